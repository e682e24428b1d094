"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space and words as the contracts of this subpackage define them.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def ship(spark: SparkSession) -> None:
    """Let Python workers find this package where they share the driver's files."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = f"{os.environ.get('PYTHONPATH', '')}:{env.get('PYTHONPATH', '')}".split(":")
    if root not in known:
        env["PYTHONPATH"] = ":".join(filter(None, [root, env.get("PYTHONPATH", "")]))


def shared(spark: SparkSession) -> str:
    """Folder for cut lineage: spark.checkpoint.dir, else a temporary one, if there is one machine only."""
    sc = spark.sparkContext
    place = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not place and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    place = place or tempfile.mkdtemp(prefix="checkpoint-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(place)
    return place


def cut(df: DataFrame) -> DataFrame:
    """The same rows, written once to the shared folder, without their lineage."""
    shared(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of plans that are done: Spark drops them when the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: In a worker: what the operator that ran last remembers between tasks, and how to forget it.
_memory: dict[str, Callable[[], None]] = {}


def _begin(owner: str, forget: Callable[[], None] | None) -> None:
    for other in [k for k in _memory if k != owner]:
        _memory.pop(other)()
    if forget:
        _memory[owner] = forget


def give_back() -> None:
    """Return what this process has freed to the machine; Arrow's pool and the C library keep it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the GNU library's only
    if trim:
        trim(0)


def tidy(owner: str, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], forget: Callable[[], None] | None = None):
    """run for mapInArrow, after which a worker that waits, while the JVM or other operators work, holds little.

    ``forget`` empties what the operator remembers between tasks (a function of its module); it is called as soon as
    another operator's task comes to the worker.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _begin(owner, forget)
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z, nothing else."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(c, upper, upper.lower())


def word_array(text: Column) -> Column:
    """Words of a text (null: none)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


class Remembered(dict):
    """What a function yields for short byte strings; forgets all when it has ``most`` of them.

    Strings above ``LONGEST`` bytes are worked out each time, so that few megabytes are held.
    """

    LONGEST = 64

    def __init__(self, work: Callable[[bytes], int], most: int) -> None:
        self.work, self.most = work, most

    def __missing__(self, word: bytes) -> int:
        value = self.work(word)
        if len(word) <= self.LONGEST:
            if len(self) >= self.most:
                self.clear()
            self[word] = value
        return value


def let(value: Column, body) -> Column:
    """body(value), evaluating value once a row even where body uses it often."""
    return F.element_at(F.transform(F.array(value), body), 1)


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal text modulo n (null id: 0)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % n, F.lit(0))


def shuffle_parts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))

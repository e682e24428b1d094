"""Document fingerprints: SpotSigs.

A signature starts at an anchor (a common word) and chains the next ``CHAIN`` content words (words that are no
anchors) after it. A fingerprint is the set of a text's signatures, each as a 32-bit hash, written as base64
of the sorted numbers; it holds the whole set, so that two fingerprints are enough to compare two
texts by Jaccard similarity. A text without any signature has the digest of its words as its only one.

``near_pairs`` compares fingerprints with each other: equal ones form a class; classes are partitioned by
set length so that only neighbouring partitions can be similar enough; within them, a pair must share one of its
rarest signatures; what is left is compared through a Jaccard similarity that stops early.

``fingerprint_edits`` needs each document's successor by descending id. Ids, and where many rows share one the
beginnings of their texts, are cut into ranges of about ``RANGE_BYTES``; each range gets a copy of the row that
follows its last one, and is then read in order as a stream, so that texts are shuffled once and no task grows with
the table. It compares given pairs, for which nothing is searched or pruned.

Cases: null texts are empty (a fixed fingerprint, likeness 1 with each other); ids that tie are ordered by text,
null ids come last; rows that repeat follow each other; empty tables give no rows; a table of one row is its
own successor; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ndspark.llm.common import Remembered, cut, ship, shuffle_parts

CHAIN = 2
#: Bytes of text in a range, characters of a text that ranges are cut by, keys that are looked at for each range.
RANGE_BYTES, BEGINNING, SEEN = 48 << 20, 32, 50
#: Articles, prepositions and auxiliaries of four languages.
ANCHORS = frozenset(
    (
        "the a an of to in is and that it was for on are as with by at be this "
        "der die das und in zu den ist von mit ein eine nicht auf sich des dem im für "
        "le la les de des un une et en est que qui dans pour du au "
        "el los las y se del por con una su para al es lo"
    ).split()
)
_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ!?.,;:()[]{}\"|", b"abcdefghijklmnopqrstuvwxyz" + b" " * 14)
_ANCHORS = frozenset(w.encode() for w in ANCHORS)


#: 64-bit hash of each word, 0 for anchors.
_hashes = Remembered(lambda word: 0 if word in _ANCHORS else xxhash.xxh64_intdigest(word) | 1, 200_000)


def signatures(text: str | None, chain: int = CHAIN) -> np.ndarray:
    """Sorted distinct 32-bit signatures of a text; at least one."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    content = np.flatnonzero(h)
    anchors = np.flatnonzero(h == 0)
    first = np.searchsorted(content, anchors)  # the first content word after each anchor
    first = np.unique(first[first + chain <= len(content)])
    if not len(first):
        return np.array([xxhash.xxh32_intdigest(b" ".join(words))], np.uint32)
    c = h[content]
    out = c[first]
    for k in range(1, chain):
        out = (out * np.uint64(0x9E3779B97F4A7C15)) ^ (c[first + k] >> np.uint64(7)) ^ c[first + k]
    out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.unique((out >> np.uint64(32)).astype(np.uint32))


def fingerprint(s: np.ndarray) -> str:
    return base64.b64encode(s.astype("<u4").tobytes()).decode()


def parse(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<u4")


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard similarity of two sorted sets; 0 as soon as the lengths rule out ``least``."""
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return 0.0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    common = int(np.count_nonzero(b[at] == a))
    return common / (len(a) + len(b) - common)


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (range, own, doc_id, text) in order, each range ending with its successor's row: results of the own rows."""
    held: tuple | None = None  # range, doc_id, text, signatures
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            part = batch.slice(at, 200)
            out = []
            for where, own, doc_id, text in zip(*(part.column(k).to_pylist() for k in range(4)), strict=True):
                text = text or ""
                s = signatures(text)
                if held and held[0] == where:
                    out.append(_compare(held[1], held[2], held[3], text, s))
                held = (where, doc_id, text, s) if own else None
            columns = list(zip(*out, strict=True)) or [[]] * 7
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def _compare(doc_id: int | None, text: str, s: np.ndarray, following: str, t: np.ndarray) -> tuple:
    n = len(text)
    k = n // 3
    edited = text[: n - k] + following[:k]
    e = signatures(edited)
    return doc_id, n, hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), fingerprint(s), fingerprint(e), likeness(s, e), likeness(s, t)


def _place(key: Column, edges: list[Column]) -> Column:
    """How many of some rising edges are at most key, by looking at every k-th and then at k of them."""
    if not edges:
        return F.lit(0)
    k = max(1, math.isqrt(len(edges)))
    number = lambda xs: F.size(F.filter(xs, lambda e: e <= key))
    coarse = number(F.array(*edges[k - 1 :: k])) if len(edges) >= k else F.lit(0)
    return coarse * k + number(F.slice(F.array(*edges), coarse * k + 1, F.lit(k)))


def fingerprint_edits(df: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row of df (doc_id, text)."""
    spark = df.sparkSession
    ship(spark)
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows, size = docs.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    ranges = max(shuffle_parts(spark), (size or 0) // range_bytes + 1)
    # falling ids, nulls last, then the texts' beginnings
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.coalesce(F.bitwise_not("doc_id"), F.lit(0)).alias("down"), F.coalesce(F.substring("text", 1, BEGINNING), F.lit("")).alias("beginning"))
    keyed = docs.withColumn("key", order)
    share = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 32)) / float(1 << 32)
    # about SEEN keys for each range
    seen = sorted(tuple(r["key"]) for r in keyed.where(share * rows <= SEEN * ranges).select("key").distinct().collect())
    cuts = sorted({seen[len(seen) * k // ranges] for k in range(1, ranges)}) if seen else []
    literal = lambda e: F.struct(F.lit(e[0]).alias("unnamed"), F.lit(e[1]).cast("long").alias("down"), F.lit(e[2]).alias("beginning"))
    ranged = keyed.withColumn("place", _place(F.col("key"), [literal(e) for e in cuts]))
    heads = {r["place"]: tuple(r["key"]) for r in ranged.groupBy("place").agg(F.min("key").alias("key")).collect()}  # a row for each range
    places = sorted(heads)
    goes = [(places[k - 1], *heads[places[k]]) for k in range(len(places))]
    target = spark.createDataFrame(goes, "to int, unnamed boolean, down long, beginning string").select("to", F.struct("unnamed", "down", "beginning").alias("head"))
    # the head of a range: of the rows with its least key, the least text
    wanted = keyed.join(F.broadcast(target), F.col("key") == F.col("head"))
    copies = wanted.groupBy("to").agg(F.min(F.struct(F.col("text").isNotNull().alias("given"), "text")).alias("t"), F.first("doc_id").alias("doc_id"))
    copies = copies.select(F.col("to").alias("place"), F.lit(False).alias("own"), "doc_id", F.col("t.text").alias("text"))
    rows_ = ranged.select("place", F.lit(True).alias("own"), "doc_id", "text").union(copies)
    dealt = rows_.repartition(max(1, len(places)), "place").sortWithinPartitions("place", F.desc("own"), F.col("doc_id").desc_nulls_last(), F.col("text").asc_nulls_first())
    return dealt.mapInArrow(_stream, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def fingerprints(df: DataFrame, chain: int = CHAIN) -> DataFrame:
    """doc_id and fingerprint of every row of df (doc_id, text)."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([fingerprint(signatures(t, chain)) for t in batch.column(1).to_pylist()], pa.string())], ["doc_id", "fingerprint"])

    return df.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fingerprint string")


def near_pairs(prints: DataFrame, percent: int = 80) -> DataFrame:
    """Pairs (a, b, likeness) of classes of equal fingerprints at percent or more; a class goes by its smallest doc_id."""
    ship(prints.sparkSession)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([parse(f).astype(np.int64).tolist() for f in batch.column(1).to_pylist()], pa.list_(pa.int64()))], ["id", "s"])

    classes = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("id")).select("id", "fingerprint")
    sets = cut(classes.mapInArrow(unpack, "id long, s array<long>").withColumn("n", F.size("s")))
    each = sets.select("id", "n", F.explode("s").alias("x"))
    rare = each.groupBy("x").agg(F.count("*").alias("df"))
    ranked = each.join(rare, "x").groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("df", "x"))).alias("r"))
    keep = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    # lengths in one partition differ by less than 1 / (percent / 100), so a partner is in this one or the next
    part = F.floor(F.log(F.col("n")) / F.lit(float(np.log(100 / percent)))).cast("int")
    prefix = ranked.select("id", "n", part.alias("p"), F.explode(F.slice("r", F.lit(1), keep.cast("int"))).alias("r")).select("id", "n", "p", F.col("r.x").alias("x"))
    near = F.explode(F.array(F.col("p"), F.col("p") + 1, F.col("p") - 1) if percent < 100 else F.array("p"))
    left = prefix.select(F.col("id").alias("a"), F.col("n").alias("na"), "x", near.alias("p"))
    right = prefix.select(F.col("id").alias("b"), F.col("n").alias("nb"), "x", "p")
    able = left.join(right, ["x", "p"]).where((F.col("a") < F.col("b")) & (100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))).select("a", "b").distinct()
    both = able.join(sets.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a").join(sets.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    like = common / (F.size("sa") + F.size("sb") - common)
    return both.select("a", "b", like.alias("likeness")).where(F.col("likeness") >= percent / 100)

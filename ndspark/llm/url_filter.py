"""URL filter over a sorted digest array.

The rules' strings are kept as sorted arrays of 64-bit xxhash digests beside the full strings. A Python
worker maps each array into memory once (an unlinked file, shared by the tasks it runs), probes a whole Arrow
batch by binary search and confirms each hit against the stored string, so that digests that collide cannot
change a verdict. Of a host only the suffixes no longer than the longest host of a rule are probed.

Arrays go to all workers, so their sum is bounded by ``max_bytes``; a larger list of rules raises.

A rule is ``host/path``: it fits its host and all subdomains if the URL's path starts with the rule's
path. The longest rule string wins, then the longer host. Rules that repeat: the last given counts.

Cases: URLs may have any length; a null URL or one without ``://`` has an empty host and path, so no rule fits it; URLs that no
rule fits get ``default``; repeated rows are judged alike; an empty table gives an empty result; columns
other than the id and the URL are not read, whatever their names.
"""

from __future__ import annotations

import mmap
import struct
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ndspark.llm.common import ascii_lower, ship

#: Bytes of one array that is sent to all workers; longer lists go as several, probed in turn, and bytes of all of them.
MAX_SHARD_BYTES, MAX_BYTES = 64 << 20, 1 << 30
_mapped: dict[str, DigestArray] = {}


def digest(strings: Iterable[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(s) for s in strings), dtype=np.uint64)


def pack(entries: dict[str, int]) -> bytes:
    """Sorted digests, payloads, string offsets and strings as one block of bytes."""
    names = list(entries)
    keys = digest(names)
    order = np.lexsort((np.arange(len(names)), keys))
    blobs = [names[i].encode() for i in order]
    ends = np.cumsum([0, *map(len, blobs)], dtype=np.uint64)
    payload = np.array([entries[names[i]] for i in order], dtype=np.int64)
    return struct.pack("<Q", len(names)) + keys[order].tobytes() + payload.tobytes() + ends.tobytes() + b"".join(blobs)


class DigestArray:
    """A packed set of strings with payloads, read through a memory map."""

    def __init__(self, packed: bytes) -> None:
        with tempfile.TemporaryFile() as f:
            f.write(packed)
            f.flush()
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        (n,) = struct.unpack_from("<Q", self.map)
        self.keys = np.frombuffer(self.map, np.uint64, n, 8)
        self.payload = np.frombuffer(self.map, np.int64, n, 8 + 8 * n)
        self.ends = np.frombuffer(self.map, np.uint64, n + 1, 8 + 16 * n)
        self.start = 8 + 16 * n + 8 * (n + 1)
        #: bytes of the longest string
        self.longest = int(np.diff(self.ends).max(initial=0))

    def string(self, i: int) -> str:
        return self.map[self.start + int(self.ends[i]) : self.start + int(self.ends[i + 1])].decode()

    def probe(self, strings: list[str], keys: np.ndarray | None = None) -> np.ndarray:
        """Row of each string in the array, -1 where it isn't one of them. keys: their digests, if known."""
        keys = digest(strings) if keys is None else keys
        out = np.full(len(strings), -1, dtype=np.int64)
        low, high = np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right")
        for k in np.nonzero(high > low)[0]:
            for i in range(low[k], high[k]):  # more than one where digests collide
                if self.string(i) == strings[k]:
                    out[k] = i
                    break
        return out


def rule_key(host: str, path: str) -> str:
    return f"{host}\0{path}"


def shards(rules: Iterable[tuple[str, str, str]]) -> list[tuple[bytes, bytes, list[int]]]:
    """Rules (verdict, host, path) as packed hosts, packed rules (payload 1: block) and their paths' lengths."""
    by_host: dict[str, dict[str, int]] = {}
    for verdict, host, path in rules:
        by_host.setdefault(host.lower(), {})[path] = int(verdict == "block")
    groups, size = [{}], 0
    for host, paths in by_host.items():
        n = sum(len(rule_key(host, p).encode()) + 24 for p in paths)
        if groups[-1] and size + n > MAX_SHARD_BYTES:
            groups.append({})
            size = 0
        groups[-1][host] = paths
        size += n
    return [
        (
            pack({h: 0 for h in group}),
            pack({rule_key(h, p): v for h, paths in group.items() for p, v in paths.items()}),
            sorted({len(p) for paths in group.values() for p in paths}),
        )
        for group in groups
        if group
    ]


def mapped(packed: bytes) -> DigestArray:
    """The array of a block of bytes, mapped once in a worker."""
    name = xxhash.xxh3_128_hexdigest(packed)
    if name not in _mapped:
        if sum(len(a.map) for a in _mapped.values()) + len(packed) > MAX_BYTES:
            _mapped.clear()
        _mapped[name] = DigestArray(packed)
    return _mapped[name]


def suffixes(host: str, most: int) -> list[str]:
    """The host and every domain above it, if they have at most so many characters."""
    out = [host] if len(host) <= most else []
    dot = host.find(".", max(0, len(host) - most - 1))
    while dot >= 0:
        out.append(host[dot + 1 :])
        dot = host.find(".", dot + 1)
    return out


def judge_batch(hosts: list[str], paths: list[str], part: tuple[DigestArray, DigestArray, list[int]]) -> list[tuple[str, str, int] | None]:
    """(host, path, block) of the rule that wins for each row; None where none fits."""
    known, rules, lengths = part
    tails = [(k, s) for k, h in enumerate(hosts) for s in suffixes(h, known.longest) if s]
    hit = known.probe([s for _, s in tails])
    tries = [(k, s, paths[k][:n]) for (k, s), at in zip(tails, hit, strict=True) if at >= 0 for n in lengths if n <= len(paths[k])]
    out: list[tuple[str, str, int] | None] = [None] * len(hosts)
    for (k, h, p), at in zip(tries, rules.probe([rule_key(h, p) for _, h, p in tries]), strict=True):
        if at >= 0:
            now = out[k]
            if now is None or (len(h) + len(p), len(h)) > (len(now[0]) + len(now[1]), len(now[0])):
                out[k] = (h, p, int(rules.payload[at]))
    return out


def judge_urls(df: DataFrame, rules: Iterable[tuple[str, str, str]], key: str = "page_id", url: str = "url", default: str = "allow", max_bytes: int = MAX_BYTES) -> DataFrame:
    """key, host, path, rule and verdict of every row of df. rules: (allow or block, host, path)."""
    spark = df.sparkSession
    ship(spark)
    arrays = shards(rules)
    if (size := sum(len(part[0]) + len(part[1]) for part in arrays)) > max_bytes:
        raise ValueError(f"the rules take {size} bytes in every worker, more than {max_bytes}")
    sent = [spark.sparkContext.broadcast(part) for part in arrays]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for b in sent:
            hosts, packed, lengths = b.value
            parts.append((mapped(hosts), mapped(packed), lengths))
        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            best: list[tuple[str, str, int] | None] = [None] * len(hosts)
            for part in parts:
                for k, new in enumerate(judge_batch(hosts, paths, part)):
                    old = best[k]
                    if new and (old is None or (len(new[0]) + len(new[1]), len(new[0])) > (len(old[0]) + len(old[1]), len(old[0]))):
                        best[k] = new
            rule = pa.array([x and x[0] + x[1] for x in best], pa.string())
            verdict = pa.array([("block" if x[2] else "allow") if x else default for x in best], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column("host"), batch.column("path"), rule, verdict], [key, "host", "path", "rule", "verdict"])

    pattern = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(F.col(url), F.lit(""))
    cleaned = df.select(F.col(key), ascii_lower(F.regexp_extract(text, pattern, 1)).alias("host"), F.regexp_extract(text, pattern, 2).alias("path"))
    kind = df.schema[key].dataType.simpleString()
    return cleaned.mapInArrow(run, f"`{key}` {kind}, host string, path string, rule string, verdict string")

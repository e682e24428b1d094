"""Near-duplicate detection over SetSketch registers.

Every document is the set of its distinct word shingles. A sketch of ``REGISTERS`` one-byte registers
holds exponentially spaced, truncated minima: register i is ``floor(1 - log_b(x_i))``, clipped to 0..255,
where x_i is the least of the set's hash values under the i-th hash, spread as exponentials of rate
``RATE``. Sketches merge by the maximum, and two sketches agree in a register with a probability close to
the sets' Jaccard similarity. ``BANDS`` bands of ``ROWS`` registers make candidates: at a similarity of 0.8 a pair
is missed with probability (1 - 0.8^8)^64 < 1e-5. What no sketch decides is a link: candidates that the joint
likelihood of their registers leaves possible are confirmed on their full shingle sets (64-bit hashes).

How links are found without listing the pairs of a group:

1. rows with equal sets form a class, which goes by a hash of the set; one row of each goes on;
2. band values are range-sorted with ids, so that even one value that a third of all rows share is cut over many
   tasks, and each run of equal values links its members to its first row; boundary rows join the runs;
3. these links are confirmed and contracted to components;
4. bands whose rows lie in more than one component are compared in blocks of bounded bytes, in place: rows of one
   component are never compared with each other, only confirmed links leave a block;
5. all links are contracted again (large star and small star, to a fixpoint).

Joins with lines of heads or classes that many rows share send those lines to all tasks (``meet``) and leave the
rows where they are; there are at most ``HUBS`` such lines, whatever the input.

Result per row: doc_id, n_shingles, component_id (smallest id reachable), kept (doc_id = component_id).
``one_of_each`` gives the rows themselves, one of each group.

Cases: texts that are null or have no words have an empty set and are linked with nothing; a text with
fewer words than a shingle is one shingle; texts and words may have any length; rows that share an id are linked by
their texts only; rows without an id are compared like all others, but give no component its name: a component of
such rows only has a null one, and its rows are kept; in ``near_duplicates`` rows that repeat, id included, are kept
alike, in ``one_of_each`` one of them is; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ndspark.llm.common import WORD, Remembered, cut, release, ship, shuffle_parts, tidy

REGISTERS, ROWS = 512, 8
BANDS = REGISTERS // ROWS
BASE, RATE = 1.08, 8.0
#: A pair of similarity 0.8 has an estimate below this with a probability under 1e-6 (0.09 is 5 standard deviations).
MARGIN = 0.09
#: Bytes of sketches and sets on either side of a block.
BLOCK_BYTES = 8 << 20
#: Links of one centre that one task confirms.
LINKS_PER_TASK = 1000
#: Rows of one key that a task takes as they come, and keys at most with more that are sent to all tasks.
KEY_ROWS, HUBS = 1000, 200_000
_MULTIPLIERS = np.random.default_rng(90).integers(0, 1 << 63, size=REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PRIME = np.uint64(0x9E3779B97F4A7C15)


_hashes = Remembered(xxhash.xxh64_intdigest, 150_000)


def _forget() -> None:
    _hashes.clear()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles. bytes.lower and split know ASCII only, as the contract does."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    width = min(size, len(words))
    n = len(words) - width + 1
    out = h[:n].copy()
    for j in range(1, width):
        out = out * _PRIME + h[j : j + n]
    return np.unique(mixed(out + np.uint64(width)))


def sketch(sets: list[np.ndarray]) -> np.ndarray:
    """Registers, a row for each set; all zero for an empty one."""
    out = np.zeros((len(sets), REGISTERS), np.uint8)
    full = [k for k, s in enumerate(sets) if len(s)]
    at = 0
    while at < len(full):
        end, total = at, 0
        while end < len(full) and (end == at or total + len(sets[full[end]]) <= 32_768):
            total += len(sets[full[end]])
            end += 1
        some = [sets[k] for k in full[at:end]]
        joined = np.concatenate(some)
        starts = np.cumsum([0, *map(len, some[:-1])])
        least = np.empty((REGISTERS, len(some)), np.uint64)
        for i, a in enumerate(_MULTIPLIERS):
            np.minimum.reduceat(joined * a, starts, out=least[i])
        x = -np.log1p(-(least.T.astype(np.float64) + 0.5) / 2.0**64) / RATE
        out[full[at:end]] = np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, 255).astype(np.uint8)
        at = end
    return out


def band_values(registers: np.ndarray) -> np.ndarray:
    """64-bit value of each band of each row."""
    value = np.ascontiguousarray(registers).reshape(len(registers), BANDS, ROWS).view(np.uint64)[:, :, 0]
    return mixed(mixed(value) + np.arange(1, BANDS + 1, dtype=np.uint64)[None, :] * _PRIME)


def slope(j: np.ndarray | float, more: np.ndarray, less: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Derivative by j, the Jaccard similarity, of the likelihood's logarithm, given how many registers of a
    exceed and fall below those of b, and both sizes. It falls as j grows."""
    u = n_a / (n_a + n_b)
    v = 1 - u
    c = (BASE - 1) / BASE
    p = lambda x: -np.log1p(-np.clip(x, 1e-12, 1) * c) / np.log(BASE)
    dp = lambda x: c / (1 - np.clip(x, 0, 1) * c) / np.log(BASE)
    a, b = u - v * j, v - u * j
    p_a, p_b = p(a), p(b)
    equal = (REGISTERS - more - less) * (v * dp(a) + u * dp(b)) / np.maximum(1 - p_a - p_b, 1e-12)
    return equal - more * v * dp(a) / p_a - less * u * dp(b) / p_b


def estimate(more: np.ndarray, less: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Likeliest Jaccard similarity (see ``slope``), by bisection."""
    low, high = np.zeros(len(more)), np.minimum(n_a / n_b, n_b / n_a)
    for _ in range(30):
        j = (low + high) / 2
        up = slope(j, more, less, n_a, n_b) > 0
        low, high = np.where(up, j, low), np.where(up, high, j)
    return (low + high) / 2


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether the sets' Jaccard similarity is at least percent / 100."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.searchsorted(b, a)
    both[both == len(b)] = 0
    common = int(np.count_nonzero(b[both] == a))
    return 100 * common >= percent * (len(a) + len(b) - common)


def possible(one: np.ndarray, n_one: int, rest: np.ndarray, n_rest: np.ndarray, percent: int) -> np.ndarray:
    """Which of other sketches can belong to a link with this one, by sizes and by the joint likelihood."""
    near = np.flatnonzero(100 * np.minimum(n_one, n_rest) >= percent * np.maximum(n_one, n_rest))
    if not len(near):
        return near
    other = rest[near]
    more, less = np.count_nonzero(one > other, axis=1), np.count_nonzero(one < other, axis=1)
    return near[slope(percent / 100 - MARGIN, more, less, np.full(len(near), float(n_one)), n_rest[near].astype(float)) >= 0]


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _key(s: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart."""
    one, two = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64)
    return int(one), int(two)


def _sketches(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of rows (doc_id, m1, m2, text): size, key and registers of the set in place of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = [shingles(t, size) for t in part.column(3).cast(pa.binary()).to_pylist()]
                keys = [_key(s) for s in sets]
                n = pa.array([len(s) for s in sets], pa.int64())
                yield pa.RecordBatch.from_arrays([*part.columns[:3], n, pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()), _binary(sketch(sets))], ["doc_id", "m1", "m2", "n", "k1", "k2", "registers"])

    return run


def _sets(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of rows (id, text): size, registers and set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = [shingles(t, size) for t in part.column(1).cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(s) for s in sets], pa.int64()), _binary(sketch(sets)), pa.array([s.tobytes() for s in sets], pa.binary())], ["id", "n", "registers", "shingles"])

    return run


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            registers = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint8).reshape(-1, REGISTERS)
            values = band_values(registers).view(np.int64).ravel()
            ids = np.repeat(part.column(0).to_numpy(), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(ids)], ["band", "id"])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted (band, id): rows whose band has another row here, with the run's first id; and, marked as edge, the first and last run."""

    def rows(band: np.ndarray, ids: np.ndarray, first: bool, last: bool) -> pa.RecordBatch | None:
        starts = np.flatnonzero(np.r_[True, band[1:] != band[:-1]])
        lengths = np.diff(np.r_[starts, len(band)])
        edge = np.zeros(len(starts), bool)
        edge[0] |= first
        edge[-1] |= last
        head, keep, edge = np.repeat(ids[starts], lengths), np.repeat((lengths > 1) | edge, lengths), np.repeat(edge, lengths)
        if not keep.any():
            return None
        return pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (band, ids, head)] + [pa.array(edge[keep])], ["band", "id", "head", "edge"])

    held: tuple[np.ndarray, np.ndarray] | None = None
    first = True
    for batch in batches:
        if not batch.num_rows:
            continue
        band, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if held:
            band, ids = np.r_[held[0], band], np.r_[held[1], ids]
        done = int(np.searchsorted(band, band[-1], "left"))
        if done == 0 and len(band) > 200_000:  # one band over many batches: its first row stands for what goes out
            out = rows(band, ids, True, True)
            yield out
            held, first = (band[:1], ids[:1]), False
            continue
        if done:
            if (out := rows(band[:done], ids[:done], first, False)) is not None:
                yield out
            first = False
        held = (band[done:], ids[done:])
    if held and (out := rows(*held, first, True)) is not None:
        yield out


def _groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, dict[str, list]]]:
    """Runs of rows with equal first n_keys columns, as lists by column."""
    key, held = None, {}
    for batch in batches:
        columns = batch.to_pydict()
        names = list(columns)
        keys = list(zip(*(columns[n] for n in names[:n_keys]), strict=True))
        at = 0
        while at < len(keys):
            end = at
            while end < len(keys) and keys[end] == keys[at]:
                end += 1
            if keys[at] != key:
                if held:
                    yield key, held
                key, held = keys[at], {n: [] for n in names[n_keys:]}
            for n in names[n_keys:]:
                held[n] += columns[n][at:end]
            at = end
    if held:
        yield key, held


def _confirm(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of rows (head, salt, tag, id, n, registers, shingles), sorted: links of each head (tag 0) with the others that hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, centre = None, None
        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in range(7)]
            found: list[tuple[int, int]] = []
            for head, salt, tag, id_, n, registers, data in zip(*columns, strict=True):
                if tag == 0:
                    key, centre = (head, salt), (n, np.frombuffer(registers, np.uint8), np.frombuffer(data, np.uint64))
                elif key == (head, salt):
                    able = possible(centre[1], centre[0], np.frombuffer(registers, np.uint8)[None, :], np.array([n]), percent)
                    if len(able) and linked(centre[2], np.frombuffer(data, np.uint64), percent):
                        found.append((head, id_))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())], ["a", "b"])

    return run


def block_links(ids: list[int], components: list[int], sizes: list[int], registers: list[bytes], data: list[bytes], percent: int) -> list[tuple[int, int]]:
    """Confirmed links between rows of different components, one at most between rows that earlier links join already."""
    order = sorted(range(len(ids)), key=lambda k: (components[k], ids[k]))
    sketches = np.frombuffer(b"".join(registers[k] for k in order), np.uint8).reshape(-1, REGISTERS)
    n = np.array([sizes[k] for k in order])
    sets = [np.frombuffer(data[k], np.uint64) for k in order]
    component = np.unique([components[k] for k in order], return_inverse=True)[1]
    found = []
    counts = np.bincount(component)
    largest = int(counts.argmax())
    for k in np.flatnonzero(component != largest) if counts[largest] > 1 else range(len(order)):
        # rows of the largest component are met from the other side
        others = np.flatnonzero((component != component[k]) & ((np.arange(len(order)) > k) | (component == largest)))
        if not len(others):
            continue
        able = others[possible(sketches[k], n[k], sketches[others], n[others], percent)]
        agree = np.count_nonzero(sketches[k] == sketches[able], axis=1)
        for j in able[np.argsort(-agree, kind="stable")]:
            if component[j] != component[k] and linked(sets[k], sets[j], percent):
                found.append((ids[order[k]], ids[order[j]]))
                old, new = component[k], component[j]
                if old == largest:
                    old, new = new, old
                component[component == old] = new
    return found


def _blocks(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, x in _groups(batches, 3):
            if found := block_links(x["id"], x["component"], x["n"], x["registers"], x["shingles"], percent):
                yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], ["a", "b"])

    return run


def meet(rows: DataFrame, lines: DataFrame, key: str, total: int) -> DataFrame:
    """rows (total of them) with the one line of their key; lines: key, weight (its number of rows) and more.

    Lines of keys with many rows go to all tasks, the others are joined by a shuffle.
    """
    heavy = F.col("weight") > max(KEY_ROWS, total // HUBS)
    hubs = lines.where(heavy).drop("weight")
    own = rows.join(F.broadcast(hubs), key)
    rest = rows.join(F.broadcast(hubs.select(key)), key, "left_anti").join(lines.where(~heavy).drop("weight"), key)
    return own.unionByName(rest)


def components(links: DataFrame) -> DataFrame:
    """id, component (the smallest id reachable) of every id in links (a, b), by large and small stars to a fixpoint."""

    def star(edges: DataFrame, large: bool, total: int) -> DataFrame:
        if large:
            both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        else:
            both = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("weight")).withColumn("m", F.least("m", "u"))
        met = meet(both, least, "u", total)
        if large:
            out = met.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = met.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    edges = cut(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    before = None
    while True:
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
        edges = cut(star(star(edges, True, 2 * now[0]), False, now[0]))
        release(links.sparkSession)
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))


def _star_links(stars: DataFrame, members: DataFrame, parts: int, percent: int) -> DataFrame:
    """Of pairs (head, id) those that are links. A head's set is sent once for ``LINKS_PER_TASK`` of its pairs."""
    counts = stars.groupBy("head").agg(_salts(F.count("*")).alias("salts"), F.count("*").alias("weight"))
    salted = meet(stars, counts, "head", stars.count()).select("head", F.pmod(F.xxhash64("id"), F.col("salts")).alias("salt"), "id")
    sides = salted.select("head", "salt", F.lit(1).alias("tag"), "id").union(salted.select("head", "salt").distinct().select("head", "salt", F.lit(0).alias("tag"), F.col("head").alias("id")))
    # an id is in a side for each head it met, and a head once for each of its salts
    dealt = sides.join(members, "id").repartition(parts, "head", "salt").sortWithinPartitions("head", "salt", "tag")
    return cut(dealt.select("head", "salt", "tag", "id", "n", "registers", "shingles").mapInArrow(tidy("setsketch", _confirm(percent)), "a long, b long"))


def _salts(rows: Column) -> Column:
    return F.ceil(rows / LINKS_PER_TASK)


def _marks(columns: list[Column]) -> list[Column]:
    """128 bits that tell rows apart."""
    return [F.xxhash64(F.lit(k), *columns).alias(f"m{k}") for k in (1, 2)]


def _comparable(df: DataFrame) -> list[Column]:
    """The columns of df as values that can be hashed."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return [F.to_json(F.struct(F.col(f"`{f.name}`"))) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`") for f in df.schema]


def _grouped(marked: DataFrame, shingle: int, percent: int) -> tuple[DataFrame, int]:
    """doc_id, m1, m2, n, component (null for empty sets) of every row of marked (doc_id, m1, m2, text), and their number."""
    if not 80 <= percent <= 100:
        raise ValueError("bands are set for similarities of 0.8 and more")
    spark = marked.sparkSession
    ship(spark)
    parts = shuffle_parts(spark)
    rows = cut(marked.mapInArrow(tidy("setsketch", _sketches(shingle), _forget), "doc_id long, m1 long, m2 long, n long, k1 long, k2 long, registers binary"))
    known = rows.where("n > 0")
    # a class is the rows with one key of 128 bits; half of it names the class unless another has the same half
    one = F.min(F.struct("m1", "m2")).alias("one")
    classes = known.groupBy("k1", "k2", "n").agg(one, F.first("registers").alias("registers"), F.count("*").alias("weight"))
    classes = cut(classes.select(F.col("k1").alias("id"), "k2", "n", "one.m1", "one.m2", "registers", "weight"))
    halves = classes.groupBy("id").agg(F.count("*").alias("c"), F.min("k2").alias("least")).where("c > 1").select("id", "least")
    halves = cut(halves)
    if halves.limit(1).count():  # expected below 2^32 classes: none
        other = lambda df, name: df.join(F.broadcast(halves), name, "left").withColumn(name, F.when(F.col("least").isNull() | (F.col("least") == F.col("k2")), F.col(name)).otherwise(F.xxhash64(name, "k2"))).drop("least")
        classes = other(classes, "id")
        known = other(known.withColumnRenamed("k1", "id"), "id")
    else:
        known = known.withColumnRenamed("k1", "id")

    # 2: bands, range-sorted, in runs
    bands = classes.select("id", "registers").mapInArrow(tidy("setsketch", _bands), "band long, id long")
    runs = cut(bands.repartitionByRange(parts, "band", "id").sortWithinPartitions("band", "id").mapInArrow(tidy("setsketch", _runs), "band long, id long, head long, edge boolean"))
    heads = runs.where("edge").groupBy("band").agg(F.min("head").alias("least"), F.max("head").alias("most")).where("least <> most")
    across = runs.where("edge").select("band", "head").distinct().join(heads.select("band", "least"), "band").select(F.col("least").alias("head"), F.col("head").alias("id"))
    stars = cut(runs.select("head", "id").union(across).where("head <> id").distinct())
    wanted = stars.select("id").union(stars.select(F.col("head").alias("id"))).distinct()

    # 3: full sets of the documents that have candidates; links to the runs' heads
    wanted = wanted.join(classes.select("id", "m1", "m2"), "id")
    texts = marked.join(wanted, ["m1", "m2"]).select("m1", "m2", "id", "text")
    if rows.groupBy("m1", "m2").agg(F.count("*").alias("c")).where("c > 1").limit(1).count():  # of rows that repeat as they are, one
        texts = texts.groupBy("m1", "m2", "id").agg(F.any_value("text").alias("text"))
    texts = texts.select("id", "text")
    members = cut(texts.mapInArrow(tidy("setsketch", _sets(shingle), _forget), "id long, n long, registers binary, shingles binary"))
    release(spark)
    first = components(_star_links(stars, members, parts, percent))
    weight = F.lit(8) * F.col("n") + (REGISTERS + 64)

    # 4: bands over several components, compared in blocks
    labels = members.select("id", weight.alias("bytes")).join(first, "id", "left").withColumn("component", F.coalesce("component", "id"))
    placed = runs.select("band", "id").distinct().join(labels, "id")
    mark = F.xxhash64("id")
    several = (
        placed.groupBy("band")
        .agg(F.min("component").alias("c0"), F.max("component").alias("c1"), F.count("*").alias("n"), F.sum(F.shiftright(mark, 34)).alias("s"), F.bit_xor(mark).alias("x"))
        .where("c0 <> c1")
        .groupBy("n", "s", "x")  # bands of the same rows are compared once
        .agg(F.min("band").alias("band"))
        .select("band")
    )
    placed = cut(placed.join(several, "band"))
    release(spark)
    weights = placed.groupBy("band", "component").agg(F.sum("bytes").alias("all")).withColumn("own", F.when(F.col("all") > BLOCK_BYTES, F.ceil(F.col("all") / BLOCK_BYTES)).otherwise(0))
    pools = weights.where("own = 0").groupBy("band").agg(F.ceil(F.sum("all") / BLOCK_BYTES).alias("pool"))
    rules = weights.select("band", "component", "own").join(pools, "band", "left")
    chunk = F.when(F.col("own") > 0, F.xxhash64("component", F.pmod(F.xxhash64("id"), F.col("own")))).otherwise(F.pmod(F.xxhash64("component"), F.col("pool")))
    chunked = placed.select("band", "component", "id").join(rules, ["band", "component"])
    chunked = cut(chunked.select("band", "component", "id", chunk.alias("chunk"), F.when(F.col("own") > 0, F.col("component")).alias("only")))
    chunks = chunked.select("band", "chunk", "only").distinct()
    a, b = chunks.select("band", F.col("chunk").alias("c"), F.col("only").alias("o")), chunks.select("band", F.col("chunk").alias("d"), F.col("only").alias("p"))
    pairs = a.join(b, "band").where((F.col("c") <= F.col("d")) & ~((F.col("o") == F.col("p")) & F.col("o").isNotNull() & F.col("p").isNotNull()).eqNullSafe(F.lit(True))).select("band", "c", "d")
    left = pairs.withColumn("chunk", F.col("c")).union(pairs.where("c <> d").withColumn("chunk", F.col("d")))
    spread = left.join(chunked, ["band", "chunk"]).select("band", "c", "d", "id", "component")
    wide = spread.join(members, "id").repartition(parts, "band", "c", "d").sortWithinPartitions("band", "c", "d")
    more = cut(wide.select("band", "c", "d", "id", "component", "n", "registers", "shingles").mapInArrow(tidy("setsketch", _blocks(percent)), "a long, b long"))
    release(spark)

    # 5: everything together
    last = components(first.select(F.col("id").alias("a"), F.col("component").alias("b")).union(more))
    named = classes.select("id", "weight").join(last, "id", "left").select("id", F.coalesce("component", "id").alias("component"), "weight")
    total = rows.count()
    full = meet(known.select("id", "doc_id", "m1", "m2", "n"), named, "id", total).select("doc_id", "m1", "m2", "n", "component")
    empty = rows.where("n = 0").select("doc_id", "m1", "m2", "n", F.lit(None).cast("long").alias("component"))
    return full.union(empty), total


def near_duplicates(df: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of df (doc_id, text); percent: 80 or more."""
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found, total = _grouped(docs.select("doc_id", *_marks([F.col("doc_id"), F.col("text")]), "text"), shingle, percent)
    found = cut(found.select("doc_id", "n", "component"))
    release(df.sparkSession)
    least = found.where(F.col("component").isNotNull()).groupBy("component").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("weight"))
    out = meet(found.where(F.col("component").isNotNull()), least, "component", total).select("doc_id", "n", "component_id")
    out = out.union(found.where(F.col("component").isNull()).select("doc_id", "n", F.col("doc_id").alias("component_id")))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"))


def one_of_each(df: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """Rows of df, all columns: of each group of near-duplicates the one of least id (null last), and all rows without words."""
    # names of its own, so that no column of df clashes with them
    names = [f"c{k}" for k in range(len(df.columns))]
    own = df.toDF(*names)
    at = {c: names[k] for k, c in enumerate(df.columns)}
    marked = own.select(*names, *_marks(_comparable(own)))
    found, total = _grouped(marked.select(F.col(at["doc_id"]).cast("long").alias("doc_id"), "m1", "m2", F.col(at["text"]).alias("text")), shingle, percent)
    alike = found.where(F.col("component").isNotNull()).groupBy("component", "m1", "m2", "doc_id").agg(F.count("*").alias("weight"))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "m1", "m2", "weight")).alias("best")
    kept = cut(alike.groupBy("component").agg(best).select("best.m1", "best.m2", "best.weight"))
    release(df.sparkSession)
    full = marked.where(F.coalesce(F.col(at["text"]), F.lit("")).rlike(WORD))
    single = full.join(kept.where("weight = 1").select("m1", "m2"), ["m1", "m2"], "left_semi").select(*names)
    out = single.union(own.where(~F.coalesce(F.col(at["text"]), F.lit("")).rlike(WORD)))
    if kept.where("weight > 1").limit(1).count():  # rows that repeat as they are: any one of them
        several = kept.where("weight > 1")
        heavy = F.col("weight") > max(KEY_ROWS, total // HUBS)
        hubs, rest = several.where(heavy).select("m1", "m2"), several.where(~heavy).select("m1", "m2")
        for part in (F.broadcast(hubs), rest):
            same = full.join(part, ["m1", "m2"], "left_semi").groupBy("m1", "m2").agg(*(F.any_value(c).alias(c) for c in names))
            out = out.union(same.select(*names))
    return out.toDF(*df.columns)

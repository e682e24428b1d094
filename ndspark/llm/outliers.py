"""Quality rules: robust multivariate outliers, in DataFrame expressions only.

Each document has counts (words, characters in words, symbols, repeated lines, words in repeated 3-word
windows). Documents that fail a base rule are out. The others' counts become a vector of transformed
rates, and for every language and source a minimum-covariance-determinant estimate of its centre and
scatter is fitted; documents whose distance from it exceeds ``cutoff`` are rejected.

The search has six starts a group: mean and covariance; medians and quartile spreads; covariance of the scaled
rates' hyperbolic tangents; of their directions; and two parts of the group chosen by a hash. A concentration step
refits mean and covariance on the ``support`` share of documents with the least Mahalanobis distance. After
``FIRST`` steps the start of least determinant goes on until no group's determinant falls any more.

Shares are found without sorting a group: sums of the moments are kept for each narrow bin of distance (``BINS`` to a
doubling), and the bins up to the one that holds the share make up the subset. Determinants are those of the
covariance plus ``FLOOR`` squared, the least spread of each rate that counts: most sources have no symbols or
repeats at all in half their texts. All rows together are one more group; a group's final estimate counts as many
rows as its subset, and ``PRIOR`` more rows that are like the subset of all, so that a small group leans on the
others without a limit between small and large ones.

All steps are aggregates with partial sums on the map side; the distance comes from a Cholesky factor written out as
columns, so no row is collected and no Python runs on executors.

Cases: a null text is empty (no words, fails the base rule); texts have any length; a null language or source is a
group of its own; rows at equal distances are in a subset together; repeated rows count as often as they occur; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ndspark.llm.common import SPACE, cut, let, word_array

SYMBOLS = "#*$%&|<>"
RATES = ("x0", "x1", "x2", "x3")
#: Least spread of mean word length (log), symbols a word, repeated lines and repeated words (square roots).
FLOOR = (0.12, 0.06, 0.12, 0.12)
SUPPORT = 0.75
#: Steps of all starts, and steps at most.
FIRST, STEPS = 2, 30
#: Squared distance; the 0.999 quantile of chi-squared with 4 degrees of freedom is 18.47.
CUTOFF = 25.0
PRIOR = 100
#: The group of all rows, and by how much a determinant's logarithm has to fall to go on.
ALL, FALL = "", 1e-3
#: Bins of squared distances to a doubling, bins of rates to 1, rows of a start that is chosen by a hash, about.
BINS, GRID, CHOSEN = 32, 1024, 20
#: Lines of estimates that are broadcast; more are joined by a shuffle, over so many salts.
BROADCAST_LINES, SALTS = 100_000, 16
D = len(RATES)
PAIRS = [(i, j) for i in range(D) for j in range(i + 1)]


def repeat_words(words: Column) -> Column:
    """Positions that lie in a window of three words that occurs twice or more in the array."""

    def covered(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def twice(p: Column) -> Column:
            same = lambda x, j: x["h"] == F.get(p, j)["h"]
            flags = F.transform(p, lambda x, j: F.when(F.coalesce(same(x, j - 1), F.lit(False)) | F.coalesce(same(x, j + 1), F.lit(False)), x["i"]))
            at = F.sort_array(F.filter(flags, lambda i: i.isNotNull()))
            return let(at, lambda a: F.aggregate(F.transform(a, lambda i, j: F.least(F.lit(3), F.coalesce(F.get(a, j + 1) - i, F.lit(3)))), F.lit(0), lambda s, x: s + x))

        return let(pairs, twice)

    def of(w: Column) -> Column:
        n = F.size(w)
        hashes = F.transform(F.slice(w, F.lit(1), F.greatest(n - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
        return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))

    return let(words, of)


def dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.regexp_replace(x, SPACE, "") != "")
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def statistics(df: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = word_array(F.col("text"))
    return df.select(
        "doc_id",
        "lang",
        "source",
        let(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeat_words(w).cast("long").alias("n_repeat_words"))).alias("w"),
        F.length(F.regexp_replace(text, SPACE, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        dup_lines(text).cast("long").alias("n_dup_lines"),
    ).select("doc_id", "lang", "source", "w.n_words", "word_chars", "n_symbols", "n_dup_lines", "w.n_repeat_words")


def _rates() -> list[Column]:
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return [
        F.log1p(F.col("word_chars") / n),
        F.log1p(F.col("n_symbols") / n),
        F.sqrt(F.col("n_dup_lines") / n),
        F.sqrt(F.col("n_repeat_words") / n),
    ]


def consistency(support: float) -> float:
    """What the covariance of the nearest ``support`` share of a normal distribution in D = 4 dimensions is to be multiplied with."""
    if support >= 1:
        return 1.0
    low, high = 0.0, 200.0
    for _ in range(200):
        q = (low + high) / 2
        low, high = (q, high) if 1 - math.exp(-q / 2) * (1 + q / 2) < support else (low, q)
    return support / (1 - math.exp(-q / 2) * (1 + q / 2 + q * q / 8))


def _factor(est: DataFrame) -> DataFrame:
    """Adds to means m* and covariances c* the Cholesky factor l* and logdet, the determinant's logarithm."""
    for i, j in PAIRS:  # one column at a time, or the expressions repeat each other
        rest = F.col(f"c{i}{j}")
        for k in range(j):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        est = est.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l{j}{j}"))
    logs = [F.log(F.col(f"l{i}{i}")) for i in range(D)]
    return est.withColumn("logdet", 2 * (logs[0] + logs[1] + logs[2] + logs[3]))


def _distance() -> Column:
    """Squared Mahalanobis distance of x* from m* under the factor l*."""

    def step(z: list[Column], i: int) -> Column:
        v = F.col(f"x{i}") - F.col(f"m{i}")
        for k in range(i):
            v = v - F.col(f"l{i}{k}") * z[k]
        return v / F.col(f"l{i}{i}")

    z: list[Column] = []
    for i in range(D):
        z.append(step(z, i))
    total = z[0] * z[0]
    for v in z[1:]:
        total = total + v * v
    return total


def _with_group(rows: DataFrame, lines: DataFrame, few: bool, how: str = "inner") -> DataFrame:
    """rows with the lines of their group g; a group may hold most rows."""
    if few:
        return rows.join(F.broadcast(lines), "g", how)
    salted = lines.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    own = F.pmod(F.xxhash64(*RATES, *(c for c in rows.columns if c == "doc_id")), F.lit(SALTS)).cast("int")
    return rows.withColumn("salt", own).join(salted, ["g", "salt"], how).drop("salt")


def _sums(v: list[Column]) -> list[Column]:
    return [F.count("*").alias("n"), *(F.sum(v[i]).alias(f"s{i}") for i in range(D)), *(F.sum(v[i] * v[j]).alias(f"p{i}{j}") for i, j in PAIRS)]


def _added() -> list[Column]:
    """Sums of sums, for what is grouped further."""
    return [F.sum(c).alias(c) for c in ("n", *(f"s{i}" for i in range(D)), *(f"p{i}{j}" for i, j in PAIRS))]


def _covariance(i: int, j: int) -> Column:
    return F.col(f"p{i}{j}") / F.col("n") - F.col(f"s{i}") / F.col("n") * F.col(f"s{j}") / F.col("n")


def _estimate(sums: DataFrame, scale: float, floor: tuple[float, ...], *keep: str) -> DataFrame:
    means = [(F.col(f"s{i}") / F.col("n")).alias(f"m{i}") for i in range(D)]
    covs = [(_covariance(i, j) * scale + (floor[i] ** 2 if i == j else 0.0)).alias(f"c{i}{j}") for i, j in PAIRS]
    return _factor(sums.select(*keep, "n", *means, *covs))


def _quartiles(passed: DataFrame) -> DataFrame:
    """Of each group the lower quartile, median and upper quartile of each rate (q*, of a grid), and its rows (size)."""
    each = passed.select("g", F.posexplode(F.array(*RATES)).alias("i", "x")).select("g", "i", F.floor(F.col("x") * GRID + 0.5).alias("bin"))
    along = Window.partitionBy("g", "i")
    counts = each.groupBy("g", "i", "bin").agg(F.count("*").alias("n"))
    shares = counts.select("g", "i", "bin", F.sum("n").over(along.orderBy("bin")).alias("up"), F.sum("n").over(along).alias("size"))
    at = lambda i, share: (F.min(F.when((F.col("i") == i) & (F.col("up") >= share * F.col("size")), F.col("bin"))) / float(GRID)).alias(f"q{i}_{round(100 * share)}")
    return shares.groupBy("g").agg(F.max("size").alias("size"), *(at(i, s) for i in range(D) for s in (0.25, 0.5, 0.75)))


def starts(passed: DataFrame, floor: tuple[float, ...]) -> tuple[DataFrame, bool]:
    """First estimates (g, start, m*, c*, l*) of each group of passed (g, x*), and whether they are few."""
    spread = [F.greatest((F.col(f"q{i}_75") - F.col(f"q{i}_25")) / 1.349, F.lit(floor[i])).alias(f"w{i}") for i in range(D)]
    known = cut(_quartiles(passed).select("g", "size", *(F.col(f"q{i}_50").alias(f"h{i}") for i in range(D)), *spread))
    few = 6 * known.count() <= BROADCAST_LINES
    z = [(F.col(f"x{i}") - F.col(f"h{i}")) / F.col(f"w{i}") for i in range(D)]
    norm = F.greatest(F.sqrt(z[0] * z[0] + z[1] * z[1] + z[2] * z[2] + z[3] * z[3]), F.lit(1e-9))
    every = F.greatest(F.lit(1), F.floor(F.col("size") / CHOSEN))
    one = lambda k, v: F.struct(F.lit(k).alias("start"), *(x.cast("double").alias(f"v{i}") for i, x in enumerate(v)))
    x = [F.col(c) for c in RATES]
    chosen = [F.when(F.pmod(F.xxhash64(*RATES, F.lit(k)), every) == 0, one(k, x)) for k in (4, 5)]
    seen = F.explode(F.filter(F.array(one(0, x), one(2, [F.tanh(v) for v in z]), one(3, [v / norm for v in z]), *chosen), lambda s: s.isNotNull()))
    sums = _with_group(passed, known, few).select("g", seen.alias("s")).select("g", "s.*").groupBy("g", "start").agg(*_sums([F.col(f"v{i}") for i in range(D)]))
    plain = _estimate(sums.where("start NOT IN (2, 3)"), 1.0, floor, "g", "start")
    names = ["g", "start", *(f"m{i}" for i in range(D)), *(f"c{i}{j}" for i, j in PAIRS)]
    middle = [F.col(f"h{i}").alias(f"m{i}") for i in range(D)]
    # what tanh and directions show is how rates go together; their sizes are the quartile spreads
    sign = F.col("start") == 3
    size = lambda i: F.when(sign, F.col(f"p{i}{i}") / F.col("n")).otherwise(_covariance(i, i))
    together = lambda i, j: F.when(sign, F.col(f"p{i}{j}") / F.col("n")).otherwise(_covariance(i, j)) / F.sqrt(F.greatest(size(i), F.lit(1e-9)) * F.greatest(size(j), F.lit(1e-9)))
    cov = lambda i, j, r: (r * F.col(f"w{i}") * F.col(f"w{j}") + (floor[i] ** 2 if i == j else 0.0)).alias(f"c{i}{j}")
    shaped = sums.where("start IN (2, 3)").join(known, "g").select("g", "start", *middle, *(cov(i, j, F.lit(1.0) if i == j else together(i, j)) for i, j in PAIRS))
    apart = known.select("g", F.lit(1).alias("start"), *middle, *(cov(i, j, F.lit(float(i == j))) for i, j in PAIRS))
    return cut(_factor(plain.select(*names).union(shaped.select(*names)).union(apart.select(*names)))), few


def concentrate(passed: DataFrame, est: DataFrame, few: bool, support: float, scale: float, floor: tuple[float, ...]) -> DataFrame:
    """One step: the estimate of the nearest share of each group, for each of its lines in est."""
    lines = est.select("g", "start", *(f"m{i}" for i in range(D)), *(f"l{i}{j}" for i, j in PAIRS))
    bin_ = F.floor(F.log2(F.greatest(_distance(), F.lit(1e-9))) * BINS)
    sums = _with_group(passed, lines, few).withColumn("bin", bin_).groupBy("g", "start", "bin").agg(*_sums([F.col(c) for c in RATES]))
    along = Window.partitionBy("g", "start")
    below = F.coalesce(F.sum("n").over(along.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    near = sums.withColumn("below", below).withColumn("size", F.sum("n").over(along)).where(F.col("below") < support * F.col("size"))
    return cut(_estimate(near.groupBy("g", "start").agg(*_added()), scale, floor, "g", "start"))


def least_determinant(passed: DataFrame, support: float = SUPPORT, steps: int = STEPS, floor: tuple[float, ...] = FLOOR) -> DataFrame:
    """The estimate (g, n, m*, c*) of least determinant of each group of passed (g, x*)."""
    scale = consistency(support)
    est, few = starts(passed, floor)
    for _ in range(min(FIRST, steps)):
        est = concentrate(passed, est, few, support, scale, floor)
    order = Window.partitionBy("g").orderBy(F.round("logdet", 9), "start")
    best = cut(est.withColumn("k", F.row_number().over(order)).where("k = 1").drop("k"))
    for _ in range(steps - FIRST):
        new = concentrate(passed, best, few, support, scale, floor)
        both = best.select("g", F.col("logdet").alias("old")).join(new, "g")
        if not both.where(F.col("logdet") < F.col("old") - FALL).limit(1).count():
            break
        kept = both.where("logdet < old").drop("old")
        best = cut(kept.unionByName(best.join(kept.select("g"), "g", "left_anti")))
    return best


def shrunk(best: DataFrame, floor: tuple[float, ...], prior: float) -> DataFrame:
    """Each group's estimate after ``prior`` more rows like the subset of all."""
    rest = [(F.col(f"c{i}{j}") - (floor[i] ** 2 if i == j else 0.0)).alias(f"c{i}{j}") for i, j in PAIRS]
    bare = best.select("g", "n", *(f"m{i}" for i in range(D)), *rest)
    every = bare.where(F.col("g") == ALL).select(*(F.col(f"m{i}").alias(f"a{i}") for i in range(D)), *(F.col(f"c{i}{j}").alias(f"b{i}{j}") for i, j in PAIRS))
    both = bare.where(F.col("g") != ALL).join(F.broadcast(every))  # one line for all
    own, more = F.col("n") / (F.col("n") + prior), prior / (F.col("n") + prior)
    mean = lambda i: own * F.col(f"m{i}") + more * F.col(f"a{i}")
    covs = [(own * F.col(f"c{i}{j}") + more * F.col(f"b{i}{j}") + (floor[i] ** 2 if i == j else 0.0)).alias(f"c{i}{j}") for i, j in PAIRS]
    return _factor(both.select("g", *(mean(i).alias(f"m{i}") for i in range(D)), *covs))


def judge(counts: DataFrame, support: float = SUPPORT, steps: int = STEPS, cutoff: float = CUTOFF, floor: tuple[float, ...] = FLOOR, prior: float = PRIOR) -> DataFrame:
    """counts (see ``statistics``) with base_failed, distance2 (null if the base rule fails) and kept."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = counts.withColumn("base_failed", failed).withColumn("g", F.to_json(F.struct("lang", "source")))
    for name, x in zip(RATES, _rates(), strict=True):
        rows = rows.withColumn(name, x)
    rows = cut(rows)
    passed = rows.where(~F.col("base_failed")).select(F.explode(F.array("g", F.lit(ALL))).alias("g"), *RATES)
    best = least_determinant(passed, support, steps, floor)
    lines = cut(shrunk(best, floor, prior).select("g", *(f"m{i}" for i in range(D)), *(f"l{i}{j}" for i, j in PAIRS)))
    last = _with_group(rows, lines, lines.count() <= BROADCAST_LINES, "left").withColumn("distance2", F.when(~F.col("base_failed"), _distance()))
    return last.select(*counts.columns, "base_failed", "distance2", (~F.col("base_failed") & F.coalesce(F.col("distance2") <= cutoff, F.lit(False))).alias("kept"))

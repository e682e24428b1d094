"""Mixing sources to target weights.

Each document gets a hash-random key, a digest of its id, source, size and text; keys cut each source into ranges
of about ``rows_per_range`` documents. Sums of sizes per range, summed up along the ranges, show the range in
which a source's budget ends, and prefix sums in key order inside that range the document, so that no task ever
holds or sorts a source. A source's budget is cut exactly: every document is taken as often as whole epochs fit, and
in the last epoch, in key order, until the budget ends inside one document, of which the leading words are taken with
the white space before each.

What the mix takes of a document follows from its source's line (budget, epochs, key at the cut), so the texts
themselves are not shuffled.

Targets: sources by code point, null last, have weights in turn and share the sum of all sizes; no target
is above ``max_epochs`` times its source's size, and what is above is shared again by weight. Sources may be any
number: they are ranked and their targets found by range sorts and sums.

Cases: a null text has size 0; a null source is a source of its own; empty tables give no rows; sources
of size 0 have target 0; rows that are equal in id, source and text are alike, and where a budget ends among them,
any one of them stands for all; other columns pass through ``mix`` under any name that does not start with ``__mix_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ndspark.llm.common import SPACE, WORD, cut, shuffle_parts

WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
ROWS_PER_RANGE = 500
#: Ranges of one source; beyond ROWS_PER_RANGE times as many rows its ranges hold more rows.
MAX_RANGES = 65_536
#: Lines of sources that are broadcast; more are joined by a shuffle, over so many salts.
BROADCAST_SOURCES, SALTS = 100_000, 16
#: Rows that one row is expanded into at a time.
BLOCK = 10_000


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def _mark(doc_id: Column, source: Column, size: Column, text: Column, seed: int) -> Column:
    """The key as 32 hexadecimal digits, by a digest that other engines have too."""
    known = [F.coalesce(c.cast("string"), F.lit("")) for c in (doc_id, source, size)]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *known, F.md5(F.coalesce(text, F.lit("")).cast("binary"))).cast("binary"))


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """sources (source, n and other columns) with the target of each."""
    order = [F.col("source").isNull(), F.col("source")]
    parts = shuffle_parts(sources.sparkSession)
    placed = cut(sources.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()))
    # the upper bits of an id are its partition
    before, offsets = 0, []
    for r in sorted(placed.groupBy(F.shiftright("__at", 33).alias("p")).count().collect()):  # a row for each partition
        offsets.append((r["p"], before))
        before += r["count"]
    known = sources.sparkSession.createDataFrame(offsets, "__p long, __before long")
    rank = F.col("__before") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    most = (F.lit(float(max_epochs)) * F.col("n")).alias("__most")
    lines = cut(placed.join(F.broadcast(known), F.shiftright("__at", 33) == F.col("__p")).select(*sources.columns, weight.alias("__weight"), most))
    ratio = F.col("__most") / F.col("__weight")
    total, all_weights = lines.agg(F.sum("n"), F.sum("__weight")).first()
    share = total / all_weights if all_weights else 0.0
    while True:  # sources that the share would lift above their most leave it to the others
        full, open_ = lines.agg(F.sum(F.when(ratio < share, F.col("__most"))), F.sum(F.when(ratio >= share, F.col("__weight")))).first()
        new = (total - (full or 0.0)) / open_ if open_ else share
        if new == share:
            break
        share = new
    target = F.when(ratio < share, F.col("__most")).otherwise(F.least(F.col("__most"), F.lit(float(share)) * F.col("__weight")))
    return lines.select(*sources.columns, target.alias("target"))


def _with_source(rows: DataFrame, lines: DataFrame, source: Column, mark: Column, few: bool) -> DataFrame:
    """rows with the columns of their source's line (its key: __mix_source)."""
    same = source.eqNullSafe(F.col("__mix_source"))
    if few:
        return rows.join(F.broadcast(lines), same).drop("__mix_source")
    salted = lines.withColumn("__mix_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    own = F.pmod(F.xxhash64(mark), F.lit(SALTS)).cast("int")
    return rows.join(salted, same & (own == F.col("__mix_salt"))).drop("__mix_source", "__mix_salt")


def _lines(df: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: float = MAX_EPOCHS, rows_per_range: int = ROWS_PER_RANGE, seed: int = 17) -> tuple[DataFrame, DataFrame, bool]:
    """Rows (doc_id, source, size, mark) of df; each source's line; and whether lines are few.

    A line has source_size, target, epochs (whole ones) and, where the budget ends: edge, the mark there, edge_rows, the
    number of rows with that mark, and edge_words, what is taken of them together.
    """
    size = n_words(F.col("text"))
    sized = df.select("doc_id", "source", size.alias("size"), "text")
    rows = cut(sized.select("doc_id", "source", "size", _mark(F.col("doc_id"), F.col("source"), F.col("size"), F.col("text"), seed).alias("mark")))
    sources = rows.groupBy("source").agg(F.sum("size").alias("n"), F.count("*").alias("rows"))
    epochs = F.when(F.col("n") > 0, F.floor(F.col("target") / F.col("n"))).otherwise(0).cast("long")
    known = targets(sources, weights, max_epochs).withColumn("epochs", epochs)
    known = cut(
        known.select(
            F.col("source").alias("__mix_source"),
            F.col("n").alias("source_size"),
            "target",
            "epochs",
            (F.floor("target").cast("long") - F.col("epochs") * F.col("n")).alias("rest"),
            F.least(F.lit(MAX_RANGES), F.ceil(F.col("rows") / rows_per_range)).alias("ranges"),
        )
    )
    few = known.count() <= BROADCAST_SOURCES
    key = F.conv(F.substring("mark", 1, 13), 16, 10).cast("bigint")
    at = F.floor(key.cast("double") / float(1 << 52) * F.col("ranges"))
    placed = _with_source(rows, known.select("__mix_source", "rest", "ranges"), F.col("source"), F.col("mark"), few).withColumn("range", at)
    along = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy("source", "range", "rest").agg(F.sum("size").alias("n")).withColumn("offset", F.coalesce(F.sum("n").over(along), F.lit(0)))
    ends = sums.where("offset <= rest AND rest < offset + n")
    ends = cut(ends.select(F.col("source").alias("__mix_source"), F.col("range").alias("end"), (F.col("rest") - F.col("offset")).alias("left")))
    last = _with_source(placed.select("source", "range", "mark", "size"), ends, F.col("source"), F.col("mark"), few).where(F.col("range") == F.col("end"))
    alike = last.groupBy("source", "mark", "left").agg(F.count("*").alias("rows"), F.max("size").alias("size"))
    inside = Window.partitionBy("source").orderBy("mark").rowsBetween(Window.unboundedPreceding, -1)
    summed = alike.withColumn("before", F.coalesce(F.sum(F.col("size") * F.col("rows")).over(inside), F.lit(0)))
    edges = summed.where("before <= left AND left < before + size * rows")
    edges = edges.select(F.col("source").alias("s"), F.col("mark").alias("edge"), F.col("rows").alias("edge_rows"), (F.col("left") - F.col("before")).alias("edge_words"))
    lines = known.join(edges, F.col("__mix_source").eqNullSafe(F.col("s")), "left")
    return rows, cut(lines.select("__mix_source", "source_size", "target", "epochs", "edge", "edge_rows", "edge_words")), few


def _part(size: Column, mark: Column) -> Column:
    """Words that the last epoch takes of a row; null where it is one of several rows at the edge."""
    alone = F.when(F.col("edge_rows") == 1, F.col("edge_words"))
    return F.when(F.col("edge").isNull() | (mark > F.col("edge")), F.lit(0)).when(mark < F.col("edge"), size).otherwise(alone)


def _blocks(n: Column) -> Column:
    """Rows (from, until) of at most BLOCK numbers that make up 0 to n - 1."""
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(n - 1, F.lit(0)), F.lit(BLOCK).cast("long"))
    return F.explode(F.transform(F.when(n > 0, starts).otherwise(F.array().cast("array<bigint>")), lambda k: F.struct(k.alias("from"), F.least(k + BLOCK, n).alias("until"))))


def plan(df: DataFrame, **settings) -> DataFrame:
    """doc_id, source, size, source_size, target, epochs (whole ones), part, taken (words) of every row of df.

    Settings: weights, max_epochs, rows_per_range, seed.
    """
    rows, lines, few = _lines(df, **settings)
    joined = _with_source(rows, lines, F.col("source"), F.col("mark"), few).withColumn("part", _part(F.col("size"), F.col("mark")))
    names = ["doc_id", "source", "size", "source_size", "target", "epochs", "part"]
    alike = joined.where("part IS NULL").groupBy("source", "mark").agg(*(F.any_value(c).alias(c) for c in ("doc_id", "size", "source_size", "target", "epochs", "edge_rows", "edge_words")))
    each = alike.withColumn("block", _blocks(F.col("edge_rows"))).withColumn("k", F.explode(F.sequence("block.from", F.col("block.until") - 1)))
    each = each.withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), F.col("edge_words") - F.col("k") * F.col("size"))))
    both = joined.where("part IS NOT NULL").select(*names).union(each.select(*names))
    return both.withColumn("taken", F.col("epochs") * F.col("size") + F.col("part"))


def leading_words(text: Column, n: Column) -> Column:
    """A text up to the end of its n-th word, with its own white space."""
    # what lies before each word, and one more piece after the last
    spaces = F.slice(F.split(text, WORD), F.lit(1), n)
    words = F.slice(F.filter(F.split(text, SPACE), lambda w: w != ""), F.lit(1), n)
    head = F.array_join(F.zip_with(spaces, words, lambda s, w: F.concat(s, w)), "")
    return F.when(n > 0, head).otherwise(F.lit(""))


def _copies(text: Column, whole: Column, part: Column, size: Column) -> Column:
    """A text so many times, and once more its leading words."""
    last = (
        F.when((part == size) & (size > 0), F.array(text))
        .when(part > 0, F.array(leading_words(text, part.cast("int"))))
        .otherwise(F.array().cast("array<string>"))
    )
    return F.concat(F.array_repeat(text, whole.cast("int")), last)


def mix(df: DataFrame, seed: int = 17, **settings) -> DataFrame:
    """The mix itself: the rows of df, each as often as it is taken, the document at a budget's end cut short."""
    _, lines, few = _lines(df, seed=seed, **settings)
    sized = df.withColumn("__mix_size", n_words(F.col("text")))
    marked = sized.withColumn("__mix_mark", _mark(F.col("doc_id"), F.col("source"), F.col("__mix_size"), F.col("text"), seed))
    kept = ("epochs", "edge", "edge_rows", "edge_words")
    own = lines.select("__mix_source", *(F.col(c).alias(f"__mix_{c}") for c in kept))
    joined = _with_source(marked, own, F.col("source"), F.col("__mix_mark"), few)
    size, mark = F.col("__mix_size"), F.col("__mix_mark")
    at_edge = mark == F.col("__mix_edge")
    alone = F.when(F.col("__mix_edge_rows") == 1, F.col("__mix_edge_words")).otherwise(0)
    part = F.when(F.col("__mix_edge").isNull() | (mark > F.col("__mix_edge")), F.lit(0)).when(at_edge, alone).otherwise(size)
    # a text of no words belongs to no budget
    whole = F.when(size > 0, F.col("__mix_epochs")).otherwise(0)
    out = joined.withColumn("text", F.explode(_copies(F.col("text"), whole, part, size))).select(*df.columns)
    if not lines.where("edge_rows > 1").limit(1).count():
        return out
    one = joined.where(at_edge & (F.col("__mix_edge_rows") > 1)).groupBy("__mix_mark", "__mix_size", "__mix_edge_words").agg(*(F.any_value(c).alias(c) for c in df.columns))
    times = F.floor(F.col("__mix_edge_words") / size).cast("long")
    blocks = one.withColumn("__mix_block", _blocks(times + 1)).repartition(shuffle_parts(df.sparkSession))
    each = blocks.withColumn("__mix_k", F.explode(F.sequence("__mix_block.from", F.col("__mix_block.until") - 1)))
    left = F.when(F.col("__mix_k") < times, size).otherwise(F.col("__mix_edge_words") - times * size)
    return out.union(each.withColumn("text", F.explode(_copies(F.col("text"), F.lit(0), left, size))).select(*df.columns))

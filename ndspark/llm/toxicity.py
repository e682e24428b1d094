"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features of a text: densities of two lexicons, plain and obfuscated, hits near a second-person word,
capitals, punctuation and obfuscation rates. The lexicons are learned from the labelled sample: words by how
many different words precede them in documents of either label (so that copies of one text do not make its
words toxic); those far more frequent under label 1 are strong, the others weak. Lexicons are learned and trees
boosted on seven tenths of the sample, and the isotonic fit of the rest, of which neither has seen anything, turns
their margins into probabilities.

The sample holds at most ``SAMPLE`` labelled documents (by the order of a hash), and both lexicons together
``LEXICON`` words, those with the most different words before them; both are parameters of ``fit``. Features and
scores are computed over whole texts of all rows.

Cases: a null or empty text has all features 0 and gets a score like any other; texts and words may have any
length; without labels of both kinds the score is the share of ones (0 without labels); of labelled rows that share
an id one is learned from; rows that repeat get equal scores; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ndspark.llm.common import Remembered, fold, ship, tidy
from ndspark.llm.sample import labelled_sample
from ndspark.llm.trees import Boosted, boost, isotonic, sigmoid

SAMPLE = 12_000
LEXICON = 300
#: Word pairs that a task holds at a time.
PAIRS = 200_000
#: Second-person words of four languages.
SECOND_PERSON = "you your yours yourself u ur du dich dir dein deine deiner ihr euch euer sie tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros os vuestro"
_LEET = str.maketrans("0134578@$!|", "oieastbasil")
STRONG, WEAK, HIDDEN, SECOND, CAPS, MIXED, SHOUT, LONG = (1 << k for k in range(8))
FEATURES = ("log_words", "strong", "weak", "hidden", "strong_count", "hit_count", "near_second", "second", "caps_words", "mixed", "shout", "stretched", "capitals", "punctuation")
_ALNUM = re.compile(r"[^\W_]")
_INNER = re.compile(r"[\W_]+")
_STRETCH = re.compile(r"(.)\1\1+")
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PUNCTUATION = b"!?.,;:-_()[]{}'\"*#&%$@/\\|<>~^+="


def bare(word: str) -> str:
    """A word without what is neither letter nor digit on either side."""
    first = _ALNUM.search(word)
    if not first:
        return ""
    end = len(word)
    while not word[end - 1].isalnum():
        end -= 1
    return word[first.start() : end]


class _Codes(Remembered):
    """Bits of each token; frequent tokens are remembered."""

    def __init__(self, strong: set[str], weak: set[str]) -> None:
        super().__init__(self.code, 120_000)
        self.strong, self.weak, self.second = strong, weak, set(SECOND_PERSON.split())

    def code(self, token: bytes) -> int:
        text = token.decode("utf-8", "replace")
        word = bare(text)
        low = word.lower()
        code = (low in self.strong) * STRONG | (low in self.weak) * WEAK | (low in self.second) * SECOND
        plain = _INNER.sub("", bare(text.lower()).translate(_LEET))
        if low != plain or _STRETCH.search(low):
            for form in (plain, _STRETCH.sub(r"\1", plain), _STRETCH.sub(r"\1\1", plain)):
                if form in self.strong and not code & STRONG:
                    code |= HIDDEN
            code |= MIXED * bool(low != plain and any(c.isalpha() for c in low))
        code |= CAPS * (len(word) > 1 and word.isupper()) | SHOUT * text.endswith("!") | LONG * bool(_STRETCH.search(low))
        return code


def features(text: bytes | None, codes: dict[bytes, int]) -> list[float]:
    data = text or b""
    tokens = data.split()
    n = len(tokens)
    if not n:
        return [0.0] * len(FEATURES)
    bits = np.fromiter(map(codes.__getitem__, tokens), np.int16, n)
    hits = np.flatnonzero(bits & (STRONG | HIDDEN))
    second = np.flatnonzero(bits & SECOND)
    near = 0
    if len(hits) and len(second):
        at = np.searchsorted(second, hits)
        before = hits - second[np.maximum(at - 1, 0)]
        after = second[np.minimum(at, len(second) - 1)] - hits
        near = int(((np.abs(before) <= 4) | (np.abs(after) <= 4)).sum())
    count = lambda bit: float(np.count_nonzero(bits & bit))
    size = len(data)
    return [
        float(np.log1p(n)),
        count(STRONG) / n,
        count(WEAK) / n,
        count(HIDDEN) / n,
        min(count(STRONG), 20.0),
        min(float(len(hits)), 20.0),
        near / n,
        len(second) / n,
        count(CAPS) / n,
        count(MIXED) / n,
        count(SHOUT) / n,
        count(LONG) / n,
        (size - len(data.translate(None, _UPPER))) / size,
        (size - len(data.translate(None, _PUNCTUATION))) / size,
    ]


@dataclass
class Model:
    strong: set[str]
    weak: set[str]
    trees: Boosted | None
    knots: tuple[np.ndarray, np.ndarray]

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(x), self.knots[1][0])
        return np.clip(np.interp(self.trees.margin(x), *self.knots), 0, 1)


def _word_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (y, text): label, bare word, and a digest of the word and the one before; each once per ``PAIRS`` or so."""

    def rows() -> pa.RecordBatch:
        y, word, pair = zip(*seen, strict=True) if seen else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(y, pa.float64()), pa.array(word, pa.string()), pa.array(pair, pa.int64())], ["y", "word", "pair"])

    low = Remembered(lambda w: bare(w.decode("utf-8", "replace").lower()), 120_000)
    seen: set[tuple[float, str, int]] = set()
    for batch in batches:
        for y, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
            words = [low[t] for t in (text or b"").split()]
            seen.update((y, w, xxhash.xxh64_intdigest(f"{v} {w}") - (1 << 63)) for v, w in set(zip(["", *words], words)) if w)  # noqa: B905  one shorter
            if len(seen) > PAIRS:
                yield rows()
                seen.clear()
    yield rows()


def lexicons(sample: DataFrame, size: int = LEXICON) -> tuple[set[str], set[str]]:
    """Strong and weak words of a sample (doc_id, text, y)."""
    ship(sample.sparkSession)
    totals = dict(sample.groupBy("y").count().collect())
    one, zero = totals.get(1.0, 0), totals.get(0.0, 0)
    if not one or not zero:
        return set(), set()
    seen = sample.select("y", "text").mapInArrow(tidy("toxicity", _word_pairs), "y double, word string, pair long").distinct()
    by_word = seen.groupBy("word").agg(F.count_if(F.col("y") == 1).alias("a"), F.count_if(F.col("y") == 0).alias("b"))
    ratio = ((F.col("a") + 0.5) / (one + 1)) / ((F.col("b") + 0.5) / (zero + 1))
    top = by_word.where((F.col("a") >= max(3, one // 100)) & (ratio >= 4)).select("word", ratio.alias("ratio"), "a").orderBy(F.desc("a"), "word").limit(size).collect()
    return {r["word"] for r in top if r["ratio"] >= 15}, {r["word"] for r in top if r["ratio"] < 15}


def _features(strong: set[str], weak: set[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _Codes(strong, weak)
        for batch in batches:
            x = [features(t, codes) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], ["y", "x"])

    return run


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE, lexicon: int = LEXICON) -> Model:
    ship(docs.sparkSession)
    part = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(10)).alias("part")
    sample = labelled_sample(docs, labels, "toxic", rows).select("doc_id", "text", "y", part)
    strong, weak = lexicons(sample.where("part < 7"), lexicon)
    data = sample.select(F.struct("y", "part", "doc_id").alias("y"), "text").mapInArrow(tidy("toxicity", _features(strong, weak)), "y struct<y: double, part: long, doc_id: long>, x array<double>").collect()
    data.sort(key=lambda r: r["y"]["doc_id"])  # at most ``rows`` rows of numbers
    y = np.array([r["y"]["y"] for r in data])
    if len(set(y.tolist())) < 2:
        return Model(strong, weak, None, (np.zeros(1), np.array([y.mean() if len(y) else 0.0])))
    x, part = np.array([r["x"] for r in data]), np.array([r["y"]["part"] for r in data])
    learn = part < 7
    if min((y[learn] == k).sum() for k in (0, 1)) == 0 or min((y[~learn] == k).sum() for k in (0, 1)) == 0:
        trees = boost(x, y, rounds=30, least=3)
        return Model(strong, weak, trees, (np.linspace(-6, 6, 61), sigmoid(np.linspace(-6, 6, 61))))
    trees = boost(x[learn], y[learn])
    return Model(strong, weak, trees, isotonic(trees.margin(x[~learn]), y[~learn]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score of every row of docs."""
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        codes = _Codes(model.strong, model.weak)
        for batch in batches:
            x = np.array([features(t, codes) for t in batch.column(1).cast(pa.binary()).to_pylist()]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(x), pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy("toxicity", run), "doc_id long, score double")


def judge(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, rows: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs."""
    scored = score(docs, fit(docs, labels, rows))
    return scored.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, rows: int = SAMPLE) -> DataFrame:
    """The rows of docs, all columns, whose text scores below the threshold."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(fit(docs, labels, rows))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        codes = _Codes(model.strong, model.weak)
        for batch in batches:
            x = np.array([features(t, codes) for t in batch.column(at).cast(pa.binary()).to_pylist()]).reshape(-1, len(FEATURES))
            yield batch.filter(pa.array(model.scores(x) < threshold))

    return docs.mapInArrow(tidy("toxicity", run), docs.schema)

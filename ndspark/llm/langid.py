"""Language identification by hyperdimensional profiles.

Every letter has a random vector of ``DIMENSIONS`` signs. A trigram's vector binds (multiplies) the letters'
vectors, permuted once for each place; a document's bundles (adds) the vectors of its trigrams; a
language's prototype bundles its documents, each scaled to length one. The prediction is the language whose
prototype has the largest cosine with the document.

Letters are lower-cased; all that lies between them is one space. Prototypes are learned from at most
``PER_LANGUAGE`` documents of each language (by the order of a hash); whole texts of all rows are predicted, in
blocks of ``BLOCK`` characters.

Cases: a text that is null or has no letter is ``und`` with score 0; a null language is not learned; of rows
that share id and language the least text is learned; rows that repeat get equal predictions; without any language
to learn everything is ``und``; ties go to the language that sorts first; more than ``MAX_LANGUAGES`` languages to
learn raise before anything is learned; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ndspark.llm.common import cut, fold, ship

DIMENSIONS = 1024
PER_LANGUAGE = 600
#: Prototypes (4 kB each) go to every worker, so they are bounded; a corpus with more needs a coarser lang column.
MAX_LANGUAGES = 20_000
#: Characters that are looked at together.
BLOCK = 500_000
#: Ids of learned documents that are broadcast; more are joined by a shuffle.
BROADCAST_IDS = 200_000
#: Letters share vectors beyond so many, by their code point.
SYMBOLS = 4096
_tables: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    """For each code point 0 if it is no letter, else the number of its vector."""
    if "letters" not in _tables:
        code = np.arange(sys.maxunicode + 1)
        letter = np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
        _tables["letters"] = np.where(letter, code % (SYMBOLS - 1) + 1, 0).astype(np.int64)
    return _tables["letters"]


def _vectors() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The letters' vectors, for the last, middle and first place of a trigram."""
    if "signs" not in _tables:
        signs = (np.random.default_rng(8).integers(0, 2, size=(SYMBOLS, DIMENSIONS), dtype=np.int8) * 2 - 1).astype(np.int8)
        _tables["signs"], _tables["once"], _tables["twice"] = signs, np.roll(signs, 1, 1), np.roll(signs, 2, 1)
    return _tables["signs"], _tables["once"], _tables["twice"]


def bundle(text: str | None) -> np.ndarray | None:
    """The text's vector, scaled to length one; None without a letter."""
    text = text or ""
    last, once, twice = _vectors()
    out = np.zeros(DIMENSIONS, np.float32)
    some, tail = False, np.zeros(1, np.int64)
    for start in range(0, len(text), BLOCK):
        symbols = _letters()[np.frombuffer(text[start : start + BLOCK].lower().encode("utf-32-le", "surrogatepass"), np.uint32)]
        some = some or bool(symbols.any())
        symbols = np.r_[tail, symbols, np.zeros(int(start + BLOCK >= len(text)), np.int64)]
        symbols = symbols[np.r_[True, (symbols[1:] > 0) | (symbols[:-1] > 0)]]
        tail = symbols[-2:]
        codes, counts = np.unique((symbols[:-2] * SYMBOLS + symbols[1:-1]) * SYMBOLS + symbols[2:], return_counts=True)
        for at in range(0, len(codes), 2048):
            c = codes[at : at + 2048]
            bound = twice[c // (SYMBOLS * SYMBOLS)] * once[c // SYMBOLS % SYMBOLS] * last[c % SYMBOLS]
            out += counts[at : at + 2048].astype(np.float32) @ bound.astype(np.float32)
    return out / max(float(np.linalg.norm(out)), 1e-9) if some else None


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (lang, text): the sum of each language's vectors, in whole numbers, so that their order doesn't matter."""
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if (v := bundle(text)) is not None:
                total[lang] = total.get(lang, 0) + np.rint(v.astype(np.float64) * 2.0**40).astype(np.int64)
    rows = [(v / max(np.linalg.norm(v), 1e-9)).astype(np.float32).tolist() for v in (t.astype(np.float64) for t in total.values())]
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(rows, pa.list_(pa.float32()))], ["lang", "v"])


def learned(docs: DataFrame, able: Column, per_language: int = PER_LANGUAGE) -> DataFrame:
    """doc_id, lang, text of at most per_language documents of each language of the rows that able holds for."""
    rows = docs.where(able & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    ids = rows.select("doc_id", "lang")
    sizes = cut(ids.groupBy("lang").agg(F.approx_count_distinct("doc_id", 0.02).alias("n")))
    if sizes.count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    # of a large language only the part with the least hashes is ordered, about twice what is needed
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) / float(1 << 32)
    near = ids.join(F.broadcast(sizes), "lang").where(share * F.col("n") <= 2 * per_language + 50).select("doc_id", "lang").distinct()
    order = Window.partitionBy("lang").orderBy(share, "doc_id")
    chosen = cut(near.withColumn("k", F.row_number().over(order)).where(F.col("k") <= per_language).select("doc_id", "lang"))
    few = chosen.count() <= BROADCAST_IDS
    found = rows.select("doc_id", "lang", "text").join(F.broadcast(chosen) if few else chosen, ["doc_id", "lang"])
    return found.groupBy("doc_id", "lang").agg(F.min("text").alias("text"))


def prototypes(docs: DataFrame, able: Column, per_language: int = PER_LANGUAGE) -> dict[str, np.ndarray]:
    """Vector of each language of the documents that able holds for."""
    ship(docs.sparkSession)
    texts = learned(docs, able, per_language).select("lang", "text").repartition("lang")
    # a row for each language, of which there are MAX_LANGUAGES at most
    return {r["lang"]: np.array(r["v"], np.float32) for r in sorted(texts.mapInArrow(_sums, "lang string, v array<float>").collect(), key=lambda r: r["lang"])}


def predict(docs: DataFrame, profiles: dict[str, np.ndarray]) -> DataFrame:
    """doc_id, lang_pred, score (the cosine, at least 0) of every row of docs."""
    spark = docs.sparkSession
    ship(spark)
    names = list(profiles)
    sent = spark.sparkContext.broadcast(np.stack([profiles[k] for k in names]).astype(np.float32) if names else np.zeros((0, DIMENSIONS), np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix = sent.value
        for batch in batches:
            langs, scores = [], []
            for text in batch.column(1).to_pylist():
                v = bundle(text) if len(matrix) else None
                cosines = None if v is None else matrix @ v
                langs.append("und" if cosines is None else names[int(cosines.argmax())])
                scores.append(0.0 if cosines is None else float(min(1.0, max(0.0, cosines.max()))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def judge(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of docs (doc_id, text, lang)."""
    found = predict(docs, prototypes(docs, fold(F.col("doc_id"), 5) != 0, per_language))
    return found.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score")

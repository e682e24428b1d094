"""Long texts, repeated ids, many sources and languages, and brute force where SQL has no answer."""

import random
import re

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from ndspark.llm import bpe, common, langid, mixing, outliers, rules, setsketch, spotsigs, toxicity, url_filter
from ndspark.llm.queries import QUERIES, URL_RULES, VOCABULARY
from ndspark.llm.sample import labelled_sample

DATA = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def theirs():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(VOCABULARY), special_tokens={})


@pytest.mark.parametrize(
    "text",
    ["ab" * 50_000, "a" * 100_001, "—" * 5_000, "abcde" * 700, "hahah" * 600, "".join(chr(0x4E00 + k * 7919 % 3000) for k in range(20_000)), "".join(random.Random(1).choice("etaoinshrdlu") for _ in range(60_000))],
    ids=["ab", "a", "dash", "five", "hahah", "chinese", "letters"],
)
def test_bpe_of_long_pieces(theirs, text):
    coder = bpe._coder("tests", bpe.read_ranks(VOCABULARY), public_tokenizers.PATTERN)
    ((ids, decoded),) = coder.encode([text])
    assert np.frombuffer(ids, "<u4").tolist() == theirs.encode_ordinary(text) and decoded == text.encode()


def test_bpe_digests_are_those_of_tiktoken(spark, theirs):
    import hashlib

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()}
    out = QUERIES["op6_byte_bpe"](spark, DATA).collect()
    assert len(out) == len(texts)
    for r in out:
        ids = theirs.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_bpe_takes_a_long_text_in_parts(theirs, monkeypatch):
    for name, value in (("CHARACTERS", 50), ("PIECES", 7), ("IDS", 11), ("REMEMBERED", 500)):
        monkeypatch.setattr(bpe, name, value)
    coder = bpe.Coder(bpe.read_ranks(VOCABULARY), public_tokenizers.PATTERN)
    texts = ["", "one two  three\n\n" * 40, "x", "zwölf Boxkämpfer " * 9, ""]
    assert [(np.frombuffer(i, "<u4").tolist(), d) for i, d in coder.encode(texts)] == [(theirs.encode_ordinary(t), t.encode()) for t in texts]


def test_bpe_remembers_pieces_that_come_again(theirs, monkeypatch):
    for name, value in (("CHARACTERS", 200), ("REMEMBERED", 4_000)):
        monkeypatch.setattr(bpe, name, value)
    coder = bpe.Coder(bpe.read_ranks(VOCABULARY), public_tokenizers.PATTERN)
    contracted, some = [], coder._some
    monkeypatch.setattr(coder, "_some", lambda pieces: contracted.extend(pieces) or some(pieces))
    random_word = random.Random(5)
    texts = [" Zwöxqlf" + "".join(" " + "".join(random_word.choices("qxzjvkw", k=9)) for _ in range(12)) for _ in range(40)]
    assert [np.frombuffer(i, "<u4").tolist() for i, _ in coder.encode(texts)] == [theirs.encode_ordinary(t) for t in texts]
    assert contracted.count(" Zwöxqlf".encode()) == 1 and len(coder.known) + len(coder.older) < 100


def test_bpe_contracts_short_pieces_in_one_recursion(theirs, monkeypatch):
    # 8,000 pieces of 14 bytes have at most 840,000 rows over all steps
    coder = bpe.Coder(bpe.read_ranks(VOCABULARY), public_tokenizers.PATTERN)
    letters = random.Random(6)
    pieces = ["".join(letters.choices("etaoinshrdlu", k=14)) for _ in range(8_000)]
    asked = []

    class Counted:
        db = coder.db

        def execute(self, sql):
            asked.append(sql)
            return self.db.execute(sql)

        def __getattr__(self, name):
            return getattr(self.db, name)

    monkeypatch.setattr(coder, "db", Counted())
    assert [i.tolist() for i in coder._contract([p.encode() for p in pieces])] == [theirs.encode_ordinary(p) for p in pieces]
    assert sum("RECURSIVE" in sql for sql in asked) == 1


def test_bpe_begins_with_merges_that_are_bound_to_come(theirs):
    coder = bpe.Coder(bpe.read_ranks(VOCABULARY), public_tokenizers.PATTERN)
    syllables = random.Random(7)
    pieces = [" " + "".join(syllables.choices(["th", "er", "on", "and", "tion", "ing", "bl", "ea"], k=4)) for _ in range(2_000)]
    assert len(coder._begun([p.encode() for p in pieces])[2]) < 0.75 * sum(map(len, pieces))
    assert [i.tolist() for i in coder._contract([p.encode() for p in pieces])] == [theirs.encode_ordinary(p) for p in pieces]


def test_bpe_of_ranks_in_any_order():
    # a token may rank below its parts, or have none that make it
    merged = 0
    for seed in range(8):
        letters, order = "abcdef"[: 3 + seed % 4], random.Random(seed)
        tokens = list(dict.fromkeys("".join(order.choices(letters, k=order.randint(2, 6))).encode() for _ in range(60)))
        ranks = {t: k for k, t in enumerate([*(bytes([b]) for b in range(256)), *tokens])}
        theirs = tiktoken.Encoding("any", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        coder = bpe.Coder(ranks, public_tokenizers.PATTERN)
        pieces = ["".join(order.choices(letters, k=order.randint(2, 20))) for _ in range(2_000)]
        pieces = [p for p in pieces if p.encode() not in ranks]  # whole tokens are looked up, not contracted
        merged += sum(map(len, pieces)) - len(coder._begun([p.encode() for p in pieces])[2])
        assert [i.tolist() for i in coder._contract([p.encode() for p in pieces])] == [theirs.encode_ordinary(p) for p in pieces]
    assert merged > 1_000


def test_bpe_cuts_texts_alike_by_both_engines():
    pattern, plain = regex.compile(public_tokenizers.PATTERN), bpe.plain_pattern(public_tokenizers.PATTERN)
    every = [chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000]
    order = random.Random(8)
    order.shuffle(every)
    mixed = "".join(order.choices([*"  \n\t\x1c\x85\u2028a9É'sve.!", "'ll", "中", "٣"], k=50_000))
    for text in (mixed, "".join(every), " ".join(every), "a".join(every)):
        assert plain.findall(text) == pattern.findall(text)
    for other in (r"\p{Lu}+", r"(?i:a)\p{L}", r"[]\s]", r"[a[b]]", r"\w+", r"[\S]", r"a{e<=1}"):
        assert bpe.plain_pattern(other) is None
    assert bpe.plain_pattern(r"[^\s\p{L}]{1,3}|\S").findall("12345a b") == ["123", "45", "a", "b"]


def test_bpe_of_texts_above_u_ffff(theirs):
    coder = bpe.Coder(bpe.read_ranks(VOCABULARY), public_tokenizers.PATTERN)
    texts = ["𝒜𝒷 𝟘𝟙 😀😀 x", "a\u2028 b\x1c\x1d c", "ß 𐐀's 12"]
    assert [np.frombuffer(i, "<u4").tolist() for i, _ in coder.encode(texts)] == [theirs.encode_ordinary(t) for t in texts]


def test_workers_forget_other_operators(monkeypatch):
    monkeypatch.setattr(bpe, "_coders", {})
    monkeypatch.setattr(common, "_memory", {})
    ranks = bpe.read_ranks(VOCABULARY)

    def encodes(batches):
        for _ in batches:
            yield bpe._coder("own", ranks, public_tokenizers.PATTERN)

    (first,), (again,) = (list(common.tidy("bpe", encodes, bpe.forget)(iter([1]))) for _ in range(2))
    assert first is again and len(bpe._coders) == 1
    list(common.tidy("setsketch", lambda batches: map(setsketch._hashes.__getitem__, batches), setsketch._forget)(iter([b"word"])))
    assert not bpe._coders and setsketch._hashes
    list(common.tidy("toxicity", iter)(iter([])))
    assert not setsketch._hashes and not common._memory


def test_sample_is_bounded_by_rows(spark):
    docs = spark.createDataFrame([(k % 7, f"text {k}") for k in range(700)], "doc_id long, text string")
    labels = spark.createDataFrame([(k % 7, k % 2) for k in range(70)], "doc_id long, toxic int")
    assert labelled_sample(docs, labels, "toxic", 3, F.lit(True)).count() == 3
    assert labelled_sample(docs, labels, "toxic", 100, F.lit(True)).count() == 7


def test_long_texts_everywhere(spark):
    long = [(1, "x" * 2_000_000, "en", "s", 1), (2, "#" * 300_000 + "a" + "#" * 300_000, "en", "s", 1), (3, "you idiot " * 100_000, "en", "s", 1), (4, "word\n" * 50_000, "en", None, 1)]
    docs = spark.createDataFrame(long, DOCS)
    labels = spark.createDataFrame([(k, k % 2, k % 2) for k in range(1, 5)], "doc_id long, toxic int, quality int")
    assert toxicity.judge(docs, labels.select("doc_id", "toxic")).count() == 4
    assert rules.judge(docs, labels.select("doc_id", "quality")).count() == 4
    assert langid.judge(docs).count() == 4 and spotsigs.fingerprint_edits(docs).count() == 4
    assert sum(r.taken for r in mixing.plan(docs).collect()) > 0 and outliers.judge(outliers.statistics(docs)).count() == 4
    assert {r.doc_id: r.n_shingles for r in setsketch.near_duplicates(docs, shingle=2).collect()} == {1: 1, 2: 1, 3: 2, 4: 1}


def test_long_urls(spark):
    urls = [(1, "http://" + "a." * 100_000 + "example.org/es/" + "p" * 100_000), (2, "http://" + "." * 100_000 + "/x")]
    got = {r.page_id: r.rule for r in url_filter.judge_urls(spark.createDataFrame(urls, "page_id long, url string"), URL_RULES).collect()}
    assert got == {1: "example.org/es/", 2: None}
    assert url_filter.suffixes("a.b.c", 3) == ["b.c", "c"] and url_filter.suffixes("a.b.c", 5) == ["a.b.c", "b.c", "c"]
    with pytest.raises(ValueError, match="bytes"):
        url_filter.judge_urls(spark.createDataFrame(urls, "page_id long, url string"), URL_RULES, max_bytes=10)


def test_many_sources_and_equal_rows(spark):
    """More sources than are broadcast, one that holds most rows, and rows that repeat where a budget ends."""
    with pytest.MonkeyPatch.context() as m:
        m.setattr(mixing, "BROADCAST_SOURCES", 5)
        rows = [(k, "w " * (k % 5), "en", f"s{k}", 1) for k in range(300)] + [(None, "a b c", "en", "hot", 1)] * 200 + [(k, "a b c", "en", None, 1) for k in range(50)]
        df = spark.createDataFrame(rows, DOCS)
        plan = mixing.plan(df).collect()
        assert len(plan) == len(rows) and all(r.taken <= 3 * r["size"] for r in plan)
        by = {}
        for r in plan:
            by.setdefault(r.source, [0, r.target])[0] += r.taken
        assert all(abs(taken - target) <= 1 for taken, target in by.values())
        mixed = mixing.mix(df)
        assert sum(r.n for r in mixed.select(mixing.n_words(F.col("text")).alias("n")).collect()) == sum(r.taken for r in plan)


def test_many_languages(spark):
    names = [f"l{k:04d}" for k in range(3000)]
    rows = [(k, " ".join("".join(chr(0x4E00 + (k * 31 + i * 7 + j) % 5000) for j in range(4)) for i in range(6)), names[k]) for k in range(3000)]
    profiles = langid.prototypes(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    assert list(profiles) == names


def test_language_against_all_cosines(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    taught = langid.learned(docs, F.col("doc_id") % 2 == 0, 20).collect()
    want = {}
    for r in taught:
        if (v := langid.bundle(r.text)) is not None:
            want.setdefault(r.lang, []).append(v)
    assert all(len(v) <= 20 for v in want.values())
    names = sorted(want)
    matrix = np.stack([np.sum(want[k], 0) / np.linalg.norm(np.sum(want[k], 0)) for k in names])
    got = {r.doc_id: r for r in langid.predict(docs, langid.prototypes(docs, F.col("doc_id") % 2 == 0, 20)).collect()}
    for r in docs.collect():
        if (v := langid.bundle(r.text)) is not None:
            cosines = matrix @ v
            assert abs(got[r.doc_id].score - max(0, cosines.max())) < 1e-4 and cosines[names.index(got[r.doc_id].lang_pred)] > cosines.max() - 1e-4


def test_language_blocks(monkeypatch):
    text = "The cat, the dog -- and 3 birds. " * 40
    whole = langid.bundle(text)
    monkeypatch.setattr(langid, "BLOCK", 17)
    assert np.allclose(langid.bundle(text), whole, atol=1e-6)


def test_minimum_covariance_determinant(spark):
    """The search's estimate against NumPy: its covariance is that of its own nearest share, and no random start finds a smaller determinant."""
    rnd = np.random.default_rng(3)
    floor, support = outliers.FLOOR, outliers.SUPPORT
    scale = outliers.consistency(support)
    groups = {"a": (rnd.normal(size=(200, 4)) * [1, 2, 0.5, 1], rnd.normal(size=(50, 4)) * 0.1 + 8), "b": (rnd.normal(size=(90, 4)) * 0.5 + 3, rnd.normal(size=(0, 4)))}
    x = {g: np.vstack(both) for g, both in groups.items()}
    df = spark.createDataFrame([(g, *map(float, v)) for g, m in x.items() for v in m], "g string, x0 double, x1 double, x2 double, x3 double")
    best = {r.g: r for r in outliers.least_determinant(df).collect()}

    def moments(rows):
        return rows.mean(0), np.cov(rows.T, bias=True) * scale + np.diag(np.square(floor))

    def step(m, mean, cov):
        d = np.einsum("ij,jk,ik->i", m - mean, np.linalg.inv(cov), m - mean)
        bins = np.floor(np.log2(np.maximum(d, 1e-9)) * outliers.BINS)
        edge = np.sort(bins)[int(np.ceil(support * len(m))) - 1]
        return m[bins <= edge]

    for g, m in x.items():
        r = best[g]
        mean = np.array([r[f"m{i}"] for i in range(4)])
        cov = np.array([[r[f"c{max(i, j)}{min(i, j)}"] for j in range(4)] for i in range(4)])
        again = moments(step(m, mean, cov))
        assert np.linalg.slogdet(cov)[1] - np.linalg.slogdet(again[1])[1] < 1e-2 and abs(r.logdet - np.linalg.slogdet(cov)[1]) < 1e-6
        least = np.inf
        for _ in range(200):
            now = moments(m[rnd.choice(len(m), 12, replace=False)])
            for _ in range(15):
                now = moments(step(m, *now))
            least = min(least, np.linalg.slogdet(now[1])[1])
        assert r.logdet < least + 0.05
    assert abs(outliers.consistency(0.75) - 1.4864) < 1e-3 and outliers.consistency(1.0) == 1.0
    assert np.linalg.norm([best["a"][f"m{i}"] for i in range(4)]) < 1  # not drawn to the fifth that lies apart


def test_distances_of_groups(spark):
    """Distances of all rows from the shrunk estimates, by NumPy."""
    rnd = random.Random(4)
    docs = [(k, " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 8))) for _ in range(80)), ("en", "de", "fr")[k % 10 // 4], "s", 1) for k in range(150)]
    counts = outliers.statistics(spark.createDataFrame(docs, DOCS))
    rows = counts.select("doc_id", F.to_json(F.struct("lang", "source")).alias("g"), *(x.alias(n) for n, x in zip(outliers.RATES, outliers._rates(), strict=True)))
    best = {r.g: r for r in outliers.least_determinant(rows.select(F.explode(F.array("g", F.lit(""))).alias("g"), *outliers.RATES)).collect()}
    got = {r.doc_id: r.distance2 for r in outliers.judge(counts).collect()}
    cov = lambda r: np.array([[r[f"c{max(i, j)}{min(i, j)}"] for j in range(4)] for i in range(4)])
    mean = lambda r: np.array([r[f"m{i}"] for i in range(4)])
    for r in rows.collect():
        own, every = best[r.g], best[""]
        w = own.n / (own.n + outliers.PRIOR)
        v = np.array([r[x] for x in outliers.RATES]) - (w * mean(own) + (1 - w) * mean(every))
        want = v @ np.linalg.inv(w * cov(own) + (1 - w) * cov(every)) @ v
        assert abs(got[r.doc_id] - want) < 1e-6 * max(1, want)


def test_compiled_rules_score_as_they_hold(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model = rules.fit(docs, spark.read.parquet(f"{DATA}/labels.parquet"))
    assert model.weights
    stats = F.array(*(F.col(f"s.{s}") for s in rules.STATISTICS))
    out = rules.scored(docs.withColumn("s", rules.statistics(F.col("text"))), model, "mine").select(stats.alias("x"), "mine").collect()
    x = np.array([r.x for r in out])
    z = model.intercept + sum(w * rules.holds(x, r) for w, r in model.weights)
    assert np.allclose([r.mine for r in out], 1 / (1 + np.exp(-z)))


def test_equal_and_missing_ids_are_told_by_their_texts(spark):
    a, b, c = "one two three four five six seven", "completely other words stand in this place", "short text number three is here"
    rows = [(5, a), (5, b), (6, b), (None, a), (None, c), (None, c.upper()), (9, None), (9, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = sorted(((r.doc_id, r.component_id, r.kept) for r in setsketch.near_duplicates(df, shingle=2).collect()), key=repr)
    assert out == sorted([(5, 5, True), (5, 5, True), (6, 5, False), (None, 5, False), (None, None, True), (None, None, True), (9, 9, True), (9, 9, True)], key=repr)
    full = df.withColumn("m1", F.lit("clash")).withColumn("id", F.lit(1)).withColumn("bag", F.create_map(F.lit("k"), F.lit(1)))
    kept = setsketch.one_of_each(full.union(full), shingle=2)
    assert kept.columns == full.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert [x for x in got if x[1]] == sorted([(5, a), (5, b), *[x for x in got if x[1] and x[1].lower() == c]], key=repr) and sum(1 for x in got if x[1] and x[1].lower() == c) == 1
    assert sum(1 for x in got if x[1] is None) == 4


def brute(rows, size, percent=80):
    """Component of each id by comparing all pairs."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets, up = {}, {}
    for i, t in rows:
        w = WORD.findall((t or "").translate(lower))
        sets[i] = frozenset(tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))) if w else frozenset()
        up[i] = i

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    full = sorted(i for i in sets if sets[i])
    for k, i in enumerate(full):
        for j in full[k + 1 :]:
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = top(i), top(j)
                up[max(a, b)] = min(a, b)
    return {i: (top(i), len(sets[i])) for i in sets}


def test_recall_of_the_pipelines_stage(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], 5)
    assert {r.doc_id: r.component_id for r in setsketch.near_duplicates(docs, shingle=5).collect()} == {k: v[0] for k, v in want.items()}


def test_stages_of_odd_tables(spark):
    rows = [(None, None, None, None, None), (1, "", None, "s", 0), (1, "some words here", "en", None, 3), (1, "some words here", "en", None, 3)]
    odd = spark.createDataFrame(rows, DOCS).withColumn("m1", F.lit(0)).withColumn("score", F.lit("clash")).withColumn("n", F.lit(None).cast("int"))
    for docs in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, DATA)
            assert out.columns == docs.columns and out.count() <= 3 * docs.count(), name
        last = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
        assert last.count() == docs.count()


def test_ranges_split_equal_ids(spark):
    rows = [(None, f"{k:03d} the text of row {k}") for k in range(120)] + [(k, f"a row with an id {k}") for k in range(30)]
    out = spotsigs.fingerprint_edits(spark.createDataFrame(rows, "doc_id long, text string"), range_bytes=200)
    got = out.withColumn("part", F.spark_partition_id()).groupBy("part").count().collect()
    assert sum(r["count"] for r in got) == 150 and max(r["count"] for r in got) < 60
    order = [*sorted((r for r in rows if r[0] is not None), key=lambda r: -r[0]), *sorted((r for r in rows if r[0] is None), key=lambda r: r[1])]
    import hashlib

    want = sorted(hashlib.sha256((t[: len(t) - len(t) // 3] + order[(k + 1) % 150][1][: len(t) // 3]).encode()).hexdigest() for k, (_, t) in enumerate(order))
    assert sorted(r.edited_sha256 for r in out.collect()) == want

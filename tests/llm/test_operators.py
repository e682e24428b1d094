"""Training-data operators on small tables: brute force, round trips, held-out accuracy, odd rows."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from ndspark.llm import bpe, chat_format, langid, mixing, outliers, rules, setsketch, spotsigs, toxicity, url_filter
from ndspark.llm.queries import QUERIES, URL_RULES, VOCABULARY

DATA = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [(1, None), (2, ""), (3, "   \n"), (4, "one"), (5, "One"), (5, "One"), (None, "no id at all"), (7, "word " * 3000), (8, "a\nb\na\nb\n" * 40), (9, "é ñ 日本 " * 60), (None, None), (10, "the same words in the same text"), (11, "the same words in the same text")]


def odd(spark, *columns):
    rows = [(i, t, ("en", "de", None)[k % 3], ("s1", None)[k % 2], len(t or "")) for k, (i, t) in enumerate(ODD)]
    df = spark.createDataFrame(rows, DOCS).withColumn("y", F.lit(3)).withColumn("score", F.lit("clash")).withColumn("id", F.lit(0))
    return df.select(*columns, "y", "score", "id") if columns else df


def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet").collect()


def words(text):
    return WORD.findall(text or "")


def test_urls(spark):
    rows = [(1, "https://a.Example.ORG/es/x?q"), (2, "http://EXAMPLE.org/en/12#f"), (3, "x://b.com/fr/"), (4, "http://com/de/a"), (5, None), (6, "no scheme"), (7, "http://example.organic/es/"), (8, "http://h"), (8, "http://h"), (None, "a://org"), (9, "a://b?c://d.org/")]
    got = url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit(1)), URL_RULES).collect()
    by = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got}
    assert len(got) == len(rows)
    assert by == {
        1: ("a.example.org", "/es/x", "example.org/es/", "block"), 2: ("example.org", "/en/12", "example.org/en/1", "block"), 3: ("b.com", "/fr/", "com/fr/", "allow"), 4: ("com", "/de/a", "com/de/", "block"),
        5: ("", "", None, "allow"), 6: ("", "", None, "allow"), 7: ("example.organic", "/es/", None, "allow"), 8: ("h", "", None, "allow"), None: ("org", "", None, "allow"), 9: ("b", "", None, "allow"),
    }
    assert url_filter.judge_urls(spark.createDataFrame([], "page_id long, url string"), URL_RULES).count() == 0
    assert url_filter.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), []).where("rule is not null").count() == 0


def test_fingerprint_edits(spark, docs):
    got = {r.doc_id: r for r in QUERIES["op2_spotsigs"](spark, DATA).collect()}
    order = sorted(docs, key=lambda r: -r.doc_id)
    assert len(got) == len(docs)
    for k, r in enumerate(order):
        after = order[(k + 1) % len(order)].text
        cut = len(r.text) // 3
        edited = r.text[: len(r.text) - cut] + after[:cut]
        g = got[r.doc_id]
        a, e, n = (spotsigs.signatures(t) for t in (r.text, edited, after))
        assert (g.n_chars, g.edited_sha256, g.fingerprint, g.edited_fingerprint) == (len(r.text), hashlib.sha256(edited.encode()).hexdigest(), spotsigs.fingerprint(a), spotsigs.fingerprint(e))
        assert g.near_edited == spotsigs.likeness(a, e) and g.near_next == spotsigs.likeness(a, n)


def test_fingerprint_edits_odd(spark):
    out = spotsigs.fingerprint_edits(odd(spark, "doc_id", "text")).collect()
    assert len(out) == len(ODD) and len({r.fingerprint for r in out if r.n_chars == 0}) == 1
    assert spotsigs.fingerprint_edits(empty(spark)).count() == 0
    one = spotsigs.fingerprint_edits(spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")).collect()
    assert one[0].near_next == 1.0 and one[0].edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()


def test_spotsigs_pairs(spark, docs):
    prints = spotsigs.fingerprints(spark.read.parquet(f"{DATA}/documents.parquet"))
    classes = {}
    for r in docs:
        classes.setdefault(spotsigs.fingerprint(spotsigs.signatures(r.text)), []).append(r.doc_id)
    sets = {min(v): set(spotsigs.parse(k).tolist()) for k, v in classes.items()}
    want = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    assert {(r.a, r.b) for r in spotsigs.near_pairs(prints).collect()} == want


def test_chat(spark):
    rows = [(1, 0, "user", "hi </s> <|end|> &lt; &amp;"), (1, 1, "assistant", "[INST] <|turn|>user\nx"), (1, 2, "user", None), (1, 3, "assistant", ""), (1, 4, "assistant", "z\n"), (2, 0, "user", "alone"), (3, None, "assistant", "first"), (3, 0, None, "none"), (None, 0, "assistant", "no id"), (4, 0, "a\nb<|end|>", "role"), (4, 0, "a\nb<|end|>", "role")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("t", F.lit(1)).withColumn("turns", F.lit(2))
    ex = chat_format.expand(df)
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r[1:])
    for r in chat_format.read_back(ex).collect():
        turns = sorted(by[r.conv_id], key=lambda t: (t[0] is not None, t[0], t[1] or "", t[2] or ""))
        assert [tuple(t) for t in r.turns] == [(b or "", c or "") for _, b, c in turns]
        assert r.loss == "".join(c or "" for _, b, c in turns if b == "assistant")
    for e in ex.collect():
        assert not any(c in e.formatted[e.loss_start - 1 : e.loss_start - 1 + e.loss_length] for c in chat_format.CONTROL)
    assert ex.where("conv_id = 1").count() == 3 and ex.where("conv_id = 2").count() == 1
    assert chat_format.digests(chat_format.read_back(chat_format.expand(df.limit(0)))).count() == 0


def labels(spark):
    return spark.read.parquet(f"{DATA}/labels.parquet")


def test_toxicity(spark, docs):
    truth = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    out = QUERIES["op4_toxicity"](spark, "/root/testdata/sf0.01").collect()
    held = [(r.predicted, truth[r.doc_id]) for r in out if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in out)
    assert sum(p == t for p, t in held) / len(held) > 0.93


def test_toxicity_odd(spark):
    d = odd(spark)
    out = toxicity.judge(d, labels(spark).limit(0)).collect()
    assert len(out) == len(ODD) and {r.score for r in out} == {0.0}
    assert toxicity.judge(empty(spark), labels(spark)).count() == 0
    kept = toxicity.keep_clean(d, labels(spark))
    assert kept.columns == d.columns and kept.count() == len(ODD)
    twice = labels(spark).union(labels(spark)).withColumn("text", F.lit("clash"))
    assert toxicity.judge(spark.read.parquet(f"{DATA}/documents.parquet"), twice).count() == 200


def test_rules(spark):
    truth = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    out = QUERIES["op10_rule_ensemble"](spark, "/root/testdata/sf0.01").collect()
    held = [(r.predicted, truth[r.doc_id]) for r in out if r.held_out and r.doc_id in truth]
    assert sum(p == t for p, t in held) / len(held) > 0.95 and all(0 <= r.score <= 1 for r in out)


def test_rules_compile_as_they_hold(spark):
    model = rules.fit(spark.read.parquet(f"{DATA}/documents.parquet"), labels(spark))
    assert all(isinstance(t, str) for t in model.text())
    out = rules.scored(odd(spark).drop("score"), model)
    assert out.count() == len(ODD) and out.where("score is null or score < 0 or score > 1").count() == 0
    assert rules.judge(odd(spark), labels(spark).limit(0)).where("predicted = 0").count() == 0
    assert rules.keep_good(odd(spark), labels(spark)).columns == odd(spark).columns
    assert rules.judge(empty(spark), labels(spark)).count() == 0


def test_statistics_of_rules(spark, docs):
    got = {r.doc_id: r.s for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", rules.statistics(F.col("text")).alias("s")).collect()}
    for r in docs:
        w, s = words(r.text), got[r.doc_id]
        n = max(1, len(w))
        assert s.distinct == len(set(w)) / n and s.adjacent == sum(a == b for a, b in zip(w, w[1:])) / n
        assert s.capitals == sum("A" <= c <= "Z" for c in r.text) / max(1, len(r.text)) and s.longest == min(200, max(map(len, w), default=0))


def test_mixing(spark, docs):
    out = QUERIES["op5_mixing"](spark, DATA).collect()
    size = {r.doc_id: len(words(r.text)) for r in docs}
    assert sorted(r.doc_id for r in out) == sorted(size) and all(r["size"] == size[r.doc_id] and r.taken <= 3 * r["size"] for r in out)
    taken, target = Counter(), {}
    source = {r.doc_id: r.source for r in docs}
    for r in out:
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)
    assert sorted(map(tuple, out)) == sorted(map(tuple, QUERIES["op5_mixing"](spark, DATA).collect()))


def test_mix_rows(spark):
    df = spark.createDataFrame([(k, " ".join(f"w{j}" for j in range(20)), "en", s, 1) for k in range(30) for s in ("a", None)][:55] + [(3, "x y z", "en", "b", 1)] * 3 + [(None, None, None, None, None)], DOCS).withColumn("rest", F.lit("r"))
    plan = mixing.plan(df).collect()
    out = mixing.mix(df)
    assert out.columns == df.columns
    assert sum(len(words(r.text)) for r in out.collect()) == sum(r.taken for r in plan)
    assert mixing.plan(empty(spark)).count() == 0 and mixing.mix(empty(spark)).count() == 0
    assert mixing.plan(odd(spark)).count() == len(ODD)


def test_ranges_do_not_change_the_mix_size(spark):
    df = spark.createDataFrame([(k, "w " * (k % 17), "en", "ab"[k % 3 == 0], 1) for k in range(500)], DOCS)
    totals = [sorted(map(tuple, mixing.plan(df, rows_per_range=n).groupBy("source").agg(F.sum("taken")).collect())) for n in (7, 1000)]
    assert totals[0] == totals[1]


def test_bpe(spark, docs):
    ranks = bpe.read_ranks(VOCABULARY)
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    extra = odd(spark, "doc_id", "text").select((F.col("doc_id") + 1_000_000).alias("doc_id"), "text")
    df = spark.read.parquet(f"{DATA}/documents.parquet").limit(60).select("doc_id", "text").union(extra)
    coded = bpe.encode(df, VOCABULARY, public_tokenizers.PATTERN).cache()
    text = {r.doc_id: r.text for r in docs} | {i + 1_000_000: t for i, t in ODD if i is not None}
    for r in coded.where("doc_id is not null").collect():
        assert r.n_tokens == len(r.ids) and bytes(r.decoded) == (text.get(r.doc_id) or "").encode()
    some = [r for r in coded.collect() if r.doc_id is not None and r.doc_id < 1_000_000]
    assert all(r.ids == theirs.encode_ordinary(text[r.doc_id]) for r in some)
    back = {r.doc_id: r.text for r in bpe.decode(coded, VOCABULARY, public_tokenizers.PATTERN).collect() if r.doc_id is not None}
    assert all(back[k] == (text[k] or "") for k in back)
    assert bpe.encode_digests(empty(spark), VOCABULARY, public_tokenizers.PATTERN).count() == 0


def test_quality_counts(spark, docs):
    got = {r.doc_id: r for r in QUERIES["op7_quality_rules"](spark, DATA).collect()}
    for r in docs:
        w = words(r.text)
        grams = Counter(zip(w, w[1:], w[2:]))
        covered = {k + j for k in range(len(w) - 2) if grams[tuple(w[k : k + 3])] > 1 for j in range(3)}
        seen, dup = set(), 0
        for line in r.text.split("\n"):
            if words(line):
                dup += line in seen
                seen.add(line)
        g = got[r.doc_id]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in r.text), dup, len(covered))
        assert g.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w)) and not (g.base_failed and g.kept)


def test_quality_verdicts(spark):
    truth = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    out = [r for r in QUERIES["op7_quality_rules"](spark, "/root/testdata/sf0.01").collect() if r.doc_id in truth and not r.base_failed]
    assert all(r.kept for r in out if truth[r.doc_id] == 1) and not any(r.kept for r in out if truth[r.doc_id] == 0)
    assert outliers.judge(outliers.statistics(odd(spark))).count() == len(ODD)
    assert outliers.judge(outliers.statistics(empty(spark))).count() == 0


def test_outliers_by_group(spark):
    import random

    rnd = random.Random(2)
    good = [(k, " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 8))) for _ in range(120)), ("en", "de")[k % 2], "s", 1) for k in range(200)]
    bad = [(1000 + k, " ".join(f"#{k}{j}***$$" for j in range(120)), "en", "s", 1) for k in range(10)]
    out = {r.doc_id: r.kept for r in outliers.judge(outliers.statistics(spark.createDataFrame(good + bad, DOCS))).collect()}
    assert sum(out[k] for k in range(200)) >= 198 and not any(out[1000 + k] for k in range(10))


def test_language(spark):
    out = QUERIES["op8_language_id"](spark, "/root/testdata/sf0.01").collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").collect()}
    held = [r.lang_pred == lang[r.doc_id] for r in out if r.held_out]
    assert sum(held) / len(held) > 0.97 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in out)


def test_language_odd(spark):
    out = langid.judge(odd(spark)).collect()
    assert len(out) == len(ODD) and all(r.lang_pred == "und" and r.score == 0 for r in out if r.doc_id in (1, 2, 3))
    assert {r.lang_pred for r in langid.judge(odd(spark).withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert langid.judge(empty(spark)).count() == 0


def brute(rows, size, percent=80):
    """Component of each id by comparing all pairs."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets, up = {}, {}
    for i, t in rows:
        w = words((t or "").translate(lower))
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


def test_near_duplicates(spark, docs):
    want = brute([(r.doc_id, r.text) for r in docs], 2)
    out = QUERIES["op9_setsketch"](spark, DATA).collect()
    assert {r.doc_id: (r.component_id, r.n_shingles) for r in out} == want and all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_near_duplicate_group_around_the_threshold(spark, monkeypatch):
    """Copies whose similarities lie on both sides of 0.8, in small blocks."""
    import random

    monkeypatch.setattr(setsketch, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(setsketch, "LINKS_PER_TASK", 3)
    rnd = random.Random(11)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for i in range(90):
        w = list(base)
        for _ in range(rnd.choice([2, 8, 16, 24])):
            w[rnd.randrange(150)] = f"e{rnd.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    rows += [(200 + i, rows[3][1].upper()) for i in range(20)]
    out = setsketch.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2).collect()
    assert {r.doc_id: (r.component_id, r.n_shingles) for r in out} == brute(rows, 2)


def test_near_duplicates_odd(spark):
    out = setsketch.near_duplicates(odd(spark), shingle=5).collect()
    by = {r.doc_id: r.component_id for r in out}
    assert len(out) == len(ODD) and by[4] == 4 and by[5] == 4 and by[11] == 10 and by[1] == 1 and by[2] == 2 and by[None] is None
    assert all(r.kept for r in out if r.doc_id is None)
    assert setsketch.near_duplicates(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        setsketch.near_duplicates(empty(spark), percent=50)


def test_language_bound_raises_and_drops_no_language(spark, monkeypatch):
    docs = spark.createDataFrame([(k, w * 5, w) for k, w in enumerate(("aa bb ", "cc dd ", "ee ff "))] + [(9, "x", None)], "doc_id long, text string, lang string")
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 3)
    assert set(langid.prototypes(docs, F.lit(True), 1)) == {"aa bb ", "cc dd ", "ee ff "}
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 2)
    with pytest.raises(ValueError, match="more than 2 languages"):
        langid.prototypes(docs, F.lit(True), 1)


def test_mixing_cuts_without_touching_white_space(spark):
    rows = [("\n a\n\n b  c ", 2, "\n a\n\n b"), ("a\tb", 1, "a"), ("a\tb", 2, "a\tb"), ("a b", 0, ""), ("é\r\n\U0001f600 x", 2, "é\r\n\U0001f600")]
    df = spark.createDataFrame(rows, "text string, n int, want string")
    assert [r.got for r in df.select(mixing.leading_words(F.col("text"), F.col("n")).alias("got")).collect()] == [r[2] for r in rows]
    docs = spark.createDataFrame([(k, " " + "\n\n\t".join(f"w{i}" for i in range(30 + k)), f"s{k % 3}") for k in range(40)], "doc_id long, text string, source string")
    whole = {r.doc_id: r.text for r in docs.collect()}
    taken = mixing.mix(docs).collect()
    assert all(whole[r.doc_id].startswith(r.text) for r in taken)
    assert any(whole[r.doc_id] != r.text and "\n" in r.text for r in taken)
    assert sum(len(r.text.split()) for r in taken) == sum(r.taken for r in mixing.plan(docs).collect())

"""Parts of the training-data operators that need no session."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from ndspark.llm import bpe, langid, setsketch, spotsigs, toxicity, trees, url_filter
from ndspark.llm.mixing import targets
from ndspark.llm.queries import URL_RULES, VOCABULARY


@pytest.fixture(scope="module")
def coder():
    return bpe.Coder(bpe.read_ranks(VOCABULARY), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def theirs():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(VOCABULARY), special_tokens={})


def test_bpe_like_tiktoken(coder, theirs):
    rnd = random.Random(4)
    texts = ["", "   \n\n x", "a" * 700, "ab" * 300, "é" * 120, "!?" * 200, "0123456789" * 9, "日本語のテキスト" * 9, "<|endoftext|>", "it's we'll I'd"]
    texts += ["".join(chr(rnd.randrange(32, 0xD7FF)) for _ in range(60)) for _ in range(30)] + ["".join(rnd.choice("theandofing ") for _ in range(300)) for _ in range(20)]
    texts += ["".join(rnd.choice("abcdefgh") for _ in range(150))]
    for t, (ids, decoded) in zip(texts, coder.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == theirs.encode_ordinary(t)
        assert decoded == t.encode()
    want = [theirs.encode_ordinary(t) for t in texts]
    assert coder.decode(want) == [t.encode() for t in texts]


def test_digest_array_confirms_strings(monkeypatch):
    monkeypatch.setattr(url_filter, "digest", lambda s: np.array([len(x) % 2 for x in s], np.uint64))  # everything collides
    names = ["a", "bb", "ccc", "dddd", "e"]
    array = url_filter.DigestArray(url_filter.pack({n: k for k, n in enumerate(names)}))
    got = array.probe([*names, "zz", ""])
    assert [array.string(i) if i >= 0 else None for i in got] == [*names, None, None]
    assert [int(array.payload[i]) for i in got[:5]] == [0, 1, 2, 3, 4]


hosts = st.lists(st.sampled_from(["a", "b", "example", "org", "com"]), min_size=1, max_size=4).map(".".join)
paths = st.text("/enabc1", max_size=6).map(lambda p: "/" + p)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["allow", "block"]), hosts, paths), max_size=8), st.lists(st.tuples(hosts, paths), min_size=1, max_size=6))
def test_url_rules_like_brute_force(rules, urls):
    parts = [(url_filter.DigestArray(a), url_filter.DigestArray(b), c) for a, b, c in url_filter.shards(rules)]
    last = {(h, p): v for v, h, p in rules}
    for part in parts:
        for (host, path), got in zip(urls, url_filter.judge_batch([h for h, _ in urls], [p for _, p in urls], part), strict=True):
            fits = [(len(h) + len(p), len(h), h, p, int(v == "block")) for (h, p), v in last.items() if (host == h or host.endswith("." + h)) and path.startswith(p)]
            assert got == (max(fits)[2:] if fits else None)


def test_many_shards(monkeypatch):
    monkeypatch.setattr(url_filter, "MAX_SHARD_BYTES", 60)
    assert len(url_filter.shards(URL_RULES)) > 1


def test_spotsigs():
    a = spotsigs.signatures("the quick fox of big dogs")
    assert len(a) == 2 and spotsigs.parse(spotsigs.fingerprint(a)).tolist() == a.tolist()
    assert spotsigs.fingerprint(spotsigs.signatures("")) == spotsigs.fingerprint(spotsigs.signatures(None))
    assert len(spotsigs.signatures("zzz yyy")) == 1
    assert spotsigs.likeness(np.array([1, 2, 3], np.uint32), np.array([2, 3, 4], np.uint32)) == 0.5
    assert spotsigs.likeness(np.array([1], np.uint32), np.array([1, 2, 3, 4], np.uint32), 0.8) == 0


def _sets(j, n, rnd):
    """Two random sets of about Jaccard similarity j."""
    common = int(round(2 * n * j / (1 + j)))
    x = np.unique(rnd.integers(0, 1 << 63, 2 * n - common, dtype=np.uint64))
    return np.sort(x[:n]), np.sort(np.r_[x[:common], x[n:]])


def test_sketch_estimates_and_merges():
    rnd = np.random.default_rng(5)
    for j in (0.2, 0.5, 0.8, 0.95):
        errors = []
        for _ in range(15):
            a, b = (setsketch.mixed(s) for s in _sets(j, 400, rnd))
            a, b = np.sort(a), np.sort(b)
            exact = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            ra, rb = setsketch.sketch([a, b])
            est = setsketch.estimate(np.array([(ra > rb).sum()]), np.array([(ra < rb).sum()]), np.array([len(a)]), np.array([len(b)]))[0]
            errors.append(est - exact)
            assert (setsketch.sketch([np.union1d(a, b)])[0] == np.maximum(ra, rb)).all()
            if exact >= 0.8:
                assert len(setsketch.possible(ra, len(a), rb[None, :], np.array([len(b)]), 80))
                assert (setsketch.band_values(ra[None, :]) == setsketch.band_values(rb[None, :])).any()
            assert setsketch.linked(a, b, 80) == (100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b)))
        assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_runs_over_batches():
    import pyarrow as pa

    rows = [(1, 5), (1, 6), (2, 1), (3, 1), (3, 2), (3, 9), (4, 4)]
    batch = lambda part: pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.int64()), pa.array([r[1] for r in part], pa.int64())], ["band", "id"])
    for cut in range(len(rows) + 1):
        out = [r for b in setsketch._runs(iter([batch(rows[:cut]), batch(rows[cut:])])) for r in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True)]
        assert out == [(1, 5, 5, True), (1, 6, 5, True), (3, 1, 1, False), (3, 2, 1, False), (3, 9, 1, False), (4, 4, 4, True)]


def test_block_links_join_what_is_linked():
    rnd = np.random.default_rng(7)
    base = np.sort(setsketch.mixed(rnd.integers(0, 1 << 63, 300, dtype=np.uint64)))
    sets = [base] + [np.sort(np.r_[base[k:], setsketch.mixed(rnd.integers(0, 1 << 63, k, dtype=np.uint64))]) for k in (5, 20, 60, 150)]
    regs = [r.tobytes() for r in setsketch.sketch(sets)]
    found = setsketch.block_links(list(range(5)), [0, 1, 2, 3, 4], [len(s) for s in sets], regs, [s.tobytes() for s in sets], 80)
    joined = {0}
    while more := {y for a, b in found for x, y in ((a, b), (b, a)) if x in joined} - joined:
        joined |= more
    assert joined == {0, 1, 2}


def test_targets(spark):
    rnd = np.random.default_rng(5)
    for k in range(12):
        names = ["a", "b", "c", None, "d"][: k % 6]
        sizes = [(s, int(rnd.integers(0, 1000) * (rnd.random() < 0.8) * 10 ** (rnd.random() * 3))) for s in names]
        out = {r.source: r.target for r in targets(spark.createDataFrame(sizes, "source string, n long")).collect()}
        assert len(out) == len(sizes)
        assert all(out[s] <= 3 * n + 1e-6 for s, n in sizes)
        assert abs(sum(out.values()) - sum(n for _, n in sizes)) < 1e-6 * max(1, sum(n for _, n in sizes))
        weight = dict(zip(sorted((s for s, _ in sizes), key=lambda s: (s is None, s or "")), [5, 2, 1, 5, 2], strict=False))
        free = [out[s] / weight[s] for s, n in sizes if out[s] < 3 * n - 1e-6]
        assert not free or max(free) - min(free) < 1e-6 * max(1, max(free))


def test_trees_learn_and_calibrate():
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(2000, 4))
    y = ((x[:, 0] > 0) & (x[:, 2] < 0.5)).astype(float)
    model = trees.boost(x, y, rounds=20)
    assert ((model.margin(x) > 0) == (y > 0)).mean() > 0.98
    knots, p = trees.isotonic(model.margin(x), y)
    assert (np.diff(p) >= 0).all() and (np.diff(knots) >= 0).all() and 0 <= p.min() and p.max() <= 1
    assert trees.isotonic(np.array([1.0, 2, 3, 4]), np.array([0.0, 1, 0, 1]))[1].tolist() == [0.0, 0.5, 0.5, 1.0]
    b, w = trees.lasso_logistic(np.c_[y, rnd.integers(0, 2, 2000)].astype(float), y, 0.01)
    assert w[0] > 1 and abs(w[1]) < 0.1


def test_toxicity_features():
    codes = toxicity._Codes({"idiot"}, {"bad"})
    f = dict(zip(toxicity.FEATURES, toxicity.features(b"you are an IDIOT! really 1d10t i.d.i.o.t bad", codes), strict=True))
    assert f["strong_count"] == 1 and f["hit_count"] == 3 and f["near_second"] > 0 and f["weak"] > 0 and f["caps_words"] > 0 and f["hidden"] > 0
    assert toxicity.features(None, codes) == [0.0] * len(toxicity.FEATURES)


def test_language_bundles():
    en, en2, de = (langid.bundle(t) for t in ("the cat and the dog went there", "then the other cat went there", "der hund und die katze sind nicht da"))
    assert en @ en2 > en @ de and langid.bundle("123 !") is None and langid.bundle(None) is None and abs(float(en @ en) - 1) < 1e-5

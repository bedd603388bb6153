"""Operators 11 to 13: brute force on small fixtures, and the defined odd cases."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from emporia.llm import url_rules, whitening, zfast

VECTORS = "vec_id long, embedding array<float>, n string, component int"


def _vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", 3) for i, v in rows], VECTORS)


def _brute_whitening(vectors, count=8):
    x = np.floor(1024 * np.array(vectors, float)) + 100_000
    n, c = len(x), x - x.mean(0)
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1], v[:, ::-1]
    ints = x.astype(object)
    dev = ((n * ints - ints.sum(0)) ** 2).sum(1)
    return c @ v[:, :count] / np.sqrt(e[:count]), e[:count] / e.sum(), dev


def test_whitening_matches_a_dense_eigendecomposition(spark):
    rng = np.random.default_rng(5)
    data = (rng.standard_normal((300, 12)) * np.linspace(3, 0.1, 12)).astype(np.float32)
    odd = [(900, None), (901, [1.0, None] + [0.0] * 10), (902, [float("nan")] + [0.0] * 11),
           (903, [float("inf")] + [0.0] * 11), (904, [1.0]), (905, [])]
    df = _vectors(spark, [(i, [float(v) for v in r]) for i, r in enumerate(data)] + odd).repartition(7)
    got = whitening.whitened(df).toPandas()
    want, share, dev = _brute_whitening(data)
    assert len(got) == 300 * 8 and set(got.n) == {300}
    w = got.pivot(index="vec_id", columns="component", values="whitened").loc[range(300)].to_numpy()
    assert np.allclose(w * np.sign((w * want).sum(0)), want, atol=1e-9)
    assert np.allclose(got.drop_duplicates("component").sort_values("component").explained, share, rtol=1e-9)
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-9
    one = got.drop_duplicates("vec_id").set_index("vec_id").loc[range(300)]
    assert [int(v) for v in one.deviation] == [int(v) for v in dev]


def test_whitening_finds_repeated_and_missing_directions(spark):
    """Equal variances in two directions, and dimensions that never vary: six components, none lost, none invented."""
    base = [[s if i == j else 0.0 for j in range(3)] for i in range(3) for s in (1.0, -1.0)]
    rows = [(i, [*v, 4.0, 4.0]) for i, v in enumerate(base * 3)]
    got = whitening.whitened(_vectors(spark, rows)).toPandas()
    assert sorted(set(got.component)) == [1, 2, 3] and len(got) == 18 * 3
    assert np.allclose(got.explained, 1 / 3) and got.identity_error.max() < 1e-9


def test_whitening_of_nothing_constant_and_huge(spark):
    assert whitening.whitened(_vectors(spark, [])).count() == 0
    assert whitening.whitened(_vectors(spark, [(1, None)])).count() == 0
    assert whitening.whitened(_vectors(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])).count() == 0
    rows = [(None, [1e30, 0.0]), (1, [3e12, 1.0]), (1, [-3e12, 2.0]), (2, [0.0, 3.0])]
    got = whitening.whitened(_vectors(spark, rows)).toPandas()
    x = np.floor(1024 * np.array([r[1] for r in rows[1:]], np.float32).astype(float)) + 100_000
    ints = np.array([[int(v) for v in r] for r in x], object)
    want = sorted(str(v) for v in ((3 * ints - ints.sum(0)) ** 2).sum(1))
    assert sorted(got[got.component == 1].deviation_exact) == want and set(got.n) == {3}
    assert got.deviation.isna().sum() == sum(int(v) >= 1 << 63 for v in want) * got.component.nunique()


# ---- URL rules -------------------------------------------------------------------
def _pages(spark, urls):
    return spark.createDataFrame([(i, u, "h", "p", "r") for i, u in enumerate(urls)], "page_id long, url string, host string, path string, rule string")


def test_written_rules_and_parts(spark):
    cases = {
        "http://a.ORG/x": ("a.org", "/x", "org/", "allow"), "http://org/": ("org", "/", "org/", "allow"),
        "http://www.example.org/es/1": ("www.example.org", "/es/1", "example.org/es/", "block"),
        "http://example.org/en/12?q#f": ("example.org", "/en/12", "example.org/en/1", "block"),
        "http://badexample.org/es/1": ("badexample.org", "/es/1", "org/", "allow"),
        "x://b.com/de/": ("b.com", "/de/", "com/de/", "block"), "x://b.com/fr/é": ("b.com", "/fr/é", "com/fr/", "allow"),
        "http://a.org": ("a.org", "", None, None), "http://a.org:80/x": ("a.org:80", "/x", None, None),
        "http://a.com?x=/de/": ("a.com", "", None, None), None: ("", "", None, None), "": ("", "", None, None),
        "a.org/x": ("", "", None, None), "://": ("", "", None, None), "u://É.Org/DE/": ("É.org", "/DE/", "org/", "allow"),
        "http://n.net/" + "y" * 100_000: ("n.net", "/" + "y" * 100_000, None, None),
    }
    urls = list(cases)
    got = {r.page_id: r for r in url_rules.judged(_pages(spark, urls)).collect()}
    for i, u in enumerate(urls):
        host, path, rule, verdict = cases[u]
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == verdict if verdict else got[i].verdict in ("allow", "block")


def _brute_verdicts(rows, min_support, min_confidence):
    """All subsets of all labelled token sets, counted in Python."""
    n = sum(1 for _, label in rows if label)
    count, said = defaultdict(int), defaultdict(int)
    for items, label in rows:
        if label:
            for m in range(1, 1 << len(items)):
                s = frozenset(t for i, t in enumerate(items) if m >> i & 1)
                count[s] += 1
                said[s, label] += 1
    out = []
    for items, label in rows:
        best = [(-k / count[s], -k, len(s), x) for (s, x), k in said.items()
                if s <= set(items) and k >= np.ceil(min_support * n) and k / count[s] >= min_confidence]
        out.append(label or (min(best)[3] if best else "allow"))
    return out


@pytest.mark.parametrize("support,confidence", [(0.01, 0.9), (0.05, 0.6)])
def test_mined_rules_match_all_subsets(spark, support, confidence):
    rng = random.Random(3)
    urls = [f"{rng.choice(['http', 'https'])}://{rng.choice(['', 'm.', 'www.'])}{rng.choice('abcd')}.example.{rng.choice(['com', 'org', 'net'])}"
            f"/{rng.choice(['de', 'fr', 'en', 'es'])}/{rng.randrange(30)}{rng.choice(['', '.html', '?x=1&y=2', '#t'])}" for _ in range(240)]
    urls += [urls[0]] * 120 + [None, "nothing"]  # one URL holds a third of the rows
    df = _pages(spark, urls).repartition(5)
    host, path = url_rules.host_and_path(F.col("url"))
    rule, label = url_rules.written_rule(host, path)
    parts = {r.page_id: (r.t, r.label) for r in df.select("page_id", url_rules.tokens(host, path, F.col("url")).alias("t"), label.alias("label")).collect()}
    want = _brute_verdicts([parts[i] for i in range(len(urls))], support, confidence)
    got = {r.page_id: r.verdict for r in url_rules.judged(df, min_support=support, min_confidence=confidence).collect()}
    assert [got[i] for i in range(len(urls))] == want
    assert "block" in {w for w, (_, known) in zip(want, (parts[i] for i in range(len(urls)))) if not known}


def test_no_pages_and_no_labels(spark):
    assert url_rules.judged(_pages(spark, [])).count() == 0
    got = url_rules.judged(_pages(spark, ["http://a.net/x", "http://a.net/x", None])).collect()
    assert [r.verdict for r in got] == ["allow"] * 3


def test_needless_rules_are_dropped_without_changing_verdicts():
    rules = [(["a"], "block", 1.0, 0.2), (["a", "b"], "block", 1.0, 0.1), (["b", "c"], "allow", 0.95, 0.3), (["a", "c"], "allow", 0.92, 0.4)]
    index = url_rules.Index(rules)
    assert len(index.rules) == 3
    assert index.judge(frozenset("abc")) == "block" and index.judge(frozenset("bc")) == "allow" and index.judge(frozenset("b")) is None


# ---- z-fast trie -------------------------------------------------------------------
SCHEMA = "conv_id long, turn long, role string, text string, depth string, key string"


def _brute_trie(rows):
    conv = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            d = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]
            conv[c].append(((turn is not None, turn or 0), d, (role, text)))
    conv = {c: [x[2] for x in sorted(v)] for c, v in conv.items()}
    members, ends, kids = defaultdict(list), defaultdict(list), defaultdict(set)
    for c in conv:
        h = zlib.crc32(str(c).encode()) % 9
        s = tuple(conv.get(c - int(np.fmod(c, 5)), [])[:h] + conv[c][h:])
        ends[s].append(c)
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
            if d:
                kids[s[: d - 1]].add(s[:d])
    leaves, saved = {}, {}
    for s in sorted(members, key=len, reverse=True):
        leaves[s] = sum(leaves[x] for x in kids.get(s, ())) or 1
        saved[s] = sum(saved[x] for x in kids.get(s, ())) + ((len(members[s]) - 1) * len(s[-1][1].encode()) if s else 0)
    return sorted((min(members[s]), len(s), min(members[s[:-1]]) if s else -1, len(members[s]), len(kids.get(s, ())), leaves[s], saved[s],
                   hashlib.sha256(",".join(map(str, sorted(ends.get(s, [])))).encode()).hexdigest()) for s in members)


def _trie(spark, rows):
    df = spark.createDataFrame([(*r, "d", "k") for r in rows], SCHEMA).repartition(6)
    got = zfast.trie(zfast.rebuilt(zfast.turn_digests(df)))
    return sorted(tuple(-1 if v is None else v for v in r) for r in got.collect())


def _conversations(seed, n, alphabet, longest, hot=None):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        texts = list(hot) if hot and rng.random() < 0.34 else [rng.choice(alphabet) for _ in range(rng.randint(1, longest))]
        rows += [(c, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


def test_trie_matches_brute_force_with_a_hot_conversation(spark):
    rows = _conversations(1, 120, ["a", "b", "é" * 40], 12, hot=["a"] * 9)
    assert _trie(spark, rows) == _brute_trie(rows)


def test_trie_odd_rows(spark):
    rows = [(0, None, None, None), (0, 1, "user", "x"), (0, 1, "user", "x"), (1, 5, "user", None), (1, None, "", ""), (None, 0, "user", "lost"),
            (-7, 0, "user", "y"), (-5, 0, "a", "z"), (10**12 + 3, 0, "user", "x"), (3, 2, "user", "t" * 200_000), (3, 1, "us", "ert")]
    assert _trie(spark, rows) == _brute_trie(rows)


def test_trie_of_nothing(spark):
    assert _trie(spark, []) == [] and _trie(spark, [(None, 1, "a", "b")]) == []


def test_long_nested_chain_takes_few_batches(spark, monkeypatch):
    """Conversations of 1 to 60 equal turns, each a prefix of the next: a batch halves what is open."""
    batches = []
    real = zfast.written
    monkeypatch.setattr(zfast, "written", lambda s, df, name: (batches.append(name), real(s, df, name))[1])
    rows = [(5 * c, i, "user", "same") for c in range(60) for i in range(c + 1)]
    assert _trie(spark, rows) == _brute_trie(rows)
    assert batches.count("trie-batch") <= 10


def test_insert_into_an_existing_trie_adds_only_what_is_new(spark):
    """Batches inserted one after the other give the node table of all at once."""
    rows = _conversations(4, 60, ["a", "b"], 8)
    df = spark.createDataFrame([(*r, "d", "k") for r in rows], SCHEMA)
    p = zfast.prefix_digests(zfast.turn_digests(df)).dropDuplicates(["key"]).cache()
    first = zfast.insert(None, p.where("conv_id < 30"), 8)
    both = zfast.insert(first, p.where("conv_id >= 30"), 8)
    whole = zfast.insert(None, p, 8)
    cols = ["p", "e", "hp", "he", "f", "hf", "g"]
    # Which turns stand on which edge depends on the set alone, not on the order of insertion.
    assert sorted(map(tuple, both.select(cols).collect())) == sorted(map(tuple, whole.select(cols).collect()))


def test_two_fattest(spark):
    pairs = [(a, b) for b in range(1, 40) for a in range(b)]
    df = spark.createDataFrame(pairs, "a int, b int")
    for a, b, f in df.select("a", "b", zfast.two_fattest(F.col("a"), F.col("b"))).collect():
        assert f == max(range(a + 1, b + 1), key=lambda v: v & -v)

"""The operators on spelling variants, exact search and periodic runs against
brute force, and odd rows."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from farebox.llm import periodic, queries, topk, variants

SF = "/root/testdata/sf0.001"
ODD = [(1, "one two three four five six"), (2, None), (3, ""), (4, "lorem ipsum dolor sit amet " * 3000),
       (5, "a  b\n\n c"), (5, "a  b\n\n c"), (None, "no id " * 9), (7, "\t\n "), (8, "x " * 500),
       (9, "Élégante élégante ÉLÉGANTE colouring coloring colorings " * 6), (10, "a \x1c b \x0b c")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string").select(
        "*", F.lit("clash").alias("word"), F.lit(1).alias("n"), F.lit(2).alias("runs"))


@pytest.fixture(scope="module")
def docs(spark):
    return [(r["doc_id"], r["text"]) for r in
            spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


# --- spelling variants ---------------------------------------------------------

def _near(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + (len(a) == len(b)):] == b[k + 1:]


def _variants(counts: dict) -> set:
    near = {w: [] for w in counts}
    for a in counts:
        for b in counts:
            if _near(a, b):
                near[a].append(b)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * n else None
    out = set()
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return out


def _counts(rows, leave_out):
    c = collections.Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(ch.lower() if "A" <= ch <= "Z" else ch for ch in run)
            h = zlib.crc32(f"{'null' if i is None else i}:{w}".encode())
            if leave_out and h % leave_out == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            c[w] += 1
    return {w: n for w, n in c.items() if len(w) >= 7 and n >= 2}


def test_variants_of_documents(spark, odd, docs):
    got = queries.op11_variants(spark, SF)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in got.collect()]
    want = _variants(_counts(docs, 31))
    assert len(rows) == len(want) > 500 and set(rows) == want
    rows = [tuple(r) for r in variants.spelling_variants(odd).collect()]
    assert set(rows) == _variants(_counts(ODD, None)) and len(rows) == len(set(rows))
    assert variants.spelling_variants(odd.limit(0)).count() == 0


def test_variants_chain_and_ties(spark):
    counts = {"aaaaaaa": 5, "aaaaaaab": 5000, "aaaaaaabc": 60, "baaaaaaab": 50_000,
              "caaaaaaab": 50_000, "zzzzzzzzzzz" * 30: 9, "zzzzzzzzzzz" * 30 + "y": 90, "abababab": 7,
              "babababa": 7, "ababababa": 70, "xyxyxyxy": 3, "xyxyxyxyx": 30, "yxyxyxyxy": 30}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert {tuple(r) for r in variants.group_variants(words).collect()} == _variants(counts)


@settings(max_examples=300, deadline=None)
@given(st.text("ab", min_size=4, max_size=9), st.integers(0, 9), st.sampled_from("abc"),
       st.sampled_from("idr"), st.permutations([x + y for x in "abc" for y in "abc"]))
def test_near_words_share_a_key(word, at, letter, kind, grams):
    at = min(at, len(word) - (kind != "i"))
    other = word[:at] + ("" if kind == "d" else letter) + word[at + (kind != "i"):]
    if other == word or len(other) < 4:
        return
    order = {g: k for k, g in enumerate(grams)}

    def keys(w, pivots):
        starts = variants.prefix_of(w, order)
        if pivots:
            starts = variants.pivots_of(starts, [order[w[i:i + 2]] for i in starts])
            assert len(starts) == 2 and starts[1] - starts[0] >= 2
        return variants.keys_of(w, starts, (-1, 0, 1) if pivots else (0,))

    assert keys(word, True) & keys(other, False) or keys(other, True) & keys(word, False)


def test_pivots_are_the_cheapest_disjoint_pair():
    assert variants.pivots_of([0, 1, 2], [5, 0, 4]) == [0, 2]
    assert variants.pivots_of([1, 4, 6], [3, 9, 1]) == [1, 6]
    assert variants.pivots_of([0, 3, 9], [3, 1, 1]) == [3, 9]


# --- exact search ----------------------------------------------------------------

def _best(rows, every, k=5):
    rows = [(n, i, v) for n, (i, v) in enumerate(rows)
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = collections.Counter()
    for n, i, v in rows:
        if i % every == 0:
            found = sorted((-sum(int(a) * int(b) for a, b in zip(v, w)), j, m)
                           for m, j, w in rows if m != n and len(w) == len(v))
            for rank, (s, j, _) in enumerate(found[:k], 1):
                out[(i, rank, j, max(-2**63, min(2**63 - 1, -s)))] += 1
    return out


def test_topk_of_embeddings(spark):
    got = queries.op12_topk(spark, SF)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    rows = [(r["vec_id"], None if r["embedding"] is None else
             [np.floor(256 * float(x)) for x in r["embedding"]])
            for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert collections.Counter(map(tuple, got.collect())) == _best(rows, 50)


@pytest.mark.parametrize("block,asked,cell", [(2048, 1024, 64), (16, 8, 2), (7, 3, 1)])
def test_topk_in_many_blocks(spark, block, asked, cell):
    rng = np.random.default_rng(block)
    centres = rng.integers(-200, 200, (6, 19))
    rows = [(n, (centres[n % 6] + rng.integers(-9, 9, 19)).tolist()) for n in range(300)]
    rows += [(1000 + n, rows[0][1]) for n in range(60)]            # copies: ties
    rows += [(0, rows[5][1]), (0, rows[5][1]), (4, None), (8, [None] * 19), (12, [float("nan")] * 19),
             (16, [float("inf")] * 19), (None, rows[0][1]), (20, []), (21, []), (24, [1.0, 2.0]),
             (28, [4e12, 3e9, 7.0]), (29, [5e6, 3e9, 1.0]), (32, [0.0] * 19)]
    df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v])
                                for i, v in rows], "vec_id long, embedding array<double>")
    df = df.select("*", F.lit("x").alias("rank"), F.lit(0).alias("score")).repartition(5)
    got = topk.top_k(df, every=4, block=block, queries=asked, cell=cell, chunk=4)
    assert collections.Counter(map(tuple, got.collect())) == _best(rows, 4)
    assert topk.top_k(df.limit(0), every=4).count() == 0


def test_segment_features_bound_the_product():
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(50, 30)), rng.normal(size=(40, 30))
    bounds = [topk.segment_features(x, s) @ topk.segment_features(y, s).T for s in (1, 4, 16, 64)]
    for b in bounds:
        assert (b >= x @ y.T - 1e-9).all()
    assert np.allclose((topk.segment_features(x, 4) ** 2).sum(1), (x ** 2).sum(1))


# --- periodic runs ----------------------------------------------------------------

def _runs(w, least=12):
    """Every maximal stretch of every period, the smallest period of each."""
    found = {}
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i + p < len(w):
            if w[i] != w[i + p]:
                i += 1
                continue
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            if j + p - i >= max(least, 2 * p):
                found.setdefault((i, j + p - i), p)
            i = j
    return sorted((s, n, p) for (s, n), p in found.items())


def _digest(doc_id, text):
    w = re.findall("[^\x20\x09-\x0D]+", text or "")
    n, h = len(w), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = _runs(w)
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc_id, len(runs), *(top or (None,) * 3), 1000 * top[1] // top[2] if top else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_runs_of_documents(spark, docs):
    got = queries.op13_runs(spark, SF)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                           "runs_sha256", "collapsed_sha256"]
    got = collections.Counter(map(tuple, got.collect()))
    small = [(i, t) for i, t in docs if len((t or "").split()) <= 3000]
    want = collections.Counter(_digest(i, t) for i, t in small)
    assert len(small) > 0.9 * len(docs)
    assert sum(1 for r in want if r[1]) > 10
    assert not want - got and sum(got.values()) == len(docs)


def test_runs_of_odd_rows(spark, odd):
    got = collections.Counter(
        (r["doc_id"], tuple(map(tuple, r["runs"])), r["collapsed"])
        for r in periodic.periodic_runs(odd).collect())
    want = collections.Counter()
    for i, t in ODD:
        w = re.findall("[^\x20\x09-\x0D]+", t or "")
        runs = _runs(w[:400]) if len(w) > 400 else _runs(w)
        if len(w) > 400:
            runs = [(0, len(w), runs[0][2])]
        gone = {k for s, n, p in runs for k in range(s + p, s + n)}
        want[(i, tuple(runs), " ".join(x for k, x in enumerate(w) if k not in gone))] += 1
    assert got == want
    assert periodic.periodic_runs(odd.limit(0)).count() == 0


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(
    st.lists(st.integers(0, 2), max_size=70),
    st.builds(lambda u, k, v: (u * k)[:200] + v, st.lists(st.integers(0, 3), min_size=1, max_size=12),
              st.integers(1, 40), st.lists(st.integers(0, 3), max_size=20))), min_size=1, max_size=5),
    st.sampled_from([1, 4, 12]))
def test_runs_against_brute_force(texts, least):
    got = periodic.runs_of([np.array(t, np.int64) for t in texts], least)
    assert [[tuple(r) for r in g.tolist()] for g in got] == [_runs(t, least) for t in texts]


def test_long_periods():
    rng = np.random.default_rng(5)
    unit = rng.integers(0, 50, 900).tolist()
    text = rng.integers(0, 50, 300).tolist() + unit * 3 + unit[:77] + rng.integers(0, 50, 200).tolist()
    assert [tuple(r) for r in periodic.runs_of([np.array(text)])[0].tolist()] == _runs(text)

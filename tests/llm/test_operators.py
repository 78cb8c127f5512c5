"""Every operator against a brute-force version on small tables, and odd rows:
nulls, empty and long texts, repeats, ties, empty tables, clashing names."""

import collections
import contextlib
import hashlib
import io
import json
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from farebox.llm import (chat_format, components, exact_dedup, jaccard_join, licences, lm_score,
                         packing, quality, queries, vectors, word_codec, wrappers)
from farebox.llm.common import stored

SF = "/root/testdata/sf0.001"
LONG = "lorem ipsum dolor sit amet " * 4000
ODD = [(1, "one two three four five six"), (2, None), (3, ""), (4, LONG), (5, "a  b\n\n c"),
       (5, "a  b\n\n c"), (6, " one two three four five six"), (None, "no id"), (7, "\t\n "),
       (8, "x<|endoftext|>y É́"), (9, "a \x1c b")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string").select(
        "*", F.lit("clash").alias("score"), F.lit(1).alias("node"), F.lit(2).alias("rep"))


@pytest.fixture(scope="module")
def docs(spark):
    return [(r["doc_id"], r["text"]) for r in
            spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def test_packing(spark, odd, docs):
    tok = Tokenizer.from_file(queries.BYTE_BPE)
    table = spark.createDataFrame(docs, "doc_id long, text string")
    for df, rows in ((odd, ODD), (table, docs)):
        ids = collections.defaultdict(list)
        for i, t in rows:
            ids[i].append(tok.encode(t or "", add_special_tokens=False).ids + [0])
        out = packing.with_ids_crc32(packing.pack(df, queries.BYTE_BPE)).collect()
        used, seqs = collections.Counter(), collections.defaultdict(list)
        for r in out:
            x = ids[r["doc_id"]][0]
            assert r["doc_tokens"] == len(x)
            piece = np.array(x[r["start"]:r["start"] + r["length"]], "<u4")
            assert zlib.crc32(piece.tobytes()) == r["ids_crc32"]
            used[r["doc_id"]] += r["length"]
            seqs[r["sequence_id"]].append((r["offset"], r["length"]))
        assert used == {i: sum(map(len, x)) for i, x in ids.items()}
        for parts in seqs.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= 1024
    assert packing.pack(odd.limit(0), queries.BYTE_BPE).count() == 0


def test_differencing_is_near_equal():
    sizes = list(np.random.default_rng(1).integers(1, 256, 400))
    bins = packing.difference(sizes, 50)
    sums = [sum(sizes[n] for n in b) for b in bins]
    assert sorted(n for b in bins for n in b) == list(range(400))
    assert max(sums) - min(sums) <= 3
    assert all(sum(sizes[n] for n in b) <= 300 for b in packing.windows(sizes, 300))


def test_quality(spark, odd):
    out = queries.op2_quality(spark, "/root/testdata/sf0.01").where("held_out")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    both = out.join(labels, "doc_id").select("predicted", "quality").collect()
    assert np.mean([r[0] == r[1] for r in both]) >= 0.95
    model = quality.fit(np.zeros((0, len(quality.FEATURES))), np.zeros(0))
    rows = quality.score(odd, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    assert quality.score(odd.limit(0), model).count() == 0


def test_exact(spark, odd, monkeypatch):
    def norm(t):
        return re.sub(r"[\x20\x09-\x0d]+", " ", t or "")
    groups = collections.defaultdict(list)
    for i, t in ODD:
        groups[norm(t)].append(i)
    out = exact_dedup.exact_dedup(odd, capacity=2).collect()
    assert len(out) == len(ODD)
    want = collections.Counter()
    for t, members in groups.items():
        known = [m for m in members if m is not None]
        keep = min(known) if known else None
        for m in members:
            want[(m, keep, len(members), m == keep, hashlib.sha256(t.encode()).hexdigest())] += 1
    assert collections.Counter(map(tuple, out)) == want
    assert exact_dedup.exact_dedup(odd.limit(0)).count() == 0
    kept = exact_dedup.kept_documents(odd)
    assert kept.columns == odd.columns and kept.count() == len(groups)
    # every text is hot, or none is; chains of several texts
    for keys, rows in ((1, 10 ** 9), (10 ** 9, 0)):
        monkeypatch.setattr(exact_dedup, "HOT_KEYS", keys)
        monkeypatch.setattr(exact_dedup, "HOT_ROWS", rows)
        assert collections.Counter(map(tuple, exact_dedup.exact_dedup(odd, capacity=2).collect())) == want
    keyed = exact_dedup._keyed
    monkeypatch.setattr(exact_dedup, "_keyed", lambda *a: keyed(*a).withColumn(
        "key", F.concat(F.substring("sha256", 1, 1), F.lit("000"))))
    rows, index = exact_dedup.build_index(odd, capacity=2)
    assert 1 < index.agg(F.max(F.size("chain"))).first()[0] and index.count() < len(groups)
    assert collections.Counter(map(tuple, exact_dedup.exact_dedup(odd, capacity=2).collect())) == want
    assert exact_dedup.kept_documents(odd, capacity=2).count() == len(groups)
    names = index.columns
    assert names == ["bucket", "key", "rows", "chain"]


def test_owners_hold_whole_buckets(spark):
    """The grouping of texts follows the exchange by bucket without one of its own."""
    df = spark.range(500).select(F.col("id").alias("doc_id"), F.concat(F.lit("t "), F.col("id") % 300).alias("text"))
    plans = []

    def look(out, name):
        if name == "exact-index":
            text = io.StringIO()
            with contextlib.redirect_stdout(text):
                out.explain()
            plans.append(text.getvalue())
        return stored(out, name)

    patch = pytest.MonkeyPatch()
    with patch.context() as m:
        m.setattr(exact_dedup, "stored", look)
        rows, index = exact_dedup.build_index(df, capacity=20)
    assert "SortAggregate" not in plans[0]
    owners = plans[0].split("Union")[1].split("BroadcastExchange")[0]
    assert owners.count("Exchange hashpartitioning(bucket") == owners.count("Exchange ") == 1
    sizes = index.groupBy("bucket").agg(F.sum(F.size("chain")).alias("n")).collect()
    assert len(sizes) > 10 and max(r["n"] for r in sizes) <= 20


def test_directory_splits_only_overfull_buckets():
    depth, table = exact_dedup.directory({0: 5, 1: 5, 2: 1, 3: 1}, 2, 5)
    assert (depth, table) == (2, [0, 1, 2, 2])


def _jaccard(rows):
    sets = []
    for i, t in rows:
        w = (t or "").split()
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))
    links = [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] is None or rows[b][0] is None or not sets[a] or not sets[b]:
                continue
            inter = len(sets[a] & sets[b])
            if 5 * inter >= 4 * (len(sets[a]) + len(sets[b]) - inter):
                links[a] += 1
                links[b] += 1
                x, y = root[a], root[b]
                root = [x if r == y else r for r in root]
    low = {}
    for k, r in enumerate(root):
        low[r] = min(low.get(r, rows[k][0]), rows[k][0]) if rows[k][0] is not None else None
    return collections.Counter((rows[k][0], low[root[k]], links[k]) for k in range(len(rows)))


def test_jaccard(spark, odd, docs):
    table = spark.createDataFrame(docs, "doc_id long, text string")
    for df, rows in ((odd, ODD), (table, docs)):
        got = collections.Counter(map(tuple, jaccard_join.jaccard_join(df, block=8).collect()))
        assert got == _jaccard(rows)
    assert jaccard_join.jaccard_join(odd.limit(0)).count() == 0


def test_jaccard_recall_in_a_large_family(spark, monkeypatch):
    """Half-alike texts, split below the second level, with near copies among them: as
    many runs as the depth reached asks for."""
    runs, splits, send = [0], [], jaccard_join._children

    def children(nodes, threshold, more=None):
        if more is None:
            splits[-1] += 1
        else:
            splits.append(0)
            runs[0] += more if isinstance(more, int) else len(more)
        return send(nodes, threshold, more)

    monkeypatch.setattr(jaccard_join, "_children", children)
    rng = np.random.default_rng(5)
    common = [f"c{k}" for k in range(60)]
    rows = []
    for k in range(300):
        own = [f"w{x}" for x in rng.integers(0, 10 ** 9, 40)]
        rows += [(2 * k, " ".join(common + own)), (2 * k + 1, " ".join(common + own[:-9] + [
            f"n{k}x{j}" for j in range(9)]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: r for r in jaccard_join.jaccard_join(df, block=4).collect()}
    want = {i: low for i, low, _ in _jaccard(rows)}
    linked = [i for i, low in want.items() if low != i]
    assert len(linked) == 300
    assert sum(out[i]["class_id"] == want[i] for i in linked) >= 0.99 * len(linked)
    assert max(splits) > 2 and runs[0] >= jaccard_join.runs_for(0.99, 0.8, max(splits))


def test_jaccard_node_sizes_by_one_join_of_stored_tables(spark, monkeypatch):
    """Every set of a node of several gets the node's size, those of a very large node
    too, by one join that has nothing but two stored tables below it."""
    seen, write = [], jaccard_join.stored

    def stored(df, name):
        out = write(df, name)
        seen.append((name, df, out))
        return out

    monkeypatch.setattr(jaccard_join, "stored", stored)
    words = [f"c{k}" for k in range(60)]
    rows = [(k, " ".join([*words, f"end{k}"])) for k in range(40)]
    rows += [(100 + k, " ".join(f"w{k}x{j}" for j in range(30))) for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {tuple(r) for r in jaccard_join.jaccard_join(df, block=8).collect()} == {
        (i, 0 if i < 40 else i, 39 if i < 40 else 0) for i, _ in rows}
    joined = [(df, out) for name, df, out in seen if name == "jaccard-nodes"]
    sent = [out for name, _, out in seen if name == "jaccard-children"]
    assert joined and len(joined) == len(sent)
    for (df, out), nodes in zip(joined, sent, strict=True):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join ") == 1 and "Inner" in plan and "Aggregate" not in plan
        pairs = [(r["node"], r["rep"]) for r in nodes.collect()]
        size = collections.Counter(node for node, _ in pairs)
        assert collections.Counter((r["node"], r["rep"], r["n"]) for r in out.collect()) == \
            collections.Counter((node, rep, size[node]) for node, rep in pairs if size[node] > 1)


def test_components_with_hot_nodes(spark):
    """Stars whose centre is the smallest, a middle and the largest id, a path, and
    random edges; a star's edges are joined where they lie."""
    rng = np.random.default_rng(4)
    edges = [(0, k) for k in range(2, 3000, 2)] + [(k, 1) for k in range(2001, 4001, 2)]
    edges += [(9000, k) for k in range(5000, 6000)] + [(5500, k) for k in range(6000, 6500)]
    edges += [(k, k + 1) for k in range(20_000, 20_060)]
    edges += [tuple(map(int, e)) for e in rng.integers(30_000, 30_400, (300, 2))]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["component"] for r in components.connected_components(df).collect()}
    assert got == {x: find(x) for e in edges for x in e if e[0] != e[1] or x in got}
    both, low = components.with_lowest(df, "a", "b", df.count())
    assert both.count() == len(edges) and low.count() == len({a for a, _ in edges})
    assert components.connected_components(df.limit(0)).count() == 0


def test_vectors(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 16))
    x = np.concatenate([base, base[:20] + rng.normal(size=(20, 16)) * 0.2, base[:5] * 3, base[:5]])
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    rows += [(200, None), (201, [0.0] * 16), (202, [float("nan")] * 16), (203, [None] * 16),
             (204, []), (205, [1.0, 2.0]), (None, [1.0] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in vectors.near_vectors(df, tile=16).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = unit @ unit.T >= 0.9 
    for k in range(len(x)):
        assert got[k]["n_links"] == link[k].sum() - 1
        seen, todo = {k}, [k]
        while todo:
            for j in np.nonzero(link[todo.pop()])[0]:
                if j not in seen:
                    seen.add(int(j))
                    todo.append(j)
        assert got[k]["component_id"] == min(seen) and got[k]["kept"] == (k == min(seen))
    assert all(got[k]["n_links"] == 0 for k in (200, 201, 202, 203, 204, 205, None))
    assert vectors.near_vectors(df.limit(0)).count() == 0


@pytest.mark.parametrize("kind", ["double", "float"])
def test_vectors_in_many_tiles(spark, monkeypatch, kind):
    """Far clusters, one of them hot: tiles that lie apart never meet, and all links
    of brute force are found."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 24))
    of = np.where(rng.random(900) < 0.3, 0, rng.integers(0, 12, 900))
    x = centres[of] + rng.normal(size=(900, 24)) * rng.choice([0.1, 0.3, 0.5], (900, 1))
    x = x.astype(np.float32 if kind == "float" else np.float64).astype(np.float64)
    pairs, stored_as = [], vectors.stored

    def look(df, name):
        out = stored_as(df, name)
        if name == "vector-pairs":
            pairs.append(out.count())
        if name == "vector-tiles":
            pairs.append(out.count())
            assert {r["wide"] for r in out.collect()} == {kind == "double"}
        return out

    monkeypatch.setattr(vectors, "stored", look)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)],
                               f"vec_id long, embedding array<{kind}>").select(
        "*", F.lit("x").alias("rep"), F.lit(1).alias("no"), F.lit(2).alias("v"))
    got = {r["vec_id"]: r for r in vectors.near_vectors(df, tile=32).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = unit @ unit.T >= 0.9
    assert [got[k]["n_links"] for k in range(900)] == (link.sum(axis=1) - 1).tolist()
    tiles, met = pairs
    assert tiles > 20 and tiles <= met < tiles * (tiles + 1) // 4


def test_word_codec_of_documents(spark, docs):
    tok = Tokenizer.from_file(queries.WORD_BPE)
    got = collections.Counter(map(tuple, queries.op9_word_codec(spark, SF).collect()))
    want = collections.Counter()
    for i, t in docs:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        text = tok.decode(ids, skip_special_tokens=False)
        want[(i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
              hashlib.sha256(text.encode()).hexdigest())] += 1
    assert got == want


def test_word_codec(spark, odd):
    tok = Tokenizer.from_file(queries.WORD_BPE)
    out = word_codec.encode(odd, queries.WORD_BPE, lexicon_words=5).collect()
    want = collections.Counter()
    for i, t in ODD:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        want[(i, tuple(ids), tok.decode(ids, skip_special_tokens=False))] += 1
    assert collections.Counter((r[0], tuple(r[1]), r[2]) for r in out) == want
    words = sorted({b"tap", b"taps", b"top", b"tops"})
    auto = word_codec.minimal_automaton(words)
    assert word_codec.traverse(auto, [*words, b"ta", b""]).tolist() == [0, 1, 2, 3, -1, -1]
    assert len(auto["final"]) == 5          # t, (a|o), p, s share their suffix


def test_lm_score(spark, odd):
    out = lm_score.lm_score(odd, order=2, min_count=2, leave_own=False, chunk_words=10).collect()
    uni, bi, n = collections.Counter(), collections.Counter(), 0
    for _, t in ODD:
        w = (t or "").split()
        n += len(w)
        uni.update(w)
        bi.update(zip(w, w[1:], strict=False))
    want = collections.defaultdict(list)
    for i, t in ODD:
        w = (t or "").split()
        s = sum(np.log(uni[x] / n) if k == 0 else
                np.log(bi[w[k - 1], x] / uni[w[k - 1]]) if bi[w[k - 1], x] >= 2 else
                np.log(0.4 * uni[x] / n) for k, x in enumerate(w))
        want[i].append((len(w), s))
    for r in out:
        assert any(r["n_words"] == c and abs(r["log_score"] - s) < 1e-6 for c, s in want[r["doc_id"]])
    assert len(out) == len(ODD) and lm_score.lm_score(odd.limit(0)).count() == 0


def _backoff(rows, order, leave_own):
    """Stupid backoff by plain counters, each row scored by the others' counts."""
    def grams(w):
        return collections.Counter(tuple(w[k:k + n]) for n in range(1, order + 1)
                                   for k in range(len(w) - n + 1))
    texts = [(i, (t or "").split()) for i, t in rows]
    total = sum((grams(w) for _, w in texts), collections.Counter())
    words = sum(len(w) for _, w in texts)
    out = []
    for i, w in texts:
        own = grams(w) if leave_own else {}
        count = lambda g: total[g] - own.get(g, 0)
        s = 0.0
        for k in range(len(w)):
            for n in range(min(order, k + 1), 0, -1):
                g = tuple(w[k + 1 - n:k + 1])
                if n == 1:
                    s += np.log(max(count(g), 1) / max(words - len(w) * leave_own, 1))
                elif count(g) >= 1:
                    s += np.log(count(g) / count(g[:-1]))
                    break
                else:
                    s += np.log(0.4)
        out.append((i, len(w), s))
    return out


@pytest.mark.parametrize("leave_own,order", [(True, 3), (False, 3), (True, 4), (True, 1)])
def test_lm_score_of_documents(spark, odd, docs, leave_own, order):
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    for df, rows in ((table, docs), (odd, ODD)):
        want = collections.defaultdict(list)
        for i, n, s in _backoff(rows, order, leave_own):
            want[i].append((n, s))
        out = lm_score.lm_score(df, order=order, leave_own=leave_own, chunk_words=5000,
                                bucket_entries=3000).collect()
        assert len(out) == len(rows)
        for r in out:
            assert any(r["n_words"] == n and abs(r["log_score"] - s) < 1e-6 * max(1, abs(s))
                       for n, s in want[r["doc_id"]])
            assert (r["mean_log_score"] is None) == (r["n_words"] == 0)


def test_lm_chunks_are_dealt_out_once(spark, odd, monkeypatch):
    plans = []

    def look(df, name):
        df.collect()
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            df.explain()
        plans.append(out.getvalue().split("Initial Plan")[0])
        return stored(df, name)

    monkeypatch.setattr(lm_score, "stored", look)
    lm_score.lm_score(odd)
    assert plans[0].count("MapInArrow pack") == 1 and "ReusedExchange" in plans[0]


def test_wrappers(spark):
    page = ("<html><head><title>t</title><script>var a='<p>no</p>'</script></head><body>"
            "<div class='cookie-notice'>We use cookies</div><nav><a href=/>Home</a></nav>"
            "<article><h1>T{n}</h1><p>A &amp; b{n}<br>c  d<p>E<ul><li>x<li>y</ul></article>"
            "<div id=comments><article class=comment><p>nice</p></article></div>"
            "<aside>s</aside><form>q</form><footer>f</footer>{end}")
    rows = [(n, f"http://h.example/{n}", page.format(n=n, end="</body></html>" * (n % 2)))
            for n in range(6)] + [(6, None, None), (7, "nonsense", ""), (None, "http://h.example", "<p>x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in wrappers.extract_pages(df).collect()}
    for n in range(6):
        assert got[n] == f"T{n}\n\nA & b{n} c d\n\nE\n\nx\n\ny"
    assert got[6] == got[7] == "" and got[None] == "x"
    assert wrappers.extract_pages(df.limit(0)).count() == 0
    clash = df.select("*", F.lit("x").alias("host"), F.lit("y").alias("text"), F.lit(1).alias("menus"),
                      F.lit(2).alias("n"), F.lit(3).alias("slot"))
    assert {r["page_id"]: r["text"] for r in wrappers.extract_pages(clash).collect()} == got


def _host_texts(spark, htmls):
    rows = [(n, f"http://host.example/{n}", h) for n, h in enumerate(htmls)]
    out = wrappers.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string"))
    return [r["text"] for r in sorted(out.collect())]


def test_shared_openings_stay(spark):
    opening = "The same standard intro of some length opens the story here. " * 5
    pages = [f"<div class='article'><p>{opening} Tail {n}.</p><p>Own words {n}</p></div>"
             for n in range(12)]
    assert _host_texts(spark, pages) == [
        f"{opening.strip()} Tail {n}.\n\nOwn words {n}" for n in range(12)]


def test_names_inside_articles(spark):
    page = ("<article><p>The <b class='side'>left side</b> of it {n}</p><h2 id='related'>Related work"
            " {n}</h2><div class='side-effects'>Effects {n}</div><div class='legal'>Law {n}</div>"
            "<div class='ad'>Buy</div><div class='related-posts'><a href=/>Other {n}</a></div>"
            "<p class='share'>Share this</p></article><div class='story'>More {n}</div>"
            "<div class='footer-links'>End</div><p>Loose</p>")
    assert _host_texts(spark, [page.format(n=n) for n in range(5)]) == [
        f"The left side of it {n}\n\nRelated work {n}\n\nEffects {n}\n\nLaw {n}\n\nMore {n}"
        for n in range(5)]


def test_fixed_lines_go_inside_and_outside_of_articles(spark):
    line = "Get our letter every Monday"
    inside = [f"<article><p>Text {n}</p><p>{line}</p></article>" for n in range(12)]
    assert _host_texts(spark, inside) == [f"Text {n}" for n in range(12)]
    outside = [f"<div><p>Text {n}</p><p>{line}</p></div>" if n % 2 else f"<div><p>Text {n}</p></div>"
               for n in range(12)]
    assert _host_texts(spark, outside) == [f"Text {n}" for n in range(12)]
    # copies of one page are one page, and a page of fixed texts only keeps them
    copies = ["<article><p>The whole story</p></article>"] * 20
    assert _host_texts(spark, copies) == ["The whole story"] * 20
    few = [f"<article><p>Text {n}</p><p>Said by many</p></article>" if n < 8 else
           f"<article><p>Text {n}</p></article>" for n in range(12)]
    assert _host_texts(spark, few)[0] == "Text 0\n\nSaid by many"


def test_menus_are_learnt_from_the_host(spark):
    page = ("<div class='x'><a href=1>One</a> <a href=2>Two {n}</a></div><div class='y'><p>Prose {n} "
            "with <a href=3>a link</a> in it</p></div>")
    assert _host_texts(spark, [page.format(n=n) for n in range(6)]) == [
        f"Prose {n} with a link in it" for n in range(6)]


def test_deep_wide_and_long_pages(spark):
    import time
    deep = ["<div>" * 3000 + "deep" + "</div>" * 3000, "<b>" * 3000 + "bold", "<a href=x>" * 3000 + "link",
            "<div><b>" * 2000 + "mixed" + "</x>" * 2000, "<ul><li>" * 1500 + "list"]
    wide = "<article>" + "".join(f"<h2>H{k}</h2><p>P{k}</p>" for k in range(4000)) + "</article>"
    long = "<article><p>" + "word " * 400_000 + "</p></article>"
    began = time.time()
    assert _host_texts(spark, [*deep, wide, long]) == [
        "deep", "bold", "link", "mixed", "list",
        "\n\n".join(f"H{k}\n\nP{k}" for k in range(4000)), ("word " * 400_000).strip()]
    assert time.time() - began < 60
    wrapper = wrappers.infer([*deep, wide, wide])
    assert "(<article>(<h2>#</><p>#</>)+</>)?" in wrappers.expression(wrapper)


def test_alignment():
    f, a = wrappers.fold, wrappers.align
    assert f([1, 1, 2, 3, 2, 4]) == [[1], [2, 3], [4]] and f([]) == []
    assert f([1, 2, 1, 3, 2]) == [[1, 2, 3]]
    assert a([[1], [2]], [[1], [3], [2]]) == [[1], [3], [2]]
    assert a([[1], [2], [3]], [[2], [4]]) == [[1], [2], [4], [3]]
    assert a([[1], [2], [3], [4]], [[1], [3], [2], [4]]) == [[1], [2, 3], [4]]
    assert a([[1], [2], [3]], [[1, 2]]) == [[1, 2], [3]]
    assert a([[1, 2], [3]], [[1], [2], [5]]) == [[1, 2], [5], [3]]
    assert a([[1], [2], [3]], [[3], [1], [2]]) == [[1, 2, 3]]
    pages = ["<ul><li>a<li>b</ul><p>x</p>", "<ul><li>a</ul><h2>t</h2><p>x</p>"]
    assert wrappers.expression(wrappers.infer(pages)) == (
        "<#root><ul>(<li>#</>)+</>(<h2>#</>)?<p>#</></>")


def test_order_of_pages_does_not_change_groups():
    import itertools
    pages = ["<p>a<ul><li>x</ul>", "<h1>t</h1><p>b", "<ul><li>y</ul><p>c", "<p>d<h2>e</h2><p>f"]
    seen = set()
    for order in itertools.permutations(pages):
        w = wrappers.infer(order)
        seen.add(tuple(sorted((g[0], g[1], *g[2:8]) for g in w.values())))
    assert len(seen) == 1


def test_chat(spark):
    tools = {"tools": [{"name": "add", "parameters": {
        "properties": {"a": {"type": "integer"}, "b": {"type": "number"}}, "required": ["a"]}}]}
    call = lambda i, args: json.dumps({"tool_calls": [
        {"id": i, "name": "add", "arguments": args}]})
    rows = [(1, 0, "system", json.dumps(tools)), (1, 1, "tool", '{"tool_call_id": "x", "content": 3}'),
            (1, 2, "assistant", call("x", {"b": 2.5, "a": 1})), (1, 3, "assistant", call("y", {"b": 1})),
            (1, 4, "tool", '{"tool_call_id": "z"}'), (2, 0, "user", None), (None, None, None, "hi"),
            (2, 1, "user", "{broken")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat_format.format_chat(df).collect()
    got = {(r["conv_id"], r["turn"]): r for r in out}
    assert len(out) == len(rows)
    assert (got[1, 1]["order_turn"], got[1, 1]["order_rank"], got[1, 1]["linked"]) == (2, 1, True)
    assert (got[1, 2]["n_calls"], got[1, 2]["calls_valid"]) == (1, 1)
    assert (got[1, 3]["n_calls"], got[1, 3]["calls_valid"]) == (1, 0)
    assert got[1, 4]["linked"] is False
    assert json.loads(json.loads(got[1, 2]["message"])["content"])["tool_calls"][0]["arguments"] == {
        "a": 1, "b": 2.5}
    assert json.loads(got[2, 0]["message"]) == {"content": None, "role": "user"}
    assert chat_format.format_chat(df.limit(0)).count() == 0


def _meets_schema(v, s):
    """A plain checker of the same part of JSON Schema."""
    if not isinstance(s, dict):
        return True
    kind = ("null" if v is None else "boolean" if isinstance(v, bool) else
            "integer" if isinstance(v, int) else "number" if isinstance(v, float) else
            "string" if isinstance(v, str) else "array" if isinstance(v, list) else "object")
    if "type" in s:
        types = s["type"] if isinstance(s["type"], list) else [s["type"]]
        if kind not in types and not (kind == "integer" and "number" in types):
            return False
    if "enum" in s and not any(type(e) is type(v) and e == v for e in s["enum"]):
        return False
    if kind == "object":
        props, more = s.get("properties"), s.get("additionalProperties")
        if any(k not in v for k in s.get("required", [])):
            return False
        if props is not None and not more and any(k not in props for k in v):
            return False
        return all(_meets_schema(x, (props or {}).get(k, more)) for k, x in v.items())
    return kind != "array" or all(_meets_schema(x, s.get("items")) for x in v)


def _chat(rows):
    """Counts, links and order of messages by plain loops."""
    def held(t):
        try:
            x = json.loads(t) if t and t.lstrip().startswith("{") else None
        except ValueError:
            x = None
        return x if isinstance(x, dict) else {}

    tools, first = {}, {}
    for c, n, role, t in sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[3] or "")):
        for tool in held(t).get("tools", []) if role == "system" else []:
            tools[c, tool["name"]] = tool.get("parameters")
        for call in held(t).get("tool_calls", []) if role == "assistant" else []:
            first.setdefault((c, call["id"]), n)
    out = collections.Counter()
    for c, n, role, t in rows:
        x = held(t)
        calls = x.get("tool_calls", []) if role == "assistant" else []
        good = 0
        for call in calls:
            schema = tools.get((c, call["name"])) if c is not None else None
            args = call["arguments"]
            if isinstance(args, str):
                args = json.loads(args) if args.startswith("{") else None
            good += schema is None or isinstance(args, dict) and _meets_schema(args, schema)
        answer = x.get("tool_call_id") if role == "tool" else None
        linked = None if answer is None else c is not None and (c, answer) in first
        turn = max(n, first[c, answer]) if linked else n
        out[c, n, role, turn, int(bool(linked)), len(calls), good, linked] += 1
    return out


def test_chat_schemas(spark):
    schema = {"type": "object", "required": ["city"], "properties": {
        "city": {"type": "string"}, "unit": {"type": "string", "enum": ["C", "F"]},
        "day": {"type": ["string", "null"]}, "box": {"type": "object", "required": ["x"], "properties": {
            "x": {"type": "integer"}, "deep": {"type": "array", "items": {
                "type": "object", "properties": {"k": {"enum": [1, "1", None]}}}}}},
        "tags": {"type": "array", "items": {"type": "string"}}, "free": {"type": "object"},
        "map": {"type": "object", "properties": {}, "additionalProperties": {"type": "number"}}}}
    cases = [({"city": "a"}, True), ({"city": "a", "unit": "K"}, False), ({"city": "a", "unit": "C"}, True),
             ({"city": "a", "day": None}, True), ({"city": "a", "day": 3}, False), ({}, False),
             ({"city": "a", "box": {"x": "1"}}, False), ({"city": "a", "box": {"x": 1}}, True),
             ({"city": "a", "box": {}}, False), ({"city": "a", "box": {"x": 1, "y": 2}}, False),
             ({"city": "a", "tags": ["b", 1]}, False), ({"city": "a", "tags": ["b"]}, True),
             ({"city": "a", "box": {"x": 1, "deep": [{"k": 1}, {"k": 2}]}}, False),
             ({"city": "a", "box": {"x": 1, "deep": [{"k": "1"}, {"k": None}]}}, True),
             ({"city": "a", "free": {"q": [{}]}}, True), ({"city": "a", "map": {"z": 1.5, "y": 2}}, True),
             ({"city": "a", "map": {"z": "1"}}, False), ({"city": "a", "zip": 1}, False),
             (json.dumps({"city": "a"}), True), ([1], False), (None, False)]
    rows = [(1, 0, "system", json.dumps({"tools": [{"name": "w", "parameters": schema}, {"name": "v"}]}))]
    rows += [(1, n + 1, "assistant", json.dumps({"tool_calls": [
        {"id": f"c{n}", "name": "w", "arguments": a}]})) for n, (a, _) in enumerate(cases)]
    rows += [(1, 99, "assistant", json.dumps({"tool_calls": [{"id": "v", "name": "v", "arguments": {"a": 1}}]}))]
    rows += [rows[2], rows[2], rows[3]]                       # rows that occur again
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").select(
        "*", F.lit("x").alias("valid"), F.lit("y").alias("message"), F.lit(1).alias("key"))
    out = chat_format.format_chat(df).collect()
    got = collections.Counter((r["turn"], r["n_calls"], r["calls_valid"]) for r in out)
    want = collections.Counter([(0, 0, 0), (99, 1, 1)] + [
        (t, 1, int(cases[t - 1][1])) for _, t, role, _ in rows if role == "assistant" and t < 99])
    assert got == want


def test_chat_against_plain_loops(spark):
    rng = np.random.default_rng(8)
    pick = lambda *x: x[rng.integers(len(x))]

    def schema(depth):
        kind = pick("string", "integer", "number", "boolean", ["string", "null"], "object", "array")
        if depth and kind == "object":
            names = [k for k in "abc" if rng.random() < 0.6]
            return {"type": "object", "properties": {k: schema(depth - 1) for k in names},
                    "required": [k for k in names if rng.random() < 0.4]}
        if depth and kind == "array":
            return {"type": "array", "items": schema(depth - 1)}
        return {"type": kind} if rng.random() < 0.9 else {"enum": ["a", 1, True, None]}

    def value(s, depth):
        kind = s.get("type", "string") if rng.random() < 0.95 else pick("string", "integer", "object")
        kind = pick(*kind) if isinstance(kind, list) else kind
        if kind == "object":
            return {k: value(t, depth - 1) for k, t in s.get("properties", {}).items()
                    if rng.random() < 0.8} | ({"zz": 1} if rng.random() < 0.05 else {})
        if kind == "array":
            return [value(s.get("items", {}), depth - 1) for _ in range(rng.integers(3))]
        return {"string": pick("a", "b"), "integer": 1, "number": 2.5, "boolean": True,
                "null": None}[kind]

    rows = []
    for conv in [*range(25), None]:
        schemas = {t: schema(3) | {"type": "object"} for t in "uv"}
        rows.append((conv, 0, "system", json.dumps({"tools": [
            {"name": t, "parameters": s} for t, s in schemas.items()]})))
        for turn in range(1, 30):
            ident = f"c{rng.integers(12)}"
            rows.append((conv, turn, *pick(
                ("user", "hello"), ("user", None), ("user", "{no json"), ("assistant", '{"x": 1}'),
                ("tool", json.dumps({"tool_call_id": ident, "content": [1]})),
                *[("assistant", json.dumps({"tool_calls": [
                    {"id": f"c{rng.integers(12)}", "name": t, "arguments": value(schemas.get(t, {}), 3)}
                    for t in [pick("u", "v", "w") for _ in range(rng.integers(1, 4))]]}))] * 3)))
            if rng.random() < 0.2:
                rows.append(rows[-1])
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    out = chat_format.format_chat(df).drop("message").collect()
    got = collections.Counter(tuple(r[c] for c in (
        "conv_id", "turn", "role", "order_turn", "order_rank", "n_calls", "calls_valid", "linked")) for r in out)
    want = _chat(rows)
    assert got == want
    valid = sum(k[6] * n for k, n in want.items())
    assert 100 < valid < sum(k[5] * n for k, n in want.items()) - 50


def test_licences(spark):
    rows = [(1, "prose of no matter\nReleased under the MIT License.\n"), (2, None), (3, ""),
            (4, "Licensed under the Apache License, Version 2.0."), (5, "he lost his license today"),
            (6, "Licensed under CC BY-NC 4.0."), (4, "plain words only and nothing else here")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("family", F.lit(1))
    got = {(r["doc_id"], r["paragraph"], r["family"]) for r in licences.scan(df).collect()}
    assert got == {(1, 1, "mit"), (4, 0, "apache"), (6, 0, "cc-by-nc")}


NOTICES = {"Licensed under the Apache License, Version 2.0": "apache",
           "Released under the MIT License": "mit", "Licensed under CC BY-NC 4.0": "cc-by-nc",
           "This work is licensed under the GNU General Public License, version 3": "gpl",
           "All rights reserved": "proprietary"}


def test_licences_of_whole_documents(spark):
    """Against a scan of all lines for the five forms; forms without a cue of old."""
    sf = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    more = spark.createDataFrame([(-1, "Released under CC-BY-SA 4.0"), (-2, "All rights reserved."),
                                  (-2, "All rights reserved."), (-3, "all the rights of the road")],
                                 "doc_id long, text string")
    want = collections.Counter({(-1, 0, "cc-by-sa"): 1, (-2, 0, "proprietary"): 2})
    for i, text in sf.collect():
        for k, line in enumerate((text or "").split("\n")):
            for form, family in NOTICES.items():
                if form in line:
                    want[i, k, family] += line.count(form)
    assert {f for _, _, f in want} >= set(NOTICES.values())
    out = licences.scan(sf.union(more)).collect()
    assert collections.Counter((r["doc_id"], r["paragraph"], r["family"]) for r in out) == want


def test_licence_cues_let_all_pass_that_can_be_confirmed():
    for own in licences.OWN:
        least = next(k for k in range(len(own) + 1) if k / len(own) >= licences.CONFIRMED)
        assert len(set(own) - set(licences.CUES)) < least


def test_licences_in_wrapped_and_in_long_lines(spark):
    gpl = next(t for f, t in licences.TEMPLATES if t.startswith("This program is free"))
    wrapped = gpl.replace("under the ", "under the\n")
    prose = " ".join(f"ord{k % 97}na the" for k in range(3000))
    rows = [(1, f"x y\n\n{wrapped}\n\nend"), (2, f"{prose} {gpl} {prose}"), (3, prose),
            (4, f"{prose} Released under the MIT License. {prose} All rights reserved. {prose}"),
            (5, "prose of the matter\nReleased under the\nMIT License.")]
    out = licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["paragraph"], r["family"]) for r in out) == [
        (1, 2, "gpl"), (2, 0, "gpl"), (4, 0, "mit"), (4, 0, "proprietary"), (5, 1, "mit")]
    assert {r["body"] for r in out if r["doc_id"] == 1} == {wrapped}


def test_pipeline(spark):
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), SF).count() == 0
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_pipeline_against_brute_force(spark, docs):
    """Every stage's decisions by plain code, and all that is left packed once."""
    import corpus_pipeline
    table = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.train(table, spark.read.parquet(f"{SF}/labels.parquet"))
    x = np.array([quality.statistics(t or "") for _, t in docs], float)
    left = [d for d, s in zip(docs, model.score(x), strict=True) if s >= 0.5]
    assert 0 < len(left) < len(docs)
    first = {}
    for i, t in sorted(left):
        first.setdefault(re.sub(r"[\x20\x09-\x0d]+", " ", t or ""), i)
    unique = [(i, t) for i, t in left if i in set(first.values())]
    classes = {i: low for i, low, _ in _jaccard(unique)}
    kept = [(i, t) for i, t in unique if classes[i] == i]
    assert len(kept) < len(unique) < len(left)
    tok = Tokenizer.from_file(queries.BYTE_BPE)
    want = {i: [*tok.encode(t or "", add_special_tokens=False).ids, 0] for i, t in kept}
    used, seqs = collections.defaultdict(list), collections.defaultdict(list)
    for r in corpus_pipeline.run(spark, SF).collect():
        ids = want[r["doc_id"]]
        piece = ids[r["start"]:r["start"] + r["length"]]
        assert len(piece) == r["length"] and r["doc_tokens"] == len(ids)
        assert zlib.crc32(np.array(piece, "<u4").tobytes()) == r["ids_crc32"]
        used[r["doc_id"]].append((r["start"], r["length"]))
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(used) == set(want)
    for parts, size in [*((used[i], len(ids)) for i, ids in want.items()),
                        *((p, sum(n for _, n in p)) for p in seqs.values())]:
        at = 0
        for start, n in sorted(parts):
            assert start == at
            at += n
        assert at == size
    assert all(sum(n for _, n in p) <= 1024 for p in seqs.values())


def test_which_operators_have_sql():
    import __spark_entry__ as entry
    ours = {*queries.QUERIES, "pipeline"}
    assert ours <= set(entry.queries())
    assert ours & set(entry.oracle_sql()) == {"op8_exact_dedup", "op12_topk"}

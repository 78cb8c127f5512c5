"""Jaccard similarity join of word n-gram sets by chosen paths.

Documents with the same set of word shingles are one representative. Each
representative has a minhash sketch; a token is a (coordinate, value) pair of it,
and two sets share a token with their Jaccard similarity as probability. A run
starts with all sets in one node and splits them by a coordinate of its own. A
node below samples coordinates, each with probability 1 / (threshold x
coordinates), and sends a set along each of them to the child named by its value. Nodes that hold few sets are compared by brute
force; larger ones are split again, and what is still large at the last level is
compared in blocks, so nothing is dropped; so is a child that holds most of a
large node, whose sets are then too alike to be split. As many independent runs are made as
the target recall needs two splits below the first; they are rows of the same jobs. Sets of
nodes that are split more often run again, until their runs suffice for the depth reached.

The comparison of sketches is lenient and yields groups of candidates. Within a
group all sets are then rebuilt from the texts and compared exactly, block by
block; only counts and a spanning set of links leave a block.
"""

from __future__ import annotations

import hashlib
import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import local_roots, mix64, per_worker, small_arrow_batches, stored
from farebox.llm.components import connected_components

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.99
COORDS = 128
BLOCK = 256              # sets that are compared at once
BLOCK_SHINGLES = 4_000_000   # shingles of them, about, when whole sets are compared
LEVELS = 12              # splits before the rest is compared in blocks
DENSE = 0.6              # share of a node in one child that makes splitting pointless
LENIENT = 0.15           # by how much a sketch may fall short of the threshold
WORD_CACHE = 400_000


def _numbers(words: list[str]) -> np.ndarray:
    """A 64-bit number for each word, the same everywhere."""
    import xxhash
    known = per_worker("word_numbers", dict)
    if len(known) > WORD_CACHE:
        known.clear()
    for w in set(words).difference(known):
        known[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def shingles(text: str, size: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit numbers of the runs of ``size`` words (words are
    parted by white space); a text of fewer words is one run, an empty one none."""
    words = text.split()
    if not words:
        return np.empty(0, np.uint64)
    x = _numbers(words)
    size = min(size, len(words))
    out = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + x[k:len(x) - size + 1 + k])
    return np.unique(out)


def sketch(x: np.ndarray, coords: int = COORDS) -> np.ndarray:
    """Minimum of each of ``coords`` random orders, 32 bits each."""
    rng = np.random.default_rng(7)
    mul = rng.integers(1, 2 ** 63, coords, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.integers(0, 2 ** 63, coords, dtype=np.uint64)
    low = np.full(coords, 0xFFFFFFFF, np.uint64)
    for k in range(0, len(x), 2048):
        part = (x[k:k + 2048, None] * mul + add) >> np.uint64(32)
        low = np.minimum(low, part.min(axis=0))
    return low.astype(np.uint32)


def runs_for(recall: float, threshold: float = THRESHOLD, splits: int = 2) -> int:
    """Runs after which a pair at the threshold shares, with probability
    ``recall``, a node that was split ``splits`` times below the first split: the
    children that such a pair shares are Poisson with mean 1, so q becomes
    1 - exp(-q) a level."""
    q = 1.0
    for _ in range(splits):
        q = 1 - math.exp(-q)
    return min(COORDS, math.ceil(math.log(1 - recall) / math.log(1 - threshold * q)))


def planes_of(x: np.ndarray) -> tuple[bytes, bytes]:
    """A sketch as its lowest bytes, which are enough to compare two of them
    leniently, and the others."""
    b = x.astype("<u4").view(np.uint8).reshape(-1, 4)
    return b[:, 0].tobytes(), b[:, 1:].tobytes()


def from_planes(low: list[bytes], high: list[bytes]) -> np.ndarray:
    """Sketches as rows of numbers."""
    b = np.empty((len(low), COORDS, 4), np.uint8)
    b[..., 0] = np.frombuffer(b"".join(low), np.uint8).reshape(len(low), COORDS)
    b[..., 1:] = np.frombuffer(b"".join(high), np.uint8).reshape(len(low), COORDS, 3)
    return b.view("<u4")[..., 0]


def _set_key(packed: bytes) -> bytes:
    return hashlib.blake2b(packed, digest_size=16).digest()


def _sets(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(doc_id, set_key, low, high, shingles) of every row, the sketch in two parts;
    null set_key without words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, keys, lows, highs, sizes = [], [], [], [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                x = shingles(t.as_py() or "", size)
                ids.append(i)
                sizes.append(len(x))
                keys.append(_set_key(x.tobytes()) if len(x) else None)
                low, high = planes_of(sketch(x)) if len(x) else (None, None)
                lows.append(low)
                highs.append(high)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(keys, pa.binary()),
                 pa.array(lows, pa.binary()), pa.array(highs, pa.binary()),
                 pa.array(sizes, pa.int64())],
                names=["doc_id", "set_key", "low", "high", "shingles"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(
        run, "doc_id long, set_key binary, low binary, high binary, shingles long")


def _children(nodes: DataFrame, threshold: float, runs: range | None = None) -> DataFrame:
    """Send each (node, rep, n, low, high) to its children; to start, the roots of ``runs``.
    Children know the size of the node they come from."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coords = np.arange(COORDS, dtype=np.uint64)
        limit = np.uint64(int(2 ** 64 / (threshold * COORDS)))
        for b in batches:
            if not len(b):
                continue
            reps = b.column("rep").to_numpy()
            sk = from_planes(b.column("low").to_pylist(), b.column("high").to_pylist())
            roots = ([(r, np.full(len(b), r + 1, np.uint64)) for r in runs] if runs else
                     [(0, b.column("node").to_numpy().view(np.uint64))])
            node, who = [], []
            for at, root in roots:
                if runs:
                    row, c = np.arange(len(b)), np.full(len(b), at)
                else:
                    picks = mix64(mix64(root)[:, None] + coords * np.uint64(0x9E3779B97F4A7C15))
                    row, c = np.nonzero(picks < limit)
                token = (sk[row, c].astype(np.uint64) << np.uint64(8)) + c.astype(np.uint64)
                node.append(mix64(mix64(root[row] + np.uint64(1)) ^ mix64(token)))
                who.append(row)
            who = np.concatenate(who)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(node).view(np.int64)), pa.array(reps[who]),
                 b.column("n").take(pa.array(who))], names=["node", "rep", "parent_n"])

    cols = ["rep", "n", "low", "high"] if runs else ["node", "rep", "n", "low", "high"]
    return nodes.select(*cols).mapInArrow(run, "node long, rep long, parent_n long")


def in_blocks(members: DataFrame, payload: str, block: int) -> DataFrame:
    """Blocks of a grouped table: (grp, part, n_parts, reps, payloads).

    ``members`` has grp, rep, n (size of the group) and the payload. A group of
    up to ``block`` rows is one block, a larger one several by a hash of rep; long
    payloads make n larger, see ``_links_within``."""
    parts = F.ceil(F.col("n") / block)
    return (members.withColumn("n_parts", parts.cast("int"))
            .withColumn("part", F.pmod(F.xxhash64("rep", F.lit(3)), "n_parts").cast("int"))
            .groupBy("grp", "part", "n_parts")
            .agg(F.collect_list(F.struct("rep", payload)).alias("m"))
            .select("grp", "part", "n_parts", F.col("m.rep").alias("reps"),
                    F.col(f"m.{payload}").alias("payloads")))


def compare_blocks(blocks: DataFrame, compare, schema: str, payload_type) -> DataFrame:
    """Every block against itself and, within its group, against each other block
    once. ``compare(reps, payloads, reps2 | None, payloads2)`` gives columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(len(b)):
                r = b.slice(k, 1).to_pylist()[0]
                out = compare(np.array(r["reps"], np.int64), r["payloads"],
                              None if r["reps2"] is None else np.array(r["reps2"], np.int64),
                              r["payloads2"])
                if out is not None:
                    yield out

    none = F.lit(None)
    alone = blocks.select("reps", "payloads", none.cast("array<bigint>").alias("reps2"),
                          none.cast(payload_type).alias("payloads2"))
    several = blocks.where("n_parts > 1")
    sent = several.select(
        "grp", "reps", "payloads",
        # part i meets i+1, i+2, ... half way round, so each pair of parts meets once
        F.explode(F.expr(
            "transform(filter(sequence(1, n_parts div 2),"
            " d -> 2 * d < n_parts or part < d), d -> (part + d) % n_parts)")).alias("part"))
    met = sent.join(several.select("grp", "part", F.col("reps").alias("reps2"),
                                   F.col("payloads").alias("payloads2")), ["grp", "part"])
    return alone.unionByName(met.select("reps", "payloads", "reps2", "payloads2")).mapInArrow(
        run, schema)


def _by_sketch(least: float):
    def compare(reps, sketches, reps2, sketches2):
        x = np.frombuffer(b"".join(sketches), np.uint8).reshape(len(reps), COORDS)
        y = x if reps2 is None else np.frombuffer(b"".join(sketches2), np.uint8).reshape(
            len(reps2), COORDS)
        found = []
        for k in range(0, len(x), 64):
            same = np.zeros((len(x[k:k + 64]), len(y)), np.int16)
            for c in range(COORDS):
                same += x[k:k + 64, c][:, None] == y[:, c]
            i, j = np.nonzero(same >= least * COORDS)
            found.append((i + k, j))
        i, j = (np.concatenate(z) for z in zip(*found, strict=True))
        return _spanning(reps, reps2, i, j)
    return compare


def _spanning(reps, reps2, i, j, counts=None):
    """Rows (rep, root, links) of the sets that have a link in this block."""
    if reps2 is None:
        i, j = i[i != j], j[i != j]
        names, a, b = reps, i, j
    else:
        names, a, b = np.concatenate([reps, reps2]), i, j + len(reps)
    if not len(a):
        return None
    root = local_roots(len(names), a, b)
    links = np.zeros(len(names), np.int64) if counts is None else counts
    at = np.unique(np.concatenate([a, b]))
    return pa.RecordBatch.from_arrays(
        [pa.array(names[at]), pa.array(names[root[at]]), pa.array(links[at])],
        names=["rep", "root", "links"])


def _exactly(threshold: float):
    def compare(reps, payloads, reps2, payloads2):
        first = [np.frombuffer(p[8:], np.uint64) for p in payloads]
        copies = np.array([int.from_bytes(p[:8], "little") for p in payloads], np.int64)
        both = first if reps2 is None else first + [np.frombuffer(p[8:], np.uint64)
                                                    for p in payloads2]
        if reps2 is not None:
            copies = np.concatenate([copies, [int.from_bytes(p[:8], "little")
                                              for p in payloads2]])
        sizes = np.array([len(s) for s in both])
        # common shingles of all pairs, by one multiplication of 0/1 matrices a slice
        flat, owner = np.concatenate(both), np.repeat(np.arange(len(both)), sizes)
        _, token, n = np.unique(flat, return_inverse=True, return_counts=True)
        often = n[token] > 1
        token, owner = token[often], owner[often]
        _, token = np.unique(token, return_inverse=True)
        m = len(first)
        common = np.zeros((m, len(both) if reps2 is None else len(both) - m), np.float32)
        for k in range(0, int(token.max(initial=-1)) + 1, 8192):
            hit = (token >= k) & (token < k + 8192)
            z = np.zeros((len(both), 8192), np.float32)
            z[owner[hit], token[hit] - k] = 1
            common += z[:m] @ (z if reps2 is None else z[m:]).T
        left, right = sizes[:m, None], (sizes if reps2 is None else sizes[m:])[None]
        # J >= threshold, in whole numbers: no rounding at the threshold itself
        inter = common.astype(np.int64)
        thousandths = round(threshold * 1000)
        ok = inter * 1000 >= thousandths * (left + right - inter)
        i, j = np.nonzero(ok)
        counts = np.zeros(len(both), np.int64)
        if reps2 is None:
            i, j = i[i != j], j[i != j]
            np.add.at(counts, i, copies[j])
        else:
            np.add.at(counts, i, copies[j + m])
            np.add.at(counts, j + m, copies[i])
        return _spanning(reps, reps2, i, j, counts)
    return compare


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 size: int = WORDS, threshold: float = THRESHOLD, recall: float = RECALL,
                 block: int = BLOCK, levels: int = LEVELS) -> DataFrame:
    """One row per input row: doc_id, class_id (smallest id reachable by links of
    at least ``threshold``), n_links (other rows linked directly).

    Rows without words (null, empty) link with nothing, and so do rows without an
    id. Rows that repeat an id are all counted as copies. An empty table gives
    none. Other columns are ignored."""
    spark = docs.sparkSession
    small_arrow_batches(spark)
    sets = stored(_sets(docs, id_col, text_col, size), "jaccard-sets")
    usable = F.col("doc_id").isNotNull() & F.col("set_key").isNotNull()
    reps = stored(sets.where(usable).groupBy("set_key").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"),
        F.min("low").alias("low"), F.min("high").alias("high"),
        F.min("shingles").alias("shingles")), "jaccard-reps")

    edges, some = None, reps
    # splits below the first that the runs made so far allow for
    made, wanted, depth = 0, runs_for(recall, threshold), 2
    while made < wanted:
        nodes = _children(some.withColumn("n", F.lit(2 ** 62)), threshold, range(made, wanted))
        deep = None
        for level in range(levels):
            nodes = stored(nodes, "jaccard-children")
            # stored: of a join of two stored tables Spark splits the keys with very many rows
            sizes = stored(nodes.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1"),
                           "jaccard-sizes")
            # sketches are fetched where they are used, not kept with every node
            members = stored(nodes.join(sizes, "node"), "jaccard-nodes")
            last = level == levels - 1
            ends = (F.col("n") <= block) | (F.col("n") >= F.col("parent_n") * DENSE) | F.lit(last)
            here = members.where(ends).join(reps.select("rep", "low"), "rep")
            found = compare_blocks(
                in_blocks(here.withColumnRenamed("node", "grp"), "low", block),
                _by_sketch(threshold - LENIENT), "rep long, root long, links long", "array<binary>")
            found = found.select("rep", "root").distinct()
            edges = found if edges is None else edges.union(found)
            large = members.where(~ends)
            if last or large.isEmpty():
                break
            if level >= 2:                     # deeper than the first runs allow for
                depth = max(depth, level + 1)
                deep = large.select("rep") if deep is None else deep.union(large.select("rep"))
            nodes = _children(large.join(reps.select("rep", "low", "high"), "rep"), threshold)
        if deep is None:
            break
        # both sets of a pair that such a node parts are in it: they alone run again
        made, wanted = wanted, runs_for(recall, threshold, depth)
        if made < wanted:
            some = stored(reps.join(deep.distinct(), "rep", "left_semi"), "jaccard-deep")
    groups = stored(connected_components(edges, "rep", "root"), "jaccard-groups")

    exact = _links_within(docs, id_col, text_col, size, threshold, reps, groups, block)
    classes = connected_components(exact, "rep", "root")
    links = exact.groupBy("rep").agg(F.sum("links").alias("links"))
    per_set = (reps.join(classes.withColumnRenamed("node", "rep"), "rep", "left")
               .join(links, "rep", "left")
               .select("set_key", F.coalesce("component", "rep").alias("class_id"),
                       (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    of_doc = sets.where(usable).select("doc_id", "set_key").join(per_set, "set_key")
    return of_doc.select("doc_id", "class_id", "n_links").union(
        sets.where(~usable).select("doc_id", "doc_id", F.lit(0).cast("long")))


def _links_within(docs, id_col, text_col, size, threshold, reps, groups, block) -> DataFrame:
    """Exact links between the sets of each candidate group, stored. A group counts
    as larger if its sets are long, so that a block holds neither too many sets nor
    too many shingles."""
    weight = F.greatest(F.count(F.lit(1)), F.ceil(F.sum("shingles") * block / BLOCK_SHINGLES))
    named = groups.withColumnRenamed("node", "rep").join(
        reps.select("rep", "copies", "set_key", "shingles"), "rep")
    chosen = (named.drop("shingles")
              .join(named.groupBy("component").agg(weight.alias("n")), "component"))
    texts = docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for r in b.to_pylist():
                packed = shingles(r["text"] or "", size).tobytes()
                if _set_key(packed) == r["set_key"]:      # an id may have several texts
                    rows.append((r["grp"], r["rep"], r["n"],
                                 int(r["copies"]).to_bytes(8, "little") + packed))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in enumerate(
                    (pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                names=["grp", "rep", "n", "set"])

    members = (chosen.join(texts, "rep").withColumnRenamed("component", "grp")
               .select("grp", "rep", "n", "copies", "set_key", "text")
               .mapInArrow(run, "grp long, rep long, n long, set binary"))
    found = compare_blocks(in_blocks(members, "set", block), _exactly(threshold),
                           "rep long, root long, links long", "array<binary>")
    return stored(found, "jaccard-links")


def kept_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are the smallest id of their class, all columns."""
    classes = jaccard_join(docs, id_col, text_col)
    out = classes.where("class_id <> doc_id").select(F.col("doc_id").alias("__out")).distinct()
    return docs.join(out, F.col(id_col) == F.col("__out"), "left_anti").select(*docs.columns)


cloudpickle.register_pickle_by_value(sys.modules[__name__])

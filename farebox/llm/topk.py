"""Exact top-k search by inner product with multi-resolution segment statistics.

The inner product is half of |q|^2 + |c|^2 - |q - c|^2, so a lower bound of the
distance bounds it from above. For vectors cut into segments the distance is at
least sum(m * ((mean - mean')^2 + (deviation - deviation')^2)); the features
sqrt(m) * mean and sqrt(m) * deviation of the segments make this bound a plain
product of features. Bounds go from few segments to many, and only candidates that
may still enter a query's list get their exact product.

Vectors are dealt out in the order of their mean, as blocks; each query's first
list comes from its own block. Query blocks meet all candidate blocks; a pair of
blocks whose bound, by the ranges of the candidates' coarse features, is below the
lists of all its queries is dropped before any vector is sent. The rest is dealt out
by query block and cell of candidate blocks, the best bound first, and each task
goes through its cells block by block with one list per query.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farebox.llm.common import small_arrow_batches, stored

K = 5
BLOCK = 2048              # candidates of a block
QUERIES = 1024            # queries of a block
CELL = 64                 # candidate blocks that a task compares with a query block
CHUNK = 512               # summaries of candidate blocks in a row
SLICE = 256               # queries compared at once
PAIRS = 100_000           # exact products taken at once
LEVELS = (4, 16)          # segments, coarse to fine
SLACK = 1e-9              # relative; more than double precision loses in a bound
EXACT = 2.0 ** 53         # sums of products below are exact in doubles
_LONG = np.iinfo(np.int64)


def segment_features(x: np.ndarray, segments: int) -> np.ndarray:
    """Rows' sqrt(m) * mean and sqrt(m) * deviation of each segment of m
    dimensions. The product of two rows' features is at least that of the rows."""
    marks = sorted({round(x.shape[1] * k / segments) for k in range(segments + 1)})
    cols = []
    for a, b in zip(marks, marks[1:], strict=False):
        part = x[:, a:b]
        mean = part.mean(axis=1)
        cols += [np.sqrt(b - a) * mean,
                 np.sqrt(((part - mean[:, None]) ** 2).sum(axis=1))]
    return np.column_stack(cols) if cols else np.zeros((len(x), 0))


def _exact(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Row by row inner products of whole numbers (as doubles); beyond a long
    they stop at its ends."""
    d = q.shape[1]
    most = np.abs(q).max(initial=0) * np.abs(c).max(initial=0) * max(d, 1)
    if most < EXACT:
        return np.einsum("nd,nd->n", q, c).astype(np.int64)
    sums = [sum(int(a) * int(b) for a, b in zip(x, y, strict=True))
            for x, y in zip(q, c, strict=True)]
    return np.array([min(max(s, _LONG.min), _LONG.max) for s in sums], np.int64)


class Lists:
    """The best k candidates so far of each query of a block: scores, then ids,
    then row numbers decide."""

    def __init__(self, rids: np.ndarray, ids: np.ndarray, vectors: np.ndarray,
                 least: np.ndarray, k: int):
        self.rids, self.ids, self.vectors, self.k = rids, ids, vectors, k
        self.levels = [segment_features(vectors, s) for s in LEVELS]
        self.norms = np.sqrt((vectors ** 2).sum(axis=1))
        self.least = least                   # a score that the last of the list reaches
        self.held = np.zeros((0, 4), np.int64)   # query, score, id, row

    def _alive(self, lo: int, hi: int, levels: list, norms: np.ndarray):
        """(query, candidate) whose bounds reach the query's list, level by level."""
        least = self.least[lo:hi, None] - SLACK * (1 + self.norms[lo:hi, None] * norms)
        i, j = np.nonzero(self.levels[0][lo:hi] @ levels[0].T >= least)
        for mine, theirs in zip(self.levels[1:], levels[1:], strict=True):
            kept = []
            for at in range(0, len(i), PAIRS):
                a, b = i[at:at + PAIRS], j[at:at + PAIRS]
                bound = np.einsum("nd,nd->n", mine[lo + a], theirs[b])
                kept.append(bound >= least[a, b])
            ok = np.concatenate(kept) if kept else np.zeros(0, bool)
            i, j = i[ok], j[ok]
        return i + lo, j

    def meet(self, rids: np.ndarray, ids: np.ndarray, c: np.ndarray) -> None:
        """Bring in a block of candidates."""
        levels = [segment_features(c, s) for s in LEVELS]
        norms = np.sqrt((c ** 2).sum(axis=1))
        for lo in range(0, len(self.vectors), SLICE):
            i, j = self._alive(lo, min(lo + SLICE, len(self.vectors)), levels, norms)
            for at in range(0, len(i), PAIRS):
                a, b = i[at:at + PAIRS], j[at:at + PAIRS]
                other = self.rids[a] != rids[b]
                a, b = a[other], b[other]
                score = _exact(self.vectors[a], c[b])
                self._take(a, score, ids[b], rids[b])

    def _take(self, a, score, ids, rids) -> None:
        ok = score >= self.least[a]
        new = np.column_stack([a[ok], score[ok], ids[ok], rids[ok]])
        if not len(new):
            return
        touched = np.zeros(len(self.rids), bool)
        touched[new[:, 0]] = True
        stay = self.held[~touched[self.held[:, 0]]]
        rows = np.concatenate([self.held[touched[self.held[:, 0]]], new])
        # ~score falls where score rises, at the ends of a long too
        rows = rows[np.lexsort((rows[:, 3], rows[:, 2], ~rows[:, 1], rows[:, 0]))]
        start = np.concatenate([[True], rows[1:, 0] != rows[:-1, 0]])
        rank = np.arange(len(rows)) - np.maximum.accumulate(np.where(start, np.arange(len(rows)), 0))
        last = rank == self.k - 1
        self.least[rows[last, 0]] = np.maximum(self.least[rows[last, 0]], rows[last, 1])
        self.held = np.concatenate([stay, rows[rank < self.k]])


def _usable(v: Column) -> Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & finite


def _matrix(data: bytes, d: int) -> np.ndarray:
    return np.frombuffer(data, np.float64).reshape(-1, d) if d else np.zeros((len(data) // 8, 0))


def _pack(x: np.ndarray) -> bytes:
    """A matrix without dimensions is kept as one number a row."""
    return np.ascontiguousarray(x if x.shape[1] else np.zeros(len(x))).tobytes()


_PACKED = "d int, size int, rids binary, ids binary, data binary"
_BLOCK = _PACKED + ", low array<double>, high array<double>, query binary, least binary"
_LISTS = "query_rid long, query_id long, rid long, vec_id long, score long"


def _rows_of(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[list]:
    """Rows in lists of at most ``size`` whose vectors (column v) are of one length."""
    held: list = []
    for b in batches:
        for row in b.to_pylist():
            if held and (len(held) >= size or len(row["v"]) != len(held[0]["v"])):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _blocks(vectors: DataFrame, count: int, every: int, k: int, block: int) -> DataFrame:
    """Packed blocks of candidates with the ranges of their coarse features, which
    of their rows are queries, and the queries' scores in their own block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _rows_of(batches, block):
            d = len(rows[0]["v"])
            x = np.array([r["v"] for r in rows], np.float64).reshape(len(rows), d)
            rids = np.array([r["rid"] for r in rows], np.int64)
            ids = np.array([r["vec_id"] for r in rows], np.int64)
            at = np.nonzero(ids % every == 0)[0]
            lists = Lists(rids[at], ids[at], x[at], np.full(len(at), _LONG.min), k)
            lists.meet(rids, ids, x)
            coarse = segment_features(x, LEVELS[0])
            yield pa.RecordBatch.from_pylist([{
                "d": d, "size": len(rows), "rids": rids.tobytes(), "ids": ids.tobytes(),
                "data": _pack(x), "low": coarse.min(axis=0).tolist(),
                "high": coarse.max(axis=0).tolist(), "query": at.astype(np.int32).tobytes(),
                "least": lists.least.tobytes()}], schema=schema)

    schema = pa.schema([("d", pa.int32()), ("size", pa.int32()), ("rids", pa.binary()),
                        ("ids", pa.binary()), ("data", pa.binary()),
                        ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64())),
                        ("query", pa.binary()), ("least", pa.binary())])
    parts = max(1, -(-count * 5 // (4 * block)))
    # equal vectors are told apart by their row number, so no value fills a partition
    dealt = vectors.repartitionByRange(parts, "d", "at", "rid").sortWithinPartitions("d", "at", "rid")
    return dealt.select("rid", "vec_id", "v").mapInArrow(run, _BLOCK)


def _query_blocks(blocks: DataFrame, count: int, size: int) -> DataFrame:
    """The queries alone, packed anew in the order of the blocks."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                at = np.frombuffer(r["query"], np.int32)
                if len(at):
                    x = _matrix(r["data"], r["d"])[at]
                    yield pa.RecordBatch.from_pydict({
                        "d": [r["d"]], "no": [r["no"]], "size": [len(at)],
                        "rids": [np.frombuffer(r["rids"], np.int64)[at].tobytes()],
                        "ids": [np.frombuffer(r["ids"], np.int64)[at].tobytes()],
                        "data": [_pack(x)], "least": [r["least"]]}, schema=few)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        for b in [*batches, None]:
            for r in ([None] if b is None else b.to_pylist()):
                if held and (r is None or r["d"] != held[0]["d"]
                             or sum(h["size"] for h in held) + r["size"] > size):
                    yield pa.RecordBatch.from_pydict({
                        "d": [held[0]["d"]], "size": [sum(h["size"] for h in held)],
                        **{c: [b"".join(h[c] for h in held)]
                           for c in ("rids", "ids", "data", "least")}}, schema=many)
                    held = []
                if r is not None:
                    held.append(r)

    many = pa.schema([("d", pa.int32()), ("size", pa.int32()), ("rids", pa.binary()),
                      ("ids", pa.binary()), ("data", pa.binary()), ("least", pa.binary())])
    few = pa.schema([many.field(0), ("no", pa.int64()), *list(many)[1:]])
    some = blocks.where(F.length("query") > 0).mapInArrow(
        cut, "d int, no long, size int, rids binary, ids binary, data binary, least binary")
    dealt = some.repartitionByRange(max(1, count // size), "d", "no").sortWithinPartitions("d", "no")
    return dealt.drop("no").mapInArrow(join, _PACKED + ", least binary")


def _bounds(queries: DataFrame, blocks: DataFrame, chunks: int) -> DataFrame:
    """(qno, no, bound): pairs of blocks in which a query may find a partner, and
    how much the best of them may lack or exceed its list. Every query block is
    held against all blocks' ranges, some hundred of them in a row."""
    part = F.pmod(F.xxhash64("no"), F.lit(chunks)).alias("chunk")
    ranges = (blocks.groupBy("d", part)
              .agg(F.collect_list(F.struct("no", "low", "high")).alias("ranges")))
    asked = queries.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"),
                                                             F.lit(chunks - 1).cast("long"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                x = _matrix(r["data"], r["d"])
                f = segment_features(x, LEVELS[0])
                low = np.array([s["low"] for s in r["ranges"]]).reshape(len(r["ranges"]), f.shape[1])
                high = np.array([s["high"] for s in r["ranges"]]).reshape(len(r["ranges"]), f.shape[1])
                up, down = np.maximum(f, 0), np.minimum(f, 0)
                bound = up @ high.T + down @ low.T
                reach = np.sqrt((f ** 2).sum(axis=1))[:, None] * np.sqrt(
                    np.maximum(low ** 2, high ** 2).sum(axis=1))
                over = bound + SLACK * (1 + reach) - np.frombuffer(r["least"], np.int64)[:, None]
                best = over.max(axis=0)
                at = np.nonzero(best >= 0)[0]
                yield pa.RecordBatch.from_pydict({
                    "qno": pa.array([r["qno"]] * len(at), pa.int64()),
                    "no": pa.array([r["ranges"][k]["no"] for k in at], pa.int64()),
                    "bound": pa.array(best[at], pa.float64())})

    return (asked.join(ranges, ["d", "chunk"]).select("qno", "d", "data", "least", "ranges")
            .mapInArrow(run, "qno long, no long, bound double"))


def _compared(pairs: DataFrame, queries: DataFrame, blocks: DataFrame, k: int,
              cells: int) -> DataFrame:
    """The lists of every query block in every cell of candidate blocks."""
    pairs = pairs.withColumn("cell", F.pmod(F.xxhash64("no"), F.lit(cells)))
    theirs = (pairs.join(blocks.select("no", "d", "rids", "ids", "data"), "no")
              .select("qno", "cell", "bound", "d", "rids", "ids", "data",
                      F.lit(None).cast("binary").alias("least")))
    mine = (pairs.select("qno", "cell").distinct()
            .join(queries.select("qno", "d", "rids", "ids", "data", "least"), "qno")
            .select("qno", "cell", F.lit(float("inf")).alias("bound"), "d", "rids", "ids", "data",
                    "least"))
    dealt = (theirs.union(mine).repartition("qno", "cell")
             .sortWithinPartitions("qno", "cell", F.col("least").isNull(), F.desc("bound")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = None
        for b in batches:
            for r in b.to_pylist():
                x = _matrix(r["data"], r["d"])
                rids, ids = (np.frombuffer(r[c], np.int64) for c in ("rids", "ids"))
                if r["least"] is not None:           # the queries of the next cell
                    if lists is not None:
                        yield out(lists)
                    lists = Lists(rids, ids, x, np.frombuffer(r["least"], np.int64).copy(), k)
                else:
                    lists.meet(rids, ids, x)
        if lists is not None:
            yield out(lists)

    def out(lists: Lists) -> pa.RecordBatch:
        h = lists.held
        return pa.RecordBatch.from_arrays(
            [pa.array(c) for c in (lists.rids[h[:, 0]], lists.ids[h[:, 0]], h[:, 3], h[:, 2], h[:, 1])],
            names=["query_rid", "query_id", "rid", "vec_id", "score"])

    return dealt.select("d", "rids", "ids", "data", "least").mapInArrow(run, _LISTS)


def top_k(vectors: DataFrame, every: int, k: int = K, id_col: str = "vec_id",
          vector_col: str = "embedding", block: int = BLOCK, queries: int = QUERIES,
          cell: int = CELL, chunk: int = CHUNK) -> DataFrame:
    """The k rows of the largest inner product with each query: query_id, rank
    (from 1), vec_id, score.

    ``vectors`` holds whole numbers (any numeric array). Queries are the rows whose
    id ``every`` divides, candidates all rows but the query's own; ties go to the
    smaller id. Rows without an id, null vectors and those with null or non-finite
    components take no part; only vectors of one length meet (empty ones score 0).
    Rows that repeat an id are queries and candidates of their own. Scores beyond a
    long stop at its ends. A query without candidates and an empty table give no
    rows; other columns are ignored."""
    small_arrow_batches(vectors.sparkSession)
    base = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.col(vector_col).cast("array<double>").alias("v"))
    total = F.aggregate("v", F.lit(0.0), lambda s, x: s + x)
    # rows are numbered as they are written, so the numbers stay
    good = stored(base.where(F.col("vec_id").isNotNull() & _usable(F.col("v"))).select(
        "vec_id", "v", F.size("v").alias("d"),
        F.when(F.size("v") > 0, total / F.size("v")).alias("at"),
        F.monotonically_increasing_id().alias("rid")), "topk-vectors")
    asked = F.coalesce(F.sum((F.col("vec_id") % every == 0).cast("long")), F.lit(0))
    count, n_asked = good.agg(F.count(F.lit(1)), asked).first()
    number = F.monotonically_increasing_id()
    blocks = stored(_blocks(good, count, every, k, block).withColumn("no", number), "topk-blocks")
    q = stored(_query_blocks(blocks, n_asked, queries).withColumn("qno", number), "topk-queries")
    n_blocks = blocks.count()
    pairs = stored(_bounds(q, blocks, max(1, n_blocks // chunk)), "topk-pairs")
    lists = _compared(pairs, q, blocks, k, max(1, n_blocks // cell))
    order = Window.partitionBy("query_rid").orderBy(F.desc("score"), "vec_id", "rid")
    return (lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Near-duplicate embeddings by a PCA-ordered tiled comparison.

Equal vectors are counted first and compared once. Vectors are scaled to unit
length, rotated to their principal axes and dealt out in the order of the first
two, as tiles. The ranges of the tiles on the first axes are a small table; tiles
that lie too far apart on them never meet, and only the other pairs are joined. A
pair of tiles is compared as a whole: products of the leading dimensions first, and after each group of dimensions a pair is given up once even
the rest, bounded by the product of the two suffix norms, can't lift it to the
threshold. What is left is decided by the cosine of the given vectors in double
precision. Of a pair of tiles only counts and a spanning set of links remain.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import local_roots, stored
from farebox.llm.components import connected_components

THRESHOLD = 0.9
TILE = 4096               # vectors of a tile
RANGED = 8                # axes on which tiles' ranges are held against each other
CHUNK = 512               # tiles whose ranges are in a row
SLICE = 256               # rows of a tile that are compared at once
LEAD = (0.125, 0.25, 0.5)  # shares of the dimensions after which pairs are given up
SLACK = 1e-9              # more than double precision loses in the rotated products


def _usable(v) -> F.Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & finite & F.exists(v, lambda x: x != 0)


def _unit(b: pa.RecordBatch, column: str) -> list[np.ndarray]:
    """Vectors scaled to length one in double precision; scaled by the largest
    component first, so that the squares neither overflow nor vanish."""
    return list(_scaled(np.array(b.column(column).to_pylist(), np.float64)))


def principal_axes(vectors: DataFrame) -> np.ndarray:
    """Axes of the given unit vectors (column v, equal lengths), by falling
    variance. Tasks send one matrix of sums each; the sums meet by component."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if len(b):
                x = np.array(_unit(b, "v"))
                total = x.T @ x if total is None else total + x.T @ x
        if total is not None:
            flat = total.ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)],
                                             names=["at", "s"])

    sums = vectors.select("v").mapInArrow(run, "at long, s double")
    rows = sums.groupBy("at").agg(F.sum("s").alias("s")).collect()   # dimensions squared
    d = round(len(rows) ** 0.5)
    cov = np.zeros(d * d)
    for r in rows:
        cov[r["at"]] = r["s"]
    return np.linalg.eigh(cov.reshape(d, d))[1][:, ::-1]


def _compare(x, y, lead, threshold):
    """Positions (i, j) of rows with a product of at least the threshold, by
    leading dimensions first. x and y are rotated unit vectors."""
    d = x.shape[1]
    at = 0
    dots = np.zeros((len(x), len(y)))
    i = j = None
    for stop in [*lead, d]:
        if i is None:
            dots += x[:, at:stop] @ y[:, at:stop].T
            rest = (np.sqrt(np.maximum(0, (x[:, stop:] ** 2).sum(1)))[:, None]
                    * np.sqrt(np.maximum(0, (y[:, stop:] ** 2).sum(1))))
            alive = dots + rest >= threshold - SLACK
            if alive.mean() < 0.02 or stop == d:       # from here on pair by pair
                i, j = np.nonzero(alive)
                left = dots[i, j]
        else:
            left = left + np.einsum("nd,nd->n", x[i, at:stop], y[j, at:stop])
            rest = np.sqrt((x[i, stop:] ** 2).sum(1) * (y[j, stop:] ** 2).sum(1))
            keep = left + rest >= threshold - SLACK
            i, j, left = i[keep], j[keep], left[keep]
        at = stop
    return i, j


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                 threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    Vectors that are null, empty, zero or hold null or non-finite components link
    with nothing, and so do rows without an id; vectors of different lengths
    don't link with each other. Rows that repeat an id count as vectors of their
    own and share its component. An empty table gives none; other columns are
    ignored."""
    base = rows.select(F.col(id_col).cast("long").alias("vec_id"),
                       F.col(vector_col).cast("array<double>").alias("v"))
    usable = _usable(F.col("v")) & F.col("vec_id").isNotNull()
    # minus zero and zero are one value here
    good = base.where(usable).select("vec_id", F.transform("v", lambda x: x + F.lit(0.0)).alias("v"))
    reps = stored(good.groupBy("v").agg(F.min("vec_id").alias("rep"),
                                        F.count(F.lit(1)).alias("copies")), "vector-reps")
    links = None
    sizes = reps.groupBy(F.size("v").alias("d")).count().collect()   # one row per length
    for r in sizes:
        part = _tiles_links(reps.where(F.size("v") == r["d"]), r["count"], threshold, tile)
        links = part if links is None else links.union(part)
    if links is None:
        found = rows.sparkSession.createDataFrame([], "rep long, n long, component long")
    else:
        links = stored(links, "vector-links")
        classes = connected_components(links, "rep", "root")
        found = links.groupBy("rep").agg(F.sum("links").alias("n")).join(
            classes.withColumnRenamed("node", "rep"), "rep", "left")
    per_rep = reps.join(found, "rep", "left").select(
        F.col("v").alias("key"), (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"))
    linked = good.join(per_rep, F.col("v") == F.col("key")).select(
        "vec_id", "n_links", "component_id")
    alone = base.where(~F.coalesce(usable, F.lit(False))).select(
        "vec_id", F.lit(0).cast("long"), "vec_id")
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _tiles_links(reps: DataFrame, count: int, threshold: float, tile: int) -> DataFrame:
    """(rep, root, links) of vectors of one length, per pair of tiles."""
    axes = principal_axes(reps)
    n_tiles = max(1, -(-count // tile))
    slabs = max(1, round(n_tiles ** 0.5))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if len(b):
                at = np.array(_unit(b, "v")) @ axes[:, :2]
                slab = np.floor((at[:, 0] + 1) / 2 * slabs).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(slab), pa.array(at[:, -1])],
                                                 names=[*b.schema.names, "slab", "at"])

    placed = stored(reps.mapInArrow(
        place, "v array<double>, rep long, copies long, slab int, at double"), "vector-placed")

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in [*batches, None]:
            if b is not None and len(b):
                held.append(b)
                size += len(b)
            if held and (b is None or size >= tile):
                t = pa.Table.from_batches(held)
                x = np.array(t.column("v").to_pylist(), np.float64)
                first = _scaled(x) @ axes[:, :RANGED]
                with np.errstate(over="ignore"):
                    narrow = x.astype(np.float32)
                wide = not np.array_equal(narrow, x)
                yield pa.RecordBatch.from_arrays([
                    pa.array([t.column("rep").to_numpy().tobytes()], pa.binary()),
                    pa.array([t.column("copies").to_numpy().tobytes()], pa.binary()),
                    pa.array([(x if wide else narrow).tobytes()], pa.binary()), pa.array([wide]),
                    pa.array([first.min(axis=0).tolist()]), pa.array([first.max(axis=0).tolist()])],
                    names=["reps", "copies", "data", "wide", "low", "high"])
                held, size = [], 0

    blocks = placed if n_tiles == 1 else placed.repartitionByRange(n_tiles, "slab", "at", "rep")
    blocks = stored(blocks.select("v", "rep", "copies").mapInArrow(
        block, "reps binary, copies binary, data binary, wide boolean, low array<double>, "
               "high array<double>").withColumn("no", F.monotonically_increasing_id()), "vector-tiles")
    pairs = stored(_near_tiles(blocks, threshold), "vector-pairs")
    payload = ["reps", "copies", "data", "wide"]
    left = blocks.select("no", *payload)
    right = blocks.select(F.col("no").alias("no2"), *[F.col(c).alias(f"{c}2") for c in payload])
    pairs = pairs.join(right, "no2").join(left, "no")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = len(axes)
        lead = sorted({max(1, round(d * s)) for s in LEAD} - {d})
        for b in batches:
            for k in range(len(b)):
                r = b.slice(k, 1).to_pylist()[0]
                out = _tile_pair(r, d, axes, lead, threshold)
                if out is not None:
                    yield out

    return pairs.select("no", *payload, "no2", *[f"{c}2" for c in payload]).mapInArrow(
        compare, "rep long, root long, links long")


def _scaled(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, as ``_unit`` does."""
    u = x / np.abs(x).max(axis=1, keepdims=True)
    return u / np.sqrt((u * u).sum(axis=1, keepdims=True))


def _near_tiles(blocks: DataFrame, threshold: float) -> DataFrame:
    """(no, no2): each pair of tiles, and each tile with itself, whose ranges don't
    rule out a link: |a-b|^2 = 2 - 2 cos is at least the sum of squared gaps."""
    chunks = max(1, blocks.count() // CHUNK)
    chunk = F.pmod(F.xxhash64("no"), F.lit(chunks))
    ranges = blocks.groupBy(chunk.alias("chunk")).agg(
        F.collect_list(F.struct("no", "low", "high")).alias("tiles"))
    # every chunk meets itself and the later ones
    sent = ranges.select(F.col("chunk").alias("own"), F.col("tiles").alias("mine"), F.explode(
        F.sequence(F.col("chunk"), F.lit(chunks - 1).cast("long"))).alias("chunk"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                (no, low, high), (no2, low2, high2) = (
                    [np.array([t[c] for t in r[side]]) for c in ("no", "low", "high")]
                    for side in ("mine", "tiles"))
                for k in range(len(no)):
                    gap = np.maximum(0, np.maximum(low[k] - high2, low2 - high[k]))
                    ok = 1 - (gap * gap).sum(axis=1) / 2 >= threshold - SLACK
                    if r["own"] == r["chunk"]:
                        ok &= no2 >= no[k]
                    if ok.any():
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(int(ok.sum()), no[k])), pa.array(no2[ok])],
                            names=["no", "no2"])

    return sent.join(ranges, "chunk").mapInArrow(run, "no long, no2 long")


def _tile_pair(r: dict, d: int, axes: np.ndarray, lead: list[int], threshold: float):
    def unit(data: bytes, wide: bool) -> tuple[np.ndarray, np.ndarray]:
        raw = np.frombuffer(data, np.float64 if wide else np.float32).astype(np.float64)
        u = _scaled(raw.reshape(-1, d))
        return u, u @ axes

    same = r["no"] == r["no2"]
    ux, px = unit(r["data"], r["wide"])
    uy, py = (ux, px) if same else unit(r["data2"], r["wide2"])
    names, copies = np.frombuffer(r["reps"], np.int64), np.frombuffer(r["copies"], np.int64)
    m = 0
    if not same:
        m = len(names)
        names = np.concatenate([names, np.frombuffer(r["reps2"], np.int64)])
        copies = np.concatenate([copies, np.frombuffer(r["copies2"], np.int64)])
    links, root = np.zeros(len(names), np.int64), np.arange(len(names))
    for k in range(0, len(px), SLICE):
        i, j = _compare(px[k:k + SLICE], py, lead, threshold)
        i = i + k
        ok = np.einsum("nd,nd->n", ux[i], uy[j]) >= threshold
        i, j = i[ok], j[ok] + m
        if same:
            i, j = i[i != j], j[i != j]
        np.add.at(links, i, copies[j])
        if not same:
            np.add.at(links, j, copies[i])
        root = local_roots(len(names), np.concatenate([np.arange(len(names)), i]),
                           np.concatenate([root, j]))
    at = np.nonzero(links)[0]
    if not len(at):
        return None
    return pa.RecordBatch.from_arrays(
        [pa.array(names[at]), pa.array(names[root[at]]), pa.array(links[at])],
        names=["rep", "root", "links"])


cloudpickle.register_pickle_by_value(sys.modules[__name__])

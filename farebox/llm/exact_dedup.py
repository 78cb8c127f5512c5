"""Exact deduplication through an extendible-hash index on shared files.

Every document has a 64-bit key, the first bits of its text's SHA-256. The
directory maps the leading bits of a key to a bucket. It starts with one entry;
while some bucket holds more keys than ``capacity`` the directory doubles and
exactly the overfull buckets split. Texts are dealt out by their bucket, so an owner
task holds whole buckets. It groups by key and text, which compares bytes, and
chains the texts that share a key; the chains are the index, written to the shared
folder. Every row then looks up its bucket and key, and in a chain of several texts
its own by the whole SHA-256.

DataFrame operations only. The few texts that very many rows hold are counted where
they lie before they go to their owner, so that none of them fills a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import stored
from farebox.llm.components import join_keyed

CAPACITY = 2_000
MAX_DEPTH = 16
HOT_KEYS = 8192          # a key with more than this part of all rows is counted where it lies
HOT_ROWS = 64            # and at least so many
_FIRST_BITS = 16


def normalised(text: Column) -> Column:
    """Null as empty; each run of space, tab, LF, VT, FF or CR as one space."""
    flat = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.when(F.contains(flat, F.lit("  ")), F.regexp_replace(flat, " {2,}", " ")).otherwise(flat)


def directory(prefix_counts: dict[int, int], bits: int, capacity: int) -> tuple[int, list[int]]:
    """Doubling: (global depth, bucket of each entry). ``prefix_counts`` has the
    number of entries by the first ``bits`` bits of the key."""
    depth, buckets = 0, [(0, 0)]                       # (local depth, prefix)
    before = [0]                                       # entries below each prefix
    for k in range(1 << bits):
        before.append(before[-1] + prefix_counts.get(k, 0))
    while depth < bits:
        sizes = [before[(p + 1) << (bits - d)] - before[p << (bits - d)] for d, p in buckets]
        if max(sizes) <= capacity:
            break
        depth += 1                                      # the directory doubles
        split = []
        for (d, p), n in zip(buckets, sizes, strict=True):
            split += [(d + 1, 2 * p), (d + 1, 2 * p + 1)] if n > capacity else [(d, p)]
        buckets = split
    entries = []
    for number, (d, _) in enumerate(buckets):
        entries += [number] * (1 << (depth - d))
    return depth, entries


def _prefix(key: Column, bits: int) -> Column:
    """The first ``bits`` bits of the hexadecimal key."""
    return F.shiftright(F.conv(F.substring(key, 1, 4), 16, 10).cast("int"), 16 - bits)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    norm = normalised(F.col(text_col))
    return docs.select(F.col(id_col).alias("doc_id"), norm.alias("norm"),
                       F.sha2(norm, 256).alias("sha256")).withColumn(
        "key", F.substring("sha256", 1, 16))


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                capacity: int = CAPACITY) -> tuple[DataFrame, DataFrame]:
    """(rows, index), both stored. rows: doc_id, sha256, key of every input row. index:
    key, bucket, rows (how many have the key) and chain, an array of sha256, keep_id,
    group_size; one row per key. An empty table gives no rows."""
    texts = _keyed(docs, id_col, text_col)
    rows = stored(texts.select("doc_id", "sha256", "key"), "exact-rows")
    keys = stored(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "exact-keys")
    top = keys.groupBy(_prefix(F.col("key"), _FIRST_BITS).alias("p")).count()
    # at most 2^16 numbers, whatever the input
    counts = {r["p"]: r["count"] for r in top.collect()}
    depth, table = directory(counts, min(MAX_DEPTH, _FIRST_BITS), capacity)
    bucket = F.element_at(F.split(F.lit(",".join(map(str, table))), ",").cast("array<int>"),
                          _prefix(F.col("key"), depth) + 1) if depth else F.lit(0)
    texts = texts.withColumn("bucket", bucket.cast("int"))

    total = keys.agg(F.sum("n")).first()[0] or 0
    # at most HOT_KEYS rows
    hot = F.broadcast(keys.where(F.col("n") > max(total / HOT_KEYS, HOT_ROWS)).select("key"))
    counted = [F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")]
    of_text = ["bucket", "key", "sha256", "norm"]     # the hash says nothing that the text doesn't
    # the owners' exchange is by bucket alone; grouping needs no other
    owned = texts.join(hot, "key", "left_anti").repartition("bucket").groupBy(*of_text).agg(*counted)
    entry = F.struct("sha256", "keep_id", "group_size")

    def chains(entries: DataFrame) -> DataFrame:
        return entries.groupBy("bucket", "key").agg(
            F.sum("group_size").alias("rows"), F.sort_array(F.collect_list(entry)).alias("chain"))

    few = texts.join(hot, "key", "left_semi").groupBy(*of_text).agg(*counted)
    return rows, stored(chains(owned).unionByName(chains(few)), "exact-index")


def looked_up(rows: DataFrame, index: DataFrame) -> DataFrame:
    """Each row with the entry of its text: keep_id, group_size."""
    found = join_keyed(rows, index.drop("bucket"), "key", "rows", rows.count())
    own = F.when(F.size("chain") == 1, F.element_at("chain", 1)).otherwise(F.element_at(
        F.filter("chain", lambda e: e["sha256"] == F.col("sha256")), 1))
    return found.withColumn("e", own).select("doc_id", "sha256", "e.keep_id", "e.group_size")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                capacity: int = CAPACITY) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty. The smallest id of equal texts stays; null ids
    sort behind all others and stay only where the whole group has none. Rows
    that repeat the same id and text are all in the group; each is marked kept
    if its id is the group's. Other columns are ignored."""
    rows, index = build_index(docs, id_col, text_col, capacity)
    return looked_up(rows, index).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha256").alias("text_sha256"))


def kept_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY) -> DataFrame:
    """The rows of ``docs`` that stay, all columns. Of rows that repeat both id
    and text one stays."""
    rows, index = build_index(docs, id_col, text_col, capacity)
    keep = index.select(F.explode("chain").alias("e")).select(
        F.col("e.keep_id").alias("__keep"), F.col("e.sha256").alias("__sha"))
    named = docs.withColumn("__of", F.sha2(normalised(F.col(text_col)), 256))
    kept = named.join(keep, F.col(id_col).eqNullSafe(F.col("__keep"))
                      & (F.col("__of") == F.col("__sha")), "left_semi")
    # a row that stays more than once is rare: only such rows are grouped whole
    repeated = stored(looked_up(rows, index).where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
                      .groupBy("doc_id", "sha256").count().where("count > 1")
                      .select(F.col("doc_id").alias("__rid"), F.col("sha256").alias("__rsha")),
                      "exact-repeated")
    if repeated.isEmpty():
        return kept.select(*docs.columns)
    same = F.col(id_col).eqNullSafe(F.col("__rid")) & (F.col("__of") == F.col("__rsha"))
    once = kept.join(repeated, same, "left_anti").select(*docs.columns)
    more = kept.join(repeated, same, "left_semi").dropDuplicates([id_col, "__of"])
    return once.unionByName(more.select(*docs.columns))

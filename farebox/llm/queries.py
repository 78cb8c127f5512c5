"""The registered queries of this subpackage; each reads whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.llm import (chat_format, exact_dedup, jaccard_join, licences, lm_score, packing,
                         periodic, quality, topk, variants, vectors, word_codec, wrappers)

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    return packing.with_ids_crc32(packing.pack(table(spark, sf_dir, "documents"), BYTE_BPE))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score of every document; a third of the ids is held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = quality.train(docs, labels.where(~held))
    scored = quality.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message as canonical JSON, calls and results linked and in order."""
    return chat_format.format_chat(table(spark, sf_dir, "conversations"))


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid-backoff scores of every document by the counts of all documents."""
    return lm_score.lm_score(table(spark, sf_dir, "documents"))


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in the paragraphs of all documents."""
    return licences.scan(table(spark, sf_dir, "documents"))


def op6_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between embeddings of a cosine of at least 0.9 and their components."""
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents whose sets of five words are at least 0.8 alike."""
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal normalised texts and the row of each that stays."""
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op9_word_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every document and of what they decode to."""
    coded = word_codec.encode(table(spark, sf_dir, "documents"), WORD_BPE)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(ids, 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article of every page and its length in code points."""
    return wrappers.extract_pages(table(spark, sf_dir, "pages")).withColumn(
        "n_chars", F.length("text").cast("long"))


def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of at least seven letters, some with a letter left out, and the form
    that each is a variant of."""
    return variants.spelling_variants(table(spark, sf_dir, "documents"), leave_out=31)


def op12_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best partners by inner product of every fiftieth embedding, in
    256ths, among all."""
    # beyond 2^53 doubles are whole
    whole = F.transform("embedding", lambda x: F.when(
        F.abs(x.cast("double") * 256) < 2 ** 53, F.floor(x.cast("double") * 256).cast("double"))
        .otherwise(x.cast("double") * 256))
    return topk.top_k(table(spark, sf_dir, "embeddings").withColumn("embedding", whole), every=50)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Documents, of which a tenth repeat some of their words to their end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    n = F.nullif(F.size(words), F.lit(0))
    a = g % n
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
    again = F.flatten(F.array_repeat(F.slice(words, (a + 1).cast("int"), p.cast("int")),
                                     F.ceil((n - a) / p).cast("int")))
    longer = F.concat(F.slice(words, F.lit(1), a.cast("int")),
                      F.slice(again, F.lit(1), (n - a).cast("int")))
    planted = (h % 10 == 0) & (F.size(words) > 0)
    return docs.withColumn("text", F.when(planted, F.array_join(longer, " "))
                           .otherwise(F.col("text")))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, the longest, and digests of all and
    of the text without their repeats."""
    found = periodic.periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("before"),
        (-r["period"]).alias("shorter"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(
        ",", r["start"], r["length"], F.concat(r["period"].cast("string"), F.lit("\n")))), "")
    return found.withColumn("top", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.before")).alias("start"),
        F.col("top.length").alias("length"), (-F.col("top.shorter")).alias("period"),
        F.expr("(1000 * top.length) div (-top.shorter)").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_quality": op2_quality,
    "op3_chat_format": op3_chat_format,
    "op4_lm_score": op4_lm_score,
    "op5_licences": op5_licences,
    "op6_vectors": op6_vectors,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_word_codec": op9_word_codec,
    "op10_wrappers": op10_wrappers,
    "op11_variants": op11_variants,
    "op12_topk": op12_topk,
    "op13_runs": op13_runs,
}

ORACLE: dict[str, str] = {
    "op8_exact_dedup": """
        WITH n AS (
          SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t
          FROM documents
        ), g AS (
          SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t
        )
        SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept,
               sha256(n.t) AS text_sha256
        FROM n JOIN g ON n.t = g.t
    """,
    "op12_topk": """
        WITH v AS (
          SELECT row_number() OVER () AS rid, vec_id,
                 list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
          FROM embeddings
          WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
          SELECT q.rid, q.vec_id AS query_id, c.vec_id, c.rid AS other,
                 CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
          FROM v AS q JOIN v AS c ON q.rid <> c.rid AND len(q.v) = len(c.v)
          WHERE q.vec_id % 50 = 0
        ), r AS (
          SELECT query_id, vec_id, score, CAST(row_number() OVER (
            PARTITION BY rid ORDER BY score DESC, vec_id, other) AS INTEGER) AS rank
          FROM s
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
}

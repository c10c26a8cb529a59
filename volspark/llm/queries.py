"""The registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from volspark.llm import angular_negatives, exact_dedup, hmm, jaccard_join, langid, packing, periodic_runs, pii, quality, sentencepiece_sampling, simhash_golay, topk_search, toxicity
from volspark.llm.common import fold, table

#: Public vocabularies; their path is a parameter of the operators.
def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn

    return add


@query(
    "op9_exact_dedup",
    """
    WITH d AS (
        SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
        FROM documents)
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, text_sha256
    FROM d WINDOW w AS (PARTITION BY text_sha256)
    """,
)
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(table(spark, sf_dir, "documents"), exact_dedup.new_index(spark))


@query(
    "op4_exact_topk",
    """
    WITH v AS (
        SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS q
        FROM embeddings
        WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    s AS (
        SELECT a.vec_id AS query_id, b.vec_id,
               list_sum([z[1] * z[2] FOR z IN list_zip(a.q, b.q)])::BIGINT AS score
        FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
)
def op4_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.search(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


@query("op5_best_fit_packing")
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), capacity=2048)


@query("op6_quality_trees")
def op6_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"), "quality")
    return quality.score(docs, model).select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op10_language_mixture")
def op10_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", (fold(F.col("doc_id"), 4) == 2).alias("held_out"))
    model = langid.MixtureModel.fit(langid.count_by_language(docs.filter(~F.col("held_out"))))
    return langid.identify(docs, model)


@query("op1_toxicity_neighbours")
def op1_toxicity_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "vote", "neighbours")


@query("op2_hidden_markov_lm")
def op2_hidden_markov_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(table(spark, sf_dir, "documents"))


@query("op7_pii_weak_supervision")
def op7_pii_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


@query("op3_jaccard_rtree")
def op3_jaccard_rtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.group(table(spark, sf_dir, "documents"))


@query("op8_sentencepiece_sampling")
def op8_sentencepiece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_sampling.round_trip(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


@query("op11_simhash_golay")
def op11_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_golay.group(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def repeated_words(docs: DataFrame) -> DataFrame:
    """``doc_id, text``; where h = crc32(doc_id) is divisible by 10, the words
    from a on are repetitions of the p words there: with g = h div 10 and n
    words, a = g mod n and p = 1 + (n - a) div (3 + g mod 8)."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.when(h % 10 == 0, words).alias("w"), F.floor(h / 10).alias("g"))
    rows = rows.withColumn("n", F.when(F.size("w") > 0, F.size("w"))).withColumn("a", (F.col("g") % F.col("n")).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    tail = F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")))
    made = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), F.slice(tail, F.lit(1), F.col("n") - F.col("a"))), " ")
    return rows.select("doc_id", F.when(F.col("n").isNotNull(), made).otherwise(F.col("text")).alias("text"))


@query("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find(repeated_words(table(spark, sf_dir, "documents")), digest=True)
    longest = F.array_sort("runs", lambda x, y: F.when(x["length"] > y["length"], -1).when(x["length"] < y["length"], 1).when(x["start"] < y["start"], -1).when(x["start"] > y["start"], 1).otherwise(x["period"] - y["period"]).cast("int"))
    found = found.withColumn("best", F.get(longest, F.lit(0)))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start"), F.col("best.length"), F.col("best.period"),
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.col("collapsed").alias("collapsed_sha256"),
    )


@query(
    "op12_angular_negatives",
    """
    WITH v AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS q
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    s AS (
        SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
               list_sum([z[1] * z[2] FOR z IN list_zip(a.q, b.q)])::BIGINT AS score
        FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
    p AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
    n AS (
        SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
               row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank
        FROM p JOIN s USING (anchor_id)
        WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
    """,
)
def op12_angular_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"), "embedding")
    return angular_negatives.mine(rows, F.col("id") % 50 == 0)

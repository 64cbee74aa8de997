"""The queries of this folder and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.llm.common import read_table
from clickpulse.llm.oracles import ORACLES  # noqa: F401  (read by the entry)

QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def word_pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clickpulse.llm.simhash import simhash_components
    return simhash_components(read_table(spark, sf_dir, "documents")).drop("group_fp")


@query
def op2_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clickpulse.llm.quality_model import score_quality, train_quality
    docs = read_table(spark, sf_dir, "documents")
    return score_quality(docs, train_quality(docs, read_table(spark, sf_dir, "labels")))


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clickpulse.llm.packing import pack_documents
    return pack_documents(read_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


@query
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clickpulse.llm.language import predict_language, train_language
    docs = read_table(spark, sf_dir, "documents")
    return predict_language(docs, train_language(docs))


@query
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clickpulse.llm.url_filter import filter_urls, rule_table
    return filter_urls(read_table(spark, sf_dir, "pages"), rule_table(spark))


@query
def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clickpulse.llm.licences import scan_licences
    return scan_licences(read_table(spark, sf_dir, "documents"))


@query
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clickpulse.llm.decontaminate import document_hits
    hits = document_hits(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return hits.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                       (F.col("n_hit") > 0).alias("contaminated"))


@query
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clickpulse.llm.token_files import export_and_read
    return export_and_read(read_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@query
def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clickpulse.llm.secret_scan import find_secrets
    return find_secrets(read_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"), word_pattern())


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clickpulse.llm.quality_rules import quality_verdicts, train_field
    docs = read_table(spark, sf_dir, "documents")
    return quality_verdicts(docs, train_field(docs, read_table(spark, sf_dir, "labels")))


@query
def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clickpulse.llm.exact_dedup import exact_copies
    return exact_copies(read_table(spark, sf_dir, "documents"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text.  With h = crc32 of the id and g = h div 10, a text of n
    words whose h ends in 0 becomes periodic behind its first a = g % n words,
    with period 1 + (n - a) div (3 + g % 8); a null id stays as it is."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("w"))
    rows = rows.withColumn("n", F.size("w")).withColumn("a", F.expr("IF(n > 0, g % n, 0)").cast("int"))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)").cast("int"))
    again = "concat(slice(w, 1, a), slice(flatten(array_repeat(slice(w, a + 1, p), cast(ceil((n - a) / p) AS INT))), 1, n - a))"
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(F.expr(again), " ")).otherwise(F.col("text")).alias("text"))


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clickpulse.llm.periodic_runs import find_runs, longest_run
    found = find_runs(with_planted_runs(read_table(spark, sf_dir, "documents"))).withColumn("best", longest_run("runs"))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.back")).alias("start"), F.col("best.length"),
        (-F.col("best.short")).alias("period"), F.expr("best.length * 1000 div -best.short").alias("exponent_milli"),
        F.sha2(F.array_join(F.expr("transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || '\\n')"), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role and text after the damage that crc32 of
    ``conv_id:turn`` modulo 20 names; nulls count as one space in all four."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    text, role, kind = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" ")), F.col("kind")
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(key.cast("binary")) % 20).alias("kind")) \
        .where("kind <> 0") \
        .withColumn("copy", F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))) \
        .select("conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
                F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"))


@query
def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from clickpulse.llm.conversation_repair import repair_report
    rows = read_table(spark, sf_dir, "conversations")
    report = repair_report(damaged(rows)).withColumnRenamed("conv_id", "c")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return rows.select("conv_id").distinct().join(report, F.col("conv_id").eqNullSafe(F.col("c")), "left").select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))

"""Registered queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecast.llm import decontam, exact_dedup, fill_middle, hard_negatives, html_text, mixing, pitman_yor, secrets, simhash, suffix_dedup, token_counts, toxicity, url_filter
from tidecast.llm.common import table


#: A public vocabulary file, read where it lies.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
#: The rules for urls, verdict and host with path.
URL_RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_scan(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_token_counts(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), token_counts.read_vocabulary(vocabulary))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"), shingle=3, radius=3)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fill_middle.fill_in_middle(table(spark, sf_dir, "documents"), unit="line", seed=7, rate=100, spm=50)
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(fill_middle.restored().cast("binary"), 256).alias("restored_sha256"),
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), anchor=F.col("vec_id") % 100 == 0, label=label)


def op13_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1
    return pitman_yor.score(table(spark, sf_dir, "documents"), held)


def queries() -> dict:
    return {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}


def oracle_sql() -> dict[str, str]:
    return {"op9_exact_dedup": exact_dedup.SQL}

"""Registered queries of this subpackage, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.llm.centroids import clusters
from shardloom.llm.common import in_fold, table
from shardloom.llm.decontaminate import contamination
from shardloom.llm.exact_dedup import exact_duplicates
from shardloom.llm.lattice_lm import lattice_scores
from shardloom.llm.license_scan import license_scan
from shardloom.llm.oracle import ORACLE  # noqa: F401  (registered beside the queries)
from shardloom.llm.pareto_mix import pareto_mix
from shardloom.llm.quality import THRESHOLD, fit_quality, quality_scores
from shardloom.llm.resample import resample
from shardloom.llm.secret_ledger import scan_versions, secret_spans
from shardloom.llm.simhash import near_duplicates
from shardloom.llm.topk import top_products
from shardloom.llm.url_templates import url_verdicts
from shardloom.llm.warc import archive_pages, read_archives


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit_quality(docs, labels.filter(~in_fold(F.col("doc_id"), 0)))
    return quality_scores(docs, model).select(
        "doc_id", in_fold(F.col("doc_id"), 0).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_scores(table(spark, sf_dir, "documents"), in_fold(F.col("doc_id"), 1))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents")).drop("n_chunks")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    read, kind = read_archives(archive_pages(pages), with_payload=False), dict(pages.dtypes)["page_id"]
    return read.select(F.col("id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       F.col("refers_to").cast(kind).alias("refers_to"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions, _, findings = scan_versions(table(spark, sf_dir, "documents"))
    return secret_spans(versions, findings)


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pareto_mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_lm_score": op3_lm_score,
    "op4_license_scan": op4_license_scan,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_url_filter": op7_url_filter,
    "op8_warc": op8_warc,
    "op9_secret_scan": op9_secret_scan,
    "op10_mix_sources": op10_mix_sources,
    "op11_target_resampling": op11_target_resampling,
    "op12_topk_search": op12_topk_search,
    "op13_centroid_clustering": op13_centroid_clustering,
}

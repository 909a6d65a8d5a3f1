"""The named queries of this subpackage; their SQL is in ``oracles``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm import (
    ball_tree,
    decontamination,
    license_scans,
    line_dedup,
    near_dups,
    packing,
    periodic_runs,
    pii,
    secrets,
    sharding,
    simplex_clusters,
    toxicity,
    url_filters,
)
from kerbside.llm.common import table

VOCABULARY = "byte_bpe_50k.json"


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op1_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return ball_tree.top_k(table(spark, folder, "embeddings"))


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    clean = line_dedup.without_boilerplate(table(spark, folder, "documents"))
    return clean.select(
        "doc_id", "n_lines", "n_removed", F.length("text").alias("n_chars"), F.sha2("text", 256).alias("text_sha256")
    )


def op4_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return license_scans.scan_licenses(table(spark, folder, "documents"))


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), vocabulary())


def op6_near_dups(spark: SparkSession, folder: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, folder, "documents"))


def op7_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan(table(spark, folder, "documents"))


def op8_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return url_filters.judge_pages(table(spark, folder, "pages"))


def op9_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(table(spark, folder, "documents"))


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op11_centroids(spark: SparkSession, folder: str) -> DataFrame:
    assigned, centroids = simplex_clusters.cluster(table(spark, folder, "embeddings"))
    centroids = centroids.select(
        "cluster",
        F.col("inertia").alias("cluster_inertia"),
        F.col("total").alias("inertia"),
        F.sha2(F.array_join("centroid", ","), 256).alias("centroid_sha256"),
    )
    # One row per centroid, 40 at most.
    return assigned.join(F.broadcast(centroids), "cluster").select("vec_id", "cluster", "distance", *centroids.columns[1:])


def op12_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.scan(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        *(f"n_{kind}" for kind in pii.KINDS),
        "n_added",
        F.sha2(pii.spelled(F.col("base")), 256).alias("base_sha256"),
        pii.spelled(F.col("spans")).alias("spans"),
    )


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    seed = F.crc32(F.col("doc_id").cast("string"))
    looped = F.when(seed % 10 == 0, periodic_runs.with_loops(F.col("text"), seed)).otherwise(F.col("text"))
    found = periodic_runs.periodic_runs(docs.select("doc_id", looped.alias("text")))
    best = F.array_min(F.transform("runs", lambda run: F.struct(-run["length"], run["start"], run["period"], run.alias("run"))))
    line = F.transform("runs", lambda run: F.concat_ws(",", run["start"], run["length"], run["period"]))
    found = found.withColumn("best", best["run"])
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *(F.col(f"best.{name}").alias(name) for name in ("start", "length", "period")),
        F.floor(F.expr("1000 * best.length div best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(line, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    run.__name__: run
    for run in (
        op1_top_k,
        op2_toxicity,
        op3_line_dedup,
        op4_licenses,
        op5_packing,
        op6_near_dups,
        op7_secrets,
        op8_url_filters,
        op9_sharding,
        op10_decontamination,
        op11_centroids,
        op12_pii,
        op13_periodic_runs,
    )
}

"""Registered queries of the operators in this package."""

from __future__ import annotations

from vantage.llm import (
    embedding_dedup,
    exact_dedup,
    language_id,
    license_scan,
    mixing,
    packing,
    pii,
    quality_rules,
    simhash,
    sphere_clusters,
    suffix_dedup,
    toxicity,
    vector_codes,
)
from vantage.llm.shared import documents
from vantage.llm.vectors import embeddings


def op1_mix_sources(spark, sf_dir):
    return mixing.mix(documents(spark, sf_dir)).drop("hash_key")


def op2_suffix_dedup(spark, sf_dir):
    return suffix_dedup.without_repeats(documents(spark, sf_dir))


def op3_toxicity(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.score(documents(spark, sf_dir), labels)


def op4_exact_dedup(spark, sf_dir):
    return exact_dedup.decisions(documents(spark, sf_dir)).drop("loc_file", "loc_row")


def op5_pii(spark, sf_dir):
    return pii.replace(documents(spark, sf_dir))


def op6_license_scan(spark, sf_dir):
    return license_scan.scan(documents(spark, sf_dir))


def op7_simhash(spark, sf_dir):
    return simhash.near_duplicates(documents(spark, sf_dir))


def op8_packing(spark, sf_dir):
    return packing.pack(documents(spark, sf_dir))


def op9_language_id(spark, sf_dir):
    return language_id.identify(documents(spark, sf_dir))


def op10_quality_rules(spark, sf_dir):
    return quality_rules.verdicts(documents(spark, sf_dir))


def op11_embedding_dedup(spark, sf_dir):
    return embedding_dedup.near_duplicates(embeddings(spark, sf_dir))


def op12_vector_codes(spark, sf_dir):
    return vector_codes.compress(embeddings(spark, sf_dir))


def op13_centroid_clusters(spark, sf_dir):
    return sphere_clusters.cluster_table(embeddings(spark, sf_dir))


QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_pii": op5_pii,
    "op6_license_scan": op6_license_scan,
    "op7_simhash": op7_simhash,
    "op8_packing": op8_packing,
    "op9_language_id": op9_language_id,
    "op10_quality_rules": op10_quality_rules,
    "op11_embedding_dedup": op11_embedding_dedup,
    "op12_vector_codes": op12_vector_codes,
    "op13_centroid_clusters": op13_centroid_clusters,
}

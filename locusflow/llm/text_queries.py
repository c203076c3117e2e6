"""Queries of the operators that look at one document at a time: licenses, quality and secrets."""

from __future__ import annotations

from pyspark.sql import functions as F

from locusflow.llm import licences, personal, quality, secrets
from locusflow.llm.registry import documents, query, table


@query("op1_license_scan")
def op1_license_scan(spark, sf_dir):
    """Which license phrases and templates does each document hold?"""
    return licences.scan_licenses(documents(spark, sf_dir))


@query("op4_secret_scan")
def op4_secret_scan(spark, sf_dir):
    """Which spans of each document look like secrets, and which of them look live?"""
    return secrets.scan_secrets(documents(spark, sf_dir))


@query("op5_quality_classifier")
def op5_quality_classifier(spark, sf_dir):
    """How likely is each document of good quality?"""
    docs = documents(spark, sf_dir)
    weights = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score_documents(docs, weights)
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query("op7_personal_data")
def op7_personal_data(spark, sf_dir):
    """Which spans of each document look like personal data?"""
    return personal.scan_personal(documents(spark, sf_dir))

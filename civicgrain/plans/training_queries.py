"""Registered queries of the general data-preparation operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from civicgrain.operators.timestamps import resolve_meeting_moments
from civicgrain.sources.tables import texts


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return resolve_meeting_moments(texts(spark, folder)).distinct()


QUERIES = {"p3_found": p3_found}
ORACLE: dict[str, str] = {}

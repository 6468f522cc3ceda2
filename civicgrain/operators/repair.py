"""Dates read again: from link texts and addresses, and from the texts of documents without a date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicgrain.functions.dates import in_window, meeting_date, text_date


def reparsed(documents: DataFrame, as_of: str) -> DataFrame:
    """(doc_id, body_id, meeting_date, in_window): the date of the link text, else with the address; the window by ``as_of``."""
    rows = documents.select("doc_id", "body_id", meeting_date(F.col("link_text"), F.col("source_url")).alias("meeting_date"))
    return rows.withColumn("in_window", in_window(F.col("meeting_date"), as_of))


def parse_stats(dated: DataFrame) -> DataFrame:
    """(body_id, documents, parsed, inside, outside, undated) of each body."""
    return dated.groupBy("body_id").agg(
        F.count("*").alias("documents"), F.count("meeting_date").alias("parsed"), F.count_if("in_window").alias("inside"), F.count_if(~F.col("in_window")).alias("outside"), F.count_if(F.col("meeting_date").isNull()).alias("undated")
    )


def undated_with_text(documents: DataFrame) -> DataFrame:
    return documents.where("meeting_date is null and text is not null and length(text) > 0")


def dated_by_text(documents: DataFrame, start: str | Column) -> DataFrame:
    """(doc_id, meeting_date, was_inside, inside) of documents without a date whose text states one; inside is from ``start`` on."""
    rows = undated_with_text(documents).select("doc_id", F.col("in_window").alias("was_inside"), text_date(F.col("text")).alias("meeting_date")).where("meeting_date is not null")
    return rows.withColumn("inside", F.col("meeting_date") >= (F.lit(start).cast("date") if isinstance(start, str) else start))


def cost_outside(dated: DataFrame, runs: DataFrame, cost: Column) -> DataFrame:
    """(documents, input_tokens, output_tokens, cost): what was spent on documents thought to be in the window that their text puts outside; all runs of a document count."""
    late = dated.where("was_inside and not inside").select(F.col("doc_id").cast("int").alias("document_id"))
    got = runs.join(late, "document_id", "left_semi")
    return got.agg(F.countDistinct("document_id").alias("documents"), F.coalesce(F.sum("input_tokens"), F.lit(0)).alias("input_tokens"), F.coalesce(F.sum("output_tokens"), F.lit(0)).alias("output_tokens"), F.coalesce(F.round(F.sum(cost), 6), F.lit(0.0)).alias("cost"))

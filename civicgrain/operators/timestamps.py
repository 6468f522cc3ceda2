"""Problem 3: the day or moment a document's meeting took place, in one form."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicgrain.functions import timestamps as ts


def resolve_meeting_moments(documents: DataFrame, zones: Mapping[str, str] | None = None, source: str = "source", skipped: str = "later", repeated: str = "earlier") -> DataFrame:
    """(doc_id, resolved) for each row whose link text or address states a month, day or moment.

    ``resolved`` is ``YYYY-MM``, ``YYYY-MM-DD`` or ``YYYY-MM-DDTHH:MM:SSZ``, as exact as
    stated. The link text goes first; the address counts if the link text states neither
    month nor day, or lacks the year, and ``meeting_date`` only gives a year both lack.
    A time without a zone takes the zone that ``zones`` gives its source, else New York. An hour the zone's clocks
    skip is ``skipped``: "later" by the length of the gap, "earlier" by it, or "null" (only the day is stated); one they repeat is
    ``repeated``: the "earlier", the "later", or "null".

    Nulls and empty texts state nothing. A text that states nothing valid gives no row, and
    so does a day whose year stands nowhere. Rows that are repeated give repeated rows.
    Other columns, whatever their names, are neither read nor returned. The plan is a
    projection and a filter: no shuffle, no Python.
    """
    zone = ts.zone_of(F.col(source) if zones else None, zones)
    given = F.struct(ts.tidy(F.coalesce(F.col("link_text"), F.lit(""))).alias("link"), F.coalesce(F.col("source_url"), F.lit("")).alias("url"), F.year("meeting_date").alias("year"), zone.alias("zone"))

    def states(g: Column) -> Column:
        yearless = ts.let(ts.stated_day_without_year(g["link"]), lambda d: ts.with_year(d, F.coalesce(ts.url_year(g["url"], d["m"]), g["year"])))
        link = F.coalesce(ts.stated_date(g["link"]), ts.stated_month(g["link"]), yearless)
        return ts.let(link, lambda d: F.when(d.isNotNull(), ts.let(ts.stated_moment(g["link"], d, g["zone"], skipped, repeated), lambda e: F.coalesce(ts.iso_moment(e), ts.iso_day(d)))).otherwise(F.coalesce(ts.let(ts.url_date(g["url"]), ts.iso_day), ts.let(ts.url_epoch(g["url"]), ts.iso_moment))))

    return documents.select("doc_id", ts.let(given, states).alias("resolved")).where(F.col("resolved").isNotNull())

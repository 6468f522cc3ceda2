"""Sheets of a census of governments made into bodies, and matters of lists of bodies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicgrain.operators.tables import written

# Sheets whose units are of one kind.
UNIT_TYPES = {"School District": "School District", "DEP School Dist": "Dependent School District"}


def read_sheets(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Each sheet of a workbook, all columns text. The workbook is read on the driver: it is a file of at most a million rows a sheet."""
    import pandas as pd

    with pd.ExcelFile(path) as book:
        return {str(name): spark.createDataFrame(book.parse(name, dtype=str).astype(object).where(lambda d: d.notna(), None)) for name in book.sheet_names}


def unit_type(sheet: str, columns: list[str]) -> Column:
    if sheet == "General Purpose" and "UNIT_TYPE" in columns:
        kind = F.regexp_extract("UNIT_TYPE", "^.*? - (.*?)(?: - .*)?$", 1)  # "1 - COUNTY"
        return F.when(kind != "", F.initcap(F.lower(kind))).otherwise(F.coalesce(F.col("UNIT_TYPE"), F.lit("nan")))
    if sheet == "Special District" and "FUNCTION_NAME" in columns:
        return F.concat(F.lit("Special District - "), F.coalesce("FUNCTION_NAME", F.lit("Other")))
    return F.lit(UNIT_TYPES.get(sheet, sheet))


def census_bodies(sheets: dict[str, DataFrame]) -> DataFrame:
    """(body_id, name, segment, county, website, coverage_level, manual_notes) of the active units of all sheets.

    A unit entered twice counts once, by the earlier sheet and in it the smaller name. A sheet may lack
    columns: without IS_ACTIVE all its units are active, without a state the state is XX.
    """

    def one(order: int, sheet: str, frame: DataFrame) -> DataFrame:
        has = lambda c, default: F.col(c) if c in frame.columns else F.lit(default).cast("string")
        rows = frame.where("IS_ACTIVE = 'Y'") if "IS_ACTIVE" in frame.columns else frame
        kind, people = unit_type(sheet, frame.columns), has("POPULATION", None).try_cast("double").cast("long")
        note = F.concat(F.lit("Census 2022 "), kind, F.when(people.isNotNull(), F.concat(F.lit(", pop "), people.cast("string"))).otherwise(F.lit("")))
        return rows.select(
            F.lit(order).alias("sheet"), F.concat(F.lit("COG-"), F.col("CENSUS_ID_PID6").cast("string")).alias("body_id"), F.col("UNIT_NAME").alias("name"), F.concat(F.coalesce(has("STATE", None), F.lit("XX")), F.lit(" "), kind).alias("segment"),
            F.coalesce(has("COUNTY_AREA_NAME", None), F.lit("")).alias("county"), F.coalesce(has("WEB_ADDRESS", None), F.lit("")).alias("website"), F.lit(0).alias("coverage_level"), note.alias("manual_notes"),
        )

    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (one(k, sheet, frame) for k, (sheet, frame) in enumerate(sheets.items())))
    keep = [c for c in rows.columns if c not in ("sheet", "body_id")]
    first = rows.groupBy("body_id").agg(F.min_by(F.struct(*keep), F.struct("sheet", "name", "segment", "county", "website", "manual_notes")).alias("r"))
    return first.select("body_id", "r.*")


def sheet_counts(sheets: dict[str, DataFrame]) -> DataFrame:
    """(sheet, units, with_website) of the active units of each sheet."""

    def one(sheet: str, frame: DataFrame) -> DataFrame:
        rows = frame.where("IS_ACTIVE = 'Y'") if "IS_ACTIVE" in frame.columns else frame
        site = F.count_if(F.coalesce("WEB_ADDRESS", F.lit("")) != "") if "WEB_ADDRESS" in frame.columns else F.lit(0).cast("long")
        return rows.agg(F.lit(sheet).alias("sheet"), F.count("*").alias("units"), site.alias("with_website"))

    return reduce(DataFrame.unionByName, (one(s, f) for s, f in sheets.items()))


def most_frequent(rows: DataFrame, column: str, most: int = 25) -> DataFrame:
    """(column, rows) of the ``most`` values that stand oftenest, of equal ones the smaller; nulls aren't counted."""
    return rows.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), column).limit(most)


def manual_notes(name: Column, population: Column) -> Column:
    return F.concat_ws(", ", name, F.when(population.isNotNull(), F.concat(F.lit("pop "), population.cast("long").cast("string"))))


def expected_facts(signals: DataFrame, facts: DataFrame) -> DataFrame:
    """(fact, found, wanted, elsewhere, passed) of each stated fact (fact, body, keywords array, least).

    A fact is a keyword in the scope or quote of signals of bodies with the given name part, at least ``least`` of them; ``elsewhere`` counts those
    of other bodies. ``signals`` has body, scope_summary and evidence_quote. The facts are a small stated list and are
    broadcast; signals are counted before anything is shuffled.
    """
    low = lambda c: F.lower(F.coalesce(c, F.lit("")))
    said = signals.select(low("body").alias("b"), low("scope_summary").alias("s"), low("evidence_quote").alias("q"))
    stated = written(facts.select("fact", F.lower("body").alias("body"), F.transform("keywords", lambda k: F.lower(k)).alias("keywords"), F.coalesce("least", F.lit(1)).alias("least")))
    if (n := stated.count()) > 10_000:
        raise ValueError(f"{n} facts: the check is for a list of at most 10,000")
    hit = said.join(F.broadcast(stated), F.exists("keywords", lambda k: F.col("s").contains(k) | F.col("q").contains(k)))
    counted = hit.groupBy("fact").agg(F.count_if(F.col("b").contains(F.col("body"))).alias("found"), F.count_if(~F.col("b").contains(F.col("body"))).alias("elsewhere"))
    rows = stated.join(counted, "fact", "left").select("fact", F.coalesce("found", F.lit(0)).alias("found"), F.col("least").alias("wanted"), F.coalesce("elsewhere", F.lit(0)).alias("elsewhere"))
    return rows.withColumn("passed", F.col("found") >= F.col("wanted"))

"""Grouping signals of one body, building and trade into projects, and rolling projects up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicgrain.functions.text import content_words, normalize_building, stage_rank
from civicgrain.operators.tables import label_groups, written

OVERLAP, SHARED = 0.4, 3


def scopes(signals: DataFrame, documents: DataFrame) -> DataFrame:
    """One row for each different set of content words in a block (body, building, first trade);
    ``id`` is its smallest signal. Signals without building or trade are in no block."""
    owner = documents.select(F.col("doc_id").cast("int").alias("document_id"), "body_id", "meeting_date")
    rows = signals.join(owner, "document_id").select("signal_id", "body_id", "meeting_date", "stage", "scope_summary", "building", normalize_building(F.col("building")).alias("place"), F.try_element_at("trades", F.lit(1)).alias("trade"), content_words(F.col("scope_summary")).alias("words"))
    return rows.where("place <> '' and trade <> '' and body_id is not null")


def similar_scopes(rows: DataFrame) -> DataFrame:
    """(a, b), a < b: different word sets of a block with Jaccard >= 0.4 or three words in common.

    Sets meet by their rarer words only: of two sets with so much in common one of the first
    ``n - least + 1`` words is shared, words being ordered from rare to common over all sets. Equal
    sets were put together before, and the commonest words, with a third of all sets or more, are hardly ever among the first.
    """
    sets = rows.groupBy("body_id", "place", "trade", "words").agg(F.min("signal_id").alias("id")).where(F.size("words") > 0)
    sets = written(sets)
    word = sets.select("body_id", "place", "trade", "id", "words", F.explode("words").alias("word"))
    held = sets.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("held"))
    ranked = word.join(held, "word").groupBy("body_id", "place", "trade", "id", "words").agg(F.array_sort(F.collect_list(F.struct("held", "word"))).alias("order"))
    least = F.least(F.lit(SHARED), F.ceil(F.size("words") * OVERLAP).cast("int"))
    first = ranked.select("body_id", "place", "trade", "id", "words", F.explode(F.slice("order", F.lit(1), F.size("words") - least + 1)).alias("o")).withColumn("word", F.col("o.word")).drop("o")
    l, r = first.alias("l"), first.alias("r")  # noqa: E741
    on = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in ("body_id", "place", "trade", "word")]
    shared, x, y = F.size(F.array_intersect("l.words", "r.words")).cast("long"), F.size("l.words"), F.size("r.words")
    both = l.join(r, [*on, F.col("l.id") < F.col("r.id")]).where((shared >= SHARED) | (shared >= OVERLAP * (x + y - shared)))
    return both.select(F.col("l.id").alias("a"), F.col("r.id").alias("b"), shared.alias("shared")).distinct()


def project_members(signals: DataFrame, documents: DataFrame) -> DataFrame:
    """(signal_id, project_id): every signal; a project is named by its smallest signal."""
    rows = written(scopes(signals, documents))
    labels = label_groups(similar_scopes(rows))
    sets = rows.groupBy("body_id", "place", "trade", "words").agg(F.min("signal_id").alias("id"))
    named = sets.join(labels, "id", "left").select("body_id", "place", "trade", "words", F.coalesce("group_id", "id").alias("project_id"))
    # an empty set of words resembles nothing, not even another one
    empty = F.size("words") == 0
    member = rows.join(named, ["body_id", "place", "trade", "words"]).select("signal_id", F.when(empty, F.col("signal_id")).otherwise(F.col("project_id")).alias("project_id"))
    return signals.select("signal_id").join(member, "signal_id", "left").select("signal_id", F.coalesce("project_id", "signal_id").alias("project_id"))


def project_rollup(members: DataFrame, signals: DataFrame, documents: DataFrame) -> DataFrame:
    """One row a project: body, first building told and first scope, first and last date, furthest stage, number of signals."""
    date = documents.select(F.col("doc_id").cast("int").alias("document_id"), "body_id", "meeting_date")
    rows = members.join(signals.select("signal_id", "document_id", "building", "stage", "scope_summary"), "signal_id").join(date, "document_id", "left")
    told = F.when(F.coalesce("building", F.lit("")) != "", F.col("building"))
    return rows.withColumn("told", told).groupBy("project_id").agg(
        F.min("body_id").alias("body_id"), F.min_by("told", F.when(F.col("told").isNotNull(), F.col("signal_id"))).alias("building"), F.min_by("scope_summary", "signal_id").alias("scope_summary"),
        F.min("meeting_date").alias("first_signal_date"), F.max("meeting_date").alias("last_signal_date"),
        F.max_by("stage", F.struct(stage_rank(F.col("stage")), -F.col("signal_id"))).alias("latest_stage"), F.count("*").alias("signal_count"),
    )


def rebuilt(signals: DataFrame, documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(projects, signals): the derived table made anew, and the signals with their ``project_id`` put back."""
    members = written(project_members(signals, documents))
    linked = signals.drop("project_id").join(members, "signal_id").select(*signals.columns)
    return project_rollup(members, signals, documents), linked


def project_stats(projects: DataFrame, warn: int = 60) -> DataFrame:
    """(projects, signals, mean_signals, max_signals, too_large): one row, means null without projects."""
    n = F.col("signal_count")
    return projects.agg(F.count("*").alias("projects"), F.coalesce(F.sum(n), F.lit(0)).alias("signals"), F.round(F.avg(n), 4).alias("mean_signals"), F.max(n).alias("max_signals"), F.coalesce(F.max(n) > warn, F.lit(False)).alias("too_large"))


def largest_projects(projects: DataFrame, bodies: DataFrame, most: int = 10) -> DataFrame:
    """The ``most`` projects of most signals, of equal ones that of the smaller id, with the body's name cut to 30 characters."""
    top = projects.orderBy(F.desc("signal_count"), "project_id").limit(most)
    name = F.coalesce(F.substring("name", 1, 30), F.col("body_id"))
    return top.join(bodies.select("body_id", "name"), "body_id", "left").select("project_id", name.alias("body"), F.substring(F.coalesce("building", F.lit("-")), 1, 20).alias("building"), "latest_stage", "signal_count")

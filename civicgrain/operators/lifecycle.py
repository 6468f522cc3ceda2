"""Documents and bodies on their way through the pipeline: status, levels, derived rows, links to the calendar.

Tables are immutable, so every change is a new snapshot made by a join; nothing is updated in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicgrain.operators.tables import insert_absent, latest_rows, numbered


def of_values(frame: DataFrame, column: str, values: list | None) -> DataFrame:
    """The rows whose column is one of the values. An empty list names nothing: it counts as not given, and all rows stay."""
    return frame.where(F.col(column).isin(list(values))) if values else frame


def with_updates(rows: DataFrame, updates: DataFrame, key: str, order: Column | None = None) -> DataFrame:
    """The rows with the columns of ``updates`` put in place where the key agrees, nulls too.

    Of several updates of one key the last in the order counts (without one, any: give it
    where that matters). Columns that updates lack stay, and so do rows without an update. Keys that no row has add nothing.
    """
    changed = [c for c in updates.columns if c != key and c in rows.columns]
    one = latest_rows(updates.select(key, *changed, *([order.alias("_order")] if order is not None else [])), [key], [F.col("_order") if order is not None else F.lit(0)])
    new = one.select(F.col(key), F.struct(*changed).alias("_new"))
    put = lambda c: F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) if c in changed else F.col(c)
    return rows.join(new, key, "left").select(*(put(c) for c in rows.columns))


def replaced(old: DataFrame, new: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Derived rows after a run over the documents ``done`` (one column, the key): theirs are the new ones only, so a second run adds nothing and a document without new rows loses its old ones."""
    return old.join(done.select(key).distinct(), key, "left_anti").unionByName(new.select(*old.columns))


def levels_after(bodies: DataFrame, reached: DataFrame, compat: bool = False) -> DataFrame:
    """(body_id, old_level, new_level, note) of bodies whose level changes; ``reached`` is (body_id, level, note).

    The highest level reached counts, and levels never fall (``compat`` lets them). A body without a level is at 0.
    """
    best = reached.where("level is not null").groupBy("body_id").agg(F.max(F.struct("level", "note")).alias("r"))
    rows = bodies.select("body_id", F.coalesce("coverage_level", F.lit(0)).alias("old_level")).join(best, "body_id").select("body_id", "old_level", F.col("r.level").cast("int").alias("new_level"), F.col("r.note").alias("note"))
    return rows.where("new_level <> old_level" if compat else "new_level > old_level")


def log_levels(bodies: DataFrame, log: DataFrame, changes: DataFrame, at: Column) -> tuple[DataFrame, DataFrame]:
    """(bodies, log): levels put in place, and the changes appended to the log under the next ids."""
    last = log.agg(F.coalesce(F.max("id"), F.lit(0)).alias("last"))
    rows = numbered(changes, [F.col("body_id")], "n").crossJoin(F.broadcast(last))  # one row
    entries = rows.select((F.col("last") + F.col("n")).cast("int").alias("id"), "body_id", "old_level", "new_level", F.lit(None).cast("string").alias("blocker_code"), "note", at.alias("changed_at"))
    return with_updates(bodies, changes.select("body_id", F.col("new_level").alias("coverage_level"), at.alias("last_checked")), "body_id"), log.unionByName(entries.select(*log.columns))


def new_documents(known: DataFrame, found: DataFrame, by_body: bool = True) -> DataFrame:
    """The found links (body_id, source_url, ...) that no document has, the first of each, with status new.

    Two bodies may publish one address: documents are told apart by body and address (``by_body=False``
    keeps the first owner of an address only).
    """
    keys = ["body_id", "source_url"] if by_body else ["source_url"]
    order = F.struct(*(c for c in ("page_order", "link_order", "body_id") if c in found.columns))
    return insert_absent(known, found, keys, order).withColumn("status", F.lit("new"))


def calendar_after(calendar: DataFrame, documents: DataFrame) -> DataFrame:
    """The calendar with a regular meeting added for each body and day of a document that has none."""
    new = documents.where("body_id is not null and meeting_date is not null").select("body_id", "meeting_date").distinct().join(calendar.select("body_id", "meeting_date"), ["body_id", "meeting_date"], "left_anti")
    last = calendar.agg(F.coalesce(F.max("meeting_id"), F.lit(0)).alias("last"))
    rows = numbered(new, [F.col("body_id"), F.col("meeting_date")], "n").crossJoin(F.broadcast(last))  # one row
    made = rows.select((F.col("last") + F.col("n")).cast("int").alias("meeting_id"), "body_id", "meeting_date", F.lit("regular").alias("meeting_type"), F.lit(None).cast("string").alias("title"))
    return calendar.select(*made.columns).unionByName(made)


def linked_to_calendar(documents: DataFrame, calendar: DataFrame) -> DataFrame:
    """The documents with the smallest meeting of their body and day as ``meeting_id``; undated ones keep theirs."""
    first = calendar.groupBy("body_id", "meeting_date").agg(F.min("meeting_id").alias("_id"))
    return documents.join(first, ["body_id", "meeting_date"], "left").withColumn("meeting_id", F.coalesce("_id", "meeting_id")).select(*documents.columns)


def stage_counts(documents: DataFrame) -> DataFrame:
    """(stage, documents): what each stage of a run would take, in order; nothing is run."""
    takes = (("fetch", "new"), ("extract", "fetched"), ("scan", "extracted"), ("classify", "scanned"), ("report", "classified"))
    counted = documents.agg(*(F.count_if(F.col("status") == status).alias(stage) for stage, status in takes))
    each = F.array(*(F.struct(F.lit(i).alias("step"), F.lit(stage).alias("stage"), F.col(stage).alias("documents")) for i, (stage, _) in enumerate(takes)))
    return counted.select(F.explode(each).alias("x")).select("x.*")


def written_by_status(documents: DataFrame, path: str) -> None:
    """The documents as a table partitioned by status: a stage reads only the files of its own status."""
    documents.repartition("status", F.pmod(F.xxhash64("doc_id"), F.lit(64))).write.mode("overwrite").partitionBy("status").parquet(path)


def missing_tables(expected: list[str], present: DataFrame) -> DataFrame:
    """(name) of expected tables that ``present`` (name) lacks."""
    return present.sparkSession.createDataFrame([(x,) for x in expected], "name string").join(present, "name", "left_anti")

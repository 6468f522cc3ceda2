"""Table operations on immutable files: upserts, inserts if absent, ownership, grouping."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civicgrain.functions.text import normalize_host


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, else the one given to the context.

    Where neither is set, a run on one machine makes a temporary one; a cluster is told to set it.
    """
    context = spark.sparkContext
    given = context._jsc.sc().getCheckpointDir()
    folder = spark.conf.get("spark.checkpoint.dir", None) or (given.get() if given.isDefined() else None)
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tables-")
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def written(frame: DataFrame) -> DataFrame:
    """The frame as a table in the shared folder: a lost executor loses no part of it.

    Unlike a checkpoint of rows, a table is compressed, read by column, and has a size the
    planner knows. It goes when the application ends.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(frame.schema).parquet(path)


def numbered(frame: DataFrame, order: list[Column], name: str = "place") -> DataFrame:
    """The rows with their place from 1 in a total order, without sorting in one task.

    Rows are cut into ranges of the order and sorted in each; a place is the number of rows
    in earlier ranges plus that inside. The order should end in something unique, so that no
    range is forced to hold a long tie.
    """
    keys = [f"_o{i}" for i in range(len(order))]
    sortable = frame.select("*", *(o.alias(k) for o, k in zip(order, keys)))
    parts = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = written(sortable.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("_id", F.monotonically_increasing_id()).drop(*keys))
    part = F.shiftright("_id", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    starts = ranges.groupBy(part.alias("_part")).agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    rows = ranges.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return rows.select(*frame.columns, (F.col("_start") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)) + 1).alias(name))


def latest_rows(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row a key, the last in the order; combined before the shuffle, so a hot key costs a row a task."""
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*(o.alias(f"o{i}") for i, o in enumerate(order)))).alias("_row"))
    return best.select(*keys, "_row.*").select(*rows.columns)


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """The old table with each key's latest new row in place of its own."""
    fresh = latest_rows(new, keys, [order]).select(*old.columns)
    return old.join(fresh, keys, "left_anti").unionByName(fresh)


def insert_absent(old: DataFrame, new: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """The new rows whose key the old table lacks, one a key, the first in the order."""
    rest = [c for c in new.columns if c not in keys]
    first = new.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_row")).select(*keys, "_row.*") if rest else new.distinct()
    return first.join(old.select(*keys), keys, "left_anti").select(*new.columns)


def first_owner(documents: DataFrame) -> DataFrame:
    """(doc_id, sha256, owner): the smallest id with the same text; null texts own nothing."""
    hashed = documents.where("text is not null").select("doc_id", F.sha2("text", 256).alias("sha256"))
    owner = hashed.groupBy("sha256").agg(F.min("doc_id").alias("owner"))
    return hashed.join(owner, "sha256").select("doc_id", "sha256", "owner")


def advance_levels(current: DataFrame, changes: DataFrame) -> DataFrame:
    """(body_id, old_level, new_level) of changes that raise a body's level; levels never fall."""
    best = changes.groupBy("body_id").agg(F.max("level").alias("new_level"))
    rows = current.join(best, "body_id").select("body_id", F.coalesce("coverage_level", F.lit(0)).alias("old_level"), "new_level")
    return rows.where("new_level > old_level")


def dedupe_by_host(rows: DataFrame, compat: bool = False) -> DataFrame:
    """Rows of one host merged into the one of smallest body_id: enrollment summed, names of the
    others noted, three or more rows marked in the name. Rows without a host stay as they are
    (``compat`` merges them too). The names of a host are gathered sorted and without repeats of a row."""
    hosted = rows.withColumn("host", normalize_host(F.col("website")))
    one = hosted.where("host <> ''" if not compat else "true")
    grouped = one.groupBy("host").agg(
        F.min("body_id").alias("body_id"), F.min_by("name", "body_id").alias("name"), F.sum("enrollment").alias("enrollment"), F.count("*").alias("n"),
        F.array_sort(F.collect_list(F.struct("body_id", "name"))).alias("all"),
    )
    others = F.array_join(F.transform(F.slice("all", F.lit(2), F.size("all")), lambda s: s["name"]), "; ")
    name = F.when(F.col("n") > 2, F.concat("name", F.lit(" (and "), (F.col("n") - 1).cast("string"), F.lit(" others)"))).otherwise(F.col("name"))
    merged = grouped.select("host", "body_id", name.alias("name"), F.col("enrollment").cast("long").alias("enrollment"), "n", F.when(F.col("n") > 1, F.concat(F.lit("Merged with: "), others)).alias("note"))
    if compat:
        return merged
    bare = hosted.where("host = ''").select("host", "body_id", "name", F.col("enrollment").cast("long").alias("enrollment"), F.lit(1).cast("long").alias("n"), F.lit(None).cast("string").alias("note"))
    return merged.unionByName(bare)


def label_groups(links: DataFrame) -> DataFrame:
    """(id, group_id) by minimum labels with labels of labels; (a, b) are links in either direction."""
    both = written(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = written(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("id"), F.least("a", "b").alias("group_id")))
    while True:
        near = both.join(labels, F.col("a") == F.col("id")).groupBy(F.col("b").alias("id")).agg(F.min("group_id").alias("least"))
        lower = labels.join(near, "id").select("id", "group_id", F.least("group_id", "least").alias("least"))
        jump = labels.select(F.col("id").alias("least"), F.col("group_id").alias("next"))
        step = written(lower.join(jump, "least").select("id", "group_id", F.least("least", "next").alias("least")))
        labels = step.select("id", F.col("least").alias("group_id"))
        if step.where("least <> group_id").isEmpty():
            return labels


def running_before(amount: Column, order: list[Column], partition: list[str]) -> Column:
    return F.coalesce(F.sum(amount).over(Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

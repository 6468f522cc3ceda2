"""Problem 5: one group id for all records linked directly or through others."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicgrain.llm.storage import saved

_PEEL_ROUNDS = 12


def valid_links(matches: DataFrame, records: DataFrame, least: float = 0.5) -> DataFrame:
    """(a, b), a < b: pairs whose latest row scores at least ``least``, both of them among the records.

    Of rows of one pair in either order the one with the latest ``matched_at`` counts, of
    equally late ones that with the greatest ``match_id``; a row without a time is older than
    any other. A null score is no match. Self matches, null ids and ids no record has are out.
    """
    rows = matches.where("left_id <> right_id").select(F.least("left_id", "right_id").alias("a"), F.greatest("left_id", "right_id").alias("b"), "score", "matched_at", "match_id")
    latest = rows.groupBy("a", "b").agg(F.max_by(F.struct("score"), F.struct("matched_at", "match_id"))["score"].alias("score"))
    ids = records.select("signal_id").where("signal_id is not null").distinct()
    good = latest.where(F.col("score") >= least).select("a", "b")
    return good.join(ids, F.col("a") == F.col("signal_id"), "left_semi").join(ids, F.col("b") == F.col("signal_id"), "left_semi")


def connected_components(links: DataFrame) -> DataFrame:
    """(id, group_id) of every linked id; group_id is the smallest id of its component.

    The component of the vertex of highest degree is peeled first: breadth-first frontier
    joins from that vertex collect it, and an anti-join takes it away. Should it be so long
    that the rounds run out, what was reached is contracted to that vertex, which keeps the
    rest exact. The remaining, small components are labelled by minimum propagation with
    contraction, so that chains take a logarithmic number of rounds. Only one-row results and
    the one vertex reach the driver. No links give no rows; repeated and reversed ones count once.
    """
    links = saved(links.select(F.col(links.columns[0]).alias("a"), F.col(links.columns[1]).alias("b")).where("a is not null and b is not null and a <> b").distinct())
    both = saved(links.union(links.select("b", "a")).distinct())
    # the count is combined before the shuffle, so a vertex with a third of all links costs one row a task
    top = both.groupBy("a").count().agg(F.max_by("a", F.struct("count", "a")).alias("v")).first()["v"]
    if top is None:
        return links.select(F.col("a").alias("id"), F.col("a").alias("group_id"))
    frontier = both.where(F.col("a") == F.lit(top)).select(F.col("a").alias("id")).limit(1)
    reached, whole = frontier, False
    # a frontier holds each vertex once. While it is small the planner broadcasts it by its stored size, so the hub's
    # links stay where they are; a large one is shuffled, and a key of many links is then split by adaptive execution
    for _ in range(_PEEL_ROUNDS):
        frontier = saved(both.join(frontier, F.col("a") == F.col("id"), "left_semi").select(F.col("b").alias("id")).distinct().join(reached, "id", "left_anti"))
        if frontier.isEmpty():
            whole = True
            break
        reached = reached.union(frontier)
    if whole:
        rest = both.join(reached, F.col("a") == F.col("id"), "left_anti")
        peeled = reached.crossJoin(F.broadcast(reached.agg(F.min("id").alias("group_id"))))  # one row
        return peeled.union(_minimum_propagation(saved(rest)))
    mark = reached.select("id", F.lit(top).alias("hub"))
    moved = both.join(mark.select(F.col("id").alias("a"), F.col("hub").alias("ha")), "a", "left").join(mark.select(F.col("id").alias("b"), F.col("hub").alias("hb")), "b", "left")
    rest = moved.select(F.coalesce("ha", "a").alias("a"), F.coalesce("hb", "b").alias("b")).where("a <> b").distinct()
    labels = saved(_minimum_propagation(saved(rest)))
    # the members of what was contracted share the hub's group, whose least id may be one of them
    hub = labels.where(F.col("id") == F.lit(top)).select(F.col("group_id").alias("g")).union(reached.agg(F.min("id"))).agg(F.min("g").alias("group_id"))
    old = labels.where(F.col("id") == F.lit(top)).select(F.col("group_id").alias("old"))
    rest = labels.where(F.col("id") != F.lit(top)).join(F.broadcast(old), F.col("group_id") == F.col("old"), "left").crossJoin(F.broadcast(hub.select(F.col("group_id").alias("least"))))
    return reached.crossJoin(F.broadcast(hub)).union(rest.select("id", F.when(F.col("old").isNotNull(), F.col("least")).otherwise(F.col("group_id"))))


def _minimum_propagation(both: DataFrame) -> DataFrame:
    """(id, group_id) by minimum labels; ``both`` holds each link in both directions.

    Each round every vertex takes the least id next to it, then its label's label, twice.
    Links are contracted to the labels and rounds repeat on what is left. At least half of
    the vertices of a chain or tree vanish in a round, whatever its diameter.
    """
    names, links = None, both
    while True:
        # counted before the shuffle, and stored: both jumps read it, twice each
        label = saved(links.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("id"), F.least("a", "b").alias("group_id")))
        step = saved(_jumped(saved(_jumped(label))))
        names = step if names is None else saved(names.join(step.select(F.col("id").alias("group_id"), F.col("group_id").alias("to")), "group_id", "left").select("id", F.coalesce("to", "group_id").alias("group_id")))
        ends = links.join(step.select(F.col("id").alias("a"), F.col("group_id").alias("x")), "a").join(step.select(F.col("id").alias("b"), F.col("group_id").alias("y")), "b")
        links = saved(ends.where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
        if links.isEmpty():
            return names


def _jumped(label: DataFrame) -> DataFrame:
    """Each label replaced by its own label; a vertex's least neighbour always has one."""
    return label.join(label.select(F.col("id").alias("group_id"), F.col("group_id").alias("to")), "group_id").select("id", F.col("to").alias("group_id"))


def group_records(matches: DataFrame, records: DataFrame, least: float = 0.5) -> DataFrame:
    """(signal_id, group_id) of each record with at least one valid match."""
    return connected_components(valid_links(matches, records, least)).select(F.col("id").alias("signal_id"), "group_id")

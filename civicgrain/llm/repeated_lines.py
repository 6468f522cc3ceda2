"""Problem 7: lines that recur in the documents of one body, found and taken out."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicgrain.llm.storage import saved

MIN_LENGTH, MIN_DOCUMENTS, MIN_PERCENT = 25, 6, 15
_COUNTERS = 4096  # of a summary; where they don't suffice, all lines of the body are counted
_BROADCAST_ROWS = 300_000  # candidates of 30 bytes or so; beyond it the join shuffles
_BLANK = " \t\r\f\v             　"


def line_key(line: Column) -> Column:
    """Equal for lines that differ only in case or in characters other than letters."""
    return F.xxhash64(F.lower(F.regexp_replace(line, r"[^\p{L}]+", "")))


def _long_enough(line: Column, least: int) -> Column:
    return F.length(F.btrim(line, F.lit(_BLANK))) >= least


def _lines(documents: DataFrame, least: int) -> DataFrame:
    rows = documents.where("text is not null and body_id is not null").select("doc_id", "body_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return rows.where(_long_enough(F.col("line"), least)).select("doc_id", "body_id", "line_no", line_key(F.col("line")).alias("key"))


def _summaries(documents: DataFrame, least: int) -> DataFrame:
    """Frequent-item summaries of each partition: (body_id, key, n) and, with a null key, (body_id, docs, slack).

    A counter falls short of the true number of documents by at most the slack of its
    summary, and sums of counters by at most the sum of slacks: summaries merge by addition.
    So does the count of a line that a summary doesn't hold at all.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict[str, dict[int, int]] = {}
        docs: dict[str, int] = {}
        slack: dict[str, int] = {}
        for batch in batches:
            for body, keys in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = counters.setdefault(body, {})
                docs[body] = docs.get(body, 0) + 1
                for k in set(keys):
                    own[k] = own.get(k, 0) + 1
                if len(own) > 2 * _COUNTERS:
                    cut = sorted(own.values(), reverse=True)[_COUNTERS]
                    counters[body] = {k: n - cut for k, n in own.items() if n > cut}
                    slack[body] = slack.get(body, 0) + cut
        for body, own in counters.items():
            m = len(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([body] * (m + 1)), pa.array([*own, None], pa.int64()), pa.array([*own.values(), 0], pa.int64()), pa.array([0] * m + [docs[body]], pa.int64()), pa.array([0] * m + [slack.get(body, 0)], pa.int64())],
                names=["body_id", "key", "n", "docs", "slack"],
            )

    line = F.filter(F.split("text", "\n"), lambda x: _long_enough(x, least))
    rows = documents.where("text is not null and body_id is not null").select("body_id", F.transform(line, line_key).alias("keys"))
    return rows.mapInArrow(run, "body_id string, key long, n long, docs long, slack long")


def _bounded(frame: DataFrame) -> DataFrame:
    """Marked for broadcast if its counted rows are few; else left to a shuffled join."""
    return F.broadcast(frame) if frame.count() <= _BROADCAST_ROWS else frame


def _enough(n: Column, docs: Column, least: int, percent: int) -> Column:
    return (n >= least) & (n * 100 >= docs * percent)


def _found(documents: DataFrame, min_length: int, min_documents: int, min_percent: int) -> tuple[DataFrame, DataFrame]:
    """(standing, confirmed): where candidate lines stand, and the (body_id, key) of those that recur."""
    merged = saved(_summaries(documents, min_length).groupBy("body_id", "key").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"), F.sum("slack").alias("slack")))
    totals = merged.where("key is null").select("body_id", "docs", "slack")
    # a line no summary holds stands in at most as many documents as the slack: where that could be enough, every line of the body is a candidate
    short = totals.where(_enough(F.col("slack"), F.col("docs"), min_documents, min_percent)).select("body_id", "docs")
    hopeful = merged.where("key is not null").select("body_id", "key", "n").join(totals, "body_id").where(_enough(F.col("n") + F.col("slack"), F.col("docs"), min_documents, min_percent))
    candidates = saved(hopeful.select("body_id", "key", "docs"))
    lines = _lines(documents, min_length)
    standing = lines.join(_bounded(candidates), ["body_id", "key"])
    if not short.isEmpty():
        standing = standing.join(short.select("body_id"), "body_id", "left_anti").unionByName(lines.join(short, "body_id"))
    standing = saved(standing)
    exact = standing.groupBy("body_id", "key", "docs").agg(F.countDistinct("doc_id").alias("n"))
    return standing, exact.where(_enough(F.col("n"), F.col("docs"), min_documents, min_percent)).select("body_id", "key")


def recurring_lines(documents: DataFrame, min_length: int = MIN_LENGTH, min_documents: int = MIN_DOCUMENTS, min_percent: int = MIN_PERCENT) -> DataFrame:
    """(doc_id, line_no) of lines that stand in at least ``min_documents`` and ``min_percent`` percent of a body's texts.

    Summaries name the candidates (in a body whose summaries ran too short, all of its lines
    are), a second pass counts exactly in how many documents each
    one stands. Rows with a null text or body are neither counted nor returned; an empty
    text is a text of one empty line. A line twice in a document counts once and is returned
    twice. Lines without any letter are the same line. Columns of other names don't matter.
    """
    standing, confirmed = _found(documents, min_length, min_documents, min_percent)
    return standing.join(confirmed, ["body_id", "key"], "left_semi").select("doc_id", "line_no")


def without_recurring_lines(documents: DataFrame, min_length: int = MIN_LENGTH, min_documents: int = MIN_DOCUMENTS, min_percent: int = MIN_PERCENT) -> DataFrame:
    """(doc_id, text): every document, its recurring lines taken out; a null text stays null.

    Each body's confirmed lines are a set that is broadcast, so texts are read in place. Should there be more of
    them than can be broadcast, texts are joined with the set of their own body by a shuffle.
    """
    _, confirmed = _found(documents, min_length, min_documents, min_percent)
    confirmed = saved(confirmed)
    small = confirmed.count() <= _BROADCAST_ROWS
    sets = confirmed.groupBy("body_id").agg(F.collect_set("key").alias("_out"))  # at most 100 / min_percent times the lines of an average document
    rows = documents.select("doc_id", "body_id", "text").join(F.broadcast(sets) if small else sets, "body_id", "left")
    kept = F.filter(F.split("text", "\n"), lambda x: ~(_long_enough(x, min_length) & F.array_contains("_out", line_key(x))))
    return rows.select("doc_id", F.when(F.col("_out").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"))

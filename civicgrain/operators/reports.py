"""Reports: coverage, signals, calibration, projects and the coverage trend, as frames and as files.

Frames stay distributed. Only what is small by nature (a row a level, a body with documents, the
first twenty of a list) is put into Markdown by the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicgrain.functions.text import evidence_found, shortened
from civicgrain.operators.tables import numbered, running_before

# Stages of signals in the order of the report; one without a stage comes last, an unlisted one before it.
_STAGE_ORDER = {"1_problem": 1, "2_study": 2, "3_funding": 3, "4_design": 4, "5_bid": 5, "6_award": 6, "7_construction": 7, "unknown": 99}
LEVELS = 7  # 0 to 6
MISSED_SHOWN = 20


def stage_order(stage: Column) -> Column:
    known = F.coalesce(*(F.when(F.coalesce(stage, F.lit("unknown")) == s, F.lit(n)) for s, n in _STAGE_ORDER.items()))
    return F.coalesce(known, F.lit(50))


def share(part: Column, whole: Column) -> Column:
    """Percent with one decimal; 0 of nothing is 0."""
    return F.coalesce(F.round(100 * F.try_divide(part.cast("double"), whole), 1), F.lit(0.0))


def owned_signals(signals: DataFrame, documents: DataFrame, bodies: DataFrame) -> DataFrame:
    """Signals with the document and body they stand in."""
    d = documents.select(F.col("doc_id").cast("int").alias("document_id"), "body_id", "source_url", "meeting_date", "in_window")
    return signals.where("is_signal").join(d, "document_id").join(bodies.select("body_id", F.col("name").alias("body")), "body_id")


def signals_report(signals: DataFrame, documents: DataFrame, bodies: DataFrame) -> DataFrame:
    """The rows of the signals file with their ``place``: in the window first, early stages, large amounts; ties by id."""
    rows = owned_signals(signals, documents, bodies)
    order = [F.when(F.col("in_window"), 0).otherwise(1), stage_order(F.col("stage")), -F.coalesce("dollar_amount", F.lit(0)), F.col("signal_id")]
    text = lambda c: F.coalesce(c, F.lit("")).alias(c)
    amount = F.when(F.coalesce("dollar_amount", F.lit(0)) != 0, F.col("dollar_amount"))
    placed = numbered(rows, order)
    return placed.select(
        "place", "signal_id", "body", "body_id", text("building"), F.coalesce(F.array_join("trades", ", "), F.lit("")).alias("trades"), text("stage"), "stage_verified", amount.alias("dollar_amount"),
        text("funding_source"), text("scope_summary"), text("evidence_quote"), "source_url", F.coalesce(F.col("meeting_date").cast("string"), F.lit("")).alias("meeting_date"), "in_window",
    )


def projects_report(projects: DataFrame, bodies: DataFrame) -> DataFrame:
    """The rows of the projects file with their ``place``: by stage, those without one last, then by latest date, undated last; ties by id."""
    rows = projects.join(bodies.select("body_id", F.col("name").alias("body")), "body_id")
    late = -F.unix_date("last_signal_date")
    order = [F.col("latest_stage").isNull(), F.col("latest_stage"), late.isNull(), late, F.col("project_id")]
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return numbered(rows, order).select("place", "project_id", "body", "body_id", *(text(c) for c in ("building", "scope_summary", "first_signal_date", "last_signal_date", "latest_stage")), "signal_count")


def repeated_scopes(signals: DataFrame, documents: DataFrame, bodies: DataFrame, least: int = 3) -> DataFrame:
    """(body_id, body, scope_summary, signals, first_date, last_date, stages) of scopes a body states ``least`` times in the window."""
    rows = owned_signals(signals, documents, bodies).where("in_window and scope_summary is not null")
    got = rows.groupBy("body_id", "body", "scope_summary").agg(F.count("*").alias("signals"), F.min("meeting_date").alias("first_date"), F.max("meeting_date").alias("last_date"), F.collect_set("stage").alias("stages"))
    return got.where(F.col("signals") >= least).withColumn("stages", F.array_join(F.array_sort("stages"), ", "))


def in_window_pairs(signals: DataFrame, passages: DataFrame, documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Signals and passages of documents in the window, both with ``doc_id``."""
    inside = documents.where("in_window").select(F.col("doc_id").cast("long").alias("doc_id"), "body_id")
    s = signals.where("is_signal").select("signal_id", F.col("document_id").cast("long").alias("doc_id"), "passage_index", "scope_summary", "evidence_quote").join(inside, "doc_id")
    return s, passages.select(F.col("doc_id").cast("long").alias("doc_id"), "passage_index", "passage_text").join(inside.select("doc_id"), "doc_id")


def calibration(signals: DataFrame, passages: DataFrame, documents: DataFrame, by_index: bool = False, partial: float | None = 0.8) -> tuple[DataFrame, DataFrame]:
    """(signals, passages) of documents in the window, each with ``met``.

    A signal and a keyword passage of one document meet if the quote stands in the passage or the passage in the quote, white space and case
    apart, or else if ``partial`` of the quote's words do in order (null leaves that out); a signal without a quote meets nothing.
    ``by_index`` keeps the old reading, in which they meet by their numbers, although these count different things.
    """
    s, p = in_window_pairs(signals, passages, documents)
    if by_index:
        said = s.select("doc_id", "passage_index").distinct().withColumn("met", F.lit(True))
        held = p.select("doc_id", "passage_index").distinct().withColumn("met", F.lit(True))
        return tuple(a.join(b, ["doc_id", "passage_index"], "left").withColumn("met", F.coalesce("met", F.lit(False))) for a, b in ((s, held), (p, said)))
    tidy = lambda c: F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"\s+", " "))
    quote, passage = tidy(F.col("evidence_quote")), tidy(F.col("passage_text"))
    pairs = s.select("doc_id", "signal_id", quote.alias("q")).where("q <> ''").join(p.select("doc_id", "passage_index", passage.alias("t")), "doc_id")
    met = F.col("t").contains(F.col("q")) | F.col("q").contains(F.col("t"))
    if partial is not None:
        met = met | evidence_found(F.col("q"), F.col("t"), partial)
    pairs = pairs.where(met)
    mark = lambda rows, keys: rows.join(pairs.select(*keys).distinct().withColumn("met", F.lit(True)), keys, "left").withColumn("met", F.coalesce("met", F.lit(False)))
    return mark(s, ["doc_id", "signal_id"]), mark(p, ["doc_id", "passage_index"])


def calibration_rates(signals: DataFrame, passages: DataFrame) -> DataFrame:
    """(rate, part, whole, pct): missed, signals that met no passage; false_hit, passages that met no signal."""
    count = lambda rows, name: rows.agg(F.lit(name).alias("rate"), F.count_if(~F.col("met")).alias("part"), F.count("*").alias("whole"))
    both = count(signals, "missed").unionByName(count(passages, "false_hit"))
    return both.withColumn("pct", share(F.col("part"), F.col("whole")))


def missed_signals(signals: DataFrame, shown: int = MISSED_SHOWN) -> DataFrame:
    """(place, signal_id, body_id, scope, quote) of the first missed signals by id, cut for reading, and a last row
    without a signal whose ``scope`` tells how many more there are, if there are."""
    missed = signals.where("not met")
    first = missed.orderBy("signal_id").limit(shown)
    rows = first.select(F.row_number().over(Window.orderBy("signal_id")).alias("place"), "signal_id", "body_id", shortened(F.col("scope_summary"), 60, "no summary").alias("scope"), shortened(F.col("evidence_quote"), 100, "no quote").alias("quote"))  # at most ``shown`` rows
    more = missed.agg((F.count("*") - shown).alias("n")).where("n > 0").select(F.lit(shown + 1).alias("place"), F.lit(None).cast("int").alias("signal_id"), F.lit(None).cast("string").alias("body_id"), F.concat(F.lit("and "), F.col("n").cast("string"), F.lit(" more")).alias("scope"), F.lit(None).cast("string").alias("quote"))
    return rows.unionByName(more)


def coverage_trend(bodies: DataFrame, log: DataFrame) -> DataFrame:
    """(step, date, level_0 ... level_6, level_3_plus): bodies at each level before all entries of the log (step 0, date "initial") and after each.

    The start is what is there now less all that the log moved; from there changes are summed in the order of time and id.
    Sums run over days first and inside a day next, so no task holds the log. A null level is level 0.
    """
    levels = range(LEVELS)
    at = lambda c, k: (F.coalesce(c, F.lit(0)) == k).cast("long")
    now = bodies.agg(*(F.coalesce(F.sum(at(F.col("coverage_level"), k)), F.lit(0)).alias(f"n{k}") for k in levels))
    moves = log.select("id", "changed_at", F.to_date("changed_at").alias("day"), *((at(F.col("new_level"), k) - at(F.col("old_level"), k)).alias(f"d{k}") for k in levels))
    whole = moves.agg(*(F.coalesce(F.sum(f"d{k}"), F.lit(0)).alias(f"t{k}") for k in levels))
    initial = now.crossJoin(F.broadcast(whole)).select(*((F.col(f"n{k}") - F.col(f"t{k}")).alias(f"i{k}") for k in levels))  # one row each
    days = moves.groupBy("day").agg(F.count("*").alias("c"), *(F.sum(f"d{k}").alias(f"d{k}") for k in levels))
    order = [F.col("day").asc_nulls_last()]
    before = days.select("day", *(running_before(F.col(f"d{k}"), order, []).alias(f"b{k}") for k in levels), running_before(F.col("c"), order, []).alias("bc"))  # a row a day
    inside = Window.partitionBy("day").orderBy("changed_at", "id").rowsBetween(Window.unboundedPreceding, 0)
    rows = moves.withColumn("r", F.count("*").over(inside)).select("day", "r", *(F.sum(f"d{k}").over(inside).alias(f"s{k}") for k in levels))
    rows = rows.withColumn("key", F.coalesce(F.col("day"), F.lit("9999-12-31").cast("date"))).join(F.broadcast(before.withColumn("key", F.coalesce(F.col("day"), F.lit("9999-12-31").cast("date"))).drop("day")), "key").crossJoin(F.broadcast(initial))
    after = rows.select((F.col("bc") + F.col("r")).alias("step"), F.coalesce(F.col("day").cast("string"), F.lit("unknown")).alias("date"), *((F.col(f"i{k}") + F.col(f"b{k}") + F.col(f"s{k}")).alias(f"level_{k}") for k in levels))
    start = initial.select(F.lit(0).cast("long").alias("step"), F.lit("initial").alias("date"), *(F.col(f"i{k}").alias(f"level_{k}") for k in levels))
    return start.unionByName(after).withColumn("level_3_plus", sum((F.col(f"level_{k}") for k in range(3, LEVELS)), F.lit(0)))


def _table(title: str, names: list[str], rows: list[list]) -> str:
    line = lambda cells: "| " + " | ".join("" if c is None else str(c) for c in cells) + " |"
    return "\n".join([f"## {title}", "", line(names), line(["---"] * len(names)), *map(line, rows), ""])


def coverage_markdown(bodies: DataFrame, documents: DataFrame, signals: DataFrame) -> str:
    """The coverage report: levels with their shares, blockers, and documents and signals of each body that has documents."""
    levels = bodies.groupBy("coverage_level").agg(F.count("*").alias("n"), F.coalesce(F.sum("enrollment"), F.lit(0)).alias("e")).orderBy(F.asc_nulls_last("coverage_level")).collect()
    n, e = sum(r["n"] for r in levels), sum(r["e"] for r in levels)
    percent = lambda a, b: f"{100 * a / b if b else 0:.1f}%"
    parts = ["# Coverage Report", "", _table("Bodies by Coverage Level", ["Level", "Bodies", "%", "Enrollment", "% Enrollment"], [[r["coverage_level"], r["n"], percent(r["n"], n), f"{r['e']:,}", percent(r["e"], e)] for r in levels] + [["**Total**", f"**{n}**", "", f"**{e:,}**", ""]])]
    blockers = bodies.where("blocker_code <> ''").groupBy("blocker_code").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "blocker_code").collect()
    if blockers:
        parts.append(_table("Blocker Codes", ["Blocker Code", "Count"], [[r["blocker_code"], r["n"]] for r in blockers]))
    held = documents.groupBy("body_id").agg(F.count_if("in_window").alias("inside"), F.count_if(~F.col("in_window")).alias("outside"), F.count_if(F.col("in_window").isNull()).alias("undated"))
    told = signals.where("is_signal").join(documents.select(F.col("doc_id").cast("int").alias("document_id"), "body_id", "in_window"), "document_id").groupBy("body_id").agg(F.count_if("in_window").alias("signals"), F.count_if(~F.col("in_window")).alias("late"))
    rows = bodies.select("body_id", "name").join(held, "body_id").join(told, "body_id", "left").orderBy("name", "body_id").collect()
    if rows:
        each = [[r["name"], r["inside"], r["outside"], r["undated"], r["signals"] or 0] for r in rows]
        parts.append(_table("Per-Body Document Statistics", ["Body", "In Window", "Out of Window", "No Date", "Signals (in window)"], each + [["**Total**", *(f"**{sum(x[k] for x in each)}**" for k in range(1, 5))]]))
    parts.append(f"*Out-of-window totals: {sum(r['outside'] for r in rows)} documents, {sum(r['late'] or 0 for r in rows)} signals*\n")
    return "\n".join(parts)


def calibration_markdown(rates: DataFrame, missed: DataFrame, repeated: DataFrame, shown: int = 200) -> str:
    """The calibration report: both rates, the first missed signals, and the scopes stated most often, with how many more there are.

    All of the latter are rows of the ``repeated_scopes`` file.
    """
    names = {"missed": "Miss rate (signal without a keyword passage)", "false_hit": "False-hit rate (keyword passage without a signal)"}
    lines = ["# Calibration Report", "", "*Documents in the window only*", "", "## Rates", "", *(f"- **{names[r['rate']]}**: {r['pct']:.1f}% ({r['part']}/{r['whole']})" for r in rates.orderBy(F.desc("rate")).collect()), ""]
    gaps = missed.orderBy("place").collect()
    if gaps:
        lines += ["## Missed Passages", "", *(f"- [{r['body_id']}] {r['scope']} Quote: \"{r['quote']}\"" if r["body_id"] is not None else f"*... {r['scope']}*" for r in gaps), ""]
    rows = repeated.orderBy(F.desc("signals"), "body", "scope_summary").limit(shown).collect()
    more = repeated.count() - len(rows)
    lines.append(_table("Repeated Projects", ["Body", "Scope Summary", "Count", "First Date", "Last Date", "Stages"], [[r["body"], (r["scope_summary"][:50] + "...") if len(r["scope_summary"]) > 50 else r["scope_summary"], r["signals"], r["first_date"], r["last_date"], r["stages"]] for r in rows]) if rows else "*No scope is stated three times by one body.*\n")
    if more > 0:
        lines.append(f"*... and {more} more*\n")
    return "\n".join(lines)

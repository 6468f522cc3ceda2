"""Packing texts into chunks, calling a model on them, and checking what it says."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicgrain.functions.text import evidence_found, json_array, money
from civicgrain.operators.scan import Vocabulary
from civicgrain.operators.tables import written

CHUNK = 12_000
SIGNAL = (
    "array<struct<is_signal:boolean,trades:array<string>,stage:string,stage_evidence:string,building:string,scope_summary:string,dollar_amount:string,"
    "funding_source:string,key_dates:string,vendors_named:string,evidence_quote:string,page_or_item:string,confidence:decimal(5,4)>>"
)


def packed(text: Column, size: int, separator: str) -> Column:
    """Passages between separators put together while they fit; one that doesn't fit stands alone. A text that fits stays as it is."""
    strip = lambda p: F.regexp_replace(p, r"(?U)^\s+|\s+$", "")
    passages = F.filter(F.transform(F.split(text, separator), strip), lambda p: p != "")

    def put(held: Column, p: Column) -> Column:
        full = (held["now"] != "") & (F.length(held["now"]) + F.length(p) + 2 > size)
        done = F.when(full, F.concat(held["done"], F.array(held["now"]))).otherwise(held["done"])
        return F.struct(done.alias("done"), F.when(full | (held["now"] == ""), p).otherwise(F.concat(held["now"], F.lit("\n\n"), p)).alias("now"))

    nothing = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("now"))
    parts = F.aggregate(passages, nothing, put, lambda held: F.when(held["now"] == "", held["done"]).otherwise(F.concat(held["done"], F.array(held["now"]))))
    return F.when(F.length(text) <= size, F.array(text)).otherwise(parts)


def chunks(documents: DataFrame, size: int = CHUNK, separator: str = r"\n\s*\n") -> DataFrame:
    """(doc_id, chunk_index, chunk), by a fold over a text's passages inside the row."""
    rows = documents.where("text is not null and text <> ''")
    return rows.select("doc_id", F.posexplode(packed(F.col("text"), size, separator)).alias("chunk_index", "chunk"))


def prompt(words: Vocabulary, fields: dict[str, str]) -> str:
    """What a model is told: keys of trades and stages with their labels, the fields wanted, and the rules."""
    listed = lambda title, rows: "\n".join([f"{title}:", *(f"  {k}: {v}" for k, v in rows.items())])
    rules = (
        "Answer with a JSON array of objects, one for each project or purchase, or [] if there is none.",
        "Staff matters, tuition, curriculum and policy are no signals.",
        "Copy evidence_quote and stage_evidence word for word from the text.",
        "Use keys of the lists only; the stage is unknown unless words about this project show it.",
    )
    return "\n\n".join([listed("Trades", words.labels("trades")), listed("Stages", words.labels("stages")), listed("Fields", fields), "\n".join(rules)])


def classify(documents: DataFrame, model: Callable[[str], str], size: int = CHUNK, retry: Callable[[str], str] | None = None) -> DataFrame:
    """Signals of documents by an injected model that answers a chunk with a JSON array.

    Only a literal false drops a signal. ``quote_verified`` and ``stage_verified`` tell
    whether what was quoted stands in the chunk; an unknown stage has no evidence. Where some
    quote of a chunk's answer doesn't, ``retry`` (if given) is asked once, and its first
    signal of the same scope takes the place of the one at fault; what it quotes is checked again.
    """

    def answers(ask: Callable[[str], str]) -> Callable:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                yield batch.assign(answer=[ask(c) for c in batch.chunk])

        return run

    shape = "doc_id long, chunk_index int, chunk string, text_method string, answer string"
    asked = chunks(documents, size).join(documents.select("doc_id", "text_method"), "doc_id").select("doc_id", "chunk_index", "chunk", "text_method")
    said = written(asked.mapInPandas(answers(model), shape))  # a model is asked once
    found = lambda s: evidence_found(s["evidence_quote"], F.col("chunk")) & evidence_found(s["stage_evidence"], F.col("chunk"))
    signals = said.select("doc_id", "chunk_index", "chunk", "text_method", F.posexplode(json_array(F.col("answer"), SIGNAL)).alias("n", "s")).where("s.is_signal is null or s.is_signal")
    if retry is not None:
        signals = written(signals.withColumn("ok", found(F.col("s"))))
        at_fault = signals.where("not ok").select("doc_id", "chunk_index", "chunk", "text_method").distinct()
        again = written(at_fault.mapInPandas(answers(retry), shape)).select("doc_id", "chunk_index", json_array(F.col("answer"), SIGNAL).alias("again"))
        same = F.get(F.filter("again", lambda r: r["scope_summary"].eqNullSafe(F.col("s.scope_summary"))), F.lit(0))
        signals = signals.join(again, ["doc_id", "chunk_index"], "left").withColumn("s", F.when(F.col("ok"), F.col("s")).otherwise(F.coalesce(same, F.col("s"))))
    rows = signals.select("doc_id", F.col("chunk_index").alias("passage_index"), F.col("chunk").alias("text"), "text_method", "s.*")
    known = F.coalesce(F.col("stage"), F.lit("unknown")) != "unknown"
    evidence = F.when(known, F.col("stage_evidence"))
    amount = money(F.col("dollar_amount"))
    return rows.select(
        "doc_id", "passage_index", F.coalesce("is_signal", F.lit(True)).alias("is_signal"), "trades", "stage", evidence.alias("stage_evidence"),
        (known & (F.coalesce(evidence, F.lit("")) != "") & evidence_found(evidence, F.col("text"))).alias("stage_verified"), "building", "scope_summary", amount.alias("dollar_amount"),
        ((F.col("text_method") == "ocr") & (F.coalesce(amount, F.lit(0)) != 0)).alias("amount_from_ocr"), "funding_source", "key_dates", "vendors_named", "evidence_quote",
        evidence_found(F.col("evidence_quote"), F.col("text")).alias("quote_verified"), "page_or_item", "confidence",
    )


def run_cost(prices: dict[str, tuple[float, float]], default: tuple[float, float] = (1.0, 5.0)) -> Column:
    """Cost of a run from its tokens and prices per million of input and output tokens."""
    model = F.lower(F.col("model"))
    rate = lambda k: F.coalesce(*(F.when(model == m, F.lit(p[k])) for m, p in prices.items()), F.lit(default[k]))
    return (F.col("input_tokens") * rate(0) + F.col("output_tokens") * rate(1)) / 1e6


def within_budget(runs: DataFrame, prices: dict[str, tuple[float, float]], cap: float) -> DataFrame:
    """(day, run_id, spent_before) of each day's runs in order up to the one that crosses the cap.

    A day may hold any number of runs: hours are summed first, and the order inside an hour
    is a window of its own.
    """
    rows = runs.where("created_at is not null").select("run_id", F.to_date("created_at").alias("day"), F.date_trunc("hour", "created_at").alias("hour"), "created_at", run_cost(prices).alias("cost"))
    hours = rows.groupBy("day", "hour").agg(F.sum("cost").alias("held"))
    past = Window.unboundedPreceding
    before = hours.select("day", "hour", F.coalesce(F.sum("held").over(Window.partitionBy("day").orderBy("hour").rowsBetween(past, -1)), F.lit(0.0)).alias("base"))
    inside = F.coalesce(F.sum("cost").over(Window.partitionBy("day", "hour").orderBy("created_at", "run_id").rowsBetween(past, -1)), F.lit(0.0))
    spent = rows.withColumn("inside", inside).join(before, ["day", "hour"]).withColumn("spent_before", F.col("base") + F.col("inside"))
    return spent.where(F.col("spent_before") < cap).select("day", "run_id", F.round("spent_before", 6).alias("spent_before"))


def running_prefix(rows: DataFrame, spent: DataFrame, cap: float) -> DataFrame:
    """The rows (doc_id, cost, ...) in order of id up to the one that crosses the cap, ``spent`` (one row, spent) counted in.

    Costs are summed by stretches of ids first, so no task holds them all.
    """
    past, stretch = Window.unboundedPreceding, F.floor(F.col("doc_id") / 10_000)
    rows = rows.withColumn("_part", stretch)
    parts = rows.groupBy("_part").agg(F.sum("cost").alias("_held"))
    before = parts.select("_part", F.coalesce(F.sum("_held").over(Window.orderBy("_part").rowsBetween(past, -1)), F.lit(0.0)).alias("_before"))  # a row a stretch
    inside = F.coalesce(F.sum("cost").over(Window.partitionBy("_part").orderBy("doc_id").rowsBetween(past, -1)), F.lit(0.0))
    placed = rows.withColumn("_inside", inside).join(before, "_part").crossJoin(F.broadcast(spent))  # one row
    return placed.where(F.col("spent") + F.col("_before") + F.col("_inside") < cap).drop("_part", "_inside", "_before", "spent")


def cost_summary(runs: DataFrame, prices: dict[str, tuple[float, float]], cap: float) -> DataFrame:
    """(day, runs, spent, cap, reached, remaining) of each day, models summed."""
    days = runs.where("created_at is not null").groupBy(F.to_date("created_at").alias("day")).agg(F.count("*").alias("runs"), F.sum(run_cost(prices)).alias("cost"))
    limit = F.lit(float(cap))
    return days.select("day", "runs", F.round("cost", 6).alias("spent"), limit.alias("cap"), (F.col("cost") >= limit).alias("reached"), F.round(F.greatest(limit - F.col("cost"), F.lit(0.0)), 6).alias("remaining"))


def to_classify(documents: DataFrame, ids: list[int] | None = None, everything: bool = False) -> DataFrame:
    """The documents a run would take: those named, else all scanned ones, else the scanned ones in the window; none without a text.

    An empty list names nothing and counts as not given. Those left out keep their status.
    """
    ready = documents.where("text is not null and text <> ''")
    if ids:
        return ready.where(F.col("doc_id").isin([int(i) for i in ids]))
    scanned = ready.where("status = 'scanned'")
    return scanned if everything else scanned.where("in_window")

"""Scanning documents for a vocabulary: keyword lines, and passages of context around them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicgrain.functions.text import any_keyword, first_seen_keywords, matching_keys, plain_blanks, without_phrases

BEFORE, AFTER, LEAST = 2, 3, 25


@dataclass(frozen=True)
class Vocabulary:
    """Keywords by trade and stage, trigger words, phrases to ignore, and patterns of lines to skip."""

    trades: dict[str, list[str]] = field(default_factory=dict)
    stages: dict[str, list[str]] = field(default_factory=dict)
    triggers: list[str] = field(default_factory=list)
    negatives: list[str] = field(default_factory=list)
    skips: list[str] = field(default_factory=list)
    names: dict[str, dict[str, str]] = field(default_factory=dict)

    @classmethod
    def from_yaml(cls, path: str) -> Vocabulary:
        """A taxonomy file with trades and stages (label, keywords), triggers, negatives and skip_patterns."""
        import yaml

        with open(path, encoding="utf-8") as f:
            raw = yaml.safe_load(f)
        groups = lambda part: {str(k): [str(w) for w in v["keywords"]] for k, v in (raw.get(part) or {}).items()}
        words = lambda part: [str(w) for w in raw.get(part) or []]
        names = {part: {str(k): " - ".join(str(v[x]) for x in ("label", "value") if v.get(x)) for k, v in (raw.get(part) or {}).items()} for part in ("trades", "stages")}
        return cls(groups("trades"), groups("stages"), words("triggers"), words("negatives"), words("skip_patterns"), names)

    def labels(self, part: str) -> dict[str, str]:
        """What each key of trades or stages stands for, the key itself where the file doesn't say."""
        return {k: self.names.get(part, {}).get(k) or k for k in getattr(self, part)}

    def telling(self) -> list[str]:
        return [w for words in self.trades.values() for w in words] + self.triggers

    def clean(self, line: Column) -> Column:
        """The line in lower case, skipped lines empty, phrases to ignore taken out."""
        skipped = line.rlike("(?i)" + "|".join(f"(?:{s})" for s in self.skips)) if self.skips else F.lit(False)
        return F.when(skipped, F.lit("")).otherwise(without_phrases(F.lower(plain_blanks(line)), self.negatives))


def keyword_lines(documents: DataFrame, words: Vocabulary) -> DataFrame:
    """(doc_id, line_no, trades, stages, triggers) of lines with a trade's keyword or a trigger.

    One alternation over all keywords filters first, so that the single patterns see few lines.
    """
    lines = documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    hits = lines.select("doc_id", "line_no", words.clean(F.col("line")).alias("line")).where(any_keyword(F.col("line"), words.telling()))
    own = {w: [w] for w in words.triggers}
    return hits.select("doc_id", "line_no", matching_keys(F.col("line"), words.trades).alias("trades"), matching_keys(F.col("line"), words.stages).alias("stages"), matching_keys(F.col("line"), own).alias("triggers"))


def keyword_passages(documents: DataFrame, words: Vocabulary) -> DataFrame:
    """(doc_id, passage_index, start_line, end_line, passage_text, trades, stages, triggers, keywords).

    Hit lines with two lines before and three after; frames that touch are one passage.
    Passages shorter than 25 characters go before numbering. Hits further apart than a frame
    begin and end passages, so frames, texts and numbers are made inside the row: nothing is
    shuffled. ``keywords`` holds those of trades and triggers as they are first met.
    """
    lines = F.split("text", "\n")
    base = documents.where("text is not null").select("doc_id", lines.alias("lines"), F.transform(lines, words.clean).alias("clean"))
    telling = words.telling()
    base = base.withColumn("told", F.transform("clean", lambda x: F.when(any_keyword(x, telling), x)))
    base = base.withColumn("hits", F.filter(F.transform("told", lambda x, i: F.when(x.isNotNull(), i)), lambda i: i.isNotNull()))
    apart = BEFORE + AFTER + 1
    begins = F.filter("hits", lambda x, i: (i == 0) | (x - F.get("hits", i - 1) > apart))
    ends = F.filter("hits", lambda x, i: (i == F.size("hits") - 1) | (F.get("hits", i + 1) - x > apart))
    base = base.withColumn("frames", F.arrays_zip(begins.alias("a"), ends.alias("b")))
    strip = lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", "")

    def passage(f: Column) -> Column:
        start, end = F.greatest(f["a"] - BEFORE, F.lit(0)), F.least(f["b"] + AFTER, F.size("lines") - 1)
        text = F.array_join(F.filter(F.transform(F.slice("lines", start + 1, end - start + 1), strip), lambda x: x != ""), " ")
        said = F.array_compact(F.slice("told", f["a"] + 1, f["b"] - f["a"] + 1))  # keywords count on hit lines only
        return F.struct(start.alias("start_line"), end.alias("end_line"), text.alias("passage_text"), said.alias("said"))

    passages = F.filter(F.transform("frames", passage), lambda p: F.length(p["passage_text"]) >= LEAST)
    rows = base.select("doc_id", F.posexplode(passages).alias("passage_index", "p")).select("doc_id", "passage_index", "p.*")
    own = {w: [w] for w in words.triggers}
    joined = F.array_join("said", "\n")
    keys = [matching_keys(joined, g).alias(n) for n, g in (("trades", words.trades), ("stages", words.stages), ("triggers", own))]
    keywords = first_seen_keywords(F.col("said"), words.trades | {"": words.triggers}).alias("keywords")
    return rows.select("doc_id", "passage_index", "start_line", "end_line", "passage_text", *keys, keywords)


def scan_counters(passages: DataFrame, documents: DataFrame) -> DataFrame:
    """(kind, key, documents, pct, chars): documents with hits in all, by trade and by stage, their share of all documents, and characters of their passages."""
    whole = documents.agg(F.count("*").alias("whole"))
    kinds = lambda c: F.transform(c, lambda k: F.struct(F.lit(c).alias("kind"), k.alias("key"))).alias(c)
    told = passages.select("doc_id", F.length("passage_text").alias("n"), F.array(F.struct(F.lit("all").alias("kind"), F.lit("").alias("key"))).alias("every"), kinds("trades"), kinds("stages"))
    each = told.select("doc_id", "n", F.explode(F.concat("every", "trades", "stages")).alias("x")).groupBy("x", "doc_id").agg(F.sum("n").alias("n"))
    rows = each.groupBy("x").agg(F.count("*").alias("documents"), F.sum("n").alias("chars")).crossJoin(F.broadcast(whole))  # one row
    return rows.select("x.kind", "x.key", "documents", F.round(100.0 * F.try_divide(F.col("documents").cast("double"), F.col("whole")), 1).alias("pct"), "chars")


def blank_passages(documents: DataFrame, words: Vocabulary, separator: str = r"\n\s*\n") -> DataFrame:
    """(doc_id, passage_no, trades): the older scanner, passages between blank lines of more than 25 characters."""
    parts = documents.select("doc_id", F.posexplode(F.split("text", separator)).alias("passage_no", "p"))
    rows = parts.select("doc_id", "passage_no", F.trim(F.regexp_replace("p", r"\s+", " ")).alias("p")).where(F.length("p") > LEAST)
    hits = rows.select("doc_id", "passage_no", words.clean(F.col("p")).alias("line")).where(any_keyword(F.col("line"), words.telling()))
    return hits.select("doc_id", "passage_no", matching_keys(F.col("line"), words.trades).alias("trades"))

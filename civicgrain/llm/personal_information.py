"""Problem 10: personal information in free text, by bootstrapped contextual extraction.

One pass over the texts lists candidates: pieces whose form could be an e-mail address, a
phone or identity number, a street address or a name, each with the words on both sides.
Seeds are the pieces that are certain by themselves (a few very common given names, numbers
labelled as social security numbers, phone numbers with a bracketed or country code, mail and street addresses
in full form). Seeds
give their contexts confidence, confident contexts make new instances, and these new
contexts, round by round over the graph of contexts and instances. A candidate counts if
it is a seed, its context confident or its instance known; looser forms of mail and street addresses need
confident contexts on both sides. A name that goes on in a capitalised word may be that of
a building, body, street or firm: which words make it one is learned, too, from how often
names before them stand in confident contexts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicgrain.llm.storage import saved

# The most common given names of the census, as seeds.
SEED_GIVEN = "james robert john michael william david richard thomas mary patricia jennifer linda elizabeth susan margaret".split()
_TITLES = "Mr|Mrs|Ms|Miss|Dr|Prof|Sr|Sra|Srta|Hon|Rev|Trustee|Member|Councilman|Councilwoman|Councilmember|Commissioner"
# Legal forms and signs after a name that make it a firm whatever the corpus.
_FIRM = r"Inc|LLC|L\.L\.C|Corp|Corporation|Co|Company|Ltd|PC|P\.C|&"
_STREETS = "Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Drive|Dr|Boulevard|Blvd|Place|Pl|Court|Ct|Terrace|Ter|Circle|Cir|Way|Highway|Hwy|Parkway|Pkwy|Turnpike|Tpke|Square|Sq|Path|Trail"
# Postal codes of the states, and how the state of the documents is written out.
_STATES = (
    "AL|AK|AZ|AR|CA|CO|CT|DE|FL|GA|HI|ID|IL|IN|IA|KS|KY|LA|ME|MD|MA|MI|MN|MS|MO|MT|NE|NV|NH|NJ|NM|NY|NC|ND|OH|OK|OR|PA|RI|SC|SD|TN|TX|UT|VT|VA|WA|WV|WI|WY|DC|N\\.Y\\.|New York"
)
_BREAK = r"(?:[-‐¬­~|]\s*\n\s*[a-z]+)?"
_SUR = r"(?:(?:O['’]|Mc|Mac|De|Di|Van|Le|La)(?=[A-Z]))?[A-ZÀ-Þ][\w'’|~]*[\wà-ÿ]" + _BREAK + r"(?:[-‐](?:O['’]|Mc)?[A-ZÀ-Þ][\w'’]+" + _BREAK + ")?"
_GIV = r"[A-ZÀ-Þ][\w|~]*[\wà-ÿ]" + _BREAK
_GAP = r"(?:[^\S\n]+|[^\S\n]*\n[^\S\n]*)"  # a blank line ends a name
_MID = "(?:" + _GAP + r"[A-Z]\.)"
EMAIL = re.compile(r"(?<![\w.+-])[\w+-]+(?:\.[\w+-]+)*@[\w-]+(?:\.[\w-]+)+")
_STOPS = frozenset(" \t\n\r\f\v\u00a0@(<[,;:")
PHONE = re.compile(r"(?=[+(\d])(?<![\w.$#-])(?:\+?1[ .-])?(?:\(\d{3}\)\s?|\d{3}[ ./-])\d{3}[ .-]\d{4}(?![\w-]|\.\d)|(?=\d)(?<![\w.$#/-])(?<!\d )\d{3}-\d{4}(?![\w-]|\.\d)")
NUMBER = re.compile(r"(?=[A-Z\d])(?<![\w.$-])(?:\d{3}([-. ])\d{2}\1\d{4}|\d{3} \d{3} \d{3}|\d{9}|[A-Z]{1,2}-?\d{5,9})(?![\w-]|\.\d)")
ADDRESS = re.compile(
    r"(?=[\dP])(?<![\w.$/-])(?:\d{1,5}[A-Z]?\s+(?:[NSEW]\.?\s+)?(?:[A-Z][\w'’]+\s+){1,3}?(?:" + _STREETS + r")\b\.?|(?:P\.?\s?O\.?|Post Office)\s+Box\s+\d+)"
    r"(?:,?\s+(?:(?:Apt|Apartment|Unit|Suite|Ste|Floor|Fl|Rm|Room)\.?\s*#?\s*|#\s?)[\w-]+)?"
    r"(?:,\s+(?:[A-Z][\w'’.-]+\s+){0,2}[A-Z][\w'’-]+,\s+(?:" + _STATES + r")(?:\s+\d{5}(?:-\d{4})?)?)?"
)
NAME = re.compile(
    r"(?=[A-ZÀ-Þ])(?:\b(?P<title>" + _TITLES + r")\b\.?\s+)?"
    r"(?P<name>(?<![\w'’@.-])(?:"
    r"(?P<g1>" + _GIV + ")" + _MID + "?" + _GAP + "(?P<s1>" + _SUR + ")"
    r"|(?:[A-Z]\.\s*){1,2}(?P<s2>" + _SUR + ")"
    "|(?P<s3>" + _SUR + ")," + _GAP + "(?P<g3>" + _GIV + ")" + _MID + "?"
    "|(?P<s5>" + _SUR + ")," + _GAP + r"[A-Z]\.(?:\s?[A-Z]\.)?"
    r"|(?P<s4>" + _SUR + ")))(?![\\w@])"
)
_STREET = re.compile(r"\b(?:" + _STREETS + r"|Box)\b")
_NEXT = re.compile(r"\s*(?:" + _FIRM + "|" + _STREETS + r")(?!\w)")
_GOES_ON = re.compile(r"[^\S\n]*\n?[^\S\n]*([A-ZÀ-Þ][\w'’]*)")
LOOSE_MAIL = re.compile(r"(?<![\w.+-])[\w+.-]+(?: ?@ ?| ?[\[(]at[\])] ?| at )[\w-]+(?:(?: ?\. ?| ?[\[(]dot[\])] ?| dot )[\w-]+)+", re.I)
_JOINED_TO = re.compile(r"[\w.$/#-]")  # what a house number doesn't stand behind
LOOSE_ADDRESS = re.compile(r"\d{1,5}[^\S\n]+[A-Z][\w'’]+(?:[^\S\n]+[A-Z][\w'’]+)?(?![\w'’])")
_SIDE = re.compile(r"[^\W\d_]+[#.]?|\d+|[^\w\s]")
_SEEDED = re.compile(r"(?:\(\d{3}\)|\+1)")
_NOT_GIVEN = frozenset("the a an on in at by of for to and or with as is".split())
_MOST_ROUNDS = 20  # the rounds end when nothing new is known; each adds instances, so they do end
_LED = 0.3  # share of names before a word that stand in confident contexts, below which the word makes them something else
_BROADCAST_ROWS = 300_000  # confident patterns and instances of 40 bytes or so; beyond it the joins shuffle


def _around(text: str, start: int, end: int) -> tuple[str, str]:
    """The two tokens before and after a piece, digits made equal."""
    before, after = text[max(0, start - 40) : start], text[end : end + 60]
    if "@" in before:
        before = EMAIL.sub("@", before)
    after = EMAIL.sub("@", after)[:30] if "@" in after else after[:30]
    left, right = _SIDE.findall(before)[-2:], _SIDE.findall(after)[:2]
    plain = lambda w: "0" if w[0].isdigit() else w.lower()
    return " ".join(map(plain, left)), " ".join(map(plain, right))


def _flat(piece: str) -> str:
    return " ".join(piece.split())


def candidates_of(text: str) -> list[tuple[str, str, str, str, str, bool, int, int, str]]:
    """(kind, found, left, right, instance, certain, start, end, after) of every piece of a text; pieces of different kinds don't overlap.

    ``after`` is the capitalised word a name goes on in, if there is one, with a newline before it if it stands in the next line.
    """
    out, taken = [], []

    def add(kind: str, start: int, end: int, instance: str, certain: bool) -> None:
        taken.append((start, end))
        out.append((kind, _flat(text[start:end]), *_around(text, start, end), instance, certain, start, end, ""))

    at = text.find("@")
    while at >= 0:  # from sign to sign: trying every word for an address is slow
        start = at
        while start and text[start - 1] not in _STOPS:
            start -= 1
        m = EMAIL.search(text, start)
        if m and m.start() < at < m.end():
            add("email", *m.span(), m[0].lower().rpartition("@")[2], True)
        at = text.find("@", at + 1)
    for m in ADDRESS.finditer(text):
        start, end = m.span()
        # a sentence's own full stop doesn't belong to a street name written out or cut short
        if text[end - 1] == "." and not re.match(r"\.|,|\s+[a-z(]", text[end : end + 3]):
            end -= 1
        add("address", start, end, _STREET.search(m[0])[0].lower(), True)
    for m in PHONE.finditer(text):
        add("phone", *m.span(), m[0], bool(_SEEDED.match(m[0])))
    for m in NUMBER.finditer(text):
        if not any(a <= m.start() < b for a, b in taken):
            label = text[max(0, m.start() - 24) : m.start()].lower()
            add("id_number", *m.span(), m[0], "ssn" in label or "social security" in label)
    if "@ " in text or " @" in text or " dot " in text or "(dot)" in text or "[dot]" in text:
        for m in LOOSE_MAIL.finditer(text):
            if not any(a < m.end() and m.start() < b for a, b in taken):
                add("email", *m.span(), "?loose", False)
    busy = sorted(taken)
    free = 0
    for m in LOOSE_ADDRESS.finditer(text):
        while free < len(busy) and busy[free][1] <= m.start():
            free += 1
        if (free == len(busy) or busy[free][0] >= m.end()) and not (m.start() and _JOINED_TO.match(text[m.start() - 1])):
            left, right = _around(text, *m.span())
            out.append(("address", _flat(m[0]), left, right, "?loose", False, *m.span(), ""))
    at, k = 0, 0
    while m := NAME.search(text, at):
        start, end = m.span("name")
        if m["title"] and (m["s3"] or m["s5"]):
            end = m.end("s3") if m["s3"] else m.end("s5")  # after a title a comma ends the name
        at = max(m.start("name") + 1, m.start() + 1)
        while k < len(busy) and busy[k][1] <= start:
            k += 1
        if k < len(busy) and busy[k][0] < end:
            at = max(at, busy[k][1])
            continue
        if m["s4"] and not m["title"]:
            at = end
            continue  # one capitalised word alone says nothing
        given = (m["g1"] or (m["g3"] if not m["title"] else "") or "").lower()
        if m["g1"] and (m["g1"] in _TITLE_SET or given in _NOT_GIVEN):
            at = m.end("g1")
            continue
        if m["s3"] and not m["title"] and (m["g3"] in _TITLE_SET or m["s3"] in _TITLE_SET):
            at = m.end("s3")
            continue
        if _NEXT.match(text, end):
            at = m.end("g1") if m["g1"] else end
            continue
        left, right = _around(text, m.start("title") if m["title"] else start, end)
        on = _GOES_ON.match(text, end)
        out.append(("name", _flat(text[start:end]), left, right, given or "?" + ("title" if m["title"] else "initial"), bool(m["title"]), start, end, (("\n" if "\n" in on[0] else "") + on[1].lower()) if on else ""))
        at = end if (m["title"] or not m["g1"]) else m.end("g1")  # overlapping readings are settled once names are known
    return out


_TITLE_SET = frozenset(_TITLES.split("|"))
_SCHEMA = "doc_id long, kind string, found string, left string, right string, instance string, certain boolean, start int, end int, after string"


def _candidates(documents: DataFrame) -> DataFrame:
    types = (pa.int64(), *[pa.string()] * 5, pa.bool_(), pa.int32(), pa.int32(), pa.string())
    names = [c.split()[0] for c in _SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows += [(i, *c) for c in candidates_of(text)]
            columns = list(zip(*rows)) if rows else [[]] * 10
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return documents.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null and text is not null").mapInArrow(run, _SCHEMA)


def _bootstrap(candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kind, pattern) and (kind, instance) that rounds over the graph make confident, until a round adds nothing."""
    # a name that goes on in its line speaks against its context, one that may go on in the next line says nothing
    open_ = candidates.where("after not like '\n%'").withColumn("ends", (F.col("after") == "").cast("long"))
    sides = F.explode(F.array(F.concat(F.lit("L "), "left"), F.concat(F.lit("R "), "right")))
    told = open_.select("kind", sides.alias("pattern"), "instance", "certain", "ends").where("kind <> 'name' or (pattern not like 'L %.' and substring(pattern, 3) rlike '[^0-9 ,.;:-]')")  # anything may begin a sentence
    edges = saved(told.groupBy("kind", "pattern", "instance").agg(F.count("*").alias("n"), F.sum("ends").alias("m"), F.max("certain").alias("certain")))
    shape = F.col("kind") == "name"
    known = saved(edges.where((shape & F.col("instance").isin(SEED_GIVEN)) | (~shape & F.col("certain"))).select("kind", "instance").distinct())
    sure, held = None, -1
    for _ in range(_MOST_ROUNDS):
        told = edges.where(~shape | ~F.col("instance").startswith("?")).join(known.withColumn("good", F.lit(1)), ["kind", "instance"], "left")
        score = told.groupBy("kind", "pattern").agg(F.sum(F.col("good") * F.col("m")).alias("good"), F.sum("n").alias("n"), F.countDistinct(F.when((F.col("good") == 1) & (F.col("m") > 0), F.col("instance"))).alias("kinds"))
        # hosts and street types are few, so one of them that stands twice is enough, but loose forms mustn't prevail; given names and numbers must differ
        coarse = F.col("kind").isin("email", "address")
        various = F.col("kinds") >= F.when(shape, 3).when(coarse, 1).otherwise(2)
        sure = saved(score.where(various & (F.col("good") >= 2) & (F.col("good") >= F.when(coarse, 0.5).otherwise(0.1) * F.col("n"))).select("kind", "pattern"))
        # an instance is known once most of what it does happens in confident contexts
        seen = edges.join(sure.withColumn("good", F.lit(1)), ["kind", "pattern"], "left").groupBy("kind", "instance").agg(F.sum(F.col("good") * F.col("m")).alias("good"), F.sum("m").alias("n"))
        new = seen.where(~F.col("instance").startswith("?")).where((shape & (F.col("good") >= 2) & (F.col("good") >= 0.3 * F.col("n"))) | (~shape & (F.col("good") >= 1))).select("kind", "instance")
        known = saved(known.union(new).distinct())
        if (now := known.count()) == held:
            break
        held = now
    return sure, known


def _bounded(frame: DataFrame) -> DataFrame:
    """Marked for broadcast if its counted rows are few, so that the hottest contexts aren't shuffled; else left to a shuffled join."""
    return F.broadcast(frame) if frame.count() <= _BROADCAST_ROWS else frame


def find_personal_information(documents: DataFrame) -> DataFrame:
    """(doc_id, pii_kind, found, start, end) of each piece of personal information, as often as it stands.

    ``found`` is the piece as it stands, white space made single blanks. Null ids and texts give nothing; repeated rows give repeated rows.
    """
    candidates = saved(_candidates(documents))
    sure, known = _bootstrap(candidates)
    left = sure.where("pattern like 'L %'").select("kind", F.expr("substring(pattern, 3)").alias("left"), F.lit(True).alias("left_sure"))
    right = sure.where("pattern like 'R %'").select("kind", F.expr("substring(pattern, 3)").alias("right"), F.lit(True).alias("right_sure"))
    known = saved(known.withColumn("known", F.lit(True)))
    # what goes on in a word that names in confident contexts hardly ever go on in isn't a person's name
    led = candidates.where("kind = 'name' and after <> '' and after not like '\n%'").join(_bounded(left), ["kind", "left"], "left")
    sign = led.groupBy("after").agg(F.count("*").alias("n"), F.count_if("left_sure").alias("good")).where(F.col("good") < _LED * F.col("n"))
    sign = saved(sign.select(F.lit("name").alias("kind"), F.explode(F.array("after", F.concat(F.lit("\n"), "after"))).alias("after"), F.lit(True).alias("part_of")))
    rows = candidates.join(_bounded(left), ["kind", "left"], "left").join(_bounded(right), ["kind", "right"], "left").join(_bounded(known), ["kind", "instance"], "left").join(_bounded(sign), ["kind", "after"], "left")
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    name = F.col("kind") == "name"
    ok = F.when(F.col("kind").isin("email", "address"), F.col("certain") | flag("left_sure") & flag("right_sure"))
    ok = ok.when(name & flag("part_of"), F.lit(False))
    ok = ok.when(name & F.col("instance").startswith("?"), F.col("certain") | flag("left_sure") | flag("right_sure"))
    ok = ok.when(name, flag("known") | F.col("certain")).otherwise(F.col("certain") | (flag("left_sure") | flag("right_sure")) & flag("known"))
    good = rows.where(ok)
    # of readings of one stretch of names that overlap, the earliest stands
    before = F.max(F.when(name, F.col("end"))).over(Window.partitionBy("doc_id").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1))
    chosen = good.withColumn("before", before).where(~name | F.col("before").isNull() | (F.col("start") >= F.col("before")))
    return chosen.select("doc_id", F.col("kind").alias("pii_kind"), "found", "start", "end")


def redact(documents: DataFrame) -> DataFrame:
    """(doc_id, text): every document with typed placeholders such as ``[EMAIL]`` for its personal information."""
    spans = find_personal_information(documents).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("start", "end", "pii_kind"))).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                parts, at = [], 0
                for x in found or ():
                    if x["start"] >= at:
                        parts += [text[at : x["start"]], f"[{x['pii_kind'].upper()}]"]
                        at = x["end"]
                texts.append(None if text is None else "".join(parts) + text[at:])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(spans, "doc_id", "left").select("doc_id", "text", "spans").mapInArrow(run, "doc_id long, text string")

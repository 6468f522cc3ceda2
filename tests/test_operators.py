import datetime
import random

import pytest
from pyspark.sql import functions as F

from civicgrain.functions import dates, text
from civicgrain.operators import classify, scan, tables
from civicgrain.sources import files

WORDS = scan.Vocabulary(trades={"windows": ["window replacement"], "hvac": ["boiler"]}, stages={"bid": ["bond vote"]}, triggers=["change order"], negatives=["boilerplate"], skips=["Salary/Step"])


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)) if values else spark.range(1)
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("line,hit", [("new boilers here", True), ("boilerplate text", False), ("window replacement", True), ("window-replacement", True), ("Salary/Step boiler", False), ("the bond vote is near", False), ("reboiler", False)])
def test_keyword_rule(spark, line, hit):
    rows = spark.createDataFrame([(1, line)], "doc_id long, text string")
    assert (scan.keyword_lines(rows, WORDS).count() == 1) is hit


def brute_passages(lines):
    hits = [i for i, x in enumerate(lines) if "boiler" in x]
    frames = []
    for i in hits:
        a, b = max(0, i - 2), min(len(lines) - 1, i + 3)
        if frames and a <= frames[-1][1] + 1:
            frames[-1][1] = b
        else:
            frames.append([a, b])
    return [(a, b) for a, b in frames if len(" ".join(x.strip() for x in lines[a : b + 1] if x.strip())) >= 25]


def test_passages_against_brute_force(spark):
    rng = random.Random(3)
    texts = [[("boiler work in the hall" if rng.random() < 0.15 else rng.choice(["", "plain line of text", "x"])) for _ in range(rng.randint(1, 40))] for _ in range(60)]
    rows = spark.createDataFrame([(i, "\n".join(t)) for i, t in enumerate(texts)] + [(99, None), (98, "")], "doc_id long, text string")
    got = {}
    for r in scan.keyword_passages(rows, WORDS).collect():
        got.setdefault(r.doc_id, []).append((r.passage_index, r.start_line, r.end_line))
    for i, t in enumerate(texts):
        assert [x[1:] for x in sorted(got.get(i, []))] == brute_passages(t)
    assert 99 not in got and 98 not in got


@pytest.mark.parametrize("link,url,want", [
    ("March 3, 2024 Agenda", "", datetime.date(2024, 3, 3)), ("Sept. 5 2023", "", datetime.date(2023, 9, 5)), ("June 31, 2026", "", None), ("1-2-49", "", datetime.date(2049, 1, 2)), ("1-2-50", "", datetime.date(1950, 1, 2)),
    ("2012-03-15", "", datetime.date(2012, 3, 15)), ("May 2021", "", datetime.date(2021, 5, 1)), ("April 7", "/2022/x.pdf", datetime.date(2022, 4, 7)), ("3–4–24", "", datetime.date(2024, 3, 4)), ("nothing", "", None),
])
def test_meeting_date(spark, link, url, want):
    assert one(spark, dates.meeting_date(F.col("a"), F.col("b")), a=link, b=url) == want


def test_meeting_date_compat(spark):
    assert one(spark, dates.meeting_date(F.col("a"), F.col("b"), compat=True), a="2012-03-15", b="") == datetime.date(2015, 12, 3)


def test_text_date_and_window(spark):
    for stated, want in (("held on 4 July 2025 here", (2025, 7, 4)), ("Jan 5, 2026", (2026, 1, 5)), ("on SEPT 9 2024 and Jan 5, 2026", (2024, 9, 9)), ("Feb 30, 2024 then 3/4/2024", (2024, 3, 4)), ("x 2024-02-29", (2024, 2, 29))):
        assert one(spark, dates.text_date(F.col("a")), a=stated) == datetime.date(*want)
    assert one(spark, dates.text_date(F.col("a")), a="x" * 3000 + " Jan 5, 2026") is None
    assert one(spark, dates.in_window(F.col("a").cast("date"), "2024-02-29"), a="2023-02-28") is True


@pytest.mark.parametrize("quote,body,want", [("", "x", True), ("a b c", "z a b  C d", True), ("a b c d z", "a x b x c x d", True), ("z a b c d", "a b c d", False), (None, None, True), ("q", None, False)])
def test_evidence(spark, quote, body, want):
    assert one(spark, text.evidence_found(F.col("a"), F.col("b")), a=quote, b=body) is want


def test_small_functions(spark):
    assert one(spark, text.json_array(F.col("a"), "array<struct<a:int>>"), a='so: [{"a":1}] done')[0]["a"] == 1
    assert one(spark, text.json_array(F.col("a"), "array<struct<a:int>>"), a="none") is None
    assert str(one(spark, text.money(F.col("a")), a="$1,234.50")) == "1234.50"
    assert one(spark, text.normalize_host(F.col("a")), a="HTTP://www.Site.example/home") == "site.example"
    assert one(spark, text.stage_rank(F.col("a")), a="5_bid") == 7
    assert one(spark, text.doc_type(F.col("a"), F.col("b")), a="Finance agenda", b="") == ("committee_agenda", "Finance")
    assert one(spark, text.content_words(F.col("a")), a="The roof of the School roof leaks") == ["leaks", "roof"]


def test_chunks_and_classification(spark):
    assert one(spark, classify.packed(F.col("a"), 5, r"\n\n"), a="a" * 10) == ["a" * 10]
    assert one(spark, classify.packed(F.col("a"), 9, r"\n\n"), a="aaaa\n\nbbb\n\n" + "c" * 20) == ["aaaa\n\nbbb", "c" * 20]
    assert one(spark, classify.packed(F.col("a"), 5, r"\n\n"), a="ab\n\n \n\n c \n\nd") == ["ab\n\nc", "d"]
    docs = spark.createDataFrame([(1, "bids were opened today", "ocr"), (2, None, "ocr")], "doc_id long, text string, text_method string")
    answer = '[{"stage":"5_bid","stage_evidence":"bids were opened","dollar_amount":"$5","trades":["x"]},{"is_signal":false}]'
    (row,) = classify.classify(docs, lambda chunk: answer).collect()
    assert row.stage_verified and row.amount_from_ocr and row.is_signal and str(row.dollar_amount) == "5.00"


def test_retry_takes_the_place_of_what_was_misquoted(spark):
    docs = spark.createDataFrame([(1, "bids were opened today for the roof", "text")], "doc_id long, text string, text_method string")
    first = '[{"scope_summary":"roof","evidence_quote":"bids were never opened","stage":"5_bid","stage_evidence":"bids were opened"},{"scope_summary":"pool","evidence_quote":"not there"}]'
    second = '[{"scope_summary":"roof","evidence_quote":"bids were opened","stage":"5_bid","stage_evidence":"opened today"}]'
    rows = {r.scope_summary: r for r in classify.classify(docs, lambda chunk: first, retry=lambda chunk: second).collect()}
    assert rows["roof"].quote_verified and rows["roof"].stage_evidence == "opened today" and not rows["pool"].quote_verified and len(rows) == 2
    assert classify.classify(docs.limit(0), lambda chunk: first, retry=lambda chunk: second).count() == 0


def test_places_across_ranges(spark):
    rows = spark.range(500).select("id", (F.col("id") % 3).alias("v"))  # a third of all rows tie
    got = {r.id: r.place for r in tables.numbered(rows, [-F.col("v"), F.col("id")]).collect()}
    want = sorted(range(500), key=lambda i: (-(i % 3), i))
    assert [got[i] for i in want] == list(range(1, 501)) and tables.numbered(rows.limit(0), [F.col("id")]).count() == 0


def test_keywords_as_first_seen(spark):
    words = scan.Vocabulary(trades={"a": ["roof", "boiler"], "b": ["boiler", "lintel"]}, triggers=["change order"])
    (row,) = scan.keyword_passages(spark.createDataFrame([(1, "a lintel and a boiler\nchange orders for the roof\nboiler")], "doc_id long, text string"), words).collect()
    assert row.keywords == ["boiler", "lintel", "roof", "change order"] and row.trades == ["a", "b"]
    counters = {(r.kind, r.key): (r.documents, r.pct) for r in scan.scan_counters(scan.keyword_passages(spark.createDataFrame([(1, "the roof leaks and is to be replaced"), (2, "x")], "doc_id long, text string"), words), spark.range(4)).collect()}
    assert counters == {("all", ""): (1, 25.0), ("trades", "a"): (1, 25.0)}


def test_similar_scopes_against_brute_force(spark):
    """The rarer words alone find all pairs, with a third of the sets sharing one common word."""
    from civicgrain.operators import projects

    rng = random.Random(5)
    sets = {i: sorted({rng.choice("abcdefghijklmnopqrst") * 4 for _ in range(rng.randint(1, 7))} | ({"common"} if i % 3 == 0 else set())) for i in range(120)}
    rows = spark.createDataFrame([(i, "b", "p", "t", w) for i, w in sets.items()], "signal_id int, body_id string, place string, trade string, words array<string>")
    first = {}
    for i, w in sets.items():
        first.setdefault(tuple(w), i)
    ids = sorted(first.values())
    want = {(i, j, len(set(sets[i]) & set(sets[j]))) for j in ids for i in ids if i < j and (len(set(sets[i]) & set(sets[j])) >= 3 or len(set(sets[i]) & set(sets[j])) >= 0.4 * len(set(sets[i]) | set(sets[j])))}
    assert {tuple(r) for r in projects.similar_scopes(rows).collect()} == want


def test_tables(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 3, 1), ("b", 4, 2), ("c", 5, 1)], "k string, v int, o int")
    assert {tuple(r) for r in tables.upsert(old, new, ["k"], F.col("o")).collect()} == {("a", 1), ("b", 4), ("c", 5)}
    assert {tuple(r) for r in tables.insert_absent(old, new.select("k", "v"), ["k"], F.col("v")).collect()} == {("c", 5)}
    links = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(100, 101)], "a int, b int")
    assert {(r.id, r.group_id) for r in tables.label_groups(links).collect()} == {(i, 0) for i in range(31)} | {(100, 100), (101, 100)}
    levels = spark.createDataFrame([("x", 5), ("y", 1)], "body_id string, coverage_level int")
    assert [tuple(r) for r in tables.advance_levels(levels, spark.createDataFrame([("x", 4), ("y", 3)], "body_id string, level int")).collect()] == [("y", 1, 3)]


def test_files(spark, tmp_path):
    (tmp_path / "b.csv").write_text("body_id,name,enrollment,last_checked\nx, ,12.5,2024-01-02\ny,Y, 7 ,bad\n")
    rows = {r.body_id: r for r in files.read_bodies_csv(spark, str(tmp_path / "b.csv")).collect()}
    assert rows["x"].name is None and rows["x"].enrollment is None and rows["x"].last_checked == datetime.datetime(2024, 1, 2) and rows["y"].enrollment == 7 and rows["y"].last_checked is None
    pages = spark.createDataFrame([("http://h.example/a/", '<a href="x.PDF"> The  file </a><a href="/y.pdf" title="T"></a><a href="z.html">z</a>'), (None, None)], "url string, html string")
    assert {(r.source_url, r.link_text) for r in files.pdf_links(pages).collect()} == {("http://h.example/a/x.PDF", "The file"), ("http://h.example/y.pdf", "T")}
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.txt").write_bytes(b"one\ntwo")
    assert [r.text for r in files.read_texts(spark, str(tmp_path / "t")).collect()] == ["one\ntwo"]
    got = files.read_binary(spark, str(tmp_path / "t"), lambda b: (b.decode(), 1)).first()
    assert got.needs_ocr and got.bytes == 7


def test_intake_twice_adds_nothing(spark, tmp_path):
    from civicgrain.streaming.intake import new_documents, store

    schema = "doc_id long, source_url string, fetched_at timestamp"
    data = spark.createDataFrame([(1, "u1", datetime.datetime(2024, 1, 1)), (2, "u1", datetime.datetime(2024, 1, 1)), (3, "u2", None)], schema)
    data.write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        stream = new_documents(spark, str(tmp_path / "in"), data.schema)
        store(stream, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).select("source_url").distinct().count() == spark.read.parquet(str(tmp_path / "out")).count() == 2

import datetime
import random

import pytest
from pyspark.sql import functions as F

from civicgrain import __main__ as command_line
from civicgrain import schemas
from civicgrain.functions import text
from civicgrain.operators import classify, discovery, lifecycle, registry, repair, reports, scan
from civicgrain.pipeline import Pipeline, Store

WORDS = scan.Vocabulary(trades={"roofing": ["roof"]}, stages={"5_bid": ["bid"]}, triggers=["change order"])
ANSWER = '[{"scope_summary":"new roof","stage":"5_bid","stage_evidence":"bid was opened","evidence_quote":"the roof","trades":["roofing"],"building":"High School","dollar_amount":"$1,000"}]'


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column.alias("x")).first()["x"]


def page(*links):
    return "".join(f'<a href="{u}">{t}</a>' for u, t in links)


@pytest.fixture
def line(spark, tmp_path):
    (tmp_path / "bodies.csv").write_text("body_id,name,coverage_level,enrollment\nb1,First,1,100\nb2,Second,,50\n")
    made = Pipeline(Store(spark, str(tmp_path / "data")), "2026-09-01", WORDS, {"model": (1.0, 5.0)}, now="2026-09-02 10:00:00")
    made.initialise()
    made.load_bodies(str(tmp_path / "bodies.csv"))
    return made


def test_all_stages(spark, line, tmp_path):
    pages = spark.createDataFrame([
        ("b1", 1, "https://one.example/board/", page(("a.pdf", "Agenda June 1, 2026"), ("a.pdf", "again"), ("old.pdf", "Minutes June 1, 2020"), ("x.html", "no"))),
        ("b2", 1, "https://two.example/", page(("/m.pdf", "Minutes"), ("/bad.pdf", "Packet May 2026"))),
    ], "body_id string, page_order int, url string, html string")
    assert line.discover(pages) == 3 and line.discover(pages) == 0
    documents = {r.source_url: r for r in line.store.read("documents").collect()}
    assert set(documents) == {"https://one.example/board/a.pdf", "https://two.example/m.pdf", "https://two.example/bad.pdf"}
    a = documents["https://one.example/board/a.pdf"]
    assert a.doc_type == "agenda" and a.meeting_date == datetime.date(2026, 6, 1) and a.in_window is True and a.status == "new"
    assert {r.body_id: r.coverage_level for r in line.store.read("bodies").collect()} == {"b1": 4, "b2": 4}
    assert line.store.read("meeting_calendar").count() == 2
    assert [r.documents for r in line.plan().orderBy("step").collect()] == [3, 0, 0, 0, 0]

    folder = tmp_path / "files"
    folder.mkdir()

    def get(url):
        if "bad" in url:
            raise OSError("gone")
        return b"same content"

    def save(name, content):
        place = folder / name.replace("/", "_")
        place.write_bytes(content)
        return str(place)

    assert line.fetch(get, save) == 3
    documents = {r.source_url[-5:]: r for r in line.store.read("documents").collect()}
    assert documents["d.pdf"].status == "error" and "gone" in documents["d.pdf"].error
    assert documents["a.pdf"].file_path == documents["m.pdf"].file_path and documents["a.pdf"].bytes == 12
    assert line.fetch(get, save) == 0
    body = "The board met.\nA bid was opened for the roof of the High School today.\nThanks." + " more" * 30
    assert line.extract(lambda path: ("", 2), lambda path: (body, 2)) == 2
    assert {r.text_method for r in line.store.read("documents").where("text is not null").collect()} == {"ocr"}
    assert line.scan() == 2 and line.scan() == 0
    assert line.store.read("keyword_hits").count() == 2
    assert line.classify(lambda chunk: ANSWER, "model") == 1 and line.classify(lambda chunk: ANSWER, "model") == 0  # only the agenda is in the window
    assert line.classify(lambda chunk: ANSWER, "model", everything=True) == 1
    (s, _) = line.store.read("signals").orderBy("signal_id").collect()
    assert s.stage_verified and s.amount_from_ocr and str(s.dollar_amount) == "1000.00" and s.model == "model"
    assert line.store.read("llm_runs").count() == 2
    assert line.rebuild_projects().first().projects == 2
    assert line.store.read("signals").where("project_id is null").count() == 0
    assert line.report(str(tmp_path / "out")) == ["coverage.md", "calibration.md", "signals.csv", "projects.csv", "coverage_trend.csv"]
    assert "| First | 1 | 0 | 0 | 1 |" in (tmp_path / "out" / "coverage.md").read_text() and "0.0% (0/1)" in (tmp_path / "out" / "calibration.md").read_text()
    trend = spark.read.csv(str(tmp_path / "out" / "coverage_trend.csv"), header=True).orderBy("step").collect()
    assert [r.level_5 for r in trend] == ["0", "0", "0", "1", "2"] and trend[0].date == "initial" and trend[0].level_0 == "1"
    assert len(line.store.versions("documents")) == 2


def test_robots_keep_documents_from_being_fetched(spark, line):
    line.discover(spark.createDataFrame([("b1", 1, "https://one.example/", page(("/private/a.pdf", "A")))], "body_id string, page_order int, url string, html string"))
    robots = spark.createDataFrame([("one.example", 200, "User-agent: *\nDisallow: /private/")], "host string, status int, text string")
    line.fetch(lambda url: b"x", lambda name, content: name, robots)
    assert line.store.read("documents").first().error == "Blocked by robots.txt"


def test_classification_stops_at_the_cap(spark, line):
    rows = spark.createDataFrame([(i, "b1", f"u{i}", "x" * 4000, "scanned", True) for i in range(1, 6)], "doc_id long, body_id string, source_url string, text string, status string, in_window boolean")
    line.store.write("documents", rows)
    line.cap = 0.002  # a document costs 0.001, and the one that crosses the cap is still taken
    assert line.classify(lambda chunk: "[]", "model") == 2
    assert [r.doc_id for r in line.store.read("documents").where("status = 'classified'").orderBy("doc_id").collect()] == [1, 2]


def test_command_line(spark, tmp_path, monkeypatch):
    data = str(tmp_path / "data")
    run = lambda *argv: command_line.run(spark, command_line.arguments([*argv, "--data", data]))
    assert "documents" in run("initdb")[0] and run("initdb") == ["initdb: []"]
    (tmp_path / "b.csv").write_text("body_id,name\nx,X\n")
    assert run("load-bodies", "--bodies", str(tmp_path / "b.csv")) == ["load-bodies: 1"]
    assert run("run-all", "--dry-run")[0] == "fetch: 0"
    with pytest.raises(SystemExit, match="--pages"):
        run("discover")
    assert [x.split(":")[0] for x in run("run-all", "--out", str(tmp_path / "out"))] == ["initdb", "scan", "projects", "report"]


def test_schemas(spark):
    raw = spark.createDataFrame([("b", "7", "x")], "BODY_ID string, coverage_level string, other string")
    got = schemas.conformed(raw, "bodies")
    assert got.columns == schemas.TABLES["bodies"].fieldNames() and got.first().coverage_level == 7 and got.first().name is None
    assert schemas.with_columns_if_missing(raw, {"Body_Id": "int", "n": "int"}).columns == ["BODY_ID", "coverage_level", "other", "n"]
    assert {(r.rule, r.rows) for r in schemas.violations(got, "bodies").collect()} == {("name is required", 1)}
    bad = spark.createDataFrame([("u", "lost"), ("v", None)], "source_url string, status string")
    assert {r.rule for r in schemas.violations(bad, "documents").collect()} == {"status is not allowed"}


def test_lifecycle(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", "x"), (2, "b", None)], "k int, s string, e string")
    updates = spark.createDataFrame([(2, "c", 1), (2, "d", 2), (9, "z", 1)], "k int, s string, o int")
    assert {tuple(r) for r in lifecycle.with_updates(rows, updates, "k", F.col("o")).collect()} == {(1, "a", "x"), (2, "d", None)}
    assert lifecycle.of_values(rows, "k", []).count() == 2 and lifecycle.of_values(rows, "k", [1]).count() == 1
    bodies = spark.createDataFrame([("x", 5), ("y", None)], "body_id string, coverage_level int")
    reached = spark.createDataFrame([("x", 4, "n"), ("y", 4, "n"), ("y", 3, "m")], "body_id string, level int, note string")
    assert [tuple(r) for r in lifecycle.levels_after(bodies, reached).collect()] == [("y", 0, 4, "n")]
    assert lifecycle.levels_after(bodies, reached, compat=True).count() == 2
    lifecycle.written_by_status(spark.createDataFrame([(1, "new"), (2, "scanned")], "doc_id long, status string"), str(tmp_path / "d"))
    read = spark.read.parquet(str(tmp_path / "d")).where("status = 'new'")
    assert read.count() == 1 and "PartitionFilters: [isnotnull(status" in read._jdf.queryExecution().toString()
    known = spark.createDataFrame([("b1", "u")], "body_id string, source_url string")
    found = spark.createDataFrame([("b1", "u"), ("b2", "u"), ("b2", "v")], "body_id string, source_url string")
    assert {(r.body_id, r.source_url) for r in lifecycle.new_documents(known, found).collect()} == {("b2", "u"), ("b2", "v")}
    assert {r.source_url for r in lifecycle.new_documents(known, found, by_body=False).collect()} == {"v"}
    assert [r.name for r in lifecycle.missing_tables(["a", "b"], spark.createDataFrame([("a",)], "name string")).collect()] == ["b"]


def test_trend_against_replay(spark):
    rng = random.Random(4)
    levels = {f"b{i}": rng.randint(0, 3) for i in range(30)}
    now, log = dict(levels), []
    for k in range(80):
        b = rng.choice(list(levels))
        new = rng.randint(0, 6)
        log.append((k, b, now[b], new, datetime.datetime(2026, 1, 1 + k // 20, k % 20)))
        now[b] = new
    want, state = [], dict(levels)
    count = lambda: [sum(v == k for v in state.values()) for k in range(7)]
    want.append(count())
    for _, b, _, new, _ in log:
        state[b] = new
        want.append(count())
    bodies = spark.createDataFrame(list(now.items()), "body_id string, coverage_level int")
    entries = spark.createDataFrame(log, "id int, body_id string, old_level int, new_level int, changed_at timestamp_ntz")
    got = reports.coverage_trend(bodies, entries).orderBy("step").collect()
    assert [[r[f"level_{k}"] for k in range(7)] for r in got] == want and [r.step for r in got] == list(range(81))
    assert [tuple(r)[:2] for r in reports.coverage_trend(bodies, entries.limit(0)).collect()] == [(0, "initial")]


def test_calibration(spark):
    documents = spark.createDataFrame([(1, "b", True), (2, "b", False)], "doc_id long, body_id string, in_window boolean")
    signals = spark.createDataFrame([(1, 1, 0, "A roof leaks", True), (2, 1, 1, "boiler w x y z", True), (3, 1, 0, None, True), (4, 2, 0, "A roof", True), (5, 1, 0, "x", False)], "signal_id int, document_id int, passage_index int, evidence_quote string, is_signal boolean").withColumn("scope_summary", F.lit("s" * 70))
    passages = spark.createDataFrame([(1, 0, "here a  roof LEAKS again"), (1, 5, "the boiler w then x and y there"), (1, 6, "nothing of it")], "doc_id long, passage_index int, passage_text string")
    s, p = reports.calibration(signals, passages, documents)
    assert {r.signal_id: r.met for r in s.collect()} == {1: True, 2: True, 3: False} and {r.passage_index: r.met for r in p.collect()} == {0: True, 5: True, 6: False}
    assert {r.signal_id: r.met for r in reports.calibration(signals, passages, documents, partial=None)[0].collect()} == {1: True, 2: False, 3: False}
    assert {r.signal_id: r.met for r in reports.calibration(signals, passages, documents, by_index=True)[0].collect()} == {1: True, 2: False, 3: True}
    rates = {r.rate: (r.part, r.whole, r.pct) for r in reports.calibration_rates(s, p).collect()}
    assert rates == {"missed": (1, 3, 33.3), "false_hit": (1, 3, 33.3)}
    (first, more) = reports.missed_signals(reports.calibration(signals, passages, documents, partial=None)[0], shown=1).orderBy("place").collect()
    assert first.signal_id == 2 and first.scope == "s" * 60 + "..." and more.scope == "and 1 more"
    assert {r.pct for r in reports.calibration_rates(s.limit(0), p.limit(0)).collect()} == {0.0}


@pytest.mark.parametrize("robots,delay", [("User-agent: *\nCrawl-delay: 5", 5.0), ("User-agent: records-engine\nCrawl-delay: 2\nUser-agent: *\nCrawl-delay: 9", 2.0), ("User-agent: other\nCrawl-delay: 3", None), ("User-agent: *\nCrawl-delay: x\n# c\nCrawl-delay: 1\nCrawl-delay: 4", 4.0), ("", None)])
def test_crawl_delay(robots, delay):
    assert discovery.crawl_delay(robots) == delay


def test_robots_and_hosts(spark):
    urls = spark.createDataFrame([(1, "https://a.example/x/y.pdf"), (2, "https://b.example/x"), (3, "https://c.example/x"), (4, "https://d.example/x")], "k int, url string")
    robots = spark.createDataFrame([("a.example", 200, "User-agent: *\nDisallow: /x/"), ("b.example", 503, ""), ("c.example", 404, "User-agent: *\nDisallow: /")], "host string, status int, text string")
    assert {r.k: r.allowed for r in discovery.robots_decisions(urls, robots).collect()} == {1: False, 2: False, 3: True, 4: True}
    pages = spark.createDataFrame([("b", "https://a.example/p/q.html", page(("x.pdf?v=1", ""), ("//f.example/y.PDF", ""), ("/z.pdf", ""))), ("b", "https://go.boarddocs.com/p", page(("x.pdf", "")))], "body_id string, url string, html string")
    assert {(r.host, r.links) for r in discovery.file_hosts(pages).collect()} == {("a.example", 2), ("f.example", 1)}
    whole = lambda link: one(spark, discovery.absolute(F.col("a"), F.col("b")), a=link, b="https://h.example/d/e.html?x=1")
    assert [whole(x) for x in ("f", "/f", "//g.example/f", "http://i.example/")] == ["https://h.example/d/f", "https://h.example/f", "https://g.example/f", "http://i.example/"]


def test_platforms_and_links(spark):
    html = page(("https://go.boarddocs.com/ny/x", "b"), ("/board/agenda.html", "a"), ("/dashboard", "d"), ("/boe", "e"), ("/files/agenda.pdf", "f"), ("/x.pdf", "g"), ("https://other.example/board", "o")) + "<script src=fsPageLayout>"
    pages = spark.createDataFrame([("https://s.example/", html), ("https://s.example/2", "granicus.com"), ("https://t.example/", None)], "url string, html string")
    rows = {r.site: r for r in discovery.site_profile(pages).collect()}
    assert rows["s.example"].platforms == "BoardDocs;Granicus" and rows["s.example"].systems == "Finalsite" and rows["s.example"].document_links == 1 and rows["s.example"].pages == 2 and rows["t.example"].platforms == ""
    links = discovery.page_links(pages)
    assert {r.link for r in links.collect()} == {"https://s.example/board/agenda.html", "https://s.example/boe"}
    assert [r.link for r in discovery.ranked_links(links, 1).collect()] == ["https://s.example/board/agenda.html"]
    assert one(spark, discovery.address_variants(F.col("a")), a="www.x.example/home") == [f"{s}://{h}/" for s in ("https", "http") for h in ("www.x.example", "x.example")]
    assert one(spark, discovery.address_variants(F.col("a")), a=None) is None
    rows = spark.createDataFrame([("1", "200", "BoardDocs", "0"), ("2", "200", "YouTube", None), ("3", "404", "", "0"), ("4", "200", "", "3"), ("5", "200", None, "x")], "k string, status string, platforms string, document_links string")
    assert {r.k for r in discovery.unresolved(rows).collect()} == {"2", "5"}


def test_drive(spark):
    ident = lambda url, kind: one(spark, discovery.drive_id(F.col("a"), kind), a=url)
    assert ident("https://drive.google.com/drive/u/0/folders/Ab_-1?usp=sharing", "folder") == "Ab_-1" and ident("https://drive.google.com/open?id=Q1", "file") == "Q1"
    assert ident("https://drive.google.com/file/d/F2/view", "file") == "F2" and ident("https://example.com/folders/x", "folder") is None and ident("https://drive.google.com/x", "file") is None

    def lister(folder):
        if folder == "bad":
            raise OSError("no")
        return [("1", "Agenda June 1, 2026", "https://drive.google.com/file/d/1/view"), ("2", "Minutes June 1, 2019", ""), ("1", "again", "https://drive.google.com/file/d/1/view")]

    pages = spark.createDataFrame([("b", 1, "https://drive.google.com/drive/folders/ok", None), ("b", 2, "https://drive.google.com/drive/folders/bad", None), ("b", 3, "https://x.example/", None)], "body_id string, page_order int, url string, html string")
    (row,) = discovery.DriveFolders(lister, "2025-09-01").list_documents(pages).collect()
    assert row.source_url.endswith("/1/view") and row.doc_type == "agenda" and row.link_text == "Agenda June 1, 2026"


def test_census(spark):
    general = spark.createDataFrame([("1", "A", "1 - COUNTY", "Y", "5"), ("1", "B", "2 - MUNICIPAL", "Y", None), ("2", "C", "odd", "N", None), ("3", "D", None, "Y", "x")], "CENSUS_ID_PID6 string, UNIT_NAME string, UNIT_TYPE string, IS_ACTIVE string, POPULATION string")
    schools = spark.createDataFrame([("3", "Late"), ("4", "E")], "CENSUS_ID_PID6 string, UNIT_NAME string")
    sheets = {"General Purpose": general, "School District": schools}
    got = {r.body_id: r for r in registry.census_bodies(sheets).collect()}
    assert got["COG-1"].segment == "XX County" and got["COG-1"].manual_notes == "Census 2022 County, pop 5" and got["COG-3"].name == "D" and got["COG-4"].segment == "XX School District" and "COG-2" not in got
    assert [tuple(r) for r in registry.most_frequent(registry.census_bodies(sheets), "segment", 1).collect()] == [("XX County", 1)]
    assert {tuple(r) for r in registry.sheet_counts(sheets).collect()} == {("General Purpose", 3, 0), ("School District", 2, 0)}
    signals = spark.createDataFrame([("Deer Lake", "new ROOF", None), ("Deer Lake", None, "roof"), ("Elm", "roof", "")], "body string, scope_summary string, evidence_quote string")
    facts = spark.createDataFrame([("f", "deer", ["roof"], 2), ("g", "elm", ["pool", "roof"], None), ("h", "x", ["roof"], 1)], "fact string, body string, keywords array<string>, least int")
    assert {r.fact: (r.found, r.elsewhere, r.passed) for r in registry.expected_facts(signals, facts).collect()} == {"f": (2, 1, True), "g": (1, 2, True), "h": (0, 3, False)}


def test_repair(spark):
    documents = spark.createDataFrame([(1, "held Jan 5, 2024", None, True), (2, "no date", None, True), (3, "Jan 5, 2026", None, True), (4, "Jan 5, 2024", "2024-01-05", True), (5, "", None, True), (6, "Jan 5, 2024", None, False)], "doc_id long, text string, meeting_date string, in_window boolean")
    dated = repair.dated_by_text(documents, "2025-09-01")
    assert {(r.doc_id, r.inside) for r in dated.collect()} == {(1, False), (3, True), (6, False)}
    runs = spark.createDataFrame([(1, "model", 1_000_000, 0), (1, "model", 0, 1_000_000), (6, "model", 5, 5)], "document_id int, model string, input_tokens int, output_tokens int")
    row = repair.cost_outside(dated, runs, classify.run_cost({"model": (1.0, 5.0)})).first()
    assert (row.documents, row.input_tokens, row.output_tokens, row.cost) == (1, 1_000_000, 1_000_000, 6.0)


def test_prompt_and_vocabulary_file(tmp_path):
    yaml = pytest.importorskip("yaml")
    (tmp_path / "v.yaml").write_text(yaml.safe_dump({"trades": {"roofing": {"label": "Roofs", "keywords": ["roof"]}}, "stages": {"5_bid": {"label": "Bid", "value": "high", "keywords": ["bid"]}}, "triggers": ["change order"], "negatives": ["roof of the"], "skip_patterns": ["Salary/Step"]}))
    words = scan.Vocabulary.from_yaml(str(tmp_path / "v.yaml"))
    assert words.trades == {"roofing": ["roof"]} and words.skips == ["Salary/Step"]
    told = classify.prompt(words, {"is_signal": "true or false"})
    assert "roofing: Roofs" in told and "5_bid: Bid - high" in told and "is_signal: true or false" in told


def test_small_texts(spark):
    assert one(spark, text.file_name(F.col("a"), F.col("b")), a="https://h.example/x/y%20z?q=1", b="0123456789") == "01234567_y%20z.pdf"
    assert one(spark, text.shortened(F.col("a"), 3), a="abcd") == "abc..." and one(spark, text.shortened(F.col("a"), 3, "none"), a=None) == "none"
    assert spark.range(1).select(text.json_or_null(F.array().cast("array<string>")).alias("a"), text.json_or_null(F.array(F.lit("x"))).alias("b")).first() == (None, '["x"]')

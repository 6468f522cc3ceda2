"""Registered queries of the public-records operators, each with its SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civicgrain.functions import dates, text
from civicgrain.operators import classify, projects, scan, tables
from civicgrain.sources.files import needs_ocr
from civicgrain.sources.tables import table, texts

VOCABULARY = scan.Vocabulary(
    trades={"roofing": ["roof replacement", "roof leak"], "hvac": ["boiler", "ductwork", "unit ventilator", "chiller"], "envelope": ["window replacement", "lintel", "masonry", "curtain wall", "skylight"], "athletics": ["track resurfacing", "turf", "playground"]},
    stages={"5_bid": ["moves to bid", "bid"], "4_design": ["drawing"]},
    triggers=["change order", "warranty", "punch list"],
    negatives=["boiler room", "bid in"],
    skips=["was declared surplus", r"copyright \d+"],
)
PRICES = {"model-small": (1.0, 5.0), "model-large": (3.0, 15.0)}
AS_OF, CAP = "2026-09-01", 0.05


def _t(spark, folder, *names):
    got = [table(spark, folder, n) for n in names]
    return got[0] if len(got) == 1 else got


def _sql_any(column: str, words) -> str:
    """The keyword rule for an engine without look-around."""
    body = "|".join(r"[\s-]+".join(w.split()) for w in words)
    return f"regexp_matches({column}, '(^|[^a-z])({body})(s|es|ing|ed)?([^a-z]|$)')"


def _sql_keys(column: str, groups) -> str:
    return "array_to_string(list_filter([" + ", ".join(f"CASE WHEN {_sql_any(column, w)} THEN '{k}' END" for k, w in sorted(groups.items())) + "], lambda x: x IS NOT NULL), ',')"


def _sql_clean(column: str) -> str:
    out = f"lower({column})"
    for p in VOCABULARY.negatives:
        out = f"replace({out}, '{p}', ' ')"
    return f"CASE WHEN regexp_matches(lower({column}), '{'|'.join(VOCABULARY.skips)}') THEN '' ELSE {out} END"


_OWN = {w: [w] for w in VOCABULARY.triggers}
_LINES = f"""WITH raw AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents WHERE text IS NOT NULL),
clean AS (SELECT doc_id, line_no, line, {_sql_clean('line')} AS c FROM raw),
hits AS (SELECT * FROM clean WHERE {_sql_any('c', VOCABULARY.telling())})
"""

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


@query(_LINES + f"SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, {_sql_keys('c', VOCABULARY.trades)} AS trades, {_sql_keys('c', VOCABULARY.stages)} AS stages, {_sql_keys('c', _OWN)} AS triggers FROM hits")
def keyword_line_hits(spark: SparkSession, folder: str) -> DataFrame:
    rows = scan.keyword_lines(texts(spark, folder), VOCABULARY)
    return rows.select("doc_id", "line_no", *(F.array_join(c, ",").alias(c) for c in ("trades", "stages", "triggers")))


_PASSAGES = _LINES + f""", marked AS (SELECT doc_id, line_no, c, CASE WHEN line_no - lag(line_no) OVER (PARTITION BY doc_id ORDER BY line_no) <= 6 THEN 0 ELSE 1 END AS fresh FROM hits),
island AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY line_no) AS g FROM marked),
last AS (SELECT doc_id, max(line_no) AS m FROM raw GROUP BY doc_id),
frame AS (SELECT doc_id, g, greatest(min(line_no) - 2, 0) AS s, least(max(line_no) + 3, any_value(m)) AS e, string_agg(c, chr(10) ORDER BY line_no) AS said FROM island JOIN last USING (doc_id) GROUP BY doc_id, g),
stripped AS (SELECT doc_id, line_no, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13) || chr(160)) AS x FROM raw),
told AS (SELECT f.doc_id, f.s, f.e, any_value(f.said) AS said, string_agg(x, ' ' ORDER BY line_no) AS t FROM frame f JOIN stripped r ON r.doc_id = f.doc_id AND r.line_no BETWEEN f.s AND f.e AND x <> '' GROUP BY f.doc_id, f.s, f.e),
passages AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1 AS passage_index, s, e, t, said FROM told WHERE length(t) >= 25)
"""


@query(_PASSAGES + f"SELECT doc_id, CAST(passage_index AS INTEGER) AS passage_index, CAST(s AS INTEGER) AS start_line, CAST(e AS INTEGER) AS end_line, t AS passage_text, {_sql_keys('said', VOCABULARY.trades)} AS trades FROM passages")
def keyword_passages(spark: SparkSession, folder: str) -> DataFrame:
    rows = scan.keyword_passages(texts(spark, folder), VOCABULARY)
    return rows.select("doc_id", "passage_index", "start_line", "end_line", "passage_text", F.array_join("trades", ",").alias("trades"))


@query(rf"""WITH raw AS (SELECT doc_id, unnest(regexp_split_to_array(text, '\n\s*\n')) AS p, generate_subscripts(regexp_split_to_array(text, '\n\s*\n'), 1) - 1 AS passage_no FROM documents WHERE text IS NOT NULL),
tidy AS (SELECT doc_id, passage_no, trim(regexp_replace(p, '\s+', ' ', 'g')) AS p FROM raw), clean AS (SELECT doc_id, passage_no, {_sql_clean('p')} AS c FROM tidy WHERE length(p) > 25)
SELECT doc_id, CAST(passage_no AS INTEGER) AS passage_no, {_sql_keys('c', VOCABULARY.trades)} AS trades FROM clean WHERE {_sql_any('c', VOCABULARY.telling())}""")
def blank_passages(spark: SparkSession, folder: str) -> DataFrame:
    return scan.blank_passages(texts(spark, folder), VOCABULARY).select("doc_id", "passage_no", F.array_join("trades", ",").alias("trades"))


@query(_LINES + f"SELECT coalesce(lower(trim(source)), '') AS source, count(DISTINCT doc_id) AS documents, count(*) AS lines FROM hits JOIN documents USING (doc_id) GROUP BY 1")
def keyword_counts_by_source(spark: SparkSession, folder: str) -> DataFrame:
    documents = texts(spark, folder)
    hits = scan.keyword_lines(documents, VOCABULARY).groupBy("doc_id").agg(F.count("*").alias("n"))
    source = documents.select("doc_id", F.coalesce(F.lower(F.trim("source")), F.lit("")).alias("source"))
    return hits.join(source, "doc_id").groupBy("source").agg(F.count("*").alias("documents"), F.sum("n").alias("lines"))


@query("""SELECT coverage_level, count(*) AS bodies, coalesce(sum(enrollment), 0)::BIGINT AS enrollment, round(coalesce(100.0 * sum(enrollment) / nullif((SELECT sum(enrollment) FROM bodies), 0), 0), 1) AS pct FROM bodies GROUP BY coverage_level
UNION ALL SELECT -1, count(*), coalesce(sum(enrollment), 0)::BIGINT, 100.0 FROM bodies""")
def coverage_by_level(spark: SparkSession, folder: str) -> DataFrame:
    levels = _t(spark, folder, "bodies").groupBy("coverage_level").agg(F.count("*").alias("bodies"), F.coalesce(F.sum("enrollment"), F.lit(0)).alias("enrollment"))
    whole = Window.partitionBy()  # a row a level
    share = F.coalesce(F.round(100 * F.try_divide(F.col("enrollment").cast("double"), F.sum("enrollment").over(whole)), 1), F.lit(0.0))
    total = levels.agg(F.lit(-1).alias("coverage_level"), F.coalesce(F.sum("bodies"), F.lit(0)).alias("bodies"), F.coalesce(F.sum("enrollment"), F.lit(0)).alias("enrollment"), F.lit(100.0).alias("pct"))
    return levels.withColumn("pct", share).unionByName(total)


@query("SELECT blocker_code, count(*) AS bodies, row_number() OVER (ORDER BY count(*) DESC, blocker_code) AS place FROM bodies WHERE blocker_code IS NOT NULL GROUP BY blocker_code")
def blocker_pareto(spark: SparkSession, folder: str) -> DataFrame:
    n = _t(spark, folder, "bodies").where("blocker_code is not null").groupBy("blocker_code").agg(F.count("*").alias("bodies"))
    return n.withColumn("place", F.row_number().over(Window.orderBy(F.desc("bodies"), "blocker_code")).cast("long"))


@query("""SELECT b.body_id, b.name, count(*) FILTER (WHERE d.in_window) AS in_window, count(*) FILTER (WHERE NOT d.in_window) AS out_window, count(*) FILTER (WHERE d.meeting_date IS NULL) AS undated, coalesce(any_value(s.n), 0) AS signals
FROM bodies b JOIN documents d USING (body_id) LEFT JOIN (SELECT body_id, count(*) AS n FROM signals JOIN documents ON document_id = doc_id WHERE in_window GROUP BY body_id) s USING (body_id) GROUP BY b.body_id, b.name""")
def documents_by_body(spark: SparkSession, folder: str) -> DataFrame:
    bodies, documents, signals = _t(spark, folder, "bodies", "documents", "signals")
    n = documents.groupBy("body_id").agg(F.count_if("in_window").alias("in_window"), F.count_if(~F.col("in_window")).alias("out_window"), F.count_if(F.col("meeting_date").isNull()).alias("undated"))
    inside = documents.where("in_window").select(F.col("doc_id").alias("document_id"), "body_id")
    s = signals.select("document_id").join(inside, "document_id").groupBy("body_id").agg(F.count("*").alias("signals"))
    return bodies.select("body_id", "name").join(n, "body_id").join(s, "body_id", "left").withColumn("signals", F.coalesce("signals", F.lit(0)))


@query("SELECT d.in_window, count(DISTINCT s.signal_id) AS signals, count(DISTINCT d.doc_id) AS documents FROM signals s JOIN documents d ON s.document_id = d.doc_id GROUP BY d.in_window")
def dual_distinct(spark: SparkSession, folder: str) -> DataFrame:
    signals, documents = _t(spark, folder, "signals", "documents")
    rows = signals.select("signal_id", "document_id").join(documents.select(F.col("doc_id").alias("document_id"), "in_window"), "document_id")
    return rows.groupBy("in_window").agg(F.countDistinct("signal_id").alias("signals"), F.countDistinct("document_id").alias("documents"))


@query("""SELECT d.body_id, s.building, count(*) AS signals, CAST(min(d.meeting_date) AS VARCHAR) AS first_date, CAST(max(d.meeting_date) AS VARCHAR) AS last_date, array_to_string(list_sort(list(DISTINCT s.stage) FILTER (WHERE s.stage IS NOT NULL)), ',') AS stages
FROM signals s JOIN documents d ON s.document_id = d.doc_id WHERE s.building IS NOT NULL AND s.building <> '' GROUP BY d.body_id, s.building HAVING count(*) >= 3""")
def repeated_buildings(spark: SparkSession, folder: str) -> DataFrame:
    signals, documents = _t(spark, folder, "signals", "documents")
    rows = signals.where("building <> ''").select("document_id", "building", "stage").join(documents.select(F.col("doc_id").alias("document_id"), "body_id", "meeting_date"), "document_id")
    got = rows.groupBy("body_id", "building").agg(F.count("*").alias("signals"), F.min("meeting_date").alias("first_date"), F.max("meeting_date").alias("last_date"), F.collect_set("stage").alias("s"))
    stages = F.when(F.size("s") > 0, F.array_join(F.array_sort("s"), ","))
    return got.where("signals >= 3").select("body_id", "building", "signals", F.col("first_date").cast("string"), F.col("last_date").cast("string"), stages.alias("stages"))


@query(_PASSAGES + """, p AS (SELECT DISTINCT doc_id, passage_index FROM passages), s AS (SELECT DISTINCT document_id AS doc_id, passage_index FROM signals WHERE passage_index IS NOT NULL),
a AS (SELECT count(*) AS n, count(*) FILTER (WHERE p.doc_id IS NULL) AS m FROM s LEFT JOIN p ON p.doc_id = s.doc_id AND p.passage_index = s.passage_index),
b AS (SELECT count(*) AS n, count(*) FILTER (WHERE s.doc_id IS NULL) AS m FROM p LEFT JOIN s ON p.doc_id = s.doc_id AND p.passage_index = s.passage_index)
SELECT 'missed' AS rate, m AS part, n AS whole, round(100.0 * m / nullif(n, 0), 1) AS pct FROM a UNION ALL SELECT 'false_hit', m, n, round(100.0 * m / nullif(n, 0), 1) FROM b""")
def calibration_rates(spark: SparkSession, folder: str) -> DataFrame:
    """As the reports have it: passages and signals meet by their index."""
    documents, signals = _t(spark, folder, "documents", "signals")
    p = scan.keyword_passages(documents, VOCABULARY).select("doc_id", "passage_index").distinct()
    s = signals.where("passage_index is not null").select(F.col("document_id").cast("long").alias("doc_id"), "passage_index").distinct()
    both = p.withColumn("p", F.lit(1)).join(s.withColumn("s", F.lit(1)), ["doc_id", "passage_index"], "full")
    n = both.agg(F.count("s").alias("s"), F.count("p").alias("p"), F.count_if(F.col("p").isNull()).alias("m"), F.count_if(F.col("s").isNull()).alias("f"))
    rows = n.select(F.explode(F.array(F.struct(F.lit("missed").alias("rate"), F.col("m").alias("part"), F.col("s").alias("whole")), F.struct(F.lit("false_hit").alias("rate"), F.col("f").alias("part"), F.col("p").alias("whole")))).alias("r")).select("r.*")
    return rows.withColumn("pct", F.round(100.0 * F.try_divide(F.col("part").cast("double"), F.col("whole")), 1))


_RANK = "CASE stage " + " ".join(f"WHEN '{s}' THEN {i}" for s, i in (("1_problem", 1), ("2_study", 2), ("3_funding", 3), ("4_design", 4), ("5_bid", 5), ("6_award", 6), ("7_construction", 7), ("unknown", 99))) + " ELSE 50 END"


@query(f"""SELECT signal_id, row_number() OVER (ORDER BY CASE WHEN in_window THEN 0 ELSE 1 END, {_RANK}, coalesce(dollar_amount, 0) DESC, signal_id) AS place, array_to_string(trades, ', ') AS trades
FROM signals JOIN documents ON document_id = doc_id""")
def ranked_signals(spark: SparkSession, folder: str) -> DataFrame:
    """Places in the order of the report. Ties of one amount, or of none, are broken by the id, so no task holds them all."""
    signals, documents = _t(spark, folder, "signals", "documents")
    rows = signals.join(documents.select(F.col("doc_id").alias("document_id"), "in_window"), "document_id")
    order = [F.when(F.col("in_window"), 0).otherwise(1), F.expr(_RANK), -F.coalesce("dollar_amount", F.lit(0)), F.col("signal_id")]
    return tables.numbered(rows.select("signal_id", "stage", "in_window", "dollar_amount", F.array_join("trades", ", ").alias("trades")), order).select("signal_id", "place", "trades")


@query("""WITH d AS (SELECT CAST(date_trunc('day', ts) AS DATE) AS day, event_type, count(*) AS delta FROM events GROUP BY 1, 2)
SELECT CAST(day AS VARCHAR) AS day, event_type, sum(delta) OVER (PARTITION BY event_type ORDER BY day)::BIGINT AS total FROM d""")
def trend_replay(spark: SparkSession, folder: str) -> DataFrame:
    """A log replayed: running totals of its entries by day and kind. Days are summed before the window."""
    d = _t(spark, folder, "events").groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count("*").alias("delta"))
    return d.select(F.col("day").cast("string"), "event_type", F.sum("delta").over(Window.partitionBy("event_type").orderBy("day")).alias("total"))


@query("SELECT status, count(*) AS documents, count(*) FILTER (WHERE text IS NULL) AS without_text FROM documents GROUP BY status")
def status_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _t(spark, folder, "documents").groupBy("status").agg(F.count("*").alias("documents"), F.count_if(F.col("text").isNull()).alias("without_text"))


_COST = "(input_tokens * CASE lower(model) WHEN 'model-small' THEN 1.0::DOUBLE WHEN 'model-large' THEN 3.0::DOUBLE ELSE 1.0::DOUBLE END + output_tokens * CASE lower(model) WHEN 'model-small' THEN 5.0::DOUBLE WHEN 'model-large' THEN 15.0::DOUBLE ELSE 5.0::DOUBLE END) / 1e6"


@query(f"SELECT CAST(CAST(created_at AS DATE) AS VARCHAR) AS day, lower(model) AS model, count(*) AS runs, round(sum({_COST}), 4) AS cost FROM llm_runs GROUP BY 1, 2")
def cost_by_day_model(spark: SparkSession, folder: str) -> DataFrame:
    runs = _t(spark, folder, "llm_runs")
    return runs.groupBy(F.to_date("created_at").cast("string").alias("day"), F.lower("model").alias("model")).agg(F.count("*").alias("runs"), F.round(F.sum(classify.run_cost(PRICES)), 4).alias("cost"))


@query(f"""WITH c AS (SELECT CAST(created_at AS DATE) AS day, run_id, coalesce(sum({_COST}) OVER (PARTITION BY CAST(created_at AS DATE) ORDER BY created_at, run_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent FROM llm_runs WHERE created_at IS NOT NULL)
SELECT CAST(day AS VARCHAR) AS day, run_id, round(spent, 6) AS spent_before FROM c WHERE spent < {CAP}""")
def capped_prefix(spark: SparkSession, folder: str) -> DataFrame:
    return classify.within_budget(_t(spark, folder, "llm_runs"), PRICES, CAP).withColumn("day", F.col("day").cast("string"))


@query("SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def latest_upsert(spark: SparkSession, folder: str) -> DataFrame:
    events = _t(spark, folder, "events")
    return tables.latest_rows(events.select("user_id", "event_id", "event_type", "value", "ts"), ["user_id"], [F.col("ts"), F.col("event_id")]).drop("ts")


@query("""SELECT body_id, CAST(meeting_date AS VARCHAR) AS meeting_date, meeting_type FROM (SELECT * FROM (SELECT DISTINCT body_id, meeting_date, 'regular' AS meeting_type FROM documents WHERE body_id IS NOT NULL AND meeting_date IS NOT NULL)
EXCEPT SELECT body_id, meeting_date, coalesce(meeting_type, 'regular') FROM meeting_calendar)""")
def calendar_additions(spark: SparkSession, folder: str) -> DataFrame:
    documents, calendar = _t(spark, folder, "documents", "meeting_calendar")
    new = documents.where("body_id is not null and meeting_date is not null").select("body_id", "meeting_date", F.lit("regular").alias("meeting_type"))
    old = calendar.select("body_id", "meeting_date", F.coalesce("meeting_type", F.lit("regular")).alias("meeting_type"))
    return tables.insert_absent(old, new, ["body_id", "meeting_date", "meeting_type"], F.lit(0)).withColumn("meeting_date", F.col("meeting_date").cast("string"))


@query("SELECT doc_id, sha256(text) AS sha256, min(doc_id) OVER (PARTITION BY sha256(text)) AS owner FROM documents WHERE text IS NOT NULL")
def content_hash_first_owner(spark: SparkSession, folder: str) -> DataFrame:
    return tables.first_owner(_t(spark, folder, "documents"))


_HOST = r"regexp_replace(lower(regexp_extract(regexp_replace(trim(coalesce({c}, '')), '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '^([^/?#:]*)', 1)), '^www\.', '')"


@query(f"""WITH h AS (SELECT *, {_HOST.format(c='website')} AS host FROM bodies), g AS (
SELECT host, min(body_id) AS body_id, arg_min(name, body_id) AS name, sum(enrollment)::BIGINT AS enrollment, count(*) AS n, list(name ORDER BY body_id) AS names FROM h WHERE host <> '' GROUP BY host)
SELECT host, body_id, CASE WHEN n > 2 THEN name || ' (and ' || (n - 1) || ' others)' ELSE name END AS name, enrollment, n, CASE WHEN n > 1 THEN 'Merged with: ' || array_to_string(names[2:], '; ') END AS note FROM g
UNION ALL SELECT host, body_id, name, enrollment::BIGINT, 1, NULL FROM h WHERE host = ''""")
def host_group_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    return tables.dedupe_by_host(_t(spark, folder, "bodies"))


def _sql_doc_type() -> str:
    t, u = "lower(coalesce(link_text, ''))", "lower(coalesce(source_url, ''))"
    committee = "CASE " + " ".join(f"WHEN contains({t}, '{w}') OR contains({u}, '{w}') THEN '{n}'" for w, n in text.COMMITTEES) + " END"
    meeting = "CASE " + " ".join(f"WHEN contains({t}, '{w}') THEN '{n}'" for w, n in text.MEETING_WORDS) + " ELSE 'regular' END"
    return f"""SELECT doc_id, CASE WHEN contains({t}, 'minute') OR contains({u}, 'minute') THEN 'minutes' WHEN contains({t}, 'agenda') OR contains({u}, 'agenda') THEN CASE WHEN {committee} IS NOT NULL THEN 'committee_agenda' ELSE 'agenda' END
WHEN contains({t}, 'packet') THEN 'packet' ELSE 'other' END AS found_type, coalesce({committee}, {meeting}) AS meeting_type FROM documents"""


@query(_sql_doc_type())
def doc_type_rules(spark: SparkSession, folder: str) -> DataFrame:
    got = text.doc_type(F.col("link_text"), F.col("source_url"))
    return _t(spark, folder, "documents").select("doc_id", got.alias("g")).select("doc_id", F.col("g.doc_type").alias("found_type"), "g.meeting_type")


@query(f"SELECT {_HOST.format(c='source_url')} AS host, count(*) AS links, count(DISTINCT body_id) AS bodies FROM documents WHERE lower(source_url) LIKE '%.pdf%' GROUP BY 1")
def host_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = _t(spark, folder, "documents").where(F.lower("source_url").contains(".pdf"))
    return rows.groupBy(text.normalize_host(F.col("source_url")).alias("host")).agg(F.count("*").alias("links"), F.countDistinct("body_id").alias("bodies"))


_PLATFORMS = {"boardhub": "boardhub", "drive": "drive_folder|/files/", "uploads": "/uploads/", "versioned": r"[?&]v=[0-9]+"}


@query("SELECT doc_id, array_to_string(list_filter([" + ", ".join(f"CASE WHEN regexp_matches(lower(source_url), '{p}') THEN '{n}' END" for n, p in _PLATFORMS.items()) + "], lambda x: x IS NOT NULL), ';') AS platforms FROM documents")
def platform_flags(spark: SparkSession, folder: str) -> DataFrame:
    flags = F.array_compact(F.array(*(F.when(F.col("source_url").rlike("(?i)" + p), F.lit(n)) for n, p in _PLATFORMS.items())))
    return _t(spark, folder, "documents").select("doc_id", F.array_join(flags, ";").alias("platforms"))


@query(f"""WITH r AS (SELECT body_id, source_url, row_number() OVER (PARTITION BY body_id ORDER BY CASE WHEN regexp_matches(lower(source_url), 'agenda|minutes') THEN 0 ELSE 1 END, length(source_url), source_url) AS place FROM documents WHERE body_id IS NOT NULL)
SELECT body_id, source_url, place FROM r WHERE place <= 4""")
def link_rank_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The four best links of a body. Each of 64 salts keeps its own four first, so a hot body is no single task."""
    rows = _t(spark, folder, "documents").where("body_id is not null").select("body_id", "source_url", F.when(F.lower("source_url").rlike("agenda|minutes"), 0).otherwise(1).alias("k"), F.length("source_url").alias("n"), F.pmod(F.xxhash64("source_url"), F.lit(64)).alias("salt"))
    order = ["k", "n", "source_url"]
    part = rows.withColumn("place", F.row_number().over(Window.partitionBy("body_id", "salt").orderBy(*order))).where("place <= 4")
    return part.withColumn("place", F.row_number().over(Window.partitionBy("body_id").orderBy(*order)).cast("long")).where("place <= 4").select("body_id", "source_url", "place")


@query("SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events WHERE CAST(json_extract(props, '$.k') AS INTEGER) >= 50")
def json_props(spark: SparkSession, folder: str) -> DataFrame:
    rows = _t(spark, folder, "events").select("event_id", "event_type", F.from_json("props", "k int")["k"].alias("k"))
    return rows.where("k >= 50")


@query("""SELECT doc_id, coalesce(try_cast(nullif(regexp_extract(source_url, '((?:19|20)[0-9]{2})[-./_]', 1), '') AS INTEGER), try_cast(nullif(regexp_extract(source_url, '((?:19|20)[0-9]{2})[.](?i:pdf)', 1), '') AS INTEGER)) AS year FROM documents""".replace("\\\\", "\\"))
def url_years(spark: SparkSession, folder: str) -> DataFrame:
    return _t(spark, folder, "documents").select("doc_id", text.url_year(F.col("source_url")).alias("year"))


@query("SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS found FROM orders")
def meeting_date_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Dates written in four forms and read back."""
    rows = _t(spark, folder, "orders")
    d = F.col("o_orderdate")
    forms = [F.date_format(d, "MMMM d, yyyy"), F.date_format(d, "MMM d yyyy"), F.date_format(d, "M-d-yyyy"), F.date_format(d, "yyyy-MM-dd")]
    shown = F.element_at(F.array(*forms), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return rows.select("o_orderkey", dates.meeting_date(F.concat(F.lit("Minutes "), shown), F.lit("")).cast("string").alias("found"))


@query(f"SELECT doc_id, meeting_date >= (DATE '{AS_OF}' - INTERVAL 1 YEAR) AS inside FROM documents")
def in_window_flags(spark: SparkSession, folder: str) -> DataFrame:
    return _t(spark, folder, "documents").select("doc_id", dates.in_window(F.col("meeting_date"), AS_OF).alias("inside"))


@query("SELECT doc_id, coalesce(length(coalesce(text, '')) / nullif(pages, 0), 0) < 100 AS needs_ocr FROM documents")
def text_density(spark: SparkSession, folder: str) -> DataFrame:
    return needs_ocr(_t(spark, folder, "documents").select("doc_id", "text", "pages")).select("doc_id", "needs_ocr")


@query("""WITH n AS (SELECT body_id, count(*) AS fetched FROM documents WHERE status <> 'new' GROUP BY body_id)
SELECT body_id, expected_per_year, coalesce(fetched, 0) AS fetched, coalesce(fetched, 0) < expected_per_year AS gap FROM bodies LEFT JOIN n USING (body_id) WHERE expected_per_year IS NOT NULL""")
def gap_check(spark: SparkSession, folder: str) -> DataFrame:
    bodies, documents = _t(spark, folder, "bodies", "documents")
    n = documents.where("status <> 'new'").groupBy("body_id").agg(F.count("*").alias("fetched"))
    rows = bodies.where("expected_per_year is not null").select("body_id", "expected_per_year").join(n, "body_id", "left").withColumn("fetched", F.coalesce("fetched", F.lit(0)))
    return rows.withColumn("gap", F.col("fetched") < F.col("expected_per_year"))


@query("""SELECT doc_id, m.meeting_id FROM documents d LEFT JOIN (SELECT body_id, meeting_date, min(meeting_id) AS meeting_id FROM meeting_calendar GROUP BY 1, 2) m USING (body_id, meeting_date) WHERE meeting_date IS NOT NULL""")
def calendar_links(spark: SparkSession, folder: str) -> DataFrame:
    documents, calendar = _t(spark, folder, "documents", "meeting_calendar")
    first = calendar.groupBy("body_id", "meeting_date").agg(F.min("meeting_id").alias("meeting_id"))
    return documents.where("meeting_date is not null").select("doc_id", "body_id", "meeting_date").join(first, ["body_id", "meeting_date"], "left").select("doc_id", "meeting_id")


@query("""WITH b AS (SELECT doc_id, lang, text, 0 AS part FROM documents WHERE lang = 'en' UNION ALL SELECT doc_id, lang, text, 1 FROM documents WHERE lang IS DISTINCT FROM 'en')
SELECT doc_id, part FROM (SELECT *, row_number() OVER (PARTITION BY sha256(coalesce(text, '')) ORDER BY part, doc_id) AS n FROM b) WHERE n = 1""")
def union_dedupe_first(spark: SparkSession, folder: str) -> DataFrame:
    documents = _t(spark, folder, "documents")
    one = documents.where("lang = 'en'").select("doc_id", "text", F.lit(0).alias("part"))
    two = documents.where("lang is null or lang <> 'en'").select("doc_id", "text", F.lit(1).alias("part"))
    rows = one.unionByName(two).select("doc_id", "part", F.sha2(F.coalesce("text", F.lit("")), 256).alias("h"))
    return rows.groupBy("h").agg(F.min(F.struct("part", "doc_id")).alias("r")).select("r.doc_id", "r.part")


_STOP = "[" + ", ".join(f"'{w}'" for w in (*text.STOP_WORDS, *text.DOMAIN_STOP_WORDS)) + "]"
_SCOPES = rf"""sc AS (SELECT s.signal_id, d.body_id, trim(regexp_replace(regexp_replace(lower(coalesce(building, '')), '[^a-z0-9\s]', '', 'g'), '\s+', ' ', 'g')) AS place, trades[1] AS trade,
list_sort(list_distinct(list_filter(regexp_extract_all(lower(coalesce(scope_summary, '')), '[a-z]+'), lambda w: length(w) > 2 AND NOT list_contains({_STOP}, w)))) AS words FROM signals s JOIN documents d ON s.document_id = d.doc_id),
st AS (SELECT body_id, place, trade, words, min(signal_id) AS id FROM sc WHERE place <> '' AND trade <> '' AND body_id IS NOT NULL GROUP BY ALL),
pr AS (SELECT a.id AS a, b.id AS b, len(list_intersect(a.words, b.words)) AS shared, len(a.words) AS x, len(b.words) AS y FROM st a JOIN st b ON a.body_id = b.body_id AND a.place = b.place AND a.trade = b.trade AND a.id < b.id),
ok AS (SELECT a, b, shared FROM pr WHERE shared > 0 AND (shared >= 3 OR shared >= 0.4 * (x + y - shared)))"""


@query(f"WITH {_SCOPES} SELECT a, b, shared FROM ok")
def similar_scopes(spark: SparkSession, folder: str) -> DataFrame:
    signals, documents = _t(spark, folder, "signals", "documents")
    return projects.similar_scopes(projects.scopes(signals, documents))


_CLUSTERS = f"""WITH RECURSIVE {_SCOPES}, e AS (SELECT a, b FROM ok UNION SELECT b, a FROM ok), r(v, g) AS (SELECT a, a FROM e UNION SELECT e.b, r.g FROM r JOIN e ON r.v = e.a WHERE r.g < e.b),
lab AS (SELECT v, min(g) AS g FROM r GROUP BY v), nm AS (SELECT st.*, coalesce(g, id) AS project_id FROM st LEFT JOIN lab ON v = id),
mem AS (SELECT s.signal_id, CASE WHEN len(nm.words) > 0 THEN coalesce(nm.project_id, s.signal_id) ELSE s.signal_id END AS project_id FROM signals s LEFT JOIN sc USING (signal_id)
LEFT JOIN nm ON nm.body_id = sc.body_id AND nm.place = sc.place AND nm.trade = sc.trade AND nm.words = sc.words)"""


@query(_CLUSTERS + " SELECT signal_id, project_id FROM mem")
def project_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return projects.project_members(*_t(spark, folder, "signals", "documents"))


@query(_CLUSTERS + """ SELECT project_id, min(body_id) AS body_id, arg_min(building, signal_id) FILTER (WHERE coalesce(building, '') <> '') AS building, arg_min_null(scope_summary, signal_id) AS scope_summary, CAST(min(meeting_date) AS VARCHAR) AS first_signal_date, CAST(max(meeting_date) AS VARCHAR) AS last_signal_date, arg_max_null(stage, (coalesce(list_position(["""+ ", ".join(f"'{s}'" for s in text.STAGES) + """], stage), 0), -signal_id)) AS latest_stage, count(*) AS signal_count
FROM mem JOIN (SELECT signal_id, building, document_id, stage, scope_summary FROM signals) USING (signal_id) LEFT JOIN documents ON document_id = doc_id GROUP BY project_id""")
def project_rollup(spark: SparkSession, folder: str) -> DataFrame:
    signals, documents = _t(spark, folder, "signals", "documents")
    return projects.project_rollup(projects.project_members(signals, documents), signals, documents).withColumn("first_signal_date", F.col("first_signal_date").cast("string")).withColumn("last_signal_date", F.col("last_signal_date").cast("string"))

"""Registered queries of the pipeline's stages, reports and discovery, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicgrain.functions import dates, text
from civicgrain.operators import classify, discovery, lifecycle, projects, registry, repair, reports, scan
from civicgrain.plans import record_queries as records
from civicgrain.plans.record_queries import AS_OF, PRICES, VOCABULARY
from civicgrain.sources.tables import table, texts

QUERIES, ORACLE = {}, {}
START = "2025-09-01"  # a year before AS_OF


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _t(spark, folder, *names):
    got = [table(spark, folder, n) for n in names]
    return got[0] if len(got) == 1 else got


# --- dates

_MONTH = "CASE lower({n}[1:3]) " + " ".join(f"WHEN '{m}' THEN {i}" for i, m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split(), 1)) + " END"
_YEAR = "coalesce(try_cast(nullif(regexp_extract({u}, '((?:19|20)[0-9]{{2}})[-./_]', 1), '') AS INTEGER), try_cast(nullif(regexp_extract({u}, '((?:19|20)[0-9]{{2}})[.](?i:pdf)', 1), '') AS INTEGER))"


def _sql_date(source: str, pattern: str, year, month: int, day: int | None, named: bool) -> str:
    part = lambda g: f"regexp_extract({source}, '(?i){pattern}', {g})"
    number = lambda g: f"try_cast(nullif({part(g)}, '') AS INTEGER)"
    y = year(part, number) if callable(year) else f"CASE WHEN {part(0)} <> '' THEN {year} END" if isinstance(year, str) else number(year)
    m = _MONTH.format(n=part(month)) if named else number(month)
    return f"try_cast(printf('%04d-%02d-%02d', {y}, {m}, {number(day) if day else 1}) AS DATE)"


def _sql_meeting_date(t: str, u: str, fallback: str = "NULL") -> str:
    source, year = f"regexp_replace(coalesce({t}, ''), '[{text.DASHES}]', '-', 'g')", _YEAR.format(u=f"coalesce({u}, '')")
    full, abbr = f"({dates._FULL})[.]?\\s+", f"({dates._ABBR})[.]?\\s+"
    tail = "([0-9]{1,2})(?:st|nd|rd|th)?,?\\s+([0-9]{4})"
    short = lambda part, number: f"CASE WHEN length({part(4)}) = 2 THEN {number(4)} + CASE WHEN {number(4)} < 50 THEN 2000 ELSE 1900 END ELSE {number(4)} END"
    d = lambda *a: _sql_date(source, *a)
    forms = [
        *(d(n + tail, 3, 1, 2, True) for n in (full, abbr)), *(d(n + "([0-9]{4})", 2, 1, None, True) for n in (full, abbr)), d(full + "([0-9]{1,2})\\b", f"coalesce({year}, {fallback})", 1, 2, True),
        d("(^|[^0-9])([0-9]{1,2})[-/]([0-9]{1,2})[-/]([0-9]{4}|[0-9]{2})([^0-9]|$)", short, 2, 3, False), d("([0-9]{4})[-/]([0-9]{1,2})[-/]([0-9]{1,2})", 1, 2, 3, False), d(abbr + "([0-9]{1,2})\\b", year, 1, 2, True),
    ]
    return f"coalesce({', '.join(forms)})"


@query(f"SELECT doc_id, CAST({_sql_meeting_date('link_text', 'source_url', 'year(meeting_date)')} AS VARCHAR) AS found FROM documents")
def link_text_dates(spark: SparkSession, folder: str) -> DataFrame:
    return _t(spark, folder, "documents").select("doc_id", dates.meeting_date(F.col("link_text"), F.col("source_url"), F.year("meeting_date")).cast("string").alias("found"))


def _sql_text_date(t: str) -> str:
    head, b = f"coalesce({t}, '')[1:3000]", "\\b"
    every = f"({dates._FULL}|{dates._ABBR})"
    return "coalesce(" + ", ".join([
        _sql_date(head, f"{b}{every}\\s+([0-9]{{1,2}}),?\\s+([0-9]{{4}}){b}", 3, 1, 2, True), _sql_date(head, f"{b}([0-9]{{1,2}})\\s+({dates._FULL})\\s+([0-9]{{4}}){b}", 3, 2, 1, True),
        _sql_date(head, f"{b}([0-9]{{1,2}})/([0-9]{{1,2}})/([0-9]{{4}}){b}", 3, 1, 2, False), _sql_date(head, f"{b}([0-9]{{4}})-([0-9]{{2}})-([0-9]{{2}}){b}", 1, 2, 3, False),
    ]) + ")"


@query(f"SELECT doc_id, CAST(found AS VARCHAR) AS found FROM (SELECT doc_id, {_sql_text_date('text')} AS found FROM documents) WHERE found IS NOT NULL")
def body_text_dates(spark: SparkSession, folder: str) -> DataFrame:
    return texts(spark, folder).select("doc_id", dates.text_date(F.col("text")).cast("string").alias("found")).where("found is not null")


@query(f"""WITH d AS (SELECT body_id, {_sql_meeting_date('link_text', 'source_url')} AS found FROM documents)
SELECT body_id, count(*) AS documents, count(found) AS parsed, count(*) FILTER (WHERE found >= DATE '{START}') AS inside, count(*) FILTER (WHERE found < DATE '{START}') AS outside, count(*) FILTER (WHERE found IS NULL) AS undated FROM d GROUP BY body_id""")
def date_parse_stats(spark: SparkSession, folder: str) -> DataFrame:
    return repair.parse_stats(repair.reparsed(_t(spark, folder, "documents"), AS_OF))


_DATED = f"late AS (SELECT doc_id FROM (SELECT doc_id, in_window, {_sql_text_date('text')} AS found FROM documents WHERE meeting_date IS NULL AND text IS NOT NULL AND length(text) > 0) WHERE found < DATE '{START}'"


@query(f"WITH {_DATED}) SELECT count(DISTINCT document_id) AS documents, coalesce(sum(input_tokens), 0)::BIGINT AS input_tokens, coalesce(sum(output_tokens), 0)::BIGINT AS output_tokens, coalesce(round(sum({records._COST}), 6), 0) AS cost FROM llm_runs WHERE document_id IN (SELECT doc_id FROM late)")
def redated_cost(spark: SparkSession, folder: str) -> DataFrame:
    """Documents here have no window where they have no date, so all of them count as thought to be inside."""
    documents = texts(spark, folder).withColumn("in_window", F.lit(True))
    return repair.cost_outside(repair.dated_by_text(documents, START), _t(spark, folder, "llm_runs"), classify.run_cost(PRICES))


# --- lifecycle


@query("SELECT doc_id, status FROM documents WHERE status IN ('scanned', 'extracted')")
def documents_of_status(spark: SparkSession, folder: str) -> DataFrame:
    return lifecycle.of_values(_t(spark, folder, "documents"), "status", ["scanned", "extracted"]).select("doc_id", "status")


@query("SELECT doc_id FROM documents WHERE text IS NOT NULL AND text <> '' AND status = 'scanned' AND in_window")
def documents_to_classify(spark: SparkSession, folder: str) -> DataFrame:
    return classify.to_classify(_t(spark, folder, "documents")).select("doc_id")


@query("""SELECT doc_id, CASE WHEN text IS NULL THEN 'error' WHEN status = 'extracted' THEN 'scanned' ELSE status END AS status, CASE WHEN text IS NULL THEN 'no text' ELSE CASE WHEN status = 'extracted' THEN NULL ELSE error END END AS error FROM documents""")
def status_updates(spark: SparkSession, folder: str) -> DataFrame:
    documents = _t(spark, folder, "documents").select("doc_id", "status", "error", F.col("text").isNull().alias("bare"))
    updates = documents.where("bare or status = 'extracted'").select("doc_id", F.when(F.col("bare"), "error").otherwise("scanned").alias("status"), F.when(F.col("bare"), "no text").alias("error"))
    return lifecycle.with_updates(documents, updates, "doc_id").select("doc_id", "status", "error")


@query("""WITH reached AS (SELECT body_id, max(CASE WHEN status IN ('new', 'error') THEN 4 ELSE 5 END) AS level FROM documents WHERE body_id IS NOT NULL GROUP BY body_id)
SELECT row_number() OVER (ORDER BY body_id)::INTEGER AS id, body_id, coalesce(coverage_level, 0) AS old_level, level AS new_level, CASE level WHEN 5 THEN 'fetched' ELSE 'discovered' END AS note FROM bodies JOIN reached USING (body_id) WHERE level > coalesce(coverage_level, 0)""")
def coverage_changes(spark: SparkSession, folder: str) -> DataFrame:
    bodies, documents = _t(spark, folder, "bodies", "documents")
    held = documents.where("body_id is not null").select("body_id", F.when(F.col("status").isin("new", "error"), 4).otherwise(5).alias("level")).distinct()
    changes = lifecycle.levels_after(bodies, held.withColumn("note", F.when(F.col("level") == 5, "fetched").otherwise("discovered")))
    empty = spark.createDataFrame([], "id int, body_id string, old_level int, new_level int, blocker_code string, note string, changed_at timestamp_ntz")
    return lifecycle.log_levels(bodies, empty, changes, F.lit(AS_OF).cast("timestamp_ntz"))[1].select("id", "body_id", "old_level", "new_level", "note")


_LOG = "lg AS (SELECT row_number() OVER (ORDER BY last_checked, body_id) AS id, last_checked AS changed_at, CASE WHEN blocker_code IS NULL THEN 0 ELSE 1 END AS o, coalesce(coverage_level, 0) AS n FROM bodies WHERE last_checked IS NOT NULL)"


@query(f"""WITH {_LOG}, now AS (SELECT {', '.join(f"count(*) FILTER (WHERE coalesce(coverage_level, 0) = {k}) AS n{k}" for k in range(7))} FROM bodies),
t AS (SELECT {', '.join(f"coalesce(sum((n = {k})::INT - (o = {k})::INT), 0) AS t{k}" for k in range(7))} FROM lg),
i AS (SELECT {', '.join(f"n{k} - t{k} AS i{k}" for k in range(7))} FROM now, t),
s AS (SELECT row_number() OVER w AS step, CAST(CAST(changed_at AS DATE) AS VARCHAR) AS date, {', '.join(f"i{k} + sum((n = {k})::INT - (o = {k})::INT) OVER w AS level_{k}" for k in range(7))} FROM lg, i WINDOW w AS (ORDER BY changed_at, id ROWS UNBOUNDED PRECEDING)),
a AS (SELECT 0 AS step, 'initial' AS date, {', '.join(f"i{k} AS level_{k}" for k in range(7))} FROM i UNION ALL SELECT * FROM s)
SELECT step::BIGINT AS step, date, {', '.join(f"level_{k}::BIGINT AS level_{k}" for k in range(7))}, (level_3 + level_4 + level_5 + level_6)::BIGINT AS level_3_plus FROM a""")
def coverage_trend(spark: SparkSession, folder: str) -> DataFrame:
    """The log here: one entry for each body that was checked, from level 0 (1 where something blocks) to its level, when it was last checked."""
    from civicgrain.operators.tables import numbered

    bodies = _t(spark, folder, "bodies")
    entries = bodies.where("last_checked is not null").select("body_id", F.col("last_checked").alias("changed_at"), F.when(F.col("blocker_code").isNull(), 0).otherwise(1).alias("old_level"), F.coalesce("coverage_level", F.lit(0)).alias("new_level"))
    return reports.coverage_trend(bodies, numbered(entries, [F.col("changed_at"), F.col("body_id")], "id"))


@query(records._PASSAGES + f""", old AS (SELECT doc_id, CAST(i AS INTEGER) AS passage_index, 'old' AS made FROM (SELECT doc_id, unnest(range(0, 2)) AS i FROM documents)), done AS (SELECT doc_id FROM documents WHERE status IN ('extracted', 'scanned'))
SELECT * FROM old ANTI JOIN done USING (doc_id) UNION ALL SELECT doc_id, CAST(passage_index AS INTEGER), 'new' FROM passages SEMI JOIN done USING (doc_id)""")
def hits_rescanned(spark: SparkSession, folder: str) -> DataFrame:
    """A second scan of some documents: their old rows go, those of the others stay."""
    documents = texts(spark, folder)
    old = documents.select("doc_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("passage_index"), F.lit("old").alias("made"))
    done = lifecycle.of_values(documents, "status", ["extracted", "scanned"])
    new = scan.keyword_passages(done, VOCABULARY).select("doc_id", "passage_index", F.lit("new").alias("made"))
    return lifecycle.replaced(lifecycle.replaced(old, new, done, "doc_id"), new, done, "doc_id")


@query("""WITH new AS (SELECT DISTINCT body_id, meeting_date FROM documents WHERE body_id IS NOT NULL AND meeting_date IS NOT NULL EXCEPT SELECT body_id, meeting_date FROM meeting_calendar)
SELECT (SELECT max(meeting_id) FROM meeting_calendar) + row_number() OVER (ORDER BY body_id, meeting_date) AS meeting_id, body_id, CAST(meeting_date AS VARCHAR) AS meeting_date FROM new""")
def calendar_created(spark: SparkSession, folder: str) -> DataFrame:
    documents, calendar = _t(spark, folder, "documents", "meeting_calendar")
    after = lifecycle.calendar_after(calendar, documents)
    return after.join(calendar.select("meeting_id"), "meeting_id", "left_anti").select(F.col("meeting_id").cast("long").alias("meeting_id"), "body_id", F.col("meeting_date").cast("string"))


@query("""SELECT step, stage, (SELECT count(*) FROM documents WHERE status = s) AS documents FROM (VALUES (0, 'fetch', 'new'), (1, 'extract', 'fetched'), (2, 'scan', 'extracted'), (3, 'classify', 'scanned'), (4, 'report', 'classified')) v(step, stage, s)""")
def dry_run(spark: SparkSession, folder: str) -> DataFrame:
    return lifecycle.stage_counts(_t(spark, folder, "documents"))


# --- reports

_ORDER = "CASE coalesce(stage, 'unknown') " + " ".join(f"WHEN '{s}' THEN {n}" for s, n in reports._STAGE_ORDER.items()) + " ELSE 50 END"
_OWNED = "signals s JOIN documents d ON s.document_id = d.doc_id JOIN bodies b ON b.body_id = d.body_id"


@query(f"""SELECT row_number() OVER (ORDER BY CASE WHEN d.in_window THEN 0 ELSE 1 END, {_ORDER}, coalesce(dollar_amount, 0) DESC, signal_id) AS place, signal_id, b.name AS body, b.body_id, coalesce(building, '') AS building, coalesce(array_to_string(trades, ', '), '') AS trades,
coalesce(stage, '') AS stage, stage_verified, CAST(nullif(dollar_amount, 0) AS DOUBLE) AS dollar_amount, coalesce(funding_source, '') AS funding_source, coalesce(scope_summary, '') AS scope_summary, coalesce(evidence_quote, '') AS evidence_quote, source_url,
coalesce(CAST(meeting_date AS VARCHAR), '') AS meeting_date, d.in_window FROM {_OWNED} WHERE is_signal""")
def signals_report(spark: SparkSession, folder: str) -> DataFrame:
    signals, documents, bodies = _t(spark, folder, "signals", "documents", "bodies")
    return reports.signals_report(signals, documents, bodies).withColumn("dollar_amount", F.col("dollar_amount").cast("double"))


_ROLLUP = records.ORACLE["project_rollup"]


@query(f"""SELECT row_number() OVER (ORDER BY latest_stage ASC NULLS LAST, last_signal_date DESC NULLS LAST, project_id) AS place, project_id, name AS body, body_id, coalesce(building, '') AS building, coalesce(scope_summary, '') AS scope_summary, coalesce(first_signal_date, '') AS first_signal_date,
coalesce(last_signal_date, '') AS last_signal_date, coalesce(latest_stage, '') AS latest_stage, signal_count FROM ({_ROLLUP}) JOIN (SELECT body_id, name FROM bodies) USING (body_id)""")
def projects_report(spark: SparkSession, folder: str) -> DataFrame:
    signals, documents, bodies = _t(spark, folder, "signals", "documents", "bodies")
    return reports.projects_report(projects.rebuilt(signals, documents)[0], bodies)


@query(f"SELECT count(*) AS projects, coalesce(sum(signal_count), 0)::BIGINT AS signals, round(avg(signal_count), 4) AS mean_signals, max(signal_count) AS max_signals, coalesce(max(signal_count) > 60, false) AS too_large FROM ({_ROLLUP})")
def project_stats(spark: SparkSession, folder: str) -> DataFrame:
    return projects.project_stats(projects.rebuilt(*_t(spark, folder, "signals", "documents"))[0])


@query(f"SELECT project_id, coalesce(name[1:30], body_id) AS body, coalesce(building, '-')[1:20] AS building, latest_stage, signal_count FROM ({_ROLLUP}) LEFT JOIN (SELECT body_id, name FROM bodies) USING (body_id) ORDER BY signal_count DESC, project_id LIMIT 10")
def largest_projects(spark: SparkSession, folder: str) -> DataFrame:
    """The ten largest are what the report shows."""
    signals, documents, bodies = _t(spark, folder, "signals", "documents", "bodies")
    return projects.largest_projects(projects.rebuilt(signals, documents)[0], bodies)


@query(f"{records._CLUSTERS} SELECT signal_id, project_id FROM mem")
def signals_of_projects(spark: SparkSession, folder: str) -> DataFrame:
    return projects.rebuilt(*_t(spark, folder, "signals", "documents"))[1].select("signal_id", "project_id")


@query(f"SELECT b.body_id, b.name AS body, scope_summary, count(*) AS signals, CAST(min(meeting_date) AS VARCHAR) AS first_date, CAST(max(meeting_date) AS VARCHAR) AS last_date, coalesce(array_to_string(list_sort(list(DISTINCT stage) FILTER (WHERE stage IS NOT NULL)), ', '), '') AS stages FROM {_OWNED} WHERE is_signal AND d.in_window AND scope_summary IS NOT NULL GROUP BY 1, 2, 3 HAVING count(*) >= 2")
def repeated_scopes(spark: SparkSession, folder: str) -> DataFrame:
    """Scopes stated twice: three times none is, in small data."""
    signals, documents, bodies = _t(spark, folder, "signals", "documents", "bodies")
    return reports.repeated_scopes(signals, documents, bodies, least=2).withColumn("first_date", F.col("first_date").cast("string")).withColumn("last_date", F.col("last_date").cast("string"))


_TIDY = r"trim(regexp_replace(lower(coalesce({c}, '')), '\s+', ' ', 'g'))"
_CALIBRATED = records._PASSAGES + f""", sg AS (SELECT signal_id, CAST(document_id AS BIGINT) AS doc_id, passage_index, scope_summary, evidence_quote, body_id, {_TIDY.format(c='evidence_quote')} AS q FROM signals JOIN documents ON document_id = doc_id WHERE is_signal AND in_window),
ps AS (SELECT doc_id, passage_index, {_TIDY.format(c='t')} AS t FROM passages SEMI JOIN (SELECT doc_id FROM documents WHERE in_window) USING (doc_id)),
mt AS (SELECT doc_id, signal_id, ps.passage_index AS p FROM sg JOIN ps USING (doc_id) WHERE q <> '' AND (contains(t, q) OR contains(q, t))),
sm AS (SELECT sg.*, EXISTS (SELECT 1 FROM mt WHERE mt.doc_id = sg.doc_id AND mt.signal_id = sg.signal_id) AS met FROM sg), pm AS (SELECT ps.*, EXISTS (SELECT 1 FROM mt WHERE mt.doc_id = ps.doc_id AND mt.p = ps.passage_index) AS met FROM ps)"""
_RATES = """ SELECT 'missed' AS rate, count(*) FILTER (WHERE NOT met) AS part, count(*) AS whole, coalesce(round(100.0 * count(*) FILTER (WHERE NOT met) / nullif(count(*), 0), 1), 0) AS pct FROM {s} UNION ALL SELECT 'false_hit', count(*) FILTER (WHERE NOT met), count(*), coalesce(round(100.0 * count(*) FILTER (WHERE NOT met) / nullif(count(*), 0), 1), 0) FROM {p}"""


def _calibrated(spark, folder, **how):
    signals, documents = table(spark, folder, "signals"), texts(spark, folder)
    return reports.calibration(signals, scan.keyword_passages(documents, VOCABULARY), documents, **how)


@query(_CALIBRATED + _RATES.format(s="sm", p="pm"))
def calibration_corrected(spark: SparkSession, folder: str) -> DataFrame:
    """Quotes and passages that contain each other; the fold over words that may follow is left out, as SQL has none."""
    return reports.calibration_rates(*_calibrated(spark, folder, partial=None))


@query(_CALIBRATED + ", sx AS (SELECT signal_id, EXISTS (SELECT 1 FROM ps WHERE ps.doc_id = sg.doc_id AND ps.passage_index = sg.passage_index) AS met FROM sg), px AS (SELECT EXISTS (SELECT 1 FROM sg WHERE ps.doc_id = sg.doc_id AND ps.passage_index = sg.passage_index) AS met FROM ps)" + _RATES.format(s="sx", p="px"))
def calibration_by_index(spark: SparkSession, folder: str) -> DataFrame:
    return reports.calibration_rates(*_calibrated(spark, folder, by_index=True))


@query(_CALIBRATED + """, ms AS (SELECT row_number() OVER (ORDER BY signal_id) AS place, count(*) OVER () AS n, * FROM sm WHERE NOT met)
SELECT place::INTEGER AS place, signal_id, body_id, CASE WHEN coalesce(scope_summary, '') = '' THEN 'no summary' WHEN length(scope_summary) > 60 THEN scope_summary[1:60] || '...' ELSE scope_summary END AS scope,
CASE WHEN coalesce(evidence_quote, '') = '' THEN 'no quote' WHEN length(evidence_quote) > 100 THEN evidence_quote[1:100] || '...' ELSE evidence_quote END AS quote FROM ms WHERE place <= 20
UNION ALL SELECT 21, NULL, NULL, 'and ' || (max(n) - 20) || ' more', NULL FROM ms HAVING max(n) > 20""")
def missed_signals(spark: SparkSession, folder: str) -> DataFrame:
    """The first twenty are what the report lists; a last row counts the others."""
    return reports.missed_signals(_calibrated(spark, folder, partial=None)[0])


@query(records._PASSAGES + ", ip AS (SELECT passages.* FROM passages JOIN documents USING (doc_id) WHERE in_window) SELECT doc_id, CAST(passage_index AS INTEGER) AS passage_index, length(t)::INTEGER AS size FROM ip")
def passages_in_window(spark: SparkSession, folder: str) -> DataFrame:
    documents = texts(spark, folder)
    return scan.keyword_passages(documents, VOCABULARY).join(documents.where("in_window").select("doc_id"), "doc_id").select("doc_id", "passage_index", F.length("passage_text").alias("size"))


def _sql_counter(kind: str, groups) -> str:
    rows = " UNION ALL ".join(f"SELECT '{kind}' AS kind, '{k}' AS key, doc_id, length(t) AS n FROM passages WHERE {records._sql_any('said', w)}" for k, w in groups.items())
    return rows


@query(records._PASSAGES + f""", e AS (SELECT 'all' AS kind, '' AS key, doc_id, length(t) AS n FROM passages UNION ALL {_sql_counter('trades', VOCABULARY.trades)} UNION ALL {_sql_counter('stages', VOCABULARY.stages)})
SELECT kind, key, count(DISTINCT doc_id) AS documents, round(100.0 * count(DISTINCT doc_id) / (SELECT count(*) FROM documents), 1) AS pct, sum(n)::BIGINT AS chars FROM e GROUP BY kind, key""")
def scan_counters(spark: SparkSession, folder: str) -> DataFrame:
    documents = texts(spark, folder)
    return scan.scan_counters(scan.keyword_passages(documents, VOCABULARY), documents)


_WORDS = list(dict.fromkeys(w for g in (VOCABULARY.trades | {"": VOCABULARY.triggers}).values() for w in g))


@query(records._PASSAGES + f""", k AS (SELECT * FROM (VALUES {', '.join(f"({i}, '{w}', '(^|[^a-z])(" + "[[:space:]-]+".join(w.split()) + ")(s|es|ing|ed)?([^a-z]|$)')" for i, w in enumerate(_WORDS))}) v(o, kw, rx)),
pi AS (SELECT p.doc_id, p.passage_index, i.line_no, i.c FROM passages p JOIN island i ON i.doc_id = p.doc_id AND i.line_no BETWEEN p.s AND p.e),
f AS (SELECT doc_id, passage_index, kw, min(line_no * 1000 + o) AS first FROM pi JOIN k ON regexp_matches(c, rx) GROUP BY ALL)
SELECT doc_id, CAST(passage_index AS INTEGER) AS passage_index, string_agg(kw, ',' ORDER BY first) AS keywords FROM f GROUP BY doc_id, passage_index""")
def passage_keywords(spark: SparkSession, folder: str) -> DataFrame:
    """Keywords of a passage as they are first met."""
    return scan.keyword_passages(texts(spark, folder), VOCABULARY).select("doc_id", "passage_index", F.array_join("keywords", ",").alias("keywords"))


@query(f"SELECT CAST(CAST(created_at AS DATE) AS VARCHAR) AS day, count(*) AS runs, round(sum({records._COST}), 6) AS spent, 0.05::DOUBLE AS cap, sum({records._COST}) >= 0.05 AS reached, round(greatest(0.05 - sum({records._COST}), 0), 6) AS remaining FROM llm_runs WHERE created_at IS NOT NULL GROUP BY 1")
def cost_summary(spark: SparkSession, folder: str) -> DataFrame:
    return classify.cost_summary(_t(spark, folder, "llm_runs"), PRICES, records.CAP).withColumn("day", F.col("day").cast("string"))


@query(r"""WITH RECURSIVE p AS (SELECT doc_id, text, list_filter(list_transform(regexp_split_to_array(text, '\n'), lambda x: regexp_replace(x, '^[\s\x{a0}]+|[\s\x{a0}]+$', '', 'g')), lambda x: x <> '') AS ps FROM documents WHERE text IS NOT NULL AND text <> ''),
f AS (SELECT doc_id, ps, 1 AS k, 0 AS chunk_index, length(ps[1]) AS size FROM p WHERE length(text) > 2000 AND len(ps) > 0
UNION ALL SELECT doc_id, ps, k + 1, CASE WHEN size + length(ps[k + 1]) + 2 > 2000 THEN chunk_index + 1 ELSE chunk_index END, CASE WHEN size + length(ps[k + 1]) + 2 > 2000 THEN length(ps[k + 1]) ELSE size + length(ps[k + 1]) + 2 END FROM f WHERE k < len(ps))
SELECT doc_id, chunk_index::INTEGER AS chunk_index, max(size)::INTEGER AS size FROM f GROUP BY doc_id, chunk_index UNION ALL SELECT doc_id, 0, length(text)::INTEGER FROM p WHERE length(text) <= 2000""")
def chunk_pack(spark: SparkSession, folder: str) -> DataFrame:
    """Lines packed into chunks of 2,000 characters: the texts here have no blank lines."""
    return classify.chunks(texts(spark, folder), 2000, "\n").select("doc_id", "chunk_index", F.length("chunk").alias("size"))


@query(r"""WITH RECURSIVE b AS (SELECT signal_id, trim(regexp_replace(lower(coalesce(evidence_quote, '')), '\s+', ' ', 'g')) AS q, trim(regexp_replace(lower(coalesce(text, '')), '\s+', ' ', 'g')) AS t FROM signals JOIN documents ON document_id = doc_id),
w AS (SELECT signal_id, string_split(q, ' ') AS ws, t FROM b WHERE q <> '' AND NOT contains(t, q)),
f AS (SELECT signal_id, ws, t, 0 AS n, 1 AS pos FROM w
UNION ALL SELECT signal_id, ws, t, n + 1, pos + instr(substr(t, pos), ws[n + 1]) - 1 + length(ws[n + 1]) FROM f WHERE n < len(ws) AND instr(substr(t, pos), ws[n + 1]) > 0),
r AS (SELECT signal_id, max(n) / max(len(ws)) AS share FROM f GROUP BY signal_id)
SELECT signal_id, coalesce(share >= 0.8, true) AS found FROM b LEFT JOIN r USING (signal_id)""")
def evidence_checked(spark: SparkSession, folder: str) -> DataFrame:
    """A document's text is joined to its signals once each; the check itself reads it in place."""
    signals, documents = _t(spark, folder, "signals", "documents")
    rows = signals.select("signal_id", "document_id", "evidence_quote").join(documents.select(F.col("doc_id").alias("document_id"), "text"), "document_id")
    return rows.select("signal_id", text.evidence_found(F.col("evidence_quote"), F.col("text")).alias("found"))


# --- discovery

_PAGE = lambda: F.concat(F.lit('<ul><li><a href="'), "source_url", F.lit('">'), F.coalesce("link_text", F.lit("")), F.lit("</a></li><li><a HREF='/board/agenda-"), F.col("doc_id").cast("string"), F.lit("'>x</a></li></ul>"))


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    """A page for each document, as the body's site would link to it."""
    page = F.concat(F.lit("https://www."), F.coalesce("body_id", F.lit("none")), F.lit(".example/list?page="), F.col("doc_id").cast("string"))
    return _t(spark, folder, "documents").where("not source_url like '%\"%'").select("doc_id", "body_id", F.col("doc_id").cast("int").alias("page_order"), page.alias("url"), _PAGE().alias("html"))


_SHOWN = "coalesce(nullif(trim(regexp_replace(coalesce(link_text, ''), '[\\s\\x{a0}]+', ' ', 'g')), ''), regexp_extract(source_url, '[^/]*$'))"
_DOC_TYPE = records.ORACLE["doc_type_rules"].replace("FROM documents", "FROM l").replace("SELECT doc_id,", "SELECT l.*,")


@query(f"""WITH l AS (SELECT doc_id, body_id, source_url, {_SHOWN} AS link_text FROM documents WHERE lower(source_url) LIKE '%.pdf' AND body_id IS NOT NULL AND source_url NOT LIKE '%"%'),
t AS ({_DOC_TYPE}), d AS (SELECT *, {_sql_meeting_date('link_text', 'source_url')} AS day FROM t)
SELECT body_id, source_url, link_text, CAST(day AS VARCHAR) AS meeting_date, found_type AS doc_type, meeting_type FROM d WHERE day IS NULL OR day >= DATE '{START}'""")
def discovered_documents(spark: SparkSession, folder: str) -> DataFrame:
    got = discovery.PdfLinks(START).list_documents(_pages(spark, folder).where("body_id is not null"))
    return got.select("body_id", "source_url", "link_text", F.col("meeting_date").cast("string"), "doc_type", "meeting_type")


@query("SELECT body_id, source_url FROM documents WHERE body_id IS NOT NULL EXCEPT SELECT body_id, source_url FROM documents WHERE status <> 'new'")
def documents_absent(spark: SparkSession, folder: str) -> DataFrame:
    documents = _t(spark, folder, "documents").where("body_id is not null")
    return lifecycle.new_documents(documents.where("status <> 'new'"), documents.select("body_id", "source_url", F.col("doc_id").alias("page_order"))).select("body_id", "source_url")


@query(f"""SELECT doc_id, source_url FROM documents WHERE meeting_date IS NULL OR meeting_date >= DATE '{START}'""")
def backfill_window(spark: SparkSession, folder: str) -> DataFrame:
    return discovery.within_backfill(_t(spark, folder, "documents"), START).select("doc_id", "source_url")


_HOST = "lower(regexp_extract({u}, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]*)', 1))"
_ONE_HOST = "(SELECT min(" + _HOST.format(u="source_url") + ") FROM documents)"


@query(f"SELECT doc_id FROM documents WHERE {_HOST.format(u='source_url')} <> {_ONE_HOST}")
def hosts_not_blocked(spark: SparkSession, folder: str) -> DataFrame:
    documents = _t(spark, folder, "documents")
    first = documents.agg(F.min(discovery.host_of(F.col("source_url"))).alias("h")).first()["h"]  # one value
    return discovery.not_blocked(documents, hosts=(first,)).select("doc_id")


@query(f"SELECT body_id, {_HOST.format(u='source_url')} AS host, count(*) AS links FROM documents WHERE lower(source_url) LIKE '%.pdf%' AND source_url NOT LIKE '%\"%' GROUP BY 1, 2")
def file_hosts(spark: SparkSession, folder: str) -> DataFrame:
    return discovery.file_hosts(_pages(spark, folder))


_SIGNS = {"Boardhub": "boardhub", "Drive": "drive_folder|/files/", "Uploads": "/uploads/"}


@query("SELECT doc_id, array_to_string(list_filter([" + ", ".join(f"CASE WHEN regexp_matches(lower(source_url), '{p}') THEN '{n}' END" for n, p in _SIGNS.items()) + "], lambda x: x IS NOT NULL), ';') AS signs FROM documents WHERE source_url NOT LIKE '%\"%'")
def page_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return _pages(spark, folder).select("doc_id", F.array_join(discovery.fingerprints(F.col("html"), _SIGNS), ";").alias("signs"))


@query(r"""SELECT 'www.' || coalesce(body_id, 'none') || '.example' AS site, '' AS platforms, '' AS systems, count(*) FILTER (WHERE regexp_matches(source_url, '(?i)\.pdf|getfile|documentcenter|resource-manager|/files/|drive\.google') AND regexp_matches(source_url, '(?i)agenda|minute|meeting|boe|board')) AS document_links, count(*) AS pages
FROM documents WHERE source_url NOT LIKE '%"%' GROUP BY 1""")
def site_profiles(spark: SparkSession, folder: str) -> DataFrame:
    return discovery.site_profile(_pages(spark, folder)).drop("platform_links")


@query("SELECT body_id FROM bodies WHERE NOT regexp_matches(coalesce(platform, ''), '(?i)boarddocs|diligent|google drive') AND coalesce(own_site_doc_links, 0) <= 0")
def unresolved_bodies(spark: SparkSession, folder: str) -> DataFrame:
    rows = _t(spark, folder, "bodies").select("body_id", F.lit("200").alias("status"), F.col("platform").alias("platforms"), F.col("own_site_doc_links").cast("string").alias("document_links"))
    return discovery.unresolved(rows).select("body_id")


@query("SELECT body_id, url, target AS link FROM (SELECT body_id, 'https://www.' || coalesce(body_id, 'none') || '.example/list?page=' || doc_id AS url, 'https://www.' || coalesce(body_id, 'none') || '.example/board/agenda-' || doc_id AS target FROM documents WHERE source_url NOT LIKE '%\"%')")
def page_links(spark: SparkSession, folder: str) -> DataFrame:
    pages = _pages(spark, folder)
    return discovery.page_links(pages).join(pages.select("url", "body_id"), "url").select("body_id", "url", "link")


_FIRST = "regexp_extract(regexp_replace(website, '^https?://', ''), '^([^/?#]*)', 1)"


@query(f"""WITH h AS (SELECT body_id, {_FIRST} AS h, regexp_replace({_FIRST}, '^www\\.', '') AS b FROM bodies WHERE website IS NOT NULL AND {_FIRST} <> ''),
v AS (SELECT body_id, CASE WHEN h = b THEN [h, 'www.' || b] WHEN h = 'www.' || b THEN [h, b] ELSE [h, b, 'www.' || b] END AS hs FROM h)
SELECT body_id, array_to_string(list_concat(list_transform(hs, lambda x: 'https://' || x || '/'), list_transform(hs, lambda x: 'http://' || x || '/')), ' ') AS variants FROM v""")
def host_variants(spark: SparkSession, folder: str) -> DataFrame:
    rows = _t(spark, folder, "bodies").select("body_id", discovery.address_variants(F.col("website")).alias("v"))
    return rows.where("v is not null").select("body_id", F.array_join("v", " ").alias("variants"))


@query("SELECT doc_id, CASE WHEN doc_id < 500 THEN sha256(source_url)[1:20] ELSE 'q-' || doc_id END AS found FROM documents")
def drive_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Ids written into Drive addresses of both forms and read back."""
    key = F.substring(F.sha2("source_url", 256), 1, 20)
    url = F.when(F.col("doc_id") < 500, F.concat(F.lit("https://drive.google.com/file/d/"), key, F.lit("/view?usp=sharing"))).otherwise(F.concat(F.lit("https://drive.google.com/open?usp=x&id=q-"), F.col("doc_id").cast("string")))
    return _t(spark, folder, "documents").select("doc_id", discovery.drive_id(url, "file").alias("found"))


@query("""WITH f AS (SELECT doc_id, sha256, regexp_extract(regexp_replace(regexp_replace(source_url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*', ''), '[?#].*$', ''), '[^/]*$') AS f FROM documents)
SELECT doc_id, sha256[1:8] || '_' || CASE WHEN f LIKE '%.pdf' THEN f ELSE f || '.pdf' END AS name FROM f""")
def file_names(spark: SparkSession, folder: str) -> DataFrame:
    return _t(spark, folder, "documents").select("doc_id", text.file_name(F.col("source_url"), F.col("sha256")).alias("name"))


@query(f"""WITH h AS (SELECT DISTINCT {_HOST.format(u='source_url')} AS host FROM documents), r AS (SELECT host, CASE length(host) % 3 WHEN 0 THEN 200 WHEN 1 THEN 404 ELSE 503 END AS status FROM h)
SELECT doc_id, CASE r.status WHEN 503 THEN false WHEN 404 THEN true ELSE NOT starts_with(regexp_replace(source_url, '^[a-zA-Z]+://[^/]*', ''), '/uploads/') END AS allowed, CASE WHEN r.status = 200 THEN CAST(length(host) AS DOUBLE) END AS delay
FROM documents JOIN r ON host = {_HOST.format(u='source_url')}""")
def robots_decisions(spark: SparkSession, folder: str) -> DataFrame:
    """Robots files made up for the hosts: a third each read, missing and failing."""
    documents = _t(spark, folder, "documents").select("doc_id", F.col("source_url").alias("url"))
    hosts, n = documents.select(discovery.host_of(F.col("url")).alias("host")).distinct(), F.length("host")
    robots = hosts.select("host", F.when(n % 3 == 0, 200).when(n % 3 == 1, 404).otherwise(503).alias("status"), F.concat(F.lit("User-agent: *\nCrawl-delay: 1\nDisallow: /uploads/\nCrawl-delay: "), n.cast("string")).alias("text"))
    return discovery.robots_decisions(documents, robots).select("doc_id", "allowed", "delay")


# --- registries


def _sheets(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    units, suppliers = _t(spark, folder, "registry_units", "supplier")
    general = units.select(F.col("unit_id").alias("CENSUS_ID_PID6"), F.col("unit_name").alias("UNIT_NAME"), F.when(F.col("pupils").isNull(), "2 - MUNICIPAL").otherwise("1 - COUNTY").alias("UNIT_TYPE"), F.col("area").alias("COUNTY_AREA_NAME"), F.col("homepage").alias("WEB_ADDRESS"), F.col("pupils").alias("POPULATION"), F.when(F.col("school_year").isNull(), "N").otherwise("Y").alias("IS_ACTIVE"))
    special = suppliers.select(F.col("s_suppkey").alias("CENSUS_ID_PID6"), F.col("s_name").alias("UNIT_NAME"), F.when(F.col("s_acctbal") > 0, "Library").alias("FUNCTION_NAME"), F.lit("NY").alias("STATE"))
    return {"General Purpose": general, "Special District": special}


_SHEETS = """g AS (SELECT 0 AS o, 'COG-' || unit_id AS body_id, unit_name AS name, 'XX ' || CASE WHEN pupils IS NULL THEN 'Municipal' ELSE 'County' END AS segment, coalesce(area, '') AS county, coalesce(homepage, '') AS website,
'Census 2022 ' || CASE WHEN pupils IS NULL THEN 'Municipal' ELSE 'County, pop ' || pupils END AS manual_notes FROM registry_units WHERE school_year IS NOT NULL),
sp AS (SELECT 1 AS o, 'COG-' || s_suppkey AS body_id, s_name AS name, 'NY Special District - ' || CASE WHEN s_acctbal > 0 THEN 'Library' ELSE 'Other' END AS segment, '' AS county, '' AS website, 'Census 2022 Special District - ' || CASE WHEN s_acctbal > 0 THEN 'Library' ELSE 'Other' END AS manual_notes FROM supplier),
u AS (SELECT *, row_number() OVER (PARTITION BY body_id ORDER BY o, name) AS n FROM (SELECT * FROM g UNION ALL SELECT * FROM sp)), c AS (SELECT body_id, name, segment, county, website, 0 AS coverage_level, manual_notes FROM u WHERE n = 1)"""


@query(f"WITH {_SHEETS} SELECT * FROM c")
def census_bodies(spark: SparkSession, folder: str) -> DataFrame:
    return registry.census_bodies(_sheets(spark, folder))


@query(f"WITH {_SHEETS} SELECT segment, count(*) AS rows FROM c GROUP BY segment ORDER BY rows DESC, segment LIMIT 25")
def top_segments(spark: SparkSession, folder: str) -> DataFrame:
    """The 25 commonest are what the report shows."""
    return registry.most_frequent(registry.census_bodies(_sheets(spark, folder)), "segment")


@query("SELECT 'General Purpose' AS sheet, count(*) AS units, count(*) FILTER (WHERE coalesce(homepage, '') <> '') AS with_website FROM registry_units WHERE school_year IS NOT NULL UNION ALL SELECT 'Special District', count(*), 0 FROM supplier")
def sheet_counts(spark: SparkSession, folder: str) -> DataFrame:
    return registry.sheet_counts(_sheets(spark, folder))


_FACTS = [("roof at a school", "school", ["roof"], 2), ("boiler or chiller", "district", ["boiler", "chiller"], 1), ("lintel at a library", "library", ["lintel"], 3), ("nothing", "nobody at all", ["zeppelin"], 1)]


@query("WITH f AS (SELECT * FROM (VALUES " + ", ".join(f"('{n}', '{b}', {k}, {m})" for n, b, k, m in _FACTS) + f""") v(fact, part, ks, least)), s AS (SELECT lower(b.name) AS body, lower(coalesce(scope_summary, '')) AS sc, lower(coalesce(evidence_quote, '')) AS q FROM {_OWNED} WHERE is_signal AND d.in_window),
h AS (SELECT fact, contains(body, part) AS own FROM f JOIN s ON len(list_filter(ks, lambda k: contains(sc, k) OR contains(q, k))) > 0), n AS (SELECT fact, count(*) FILTER (WHERE own) AS found, count(*) FILTER (WHERE NOT own) AS elsewhere FROM h GROUP BY fact)
SELECT fact, coalesce(found, 0) AS found, least AS wanted, coalesce(elsewhere, 0) AS elsewhere, coalesce(found, 0) >= least AS passed FROM f LEFT JOIN n USING (fact)""")
def expected_facts(spark: SparkSession, folder: str) -> DataFrame:
    signals, documents, bodies = _t(spark, folder, "signals", "documents", "bodies")
    facts = spark.createDataFrame(_FACTS, "fact string, body string, keywords array<string>, least int")
    return registry.expected_facts(reports.owned_signals(signals, documents, bodies).where("in_window"), facts)

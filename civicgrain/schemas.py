"""Schemas of the pipeline's tables, and bringing frames into them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DateType, DecimalType, IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType

_TYPES = {
    "string": StringType(), "int": IntegerType(), "bigint": LongType(), "boolean": BooleanType(), "date": DateType(), "timestamp_ntz": TimestampNTZType(), "array<string>": ArrayType(StringType()),
    "decimal(38,2)": DecimalType(38, 2), "decimal(5,4)": DecimalType(5, 4),
}


def _schema(columns: str) -> StructType:
    """A schema from "name type [not null]" parts; no session is needed for it."""
    parts = [c.split(" ", 2) for c in columns.replace(", ", "\n").split("\n")]
    return StructType([StructField(p[0], _TYPES[p[1]], len(p) < 3) for p in parts])


TABLES: dict[str, StructType] = {
    "bodies": _schema(
        "body_id string not null, name string not null, segment string, county string, website string, board_page_url string, platform string, coverage_level int, blocker_code string, "
        "enrollment int, expected_per_year int, own_site_doc_links int, last_checked timestamp_ntz, last_success timestamp_ntz, manual_notes string"
    ),
    "meeting_calendar": _schema("meeting_id int, body_id string not null, meeting_date date not null, meeting_type string, title string"),
    "documents": _schema(
        "doc_id bigint, body_id string, meeting_id int, doc_type string, source_url string not null, link_text string, meeting_date date, in_window boolean, file_path string, sha256 string, "
        "bytes int, pages int, text string, text_method string, fetched_at timestamp_ntz, status string, error string"
    ),
    "keyword_hits": _schema("hit_id string, doc_id bigint not null, passage_index int not null, passage_text string not null, trades array<string>, stages array<string>, triggers array<string>"),
    "signals": _schema(
        "signal_id int, document_id int not null, project_id int, passage_index int, is_signal boolean not null, trades array<string>, stage string, stage_evidence string, stage_verified boolean, "
        "low_value boolean, building string, scope_summary string, dollar_amount decimal(38,2), amount_from_ocr boolean, funding_source string, key_dates string, vendors_named string, "
        "evidence_quote string, page_or_item string, confidence decimal(5,4), model string, created_at timestamp_ntz"
    ),
    "projects": _schema("project_id int, body_id string not null, building string, scope_summary string, first_signal_date date, last_signal_date date, latest_stage string, signal_count int, created_at timestamp_ntz"),
    "llm_runs": _schema("run_id int, document_id int not null, model string not null, input_tokens int not null, output_tokens int not null, created_at timestamp_ntz"),
    "coverage_log": _schema("id int, body_id string not null, old_level int, new_level int, blocker_code string, note string, changed_at timestamp_ntz"),
}
# What the columns of limited vocabularies may hold.
ALLOWED = {
    "documents.status": ("new", "fetched", "extracted", "scanned", "classified", "error"),
    "documents.doc_type": ("agenda", "committee_agenda", "minutes", "packet", "other"),
    "documents.text_method": ("native", "ocr"),
}


def conformed(frame: DataFrame, table: str) -> DataFrame:
    """The frame with exactly the table's columns: missing ones null, others cast leniently (what can't be cast is null), further ones left out."""
    have = {c.lower() for c in frame.columns}

    def column(field) -> Column:
        if field.name.lower() not in have:
            return F.lit(None).cast(field.dataType).alias(field.name)
        known = frame.schema[next(c for c in frame.columns if c.lower() == field.name.lower())].dataType
        c = F.col(f"`{field.name}`")
        return (c if known == field.dataType else c.try_cast(field.dataType)).alias(field.name)

    return frame.select(*(column(f) for f in TABLES[table].fields))


def with_columns_if_missing(frame: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The frame with each named column, null and of the given type where it lacked it. Names are compared without regard to case."""
    have = {c.lower() for c in frame.columns}
    return frame.select("*", *(F.lit(None).cast(t).alias(c) for c, t in columns.items() if c.lower() not in have))


def violations(frame: DataFrame, table: str) -> DataFrame:
    """(rule, rows): rows that miss a required value or hold one that isn't allowed, for each rule that is broken."""
    rules = [(f"{f.name} is required", F.col(f.name).isNull()) for f in TABLES[table].fields if not f.nullable and f.name in frame.columns]
    rules += [(f"{name.split('.')[1]} is not allowed", F.col(name.split(".")[1]).isNotNull() & ~F.col(name.split(".")[1]).isin(*values)) for name, values in ALLOWED.items() if name.startswith(table + ".") and name.split(".")[1] in frame.columns]
    if not rules:
        return frame.sparkSession.createDataFrame([], "rule string, rows long")
    counted = frame.agg(*(F.count_if(broken).alias(f"r{i}") for i, (_, broken) in enumerate(rules)))
    each = F.explode(F.array(*(F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("rows")) for i, (name, _) in enumerate(rules))))
    return counted.select(each.alias("x")).select("x.*").where("rows > 0")

"""Files as sources and sinks: CSV of bodies, folders of texts, binary documents, pages of links."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_INTEGERS = ("coverage_level", "enrollment", "expected_per_year", "own_site_doc_links")
_TIMES = ("last_checked", "last_success")


def read_bodies_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with a header, all columns text; blanks become null, numbers and times are read leniently."""
    raw = spark.read.csv(path, header=True, inferSchema=False)
    filled = raw.select(*(F.when(F.trim(F.col(f"`{c}`")) != "", F.col(f"`{c}`")).alias(c) for c in raw.columns))
    for c in filled.columns:
        if c in _INTEGERS:
            filled = filled.withColumn(c, F.trim(c).try_cast("int"))
        elif c in _TIMES:
            filled = filled.withColumn(c, F.coalesce(F.try_to_timestamp(c), F.try_to_timestamp(c, F.lit("yyyy-MM-dd"))).cast("timestamp_ntz"))
    return filled


def read_texts(spark: SparkSession, folder: str) -> DataFrame:
    """(path, name, text) of every .txt of a folder, in order of their names; bytes that are no UTF-8 become replacement characters."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(folder).select("path", "content")
    return raw.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), _decoded("content").alias("text")).orderBy("name", "path")


def _decoded(content: str) -> Column:
    """Lenient decoding has no built-in that is safe from session settings; the bytes come in Arrow batches."""

    @F.pandas_udf(StringType())
    def decode(b: pd.Series) -> pd.Series:
        return b.map(lambda x: bytes(x).decode("utf-8", "replace"))

    return decode(content)


def write_hits(passages: DataFrame, path: str) -> None:
    """Passages as JSON lines, by document and number."""
    passages.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "passage_index").write.mode("overwrite").json(path)


def read_binary(spark: SparkSession, folder: str, extract: Callable[[bytes], tuple[str, int]]) -> DataFrame:
    """(path, sha256, bytes, text, pages, needs_ocr) by an injected extractor of text and page count."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = [extract(c) for c in batch.content]
            yield pd.DataFrame({"path": batch.path, "sha256": batch.sha256, "bytes": batch.bytes, "text": [t for t, _ in got], "pages": [p for _, p in got]})

    raw = spark.read.format("binaryFile").load(folder).select("path", "content", F.sha2("content", 256).alias("sha256"), F.length("content").alias("bytes"))
    return needs_ocr(raw.mapInPandas(run, "path string, sha256 string, bytes int, text string, pages int"))


def needs_ocr(rows: DataFrame, least: int = 100) -> DataFrame:
    """With ``needs_ocr``: fewer than that many characters a page; no pages or no text count as none."""
    density = F.coalesce(F.try_divide(F.length(F.coalesce("text", F.lit(""))), F.col("pages")), F.lit(0))
    return rows.withColumn("needs_ocr", density < least)


class _Anchors(HTMLParser):
    def __init__(self) -> None:
        super().__init__()
        self.links: list[list[str]] = []
        self.open = False

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            a = dict(attrs)
            self.open = bool(a.get("href"))
            if self.open:
                self.links.append([a["href"], "", a.get("title") or ""])

    def handle_data(self, data):
        if self.open:
            self.links[-1][1] += data

    def handle_endtag(self, tag):
        if tag == "a":
            self.open = False


def pdf_links(pages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """(url, source_url, link_text, link_order) of every anchor to a .pdf, with the page's columns ``keep``; the text, else the title, else the file's name."""
    kept = keep or []
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in pages.select(*kept).schema.fields) + "url string, source_url string, link_text string, link_order int"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for url, html, *own in zip(batch.url, batch.html, *(batch[c] for c in kept)):
                reader = _Anchors()
                reader.feed(html or "")
                for k, (href, text, title) in enumerate(reader.links):
                    if href.lower().endswith(".pdf"):
                        rows.append((*own, url, urljoin(url, href), " ".join(text.split()) or title or href.rsplit("/", 1)[-1], k))
            yield pd.DataFrame(rows, columns=[*kept, "url", "source_url", "link_text", "link_order"])

    return pages.select("url", "html", *kept).where("url is not null").mapInPandas(run, schema)


def write_csv(frame: DataFrame, path: str) -> bool:
    """One CSV with a header; nothing is written when there are no rows."""
    if frame.isEmpty():
        return False
    frame.coalesce(1).write.mode("overwrite").csv(path, header=True)
    return True

"""Finding documents on pages: links, hosts and platforms, robots rules, and adapters that turn pages into document links.

Fetching is left to the caller: a page is a row (url, html), a robots file a row (host, status, text).
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Callable, Iterator
from urllib.robotparser import RobotFileParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicgrain.functions.dates import meeting_date
from civicgrain.functions.text import doc_type
from civicgrain.functions.timestamps import let
from civicgrain.sources.files import pdf_links

# Platforms that publish agendas, and systems that sites are made with, by what stands in their pages.
PLATFORMS = {
    "BoardDocs": r"boarddocs\.com", "Legistar": r"legistar\.com", "BoardBook": r"boardbook\.org", "Simbli": r"simbli\.eboardsolutions|eboardsolutions\.com", "CivicClerk/CivicPlus": "civicclerk|civicplus|agendacenter",
    "Granicus": r"granicus\.com", "Diligent Community": r"diligent\.community|community\.diligentoneplatform", "BoardOnTrack": r"boardontrack\.com", "Sparq": r"sparqdata|meetings\.sparq",
    "Google Drive/Docs": r"drive\.google\.com|docs\.google\.com", "YouTube": r"youtube\.com|youtu\.be",
}
SITE_SYSTEMS = {
    "Finalsite": r"finalsite|fsPageLayout|resources\.finalsite", "Edlio": "edlio", "Blackboard/SchoolWires": r"schoolwires|blackboard|/site/Default\.aspx|/cms/lib", "Apptegy/Thrillshare": "apptegy|thrillshare",
    "SchoolMessenger": "schoolmessenger|/pages/", "ParentSquare/Smore": "parentsquare",
}
GENERAL = ("Google Drive/Docs", "YouTube")  # hosts of all kinds of things: no sign of a platform in a single link
# Hosts that nothing is fetched from.
BLOCKED_HOSTS = ("go.boarddocs.com", "files.smartsites.parentsquare.com")
AGENT = "records-engine"
# Addresses that are no pages, and words in those of meetings, boards and their documents.
HREF = r"""(?i)href\s*=\s*["']([^"']+)["']"""
NO_PAGE = r"(?i)\.(?:pdf|jpe?g|png|docx?|xlsx?)(?:$|\?)|keyboard|dashboard|onboard|^mailto:|^javascript:|#"
MEETING_PAGE, BOARD_PAGE = "(?i)agenda|minutes|meeting", r"(?i)board|boe\b|trustee"
DOCUMENT_LINK, MEETING_LINK = r"(?i)\.pdf|getfile|documentcenter|resource-manager|/files/|drive\.google", "(?i)agenda|minute|meeting|boe|board"


def fingerprints(html: Column, signs: dict[str, str]) -> Column:
    """Sorted names of the signs that stand in a page, whatever the case; none in a null."""
    return F.array_compact(F.array(*(F.when(F.coalesce(html, F.lit("")).rlike("(?i)" + p), F.lit(n)) for n, p in sorted(signs.items()))))


def absolute(link: Column, page: Column) -> Column:
    """A link made whole by the address of its page: full ones as they are, those from the host, the scheme or the folder on."""
    base = F.regexp_extract(page, "^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    folder = F.regexp_replace(F.regexp_replace(page, "[?#].*$", ""), "(?<=[^/])/[^/]*$", "")
    whole = F.when(link.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), link).when(link.startswith("//"), F.concat(F.regexp_extract(page, "^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1), link))
    return whole.when(link.startswith("/"), F.concat(base, link)).otherwise(F.concat(folder, F.lit("/"), link))


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), "^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]*)", 1))


def links_of(html: Column) -> Column:
    """The distinct link targets of a page, in order."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(HREF), F.lit(1)))


def page_links(pages: DataFrame) -> DataFrame:
    """(url, link) of the links of each page to pages of its own host that look like a board's, no files among them."""
    rows = pages.select("url", F.explode(links_of(F.col("html"))).alias("target")).where(~F.col("target").rlike(NO_PAGE))
    rows = rows.select("url", absolute(F.col("target"), F.col("url")).alias("link")).where(host_of(F.col("link")) == host_of(F.col("url")))
    return rows.where(F.col("link").rlike(BOARD_PAGE) | F.col("link").rlike(MEETING_PAGE)).distinct()


def ranked_links(links: DataFrame, most: int = 4) -> DataFrame:
    """(url, link, place) of the ``most`` likeliest links of a page: those that name a meeting first, then the shorter ones, then by address.

    The first of each of 64 salts are taken before those of all of them, so a page of very many links is no single task.
    """
    from pyspark.sql import Window

    keyed = links.select("url", "link", F.when(F.col("link").rlike(MEETING_PAGE), 0).otherwise(1).alias("k"), F.length("link").alias("n"), F.pmod(F.xxhash64("link"), F.lit(64)).alias("salt"))
    by = lambda *c: F.row_number().over(Window.partitionBy(*c).orderBy("k", "n", "link"))
    return keyed.withColumn("place", by("url", "salt")).where(F.col("place") <= most).withColumn("place", by("url")).where(F.col("place") <= most).select("url", "link", "place")


def site_profile(pages: DataFrame, site: Column | None = None) -> DataFrame:
    """(site, platforms, systems, platform_links, document_links, pages): what the pages of a site (their host unless given) show together.

    Platforms of all pages are united; ``platform_links`` are links to one, ``document_links`` counts links to files about meetings.
    """
    specific = "(?i)" + "|".join(p for n, p in PLATFORMS.items() if n not in GENERAL)
    links = links_of(F.col("html"))
    rows = pages.select(
        (host_of(F.col("url")) if site is None else site).alias("site"), fingerprints(F.col("html"), PLATFORMS).alias("p"), fingerprints(F.col("html"), SITE_SYSTEMS).alias("s"), F.filter(links, lambda x: x.rlike(specific)).alias("l"),
        F.size(F.filter(links, lambda x: x.rlike(DOCUMENT_LINK) & x.rlike(MEETING_LINK))).alias("d"),
    )
    united = lambda c: F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set(c)))), ";")
    return rows.groupBy("site").agg(united("p").alias("platforms"), united("s").alias("systems"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("l")))).alias("platform_links"), F.sum("d").alias("document_links"), F.count("*").alias("pages"))


def unresolved(profiles: DataFrame, platforms: str = "(?i)boarddocs|diligent|google drive") -> DataFrame:
    """The sites whose pages were read but show neither a platform of their own nor a document: the next pass takes them."""
    return profiles.where((F.col("status") == "200") & ~F.coalesce("platforms", F.lit("")).rlike(platforms) & (F.coalesce(F.col("document_links").try_cast("int"), F.lit(0)) <= 0))


def address_variants(site: Column) -> Column:
    """The addresses a homepage may have: both schemes, the host as given, without and with www., each once in that order."""
    host = F.regexp_extract(F.regexp_replace(F.coalesce(site, F.lit("")), "^https?://", ""), "^([^/?#]*)", 1)
    bare = F.regexp_replace(host, r"^www\.", "")
    made = lambda h: F.array_distinct(F.flatten(F.array(*(F.array(*(F.concat(F.lit(f"{s}://"), x, F.lit("/")) for x in (h["h"], h["b"], F.concat(F.lit("www."), h["b"])))) for s in ("https", "http")))))
    return F.when(host != "", let(F.struct(host.alias("h"), bare.alias("b")), made))


def drive_id(url: Column, kind: str) -> Column:
    """The id of a Drive ``folder`` or ``file``: from the path, else the id parameter; null for other hosts."""
    path = {"folder": "/folders/([A-Za-z0-9_-]+)", "file": "/file/d/([A-Za-z0-9_-]+)"}[kind]
    before = F.regexp_replace(url, "[?#].*$", "")
    found = F.coalesce(F.nullif(F.regexp_extract(before, path, 1), F.lit("")), F.nullif(F.regexp_extract(url, "[?&]id=([^&#]+)", 1), F.lit("")))
    return F.when(host_of(url).contains("drive.google.com"), found)


def crawl_delay(text: str, agent: str = AGENT) -> float | None:
    """Seconds between two requests by a robots file: those for the agent, else those for all; the last value stated counts."""
    own = general = None
    section = ""
    for line in (x.strip() for x in (text or "").splitlines()):
        name, _, value = line.partition(":")
        name, value = name.strip().lower(), value.strip().lower()
        if name == "user-agent":
            section = "own" if agent.lower() in value else "all" if value == "*" else ""
        elif name == "crawl-delay" and section:
            try:
                seconds = float(value)
            except ValueError:
                continue
            if section == "own":
                own = seconds
            elif own is None:
                general = seconds
    return general if own is None else own


def robots_decisions(urls: DataFrame, robots: DataFrame, agent: str = AGENT) -> DataFrame:
    """The rows of ``urls`` (with ``url``) with ``allowed`` and ``delay`` by the robots file of their host (host, status, text).

    A server error forbids all, a missing or unreachable file (status null, 4xx, no row) forbids nothing.
    A file is read once for all addresses of its host in a batch.
    """
    rows = urls.withColumn("_host", host_of(F.col("url"))).join(robots.select(F.lower("host").alias("_host"), F.col("status").alias("_status"), F.col("text").alias("_text")), "_host", "left")
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in urls.schema.fields)}, allowed boolean, delay double"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            read: dict[str, tuple[RobotFileParser, float | None]] = {}
            allowed, delay = [], []
            for url, host, status, text in zip(batch.url, batch._host, batch._status, batch._text):
                code = None if pd.isna(status) else int(status)
                if host not in read:
                    rules = RobotFileParser()
                    stated = text if code is not None and code < 400 and text else ""
                    rules.parse(stated.splitlines())
                    read[host] = rules, crawl_delay(stated, agent)
                allowed.append(False if code is not None and code >= 500 else bool(url) and read[host][0].can_fetch(agent, url))
                delay.append(read[host][1])
            yield batch.drop(columns=["_host", "_status", "_text"]).assign(allowed=allowed, delay=pd.Series(delay, dtype="float64", index=batch.index))

    return rows.select(*urls.columns, "_host", "_status", "_text").mapInPandas(run, schema)


def within_backfill(links: DataFrame, start: str | Column) -> DataFrame:
    """The links without a date, and those dated on ``start`` or later."""
    return links.where(F.col("meeting_date").isNull() | (F.col("meeting_date") >= (F.lit(start).cast("date") if isinstance(start, str) else start)))


def not_blocked(rows: DataFrame, url: str = "source_url", hosts: tuple[str, ...] = BLOCKED_HOSTS) -> DataFrame:
    """The rows whose host isn't exactly one of the blocked ones."""
    return rows.where(~host_of(F.col(url)).isin(*hosts))


def file_hosts(pages: DataFrame, robots: DataFrame | None = None, hosts: tuple[str, ...] = BLOCKED_HOSTS) -> DataFrame:
    """(body_id, host, links): where the PDF files lie that a body's pages link to. Pages of blocked hosts, and those robots files forbid, aren't read."""
    rows = not_blocked(pages, "url", hosts)
    if robots is not None:
        rows = robots_decisions(rows, robots).where("allowed")
    found = rows.select("body_id", "url", F.explode(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(HREF), F.lit(1))).alias("target")).where(F.lower("target").contains(".pdf"))
    return found.groupBy("body_id", host_of(absolute(F.col("target"), F.col("url"))).alias("host")).agg(F.count("*").alias("links"))


class Adapter(ABC):
    """Turns the pages of bodies into document links: (body_id, source_url, link_text, meeting_date, doc_type, meeting_type, page_order, link_order)."""

    @abstractmethod
    def list_documents(self, pages: DataFrame) -> DataFrame:
        """``pages`` is (body_id, page_order, url, html)."""


def _described(links: DataFrame, start: str | None) -> DataFrame:
    kind = doc_type(F.col("link_text"), F.col("source_url"))
    rows = links.withColumn("meeting_date", meeting_date(F.col("link_text"), F.col("source_url"))).withColumn("k", kind)
    rows = rows.select("body_id", "source_url", "link_text", "meeting_date", F.col("k.doc_type").alias("doc_type"), F.col("k.meeting_type").alias("meeting_type"), "page_order", "link_order")
    return rows if start is None else within_backfill(rows, start)


class PdfLinks(Adapter):
    """Anchors to .pdf files; of one address of a body the first counts. Undated documents and those from ``start`` on are kept."""

    def __init__(self, start: str | None = None) -> None:
        self.start = start

    def list_documents(self, pages: DataFrame) -> DataFrame:
        found = pdf_links(pages.where("html is not null"), keep=["body_id", "page_order"])
        first = found.groupBy("body_id", "source_url").agg(F.min_by(F.struct("link_text", "page_order", "link_order"), F.struct("page_order", "link_order")).alias("f"))
        return _described(first.select("body_id", "source_url", "f.*"), self.start)


class DriveFolders(Adapter):
    """Files of Drive folders by an injected lister: folder id -> [(file id, name, link)]. A folder that can't be listed gives nothing and stops no other."""

    def __init__(self, lister: Callable[[str], list[tuple[str, str, str]]], start: str | None = None) -> None:
        self.lister, self.start = lister, start

    def list_documents(self, pages: DataFrame) -> DataFrame:
        """Here ``url`` is the folder's address and html isn't read."""
        lister = self.lister

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                rows = []
                for body, order, folder in zip(batch.body_id, batch.page_order, batch.folder):
                    try:
                        files = list(lister(folder))
                    except Exception:  # noqa: BLE001 - whatever the lister raises concerns this folder only
                        files = []
                    rows += [(body, link or f"https://drive.google.com/file/d/{key}/view", name, order, k) for k, (key, name, link) in enumerate(files)]
                yield pd.DataFrame(rows, columns=["body_id", "source_url", "link_text", "page_order", "link_order"])

        folders = pages.select("body_id", "page_order", drive_id(F.col("url"), "folder").alias("folder")).where("folder is not null").distinct()
        found = folders.mapInPandas(run, "body_id string, source_url string, link_text string, page_order int, link_order int")
        first = found.groupBy("body_id", "source_url").agg(F.min_by(F.struct("link_text", "page_order", "link_order"), F.struct("page_order", "link_order")).alias("f"))
        return _described(first.select("body_id", "source_url", "f.*"), self.start)

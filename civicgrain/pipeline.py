"""The stages of the pipeline over stored tables: load, discover, fetch, extract, scan, classify, report.

Tables are versions of Parquet folders; a stage reads the latest ones, makes new snapshots and stores
them, so a stage that is run again finds nothing left to do and adds nothing. Fetching, extraction and
the model are injected callables that run in the executors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from datetime import datetime
from hashlib import sha256

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicgrain.functions.dates import in_window

from civicgrain.operators import classify as model_stage
from civicgrain.operators import discovery, lifecycle, projects, reports, scan
from civicgrain.operators.tables import insert_absent, numbered, upsert, written
from civicgrain.schemas import TABLES, conformed
from civicgrain.sources.files import needs_ocr, read_bodies_csv, write_csv


class Store:
    """Tables of a folder. A new version is written beside the old one and counts once it is complete."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self._files = spark._jvm.org.apache.hadoop.fs

    def _system(self):
        return self._files.Path(self.folder).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self, table: str) -> list[str]:
        system, place = self._system(), self._files.Path(f"{self.folder}/{table}")
        names = [s.getPath().getName() for s in system.listStatus(place)] if system.exists(place) else []
        return sorted(n for n in names if n.startswith("v") and system.exists(self._files.Path(f"{self.folder}/{table}/{n}/_SUCCESS")))

    def read(self, table: str) -> DataFrame:
        """The latest version; without one, no rows."""
        versions = self.versions(table)
        if not versions:
            return self.spark.createDataFrame([], TABLES[table])
        return self.spark.read.schema(TABLES[table]).parquet(f"{self.folder}/{table}/{versions[-1]}")

    def write(self, table: str, rows: DataFrame, keep: int = 2) -> None:
        versions = self.versions(table)
        number = int(versions[-1][1:]) + 1 if versions else 1
        conformed(rows, table).write.mode("overwrite").parquet(f"{self.folder}/{table}/v{number:08d}")
        for old in versions[: 1 - keep or None]:
            self._system().delete(self._files.Path(f"{self.folder}/{table}/{old}"), True)


@dataclass
class Pipeline:
    """Stages over a store. ``get(url)`` gives bytes; ``save(name, bytes)`` gives the path; ``extract(path)`` and ``ocr(path)`` give (text, pages);
    ``model(chunk)`` and ``retry(chunk)`` give an answer. ``as_of`` is the day the window of a year ends."""

    store: Store
    as_of: str
    words: scan.Vocabulary = field(default_factory=scan.Vocabulary)
    prices: dict[str, tuple[float, float]] = field(default_factory=dict)
    cap: float = 5.0
    now: str | None = None

    def _now(self):
        return F.lit(self.now or datetime.now().isoformat(sep=" ", timespec="seconds")).cast("timestamp_ntz")

    def initialise(self) -> list[str]:
        """Stores an empty table for each that there is none of; their names."""
        missing = [t for t in TABLES if not self.store.versions(t)]
        for t in missing:
            self.store.write(t, self.store.read(t))
        return missing

    def load_bodies(self, path: str) -> int:
        """Bodies of a CSV put in, or in place of those of the same id; of rows of one id the last by all their columns counts."""
        new = conformed(read_bodies_csv(self.store.spark, path), "bodies").where("body_id is not null and name is not null")
        order = F.struct(*(F.col(c) for c in new.columns))
        self.store.write("bodies", upsert(self.store.read("bodies"), new, ["body_id"], order))
        return new.select("body_id").distinct().count()

    def _levels(self, reached: DataFrame) -> None:
        changes = written(lifecycle.levels_after(self.store.read("bodies"), reached))
        if not changes.isEmpty():
            bodies, log = lifecycle.log_levels(self.store.read("bodies"), self.store.read("coverage_log"), changes, self._now())
            self.store.write("bodies", bodies)
            self.store.write("coverage_log", log)

    def discover(self, pages: DataFrame, adapters: list[discovery.Adapter] | None = None) -> int:
        """Documents linked from pages (body_id, page_order, url, html) that aren't known yet; their bodies reach level 4, their days enter the calendar."""
        start = F.add_months(F.lit(self.as_of).cast("date"), -12).cast("string")
        found = None
        for adapter in adapters or [discovery.PdfLinks(self.store.spark.range(1).select(start).first()[0])]:
            some = adapter.list_documents(pages)
            found = some if found is None else found.unionByName(some)
        found = written(found)
        old = self.store.read("documents")
        new = lifecycle.new_documents(old, found)
        last = old.agg(F.coalesce(F.max("doc_id"), F.lit(0)).alias("last"))
        rows = numbered(new, [F.col("body_id"), F.col("page_order"), F.col("link_order"), F.col("source_url")], "n").crossJoin(F.broadcast(last))  # one row
        rows = written(rows.withColumn("doc_id", F.col("last") + F.col("n")).withColumn("in_window", in_window(F.col("meeting_date"), self.as_of)))
        calendar = self.store.read("meeting_calendar")
        days = found.where("meeting_date is not null").select("body_id", "meeting_date", "meeting_type").distinct()
        have = calendar.select("body_id", "meeting_date", F.coalesce("meeting_type", F.lit("regular")).alias("meeting_type"))
        meetings = insert_absent(have, days, ["body_id", "meeting_date", "meeting_type"], F.lit(0))
        top = calendar.agg(F.coalesce(F.max("meeting_id"), F.lit(0)).alias("last"))
        made = numbered(meetings, [F.col(c) for c in ("body_id", "meeting_date", "meeting_type")], "n").crossJoin(F.broadcast(top)).withColumn("meeting_id", (F.col("last") + F.col("n")).cast("int"))
        self.store.write("meeting_calendar", calendar.unionByName(conformed(made, "meeting_calendar")))
        self.store.write("documents", old.unionByName(conformed(rows, "documents")))
        self._levels(found.select("body_id", F.lit(4).alias("level"), F.lit("documents discovered").alias("note")).distinct())
        return rows.count()

    def _update(self, updates: DataFrame) -> int:
        updates = written(updates)
        self.store.write("documents", lifecycle.with_updates(self.store.read("documents"), updates, "doc_id"))
        return updates.count()

    def fetch(self, get: Callable[[str], bytes], save: Callable[[str, bytes], str], robots: DataFrame | None = None) -> int:
        """New documents fetched and stored. A file there already under its hash isn't stored again; what can't be fetched gets the status error."""
        todo = self.store.read("documents").where("status = 'new'").select("doc_id", "body_id", F.col("source_url").alias("url"))
        allowed = discovery.robots_decisions(todo, robots).drop("delay") if robots is not None else todo.withColumn("allowed", F.lit(True))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                rows = []
                for key, body, url, ok in zip(batch.doc_id, batch.body_id, batch.url, batch.allowed):
                    if not ok:
                        rows.append((key, None, None, None, "error", "Blocked by robots.txt"))
                        continue
                    try:
                        content = get(url)
                    except Exception as e:  # noqa: BLE001 - one document's failure is its status
                        rows.append((key, None, None, None, "error", str(e)[:500]))
                        continue
                    digest = sha256(content).hexdigest()
                    rows.append((key, save(f"{body}/{digest}", content), digest, len(content), "fetched", None))
                yield pd.DataFrame(rows, columns=["doc_id", "file_path", "sha256", "bytes", "status", "error"])

        got = written(allowed.mapInPandas(run, "doc_id long, file_path string, sha256 string, bytes int, status string, error string").withColumn("fetched_at", F.when(F.col("status") == "fetched", self._now())))
        # of documents with one content the path of the first stands for all, those fetched earlier before those fetched now
        known = self.store.read("documents").where("sha256 is not null and file_path is not null").select("sha256", "file_path", "doc_id", F.lit(0).alias("late")).unionByName(got.where("sha256 is not null").select("sha256", "file_path", "doc_id", F.lit(1).alias("late")))
        owner = known.groupBy("sha256").agg(F.min_by("file_path", F.struct("late", "doc_id")).alias("owned"))
        done = self._update(got.join(owner, "sha256", "left").withColumn("file_path", F.coalesce("owned", "file_path")).drop("owned"))
        held = self.store.read("documents").where("status not in ('new', 'error')").select("body_id").distinct()
        self._levels(held.select("body_id", F.lit(5).alias("level"), F.lit("documents fetched").alias("note")))
        return done

    def extract(self, extract: Callable[[str], tuple[str, int]], ocr: Callable[[str], tuple[str, int]] | None = None) -> int:
        """Texts of fetched documents; where there are fewer than 100 characters a page, by ``ocr`` if given."""
        todo = self.store.read("documents").where("status = 'fetched' and file_path is not null").select("doc_id", "file_path")

        def reader(read: Callable[[str], tuple[str, int]], method: str) -> Callable:
            def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                for batch in batches:
                    rows = []
                    for key, path in zip(batch.doc_id, batch.file_path):
                        try:
                            text, pages = read(path)
                            rows.append((key, path, text, pages, method, "extracted", None))
                        except Exception as e:  # noqa: BLE001 - one document's failure is its status
                            rows.append((key, path, None, None, None, "error", str(e)[:500]))
                    yield pd.DataFrame(rows, columns=["doc_id", "file_path", "text", "pages", "text_method", "status", "error"]).astype({"pages": "Int32"})

            return run

        shape = "doc_id long, file_path string, text string, pages int, text_method string, status string, error string"
        native = written(needs_ocr(todo.mapInPandas(reader(extract, "native"), shape)))
        if ocr is None:
            return self._update(native.drop("needs_ocr", "file_path"))
        thin = (F.col("status") == "extracted") & F.col("needs_ocr")
        scanned = native.where(thin).select("doc_id", "file_path").mapInPandas(reader(ocr, "ocr"), shape)
        return self._update(native.where(~thin).drop("needs_ocr").unionByName(scanned).drop("file_path"))

    def scan(self) -> int:
        """Keyword passages of extracted documents, in place of any they had."""
        todo = self.store.read("documents").where("status = 'extracted'")
        done = written(todo.select("doc_id"))
        rows = scan.keyword_passages(todo, self.words).withColumn("hit_id", F.concat_ws("-", "doc_id", "passage_index"))
        hits = self.store.read("keyword_hits")
        self.store.write("keyword_hits", lifecycle.replaced(hits, conformed(rows, "keyword_hits"), done, "doc_id"))
        return self._update(done.withColumn("status", F.lit("scanned")))

    def classify(self, model: Callable[[str], str], name: str, retry: Callable[[str], str] | None = None, ids: list[int] | None = None, everything: bool = False) -> int:
        """Signals of the selected documents by the model, in order of id, up to the one that crosses what is left of the day's cap.

        Tokens are taken as a quarter of the characters sent and answered.
        """
        day = F.to_date(self._now())
        runs = self.store.read("llm_runs")
        spent = runs.where(F.to_date("created_at") == day).agg(F.coalesce(F.sum(model_stage.run_cost(self.prices)), F.lit(0.0)).alias("spent"))
        todo = written(model_stage.to_classify(self.store.read("documents"), ids, everything))
        ahead = todo.select("doc_id", F.lit(name).alias("model"), F.ceil(F.length("text") / 4).cast("int").alias("input_tokens"), F.lit(0).alias("output_tokens"))
        take = written(model_stage.running_prefix(ahead.withColumn("cost", model_stage.run_cost(self.prices)), spent, self.cap))
        chosen = todo.join(take.select("doc_id"), "doc_id", "left_semi")
        found = written(model_stage.classify(chosen, model, retry=retry))
        signals = self.store.read("signals")
        last = signals.agg(F.coalesce(F.max("signal_id"), F.lit(0)).alias("last"))
        new = numbered(found.withColumn("document_id", F.col("doc_id").cast("int")), [F.col("doc_id"), F.col("passage_index"), F.col("scope_summary"), F.col("evidence_quote")], "n").crossJoin(F.broadcast(last))
        new = new.withColumn("signal_id", (F.col("last") + F.col("n")).cast("int")).withColumn("model", F.lit(name)).withColumn("created_at", self._now())
        done = written(chosen.select("doc_id"))
        self.store.write("signals", lifecycle.replaced(signals, conformed(new, "signals"), done.select(F.col("doc_id").cast("int").alias("document_id")), "document_id"))
        first = runs.agg(F.coalesce(F.max("run_id"), F.lit(0)).alias("last"))
        spent_now = numbered(take.select("doc_id", "model", "input_tokens", "output_tokens"), [F.col("doc_id")], "n").crossJoin(F.broadcast(first))
        rows = spent_now.select((F.col("last") + F.col("n")).cast("int").alias("run_id"), F.col("doc_id").cast("int").alias("document_id"), "model", "input_tokens", "output_tokens", self._now().alias("created_at"))
        self.store.write("llm_runs", runs.unionByName(conformed(rows, "llm_runs")))
        return self._update(done.withColumn("status", F.lit("classified")))

    def rebuild_projects(self) -> DataFrame:
        made, linked = projects.rebuilt(self.store.read("signals"), self.store.read("documents"))
        self.store.write("projects", made.withColumn("created_at", self._now()))
        self.store.write("signals", linked)
        return projects.project_stats(self.store.read("projects"))

    def report(self, folder: str) -> list[str]:
        """Coverage and calibration as Markdown, signals, projects, the trend and repeated scopes as CSV; a CSV without rows isn't written. The names of what was."""
        bodies, documents, signals = (self.store.read(t) for t in ("bodies", "documents", "signals"))
        out, folder = [], folder.rstrip("/")
        s, p = reports.calibration(signals, self.store.read("keyword_hits"), documents)
        repeated = reports.repeated_scopes(signals, documents, bodies)
        texts = {"coverage.md": reports.coverage_markdown(bodies, documents, signals), "calibration.md": reports.calibration_markdown(reports.calibration_rates(s, p), reports.missed_signals(s), repeated)}
        for name, text in texts.items():
            self._put(f"{folder}/{name}", text)
            out.append(name)
        frames = {"signals.csv": reports.signals_report(signals, documents, bodies), "projects.csv": reports.projects_report(self.store.read("projects"), bodies), "coverage_trend.csv": reports.coverage_trend(bodies, self.store.read("coverage_log")), "repeated_scopes.csv": repeated}
        first = {"coverage_trend.csv": "step", "repeated_scopes.csv": "signals"}
        for name, rows in frames.items():
            if write_csv(rows.orderBy(first.get(name, "place")), f"{folder}/{name}"):
                out.append(name)
        return out

    def _put(self, path: str, text: str) -> None:
        place = self.store._files.Path(path)
        stream = place.getFileSystem(self.store.spark._jsc.hadoopConfiguration()).create(place, True)
        stream.write(bytearray(text.encode("utf-8")))
        stream.close()

    def plan(self) -> DataFrame:
        """What each stage would take, without running any."""
        return lifecycle.stage_counts(self.store.read("documents"))

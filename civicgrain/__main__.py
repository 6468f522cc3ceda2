"""Command line: ``python -m civicgrain COMMAND --data FOLDER``. Fetching, extraction and models come from a module of the caller (``--with``)."""

from __future__ import annotations

import argparse
import importlib
import sys
from datetime import date

from pyspark.sql import SparkSession

from civicgrain.operators import scan
from civicgrain.pipeline import Pipeline, Store

COMMANDS = ("initdb", "load-bodies", "discover", "fetch", "extract", "scan", "classify", "projects", "report", "run-all")


def arguments(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="civicgrain", description="Stages of the records pipeline over a folder of tables.")
    parser.add_argument("command", choices=COMMANDS)
    parser.add_argument("--data", required=True, help="folder of the tables")
    parser.add_argument("--bodies", help="CSV of bodies (load-bodies)")
    parser.add_argument("--pages", help="Parquet of pages: body_id, page_order, url, html (discover)")
    parser.add_argument("--robots", help="Parquet of robots files: host, status, text (fetch)")
    parser.add_argument("--with", dest="plugin", help="module with get, save, extract, ocr, model, retry")
    parser.add_argument("--vocabulary", help="YAML of trades, stages, triggers, negatives and skip_patterns")
    parser.add_argument("--model", default="model-small", help="name the runs are stored under")
    parser.add_argument("--cap", type=float, default=5.0, help="most to spend a day")
    parser.add_argument("--docs", type=int, nargs="*", help="documents to classify; goes before --all")
    parser.add_argument("--all", action="store_true", help="classify all scanned documents, not only those in the window")
    parser.add_argument("--out", default="reports", help="folder of the reports")
    parser.add_argument("--as-of", default=date.today().isoformat())
    parser.add_argument("--dry-run", action="store_true", help="only tell what each stage would take")
    return parser.parse_args(argv)


def run(spark: SparkSession, options: argparse.Namespace) -> list[str]:
    """Runs the command; lines that tell what was done."""
    words = scan.Vocabulary.from_yaml(options.vocabulary) if options.vocabulary else scan.Vocabulary()
    line = Pipeline(Store(spark, options.data), options.as_of, words, cap=options.cap)
    plugin = importlib.import_module(options.plugin) if options.plugin else None
    of = lambda name: getattr(plugin, name, None)

    def need(value, what: str):
        if value is None:
            raise SystemExit(f"{options.command} needs {what}")
        return value

    stages = {
        "initdb": lambda: line.initialise(),
        "load-bodies": lambda: line.load_bodies(need(options.bodies, "--bodies")),
        "discover": lambda: line.discover(spark.read.parquet(need(options.pages, "--pages"))),
        "fetch": lambda: line.fetch(need(of("get"), "get in --with"), need(of("save"), "save in --with"), spark.read.parquet(options.robots) if options.robots else None),
        "extract": lambda: line.extract(need(of("extract"), "extract in --with"), of("ocr")),
        "scan": lambda: line.scan(),
        "classify": lambda: line.classify(need(of("model"), "model in --with"), options.model, of("retry"), options.docs, options.all),
        "projects": lambda: [f"{r.projects} projects, {r.max_signals} signals at most" for r in line.rebuild_projects().collect()],
        "report": lambda: line.report(options.out),
    }
    if options.dry_run:
        return [f"{r.stage}: {r.documents}" for r in line.plan().orderBy("step").collect()]
    if options.command != "run-all":
        return [f"{options.command}: {stages[options.command]()}"]
    given = {"discover": options.pages, "fetch": of("get"), "extract": of("extract"), "classify": of("model")}
    return [f"{name}: {stages[name]()}" for name in ("initdb", "discover", "fetch", "extract", "scan", "classify", "projects", "report") if given.get(name, True)]


def main(argv: list[str] | None = None) -> int:
    options = arguments(sys.argv[1:] if argv is None else argv)
    spark = SparkSession.builder.appName("civicgrain").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    print("\n".join(run(spark, options)))
    return 0


if __name__ == "__main__":
    sys.exit(main())

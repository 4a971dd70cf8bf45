"""python -m siltstone COMMAND: the engine's jobs over tables and files.

Tables are Parquet folders; metadata pages, the outcome log and sidecars are JSON as harvested. A command prints the
rows of its report, or writes them where --out is given.
"""

from __future__ import annotations

import argparse
import importlib.util
import shutil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _tracker(spark: SparkSession, a) -> DataFrame:
    return spark.read.parquet(a.tracker)


def build(spark, a):
    from .operators.tracker import build as made
    from .sources.records import read_outcomes, read_pages, read_sidecars

    return made(read_pages(spark, a.pages), read_outcomes(spark, a.outcomes) if a.outcomes else None, read_sidecars(spark, a.sidecars) if a.sidecars else None)


def landscape(spark, a):
    from .operators.reports import landscape as made

    return made(_tracker(spark, a).where(F.col("year") >= a.since))


def status(spark, a):
    from .operators.reports import counts_by

    return counts_by(_tracker(spark, a), a.by)


def find(spark, a):
    return _tracker(spark, a).where(F.lower("doi") == a.doi.lower())


def fetch(spark, a):
    from .operators.selection import fetch_plan

    done = spark.read.parquet(a.fetched) if a.fetched else spark.createDataFrame([], "id string, has_xml boolean, has_pdf_file boolean")
    return fetch_plan(_tracker(spark, a), a.route, done, a.limit)


def sample(spark, a):
    from .operators.selection import balanced

    return balanced(_tracker(spark, a), a.per, a.top)


def corpus(spark, a):
    """One plan item after another, ``Name:N``: hosted works first with --prefer-direct."""
    from functools import reduce

    from .functions.text import plan_items
    from .operators.selection import tiered

    works = _tracker(spark, a).where("disposition = 'convert_vor'")
    works = works.where("has_grobid") if a.with_tei else works
    items = spark.range(1).select(F.explode(plan_items(F.lit(a.plan))).alias("i")).select("i.name", "i.n").collect()
    return reduce(DataFrame.unionByName, [tiered(works.where(F.col("publisher") == i.name).select("id", "publisher"), works.where("in_pmc"), i.n, a.prefer_direct) for i in items])


def budget(spark, a):
    from .operators.selection import within_budget

    return within_budget(spark.read.parquet(a.items), a.per, a.budget)


def attempts(spark, a):
    from .operators.selection import attempts as made
    from .sources.records import read_outcomes

    return made(_tracker(spark, a).where(F.col("route") == a.route).select("id"), read_outcomes(spark, a.outcomes), a.limit, a.redo, a.no_retry)


def crosswalk(spark, a):
    """Sources (id, xml, kind, mid, meta, codes, assets) to house articles."""
    from .operators.documents import crosswalk as made

    return made(spark.read.parquet(a.sources))


def repair(spark, a):
    from .operators.documents import repair_figures

    return repair_figures(spark.read.parquet(a.articles))


def captions(spark, a):
    from .functions.latex import clean_text

    df = spark.read.parquet(a.table)
    return df.withColumn(a.column, clean_text(a.column))


def fidelity(spark, a):
    from .operators.fidelity import evaluate

    pairs = spark.read.parquet(a.pairs)
    return evaluate(pairs.withColumn("floor", F.lit(a.floor).cast("double")) if a.floor is not None else pairs)


def pilot(spark, a):
    from .operators.pilot import pilot as made

    manifest = spark.read.parquet(a.manifest)
    manifest = manifest.where(F.col("slug") == a.only) if a.only else manifest
    return made(manifest, spark.read.parquet(a.works), spark.read.parquet(a.verdicts), spark.read.parquet(a.findings))[a.report]


def calibrate(spark, a):
    from .operators.fidelity import METRICS
    from .operators.pilot import completeness_by
    from .operators.reports import distribution

    rows = spark.read.parquet(a.measured)
    return completeness_by(rows) if a.by_publisher else distribution(rows, "lint_pass", METRICS)


def policy(spark, a):
    from .plans.rules import explain

    return spark.createDataFrame([(c, str(place), str(to), why) for c, place, to, why in explain()], "column string, place string, result string, why string")


def query(spark, a):
    from . import more_queries  # noqa: F401
    from .queries import QUERIES

    return QUERIES[a.name](spark, a.sf_dir) if a.name else spark.createDataFrame([(n,) for n in sorted(QUERIES)], "name string")


def doctor(spark, a):
    """What is there to work with."""
    found = [("spark", spark.version), ("cores", str(spark.sparkContext.defaultParallelism)), ("shared folder", spark.conf.get("spark.checkpoint.dir", None) or "not set"), ("java", shutil.which("java") or "not on the path")]
    found += [(m, "there" if importlib.util.find_spec(m) else "missing") for m in ("pyarrow", "numpy", "pandas", "xxhash", "tokenizers", "tiktoken")]
    return spark.createDataFrame(found, "what string, found string")


TRACKER = ("tracker", {})
COMMANDS: dict = {
    build: [("pages", {}), ("--outcomes", {}), ("--sidecars", {})],
    landscape: [TRACKER, ("--since", {"type": int, "default": 2021})],
    status: [TRACKER, ("--by", {"default": "ingest_status"})],
    find: [TRACKER, ("--doi", {"required": True})],
    fetch: [TRACKER, ("--route", {"required": True}), ("--limit", {"type": int, "default": 3}), ("--fetched", {})],
    sample: [TRACKER, ("--per", {"type": int, "default": 3}), ("--top", {"type": int, "default": 10})],
    corpus: [TRACKER, ("--plan", {"required": True}), ("--prefer-direct", {"action": "store_true"}), ("--with-tei", {"action": "store_true"})],
    budget: [("items", {}), ("--per", {"type": int, "default": 5}), ("--budget", {"type": float, "required": True})],
    attempts: [TRACKER, ("outcomes", {}), ("--route", {"default": "pmc"}), ("--limit", {"type": int, "default": 10}), ("--redo", {"action": "store_true"}), ("--no-retry", {"action": "store_true"})],
    crosswalk: [("sources", {})], repair: [("articles", {})], captions: [("table", {}), ("--column", {"default": "caption"})],
    fidelity: [("pairs", {}), ("--floor", {"type": float})],
    pilot: [("manifest", {}), ("works", {}), ("verdicts", {}), ("findings", {}), ("--only", {}), ("--report", {"choices": ["results", "publishers", "kinds"], "default": "publishers"})],
    calibrate: [("measured", {}), ("--by-publisher", {"action": "store_true"})],
    policy: [], doctor: [], query: [("name", {"nargs": "?"}), ("--sf-dir", {"default": "/root/testdata/sf0.001"})],
}


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="siltstone", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = p.add_subparsers(dest="command", required=True)
    for f, arguments in COMMANDS.items():
        c = commands.add_parser(f.__name__, help=f.__doc__)
        for name, how in arguments:
            c.add_argument(name, **how)
        c.add_argument("--out", help="a folder for the rows, as Parquet")
        c.add_argument("--limit-shown", type=int, default=20)
    a = p.parse_args(argv)
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    rows = next(f for f in COMMANDS if f.__name__ == a.command)(spark, a)
    if a.out:
        rows.write.mode("overwrite").parquet(a.out)
        rows = spark.read.parquet(a.out)
    rows.show(a.limit_shown, truncate=80)
    # a check that found a failure says so to its caller
    return int(a.command == "fidelity" and not rows.where("verdict = 'fail'").isEmpty())


if __name__ == "__main__":
    raise SystemExit(main())

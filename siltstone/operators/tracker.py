"""The rebuildable tracker: dedupe, route, seed, overlay outcomes, index sidecars."""

from __future__ import annotations

from bisect import bisect_right

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.rules import route_works
from ..shipping import ship
from ..sources.records import OUTCOME_COLUMNS, pin_types, sidecar_fields

#: Rows of a range that is numbered by one task.
RANKED_ROWS = 500_000
STATUSES = ["pending", "ingested", "partial", "escalate", "failed"]
OUTCOME_TYPES = {"ingest_status": "string", "gates_passed": "boolean", "figures_status": "string", "escalate_reason": "string", "ingest_mid": "string", "ingest_ts": "string"}
SIDE_TYPES = {"sidecar_path": "string", "sidecar": "string", "n_assets": "int", "err_count": "int", "warn_count": "int"}


def dedupe(df: DataFrame, key: list[str], order: list) -> DataFrame:
    """One row per key, the first in a total order. A grouped minimum, so a key's rows are combined before the shuffle."""
    rest = [c for c in df.columns if c not in key]
    first = df.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return first.select(*key, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*df.columns)


def latest(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row per key, the last in order."""
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*key, *[F.col(f"_r.{c}").alias(c) for c in rest])


def overlay(base: DataFrame, other: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows matched by key take all the columns of the other side, nulls included; rows without a match keep theirs."""
    right = other.select(key, *[F.col(c).alias(f"_{c}") for c in columns], F.lit(True).alias("_met"))
    joined = base.join(right, key, "left")
    return joined.select(*[F.when(F.col("_met"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in base.columns])


def seeded(routed: DataFrame) -> DataFrame:
    """The six outcome columns, empty but for the status."""
    out = routed
    for name, kind in OUTCOME_TYPES.items():
        out = out.withColumn(name, F.lit(None).cast(kind))
    return out.withColumn("ingest_status", F.when(F.col("lane") == "out_of_scope", "out_of_scope").otherwise("pending"))


def sidecar_rows(sidecars: DataFrame) -> DataFrame:
    """Sidecars (sidecar_path, sidecar) by work: id and the five columns. Texts that aren't JSON, and those of no work, are left out."""
    found = sidecar_fields(sidecars.select("sidecar_path", "sidecar"))
    return found.where("not bad and work_id is not null").select(F.col("work_id").alias("id"), *SIDE_TYPES)


def index_sidecars(works: DataFrame, sidecars: DataFrame) -> DataFrame:
    """Adds the five sidecar columns by work id; the last path of a work wins, files that aren't JSON are left out."""
    for name, kind in SIDE_TYPES.items():
        works = works if name in works.columns else works.withColumn(name, F.lit(None).cast(kind))
    return overlay(works, latest(sidecar_rows(sidecars), ["id"], ["sidecar_path"]), "id", list(SIDE_TYPES))


def build(works: DataFrame, outcomes: DataFrame | None = None, sidecars: DataFrame | None = None) -> DataFrame:
    """The whole tracker as one lazy plan."""
    pinned = pin_types(works, {"license": "string", "journal": "string", "publisher": "string", "in_pmc": "boolean", "has_pdf": "boolean"})
    out = seeded(route_works(dedupe(pinned, ["id"], [F.to_json(F.struct(*pinned.columns))])))
    if outcomes is not None:
        out = overlay(out, latest(outcomes, ["id"], ["ingest_ts", "ingest_status"]), "id", OUTCOME_COLUMNS)
    return index_sidecars(out, sidecars) if sidecars is not None else out


def published(tracker: DataFrame) -> DataFrame:
    """The view of openly licensed published versions that have a file."""
    return tracker.where("license = 'cc-by' and version = 'publishedVersion' and has_pdf")


def status_of(licence_pass: Column, escalate: Column, validate: Column, lint: Column, figures: Column) -> Column:
    """The status of an attempt; licence first, then escalation, then the two gates."""
    return (F.when(~licence_pass, "failed").when(F.coalesce(escalate, F.lit("")) != "", "escalate").when(validate & lint, "ingested")
            .when(validate & ~lint & figures.isin("partial", "none"), "partial").otherwise("failed"))


def figure_status(lint: Column, figure_errors: Column, figures: Column) -> Column:
    return F.when(lint, "complete").when(figure_errors > 0, F.when(figures > 0, "partial").otherwise("none")).otherwise("complete")


def failure_reason(both: Column, errors: Column, licence: Column, fidelity: Column, detail: Column) -> Column:
    """Why an attempt isn't clean: math images, the first error, the licence, then fidelity; empty when nothing is."""
    images = F.exists(errors, lambda e: F.contains(e, F.lit("M")) & F.contains(e, F.lit(".gif")))
    first = F.substring(F.regexp_replace(F.get(errors, F.lit(0)), "'[^']*'", "X"), 1, 60)
    gate = F.when(~both & images, "inline-math images -> ESCALATE").when(~both & (F.size(errors) > 0), first)
    reason = F.coalesce(gate, F.when(~licence, "licence not CC-BY -> FAILED"))
    said = F.coalesce(detail, F.lit("see sidecar"))
    return F.coalesce(reason, F.when(fidelity == "fail", F.substring(F.concat(F.lit("fidelity: "), said), 1, 60)).when(fidelity == "flag", F.substring(F.concat(F.lit("fidelity flag: "), said), 1, 60)), F.lit(""))


def overridden(lint: Column, errors: Column, warnings: Column, residual: Column, fidelity: Column) -> Column:
    """struct(lint, errors, warnings) after the checks that the gates can't make."""
    bad = F.coalesce(fidelity == "fail", F.lit(False))
    return F.struct((lint & (residual == 0) & ~bad).alias("lint"), (errors + residual + bad.cast("int")).alias("errors"),
                    (warnings + F.coalesce(fidelity == "flag", F.lit(False)).cast("int")).alias("warnings"))


def padded(number: Column, width: int) -> Column:
    """With zeros up to width; a longer number keeps all its digits (lpad would cut it)."""
    return F.format_string(f"%0{width}d", number.cast("bigint"))


def allocate(files: DataFrame, known: DataFrame, prefix: str = "MORE-2025-", first: int = 910_000, width: int = 6) -> DataFrame:
    """files (id, place) with a key each: those known keep theirs, others get the next numbers in file order.

    ``known``: (id, mid). New rows are numbered within ranges of place and the ranges set one after
    another, so no task holds all of them.
    """
    top = known.where(F.col("mid").rlike(r"-\d+$")).select(F.coalesce(F.max(F.regexp_extract("mid", r"-(\d+)$", 1).cast("bigint")), F.lit(first)).alias("top"))
    fresh = files.join(known, "id", "left_anti")
    numbered = ranked(fresh, "place").crossJoin(F.broadcast(top))  # one row
    made = numbered.select("id", "place", F.concat(F.lit(prefix), padded(F.col("top") + F.col("rank"), width)).alias("mid"))
    return files.join(known, "id").select("id", "place", "mid").unionByName(made)


def ranked(df: DataFrame, order: str) -> DataFrame:
    """rank from 1 over all rows in order (of a unique column, a number or a string).

    Rows are numbered within ranges of about RANKED_ROWS, and the ranges set one after another. Where
    ranges begin is read from a bounded sample, so neither a far outlier nor a dense stretch makes a large one.
    """
    n = df.count()
    parts = -(-n // RANKED_ROWS)
    bounds: list = []
    if parts > 1:
        seen = sorted(r[0] for r in df.select(order).sample(min(1.0, 50 * parts / n), seed=7).collect() if r[0] is not None)
        bounds = sorted({seen[i * len(seen) // parts] for i in range(1, parts)}) if seen else []

    @F.pandas_udf("int")
    def range_of(x: pd.Series) -> pd.Series:
        return x.map(lambda v: bisect_right(bounds, v), na_action="ignore").fillna(0).astype("int32")

    ship(df.sparkSession)
    placed = df.withColumn("_part", range_of(F.col(order)) if bounds else F.lit(0))
    counts = placed.groupBy("_part").count()
    before = counts.select("_part", F.coalesce(F.sum("count").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(order))
    return placed.join(before, "_part").withColumn("rank", F.col("_before") + within).drop("_part", "_before")


def pilot_numbers(rows: DataFrame, prefix: str = "MORE-2025-99", width: int = 4) -> DataFrame:
    """rows (id, slug) numbered from 0 in order of slug and id."""
    numbered = ranked(rows.withColumn("_key", F.concat("slug", F.lit("\u0000"), F.col("id").cast("string"))), "_key")
    return numbered.select("id", "slug", F.concat(F.lit(prefix), padded(F.col("rank") - 1, width)).alias("mid"))

"""Versions and content hashes: what has to be made or judged again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Current step versions.
STEPS = {"crosswalk": 1, "tei_to_jats": 3, "elsevier": 1, "body_clean": 1, "caption_clean": 1, "fig_repair": 1, "figures": 1, "fidelity": 1}


def _literal(steps: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in steps.items() for x in kv])


def stale_steps(recorded: Column, current: dict[str, int] | None = None) -> Column:
    """map<step, struct(recorded, current)> of steps whose recorded version (0 where missing) is lower."""
    now = _literal(current or STEPS)
    seen = F.coalesce(recorded, F.create_map().cast("map<string,int>"))
    paired = F.transform_values(now, lambda k, v: F.struct(F.coalesce(F.try_element_at(seen, k), F.lit(0)).alias("recorded"), v.alias("current")))
    return F.map_filter(paired, lambda k, v: v["recorded"] < v["current"])


def stale_gates(recorded: Column, current: dict[str, str], has_fidelity: Column) -> Column:
    """map<gate, struct(recorded, current)> of gates whose stamp isn't the current one; fidelity only where there is a verdict."""
    seen = F.coalesce(recorded, F.create_map().cast("map<string,string>"))
    paired = F.transform_values(_literal(current), lambda k, v: F.struct(F.coalesce(F.try_element_at(seen, k), F.lit("unstamped")).alias("recorded"), v.alias("current")))
    return F.map_filter(paired, lambda k, v: (v["recorded"] != v["current"]) & ((k != "fidelity") | has_fidelity))


def stamp(engine: Column, has_fidelity: Column) -> Column:
    """An engine stamp without the fidelity gate where that gave no verdict."""
    return F.map_filter(engine, lambda k, v: (k != "fidelity") | has_fidelity)


def sidecar(rows: DataFrame) -> DataFrame:
    """Nested sidecar records as JSON text, from flat columns; nulls are left out as in the records read."""
    c = F.col
    record = F.struct(
        F.lit("sidecar/6").alias("schema"), F.struct(c("id").alias("work_id"), "mid", "doi", "journal", "title").alias("identity"), F.struct("route", "lane", "asset_route").alias("route"),
        F.struct(c("validate").alias("validate_pass"), c("lint").alias("lint_pass"), "errors", "warnings", (c("validate") & c("lint")).alias("both_pass")).alias("gates"),
        F.struct(c("n_assets").alias("count"), c("asset_source").alias("source")).alias("assets"), "pipeline")
    return rows.select("id", F.to_json(record).alias("sidecar"))


def fingerprints(files: DataFrame) -> DataFrame:
    """(path, sha16) of file contents; a missing file's is ``missing``."""
    return files.select("path", F.coalesce(F.substring(F.sha2("content", 256), 1, 16), F.lit("missing")).alias("sha16"))

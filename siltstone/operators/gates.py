"""The gates' verdicts as one typed record, and the path of an attempt from verdicts to outcome as one plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import licence_verdict
from .tracker import failure_reason, figure_status, overridden, status_of

STAMP = "yyyy-MM-dd'T'HH:mm:ss"


def stamp(clock: Column | None = None) -> Column:
    """A local time to the second, as text. ``clock``: a timestamp in place of now."""
    return F.date_format(F.current_timestamp() if clock is None else clock, STAMP)


def provisional(codes: Column) -> Column:
    """Whether the second of the subject codes (array<struct<code, label>>) is only a placeholder of its division."""
    return F.coalesce(F.endswith(F.get(codes, F.lit(1))["code"], F.lit("99")), F.lit(False))


def record(validate_line: Column, lint_output: Column, article: Column, engine: Column, clock: Column | None = None) -> Column:
    """What three gates said, typed: the last line of the validation, the output of the lint and the article itself.

    The numbers are those the lint reports; where it reports none, its lines of errors are counted.
    """
    lines = F.split(F.coalesce(lint_output, F.lit("")), "\n")
    result = F.get(F.filter(lines, lambda x: F.startswith(x, F.lit("Result"))), F.lit(0))
    errors = F.filter(lines, lambda x: F.contains(x, F.lit("ERROR")))
    number = lambda p: F.nullif(F.regexp_extract(F.coalesce(lint_output, F.lit("")), p, 1), F.lit("")).cast("int")
    said = F.coalesce(validate_line, F.lit("?"))
    licence = licence_verdict(article)
    return F.struct(
        (F.contains(said, F.lit("PASS")) & ~F.contains(said, F.lit("FAIL"))).alias("validate_pass"), said.alias("validate_line"),
        F.coalesce(F.contains(result, F.lit("Result: PASS")), F.lit(False)).alias("lint_pass"), F.coalesce(result, F.substring(F.trim(F.coalesce(lint_output, F.lit(""))), 1, 120)).alias("lint_line"),
        F.coalesce(number(r"\((\d+)\s+error"), F.size(errors)).alias("errors"), F.coalesce(number(r"(\d+)\s+warning"), F.lit(0)).alias("warnings"), errors.alias("error_lines"),
        licence["ok"].alias("licence_pass"), licence["uri"].alias("licence_uri"), licence["detail"].alias("licence_detail"), engine.alias("engine"), stamp(clock).alias("checked_at"))


def ingested(attempts: DataFrame) -> DataFrame:
    """attempts (id, mid, gates as of ``record``, residual, fidelity, fidelity_detail, figure_errors, figures, escalate, ts) as rows of the outcome log.

    What the gates can't see, raw LaTeX and a failed comparison with the source, is laid over
    their verdicts first; status, figures and reason follow from these.
    """
    g = F.col("gates")
    judged = attempts.withColumn("own", overridden(g["lint_pass"], g["errors"], g["warnings"], F.col("residual"), F.col("fidelity")))
    both = g["validate_pass"] & F.col("own.lint")
    figures = figure_status(F.col("own.lint"), F.col("figure_errors"), F.col("figures"))
    status = status_of(g["licence_pass"], F.col("escalate"), g["validate_pass"], F.col("own.lint"), figures)
    reason = failure_reason(both, g["error_lines"], g["licence_pass"], F.col("fidelity"), F.col("fidelity_detail"))
    return judged.select("id", status.alias("ingest_status"), (both & g["licence_pass"]).alias("gates_passed"), figures.alias("figures_status"),
                         F.nullif(F.coalesce(F.nullif(F.col("escalate"), F.lit("")), reason), F.lit("")).alias("escalate_reason"), F.col("mid").alias("ingest_mid"), F.col("ts").alias("ingest_ts"),
                         F.col("own.errors").alias("err_count"), F.col("own.warnings").alias("warn_count"))

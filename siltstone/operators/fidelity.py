"""How faithfully a converted document has its source's text: shingles, ratios, verdicts, missing runs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.words import Shingled, slices
from .spread import spread

# Calibrated values.
DEFAULTS = {"grounding": 0.60, "fail": 0.40, "floor": 0.65, "mass": 0.35, "source_tokens": 2000, "n": 5, "runs": 5}

#: Bytes of both sides that are compared at once. Larger parts have arrays for which memory is fetched from the system each time.
SLICE_BYTES = 1 << 17
COUNTS = ["source_tokens", "target_tokens", "source_set", "target_set", "common", "source_nums", "both_nums"]
METRICS = ["completeness", "grounding", "mass_ratio", "num_recall"]


def _ratio(a: Column, b: Column, empty: float = 0.0) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(empty))


def _thousandths(x: Column) -> Column:
    return F.bround(x, 3)


def _counted(n: int, normalise: bool):
    """The numbers of COUNTS of a source and its target. What needs a text that is null is null."""
    def counted(texts):
        source, target = (c.cast(pa.binary()).to_pylist() for c in texts.columns)
        s = Shingled(source, target, n, normalise)
        numerals, both = s.numerals()
        no_source, no_target = (np.array([x is None for x in side], bool) for side in (source, target))
        found = [(s.size[: s.pairs], no_source), (s.size[s.pairs :], no_target), (s.per_pair(s.in_source), no_source), (s.per_pair(s.in_target), no_target),
                 (s.per_pair(s.in_source & s.in_target), no_source | no_target), (numerals, no_source), (both, no_source | no_target)]
        return [pa.array(x.astype(np.int32), mask=gone) for x, gone in found]

    def run(source: pa.Array, target: pa.Array) -> pa.Array:
        parts = [counted(part) for part in slices(pa.RecordBatch.from_arrays([source, target], names=["source", "target"]), [0, 1], SLICE_BYTES)]
        return pa.StructArray.from_arrays([pa.concat_arrays(x) for x in zip(*parts, strict=True)] or [pa.array([], pa.int32())] * len(COUNTS), names=COUNTS)
    return F.arrow_udf(run, ", ".join(f"{c} int" for c in COUNTS)).asNondeterministic()  # so that filters and explodes don't evaluate it again


def metrics(pairs: DataFrame, normalise: bool = True) -> DataFrame:
    """pairs without their texts, with completeness, grounding, mass_ratio and num_recall, unrounded, and token counts.

    Sets stay within a row: one pass, no shuffle. Of the texts only counts leave Python; where no metric is used, no text is read.
    """
    rest = [c for c in pairs.columns if c not in ("source_text", "target_text")]
    s = spread(pairs).select(*rest, _counted(DEFAULTS["n"], normalise)("source_text", "target_text").alias("_found")).select(*rest, *[F.col(f"_found.{c}").alias(c) for c in COUNTS])
    c = F.col
    return s.withColumns({
        "completeness": _ratio(c("common"), c("source_set")), "grounding": _ratio(c("common"), c("target_set")), "mass_ratio": _ratio(c("target_tokens"), c("source_tokens")),
        "num_recall": _ratio(c("both_nums"), c("source_nums"), 1.0)}).drop("source_set", "target_set", "common", "source_nums", "both_nums")


def _two(x: Column) -> Column:
    return F.format_string("%.2f", x)


def judged(pairs: DataFrame, source_tokens: int = DEFAULTS["source_tokens"], normalise: bool = True) -> DataFrame:
    """pairs (pair_id, source_text, target_text, ref_target, ref_source?, floor?) with verdict, reasons and exact metrics.

    A floor of null or 0 is the default one. Verdicts use exact ratios, metrics are rounded. Parity of
    references is judged only where the source's count is known.
    """
    m = metrics(pairs, normalise)
    floor = F.coalesce(F.nullif(F.col("floor"), F.lit(0.0)), F.lit(DEFAULTS["floor"]))
    c = F.col
    fails = F.filter(F.array(
        F.when(c("ref_source").isNotNull() & (c("ref_target") != c("ref_source")), F.concat(F.lit("ref parity broken: "), c("ref_target"), F.lit(" target refs vs "), c("ref_source"), F.lit(" in the source"))),
        F.when(c("source_tokens") < source_tokens, F.concat(F.lit("suspect source: "), c("source_tokens"), F.lit(f" letter-tokens < {source_tokens}"))),
        F.when(c("mass_ratio") < DEFAULTS["mass"], F.concat(F.lit("body mass "), _two(c("mass_ratio")), F.lit(f" < {DEFAULTS['mass']} of the source"))),
        F.when(c("grounding") < DEFAULTS["grounding"], F.concat(F.lit("grounding "), _two(c("grounding")), F.lit(f" < {DEFAULTS['grounding']} (wrong pairing?)"))),
        F.when(c("completeness") < DEFAULTS["fail"], F.concat(F.lit("completeness "), _two(c("completeness")), F.lit(f" < {DEFAULTS['fail']}"))),
    ), lambda x: x.isNotNull())
    out = m.withColumns({"fails": fails, "pass_floor": floor})
    flagged = c("completeness") < c("pass_floor")
    verdict = F.when(F.size("fails") > 0, "fail").when(flagged, "flag").otherwise("pass")
    note = F.concat(F.lit("completeness "), _two(c("completeness")), F.lit(" below the "), _two(c("pass_floor")), F.lit(" floor"))
    return out.select("pair_id", verdict.alias("verdict"), F.when(verdict == "flag", F.array(note)).otherwise(c("fails")).alias("reasons"),
                      *METRICS, "source_tokens", "target_tokens", "ref_target", "ref_source", "pass_floor")


def evaluate(pairs: DataFrame, source_tokens: int = DEFAULTS["source_tokens"], normalise: bool = True) -> DataFrame:
    """``judged`` with metrics in thousandths."""
    return judged(pairs, source_tokens, normalise).withColumns({k: _thousandths(F.col(k)) for k in (*METRICS, "pass_floor")})


def _runs(n: int, most: int, normalise: bool):
    """(pair_id, shingles, at_token, snippet). Batches: source and target texts, pair_id."""
    def found(batch):
        s = Shingled(*(batch.column(c).cast(pa.binary()).to_pylist() for c in (0, 1)), n, normalise)
        row, at = s.lacking()
        new = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1)]) if len(row) else np.zeros(0, np.int64)
        size, row, at = np.diff(np.r_[new, len(row)]), row[new], at[new]
        order = np.lexsort((at, -size, row))
        row, at, size = row[order], at[order], size[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        keep = (place < most) & (size >= n)
        row, at, size = row[keep], at[keep], size[keep]
        return pa.RecordBatch.from_arrays([batch.column(2).take(pa.array(row)), pa.array(size.astype(np.int64)), pa.array(at.astype(np.int32)), s.said(row, at, 24, 160)], names=["pair_id", "shingles", "at_token", "snippet"])

    def run(batches):
        for whole in batches:
            for part in slices(whole, [0, 1], SLICE_BYTES):
                yield found(part)
    return run


def missing_runs(pairs: DataFrame, normalise: bool = True) -> DataFrame:
    """(pair_id, shingles, at_token, snippet) of the longest runs of source shingles that the target lacks.

    A run is a stretch of missing shingles in a row. The longest five runs (of equals the first) are
    taken, then those shorter than a shingle go. All of it lies within a pair: one pass, no shuffle.
    """
    s = spread(pairs).select("source_text", "target_text", "pair_id")
    return s.mapInArrow(_runs(DEFAULTS["n"], DEFAULTS["runs"], normalise), f"pair_id {pairs.schema['pair_id'].dataType.simpleString()}, shingles bigint, at_token int, snippet string")

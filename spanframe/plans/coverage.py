"""The coverage report: united speech, what words cover of it, holes, gates and the spans to go over again."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanframe.operators import intervals as iv


@dataclass(frozen=True)
class CoverageConfig:
    region_gap: int = 150
    word_padding: int = 120
    word_gap: int = 300
    least_hole: int = 750
    least_ratio: float = 0.70
    rescue_padding: int = 500
    rescue_gap: int = 250
    longest_outside: int = 120
    longest_piece: int = 10_000


@dataclass(frozen=True)
class CoverageReport:
    regions: DataFrame
    issues: DataFrame
    violations: DataFrame
    rescue: DataFrame
    summary: DataFrame


def coverage_report(speech: DataFrame, words: DataFrame, keys: list[str], config: CoverageConfig = CoverageConfig(), reviewed: DataFrame | None = None) -> CoverageReport:
    """speech and words: (keys, start_ms, end_ms). reviewed: (keys, region_start, region_end, gap_start, gap_end) of holes that hold no speech.

    A region is covered by the words that overlap it, padded, united and clipped.
    Below least_ratio every hole is an issue, else those of least_hole or more;
    a review clears an issue of exactly its bounds. A word may not run outside
    all regions for over longest_outside. passed: no issue left and no violation.
    """
    bounds = ("region_start", "region_end")
    regions = iv.coalesce_intervals(speech, keys, gap=config.region_gap).select(*keys, F.col("start_ms").alias("region_start"), F.col("end_ms").alias("region_end"))
    # only words that overlap a region count for it, but then with their padding
    touching = iv.interval_join(regions, words.select(*keys, "start_ms", "end_ms"), keys, bounds, ("start_ms", "end_ms"))
    padded = touching.select(*keys, *bounds, F.greatest(F.lit(0).cast("bigint"), F.col("start_ms") - config.word_padding).alias("start_ms"), (F.col("end_ms") + config.word_padding).alias("end_ms"))
    united = iv.coalesce_intervals(padded, [*keys, *bounds], gap=config.word_gap)
    covered = united.withColumn("start_ms", F.greatest("start_ms", "region_start")).withColumn("end_ms", F.least("end_ms", "region_end")).filter("start_ms < end_ms")
    by = [*keys, *bounds]
    measured = iv.coverage(regions, covered.select(*keys, "start_ms", "end_ms"), keys).withColumn("ratio", iv.safe_ratio(F.col("covered_ms"), F.col("region_ms")))
    gaps = iv.subtract_intervals(regions, covered.select(*keys, "start_ms", "end_ms"), keys)
    low = F.col("ratio") < config.least_ratio
    long = F.col("gap_end") - F.col("gap_start") >= config.least_hole
    issues = gaps.join(measured.select(*by, "ratio"), by).filter(low | long).withColumn("reason", F.when(low, "low_coverage_speech_hole").otherwise("speech_hole"))
    if reviewed is not None:
        issues = issues.join(reviewed.select(*by, "gap_start", "gap_end").distinct(), [*by, "gap_start", "gap_end"], "left_anti")
    named = words.select(*keys, F.col("start_ms").alias("word_start"), F.col("end_ms").alias("word_end"))
    violations = iv.outside_runs(named, regions.withColumnsRenamed({"region_start": "start_ms", "region_end": "end_ms"}), keys, ("word_start", "word_end"), ("start_ms", "end_ms")).filter(F.col("gap_end") - F.col("gap_start") > config.longest_outside)
    spans = issues.select(*keys, F.greatest(F.lit(0).cast("bigint"), F.col("gap_start") - config.rescue_padding).alias("start_ms"), (F.col("gap_end") + config.rescue_padding).alias("end_ms"))
    rescue = iv.coalesce_intervals(spans, keys, gap=config.rescue_gap)
    counts = measured.groupBy(*keys).agg(F.count("*").alias("n_regions"), F.sum("covered_ms").alias("covered_ms"), F.sum("region_ms").alias("region_ms"))
    problems = issues.groupBy(*keys).agg(F.count("*").alias("n_issues")).join(violations.groupBy(*keys).agg(F.count("*").alias("n_violations")), keys, "full_outer")
    summary = counts.join(problems, keys, "full_outer").fillna(0, ["n_regions", "covered_ms", "region_ms", "n_issues", "n_violations"])
    return CoverageReport(measured, issues, violations, rescue, summary.withColumn("passed", (F.col("n_issues") == 0) & (F.col("n_violations") == 0)))

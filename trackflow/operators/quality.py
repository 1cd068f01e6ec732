"""Row rules: drop, warn, measure, split; uniqueness; validation of records to be written."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackflow import config

Rules = Mapping[str, str]

POSITION_RULES: Rules = {
    "has_position": "event_ts IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL",
    "inside_box": "lat BETWEEN {} AND {} AND lon BETWEEN {} AND {}".format(*config.BOX_LAT, *config.BOX_LON),
    "plausible_altitude": "coalesce(alt_ft, 0) BETWEEN -1500 AND 60000",
    "plausible_speed": "coalesce(speed_kt, 0) < 700",
}
POSITION_WARNINGS: Rules = {"has_callsign": "length(callsign) > 0"}


def passes(rule: str) -> Column:
    """A rule that cannot be decided counts as broken."""
    return F.coalesce(F.expr(rule), F.lit(False))


def keep_valid(df: DataFrame, rules: Rules = POSITION_RULES) -> DataFrame:
    for rule in rules.values():
        df = df.where(passes(rule))
    return df


def rule_metrics(df: DataFrame, rules: Rules) -> DataFrame:
    """Passed and failed rows per rule, in one pass over the data."""
    counts = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(passes(r)).alias(name) for name, r in rules.items()])
    per_rule = F.explode(
        F.array(*[F.struct(F.lit(name).alias("rule"), F.col(name).alias("passed")) for name in rules])
    )
    return counts.select("n", per_rule.alias("m")).select(
        "m.rule", "m.passed", (F.col("n") - F.col("m.passed")).alias("failed")
    )


def observed(df: DataFrame, rules: Rules, name: str = "rules") -> DataFrame:
    """Count broken rules while a stream or batch runs; read them from the query progress."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"), *[F.count_if(~passes(r)).alias(n) for n, r in rules.items()])


def with_reasons(df: DataFrame, rules: Rules, column: str = "reasons") -> DataFrame:
    """Names of all broken rules, in rule order."""
    broken = [F.when(~passes(r), F.lit(name)) for name, r in rules.items()]
    return df.withColumn(column, F.concat_ws(",", *broken))


def split(df: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with reasons)."""
    marked = with_reasons(df, rules)
    return marked.where("reasons = ''").drop("reasons"), marked.where("reasons <> ''")


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys held by more than one row (combined before the shuffle)."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def violations(df: DataFrame, rules: Rules, unique: Mapping[str, Sequence[str]]) -> DataFrame:
    """Number of rows breaking each row rule and each uniqueness constraint."""
    report = rule_metrics(df, rules).select(F.col("rule").alias("name"), F.col("failed").alias("violations"))
    for name, key in unique.items():
        extra = duplicate_keys(df, key).agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("violations"))
        report = report.unionByName(extra.select(F.lit(name).alias("name"), "violations"))
    return report


def _one_of(column: str, values: Sequence[str]) -> str:
    return f"{column} IN ({', '.join(repr(v) for v in values)})"


QUEUE_RULES: Rules = {
    "event_type": _one_of("event_type", config.EPISODE_KINDS),
    "status": _one_of("status", config.STATUSES),
    "required": "icao24 IS NOT NULL AND location IS NOT NULL AND started_at IS NOT NULL AND ended_at IS NOT NULL",
}
ASSESSMENT_RULES: Rules = {
    "event_id": f"event_id RLIKE '{config.UUID_PATTERN}'",
    "cause": _one_of("cause", config.CAUSES),
    "severity": "severity BETWEEN 1 AND 3",
    "confidence": "confidence BETWEEN 0 AND 1",
}
REVIEW_RULES: Rules = {
    "verdict": _one_of("verdict", config.VERDICTS),
    "corrected_cause": f"corrected_cause IS NULL OR {_one_of('corrected_cause', config.CAUSES)}",
}


def forecast_rules(now: str) -> Rules:
    """Ranges of a forecast, and a target hour from one hour ago to three hours ahead of ``now``."""
    at = f"TIMESTAMP'{now}'"
    return {
        "mean": "predicted_mean_hold_min BETWEEN 0 AND 120",
        "flights": "predicted_holding_flights BETWEEN 0 AND 200",
        "target_hour": f"date_trunc('hour', target_hour) BETWEEN {at} - INTERVAL 1 HOUR AND {at} + INTERVAL 3 HOURS",
    }


def length_rules(**longest: int | None) -> Rules:
    """A rule for every column with a longest length; texts are never cut, over-long ones are reported."""
    return {f"{column}_length": f"{column} IS NULL OR length({column}) <= {n}" for column, n in longest.items() if n is not None}


def checked_assessments(df: DataFrame, reasoning_length: int | None = None, summary_length: int | None = None) -> DataFrame:
    """Assessments with their broken rules, the summary as JSON; lengths are unbounded unless given."""
    rules = ASSESSMENT_RULES | length_rules(reasoning=reasoning_length, evidence_summary=summary_length)
    summary = F.col("evidence_summary").alias("summary")
    return with_reasons(df, rules).withColumn("evidence", F.to_json(F.struct(summary))).drop("evidence_summary")


def checked_forecasts(df: DataFrame, now: str, rationale_length: int | None = None) -> DataFrame:
    """Forecasts with their broken rules; the target is the hour it falls in."""
    rules = forecast_rules(now) | length_rules(rationale=rationale_length)
    return with_reasons(df, rules).withColumn("target_hour", F.date_trunc("hour", "target_hour"))


def checked_reviews(df: DataFrame) -> DataFrame:
    """Reviews with their broken rules; only those without one are fit to be appended."""
    return with_reasons(df, REVIEW_RULES)

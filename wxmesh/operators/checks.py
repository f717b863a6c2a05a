"""Declarative data checks as DataFrame operators (K1-K6).

``violations(df, rule)`` returns the offending rows (empty = pass);
``report`` counts violations for many rules in few passes; ``gate`` raises
before anything downstream is written.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Rule:
    kind: str                      # not_null | unique | unique_combination | accepted_range
    columns: tuple
    min_value: float | None = None
    max_value: float | None = None

    @property
    def label(self) -> str:
        cols = ",".join(self.columns)
        if self.kind == "accepted_range":
            return f"accepted_range({cols}, {self.min_value}, {self.max_value})"
        return f"{self.kind}({cols})"


def not_null(col: str) -> Rule:
    return Rule("not_null", (col,))


def unique(col: str) -> Rule:
    return Rule("unique", (col,))


def unique_combination(*cols: str) -> Rule:
    return Rule("unique_combination", tuple(cols))


def accepted_range(col: str, lo: float | None = None, hi: float | None = None) -> Rule:
    return Rule("accepted_range", (col,), lo, hi)


def _out_of_range(rule: Rule):
    c = F.col(rule.columns[0])
    ok = F.lit(True)
    if rule.min_value is not None:
        ok = ok & (c >= rule.min_value)
    if rule.max_value is not None:
        ok = ok & (c <= rule.max_value)
    return ~ok          # null values give null -> not counted (nulls pass)


def violations(df: DataFrame, rule: Rule) -> DataFrame:
    """K1-K4: rows (or duplicate groups) that break ``rule``."""
    cols = list(rule.columns)
    if rule.kind == "not_null":
        return df.filter(F.col(cols[0]).isNull())
    if rule.kind == "unique":
        return (df.filter(F.col(cols[0]).isNotNull()).groupBy(*cols)
                  .agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1))
    if rule.kind == "unique_combination":
        return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows"))
                  .filter(F.col("n_rows") > 1))
    if rule.kind == "accepted_range":
        return df.filter(_out_of_range(rule))
    raise ValueError(f"unknown rule kind {rule.kind}")


REPORT_SCHEMA = T.StructType([
    T.StructField("model", T.StringType()), T.StructField("rule", T.StringType()),
    T.StructField("violations", T.LongType()),
])


def _bad(rule: Rule):
    return F.col(rule.columns[0]).isNull() if rule.kind == "not_null" else _out_of_range(rule)


def _counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row with the violations ``r0, r1, ...`` of ``rules``, at most one of which is a uniqueness rule.

    With one, the rows are grouped by its key: the groups carry conditional
    counts for the row rules, and one more aggregate adds them up and counts
    the groups of several rows. So a model is read once.
    """
    row_rules = [(i, r) for i, r in enumerate(rules) if r.kind in ("not_null", "accepted_range")]
    keyed = [(i, r) for i, r in enumerate(rules) if r.kind not in ("not_null", "accepted_range")]
    counts = [F.count(F.when(_bad(r), 1)).alias(f"r{i}") for i, r in row_rules]
    if not keyed:
        return df.agg(*counts)
    (k, rule), = keyed
    keys = [F.col(c).alias(f"_k{j}") for j, c in enumerate(rule.columns)]
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *counts)
    several = F.col("_n") > 1
    if rule.kind == "unique":
        several = several & F.col("_k0").isNotNull()
    return groups.agg(*[F.coalesce(F.sum(f"r{i}"), F.lit(0)).alias(f"r{i}") for i, _ in row_rules],
                      F.count(F.when(several, 1)).alias(f"r{k}"))


def report(checks: Sequence[tuple[str, DataFrame, Sequence[Rule]]]) -> DataFrame:
    """K6: one row per (model, rule) with its violation count.

    The row rules of a model and its (first) uniqueness rule share one pass;
    any further uniqueness rule is a pass of its own. Nothing is collected.
    """
    parts: list[DataFrame] = []
    for model, df, rules in checks:
        keyed = [r for r in rules if r.kind in ("unique", "unique_combination")]
        for group in ([r for r in rules if r not in keyed[1:]], *([r] for r in keyed[1:])):
            stack = F.explode(F.array(*[
                F.struct(F.lit(model).alias("model"), F.lit(r.label).alias("rule"),
                         F.col(f"r{i}").cast("bigint").alias("violations")) for i, r in enumerate(group)]))
            parts.append(_counts(df, group).select(stack.alias("s")).select("s.*"))
    if not parts:
        raise ValueError("no rules given")
    return reduce(DataFrame.unionByName, parts)


class CheckFailed(RuntimeError):
    pass


def gate(checks: Sequence[tuple[str, DataFrame, Sequence[Rule]]],
         allow: Iterable[tuple[str, str]] = ()) -> DataFrame:
    """K5: evaluate the rules and raise if any fails (except allowed ones).

    Returns the report as a computed frame when all pass. It has one row per
    rule, so collecting it is bounded by the rule count.
    """
    rows = report(checks).collect()
    allowed = set(allow)
    failed = [r for r in rows if r["violations"] > 0 and (r["model"], r["rule"]) not in allowed]
    if failed:
        raise CheckFailed("; ".join(f"{r['model']}: {r['rule']} -> {r['violations']} rows" for r in failed))
    return checks[0][1].sparkSession.createDataFrame(rows, REPORT_SCHEMA)


# The reference's declared tests, by model (31 rules).
REFERENCE_SUITE: dict[str, list[Rule]] = {
    "stg_observations": [not_null("wmo_station_id"), not_null("timestamp")],
    "stg_forecasts": [not_null("wmo_station_id"), not_null("forecast_timestamp")],
    "stg_stations": [not_null("wmo_station_id"), not_null("geometry")],
    "stg_postal_codes": [unique("postal_code"), not_null("postal_code")],
    "station_area_map": [unique_combination("postal_code", "wmo_station_id"),
                         not_null("postal_code"), not_null("wmo_station_id"), not_null("station_rank")],
    "cleaned_observations": [unique_combination("postal_code", "observation_hour", "wmo_station_id"),
                             accepted_range("temperature", -60.0, 60.0),
                             accepted_range("relative_humidity", 0, 100)],
    "cleaned_forecasts": [unique_combination("postal_code", "forecast_hour", "wmo_station_id"),
                          accepted_range("temperature", -60.0, 60.0)],
    "hourly_observations": [unique_combination("postal_code", "observation_hour"),
                            not_null("postal_code"), not_null("observation_hour"),
                            accepted_range("temperature", -60.0, 60.0),
                            accepted_range("precipitation", 0, 1000),
                            accepted_range("relative_humidity", 0, 100),
                            accepted_range("wind_speed", 0, 200)],
    "hourly_forecasts": [unique_combination("postal_code", "forecast_hour"),
                         not_null("postal_code"), not_null("forecast_hour"),
                         accepted_range("temperature", -60.0, 60.0),
                         accepted_range("precipitation", 0, 1000),
                         accepted_range("relative_humidity", 0, 100),
                         accepted_range("wind_speed", 0, 200)],
}

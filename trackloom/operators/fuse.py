"""Fusion of features onto the roster: authority, anomalies, summaries and KPIs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NO_DATA = "NO_DATA"


def is_ok(status: Column) -> Column:
    return F.coalesce(status == "OK", F.lit(False))


def by_authority(*values: tuple[Column, Column]) -> Column:
    """The value of the first ``(usable, value)`` whose condition holds; NO_DATA without any."""
    return F.coalesce(*[F.when(usable, value) for usable, value in values], F.lit(NO_DATA))


def door_anomaly(state: Column) -> Column:
    s = F.lower(F.coalesce(state, F.lit("")))
    return s.contains("damage") | (s.contains("open") & ~s.contains("partial"))


def unit_anomalies(kind: Column, left: Column, right: Column, damaged: Column, identifier: Column, load: Column) -> Column:
    """The ordered list of what is wrong with a unit. A missing identifier or load counts for the core kind only."""
    core = kind == "WAGON"
    return F.array_compact(F.array(
        F.when(door_anomaly(left), F.concat(F.lit("LEFT DOOR "), F.upper(left))),
        F.when(door_anomaly(right), F.concat(F.lit("RIGHT DOOR "), F.upper(right))),
        F.when(F.lower(left).contains("partial") | F.lower(right).contains("partial"), "PARTIAL DOOR"),
        F.when(damaged, "DAMAGE"),
        F.when(core & identifier.isNull(), "NO IDENTIFIER"),
        F.when(core & (load.isNull() | (load == NO_DATA)), "NO LOAD DATA"),
    ))


def conditional_counts(df: DataFrame, group: Sequence[str], tests: dict[str, Column]) -> DataFrame:
    """One pass over the rows: a count for each named test."""
    return df.groupBy(*group).agg(F.count("*").alias("total"), *[F.count_if(c).alias(n) for n, c in tests.items()])


def state_histogram(df: DataFrame, group: Sequence[str], states: Sequence[str]) -> DataFrame:
    """Rows by state over several state columns together."""
    return df.select(*group, F.explode(F.array(*[F.coalesce(F.col(s), F.lit(NO_DATA)) for s in states])).alias("state")).groupBy(*group, "state").agg(F.count("*").alias("n"))


def rake_type(loaded: Column, empty: Column) -> Column:
    return F.when((loaded == 0) & (empty == 0), "N/A").when(loaded >= empty, "LOADED").otherwise("EMPTY")


def rejection_summary(df: DataFrame, camera: str, position: str, severity: str) -> DataFrame:
    """Counts by camera, position and severity, with all subtotals, in one pass by grouping sets."""
    return df.cube(camera, position, severity).agg(F.count("*").alias("n"), F.grouping_id().cast("long").alias("level"))


def suppress_for_loaded(observations: DataFrame, loads: DataFrame, key: str, kind: str, state: str, suppressed: str = "floor_damage") -> DataFrame:
    """Drops observations of one kind for units whose load is LOADED; without load data they stay."""
    loaded = loads.where(F.col(state) == "LOADED").select(key).distinct().withColumn("__loaded", F.lit(True))
    hidden = F.coalesce((F.col(kind) == suppressed) & F.col("__loaded"), F.lit(False))
    return observations.join(loaded, key, "left").where(~hidden).select(*observations.columns)

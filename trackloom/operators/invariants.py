"""What must hold of a fused result, checked while it is written.

A check is a condition on the rows of one table, which windows over a batch have made ready; ``observe`` counts the rows that break it, with the least example,
in the same pass that writes the table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

Names = Sequence[str]


class InvariantError(RuntimeError):
    """A strict write broke an invariant; ``broken`` has ``(table, check, rows, example)``, and nothing was left behind."""

    def __init__(self, broken: list[tuple[str, str, int, str]]):
        super().__init__("; ".join(f"{t}.{c}: {n} row(s), such as {e}" for t, c, n, e in broken))
        self.broken = broken


@dataclass
class Checked:
    """A table, the conditions that its rows must not meet, what names a row in a report, and the columns that only serve the checks."""

    table: str
    rows: DataFrame
    broken: dict[str, Column]
    name: Column
    helpers: list[str] = field(default_factory=list)

    def observed(self) -> tuple[DataFrame, Observation]:
        seen = Observation(f"checks of {self.table}")
        measures = []
        for check, bad in self.broken.items():
            bad = F.coalesce(bad, F.lit(False))
            measures += [F.count_if(bad).alias(check), F.min(F.when(bad, self.name)).alias(f"{check} example")]
        return self.rows.observe(seen, *measures).drop(*self.helpers), seen

    def report(self) -> DataFrame:
        """``(table, check, broken, example)``, a row for each check, without writing anything."""
        measures = [F.struct(F.lit(self.table).alias("table"), F.lit(c).alias("check"), F.count_if(F.coalesce(b, F.lit(False))).alias("broken"), F.min(F.when(b, self.name)).alias("example")) for c, b in self.broken.items()]
        return self.rows.agg(F.array(*measures).alias("r")).select(F.inline("r"))


def gap_checks(gaps: DataFrame, masters: DataFrame, group: Names, master: str, supports: Sequence[str]) -> Checked:
    """Of the global boundaries ``(group, gap_id, camera, key, frame)``: as many as the ``masters(group, key)`` have, each from the master camera and none from a support, ids
    1 to N, in the order of frames."""
    w = Window.partitionBy(*group)
    n = masters.groupBy(*group).agg(F.count("*").alias("__masters"))
    rows = gaps.withColumn("__n", F.count("*").over(w)).withColumn("__no", F.row_number().over(w.orderBy("gap_id"))).withColumn("__before", F.lag("frame").over(w.orderBy("gap_id")))
    rows = rows.join(n, list(group), "left")
    broken = {
        "GAP_COUNT": (F.col("__no") == 1) & (F.col("__n") != F.coalesce("__masters", F.lit(0))),
        "GAP_WITHOUT_MASTER": F.col("key").isNull(),
        "GAP_OF_ANOTHER_CAMERA": F.col("key").isNotNull() & ~F.col("camera").eqNullSafe(F.lit(master)),
        "SUPPORT_AS_MASTER": F.col("camera").isin(*supports) if supports else F.lit(False),
        "GAP_IDS": ~F.col("gap_id").eqNullSafe(F.col("__no")),
        "GAP_ORDER": F.col("frame") < F.col("__before"),
    }
    return Checked("gaps", rows, broken, F.concat_ws(":", *group, "gap_id"), ["__n", "__no", "__before", "__masters"])


def unit_checks(units: DataFrame, gaps: DataFrame, windows: DataFrame, group: Names) -> Checked:
    """Of the units ``(group, unit_id, start_frame, end_frame)``: no more than gaps and one, as many as the window ``(group, unit_count, segments, outside)`` says, none with the span of a
    leading or trailing segment (``outside``: an array of start and end), every segment either a unit or outside, not more segments than gaps allow, and ids GW_1 to GW_N in
    the order of frames. Batches without units are in no row, so they are not judged here."""
    w = Window.partitionBy(*group)
    rows = units.withColumn("__n", F.count("*").over(w)).withColumn("__no", F.row_number().over(w.orderBy("start_frame", "unit_id")))
    rows = rows.join(gaps.groupBy(*group).agg(F.count("*").alias("__gaps")), list(group), "left").join(windows.select(*group, F.struct("unit_count", "segments", "outside").alias("__w")), list(group), "left")
    first, most = F.col("__no") == 1, F.coalesce("__gaps", F.lit(0)) + 1
    broken = {
        "UNIT_COUNT": first & (F.col("__n") > most),
        "WINDOW_COUNT": first & (F.col("__n") != F.col("__w.unit_count")),
        "SEGMENT_BALANCE": first & (F.col("__n") + F.size("__w.outside") != F.col("__w.segments")),
        "TOO_MANY_SEGMENTS": first & (F.col("__w.segments") > most),
        "UNIT_OUTSIDE": F.exists("__w.outside", lambda o: (o["start"] == F.col("start_frame")) & (o["end"] == F.col("end_frame"))),
        "UNIT_IDS": ~F.col("unit_id").eqNullSafe(F.concat(F.lit("GW_"), F.col("__no").cast("string"))),
    }
    return Checked("units", rows, broken, F.concat_ws(":", *group, "unit_id"), ["__n", "__no", "__gaps", "__w"])


def camera_checks(cameras: DataFrame, gaps: DataFrame, group: Names) -> Checked:
    """Of each support camera ``(group, camera, raw, aligned, excluded, excluded_told, matched, matched_gaps, extra)``: what was aligned is a match or extra, what was not is excluded and told, and
    no global boundary is matched twice or by more rows than there are."""
    rows = cameras.join(gaps.groupBy(*group).agg(F.count("*").alias("__gaps")), list(group), "left")
    broken = {
        "ALIGNED_BALANCE": F.col("matched") + F.col("extra") != F.col("aligned"),
        "RAW_BALANCE": F.col("aligned") + F.col("excluded") != F.col("raw"),
        "EXCLUDED_UNTOLD": F.col("excluded") != F.col("excluded_told"),
        "OVER_MATCHED": F.col("matched") > F.coalesce("__gaps", F.lit(0)),
        "MATCHED_TWICE": F.col("matched_gaps") < F.col("matched"),
    }
    return Checked("cameras", rows, broken, F.concat_ws(":", *group, "camera"), ["__gaps"])


def _remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def write_checked(folder: str, tables: Sequence[Checked], strict: bool = True) -> list[tuple[str, str, int, str | None]]:
    """Writes each table to ``folder/<table>`` and gives ``(table, check, rows, example)`` for every check.

    Strict, a broken check raises ``InvariantError`` once all tables are judged, and the folder goes: a reader never finds a result that is known to be wrong. Else
    the result stands and the caller has the record. The folder must not exist yet. A table without rows breaks nothing.
    """
    record = []
    spark = tables[0].rows.sparkSession
    try:
        for checked in tables:
            rows, seen = checked.observed()
            rows.write.mode("error").parquet(f"{folder}/{checked.table}")
            found = seen.get
            record += [(checked.table, c, int(found.get(c) or 0), found.get(f"{c} example")) for c in checked.broken]
    except Exception:
        _remove(spark, folder)
        raise
    broken = [r for r in record if r[2]]
    if strict and broken:
        _remove(spark, folder)
        raise InvariantError(broken)
    return record

import os

import pytest

from trackloom.operators import invariants as V

GAPS = "b int, gap_id long, camera string, key long, frame long"
UNITS = "b int, unit_id string, start_frame long, end_frame long"
WINDOWS = "b int, unit_count long, segments long, outside array<struct<start:bigint,end:bigint>>"
CAMERAS = "b int, camera string, raw long, aligned long, excluded long, excluded_told long, matched long, matched_gaps long, extra long"
GOOD = {
    "gaps": [(1, k + 1, "main", 100 + k, 50 * (k + 1)) for k in range(3)],
    "masters": [(1, 100 + k) for k in range(3)],
    "units": [(1, "GW_1", 50, 99), (1, "GW_2", 100, 149)],
    "windows": [(1, 2, 4, [(0, 49), (150, 200)])],
    "cameras": [(1, "side", 5, 4, 1, 1, 3, 3, 1)],
}
#: What breaks each check, and how many rows it finds.
BAD = {
    "GAP_COUNT": ("masters", [(1, 100)], 1), "GAP_WITHOUT_MASTER": ("gaps", [*GOOD["gaps"][:2], (1, 3, "main", None, 150)], 1), "GAP_OF_ANOTHER_CAMERA": ("gaps", [*GOOD["gaps"][:2], (1, 3, "other", 102, 150)], 1),
    "SUPPORT_AS_MASTER": ("gaps", [(1, 1, "side", 100, 50), *GOOD["gaps"][1:]], 1), "GAP_IDS": ("gaps", [(b, i + 1, *r) for b, i, *r in GOOD["gaps"]], 3), "GAP_ORDER": ("gaps", [(1, 1, "main", 100, 60), (1, 2, "main", 101, 50), (1, 3, "main", 102, 70)], 1),
    "UNIT_COUNT": ("units", [(1, f"GW_{k}", k, k) for k in range(1, 6)], 1), "WINDOW_COUNT": ("windows", [(1, 3, 4, [(0, 49), (150, 200)])], 1), "SEGMENT_BALANCE": ("windows", [(1, 2, 4, [(0, 49)])], 1),
    "TOO_MANY_SEGMENTS": ("windows", [(1, 2, 5, [(0, 49), (150, 200), (201, 202)])], 1), "UNIT_OUTSIDE": ("windows", [(1, 2, 4, [(50, 99), (150, 200)])], 1), "UNIT_IDS": ("units", [(1, "GW_2", 50, 99), (1, "GW_1", 100, 149)], 2),
    "ALIGNED_BALANCE": ("cameras", [(1, "side", 5, 4, 1, 1, 3, 3, 0)], 1), "RAW_BALANCE": ("cameras", [(1, "side", 6, 4, 1, 1, 3, 3, 1)], 1), "EXCLUDED_UNTOLD": ("cameras", [(1, "side", 5, 4, 1, 0, 3, 3, 1)], 1),
    "OVER_MATCHED": ("cameras", [(1, "side", 5, 4, 1, 1, 4, 4, 0)], 1), "MATCHED_TWICE": ("cameras", [(1, "side", 5, 4, 1, 1, 3, 2, 1)], 1),
}


def tables(spark, **other):
    d = {n: spark.createDataFrame(other.get(n, GOOD[n]), s) for n, s in (("gaps", GAPS), ("masters", "b int, key long"), ("units", UNITS), ("windows", WINDOWS), ("cameras", CAMERAS))}
    return [V.gap_checks(d["gaps"], d["masters"], ["b"], "main", ["side"]), V.unit_checks(d["units"], d["gaps"], d["windows"], ["b"]), V.camera_checks(d["cameras"], d["gaps"], ["b"])]


def test_a_sound_result_is_written_as_it_is(spark, tmp_path):
    record = V.write_checked(f"{tmp_path}/out", tables(spark))
    assert len(record) == len(BAD) == 17 and {c for _, c, *_ in record} == set(BAD) and not any(n for *_, n, _ in record)
    assert spark.read.parquet(f"{tmp_path}/out/units").columns == [c.split()[0] for c in UNITS.split(", ")]
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out/gaps").select("b", "gap_id", "camera", "key", "frame").collect())) == GOOD["gaps"]


@pytest.mark.parametrize("check", BAD)
def test_each_check_fails_alone(spark, tmp_path, check):
    name, rows, n = BAD[check]
    record = {c: (k, e) for _, c, k, e in V.write_checked(f"{tmp_path}/warn", tables(spark, **{name: rows}), strict=False)}
    assert record[check][0] == n and record[check][1].startswith("1:")
    assert os.path.isdir(f"{tmp_path}/warn/units")
    with pytest.raises(V.InvariantError) as error:
        V.write_checked(f"{tmp_path}/strict", tables(spark, **{name: rows}))
    assert check in {c for _, c, *_ in error.value.broken} and not os.path.exists(f"{tmp_path}/strict")


def test_reports_without_writing_and_empty_tables(spark, tmp_path):
    gaps = tables(spark, gaps=BAD["GAP_ORDER"][1])[0]
    assert {r.check: r.broken for r in gaps.report().collect()}["GAP_ORDER"] == 1
    assert not any(n for *_, n, _ in V.write_checked(f"{tmp_path}/none", tables(spark, gaps=[], masters=[], units=[], windows=[], cameras=[])))

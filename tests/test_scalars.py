import pytest
from pyspark.sql import functions as F

from trackloom.functions import scalars as S


def value(spark, column):
    return spark.range(1).select(column).first()[0]


def box(*v):
    return tuple(F.lit(float(x)) for x in v)


@pytest.mark.parametrize(("a", "b", "expected"), [((0, 0, 2, 2), (1, 1, 3, 3), 1 / 7), ((0, 0, 1, 1), (5, 5, 6, 6), 0.0), ((2, 2, 1, 1), (0, 0, 0, 0), 0.0), ((0, 0, 2, 2), (0, 0, 2, 2), 1.0)])
def test_iou(spark, a, b, expected):
    assert value(spark, S.iou(box(*a), box(*b))) == pytest.approx(expected)


def test_local_frames_are_never_clamped(spark):
    frame = lambda t: value(spark, S.local_frame(F.lit(t), F.lit(1.0), F.lit(10.0), F.lit(100)))
    assert [frame(t) for t in (0.0, 1.0, 1.25, 1.35, 10.9, 11.0)] == [None, 0, 2, 4, 99, None]


def test_ranges_are_clamped_or_null(spark):
    def span(a, b):
        return tuple(value(spark, c) for c in S.local_range(F.lit(a), F.lit(b), F.lit(0.0), F.lit(10.0), F.lit(100)))

    assert span(-5.0, 1.0) == (0, 9) and span(9.0, 20.0) == (90, 99) and span(20.0, 30.0) == (None, None) and span(-5.0, -1.0) == (None, None)


@pytest.mark.parametrize(("number", "errors", "corrected"), [("31123456789", [], "31123456789"), ("3112345678", ["length"], "3112345678"), ("41123456789", ["type"], "11123456789"), ("3112345678x", ["not numeric"], "3112345678x")])
def test_numbers(spark, number, errors, corrected):
    assert value(spark, S.number_errors(F.lit(number))) == errors
    assert value(spark, S.corrected_number(F.lit(number))) == corrected


def test_names(spark):
    assert value(spark, S.formatted_number(F.lit("31123456789"))) == "31 12 34 5678 9"
    name = S.slot(F.lit(4), F.lit("TOP__A"))
    assert (value(spark, name), value(spark, S.slot_track(name)), value(spark, S.slot_camera(name))) == ("track_4__TOP__A", 4, "TOP__A")
    assert value(spark, S.slot_track(F.lit("track_9"))) == 9 and value(spark, S.slot_camera(F.lit("track_9"))) is None
    assert value(spark, S.natural_key(F.lit("GW_10"))) == 10
    assert str(value(spark, S.batch_time(F.lit("cam_20240102_030405.mp4")))) == "2024-01-02 03:04:05"
    assert value(spark, S.batch_time(F.lit("cam.mp4"))) is None


@pytest.mark.parametrize(("state", "shown"), [(None, "UNKNOWN"), (" ", "UNKNOWN"), ("partial_open", "PARTIAL OPEN"), ("opened", "OPEN")])
def test_door_status(spark, state, shown):
    assert value(spark, S.door_status(F.lit(state).cast("string"))) == shown


def test_labels_follow_the_order_of_rules(spark):
    rules = [("brake", "BRAKE_VAN"), ("engine", "ENGINE")]
    assert value(spark, S.by_substring(F.lit("Engine brake van"), rules)) == "BRAKE_VAN"
    assert value(spark, S.by_substring(F.lit(None).cast("string"), rules)) == "UNKNOWN"
    assert value(spark, S.canonical(F.lit(" shut "), {"SHUT": "CLOSED"})) == "CLOSED"

import random

import brute_force
import pytest
from pyspark.sql import functions as F

from tarmac.functions import aircraft_type, delay_minutes, model_label, seconds_of_day, tuple_line


def values(spark, texts, build):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in rows.select("i", build(F.col("t")).alias("v")).orderBy("i").collect()]


def test_seconds_of_day(spark):
    expected = {
        "12:34:56": 45296,
        "00:00:00": 0,
        "23:59:59": 86399,
        "1:2:3": 3723,
        "25:10:00": 90600,
        "99:99:99": 99 * 3660 + 99,
        "12:34:56x": 45296,
        "12:34:56 ": 45296,
        "12:34:567": 12 * 3600 + 34 * 60 + 567,
        " 12:34:56": 45296,
        "12: 34:\t56": 45296,
        "012:34:56": 45296,
        "100:00:00": 360000,
        "2147483647:59:59": 2147483647 * 3600 + 3599,
        "2147483648:00:00": None,
        "99999999999999999999:00:00": None,
        "12:34": None,
        "12:34:": None,
        "12 :34:56": None,
        "x12:34:56": None,
        "12-34-56": None,
        "": None,
        "abc": None,
        None: None,
    }
    assert values(spark, expected, seconds_of_day) == list(expected.values())


def test_seconds_of_random_texts(spark):
    pick = random.Random(7)
    usual = [f"{pick.randrange(100):02}:{pick.randrange(100):02}:{pick.randrange(100):02}" for _ in range(1000)]
    changed = []
    for text in usual:
        at = pick.randrange(len(text) + 1)
        changed.append(text[:at] + pick.choice(["", " ", "\t", ":", "0", "77", "x", "-"]) + text[at + pick.randrange(2) :])
    noise = ["".join(pick.choices("0123: \tx\n", k=pick.randrange(12))) for _ in range(1000)]
    texts = usual + changed + noise
    assert values(spark, texts, seconds_of_day) == [brute_force.seconds(t) for t in texts]


@pytest.mark.parametrize(
    "scheduled, actual, of_hour, total",
    [
        ("10:00:00", "10:15:30", 15, 15),
        ("10:00:00", "11:15:00", 15, 75),
        ("10:00:00", "11:00:00", None, 60),
        ("10:00:00", "12:00:59", None, 120),
        ("10:00:00", "12:01:00", 1, 121),
        ("10:00:00", "10:00:59", None, None),
        ("10:00:00", "10:01:00", 1, 1),
        ("10:00:00", "10:00:00", None, None),
        ("10:15:00", "10:00:00", None, None),
        ("10:15:00", "08:14:59", None, None),
        ("23:50:00", "00:10:00", None, None),
        ("23:50:00", "24:10:00", 20, 20),
        ("10:00:00", "", None, None),
        ("", "10:00:00", None, None),
        ("10:00:00", None, None, None),
    ],
)
def test_delay_minutes(spark, scheduled, actual, of_hour, total):
    row = spark.createDataFrame([(scheduled, actual)], "s string, a string").select(
        delay_minutes(F.col("s"), F.col("a")).alias("of_hour"),
        delay_minutes(F.col("s"), F.col("a"), "total").alias("total"),
    )
    assert row.first() == (of_hour, total)
    assert row.dtypes == [("of_hour", "bigint"), ("total", "bigint")]


def test_delay_minutes_rejects_other_units():
    with pytest.raises(ValueError):
        delay_minutes(F.lit("a"), F.lit("b"), "hours")


def test_model_label(spark):
    expected = {
        "T210L": "Cessna 210",
        "172N": "Cessna 172",
        "A150-K152": "Cessna 150",
        "U1 50X": "Cessna 1 5",
        "T-41A": "Cessna 41",
        "SKYHAWK": "Cessna ",
        "": "Cessna ",
        "1721": "Cessna 172",
        None: None,
    }
    assert values(spark, expected, model_label) == list(expected.values())
    assert values(spark, ["T210L"], lambda c: model_label(c, "Model ")) == ["Model 210"]


def test_aircraft_type_keeps_percent_signs(spark):
    rows = spark.createDataFrame([("A%B", "7%7"), (None, "1"), ("", "")], "m string, n string")
    assert [r[0] for r in rows.select(aircraft_type(F.col("m"), F.col("n"))).collect()] == ["A%B 7%7", None, " "]


def test_tuple_line(spark):
    rows = spark.createDataFrame([("X", 3, None), ("", 0, "a,b")], "a string, b bigint, c string")
    lines = [r[0] for r in rows.select(tuple_line(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert lines == ["(X,3,null)", "(,0,a,b)"]

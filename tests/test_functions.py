"""Date and rounding helpers."""

from conftest import d
from pyspark.sql import functions as F

from cohortwise.functions.dates import full_years
from cohortwise.functions.rounding import round_to
from cohortwise.operators.report import mean_1dp


def test_full_years(spark):
    cases = [
        ("2000-02-29", "2001-02-28", 0),
        ("2000-02-29", "2001-03-01", 1),
        ("1950-06-15", "2000-06-14", 49),
        ("1950-06-15", "2000-06-15", 50),
        ("2000-06-15", "1990-06-16", -9),
        ("2000-06-15", "1990-06-15", -10),
    ]
    df = spark.createDataFrame([(d(b), d(e)) for b, e, _ in cases], "b date, e date")
    got = [r.y for r in df.select(full_years("e", "b").alias("y")).collect()]
    assert got == [y for _, _, y in cases]


def test_rounding(spark):
    df = spark.createDataFrame([(15, 4), (25, 1), (-5, 2), (49, 4), (1, 3)], "s long, c long")
    out = df.select(round_to("s").alias("r"), mean_1dp(F.col("s"), F.col("c")).alias("m")).collect()
    assert [r.r for r in out] == [20, 30, -10, 50, 0]
    assert [r.m for r in out] == [3.8, 25.0, -2.5, 12.3, 0.3]

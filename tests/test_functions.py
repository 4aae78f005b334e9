import pytest
from pyspark.sql import functions as F

from traitlab.functions.dates import normalise_date_col, normalise_job_date
from traitlab.functions.text import before_first, split_dropping_trailing


@pytest.mark.parametrize("text,expected", [
    ("20180709", 20180709),
    ("20180732", 20180801),   # day past month end rolls over
    ("20181301", 20190101),   # month 13 rolls into next year
    ("20180100", 20171231),   # day 0 is the last day of the previous month
    ("20180229", 20180301),   # not a leap year
    ("20160229", 20160229),
])
def test_normalise_job_date(spark, text, expected):
    assert normalise_job_date(text) == expected
    got = spark.createDataFrame([(text,)], "t string").select(
        normalise_date_col(F.col("t")).alias("d")).first()["d"]
    assert int(got) == expected


def test_normalise_malformed_is_null(spark):
    got = spark.createDataFrame([("2018xx09",), ("",)], "t string").select(
        normalise_date_col(F.col("t")).alias("d")).collect()
    assert [r["d"] for r in got] == [None, None]


def test_split_drops_trailing_empty_fields(spark):
    rows = spark.createDataFrame([("a:1:",), ("a::",), ("::",), ("a::b",), ("",)], "t string")
    got = [r["s"] for r in rows.select(split_dropping_trailing(F.col("t"), ":").alias("s")).collect()]
    assert got == [["a", "1"], ["a"], [""], ["a", "", "b"], [""]]


def test_before_first(spark):
    rows = spark.createDataFrame([("11:5",), ("abc",), (":1",)], "t string")
    got = [r["k"] for r in rows.select(before_first(F.col("t"), ":").alias("k")).collect()]
    assert got == ["11", "abc", ""]

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ordermill.functions.dates import normalize_date_str, parse_date, spark_pattern
from ordermill.operators import validate as V


def _parse(spark, values, fmt="%Y-%m-%d"):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    return [r[0] for r in df.select(parse_date(F.col("s"), fmt)).collect()]


def test_strftime_translation():
    assert spark_pattern("%Y-%m-%d") == "yyyy-M-d"
    assert spark_pattern("%d %b %Y") == "d MMM yyyy"
    assert spark_pattern("yyyy/MM/dd") == "yyyy/MM/dd"


def test_strict_and_fallback_formats(spark):
    d = dt.datetime(2025, 10, 25)
    got = _parse(spark, ["2025-10-25", "2025-1-5", "2025/10/25", "10/25/2025", "25/10/2025",
                         "25 Oct 2025", "20251025", "2025-10-25T13:45:00"])
    assert got[:1] == [d]
    assert got[1] == dt.datetime(2025, 1, 5)
    assert got[2:7] == [d] * 5
    assert got[7] == dt.datetime(2025, 10, 25, 13, 45)


def test_fallback_is_per_row_and_deterministic(spark):
    # pandas guesses one format from the first failed row; here each row parses on its own.
    assert _parse(spark, ["10/25/2025", "2025/10/25"]) == [dt.datetime(2025, 10, 25)] * 2
    # ambiguous day/month is always month first
    assert _parse(spark, ["01/02/2025"]) == [dt.datetime(2025, 1, 2)]


def test_wider_fallback(spark):
    d = dt.datetime(2025, 10, 25)
    texts = ["2025/10/25 10:00:00", "10/25/2025 10:00", "October 25, 2025", "Oct 25, 2025", "25-Oct-2025", "25-10-2025",
             "2025.10.25", "25 October 2025", "10-25-2025", "2025-10-25 10:00 PM"]
    hours = [10, 10, 0, 0, 0, 0, 0, 0, 0, 22]
    assert _parse(spark, texts) == [d.replace(hour=h) for h in hours]


def test_an_offset_is_applied(spark):
    assert _parse(spark, ["2025-10-25T23:30:00+02:00", "2025-10-25T23:30:00Z", "2025-10-25 23:30:00 -01:00"]) == [
        dt.datetime(2025, 10, 25, 21, 30), dt.datetime(2025, 10, 25, 23, 30), dt.datetime(2025, 10, 26, 0, 30)]


def test_rejects(spark):
    assert _parse(spark, ["2025-02-30", "12:00", "2025", "garbage", None, ""]) == [None] * 6


def test_formatless_mode(spark):
    assert _parse(spark, ["2025/10/25", "x"], fmt=None) == [dt.datetime(2025, 10, 25), None]


def test_parse_date_column_split(spark):
    df = spark.createDataFrame([(1, "2025-10-25"), (2, "10/26/2025"), (3, "bad"), (4, None)],
                               "id long, order_date string")
    good, bad = V.parse_date_column(df, "order_date")
    g = {r["id"]: (r["order_date"], r["_date_recovered"]) for r in good.collect()}
    assert g == {1: (dt.datetime(2025, 10, 25), False), 2: (dt.datetime(2025, 10, 26), True)}
    assert dict(good.dtypes)["order_date"] == "timestamp_ntz"
    b = {r["id"]: (r["order_date"], r["_parse_error"]) for r in bad.collect()}
    assert b == {3: ("bad", "Flexible parsing also failed"), 4: (None, "Flexible parsing also failed")}


def test_missing_date_column_raises(spark):
    df = spark.createDataFrame([(1,)], "id long")
    with pytest.raises(KeyError):
        V.parse_date_column(df, "order_date")


def test_normalize_date_str():
    assert normalize_date_str("2025-10-25") == "20251025"
    assert normalize_date_str("20251025") == "20251025"


def test_blanks_around_a_date_are_recovered(spark):
    df = spark.createDataFrame([(1, " 2025-10-25 "), (2, "2025-10-25")], "id long, order_date string")
    good, bad = V.parse_date_column(df, "order_date")
    rows = {r["id"]: (r["order_date"], r["_date_recovered"]) for r in good.collect()}
    assert rows == {1: (dt.datetime(2025, 10, 25), True), 2: (dt.datetime(2025, 10, 25), False)}
    assert bad.count() == 0


def test_day_first_and_ambiguous_rows_are_parsed_separately(spark):
    # pandas would guess day-first for both from the first row; here each row
    # parses on its own: 25/10 can only be day-first, 01/02 is month-first.
    assert _parse(spark, ["25/10/2025", "01/02/2025"]) == [dt.datetime(2025, 10, 25), dt.datetime(2025, 1, 2)]


def test_order_evidence_is_that_of_the_shapes(spark):
    from ordermill.functions import dates

    firsts, seps = ("0", "1", "5", "12", "13", "19", "25", "31", "99", "123"), "/.-"
    texts = [f"{a}{s}{b}{t}{y}" for a in firsts for b in firsts for s in seps for t in (s, "/") for y in ("1995", "95", "69", "1995 10:00", "#", "199", "19955")]
    texts += ["Monday 25/10/1995", " 10/25/1995 ", "a25/10/1995", "25/10", "", None]
    shape = dates._shape(dates._plain(F.col("t")))
    want = F.when(shape.rlike(r"^D([/.-])9\1#"), F.lit(dates.DAY_FIRST)).when(shape.rlike(r"^9([/.-])D\1#"), F.lit(dates.MONTH_FIRST))
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", dates.order_evidence(F.col("t")).alias("got"), want.alias("want"))
    assert got.where("NOT got <=> want").collect() == [] and got.where("got IS NOT NULL").count() > 100

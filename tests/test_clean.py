from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from starweave.functions.dates import elapsed_days, parse_ts
from starweave.functions.text import normalize_key, strip_ws
from starweave.operators import clean


def test_drop_columns_strict(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert clean.drop_columns(df, ["a"]).columns == ["b"]
    with pytest.raises(KeyError):
        clean.drop_columns(df, ["zz"])


def test_fill_unknown_any_type(spark):
    df = spark.createDataFrame([(None, None, "x")], "a int, d date, s string")
    out = clean.fill_unknown(df)
    assert rows(out) == [("unknown", "unknown", "x")]


def test_recode_small_unmatched_and_null_pass(spark):
    df = spark.createDataFrame([("TX",), ("ZZ",), (None,)], "s string")
    out = clean.recode(df, "s", {"TX": "Texas"})
    assert rows(out) == [("Texas",), ("ZZ",), (None,)]


def test_recode_lookup_last_entry_wins(spark):
    lookup = spark.createDataFrame([(1, "01001", "First"), (2, "01001", "Later"), (3, "02000", "Other")],
                                   "seq int, code string, label string")
    df = spark.createDataFrame([("01001",), ("99999",), (None,)], "fips string")
    out = clean.recode_lookup(df, "fips", lookup)
    assert rows(out) == [("99999",), ("Later",), (None,)]


def test_try_cast_is_ansi_safe(spark):
    df = spark.createDataFrame([("12",), ("unknown",)], "x string")
    assert rows(clean.try_cast_columns(df, {"x": "int"})) == [(12,), (None,)]


def test_cast_bool_columns(spark):
    df = spark.createDataFrame([("1", "true"), ("0", "unknown")], "a string, b string")
    assert rows(clean.cast_bool_columns(df, ["a", "b"])) == [(False, None), (True, True)]


def test_drop_null_keys_reaches_scan(spark, tmp_path):
    p = str(tmp_path / "t")
    spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string").write.parquet(p)
    df = clean.drop_null_keys(spark.read.parquet(p), ["k"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(k)" in plan and "PushedFilters" in plan
    assert rows(df) == [(1, "a")]


def test_elapsed_days_floor_vs_calendar_days(spark):
    df = spark.createDataFrame(
        [(datetime(2020, 1, 1, 20), datetime(2020, 1, 2, 4)), (datetime(2020, 1, 2), datetime(2020, 1, 1, 23))],
        "b timestamp_ntz, e timestamp_ntz",
    )
    out = df.select(elapsed_days("b", "e").alias("floor_days"), F.datediff("e", "b").alias("cal_days"))
    assert [tuple(r) for r in out.collect()] == [(0, 1), (-1, -1)]


def test_derive_duration_zero_day_imputed_in_range(spark):
    df = spark.createDataFrame(
        [(i, datetime(2020, 1, 1), datetime(2020, 1, 1, 5) if i % 2 else datetime(2020, 1, 3)) for i in range(200)],
        "id int, b timestamp_ntz, e timestamp_ntz",
    )
    out = clean.derive_duration(df, "b", "e", "dur", 1, ["id"])
    got = {r.id: r.dur for r in out.collect()}
    assert all(1 <= got[i] <= 24 for i in range(1, 200, 2))
    assert all(got[i] == 48 for i in range(0, 200, 2))
    again = {r.id: r.dur for r in clean.derive_duration(df.repartition(5), "b", "e", "dur", 1, ["id"]).collect()}
    assert got == again


def test_duration_fallback(spark):
    df = spark.createDataFrame([(datetime(2020, 1, 1).date(), datetime(2020, 1, 3).date(), None), (None, None, 5)],
                               "b date, e date, d int")
    assert rows(clean.duration_fallback(df, "b", "e", "d")) == rows(
        spark.createDataFrame([(datetime(2020, 1, 1).date(), datetime(2020, 1, 3).date(), 48), (None, None, 5)], "b date, e date, d int"))


def test_parse_lenient_and_strict(spark):
    df = spark.createDataFrame([("2020-01-02T03:04:05Z",), ("unknown",)], "s string")
    out = df.select(parse_ts("s").alias("t"))
    assert [r.t is None for r in out.collect()] == [False, True]
    with pytest.raises(Exception):
        df.select(parse_ts("s", strict=True).alias("t")).collect()


def test_text_normalisation(spark):
    df = spark.createDataFrame([("  ab c ",), ("\tx\n",)], "s string")
    assert [tuple(r) for r in df.select(normalize_key("s"), strip_ws("s")).collect()] == [("AB C", "ab c"), ("\tX\n", "x")]


def test_drop_null_keys_drops_nan_like_pandas(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), "b"), (None, "c")], "k double, v string")
    assert rows(clean.drop_null_keys(df, ["k"])) == [(1.0, "a")]


def test_to_date_lenient(spark):
    from datetime import date

    from starweave.functions.dates import to_date_lenient

    df = spark.createDataFrame([("2020-01-02",), ("2020-01-02T03:04:05Z",), ("unknown",), (None,)], "s string")
    got = [r[0] for r in df.select(to_date_lenient("s")).collect()]
    assert got == [date(2020, 1, 2), date(2020, 1, 2), None, None]

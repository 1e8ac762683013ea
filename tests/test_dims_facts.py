from datetime import date

from conftest import rows
from pyspark.sql import functions as F

from starweave.operators.constraints import check_unique
from starweave.plans.dimensions import DimensionSpec, build_dimension
from starweave.plans.facts import KeyLookup, build_fact

LOAD = "2024-01-01 00:00:00"
STATE = DimensionSpec("state_dim", "state_tk", ("country_name",), ("state_name",), ("state_name", "country_name"),
                      unknown={"state_name": "UNKNOWN", "country_name": "UNKNOWN"}, reserved={"country_name": "UNKNOWN"})


def _state_dim(spark):
    db = spark.createDataFrame([("TEXAS", "HARRIS"), ("IOWA", "POLK")], "state_name string, country_name string")
    csv = spark.createDataFrame([("texas", "HARRIS"), ("X", "UNKNOWN"), ("Y", None), ("OHIO", "ADAMS")],
                                "state_name string, country_name string")
    return build_dimension([db, csv], STATE, LOAD)


def test_dimension_members_keys_and_unknown(spark):
    dim = _state_dim(spark)
    got = {(r.state_tk, r.state_name, r.country_name) for r in dim.collect()}
    assert got == {(0, "UNKNOWN", "UNKNOWN"), (1, "OHIO", "ADAMS"), (2, "TEXAS", "HARRIS"), (3, "IOWA", "POLK")}
    assert check_unique(dim, ["country_name"]).count() == 0
    assert dim.columns == ["state_tk", "version", "date_from", "date_to", "state_name", "country_name"]


def test_fact_rows_equal_staging_rows_and_unknown_is_zero(spark):
    dim = _state_dim(spark)
    staging = spark.createDataFrame(
        [(" harris ", 3, 1), ("polk", 4, 2), ("unknown", 5, 3), (None, 6, 4), ("nowhere", 7, 5), ("polk", 4, 6)],
        "country_name string, deaths int, rid long",
    )
    fact = build_fact(staging, [KeyLookup(dim, "state_tk", (("country_name", "country_name"),), normalize=True)],
                      ["deaths"], "fact_tk", row_id=["rid"])
    got = rows(fact)
    assert len(got) == staging.count()
    assert got == [(0, 5, 1), (0, 6, 2), (0, 7, 3), (2, 3, 4), (3, 4, 5), (3, 4, 6)]


def test_composite_key_dimension(spark):
    spec = DimensionSpec("dates", "dates_tk", ("b", "e"), ("dur",), unknown={"dur": 0})
    src = spark.createDataFrame(
        [(date(2020, 1, 1), date(2020, 1, 2), 24), (date(2020, 1, 1), date(2020, 1, 2), None),
         (date(2020, 1, 1), date(2020, 1, 3), None), (None, date(2020, 1, 3), 1)],
        "b date, e date, dur int",
    )
    dim = build_dimension([src], spec, LOAD)
    got = sorted((r.dates_tk, r.b, r.e, r.dur) for r in dim.collect())
    assert got == [(0, None, None, 0), (1, date(2020, 1, 1), date(2020, 1, 2), 24), (2, date(2020, 1, 1), date(2020, 1, 3), None)]


def test_fact_plan_broadcasts_small_dimensions(spark):
    dim = _state_dim(spark)
    name = F.when(F.col("id") % 2 == 0, F.lit("polk")).otherwise(F.lit("harris"))
    staging = spark.range(0, 100).select(name.alias("country_name"), F.lit(1).alias("deaths"), F.col("id").alias("rid"))
    from starweave.plans.facts import resolve_keys

    out = resolve_keys(staging, [KeyLookup(dim, "state_tk", (("country_name", "country_name"),), normalize=True)], ["deaths"])
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()

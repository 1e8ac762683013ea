"""Plan shape: pushdown, pruning, pre-shuffle reduction, no single-task numbering of base rows."""

import re

from pyspark.sql import functions as F

from starweave.operators import joins, keys
from starweave.plans import scenario as S
from starweave.plans.facts import resolve_keys
from starweave.sources import files

D = "/root/testdata/sf0.01"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_reduces_before_shuffle(spark):
    plan = _plan(keys.first_by_attributes(S.declaration_sources(spark, D)[1], ["declaration_request_number"]))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_flat_line_read_is_pruned_and_filter_pushed(spark):
    src = S.declaration_sources(spark, D)[1]
    plan = _plan(src)
    scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "lines" in ln][0]
    assert "PushedFilters: [IsNotNull(is_test), EqualTo(is_test,true)]" in scan
    schema = scan.split("ReadSchema: ")[1]
    assert "l_quantity" not in schema and "p_type" not in schema


def test_numbering_reads_sizes_and_rows_from_the_same_files(spark):
    df = spark.range(0, 200000).select((F.col("id") * 7919 % 200000).alias("k"))
    plan = _plan(keys.dense_number(df, ["k"], "tk", partitions=8))
    # rows come numbered from files: no range exchange is left that could be evaluated twice
    assert "rangepartitioning" not in plan and plan.count("FileScan parquet") == 2
    assert len([ln for ln in plan.splitlines() if "SinglePartition" in ln]) <= 1  # only the size table


def test_compressible_table_is_neither_broadcast_nor_sorted_in_one_task(spark):
    # 3 million wide rows that compress to almost nothing on disk
    wide = spark.range(0, 3_000_000).select((F.col("id") % 1000).alias("k"), F.lit("x" * 100).alias("a"), F.lit("y" * 100).alias("b"))
    written = files.materialize(wide, "compressible")
    count, size = files.measured(written)
    assert count == 3_000_000 and size > 600_000_000
    assert not joins.fits_broadcast(written)
    assert keys.range_partitions(spark, size) > 8
    fact = spark.range(0, 1000).select((F.col("id") % 1000).alias("f"))
    plan = joins.lookup_join(fact, written.select("k", "a"), [(F.col("f"), "k")], broadcast=joins.fits_broadcast(written))
    assert "ResolvedHint" not in plan._jdf.queryExecution().analyzed().toString()


def test_projections_scan_their_columns_only(spark):
    from starweave.plans.catalog import QUERIES

    for name, used in {"distinct_rows": {"o_custkey", "o_orderstatus"}, "synthetic_measure": {"o_orderkey"}, "recode_small": {"event_id", "event_type"},
                       "project_cols": {"c_custkey", "c_name", "c_mktsegment"}, "head_n": None, "cast_types": {"o_orderkey", "o_custkey", "o_orderstatus"}}.items():
        plan = _plan(QUERIES[name](spark, D))
        schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
        if used:
            assert {c.split(":")[0] for s in schemas for c in s.split(",")} == used, name
        if name not in ("distinct_rows", "head_n"):
            assert "Exchange" not in plan, name


def test_four_lookups_take_one_sampling_job(spark):
    S.written_dims(spark, D)
    lookups, staging = S.fact_lookups(spark, D), S.staging(spark, D)
    spark.conf.set("spark.starweave.broadcastBytes", "0")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lookups", "plan building only")
    try:
        resolve_keys(staging, lookups, ["deaths"])
        assert len(tracker.getJobIdsForGroup("lookups")) <= 3  # adaptive stages of one query
    finally:
        spark.conf.unset("spark.starweave.broadcastBytes")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_lines_carry_no_part_attributes(spark):
    ln = S.lines(spark, D)
    assert not [c for c in ln.columns if c.startswith("p_")]
    some = ln.select("l_orderkey", "l_partkey").limit(50).unionByName(spark.createDataFrame([(-1, -1), (-2, None)], "l_orderkey long, l_partkey long"))
    got = S.with_parts(spark, D, some).collect()
    assert len(got) == 52 and all((r.p_size is None) == (r.l_orderkey < 0) for r in got)


def test_rollup_samples_ahead_of_its_joins(spark, monkeypatch):
    from starweave.operators import history
    from starweave.plans import catalog

    seen = []
    monkeypatch.setattr(history, "fits_broadcast", lambda dim: False)
    monkeypatch.setattr(history, "hot_keys", lambda df, keys, **more: seen.append((_plan(df), more)) or {})
    want = sorted(map(tuple, catalog.fact_rollup(spark, D).collect()), key=str)
    assert len(seen) == 1 and seen[0][1] == {"fraction": 1.0}
    plan = seen[0][0]
    # the sample lies below the joins: no join of all staging rows stands under it
    assert "Sample" in plan and all("Join" not in x for x in plan[plan.index("Sample") :].split("Union")[0].splitlines()[1:])
    monkeypatch.undo()
    assert want == sorted(map(tuple, catalog.fact_rollup(spark, D).collect()), key=str)


def test_entities_sample_ahead_of_their_shuffles(spark, monkeypatch):
    from starweave.plans import normalize
    from starweave.plans import warehouse as W

    seen, original = [], joins.hot_keys

    def recorded(df, keys, *a, **k):
        seen.append((sorted(keys), _plan(df)))
        return original(df, keys, *a, **k)

    loaded = W.entities(spark, D)
    monkeypatch.setattr(joins, "hot_keys", recorded)
    monkeypatch.setattr(normalize, "hot_keys", recorded, raising=False)
    W.declarations(W.flat80(spark, D), loaded["Disaster"], loaded["State"], keep_unmatched=True)
    normalize.bridge(W.flat80(spark, D), loaded["Disaster"], "disaster_number", loaded["State"], "country_name")
    assert len(seen) == 2  # one sample for both lookups, each time
    assert all("Exchange" not in plan and len(names) == 2 for names, plan in seen)


def test_disasters_reduce_their_lines_before_parts_are_joined(spark, monkeypatch):
    from starweave.plans import warehouse as W
    from starweave.plans.normalize import append_entities

    table = S.table

    def parts_twice(spark, d, name, columns=None):
        got = table(spark, d, name, columns)
        if name != "part":
            return got
        more = got.where("p_partkey % 3 = 0").withColumn("p_type", F.concat(F.lit("A"), "p_type")).withColumn("p_size", (50 - F.col("p_size")).cast("int"))
        return got.where("p_partkey % 5 <> 0").unionByName(more)

    for tables in (table, parts_twice):  # as given; and with numbers that have no part or two
        monkeypatch.setattr(S, "table", tables)
        for sizes in (None, F.col("size") <= 45):
            flat = W.flat80(spark, D, parts=True)
            wide = append_entities(None, (flat if sizes is None else flat.filter(sizes)).select(*W.DISASTER_COLS), ["disaster_number"])
            assert sorted(map(tuple, W.disasters(spark, D, sizes).collect()), key=str) == sorted(map(tuple, wide.collect()), key=str)
    monkeypatch.undo()
    monkeypatch.setattr(W, "append_entities", lambda existing, rows, keys: rows)
    plan = _plan(W.disasters(spark, D))
    scans = plan[plan.index("Join") :]
    assert "WindowGroupLimit" in scans  # below the join


def test_entities_give_their_shuffles_back(spark, monkeypatch):
    import time

    from starweave import session
    from starweave.plans import warehouse as W

    def files_now():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {found.apply(i).getName() for i in range(found.size())}

    before, old = files_now(), spark.conf.get(session.SHUFFLE_CLEANUP, None)
    with session.shuffles_removed(spark):
        rows = spark.range(1000).repartition(5).groupBy((F.col("id") % 10).alias("k")).count()
        assert len(rows.collect()) == len(rows.collect()) == 10  # executed again, it is shuffled again
        end = time.time() + 20
        while (left := {n for n in files_now() - before if n.startswith("shuffle_")}) and time.time() < end:
            time.sleep(0.2)
        assert not left
    assert spark.conf.get(session.SHUFFLE_CLEANUP, None) == old
    monkeypatch.setattr(W, "_LOADED", {})
    monkeypatch.setattr(W, "load_entities", lambda spark, d: spark.conf.get(session.SHUFFLE_CLEANUP, None))
    assert W.entities(spark, D) == "true"

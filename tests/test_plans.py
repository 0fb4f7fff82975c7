"""Physical-plan guards: the properties the design relies on at scale."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
BAD = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython")


def _plan(spark, key):
    df = E.queries()[key](spark, SF)
    df.write.format("noop").mode("overwrite").save()     # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_cur_scan_prunes_and_pushes(spark):
    plan = _plan(spark, "aws_daily_cost_v1")
    scan = [ln for ln in plan.split("\n") if "FileScan" in ln or "Scan parquet" in ln]
    assert scan, plan
    assert any("PartitionFilters: [" in ln and "year" in ln and "month" in ln for ln in scan)
    assert any("line_item_usage_start_date" in ln.split("PushedFilters")[-1] for ln in scan)
    # raw lines go through hash aggregation; the sort-based one sees only per-key rows
    assert "HashAggregate" in plan


def test_gcp_scan_prunes_ingestion_dates(spark):
    plan = _plan(spark, "refresh_window_scan")
    assert "PartitionFilters: [" in plan and "partition_date" in plan


@pytest.mark.parametrize("key", ["aws_load", "service_level_billing", "monthly_invoice", "customer_daily_cost",
                                 "daily_org_pricing", "amortized_two_month", "report_coverage_gaps",
                                 "stream_incremental_daily"])
def test_no_nested_loops_or_python(spark, key):
    plan = _plan(spark, key)
    assert not [b for b in BAD if b in plan], plan


@pytest.mark.parametrize("key", ["cur_v2_period_scan", "aws_daily_cost_v2"])
def test_v2_scan_prunes_periods(spark, key):
    df = E.queries()[key](spark, SF)
    assert any("billing_period" in x for x in _filters(df))


@pytest.fixture(scope="module")
def month_tables(spark):
    import uuid

    from cloudcost import registry as R
    from cloudcost.plans import jobs
    from cloudcost.session import scratch_path
    f = R.Fixture(spark, SF)
    f.load_daily_tables()
    base = scratch_path(spark, f"plans-test-{uuid.uuid4().hex}")
    paths = {k: f"{base}/{k}" for k in ("aws", "gcp", "hw")}
    jobs.overwrite_partitions(f.aws_daily, paths["aws"], ["billing_month"])
    jobs.write_gcp_table(f.gcp_daily, paths["gcp"], [])
    jobs.overwrite_partitions(f.hw_daily, paths["hw"], ["billing_month"])
    return {k: jobs.read_table(spark, p) for k, p in paths.items()}


def _filters(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [ln.split("PartitionFilters: [")[1].split("]")[0] for ln in plan.split("\n") if "PartitionFilters: [" in ln]


def test_rollups_and_payer_costs_prune_months(month_tables):
    import datetime as dt

    from cloudcost.operators import rollup
    ws, we = dt.date(2001, 2, 1), dt.date(2001, 8, 15)
    for df in (rollup.rollup_aws(month_tables["aws"], ws, we, None), rollup.rollup_gcp(month_tables["gcp"], ws, we, None),
               rollup.rollup_huawei(month_tables["hw"], ws, we, None)):
        found = _filters(df)
        assert found and all("billing_month" in x for x in found)


def test_emptied_and_missing_tables(spark, tmp_path):
    import datetime as dt

    from cloudcost.plans import jobs
    schema = "m date, v int"
    rows = [(dt.date(2001, i, 1), i) for i in (1, 2, 3)]
    path = str(tmp_path / "t")
    assert jobs.read_table(spark, path) is None
    jobs.overwrite_partitions(spark.createDataFrame(rows, schema), path, ["m"])
    jobs.overwrite_partitions(spark.createDataFrame([(dt.date(2001, 3, 1), 9)], schema), path, ["m"],
                              [dt.date(2001, 2, 1), dt.date(2001, 3, 1)])
    assert sorted((r.m.month, r.v) for r in jobs.read_table(spark, path).collect()) == [(1, 1), (3, 9)]
    with pytest.raises(Exception):
        jobs.read_table(spark, "nosuchscheme://x/y")


def test_late_line_changes_its_whole_day(spark, tmp_path):
    import datetime as dt

    from cloudcost import registry as R
    from cloudcost.operators import daily
    from cloudcost.plans import jobs
    from pyspark.sql import functions as F
    export = R.Fixture(spark, SF).gcp_export.filter("partition_date between date'2001-07-20' and date'2001-07-28'")
    day = dt.date(2001, 7, 20)
    late = export.filter(F.to_date("usage_start_time") == F.lit(day)).withColumn("partition_date", F.lit(dt.date(2001, 7, 29)))
    landing, table = str(tmp_path / "landing"), str(tmp_path / "table")
    export.write.partitionBy("partition_date").parquet(landing)
    jobs.run_gcp_load(spark, landing, table, dt.date(2001, 7, 28), explicit_start=dt.date(2001, 7, 1))
    late.write.mode("append").partitionBy("partition_date").parquet(landing)
    jobs.run_gcp_load(spark, landing, table, dt.date(2001, 7, 29), explicit_start=dt.date(2001, 7, 29))
    want = daily.gcp_daily_cost(export.unionByName(late), dt.date(2001, 7, 1), dt.date(2001, 7, 31))
    got = jobs.read_table(spark, table).select(*daily.GCP_COLUMNS)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0

"""Runs that read only what is new: the page ledger, the stream, compaction, bucketed merges."""

import datetime as dt
import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cloudcost import registry as R
from cloudcost.operators import amortized, bucketed, daily, reports
from cloudcost.operators.merge import Batch, keyed_merge
from cloudcost.plans import compaction, jobs, tables
from cloudcost.sources import catalog, files, ledger
from cloudcost.sources import fixtures as fx
from cloudcost.streaming import incremental

SF = "/root/testdata/sf0.001"
d = dt.date


@pytest.fixture(scope="module")
def fixture(spark):
    return R.Fixture(spark, SF)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


# --- S5, F3: pages ------------------------------------------------------------------

def page(folder, name, *records):
    """Land one page: records as (day, cycle, customer, amount)."""
    os.makedirs(folder, exist_ok=True)
    rows = [{"bill_date": day, "cycle": cycle, "customer_id": who, "consume_amount": amount, "charge_mode": 1, "bill_type": 5,
             "resource_name": f"res-{amount}"} for day, cycle, who, amount in records]
    with open(f"{folder}/{name}", "w") as f:
        f.write(json.dumps({"monthly_records": rows, "total_count": len(rows), "currency": "EUR"}))


def amounts(spark, table):
    return sorted((str(r.bill_date), str(r.billing_month), r.customer_id, float(r.consume_amount))
                  for r in jobs.read_table(spark, table).collect())


def test_a_run_opens_only_new_pages(spark, tmp_path, monkeypatch):
    pages, table = str(tmp_path / "pages"), str(tmp_path / "t")
    page(pages, "a b.json", ("2001-07-02", "2001-07", "x", 10), ("2001-07-02", "2001-07", "x", 5))
    page(f"{pages}/deep", "b.json", ("2001-07-03", "2001-08", "y", 1))
    opened = []
    read = files.read_huawei_pages
    monkeypatch.setattr(files, "read_huawei_pages", lambda s, p, **kw: opened.append([os.path.basename(x) for x in p]) or read(s, p, **kw))
    run = lambda **kw: jobs.run_huawei_load(spark, pages, None, table, d(2001, 7, 25), **kw)
    assert run(first_run=True) == [d(2001, 7, 1), d(2001, 8, 1)]
    assert opened.pop() == ["a b.json", "b.json"]
    run()
    assert opened == []  # nothing new, nothing opened
    # a late record: its whole day, also before the window of the run
    page(pages, "c.json", ("2001-07-02", "2001-07", "x", 2), ("2001-05-09", "2001-05", "z", 3))
    run()
    assert opened.pop() == ["c.json"]
    assert amounts(spark, table) == [("2001-05-09", "2001-05-01", "z", 3.0), ("2001-07-02", "2001-07-01", "x", 17.0),
                                     ("2001-07-03", "2001-08-01", "y", 1.0)]
    scanned = read(spark, [f"{pages}/c.json"]).inputFiles()
    assert [os.path.basename(x) for x in scanned] == ["c.json"]


def test_a_page_that_lands_again_counts_once(spark, tmp_path):
    pages, table = str(tmp_path / "pages"), str(tmp_path / "t")
    run = lambda first=False: jobs.run_huawei_load(spark, pages, None, table, d(2001, 7, 25), first_run=first)
    page(pages, "a.json", ("2001-07-20", "2001-07", "x", 10), ("2001-07-21", "2001-07", "gone", 4))
    page(pages, "b.json", ("2001-07-20", "2001-07", "x", 1))
    run(True)
    page(pages, "a.json", ("2001-07-20", "2001-07", "x", 12.5), ("2001-07-22", "2001-07", "new", 6))
    run()
    run()
    assert amounts(spark, table) == [("2001-07-20", "2001-07-01", "x", 13.5), ("2001-07-21", "2001-07-01", "gone", 0.0),
                                     ("2001-07-22", "2001-07-01", "new", 6.0)]
    os.remove(f"{pages}/b.json")  # a file that was read may be archived
    run()
    assert ("2001-07-20", "2001-07-01", "x", 13.5) in amounts(spark, table)


def test_a_killed_run_leaves_nothing_behind(spark, tmp_path, monkeypatch):
    pages, table = str(tmp_path / "pages"), str(tmp_path / "t")
    page(pages, "a.json", ("2001-07-20", "2001-07", "x", 10))
    with monkeypatch.context() as m:
        m.setattr(ledger.PageLedger, "commit", lambda self, run: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            jobs.run_huawei_load(spark, pages, None, table, d(2001, 7, 25), first_run=True)
    page(pages, "b.json", ("2001-07-20", "2001-07", "x", 1))
    jobs.run_huawei_load(spark, pages, None, table, d(2001, 7, 25), first_run=True)
    assert amounts(spark, table) == [("2001-07-20", "2001-07-01", "x", 11.0)]
    assert jobs.huawei_ledger(spark, table, True).committed() == 0


def test_records_without_a_cycle_keep_their_rows(spark, tmp_path):
    pages, table = str(tmp_path / "pages"), str(tmp_path / "t")
    page(pages, "1.json", ("2001-07-14", None, "x", 1), ("2001-07-14", None, "y", 2), ("2001-07-14", "2001-07", "x", 3))
    assert jobs.run_huawei_load(spark, pages, None, table, d(2001, 7, 14), first_run=True) == [None, d(2001, 7, 1)]
    page(pages, "2.json", ("2001-07-28", None, "x", 4), ("2001-07-28", None, "y", 5))
    assert jobs.run_huawei_load(spark, pages, None, table, d(2001, 7, 28)) == [None]
    assert amounts(spark, table) == [("2001-07-14", "2001-07-01", "x", 3.0), ("2001-07-14", "None", "x", 1.0),
                                     ("2001-07-14", "None", "y", 2.0), ("2001-07-28", "None", "x", 4.0), ("2001-07-28", "None", "y", 5.0)]


def test_null_partitions_are_replaced_like_any_other(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = lambda *x: spark.createDataFrame(list(x), "m date, b date, v int")
    jobs.overwrite_partitions(rows((None, None, 1), (None, d(2001, 1, 1), 2), (d(2001, 1, 1), None, 3), (d(2001, 2, 1), None, 4)), path, ["m", "b"])
    jobs.overwrite_partitions(rows((None, None, 5)), path, ["m", "b"], [None, d(2001, 2, 1)])
    assert sorted(r.v for r in jobs.read_table(spark, path).collect()) == [3, 5]


def test_huawei_records_reach_a_hash_aggregate(fixture):
    lines = plan(daily.huawei_daily_cost(fixture.hw_records, R.WS, R.WE)).split("\n")
    kinds = [x.split("Aggregate(")[0].strip(" :+-") for x in lines if "Aggregate(" in x]
    # from the bottom: both phases of the hash aggregate over records, then the reduced rows
    assert kinds[-2:] == ["Hash", "Hash"] and set(kinds[:-2]) == {"Sort"}


# --- R1: stream ---------------------------------------------------------------------

def test_the_stream_reads_every_line_once(spark, fixture, tmp_path):
    landing, table, ckpt = (str(tmp_path / x) for x in ("landing", "table", "ckpt"))
    export = fixture.gcp_export
    late = export.filter(F.col("partition_date") >= F.lit(R.LATE_FROM)).withColumn("partition_date", F.date_add("partition_date", 2))
    early = export.filter(F.col("partition_date") < F.lit(R.LATE_FROM))
    # a day lands in many files and over several batches
    early.repartition(12).write.partitionBy("partition_date").parquet(landing)
    ws, we = R.WS, d(2001, 9, 1)
    assert incremental.gcp_incremental_load(spark, landing, table, ckpt, ws, we, files_per_trigger=60) == early.count()
    late.repartition(5).write.mode("append").partitionBy("partition_date").parquet(landing)
    assert incremental.gcp_incremental_load(spark, landing, table, ckpt, ws, we, files_per_trigger=60) == late.count()
    assert incremental.gcp_incremental_load(spark, landing, table, ckpt, ws, we) == 0
    want = daily.gcp_daily_cost(early.unionByName(late), ws, we)
    assert same(incremental.read_daily_table(spark, table), want)
    # a narrower window from the stored parts, without the export
    stream = os.listdir(f"{table}_parts")
    assert len(stream) == 1
    incremental.rebuild(spark, table, stream[0], ws, d(2001, 7, 10))
    assert same(incremental.read_daily_table(spark, table), daily.gcp_daily_cost(early.unionByName(late), ws, d(2001, 7, 10)))


def test_a_replayed_batch_changes_nothing(spark, fixture, tmp_path):
    table = str(tmp_path / "table")
    export = fixture.gcp_export
    half = F.pmod(F.xxhash64("cost", "usage_start_time"), F.lit(2))
    for batch_id, part in ((0, 0), (1, 1), (1, 1), (0, 0)):
        incremental.upsert_batch(export.filter(half == part), batch_id, "s", table, R.WS, R.WE)
    assert same(incremental.read_daily_table(spark, table), daily.gcp_daily_cost(export, R.WS, R.WE))


# --- F4, A8, U1: zones ----------------------------------------------------------------

def test_the_gcp_table_prunes_by_billing_month(spark, fixture, tmp_path):
    from cloudcost.operators import rollup
    path = str(tmp_path / "gcp")
    jobs.write_gcp_table(fixture.gcp_daily, path, [])
    table = jobs.read_gcp_table(spark, path)
    old = table.withColumn("usage_month", F.lit(d(1999, 1, 1))).withColumn("billing_month", F.lit(d(1999, 1, 1)))
    jobs.overwrite_partitions(old, path, jobs.GCP_ZONES)
    df = rollup.rollup_gcp(jobs.read_gcp_table(spark, path).drop("usage_month"), R.WS, R.WE, None)
    df.write.format("noop").mode("overwrite").save()
    filters = [x.split("PartitionFilters: [")[1].split("]")[0] for x in plan(df).split("\n") if "PartitionFilters: [" in x]
    assert filters and all("billing_month" in x for x in filters)
    scans = [x for x in plan(df).split("\n") if "Scan parquet" in x]
    assert scans and same(df, rollup.rollup_gcp(fixture.gcp_daily, R.WS, R.WE, None))


def test_a_key_whose_billing_month_changes_moves(spark, fixture, tmp_path):
    path = str(tmp_path / "gcp")
    jobs.write_gcp_table(fixture.gcp_daily, path, [])
    months = jobs.values_of(jobs.read_gcp_table(spark, path), "usage_month")
    shifted = fixture.gcp_daily.withColumn("billing_month", F.lit(d(2001, 12, 1)))
    jobs.write_gcp_table(shifted, path, months)
    got = jobs.read_gcp_table(spark, path).select(*daily.GCP_COLUMNS)
    assert same(got, shifted)


# --- K2-K5: bucketed merges ---------------------------------------------------------------

def test_the_target_of_a_bucketed_merge_is_not_shuffled(spark, fixture, tmp_path):
    batch = Batch(daily.aws_daily_cost_window(fixture.cur, R.cur_src.V1, R.WS, R.WE), daily.AWS_DESCRIPTORS + daily.AWS_INTERNAL)
    table = tables.aws_table(spark, "plan_target", str(tmp_path / "t"), batch.df.schema, 6)
    with jobs.staging(spark) as stage:
        table.merge([batch], stage)
        change, where = bucketed.deltas([batch], table.keys, table.columns)
        lines = plan(table.merged(stage(change), where, [d(2001, 7, 1), d(2001, 8, 1)])).split("\n")
    scan = next(i for i, x in enumerate(lines) if "plan_target" in x)
    assert "Bucketed: true" in lines[scan] and "billing_month" in lines[scan].split("PartitionFilters:")[1]
    depth = len(lines[scan]) - len(lines[scan].lstrip(" :+-*()0123456789"))
    above = []
    for x in reversed(lines[:scan]):
        at = len(x) - len(x.lstrip(" :+-*()0123456789"))
        if at < depth:
            above.append(x)
            depth = at
    assert any("SortMergeJoin" in x or "ShuffledHashJoin" in x for x in above) and not any("Exchange" in x for x in above)
    assert sum("Exchange" in x for x in lines) == 1  # the batch


def test_rows_to_merge_carry_a_column_once(spark):
    """Columns that the latest row of a key decides are not shuffled a second time as those of its first row."""
    schema = "k string, a int, b int"
    one, two = (spark.createDataFrame(r, schema) for r in ([("x", 1, 1), ("y", 1, 1)], [("x", 2, None), ("z", 2, 2)]))
    change, where = bucketed.deltas([Batch(one, ["a", "b"])], ["k"], ["k", "a", "b"])
    assert "first" not in change.columns and where == {"a": "own0", "b": "own0"}
    change, _ = bucketed.deltas([Batch(one, ["a"]), Batch(two, ["a", "b"])], ["k"], ["k", "a", "b"])
    assert change.schema["first"].dataType.names == ["b"]
    out = keyed_merge(one, [Batch(two, ["a", "b"])], ["k"])
    assert "min_by" not in plan(out)
    assert sorted(map(tuple, out.collect())) == [("x", 2, None), ("y", 1, 1), ("z", 2, 2)]
    out = keyed_merge(one, [Batch(two, ["a"]), Batch(one, ["b"])], ["k"])  # b: the first row, then its owner
    assert sorted(map(tuple, out.collect())) == [("x", 2, 1), ("y", 1, 1), ("z", 2, 2)]


def test_a_batch_alone_is_not_regrouped(spark):
    rows = spark.createDataFrame([("x", 1, None, 1), ("y", None, 2, 1)], "k string, a int, b int, at int")
    change, where = bucketed.deltas([Batch(rows, ["a"])], ["k"], ["k", "a", "b"])
    assert "Aggregate" not in plan(change) and "Exchange" not in plan(change)
    assert where == {"a": "own0"} and change.columns == ["k", "first", "own0", bucketed.KEY]
    assert sorted((r.k, r.first.b, r.own0.a) for r in change.collect()) == [("x", None, 1), ("y", 2, None)]
    twice = rows.unionByName(rows.withColumns({"a": F.lit(9), "at": F.lit(2)}))
    change, _ = bucketed.deltas([Batch(twice, ["a", "b"], "at")], ["k"], ["k", "a", "b"])  # the last of a key counts
    assert sorted((r.k, r.own0.a, r.own0.b) for r in change.collect()) == [("x", 9, None), ("y", 9, 2)]
    change, where = bucketed.deltas([Batch(rows, [])], ["k"], ["k", "a"])
    assert where == {} and sorted((r.k, r.first.a) for r in change.collect()) == [("x", 1), ("y", None)]


def test_a_replayed_batch_is_computed_once(spark, fixture):
    seen = spark.sparkContext.accumulator(0)

    def count(a):
        seen.add(1)
        return a
    rows = spark.createDataFrame([(d(2001, 1, 1), "x", 1), (d(2001, 2, 1), "y", 2)], "m date, k string, a int")
    batch = Batch(rows.withColumn("a", F.udf(count, "int")("a")), ["a"])
    other = Batch(rows.withColumn("a", F.lit(7)).filter("k = 'x'"), ["a"])

    def make(spark, name, path, schema, buckets):
        return bucketed.BucketedTable(spark, name, path, ["m", "k"], ["m", "k", "a"], "m", buckets).attach(schema)
    out = R._bucketed(fixture, make, [[batch], [other], [batch]])
    assert sorted((r.k, r.a) for r in out.collect()) == [("x", 1), ("y", 2)]
    assert seen.value == 2


def random_batches(spark, seed):
    import random
    rng = random.Random(seed)
    schema = "m date, k string, a int, b int, c string"

    def rows(n):
        keys = {(rng.choice([d(2001, 1, 1), d(2001, 2, 1), d(2001, 3, 1), None]), rng.choice(["x", "", None, "y", "zz"])) for _ in range(n)}
        return [(*k, rng.choice([None, 1, 2]), rng.randrange(9), rng.choice(["p", None])) for k in sorted(keys, key=str)]
    return [Batch(spark.createDataFrame(rows(rng.randint(1, 9)), schema), rng.choice([["a"], ["b", "c"], ["a", "b"], []])) for _ in range(5)]


@pytest.mark.parametrize("seed", range(3))
def test_bucketed_merges_equal_keyed_merges(spark, tmp_path, seed, monkeypatch):
    if seed == 2:  # all keys collide: the key columns decide
        monkeypatch.setattr(bucketed, "key_hash", lambda keys: F.lit(7).cast("long"))
    batches = random_batches(spark, seed)
    table = bucketed.BucketedTable(spark, f"small_{seed}", str(tmp_path / "t"), ["m", "k"], ["m", "k", "a", "b", "c"], "m", 3).attach(
        batches[0].df.schema)
    want = None
    for some in (batches[:2], batches[2:3], batches[3:], batches[3:]):
        with jobs.staging(spark) as stage:
            table.merge(some, stage)
        want = keyed_merge(want, some, ["m", "k"], ["m", "k", "a", "b", "c"]) if want is not None else \
            keyed_merge(None, some, ["m", "k"], ["m", "k", "a", "b", "c"])
    assert same(table.read(), want)
    again = bucketed.BucketedTable(spark, f"again_{seed}", table.path, table.keys, table.columns, "m", 3).attach(batches[0].df.schema)
    assert same(again.read(), want)  # found again by a new session's catalog


def test_jobs_into_bucketed_tables_equal_jobs_into_paths(spark, fixture, tmp_path):
    pages = str(tmp_path / "pages")
    aws, gcp, hw = (str(tmp_path / x) for x in ("aws", "gcp", "hw"))
    b_hw = tables.huawei_table(spark, "job_hw", str(tmp_path / "b_hw"), fixture.hw_daily.schema, 3)
    b_gcp = tables.gcp_table(spark, "job_gcp", str(tmp_path / "b_gcp"), fixture.gcp_daily.schema, 3)
    b_aws = tables.aws_table(spark, "job_aws", str(tmp_path / "b_aws"), fixture.aws_daily.schema, 3)
    landed = fx.landed_exports(spark, SF)
    for first, day in ((True, d(2001, 7, 12)), (False, d(2001, 7, 21))):
        page(pages, f"{day}.json", (str(day), "2001-07", "x", 1), ("2001-07-02", None, "y", day.day))
        for table in (hw, b_hw):
            jobs.run_huawei_load(spark, pages, None, table, day, first_run=first)
        for table in (gcp, b_gcp):
            jobs.run_gcp_load(spark, landed["gcp"], table, day, first_run=first)
        for table in (aws, b_aws):
            jobs.run_aws_load(spark, landed["cur"], [], [], table, day, first_run=first)
    for table, path in ((b_hw, hw), (b_gcp, gcp), (b_aws, aws)):
        assert same(table.read(), jobs.read_table(spark, path).select(*table.columns))
    with pytest.raises(ValueError):
        jobs.run_aws_load(spark, landed["cur"], [], [], b_aws, d(2001, 7, 21), cleanup=True)


# --- U2, R2 ---------------------------------------------------------------------------------

def test_two_months_amortized_in_one_scan(spark, fixture):
    df = amortized.amortized_two_month(fixture.cur, fixture.org_accounts, fx.AMORTIZED, R.AS_OF)
    scans = [x for x in plan(df).split("\n") if "FileScan" in x]
    assert sum("line_item_line_item_type" in x for x in scans) == 1 and len(scans) == 2
    assert "year" in scans[0].split("PartitionFilters: [")[1].split("]")[0]
    # an account that the dimension names twice counts for both entities, and once for the tag
    doubled = fixture.org_accounts.unionByName(spark.createDataFrame([("7", "ent-2"), ("7", "ent-3")], "account_id string, billing_entity string"))
    got = amortized.amortized_two_month(fixture.cur, doubled, fx.AMORTIZED, R.AS_OF)
    parts, seq = None, 0
    for y, m in ((2001, 8), (2001, 7)):
        for part in (amortized.amortized_cost_by_entity(fixture.cur, doubled, fx.AMORTIZED, y, m),
                     amortized.amortized_cost_tagged(fixture.cur, fx.AMORTIZED, y, m)):
            seq += 1
            part = part.withColumn("seq", F.lit(seq))
            parts = part if parts is None else parts.unionByName(part)
    assert same(got, parts.groupBy("usage_date", "billing_entity").agg(F.max_by("cost", "seq").alias("cost")))


def test_gaps_from_bitmaps(spark, fixture):
    import random
    rng = random.Random(6)
    days = {("a", d(2000, 12, 31)), ("a", d(2003, 1, 1)), ("one", d(2004, 2, 29)), (None, d(2001, 1, 1)), (None, d(2001, 1, 3)),
            ("old", d(1899, 12, 30)), ("old", d(1900, 1, 2))}
    days |= {("r", d(2003, 1, 1) + dt.timedelta(days=rng.randrange(900))) for _ in range(300)}
    days |= {("leap", d(2004, 1, 1) + dt.timedelta(days=i)) for i in range(366) if i not in (0, 63, 64, 127, 128, 319, 320, 364)}
    want = set()
    for who in {w for w, _ in days}:
        own = {x for w, x in days if w == who}
        at = min(own)
        while at < max(own):
            if at not in own:
                want.add((who, at))
            at += dt.timedelta(days=1)
    table = spark.createDataFrame(list(days) + list(days) + [("a", None)], "usage_account_id string, usage_date date")
    got = reports.report_coverage_gaps(table)
    assert {(r.account_id, r.missing_day) for r in got.collect()} == want and got.count() == len(want)
    text = plan(reports.report_coverage_gaps(fixture.aws_daily))
    assert "Window" not in text and "SortAggregate" not in text
    assert sum("Exchange hashpartitioning" in x for x in text.split("\n")) == 2  # bitmaps by year, then an account's years


# --- F2: compaction -----------------------------------------------------------------------------

def test_compaction_bounds_files_and_keeps_rows(spark, tmp_path):
    path = str(tmp_path / "parts")
    rows = spark.range(4000).select((F.col("id") % 3).cast("int").alias("a"), F.when(F.col("id") % 2 == 0, F.lit(d(2001, 1, 1))).alias("m"),
                                    F.col("id").alias("v"))
    for i in range(6):
        rows.filter(F.col("v") % 6 == i).repartition(3).write.mode("append").partitionBy("a", "m").parquet(path)
    rows.filter("a = 0").withColumn("a", F.lit(9)).coalesce(1).write.mode("append").partitionBy("a", "m").parquet(path)
    calm = {f for f in os.listdir(f"{path}/a=9/m=2001-01-01")}
    want = spark.createDataFrame(spark.read.parquet(path).collect(), spark.read.parquet(path).schema)
    assert compaction.compact(spark, path, ["a", "m"]) == 6
    counts = {(r.p0, r.p1): r.files for r in compaction.partition_files(spark, path, ["a", "m"]).collect()}
    assert set(counts.values()) == {1} and len(counts) == 8
    assert {f for f in os.listdir(f"{path}/a=9/m=2001-01-01")} == calm  # not opened, not rewritten
    assert same(spark.read.parquet(path).select(*want.columns), want)
    assert compaction.compact(spark, path, ["a", "m"]) == 0 and compaction.compact(spark, str(tmp_path / "none"), ["a"]) == 0


# --- S7: catalog tables --------------------------------------------------------------------------

def test_catalog_tables_are_reconciled(spark, fixture):
    mk = lambda schema, row: spark.createDataFrame([row], schema)
    out = catalog.reconciled([mk("a int, b date, e double", (1, d(2001, 1, 1), 0.5)), mk("b timestamp, a decimal(12,2), c string", (dt.datetime(2001, 1, 2), Decimal(2), "z"))])
    assert out.columns == ["a", "b", "e", "c"] and dict(out.dtypes)["b"] == "timestamp" and dict(out.dtypes)["a"].startswith("decimal")
    assert sorted((float(r.a), r.e, r.c) for r in out.collect()) == [(1.0, 0.5, None), (2.0, None, "z")]
    with pytest.raises(ValueError, match="column a"):
        catalog.reconciled([mk("a int", (1,)), mk("a string", ("1",))])


def test_catalog_scans_prune_partitions(spark, fixture):
    database = "external_plan_test"
    fx.create_external_database(spark, SF, database, fixture.cur)
    names = catalog.catalog_tables(spark, database, fx.CUR_EXT_PREFIX, {fx.EXCLUDED_CUR_TABLE})
    assert names == [f"{database}.cur_ext_{i}" for i in range(3)]
    rows = catalog.union_catalog_tables(spark, names).filter(R.cur_src.period_predicate(R.cur_src.V1, 2001, 7))
    scans = [x for x in plan(rows).split("\n") if "FileScan" in x]
    assert len(scans) == 3 and all("year" in x.split("PartitionFilters: [")[1].split("]")[0] for x in scans)


# --- S8: relational scan ---------------------------------------------------------------------------

def test_date_bounds_are_pushed_and_sliced(spark, tmp_path):
    from cloudcost.sources import relational
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(d(2001, 1, 1) + dt.timedelta(days=i), f"k{i % 3}", i, "x") for i in range(90)] + [(None, "k1", -1, "x")],
                                 "day date, k string, v long, wide string")
    rows.write.parquet(path)
    schema = rows.select("day", "k", "v").schema
    read = lambda lo=d(2001, 1, 1), hi=d(2001, 12, 31): relational.read_date_slices(spark, path, schema, "day", lo, hi, days=7)
    df = read().filter("day >= date'2001-01-10' and day < date'2001-02-01' and k = 'k1'")
    assert sorted(r.v for r in df.collect()) == [i for i in range(9, 31) if i % 3 == 1]
    assert df.rdd.getNumPartitions() == 4  # 10 to 31 January in slices of seven days
    text = plan(df)
    assert "k#" in text.split("Filter")[1] and "day#" not in text.split("Filter (")[1].split("\n")[0]
    assert read().filter("day = date'2001-03-01' and day > date'2001-02-28'").count() == 1
    assert read().filter("day > date'2005-01-01'").count() == 0 and read().count() == 90
    assert read(d(2001, 1, 5), d(2001, 1, 6)).count() == 2


# --- F6, F7 ------------------------------------------------------------------------------------------

def test_invoice_and_customer_cost_jobs_read_their_months_alone(spark, fixture, tmp_path, monkeypatch):
    paths = {k: str(tmp_path / k) for k in ("slb", "aws", "pricing", "billings", "cc")}
    jobs.overwrite_partitions(fixture.slb.withColumn("usage_month", F.trunc("usage_date", "MM")), paths["slb"], ["usage_month"])
    jobs.overwrite_partitions(fixture.aws_daily, paths["aws"], ["billing_month"])
    jobs.run_daily_pricing(spark, fixture.pricing_rows, paths["pricing"], R.AS_OF)
    seen = []
    monkeypatch.setattr(jobs.billing, "monthly_invoice", lambda slb, *a: seen.extend([slb, a[3]]) or (_ for _ in ()).throw(StopIteration))
    monkeypatch.setattr(jobs.billing, "customer_daily_cost", lambda slb, *a: seen.extend([slb, a[4]]) or (_ for _ in ()).throw(StopIteration))
    with pytest.raises(StopIteration):
        jobs.run_monthly_invoice(spark, paths["slb"], fixture.products, fixture.organizations, fixture.product_accounts, paths["pricing"],
                                 fixture.pricing_rows, paths["billings"], R.AS_OF)
    with pytest.raises(StopIteration):
        jobs.run_customer_cost(spark, paths["slb"], paths["aws"], fixture.products, fixture.organizations, fixture.product_accounts,
                               paths["pricing"], fixture.amortized, fixture.billing_entity_map, paths["cc"], R.AS_OF)
    assert len(seen) == 4
    for df, col in zip(seen, ["usage_month", "pricing_month"] * 2):
        assert f"{col}" in plan(df).split("PartitionFilters: [")[1].split("]")[0]

"""Exports are landed when a query reads them, from narrow rows, in tasks and files whose size is bounded."""

import datetime as dt
import glob
import os

from pyspark.sql import functions as F

from cloudcost import registry as R
from cloudcost.plans import jobs
from cloudcost.session import shuffles_freed
from cloudcost.sources import fixtures as fx
from cloudcost.sources.files import read_huawei_pages, write_huawei_pages
from cloudcost.sources.ledger import PageLedger

SF = "/root/testdata/sf0.001"


def test_a_query_lands_what_it_reads(spark):
    exports = fx._LANDED[(spark.sparkContext.applicationId, SF)] = fx.LandedExports(spark, SF)
    for key in [k for k in fx._LANDED_DF if k[1] == SF]:
        del fx._LANDED_DF[key]
    R.queries()["latest_invoice_number"](spark, SF).collect()
    assert set(exports) == {"existing_billings"}
    R.queries()["gcp_daily_cost"](spark, SF).collect()
    assert set(exports) == {"existing_billings", "gcp", "gcp_schema"}
    assert sorted(os.listdir(exports.base)) == ["dim_existing_billings", "gcp"]


def test_a_large_period_is_written_by_several_tasks(spark, tmp_path):
    source = fx._cur_source(spark, SF).withColumn(
        "_bm", fx.F.expr("date_add(date'2001-08-01', l_linenumber - l_linenumber)"))
    files = str(tmp_path / "source")  # a partition is split by the tasks that wrote to it
    source.repartition(6).write.parquet(files)
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        rows = fx._as_cur(fx._with_period(fx._gathered(spark.read.parquet(files), "_bm")))
        rows.write.partitionBy("year", "month").parquet(str(tmp_path / "cur"))
    finally:
        if before is None:
            spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        else:
            spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len(glob.glob(str(tmp_path / "cur" / "year=2001" / "month=8" / "*.parquet"))) > 2
    assert spark.read.parquet(str(tmp_path / "cur")).count() == source.count()


def test_pages_land_compressed_and_are_found(spark, tmp_path):
    records = fx.huawei_records(spark, SF)
    pages = str(tmp_path / "pages")
    write_huawei_pages(records, pages)
    assert glob.glob(f"{pages}/*.json.gz") and not glob.glob(f"{pages}/*.json")
    got = read_huawei_pages(spark, pages)
    assert got.exceptAll(records).count() == 0 and got.count() == records.count()
    ledger = PageLedger(spark, str(tmp_path / "ledger"), "bill_month")
    assert ledger.pending(pages).count() == len(glob.glob(f"{pages}/*.json.gz"))


def test_page_parts_are_gathered_by_month(spark, tmp_path):
    pages, table = str(tmp_path / "pages"), str(tmp_path / "table")
    write_huawei_pages(fx.huawei_records(spark, SF), pages)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # few rows, many tasks
    try:
        jobs.run_huawei_load(spark, pages, None, table, R.HISTORY[1], first_run=True, explicit_start=R.HISTORY[0])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    ledger = jobs.huawei_ledger(spark, table, True)
    for months in (glob.glob(f"{ledger.base}/parts/run=0/bill_month=*"), glob.glob(f"{table}/billing_month=*")):
        assert len(months) > 12 and all(len(glob.glob(f"{m}/*.parquet")) == 1 for m in months)
    assert ledger.withdrawn(0) is None
    want = R.daily.huawei_daily_cost(fx.huawei_records(spark, SF), *R.HISTORY)
    assert jobs.read_table(spark, table).select(want.columns).exceptAll(want).count() == 0
    assert jobs.read_table(spark, table).count() == want.count()


def _shuffle_files(spark) -> set:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {n for n in names if n.startswith("shuffle_")}


def test_written_tables_leave_no_shuffles(spark, tmp_path):
    """Shuffles of a landed or staged table go with the write, whoever else writes meanwhile."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = _shuffle_files(spark), spark.conf.get(setting, None)
    rows = spark.range(2000).select((F.col("id") % 7).alias("k"), F.lit(dt.date(2001, 7, 1)).alias("m"))
    with jobs.staging(spark) as stage:
        assert len(stage(rows.groupBy("k", "m").count()).collect()) == 7
        jobs.overwrite_partitions(rows.repartition(3, "k"), str(tmp_path / "t"), ["m"])
        jobs.overwrite_partitions(rows.repartition(3, "k"), str(tmp_path / "t"), ["m"])
    assert not _shuffle_files(spark) - before
    assert spark.conf.get(setting, None) == was
    with shuffles_freed(spark):
        with shuffles_freed(spark):
            pass
        assert spark.conf.get(setting) == "true"
    assert spark.conf.get(setting, None) == was
    assert jobs.read_table(spark, str(tmp_path / "t")).count() == 2000

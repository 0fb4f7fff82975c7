"""Runnable jobs: read the current tables, compute, write back only what changed.

Daily and service-level tables are partitioned by month. A run aggregates its refresh
window, stages the new daily rows under the shared checkpoint folder, and takes the months
to rewrite from the rows themselves: a bill or usage month may lie outside the window.
Exactly those months are read from the table, merged and replaced (dynamic partition
overwrite after a second staging: Spark cannot overwrite what it is reading). Months that
a delete or purge empties are removed. A killed run leaves the old partitions in place up
to the overwrite; a re-run is idempotent.

Huawei pages are read once: a ledger of landed files (``<table>_pages_*``) keeps what was read
from each as partial sums, and a run opens only files that are new or were landed again.

The daily tables may be given as ``BucketedTable`` instead of paths: their months are merged
without a shuffle of the table and replaced in one step.

Google usage days arrive over several ingestion days. Their partial sums are kept by
ingestion day (``<table>_parts_*``): a run replaces the ingestion days of its window there
and rolls the touched usage days up from all their parts, so a late line changes its whole
day, however late it lands.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import add_months, first_of_month, previous_month, refresh_window, rollup_window
from ..operators import daily
from ..operators.bucketed import BucketedTable
from ..operators.merge import Batch, append_new, keyed_merge
from ..session import COMPRESSION, scratch_path, shuffles_freed
from ..sources import cur as cur_src
from ..sources import files
from ..sources.ledger import PageLedger
from . import billing, loads

_NO_TABLE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
GCP_ZONES = ["usage_month", "billing_month"]
_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None before its first run (no folder or no files)."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if str(e.getCondition()).split(".")[0] in _NO_TABLE:
            return None
        raise


def months_between(lo: dt.date, hi: dt.date) -> list[dt.date]:
    """First days of the months from ``lo`` to ``hi`` (a short, bounded list)."""
    out, m = [], first_of_month(lo)
    while m <= hi:
        out.append(m)
        m = add_months(m, 1)
    return out


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder on whatever store it lies."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def staging(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Gives ``stage``, which writes a table below the shared folder and reads it back; the
    tables are removed when the run is over."""
    paths = []

    def stage(df: DataFrame) -> DataFrame:
        paths.append(scratch_path(spark, f"staging-{uuid.uuid4().hex}"))
        with shuffles_freed(spark):
            df.write.parquet(paths[-1], compression=COMPRESSION)
        return spark.read.schema(df.schema).parquet(paths[-1])
    try:
        yield stage
    finally:
        for path in paths:
            delete_folder(spark, path)


def values_of(df: DataFrame, col: str) -> list:
    """Distinct values of a date column in order, null first (bounded by the calendar)."""
    return in_order(r[0] for r in df.select(col).distinct().collect())


def in_order(values: Iterable) -> list:
    """Distinct values in order, null first."""
    return sorted(set(values), key=lambda v: (v is not None, v if v is not None else dt.date.min))


def is_one_of(col: str, values: Iterable) -> Column:
    """``col`` is one of ``values``, null among them; written so that partitions prune."""
    values = list(values)
    known = F.col(col).isin(*[v for v in values if v is not None])
    return known | F.col(col).isNull() if None in values else known


def overwrite_partitions(df: DataFrame, path: str, partition_by: list[str], replace: Iterable = (),
                         gather: bool = False) -> None:
    """Stage ``df`` if there is a table (cuts its lineage to the table it may read), replace the
    partitions present in it, then remove what is left of ``replace`` (values of the first partition
    column whose old partitions end with this run) and not in ``df``. With ``gather`` the
    final write rebalances by partition, so that few tasks write into a folder."""
    spark = df.sparkSession
    old = read_table(spark, path)
    with staging(spark) as stage:
        # before the first run there is no table that ``df`` could read
        staged = df if old is None else stage(df)
        gone = []
        if old is not None and list(replace):
            kept = staged.select(*partition_by).distinct()
            # partitions of a few months; a null value is a partition like any other
            same = [F.col(f"o.{c}").eqNullSafe(F.col(f"k.{c}")) for c in partition_by]
            gone = (old.filter(is_one_of(partition_by[0], replace)).select(*partition_by).distinct().alias("o")
                    .join(kept.alias("k"), same, "left_anti").collect())
        final = staged.hint("rebalance", *partition_by) if gather else staged
        with shuffles_freed(spark):
            (final.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(*partition_by).parquet(path, compression=COMPRESSION))
    for row in gone:
        delete_folder(spark, "/".join([path, *(f"{c}={_NULL_PARTITION if row[c] is None else row[c]}"
                                               for c in partition_by)]))


def _of_months(existing: DataFrame | None, col: str, months: list[dt.date]) -> DataFrame | None:
    # a column of null partitions alone has no type of its own
    return None if existing is None else existing.filter(is_one_of(col, months)).withColumn(col, F.col(col).cast("date"))


def run_aws_load(spark: SparkSession, cur_path: str, external_tables: list[str], view_tables: list[str],
                 table_path: str | BucketedTable, as_of: dt.date, first_run: bool = False, cleanup: bool = False,
                 v2_paths: Iterable[str] = (), new_tables: Iterable[str] = (),
                 explicit_start: dt.date | None = None) -> list[dt.date]:
    """the internal CUR (v1) and further internal v2 exports, external CUR tables and
    amortized views from the catalog, merged into the daily table's months.

    ``new_tables``: paths or names that are loaded for the first time and therefore
    back-fill, whatever the other tables do. ``explicit_start`` sets the window's start for
    all. Returns the billing months rewritten."""
    new = set(new_tables)

    def window(name: str) -> tuple[dt.date, dt.date]:
        return refresh_window(as_of, "AWS", first_run or name in new, explicit_start)
    inputs = [loads.AwsInput(cur_src.read_cur(spark, cur_path), "internal", window(cur_path))]
    inputs += [loads.AwsInput(cur_src.read_cur(spark, p), "internal", window(p), cur_src.V2) for p in v2_paths]
    for kind, names in (("external", external_tables), ("view", view_tables)):
        # tables of one window are one scan; a key lies in one of them
        for w in sorted({window(n) for n in names}):
            inputs.append(loads.AwsInput(loads.union_tables(spark, [n for n in names if window(n) == w]), kind, w))
    with staging(spark) as stage:
        if isinstance(table_path, BucketedTable):
            if cleanup:
                raise ValueError("the window delete is not built for bucketed tables")
            return table_path.merge([i.batch() for i in inputs], stage)
        batches = [Batch(stage(b.df), b.update_cols) for b in (i.batch() for i in inputs)]
        months = in_order(m for b in batches for m in values_of(b.df, "billing_month"))
        existing = read_table(spark, table_path)
        replaced = set(months)
        if existing is not None and loads.aws_cleanup_applies(as_of, cleanup):
            start = add_months(first_of_month(as_of), -1)
            replaced |= set(values_of(existing.filter(F.col("billing_month") >= F.lit(start)), "billing_month"))
            existing = loads.aws_window_delete(existing, as_of)
        out = loads.aws_merge(batches, _of_months(existing, "billing_month", in_order(replaced)))
        overwrite_partitions(out, table_path, ["billing_month"], replaced)
    return months


def refresh_gcp_parts(lines: DataFrame, parts_path: str, dates: list[dt.date],
                      stage: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, list[dt.date]]:
    """Replace the ingestion ``dates`` of a parts table by ``lines`` (all lines of those
    dates). Returns all parts of the usage days that this changes, and their months."""
    spark = lines.sparkSession
    new = stage(daily.gcp_parts(lines))
    days = new.select("usage_date", "usage_month")
    old = read_table(spark, parts_path)
    if old is not None:
        days = days.unionByName(old.filter(F.col("partition_date").isin(*dates)).select(
            "usage_date", F.col("usage_month").cast("date").alias("usage_month")))
    days = stage(days.distinct())
    overwrite_partitions(new, parts_path, ["partition_date", "usage_month"], dates)
    months = values_of(days, "usage_month")
    if not months:
        return new, months
    return parts_of_days(spark.read.parquet(parts_path), days, months), months


def parts_of_days(parts: DataFrame, days: DataFrame, months: list[dt.date]) -> DataFrame:
    """The parts of the given usage days (a null day among them), from their months alone."""
    return (parts.filter(is_one_of("usage_month", months)).alias("p")
            .join(days.select("usage_date").distinct().alias("d"),
                  F.col("p.usage_date").eqNullSafe(F.col("d.usage_date")), "left_semi"))


def gcp_parts_path(table_path: str, internal: bool) -> str:
    return f"{table_path}_parts_{'internal' if internal else 'external'}"


def _folder(table: str | BucketedTable) -> str:
    return table.path if isinstance(table, BucketedTable) else table


def run_gcp_load(spark: SparkSession, export_path: str, table_path: str | BucketedTable, as_of: dt.date,
                 first_run: bool = False, external_export_path: str | None = None,
                 explicit_start: dt.date | None = None) -> list[dt.date]:
    """exports partitioned by ingestion date (internal, and external if given) -> parts
    -> whole usage days -> merge into the usage months they lie in."""
    ws, we = refresh_window(as_of, "GCP", first_run, explicit_start)
    dates = [ws + dt.timedelta(days=i) for i in range((we - ws).days + 1)]
    batches, months = [], set()
    with staging(spark) as stage:
        for path, internal in ((export_path, True), (external_export_path, False)):
            if path is None:
                continue
            lines = spark.read.parquet(path).filter(F.col("partition_date").between(F.lit(ws), F.lit(we)))
            parts, touched = refresh_gcp_parts(
                lines, gcp_parts_path(_folder(table_path), internal), dates, stage)
            batches.append(Batch(daily.gcp_daily_from_parts(parts, internal),
                                 daily.GCP_DESCRIPTORS + (daily.GCP_INTERNAL if internal else daily.GCP_EXTERNAL)))
            months |= set(touched)
        if isinstance(table_path, BucketedTable):
            return table_path.merge(batches, stage)
        months = in_order(months)
        existing = _of_months(read_gcp_table(spark, table_path), "usage_month", months)
        out = keyed_merge(None if existing is None else existing.drop("usage_month"), batches, daily.GCP_KEYS,
                          daily.GCP_COLUMNS)
        write_gcp_table(out, table_path, months)
    return months


def write_gcp_table(rows: DataFrame, table_path: str, months: Iterable) -> None:
    """Replace usage ``months`` of the Google daily table. Below the usage month lies the billing
    month, a descriptor: a rollup that wants late lines of recent billing months finds them
    without opening the rest of the history. A key whose billing month changes moves; what
    it leaves empty goes."""
    overwrite_partitions(rows.withColumn("usage_month", F.trunc("usage_date", "MM")), table_path, GCP_ZONES, months)


def read_gcp_table(spark: SparkSession, table_path: str) -> DataFrame | None:
    table = read_table(spark, table_path)
    return None if table is None else table.withColumn("billing_month", F.col("billing_month").cast("date"))


def run_huawei_load(spark: SparkSession, internal_pages: str, external_pages: str | None, table_path: str | BucketedTable,
                    as_of: dt.date, first_run: bool = False, external_first_run: bool | None = None,
                    explicit_start: dt.date | None = None) -> list[dt.date]:
    """landed JSON pages (internal and external accounts) -> merge into the cycles the
    records belong to, whatever their bill dates; a record without a cycle belongs to the null
    month. The external accounts may have a window of their own (``external_first_run``).

    Only files that the ledger does not know are opened. Rolled up are the days of the window
    and, after the first run, whatever days the new files touch, late ones included."""
    def window(first: bool) -> tuple[dt.date, dt.date]:
        return refresh_window(as_of, "HWC", first, explicit_start)
    first = first_run if external_first_run is None else external_first_run
    sources = [(internal_pages, True, first_run)] + ([(external_pages, False, first)] if external_pages else [])
    with staging(spark) as stage:
        batches, commits = [], []
        for path, internal, fresh in sources:
            ledger = huawei_ledger(spark, _folder(table_path), internal)
            rows, run = refresh_huawei_parts(ledger, path, window(fresh), not fresh, internal, stage)
            commits.append((ledger, run))
            if rows is not None:
                batches.append(Batch(rows, daily.HWC_DESCRIPTORS + (daily.HWC_INTERNAL if internal else daily.HWC_EXTERNAL)))
        if isinstance(table_path, BucketedTable):
            months = table_path.merge(batches, stage) if batches else []
        else:
            months = in_order(m for b in batches for m in values_of(b.df, "billing_month"))
        if months and not isinstance(table_path, BucketedTable):
            existing = _of_months(read_table(spark, table_path), "billing_month", months)
            out = keyed_merge(existing, batches, daily.HWC_KEYS, daily.HWC_COLUMNS)
            overwrite_partitions(out, table_path, ["billing_month"], gather=True)
        for ledger, run in commits:
            ledger.commit(run)
    return months


def huawei_ledger(spark: SparkSession, table_path: str, internal: bool) -> PageLedger:
    """The ledger of the pages of internal or external accounts beside a table."""
    return PageLedger(spark, f"{table_path}_pages_{'internal' if internal else 'external'}", "bill_month")


def refresh_huawei_parts(ledger: PageLedger, path: str, window: tuple[dt.date, dt.date], late_days: bool, internal: bool,
                         stage: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame | None, int | None]:
    """Read the new files below ``path`` into parts; daily rows of the window's days (and, with
    ``late_days``, of all days that the new files touch) from all parts; the run to commit."""
    spark = ledger.spark
    run = ledger.read_new(path, lambda paths: daily.huawei_parts(
        files.read_huawei_pages(spark, paths, with_file=True), "file"))
    parts = ledger.parts(run)
    if parts is None:
        return None, run
    months = set(months_between(*window))
    days = spark.createDataFrame([], "bill_date date")
    withdrawn = None
    if run is not None:
        withdrawn = ledger.withdrawn(run)
        days = ledger.all_parts(run).filter(F.col("run") == run).select("bill_date")
        if withdrawn is not None:
            days = days.unionByName(withdrawn.select("bill_date"))
        days = stage(days.distinct())
    if late_days:
        months |= {first_of_month(d) for d in values_of(days, "bill_date")}
    lo, hi = (F.lit(d) for d in window)

    def of_days(rows: DataFrame) -> DataFrame:
        rows = rows.filter(is_one_of("bill_month", in_order(months)))
        if not late_days:
            return rows.filter(F.col("bill_date").between(lo, hi))
        touched = rows.join(days.withColumn("touched", F.lit(True)), "bill_date", "left")
        return touched.filter(F.col("bill_date").between(lo, hi) | F.col("touched")).drop("touched")
    rows = stage(daily.huawei_daily_from_parts(of_days(parts), internal))
    if withdrawn is not None:
        rows = rows.unionByName(daily.huawei_withdrawn(of_days(withdrawn), rows, internal))
    return rows, run


def run_service_level(spark: SparkSession, aws_path: str, gcp_path: str, hw_path: str,
                      service_types: DataFrame, table_path: str, as_of: dt.date,
                      run_ts: dt.datetime) -> None:
    """rollups of the daily tables over the rewrite window.

    The window starts on the first of a month, so upsert (K5) followed by the
    purge of untouched window rows (K10) leaves exactly this run's rows in the
    window months: those partitions are replaced, emptied ones removed, older ones kept."""
    gcp = read_gcp_table(spark, gcp_path).drop("usage_month")
    out = billing.service_level_billing(read_table(spark, aws_path), gcp, read_table(spark, hw_path),
                                        service_types, as_of, run_ts)
    ws, _ = rollup_window(as_of)
    out = out.withColumn("usage_month", F.trunc("usage_date", "MM"))
    old = read_table(spark, table_path)
    window = [] if old is None else values_of(old.filter(F.col("usage_month") >= F.lit(ws)), "usage_month")
    # outside-of-month rows may be dated after the window end (last day of a late billing month)
    overwrite_partitions(out.filter(F.col("usage_date") >= F.lit(ws)), table_path, ["usage_month"], window)


def run_daily_pricing(spark: SparkSession, pricing_rows: DataFrame, table_path: str, as_of: dt.date) -> None:
    """F5 + K6: the daily price table is rebuilt from the (small) contract table."""
    overwrite_partitions(billing.daily_pricing_job(pricing_rows, as_of).withColumn(
        "pricing_month", F.trunc("pricing_date", "MM")), table_path, ["pricing_month"])


def run_monthly_invoice(spark: SparkSession, slb_path: str, products: DataFrame, organizations: DataFrame,
                        product_accounts: DataFrame, pricing_path: str, pricing_rows: DataFrame,
                        billings_path: str, as_of: dt.date) -> None:
    """F6 + K8: invoices of the previous month appended once (guarded)."""
    start, end = previous_month(as_of)

    def month(path: str, col: str) -> DataFrame:
        return read_table(spark, path).filter(F.col(col).between(F.lit(start), F.lit(end))).drop(col)
    existing = read_table(spark, billings_path)
    billed = existing if existing is not None else _empty_billings(spark)
    inv = billing.monthly_invoice(month(slb_path, "usage_month"), products, organizations, product_accounts,
                                  month(pricing_path, "pricing_month"), pricing_rows, billed, as_of)
    guard = ["month_date", "product_id", "cloud_provider"]
    fresh = inv.join(billed.select(*guard).distinct(), guard, "left_anti")
    with staging(spark) as stage:
        stage(fresh).write.mode("append").parquet(billings_path)


def run_customer_cost(spark: SparkSession, slb_path: str, aws_path: str, products: DataFrame,
                      organizations: DataFrame, product_accounts: DataFrame, pricing_path: str,
                      amortized: DataFrame, billing_entity_map: DataFrame, table_path: str,
                      as_of: dt.date) -> None:
    """F7 + K7: upsert into the months of the window (previous and current)."""
    start = add_months(first_of_month(as_of), -1)

    def since(path: str, col: str) -> DataFrame:
        return read_table(spark, path).filter(F.col(col).between(F.lit(start), F.lit(as_of))).drop(col)
    months = months_between(start, as_of)
    target = _of_months(read_table(spark, table_path), "day_month", months)
    with staging(spark) as stage:
        new = billing.customer_daily_cost(since(slb_path, "usage_month"), read_table(spark, aws_path), products,
                                          organizations, product_accounts, since(pricing_path, "pricing_month"),
                                          stage(amortized), billing_entity_map, as_of)
        out = new if target is None else billing.customer_cost_upsert(target.drop("day_month"), new)
        overwrite_partitions(out.withColumn("day_month", F.trunc("day", "MM")), table_path, ["day_month"])


def _empty_billings(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "month_date date, product_id bigint, organization_id bigint, "
                                     "cloud_provider string, cost decimal(20,8), handling_fee decimal(20,2), "
                                     "support_fee decimal(20,2), invoice_number bigint, created_date date, "
                                     "due_date date")


__all__ = ["read_table", "overwrite_partitions", "append_new", "run_aws_load", "run_gcp_load",
           "run_huawei_load", "run_service_level", "run_daily_pricing", "run_monthly_invoice",
           "run_customer_cost"]

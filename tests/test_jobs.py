"""The flows as jobs over month-partitioned tables: a first run, then an
incremental run (only touched months are read and rewritten); the tables must
still equal the oracle."""

import datetime as dt
import uuid

import pytest

import __spark_entry__ as E
from cloudcost import registry as R
from cloudcost.plans import jobs
from cloudcost.session import scratch_path
from cloudcost.sources import fixtures as fx
from cloudcost.sources.files import write_huawei_pages
from harness import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    base = scratch_path(spark, f"jobs-test-{uuid.uuid4().hex}")
    landed = fx.landed_exports(spark, SF)
    f = R.Fixture(spark, SF)
    ext = [n for n in fx.register_cur_external_tables(spark, SF, f.cur) if n != fx.EXCLUDED_CUR_TABLE]
    f.view.createOrReplaceTempView("amortized_view_test")
    out = {k: f"{base}/{k}" for k in ("aws", "gcp", "hw", "slb")}
    hw_ext = f"{base}/hw_ext_pages"
    write_huawei_pages(f.hw_external_records, hw_ext)
    gcp_ext = f"{base}/gcp_ext"
    f.gcp_external_export.write.partitionBy("partition_date").parquet(gcp_ext)
    for first in (True, False):
        months = jobs.run_aws_load(spark, landed["cur"], ext, ["amortized_view_test"], out["aws"], R.AS_OF,
                                   first_run=first)
        if not first:
            assert months == [dt.date(2001, 8, 1)]   # the incremental run touches one month only
        jobs.run_gcp_load(spark, landed["gcp"], out["gcp"], R.AS_OF, first_run=first, external_export_path=gcp_ext)
        jobs.run_huawei_load(spark, landed["huawei"], hw_ext, out["hw"], R.AS_OF, first_run=first)
        jobs.run_service_level(spark, out["aws"], out["gcp"], out["hw"], f.service_types, out["slb"], R.AS_OF,
                               dt.datetime(2001, 8, 15, 6 if first else 7))
    return out


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key,table,drop", [
    ("aws_load", "aws", []), ("gcp_load", "gcp", ["usage_month"]), ("huawei_load", "hw", []),
    ("service_level_billing", "slb", ["usage_month", "last_updated_at"]),
])
def test_tables_match_oracle(spark, con, tables, key, table, drop):
    def read(s, _d):
        cols = E.queries()[key](s, SF).columns
        return jobs.read_table(s, tables[table]).drop(*drop).select(*cols)
    ok, msg = compare(spark, con, key, SF, read, E.oracle_sql()[key])
    assert ok, msg


def test_months_between():
    assert jobs.months_between(dt.date(2001, 11, 15), dt.date(2002, 2, 1)) == [
        dt.date(2001, 11, 1), dt.date(2001, 12, 1), dt.date(2002, 1, 1), dt.date(2002, 2, 1)]

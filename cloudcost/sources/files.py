"""File sources and sinks: landed Huawei JSON pages (S5), headerless gzip CSV
unload and re-read (K1, S6, S10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..session import shuffles_freed

# Fields of one bill record in a page (extra payload fields are ignored on read).
HUAWEI_RECORD = T.StructType([
    T.StructField("cycle", T.StringType()),
    T.StructField("bill_date", T.StringType()),
    T.StructField("bill_type", T.IntegerType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("region_name", T.StringType()),
    T.StructField("cloud_service_type", T.StringType()),
    T.StructField("resource_Type_code", T.StringType()),
    T.StructField("cloud_service_type_name", T.StringType()),
    T.StructField("resource_type_name", T.StringType()),
    T.StructField("resource_name", T.StringType()),
    T.StructField("sku_code", T.StringType()),
    T.StructField("enterprise_project_id", T.StringType()),
    T.StructField("enterprise_project_name", T.StringType()),
    T.StructField("charge_mode", T.IntegerType()),
    T.StructField("consume_amount", T.DecimalType(20, 8)),
    T.StructField("debt_amount", T.DecimalType(20, 8)),
    T.StructField("official_amount", T.DecimalType(20, 8)),
    T.StructField("product_spec_desc", T.StringType()),
    T.StructField("payer_account_id", T.StringType()),
])
HUAWEI_PAGE = T.StructType([
    T.StructField("monthly_records", T.ArrayType(HUAWEI_RECORD)),
    T.StructField("total_count", T.IntegerType()),
    T.StructField("currency", T.StringType()),
])
PAGE_SIZE = 1000


def write_huawei_pages(records: DataFrame, path: str, page_size: int = PAGE_SIZE) -> None:
    """Land records as API-shaped pages of at most ``page_size`` records, one
    page per JSON line, compressed (most of a page is field names). Pages are cut inside each
    Spark partition, so no page (group) ever exceeds the page size."""
    cols = [f.name for f in HUAWEI_RECORD.fields]
    page = F.floor(F.monotonically_increasing_id() / F.lit(page_size))
    pages = (records.select(*cols).withColumn("_page", page)
             .groupBy("_page")
             .agg(F.collect_list(F.struct(*cols)).alias("monthly_records"),
                  F.count(F.lit(1)).cast("int").alias("total_count"))
             .select("monthly_records", "total_count", F.lit("EUR").alias("currency")))
    with shuffles_freed(records.sparkSession):
        pages.write.mode("overwrite").json(path, compression="gzip")


def read_huawei_pages(spark: SparkSession, path: str | list[str], multi_line: bool = False,
                      with_file: bool = False) -> DataFrame:
    """Pages -> one row per bill record (``explode`` of ``monthly_records``).
    ``path`` is a folder or a list of files; ``multi_line`` reads one pretty-printed page per
    file; ``with_file`` adds the name of the record's file as ``file``."""
    pages = spark.read.schema(HUAWEI_PAGE).option("multiLine", multi_line).json(path)
    origin = [F.col("_metadata.file_path").alias("file")] if with_file else []
    return pages.select(*origin, F.explode("monthly_records").alias("r")).select(
        *(["file"] if with_file else []), "r.*")


NULL_MARK = "\\N"


def unload_csv(df: DataFrame, path: str) -> None:
    """K1: headerless gzip CSV; NULL is written as ``\\N`` so it stays distinct
    from the empty string."""
    (df.write.mode("overwrite").option("compression", "gzip").option("header", False)
     .option("nullValue", NULL_MARK).csv(path))


def read_daily_csv(spark: SparkSession, path: str, columns: list[str],
                   date_cols: tuple[str, ...] = ("usage_date", "billing_month"),
                   usage_cols: tuple[str, ...] = ("usage_amount",),
                   money_suffix: str = "_cost") -> DataFrame:
    """S6 + S10: read headerless gzip CSV with a declared column list, then type
    it: ISO dates, empty/NULL amounts -> 0, malformed amounts raise (ANSI cast)."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    raw = (spark.read.schema(schema).option("header", False).option("nullValue", NULL_MARK)
           .option("emptyValue", "").csv(path))

    def amount(c: str, t: str):
        return F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("0")).cast(t)
    out = []
    for c in columns:
        if c in date_cols:
            out.append(F.to_date(F.col(c), "yyyy-MM-dd").alias(c))
        elif c in usage_cols:
            out.append(amount(c, C.USAGE).alias(c))
        elif c.endswith(money_suffix):
            out.append(amount(c, C.MONEY).alias(c))
        else:
            out.append(F.col(c))
    return raw.select(*out)

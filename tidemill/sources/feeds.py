"""CSV feeds: declared schemas, reading, seeds, external tables, and file discovery."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions import delivery_name, feed_name
from tidemill.sources.store import Store

CORRUPT = "_corrupt_record"
FILES_SCHEMA = "path string, uri string, file_name string, feed string, modified_at timestamp, bytes bigint"


@dataclass(frozen=True)
class Feed:
    """Name, columns as DDL, columns that must have a value, and options for the CSV reader."""

    name: str
    columns: str
    required: tuple[str, ...] = ()
    options: dict[str, str] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.columns)

    @property
    def text_schema(self) -> T.StructType:
        """All columns as text, and a column for lines with too few or too many fields."""
        fields = [T.StructField(n, T.StringType()) for n in self.schema.names]
        return T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])

    @property
    def glob(self) -> str:
        """Names of deliveries of the feed."""
        return f"{{{self.name}.csv,{self.name}_{'[0-9]' * 8}.csv}}"


CUSTOMERS = Feed(
    "customers",
    "customer_id bigint, first_name string, last_name string, email string, created_at date",
    ("customer_id",),
)
ORDERS = Feed(
    "orders",
    "order_id bigint, customer_id bigint, order_date date, amount decimal(10,2), status string",
    ("order_id",),
)
PRODUCTS = Feed(
    "products",
    "product_id bigint, name string, category string, price decimal(10,2), created_at date",
    ("product_id",),
)
ORDER_ITEMS = Feed(
    "order_items",
    "order_id bigint, line_number bigint, product_id bigint, amount decimal(10,2)",
    ("order_id", "line_number"),
)
FEEDS = {feed.name: feed for feed in (CUSTOMERS, ORDERS, PRODUCTS, ORDER_ITEMS)}


def read_feed(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str | None = None,
    **options: str,
) -> DataFrame:
    """CSV with a header and a declared schema; the header must name the same columns in order.

    Without a schema the types are inferred, which reads the data once more.
    """
    reader = spark.read.option("header", True).options(**options)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)


def read_feed_text(spark: SparkSession, path: str | Sequence[str], feed: Feed) -> DataFrame:
    """Lines of the feed with all values as text, headers among them, for checks that must not fail on a bad one."""
    return (
        spark.read.schema(feed.text_schema)
        .option("header", False)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .options(**feed.options)
        .csv(path)
    )


def load_seed(
    store: Store, path: str, table: str, schema: T.StructType | str | None = None, column_types: dict | None = None
) -> int:
    """Replace a table by a CSV file; `column_types` overrides the types of single columns."""
    df = read_feed(store.spark, path, schema)
    for name, dtype in (column_types or {}).items():
        df = df.withColumn(name, F.col(name).cast(dtype))
    return store.materialize(df, table)


def external_table(spark: SparkSession, name: str, path: str, columns: str) -> DataFrame:
    """Catalog table over CSV files where they lie."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING csv "
        f"OPTIONS (header 'true', enforceSchema 'false') LOCATION '{path}'"
    )
    return spark.table(name)


def landing_files(spark: SparkSession, landing: str) -> DataFrame:
    """CSV files of the landing zone and the feeds they belong to; file contents are not read.

    A delivery is a file, or a folder of part files as Spark writes it: `orders_20240601.csv/part-*.csv`.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True)
    try:
        listed = reader.load(landing)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FILES_SCHEMA)
    return listed.select(
        "path",
        F.col("_metadata.file_path").alias("uri"),  # as rows of the file name it; blanks are encoded
        delivery_name(F.col("path")).alias("file_name"),
        feed_name(F.col("path")).alias("feed"),
        F.col("modificationTime").alias("modified_at"),
        F.col("length").alias("bytes"),
    )

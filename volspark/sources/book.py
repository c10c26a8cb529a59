"""Order-book sources.

The raw book is one scan over a directory of per-stock files (CSV or
parquet).  The stock name comes from the file name through ``_metadata``,
so adding stocks never changes the plan; filters on ``stock_id`` and
``time_id`` are plain predicates that reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import BOOK_COLUMNS
from ..functions.columns import stock_id_normalised
from ..functions.quantiles import ranked_in_group

BOOK_SCHEMA = T.StructType(
    [
        T.StructField("time_id", T.LongType()),
        T.StructField("seconds_in_bucket", T.IntegerType()),
        T.StructField("bid_price1", T.DoubleType()),
        T.StructField("ask_price1", T.DoubleType()),
        T.StructField("bid_price2", T.DoubleType()),
        T.StructField("ask_price2", T.DoubleType()),
        T.StructField("bid_size1", T.DoubleType()),
        T.StructField("ask_size1", T.DoubleType()),
        T.StructField("bid_size2", T.DoubleType()),
        T.StructField("ask_size2", T.DoubleType()),
        T.StructField("stock_id", T.StringType()),
    ]
)

STOCK_FILE_PATTERN = r"^(stock_[^/.]+)\.(csv|parquet)$"


def derived_book_sql(string_type: str = "string") -> str:
    """The order-book view over ``lineitem`` (same text runs in DuckDB)."""
    return f"""
SELECT concat('stock_', cast(l_suppkey % 4 AS {string_type}))      AS stock_id,
       cast(floor(l_partkey / 40) AS bigint)                      AS time_id,
       cast((l_orderkey * 7 + l_linenumber * 131) % 600 AS int)   AS seconds_in_bucket,
       1 + (l_orderkey % 97) / 1e5                                AS bid_price1,
       1 + (l_orderkey % 97) / 1e5 + 2e-4 + l_tax / 1e3           AS ask_price1,
       1 + (l_orderkey % 97) / 1e5 - 1e-4                         AS bid_price2,
       1 + (l_orderkey % 97) / 1e5 + 3e-4 + l_tax / 1e3           AS ask_price2,
       l_quantity                                                 AS bid_size1,
       cast(1 + l_orderkey % 50 AS double)                        AS ask_size1,
       cast(l_linenumber * 10 AS double)                          AS bid_size2,
       cast(10 + l_partkey % 90 AS double)                        AS ask_size2
FROM lineitem"""


def derived_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order book derived from the driver's ``lineitem`` table.

    Written with the DataFrame API so the parquet scan only reads the six
    ``lineitem`` columns it needs.
    """
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    base = 1 + (F.col("l_orderkey") % 97) / F.lit(1e5)
    tax = F.col("l_tax") / F.lit(1e3)
    return li.select(
        F.concat(F.lit("stock_"), (F.col("l_suppkey") % 4).cast("string")).alias("stock_id"),
        F.floor(F.col("l_partkey") / F.lit(40)).cast("bigint").alias("time_id"),
        ((F.col("l_orderkey") * 7 + F.col("l_linenumber") * 131) % 600).cast("int").alias("seconds_in_bucket"),
        base.alias("bid_price1"),
        (base + F.lit(2e-4) + tax).alias("ask_price1"),
        (base - F.lit(1e-4)).alias("bid_price2"),
        (base + F.lit(3e-4) + tax).alias("ask_price2"),
        F.col("l_quantity").cast("double").alias("bid_size1"),
        (1 + F.col("l_orderkey") % 50).cast("double").alias("ask_size1"),
        (F.col("l_linenumber") * 10).cast("double").alias("bid_size2"),
        (10 + F.col("l_partkey") % 90).cast("double").alias("ask_size2"),
    )


def read_book(spark: SparkSession, source_dir: str, fmt: str = "csv", partitioned: bool = False) -> DataFrame:
    """One scan over ``stock_*.{csv,parquet}`` in ``source_dir`` (or,
    ``partitioned``, over ``stock_id=<name>/`` folders).

    Missing columns raise (like the per-file check of the original); the
    ``stock_id`` column is normalised (P15) and, when absent from the file,
    taken from the file (or folder) name.
    """
    reader = spark.read
    path = source_dir if partitioned else f"{source_dir}/stock_*.{fmt}"
    if fmt == "csv":
        # one file's header gives the names; a file whose header differs is an
        # error, not a misread file
        reader = reader.option("header", True).option("enforceSchema", False)
        df = reader.schema(reader.csv(path).schema).csv(path)
    else:
        df = reader.parquet(path)
    names = set(df.columns)
    file_stock = F.regexp_extract(F.col("_metadata.file_name"), STOCK_FILE_PATTERN, 1)
    if "stock_id" not in names:
        df = df.withColumn("stock_id", file_stock)
        names.add("stock_id")
    missing = set(BOOK_COLUMNS) - names
    if missing:
        raise ValueError(f"book source is missing columns: {sorted(missing)}")
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in BOOK_SCHEMA.fields if f.name != "stock_id"]
    return df.select(*typed, stock_id_normalised(F.col("stock_id")).alias("stock_id"))


def list_stocks(spark: SparkSession, source_dir: str, fmt: str = "csv") -> DataFrame:
    """Sorted distinct stock names found in the source folder.

    Uses the file listing only (``binaryFile`` with the content column pruned),
    never the file contents.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source_dir).select("path")
    stem = F.regexp_extract(F.element_at(F.split(F.col("path"), "/"), -1), STOCK_FILE_PATTERN, 1)
    folder = F.regexp_extract(F.col("path"), r"/stock_id=(stock_[^/]+)/", 1)
    name = F.when(stem != "", stem).otherwise(folder)
    return files.select(name.alias("stock_id")).where(F.col("stock_id") != "").distinct().orderBy("stock_id")


def select_stocks(book: DataFrame, stocks=None, limit: int | None = None) -> DataFrame:
    """Restrict to requested stocks (normalised) or the first ``limit``."""
    if stocks:
        wanted = [s if str(s).startswith("stock_") else f"stock_{s}" for s in stocks]
        book = book.where(F.col("stock_id").isin(wanted))
    if limit is not None:
        firsts = book.select("stock_id").distinct().orderBy("stock_id").limit(int(limit))
        book = book.join(F.broadcast(firsts), "stock_id", "left_semi")  # at most `limit` rows
    return book


def first_windows(book: DataFrame, n: int | None) -> DataFrame:
    """keep the ``n`` smallest distinct ``time_id`` of each stock.

    Ranks distinct ``(stock_id, time_id)`` keys, not book rows, from range
    partitions: a stock may have any number of windows.
    """
    if n is None:
        return book
    ranked = ranked_in_group(book.select("stock_id", "time_id").distinct(), "stock_id", "time_id")
    return book.join(ranked.where(F.col("_r") <= int(n)).select("stock_id", "time_id"), ["stock_id", "time_id"], "left_semi")

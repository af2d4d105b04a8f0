"""The transactions table: from a headered CSV or from a star schema in Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Header names of the CSV export and the column names used here.
CSV_COLUMNS = {
    "CustomerID": "customer_id",
    "ProductID": "product_id",
    "Quantity": "quantity",
    "Price": "price",
    "TransactionDate": "transaction_date",
    "PaymentMethod": "payment_method",
    "StoreLocation": "store_location",
    "ProductCategory": "product_category",
    "DiscountApplied(%)": "discount_pct",
    "TotalAmount": "total_amount",
}

TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("CustomerID", T.LongType()),
        T.StructField("ProductID", T.StringType()),
        T.StructField("Quantity", T.IntegerType()),
        T.StructField("Price", T.DoubleType()),
        T.StructField("TransactionDate", T.StringType()),
        T.StructField("PaymentMethod", T.StringType()),
        T.StructField("StoreLocation", T.StringType()),
        T.StructField("ProductCategory", T.StringType()),
        T.StructField("DiscountApplied(%)", T.DoubleType()),
        T.StructField("TotalAmount", T.DoubleType()),
    ]
)


def read_csv_transactions(
    spark: SparkSession, path: str, infer_schema: bool = False, coerce_dates: bool = False
) -> DataFrame:
    """Headered CSV scan. Dates raise on bad input unless ``coerce_dates`` (bad input -> null)."""
    reader = spark.read.option("header", True)
    if infer_schema:
        raw = reader.option("inferSchema", True).csv(path)
    else:
        # enforceSchema=False checks the header, so a file with other columns is refused.
        raw = reader.schema(TRANSACTION_SCHEMA).option("enforceSchema", False).csv(path)
    named = raw.select([F.col(f"`{old}`").alias(new) for old, new in CSV_COLUMNS.items()])
    text = F.col("transaction_date").cast("string")
    parse = F.try_to_timestamp if coerce_dates else F.to_timestamp
    return named.withColumn("transaction_date", parse(text).cast("timestamp_ntz"))


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def transactions(spark: SparkSession, directory: str, *columns: str) -> DataFrame:
    """The transactions view over the star schema, joined only as far as ``columns`` need.

    Foreign keys are complete in the star schema, so leaving out an unused dimension does not
    change the rows. No join hints: Spark broadcasts a dimension only below its size threshold
    and otherwise shuffles on the key.
    """
    expressions = {
        "customer_id": ("orders", "o_custkey"),
        "product_id": ("part", "p_brand"),
        "part_id": ("lineitem", "l_partkey"),
        "order_id": ("lineitem", "l_orderkey"),
        "quantity": ("lineitem", "l_quantity"),
        "price": ("lineitem", "l_extendedprice"),
        "transaction_date": ("orders", "o_orderdate"),
        "payment_method": ("orders", "o_orderpriority"),
        "store_location": ("nation", "n_name"),
        "product_category": ("part", "p_type"),
        "discount_pct": ("lineitem", "l_discount * 100"),
        "total_amount": ("lineitem", "l_quantity * l_extendedprice * (1 - l_discount)"),
        "row_key": (
            "lineitem",
            "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)",
        ),
    }
    wanted = columns or tuple(CSV_COLUMNS.values()) + ("row_key",)
    needed = {expressions[c][0] for c in wanted}
    df = table(spark, directory, "lineitem")
    if needed & {"orders", "nation"}:
        orders = table(spark, directory, "orders")
        df = df.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if "part" in needed:
        df = df.join(table(spark, directory, "part"), F.col("l_partkey") == F.col("p_partkey"))
    if "nation" in needed:
        customer = table(spark, directory, "customer").select("c_custkey", "c_nationkey")
        df = df.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        nation = table(spark, directory, "nation").select("n_nationkey", "n_name")
        df = df.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return df.select([F.expr(expressions[c][1]).alias(c) for c in wanted])


def events(spark: SparkSession, directory: str) -> DataFrame:
    return table(spark, directory, "events")

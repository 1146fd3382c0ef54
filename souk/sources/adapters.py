"""Views of the stored tables in the shapes the operators take."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Event types of the stored log and the grades used for ranking labels on it.
STORED_RELEVANCE = {"view": 1, "click": 2, "purchase": 3}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def item_of(props: Column) -> Column:
    return F.from_json(props, "k bigint")["k"]


def as_interactions(events: DataFrame) -> DataFrame:
    """The event log as interactions: the item is ``props.k``, the price is the event value."""
    item = item_of(F.col("props"))
    return events.select(
        "event_id",
        "user_id",
        item.alias("item_id"),
        "event_type",
        F.concat(F.lit("cat_"), (item % 5).cast("string")).alias("category"),
        F.col("value").alias("price"),
        "ts",
    )


def interactions(spark: SparkSession, folder: str) -> DataFrame:
    return as_interactions(table(spark, folder, "events"))


def experiment_units(spark: SparkSession, folder: str, start: str = "2024-01-16") -> DataFrame:
    """Per user: arm by parity, outcome after ``start`` and the same sum before it as the covariate."""
    after = F.col("ts") >= F.lit(start).cast("timestamp_ntz")
    return (
        table(spark, folder, "events").groupBy(F.col("user_id").alias("unit_id"))
        .agg(
            F.sum(F.when(after, F.col("value")).otherwise(0.0)).alias("y"),
            F.sum(F.when(~after, F.col("value")).otherwise(0.0)).alias("x_pre"),
        )
        .withColumn("variant", F.when(F.col("unit_id") % 2 == 0, "control").otherwise("treatment"))
    )


def metric_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Single observations in time order for guardrails: the arm is the user's parity."""
    return table(spark, folder, "events").select(
        F.when(F.col("user_id") % 2 == 0, "control").otherwise("treatment").alias("variant"),
        F.col("value").alias("metric"), "ts", "event_id",
    )


def request_log(spark: SparkSession, folder: str) -> DataFrame:
    """The event log read as a request log: endpoint, method, status and latency."""
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        "event_id", "ts", "user_id",
        F.when(kind == "signup", "POST").otherwise("GET").alias("method"),
        F.when(kind == "click", "/metrics").otherwise(F.concat(F.lit("/"), kind)).alias("endpoint"),
        F.when(kind == "error", "500").otherwise("200").alias("http_status"),
        F.col("value").alias("latency"),
    )


def alerts(spark: SparkSession, folder: str, floor: float = 30.0) -> DataFrame:
    """Purchases above ``floor`` as fraud alerts on their item."""
    events = table(spark, folder, "events").filter((F.col("event_type") == "purchase") & (F.col("value") > floor))
    return events.select(
        item_of(F.col("props")).alias("transaction_id"), F.col("event_id").alias("alert_id"), "user_id",
        F.col("value").alias("amount"), F.col("ts").alias("alert_at"),
    )


def decisions(spark: SparkSession, folder: str) -> DataFrame:
    """Sign-ups as reviewer decisions on their item."""
    events = table(spark, folder, "events").filter(F.col("event_type") == "signup")
    return events.select(
        item_of(F.col("props")).alias("transaction_id"), F.col("event_id").alias("decision_id"),
        F.when(F.col("user_id") % 3 == 0, "Approved").otherwise("Blocked").alias("action"),
        F.col("user_id").alias("reviewer_id"), F.col("ts").alias("decided_at"),
    )


def did_panel(spark: SparkSession, folder: str) -> DataFrame:
    """Order totals by date, with customers of odd nations as the treated group."""
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    customers = table(spark, folder, "customer").select("c_custkey", (F.col("c_nationkey") % 2).alias("treated"))
    return orders.join(customers, orders.o_custkey == customers.c_custkey).select(
        "treated", F.col("o_orderdate").alias("time"), F.col("o_totalprice").alias("target")
    )


def daily_revenue(spark: SparkSession, folder: str) -> DataFrame:
    """Revenue per day with the day's order counts, in all and by status, as covariates."""
    return (
        table(spark, folder, "orders").groupBy(F.col("o_orderdate").alias("day"))
        .agg(
            F.sum("o_totalprice").alias("revenue"),
            F.count(F.lit(1)).cast("double").alias("n_orders"),
            F.count_if(F.col("o_orderstatus") == "O").cast("double").alias("n_open"),
            F.count_if(F.col("o_orderstatus") == "F").cast("double").alias("n_filled"),
            F.count_if(F.col("o_orderstatus") == "P").cast("double").alias("n_partial"),
        )
    )


def monthly_brand_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Quantity per brand and month; ``t`` numbers the months from January 1995 = 0."""
    lines = table(spark, folder, "lineitem").select("l_partkey", "l_quantity", "l_shipdate")
    parts = table(spark, folder, "part").select("p_partkey", "p_brand")
    month = (F.year("l_shipdate") - 1995) * 12 + F.month("l_shipdate") - 1
    per_part = lines.groupBy("l_partkey", month.cast("int").alias("t")).agg(F.sum("l_quantity").alias("qty"))
    return (
        per_part.join(parts, per_part.l_partkey == parts.p_partkey)
        .groupBy(F.col("p_brand").alias("series_id"), "t").agg(F.sum("qty").alias("y"))
    )


def price_samples(spark: SparkSession, folder: str, split: str = "1998-06-01") -> DataFrame:
    """Line-item measures marked as baseline (shipped before ``split``) or recent."""
    return table(spark, folder, "lineitem").select(
        (F.col("l_shipdate") < F.lit(split).cast("timestamp_ntz")).alias("is_expected"),
        "l_extendedprice", "l_quantity", "l_discount",
    )


def customer_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct (customer, part) pairs: the shared attribute of the fraud graph."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    return (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .select(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("attribute")).distinct()
    )


NODE_FEATURES = (
    "n_orders", "total", "mean_price", "max_price", "min_price", "n_open", "n_filled", "n_partial", "n_urgent", "n_days",
)


def customer_nodes(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as graph nodes: ten order statistics, and an overdrawn account as the label."""
    orders = table(spark, folder, "orders")
    stats = orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).cast("double").alias("n_orders"),
        F.sum("o_totalprice").alias("total"),
        F.avg("o_totalprice").alias("mean_price"),
        F.max("o_totalprice").alias("max_price"),
        F.min("o_totalprice").alias("min_price"),
        F.count_if(F.col("o_orderstatus") == "O").cast("double").alias("n_open"),
        F.count_if(F.col("o_orderstatus") == "F").cast("double").alias("n_filled"),
        F.count_if(F.col("o_orderstatus") == "P").cast("double").alias("n_partial"),
        F.count_if(F.col("o_orderpriority").startswith("1")).cast("double").alias("n_urgent"),
        F.datediff(F.max("o_orderdate"), F.min("o_orderdate")).cast("double").alias("n_days"),
    )
    customers = table(spark, folder, "customer").select("c_custkey", (F.col("c_acctbal") < 0).cast("int").alias("label"))
    joined = customers.join(stats, customers.c_custkey == stats.o_custkey, "left")
    return joined.select(
        F.col("c_custkey").alias("node_id"),
        F.array(*[F.coalesce(F.col(c), F.lit(0.0)) for c in NODE_FEATURES]).alias("features"),
        "label",
    )

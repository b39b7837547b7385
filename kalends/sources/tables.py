"""Projection of the star-schema tables onto economies, categories and months.

The only wide work is here: the line-item scan, its joins to supplier and part, and one
pre-aggregated shuffle on the cell key. Everything later runs on the cell grid.
No side is hinted for broadcast: size estimates and adaptive execution decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

MONEY = "decimal(18,2)"

# Category codes of the part dimension.
CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


# Column types of the driver's tables; a given schema saves the footer-reading job.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
                "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def month_of(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM")


def cents(col: Column) -> Column:
    """Money or quantity with two decimals as an exact long: cheap to sum and independent of row order."""
    return F.round(col * 100).cast("long")


def economies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """economy_key, economy, region."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("economy_key"), F.col("n_name").alias("economy"), F.col("r_name").alias("region")
    )


def lines(spark: SparkSession, sf_dir: str, before: str | None = None, since: str | None = None) -> DataFrame:
    """One row per line item with its economy, category, month number and exact amounts in hundredths.

    The date bounds are put on the scan, so they are pushed down. Months stay integers until rows are grouped.
    Dimensions are joined one after the other: a pre-joined side is estimated as a product of sizes, which
    would make the planner build its hash table from the line items instead.
    """
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("economy"), "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", F.col("r_name").alias("region"))
    what = table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_type").alias("category"), F.col("p_brand").alias("brand")
    )
    scan = table(spark, sf_dir, "lineitem")
    if before is not None:
        scan = scan.filter(F.col("l_shipdate") < F.lit(before).cast("timestamp_ntz"))
    if since is not None:
        scan = scan.filter(F.col("l_shipdate") >= F.lit(since).cast("timestamp_ntz"))
    return (
        scan.select(
            "l_suppkey", "l_partkey",
            (F.year("l_shipdate") * 12 + F.month("l_shipdate") - 1).alias("month"),
            cents(F.col("l_extendedprice")).alias("amount"),
            cents(F.col("l_quantity")).alias("units"),
            F.col("l_returnflag").alias("flag"),
        )
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(what, F.col("l_partkey") == F.col("p_partkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("l_suppkey", "economy", "region", "category", "brand", "month", "amount", "units", "flag")
    )


def period_of(month: Column) -> Column:
    """``yyyy-MM`` of a month number (year x 12 + month - 1)."""
    return F.concat_ws("-", F.floor(month / 12).cast("string"), F.lpad((month % 12 + 1).cast("string"), 2, "0"))


def priced(df: DataFrame, *keys: str) -> DataFrame:
    """Sum exact amounts per key and month; the unit price is value over quantity."""
    plain = lambda name: F.sum(name).cast("double") / 100.0
    return (
        df.groupBy(*keys, "month").agg(plain("amount").alias("value"), plain("units").alias("quantity"))
        .select(*keys, period_of(F.col("month")).alias("period"), "value", "quantity", (F.col("value") / F.col("quantity")).alias("unit_price"))
    )


def observations(spark: SparkSession, sf_dir: str, *, by: str = "economy", category: str = "category",
                 first_vintage: bool = False) -> DataFrame:
    """economy, category, period, value, quantity, unit_price.

    ``by='region'`` gives the dense panel, with regions as economies;
    ``first_vintage`` leaves out returned lines, as a first publication would.
    """
    rows = lines(spark, sf_dir)
    if by == "region":
        rows = rows.drop("economy").withColumnRenamed("region", "economy")
    if category != "category":
        rows = rows.drop("category").withColumnRenamed(category, "category")
    if first_vintage:
        rows = rows.filter(F.col("flag") != "R")
    return priced(rows, "economy", "category")


def headline_of(obs: DataFrame) -> DataFrame:
    """economy, period, unit_price over all categories of an economy."""
    return obs.groupBy("economy", "period").agg(
        (F.sum(F.col("value").cast(MONEY)).cast("double") / F.sum(F.col("quantity").cast(MONEY)).cast("double"))
        .alias("unit_price")
    )


def weights_of(obs: DataFrame) -> DataFrame:
    """economy, category, weight: exact share of all spending."""
    cells = obs.groupBy("economy", "category").agg(F.sum(F.col("value").cast(MONEY)).alias("spent"))
    total = cells.select(F.sum("spent").cast("double")).scalar()
    return cells.select("economy", "category", (F.col("spent").cast("double") / total).alias("weight"))


def relatives_of(obs: DataFrame, reference: str) -> DataFrame:
    """economy, category, period, price_relative = 100 at the reference month; cells without it drop out."""
    base = obs.filter(F.col("period") == reference).select(
        "economy", "category", F.col("unit_price").alias("reference_price")
    )
    return obs.join(base, ["economy", "category"]).select(
        "economy", "category", "period", (F.lit(100.0) * F.col("unit_price") / F.col("reference_price")).alias("price_relative")
    )


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """economy, region, income_group, characteristics, covariates for every nation.

    Market segments held by more than an even share of a nation's customers are its
    characteristics; mean balance and mean order total are its covariates.
    """
    customer = table(spark, sf_dir, "customer")
    orders = table(spark, sf_dir, "orders")
    segments = customer.groupBy("c_nationkey", "c_mktsegment").agg(
        F.count("*").alias("n"), F.sum(F.col("c_acctbal").cast(MONEY)).alias("balance")
    )
    totals = segments.groupBy("c_nationkey").agg(
        F.sum("n").alias("customers"), F.sum("balance").cast("double").alias("balance")
    )
    traits = (
        segments.select("c_nationkey", "c_mktsegment", "n").join(totals, "c_nationkey")
        .groupBy("c_nationkey", "customers", "balance")
        .agg(F.array_sort(F.collect_set(F.when(F.col("n") * 5 > F.col("customers"), F.col("c_mktsegment"))))
             .alias("characteristics"))
    )
    spend = (
        orders.join(customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey")
        .agg((F.sum(F.col("o_totalprice").cast(MONEY)).cast("double") / F.count("*")).alias("mean_order"))
    )
    mean_balance = F.col("balance") / F.col("customers")
    return (
        economies(spark, sf_dir)
        .join(traits, F.col("economy_key") == F.col("c_nationkey")).drop("c_nationkey")
        .join(spend, F.col("economy_key") == F.col("c_nationkey"), "left")
        .select(
            "economy", "region",
            F.when(mean_balance >= 4500, "HIGH").otherwise("LOW").alias("income_group"),
            "characteristics",
            F.map_filter(
                F.create_map(F.lit("mean_balance"), mean_balance, F.lit("mean_order"), F.col("mean_order")),
                lambda _, v: v.isNotNull(),
            ).alias("covariates"),
        )
    )


def release_calendar(panel: DataFrame) -> DataFrame:
    """period, release_date: month end plus 15 days plus month ordinal mod 10."""
    first = F.to_date(F.concat("period", F.lit("-01")))
    ordinal = F.year(first) * 12 + F.month(first)
    return panel.select("period").distinct().withColumn(
        "release_date", F.date_add(F.last_day(first), 15 + ordinal % 10)
    )

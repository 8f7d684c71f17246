"""Views over the given tables that give them the shapes the operators work on.

The tables hold no NULLs, blanks, ties or broken bodies, so these are put in by rules on
the keys, always inside a projection: every view covers every row of its table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.naming import SnapshotName
from strata.operators.conform import ConformSpec
from strata.operators.enrich import Lookup
from strata.session import written

EVENT_SNAPSHOT = SnapshotName("events__fetched_", "_UTC.json")
POPULATION_BODY = "data array<struct<`Nation ID`: string, Nation: string, Year: bigint, Population: double>>"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as observations: a customer is a series, order totals add up per quarter.

    Every 5th series is annual only, every 3rd has an annual value beside its quarters,
    every 17th a period code nobody knows, every 11th equal values (ties), every 13th no
    value in its third quarters.
    """
    key = F.col("o_custkey")
    quarter = F.quarter("o_orderdate")
    own = (
        F.when(key % 5 == 0, "Q05")
        .when((key % 17 == 0) & (quarter == 2), "Q06")
        .otherwise(F.concat(F.lit("Q0"), quarter))
    )
    periods = F.when((key % 3 == 0) & (key % 5 != 0), F.array(own, F.lit("Q05"))).otherwise(F.array(own))
    rows = table(spark, sf_dir, "orders").select(
        key.alias("_key"),
        F.year("o_orderdate").alias("year"),
        F.explode(periods).alias("period"),
        F.col("o_totalprice").cast("decimal(18,3)").alias("_amount"),
    )
    summed = rows.groupBy("_key", "year", "period").agg(F.sum("_amount").alias("_total"))
    value = (
        F.when(F.col("_key") % 11 == 0, F.lit(1000))
        .when((F.col("_key") % 13 == 0) & (F.col("period") == "Q03"), F.lit(None))
        .otherwise(F.col("_total"))
    )
    return summed.select(
        F.concat(F.lit("S"), F.col("_key")).alias("series_id"),
        "year",
        "period",
        value.try_cast("decimal(18,3)").alias("value"),
    )


def padded(value: Column) -> Column:
    return F.concat(F.lit("  "), value.cast("string"), F.lit(" "))


def raw_observations(obs: DataFrame) -> DataFrame:
    """The observations as a text source would hold them: padded strings."""
    return obs.select(*[padded(F.col(name)).alias(name) for name in ("series_id", "year", "period", "value")])


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as coded series; every 29th lacks its sector code."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("S"), key).alias("series_id"),
        F.when(key % 29 != 0, F.col("c_nationkey")).alias("sector_code"),
        F.col("c_mktsegment").alias("class_code"),
        key.alias("measure_code"),
        F.floor(key / 15).alias("duration_code"),
        (F.col("c_nationkey") % 5).alias("seasonal_code"),
    )


def lookups(spark: SparkSession, sf_dir: str) -> list[Lookup]:
    """Five code tables: two small ones, two that grow with the data, one inline without MACHINERY."""
    classes = spark.sql(
        "SELECT * FROM VALUES ('AUTOMOBILE', 'Vehicles'), ('BUILDING', 'Construction'), "
        "('FURNITURE', 'Furniture'), ('HOUSEHOLD', 'Households') AS t(class_code, class_text)"
    )
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("sector_name"))
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("measure_text"))
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_name").alias("duration_text"))
    region = table(spark, sf_dir, "region").select("r_regionkey", F.col("r_name").alias("seasonal_text"))
    return [
        Lookup(nation, "n_nationkey", "sector_name", "sector_code"),
        Lookup(classes, "class_code", "class_text", "class_code"),
        Lookup(part, "p_partkey", "measure_text", "measure_code"),
        Lookup(supplier, "s_suppkey", "duration_text", "duration_code"),
        Lookup(region, "r_regionkey", "seasonal_text", "seasonal_code"),
    ]


def yearly_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line item totals per year, one year late: the first observed year has none, the last is spare.

    Written out, as the yearly table is a published one: the join behind it then knows its size.
    """
    lines = table(spark, sf_dir, "lineitem")
    totals = lines.groupBy((F.year("l_shipdate") + 1).cast("bigint").alias("year")).agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("population")
    )
    return written(totals, "yearly-population")


def population_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON body of three records per order, some broken, some empty, some without the list."""
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    records = F.transform(
        F.sequence(F.lit(0), F.lit(2)),
        lambda i: F.struct(
            F.col("o_custkey").cast("string").alias("Nation ID"),
            F.col("o_orderpriority").alias("Nation"),
            (F.year("o_orderdate") + i).alias("Year"),
            (F.col("o_totalprice") + i).alias("Population"),
        ),
    )
    whole = F.to_json(F.struct(records.alias("data")))
    body = (
        F.when(key % 9 == 0, F.concat(F.lit('{"data":[{"Year":'), key))
        .when(key % 14 == 0, '{"data":[]}')
        .when(key % 25 == 0, '{"page":1}')
        .otherwise(whole)
    )
    return orders.select(
        key.alias("snapshot_id"), F.col("o_orderdate").alias("fetched_at_utc"), body.alias("raw_json")
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as padded text; every 7th priority is blank, every 13th price unreadable, every 31st key empty."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        padded(F.when(key % 31 != 0, key)).alias("o_orderkey"),
        padded(F.col("o_custkey")).alias("o_custkey"),
        padded(F.col("o_orderdate").cast("date")).alias("o_orderdate"),
        F.when(key % 7 == 0, "   ").otherwise(padded(F.col("o_orderpriority"))).alias("o_orderpriority"),
        F.when(key % 13 == 0, " n/a ")
        .otherwise(padded(F.col("o_totalprice").cast("decimal(18,3)")))
        .alias("o_totalprice"),
    )


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Any table as padded text; doubles as decimals with three places."""
    df = table(spark, sf_dir, name)
    texts = []
    for f in df.schema:
        value = F.col(f.name)
        if f.dataType.typeName() == "double":
            value = value.cast("decimal(18,3)")
        elif f.dataType.typeName().startswith("timestamp"):
            value = value.cast("date")
        texts.append(padded(value).alias(f.name))
    return df.select(*texts)


ORDERS_SPEC = ConformSpec.of(
    "orders", "fct_orders",
    "o_orderkey>order_id:bigint o_custkey>customer_id:int o_orderdate>ordered_on "
    "o_orderpriority>priority o_totalprice>total:decimal(18,3)",
    keys="order_id", required="order_id total", comment="Typed orders.",
)

# One typed dataset each; lineitem has no unique key, so its flag is false for repeated ones.
SPECS = (
    ConformSpec.of(
        "lineitem", "fct_lineitem",
        "l_orderkey>order_id:bigint l_linenumber>line:int l_partkey>part_id:bigint "
        "l_quantity>quantity:decimal(18,3) l_extendedprice>price:decimal(18,3) l_discount>discount:double "
        "l_returnflag>return_flag l_shipdate>shipped_on",
        keys="order_id line",
    ),
    ConformSpec.of(
        "customer", "dim_customer",
        "c_custkey>customer_id:bigint c_name>name c_nationkey>nation_code c_acctbal>balance:decimal(18,3) "
        "c_mktsegment>segment",
        keys="customer_id",
    ),
    ConformSpec.of(
        "part", "dim_part",
        "p_partkey>part_id:bigint p_name>part_text p_brand>brand p_type>type p_size>size:int "
        "p_retailprice>price:decimal(18,3)",
        keys="part_id",
    ),
    ConformSpec.of(
        "supplier", "dim_supplier",
        "s_suppkey>supplier_id:bigint s_name>name s_nationkey>nation_code s_acctbal>balance:double",
        keys="supplier_id",
    ),
    ConformSpec.of("nation", "dim_nation", "n_nationkey>nation_code n_name>nation_text n_regionkey>region_code:int",
                   keys="nation_code"),
    ConformSpec.of("region", "dim_region", "r_regionkey>region_code r_name>region_text", keys="region_code"),
)


def order_files(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Orders as files of a source: manifest, new listing and local copies.

    The manifest knows the orders before 2001, the listing shows those since July 1995.
    High priorities have a new time, medium ones a new size, low ones no local copy;
    urgent finished orders were marked as removed before.
    """
    orders = table(spark, sf_dir, "orders")
    name = F.concat(F.lit("order-"), F.col("o_orderkey")).alias("file_name")
    size = F.floor("o_totalprice")
    modified = F.date_format("o_orderdate", "M/d/yyyy h:mm a")
    priority = F.col("o_orderpriority")
    gone = (F.col("o_orderstatus") == "F") & (priority == "1-URGENT")
    day = F.expr("INTERVAL 1 DAY")
    manifest = orders.where(F.col("o_orderdate") < F.lit("2001-01-01").cast("timestamp_ntz")).select(
        name,
        modified.alias("source_last_modified"),
        size.alias("source_size_bytes"),
        F.when(gone, "removed").otherwise("active").alias("status"),
        F.col("o_orderdate").alias("first_seen_at"),
        (F.col("o_orderdate") + day).alias("last_seen_at"),
        F.col("o_orderdate").alias("last_downloaded_at"),
        F.when(gone, F.col("o_orderdate") + day).alias("removed_at"),
    )
    listed_size = F.when(priority == "3-MEDIUM", size + 1).otherwise(size)
    listing = orders.where(F.col("o_orderdate") >= F.lit("1995-07-01").cast("timestamp_ntz")).select(
        name,
        F.when(priority == "2-HIGH", "1/1/2002 1:00 AM").otherwise(modified).alias("source_last_modified"),
        listed_size.alias("source_size_bytes"),
    )
    local = orders.where(priority != "5-LOW").select(name, size.alias("local_size_bytes"))
    return manifest, listing, local


def _listing_row(modified: Column, size: Column, href: Column, name: Column) -> Column:
    return F.concat(modified, F.lit("       "), size, F.lit(' <A HREF="'), href, F.lit('">'), name, F.lit("</A><br>"))


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A directory listing per part, naming three files, the first one twice."""
    key, size = F.col("p_partkey"), F.col("p_size")
    day = F.concat(F.lit(" 1/"), key % 28 + 1, F.lit("/2024  9:05 AM"))
    data, series_file, text = (F.concat(F.lit("p"), key, F.lit(ending)) for ending in (".data", ".series", ".txt"))
    html = F.concat(
        F.lit("<html><body><pre>"),
        _listing_row(day, size, F.concat(F.lit("/pub/old/"), data), data),
        _listing_row(day, size + 1, series_file, series_file),
        _listing_row(day, size + 2, F.concat(F.lit("../"), text), text),
        _listing_row(F.lit("12/31/2024 11:59 PM"), size + 3, F.concat(F.lit("/pub/new/"), data), data),
        F.lit("</pre></body></html>"),
    )
    return table(spark, sf_dir, "part").select(key.alias("page_id"), html.alias("html"))

"""The given parquet tables in the role of the source system.

``*_text`` functions give an entity's all-text file layout, the others typed clean tables. The
"day 1" tables are derived from the data itself (by balance, status, segment), never sampled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.functions.calendar import date_dim
from plinth.operators.enrich import STATE_CODES, TIER_1, TIER_2

# Order status of the given data and the delivery status it stands for.
DELIVERY_STATUS = {"F": "Delivered", "O": "Pending", "P": "In Transit"}
# Nation number to (state, city), 25 of each, in list order.
STATES = list(STATE_CODES)
CITIES = TIER_1 + TIER_2
DAY_0, DAY_1 = "1996-01-01 00:00:00", "1998-07-01 00:00:00"


# The given tables' columns, so that opening one needs no job to look at its files.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def line_items(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem")


def money(c: str, precision: int = 10) -> Column:
    return F.col(c).cast(f"decimal({precision},2)")


def at(ts: str) -> Column:
    return F.lit(ts).cast("timestamp")


def _listed(values: list[str], index: str) -> Column:
    listed = ", ".join(f"'{v}'" for v in values)
    return F.expr(f"element_at(array({listed}), {index} + 1)")


def _day_after(start: str, days: Column) -> Column:
    return F.date_add(F.lit(start).cast("date"), F.floor(days).cast("int"))


# --- file layouts -----------------------------------------------------------------------------


def customer_text(spark: SparkSession, sf: str) -> DataFrame:
    """Birthdays of one segment are written day first, so they do not parse."""
    born = _day_after("1970-01-01", F.col("c_acctbal"))
    return table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("customerid"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("9"), F.lpad(F.col("c_custkey").cast("string"), 9, "0")).alias("mobile"),
        F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@mail.test")).alias("email"),
        F.col("c_mktsegment").alias("loginbyusing"),
        F.when(F.col("c_nationkey") < 12, "F").otherwise("M").alias("gender"),
        F.when(F.col("c_mktsegment") == "MACHINERY", F.date_format(born, "dd/MM/yyyy"))
        .otherwise(F.date_format(born, "yyyy-MM-dd")).alias("dob"),
        F.when(F.col("c_acctbal") >= 0, F.date_format(_day_after("1990-01-01", F.col("c_acctbal")), "yyyy-MM-dd"))
        .alias("anniversary"),
        F.concat(F.lit('{"segment":"'), F.col("c_mktsegment"), F.lit('"}')).alias("preferences"),
        F.lit("2020-01-01T08:30:00.123456").alias("createddate"),
        F.concat(
            F.lit("2020-02-"), F.lpad((F.col("c_nationkey") + 1).cast("string"), 2, "0"), F.lit("T10:00:00.000001")
        ).alias("modifieddate"),
        "c_acctbal",
    )


def customer_files(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Initial file and day-1 delta: some customers are new on day 1, debtors change their login."""
    rows = customer_text(spark, sf)
    late = (F.col("loginbyusing") == "BUILDING") & (F.col("c_acctbal") > 5000)
    debtor = F.col("c_acctbal") < 0
    initial = rows.where(~late).drop("c_acctbal")
    delta = (
        rows.where(late | debtor)
        .withColumn("loginbyusing", F.when(debtor, F.lit("Google")).otherwise(F.col("loginbyusing")))
        .withColumn("modifieddate", F.lit("2020-03-01T00:00:00.000000"))
        .drop("c_acctbal")
    )
    return initial, delta


def location_text(spark: SparkSession, sf: str, owner: str = "supplier") -> DataFrame:
    """One location per supplier (or customer); debtors live in a place without a state code."""
    p = owner[0]
    rows = table(spark, sf, owner).join(
        F.broadcast(  # nation and region have a fixed size of 25 and 5 rows
            table(spark, sf, "nation").join(
                table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")
            )
        ),
        F.col(f"{p}_nationkey") == F.col("n_nationkey"),
    )
    key = f"{p}_suppkey" if owner == "supplier" else f"{p}_custkey"
    debtor = F.col(f"{p}_acctbal") < 0
    return rows.select(
        F.col(key).cast("string").alias("locationid"),
        F.when(debtor, F.col("n_name")).otherwise(_listed(CITIES, "n_nationkey")).alias("city"),
        F.when(debtor, F.col("r_name")).otherwise(_listed(STATES, "n_nationkey")).alias("state"),
        F.lpad(F.col(key).cast("string"), 6, "0").alias("zipcode"),
        F.lit("Yes").alias("activeflag"),
        F.lit("2020-01-01 00:00:00").alias("createddate"),
        F.lit(None).cast("string").alias("modifieddate"),
        F.col(f"{p}_acctbal").alias("_balance"),
    )


def location_files(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Initial file, and a day-1 file that repeats every row with a flag changed for rich suppliers."""
    rows = location_text(spark, sf)
    rich = F.col("_balance") > 8000
    changed = rows.withColumn("activeflag", F.when(rich, F.lit("No")).otherwise(F.col("activeflag")))
    changed = changed.withColumn("modifieddate", F.when(rich, F.lit("2020-02-01 12:00:00")))
    return rows.drop("_balance"), changed.drop("_balance")


def menu_text(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("menuid"),
        F.col("p_size").cast("string").alias("restaurantid"),
        F.concat(F.lit("  "), F.col("p_name"), F.lit(" ")).alias("itemname"),
        F.concat(F.col("p_brand"), F.lit(" "), F.col("p_name"), F.lit(" ")).alias("description"),
        money("p_retailprice").cast("string").alias("price"),
        F.col("p_type").alias("category"),
        F.when(F.col("p_type") == "PROMO", "TRUE").when(F.col("p_type") == "ECONOMY", "n/a")
        .otherwise("False").alias("availability"),
        F.when(F.col("p_size") < 25, "Veg").otherwise("Non-Veg").alias("itemtype"),
        F.lit("2020-01-01 00:00:00").alias("createddate"),
        F.lit("2020-01-01 00:00:00").alias("modifieddate"),
    )


def menu_stage(spark: SparkSession, sf: str) -> DataFrame:
    """A whole stage table: every item, and once more with a new price for large items."""
    first = menu_text(spark, sf)
    again = (
        menu_text(spark, sf)
        .where(F.col("itemtype") == "Non-Veg")
        .withColumn("price", (F.col("price").cast("decimal(10,2)") + 10).cast("decimal(10,2)").cast("string"))
        .withColumn("modifieddate", F.lit("2020-02-01 00:00:00"))
    )
    return first.unionByName(again)


def order_text(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("orderid"),
        F.col("o_custkey").cast("string").alias("customerid"),
        F.lit(None).cast("string").alias("restaurantid"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("orderdate"),
        money("o_totalprice").cast("string").alias("totalamount"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("paymentmethod"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("createddate"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("modifieddate"),
    )


def order_item_text(spark: SparkSession, sf: str) -> DataFrame:
    """Lines shipped in 2001 carry a quantity that does not convert."""
    shipped = F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")
    return line_items(spark, sf).select(
        F.col("l_linenumber").cast("string").alias("orderitemid"),
        F.col("l_orderkey").cast("string").alias("orderid"),
        F.col("l_partkey").cast("string").alias("menuid"),
        F.when(F.year("l_shipdate") == 2001, F.concat(F.lit("x"), F.col("l_linenumber").cast("string")))
        .otherwise(money("l_quantity").cast("string")).alias("quantity"),
        money("l_extendedprice").cast("string").alias("price"),
        net_price().cast("string").alias("subtotal"),
        shipped.alias("createddate"),
        shipped.alias("modifieddate"),
    )


def restaurant_files(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Suppliers as restaurants, the richest new on day 1. Then all are sent again: debtors are closed
    and their price is no number any more, the others are as they were."""
    debtor, rich = F.col("s_acctbal") < 0, F.col("s_acctbal") > 8000
    key, nation = F.col("s_suppkey").cast("string"), F.col("s_nationkey").cast("string")
    first = table(spark, sf, "supplier").select(
        key.alias("restaurantid"),
        F.col("s_name").alias("name"),
        F.concat(F.lit("cuisine "), nation).alias("cuisinetype"),
        money("s_acctbal").cast("string").alias("pricing_for_2"),
        F.concat(F.lit("080"), F.lpad(key, 7, "0")).alias("restaurant_phone"),
        F.lit("10 AM - 11 PM").alias("operatinghours"),
        (F.col("s_nationkey") + 1).cast("string").alias("locationid"),
        F.lit("Yes").alias("activeflag"),
        F.lit("Open").alias("openstatus"),
        F.lit(None).cast("string").alias("locality"),
        F.concat(F.col("s_name"), F.lit(", street "), nation).alias("restaurant_address"),
        F.concat(F.lit("12."), F.lpad(nation, 6, "0")).alias("latitude"),
        F.concat(F.lit("-77."), F.lpad(nation, 6, "0")).alias("longitude"),
        F.lit("2020-01-01 08:30:00.123456000").alias("createddate"),
        F.lit("2020-01-01 08:30:00.123456000").alias("modifieddate"),
        debtor.alias("_debtor"), rich.alias("_rich"),
    )
    again = (
        first.withColumn("openstatus", F.when(F.col("_debtor"), "Closed").otherwise(F.col("openstatus")))
        .withColumn("pricing_for_2", F.when(F.col("_debtor"), "n/a").otherwise(F.col("pricing_for_2")))
        .withColumn("modifieddate", F.lit("2020-02-01 00:00:00"))
    )
    return first.where(~F.col("_rich")).drop("_debtor", "_rich"), again.drop("_debtor", "_rich")


def address_files(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Homes of all customers; on day 1 their offices, and the homes of debtors with another landmark
    and another owner. Offices of one segment have ids that are no numbers."""
    rows = table(spark, sf, "customer")

    def lines(kind: str, n: int) -> DataFrame:
        key, nation = F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")
        number = (F.col("c_custkey") * 2 + n).cast("string")
        return rows.select(
            F.when((F.col("c_mktsegment") == "MACHINERY") & F.lit(n == 1), F.concat(F.lit("x"), number)).otherwise(number).alias("addressid"),
            key.alias("customerid"),
            F.concat(F.lit("F"), nation).alias("flatno"),
            key.alias("houseno"),
            nation.alias("floor"),
            F.col("c_mktsegment").alias("building"),
            F.lit("old tree").alias("landmark"),
            F.lit(None).cast("string").alias("locality"),
            _listed(CITIES, "c_nationkey").alias("city"),
            _listed(STATES, "c_nationkey").alias("state"),
            F.lpad(key, 6, "0").alias("pincode"),
            F.concat(F.lit("12,"), nation).alias("coordinates"),
            F.lit("No" if n else "Yes").alias("primaryflag"),
            F.lit(kind).alias("addresstype"),
            F.lit("2020-01-01T08:30:00.500000").alias("createddate"),
            F.lit("2020-01-01T08:30:00.500000").alias("modifieddate"),
            "c_acctbal",
        )

    home, office = lines("Home", 0), lines("Office", 1).where(F.col("c_acctbal") > 5000)
    moved = (
        home.where(F.col("c_acctbal") < 0).withColumn("customerid", F.lit("0")).withColumn("landmark", F.lit("new bridge"))
        .withColumn("modifieddate", F.lit("2020-03-01T00:00:00"))
    )
    return home.drop("c_acctbal"), moved.unionByName(office).drop("c_acctbal")


def agent_files(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Suppliers as agents; on day 1 debtors among them have another name and rating, and rich
    customers become agents with ids from a billion on."""

    def agents(p: str, owner: str, key: Column) -> DataFrame:
        nation = F.col(f"{p}_nationkey")
        return table(spark, sf, owner).select(
            key.cast("string").alias("deliveryagentid"),
            F.col(f"{p}_name").alias("name"),
            F.concat(F.lit("7"), F.lpad(key.cast("string"), 10, "0")).alias("phone"),
            F.when(nation < 12, "Bike").otherwise("Scooter").alias("vehicletype"),
            (nation + 1).cast("string").alias("locationid"),
            F.lit("Active").alias("status"),
            F.lit(None).cast("string").alias("gender"),
            F.concat(F.pmod(nation, 5).cast("string"), F.lit(".5")).alias("rating"),
            F.lit("2020-01-01 00:00:00").alias("createddate"),
            F.lit("2020-01-01 00:00:00").alias("modifieddate"),
            F.col(f"{p}_acctbal").alias("_balance"),
        )

    first = agents("s", "supplier", F.col("s_suppkey"))
    changed = (
        first.where(F.col("_balance") < 0).withColumn("name", F.lit("renamed")).withColumn("rating", F.lit("1.25"))
        .withColumn("modifieddate", F.lit("2020-02-01 00:00:00"))
    )
    joining = agents("c", "customer", F.col("c_custkey") + 1_000_000_000).where(F.col("_balance") > 9000)
    return first.drop("_balance"), changed.unionByName(joining).drop("_balance")


def delivery_files(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """A delivery per order; on day 1 those in transit arrive, urgent pending ones go to the next
    agent, which is a row of its own, and pending ones of low priority have a date that is none."""
    status = F.col("o_orderstatus")
    moment = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    first = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("deliveryid"),
        F.col("o_orderkey").cast("string").alias("orderid"),
        F.pmod("o_orderkey", F.lit(97)).cast("string").alias("deliveryagentid"),
        delivery_status(status).alias("deliverystatus"),
        F.col("o_orderpriority").alias("estimatedtime"),
        (F.col("o_custkey") * 2).cast("string").alias("addressid"),
        moment.alias("deliverydate"), moment.alias("createddate"), moment.alias("modifieddate"),
    )
    pending, priority = F.col("deliverystatus") == "Pending", F.col("estimatedtime")
    urgent, slow = pending & (priority == "1-URGENT"), pending & (priority == "5-LOW")
    agent = F.col("deliveryagentid")
    delta = first.where((F.col("deliverystatus") == "In Transit") | urgent | slow).select(
        "deliveryid", "orderid", F.when(urgent, (agent.cast("bigint") + 1).cast("string")).otherwise(agent).alias("deliveryagentid"),
        F.when(pending, F.col("deliverystatus")).otherwise("Delivered").alias("deliverystatus"), "estimatedtime", "addressid",
        F.when(slow, "soon").otherwise(F.col("deliverydate")).alias("deliverydate"), "createddate",
        F.lit("2002-01-01 00:00:00").alias("modifieddate"),
    )
    return first, delta


# --- typed clean tables -----------------------------------------------------------------------


def net_price() -> Column:
    """Line price after discount, exact in cents."""
    return F.round(money("l_extendedprice") * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)")), 2).cast(
        "decimal(10,2)"
    )


def order_items(spark: SparkSession, sf: str) -> DataFrame:
    """Every line item is one item; the supplier it came from is its restaurant."""
    return line_items(spark, sf).select(
        F.col("l_linenumber").cast("bigint").alias("order_item_id"),
        F.col("l_orderkey").alias("order_id_fk"),
        F.col("l_partkey").alias("menu_id_fk"),
        F.col("l_suppkey").alias("restaurant_id_fk"),
        money("l_quantity").alias("quantity"),
        money("l_extendedprice").alias("price"),
        net_price().alias("subtotal"),
        F.col("l_shipdate").alias("modified_dt"),
    )


def orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id_fk"),
        F.col("o_orderdate").alias("order_date"),
        money("o_totalprice").alias("total_amount"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("payment_method"),
    )


def delivery_status(c: Column) -> Column:
    result = F
    for code, status in DELIVERY_STATUS.items():
        result = result.when(c == code, F.lit(status))
    return result


def deliveries(spark: SparkSession, sf: str) -> DataFrame:
    """One delivery per order to the customer's home address; agents take turns by order number."""
    agents = table(spark, sf, "supplier").agg(F.count(F.lit(1))).scalar()
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("delivery_id"),
        F.col("o_orderkey").alias("order_id_fk"),
        F.pmod(F.col("o_orderkey"), agents).alias("delivery_agent_id_fk"),
        delivery_status(F.col("o_orderstatus")).alias("delivery_status"),
        F.col("o_orderpriority").alias("estimated_time"),
        (F.col("o_custkey") * 2).alias("customer_address_id_fk"),
    )


def order_status(spark: SparkSession, sf: str) -> DataFrame:
    """The two delivery columns the KPI views need."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id_fk"),
        delivery_status(F.col("o_orderstatus")).alias("delivery_status"),
    )


def customer_addresses(spark: SparkSession, sf: str) -> DataFrame:
    """A home address per customer and an office for those with a balance over 5000."""
    rows = table(spark, sf, "customer")
    kinds = F.when(F.col("c_acctbal") > 5000, F.array(F.lit("Home"), F.lit("Office"))).otherwise(
        F.array(F.lit("Home"))
    )
    return rows.select("c_custkey", "c_nationkey", F.posexplode(kinds).alias("n", "kind")).select(
        (F.col("c_custkey") * 2 + F.col("n")).alias("address_id"),
        F.col("c_custkey").alias("customer_id_fk"),
        _listed(CITIES, "c_nationkey").alias("city"),
        F.col("kind").alias("address_type"),
    )


def delivery_agents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("delivery_agent_id"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").cast("bigint").alias("location_id_fk"),
    )


def restaurants(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("restaurant_id"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").cast("bigint").alias("location_id_fk"),
        money("s_acctbal").alias("pricing_for_two"),
    )


def locations(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("location_id"),
        _listed(CITIES, "n_nationkey").alias("city"),
        _listed(STATES, "n_nationkey").alias("state"),
    )


def menu_items(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("menu_id"),
        F.col("p_name").alias("item_name"),
        F.col("p_type").alias("category"),
        money("p_retailprice").alias("price"),
    )


def customers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
        money("c_acctbal").alias("balance"),
    )


def customers_day_1(spark: SparkSession, sf: str) -> DataFrame:
    """Next snapshot: debtors change segment, the richest leave, suppliers become customers too."""
    stay = customers(spark, sf).where(F.col("balance") <= 9500)
    moved = stay.withColumn("segment", F.when(F.col("balance") < 0, F.lit("DEBT")).otherwise(F.col("segment")))
    joining = table(spark, sf, "supplier").select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("customer_id"),
        F.col("s_name").alias("name"), F.lit("SUPPLIER").alias("segment"), money("s_acctbal").alias("balance"),
    )
    return moved.unionByName(joining)


def calendar(spark: SparkSession, sf: str) -> DataFrame:
    """Date dimension from the first to the last order day."""
    rows = table(spark, sf, "orders")
    return date_dim(rows, "o_orderdate", as_of=F.to_date("o_orderdate"))

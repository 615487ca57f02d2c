"""The four staging feeds, derived from the TPC-H-like sample tables.

The sample tables are clean, so each feed adds fixed irregularities by key:
nulls, padding, malformed emails, negative numbers, unknown keys, reversed dates,
second deliveries of the same record. Every rule is plain arithmetic on keys, so
feeds grow with the tables and any SQL engine can restate them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketwork import schemas
from basketwork.functions.numbers import MONEY

AS_OF = dt.date(2001, 11, 5)
EPOCH = dt.date(1995, 1, 1)
MAX_QUANTITY_TYPE = "decimal(10,0)"
ORDER = "order_key"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(key: str, step: int, rest: int = 0) -> Column:
    return F.col(key) % step == rest


def _null_if(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


def _conform(df: DataFrame, feed: str, keep_decimals: bool = True, extra: Sequence[str] = ()) -> DataFrame:
    """Columns in feed order and type; decimals stay exact where they are used."""
    out = []
    for field in schemas.FEEDS[feed].fields:
        if field.name not in df.columns:
            out.append(F.lit(None).cast(field.dataType).alias(field.name))
        elif keep_decimals and dict(df.dtypes)[field.name].startswith("decimal"):
            out.append(F.col(field.name))
        else:
            out.append(F.col(field.name).cast(field.dataType).alias(field.name))
    return df.select(*out, *extra)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    places = nation.join(region, nation.n_regionkey == region.r_regionkey)
    people = table(spark, sf_dir, "customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    key = F.col("c_custkey").cast("string")
    email = (
        F.when(F.col("c_acctbal") < 0, F.lit(None).cast("string"))
        .when(_every("c_custkey", 50, 7), F.concat(F.lit("customer-at-mail-"), key))
        .when(_every("c_custkey", 97, 5), F.lit("shared@mail.example.com"))
        .otherwise(F.concat(F.lit("Customer"), key, F.lit("@Mail.example.com")))
    )
    phone = (
        F.when(_every("c_custkey", 33, 2), F.lit(None).cast("string"))
        .when(_every("c_custkey", 10), F.lit("12345"))
        .otherwise(F.concat(F.lit(" +39 (02) 55.x"), F.lpad(key, 9, "0")))
    )
    feed = people.select(
        "c_custkey",
        key.alias("customer_id"),
        _null_if(_every("c_custkey", 40, 3), F.lower("c_mktsegment")).alias("first_name"),
        F.concat(F.lit("  "), F.col("r_name"), F.lit(" ")).alias("last_name"),
        email.alias("email"),
        phone.alias("phone"),
        _null_if(_every("c_custkey", 21, 4), F.concat(F.lit(" Street "), key)).alias("address"),
        F.lower("r_name").alias("city"),
        F.concat(F.lit(" "), F.lower("n_name")).alias("country"),
        _null_if(
            _every("c_custkey", 60, 11), F.date_add(F.lit(EPOCH), (F.col("c_custkey") % 1500).cast("int"))
        ).alias("registration_date"),
        (F.col("c_custkey") % 130).alias("age"),
    )
    # a second delivery without email but with a newer date: ranks below the first
    again = feed.filter(_every("c_custkey", 25, 4)).withColumns(
        {"email": F.lit(None).cast("string"), "registration_date": F.lit(AS_OF)}
    )
    # a newer delivery with a malformed email: ranks first and is then dropped
    broken = feed.filter(_every("c_custkey", 75, 9)).withColumns(
        {"email": F.lit("no address"), "registration_date": F.lit(AS_OF)}
    )
    return _conform(feed.unionByName(again).unionByName(broken), "customers")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    currency = F.when(_every("p_size", 3), "USD").when(_every("p_size", 3, 1), "GBP").otherwise("EUR")
    price = F.col("p_retailprice").cast(MONEY)
    feed = table(spark, sf_dir, "part").select(
        "p_partkey",
        key.cast("string").alias("product_id"),
        _null_if(_every("p_partkey", 45, 8), F.concat("p_name", F.lit(" "))).alias("name"),
        F.lower("p_type").alias("category"),
        _null_if(_every("p_partkey", 4), F.lower("p_name")).alias("subcategory"),
        F.lower("p_brand").alias("brand"),
        F.when(_every("p_partkey", 70, 9), F.lit(0).cast(MONEY)).otherwise(price).alias("price"),
        _null_if(_every("p_partkey", 11), currency).alias("currency"),
        _null_if(_every("p_partkey", 19), F.concat(F.lit(" About "), "p_name")).alias("description"),
        _null_if(_every("p_partkey", 13), _every("p_size", 2)).alias("availability"),
        (F.col("p_size") - 5).alias("stock_quantity"),
        (F.col("p_size") / 8).alias("rating"),
        (key % 200 - 10).alias("reviews_count"),
        _null_if(_every("p_partkey", 17), F.col("p_size") / 16).alias("weight_kg"),
        F.concat(F.lit("nation "), (key % 25).cast("string")).alias("country_origin"),
    )
    # a second delivery without price: ranks below the first
    again = feed.filter(_every("p_partkey", 30, 1)).withColumns(
        {"price": F.lit(None).cast(MONEY), "availability": F.lit(True)}
    )
    return _conform(feed.unionByName(again), "products")


def campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    places = nation.join(region, nation.n_regionkey == region.r_regionkey)
    sellers = table(spark, sf_dir, "supplier").join(places, F.col("s_nationkey") == F.col("n_nationkey"))
    key, budget = F.col("s_suppkey"), F.col("s_acctbal").cast(MONEY)
    start = F.date_add(F.lit(EPOCH), (key * 17 % 2000).cast("int"))
    status = (
        F.when(_every("s_suppkey", 5), "ACTIVE")
        .when(_every("s_suppkey", 5, 1), "PAUSED")
        .when(_every("s_suppkey", 5, 2), "COMPLETED")
        .when(_every("s_suppkey", 5, 3), "active")
    )
    end = (
        F.when(_every("s_suppkey", 8), F.lit(None).cast("date"))
        .when(_every("s_suppkey", 14, 3), F.lit(dt.date(2099, 12, 31)))
        .otherwise(F.date_add(start, (key % 90 - 10).cast("int")))
    )
    feed = sellers.select(
        "s_suppkey",
        key.cast("string").alias("campaign_id"),
        _null_if(_every("s_suppkey", 29, 3), F.concat(F.lit(" Campaign "), key.cast("string"))).alias("name"),
        F.lower("r_name").alias("channel"),
        status.alias("status"),
        _null_if(_every("s_suppkey", 6), F.lit(" everyone ")).alias("target_audience"),
        budget.alias("budget"),
        F.round(budget * (key % 13) * F.lit("0.1").cast("decimal(2,1)"), 2).cast(MONEY).alias("actual_spend"),
        (key % 12 / 10).alias("conversion_rate"),
        (key * 100 - 500).alias("impressions"),
        (key % 7 * 10).alias("clicks"),
        (key % 9).alias("conversions"),
        _null_if(_every("s_suppkey", 23), start).alias("start_date"),
        end.alias("end_date"),
        start.alias("created_date"),
        start.alias("updated_date"),
        F.concat(F.lit("doc-"), key.cast("string")).alias("document_id"),
    )
    # a later delivery that is not running: ranks below an active first one
    again = feed.filter(_every("s_suppkey", 10, 5)).withColumns(
        {"status": F.lit("PAUSED"), "start_date": F.lit(AS_OF)}
    )
    return _conform(feed.unionByName(again), "marketing_campaigns")


def transactions(spark: SparkSession, sf_dir: str, with_order: bool = False) -> DataFrame:
    """The sales feed; `with_order` adds the order of each sale (`ORDER`), by which a large feed comes dealt out."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    # whole units and cents have far fewer bytes than doubles in the shuffle of the join
    types = {"l_quantity": MAX_QUANTITY_TYPE, "l_extendedprice": MONEY, "l_tax": "decimal(4,2)"}
    exact = table(spark, sf_dir, "lineitem").withColumns({name: F.col(name).cast(kind) for name, kind in types.items()})
    lines = exact.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    c, order = F.col, F.col("l_orderkey")
    units = c("l_quantity")
    unit_price = F.round(c("l_extendedprice") / units, 2).cast(MONEY)
    lines = lines.withColumn("__price", unit_price)
    gross = (units * c("__price")).cast(MONEY)
    discount = F.round(gross * c("l_discount").cast("decimal(4,2)"), 2).cast(MONEY)
    tax = F.round(gross * c("l_tax"), 2).cast(MONEY)
    off_by = F.when(_every("l_orderkey", 37), "0.02").when(_every("l_orderkey", 41), "0.01").otherwise("0.00")
    amount = F.when(_every("l_orderkey", 59), F.lit(0).cast(MONEY)).otherwise(
        (gross - discount + tax + off_by.cast(MONEY)).cast(MONEY)
    )
    status = (
        F.when((c("o_orderstatus") == "F") & (c("l_returnflag") == "A"), "COMPLETED")
        .when(c("o_orderstatus") == "F", "completed")
        .when(c("o_orderstatus") == "O", "pending")
        .otherwise("cancelled")
    )
    campaign = F.when(c("l_returnflag") == "R", "").when(c("l_returnflag") == "A", c("l_suppkey").cast("string"))
    method = (
        F.when(c("l_linenumber") == 1, "credit_card")
        .when(c("l_linenumber") == 2, " PayPal ")
        .when(c("l_linenumber") == 3, "cash")
        .when(c("l_linenumber") == 4, "voucher")
        .when(c("l_linenumber") != 5, "bank_transfer")
    )
    feed = lines.select(
        F.concat_ws("-", order.cast("string"), c("l_linenumber").cast("string")).alias("transaction_id"),
        F.when(_every("l_orderkey", 83), "nobody").otherwise(c("o_custkey").cast("string")).alias("customer_id"),
        F.when(_every("l_orderkey", 89), "nothing").otherwise(c("l_partkey").cast("string")).alias("product_id"),
        campaign.alias("campaign_id"),
        F.when(_every("l_orderkey", 101), F.lit(0)).otherwise(units.cast("bigint")).alias("quantity"),
        c("__price").alias("unit_price"),
        amount.alias("amount"),
        _null_if(c("l_discount") == 0, discount).alias("discount_amount"),
        tax.alias("tax_amount"),
        _null_if(_every("l_orderkey", 211), c("l_shipdate")).alias("transaction_date"),
        status.alias("status"),
        method.alias("payment_method"),
        _null_if(_every("l_partkey", 9), F.concat(F.lit(" Dock "), c("l_suppkey").cast("string"))).alias(
            "shipping_address"
        ),
        _null_if(_every("l_partkey", 5), F.lit("ring twice ")).alias("order_notes"),
        c("o_orderdate").alias("created_date"),
        c("l_shipdate").alias("updated_date"),
        order.alias(ORDER),
    )
    return _conform(feed, "sales_transactions", extra=[ORDER] if with_order else [])


def all_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "customers": customers(spark, sf_dir),
        "products": products(spark, sf_dir),
        "marketing_campaigns": campaigns(spark, sf_dir),
        "sales_transactions": transactions(spark, sf_dir),
    }


# Which pipeline step each kind of event stands for in the run log.
EVENT_STEPS = {
    "click": "customers",
    "view": "products",
    "signup": "marketing_campaigns",
    "purchase": "sales_transactions",
    "error": "dim_customers",
}


def _step(event_type: Column, part: int) -> Column:
    from basketwork.functions.numbers import first_match
    from basketwork.operators.lineage_seeds import CAPTURES

    rules = [(event_type == kind, CAPTURES[name][part]) for kind, name in EVENT_STEPS.items()]
    return first_match(rules, None)


def captured_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineage captures of a run history: each event is one captured relationship."""
    c, kind = F.col, F.col("event_type")
    rule = F.when(_every("user_id", 7), F.lit("TRANS_NOT_REGISTERED")).otherwise(_step(kind, 2))
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("RT_"), kind, F.lit("_"), c("event_id").cast("string")).alias("relationship_id"),
        _step(kind, 0).alias("source_id"),
        _step(kind, 1).alias("target_id"),
        rule.alias("transformation_id"),
        _step(kind, 3).alias("relationship_type"),
        (_step(kind, 4).cast("decimal(4,2)") - (c("user_id") % 4) * F.lit("0.05").cast("decimal(3,2)"))
        .cast("double")
        .alias("confidence_score"),
        _step(kind, 5).alias("pipeline_name"),
        F.concat(F.lit("dag_"), kind).alias("dag_id"),
        F.concat(F.lit("task_"), (c("user_id") % 5).cast("string")).alias("task_id"),
        c("ts").cast("timestamp").alias("execution_date"),
        c("ts").cast("timestamp").alias("created_timestamp"),
        (~_every("event_id", 10)).alias("is_active"),
    )


def execution_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An append-only log: each event starts an execution, most also end it."""
    c, kind = F.col, F.col("event_type")
    events = table(spark, sf_dir, "events").withColumns(
        {"__start": c("ts").cast("timestamp"), "__seconds": F.floor("value").cast("bigint")}
    )
    ids = [
        F.concat(kind, F.lit("_"), c("event_id").cast("string")).alias("execution_id"),
        F.concat(F.lit("dag_"), kind).alias("dag_id"),
        F.concat(F.lit("task_"), (c("user_id") % 5).cast("string")).alias("task_id"),
        F.concat(F.lit("run_"), c("user_id").cast("string")).alias("run_id"),
        F.lit("").alias("source_table"),
        _step(kind, 1).alias("target_table"),
    ]
    failed = kind == "error"
    start = events.select(
        *ids,
        F.lit(None).cast("bigint").alias("records_processed"),
        F.lit("RUNNING").alias("execution_status"),
        c("__start").alias("start_time"),
        F.lit(None).cast("timestamp").alias("end_time"),
        F.lit(None).cast("bigint").alias("execution_duration_seconds"),
        F.lit(None).cast("string").alias("error_message"),
        F.lit(False).alias("lineage_captured"),
        c("__start").alias("created_timestamp"),
    )
    ended_at = c("__start") + F.make_dt_interval(secs=c("__seconds").cast("decimal(18,6)"))
    end = events.filter(~_every("user_id", 20)).select(
        *ids,
        F.when(failed, F.lit(0)).otherwise(F.get_json_object("props", "$.k").cast("bigint")).alias("records_processed"),
        F.when(failed, "FAILED").otherwise("SUCCESS").alias("execution_status"),
        c("__start").alias("start_time"),
        ended_at.alias("end_time"),
        c("__seconds").alias("execution_duration_seconds"),
        F.when(failed, F.concat(F.lit("code "), F.get_json_object("props", "$.k"))).otherwise(F.lit("")).alias(
            "error_message"
        ),
        F.lit(True).alias("lineage_captured"),
        ended_at.alias("created_timestamp"),
    )
    return start.unionByName(end)

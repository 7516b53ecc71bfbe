"""The domain's raw tables, derived from the test tables.

Every raw table covers the whole test table it comes from. JSON sources carry the payload
as text plus ``_loaded_at`` and ``_source_file``, the way the loaders land them.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import cents_of, html_text, money_from_cents, whole_div

AS_OF = dt.date(2024, 1, 31)
RUN_TS = dt.datetime(2024, 1, 31, 8, 0, 0)

# Fixed values of the domain, in the order the adapters number them.
CASE_CATEGORIES = (
    "CARD_DECLINE",
    "UNAUTHORIZED_TRANSACTION",
    "FEE_INQUIRY",
    "ACCOUNT_ACCESS",
    "PAYMENT_FAILURE",
    "ACCOUNT_CLOSURE",
)
CHANNELS = ("ONLINE", "IN_STORE", "MOBILE_APP", "ATM")
ACCOUNT_TYPES = ("CHECKING", "SAVINGS", "CREDIT")
INDUSTRIES = ("GROCERY", "TRAVEL", "FUEL", "DINING", "RETAIL", "UTILITIES")
PRIORITIES = ("HIGH", "MEDIUM", "LOW")
CASE_STATUSES = ("OPEN", "ESCALATED", "RESOLVED", "RESOLVED")
RATINGS = ("HIGH", "MEDIUM", "MEDIUM", "LOW", "LOW")


# The columns that tell the rows of each larger table apart.
ROW_KEYS = {
    "lineitem": ["l_orderkey", "l_linenumber", "l_partkey"],
    "orders": ["o_orderkey"],
    "customer": ["c_custkey"],
    "events": ["event_id"],
    "documents": ["doc_id"],
    "pages": ["page_id"],
    "embeddings": ["vec_id"],
}
FEW_SPLITS = 8
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """A test table. ``spread`` is for costly work per row: a table that is read in fewer parts than
    there are cores is spread over them first. A table of many parts is never shuffled for that."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if spread and df.rdd.getNumPartitions() < min(FEW_SPLITS, spark.sparkContext.defaultParallelism):
        return df.repartition(FEW_SPLITS, *ROW_KEYS[name])
    return df


def _pick(values: tuple[str, ...], index: Column) -> Column:
    chain = F.when(index == 0, values[0])
    for i, value in enumerate(values[1:], start=1):
        chain = chain.when(index == i, value)
    return chain


def _ntz(value: dt.datetime) -> Column:
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def _text(col: Column) -> Column:
    return col.cast("string")


def _rows(df: DataFrame, *columns: Column) -> DataFrame:
    """Projects through inline(), so that a payload is built once per row however often it is read."""
    return df.select(F.inline(F.array(F.struct(*columns))))


def _plus(ts: Column, days: Column | int = 0, hours: Column | int = 0) -> Column:
    day = F.lit(days) if isinstance(days, int) else days
    hour = F.lit(hours) if isinstance(hours, int) else hours
    return ts.cast("timestamp_ntz") + F.make_dt_interval(day.cast("int"), hour.cast("int"))


# ---------------------------------------------------------------- settlements


def raw_settlements(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem", spread=True)
    amount_cents = whole_div(cents_of(F.col("l_extendedprice")), F.lit(100))
    ts = _plus(F.col("l_shipdate"), 8120, F.col("l_partkey") % 24)
    sid = F.concat_ws(
        "-",
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        cents_of(F.col("l_quantity")),
        cents_of(F.col("l_extendedprice")),
        F.to_date("l_shipdate"),
    )
    status = (
        F.when(F.col("l_partkey") % (F.col("l_suppkey") % 4 + 6) == 0, "FAILED")
        .when((F.col("l_linestatus") == "O") & (F.col("l_linenumber") == 1), "PENDING")
        .otherwise("SETTLED")
    )
    day = F.to_date(ts)
    return li.select(
        sid.alias("settlement_id"),
        F.concat(F.lit("S"), sid).alias("transaction_id"),
        _text(F.col("l_orderkey")).alias("account_id"),
        _text(F.col("l_suppkey")).alias("merchant_id"),
        ts.alias("transaction_timestamp"),
        F.date_add(day, 1).alias("settlement_date"),
        money_from_cents(amount_cents).alias("amount"),
        F.lit("USD").alias("currency"),
        status.alias("settlement_status"),
        money_from_cents(whole_div(amount_cents, F.lit(100))).alias("fee_amount"),
        _plus(day, 1, 2).alias("_loaded_at"),
        F.concat(F.lit("settlements/"), _text(day), F.lit(".csv")).alias("_source_file"),
    )


# ------------------------------------------------------- partner transactions


def partner_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The authorization events before they are turned into JSON lines."""
    ev = table(spark, sf_dir, "events", spread=True)
    user = F.col("user_id")
    return ev.select(
        _text(F.col("event_id")).alias("event_id"),
        F.concat(F.lit("T"), "event_id").alias("transaction_id"),
        F.when(user % 50 == 7, F.concat(F.lit("X"), user)).otherwise(_text(user)).alias("account_id"),
        _text(F.col("event_id") % 10).alias("merchant_id"),
        _text(F.col("ts")).alias("event_timestamp"),
        money_from_cents(cents_of(F.col("value"))).alias("amount"),
        F.lit("USD").alias("currency"),
        F.when(F.col("event_type") == "error", "DECLINED")
        .when(F.col("event_type") == "view", "PENDING")
        .otherwise("APPROVED")
        .alias("authorization_status"),
        _pick(CHANNELS, user % 4).alias("channel"),
        F.concat(F.lit("D"), F.regexp_extract("props", "([0-9]+)", 1)).alias("device_id"),
        F.col("ts").alias("_ts"),
        F.col("event_id").alias("_n"),
    )


PARTNER_FIELDS = (
    "event_id",
    "transaction_id",
    "account_id",
    "merchant_id",
    "event_timestamp",
    "amount",
    "currency",
    "authorization_status",
    "channel",
    "device_id",
)


def _four_hourly(ts: Column, folder: str) -> tuple[Column, Column]:
    """Load time and file name of a feed that arrives every four hours."""
    block = whole_div(F.hour(ts), F.lit(4))
    loaded = _plus(F.to_date(ts), 0, block * 4 + 4)
    name = F.concat(F.lit(f"{folder}/"), _text(F.to_date(ts)), F.lit("-"), _text(block), F.lit(".json"))
    return loaded, name


def raw_partner_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded, name = _four_hourly(F.col("_ts"), "partner_transactions")
    return _rows(
        partner_events(spark, sf_dir),
        F.to_json(F.struct(*PARTNER_FIELDS)).alias("raw_payload"),
        loaded.alias("_loaded_at"),
        name.alias("_source_file"),
    )


def dirty_partner_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same feed with defects: absent keys, explicit nulls and broken lines."""
    n = F.col("_n")
    loaded, name = _four_hourly(F.col("_ts"), "partner_transactions")
    whole = F.to_json(F.struct(*PARTNER_FIELDS))
    no_account = F.to_json(F.struct(*[f for f in PARTNER_FIELDS if f != "account_id"]))
    null_merchant = F.to_json(
        F.struct(*[F.lit(None).cast("string").alias(f) if f == "merchant_id" else f for f in PARTNER_FIELDS]),
        {"ignoreNullFields": "false"},
    )
    line = (
        F.when(n % 53 == 0, F.concat(F.lit("{broken "), whole))
        .when(n % 37 == 0, no_account)
        .when(n % 41 == 0, null_merchant)
        .otherwise(whole)
    )
    return _rows(
        partner_events(spark, sf_dir),
        line.alias("value"),
        loaded.alias("_loaded_at"),
        name.alias("_source_file"),
    )


# ----------------------------------------------------------- account activity


def raw_account_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events", spread=True)
    loaded, name = _four_hourly(F.col("ts"), "account_activity")
    status = (
        F.when(F.col("event_type") == "error", "FROZEN")
        .when(F.col("event_type") == "view", "CLOSED")
        .otherwise("OPEN")
    )
    payload = F.struct(
        _text(F.col("user_id")).alias("account_id"),
        _text(F.col("user_id")).alias("customer_id"),
        status.alias("account_status"),
        money_from_cents(cents_of(F.col("value"), 1000)).alias("current_balance"),
        F.lit("USD").alias("currency"),
        _text(F.col("ts")).alias("updated_at"),
    )
    return _rows(
        ev, F.to_json(payload).alias("raw_payload"), loaded.alias("_loaded_at"), name.alias("_source_file")
    )


# -------------------------------------------------------------- support cases


def raw_support_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", spread=True)
    i = F.col("doc_id")
    opened = _plus(_ntz(dt.datetime(2024, 1, 1)), 0, i % 720)
    payload = F.struct(
        _text(i).alias("case_id"),
        _text(i % 150).alias("customer_id"),
        _pick(CASE_CATEGORIES, i % 6).alias("category"),
        _pick(PRIORITIES, i % 3).alias("priority"),
        _pick(CASE_STATUSES, i % 4).alias("status"),
        F.col("text").alias("narrative"),
        _text(opened).alias("opened_at"),
    )
    return _rows(
        docs,
        F.to_json(payload).alias("raw_payload"),
        _plus(F.to_date(opened), 1, 2).alias("_loaded_at"),
        F.concat(F.lit("support_cases/"), _text(F.to_date(opened)), F.lit(".json")).alias("_source_file"),
    )


# ---------------------------------------------------------- versioned entities


def _envelope(records: Column) -> Column:
    return F.to_json(F.struct(records.alias("records")))


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One envelope per customer; every fourth one carries an outdated version as well."""
    cust = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    created = _plus(_ntz(dt.datetime(2015, 1, 1)), k % 2500)

    def version(status: Column, rating: Column, updated: Column) -> Column:
        return F.struct(
            _text(k).alias("customer_id"),
            F.lit("Customer").alias("first_name"),
            F.expr("substring(c_name, 10)").alias("last_name"),
            F.concat(F.lit("c"), k, F.lit("@example.com")).alias("email"),
            F.concat(F.lit("+1-555-"), F.lpad(_text(k % 10000), 4, "0")).alias("phone"),
            F.concat(F.lit("City "), k % 97).alias("city"),
            F.concat(F.lit("S"), k % 50).alias("state"),
            F.lit("US").alias("country"),
            status.alias("customer_status"),
            rating.alias("risk_rating"),
            _text(created).alias("created_at"),
            _text(updated).alias("updated_at"),
        )

    status = F.when(k % 10 < 7, "ACTIVE").when(k % 10 < 9, "DORMANT").otherwise("CLOSED")
    rating = F.when(k % 11 != 0, _pick(RATINGS, k % 5))
    old = version(F.lit("ACTIVE"), F.lit("LOW"), created)
    new = version(status, rating, _plus(created, 30))
    return _rows(
        cust,
        _envelope(F.when(k % 4 == 0, F.array(old, new)).otherwise(F.array(new))).alias("raw_payload"),
        _ntz(dt.datetime(2024, 1, 2)).alias("_loaded_at"),
        F.concat(F.lit("customers/"), _text(k % 16), F.lit(".json")).alias("_source_file"),
    )


def raw_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One envelope per account. Customers whose number ends the pattern below own none."""
    orders = table(spark, sf_dir, "orders", spread=True)
    k, owner = F.col("o_orderkey"), F.col("o_custkey")
    created = F.col("o_orderdate")

    def version(status: Column, cents: Column, updated: Column) -> Column:
        return F.struct(
            _text(k).alias("account_id"),
            _text(owner + F.when(owner % 50 == 7, 1).otherwise(0)).alias("customer_id"),
            _pick(ACCOUNT_TYPES, k % 3).alias("account_type"),
            status.alias("account_status"),
            money_from_cents(cents).alias("current_balance"),
            F.lit("USD").alias("currency"),
            _text(created).alias("created_at"),
            _text(updated).alias("updated_at"),
        )

    status = (
        F.when(k % 20 == 0, "FROZEN").when(F.col("o_orderstatus") == "F", "CLOSED").otherwise("OPEN")
    )
    old = version(F.lit("OPEN"), F.lit(0), created)
    new = version(status, cents_of(F.col("o_totalprice")), _plus(created, 10))
    return _rows(
        orders,
        _envelope(F.when(k % 4 == 0, F.array(old, new)).otherwise(F.array(new))).alias("raw_payload"),
        _ntz(dt.datetime(2024, 1, 2)).alias("_loaded_at"),
        F.concat(F.lit("accounts/"), _text(k % 16), F.lit(".json")).alias("_source_file"),
    )


def raw_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of every merchant; the later one has the true risk class."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    rows = table(spark, sf_dir, "supplier").join(
        nation, F.col("s_nationkey") == F.col("n_nationkey"), "left"
    )
    k = F.col("s_suppkey")

    def version(risk: Column) -> Column:
        return F.array(
            F.struct(
                _text(k).alias("merchant_id"),
                F.col("s_name").alias("merchant_name"),
                _text(F.col("s_nationkey") + 5000).alias("merchant_category_code"),
                _pick(INDUSTRIES, k % 6).alias("industry"),
                F.col("n_name").alias("country"),
                risk.alias("risk_category"),
            )
        )

    risk = F.when(F.col("s_acctbal") < 1000, "HIGH").when(F.col("s_acctbal") < 5000, "MEDIUM").otherwise("LOW")
    loads = F.array(
        F.struct(
            _envelope(version(F.lit("LOW"))).alias("raw_payload"),
            _ntz(dt.datetime(2024, 1, 1)).alias("_loaded_at"),
            F.lit("merchants/2024-01-01.json").alias("_source_file"),
        ),
        F.struct(
            _envelope(version(risk)).alias("raw_payload"),
            _ntz(dt.datetime(2024, 1, 2)).alias("_loaded_at"),
            F.lit("merchants/2024-01-02.json").alias("_source_file"),
        ),
    )
    return rows.select(F.inline(loads))


# ------------------------------------------------------ rates and documents


def raw_exchange_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payload per day on which events happened, with a rate for each nation's code."""
    keys = table(spark, sf_dir, "nation").agg(F.sort_array(F.collect_list("n_nationkey"))).scalar()
    days = (
        table(spark, sf_dir, "events")
        .select(F.to_date("ts").alias("day"))
        .distinct()
        .withColumn("keys", keys)
    )
    micro = lambda k: F.lit(500_000) + k * 10_000 + F.dayofmonth("day") * 100
    rates = F.map_from_entries(
        F.transform(
            "keys",
            lambda k: F.struct(
                F.concat(F.lit("C"), k),
                (micro(k).cast("decimal(14,0)") * F.lit(Decimal("0.000001"))).cast("decimal(12,6)"),
            ),
        )
    )
    payload = F.struct(
        F.lit("USD").alias("base_currency"),
        F.concat(_text(F.col("day")), F.lit(" 06:00:00")).alias("ingested_at"),
        F.struct(_text(F.col("day")).alias("date"), rates.alias("rates")).alias("payload"),
    )
    return _rows(
        days,
        F.to_json(payload).alias("raw_payload"),
        _plus(F.col("day"), 0, 6).alias("_loaded_at"),
        F.concat(F.lit("exchange_rates/"), _text(F.col("day")), F.lit(".json")).alias("_source_file"),
    )


def raw_policy_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", spread=True)
    texts = _rows(pages, F.col("url").alias("file_name"), html_text(F.col("html")).alias("extracted_text"))
    return texts.select(
        "file_name",
        "extracted_text",
        (whole_div(F.length("extracted_text"), F.lit(3000)) + 1).cast("int").alias("page_count"),
        _ntz(dt.datetime(2024, 1, 2)).alias("_loaded_at"),
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "settlements": raw_settlements(spark, sf_dir),
        "partner_transactions": raw_partner_transactions(spark, sf_dir),
        "customers_api_raw": raw_customers(spark, sf_dir),
        "accounts_api_raw": raw_accounts(spark, sf_dir),
        "merchants_api_raw": raw_merchants(spark, sf_dir),
        "support_cases": raw_support_cases(spark, sf_dir),
        "policy_documents": raw_policy_documents(spark, sf_dir),
        "external_exchange_rates": raw_exchange_rates(spark, sf_dir),
        "account_activity": raw_account_activity(spark, sf_dir),
    }

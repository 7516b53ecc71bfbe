"""Registered queries. Each reads whole test tables and returns one DataFrame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.buckets import BucketTable
from tidemark.catalog.models import Models
from tidemark.functions import columns as C
from tidemark.operators import drift, log_triage, quality, routing
from tidemark.operators.ranking import auc_exact
from tidemark.operators.vector_index import VectorIndex
from tidemark.plans import churn, extras, health, ingest, inventory, semantic
from tidemark.plans import intermediate as I
from tidemark.plans.graph import build_models
from tidemark.plans.suite import FRESHNESS, PARITY, SUITE
from tidemark.session import new_folder, settle, shared_root, shuffles_removed
from tidemark.sources import files
from tidemark.sources import tables as R
from tidemark.sources.tables import AS_OF, RUN_TS, table
from tidemark.state import ReplacedTable, read_batches, write_batch
from tidemark.streaming import cdc, index
from tidemark.streaming import ingest as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
DAY = dt.timedelta(days=1)
NULLABLE_FLAGS = {"has_risk_flag"}  # three-valued, shown as text


def to_plain(df: DataFrame) -> DataFrame:
    """Result columns in types any engine shows alike: whole numbers, doubles, booleans and text."""

    def plain(f: T.StructField):
        col = F.col(f"`{f.name}`")
        if f.name in NULLABLE_FLAGS:
            return col.cast("string").alias(f.name)
        if isinstance(f.dataType, T.DecimalType):
            return col.cast("double").alias(f.name)
        if isinstance(f.dataType, (T.DateType, T.TimestampNTZType, T.TimestampType)):
            return col.cast("string").alias(f.name)
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            return col.cast("bigint").alias(f.name)
        return col

    return df.select(*[plain(f) for f in df.schema.fields])


def query(fn: Callable[[Models], DataFrame]) -> Callable[[Models], DataFrame]:
    """Register a function of the models under its own name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return to_plain(fn(Models(spark, sf_dir)))

    QUERIES[fn.__name__] = run
    return fn


# ------------------------------------------------------------ sources and scans


STAGED_ROWS = 1_000_000  # of a file, so that no compressed file is long


def _stage_csv(m: Models) -> str:
    stage = new_folder(m.spark, "stage-settlements")
    rows = m.raw("settlements").select(*[n for n, _ in files.SETTLEMENT_CSV])
    writer = rows.write.option("header", True).option("maxRecordsPerFile", STAGED_ROWS)
    writer.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").csv(stage)
    return stage


def _stage_json(m: Models, source: str, column: str = "raw_payload") -> str:
    stage = new_folder(m.spark, f"stage-{source}")
    m.raw(source).select(column).write.text(stage)
    return stage


@query
def scan_settlements_csv(m: Models) -> DataFrame:
    return files.read_csv_strict(m.spark, _stage_csv(m)).drop("_source_file")


@query
def scan_ndjson_variant(m: Models) -> DataFrame:
    rows = files.read_ndjson_variant(m.spark, _stage_json(m, "account_activity"))
    return rows.groupBy(F.variant_get("raw_payload", "$.account_status", "string").alias("account_status")).agg(
        F.count("*").alias("n_rows"),
        F.sum(F.variant_get("raw_payload", "$.current_balance", "decimal(12,2)")).alias("balance"),
        F.max(F.variant_get("raw_payload", "$.updated_at", "timestamp_ntz")).alias("last_update"),
    )


@query
def scan_with_source_file(m: Models) -> DataFrame:
    rows = files.with_source(table(m.spark, m.sf_dir, "events"))
    return rows.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("_source_file").isNull()).alias("rows_without_source"),
        F.bool_and(F.contains("_source_file", F.lit("/events.parquet"))).alias("all_from_events"),
    )


@query
def load_lenient(m: Models) -> DataFrame:
    stage = new_folder(m.spark, "stage-dirty")
    R.dirty_partner_lines(m.spark, m.sf_dir).select("value").write.text(stage)
    rows = files.read_ndjson_lenient(m.spark, stage)
    event = F.get_json_object(F.when(~F.col("_is_bad"), F.col("raw_payload")), "$.event_id").cast("bigint")
    return rows.groupBy("_is_bad").agg(F.count("*").alias("n_rows"), F.coalesce(F.sum(event), F.lit(0)).alias("event_id_sum"))


@query
def load_strict(m: Models) -> DataFrame:
    """A clean folder loads whole; the same rows with defects load not at all."""
    clean = files.read_ndjson_strict(m.spark, _stage_json(m, "partner_transactions"))
    stage, target = new_folder(m.spark, "stage-dirty"), new_folder(m.spark, "strict")
    R.dirty_partner_lines(m.spark, m.sf_dir).select("value").write.text(stage)
    refused = False
    try:
        files.read_ndjson_strict(m.spark, stage).write.parquet(target)
    except PySparkException as problem:
        if "not JSON in" not in str(problem):
            raise
        refused = True
    return clean.agg(F.count("*").alias("loaded_rows")).withColumn("defective_refused", F.lit(refused))


@query
def load_once_ledger(m: Models) -> DataFrame:
    """The same stage loaded twice: the second run finds nothing new."""
    lake = ingest.Lake(m.spark, new_folder(m.spark, "lake"))
    stage = _stage_json(m, "account_activity")
    first = ingest.validate_and_load(m.spark, ingest.ACCOUNT_ACTIVITY, stage, lake, RUN_TS)
    second = ingest.validate_and_load(m.spark, ingest.ACCOUNT_ACTIVITY, stage, lake, RUN_TS + DAY)
    return lake.raw("account_activity").agg(F.count("*").alias("raw_rows")).withColumns(
        {"first_run": F.lit(first.message), "second_run": F.lit(second.message)}
    )


def _dirty_rows(m: Models) -> DataFrame:
    rows = R.dirty_partner_lines(m.spark, m.sf_dir)
    return rows.withColumn("_is_bad", ~routing.readable_json(F.col("value")))


@query
def load_history_errors(m: Models) -> DataFrame:
    return health.load_history_errors(health.load_history(_dirty_rows(m)), RUN_TS)


@query
def directory_listing(m: Models) -> DataFrame:
    """The files of every test table next to the rows that are read from them."""
    listed = files.list_files(m.spark, m.sf_dir, "*.parquet")
    owner = F.regexp_extract("relative_path", "^([^/]+)", 1)
    sizes = listed.groupBy(owner.alias("listed_as")).agg(F.bool_and(F.col("size") > 0).alias("all_have_size"))
    counts = [table(m.spark, m.sf_dir, n).agg(F.count("*").alias("n_rows")).withColumn("name", F.lit(f"{n}.parquet")) for n in R.TABLES]
    found = reduce(DataFrame.unionByName, counts)
    return sizes.join(found, F.col("listed_as") == F.col("name")).select("listed_as", "all_have_size", "n_rows")


@query
def document_load(m: Models) -> DataFrame:
    """Every page as a file of its own: listed, extracted, appended, and previewed from what was stored."""
    folder, loaded = new_folder(m.spark, "documents"), new_folder(m.spark, "loaded-documents")
    pages = table(m.spark, m.sf_dir, "pages").select(F.col("url").alias("name"), F.coalesce("html", F.lit("")).alias("html"))
    staged = files.stage_documents(pages, folder, "name", "html")  # an url may have several pages
    for i in range(0, len(staged), files.FOLDERS_PER_LOAD):
        group = staged[i : i + files.FOLDERS_PER_LOAD]
        documents = files.load_documents(m.spark, group, "*.txt", files.html_document, RUN_TS, named_by="name")
        write_batch(documents, loaded, f"b{i // files.FOLDERS_PER_LOAD + 1}", compression="zstd")
    return files.preview(read_batches(m.spark, loaded, f"{files.DOCUMENT_SCHEMA}, _loaded_at timestamp_ntz"))


@query
def document_text(m: Models) -> DataFrame:
    return m.raw("policy_documents").select("file_name", "extracted_text", "page_count")


@query
def parse_json_insert(m: Models) -> DataFrame:
    rows = files.parse_payload(m.raw("exchange_rates").select(F.col("raw_payload").alias("value")))
    return rows.select(
        F.variant_get("raw_payload", "$.payload.date", "string").alias("rate_date"),
        F.variant_get("raw_payload", "$.base_currency", "string").alias("base_currency"),
        F.variant_get("raw_payload", "$.payload.rates.C3", "double").alias("rate_c3"),
    )


# ------------------------------------------------------------------------ sinks

DAILY_SCHEMA = "account_id string, updated_at timestamp_ntz, balance decimal(12,2)"


def _activity_states(m: Models) -> DataFrame:
    return m.stg_account_activity.select("account_id", F.col("activity_timestamp").alias("updated_at"), "balance")


@query
def sink_append(m: Models) -> DataFrame:
    """Two appended batches, the first repeated as after a lost driver."""
    path = new_folder(m.spark, "append")
    rows = m.stg_settlements.select("settlement_id", "amount", "settlement_status")
    for batch, part in (
        ("b1", rows.where("settlement_status = 'FAILED'")),
        ("b1", rows.where("settlement_status = 'FAILED'")),
        ("b2", rows.where("settlement_status <> 'FAILED'")),
    ):
        write_batch(part, path, batch)
    back = read_batches(m.spark, path, rows.schema)
    return back.groupBy("batch_id").agg(F.count("*").alias("n_rows"), F.sum("amount").alias("amount"))


@query
def sink_overwrite(m: Models) -> DataFrame:
    target = ReplacedTable(m.spark, new_folder(m.spark, "replace"), "account_id string, n bigint")
    counts = m.stg_account_activity.groupBy("account_id").agg(F.count("*").alias("n"))
    target.overwrite(counts.withColumn("n", F.lit(0).cast("bigint")), "v1")
    target.overwrite(counts, "v2")
    return target.read()


@query
def sink_upsert(m: Models) -> DataFrame:
    """State after merging the activity log in two batches, the later half first."""
    state = BucketTable(m.spark, new_folder(m.spark, "upsert"), DAILY_SCHEMA, "account_id", ["updated_at"], ["balance"], buckets=8)
    half = F.col("updated_at") >= F.lit("2024-01-16").cast("timestamp_ntz")
    rows = _activity_states(m)
    state.update(rows.where(half), "b1")
    state.update(rows.where(~half), "b2")
    return state.read()


@query
def materialize_models(m: Models) -> DataFrame:
    """Row counts of the models written as tables."""
    built = build_models(m.spark, R.raw_tables(m.spark, m.sf_dir), AS_OF, new_folder(m.spark, "models"))
    written = {n: df for n, df in built.items() if not n.startswith("stg_")}
    counted = [df.agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("model"), "n_rows") for n, df in written.items()]
    return reduce(DataFrame.unionByName, counted)


# ------------------------------------------------------ governance and quality


@query
def json_key_set(m: Models) -> DataFrame:
    return drift.json_key_set(m.raw("partner_transactions"))


@query
def csv_header_set(m: Models) -> DataFrame:
    return drift.header_key_set(files.csv_headers(m.spark, _stage_csv(m)))


def _key_baseline(m: Models) -> DataFrame:
    """Keys seen in customer records, taken as what partner events used to carry too."""
    names = [*R.PARTNER_FIELDS, "merchant_country", "card_network"]
    known = F.explode(F.array(*[F.lit(n.upper()) for n in names])).alias("column_key")
    stamp = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return m.spark.range(1).select(
        F.lit("partner_transactions").alias("source_name"),
        known,
        stamp.alias("first_seen_at"),
        stamp.alias("last_seen_at"),
    )


@query
def drift_missing_keys(m: Models) -> DataFrame:
    return drift.missing_keys(_key_baseline(m), drift.json_key_set(m.raw("partner_transactions")))


@query
def null_key_count(m: Models) -> DataFrame:
    feeds = {name: (m.raw(name), spec) for name, spec in ingest.SPECS.items()}
    partner = ingest.SourceSpec("partner_transactions", quality.BatchLabels("", ""), routing.KEY_FIELDS)
    feeds["partner_transactions"] = (_readable_dirty(m), partner)
    counted = [
        quality.batch_counters(spec.keys(rows), spec.required).select(F.lit(name).alias("source_name"), "null_rows")
        for name, (rows, spec) in feeds.items()
    ]
    return reduce(DataFrame.unionByName, counted)


@query
def dup_key_count(m: Models) -> DataFrame:
    """Of settlement ids none repeats; account ids repeat once per later settlement."""
    by_id = quality.duplicate_rows(m.raw("settlements"), F.col("settlement_id"))
    by_account = quality.duplicate_rows(m.raw("settlements"), F.col("account_id"))
    return by_id.select(F.lit("settlement_id").alias("key_column"), "duplicate_rows").unionByName(
        by_account.select(F.lit("account_id").alias("key_column"), "duplicate_rows")
    )


@query
def batch_row_count(m: Models) -> DataFrame:
    return m.raw("settlements").groupBy("_source_file").agg(F.count("*").alias("rows_loaded"))


@query
def batch_verdict(m: Models) -> DataFrame:
    """The verdict on each file of the defective feed, as if each were a batch."""
    rows = _dirty_rows(m).where("NOT _is_bad").withColumnRenamed("value", "raw_payload")
    absent = [F.get_json_object("raw_payload", f"$.{k}").isNull() for k in routing.KEY_FIELDS]
    any_absent = absent[0] | absent[1] | absent[2]
    counters = rows.groupBy("_source_file").agg(
        F.count("*").alias("rows_loaded"),
        F.count_if(any_absent).alias("null_rows"),
        (F.count("*") - F.countDistinct(F.get_json_object("raw_payload", "$.device_id"))).alias("duplicate_rows"),
    )
    labels = quality.BatchLabels("Schema drift: missing fields ", " rows with missing keys.", " duplicate device_id(s) found.")
    return quality.batch_verdict(counters.withColumn("missing_keys", F.lit("")), labels).select(
        "_source_file", "rows_loaded", F.coalesce("error_message", F.lit("ok")).alias("verdict")
    )


def _load(m: Models, source: str) -> DataFrame:
    lake = ingest.Lake(m.spark, new_folder(m.spark, "lake"))
    stage = _stage_csv(m) if source == "settlements" else _stage_json(m, source)
    result = ingest.validate_and_load(m.spark, ingest.SPECS[source], stage, lake, RUN_TS)
    audit = lake.audit().select(
        "source_name", "status", "rows_loaded", "duplicate_rows", "null_rows", F.coalesce("error_message", F.lit("")).alias("error_message")
    )
    keys = lake.baseline(source).agg(F.count("*").alias("n")).scalar()
    raw_rows = lake.raw(source).agg(F.count("*").alias("n")).scalar()
    # the message counts the rows of this run; for rates the rows are files of one line each
    return audit.withColumns({"message": F.lit(result.message), "known_keys": keys, "raw_rows": raw_rows})


@query
def validate_and_load_settlements(m: Models) -> DataFrame:
    return _load(m, "settlements")


@query
def validate_and_load_support_cases(m: Models) -> DataFrame:
    return _load(m, "support_cases")


@query
def validate_and_load_account_activity(m: Models) -> DataFrame:
    return _load(m, "account_activity")


@query
def validate_and_load_exchange_rates(m: Models) -> DataFrame:
    return _load(m, "exchange_rates")


@query
def audit_append(m: Models) -> DataFrame:
    """A good batch and a refused one both leave a record."""
    lake = ingest.Lake(m.spark, new_folder(m.spark, "lake"))
    stage = _stage_json(m, "support_cases")
    ingest.validate_and_load(m.spark, ingest.SUPPORT_CASES, stage, lake, RUN_TS)
    m.raw("support_cases").select("raw_payload").unionByName(m.raw("support_cases").select("raw_payload")).write.mode(
        "append"
    ).text(stage)
    try:
        ingest.validate_and_load(m.spark, ingest.SUPPORT_CASES, stage, lake, RUN_TS + DAY)
    except ingest.ValidationFailed:
        pass
    return lake.audit().withColumn("error_message", F.coalesce("error_message", F.lit("")))


@query
def promote_new_files(m: Models) -> DataFrame:
    lake = ingest.Lake(m.spark, new_folder(m.spark, "lake"))
    ingest.validate_and_load(m.spark, ingest.SETTLEMENTS, _stage_csv(m), lake, RUN_TS)
    return (
        lake.raw("settlements")
        .groupBy("settlement_status")
        .agg(F.count("*").alias("n_rows"), F.sum("amount").alias("amount"), F.sum("fee_amount").alias("fees"))
    )


@query
def snapshot_upsert(m: Models) -> DataFrame:
    actual = drift.json_key_set(m.raw("partner_transactions"))
    return drift.snapshot_upsert(_key_baseline(m), actual, "partner_transactions", files.ntz(RUN_TS))


@query
def load_audit(m: Models) -> DataFrame:
    lake = ingest.Lake(m.spark, new_folder(m.spark, "lake"))
    ingest.validate_and_load(m.spark, ingest.SUPPORT_CASES, _stage_json(m, "support_cases"), lake, RUN_TS)
    records = read_batches(m.spark, lake.path("load_audit", "support_cases"), ingest.LOAD_AUDIT_SCHEMA)
    return records.groupBy("source_system", "target_table", "load_status").agg(F.sum("row_count").alias("row_count"))


@query
def run_records(m: Models) -> DataFrame:
    lake = ingest.Lake(m.spark, new_folder(m.spark, "lake"))
    ingest.validate_and_load(m.spark, ingest.ACCOUNT_ACTIVITY, _stage_json(m, "account_activity"), lake, RUN_TS)
    rows = lake.raw("account_activity").agg(F.count("*").alias("n")).scalar()
    ingest.record_run(lake, "account_activity_load", "MANUAL", "SUCCESS", RUN_TS, RUN_TS + DAY)
    return ingest.record_run(lake, "models", "SCHEDULED", "SUCCESS", RUN_TS, RUN_TS + DAY).withColumn("raw_rows", rows)


def _readable_dirty(m: Models) -> DataFrame:
    return _dirty_rows(m).where("NOT _is_bad").select(F.col("value").alias("raw_payload"), "_loaded_at", "_source_file")


def _typed_keys(df: DataFrame) -> DataFrame:
    keys = [F.get_json_object("raw_payload", f"$.{k}").alias(k) for k in routing.KEY_FIELDS]
    return df.select(*keys, "_source_file")


@query
def clean_split(m: Models) -> DataFrame:
    return _typed_keys(routing.clean_split(_readable_dirty(m)))


@query
def quarantine_split(m: Models) -> DataFrame:
    return _typed_keys(routing.quarantine_split(_readable_dirty(m)))


@query
def quarantine_split_literal(m: Models) -> DataFrame:
    return _typed_keys(routing.quarantine_split(_readable_dirty(m), literal=True))


@query
def quarantine_recent_count(m: Models) -> DataFrame:
    return health.quarantine_recent_count(routing.quarantine_split(_readable_dirty(m)), RUN_TS)


@query
def stream_health(m: Models) -> DataFrame:
    """The day's report on the defective feed against a baseline with two retired-looking keys."""
    baseline = _key_baseline(m)
    recent = health.last_day(_readable_dirty(m), RUN_TS)
    return health.stream_findings(health.load_history(_dirty_rows(m)), recent, baseline, RUN_TS)


@query
def source_freshness(m: Models) -> DataFrame:
    now = RUN_TS + dt.timedelta(hours=9)
    checked = [
        quality.freshness(m.raw(name), "_loaded_at", now, warn, error).select(F.lit(name).alias("source_name"), "*")
        for name, (warn, error) in FRESHNESS.items()
    ]
    return reduce(DataFrame.unionByName, checked)


@query
def table_inventory(m: Models) -> DataFrame:
    # The names the report shows.
    shown = {
        "settlements": "settlements",
        "partner_transactions": "partner_transactions",
        "customers_files": "customers",
        "accounts_files": "accounts",
        "merchants_files": "merchants",
        "support_cases": "support_cases",
        "policy_documents": "policy_documents",
        "exchange_rates": "exchange_rates",
        "account_activity_raw": "account_activity",
    }
    tables = {label: (m.raw(name), "_loaded_at") for label, name in shown.items()}
    current = m.stg_accounts_current.withColumn("_merged_at", files.ntz(RUN_TS))
    tables["accounts_current_core"] = (current, "_merged_at")
    return inventory.table_inventory(tables)


@query
def per_file_counts(m: Models) -> DataFrame:
    return inventory.per_file_counts(m.raw("account_activity"))


@query
def sum_check(m: Models) -> DataFrame:
    return inventory.sum_check(m.raw("settlements"))


@query
def test_unique(m: Models) -> DataFrame:
    return quality.unique_failures(m.stg_account_activity, "account_id")


@query
def test_not_null(m: Models) -> DataFrame:
    return quality.not_null_failures(m.customer_summary, ["customer_id", "risk_rating", "has_risk_flag", "last_transaction_date"])


@query
def test_accepted_values(m: Models) -> DataFrame:
    return quality.accepted_values_failures(m.transactions, "status", ("APPROVED", "SETTLED"))


@query
def test_relationships(m: Models) -> DataFrame:
    return quality.relationship_failures(m.transactions, "account_id", m.stg_accounts, "account_id")


@query
def test_rowcount_parity(m: Models) -> DataFrame:
    """Customers and summary agree; accounts and customers do not, and are reported."""
    good = quality.rowcount_parity_failures(m.customer_summary, m.stg_customers)
    merchants = quality.rowcount_parity_failures(m.merchant_summary, m.stg_merchants)
    bad = quality.rowcount_parity_failures(m.stg_accounts, m.stg_customers)
    return (
        good.select(F.lit("customer_summary").alias("pair"), "*")
        .unionByName(merchants.select(F.lit("merchant_summary").alias("pair"), "*"))
        .unionByName(bad.select(F.lit("accounts_against_customers").alias("pair"), "*"))
    )


@query
def dq_results(m: Models) -> DataFrame:
    """Every column test of every model, over models written once; row tests are counted while writing.

    A model is tested when it is written, and its table goes when no other model needs it.
    """
    observed, found = quality.Observed(SUITE), []

    def test(models: dict[str, DataFrame], names: list[str]) -> None:
        suite = {n: tests for n, tests in SUITE.items() if n in names}
        pairs = [pair for pair in PARITY if pair[0] in names]
        if suite:
            found.extend(quality.run_tests(models, suite, pairs, observed).collect())

    with shuffles_removed(m.spark):
        raw, folder = R.raw_tables(m.spark, m.sf_dir), new_folder(m.spark, "models")
        build_models(m.spark, raw, AS_OF, folder, observed, by_month=False, written=test)
    counted, path = m.spark.createDataFrame(found, quality.COUNTED), new_folder(m.spark, "dq")
    write_batch(quality.as_results(counted, "run1", RUN_TS), path, "run1")
    schema = (
        "test_run_id string, model_name string, test_name string, test_status string, "
        "failures_count bigint, executed_at timestamp_ntz"
    )
    return read_batches(m.spark, path, schema).drop("batch_id")


def _log_lines(m: Models) -> DataFrame:
    """Job logs made of the events, in colour as on a terminal; one task in ten logs no error."""
    n, u = F.col("event_id"), F.col("user_id")
    red, plain = F.lit("\u001b[31m"), F.lit("\u001b[0m")
    text = (
        F.when(u % 10 == 3, F.lit("12:00:01  Finished running 3 models"))
        .when(n % 7 == 0, F.concat(red, F.lit("ERROR"), plain, F.lit(" creating sql table model core.m_"), n % 4))
        .when(n % 7 == 1, F.concat(F.lit("  Database Error in "), red, F.lit("model stg_"), n % 11, plain))
        .when(n % 7 == 2, F.concat(F.lit("Failure in test unique_"), n % 3, F.lit(" (models/x.yml)")))
        .when(n % 7 == 3, F.concat(F.lit("Compilation Error in snapshot snap_"), n % 2, F.lit("; Failure in test both")))
        .otherwise(F.lit("12:00:02  1 of 3 OK"))
    )
    return table(m.spark, m.sf_dir, "events").select(
        F.lit("models").alias("dag_id"),
        F.concat(F.lit("task_"), u).alias("task_id"),
        F.lit("1").alias("attempt"),
        n.alias("pos"),
        text.alias("value"),
    )


TASK = ["dag_id", "task_id", "attempt"]


@query
def log_triage_summary(m: Models) -> DataFrame:
    return log_triage.log_triage(_log_lines(m), TASK)


@query
def error_log_append(m: Models) -> DataFrame:
    found = log_triage.log_triage(_log_lines(m), TASK)
    return log_triage.error_log_append(m.spark, new_folder(m.spark, "errors"), found, "b1")


# --------------------------------------------------------------------- staging


@query
def stg_settlements(m: Models) -> DataFrame:
    return m.stg_settlements


@query
def stg_partner_transactions(m: Models) -> DataFrame:
    return m.stg_partner_transactions


@query
def stg_support_cases(m: Models) -> DataFrame:
    return m.stg_support_cases


@query
def stg_account_activity(m: Models) -> DataFrame:
    return m.stg_account_activity


@query
def stg_customers(m: Models) -> DataFrame:
    return m.stg_customers


@query
def stg_accounts(m: Models) -> DataFrame:
    return m.stg_accounts


@query
def stg_merchants(m: Models) -> DataFrame:
    return m.stg_merchants


@query
def stg_exchange_rates(m: Models) -> DataFrame:
    return m.stg_exchange_rates


@query
def stg_accounts_current(m: Models) -> DataFrame:
    return m.stg_accounts_current


# --------------------------------------------------------- change data capture


def _activity_table(m: Models) -> str:
    """The raw activity rows as a folder of files a stream can follow."""
    path = new_folder(m.spark, "activity")
    write_batch(m.raw("account_activity"), f"{path}/raw", "b1")
    return path


@query
def cdc_accounts_current(m: Models) -> DataFrame:
    path, state = _activity_table(m), new_folder(m.spark, "accounts-current")
    cdc.merge_stream(streams.raw_stream(m.spark, path), state, f"{state}/checkpoint", merged_at=RUN_TS)
    return cdc.accounts_current(m.spark, state).read()


@query
def cdc_late_guard(m: Models) -> DataFrame:
    """Newer events merged before older ones; the newer state stays."""
    state = cdc.accounts_current(m.spark, new_folder(m.spark, "accounts-current"))
    rows = m.raw("account_activity")
    late = F.col("_loaded_at") > F.lit("2024-01-16").cast("timestamp_ntz")
    cdc.merge_batch(state, rows.where(late), "b1", RUN_TS)
    cdc.merge_batch(state, rows.where(~late), "b2", RUN_TS + DAY)
    return state.read()


# ---------------------------------------------------------- intermediate models


@query
def int_accounts_enriched(m: Models) -> DataFrame:
    return m.accounts


@query
def int_transactions_unified(m: Models) -> DataFrame:
    return m.transactions


@query
def txn_time_features(m: Models) -> DataFrame:
    keys = ["transaction_hour", "day_of_week", "is_weekend", "is_late_night"]
    return m.transactions.groupBy(*keys).agg(F.count("*").alias("n"), F.max("transaction_date").alias("last_date"))


@query
def txn_amount_bucket(m: Models) -> DataFrame:
    return m.transactions.groupBy("amount_bucket").agg(F.count("*").alias("n"), F.sum("amount").alias("amount"))


@query
def txn_outcome_flags(m: Models) -> DataFrame:
    return m.transactions.groupBy("status", "is_declined_or_failed", "is_successful").agg(F.count("*").alias("n"))


@query
def account_summary(m: Models) -> DataFrame:
    return I.account_summary(m.accounts)


@query
def transaction_summary(m: Models) -> DataFrame:
    return I.transaction_summary(m.accounts, m.transactions, AS_OF)


@query
def support_summary(m: Models) -> DataFrame:
    return I.support_summary(m.stg_support_cases)


@query
def int_customer_activity_summary(m: Models) -> DataFrame:
    return m.customer_summary


@query
def merchant_txn_summary(m: Models) -> DataFrame:
    return I.merchant_txn_summary(m.transactions, AS_OF)


@query
def int_merchant_risk_summary(m: Models) -> DataFrame:
    return m.merchant_summary


# ----------------------------------------------------------------------- marts


@query
def mart_customer_360(m: Models) -> DataFrame:
    return m.customer_360


@query
def mart_merchant_performance(m: Models) -> DataFrame:
    return m.merchant_performance


@query
def mart_daily_transaction_kpi(m: Models) -> DataFrame:
    return m.daily_kpi


# ---------------------------------------------------------------- metric layer


@query
def metric_query(m: Models) -> DataFrame:
    """Asked for by other names, with a filter."""
    return semantic.metric_query(
        m.marts,
        ["total deposits", "number of customers", "total_failed_payments"],
        ["activity level", "risk_rating"],
        [("account status", "in", ("ACTIVE", "DORMANT")), ("risk_rating", "<>", "MEDIUM")],
    )


@query
def metric_customers(m: Models) -> DataFrame:
    names = [
        "total_customer_balance",
        "avg_transactions_per_customer",
        "total_failed_payments",
        "total_support_cases",
        "customer_count",
    ]
    return semantic.metric_query(m.marts, names, ["engagement"])


@query
def metric_merchants(m: Models) -> DataFrame:
    return semantic.metric_query(
        m.marts, ["total_merchant_volume", "total_declines", "merchant_count"], ["industry", "merchants.risk_category"]
    )


@query
def metric_daily(m: Models) -> DataFrame:
    return semantic.metric_query(m.marts, ["daily revenue", "total_daily_count"])


# ---------------------------------------------------------------------- search


def _questions(m: Models) -> DataFrame:
    """Every benchmark item, whole, as a search request."""
    return table(m.spark, m.sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


@query
def search_support_cases(m: Models) -> DataFrame:
    """Open cases from an index of all cases; the filter is a bitmap of the index."""
    shown = ["customer_id", "category", "priority", "status"]
    cases = m.stg_support_cases.select(F.col("case_id").cast("bigint").alias("doc_id"), F.col("narrative").alias("text"), *shown)
    idx = index.TextIndex(m.spark, new_folder(m.spark, "case-index"))
    idx.refresh(cases, "r1", RUN_TS)
    return idx.search(_questions(m), 5, {"status": ["OPEN"]}, shown).withColumnRenamed("doc_id", "case_no")


@query
def search_policy_docs(m: Models) -> DataFrame:
    docs = m.raw("policy_documents").select(F.col("file_name").alias("doc_id"), F.col("extracted_text").alias("text"), "page_count")
    idx = index.TextIndex(m.spark, new_folder(m.spark, "policy-index"), "string")
    idx.refresh(docs, "r1", RUN_TS)
    hits = idx.search(_questions(m), 5, shown=["page_count"]).withColumnRenamed("doc_id", "file_name")
    return hits.withColumn("page_count", F.col("page_count").cast("int"))


@query
def vector_topk(m: Models) -> DataFrame:
    """The nearest vectors to the centre of each class, from cells around pivots."""
    vectors = table(m.spark, m.sf_dir, "embeddings")
    parts = vectors.select("label", F.posexplode("embedding").alias("i", "x"))
    centres = (
        parts.groupBy("label", "i")
        .agg(F.avg(F.col("x").cast("double")).alias("x"))
        .groupBy(F.col("label").alias("query_id"))
        .agg(F.sort_array(F.collect_list(F.struct("i", "x")))["x"].alias("vector"))
    )
    cells = VectorIndex(m.spark, new_folder(m.spark, "vectors"))
    cells.build(vectors, "vec_id", "embedding")
    return cells.search(centres, 10)


def _documents(m: Models) -> DataFrame:
    return table(m.spark, m.sf_dir, "documents", spread=True).select("doc_id", "text")


@query
def index_refresh_incremental(m: Models) -> DataFrame:
    """Indexed with outdated texts first, then refreshed; compared by the words that count now."""
    idx = index.TextIndex(m.spark, new_folder(m.spark, "index"))
    docs = _documents(m)
    outdated = docs.withColumn("text", F.when(F.col("doc_id") % 4 == 0, F.concat("text", F.lit(" outdated"))).otherwise(F.col("text")))
    idx.refresh(outdated, "r1", RUN_TS - DAY)
    idx.refresh(docs, "r2", RUN_TS)
    return idx.postings().groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("tf"))


@query
def index_manifest(m: Models) -> DataFrame:
    """Which refresh last indexed how many documents, and how old that makes the index."""
    idx = index.TextIndex(m.spark, new_folder(m.spark, "index"))
    docs = _documents(m)
    outdated = docs.withColumn("text", F.when(F.col("doc_id") % 4 == 0, F.concat("text", F.lit(" outdated"))).otherwise(F.col("text")))
    idx.refresh(outdated, "r1", RUN_TS - DAY)
    idx.refresh(docs, "r2", RUN_TS)
    return idx.current().groupBy("refresh", "indexed_at").agg(F.count("*").alias("documents"), F.sum("doc_len").alias("words"))


@query
def index_lag(m: Models) -> DataFrame:
    """A day-old index against a lag of an hour, next to how many documents it holds."""
    idx = index.TextIndex(m.spark, new_folder(m.spark, "index"))
    idx.refresh(_documents(m), "r1", RUN_TS - DAY)
    documents = idx.current().agg(F.count("*").alias("n")).scalar()
    return idx.lag(RUN_TS, dt.timedelta(hours=1)).withColumn("documents", documents)


# ----------------------------------------------------------------------- churn


def _stand_in_scores(m: Models) -> DataFrame:
    """A fixed formula over the features in place of a trained model, for customers with all features."""
    z = (
        F.col("support_case_count") * 0.3
        + F.col("frozen_accounts") * 0.2
        - F.col("open_accounts") * 0.1
        + F.col("failed_payment_count") * 0.01
        - 0.5
    )
    return churn.churn_features(m.customer_360).select(
        "customer_id",
        F.round(1.0 / (1.0 + F.exp(-z)), 6).alias("churn_probability"),
        files.ntz(RUN_TS).alias("scored_at"),
        "churn_label",
    )


def _scores(m: Models) -> DataFrame:
    return _stand_in_scores(m).drop("churn_label")


@query
def churn_label(m: Models) -> DataFrame:
    return churn.churn_label(m.customer_360).select("customer_id", "customer_status", "churn_label")


@query
def churn_features(m: Models) -> DataFrame:
    return churn.churn_features(m.customer_360)


@query
def churn_split(m: Models) -> DataFrame:
    return churn.churn_split(churn.churn_features(m.customer_360)).groupBy("is_train", "churn_label").agg(
        F.count("*").alias("customers")
    )


def _registry(m: Models) -> churn.Registry:
    key = "-".join(p for p in m.sf_dir.split("/") if p)
    return churn.Registry(m.spark, f"{shared_root(m.spark)}/tidemark/models-{m.spark.sparkContext.applicationId}-{key}")


def _mart_table(m: Models) -> ReplacedTable:
    mart = ReplacedTable(m.spark, f"{_registry(m).path}/mart", m.customer_360.schema)
    if mart.current_version() is None:
        mart.overwrite(m.customer_360, "v1")
    return mart


def _log_facts(m: Models, registry: churn.Registry) -> DataFrame:
    """The training log in what does not depend on the fit, next to the rows it was fitted and judged on."""
    split = churn.churn_split(churn.churn_features(_mart_table(m).read())).agg(
        F.count_if("is_train").alias("trained_rows"), F.count_if(~F.col("is_train")).alias("held_out_rows")
    )
    in_range = F.col("accuracy").between(0, 1) & (F.col("auc").isNull() | F.col("auc").between(0, 1))
    log = churn.training_log_latest(registry).select(
        "version_name", "promoted", "promotion_note", in_range.alias("metrics_in_range")
    )
    return log.withColumns({c: split.select(c).scalar() for c in split.columns})


@query
def churn_train(m: Models) -> DataFrame:
    """Train once per mart version; version, promotion and rows of the training."""
    registry = _registry(m)
    churn.retrain_if_changed(_mart_table(m), registry, RUN_TS)
    return _log_facts(m, registry)


@query
def training_log_latest(m: Models) -> DataFrame:
    registry = _registry(m)
    if registry.default() is None:
        churn.churn_train(_mart_table(m).read(), registry, RUN_TS)
    return _log_facts(m, registry)


@query
def churn_score(m: Models) -> DataFrame:
    """Every customer with all features, scored by the version in production; the score itself only by its range."""
    registry, mart = _registry(m), _mart_table(m)
    if registry.default() is None:
        churn.churn_train(mart.read(), registry, RUN_TS)
    scores = churn.churn_score(mart.read(), registry, RUN_TS)
    return scores.select(
        "customer_id",
        F.col("churn_probability").between(0, 1).alias("in_range"),
        "scored_at",
        F.lit(registry.default()[0]).alias("model_version"),
    )


@query
def auc_by_rank(m: Models) -> DataFrame:
    return auc_exact(_stand_in_scores(m), "churn_label", "churn_probability").withColumn("auc", F.round("auc", 9))


@query
def churn_tracking(m: Models) -> DataFrame:
    return churn.churn_tracking(m.customer_360, _scores(m))


@query
def churned_count(m: Models) -> DataFrame:
    return churn.churned_count(churn.churn_tracking(m.customer_360, _scores(m)))


@query
def churn_outcome_counts(m: Models) -> DataFrame:
    return churn.churn_outcome_counts(churn.churn_tracking(m.customer_360, _scores(m)))


@query
def churn_risk_list(m: Models) -> DataFrame:
    return churn.churn_risk_list(churn.churn_tracking(m.customer_360, _scores(m)))


@query
def churn_top20(m: Models) -> DataFrame:
    return churn.churn_top(_scores(m)).select("customer_id", "churn_probability")


# ------------------------------------------------------------------- streaming


def _dirty_table(m: Models) -> DataFrame:
    path = new_folder(m.spark, "lines")
    lines = R.dirty_partner_lines(m.spark, m.sf_dir)
    lines.write.parquet(path)
    return m.spark.readStream.schema(lines.schema).parquet(path)


@query
def stream_partner_ingest(m: Models) -> DataFrame:
    """Lines landed by a stream: good ones, rejects, and the load history they leave."""
    out = new_folder(m.spark, "landed")
    streams.land_stream(_dirty_table(m), out, f"{out}/checkpoint")
    good = streams.landed(m.spark, out).groupBy("_source_file").agg(F.count("*").alias("good"))
    bad = streams.landed(m.spark, out, "rejects").groupBy("_source_file").agg(F.count("*").alias("bad"))
    return streams.history(m.spark, out).join(good, "_source_file", "left").join(bad, "_source_file", "left").select(
        "_source_file", "row_count", "error_count", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("bad", F.lit(0)).alias("bad")
    )


@query
def stream_activity_ingest(m: Models) -> DataFrame:
    stage, out = _stage_json(m, "account_activity"), new_folder(m.spark, "landed")
    streams.land_stream(streams.read_line_stream(m.spark, stage), out, f"{out}/checkpoint", RUN_TS)
    rows = streams.landed(m.spark, out)
    return rows.groupBy(F.get_json_object("raw_payload", "$.account_id").alias("account_id")).agg(
        F.count("*").alias("events"), F.max("_loaded_at").alias("loaded_at")
    )


@query
def stream_clean_quarantine(m: Models) -> DataFrame:
    landed, routed = new_folder(m.spark, "landed"), new_folder(m.spark, "routed")
    streams.land_stream(_dirty_table(m), landed, f"{landed}/checkpoint")
    streams.route_stream(streams.raw_stream(m.spark, landed), routed, f"{routed}/checkpoint")
    parts = [
        streams.landed(m.spark, routed, side).groupBy("_source_file").agg(F.count("*").alias("n_rows")).select(F.lit(side).alias("side"), "*")
        for side in ("clean", "quarantine")
    ]
    return parts[0].unionByName(parts[1])


@query
def stream_cdc_merge(m: Models) -> DataFrame:
    """Two runs of the merge over a growing table; the second takes only what was added."""
    path, state = new_folder(m.spark, "activity"), new_folder(m.spark, "accounts-current")
    rows = m.raw("account_activity")
    early = F.col("_loaded_at") <= F.lit("2024-01-16").cast("timestamp_ntz")
    for part, at in ((rows.where(early), RUN_TS), (rows.where(~early), RUN_TS + DAY)):
        write_batch(part, f"{path}/raw", streams.batch_key(at.day))
        cdc.merge_stream(streams.raw_stream(m.spark, path), state, f"{state}/checkpoint", merged_at=at)
    return cdc.accounts_current(m.spark, state).read()


@query
def stream_index_refresh(m: Models) -> DataFrame:
    folder, path = new_folder(m.spark, "docs"), new_folder(m.spark, "index")
    docs = _documents(m)
    docs.write.parquet(folder)
    index.index_stream(m.spark.readStream.schema(docs.schema).parquet(folder), path, f"{path}/checkpoint", RUN_TS)
    idx = index.TextIndex(m.spark, path)
    return idx.search(_questions(m), 3)


@query
def stream_event_dedup(m: Models) -> DataFrame:
    """Every event sent twice, the newer half first, and those once more with the late older half; each id is kept once."""
    folder, out = new_folder(m.spark, "events"), new_folder(m.spark, "dedup")
    columns = [F.col("event_id"), F.col("event_timestamp").cast("timestamp").alias("event_time"), F.col("amount")]
    once = settle(m.stg_partner_transactions.select(*columns), "events")
    newer = once.where(F.col("event_time") >= F.lit("2024-01-16").cast("timestamp"))
    schema = "event_id string, event_time timestamp, amount decimal(12,2)"
    for part in (newer.unionByName(newer), once.unionByName(once)):
        part.write.mode("append").parquet(folder)
        rows = m.spark.readStream.schema(once.schema).parquet(folder)
        streams.dedup_stream(rows, "event_id", "event_time", out, f"{out}-checkpoint")
    copies = read_batches(m.spark, f"{out}/copies", "event_id string, copies bigint").groupBy("event_id").agg(F.sum("copies").alias("copies"))
    return streams.deduplicated(m.spark, out, schema).join(copies, "event_id", "left").select("event_id", "amount", "copies")


# ---------------------------------------------------------------------- extras


@query
def fx_to_usd(m: Models) -> DataFrame:
    """Transactions given a currency by merchant, converted at the rate of their day or the last before."""
    code = F.pmod(F.col("merchant_id").cast("bigint"), F.lit(26))
    priced = m.transactions.withColumn("currency", F.when(code == 25, "USD").otherwise(F.concat(F.lit("C"), code)))
    done = extras.fx_to_usd(priced, m.stg_exchange_rates, F.col("transaction_id"))
    return done.groupBy("currency").agg(
        F.count("*").alias("n"), F.count("amount_usd").alias("n_converted"), F.sum("amount_usd").alias("amount_usd")
    )


@query
def rolling_30_60_90(m: Models) -> DataFrame:
    return extras.rolling_30_60_90(m.stg_accounts, m.transactions, m.stg_support_cases)


@query
def merchant_chargeback_ratio(m: Models) -> DataFrame:
    return extras.merchant_failed_settlement_ratio(m.stg_settlements)


@query
def settlement_audit_hash(m: Models) -> DataFrame:
    return extras.settlement_audit_hash(m.stg_settlements)


@query
def case_sla(m: Models) -> DataFrame:
    return extras.case_open_age(m.stg_support_cases, AS_OF)


@query
def activity_state_changes(m: Models) -> DataFrame:
    return extras.activity_state_changes(m.stg_account_activity)


@query
def assert_balance(m: Models) -> DataFrame:
    return extras.assert_balance(m.stg_settlements)


@query
def dim_customers(m: Models) -> DataFrame:
    return extras.dim_customers(m.customer_360, _scores(m))


@query
def dim_merchants(m: Models) -> DataFrame:
    return extras.dim_merchants(m.merchant_performance)


@query
def fct_transactions(m: Models) -> DataFrame:
    return extras.fct_transactions(m.transactions)

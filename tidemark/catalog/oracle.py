"""The same queries as SQL over the test tables, written from the relational meaning alone.

Amounts are whole cents until the last step, so both sides agree to the last digit.
"""

from __future__ import annotations

import re

from tidemark.plans.suite import PARITY, SUITE
from tidemark.sources.tables import TABLES

AS_OF = "DATE '2024-01-31'"
RUN = "TIMESTAMP '2024-01-31 08:00:00'"


def _pct(part: str, whole: str) -> str:
    micro = f"((CAST({part} AS BIGINT) * 2000000 + {whole}) // (2 * {whole}))"
    return f"CASE WHEN {whole} > 0 THEN (({micro} + 50) // 100) / 100.0 END"


def _big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


WORDS = r"list_filter(regexp_split_to_array(lower({}), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')"

# Named parts; a query lists the ones it starts from and their own parts come along.
PARTS: dict[str, str] = {
    "settle": """
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                   CAST(round(l_quantity * 100) AS BIGINT), CAST(round(l_extendedprice * 100) AS BIGINT),
                   CAST(l_shipdate AS DATE)) AS settlement_id,
               CAST(l_orderkey AS VARCHAR) AS account_id,
               CAST(l_suppkey AS VARCHAR) AS merchant_id,
               l_shipdate + to_days(8120) + to_hours(CAST(l_partkey % 24 AS INTEGER)) AS ts,
               CAST(round(l_extendedprice * 100) AS BIGINT) // 100 AS cents,
               CAST(round(l_extendedprice * 100) AS BIGINT) // 10000 AS fee_cents,
               CASE WHEN l_partkey % (6 + l_suppkey % 4) = 0 THEN 'FAILED'
                    WHEN l_linestatus = 'O' AND l_linenumber = 1 THEN 'PENDING'
                    ELSE 'SETTLED' END AS status
        FROM lineitem""",
    "partner": """
        SELECT CAST(event_id AS VARCHAR) AS event_id, 'T' || event_id AS transaction_id,
               CASE WHEN user_id % 50 = 7 THEN 'X' || user_id ELSE CAST(user_id AS VARCHAR) END AS account_id,
               CAST(event_id % 10 AS VARCHAR) AS merchant_id, ts,
               CAST(round(value * 100) AS BIGINT) AS cents,
               CASE event_type WHEN 'error' THEN 'DECLINED' WHEN 'view' THEN 'PENDING' ELSE 'APPROVED' END AS status,
               CASE user_id % 4 WHEN 0 THEN 'ONLINE' WHEN 1 THEN 'IN_STORE' WHEN 2 THEN 'MOBILE_APP' ELSE 'ATM' END AS channel,
               'D' || regexp_extract(props, '([0-9]+)', 1) AS device_id,
               event_id AS n,
               CAST(CAST(ts AS DATE) AS TIMESTAMP) + to_hours(CAST((hour(ts) // 4) * 4 + 4 AS INTEGER)) AS loaded_at,
               'partner_transactions/' || CAST(CAST(ts AS DATE) AS VARCHAR) || '-' || (hour(ts) // 4) || '.json' AS source_file
        FROM events""",
    "dirty": """
        SELECT *, n % 53 = 0 AS is_bad,
               CASE WHEN n % 37 = 0 THEN NULL ELSE account_id END AS seen_account,
               CASE WHEN n % 37 <> 0 AND n % 41 = 0 THEN NULL ELSE merchant_id END AS seen_merchant
        FROM partner""",
    "activity": """
        SELECT event_id, CAST(user_id AS VARCHAR) AS account_id, CAST(user_id AS VARCHAR) AS customer_id,
               CASE event_type WHEN 'error' THEN 'FROZEN' WHEN 'view' THEN 'CLOSED' ELSE 'OPEN' END AS account_status,
               CAST(round(value * 1000) AS BIGINT) AS cents, ts,
               CAST(CAST(ts AS DATE) AS TIMESTAMP) + to_hours(CAST((hour(ts) // 4) * 4 + 4 AS INTEGER)) AS loaded_at,
               'account_activity/' || CAST(CAST(ts AS DATE) AS VARCHAR) || '-' || (hour(ts) // 4) || '.json' AS source_file
        FROM events""",
    "cases": """
        SELECT doc_id, CAST(doc_id AS VARCHAR) AS case_id, CAST(doc_id % 150 AS VARCHAR) AS customer_id,
               CASE doc_id % 6 WHEN 0 THEN 'CARD_DECLINE' WHEN 1 THEN 'UNAUTHORIZED_TRANSACTION' WHEN 2 THEN 'FEE_INQUIRY'
                    WHEN 3 THEN 'ACCOUNT_ACCESS' WHEN 4 THEN 'PAYMENT_FAILURE' ELSE 'ACCOUNT_CLOSURE' END AS category,
               CASE doc_id % 3 WHEN 0 THEN 'HIGH' WHEN 1 THEN 'MEDIUM' ELSE 'LOW' END AS priority,
               CASE doc_id % 4 WHEN 0 THEN 'OPEN' WHEN 1 THEN 'ESCALATED' ELSE 'RESOLVED' END AS status,
               text AS narrative,
               TIMESTAMP '2024-01-01' + to_hours(CAST(doc_id % 720 AS INTEGER)) AS opened_at
        FROM documents""",
    "cust": """
        SELECT c_custkey AS k, CAST(c_custkey AS VARCHAR) AS customer_id, substr(c_name, 10) AS last_name,
               CASE WHEN c_custkey % 10 < 7 THEN 'ACTIVE' WHEN c_custkey % 10 < 9 THEN 'DORMANT' ELSE 'CLOSED' END AS customer_status,
               CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 5 = 0 THEN 'HIGH'
                    WHEN c_custkey % 5 <= 2 THEN 'MEDIUM' ELSE 'LOW' END AS risk_rating,
               TIMESTAMP '2015-01-01' + to_days(CAST(c_custkey % 2500 AS INTEGER)) AS created_at
        FROM customer""",
    "acct0": """
        SELECT CAST(o_orderkey AS VARCHAR) AS account_id,
               CAST(o_custkey + CASE WHEN o_custkey % 50 = 7 THEN 1 ELSE 0 END AS VARCHAR) AS customer_id,
               CASE o_orderkey % 3 WHEN 0 THEN 'CHECKING' WHEN 1 THEN 'SAVINGS' ELSE 'CREDIT' END AS account_type,
               CASE WHEN o_orderkey % 20 = 0 THEN 'FROZEN' WHEN o_orderstatus = 'F' THEN 'CLOSED' ELSE 'OPEN' END AS account_status,
               CAST(round(o_totalprice * 100) AS BIGINT) AS cents, o_orderdate AS created_at, o_orderkey AS k
        FROM orders""",
    "live": """
        SELECT account_id, customer_id, account_status, cents, ts FROM
            (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY ts DESC, event_id DESC) AS r FROM activity)
        WHERE r = 1""",
    "acct": """
        SELECT a.account_id, a.customer_id, a.account_type, a.created_at,
               coalesce(l.account_status, a.account_status) AS account_status, coalesce(l.cents, a.cents) AS cents,
               coalesce(l.ts, a.created_at) AS last_updated_at, l.account_id IS NOT NULL AS has_activity_history
        FROM acct0 a LEFT JOIN live l ON a.account_id = l.account_id""",
    "merch": """
        SELECT CAST(s_suppkey AS VARCHAR) AS merchant_id, s_name AS merchant_name,
               CAST(5000 + s_nationkey AS VARCHAR) AS merchant_category_code,
               CASE s_suppkey % 6 WHEN 0 THEN 'GROCERY' WHEN 1 THEN 'TRAVEL' WHEN 2 THEN 'FUEL' WHEN 3 THEN 'DINING'
                    WHEN 4 THEN 'RETAIL' ELSE 'UTILITIES' END AS industry,
               n_name AS country,
               CASE WHEN s_acctbal < 1000 THEN 'HIGH' WHEN s_acctbal < 5000 THEN 'MEDIUM' ELSE 'LOW' END AS risk_category
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "rates": """
        SELECT 'C' || n_nationkey AS quote_currency, day AS rate_date,
               500000 + n_nationkey * 10000 + day(day) * 100 AS micro
        FROM nation, (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events)""",
    "pol": r"""
        SELECT url AS file_name, extracted_text, CAST(1 + length(extracted_text) // 3000 AS BIGINT) AS page_count
        FROM (SELECT url, trim(regexp_replace(replace(replace(replace(replace(replace(
                regexp_replace(regexp_replace(regexp_replace(html,
                    '(?is)<(?:script|style)[^>]*>.*?</(?:script|style)>', ' ', 'g'),
                    '(?s)<!--.*?-->', ' ', 'g'), '(?s)<[^>]+>', ' ', 'g'),
                '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'),
                '[ \t\r\n]+', ' ', 'g')) AS extracted_text FROM pages)""",
    "txn": """
        SELECT *, CAST(ts AS DATE) AS day, status IN ('DECLINED', 'FAILED') AS declined,
               status IN ('APPROVED', 'SETTLED') AS success, hour(ts) AS hr, dayofweek(ts) AS dow,
               CASE WHEN cents < 2500 THEN 'MICRO' WHEN cents < 20000 THEN 'SMALL' WHEN cents < 100000 THEN 'MEDIUM'
                    ELSE 'LARGE' END AS bucket
        FROM (SELECT settlement_id AS transaction_id, account_id, merchant_id, ts, cents, status,
                     'SETTLEMENT' AS src, 'BATCH' AS via, CAST(NULL AS VARCHAR) AS channel FROM settle
              UNION ALL
              SELECT transaction_id, account_id, merchant_id, ts, cents, status,
                     'PARTNER_EVENT', 'SNOWPIPE_REALTIME', channel FROM partner)""",
    "acc_sum": """
        SELECT customer_id, count(*) AS total_accounts,
               count(*) FILTER (WHERE account_status = 'OPEN') AS open_accounts,
               count(*) FILTER (WHERE account_status = 'FROZEN') AS frozen_accounts,
               count(*) FILTER (WHERE account_status = 'CLOSED') AS closed_accounts,
               CAST(sum(cents) AS BIGINT) AS cents, CAST(sum(cents) AS BIGINT) / 100.0 / count(*) AS mean,
               max(last_updated_at) AS newest
        FROM acct GROUP BY customer_id""",
    "txn_sum": f"""
        SELECT a.customer_id, count(t.transaction_id) AS n,
               count(*) FILTER (WHERE t.day >= {AS_OF} - 30) AS n30,
               CAST(coalesce(sum(t.cents) FILTER (WHERE t.day >= {AS_OF} - 30), 0) AS BIGINT) AS cents30,
               count(*) FILTER (WHERE t.declined) AS failed,
               max(t.day) AS last_day, date_diff('day', max(t.day), {AS_OF}) AS recency
        FROM acct a LEFT JOIN txn t ON a.account_id = t.account_id GROUP BY a.customer_id""",
    "case_sum": """
        SELECT customer_id, count(*) AS cases, count(*) FILTER (WHERE priority = 'HIGH') AS high,
               count(*) FILTER (WHERE status = 'OPEN') AS opened
        FROM cases GROUP BY customer_id""",
    "c360": f"""
        SELECT c.customer_id, 'Customer' AS first_name, c.last_name, c.customer_status, c.risk_rating,
               CAST(c.created_at AS VARCHAR) AS customer_since,
               date_diff('day', CAST(c.created_at AS DATE), {AS_OF}) AS account_age_days,
               coalesce(a.total_accounts, 0) AS total_accounts, coalesce(a.open_accounts, 0) AS open_accounts,
               coalesce(a.frozen_accounts, 0) AS frozen_accounts, coalesce(a.closed_accounts, 0) AS closed_accounts,
               coalesce(a.cents, 0) / 100.0 AS total_balance, coalesce(a.mean, 0.0) AS avg_account_balance,
               coalesce(t.n, 0) AS transaction_count_all_time, coalesce(t.n30, 0) AS transaction_count_30d,
               coalesce(t.cents30, 0) / 100.0 AS transaction_amount_30d, coalesce(t.failed, 0) AS failed_payment_count,
               CAST(t.last_day AS VARCHAR) AS last_transaction_date,
               coalesce(t.recency, 9999) AS days_since_last_transaction,
               coalesce(s.cases, 0) AS support_case_count, coalesce(s.high, 0) AS high_priority_case_count,
               coalesce(s.opened, 0) AS open_case_count,
               CASE WHEN t.recency IS NULL THEN 'NEVER_TRANSACTED' WHEN t.recency <= 30 THEN 'ACTIVE'
                    WHEN t.recency <= 90 THEN 'AT_RISK' ELSE 'DORMANT' END AS engagement_segment,
               c.risk_rating = 'HIGH' OR coalesce(a.frozen_accounts, 0) > 0 OR coalesce(s.high, 0) > 0 AS has_risk_flag,
               coalesce(a.cents, 0) AS balance_cents
        FROM cust c LEFT JOIN acc_sum a ON a.customer_id = c.customer_id
        LEFT JOIN txn_sum t ON t.customer_id = c.customer_id
        LEFT JOIN case_sum s ON s.customer_id = c.customer_id""",
    "merch_sum": f"""
        SELECT merchant_id, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents,
               CAST(sum(cents) AS BIGINT) / 100.0 / count(*) AS mean,
               count(*) FILTER (WHERE declined) AS d, count(*) FILTER (WHERE success) AS s,
               count(*) FILTER (WHERE day >= {AS_OF} - 30) AS n30,
               count(*) FILTER (WHERE day >= {AS_OF} - 30 AND declined) AS d30, max(day) AS last_day
        FROM txn GROUP BY merchant_id""",
    "mperf": f"""
        SELECT m.*, coalesce(t.n, 0) AS total_transaction_count, coalesce(t.cents, 0) / 100.0 AS total_transaction_amount,
               coalesce(t.mean, 0.0) AS avg_transaction_amount, coalesce(t.d, 0) AS declined_count,
               coalesce(t.n30, 0) AS transaction_count_30d, coalesce(t.d30, 0) AS declined_count_30d,
               CAST(t.last_day AS VARCHAR) AS last_transaction_date,
               {_pct("t.d", "t.n")} AS decline_rate_pct, {_pct("t.d30", "t.n30")} AS decline_rate_30d_pct,
               coalesce(t.n, 0) >= 20 AND (t.d * 2000000 + t.n) // (2 * t.n) > 150000 AS is_high_decline_merchant
        FROM merch m LEFT JOIN merch_sum t ON t.merchant_id = m.merchant_id""",
    "kpi": f"""
        SELECT CAST(day AS VARCHAR) AS transaction_date, count(*) AS total_transaction_count,
               CAST(sum(cents) AS BIGINT) / 100.0 AS total_transaction_amount,
               CAST(sum(cents) AS BIGINT) / 100.0 / count(*) AS avg_transaction_amount,
               count(*) FILTER (WHERE success) AS successful_count,
               count(*) FILTER (WHERE declined) AS declined_or_failed_count,
               {_pct("count(*) FILTER (WHERE declined)", "count(*)")} AS decline_rate_pct,
               count(*) FILTER (WHERE src = 'SETTLEMENT') AS settlement_count,
               count(*) FILTER (WHERE src = 'PARTNER_EVENT') AS partner_event_count,
               CAST(coalesce(sum(cents) FILTER (WHERE dow IN (0, 6)), 0) AS BIGINT) / 100.0 AS weekend_amount,
               count(*) FILTER (WHERE hr BETWEEN 0 AND 5) AS late_night_transaction_count
        FROM txn GROUP BY day""",
    "feat": """
        SELECT customer_id, total_accounts, open_accounts, frozen_accounts, closed_accounts, total_balance,
               avg_account_balance, transaction_count_all_time, transaction_amount_30d, failed_payment_count,
               support_case_count, high_priority_case_count, open_case_count, account_age_days, has_risk_flag,
               CAST(CASE WHEN customer_status IN ('DORMANT', 'CLOSED') THEN 1 ELSE 0 END AS BIGINT) AS churn_label
        FROM c360 WHERE has_risk_flag IS NOT NULL""",
    "scored": """
        SELECT customer_id, churn_label,
               round(1.0::DOUBLE / (1.0::DOUBLE + exp(-(support_case_count * 0.3::DOUBLE + frozen_accounts * 0.2::DOUBLE
                   - open_accounts * 0.1::DOUBLE + failed_payment_count * 0.01::DOUBLE - 0.5::DOUBLE))), 6) AS p
        FROM feat""",
    "track": """
        SELECT c.customer_id, c.customer_status, c.customer_status IN ('DORMANT', 'CLOSED') AS actually_churned,
               s.p AS churn_probability,
               CASE WHEN s.p IS NULL THEN NULL ELSE '2024-01-31 08:00:00' END AS scored_at,
               coalesce(o.outcome, 'CORRECTLY NOT FLAGGED') AS tracking_outcome
        FROM c360 c LEFT JOIN scored s ON s.customer_id = c.customer_id
        LEFT JOIN (VALUES -- fixed texts by (churned, flagged)
            (true, true, 'CORRECTLY FLAGGED'), (true, false, 'MISSED (false negative)'),
            (false, true, 'FALSE ALARM (false positive)'), (false, false, 'CORRECTLY NOT FLAGGED')
        ) AS o(churned, flagged, outcome)
            ON o.churned = (c.customer_status IN ('DORMANT', 'CLOSED')) AND o.flagged = (s.p >= 0.5)""",
    "asked": "SELECT item_id AS query_id, unnest(list_distinct(" + WORDS.format("text") + ")) AS term FROM benchmark",
}


def build(select: str, **more: str) -> str:
    """The statement with the named parts it mentions, in the order they need each other."""
    parts = {**PARTS, **more}
    order: list[str] = []

    def need(text: str) -> None:
        for name in parts:
            if name not in order and re.search(rf"(?:FROM|JOIN|,)\s+\(?\s*{name}\b", text):
                need(parts[name])
                if name not in order:
                    order.append(name)

    need(select)
    head = ",\n".join(f"{name} AS ({parts[name]})" for name in order)
    return f"WITH {head}\n{select}" if order else select


def _bm25(docs: str, k: int, where: str = "TRUE", extra: str = "") -> str:
    return build(
        f"""
        SELECT query_id, doc_id, score, rank {extra} FROM (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM (
                SELECT a.query_id, t.doc_id, round(sum(
                    ln(1 + (s.n - f.df + 0.5::DOUBLE) / (f.df + 0.5::DOUBLE)) * (t.tf * 2.2::DOUBLE)
                    / (t.tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * t.doc_len / (s.total / s.n)))), 6) AS score
                FROM tf t JOIN asked a ON a.term = t.term JOIN df f ON f.term = t.term, tot s
                WHERE t.doc_id IN (SELECT doc_id FROM src WHERE {where})
                GROUP BY a.query_id, t.doc_id))
        WHERE rank <= {k}""",
        src=docs,
        tok="SELECT doc_id, w, len(w) AS doc_len FROM (SELECT doc_id, " + WORDS.format("body") + " AS w FROM src)",
        tot="SELECT CAST(count(*) AS DOUBLE) AS n, CAST(sum(doc_len) AS DOUBLE) AS total FROM tok",
        tf="SELECT doc_id, doc_len, term, count(*) AS tf FROM (SELECT doc_id, doc_len, unnest(w) AS term FROM tok) GROUP BY ALL",
        df="SELECT term, count(*) AS df FROM tf GROUP BY term",
    )


def _load_row(source: str, message: str, keys: int, rows: str, noun: str = "row(s)") -> str:
    return f"""
        SELECT '{source}' AS source_name, 'Success' AS status, n AS rows_loaded, CAST(0 AS BIGINT) AS duplicate_rows,
               CAST(0 AS BIGINT) AS null_rows, '' AS error_message, 'Success: loaded ' || n || ' new {noun}.' AS message,
               CAST({keys} AS BIGINT) AS known_keys, n AS raw_rows FROM (SELECT {rows} AS n)"""


LIVE = """SELECT account_id, customer_id, account_status, cents / 100.0 AS current_balance, 'USD' AS currency,
              CAST(ts AS VARCHAR) AS updated_at"""


def _expected_tests() -> str:
    """Failure counts of the suite, from the parts that stand for each model."""
    rates = "(SELECT 'USD' AS base_currency, quote_currency, micro AS exchange_rate, rate_date FROM rates)"
    model = {
        "stg_account_activity": "(SELECT account_id, account_status, ts AS activity_timestamp FROM activity)",
        "stg_accounts": "(SELECT account_id, customer_id, account_type, account_status AS account_status_at_creation, 'USD' AS currency FROM acct0)",
        "stg_accounts_current": "(SELECT account_id, account_status, cents AS current_balance, 'USD' AS currency FROM live)",
        "stg_customers": "(SELECT customer_id, customer_status, risk_rating FROM cust)",
        "stg_exchange_rates": rates,
        "stg_merchants": "(SELECT * FROM merch)",
        "stg_partner_transactions": "(SELECT event_id, account_id, merchant_id, status AS authorization_status, channel FROM partner)",
        "stg_settlements": "(SELECT settlement_id, account_id, merchant_id, cents AS amount, status AS settlement_status FROM settle)",
        "stg_support_cases": "(SELECT * FROM cases)",
        "int_customer_activity_summary": "(SELECT * FROM c360)",
        "int_merchant_risk_summary": "(SELECT * FROM mperf)",
        "int_transactions_unified": "(SELECT transaction_id, account_id, merchant_id, src AS transaction_source, via AS ingestion_channel, bucket AS amount_bucket FROM txn)",
        "mart_customer_360": "(SELECT * FROM c360)",
        "mart_daily_transaction_kpi": "(SELECT * FROM kpi)",
        "mart_merchant_performance": "(SELECT * FROM mperf)",
    }
    rows = []
    for name, tests in SUITE.items():
        src = model[name]
        for c in tests.not_null:
            rows.append((name, f"not_null_{c}", f"SELECT count(*) FROM {src} x WHERE {c} IS NULL"))
        for c, values in tests.accepted.items():
            listed = ", ".join(f"'{v}'" for v in values)
            rows.append((name, f"accepted_values_{c}", f"SELECT count(*) FROM {src} x WHERE {c} NOT IN ({listed})"))
        for c in tests.unique:
            rows.append((name, f"unique_{c}", f"SELECT count(*) FROM (SELECT {c} FROM {src} x WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)"))
        for c, (parent, pc) in tests.parents.items():
            rows.append((name, f"relationships_{c}", f"SELECT count(*) FROM {src} x WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {pc} FROM {model[parent]} y)"))
    for summary, source in PARITY:
        rows.append((summary, "rowcount_parity", f"SELECT CAST((SELECT count(*) FROM {model[summary]} x) <> (SELECT count(*) FROM {model[source]} y) AS BIGINT)"))
    union = "\nUNION ALL\n".join(f"SELECT '{m}' AS model_name, '{t}' AS test_name, ({q}) AS f" for m, t, q in rows)
    return build(
        f"""SELECT 'run1' AS test_run_id, model_name, test_name, CASE WHEN f = 0 THEN 'pass' ELSE 'fail' END AS test_status,
                   f AS failures_count, '2024-01-31 08:00:00' AS executed_at FROM ({union})"""
    )


def oracle_sql() -> dict[str, str]:
    o: dict[str, str] = {}
    flag = "REPLACE (CAST(has_risk_flag AS VARCHAR) AS has_risk_flag)"
    # ------------------------------------------------------------- sources
    o["scan_settlements_csv"] = build("""
        SELECT settlement_id, 'S' || settlement_id AS transaction_id, account_id, merchant_id,
               CAST(ts AS VARCHAR) AS transaction_timestamp, CAST(CAST(ts AS DATE) + 1 AS VARCHAR) AS settlement_date,
               cents / 100.0 AS amount, 'USD' AS currency, status AS settlement_status, fee_cents / 100.0 AS fee_amount
        FROM settle""")
    o["scan_ndjson_variant"] = build("""
        SELECT account_status, count(*) AS n_rows, CAST(sum(cents) AS BIGINT) / 100.0 AS balance,
               CAST(max(ts) AS VARCHAR) AS last_update FROM activity GROUP BY account_status""")
    o["scan_with_source_file"] = """
        SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS rows_without_source, TRUE AS all_from_events FROM events"""
    o["load_lenient"] = build("""
        SELECT is_bad AS _is_bad, count(*) AS n_rows, CAST(sum(CASE WHEN is_bad THEN 0 ELSE n END) AS BIGINT) AS event_id_sum
        FROM dirty GROUP BY is_bad""")
    o["load_strict"] = "SELECT count(*) AS loaded_rows, TRUE AS defective_refused FROM events"
    o["load_once_ledger"] = """
        SELECT count(*) AS raw_rows, 'Success: loaded ' || count(*) || ' new row(s).' AS first_run,
               'No new files to load -- all files already loaded previously.' AS second_run FROM events"""
    o["load_history_errors"] = build(f"""
        SELECT source_file AS _source_file, count(*) AS row_count, count(*) FILTER (WHERE is_bad) AS error_count,
               CAST(max(loaded_at) AS VARCHAR) AS last_load_time FROM dirty GROUP BY source_file
        HAVING max(loaded_at) >= {RUN} - INTERVAL 1 DAY AND count(*) FILTER (WHERE is_bad) > 0""")
    o["directory_listing"] = " UNION ALL ".join(
        f"SELECT '{n}.parquet' AS listed_as, TRUE AS all_have_size, count(*) AS n_rows FROM {n}" for n in TABLES
    )
    o["document_load"] = build("SELECT file_name, page_count, left(extracted_text, 200) AS preview FROM pol")
    o["document_text"] = build("SELECT file_name, extracted_text, page_count FROM pol")
    o["parse_json_insert"] = build("""
        SELECT CAST(rate_date AS VARCHAR) AS rate_date, 'USD' AS base_currency, micro / 1000000.0 AS rate_c3
        FROM rates WHERE quote_currency = 'C3'""")
    # --------------------------------------------------------------- sinks
    o["sink_append"] = build("""
        SELECT CASE WHEN status = 'FAILED' THEN 'b1' ELSE 'b2' END AS batch_id, count(*) AS n_rows,
               CAST(sum(cents) AS BIGINT) / 100.0 AS amount FROM settle GROUP BY 1""")
    o["sink_overwrite"] = build("SELECT account_id, count(*) AS n FROM activity GROUP BY account_id")
    o["sink_upsert"] = build("""
        SELECT account_id, CAST(ts AS VARCHAR) AS updated_at, cents / 100.0 AS balance FROM live""")
    o["materialize_models"] = build("""
        SELECT 'int_accounts_enriched' AS model, count(*) AS n_rows FROM acct
        UNION ALL SELECT 'int_transactions_unified', count(*) FROM txn
        UNION ALL SELECT 'int_customer_activity_summary', count(*) FROM cust
        UNION ALL SELECT 'int_merchant_risk_summary', count(*) FROM merch
        UNION ALL SELECT 'mart_customer_360', count(*) FROM cust
        UNION ALL SELECT 'mart_merchant_performance', count(*) FROM merch
        UNION ALL SELECT 'mart_daily_transaction_kpi', count(DISTINCT day) FROM txn""")
    # ---------------------------------------------------------- governance
    partner_keys = (
        "EVENT_ID", "TRANSACTION_ID", "ACCOUNT_ID", "MERCHANT_ID", "EVENT_TIMESTAMP", "AMOUNT", "CURRENCY",
        "AUTHORIZATION_STATUS", "CHANNEL", "DEVICE_ID",
    )
    listed = ", ".join(f"'{k}'" for k in partner_keys)
    o["json_key_set"] = build(f"""
        SELECT DISTINCT unnest([{listed}]) AS column_key FROM partner""")
    o["csv_header_set"] = """
        SELECT DISTINCT unnest(['settlement_id', 'transaction_id', 'account_id', 'merchant_id', 'transaction_timestamp',
            'settlement_date', 'amount', 'currency', 'settlement_status', 'fee_amount']) AS column_key FROM lineitem"""
    o["drift_missing_keys"] = "SELECT DISTINCT unnest(['MERCHANT_COUNTRY', 'CARD_NETWORK']) AS column_key FROM events"
    o["null_key_count"] = build("""
        SELECT 'settlements' AS source_name, count(*) FILTER (WHERE settlement_id IS NULL OR account_id IS NULL
               OR merchant_id IS NULL) AS null_rows FROM settle
        UNION ALL SELECT 'support_cases', count(*) FILTER (WHERE case_id IS NULL OR customer_id IS NULL) FROM cases
        UNION ALL SELECT 'account_activity', count(*) FILTER (WHERE account_id IS NULL) FROM activity
        UNION ALL SELECT 'exchange_rates', count(*) FILTER (WHERE rate_date IS NULL) FROM rates
        UNION ALL SELECT 'partner_transactions', count(*) FILTER (WHERE NOT is_bad
               AND (seen_account IS NULL OR seen_merchant IS NULL)) FROM dirty""")
    o["dup_key_count"] = build("""
        SELECT 'settlement_id' AS key_column, count(*) - count(DISTINCT settlement_id) AS duplicate_rows FROM settle
        UNION ALL SELECT 'account_id', count(*) - count(DISTINCT account_id) FROM settle""")
    o["batch_row_count"] = build("""
        SELECT 'settlements/' || CAST(CAST(ts AS DATE) AS VARCHAR) || '.csv' AS _source_file, count(*) AS rows_loaded
        FROM settle GROUP BY 1""")
    o["batch_verdict"] = build("""
        SELECT source_file AS _source_file, count(*) AS rows_loaded,
               CASE WHEN count(*) FILTER (WHERE seen_account IS NULL OR seen_merchant IS NULL) > 0
                    THEN count(*) FILTER (WHERE seen_account IS NULL OR seen_merchant IS NULL) || ' rows with missing keys.'
                    WHEN count(*) > count(DISTINCT device_id)
                    THEN (count(*) - count(DISTINCT device_id)) || ' duplicate device_id(s) found.'
                    ELSE 'ok' END AS verdict
        FROM dirty WHERE NOT is_bad GROUP BY source_file""")
    o["validate_and_load_settlements"] = _load_row("settlements", "", 10, "(SELECT count(*) FROM lineitem)")
    o["validate_and_load_support_cases"] = _load_row("support_cases", "", 7, "(SELECT count(*) FROM documents)")
    o["validate_and_load_account_activity"] = _load_row("account_activity", "", 6, "(SELECT count(*) FROM events)")
    o["validate_and_load_exchange_rates"] = _load_row(
        "exchange_rates", "", 3, "(SELECT count(DISTINCT CAST(ts AS DATE)) FROM events)", "file(s)"
    )
    o["audit_append"] = """
        SELECT 'support_cases' AS source_name, 'Success' AS status, '2024-01-31 08:00:00' AS load_timestamp,
               count(*) AS rows_loaded, CAST(0 AS BIGINT) AS duplicate_rows, CAST(0 AS BIGINT) AS null_rows,
               '' AS error_message FROM documents
        UNION ALL SELECT 'support_cases', 'Failed', '2024-02-01 08:00:00', 2 * count(*), count(*), 0,
               count(*) || ' duplicate case_id(s) found.' FROM documents"""
    o["promote_new_files"] = build("""
        SELECT status AS settlement_status, count(*) AS n_rows, CAST(sum(cents) AS BIGINT) / 100.0 AS amount,
               CAST(sum(fee_cents) AS BIGINT) / 100.0 AS fees FROM settle GROUP BY status""")
    o["snapshot_upsert"] = f"""
        SELECT DISTINCT 'partner_transactions' AS source_name, k AS column_key, '2024-01-01 00:00:00' AS first_seen_at,
               CASE WHEN k IN ({listed}) THEN '2024-01-31 08:00:00' ELSE '2024-01-01 00:00:00' END AS last_seen_at
        FROM (SELECT unnest([{listed}, 'MERCHANT_COUNTRY', 'CARD_NETWORK']) AS k FROM events)"""
    o["load_audit"] = """
        SELECT 'support_cases' AS source_system, 'raw.support_cases' AS target_table, 'LOADED' AS load_status,
               count(*) AS row_count FROM documents"""
    o["run_records"] = """
        SELECT 'b20240131T080000000000-' || p AS run_id, p AS pipeline_name, t AS trigger_type, 'SUCCESS' AS status,
               '2024-01-31 08:00:00' AS started_at, '2024-02-01 08:00:00' AS ended_at,
               (SELECT count(*) FROM events) AS raw_rows
        FROM (VALUES ('account_activity_load', 'MANUAL'), ('models', 'SCHEDULED')) v(p, t)"""
    keys = "event_id, seen_account AS account_id, seen_merchant AS merchant_id, source_file AS _source_file"
    o["clean_split"] = build(f"""
        SELECT {keys} FROM dirty WHERE NOT is_bad AND seen_account IS NOT NULL AND seen_merchant IS NOT NULL""")
    o["quarantine_split"] = build(f"""
        SELECT {keys} FROM dirty WHERE NOT is_bad AND (seen_account IS NULL OR seen_merchant IS NULL)""")
    o["quarantine_split_literal"] = build(f"""
        SELECT {keys} FROM dirty WHERE NOT is_bad AND seen_account IS NULL""")
    o["quarantine_recent_count"] = build(f"""
        SELECT count(*) AS quarantined_rows FROM dirty WHERE NOT is_bad
        AND (seen_account IS NULL OR seen_merchant IS NULL) AND loaded_at >= {RUN} - INTERVAL 1 DAY""")
    o["stream_health"] = build(f"""
        SELECT f AS failed_files, 'CARD_NETWORK, MERCHANT_COUNTRY' AS missing_keys,
               CASE WHEN f > 0 THEN f || ' file(s) failed to parse. ' ELSE '' END
               || 'Schema drift: missing CARD_NETWORK, MERCHANT_COUNTRY. ' AS summary
        FROM (SELECT count(*) AS f FROM (SELECT source_file FROM dirty GROUP BY source_file
              HAVING max(loaded_at) >= {RUN} - INTERVAL 1 DAY AND count(*) FILTER (WHERE is_bad) > 0))""")
    age = f"date_diff('second', max(loaded_at), {RUN} + INTERVAL 9 HOUR)"
    o["source_freshness"] = build(f"""
        SELECT 'partner_transactions' AS source_name, CAST(max(loaded_at) AS VARCHAR) AS max_loaded_at, {age} AS age_seconds,
               CASE WHEN {age} > 172800 THEN 'error' WHEN {age} > 43200 THEN 'warn' ELSE 'pass' END AS status FROM partner
        UNION ALL SELECT 'account_activity', CAST(max(loaded_at) AS VARCHAR), {age},
               CASE WHEN {age} > 604800 THEN 'error' WHEN {age} > 259200 THEN 'warn' ELSE 'pass' END FROM activity""")
    second = "CAST(max(CAST(CAST({0} AS DATE) AS TIMESTAMP)) + INTERVAL 26 HOUR AS VARCHAR)"
    o["table_inventory"] = build(f"""
        SELECT 'settlements' AS source, count(*) AS row_count, {second.format('ts')} AS last_loaded FROM settle
        UNION ALL SELECT 'partner_transactions', count(*), CAST(max(loaded_at) AS VARCHAR) FROM partner
        UNION ALL SELECT 'customers_files', count(*), '2024-01-02 00:00:00' FROM customer
        UNION ALL SELECT 'accounts_files', count(*), '2024-01-02 00:00:00' FROM orders
        UNION ALL SELECT 'merchants_files', 2 * count(*), '2024-01-02 00:00:00' FROM supplier
        UNION ALL SELECT 'support_cases', count(*), {second.format('opened_at')} FROM cases
        UNION ALL SELECT 'policy_documents', count(*), '2024-01-02 00:00:00' FROM pages
        UNION ALL SELECT 'exchange_rates', count(DISTINCT rate_date), CAST(max(rate_date) + INTERVAL 6 HOUR AS VARCHAR) FROM rates
        UNION ALL SELECT 'account_activity_raw', count(*), CAST(max(loaded_at) AS VARCHAR) FROM activity
        UNION ALL SELECT 'accounts_current_core', count(*), '2024-01-31 08:00:00' FROM live
        ORDER BY source""")
    o["per_file_counts"] = build("""
        SELECT source_file AS _source_file, count(*) AS row_count, CAST(max(loaded_at) AS VARCHAR) AS last_loaded
        FROM activity GROUP BY source_file ORDER BY max(loaded_at) DESC, source_file LIMIT 5""")
    o["sum_check"] = build("SELECT count(*) AS row_count, CAST(sum(cents) AS BIGINT) / 100.0 AS total_amount FROM settle")
    o["test_unique"] = build("""
        SELECT account_id AS value, count(*) AS n_records FROM activity GROUP BY account_id HAVING count(*) > 1""")
    nulls = "count(*) FILTER (WHERE {0} IS NULL)"
    o["test_not_null"] = build(
        "\nUNION ALL\n".join(
            f"SELECT '{c}' AS column_name, {nulls.format(c)} AS failures FROM c360"
            for c in ("customer_id", "risk_rating", "has_risk_flag", "last_transaction_date")
        )
    )
    o["test_accepted_values"] = build("""
        SELECT status AS value, count(*) AS n_records FROM txn WHERE status NOT IN ('APPROVED', 'SETTLED') GROUP BY status""")
    o["test_relationships"] = build("""
        SELECT account_id AS value, count(*) AS n_records FROM txn
        WHERE account_id NOT IN (SELECT account_id FROM acct0) GROUP BY account_id""")
    o["test_rowcount_parity"] = """
        SELECT 'accounts_against_customers' AS pair, a AS summary_row_count, c AS source_row_count
        FROM (SELECT (SELECT count(*) FROM orders) AS a, (SELECT count(*) FROM customer) AS c) WHERE a <> c"""
    o["dq_results"] = _expected_tests()
    triage = {
        "lines": """
            SELECT user_id, event_id AS pos, CASE
                WHEN user_id % 10 = 3 THEN '12:00:01  Finished running 3 models'
                WHEN event_id % 7 = 0 THEN 'ERROR creating sql table model core.m_' || event_id % 4
                WHEN event_id % 7 = 1 THEN '  Database Error in model stg_' || event_id % 11
                WHEN event_id % 7 = 2 THEN 'Failure in test unique_' || event_id % 3 || ' (models/x.yml)'
                WHEN event_id % 7 = 3 THEN 'Compilation Error in snapshot snap_' || event_id % 2 || '; Failure in test both'
                ELSE '12:00:02  1 of 3 OK' END AS v FROM events""",
        "hit0": r"""
            SELECT user_id, pos, 0 AS w, 'Model failed to build: ' || regexp_extract(v, 'ERROR creating.*model\s+([A-Za-z0-9_.]+)', 1) AS h
            FROM lines WHERE regexp_matches(v, 'ERROR creating.*model\s+[A-Za-z0-9_.]+')
            UNION ALL SELECT user_id, pos, 1, 'Database error: ' || regexp_extract(v, 'Database Error in (?:model|test|snapshot)\s+([A-Za-z0-9_.]+)', 1)
            FROM lines WHERE regexp_matches(v, 'Database Error in (?:model|test|snapshot)\s+[A-Za-z0-9_.]+')
            UNION ALL SELECT user_id, pos, 2, 'Compilation error: ' || regexp_extract(v, 'Compilation Error in (?:model|test|snapshot)\s+([A-Za-z0-9_.]+)', 1)
            FROM lines WHERE regexp_matches(v, 'Compilation Error in (?:model|test|snapshot)\s+[A-Za-z0-9_.]+')
            UNION ALL SELECT user_id, pos, 3, 'Test failed: ' || regexp_extract(v, 'Failure in test\s+([A-Za-z0-9_.]+)', 1)
            FROM lines WHERE regexp_matches(v, 'Failure in test\s+[A-Za-z0-9_.]+')""",
        "firsts": "SELECT user_id, h, min(pos * 4 + w) AS p FROM hit0 GROUP BY user_id, h",
        "topped": """
            SELECT user_id, string_agg(h, '; ' ORDER BY p) AS s FROM
                (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY p) AS r FROM firsts) WHERE r <= 5 GROUP BY user_id""",
        "summary": """
            SELECT u.user_id, coalesce(t.s, 'No specific dbt error pattern matched -- check the full task log.') AS s
            FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN topped t ON t.user_id = u.user_id""",
    }
    o["log_triage_summary"] = build(
        """SELECT 'models' AS dag_id, 'task_' || user_id AS task_id, '1' AS attempt, s AS error_summary FROM summary""", **triage
    )
    o["error_log_append"] = build(
        """SELECT 'models' AS dag_id, 'task_' || user_id AS task_id, 'FAILED' AS status, '1' AS attempt,
                  s AS error_summary FROM summary""",
        **triage,
    )
    # ------------------------------------------------------------- staging
    o["stg_settlements"] = build("""
        SELECT settlement_id, 'S' || settlement_id AS transaction_id, account_id, merchant_id,
               CAST(ts AS VARCHAR) AS transaction_timestamp, CAST(CAST(ts AS DATE) + 1 AS VARCHAR) AS settlement_date,
               cents / 100.0 AS amount, 'USD' AS currency, status AS settlement_status, fee_cents / 100.0 AS fee_amount,
               CAST(CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 26 HOUR AS VARCHAR) AS _loaded_at,
               'settlements/' || CAST(CAST(ts AS DATE) AS VARCHAR) || '.csv' AS _source_file
        FROM settle""")
    o["stg_partner_transactions"] = build("""
        SELECT event_id, transaction_id, account_id, merchant_id, CAST(ts AS VARCHAR) AS event_timestamp,
               cents / 100.0 AS amount, 'USD' AS currency, status AS authorization_status, channel, device_id,
               CAST(loaded_at AS VARCHAR) AS _loaded_at, source_file AS _source_file FROM partner""")
    o["stg_support_cases"] = build("""
        SELECT case_id, customer_id, category, priority, status, narrative, CAST(opened_at AS VARCHAR) AS opened_at,
               CAST(CAST(CAST(opened_at AS DATE) AS TIMESTAMP) + INTERVAL 26 HOUR AS VARCHAR) AS _loaded_at,
               'support_cases/' || CAST(CAST(opened_at AS DATE) AS VARCHAR) || '.json' AS _source_file FROM cases""")
    o["stg_account_activity"] = build("""
        SELECT account_id, customer_id, account_status, cents / 100.0 AS balance, 'USD' AS currency,
               CAST(ts AS VARCHAR) AS activity_timestamp, CAST(loaded_at AS VARCHAR) AS _loaded_at,
               source_file AS _source_file FROM activity""")
    o["stg_customers"] = build("""
        SELECT customer_id, 'Customer' AS first_name, last_name, 'c' || k || '@example.com' AS email,
               '+1-555-' || lpad(CAST(k % 10000 AS VARCHAR), 4, '0') AS phone, 'City ' || k % 97 AS city,
               'S' || k % 50 AS state, 'US' AS country, customer_status, risk_rating,
               CAST(created_at AS VARCHAR) AS created_at, CAST(created_at + INTERVAL 30 DAY AS VARCHAR) AS updated_at,
               '2024-01-02 00:00:00' AS _loaded_at, 'customers/' || k % 16 || '.json' AS _source_file FROM cust""")
    o["stg_accounts"] = build("""
        SELECT account_id, customer_id, account_type, account_status AS account_status_at_creation,
               cents / 100.0 AS balance_at_creation, 'USD' AS currency, CAST(created_at AS VARCHAR) AS created_at,
               CAST(created_at + INTERVAL 10 DAY AS VARCHAR) AS file_updated_at, '2024-01-02 00:00:00' AS _loaded_at,
               'accounts/' || k % 16 || '.json' AS _source_file FROM acct0""")
    o["stg_merchants"] = build("""
        SELECT *, '2024-01-02 00:00:00' AS _loaded_at, 'merchants/2024-01-02.json' AS _source_file FROM merch""")
    o["stg_exchange_rates"] = build("""
        SELECT 'USD' AS base_currency, CAST(rate_date AS VARCHAR) || ' 06:00:00' AS ingested_at,
               CAST(rate_date AS VARCHAR) AS rate_date, quote_currency, micro / 1000000.0 AS exchange_rate,
               CAST(rate_date AS VARCHAR) || ' 06:00:00' AS _loaded_at,
               'exchange_rates/' || CAST(rate_date AS VARCHAR) || '.json' AS _source_file FROM rates""")
    o["stg_accounts_current"] = build(f"{LIVE} FROM live")
    # ----------------------------------------------------------------- cdc
    o["cdc_accounts_current"] = build(f"{LIVE}, '2024-01-31 08:00:00' AS _merged_at FROM live")
    merged = """CASE WHEN CAST(CAST(ts AS DATE) AS TIMESTAMP) + to_hours(CAST((hour(ts) // 4) * 4 + 4 AS INTEGER))
                > TIMESTAMP '2024-01-16' THEN '{}' ELSE '{}' END AS _merged_at"""
    o["cdc_late_guard"] = build(
        f"{LIVE}, {merged.format('2024-01-31 08:00:00', '2024-02-01 08:00:00')} FROM live"
    )
    o["stream_cdc_merge"] = build(
        f"{LIVE}, {merged.format('2024-02-01 08:00:00', '2024-01-31 08:00:00')} FROM live"
    )
    # -------------------------------------------------------- intermediate
    o["int_accounts_enriched"] = build("""
        SELECT account_id, customer_id, account_type, 'USD' AS currency, CAST(created_at AS VARCHAR) AS created_at,
               account_status, cents / 100.0 AS current_balance, CAST(last_updated_at AS VARCHAR) AS last_updated_at,
               has_activity_history FROM acct""")
    o["int_transactions_unified"] = build("""
        SELECT transaction_id, account_id, merchant_id, CAST(ts AS VARCHAR) AS transaction_timestamp,
               cents / 100.0 AS amount, 'USD' AS currency, status, src AS transaction_source, via AS ingestion_channel,
               channel AS transaction_channel, CAST(day AS VARCHAR) AS transaction_date, hr AS transaction_hour,
               dow AS day_of_week, dow IN (0, 6) AS is_weekend, hr BETWEEN 0 AND 5 AS is_late_night,
               bucket AS amount_bucket, declined AS is_declined_or_failed, success AS is_successful FROM txn""")
    o["txn_time_features"] = build("""
        SELECT hr AS transaction_hour, dow AS day_of_week, dow IN (0, 6) AS is_weekend, hr < 6 AS is_late_night,
               count(*) AS n, CAST(max(day) AS VARCHAR) AS last_date FROM txn GROUP BY hr, dow""")
    o["txn_amount_bucket"] = build("""
        SELECT bucket AS amount_bucket, count(*) AS n, CAST(sum(cents) AS BIGINT) / 100.0 AS amount FROM txn GROUP BY bucket""")
    o["txn_outcome_flags"] = build("""
        SELECT status, declined AS is_declined_or_failed, success AS is_successful, count(*) AS n FROM txn GROUP BY ALL""")
    o["account_summary"] = build("""
        SELECT customer_id, total_accounts, open_accounts, frozen_accounts, closed_accounts,
               cents / 100.0 AS total_balance_across_accounts, mean AS avg_account_balance,
               CAST(newest AS VARCHAR) AS most_recent_account_update FROM acc_sum""")
    o["transaction_summary"] = build("""
        SELECT customer_id, n AS transaction_count_all_time, n30 AS transaction_count_30d,
               cents30 / 100.0 AS transaction_amount_30d, failed AS failed_payment_count,
               CAST(last_day AS VARCHAR) AS last_transaction_date, recency AS days_since_last_transaction FROM txn_sum""")
    o["support_summary"] = build("""
        SELECT customer_id, cases AS support_case_count, high AS high_priority_case_count, opened AS open_case_count
        FROM case_sum""")
    o["int_customer_activity_summary"] = build(f"SELECT * EXCLUDE (balance_cents) {flag} FROM c360")
    o["merchant_txn_summary"] = build("""
        SELECT merchant_id, n AS total_transaction_count, cents / 100.0 AS total_transaction_amount,
               mean AS avg_transaction_amount, d AS declined_count, s AS successful_count, n30 AS transaction_count_30d,
               d30 AS declined_count_30d, CAST(last_day AS VARCHAR) AS last_transaction_date FROM merch_sum""")
    o["int_merchant_risk_summary"] = build("SELECT * FROM mperf")
    # --------------------------------------------------------------- marts
    o["mart_customer_360"] = o["int_customer_activity_summary"]
    o["mart_merchant_performance"] = o["int_merchant_risk_summary"]
    o["mart_daily_transaction_kpi"] = build("SELECT * FROM kpi")
    # ------------------------------------------------------------- metrics
    o["metric_query"] = build("""
        SELECT engagement_segment AS engagement, risk_rating, CAST(sum(balance_cents) AS BIGINT) / 100.0 AS total_customer_balance,
               count(customer_id) AS customer_count, CAST(sum(failed_payment_count) AS BIGINT) AS total_failed_payments
        FROM c360 WHERE customer_status IN ('ACTIVE', 'DORMANT') AND risk_rating <> 'MEDIUM'
        GROUP BY engagement_segment, risk_rating""")
    o["metric_customers"] = build("""
        SELECT engagement_segment AS engagement, CAST(sum(balance_cents) AS BIGINT) / 100.0 AS total_customer_balance,
               CAST(sum(transaction_count_all_time) AS BIGINT)::DOUBLE / count(*) AS avg_transactions_per_customer,
               CAST(sum(failed_payment_count) AS BIGINT) AS total_failed_payments,
               CAST(sum(support_case_count) AS BIGINT) AS total_support_cases, count(customer_id) AS customer_count
        FROM c360 GROUP BY engagement_segment""")
    o["metric_merchants"] = build("""
        SELECT industry, risk_category, CAST(sum(coalesce(t.cents, 0)) AS BIGINT) / 100.0 AS total_merchant_volume,
               CAST(sum(coalesce(t.d, 0)) AS BIGINT) AS total_declines, count(*) AS merchant_count
        FROM merch m LEFT JOIN merch_sum t ON t.merchant_id = m.merchant_id GROUP BY industry, risk_category""")
    o["metric_daily"] = build("""
        SELECT CAST(sum(cents) AS BIGINT) / 100.0 AS total_daily_volume, count(*) AS total_daily_count FROM txn""")
    # -------------------------------------------------------------- search
    case_docs = "SELECT doc_id, narrative AS body, status FROM cases"
    inner = _bm25(case_docs, 5, "status = 'OPEN'")
    o["search_support_cases"] = build(f"""
        SELECT h.query_id, h.doc_id AS case_no, h.score, h.rank, c.customer_id, c.category, c.priority, c.status
        FROM ({inner}) h JOIN cases c ON c.doc_id = h.doc_id""")
    inner = _bm25("SELECT file_name AS doc_id, extracted_text AS body FROM pol", 5)
    o["search_policy_docs"] = build(f"""
        SELECT h.query_id, h.doc_id AS file_name, h.score, h.rank, p.page_count
        FROM ({inner}) h JOIN pol p ON p.file_name = h.doc_id""")
    o["stream_index_refresh"] = _bm25("SELECT doc_id, text AS body FROM documents", 3)
    o["vector_topk"] = """
        WITH parts AS (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
        centre AS (SELECT label, list(x ORDER BY i) AS c FROM (SELECT label, i, avg(x) AS x FROM parts GROUP BY label, i) GROUP BY label)
        SELECT query_id, doc_id, score, rank FROM (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM (
                SELECT CAST(label_c AS BIGINT) AS query_id, vec_id AS doc_id,
                       round(list_cosine_similarity(embedding::DOUBLE[], c), 6) AS score
                FROM embeddings, (SELECT label AS label_c, c FROM centre)))
        WHERE rank <= 10"""
    doc_words = "SELECT doc_id, " + WORDS.format("text") + " AS w FROM documents"
    o["index_refresh_incremental"] = f"""
        SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS tf FROM
            (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM ({doc_words})) GROUP BY ALL)
        GROUP BY term"""
    o["index_manifest"] = f"""
        SELECT CASE WHEN doc_id % 4 = 0 THEN 'r2' ELSE 'r1' END AS refresh,
               CASE WHEN doc_id % 4 = 0 THEN '2024-01-31 08:00:00' ELSE '2024-01-30 08:00:00' END AS indexed_at,
               count(*) AS documents, CAST(sum(len(w)) AS BIGINT) AS words
        FROM ({doc_words}) GROUP BY ALL"""
    o["index_lag"] = """
        SELECT '2024-01-30 08:00:00' AS max_loaded_at, CAST(86400 AS BIGINT) AS age_seconds, 'error' AS status,
               count(*) AS documents FROM documents"""
    # --------------------------------------------------------------- churn
    o["churn_label"] = build("""
        SELECT customer_id, customer_status,
               CAST(CASE WHEN customer_status IN ('DORMANT', 'CLOSED') THEN 1 ELSE 0 END AS BIGINT) AS churn_label FROM cust""")
    o["churn_features"] = build(f"SELECT * {flag} FROM feat")
    o["churn_split"] = build("""
        SELECT substr(md5(customer_id || ':42'), 1, 8) < 'cccccccc' AS is_train, churn_label, count(*) AS customers
        FROM feat GROUP BY ALL""")
    # The version of the run and the note on a first model.
    for name in ("churn_train", "training_log_latest"):
        o[name] = build("""
        SELECT 'v_20240131_080000' AS version_name, TRUE AS promoted,
               'No prior model existed -- promoted as the new default.' AS promotion_note, TRUE AS metrics_in_range,
               count(*) FILTER (substr(md5(customer_id || ':42'), 1, 8) < 'cccccccc') AS trained_rows,
               count(*) FILTER (substr(md5(customer_id || ':42'), 1, 8) >= 'cccccccc') AS held_out_rows
        FROM feat""")
    o["churn_score"] = build("""
        SELECT customer_id, TRUE AS in_range, '2024-01-31 08:00:00' AS scored_at, 'v_20240131_080000' AS model_version FROM feat""")
    o["auc_by_rank"] = build("""
        SELECT positives, negatives, round(wins::DOUBLE / (2.0::DOUBLE * positives * negatives), 9) AS auc FROM (
            SELECT CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives, sum(pos * (2 * below + neg)) AS wins FROM (
                SELECT *, coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM (
                    SELECT p, count(*) FILTER (WHERE churn_label = 1) AS pos, count(*) FILTER (WHERE churn_label = 0) AS neg
                    FROM scored GROUP BY p)))""")
    o["churn_tracking"] = build("SELECT * FROM track")
    o["churned_count"] = build("SELECT count(*) AS churned_customers FROM track WHERE actually_churned")
    o["churn_outcome_counts"] = build(
        "SELECT tracking_outcome, count(*) AS customers FROM track GROUP BY tracking_outcome"
    )
    o["churn_risk_list"] = build("""
        SELECT customer_id, churn_probability FROM track WHERE customer_status = 'ACTIVE' AND churn_probability >= 0.5
        ORDER BY churn_probability DESC, customer_id""")
    o["churn_top20"] = build("""
        SELECT customer_id, p AS churn_probability FROM scored ORDER BY p DESC, customer_id LIMIT 20""")
    # ----------------------------------------------------------- streaming
    o["stream_partner_ingest"] = build("""
        SELECT source_file AS _source_file, count(*) AS row_count, count(*) FILTER (WHERE is_bad) AS error_count,
               count(*) FILTER (WHERE NOT is_bad) AS good, count(*) FILTER (WHERE is_bad) AS bad FROM dirty GROUP BY source_file""")
    o["stream_activity_ingest"] = build("""
        SELECT account_id, count(*) AS events, '2024-01-31 08:00:00' AS loaded_at FROM activity GROUP BY account_id""")
    o["stream_clean_quarantine"] = build("""
        SELECT CASE WHEN seen_account IS NULL OR seen_merchant IS NULL THEN 'quarantine' ELSE 'clean' END AS side,
               source_file AS _source_file, count(*) AS n_rows FROM dirty WHERE NOT is_bad GROUP BY ALL""")
    o["stream_event_dedup"] = build("""
        SELECT event_id, cents / 100.0 AS amount, CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN 3 ELSE 1 END AS copies FROM partner""")
    # -------------------------------------------------------------- extras
    o["fx_to_usd"] = build(
        """
        SELECT currency, count(*) AS n, count(usd) AS n_converted, CAST(sum(usd) AS BIGINT) / 100.0 AS amount_usd FROM (
            SELECT t.currency, CASE WHEN t.currency = 'USD' THEN t.cents
                                    ELSE (2 * t.cents * 1000000 + r.micro) // (2 * r.micro) END AS usd
            FROM priced t ASOF LEFT JOIN rates r ON t.currency = r.quote_currency AND t.day >= r.rate_date)
        GROUP BY currency""",
        priced="""SELECT *, CASE WHEN CAST(merchant_id AS BIGINT) % 26 = 25 THEN 'USD'
                  ELSE 'C' || CAST(merchant_id AS BIGINT) % 26 END AS currency FROM txn""",
    )
    spans = []
    for d in (30, 60, 90):
        w = f"OVER (PARTITION BY customer_id ORDER BY day RANGE BETWEEN INTERVAL {d - 1} DAY PRECEDING AND CURRENT ROW)"
        spans.append(
            f"CAST(sum(cents) {w} AS BIGINT) / 100.0 AS volume_{d}d, "
            f"{_pct(f'CAST(sum(failed) {w} AS BIGINT)', f'CAST(sum(n) {w} AS BIGINT)')} AS failure_pct_{d}d, "
            f"CAST(sum(tickets) {w} AS BIGINT) AS tickets_{d}d"
        )
    o["rolling_30_60_90"] = build(
        f"SELECT customer_id, CAST(day AS VARCHAR) AS day, {', '.join(spans)} FROM daily",
        daily="""
            SELECT customer_id, day, sum(cents) AS cents, sum(n) AS n, sum(failed) AS failed, sum(tickets) AS tickets FROM (
                SELECT a.customer_id, t.day, t.cents, 1 AS n, CASE WHEN declined THEN 1 ELSE 0 END AS failed, 0 AS tickets
                FROM txn t JOIN acct0 a ON a.account_id = t.account_id
                UNION ALL SELECT customer_id, CAST(opened_at AS DATE), 0, 0, 0, 1 FROM cases)
            GROUP BY customer_id, day""",
    )
    o["merchant_chargeback_ratio"] = build(f"""
        SELECT merchant_id, count(*) AS settlement_count, count(*) FILTER (WHERE status = 'FAILED') AS failed_count,
               {_pct("count(*) FILTER (WHERE status = 'FAILED')", "count(*)")} AS chargeback_ratio_pct
        FROM settle GROUP BY merchant_id""")
    money = "printf('%d.%02d', {0} // 100, {0} % 100)"
    o["settlement_audit_hash"] = build(f"""
        SELECT settlement_id, sha256(concat_ws(chr(1), settlement_id, account_id, merchant_id,
               CAST(CAST(ts AS DATE) + 1 AS VARCHAR), {money.format('cents')}, 'USD', status, {money.format('fee_cents')})) AS audit_hash
        FROM settle""")
    o["case_sla"] = build(f"""
        SELECT case_id, priority, status, date_diff('day', CAST(opened_at AS DATE), {AS_OF}) AS open_days
        FROM cases WHERE status <> 'RESOLVED'""")
    o["activity_state_changes"] = build("""
        SELECT account_id, CAST(ts AS VARCHAR) AS activity_timestamp, p AS from_status, account_status AS to_status,
               (cents - pc) / 100.0 AS balance_delta FROM (
            SELECT *, lag(account_status) OVER w AS p, lag(cents) OVER w AS pc FROM activity
            WINDOW w AS (PARTITION BY account_id ORDER BY ts, event_id)) WHERE p <> account_status""")
    o["assert_balance"] = build("""
        SELECT settlement_id, cents / 100.0 AS amount, fee_cents / 100.0 AS fee_amount FROM settle
        WHERE cents IS NULL OR fee_cents IS NULL""")
    o["dim_customers"] = build("""
        SELECT c.customer_id, first_name, last_name, customer_status, risk_rating, engagement_segment, s.p AS churn_probability
        FROM c360 c LEFT JOIN scored s ON s.customer_id = c.customer_id""")
    o["dim_merchants"] = build("SELECT * FROM merch")
    o["fct_transactions"] = build("""
        SELECT transaction_id, account_id, merchant_id, CAST(day AS VARCHAR) AS transaction_date, cents / 100.0 AS amount,
               status, src AS transaction_source, bucket AS amount_bucket, declined AS is_declined_or_failed FROM txn""")
    return o

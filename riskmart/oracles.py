"""The registered queries once more, as plain SQL straight over the sample tables.

The SQL goes from the source columns to the result without the steps of the Spark
plans (no JSON, no typing from text), so the two only agree if both are right.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}

AS_OF = "TIMESTAMP '2024-06-01 00:00:00'"


def half_up(total_hundredths: str, count: str) -> str:
    """Mean of a total given in hundredths: to 6 decimals, then to 2, ties away from zero."""
    six = f"((2 * CAST({total_hundredths} AS HUGEINT) * 10000 + {count}) // (2 * {count}))"
    return f"(CAST(({six} + 5000) // 10000 AS DOUBLE) / 100)"


def mean_score(column: str = "risk_score") -> str:
    return f"(CAST((200 * CAST(sum({column}) AS HUGEINT) + count({column})) // (2 * count({column})) AS DOUBLE) / 100)"


def pct(part: str, whole: str) -> str:
    return f"round(CAST({part} AS DOUBLE) * 100.0 / CAST({whole} AS DOUBLE), 2)"


def many(condition: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {condition}) AS BIGINT)"


def worth(condition: str, column: str = "amount") -> str:
    return f"CAST(coalesce(sum({column}) FILTER (WHERE {condition}), 0) AS DOUBLE)"


# Named sub-queries; each lists the ones it builds on.
PARTS: dict[str, tuple[tuple[str, ...], str]] = {}


def part(name: str, sql: str, *needs: str) -> None:
    PARTS[name] = (needs, sql)


def compose(body: str, *needs: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for other in PARTS[name][0]:
                visit(other)
            order.append(name)

    for name in needs:
        visit(name)
    clauses = ",\n".join(f"{name} AS ({PARTS[name][1]})" for name in order)
    return f"WITH {clauses}\n{body}" if clauses else body


def oracle(name: str, body: str, *needs: str) -> None:
    ORACLES[name] = compose(body, *needs)


# ---- operational tables ----------------------------------------------------------

part("nat", "SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
part(
    "first_line",
    """SELECT l_orderkey, l_suppkey FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey) = 1""",
)
part(
    "pay",
    """SELECT o_orderkey AS k, o_custkey AS cust, l_suppkey AS supp, o_orderdate AS event_time,
      CAST(o_totalprice AS DECIMAL(12,2)) AS amount,
      CASE cn.r_name WHEN 'AMERICA' THEN 'USD' WHEN 'EUROPE' THEN 'EUR' ELSE 'BRL' END AS currency,
      cn.r_name AS home_region,
      CASE WHEN o_orderkey % 5 = 0 THEN sn.r_name ELSE cn.r_name END AS ip_region,
      CASE WHEN o_orderkey % 3 = 0 THEN sn.r_name ELSE cn.r_name END AS shipping_region,
      o_orderkey % 7 = 0 AS is_new_device,
      o_orderkey % 1000 AS account_age_days,
      o_orderkey % 6 AS login_failures, 1 + o_orderkey % 5 AS attempt_number,
      CAST(greatest(c_acctbal, 0) * 25 AS DECIMAL(12,2)) AS customer_average_amount,
      o_orderkey % 11 = 0 AS disputed, TIMESTAMP '2024-02-01' + to_seconds(o_orderkey) AS captured
    FROM orders JOIN first_line ON l_orderkey = o_orderkey
    JOIN customer ON c_custkey = o_custkey JOIN nat cn ON cn.n_nationkey = c_nationkey
    JOIN supplier ON s_suppkey = l_suppkey JOIN nat sn ON sn.n_nationkey = s_nationkey""",
    "nat", "first_line",
)
part(
    "hits",
    """SELECT *, amount >= 250 AND amount >= 3 * customer_average_amount AS h1, is_new_device AS h2,
      ip_region <> home_region AS h3, shipping_region <> home_region AS h4,
      login_failures >= 3 AS h5, attempt_number >= 4 AS h6 FROM pay""",
    "pay",
)
part(
    "dec",
    """SELECT *, CASE WHEN risk_score >= 60 THEN 'DECLINE' WHEN risk_score >= 30 THEN 'REVIEW'
        ELSE 'APPROVE' END AS action
    FROM (SELECT *, least(100, 30 * h1::INT + 20 * h2::INT + 20 * h3::INT + 10 * h4::INT
        + 20 * h5::INT + 15 * h6::INT) AS risk_score,
      concat_ws(',', CASE WHEN h1 THEN 'AMOUNT_OUTLIER' END, CASE WHEN h2 THEN 'NEW_DEVICE' END,
        CASE WHEN h3 THEN 'IP_HOME_MISMATCH' END, CASE WHEN h4 THEN 'SHIPPING_HOME_MISMATCH' END,
        CASE WHEN h5 THEN 'REPEATED_LOGIN_FAILURES' END,
        CASE WHEN h6 THEN 'REPEATED_PAYMENT_ATTEMPTS' END) AS reason_codes
      FROM hits)""",
    "hits",
)

oracle(
    "payment_decisions",
    f"""SELECT sha256(k || '|rules-v1') AS decision_id, CAST(k AS VARCHAR) AS transaction_id,
      CAST(cust AS VARCHAR) AS customer_id, risk_score, action, reason_codes,
      'rules-v1' AS rules_version, {AS_OF} AS decision_time, captured AS kafka_timestamp FROM dec""",
    "dec",
)
oracle("action_counts", "SELECT action, count(*) AS count FROM dec GROUP BY action", "dec")
oracle(
    "reason_counts",
    """SELECT reason, count(*) AS count FROM (
      SELECT unnest(string_split(reason_codes, ',')) AS reason FROM dec WHERE reason_codes <> '')
    GROUP BY reason""",
    "dec",
)
oracle(
    "enriched_payments",
    """SELECT CAST(k AS VARCHAR) AS transaction_id, strftime(event_time, '%Y-%m-%d') AS metric_date,
      CAST(amount AS DOUBLE) AS amount, risk_score, action, reason_codes,
      CASE WHEN disputed THEN 'cb-' || k END AS confirmed_chargeback_id,
      CASE WHEN disputed THEN 'FRAUD' END AS chargeback_reason,
      CASE WHEN disputed THEN event_time + INTERVAL 30 DAY END AS reported_at FROM dec""",
    "dec",
)
oracle(
    "daily_business_kpis",
    f"""SELECT strftime(event_time, '%Y-%m-%d') AS metric_date, currency, count(*) AS payment_count,
      count(DISTINCT cust) AS unique_customers, count(DISTINCT supp) AS active_sellers,
      CAST(sum(amount) AS DOUBLE) AS gross_payment_value,
      {half_up('sum(amount) * 100', 'count(*)')} AS average_payment_value,
      {many('disputed')} AS chargeback_count, {worth('disputed')} AS chargeback_amount,
      {pct(many('disputed'), 'count(*)')} AS chargeback_rate_pct, {AS_OF} AS refreshed_at
    FROM dec GROUP BY 1, 2""",
    "dec",
)
FLAGGED = "action IN ('REVIEW', 'DECLINE')"
oracle(
    "daily_fraud_kpis",
    f"""SELECT strftime(event_time, '%Y-%m-%d') AS metric_date, 'rules-v1' AS rules_version,
      count(*) AS total_decisions, {many("action = 'APPROVE'")} AS approved_count,
      {many("action = 'REVIEW'")} AS review_count, {many("action = 'DECLINE'")} AS declined_count,
      {mean_score()} AS average_risk_score,
      {worth("action = 'REVIEW'")} AS review_amount, {worth("action = 'DECLINE'")} AS declined_amount,
      {many('disputed')} AS confirmed_fraud_count, {worth('disputed')} AS confirmed_fraud_amount,
      {pct(many(FLAGGED), 'count(*)')} AS flagged_rate_pct,
      {pct(many('disputed'), 'count(*)')} AS confirmed_fraud_rate_pct, {AS_OF} AS refreshed_at
    FROM dec GROUP BY 1""",
    "dec",
)
part(
    "sellers",
    f"""SELECT supp, count(*) AS transaction_count, count(DISTINCT cust) AS unique_customers,
      CAST(sum(amount) AS DOUBLE) AS gross_payment_value, {mean_score()} AS average_risk_score,
      {many("action = 'REVIEW'")} AS review_count, {many("action = 'DECLINE'")} AS declined_count,
      {many('disputed')} AS confirmed_chargeback_count, max(event_time) AS latest_payment_at,
      {pct(many(FLAGGED), 'count(*)')} AS flagged_rate_pct,
      {pct(many('disputed'), 'count(*)')} AS chargeback_rate_pct
    FROM dec GROUP BY supp""",
    "dec",
)
oracle(
    "seller_performance",
    f"SELECT CAST(supp AS VARCHAR) AS seller_id, * EXCLUDE (supp), {AS_OF} AS refreshed_at FROM sellers",
    "sellers",
)
part(
    "people",
    f"""SELECT c_custkey AS cust, r_name AS home_region, order_count, lifetime_order_value,
      latest_order_at, account_created_at, average_order_amount
    FROM customer JOIN nat ON n_nationkey = c_nationkey
    LEFT JOIN (SELECT o_custkey, count(*) AS order_count,
        sum(CAST(o_totalprice AS DECIMAL(12,2))) AS lifetime_order_value,
        max(o_orderdate) AS latest_order_at, min(o_orderdate) - INTERVAL 30 DAY AS account_created_at,
        {half_up('sum(CAST(o_totalprice AS DECIMAL(12,2))) * 100', 'count(*)')} AS average_order_amount
      FROM orders GROUP BY 1) ON o_custkey = c_custkey""",
    "nat",
)
part(
    "c360",
    f"""SELECT cust, home_region, account_created_at, average_order_amount,
      coalesce(order_count, 0) AS order_count,
      CAST(coalesce(lifetime_order_value, 0) AS DOUBLE) AS lifetime_order_value, latest_order_at,
      coalesce(payment_count, 0) AS payment_count,
      CAST(coalesce(lifetime_payment_value, 0) AS DOUBLE) AS lifetime_payment_value, latest_payment_at,
      coalesce(mean_risk, 0) AS average_risk_score,
      coalesce(review_count, 0) AS review_count, coalesce(declined_count, 0) AS declined_count,
      coalesce(cb, 0) AS confirmed_chargeback_count,
      CASE WHEN cb > 0 OR declined_count > 0 THEN 'HIGH'
        WHEN review_count > 0 OR mean_risk >= 20 THEN 'MEDIUM' ELSE 'LOW' END AS customer_risk_segment
    FROM people LEFT JOIN (SELECT cust, count(*) AS payment_count, sum(amount) AS lifetime_payment_value,
        max(event_time) AS latest_payment_at, {mean_score()} AS mean_risk,
        {many("action = 'REVIEW'")} AS review_count, {many("action = 'DECLINE'")} AS declined_count,
        {many('disputed')} AS cb FROM dec GROUP BY cust) p USING (cust)""",
    "people", "dec",
)
oracle(
    "customer_360",
    f"SELECT CAST(cust AS VARCHAR) AS customer_id, * EXCLUDE (cust), {AS_OF} AS refreshed_at FROM c360",
    "c360",
)

# ---- change stream -----------------------------------------------------------------

# One row per customer record: key, op, lsn, place in the log, amount (NULL if not a number).
part(
    "cust_log",
    """SELECT CAST(c_custkey AS VARCHAR) AS key, 'r' AS op, CAST(1 AS BIGINT) AS lsn, c_custkey % 6 AS part,
      c_custkey AS off, TIMESTAMP '2024-01-01' AS ts, CAST(greatest(c_acctbal, 0) AS DECIMAL(12,2)) AS amt,
      c_custkey AS person, false AS gone FROM customer
    UNION ALL
    SELECT CASE WHEN event_id % 101 <> 0 THEN CAST(user_id AS VARCHAR) END,
      CASE WHEN event_id % 97 = 0 THEN 'x' WHEN event_type = 'signup' THEN 'c'
        WHEN event_type = 'error' THEN 'd' ELSE 'u' END,
      1000000 + event_id // 3, user_id % 6, 1000000 + event_id, ts,
      CASE WHEN event_id % 107 = 0 THEN -1 WHEN event_id % 109 = 0 THEN NULL
        ELSE CAST(value AS DECIMAL(12,2)) END,
      user_id, event_id % 103 = 0 FROM events""",
)
part(
    "cust_rows",
    """SELECT CASE WHEN gone THEN NULL ELSE key END AS customer_id,
      CASE WHEN NOT gone THEN 'R' || person % 5 END AS home_region,
      CASE WHEN NOT gone THEN TIMESTAMP '2023-01-01' + to_days(CAST(person % 300 AS INT)) END AS account_created_at,
      CASE WHEN NOT gone THEN CAST(amt AS DOUBLE) END AS average_order_amount,
      CASE WHEN NOT gone THEN 'dev-' || person END AS trusted_device_id,
      CASE WHEN NOT gone THEN ts END AS updated_at,
      CASE WHEN NOT gone THEN op END AS _cdc_operation, CASE WHEN NOT gone THEN lsn END AS _source_lsn,
      CAST(part AS INT) AS _kafka_partition, off AS _kafka_offset, ts AS _kafka_timestamp FROM cust_log""",
    "cust_log",
)
oracle("cdc_parse_customers", "SELECT * FROM cust_rows", "cust_rows")
UPS = "coalesce(_cdc_operation IN ('c', 'u', 'r'), false)"
part(
    "cust_codes",
    f"""SELECT *, concat_ws(',', CASE WHEN customer_id IS NULL THEN 'MISSING_PRIMARY_KEY' END,
      CASE WHEN _cdc_operation IS NULL OR _cdc_operation = 'x' THEN 'INVALID_CDC_OPERATION' END,
      CASE WHEN {UPS} AND customer_id IS NULL THEN 'MISSING_CUSTOMER_ID' END,
      CASE WHEN {UPS} AND average_order_amount IS NULL THEN 'MISSING_AVERAGE_ORDER_AMOUNT' END,
      CASE WHEN {UPS} AND average_order_amount < 0 THEN 'NEGATIVE_AVERAGE_ORDER_AMOUNT' END) AS error_codes
    FROM cust_rows""",
    "cust_rows",
)
oracle("cdc_quality_customers", "SELECT _kafka_partition, _kafka_offset, error_codes FROM cust_codes", "cust_codes")
part(
    "order_codes",
    """SELECT o_orderkey AS k, TIMESTAMP '2024-02-01' + to_seconds(o_orderkey) AS ts, concat_ws(',',
      CASE WHEN o_orderkey % 227 = 0 THEN 'EMPTY_SHIPPING_REGION' END,
      CASE WHEN o_orderkey % 211 = 0 THEN 'NEGATIVE_ORDER_AMOUNT' END,
      CASE WHEN o_orderkey % 223 = 0 THEN 'INVALID_ORDER_STATUS' END) AS error_codes FROM orders""",
)
part(
    "payment_codes",
    """SELECT k, captured AS ts, concat_ws(',', CASE WHEN k % 263 = 0 THEN 'EMPTY_CURRENCY' END,
      CASE WHEN k % 229 = 0 THEN 'NON_POSITIVE_PAYMENT_AMOUNT' END,
      CASE WHEN k % 233 = 0 THEN 'NEGATIVE_ACCOUNT_AGE' END,
      CASE WHEN k % 239 = 0 THEN 'NEGATIVE_LOGIN_FAILURES' END,
      CASE WHEN k % 241 = 0 THEN 'INVALID_ATTEMPT_NUMBER' END,
      CASE WHEN k % 251 = 0 THEN 'NEGATIVE_CUSTOMER_AVERAGE' END,
      CASE WHEN k % 257 = 0 THEN 'INVALID_PAYMENT_STATUS' END) AS error_codes FROM pay""",
    "pay",
)
part(
    "chargeback_codes",
    """SELECT k, captured AS ts,
      CASE WHEN k % 13 = 0 THEN 'EMPTY_REASON' ELSE '' END AS error_codes FROM pay WHERE disputed""",
    "pay",
)
for _entity in ("order", "payment", "chargeback"):
    oracle(
        f"cdc_quality_{_entity}s",
        f"""SELECT CAST(k % 6 AS INT) AS _kafka_partition, k AS _kafka_offset, error_codes
        FROM {_entity}_codes""",
        f"{_entity}_codes",
    )
oracle(
    "cdc_parse_payments",
    """SELECT CAST(k AS VARCHAR) AS transaction_id, 'evt-' || k AS event_id, CAST(k AS VARCHAR) AS order_id,
      CAST(cust AS VARCHAR) AS customer_id, CAST(supp AS VARCHAR) AS seller_id, event_time,
      CASE WHEN k % 229 = 0 THEN 0 ELSE CAST(amount AS DOUBLE) END AS amount,
      CASE WHEN k % 263 = 0 THEN '' ELSE currency END AS currency, 'CARD' AS payment_type,
      'dev-' || cust AS device_id, is_new_device, ip_region, home_region, shipping_region,
      CAST(CASE WHEN k % 233 = 0 THEN -1 ELSE account_age_days END AS INT) AS account_age_days,
      CAST(CASE WHEN k % 239 = 0 THEN -2 ELSE login_failures END AS INT) AS login_failures,
      CAST(CASE WHEN k % 241 = 0 THEN 0 ELSE attempt_number END AS INT) AS attempt_number,
      CASE WHEN k % 251 = 0 THEN -1 ELSE CAST(customer_average_amount AS DOUBLE) END AS customer_average_amount,
      CASE WHEN k % 257 = 0 THEN 'LOST' ELSE 'AUTHORIZED' END AS status, event_time AS created_at,
      'c' AS _cdc_operation, 3000000 + k AS _source_lsn, CAST(k % 6 AS INT) AS _kafka_partition,
      k AS _kafka_offset, captured AS _kafka_timestamp FROM pay""",
    "pay",
)
part(
    "cust_newest",
    """SELECT * EXCLUDE (error_codes) FROM cust_codes WHERE error_codes = ''
    QUALIFY row_number() OVER (PARTITION BY customer_id
      ORDER BY _source_lsn DESC, _kafka_timestamp DESC, _kafka_offset DESC) = 1""",
    "cust_codes",
)
oracle("cdc_latest_per_key", "SELECT * FROM cust_newest", "cust_newest")
oracle("cdc_current_state", "SELECT * FROM cust_newest WHERE _cdc_operation <> 'd'", "cust_newest")
part(
    "cust_intervals",
    """SELECT * EXCLUDE (error_codes, valid_to), valid_to, valid_to IS NULL AS is_current FROM (
      SELECT *, _source_lsn AS valid_from, lead(_source_lsn) OVER (PARTITION BY customer_id ORDER BY _source_lsn) AS valid_to
      FROM (SELECT * FROM cust_codes WHERE error_codes = ''
        QUALIFY row_number() OVER (PARTITION BY customer_id, _source_lsn
          ORDER BY _kafka_timestamp DESC, _kafka_offset DESC) = 1))
    WHERE _cdc_operation <> 'd'""",
    "cust_codes",
)
oracle("customer_history", "SELECT * FROM cust_intervals", "cust_intervals")
oracle(
    "customers_as_of",
    """SELECT * EXCLUDE (error_codes) FROM (SELECT * FROM cust_codes WHERE error_codes = '' AND _source_lsn <= 1001000
      QUALIFY row_number() OVER (PARTITION BY customer_id
        ORDER BY _source_lsn DESC, _kafka_timestamp DESC, _kafka_offset DESC) = 1) WHERE _cdc_operation <> 'd'""",
    "cust_codes",
)
_moments = [(f"{m}m", f"RANGE BETWEEN INTERVAL {m} MINUTE PRECEDING AND CURRENT ROW") for m in (1, 5, 30)]
oracle(
    "customer_velocity",
    "SELECT event_id, "
    + ", ".join(
        f"""count(*) OVER (PARTITION BY user_id ORDER BY ts {frame}) AS count_{name},
      CAST(coalesce(sum(CAST(value AS DECIMAL(12,2))) OVER (PARTITION BY user_id ORDER BY ts {frame}), 0) AS DOUBLE) AS amount_{name}"""
        for name, frame in _moments
    )
    + " FROM events",
)
oracle(
    "cdc_merge_actions",
    """SELECT CASE WHEN _source_lsn = 1 THEN 'keep' WHEN _cdc_operation = 'd' THEN 'delete' ELSE 'update' END
      AS action, count(*) AS count FROM cust_newest GROUP BY 1""",
    "cust_newest",
)
# Orders, payments and chargebacks: clean inserts, and the later change of every row.
part(
    "order_history",
    """SELECT k, o_custkey AS cust, status, amount, o_orderdate AS placed, 'c' AS op, 2000000 + k AS lsn, k AS off, ts
      FROM order_base WHERE error_codes = ''
    UNION ALL SELECT k, o_custkey, CASE status WHEN 'FAILED' THEN 'CANCELLED' WHEN 'CREATED' THEN 'DELIVERED' ELSE status END,
      amount, o_orderdate, CASE status WHEN 'PAID' THEN 'd' ELSE 'u' END,
      CASE status WHEN 'CREATED' THEN 1999999 ELSE 6000000 END + k, 10000000 + k, ts + INTERVAL 1 DAY FROM order_base""",
    "order_base",
)
part(
    "order_base",
    """SELECT o.*, o_orderkey AS k, CAST(o_totalprice AS DECIMAL(12,2)) AS amount, ts, error_codes,
      CASE o_orderstatus WHEN 'F' THEN 'FAILED' WHEN 'O' THEN 'CREATED' ELSE 'PAID' END AS status
    FROM orders o JOIN order_codes c ON c.k = o_orderkey""",
    "order_codes",
)
part(
    "payment_history",
    """SELECT pay.*, 'AUTHORIZED' AS status, 'c' AS op, 3000000 + k AS lsn, k AS off, captured AS ts
      FROM pay JOIN payment_codes USING (k) WHERE error_codes = ''
    UNION ALL SELECT pay.*, CASE home_region WHEN 'ASIA' THEN 'DECLINED' ELSE 'PENDING' END,
      CASE home_region WHEN 'AFRICA' THEN 'd' ELSE 'u' END,
      CASE WHEN home_region IN ('ASIA', 'AFRICA') THEN 9000000 ELSE 2999999 END + k, 10000000 + k,
      captured + INTERVAL 1 DAY FROM pay""",
    "pay", "payment_codes",
)
part(
    "chargeback_history",
    """SELECT k, event_time, 'FRAUD' AS reason, 'c' AS op, 4000000 + k AS lsn, k AS off, captured AS ts
      FROM pay JOIN chargeback_codes USING (k) WHERE error_codes = ''
    UNION ALL SELECT k, event_time, CASE weekday WHEN 1 THEN 'STOLEN_CARD' ELSE 'UNKNOWN' END,
      CASE weekday WHEN 0 THEN 'd' ELSE 'u' END,
      CASE WHEN weekday < 2 THEN 12000000 ELSE 3999999 END + k, 10000000 + k, captured + INTERVAL 1 DAY
      FROM (SELECT *, dayofweek(event_time + INTERVAL 30 DAY) AS weekday FROM pay WHERE disputed)""",
    "pay", "chargeback_codes",
)
_lineage = """op AS _cdc_operation, lsn AS _source_lsn, CAST(k % 6 AS INT) AS _kafka_partition,
      off AS _kafka_offset, ts AS _kafka_timestamp"""
_HISTORY = {
    "orders": f"""SELECT CAST(k AS VARCHAR) AS order_id, CAST(cust AS VARCHAR) AS customer_id, status,
      CAST(amount AS DOUBLE) AS total_amount, 'UNKNOWN' AS shipping_region, placed AS created_at, placed AS updated_at,
      {_lineage} FROM order_history""",
    "payments": f"""SELECT CAST(k AS VARCHAR) AS transaction_id, 'evt-' || k AS event_id, CAST(k AS VARCHAR) AS order_id,
      CAST(cust AS VARCHAR) AS customer_id, CAST(supp AS VARCHAR) AS seller_id, event_time,
      CAST(amount AS DOUBLE) AS amount, currency, 'CARD' AS payment_type, 'dev-' || cust AS device_id, is_new_device,
      ip_region, home_region, shipping_region, CAST(account_age_days AS INT) AS account_age_days,
      CAST(login_failures AS INT) AS login_failures, CAST(attempt_number AS INT) AS attempt_number,
      CAST(customer_average_amount AS DOUBLE) AS customer_average_amount, status, event_time AS created_at,
      {_lineage} FROM payment_history""",
    "chargebacks": f"""SELECT 'cb-' || k AS chargeback_id, CAST(k AS VARCHAR) AS transaction_id,
      event_time + INTERVAL 30 DAY AS reported_at, reason, event_time + INTERVAL 30 DAY AS created_at,
      {_lineage} FROM chargeback_history""",
}
for _entity, _rows in _HISTORY.items():
    _newest = f"{_rows} QUALIFY row_number() OVER (PARTITION BY k ORDER BY lsn DESC) = 1"
    oracle(f"cdc_latest_{_entity}", _newest, f"{_entity[:-1]}_history")
    oracle(f"cdc_state_{_entity}", f"SELECT * FROM ({_newest}) WHERE _cdc_operation <> 'd'", f"{_entity[:-1]}_history")
part(
    "log",
    """SELECT 'customers' AS entity, CAST(part AS INT) AS part, off, ts, key,
      NOT gone AS has_payload FROM cust_log
    UNION ALL SELECT 'orders', o_orderkey % 6, o_orderkey, TIMESTAMP '2024-02-01' + to_seconds(o_orderkey),
      CAST(o_orderkey AS VARCHAR), true FROM orders
    UNION ALL SELECT 'payments', k % 6, k, captured, CAST(k AS VARCHAR), true FROM pay
    UNION ALL SELECT 'chargebacks', k % 6, k, captured, CAST(k AS VARCHAR), true
      FROM pay WHERE disputed""",
    "cust_log", "pay",
)
oracle(
    "bronze_lineage",
    """SELECT 'commerce.commerce.' || entity AS topic, part AS partition, off AS offset, ts AS kafka_timestamp,
      key AS message_key, strftime(ts, '%Y-%m-%d') AS ingest_date, has_payload FROM log""",
    "log",
)
oracle("topic_counts", "SELECT 'commerce.commerce.' || entity AS topic, count(*) AS count FROM log GROUP BY entity", "log")
part(
    "bad",
    """SELECT 'customers' AS entity, _kafka_partition AS part, _kafka_offset AS off, _kafka_timestamp AS ts, error_codes
      FROM cust_codes WHERE error_codes <> ''
    UNION ALL SELECT 'orders', k % 6, k, ts, error_codes FROM order_codes WHERE error_codes <> ''
    UNION ALL SELECT 'payments', k % 6, k, ts, error_codes FROM payment_codes WHERE error_codes <> ''
    UNION ALL SELECT 'chargebacks', k % 6, k, ts, error_codes FROM chargeback_codes WHERE error_codes <> ''""",
    "cust_codes", "order_codes", "payment_codes", "chargeback_codes",
)
oracle(
    "cdc_quarantine",
    """SELECT sha256('commerce.commerce.' || entity || '|' || part || '|' || off) AS quarantine_id,
      'commerce.commerce.' || entity AS topic, CAST(part AS INT) AS kafka_partition, off AS kafka_offset,
      ts AS kafka_timestamp, error_codes FROM bad""",
    "bad",
)

# ---- serving over gold ----------------------------------------------------------------

oracle(
    "seller_watchlist",
    """SELECT row_number() OVER (ORDER BY confirmed_chargeback_count DESC, flagged_rate_pct DESC,
        gross_payment_value DESC, CAST(supp AS VARCHAR)) AS seller_rank,
      * EXCLUDE (supp, latest_payment_at) FROM sellers QUALIFY seller_rank <= 8""",
    "sellers",
)
oracle("customer_segments", "SELECT customer_risk_segment, count(*) AS count FROM c360 GROUP BY 1", "c360")
oracle(
    "segment_share",
    f"""SELECT s AS customer_risk_segment, count(cust) AS count,
      {pct('count(cust)', '(SELECT count(*) FROM c360)')} AS share_pct
    FROM (VALUES ('LOW'), ('MEDIUM'), ('HIGH')) v(s) LEFT JOIN c360 ON customer_risk_segment = s GROUP BY s""",
    "c360",
)
part(
    "fraud_days",
    f"SELECT event_time::DATE AS day, count(*) AS n, {mean_score()} AS score FROM dec GROUP BY 1",
    "dec",
)
oracle(
    "headline_kpis",
    f"""SELECT count(*) AS payment_count, CAST(sum(amount) AS DOUBLE) AS gross_payment_value,
      {many('disputed')} AS chargeback_count, count(DISTINCT currency) AS currencies,
      count(*) AS total_decisions, {many("action = 'APPROVE'")} AS approved_count,
      {many("action = 'REVIEW'")} AS review_count, {many("action = 'DECLINE'")} AS declined_count,
      {worth("action = 'REVIEW'")} AS review_amount, {worth("action = 'DECLINE'")} AS declined_amount,
      {worth('disputed')} AS confirmed_fraud_amount,
      (SELECT round(sum(score * n) / sum(n), 2) FROM fraud_days) AS average_risk_score,
      (SELECT count(*) FROM customer) AS current_customers, count(DISTINCT supp) AS active_sellers,
      {pct(many(FLAGGED), 'count(*)')} AS flagged_rate_pct,
      {pct(many('disputed'), 'count(*)')} AS chargeback_rate_pct FROM dec""",
    "dec", "fraud_days",
)
oracle(
    "currency_totals",
    f"""SELECT currency, count(*) AS payment_count, CAST(sum(amount) AS DOUBLE) AS gross_payment_value,
      {many('disputed')} AS chargeback_count, {worth('disputed')} AS chargeback_amount FROM dec GROUP BY 1""",
    "dec",
)
for _extract, _table in (("extract_business_kpis", "daily_business_kpis"), ("extract_fraud_kpis", "daily_fraud_kpis")):
    ORACLES[_extract] = f"SELECT * EXCLUDE (refreshed_at) FROM ({ORACLES[_table]})"
oracle(
    "source_row_counts",
    """SELECT 'customers' AS table_name, count(*) AS row_count FROM customer
    UNION ALL SELECT 'orders', count(*) FROM orders
    UNION ALL SELECT 'payments', count(*) FROM pay UNION ALL SELECT 'decisions', count(*) FROM pay
    UNION ALL SELECT 'chargebacks', count(*) FROM pay WHERE disputed""",
    "pay",
)

# ---- marketplace -------------------------------------------------------------------------

part(
    "mc",
    """SELECT c_custkey AS cust, c_custkey // 2 AS person, CAST(c_custkey % 200 AS INT) AS zip,
      lower(c_mktsegment) AS city, n_name AS state, lower(n_name) || ' ' AS raw_state, CAST(c_acctbal AS DECIMAL(12,2)) AS lat
    FROM customer JOIN nation ON n_nationkey = c_nationkey""",
)
part(
    "mo",
    """SELECT o_orderkey AS k, o_custkey AS cust,
      CASE o_orderstatus WHEN 'F' THEN 'canceled' WHEN 'O' THEN 'shipped' ELSE 'delivered' END AS status,
      o_orderdate AS bought,
      CASE WHEN o_orderkey % 13 <> 0 THEN o_orderdate + INTERVAL 5 HOUR END AS approved,
      CASE WHEN o_orderstatus <> 'F' THEN o_orderdate + INTERVAL 2 DAY END AS carried,
      CASE WHEN o_orderstatus = 'P' THEN o_orderdate + to_hours(24 * (o_orderkey % 20) + o_orderkey % 24) END AS delivered,
      o_orderdate + INTERVAL 12 DAY AS estimated FROM orders""",
)
part(
    "lines",
    """SELECT *, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
      row_number() OVER (PARTITION BY l_orderkey
        ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS place FROM lineitem""",
)
part(
    "mi",
    """SELECT l_orderkey AS k, place, l_partkey AS prod, l_suppkey AS supp, l_shipdate AS ship, price,
      CAST(price * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(12,2)) AS freight FROM lines""",
    "lines",
)
part(
    "mp",
    """SELECT l_orderkey AS k, place AS seq,
      CASE l_linenumber % 4 WHEN 0 THEN 'CREDIT_CARD' WHEN 1 THEN 'BOLETO' WHEN 2 THEN 'DEBIT CARD' ELSE '' END AS kind,
      CAST(l_quantity AS INT) % 13 AS inst,
      CASE WHEN l_orderkey % 50 = 0 THEN price * 20 ELSE price END AS value FROM lines""",
    "lines",
)
part(
    "mr",
    """SELECT o_orderkey AS k, CAST(o_orderkey % 5 + 1 AS INT) AS score, o_orderdate AS written
    FROM orders WHERE o_orderkey % 3 <> 0""",
)
oracle(
    "dim_customers",
    """SELECT CAST(cust AS VARCHAR) AS customer_id, CAST(person AS VARCHAR) AS customer_unique_id,
      zip AS zip_code_prefix, city, state FROM mc""",
    "mc",
)
oracle(
    "dim_sellers",
    """SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, CAST(s_suppkey % 200 AS INT) AS zip_code_prefix,
      'city ' || s_suppkey % 40 AS city, n_name AS state FROM supplier JOIN nation ON n_nationkey = s_nationkey""",
)
oracle(
    "dim_products",
    """SELECT CAST(p_partkey AS VARCHAR) AS product_id,
      CASE WHEN p_partkey % 50 = 0 THEN 'unknown' WHEN p_type = 'ECONOMY' THEN p_type
        ELSE lower(p_type) || '_en' END AS category,
      CAST(length(p_name) AS INT) AS name_length, p_size * 10 AS description_length,
      CASE WHEN p_partkey % 31 <> 0 THEN p_size % 5 END AS photo_count, CAST(p_size * 100 AS DOUBLE) AS weight_g,
      CAST(p_size + 5 AS DOUBLE) AS length_cm, CAST(p_size + 2 AS DOUBLE) AS height_cm,
      CAST(p_size + 1 AS DOUBLE) AS width_cm FROM part""",
)
part(
    "geo",
    """SELECT zip AS zip_code_prefix, city, state, round(CAST(sum(lat) AS DOUBLE) / count(*), 4) AS latitude,
      round(-CAST(sum(lat) AS DOUBLE) / count(*), 4) AS longitude, count(*) AS point_count FROM mc GROUP BY 1, 2, 3""",
    "mc",
)
oracle("geolocation_candidates", "SELECT * FROM geo", "geo")
oracle(
    "dim_geolocation_zip",
    """SELECT * FROM geo QUALIFY row_number() OVER (
      PARTITION BY zip_code_prefix ORDER BY point_count DESC, state, city) = 1""",
    "geo",
)
oracle(
    "fact_orders",
    """SELECT CAST(k AS VARCHAR) AS order_id, CAST(cust AS VARCHAR) AS customer_id, status AS order_status,
      bought AS purchased_at, approved AS approved_at, carried AS carrier_received_at,
      delivered AS delivered_at, estimated AS estimated_delivery_at FROM mo""",
    "mo",
)
oracle(
    "fact_order_items",
    """SELECT CAST(k AS VARCHAR) AS order_id, CAST(place AS INT) AS order_item_id, CAST(prod AS VARCHAR) AS product_id,
      CAST(supp AS VARCHAR) AS seller_id, ship AS shipping_limit_at, CAST(price AS DOUBLE) AS item_value_brl,
      CAST(freight AS DOUBLE) AS freight_value_brl FROM mi""",
    "mi",
)
oracle(
    "fact_payments",
    """SELECT CAST(k AS VARCHAR) AS order_id, CAST(seq AS INT) AS payment_sequence, kind AS payment_type,
      inst AS installments, CAST(value AS DOUBLE) AS payment_value_brl FROM mp""",
    "mp",
)
oracle(
    "fact_reviews",
    """SELECT 'rv-' || k AS review_id, CAST(k AS VARCHAR) AS order_id, score AS review_score,
      CASE WHEN k % 4 <> 0 THEN 'title ' || k END AS review_title,
      'said "fine", then' || chr(10) || 'left ' || k % 9 AS review_message,
      written AS review_created_at, written + INTERVAL 1 DAY AS review_answered_at FROM mr""",
    "mr",
)
oracle(
    "market_layer_row_counts",
    """SELECT 'dim_customers' AS table_name, count(*) AS row_count FROM customer
    UNION ALL SELECT 'dim_sellers', count(*) FROM supplier UNION ALL SELECT 'dim_products', count(*) FROM part
    UNION ALL SELECT 'dim_geolocation_zip', count(DISTINCT zip) FROM mc
    UNION ALL SELECT 'fact_orders', count(*) FROM orders UNION ALL SELECT 'fact_order_items', count(*) FROM lineitem
    UNION ALL SELECT 'fact_payments', count(*) FROM lineitem UNION ALL SELECT 'fact_reviews', count(*) FROM mr""",
    "mc", "mr",
)
part("paid", "SELECT k, sum(value) AS total FROM mp GROUP BY k", "mp")
oracle("order_payment_totals", "SELECT CAST(k AS VARCHAR) AS order_id, CAST(total AS DOUBLE) AS revenue_brl FROM paid", "paid")
part(
    "valued",
    "SELECT mo.*, person, state, coalesce(total, 0) AS total FROM mo JOIN mc USING (cust) LEFT JOIN paid USING (k)",
    "mo", "mc", "paid",
)
part(
    "commerce",
    f"""SELECT strftime(bought, '%Y-%m-%d') AS order_date, count(*) AS order_count,
      count(DISTINCT person) AS unique_customers, CAST(sum(total) AS DOUBLE) AS revenue_brl,
      {half_up('sum(total) * 100', 'count(*)')} AS average_order_value_brl,
      {many("status = 'delivered'")} AS delivered_orders, {many("status = 'canceled'")} AS failed_orders
    FROM valued GROUP BY 1""",
    "valued",
)
oracle("daily_commerce_kpis", "SELECT * FROM commerce", "commerce")
oracle(
    "daily_series",
    "SELECT order_date, order_count, revenue_brl, average_order_value_brl FROM commerce",
    "commerce",
)
oracle(
    "market_global_kpis",
    f"""SELECT count(*) AS orders, count(DISTINCT person) AS unique_customers, CAST(sum(total) AS DOUBLE) AS revenue_brl,
      {half_up('sum(total) * 100', 'count(*)')} AS average_order_value_brl,
      {pct(many("status = 'delivered'"), 'count(*)')} AS delivered_pct FROM valued""",
    "valued",
)
part(
    "delivery",
    """SELECT state AS customer_state, count(*) AS delivered_orders,
      round(CAST(sum(date_sub('hour', bought, delivered)) AS DOUBLE) / count(*) / 24, 2) AS average_delivery_days,
      round(100.0::DOUBLE * count(*) FILTER (WHERE delivered <= estimated) / count(*), 2) AS on_time_delivery_pct
    FROM valued WHERE status = 'delivered' GROUP BY state""",
    "valued",
)
oracle("delivery_performance", "SELECT * FROM delivery", "delivery")
oracle("delivery_table", "SELECT * FROM delivery", "delivery")
part(
    "msell",
    """SELECT s_suppkey AS supp, 'city ' || s_suppkey % 40 AS city, n_name AS state, orders,
      merchandise_value_brl, freight_value_brl, average_review_score
    FROM supplier JOIN nation ON n_nationkey = s_nationkey
    JOIN (SELECT supp, count(DISTINCT k) AS orders, CAST(sum(price) AS DOUBLE) AS merchandise_value_brl,
        CAST(sum(freight) AS DOUBLE) AS freight_value_brl FROM mi GROUP BY supp) m ON m.supp = s_suppkey
    LEFT JOIN (SELECT supp, CAST((200 * sum(score) + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS average_review_score
      FROM (SELECT DISTINCT k, supp FROM mi) JOIN mr USING (k) GROUP BY supp) r ON r.supp = s_suppkey""",
    "mi", "mr",
)
oracle("market_seller_performance", "SELECT CAST(supp AS VARCHAR) AS seller_id, * EXCLUDE (supp) FROM msell", "msell")
oracle(
    "top_sellers",
    """SELECT state, city, orders, merchandise_value_brl, average_review_score FROM msell
    ORDER BY merchandise_value_brl DESC, CAST(supp AS VARCHAR) LIMIT 25""",
    "msell",
)
oracle(
    "market_customer_360",
    f"""SELECT CAST(person AS VARCHAR) AS customer_unique_id, max(state) AS state, count(*) AS order_count,
      min(bought) AS first_order_at, max(bought) AS latest_order_at, CAST(sum(total) AS DOUBLE) AS lifetime_value_brl,
      {half_up('sum(total) * 100', 'count(*)')} AS average_order_value_brl,
      {many("status = 'canceled'")} AS failed_orders FROM valued GROUP BY person""",
    "valued",
)
part(
    "sig0",
    """SELECT DISTINCT k, person, bought, status, seq, kind, inst, value, score AS review_score
    FROM mp JOIN mo USING (k) JOIN mc USING (cust) LEFT JOIN mr USING (k)""",
    "mp", "mo", "mc", "mr",
)
part(
    "sig1",
    """SELECT *, (2 * CAST(sum(value) OVER w * 100 AS HUGEINT) * 10000 + count(*) OVER w) // (2 * count(*) OVER w) AS mean6
    FROM sig0 WINDOW w AS (PARTITION BY person)""",
    "sig0",
)
part(
    "sig2",
    """SELECT *, CAST(value * 100 AS HUGEINT) * 10000 > greatest(3 * mean6, 500000000) AS g1, inst >= 10 AS g2, seq > 1 AS g3,
      status = 'canceled' AS g4, coalesce(review_score = 1, false) AS g5 FROM sig1""",
    "sig1",
)
part(
    "sig",
    """SELECT *, 35 * g1::INT + 20 * g2::INT + 10 * g3::INT + 25 * g4::INT + 10 * g5::INT AS risk_score,
      concat_ws(',', CASE WHEN g1 THEN 'AMOUNT_OUTLIER' END, CASE WHEN g2 THEN 'HIGH_INSTALLMENTS' END,
        CASE WHEN g3 THEN 'SPLIT_PAYMENT' END, CASE WHEN g4 THEN 'FAILED_ORDER' END,
        CASE WHEN g5 THEN 'LOW_REVIEW' END) AS reason_codes,
      CASE WHEN risk_score >= 60 THEN 'HIGH' WHEN risk_score >= 30 THEN 'MEDIUM' ELSE 'LOW' END AS risk_band,
      'HEURISTIC_PROXY_NOT_CONFIRMED_FRAUD' AS label_status FROM sig2""",
    "sig2",
)
oracle(
    "payment_risk_signals",
    """SELECT CAST(k AS VARCHAR) AS order_id, CAST(person AS VARCHAR) AS customer_unique_id, bought AS purchased_at,
      status AS order_status, CAST(seq AS INT) AS payment_sequence, kind AS payment_type, inst AS installments,
      CAST(value AS DOUBLE) AS payment_value_brl, CAST(mean6 AS DOUBLE) / 1000000 AS customer_average_brl,
      review_score, risk_score, reason_codes, risk_band, label_status FROM sig""",
    "sig",
)
oracle(
    "risk_band_summary",
    """SELECT risk_band, count(*) AS payments, CAST(sum(value) AS DOUBLE) AS payment_value_brl,
      CAST((200 * CAST(sum(risk_score) AS HUGEINT) + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS average_risk_score
    FROM sig GROUP BY 1""",
    "sig",
)
oracle(
    "top_risky_payments",
    """SELECT CAST(k AS VARCHAR) AS order_id, bought AS purchased_at, kind AS payment_type,
      CAST(value AS DOUBLE) AS payment_value_brl, risk_score, risk_band, reason_codes, label_status FROM sig
    WHERE risk_score >= 30 ORDER BY risk_score DESC, value DESC, CAST(k AS VARCHAR), seq LIMIT 100""",
    "sig",
)

# ---- replay -----------------------------------------------------------------------------


def uuid5(entity: str, key: str) -> str:
    """Version-5 UUID of ``riskmart/replay/<entity>/<key>`` in the URL namespace."""
    return (
        "list_transform([sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || "
        f"encode('riskmart/replay/{entity}/' || {key}))], lambda h: substr(h, 1, 8) || '-' || substr(h, 9, 4) "
        "|| '-5' || substr(h, 14, 3) || '-' || substr('89ab', 1 + ('0x' || substr(h, 17, 1))::INT % 4, 1) "
        "|| substr(h, 18, 3) || '-' || substr(h, 21, 12))[1]"
    )


def half_even(total_cents: str, count: str) -> str:
    """Mean of a total in cents, ties to the even cent, in currency units."""
    t, n = f"CAST({total_cents} AS HUGEINT)", f"CAST({count} AS HUGEINT)"
    return (
        f"(CAST({t} // {n} + CASE WHEN 2 * ({t} % {n}) > {n} OR (2 * ({t} % {n}) = {n} AND ({t} // {n}) % 2 = 1) "
        "THEN 1 ELSE 0 END AS DOUBLE) / 100)"
    )


part("rp", "SELECT * REPLACE (CASE WHEN k % 61 = 0 THEN 0 ELSE value END AS value) FROM mp", "mp")
part("rpaid", "SELECT k, sum(value) AS total FROM rp GROUP BY k", "rp")
part(
    "persons",
    f"""SELECT person, min(bought) - INTERVAL 30 DAY AS opened,
      CASE WHEN count(total) > 0 THEN {half_even('coalesce(sum(total), 0) * 100', 'greatest(count(total), 1)')}
        ELSE 0 END AS average
    FROM mo JOIN mc USING (cust) LEFT JOIN rpaid USING (k) GROUP BY person""",
    "mo", "mc", "rpaid",
)
oracle(
    "replay_customers",
    f"""SELECT {uuid5('customer', 'person')} AS customer_id, raw_state AS home_region, opened AS account_created_at,
      average AS average_order_amount, 'trusted-' || person AS trusted_device_id
    FROM persons JOIN (SELECT person, raw_state FROM mc QUALIFY row_number() OVER (
      PARTITION BY person ORDER BY CAST(cust AS VARCHAR)) = 1) USING (person)""",
    "persons", "mc",
)
oracle(
    "replay_sellers",
    f"""SELECT {uuid5('seller', 's_suppkey')} AS seller_id, lower(n_name) AS seller_region, 'LOW' AS risk_tier
    FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem)""",
)
part("listed", "SELECT prod, supp, sum(price) AS total, count(*) AS n FROM mi GROUP BY 1, 2", "mi")
oracle(
    "replay_listings",
    f"""SELECT {uuid5('listing', "prod || ':' || supp")} AS product_id, {uuid5('seller', 'supp')} AS seller_id,
      CASE WHEN p_partkey % 50 = 0 THEN 'unknown' WHEN p_type = 'ECONOMY' THEN p_type
        ELSE lower(p_type) || '_en' END AS category, {half_even('total * 100', 'n')} AS unit_price
    FROM listed JOIN part ON p_partkey = prod""",
    "listed",
)
oracle(
    "replay_inventory",
    f"""SELECT {uuid5('listing', "prod || ':' || supp")} AS product_id, 1000000 AS available_quantity FROM listed""",
    "listed",
)
STATUS = "CASE status WHEN 'canceled' THEN 'CANCELLED' WHEN 'shipped' THEN 'SHIPPED' ELSE 'DELIVERED' END"
part(
    "rorders",
    f"""SELECT {uuid5('order', 'k')} AS order_id, {uuid5('customer', 'person')} AS customer_id, {STATUS} AS status,
      CAST(coalesce(total, 0) AS DOUBLE) AS total_amount, raw_state AS shipping_region, bought AS created_at, k
    FROM mo JOIN mc USING (cust) LEFT JOIN rpaid USING (k)""",
    "mo", "mc", "rpaid",
)
oracle("replay_orders", "SELECT * EXCLUDE (k) FROM rorders", "rorders")
oracle(
    "replay_order_slice",
    """SELECT * EXCLUDE (k, total_amount) FROM rorders ORDER BY created_at, CAST(k AS VARCHAR) LIMIT 10000""",
    "rorders",
)
oracle(
    "replay_slices",
    """SELECT slice, order_id FROM (SELECT CAST(o_orderkey AS VARCHAR) AS order_id, count(*) OVER () AS n,
        row_number() OVER (ORDER BY o_orderdate, CAST(o_orderkey AS VARCHAR)) AS place FROM orders)
      JOIN (VALUES ('one'), ('half'), ('all')) v(slice)
      ON place <= CASE slice WHEN 'one' THEN 1 WHEN 'half' THEN n // 2 ELSE n END""",
)
oracle(
    "replay_unmapped",
    """SELECT CAST(k AS VARCHAR) AS order_id, 'lost' AS order_status, coalesce(l.n, 0) AS lines,
      coalesce(p.n, 0) AS payments, 0 AS kept
    FROM mo LEFT JOIN (SELECT k, count(*) AS n FROM mi GROUP BY k) l USING (k)
    LEFT JOIN (SELECT k, count(*) AS n FROM rp GROUP BY k) p USING (k) WHERE status = 'delivered'""",
    "mo", "mi", "rp",
)
oracle(
    "replay_order_items",
    f"""SELECT {uuid5('order', 'k')} AS order_id, {uuid5('listing', "prod || ':' || supp")} AS product_id,
      count(*) AS quantity, {half_even('sum(price) * 100', 'count(*)')} AS unit_price FROM mi GROUP BY k, prod, supp""",
    "mi",
)
part(
    "tender",
    """SELECT rp.*, person, raw_state AS region, first.supp AS seller, status,
      coalesce(approved, bought) AS event_time, opened, average
    FROM rp JOIN mo USING (k) JOIN mc USING (cust) JOIN persons USING (person)
    JOIN (SELECT k, supp FROM mi WHERE place = 1) first USING (k)""",
    "rp", "mo", "mc", "persons", "mi",
)
oracle(
    "replay_payments",
    f"""SELECT {uuid5('transaction', "k || ':' || seq")} AS transaction_id,
      {uuid5('payment-event', "k || ':' || seq")} AS event_id, {uuid5('order', 'k')} AS order_id,
      {uuid5('customer', 'person')} AS customer_id, {uuid5('seller', 'seller')} AS seller_id, event_time,
      CAST(value AS DOUBLE) AS amount, 'BRL' AS currency,
      CASE kind WHEN '' THEN 'UNKNOWN' ELSE replace(kind, ' ', '_') END AS payment_type,
      'trusted-' || person AS device_id, false AS is_new_device, region AS ip_region, region AS home_region,
      region AS shipping_region, CAST(date_sub('day', opened, event_time) AS INT) AS account_age_days,
      0 AS login_failures, 1 AS attempt_number, average AS customer_average_amount,
      CASE status WHEN 'canceled' THEN 'DECLINED' ELSE 'AUTHORIZED' END AS status FROM tender WHERE value > 0""",
    "tender",
)
oracle("replay_skipped_payments", "SELECT count(*) AS skipped_payments FROM tender WHERE value <= 0", "tender")
part(
    "levels",
    """SELECT c_custkey, CAST(greatest(c_acctbal, 100) AS DECIMAL(12,2)) AS b FROM customer""",
)
part(
    "baskets",
    """SELECT p_partkey AS p, q, CAST(CAST(p_retailprice AS DECIMAL(12,2)) * q AS DECIMAL(14,2)) AS amount
    FROM part, (VALUES (1), (2), (3)) v(q)""",
)
oracle(
    "basket_match",
    """SELECT CAST(c_custkey AS VARCHAR) AS customer_id, CAST(b AS DOUBLE) AS baseline, n AS in_band_baskets,
      n > 0 AS in_band, best.p AS product_key, CAST(best.q AS INT) AS quantity, CAST(best.a AS DOUBLE) AS amount
    FROM levels JOIN (SELECT b, count(*) FILTER (WHERE 2 * amount >= b AND 2 * amount <= 3 * b) AS n,
        min({'d': abs(amount - b), 'p': p, 'q': q, 'a': amount}) AS best
      FROM (SELECT DISTINCT b FROM levels), baskets GROUP BY b) USING (b)""",
    "levels", "baskets",
)

# ---- gates ------------------------------------------------------------------------------

_ZERO_GATES = (
    "one_decision_per_transaction one_chargeback_per_transaction chargebacks_have_payments "
    "payments_have_decisions decision_ids_unique silver_customers_keys_unique silver_orders_keys_unique "
    "silver_payments_keys_unique silver_chargebacks_keys_unique gold_daily_business_kpis_grain_unique "
    "gold_daily_fraud_kpis_grain_unique gold_seller_performance_grain_unique gold_customer_360_grain_unique"
).split()
_PAYMENT_GATES = (
    "decisions_equal_logged_payments decisions_equal_payments business_total_equals_payments "
    "fraud_total_equals_decisions seller_total_equals_payments customer_total_equals_payments "
    "extract_payments_reconcile extract_decisions_reconcile"
).split()
_gate_rows = [f"('{gate}', CAST(0 AS BIGINT))" for gate in _ZERO_GATES]
_gate_rows += [f"('{gate}', (SELECT count(*) FROM pay))" for gate in _PAYMENT_GATES]
_gate_rows += [
    f"('one_refresh_stamp', epoch_us({AS_OF}))",
    "('confirmed_fraud_equals_chargebacks', (SELECT count(*) FROM pay WHERE disputed))",
    "('one_profile_per_customer', (SELECT count(*) FROM customer))",
    "('extract_customers_reconcile', (SELECT count(*) FROM customer))",
    "('one_row_per_active_seller', (SELECT count(DISTINCT supp) FROM pay))",
]
oracle(
    "gates_summary",
    f"SELECT gate, n AS expected, n AS actual, true AS passed FROM (VALUES {', '.join(_gate_rows)}) v(gate, n)",
    "pay",
)
# ---- the extract as one document, and the summary row ------------------------------------------


def flat(section: str, rows: str, order: str, texts: list[str], numbers: list[str]) -> str:
    """One row per value of a section; ``place`` is that of its row in the order given."""
    cells = [f"{{'field': '{c}', 'number': CAST(NULL AS DOUBLE), 'text': {c}}}" for c in texts]
    cells += [f"{{'field': '{c}', 'number': CAST({c} AS DOUBLE), 'text': CAST(NULL AS VARCHAR)}}" for c in numbers]
    return f"""SELECT '{section}' AS section, place, cell.field, cell.number, cell.text FROM (
      SELECT place, unnest([{", ".join(cells)}]) AS cell FROM (
        SELECT *, CAST(row_number() OVER (ORDER BY {order}) - 1 AS INT) AS place FROM ({rows})))"""


_SOURCE_ROWS = {
    "bronze_records": "log", "quarantine_records": "bad", "source_customers": "customer",
    "source_orders": "orders", "source_payments": "pay", "source_decisions": "pay",
    "source_chargebacks": "(SELECT * FROM pay WHERE disputed)",
}
_GOLD = ("customer_360", "daily_business_kpis", "daily_fraud_kpis", "seller_performance")
_meta = [f"(SELECT count(*) FROM {table}) AS {name}" for name, table in _SOURCE_ROWS.items()]
_document = [
    flat("metadata", f"SELECT '2024-06-01T00:00:00Z' AS refreshed_at, {', '.join(_meta)}", "1", ["refreshed_at"],
         [*_SOURCE_ROWS]),
    flat("daily_business_kpis", ORACLES["daily_business_kpis"], "metric_date, currency", ["metric_date", "currency"],
         ["payment_count", "unique_customers", "active_sellers", "gross_payment_value", "average_payment_value",
          "chargeback_count", "chargeback_amount", "chargeback_rate_pct"]),
    flat("daily_fraud_kpis", ORACLES["daily_fraud_kpis"], "metric_date", ["metric_date", "rules_version"],
         ["total_decisions", "approved_count", "review_count", "declined_count", "average_risk_score",
          "review_amount", "declined_amount", "confirmed_fraud_count", "confirmed_fraud_amount",
          "flagged_rate_pct", "confirmed_fraud_rate_pct"]),
    flat("seller_risk_watchlist", ORACLES["seller_watchlist"], "seller_rank", [],
         ["seller_rank", "transaction_count", "unique_customers", "gross_payment_value", "average_risk_score",
          "review_count", "declined_count", "confirmed_chargeback_count", "flagged_rate_pct", "chargeback_rate_pct"]),
    flat("customer_risk_segments", ORACLES["customer_segments"], "customer_risk_segment",
         ["customer_risk_segment"], ["count"]),
    *(f"""SELECT 'metadata', 0, 'gold_row_counts.{name}', CAST(count(*) AS DOUBLE), NULL FROM ({ORACLES[name]})"""
      for name in _GOLD),
]
oracle("extract_document", " UNION ALL ".join(_document), "log", "bad", "pay")
oracle(
    "extract_document_gates",
    """SELECT gate, n AS expected, n AS actual, true AS passed FROM (VALUES
      ('document_payments_reconcile', (SELECT count(*) FROM pay)),
      ('document_decisions_reconcile', (SELECT count(*) FROM pay)),
      ('document_customers_reconcile', (SELECT count(*) FROM customer)),
      ('document_has_no_identifiers', CAST(0 AS BIGINT)), ('document_has_all_sections', CAST(5 AS BIGINT))) v(gate, n)""",
    "pay",
)


def counted_text(rows: str, key: str) -> str:
    return f"(SELECT string_agg({key} || '=' || n, ',' ORDER BY {key}) FROM ({rows}))"


_silver = {"chargebacks": "(SELECT * FROM pay WHERE disputed)", "customers": "customer", "orders": "orders", "payments": "pay"}
_silver_rows = " UNION ALL ".join(f"SELECT '{n}' AS t, count(*) AS n FROM {t}" for n, t in _silver.items())
_gold_rows = " UNION ALL ".join(f"SELECT '{n}' AS t, count(*) AS n FROM ({ORACLES[n]})" for n in _GOLD)
oracle(
    "pipeline_summary",
    f"""SELECT (SELECT count(*) FROM log) AS bronze_records,
      {counted_text("SELECT 'commerce.commerce.' || entity AS t, count(*) AS n FROM log GROUP BY 1", "t")} AS topic_counts,
      (SELECT count(*) FROM dec) AS fraud_decisions,
      {counted_text("SELECT action AS t, count(*) AS n FROM dec GROUP BY 1", "t")} AS action_counts,
      {counted_text(
          "SELECT t, count(*) AS n FROM (SELECT unnest(string_split(reason_codes, ',')) AS t FROM dec "
          "WHERE reason_codes <> '') GROUP BY 1", "t")} AS reason_counts,
      CAST(0 AS BIGINT) AS duplicate_decision_ids,
      {counted_text(_silver_rows, "t")} AS silver_counts,
      '{",".join(f"{n}=0" for n in sorted(_silver))}' AS silver_duplicate_keys,
      {counted_text(_gold_rows, "t")} AS gold_counts,
      '{",".join(f"{n}=0" for n in sorted(_GOLD))}' AS gold_duplicate_keys,
      {AS_OF} AS gold_refreshed_at, (SELECT count(*) FROM bad) AS quarantine_records""",
    "log", "bad", "dec", "pay",
)
oracle(
    "unmatched_chargebacks",
    """SELECT 'cb-' || o_orderkey AS chargeback_id, CAST(o_orderkey AS VARCHAR) AS transaction_id
    FROM orders WHERE o_orderkey % 11 = 0 AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",
)
oracle(
    "duplicate_keys",
    """SELECT unnest(['lineitem.rows', 'lineitem.keys', 'lineitem.duplicates']) AS measure,
      unnest([CAST(sum(n) AS BIGINT), count(*), count(*) FILTER (WHERE n > 1)]) AS value
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
)

# ---- keyed writes, CSV, streams -------------------------------------------------------------

oracle(
    "insert_absent_orders",
    """SELECT order_id, status, CASE WHEN place <= 10000 THEN 'slice' ELSE 'all' END AS loaded_by
    FROM (SELECT *, row_number() OVER (ORDER BY created_at, CAST(k AS VARCHAR)) AS place FROM rorders)""",
    "rorders",
)
oracle(
    "upsert_customers",
    """SELECT CAST(cust AS VARCHAR) AS customer_id, coalesce(upper(event_type), home_region) AS home_region,
      coalesce(CAST(CAST(value AS DECIMAL(12,2)) AS DOUBLE), average_order_amount) AS average_order_amount
    FROM people FULL JOIN (SELECT user_id AS cust, event_type, value FROM events
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) USING (cust)""",
    "people",
)
oracle(
    "status_mapping",
    """SELECT o_orderkey AS order_key,
      ['PAYMENT_PENDING', 'CANCELLED', 'CREATED', 'DELIVERED', 'PAYMENT_PENDING', 'PAYMENT_PENDING',
        'SHIPPED', 'FAILED', NULL][CAST(o_orderkey % 9 + 1 AS INT)] AS status,
      CASE WHEN o_orderkey % 9 IN (1, 7) THEN 'DECLINED' ELSE 'AUTHORIZED' END AS payment_status FROM orders""",
)
oracle("event_properties", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events")
ORACLES["csv_reviews"] = ORACLES["fact_reviews"]
oracle(
    "csv_row_counts",
    """SELECT 'customers' AS table_name, count(*) AS row_count FROM customer
    UNION ALL SELECT 'geolocation', count(*) FROM customer
    UNION ALL SELECT 'order_items', count(*) FROM lineitem UNION ALL SELECT 'order_payments', count(*) FROM lineitem
    UNION ALL SELECT 'order_reviews', count(*) + count(*) FILTER (WHERE k % 10 = 0) FROM mr
    UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'products', count(*) FROM part
    UNION ALL SELECT 'sellers', count(*) FROM supplier
    UNION ALL SELECT 'product_category_name_translation', count(DISTINCT p_type) FROM part WHERE p_type <> 'ECONOMY'""",
    "mr",
)
part(
    "left_behind",
    """SELECT 'customers' AS table_name, customer_id AS record_key, _source_lsn, _kafka_partition, _kafka_offset
      FROM cust_newest WHERE _cdc_operation <> 'd'
    UNION ALL SELECT 'orders', CAST(k AS VARCHAR), 2000000 + k, CAST(k % 6 AS INT), k FROM order_codes WHERE error_codes = ''
    UNION ALL SELECT 'payments', CAST(k AS VARCHAR), 3000000 + k, CAST(k % 6 AS INT), k FROM payment_codes WHERE error_codes = ''
    UNION ALL SELECT 'chargebacks', 'cb-' || k, 4000000 + k, CAST(k % 6 AS INT), k FROM chargeback_codes WHERE error_codes = ''
    UNION ALL SELECT 'quarantine', sha256('commerce.commerce.' || entity || '|' || part || '|' || off), 0, CAST(part AS INT), off FROM bad
    UNION ALL SELECT 'decisions', sha256(k || '|rules-v1'), 0, 0, 0 FROM pay""",
    "cust_newest", "order_codes", "payment_codes", "chargeback_codes", "bad", "pay",
)
oracle("stream_final_state", "SELECT * FROM left_behind", "left_behind")
# A payment sent again has the same LSN and a later place in its partition, and no fault.
oracle(
    "stream_restarted",
    """SELECT *, 4 AS batches, 2 AS starts FROM left_behind WHERE table_name <> 'payments'
    UNION ALL SELECT 'payments', CAST(k AS VARCHAR), 3000000 + k, CAST(k % 6 AS INT), 20000000 + k, 4, 2 FROM pay""",
    "left_behind", "pay",
)

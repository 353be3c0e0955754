"""The named queries once more, as DuckDB SQL over the given Parquet tables.

``PARTS`` are common table expressions; ``_sql`` puts the ones a query needs,
and whatever they refer to, in front of it.
"""

from __future__ import annotations

import re

from tidemark.functions import fixed_values as fixed
from tidemark.sources.csv_layers import TYPED_TABLES

# Account that owns a user; also used for tickets and live events.
_OWNER = "CASE WHEN user_id % 4 < 2 THEN user_id - user_id % 4 ELSE user_id END"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _simple_case(column: str, values: dict, otherwise: str) -> str:
    return f"CASE {column} {' '.join(f'WHEN {_quoted(key)} THEN {value}' for key, value in values.items())} ELSE {otherwise} END"


def _ladder(column: str, compare: str, bands, floor) -> str:
    """The first band whose bound holds decides."""
    return f"CASE {' '.join(f'WHEN {column} {compare} {bound} THEN {value}' for bound, value in bands)} ELSE {floor} END"


_PRICE = _simple_case("plan", fixed.PLAN_PRICES, "0")
_STATUS = _ladder(
    "points", ">=", [(fixed.HEALTHY_FROM * 100, _quoted(fixed.HEALTHY)), (fixed.WATCH_FROM * 100, _quoted(fixed.WATCH))], _quoted(fixed.AT_RISK)
)
_TIER = _ladder("churn_probability", ">=", [(fixed.HIGH_RISK_FROM, "'High'"), (fixed.MEDIUM_RISK_FROM, "'Medium'")], "'Low'")
_POINTS = " + ".join(f"{name} * {weight}" for name, weight in fixed.HEALTH_WEIGHTS.items())
_FAILED = "failed_invoices * 100 <= total_invoices"
_BILLING = f"""CASE WHEN total_invoices = 0 THEN {fixed.BILLING_CLEAN}
            WHEN failed_invoices > 0 AND {_FAILED} * {fixed.BILLING_RARE_SHARE} THEN {fixed.BILLING_RARE}
            WHEN {_FAILED} * {fixed.BILLING_SOME_SHARE} THEN {fixed.BILLING_SOME} ELSE {fixed.BILLING_FLOOR} END"""


def _pct(part: str, whole: str) -> str:
    """Percent in two decimals, halves up, in whole numbers."""
    return f"CASE WHEN {whole} > 0 THEN CAST(({part} * 20000 + {whole}) // ({whole} * 2) AS DOUBLE) / 100 END"


PARTS = {
    # ---- the mapped tables -------------------------------------------------
    "plans": "SELECT * FROM (VALUES (1, 'Starter', 100), (2, 'Professional', 250), (3, 'Enterprise', 500)) v(plan_id, plan_name, monthly_price)",
    "accounts": """
        SELECT c_custkey AS account_id, c_mktsegment AS industry,
               CASE WHEN c_acctbal < 1000 THEN 'Small' WHEN c_acctbal < 4000 THEN 'Medium'
                    WHEN c_acctbal < 7000 THEN 'Large' ELSE 'Enterprise' END AS size,
               r_name AS region, n_name AS owner
        FROM customer, nation, region
        WHERE c_nationkey = n_nationkey AND n_regionkey = r_regionkey""",
    "app_users": f"""
        SELECT user_id, {_OWNER} AS account_id,
               CASE user_id % 4 WHEN 0 THEN 'User' WHEN 1 THEN 'Analyst' WHEN 2 THEN 'Manager' ELSE 'Admin' END AS role,
               min(ts) FILTER (WHERE event_type = 'signup') AS created_at
        FROM events GROUP BY user_id""",
    "usage_events": """
        SELECT event_id, e.user_id, event_type AS feature, ts AS event_timestamp,
               coalesce(ts >= created_at, FALSE) AS is_valid_event
        FROM events e LEFT JOIN app_users u ON u.user_id = e.user_id
        WHERE event_type IN ('view', 'click', 'purchase')""",
    "subs": """
        SELECT o_orderkey AS subscription_id, o_custkey AS account_id,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'Enterprise' WHEN '2-HIGH' THEN 'Professional'
                    WHEN '3-MEDIUM' THEN 'Professional' ELSE 'Starter' END AS plan,
               o_orderdate AS start_date,
               CASE WHEN o_totalprice < 100000 AND o_orderstatus = 'F' THEN 'Cancelled'
                    WHEN o_totalprice < 100000 AND o_orderstatus = 'P' THEN 'Paused' ELSE 'Active' END AS status
        FROM orders""",
    "invoices": """
        SELECT l_orderkey * 1000000 + l_partkey * 10 + l_linenumber AS invoice_id, o_custkey AS account_id,
               CAST(CASE WHEN l_linenumber > 5 THEN l_extendedprice WHEN l_quantity < 23 THEN 100
                         WHEN l_quantity < 43 THEN 250 ELSE 500 END AS DECIMAL(18,2)) AS amount,
               l_shipdate AS due_date,
               CASE WHEN l_returnflag = 'R' THEN CASE WHEN l_linestatus = 'F' AND l_quantity <= 20 THEN 'Failed' ELSE 'Overdue' END
                    WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'Pending' ELSE 'Paid' END AS status
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
    "tickets": f"""
        SELECT event_id AS ticket_id, {_OWNER} AS account_id,
               CASE WHEN value < 5 THEN 'Low' WHEN value < 30 THEN 'Medium' WHEN value < 70 THEN 'High' ELSE 'Critical' END AS severity,
               ts AS created_at, next_other AS resolved_at,
               (epoch_us(next_other) - epoch_us(ts) + 18000000) // 36000000 AS hundredths
        FROM (SELECT *, min(CASE WHEN event_type <> 'error' THEN ts END) OVER (
                  PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_other
              FROM events)
        WHERE event_type = 'error'""",
    "seed_alerts": """
        SELECT c_custkey AS alert_id, c_custkey AS customer_id,
               CASE c_mktsegment WHEN 'BUILDING' THEN 'Payment Failure' WHEN 'MACHINERY' THEN 'Expansion Opportunity'
                    ELSE 'Customer Health Risk' END AS alert_type,
               CASE WHEN c_acctbal < 1000 THEN 'High' ELSE 'Medium' END AS severity,
               CASE c_mktsegment WHEN 'BUILDING' THEN 'Billing' ELSE 'CSM' END AS owner,
               CASE WHEN c_acctbal < 4000 THEN 'Open' ELSE 'Acknowledged' END AS status,
               'Seed alert' AS reason, 'Review' AS recommended_action, 'Seed' AS source, '{}' AS metadata,
               TIMESTAMP '2026-01-01 00:00:00' + to_seconds(c_custkey) AS created_at,
               CASE WHEN c_acctbal >= 4000 THEN TIMESTAMP '2026-01-01 00:00:00' + to_seconds(c_custkey) END AS acknowledged_at
        FROM customer""",
    "live": f"""
        SELECT CAST(event_id AS VARCHAR) AS event_id, 'product_usage' AS event_type,
               CAST({_OWNER} AS VARCHAR) AS customer_id, CAST(user_id AS VARCHAR) AS user_id, event_type AS feature,
               ts AS event_timestamp, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS sent_at, ts AS received_at
        FROM events""",
    "live_rows": """
        SELECT event_id, event_type, customer_id, user_id, feature, event_timestamp,
               '{"event_id":"' || event_id || '","event_type":"product_usage","customer_id":"' || customer_id
               || '","user_id":"' || user_id || '","feature":"' || feature || '","timestamp":"' || sent_at || '"}' AS raw_event,
               received_at
        FROM live""",
    "raw_invoices": """
        SELECT CAST(invoice_id AS VARCHAR) || '.0' AS invoice_id, CAST(account_id AS VARCHAR) AS account_id,
               CASE WHEN amount > 90000 THEN 'n/a' WHEN amount > 80000 THEN ' ' ELSE CAST(amount AS VARCHAR) END AS amount,
               strftime(due_date, '%Y-%m-%d %H:%M:%S') AS due_date, status
        FROM invoices""",
    # ---- marts ---------------------------------------------------------------
    "usage_mart": """
        SELECT account_id AS customer_id, count(event_id) AS total_events,
               count(DISTINCT e.user_id) AS active_users, count(DISTINCT feature) AS features_used
        FROM accounts LEFT JOIN app_users u USING (account_id)
             LEFT JOIN (SELECT * FROM usage_events WHERE is_valid_event) e ON e.user_id = u.user_id
        GROUP BY account_id""",
    "subs_mart": f"""
        SELECT account_id AS customer_id, count(*) FILTER (status = 'Active') AS active_subscriptions,
               CAST(coalesce(sum({_PRICE}) FILTER (status = 'Active'), 0) AS BIGINT) AS customer_mrr
        FROM subs GROUP BY account_id""",
    "support_mart": """
        SELECT account_id AS customer_id, count(*) AS total_tickets,
               count(*) FILTER (severity IN ('High', 'Critical')) AS high_priority_tickets,
               coalesce(CAST(sum(hundredths) AS DOUBLE) / nullif(count(hundredths), 0) / 100, 0) AS avg_resolution_hours
        FROM tickets GROUP BY account_id""",
    "billing_mart": """
        SELECT account_id AS customer_id, count(*) AS total_invoices, CAST(sum(amount) AS DOUBLE) AS total_billed,
               count(*) FILTER (status = 'Paid') AS paid_invoices, count(*) FILTER (status = 'Failed') AS failed_invoices
        FROM invoices GROUP BY account_id""",
    "health_parts": """
        SELECT customer_id,
               total_events, active_users, features_used,
               coalesce(active_subscriptions, 0) AS active_subscriptions, coalesce(customer_mrr, 0) AS customer_mrr,
               coalesce(total_tickets, 0) AS total_tickets, coalesce(high_priority_tickets, 0) AS high_priority_tickets,
               coalesce(avg_resolution_hours, 0) AS avg_resolution_hours,
               coalesce(total_invoices, 0) AS total_invoices, coalesce(total_billed, 0) AS total_billed,
               coalesce(paid_invoices, 0) AS paid_invoices, coalesce(failed_invoices, 0) AS failed_invoices
        FROM usage_mart LEFT JOIN subs_mart USING (customer_id) LEFT JOIN support_mart USING (customer_id)
             LEFT JOIN billing_mart USING (customer_id)""",
    "health": f"""
        SELECT *, CAST(points AS DOUBLE) / 100 AS health_score, {_STATUS} AS health_status
        FROM (SELECT *, {_POINTS} AS points
              FROM (SELECT *, {_ladder("total_events", ">=", fixed.USAGE_BANDS, fixed.USAGE_FLOOR)} AS usage_score,
                       {_ladder("avg_resolution_hours", "<=", fixed.SUPPORT_BANDS, fixed.SUPPORT_FLOOR)} AS support_score,
                       {_BILLING} AS billing_score
                    FROM health_parts))""",
    "revenue": f"""
        SELECT plan, active_subscriptions, active_customers, cancelled_subscriptions, active_mrr,
               active_mrr * 12 AS active_arr, cancelled_mrr,
               {_pct("cancelled_mrr", "(active_mrr + cancelled_mrr)")} AS cancelled_revenue_share_pct
        FROM (SELECT plan, count(*) FILTER (status = 'Active') AS active_subscriptions,
                     count(DISTINCT CASE status WHEN 'Active' THEN account_id END) AS active_customers,
                     count(*) FILTER (status = 'Cancelled') AS cancelled_subscriptions,
                     CAST(coalesce(sum({_PRICE}) FILTER (status = 'Active'), 0) AS BIGINT) AS active_mrr,
                     CAST(coalesce(sum({_PRICE}) FILTER (status = 'Cancelled'), 0) AS BIGINT) AS cancelled_mrr
              FROM subs GROUP BY plan)""",
    "daily": """
        SELECT CAST(event_timestamp AS DATE) AS usage_date, feature, count(*) AS total_events,
               count(DISTINCT user_id) AS daily_active_users
        FROM usage_events WHERE is_valid_event GROUP BY ALL""",
    "monthly_users": """
        SELECT CAST(date_trunc('month', event_timestamp) AS DATE) AS month_start, feature,
               count(DISTINCT user_id) AS monthly_active_users
        FROM usage_events WHERE is_valid_event GROUP BY ALL""",
    "usage_table": f"""
        SELECT usage_date, d.feature, total_events, daily_active_users, monthly_active_users,
               {_pct("daily_active_users", "monthly_active_users")} AS daily_to_monthly_active_pct
        FROM daily d, monthly_users m
        WHERE m.feature = d.feature AND m.month_start = date_trunc('month', d.usage_date)""",
    "usage_feed": "SELECT * FROM usage_table ORDER BY usage_date DESC, feature LIMIT 100",
    "sla": f"""
        SELECT * EXCLUDE (hundredths), coalesce(hundredths <= sla_hours * 100, FALSE) AS within_sla,
               CASE WHEN resolved_at IS NULL THEN '{fixed.UNRESOLVED}' WHEN hundredths <= sla_hours * 100 THEN '{fixed.WITHIN_SLA}'
                    ELSE '{fixed.BREACHED_SLA}' END AS sla_status
        FROM (SELECT ticket_id, account_id AS customer_id, severity, created_at, resolved_at, hundredths,
                     CAST(hundredths AS DOUBLE) / 100 AS resolution_hours, {_simple_case("severity", fixed.SLA_HOURS, "NULL")} AS sla_hours
              FROM tickets)""",
    # ---- star ------------------------------------------------------------------
    "star_usage": """
        SELECT event_id, e.user_id, u.account_id AS customer_id, feature, event_timestamp, is_valid_event,
               CAST(event_timestamp AS DATE) AS date_key
        FROM usage_events e LEFT JOIN app_users u ON u.user_id = e.user_id""",
    "star_billing": """
        SELECT invoice_id, account_id AS customer_id, amount, status, CAST(due_date AS DATE) AS date_key FROM invoices""",
    "star_dates": """
        SELECT min(d) AS first_day, max(d) AS last_day FROM (
            SELECT CAST(event_timestamp AS DATE) AS d FROM usage_events UNION ALL SELECT CAST(due_date AS DATE) FROM invoices
            UNION ALL SELECT CAST(start_date AS DATE) FROM subs UNION ALL SELECT CAST(created_at AS DATE) FROM tickets)""",
    # ---- churn -------------------------------------------------------------------
    "account_facts": """
        SELECT account_id, 'plan' AS kind, start_date AS begun, monthly_price AS price, status = 'Cancelled' AS bad,
               NULL AS feature, NULL AS micros
        FROM subs LEFT JOIN plans ON plan_name = plan
        UNION ALL SELECT account_id, 'bill', NULL, NULL, status = 'Failed', NULL, NULL FROM invoices
        UNION ALL SELECT account_id, 'user', NULL, NULL, NULL, NULL, NULL FROM app_users
        UNION ALL SELECT account_id, 'click', NULL, NULL, NULL, feature, NULL FROM usage_events JOIN app_users USING (user_id) WHERE is_valid_event
        UNION ALL SELECT account_id, 'help', NULL, NULL, NULL, NULL, epoch_us(resolved_at) - epoch_us(created_at)
        FROM tickets WHERE resolved_at IS NOT NULL""",
    "measures": """
        SELECT account_id, count(*) FILTER (kind = 'plan') AS subscription_count, max(begun) AS latest_subscription_start,
               avg(price) AS avg_plan_price, CAST(max(price) AS BIGINT) AS max_plan_price,
               CAST(bool_or(bad) FILTER (kind = 'plan') AS INTEGER) AS churned,
               count(*) FILTER (kind = 'user') AS users, count(*) FILTER (kind = 'click') AS usage_events,
               count(DISTINCT feature) AS features_used, count(micros) AS support_ticket_count,
               CAST(sum(micros) AS DOUBLE) / nullif(count(micros), 0) / 3600000000 AS avg_resolution_hours,
               count(*) FILTER (kind = 'bill') AS invoice_count, count(*) FILTER (kind = 'bill' AND bad) AS failed_invoice_count
        FROM account_facts GROUP BY account_id""",
    "features": """
        SELECT account_id, industry, size, region, subscription_count, latest_subscription_start, avg_plan_price, max_plan_price,
               usage_events, features_used, support_ticket_count, coalesce(avg_resolution_hours, 0) AS avg_resolution_hours,
               invoice_count, failed_invoice_count,
               CASE WHEN invoice_count > 0 THEN CAST(failed_invoice_count AS DOUBLE) / invoice_count ELSE 0 END AS failed_invoice_rate, churned
        FROM accounts JOIN measures USING (account_id) WHERE subscription_count > 0""",
    "patterns": """
        SELECT a.*, churned, coalesce(usage_events, 0) AS usage_events, coalesce(features_used, 0) AS features_used,
               coalesce(support_ticket_count, 0) AS support_ticket_count, coalesce(avg_resolution_hours, 0) AS avg_resolution_hours,
               coalesce(failed_invoice_count, 0) AS failed_invoice_count, coalesce(invoice_count, 0) AS invoice_count
        FROM accounts a LEFT JOIN measures USING (account_id)""",
    "model_rows": """
        SELECT * EXCLUDE (latest_subscription_start),
               datediff('day', latest_subscription_start, TIMESTAMP '2026-12-31') AS subscription_age_days
        FROM features""",
    "label_quota": """
        SELECT churned, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, churned) <= train - sum(base) OVER () THEN 1 ELSE 0 END AS quota
        FROM (SELECT churned, train, train * n // total AS base, train * n % total AS rest
              FROM (SELECT churned, n, total, total - (total + 4) // 5 AS train
                    FROM (SELECT churned, count(*) AS n, (SELECT count(*) FROM model_rows) AS total FROM model_rows GROUP BY churned)))""",
    "split": """
        SELECT * EXCLUDE (place, quota), place <= quota AS is_train
        FROM (SELECT *, row_number() OVER (PARTITION BY churned ORDER BY md5('42:' || account_id), account_id) AS place FROM model_rows)
             JOIN label_quota USING (churned)""",
    "scores": """
        SELECT account_id, churned, trouble / (trouble + 4) AS churn_probability
        FROM (SELECT *, CAST(failed_invoice_count * 3 + support_ticket_count + 1 AS DOUBLE) AS trouble FROM features)""",
    "tiers": f"""
        SELECT account_id AS customer_id, round_even(churn_probability, 4) AS churn_probability,
               {_TIER} AS risk_level
        FROM scores""",
    "confusion": """
        SELECT count(*) FILTER (churned = 1 AND churn_probability > 0.5) AS tp, count(*) FILTER (churned = 0 AND churn_probability > 0.5) AS fp,
               count(*) FILTER (churned = 1 AND churn_probability <= 0.5) AS fn, count(*) FILTER (churned = 0 AND churn_probability <= 0.5) AS tn
        FROM scores""",
    "class_rates": """
        SELECT class, precision, recall, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1_score, support
        FROM (SELECT '1' AS class, coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall, tp + fn AS support FROM confusion
              UNION ALL
              SELECT '0', coalesce(tn / nullif(tn + fn, 0), 0), coalesce(tn / nullif(tn + fp, 0), 0), tn + fp FROM confusion)""",
    # ---- forecast ------------------------------------------------------------------
    "paid": """
        SELECT 'all' AS segment, CAST(date_trunc('month', date_key) AS DATE) AS revenue_month, CAST(sum(amount) AS DOUBLE) AS monthly_revenue
        FROM star_billing WHERE status = 'Paid' GROUP BY ALL""",
    "paid_by_region": """
        SELECT region AS segment, CAST(date_trunc('month', date_key) AS DATE) AS revenue_month, CAST(sum(amount) AS DOUBLE) AS monthly_revenue
        FROM star_billing JOIN accounts ON account_id = customer_id WHERE status = 'Paid' GROUP BY ALL""",
    # ---- alerts --------------------------------------------------------------------
    "open_keys": "SELECT DISTINCT customer_id, alert_type FROM seed_alerts WHERE status = 'Open'",
    "expansion_first": """
        SELECT * FROM live WHERE feature = 'purchase'
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY event_timestamp, event_id) = 1""",
}


def _sql(body: str, **extra: str) -> str:
    """``body`` behind a WITH clause of every part it needs, in order."""
    parts = {**PARTS, **extra}
    ordered: list[str] = []

    def need(text: str) -> None:
        for name in parts:
            if name not in ordered and re.search(rf"\b{name}\b", text):
                inner = parts[name]
                if inner is not text:
                    need(inner)
                    if name not in ordered:
                        ordered.append(name)

    need(body)
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{name} AS ({parts[name]})" for name in ordered) + "\n" + body


# ---- data-quality rows --------------------------------------------------------

_EARLY = "SELECT count(*) FROM usage_events e, app_users u WHERE u.user_id = e.user_id AND event_timestamp < created_at"
_MEASURES = {
    "Accounts account_id NULL check": "SELECT count(*) FROM accounts WHERE account_id IS NULL",
    "Users user_id NULL check": "SELECT count(*) FROM app_users WHERE user_id IS NULL",
    "Product events event_id NULL check": "SELECT count(*) FROM usage_events WHERE event_id IS NULL",
    "Subscriptions subscription_id NULL check": "SELECT count(*) FROM subs WHERE subscription_id IS NULL",
    "Accounts duplicate account_id check": "SELECT count(*) FROM (SELECT 1 FROM accounts GROUP BY account_id HAVING count(*) > 1)",
    "Users duplicate user_id check": "SELECT count(*) FROM (SELECT 1 FROM app_users GROUP BY user_id HAVING count(*) > 1)",
    "Product events duplicate event_id check": "SELECT count(*) FROM (SELECT 1 FROM usage_events GROUP BY event_id HAVING count(*) > 1)",
    "Users account reference check": "SELECT count(*) FROM app_users WHERE account_id NOT IN (SELECT account_id FROM accounts)",
    "Product event user reference check": "SELECT count(*) FROM usage_events WHERE user_id NOT IN (SELECT user_id FROM app_users)",
    "Product events before user creation": _EARLY,
    "Multiple active subscriptions per account": "SELECT count(*) FROM (SELECT 1 FROM subs WHERE status = 'Active' GROUP BY account_id HAVING count(*) > 1)",
    "Invoice amount plan price check": "SELECT count(*) FROM invoices WHERE amount NOT IN (SELECT monthly_price FROM plans)",
    "Accounts minimum volume": "SELECT count(*) FROM accounts",
    "Users minimum volume": "SELECT count(*) FROM app_users",
    "Product events minimum volume": "SELECT count(*) FROM usage_events",
    "Invoices minimum volume": "SELECT count(*) FROM invoices",
}


def _checks(*, kinds=None, names=None, core=False) -> str:
    """Result rows of the chosen checks."""
    rows = []
    for number, (name, table, kind, bad, message, in_core) in enumerate(fixed.QUALITY_CHECKS, start=1):
        if (kinds and kind not in kinds) or (names and name not in names) or (core and not in_core):
            continue
        minimum = 1 if kind == "VOLUME" else 0
        good = "n >= 1" if minimum else "n = 0"
        status = f"CASE WHEN {good} THEN 'PASS' ELSE '{bad}' END"
        text = f"'Airflow automated check: ' || {status}" if core else _quoted(message.format(minimum=1))
        rows.append(
            f"SELECT CAST({number} AS INTEGER) AS dq_id, {_quoted(name)} AS check_name, 'silver.{table}' AS table_name, "
            f"'{kind}' AS check_type, {status} AS status, CAST(n AS BIGINT) AS actual_value, "
            f"CAST({minimum} AS BIGINT) AS expected_value, {text} AS message FROM ({_MEASURES[name]}) m(n)"
        )
    return "\nUNION ALL\n".join(rows)


def _contract_rows() -> str:
    tables = {
        "stg_customers": ("accounts", {"customer_id": "account_id"}),
        "stg_users": ("app_users", {"customer_id": "account_id"}),
        "stg_product_events": ("usage_events", {}),
        "stg_subscriptions": ("subs", {"customer_id": "account_id"}),
        "stg_invoices": ("invoices", {"customer_id": "account_id"}),
        "stg_support": ("tickets", {"customer_id": "account_id"}),
        "customer_health": ("health", {}),
        "revenue": ("revenue", {}),
        "product_usage": ("usage_table", {}),
        "support_sla": ("sla", {}),
    }
    rows = []
    for model, (unique_key, not_null) in fixed.MODEL_CONTRACTS.items():
        table, renamed = tables[model]
        for name in not_null:
            rows.append(
                f"SELECT '{model}' AS model, '{name}' AS column_name, 'not_null' AS test, "
                f"count(*) FILTER ({renamed.get(name, name)} IS NULL) AS failures FROM {table}"
            )
        if unique_key:
            column = renamed.get(unique_key, unique_key)
            rows.append(
                f"SELECT '{model}', '{unique_key}', 'unique', count(*) FROM "
                f"(SELECT 1 FROM {table} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1)"
            )
    return "\nUNION ALL\n".join(rows)


# ---- alerts ------------------------------------------------------------------------


def _alert(texts: dict, customer: str, severity: str, metadata: str, source: str) -> str:
    return (
        f"SELECT {customer} AS customer_id, {_quoted(texts['alert_type'])} AS alert_type, {severity} AS severity, "
        f"{_quoted(texts['owner'])} AS owner, 'Open' AS status, {_quoted(texts['reason'])} AS reason, "
        f"{_quoted(texts['recommended_action'])} AS recommended_action, {_quoted(texts['source'])} AS source, "
        f"{metadata} AS metadata FROM {source} s WHERE NOT EXISTS (FROM open_keys k "
        f"WHERE CAST(k.customer_id AS VARCHAR) = CAST(s.{customer} AS VARCHAR) AND k.alert_type = {_quoted(texts['alert_type'])})"
    )


_HEALTH_ALERTS = _alert(
    fixed.HEALTH_ALERT,
    "customer_id",
    "'High'",
    """'{"health_score":' || CAST(health_score AS DECIMAL(5,2)) || ',"usage_score":' || usage_score
       || ',"support_score":' || support_score || ',"billing_score":' || billing_score || '}'""",
    f"(SELECT * FROM health WHERE health_status = '{fixed.AT_RISK}')",
)
_PAYMENT_ALERTS = _alert(
    fixed.PAYMENT_ALERT,
    "customer_id",
    "CASE WHEN failed_invoices > 1 THEN 'High' ELSE 'Medium' END",
    """'{"failed_invoice_count":' || failed_invoices || ',"invoice_count":' || total_invoices || '}'""",
    "(SELECT * FROM billing_mart WHERE failed_invoices > 0)",
)
_EXPANSION_ALERTS = _alert(
    fixed.EXPANSION_ALERT,
    "customer_id",
    "'Medium'",
    """'{"event_id":"' || event_id || '","feature":"' || feature || '","user_id":"' || user_id
       || '","event_timestamp":"' || sent_at || '"}'""",
    "expansion_first",
)

# ---- churn preprocessing -----------------------------------------------------------


def _filled() -> str:
    numeric = [
        f"coalesce(CAST({name} AS DOUBLE), (SELECT median({name}) FROM split WHERE is_train)) AS {name}"
        for name in fixed.NUMERIC_FEATURES
    ]
    text = [
        f"coalesce({name}, (SELECT {name} FROM split WHERE is_train GROUP BY {name} ORDER BY count(*) DESC, {name} LIMIT 1)) AS {name}"
        for name in fixed.CATEGORICAL_FEATURES
    ]
    return f"SELECT account_id, {', '.join(numeric + text)}, is_train FROM split"


def _scaled() -> str:
    columns = [
        f"round(({name} - (SELECT avg({name}) FROM filled WHERE is_train)) / "
        f"(SELECT coalesce(nullif(stddev_pop({name}), 0), 1) FROM filled WHERE is_train), 6) AS {name}"
        for name in fixed.NUMERIC_FEATURES
    ]
    return f"SELECT account_id, {', '.join(columns)} FROM filled"


def _codes() -> str:
    columns = [
        f"(SELECT string_agg(CASE WHEN c = s.{name} THEN '1' ELSE '0' END, '' ORDER BY c) "
        f"FROM (SELECT DISTINCT {name} AS c FROM split WHERE is_train)) AS {name}_code"
        for name in fixed.CATEGORICAL_FEATURES
    ]
    return f"SELECT account_id, {', '.join(columns)} FROM split s"


def _flat() -> str:
    levels = " + ".join(f"(SELECT count(DISTINCT {name}) FROM split WHERE is_train)" for name in fixed.CATEGORICAL_FEATURES)
    return (
        "SELECT feature_no::BIGINT AS feature_no, 0.0::DOUBLE AS gradient "
        f"FROM (SELECT unnest(range(1 + {len(fixed.NUMERIC_FEATURES)} + {levels})) AS feature_no)"
    )


# ---- forecast ------------------------------------------------------------------------


def _forecast_parts(paid: str) -> dict[str, str]:
    return {
        "series": f"""
            SELECT *, row_number() OVER (PARTITION BY segment ORDER BY revenue_month) - 1 AS time_index,
                   count(*) OVER (PARTITION BY segment) AS months FROM {paid}""",
        "early_line": """
            SELECT segment, regr_slope(monthly_revenue, time_index) AS slope, regr_intercept(monthly_revenue, time_index) AS intercept
            FROM series WHERE time_index < months - 2 GROUP BY segment""",
        "held_out": """
            SELECT segment, revenue_month, monthly_revenue AS actual, intercept + slope * time_index AS predicted
            FROM series JOIN early_line USING (segment) WHERE time_index >= months - 2""",
        "forecasts": f"""
            SELECT segment, CAST(last_month + to_months(CAST(ahead AS INTEGER)) AS DATE) AS forecast_month,
                   round(intercept + slope * (last_index + ahead), 4) AS forecast_revenue, '{fixed.FORECAST_MODEL}' AS model_name,
                   round(validation_mae, 4) AS validation_mae, TIMESTAMP '2026-12-31 00:00:00' AS generated_at
            FROM (SELECT segment, regr_slope(monthly_revenue, time_index) AS slope, regr_intercept(monthly_revenue, time_index) AS intercept,
                         max(time_index) AS last_index, max(revenue_month) AS last_month FROM series GROUP BY segment)
                 JOIN (SELECT segment, avg(abs(actual - predicted)) AS validation_mae FROM held_out GROUP BY segment) USING (segment),
                 (VALUES (1), (2), (3)) v(ahead)""",
    }


_ALL = _forecast_parts("paid")
_REGIONS = _forecast_parts("paid_by_region")

_HEALTH_COLUMNS = ", ".join(
    ("customer_id", "usage_score", "support_score", "billing_score", "health_score", "health_status")
)
_SUITE = _checks()

ORACLES = {
    # layers
    "bronze_ingest": _sql("SELECT CAST(account_id AS VARCHAR) AS account_id, industry, size, region, owner FROM accounts"),
    "silver_typed": _sql(
        """SELECT CAST(left(invoice_id, -2) AS BIGINT) AS invoice_id, CAST(account_id AS BIGINT) AS account_id,
                  CAST(nullif(trim(amount), '') AS DOUBLE) AS amount, CAST(due_date AS TIMESTAMP) AS due_date, status
           FROM raw_invoices WHERE amount <> 'n/a'"""
    ),
    "silver_quarantine": _sql("SELECT *, 'amount' AS failed_columns FROM raw_invoices WHERE amount = 'n/a'"),
    "flag_valid_events": _sql("SELECT * FROM usage_events"),
    "flag_valid_events_stored": _sql("SELECT * FROM usage_events"),
    "stage_customers": _sql("SELECT account_id AS customer_id, industry, size, region, owner FROM accounts"),
    "stage_users": _sql("SELECT user_id, account_id AS customer_id, role, created_at FROM app_users"),
    "stage_product_events": _sql("SELECT * FROM usage_events"),
    "stage_subscriptions": _sql("SELECT subscription_id, account_id AS customer_id, plan, start_date, status FROM subs"),
    "stage_invoices": _sql(
        "SELECT invoice_id, account_id AS customer_id, CAST(amount AS DOUBLE) AS amount, due_date, status FROM invoices"
    ),
    "stage_support": _sql(
        """SELECT ticket_id, account_id AS customer_id, severity, created_at, resolved_at,
                  CAST(hundredths AS DOUBLE) / 100 AS resolution_hours FROM tickets"""
    ),
    "star_dim_customer": _sql("SELECT account_id AS customer_id, industry, size, region, owner FROM accounts"),
    "star_dim_user": _sql("SELECT user_id, account_id AS customer_id, role, created_at FROM app_users"),
    "star_dim_plan": _sql("SELECT * FROM plans WHERE plan_name IN (SELECT plan FROM subs)"),
    "star_dim_date": _sql(
        """SELECT CAST(d AS DATE) AS date_key, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
                  CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day, CAST(date_trunc('month', d) AS DATE) AS month_start
           FROM (SELECT unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS d FROM star_dates)"""
    ),
    "star_fact_usage": _sql("SELECT * FROM star_usage"),
    "star_fact_billing": _sql("SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM star_billing"),
    "star_fact_subscription": _sql(
        """SELECT subscription_id, account_id AS customer_id, plan_id, plan, status, CAST(start_date AS DATE) AS date_key
           FROM subs LEFT JOIN plans ON plan = plan_name"""
    ),
    "star_fact_support": _sql(
        """SELECT ticket_id, account_id AS customer_id, severity, created_at, resolved_at,
                  CAST(hundredths AS DOUBLE) / 100 AS resolution_hours, CAST(created_at AS DATE) AS date_key FROM tickets"""
    ),
    "nonempty_gate": _sql(
        "\nUNION ALL\n".join(
            f"SELECT '{name}' AS table_name, count(*) AS row_count, count(*) > 0 AS ok FROM {part}"
            for name, part in (
                ("accounts", "accounts"),
                ("users", "app_users"),
                ("product_events", "usage_events"),
                ("subscriptions", "subs"),
                ("invoices", "invoices"),
                ("support", "tickets"),
            )
        )
    ),
    # marts
    "customer_usage": _sql("SELECT * FROM usage_mart"),
    "customer_subscription": _sql("SELECT * FROM subs_mart"),
    "customer_support": _sql("SELECT * FROM support_mart"),
    "customer_billing": _sql("SELECT * FROM billing_mart"),
    "customer_health": _sql("SELECT * EXCLUDE (points) FROM health"),
    "revenue_by_plan": _sql("SELECT * FROM revenue"),
    "revenue_by_plan_integer_share": _sql(
        """SELECT * REPLACE (CAST(cancelled_mrr // nullif(active_mrr + cancelled_mrr, 0) * 100 AS DOUBLE) AS cancelled_revenue_share_pct)
           FROM revenue"""
    ),
    "daily_feature_usage": _sql("SELECT * FROM daily"),
    "monthly_feature_usage": _sql("SELECT * FROM monthly_users"),
    "product_usage": _sql("SELECT * FROM usage_table"),
    "support_sla": _sql("SELECT * FROM sla"),
    # data quality
    "dq_null_check": _sql(_checks(kinds=("NULL",))),
    "dq_duplicate_check": _sql(_checks(kinds=("DUPLICATE",))),
    "dq_referential_check": _sql(_checks(kinds=("REFERENTIAL",))),
    "dq_events_before_creation": _sql(_checks(names=("Product events before user creation",))),
    "dq_multiple_active": _sql(_checks(names=("Multiple active subscriptions per account",))),
    "dq_invoice_price": _sql(_checks(names=("Invoice amount plan price check",))),
    "dq_min_volume": _sql(_checks(kinds=("VOLUME",))),
    "dq_suite": _sql(_SUITE),
    "dq_core_gate": _sql(_checks(core=True)),
    "dq_summary": _sql(f"SELECT status, count(*) AS check_count FROM ({_SUITE}) GROUP BY status"),
    "dq_report": _sql(_SUITE),
    "dq_pass_rate": _sql(
        f"""SELECT count(*) AS checks, count(*) FILTER (status = 'PASS') AS passing, count(*) FILTER (status = 'WARN') AS warnings,
                   CAST(floor(count(*) FILTER (status = 'PASS') * 100.0 / count(*) + 0.5) AS BIGINT) AS pass_rate_pct FROM ({_SUITE})"""
    ),
    "schema_contracts": _sql(_contract_rows()),
    # alerts and actions
    "health_risk_alerts": _sql(_HEALTH_ALERTS),
    "payment_failure_alerts": _sql(_PAYMENT_ALERTS),
    "suppress_open_alerts": _sql(
        """SELECT account_id AS customer_id, 'Payment Failure' AS alert_type FROM accounts
           WHERE (account_id, 'Payment Failure') NOT IN (SELECT (customer_id, alert_type) FROM open_keys)"""
    ),
    "new_alert_counts": _sql(
        f"""SELECT coalesce(alert_type, 'Total') AS alert_type, CAST(sum(n) AS BIGINT) AS new_alerts
            FROM (SELECT 'Customer Health Risk' AS alert_type, count(*) AS n FROM ({_HEALTH_ALERTS})
                  UNION ALL SELECT 'Payment Failure', count(*) FROM ({_PAYMENT_ALERTS}))
            GROUP BY ROLLUP (alert_type)"""
    ),
    "open_alert_summary": _sql(
        """SELECT alert_type, severity, count(*) AS alert_count, CAST(sum(count(*)) OVER () AS BIGINT) AS total_open_alerts
           FROM seed_alerts WHERE status = 'Open' GROUP BY alert_type, severity"""
    ),
    "alert_feed": _sql(
        "SELECT * EXCLUDE (metadata) FROM seed_alerts ORDER BY created_at DESC, alert_id DESC LIMIT 20"
    ),
    "alert_feed_counts": _sql(
        """SELECT count(*) AS recent_alerts, count(*) FILTER (status = 'Open') AS open_in_feed,
                  count(*) FILTER (severity = 'High') AS high_severity,
                  count(*) FILTER (alert_type = 'Expansion Opportunity') AS expansion_signals
           FROM seed_alerts"""
    ),
    "acknowledge_alerts": _sql(
        """SELECT * EXCLUDE (hit) REPLACE (CASE WHEN hit THEN 'Acknowledged' ELSE status END AS status,
                             CASE WHEN hit THEN TIMESTAMP '2026-12-31' ELSE acknowledged_at END AS acknowledged_at)
           FROM (SELECT *, status = 'Open' AND alert_id IN (SELECT p_partkey FROM part) AS hit FROM seed_alerts)"""
    ),
    "acknowledge_report": _sql(
        f"""SELECT p_partkey AS alert_id, customer_id, alert_type, severity, owner,
                   CASE WHEN customer_id IS NOT NULL THEN 'Acknowledged' END AS status,
                   CASE WHEN customer_id IS NOT NULL THEN TIMESTAMP '2026-12-31' END AS acknowledged_at,
                   CASE WHEN customer_id IS NOT NULL THEN '{fixed.ACKNOWLEDGED}' ELSE '{fixed.NOT_ACKNOWLEDGED}' END AS message
            FROM part LEFT JOIN (SELECT * FROM seed_alerts WHERE status = 'Open') ON alert_id = p_partkey"""
    ),
    "customer_actions": _sql(
        f"""SELECT customer_id, {_simple_case("alert_type", {kind: _quoted(text) for kind, text in fixed.FOLLOW_UPS.items()}, _quoted(fixed.DEFAULT_FOLLOW_UP))}
                   AS action_type, owner, reason AS notes, 'Created' AS status FROM seed_alerts"""
    ),
    # KPIs and feeds
    "dashboard_kpis": _sql(
        f"""SELECT CAST(sum(active_mrr) AS BIGINT) AS active_mrr, CAST(sum(active_arr) AS BIGINT) AS active_arr,
                  CAST(sum(active_customers) AS BIGINT) AS active_customers,
                  CAST(sum(active_subscriptions) AS BIGINT) AS active_subscriptions,
                  (SELECT count(*) FROM seed_alerts WHERE status = 'Open') AS open_alerts,
                  (SELECT count(*) FROM health WHERE health_status = '{fixed.HEALTHY}') AS healthy_customers,
                  (SELECT count(*) FROM health WHERE health_status = '{fixed.WATCH}') AS watch_customers,
                  (SELECT count(*) FROM health WHERE health_status = '{fixed.AT_RISK}') AS at_risk_customers,
                  (SELECT count(DISTINCT account_id) FROM subs WHERE status = 'Active') AS active_customers_distinct
           FROM revenue"""
    ),
    "revenue_listing": _sql("SELECT * FROM revenue"),
    "plan_mix": _sql(
        "SELECT plan, active_mrr, CAST(active_mrr AS DOUBLE) / (SELECT sum(active_mrr) FROM revenue) AS share FROM revenue"
    ),
    "customer_health_lookup": _sql(
        f"""SELECT p_partkey AS customer_id, h.* EXCLUDE (customer_id),
                   CASE WHEN h.customer_id IS NULL THEN '{fixed.CUSTOMER_NOT_FOUND}' END AS message
            FROM part LEFT JOIN (SELECT {_HEALTH_COLUMNS} FROM health) h ON h.customer_id = p_partkey"""
    ),
    "health_watchlist": _sql(f"SELECT {_HEALTH_COLUMNS} FROM health ORDER BY health_score, customer_id LIMIT 10"),
    "product_usage_feed": _sql("SELECT * FROM usage_feed"),
    "usage_by_feature": _sql(
        """SELECT feature, CAST(sum(total_events) AS BIGINT) AS total_events FROM usage_table
           GROUP BY feature ORDER BY 2 DESC, 1 LIMIT 6"""
    ),
    "usage_trend": _sql(
        """SELECT usage_date, CAST(sum(total_events) AS BIGINT) AS total_events FROM usage_table
           GROUP BY usage_date ORDER BY usage_date DESC LIMIT 8"""
    ),
    "usage_feed_totals": _sql(
        """SELECT count(DISTINCT feature) AS features_observed, CAST(sum(total_events) AS BIGINT) AS recent_events FROM usage_table"""
    ),
    "live_event_feed": _sql("SELECT * EXCLUDE (sent_at) FROM live ORDER BY received_at DESC, event_id DESC LIMIT 20"),
    "forecast_listing": _sql("SELECT * FROM forecasts", **_ALL),
    # churn
    "churn_subscription_features": _sql("""SELECT account_id, subscription_count, latest_subscription_start, avg_plan_price, max_plan_price, churned
           FROM measures WHERE subscription_count > 0"""),
    "churn_usage_features": _sql("SELECT account_id, usage_events, features_used FROM measures WHERE users > 0"),
    "churn_support_features": _sql("SELECT account_id, support_ticket_count, avg_resolution_hours FROM measures WHERE support_ticket_count > 0"),
    "churn_billing_features": _sql("SELECT account_id, invoice_count, failed_invoice_count FROM measures WHERE invoice_count > 0"),
    "churn_features": _sql("SELECT * FROM features"),
    "subscription_age_days": _sql("SELECT account_id, subscription_age_days FROM model_rows"),
    "churn_pattern_features": _sql("SELECT * FROM patterns"),
    "churn_distribution": _sql(
        "SELECT churned, count(*) AS count FROM patterns WHERE churned IS NOT NULL GROUP BY churned"
    ),
    "churn_rate_by_segment": _sql(
        "\nUNION ALL\n".join(
            f"""SELECT '{name}' AS segment, {name} AS value, count(churned) AS count,
                       CAST(coalesce(sum(churned), 0) AS BIGINT) AS sum, avg(churned) AS mean FROM patterns GROUP BY {name}"""
            for name in fixed.CATEGORICAL_FEATURES
        )
    ),
    "feature_means_by_churn": _sql(
        f"""SELECT churned, {', '.join(f'round_even(avg({name}), 2) AS {name}' for name in fixed.PATTERN_MEANS)}
            FROM patterns WHERE churned IS NOT NULL GROUP BY churned"""
    ),
    "failed_rate_by_churn": _sql(
        """SELECT churned, round_even(avg(CAST(failed_invoice_count AS DOUBLE) / greatest(invoice_count, 1)), 4) AS failed_invoice_rate
           FROM patterns WHERE churned IS NOT NULL GROUP BY churned"""
    ),
    "stratified_split": _sql("SELECT account_id, churned, is_train FROM split"),
    "impute": _sql(_filled()),
    "standardize": _sql(_scaled(), filled=_filled()),
    "one_hot": _sql(_codes()),
    # A fit is right where the loss is flat, a score where it is the published coefficients' logistic.
    "churn_fit_gradients": _sql(_flat()),
    "churn_score_gaps": _sql("SELECT account_id, 0.0::DOUBLE AS gap FROM split"),
    "churn_metrics": _sql(
        """SELECT 'accuracy' AS metric, (tp + tn) / (tp + tn + fp + fn) AS value FROM confusion
           UNION ALL SELECT 'precision', coalesce(tp / nullif(tp + fp, 0), 0) FROM confusion
           UNION ALL SELECT 'recall', coalesce(tp / nullif(tp + fn, 0), 0) FROM confusion
           UNION ALL
           SELECT 'roc_auc', (sum(place) FILTER (churned = 1) - CAST(sum(churned) AS DOUBLE) * (sum(churned) + 1) / 2)
                             / (CAST(sum(churned) AS DOUBLE) * (count(*) - sum(churned)))
           FROM (SELECT churned, rank() OVER (ORDER BY churn_probability)
                        + (count(*) OVER (PARTITION BY churn_probability) - 1) / 2 AS place FROM scores)"""
    ),
    "classification_report": _sql(
        """SELECT * FROM class_rates
           UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), CAST(sum(support) AS BIGINT) FROM class_rates
           UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                            sum(f1_score * support) / sum(support), CAST(sum(support) AS BIGINT) FROM class_rates"""
    ),
    "risk_tier": _sql("SELECT * FROM tiers"),
    "churn_risk": _sql("SELECT * FROM tiers ORDER BY churn_probability DESC, customer_id LIMIT 10"),
    "risk_summary": _sql(
        """SELECT count(*) AS total_customers, count(*) FILTER (risk_level = 'High') AS high_risk_customers,
                  count(*) FILTER (risk_level = 'Medium') AS medium_risk_customers,
                  count(*) FILTER (risk_level = 'Low') AS low_risk_customers FROM tiers"""
    ),
    # forecast
    "monthly_paid_revenue": _sql("SELECT * EXCLUDE (months) FROM series", **_ALL),
    "revenue_holdout": _sql(
        """SELECT * REPLACE (round(predicted, 4) AS predicted), round(avg(abs(actual - predicted)) OVER (PARTITION BY segment), 4) AS mae
           FROM held_out""",
        **_ALL,
    ),
    "revenue_forecast": _sql("SELECT * FROM forecasts", **_ALL),
    "revenue_forecast_by_region": _sql("SELECT * FROM forecasts", **_REGIONS),
    "revenue_forecast_upsert": _sql(
        """SELECT * FROM forecasts
           UNION ALL
           SELECT * FROM (SELECT * REPLACE (CAST(forecast_month - INTERVAL 1 MONTH AS DATE) AS forecast_month,
                                            round(forecast_revenue - 100, 4) AS forecast_revenue) FROM forecasts)
           WHERE forecast_month NOT IN (SELECT forecast_month FROM forecasts)""",
        **_ALL,
    ),
    # live events
    "live_events_ingest": _sql("SELECT * FROM live_rows"),
    "live_events_stream": _sql("SELECT * FROM live_rows"),
    "expansion_alerts_stream": _sql(_EXPANSION_ALERTS),
    "live_events_batch": _sql("SELECT * FROM live_rows WHERE feature <> 'click'"),
    "expansion_alerts": _sql(_EXPANSION_ALERTS),
    "expansion_alerts_live": _sql(_EXPANSION_ALERTS),
    "enrich_events_with_account": _sql(
        """SELECT event_id, user_id, feature, event_timestamp, customer_id FROM star_usage"""
    ),
}


# ---- whole layers ---------------------------------------------------------------

_PARTS_OF = {"accounts": "accounts", "users": "app_users", "product_events": "usage_events", "subscriptions": "subs", "invoices": "invoices", "support": "tickets", "dim_plan": "plans"}


def _spoilt(spec: dict) -> tuple[str, str]:
    """(column, condition) of the cells that an export of the table spoils."""
    column = [name for name, (_, kind) in spec.items() if kind != "string"][-1]
    return column, f"({next(iter(spec))} % 50 = 7 AND {column} IS NOT NULL)"


def _cells(name: str, spec: dict, where: str = "TRUE", more: str = "") -> str:
    column, fault = _spoilt(spec)
    cells = []
    for each, (_, kind) in spec.items():
        text = f"strftime({each}, '%Y-%m-%d %H:%M:%S.%f')" if kind.startswith("timestamp") else f"CAST({each} AS VARCHAR)"
        text = f"CASE WHEN {fault} THEN 'no ' || {text} ELSE {text} END" if each == column else text
        cells.append(f"coalesce({text}, '')")
    joined = " || '|' || ".join(cells)
    return f"SELECT '{name}' AS table_name, {joined} AS cells{more} FROM {_PARTS_OF[name]} WHERE {where}"


def _positions(order: str, body: str) -> str:
    return f"SELECT row_number() OVER (ORDER BY {order}) AS position, * FROM ({body})"


ORACLES |= {
    "bronze_layer": _sql("\nUNION ALL\n".join(_cells(name, spec) for name, spec in TYPED_TABLES.items())),
    "quarantine_layer": _sql(
        "\nUNION ALL\n".join(
            _cells(name, spec, _spoilt(spec)[1], f", '{_spoilt(spec)[0]}' AS failed_columns") for name, spec in TYPED_TABLES.items()
        )
    ),
    **{
        f"silver_typed_{name}": _sql(f"SELECT {', '.join(spec)} FROM {_PARTS_OF[name]} WHERE NOT {_spoilt(spec)[1]}")
        for name, spec in TYPED_TABLES.items()
        if name not in ("invoices", "dim_plan")
    },
    "nonempty_gate_bronze": ORACLES["nonempty_gate"],
    "nonempty_gate_star": "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count, count(*) > 0 AS ok FROM ({_sql('SELECT * FROM plans') if name == 'dim_plan' else ORACLES['star_' + name]})"
        for name in fixed.STAR_TABLES
    ),
    "dq_observed_checks": _sql(_checks(kinds=("NULL", "VOLUME"))),
    "dq_report_positions": _sql(
        _positions("CASE status WHEN 'FAIL' THEN 1 WHEN 'WARN' THEN 2 ELSE 3 END, check_name", _SUITE)
    ),
    "dq_report_inserted": _sql(_positions("dq_id", _SUITE)),
    "forecast_listing_positions": _sql(_positions("forecast_month", "SELECT * FROM forecasts"), **_ALL),
    "short_series": _sql(
        f"""SELECT CAST(customer_id AS VARCHAR) AS segment, count(DISTINCT date_trunc('month', date_key)) AS months,
                   CAST(sum(amount) AS DOUBLE) AS monthly_revenue
            FROM star_billing WHERE status = 'Paid' GROUP BY customer_id HAVING months < {fixed.MINIMUM_MONTHS}"""
    ),
    "undated_paid_revenue": _sql(
        """SELECT count(*) AS invoices, CAST(sum(amount) AS DOUBLE) AS amount
           FROM star_billing WHERE status = 'Paid' AND invoice_id % 10 = 0"""
    ),
}

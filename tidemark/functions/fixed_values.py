"""They decide results, so they are stated once, in plain text."""

# ---- Fixed values: plans -------------------------------------------------
PLAN_PRICES = {"Starter": 100, "Professional": 250, "Enterprise": 500}
MONTHS_PER_YEAR = 12

# ---- Fixed values: service levels, hours to resolve by severity ----------
SLA_HOURS = {"Critical": 4, "High": 8, "Medium": 24, "Low": 48}
UNRESOLVED, WITHIN_SLA, BREACHED_SLA = "Unresolved", "Within SLA", "Breached SLA"

# ---- Fixed values: score bands (first match wins) ------------------------
USAGE_BANDS = ((50, 100), (30, 80), (15, 60), (5, 40))  # at least N events
USAGE_FLOOR = 0
SUPPORT_BANDS = ((8, 100), (16, 80), (24, 60))  # at most N hours on average
SUPPORT_FLOOR = 30
BILLING_CLEAN, BILLING_RARE, BILLING_SOME, BILLING_FLOOR = 100, 80, 60, 30
BILLING_RARE_SHARE, BILLING_SOME_SHARE = 10, 25  # percent of invoices failed
HEALTH_WEIGHTS = {"usage_score": 40, "support_score": 30, "billing_score": 30}
HEALTHY_FROM, WATCH_FROM = 80, 60
HEALTHY, WATCH, AT_RISK = "Healthy", "Watch", "At Risk"
CUSTOMER_NOT_FOUND = "Customer not found"

# ---- Fixed values: churn model -------------------------------------------
HIGH_RISK_FROM, MEDIUM_RISK_FROM = 0.70, 0.40
CHURN_REFERENCE_DATE = "2026-12-31"
NUMERIC_FEATURES = (
    "subscription_count",
    "avg_plan_price",
    "max_plan_price",
    "usage_events",
    "features_used",
    "support_ticket_count",
    "avg_resolution_hours",
    "invoice_count",
    "failed_invoice_count",
    "failed_invoice_rate",
    "subscription_age_days",
)
CATEGORICAL_FEATURES = ("industry", "size", "region")
PATTERN_MEANS = (
    "usage_events",
    "features_used",
    "support_ticket_count",
    "avg_resolution_hours",
    "failed_invoice_count",
    "invoice_count",
)

# ---- Fixed values: forecast ----------------------------------------------
FORECAST_MODEL = "Linear Regression"
FORECAST_HORIZON = 3
HOLDOUT_MONTHS = 2
MINIMUM_MONTHS = 6

# ---- Fixed values: alerts ------------------------------------------------
HEALTH_ALERT = {
    "alert_type": "Customer Health Risk",
    "owner": "CSM",
    "reason": "Customer health status is At Risk.",
    "recommended_action": "CSM should review customer health and contact the customer.",
    "source": "Customer Health",
}
PAYMENT_ALERT = {
    "alert_type": "Payment Failure",
    "owner": "Billing",
    "reason": "Customer has one or more failed invoices.",
    "recommended_action": "Billing team should review the failed payment and contact the customer if required.",
    "source": "Billing",
}
EXPANSION_ALERT = {
    "alert_type": "Expansion Opportunity",
    "owner": "CSM",
    "reason": "Customer used the AI_Assistant feature in a live product event.",
    "recommended_action": "CSM should review AI_Assistant adoption and evaluate whether an expansion conversation is appropriate.",
    "source": "Live Product Usage",
}
EXPANSION_FEATURE = "AI_Assistant"
FOLLOW_UPS = {
    "Expansion Opportunity": "Expansion Outreach",
    "Payment Failure": "Billing Follow-up",
}
DEFAULT_FOLLOW_UP = "Customer Success Outreach"
DEFAULT_OWNER = "CSM"
ACKNOWLEDGED = "Alert acknowledged successfully"
NOT_ACKNOWLEDGED = "Alert not found or already acknowledged"

# ---- Fixed values: data-quality messages ---------------------------------
NULL_MESSAGE = "Expected zero NULL values in key column."
DUPLICATE_MESSAGE = "Expected zero duplicate business keys."
USER_ACCOUNT_MESSAGE = "Every user should reference an existing account."
EVENT_USER_MESSAGE = "Every product event should reference an existing user."
EARLY_EVENT_MESSAGE = "Events before user creation are flagged for analytical exclusion."
MULTIPLE_ACTIVE_MESSAGE = (
    "Accounts with multiple active subscriptions are retained and handled by current-state logic."
)
INVOICE_PRICE_MESSAGE = "Every invoice amount should match a valid plan monthly price."
VOLUME_MESSAGE = "Expected at least {minimum} row(s)."
CORE_MESSAGE = "Airflow automated check: {status}"

# ---- Fixed values: data-quality suite, in stored order --------------------
# (check_name, table, check_type, bad status, message, part of the core gate)
QUALITY_CHECKS = (
    ("Accounts account_id NULL check", "accounts", "NULL", "FAIL", NULL_MESSAGE, True),
    ("Users user_id NULL check", "users", "NULL", "FAIL", NULL_MESSAGE, False),
    ("Product events event_id NULL check", "product_events", "NULL", "FAIL", NULL_MESSAGE, False),
    ("Subscriptions subscription_id NULL check", "subscriptions", "NULL", "FAIL", NULL_MESSAGE, False),
    ("Accounts duplicate account_id check", "accounts", "DUPLICATE", "FAIL", DUPLICATE_MESSAGE, True),
    ("Users duplicate user_id check", "users", "DUPLICATE", "FAIL", DUPLICATE_MESSAGE, False),
    ("Product events duplicate event_id check", "product_events", "DUPLICATE", "FAIL", DUPLICATE_MESSAGE, False),
    ("Users account reference check", "users", "REFERENTIAL", "FAIL", USER_ACCOUNT_MESSAGE, True),
    ("Product event user reference check", "product_events", "REFERENTIAL", "FAIL", EVENT_USER_MESSAGE, True),
    ("Product events before user creation", "product_events", "BUSINESS_RULE", "WARN", EARLY_EVENT_MESSAGE, True),
    ("Multiple active subscriptions per account", "subscriptions", "BUSINESS_RULE", "WARN", MULTIPLE_ACTIVE_MESSAGE, True),
    ("Invoice amount plan price check", "invoices", "BUSINESS_RULE", "FAIL", INVOICE_PRICE_MESSAGE, False),
    ("Accounts minimum volume", "accounts", "VOLUME", "FAIL", VOLUME_MESSAGE, False),
    ("Users minimum volume", "users", "VOLUME", "FAIL", VOLUME_MESSAGE, False),
    ("Product events minimum volume", "product_events", "VOLUME", "FAIL", VOLUME_MESSAGE, False),
    ("Invoices minimum volume", "invoices", "VOLUME", "FAIL", VOLUME_MESSAGE, False),
)

# ---- Fixed values: column contracts (model -> unique key, not-null columns)
MODEL_CONTRACTS = {
    "stg_customers": ("customer_id", ("customer_id",)),
    "stg_users": ("user_id", ("user_id", "customer_id")),
    "stg_product_events": ("event_id", ("event_id", "user_id")),
    "stg_subscriptions": ("subscription_id", ("subscription_id", "customer_id")),
    "stg_invoices": ("invoice_id", ("invoice_id", "customer_id")),
    "stg_support": ("ticket_id", ("ticket_id", "customer_id")),
    "customer_health": ("customer_id", ("customer_id",)),
    "revenue": (None, ("plan",)),
    "product_usage": (None, ("usage_date", "feature")),
    "support_sla": ("ticket_id", ("ticket_id",)),
}

# ---- Fixed values: layers, in the order they are checked ------------------
SOURCE_TABLES = ("accounts", "users", "product_events", "subscriptions", "invoices", "support")
STAR_TABLES = (
    "dim_customer",
    "dim_user",
    "dim_plan",
    "dim_date",
    "fact_usage",
    "fact_billing",
    "fact_subscription",
    "fact_support",
)

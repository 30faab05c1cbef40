"""Independent DuckDB SQL for the registered queries (the correctness oracle).

The SQL restates each rule from the survey; it shares no code with the Spark
operators. Conventions that keep both engines bit-identical:

* Spark ``round`` is HALF_UP on the shortest decimal text of a double;
  ``ROUND(x::VARCHAR::DECIMAL(38,18), n)::DOUBLE`` reproduces it (``rnd``):
  DuckDB also prints the shortest text, and ROUND on a DECIMAL rounds half
  away from zero. (A direct ``x::DECIMAL(38,12)`` cast rounds the binary
  value first and flips e.g. 3.2737499999999997 to 3.2738.)
* Money is summed exactly as DECIMAL(28,4) and then cast to DOUBLE (``msum``).
* Integer means are ``SUM(x)::DOUBLE / COUNT(x)``.
"""

from __future__ import annotations

AS_OF = "DATE '2024-02-01'"
REVENUE_UNIT = "1000000.0"


def rnd(expr: str, n: int) -> str:
    return f"ROUND(({expr})::DOUBLE::VARCHAR::DECIMAL(38,18), {n})::DOUBLE"


def msum(expr: str) -> str:
    return f"SUM(({expr})::DECIMAL(28,4))::DOUBLE"


def mavg(expr: str) -> str:
    return f"(SUM(({expr})::DECIMAL(28,4))::DOUBLE / COUNT({expr}))"


def parse_date(x: str) -> str:
    return (f"CASE WHEN regexp_full_match({x}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') "
            f"THEN CAST(TRY_STRPTIME({x}, '%Y-%m-%d') AS TIMESTAMP) END")


def parse_int(x: str) -> str:
    return f"TRY_CAST(regexp_replace({x}, '^\\s*([+-]?\\d+)\\.\\d*\\s*$', '\\1') AS INTEGER)"


def dedupe(src: str, key: str, cols: list[str]) -> str:
    order = ", ".join(f"{c} ASC NULLS LAST" for c in cols if c != key)
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER "
            f"(PARTITION BY {key} ORDER BY {order}) AS rn FROM {src}) WHERE rn = 1")


RAW_CUSTOMERS = """
raw_customers AS (
  SELECT CAST(c.c_custkey AS VARCHAR) AS customer_id,
    CASE WHEN c.c_custkey % 7 = 0 THEN ' ' || c.c_name || ' ' ELSE c.c_name END AS customer_name,
    c.c_mktsegment AS industry, n.n_name AS country, r.r_name AS city,
    CASE WHEN c.c_custkey % 50 = 0 THEN '12x'
         WHEN c.c_custkey % 50 = 25 THEN CAST(45 + (c.c_custkey * 37) % 4956 AS VARCHAR) || '.7'
         ELSE CAST(45 + (c.c_custkey * 37) % 4956 AS VARCHAR) END AS employee_count,
    CASE WHEN c.c_custkey % 40 = 0 THEN 'n/a' ELSE CAST(c.c_acctbal AS VARCHAR) END AS annual_revenue,
    CASE WHEN c.c_custkey % 13 = 0 THEN NULL ELSE 'AM' || CAST(c.c_custkey % 20 AS VARCHAR) END AS account_manager,
    strftime(DATE '2020-01-01' + CAST(c.c_custkey % 1000 AS INTEGER), '%Y-%m-%d') AS created_at
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)"""

RAW_LEADS = """
orders_dup AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
  UNION ALL
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1.0, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderkey % 20 = 0),
raw_leads AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS lead_id, CAST(o_custkey AS VARCHAR) AS customer_id,
    'Lead ' || CAST(o_orderkey AS VARCHAR) AS lead_name,
    CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE ' Contact' || CAST(o_orderkey AS VARCHAR) || '@Example.COM' END AS email,
    CASE WHEN o_orderkey % 15 = 0 THEN NULL ELSE '555-' || lpad(CAST(o_orderkey % 10000 AS VARCHAR), 4, '0') END AS phone,
    'Company ' || CAST(o_custkey AS VARCHAR) AS company,
    CASE WHEN o_orderkey % 50 = 0 THEN 'n/a' ELSE CAST(o_totalprice AS VARCHAR) END AS deal_value,
    CASE o_orderstatus WHEN 'F' THEN ' Closed_Won ' WHEN 'P' THEN 'closed_lost' WHEN 'O' THEN 'OPEN' END AS status,
    CASE WHEN o_orderkey % 97 = 0 THEN '2024/13/45' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS created_at,
    strftime(o_orderdate, '%Y-%m-%d') AS updated_at,
    o_orderpriority AS source
  FROM orders_dup)"""

RAW_INTERACTIONS = """
ev AS (
  SELECT event_id, ts, user_id, event_type, value,
    CASE event_type WHEN 'click' THEN 'Phone' WHEN 'signup' THEN 'call' WHEN 'view' THEN 'E-Mail'
      WHEN 'purchase' THEN 'WhatsApp Message' WHEN 'error' THEN 'sms' END AS ch,
    CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS minutes,
    CASE WHEN value >= 50 THEN 'positive' WHEN value < 10 THEN 'negative' ELSE 'neutral' END AS oc
  FROM events),
raw_interactions AS (
  SELECT CAST(event_id AS VARCHAR) AS interaction_id, CAST(user_id AS VARCHAR) AS customer_id,
    CASE WHEN event_id % 9 = 0 THEN ' ' || ch || ' ' ELSE ch END AS channel,
    strftime(ts, '%Y-%m-%d') AS interaction_date,
    CASE WHEN event_id % 50 = 0 THEN '12x' WHEN event_id % 11 = 0 THEN minutes || '.5' ELSE minutes END
      AS interaction_time_minutes,
    CASE WHEN event_id % 7 = 0 THEN upper(oc[1]) || oc[2:] ELSE oc END AS outcome,
    CASE WHEN event_id % 4 = 0 THEN NULL ELSE ' note ' || event_type || ' ' END AS notes
  FROM ev)"""

RAW_PRODUCTS = """
raw_products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_type AS category,
    CAST(p_retailprice AS VARCHAR) AS base_price, 'USD' AS currency,
    '2023-' || lpad(CAST(p_size % 12 + 1 AS VARCHAR), 2, '0') || '-15' AS launch_date
  FROM part)"""

LEADS_COLS = ["lead_id", "customer_id", "lead_name", "email", "phone", "company", "deal_value",
              "status", "created_at", "updated_at", "source", "is_contactable"]
CUSTOMERS_COLS = ["customer_id", "customer_name", "industry", "country", "city", "employee_count",
                  "annual_revenue", "account_manager", "created_at"]
INTERACTIONS_COLS = ["interaction_id", "customer_id", "channel", "interaction_date",
                     "interaction_time_minutes", "outcome", "notes", "channel_standardized"]
PRODUCTS_COLS = ["product_id", "product_name", "category", "base_price", "currency", "launch_date"]

CLEAN_LEADS = RAW_LEADS + """,
typed_leads AS (
  SELECT lead_id, customer_id, trim(lead_name) AS lead_name, trim(lower(email)) AS email,
    trim(phone) AS phone, trim(company) AS company,
    COALESCE(TRY_CAST(deal_value AS DOUBLE), 0.0) AS deal_value,
    trim(lower(status)) AS status, """ + parse_date("created_at") + """ AS created_at,
    """ + parse_date("updated_at") + """ AS updated_at, trim(source) AS source,
    CASE WHEN email IS NULL AND phone IS NULL THEN 0 ELSE 1 END AS is_contactable
  FROM raw_leads),
leads_clean AS (""" + dedupe("typed_leads", "lead_id", LEADS_COLS) + ")"

CLEAN_CUSTOMERS = RAW_CUSTOMERS + """,
typed_customers AS (
  SELECT customer_id, trim(customer_name) AS customer_name, trim(industry) AS industry,
    trim(country) AS country, trim(city) AS city,
    COALESCE(""" + parse_int("employee_count") + """, 0) AS employee_count,
    COALESCE(TRY_CAST(annual_revenue AS DOUBLE), 0.0) AS annual_revenue,
    trim(account_manager) AS account_manager, """ + parse_date("created_at") + """ AS created_at
  FROM raw_customers),
customers_clean AS (""" + dedupe("typed_customers", "customer_id", CUSTOMERS_COLS) + ")"

CLEAN_INTERACTIONS = RAW_INTERACTIONS + """,
typed_interactions AS (
  SELECT interaction_id, customer_id, trim(lower(channel)) AS channel,
    """ + parse_date("interaction_date") + """ AS interaction_date,
    COALESCE(""" + parse_int("interaction_time_minutes") + """, 0) AS interaction_time_minutes,
    trim(lower(outcome)) AS outcome, COALESCE(trim(notes), '') AS notes,
    CASE WHEN trim(lower(channel)) IN ('call', 'phone') THEN 'call'
         WHEN trim(lower(channel)) IN ('whatsapp', 'whatsapp message') THEN 'whatsapp'
         WHEN trim(lower(channel)) IN ('email', 'e-mail') THEN 'email'
         ELSE trim(lower(channel)) END AS channel_standardized
  FROM raw_interactions),
interactions_clean AS (""" + dedupe("typed_interactions", "interaction_id", INTERACTIONS_COLS) + ")"

CLEAN_PRODUCTS = RAW_PRODUCTS + """,
typed_products AS (
  SELECT product_id, trim(product_name) AS product_name, trim(category) AS category,
    COALESCE(TRY_CAST(base_price AS DOUBLE), 0.0) AS base_price, trim(currency) AS currency,
    """ + parse_date("launch_date") + """ AS launch_date
  FROM raw_products),
products_clean AS (""" + dedupe("typed_products", "product_id", PRODUCTS_COLS) + ")"

ALL_CLEAN = ",".join([CLEAN_CUSTOMERS, CLEAN_LEADS, CLEAN_INTERACTIONS, CLEAN_PRODUCTS])

INTERACTION_METRICS = """
im_agg AS (
  SELECT customer_id, COUNT(*) AS total_interactions,
    COUNT(*) FILTER (WHERE channel_standardized = 'call') AS num_calls,
    COUNT(*) FILTER (WHERE channel_standardized = 'whatsapp') AS num_whatsapp,
    COUNT(*) FILTER (WHERE channel_standardized = 'email') AS num_emails,
    COUNT(*) FILTER (WHERE outcome = 'positive') AS num_positive_outcomes,
    COUNT(*) FILTER (WHERE outcome = 'negative') AS num_negative_outcomes,
    COUNT(*) FILTER (WHERE outcome = 'neutral') AS num_neutral_outcomes,
    SUM(interaction_time_minutes)::DOUBLE / COUNT(interaction_time_minutes) AS avg_interaction_duration_minutes,
    MAX(interaction_date) AS last_interaction_date, MIN(interaction_date) AS first_interaction_date
  FROM interactions_clean GROUP BY customer_id),
interaction_metrics AS (
  SELECT *,
    date_diff('day', last_interaction_date::DATE, """ + AS_OF + """)::INTEGER AS days_since_last_interaction,
    CASE WHEN date_diff('day', first_interaction_date::DATE, """ + AS_OF + """) + 1 = 0 THEN NULL ELSE """ + rnd(
    "total_interactions::DOUBLE / (date_diff('day', first_interaction_date::DATE, " + AS_OF + ") + 1)", 4) + """ END
      AS interaction_frequency_per_day,
    CASE WHEN num_calls >= num_whatsapp THEN (CASE WHEN num_calls >= num_emails THEN 'call' ELSE 'email' END)
         ELSE (CASE WHEN num_whatsapp >= num_emails THEN 'whatsapp' ELSE 'email' END) END AS preferred_channel,
    """ + rnd("(num_positive_outcomes * 10 + total_interactions * 2 - num_negative_outcomes * 5)::DOUBLE"
              " / (total_interactions + 1)", 2) + """ AS engagement_score
  FROM im_agg)"""

DEAL_METRICS = """
dm_agg AS (
  SELECT customer_id,
    """ + msum("CASE WHEN status = 'closed_won' THEN deal_value ELSE 0.0 END") + """ AS total_revenue,
    COUNT(*) FILTER (WHERE status = 'closed_won') AS num_closed_won,
    COUNT(*) FILTER (WHERE status = 'closed_lost') AS num_closed_lost,
    COUNT(*) FILTER (WHERE status = 'open') AS num_open_deals,
    """ + msum("deal_value") + """ AS total_deal_value,
    """ + mavg("CASE WHEN status = 'closed_won' THEN deal_value END") + """ AS avg_won_deal_value,
    MAX(deal_value) AS max_deal_value, COUNT(*) AS total_deals
  FROM leads_clean GROUP BY customer_id),
deal_metrics AS (
  SELECT *,
    """ + rnd("num_closed_won / (num_closed_won + num_closed_lost + 0.001::DOUBLE)", 4) + """ AS conversion_rate,
    """ + rnd("num_closed_won / (total_deals + 0.001::DOUBLE)", 4) + """ AS win_rate,
    """ + rnd("total_deal_value / (total_deals + 0.001::DOUBLE)", 2) + """ AS avg_deal_value
  FROM dm_agg)"""

FEATURES = INTERACTION_METRICS + "," + DEAL_METRICS + """,
feat AS (
  SELECT c.customer_id, c.customer_name, c.industry, c.country, c.city, c.employee_count,
    c.annual_revenue, c.account_manager, c.created_at,
    COALESCE(i.total_interactions, 0) AS total_interactions, COALESCE(i.num_calls, 0) AS num_calls,
    COALESCE(i.num_whatsapp, 0) AS num_whatsapp, COALESCE(i.num_emails, 0) AS num_emails,
    COALESCE(i.num_positive_outcomes, 0) AS num_positive_outcomes,
    COALESCE(i.num_negative_outcomes, 0) AS num_negative_outcomes,
    COALESCE(i.engagement_score, 0.0) AS engagement_score,
    COALESCE(i.preferred_channel, 'email') AS preferred_channel,
    COALESCE(i.days_since_last_interaction, 999) AS days_since_last_interaction,
    COALESCE(d.total_revenue, 0.0) AS total_revenue, COALESCE(d.num_closed_won, 0) AS num_closed_won,
    COALESCE(d.num_closed_lost, 0) AS num_closed_lost, COALESCE(d.num_open_deals, 0) AS num_open_deals,
    COALESCE(d.conversion_rate, 0.0) AS conversion_rate, COALESCE(d.win_rate, 0.0) AS win_rate,
    COALESCE(d.avg_deal_value, 0.0) AS avg_deal_value
  FROM customers_clean c
  LEFT JOIN interaction_metrics i ON c.customer_id = i.customer_id
  LEFT JOIN deal_metrics d ON c.customer_id = d.customer_id),
feat_s AS (
  SELECT *, """ + rnd("total_revenue / " + REVENUE_UNIT + " * 30.0 + total_interactions * 2.0"
                     " + engagement_score * 1.0 + win_rate * 20.0", 2) + """ AS raw_score FROM feat),
customer_features AS (
  SELECT * EXCLUDE (raw_score, lead_score0), lead_score0 AS lead_score,
    CASE WHEN lead_score0 >= 80 THEN 'hot' WHEN lead_score0 >= 60 THEN 'warm'
         WHEN lead_score0 >= 40 THEN 'cool' ELSE 'cold' END AS lead_quality,
    """ + rnd("engagement_score / 100 * 0.4 + conversion_rate * 0.6", 4) + """ AS probability_to_convert
  FROM (SELECT *, CASE WHEN raw_score > 100 THEN 100.0 ELSE raw_score END AS lead_score0 FROM feat_s))"""


def with_(ctes: str, body: str) -> str:
    return "WITH " + ctes.strip().lstrip(",") + "\n" + body


ORACLE: dict[str, str] = {
    "leads_clean": with_(CLEAN_LEADS, "SELECT * FROM leads_clean"),
    "customers_clean": with_(CLEAN_CUSTOMERS, "SELECT * FROM customers_clean"),
    "interactions_clean": with_(CLEAN_INTERACTIONS, "SELECT * FROM interactions_clean"),
    "products_clean": with_(CLEAN_PRODUCTS, "SELECT * FROM products_clean"),
    "interaction_metrics": with_(CLEAN_INTERACTIONS + "," + INTERACTION_METRICS,
                                 "SELECT * FROM interaction_metrics"),
    "deal_metrics": with_(CLEAN_LEADS + "," + DEAL_METRICS, "SELECT * FROM deal_metrics"),
    "customer_features": with_(ALL_CLEAN + "," + FEATURES, "SELECT * FROM customer_features"),
    "sales_summary": with_(CLEAN_LEADS, """
SELECT created_at AS deal_date, COUNT(*) AS total_deals,
  COUNT(*) FILTER (WHERE status = 'closed_won') AS deals_won,
  COUNT(*) FILTER (WHERE status = 'closed_lost') AS deals_lost,
  COUNT(*) FILTER (WHERE status = 'open') AS deals_open,
  """ + msum("CASE WHEN status = 'closed_won' THEN deal_value ELSE 0.0 END") + """ AS revenue_won,
  """ + msum("deal_value") + """ AS total_deal_value,
  COUNT(DISTINCT customer_id) AS unique_customers,
  """ + rnd("COUNT(*) FILTER (WHERE status = 'closed_won') / (COUNT(*) FILTER (WHERE status = 'closed_won')"
            " + COUNT(*) FILTER (WHERE status = 'closed_lost') + 0.001::DOUBLE)", 4) + """ AS win_rate_daily
FROM leads_clean GROUP BY created_at"""),
    "channel_performance": with_(CLEAN_INTERACTIONS, """
SELECT channel_standardized, COUNT(*) AS total_interactions,
  COUNT(*) FILTER (WHERE outcome = 'positive') AS positive_outcomes,
  COUNT(*) FILTER (WHERE outcome = 'negative') AS negative_outcomes,
  COUNT(*) FILTER (WHERE outcome = 'neutral') AS neutral_outcomes,
  SUM(interaction_time_minutes)::DOUBLE / COUNT(interaction_time_minutes) AS avg_duration_minutes,
  COUNT(DISTINCT customer_id) AS unique_customers,
  """ + rnd("COUNT(*) FILTER (WHERE outcome = 'positive') / (COUNT(*) + 0.001::DOUBLE)", 4) + """ AS positive_rate,
  """ + rnd("COUNT(*) / (COUNT(DISTINCT customer_id) + 0.001::DOUBLE)", 2) + """ AS interactions_per_customer
FROM interactions_clean GROUP BY channel_standardized"""),
    "top_customers": with_(ALL_CLEAN + "," + FEATURES, """
SELECT customer_id, customer_name, industry, annual_revenue, total_revenue, num_closed_won,
  total_interactions, engagement_score, lead_score, lead_quality, account_manager
FROM customer_features ORDER BY total_revenue DESC, customer_id ASC LIMIT 50"""),
}


# --- analysis-rule features and profiling ------------------------------------

RAW_CHANNELS = {"call": "num_call", "e-mail": "num_e_mail", "phone": "num_phone",
                "sms": "num_sms", "whatsapp message": "num_whatsapp_message"}
OUTCOMES = {"negative": "num_negative_outcomes", "neutral": "num_neutral_outcomes",
            "positive": "num_positive_outcomes"}

_pivots = ",\n    ".join(
    [f"COUNT(*) FILTER (WHERE channel = '{v}') AS {n}" for v, n in RAW_CHANNELS.items()]
    + [f"COUNT(*) FILTER (WHERE outcome = '{v}') AS {n}" for v, n in OUTCOMES.items()])
_pivot_fill = ", ".join(f"COALESCE(i.{n}, 0) AS {n}"
                        for n in list(RAW_CHANNELS.values()) + list(OUTCOMES.values()))

EDA_FEATURES = """
eda_isum AS (
  SELECT customer_id, COUNT(interaction_id) AS total_interactions,
    SUM(interaction_time_minutes)::DOUBLE / COUNT(interaction_time_minutes) AS avg_interaction_duration,
    MAX(interaction_date) AS last_interaction_date,
    """ + _pivots + """
  FROM interactions_clean WHERE customer_id IS NOT NULL GROUP BY customer_id),
eda_deals AS (
  SELECT customer_id, """ + msum("deal_value") + """ AS total_revenue, COUNT(deal_value) AS total_deals,
    """ + mavg("deal_value") + """ AS avg_deal_value,
    COUNT(*) FILTER (WHERE status = 'closed_won') AS num_closed_won
  FROM leads_clean WHERE customer_id IS NOT NULL GROUP BY customer_id),
eda_j AS (
  SELECT c.customer_id, c.customer_name, c.industry, c.country, c.city, c.employee_count,
    c.annual_revenue, c.account_manager, c.created_at,
    COALESCE(i.total_interactions, 0) AS total_interactions,
    COALESCE(i.avg_interaction_duration, 0.0) AS avg_interaction_duration,
    i.last_interaction_date, """ + _pivot_fill + """,
    COALESCE(d.total_revenue, 0.0) AS total_revenue, COALESCE(d.total_deals, 0) AS total_deals,
    COALESCE(d.avg_deal_value, 0.0) AS avg_deal_value, COALESCE(d.num_closed_won, 0) AS num_closed_won
  FROM customers_clean c
  LEFT JOIN eda_isum i ON c.customer_id = i.customer_id
  LEFT JOIN eda_deals d ON c.customer_id = d.customer_id),
eda_e AS (
  SELECT *, (num_positive_outcomes * 10 + total_interactions * 2 - num_negative_outcomes * 5)::DOUBLE
    / (total_interactions + 1) AS engagement_score FROM eda_j),
eda_s AS (
  SELECT *, total_revenue / """ + REVENUE_UNIT + """::DOUBLE * 30.0::DOUBLE + total_interactions * 2.0::DOUBLE
    + engagement_score * 25.0::DOUBLE + (num_closed_won / (total_deals + 0.001::DOUBLE)) * 20.0::DOUBLE AS raw_score
  FROM eda_e),
eda_features AS (
  SELECT * EXCLUDE (raw_score, s0, s1), s1 AS lead_score,
    CASE WHEN s1 > 0 AND s1 <= 100 AND s1 > 80 THEN 'hot'
         WHEN s1 > 0 AND s1 <= 100 AND s1 > 60 THEN 'warm'
         WHEN s1 > 0 AND s1 <= 100 AND s1 > 40 THEN 'cool'
         WHEN s1 > 0 AND s1 <= 100 THEN 'cold' END AS lead_quality
  FROM (SELECT *, CASE WHEN s0 < 0 THEN 0.0 ELSE s0 END AS s1
        FROM (SELECT *, CASE WHEN raw_score > 100 THEN 100.0 ELSE raw_score END AS s0 FROM eda_s)))"""

VALUE_DISTRIBUTIONS = (
    ("leads", "status"), ("leads", "source"), ("customers", "industry"),
    ("interactions", "channel"), ("interactions", "channel_standardized"),
    ("interactions", "outcome"), ("products", "category"),
)


def _value_dist(table: str, col: str) -> str:
    return f"""SELECT * FROM (
  SELECT '{table}' AS table_name, '{col}' AS column_name, CAST({col} AS VARCHAR) AS value,
    COUNT(*) AS count, COUNT(*) * 100.0::DOUBLE / (SUM(COUNT(*)) OVER ())::DOUBLE AS pct
  FROM {table}_clean GROUP BY {col}) WHERE value IS NOT NULL"""


RAW_TABLE_COLS = {
    "leads": LEADS_COLS[:-1], "customers": CUSTOMERS_COLS,
    "interactions": INTERACTIONS_COLS[:-1], "products": PRODUCTS_COLS,
}


def _null_profile(table: str) -> str:
    parts = [f"""SELECT '{table}' AS table_name, '{c}' AS column_name,
    COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count,
    COUNT(*) FILTER (WHERE {c} IS NULL) * 100.0::DOUBLE / COUNT(*) AS null_pct FROM raw_{table}"""
             for c in RAW_TABLE_COLS[table]]
    return "\nUNION ALL\n".join(parts)


def median_sql(table: str, col: str) -> str:
    """Exact median as Spark's percentile interpolates it: 0.5*a + 0.5*b."""
    return f"""(SELECT CASE WHEN n = 0 THEN NULL WHEN n % 2 = 1 THEN MAX(x) FILTER (WHERE i = (n - 1) // 2)
    ELSE 0.5 * MAX(x) FILTER (WHERE i = (n - 2) // 2) + 0.5 * MAX(x) FILTER (WHERE i = n // 2) END
  FROM (SELECT x, ROW_NUMBER() OVER (ORDER BY x) - 1 AS i, COUNT(*) OVER () AS n
        FROM (SELECT {col}::DOUBLE AS x FROM {table} WHERE {col} IS NOT NULL)) GROUP BY n)"""


DESCRIBE_SPEC = {
    "leads": {"deal_value": ("sum", "mean", "median", "min", "max")},
    "customers": {"employee_count": ("mean", "median", "min", "max"),
                  "annual_revenue": ("sum", "mean", "median")},
    "interactions": {"interaction_time_minutes": ("mean", "median", "max")},
}


def _describe() -> str:
    parts = []
    for table, spec in DESCRIBE_SPEC.items():
        for col, stats in spec.items():
            x = f"{col}::DOUBLE"
            fn = {"sum": msum(x), "mean": mavg(x), "min": f"MIN({x})", "max": f"MAX({x})"}
            for s in stats:
                expr = median_sql(f"{table}_clean", col) if s == "median" else f"(SELECT {fn[s]} FROM {table}_clean)"
                parts.append(f"SELECT '{table}' AS table_name, '{col}' AS column_name, '{s}' AS stat, "
                             f"{expr} AS value")
    return "\nUNION ALL\n".join(parts)


ORACLE.update({
    "eda_customer_features": with_(ALL_CLEAN + "," + EDA_FEATURES, "SELECT * FROM eda_features"),
    "value_distribution": with_(ALL_CLEAN, "\nUNION ALL\n".join(_value_dist(t, c) for t, c in VALUE_DISTRIBUTIONS)),
    "null_profile": with_(",".join([RAW_LEADS, RAW_CUSTOMERS, RAW_INTERACTIONS, RAW_PRODUCTS]),
                          "SELECT * FROM (" + "\nUNION ALL\n".join(
                              _null_profile(t) for t in RAW_TABLE_COLS) + ") WHERE null_count > 0"),
    "descriptive_stats": with_(ALL_CLEAN, _describe()),
    "status_breakdown": with_(CLEAN_LEADS, """
SELECT * FROM (SELECT status, COUNT(*) AS deals, """ + msum("deal_value") + """ AS deal_value,
  COUNT(*) * 100.0::DOUBLE / (SUM(COUNT(*)) OVER ())::DOUBLE AS pct
  FROM leads_clean GROUP BY status) WHERE status IS NOT NULL""").replace("SELECT * FROM (SELECT status, COUNT",
    "SELECT *, (ROW_NUMBER() OVER (ORDER BY deal_value DESC NULLS LAST, status))::INTEGER AS revenue_rank "
    "FROM (SELECT status, COUNT"),
    "industry_revenue": with_(CLEAN_CUSTOMERS, """
SELECT industry, """ + msum("annual_revenue") + """ AS annual_revenue
FROM customers_clean WHERE industry IS NOT NULL GROUP BY industry"""),
    "quality_distribution": with_(ALL_CLEAN + "," + EDA_FEATURES, """
SELECT d.position, d.lead_quality, COALESCE(c.customers, 0) AS customers,
  COALESCE(c.customers, 0) * 100.0::DOUBLE / (SELECT COUNT(*) FROM eda_features) AS pct
FROM (VALUES (0, 'hot'), (1, 'warm'), (2, 'cool'), (3, 'cold')) d(position, lead_quality)
LEFT JOIN (SELECT lead_quality, COUNT(*) AS customers FROM eda_features GROUP BY lead_quality) c
  ON d.lead_quality = c.lead_quality"""),
    "notebook_quality_distribution": with_(ALL_CLEAN + "," + FEATURES, """
SELECT d.position, d.lead_quality, COALESCE(c.customers, 0) AS customers,
  COALESCE(c.customers, 0) * 100.0::DOUBLE / (SELECT COUNT(*) FROM customer_features) AS pct
FROM (VALUES (0, 'hot'), (1, 'warm'), (2, 'cool'), (3, 'cold')) d(position, lead_quality)
LEFT JOIN (SELECT lead_quality, COUNT(*) AS customers FROM customer_features GROUP BY lead_quality) c
  ON d.lead_quality = c.lead_quality"""),
    "feature_summary": with_(ALL_CLEAN + "," + EDA_FEATURES, """
SELECT """ + rnd("AVG(lead_score)", 6) + """ AS mean_lead_score, MAX(lead_score) AS max_lead_score,
  """ + rnd("AVG(engagement_score)", 6) + """ AS mean_engagement_score,
  SUM(total_interactions)::DOUBLE / COUNT(total_interactions) AS mean_total_interactions,
  """ + mavg("total_revenue") + """ AS mean_total_revenue,
  """ + median_sql("eda_features", "lead_score") + """ AS median_lead_score
FROM eda_features"""),
    "lead_score_histogram": with_(ALL_CLEAN + "," + EDA_FEATURES + """,
rng AS (SELECT MIN(lead_score) AS lo, MAX(lead_score) AS hi FROM eda_features),
binned AS (
  SELECT CASE WHEN r.hi = r.lo THEN 0 ELSE LEAST(CAST(floor((f.lead_score - r.lo) / ((r.hi - r.lo) / 15.0::DOUBLE)) AS INTEGER), 14) END AS bin
  FROM eda_features f, rng r WHERE f.lead_score IS NOT NULL)""", """
SELECT b.bin, r.lo + b.bin * (r.hi - r.lo) / 15.0::DOUBLE AS bin_start,
  r.lo + (b.bin + 1) * (r.hi - r.lo) / 15.0::DOUBLE AS bin_end, COALESCE(c.customers, 0) AS customers
FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(15)) b CROSS JOIN rng r
LEFT JOIN (SELECT bin, COUNT(*) AS customers FROM binned GROUP BY bin) c ON b.bin = c.bin
WHERE r.lo IS NOT NULL"""),
    "revenue_interaction_points": with_(ALL_CLEAN + "," + EDA_FEATURES,
                                        "SELECT customer_id, total_interactions, total_revenue, lead_score FROM eda_features"),
    "size_revenue_points": with_(CLEAN_CUSTOMERS, "SELECT customer_id, employee_count, annual_revenue FROM customers_clean"),
    "top10_revenue": with_(ALL_CLEAN + "," + EDA_FEATURES, """
SELECT customer_id, customer_name, total_revenue FROM eda_features
ORDER BY total_revenue DESC, customer_id ASC LIMIT 10"""),
    "top10_lead_score": with_(ALL_CLEAN + "," + EDA_FEATURES, """
SELECT *, (ROW_NUMBER() OVER (ORDER BY lead_score DESC, customer_id ASC))::INTEGER AS rank FROM (
  SELECT customer_id, customer_name, lead_score, total_revenue, lead_quality FROM eda_features
  ORDER BY lead_score DESC, customer_id ASC LIMIT 10)"""),
    "top5_industries": with_(CLEAN_CUSTOMERS, """
SELECT * FROM (""" + _value_dist("customers", "industry") + """) ORDER BY count DESC, value ASC LIMIT 5"""),
})


# --- data quality ----------------------------------------------------------------

KEYS = {"leads": "lead_id", "customers": "customer_id", "interactions": "interaction_id",
        "products": "product_id"}
QUALITY_SPEC = {
    "leads": dict(null_columns=("email", "phone"), flag_columns=("is_contactable",),
                  range_columns=("deal_value",)),
    "customers": dict(null_columns=("account_manager",), range_columns=("employee_count", "annual_revenue")),
    "interactions": dict(),
    "products": dict(range_columns=("base_price",)),
}
CLEAN_COLS = {"leads": LEADS_COLS, "customers": CUSTOMERS_COLS, "interactions": INTERACTIONS_COLS,
              "products": PRODUCTS_COLS}
ALL_RAW = ",".join([RAW_LEADS, RAW_CUSTOMERS, RAW_INTERACTIONS, RAW_PRODUCTS])


def _dup_clean(table: str) -> str:
    k = KEYS[table]
    return (f"COUNT(DISTINCT {k}) + COALESCE(MAX(CASE WHEN {k} IS NULL THEN 1 ELSE 0 END), 0)")


def _quality_metrics(table: str) -> str:
    spec = QUALITY_SPEC[table]
    metrics = [("raw_rows", f"(SELECT COUNT(*) FROM raw_{table})"),
               ("duplicates_removed", f"(SELECT COUNT(*) - ({_dup_clean(table)}) FROM raw_{table})"),
               ("clean_rows", f"(SELECT COUNT(*) FROM {table}_clean)")]
    metrics += [(f"null_{c}", f"(SELECT COUNT(*) FILTER (WHERE {c} IS NULL) FROM {table}_clean)")
                for c in spec.get("null_columns", ())]
    metrics += [(f"{c}_count", f"(SELECT COUNT(*) FILTER (WHERE {c} = 1) FROM {table}_clean)")
                for c in spec.get("flag_columns", ())]
    for c in spec.get("range_columns", ()):
        metrics += [(f"{c}_min", f"(SELECT MIN({c}::DOUBLE) FROM {table}_clean)"),
                    (f"{c}_max", f"(SELECT MAX({c}::DOUBLE) FROM {table}_clean)")]
    return "\nUNION ALL\n".join(f"SELECT '{table}' AS table_name, '{m}' AS metric, {e}::DOUBLE AS value"
                                for m, e in metrics)


def _col_stats(table: str, src: str, cols: list[str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, MIN({c}::DOUBLE) AS min_value, "
        f"MAX({c}::DOUBLE) AS max_value, {mavg(c + '::DOUBLE')} AS mean_value, "
        f"{msum(c + '::DOUBLE')} AS sum_value FROM {src}" for c in cols)


RANGE_RULES = {
    "leads": {"deal_value_non_negative": "deal_value >= 0",
              "status_known": "status IN ('open', 'closed_won', 'closed_lost')"},
    "customers": {"annual_revenue_non_negative": "annual_revenue >= 0",
                  "employee_count_non_negative": "employee_count >= 0"},
    "interactions": {"duration_non_negative": "interaction_time_minutes >= 0",
                     "date_present": "interaction_date IS NOT NULL"},
    "products": {"base_price_non_negative": "base_price >= 0"},
}


def _completeness(table: str, src: str, cols: list[str]) -> str:
    nn = " + ".join(f"COUNT({c})" for c in cols)
    n = len(cols)
    return (f"SELECT '{table}' AS table_name, COUNT(*) AS rows, COUNT(*) * {n} AS cells, "
            f"({nn})::BIGINT AS non_null_cells, CASE WHEN COUNT(*) = 0 THEN NULL ELSE "
            f"{rnd(f'({nn}) * 100.0::DOUBLE / (COUNT(*) * {n})', 4)} END AS completeness_pct FROM {src}")


ORACLE.update({
    "clean_layer_metrics": with_(ALL_CLEAN,
                                 "\nUNION ALL\n".join([_quality_metrics(t) for t in QUALITY_SPEC] + [
                                     f"SELECT '{t}', '{c}=' || {c}, COUNT(*)::DOUBLE FROM {t}_clean "
                                     f"WHERE {c} IS NOT NULL GROUP BY {c}" for t, c in (
                                         ("interactions", "channel"), ("interactions", "outcome"),
                                         ("products", "category"))])),
    "duplicate_counts": with_(ALL_RAW, "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS raw_rows, ({_dup_clean(t)})::BIGINT AS clean_rows, "
        f"(COUNT(*) - ({_dup_clean(t)}))::BIGINT AS duplicates_removed FROM raw_{t}" for t in QUALITY_SPEC)),
    "column_stats": with_(ALL_CLEAN + "," + INTERACTION_METRICS + "," + DEAL_METRICS, "\nUNION ALL\n".join([
        _col_stats("leads", "leads_clean", ["deal_value"]),
        _col_stats("customers", "customers_clean", ["employee_count", "annual_revenue"]),
        _col_stats("products", "products_clean", ["base_price"]),
        _col_stats("interactions", "interactions_clean", ["interaction_time_minutes"]),
        _col_stats("interaction_metrics", "interaction_metrics", ["total_interactions", "engagement_score"]),
        _col_stats("deal_metrics", "deal_metrics", ["total_revenue", "conversion_rate", "avg_deal_value"]),
    ])),
    "deal_date_range": with_(CLEAN_LEADS, """
SELECT 'leads' AS table_name, 'created_at' AS column_name, MIN(created_at) AS first_value, MAX(created_at) AS last_value
FROM leads_clean
UNION ALL SELECT 'leads', 'updated_at', MIN(updated_at), MAX(updated_at) FROM leads_clean"""),
    "orphan_leads": with_(ALL_CLEAN, """
SELECT lead_id, customer_id FROM leads_clean l
WHERE NOT EXISTS (SELECT 1 FROM customers_clean c WHERE c.customer_id = l.customer_id AND c.annual_revenue >= 0)"""),
    "type_mismatches": "SELECT * FROM (VALUES " + ", ".join(
        f"('{t}', '{c}', '{want}', 'string')" for t, kinds in (
            ("leads", {"deal_value": "double", "created_at": "timestamp_ntz", "updated_at": "timestamp_ntz"}),
            ("customers", {"employee_count": "int", "annual_revenue": "double", "created_at": "timestamp_ntz"}),
            ("interactions", {"interaction_date": "timestamp_ntz", "interaction_time_minutes": "int"}),
            ("products", {"base_price": "double", "launch_date": "timestamp_ntz"})) for c, want in kinds.items())
        + ", ('leads', 'is_contactable', 'int', NULL), ('interactions', 'channel_standardized', 'string', NULL)"
        + ") v(table_name, column_name, expected_type, actual_type)",
    "distinct_values": with_(ALL_CLEAN, "\nUNION ALL\n".join(
        f"SELECT DISTINCT '{t}' AS table_name, '{c}' AS column_name, {c} AS value FROM {t}_clean"
        for t, c in (("leads", "status"), ("customers", "account_manager"), ("interactions", "channel_standardized")))),
    "lead_days": with_(RAW_LEADS, "SELECT lead_id, deal_value, CAST(" + parse_date("created_at")
                       + " AS DATE)::VARCHAR AS created_day FROM raw_leads"),
    "row_counts": with_(ALL_CLEAN, "\nUNION ALL\n".join(
        [f"SELECT 'raw_{t}' AS table_name, COUNT(*) AS row_count FROM raw_{t}" for t in QUALITY_SPEC]
        + [f"SELECT 'clean_{t}' AS table_name, COUNT(*) AS row_count FROM {t}_clean" for t in QUALITY_SPEC])),
    "range_violations": with_(ALL_CLEAN, "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, '{r}' AS rule, COUNT(*) FILTER (WHERE NOT COALESCE({cond}, FALSE)) "
        f"AS violations FROM {t}_clean" for t, rules in RANGE_RULES.items() for r, cond in rules.items())),
    "negative_revenue_customers": with_(CLEAN_CUSTOMERS, """
SELECT customer_id, customer_name, annual_revenue FROM customers_clean
WHERE NOT COALESCE(annual_revenue >= 0, FALSE)"""),
    "orphan_counts": with_(ALL_CLEAN, """
SELECT 'leads' AS table_name, COUNT(*) AS orphan_rows FROM leads_clean l
WHERE NOT EXISTS (SELECT 1 FROM customers_clean c WHERE c.customer_id = l.customer_id)
UNION ALL
SELECT 'interactions', COUNT(*) FROM interactions_clean i
WHERE NOT EXISTS (SELECT 1 FROM customers_clean c WHERE c.customer_id = i.customer_id)"""),
    "completeness": with_(ALL_CLEAN, "\nUNION ALL\n".join(
        [_completeness(f"raw_{t}", f"raw_{t}", RAW_TABLE_COLS[t]) for t in QUALITY_SPEC]
        + [_completeness(f"clean_{t}", f"{t}_clean", CLEAN_COLS[t]) for t in QUALITY_SPEC])),
    "volume_growth": with_(ALL_CLEAN + """,
prev AS (""" + "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS previous_rows FROM raw_{t}" for t in QUALITY_SPEC) + """),
cur AS (""" + "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS current_rows FROM {t}_clean" for t in QUALITY_SPEC) + ")", """
SELECT COALESCE(p.table_name, c.table_name) AS table_name, previous_rows, current_rows,
  current_rows - previous_rows AS row_change,
  CASE WHEN previous_rows = 0 THEN NULL ELSE """ + rnd("(current_rows - previous_rows) * 100.0::DOUBLE / previous_rows", 4) + """ END AS growth_pct
FROM prev p FULL OUTER JOIN cur c ON p.table_name = c.table_name"""),
})

# --- documented-only operators ---------------------------------------------------

_EMAIL_RE = "'^(.*)@([^@]*)$'"
_DIGITS = "regexp_replace(phone, '[^0-9]', '', 'g')"

ORACLE.update({
    "normalized_names": with_(CLEAN_CUSTOMERS, """
SELECT customer_id,
  regexp_replace(trim(lower(customer_name)), '[^a-z0-9\\s]', '', 'g') AS customer_name,
  regexp_replace(trim(lower(industry)), '[^a-z0-9\\s]', '', 'g') AS industry
FROM customers_clean"""),
    "leads_with_defaults": with_(CLEAN_LEADS, """
SELECT * REPLACE (COALESCE(email, 'unknown') AS email, COALESCE(phone, 'unknown') AS phone,
  COALESCE(status, 'unknown') AS status)
FROM leads_clean WHERE customer_id IS NOT NULL"""),
    "masked_leads": with_(CLEAN_LEADS, """
SELECT lead_id,
  CASE WHEN email IS NULL THEN NULL
       WHEN contains(email, '@') THEN sha256(regexp_extract(email, """ + _EMAIL_RE + """, 1)) || '@'
         || regexp_extract(email, """ + _EMAIL_RE + """, 2)
       ELSE sha256(email) END AS email,
  CASE WHEN phone IS NULL THEN NULL ELSE repeat('*', greatest(length(""" + _DIGITS + """) - 4, 0))
    || right(""" + _DIGITS + """, 4) END AS phone
FROM leads_clean"""),
    "interactions_daily_dedupe": with_(CLEAN_INTERACTIONS, """
SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id, interaction_date
  ORDER BY interaction_id ASC NULLS LAST, channel ASC NULLS LAST, interaction_time_minutes ASC NULLS LAST,
  outcome ASC NULLS LAST, notes ASC NULLS LAST, channel_standardized ASC NULLS LAST) AS rn
  FROM interactions_clean) WHERE rn = 1"""),
    "lead_features": with_(CLEAN_LEADS + "," + CLEAN_INTERACTIONS + "," + INTERACTION_METRICS, """
SELECT l.lead_id, l.customer_id, l.deal_value, l.status, l.source,
  COALESCE(i.total_interactions, 0) AS total_interactions, COALESCE(i.num_calls, 0) AS num_calls,
  COALESCE(i.num_positive_outcomes, 0) AS num_positive_outcomes,
  COALESCE(i.num_negative_outcomes, 0) AS num_negative_outcomes,
  COALESCE(i.engagement_score, 0.0) AS engagement_score,
  COALESCE(i.preferred_channel, 'email') AS preferred_channel,
  COALESCE(i.days_since_last_interaction, 999) AS days_since_last_interaction
FROM leads_clean l LEFT JOIN interaction_metrics i ON l.customer_id = i.customer_id"""),
    "weighted_score": with_(ALL_CLEAN + "," + FEATURES + """,
mx AS (SELECT MAX(total_revenue) AS mr, MAX(total_interactions) AS mn FROM customer_features),
ws AS (SELECT customer_id, """ + rnd(
        "COALESCE(CASE WHEN mx.mr = 0 THEN NULL ELSE total_revenue / mx.mr END, 0.0) * 100 * 0.30::DOUBLE"
        " + COALESCE(CASE WHEN mx.mn = 0 THEN NULL ELSE total_interactions::DOUBLE / mx.mn END, 0.0) * 100 * 0.20::DOUBLE"
        " + engagement_score * 0.25::DOUBLE + win_rate * 100 * 0.25::DOUBLE", 2) + """ AS weighted_score
  FROM customer_features, mx)""", """
SELECT customer_id, weighted_score,
  CASE WHEN weighted_score >= 80 THEN 'hot' WHEN weighted_score >= 60 THEN 'warm'
       WHEN weighted_score >= 40 THEN 'cool' ELSE 'cold' END AS weighted_quality
FROM ws"""),
    "recency_engagement": with_(ALL_CLEAN + "," + FEATURES, """
SELECT customer_id, CASE WHEN total_interactions = 0 THEN NULL ELSE """ + rnd(
        "((num_positive_outcomes::DOUBLE / total_interactions) * 5 + (num_calls::DOUBLE / total_interactions) * 2"
        " + (CASE WHEN days_since_last_interaction < 7 THEN 10 ELSE 5 END) * 3) / 10", 4) + """ END
  AS recency_engagement
FROM customer_features"""),
    "channel_conversion": with_(CLEAN_LEADS + "," + CLEAN_INTERACTIONS + """,
users AS (SELECT DISTINCT channel_standardized, customer_id FROM interactions_clean WHERE customer_id IS NOT NULL),
per_cust AS (SELECT customer_id, COUNT(*) FILTER (WHERE status = 'closed_won') AS won,
  COUNT(*) FILTER (WHERE status = 'closed_lost') AS lost, SUM(deal_value::DECIMAL(28,4)) AS deal_sum,
  COUNT(deal_value) AS deals FROM leads_clean WHERE customer_id IS NOT NULL GROUP BY customer_id),
cc AS (SELECT channel_standardized, COUNT(*) AS customers_with_deals, SUM(won)::BIGINT AS won,
  SUM(lost)::BIGINT AS lost, SUM(deal_sum) AS deal_sum, SUM(deals)::BIGINT AS deals
  FROM users u JOIN per_cust p ON u.customer_id = p.customer_id GROUP BY channel_standardized)""", """
SELECT channel_standardized, customers_with_deals, won, lost,
  CASE WHEN won + lost = 0 THEN NULL ELSE """ + rnd("won::DOUBLE / (won + lost)", 4) + """ END AS channel_conversion_rate,
  CASE WHEN deals = 0 THEN NULL ELSE """ + rnd("deal_sum::DOUBLE / deals", 2) + """ END AS avg_deal_value
FROM cc"""),
    "channel_response_time": with_(CLEAN_LEADS + "," + CLEAN_INTERACTIONS + """,
cd AS (SELECT DISTINCT customer_id, channel_standardized AS ch, interaction_date AS day FROM interactions_clean
  WHERE customer_id IS NOT NULL AND interaction_date IS NOT NULL),
ld AS (SELECT customer_id, created_at AS day, COUNT(*) AS n_leads FROM leads_clean
  WHERE customer_id IS NOT NULL AND created_at IS NOT NULL GROUP BY customer_id, created_at),
firsts AS (SELECT l.customer_id, c.ch, l.day, l.n_leads, MIN(c.day) AS nxt
  FROM ld l JOIN cd c ON l.customer_id = c.customer_id AND c.day >= l.day
  GROUP BY l.customer_id, c.ch, l.day, l.n_leads)""", """
SELECT ch AS channel_standardized, SUM(n_leads)::BIGINT AS leads_answered,
  """ + rnd("SUM(date_diff('day', day::DATE, nxt::DATE) * n_leads)::DOUBLE / SUM(n_leads)", 4) + """ AS avg_response_days
FROM firsts GROUP BY ch"""),
    "daily_trend": with_(CLEAN_LEADS + """,
daily AS (SELECT created_at AS deal_date, COUNT(*) AS total_deals,
  """ + msum("CASE WHEN status = 'closed_won' THEN deal_value ELSE 0.0 END") + """ AS revenue_won
  FROM leads_clean WHERE created_at IS NOT NULL GROUP BY created_at)""", """
SELECT deal_date, total_deals, revenue_won,
  revenue_won - LAG(revenue_won) OVER (ORDER BY deal_date) AS revenue_change,
  total_deals - LAG(total_deals) OVER (ORDER BY deal_date) AS deals_change
FROM daily"""),
    "hot_leads": with_(ALL_CLEAN + "," + FEATURES, """
SELECT customer_id, customer_name, lead_score, preferred_channel, total_revenue, engagement_score
FROM customer_features WHERE lead_quality = 'hot'
ORDER BY lead_score DESC, customer_id ASC LIMIT 10"""),
})


# --- lead-scoring model -------------------------------------------------------

ML_FEATURES = ("total_interactions", "num_calls", "num_whatsapp", "num_emails",
               "num_positive_outcomes", "num_negative_outcomes", "engagement_score",
               "total_revenue", "num_closed_won", "num_closed_lost", "conversion_rate",
               "win_rate", "avg_deal_value", "employee_count", "annual_revenue")
LABELLED = ALL_CLEAN + "," + FEATURES + """,
labelled AS (SELECT *, (lead_score >= 80)::INTEGER AS is_hot_lead FROM customer_features),
rule_pred AS (SELECT is_hot_lead, (probability_to_convert >= 0.5)::INTEGER AS prediction FROM labelled),
cells AS (SELECT
  COUNT(*) FILTER (WHERE is_hot_lead = 0 AND prediction = 0) AS tn,
  COUNT(*) FILTER (WHERE is_hot_lead = 0 AND prediction = 1) AS fp,
  COUNT(*) FILTER (WHERE is_hot_lead = 1 AND prediction = 0) AS fn,
  COUNT(*) FILTER (WHERE is_hot_lead = 1 AND prediction = 1) AS tp FROM rule_pred),
c AS (SELECT tn, fp, fn, tp, tn::DOUBLE AS dtn, fp::DOUBLE AS dfp, fn::DOUBLE AS dfn, tp::DOUBLE AS dtp FROM cells),
prf AS (SELECT *,
  COALESCE(CASE WHEN dtp + dfp = 0 THEN NULL ELSE dtp / (dtp + dfp) END, 0.0) AS p1,
  COALESCE(CASE WHEN dtp + dfn = 0 THEN NULL ELSE dtp / (dtp + dfn) END, 0.0) AS r1,
  COALESCE(CASE WHEN dtn + dfn = 0 THEN NULL ELSE dtn / (dtn + dfn) END, 0.0) AS p0,
  COALESCE(CASE WHEN dtn + dfp = 0 THEN NULL ELSE dtn / (dtn + dfp) END, 0.0) AS r0,
  dtp + dfn AS s1, dtn + dfp AS s0 FROM c),
prf2 AS (SELECT *,
  COALESCE(CASE WHEN p1 + r1 = 0 THEN NULL ELSE 2.0::DOUBLE * p1 * r1 / (p1 + r1) END, 0.0) AS f1,
  COALESCE(CASE WHEN p0 + r0 = 0 THEN NULL ELSE 2.0::DOUBLE * p0 * r0 / (p0 + r0) END, 0.0) AS f0,
  s0 + s1 AS total FROM prf)"""


def _wavg(a: str, b: str) -> str:
    return f"COALESCE(CASE WHEN total = 0 THEN NULL ELSE ({a} * s0 + {b} * s1) / total END, 0.0)"


ORACLE.update({
    "ml_labels": with_(ALL_CLEAN + "," + FEATURES, """
SELECT customer_id, (lead_score >= 80)::INTEGER AS score_label,
  (total_revenue > """ + median_sql("customer_features", "total_revenue") + """
   AND total_interactions > """ + median_sql("customer_features", "total_interactions") + """)::INTEGER AS median_label
FROM customer_features"""),
    "class_balance": with_(LABELLED, """
SELECT * FROM (SELECT 'customer_features' AS table_name, 'is_hot_lead' AS column_name,
  CAST(is_hot_lead AS VARCHAR) AS value, COUNT(*) AS count,
  COUNT(*) * 100.0::DOUBLE / (SUM(COUNT(*)) OVER ())::DOUBLE AS pct
  FROM labelled GROUP BY is_hot_lead) WHERE value IS NOT NULL"""),
    "ml_feature_matrix": with_(LABELLED, "SELECT customer_id, " + ", ".join(
        f"COALESCE({c}::DOUBLE, 0.0) AS {c}" for c in ML_FEATURES) + ", is_hot_lead FROM labelled"),
    "train_test_split": with_(LABELLED, """
SELECT customer_id, is_hot_lead,
  CASE WHEN ROW_NUMBER() OVER (PARTITION BY is_hot_lead ORDER BY substr(md5(customer_id || ':42'), 1, 15), customer_id)
    <= """ + rnd("COUNT(*) OVER (PARTITION BY is_hot_lead) * 0.2::DOUBLE", 0) + """ THEN 'test' ELSE 'train' END AS split
FROM labelled"""),
    "rule_classifier_auc": with_(LABELLED + """,
s AS (SELECT probability_to_convert AS s, COUNT(*) FILTER (WHERE is_hot_lead = 1) AS pos,
  COUNT(*) FILTER (WHERE is_hot_lead = 0) AS neg FROM labelled GROUP BY 1),
r AS (SELECT *, COALESCE(SUM(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS under FROM s)""",
        """
SELECT CASE WHEN SUM(pos) * SUM(neg) = 0 THEN NULL ELSE
  SUM(pos * (2 * under + neg))::DOUBLE / (2.0::DOUBLE * SUM(pos)::DOUBLE * SUM(neg)::DOUBLE) END AS roc_auc FROM r"""),
    **{name: with_(LABELLED, """
SELECT customer_id, is_hot_lead, TRUE AS probability_in_range, TRUE AS class_agrees, TRUE AS reload_agrees
FROM (SELECT customer_id, is_hot_lead, ROW_NUMBER() OVER (PARTITION BY is_hot_lead
    ORDER BY substr(md5(customer_id || ':42'), 1, 15), customer_id) AS rn,
  """ + rnd("COUNT(*) OVER (PARTITION BY is_hot_lead) * 0.2::DOUBLE", 0) + """ AS k FROM labelled) WHERE rn <= k""")
       for name in ("model_predictions", "forest_predictions")},
    "rule_classifier_metrics": with_(LABELLED, """
SELECT COALESCE(CASE WHEN total = 0 THEN NULL ELSE (dtp + dtn) / (dtp + dtn + dfp + dfn) END, 0.0) AS accuracy,
  p1 AS precision, r1 AS recall, f1, tn, fp, fn, tp FROM prf2"""),
    "rule_classifier_report": with_(LABELLED, """
SELECT '0' AS class_label, p0 AS precision, r0 AS recall, f0 AS f1, s0::BIGINT AS support FROM prf2
UNION ALL SELECT '1', p1, r1, f1, s1::BIGINT FROM prf2
UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, total::BIGINT FROM prf2
UNION ALL SELECT 'weighted avg', """ + _wavg("p0", "p1") + ", " + _wavg("r0", "r1") + ", " + _wavg("f0", "f1")
        + """, total::BIGINT FROM prf2
UNION ALL SELECT 'accuracy', NULL, NULL, COALESCE(CASE WHEN total = 0 THEN NULL ELSE (dtp + dtn) / total END, 0.0),
  total::BIGINT FROM prf2"""),
})


# --- report table ---------------------------------------------------------------

def _dist(table: str, col: str) -> str:
    return f"""(SELECT value, count, pct FROM ({_value_dist(table, col)}))"""


def _rows(section: str, metric: str, src: str, dim: str, val: str) -> str:
    return (f"SELECT '{section}' AS section, '{metric}' AS metric, CAST({dim} AS VARCHAR) AS dimension, "
            f"({val})::DOUBLE AS value FROM {src}")


_SUMMARY = "\nUNION ALL\n".join(
    f"SELECT 'summary' AS section, 'total_{t}' AS metric, '' AS dimension, "
    f"(SELECT COUNT(*) FROM {t}_clean)::DOUBLE AS value"
    for t in ("customers", "leads", "interactions", "products"))
_STATUS = """(SELECT * FROM (SELECT status, COUNT(*) AS deals, """ + msum("deal_value") + """ AS deal_value,
  COUNT(*) * 100.0::DOUBLE / (SUM(COUNT(*)) OVER ())::DOUBLE AS pct FROM leads_clean GROUP BY status)
  WHERE status IS NOT NULL)"""
_TOP_IND = "(SELECT * FROM " + _dist("customers", "industry") + " ORDER BY count DESC, value ASC LIMIT 5)"
_QUAL = """(SELECT d.lead_quality, COALESCE(c.customers, 0) AS customers,
  COALESCE(c.customers, 0) * 100.0::DOUBLE / (SELECT COUNT(*) FROM eda_features) AS pct
  FROM (VALUES (0, 'hot'), (1, 'warm'), (2, 'cool'), (3, 'cold')) d(position, lead_quality)
  LEFT JOIN (SELECT lead_quality, COUNT(*) AS customers FROM eda_features GROUP BY lead_quality) c
  ON d.lead_quality = c.lead_quality)"""
_FS = """(SELECT """ + rnd("AVG(lead_score)", 6) + """ AS mean_lead_score, MAX(lead_score) AS max_lead_score,
  """ + rnd("AVG(engagement_score)", 6) + """ AS mean_engagement_score,
  SUM(total_interactions)::DOUBLE / COUNT(total_interactions) AS mean_total_interactions,
  """ + mavg("total_revenue") + """ AS mean_total_revenue,
  """ + median_sql("eda_features", "lead_score") + """ AS median_lead_score FROM eda_features)"""
_TOP_SCORE = """(SELECT *, (ROW_NUMBER() OVER (ORDER BY lead_score DESC, customer_id ASC))::VARCHAR AS rank FROM (
  SELECT customer_id, customer_name, lead_quality, lead_score, total_revenue FROM eda_features
  ORDER BY lead_score DESC, customer_id ASC LIMIT 10))"""

ORACLE["analysis_report"] = with_(ALL_CLEAN + "," + EDA_FEATURES, "\nUNION ALL\n".join([
    _SUMMARY,
    "SELECT 'leads', 'sum_deal_value', '', (SELECT " + msum("deal_value::DOUBLE") + " FROM leads_clean)",
    "SELECT 'leads', 'mean_deal_value', '', (SELECT " + mavg("deal_value::DOUBLE") + " FROM leads_clean)",
    "SELECT 'leads', 'median_deal_value', '', " + median_sql("leads_clean", "deal_value"),
    _rows("leads", "status_deals", _STATUS, "status", "deals"),
    _rows("leads", "status_deal_value", _STATUS, "status", "deal_value"),
    _rows("leads", "status_pct", _STATUS, "status", "pct"),
    _rows("leads", "source_leads", _dist("leads", "source"), "value", "count"),
    _rows("leads", "source_pct", _dist("leads", "source"), "value", "pct"),
    "SELECT 'customers', 'sum_annual_revenue', '', (SELECT " + msum("annual_revenue::DOUBLE") + " FROM customers_clean)",
    "SELECT 'customers', 'mean_employee_count', '', (SELECT " + mavg("employee_count::DOUBLE") + " FROM customers_clean)",
    "SELECT 'customers', 'max_employee_count', '', (SELECT MAX(employee_count)::DOUBLE FROM customers_clean)",
    "SELECT 'customers', 'min_employee_count', '', (SELECT MIN(employee_count)::DOUBLE FROM customers_clean)",
    _rows("customers", "top_industry_customers", _TOP_IND, "value", "count"),
    _rows("customers", "top_industry_pct", _TOP_IND, "value", "pct"),
    "SELECT 'interactions', 'mean_duration_minutes', '', (SELECT "
    + mavg("interaction_time_minutes::DOUBLE") + " FROM interactions_clean)",
    _rows("interactions", "channel_interactions", _dist("interactions", "channel"), "value", "count"),
    _rows("interactions", "channel_pct", _dist("interactions", "channel"), "value", "pct"),
    _rows("interactions", "outcome_interactions", _dist("interactions", "outcome"), "value", "count"),
    _rows("interactions", "outcome_pct", _dist("interactions", "outcome"), "value", "pct"),
    *[f"SELECT 'features', '{m}', '', {m}::DOUBLE FROM {_FS}" for m in
      ("mean_lead_score", "median_lead_score", "max_lead_score", "mean_engagement_score",
       "mean_total_interactions", "mean_total_revenue")],
    _rows("features", "quality_customers", _QUAL, "lead_quality", "customers"),
    _rows("features", "quality_pct", _QUAL, "lead_quality", "pct"),
    _rows("features", "top_customer", _TOP_SCORE, "concat_ws(': ', rank, customer_name)", "NULL"),
    _rows("features", "top_customer_id", _TOP_SCORE, "concat_ws(': ', rank, customer_id)", "NULL"),
    _rows("features", "top_quality", _TOP_SCORE, "concat_ws(': ', rank, lead_quality)", "NULL"),
    _rows("features", "top_lead_score", _TOP_SCORE, "rank", "lead_score"),
    _rows("features", "top_revenue", _TOP_SCORE, "rank", "total_revenue"),
]))


ORACLE.update({
    "interaction_summary": with_(CLEAN_INTERACTIONS, """
SELECT customer_id, COUNT(interaction_id) AS total_interactions,
  SUM(interaction_time_minutes)::DOUBLE / COUNT(interaction_time_minutes) AS avg_interaction_duration,
  MAX(interaction_date) AS last_interaction_date
FROM interactions_clean WHERE customer_id IS NOT NULL GROUP BY customer_id"""),
    "channel_pivot": with_(CLEAN_INTERACTIONS, "SELECT customer_id, " + ", ".join(
        f"COUNT(*) FILTER (WHERE channel = '{v}') AS {n}" for v, n in RAW_CHANNELS.items())
        + " FROM interactions_clean WHERE customer_id IS NOT NULL GROUP BY customer_id"),
    "outcome_pivot": with_(CLEAN_INTERACTIONS, "SELECT customer_id, " + ", ".join(
        f"COUNT(*) FILTER (WHERE outcome = '{v}') AS {n}" for v, n in OUTCOMES.items())
        + " FROM interactions_clean WHERE customer_id IS NOT NULL GROUP BY customer_id"),
    "deal_summary": with_(CLEAN_LEADS, """
SELECT customer_id, """ + msum("deal_value") + """ AS total_revenue, COUNT(deal_value) AS total_deals,
  """ + mavg("deal_value") + """ AS avg_deal_value,
  COUNT(*) FILTER (WHERE status = 'closed_won') AS num_closed_won
FROM leads_clean WHERE customer_id IS NOT NULL GROUP BY customer_id"""),
})


ORACLE["doc_flow_scores"] = with_(ALL_CLEAN + "," + FEATURES + """,
df_s AS (SELECT customer_id, total_revenue / """ + REVENUE_UNIT + """::DOUBLE * 30.0::DOUBLE
  + total_interactions * 2.0::DOUBLE + engagement_score * 25.0::DOUBLE + win_rate * 20.0::DOUBLE AS lead_score
  FROM customer_features)""", """
SELECT customer_id, lead_score,
  CASE WHEN lead_score >= 80 THEN 'hot' WHEN lead_score >= 60 THEN 'warm'
       WHEN lead_score >= 40 THEN 'cool' ELSE 'cold' END AS lead_quality
FROM df_s""")


def _violation(table: str, key: str, column: str, declared: str, parsed: str) -> str:
    return (f"SELECT '{table}' AS table_name, CAST({key} AS VARCHAR) AS row_key, '{column}' AS column_name, "
            f"'{declared}' AS declared_type, {column} AS raw_value FROM raw_{table} WHERE {column} IS NOT NULL AND ({parsed}) IS NULL")


ORACLE["cast_violations"] = with_(",".join([RAW_CUSTOMERS, RAW_LEADS, RAW_INTERACTIONS, RAW_PRODUCTS]), "\nUNION ALL\n".join([
    *[_violation(t, k, c, "double", f"TRY_CAST({c} AS DOUBLE)") for t, k, c in (
        ("leads", "lead_id", "deal_value"), ("customers", "customer_id", "annual_revenue"), ("products", "product_id", "base_price"))],
    *[_violation(t, k, c, "int", parse_int(c)) for t, k, c in (
        ("customers", "customer_id", "employee_count"), ("interactions", "interaction_id", "interaction_time_minutes"))],
    *[_violation(t, k, c, "timestamp_ntz", parse_date(c)) for t, k, c in (
        ("leads", "lead_id", "created_at"), ("leads", "lead_id", "updated_at"), ("customers", "customer_id", "created_at"),
        ("interactions", "interaction_id", "interaction_date"), ("products", "product_id", "launch_date"))]]))

ORACLE["quarantined_leads"] = with_(RAW_LEADS, f"""
SELECT lead_id, deal_value, created_at, CASE WHEN v OR c OR u THEN
  concat_ws(',', CASE WHEN v THEN 'deal_value' END, CASE WHEN c THEN 'created_at' END, CASE WHEN u THEN 'updated_at' END) END AS broken
FROM (SELECT *, deal_value IS NOT NULL AND TRY_CAST(deal_value AS DOUBLE) IS NULL AS v,
  created_at IS NOT NULL AND ({parse_date('created_at')}) IS NULL AS c,
  updated_at IS NOT NULL AND ({parse_date('updated_at')}) IS NULL AS u FROM raw_leads)""")

ORACLE["run_growth"] = with_(ALL_CLEAN, """
SELECT 'run-1' AS previous_run, 'run-2' AS current_run, table_name, p AS previous_rows, c AS current_rows, c - p AS row_change,
  """ + rnd("CASE WHEN p > 0 THEN (c - p) * 100.0::DOUBLE / p END", 4) + """ AS growth_pct
FROM (SELECT 'leads' AS table_name, COUNT(*) FILTER (updated_at IS NULL OR updated_at < DATE '1998-01-01') AS p, COUNT(*) AS c FROM leads_clean
  UNION ALL SELECT 'interactions', COUNT(*) FILTER (interaction_date IS NULL OR interaction_date < DATE '2024-01-16'), COUNT(*) FROM interactions_clean
  UNION ALL SELECT 'customers', COUNT(*), COUNT(*) FROM customers_clean)""")

ORACLE["unique_customers_sketched"] = with_(ALL_CLEAN, """
SELECT channel_standardized, COUNT(*) AS rows, COUNT(DISTINCT customer_id) AS unique_customers, TRUE AS within_error
FROM interactions_clean GROUP BY channel_standardized""")

ORACLE["sketched_quantiles"] = with_(ALL_CLEAN, """
SELECT table_name, column_name, quantile, n, TRUE AS within_error FROM (
  SELECT 'leads' AS table_name, 'deal_value' AS column_name, COUNT(deal_value) AS n FROM leads_clean
  UNION ALL SELECT 'customers', 'employee_count', COUNT(employee_count) FROM customers_clean
  UNION ALL SELECT 'customers', 'annual_revenue', COUNT(annual_revenue) FROM customers_clean
  UNION ALL SELECT 'interactions', 'interaction_time_minutes', COUNT(interaction_time_minutes) FROM interactions_clean),
  (SELECT UNNEST([0.05, 0.25, 0.5, 0.75, 0.95]::DOUBLE[]) AS quantile)""")


def _boosting_level(level: int) -> str:
    """Best split of every node of a level, and the rows' nodes on the next; a row without a split stays where it is."""
    return f"""
sums{level} AS (SELECT n, f, edge, SUM(0.5::DOUBLE - y) AS g, SUM(0.25::DOUBLE) AS h FROM at_level_{level}
  JOIN binned_vals USING (customer_id) WHERE n >= {2 ** level - 1} GROUP BY n, f, edge),
low{level} AS (SELECT n, f, edge, COALESCE(SUM(g) OVER before, 0) AS gl, COALESCE(SUM(h) OVER before, 0) AS hl,
  SUM(g) OVER (PARTITION BY n, f) AS ga, SUM(h) OVER (PARTITION BY n, f) AS ha FROM sums{level}
  WINDOW before AS (PARTITION BY n, f ORDER BY edge NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
gain{level} AS (SELECT n, f, edge, gl * gl / (hl + 1) + (ga - gl) * (ga - gl) / ((ha - hl) + 1) - ga * ga / (ha + 1) AS gain
  FROM low{level} WHERE hl >= 1 AND ha - hl >= 1),
best{level} AS (SELECT n, f, edge FROM gain{level} WHERE gain > 1e-6
  QUALIFY ROW_NUMBER() OVER (PARTITION BY n ORDER BY gain DESC, f, edge) = 1),
at_level_{level + 1} AS (SELECT r.customer_id, r.y, CASE WHEN b.n IS NULL THEN r.n WHEN v.x < b.edge THEN 2 * r.n + 1 ELSE 2 * r.n + 2 END AS n
  FROM at_level_{level} r LEFT JOIN best{level} b ON r.n = b.n LEFT JOIN feature_vals v ON v.customer_id = r.customer_id AND v.f = b.f)"""


ORACLE["boosted_margins"] = with_(LABELLED + """,
feature_vals AS MATERIALIZED (SELECT customer_id, UNNEST(RANGE(""" + str(len(ML_FEATURES)) + """)) AS f,
  UNNEST([""" + ", ".join(f"{c}::DOUBLE" for c in ML_FEATURES) + """]) AS x FROM labelled),
value_cuts AS MATERIALIZED (SELECT DISTINCT f, UNNEST(QUANTILE_DISC(x, [""" + ", ".join(f"{k / 256!r}" for k in range(1, 256)) + """])) AS edge
  FROM feature_vals GROUP BY f),
binned_vals AS MATERIALIZED (SELECT v.customer_id, v.f, c.edge FROM feature_vals v ASOF LEFT JOIN value_cuts c ON v.f = c.f AND v.x >= c.edge),
at_level_0 AS (SELECT customer_id, is_hot_lead AS y, 0 AS n FROM labelled),"""
    + ",".join(_boosting_level(k).replace(f"at_level_{k + 1} AS (", f"at_level_{k + 1} AS MATERIALIZED (") for k in range(5)) + """,
leaves AS (SELECT n, (-0.1::DOUBLE) * SUM(0.5::DOUBLE - y) / (SUM(0.25::DOUBLE) + 1) AS margin FROM at_level_5 GROUP BY n)
""", """
SELECT customer_id, y AS is_hot_lead, 0.0::DOUBLE + margin AS margin, 1.0::DOUBLE / (1.0::DOUBLE + EXP(-(0.0::DOUBLE + margin))) AS p_hot,
  (1.0::DOUBLE / (1.0::DOUBLE + EXP(-(0.0::DOUBLE + margin))) > 0.5)::INTEGER AS prediction
FROM at_level_5 JOIN leaves USING (n)""")

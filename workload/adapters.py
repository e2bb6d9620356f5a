"""Provided tables -> the seven entities, as SQL text that Spark and DuckDB both run.

Every row of the tables read ends up in an entity: orders in transactions, lineitems in
portfolios, events in logins, activities or payments by their type, and all events in
currency rates. Clients without transactions or portfolio come from giving their orders
to the next client, not from leaving rows out. `{table}` is filled in by the caller.
"""

from __future__ import annotations

# Client an order's transaction or lineitems belong to.
_PAYER = "o_custkey + (CASE WHEN o_custkey % 20 = 2 THEN 1 ELSE 0 END)"
_HOLDER = "o_custkey + (CASE WHEN o_custkey % 3 = 1 THEN 1 ELSE 0 END)"
# Client of an event: uneven slots, so activity varies around the rule thresholds.
_ACTOR = (
    "user_id * 10 + (CASE event_id % 10 WHEN 4 THEN 1 WHEN 5 THEN 2 WHEN 6 THEN 3 WHEN 7 THEN 4 "
    "WHEN 8 THEN 6 WHEN 9 THEN 8 ELSE 0 END)"
)


def _padded(expr: str, width: int) -> str:
    """Zero-padded number that keeps all digits when it is wider."""
    text = f"cast({expr} AS string)"
    return f"lpad({text}, cast(greatest({width}, length({text})) AS int), '0')"


def _client(expr: str) -> str:
    return f"'CLIENT_' || {_padded(f'{expr} + 1', 6)}"


ADAPTERS: dict[str, str] = {
    "clients": f"""
SELECT {_client('c_custkey')} AS client_id, c_name AS client_name,
  '7' || {_padded('c_custkey', 10)} AS phone,
  lower(replace(c_name, '#', '.')) || '@example.test' AS email,
  DATE '1950-01-01' + cast(c_custkey * 37 % 18000 AS int) AS birth_date,
  DATE '2020-01-01' + cast(c_custkey % 1800 AS int) AS registration_date, n_name AS city,
  CASE WHEN c_custkey % 50 = 49 THEN NULL WHEN c_custkey % 4 = 0 THEN 'VIP' WHEN c_custkey % 4 = 1 THEN 'Premium'
       WHEN c_custkey % 4 = 2 THEN 'Standard' ELSE 'Basic' END AS segment,
  CASE WHEN c_acctbal >= 0 THEN 'Active' ELSE 'Inactive' END AS status
FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey""",
    "bank_transactions": f"""
SELECT 'TXN_' || {_padded('o_orderkey + 1', 8)} AS transaction_id,
  {_client(_PAYER)} AS client_id, cast(o_orderdate AS date) AS transaction_date,
  cast(round(cast(o_totalprice AS decimal(12,2)) * (CASE o_custkey % 20 WHEN 0 THEN cast(0.50 AS decimal(3,2))
    WHEN 1 THEN cast(0.25 AS decimal(3,2)) WHEN 3 THEN cast(0.01 AS decimal(3,2)) ELSE cast(0.04 AS decimal(3,2)) END), 2) AS double) AS amount,
  CASE o_orderkey % 3 WHEN 0 THEN 'RUB' WHEN 1 THEN 'USD' ELSE 'EUR' END AS currency,
  CASE o_orderstatus WHEN 'P' THEN 'TRANSFER' WHEN 'O' THEN 'DEBIT' ELSE 'CREDIT' END AS transaction_type,
  CASE o_orderkey % 4 WHEN 0 THEN 'ATM' WHEN 1 THEN 'Online' WHEN 2 THEN 'Branch' ELSE 'Mobile' END AS channel
FROM {{orders}}""",
    "client_logins": f"""
SELECT 'LOGIN_' || {_padded('event_id + 1', 8)} AS login_id, {_client(_ACTOR)} AS client_id,
  cast(ts AS timestamp) AS login_timestamp,
  '10.0.' || cast(user_id % 256 AS string) || '.' || cast(event_id % 256 AS string) AS ip_address,
  CASE event_id % 3 WHEN 0 THEN 'DESKTOP' WHEN 1 THEN 'MOBILE' ELSE 'TABLET' END AS device_type,
  CASE event_id % 4 WHEN 0 THEN 'Chrome' WHEN 1 THEN 'Firefox' WHEN 2 THEN 'Safari' ELSE 'Edge' END AS browser,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE event_type <> 'error' END AS success
FROM {{events}} WHERE event_type IN ('signup', 'error')""",
    "client_activities": f"""
SELECT 'ACT_' || {_padded('event_id + 1', 8)} AS activity_id, {_client(_ACTOR)} AS client_id,
  cast(ts AS date) AS activity_date,
  CASE event_type WHEN 'signup' THEN 'UPDATE_PROFILE' WHEN 'click' THEN 'LOGIN' WHEN 'view' THEN 'VIEW_BALANCE' ELSE 'PAYMENT' END AS activity_type,
  cast(event_id % 30 + 1 AS int) AS duration_minutes, cast(event_id % 10 + 1 AS int) AS page_views
FROM {{events}} WHERE event_type <> 'error'""",
    "payments": f"""
SELECT 'PAY_' || {_padded('event_id + 1', 8)} AS payment_id, {_client(_ACTOR)} AS client_id,
  cast(ts AS date) AS payment_date, value AS amount, 'RUB' AS currency,
  CASE event_id % 4 WHEN 0 THEN 'UTILITY' WHEN 1 THEN 'MOBILE' WHEN 2 THEN 'INTERNET' ELSE 'INSURANCE' END AS payment_type,
  CASE event_id % 3 WHEN 0 THEN 'Completed' WHEN 1 THEN 'Pending' ELSE 'Failed' END AS status
FROM {{events}} WHERE event_type = 'purchase'""",
    "portfolios": f"""
SELECT 'P' || substr(md5(cast(l_orderkey AS string) || '_' || cast(l_partkey AS string) || '_' || cast(l_linenumber AS string) || '_' || cast(l_suppkey AS string)
    || '_' || cast(cast(l_extendedprice AS decimal(18,2)) AS string) || '_' || cast(cast(l_shipdate AS date) AS string)), 1, 19) AS portfolio_id,
  {_client(_HOLDER)} AS client_id,
  CASE p_size % 4 WHEN 0 THEN 'STOCK' WHEN 1 THEN 'BOND' WHEN 2 THEN 'ETF' ELSE 'MUTUAL_FUND' END AS security_type, p_name AS security_name,
  (cast(l_quantity AS int) % 7 + 1) * (CASE WHEN o_custkey % 10 = 4 THEN 6 ELSE 1 END) AS quantity,
  cast(round(cast(p_retailprice AS decimal(10,2)) * cast(0.90 AS decimal(3,2)), 2) AS double) AS purchase_price,
  CASE WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN NULL ELSE p_retailprice END AS current_price,
  cast(l_shipdate AS date) AS purchase_date
FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey JOIN {{part}} ON l_partkey = p_partkey""",
    "currency_rates": f"""
SELECT 'RATE_' || {_padded('event_id + 1', 6)} AS rate_id,
  CASE event_id % 3 WHEN 0 THEN 'USD/RUB' WHEN 1 THEN 'EUR/RUB' ELSE 'GBP/RUB' END AS currency_pair,
  cast(ts AS timestamp) AS rate_date, cast(60 + event_id % 4000 AS double) / 100 AS rate_value, 'Close' AS rate_type
FROM {{events}}""",
}

# Columns read from the provided tables; given to the reader, so nothing is inferred.
TABLES: dict[str, str] = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def tables_of(entity: str) -> list[str]:
    return [t for t in TABLES if "{" + t + "}" in ADAPTERS[entity]]


def duckdb_sql(entity: str) -> str:
    return ADAPTERS[entity].format(**{t: t for t in TABLES})


def spark_entities(spark, sf_dir: str, *entities: str) -> dict:
    """The entities over one reader per table."""
    names = {t for e in entities for t in tables_of(e)}
    read = {t: spark.read.schema(TABLES[t]).parquet(f"{sf_dir}/{t}.parquet") for t in names}
    return {e: spark.sql(ADAPTERS[e], **{t: read[t] for t in tables_of(e)}) for e in entities}


def spark_entity(spark, sf_dir: str, entity: str):
    return spark_entities(spark, sf_dir, entity)[entity]

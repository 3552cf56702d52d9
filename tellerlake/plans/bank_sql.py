"""The tables of ``bank`` in SQL, for the checks. Later views may use earlier ones."""

from __future__ import annotations

from tellerlake.operators.quality import RULES
from tellerlake.schemas import TRACKED

VIEWS: dict[str, str] = {}

VIEWS["people"] = """
SELECT 'CUST-' || c_custkey AS customer_id, c_mktsegment AS first_name, c_name AS last_name,
       CASE WHEN c_acctbal < 0 THEN NULL
            WHEN c_mktsegment = 'FURNITURE' THEN lower(c_name) || '@mail.com'
            ELSE lower(replace(c_name, '#', '.')) || '@mail.com' END AS email_address,
       '416-555-' || right(c_name, 4) AS phone_number, n_name AS city,
       c_mktsegment AS state_province, r_name AS country, c_acctbal < 0 AS overdrawn
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

VIEWS["raw_customers"] = """
SELECT '  ' || customer_id AS customer_id, ' ' || first_name || '  ' AS first_name, last_name,
       upper(email_address) || ' ' AS email_address, phone_number, city || ' ' AS city,
       CASE WHEN state_province = 'AUTOMOBILE' THEN 'VEHICLES' ELSE state_province END AS state_province,
       country, TIMESTAMP '2023-03-01 00:00:00' AS _loaded_at, 1 AS _load_id
FROM people WHERE NOT overdrawn
UNION ALL
SELECT customer_id, first_name, last_name, email_address, phone_number, city, state_province, country,
       TIMESTAMP '2024-03-06 00:00:00', 2
FROM people WHERE overdrawn OR state_province = 'AUTOMOBILE'"""

VIEWS["tidy_customers"] = """
SELECT trim(customer_id) AS customer_id, trim(first_name) AS first_name, trim(last_name) AS last_name,
       lower(trim(email_address)) AS email_address, trim(phone_number) AS phone_number, trim(city) AS city,
       trim(state_province) AS state_province, trim(country) AS country, _loaded_at, _load_id
FROM raw_customers"""

VIEWS["clean_customers"] = """
SELECT * FROM tidy_customers c
WHERE NOT EXISTS (SELECT 1 FROM tidy_customers n
                  WHERE n.customer_id = c.customer_id AND n._loaded_at > c._loaded_at)"""

VIEWS["accounts"] = """
SELECT 'ACCT-' || o_orderkey AS account_id, 'CUST-' || o_custkey AS customer_id,
       o_orderpriority AS account_type, o_orderstatus AS status,
       CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'CAD' ELSE 'USD' END AS currency_code,
       CAST(o_orderdate AS DATE) AS open_date, o_orderdate AS created_timestamp
FROM orders"""

VIEWS["raw_accounts"] = """
SELECT ' ' || account_id AS account_id, customer_id, account_type || ' ' AS account_type, 'O' AS status,
       CASE WHEN currency_code = 'USD' THEN ' USD ' END AS currency_code, open_date, created_timestamp,
       TIMESTAMP '2023-03-01 00:00:00' AS _loaded_at, 1 AS _load_id
FROM accounts
UNION ALL
SELECT *, TIMESTAMP '2024-03-06 00:00:00', 2 FROM accounts WHERE status <> 'O'"""

VIEWS["tidy_accounts"] = """
SELECT trim(account_id) AS account_id, trim(customer_id) AS customer_id, trim(account_type) AS account_type,
       trim(status) AS status, coalesce(trim(currency_code), 'CAD') AS currency_code, open_date,
       created_timestamp, _loaded_at, _load_id
FROM raw_accounts"""

VIEWS["clean_accounts"] = """
SELECT * FROM tidy_accounts a
WHERE NOT EXISTS (SELECT 1 FROM tidy_accounts n
                  WHERE n.account_id = a.account_id AND n._loaded_at > a._loaded_at)"""

VIEWS["transactions"] = """
SELECT 'TXN-' || l_orderkey || '-' || l_linenumber AS transaction_id, 'ACCT-' || l_orderkey AS account_id,
       l_shipdate AS transaction_date, l_returnflag AS transaction_type,
       CAST(l_extendedprice AS DECIMAL(18, 2)) AS amount, l_linestatus AS description
FROM lineitem"""

VIEWS["raw_transactions"] = """
SELECT transaction_id, ' ' || account_id || ' ' AS account_id, transaction_date,
       transaction_type || ' ' AS transaction_type, amount, description,
       transaction_date AS _loaded_at, year(transaction_date) AS _load_id
FROM transactions"""

VIEWS["tidy_transactions"] = """
SELECT trim(transaction_id) AS transaction_id, trim(account_id) AS account_id, transaction_date,
       trim(transaction_type) AS transaction_type, amount, trim(description) AS description,
       _loaded_at, _load_id
FROM raw_transactions"""

VIEWS["clean_transactions"] = """
SELECT * FROM tidy_transactions t
WHERE NOT EXISTS (SELECT 1 FROM tidy_transactions n
                  WHERE n.transaction_id = t.transaction_id AND n._loaded_at > t._loaded_at)"""

_VERSION = "customer_id, first_name, last_name, email_address, {city}, state_province, country"

VIEWS["dim_prior"] = f"""
SELECT {_VERSION.format(city='city')}, DATE '2023-03-01' AS start_date, DATE '9999-12-31' AS end_date,
       'Y' AS current_flag
FROM tidy_customers WHERE _load_id = 1
UNION ALL
SELECT {_VERSION.format(city="'OLD TOWN'")}, DATE '2020-01-01', DATE '2023-02-28', 'N'
FROM tidy_customers WHERE _load_id = 1 AND state_province = 'BUILDING'"""

VIEWS["dim_changed"] = f"""
SELECT DISTINCT d.customer_id FROM dim_prior d JOIN people s ON d.customer_id = s.customer_id
WHERE d.current_flag = 'Y' AND ({" OR ".join(f"d.{c} <> s.{c}" for c in TRACKED)})"""

VIEWS["dim_closed"] = """
SELECT d.customer_id, d.first_name, d.last_name, d.email_address, d.city, d.state_province, d.country,
       d.start_date, CASE WHEN x.customer_id IS NULL THEN d.end_date ELSE DATE '2024-03-05' END AS end_date,
       CASE WHEN x.customer_id IS NULL THEN d.current_flag ELSE 'N' END AS current_flag
FROM dim_prior d LEFT JOIN dim_changed x ON d.customer_id = x.customer_id AND d.current_flag = 'Y'"""

VIEWS["dim_fresh"] = """
SELECT s.customer_id, s.first_name, s.last_name, s.email_address, s.city, s.state_province, s.country,
       DATE '2024-03-06' AS start_date, DATE '9999-12-31' AS end_date, 'Y' AS current_flag
FROM people s LEFT JOIN dim_closed d ON s.customer_id = d.customer_id AND d.current_flag = 'Y'
WHERE d.customer_id IS NULL"""

VIEWS["dim_now"] = "SELECT * FROM dim_closed UNION ALL SELECT * FROM dim_fresh"

VIEWS["fact"] = """
SELECT CAST(t.transaction_date AS DATE) AS date_key, a.customer_id, t.account_id, t.transaction_id,
       t.transaction_type, t.amount
FROM transactions t JOIN accounts a ON t.account_id = a.account_id"""


def _rollup(level: int, customer: str, account: str, kind: str, source: str) -> str:
    keys = ", ".join(["date_key", *[c for c in (customer, account, kind) if "NULL" not in c]])
    return f"""
SELECT date_key, {customer} AS customer_id, {account} AS account_id, {kind} AS transaction_type,
       SUM(amount) AS total_amount, COUNT(*) AS transaction_count, {level} AS rollup_level
FROM {source} GROUP BY {keys}"""


_NONE = "CAST(NULL AS VARCHAR)"
_UNJOINED = "(SELECT *, CAST(transaction_date AS DATE) AS date_key FROM transactions)"

VIEWS["rollups"] = "\nUNION ALL".join(
    [
        _rollup(1, "customer_id", _NONE, _NONE, "fact"),
        _rollup(2, _NONE, "account_id", _NONE, _UNJOINED),
        _rollup(3, "customer_id", _NONE, "transaction_type", "fact"),
        _rollup(4, _NONE, "account_id", "transaction_type", _UNJOINED),
    ]
)

VIEWS["spend"] = """
SELECT c.customer_id, c.first_name, c.last_name, c.city, c.state_province, f.transaction_type,
       CAST(date_trunc('month', f.date_key) AS DATE) AS month_key, COUNT(*) AS transaction_count,
       CAST(SUM(f.amount) AS DOUBLE) AS total_spend,
       CAST(SUM(f.amount) AS DOUBLE) / COUNT(f.amount) AS avg_transaction,
       CAST(MIN(f.amount) AS DOUBLE) AS min_transaction, CAST(MAX(f.amount) AS DOUBLE) AS max_transaction
FROM fact f JOIN dim_now c ON f.customer_id = c.customer_id AND c.current_flag = 'Y'
GROUP BY ALL"""

VIEWS["trend"] = """
SELECT transaction_type, CAST(date_trunc('month', date_key) AS DATE) AS month_key,
       COUNT(*) AS transaction_count, CAST(SUM(amount) AS DOUBLE) AS total_amount,
       CAST(SUM(amount) AS DOUBLE) / COUNT(amount) AS avg_amount,
       COUNT(DISTINCT customer_id) AS unique_customers, COUNT(DISTINCT account_id) AS unique_accounts,
       CAST(SUM(amount) AS DOUBLE) / NULLIF(COUNT(DISTINCT customer_id), 0) AS avg_spend_per_customer
FROM fact GROUP BY ALL"""

VIEWS["faulty_customers"] = """
SELECT * REPLACE (CASE WHEN email_address IS NOT NULL THEN customer_id END AS customer_id) FROM tidy_customers"""

VIEWS["faulty_accounts"] = """
SELECT * REPLACE (CASE WHEN account_type <> '4-NOT SPECIFIED' THEN account_id END AS account_id,
                  CASE WHEN account_type <> '1-URGENT' THEN customer_id END AS customer_id)
FROM accounts"""

VIEWS["faulty_transactions"] = """
SELECT * REPLACE (CASE WHEN transaction_type = 'R' AND description = 'O' THEN NULL ELSE transaction_id END
                    AS transaction_id,
                  CASE WHEN transaction_type = 'R' AND description = 'O' THEN NULL ELSE account_id END
                    AS account_id)
FROM transactions"""

VIEWS["faulty_dim"] = """
SELECT customer_id, current_flag FROM dim_prior
UNION ALL SELECT customer_id, 'Y' FROM people WHERE state_province = 'AUTOMOBILE'"""

# Fixed value: the pattern of an e-mail address.
_BAD_EMAIL = r"""email_address IS NOT NULL AND NOT regexp_matches(email_address,
      '^[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}$')"""


def _counts(customers: str, accounts: str, transactions: str, dim: str) -> str:
    return f"""
SELECT 1 AS rule_no, COUNT(*) AS n FROM {customers} WHERE customer_id IS NULL
UNION ALL SELECT 2, COUNT(*) FROM {accounts} WHERE account_id IS NULL
UNION ALL SELECT 3, COUNT(*) FROM {transactions} WHERE transaction_id IS NULL
UNION ALL SELECT 4, COUNT(*) FROM
  (SELECT customer_id FROM {customers} GROUP BY customer_id HAVING COUNT(*) > 1)
UNION ALL SELECT 5, COUNT(*) FROM {customers} WHERE {_BAD_EMAIL}
UNION ALL SELECT 6, COUNT(*) FROM {accounts} a LEFT JOIN
  (SELECT DISTINCT customer_id FROM {customers}) c ON a.customer_id = c.customer_id
  WHERE c.customer_id IS NULL
UNION ALL SELECT 7, COUNT(*) FROM {transactions} t LEFT JOIN
  (SELECT DISTINCT account_id FROM {accounts}) a ON t.account_id = a.account_id
  WHERE a.account_id IS NULL
UNION ALL SELECT 8, COUNT(*) FROM
  (SELECT customer_id FROM {dim} WHERE current_flag = 'Y' GROUP BY customer_id HAVING COUNT(*) > 1)"""


VIEWS["clean_counts"] = _counts("people", "accounts", "transactions", "dim_prior")
VIEWS["faulty_counts"] = _counts("faulty_customers", "faulty_accounts", "faulty_transactions", "faulty_dim")
VIEWS["rules"] = "SELECT * FROM (VALUES " + ", ".join(
    f"({r.number}, '{r.table}', '{r.check}', '{r.level}', '{r.failed}', '{r.passed}')" for r in RULES
) + ") AS v(rule_no, table_name, check_name, level, failed, passed)"


def _log(counts: str, run_id: str, checked_at: str, first: int) -> str:
    return f"""
SELECT {first} - 1 + r.rule_no AS log_id, '{run_id}' AS run_id, TIMESTAMP '{checked_at}' AS check_timestamp,
       r.table_name, r.check_name, CASE WHEN n > 0 THEN r.level ELSE 'INFO' END AS severity,
       CAST(n AS BIGINT) AS records_failed,
       CASE WHEN n > 0 THEN n || ' ' || r.failed ELSE r.passed END AS details
FROM {counts} c JOIN rules r ON c.rule_no = r.rule_no"""


VIEWS["clean_run"] = _log("clean_counts", "20230301_000000", "2023-03-01 00:00:00", 1)
VIEWS["faulty_run"] = _log("faulty_counts", "20240306_000000", "2024-03-06 00:00:00", 9)
VIEWS["quality_log"] = "SELECT * FROM clean_run UNION ALL SELECT * FROM faulty_run"

"""Building blocks of the comparison SQL: named subqueries and rendering helpers."""

from __future__ import annotations

import re

from harborline.domain import LINE_ID

THRESHOLD = 15


def dbl(e: str) -> str:
    return f"CAST({e} AS DOUBLE)"


def dt(e: str) -> str:
    return f"strftime({e}, '%Y-%m-%d')"


def ts(e: str) -> str:
    return f"strftime({e}, '%Y-%m-%d %H:%M:%S.%f')"


def div(num: str, den: str, places: int, positive_num: bool = False) -> str:
    """num / den of amounts or counts, rounded half up in whole numbers; NULL unless den (and num) > 0."""
    guard = f"{den} > 0" + (f" AND {num} > 0" if positive_num else "")
    n = f"CAST(CAST({num} AS DECIMAL(30,2)) * 100 AS HUGEINT)"
    d = f"CAST(CAST({den} AS DECIMAL(30,2)) * 100 AS HUGEINT)"
    rounded = f"sign({n}) * ((2 * abs({n}) * {10**places} + {d}) // (2 * {d}))"
    return f"CASE WHEN {guard} THEN CAST({rounded} AS DOUBLE) / {10**places} END"


def _trip(prefix: str, status: str, extra: str = "") -> str:
    return f"""
SELECT l_linenumber AS VendorID, o_orderdate AS {prefix}_pickup_datetime, l_shipdate AS {prefix}_dropoff_datetime,
  l_partkey % 6 AS passenger_count, l_quantity AS trip_distance, l_partkey % 5 + 1 AS RatecodeID,
  'N' AS store_and_fwd_flag, s_nationkey AS PULocationID, c_nationkey AS DOLocationID,
  l_suppkey % 4 + 1 AS payment_type, l_extendedprice AS fare_amount, 0.5::DOUBLE AS extra, 0.5::DOUBLE AS mta_tax,
  l_extendedprice * l_discount AS tip_amount, 0.0::DOUBLE AS tolls_amount, 0.3::DOUBLE AS improvement_surcharge,
  l_extendedprice * (1.0::DOUBLE + l_tax) AS total_amount, 2.5::DOUBLE AS congestion_surcharge{extra}
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN supplier ON l_suppkey = s_suppkey WHERE l_linestatus = '{status}'"""


_NUM = "CAST({} AS DECIMAL(38,9)) AS {}"


def _staged(source: str, prefix: str, trip_type: str, ehail: str) -> str:
    amounts = [
        "extra", "mta_tax", "tip_amount", "tolls_amount",
    ]
    return f"""
SELECT CAST(VendorID AS INTEGER) AS vendor_id, CAST(RatecodeID AS INTEGER) AS rate_code_id,
  CAST(PULocationID AS INTEGER) AS pickup_location_id, CAST(DOLocationID AS INTEGER) AS dropoff_location_id,
  {prefix}_pickup_datetime AS pickup_datetime, {prefix}_dropoff_datetime AS dropoff_datetime, store_and_fwd_flag,
  CAST(passenger_count AS INTEGER) AS passenger_count, {_NUM.format('trip_distance', 'trip_distance')},
  CAST({trip_type} AS INTEGER) AS trip_type, {_NUM.format('fare_amount', 'fare_amount')},
  {', '.join(_NUM.format(a, a) for a in amounts)}, {_NUM.format(ehail, 'ehail_fee')},
  {', '.join(_NUM.format(a, a) for a in ['improvement_surcharge', 'total_amount', 'congestion_surcharge'])},
  CAST(payment_type AS INTEGER) AS payment_type
FROM {source} WHERE VendorID IS NOT NULL"""


CTES = {
    "raw_policy": """
SELECT o_orderkey AS id, o_orderkey AS policy_number, o_custkey AS user_id, o_orderkey AS application_id,
  o_orderpriority AS product, o_orderdate AS issue_date, o_orderdate AS effective_date,
  CASE o_orderstatus WHEN 'F' THEN 'F' WHEN 'O' THEN 'M' END AS insured_gender,
  CAST(CAST(o_orderdate AS DATE) - to_months(CAST(240 + o_custkey % 600 AS INTEGER)) AS DATE) AS insured_date_of_birth
FROM orders""",
    "confirmed_policy": "SELECT o_orderkey AS policy_number FROM orders WHERE o_orderstatus <> 'P'",
    "raw_invoice": f"""
SELECT {LINE_ID} AS id, l_linestatus AS invoice_type, l_orderkey AS policy_number,
  l_shipdate AS coverage_start_date, l_shipdate + INTERVAL 30 DAY AS coverage_end_date, l_shipdate AS due_date,
  CASE l_returnflag WHEN 'A' THEN 'paid' WHEN 'N' THEN 'open' ELSE 'refunded' END AS status,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS pre_levy_amount,
  CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 + CAST(l_tax AS DECIMAL(4,2))), 2) AS DECIMAL(18,2))
    AS total_amount,
  CASE WHEN l_returnflag = 'R' THEN CAST(l_shipdate AS DATE) END AS refund_date,
  CASE WHEN NOT (l_linenumber = 7 AND l_linestatus = 'O') THEN l_shipdate END AS charge_date
FROM lineitem""",
    "raw_claim": f"""
SELECT {LINE_ID} AS id, 'T' || l_linenumber AS type,
  CASE l_linestatus WHEN 'F' THEN 'paid' ELSE 'open' END AS status, l_orderkey AS policy_number,
  l_shipdate AS submit_date, CASE l_linestatus WHEN 'F' THEN l_shipdate END AS payment_date,
  CASE WHEN l_linenumber <> 7 THEN CAST(l_shipdate AS DATE) END AS admission_date,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS total_billed_amount,
  CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(18,2))
    AS total_base_payable_amount
FROM lineitem WHERE l_returnflag = 'R'""",
    "yellow": _trip("tpep", "F"),
    "green": _trip("lpep", "O", ", CAST(NULL AS DOUBLE) AS ehail_fee, l_partkey % 2 + 1 AS trip_type"),
    "stg_yellow": _staged("yellow", "tpep", "1", "0"),
    "stg_green": _staged("green", "lpep", "trip_type", "ehail_fee"),
    "trips": "SELECT * FROM stg_green UNION ALL BY NAME SELECT * FROM stg_yellow",
    "zones": """
SELECT n_nationkey AS location_id, r_name AS borough, n_name AS zone,
  CASE WHEN r_regionkey < 2 THEN 'Yellow Zone' ELSE 'Boro Zone' END AS service_zone
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "products": "SELECT p_brand AS brand, CAST(p_retailprice AS DECIMAL(18,2)) AS price FROM part",
    "stg_policy": f"""
SELECT *, user_id IN (SELECT user_id FROM raw_policy GROUP BY user_id HAVING count(*) > {THRESHOLD}) AS is_outlier_user
FROM raw_policy""",
    "ranked": """
SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY effective_date NULLS LAST, policy_number) AS policy_rank
FROM stg_policy""",
    "stg_invoice": "SELECT * FROM raw_invoice WHERE policy_number IN (SELECT policy_number FROM raw_policy)",
    "paid_invoice": "SELECT * FROM stg_invoice WHERE status = 'paid'",
    "paid_claim": "SELECT * FROM raw_claim WHERE status = 'paid' AND payment_date IS NOT NULL",
    "regular": "SELECT * FROM stg_policy WHERE NOT is_outlier_user",
    "daily_premium": """
SELECT CAST(charge_date AS DATE) AS k, count(DISTINCT policy_number) AS payers, sum(pre_levy_amount) AS premium
FROM paid_invoice WHERE charge_date IS NOT NULL AND policy_number IN (SELECT policy_number FROM regular) GROUP BY 1""",
    "daily_issued": "SELECT CAST(effective_date AS DATE) AS k, count(*) AS issued FROM regular GROUP BY 1",
    "daily_claims": """
SELECT CAST(payment_date AS DATE) AS k, count(*) AS claims, sum(total_base_payable_amount) AS paid
FROM paid_claim GROUP BY 1""",
    "monthly_premium": """
SELECT CAST(date_trunc('month', charge_date) AS DATE) AS k, count(DISTINCT policy_number) AS payers,
  sum(pre_levy_amount) AS premium
FROM paid_invoice WHERE policy_number IN (SELECT policy_number FROM regular) GROUP BY 1""",
    "monthly_issued": """
SELECT CAST(date_trunc('month', effective_date) AS DATE) AS k, count(*) AS issued FROM regular GROUP BY 1""",
    "monthly_claims": """
SELECT CAST(date_trunc('month', payment_date) AS DATE) AS k, count(*) AS claims,
  sum(total_base_payable_amount) AS paid
FROM paid_claim GROUP BY 1""",
    "product_premium": """
SELECT CAST(date_trunc('month', charge_date) AS DATE) AS k, product, count(DISTINCT policy_number) AS payers,
  sum(pre_levy_amount) AS premium
FROM paid_invoice JOIN regular USING (policy_number) WHERE charge_date IS NOT NULL GROUP BY 1, 2""",
    "product_issued": """
SELECT CAST(date_trunc('month', effective_date) AS DATE) AS k, product, count(*) AS issued FROM regular GROUP BY 1, 2""",
    "product_claims": """
SELECT CAST(date_trunc('month', payment_date) AS DATE) AS k, product, count(*) AS claims,
  sum(total_base_payable_amount) AS paid
FROM paid_claim JOIN stg_policy USING (policy_number) GROUP BY 1, 2""",
}


def _mart(spine: str, keys: str, premium: str, issued: str, claims: str) -> str:
    on = " AND ".join(f"s.{k} = {{0}}.{k}" for k in keys.split(", "))
    p, c = "coalesce(premium, 0)", "coalesce(paid, 0)"
    return f"""
SELECT {', '.join(f's.{k}' for k in keys.split(', '))}, {dbl(p)} AS premium_received,
  CAST(coalesce(issued, 0) AS INTEGER) AS policies_issued, {dbl(c)} AS claims_paid,
  CAST(coalesce(claims, 0) AS INTEGER) AS claim_count, {div(c, p, 4)} AS loss_ratio,
  {div(p, 'coalesce(payers, 0)', 2, True)} AS avg_premium_per_policy,
  {div(c, 'coalesce(claims, 0)', 2, True)} AS avg_claim_amount,
  {p} AS premium_exact, {c} AS paid_exact
FROM ({spine}) s LEFT JOIN {premium} a ON {on.format('a')} LEFT JOIN {issued} b ON {on.format('b')}
LEFT JOIN {claims} c ON {on.format('c')}"""


def _spine(keys: str, *tables: str) -> str:
    return " UNION ".join(f"SELECT {keys} FROM {t}" for t in tables)


for _name in ("daily", "monthly"):
    _parts = [f"{_name}_premium", f"{_name}_issued", f"{_name}_claims"]
    CTES[_name] = _mart(_spine("k", *_parts), "k", *_parts)
CTES["product_month"] = _mart(
    _spine("k, product", "product_premium", "product_issued", "product_claims"),
    "k, product", "product_premium", "product_issued", "product_claims",
)

VALUES = "premium_received, policies_issued, claims_paid, claim_count, loss_ratio, avg_premium_per_policy, avg_claim_amount"
_SUMS = {"premium": "sum(premium_exact)", "paid": "sum(paid_exact)", "n": "sum(claim_count)", "i": "sum(policies_issued)"}


def _grain(code: str, unit: str) -> str:
    return f"""
SELECT '{code}' AS time_grain, CAST(date_trunc('{unit}', k) AS DATE) AS period_start,
  {dbl(_SUMS['premium'])} AS premium_received, CAST({_SUMS['i']} AS INTEGER) AS policies_issued,
  {dbl(_SUMS['paid'])} AS claims_paid, CAST({_SUMS['n']} AS INTEGER) AS claim_count,
  {div(_SUMS['paid'], _SUMS['premium'], 4)} AS loss_ratio, {div(_SUMS['premium'], _SUMS['i'], 2)} AS avg_premium_per_policy,
  {div(_SUMS['paid'], _SUMS['n'], 2)} AS avg_claim_amount
FROM daily GROUP BY 2"""


CTES["grains"] = " UNION ALL ".join(
    [f"SELECT 'D' AS time_grain, k AS period_start, {VALUES} FROM daily"]
    + [_grain(c, u) for c, u in (("W", "week"), ("M", "month"), ("Q", "quarter"), ("Y", "year"))]
)
# each period is sent to itself and to the one a year later, and the two meet in one aggregation
CTES["lent"] = f"""
SELECT time_grain, period_start AS period, true AS here, period_start, {VALUES} FROM grains
UNION ALL SELECT time_grain, CAST(period_start + INTERVAL 1 YEAR AS DATE), false, period_start, {VALUES} FROM grains
WHERE time_grain IN ('M', 'Q', 'Y') AND period_start IS NOT NULL"""
CTES["rollups"] = f"""
SELECT time_grain, period AS period_start, {', '.join(f'max({v}) FILTER (here) AS {v}' for v in VALUES.split(', '))},
  max(period_start) FILTER (NOT here) AS period_start_ly,
  {', '.join(f'max({v}) FILTER (NOT here) AS {v}_ly' for v in VALUES.split(', '))}
FROM lent GROUP BY time_grain, period HAVING bool_or(here)"""
CTES["invoice_totals"] = """
SELECT policy_number, count(*) AS invoice_count, sum(pre_levy_amount) AS total_pre_levy_amount,
  sum(total_amount) AS total_amount_paid
FROM paid_invoice GROUP BY 1"""
CTES["claim_totals"] = """
SELECT policy_number, count(*) AS claim_count, sum(total_billed_amount) AS total_billed_amount,
  sum(total_base_payable_amount) AS total_payable_amount
FROM raw_claim GROUP BY 1"""
CTES["wide"] = """
SELECT p.* EXCLUDE (id, application_id), CAST(coalesce(invoice_count, 0) AS INTEGER) AS invoice_count,
  total_pre_levy_amount, total_amount_paid, CAST(coalesce(claim_count, 0) AS INTEGER) AS claim_count,
  total_billed_amount, total_payable_amount
FROM stg_policy p LEFT JOIN invoice_totals i ON p.policy_number = i.policy_number
LEFT JOIN claim_totals c ON p.policy_number = c.policy_number"""


def sql(body: str, **extra: str) -> str:
    """``body`` preceded by the named subqueries it needs, directly or through others."""
    known = {**CTES, **extra}
    ordered: list[str] = []

    def need(text: str) -> None:
        for word in re.findall(r"\w+", re.sub(r"'[^']*'", "", text)):
            if word in known and word not in ordered and word not in path:
                path.append(word)
                need(known[word])
                path.pop()
                if word not in ordered:
                    ordered.append(word)

    path: list[str] = []
    need(body)
    if not ordered:
        return body.strip()
    texts = [known[n] for n in ordered] + [body]

    def clause(name: str) -> str:
        # a subquery used more than once is kept, or the other engine computes it anew for each use
        uses = sum(len(re.findall(rf"\b{name}\b", re.sub(r"'[^']*'", "", t))) for t in texts)
        return f"{name} AS {'MATERIALIZED ' if uses > 1 else ''}({known[name]})"

    return "WITH " + ", ".join(map(clause, ordered)) + "\n" + body.strip()

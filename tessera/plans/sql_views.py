"""ANSI/DuckDB text of the two sales views, used by the oracle queries.

They mirror ``tessera.sources.tables.sales`` / ``sales_raw`` expression by
expression (``rint`` is ``round_even(x, 0)``, ``date_format(d,'MMM')`` is
``strftime(d, '%b')``).
"""

JOINED = """
  lineitem
  LEFT JOIN orders   ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN part     ON l_partkey = p_partkey
  LEFT JOIN nation   ON c_nationkey = n_nationkey
  LEFT JOIN region   ON n_regionkey = r_regionkey
"""

RATING = "(1.0 + round_even(l_tax * 100, 0) / 2)"
SHIP_DAYS = "datediff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))"

SALES = f"""
SELECT
  o_orderkey AS order_id, o_custkey AS customer_id, c_name AS customer_name,
  p_size AS age, o_orderstatus AS gender, n_name AS city, n_name AS state,
  r_name AS region, c_mktsegment AS loyalty_tier, p_type AS product_category,
  p_name AS product_name, CAST(l_quantity AS INTEGER) AS quantity,
  l_extendedprice / l_quantity AS unit_price, l_discount AS discount,
  round_even(l_extendedprice / l_quantity * CAST(l_quantity AS INTEGER) * (1 - l_discount) * 100, 0) / 100 AS total_sales,
  CAST(o_orderdate AS DATE) AS order_date, o_orderpriority AS payment_method,
  {RATING} AS customer_rating, l_returnflag = 'R' AS return_flag,
  CAST({SHIP_DAYS} AS INTEGER) AS shipping_days,
  CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
  strftime(CAST(o_orderdate AS DATE), '%b') AS month_name, CAST(quarter(o_orderdate) AS INTEGER) AS quarter
FROM {JOINED}
"""

_KL = "(l_orderkey + l_linenumber)"
_GENDER = "CASE WHEN o_orderstatus = 'F' THEN 'Female' ELSE 'Male' END"
_SPELLED = " ".join(f"WHEN {_KL} % 9001 = {i + 1} THEN '{x}'" for i, x in enumerate(
    ("male", "m", "MALE", "M", "female", "f", "FEMALE", "F", "N/A")))
_RAW_ROWS = f"""
SELECT
  o_orderkey AS order_id, o_custkey AS customer_id, c_name AS customer_name,
  CASE WHEN o_custkey % 20 = 3 THEN NULL WHEN {_KL} % 3001 = 5 THEN 400.0 ELSE CAST(p_size AS DOUBLE) END AS age,
  CASE WHEN o_custkey % 25 = 1 THEN NULL {_SPELLED}
       WHEN o_custkey % 10 = 5 THEN ' ' || {_GENDER} ELSE {_GENDER} END AS gender,
  CASE WHEN l_orderkey % 50 = 7 THEN NULL ELSE n_name END AS city,
  n_name AS state,
  CASE WHEN l_orderkey % 33 = 5 THEN NULL ELSE r_name END AS region,
  CASE WHEN o_custkey % 3 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END AS loyalty_tier,
  CASE WHEN {_KL} % 40 = 0 THEN '  ' || p_type || ' ' ELSE p_type END AS product_category,
  p_name AS product_name,
  CASE WHEN {_KL} % 9973 = 1 THEN -CAST(l_quantity AS INTEGER) ELSE CAST(l_quantity AS INTEGER) END AS quantity,
  CASE WHEN {_KL} % 50 = 3 THEN NULL WHEN {_KL} % 5003 = 7 THEN 0.0 WHEN {_KL} % 5003 = 8 THEN -5.0
       WHEN {_KL} % 4001 = 12 THEN l_extendedprice / l_quantity * 50 ELSE l_extendedprice / l_quantity END AS unit_price,
  CASE WHEN {_KL} % 33 = 4 THEN NULL WHEN {_KL} % 5003 = 9 THEN 1.5 ELSE l_discount END AS discount,
  l_extendedprice AS total_sales,
  CASE WHEN l_orderkey % 15013 = 11 THEN '99/99/9999' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date,
  CASE WHEN l_orderkey % 25 = 6 THEN NULL ELSE o_orderpriority END AS payment_method,
  CASE WHEN {_KL} % 14 = 2 THEN NULL WHEN {_KL} % 9967 = 9 THEN 6.0 WHEN {_KL} % 9967 = 10 THEN 0.0
       WHEN {_KL} % 9967 = 11 THEN -1.0 ELSE {RATING} END AS customer_rating,
  l_returnflag = 'R' AS return_flag,
  CASE WHEN {_KL} % 50 = 8 THEN NULL ELSE CAST({SHIP_DAYS} AS DOUBLE) END AS shipping_days
FROM {JOINED}
"""
SALES_RAW = _RAW_ROWS + "UNION ALL" + _RAW_ROWS + f"WHERE {_KL} % 33 = 0"


def with_views(body: str, raw: bool = False, clean: bool = True, sales: str | None = None) -> str:
    """Prefix a query with the sales CTEs it reads; ``sales`` puts other CTEs, which
    define ``sales`` over ``sales_raw``, in the place of the clean view."""
    ctes = []
    if sales:
        ctes += [f"sales_raw AS ({SALES_RAW})", sales]
    elif clean:
        ctes.append(f"sales AS ({SALES})")
    if raw and not sales:
        ctes.append(f"sales_raw AS ({SALES_RAW})")
    body = body.lstrip()
    if body[:5].upper() == "WITH ":
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body

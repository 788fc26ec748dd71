"""The cleaning chain as DuckDB CTEs (oracle side of ``tessera.operators.clean``)."""

from __future__ import annotations

STRIP = r"regexp_replace({c}, '^\s+|\s+$', '', 'g')"
STR_COLS = ("customer_name", "gender", "city", "state", "region", "loyalty_tier",
            "product_category", "product_name", "payment_method")
MALE = "('male','m','MALE','M')"
FEMALE = "('female','f','FEMALE','F')"


def strip(c: str) -> str:
    return STRIP.format(c=c)


def gender_std(src: str = "gender") -> str:
    s = strip(src)
    return f"CASE WHEN {s} IN {MALE} THEN 'Male' WHEN {s} IN {FEMALE} THEN 'Female' ELSE {s} END"


def title(c: str) -> str:
    return f"upper(left({c}, 1)) || lower(substr({c}, 2))"


PARSED = "SELECT * REPLACE (CAST(try_strptime(order_date, '%Y-%m-%d') AS DATE) AS order_date) FROM {src}"

STD_REPLACE = ",\n".join(
    [f"{gender_std()} AS gender"]
    + [f"{strip(c)} AS {c}" for c in STR_COLS if c not in ("gender", "loyalty_tier")]
    + [f"{title(strip('loyalty_tier'))} AS loyalty_tier"])
STANDARDISED = "SELECT * REPLACE (" + STD_REPLACE + ") FROM {src}"

INVALID = """SELECT * REPLACE (abs(quantity) AS quantity,
  CASE WHEN customer_rating IS NOT NULL AND NOT (customer_rating BETWEEN 1.0 AND 5.0)
       THEN NULL ELSE customer_rating END AS customer_rating) FROM {src}"""

MEDIAN_DATE = """SELECT order_date AS md FROM (
  SELECT order_date, row_number() OVER (ORDER BY order_date) - 1 AS i, count(*) OVER () AS n
  FROM {src} WHERE order_date IS NOT NULL) WHERE i = n // 2"""

NUM = ("age", "unit_price", "discount", "customer_rating", "shipping_days")
CAT = ("gender", "payment_method", "region", "city", "state", "loyalty_tier")


def mode_sql(c: str, src: str) -> str:
    return (f"(SELECT {c} FROM {src} WHERE {c} IS NOT NULL GROUP BY {c} "
            f"ORDER BY count(*) DESC, {c} LIMIT 1)")


def medians_cte(src: str) -> str:
    return "SELECT " + ", ".join(f"median({c}) AS {c}" for c in NUM) + f" FROM {src}"


def imputed(src: str, med: str) -> str:
    parts = [f"coalesce({c}, (SELECT {c} FROM {med})) AS {c}" for c in NUM]
    parts += [f"coalesce({c}, {mode_sql(c, src)}) AS {c}" for c in CAT]
    return "SELECT * REPLACE (" + ", ".join(parts) + f") FROM {src}"


def bounds(src: str, col: str = "unit_price", k: float = 3.0) -> str:
    return (f"SELECT '{col}' AS column, q1, q3, q1 - {k} * (q3 - q1) AS lo, q3 + {k} * (q3 - q1) AS hi "
            f"FROM (SELECT quantile_cont({col}, 0.25) AS q1, quantile_cont({col}, 0.75) AS q3 FROM {src})")


def capped(src: str, b: str, col: str = "unit_price") -> str:
    return (f"SELECT * REPLACE (least(greatest({col}, (SELECT lo FROM {b})), (SELECT hi FROM {b})) AS {col}) "
            f"FROM {src}")


DERIVED = """SELECT * REPLACE (round_even(unit_price * quantity * (1 - discount) * 100.0, 0) / 100.0 AS total_sales),
  CAST(year(order_date) AS INTEGER) AS year, CAST(month(order_date) AS INTEGER) AS month,
  strftime(order_date, '%b') AS month_name, CAST(quarter(order_date) AS INTEGER) AS quarter FROM {src}"""

CAST = """SELECT * REPLACE (CAST(trunc(age) AS INTEGER) AS age, CAST(quantity AS INTEGER) AS quantity,
  CAST(round_even(shipping_days, 0) AS INTEGER) AS shipping_days) FROM {src}"""


def chain() -> str:
    """CTEs dedup .. clean over ``sales_raw`` (body continues after a comma)."""
    return f"""
dedup AS (SELECT DISTINCT * FROM sales_raw),
parsed AS ({PARSED.format(src='dedup')}),
std AS ({STANDARDISED.format(src='parsed')}),
inv AS ({INVALID.format(src='std')}),
md AS ({MEDIAN_DATE.format(src='inv')}),
dated AS (SELECT * REPLACE (coalesce(order_date, (SELECT md FROM md)) AS order_date) FROM inv),
med AS ({medians_cte('dated')}),
imp AS ({imputed('dated', 'med')}),
bnd AS ({bounds('imp')}),
cap AS ({capped('imp', 'bnd')}),
der AS ({DERIVED.format(src='cap')}),
clean AS ({CAST.format(src='der')})
"""

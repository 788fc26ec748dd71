"""Oracle SQL (DuckDB dialect) for every query in ``tessera.plans.catalog``.

Each string reads the pre-registered test tables through the same sales views
the Spark side uses (``tessera.plans.sql_views``). Column names match the
Spark output so the comparison can sort columns by name.
"""

from __future__ import annotations

from tessera.plans.sql_views import with_views

MONEY_SUM = "CAST(SUM(CAST({x} AS DECIMAL(18,2))) AS DOUBLE)"


def msum(x: str) -> str:
    return MONEY_SUM.format(x=x)


def r2(x: str, digits: int = 2) -> str:
    s = f"{10 ** digits}.0"
    return f"(round_even(({x}) * {s}, 0) / {s})"


ORACLE: dict[str, str] = {}
BODIES: dict[str, str] = {}


def register(name: str, body: str, raw: bool = False, clean: bool = True) -> None:
    BODIES[name] = body
    ORACLE[name] = with_views(body, raw=raw, clean=clean)


# ---------------------------------------------------------------- marts
register("kpis", f"""
SELECT {msum('total_sales')} AS total_revenue, count(*) AS total_orders,
       {r2('avg(total_sales)')} AS avg_order_value, {r2('avg(customer_rating)')} AS avg_rating,
       min(order_date) AS first_date, max(order_date) AS last_date,
       count(DISTINCT customer_name) AS unique_customers
FROM sales""")

register("distinct_customers", """
WITH d AS (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, region AS "group", customer_id AS c FROM sales
           WHERE order_date IS NOT NULL AND region IS NOT NULL AND customer_id IS NOT NULL)
SELECT CASE WHEN grouping(month) = 0 AND grouping("group") = 0 THEN 'month_group' WHEN grouping(month) = 0 THEN 'month'
            WHEN grouping("group") = 0 THEN 'group' ELSE 'all' END AS level,
       month, "group", count(DISTINCT c) AS customers, true AS within
FROM d GROUP BY GROUPING SETS ((month, "group"), (month), ("group"), ())""", clean=True)

register("top_entities", f"""
SELECT dimension, top_value, revenue FROM (
  SELECT *, row_number() OVER (PARTITION BY dimension ORDER BY revenue DESC, top_value) AS rn FROM (
    SELECT 'region' AS dimension, CAST(region AS VARCHAR) AS top_value, {msum('total_sales')} AS revenue
      FROM sales WHERE region IS NOT NULL GROUP BY region
    UNION ALL
    SELECT 'product_category', CAST(product_category AS VARCHAR), {msum('total_sales')}
      FROM sales WHERE product_category IS NOT NULL GROUP BY product_category
    UNION ALL
    SELECT 'product_name', CAST(product_name AS VARCHAR), {msum('total_sales')}
      FROM sales WHERE product_name IS NOT NULL GROUP BY product_name))
WHERE rn = 1""")

register("yearly_growth", f"""
WITH y AS (SELECT year, {msum('total_sales')} AS revenue FROM sales WHERE year IS NOT NULL GROUP BY year),
f AS (SELECT arg_min(revenue, year) AS first_rev, arg_max(revenue, year) AS last_rev FROM y)
SELECT year, revenue, {r2('(revenue - first_rev) / first_rev * 100')} AS pct_vs_first,
       {r2('(last_rev - first_rev) / first_rev * 100', 1)} AS growth_last_vs_first
FROM y, f""")

register("regional", f"""
SELECT region, {msum('total_sales')} AS revenue, count(order_id) AS orders,
       {r2('avg(customer_rating)')} AS avg_rating
FROM sales WHERE region IS NOT NULL GROUP BY region""")

register("loyalty", f"""
SELECT loyalty_tier, count(order_id) AS orders, {msum('total_sales')} AS revenue
FROM sales WHERE loyalty_tier IS NOT NULL GROUP BY loyalty_tier""")

register("category_share", f"""
SELECT product_category, revenue, {r2('revenue / sum(revenue) OVER () * 100')} AS share_pct, avg_order_value
FROM (SELECT product_category, {msum('total_sales')} AS revenue, {r2('avg(total_sales)')} AS avg_order_value
      FROM sales WHERE product_category IS NOT NULL GROUP BY product_category)""")

register("monthly", f"""
SELECT year, month, month_name, {msum('total_sales')} AS revenue
FROM sales WHERE year IS NOT NULL AND month IS NOT NULL GROUP BY year, month, month_name""")

for _key, _aov, _name in (("payment_method", True, "payment_split"), ("gender", False, "gender_split")):
    _aov_sel = f", {r2('avg(total_sales)')} AS avg_order_value" if _aov else ""
    _aov_out = ", avg_order_value" if _aov else ""
    register(_name, f"""
SELECT {_key}, orders, {r2('orders / sum(orders) OVER () * 100')} AS share_pct{_aov_out}
FROM (SELECT {_key}, count(*) AS orders{_aov_sel} FROM sales WHERE {_key} IS NOT NULL GROUP BY {_key})""")

register("quarter_yoy", f"""
WITH yq AS (SELECT year, quarter, {msum('total_sales')} AS rev FROM sales WHERE year IS NOT NULL GROUP BY year, quarter),
spine AS (SELECT y.year, CAST(q.range AS INTEGER) AS quarter FROM (SELECT DISTINCT year FROM yq) y, range(1, 5) q),
full_ AS (SELECT s.year, s.quarter, coalesce(yq.rev, 0.0) AS revenue FROM spine s LEFT JOIN yq USING (year, quarter))
SELECT year, quarter, revenue,
       CASE WHEN first_value(revenue) OVER w > 0
            THEN {r2('(revenue - first_value(revenue) OVER w) / first_value(revenue) OVER w * 100', 1)} END AS pct_vs_first_year
FROM full_ WINDOW w AS (PARTITION BY quarter ORDER BY year)""")

register("region_category", f"""
WITH r AS (SELECT DISTINCT region FROM sales WHERE region IS NOT NULL AND product_category IS NOT NULL),
c AS (SELECT DISTINCT product_category FROM sales WHERE region IS NOT NULL AND product_category IS NOT NULL),
a AS (SELECT region, product_category, {msum('total_sales')} AS revenue FROM sales
      WHERE region IS NOT NULL AND product_category IS NOT NULL GROUP BY region, product_category)
SELECT r.region, c.product_category, coalesce(a.revenue, 0.0) AS revenue
FROM r, c LEFT JOIN a ON a.region = r.region AND a.product_category = c.product_category""")

register("top_products", f"""
SELECT CAST(row_number() OVER (ORDER BY revenue DESC, product_name) AS INTEGER) AS rank, product_name, revenue
FROM (SELECT product_name, {msum('total_sales')} AS revenue FROM sales WHERE product_name IS NOT NULL
      GROUP BY product_name ORDER BY revenue DESC, product_name LIMIT 10)""")

ORACLE["top5_products"] = ORACLE["top_products"].replace("LIMIT 10", "LIMIT 5")

# ---------------------------------------------------------------- cleaning
from tessera.plans import sql_clean as C  # noqa: E402

register("dedup", "SELECT DISTINCT * FROM sales_raw", raw=True, clean=False)
register("date_fix", f"""
WITH parsed AS ({C.PARSED.format(src='sales_raw')}),
md AS ({C.MEDIAN_DATE.format(src='parsed')})
SELECT * REPLACE (coalesce(order_date, (SELECT md FROM md)) AS order_date) FROM parsed""", raw=True, clean=False)
register("standardise", C.STANDARDISED.format(src="sales_raw"), raw=True, clean=False)
register("invalid_values", C.INVALID.format(src="sales_raw"), raw=True, clean=False)
register("impute", f"""
WITH med AS ({C.medians_cte('sales_raw')})
{C.imputed('sales_raw', 'med')}""", raw=True, clean=False)
register("iqr_bounds", C.bounds("sales_raw"), raw=True, clean=False)
register("iqr_cap", f"WITH bnd AS ({C.bounds('sales_raw')}) {C.capped('sales_raw', 'bnd')}", raw=True, clean=False)
register("zscore_count", """
WITH m AS (SELECT avg(age) AS m, stddev_pop(age) AS s FROM sales_raw)
SELECT count(*) FILTER (WHERE age IS NOT NULL AND abs((age - m) / s) > 3.0) AS n_outliers FROM sales_raw, m""",
         raw=True, clean=False)
register("derive", f"""
WITH parsed AS ({C.PARSED.format(src='sales_raw')}),
md AS ({C.MEDIAN_DATE.format(src='parsed')}),
dated AS (SELECT * REPLACE (coalesce(order_date, (SELECT md FROM md)) AS order_date) FROM parsed),
der AS ({C.DERIVED.format(src='dated')})
{C.CAST.format(src='der')}""", raw=True, clean=False)
register("raw_profile", """
SELECT count(*) AS raw_rows, 20 AS raw_cols,
  CAST(""" + " + ".join(f"count(*) - count({c})" for c in (
    "order_id", "customer_id", "customer_name", "age", "gender", "city", "state", "region",
    "loyalty_tier", "product_category", "product_name", "quantity", "unit_price", "discount",
    "total_sales", "order_date", "payment_method", "customer_rating", "return_flag",
    "shipping_days")) + """ AS BIGINT) AS raw_nulls,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM sales_raw)) AS raw_duplicates
FROM sales_raw""", raw=True, clean=False)
register("cleaned_sales", "WITH " + C.chain() + "SELECT * FROM clean", raw=True, clean=False)

_VALIDATION_AGG = """
v AS (SELECT
  CAST(""" + " + ".join(f"count(*) - count({c})" for c in ("age", "quantity", "unit_price", "total_sales", "order_date")) + """ AS BIGINT) AS c0,
  count(*) FILTER (WHERE NOT coalesce(customer_rating BETWEEN 1.0 AND 5.0, false)) AS c1,
  count(*) FILTER (WHERE NOT coalesce(quantity >= 0, false)) AS c2,
  count(*) FILTER (WHERE NOT coalesce(unit_price > 0, false)) AS c3,
  count(*) FILTER (WHERE NOT coalesce(discount BETWEEN 0.0 AND 1.0, false)) AS c4,
  count(*) FILTER (WHERE gender IS NULL) AS c5 FROM clean),
val AS (
  SELECT 'No nulls in key columns' AS "check", c0 AS violations FROM v UNION ALL
  SELECT 'All ratings in [1.0, 5.0]', c1 FROM v UNION ALL
  SELECT 'All quantities >= 0', c2 FROM v UNION ALL
  SELECT 'All unit prices > 0', c3 FROM v UNION ALL
  SELECT 'Discount in [0, 1]', c4 FROM v UNION ALL
  SELECT 'No empty gender values', c5 FROM v)
"""
register("validation", "WITH " + C.chain() + "," + _VALIDATION_AGG +
         'SELECT "check", violations, violations = 0 AS passed FROM val', raw=True, clean=False)

_ALL24 = ("order_id", "customer_id", "customer_name", "age", "gender", "city", "state", "region",
          "loyalty_tier", "product_category", "product_name", "quantity", "unit_price", "discount",
          "total_sales", "order_date", "payment_method", "customer_rating", "return_flag",
          "shipping_days", "year", "month", "month_name", "quarter")
_RAW20 = _ALL24[:20]


def _rnd1(x: str) -> str:
    return f"(round_even(({x}) * 10.0, 0) / 10.0)"


_REPORT_CTES = "WITH " + C.chain() + "," + _VALIDATION_AGG + f""",
prof AS (SELECT count(*) AS raw_rows,
  CAST({' + '.join(f'count(*) - count({c})' for c in _RAW20)} AS BIGINT) AS raw_nulls FROM sales_raw),
flags AS (SELECT
  count(*) AS dedup_rows,
  count(*) FILTER (WHERE try_strptime(d.order_date, '%Y-%m-%d') IS NULL) AS invalid_dates,
  count(*) FILTER (WHERE {C.strip('d.gender')} IN {C.MALE} OR {C.strip('d.gender')} IN {C.FEMALE}) AS gender_variants_fixed,
  count(*) FILTER (WHERE d.gender IS NOT NULL AND NOT ({C.strip('d.gender')} IN {C.MALE} OR {C.strip('d.gender')} IN {C.FEMALE})
                   AND {C.strip('d.gender')} NOT IN ('Male', 'Female')) AS unknown_genders,
  count(*) FILTER (WHERE d.quantity < 0) AS negative_qty_fixed,
  count(*) FILTER (WHERE d.customer_rating IS NOT NULL AND NOT (d.customer_rating BETWEEN 1.0 AND 5.0)) AS bad_ratings_nulled
  FROM dedup d),
miss AS (SELECT {', '.join(f'count(*) - count({c}) AS missing_{c}' for c in C.NUM + C.CAT)} FROM inv),
capn AS (SELECT count(*) FILTER (WHERE unit_price < (SELECT lo FROM bnd) OR unit_price > (SELECT hi FROM bnd)) AS capped_unit_price FROM imp),
fin AS (SELECT count(*) AS final_rows,
  CAST({' + '.join(f'count(*) - count({c})' for c in _ALL24)} AS BIGINT) AS final_nulls FROM clean),
failed AS (SELECT count(*) FILTER (WHERE violations > 0) AS failed_checks FROM val),
rep0 AS (SELECT prof.raw_rows, 20 AS raw_cols, prof.raw_nulls, prof.raw_rows - flags.dedup_rows AS raw_duplicates,
  prof.raw_rows - flags.dedup_rows AS duplicates_removed, invalid_dates, gender_variants_fixed, unknown_genders,
  negative_qty_fixed, bad_ratings_nulled, 9 AS whitespace_cols,
  {', '.join(f'missing_{c}' for c in C.NUM + C.CAT)}, capped_unit_price,
  final_rows, 24 AS final_cols, final_nulls, failed_checks
  FROM prof, flags, miss, capn, fin, failed),
rep AS (SELECT *, {_rnd1('''greatest(0.0, least(100.0, 100.0
    - CASE WHEN raw_rows > 0 THEN least(20.0, (raw_rows - final_rows) / raw_rows * 200) ELSE 0.0 END
    - CASE WHEN final_rows * greatest(final_cols, 1) > 0 THEN least(30.0, final_nulls / (final_rows * greatest(final_cols, 1)) * 1000) ELSE 0.0 END
    - least(25.0, invalid_dates * 0.5 + negative_qty_fixed * 0.3 + bad_ratings_nulled * 0.3 + gender_variants_fixed * 0.05 + failed_checks * 5.0)))''')} AS dq_score
  FROM rep0)
"""
register("dq_report", _REPORT_CTES + "SELECT * FROM rep", raw=True, clean=False)

_ISSUE_METRICS = ("duplicates_removed", "invalid_dates", "gender_variants_fixed", "unknown_genders",
                  "negative_qty_fixed", "bad_ratings_nulled", "whitespace_cols")
register("dq_issues", _REPORT_CTES + " UNION ALL ".join(
    [f"SELECT '{m}' AS metric, CAST(NULL AS VARCHAR) AS column, CAST({m} AS BIGINT) AS n, "
     f"CAST(NULL AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS text FROM rep" for m in _ISSUE_METRICS]
    + ["SELECT 'outliers_capped', 'unit_price', capped_unit_price, (SELECT hi FROM bnd), NULL FROM rep"]
    + [f"SELECT 'imputed', '{c}', missing_{c}, (SELECT {c} FROM med), NULL FROM rep WHERE missing_{c} > 0"
       for c in C.NUM]
    + [f"SELECT 'imputed', '{c}', missing_{c}, NULL, {C.mode_sql(c, 'dated')} FROM rep WHERE missing_{c} > 0"
       for c in C.CAT]), raw=True, clean=False)

# ---------------------------------------------------------------- statistics
_DESC = ("age", "unit_price", "discount", "total_sales", "customer_rating", "quantity", "shipping_days")


def _long(cols, src="sales"):
    return " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS v FROM {src} WHERE {c} IS NOT NULL"
                              for c in cols)


register("describe", f"""
WITH l AS ({_long(_DESC)}),
c AS (SELECT "column", v, v - avg(v) OVER (PARTITION BY "column") AS d FROM l)
SELECT "column", count(v) AS count, {r2('avg(v)')} AS mean, {r2('median(v)')} AS median,
  {r2('stddev_samp(v)')} AS std, {r2('min(v)')} AS min, {r2('max(v)')} AS max,
  {r2('avg(d*d*d) / pow(avg(d*d), 1.5)', 3)} AS skewness,
  {r2('avg(d*d*d*d) / pow(avg(d*d), 2) - 3', 3)} AS kurtosis
FROM c GROUP BY "column" """)

_GM = """g AS (SELECT region, count(total_sales) AS n, avg(total_sales) AS mean, var_samp(total_sales) AS var
            FROM sales WHERE region IS NOT NULL AND total_sales IS NOT NULL GROUP BY region),
t AS (SELECT sum(n) AS tot_n, sum(n * mean) / sum(n) AS gm, count(*) AS k FROM g)"""
register("anova", f"""
WITH {_GM},
p AS (SELECT sum(g.n * (mean - gm) * (mean - gm)) AS ssb, sum((g.n - 1) * coalesce(var, 0.0)) AS ssw,
             any_value(k) AS k, any_value(tot_n) AS tot_n FROM g, t)
SELECT {r2('(ssb / (k - 1)) / (ssw / (tot_n - k))', 4)} AS f_stat, CAST(k - 1 AS BIGINT) AS df_between,
       CAST(tot_n - k AS BIGINT) AS df_within FROM p""")
register("region_means", f"WITH {_GM} SELECT region, {r2('mean')} AS mean FROM g")

_CT = """base AS (SELECT payment_method, gender FROM sales WHERE payment_method IS NOT NULL AND gender IS NOT NULL),
ra AS (SELECT DISTINCT payment_method FROM base), cb AS (SELECT DISTINCT gender FROM base),
obs AS (SELECT payment_method, gender, count(*) AS o FROM base GROUP BY ALL),
ct AS (SELECT ra.payment_method, cb.gender, coalesce(obs.o, 0) AS observed
       FROM ra, cb LEFT JOIN obs ON obs.payment_method = ra.payment_method AND obs.gender = cb.gender)"""
register("contingency", f"WITH {_CT} SELECT payment_method, gender, CAST(observed AS BIGINT) AS observed FROM ct")
register("chi_square", f"""
WITH {_CT},
cells AS (SELECT CAST(observed AS DOUBLE) AS o,
  sum(observed) OVER (PARTITION BY payment_method) * sum(observed) OVER (PARTITION BY gender)
    / (SELECT sum(observed) FROM ct) AS e FROM ct),
d AS (SELECT (SELECT count(*) FROM ra) AS r, (SELECT count(*) FROM cb) AS c),
adj AS (SELECT e, CASE WHEN (r - 1) * (c - 1) = 1 THEN o + sign(e - o) * least(0.5, abs(e - o)) ELSE o END AS o2,
        (r - 1) * (c - 1) AS dof FROM cells, d)
SELECT {r2('sum((o2 - e) * (o2 - e) / e)', 4)} AS chi2_stat, CAST(any_value(dof) AS BIGINT) AS dof FROM adj""")


def _pairs(cols):
    return [(cols[i], cols[j]) for i in range(len(cols)) for j in range(i + 1, len(cols))]


register("pearson", "WITH b AS (SELECT * FROM sales WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in _DESC)
         + ")\n" + " UNION ALL ".join(
             f"SELECT '{x}' AS c1, '{y}' AS c2, count(*) AS n, {r2(f'corr({x}, {y})', 3)} AS r FROM b"
             for x, y in _pairs(_DESC)))
_CM = ("age", "quantity", "unit_price", "discount", "total_sales", "customer_rating", "shipping_days")
register("corr_matrix", " UNION ALL ".join(
    f"SELECT '{y}' AS row, '{x}' AS col, {r2(f'corr({x}, {y})', 2)} AS r FROM sales" for x, y in _pairs(_CM)))

_ABC = """rev AS (SELECT product_name, sum(CAST(total_sales AS DECIMAL(18,2))) AS rev_dec FROM sales
                  WHERE product_name IS NOT NULL GROUP BY product_name),
cum AS (SELECT product_name, rev_dec,
          CAST(sum(rev_dec) OVER (ORDER BY rev_dec DESC, product_name ROWS UNBOUNDED PRECEDING) AS DOUBLE)
          / CAST((SELECT sum(rev_dec) FROM rev) AS DOUBLE) AS share FROM rev),
abc AS (SELECT product_name AS product, CAST(rev_dec AS DOUBLE) AS revenue, share,
          CASE WHEN share <= 0.7 THEN 'A' WHEN share <= 0.9 THEN 'B' ELSE 'C' END AS abc_tier FROM cum)"""
register("abc", f"WITH {_ABC} SELECT product, revenue, {r2('share', 4)} AS cum_share, abc_tier FROM abc")
register("abc_tiers", f"WITH {_ABC} SELECT abc_tier, count(*) AS products, {msum('revenue')} AS revenue "
         "FROM abc GROUP BY abc_tier")
register("repeat_customers", f"""
WITH per AS (SELECT customer_id, count(order_id) AS n FROM sales WHERE customer_id IS NOT NULL GROUP BY customer_id)
SELECT count(*) AS total_customers, count(*) FILTER (WHERE n > 1) AS repeat_customers,
  {r2('count(*) FILTER (WHERE n > 1) / count(*) * 100')} AS repeat_rate_pct,
  {r2('avg(n)')} AS avg_orders, max(n) AS max_orders FROM per""")
register("return_rate", f"""
SELECT product_category, return_count, total_orders, {r2('return_count / total_orders * 100')} AS return_rate_pct
FROM (SELECT product_category, count(*) FILTER (WHERE return_flag) AS return_count, count(return_flag) AS total_orders
      FROM sales WHERE product_category IS NOT NULL GROUP BY product_category)""")
register("linear_fit", f"""
SELECT count(*) FILTER (WHERE discount IS NOT NULL AND total_sales IS NOT NULL) AS n,
  {r2('regr_slope(total_sales, discount * 100.0)', 4)} AS slope,
  {r2('regr_intercept(total_sales, discount * 100.0)', 4)} AS intercept,
  {r2('regr_r2(total_sales, discount * 100.0)', 6)} AS r2 FROM sales""")
_NORM = ("age", "unit_price", "total_sales", "customer_rating", "discount")
register("jarque_bera", f"""
WITH l AS ({_long(_NORM)}),
c AS (SELECT "column", v - avg(v) OVER (PARTITION BY "column") AS d FROM l),
m AS (SELECT "column", count(*) AS n, avg(d*d*d) / pow(avg(d*d), 1.5) AS s, avg(d*d*d*d) / pow(avg(d*d), 2) - 3 AS k
      FROM c GROUP BY "column")
SELECT "column", n, {r2('n / 6.0 * (s * s + k * k / 4.0)', 4)} AS jb_stat,
  {r2('exp(-(n / 6.0 * (s * s + k * k / 4.0)) / 2.0)', 4)} AS p_value FROM m""")

# ---------------------------------------------------------------- features


def r4(x: str) -> str:
    return r2(x, 4)


_DAILY = f"""
agg AS (SELECT order_date, {msum('total_sales')} AS total_sales, count(order_id) AS n_orders,
          avg(unit_price) AS price_mean,
          CAST(sum(CAST(discount AS DECIMAL(18,2))) AS DOUBLE) / count(discount) AS discount_mean,
          avg(quantity) AS quantity_mean
        FROM sales WHERE order_date IS NOT NULL GROUP BY order_date),
spine AS (SELECT CAST(unnest(generate_series(min(order_date), max(order_date), INTERVAL 1 DAY)) AS DATE) AS order_date FROM agg),
daily AS (SELECT s.order_date, coalesce(total_sales, 0.0) AS total_sales, CAST(coalesce(n_orders, 0) AS BIGINT) AS n_orders,
            coalesce(price_mean, 0.0) AS price_mean, coalesce(discount_mean, 0.0) AS discount_mean,
            coalesce(quantity_mean, 0.0) AS quantity_mean FROM spine s LEFT JOIN agg USING (order_date))"""
_DAILY_OUT = (f"order_date, {r4('total_sales')} AS total_sales, n_orders, {r4('price_mean')} AS price_mean, "
              f"{r4('discount_mean')} AS discount_mean, {r4('quantity_mean')} AS quantity_mean")
_CAL = """CAST(month(order_date) AS INTEGER) AS month, CAST(quarter(order_date) AS INTEGER) AS quarter,
  CAST(year(order_date) AS INTEGER) AS year, CAST(isodow(order_date) - 1 AS INTEGER) AS day_of_week,
  CAST(day(order_date) AS INTEGER) AS day_of_month, CAST(isodow(order_date) >= 6 AS INTEGER) AS is_weekend,
  CAST(month(order_date) IN (10, 11, 12) AS INTEGER) AS is_festive_month"""
_LAGS = ", ".join(f"lag(total_sales, {k}) OVER (ORDER BY order_date) AS lag_{k}" for k in (1, 2, 3, 7))
_ROLL = """avg(total_sales) OVER (ORDER BY order_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS rolling_7_mean,
  coalesce(stddev_samp(total_sales) OVER (ORDER BY order_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 0.0) AS rolling_7_std,
  avg(total_sales) OVER (ORDER BY order_date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS rolling_30_mean"""


def _dom(key: str, out: str) -> str:
    return f"""
rev_{key} AS (SELECT order_date, {key}, {msum('total_sales')} AS rev FROM sales
              WHERE order_date IS NOT NULL AND {key} IS NOT NULL GROUP BY ALL),
top_{key} AS (SELECT order_date, {key} FROM (SELECT *, row_number() OVER (PARTITION BY order_date ORDER BY rev DESC, {key}) AS rn
              FROM rev_{key}) WHERE rn = 1),
dom_{key} AS (SELECT t.order_date, t.{key}, CAST(c.code AS INTEGER) AS {out} FROM top_{key} t JOIN
              (SELECT {key}, dense_rank() OVER (ORDER BY {key}) - 1 AS code FROM (SELECT DISTINCT {key} FROM top_{key})) c
              USING ({key}))"""


register("daily", f"WITH {_DAILY} SELECT {_DAILY_OUT} FROM daily")
register("calendar", f"WITH {_DAILY} SELECT {_DAILY_OUT}, {_CAL} FROM daily")
register("lags", f"""WITH {_DAILY}, l AS (SELECT order_date, total_sales, {_LAGS} FROM daily)
SELECT order_date, {r4('total_sales')} AS total_sales, {', '.join(f"{r4(f'lag_{k}')} AS lag_{k}" for k in (1, 2, 3, 7))} FROM l""")
register("rolling", f"""WITH {_DAILY}, r AS (SELECT order_date, total_sales, {_ROLL} FROM daily)
SELECT order_date, {r4('total_sales')} AS total_sales, {r4('rolling_7_mean')} AS rolling_7_mean,
  {r4('rolling_7_std')} AS rolling_7_std, {r4('rolling_30_mean')} AS rolling_30_mean FROM r""")
register("dominant", f"""WITH {_dom('product_category', 'category_enc')}, {_dom('region', 'region_enc')}
SELECT order_date, product_category, category_enc, region, region_enc
FROM dom_product_category JOIN dom_region USING (order_date)""")
_FEATURES = f"""{_DAILY}, {_dom('product_category', 'category_enc')}, {_dom('region', 'region_enc')},
f0 AS (SELECT daily.*, {_CAL}, {_LAGS}, {_ROLL} FROM daily),
feat AS (SELECT f0.*, coalesce(c.category_enc, 0) AS category_enc, coalesce(r.region_enc, 0) AS region_enc
         FROM f0 LEFT JOIN dom_product_category c USING (order_date) LEFT JOIN dom_region r USING (order_date))"""
_FEAT_OUT = (_DAILY_OUT + ", month, quarter, year, day_of_week, day_of_month, is_weekend, is_festive_month, "
             + ", ".join(f"{r4(f'coalesce({c}, 0.0)')} AS {c}" for c in
                         ("lag_1", "lag_2", "lag_3", "lag_7", "rolling_7_mean", "rolling_7_std", "rolling_30_mean"))
             + ", category_enc, region_enc")
register("features", f"WITH {_FEATURES} SELECT {_FEAT_OUT} FROM feat")
register("chrono_split", f"""WITH {_FEATURES},
rng AS (SELECT min(order_date) AS d0, datediff('day', min(order_date), max(order_date)) + 1 AS n FROM feat)
SELECT order_date, {r4('total_sales')} AS total_sales,
  order_date < d0 + CAST(floor(n * 0.8) AS INTEGER) AS is_train FROM feat, rng""")
register("recent_history", f"""WITH {_DAILY}
SELECT order_date, {r4('total_sales')} AS total_sales FROM daily
WHERE order_date > (SELECT max(order_date) FROM daily) - INTERVAL 90 DAY""")
register("loyalty_tier", f"""
WITH per AS (SELECT customer_id, order_id, order_date, sum(CAST(total_sales AS DECIMAL(18,2))) AS spend
             FROM sales WHERE customer_id IS NOT NULL GROUP BY ALL),
cum AS (SELECT *, sum(spend) OVER (PARTITION BY customer_id ORDER BY order_date, order_id ROWS UNBOUNDED PRECEDING) AS cum
        FROM per)
SELECT customer_id, order_id, order_date, {r4('CAST(spend AS DOUBLE)')} AS order_spend,
  {r4('CAST(cum AS DOUBLE)')} AS cum_spend,
  CASE WHEN cum >= 50000 THEN 'Gold' WHEN cum >= 15000 THEN 'Silver' ELSE 'Bronze' END AS loyalty_tier FROM cum""")

# ---------------------------------------------------------------- distributions
register("rating_buckets", " UNION ALL ".join(
    f"SELECT CAST({k} AS INTEGER) AS rating, count(*) FILTER (WHERE round_even(customer_rating, 0) = {k}) AS orders FROM sales"
    for k in range(1, 6)))

_HB = {"age": (25, "CAST(age AS DOUBLE)"), "discount": (15, "discount * 100.0"), "total_sales": (50, "total_sales")}
register("histogram", "WITH l AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {e} AS v, {n} AS nbins FROM sales WHERE {c} IS NOT NULL" for c, (n, e) in _HB.items())
    + f"""),
st0 AS (SELECT "column", min(v) AS lo, max(v) AS hi, count(v) AS n, any_value(nbins) AS nbins FROM l GROUP BY "column"),
st AS (SELECT "column", CASE WHEN lo < hi THEN lo ELSE lo - 0.5 END AS lo, CASE WHEN lo < hi THEN hi ELSE hi + 0.5 END AS hi, n, nbins FROM st0),
cnt AS (SELECT "column", CAST(least(floor((v - lo) * (st.nbins / (hi - lo))), st.nbins - 1) AS INTEGER) AS bin, count(*) AS c
        FROM l JOIN st USING ("column") GROUP BY ALL),
spine AS (SELECT "column", lo, hi, n, nbins, CAST(unnest(generate_series(0, nbins - 1)) AS INTEGER) AS bin FROM st)
SELECT "column", bin, {r2('lo + bin * ((hi - lo) / nbins)', 6)} AS bin_lo, {r2('lo + (bin + 1) * ((hi - lo) / nbins)', 6)} AS bin_hi,
  CAST(coalesce(c, 0) AS BIGINT) AS count, {r2('coalesce(c, 0) / (n * ((hi - lo) / nbins))', 10)} AS density
FROM spine LEFT JOIN cnt USING ("column", bin)""")

register("kde", f"""
WITH x AS (SELECT CAST(age AS DOUBLE) AS x FROM sales WHERE age IS NOT NULL),
st AS (SELECT min(x) AS lo, max(x) AS hi, count(x) AS n, stddev_samp(x) AS sd, avg(x) AS mean, median(x) AS med FROM x),
p AS (SELECT *, sd * pow(CAST(n AS DOUBLE), -0.2) AS h FROM st),
vc AS (SELECT x, count(*) AS c FROM x GROUP BY x),
g AS (SELECT CAST(i AS INTEGER) AS i, lo + i * ((hi - lo) / 299) AS gx FROM p, generate_series(0, 299) t(i)),
k AS (SELECT g.i, any_value(g.gx) AS gx, sum(c * exp(-0.5 * ((g.gx - vc.x) / p.h) * ((g.gx - vc.x) / p.h))) AS k
      FROM g, vc, p GROUP BY g.i)
SELECT i AS point, {r2('gx', 6)} AS x, {r2('k / (n * h * sqrt(2 * pi()))', 10)} AS density,
  {r2('mean', 4)} AS mean, {r2('med', 4)} AS median FROM k, p""")


def _quart_sql(value: str, group: str) -> str:
    return (f"SELECT {group}, quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.5) AS median, "
            f"quantile_cont({value}, 0.75) AS q3 FROM sales WHERE {group} IS NOT NULL AND {value} IS NOT NULL "
            f"GROUP BY {group}")


register("violin", f"""WITH q AS ({_quart_sql('unit_price', 'product_category')})
SELECT product_category, CAST(row_number() OVER (ORDER BY median DESC, product_category) AS INTEGER) AS position,
  {r2('q1', 4)} AS q1, {r2('median', 4)} AS median, {r2('q3', 4)} AS q3 FROM q""")
register("box", f"""WITH q AS ({_quart_sql('customer_rating', 'product_category')}),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo_f, q3 + 1.5 * (q3 - q1) AS hi_f FROM q),
a AS (SELECT s.product_category, any_value(q1) AS q1, any_value(median) AS median, any_value(q3) AS q3,
        min(CASE WHEN customer_rating BETWEEN lo_f AND hi_f THEN customer_rating END) AS whisker_lo,
        max(CASE WHEN customer_rating BETWEEN lo_f AND hi_f THEN customer_rating END) AS whisker_hi,
        count(*) FILTER (WHERE NOT (customer_rating BETWEEN lo_f AND hi_f)) AS fliers, avg(customer_rating) AS mean
      FROM sales s JOIN f USING (product_category) WHERE customer_rating IS NOT NULL GROUP BY s.product_category)
SELECT product_category, CAST(row_number() OVER (ORDER BY mean DESC, product_category) AS INTEGER) AS position,
  {r2('q1', 4)} AS q1, {r2('median', 4)} AS median, {r2('q3', 4)} AS q3, {r2('whisker_lo', 4)} AS whisker_lo,
  {r2('whisker_hi', 4)} AS whisker_hi, fliers, {r2('mean', 4)} AS mean FROM a""")

# ---------------------------------------------------------------- sources and sinks
register("csv_roundtrip", "SELECT * REPLACE (CAST(order_id AS VARCHAR) AS order_id, "
         "CAST(customer_id AS VARCHAR) AS customer_id) FROM sales_raw", raw=True, clean=False)
register("value_audit", f"""
SELECT 'before' AS stage, gender AS value, count(*) AS rows FROM sales_raw WHERE gender IS NOT NULL GROUP BY gender
UNION ALL
SELECT 'after', g, count(*) FROM (SELECT {C.gender_std()} AS g FROM sales_raw) WHERE g IS NOT NULL GROUP BY g""",
         raw=True, clean=False)
register("violin_density", f"""
WITH x AS (SELECT product_category, CAST(unit_price AS DOUBLE) AS x FROM sales
           WHERE product_category IS NOT NULL AND unit_price IS NOT NULL),
st AS (SELECT product_category, min(x) AS lo, max(x) AS hi, count(x) AS n, stddev_samp(x) AS sd FROM x GROUP BY ALL),
p AS (SELECT *, coalesce(sd, 0.0) * pow(CAST(n AS DOUBLE), -0.2) AS h FROM st),
p2 AS (SELECT *, lo - 2.0 * h AS g0, (hi - lo + 2 * 2.0 * h) / 99 AS step FROM p),
vc AS (SELECT product_category, x, count(*) AS c FROM x GROUP BY ALL),
g AS (SELECT product_category, CAST(i AS INTEGER) AS point, g0 + i * step AS gx, n, h FROM p2, generate_series(0, 99) t(i)),
k AS (SELECT g.product_category, g.point, any_value(g.gx) AS gx,
        sum(vc.c * exp(-0.5 * ((g.gx - vc.x) / nullif(g.h, 0)) * ((g.gx - vc.x) / nullif(g.h, 0)))) / nullif(any_value(g.n) * any_value(g.h) * sqrt(2 * pi()), 0) AS d
      FROM g JOIN vc USING (product_category) GROUP BY g.product_category, g.point)
SELECT product_category, point, {r2('gx', 6)} AS x, {r2('d', 12)} AS density FROM k""")
register("geo_consistency", "WITH " + C.chain() + """,
per AS (SELECT city, region, count(*) AS rows FROM clean WHERE city IS NOT NULL AND region IS NOT NULL GROUP BY ALL)
SELECT city, CAST(count(*) AS BIGINT) AS regions, CAST(sum(rows) AS BIGINT) AS rows FROM per
GROUP BY city HAVING count(*) > 1""", raw=True, clean=False)

# ---------------------------------------------------------------- p-values in closed form
# F with 4 numerator degrees of freedom (five groups): I_x(a, 2) = x^a (1 + a (1 - x)), x = d2 / (d2 + d1 F), a = d2 / 2
register("anova_test", f"""
WITH {_GM},
p AS (SELECT sum(g.n * (mean - gm) * (mean - gm)) AS ssb, sum((g.n - 1) * coalesce(var, 0.0)) AS ssw,
             any_value(k) AS k, any_value(tot_n) AS tot_n FROM g, t),
f AS (SELECT (ssb / (k - 1)) / (ssw / (tot_n - k)) AS f, k - 1 AS d1, tot_n - k AS d2 FROM p),
q AS (SELECT *, d2 / (d2 + d1 * f) AS x, d2 / 2.0 AS a FROM f),
r AS (SELECT *, pow(x, a) * (1 + a * (1 - x)) AS p FROM q)
SELECT {r2('f', 4)} AS f_stat, CAST(d1 AS BIGINT) AS df_between, CAST(d2 AS BIGINT) AS df_within,
       {r2('p', 4)} AS p_value, p < 0.05 AS significant FROM r WHERE d1 = 4""")
# chi-square with an even number 2m of degrees of freedom: exp(-x/2) sum over i < m of (x/2)^i / i!
register("chi_square_test", f"""
WITH {_CT},
cells AS (SELECT CAST(observed AS DOUBLE) AS o,
  sum(observed) OVER (PARTITION BY payment_method) * sum(observed) OVER (PARTITION BY gender)
    / (SELECT sum(observed) FROM ct) AS e FROM ct),
s AS (SELECT sum((o - e) * (o - e) / e) AS x, (SELECT (SELECT count(*) FROM ra) - 1) * (SELECT (SELECT count(*) FROM cb) - 1) AS dof FROM cells),
p AS (SELECT x, dof, exp(-x / 2) * (SELECT sum(pow(s.x / 2, i) / gamma(i + 1)) FROM generate_series(0, 30) t(i) WHERE i < s.dof // 2) AS p FROM s)
SELECT {r2('x', 4)} AS chi2_stat, CAST(dof AS BIGINT) AS dof, {r2('p', 4)} AS p_value, p < 0.05 AS significant
FROM p WHERE dof % 2 = 0""")

# Student's t as the continued fraction of the incomplete beta function, from its last term back
_FRACTION = """list_reduce(list_concat([1.0], list_transform(range(CAST(200 + 12 * sqrt(greatest(a, b)) AS BIGINT), 0, -1),
  lambda i: CASE WHEN i % 2 = 0 THEN (i // 2) * (b - i // 2) * x / ((a + i - 1) * (a + i))
                 ELSE -(a + i // 2) * (a + b + i // 2) * x / ((a + i - 1) * (a + i)) END)), lambda f, d: 1.0 + d / f)"""
register("pearson_test", "WITH c AS (SELECT * FROM sales WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in _DESC) + "),\ns AS ("
         + " UNION ALL ".join(f"SELECT '{x}' AS c1, '{y}' AS c2, count(*) AS n, corr({x}, {y}) AS r FROM c" for x, y in _pairs(_DESC)) + f"""),
t AS (SELECT *, r * r AS x0, 0.5 AS a0, (n - 2) / 2.0 AS b0 FROM s),
q AS (SELECT *, x0 < (a0 + 1) / (a0 + b0 + 2) AS low FROM t),
u AS (SELECT *, CASE WHEN low THEN x0 ELSE 1 - x0 END AS x, CASE WHEN low THEN a0 ELSE b0 END AS a,
             CASE WHEN low THEN b0 ELSE a0 END AS b FROM q),
w AS (SELECT *, exp(a * ln(x) + b * ln(1 - x) + lgamma(a + b) - lgamma(a) - lgamma(b)) / a / {_FRACTION} AS i FROM u)
SELECT c1, c2, n, {r2('r', 3)} AS r, {r2('CASE WHEN low THEN 1 - i ELSE i END', 4)} AS p_value FROM w""")


def _ln_normal_sf(z: str) -> str:
    """ln P(Z > z): power series within 2.5 deviations, Mills' continued fraction beyond."""
    series, fraction = "1.0", "u"
    for k in range(32, 0, -1):
        series = f"(1 + {z} * {z} / {2 * k + 1} * {series})"
    for k in range(50, 0, -1):
        fraction = f"(u + {k} / {fraction})"
    far = f"(-u * u / 2 - 0.5 * ln(2 * pi()) - ln({fraction}))"
    return (f"CASE WHEN {z} > 2.5 THEN {far} WHEN {z} < -2.5 THEN ln(1 - exp({far})) "
            f"ELSE ln(0.5 - {z} * {series} * exp(-{z} * {z} / 2) / sqrt(2 * pi())) END")


_NORMAL = ("age", "unit_price", "total_sales", "customer_rating", "discount")
_POLY = {0.5: (2.76773, -19.828315, 80.709644, -138.55152, 81.218052), 0.9: (-4.901232, 40.662806, -97.490286, 94.029866, -32.355711),
         1.31: (6.198765, -19.558097, 23.186922, -12.234627, 2.423045)}
_RANKS = f"""
WITH l AS ({' UNION ALL '.join(f"SELECT '{c}' AS col, CAST({c} AS DOUBLE) AS v FROM sales WHERE {c} IS NOT NULL" for c in _NORMAL)}),
m AS (SELECT col, count(*) AS n, avg(v) AS mu, stddev_samp(v) AS sd FROM l GROUP BY col),
r AS (SELECT col, n, (v - mu) / sd AS z, row_number() OVER (PARTITION BY col ORDER BY v) AS i, count(*) OVER (PARTITION BY col ORDER BY v) AS hi,
             count(*) OVER (PARTITION BY col, v) AS c FROM l JOIN m USING (col)),
e AS (SELECT *, greatest(abs(z), 2.5) AS u FROM r),
f AS (SELECT *, {_ln_normal_sf('z')} AS above, {_ln_normal_sf('(-z)')} AS under FROM e),
s AS (SELECT col, any_value(n) AS n, -any_value(n) - sum((2 * i - 1) * under + (2 * n + 1 - 2 * i) * above) / any_value(n) AS a2,
             max(greatest(CAST(hi AS DOUBLE) / n - exp(under), exp(under) - CAST(hi - c AS DOUBLE) / n)) AS d FROM f GROUP BY col),
t AS (SELECT *, a2 * (1 + 0.75 / n + 2.25 / (CAST(n AS DOUBLE) * n)) AS a, CASE WHEN n > 100 THEN d * pow(n / 100.0, 0.49) ELSE d END AS kd,
             least(n, 100.0) AS nd, (sqrt(n) - 0.01 + 0.85 / sqrt(n)) * d AS k FROM s),
p AS (SELECT *, CASE WHEN a < 0.2 THEN 1 - exp(-13.436 + 101.14 * a - 223.73 * a * a) WHEN a < 0.34 THEN 1 - exp(-8.318 + 42.796 * a - 59.938 * a * a)
             WHEN a < 0.6 THEN exp(0.9177 - 4.279 * a - 1.38 * a * a) WHEN a < 10 THEN exp(1.2937 - 5.709 * a + 0.0186 * a * a) ELSE 3.7e-24 END AS pa,
             exp(-7.01256 * kd * kd * (nd + 2.78019) + 2.99587 * kd * sqrt(nd + 2.78019) - 0.122119 + 0.974598 / sqrt(nd) + 1.67997 / nd) AS p0 FROM t),
o AS (SELECT *, CASE WHEN p0 <= 0.1 THEN p0 WHEN k <= 0.302 THEN 1.0
             {' '.join(f"WHEN k <= {x} THEN " + ' + '.join(f'({c}) * pow(k, {j})' for j, c in enumerate(cs)) for x, cs in _POLY.items())} ELSE 0.0 END AS pl FROM p)"""
register("normality_full", f"""{_RANKS}
SELECT col AS column, n, {r2('a2', 4)} AS ad_stat, {r2('pa', 4)} AS ad_p, {r2('d', 6)} AS lf_stat, {r2('pl', 4)} AS lf_p,
       CASE WHEN pa > 0.05 THEN 'Yes' ELSE 'No' END AS normal FROM o""")
register("ks_normal", f"{_RANKS} SELECT col AS column, {r2('d', 6)} AS ks_stat, {r2('pl', 4)} AS p_value FROM o")

# ---------------------------------------------------------------- malformed lines: the faults that the query puts in
ORACLE["csv_quarantine"] = """
WITH k AS (SELECT l_orderkey * 7 + l_linenumber AS k FROM lineitem),
w AS (SELECT k, k % 73 = 0 OR k % 71 = 0 AS wide FROM k),
f AS (SELECT NULL AS field, 'columns' AS reason, count(*) AS rows FROM w WHERE wide
      UNION ALL SELECT 'l_quantity', 'type', count(*) FROM w WHERE NOT wide AND k % 97 = 0
      UNION ALL SELECT 'l_extendedprice', 'type', count(*) FROM w WHERE NOT wide AND k % 89 = 0
      UNION ALL SELECT 'l_shipdate', 'type', count(*) FROM w WHERE NOT wide AND k % 83 = 0
      UNION ALL SELECT 'l_orderkey', 'missing', count(*) FROM w WHERE NOT wide AND k % 79 = 0
      UNION ALL SELECT NULL, 'good', count(*) FROM w WHERE NOT wide AND k % 97 <> 0 AND k % 89 <> 0 AND k % 83 <> 0 AND k % 79 <> 0)
SELECT field, reason, rows FROM f WHERE rows > 0 OR reason = 'good'"""

# ---------------------------------------------------------------- samples: the smallest md5 of the key
_KEY = ("order_id", "product_name", "quantity", "shipping_days", "return_flag", "CAST(round(total_sales * 100) AS BIGINT)")


def _md5(cols) -> str:
    return "md5('42|' || " + " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in cols) + ")"


register("row_sample", f"SELECT * FROM sales ORDER BY {_md5(_KEY)}, order_id, product_name, quantity LIMIT 800")
register("shapiro_input", " UNION ALL ".join(
    f"SELECT * FROM (SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS v FROM sales WHERE {c} IS NOT NULL "
    f"ORDER BY {_md5(_KEY)} LIMIT 500)" for c in _NORM))

# ---------------------------------------------------------------- metrics and monthly roll-up on fixed pairs
_PAIRS = f"""{_FEATURES}, pairs AS (SELECT order_date, total_sales AS actual, coalesce(rolling_7_mean, 0.0) AS predicted FROM feat)"""
register("naive_metrics", f"""WITH {_PAIRS}
SELECT {r2('avg(abs(actual - predicted))')} AS "MAE", {r2('sqrt(avg((actual - predicted) * (actual - predicted)))')} AS "RMSE",
  {r2('1 - sum((actual - predicted) * (actual - predicted)) / (var_pop(actual) * count(*))', 4)} AS "R2", count(*) AS test_days FROM pairs""")
register("naive_monthly", f"""WITH {_PAIRS}
SELECT strftime(date_trunc('month', order_date), '%b %Y') AS month_label, CAST(date_trunc('month', order_date) AS DATE) AS month_start,
  {r4('sum(predicted)')} AS predicted_sales, {r4('sum(predicted) * 0.85')} AS lower, {r4('sum(predicted) * 1.15')} AS upper
FROM pairs GROUP BY ALL""")

# ---------------------------------------------------------------- the same operators over raw rows and over cleaned rows
ON_RAW = ("describe", "pearson", "corr_matrix", "contingency", "regional", "category_share")
ON_CLEAN = ("describe", "pearson", "regional", "daily", "monthly", "anova_test", "chi_square", "repeat_customers")
for _n in ON_RAW:
    ORACLE[f"{_n}_raw"] = with_views(BODIES[_n], sales="sales AS (SELECT * FROM sales_raw)")
for _n in ON_CLEAN:
    ORACLE[f"{_n}_clean"] = with_views(BODIES[_n], sales=C.chain().strip() + ",\nsales AS (SELECT * FROM clean)")
ORACLE["box_raw"] = with_views(BODIES["box"].replace("customer_rating", "unit_price"), sales="sales AS (SELECT * FROM sales_raw)")

# ---------------------------------------------------------------- the published report set: rows of every table, all intact
_TABLES = {"descriptive": "describe", "anova": "anova_test", "region_means": "region_means", "chi_square": "chi_square_test",
           "correlations": "pearson", "abc": "abc", "abc_tiers": "abc_tiers", "repeat": "repeat_customers", "returns": "return_rate",
           "kpis": "kpis", "top_entities": "top_entities", "yearly_growth": "yearly_growth", "regional": "regional",
           "loyalty": "loyalty", "top_products": "top_products"}
_COUNTS = [f"SELECT '{t}' AS t, count(*) AS n FROM ({BODIES[b].strip()})" for t, b in _TABLES.items()]
_COUNTS = [c.replace("LIMIT 10", "LIMIT 5") if "'top_products'" in c else c for c in _COUNTS]
# fixed numbers of rows: tested columns, one report, six checks, one row of metrics, the ten first features
_COUNTS += [f"SELECT '{t}', {n}" for t, n in {"normality": 5, "dq_report": 1, "validation": 6, "ml_metrics": 1, "ml_cv": 1, "ml_importance": 10}.items()]
_COUNTS += ["""SELECT 'ml_forecast', count(DISTINCT date_trunc('month', d + CAST(i AS INTEGER)))
  FROM (SELECT max(order_date) AS d FROM sales), generate_series(1, 90) g(i)""", f"SELECT 'dq_issues', count(*) FROM ({ORACLE['dq_issues']})"]
ORACLE["report_tables"] = with_views('SELECT t AS "table", CAST(n AS BIGINT) AS rows, true AS intact FROM (' + "\nUNION ALL ".join(_COUNTS) + ")",
                                     sales=C.chain().strip() + ",\nsales AS (SELECT * FROM clean)")
register("model_save", f"""WITH {_DAILY}, {_dom('product_category', 'category_enc')}, {_dom('region', 'region_enc')},
n AS (SELECT datediff('day', min(order_date), max(order_date)) + 1 AS n FROM daily)
SELECT n - CAST(floor(n * 0.8) AS BIGINT) AS test_days, 0 AS differ, 200 AS trees, 19 AS features,
       (SELECT count(DISTINCT product_category) FROM dom_product_category) + (SELECT count(DISTINCT region) FROM dom_region) AS codes FROM n""")

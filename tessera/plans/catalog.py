"""Registry of named queries: name -> (spark, sf_dir) -> DataFrame.

Each entry reads the test tables through ``tessera.sources`` and runs one
operator (or a short chain) over the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.operators import marts
from tessera.params import ForecastParams, ReportingParams
from tessera.session import materialize
from tessera.sources import LINE_ORDER, raw_shares
from tessera.sources import sales as _sales_view
from tessera.sources import sales_raw as _sales_raw_view

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
_TABLES: dict = {}

#: Session setting: "true" writes each sales view once and lets all queries of the session read the
#: copy. For a batch that runs many queries; by itself every query prunes its own source scans.
STAGE = "spark.tessera.stage"


def _version(spark: SparkSession, sf_dir: str) -> tuple:
    """What a kept result depends on: the application, and the files of the tables it reads."""
    sc = spark.sparkContext
    parts = [sc.applicationId, sf_dir]
    for t in ("lineitem", "orders", "customer", "part", "nation", "region"):
        path = sc._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{t}.parquet")
        for f in path.getFileSystem(sc._jsc.hadoopConfiguration()).listStatus(path):
            parts.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(parts)


def _stage(name: str, build, spark: SparkSession, sf_dir: str) -> DataFrame:
    if spark.conf.get(STAGE, "false") != "true":
        return build(spark, sf_dir)
    key = (name, _version(spark, sf_dir))
    if key not in _TABLES:
        _TABLES[key] = materialize(build(spark, sf_dir))
    return _TABLES[key]


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stage("sales", _sales_view, spark, sf_dir)


def sales_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stage("sales_raw", _sales_raw_view, spark, sf_dir)


def _on_sales(name: str, op, **kw) -> None:
    QUERIES[name] = lambda spark, sf_dir: op(sales(spark, sf_dir), **kw)


REPORTING = ReportingParams()

# ---------------------------------------------------------------- marts
_on_sales("kpis", marts.kpis)
_on_sales("distinct_customers", marts.distinct_customers)
_on_sales("top_entities", marts.top_entities)
_on_sales("yearly_growth", marts.yearly_growth)
_on_sales("regional", marts.regional)
_on_sales("loyalty", marts.loyalty)
_on_sales("category_share", marts.category_share)
_on_sales("monthly", marts.monthly)
_on_sales("payment_split", marts.split, key="payment_method", with_aov=True)
_on_sales("gender_split", marts.split, key="gender")
_on_sales("quarter_yoy", marts.quarter_yoy)
_on_sales("region_category", marts.region_category)
_on_sales("top_products", marts.top_products, n=REPORTING.top_n_products)
_on_sales("top5_products", marts.top_products, n=REPORTING.top_k_summary)

# ---------------------------------------------------------------- cleaning
from tessera.operators import clean as C  # noqa: E402
from tessera.operators import quality as Q  # noqa: E402


def _on_raw(name: str, fn) -> None:
    QUERIES[name] = lambda spark, sf_dir: fn(sales_raw(spark, sf_dir))


_on_raw("dedup", C.remove_duplicates)
_on_raw("date_fix", lambda r: C.drop_flags(C.fix_dates(r)))
_on_raw("standardise", lambda r: C.drop_flags(C.standardise_categoricals(r)))
_on_raw("invalid_values", lambda r: C.drop_flags(C.fix_invalid_values(r)))
_on_raw("value_audit", C.value_audit)
_on_raw("impute", C.impute_missing)
_on_raw("iqr_bounds", lambda r: C.iqr_bounds(r, ["unit_price"], 3.0))
_on_raw("iqr_cap", lambda r: C.cap_outliers(r).drop("_cap_unit_price"))
_on_raw("zscore_count", lambda r: C.zscore_count(r, "age", 3.0))
_on_raw("derive", lambda r: C.drop_flags(C.type_cast(C.recompute_derived(C.fix_dates(r)))))
_on_raw("raw_profile", Q.raw_profile)
_CLEANED: dict = {}


def cleaned(spark: SparkSession, sf_dir: str) -> C.CleanResult:
    """One clean run per (session, tables): its four outputs share the staged table.

    The chain reads the raw join directly: its own staged table is the one
    materialisation it needs (staging the raw view first would write twice)."""
    key = _version(spark, sf_dir)
    if key not in _CLEANED:
        _CLEANED[key] = C.clean_sales(_sales_raw_view(spark, sf_dir), shares=raw_shares(spark, sf_dir), near=LINE_ORDER)
    return _CLEANED[key]


QUERIES["cleaned_sales"] = lambda spark, sf_dir: cleaned(spark, sf_dir).clean
QUERIES["validation"] = lambda spark, sf_dir: cleaned(spark, sf_dir).validation
QUERIES["dq_report"] = lambda spark, sf_dir: cleaned(spark, sf_dir).report
QUERIES["dq_issues"] = lambda spark, sf_dir: cleaned(spark, sf_dir).issues

# ---------------------------------------------------------------- statistics
from pyspark.sql import functions as _F  # noqa: E402

from tessera.operators import stats as S  # noqa: E402

_on_sales("describe", S.describe)
_on_sales("anova", S.anova)
_on_sales("anova_test", S.anova_test)
_on_sales("region_means", S.group_means)
_on_sales("contingency", S.contingency)
_on_sales("chi_square", S.chi_square)
_on_sales("chi_square_test", S.chi_square_test)
_on_sales("pearson", S.pearson)
_on_sales("pearson_test", S.pearson_test)
_on_sales("corr_matrix", S.corr_matrix)
_on_sales("abc", S.abc)
QUERIES["abc_tiers"] = lambda spark, sf_dir: S.abc_tiers(S.abc(sales(spark, sf_dir)))
_on_sales("repeat_customers", S.repeat_customers)
_on_sales("return_rate", S.return_rate)
_on_sales("linear_fit", S.linear_fit)
_on_sales("jarque_bera", S.jarque_bera)
# a key that covers the row: ties in it are rows equal in every column of the key
SAMPLE_KEY = ("order_id", "product_name", "quantity", "shipping_days", "return_flag", "_cents")


def _keyed(op, **kw):
    def run(spark, sf_dir):
        s = sales(spark, sf_dir).withColumn("_cents", _F.round(_F.col("total_sales") * 100).cast("long"))
        return op(s, key_cols=SAMPLE_KEY, **kw).drop("_cents")
    return run


QUERIES["shapiro_sample"] = _keyed(S.normality, sample_size=REPORTING.normality_sample)
QUERIES["shapiro_input"] = _keyed(S.normality_sample, sample_size=REPORTING.normality_sample)
QUERIES["row_sample"] = _keyed(S.row_sample, n=REPORTING.sample_rows)

# ---------------------------------------------------------------- features
from pyspark.sql.types import DoubleType as _Double  # noqa: E402

from tessera.operators import features as M  # noqa: E402


def round_doubles(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round double columns at the outermost select (engines sum in different
    orders; the comparison is on rounded values)."""
    from tessera.functions.numeric import round_half_even
    return df.select(*[round_half_even(_F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, _Double) else _F.col(f.name) for f in df.schema.fields])


def _feat(name: str, fn) -> None:
    QUERIES[name] = lambda spark, sf_dir: round_doubles(fn(sales(spark, sf_dir)))


_feat("daily", M.daily)
_feat("calendar", lambda s: M.calendar(M.daily(s)))
_feat("lags", lambda s: M.lags(M.daily(s)).select("order_date", "total_sales", "lag_1", "lag_2", "lag_3", "lag_7"))
_feat("rolling", lambda s: M.rolling(M.daily(s)).select("order_date", "total_sales", "rolling_7_mean",
                                                         "rolling_7_std", "rolling_30_mean"))
_feat("dominant", lambda s: M.dominant(s, "product_category", "category_enc").join(
    M.dominant(s, "region", "region_enc"), "order_date"))
_feat("features", M.features)
_feat("chrono_split", lambda s: M.chrono_split(M.features(s)).select("order_date", "total_sales", "is_train"))
_feat("recent_history", lambda s: M.recent_history(M.daily(s)))
_feat("loyalty_tier", M.loyalty_tier)

# ---------------------------------------------------------------- forecast
from tessera.operators import forecast as FC  # noqa: E402

_FITTED: dict = {}
#: What the features, the encoders and the forecast read of a sale.
FORECAST_COLS = ("order_date", "order_id", "region", "product_category", "total_sales", "unit_price", "discount", "quantity")


def forecast_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales as the forecast reads them: several aggregates scan them, so the joins behind them run once."""
    s = sales(spark, sf_dir)
    return s if spark.conf.get(STAGE, "false") == "true" else materialize(s.select(*FORECAST_COLS))


def fitted(spark: SparkSession, sf_dir: str):
    """One forest per (session, tables): the forecast queries share it."""
    key = _version(spark, sf_dir)
    if key not in _FITTED:
        s = forecast_sales(spark, sf_dir)
        _FITTED[key] = (FC.fit(M.features(s)), s)
    return _FITTED[key]


def _daily_forecast(spark, sf_dir):
    fc, s = fitted(spark, sf_dir)
    return FC.forecast_daily(fc, s)


QUERIES["rf_eval"] = lambda spark, sf_dir: FC.evaluation(fitted(spark, sf_dir)[0])
QUERIES["rf_metrics"] = lambda spark, sf_dir: FC.metrics_of(FC.evaluation(fitted(spark, sf_dir)[0]))
QUERIES["ts_cv"] = lambda spark, sf_dir: FC.ts_cv(fitted(spark, sf_dir)[0])
QUERIES["cv_summary"] = lambda spark, sf_dir: FC.cv_summary(FC.ts_cv(fitted(spark, sf_dir)[0]))
QUERIES["importance"] = lambda spark, sf_dir: FC.importance(fitted(spark, sf_dir)[0], top_n=10)
QUERIES["forecast_daily"] = _daily_forecast


def _by_region(spark, sf_dir):
    """M12 in its parallel form: one forest over all regions' days, a forecast for each region."""
    s = forecast_sales(spark, sf_dir).where("region IS NOT NULL")
    return FC.forecast_daily(FC.fit(M.features(s, series=("region",)), series=("region",)), s)


def _strict(spark, sf_dir):
    """M8 without same-day features: test metrics of what is known the day before."""
    fc = FC.fit(M.features(forecast_sales(spark, sf_dir)), ForecastParams(strict_features=True))
    return FC.metrics_of(FC.evaluation(fc))


def _naive_pairs(spark, sf_dir):
    """Fixed (actual, predicted) pairs: the mean of the last seven days as the prediction."""
    f = M.features(sales(spark, sf_dir))
    return f.select("order_date", _F.col("total_sales").alias("actual"), _F.col("rolling_7_mean").alias("predicted"))


QUERIES["forecast_by_region"] = _by_region
QUERIES["strict_features"] = _strict
QUERIES["naive_metrics"] = lambda spark, sf_dir: FC.metrics_of(_naive_pairs(spark, sf_dir))
QUERIES["naive_monthly"] = lambda spark, sf_dir: round_doubles(FC.forecast_monthly(
    _naive_pairs(spark, sf_dir).select("order_date", _F.col("predicted").alias("predicted_sales"))))
QUERIES["forecast_monthly"] = lambda spark, sf_dir: FC.forecast_monthly(_daily_forecast(spark, sf_dir))
QUERIES["timeline"] = lambda spark, sf_dir: FC.timeline(fitted(spark, sf_dir)[0], _daily_forecast(spark, sf_dir))

# ---------------------------------------------------------------- distributions
from tessera.operators import distributions as DI  # noqa: E402

_on_sales("rating_buckets", DI.rating_buckets)
_on_sales("histogram", DI.histogram)
_on_sales("kde", DI.kde)
_on_sales("violin", DI.violin)
_on_sales("box", DI.box)

# ---------------------------------------------------------------- sources and sinks
from tessera.sources import files as FI  # noqa: E402
from tessera.session import stage_path as _stage_path  # noqa: E402
from tessera.sources import tables as FI_tables  # noqa: E402


def _csv_roundtrip(spark, sf_dir):
    """S1 + S3: write the raw frame as CSV, read it back with the declared schema."""
    path = _stage_path(spark, "csv")
    FI.write_table(sales_raw(spark, sf_dir), path, fmt="csv")
    return FI.read_csv(spark, path)


def _pipeline_report(spark, sf_dir):
    """The whole run: clean, A14 on the cleaned rows, the model, and S5-S7 written; row counts read back."""
    cr = cleaned(spark, sf_dir)
    s = materialize(cr.clean)  # some thirty scans follow
    fc = FC.fit(M.features(s))
    daily_fc = FC.forecast_daily(fc, s)
    tables = dict(S.run_analysis(s))
    tables.update({"kpis": marts.kpis(s), "top_entities": marts.top_entities(s),
                   "yearly_growth": marts.yearly_growth(s), "regional": marts.regional(s),
                   "loyalty": marts.loyalty(s), "top_products": marts.top_products(s, REPORTING.top_k_summary),
                   "dq_report": cr.report, "dq_issues": cr.issues, "validation": cr.validation,
                   "ml_metrics": FC.metrics_of(FC.evaluation(fc)), "ml_cv": FC.cv_summary(FC.ts_cv(fc)),
                   "ml_importance": FC.importance(fc, 10), "ml_forecast": FC.forecast_monthly(daily_fc)})
    base = _stage_path(spark, "reports")
    FI.write_reports(tables, base)
    return FI.check_reports(spark, base)


def _csv_quarantine(spark, sf_dir):
    """Lineitem as CSV lines, some of them broken, read back in two parts: lines by field and reason, and good rows."""
    from pyspark.sql.types import StructField, StructType

    li = FI_tables.read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", _F.to_date("l_shipdate").alias("l_shipdate"), "l_returnflag")
    schema = StructType([StructField(f.name, f.dataType, f.name != "l_orderkey") for f in li.schema.fields])
    k = _F.col("l_orderkey") * 7 + _F.col("l_linenumber")
    text = {c: _F.col(c).cast("string") for c in li.columns}
    text["l_quantity"] = _F.when(k % 97 == 0, "many").otherwise(text["l_quantity"])
    text["l_extendedprice"] = _F.when(k % 89 == 0, "12,5 EUR").otherwise(text["l_extendedprice"])
    text["l_shipdate"] = _F.when(k % 83 == 0, "99/99/9999").otherwise(text["l_shipdate"])
    text["l_orderkey"] = _F.when(k % 79 == 0, "").otherwise(text["l_orderkey"])
    cells = [_F.concat(_F.lit('"'), c, _F.lit('"')) if n == "l_extendedprice" else c for n, c in text.items()]
    line = _F.concat_ws(",", *cells)
    line = _F.when(k % 73 == 0, _F.concat(line, _F.lit(",more"))).when(k % 71 == 0, _F.concat_ws(",", *cells[:-2])).otherwise(line)
    path = _stage_path(spark, "lines")
    li.select(line.alias("value")).write.text(path)
    good, bad = FI.read_quarantined(spark, path, schema, header=False)
    reasons = bad.select(_F.explode("reasons").alias("r")).groupBy("r.field", "r.reason").agg(_F.count(_F.lit(1)).alias("rows"))
    total = good.agg(_F.lit(None).cast("string").alias("field"), _F.lit("good").alias("reason"), _F.count(_F.lit(1)).alias("rows"))
    return reasons.unionByName(total)


def _model_save(spark, sf_dir):
    """Save the pipeline, its feature list and the encoders, read them back, and score the test days from the saved trees."""
    fc, s = fitted(spark, sf_dir)
    path = FC.save_model(fc, path=_stage_path(spark, "model"), codes=FC.encoders(s))
    both = FC.score_saved(fc.model.transform(fc.test), path, out="again")
    far = _F.abs(_F.col("again") - _F.col("prediction")) > 1e-9 * _F.greatest(_F.abs("prediction"), _F.lit(1.0))
    codes = spark.read.parquet(f"{path}/encoders").agg(_F.count(_F.lit(1)).alias("codes")).scalar()
    features = spark.read.parquet(f"{path}/feature_list").agg(_F.count(_F.lit(1)).alias("features")).scalar()
    trees = spark.read.parquet(FC.node_path(path)).agg(_F.count_distinct("treeID").alias("trees")).scalar()
    return both.agg(_F.count(_F.lit(1)).alias("test_days"), _F.count_if(far).alias("differ")).select(
        "test_days", "differ", trees.alias("trees"), features.alias("features"), codes.alias("codes"))


QUERIES["csv_roundtrip"] = _csv_roundtrip
QUERIES["csv_quarantine"] = _csv_quarantine
QUERIES["report_tables"] = _pipeline_report
QUERIES["model_save"] = _model_save
_on_sales("violin_density", DI.kde_by)
QUERIES["forecast_band"] = lambda spark, sf_dir: FC.empirical_band(fitted(spark, sf_dir)[0],
                                                                   _daily_forecast(spark, sf_dir))
QUERIES["geo_consistency"] = lambda spark, sf_dir: Q.geo_consistency(cleaned(spark, sf_dir).clean)
_on_sales("ks_normal", S.ks_normal)
_on_sales("normality_full", S.normality_full)

# ---------------------------------------------------------------- the same operators over raw rows (nulls, copies, outliers) and cleaned rows
for _name, _op in {"describe": S.describe, "pearson": S.pearson, "corr_matrix": S.corr_matrix, "contingency": S.contingency,
                   "regional": marts.regional, "category_share": marts.category_share}.items():
    QUERIES[f"{_name}_raw"] = lambda spark, sf_dir, op=_op: op(sales_raw(spark, sf_dir))
QUERIES["box_raw"] = lambda spark, sf_dir: DI.box(sales_raw(spark, sf_dir), value="unit_price")
for _name, _op in {"describe": S.describe, "pearson": S.pearson, "regional": marts.regional, "monthly": marts.monthly,
                   "daily": lambda s: round_doubles(M.daily(s)), "anova_test": S.anova_test, "chi_square": S.chi_square,
                   "repeat_customers": S.repeat_customers}.items():
    QUERIES[f"{_name}_clean"] = lambda spark, sf_dir, op=_op: op(cleaned(spark, sf_dir).clean)

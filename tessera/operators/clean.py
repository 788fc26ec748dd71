"""Cleaning steps C1-C17 and the chained clean.

Each step is ``DataFrame -> DataFrame`` and can be used with ``.transform``.
Row-level steps are pure projections (one codegen stage, no shuffle). The
steps that need a global parameter (median date, medians, modes, IQR bounds)
compute it as a distributed aggregate and bring back only the few scalar
values (as Spark ML's ``Imputer`` does with its surrogates); they enter the
row-level plan as literals, so plans stay flat, Catalyst can fold them, and
no cross join is planned.
Counter columns (``_bad_date``, ``_g_fixed`` ...) are kept as flags until the
report has counted them; ``drop_flags`` removes them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tessera.functions.numeric import clip, round_half_even, round_half_up
from tessera.functions.quantiles import percentiles
from tessera.functions.text import GENDER_CANONICAL, GENDER_MAP, lookup, py_strip, title_case
from tessera.params import CleaningParams
from tessera.session import materialize, materialize_each

FLAGS = ("_bad_date", "_g_fixed", "_g_unknown", "_neg_qty", "_bad_rating")


def drop_flags(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in FLAGS if c in df.columns])


def nan_to_null(df: DataFrame) -> DataFrame:
    """pandas treats NaN as missing; make it SQL NULL so counts, medians and
    fills skip it the same way."""
    cols = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast(df.schema[c].dataType)) for c in cols}) \
        if cols else df


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


# ------------------------------------------------------------------ C1
def remove_duplicates(df: DataFrame) -> DataFrame:
    """Keep one of each identical row (nulls compare equal).

    A hash aggregate on all columns: partial aggregation in each task first
    collapses copies, so a row repeated a billion times costs one row per task
    in the shuffle.
    """
    return df.dropDuplicates()


def count_copies(df: DataFrame, *more: str) -> DataFrame:
    """C1 with what the report needs: ``_mult`` copies of each row and its ``_cells`` null cells.

    ``more`` names columns that are in the key and not of the row."""
    cells = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("int") for c in df.columns if c not in more])
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_mult")).withColumn("_cells", cells)


def staged_shares(shares: Sequence[DataFrame], steps, near: str, key: str = "order_id", mode: str = "checkpoint") -> DataFrame:
    """The rows of ``shares`` without their copies, behind the row-level ``steps``, written share by share.

    Rows with the same ``near`` are in one share, and ``near`` is ``key`` where
    that is not null. So copies have the same ``near``, and where a join has
    dealt the rows by it they are found in its tasks: whole rows, several times
    as wide as the tables', are not shuffled. Only rows without a ``key`` may be
    copies under another ``near``: they keep their values as they came and are
    grouped once more.
    """
    columns = [c for c in shares[0].columns if c != near]
    lone = F.when(F.col(key).isNull(), F.struct(*columns))
    staged = materialize_each([steps(count_copies(nan_to_null(s), near).withColumn("_lone", lone).drop(near)) for s in shares], mode)
    apart = staged.where(F.col(key).isNull())
    if apart.isEmpty():
        return staged.drop("_lone")
    once = apart.select("_lone.*", "_mult", "_cells").groupBy(*columns).agg(F.sum("_mult").alias("_mult"), F.max("_cells").alias("_cells"))
    return staged.where(F.col(key).isNotNull()).drop("_lone").unionByName(materialize(steps(once), mode))


# ------------------------------------------------------------------ C2, C3
def parse_dates(df: DataFrame, col: str = "order_date", fmt: str = "yyyy-MM-dd") -> DataFrame:
    """Text -> date, unparseable -> null (flagged in ``_bad_date``)."""
    c = F.col(col)
    if isinstance(df.schema[col].dataType, StringType):
        parsed = F.to_date(F.try_to_timestamp(c, F.lit(fmt)))
    else:
        parsed = F.to_date(c)
    return df.withColumns({col: parsed, "_bad_date": parsed.isNull()})


def median_date(df: DataFrame, col: str = "order_date") -> DataFrame:
    """The upper median ``sorted[n // 2]`` of the valid dates, as a one-row frame."""
    days = df.select(F.unix_date(F.col(col)).alias("d"))
    p = percentiles(days, ["d"], [0.5], interpolation="higher")
    return p.select(F.date_from_unix_date(F.col("value").cast("int")).alias("median_date"))


def fill_median_date(df: DataFrame, col: str = "order_date") -> DataFrame:
    """Fill missing dates with the upper median date (one scalar)."""
    med = median_date(df, col).first()  # none if no date is valid: all stay null
    return df.withColumn(col, F.coalesce(F.col(col), F.lit(med[0] if med else None).cast("date")))


def fix_dates(df: DataFrame, col: str = "order_date", fmt: str = "yyyy-MM-dd") -> DataFrame:
    return fill_median_date(parse_dates(df, col, fmt), col)


# ------------------------------------------------------------------ C4-C7
def standardise_gender(df: DataFrame, col: str = "gender") -> DataFrame:
    """C4: strip + fixed spelling map; unknown spellings are kept and flagged."""
    df = df.withColumn(col, py_strip(F.col(col)))  # once, not in each of the columns that follow from it
    s = F.col(col)
    mapped = lookup(s, GENDER_MAP)
    known = mapped.isNotNull()
    unknown = s.isNotNull() & ~known & ~s.isin(*GENDER_CANONICAL)
    return df.withColumns({col: F.coalesce(mapped, s), "_g_fixed": known, "_g_unknown": unknown})


def strip_strings(df: DataFrame) -> DataFrame:
    """Strip every string column."""
    cols = string_columns(df)
    return df.withColumns({c: py_strip(F.col(c)) for c in cols}) if cols else df


def standardise_categoricals(df: DataFrame) -> DataFrame:
    """C4 + C6 + C7 in the reference order."""
    out = standardise_gender(df) if "gender" in df.columns else df
    out = strip_strings(out)
    if "loyalty_tier" in out.columns:
        out = out.withColumn("loyalty_tier", title_case(F.col("loyalty_tier")))
    return out


def value_audit(df: DataFrame, col: str = "gender") -> DataFrame:
    """C5 as long rows: each distinct value before and after standardising,
    with its row count (a hash aggregate, no array in one task)."""
    before = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).count() \
               .withColumn("stage", F.lit("before"))
    after = standardise_gender(df, col).where(F.col(col).isNotNull()) \
        .groupBy(F.col(col).alias("value")).count().withColumn("stage", F.lit("after"))
    return before.unionByName(after).select("stage", "value", F.col("count").alias("rows"))


# ------------------------------------------------------------------ C8, C9
def fix_invalid_values(df: DataFrame, p: CleaningParams = CleaningParams()) -> DataFrame:
    """Negative quantity -> abs; C9: rating outside [min, max] -> null."""
    q, r = F.col("quantity"), F.col("customer_rating")
    bad = r.isNotNull() & ~r.between(p.rating_min, p.rating_max)
    return df.withColumns({
        "_neg_qty": F.coalesce(q < 0, F.lit(False)),
        "quantity": F.abs(q),
        "_bad_rating": bad,
        "customer_rating": F.when(bad, F.lit(None).cast("double")).otherwise(r),
    })


# ------------------------------------------------------------------ C10-C12
def fill_values(df: DataFrame, p: CleaningParams = CleaningParams()) -> dict:
    """The imputation values: exact medians of the numeric columns and the
    smallest mode of the categorical ones ({column: value})."""
    num = [c for c in p.median_cols if c in df.columns]
    cat = [c for c in p.mode_cols if c in df.columns]
    vals: dict = {}
    if num:
        vals.update({r["column"]: r["value"] for r in percentiles(df, num, [0.5]).collect()})
    vals.update(modes(df, cat))
    return vals


def modes(df: DataFrame, cols) -> dict:
    """C11: the commonest value of each column, of equally common ones the smallest ({column: value}).

    Values are counted by a hash aggregate over all columns at once (copies fall
    together in each task before the shuffle) and the counts are compared by a
    second one: no map of a column's distinct values is ever in one task.
    """
    cols = list(cols)
    if not cols:
        return {}
    kinds = {df.schema[c].dataType for c in cols}
    if len(kinds) > 1:  # columns of one type share a scan
        return {c: v for k in kinds for c, v in modes(df, [c for c in cols if df.schema[c].dataType == k]).items()}
    values = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).alias("v")) for i, c in enumerate(cols)])).alias("x")
    counts = df.select(values).where("x.v IS NOT NULL").groupBy("x.i", "x.v").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("i").agg(F.min_by("v", F.struct(-F.col("n"), "v")).alias("v"))
    found = {cols[r.i]: r.v for r in best.collect()}  # one row for each column
    return {c: found.get(c) for c in cols}


def impute_missing(df: DataFrame, p: CleaningParams = CleaningParams(), values: dict | None = None) -> DataFrame:
    """Fill numeric nulls with the exact median, categorical with the mode."""
    if values is None:  # the fills scan the frame three times before it is filled: it is computed once
        df = materialize(df, p.materialize)
    vals = values if values is not None else fill_values(df, p)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType))
                           for c, v in vals.items() if c in df.columns and v is not None})


# ------------------------------------------------------------------ C13, C14
def iqr_bounds(df: DataFrame, cols, factor: float = 3.0) -> DataFrame:
    """Per column: q1, q3, lo = q1 - k*iqr, hi = q3 + k*iqr (exact quartiles)."""
    q = percentiles(df, list(cols), [0.25, 0.75])
    w = q.groupBy("column").agg(F.max(F.when(F.col("prob") == 0.25, F.col("value"))).alias("q1"),
                                F.max(F.when(F.col("prob") == 0.75, F.col("value"))).alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    return w.select("column", "q1", "q3", (F.col("q1") - factor * iqr).alias("lo"),
                    (F.col("q3") + factor * iqr).alias("hi"))


def cap_outliers(df: DataFrame, p: CleaningParams = CleaningParams(), bounds: dict | None = None) -> DataFrame:
    """Clip each outlier column to its IQR fence; flags ``_cap_<col>``.

    ``bounds`` maps column -> (lo, hi); computed when not given."""
    cols = [c for c in p.outlier_cols if c in df.columns]
    if not cols:
        return df
    if bounds is None:
        bounds = {r["column"]: (r["lo"], r["hi"]) for r in iqr_bounds(df, cols, p.iqr_factor).collect()}
    out = {}
    for c in cols:
        lo, hi = (F.lit(v).cast("double") for v in bounds.get(c, (None, None)))
        x = F.col(c)
        if c not in bounds:  # no value at all: nothing to cap
            out[f"_cap_{c}"] = F.lit(False)
            continue
        out[f"_cap_{c}"] = F.coalesce((x < lo) | (x > hi), F.lit(False))
        out[c] = clip(x, lo, hi)
    return df.withColumns(out)


def zscore_count(df: DataFrame, col: str = "age", limit: float = 3.0) -> DataFrame:
    """C14: number of values with |z| > limit (population std), informational."""
    m = df.agg(F.avg(col).alias("m"), F.stddev_pop(col).alias("s")).first()
    mean, sd = (F.lit(m[c]).cast("double") for c in ("m", "s"))
    z = F.abs(F.try_divide(F.col(col) - mean, sd))  # no spread: no outlier
    return df.agg(F.count_if(F.col(col).isNotNull() & F.coalesce(z > limit, F.lit(False))).alias("n_outliers"))


# ------------------------------------------------------------------ C15-C17
def recompute_derived(df: DataFrame, half_even: bool = True) -> DataFrame:
    """total_sales = round(price * qty * (1 - discount), 2), date parts."""
    rnd = round_half_even if half_even else round_half_up
    d = F.col("order_date")
    return df.withColumns({
        "total_sales": rnd(F.col("unit_price") * F.col("quantity") * (1 - F.col("discount")), 2),
        "year": F.year(d), "month": F.month(d),
        "month_name": F.date_format(d, "MMM"), "quarter": F.quarter(d),
    })


def type_cast(df: DataFrame) -> DataFrame:
    """C17: age and quantity truncate to int, shipping days round half-even."""
    out = {"age": F.col("age").cast("int"), "quantity": F.col("quantity").cast("int")}
    if "shipping_days" in df.columns:
        out["shipping_days"] = F.rint("shipping_days").cast("int")
    return df.withColumns(out)


# ------------------------------------------------------------------ C21
class CleanResult:
    """The clean frame, with its report built on first access."""

    def __init__(self, clean: DataFrame, build):
        self.clean = clean          # 24 columns, no flags
        self._build = build
        self._parts = None

    def _get(self, i: int) -> DataFrame:
        if self._parts is None:
            self._parts = self._build()
        return self._parts[i]

    @property
    def report(self) -> DataFrame:      # one row of counters and the score
        return self._get(0)

    @property
    def issues(self) -> DataFrame:      # long rows (metric, column, n, value, text)
        return self._get(1)

    @property
    def validation(self) -> DataFrame:  # (check, violations, passed)
        return self._get(2)


def clean_sales(raw: DataFrame, p: CleaningParams = CleaningParams(), shares: Sequence[DataFrame] = (), near: str = "") -> CleanResult:
    """C1-C19 in the reference order, returning the clean frame and its report.

    The deduplicated frame is written, the clean frame is not: it is a
    projection with the fills and bounds as literals. The report's counters are
    two aggregates over the written frame, made when the report is asked for.
    ``shares`` are the rows of ``raw`` dealt by their column ``near``, as
    ``staged_shares`` has them: they are then written one after the other.
    """
    from tessera.operators import quality

    def steps(dedup: DataFrame) -> DataFrame:
        return fix_invalid_values(standardise_categoricals(parse_dates(dedup, "order_date", p.date_format)), p)

    # every later global aggregate scans this frame: pin it once
    staged = staged_shares(shares, steps, near, mode=p.materialize) if shares \
        else materialize(steps(count_copies(nan_to_null(raw))), p.materialize)
    # one distributed selection serves the upper-median date and the numeric
    # medians (both read the staged table)
    num = [c for c in p.median_cols if c in staged.columns]
    sel = staged.select(F.unix_date("order_date").alias("_order_day"), *num)
    meds = {r["column"]: r for r in percentiles(sel, ["_order_day", *num], [0.5]).collect()}
    md = meds["_order_day"]["higher"] if "_order_day" in meds else None
    dated = staged.withColumn("order_date", F.coalesce(
        F.col("order_date"), F.date_from_unix_date(F.lit(md).cast("int")) if md is not None else F.lit(None).cast("date")))
    cat = [c for c in p.mode_cols if c in dated.columns]
    fills = {c: meds[c]["value"] for c in num if c in meds}
    fills.update(modes(dated, cat))
    imputed = impute_missing(dated, p, fills)
    cap_cols = [c for c in p.outlier_cols if c in imputed.columns]
    bounds = {r["column"]: r.asDict() for r in iqr_bounds(imputed, cap_cols, p.iqr_factor).collect()} \
        if cap_cols else {}
    capped = cap_outliers(imputed, p, {c: (b["lo"], b["hi"]) for c, b in bounds.items()})
    final = type_cast(recompute_derived(capped, p.half_even))
    hidden = [*FLAGS, "_mult", "_cells", *[c for c in final.columns if c.startswith("_cap_")]]
    # a projection of the pinned frame: not written, so what reads it computes only the columns it needs
    clean = final.drop(*hidden)

    def report():
        before = _values(staged, quality.staged_counters(staged, p))
        after = _values(final, quality.final_counters(final, clean.columns, p))
        return quality.build_report(raw.columns, staged, clean, before, after, bounds, fills, p)
    return CleanResult(clean, report)


def _values(df: DataFrame, aggregates: dict) -> dict:
    return df.agg(*[c.alias(n) for n, c in aggregates.items()]).first().asDict()


def counted(df: DataFrame, counters: dict, mode: str = "checkpoint"):
    """``df`` pinned, and a function that gives the values of the aggregates ``counters``.

    A written frame is observed by the job that writes it: the counters are
    those of the tasks whose rows were committed, and no scan follows. Other
    modes write nothing, so their counters are an aggregate of their own.
    """
    exprs = [c.alias(n) for n, c in counters.items()]
    if mode != "checkpoint":
        out = materialize(df, mode)
        return out, lambda: out.agg(*exprs).first().asDict()
    seen = Observation()
    return materialize(df.observe(seen, *exprs), mode), lambda: seen.get

"""Data-quality measures: raw profile (S2), validation (C18), score (C19),
issue listing (C20).

The counters are aggregates over the written staged frame and the final frame
projected from it; the report row is made of their values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.numeric import round_half_even
from tessera.params import CleaningParams

# The six checks of the validation step, in reference order.
CHECKS = (
    "No nulls in key columns",
    "All ratings in [1.0, 5.0]",
    "All quantities >= 0",
    "All unit prices > 0",
    "Discount in [0, 1]",
    "No empty gender values",
)
KEY_COLUMNS = ("age", "quantity", "unit_price", "total_sales", "order_date")


def _nulls(df: DataFrame, cols=None) -> Column:
    cols = list(cols) if cols is not None else df.columns
    terms = [F.sum(F.col(c).isNull().cast("long")) for c in cols]
    return F.coalesce(reduce(lambda a, b: a + b, terms), F.lit(0)).cast("long")


def raw_profile(raw: DataFrame) -> DataFrame:
    """Rows, columns, null cells, exact duplicate rows.

    One pass: equal rows are counted by a hash aggregate (copies collapse in
    the map side before the shuffle), and everything else follows from the counts.
    """
    from tessera.operators.clean import count_copies

    rows = F.coalesce(F.sum("_mult"), F.lit(0))
    return count_copies(raw).agg(
        rows.alias("raw_rows"), F.lit(len(raw.columns)).alias("raw_cols"),
        F.coalesce(F.sum(F.col("_mult") * F.col("_cells")), F.lit(0)).alias("raw_nulls"),
        (rows - F.count(F.lit(1))).alias("raw_duplicates"))


def violation_counts(df: DataFrame, p: CleaningParams = CleaningParams()) -> list[Column]:
    def bad(cond: Column) -> Column:
        return F.count_if(~F.coalesce(cond, F.lit(False)))
    return [
        _nulls(df, [c for c in KEY_COLUMNS if c in df.columns]),
        bad(F.col("customer_rating").between(p.rating_min, p.rating_max)),
        bad(F.col("quantity") >= 0),
        bad(F.col("unit_price") > 0),
        bad(F.col("discount").between(0.0, 1.0)),
        F.count_if(F.col("gender").isNull()),
    ]


def validation(df: DataFrame, p: CleaningParams = CleaningParams()) -> DataFrame:
    """One aggregate, unpivoted to (check, violations, passed)."""
    names = [f"c{i}" for i in range(len(CHECKS))]
    one = df.agg(*[v.cast("long").alias(n) for v, n in zip(violation_counts(df, p), names)])
    stacked = one.unpivot([], names, "cid", "violations")
    label = F.element_at(F.array(*[F.lit(c) for c in CHECKS]),
                         F.substring("cid", 2, 3).cast("int") + 1)
    return stacked.select(label.alias("check"), "violations",
                          (F.col("violations") == 0).alias("passed"))


def dq_score(raw_rows: Column, final_rows: Column, final_cols: Column, final_nulls: Column,
             invalid_dates: Column, neg_qty: Column, bad_ratings: Column,
             gender_fixed: Column, failed: Column) -> Column:
    """100 - row-loss, null-rate and issue deductions, clamped, 1 dp."""
    loss = F.when(raw_rows > 0, F.least(F.lit(20.0), (raw_rows - final_rows) / raw_rows * 200)) \
            .otherwise(F.lit(0.0))
    cells = final_rows * F.greatest(final_cols, F.lit(1))
    nullp = F.when(cells > 0, F.least(F.lit(30.0), final_nulls / cells * 1000)).otherwise(F.lit(0.0))
    issues = F.least(F.lit(25.0), invalid_dates * 0.5 + neg_qty * 0.3 + bad_ratings * 0.3
                     + gender_fixed * 0.05 + failed * 5.0)
    score = F.lit(100.0) - loss - nullp - issues
    return round_half_even(F.greatest(F.lit(0.0), F.least(F.lit(100.0), score)), 1)


def _present(df: DataFrame, cols) -> list[str]:
    return [c for c in cols if c in df.columns]


def staged_counters(staged: DataFrame, p: CleaningParams = CleaningParams()) -> dict[str, Column]:
    """What the report counts of the raw and staged rows (``_mult`` copies of each stand for the raw rows)."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    flags = {"invalid_dates": "_bad_date", "gender_variants_fixed": "_g_fixed", "unknown_genders": "_g_unknown",
             "negative_qty_fixed": "_neg_qty", "bad_ratings_nulled": "_bad_rating"}
    return {"raw_rows": total(F.col("_mult")), "raw_nulls": total(F.col("_mult") * F.col("_cells")), "staged_rows": F.count(F.lit(1)),
            **{n: F.count_if(F.col(c)) if c in staged.columns else F.lit(0).cast("long") for n, c in flags.items()},
            **{f"missing_{c}": F.count_if(F.col(c).isNull()) for c in _present(staged, [*p.median_cols, *p.mode_cols])}}


def final_counters(final: DataFrame, columns: list[str], p: CleaningParams = CleaningParams()) -> dict[str, Column]:
    """What the report counts of the final rows: nulls of ``columns``, capped values, violations of each check."""
    caps = [c for c in p.outlier_cols if f"_cap_{c}" in final.columns]
    return {"rows": F.count(F.lit(1)), "nulls": _nulls(final, columns), **{f"capped_{c}": F.count_if(F.col(f"_cap_{c}")) for c in caps},
            **{f"c{i}": v.cast("long") for i, v in enumerate(violation_counts(final, p))}}


def build_report(raw_columns: list[str], staged: DataFrame, clean: DataFrame, before: dict, after: dict, bounds: dict,
                 fills: dict, p: CleaningParams = CleaningParams()):
    """Assemble (report, issues, validation) of a ``clean_sales`` run from its counters."""
    from tessera.operators.clean import string_columns

    spark = clean.sparkSession
    num, cat = _present(staged, p.median_cols), _present(staged, p.mode_cols)
    caps = [c for c in p.outlier_cols if f"capped_{c}" in after]
    checks = [after[f"c{i}"] for i in range(len(CHECKS))]
    val = spark.createDataFrame([(label, n, n == 0) for label, n in zip(CHECKS, checks)],
                                "check string, violations long, passed boolean")
    # string columns when the whitespace step runs (after date parsing)
    ws_cols = len([c for c in string_columns(staged) if c != "order_date"])
    long = lambda v: F.lit(v).cast("long")
    copies = before["raw_rows"] - before["staged_rows"]
    row = {"raw_rows": long(before["raw_rows"]), "raw_cols": F.lit(len(raw_columns)), "raw_nulls": long(before["raw_nulls"]),
           "raw_duplicates": long(copies), "duplicates_removed": long(copies),
           **{n: long(before[n]) for n in ("invalid_dates", "gender_variants_fixed", "unknown_genders", "negative_qty_fixed",
                                           "bad_ratings_nulled")},
           "whitespace_cols": F.lit(ws_cols), **{f"missing_{c}": long(before[f"missing_{c}"]) for c in num + cat},
           **{f"capped_{c}": long(after[f"capped_{c}"]) for c in caps},
           "final_rows": long(after["rows"]), "final_cols": F.lit(len(clean.columns)), "final_nulls": long(after["nulls"]),
           "failed_checks": long(sum(1 for n in checks if n))}
    report = spark.range(1).select(*[c.alias(n) for n, c in row.items()])
    report = report.withColumn("dq_score", dq_score(
        F.col("raw_rows"), F.col("final_rows"), F.col("final_cols"), F.col("final_nulls"),
        F.col("invalid_dates"), F.col("negative_qty_fixed"), F.col("bad_ratings_nulled"),
        F.col("gender_variants_fixed"), F.col("failed_checks")))
    issues = issue_rows(report, bounds, fills, num, cat, caps)
    return report, issues, val


def issue_rows(report: DataFrame, bounds: dict, fills: dict, num, cat, caps) -> DataFrame:
    """C20: long listing (metric, column, n, value, text) of what was fixed."""
    counters = ["duplicates_removed", "invalid_dates", "gender_variants_fixed", "unknown_genders",
                "negative_qty_fixed", "bad_ratings_nulled", "whitespace_cols"]
    base = report.select(*[F.col(c).cast("long").alias(c) for c in counters]).unpivot(
        [], counters, "metric", "n").select(
        "metric", F.lit(None).cast("string").alias("column"), "n",
        F.lit(None).cast("double").alias("value"), F.lit(None).cast("string").alias("text"))
    parts = [base]
    for c in caps:
        parts.append(report.select(F.lit("outliers_capped").alias("metric"), F.lit(c).alias("column"),
                                   F.col(f"capped_{c}").cast("long").alias("n"),
                                   F.lit(bounds[c]["hi"] if c in bounds else None).cast("double").alias("value"),
                                   F.lit(None).cast("string").alias("text")))
    for c in num + cat:
        v = fills.get(c)
        parts.append(report.where(F.col(f"missing_{c}") > 0).select(
            F.lit("imputed").alias("metric"), F.lit(c).alias("column"),
            F.col(f"missing_{c}").cast("long").alias("n"),
            (F.lit(v) if c in num else F.lit(None)).cast("double").alias("value"),
            (F.lit(None) if c in num else F.lit(v)).cast("string").alias("text")))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def geo_consistency(clean: DataFrame, city: str = "city", region: str = "region") -> DataFrame:
    """Optional check: cities that appear under more than one region after
    imputation (the imputed mode region need not match the city's region)."""
    per = (clean.where(F.col(city).isNotNull() & F.col(region).isNotNull())
                .groupBy(city, region).agg(F.count(F.lit(1)).alias("rows")))
    multi = per.groupBy(city).agg(F.count(F.lit(1)).alias("regions"), F.sum("rows").alias("rows"))
    return multi.where(F.col("regions") > 1).select(city, F.col("regions").cast("long").alias("regions"),
                                                    F.col("rows").cast("long").alias("rows"))

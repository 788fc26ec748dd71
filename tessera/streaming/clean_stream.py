"""The stateless cleaning steps on a stream.

Parsing, standardising, range checks and the derived measures are row-local,
so they apply unchanged to a streaming DataFrame. Steps that need a global
statistic (median date, medians, modes, IQR bounds) take it from a batch
reference table computed once (``fill_values`` / ``iqr_bounds`` on history)
and joined as a small static side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import clean as C
from tessera.params import CleaningParams


def clean_rows(stream: DataFrame, fills: dict | None = None, bounds: dict | None = None,
               p: CleaningParams = CleaningParams()) -> DataFrame:
    """Row-level cleaning of a (streaming or batch) raw sales frame.

    ``fills`` maps column -> fill value (from a batch ``fill_values``);
    ``bounds`` maps column -> (lo, hi) (from a batch ``iqr_bounds``).
    """
    out = C.fix_invalid_values(C.standardise_categoricals(C.parse_dates(stream, "order_date", p.date_format)), p)
    if fills:
        out = out.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(out.schema[c].dataType))
                               for c, v in fills.items() if c in out.columns})
    if bounds:
        out = out.withColumns({c: F.least(F.greatest(F.col(c), F.lit(lo)), F.lit(hi))
                               for c, (lo, hi) in bounds.items() if c in out.columns})
    return C.drop_flags(C.type_cast(C.recompute_derived(out, p.half_even)))

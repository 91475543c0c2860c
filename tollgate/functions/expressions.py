"""Column-expression helpers (all JVM-side, no Python UDFs).

Each helper returns a ``Column`` so it composes into whole-stage codegen.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor_days(later, earlier) -> Column:
    """Whole days from ``earlier`` to ``later``, rounded toward minus infinity.

    -22 h gives -1 and +2 h across midnight gives 0 (neither ``datediff`` nor
    ``timestampdiff(DAY)`` behaves like that).  NULL when either side is NULL.
    """
    diff = F.unix_micros(_c(later).cast("timestamp")) - F.unix_micros(_c(earlier).cast("timestamp"))
    return F.floor(diff / F.lit(float(MICROS_PER_DAY))).cast("long")


def add_days(ts, days: int) -> Column:
    """Timestamp + exact ``days`` x 24 h (fixed-length days, not calendar months)."""
    return _c(ts).cast("timestamp") + F.make_dt_interval(F.lit(int(days)))


def python_title(c) -> Column:
    """``str.strip().title()``: upper-case every letter that follows a non-letter.

    ``initcap`` only capitalises after white space ("Jammu-kashmir"); splitting the
    lower-cased text into letter and non-letter runs and capitalising each run gives
    "Jammu-Kashmir" and "O'Neil" like Python.
    """
    runs = F.regexp_extract_all(F.lower(F.trim(_c(c))), F.lit(r"(\p{L}+|\P{L}+)"), 1)
    return F.when(_c(c).isNull(), F.lit(None).cast("string")).otherwise(
        F.array_join(F.transform(runs, lambda w: F.initcap(w)), ""))


def parse_dmy(c) -> Column:
    """Tolerant day-month-year parse: 1- or 2-digit day/month, NULL on anything else."""
    return F.try_to_timestamp(F.trim(_c(c)), F.lit("d-M-yyyy"))


def threshold_category(c, threshold, above: str, otherwise: str) -> Column:
    """``above`` when ``c > threshold``; NULL and smaller values fall to ``otherwise``."""
    return F.when(_c(c) > F.lit(threshold), F.lit(above)).otherwise(F.lit(otherwise))


def safe_div(num, den) -> Column:
    """num / den, NULL when den is 0 or NULL (never raises under ANSI mode)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def md5_uniform(seed, key) -> Column:
    """Deterministic uniform draw in [0, 1): first 8 hex digits of md5(seed:key) / 2^32."""
    h = F.md5(F.concat(F.lit(str(seed)), F.lit(":"), _c(key).cast("string")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def md5_order_key(seed, key) -> Column:
    """Hex md5 text used as a deterministic shuffle order (same in every engine)."""
    return F.md5(F.concat(F.lit(str(seed)), F.lit(":"), _c(key).cast("string")))


def chi2_sf_1dof(stat) -> Column:
    """Upper tail of chi-square with 1 degree of freedom, erfc(sqrt(x/2)), to about 1e-12 of its value.

    Neither Spark nor DuckDB ships ``erfc``.  Below x = 8 the Maclaurin series of erf, whose terms are all
    positive, is summed from its last term; from there on the continued fraction of erfc.  NULL gives NULL.
    """
    x = _c(stat).cast("double")
    z = F.sqrt(x / F.lit(2.0))
    terms = F.aggregate(F.sequence(F.lit(60), F.lit(1), F.lit(-1)), F.lit(1.0),
                        lambda acc, k: F.lit(1.0) + acc * x / (F.lit(2.0) * k + F.lit(1.0)))
    series = F.lit(1.0) - z * F.exp(-x / F.lit(2.0)) * terms * F.lit(2.0 / math.sqrt(math.pi))
    far = F.greatest(z, F.lit(2.0))
    fraction = F.aggregate(F.sequence(F.lit(120), F.lit(1), F.lit(-1)), far,
                           lambda acc, k: far + k / (F.lit(2.0) * acc))
    return F.when(x < 8.0, series).otherwise(F.exp(-x / F.lit(2.0)) / (fraction * F.lit(math.sqrt(math.pi))))


def yates_chi2(a, b, c, d) -> Column:
    """Yates-corrected chi-square of the 2x2 table [[a, b], [c, d]] (scipy's default)."""
    a, b, c, d = (_c(x).cast("double") for x in (a, b, c, d))
    n = a + b + c + d
    num = n * F.pow(F.greatest(F.abs(a * d - b * c) - n / F.lit(2.0), F.lit(0.0)), 2)
    den = (a + b) * (c + d) * (a + c) * (b + d)
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def weekday_monday0(c) -> Column:
    """Day of week with Monday = 0 (pandas ``dt.dayofweek``)."""
    return F.weekday(_c(c))


def inf_to_null(c) -> Column:
    """+/-infinity (and NaN) become NULL so row means/maxima skip them."""
    x = _c(c).cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(None).cast("double")).otherwise(x)

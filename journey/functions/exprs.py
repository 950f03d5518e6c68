"""Scalar column expressions (all JVM-side, no Python UDFs).

Each function returns a ``Column``; operators compose them inside one
projection so they stay in whole-stage codegen.
"""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from journey.functions.sqltext import ident, lit


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- arithmetic -------------------------------------------------------------

def safe_div(num, den) -> Column:
    """``num / den`` as DOUBLE; NULL when ``den`` is 0 or NULL (SQL ``NULLIF`` form)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def safe_div_or_zero(num, den) -> Column:
    """``num / den`` or 0 when the denominator is 0 (the ``x if d > 0 else 0`` form)."""
    return F.coalesce(safe_div(num, den), F.lit(0.0))


#: decimal places an amount keeps; amounts of 10**(18 - scale) and more do not fit and fail the cast under ANSI
MONEY_SCALE = 6


def money(col, scale: int = MONEY_SCALE) -> Column:
    """An amount as DECIMAL(18, scale); further decimals are rounded half up, once, per amount."""
    return _c(col).cast(f"decimal(18,{scale})")


def money_sum(col, scale: int = MONEY_SCALE) -> Column:
    """Exact sum of a money column: DECIMAL addition does not depend on the
    order in which partitions are combined, so totals (and figures rounded
    from them) are the same on every run and engine."""
    return F.sum(money(col, scale))


def money_total(col, scale: int = MONEY_SCALE) -> Column:
    """``money_sum`` as DOUBLE, 0 when there is no amount."""
    return F.coalesce(money_sum(col, scale).cast("double"), F.lit(0.0))


def pct(num, den, scale: int | None = 2) -> Column:
    """``ROUND(num * 100.0 / NULLIF(den, 0), scale)`` in DOUBLE."""
    v = F.try_divide(_c(num).cast("double") * F.lit(100.0), _c(den).cast("double"))
    return F.round(v, scale) if scale is not None else v


# --- fixed values: duration buckets of the original time analysis ----------
DURATION_BUCKETS = ("< 30s", "30s-2m", "2m-5m", "5m-15m", "15m+")
DURATION_EDGES = (30, 120, 300, 900)
# --- fixed values: weekday names, Monday first ------------------------------
WEEKDAY_NAMES = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")
# --- fixed values: city tiers of the original segment analysis --------------
TIER1_CITIES = ("Mumbai", "Delhi", "Bangalore", "Hyderabad", "Chennai")
TIER2_CITIES = ("Pune", "Kolkata", "Ahmedabad", "Jaipur", "Lucknow")
# --- fixed values: priority quadrants ---------------------------------------
QUADRANTS = ("Quick Wins", "Major Projects", "Fill-ins", "Don't Bother")
# ---------------------------------------------------------------------------


def city_tier(city, tier1=TIER1_CITIES, tier2=TIER2_CITIES) -> Column:
    c = _c(city)
    return (
        F.when(c.isin(*tier1), F.lit("Tier 1"))
        .when(c.isin(*tier2), F.lit("Tier 2"))
        .otherwise(F.lit("Tier 3"))
    )


def loyalty_tier(n_orders) -> Column:
    n = _c(n_orders)
    return (
        F.when(n == 0, F.lit("new"))
        .when(n == 1, F.lit("bronze"))
        .when(n <= 3, F.lit("silver"))
        .otherwise(F.lit("gold"))
    )


def priority_quadrant(ease, impact, ease_min=6, impact_min=400000) -> Column:
    """Quadrant of an ease score and an impact; NULL where either is unknown."""
    easy, big = _c(ease) >= ease_min, _c(impact) >= impact_min
    return F.when(easy, F.when(big, F.lit(QUADRANTS[0])).when(~big, F.lit(QUADRANTS[2]))).when(
        ~easy, F.when(big, F.lit(QUADRANTS[1])).when(~big, F.lit(QUADRANTS[3])))


def weekday_name(day_of_week) -> Column:
    """Monday = 0 → 'Mon'."""
    return F.element_at(F.array(*[F.lit(x) for x in WEEKDAY_NAMES]), _c(day_of_week) + 1)


def month_key(d) -> Column:
    return F.date_format(_c(d), "yyyy-MM")


def seconds_between(start, end) -> Column:
    """Exact seconds (DOUBLE, microsecond precision) from ``start`` to ``end``.

    ``timestamp_diff`` on TIMESTAMP_NTZ involves no session time zone.
    """
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end)).cast("double") / F.lit(1e6)


def whole_seconds_between(start, end) -> Column:
    """Whole seconds (floor) from ``start`` to ``end``."""
    us = F.timestamp_diff("MICROSECOND", _c(start), _c(end))
    return F.floor(us / F.lit(1000000)).cast("int")


def campaign_tag(source, when_ts, paid_sources) -> Column:
    """``campaign_<source>_<Mon>`` for paid sources, else NULL."""
    s = _c(source)
    return F.when(s.isin(*paid_sources), F.concat_ws("_", F.lit("campaign"), s, F.date_format(_c(when_ts), "MMM")))


def text_timestamp(col, fmt: str | None = None) -> Column:
    """Text to TIMESTAMP_NTZ; text that is no timestamp gives NULL, a timestamp stays as it is."""
    t = F.try_to_timestamp(_c(col), F.lit(fmt)) if fmt else F.try_to_timestamp(_c(col))
    return t.cast("timestamp_ntz")


# --- fixed values: hours with higher conversion in the original data ---------
PEAK_HOURS = (20, 21, 22)
# -----------------------------------------------------------------------------


def is_peak_hour(hour, hours=PEAK_HOURS) -> Column:
    """Whether ``hour`` is one of the peak hours; NULL for an unknown hour."""
    return _c(hour).isin(*hours)


def page_url(stage) -> Column:
    return F.concat(F.lit("/"), F.translate(_c(stage), "_", "-"))


def title_case(name) -> Column:
    return F.initcap(F.translate(_c(name), "_", " "))


def inr_lakh(x, digits: int = 1) -> Column:
    """Display form ``₹12.3L`` (the number itself stays in its own column)."""
    return F.format_string(f"₹%.{digits}fL", _c(x) / F.lit(100000.0))


def percent_text(x, digits: int = 2) -> Column:
    """Display form ``12.34%`` of a number that is already in percent."""
    return F.format_string(f"%.{digits}f%%", _c(x).cast("double"))


def thousands(x, prefix: str = "") -> Column:
    """Display form ``12,345`` without decimals, e.g. with prefix ``₹``."""
    return F.concat(F.lit(prefix), F.format_number(_c(x), 0))


# --- semi-structured event properties -------------------------------------

PROPS_SCHEMA = T.StructType(
    [
        T.StructField("product_id", T.LongType()),
        T.StructField("category", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("method", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("reason", T.StringType()),
    ]
)


def parse_props(col, schema: T.StructType = PROPS_SCHEMA) -> Column:
    """JSON text → struct. Malformed text gives NULL fields, never an error (PERMISSIVE is the default)."""
    return F.from_json(_c(col), schema)


def props_of(df, col: str, schema: T.StructType = PROPS_SCHEMA) -> Column:
    """The event properties of ``df`` as a struct, whichever way ``df`` holds them.

    A typed struct ``df[col]`` is used as it is: no parsing, and Parquet reads
    only the nested fields a query touches.  JSON text is parsed
    (schema-on-read); of a VARIANT the wanted keys are taken.  Without a column ``col`` the properties are plain
    columns of ``df``; a property that is no column is NULL.  The choice is
    made from the DataFrame's schema.
    """
    dtype = dict(df.dtypes).get(col)
    if dtype is None:
        plain = [F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType) for f in schema.fields]
        if not any(f.name in df.columns for f in schema.fields):
            raise ValueError(f"neither {col} nor any of {schema.names} in {df.columns}")
        return F.struct(*[c.alias(f.name) for c, f in zip(plain, schema.fields)])
    if dtype == "variant":
        return variant_props(col, schema)
    return F.col(col) if dtype.startswith("struct") else parse_props(col, schema)


def parse_variant(col) -> Column:
    """JSON text → VARIANT, parsed once when the events are stored; malformed text gives NULL."""
    return F.try_parse_json(_c(col))


def variant_props(col: str, schema: T.StructType = PROPS_SCHEMA) -> Column:
    """The keys of ``schema`` out of the VARIANT column ``col``, as a struct; other keys are left alone.

    As with JSON text, a number is only taken from a JSON number (an integer
    from one without a fraction) and anything else in its place is NULL; a text key
    takes numbers and booleans in their JSON form.  What is no object has no keys.
    """
    fields = []
    for f in schema.fields:
        path, kind = lit("$." + f.name), f.dataType.simpleString()
        value = f"try_variant_get({ident(col)}, {path}, {lit(kind)})"
        if kind != "string":
            of = f"schema_of_variant(try_variant_get({ident(col)}, {path}, 'variant'))"
            number = "'BIGINT'" if kind in ("bigint", "int") else "'^(BIGINT|DECIMAL|DOUBLE|FLOAT)'"
            value = f"CASE WHEN {of} RLIKE {number} THEN {value} END"
        fields.append(f"{value} AS {ident(f.name)}")
    return F.expr(f"struct({', '.join(fields)})")


def prop_of(df, col: str, key: str, default=None) -> Column:
    """One property of ``df`` (see ``props_of``) with a default for missing values."""
    v = props_of(df, col).getField(key)
    return v if default is None else F.coalesce(v, F.lit(default))


def props_json(**fields: Column) -> Column:
    """Serialise properties; NULL fields are omitted, all-NULL gives ``{}``."""
    return F.to_json(F.struct(*[c.alias(k) for k, c in fields.items()]))


# --- statistics -------------------------------------------------------------

# fixed values: coefficients of a Chebyshev fit of log(erfc(x) exp(x^2) / t), t = 1 / (1 + x / 2);
# its fractional error is below 1.2e-7 everywhere, also for tiny p-values
ERFC = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587,
        -0.82215223, 0.17087277)


def _sql(x) -> str:
    """A column name or SQL expression text, as SQL text."""
    return f"`{x}`" if x.isidentifier() else f"({x})"


def erfc_pos_sql(x: str) -> str:
    """erfc(x) for x >= 0 as SQL text."""
    t = f"(1.0D / (1.0D + 0.5D * {x}))"
    poly = f"({ERFC[-1]!r}D)"
    for c in reversed(ERFC[:-1]):
        poly = f"({c!r}D + {t} * {poly})"
    return f"({t} * exp({poly} - {x} * {x}))"


def two_sided_p_sql(z: str) -> str:
    return erfc_pos_sql(f"(abs({_sql(z)}) / {math.sqrt(2.0)!r}D)")


def pooled_z_sql(x_a: str, n_a: str, x_b: str, n_b: str) -> str:
    xa, na, xb, nb = (f"CAST({_sql(v)} AS DOUBLE)" for v in (x_a, n_a, x_b, n_b))
    p = f"try_divide({xa} + {xb}, {na} + {nb})"
    var = f"({p} * (1.0D - {p}) * (try_divide(1.0D, {na}) + try_divide(1.0D, {nb})))"
    diff = f"(try_divide({xa}, {na}) - try_divide({xb}, {nb}))"
    return f"try_divide({diff}, CASE WHEN {var} > 0 THEN sqrt({var}) END)"


def power_delta(alpha: float = 0.05, power: float = 0.8) -> float:
    """Solve Φ(δ − c) + Φ(−δ − c) = power for δ (two-sided, c = z_{1−α/2}).

    A pure function of two scalars, solved once on the driver; the per-row
    sample sizes are then column expressions.
    """
    nd = NormalDist()
    c = nd.inv_cdf(1.0 - alpha / 2.0)
    lo, hi = 0.0, 40.0
    for _ in range(200):
        mid = (lo + hi) / 2.0
        if nd.cdf(mid - c) + nd.cdf(-mid - c) < power:
            lo = mid
        else:
            hi = mid
    return (lo + hi) / 2.0


def sample_size_per_variant(baseline, mde, alpha: float = 0.05, power: float = 0.8) -> Column:
    """Sessions per variant to detect an absolute lift ``mde`` over ``baseline``."""
    d = power_delta(alpha, power)
    p = _c(baseline).cast("double")
    effect = F.try_divide(F.abs(_c(mde).cast("double")), F.sqrt(p * (F.lit(1.0) - p)))
    n = F.try_divide(F.lit(2.0 * d * d), effect * effect)
    return F.when(effect > 0, F.floor(n)).cast("long")

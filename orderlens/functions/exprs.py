"""Column expressions shared by every operator.

All helpers return ``Column`` objects built from ``pyspark.sql.functions`` so
they stay inside whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------------------
# Numbers
# ---------------------------------------------------------------------------

def rnd(x: ColumnOrName, digits: int) -> Column:
    """Round half-to-even on the scaled double: ``rint(x * 10^n) / 10^n``.

    This reproduces rounding of a float frame exactly; Spark ``round`` is
    HALF_UP and ``bround`` works on the decimal expansion, both of which
    disagree on ties produced by binary floating point."""
    scale = float(10 ** digits)
    return F.rint(_c(x).cast("double") * F.lit(scale)) / F.lit(scale)


def nan_to_null(x: ColumnOrName) -> Column:
    """NaN is 'missing' in the source model; SQL only knows NULL."""
    c = _c(x)
    return F.when(~F.isnan(c), c)


def clip01(x: ColumnOrName) -> Column:
    """Clip to [0, 1] keeping NULL as NULL (``greatest``/``least`` skip NULLs)."""
    c = _c(x)
    return F.when(c.isNotNull(), F.greatest(F.least(c, F.lit(1.0)), F.lit(0.0)))


def clip_lower(x: ColumnOrName, low: float) -> Column:
    c = _c(x)
    return F.when(c.isNotNull(), F.greatest(c, F.lit(float(low))))


def exact_sum(x: ColumnOrName) -> Column:
    """Order-independent sum of a DOUBLE column without cutting its values.

    Whole parts are summed as DECIMAL(38,0) and the rest (below 1) as
    DECIMAL(38,20): both sums are exact, so the result does not depend on the
    order in which partitions merge, fractions of a cent count, and sums stay
    clear of overflow up to 1e38."""
    c = _c(x).cast("double")
    rest = c % F.lit(1.0)
    whole = F.sum((c - rest).cast("decimal(38,0)"))
    part = F.sum(rest.cast("decimal(30,20)"))
    carry = F.floor(part)
    return ((whole + carry.cast("decimal(28,0)")).cast("double")
            + (part - carry).cast("decimal(38,20)").cast("double"))


def exact_avg(x: ColumnOrName) -> Column:
    c = _c(x)
    return exact_sum(c) / F.count(c)


def nullif_zero(x: ColumnOrName) -> Column:
    c = _c(x)
    return F.when(c != 0, c)


def ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """num / den as DOUBLE; zero or NULL denominator gives NULL (x/0 -> missing)."""
    return F.try_divide(_c(num).cast("double"), nullif_zero(_c(den)).cast("double"))


def safe_div(num: ColumnOrName, den: ColumnOrName, default: float = 0.0) -> Column:
    """``DIVIDE(a, b, default)``: ratio, or ``default`` when it is undefined."""
    return F.coalesce(ratio(num, den), F.lit(float(default)))


def pct_change(x: ColumnOrName, prev: ColumnOrName) -> Column:
    """Relative change against the previous row, 4 dp; x/0 and 0/0 -> NULL."""
    return rnd(ratio(x, prev) - F.lit(1.0), 4)


_NUMERIC_RE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_SPECIAL_RE = r"^\s*[+-]?(inf|infinity)\s*$"


def coerce_double(x: ColumnOrName) -> Column:
    """Coercing numeric cast: unparseable text -> NULL, NaN -> NULL (its text
    passes neither pattern).

    Accepts plain decimal / scientific notation and +-inf; rejects Java-style
    suffixes such as ``1.0d`` that ``try_cast`` alone would accept."""
    c = _c(x)
    s = c.cast("string")
    ok = s.rlike(_NUMERIC_RE) | F.lower(s).rlike(_SPECIAL_RE)
    return F.when(ok, F.trim(s).try_cast("double"))


# ---------------------------------------------------------------------------
# Dates
# ---------------------------------------------------------------------------

def week_start(d: ColumnOrName) -> Column:
    """Monday of the (Mon-Sun) week containing ``d``; pure DATE arithmetic,
    independent of the session time zone."""
    c = _c(d).cast("date")
    return F.date_sub(c, (F.dayofweek(c) + F.lit(5)) % F.lit(7))


def iso_year_week(d: ColumnOrName) -> Column:
    """``%G-W%V`` label: ISO week-numbering year, '-W', two-digit ISO week."""
    c = _c(d).cast("date")
    return F.concat(
        F.extract(F.lit("YEAROFWEEK"), c).cast("string"),
        F.lit("-W"),
        F.lpad(F.weekofyear(c).cast("string"), 2, "0"),
    )


def month_name(d: ColumnOrName) -> Column:
    return F.date_format(_c(d).cast("date"), "MMMM")


def date_parts(d: ColumnOrName) -> dict[str, Column]:
    """year / month / ISO week / quarter as BIGINT."""
    c = _c(d).cast("date")
    return {
        "year": F.year(c).cast("bigint"),
        "month": F.month(c).cast("bigint"),
        "week_number": F.weekofyear(c).cast("bigint"),
        "quarter": F.quarter(c).cast("bigint"),
    }


# ---------------------------------------------------------------------------
# Ordered picks (deterministic "first" / "last")
# ---------------------------------------------------------------------------

def first_by(value: ColumnOrName, order: ColumnOrName) -> Column:
    """First non-missing ``value`` in ``order`` (an aggregate)."""
    v = _c(value)
    return F.min_by(v, F.when(v.isNotNull(), _c(order)))


def last_by(value: ColumnOrName, order: ColumnOrName) -> Column:
    """Last non-missing ``value`` in ``order`` (an aggregate)."""
    v = _c(value)
    return F.max_by(v, F.when(v.isNotNull(), _c(order)))


# ---------------------------------------------------------------------------
# Display formats
# ---------------------------------------------------------------------------

def fixed(x: ColumnOrName, digits: int, plus: bool = False) -> Column:
    """Fixed-point text of a DOUBLE, ``%.<digits>f`` as C prints it: the value
    itself is rounded half-to-even, not its shortest decimal form (which is
    what ``format_string`` rounds, half up).

    ``x * 2 * 10^digits`` is split into a rounded product and its exact error
    (the factor has few bits), so the comparison with the midpoint of two
    neighbours is exact.  Missing prints as ``nan``; from 1e13 on there are no
    two digits left to round and ``format_string`` is right."""
    c = _c(x).cast("double")
    a, scale = F.abs(c), 10 ** digits
    twice = a * F.lit(2.0 * scale)
    split = a * F.lit(134217729.0)
    high = split - (split - a)
    error = (high * F.lit(2.0 * scale) - twice) + (a - high) * F.lit(2.0 * scale)
    n = F.floor(a * F.lit(float(scale)))
    over = (twice - (2 * n + 1).cast("double")) + error
    q = n + F.when(over > 0, 1).when(over == 0, n % 2).otherwise(0)
    text = F.floor(q / scale).cast("string") if digits else q.cast("string")
    if digits:
        text = F.concat(text, F.lit("."), F.lpad((q % scale).cast("string"), digits, "0"))
    sign = F.when(c.cast("string").startswith("-"), F.lit("-")).otherwise(F.lit("+" if plus else ""))
    flag = "+" if plus else ""
    return (F.when(c.isNull(), F.lit("nan"))
            .when(a < 1e13, F.concat(sign, text))
            .otherwise(F.format_string(f"%{flag}.{digits}f", c)))


def fmt_currency(x: ColumnOrName, symbol: str = "$") -> Column:
    """``$1.23M`` / ``$4.56K`` / ``$7.89``; missing prints as ``$nan``."""
    c = _c(x).cast("double")
    return (
        F.when(c >= 1_000_000, F.concat(F.lit(symbol), fixed(c / F.lit(1_000_000.0), 2), F.lit("M")))
        .when(c >= 1_000, F.concat(F.lit(symbol), fixed(c / F.lit(1_000.0), 2), F.lit("K")))
        .otherwise(F.concat(F.lit(symbol), fixed(c, 2)))
    )


def fmt_pct(x: ColumnOrName, digits: int = 2) -> Column:
    """Fraction shown as percent: 0.1234 -> ``12.34%``; missing is ``nan%``."""
    return F.concat(fixed(_c(x).cast("double") * F.lit(100.0), digits), F.lit("%"))


def fmt_signed_pct(x: ColumnOrName, digits: int = 2, suffix: str = "") -> Column:
    """Signed percent, ``+1.23%`` / ``-4.56%``; NULL stays NULL."""
    c = _c(x).cast("double")
    return F.when(c.isNotNull(), F.concat(fixed(c * F.lit(100.0), digits, plus=True), F.lit("%" + suffix)))


def fmt_thousands(x: ColumnOrName) -> Column:
    """``#,0``: integer with thousands separators."""
    return F.format_number(_c(x).cast("double"), 0)


def fmt_measure(x: ColumnOrName, pattern: str) -> Column:
    """Display a measure value with one of the model's format strings:
    ``#,0``, ``£#,0.00`` (any currency prefix), ``0.00%`` and the signed
    ``+0.00%;-0.00%;0.00%``.  Values are rounded half-to-even first."""
    c = _c(x).cast("double")
    if pattern == "#,0":
        return F.format_number(rnd(c, 0), 0)
    if pattern.endswith("#,0.00"):
        prefix = pattern[: -len("#,0.00")]
        body = F.format_number(F.abs(rnd(c, 2)), 2)
        return F.when(c.isNotNull(), F.concat(F.when(rnd(c, 2) < 0, F.lit("-")).otherwise(F.lit("")),
                                               F.lit(prefix), body))
    if pattern == "0.00%":
        return F.when(c.isNotNull(), fmt_pct(c, 2))
    if pattern == "+0.00%;-0.00%;0.00%":
        r = rnd(c * F.lit(100.0), 2)
        return (F.when(c.isNull(), F.lit(None))
                .when(r == 0, F.lit("0.00%"))
                .otherwise(F.format_string("%+.2f%%", r)))
    raise ValueError(f"unsupported format {pattern!r}")

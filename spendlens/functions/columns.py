"""Column expressions shared by all operators. Every one stays inside code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from spendlens import fixed_values as V

MONEY = "decimal(18,4)"
RATE = "decimal(18,6)"
TOTAL = "decimal(38,4)"
ALLOCATED = "decimal(18,6)"
ALLOCATED_TOTAL = "decimal(38,6)"
IDE_SHARE = "decimal(9,8)"
FEATURE_SHARE = "decimal(18,8)"

_WHITESPACE = " \t\n\r\f\x0b"
_ZONE_SUFFIX = r"(Z|[+-]\d{2}:?\d{2})$"


def as_column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ------------------------------------------------------------------ keys


def norm(c) -> Column:
    """Join key for text: names that differ in case or trailing blanks only are the same name."""
    return F.lower(F.rtrim(as_column(c)))


def present(key) -> Column:
    key = as_column(key)
    return key.isNotNull() & (key != "")


def product_key(product, sku) -> Column:
    """One unambiguous key for the (product, sku) pair; NULL when either part is NULL."""
    product, sku = norm(product), norm(sku)
    return F.when(
        present(product),
        F.concat(F.length(product).cast("string"), F.lit(":"), product, F.lit(":"), sku),
    )


def team_key(team_id, org_key) -> Column:
    return F.concat(as_column(team_id).cast("string"), F.lit(":"), as_column(org_key))


# ------------------------------------------------------------------ raw value rules


def strip(c) -> Column:
    return F.btrim(as_column(c), F.lit(_WHITESPACE))


def text_or(c, default: str) -> Column:
    """The text, or the default when it is absent or empty."""
    return F.coalesce(F.nullif(as_column(c), F.lit("")), F.lit(default))


def label(c, default: str) -> Column:
    """Dimension value: defaulted, stripped, lower-cased."""
    return F.lower(strip(text_or(c, default)))


def _number(c) -> Column:
    """The value as a decimal; NULL for texts that are no finite number."""
    return as_column(c).cast("string").try_cast("decimal(38,10)")


def _whole(c, kind: str) -> Column:
    cut = F.when(_number(c) < 0, F.ceil(_number(c))).otherwise(F.floor(_number(c)))
    return cut.try_cast(kind)


def count(c, kind: str = "bigint") -> Column:
    """Truncated integer; anything that is not a finite number in range counts as zero."""
    return F.coalesce(_whole(c, kind), F.lit(0).cast(kind))


def count_refused(c) -> Column:
    """Whether a count was given and could not be read."""
    given = strip(as_column(c).cast("string"))
    return F.coalesce((given != "") & _whole(c, "bigint").isNull(), F.lit(False))


def money(c, decimal: str = MONEY) -> Column:
    return F.coalesce(as_column(c).cast(decimal), F.lit(0).cast(decimal))


def flag(c) -> Column:
    """Truthiness with NULL kept: no signal is not the same as unused."""
    text = F.lower(as_column(c))
    return F.when(text.isNotNull(), ~text.isin("false", "0", "0.0", "", "[]", "{}"))


#: Days outside are taken for damage: a calendar is filled from the first to the last day.
FIRST_DAY, LAST_DAY = "1990-01-01", "2099-12-31"


def day(c) -> Column:
    """The day at the start of a text; NULL when there is none in the calendar's range."""
    date = F.substring(as_column(c).cast("string"), 1, 10).try_cast("date")
    return F.when(date.between(F.lit(FIRST_DAY).cast("date"), F.lit(LAST_DAY).cast("date")), date)


def day_refused(c) -> Column:
    """Whether a day was given and could not be read."""
    return present(as_column(c)) & day(c).isNull()


def whole_second(ts) -> Column:
    """A zone-less timestamp rounded to the nearest second."""
    shifted = as_column(ts) + F.expr("interval 500 milliseconds")
    return F.date_trunc("second", shifted).cast("timestamp_ntz")


def utc_time(c) -> Column:
    """ISO text to a zone-less UTC time. Text without an offset is taken as UTC already."""
    text = F.nullif(as_column(c), F.lit(""))
    local = text.cast("timestamp").cast("timestamp_ntz")
    shifted = F.convert_timezone(F.current_timezone(), F.lit("UTC"), local)
    return whole_second(
        F.when(text.rlike(_ZONE_SUFFIX), shifted).otherwise(text.cast("timestamp_ntz"))
    )


# ------------------------------------------------------------------ lookups


def ide_family(c) -> Column:
    pairs = [F.lit(x) for pair in V.IDE_FAMILIES.items() for x in pair]
    found = F.create_map(*pairs)[F.lower(strip(c))]
    return F.coalesce(found, F.lit(V.OTHER_FAMILY))


def feature_group(c) -> Column:
    key = norm(c)
    result = F.lit(V.OTHER_GROUP)
    for prefix, group in V.FEATURE_GROUP_PREFIXES.items():
        result = F.when(key.startswith(prefix), group).otherwise(result)
    for value, group in V.FEATURE_GROUPS.items():
        result = F.when(key == value, group).otherwise(result)
    return result


# ------------------------------------------------------------------ dates


def date_key(d) -> Column:
    d = as_column(d)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def to_date_key(value) -> int:
    """date_key of a driver-side date or ISO text."""
    return int(str(value)[:10].replace("-", ""))


# ------------------------------------------------------------------ ratios and output


def ratio(numerator, denominator) -> Column:
    """Quotient as a double; NULL when the denominator is zero or missing."""
    return F.try_divide(
        as_column(numerator).cast("double"), as_column(denominator).cast("double")
    )


def money_text(c) -> Column:
    """Dollar text with thousands separators; missing or unreadable amounts show as $0.00."""
    amount = F.coalesce(as_column(c).cast("string").try_cast("double"), F.lit(0.0))
    return F.concat(F.lit("$"), F.format_number(amount, 2))


def pseudonym(c) -> Column:
    return F.concat(F.lit("user-"), F.substring(F.sha2(as_column(c), 256), 1, 8))


def safe_segment(c) -> Column:
    """A path segment that cannot leave its folder and is never empty."""
    cleaned = F.btrim(F.regexp_replace(as_column(c), V.UNSAFE_SEGMENT, "_"), F.lit("."))
    return text_or(cleaned, V.UNNAMED)

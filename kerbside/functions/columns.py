"""Column expressions. All are built-ins, so they stay inside codegen."""

from pyspark.sql import Column, functions as F

from kerbside import contract as C


def rounded(col, digits) -> Column:
    """Half up on the decimal value: what a double misses of it is rounded off first."""
    col = F.col(col) if isinstance(col, str) else col
    return F.round(F.round(col, digits + 6), digits)


def total(col) -> Column:
    """The sum of a column of doubles to the millionth, the same for any order of the rows; null without values.

    Whole parts and millionths are summed as whole numbers. A value of 2^53
    and more, or one that is not finite, has no millionths and is added as it
    is.
    """
    value = (F.col(col) if isinstance(col, str) else col).cast("double")
    small = F.abs(value) < 2.0**53
    whole = F.sum(F.when(small, F.floor(value)))
    parts = F.sum(F.when(small, F.floor((value - F.floor(value)) * 1e6 + 0.5)))
    exact = whole + parts / 1e6
    large = F.sum(F.when(~small, value))
    return F.when(large.isNull(), exact).otherwise(F.coalesce(exact, F.lit(0.0)) + large)


def mean(col) -> Column:
    """:func:`total` over the number of values."""
    return F.try_divide(total(col), F.count(col))


def padded(number: Column, width) -> Column:
    """Zero-padded digits; longer numbers keep all of theirs."""
    digits = number.cast("string")
    return F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0"))


def lookup(key: Column, mapping: dict, default=None) -> Column:
    """Value of a literal map; unmapped and null keys give ``default``.

    A map, not a CASE, so that the key expression is evaluated once.
    """
    pairs = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    found = F.try_element_at(pairs, key)
    return found if default is None else F.coalesce(found, F.lit(default))


def canonical_type(col: Column) -> Column:
    return lookup(F.lower(F.trim(col)), C.TYPE_SPELLINGS, C.UNKNOWN)


def canonical_zone(col: Column) -> Column:
    return lookup(F.lower(F.trim(col)), C.ZONE_SPELLINGS, C.UNKNOWN)


def title_case(col: Column) -> Column:
    return F.initcap(F.trim(col))


def number(col: Column) -> Column:
    """Numeric value or null: bad text and NaN both become null."""
    value = col.try_cast("double")
    return F.when(~F.isnan(value), value)


def moment(col: Column) -> Column:
    """Timestamp or null."""
    return F.try_to_timestamp(col.cast("string"))


def within(col: Column, low, high) -> Column:
    """Inclusive range test that is false, not null, for nulls."""
    return F.coalesce(col.between(low, high), F.lit(False))


def outside(col: Column, low, high) -> Column:
    """1 when a value is present and out of range, else 0."""
    return F.when(col.isNotNull() & ~col.between(low, high), 1).otherwise(0)


def clip(col: Column, low, high) -> Column:
    """Clip to a range; ``least``/``greatest`` skip nulls, so guard them."""
    return F.when(col.isNotNull(), F.least(F.greatest(col, F.lit(low)), F.lit(high)))


def is_peak(hour: Column) -> Column:
    flag = F.lit(False)
    for low, high in C.PEAK_HOURS:
        flag = flag | within(hour, low, high)
    return flag


def is_weekend(ts: Column) -> Column:
    return F.coalesce(F.weekday(ts) >= 5, F.lit(False))


def day_name(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")


def severity(kind: Column, speed: Column) -> Column:
    speeding = kind == C.SPEEDING
    return (
        F.when(kind.isin(C.ALWAYS_HIGH), "High")
        .when(speeding & (speed > C.SPEEDING_HIGH), "High")
        .when(speeding & speed.between(C.SPEEDING_MEDIUM, C.SPEEDING_HIGH), "Medium")
        .when(kind == C.ALWAYS_MEDIUM, "Medium")
        .otherwise("Low")
    )


def tier(col: Column, steps, beyond) -> Column:
    """First label whose upper bound holds the value; null falls through."""
    out = None
    for upper, label in steps:
        out = F.when(col <= upper, label) if out is None else out.when(col <= upper, label)
    return out.otherwise(beyond)


def speed_category(speed: Column) -> Column:
    return tier(speed, C.SPEED_CATEGORIES, C.SPEED_BEYOND)


def fine_tier(fine: Column) -> Column:
    return tier(fine, C.FINE_TIERS, C.FINE_BEYOND)


def log_partition(key: Column, n: int) -> Column:
    """Stable key -> partition number, the same in every process and engine."""
    head = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long")
    return F.pmod(head, F.lit(n)).cast("int")


def is_alert(kind: Column, speed: Column) -> Column:
    return kind.isin(C.ALERT_TYPES) | (speed > C.ALERT_SPEED)


def draw(seed_name: str, low, high, *keys) -> Column:
    """Whole number in [low, high), derived from the keys by hashing."""
    return F.pmod(F.xxhash64(*keys, F.lit(seed_name)), F.lit(high - low)) + F.lit(low)


def pick(seed_name: str, values, *keys) -> Column:
    """One of ``values``, derived from the keys by hashing."""
    options = F.array(*[F.lit(v) for v in values])
    return F.element_at(options, (draw(seed_name, 0, len(values), *keys) + 1).cast("int"))

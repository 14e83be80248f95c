"""Column expressions: parsing, cleaning and calendar parts. All stay inside the JVM."""

from __future__ import annotations

import math
from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, functions as F

# Accepted number text, white space, and date layouts in order of preference.
NUMBER_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
WHITE_SPACE = (" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0       "
               "         　")
NULL_TEXT = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
             "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
ODD_SIGN = r"[^ -~]"
DAY_FIRST = r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})$"
ISO_TEXT = r"^\d{4}-\d{1,2}-\d{1,2}([ T].*)?$"
CLOCK_TEXT = r"[ T]+(\d{1,2}):(\d{2})(?::(\d{2}(?:\.\d+)?))?(?: ?([AaPp])[Mm])?$"
SHORT_YEAR = r"^((?:\d{1,2}-)?[A-Za-z]+-(?:\d{1,2}-)?|\d{1,2}-\d{1,2}-)(\d{2})$"
ZONED_TEXT = r"^\d{4}-\d{1,2}-\d{1,2}[ T].*(Z|[+-]\d{2}:?\d{2})$"
# End of fixed values.


def strip(c: Column) -> Column:
    """Without white space at both ends. Plain text only needs blanks cut off, which is several times as fast."""
    return F.when(c.rlike(ODD_SIGN), F.trim(c, F.lit(WHITE_SPACE))).otherwise(F.trim(c))


def finite(c: Column) -> Column:
    """NaN and both infinities become NULL, so aggregates skip them."""
    return F.when(F.isnan(c) | (F.abs(c) == float("inf")), None).otherwise(c)


def parse_number(c: Column) -> Column:
    text = strip(F.replace(c.cast("string"), F.lit(","), F.lit("")))
    return finite(F.when(text.rlike(NUMBER_TEXT), text.try_cast("double")))


def as_number(c: Column, dtype: str) -> Column:
    """Number column of any stored type; text goes through :func:`parse_number`."""
    return parse_number(c) if dtype in ("string", "void") else finite(c.cast("double"))


def null_tokens(c: Column) -> Column:
    """CSV cells that stand for a missing value."""
    return F.when(c.isin(*NULL_TEXT), None).otherwise(c)


def clean_key(c: Column) -> Column:
    return F.lower(strip(c.cast("string")))


def clean_or_default(c: Column, default: str = "unspecified") -> Column:
    return F.coalesce(F.nullif(clean_key(c), F.lit("")), F.lit(default))


def spelling(c: Column, wanted: tuple[str, ...]) -> Column:
    """Cleaned category -> the spelling asked for; NULL for any other category."""
    pairs = [F.lit(text) for name in wanted for text in (name.strip().lower(), name)]
    return F.try_element_at(F.create_map(*pairs), clean_key(c))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once; a plain expression would repeat it at every use."""
    return F.transform(F.array(value), use)[0]


def _calendar_day(text: Column, day_first: bool) -> Column:
    """Day of a text without a time of day, as a timestamp at midnight.

    Signs between the parts become '-', month names three letters, and two-digit years the year within 50 years
    of today, so few layouts are left; only those whose shape fits are tried.
    """
    both = ["d-M-yyyy", "M-d-yyyy"]
    layouts = {
        r"^\d{4}-\d{1,2}-\d{1,2}$": ["yyyy-M-d"], r"^\d{8}$": ["yyyyMMdd"],
        r"^\d{1,2}-\d{1,2}-\d{4}$": both if day_first else both[::-1],
        r"^\d{1,2}-[A-Za-z]{3}-\d{4}$": ["d-MMM-yyyy"], r"^[A-Za-z]{3}-\d{1,2}-\d{4}$": ["MMM-d-yyyy"],
    }

    def full_year(plain: Column) -> Column:
        year = F.regexp_extract(plain, SHORT_YEAR, 2)
        century = F.when(year >= F.lit(f"{(date.today().year + 50) % 100:02d}"), F.lit("19")).otherwise(F.lit("20"))
        return F.when(year != "", F.concat(F.regexp_extract(plain, SHORT_YEAR, 1), century, year)).otherwise(plain)

    def parsed(plain: Column) -> Column:
        out = None
        for shape, formats in layouts.items():
            tries = [F.try_to_timestamp(plain, F.lit(f)).cast("timestamp_ntz") for f in formats]
            out = (out.when if out is not None else F.when)(plain.rlike(shape), F.coalesce(*tries))
        return out

    plain = F.regexp_replace(F.regexp_replace(text, r"[-/., ]+", "-"), "([A-Za-z]{3})[A-Za-z]+", "$1")
    return _let(_let(plain, full_year), parsed)


def parse_date(c: Column, dtype: str = "string") -> Column:
    """Day-first date; ISO text stays year-month-day; the time of day is dropped."""
    if dtype != "string":
        return c.cast("date")
    text = strip(c)
    iso = F.when(text.rlike(ISO_TEXT), text.try_cast("date"))
    # The usual layout is turned into ISO text; what is no such day goes the long way, as all others do.
    usual = F.when(text.rlike(DAY_FIRST), F.regexp_replace(text, DAY_FIRST, "$3-$2-$1").try_cast("date"))
    return F.coalesce(iso, usual, _calendar_day(F.regexp_replace(text, CLOCK_TEXT, ""), True).cast("date"))


def parse_timestamp(c: Column, zone: str, dtype: str = "string") -> Column:
    """Month-first timestamp without zone; text with an offset is moved to ``zone`` first."""
    if dtype == "timestamp":
        return local_time(c, zone)
    if dtype != "string":
        return c.cast("timestamp_ntz")
    text = strip(c)
    hour, minute, second = (F.coalesce(F.nullif(F.regexp_extract(text, CLOCK_TEXT, i), F.lit("")), F.lit("0")) for i in (1, 2, 3))
    half = F.lower(F.regexp_extract(text, CLOCK_TEXT, 4))
    hour = hour.cast("int")
    of_day = F.when(half == "", hour).when(hour.between(1, 12), hour % 12 + F.when(half == "p", 12).otherwise(0))
    clock = F.when((of_day < 24) & (minute.cast("int") < 60), F.make_dt_interval(F.lit(0), of_day, minute.cast("int"), second.cast("decimal(18,6)")))
    mixed = _calendar_day(F.regexp_replace(text, CLOCK_TEXT, ""), False) + clock
    return (
        F.when(text.rlike(ZONED_TEXT), local_time(text.try_cast("timestamp"), zone))
        .when(text.rlike(ISO_TEXT), F.coalesce(text.try_cast("timestamp_ntz"), mixed))
        .otherwise(mixed)
    )


def local_time(instant: Column, zone: str) -> Column:
    """Instant -> wall clock in ``zone``, zone dropped; independent of the session zone."""
    return F.convert_timezone(F.current_timezone(), F.lit(zone), instant.cast("timestamp_ntz"))


def weekday(c: Column) -> Column:
    """Monday is 0."""
    return F.weekday(c)


def cyclic(value: Column, period: int, name: str) -> list[Column]:
    angle = F.lit(2 * math.pi) * value / F.lit(float(period))
    return [F.sin(angle).alias(f"{name}_sin"), F.cos(angle).alias(f"{name}_cos")]


def quarter_label(c: Column) -> Column:
    return F.concat(F.year(c).cast("string"), F.lit("Q"), F.quarter(c).cast("string"))


def reasons(rules: list[tuple[Column, str]], ok: str = "eligible") -> Column:
    """Texts of the failed rules joined by '; ', or ``ok``."""
    joined = F.concat_ws("; ", *[F.when(failed, F.lit(text)) for failed, text in rules])
    return F.when(joined == "", F.lit(ok)).otherwise(joined)


def ratio(top: Column, bottom: Column) -> Column:
    """Division that yields NULL instead of an error on zero."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def draw(*parts: Column | str | int) -> Column:
    """Repeatable pseudo-random whole number in [0, 2^32) from the given parts."""
    text = F.concat_ws(":", *[(p if isinstance(p, Column) else F.lit(str(p))).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def range_violation(c: Column, low: Column, high: Column) -> Column:
    """True where a value sits outside its own known and sound range."""
    known = low.isNotNull() & high.isNotNull()
    wrong = (low <= 0) | (high < low) | (c < low) | (c > high)
    return F.coalesce(known & wrong, F.lit(False))

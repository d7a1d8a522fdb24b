"""Column expressions for market data: cleaning, parsing, clocks and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE = "America/New_York"

# Minutes of the New York day at which each labelled part begins and ends.
DAY_PARTS = (("Pre-Market", 240, 570), ("Open", 570, 600), ("Mid-Morning", 600, 690), ("Late Morning", 690, 720), ("Lunch", 720, 810), ("Early Afternoon", 810, 900), ("Late Afternoon", 900, 930), ("Close", 930, 960))


def clean_ticker(c: Column) -> Column:
    """Trimmed, upper case, up to the first hyphen."""
    return F.split(F.upper(F.trim(c)), "-")[0]


def to_number(c: Column) -> Column:
    """A double; blank, bad, NaN and infinite values are null."""
    x = F.trim(c).try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def to_int(c: Column) -> Column:
    """A whole number, cut off from a number's text; null where to_number is."""
    return to_number(c).cast("long")


def parse_occ_symbol(c: Column) -> Column:
    """struct(root, expiry, type, strike) of an option symbol such as O:ABC240119C00050000; null if it isn't one."""
    pattern = r"^O:([A-Z]+)(\d{6})([CP])(\d{8})$"
    part = lambda k: F.regexp_extract(c, pattern, k)
    expiry = F.try_to_date(F.concat(F.lit("20"), part(2)), "yyyyMMdd")
    return F.when(c.rlike(pattern), F.struct(part(1).alias("root"), expiry.alias("expiry"), part(3).alias("type"), (part(4).cast("double") / 1000).alias("strike")))


def occ_symbol(root: Column, expiry: Column, kind: Column, strike: Column) -> Column:
    return F.concat(F.lit("O:"), root, F.date_format(expiry, "yyMMdd"), kind, F.lpad(F.round(strike * 1000).cast("long").cast("string"), 8, "0"))


def new_york(ts: Column) -> Column:
    """Wall clock of New York from a UTC timestamp without time zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(ZONE), ts)


def minute_of_day(ts: Column) -> Column:
    return F.hour(ts) * 60 + F.minute(ts)


def time_zone_bucket(ts: Column) -> Column:
    """Label of the part of the New York day that a UTC timestamp falls in, or Other."""
    minute = minute_of_day(new_york(ts))
    out = F.lit("Other")
    for label, start, end in reversed(DAY_PARTS):
        out = F.when((minute >= start) & (minute < end), F.lit(label)).otherwise(out)
    return out


def in_session(ts: Column, start: int = 570, end: int = 960) -> Column:
    """Whether a UTC timestamp is inside [start, end) minutes of the New York day."""
    minute = minute_of_day(new_york(ts))
    return (minute >= start) & (minute < end)


def session_label(ts: Column, closed: Column, early_close: Column | None = None) -> Column:
    """pre-market, regular, after-hours or closed; closed: the day is a holiday or weekend; early_close: minute, if any."""
    minute = minute_of_day(new_york(ts))
    end = F.coalesce(early_close, F.lit(960)) if early_close is not None else F.lit(960)
    return F.when(closed, "closed").when((minute >= 240) & (minute < 570), "pre-market").when((minute >= 570) & (minute < end), "regular").when((minute >= end) & (minute < 1200), "after-hours").otherwise("closed")


def naive_ts_to_utc(text: Column) -> Column:
    """UTC timestamp from text: with an offset as it says, without one as UTC+8."""
    aware = text.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    return F.when(aware, F.try_to_timestamp(text)).otherwise(F.try_to_timestamp(F.concat(text, F.lit("+08:00"))))


def sic_group(code: Column) -> Column:
    """One of eleven groups of a SIC code by range, or Other."""
    # First and last code of each division of the classification.
    ranges = ((100, 999, "Agriculture"), (1000, 1499, "Mining"), (1500, 1799, "Construction"), (2000, 3999, "Manufacturing"), (4000, 4999, "Transportation"), (5000, 5199, "Wholesale"), (5200, 5999, "Retail"), (6000, 6799, "Finance"), (7000, 8999, "Services"), (9100, 9729, "Public Administration"), (9900, 9999, "Nonclassifiable"))
    out = F.lit("Other")
    for low, high, name in ranges:
        out = F.when(code.between(low, high), F.lit(name)).otherwise(out)
    return out


def expiry_type(expiry: Column, dte: Column) -> Column:
    """Monthly on a third Friday; Weekly on another Friday or within 7 days; else Monthly."""
    friday = F.dayofweek(expiry) == 6
    third = F.dayofmonth(expiry).between(15, 21)
    return F.when(friday & third, "Monthly").when(friday | (dte <= 7), "Weekly").otherwise("Monthly")


def safe_divide(a: Column, b: Column, default: float | None = None) -> Column:
    """a / b, or default where b is 0 or null."""
    out = a / F.nullif(b, F.lit(0).cast("double"))
    return out if default is None else F.coalesce(out, F.lit(default))

"""Date and duration columns. Instants are ``timestamp_ntz`` read as UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.functions import text as tx

NTZ = "timestamp_ntz"


def ntz(literal: str) -> Column:
    return F.lit(literal).cast(NTZ)


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a zone-less instant."""
    return F.unix_micros(ts.cast("timestamp"))


def from_micros(us: Column) -> Column:
    return F.timestamp_micros(us).cast(NTZ)


def shift_hours(ts: Column, hours: int) -> Column:
    return ts + F.expr(f"make_dt_interval(0, {int(hours)}, 0, 0)")


def round_half_up(c: Column) -> Column:
    return F.floor(c + 0.5)


def age_hours(generated: Column, published: Column) -> Column:
    return (micros(generated) - micros(published)) / F.lit(3_600_000_000.0)


def freshness_hours(generated: Column, published: Column) -> Column:
    """Age in hours, two decimals, halves up; null when either date is missing."""
    return F.floor(age_hours(generated, published) * 100 + 0.5) / 100


def published_from_freshness(generated: Column, hours: Column) -> Column:
    return F.when(hours.isNull(), generated).otherwise(from_micros(micros(generated) - (hours * 3_600_000_000).cast("bigint")))


def iso_week_key(ts: Column) -> Column:
    return F.format_string("%d-W%02d", F.extract(F.lit("YEAROFWEEK"), ts).cast("int"), F.weekofyear(ts))


def week_start(ts: Column) -> Column:
    return F.date_trunc("week", ts).cast("date")


def china_time(stamp: Column) -> Column:
    """``yyyy-MM-dd HH:mm[:ss]`` wall time at +08:00, as UTC."""
    padded = F.when(stamp.rlike(r":\d{2}:\d{2}$"), stamp).otherwise(F.concat(stamp, F.lit(":00")))
    parsed = F.try_to_timestamp(padded, F.lit("yyyy-MM-dd HH:mm:ss")).cast(NTZ)
    return shift_hours(parsed, -8)


def listing_time(value: Column, now: Column) -> Column:
    """Times as written on listing pages: ``N 分钟/小时/天前``, ``MM月DD日``, absolute +08:00 time; else null."""
    ago, month_day, absolute = r"(?U)^(\d+)\s*(分钟|小时|天)前$", r"^(\d{2})月(\d{2})日$", r"(?U)^(\d{4}-\d{2}-\d{2})\s+(\d{2}:\d{2}(?::\d{2})?)$"

    def read(text: Column) -> Column:
        unit = F.regexp_extract(text, ago, 2)
        step = F.when(unit == "分钟", F.lit(60_000_000)).when(unit == "小时", F.lit(3_600_000_000)).otherwise(F.lit(86_400_000_000))
        amount = F.regexp_extract(text, ago, 1).try_cast("bigint")
        this_year = F.concat(F.year(now).cast("string"), F.regexp_replace(text, month_day, "-$1-$2 00:00:00"))
        return (
            F.when(text.rlike(ago), from_micros(micros(now) - amount * step))
            .when(text.rlike(month_day), china_time(this_year))
            .when(text.rlike(absolute), china_time(F.regexp_replace(text, absolute, "$1 $2")))
        )

    return tx.let(tx.strip(value), read)


_ZONED = r"(?i)\s*(gmt|utc|z|[+-]\d{2}:?\d{2})$"


def feed_time(value: Column) -> Column:
    """RFC-822 and ISO-8601 instants as UTC; null when neither reads."""
    text = tx.strip(value)
    bare = F.regexp_replace(text, r"^[A-Za-z]{3,9},\s*", "")
    zone = F.regexp_extract(bare, _ZONED, 1)
    local = F.regexp_replace(F.regexp_replace(bare, _ZONED, ""), r"(\d)T(\d)", "$1 $2")
    local = F.regexp_replace(local, r"^(\d) ", "0$1 ")
    parsed = F.coalesce(
        *[
            F.try_to_timestamp(local, F.lit(fmt))
            for fmt in (
                "dd MMM yyyy HH:mm:ss", "dd MMM yyyy HH:mm", "dd MMM yyyy",
                "yyyy-MM-dd HH:mm:ss.SSS", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd",
            )
        ]
    ).cast(NTZ)
    sign = F.when(zone.startswith("-"), -1).otherwise(1)
    digits = F.regexp_replace(zone, r"[^\d]", "")
    offset = F.when(
        F.length(digits) == 4,
        sign * (F.substring(digits, 1, 2).try_cast("int") * 60 + F.substring(digits, 3, 2).try_cast("int")),
    ).otherwise(0)
    return from_micros(micros(parsed) - offset.cast("bigint") * 60_000_000)


def unix_time(value: Column) -> Column:
    """Seconds since 1970 (number or numeric text), millisecond precision; null otherwise."""
    millis = F.floor(value.try_cast("double") * 1000).cast("bigint")
    return F.timestamp_millis(millis).cast(NTZ)


def iso_text(ts: Column) -> Column:
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("Z"))


def srt_time(ms: Column) -> Column:
    ms = ms.cast("bigint")
    seconds = F.floor(ms / 1000)
    return F.format_string("%02d:%02d:%02d,%03d", F.floor(seconds / 3600), F.floor(seconds / 60) % 60, seconds % 60, ms % 1000)


def speech_ms(text: Column, base: int = 500, per_char: int = 80, low: int = 900, high: int = 12000) -> Column:
    spoken = F.length(F.regexp_replace(text, rf"{tx.WS}+", ""))
    return F.least(F.lit(high), F.greatest(F.lit(low), F.lit(base) + spoken * per_char)).cast("bigint")


def article_ms(body: Column, per_char: int = 45, low: int = 3000) -> Column:
    return F.greatest(F.lit(low), F.length(body) * per_char).cast("bigint")

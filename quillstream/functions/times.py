"""Upload times: ISO 8601 forms to an instant, NULL for anything else."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the shape a time must have after the rewrites below.
SHAPE = (
    r"^\d{4}-\d{2}-\d{2}"
    r"(T\d{2}:\d{2}:\d{2}(\.\d+)?([+-]\d{2}:\d{2}(:\d{2}(\.\d+)?)?)?)?\z"
)
LOCAL = r"^(\d{4}-\d{2}-\d{2}(?:T\d{2}:\d{2}:\d{2}(?:\.\d+)?)?)"
OFFSET = r"T.*([+-])(\d{2}):(\d{2})(?::(\d{2})(\.\d{1,6})?)?"

# Year, week and day, with dashes throughout or without.
WEEK = r"^(\d{4})(?:-W(\d{2})(?:-(\d))?|W(\d{2})(\d)?)(?=\D|\z)"

# Rewrites of other ISO forms into that shape, applied in this order.
REWRITES = (
    (r"^(\d{4})(\d{2})(\d{2})(?=\D|\z)", "$1-$2-$3"),  # 20251022
    (r"^(\d{4}-\d{2}-\d{2})[\s\S](?=\d)", "$1T"),  # any separator
    (r"T(\d{2})(\d{2})(\d{2})(?!\d)", "T$1:$2:$3"),  # T120000
    (r"T(\d{2})(\d{2})(?=[+-]|\z)", "T$1:$2"),  # T1200
    (r"T(\d{2})(?=[+-]|\z)", "T$1:00"),  # T12
    (r"T(\d{2}:\d{2})(?=[+-]|\z)", "T$1:00"),  # T12:00
    (r"(T.*[+-]\d{2})(\d{2})(\d{2})(?=[.,]|\z)", "$1:$2:$3"),  # +030000
    (r"(T.*[+-]\d{2})(\d{2})\z", "$1:$2"),  # +0300
    (r"(?<=:\d{2}),(?=\d)", "."),  # comma fraction
    (r"(T.*[+-]\d{2})\z", "$1:00"),  # +03
)


def _calendar_date(text: Column) -> Column:
    """A week date at the start of `text` as year, month and day; NULL if there is no such week or day."""

    def part(*groups: int) -> Column:
        return F.concat(*[F.regexp_extract(text, WEEK, group) for group in groups])

    year, week, day = part(1), part(2, 4).try_cast("int"), F.coalesce(part(3, 5).try_cast("int"), F.lit(1))
    # the fourth of January is in the first week, the 28th of December in the last
    first = F.date_trunc("week", F.concat(year, F.lit("-01-04")).try_cast("timestamp")).cast("date")
    last = F.weekofyear(F.concat(year, F.lit("-12-28")).try_cast("date"))
    there = week.between(1, last) & day.between(1, 7)
    date = F.date_format(F.date_add(first, (week - 1) * 7 + day - 1), "yyyy-MM-dd")
    return F.when(text.rlike(WEEK), F.when(there, F.concat(date, F.regexp_replace(text, WEEK, "")))).otherwise(text)


def _offset_micros(text: Column) -> Column:
    def number(group: int) -> Column:
        return F.coalesce(F.regexp_extract(text, OFFSET, group).try_cast("bigint"), F.lit(0))

    fraction = F.concat(F.lit("0"), F.regexp_extract(text, OFFSET, 5)).try_cast("decimal(7,6)")
    size = (number(2) * 3600 + number(3) * 60 + number(4)) * 1_000_000 + (F.coalesce(fraction, F.lit(0)) * 1_000_000).cast("bigint")
    return F.when(F.regexp_extract(text, OFFSET, 1) == "-", -size).otherwise(size)


def parse_upload_time(col: Column) -> Column:
    """Instant of an ISO time, calendar or week date; without an offset it is read as UTC. Offsets reach to one day."""
    text = _calendar_date(F.replace(col, F.lit("Z"), F.lit("+00:00")))
    for pattern, target in REWRITES:
        text = F.regexp_replace(text, pattern, target)
    local, offset = F.regexp_extract(text, LOCAL, 1).try_cast("timestamp"), _offset_micros(text)
    good = text.rlike(SHAPE) & ~text.startswith("0000") & (F.abs(offset) < 86_400_000_000)
    return F.when(good, F.timestamp_micros(F.unix_micros(local) - offset))

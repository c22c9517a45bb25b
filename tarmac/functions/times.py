"""Times of day held as text, and the delay between two of them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted spellings of a time of day. Parts may have any number of
# digits and leading blanks, and text after the seconds is ignored.
LENIENT_TIME = r"^[ \t]*([0-9]+):[ \t]*([0-9]+):[ \t]*([0-9]+)"
USUAL_TIME = r"^[0-9]{2}:[0-9]{2}:[0-9]{2}(?![0-9])"
USUAL_STARTS = (1, 4, 7)
PART_SECONDS = (3600, 60, 1)


def seconds_of_day(text: Column) -> Column:
    """Seconds since midnight of an ``HH:mm:ss`` text, null where it cannot be read.

    Hours, minutes and seconds out of range roll over (``25:10:00`` is 90600). The usual
    spelling costs one pattern test and three substrings; only other spellings pay for
    three pattern extractions.
    """
    usual = text.rlike(USUAL_TIME)
    parts = [
        F.when(usual, F.substring(text, start, 2)).otherwise(F.regexp_extract(text, LENIENT_TIME, group))
        for group, start in enumerate(USUAL_STARTS, 1)
    ]
    # Parts beyond int are unreadable, so that the product cannot overflow.
    hours, minutes, seconds = (p.try_cast("int").cast("bigint") * s for p, s in zip(parts, PART_SECONDS))
    return hours + minutes + seconds


def delay_minutes(scheduled: Column, actual: Column, minutes: str = "of_hour") -> Column:
    """Whole minutes a departure is late, null if it is not late or a time is unreadable.

    ``minutes="of_hour"`` keeps only the minutes past the full hour, so 75 minutes count
    as 15 and a delay of exactly one hour does not count. ``minutes="total"`` keeps them
    all. Delays under a minute, early departures, and departures past midnight (both
    values are times of the same day) give null; so does a cancelled flight, which has no
    readable actual departure.

    Null rather than a filter lets aggregates skip these rows with the times read once;
    a filter on the computed delay would be pushed down and read them a second time.
    """
    late_seconds = seconds_of_day(actual) - seconds_of_day(scheduled)
    whole = F.call_function("div", late_seconds, F.lit(60))
    if minutes == "of_hour":
        whole = whole % 60
    elif minutes != "total":
        raise ValueError(f"minutes must be 'of_hour' or 'total', not {minutes!r}")
    # Not `when(whole > 0, whole)`, which would work out the times twice.
    return F.nullif(F.greatest(whole, F.lit(0)), F.lit(0))

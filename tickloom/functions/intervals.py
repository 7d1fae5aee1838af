"""Right-closed intervals (end - width, end] of nanosecond timestamps, and the regular trading session."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_NS = 86_400_000_000_000
#: The regular session, in nanoseconds: from 09:30 to 16:00 in New York, both included.
OPEN_NS, SESSION_NS = 34_200_000_000_000, 23_400_000_000_000


def width_ns(freq_hz: float) -> int:
    """The interval length of a frequency; fractions of a nanosecond are cut off."""
    return int(1e9 / freq_hz)


def freq_label(freq_hz: float) -> str:
    return f"{freq_hz:g}Hz"


def parse_frequencies(text: str) -> list[float]:
    """Positive frequencies from a comma list, each once; two that share a label are an error."""
    found: list[float] = []
    for part in filter(None, (p.strip() for p in text.split(","))):
        freq = float(part)
        if not freq > 0 or freq == float("inf"):
            raise ValueError(f"a frequency must be positive: {part}")
        if freq not in found:
            found.append(freq)
    if not found:
        raise ValueError("no frequency")
    labels = [freq_label(f) for f in found]
    if len(set(labels)) < len(labels):
        raise ValueError(f"frequencies with equal labels: {labels}")
    return found


def interval_end(ts: Column, width: Column) -> Column:
    """The end of the interval of ts. The quotient is a double on purpose: near a boundary the last bits decide."""
    return F.ceil(ts.cast("double") / width.cast("double")).cast("long") * width


def session_open(ts: Column) -> Column:
    """Nanoseconds of 09:30 New York time on the UTC date of ts, whatever the session's time zone. Days are counted in whole numbers: a double has no room for single nanoseconds."""
    days = F.call_function("div", ts - F.pmod(ts, F.lit(DAY_NS)), F.lit(DAY_NS))
    day = F.date_from_unix_date(days.cast("int")).cast("timestamp_ntz")
    utc = F.convert_timezone(F.lit("America/New_York"), F.lit("UTC"), day)
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), utc) * F.lit(1000) + F.lit(OPEN_NS)


def in_session(ts: Column, opened: Column) -> Column:
    return ts.between(opened, opened + F.lit(SESSION_NS))


def as_double_and_back(ts: Column) -> Column:
    """The nearest double of a timestamp, as a long: multiples of 256 ns at present."""
    return ts.cast("double").cast("long")

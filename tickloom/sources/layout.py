"""Where files are: `{root}/{kind}/...` by feed, year, month and date, and which dates a run covers."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.intervals import freq_label

FEEDS = ("quotes_v1", "trades_v1")


@dataclass(frozen=True)
class Layout:
    """Flat files, converted Parquet and snapshots under one root, each of which may be moved by itself."""

    root: str
    product: str = "us_stocks_sip"
    flat: str | None = None
    parquet: str | None = None
    snapshots: str | None = None

    def flat_root(self) -> str:
        return self.flat or f"{self.root}/flatfiles"

    def parquet_root(self) -> str:
        return self.parquet or f"{self.root}/parquet"

    def snapshot_root(self) -> str:
        return self.snapshots or f"{self.root}/snapshots"

    def flat_file(self, feed: str, date: str) -> str:
        return f"{self.flat_root()}/{self.product}/{feed}/{date[:4]}/{date[5:7]}/{date}.csv.gz"

    def parquet_dir(self, feed: str, date: str) -> str:
        return f"{self.parquet_root()}/{self.product}/{feed}/{date[:4]}/{date[5:7]}/{date}.parquet"

    def snapshot_dir(self, freq_hz: float, date: str) -> str:
        return f"{self.snapshot_root()}/{freq_label(freq_hz)}/{date[:4]}/{date[5:7]}/{date}.parquet"


def weekdays(start: str, end: str | None = None) -> list[str]:
    """Monday to Friday from start to end, both included; without an end up to today. Holidays are not known."""
    a, b = dt.date.fromisoformat(start), dt.date.fromisoformat(end) if end else dt.date.today()
    return [d.isoformat() for d in (a + dt.timedelta(k) for k in range((b - a).days + 1)) if d.weekday() < 5]


def parse_dates(dates: str | None = None, start: str | None = None, end: str | None = None) -> list[str]:
    """The days of a run: those of a comma list, each once and in order, or the weekdays of a range."""
    if not dates:
        if not start:
            raise ValueError("give dates or a start")
        return weekdays(start, end)
    days = {dt.datetime.strptime(part, "%Y-%m-%d").date() for part in dates.replace(",", " ").split()}
    return [day.isoformat() for day in sorted(days)]


def business_dates(df: DataFrame, first: str, last: str) -> DataFrame:
    """date: the weekdays between two date columns of each row."""
    days = df.select(F.explode(F.sequence(F.to_date(first), F.to_date(last))).alias("d"))
    return days.where(F.weekday("d") < 5).select(F.date_format("d", "yyyy-MM-dd").alias("date"))

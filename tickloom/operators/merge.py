"""Quote and trade intervals of a ticker in one sparse, forward-filled series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.intervals import as_double_and_back

from .quotes import KEY, VALUES

FILLED = ["sip_timestamp_quote", *VALUES, "open", "high", "low", "close", "sip_timestamp_trade", "vwap_all", "vwap", "vwap_ol"]
#: The columns of a snapshot, in their order.
COLUMNS = ["ticker", "ts_interval", "sip_timestamp_quote", "ask_price", "ask_size", "bid_price", "bid_size", "open", "high", "low", "close", "volume", "n", "sip_timestamp_trade", "vwap_all", "vwap", "vwap_ol"]
UNIT = ["freq", "date", "partition"]


def union_sides(quotes: DataFrame, trades: DataFrame) -> DataFrame:
    """The full outer join of two tables that have a KEY once at most, as a union and a grouping: no second join shuffle."""
    both = quotes.unionByName(trades, allowMissingColumns=True)
    return both.groupBy(*KEY).agg(*(F.max(c).alias(c) for c in both.columns if c not in KEY))


def fill_forward(merged: DataFrame) -> DataFrame:
    """Flags of units that lack a side somewhere, then the last known value of each column of a ticker.

    Both windows stand on one exchange by unit: a unit's tickers are together, and each ticker is ordered in time.
    """
    unit = Window.partitionBy(*UNIT)
    ticker = Window.partitionBy(*UNIT, "ticker").orderBy("ts_interval").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    flagged = merged.withColumns({f"lacks_{s}": F.max(F.col(f"sip_timestamp_{s}").isNull()).over(unit) for s in ("quote", "trade")})
    return flagged.withColumns({c: F.last(c, ignorenulls=True).over(ticker) for c in FILLED})


def finish(filled: DataFrame) -> DataFrame:
    """Rows from a ticker's first quote and first trade on; volume and n are 0 where there is no trade (a volume that is missing in spite of one stays missing); timestamps lose what a double cannot hold where their unit lacks a side."""
    started = filled.where(F.col("sip_timestamp_quote").isNotNull() & F.col("sip_timestamp_trade").isNotNull())
    rounded = {f"sip_timestamp_{s}": F.when(F.col(f"lacks_{s}"), as_double_and_back(F.col(f"sip_timestamp_{s}"))).otherwise(F.col(f"sip_timestamp_{s}")) for s in ("quote", "trade")}
    return started.withColumns(rounded | {c: F.when(F.col("n").isNull(), F.lit(0.0)).otherwise(F.col(c)) for c in ("volume", "n")}).select(*UNIT, *COLUMNS)

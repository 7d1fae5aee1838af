"""Quotes: the last known value of each column in each interval."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.intervals import interval_end
from tickloom.functions.numbers import as_double, as_long

VALUES = ["ask_price", "ask_size", "bid_price", "bid_size"]
KEY = ["freq", "date", "partition", "ticker", "ts_interval"]
LOT = 100


def order() -> Column:
    """The order of ticks of a ticker: time, sequence number, then place in the file."""
    return F.struct("sip_timestamp", "sequence_number", "row_id")


def prepare_quotes(quotes: DataFrame) -> DataFrame:
    """Typed columns, sizes in shares, rows with a ticker."""
    values = [as_double(quotes, c) for c in VALUES]
    lots = {c: F.col(c) * F.lit(float(LOT)) for c in ("ask_size", "bid_size")}
    typed = quotes.select("date", "partition", "ticker", as_long(quotes, "sip_timestamp"), as_long(quotes, "sequence_number"), "row_id", *values)
    return typed.withColumns(lots).where(F.col("ticker").isNotNull())


def aggregate_quotes(prepared: DataFrame) -> DataFrame:
    """prepared has freq and width: one row for each KEY with the last value that is not missing, column by column."""
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), order())).alias(c) for c in VALUES]
    return prepared.withColumn("ts_interval", interval_end(F.col("sip_timestamp"), F.col("width"))).groupBy(*KEY).agg(F.max("sip_timestamp").alias("sip_timestamp_quote"), *last)

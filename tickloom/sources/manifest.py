"""Units of work, what is left to do, and which unit can be processed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.rules import TradeRules, codes_are_valid
from tickloom.operators.trades import effective_trades


def ticker_bucket(ticker: Column, n: int) -> Column:
    """The partition of a ticker where no mapping table gives one."""
    return F.pmod(F.xxhash64(ticker), F.lit(n)).cast("int")


def with_partition(ticks: DataFrame, n: int, mapping: DataFrame | None = None) -> DataFrame:
    """ticks with `partition`: from mapping (ticker, partition) where it has the ticker, else by hash."""
    if mapping is None:
        return ticks.withColumn("partition", ticker_bucket(F.col("ticker"), n))
    given = mapping.select(F.col("ticker").alias("_t"), F.col("partition").cast("int").alias("_p"))
    joined = ticks.join(given, F.col("ticker").eqNullSafe(F.col("_t")), "left")
    return joined.withColumn("partition", F.coalesce("_p", ticker_bucket(F.col("ticker"), n))).drop("_t", "_p")


def pending_units(wanted: DataFrame, done: DataFrame, overwrite: bool = False) -> DataFrame:
    """The units that are wanted and not done."""
    return wanted if overwrite else wanted.join(done.select(*wanted.columns), wanted.columns, "left_anti")


def unit_status(quotes: DataFrame, trades: DataFrame, rules: TradeRules) -> DataFrame:
    """date, partition, counts and status of each unit: `ok`, or why it cannot be processed while others go on."""
    unit = ["date", "partition"]
    bad = F.coalesce(F.sum((~codes_are_valid(F.col("conditions"))).cast("int")), F.lit(0))
    t = trades.groupBy(*unit).agg(F.count("*").alias("n_trades"), bad.alias("n_bad"))
    clean = trades.where(codes_are_valid(F.col("conditions")))
    effective = effective_trades(clean, rules).groupBy(*unit).agg(F.count("*").alias("n_effective"), F.count("ticker").alias("n_named"))
    joined = quotes.groupBy(*unit).agg(F.count("*").alias("n_quotes")).join(t, unit, "full").join(effective, unit, "left")
    joined = joined.fillna(0, ["n_quotes", "n_trades", "n_bad", "n_effective", "n_named"])
    status = F.when(F.col("n_quotes") == 0, "no quotes").when(F.col("n_trades") == 0, "no trades").when(F.col("n_bad") > 0, "bad conditions").when(F.col("n_effective") == 0, "no effective trades").when(F.col("n_named") == 0, "no named trades").otherwise("ok")
    return joined.select(*unit, "n_quotes", "n_trades", "n_effective", status.alias("status"))

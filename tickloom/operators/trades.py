"""Trades: who may update what, and the aggregates of each interval."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.intervals import in_session, interval_end, session_open
from tickloom.functions.numbers import as_double, as_long, kahan, missing, ratio
from tickloom.functions.rules import TradeRules, eligibility

from .quotes import KEY, order

ODD_LOT = 100
SUMS = ["volume", "dollars_all", "weight", "dollars", "weight_odd", "dollars_odd"]


def effective_trades(trades: DataFrame, rules: TradeRules) -> DataFrame:
    """Typed trades that may update any aggregate, with flags high_low, open_close, volume_ok and form_t."""
    typed = trades.select("date", "partition", "ticker", eligibility(F.col("conditions"), rules).alias("f"), as_double(trades, "price"), as_double(trades, "size"), as_long(trades, "sip_timestamp"), as_long(trades, "sequence_number"), "row_id")
    sized = F.coalesce(F.col("size") >= 1, F.lit(False))
    flagged = typed.select("*", (F.col("f.high_low") & sized).alias("high_low"), (F.col("f.open_close") & sized).alias("open_close"), F.col("f.volume").alias("volume_ok"), F.col("f.form_t").alias("form_t")).drop("f")
    return flagged.where("high_low or open_close or volume_ok")


def unit_sessions(effective: DataFrame) -> DataFrame:
    """date, partition, opened: the session of the first effective trade in file order, be its ticker null or not."""
    first = effective.groupBy("date", "partition").agg(F.min_by("sip_timestamp", "row_id").alias("first_ts"))
    return first.select("date", "partition", session_open(F.col("first_ts")).alias("opened"))


def without_session_form_t(effective: DataFrame) -> DataFrame:
    """A Form T trade in the regular session no longer counts for volume; it stays a trade.

    The sessions are broadcast: one row of three numbers for each date and partition, whatever the number of trades.
    """
    joined = effective.join(F.broadcast(unit_sessions(effective)), ["date", "partition"])
    return joined.withColumn("volume_ok", F.col("volume_ok") & ~(F.col("form_t") & in_session(F.col("sip_timestamp"), F.col("opened")))).drop("opened")


def trade_terms(trades: DataFrame) -> DataFrame:
    """Prices by eligibility and the six summands of each trade; rows with a ticker."""
    price_in = lambda flag: F.when(F.col(flag), F.col("price"))
    priced = trades.withColumns({"open": price_in("open_close"), "high": price_in("high_low"), "low": price_in("high_low"), "close": price_in("open_close"), "volume": missing(F.col("size") * F.col("volume_ok").cast("double"))})
    names = ["open", "high", "low", "close"]
    total, count = F.lit(0.0), F.lit(0.0)
    for c in names:
        total, count = total + F.coalesce(F.col(c), F.lit(0.0)), count + F.col(c).isNotNull().cast("double")
    priced = priced.withColumn("mean", missing(F.when(count > 0, F.try_divide(total, count))))
    odd = F.coalesce(F.col("volume") < ODD_LOT, F.lit(False)).cast("double")
    traded = F.when(F.col("volume") != 0, F.col("volume"))
    terms = {"dollars_all": F.col("price") * F.col("volume"), "weight": F.col("mean").isNotNull().cast("double") * traded, "dollars": F.col("mean") * traded, "weight_odd": odd * traded, "dollars_odd": F.col("price") * odd * traded}
    return priced.withColumns({k: missing(v) for k, v in terms.items()}).withColumn("n", F.col("volume").isNotNull().cast("long")).where(F.col("ticker").isNotNull())


def prepare_trades(trades: DataFrame, rules: TradeRules) -> DataFrame:
    """Trades with their terms. Deal them out by date, partition and ticker (`by_ticker`) before they are multiplied by frequencies."""
    return trade_terms(without_session_form_t(effective_trades(trades, rules)))


def by_ticker(prepared: DataFrame) -> DataFrame:
    """One exchange that serves the groupings of all frequencies, as their keys contain its own: each trade travels once, not once for every frequency."""
    return prepared.repartition("date", "partition", "ticker")


def aggregate_trades(prepared: DataFrame) -> DataFrame:
    """One row for each KEY: first and last, extremes, count, and sums in trade order with Kahan's compensation.

    A zero extreme takes the sign of the first zero in trade order, which max and min alone do not promise.
    """
    at, rows = order(), prepared.withColumn("ts_interval", interval_end(F.col("sip_timestamp"), F.col("width")))
    pick = lambda f, c, when: f(c, F.when(when, at))
    found = rows.groupBy(*KEY).agg(
        pick(F.min_by, "open", F.col("open").isNotNull()).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), pick(F.max_by, "close", F.col("close").isNotNull()).alias("close"),
        pick(F.min_by, "high", F.col("high") == 0).alias("zero"), F.sum("n").alias("n"), F.max("sip_timestamp").alias("sip_timestamp_trade"),
        F.array_sort(F.collect_list(F.struct("sip_timestamp", "sequence_number", "row_id", *SUMS))).alias("terms"),
    )
    sums = found.select(*KEY, "open", F.when(F.col("high") == 0, F.col("zero")).otherwise(F.col("high")).alias("high"), F.when(F.col("low") == 0, F.col("zero")).otherwise(F.col("low")).alias("low"), "close", "n", "sip_timestamp_trade", *(kahan(F.col("terms"), s).alias(s) for s in SUMS))
    vwap = {"vwap_all": ("dollars_all", "volume"), "vwap": ("dollars", "weight"), "vwap_ol": ("dollars_odd", "weight_odd")}
    return sums.select(*KEY, "open", "high", "low", "close", missing(F.col("volume")).alias("volume"), F.col("n").cast("double").alias("n"), "sip_timestamp_trade", *(ratio(F.col(a), F.col(b)).alias(k) for k, (a, b) in vwap.items()))

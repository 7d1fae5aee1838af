"""Snapshots of any number of frequencies from one preparation of the ticks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.intervals import freq_label, width_ns
from tickloom.functions.rules import TradeRules, trade_rules
from tickloom.operators.merge import fill_forward, finish, union_sides
from tickloom.operators.quotes import aggregate_quotes, prepare_quotes
from tickloom.operators.trades import aggregate_trades, by_ticker, prepare_trades


def at_frequencies(prepared: DataFrame, freqs: Iterable[float]) -> DataFrame:
    """Each row once for every frequency, with its label and interval length."""
    each = F.array(*(F.struct(F.lit(freq_label(f)).alias("freq"), F.lit(width_ns(f)).cast("long").alias("width")) for f in freqs))
    return prepared.select("*", F.explode(each).alias("_f")).select("*", "_f.freq", "_f.width").drop("_f")


def build_snapshots(quotes: DataFrame, trades: DataFrame, freqs: Iterable[float], rules: TradeRules | None = None) -> DataFrame:
    """freq, date, partition and the 17 snapshot columns.

    quotes and trades have date, partition and row_id (the place in the file) beside their own columns. All semantics are
    local to (date, partition). Frequencies share the scan, the preparation and the exchange of trades; quotes are aggregated before
    they are exchanged.
    """
    rules, freqs = rules or trade_rules(), list(freqs)
    q = aggregate_quotes(at_frequencies(prepare_quotes(quotes), freqs))
    t = aggregate_trades(at_frequencies(by_ticker(prepare_trades(trades, rules)), freqs))
    return finish(fill_forward(union_sides(q, t)))

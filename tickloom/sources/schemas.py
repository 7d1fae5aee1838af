"""Columns of the flat-file feeds: declared, never inferred; a header only says in which order they stand."""

from __future__ import annotations

from pyspark.sql import types as T

LONG, DOUBLE, STRING = T.LongType(), T.DoubleType(), T.StringType()

#: The columns of each feed and their types (sizes of trades may be fractions of a share).
FEED_COLUMNS = {
    "quotes_v1": {
        "ticker": STRING, "ask_exchange": LONG, "ask_price": DOUBLE, "ask_size": LONG, "bid_exchange": LONG, "bid_price": DOUBLE, "bid_size": LONG,
        "conditions": STRING, "indicators": STRING, "participant_timestamp": LONG, "sequence_number": LONG, "sip_timestamp": LONG, "tape": LONG, "trf_timestamp": LONG,
    },
    "trades_v1": {
        "ticker": STRING, "conditions": STRING, "correction": LONG, "exchange": LONG, "id": LONG, "participant_timestamp": LONG, "price": DOUBLE,
        "sequence_number": LONG, "sip_timestamp": LONG, "size": DOUBLE, "tape": LONG, "trf_id": LONG, "trf_timestamp": LONG,
    },
}
#: Columns that conversion leaves out.
DROPPED = {"participant_timestamp", "tape", "trf_timestamp", "trf_id", "correction", "id"}


def kept(feed: str) -> list[str]:
    return [c for c in FEED_COLUMNS[feed] if c not in DROPPED]

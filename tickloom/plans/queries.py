"""The driver's queries over the events table, and the same in SQL.

Trades are the events signup, purchase and error; quotes are view and click. A ticker is `U` and the last digit of the user,
a unit is a UTC date and that digit modulo 4, and a size comes from the number in `props`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.intervals import in_session, interval_end, session_open, width_ns
from tickloom.functions.numbers import kahan
from tickloom.functions.rules import FORM_T, STOCK_OPTION, eligibility, trade_rules
from tickloom.operators import merge, quotes, trades
from tickloom.sources.layout import business_dates
from tickloom.sources.manifest import pending_units, ticker_bucket, unit_status

from .snapshot import at_frequencies, build_snapshots

#: Condition lists dealt to trades by event_id modulo 16.
CONDITIONS = [None, "1", "12", "12,37", "14,41", "37", "4,12,37", "15", "16", "2", "35", "38", "41", "52,53", "9", "12,41"]
HOUR, TEN_MINUTES = 1 / 3600, 1 / 600


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/events.parquet")
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts").cast("timestamp_ntz"))
    digit = F.col("user_id") % 10
    return rows.select("event_id", "event_type", "value", F.concat(F.lit("U"), digit.cast("string")).alias("ticker"), (digit % 4).cast("int").alias("partition"), (micros * 1000).alias("sip_timestamp"), F.date_format(F.col("ts").cast("date"), "yyyy-MM-dd").alias("date"), F.get_json_object("props", "$.k").cast("long").alias("k"))


def trade_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = F.get(F.array(*map(F.lit, CONDITIONS)), (F.col("event_id") % len(CONDITIONS)).cast("int"))
    rows = events(spark, sf_dir).where(F.col("event_type").isin("signup", "purchase", "error"))
    return rows.select("date", "partition", "ticker", codes.alias("conditions"), F.col("value").alias("price"), (F.col("k") * 5).cast("double").alias("size"), "sip_timestamp", F.col("event_id").alias("sequence_number"), F.col("event_id").alias("row_id"))


def quote_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).where(F.col("event_type").isin("view", "click"))
    return rows.select("date", "partition", "ticker", F.col("value").alias("ask_price"), F.col("k").alias("ask_size"), (F.col("value") * 0.5).alias("bid_price"), (F.col("k") % 7).alias("bid_size"), "sip_timestamp", F.col("event_id").alias("sequence_number"), F.col("event_id").alias("row_id"))


RULES = trade_rules()


def effective(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trades.effective_trades(trade_ticks(spark, sf_dir), RULES)


def hourly_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trades.aggregate_trades(at_frequencies(trades.prepare_trades(trade_ticks(spark, sf_dir), RULES), [HOUR]))


def hourly_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.aggregate_quotes(at_frequencies(quotes.prepare_quotes(quote_ticks(spark, sf_dir)), [HOUR]))


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.union_sides(hourly_quotes(spark, sf_dir), hourly_trades(spark, sf_dir))


def interval_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("event_id", *(interval_end(F.col("sip_timestamp"), F.lit(width_ns(f))).alias(n) for n, f in (("hour_end", HOUR), ("ten_minute_end", TEN_MINUTES), ("third_hz_end", 3.0))))


def condition_eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trade_ticks(spark, sf_dir).select(F.col("row_id").alias("event_id"), eligibility(F.col("conditions"), RULES).alias("f")).select("event_id", "f.*")


def effective_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return effective(spark, sf_dir).select(F.col("row_id").alias("event_id"), "high_low", "open_close", "volume_ok", "form_t")


def form_t_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trades.without_session_form_t(effective(spark, sf_dir)).select(F.col("row_id").alias("event_id"), "volume_ok")


def unit_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trades.unit_sessions(effective(spark, sf_dir))


def trade_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = trades.prepare_trades(trade_ticks(spark, sf_dir), RULES)
    return rows.select(F.col("row_id").alias("event_id"), "open", "high", "volume", "mean", "n", *trades.SUMS[1:])


def trade_ohlc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_trades(spark, sf_dir).select("date", "ticker", "ts_interval", "open", "high", "low", "close")


def trade_volume_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_trades(spark, sf_dir).select("date", "ticker", "ts_interval", "n", "sip_timestamp_trade")


def kahan_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compensated sums of value in time order, for each ticker and day."""
    lists = events(spark, sf_dir).groupBy("date", "ticker").agg(F.array_sort(F.collect_list(F.struct("sip_timestamp", "event_id", "value"))).alias("all"))
    return lists.select("date", "ticker", kahan(F.col("all"), "value").alias("total"))


def vwap(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: hourly_trades(spark, sf_dir).select("date", "ticker", "ts_interval", name)


def quote_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_quotes(spark, sf_dir).drop("freq", "partition")


def quote_trade_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merged(spark, sf_dir).select("date", "ticker", "ts_interval", F.col("sip_timestamp_quote").isNotNull().alias("has_quote"), F.col("sip_timestamp_trade").isNotNull().alias("has_trade"))


def forward_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timestamps before a side's first tick show as -1."""
    times = [f"sip_timestamp_{s}" for s in ("quote", "trade")]
    rows = merge.fill_forward(merged(spark, sf_dir)).withColumns({c: F.coalesce(c, F.lit(-1)) for c in times})
    return rows.select("date", "ticker", "ts_interval", *merge.FILLED)


def start_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_snapshots(quote_ticks(spark, sf_dir), trade_ticks(spark, sf_dir), [HOUR]).groupBy("date", "ticker").agg(F.min("ts_interval").alias("first_interval"), F.count("*").alias("intervals"))


def timestamp_rounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_snapshots(quote_ticks(spark, sf_dir), trade_ticks(spark, sf_dir), [HOUR]).select("date", "ticker", "ts_interval", "sip_timestamp_quote", "sip_timestamp_trade")


def snapshot_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_snapshots(quote_ticks(spark, sf_dir), trade_ticks(spark, sf_dir), [HOUR]).drop("freq")


def snapshot_multi_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_snapshots(quote_ticks(spark, sf_dir), trade_ticks(spark, sf_dir), [HOUR, TEN_MINUTES])


def pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units of quotes that have no output yet, where the units of even days have."""
    units = quote_ticks(spark, sf_dir).select("date", "partition").distinct()
    return pending_units(units, units.where(F.dayofmonth(F.to_date("date")) % 2 == 0))


def status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unit_status(quote_ticks(spark, sf_dir), trade_ticks(spark, sf_dir), RULES)


def dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = events(spark, sf_dir).agg(F.min("date").alias("a"), F.max("date").alias("b"))
    return business_dates(span, "a", "b")


def partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trade_ticks(spark, sf_dir).groupBy("date", "partition").agg(F.count("*").alias("n_rows"))


def bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("ticker").distinct().select("ticker", ticker_bucket(F.col("ticker"), 100).alias("bucket"))


def session_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    opened = session_open(F.col("sip_timestamp"))
    return events(spark, sf_dir).select("event_id", opened.alias("opened"), in_session(F.col("sip_timestamp"), opened).alias("inside"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (interval_assign, condition_eligibility, effective_trades, form_t_session, unit_sessions, trade_terms, trade_ohlc, trade_volume_n, kahan_volume, quote_last, quote_trade_union, forward_fill, start_filter, timestamp_rounding, snapshot_1h, snapshot_multi_freq, partition_counts, session_bounds)
    return {f.__name__: f for f in found} | {"vwap_all": vwap("vwap_all"), "vwap_price": vwap("vwap"), "vwap_odd_lot": vwap("vwap_ol"), "pending_units": pending, "unit_status": status, "business_dates": dates, "ticker_bucket": bucket}


def in_set(codes: tuple[int, ...]) -> str:
    return f"len(list_filter(codes, lambda c: c NOT IN ({', '.join(map(str, sorted(codes)))}))) = 0"


def cte(freqs: list[float]) -> str:
    """The steps of the plan in SQL, each by the name of what it has."""
    listed = ", ".join("NULL" if c is None else f"'{c}'" for c in CONDITIONS)
    rates = ", ".join(f"('{f:g}Hz', CAST({width_ns(f)} AS BIGINT))" for f in freqs)
    total = lambda name: f"coalesce(kahan_sum({name} ORDER BY ts, event_id), 0.0)"
    ratio = lambda a, b: f"CASE WHEN {total(b)} = 0 THEN CASE WHEN {total(a)} > 0 THEN CAST('inf' AS DOUBLE) WHEN {total(a)} < 0 THEN CAST('-inf' AS DOUBLE) END ELSE {total(a)} / {total(b)} END"
    fills = ", ".join(f"last_value({c} IGNORE NULLS) OVER w AS {c}" for c in merge.FILLED)
    return f"""
WITH e AS (SELECT event_id, event_type, value, 'U' || CAST(user_id % 10 AS VARCHAR) AS ticker, CAST(user_id % 10 % 4 AS INTEGER) AS partition, epoch_us(ts) * 1000 AS ts,
                  strftime(ts, '%Y-%m-%d') AS date, CAST(props->>'$.k' AS BIGINT) AS k FROM events),
tr AS (SELECT *, value AS price, CAST(k * 5 AS DOUBLE) AS size, [{listed}][event_id % {len(CONDITIONS)} + 1] AS conditions FROM e WHERE event_type IN ('signup', 'purchase', 'error')),
qu AS (SELECT *, value AS ask_price, k * 100.0 AS ask_size, value * 0.5 AS bid_price, (k % 7) * 100.0 AS bid_size FROM e WHERE event_type IN ('view', 'click')),
co AS (SELECT *, list_transform(string_split(coalesce(conditions, '1'), ','), lambda x: CAST(x AS INTEGER)) AS codes FROM tr),
fl AS (SELECT *, {in_set(RULES.high_low)} AND NOT list_contains(codes, {STOCK_OPTION}) AS hl, {in_set(RULES.open_close)} AND NOT list_contains(codes, {STOCK_OPTION}) AS oc, {in_set(RULES.volume)} AS vo, list_contains(codes, {FORM_T}) AS form_t FROM co),
ef AS (SELECT * REPLACE (hl AND size >= 1 AS hl, oc AND size >= 1 AS oc) FROM fl WHERE (hl OR oc) AND size >= 1 OR vo),
un AS (SELECT date, partition, epoch_us(((make_timestamp(arg_min(ts, event_id) // 86400000000000 * 86400000000)) AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC') * 1000 + 34200000000000 AS opened FROM ef GROUP BY ALL),
ft AS (SELECT ef.* REPLACE (vo AND NOT (form_t AND ts BETWEEN opened AND opened + 23400000000000) AS vo) FROM ef JOIN un USING (date, partition)),
pr AS (SELECT *, CASE WHEN oc THEN price END AS o, CASE WHEN hl THEN price END AS h, size * CAST(vo AS DOUBLE) AS volume FROM ft),
me AS (SELECT *, CASE WHEN oc OR hl THEN (((coalesce(o, 0.0) + coalesce(h, 0.0)) + coalesce(h, 0.0)) + coalesce(o, 0.0)) / (2 * CAST(oc AS DOUBLE) + 2 * CAST(hl AS DOUBLE)) END AS mean, nullif(volume, 0) AS traded FROM pr),
te AS (SELECT *, price * volume AS dollars_all, CAST(mean IS NOT NULL AS DOUBLE) * traded AS weight, mean * traded AS dollars, CAST(volume < 100 AS DOUBLE) * traded AS weight_odd, price * CAST(volume < 100 AS DOUBLE) * traded AS dollars_odd FROM me),
fr(freq, width) AS (VALUES {rates}),
ta AS (SELECT freq, date, partition, ticker, CAST(ceil(CAST(ts AS DOUBLE) / width) AS BIGINT) * width AS ts_interval, arg_min(o, ts) AS open, max(h) AS high, min(h) AS low, arg_max(o, ts) AS close,
              {total('volume')} AS volume, CAST(count(volume) AS DOUBLE) AS n, max(ts) AS sip_timestamp_trade, {ratio('dollars_all', 'volume')} AS vwap_all, {ratio('dollars', 'weight')} AS vwap, {ratio('dollars_odd', 'weight_odd')} AS vwap_ol FROM te, fr GROUP BY ALL),
qa AS (SELECT freq, date, partition, ticker, CAST(ceil(CAST(ts AS DOUBLE) / width) AS BIGINT) * width AS ts_interval, max(ts) AS sip_timestamp_quote, {', '.join(f'arg_max({c}, ts) AS {c}' for c in quotes.VALUES)} FROM qu, fr GROUP BY ALL),
jo AS (SELECT * FROM qa FULL JOIN ta USING (freq, date, partition, ticker, ts_interval)),
un2 AS (SELECT *, bool_or(sip_timestamp_quote IS NULL) OVER u AS lacks_quote, bool_or(sip_timestamp_trade IS NULL) OVER u AS lacks_trade FROM jo WINDOW u AS (PARTITION BY freq, date, partition)),
fi AS (SELECT freq, date, partition, ticker, ts_interval, lacks_quote, lacks_trade, volume, n, {fills} FROM un2 WINDOW w AS (PARTITION BY freq, date, partition, ticker ORDER BY ts_interval ROWS UNBOUNDED PRECEDING)),
sn AS (SELECT * REPLACE (CASE WHEN lacks_quote THEN CAST(CAST(sip_timestamp_quote AS DOUBLE) AS BIGINT) ELSE sip_timestamp_quote END AS sip_timestamp_quote,
                         CASE WHEN lacks_trade THEN CAST(CAST(sip_timestamp_trade AS DOUBLE) AS BIGINT) ELSE sip_timestamp_trade END AS sip_timestamp_trade, CASE WHEN n IS NULL THEN 0.0 ELSE volume END AS volume, coalesce(n, 0.0) AS n)
       FROM fi WHERE sip_timestamp_quote IS NOT NULL AND sip_timestamp_trade IS NOT NULL)
"""


def oracle_sql() -> dict[str, str]:
    hour, both = cte([HOUR]), cte([HOUR, TEN_MINUTES])
    end = lambda f: f"CAST(ceil(CAST(ts AS DOUBLE) / {width_ns(f)}) AS BIGINT) * {width_ns(f)}"
    series = "date, ticker, ts_interval"
    columns = ", ".join(merge.COLUMNS)
    opened = "epoch_us(((make_timestamp(ts // 86400000000000 * 86400000000)) AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC') * 1000 + 34200000000000"
    return {
        "interval_assign": f"{hour} SELECT event_id, {end(HOUR)} AS hour_end, {end(TEN_MINUTES)} AS ten_minute_end, {end(3.0)} AS third_hz_end FROM e",
        "condition_eligibility": f"{hour} SELECT event_id, hl AS high_low, oc AS open_close, vo AS volume, form_t FROM fl",
        "effective_trades": f"{hour} SELECT event_id, hl AS high_low, oc AS open_close, vo AS volume_ok, form_t FROM ef",
        "form_t_session": f"{hour} SELECT event_id, vo AS volume_ok FROM ft",
        "unit_sessions": f"{hour} SELECT date, partition, opened FROM un",
        "trade_terms": f"{hour} SELECT event_id, o AS open, h AS high, volume, mean, CAST(volume IS NOT NULL AS BIGINT) AS n, dollars_all, weight, dollars, weight_odd, dollars_odd FROM te",
        "trade_ohlc": f"{hour} SELECT {series}, open, high, low, close FROM ta",
        "trade_volume_n": f"{hour} SELECT {series}, n, sip_timestamp_trade FROM ta",
        "kahan_volume": f"{hour} SELECT date, ticker, kahan_sum(value ORDER BY ts, event_id) AS total FROM e GROUP BY ALL",
        "vwap_all": f"{hour} SELECT {series}, vwap_all FROM ta",
        "vwap_price": f"{hour} SELECT {series}, vwap FROM ta",
        "vwap_odd_lot": f"{hour} SELECT {series}, vwap_ol FROM ta",
        "quote_last": f"{hour} SELECT {series}, sip_timestamp_quote, ask_price, ask_size, bid_price, bid_size FROM qa",
        "quote_trade_union": f"{hour} SELECT {series}, sip_timestamp_quote IS NOT NULL AS has_quote, sip_timestamp_trade IS NOT NULL AS has_trade FROM jo",
        "forward_fill": f"{hour} SELECT {series}, {', '.join(f'coalesce({c}, -1) AS {c}' if c.startswith('sip') else c for c in merge.FILLED)} FROM fi",
        "start_filter": f"{hour} SELECT date, ticker, min(ts_interval) AS first_interval, count(*) AS intervals FROM sn GROUP BY ALL",
        "timestamp_rounding": f"{hour} SELECT {series}, sip_timestamp_quote, sip_timestamp_trade FROM sn",
        "snapshot_1h": f"{hour} SELECT date, partition, {columns} FROM sn",
        "snapshot_multi_freq": f"{both} SELECT freq, date, partition, {columns} FROM sn",
        "pending_units": f"{hour} SELECT DISTINCT date, partition FROM qu WHERE day(CAST(date AS DATE)) % 2 <> 0",
        "unit_status": f"{hour}, q AS (SELECT date, partition, count(*) AS n_quotes FROM qu GROUP BY ALL), t AS (SELECT date, partition, count(*) AS n_trades FROM tr GROUP BY ALL), f AS (SELECT date, partition, count(*) AS n_effective FROM ef GROUP BY ALL) SELECT date, partition, coalesce(n_quotes, 0) AS n_quotes, coalesce(n_trades, 0) AS n_trades, coalesce(n_effective, 0) AS n_effective, CASE WHEN n_quotes IS NULL THEN 'no quotes' WHEN n_trades IS NULL THEN 'no trades' WHEN n_effective IS NULL THEN 'no effective trades' ELSE 'ok' END AS status FROM q FULL JOIN t USING (date, partition) LEFT JOIN f USING (date, partition)",
        "business_dates": f"{hour} SELECT strftime(d, '%Y-%m-%d') AS date FROM (SELECT unnest(generate_series(min(CAST(date AS DATE))::TIMESTAMP, max(CAST(date AS DATE))::TIMESTAMP, INTERVAL 1 DAY)) AS d FROM e) WHERE isodow(d) < 6",
        "partition_counts": f"{hour} SELECT date, partition, count(*) AS n_rows FROM tr GROUP BY ALL",
        "session_bounds": f"{hour} SELECT event_id, {opened} AS opened, ts BETWEEN {opened} AND {opened} + 23400000000000 AS inside FROM e",
    }

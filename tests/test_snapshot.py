import math

import pytest
from pyspark.sql import functions as F

from tests.ticks import QUOTE_SQL, TRADE_SQL, ns, random_ticks, slow_snapshots
from tickloom.functions.intervals import freq_label, parse_frequencies, session_open, width_ns
from tickloom.functions.rules import trade_rules
from tickloom.operators.merge import COLUMNS
from tickloom.plans.snapshot import build_snapshots

RULES = trade_rules()


def exact(rows):
    show = lambda x: x if not isinstance(x, float) else (x.hex() if math.isfinite(x) else str(x))
    return sorted((tuple(map(show, r)) for r in rows), key=str)


def fast(spark, q, t, freqs, rules=RULES):
    built = build_snapshots(spark.createDataFrame(q, QUOTE_SQL), spark.createDataFrame(t, TRADE_SQL), freqs, rules)
    return {freq_label(f): [tuple(r)[1:] for r in built.where(f"freq = '{freq_label(f)}'").collect()] for f in freqs}


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_the_slow_method_bit_by_bit_at_several_frequencies(spark, seed):
    q, t = random_ticks(seed)
    found = fast(spark, q, t, [1.0, 0.125, 3.0])
    for f in (1.0, 0.125, 3.0):
        assert exact(found[freq_label(f)]) == exact(slow_snapshots(q, t, f, RULES))


def one(ticker="A", **more):
    return {"date": "2021-01-27", "partition": 0, "row_id": 0, "ticker": ticker, "sequence_number": 1} | more


def test_session_bounds_are_inclusive_and_form_t_stays_a_trade(spark):
    opened = ns("2021-01-27 09:30:00")
    times = [opened - 1, opened, opened + 23_400 * 10**9, opened + 23_400 * 10**9 + 1]
    t = [tuple(one(row_id=k, sip_timestamp=x, conditions="12", price=10.0, size=7.0)[c] for c in ("date", "partition", "row_id", "ticker", "sip_timestamp", "sequence_number", "conditions", "price", "size")) for k, x in enumerate(times)]
    q = [("2021-01-27", 0, 0, "A", opened - 10**12, 1, 10.0, 1, 9.0, 1)]
    rows = fast(spark, q, t, [1e9 / 10**9])["1Hz"]
    volume = {r[2 + COLUMNS.index("ts_interval")]: (r[2 + COLUMNS.index("volume")], r[2 + COLUMNS.index("n")]) for r in rows}
    # the bounds share their intervals with the neighbours just outside or stand alone
    assert sum(v for v, _ in volume.values()) == 14.0
    assert sum(n for _, n in volume.values()) == 4.0
    assert exact(rows) == exact(slow_snapshots(q, t, 1.0, RULES))


def test_session_date_is_that_of_the_first_trade_in_file_order_even_without_a_ticker(spark):
    late, early = ns("2021-01-27 19:30:00"), ns("2021-01-27 10:00:00")
    t = [("2021-01-27", 0, 0, None, late, 1, None, 5.0, 10.0), ("2021-01-27", 0, 1, "A", early, 1, "12", 10.0, 7.0)]
    q = [("2021-01-27", 0, 0, "A", early - 10**9, 1, 10.0, 1, 9.0, 1)]
    rows = fast(spark, q, t, [1.0])["1Hz"]
    assert [r[2 + COLUMNS.index("volume")] for r in rows] == [7.0]
    assert exact(rows) == exact(slow_snapshots(q, t, 1.0, RULES))


@pytest.mark.parametrize("before", [1, 128, 129])
def test_session_date_to_the_nanosecond(spark, before):
    """The first trade stands just before midnight UTC: the session is that of the day that ends."""
    midnight = ns("2021-01-28 00:00:00", "UTC")
    t = [("2021-01-27", 0, 0, "A", midnight - before, 1, None, 5.0, 10.0), ("2021-01-27", 0, 1, "A", ns("2021-01-27 10:00:00"), 2, "12", 10.0, 7.0), ("2021-01-27", 0, 2, "A", ns("2021-01-27 17:00:00"), 3, "12", 10.0, 8.0)]
    q = [("2021-01-27", 0, 0, "A", ns("2021-01-27 09:00:00"), 1, 10.0, 1, 9.0, 1)]
    rows = fast(spark, q, t, [1.0])["1Hz"]
    assert sorted(r[2 + COLUMNS.index("volume")] for r in rows) == [0.0, 8.0, 10.0]
    assert exact(rows) == exact(slow_snapshots(q, t, 1.0, RULES))
    opened = spark.createDataFrame([(midnight - before,), (midnight,), (-1,)], "ts long").select(session_open(F.col("ts")).alias("x")).collect()
    assert [r["x"] for r in opened] == [ns("2021-01-27 09:30:00"), ns("2021-01-28 09:30:00"), ns("1969-12-31 09:30:00")]


def test_a_volume_that_is_no_number_stays_missing(spark):
    """inf - inf: there are trades, so it is not 0."""
    at = ns("2021-01-27 10:00:00")
    t = [("2021-01-27", 0, k, "A", at + 1 + k, k, None, 5.0, x) for k, x in enumerate([float("inf"), float("-inf"), 3.0])] + [("2021-01-27", 0, 9, "A", at + 10**10, 9, None, 5.0, 2.0)]
    q = [("2021-01-27", 0, 0, "A", at + k * 10**9, k, 10.0, 1, 9.0, 1) for k in range(3)]
    rows = fast(spark, q, t, [1.0])["1Hz"]
    assert exact(rows) == exact(slow_snapshots(q, t, 1.0, RULES))
    found = [(r[2 + COLUMNS.index("volume")], r[2 + COLUMNS.index("n")]) for r in sorted(rows, key=lambda r: r[2 + COLUMNS.index("ts_interval")])]
    assert found[0] == (None, 3.0) and (0.0, 0.0) in found and found[-1] == (2.0, 1.0)


def test_trades_are_exchanged_once_for_all_frequencies(spark):
    q, t = random_ticks(6, quotes=5, trades=5)
    plans = [build_snapshots(spark.createDataFrame(q, QUOTE_SQL), spark.createDataFrame(t, TRADE_SQL), f)._jdf.queryExecution().executedPlan().toString() for f in ([1.0], [1.0, 0.5, 0.25])]
    assert plans[0].count("Exchange") == plans[1].count("Exchange") and "Exchange hashpartitioning(date" in plans[1]


def test_only_one_side_gives_no_rows(spark):
    q, t = random_ticks(3, partitions=1)
    only_a = [x for x in q if x[3] == "A"]
    only_na = [x for x in t if x[3] == "NA"]
    assert fast(spark, only_a, only_na, [1.0])["1Hz"] == []


def test_bad_conditions_are_an_error(spark):
    q, t = random_ticks(4, partitions=1, trades=5)
    t.append(("2021-01-27", 0, 99, "A", t[0][4], 1, "", 1.0, 1.0))
    with pytest.raises(Exception, match="not a condition code"):
        fast(spark, q, t, [1.0])


def test_frequencies():
    assert parse_frequencies("1, 0.125,1") == [1.0, 0.125]
    assert width_ns(3) == 333_333_333
    assert freq_label(0.125) == "0.125Hz"
    for bad in ("", "0", "-1", "1.0000001,1.00000011"):
        with pytest.raises(ValueError):
            parse_frequencies(bad)


def test_exchanges_of_the_plan(spark):
    """Both sides are aggregated, merged and filled with no join between them."""
    q, t = random_ticks(5, quotes=5, trades=5)
    built = build_snapshots(spark.createDataFrame(q, QUOTE_SQL), spark.createDataFrame(t, TRADE_SQL), [1.0])
    plan = built._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FullOuter") == 0 and "Python" not in plan
    assert plan.count("Exchange hashpartitioning") <= 6

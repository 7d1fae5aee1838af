"""Random ticks, and snapshots of them computed row by row."""

from __future__ import annotations

import datetime as dt
import math
import random
from zoneinfo import ZoneInfo

from tickloom.functions.rules import TradeRules
from tickloom.operators.merge import COLUMNS

QUOTE_COLUMNS = ["date", "partition", "row_id", "ticker", "sip_timestamp", "sequence_number", "ask_price", "ask_size", "bid_price", "bid_size"]
TRADE_COLUMNS = ["date", "partition", "row_id", "ticker", "sip_timestamp", "sequence_number", "conditions", "price", "size"]
QUOTE_SQL = "date string, partition int, row_id long, ticker string, sip_timestamp long, sequence_number long, ask_price double, ask_size long, bid_price double, bid_size long"
TRADE_SQL = "date string, partition int, row_id long, ticker string, sip_timestamp long, sequence_number long, conditions string, price double, size double"
CONDITIONS = [None, "1", "12", "12,37", "14,41", "37", "4,12,37", "15", "16", "2", "35", "38", "41", "52,53"]


def ns(text: str, zone: str = "America/New_York") -> int:
    return int(dt.datetime.fromisoformat(text).replace(tzinfo=ZoneInfo(zone)).timestamp()) * 10**9


def random_ticks(seed: int, date: str = "2021-01-27", partitions: int = 2, quotes: int = 300, trades: int = 250):
    r = random.Random(seed)
    start = ns(f"{date} 09:29:50")

    def when() -> int:
        t = start + r.randrange(30) * 10**9
        return t + r.choice([0, 1, -1, 127, -127, 128, -128, 257, -257, r.randrange(10**9)])

    tickers = [["A", "NA", None], ["NULL", "Z"]]
    q = [(date, p, k, r.choice(tickers[p % 2]), when(), r.randrange(50), r.choice([None, round(r.uniform(9, 11), 2)]) if r.random() < 0.1 else round(r.uniform(9, 11), 2), r.choice([None, 3, 10]), round(r.uniform(8, 9), 2), r.randrange(9)) for p in range(partitions) for k in range(quotes)]
    t = [(date, p, k, r.choice(tickers[p % 2]), when(), r.randrange(50), r.choice(CONDITIONS), r.choice([0.0, -0.0, None, math.inf]) if r.random() < 0.05 else round(r.uniform(9, 11), 2), r.choice([1.0, 100.0, 37.0, 0.14, 0.074081, 250.0, 5000.0, 0.0, 99.0, 1.5, None])) for p in range(partitions) for k in range(trades)]
    return q, t


def kahan(values):
    total = lost = 0.0
    for x in values:
        if x is None:
            continue
        y = x - lost
        new = total + y
        lost = (new - total) - y
        if lost != lost:
            lost = 0.0
        total = new
    return None if total != total else total


def clean(x):
    return None if x is None or x != x else x


def over(a, b):
    if a is None or b is None:
        return None
    if b == 0:
        return None if a == 0 else math.copysign(math.inf, a)
    return clean(a / b)


def slow_snapshots(quotes, trades, freq: float, rules: TradeRules):
    """The snapshot rows of each (date, partition), as the method is defined, one row at a time."""
    width, out = int(1e9 / freq), []
    for unit in sorted({(x[0], x[1]) for x in quotes} & {(x[0], x[1]) for x in trades}):
        q = [dict(zip(QUOTE_COLUMNS, x, strict=True)) for x in quotes if (x[0], x[1]) == unit]
        t = [dict(zip(TRADE_COLUMNS, x, strict=True)) for x in trades if (x[0], x[1]) == unit]
        live = []
        for x in sorted(t, key=lambda x: x["row_id"]):
            codes = {1} if x["conditions"] is None else {int(c) for c in x["conditions"].split(",")}
            sized = x["size"] is not None and x["size"] >= 1
            x["hl"] = codes <= set(rules.high_low) and 35 not in codes and sized
            x["oc"] = codes <= set(rules.open_close) and 35 not in codes and sized
            x["vo"], x["ft"] = codes <= set(rules.volume), 12 in codes
            if x["hl"] or x["oc"] or x["vo"]:
                live.append(x)
        day = dt.datetime.fromtimestamp(live[0]["sip_timestamp"] // 10**9, dt.timezone.utc).date()
        opened = ns(f"{day} 00:00:00") + 34_200 * 10**9
        cells: dict = {}
        at = lambda x: (x["ticker"], math.ceil(float(x["sip_timestamp"]) / width) * width)
        order = lambda x: (x["sip_timestamp"], x["sequence_number"], x["row_id"])
        for x in sorted((x for x in q if x["ticker"] is not None), key=order):
            cell = cells.setdefault(at(x), {})
            cell["sip_timestamp_quote"] = x["sip_timestamp"]
            for c in ("ask_price", "ask_size", "bid_price", "bid_size"):
                if x[c] is not None:
                    cell[c] = float(x[c]) * (100 if c.endswith("size") else 1)
        for x in sorted((x for x in live if x["ticker"] is not None), key=order):
            if x["vo"] and x["ft"] and opened <= x["sip_timestamp"] <= opened + 23_400 * 10**9:
                x["vo"] = False
            cells.setdefault(at(x), {}).setdefault("trades", []).append(x)
        for cell in cells.values():
            if "trades" not in cell:
                continue
            sums, n = [[] for _ in range(6)], 0
            for x in cell["trades"]:
                p = x["price"]
                o, h = (p if x["oc"] else None), (p if x["hl"] else None)
                if o is not None:
                    cell.setdefault("open", o)
                    cell["close"] = o
                if h is not None:
                    cell["high"] = h if "high" not in cell or h > cell["high"] else cell["high"]
                    cell["low"] = h if "low" not in cell or h < cell["low"] else cell["low"]
                v = None if x["size"] is None else x["size"] * float(x["vo"])
                n += v is not None
                count = 2 * (o is not None) + 2 * (h is not None)
                mean = clean((((0.0 + (o or 0.0)) + (h or 0.0)) + (h or 0.0) + (o or 0.0)) / count) if count else None
                traded = v or None
                odd = float(v is not None and v < 100)
                mul = lambda *f: None if None in f else clean(math.prod(f, start=1.0) if len(f) < 3 else (f[0] * f[1]) * f[2])
                for s, term in zip(sums, (v, mul(p, v), mul(float(mean is not None), traded), mul(mean, traded), mul(odd, traded), mul(p, odd, traded)), strict=True):
                    s.append(term)
            k = [kahan(s) for s in sums]
            cell |= {"volume": k[0], "n": float(n), "sip_timestamp_trade": cell["trades"][-1]["sip_timestamp"]}
            cell |= {name: x for name, x in (("vwap_all", over(k[1], k[0])), ("vwap", over(k[3], k[2])), ("vwap_ol", over(k[5], k[4]))) if x is not None}
        lacks = {s: any(f"sip_timestamp_{s}" not in c for c in cells.values()) for s in ("quote", "trade")}
        known: dict = {}
        for (ticker, end), cell in sorted(cells.items()):
            now = known.setdefault(ticker, {})
            now |= {c: x for c, x in cell.items() if c not in ("trades", "volume", "n") and x is not None}
            if "sip_timestamp_quote" in now and "sip_timestamp_trade" in now:
                row = now | {"ticker": ticker, "ts_interval": end, "volume": cell["volume"] if "n" in cell else 0.0, "n": cell.get("n", 0.0)}
                for s in lacks:
                    if lacks[s]:
                        row[f"sip_timestamp_{s}"] = int(float(row[f"sip_timestamp_{s}"]))
                out.append((*unit, *(row.get(c) for c in COLUMNS)))
    return out

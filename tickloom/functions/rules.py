"""Which trades may update which aggregate, by their condition codes."""

from __future__ import annotations

import json
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Condition codes whose trades may update high and low, open and close, and volume.
UPDATES_HIGH_LOW = [1, 3, 4, 5, 6, 8, 9, 10, 11, 14, 17, 18, 19, 22, 23, 24, 25, 27, 28, 30, 31, 32, 33, 34, 35, 36, 38, 55]
UPDATES_OPEN_CLOSE = [1, 3, 4, 6, 8, 9, 11, 14, 18, 19, 23, 24, 25, 27, 28, 30, 31, 34, 35, 36, 38, 55]
UPDATES_VOLUME = [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 17, 18, 19, 20, 21, 22, 23, 24, 25, 27, 28, 29, 30, 31, 32, 33, 34, 35, 36, 37, 52, 53, 55]
#: A regular sale, a late report of extended hours, a stock option trade, an exempt trade-through.
REGULAR, FORM_T, STOCK_OPTION, EXEMPT = 1, 12, 35, 41


#: The keys of a rule file, one for each aggregate.
FILE_KEYS = {"high_low": "updates_high_low", "open_close": "updates_open_close", "volume": "updates_volume"}
#: Codes that count for an aggregate beyond those that a rule file lists.
EXTENDED = {"high_low": (FORM_T, EXEMPT), "open_close": (FORM_T, EXEMPT), "volume": (EXEMPT,)}


class TradeRules(NamedTuple):
    """The sorted codes whose trades may update an aggregate."""

    high_low: tuple[int, ...]
    open_close: tuple[int, ...]
    volume: tuple[int, ...]


def trade_rules(path: str | None = None) -> TradeRules:
    """The packaged codes, or those of a JSON file, with what every set is extended by."""
    listed = {"high_low": UPDATES_HIGH_LOW, "open_close": UPDATES_OPEN_CLOSE, "volume": UPDATES_VOLUME}
    if path is not None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if lacking := sorted(set(FILE_KEYS.values()) - spec.keys()):
            raise ValueError(f"{path} lacks {', '.join(lacking)}")
        listed = {name: spec[key] for name, key in FILE_KEYS.items()}
    return TradeRules(**{name: tuple(sorted({*codes, *EXTENDED[name]})) for name, codes in listed.items()})


def eligibility(conditions: Column, rules: TradeRules) -> Column:
    """struct(high_low, open_close, volume, form_t): a trade updates an aggregate if all its codes may; a stock option trade gives no price."""
    codes = parse_codes(conditions)
    may = {name: F.size(F.array_except(codes, F.array(*map(F.lit, own)))) == 0 for name, own in rules._asdict().items()}
    option = F.array_contains(codes, STOCK_OPTION)
    return F.struct((may["high_low"] & ~option).alias("high_low"), (may["open_close"] & ~option).alias("open_close"), may["volume"].alias("volume"), F.array_contains(codes, FORM_T).alias("form_t"))


def parse_codes(conditions: Column) -> Column:
    """The codes of a comma list; null is a regular sale, anything that is no number an error."""
    code = lambda c: F.coalesce(F.trim(c).try_cast("int"), F.raise_error(F.concat(F.lit("not a condition code: '"), c, F.lit("'"))).cast("int"))
    return F.transform(F.split(F.coalesce(conditions, F.lit(str(REGULAR))), ","), code)


def codes_are_valid(conditions: Column) -> Column:
    return F.forall(F.split(F.coalesce(conditions, F.lit(str(REGULAR))), ","), lambda c: F.trim(c).try_cast("int").isNotNull())

"""Quality rules as a short-circuit cascade.

Rules are independent predicates that reject a text. On a bounded sample (`sample_rows`, by default 2,000 rows, from up to
16 partitions spread over the table) the cost of each rule and the share it rejects are measured; rules then run in
falling order of rejections per second, each on the texts that no earlier rule has rejected, and a statistic is computed
when the first rule that needs it runs. The order changes the work, never the verdict: a text is kept if no rule rejects it.
`filter_quality` spares what the cascade spares; `quality_report` has to give the base statistics of every text, so there the
cascade spares only what they do not take in (letters, bullets, ellipses).

Defined results: a null or empty text, or one of white space, has no words and is rejected (fewer than 20 words).
Equal texts get equal verdicts; repeated rows and null ids pass through; an empty table gives an empty result.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .spark_io import ids_and_texts, map_batches, small_batches

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
#: Letters: A-Z, a-z and every character beyond ASCII.
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
REPEAT_WINDOW = 8


class Texts:
    """The statistics of a chunk of texts, each computed when it is first asked for."""

    def __init__(self, buf: np.ndarray, off: np.ndarray):
        self.buf, self.off, self.n = buf, off, len(off) - 1

    def only(self, mask: np.ndarray) -> Texts:
        """Some of the texts, with what is known of each."""
        length = np.diff(self.off)[mask]
        out = Texts(K.gather(self.buf, self.off[:-1][mask], length), np.concatenate([[0], np.cumsum(length)]))
        for name in {"n_words", "word_chars", "n_symbols", "n_repeat_words", "lettered"} & self.__dict__.keys():
            out.__dict__[name] = getattr(self, name)[mask]
        for name in {"line_counts", "line_marks"} & self.__dict__.keys():
            out.__dict__[name] = tuple(x[mask] for x in getattr(self, name))
        return out

    @cached_property
    def at8(self) -> np.ndarray:
        return K.wide(self.buf)

    def strings(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return K.strings(self.at8, self.buf, start, end)

    @cached_property
    def word_keys(self) -> np.ndarray:
        return self.strings(*self.words[:2])

    @cached_property
    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return K.words(self.buf, self.off)

    @cached_property
    def n_words(self) -> np.ndarray:
        return K.per_text(self.words[2], self.n)

    def count(self, flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return sums[self.off[1:]] - sums[self.off[:-1]]

    @cached_property
    def word_chars(self) -> np.ndarray:
        return self.count(~K.SPACE[self.buf] & ((self.buf & 0xC0) != 0x80))

    @cached_property
    def n_symbols(self) -> np.ndarray:
        return self.count(SYMBOLS[self.buf])

    @cached_property
    def lettered(self) -> np.ndarray:
        """Words with a letter."""
        start, end, doc = self.words
        sums = np.concatenate([[0], np.cumsum(LETTER[self.buf])])
        return K.per_text(doc[sums[end] > sums[start]], self.n)

    @cached_property
    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and text numbers of the lines with a word."""
        start, end, doc = K.lines(self.buf, self.off)
        solid = np.concatenate([[0], np.cumsum(~K.SPACE[self.buf])])
        live = solid[end] > solid[start]
        return start[live], end[live], doc[live]

    @cached_property
    def line_marks(self) -> tuple[np.ndarray, np.ndarray]:
        """Lines that begin with a bullet, and lines that end in an ellipsis, white space apart."""
        start, end, doc = self.lines
        solid = np.flatnonzero(~K.SPACE[self.buf])
        first, last = solid[np.searchsorted(solid, start)], solid[np.searchsorted(solid, end) - 1]
        after = np.concatenate([self.buf, np.zeros(2, np.uint8)])
        is_at = lambda at, text: np.logical_and.reduce([after[at + k] == c for k, c in enumerate(text)])
        bullet = is_at(first, b"-") | is_at(first, b"*") | is_at(first, "•".encode())
        dots = (last - first >= 2) & (is_at(last - 2, b"...") | is_at(last - 2, "…".encode()))
        return K.per_text(doc[bullet], self.n), K.per_text(doc[dots], self.n)

    @cached_property
    def line_counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Lines with a word, and those of them that equal an earlier line of the text."""
        start, end, doc = self.lines
        keys = K.scoped(self.strings(start, end), doc)
        _, first = np.unique(keys, return_index=True)
        full = K.per_text(doc, self.n)
        return full, full - K.per_text(doc[first], self.n)

    @cached_property
    def n_repeat_words(self) -> np.ndarray:
        """Words that lie in an 8-word window found at least twice in the text, its first place included."""
        start, end, doc = self.words
        at, h = K.windows(self.word_keys, doc, REPEAT_WINDOW)
        keys = K.scoped(h, doc[at])
        order = np.argsort(keys)
        same = keys[order][1:] == keys[order][:-1]
        twice = np.zeros(len(keys), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        edge = np.zeros(len(start) + REPEAT_WINDOW + 1, np.int64)
        edge[at[twice]] += 1
        edge[at[twice] + REPEAT_WINDOW] -= 1
        covered = np.cumsum(edge)[: len(start)] > 0
        return K.per_text(doc[covered], self.n)


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Texts], np.ndarray]


def few_words(t: Texts) -> np.ndarray:
    return t.n_words < 20


def repeated_words(t: Texts) -> np.ndarray:
    return 100 * t.n_repeat_words > 30 * t.n_words


def symbol_share(t: Texts) -> np.ndarray:
    """More than one symbol to ten words."""
    return 10 * t.n_symbols > t.n_words


def repeated_lines(t: Texts) -> np.ndarray:
    """More than half of the lines repeat an earlier line."""
    return 2 * t.line_counts[1] > t.line_counts[0]


def word_length(t: Texts) -> np.ndarray:
    """A mean word of under 2 or over 15 code points."""
    return (t.word_chars < 2 * t.n_words) | (t.word_chars > 15 * t.n_words)


def few_letters(t: Texts) -> np.ndarray:
    """Fewer than six in ten words have a letter."""
    return 10 * t.lettered < 6 * t.n_words


def bullet_lines(t: Texts) -> np.ndarray:
    """More than nine in ten lines are bullets."""
    return 10 * t.line_marks[0] > 9 * t.line_counts[0]


def ellipsis_lines(t: Texts) -> np.ndarray:
    """More than three in ten lines end in an ellipsis."""
    return 10 * t.line_marks[1] > 3 * t.line_counts[0]


#: `few_words` and `repeated_words` are the base rules; the verdict joins all.
BASE = (Rule("few_words", few_words), Rule("repeated_words", repeated_words))
MORE = (Rule("symbol_share", symbol_share), Rule("repeated_lines", repeated_lines), Rule("word_length", word_length), Rule("few_letters", few_letters), Rule("bullet_lines", bullet_lines), Rule("ellipsis_lines", ellipsis_lines))
RULES = BASE + MORE


def cascade(texts: Texts, rules: tuple[Rule, ...], live: np.ndarray | None = None) -> np.ndarray:
    """Which texts no rule rejects; every rule sees only what the rules before it have left."""
    live = np.ones(texts.n, bool) if live is None else live.copy()
    for rule in rules:
        left = int(live.sum())
        if not left:
            break
        if left < 0.7 * texts.n:
            kept = live.copy()
            kept[live] = cascade(texts.only(live), rules[rules.index(rule) :])
            return kept
        live &= ~rule.rejects(texts)
    return live


#: Partitions that the sample of rows comes from.
SAMPLED = 16


def plan_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 2000, id_col: str = "doc_id", text_col: str = "text") -> tuple[Rule, ...]:
    """The rules by falling rejection per cost, as measured on at most `sample_rows` rows of `SAMPLED` partitions spread evenly over docs."""
    each = max(1, sample_rows // SAMPLED)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost, gone, seen = [0.0] * len(rules), [0] * len(rules), 0
        for batch in batches:
            for lo, hi, buf, off in K.text_chunks(batch.column("text").slice(0, each - seen)):
                for k, rule in enumerate(rules):
                    began = time.thread_time()
                    gone[k] += int(rule.rejects(Texts(buf, off)).sum())
                    cost[k] += time.thread_time() - began
                seen += hi - lo
            if seen >= each:
                break
        if seen:
            yield pa.RecordBatch.from_pydict({"rule": list(range(len(rules))), "cost": cost, "rejected": gone})

    small_batches(docs.sparkSession)
    measured = ids_and_texts(docs, id_col, text_col).mapInArrow(measure, "rule long, cost double, rejected long").rdd
    n = measured.getNumPartitions()
    # a job over some partitions only: the sample never scans the table
    found = docs.sparkSession.sparkContext.runJob(measured, list, sorted({n * k // SAMPLED for k in range(SAMPLED)})) if n else []
    cost, gone = [0.0] * len(rules), [0] * len(rules)
    for r in found:
        cost[r["rule"]] += r["cost"]
        gone[r["rule"]] += r["rejected"]
    return tuple(rules[k] for k in sorted(range(len(rules)), key=lambda k: (-gone[k] / max(cost[k], 1e-9), k)))


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = MORE, sample_rows: int = 2000) -> DataFrame:
    """Base statistics of every text, whether the base rules reject it, and the verdict of base rules and cascade."""
    order = plan_rules(docs, rules, sample_rows, id_col, text_col)

    def report(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids = batch.column("doc_id")
        for lo, hi, buf, off in K.text_chunks(batch.column("text")):
            t = Texts(buf, off)
            failed = few_words(t) | repeated_words(t)
            columns = [t.n_words, t.word_chars, t.n_symbols, t.line_counts[1], t.n_repeat_words, failed, cascade(t, order, ~failed)]
            yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), *map(pa.array, columns)], ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"])

    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean"
    return map_batches(ids_and_texts(docs, id_col, text_col), report, schema)


def filter_quality(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, sample_rows: int = 2000) -> DataFrame:
    """The rows of docs, all columns as they are, whose text no rule rejects; no shuffle."""
    order = plan_rules(docs.select(F.lit(0).alias("row"), F.col(text_col).alias("text")), rules, sample_rows, "row", "text")

    place = docs.columns.index(text_col)

    def keep(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        kept = np.concatenate([cascade(Texts(buf, off), order) for _, _, buf, off in K.text_chunks(batch.column(place).cast(pa.string()))])
        yield batch.filter(pa.array(kept))

    return map_batches(docs, keep, docs.schema)

"""Quality classifier: regularised quadratic discriminant analysis of document statistics.

Each text gives a fixed vector of transformed statistics. Labelled rows give, in one distributed pass, the count, sum and
sum of outer products of the vectors of each class: a few hundred numbers whatever the input. A class covariance is
shrunk towards the pooled one and that towards its diagonal; the score is the logistic function of the difference of the
log densities (squared Mahalanobis distances by cached Cholesky factors, log determinants) and of the log priors.

Defined results: null and empty texts have a vector like any other and get a score; rows of labels without a quality and
documents without a label take no part in the fit; with one class only (or no label) every score is that class's share
(or 0.5); repeated rows score alike.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .quality_rules import Texts
from .spark_io import ids_and_texts, map_batches

UPPER, DIGIT, MARK, STOP, BAR = (np.zeros(256, bool) for _ in range(5))
UPPER[65:91] = True
DIGIT[48:58] = True
MARK[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
STOP[list(b".!?")] = True
BAR[list(b"|")] = True

NAMES = ("log_words", "word_length", "upper", "digits", "marks", "symbols", "exclaims", "bars", "stops", "line_words", "dup_lines", "repeats", "distinct", "spaces")


def vectors(t: Texts) -> np.ndarray:
    """A row of transformed statistics for each text; shares are mapped by log(share + 0.01), which spreads small ones."""
    words, chars, size = t.n_words.astype(float), t.word_chars.astype(float), np.diff(t.off).astype(float)
    lines, dup = (x.astype(float) for x in t.line_counts)
    doc = t.words[2]
    keys = K.scoped(t.word_keys, doc)
    _, first = np.unique(keys, return_index=True)
    distinct = K.per_text(doc[first], t.n)
    share = lambda a, b: np.log(a / np.maximum(b, 1.0) + 0.01)
    return np.stack([
        np.log1p(words), np.log1p(chars / np.maximum(words, 1)), share(t.count(UPPER[t.buf]), chars), share(t.count(DIGIT[t.buf]), chars),
        share(t.count(MARK[t.buf]), chars), share(t.n_symbols, words), share(t.count(t.buf == 33), words), share(t.count(BAR[t.buf]), words),
        share(t.count(STOP[t.buf]), words), np.log1p(words / np.maximum(lines, 1)), share(dup, lines), share(t.n_repeat_words, words),
        share(distinct, np.sqrt(words)), share(size - chars, size),
    ], axis=1)


@dataclass(frozen=True)
class Discriminant:
    """log prior odds of class 1, and each class's mean, inverse Cholesky factor and log determinant; `only`: a constant score."""

    odds: float
    mean: tuple[np.ndarray, np.ndarray]
    root: tuple[np.ndarray, np.ndarray]
    log_det: tuple[float, float]
    only: float | None = None

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.only is not None:
            return np.full(len(x), self.only)
        density = [-0.5 * (((x - m) @ r.T) ** 2).sum(1) - 0.5 * d for m, r, d in zip(self.mean, self.root, self.log_det, strict=True)]
        return 1 / (1 + np.exp(-np.clip(self.odds + density[1] - density[0], -700, 700)))


def discriminant(n: np.ndarray, total: np.ndarray, outer: np.ndarray, shrink: float, ridge: float) -> Discriminant:
    if not n.all():
        return Discriminant(0.0, (), (), (), float(n[1] / n.sum()) if n.sum() else 0.5)
    d = total.shape[1]
    mean = total / n[:, None]
    cov = [outer[c] / n[c] - np.outer(mean[c], mean[c]) for c in (0, 1)]
    pooled = (n[0] * cov[0] + n[1] * cov[1]) / n.sum()
    spread = np.diag(np.maximum(np.diag(pooled), 1e-6))
    target = 0.9 * pooled + 0.1 * spread
    roots, dets = [], []
    for c in (0, 1):
        weight = shrink + (1 - shrink) * d / (d + n[c])  # the fewer rows a class has, the more it borrows
        s = (1 - weight) * cov[c] + weight * target + ridge * spread
        factor = np.linalg.cholesky(s)
        roots.append(np.linalg.inv(factor))
        dets.append(2 * float(np.log(np.diag(factor)).sum()))
    return Discriminant(float(np.log(n[1] / n[0])), (mean[0], mean[1]), (roots[0], roots[1]), (dets[0], dets[1]))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text", sample: int = 20_000, shrink: float = 0.2, ridge: float = 1e-3) -> Discriminant:
    """Fits on at most about `sample` labelled rows: those whose hashed id is below a bound set from the number of labels.

    Only ids and labels are joined first; texts reach the fit through a filter on that bound and a join with the sample.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
    count = known.count()
    share = 1.0 if count <= sample else sample / count
    pick = lambda c: F.pmod(F.xxhash64(F.col(c), F.lit("fit")), F.lit(1_000_003)) < F.lit(int(share * 1_000_003))
    known = known if share == 1.0 else known.where(pick("doc_id"))
    rows = ids_and_texts(docs, id_col, text_col)
    rows = rows if share == 1.0 else rows.where(pick("doc_id"))
    size = len(NAMES)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, outer = np.zeros(2), np.zeros((2, size)), np.zeros((2, size, size))
        for batch in batches:
            y = batch.column("y").to_numpy(zero_copy_only=False)
            for lo, hi, buf, off in K.text_chunks(batch.column("text")):
                x = vectors(Texts(buf, off))
                for c in (0, 1):
                    own = x[y[lo:hi] == c]
                    n[c] += len(own)
                    total[c] += own.sum(0)
                    outer[c] += own.T @ own
        if n.sum():
            yield pa.RecordBatch.from_pydict({"sums": [np.concatenate([n, total.ravel(), outer.ravel()])]})

    parts = rows.join(known, "doc_id").mapInArrow(sums, "sums array<double>")
    added = parts.select(F.posexplode("sums").alias("k", "v")).groupBy("k").agg(F.sum("v").alias("v")).collect()
    flat = np.zeros(2 + 2 * size + 2 * size * size)
    for r in added:
        flat[r["k"]] = r["v"]
    return discriminant(flat[:2], flat[2 : 2 + 2 * size].reshape(2, size), flat[2 + 2 * size :].reshape(2, size, size), shrink, ridge)


def score(docs: DataFrame, model: Discriminant, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, predicted of every row, from its whole text; no shuffle."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for lo, hi, buf, off in K.text_chunks(batch.column("text")):
            s = model.scores(vectors(Texts(buf, off)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    return map_batches(ids_and_texts(docs, id_col, text_col), run, "doc_id long, score double, predicted int")


def keep_good(docs: DataFrame, model: Discriminant, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of docs, all columns as they are, whose text scores at least `least`; null and empty texts are scored like others."""
    place = docs.columns.index(text_col)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        s = np.concatenate([model.scores(vectors(Texts(buf, off))) for _, _, buf, off in K.text_chunks(batch.column(place).cast(pa.string()))])
        yield batch.filter(pa.array(s >= least))

    return map_batches(docs, run, docs.schema)


def fold(column: Column) -> Column:
    """crc32 of an id as text, modulo 3."""
    return F.crc32(column.cast("string").cast("binary")) % 3


def crc_fold(doc_id: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % 3

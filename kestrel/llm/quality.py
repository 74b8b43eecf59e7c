"""Quality classifier by co-training of a text view and a page-metadata view.

The text view is the mean of hashed word weights plus shares of character classes and word
shapes over the whole text; the metadata view has language, source and length.  Both are logistic
models, which first learn from a bounded sample of labelled documents (``labelled`` rows, those with the smallest
hashes of their doc_id).  Every other document is in the pool.  In each round

 1. both models score the whole pool, and histograms of their calibrated log-odds come back, in which the confident
    ends of each view are cut: at most a share of the pool, growing from round to round, and only scores that are sure;
 2. the documents at a view's ends are pseudo-labels for the other view: a second pass over the pool sums, per class,
    the other model's logistic gradient and the diagonal of a bound on its curvature (a quarter of x_j times the sum of x);
 3. each model is trained again on the labelled sample plus that quadratic bound, which never understates the
    loss on the pool, so a step cannot overshoot.  The pool's classes weigh ``trust`` of the sample's, however large the pool.

Only the sample, the histograms and the sums (a few numbers a feature) reach the driver; features of the pool are stored once and
never leave the executors.  A held-out quarter of the labelled sample calibrates each view (a logistic curve over its score),
and a last logistic model combines the calibrated log-odds.  All documents are scored where they lie, without a shuffle.

Defined results: a null or blank text has no words and zero shares; a null language or source is a
value of its own.  Without labels of both kinds nothing can be learnt: every document scores 1 and is kept.
Labels that are null are ignored; of several for a doc_id the mean decides.  Of several texts of a labelled doc_id the one whose
words sort first is learnt from.  Each row gives a row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, functions as F

from kestrel.llm.common import U64, drop, mix, store, table, text_chunks, word_hashes, word_spans

BUCKETS = 1 << 14
SHAPES = 9
META = 1 << 10
WORD_SCALE = 12.0

_UPPER = np.zeros(256, np.float64)
_UPPER[65:91] = 1
_DIGIT = np.zeros(256, np.float64)
_DIGIT[48:58] = 1
_MARK = np.zeros(256, np.float64)
_MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 1
_STOP = np.zeros(256, np.float64)
_STOP[[33, 46, 63]] = 1  # ! . ?
_BREAK = np.zeros(256, np.float64)
_BREAK[10] = 1


def _per_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values)])
    return total[bounds[1:]] - total[bounds[:-1]]


def text_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word buckets of a chunk, the first word of each row in them, and a dense matrix of shapes."""
    starts, ends, first = word_spans(data, offsets)
    h = word_hashes(data, starts, ends, lower=True)
    words = np.maximum(np.diff(first), 1)
    size = np.maximum(np.diff(offsets), 1)
    # words that hold a mark inside or at the end, and distinct words, tell junk from prose
    marks = np.concatenate([[0.0], np.cumsum(_MARK[data])])
    marked = (marks[ends] - marks[starts]) > 0
    kinds = np.array([len(np.unique(h[a:b])) for a, b in zip(first[:-1], first[1:], strict=True)], np.float64)
    shapes = np.stack([
        _per_row(_UPPER[data], offsets) / size, _per_row(_DIGIT[data], offsets) / size, _per_row(_MARK[data], offsets) / size,
        _per_row(_STOP[data], offsets) / words, _per_row(_BREAK[data], offsets) / words,
        _per_row((ends - starts).astype(np.float64), first) / words / 10, _per_row(marked.astype(np.float64), first) / words,
        kinds / words, np.log1p(np.diff(first)) / 10,
    ], 1)
    return (h & U64(BUCKETS - 1)).astype(np.int32), first, shapes


def _hash_text(value: str | None, salt: int) -> int:
    h = salt + 1
    for x in (f"{salt}:" + ("\0" if value is None else value)).encode("utf-8", "replace"):
        h = int(mix(np.array([(h * 31 + x) & (1 << 64) - 1], np.uint64))[0])
    return h


def meta_features(batch: pa.RecordBatch) -> np.ndarray:
    """Three buckets a row: language, source, and language with the length's magnitude."""
    lang, source = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
    length = batch.column("n_chars").to_pylist()
    known: dict[tuple, int] = {}

    def bucket(value, salt):
        if (value, salt) not in known:
            known[value, salt] = _hash_text(value, salt) % META
        return known[value, salt]

    return np.array([[bucket(a, 0), bucket(b, 1), bucket(f"{a}|{-1 if n is None else max(0, int(n)).bit_length()}", 2)]
                     for a, b, n in zip(lang, source, length, strict=True)], np.int32).reshape(-1, 3)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class View:
    """Hashed features as (flat indices, row bounds, weight of each row's features, times each occurs) and dense ones."""

    flat: np.ndarray
    bounds: np.ndarray
    scale: np.ndarray
    dense: np.ndarray
    size: int
    times: np.ndarray | None = None

    def take(self, rows: np.ndarray) -> View:
        at = np.concatenate([np.arange(self.bounds[r], self.bounds[r + 1]) for r in rows]) if len(rows) else np.empty(0, np.int64)
        bounds = np.concatenate([[0], np.cumsum(np.diff(self.bounds)[rows])]).astype(np.int64)
        return View(self.flat[at], bounds, self.scale[rows], self.dense[rows], self.size, None if self.times is None else self.times[at])

    def values(self) -> np.ndarray:
        """The value of each hashed feature."""
        x = np.repeat(self.scale, np.diff(self.bounds))
        return x if self.times is None else x * self.times


@dataclass
class Linear:
    """``theta`` holds the weights of hashed features, of dense ones, and the bias."""

    theta: np.ndarray
    mean: np.ndarray
    dev: np.ndarray

    def score(self, v: View) -> np.ndarray:
        hashed = _per_row(self.theta[v.flat] * v.values(), v.bounds)
        return hashed + ((v.dense - self.mean) / self.dev) @ self.theta[v.size : -1] + self.theta[-1]

    def sums(self, v: View, err: np.ndarray, heavy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradient sums for the rows' errors, and the bound on the curvature for rows that count ``heavy``."""
        dense, x = (v.dense - self.mean) / self.dev, v.values()
        row = np.repeat(np.arange(len(err)), np.diff(v.bounds))
        g = np.concatenate([np.bincount(v.flat, err[row] * x, v.size), dense.T @ err, [err.sum()]])
        whole = (np.bincount(row, x, len(err)) + np.abs(dense).sum(1) + 1) * heavy / 4
        return g, np.concatenate([np.bincount(v.flat, whole[row] * x, v.size), np.abs(dense).T @ whole, [whole.sum()]])


@dataclass
class Pull:
    """The pool's share of the loss around ``at``: mean gradient and curvature, both classes of one weight."""

    at: np.ndarray
    gradient: np.ndarray
    curvature: np.ndarray


def train(v: View, y: np.ndarray, pull: Pull | None = None, epochs: int = 80, rate: float = 0.15, ridge: float = 2e-4) -> Linear:
    """Logistic regression on balanced classes by full-batch Adam steps."""
    mean, dev = v.dense.mean(0), v.dense.std(0) + 1e-6
    dense, x = (v.dense - mean) / dev, v.values()
    share = 1 / np.where(y > 0.5, (y > 0.5).sum(), (y <= 0.5).sum()) / 2
    row = np.repeat(np.arange(len(y), dtype=np.int32), np.diff(v.bounds))
    model = Linear(np.zeros(v.size + dense.shape[1] + 1) if pull is None else pull.at.copy(), mean, dev)
    theta = model.theta
    m, s = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, epochs + 1):
        err = (sigmoid(model.score(v)) - y) * share
        g = np.concatenate([np.bincount(v.flat, err[row] * x, v.size), dense.T @ err, [err.sum()]]) + ridge * theta
        if pull is not None:
            g += pull.gradient + pull.curvature * (theta - pull.at)
        m, s = 0.9 * m + 0.1 * g, 0.99 * s + 0.01 * g * g
        theta -= rate * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-8)
    return model


def curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Coefficients of a small logistic model over the columns of ``x`` and a constant, by Newton steps with a ridge."""
    x = np.column_stack([x, np.ones(len(y))])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + 1e-2 * np.eye(len(w)), x.T @ (y - p) - 1e-2 * w)
        w += np.clip(step, -2, 2)
    return w


@dataclass
class CoTrained:
    text: Linear
    meta: Linear
    curves: tuple[np.ndarray, np.ndarray]
    last: np.ndarray

    def probabilities(self, text: View, meta: View) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a = np.clip(self.text.score(text), -30, 30) * self.curves[0][0] + self.curves[0][1]
        b = np.clip(self.meta.score(meta), -30, 30) * self.curves[1][0] + self.curves[1][1]
        return sigmoid(a), sigmoid(b), sigmoid(np.column_stack([a, b]) @ self.last[:2] + self.last[2])


BINS = 480
EDGE = 12.0
POINT = float(1 << 20)


def bins(odds: np.ndarray) -> np.ndarray:
    """The histogram bin of calibrated log-odds."""
    return np.floor((np.clip(odds, -EDGE, EDGE - 1e-9) + EDGE) * (BINS / (2 * EDGE))).astype(np.int64)


def ends(counts: np.ndarray, share: float, sure: float) -> tuple[int, int]:
    """Bins up to the first and from the second on hold the surest documents: ``share`` of all at either end at most, and
    the outermost bin if that alone holds more."""
    most, total = share * counts.sum(), np.cumsum(counts)
    least = bins(np.array([np.log(sure / (1 - sure))]))[0]
    filled = np.flatnonzero(counts)
    if not len(filled):
        return -1, BINS
    low = max(int(np.searchsorted(total, most, "right")) - 1, int(filled[0]))
    high = min(BINS - int(np.searchsorted(np.cumsum(counts[::-1]), most, "right")), int(filled[-1]))
    return min(low, BINS - 2 - int(least)), max(high, int(least) + 1)


def _pool_views(batch: pa.RecordBatch, known: np.ndarray) -> tuple[View, View]:
    """The stored features of the documents outside the labelled sample."""
    batch = batch.filter(pa.array(~np.isin(batch.column("doc_id").fill_null(0).to_numpy(), known) | batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)))
    return feature_views(batch)


def feature_views(batch) -> tuple[View, View]:
    """The views of feature rows (words, times, shapes, meta)."""
    def lists(name, dtype, width=None):
        col = batch.column(name)
        col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
        flat = col.flatten().to_numpy(zero_copy_only=False).astype(dtype)
        return flat.reshape(-1, width) if width else (flat, np.concatenate([[0], np.cumsum(pa.compute.list_value_length(col).to_numpy())]).astype(np.int64))

    n = batch.num_rows
    flat, bounds = lists("words", np.int32)
    times = lists("times", np.float64)[0]
    size = _per_row(times, bounds)
    meta = lists("meta", np.int32, 3)
    return (View(flat, bounds, WORD_SCALE / np.maximum(size, 1), lists("shapes", np.float64, SHAPES), BUCKETS, times),
            View(meta.ravel(), np.arange(n + 1) * 3, np.ones(n), np.zeros((n, 1)), META))


def pool_counts(pool: DataFrame, known: np.ndarray, models: list[Linear], curves: list[np.ndarray]) -> np.ndarray:
    """Per view the histogram of the whole pool's calibrated log-odds."""

    def run(batches):
        total = np.zeros((2, BINS), np.int64)
        for batch in batches:
            for k, v in enumerate(_pool_views(batch, known)):
                total[k] += np.bincount(bins(models[k].score(v) * curves[k][0] + curves[k][1]), minlength=BINS)
        k, b = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(total[k, b])], names=["view", "bin", "n"])

    out = np.zeros((2, BINS), np.int64)
    for r in pool.mapInArrow(run, "view int, bin int, n long").groupBy("view", "bin").agg(F.sum("n").alias("n")).collect():  # at most 2 x BINS rows
        out[r["view"], r["bin"]] = r["n"]
    return out


def pool_pulls(pool: DataFrame, known: np.ndarray, models: list[Linear], curves: list[np.ndarray], cuts: list[tuple[int, int]], trust: float) -> list[Pull | None]:
    """For each view what the other one's pseudo-labels add to its loss, summed over the whole pool in fixed point."""
    width = max(len(m.theta) for m in models)

    def run(batches):
        g, h, n = (np.zeros((2, 2, w)) for w in (width, width, 1))
        for batch in batches:
            views = _pool_views(batch, known)
            scores = [m.score(v) for m, v in zip(models, views, strict=True)]
            for k in range(2):
                at = bins(scores[1 - k] * curves[1 - k][0] + curves[1 - k][1])
                for side, on in enumerate((at <= cuts[1 - k][0], at >= cuts[1 - k][1])):
                    rows = np.flatnonzero(on)
                    if len(rows):
                        a, b = models[k].sums(views[k].take(rows), sigmoid(scores[k][rows]) - side, np.ones(len(rows)))
                        g[k, side, : len(a)] += a
                        h[k, side, : len(b)] += b
                        n[k, side, 0] += len(rows)
        k, side, i = np.nonzero(h)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (
            k.astype(np.int32), side.astype(np.int32), i.astype(np.int32), np.rint(g[k, side, i] * POINT).astype(np.int64),
            np.rint(h[k, side, i] * POINT).astype(np.int64), n[k, side, 0].astype(np.int64))], names=["view", "side", "i", "g", "h", "n"])

    summed = (pool.mapInArrow(run, "view int, side int, i int, g long, h long, n long").groupBy("view", "side", "i")
              .agg(*(F.sum(F.col(c).cast("decimal(38,0)")).cast("double").alias(c) for c in ("g", "h")), F.sum("n").alias("n"))
              .orderBy("view", "side", "i").toArrow().to_pandas())  # at most 4 numbers a feature
    out: list[Pull | None] = []
    for k in range(2):
        size = len(models[k].theta)
        g, h, both = np.zeros(size), np.zeros(size), 0
        for side in range(2):
            part = summed[(summed["view"] == k) & (summed["side"] == side)]
            if len(part):
                # every document adds to the bias, so its row has the documents of all tasks
                rows = float(part["n"].max())
                both += 1
                g[part["i"]] += part["g"] / POINT / rows / 2 * trust
                h[part["i"]] += part["h"] / POINT / rows / 2 * trust
        out.append(Pull(models[k].theta.copy(), g, h) if both == 2 else None)
    return out


def co_train(sample: tuple[View, View], y: np.ndarray, pool: DataFrame, known: np.ndarray, rounds: int, share: float, sure: float, trust: float) -> CoTrained:
    """``sample`` is labelled by ``y``.  Every fourth row is held out for calibration."""
    every = np.arange(len(y))
    held, start = every[::4], every[every % 4 != 0]
    if len(set(y[start])) < 2 or len(set(y[held])) < 2:
        held = start = every
    calibrate = lambda: [curve(models[k].score(sample[k].take(held))[:, None], y[held]) for k in range(2)]
    models = [train(v.take(start), y[start]) for v in sample]
    for r in range(rounds):
        curves = calibrate()
        counts = pool_counts(pool, known, models, curves)
        pulls = pool_pulls(pool, known, models, curves, [ends(c, share * (r + 1), sure) for c in counts], trust)
        models = [train(v.take(start), y[start], p) if p else m for v, m, p in zip(sample, models, pulls, strict=True)]
    a, b = (models[k].score(sample[k].take(held)) for k in range(2))
    curves = calibrate()
    both = np.column_stack([a * curves[0][0] + curves[0][1], b * curves[1][0] + curves[1][1]])
    return CoTrained(models[0], models[1], (curves[0], curves[1]), curve(both, y[held]))


def _views(batch: pa.RecordBatch) -> Iterator[tuple[int, int, View, View]]:
    meta = meta_features(batch)
    for i, j, data, offsets in text_chunks(batch.column("text")):
        flat, first, shapes = text_features(data, offsets)
        n = j - i
        yield i, j, View(flat, first, WORD_SCALE / np.maximum(np.diff(first), 1), shapes, BUCKETS), View(
            meta[i:j].ravel(), np.arange(n + 1) * 3, np.ones(n), np.zeros((n, 1)), META)


NEEDED = ["doc_id", "text", "lang", "source", "n_chars"]


FEATURES = "doc_id long, words array<int>, times array<int>, shapes array<double>, meta array<int>"


def features(docs: DataFrame) -> DataFrame:
    """One row of features a document: distinct word buckets and how often each occurs (at most BUCKETS), shapes, metadata."""

    def run(batches):
        for batch in batches:
            for i, j, t, m in _views(batch):
                n = np.diff(t.bounds)
                both, times = np.unique(np.repeat(np.arange(j - i, dtype=np.int64), n) * BUCKETS + t.flat, return_counts=True)
                bounds = pa.array(np.searchsorted(both, np.arange(j - i + 1, dtype=np.int64) * BUCKETS).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id")[i:j], pa.ListArray.from_arrays(bounds, pa.array((both % BUCKETS).astype(np.int32))),
                    pa.ListArray.from_arrays(bounds, pa.array(times.astype(np.int32))),
                    pa.FixedSizeListArray.from_arrays(pa.array(t.dense.ravel()), SHAPES).cast(pa.list_(pa.float64())),
                    pa.FixedSizeListArray.from_arrays(pa.array(m.flat), 3).cast(pa.list_(pa.int32())),
                ], names=["doc_id", "words", "times", "shapes", "meta"])

    return docs.select(*NEEDED).mapInArrow(run, FEATURES)


def fit_quality(docs: DataFrame, labels: DataFrame, labelled: int = 3000, rounds: int = 3,
                share: float = 0.1, sure: float = 0.9, trust: float = 0.3) -> CoTrained | None:
    """The model, from a bounded sample of labelled documents and all others; None if labels do not hold both kinds."""
    y = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("double").alias("y"))
    every = store(features(docs), "features")
    ids = every.where("doc_id IS NOT NULL").select("doc_id").distinct()
    some = ids.join(y, "doc_id").orderBy(F.xxhash64(F.lit("l"), "doc_id"), "doc_id").limit(labelled)
    # the sample is bounded by a parameter and its rows by BUCKETS, so its ids may be broadcast and its features collected
    sample = (every.join(F.broadcast(some), "doc_id").groupBy("doc_id", "y").agg(F.min(F.struct("words", "times", "shapes", "meta")).alias("x"))
              .select("doc_id", "y", "x.*").toArrow().sort_by([("doc_id", "ascending")]).combine_chunks())
    y = sample.column("y").to_numpy(zero_copy_only=False).astype(float)
    model = None
    if len(set(y)) == 2:
        known = sample.column("doc_id").to_numpy()
        model = co_train(feature_views(sample), y, every, known, rounds, share, sure, trust)
    drop(every)
    return model


def score_quality(docs: DataFrame, model: CoTrained | None, threshold: float = 0.5) -> DataFrame:
    """(doc_id, p_text, p_meta, score, keep) of every row."""

    def run(batches):
        for batch in batches:
            for i, j, t, m in _views(batch):
                a, b, c = model.probabilities(t, m) if model else (np.ones(j - i),) * 3
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[i:j], *map(pa.array, (a, b, c, c >= threshold))],
                                                 names=["doc_id", "p_text", "p_meta", "score", "keep"])

    return docs.select(*NEEDED).mapInArrow(run, "doc_id long, p_text double, p_meta double, score double, keep boolean")


def filter_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    """The rows of ``docs`` (all columns) that the classifier keeps."""
    model = fit_quality(docs, labels, **options)

    def run(batches):
        for batch in batches:
            keep = [np.ones(j - i, bool) if model is None else model.probabilities(t, m)[2] >= threshold for i, j, t, m in _views(batch)]
            yield batch.filter(pa.array(np.concatenate(keep) if keep else np.empty(0, bool)))

    return docs.mapInArrow(run, docs.schema)


# ---------------------------------------------------------------- registered query

def op1_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))

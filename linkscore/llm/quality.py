"""Quality rules: plain counts and a calibrated model over hashed n-grams.

The model is a logistic regression over hashed words, word pairs and character
4-grams, fitted on a bounded sample of the labelled rows and calibrated on rows
it has not seen (Platt). Only its weights travel; texts are scored where they
are read, in Arrow batches, against a fixed threshold.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkscore.llm.batches import Words, new_powers, run_index, slices, text_bytes

BITS = 16  # of a feature's number
MAX_ROWS = 2_000  # labelled rows that the fit may use
THRESHOLD = 0.5  # least calibrated probability of good quality
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
MIN_WORDS = 50

BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean"


@dataclass
class Model:
    """Weights by feature, intercept, and the calibration ``sigmoid(slope * z + shift)``."""

    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def probability(self, z: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * z + self.shift)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def features(table: pa.Table, powers) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Feature numbers of each kind with their bounds by text, and the number of words."""
    raw, offsets = text_bytes(table["text"])
    words = Words(raw, offsets, powers)
    top = np.uint64(64 - BITS)
    single = ((words.hash * np.uint64(0x9E3779B97F4A7C15)) >> top).astype(np.int32)
    pairs, pair_bounds = words.grams(2)
    pairs = (pairs >> top).astype(np.int32)
    n = max(len(raw) - 3, 0)
    wide = raw.astype(np.uint32)
    quad = wide[:n].copy()
    for i in (1, 2, 3):
        quad |= wide[i : i + n] << np.uint32(8 * i)
    quad *= np.uint32(0x9E3779B1)
    quad >>= np.uint32(32 - BITS)
    count = np.maximum(np.diff(offsets) - 3, 0)
    quad = quad.astype(np.int32)[run_index(offsets[:-1], count)]
    bounds = np.concatenate([[0], np.cumsum(count)])
    return [(single, words.first), (pairs, pair_bounds), (quad, bounds)], np.diff(words.first)


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum per text of values laid end to end."""
    run = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return run[bounds[1:]] - run[bounds[:-1]]


def raw_scores(model: Model, kinds: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Linear score: each kind's weights summed over the root of its count."""
    z = model.bias
    for key, bounds in kinds:
        z = z + _sums(model.weights[key], bounds) / np.sqrt(np.maximum(np.diff(bounds), 1))
    return z


def base_counts(text: str | None) -> tuple[int, int, int, int, int, bool]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed of one text.

    Null and empty texts have no words and fail.
    """
    text = text or ""
    words = text.encode().split()  # at the ASCII blanks, as the words are defined
    n = len(words)
    chars = len(text) - sum(map(text.count, BLANKS)) if n else 0
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        often = Counter(windows)
        reach = 0  # words before this one are counted already
        for i, window in enumerate(windows):
            if often[window] > 1:
                repeated += i + 3 - max(reach, i)
                reach = i + 3
    return n, chars, symbols, len(lines) - len(set(lines)), repeated, n < MIN_WORDS or 100 * repeated > 50 * n


def label_sample(labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """At most ``max_rows`` labelled ids in an order that ignores the data's order.

    Null ids and labels are left out, as are ids with contradicting labels.
    """
    clean = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("_most"))
        .where(F.col("quality") == F.col("_most"))
    )
    order = F.crc32(F.concat(F.lit("quality:"), F.col("doc_id").cast("string")))
    return clean.select("doc_id", "quality").orderBy(order, "doc_id").limit(max_rows)


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """Fit on three quarters of the sample, calibrate on the rest.

    Bounded by ``max_rows`` rows, whose feature counts alone come to the driver.
    Without rows of both classes every text gets the share of good rows (1 where
    there are no labels), so nothing is dropped unlearnt.
    """
    sample = F.broadcast(label_sample(labels, max_rows))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = new_powers()
        for batch in batches:
            for table in slices(batch):
                kinds, _ = features(table, powers)
                keys, values = [], []
                for i in range(table.num_rows):
                    total: dict[int, float] = {}
                    for key, bounds in kinds:
                        own, times = np.unique(key[bounds[i] : bounds[i + 1]], return_counts=True)
                        scale = 1 / max(bounds[i + 1] - bounds[i], 1) ** 0.5
                        for k, t in zip(own.tolist(), (times * scale).tolist()):
                            total[k] = total.get(k, 0.0) + t
                    keys.append(np.fromiter(total, np.int32, len(total)).tobytes())
                    values.append(np.fromiter(total.values(), np.float32, len(total)).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [table["doc_id"].cast(pa.int64()).combine_chunks(), table["quality"].cast(pa.int32()).combine_chunks(), pa.array(keys, pa.binary()), pa.array(values, pa.binary())],
                    names=["doc_id", "quality", "keys", "vals"],
                )

    rows = (
        docs.select("doc_id", "text")
        .join(sample, "doc_id")
        .groupBy("doc_id", "quality")
        .agg(F.min("text").alias("text"))  # one row per id, however often it is repeated
        .mapInArrow(count, "doc_id long, quality int, keys binary, vals binary")
        .collect()
    )
    rows.sort(key=lambda r: (r.doc_id, r["keys"]))
    y = np.array([r.quality for r in rows], np.float64)
    if len(set(y.tolist())) < 2:
        share = y.mean() if len(y) else 1.0
        odds = np.clip(share, 1e-9, 1 - 1e-9)
        return Model(np.zeros(1 << BITS, np.float32), float(np.log(odds / (1 - odds))))
    keys = [np.frombuffer(r["keys"], np.int32) for r in rows]
    values = [np.frombuffer(r["vals"], np.float32) for r in rows]
    held = np.arange(len(rows)) % 4 == 3
    if len(set(y[held].tolist())) < 2 or len(set(y[~held].tolist())) < 2:
        held = np.zeros(len(rows), bool)
    fitted = _descend([k for k, h in zip(keys, held) if not h], [v for v, h in zip(values, held) if not h], y[~held])
    on = held if held.any() else ~held
    z = np.array([fitted.bias + float(fitted.weights[k] @ v) for k, v, h in zip(keys, values, on) if h])
    fitted.slope, fitted.shift = _platt(z, y[on])
    return fitted


def _descend(keys: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, rounds: int = 100, rate: float = 0.05, l2: float = 1e-5) -> Model:
    """Full-batch Adam on the logistic loss."""
    row = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
    key, value = np.concatenate(keys), np.concatenate(values).astype(np.float64)
    size = (1 << BITS) + 1  # the last weight is the intercept
    w, mean, square = np.zeros(size), np.zeros(size), np.zeros(size)
    for i in range(1, rounds + 1):
        slip = _sigmoid(np.bincount(row, w[key] * value, len(keys)) + w[-1]) - y
        slope = np.bincount(key, slip[row] * value, size) / len(y) + l2 * w
        slope[-1] = slip.mean()
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        w -= rate * (mean / (1 - 0.9**i)) / (np.sqrt(square / (1 - 0.99**i)) + 1e-8)
    return Model(w[:-1].astype(np.float32), float(w[-1]))


def _platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift by Newton steps, towards smoothed targets."""
    good, bad = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    x = np.stack([z, np.ones(len(z))], 1)
    ab = np.array([1.0, 0.0])
    for _ in range(100):
        p = _sigmoid(x @ ab)
        slope = x.T @ (p - target) + 1e-6 * ab
        curve = (x.T * np.maximum(p * (1 - p), 1e-9)) @ x + 1e-6 * np.eye(2)
        move = np.linalg.solve(curve, slope)
        ab = ab - np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-9:
            break
    return float(ab[0]), float(ab[1])


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, the base counts, ``quality`` (calibrated probability) and ``kept``, row by row.

    Null and empty texts fail the base rules and are not kept; texts of any length
    count whole. Rows are independent: repeated ids stay, other columns are left
    out, no rows give no rows.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = new_powers()
        for batch in batches:
            for table in slices(batch):
                kinds, _ = features(table, powers)
                quality = model.probability(raw_scores(model, kinds))
                base = [base_counts(x) for x in table["text"].to_pylist()]
                columns = [pa.array(x, pa.int64()) for x in list(zip(*base))[:5]]
                failed = np.array([x[5] for x in base], bool)
                yield pa.RecordBatch.from_arrays(
                    [table["doc_id"].cast(pa.int64()).combine_chunks(), *columns, pa.array(failed), pa.array(quality), pa.array(~failed & (quality >= threshold))],
                    names=["doc_id", *[x.split()[0] for x in BASE.split(", ")], "quality", "kept"],
                )

    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id long, {BASE}, quality double, kept boolean")


def quality_rules(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """Fit on ``labels`` and score all of ``docs``; rules as in :func:`score`."""
    return score(docs, fit(docs, labels, max_rows), threshold)

"""Quality scores: ridge regression on random Fourier features of document statistics, calibrated isotonically.

Statistics of the whole text are computed once and written. Random Fourier features of the standardised statistics
approximate a Gaussian kernel; each partition sums their normal equations, one set per fold of the training rows, and
the driver adds a fixed number of such sets (``_SUM_TASKS`` times ``FOLDS``) and solves them. Leaving one fold out
gives scores for rows that a model has not seen; an isotonic fit on those (as counts in a fixed number of bins)
turns ridge scores into probabilities for all rows.

Cases: a null text is scored as the empty text. Labels that are null, or without a document, teach nothing; several
labels of one id count each. Rows that repeat are scored each. Without any label every score is 0.5. Empty table: empty
result. Neither doc_id nor any column but the text enters a score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import written

COMPONENTS, RIDGE, FOLDS, SEED, THRESHOLD = 160, 1.0, 4, 11, 0.7
_SUM_TASKS, _BINS = 16, 1024
_LOW, _HIGH = -0.5, 1.5  # ridge scores outside are counted in the first or last bin

#: Byte classes for the shares below: one row of counts per class.
_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789", "space": b" ", "line": b"\n\r",
    "stop": b".?", "comma": b",;:", "shout": b"!", "bar": b"|", "symbol": b"#$%&*+/<=>@\\^_`{}~", "quote": b"\"'()[]-",
}
_CLASS_OF = np.zeros(256, np.int64)
for _k, _chars in enumerate(_CLASSES.values(), 1):
    _CLASS_OF[list(_chars)] = _k
STATISTICS = len(_CLASSES) + 15


def statistics(text: str | None) -> list[float]:
    """Scale-free statistics of a whole text, each between 0 and about 1."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    counts = np.zeros(len(_CLASSES) + 1, np.int64)
    data = np.frombuffer(raw, np.uint8)
    for at in range(0, len(data), 1 << 20):
        counts += np.bincount(_CLASS_OF[data[at : at + (1 << 20)]], minlength=len(counts))
    size, words = max(1, len(raw)), text.split()
    n, seen = max(1, len(words)), Counter(words)
    lines = text.split("\n")
    line_counts, long_lines = Counter(lines), max(1, len(lines))
    letters = max(1, int(counts[1] + counts[2]))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    repeats = sum(map(str.__eq__, words, words[1:]))
    ends = Counter(w[-1] for w in words)
    marked = sum(k for c, k in ends.items() if c in "#$%&*!|<>=+~^@")
    shouted = sum(k for w, k in seen.items() if w.isupper() and len(w) > 1)
    titled = sum(k for w, k in seen.items() if w[0].isupper())
    return [
        *(counts[1:] / size), counts[1] / letters,
        min(1.0, np.log1p(len(raw)) / 14), min(1.0, np.log1p(len(words)) / 12), min(1.0, float(lengths.mean()) / 16 if len(words) else 0.0),
        min(1.0, float(lengths.std()) / 8 if len(words) else 0.0), (len(raw) - len(text)) / size, len(seen) / n,
        max(seen.values(), default=0) / n, repeats / n, marked / n, shouted / n, titled / n, ends.get(".", 0) / n,
        1 - len(line_counts) / long_lines, min(1.0, len(lines) / n),
    ]


def _features_of(docs: DataFrame) -> DataFrame:
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [statistics(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.list_(pa.float64()))], names=["doc_id", "x"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(of_batches, "doc_id bigint, x array<double>")


class Fourier:
    """cos(W x + b), with W drawn for a Gaussian kernel over standardised statistics, and a constant."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, components: int = COMPONENTS, seed: int = SEED):
        draw = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        self.weights = draw.normal(size=(len(mean), components)) / np.sqrt(2 * len(mean))
        self.phase = draw.uniform(0, 2 * np.pi, components)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        standard = np.clip((x - self.mean) / self.scale, -6, 6)
        z = np.cos(standard @ self.weights + self.phase) * np.sqrt(2 / len(self.phase))
        return np.hstack([z, np.ones((len(x), 1))])


def _matrix(batch: pa.RecordBatch, name: str = "x") -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def normal_equations(train: DataFrame, fourier: Fourier, folds: int = FOLDS) -> tuple[np.ndarray, np.ndarray]:
    """Sums of z z' and z y over the rows (x, y, fold), by fold. What reaches the driver is ``_SUM_TASKS`` times
    ``folds`` matrices, however many rows there are."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(fourier.phase) + 1
        total = np.zeros((folds, width, width + 1))
        for batch in batches:
            z, y, fold = fourier(_matrix(batch)), batch.column("y").to_numpy(), batch.column("fold").to_numpy()
            for k in range(folds):
                own = z[fold == k]
                total[k] += own.T @ np.column_stack([own, y[fold == k]])
        yield pa.RecordBatch.from_arrays([pa.array([t.tobytes() for t in total], pa.binary())], names=["sums"])

    width = len(fourier.phase) + 1
    total = np.zeros((folds, width, width + 1))
    for k, row in enumerate(train.repartition(_SUM_TASKS).mapInArrow(sums, "sums binary").toLocalIterator()):
        total[k % folds] += np.frombuffer(row.sums).reshape(width, width + 1)
    return total[:, :, :-1], total[:, :, -1]


def isotonic(lows: np.ndarray, good: np.ndarray, all_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over bins in ascending order: centre and value of each block, for interpolation."""
    blocks: list[list[float]] = []  # weighted sum of positions, good, all
    for low, g, n in zip(lows, good, all_):
        blocks.append([low * n, g, n])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


class Scorer:
    """A fitted model: scores for a matrix of statistics."""

    def __init__(self, fourier: Fourier | None = None, weights: np.ndarray | None = None, at=None, value=None):
        self.fourier, self.weights, self.at, self.value = fourier, weights, at, value

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if self.fourier is None:
            return np.full(len(x), 0.5)
        return np.interp(self.fourier(x) @ self.weights, self.at, self.value)


def fit(spark: SparkSession, train: DataFrame, folds: int = FOLDS, ridge: float = RIDGE) -> Scorer:
    """A scorer from rows (x array of statistics, y 0 or 1, fold), by sums only."""
    each = [F.col("x")[k] for k in range(STATISTICS)]
    moments = train.agg(F.count("*"), *(F.avg(c) for c in each), *(F.stddev_pop(c) for c in each)).first()
    if not moments[0]:
        return Scorer()
    mean, scale = np.array(moments[1 : STATISTICS + 1]), np.array(moments[STATISTICS + 1 :])
    fourier = Fourier(mean, np.where(scale > 1e-9, scale, 1.0))
    gram, target = normal_equations(train, fourier, folds)
    penalty = ridge * np.eye(gram.shape[1])
    penalty[-1, -1] = 1e-6

    def solve(used: list[int]) -> np.ndarray:
        return np.linalg.solve(gram[used].sum(0) + penalty, target[used].sum(0))

    left_out = np.array([solve([j for j in range(folds) if j != k]) for k in range(folds)])

    def unseen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = (fourier(_matrix(batch)) * left_out[batch.column("fold").to_numpy()]).sum(1)
            bins = np.clip((score - _LOW) / (_HIGH - _LOW) * _BINS, 0, _BINS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(bins), batch.column("y")], names=["bin", "y"])

    binned = train.mapInArrow(unseen, "bin int, y double").groupBy("bin").agg(F.sum("y").alias("good"), F.count("*").alias("n"))
    rows = sorted(binned.collect())  # at most _BINS
    lows = _LOW + (np.array([r.bin for r in rows]) + 0.5) * (_HIGH - _LOW) / _BINS
    at, value = isotonic(lows, np.array([r.good for r in rows]), np.array([r.n for r in rows]))
    return Scorer(fourier, solve(list(range(folds))), at, value)


def learn(spark: SparkSession, docs: DataFrame, labels: DataFrame, teaches: Column) -> tuple[Scorer, DataFrame]:
    """A scorer, and the written statistics (doc_id, x) of ``docs``. ``labels`` (doc_id, quality) teach where
    ``teaches``, a condition on doc_id, holds."""
    features = written(_features_of(docs), "quality-statistics")
    labelled = labels.where("doc_id is not null and quality is not null").where(teaches)
    train = features.join(labelled.select(F.col("doc_id").cast("bigint"), F.col("quality").cast("double").alias("y")), "doc_id")
    train = written(train.select("x", "y", F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int").alias("fold")), "quality-train")
    return fit(spark, train), features


def score(spark: SparkSession, docs: DataFrame, labels: DataFrame, teaches: Column) -> DataFrame:
    """(doc_id, score, predicted) for each row of ``docs``."""
    scorer, features = learn(spark, docs, labels, teaches)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = scorer(_matrix(batch)) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(value), pa.array((value >= THRESHOLD).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return features.mapInArrow(scored, "doc_id bigint, score double, predicted int")


def kept_documents(spark: SparkSession, docs: DataFrame, labels: DataFrame, teaches: Column) -> DataFrame:
    """``docs`` without those that the classifier rejects. The texts are scored where they lie; no row is shuffled."""
    scorer, _ = learn(spark, docs, labels, teaches)

    @F.arrow_udf("boolean")
    def good(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(scorer(np.array([statistics(t.as_py()) for t in texts])) >= THRESHOLD if len(texts) else [], pa.bool_())

    return docs.where(good("text"))

"""Quality scores: ridge regression on random Fourier features of document statistics, then isotonic calibration.

Each text becomes a few statistics (lengths, character classes, repetition). Random Fourier features approximate a
Gaussian kernel over them. Ridge weights solve the normal equations, which are sums over rows: each task adds up its
rows and sends one matrix per fold; the driver adds these and solves. Leaving a fold's sums out gives scores for that
fold's rows that did not see them; these, counted in bins, are the data of the isotonic fit (pool adjacent violators).

At most ``MAX_TRAIN`` labelled rows are learned from, chosen by a hash of the id where there are more; everything is
scored. The labelled ids are therefore of bounded size and reach the documents by broadcast, so no text is shuffled.

Cases: a null text is scored as an empty one. Labels that are null, or of documents not there, are not learned from;
a document with several labels counts with their mean. Without labelled rows every score is 1 (nothing is rejected);
with labels of one class only, every score is that class. Repeated documents each keep their row; in ``scored`` other
columns pass through and columns named ``score`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidegate.llm.common import any_names, column_of, quoted, ship, text_bytes, tidy, unused
from tidegate.session import written

MAX_TRAIN = 100_000
"""Most labelled rows that a model is fitted to."""

FIT_TASKS = 16
FOLDS = 4
DIMENSIONS = 192
RIDGE = 1.0
BINS = 2_048
THRESHOLD = 0.3

_UPPER = bytes(range(0x41, 0x5B))
_LOWER = bytes(range(0x61, 0x7B))
_DIGIT = bytes(range(0x30, 0x3A))
_SPACE = bytes([0x20, *range(0x09, 0x0E)])
_HIGH = bytes(range(0x80, 0x100))
_STOP = b".,;:!?"
_CLASSES = (_UPPER, _LOWER, _DIGIT, _SPACE, _HIGH, _STOP, b"!", b"|", b"#$%&*")

STATISTICS = len(_CLASSES) + 13


def statistics(text: bytes | None) -> list[float]:
    """Numbers that describe a whole text; all are finite."""
    text = text or b""
    size = max(len(text), 1)
    shares = [(len(text) - len(text.translate(None, c))) / size for c in _CLASSES]
    words = text.split()
    count = max(len(words), 1)
    distinct = len(set(words))
    again = sum(map(bytes.__eq__, words, words[1:]))
    lines = text.split(b"\n")
    long_lines = [x for x in lines if x]
    ends = sum(text.count(x + b" ") + text.count(x + b"\n") for x in (b"$", b"%", b"&", b"*", b"#", b"!"))
    sentences = text.count(b". ") + text.count(b".\n") + text.endswith(b".")
    caps = sum(map(bytes.isupper, words))
    titles = sum(map(bytes.istitle, words))
    longest = max(map(len, words), default=0)
    return [
        *shares,
        np.log1p(len(text)),
        np.log1p(len(words)),
        len(text) / count / 10,
        distinct / count,
        again / count,
        len(set(long_lines)) / max(len(long_lines), 1),
        np.log1p(len(lines)),
        np.log1p(size / len(lines)),
        ends / count,
        sentences / count,
        caps / count,
        titles / count,
        min(longest, 200) / 50,
    ]


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array([statistics(t) for t in text_bytes(column)], np.float64).reshape(-1, STATISTICS)


class Fourier:
    """``cos(Wx + b)`` features of standardised statistics, with a constant."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, seed: int = 7, width: float = 4.0):
        rng = np.random.default_rng(seed)
        self.mean, self.spread = mean, spread
        self.weights = rng.normal(size=(len(mean), DIMENSIONS)) / width
        self.shift = rng.uniform(0, 2 * np.pi, DIMENSIONS)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -6, 6)
        return np.hstack([np.cos(z @ self.weights + self.shift) * np.sqrt(2 / DIMENSIONS), np.ones((len(x), 1))])


def _statistics_step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = pa.array(list(_matrix(column_of(batch, "text"))), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays(
            [column_of(batch, "fold"), column_of(batch, "y"), x], names=["fold", "y", "x"]
        )


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    return np.array(column_of(batch, "x").to_pylist(), np.float64).reshape(-1, STATISTICS)


def _moments_step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((3, STATISTICS))
    for batch in batches:
        x = _rows(batch)
        total += [np.full(STATISTICS, len(x)), x.sum(0), (x * x).sum(0)]
    yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])


def _normal_step(fourier: Fourier):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = DIMENSIONS + 1
        sums = np.zeros((FOLDS, d, d + 1))
        for batch in batches:
            z, y = fourier(_rows(batch)), column_of(batch, "y").to_numpy(zero_copy_only=False)
            fold = column_of(batch, "fold").to_numpy(zero_copy_only=False)
            for k in range(FOLDS):
                own = z[fold == k]
                sums[k, :, :d] += own.T @ own
                sums[k, :, d] += own.T @ y[fold == k]
        yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary())], names=["sums"])

    return step


def _bins_step(fourier: Fourier, weights: np.ndarray):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, good = np.zeros(BINS), np.zeros(BINS)
        for batch in batches:
            fold = column_of(batch, "fold").to_numpy(zero_copy_only=False)
            y = column_of(batch, "y").to_numpy(zero_copy_only=False)
            at = bin_of((fourier(_rows(batch)) * weights[fold]).sum(1))
            count += np.bincount(at, minlength=BINS)
            good += np.bincount(at, weights=y, minlength=BINS)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(count[used]), pa.array(good[used])], names=["bin", "n", "y"]
        )

    return step


def bin_of(raw: np.ndarray) -> np.ndarray:
    return np.clip(((raw + 0.5) / 2 * BINS).astype(np.int64), 0, BINS - 1)


def isotonic(weights: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence nearest to ``values``, by pooling neighbours that violate the order."""
    blocks: list[list[float]] = []
    for w, v in zip(weights, values, strict=True):
        blocks.append([w, v, 1])
        while len(blocks) > 1 and blocks[-2][1] >= blocks[-1][1]:
            b, a = blocks.pop(), blocks.pop()
            blocks.append([a[0] + b[0], (a[0] * a[1] + b[0] * b[1]) / (a[0] + b[0]), a[2] + b[2]])
    return np.concatenate([np.full(int(n), v) for _, v, n in blocks]) if blocks else np.array([])


class Model:
    """Scores texts: Fourier features, ridge weights and the calibrated score of each bin of the raw score."""

    def __init__(self, fourier: Fourier | None, weights: np.ndarray | None, curve: np.ndarray):
        self.fourier, self.weights, self.curve = fourier, weights, curve

    def scores(self, column: pa.Array) -> np.ndarray:
        if self.fourier is None:
            return np.full(len(column), self.curve[0])
        return self.curve[bin_of(self.fourier(_matrix(column)) @ self.weights)]


def training_rows(documents: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """``fold, y, text`` of labelled documents outside the held-out fifth (crc32 of the id mod 5 = 0)."""
    usable = (
        labels.where("doc_id is not null and quality is not null and crc32(cast(doc_id as string)) % 5 != 0")
        .groupBy("doc_id")
        .agg(F.avg("quality").alias("y"))
    )
    count = usable.count()
    if count > max_train:
        share = int(max_train / count * 2**32 * 0.98)
        usable = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(2**32)) < share)
    usable = usable.select("doc_id", "y", (F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS * 7919)) % FOLDS).alias("fold"))
    # At most max_train rows of three numbers.
    return documents.select("doc_id", "text").join(F.broadcast(usable), "doc_id").select("fold", "y", "text")


def fit(documents: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    ship(documents.sparkSession)
    labelled = training_rows(documents, labels, max_train)
    rows = written(labelled.mapInArrow(tidy(_statistics_step), "fold long, y double, x array<double>"), "statistics")
    rows = rows.coalesce(FIT_TASKS)  # of bounded size: max_train rows
    sums = [np.frombuffer(r.sums).reshape(3, -1) for r in rows.mapInArrow(tidy(_moments_step), "sums binary").collect()]
    count, total, squares = sum(sums, np.zeros((3, STATISTICS)))
    if not count[0]:
        return Model(None, None, np.ones(1))
    classes = rows.agg(F.min("y"), F.max("y")).first()
    if classes[0] == classes[1]:
        return Model(None, None, np.full(1, float(classes[0])))
    mean = total / count
    spread = np.sqrt(np.maximum(squares / count - mean**2, 1e-12))
    fourier = Fourier(mean, np.where(spread < 1e-6, 1.0, spread))
    d = DIMENSIONS + 1
    parts = rows.mapInArrow(tidy(_normal_step(fourier)), "sums binary").collect()
    folds = sum((np.frombuffer(r.sums).reshape(FOLDS, d, d + 1) for r in parts), np.zeros((FOLDS, d, d + 1)))
    whole = folds.sum(0)

    def solve(m: np.ndarray) -> np.ndarray:
        return np.linalg.solve(m[:, :d] + RIDGE * np.eye(d), m[:, d])

    apart = np.array([solve(whole - folds[k]) for k in range(FOLDS)])
    bins = rows.mapInArrow(tidy(_bins_step(fourier, apart)), "bin long, n double, y double").groupBy("bin").agg(
        F.sum("n").alias("n"), F.sum("y").alias("y")
    )
    found = sorted(bins.collect())
    at, n, y = (np.array(c, np.float64) for c in zip(*found, strict=True))
    steps = isotonic(n, y / n)
    return Model(fourier, solve(whole), np.clip(np.interp(np.arange(BINS), at, steps), 0, 1))


@any_names
def scored(documents: DataFrame, model: Model, columns: list[str] | None = None, name: str = "score") -> DataFrame:
    """The documents, or the named columns, with their score as ``name``."""
    ship(documents.sparkSession)
    columns = [c for c in columns or documents.columns if c.lower() != name.lower()]
    kept = [documents.schema[c] for c in columns]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in kept] + [T.StructField(name, T.DoubleType())])
    arrow = to_arrow_schema(schema)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = pa.array(model.scores(column_of(batch, "text")), pa.float64())
            data = [column_of(batch, c).cast(arrow.field(c).type) for c in columns]
            yield pa.RecordBatch.from_arrays([*data, score], schema=arrow)

    return documents.select(*quoted(dict.fromkeys([*columns, "text"]))).mapInArrow(tidy(step), schema)


def report(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    model = fit(documents, labels)
    return scored(documents.select("doc_id", "text"), model, ["doc_id"]).select(
        "doc_id",
        (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


@any_names
def accepted(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the model does not reject."""
    name = unused("score", documents.columns)
    kept = scored(documents, fit(documents, labels), name=name).where(F.col(name) >= threshold)
    return kept.select(*quoted(documents.columns))

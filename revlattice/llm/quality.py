"""A quality classifier: random Fourier features of document statistics, ridge, isotonic.

Statistics of whole texts are standardised and mapped to random Fourier features, which
approximate a Gaussian kernel. Ridge scores come from normal equations summed by partition;
an isotonic curve turns them into probabilities.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlattice.session import store

#: Names of the document statistics, in the order of `statistics`.
STATISTICS = [
    "log_words", "log_bytes", "word_length", "word_length_spread", "distinct_words", "top_word", "same_as_next",
    "upper", "digits", "sentence_marks", "other_marks", "not_ascii", "words_with_marks", "words_of_marks",
    "distinct_lines", "words_per_line", "packed", "byte_entropy", "words_without_lower", "distinct_pairs",
]

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SENTENCE = np.zeros(256, bool)
_SENTENCE[[ord(c) for c in ".,;:?'\"-"]] = True
_ALL_MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_ALL_BUT_MARKS = bytes(b for b in range(33, 256) if b not in _ALL_MARKS)
_NOT_LOWER = bytes(range(33, 97)) + bytes(range(123, 127))
_MARK = np.array([33 <= b < 127 and not chr(b).isalnum() for b in range(256)]) & ~_SENTENCE


def statistics(text: str | None) -> list[float]:
    """STATISTICS of a whole text; all zero for null, empty and blank texts."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return [0.0] * len(STATISTICS)
    n, size = len(words), len(raw)
    counts = Counter(words)
    length = np.fromiter(map(len, words), np.float64, n)
    of_bytes = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = of_bytes[of_bytes > 0] / size
    lines = [x for x in raw.split(b"\n") if x.strip()]
    without = [len(raw.translate(None, gone).split()) for gone in (_ALL_BUT_MARKS, _ALL_MARKS, _NOT_LOWER)]
    return [
        float(np.log1p(n)),
        float(np.log1p(size)),
        float(length.mean()),
        float(length.std()),
        len(counts) / n,
        max(counts.values()) / n,
        sum(map(eq, words, words[1:])) / n,
        float(of_bytes[_UPPER].sum()) / size,
        float(of_bytes[_DIGIT].sum()) / size,
        float(of_bytes[_SENTENCE].sum()) / size,
        float(of_bytes[_MARK].sum()) / size,
        float(of_bytes[128:].sum()) / size,
        without[0] / n,
        1 - without[1] / n,
        len(set(lines)) / len(lines),
        float(np.log1p(n / len(lines))),
        len(zlib.compress(raw, 1)) / (size + 20),
        float(-(share * np.log2(share)).sum()),
        1 - without[2] / n,
        len(set(zip(words, words[1:], strict=False))) / n,
    ]


def statistics_column(text):
    @F.pandas_udf("array<double>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t) for t in texts], dtype=object)

    return of(text)


def held_out(doc_id, folds: int = 5):
    """Whether a row is kept from learning: crc32 of the id as text leaves 0 by `folds`."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 0, F.lit(True))


@dataclass
class QualityModel:
    """What scoring needs; its size does not grow with the documents."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    shift: np.ndarray
    coefficients: np.ndarray
    knots: np.ndarray
    values: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -8, 8)
        mapped = np.cos(z @ self.weights + self.shift) * np.sqrt(2 / len(self.shift))
        return np.hstack([mapped, np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.coefficients

    def score(self, stats: np.ndarray) -> np.ndarray:
        # Sums of floating numbers depend on the order of tasks in their last digits.
        return np.round(np.clip(np.interp(self.raw(stats), self.knots, self.values), 0, 1), 6)


def _stack(column: pd.Series) -> np.ndarray:
    return np.vstack([np.asarray(x, np.float64) for x in column])


def fit_quality(
    rows: DataFrame, labels: DataFrame, n_features: int = 256, ridge: float = 1e-4, seed: int = 17,
    fit_partitions: int = 32, bins: int = 2048,
) -> QualityModel:
    """Learn from `rows` (doc_id, stats) that are not held out and have a `labels.quality`.

    Every such row counts. The labelled statistics are dealt to `fit_partitions` tasks, each of
    which sends one matrix of `n_features`² sums. The isotonic curve is fitted to at most
    `bins` groups of equal rounded scores. Without labelled rows every score is 1.
    """
    marked = labels.select("doc_id", F.col("quality").cast("double").alias("y")).where("quality is not null")
    train = store(
        rows.where(~held_out("doc_id")).select("doc_id", "stats").join(marked, "doc_id").select("stats", "y")
        .repartition(fit_partitions),
        "quality-train",
    )
    k = len(STATISTICS)
    at = [F.col("stats")[i] for i in range(k)]
    sums = train.agg(F.count("*"), *[F.avg(c) for c in at], *[F.stddev_pop(c) for c in at]).first()
    rng = np.random.default_rng(seed)
    weights = rng.normal(size=(k, n_features)) / np.sqrt(k)
    shift = rng.uniform(0, 2 * np.pi, n_features)
    if not sums[0]:
        empty = np.zeros(n_features + 1)
        return QualityModel(np.zeros(k), np.ones(k), weights, shift, empty, np.array([0.0]), np.array([1.0]))
    scale = np.array(sums[1 + k :], float)
    model = QualityModel(
        np.array(sums[1 : 1 + k], float), np.where(scale > 1e-9, scale, 1.0), weights, shift, None, None, None
    )

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        xx, xy = np.zeros((n_features + 1, n_features + 1)), np.zeros(n_features + 1)
        for part in batches:
            if len(part):
                x, y = model.features(_stack(part["stats"])), part["y"].to_numpy()
                xx += x.T @ x
                xy += x.T @ y
        yield pd.DataFrame({"i": range(n_features + 1), "xx": list(xx), "xy": xy})

    # fit_partitions x n_features short rows, summed by matrix row.
    cells = train.mapInPandas(partial, "i int, xx array<double>, xy double")
    got = _sum_rows(cells).orderBy("i").toPandas()
    xx = _stack(got["xx"])
    penalty = ridge * sums[0] * np.eye(n_features + 1)
    penalty[-1, -1] = 0
    model.coefficients = np.linalg.solve(xx + penalty + 1e-9 * np.eye(n_features + 1), got["xy"].to_numpy())

    @F.pandas_udf("double")
    def raw(stats: pd.Series) -> pd.Series:
        return pd.Series(model.raw(_stack(stats))) if len(stats) else pd.Series(dtype=float)

    step = 4.0 / bins
    curve = (
        train.select(F.round(F.greatest(F.lit(-1.5), F.least(F.lit(2.5), raw("stats"))) / step).alias("bin"), "y")
        .groupBy("bin").agg(F.sum("y").alias("y"), F.count("*").alias("n")).orderBy("bin").toPandas()
    )
    model.knots = curve["bin"].to_numpy() * step
    model.values = isotonic(curve["y"].to_numpy() / curve["n"].to_numpy(), curve["n"].to_numpy())
    return model


def _sum_rows(cells: DataFrame) -> DataFrame:
    """Sum the arrays of equal `i` element by element; one group is as long as partitions."""

    def add(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": part["i"][:1], "xx": [_stack(part["xx"]).sum(axis=0)], "xy": part["xy"].sum()})

    return cells.groupBy("i").applyInPandas(add, "i int, xx array<double>, xy double")


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The rising curve closest to `values` by weighted squares (pool adjacent violators)."""
    level: list[list[float]] = []
    for value, weight in zip(values, weights, strict=True):
        level.append([value, weight, 1])
        while len(level) > 1 and level[-2][0] >= level[-1][0]:
            v, w, n = level.pop()
            level[-1] = [(level[-1][0] * level[-1][1] + v * w) / (level[-1][1] + w), level[-1][1] + w, level[-1][2] + n]
    return np.concatenate([np.full(n, v) for v, _, n in level])


def with_score(rows: DataFrame, model: QualityModel) -> DataFrame:
    """`rows` (stats, ...) with `score`."""

    @F.pandas_udf("double")
    def score(stats: pd.Series) -> pd.Series:
        return pd.Series(model.score(_stack(stats))) if len(stats) else pd.Series(dtype=float)

    return rows.withColumn("score", score("stats"))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **fit) -> DataFrame:
    """Per row of `docs` (doc_id, text): doc_id, held_out, score (0 to 1) and predicted (0 or 1).

    Only whole texts are scored; other columns are ignored. Null, empty and blank texts have
    statistics of zero and are scored by them. Rows without a doc_id are held out. Labels with
    a null id or quality teach nothing; repeated labels count as often as they come.
    """
    rows = store(docs.select("doc_id", statistics_column("text").alias("stats")), "quality-stats")
    model = fit_quality(rows, labels, **fit)
    return with_score(rows, model).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **fit) -> DataFrame:
    """The rows of `docs` whose text scores `threshold` or more, with all their columns."""
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")
    packed = store(docs.select(row, statistics_column(docs["text"]).alias("stats")), "quality-docs")
    model = fit_quality(packed.select("row.doc_id", "stats"), labels, **fit)
    return with_score(packed, model).where(F.col("score") >= threshold).select("row.*")

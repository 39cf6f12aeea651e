"""Quality by regularised quadratic discriminant analysis of document statistics.

Each text becomes a short vector of transformed statistics (logarithms of sizes, arcsine roots of
ratios). Both classes are normal densities; their covariances are shrunk towards the pooled one and
towards its diagonal. The score is a logistic function of the difference of the two log densities, which
needs one triangular solve per class with Cholesky factors that are computed once and sent to the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstrata.llm.common import stored
from shopstrata.llm.labelled import held_out, training_labels
from shopstrata.llm.spotsigs import ANCHORS

# Most labelled rows that the model is fitted on.
SAMPLE = 50_000
POOLED = 0.1
DIAGONAL = 0.05
MODULUS, REMAINDER = 5, 0
CUT = 0.3

# Kinds of bytes: 1 lower-case letter, 2 upper-case letter, 3 digit, 4 mark, 5 end of a sentence, 6 white space,
# 7 part of a character beyond ASCII.
_KIND = np.full(256, 4, np.uint8)
_KIND[list(range(97, 123))] = 1
_KIND[list(range(65, 91))] = 2
_KIND[list(range(48, 58))] = 3
_KIND[[ord(c) for c in ".,;:?"]] = 5
_KIND[[9, 10, 11, 12, 13, 32]] = 6
_KIND[128:] = 7
FEATURES = (
    "words", "word_length", "line_length", "upper", "digits", "marks", "sentence_marks", "anchors",
    "different_words", "different_lines", "marked_words", "beyond_ascii", "longest_word",
)


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of a whole text; a null text counts as empty."""
    text = text or ""
    raw = text.encode()
    words = text.split()
    lines = [line for line in text.split("\n") if line.strip()]
    kinds = np.bincount(_KIND[np.frombuffer(raw, np.uint8)], minlength=8)
    visible = max(1, len(raw) - int(kinds[6]))
    letters = max(1, int(kinds[1] + kinds[2] + kinds[7]))
    n, m = max(1, len(words)), max(1, len(lines))
    known = sum(w in ANCHORS for w in text.lower().split())

    def ratio(part: float, whole: float) -> float:
        return float(np.arcsin(np.sqrt(min(1.0, part / whole))))

    return [
        float(np.log1p(len(words))),
        float(np.log1p(visible / n)),
        float(np.log1p(len(words) / m)),
        ratio(kinds[2], letters),
        ratio(kinds[3], visible),
        ratio(kinds[4], visible),
        ratio(kinds[5], visible),
        ratio(known, n),
        ratio(len(set(words)), n),
        ratio(len(set(lines)), m),
        ratio(sum(not (w[-1].isalnum() or w[-1] in ".,;:?") for w in words), n),
        ratio(kinds[7], visible),
        float(np.log1p(max(map(len, words), default=0))),
    ]


def with_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, x) with the statistics of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.float64()))], ["doc_id", "x"]
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, x array<double>")


@dataclass
class Model:
    """Means, inverse Cholesky factors and log determinants of both classes, and the calibration."""

    means: np.ndarray
    whiten: np.ndarray
    constants: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 minus that of class 0 (with priors) for the rows of ``x``."""
        logs = []
        for k in (0, 1):
            z = (x - self.means[k]) @ self.whiten[k].T
            logs.append(self.constants[k] - 0.5 * np.einsum("ij,ij->i", z, z))
        return logs[1] - logs[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        odds = np.clip(self.slope * self.difference(x) + self.offset, -500, 500)
        return 1.0 / (1.0 + np.exp(-odds))


def fit(x: np.ndarray, y: np.ndarray, pooled: float = POOLED, diagonal: float = DIAGONAL) -> Model | float:
    """The model of the rows ``x`` with labels ``y``, or their share of ones where a class is missing."""
    if len(set(y.tolist())) < 2:
        return float(y.mean()) if len(y) else 0.5
    groups = [x[y == k] for k in (0, 1)]
    means = np.array([g.mean(0) for g in groups])
    spread = [np.cov(g, rowvar=False, bias=True) for g in groups]
    shared = sum(len(g) * s for g, s in zip(groups, spread)) / len(x)
    scale = np.diag(shared) + 1e-4
    whiten, constants = [], []
    for g, s in zip(groups, spread):
        # Few rows of a class lean more on the other ones.
        weight = pooled + (1 - pooled) * x.shape[1] / (x.shape[1] + len(g))
        s = (1 - weight) * s + weight * shared
        s = (1 - diagonal) * s + diagonal * np.diag(scale)
        factor = np.linalg.cholesky(s)
        whiten.append(np.linalg.inv(factor))
        constants.append(np.log(len(g) / len(x)) - np.log(np.diag(factor)).sum())
    model = Model(means, np.array(whiten), np.array(constants))
    # Log densities of dependent statistics overstate; a logistic fit in one variable sets them right.
    d = np.clip(model.difference(x), -60, 60)
    a, b = 0.1, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-(a * d + b)))
        w = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((p - y) * d).sum() + 0.1 * a, (p - y).sum()])
        h = np.array([[(w * d * d).sum() + 0.1, (w * d).sum()], [(w * d).sum(), w.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2.0 / np.abs(step).max()) if np.abs(step).max() else 0.0
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    model.slope, model.offset = max(float(a), 1e-6), float(b)
    return model


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    column: str = "quality",
    modulus: int = MODULUS,
    remainder: int = REMAINDER,
    cut: float = CUT,
    sample: int = SAMPLE,
) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs`` (doc_id, text).

    Labels of rows whose id has crc32 modulo ``modulus`` equal to ``remainder`` are not looked at. The model is
    fitted on at most ``sample`` labelled rows; every text is scored whole, empty and null ones as well.
    Where the labels have one class only, all scores are its value; without labels they are 0.5. A null
    doc_id is not held out. Repeated rows are scored alike, an empty table gives an empty result.
    """
    vectors = stored(with_statistics(docs))
    chosen = training_labels(labels, column, modulus, remainder, sample)
    # One row per id, that with the smallest vector: at most ``sample`` rows reach the driver.
    rows = vectors.join(chosen, "doc_id").groupBy("doc_id", "label").agg(F.min("x").alias("x")).collect()
    x = np.array([r["x"] for r in rows]).reshape(len(rows), len(FEATURES))
    model = fit(x, np.array([r["label"] for r in rows], float))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, len(FEATURES))
            found = np.full(batch.num_rows, model) if isinstance(model, float) else model.score(points)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])

    scored = vectors.mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id",
        held_out(modulus, remainder).alias("held_out"),
        "score",
        (F.col("score") >= cut).cast("int").alias("predicted"),
    )

"""Quality scores: random Fourier features, ridge regression, isotonic calibration.

Every document becomes a row of statistics of its whole text.  Standardised statistics
go through ``FOURIER`` random cosines, whose products approximate a Gaussian kernel.  Each
task adds up the normal equations of its labelled rows, the sums of all tasks are added
by matrix row, and one small system is solved.  Scores are then calibrated by isotonic
regression on the labelled rows, summed by ``STEPS`` equal steps of the raw score.

Labelled rows are all used; what reaches the driver is one matrix of fixed size and one
sum per step.

Defined results: a null text counts as empty and has a score like any other; several
labels of an id are averaged; labels without a document, or null ones, are left out; with
no label at all every score is 0.5; equal texts get equal scores; an empty table gives an
empty table; other columns pass through.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadloom.llm.common import column_or, in_batches
from leadloom.session import cut_lineage

FOURIER = 192
BANDWIDTH = 3.0
RIDGE = 1e-3
STEPS = 2048
#: A document is kept if its score reaches this value.
KEEP = 0.3

_UPPER = bytes(range(65, 91))
_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))
_DIGITS = bytes(range(48, 58))
_SPACE = b" \t\n\x0b\x0c\r"
_PLAIN = b".,;:'\"?-()"
STATISTICS = (
    "log_bytes",
    "log_words",
    "word_length",
    "letters",
    "upper",
    "digits",
    "plain_marks",
    "other_marks",
    "bangs",
    "bars",
    "distinct_words",
    "top_word",
    "repeated_neighbours",
    "log_lines",
    "distinct_lines",
    "line_length",
)


def statistics(text: str) -> list[float]:
    """Shares and logarithms that describe a whole text, in the order of ``STATISTICS``."""
    raw = text.encode("utf-8", "surrogatepass")
    size = len(raw)
    whole = max(size, 1)
    words = raw.lower().split()
    count = max(len(words), 1)
    letters = size - len(raw.translate(None, _LETTERS))
    digits = size - len(raw.translate(None, _DIGITS))
    marks = raw.translate(None, _LETTERS + _DIGITS + _SPACE)
    other = len(marks.translate(None, _PLAIN))
    seen = Counter(words)
    lines = raw.split(b"\n")
    return [
        float(np.log1p(size)),
        float(np.log1p(len(words))),
        min((size - len(words)) / count, 50.0),
        letters / whole,
        (size - len(raw.translate(None, _UPPER))) / whole,
        digits / whole,
        (len(marks) - other) / whole,
        other / whole,
        raw.count(b"!") / count,
        raw.count(b"|") / count,
        len(seen) / count,
        max(seen.values(), default=0) / count,
        sum(map(bytes.__eq__, words, words[1:])) / count,
        float(np.log1p(len(lines))),
        len(set(lines)) / len(lines),
        float(np.log1p(size / len(lines))),
    ]


@dataclass
class Model:
    """Means and deviations of the statistics, the random cosines, weights and calibration."""

    mean: np.ndarray
    deviation: np.ndarray
    weights: np.ndarray | None = None
    raw_steps: np.ndarray | None = None
    calibrated: np.ndarray | None = None

    def features(self, rows: np.ndarray) -> np.ndarray:
        """Random Fourier features and a constant."""
        draw = np.random.default_rng(20240)
        slopes = draw.normal(size=(rows.shape[1], FOURIER)) / BANDWIDTH
        shifts = draw.uniform(0, 2 * np.pi, FOURIER)
        plain = np.clip((rows - self.mean) / self.deviation, -5, 5)
        waves = np.sqrt(2 / FOURIER) * np.cos(plain @ slopes + shifts)
        return np.hstack([waves, np.ones((len(rows), 1))])

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return self.features(rows) @ self.weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        if self.weights is None or not len(rows):
            return np.full(len(rows), 0.5)
        return np.interp(self.raw(rows), self.raw_steps, self.calibrated)


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id and the statistics of each row, as a written table."""
    schema = T.StructType([docs.schema["doc_id"], T.StructField("stats", T.ArrayType(T.FloatType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_batches(batches, 2000):
            rows = [statistics(x) for x in column_or(batch, text)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float32()))], names=["doc_id", "stats"])

    return cut_lineage(docs.select("doc_id", text).mapInArrow(run, schema))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index("stats"))
    return np.asarray(column.flatten(), np.float64).reshape(batch.num_rows, len(STATISTICS))


def fit(stats: DataFrame, labels: DataFrame) -> Model:
    """Train on all rows of ``stats`` whose doc_id has a label (doc_id, label of 0 to 1)."""
    each = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull())
        .groupBy(F.col("doc_id").alias("of"))
        .agg(F.avg(F.col("label").cast("double")).alias("label"))
    )
    rows = cut_lineage(stats.join(each, F.col("doc_id") == F.col("of")).select("stats", "label"))
    width = len(STATISTICS)
    moments = rows.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.avg(F.col("stats")[i].cast("double")).alias(f"mean_{i}") for i in range(width)],
        *[F.stddev_pop(F.col("stats")[i].cast("double")).alias(f"dev_{i}") for i in range(width)],
    ).first()
    if not moments["rows"]:
        return Model(np.zeros(width), np.ones(width))
    model = Model(
        np.array([moments[f"mean_{i}"] for i in range(width)]),
        np.array([max(moments[f"dev_{i}"], 1e-6) for i in range(width)]),
    )
    size = FOURIER + 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for batch in batches:
            x = model.features(_matrix(batch))
            y = np.asarray(batch.column(batch.schema.get_field_index("label")), np.float64)
            total += x.T @ np.hstack([x, y[:, None]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(size), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["row", "part"]
        )

    parts = rows.mapInArrow(sums, "row int, part array<double>")
    added = parts.select("row", F.posexplode("part").alias("column", "value")).groupBy("row", "column").agg(F.sum("value").alias("value"))
    system = np.zeros((size, size + 1))
    for cell in added.collect():  # (FOURIER + 1) * (FOURIER + 2) numbers
        system[cell["row"], cell["column"]] = cell["value"]
    penalty = np.eye(size) * RIDGE * moments["rows"] / size
    penalty[-1, -1] = 0.0
    model.weights = np.linalg.solve(system[:, :size] + penalty, system[:, size])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.clip(model.raw(_matrix(batch)), -0.5, 1.5)
            step = np.rint((raw + 0.5) / 2 * STEPS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(step), batch.column(batch.schema.get_field_index("label"))], names=["step", "label"])

    by_step = rows.mapInArrow(scored, "step int, label double").groupBy("step").agg(F.count(F.lit(1)).alias("rows"), F.sum("label").alias("good"))
    steps = sorted(by_step.collect(), key=lambda r: r["step"])  # at most STEPS + 1 rows
    model.raw_steps = np.array([r["step"] / STEPS * 2 - 0.5 for r in steps])
    model.calibrated = isotonic([r["good"] for r in steps], [r["rows"] for r in steps])
    return model


def isotonic(good: list[float], rows: list[int]) -> np.ndarray:
    """The non-decreasing shares closest to ``good / rows``, by pooling neighbours that fall."""
    pools: list[list[float]] = []
    for g, n in zip(good, rows, strict=True):
        pools.append([g, n, 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            g2, n2, k2 = pools.pop()
            pools[-1] = [pools[-1][0] + g2, pools[-1][1] + n2, pools[-1][2] + k2]
    return np.concatenate([np.full(int(k), min(max(g / n, 0.0), 1.0)) for g, n, k in pools])


def score_measured(stats: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of measured rows."""
    schema = T.StructType([stats.schema["doc_id"], T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(_matrix(batch)), pa.float64())], names=["doc_id", "score"])

    return stats.select("doc_id", "stats").mapInArrow(run, schema)


def score(docs: DataFrame, model: Model, text: str = "text", to: str = "quality_score") -> DataFrame:
    """All columns of ``docs`` and the score."""
    kept = [c for c in docs.columns if c != to]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(to, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_batches(batches, 2000):
            rows = np.array([statistics(x) for x in column_or(batch, text)], np.float32).astype(np.float64)
            columns = [batch.column(i) for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(model.score(rows.reshape(-1, len(STATISTICS))), pa.float64())], names=[*kept, to])

    return docs.select(*kept).mapInArrow(run, schema)

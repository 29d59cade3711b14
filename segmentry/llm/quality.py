"""Document quality by a regularised quadratic discriminant over document statistics.

Each class of labelled documents gives a mean and a covariance of the transformed statistics; the
covariance is shrunk towards the pooled one and a multiple of the identity.  Its Cholesky factor is computed once,
and a document's score compares the two Mahalanobis log densities.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmentry.llm.common import text_or_empty, written

#: Statistics of a text, in this order.
STATISTICS = (
    ["log_bytes", "log_words", "upper", "digit", "blank", "line_break", "stop", "mark", "bang", "bar", "other"]
    + ["word_length", "distinct_words", "repeated_lines", "top_line", "line_length", "top_word"]
)
#: Bytes of average text that a share is smoothed with, so that short texts tell little.
SMOOTHING = 40.0
#: Weights of the pooled covariance and of the identity in a class covariance.
POOLED, RIDGE = 0.3, 0.05
#: Standard deviations of the pooled statistics beyond which a value counts no more.
REACH = 4.0
#: Divides the log density difference; statistics of a text overlap in what they say.
TEMPERATURE = 2.0
THRESHOLD = 0.3

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "blank": b" \t\r\x0b\x0c",
    "line_break": b"\n",
    "stop": b".,;:?'\"()-",
    "mark": b"*#$%&@^~+=<>{}[]\\/_`",
    "bang": b"!",
    "bar": b"|",
}
#: Shares expected of average text, for smoothing.
_USUAL = {"upper": 0.01, "digit": 0.002, "blank": 0.14, "line_break": 0.004, "stop": 0.02, "mark": 0.001, "bang": 0.0, "bar": 0.0, "other": 0.0}


def statistics(text: str) -> list[float]:
    raw = text.encode("utf-8", "surrogatepass")
    n = len(raw)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = {k: (counts[list(v)].sum() + SMOOTHING * _USUAL[k]) / (n + SMOOTHING) for k, v in _CLASSES.items()}
    control = counts[:9].sum() + counts[14:32].sum() + counts[127]
    share["other"] = control / (n + SMOOTHING)
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x]
    m, seen = len(words), len(set(words))
    most = 0
    if m:
        most = max(map(words.count, set(words))) if m < 40 else int(np.unique(np.fromiter(map(hash, words), np.int64, m), return_counts=True)[1].max())
    tally: dict[bytes, int] = {}
    for x in lines:
        tally[x] = tally.get(x, 0) + 1
    k = len(lines)
    return [
        np.log1p(n),
        np.log1p(m),
        *(np.sqrt(share[c]) for c in STATISTICS[2:11]),
        (n - counts[list(_CLASSES["blank"])].sum() + 6 * 8) / (m + 8) ** 1.0,
        (seen + 8) / (m + 8) ** 0.9,
        np.sqrt((k - len(tally)) / (k + 2)),
        np.sqrt((max(tally.values(), default=1) - 1) / (k + 2)),
        np.log1p((n + 100) / (k + 1)),
        np.sqrt((most + 1) / (m + 20)),
    ]


def described(docs: DataFrame) -> DataFrame:
    """``(doc_id, x)`` with the statistics of every whole text; rows stay rows, null texts are empty."""
    schema = pa.schema([("doc_id", pa.int64()), ("x", pa.list_(pa.float64()))])

    def describe(batches):
        for batch in batches:
            values = [statistics(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, schema.field("x").type)], schema=schema)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(describe, "doc_id bigint, x array<double>")


@dataclass
class Discriminant:
    """Centre and scale of the statistics, and per class: mean, inverse Cholesky factor, constant."""

    centre: np.ndarray
    scale: np.ndarray
    means: list[np.ndarray]
    factors: list[np.ndarray]
    constants: list[float]

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.centre) / self.scale, -REACH, REACH)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row of statistics."""
        z = self.scaled(x)
        low, high = (c - 0.5 * (((z - m) @ f.T) ** 2).sum(axis=1) for m, f, c in zip(self.means, self.factors, self.constants))
        return 1 / (1 + np.exp(np.clip((low - high) / TEMPERATURE, -500, 500)))


def _moments(rows: DataFrame, by: list[str], z: list) -> list:
    """Count, means and second moments; aggregated map-side, one row per class."""
    d = len(z)
    named = rows.select(*by, *(c.alias(f"z{i}") for i, c in enumerate(z)))
    sums = [F.avg(f"z{i}").alias(f"m{i}") for i in range(d)]
    sums += [F.avg(F.col(f"z{i}") * F.col(f"z{j}")).alias(f"c{i}_{j}") for i in range(d) for j in range(i, d)]
    return named.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *sums).collect()


def _of(row, d: int) -> tuple[int, np.ndarray, np.ndarray]:
    mean = np.array([row[f"m{i}"] for i in range(d)])
    second = np.array([[row[f"c{min(i, j)}_{max(i, j)}"] for j in range(d)] for i in range(d)])
    return row["n"], mean, second - np.outer(mean, mean)


def fit(rows: DataFrame, pooled: float = POOLED, ridge: float = RIDGE) -> Discriminant:
    """Fit on all of ``rows(quality, x)``; two passes over numbers, no row reaches the driver.

    With fewer than two rows of a class, that class has the pooled covariance, and the pooled
    mean if it has none.
    """
    d = len(STATISTICS)
    x = [F.get("x", F.lit(i)) for i in range(d)]
    total = _moments(rows, [], x)[0]
    if not total["n"]:
        one = np.ones(d)
        return Discriminant(0 * one, one, [0 * one] * 2, [np.eye(d)] * 2, [0.0, 0.0])
    _, centre, spread = _of(total, d)
    scale = np.sqrt(np.maximum(np.diag(spread), 1e-6))
    z = [F.least(F.greatest((c - F.lit(float(m))) / F.lit(float(s)), F.lit(-REACH)), F.lit(REACH)) for c, m, s in zip(x, centre, scale)]
    found = {r["quality"]: _of(r, d) for r in _moments(rows, ["quality"], z)}
    n = sum(k for k, _, _ in found.values())
    within = sum(k * c for k, _, c in found.values()) / n
    middle = sum(k * m for k, m, _ in found.values()) / n
    means, factors, constants = [], [], []
    for label in (0, 1):
        k, mean, own = found.get(label, (0, middle, within))
        own = within if k < 2 else own
        cov = (1 - pooled - ridge) * own + pooled * within + ridge * np.eye(d) * max(np.trace(own) / d, 1e-3)
        lower = np.linalg.cholesky(cov)
        means.append(mean)
        factors.append(np.linalg.inv(lower))
        constants.append(float(np.log((k + 1) / (n + 2)) - np.log(np.diag(lower)).sum()))
    return Discriminant(centre, scale, means, factors, constants)


def score(described_docs: DataFrame, model: Discriminant, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, score, predicted)`` of ``(doc_id, x)``."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32())])

    def judge(batches):
        for batch in batches:
            if batch.num_rows:
                x = np.array(batch.column(1).flatten()).reshape(batch.num_rows, -1)
                p = model.scores(x)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p), pa.array((p >= threshold).astype(np.int32))], schema=schema)

    return described_docs.select("doc_id", "x").mapInArrow(judge, "doc_id bigint, score double, predicted int")


def held_out(doc_id="doc_id"):
    """Rows that are never learned from: crc32 of the id's digits divisible by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row of ``docs(doc_id, text)``.

    Learns from ``labels(doc_id, quality)`` with quality 0 or 1 of documents that aren't held out; other
    labels are ignored, and a document counts once per label row.  Texts alone are scored: null ones as
    empty, a null ``doc_id`` is not held out.  Without labels all scores are the same.
    """
    stats = written(described(docs), "statistics")
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.where(F.col("quality").isin(0, 1) & ~held_out())
    model = fit(stats.join(known, "doc_id").select("quality", "x"))
    return score(stats, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")

"""A quality classifier: random Fourier features of document statistics, ridge regression, isotonic calibration.

The features cos(w.x + b), with normal w and uniform b, approximate a Gaussian kernel over the standardised statistics. The
normal equations are summed by partition and solved on the driver; their size is that of the features. Scores of labelled
documents that the regression hasn't seen are then calibrated by an isotonic fit.
"""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

FEATURES, RIDGE, SEED, ACCEPT = 256, 1e-4, 5, 0.7
#: Labelled rows that the fit takes at most, about; a hash of the id chooses them. The partitions that sum them.
SAMPLE, SUMS = 200_000, 16
STATISTICS = 18
UPPER, LOWER, DIGIT, SPACE = (np.zeros(256, bool) for _ in range(4))
UPPER[65:91], LOWER[97:123], DIGIT[48:58], SPACE[[32, *range(9, 14)]] = True, True, True, True
HIGH = np.arange(256) >= 128
SIGN = ~(UPPER | LOWER | DIGIT | SPACE | HIGH)


def statistics(text: str | None) -> list[float]:
    """Of a whole text; an empty one, or null, has its own point."""
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return [0.0] * (STATISTICS - 1) + [1.0]
    count = np.bincount(np.frombuffer(raw, "u1"), minlength=256)
    n, m = len(raw), len(words)
    upper, lower, digit, sign = (int(count[x].sum()) for x in (UPPER, LOWER, DIGIT, SIGN))
    often = Counter(words)
    lines = [x for x in raw.split(b"\n") if x]
    first = max(often.values())
    entropy = 0.0
    if m > 1:
        c = np.fromiter(often.values(), float, len(often)) / m
        entropy = float(-(c * np.log(c)).sum() / np.log(m))
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    return [
        float(np.log1p(m)),
        n / m,
        upper / n,
        lower / n,
        digit / n,
        sign / n,
        count[124] / m,
        (count[35] + count[36] + count[37] + count[38] + count[42]) / m,
        count[33] / m,
        (count[44] + count[46]) / m,
        len(often) / m,
        first / m,
        entropy,
        same / m,
        1 - len(set(lines)) / max(1, len(lines)),
        float(np.log1p(m / max(1, len(lines)))),
        upper / max(1, upper + lower),
        0.0,
    ]


def held_out(doc_id) -> int:
    """crc32 of the id's decimal text, mod 4; of an empty text for a null id."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 4


def _table(batch: pa.RecordBatch) -> np.ndarray:
    return np.array([statistics(t) for t in batch.column(1).to_pylist()], float).reshape(-1, STATISTICS)


class Model:
    def __init__(self, center, scale, weights=None, steps=None):
        rng = np.random.default_rng(SEED)
        self.center, self.scale = center, scale
        self.w = rng.normal(0, 1 / np.sqrt(STATISTICS), (STATISTICS, FEATURES))
        self.b = rng.uniform(0, 2 * np.pi, FEATURES)
        self.weights, self.steps = weights, steps

    def features(self, x: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.center) / self.scale, -8, 8)
        return np.hstack([np.sqrt(2 / FEATURES) * np.cos(x @ self.w + self.b), np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated, with a small share of the raw value so that scores keep their order within a step."""
        raw = np.clip(self.raw(x), -0.5, 1.5)
        at, to = self.steps
        return np.clip(np.interp(raw, at, to) * 0.98 + 0.01 * (raw + 0.5), 0, 1).round(6)


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators over ascending x: the blocks' mean x and mean y."""
    blocks: list[list[float]] = []
    for a, b, c in zip(x, y, w, strict=True):
        blocks.append([a * c, b * c, c])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last, strict=True)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def _sums(rows: DataFrame, of, size: int) -> np.ndarray:
    """Adds up of(statistics, label), an array of `size` doubles, over all rows: one array a partition, SUMS at most."""

    def run(batches):
        total = np.zeros(size)
        for batch in batches:
            x = np.array(batch.column(0).flatten().to_numpy(zero_copy_only=False)).reshape(-1, STATISTICS)
            total += of(x, batch.column(1).to_numpy().astype(float)).ravel()
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["total"])

    parts = rows.select("x", "y").coalesce(SUMS).mapInArrow(run, "total binary").collect()
    return np.sum([np.frombuffer(r["total"]) for r in parts], axis=0) if parts else np.zeros(size)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learns from the labelled documents that aren't held out. Three of the four parts of the ids are numbered 0, 1
    and 3: the regression takes 0 and 1, the calibration 3. Without labels of both kinds every score is their share."""
    part = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(4))
    known = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.avg("quality").alias("y"))
    known = known.select("doc_id", (F.col("y") >= 0.5).cast("double").alias("y"), part.alias("part")).where("part <> 2")
    share = min(1.0, SAMPLE / max(1, known.count()))
    known = known.where(F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20))))
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(known), "doc_id")

    def measure(batches):
        for batch in batches:
            x = pa.array(list(_table(batch)), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([x, batch.column(2), batch.column(3)], ["x", "y", "part"])

    seen = saved(chosen.select("doc_id", "text", "y", F.col("part").cast("int").alias("part")).mapInArrow(measure, "x array<double>, y double, part int"))
    train, tune = seen.where("part < 2"), seen.where("part = 3")
    d = STATISTICS
    moments = _sums(train, lambda x, y: np.concatenate([[len(x), y.sum()], x.sum(0), (x * x).sum(0)]), 2 + 2 * d)
    n, ones = moments[0], moments[1]
    if not n or ones in (0, n):
        model = Model(np.zeros(d), np.ones(d), np.zeros(FEATURES + 1))
        model.steps = (np.array([0.0]), np.array([ones / n if n else 0.5]))
        return model
    center = moments[2 : 2 + d] / n
    scale = np.sqrt(np.maximum(moments[2 + d :] / n - center**2, 1e-12))
    scale[scale < 1e-5] = 1.0
    model, f = Model(center, scale), FEATURES + 1

    def equations(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = model.features(x)
        # Both labels weigh the same.
        w = np.where(y > 0.5, 0.5 / ones, 0.5 / (n - ones))
        return np.concatenate([(z.T @ (z * w[:, None])).ravel(), z.T @ (w * y)])

    found = _sums(train, equations, f * f + f)
    model.weights = np.linalg.solve(found[: f * f].reshape(f, f) + RIDGE * np.eye(f), found[f * f :])
    bins = 400

    def histogram(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        raw = np.clip(model.raw(x), -0.5, 1.5)
        at = np.minimum((raw + 0.5) * bins / 2, bins - 1).astype(int)
        return np.concatenate([np.bincount(at, w, bins) for w in (np.ones(len(x)), raw, y)])

    total, raw, good = _sums(tune, histogram, 3 * bins).reshape(3, bins)
    at = total > 0
    if at.any():
        model.steps = isotonic(raw[at] / total[at], good[at] / total[at], total[at])
    else:
        model.steps = (np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    return model


def scores(docs: DataFrame, model: Model, score_name: str = "score", predicted_name: str = "predicted") -> DataFrame:
    """docs with a score and a prediction added under names that docs doesn't have; statistics are of the whole text, however
    long. Null and empty texts share one point. Other columns may have any names."""
    names = docs.columns
    text = names.index("text")
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names) + f", `{score_name}` double, `{predicted_name}` int"

    def run(batches):
        for batch in batches:
            score = model.score(np.array([statistics(t) for t in batch.column(text).to_pylist()], float).reshape(-1, STATISTICS))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score), pa.array((score >= ACCEPT).astype("i4"))], [*names, score_name, predicted_name])

    return docs.select(*[f"`{c}`" for c in names]).mapInArrow(run, schema)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row a document: held_out, score (0 to 1, higher is better) and predicted (1 from ACCEPT on).

    Null and empty texts share one point of the statistics and are scored like any other. Repeated rows get equal
    scores. A null doc_id is never labelled. No rows give none; with no labels every score is 0.5.
    """
    scored = scores(docs.select("doc_id", "text"), fit(docs, labels))
    part = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(4))
    return scored.select("doc_id", (part == 2).alias("held_out"), "score", "predicted")

"""Outside models on columns: loaded once a worker, called a batch at a time. Scores of vectors without a model."""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import bound


def per_worker(load: Callable[[], object], predict: Callable[[object, pd.Series], pd.Series], returns: str):
    """A column function: load() runs once in each worker process, predict(model, batch) on each batch."""

    @F.pandas_udf(returns)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for batch in batches:
            yield predict(model, batch)

    return run


def tags_above(scores: Column, least: float) -> Column:
    """Names of a map from tag to score whose score is at least that, best first."""
    kept = F.filter(F.map_entries(scores), lambda e: e["value"] >= least)
    best = F.array_sort(F.transform(kept, lambda e: F.struct((-e["value"]).alias("s"), e["key"].alias("k"))))
    return F.array_join(F.transform(best, lambda e: e["k"]), ", ")


def best_label(scores: Column) -> Column:
    """The name with the highest score of a map; of equals the first by name."""
    ranked = F.array_sort(F.transform(F.map_entries(scores), lambda e: F.struct((-e["value"]).alias("s"), e["key"].alias("k"))))
    return F.get(ranked, F.lit(0))["k"]


def class_of(labels: Column, classes: dict[str, list[str]], default: str = "") -> Column:
    """The first of the classes of which the array holds any label; the default if none, or for a null array."""
    found = F.lit(default)
    for name, members in reversed(classes.items()):
        found = F.when(F.arrays_overlap(labels, F.array(*[F.lit(m) for m in members])), F.lit(name)).otherwise(found)
    return found


def linear_score(vector: Column, weights: list[float], bias: float = 0.0) -> Column:
    """weights . vector / |vector| + bias, in double precision; null for a zero vector."""
    w = F.array(*[F.lit(float(x)) for x in weights])
    dot = F.aggregate(F.zip_with(vector, w, lambda a, b: a.cast("double") * b), F.lit(0.0), lambda a, x: a + x)
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    return F.when(norm > 0, dot / norm + bias)


def layered_score(vector: Column, layers: list[tuple[list[list[float]], list[float]]]) -> Column:
    """A perceptron on |vector| = 1: layers (weights by output, biases), with max(0, x) between them; the last has one output."""
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    out = F.when(norm > 0, bound(norm, lambda n: F.transform(vector, lambda x: x / n)))

    def applied(v: Column, weights: list[list[float]], biases: list[float], last: bool) -> Column:
        rows = F.array(*[F.struct(F.array(*[F.lit(float(x)) for x in w]).alias("w"), F.lit(float(b)).alias("b")) for w, b in zip(weights, biases, strict=True)])
        dot = lambda v, r: F.aggregate(F.zip_with(v, r["w"], lambda a, b: a * b), r["b"], lambda a, x: a + x)
        return bound(v, lambda v: F.transform(rows, lambda r: dot(v, r) if last else F.greatest(dot(v, r), F.lit(0.0))))

    for i, (weights, biases) in enumerate(layers):
        out = applied(out, weights, biases, i == len(layers) - 1)
    return F.when(norm > 0, F.get(out, F.lit(0)))


def text_boxes(images: DataFrame, load: Callable[[], object], detect: Callable[[object, bytes], list[list[tuple[float, float]]]]) -> DataFrame:
    """(path, boxes) of images (path, content): an engine, loaded once a worker, gives the corners of each box of text; what it
    fails on has none. geometry.text_area() tells how much of an image they cover."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        engine = load()
        for batch in batches:
            boxes = []
            for data in batch["content"]:
                try:
                    boxes.append([[{"x": float(x), "y": float(y)} for x, y in corners] for corners in detect(engine, data) or []])
                except Exception:
                    boxes.append([])
            yield pd.DataFrame({"path": batch["path"], "boxes": boxes})

    return images.select("path", "content").mapInPandas(run, "path string, boxes array<array<struct<x:double,y:double>>>")


def score_bucket(score: Column, good: float, medium: float) -> Column:
    """'good' and 'medium' from their least scores on, else 'bad'; a missing score is bad."""
    return F.when(score >= good, "good").when(score >= medium, "medium").otherwise("bad")

"""Gradient-boosted trees: trained with Spark ML, applied as plain column expressions."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.session import settled


@dataclass(frozen=True)
class Leaf:
    value: float


@dataclass(frozen=True)
class Split:
    feature: int
    threshold: float
    low: "Leaf | Split"
    high: "Leaf | Split"


@dataclass(frozen=True)
class Boosted:
    """Weighted trees over named features; with no trees every row scores ``prior``."""

    features: tuple[str, ...]
    trees: tuple[tuple[float, "Leaf | Split"], ...]
    prior: float = 0.5

    def probability(self, column: Callable[[str], Column] = F.col) -> Column:
        """P(label = 1) from columns named as the features (or what ``column`` makes of the names); null features count as 0."""
        if not self.trees:
            return F.lit(float(self.prior))
        columns = [F.coalesce(column(f), F.lit(0.0)) for f in self.features]
        margin = sum((F.lit(w) * _column(tree, columns) for w, tree in self.trees), F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * margin))


def _column(node: Leaf | Split, columns: list[Column]) -> Column:
    if isinstance(node, Leaf):
        return F.lit(node.value)
    return F.when(columns[node.feature] <= node.threshold, _column(node.low, columns)).otherwise(_column(node.high, columns))


def _parse(lines: list[str]) -> Leaf | Split:
    """A tree from the lines of its description, taken off the front."""
    line = lines.pop(0)
    if line.startswith("Predict:"):
        return Leaf(float(line.split(":")[1]))
    feature, threshold = re.fullmatch(r"If \(feature (\d+) <= (\S+)\)", line).groups()
    low = _parse(lines)
    lines.pop(0)  # Else
    return Split(int(feature), float(threshold), low, _parse(lines))


def fit(sample: DataFrame, features: list[str], label: str, rounds: int = 12, depth: int = 3, seed: int = 7, weight: str | None = None) -> Boosted:
    """Boosted trees on labelled rows: a bounded number of them, or any number of rows with a ``weight``, which say how often each occurs. With
    rows of one class only, that class is the answer.

    Spark ML takes the candidates of its splits (32 bins a feature) from about 10,000 of the rows; trees and leaves come from all rows."""
    sample = sample.select(*features, label) if weight is None else sample.select(*features, label, F.col(weight).cast("double").alias("weight"))
    sample = settled(sample.coalesce(2) if weight is None else sample, "boosting-sample")
    counts = {int(r[0]): r[1] for r in sample.groupBy(F.col(label).cast("int")).count().collect()}
    if set(counts) != {0, 1}:
        return Boosted(tuple(features), (), 0.5 if not counts else float(max(counts)))
    columns = [*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in features], F.col(label).cast("double").alias("label")]
    vectors = VectorAssembler(inputCols=features, outputCol="vector").transform(sample.select(*columns, *(["weight"] if weight else [])))
    trainer = GBTClassifier(featuresCol="vector", labelCol="label", maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=seed,
                            checkpointInterval=-1)
    if weight:
        trainer = trainer.setWeightCol("weight")
    model = trainer.fit(vectors.select("vector", "label", *(["weight"] if weight else [])))
    trees = []
    for weight, tree in zip(model.treeWeights, model.trees):
        lines = [x.strip() for x in tree.toDebugString.splitlines()[1:] if x.strip()]
        trees.append((float(weight), _parse(lines)))
    return Boosted(tuple(features), tuple(trees))

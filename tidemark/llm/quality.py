"""Text quality by naive Bayes support vectors.

Features are word and word-pair indicators: runs of letters, of digits and of other signs, case kept, and pairs of
neighbours, hashed into ``2**BITS`` places. Each indicator is scaled by its log-count ratio (how much likelier it is in
good than in bad examples), each example to unit length, and a linear hinge-loss model with squared norm is fitted by
dual coordinate descent. Margins become probabilities by a logistic curve fitted to margins of held-out folds, weighted
back to the class shares of all labelled rows.

Fitting takes a bounded sample: of each class the first ``MAX_EXAMPLES`` labelled rows by a hash of the id, as far as they
come to ``MAX_FEATURES`` feature numbers (the first row is always taken, and has ``2**BITS`` at most); numbers travel
packed, four bytes each. The model is one array of ``2**BITS`` weights, so it travels with the function.

Defined cases: null and empty texts have no features and get the score of margin 0 (the bias alone); texts of any length
are read whole; repeated rows are scored one by one; without labelled rows every score is 0, with one class only it is
that class; other columns pass through.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, whole_text
from tidemark.session import cut_lineage

MAX_EXAMPLES = 2000
MAX_FEATURES = 10_000_000
BITS = 18
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 30
FOLDS = 4
SEED = 7

# Letters (with all of UTF-8's further bytes), digits, other signs.
_TOKENS = re.compile(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^A-Za-z0-9\x80-\xff\x20\x09-\x0D]+").findall


def features(text: str) -> np.ndarray:
    """Distinct feature numbers of a text, ascending."""
    tokens = _TOKENS(text.encode())
    if not tokens:
        return np.zeros(0, dtype=np.int64)
    one = np.fromiter(map(zlib.crc32, tokens), dtype=np.uint64, count=len(tokens))
    # Pairs mix both hashes by odd constants, so that order matters and pairs don't meet single words.
    two = one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:] * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(1)
    mixed = np.concatenate([one * np.uint64(0xD6E8FEB86659FD93), two])
    return np.unique((mixed >> np.uint64(64 - BITS)).astype(np.int64))


@dataclass
class Model:
    weights: np.ndarray
    ratios: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, found: np.ndarray) -> float:
        if not len(found):
            return self.bias
        norm = float(np.sqrt(np.square(self.ratios[found]).sum()))
        return float(self.weights[found].sum()) / norm + self.bias if norm > 0 else self.bias

    def score(self, text: str) -> float:
        z = self.slope * self.margin(features(text)) + self.offset
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))))


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    size = 1 << BITS
    p, q = np.full(size, SMOOTHING), np.full(size, SMOOTHING)
    for found, label in zip(rows, labels):
        (p if label else q)[found] += 1
    return np.log(p / p.sum()) - np.log(q / q.sum())


def dual_coordinate_descent(rows: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias of the hinge-loss model over scaled, unit-length indicators.

    Every step solves one example's dual variable exactly, within 0 and its cost; classes cost alike in sum.
    """
    sign = np.where(labels > 0, 1.0, -1.0)
    n = len(rows)
    share = {1.0: max(1, int((sign > 0).sum())), -1.0: max(1, int((sign < 0).sum()))}
    cost = np.array([COST * n / (2 * share[s]) for s in sign])
    values = []
    for found in rows:
        x = ratios[found]
        norm = np.sqrt((x * x).sum())
        values.append(x / norm if norm > 0 else x)
    # Squared length with the bias feature.
    length = np.array([(v * v).sum() + 1.0 for v in values])
    w, bias, alpha = np.zeros(len(ratios)), 0.0, np.zeros(n)
    order = np.random.default_rng(SEED)
    for _ in range(EPOCHS):
        moved = 0.0
        for i in order.permutation(n):
            slack = sign[i] * (w[rows[i]] @ values[i] + bias) - 1.0
            new = min(max(alpha[i] - slack / length[i], 0.0), cost[i])
            step = (new - alpha[i]) * sign[i]
            if step:
                w[rows[i]] += step * values[i]
                bias += step
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w, bias


def fit_rows(rows: list[np.ndarray], labels: np.ndarray, mass: np.ndarray) -> Model:
    """A model of feature sets; ``mass`` is how many labelled rows each example stands for."""

    def train(use: np.ndarray) -> Model:
        own = [rows[i] for i in np.flatnonzero(use)]
        ratios = log_count_ratios(own, labels[use])
        w, bias = dual_coordinate_descent(own, labels[use], ratios)
        return Model(w * ratios, ratios, bias, 1.0, 0.0)

    fold = np.arange(len(rows)) % FOLDS
    margins = np.zeros(len(rows))
    for k in range(FOLDS):
        part = train(fold != k)
        for i in np.flatnonzero(fold == k):
            margins[i] = part.margin(rows[i])
    model = train(np.ones(len(rows), dtype=bool))
    model.slope, model.offset = logistic(margins, labels, mass)
    return model


def logistic(x: np.ndarray, y: np.ndarray, mass: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the weighted logistic curve, by Newton steps with a weak pull of the slope towards 0."""
    mass = mass * len(mass) / mass.sum()
    # Targets slightly inside 0 and 1 keep separable data finite.
    t = np.where(y > 0, (y > 0).sum() + 1.0, 1.0) / np.where(y > 0, (y > 0).sum() + 2.0, (y <= 0).sum() + 2.0)
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -500, 500)))
        g = np.array([(mass * (p - t) * x).sum() + 1e-3 * a, (mass * (p - t)).sum()])
        h = mass * p * (1 - p)
        hess = np.array([[(h * x * x).sum() + 1e-3, (h * x).sum()], [(h * x).sum(), h.sum() + 1e-9]])
        step = np.linalg.solve(hess, g)
        step *= min(1.0, 5.0 / max(1e-12, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def _feature_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [features(t.as_py()) for t in batch.column(2)]
        packed, number = [s.astype("<i4").tobytes() for s in sets], [len(s) for s in sets]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(packed, pa.binary()), pa.array(number, pa.int64())],
            names=["ord", "label", "features", "number"],
        )


def fit(docs: DataFrame, labelled: DataFrame, id_column: str, text_column: str, label_column: str) -> Model | float:
    """A model, or the one score there is to give if the labelled rows hold fewer than two classes."""
    known = labelled.where(F.col(label_column).isin(0, 1) & F.col(id_column).isNotNull()).select(
        F.col(id_column).alias("__id"), F.col(label_column).cast("int").alias("__label")
    )
    known = known.groupBy("__id").agg(F.max("__label").alias("__label"))
    shares = {r["__label"]: r["count"] for r in known.groupBy("__label").count().collect()}
    if len(shares) < 2:
        return float(next(iter(shares), 0))
    drawn = None
    for label in (0, 1):
        own = known.where(F.col("__label") == label).withColumn("__order", F.xxhash64("__id"))
        own = own.orderBy("__order", "__id").limit(MAX_EXAMPLES)
        drawn = own if drawn is None else drawn.unionByName(own)
    drawn = cut_lineage(drawn)
    texts = docs.select(F.col(id_column).alias("__id"), whole_text(text_column).alias("__text"))
    examples = texts.join(F.broadcast(drawn), "__id").dropDuplicates(["__id"]).select("__order", "__label", "__text")
    sets = cut_lineage(examples.mapInArrow(_feature_sets, "ord long, label int, features binary, number bigint"))
    # Windows over the drawn rows only: at most MAX_EXAMPLES numbers a class.
    before = Window.partitionBy("label").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    sized = sets.select("ord", "label", F.coalesce(F.sum("number").over(before), F.lit(0)).alias("before"), "number")
    fits = sized.where((F.col("before") == 0) | (F.col("before") + F.col("number") <= MAX_FEATURES))
    rows = sets.join(F.broadcast(fits.select("ord", "label")), ["ord", "label"], "left_semi").orderBy("ord").collect()
    labels = np.array([r["label"] for r in rows])
    if len(set(labels.tolist())) < 2:
        return float(labels[0]) if len(labels) else 0.0
    drawn_of = {y: int((labels == y).sum()) for y in (0, 1)}
    mass = np.array([shares[y] / drawn_of[y] for y in labels.tolist()])
    return fit_rows([np.frombuffer(r["features"], dtype="<i4").astype(np.int64) for r in rows], labels, mass)


def _scorer(model: Model | float, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_at)
            if isinstance(model, float):
                scores = [model] * len(texts)
            else:
                scores = [model.score(t.as_py() or "") for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, "score"]
            )

    return run


def score(docs: DataFrame, model: Model | float, text_column: str = "text", score_as: str = "score") -> DataFrame:
    """``docs`` with a score in 0..1 under ``score_as``."""
    types = ", ".join(f"`c{i}` {f.dataType.simpleString()}" for i, f in enumerate(docs.schema))
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    scored = plain.mapInArrow(_scorer(model, docs.columns.index(text_column)), f"{types}, score double")
    return scored.toDF(*docs.columns, score_as)


def keep_good(docs: DataFrame, labels: DataFrame, training: Column, limit: float = 0.7, id_column: str = "doc_id",
              text_column: str = "text", label_column: str = "quality") -> DataFrame:
    """The rows of ``docs`` whose score reaches ``limit``."""
    model = fit(docs, labels.where(training), id_column, text_column, label_column)
    name = free_name(docs, "__quality")
    return score(docs, model, text_column, name).where(F.col(name) >= limit).select(*docs.columns)

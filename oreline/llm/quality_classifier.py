"""Quality classifier: a support vector machine on naive Bayes features.

Features are indicators of word n-grams, hashed to a fixed number of places:
single words, and runs of up to three word shapes (upper case, lower case,
digits and each other sign, runs cut to one; a word equal to the one before it is
marked). Class log-count ratios come from all training rows. Indicators scaled by
them feed a linear hinge-loss model, fitted by dual coordinate descent on a
bounded sample of the training rows, and a logistic curve turns margins into
scores.

Cases: null and blank texts have no features and get the score of the bias;
null labels and labels without a document are not used; repeated rows count as
often as they occur; without rows of both classes the score is the smoothed
share of label 1. Every input row gives one output row, further columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, StructField, StructType

from oreline.llm.common import require, scratch, stored

PLACE_BITS = 16
PLACES = 1 << PLACE_BITS
MAX_NGRAM = 3
SAMPLE_PER_CLASS = 3000  # bound of the rows the hinge-loss model is fitted on
COST = 0.02
EPOCHS = 12
SMOOTH = 1.0
WORDS_KEPT = 1 << 19

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _shape(word: str) -> str:
    out = []
    for c in word:
        kind = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        if not out or out[-1] != kind:
            out.append(kind)
    return "".join(out)


class _Codes(dict):
    """Word to (hash of the word, hash of its shape); forgets all when full."""

    def __missing__(self, word: bytes) -> tuple[int, int]:
        if len(self) >= WORDS_KEPT:
            self.clear()
        shape = _shape(word.decode("utf-8", "replace")).encode()
        out = self[word] = (
            xxhash.xxh3_64_intdigest(word),
            xxhash.xxh3_64_intdigest(shape, seed=1),
        )
        return out


def features(text: str | bytes | None, codes: dict) -> np.ndarray:
    """Distinct places of the n-grams of a text, in order."""
    data = text or b""
    words = (data if isinstance(data, bytes) else data.encode("utf-8", "surrogatepass")).split()
    if not words:
        return np.empty(0, np.int64)
    pairs = np.array(list(map(codes.__getitem__, words)), np.uint64)
    word, shape = pairs[:, 0], pairs[:, 1].copy()
    shape[1:] += (word[1:] == word[:-1]).astype(np.uint64)
    found = [word * _MIX]
    gram = np.full(len(shape), np.uint64(1))
    for n in range(1, min(MAX_NGRAM, len(shape)) + 1):
        gram = gram[: len(shape) - n + 1] * _MIX + shape[n - 1 :]
        gram = gram ^ (gram >> np.uint64(29))
        found.append(gram * _MIX)
    places = np.concatenate(found) >> np.uint64(64 - PLACE_BITS)
    seen = np.zeros(PLACES, bool)
    seen[places.astype(np.int64)] = True
    return np.flatnonzero(seen)


@dataclass
class Model:
    """Weight of each place, bias, and the curve from margin to score."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def score(self, text: str | None, codes: dict) -> float:
        margin = float(self.weights[features(text, codes)].sum()) + self.bias
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30))))


def descend(rows: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray) -> tuple:
    """Dual coordinate descent for the hinge loss; the bias is one more feature."""
    rng = np.random.default_rng(11)
    weights, bias = np.zeros(len(ratios)), 0.0
    alpha = np.zeros(len(rows))
    norms = np.array([float((ratios[r] ** 2).sum()) + 1 for r in rows])
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            x = ratios[rows[i]]
            gradient = labels[i] * (float(weights[rows[i]] @ x) + bias) - 1
            now = min(max(alpha[i] - gradient / norms[i], 0.0), COST)
            if now != alpha[i]:
                step = (now - alpha[i]) * labels[i]
                weights[rows[i]] += step * x
                bias += step
                alpha[i] = now
    return weights * ratios, bias


def _curve(margins: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Logistic curve through margins, by a few damped Newton steps."""
    wanted = (labels > 0) * 0.98 + 0.01
    points = np.stack([margins, np.ones_like(margins)])
    at = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(at @ points, -30, 30)))
        gradient = points @ (weight * (p - wanted))
        curve = (points * (weight * p * (1 - p))) @ points.T + np.eye(2) * 1e-3
        at -= np.clip(np.linalg.solve(curve, gradient), -1, 1)
    return float(at[0]), float(at[1])


def fit(train: DataFrame) -> Model:
    """Model for label 1 against label 0; ``train`` is what ``training_rows`` returns."""
    require(train, "id", "places", "label")
    with scratch(train.sparkSession):
        rows = train.where(F.col("label").isin(0, 1))
        return _fitted(stored(rows.select("id", "places", F.col("label").cast("int").alias("label")), "train"))


def _fitted(rows: DataFrame) -> Model:

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, docs = np.zeros((2, PLACES), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            for places, y in zip(batch["places"], batch["label"]):
                table[y, np.frombuffer(places, np.uint16)] += 1
                docs[y] += 1
        some = np.flatnonzero(table.any(axis=0))
        yield pd.DataFrame(
            {
                "place": np.append(some, -1),
                "zero": np.append(table[0, some], docs[0]),
                "one": np.append(table[1, some], docs[1]),
            }
        )

    counts = rows.mapInPandas(count, "place long, zero long, one long")
    # At most one row for each place.
    table = counts.groupBy("place").agg(F.sum("zero").alias("zero"), F.sum("one").alias("one"))
    table = table.toPandas().set_index("place")
    n_zero, n_one = (int(table[c].get(-1, 0)) for c in ("zero", "one"))
    prior = np.log((n_one + 1) / (n_zero + 1))
    if not n_zero or not n_one:
        return Model(np.zeros(PLACES), 0.0, 0.0, float(prior))
    table = table.drop(index=-1)
    one, zero = np.full(PLACES, SMOOTH), np.full(PLACES, SMOOTH)
    one[table.index], zero[table.index] = table["one"] + SMOOTH, table["zero"] + SMOOTH
    ratios = np.log((one / one.sum()) / (zero / zero.sum()))
    ratios[(one + zero) < 2 * SMOOTH + 2] = 0  # seen once: says nothing

    def draw(y: int) -> DataFrame:
        # By id as well: copies of one text do not lie together.
        order = F.xxhash64("id", "places", F.lit(y))
        return rows.where(F.col("label") == y).orderBy(order, "places").limit(SAMPLE_PER_CLASS)

    def learn(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["label", "places"])
        found = [np.frombuffer(places, np.uint16).astype(np.int64) for places in group["places"]]
        y = group["label"].to_numpy() * 2.0 - 1
        weights, bias = descend(found, y, ratios)
        margins = np.array([weights[r].sum() for r in found]) + bias
        share = {1.0: n_one / max(1, (y > 0).sum()), -1.0: n_zero / max(1, (y < 0).sum())}
        slope, offset = _curve(margins, y, np.array([share[v] for v in y]))
        packed = np.append(weights, [bias, slope, offset]).tobytes()
        return pd.DataFrame({"model": [packed]})

    sample = draw(0).union(draw(1)).withColumn("all", F.lit(1))
    sample = sample.groupBy("all").applyInPandas(learn, "model binary")
    packed = np.frombuffer(bytes(sample.first()["model"]), np.float64)
    return Model(packed[:-3], *map(float, packed[-3:]))


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the score of each text in column ``name`` (replaced if there)."""
    require(docs, text)
    docs = docs.drop(name) if name != text else docs
    small = Model(model.weights.astype(np.float32), model.bias, model.slope, model.offset)

    def rate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes = _Codes()
        for batch in batches:
            yield batch.assign(**{name: [small.score(body, codes) for body in batch[text]]})

    return docs.mapInPandas(rate, _with(docs, name))


def _with(docs: DataFrame, name: str) -> StructType:
    return StructType([*docs.schema.fields, StructField(name, DoubleType())])


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Rows never learned from: crc32 of the id's text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    label: str = "quality",
    text: str = "text",
) -> DataFrame:
    """``(id, places, label)`` of the labelled documents that may be learned from.

    Texts become packed feature places where they are read; only these meet the labels.
    """
    marks = labels.select(F.col(doc_id).alias("of"), F.col(label).alias("label"))
    marks = marks.where("label is not null").where(~held_out("of")).distinct()
    rows = docs.where(~held_out(doc_id)).select(F.col(doc_id).alias("id"), F.col(text).cast("binary").alias("text"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _Codes()
        for batch in batches:
            found = [features(body, codes) for body in batch.column("text").to_pylist()]
            packed = pa.array([f.astype(np.uint16).tobytes() for f in found], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), packed], names=["id", "places"])

    schema = StructType([rows.schema["id"], StructField("places", BinaryType())])
    return rows.mapInArrow(pack, schema).join(marks, F.col("id") == F.col("of")).drop("of")

"""Naive Bayes support vectors: n-gram indicators times log-count ratios, hinge loss, dual coordinate descent."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postings.llm.common import WordHash, mix64, pieces, word_hashes
from postings.llm.labelled import dual_coordinate_descent, held_out, platt, training_rows

BITS = 18
#: Labelled rows a class that a model is fitted on at most.
TRAIN_ROWS = 3000
_RUNS = ((re.compile(rb"[a-z\x80-\xff]+"), b"a"), (re.compile(rb"[A-Z]{2,}"), b"B"), (re.compile(rb"[0-9]+"), b"0"), (re.compile(rb"(.)\1+"), rb"\1\1"))


class ShapeHash(WordHash):
    """Hash of a word's shape: runs of lower-case letters, of capitals, of digits and of signs."""

    def __missing__(self, word: bytes) -> int:
        shape = word
        for pattern, to in _RUNS:
            shape = pattern.sub(to, shape)
        if len(self) >= self.most:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(shape, seed=1)
        return found


_shapes = ShapeHash(100_000)


def indicators(text: bytes | None, bits: int = BITS) -> np.ndarray:
    """Distinct hashed n-grams of a whole text: words, word pairs, shapes, and shape pairs with "same word again"."""
    words = (text or b"").split()
    if not words:
        return np.empty(0, np.int64)
    h, s = word_hashes.of(words), _shapes.of(words)
    pairs = mix64(h[:-1]) + h[1:]
    shapes = mix64(s[:-1] * np.uint64(3) + (h[:-1] == h[1:])) + s[1:]
    return np.unique(mix64(np.concatenate([h, pairs, s, shapes])) >> np.uint64(64 - bits)).astype(np.int64)


@dataclass(frozen=True)
class Model:
    ratios: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, dims: np.ndarray) -> float:
        if not len(dims):
            return self.bias
        r = self.ratios[dims]
        return float(self.weights[dims] @ r / max(np.sqrt(r @ r), 1e-9) + self.bias)

    def score(self, dims: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(dims) + self.offset, -30, 30))))


def fit(docs: DataFrame, labels: DataFrame, label: str, *, train_rows: int = TRAIN_ROWS, bits: int = BITS, smooth: float = 1.0) -> Model:
    """A model of ``label`` from at most ``train_rows`` labelled rows a class; a fifth of them only calibrates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [indicators(t, bits).astype(np.int32) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(sets, pa.list_(pa.int32()))], ["doc_id", "label", "dims"])

    rows = training_rows(docs, labels, label, train_rows).mapInArrow(run, "doc_id long, label int, dims array<int>").toPandas()
    rows = rows.sort_values("doc_id", kind="stable").reset_index(drop=True)
    y = rows["label"].to_numpy()
    if len(np.unique(y)) < 2:  # nothing to learn from: the one class seen, or none
        p = float(y[0]) if len(y) else 0.5
        return Model(np.zeros(2**bits), np.zeros(2**bits), 0.0, 1.0, 8 * (2 * p - 1))
    sets = [np.asarray(d, np.int32) for d in rows.pop("dims")]
    fold = np.arange(len(sets)) % 5 == 4
    if len(np.unique(y[fold])) < 2 or len(np.unique(y[~fold])) < 2:
        fold[:] = False
    counts = np.full((2, 2**bits), smooth)
    for d, c in zip((s for s, f in zip(sets, fold, strict=True) if not f), y[~fold], strict=True):
        counts[c][d] += 1
    ratios = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    used = [s for s, f in zip(sets, fold, strict=True) if not f]
    starts = np.cumsum([0, *map(len, used)])
    columns = np.concatenate(used)
    values = ratios.astype(np.float32)[columns]
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        values[a:b] /= max(np.sqrt(values[a:b] @ values[a:b]), 1e-9)
    share = np.bincount(y[~fold], minlength=2) / (~fold).sum()
    cost = np.where(y[~fold] == 1, 0.5 / share[1], 0.5 / share[0])
    w = dual_coordinate_descent(starts, columns, values, 2.0 * y[~fold] - 1, 2**bits, cost)
    model = Model(ratios.astype(np.float32), w[:-1].astype(np.float32), float(w[-1]), 1.0, 0.0)
    check = fold if fold.any() else ~fold
    slope, offset = platt(np.array([model.margin(s) for s, f in zip(sets, check, strict=True) if f]), y[check])
    return Model(model.ratios, model.weights, model.bias, slope, offset)


def quality_scores(df: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5, bits: int = BITS, keep: list[str] | None = None) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row, whole texts, with the columns in ``keep`` as ``keep_*`` besides.

    Null and empty texts get the score of no n-gram at all. Null and repeated ids are scored
    like others (a null id isn't held out); an empty table gives an empty result.
    """
    keep = keep or []
    columns = [F.col(c).alias(f"keep_{c}") for c in keep]
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in pieces(whole)):
            scores = [model.score(indicators(t, bits)) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            rest = [batch.column(f"keep_{c}") for c in keep]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64()), *rest], ["doc_id", "score", *(f"keep_{c}" for c in keep)])

    schema = docs.select("doc_id", F.lit(0.0).alias("score"), *(f"keep_{c}" for c in keep)).schema
    scored = docs.mapInArrow(run, schema)
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), *(f"keep_{c}" for c in keep)
    )

"""Toxicity by a gap-weighted subsequence kernel, Nystroem landmarks and a linear support vector machine.

Units are words (and short words run together), so an insult is caught wherever it stands in
a text of any length; a document's score is that of its worst unit. The kernel of two units
sums, over all common subsequences of three characters, ``decay`` to the power of the characters
they span in both: gaps and inserted characters lower a match instead of ending it.

A Nystroem feature of a unit is a fixed linear map of its kernels with the landmarks, and a
kernel is a dot product over subsequences. A trained linear model is therefore folded once
into one weight a subsequence, and scoring costs the same for any number of landmarks.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postings.llm.labelled import dual_coordinate_descent, held_out, training_rows

#: Characters of a unit at once (longer words are read in overlapping windows), widest span of a subsequence, decay.
LONGEST, SPAN, DECAY = 16, 7, 0.7
#: Labelled documents a class to learn from, landmarks, words of clean sentences to learn from.
TRAIN_ROWS, LANDMARKS, CLEAN_WORDS = 3000, 600, 6000
#: Different words before it, and after it, that a word of toxic sentences needs to be a positive unit, and how
#: many times as often it must stand in them as in clean ones (a few wrong labels, or quotations, do no harm).
LEAST_CONTEXTS, LEAST_RATIO = 4, 20.0
#: A document's score is 0.7 at the margin that best parts held-back labelled ones, and rises with this slope.
THRESHOLD, SLOPE = 0.7, 2.0
_TRIPLES = np.array([t for t in combinations(range(LONGEST + 2), 3) if t[2] - t[0] < SPAN])
_SPANS = (DECAY ** (_TRIPLES[:, 2] - _TRIPLES[:, 0] + 1)).astype(np.float32)
_EDGES = ".,;:!?()[]{}\"'“”‘’«»…–—¡¿#$%&*|<>~^+=/\\@_-"
_SENTENCE = re.compile(r"[.!?\n]+")
BEGIN, END = 62, 63


def _code(ch: str) -> int:
    """a-z are 1-26, a digit is 27, other characters share 28-61; 0 pads."""
    if "a" <= ch <= "z":
        return ord(ch) - 96
    return 27 if ch.isdigit() else 28 + ord(ch) % 34


class _Codes(dict):
    def __missing__(self, ch: str) -> int:
        found = self[ch] = _code(ch)
        return found


_codes = _Codes()


def pieces(word: str) -> list[str]:
    """A word whole, or in windows of LONGEST characters that overlap by half, so nothing is cut off."""
    if len(word) <= LONGEST:
        return [word]
    return [word[i : i + LONGEST] for i in range(0, len(word) - LONGEST // 2, LONGEST // 2)]


def encode(units: list[str]) -> np.ndarray:
    """Rows of character codes with begin and end marks, padded with 0."""
    out = np.zeros((len(units), LONGEST + 2), np.int64)
    for i, u in enumerate(units):
        out[i, : len(u) + 2] = [BEGIN, *map(_codes.__getitem__, u), END]
    return out


def subsequences(units: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(subsequence codes, weights) of each unit, equal subsequences summed, unused places -1 and 0; rows have norm 1."""
    codes = encode(units)
    used = max((len(u) + 2 for u in units), default=0)
    pick = _TRIPLES[:, 2] < used
    at = _TRIPLES[pick]
    a, b, c = codes[:, at[:, 0]], codes[:, at[:, 1]], codes[:, at[:, 2]]
    keys = np.where((a > 0) & (b > 0) & (c > 0), (a << 12) | (b << 6) | c, -1)
    order = np.argsort(keys, axis=1, kind="stable")
    keys = np.take_along_axis(keys, order, 1)
    weights = np.where(keys >= 0, _SPANS[pick][order], 0).astype(np.float32)
    # add equal neighbours up at the last of each run
    sums = np.cumsum(weights, axis=1, dtype=np.float64)
    last = np.ones(keys.shape, bool)
    last[:, :-1] = keys[:, :-1] != keys[:, 1:]
    upto = np.where(last, sums, 0)
    before = np.zeros_like(upto)
    before[:, 1:] = np.maximum.accumulate(upto, axis=1)[:, :-1]
    weights = np.where(last & (keys >= 0), sums - before, 0)
    norms = np.sqrt((weights**2).sum(axis=1, keepdims=True))
    return np.where(last, keys, -1), (weights / np.maximum(norms, 1e-9)).astype(np.float32)


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def joined(words: list[str]) -> list[str]:
    """Runs of words of one or two characters, put together, and the letters of words with signs between them."""
    out, run = [], []
    for w in [*words, "longer"]:
        if len(w) <= 2:
            run.append(w)
        else:
            if len(run) >= 3:
                out.append("".join(run))
            run = []
    out += ["".join(c for c in w if c.isalpha()) for w in words if not w.isalpha() and not bare(w).isalpha()]
    return [w for w in out if w]


def disguised(word: str) -> list[tuple[str, float]]:
    """Spellings of a word with shares of its weight: a sign or its own letter put in, two letters put in, one left out.

    Signs between all letters need none: the letters of such a word are a unit of their own.
    """
    inner = range(1, len(word))
    one = [word[:i] + c + word[i:] for i in inner for c in (".", word[i - 1])]
    two = [word[:i] + a + word[i:j] + b + word[j:] for i in inner for j in inner if i < j for a, b in ("xe", "aq", "ht")]
    left = [word[:i] + word[i + 1 :] for i in range(1, len(word) - 1)] if len(word) > 4 else []
    kinds = ((one, 2.0), (two, 2.5), (left, 2.5))
    return [(v, share / len(kind)) for kind, share in kinds for v in kind if len(v) <= LONGEST]


def bare(word: str) -> str:
    return word.strip(_EDGES) or word


@dataclass(frozen=True)
class Model:
    table: np.ndarray
    bias: float
    slope: float
    offset: float

    def margins(self, words: list[str]) -> np.ndarray:
        """The greatest margin over each word's pieces."""
        cut = [pieces(bare(w)) for w in words]
        flat = [p for c in cut for p in c]
        found = np.empty(len(flat), np.float32)
        order = np.argsort(np.fromiter(map(len, flat), np.int64, len(flat)), kind="stable")
        for i in range(0, len(flat), 2048):
            at = order[i : i + 2048]
            keys, weights = subsequences([flat[j] for j in at])
            found[at] = (self.table[keys] * weights).sum(axis=1) + self.bias
        starts = np.cumsum([0, *map(len, cut)])[:-1]
        return np.maximum.reduceat(found, starts) if len(flat) else found

    def score(self, margin: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30))))


class Worst(dict):
    """Margins of words seen by a worker, up to a bound."""

    def __init__(self, model: Model, most: int = 400_000):
        super().__init__()
        self.model, self.most = model, most

    def of(self, texts: list[str | None]) -> list[float]:
        out = []
        for i in range(0, len(texts), 500):
            split = [words_of(t) for t in texts[i : i + 500]]
            split = [w + joined(w) for w in split]
            new = list(set().union(*split).difference(self))
            if len(self) + len(new) > self.most:
                self.clear()
                new = list(set().union(*split))
            self.update(zip(new, self.model.margins(new).tolist(), strict=True))
            out += [max(map(self.__getitem__, w), default=-np.inf) for w in split]
        return out


def _learn(units: list[str], y: np.ndarray, times: np.ndarray, landmarks: list[str]) -> tuple[np.ndarray, float]:
    """Support vectors over Nystroem features of the landmarks, folded into weights of subsequences."""
    lk, lw = subsequences(landmarks)
    used = np.unique(lk[lk >= 0])
    place = np.full(64**3 + 1, len(used))
    place[used] = np.arange(len(used))
    dense = np.zeros((len(used) + 1, len(landmarks)), np.float32)
    np.add.at(dense, (place[lk], np.arange(len(landmarks))[:, None]), lw)
    dense[-1] = 0
    values, vectors = np.linalg.eigh((dense.T @ dense).astype(np.float64))
    root = vectors / np.sqrt(np.maximum(values, 1e-3)) @ vectors.T
    k = np.empty((len(units), len(landmarks)))
    for i in range(0, len(units), 64):
        keys, weights = subsequences(units[i : i + 64])
        k[i : i + 64] = np.einsum("ujl,uj->ul", dense[place[keys]], weights)
    features = k @ root
    n, m = features.shape
    cost = np.where(y > 0, 10.0, 20.0) * n * times / np.where(y > 0, times[y > 0].sum(), times[y < 0].sum())
    w = dual_coordinate_descent(np.arange(n + 1) * m, np.tile(np.arange(m), n), features.ravel(), y, m, cost, rounds=60)
    table = np.zeros(64**3 + 1, np.float32)
    table[used] = dense[:-1] @ (root @ w[:-1]).astype(np.float32)
    return table, float(w[-1])


def _landmarks(units: list[str], most: int) -> list[str]:
    """Units far from each other in the kernel, greedily: the next one is the least alike to all chosen."""
    if len(units) <= most:
        return units
    keys, weights = subsequences(units)
    chosen, best = [0], np.zeros(len(units))
    while len(chosen) < most:
        row = np.zeros(64**3 + 1, np.float32)
        row[keys[chosen[-1]]] = weights[chosen[-1]]
        row[-1] = 0
        best = np.maximum(best, (row[keys] * weights).sum(axis=1))
        best[chosen] = np.inf
        chosen.append(int(best.argmin()))
    return [units[i] for i in chosen]


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", *, train_rows: int = TRAIN_ROWS, landmarks: int = LANDMARKS, clean_words: int = CLEAN_WORDS) -> Model:
    """A model from at most ``train_rows`` labelled documents a class.

    Distinct sentences take their document's label, words that of their sentences: those that
    stand among several different neighbours in toxic sentences, and LEAST_RATIO times as often
    there as in clean ones, are the positive units, with their disguised spellings; words of
    clean sentences are the negative ones: the ``clean_words`` most frequent and, of all others,
    those that a first model takes for positive, in two further rounds. Three documents of ten
    only calibrate the score.
    """
    rows = training_rows(docs, labels, label, train_rows).toPandas().sort_values("doc_id", kind="stable")
    y = rows["label"].to_numpy()
    blank = Model(np.zeros(64**3 + 1, np.float32), 0.0, 1.0, -4.0)
    if len(np.unique(y)) < 2:
        return blank
    fold = np.arange(len(rows)) % 10 >= 7
    texts = rows["text"].tolist()
    sentences: tuple[set, set] = (set(), set())
    for text, c, f in zip(texts, y, fold, strict=True):
        if not f:
            sentences[c].update(_SENTENCE.split((text or "").lower()))
    clean: Counter = Counter()
    for s in sentences[0]:
        clean.update({bare(w) for w in s.split()})
    around = defaultdict(set)
    toxic: Counter = Counter()
    sentences = (sentences[0], sentences[1] - sentences[0])
    for s in sentences[1]:
        line = ["", *map(bare, s.split()), ""]
        toxic.update(set(line))
        for before, w, after in zip(line, line[1:], line[2:]):
            if len(w) >= 3:
                around[w].add((before, after))
    scale = max(1, len(sentences[0])) / max(1, len(sentences[1]))
    around = {w: n for w, n in around.items() if toxic[w] * scale >= LEAST_RATIO * clean[w]}
    # the words of one copied text keep their neighbours; an insult stands among many
    some = sorted((w for w, n in around.items() if len({a for a, _ in n}) >= LEAST_CONTEXTS and len({b for _, b in n}) >= LEAST_CONTEXTS), key=lambda w: (-len(around[w]), w))
    if not some or not clean:
        return blank
    some = [w for w in some if len(around[w]) >= 0.02 * len(around[some[0]])]
    # a unit weighs as the root of how many places it was seen in
    weighed = {p: np.sqrt(len(around[w]) / LEAST_CONTEXTS) for w in reversed(some) for p in pieces(w)}
    seen = list(weighed)
    for w in seen:
        for v, share in disguised(w):
            weighed.setdefault(v, share * weighed[w])
    positive, times = list(weighed), list(weighed.values())
    clean_units = [p for w, _ in sorted(clean.items(), key=lambda r: (-r[1], r[0])) if len(w) >= 3 and w not in weighed for p in pieces(w)]
    negative = clean_units[:clean_words]
    hard = negative[:1500]
    for _ in range(3):
        chosen = list(dict.fromkeys(_landmarks(seen[::-1], landmarks // 2) + _landmarks(hard, landmarks // 2)))
        # the empty unit stands for all unknown ones: the bias alone must say no
        units = ["", *positive, *negative]
        y_units = np.array([-1.0] + [1.0] * len(positive) + [-1.0] * len(negative))
        table, bias = _learn(units, y_units, np.array([50.0, *times] + [1.0] * len(negative)), chosen)
        model = Model(table, bias, 1.0, 0.0)
        margins = model.margins(clean_units)
        hard = [clean_units[i] for i in np.argsort(-margins, kind="stable")[:2000]]
        negative = list(dict.fromkeys(negative + [u for u, m in zip(hard, np.sort(margins)[::-1], strict=False) if m > -1]))
    worst = np.maximum(-30, Worst(model).of([t for t, f in zip(texts, fold, strict=True) if f]))
    # a word of unknown subsequences has the bias for its margin: it must stay below
    cut = max(best_cut(worst, y[fold]), model.bias + 0.25)
    return Model(model.table, model.bias, SLOPE, float(np.log(THRESHOLD / (1 - THRESHOLD)) - SLOPE * cut))


def best_cut(margins: np.ndarray, labels: np.ndarray) -> float:
    """The margin that best parts the labels, a false alarm counting as three misses; the middle of a gap."""
    order = np.argsort(margins, kind="stable")
    m, hit = margins[order], labels[order] == 1
    if hit.all() or not hit.any():
        return 0.0
    # before place i all are called 0, from it on 1
    missed = np.concatenate([[0], np.cumsum(hit)]) / hit.sum()
    alarms = 1 - np.concatenate([[0], np.cumsum(~hit)]) / (~hit).sum()
    edge = np.concatenate([[m[0] - 1], (m[1:] + m[:-1]) / 2, [m[-1] + 1]])
    cost = missed + 3 * alarms
    cost[1:-1][m[1:] == m[:-1]] = np.inf
    return float(edge[int(cost.argmin())])


def toxicity_scores(df: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row, whole texts.

    Null and empty texts score next to 0. Null and repeated ids are scored like others
    (a null id isn't held out); an empty table gives an empty result; other columns are ignored.
    """
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worst = Worst(model)
        for batch in batches:
            scores = [model.score(m) for m in worst.of(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    scored = docs.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))

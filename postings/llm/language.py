"""Language of texts by a linear-chain conditional random field over their words.

Every word has features (its affixes and inner n-grams, hashed; its place in a learned lexicon),
every pair of neighbours a learned transition. Forward-backward gives each word's probability of
each language, so that texts that switch between languages are labelled word by word; a text's
language is the one with the largest share of its words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postings.llm.common import mix64
from postings.llm.labelled import held_out

UNKNOWN = "und"
BITS, GRAMS = 16, 5
#: What a model is fitted on at most: rows a language, rows in all, and runs of so many words of each row, drawn by a hash.
TRAIN_ROWS, TRAIN_ROWS_IN_ALL, RUNS, RUN_WORDS, RUN_CHARS = 600, 2400, 4, 20, 64
#: Rounds of the fit, runs a training sequence, and steps of strength of a lexicon word.
ROUNDS, JOINED, STRENGTHS = 40, 6, 4
#: Words whose emissions a worker keeps, and characters scored at once.
CACHED, SLICE_CHARS = 400_000, 1_500_000
#: Steps after which messages are scaled, and the least logarithm of a factor: 8 steps stay far within a double.
SCALED, LEAST = 4, -40.0
_WORD, _PLAIN = regex.compile(r"\p{L}[\p{L}\p{M}]*"), re.compile("[a-z]+")


def words(text: str | None) -> list[str]:
    """Runs of letters (with their marks), lower-cased."""
    return (_PLAIN if text.isascii() else _WORD).findall(text.lower()) if text else []


def grams(found: list[str], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(dims, starts) of the words' hashed n-grams of ``^word$``: those with a mark are the affixes."""
    codes = np.frombuffer("".join(f"^{w}$" for w in found).encode("utf-32-le"), np.uint32).astype(np.uint64)
    size = np.fromiter(map(len, found), np.int64, len(found)) + 2
    word = np.repeat(np.arange(len(found)), size)
    parts, owners, h = [], [], np.zeros(len(codes), np.uint64)
    for n in range(1, GRAMS + 1):
        h = mix64(h[: len(codes) - n + 1]) + codes[n - 1 :]
        inside = word[: len(h)] == word[n - 1 :]
        parts.append((mix64(h[inside] + np.uint64(n)) >> np.uint64(64 - bits)).astype(np.int32))
        owners.append(word[: len(h)][inside])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(parts)[order], np.searchsorted(owner[order], np.arange(len(found)))


def marginals(emit: np.ndarray, begins: np.ndarray, trans: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posterior label probabilities of each word, and the expected transitions, of sequences laid end to end.

    ``emit`` (words x labels), ``trans`` and ``start`` are factors, not logarithms; ``begins`` marks
    the first word of each sequence. A sequence's start is a step that forgets what came before,
    so all sequences are one chain. It is cut into blocks: their step products come first,
    for all blocks at once; these carry the messages over the blocks, then all blocks run
    forward and backward at once. Exact, without a loop over words or sequences.
    """
    t, labels = emit.shape
    width = max(1, int(np.sqrt(t)))
    blocks = -(-t // width)
    pad = blocks * width - t
    e = np.concatenate([emit, np.ones((pad, labels))]).reshape(blocks, width, labels).transpose(1, 0, 2).copy()
    b = np.concatenate([begins, np.ones(pad, bool)]).reshape(blocks, width).T.copy()
    whole = np.broadcast_to(np.eye(labels), (blocks, labels, labels)).copy()
    for j in range(width):
        step = (whole.reshape(-1, labels) @ trans).reshape(whole.shape)
        if b[j].any():
            step[b[j]] = whole[b[j]].sum(2, keepdims=True) * start
        whole = step * e[j][:, None]
        if j % SCALED == 0:
            whole /= whole.max((1, 2), keepdims=True)
    whole /= whole.max((1, 2), keepdims=True)
    ahead, behind = np.ones((blocks, labels)), np.ones((blocks, labels))
    for i in range(1, blocks):
        x = ahead[i - 1] @ whole[i - 1]
        ahead[i] = x / x.max()
    for i in range(blocks - 2, -1, -1):
        x = whole[i + 1] @ behind[i + 1]
        behind[i] = x / x.max()
    alpha, beta, before = np.empty_like(e), np.empty_like(e), np.empty_like(e)
    now = ahead
    for j in range(width):
        before[j] = now
        step = np.where(b[j][:, None], now.sum(1, keepdims=True) * start, now @ trans) * e[j]
        alpha[j] = now = step / step.max(1, keepdims=True) if j % SCALED == 0 else step
    now = behind
    for j in range(width - 1, -1, -1):
        beta[j] = now
        x = e[j] * now
        step = np.where(b[j][:, None], x @ start[:, None], x @ trans.T)
        now = step / step.max(1, keepdims=True) if j % SCALED == 0 else step
    post = alpha * beta
    post /= post.sum(2, keepdims=True)
    after = e * beta
    inner = ~b
    left, right = before[inner], after[inner]
    left = left / np.einsum("ti,ij,tj->t", left, trans, right, optimize=True)[:, None]
    return post.transpose(1, 0, 2).reshape(-1, labels)[:t], (left.T @ right) * trans


class WordIds(dict):
    """Numbers of words in order of their first use; ``fresh`` are those since it was last emptied."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        self.fresh.append(word)
        found = self[word] = len(self)
        return found


@dataclass
class Model:
    """Labels, weights of hashed n-grams, lexicon (word: feature) with weights, transitions and starts as logarithms."""

    labels: list[str]
    weights: np.ndarray
    lexicon: dict[str, int]
    strengths: np.ndarray
    trans: np.ndarray
    start: np.ndarray
    _ids: WordIds = field(default_factory=WordIds, repr=False)
    _bank: list = field(default_factory=list, repr=False)

    def emissions(self, found: list[str]) -> np.ndarray:
        """Logarithms (words x labels) of distinct words."""
        dims, starts = grams(found)
        out = np.add.reduceat(self.weights[dims], starts, axis=0)
        place = np.fromiter((self.lexicon.get(w, -1) for w in found), np.int64, len(found))
        out[place >= 0] += self.strengths[place[place >= 0]]
        return out

    def _of(self, found: list[str]) -> np.ndarray:
        """Emissions of all words in turn; those of words seen before come from the cache."""
        if len(self._ids) > CACHED:
            self._ids.clear()
            self._bank.clear()
        at = np.fromiter(map(self._ids.__getitem__, found), np.int64, len(found))
        if self._ids.fresh:
            self._bank.append(self.emissions(self._ids.fresh))
            self._ids.fresh = []
        if len(self._bank) > 1:
            self._bank[:] = [np.concatenate(self._bank)]
        return self._bank[0][at]

    def word_labels(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """(probabilities of each word's label, the text each word is of) for non-empty lists of words laid end to end."""
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        flat = [w for t in texts for w in t]
        owner = np.repeat(np.arange(len(texts)), size)
        begins = np.zeros(len(flat), bool)
        begins[np.cumsum(size)[size > 0] - size[size > 0]] = True
        log = self._of(flat)
        emit = np.exp(np.maximum(log - log.max(1, keepdims=True), LEAST))
        return marginals(emit, begins, np.exp(self.trans), np.exp(self.start))[0], owner

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """(language, its share of the words' probability) of each text."""
        names, scores, at = [], np.zeros(len(texts)), 0
        while at < len(texts):
            end, chars = at, 0
            while end < len(texts) and (end == at or chars + len(texts[end] or "") <= SLICE_CHARS):
                chars += len(texts[end] or "")
                end += 1
            found = [words(t) for t in texts[at:end]] if self.labels else [[] for _ in texts[at:end]]
            share = np.zeros((end - at, max(1, len(self.labels))))
            if any(found):
                post, owner = self.word_labels(found)
                for label in range(len(self.labels)):
                    share[:, label] = np.bincount(owner, post[:, label], end - at)
            size = np.fromiter(map(len, found), np.int64, end - at)
            best = share.argmax(1)
            names += [self.labels[k] if n else UNKNOWN for k, n in zip(best, size, strict=True)]
            scores[at:end] = np.minimum(share[np.arange(end - at), best] / np.maximum(size, 1), 1.0)
            at = end
        return names, scores


def _lexicon(runs: list[list[str]], y: np.ndarray, labels: int) -> dict[str, int]:
    """Words of two runs or more: label of most runs, and how clearly (0 to STRENGTHS - 1)."""
    seen: dict[str, np.ndarray] = {}
    for run, label in zip(runs, y, strict=True):
        for w in set(run):
            if w not in seen:
                seen[w] = np.zeros(labels, np.int64)
            seen[w][label] += 1
    share = lambda c: (c.max() + 0.5) / (c.sum() + 0.5 * labels)
    return {w: int(c.argmax()) * STRENGTHS + min(STRENGTHS - 1, int(share(c) * STRENGTHS)) for w, c in seen.items() if c.sum() > 1}


def learn(runs: list[list[str]], names: list[str], *, rounds: int = ROUNDS, rate: float = 0.3, decay: float = 1e-5, bits: int = BITS) -> Model:
    """A model of runs of words and their languages, by Adam on the likelihood of the labels.

    Runs of all languages are dealt into sequences of JOINED runs in a fixed random order, so
    switches between languages are learned with the rest. The lexicon comes from every other run
    and the weights from the others: its strength is learned on runs it has not seen.
    """
    labels = sorted(set(names))
    n, dims = len(labels), 1 << bits
    y = np.array([labels.index(x) for x in names], np.int64)
    order = np.random.default_rng(11).permutation(len(runs))
    runs, y = [runs[i] for i in order], y[order]
    model = Model(labels, np.zeros((dims, n)), _lexicon(runs[::2], y[::2], n), np.zeros((n * STRENGTHS, n)), np.zeros((n, n)), np.zeros(n))
    if n < 2:
        return model
    runs, y = (runs[1::2], y[1::2]) if len(runs) > 3 * n else (runs, y)
    flat = [w for r in runs for w in r]
    label = np.repeat(y, [len(r) for r in runs])
    begins = np.zeros(len(flat), bool)
    begins[np.cumsum([0, *map(len, runs)])[:-1:JOINED]] = True
    distinct = sorted(set(flat))
    place = {w: i for i, w in enumerate(distinct)}
    at = np.fromiter((place[w] for w in flat), np.int64, len(flat))
    hashed, starts = grams(distinct, bits)
    each = np.diff([*starts, len(hashed)])
    lexical = np.fromiter((model.lexicon.get(w, -1) for w in distinct), np.int64, len(distinct))
    hot = np.eye(n)[label]
    inner = np.flatnonzero(~begins)
    taken = np.zeros((n, n))
    np.add.at(taken, (label[inner - 1], label[inner]), 1)
    params = [model.weights, model.strengths, model.trans, model.start]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for turn in range(1, rounds + 1):
        log = np.add.reduceat(model.weights[hashed], starts, axis=0)
        log[lexical >= 0] += model.strengths[lexical[lexical >= 0]]
        log = log[at]
        emit = np.exp(np.maximum(log - log.max(1, keepdims=True), LEAST))
        post, moves = marginals(emit, begins, np.exp(model.trans), np.exp(model.start))
        miss = hot - post
        word = np.column_stack([np.bincount(at, miss[:, k], len(distinct)) for k in range(n)])
        grads = [
            np.column_stack([np.bincount(hashed, np.repeat(word[:, k], each), dims) for k in range(n)]),
            np.column_stack([np.bincount(lexical[lexical >= 0], word[lexical >= 0, k], n * STRENGTHS) for k in range(n)]),
            taken - moves,
            miss[begins].sum(0),
        ]
        for p, g, m, v in zip(params, grads, first, second, strict=True):
            g = g / len(flat) - decay * p
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p += rate * (1 - turn / (rounds + 1)) * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.999**turn)) + 1e-7)
    model.weights, model.strengths = model.weights.astype(np.float32), model.strengths.astype(np.float32)
    return model


def fit(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", train_rows: int = TRAIN_ROWS, rows_in_all: int = TRAIN_ROWS_IN_ALL) -> Model:
    """A model of ``lang_col`` from rows outside the held-out third with a non-null id and language.

    At most ``train_rows`` rows a language (fewer if there are very many languages), the first by a
    hash of the id, and RUNS runs of RUN_WORDS words of each: the only bounded sample here.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    known = rows.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()  # a row a language
    most = max(1, min(train_rows, rows_in_all // max(1, len(counts))))
    # ids of low hashes only, about three times the rows drawn, so that no task ranks a language's rows
    low = [(r.lang, min(2**63 - 1, int(2**64 * min(1.0, (3 * most + 50) / r.n)) - 2**63)) for r in counts]
    limits = F.broadcast(docs.sparkSession.createDataFrame(low, "lang string, low long"))
    draw = known.join(limits, "lang").where(F.xxhash64("doc_id") <= F.col("low")).select("doc_id", "lang").distinct()
    draw = draw.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")))
    draw = draw.where(F.col("place") <= most).drop("place")  # at most rows_in_all rows (one a language at least), so they are broadcast

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, langs, runs = [], [], []
            for doc_id, text, lang in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ws = words(text)
                cuts = np.arange(0, len(ws), RUN_WORDS)
                drawn = np.argsort(mix64(cuts.astype(np.uint64) * np.uint64(2654435761) + np.uint64(doc_id % 2**64)), kind="stable")[:RUNS]
                for a in cuts[np.sort(drawn)]:
                    ids.append(doc_id)
                    langs.append(lang)
                    runs.append([w[:RUN_CHARS] for w in ws[a : a + RUN_WORDS]])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(langs, pa.string()), pa.array(runs, pa.list_(pa.string()))], ["doc_id", "lang", "words"])

    drawn = rows.join(F.broadcast(draw), ["doc_id", "lang"]).select("doc_id", "text", "lang")
    got = sorted(drawn.mapInArrow(run, "doc_id long, lang string, words array<string>").collect())
    return learn([r.words for r in got], [r.lang for r in got])


def languages(df: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of each row, by all words of its text.

    ``score`` is the predicted language's share of the words. A null text, one without a letter, or any
    text under a model that has learned no language is ``und`` with score 0; equal shares go
    to the first label in order. Repeated rows are scored alike, null ids aren't held out,
    an empty table gives an empty result, other columns are ignored. Texts are read whole.
    """
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                names, scores = model.predict(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    scored = docs.mapInArrow(run, "doc_id long, lang_pred string, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")

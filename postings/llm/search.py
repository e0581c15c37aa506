"""Ranked lexical search: Block-Max MaxScore over shards of compressed, blocked posting lists.

The index is a table of shards, each a bounded run of documents inverted in the task that read
them, so building it shuffles no posting. A block of postings keeps what its highest score
depends on (the least document size of each small term frequency), not the score: the index
stays valid while the corpus, and so every weight, changes.

A search reads each shard once. For each item, lists whose global bounds together cannot reach
the item's threshold are not essential: only the other lists name candidates. A candidate is held
against the block maxima of the rest first, and only blocks that still hold one are unpacked.
Each task keeps a heap an item over all its shards, and the heaps are merged in two steps.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postings.llm.common import key_bits, materialize, with_bit

TOP = 50
BLOCK = 128
#: A shard is closed at so many documents or postings; a worker forgets words beyond so many.
SHARD_DOCS, SHARD_POSTINGS, CACHED = 16_384, 1_000_000, 400_000
#: Terms (of all items together) that one pass over the index carries; more items mean more passes.
BLOCK_TERMS = 100_000
#: Groups whose heaps are merged before an item's.
MERGE_GROUPS = 64
#: Term frequencies with a least document size of their own in a block; higher ones share the last.
LEVELS = 3
NONE = np.iinfo(np.int32).max
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
INDEX = (
    "n_docs long, n_terms long, doc_ids binary, null_ids binary, sizes binary, terms array<string>, dfs array<int>, highest array<int>, least array<array<int>>, "
    "firsts binary, lasts binary, offsets binary, levels binary, payload binary"
)


def terms_of(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters, digits and any non-ASCII characters; only A-Z lower-cased."""
    return text.translate(_FOLD).split() if text else []


class TermIds(dict):
    """Numbers of a shard's terms; -1 for words that ``bits`` (of the vocabulary's hashes) rules out."""

    def __init__(self, bits: np.ndarray | None):
        super().__init__()
        self.bits, self.names = bits, []

    def __missing__(self, word: bytes) -> int:
        if self.bits is not None and not with_bit(self.bits, np.array([xxhash.xxh64_intdigest(word, seed=42)], np.uint64))[0]:
            found = -1
        else:
            found = len(self.names)
            self.names.append(word)
        self[word] = found
        return found

    def trim(self) -> None:
        if self.bits is not None and len(self) > CACHED:
            kept = {w: i for i, w in enumerate(self.names)}
            self.clear()
            self.update(kept)


def level_minima(tf: np.ndarray, size: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(runs x LEVELS + 2): least document size at tf 1, 2, ..., at any higher tf, and the highest tf of each run."""
    columns = [np.minimum.reduceat(np.where(tf == level, size, NONE), starts) for level in range(1, LEVELS + 1)]
    columns.append(np.minimum.reduceat(np.where(tf > LEVELS, size, NONE), starts))
    columns.append(np.maximum.reduceat(tf, starts))
    return np.stack(columns, 1).astype(np.int32)


def _narrow(x: np.ndarray) -> np.dtype:
    most = int(x.max())
    return np.dtype(np.uint8) if most < 1 << 8 else np.dtype(np.uint16) if most < 1 << 16 else np.dtype(np.uint32)


def pack(docs: np.ndarray, tf: np.ndarray, base: int) -> bytes:
    """One block: a byte with the two widths, gaps between document numbers (the first after ``base``), frequencies less 1."""
    gaps = np.diff(docs, prepend=base)
    a, b = _narrow(gaps), _narrow(tf - 1)
    return bytes([a.itemsize << 4 | b.itemsize]) + gaps.astype(a).tobytes() + (tf - 1).astype(b).tobytes()


def unpack(block: memoryview, base: int) -> tuple[np.ndarray, np.ndarray]:
    a, b = block[0] >> 4, block[0] & 15
    n = (len(block) - 1) // (a + b)
    gaps = np.frombuffer(block, f"<u{a}", n, 1)
    return np.cumsum(gaps, dtype=np.int64) + base, np.frombuffer(block, f"<u{b}", n, 1 + n * a).astype(np.int64) + 1


def shard_row(doc_ids: list, sizes: list[int], names: list[bytes], term: np.ndarray, doc: np.ndarray, tf: np.ndarray) -> list:
    """The index row of a shard's postings (term, doc, tf), documents ascending within each term."""
    order = np.argsort(term, kind="stable")
    term, doc, tf = term[order], doc[order], tf[order]
    size = np.asarray(sizes, np.int64)
    present, first = np.unique(term, return_index=True)
    df = np.diff([*first, len(term)])
    blocks = -(-df // BLOCK)
    firsts = np.concatenate([[0], np.cumsum(blocks)])
    starts = np.repeat(first, blocks) + BLOCK * (np.arange(firsts[-1]) - np.repeat(firsts[:-1], blocks))
    ends = np.append(starts, len(term))[1:]
    lasts = doc[ends - 1] if len(term) else np.empty(0, np.int64)
    opening = np.isin(np.arange(len(starts)), firsts)
    parts = [pack(doc[a:b], tf[a:b], -1 if new else lasts[i - 1]) for i, (a, b, new) in enumerate(zip(starts, ends, opening, strict=True))]
    whole = level_minima(tf, size[doc], first) if len(term) else np.empty((0, LEVELS + 2), np.int32)
    levels = level_minima(tf, size[doc], starts) if len(term) else whole
    ids = np.array([0 if d is None else d for d in doc_ids], np.int64)
    nulls = np.array([d is None for d in doc_ids], np.uint8)
    return [
        len(doc_ids), int(size.sum()), ids.tobytes(), nulls.tobytes(), size.astype(np.int32).tobytes(), [names[t].decode("utf-8", "replace") for t in present],
        df.astype(np.int32), whole[:, -1], list(whole[:, :-1]), firsts.astype(np.int32).tobytes(), lasts.astype(np.int32).tobytes(),
        np.cumsum([0, *map(len, parts)]).astype(np.int64).tobytes(), levels.tobytes(), b"".join(parts),
    ]


def build_index(df: DataFrame, vocabulary: np.ndarray | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A shard a row of every document's whole text; with ``vocabulary`` (bits of terms' hashes) of those terms, all counts being of all terms.

    Documents without a term are in no list and no count. Repeated rows are documents of their own,
    a null id stays null, an empty table gives an empty index.
    """
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    names = [f.split()[0] for f in INDEX.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            counted = np.concatenate(tf) if tf else np.empty(0, np.int64)
            row = shard_row(doc_ids, sizes, ids.names, np.concatenate(found) if found else counted, np.repeat(np.arange(len(doc_ids)), [len(x) for x in found]), counted)
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.list_(pa.int32())), *[pa.binary()] * 5]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names)

        ids, doc_ids, sizes, found, tf, held = TermIds(vocabulary), [], [], [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ws = terms_of(text.as_py())
                if not ws:
                    continue
                at = np.fromiter(map(ids.__getitem__, ws), np.int64, len(ws))
                u, n = np.unique(at[at >= 0], return_counts=True)
                doc_ids.append(doc_id)
                sizes.append(len(ws))
                found.append(u)
                tf.append(n.astype(np.int64))
                held += len(u)
                ids.trim()
                if len(doc_ids) >= SHARD_DOCS or held >= SHARD_POSTINGS:
                    yield flush()
                    ids, doc_ids, sizes, found, tf, held = TermIds(vocabulary), [], [], [], [], 0
        if doc_ids:
            yield flush()

    return docs.mapInArrow(run, INDEX)


@dataclass
class Item:
    terms: list[str]
    weights: np.ndarray
    bounds: np.ndarray


class Shard:
    """One row of the index, with what has been unpacked of it so far."""

    def __init__(self, row: dict, n_docs: int, n_terms: int):
        array = lambda name, kind: np.frombuffer(row[name], kind)
        self.ids, self.nulls = array("doc_ids", np.int64), array("null_ids", np.uint8)
        self.place = {t: i for i, t in enumerate(row["terms"])}
        self.firsts, self.lasts, self.offsets = array("firsts", np.int32), array("lasts", np.int32), array("offsets", np.int64)
        self.levels, self.payload = array("levels", np.int32).reshape(-1, LEVELS + 2), memoryview(row["payload"])
        self.totals = n_docs, n_terms
        self.norm = 20 * self.norms(array("sizes", np.int32))
        self.blocks: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.maxima: dict[int, np.ndarray] = {}

    def norms(self, sizes: np.ndarray) -> np.ndarray:
        """m of documents of these sizes, in whole numbers of any length."""
        n_docs, n_terms = self.totals
        distinct, back = np.unique(sizes, return_inverse=True)
        return np.array([100 - 50 + (50 * int(s) * n_docs) // n_terms for s in distinct], np.int64)[back]

    def block(self, b: int, t: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores for weight 1) of one block, unpacked at its first use."""
        if b not in self.blocks:
            docs, tf = unpack(self.payload[self.offsets[b] : self.offsets[b + 1]], -1 if b == self.firsts[t] else int(self.lasts[b - 1]))
            self.blocks[b] = docs, (1_000_000_000 * tf) // (1000 * tf + self.norm[docs])
        return self.blocks[b]

    def list(self, t: int) -> tuple[np.ndarray, np.ndarray]:
        if t not in self.lists:
            parts = [self.block(b, t) for b in range(self.firsts[t], self.firsts[t + 1])]
            self.lists[t] = tuple(np.concatenate(x) for x in zip(*parts, strict=True))
        return self.lists[t]

    def block_maxima(self, t: int) -> np.ndarray:
        """Highest score (for weight 1) a document can have in each block of a list, and 0 behind the last."""
        if t not in self.maxima:
            levels = self.levels[self.firsts[t] : self.firsts[t + 1]]
            best = np.zeros(len(levels) + 1, np.int64)
            for k in range(LEVELS + 1):
                there = levels[:, k] != NONE
                tf = np.full(int(there.sum()), k + 1, np.int64) if k < LEVELS else levels[there, LEVELS + 1].astype(np.int64)
                top = (1_000_000_000 * tf) // (1000 * tf + 20 * self.norms(levels[there, k]))
                best[:-1][there] = np.maximum(best[:-1][there], top)
            self.maxima[t] = best
        return self.maxima[t]

    def search(self, item: Item, floor: int, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(documents, exact scores) of all documents of the shard that reach ``floor``; ``scores`` is zeros, and is left so."""
        there = sorted((int(b), int(w), self.place[t]) for t, w, b in zip(item.terms, item.weights, item.bounds, strict=True) if t in self.place)
        reach = np.cumsum([b for b, _, _ in there])
        rest = int(np.searchsorted(reach, floor))  # the first lists, which together stay below the floor
        for _, w, t in there[rest:]:
            docs, unit = self.list(t)
            scores[docs] += w * unit
        docs = np.flatnonzero(scores)
        now = scores[docs]
        scores[docs] = 0
        others = there[:rest][::-1]
        if others and len(docs):
            at = [np.searchsorted(self.lasts[self.firsts[t] : self.firsts[t + 1]], docs) for _, _, t in others]
            top = [w * self.block_maxima(t)[a] for (_, w, t), a in zip(others, at, strict=True)]
            left = np.sum(top, axis=0)
            for k, (_, w, t) in enumerate(others):
                keep = now + left >= floor
                if not keep.all():
                    docs, now, left = docs[keep], now[keep], left[keep]
                    at[k:], top[k:] = [a[keep] for a in at[k:]], [x[keep] for x in top[k:]]
                left = left - top[k]
                for b in np.unique(at[k][top[k] > 0]):
                    found, unit = self.block(int(self.firsts[t] + b), t)
                    here = np.flatnonzero(at[k] == b)
                    place = np.searchsorted(found, docs[here])
                    hit = found[np.minimum(place, len(found) - 1)] == docs[here]
                    now[here[hit]] += w * unit[place[hit]]
        keep = now >= max(1, floor)
        return docs[keep], now[keep]


def best(scores: np.ndarray, nulls: np.ndarray, ids: np.ndarray, top: int) -> np.ndarray:
    """Places of the ``top`` highest scores; equal ones by ascending id, null ids last."""
    if len(scores) > 4 * top:  # ties at the cut stay in
        cut = np.partition(scores, len(scores) - top)[len(scores) - top]
        part = np.flatnonzero(scores >= cut)
        return part[best(scores[part], nulls[part], ids[part], top)] if len(part) < len(scores) else np.lexsort((ids, nulls, -scores))[:top]
    return np.lexsort((ids, nulls, -scores))[:top]


def search(df: DataFrame, items: DataFrame, *, top: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", index: DataFrame | None = None) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``top`` highest-scoring documents, equal scores by ascending doc_id.

    Scores are whole numbers, as the contract of the query gives them: a saturated term
    frequency, normed by document size, times floor(1000 ln((2N + 2) / (2 df + 1))), summed
    over the item's terms once each. ``index`` may be one that ``build_index`` wrote over the same
    documents; else one of the items' terms is built and written to the shared folder.

    Every document takes part with its whole text, every item is searched for. Rows of one item_id
    are one item; a null item id is an item, too. A null or empty text has no terms: such an
    item has no rows, such a document is never found. Repeated rows are ranked side by
    side; null doc_ids come last among equal scores. Empty tables give an empty result.
    """
    split = F.regexp_extract_all(F.translate(F.coalesce(F.col(item_text_col).cast("string"), F.lit("")), UPPER, LOWER), F.lit(TERM), 0)
    wanted = materialize(items.select(F.col(item_col).cast("long").alias("item_id"), F.explode(split).alias("term")).distinct(), "items")
    if index is None:
        keys = wanted.select(F.xxhash64("term").alias("key")).distinct()
        index = materialize(build_index(df, key_bits(keys, keys.count()), id_col=id_col, text_col=text_col), "index")
    total = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n"), F.coalesce(F.sum("n_terms"), F.lit(0)).alias("l")).first()
    each = index.select(F.explode(F.arrays_zip("terms", "dfs", "highest", "least")).alias("t")).select("t.*")
    # what the shards say of a term, then what its score can reach anywhere
    sizes = [F.min(F.col("least")[k]).alias(f"s{k}") for k in range(LEVELS + 1)]
    stats = each.join(wanted.select(F.col("term").alias("terms")).distinct(), "terms", "left_semi")
    stats = stats.groupBy("terms").agg(F.sum("dfs").alias("df"), F.max("highest").alias("tf"), *sizes)
    weight = F.floor(F.lit(1000) * F.log((F.lit(2) * F.lit(total["n"]) + 2).cast("double") / (F.lit(2) * F.col("df") + 1).cast("double")))
    weighed = materialize(wanted.join(stats.withColumn("w", weight), F.col("term") == F.col("terms")).drop("terms"), "weights")
    passes = max(1, -(-weighed.count() // BLOCK_TERMS))
    schema = "item_id long, doc_id long, score long"
    heaps = []
    for turn in range(passes):
        # a bounded block of items; each pass holds all documents against it
        rows = weighed.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == turn).orderBy("item_id", "term").collect()
        heaps.append(index.mapInArrow(_searcher(rows, total["n"], total["l"], top), schema))
    found = heaps[0]
    for h in heaps[1:]:
        found = found.unionByName(h)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    group = F.pmod(F.xxhash64("doc_id"), F.lit(MERGE_GROUPS)).alias("g")
    place = F.row_number().over(Window.partitionBy("item_id", "g").orderBy(*order))
    found = found.select("*", group).withColumn("rank", place).where(F.col("rank") <= top)
    place = F.row_number().over(Window.partitionBy("item_id").orderBy(*order))
    return found.withColumn("rank", place).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def _searcher(rows: list, n_docs: int, n_terms: int, top: int):
    """The task that holds every shard it reads against the items of ``rows`` (item_id, term, df, tf, s0.., w)."""
    grouped: dict[int | None, list] = {}
    for r in rows:
        grouped.setdefault(r["item_id"], []).append(r)

    def reach(r) -> int:
        highest = 0
        for k in range(LEVELS + 1):
            if r[f"s{k}"] is not None and r[f"s{k}"] != NONE:
                tf = k + 1 if k < LEVELS else r["tf"]
                highest = max(highest, (1_000_000_000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * r[f"s{k}"] * n_docs) // n_terms)))
        return r["w"] * highest

    items = {i: Item([r["term"] for r in rs], np.array([r["w"] for r in rs], np.int64), np.array([reach(r) for r in rs], np.int64)) for i, rs in grouped.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = {i: (np.empty(0, np.int64), np.empty(0, np.uint8), np.empty(0, np.int64)) for i in items}
        for batch in batches:
            for at in range(batch.num_rows):
                shard = Shard(batch.slice(at, 1).to_pylist()[0], n_docs, n_terms)
                zeros = np.zeros(len(shard.ids), np.int64)
                for i, item in items.items():
                    held = heaps[i]
                    floor = int(held[0][-1]) if len(held[0]) == top else 1
                    docs, scores = shard.search(item, floor, zeros)
                    if len(docs):
                        all_ = [np.concatenate(x) for x in zip(held, (scores, shard.nulls[docs], shard.ids[docs]), strict=True)]
                        keep = best(*all_, top)
                        heaps[i] = tuple(x[keep] for x in all_)
        for i, (scores, nulls, ids) in heaps.items():
            if len(scores):
                yield pa.RecordBatch.from_arrays([pa.array([i] * len(scores), pa.int64()), pa.array(ids, pa.int64(), mask=nulls.astype(bool)), pa.array(scores, pa.int64())], ["item_id", "doc_id", "score"])

    return run

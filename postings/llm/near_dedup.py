"""Near-copy groups by circulant MinHash, banding and exact verification."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postings.llm.common import classes, materialize, mix64, windows, word_hashes

#: 32 bands of 5 coordinates: a pair of similarity 0.8 is missed with probability (1 - 0.8**5)**32 = 3e-6.
BANDS, ROWS = 32, 5


def shingle_set(text: bytes | None, k: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct k-word shingles of a text, ASCII letters lower-cased.

    A text of fewer than k words has its whole word sequence as one shingle; one without
    words has none.
    """
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(windows(word_hashes.of(words), min(k, len(words))))


def circulant_signature(shingles: np.ndarray, size: int) -> np.ndarray:
    """C-MinHash: one permutation scatters the shingles, a second one is shifted circularly.

    Coordinate j is the least pi(sigma(x) + j mod 2**32) over the set. sigma is a 64-bit mix cut
    to 32 bits, pi the 32-bit bijection below; no further hash functions are drawn.
    """
    scattered = (mix64(shingles ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)).astype(np.uint32)
    shifts = np.arange(size, dtype=np.uint32)[:, None]
    least = np.full(size, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(scattered), 512):
        x = scattered[None, at : at + 512] + shifts
        x ^= x >> np.uint32(16)
        x *= np.uint32(0x85EBCA6B)
        x ^= x >> np.uint32(13)
        x *= np.uint32(0xC2B2AE35)
        x ^= x >> np.uint32(16)
        np.minimum(least, x.min(axis=1), out=least)
    return least


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band of each signature; the band's number is part of the key."""
    cut = signatures.reshape(len(signatures), bands, rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(signatures), bands))
    for i in range(rows):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + cut[:, :, i])
    return key.view(np.int64)


def sketches(signatures: np.ndarray) -> np.ndarray:
    """The lowest two bits of each coordinate, 32 coordinates to a 64-bit word."""
    n, size = signatures.shape
    bits = np.zeros((n, -(-size // 32) * 32), np.uint64)
    bits[:, :size] = signatures & np.uint32(3)
    return (bits.reshape(n, -1, 32) << np.arange(0, 64, 2, dtype=np.uint64)).sum(axis=2, dtype=np.uint64).view(np.int64)


def _ints(lists: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
    flat = np.concatenate(lists) if lists else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def signatures(docs: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, n_shingles, digest, bands, sketch) of each row of docs(doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            known: dict[bytes, int] = {}
            sizes, digests, which, found = [], [], [], []
            for text in texts:
                s = shingle_set(text, k)
                digest = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                if digest not in known:  # copies inside a batch share their signature
                    known[digest] = len(found)
                    found.append(circulant_signature(s, bands * rows))
                sizes.append(len(s))
                digests.append(digest)
                which.append(known[digest])
            drawn = np.array(found, np.uint32).reshape(len(found), bands * rows)
            keys, short = band_keys(drawn, bands, rows), sketches(drawn)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), _ints([keys[i] for i in which]), _ints([short[i] for i in which])],
                ["doc_id", "n_shingles", "digest", "bands", "sketch"],
            )

    return docs.mapInArrow(run, "doc_id long, n_shingles long, digest binary, bands array<long>, sketch array<long>")


def shingle_sets(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, shingles) of docs(doc_id, text): the full sets that links are confirmed on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, k) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _ints(sets)], ["doc_id", "shingles"])

    return docs.mapInArrow(run, "doc_id long, shingles array<long>")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of pairs (a, b) whose sets have 100 * intersection >= percent * union."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (
        pairs.join(right, "b")
        .join(left, "a")
        .where(100 * F.least(F.size("sa"), F.size("sb")) >= percent * F.greatest(F.size("sa"), F.size("sb")))
        .where(100 * both >= percent * (F.size("sa") + F.size("sb") - both))
        .select("a", "b")
    )


def unsettled(open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different classes that share a bucket and that sets allow to be links.

    All members of a bucket are compared with its smallest one, h. What a member has besides h
    is its extra. Two sets without a common extra share at most what each shares with h, so
    such a pair is only made if both lie so close to h that this still suffices; all other
    pairs are found by a join on their rarest extras. This is exact and avoids testing each
    member on the edge of a large group against the whole group.
    """
    near = open_.select(F.col("a").alias("h"), "node", "class").distinct()
    mine, base = sets.select(F.col("doc_id").alias("node"), F.col("shingles").alias("s")), sets.select(F.col("doc_id").alias("h"), F.col("shingles").alias("t"))
    extra = F.array_except("s", "t")
    near = near.join(mine, "node").join(base, "h").select("h", "node", "class", F.size("s").alias("n"), extra.alias("extra"), (F.size("s") - F.size(extra)).alias("same"))
    near = materialize(near, "near")
    least = near.groupBy("h").agg(F.min("n").alias("least"))
    loose = near.drop("extra").join(least, "h").where(f"100 * same >= {percent} * (least + n - same)")
    x, y = loose.alias("x"), loose.alias("y")
    m = F.least("x.same", "y.same")
    close = (F.col("x.h") == F.col("y.h")) & (F.col("x.class") < F.col("y.class")) & (100 * m >= percent * (F.col("x.n") + F.col("y.n") - m))
    close = x.join(y, close).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    spread = near.select("h", "node", "class", "n", "same", F.explode("extra").alias("e"))
    # u and v need so many common extras; a member's least need, over any partner, tells which of its
    # extras may be left out: with the rarest first, one of the others would be common too
    often = spread.groupBy("h", "e").agg(F.count(F.lit(1)).alias("often"))
    ranked = spread.join(often, ["h", "e"]).groupBy("h", "node", "class", "n", "same").agg(F.sort_array(F.collect_list(F.struct("often", "e"))).alias("extra"))
    need = F.greatest(F.lit(1), F.ceil(percent * (F.col("n") + F.col("least")) / (100 + percent)) - F.col("same"))
    ranked = ranked.join(least, "h").withColumn("count", F.size("extra")).where(need <= F.col("count"))
    first = ranked.select("h", "node", "class", "n", "same", "count", F.explode(F.slice("extra", F.lit(1), (F.col("count") - need + 1).cast("int"))).alias("e"))
    x, y = first.alias("x"), first.alias("y")
    needed = F.ceil(percent * (F.col("x.n") + F.col("y.n")) / (100 + percent)) - m
    common = (F.col("x.h") == F.col("y.h")) & (F.col("x.e") == F.col("y.e")) & (F.col("x.class") < F.col("y.class")) & (needed <= F.least("x.count", "y.count"))
    common = x.join(y, common).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    return close.unionByName(common).distinct()


def plausible(size: int, percent: int, x: str, y: str) -> Column:
    """Whether two documents' sizes and sketches allow a similarity of ``percent``.

    Sketch entries of such a pair differ with probability 0.75 * (1 - similarity) at most; more
    than six standard deviations above that are ruled out (one such pair in 10**9).
    """
    p = 0.75 * (1 - percent / 100)
    most = math.ceil(size * p + 6 * math.sqrt(size * p * (1 - p)))
    n, m = F.col(f"{x}.n_shingles"), F.col(f"{y}.n_shingles")
    differ = F.lit(0)
    for i in range(-(-size // 32)):
        d = F.get(F.col(f"{x}.sketch"), F.lit(i)).bitwiseXOR(F.get(F.col(f"{y}.sketch"), F.lit(i)))
        differ = differ + F.bit_count(d.bitwiseOR(F.shiftrightunsigned(d, 1)).bitwiseAND(F.lit(0x5555555555555555)))
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (differ <= most)


def near_duplicates(
    df: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row of ``df``.

    Documents of equal shingle sets collapse first (a 128-bit digest, combined before the
    shuffle). Documents that share a band bucket are candidates; ``classes`` tests them without
    making all pairs of a bucket and without losing a link. Links are confirmed on full sets.

    Null or wordless text: no shingles, linked with nothing. A null id: linked with nothing,
    component null, kept. Repeated ids are one document, linked if any of its rows links, and
    each row is returned. An empty table gives an empty result; other columns are ignored.
    """
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = materialize(signatures(docs, k, bands, rows), "signatures")
    full = signed.where("n_shingles > 0 and doc_id is not null")
    first = full.groupBy("digest").agg(F.min(F.struct("doc_id", "n_shingles", "bands", "sketch")).alias("r"), F.max("doc_id").alias("last"))
    reps = materialize(first.select("digest", "last", "r.*"), "representatives")
    buckets = reps.select(F.col("doc_id").alias("node"), F.explode("bands").alias("key"))
    shared = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    members = materialize(buckets.join(shared, "key").select("key", "node"), "members")
    wanted = members.select(F.col("node").alias("doc_id")).distinct()
    sets = materialize(shingle_sets(docs.join(wanted, "doc_id", "left_semi"), k), "sets")
    several = full.groupBy("doc_id").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi")).where("lo <> hi").select("doc_id")
    same = full.join(several, "doc_id").join(reps.select("digest", F.col("doc_id").alias("b")), "digest").select(F.col("doc_id").alias("a"), "b")
    found = classes(
        members,
        reps.select(F.col("doc_id").alias("node"), "n_shingles", "sketch"),
        lambda x, y: plausible(bands * rows, percent, x, y),
        lambda pairs: confirmed(pairs, sets, percent),
        same,
        lambda open_: unsettled(open_, sets, percent),
    )

    # every document to its representative, every representative to its component
    copies = full.join(reps.where("last > doc_id").select("digest", F.col("doc_id").alias("rep")), "digest")
    copies = copies.where("doc_id <> rep").select(F.col("doc_id").alias("node"), "rep")
    moved = copies.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("node", F.coalesce("component", "rep").alias("component"))
    where = found.unionByName(moved).groupBy("node").agg(F.min("component").alias("component"))
    out = signed.select("doc_id", "n_shingles").join(where, F.col("doc_id") == F.col("node"), "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))

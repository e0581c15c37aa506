"""Repeated passages: 13-word windows counted exactly in super-k-mer buckets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postings.llm.common import mix64, windows, word_hashes

WIDTH, MINIMISER = 13, 3
#: Text in a map task's working set, and packed bytes that a bucket should hold.
CHUNK_BYTES, BUCKET_BYTES = 12_000_000, 40_000_000
#: Documents sampled to find frequent word triples (they are only avoided as minimisers; no result depends on them).
SAMPLE_DOCS = 4000
RANGES = "doc_id long, row_hash long, start int, stop int"


def sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """The least of every w consecutive entries, by doubling."""
    n, p = len(v) - w + 1, 1
    while 2 * p <= w:
        v = np.minimum(v[:-p], v[p:])
        p *= 2
    return np.minimum(v[:n], v[w - p : w - p + n]) if p < w else v[:n]


def super_kmers(h: np.ndarray, k: int, m: int, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(minimiser, first window, windows) of each run of consecutive k-word windows with one minimiser.

    Word m-grams are ordered by a hash, frequent ones after all others, so that a passage many
    documents share isn't chosen by the windows that reach out of it.
    """
    grams = windows(h, m)
    order = mix64(grams ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(1)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, grams), len(frequent) - 1)
        order |= (frequent[at] == grams).astype(np.uint64) << np.uint64(63)
    least = sliding_min(order, k - m + 1)
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    return least[first], first, np.diff(np.append(first, len(least)))


def frequent_grams(docs: DataFrame, rows: int, m: int) -> np.ndarray:
    """Hashes of m-grams in one of 200 sampled documents or more, 20,000 at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                grams = np.unique(windows(word_hashes.of((text or b"").split()), m)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(grams)], ["gram"])

    sampled = docs.select("text").sample(min(1.0, SAMPLE_DOCS / max(rows, 1)), seed=7)
    counted = sampled.mapInArrow(run, "gram long").groupBy("gram").count()
    least = max(8, min(rows, SAMPLE_DOCS) // 200)
    top = counted.where(F.col("count") >= least).orderBy(F.desc("count"), "gram").limit(20_000).select("gram")
    return np.sort(np.array([r[0] for r in top.collect()], np.int64).view(np.uint64))


def _merge(start: int, flags: list[bool], k: int) -> Iterator[tuple[int, int]]:
    """Word ranges that runs of removed windows cover."""
    i = 0
    while i < len(flags):
        if flags[i]:
            j = i
            while j + 1 < len(flags) and flags[j + 1]:
                j += 1
            yield start + i, start + j + k
            i = j
        i += 1


def _blob(mins, docs, rows, starts, counts, packed: list[bytes]) -> bytes:
    """Super-k-mers of one bucket, compressed; 32 bits of a minimiser are enough to group them, windows are compared in full."""
    head = np.array([len(packed)], "<u8").tobytes()
    sizes = np.fromiter(map(len, packed), np.uint32, len(packed))
    columns = [np.asarray(mins, np.uint64).astype(np.uint32), np.asarray(docs, np.int64), np.asarray(rows, np.int64), np.asarray(starts, np.uint32), np.asarray(counts, np.uint32), sizes]
    return zstandard.ZstdCompressor(level=6).compress(b"".join([head, *(c.tobytes() for c in columns), *packed]))


def _unblob(data: bytes) -> tuple[list[np.ndarray], list[bytes]]:
    data = zstandard.ZstdDecompressor().decompress(data)
    n, at, columns = int.from_bytes(data[:8], "little"), 8, []
    for kind in (np.uint32, np.int64, np.int64, np.uint32, np.uint32, np.uint32):
        columns.append(np.frombuffer(data, kind, n, at))
        at += n * columns[-1].itemsize
    ends = (at + np.cumsum(columns[5], dtype=np.int64)).tolist()
    return columns[:5], [data[a:b] for a, b in zip([at, *ends[:-1]], ends, strict=True)]


def _cut(chunk: list[tuple[int, int, bytes]], buckets: int, k: int, m: int, frequent: np.ndarray) -> Iterator[tuple[int, bytes, list]]:
    """A chunk's super-k-mers as (bucket, blob, []), and (bucket, b"", ranges) of those settled here.

    Of equal strings only those of the smallest document travel: the others are repeats of it.
    """
    chunk.sort(key=lambda r: r[0])
    seen: dict[bytes, int] = {}
    mins, docs, rows, starts, counts, packed, settled = [], [], [], [], [], [], []
    for doc, row, text in chunk:
        words = text.split()
        if len(words) < k:
            continue
        least, first, n = super_kmers(word_hashes.of(words), k, m, frequent)
        line = b" ".join(words)
        off = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)])
        for mini, s, c, a, b in zip(least.tolist(), first.tolist(), n.tolist(), off[first].tolist(), (off[first + n + k - 1] - 1).tolist(), strict=True):
            string = line[a:b]
            if seen.setdefault(string, doc) != doc:
                settled.append((doc, row, s, s + c + k - 1))
                continue
            mins.append(mini)
            docs.append(doc)
            rows.append(row)
            starts.append(s)
            counts.append(c)
            packed.append(string)
    if packed:
        mins = np.array(mins, np.uint64)
        bucket = (mix64(mins) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
            at = part.tolist()
            pick = lambda xs, at=at: [xs[i] for i in at]
            yield int(bucket[at[0]]), _blob(mins[part], pick(docs), pick(rows), pick(starts), pick(counts), pick(packed)), []
    for i in range(0, len(settled), 20_000):
        yield settled[i][0] % buckets, b"", settled[i : i + 20_000]


def _count(mins, docs, rows, starts, counts, packed: list[bytes], k: int) -> list[tuple[int, int, int, int]]:
    """Ranges of a bucket's windows whose words start in a smaller document too: equal windows meet by sorting."""
    out: list[tuple[int, int, int, int]] = []
    order = np.lexsort((docs, mins))
    cuts = np.flatnonzero(np.diff(mins[order])) + 1
    begins = np.concatenate([[0], cuts])
    ends = np.append(cuts, len(order))
    several = docs[order[begins]] != docs[order[ends - 1]]
    for a, b in zip(begins[several].tolist(), ends[several].tolist(), strict=True):
        group = sorted(((packed[i], int(docs[i]), i) for i in order[a:b].tolist()))
        left, last, least = [], None, 0
        for string, doc, i in group:
            if string != last:
                last, least = string, doc
            if doc > least:
                out.append((doc, int(rows[i]), int(starts[i]), int(starts[i] + counts[i]) + k - 1))
            else:
                left.append((string, doc, i))
        if len(left) < 2 or left[0][0] == left[-1][0]:
            continue
        table = []
        for n, (string, doc, _) in enumerate(left):
            off, at = [0], string.find(b" ")
            while at >= 0:
                off.append(at + 1)
                at = string.find(b" ", at + 1)
            off.append(len(string) + 1)
            table += [(string[off[j] : off[j + k] - 1], doc, n, j) for j in range(len(off) - k)]
        table.sort()
        flags = [[False] * int(counts[i]) for _, _, i in left]
        last, least = None, 0
        for window, doc, n, j in table:
            if window != last:
                last, least = window, doc
            elif doc > least:
                flags[n][j] = True
        for f, (_, doc, i) in zip(flags, left, strict=True):
            # an equal string of the same document has the same windows
            out += [(doc, int(rows[i]), s, e) for s, e in _merge(int(starts[i]), f, k)]
    return out


def _range_batch(found: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    columns = zip(*found, strict=True) if found else ([], [], [], [])
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["doc_id", "row_hash", "start", "stop"])


def repeated_ranges(docs: DataFrame, k: int = WIDTH, m: int = MINIMISER) -> DataFrame:
    """Word ranges of docs(doc_id, row_hash, text) covered by windows that start in a smaller document too."""
    known = docs.where("doc_id is not null and text is not null")
    total = known.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    spark = docs.sparkSession
    buckets = int(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total[1] * 7 // (2 * BUCKET_BYTES))))
    frequent = frequent_grams(known, total[0], m)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(chunk):
            for bucket, blob, ranges in _cut(chunk, buckets, k, m, frequent):
                cols = list(zip(*ranges, strict=True)) if ranges else [[], [], [], []]
                lists = [pa.array([list(c)], pa.list_(t)) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([blob], pa.binary()), *lists], ["bucket", "blob", "doc_id", "row_hash", "start", "stop"])

        chunk, held = [], 0
        for batch in batches:
            rows = zip(batch.column("doc_id").to_pylist(), batch.column("row_hash").to_pylist(), batch.column("text").cast(pa.binary()), strict=True)
            for doc, row, text in rows:
                chunk.append((doc, row, text.as_py()))
                held += len(chunk[-1][2])
                if held >= CHUNK_BYTES:
                    yield from out(chunk)
                    chunk, held = [], 0
        if chunk:
            yield from out(chunk)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, blobs = None, []

        def settle():
            parts = [_unblob(b) for b in blobs]
            columns = [np.concatenate([p[0][i] for p in parts]) for i in range(5)]
            found = _count(*columns, [s for p in parts for s in p[1]], k)
            for i in range(0, len(found), 50_000):
                yield _range_batch(found[i : i + 50_000])

        for batch in batches:
            for row in batch.to_pylist():
                if row["doc_id"]:
                    yield _range_batch(list(zip(row["doc_id"], row["row_hash"], row["start"], row["stop"], strict=True)))
                    continue
                if row["bucket"] != now and blobs:
                    yield from settle()
                    blobs = []
                now = row["bucket"]
                blobs.append(row["blob"])
        if blobs:
            yield from settle()

    schema = "bucket int, blob binary, doc_id array<long>, row_hash array<long>, start array<int>, stop array<int>"
    dealt = known.mapInArrow(cut, schema).repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(count, RANGES)


def drop_repeats(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", k: int = WIDTH) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) of each row: words of repeated k-word windows removed.

    A window counts as repeated if its words also start in a document with a smaller id, as
    judged on the input. Null text: no words, empty kept text. A null id: nothing is removed
    and it makes no other row's window a repeat. Rows of one id don't repeat each other.
    Texts of fewer than k words stay whole. Kept words are joined by one space. Other columns
    are ignored; an empty table gives an empty result.
    """
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    docs = docs.withColumn("row_hash", F.xxhash64("text"))
    ranges = repeated_ranges(docs, k)
    by_row = ranges.groupBy("doc_id", "row_hash").agg(F.collect_set(F.struct("start", "stop")).alias("ranges"))
    joined = docs.join(by_row, ["doc_id", "row_hash"], "left").select("doc_id", "text", "ranges")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, gone, kept = [], [], []
            for text, ranges in zip(batch.column("text").cast(pa.binary()), batch.column("ranges").to_pylist(), strict=True):
                words = (text.as_py() or b"").split()
                n.append(len(words))
                left, at = [], 0
                for r in sorted((r["start"], r["stop"]) for r in ranges or []):
                    left += words[at : r[0]]
                    at = max(at, r[1])
                left += words[at:]
                gone.append(len(words) - len(left))
                kept.append(b" ".join(left))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept_text"])

    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_text string")

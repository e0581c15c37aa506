"""Token-id files: fixed-width packed ids in blocks, written and read by Spark tasks.

A ``.tok`` file holds, little-endian and in this order: a header (magic, width of an id in
bits, ids in a block, documents, ids, blocks), a byte a document that says whether its id is
known, the document ids (int64), ids in each document (uint64), the byte offset of each block in
the payload (uint64, one more than blocks) and the payload. Every block starts on a byte, so
that any id is found by one seek and a block is unpacked by numpy at once.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postings.llm.common import fresh_path, materialize

MAGIC, HEADER = b"PACKTOK1", struct.Struct("<8sIIQQQ")
BLOCK, FILE_IDS = 4096, 8_000_000
MANIFEST = "path string, part int, seq int, n_docs long, n_ids long"
_encoders: dict[str, Encoder] = {}


def pack(ids: np.ndarray, bits: int) -> bytes:
    """The ids' lowest ``bits`` bits, one after the other, from the lowest bit of each byte on."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    cut = ((ids.astype(np.uint64)[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    return np.packbits(cut.ravel(), bitorder="little").tobytes()


def unpack(data: bytes | memoryview, bits: int, n: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype(np.uint32)
    flat = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    return (flat.astype(np.uint64) << np.arange(bits, dtype=np.uint64)).sum(axis=1).astype(np.uint32)


def to_file(doc_ids: list[int | None], counts: list[int], ids: np.ndarray, bits: int, block: int = BLOCK) -> bytes:
    packed = [pack(ids[i : i + block], bits) for i in range(0, len(ids), block)]
    ends = np.cumsum([0, *map(len, packed)]).astype("<u8")
    known = np.array([d is not None for d in doc_ids], np.uint8)
    head = HEADER.pack(MAGIC, bits, block, len(doc_ids), len(ids), len(packed))
    return b"".join([head, known.tobytes(), np.array([d or 0 for d in doc_ids], "<i8").tobytes(), np.array(counts, "<u8").tobytes(), ends.tobytes(), *packed])


class TokenFile:
    """A file's bytes: its document table, all its ids, or any range of them."""

    def __init__(self, data: bytes):
        magic, self.bits, self.block, docs, self.n_ids, blocks = HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token file")
        at = HEADER.size
        known = np.frombuffer(data, np.uint8, docs, at)
        ids = np.frombuffer(data, "<i8", docs, at + docs)
        self.doc_ids = [int(d) if k else None for d, k in zip(ids, known, strict=True)]
        self.counts = np.frombuffer(data, "<u8", docs, at + 9 * docs).astype(np.int64)
        self.ends = np.frombuffer(data, "<u8", blocks + 1, at + 17 * docs).astype(np.int64)
        self.payload = memoryview(data)[at + 17 * docs + 8 * (blocks + 1) :]

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        stop = self.n_ids if stop is None else min(stop, self.n_ids)
        if start >= stop:
            return np.empty(0, np.uint32)
        lo, hi = start // self.block, (stop - 1) // self.block
        got = [unpack(self.payload[self.ends[i] : self.ends[i + 1]], self.bits, min(self.block, self.n_ids - i * self.block)) for i in range(lo, hi + 1)]
        return np.concatenate(got)[start - lo * self.block : stop - lo * self.block]


def byte_letters() -> dict[int, str]:
    """The letter that spells each byte in a byte-level vocabulary: printable Latin-1 itself, others from U+0100 on."""
    plain = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace()]
    other = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(other)}


class Encoder:
    """Whole texts to little-endian 32-bit ids by a file of the tokenizers library.

    The byte-level pre-tokens never reach over a space or a newline that stands between
    non-spaces, nor over a point or comma after a letter. A text is cut there, and each distinct
    piece is encoded once while the bounded cache holds it. Texts with two white-space
    characters together, or that spell a special token, are encoded in one go. Both ways give
    the library's ids of the whole text.
    """

    def __init__(self, path: str, most: int = 500_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.most, self.cache = Tokenizer.from_file(path), most, {}
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = re.compile("|".join([r"\s\s", *special]))
        self.bits = max(1, (self.tokenizer.get_vocab_size() - 1).bit_length())
        # the vocabulary spells a space and a newline as these letters; a token that begins so begins a piece
        self.begins = np.zeros(1 << self.bits, bool)
        self.begins[[i for t, i in self.tokenizer.get_vocab().items() if t[0] in "\u0120\u010a"]] = True
        self.tails = {c: self._one(c) for c in ".,"}
        self.letters, self.split_word = byte_letters(), self.tokenizer.model.tokenize

    def _one(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _learn(self, pieces: set[str]) -> None:
        """Put the pieces in the cache: most in one text, whose ids are cut where a piece begins."""
        cache, tails = self.cache, self.tails
        if len(cache) + len(pieces) > self.most:
            cache.clear()
        stems = {p[:-1] if p[-1:] in tails and p[-2:-1].isalpha() else p for p in pieces}
        new = [p for p in stems if p not in cache]
        for p in new:
            if p.isalpha():  # one pre-token: straight to the merges
                spelt = p if p.isascii() else p.encode().decode("latin-1").translate(self.letters)
                cache[p] = array("I", [t.id for t in self.split_word("\u0120" + spelt)]).tobytes()
        joint = [p for p in new if p and not p.isalpha() and not p[-1].isspace()]
        if joint:
            ids = np.array(self.tokenizer.encode("".join(p if p[0] == "\n" else " " + p for p in joint), add_special_tokens=False).ids, "<u4")
            cuts = np.flatnonzero(self.begins[ids]).tolist()
            if len(cuts) == len(joint):
                data = ids.tobytes()
                cache.update((p, data[4 * a : 4 * b]) for p, a, b in zip(joint, cuts, [*cuts[1:], len(ids)], strict=True))
        for p in new:
            if p not in cache:
                cache[p] = self._one(p if p[:1] == "\n" else " " + p)
        for p in pieces:
            if p not in cache:
                cache[p] = cache[p[:-1]] + tails[p[-1]]

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        if self.whole.search(text):
            return self._one(text)
        first, *pieces = text.replace("\n", " \n").split(" ")
        got = list(map(self.cache.get, pieces))
        if None in got:
            new = {p for p, g in zip(pieces, got, strict=True) if g is None}
            self._learn(new)
            cache = self.cache
            got = [cache[p] if g is None else g for p, g in zip(pieces, got, strict=True)]
        return (self._one(first) if first else b"") + b"".join(got)


def encoder(path: str) -> Encoder:
    """One for each worker process and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a full URI; a path without a scheme could mean another one to Spark than here."""
    if ":" not in uri:
        raise ValueError(f"token files need a full URI, not {uri}")
    return pafs.FileSystem.from_uri(uri)


def write_token_files(
    df: DataFrame,
    uri: str,
    tokenizer_path: Callable[[], str],
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 0,
    file_ids: int = FILE_IDS,
) -> DataFrame:
    """Encode every text, in ascending id order, to token files under ``uri``; the manifest of the files.

    Rows are dealt out by ranges of the id (nulls first) before they are encoded, so only texts
    are shuffled and every task writes its own files. A retried or speculative task writes
    under other names; only files in the manifest count, and Spark commits that as a table.
    ``tokenizer_path`` is called in the tasks. Null text counts as empty; every document ends
    with ``end_id``. Other columns are ignored.
    """
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer_path()), np.array([end_id], "<u4").tobytes()
        files, where = filesystem(uri)
        part, seq, ids, counts, data, total = TaskContext.get().partitionId(), 0, [], [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal seq, ids, counts, data, total
            name = f"part-{part:06d}-{seq:05d}-{uuid.uuid4().hex}.tok"
            files.create_dir(where, recursive=True)
            with files.open_output_stream(f"{where}/{name}") as out:
                out.write(to_file(ids, counts, np.frombuffer(b"".join(data), "<u4"), encode.bits))
            row = pa.RecordBatch.from_arrays([pa.array([name]), pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(ids)]), pa.array([total])], ["path", "part", "seq", "n_docs", "n_ids"])
            seq, ids, counts, data, total = seq + 1, [], [], [], 0
            return row

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                got = encode(text.as_py()) + end
                ids.append(doc)
                data.append(got)
                counts.append(len(got) // 4)
                total += counts[-1]
                if total >= file_ids:
                    yield flush()
        if ids:
            yield flush()

    ordered = docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    return materialize(ordered.mapInArrow(run, MANIFEST), "manifest")


def with_starts(manifest: DataFrame) -> DataFrame:
    """The manifest with ``start``, the ids in all files before: running totals by task, then over tasks."""
    tasks = manifest.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = tasks.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_ids")
    return manifest.withColumn("inside", inside).join(before, "part").select("path", "n_docs", "n_ids", (F.col("before") + F.col("inside")).alias("start"))


def read_token_files(manifest: DataFrame, uri: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the manifest's files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, where = filesystem(uri)
        for batch in batches:
            for row in batch.to_pylist():
                with files.open_input_stream(f"{where}/{row['path']}") as source:
                    file = TokenFile(source.read())
                ids, ends = file.ids().astype("<u4"), np.cumsum(file.counts)
                begins = ends - file.counts
                crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(begins, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(file.doc_ids, pa.int64()), pa.array(begins + row["start"]), pa.array(file.counts), pa.array(crcs, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    listed = with_starts(manifest).select("path", "start").repartition("path")
    return listed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def public_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def token_files(spark: SparkSession, df: DataFrame, tokenizer_path: Callable[[], str] = public_vocabulary) -> DataFrame:
    """Write ``df``'s token files to a new folder of the shared directory and read them back.

    An empty table gives no files and no rows; repeated ids stay separate documents, side by
    side; a null id comes first and is read back as null.
    """
    uri = fresh_path(spark, "tokens")
    return read_token_files(write_token_files(df, uri, tokenizer_path), uri)

"""Benchmark decontamination by word templates with typed slots and a slot-consistency check."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postings.llm.common import WordHash, key_bits, materialize, mix64, pieces, with_bit

WIDTH, LEAST_LITERAL = 8, 4
#: Items of fewer words than a window are matched whole, down to this many: shorter phrases prove nothing.
SHORTEST = 4
#: What counts as a unit after a number.
UNITS = frozenset(
    b"% percent mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg lb lbs oz ounce ounces pound pounds ton tons ml cl l liter liters litre litres gallon gallons "
    b"s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years dollar dollars euro euros cent cents usd eur gbp "
    b"hz khz mhz ghz w kw v a j kj cal kcal c f k degrees degree mph kmh km/h mb gb tb".split()
)
_EDGES = ".,;:!?()[]{}\"'`*_-“”‘’«»…–—¡¿"
_ENDS = (b".", b"!", b"?", b":", b"\xe2\x80\xa6", b'."', b'!"', b'?"')
_NUMBERS = frozenset(b"one two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty hundred thousand million".split())
_SLOTS = {1: xxhash.xxh3_64_intdigest(b"\x00number"), 2: xxhash.xxh3_64_intdigest(b"\x00name"), 3: xxhash.xxh3_64_intdigest(b"\x00unit")}


NUMBER_BIT, UNIT_BIT, CAPITAL_BIT, END_BIT = (np.uint64(1 << i) for i in range(4))


class Token(WordHash):
    """word -> hash of the bare lower-case word, its low four bits: number, unit, capitalised, ends a sentence."""

    def __missing__(self, word: bytes) -> int:
        bare = word.decode("utf-8", "replace").strip(_EDGES)
        low = bare.lower().encode()
        digits = 0 if bare.isalpha() else sum(c.isdigit() for c in bare)
        number = bool(digits) and 2 * digits >= len(bare) or low in _NUMBERS
        flags = number | (low in UNITS or word == b"%") << 1 | (bare[:1].isupper() and not bare.isupper() and not number) << 2 | word.endswith(_ENDS) << 3
        if len(self) >= self.most:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(low) & ~15 | flags
        return found


_tokens = Token(120_000)


def windows_of(h: np.ndarray, widths: tuple[int, ...]) -> list[np.ndarray]:
    """The hashes that ``windows`` gives for each of the ascending widths, from one pass: a wider one goes on where a narrower one ends."""
    out, found, k = h.copy(), [], 1
    for width in widths:
        while k < width and len(out) > 1:
            out = mix64(out[:-1]) + h[k:]
            k += 1
        found.append(mix64(out) if k == width else np.empty(0, np.uint64))
    return found


def templates(words: list[bytes], starts: np.ndarray, firsts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(hashes, slot types) of the words of texts that begin at ``firsts``, read in four ways: 1 number, 2 name, 3 unit after a number, 0 a literal word.

    A name is a capitalised word (not one in capitals) that doesn't begin a sentence or the text.
    The first reading has no slots at all. The second has no names, so that case is no matter;
    the third has names; the fourth also where a line starts (``starts``), which may be a
    sentence's start or a wrapped line.
    """
    h = _tokens.of(words)
    if not len(h):
        return []
    number, unit, capital, ends = ((h & bit) != 0 for bit in (NUMBER_BIT, UNIT_BIT, CAPITAL_BIT, END_BIT))
    h &= ~np.uint64(15)
    capital[1:] &= ~ends[:-1]
    capital[firsts] = False
    found = [(h.copy(), np.zeros(len(h), np.int8))]
    plain = np.zeros(len(h), np.int8)
    after = unit[1:] & number[:-1]
    after[firsts[1:] - 1] = False  # a number that ends another text
    plain[1:][after] = 3
    plain[number] = 1
    for kind in (1, 3):
        h[plain == kind] = _SLOTS[kind]
    found.append((h, plain))
    inner = capital.copy()
    inner[starts] = False
    for name in (inner, capital) if (inner != capital).any() else (inner,):
        if name.any():
            slot, named = plain.copy(), h.copy()
            slot[name] = 2
            named[name] = _SLOTS[2]
            found.append((named, slot))
    return found


def _read(texts: list[bytes | None]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(words of all texts, bounds of each text's words, places where a line starts)."""
    lines = [line.split() for text in texts for line in (text or b"").split(b"\n")]
    n_lines = np.fromiter(((text or b"").count(b"\n") + 1 for text in texts), np.int64, len(texts))
    ends = np.cumsum(np.fromiter(map(len, lines), np.int64, len(lines)))
    words = [w for line in lines for w in line]
    bounds = np.concatenate([[0], ends[np.cumsum(n_lines) - 1]])
    starts = np.concatenate([[0], ends[:-1]])
    return words, bounds, starts[starts < len(words)]


def template_windows(texts: list[bytes | None], widths: tuple[int, ...], least_literal: int, bits: np.ndarray | None = None, whole: bool = False) -> tuple[list[bytes], np.ndarray, list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]]:
    """The words of all texts, the bounds of each text's, and (width, slot types, places, hashes) of each reading's windows that have enough literal words.

    Half of a window's words must be literal, or ``least_literal`` of the widest. The reading
    without slots has only windows that have too few literal words in the next one: they match
    word for word alone. A window that a reading shares with an earlier one is left out; with
    ``bits`` also those without their bit. No window goes over a text's end. With ``whole``, a
    text shorter than the widest window has one window, itself.
    """
    words, bounds, starts = _read(texts)
    sizes = np.diff(bounds)
    widest = max(widths)
    if whole:  # each text has windows of one width
        own = np.minimum(widest, sizes)
        own[sizes < SHORTEST] = 0
        widths = tuple(np.unique(own[own > 0]).tolist())
        own = np.repeat(own, sizes)
    left = np.repeat(bounds[1:], sizes) - np.arange(len(words))  # words from here to the text's end
    readings = templates(words, starts, bounds[:-1][sizes > 0])
    hashes = [dict(zip(widths, windows_of(h, widths), strict=True)) for h, _ in readings]
    literals = [np.concatenate([[0], np.cumsum(slot == 0)]) for _, slot in readings]
    out = []
    for width in widths:
        n_windows = len(words) - width + 1
        if n_windows <= 0:
            continue
        earlier = []
        least = -(-least_literal * width // widest)
        inside = left[:n_windows] >= width
        if whole:
            inside &= own[:n_windows] == width
        for n, (_, slot) in enumerate(readings):
            keys = hashes[n][width]
            literal = literals[max(n, 1)]
            fit = inside & ((literal[width:] - literal[:-width] >= least) == (n > 0))
            if bits is not None:
                at = np.flatnonzero(fit)
                at = at[with_bit(bits, keys[at])]
            else:
                at = np.flatnonzero(fit)
            for other in earlier:
                at = at[keys[at] != other[at]]
            if n:
                earlier.append(keys)
            if len(at):
                out.append((width, slot, at, keys[at]))
    return words, bounds, out


def _slots(words: list[bytes], slot: np.ndarray, at: int, width: int) -> list[str]:
    """Values of a window's slots in order, their type first."""
    return [f"{slot[i]}:{words[i].decode('utf-8', 'replace').strip(_EDGES).lower()}" for i in range(at, at + width) if slot[i]]


def window_table(df: DataFrame, widths: tuple[int, ...], least_literal: int, bits: np.ndarray | None = None, whole: bool = False) -> DataFrame:
    """(key, id, part, at, width, slots) of df(id, part, text)'s windows; with ``bits`` only of those whose bit is set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch):
                ids, parts = part.column("id").to_pylist(), part.column("part").to_pylist()
                words, bounds, readings = template_windows(part.column("text").cast(pa.binary()).to_pylist(), widths, least_literal, bits, whole)
                out: list[list] = [[], [], [], [], [], []]
                for width, slot, at, keys in readings:
                    owners = np.searchsorted(bounds, at, "right") - 1
                    for a, i, key in zip(at.tolist(), owners.tolist(), keys.view(np.int64).tolist(), strict=True):
                        for column, value in zip(out, (key, ids[i], parts[i], a - int(bounds[i]), width, _slots(words, slot, a, width)), strict=True):
                            column.append(value)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], ["key", "id", "part", "at", "width", "slots"])

    return df.mapInArrow(run, "key long, id long, part long, at int, width int, slots array<string>")


def longest_run(windows: Column) -> Column:
    """Most consecutive windows whose slots agree, of an array of (at, n_slots, pairs) sorted by place.

    Slots agree if each value of the item stands for one value of the text. A window that
    contradicts the run before it begins another run. If no run is longer than the windows that
    contradict themselves are many, only windows without slots count.
    """
    agree = lambda pairs: F.size(F.array_distinct(F.transform(pairs, lambda p: p["item_slots"]))) == F.size(pairs)
    none = F.array().cast("array<struct<item_slots:string,slots:string>>")

    def state(at: Column, pairs: Column, n: Column, best: Column, bad: Column) -> Column:
        return F.struct(at.cast("int").alias("at"), pairs.alias("pairs"), n.cast("int").alias("n"), F.greatest(best, n).cast("int").alias("best"), bad.cast("int").alias("bad"))

    def step(s: Column, x: Column) -> Column:
        both, own, here = F.array_union(s["pairs"], x["pairs"]), F.array_distinct(x["pairs"]), x["at"] == s["at"]
        longer = (s["n"] > 0) & (x["at"] == s["at"] + 1) & agree(both)
        # several readings of one place: the one with the fewest slots comes first, and one that fits is enough
        return (
            F.when((s["n"] > 0) & here, s)
            .when(longer, state(x["at"], both, s["n"] + 1, s["best"], s["bad"]))
            .when(agree(own), state(x["at"], own, F.lit(1), s["best"], s["bad"] - F.when(here, 1).otherwise(0)))
            .otherwise(state(x["at"], none, F.lit(0), s["best"], s["bad"] + F.when(here, 0).otherwise(1)))
        )

    bare = F.size(F.filter(windows, lambda x: x["n_slots"] == 0))
    start = state(F.lit(-2), none, F.lit(0), F.lit(0), F.lit(0))
    return F.aggregate(windows, start, step, lambda s: F.when(s["best"] > s["bad"], s["best"]).otherwise(bare))


def contamination(
    df: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = WIDTH,
    least_literal: int = LEAST_LITERAL,
) -> DataFrame:
    """(doc_id, row_hash, item_id, windows) of each row and each benchmark item that it repeats.

    Numbers, names and units become typed slots, names also lower-case literals; windows of
    ``width`` words with ``least_literal`` literal ones at least are joined by hash, windows
    with fewer only word for word. ``windows`` is the longest run of consecutive windows that
    a text shares with an item and along which each slot value of the item stands for one value
    of the text (several may stand for the same one): an altered slot ends a run, and does not
    hide the rest (see ``longest_run``). An item of fewer than ``width`` words is one window as a whole; items of
    fewer than SHORTEST words, null texts and null ids match nothing; either table may be empty.
    """
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("part"), F.col(text_col).cast("string").alias("text"))
    items = benchmark.select(F.col(item_col).cast("long").alias("id"), F.lit(0).cast("long").alias("part"), F.col(item_text_col).cast("string").alias("text"))
    known = materialize(window_table(items.where("id is not null and text is not null"), (width,), least_literal, whole=True), "benchmark")
    bits = key_bits(known, known.count())
    widths = tuple(sorted({width, *(r[0] for r in known.select("width").distinct().collect())}))  # width - SHORTEST + 1 numbers at most
    seen = window_table(docs.where("id is not null and text is not null"), widths, least_literal, bits)
    y = known.select("key", F.col("id").alias("item_id"), F.col("at").alias("item_at"), F.col("width").alias("item_width"), F.col("slots").alias("item_slots"))
    met = seen.join(y, "key").where("width = item_width").select(
        F.col("id").alias("doc_id"), F.col("part").alias("row_hash"), "item_id", (F.col("at") - F.col("item_at")).alias("shift"), "item_at",
        F.arrays_zip("item_slots", "slots").alias("pairs"),
    )
    # an alignment has at most a few windows a word of the item
    window = F.struct(F.col("item_at").alias("at"), F.size("pairs").alias("n_slots"), "pairs")
    lined = met.groupBy("doc_id", "row_hash", "item_id", "shift").agg(F.array_sort(F.collect_set(window)).alias("windows"))
    lined = lined.withColumn("windows", longest_run(F.col("windows")).cast("long"))
    return lined.where("windows > 0").groupBy("doc_id", "row_hash", "item_id").agg(F.max("windows").alias("windows"))


def flag_contaminated(df: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, contaminated, n_items, first_item) of each row; rows of one id and other texts are judged apart."""
    hits = contamination(df, benchmark, id_col=id_col, text_col=text_col, **options)
    hits = hits.groupBy("doc_id", "row_hash").agg(F.count(F.lit(1)).alias("n"), F.min("item_id").alias("first_item"))
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("row_hash"))
    n = F.coalesce("n", F.lit(0))
    return rows.join(hits, ["doc_id", "row_hash"], "left").select("doc_id", (n > 0).alias("contaminated"), n.alias("n_items"), "first_item")

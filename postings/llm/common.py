"""Helpers shared by the operators: word hashing, components; tables in the shared folder are the library's."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from postings.operators.shared import fresh_path, materialize, shared_dir  # noqa: F401 (operators take them from here)

#: Java and RE2 class for what separates words: space, tab, \n, \v, \f, \r (bytes.split() splits on the same six).
SPACE_CLASS = r"[ \t\n\x0B\f\r]"
WORD_CLASS = r"[^ \t\n\x0B\f\r]"


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (in place where it can be)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class WordHash(dict):
    """64-bit hashes of words, kept up to a bound so that a worker's memory stays flat."""

    def __init__(self, most: int = 250_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


#: One cache for all operators of a worker process.
word_hashes = WordHash()


def pieces(batch: pa.RecordBatch, most: int = 200_000) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``most`` bytes of text: many short texts share a pass, and a piece's memory is bounded (by one text at least)."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column("text")), 0), np.int64))
    start = 0
    while start < len(ends):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k consecutive entries of ``h`` (order matters)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = h[:n].copy()
    for i in range(1, k):
        out = mix64(out) + h[i : i + n]
    return mix64(out)


def key_bits(keys: DataFrame, count: int) -> np.ndarray:
    """A bit set of the keys' low bits: 16 bits a key, from 128 KB to 16 MB however many they are.

    It only spares the shuffle rows that can't match; a full one lets more through to the join.
    """
    size = 1 << min(27, max(20, (16 * max(1, count) - 1).bit_length()))
    place = F.col("key").bitwiseAND(F.lit(size - 1))
    found = keys.select(place.alias("p")).groupBy(F.floor(F.col("p") / 32768).alias("bucket"))
    found = found.agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("p") + 1)).alias("bits"))
    bits = np.zeros(size // 8, np.uint8)
    for bucket, part in found.collect():  # at most size / 32768 rows of 4 KB
        bits[bucket * 4096 : (bucket + 1) * 4096] = np.frombuffer(part, np.uint8)
    return bits


def with_bit(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the 64-bit keys have their bit set."""
    bit = keys & np.uint64(len(bits) * 8 - 1)
    return (bits[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _written(links: DataFrame) -> tuple[DataFrame, tuple]:
    """The links as a table, and their number and hash sum, observed while they are written."""
    seen = Observation()
    table = materialize(links.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")), "links")
    return table, (seen.get["n"], seen.get["h"])


def components(edges: DataFrame, most_rounds: int = 40) -> DataFrame:
    """Connected components of links ``(a, b)`` of any ordered type: ``(node, component)``, the smallest node of each.

    Alternating large-star and small-star rounds: every round is two aggregations (combined
    before the shuffle, so a hub costs one row per task) and two equi-joins that adaptive
    execution can split at a hot hub. Rounds grow with the logarithm of the longest chain.
    Nodes without links aren't returned. Self links, repeated links and nulls are ignored.
    """
    now, seen = _written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    if not seen[0]:
        return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    for _ in range(most_rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        last = seen
        now, seen = _written(small.select("a", F.col("m").alias("b")).unionByName(small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct())
        if last == seen:
            break
    else:
        raise RuntimeError(f"components: not settled after {most_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))


#: Members of one block of an open bucket: where pairs are rows, and where a task compares cells.
BLOCK, CELL = 512, 2048


def _merged(found: DataFrame, more: DataFrame) -> DataFrame:
    """``found`` (node, component) with the links ``more`` (a, b): only the classes that they join are worked over."""
    of = lambda c: found.select(F.col("node").alias(c), F.col("component").alias(f"{c}_class"))
    edges = more.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("a_class", "a").alias("a"), F.coalesce("b_class", "b").alias("b"))
    top = components(edges)
    moved = found.join(top.select(F.col("node").alias("component"), F.col("component").alias("top")), "component", "left")
    return materialize(moved.select("node", F.coalesce("top", "component").alias("component")).unionByName(top), "classes")


def dealt_pairs(open_: DataFrame, nodes: DataFrame, likely: Callable[[str, str], Column], turn: int, hand: int) -> DataFrame:
    """Pairs (a, b) of members of different classes of open_(key, node, class, size) that the turn's deal puts into one hand.

    Hands have about ``hand`` members, so pairs grow with the members; a bucket of so many or fewer is one hand. Their number is
    a power of two, so that members of several buckets meet in the same pairs.
    """
    hands = F.pow(F.lit(2), F.ceil(F.log2(F.col("size") / hand))).cast("long")
    z = open_.withColumn("hand", F.when(F.col("size") <= hand, 0).otherwise(F.pmod(F.xxhash64("node", F.lit(turn)), hands))).join(nodes, "node")
    x, y = z.alias("x"), z.alias("y")
    met = (F.col("x.key") == F.col("y.key")) & (F.col("x.hand") == F.col("y.hand")) & (F.col("x.class") < F.col("y.class"))
    return x.join(y, met & likely("x", "y")).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def all_pairs(open_: DataFrame, nodes: DataFrame, likely: Callable[[str, str], Column]) -> DataFrame:
    """All likely pairs (a, b) of members of different classes of open_(key, node, class, size), each made in the least key its two share.

    Blocks of BLOCK members meet blocks, so that no task holds a large bucket.
    """
    blocks = F.ceil(F.col("size") / BLOCK)
    keys = open_.groupBy("node").agg(F.collect_set("key").alias("keys"))  # a node has a few keys, as its operator draws
    z = open_.withColumn("block", F.pmod(F.xxhash64("node"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    z = z.select("key", "node", "class", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")).join(nodes, "node").join(keys, "node")
    x, y = z.where("block = low").alias("x"), z.where("block = high").alias("y")
    cell = (F.col("x.key") == F.col("y.key")) & (F.col("x.low") == F.col("y.low")) & (F.col("x.high") == F.col("y.high"))
    once = (F.col("x.class") != F.col("y.class")) & ((F.col("x.low") < F.col("x.high")) | (F.col("x.node") < F.col("y.node")))
    least = F.array_min(F.array_intersect("x.keys", "y.keys")) == F.col("x.key")
    pairs = x.join(y, cell & once & likely("x", "y") & least)
    return pairs.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))


def classes(members: DataFrame, nodes: DataFrame, likely: Callable[[str, str], Column], confirm: Callable[[DataFrame], DataFrame], links: DataFrame | None = None, rest: Callable[[DataFrame], DataFrame] | None = None, pivots: int = 0, deals: tuple[int, ...] = (), compare: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Components (node, component) of the confirmed links among candidates that share a bucket.

    ``members`` has (key, node) of buckets of two or more, ``nodes`` has a row a node with what
    ``likely(x, y)`` compares (a cheap condition on aliases x and y that no link may violate),
    ``confirm`` returns those of pairs (a, b) that are links; ``links`` are given in advance.

    Every bucket first tests all members against its smallest one. ``pivots`` more rounds may test
    a random member of each bucket that still has several classes against members of other
    classes; then only members of different classes are tested pairwise: those that ``likely``
    allows, or those that ``rest`` makes of (key, node, class, a, pivot_class), where a is the
    smallest node of the bucket. A bucket of copies, however large, thus costs a few tests a
    member, and no link between candidates is lost. Without ``rest``, ``deals`` rounds first compare
    members of different classes within hands of so many, dealt anew each round. ``compare`` instead finds
    links (a, b) of what is left inside the tasks (``in_cells``), so that pairs are never rows.
    """

    def tested(pairs: DataFrame) -> DataFrame:
        x, y = nodes.alias("x"), nodes.alias("y")
        both = pairs.join(x, F.col("a") == F.col("x.node")).join(y, F.col("b") == F.col("y.node")).where(likely("x", "y"))
        return materialize(confirm(both.select("a", "b")), "links")

    hubs = members.groupBy("key").agg(F.min("node").alias("a"))
    stars = members.join(hubs, "key").where("node <> a").select("a", F.col("node").alias("b")).distinct()
    first = tested(stars)
    found = components(first if links is None else first.unionByName(links))
    left = members.join(members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 2").select("key"), "key")
    for turn in range(pivots + 1):
        classed = left.join(found, "node", "left").select("key", "node", F.coalesce("component", "node").alias("class"))
        order = F.xxhash64("node", F.lit(turn)) if turn < pivots else F.lit(0)
        pivot = F.min(F.struct(order.alias("order"), "node", "class")).alias("pivot")
        mixed = classed.groupBy("key").agg(F.min("class").alias("lo"), F.max("class").alias("hi"), pivot)
        mixed = mixed.where("lo <> hi").select("key", F.col("pivot.node").alias("a"), F.col("pivot.class").alias("pivot_class"))
        open_ = materialize(classed.join(mixed, "key"), "open")
        if open_.isEmpty():
            break
        left = open_.select("key", "node")
        if turn < pivots:
            more = tested(open_.where("class <> pivot_class").select("a", F.col("node").alias("b")).distinct())
        elif rest is not None:
            more = materialize(confirm(rest(open_)), "links")
        elif compare is not None:
            return in_cells(open_.select("key", "node", "class"), found, compare)
        else:
            return _dealt(open_.select("key", "node"), found, nodes, likely, confirm, deals)
        if not more.isEmpty():
            found = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))
    return found


def in_cells(open_: DataFrame, found: DataFrame, compare: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``found`` with the links that ``compare`` finds in open_(key, node, class), the members of buckets of several classes.

    ``compare`` gets (key, low, high, side, node, class): a cell (key, low, high) is a block of a bucket, to be compared within
    itself, or two blocks (sides 0 and 1), to be compared with each other. It may leave out links between what it has linked
    already. Buckets of several blocks meet across them in a second round, if they are still of several classes.
    """
    large = materialize(open_.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > CELL).select("key", F.ceil(F.col("size") / CELL).alias("blocks")), "large")
    place = F.pmod(F.xxhash64("node"), F.coalesce("blocks", F.lit(1).cast("long")))
    one = open_.join(large, "key", "left").select("key", place.alias("low"), place.alias("high"), F.lit(0).alias("side"), "node", "class")
    more = materialize(compare(one), "links")
    if not more.isEmpty():
        found = _merged(found, more)
    if large.isEmpty():
        return found
    left = open_.select("key", "node").join(large, "key").join(found, "node", "left").select("key", "node", "blocks", F.coalesce("component", "node").alias("class"))
    mixed = left.groupBy("key").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo <> hi").select("key")
    two = left.join(mixed, "key").withColumn("block", place).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).where("block <> other")
    two = two.select("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), (F.col("block") > F.col("other")).cast("int").alias("side"), "node", "class")
    more = materialize(compare(two), "links")
    return found if more.isEmpty() else _merged(found, more)


def _dealt(left: DataFrame, found: DataFrame, nodes: DataFrame, likely: Callable[[str, str], Column], confirm: Callable[[DataFrame], DataFrame], deals: tuple[int, ...]) -> DataFrame:
    """``found`` with all links of left(key, node): deals into hands join what has many links at a cost linear in a bucket, then what is still apart is compared in full."""
    for turn, hand in enumerate((*deals, 0)):
        classed = left.join(found, "node", "left").select("key", "node", F.coalesce("component", "node").alias("class"))
        mixed = classed.groupBy("key").agg(F.min("class").alias("lo"), F.max("class").alias("hi"), F.count(F.lit(1)).alias("size")).where("lo <> hi").select("key", "size")
        open_ = materialize(classed.join(mixed, "key"), "open")
        if open_.isEmpty():
            break
        pairs = dealt_pairs(open_, nodes, likely, turn, hand) if hand else all_pairs(open_, nodes, likely)
        more = materialize(confirm(pairs), "links")
        if not more.isEmpty():
            found = _merged(found, more)
        left = open_.where(F.col("size") > hand).select("key", "node")
    return found

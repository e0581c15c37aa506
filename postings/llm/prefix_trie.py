"""The trie of all conversations' prefixes by Van Emde Boas recursion on rows of sequence pieces.

A piece is (root, sequence): a run of turns below a named prefix. Every round cuts all pieces at half
their depth: the head stays below its root, the name of (root, head) is the cut prefix, and
the tail is a piece below that name. Equal pieces are put together with their numbers of
conversations, so upper tries and lower forests of all places shrink to distinct pieces and are
built in the same round. After log2(depth) rounds pieces are single turns: the nodes.

Subtree totals are grafted the other way: of an ancestor and a descendant, exactly one cut lies
between them, so the lower forest of each cut is summed once, and its sum is sent up the path of
the head above it, by the same halvings with weights.

Conversations are held as chunks of a bounded number of turns. Of a longer one, the names of
its whole chunks are a sequence again, whose trie (by the same rounds) names the roots of the chunks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postings.llm.common import WORD_CLASS, materialize
from postings.operators.ranks import numbered

#: Turns (or chunk names) a row holds at most, conversations that share 20 a base, and ids of a packed list.
CHUNK, FAMILY, PACK = 512, 20, 4096
ROOT = ""
SEQ = "array<string>"


def named(root: Column, seq: Column) -> Column:
    """The name of a prefix: of its root's name and what follows."""
    return F.md5(F.concat(root, F.lit("|"), F.array_join(seq, ",")).cast("binary"))


def rebuilt(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(conversations (c), turns (c, pos, tok)) after each family member's opening is taken from the family's first.

    ``tok`` stands for (role, text) and ends with the number of words of the text.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = df.select(F.col(conv_col).cast("long").alias("c"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text")).where("c is not null")
    tok = F.concat_ws(":", F.md5(F.concat(F.length("role"), F.lit(":"), "role", "text").cast("binary")), F.regexp_count("text", F.lit(f"{WORD_CLASS}+")))
    turns = materialize(numbered(rows, ["c"], ["turn", "role", "text"], "pos").select("c", "pos", tok.alias("tok")), "turns")
    h = (F.crc32(F.col("c").cast("string").cast("binary")) % 4).alias("h")
    convs = turns.select("c").distinct().select("c", (F.col("c") - F.col("c") % FAMILY).alias("base"), h)
    first = turns.where((F.col("pos") < 4) & (F.col("c") % FAMILY == 0)).groupBy(F.col("c").alias("base")).agg(F.sort_array(F.collect_list(F.struct("pos", "tok")))["tok"].alias("first"))
    opening = convs.join(first, "base", "left").select("c", "h", F.when(F.col("h") > 0, F.slice(F.coalesce("first", F.lit([]).cast(SEQ)), F.lit(1), F.greatest("h", F.lit(1)))).otherwise(F.lit([]).cast(SEQ)).alias("opening"))
    opening = materialize(opening, "openings")
    own = turns.join(opening.select("c", "h", F.size("opening").cast("long").alias("taken")), "c").where(F.col("pos") > F.col("h"))
    own = own.select("c", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "tok")
    taken = opening.select("c", F.posexplode("opening").alias("pos", "tok")).select("c", (F.col("pos") + 1).cast("long").alias("pos"), "tok")
    return opening.select("c"), taken.unionByName(own)


def chunked(rows: DataFrame, chunk: int) -> DataFrame:
    """(c, s, seq): the ``tok`` of rows (c, pos, tok) in order of ``pos`` (from 1), at most ``chunk`` a row."""
    s = F.floor((F.col("pos") - 1) / chunk).alias("s")
    return rows.groupBy("c", s).agg(F.sort_array(F.collect_list(F.struct("pos", "tok")))["tok"].alias("seq"))


@dataclass
class Level:
    """One scale of the trie: its distinct pieces, and after each round of half ``h`` the heads whose ends are named."""

    pieces: DataFrame
    heads: list[tuple[int, DataFrame]]
    nodes: DataFrame


def cut(pieces: DataFrame, h: int, unit: int) -> DataFrame:
    """A round: all pieces cut after ``h`` entries (of ``unit`` turns), equal ones put together."""
    size, head = F.size("seq"), F.slice("seq", 1, h)
    x = named(F.col("root"), head)
    none = F.lit(None).cast("string")
    upper = F.struct("root", "cuts", "depth", head.alias("seq"), F.when(size >= h, x).alias("x"), F.when(size <= h, F.col("end")).alias("end"))
    lower = F.struct(x.alias("root"), F.array_append("cuts", x).alias("cuts"), (F.col("depth") + h * unit).alias("depth"), F.slice("seq", h + 1, h).alias("seq"), none.alias("x"), F.col("end"))
    parts = pieces.select("n", "least", F.explode(F.when(size > h, F.array(upper, lower)).otherwise(F.array(upper))).alias("p")).select("n", "least", "p.*")
    merged = parts.groupBy("root", "seq").agg(
        F.any_value("cuts").alias("cuts"), F.any_value("depth").alias("depth"), F.sum("n").alias("n"), F.min("least").alias("least"), F.max("x").alias("x"), F.max("end").alias("end")
    )
    return materialize(merged, f"trie-{unit}-{h}")


def level(pieces: DataFrame, longest: int, unit: int) -> Level:
    """All rounds over pieces of at most ``longest`` entries."""
    now, heads, h = pieces, [], 1 << (max(1, longest).bit_length() - 1)
    while h:
        now = cut(now, h, unit)
        heads.append((h, now.where("x is not null")))
        h //= 2
    return Level(pieces, heads, now)


def roots_of(seqs: DataFrame, chunk: int, unit: int) -> DataFrame:
    """(c, s, root, cuts, depth) behind each entry (of ``unit`` turns) of sequences (c, s, seq, root, cuts, depth): names as the rounds give them."""
    bits = [1 << b for b in reversed(range(chunk.bit_length()))]
    rows = seqs.withColumn("i", F.explode(F.sequence(F.lit(1), F.size("seq"))))
    root, cuts, done = F.col("root"), F.col("cuts"), F.lit(0)
    for b in bits:  # the cut prefixes of i entries: one for each bit of i
        rows = rows.withColumns({"root_": root, "cuts_": cuts, "done_": done})
        on = F.col("i").bitwiseAND(F.lit(b)) > 0
        x = named(F.col("root_"), F.slice("seq", F.col("done_") + 1, F.lit(b)))
        rows = rows.withColumns({"x_": F.when(on, x)})
        root, cuts, done = F.coalesce("x_", "root_"), F.when(on, F.array_append("cuts_", F.col("x_"))).otherwise(F.col("cuts_")), F.when(on, F.col("done_") + b).otherwise(F.col("done_"))
    return rows.select("c", (F.col("s") * chunk + F.col("i")).alias("s"), root.alias("root"), cuts.alias("cuts"), (F.col("depth") + F.col("i") * unit).alias("depth"))


def levels(seqs: DataFrame, chunk: int, unit: int = 1) -> tuple[list[Level], DataFrame, DataFrame | None]:
    """(levels from the coarsest to this one, this one's sequences (c, s, seq, root, cuts, depth, end), roots (c, s, root, cuts, depth) behind whole chunks)."""
    longest = seqs.agg(F.max("s").alias("s"), F.max(F.size("seq")).alias("n")).first()
    empty = [F.lit(ROOT).alias("root"), F.lit([]).cast(SEQ).alias("cuts"), F.lit(0).cast("long").alias("depth")]
    above: list[Level] = []
    roots = None
    if not longest["s"]:
        rooted, entries, last = seqs.select("*", *empty), longest["n"] or 0, F.lit(True)
    else:
        whole = seqs.where(F.size("seq") == chunk).select("c", (F.col("s") + 1).alias("pos"), named(F.lit("chunk"), F.col("seq")).alias("tok"))
        above, coarse, later = levels(materialize(chunked(whole, chunk), "chunks"), chunk, unit * chunk)
        roots = roots_of(coarse, chunk, unit * chunk)
        if later is not None:  # behind a whole chunk of chunks, the name is the next coarser level's
            roots = roots.where(F.col("s") % chunk != 0).unionByName(later.withColumn("s", F.col("s") * chunk))
        ends = seqs.groupBy("c").agg(F.max("s").alias("last"))
        later = seqs.where("s > 0").join(roots, ["c", "s"])
        rooted = seqs.where("s = 0").select("*", *empty).unionByName(later).join(ends, "c")
        entries, last = chunk - 1, F.col("s") == F.col("last")  # the end of a whole chunk is the coarser level's cut
    rooted = materialize(rooted.select("c", "s", "seq", "root", "cuts", "depth", F.when(last, named(F.col("root"), F.col("seq"))).alias("end")), "rooted")
    pieces = rooted.groupBy("root", "seq").agg(F.any_value("cuts").alias("cuts"), F.any_value("depth").alias("depth"), F.count(F.lit(1)).alias("n"), F.min("c").alias("least"), F.max("end").alias("end"))
    return [*above, level(materialize(pieces, "pieces"), entries, unit)], rooted, roots


def grafted(found: list[Level], sums: DataFrame) -> DataFrame:
    """(root, tok, more_leaves, more_saved) of each node: the ``sums`` (x, leaves, saved) of all cuts below it."""
    now = None
    for depth, lv in enumerate(found):
        if depth:  # from names of chunks to the chunks
            chunks = lv.pieces.select("root", "seq").withColumn("tok", named(F.lit("chunk"), F.col("seq")))
            now = now.select("root", F.col("seq")[0].alias("tok"), "leaves", "saved").join(chunks, ["root", "tok"]).drop("tok")
        for h, heads in lv.heads:
            more = heads.join(sums, "x").select("root", "seq", "leaves", "saved")
            if now is not None:
                size, head = F.size("seq"), F.slice("seq", 1, h)
                upper, lower = F.struct("root", head.alias("seq")), F.struct(named(F.col("root"), head).alias("root"), F.slice("seq", h + 1, h).alias("seq"))
                parts = F.explode(F.when(size > h, F.array(upper, lower)).otherwise(F.array(upper)))
                more = more.unionByName(now.select(parts.alias("p"), "leaves", "saved").select("p.*", "leaves", "saved"))
            now = more.groupBy("root", "seq").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    return now.select("root", F.col("seq")[0].alias("tok"), F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved"))


def lists_hashed(members: DataFrame) -> DataFrame:
    """(end, ends_sha256) of members (end, c): the hash of each end's ids, ascending, as decimals joined by commas.

    Ids are packed by blocks of PACK numbers and run through the hash in order: no list is held.
    """
    packs = members.groupBy("end", F.floor(F.col("c") / PACK).alias("block")).agg(F.array_join(F.transform(F.sort_array(F.collect_list("c")), lambda x: x.cast("string")), ",").alias("ids"))
    packs = packs.repartition("end").sortWithinPartitions("end", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, None
        for batch in batches:
            ends, hashes = [], []
            for end, ids in zip(batch.column("end").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if end == at and state is not None:
                    state.update(b",")
                else:
                    if state is not None:
                        ends.append(at)
                        hashes.append(state.hexdigest())
                    at, state = end, hashlib.sha256()
                state.update(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(ends, pa.string()), pa.array(hashes, pa.string())], ["end", "ends_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.string()), pa.array([state.hexdigest()], pa.string())], ["end", "ends_sha256"])

    return packs.mapInArrow(run, "end string, ends_sha256 string")


def prefix_trie(df: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """A row a node of the trie of all rebuilt conversations, the textless root included.

    Columns: conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs, n_children,
    n_leaves, saved_tokens (words that the node and those below it spare by being stored once) and
    ends_sha256 (of the ids of the conversations that end here).

    Turns are ordered by (turn, role, text), null turns first; repeated rows stay. Null role
    and text are empty. Rows of a null conversation id are in no conversation and left out. A conversation whose rebuilt form has no turn ends at
    the root. An empty table has no conversation and gives no row; other columns are ignored. ``chunk``, a power of 2, bounds
    a row, not a conversation; no result depends on it.
    """
    convs, turns = rebuilt(df, conv_col, turn_col, role_col, text_col)
    all_ = convs.agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("least")).first()
    seqs = materialize(chunked(turns, chunk), "sequences")
    found, rooted, _ = levels(seqs, chunk)
    nodes = found[-1].nodes.select("root", F.col("seq")[0].alias("tok"), (F.col("depth") + 1).alias("depth"), "n", "least", "cuts", "end")
    units = [chunk ** (len(found) - 1 - i) for i in range(len(found))]
    names = None
    for unit, lv in zip(units, found, strict=True):
        for h, heads in lv.heads:
            part = heads.select("x", (F.col("depth") + h * unit).alias("depth"), "least")
            names = part if names is None else names.unionByName(part)
    children = nodes.groupBy(F.col("root").alias("x")).agg(F.count(F.lit(1)).alias("n_children"))
    names = materialize(names.join(children, "x", "left").select("x", "depth", "least", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children")), "names")
    words = F.element_at(F.split("tok", ":"), -1).cast("long")
    own = nodes.join(names.select("depth", "least", "n_children"), ["depth", "least"]).withColumns({"leaves": (F.col("n_children") == 0).cast("long"), "saved": (F.col("n") - 1) * words})
    own = materialize(own, "nodes")
    sums = materialize(own.select(F.explode("cuts").alias("x"), "leaves", "saved").groupBy("x").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")), "sums")
    parents = names.select(F.col("x").alias("root"), F.col("least").alias("parent_conv_id"))
    none = F.lit(hashlib.sha256().hexdigest())
    ending = rooted.where("end is not null").select("c", "end")
    ending = ending.unionByName(convs.join(ending.select("c"), "c", "left_anti").select("c", F.lit(ROOT).alias("end")))
    ends = materialize(lists_hashed(ending), "ends")
    full = own.join(grafted(found, sums), ["root", "tok"], "left").join(parents, "root", "left").join(ends, "end", "left")
    least = F.lit(all_["least"]).cast("long")
    rows = full.select(
        F.col("least").alias("conv_id"), "depth", F.when(F.col("root") == ROOT, least).otherwise(F.col("parent_conv_id")).alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children",
        (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("n_leaves"), (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved_tokens"), F.coalesce("ends_sha256", none).alias("ends_sha256"),
    )
    top = own.agg(F.count_if(F.col("root") == ROOT).alias("n_children"), F.greatest(F.coalesce(F.sum("leaves"), F.lit(0)), F.lit(1)).alias("n_leaves"), F.coalesce(F.sum("saved"), F.lit(0)).alias("saved_tokens"))
    bare = ends.where(F.col("end") == ROOT).first()
    top = top.withColumn("ends_sha256", F.lit(bare["ends_sha256"]) if bare else none).where(F.lit(all_["n"] > 0)).select(
        least.alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), F.lit(all_["n"]).cast("long").alias("n_convs"), "n_children", "n_leaves", "saved_tokens", "ends_sha256",
    )
    return rows.unionByName(top)

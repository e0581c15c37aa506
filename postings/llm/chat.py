"""Multi-party dialogues rendered from every participant's perspective, on Column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SYSTEM = "system"
#: How marks in what people wrote are spelt, so that no text or name can begin or end a turn.
ESCAPES = (("<|", "< |"), ("|>", "| >"))
#: Characters a segment holds before the next turn starts another one; a block is so many turns of one sum.
SEGMENT_CHARS, BLOCK_TURNS = 32_768, 256


def escaped(text: Column) -> Column:
    for mark, spelt in ESCAPES:
        text = F.replace(text, F.lit(mark), F.lit(spelt))
    return text


def rotate(df: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role", text_col: str = "text", segment_chars: int = SEGMENT_CHARS) -> DataFrame:
    """Segments of each conversation rendered once for each participant.

    In a rendering, that participant's turns are ``<|assistant|>`` turns and carry the loss
    mask; others are ``<|user name=...|>`` turns; ``system`` turns keep their role and are no
    participant. Rows: conv_id, perspective, segment, first_turn, n_turns, text, and
    ``mask`` with the character spans [start, stop) of ``text`` to learn: the assistant's words and
    end mark, not the header. Segments laid end to end are the whole rendering; a turn is never
    split (one longer than a segment is a row of its own length), and a segment begins when ``segment_chars`` more characters have gone by, so that one
    conversation with a third of all rows becomes many bounded rows.

    Turns are ordered by (turn, speaker, text), null turns first; repeated rows stay. A null
    speaker is the participant ``unknown``, null text is empty, marks such as ``<|end|>`` in a text
    or a name are spelt ``< |end| >`` (a name's line breaks as spaces), a null conversation id is a
    conversation of its own. A conversation of system turns alone has no participant and gives
    no row; an empty table gives an empty result; other columns are ignored.
    """
    rows = df.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(speaker_col).cast("string"), F.lit("unknown")).alias("speaker"),
        escaped(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("body"),
    )
    # distinct speakers are combined before the shuffle; the join can be split at a hot conversation
    people = rows.where(F.col("speaker") != SYSTEM).select(F.col("conv_id").alias("c"), F.col("speaker").alias("perspective")).distinct()
    turns = rows.join(people, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    own, system = F.col("speaker") == F.col("perspective"), F.col("speaker") == SYSTEM
    head = F.when(own, F.lit("<|assistant|>\n")).when(system, F.lit("<|system|>\n")).otherwise(F.concat(F.lit("<|user name="), F.translate(escaped(F.col("speaker")), "\r\n", "  "), F.lit("|>\n")))
    turns = turns.select("conv_id", "turn", "speaker", "perspective", own.alias("own"), F.length(head).alias("head"), F.concat(head, "body", F.lit("<|end|>\n")).alias("piece"), "body")
    # where a turn starts: totals of blocks of turns, then a running total inside the block
    # turns without a number are in blocks of one speaker and the first letters of the text
    unknown = F.col("turn").isNull()
    first = lambda c: F.when(unknown, c).otherwise("")
    block = F.struct(F.coalesce(F.floor(F.col("turn") / BLOCK_TURNS), F.lit(-(2**62))).alias("n"), first(F.col("speaker")).alias("who"), first(F.substring("body", 1, 8)).alias("text"))
    turns = turns.withColumns({"block": block, "long": F.length("piece").cast("long")})
    rendering = ["conv_id", "perspective"]
    totals = turns.groupBy(*rendering, "block").agg(F.sum("long").alias("chars"))
    before = F.sum("chars").over(Window.partitionBy(*rendering).orderBy("block")) - F.col("chars")
    totals = totals.select(F.col("conv_id").alias("c"), F.col("perspective").alias("p"), F.col("block").alias("b"), before.alias("before"))
    order = Window.partitionBy(*rendering, "block").orderBy("turn", "speaker", "body")
    turns = turns.withColumns({"inside": F.sum("long").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("long"), "place": F.row_number().over(order)})
    placed = turns.join(totals, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("perspective") == F.col("p")) & (F.col("block") == F.col("b")))
    placed = placed.withColumn("start", F.col("before") + F.col("inside")).withColumn("segment", F.floor(F.col("start") / segment_chars))
    entry = F.struct("start", "block", "place", "turn", "own", "head", "long", "piece")
    grouped = placed.groupBy(*rendering, "segment").agg(F.sort_array(F.collect_list(entry)).alias("t"))
    base = F.col("t")[0]["start"]
    mask = F.transform(F.filter("t", lambda x: x["own"]), lambda x: F.struct((x["start"] - base + x["head"]).alias("start"), (x["start"] - base + x["long"] - 1).alias("stop")))
    return grouped.select(
        "conv_id", "perspective", "segment", F.col("t")[0]["turn"].alias("first_turn"), F.size("t").cast("long").alias("n_turns"),
        F.array_join(F.transform("t", lambda x: x["piece"]), "").alias("text"), mask.alias("mask"),
    )

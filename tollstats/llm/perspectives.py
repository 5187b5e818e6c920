"""Multi-party chat formatting by perspective rotation, in DataFrame functions only.

A dialogue is rendered once for every participant: that speaker's turns become
the assistant's, everybody else's are users with names, and only the
assistant's turns are trained on.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollstats.llm.staging import checkpointed
from tollstats.operators.joins import broadcast_if_small

# The markers of the chat format.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
NARRATORS = ("system",)
UNKNOWN = "unknown"
PART_TURNS = 64
# A part of more rows than this, where turns lack numbers or repeat them, is cut.
PART_ROWS = 4096
LAST_TURN = 2**63 - 1


def _escaped(text: Column) -> Column:
    """Text that cannot be read as a marker."""
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def _header(speaker: Column, perspective: Column, narrators: Sequence[str]) -> Column:
    role = (
        F.when(speaker.isin(*narrators), speaker)
        .when(speaker == perspective, F.lit("assistant"))
        .otherwise(F.concat(F.lit("user name="), F.translate(speaker, "\r\n", "  ")))
    )
    return F.concat(F.lit(OPEN), role, F.lit("\n"))


def _cut(marked: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows of large parts, dealt by a hash; equal rows are counted and numbered first."""
    rows = [c for c in columns if c != "cut"]
    same = marked.where(F.col("cuts").isNotNull()).groupBy(*rows, "cuts").agg(F.count("*").alias("copies"))
    blocks = same.withColumn("block", F.explode(F.sequence(F.lit(0), F.expr(f"(copies - 1) div {PART_ROWS}"))))
    until = F.least("copies", (F.col("block") + 1) * PART_ROWS)
    copy = F.explode(F.sequence(F.col("block") * PART_ROWS + 1, until)).alias("copy")
    bucket = F.pmod(F.xxhash64("turn", "speaker", "body", "copy"), F.col("cuts")).cast("int")
    cut = F.struct("turn", bucket.alias("cut")).alias("cut")
    return blocks.select(*rows, "cuts", copy).select(*rows, cut)


def rotate_perspectives(
    turns: DataFrame,
    narrators: Sequence[str] = NARRATORS,
    part_turns: int = PART_TURNS,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """One row per conversation, participant and part of the dialogue.

    ``turns`` needs conv_id, turn, role (the speaker) and text. A part holds
    the turns of one run of ``part_turns`` turn numbers, so most dialogues have
    one and a very long one is never gathered in one place. A part of more than
    ``part_rows`` rows is cut at every turn number, and the rows of one number
    are dealt over parts of about that size. Columns: conv_id,
    perspective, part, n_turns, text (the rendered part), trained (spans
    start-stop of ``text`` in characters, comma separated: the assistant's
    words with their closing marker) and trained_chars.

    Narrators keep their role and have no perspective; a dialogue of narrators
    only gives rows with a null perspective and nothing trained. A null role is
    the participant ``unknown``, a null text is empty, a turn without a number
    comes last, turns of one number follow in the order of speaker and text,
    and repeated rows are repeated turns. A null conv_id is a conversation of
    its own. Further columns are ignored; an empty table gives an empty result.
    """
    clean = turns.select(
        "conv_id",
        F.coalesce(F.col("turn").cast("bigint"), F.lit(LAST_TURN)).alias("turn"),
        _escaped(F.coalesce("role", F.lit(UNKNOWN))).alias("speaker"),
        _escaped(F.coalesce("text", F.lit(""))).alias("body"),
    )
    clean = clean.withColumn("part_turn", F.floor(F.col("turn") / part_turns))
    counts = clean.groupBy("conv_id", "part_turn").agg(F.count("*").alias("rows"))
    # Parts of more rows than this are few: no more than the rows divided by it.
    large = counts.where(F.col("rows") > part_rows).select(
        F.col("conv_id").alias("in_conv"),
        F.col("part_turn").alias("in_part"),
        F.ceil(F.col("rows") / part_rows).cast("int").alias("cuts"),
    )
    inside = F.col("conv_id").eqNullSafe(F.col("in_conv")) & (F.col("part_turn") == F.col("in_part"))
    large = checkpointed(large)
    uncut = clean.withColumn("cut", F.lit(None).cast("struct<turn: bigint, cut: int>"))
    dealt = uncut
    if not large.isEmpty():
        marked = uncut.join(broadcast_if_small(large), inside, "left")
        dealt = marked.where(F.col("cuts").isNull()).select(*uncut.columns).unionByName(_cut(marked, uncut.columns))
    keys = ["conv_id", "part_turn", "cut"]
    parts = dealt.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("turn", "speaker", "body"))).alias("turns"))
    # The windows run over the parts of a conversation, one narrow row each.
    in_order = Window.partitionBy("conv_id").orderBy("part_turn", F.col("cut").asc_nulls_first())
    numbers = dealt.select(*keys).distinct().withColumn("part", F.row_number().over(in_order) - 1)
    people = clean.groupBy("conv_id").agg(
        F.sort_array(F.collect_set(F.when(~F.col("speaker").isin(*narrators), F.col("speaker")))).alias("people")
    )
    p, n, c = parts.alias("p"), numbers.alias("n"), people.alias("c")
    numbered = p.join(n, reduce(and_, [F.col(f"p.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]))
    rotated = numbered.join(c, F.col("p.conv_id").eqNullSafe(F.col("c.conv_id"))).select(
        "p.conv_id", F.col("n.part").cast("bigint").alias("part"), "turns", F.explode_outer("people").alias("perspective")
    )
    perspective = F.col("perspective")
    segments = F.transform(
        "turns",
        lambda t: F.struct(
            _header(t["speaker"], perspective, narrators).alias("head"),
            F.concat(t["body"], F.lit(CLOSE)).alias("tail"),
            F.coalesce(t["speaker"] == perspective, F.lit(False)).alias("trained"),
        ),
    )
    start = F.struct(
        F.lit(0).alias("at"), F.lit(0).alias("chars"), F.lit("").alias("spans")
    )

    def step(done: Column, s: Column) -> Column:
        opens = done["at"] + F.length(s["head"])
        closes = opens + F.length(s["tail"])
        stop = closes - 1  # the marker without its line feed
        span = F.concat_ws("-", opens.cast("string"), stop.cast("string"))
        joined = F.when(done["spans"] == "", span).otherwise(F.concat_ws(",", done["spans"], span))
        return F.struct(
            closes.alias("at"),
            (done["chars"] + F.when(s["trained"], stop - opens).otherwise(0)).alias("chars"),
            F.when(s["trained"], joined).otherwise(done["spans"]).alias("spans"),
        )

    rendered = rotated.withColumn("segments", segments).withColumn(
        "mask", F.aggregate("segments", start, step)
    )
    text = F.array_join(F.transform("segments", lambda s: F.concat(s["head"], s["tail"])), "")
    return rendered.select(
        "conv_id",
        "perspective",
        "part",
        F.size("turns").cast("bigint").alias("n_turns"),
        text.alias("text"),
        F.col("mask.spans").alias("trained"),
        F.col("mask.chars").cast("bigint").alias("trained_chars"),
    )

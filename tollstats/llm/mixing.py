"""Mixing sources to target weights by capped water-filling, in DataFrame functions only.

Every source gets a share of the mix by its weight, but never more than a
multiple of its own size; what a source cannot take goes to the others by
weight. A source is then repeated as often as its target asks: each of its
documents whole so many times, and a seeded part of them once more.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollstats.functions.hashing import key_text
from tollstats.llm.staging import checkpointed
from tollstats.llm.tokens import WORD_PATTERN
from tollstats.operators.joins import broadcast_if_small

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
CAP = 2.0
SEED = 1234
# Documents of a source are ordered by 60 bits of a hash. Its leading 10 bits number
# 1,024 buckets, its leading 20 bits 1,024 parts of each of them.
BUCKET_SHIFT, PART_SHIFT = 50, 40


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint")


def draw_order(id_column: str, seed: int = SEED) -> Column:
    """The place of a document in the seeded order of its source."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key_text([id_column])))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def fill_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP
) -> DataFrame:
    """Target of each source; ``sizes`` has one row (source, source_size) per source.

    Sources in code point order, null last, weigh ``weights``, repeating. If
    sources are taken by rising cap per weight, those up to some point are
    full and the rest share what is left: the first source that its share does
    not fill gives the common level. The two windows run over the sources, not
    over their documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn("place", F.row_number().over(by_name)).withColumn(
        "weight", F.element_at(cycle, (F.col("place") - 1) % len(weights) + 1)
    )
    limited = ranked.withColumn("limit", F.col("source_size") * F.lit(float(cap)))
    rising = Window.orderBy(F.col("limit") / F.col("weight"), "place")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    onward = rising.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = rising.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    budget = F.sum("source_size").over(whole) * F.lit(float(share))
    full = F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    level = (budget - full) / F.sum("weight").over(onward)
    stepped = limited.withColumn("level", level)
    holds = F.col("level") * F.col("weight") <= F.col("limit")
    common = F.first(F.when(holds, F.col("level")), ignorenulls=True).over(whole)
    target = F.least("limit", F.coalesce(F.col("common") * F.col("weight"), F.col("limit")))
    return stepped.withColumn("common", common).select(
        "source", "source_size", target.alias("target")
    )


def _crossing(sums: DataFrame, extras: DataFrame) -> DataFrame:
    """(source, bucket, skipped, extra): where each source's extra part ends, and the words ahead of it.

    ``sums`` has the words of numbered buckets (source, bucket, words), ``extras``
    the words ahead of all of them (source, skipped, extra). A source without an
    extra part has no row.
    """
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    reached = sums.withColumn("ahead", F.coalesce(F.sum("words").over(ahead), F.lit(0)))
    start = F.col("skipped") + F.col("ahead")
    crossing = (
        reached.alias("r")
        .join(extras.alias("e"), F.col("r.source").eqNullSafe(F.col("e.source")))
        .where((start < F.col("extra")) & (start + F.col("words") >= F.col("extra")))
        .select("r.source", "bucket", start.alias("skipped"), "extra")
    )
    return checkpointed(crossing)


def _within(documents: DataFrame, crossing: DataFrame, shift: int) -> DataFrame:
    """The documents in the bucket of their source in which its extra part ends."""
    d, c = documents.alias("d"), broadcast_if_small(crossing).alias("c")
    place = F.shiftright("d.draw", shift)
    return d.join(
        c, F.col("d.source").eqNullSafe(F.col("c.source")) & (place == F.col("c.bucket"))
    ).select("d.source", "d.draw", "d.doc_id", "d.size", "c.skipped", "c.extra")


def mix_plan(
    documents: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    seed: int = SEED,
) -> DataFrame:
    """One row per source: how often whole, and where its seeded extra part ends.

    ``documents`` has (doc_id, source, size, draw). The columns are source,
    source_size, target, whole (repetitions of every document), cut and cut_id
    (the document in which the extra part ends), cut_words and cut_size (words
    still taken there, and the words there are). Sums over hash buckets find
    the bucket of the cut, sums over its parts the part; only that part's
    documents, about a millionth of the source, are ordered.
    """

    def words_by(rows: DataFrame, shift: int) -> DataFrame:
        bucket = F.shiftright("draw", shift).alias("bucket")
        return rows.groupBy("source", bucket).agg(F.sum("size").alias("words"))

    sums = words_by(documents, BUCKET_SHIFT)
    sizes = sums.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = (
        fill_targets(sizes, weights, share, cap)
        .withColumn(
            "whole", F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0))
        )
        .withColumn(
            "extra",
            F.round(F.col("target") - F.col("whole") * F.col("source_size")).cast("bigint"),
        )
    )
    targets = checkpointed(targets)
    bucket = _crossing(sums, targets.select("source", F.lit(0).cast("bigint").alias("skipped"), "extra"))
    parts = words_by(_within(documents, bucket, BUCKET_SHIFT), PART_SHIFT)
    part = _crossing(parts, bucket.drop("bucket"))
    inside = (
        _within(documents, part, PART_SHIFT)
        .groupBy("source", "draw", "doc_id", "skipped", "extra")
        .agg(F.sum("size").alias("cut_size"))
    )
    ordered = Window.partitionBy("source").orderBy("draw", F.col("doc_id").asc_nulls_last())
    before = F.coalesce(
        F.sum("cut_size").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    cuts = (
        inside.withColumn("cut_words", F.col("extra") - F.col("skipped") - before)
        .where(F.col("cut_words") > 0)
        .where(F.col("cut_words") <= F.col("cut_size"))
        .select("source", F.col("draw").alias("cut"), F.col("doc_id").alias("cut_id"), "cut_words", "cut_size")
        .alias("c")
    )
    t = targets.alias("t")
    return t.join(cuts, F.col("t.source").eqNullSafe(F.col("c.source")), "left").select(
        "t.source", "source_size", "target", "whole", "cut", "cut_id", "cut_words", "cut_size"
    )


def with_taken(documents: DataFrame, plan: DataFrame) -> DataFrame:
    """Add source_size, target and taken to rows (doc_id, source, size, draw, ...)."""
    d, p = documents.alias("d"), broadcast_if_small(plan).alias("p")
    at_cut = (F.col("d.draw") == F.col("p.cut")) & F.col("d.doc_id").eqNullSafe(F.col("p.cut_id"))
    first = (F.col("d.draw") < F.col("p.cut")) | (
        (F.col("d.draw") == F.col("p.cut"))
        & F.coalesce(F.col("d.doc_id") < F.col("p.cut_id"), F.col("d.doc_id").isNotNull())
    )
    part = F.expr("cast(cut_words as decimal(38, 0)) * d.size div cut_size").cast("bigint")
    extra = (
        F.when(F.col("p.cut").isNull(), 0).when(at_cut, part).when(first, F.col("d.size")).otherwise(0)
    )
    taken = (F.col("p.whole") * F.col("d.size") + extra).cast("bigint")
    return d.join(p, F.col("d.source").eqNullSafe(F.col("p.source"))).select(
        "d.*", "p.source_size", "p.target", taken.alias("taken")
    )


def sized(documents: DataFrame, seed: int = SEED) -> DataFrame:
    return documents.withColumns({"size": word_count(F.col("text")), "draw": draw_order("doc_id", seed)})


def mix_sources(
    documents: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    seed: int = SEED,
) -> DataFrame:
    """doc_id, size, source_size, target and taken of every document.

    ``documents`` needs doc_id, text and source; other columns are ignored. A
    null source is a source of its own, a null text has no words and is never
    taken, an empty table gives an empty result. Rows that repeat an id share
    the cut in proportion to their sizes. The same seed gives the same mix
    under any partitioning.
    """
    narrow = checkpointed(
        sized(documents.select("doc_id", "source", "text"), seed).drop("text")
    )
    plan = mix_plan(narrow, weights, share, cap, seed)
    return with_taken(narrow, plan).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(
    documents: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    seed: int = SEED,
) -> DataFrame:
    """The mix itself, with the columns of ``documents``: one row per repetition.

    The document in which a source's extra part ends appears once more with
    its first words only, joined by single blanks; its n_chars, if there is
    such a column, follows. Texts are not shuffled: a row's repetitions follow
    from its source's plan. Where size, draw or the plan's names are columns
    of the documents already, they pass through.
    """
    names = documents.columns
    row = F.struct(*[F.col(c) for c in names]).alias("row")
    rows = documents.select("doc_id", "source", "text", row)
    narrow = checkpointed(sized(rows.select("doc_id", "source", "text"), seed).drop("text"))
    taken = with_taken(sized(rows, seed), mix_plan(narrow, weights, share, cap, seed))
    copies = F.expr("cast(ceil(try_divide(cast(taken as double), size)) as int)")
    numbered = taken.where(F.col("taken") > 0).select(
        "row", "size", "taken", F.explode(F.sequence(F.lit(1), copies)).alias("copy")
    )
    left = F.col("taken") - (F.col("copy") - 1) * F.col("size")
    words = F.filter(F.split("row.text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    start = F.array_join(F.slice(words, F.lit(1), left.cast("int")), " ")
    text = F.when(left >= F.col("size"), F.col("row.text")).otherwise(start)
    fields = {c: F.col("row").getField(c) for c in names} | {"text": text}
    if "n_chars" in names:
        kind = documents.schema["n_chars"].dataType
        fields["n_chars"] = (
            F.when(left >= F.col("size"), F.col("row.n_chars")).otherwise(F.length(start)).cast(kind)
        )
    return numbered.select(*[fields[c].alias(c) for c in names])

"""Balanced sharding by label propagation.

Documents of equal text are one unit, and units that share a long line are
linked through it. Units start laid along the shards in the order of a line
they share, each shard filled to its quota. Each round counts, for every unit,
in which shards its neighbours are, and moves units to the shard of most of
them as far as the shards' room allows. What a shard then holds beyond its
quota goes on to free room, again in the order of lines.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tollstats.llm.staging import checkpointed
from tollstats.operators.joins import broadcast_if_small

SHARDS = 16
ROUNDS = 3
SALTS = 4096
# Lines of fewer characters link nothing.
LINK_CHARS = 40
# A unit of more than this share of a shard's quota is heavy: it is placed before
# the others, by size. There are at most SHARDS / HEAVY of them.
HEAVY = 1 / 64
# Equal texts stay together unless they have more than this share of a quota.
WHOLE = 0.9
# Units of more than this share of a quota are laid before the others, which then even out the ends.
COARSE = 1 / 1024
# Running sums go over the totals of buckets, of this many rows on average, and of
# this many buckets at least.
BUCKET_ROWS, BUCKETS = 1 << 12, 256


def _bits(rows: int) -> int:
    """So many leading bits of a hash number enough buckets for the rows."""
    return (max(BUCKETS, -(-rows // BUCKET_ROWS)) - 1).bit_length()


def _running(frame: DataFrame, lane: str, coarse: float) -> DataFrame:
    """Add ``before``: the weight of the units ahead in the same lane, coarse ones first, then by ``place`` and line.

    Totals of places are summed first, a bounded number of rows, and then the
    units inside each place.
    """
    classed = frame.withColumn("class", F.when(F.col("weight") > coarse, 0).otherwise(1))
    keys = [lane, "class", "place"]
    totals = classed.groupBy(*keys).agg(F.sum("weight").alias("filled"))
    ahead = Window.partitionBy(lane).orderBy("class", "place").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select(*keys, F.coalesce(F.sum("filled").over(ahead), F.lit(0)).alias("shift"))
    inside = Window.partitionBy(*keys).orderBy("line", "unit").rowsBetween(Window.unboundedPreceding, -1)
    # shifts has two rows a place and lane, of BUCKET_ROWS units each on average.
    return (
        classed.withColumn("inside", F.coalesce(F.sum("weight").over(inside), F.lit(0)))
        .join(broadcast_if_small(checkpointed(shifts)), keys)
        .withColumn("before", F.col("shift") + F.col("inside"))
        .drop("class", "inside", "shift")
    )


def _placed(units: DataFrame, rows: int) -> DataFrame:
    """Add ``place``: a range of lines, or a part of the units of one very common line.

    Places order the units by their line, so that neighbours lie side by side.
    """
    hot = units.groupBy("line").agg(F.count("*").alias("n")).where(F.col("n") > BUCKET_ROWS)
    parts = hot.select("line", F.ceil(F.col("n") / BUCKET_ROWS).cast("int").alias("parts"))
    bucket = F.shiftright("line", 64 - _bits(rows)).cast("int")
    part = F.coalesce(F.pmod(F.xxhash64(F.lit(17), "unit"), F.col("parts")), F.lit(0)).cast("int")
    alone = F.coalesce(F.when(F.col("parts").isNotNull(), F.col("line")), F.lit(0))
    place = F.struct(bucket.alias("bucket"), alone.alias("alone"), part.alias("part"))
    return units.join(broadcast_if_small(checkpointed(parts)), "line", "left").withColumn("place", place).drop("parts")


def _laid(units: DataFrame, room: np.ndarray, coarse: float) -> DataFrame:
    """Add ``shard``: the units end to end along the shards' room, in the order of their lines."""
    ends = np.cumsum(room)
    laid = _running(units.withColumn("lane", F.lit(0)), "lane", coarse)
    middle = F.col("before") + F.col("weight") / 2
    shard = F.size(F.filter(F.array(*[F.lit(float(e)) for e in ends[:-1]]), lambda e: e <= middle))
    return laid.withColumn("shard", shard).drop("lane", "before")


def place_heavy(weights: list[tuple[int, int]], shards: int) -> tuple[dict[int, int], list[int]]:
    """Shard of each heavy unit, largest first into the emptiest shard, and the shards' loads."""
    loads, where = [0] * shards, {}
    for unit, weight in sorted(weights, key=lambda w: (-w[1], w[0])):
        best = min(range(shards), key=lambda s: (loads[s], s))
        where[unit] = best
        loads[best] += weight
    return where, loads


def move_shares(wanted: np.ndarray, loads: np.ndarray, quotas: np.ndarray) -> np.ndarray:
    """The share of the weight wanting to go from shard to shard that may go.

    Opposite flows are exchanged one for one; beyond that a shard takes what it
    has room for, from all others in proportion.
    """
    allowed = np.minimum(wanted, wanted.T)
    rest = wanted - allowed
    room = np.maximum(quotas - loads, 0)
    arriving = rest.sum(axis=0)
    taken = np.divide(np.minimum(room, arriving), arriving, out=np.zeros_like(arriving), where=arriving > 0)
    allowed = allowed + rest * taken[None, :]
    return np.divide(allowed, wanted, out=np.zeros_like(wanted), where=wanted > 0)


def propagate(
    units: DataFrame, links: DataFrame, quotas: np.ndarray, shards: int, rounds: int
) -> DataFrame:
    """The units with their shard after the given rounds.

    ``units`` has unit, weight and a first shard, ``links`` has (line, unit).
    A round joins the links with the shards twice: shards are counted per line,
    then the counts per unit. Lines weigh less the more units they have. Only
    the matrix of wanted flows, shards x shards numbers, comes to the driver.
    """
    each = range(shards)
    for turn in range(rounds):
        present = links.join(units.select("unit", "shard"), "unit")
        counts = present.groupBy("line").agg(
            *[F.count_if(F.col("shard") == s).cast("double").alias(f"n{s}") for s in each],
            F.count("*").alias("size"),
        )
        counts = checkpointed(counts)  # so that the join may split a line of very many units
        votes = (
            links.join(counts, "line")
            .groupBy("unit")
            .agg(*[F.round(F.sum(F.col(f"n{s}") / F.col("size")), 6).alias(f"v{s}") for s in each])
            .select("unit", F.array(*[f"v{s}" for s in each]).alias("votes"))
        )
        best = (F.array_position("votes", F.array_max("votes")) - 1).cast("int")
        here = F.get("votes", F.col("shard"))
        asked = checkpointed(
            units.join(votes, "unit", "left").withColumn(
                "goal", F.when(F.array_max("votes") > here, best).otherwise(F.col("shard"))
            ).drop("votes")
        )
        flows = asked.groupBy("shard", "goal").agg(F.sum("weight").alias("weight")).collect()
        wanted, loads = np.zeros((shards, shards)), np.zeros(shards)
        for f in flows:
            loads[f["shard"]] += f["weight"]
            if f["shard"] != f["goal"]:
                wanted[f["shard"], f["goal"]] = f["weight"]
        shares = F.array(*[F.lit(float(x)) for x in move_shares(wanted, loads, quotas).ravel()])
        drawn = F.pmod(F.xxhash64(F.lit(turn), "unit"), F.lit(1 << 30)) / float(1 << 30)
        goes = drawn < F.get(shares, F.col("shard") * shards + F.col("goal"))
        units = asked.withColumn("shard", F.when(goes, F.col("goal")).otherwise(F.col("shard"))).drop("goal")
    return units


def settle(units: DataFrame, quotas: np.ndarray) -> DataFrame:
    """(unit, shard) with every shard at its quota, up to one small unit.

    A shard keeps units up to its quota, in the order of their lines, and the
    rest is laid along the free room in the same order.
    """
    coarse = COARSE * float(quotas.mean())
    limits = F.array(*[F.lit(float(q)) for q in quotas])
    ranked = checkpointed(_running(units, "shard", coarse))
    stays = F.col("before") + F.col("weight") <= F.get(limits, F.col("shard"))
    kept, moved = ranked.where(stays), ranked.where(~stays)
    loads = np.zeros(len(quotas))
    for row in kept.groupBy("shard").agg(F.sum("weight").alias("weight")).collect():
        loads[row["shard"]] = row["weight"]
    laid = _laid(moved.drop("shard", "before"), np.maximum(quotas - loads, 0), coarse)
    return kept.select("unit", "shard").unionByName(laid.select("unit", "shard"))


def kept_links(units: DataFrame, links: DataFrame) -> DataFrame:
    """line, units and kept: the share of the pairs of a line's units that lie in one shard."""
    held = links.join(units.select("unit", "shard"), "unit").groupBy("line", "shard").agg(F.count("*").alias("n"))
    pairs = F.sum(F.col("n") * (F.col("n") - 1))
    sizes = held.groupBy("line").agg(F.sum("n").alias("units"), pairs.alias("together"))
    return sizes.where(F.col("units") > 1).select(
        "line", "units", (F.col("together") / (F.col("units") * (F.col("units") - 1))).alias("kept")
    )


class Graph(NamedTuple):
    """What is to be sharded: units with weight, line, place and first shard; links (line, unit);
    the shards' quotas; the heavy units' shards; and the documents with their unit."""

    units: DataFrame
    links: DataFrame
    quotas: np.ndarray
    heavy: dict[int, int]
    rows: DataFrame


def linked_units(documents: DataFrame, shards: int = SHARDS) -> Graph:
    """The graph that is propagated on, laid along the shards for a start."""
    text = F.coalesce("text", F.lit(""))
    long_lines = F.filter(F.split(text, "\n"), lambda x: F.length(x) >= LINK_CHARS)
    rows = checkpointed(
        documents.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("bigint").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.xxhash64(text).alias("node"),
            F.array_distinct(F.transform(long_lines, lambda x: F.xxhash64(x))).alias("lines"),
            # Tells rows apart that are equal in all else, so that they can be spread.
            F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int").alias("salt"),
        )
    )
    sums = rows.agg(F.sum("size").alias("size"), F.count("*").alias("rows")).first()
    total = sums["size"] or 0
    quota = total / shards
    groups = rows.groupBy("node").agg(F.sum("size").alias("weight"))
    # Fewer than shards / WHOLE groups can have so many bytes.
    large = groups.where(F.col("weight") > quota * WHOLE).select(
        "node", F.ceil(F.col("weight") / F.lit(max(quota, 1.0) * WHOLE / 2)).alias("parts")
    )
    part = F.pmod(F.xxhash64("doc_id", "salt"), F.col("parts"))
    member = F.when(F.col("parts").isNull(), F.col("node")).otherwise(F.xxhash64("node", part))
    rows = checkpointed(rows.join(F.broadcast(large), "node", "left").withColumn("unit", member).drop("parts"))
    weights = checkpointed(rows.groupBy("unit").agg(F.sum("size").alias("weight")))
    bound = quota * HEAVY
    # Fewer than shards / HEAVY units can be heavy.
    heavy = [(r["unit"], r["weight"]) for r in weights.where(F.col("weight") > bound).collect()]
    where, loads = place_heavy(heavy, shards)
    free = np.maximum(quota - np.array(loads, dtype=float), 0)
    rest = total - sum(loads)
    quotas = free * (rest / free.sum()) if free.sum() else np.full(shards, rest / shards)

    pairs = rows.where(F.col("unit") == F.col("node")).select("unit", F.explode("lines").alias("line")).distinct()
    shared = pairs.groupBy("line").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("line")
    links = checkpointed(pairs.join(shared, "line"))
    light = weights.where(F.col("weight") <= bound)
    origin = links.groupBy("unit").agg(F.min("line").alias("line"))
    units = light.join(origin, "unit", "left").select("unit", "weight", F.coalesce("line", "unit").alias("line"))
    placed = checkpointed(_placed(checkpointed(units), sums["rows"]))
    first = checkpointed(_laid(placed, quotas, COARSE * float(quotas.mean())))
    return Graph(first, links, quotas, where, rows)


def assign_shards(documents: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text plus 1), text_crc32, shard and slot of every document.

    Shards are near equal in bytes. Equal texts share a shard unless they have
    nearly a shard's bytes or more; then they are dealt over a few. ``slot``
    numbers the documents of a shard from 0 without gaps.

    A null text counts as an empty one. Rows with a null id, and repeated rows,
    get a shard like any other. Further columns are ignored; an empty table
    gives an empty result.
    """
    graph = linked_units(documents, shards)
    settled = settle(propagate(graph.units, graph.links, graph.quotas, shards, rounds), graph.quotas)
    spark = documents.sparkSession
    fixed = spark.createDataFrame(list(graph.heavy.items()), "unit long, shard int")
    key = ["doc_id", "text_crc32", "size", "salt"]
    labelled = graph.rows.join(settled.unionByName(fixed), "unit").select(*key, "shard")
    bucket = F.shiftright(F.xxhash64(*key), 64 - _bits(graph.rows.count())).cast("int")
    labelled = checkpointed(labelled.withColumn("bucket", bucket))
    counts = labelled.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("shift"))
    inside = Window.partitionBy("shard", "bucket").orderBy(*key)
    # shifts has a row a shard and bucket, of BUCKET_ROWS documents or fewer on average.
    return (
        labelled.withColumn("place", F.row_number().over(inside) - 1)
        .join(broadcast_if_small(checkpointed(shifts)), ["shard", "bucket"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("shift") + F.col("place")).alias("slot"))
    )

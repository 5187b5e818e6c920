"""Near-duplicate classes of documents by dart signatures and an exact check.

Documents of equal text are one node, named by the MD5 of the text. Nodes whose signatures agree in a whole
band of coordinates are candidates; candidates are linked if their sets of word
shingles are at least ``SIMILARITY`` alike, and classes are the connected
components of the links.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollstats.llm.components import connected_components
from tollstats.llm.darts import COORDINATES, band_hashes, short_signature, signature
from tollstats.llm.shipping import ship_package
from tollstats.llm.staging import checkpointed, staged
from tollstats.llm.tokens import SHINGLE_WORDS, shingle_hashes, word_hashes
from tollstats.operators.joins import broadcast_if_small

SIMILARITY = 0.8
# Buckets up to this size are compared pair by pair, larger ones through hubs first.
SMALL_BUCKET = 8
# Rows of the two blocks that meet in one task.
ASK_BLOCK, OTHER_BLOCK = 128, 256
# Candidates are compared exactly if this share of short signatures agrees; at a
# similarity of 0.8 fewer agree with a probability below 1e-7 (1e-4 with repeats).
LIKELY = 0.6
# A shingle weighs 1 and for its repeats up to this much more. The exact check
# compares sets, and bounded weights keep the similarity of signatures near theirs.
REPEATS_WEIGH = 1 / 16


def shingle_weights(counts: np.ndarray) -> np.ndarray:
    """From 1 for a single occurrence towards 1 + ``REPEATS_WEIGH`` for very many."""
    return 1.0 + REPEATS_WEIGH * (1.0 - 1.0 / counts)


def _signatures(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        nodes, bands, short, widths = [], [], [], []
        for text in batch["text"]:
            raw = (text or "").encode()
            shingles = shingle_hashes(word_hashes(raw), SHINGLE_WORDS)
            elements, counts = np.unique(shingles, return_counts=True)
            kept = signature(elements, shingle_weights(counts))
            nodes.append(hashlib.md5(raw).digest())
            widths.append(len(elements))
            bands.append(None if kept is None else band_hashes(kept))
            short.append(None if kept is None else short_signature(kept))
        ids = batch["doc_id"].astype("Int64")
        yield pd.DataFrame({"doc_id": ids, "node": nodes, "bands": bands, "short": short, "width": widths})


def _shingle_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The distinct shingles of each node."""
    for batch in batches:
        for node, text in zip(batch["node"], batch["text"]):
            found = np.unique(shingle_hashes(word_hashes(text), SHINGLE_WORDS))
            yield pd.DataFrame({"shingle": found.view(np.int64), "node": [node] * len(found)})


def _likely(a: pd.Series, b: pd.Series) -> pd.Series:
    left = np.frombuffer(b"".join(a), dtype=np.uint8).reshape(-1, COORDINATES)
    right = np.frombuffer(b"".join(b), dtype=np.uint8).reshape(-1, COORDINATES)
    return pd.Series((left == right).mean(axis=1) >= LIKELY)


def jaccard(a: pd.Series, b: pd.Series) -> pd.Series:
    """Exact similarity of the sets of word shingles; two texts without words are alike."""
    result, last, left = [], None, None
    for x, y in zip(a, b):
        if left is None or x != last:
            last, left = x, np.unique(shingle_hashes(word_hashes(x), SHINGLE_WORDS))
        right = np.unique(shingle_hashes(word_hashes(y), SHINGLE_WORDS))
        common = len(np.intersect1d(left, right, assume_unique=True))
        result.append(common / (len(left) + len(right) - common) if len(left) + len(right) else 1.0)
    return pd.Series(result, dtype=float)


def _pairs(frame: DataFrame, left: str, right: str) -> DataFrame:
    """Unordered pairs of different nodes."""
    return frame.where(F.col(left) != F.col(right)).select(
        F.least(left, right).alias("a"), F.greatest(left, right).alias("b")
    )


def _members(nodes: DataFrame) -> DataFrame:
    """(band, node, size, low, hub) of nodes in buckets of two or more.

    A bucket's hub is the member with the most companions over all its buckets,
    such as the text from which a group of near copies was made.
    """
    rows = nodes.select(F.explode("bands").alias("band"), "node")
    sizes = (
        rows.groupBy("band")
        .agg(F.count("*").alias("size"), F.min("node").alias("low"))
        .where(F.col("size") > 1)
    )
    shared = checkpointed(rows.join(sizes, "band"))
    known = shared.groupBy("node").agg(F.sum("size").alias("companions"))
    hubs = (
        shared.join(known, "node")
        .groupBy("band")
        .agg(F.min(F.struct(-F.col("companions"), "node")).alias("best"))
        .select("band", F.col("best.node").alias("hub"))
    )
    return checkpointed(shared.join(hubs, "band"))


def _first_pairs(members: DataFrame) -> DataFrame:
    """Everyone with the hub and the smallest member; all pairs of small buckets."""
    small = members.where(F.col("size") <= SMALL_BUCKET).select("band", "node")
    inside = small.join(small.withColumnRenamed("node", "other"), "band").where(
        F.col("node") < F.col("other")
    )
    return (
        _pairs(members, "node", "hub")
        .unionByName(_pairs(members.where(F.col("size") > SMALL_BUCKET), "node", "low"))
        .unionByName(_pairs(inside, "node", "other"))
        .distinct()
    )


def _node(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def _texts(wanted: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, text) of the given nodes (node), once each.

    A text is taken from the document of its smallest id only, so of a text
    that a third of all documents have, few rows are read further.
    """
    chosen = nodes.select("node", "equal_id").join(wanted, "node", "left_semi")
    chosen = broadcast_if_small(checkpointed(chosen))
    found = texts.select("doc_id", "text", _node(F.col("text")).alias("found"))
    same = (F.col("found") == F.col("node")) & F.col("doc_id").eqNullSafe(F.col("equal_id"))
    return found.join(chosen, same).groupBy("node").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))


def _compare_blocks(asks: pd.DataFrame, others: pd.DataFrame, similarity: float) -> pd.DataFrame:
    """Links between the rows of two blocks that join different components.

    The shingles of one block form an inverted list; each row of the other
    counts its common shingles with all of them at once. A link between
    components that earlier links of the blocks have joined already is left
    out, so fewer links than components leave the task, not all pairs.
    """
    links, parent = [], {}

    def root(component):
        while component in parent:
            component = parent[component]
        return component

    if len(asks) and len(others):
        sets = [np.unique(shingle_hashes(word_hashes(t), SHINGLE_WORDS)) for t in others["text"]]
        widths = np.array([len(s) for s in sets])
        values, owners = np.concatenate(sets), np.repeat(np.arange(len(sets)), widths)
        order = np.argsort(values, kind="stable")
        values, owners = values[order], owners[order]
        nodes, own = others["node"].to_numpy(), others["own"].to_numpy()
        for node, component, text in zip(asks["node"], asks["own"], asks["text"]):
            mine = np.unique(shingle_hashes(word_hashes(text), SHINGLE_WORDS))
            start, stop = np.searchsorted(values, mine), np.searchsorted(values, mine, side="right")
            runs = stop - start
            places = np.arange(runs.sum()) + np.repeat(start - (np.cumsum(runs) - runs), runs)
            shared = np.bincount(owners[places], minlength=len(sets))
            alike = (shared >= similarity * (len(mine) + widths - shared)) & (own != component)
            for other, of in zip(nodes[alike], own[alike]):
                mine_now, theirs = root(component), root(of)
                if mine_now != theirs:
                    parent[theirs] = mine_now
                    links.append((min(node, other), max(node, other)))
    return pd.DataFrame(links, columns=["a", "b"], dtype=object)


def _rest_links(
    members: DataFrame, labels: DataFrame, nodes: DataFrame, texts: DataFrame, similarity: float
) -> DataFrame:
    """Links between members of larger buckets that hubs left in different components.

    Whoever is not in its hub's component is compared with all members of that
    hub's buckets, block against block; only links leave the tasks. Left out
    are texts that cannot have a link: of n shingles, as many as the
    similarity's share must occur in any other text at all, which is not so for
    copies with many changes.
    """
    of = labels.select("node", F.col("component").alias("own"))
    placed = (
        members.where(F.col("size") > SMALL_BUCKET)
        .select("hub", "node")
        .distinct()
        .join(of, "node", "left")
        .withColumn("own", F.coalesce("own", "node"))
    )
    of_hub = labels.select(F.col("node").alias("hub"), F.col("component").alias("hubs"))
    placed = placed.join(of_hub, "hub", "left").withColumn("apart", F.col("own") != F.coalesce("hubs", "hub"))
    placed = checkpointed(placed.select("hub", "node", "own", "apart"))
    opened = checkpointed(placed.join(placed.where("apart").select("hub").distinct(), "hub", "left_semi"))

    wanted = _texts(opened.select("node").distinct(), nodes, texts).join(nodes.select("node", "width"), "node")
    wanted = staged(wanted, "texts")
    shingles = wanted.select("node", "text").mapInPandas(_shingle_rows, "shingle long, node binary")
    common = shingles.groupBy("shingle").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    of_node = shingles.join(common, "shingle", "left_semi").groupBy("node").agg(F.count("*").alias("common"))
    able = (
        wanted.join(of_node, "node")
        .where(F.col("common") >= similarity * F.col("width"))
        .select("node", "text")
    )
    able = checkpointed(opened.join(able.select("node"), "node"))
    blocks = able.groupBy("hub").agg(
        F.ceil(F.count_if("apart") / ASK_BLOCK).cast("int").alias("asks"),
        F.ceil(F.count("*") / OTHER_BLOCK).cast("int").alias("others"),
    )
    dealt = able.join(blocks.where(F.col("asks") > 0), "hub").join(wanted.select("node", "text"), "node")

    def numbered(n: str, salt: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(salt), "node"), F.col(n)).cast("int")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    keys = ["hub", "ask_block", "other_block"]
    asks = dealt.where("apart").select(
        "hub", numbered("asks", 1).alias("ask_block"), every("others").alias("other_block"), "node", "own", "text"
    )
    others = dealt.select(
        "hub", every("asks").alias("ask_block"), numbered("others", 2).alias("other_block"), "node", "own", "text"
    ).toDF(*keys, "node", "own", "text")  # columns of its own, apart from those of asks
    found = (
        asks.groupBy(*keys)
        .cogroup(others.groupBy(*keys))
        .applyInPandas(lambda x, y: _compare_blocks(x, y, similarity), "a binary, b binary")
    )
    return checkpointed(found.distinct())


def _links(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose shingle sets are alike enough."""
    alike, measured = F.pandas_udf(_likely, "boolean"), F.pandas_udf(jaccard, "double")
    left = nodes.select(F.col("node").alias("a"), F.col("short").alias("short_a"))
    right = nodes.select(F.col("node").alias("b"), F.col("short").alias("short_b"))
    likely = checkpointed(
        pairs.join(left, "a").join(right, "b").where(alike("short_a", "short_b")).select("a", "b")
    )
    wanted = staged(_texts(likely.select(F.explode(F.array("a", "b")).alias("node")).distinct(), nodes, texts), "texts")
    first = wanted.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    second = wanted.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    measure = measured("text_a", "text_b") >= similarity
    return checkpointed(likely.join(first, "a").join(second, "b").where(measure).select("a", "b"))


class Classes(NamedTuple):
    """``rows``: doc_id and node of every document. ``nodes``: node, equal_id, component, class_id of every text."""

    rows: DataFrame
    nodes: DataFrame


def classified(documents: DataFrame, similarity: float = SIMILARITY) -> Classes:
    """The near-duplicate classes of the documents' texts (see ``near_duplicates``)."""
    ship_package(documents.sparkSession)
    sketches = staged(
        documents.select("doc_id", "text").mapInPandas(
            _signatures, "doc_id long, node binary, bands array<long>, short binary, width int"
        ),
        "sketches",
    )
    # Equal texts have equal sketches, so any row of a node stands for all.
    texts = checkpointed(
        sketches.groupBy("node").agg(
            F.min("doc_id").alias("equal_id"), *[F.first(c).alias(c) for c in ("bands", "short", "width")]
        )
    )
    nodes = texts.where(F.col("bands").isNotNull())
    members = _members(nodes)
    links = _links(_first_pairs(members), nodes, documents, similarity)
    labels = connected_components(links)
    more = _rest_links(members, labels, nodes, documents, similarity)
    if not more.isEmpty():
        labels = connected_components(links.unionByName(more))
    known = texts.select("node", "equal_id").join(labels, "node", "left")
    known = checkpointed(known.withColumn("component", F.coalesce("component", "node")))
    named = known.groupBy("component").agg(F.min("equal_id").alias("class_id"), F.count("*").alias("texts"))
    # Most components are one text, whose class needs no join.
    several = broadcast_if_small(checkpointed(named.where(F.col("texts") > 1).drop("texts")))
    of_class = F.coalesce("class_id", "equal_id").alias("class_id")
    joined = known.join(several, "component", "left").select("node", "equal_id", "component", of_class)
    return Classes(sketches.select("doc_id", "node"), joined)


def near_duplicates(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id (the smallest doc_id of the class) and equal_id (that of the equal texts).

    ``documents`` needs doc_id and text; further columns are ignored. A null
    text is empty, and documents without words are alike only if equal. Rows
    with a null id belong to the class of their text like any other; an id of
    null is given only where all texts of the class, or all equal texts, lack
    one. An id with several texts belongs to the classes of all of them.
    Repeated rows of an id get a row each; an empty table gives an empty result.

    Bands are cut so that two texts of similarity 0.8 become candidates with a
    probability of 0.9993; where one repeats shingles that the other has once,
    it is 0.99 at least. Buckets of candidates are first compared with hubs;
    what this leaves in different components is then compared block by block,
    so hubs save work and lose nothing.
    """
    classes = classified(documents, similarity)
    return classes.rows.join(classes.nodes, "node").select("doc_id", "class_id", "equal_id")


def without_near_duplicates(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each class, with all its columns.

    It is the one of the smallest id, a missing id being larger than any, and
    of the smallest text digest where that id has several texts of the class.
    Classes whose documents all lack an id keep one as well. Of repeated rows
    of that id and text one stays, chosen by a hash of all columns.
    """
    classes = classified(documents, similarity)
    order = F.struct(F.col("equal_id").isNull(), "equal_id", "node")
    chosen = classes.nodes.groupBy("component").agg(F.min(order).alias("best")).select("best.equal_id", "best.node")
    copies = classes.rows.groupBy("doc_id", "node").agg(F.count("*").alias("copies")).where(F.col("copies") > 1)
    same = F.col("equal_id").eqNullSafe(F.col("doc_id")) & (F.col("chosen") == F.col("node"))
    several = chosen.withColumnRenamed("node", "chosen").join(copies, same, "left")
    marked = several.select(
        F.col("equal_id").alias("_id"), F.col("chosen").alias("_node"), F.col("copies").isNotNull().alias("_several")
    )
    rows = documents.withColumn("_text_node", _node(F.col("text")))
    here = (F.col("_text_node") == F.col("_node")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    found = rows.join(broadcast_if_small(checkpointed(marked)), here)
    names = documents.columns
    repeated = found.where("_several").groupBy("_text_node", "_id")
    smallest = F.min_by(F.struct(*names), F.xxhash64(*names)).alias("row")
    return found.where(~F.col("_several")).select(*names).unionByName(repeated.agg(smallest).select("row.*"))

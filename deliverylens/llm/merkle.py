"""A Merkle manifest of a table, in blocks of a van Emde Boas layout.

Rows are leaves, in order within their source. Three neighbours (fewer at the end) become
one node, up to a subroot for each source; the subroots, in order of their sources, become
the root in the same way. Nodes are kept in blocks: a block is an aligned subtree of up to
3^7 leaves, stored as one binary in which the subtree is split at half its height, the top
half first and then each bottom half, each split again in the same way. A path from leaf
to root thus lies in few pieces whatever a page or cache line holds, and the address of a
node follows from its depth and index alone.

The roots of a tier's blocks are the leaves of the next tier, until one block is left. So
a tier costs one shuffle of the digests below it, a task holds blocks and never a source,
and siblings are found block by block from the top down.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deliverylens.llm.storage import written

FAN = 3
BLOCK_LEVELS = 8  # of nodes, leaves included
PART_ROWS = 200_000  # rows of digests that are ordered in one task
DIGEST = 32


def leaf_digest(*fields: Column) -> Column:
    """SHA-256 of a row: each field is ``-`` if null, else its UTF-8 length, ``:`` and itself."""

    def framed(field: Column) -> Column:
        text = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(framed, fields)), 256)


def subtree_nodes(levels: int) -> int:
    """Nodes of a full subtree of so many levels."""
    return (FAN**levels - 1) // (FAN - 1)


@cache
def addresses(levels: int) -> tuple[np.ndarray, ...]:
    """By depth, the places of all nodes of a full subtree in its van Emde Boas layout."""
    found = []
    for depth in range(levels):
        index = np.arange(FAN**depth)
        place = np.zeros(len(index), np.int64)
        height, left = levels, depth
        while height > 1:
            top = height // 2
            if left < top:
                height = top
                continue
            below = FAN ** (left - top)
            place += subtree_nodes(top) + index // below * subtree_nodes(height - top)
            index, left, height = index % below, left - top, height - top
        found.append(place)
    return tuple(found)


def levels_of(n: int, least: int) -> int:
    """Levels of a block of ``n`` leaves: as many as lead to one node, ``least`` at the least."""
    levels = least
    while FAN ** (levels - 1) < n:
        levels += 1
    return levels


def parent(run: list[str]) -> str:
    return hashlib.sha256("".join(run).encode()).hexdigest()


def build_block(leaves: list[bytes], least: int) -> tuple[bytes, str]:
    """The nodes of a block in their layout, absent ones as zeros, and its root."""
    levels = levels_of(len(leaves), least)
    where = addresses(levels)
    nodes = np.zeros((subtree_nodes(levels), DIGEST), np.uint8)
    row = [leaf.hex() for leaf in leaves]
    for depth in reversed(range(levels)):
        nodes[where[depth][: len(row)]] = np.frombuffer(bytes.fromhex("".join(row)), np.uint8).reshape(-1, DIGEST)
        if depth:
            row = [parent(row[k : k + FAN]) for k in range(0, len(row), FAN)]
    return nodes.tobytes(), row[0]


def block_paths(nodes: bytes, n: int, least: int, above: str) -> list[str]:
    """For each leaf of a block, the siblings on its way up: ``before,after`` at each level
    (hexadecimal digests, several joined), levels ended by ``;``. ``above`` is the way
    from the block's root on."""
    levels = levels_of(n, least)
    where = addresses(levels)
    stored = np.frombuffer(nodes, np.uint8).reshape(-1, DIGEST)
    ways = [above]
    for depth in range(1, levels):
        size = -(-n // FAN ** (levels - 1 - depth))
        text = stored[where[depth][:size]].tobytes().hex()
        row = [text[k : k + 2 * DIGEST] for k in range(0, len(text), 2 * DIGEST)]
        ways = [
            f"{''.join(row[k - k % FAN : k])},{''.join(row[k + 1 : k - k % FAN + FAN])};{ways[k // FAN]}" for k in range(size)
        ]
    return ways


def fold(leaf: str, way: str) -> str:
    """The root that a leaf and the siblings on its way lead to."""
    for level in way.split(";")[:-1]:
        before, _, after = level.partition(",")
        leaf = parent([before, leaf, after])
    return leaf


def siblings_digest(way: str) -> str:
    return hashlib.sha256(way.replace(",", "").replace(";", "").encode()).hexdigest()


BUILT = T.StructType([T.StructField("nodes", T.BinaryType()), T.StructField("node", T.StringType())])
PROVED = T.StructType(
    [T.StructField("proof", T.ArrayType(T.StringType())), T.StructField("folded", T.ArrayType(T.StringType()))]
)


@F.pandas_udf(BUILT)
def _built(leaves: pd.Series, least: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([build_block(list(x), k) for x, k in zip(leaves, least, strict=True)], columns=["nodes", "node"])


@F.pandas_udf(T.ArrayType(T.StringType()))
def _ways(nodes: pd.Series, n: pd.Series, least: pd.Series, above: pd.Series) -> pd.Series:
    return pd.Series([block_paths(*block) for block in zip(nodes, n, least, above, strict=True)], dtype=object)


@F.pandas_udf(PROVED)
def _proved(nodes: pd.Series, n: pd.Series, least: pd.Series, above: pd.Series, claimed: pd.Series) -> pd.DataFrame:
    rows = []
    for *block, leaves in zip(nodes, n, least, above, claimed, strict=True):
        ways = block_paths(*block)
        folded = [fold(leaf.hex(), way) for leaf, way in zip(leaves, ways, strict=True)]
        rows.append(([siblings_digest(way) for way in ways], folded))
    return pd.DataFrame(rows, columns=["proof", "folded"])


def placed(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``rows`` with ``place``, their number from 0 within ``key`` (never null) in this order,
    which must tell all rows apart. Rows are dealt out by ranges of key and order, so a key
    with most of the rows spreads over many tasks; what joins them is a count a range."""
    spark = rows.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, 1 + rows.count() // PART_ROWS)
    at = F.monotonically_increasing_id()  # its upper bits number the ranges, its lower 33 bits their rows
    ordered = written(
        rows.repartitionByRange(parts, key, *order).sortWithinPartitions(key, *order).withColumn("at", at), "ordered"
    ).withColumn("part", F.shiftrightunsigned("at", 33))
    before = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (
        ordered.groupBy(key, "part")
        .agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
        .select(key, "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    )
    return ordered.join(written(ranges, "ranges"), [key, "part"]).withColumn("place", F.col("at") + F.col("shift")).drop(
        "at", "part", "shift"
    )


def tiers_of(rows: DataFrame, most: int, block_levels: int) -> list[DataFrame]:
    """Blocks of all tiers, the lowest first: key, block, least (levels), n, rows (an array of structs in
    order), nodes, node (the block's root). ``rows`` has key, place, leaf and maybe more;
    ``most`` is the number of rows of the largest key."""
    tiers = []
    width = FAN ** (block_levels - 1)
    while True:
        blocks = (
            rows.withColumn("block", F.expr(f"place div {width}"))
            .groupBy("key", "block")
            .agg(F.sort_array(F.collect_list(F.struct("place", *[c for c in rows.columns if c not in ("key", "place")]))).alias("rows"))
        )
        # where a key has several blocks, each goes up all levels, the last one as well
        alone = F.max("place") < width
        last = rows.groupBy("key").agg(F.when(alone, 1).otherwise(block_levels).alias("least"))
        blocks = blocks.join(written(last, "keys"), "key")
        built = blocks.withColumn("n", F.size("rows")).withColumn("b", _built(F.col("rows.leaf"), F.col("least")))
        tiers.append(written(built.select("key", "block", "least", "n", "rows", "b.nodes", "b.node"), "tier"))
        if most <= width:
            return tiers
        most = -(-most // width)
        rows = tiers[-1].where("least > 1").select("key", F.col("block").alias("place"), F.unhex("node").alias("leaf"))


def _down(tiers: list[DataFrame], tops: DataFrame, block_levels: int) -> DataFrame:
    """The lowest blocks with the columns of ``tops`` (key and ``way`` from the key's root on,
    and maybe more), ``way`` led on to each block's root."""
    others = [c for c in tops.columns if c not in ("key", "way")]
    led = None
    for tier in reversed(tiers):
        # the block that is alone in its tier ends in its key's root
        alone = tier.where("least = 1").select("key", "block").join(tops, "key")
        led = alone if led is None else alone.unionByName(led)
        known = tier.join(led, ["key", "block"])
        if tier is tiers[0]:
            return known
        ways = known.select("key", *others, F.posexplode(_ways("nodes", "n", "least", "way")).alias("slot", "way"), "block")
        led = written(
            ways.select("key", (F.col("block") * FAN ** (block_levels - 1) + F.col("slot")).alias("block"), "way", *others), "ways"
        )


@dataclass
class Manifest:
    """The written blocks of all sources and of the tree above them."""

    sources: list[DataFrame]
    above: list[DataFrame]
    root: str | None
    block_levels: int


def build_manifest(leaves: DataFrame, block_levels: int = BLOCK_LEVELS) -> Manifest:
    """The manifest of ``leaves``: doc_id, source (string), leaf (hexadecimal digest), and
    maybe ``claimed``, a digest to be held against the leaf's place later.

    Within a source, rows stand in ascending order of doc_id (null first), equal ids in
    order of their leaves. A null source is one of its own and comes first. Sources may be
    as many or as large as they like. An empty table has no root. The driver holds the
    number of rows of the largest source, the number of sources, and the root.
    """
    claimed = F.col("claimed") if "claimed" in leaves.columns else F.lit(None).cast("string")
    named = leaves.select(
        # keys that are never null and sort as sources do, null first
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")).alias("key"),
        "doc_id",
        F.unhex("leaf").alias("leaf"),
        F.unhex(F.when(claimed != F.col("leaf"), claimed)).alias("claimed"),
        # rows alike in all this are alike in their proofs, and any fixed order of them will do
        F.monotonically_increasing_id().alias("line"),
    )
    ordered = placed(written(named, "leaves"), "key", ["doc_id", "leaf", "line"]).drop("line")
    sizes = ordered.groupBy("key").agg((F.max("place") + 1).alias("n"))
    largest = sizes.agg(F.max("n")).first()[0]
    if largest is None:
        return Manifest([], [], None, block_levels)
    sources = tiers_of(ordered, largest, block_levels)
    subroots = None
    for tier in sources:
        done = tier.where("least = 1").select(F.col("key").alias("source"), "node")
        subroots = done if subroots is None else subroots.unionAll(done)
    subroots = placed(
        written(subroots.select(F.lit("").alias("key"), "source", F.unhex("node").alias("leaf")), "subroots"), "key", ["source"]
    )
    above = tiers_of(subroots, subroots.count(), block_levels)
    return Manifest(sources, above, above[-1].first()["node"], block_levels)


def prove(manifest: Manifest) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified for every leaf of
    a manifest. The proof is the digest of the siblings from leaf to root; folded_root is
    what these and the claimed leaf (the leaf itself where none is claimed) lead to."""
    spark_root = F.lit(manifest.root)
    top = manifest.above[-1].select("key", F.lit("").alias("way"))
    members = _down(manifest.above, top, manifest.block_levels)
    subroots = members.withColumn("ways", _ways("nodes", "n", "least", "way")).select(
        F.inline(F.arrays_zip(F.col("rows.source").alias("key"), F.col("rows.leaf").alias("leaf"), F.col("ways").alias("way")))
    )
    tops = written(subroots.select("key", "way", F.lower(F.hex("leaf")).alias("subroot")), "subroot-ways")
    blocks = _down(manifest.sources, tops, manifest.block_levels)
    claimed = F.transform("rows", lambda r: F.coalesce(r["claimed"], r["leaf"]))
    proved = blocks.select("rows", "subroot", _proved("nodes", "n", "least", "way", claimed).alias("p")).select(
        "subroot",
        F.inline(
            F.arrays_zip(
                F.col("rows.doc_id").alias("doc_id"),
                F.col("rows.leaf").alias("leaf"),
                F.col("p.proof").alias("proof_sha256"),
                F.col("p.folded").alias("folded_root"),
            )
        ),
    )
    return proved.select(
        "doc_id",
        F.lower(F.hex("leaf")).alias("leaf"),
        "subroot",
        spark_root.alias("root"),
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == spark_root).alias("verified"),
    )


def audit_manifest(docs: DataFrame, altered: Column, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """Build the manifest of ``docs`` and hold a later state of its rows against it: what
    ``prove`` returns, with ``altered`` in place of each text.

    Fields of a leaf are doc_id, source, lang, n_chars and text; any of them may be null,
    texts empty or of any length, rows repeated. Other columns are not read, texts are
    read once and only digests of them are moved. An empty table gives an empty result.
    """
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    text = F.col("text").cast("string")
    leaves = docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        leaf_digest(*fields, text).alias("leaf"),
        F.when(altered.eqNullSafe(text), None).otherwise(leaf_digest(*fields, altered)).alias("claimed"),
    )
    manifest = build_manifest(leaves, block_levels)
    if manifest.root is None:
        return leaves.where("false").select(
            "doc_id",
            "leaf",
            *[F.lit(None).cast("string").alias(c) for c in ("subroot", "root", "proof_sha256", "folded_root")],
            F.lit(None).cast("boolean").alias("verified"),
        )
    return prove(manifest)


def without_breaks(docs: DataFrame) -> Column:
    """Each text, for every second document (by the CRC-32 of its id) without its line
    breaks; others, nulls and texts of a null id as they are."""
    text = F.col("text").cast("string")
    return F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)

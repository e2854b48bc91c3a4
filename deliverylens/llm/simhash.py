"""SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint is cut into two halves. Where two fingerprints differ in three
bits or fewer, one half differs in one bit at most, so the halves agree once some one
bit is masked out. Each half is therefore indexed under its 32 one-wildcard variants;
fingerprints that meet on a variant are compared in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deliverylens.llm.components import connected_components
from deliverylens.llm.storage import written
from deliverylens.llm.words import spaced_words, utf8

SHINGLE = 3
MAX_BITS = 3
SEED = 42
HALVES, HALF_BITS = 2, 32
TILE = 2048  # fingerprints of a crowded variant that meet in one go
WINDOW_SHINGLES = 65_536  # hashed at a time, of however long a text


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The majority of each bit over the XXH64 hashes of a text's word shingles."""
    words = spaced_words(utf8(text))
    if not words:
        return 0
    n = max(len(words) - shingle + 1, 1)
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for first in range(0, n, WINDOW_SHINGLES):
        last = min(first + WINDOW_SHINGLES, n)
        hashes = [digest(b" ".join(words[k : k + shingle]), SEED) for k in range(first, last)]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << k for k in range(64) if 2 * ones[k] > n)


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint of each text, its 64 bits as a signed number."""

    @F.pandas_udf(T.LongType())
    def printed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = np.fromiter((fingerprint(t, shingle) for t in texts), np.uint64, len(texts))
            yield pd.Series(found.view(np.int64))

    return printed(text)


def variants(prints: DataFrame) -> DataFrame:
    """(variant, fp) for both halves of each fingerprint under every wildcard bit."""
    bits = [F.lit(k).cast("int") for k in range(HALF_BITS)]
    low, high = F.expr("fp & 4294967295L"), F.expr("shiftrightunsigned(fp, 32)")
    of = lambda half, number: F.array(
        # number of half and wildcard above the 32 bits that are left
        *(
            half.bitwiseAND(F.lit(0xFFFFFFFF ^ (1 << k))).bitwiseOR(F.lit((number * HALF_BITS + k) << HALF_BITS))
            for k in range(len(bits))
        )
    )
    return prints.select(F.explode(F.concat(of(low, 0), of(high, 1))).alias("variant"), "fp")


def spanning_links(left: np.ndarray, right: np.ndarray | None, max_bits: int) -> list[tuple[int, int]]:
    """Links that join what is within ``max_bits``, as few as do.

    ``right`` None: among ``left``; else between the two. Each round takes one
    fingerprint and all not yet reached that are close to one at hand.
    """
    everything = left if right is None else np.concatenate((left, right))
    if len(everything) == 2:
        a, b = everything.tolist()
        return [(a, b)] if (a ^ b).bit_count() <= max_bits else []
    side = None if right is None else np.arange(len(everything)) < len(left)
    todo = np.arange(len(everything))
    links = []
    while len(todo):
        reached = [int(todo[0])]
        todo = todo[1:]
        for at in reached:
            if not len(todo):
                break
            near = np.bitwise_count(everything[todo] ^ everything[at]) <= max_bits
            if side is not None:
                near &= side[todo] != side[at]
            new = todo[near]
            if len(new):
                links += [(int(everything[at]), int(everything[k])) for k in new]
                reached += new.tolist()
                todo = todo[~near]
    return links


LINKS = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def _compare(max_bits: int):
    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            links: set[tuple[int, int]] = set()
            for left, right in zip(batch["left"], batch["right"], strict=True):
                one = np.asarray(left, np.int64).view(np.uint64)
                other = None if right is None else np.asarray(right, np.int64).view(np.uint64)
                links.update(spanning_links(one, other, max_bits))
            found = np.array(sorted(links), np.uint64).reshape(-1, 2).view(np.int64)
            yield pd.DataFrame({"a": found[:, 0], "b": found[:, 1]})

    return compare


def near_links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) of a table that join all
    within ``max_bits`` of each other, though not a link for each such pair.

    A variant's fingerprints are dealt into as many tiles as keep a tile near
    ``TILE``; each pair of tiles is one comparison, so that no comparison holds more
    than two tiles however crowded a variant is.
    """
    # each fingerprint becomes many rows, so they are dealt out before that
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = variants(prints.select("fp").repartition(tasks, "fp"))
    # a variant with one fingerprint has nothing to compare
    crowd = keyed.groupBy("variant").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # merged at every size: the planner knows no sizes behind an explode, and takes the
    # variants for as few bytes as the fingerprints that they are made of
    shared = keyed.join(crowd.hint("merge"), "variant").select(
        "variant",
        "fp",
        F.ceil(F.col("n") / TILE).cast("int").alias("tiles"),
    )
    tiled = (
        shared.withColumn("tile", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int"))
        .groupBy("variant", "tiles", "tile")
        .agg(F.collect_list("fp").alias("fps"))
    )
    alone = tiled.where("tiles = 1").select(F.col("fps").alias("left"), F.lit(None).cast("array<long>").alias("right"))
    # a crowded variant: each tile goes to every pair that it is part of
    paired = (
        tiled.where("tiles > 1")
        .select("variant", "tile", "fps", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
        .groupBy("variant", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"))
        .agg(
            F.first(F.when(F.col("tile") <= F.col("other"), F.col("fps")), ignorenulls=True).alias("left"),
            F.first(F.when(F.col("tile") > F.col("other"), F.col("fps")), ignorenulls=True).alias("right"),
        )
        .where("left is not null")
        .select("left", "right")
    )
    return alone.unionAll(paired).mapInPandas(_compare(max_bits), LINKS)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id, the smallest
    doc_id reachable by links of up to ``max_bits`` bits, for every row of ``docs``.

    Null and empty texts have the fingerprint zero and are linked like any other. A
    null doc_id is never the smallest unless its component has no other (then
    component_id is null). Repeated rows stay and share a component. Only doc_id and
    text are read; an empty table gives an empty result.

    Texts are read once, for their fingerprints; copies meet as one fingerprint.
    """
    printed = written(docs.select("doc_id", fingerprints(F.col("text"), shingle).alias("fp")), "prints")
    classes = written(printed.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    if max_bits > 2 * HALVES - 1:
        raise ValueError(f"the index finds pairs of up to {2 * HALVES - 1} differing bits")
    group = connected_components(near_links(classes, max_bits))
    grouped = classes.join(group, classes["fp"] == group["id"], "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component")
    )
    smallest = written(grouped.groupBy("component").agg(F.min("first_id").alias("component_id")), "smallest")
    named = written(grouped, "grouped").join(smallest, "component").select("fp", "component_id")
    return printed.join(written(named, "named"), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one_each(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its component, columns as
    they are. A doc_id whose rows fall into several components stays if it is the
    smallest of one; of rows that share a doc_id that stays, one does. Rows with a
    null doc_id cannot be told apart and stay, all of them.
    """
    found = written(near_duplicates(docs, shingle, max_bits), "found").where("doc_id is not null")
    ids = written(
        found.groupBy("doc_id").agg(
            F.max(F.col("doc_id") == F.col("component_id")).alias("stays"), F.count(F.lit(1)).alias("n")
        ),
        "ids",
    )
    # merged at every size: what goes grows with the documents, so it is never broadcast
    kept = docs.join(ids.where("not stays").select("doc_id").hint("merge"), "doc_id", "left_anti")
    repeated = ids.where("stays and n > 1").select("doc_id")
    if not repeated.isEmpty():
        kept = kept.join(repeated, "doc_id", "left_anti").unionByName(
            kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
        )
    return kept.select(*[kept[f"`{c}`"] for c in docs.columns])

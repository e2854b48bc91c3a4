"""Benchmark decontamination by greedy string tiling.

Documents meet benchmark items on shared seeds of ``MIN_MATCH`` words. For each such
pair, tiles (longest common runs of words, found by a running Karp-Rabin hash) are
marked one after the other, longest first, on words that no earlier tile has taken in
either text. An item is in a document if tiles cover ``COVERAGE`` of its words, in
whatever order its passages stand there.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deliverylens.llm.words import alnum_words, utf8

MIN_MATCH = 5
COVERAGE = 0.8
BLOCK_CHARS = 16_000_000  # benchmark text in one broadcast

_BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased runs of letters and digits; punctuation and case never tell texts apart."""
    return [] if text is None else alnum_words(utf8(text.lower()))


def running_hash(ids: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hashes (modulo 2^64) of all windows of ``length`` word numbers."""
    n = len(ids) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    hashes = np.zeros(n, np.uint64)
    for k in range(length):
        hashes = hashes * _BASE + ids[k : k + n].astype(np.uint64)
    return hashes


def common_runs(doc: np.ndarray, item: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """All (length, start in item, start in doc) of runs of ``min_match`` words or more that
    both texts share and that cannot be made longer. Runs grow word by word of the item,
    at all places of the document at once."""
    runs: list[tuple[int, int, int]] = []
    length = np.zeros(len(doc) + 1, np.int32)  # of the run that ends before each place
    for q in range(len(item) + 1):
        same = doc == item[q] if q < len(item) else np.zeros(len(doc), bool)
        ended = length >= min_match
        ended[:-1] &= ~same
        for p in np.flatnonzero(ended).tolist():
            n = int(length[p])
            runs.append((n, q - n, p - n))
        length[1:] = np.where(same, length[:-1] + 1, 0)
        length[0] = 0
    return runs


def tile(doc: np.ndarray, item: np.ndarray, min_match: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Greedy tiles (length, start in item, start in doc), longest first; equal ones
    by their place in the item, then in the document. Places of the document that hold no
    seed, found by the running hash, are never compared."""
    seeded = np.isin(running_hash(doc, min_match), running_hash(item, min_match))
    under = np.zeros(len(doc) + 1, np.int64)
    np.add.at(under, np.flatnonzero(seeded), 1)
    np.add.at(under, np.flatnonzero(seeded) + min_match, -1)
    places = np.flatnonzero(np.cumsum(under[:-1]) > 0)
    waiting: list[tuple[int, int, int]] = []
    # stretches of words under seeds, each on its own
    for part in np.split(places, np.flatnonzero(np.diff(places) > 1) + 1) if len(places) else []:
        first = int(part[0])
        waiting += [(-n, q, first + p) for n, q, p in common_runs(doc[part], item, min_match)]
    heapq.heapify(waiting)
    taken_doc, taken_item = np.zeros(len(doc), bool), np.zeros(len(item), bool)
    tiles = []
    while waiting:
        length, q, p = heapq.heappop(waiting)
        length = -length
        used = taken_doc[p : p + length] | taken_item[q : q + length]
        if not used.any():
            taken_doc[p : p + length] = taken_item[q : q + length] = True
            tiles.append((length, q, p))
            left = np.cumsum(np.append(0, ~taken_item))
            if not (left[min_match:] - left[:-min_match] == min_match).any():
                break  # what is left of the item is too short for another tile
            continue
        # what is left between taken words waits for its turn
        edges = np.flatnonzero(np.diff(np.concatenate(([True], used, [True])).astype(np.int8)))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if b - a >= min_match:
                heapq.heappush(waiting, (a - b, q + a, p + a))
    return tiles


class SeedIndex:
    """Benchmark items of one block, their vocabulary and their seeds."""

    def __init__(self, rows: list[tuple[int, str | None]]):
        texts = [(key, words_of(text)) for key, text in rows]
        # items too short for a seed are looked for as a whole, by their number of words
        self.short: dict[int, dict[tuple[bytes, ...], list]] = {}
        for key, words in texts:
            if 0 < len(words) < MIN_MATCH:
                self.short.setdefault(len(words), {}).setdefault(tuple(words), []).append(key)
        texts = [(key, words) for key, words in texts if len(words) >= MIN_MATCH]
        self.number: dict[bytes, int] = {}
        for _, words in texts:
            for w in words:
                self.number.setdefault(w, len(self.number) + 1)
        self.items = [(key, np.array([self.number[w] for w in words], np.int64)) for key, words in texts]
        hashes = [running_hash(ids, MIN_MATCH) for _, ids in self.items]
        seeds = np.concatenate([*hashes, np.empty(0, np.uint64)])
        owners = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
        order = np.argsort(seeds, kind="stable")
        self.seeds, self.owners = seeds[order], owners[order]

    def found(self, text: str | None) -> list[tuple]:
        """(item_id, coverage, n_tiles, longest, tiles) of the items in one text."""
        get = self.number.get
        words = words_of(text)
        out = self._short_found(words)
        ids = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
        # only windows of benchmark words throughout can be seeds
        known = np.concatenate(([0], np.cumsum(ids > 0)))
        full = np.flatnonzero(known[MIN_MATCH:] - known[:-MIN_MATCH] == MIN_MATCH)
        if not len(full) or not len(self.seeds):
            return out
        hashes = running_hash(ids, MIN_MATCH)[full]
        low, high = np.searchsorted(self.seeds, hashes, "left"), np.searchsorted(self.seeds, hashes, "right")
        hit = hashes[high > low]
        for owner in sorted({o for h in set(hit.tolist()) for o in self._owners(h)}):
            key, item = self.items[owner]
            # words under any shared seed bound what tiles can cover
            under = np.zeros(len(item) + 1, np.int64)
            shared = np.flatnonzero(np.isin(running_hash(item, MIN_MATCH), hit))
            np.add.at(under, shared, 1)
            np.add.at(under, np.minimum(shared + MIN_MATCH, len(item)), -1)
            if (np.cumsum(under[:-1]) > 0).sum() < COVERAGE * len(item):
                continue
            tiles = tile(ids, item)
            covered = sum(length for length, *_ in tiles)
            if covered >= COVERAGE * len(item):
                spans = [(q, p, length) for length, q, p in tiles]
                out.append((key, covered / len(item), len(tiles), max(length for length, *_ in tiles), spans))
        return out

    def _short_found(self, words: list[bytes]) -> list[tuple]:
        """Short items that stand in a text word by word, at their first place."""
        out = []
        for n, items in self.short.items():
            first: dict[tuple[bytes, ...], int] = {}
            for p, run in enumerate(zip(*(words[k:] for k in range(n)))):
                if run in items:
                    first.setdefault(run, p)
            out += [(key, 1.0, 1, n, [(0, p, n)]) for run, p in first.items() for key in items[run]]
        return out

    def _owners(self, seed: int) -> np.ndarray:
        low = np.searchsorted(self.seeds, np.uint64(seed), "left")
        high = np.searchsorted(self.seeds, np.uint64(seed), "right")
        return self.owners[low:high]


FOUND = T.ArrayType(
    T.StructType(
        [
            T.StructField("item_id", T.LongType()),
            T.StructField("coverage", T.DoubleType()),
            T.StructField("n_tiles", T.LongType()),
            T.StructField("longest", T.LongType()),
            T.StructField(
                "tiles",
                T.ArrayType(
                    T.StructType(
                        [
                            T.StructField("item_start", T.LongType()),
                            T.StructField("doc_start", T.LongType()),
                            T.StructField("n_words", T.LongType()),
                        ]
                    )
                ),
            ),
        ]
    )
)


def found_items(block: DataFrame, text: Column) -> Column:
    """What of a block of benchmark items stands in each text, as an array."""
    rows = [tuple(r) for r in block.select("item_id", "text").collect()]
    shared = block.sparkSession.sparkContext.broadcast(SeedIndex(rows))

    @F.pandas_udf(FOUND)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = shared.value
        for texts in batches:
            yield pd.Series([index.found(t) for t in texts], dtype=object)

    return found(text)


def benchmark_blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> list[DataFrame]:
    """The benchmark in blocks of about ``block_chars`` characters, dealt by item."""
    size = benchmark.agg(F.sum(F.length("text"))).first()[0] or 0
    n = 1 + size // block_chars
    if n == 1:
        return [benchmark]
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    return [benchmark.where(part == k) for k in range(n)]


def contaminated(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row for each document and benchmark item that it holds: doc_id, item_id,
    coverage (share of the item's words under tiles), n_tiles, longest, tiles.

    Null and empty texts hold nothing, and nothing holds an item without words. An item
    of fewer than ``MIN_MATCH`` words is held where all its words stand together. Repeated rows of either table give repeated rows here; null ids stay
    null. No other column is read. Either table empty: an empty result. Each block
    of the benchmark is one pass over the documents.
    """
    passes = [
        docs.select("doc_id", F.explode(found_items(block, F.col("text"))).alias("hit")).select("doc_id", "hit.*")
        for block in benchmark_blocks(benchmark, block_chars)
    ]
    return reduce(DataFrame.unionAll, passes)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, columns as they are."""
    for block in benchmark_blocks(benchmark, block_chars):
        docs = docs.where(F.size(found_items(block, F.col("text"))) == 0)
    return docs

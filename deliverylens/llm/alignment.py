"""Alignment of two tokenizers' tokens by merge-path partitioning.

Two tokenizations of the same bytes are two ascending lists of token ends. Merged, each
step from one end to the next is a stretch of bytes that lies in just one token of either
side, so steps are the overlaps, and ends that both sides share cut the tokens into groups.

The two lists of a slice of texts are merged in pieces of equal work: the diagonals of the
merge are cut at every so many ends, a binary search on each finds how many ends of either
side lie before it, and the pieces between are merged on their own, however long the text
is that they are part of. A piece emits its overlaps and shared ends; an end that meets its
like across a border is stitched by the piece behind the border.

How many documents hold a linked pair is counted corpus-wide. A slice gives each of its
pairs once, so a pair that all documents hold is a row a slice, not a row a document.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deliverylens.llm.bpe import byte_letters
from deliverylens.llm.remember import Remembered
from deliverylens.llm.storage import small_batches, written
from deliverylens.llm.tokenstore import PieceEncoder, gather

PIECE_ENDS = 1 << 16  # of both sides, that are merged in one go
SLICE_CHARS = 2_000_000  # of text whose pairs are gathered before they are shuffled, whole texts
KEPT_WORDS = 60_000  # that a worker remembers of B
KEPT_PIECES = 300_000  # and of A
ID_BITS = 20  # a pair of ids in one number
MARK = "▁"  # Fixed value: how pieces write a space


def diagonals(a: np.ndarray, b: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """How many of the ascending ``a`` and ``b`` lie before every ``step``-th place of their
    merge (equal ones: of ``a`` first), by a binary search on each diagonal at once."""
    total = len(a) + len(b)
    places = np.append(np.arange(0, total, step), total)
    low, high = np.maximum(places - len(b), 0), np.minimum(places, len(a))
    while (low < high).any():
        middle = (low + high) // 2
        # a[middle] stands before b[place - middle - 1]: more of a is needed
        more = (low < high) & (a[np.minimum(middle, len(a) - 1)] <= b[np.clip(places - middle - 1, 0, len(b) - 1)])
        low, high = np.where(more, middle + 1, low), np.where(more | (low >= high), high, middle)
    return low, places - low


def merge_piece(a: np.ndarray, b: np.ndarray, i: tuple[int, int], j: tuple[int, int]):
    """Overlaps (numbers of tokens of both sides) and shared ends (numbers of the tokens
    that end there) of one piece of the merge, ``a[i]`` and ``b[j]``."""
    ends = np.concatenate((a[i[0] : i[1]], b[j[0] : j[1]]))
    order = np.argsort(ends, kind="stable")  # two ascending runs are merged, of equal ones a first
    ends, of_a = ends[order], order < i[1] - i[0]
    at_a = i[0] + np.cumsum(of_a) - of_a  # tokens of a that ended before
    at_b = j[0] + np.cumsum(~of_a) - ~of_a
    before = max(a[i[0] - 1] if i[0] else 0, b[j[0] - 1] if j[0] else 0)
    new = np.diff(ends, prepend=before) > 0
    return at_a[new], at_b[new], at_a[~new] - 1, at_b[~new]


def overlaps(a: np.ndarray, b: np.ndarray, step: int = PIECE_ENDS):
    """All overlaps and shared ends of two ascending lists of token ends, piece by piece."""
    i, j = diagonals(a, b, step)
    pieces = [merge_piece(a, b, (i[k], i[k + 1]), (j[k], j[k + 1])) for k in range(len(i) - 1)]
    if not pieces:
        return (np.empty(0, np.int64),) * 4
    return tuple(np.concatenate(part) for part in zip(*pieces, strict=True))


class TokenTable:
    """The bytes of every token of a vocabulary, end to end."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def join(self, ids: np.ndarray) -> np.ndarray:
        return gather(self.data, self.sizes, ids)[0]


class WordPieces:
    """Encodes texts with a sentencepiece model, each distinct word only once where no piece
    reaches over the space between words."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        self.by_word = not any(MARK in p.lstrip(MARK) for p in pieces)
        self.known = Remembered(KEPT_WORDS)

    def token_bytes(self) -> list[bytes]:
        n = self.model.get_piece_size()
        return [
            bytes([int(self.model.id_to_piece(k)[3:5], 16)])
            if self.model.is_byte(k)
            else self.model.id_to_piece(k).replace(MARK, " ").encode()
            for k in range(n)
        ]

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(ids, np.uint32).tobytes() for ids in self.model.encode(texts, num_threads=1)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, the space put before it by the model included."""
        cut = [t.split(" ") if self.by_word else [""] for t in texts]
        odd = [k for k, words in enumerate(cut) if "" in words or MARK in texts[k]]
        out = dict(zip(odd, self._whole([texts[k] for k in odd]), strict=True))
        new = self.known.missing(set().union(*(words for k, words in enumerate(cut) if k not in out)))
        self.known.update(zip(new, self._whole(new), strict=True))
        ids_of = self.known.__getitem__
        found = [out[k] if k in out else b"".join(map(ids_of, words)) for k, words in enumerate(cut)]
        self.known.trim()
        return [np.frombuffer(ids, np.uint32) for ids in found]


class Aligner:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        self.a = PieceEncoder(path_a, plain_specials=True, kept=KEPT_PIECES)
        self.b = WordPieces(path_b)
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        byte = {c: k for k, c in enumerate(byte_letters())}
        named = {**spec["model"]["vocab"], **{t["content"]: t["id"] for t in spec["added_tokens"]}}
        tokens = [b""] * (max(named.values()) + 1)
        for token, k in named.items():
            tokens[k] = bytes(byte[c] for c in token)
        self.bytes_a, self.bytes_b = TokenTable(tokens), TokenTable(self.b.token_bytes())
        numbers = [str(k).encode() for k in range(max(len(tokens), len(self.bytes_b.sizes)))]
        # an id with what may stand behind it in the digest's text
        self.digits = TokenTable([n + end for end in (b",", b"|", b";") for n in numbers])
        self.n_numbers = len(numbers)

    def group_text(self, ids_a: np.ndarray, ids_b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``a1,a2|b1;a3|b2;`` of groups that end before tokens ``cut_a`` and ``cut_b``, and where
        in it each group ends."""
        in_a, in_b = np.diff(cut_a, prepend=0), np.diff(cut_b, prepend=0)
        place_a = np.arange(len(ids_a)) + np.repeat(cut_b - in_b, in_a)
        place_b = np.arange(len(ids_b)) + np.repeat(cut_a, in_b)
        tokens = np.empty(len(ids_a) + len(ids_b), np.int64)
        tokens[place_a], tokens[place_b] = ids_a, ids_b
        tokens[place_a[cut_a - 1]] += self.n_numbers
        tokens[place_b[cut_b - 1]] += 2 * self.n_numbers
        text, sizes = gather(self.digits.data, self.digits.sizes, tokens)
        return text, np.cumsum(sizes)[place_b[cut_b - 1]]

    def align(self, texts: list[str]) -> tuple[list[tuple], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For a slice of texts: (n_a, n_b, n_groups, n_links, groups_sha256) of each; the
        distinct pairs of linked ids; and for each text in turn the numbers of its distinct
        pairs, how often it has each, and how many it has."""
        spaced = [" " + t for t in texts]
        all_a, all_b = self.a.encode(spaced), self.b.encode(texts)
        kept = []
        for k, (text, a, b) in enumerate(zip(spaced, all_a, all_b, strict=True)):
            raw = np.frombuffer(text.encode(), np.uint8)
            if len(raw) > 1 and all(np.array_equal(t.join(x), raw) for t, x in ((self.bytes_a, a), (self.bytes_b, b))):
                kept.append(k)
        docs: list[tuple] = [(0, 0, 0, 0, "")] * len(texts)
        sizes = np.zeros(len(texts), np.int32)
        empty = np.empty(0, np.int64)
        if not kept:
            return docs, empty, empty.astype(np.int32), empty.astype(np.int32), sizes
        ids_a, ids_b = np.concatenate([all_a[k] for k in kept]), np.concatenate([all_b[k] for k in kept])
        # ends count on through the slice; the end of each text is one of both sides
        link_a, link_b, end_a, end_b = overlaps(
            np.cumsum(self.bytes_a.sizes[ids_a]), np.cumsum(self.bytes_b.sizes[ids_b])
        )
        n_a, n_b = (np.array([len(x[k]) for k in kept]) for x in (all_a, all_b))
        upto_a = np.cumsum(n_a)
        text, group_ends = self.group_text(ids_a, ids_b, end_a + 1, end_b + 1)
        last_group = np.searchsorted(end_a, upto_a - 1)  # of each text
        text_ends = group_ends[last_group]
        doc_of_link = np.searchsorted(upto_a, link_a, side="right")
        coded = pa.array((ids_a[link_a].astype(np.int64) << ID_BITS) | ids_b[link_b]).dictionary_encode()
        pairs = coded.dictionary.to_numpy()
        found, times = np.unique(doc_of_link * len(pairs) + coded.indices.to_numpy(), return_counts=True)
        n_links = np.bincount(doc_of_link, minlength=len(kept))
        sizes[kept] = np.bincount(found // len(pairs), minlength=len(kept))
        groups = np.diff(last_group, prepend=-1)
        start = 0
        for at, k in enumerate(kept):
            stop = int(text_ends[at])
            digest = hashlib.sha256(text[start : stop - 1].data).hexdigest()  # without the last mark
            docs[k] = (int(n_a[at]), int(n_b[at]), int(groups[at]), int(n_links[at]), digest)
            start = stop
        return docs, pairs, (found % len(pairs)).astype(np.int32), times.astype(np.int32), sizes


@cache
def aligner_of(path_a: str, path_b: str) -> Aligner:
    """One aligner a worker process, whatever tasks it runs."""
    return Aligner(path_a, path_b)


COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def align_slices(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Slices of the documents, each with its rows, its distinct pairs, in how many rows each
    occurs, and which pairs each row has (packed 32-bit integers)."""
    rows = docs.select("doc_id", "text")
    whole = T.ArrayType(T.LongType())
    schema = T.StructType(
        [
            T.StructField("slice", T.StringType()),
            T.StructField("doc_id", T.ArrayType(rows.schema["doc_id"].dataType)),
            *[T.StructField(c, whole) for c in COUNTS],
            T.StructField("groups_sha256", T.ArrayType(T.StringType())),
            T.StructField("pairs", whole),
            T.StructField("holders", whole),
            *[T.StructField(c, T.BinaryType()) for c in ("numbers", "times", "sizes")],
        ]
    )

    def one(values, kind=None) -> pa.Array:
        return pa.ListArray.from_arrays([0, len(values)], values if isinstance(values, pa.Array) else pa.array(values, kind))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = aligner_of(path_a, path_b)
        for part in small_batches(batches, SLICE_CHARS):
            found, pairs, numbers, times, sizes = aligner.align([t or "" for t in part["text"].to_pylist()])
            *counts, digests = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([uuid.uuid4().hex]),
                    one(part["doc_id"]),
                    *[one(c, pa.int64()) for c in counts],
                    one(digests, pa.string()),
                    one(pairs, pa.int64()),
                    one(np.bincount(numbers, minlength=len(pairs)), pa.int64()),
                    *[pa.array([x.tobytes()], pa.binary()) for x in (numbers, times, sizes)],
                ],
                names=schema.names,
            )

    return rows.mapInArrow(align, schema)


def pair_counts(slices: DataFrame) -> DataFrame:
    """pair, id_a, id_b, n (documents that hold the pair) and best (whether no pair of id_a is
    held by more). An id has at most as many pairs as the other vocabulary has ids, and a
    window holds no more."""
    summed = (
        slices.select(F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("holders").alias("n"))))
        .groupBy("pair")
        .agg(F.sum("n").alias("n"))
        .select(
            "pair",
            F.shiftright("pair", ID_BITS).alias("id_a"),
            F.col("pair").bitwiseAND(F.lit((1 << ID_BITS) - 1)).alias("id_b"),
            "n",
        )
    )
    return summed.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("id_a")))


def _sums(numbers: bytes, times: bytes, sizes: bytes, n: np.ndarray, best: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of a slice, its links of a best pair, and the counts of its links."""
    which, often = np.frombuffer(numbers, np.int32), np.frombuffer(times, np.int32).astype(np.int64)
    ends = np.concatenate(([0], np.cumsum(np.frombuffer(sizes, np.int32))))
    total = lambda x: np.diff(np.concatenate(([0], np.cumsum(x)))[ends])
    return total(often * best[which]), total(often * n[which])


def align_tokens(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 for every row
    of ``docs``, from a tokenizers file (A, on a space and the text) and a sentencepiece
    model (B, which adds the space). Every machine has both files.

    Null and empty texts, and texts whose tokens do not join to their bytes, have no tokens:
    zeros and an empty digest. Repeated rows and null ids stay, each row a document of its
    own. Other columns are not read, an empty table gives an empty result.

    Tokens are made once; slices of about ``SLICE_CHARS`` are written, their pairs counted
    and joined back to the slices, whose sums are then taken.
    """
    slices = written(align_slices(docs, path_a, path_b), "slices")
    counts = written(pair_counts(slices).select("pair", "n", "best"), "pairs")
    found = (
        slices.select("slice", F.posexplode("pairs").alias("at", "pair"))
        .join(counts, "pair")
        .groupBy("slice")
        .agg(F.sort_array(F.collect_list(F.struct("at", "n", "best"))).alias("found"))
    )
    whole = T.ArrayType(T.LongType())
    kept = ["doc_id", *COUNTS, "groups_sha256"]
    schema = T.StructType(
        [*[slices.schema[c] for c in kept], T.StructField("n_best", whole), T.StructField("count_sum", whole)]
    )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                n, best = (np.asarray(row[c].flatten().to_numpy(zero_copy_only=False), np.int64) for c in ("n", "best"))
                sums = _sums(*(row[c][0].as_py() for c in ("numbers", "times", "sizes")), n, best)
                ends = [0, len(sums[0])]
                yield pa.RecordBatch.from_arrays(
                    [*[row[c] for c in kept], *[pa.ListArray.from_arrays(ends, pa.array(s, pa.int64())) for s in sums]],
                    names=schema.names,
                )

    joined = slices.join(found, "slice", "left").select(
        *kept, "numbers", "times", "sizes", F.col("found.n").alias("n"), F.col("found.best").alias("best")
    )
    return joined.mapInArrow(finish, schema).select(F.inline(F.arrays_zip(*schema.names)))

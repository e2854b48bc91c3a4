"""Token-id files of shuffled bit planes.

Ids go into blocks of a fixed number. A block is transposed into planes, the first
bits of all its ids, the second bits, and so on (or bytes), each plane compressed on
its own with zstandard. A file holds blocks one after the other, then an index of its
documents and chunks, then a footer that says where the index is:

    plane plane ... | index | index length, 8 bytes | magic, 4 bytes

Files of a set follow each other in order of their documents' ids. A table beside
them, the manifest, names the files that count and how many ids stand before each, so
files of lost or repeated task attempts are never read.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import accumulate, chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from deliverylens.llm.storage import fresh_folder, open_folder, small_batches

MAGIC = b"BPT1"
BLOCK_IDS = 65_536
KEPT_PIECES = 1_000_000  # pieces of text whose ids a worker remembers
KEPT_BYTES = 64 << 20
SLICE_CHARS = 6_000_000  # of text held at once, whole texts
FILE_BYTES = 64 << 20  # of text in one file, about

# elsewhere than in texts with these, the tokenizer never joins what _PIECE tells apart:
# a space stays with what follows it, of other white space the last character stands alone
_WHOLE = re.compile("[\x1c-\x1f]")
_PIECE = re.compile(r" ?\S+|\s+(?!\S)|\s")
# nor a run of letters with what follows it, if that is surely no letter
_LETTERS = re.compile(
    "( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([\\x21-\\x40\\x5b-\\x60\\x7b-\\x7e].*)", re.S
)
# the same of a piece without its space, and a space that does not begin a piece, for RE2
_LETTERS_AND_REST = (
    r"^(?P<word>[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}]+)(?P<rest>[\x{21}-\x{40}\x{5b}-\x{60}\x{7b}-\x{7e}](?s:.*))$"
)
_ODD_SPACE = (
    r" (?:$|[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}])|[\x{1c}-\x{1f}]"
)


def gather(values: np.ndarray, sizes: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``values`` (of these sizes, one after the other) in the order of their
    numbers, and the sizes in that order."""
    lengths = sizes[numbers]
    # what a slice of texts holds is far below 2^31
    shift = (np.cumsum(sizes) - sizes)[numbers] - (np.cumsum(lengths) - lengths)
    places = np.repeat(shift.astype(np.int32), lengths)
    places += np.arange(len(places), dtype=np.int32)
    return values[places], lengths


class PieceEncoder:
    """Encodes texts with a byte-level tokenizer, each distinct piece only once.

    What pieces encode to is remembered in columns: the pieces, how many ids each has, and
    the ids, one after the other. With ``plain_specials``, special tokens that stand in a
    text are text like any other.
    """

    def __init__(self, path: str, plain_specials: bool = False, kept: int = KEPT_PIECES):
        # a task has its own core; threads of the library would take those of others
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = plain_specials
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [] if plain_specials else [t.content for t in added]
        self.odd = "|".join([_ODD_SPACE, *(re.escape(s) for s in self.special)])
        self.kept = kept
        self._forget()

    def _forget(self) -> None:
        self.pieces = pa.array([], pa.large_string())
        self.sizes, self.values = np.empty(0, np.int64), np.empty(0, np.uint32)

    def _parts(self, text: str) -> list[str]:
        """What of a text is encoded on its own."""
        if _WHOLE.search(text) is not None or any(s in text for s in self.special):
            return [text]
        out: list[str] = []
        for small in _PIECE.findall(text):
            cut = _LETTERS.fullmatch(small)
            out += cut.groups() if cut else (small,)
        return out

    def _numbers(self, pieces: pa.Array) -> np.ndarray:
        """The places of the pieces in memory, where all of them are afterwards."""
        coded = pieces.dictionary_encode()
        if len(self.pieces) > self.kept or self.pieces.nbytes > KEPT_BYTES:
            self._forget()
        place = pc.index_in(coded.dictionary, self.pieces)
        new = coded.dictionary.filter(place.is_null())
        found = [e.ids for e in self.tokenizer.encode_batch_fast(new.to_pylist(), add_special_tokens=False)]
        places = np.empty(len(place), np.int64)
        absent = place.is_null().to_numpy(zero_copy_only=False)
        places[~absent] = place.drop_null().to_numpy()
        places[absent] = len(self.pieces) + np.arange(len(new))
        self.pieces = pa.concat_arrays([self.pieces, new])
        self.sizes = np.append(self.sizes, np.fromiter(map(len, found), np.int64, len(found)))
        self.values = np.append(self.values, np.fromiter(chain.from_iterable(found), np.uint32))
        return places[coded.indices.to_numpy()]

    def encode(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        """The ids of each text, null as empty. Pieces are told apart and numbered in bulk; only
        distinct words and what stands behind them are looked at."""
        rows = pc.fill_null(pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string()), "")
        if not len(rows):
            return []
        plain = pc.invert(pc.match_substring_regex(rows, self.odd))
        cut = pc.split_pattern(rows.filter(plain), " ")
        # texts with odd spaces are cut up one by one
        parts = [self._parts(t) for t in rows.filter(pc.invert(plain)).to_pylist()]
        plain = plain.to_numpy(zero_copy_only=False)
        sizes = pc.list_value_length(cut).to_numpy(zero_copy_only=False).astype(np.int64)
        firsts = np.cumsum(sizes) - sizes
        coded = cut.flatten().dictionary_encode()
        split = pc.extract_regex(coded.dictionary, _LETTERS_AND_REST)
        word = pc.coalesce(pc.struct_field(split, "word"), coded.dictionary).dictionary_encode()
        rest = pc.coalesce(pc.struct_field(split, "rest"), "").dictionary_encode()
        # no space stands before the first piece of a text
        heads = pc.list_element(cut, 0)
        places = self._numbers(
            pa.concat_arrays(
                [
                    pc.binary_join_element_wise("", word.dictionary.cast(pa.string()), " ").cast(pa.large_string()),
                    rest.dictionary,
                    heads,
                    pa.array(list(chain.from_iterable(parts)), pa.large_string()),
                ]
            )
        )
        ends = np.cumsum([len(word.dictionary), len(rest.dictionary), len(heads)])
        of_word, of_rest, of_head, of_part = np.split(places, ends)
        # each distinct piece from its two parts; heads and parts as they are
        both = np.stack((of_word[word.indices.to_numpy()], of_rest[rest.indices.to_numpy()]), axis=1).reshape(-1)
        values, lengths = gather(self.values, self.sizes, np.concatenate((both, of_head, of_part)))
        n_pieces = len(both) // 2
        lengths = np.append(lengths[: 2 * n_pieces].reshape(-1, 2).sum(axis=1), lengths[2 * n_pieces :])
        # all pieces of all texts
        counts = np.empty(len(rows), np.int64)
        counts[plain], counts[~plain] = sizes, list(map(len, parts))
        numbers = np.empty(counts.sum(), np.int64)
        from_plain = np.repeat(plain, counts)
        of_plain = coded.indices.to_numpy().astype(np.int64)
        of_plain[firsts] = n_pieces + np.arange(len(heads))
        numbers[from_plain] = of_plain
        numbers[~from_plain] = n_pieces + len(heads) + np.arange(len(of_part))
        ids, lengths = gather(values, lengths, numbers)
        upto = np.append(0, np.cumsum(lengths))[np.cumsum(counts)]
        return np.split(ids, upto[:-1])


@cache
def piece_encoder(path: str) -> PieceEncoder:
    """One encoder a worker process, whatever tasks it runs."""
    return PieceEncoder(path)


def shuffle_planes(ids: np.ndarray, unit: str, compressor: zstandard.ZstdCompressor) -> list[bytes]:
    """The compressed planes of one block, the lowest first, as many as its largest id needs."""
    if unit == "byte":
        rows = ids.astype("<u4").view(np.uint8).reshape(-1, 4).T
        planes = [rows[k].tobytes() for k in range((int(ids.max()).bit_length() + 7) // 8)]
    else:
        width = int(ids.max()).bit_length()
        planes = [np.packbits((ids >> k) & 1).tobytes() for k in range(width)]
    return [compressor.compress(p) for p in planes]


def gather_planes(planes: list[bytes], n: int, unit: str) -> np.ndarray:
    """The ids of one block from its uncompressed planes."""
    ids = np.zeros(n, np.uint32)
    for k, plane in enumerate(planes):
        raw = np.frombuffer(plane, np.uint8)
        if unit == "byte":
            ids |= raw.astype(np.uint32) << np.uint32(8 * k)
        else:
            ids |= np.unpackbits(raw, count=n).astype(np.uint32) << np.uint32(k)
    return ids


class PlaneWriter:
    """Writes one file to an open stream, block by block."""

    def __init__(self, sink, unit: str = "byte", block_ids: int = BLOCK_IDS, level: int = 3):
        self.sink, self.unit, self.block_ids = sink, unit, block_ids
        self.compressor = zstandard.ZstdCompressor(level=level)
        self.chunks: list[tuple[int, list[int]]] = []  # ids, bytes of each plane
        self.docs: list[tuple[int | None, int]] = []
        self.held: list[np.ndarray] = []
        self.n_held = self.n_ids = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id, len(ids)))
        self.n_ids += len(ids)
        while len(ids):
            take = ids[: self.block_ids - self.n_held]
            self.held.append(take)
            self.n_held += len(take)
            ids = ids[len(take) :]
            if self.n_held == self.block_ids:
                self._flush()

    def _flush(self) -> None:
        planes = shuffle_planes(np.concatenate(self.held), self.unit, self.compressor)
        for p in planes:
            self.sink.write(p)
        self.chunks.append((self.n_held, [len(p) for p in planes]))
        self.held, self.n_held = [], 0

    def close(self) -> None:
        if self.n_held:
            self._flush()
        index = {"unit": self.unit, "chunks": self.chunks, "docs": self.docs}
        packed = self.compressor.compress(json.dumps(index, separators=(",", ":")).encode())
        self.sink.write(packed + struct.pack("<Q", len(packed)) + MAGIC)


def read_index(source, size: int) -> dict:
    """The index of a file of ``size`` bytes."""
    source.seek(size - 12)
    length, magic = struct.unpack("<Q4s", source.read(12))
    if magic != MAGIC:
        raise ValueError("no token file: its end mark is missing")
    source.seek(size - 12 - length)
    return json.loads(zstandard.ZstdDecompressor().decompress(source.read(length)))


def read_documents(source, size: int) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(doc_id, start in the file, ids) of each document, a block in memory at a time
    beside the document at hand."""
    index = read_index(source, size)
    unpack = zstandard.ZstdDecompressor()
    source.seek(0)

    def blocks() -> Iterator[np.ndarray]:
        for n, lengths in index["chunks"]:
            yield gather_planes([unpack.decompress(source.read(k)) for k in lengths], n, index["unit"])

    waiting, block, at, start = blocks(), np.empty(0, np.uint32), 0, 0
    for doc_id, n in index["docs"]:
        parts, left = [], n
        while left:
            if at == len(block):
                block, at = next(waiting), 0
            parts.append(block[at : at + left])
            at += len(parts[-1])
            left -= len(parts[-1])
        yield doc_id, start, np.concatenate(parts) if parts else np.empty(0, np.uint32)
        start += n


WRITTEN = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("file", T.StringType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("n_docs", T.LongType()),
        T.StructField("n_ids", T.LongType()),
    ]
)
WRITTEN_ARROW = pa.schema(
    [("part", pa.int32()), ("file", pa.string()), ("bytes", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]
)


def write_token_files(
    docs: DataFrame, folder: str, path: str, end_id: int, unit: str = "byte", file_bytes: int = FILE_BYTES
) -> DataFrame:
    """Encode all texts and write their ids, each document's ended by ``end_id``, in
    ascending order of doc_id (null first; equal ids by a hash of their text). Returns the
    manifest: part, file, bytes, n_docs, n_ids, first_id (ids in all files before).

    ``path`` names a tokenizers file that every machine has. Null and empty texts give
    the end id alone. An empty table writes no file. The driver holds one row a file.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # several files a core keep tasks short on small inputs, large inputs go by size
    n_files = max(1 + size // file_bytes, spark.sparkContext.defaultParallelism)
    ordered = rows.repartitionByRange(n_files, "doc_id", F.xxhash64("text")).sortWithinPartitions(
        "doc_id", F.xxhash64("text"), "text"
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_encoder(path)
        name = f"part-{uuid.uuid4().hex}.bpt"
        system, top = open_folder(folder)
        system.create_dir(top, recursive=True)
        end = np.uint32(end_id)
        with system.open_output_stream(f"{top}/{name}") as sink:
            writer = PlaneWriter(sink, unit)
            for part in small_batches(batches, SLICE_CHARS):
                ids = encoder.encode(part["text"])
                for doc_id, own in zip(part["doc_id"].to_pylist(), ids, strict=True):
                    writer.add(doc_id, np.append(own, end))
            writer.close()
            length = sink.tell()
        if writer.docs:
            row = (TaskContext.get().partitionId(), name, length, len(writer.docs), writer.n_ids)
            yield pa.RecordBatch.from_pylist([dict(zip(WRITTEN.names, row, strict=True))], WRITTEN_ARROW)
        else:
            system.delete_file(f"{top}/{name}")

    done = sorted(tuple(r) for r in ordered.mapInArrow(write, WRITTEN).collect())
    before = accumulate((n for *_, n in done), initial=0)
    manifest = spark.createDataFrame(
        [(k, *row[1:], first) for k, (row, first) in enumerate(zip(done, before, strict=False))],
        T.StructType([*WRITTEN.fields, T.StructField("first_id", T.LongType())]),
    )
    manifest.coalesce(1).write.parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/manifest")


READ = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
)
READ_BYTES = 4 << 20  # of ids in one batch of rows


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before) and ids (little-endian unsigned
    32-bit integers) of every document of a set of files."""
    manifest = read_manifest(spark, folder)
    n_files = max(1, manifest.count())

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, top = open_folder(folder)
        for batch in batches:
            for name, size, first in zip(batch["file"], batch["bytes"], batch["first_id"], strict=True):
                rows: list[tuple] = []
                held = 0
                with system.open_input_file(f"{top}/{name}") as source:
                    for doc_id, start, ids in read_documents(source, size):
                        rows.append((doc_id, first + start, ids.astype("<u4").tobytes()))
                        held += len(rows[-1][2])
                        if held >= READ_BYTES:
                            yield _frame(rows)
                            rows, held = [], 0
                yield _frame(rows)

    return manifest.repartitionByRange(n_files, "part").mapInPandas(read, READ)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=READ.names)
    out["doc_id"] = out["doc_id"].astype("Int64")
    return out


def token_digest(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of documents read from token files."""
    return tokens.select(
        "doc_id",
        "start",
        F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def round_trip(docs: DataFrame, path: str, end_id: int, unit: str = "byte") -> DataFrame:
    """Write ``docs`` to token files in the shared folder and read them back."""
    folder = fresh_folder(docs.sparkSession, "tokens")
    write_token_files(docs, folder, path, end_id, unit)
    return read_token_files(docs.sparkSession, folder)


def crc32_of(ids: list[int]) -> int:
    """The checksum that ``token_digest`` gives for these ids."""
    return zlib.crc32(np.array(ids, "<u4").tobytes())

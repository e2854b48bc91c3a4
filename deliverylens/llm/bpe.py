"""BPE encoding and decoding by prefix-sharing trie traversal.

Of BPE, the encoding of a prefix that ends in token t is the encoding of what stands
before t, then t. So one state a prefix, its last token, is enough, and words that
share a prefix share its states. New words of a batch go into a trie; a depth-first
walk sets the last token of each node from those of the nodes above it; a word's
encoding is read back along its own last tokens.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from deliverylens.llm.remember import Remembered
from deliverylens.llm.storage import small_batches

# Fixed value: how the word vocabulary's tokenizer cuts a normalised text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"
KEPT_WORDS = 300_000  # chunks that a worker remembers, twice as many at most
KEPT_PAIRS = 400_000  # and pairs of tokens
ID_BITS = 20

# texts of other characters are normalised and cut by the tokenizer's own code
_PLAIN = regex.compile("[\\t-\\r\\x20-\\x7e\\u00a0-\\u012f\\u0132-\\u024f\\u2010-\\u2027]*")
SLICE_CHARS = 1_000_000  # of text whose words are held at once, whole texts


@cache
def byte_letters() -> list[str]:
    """The printable letter of each byte in byte-level vocabularies: bytes that print
    stand for themselves, the others for the letters from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class TrieEncoder:
    """Encodes words with the vocabulary and merges of a tokenizers file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.vocab: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in {**self.vocab, **self.special}.items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.rank = {(a, b): k for k, (a, b) in enumerate(merges)}
        self.made: dict[str, tuple[str, str]] = {}  # the parts that a token is first made of
        self.made_at: dict[str, int] = {}
        for k, (a, b) in enumerate(merges):
            if a + b not in self.made:
                self.made[a + b], self.made_at[a + b] = (a, b), k
        self.longest = max(len(t.removesuffix(WORD_END)) for t in self.vocab)
        self.known = Remembered(KEPT_WORDS)  # chunks and words, with their ids
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.split = regex.compile(SPLIT)
        self.letter = byte_letters()
        self.byte = {c: b for b, c in enumerate(self.letter)}
        self.sizes = {i: len(t.removesuffix(WORD_END)) for t, i in self.vocab.items()}
        self.fits: dict[int, bool] = {}

    def follows(self, left: str, right: str) -> bool:
        """Whether BPE keeps ``left`` and ``right`` apart where they meet.

        The merges that made them are undone, the latest first (of equal ones the
        right one, as BPE merges from the left). Each time, the two parts at the
        border must not have had a merge of their own due before the one undone.
        """
        due = len(self.rank)
        while True:
            crossing = self.rank.get((left, right))
            if crossing is not None and crossing < due:
                return False
            at_left, at_right = self.made_at.get(left, -1), self.made_at.get(right, -1)
            if at_left < 0 and at_right < 0:
                return True
            if at_left > at_right:
                due, left = at_left, self.made[left][1]
            else:
                due, right = at_right + 1, self.made[right][0]

    def walk(self, words: Iterable[str]) -> Iterator[tuple[str, list[int]]]:
        """Each word, in letters of its bytes, with its ids. In sorted order a word
        branches off the path of the one before where the two begin to differ, so the
        path at hand is all of the trie that the walk has to hold."""
        get, fits, longest, sizes, name = self.vocab.get, self.fits, self.longest, self.sizes, self.token
        fitting = fits.get
        last = [-1]  # by depth: the last token of the path so far
        before = ""
        for word in sorted(words):
            size = len(word)
            # the last letter of a word is another node than the same letter within one
            shared = min(len(last), size) - 1
            while word[:shared] != before[:shared]:
                shared -= 1
            del last[shared + 1 :]
            ended = word + WORD_END
            for depth in range(shared + 1, size + 1):
                stop = depth if depth < size else len(ended)
                for start in range(depth - longest if depth > longest else 0, depth):
                    token = get(ended[start:stop])
                    if token is not None:
                        if not start:
                            break
                        pair = last[start] << ID_BITS | token
                        fit = fitting(pair)
                        if fit is None:
                            fit = fits[pair] = self.follows(name[last[start]], name[token])
                        if fit:
                            break
                else:
                    raise ValueError(f"no token ends {word[:depth]!r}")
                last.append(token)
            token = last.pop()
            ids = [token]
            depth = size - sizes[token]
            while depth:
                token = last[depth]
                ids.append(token)
                depth -= sizes[token]
            ids.reverse()
            yield word, ids
            before = word
        if len(fits) > KEPT_PAIRS:
            fits.clear()

    def chunks(self, text: str) -> list[str]:
        """What stands between white space in a normalised text; no word crosses it."""
        if _PLAIN.fullmatch(text):
            return text.lower().split()
        pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(text))
        return [bytes(map(self.byte.__getitem__, piece)).decode() for piece, _ in pieces]

    def pieces(self, text: str) -> Iterator[tuple[bytes, list[str]]]:
        """The text as pairs of a special token's ids, if one stands there, and the
        chunks behind it."""
        if "<|" not in text:
            yield b"", self.chunks(text)
            return
        # odd ones are what the pattern caught
        cut = ["", *self.specials.split(text)]
        for special, plain in zip(cut[::2], cut[1::2], strict=True):
            yield np.array([self.special[special]] if special else [], np.int32).tobytes(), self.chunks(plain)

    def encode_slice(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text; new words of all of them share one trie."""
        known, letter = self.known, self.letter
        cut = [list(self.pieces(text)) for text in texts]
        missing = known.missing(set().union(*(chunks for pieces in cut for _, chunks in pieces)))
        new = {chunk: self.split.findall(chunk) for chunk in missing}
        raw = {"".join([letter[b] for b in w.encode()]): w for w in known.missing(set().union(*new.values()))}
        for word, ids in self.walk(raw):
            known[raw[word]] = array("i", ids).tobytes()
        for chunk, words in new.items():
            if chunk not in known:
                known[chunk] = b"".join([known[w] for w in words])
        ids_of = known.__getitem__
        out = [
            np.frombuffer(b"".join([ids + b"".join(map(ids_of, chunks)) for ids, chunks in pieces]), np.int32)
            for pieces in cut
        ]
        known.trim()
        return out

    def encode(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text, null as empty, a slice of texts at a time."""
        held: list[str] = []
        size = 0
        for text in texts:
            held.append(text or "")
            size += len(held[-1])
            if size >= SLICE_CHARS:
                yield from self.encode_slice(held)
                held, size = [], 0
        yield from self.encode_slice(held)

    def decode(self, ids: Iterable[int]) -> str:
        """Tokens joined by spaces: the file names no decoder, so word ends stay."""
        return " ".join(map(self.token.__getitem__, ids))


@cache
def encoder_of(path: str) -> TrieEncoder:
    """One encoder a worker process, whatever tasks it runs."""
    return TrieEncoder(path)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and decoded for every row of ``docs``.

    ``path`` names a tokenizers file that every machine has. Null and empty texts have
    no ids and decode to an empty text. Special tokens that stand in a text are encoded
    as such. Repeated rows and null ids stay, other columns are not read, an empty
    table gives an empty result. A task holds a slice of its texts at a time.
    """
    rows = docs.select("doc_id", "text")
    schema = T.StructType(
        [
            T.StructField("doc_id", rows.schema["doc_id"].dataType),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
            T.StructField("decoded", T.StringType()),
        ]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        for part in small_batches(batches, SLICE_CHARS):
            ids = list(encoder.encode(part["text"].to_pylist()))
            offsets = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            values = np.concatenate([*ids, np.empty(0, np.int32)])
            yield pa.RecordBatch.from_arrays(
                [
                    part["doc_id"],
                    pa.ListArray.from_arrays(offsets, values),
                    pa.array([encoder.decode(i.tolist()) for i in ids], pa.string()),
                ],
                names=schema.names,
            )

    return rows.mapInArrow(encode, schema)


def digest_encoded(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of the ids and of the decoded text."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

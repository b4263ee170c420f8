"""Packing by power-of-two decomposition.

A document of n tokens is cut into pieces whose lengths are the binary digits of n, longest
first, after as many pieces of the longest allowed length as fit. Pieces of one length fill
sequences of exactly that length, so no sequence holds two documents and nothing is padded.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 2048
#: Closes every document.
END = 1
#: Distinct pieces of text whose ids a worker keeps; it starts anew beyond.
CACHE = 800_000
#: Characters of the texts whose new pieces are encoded together.
GROUP_CHARS = 2_000_000
SPECIAL = "<|endoftext|>"
PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def _letter_encoder(path: str):
    """A faster encoder of single pre-tokens of letters, built from the vocabulary in ``path``.

    It merges the pair with the lowest id, so it serves only where merges are numbered in their
    order of rank; else None, and the tokenizer encodes all pieces.
    """
    import tiktoken

    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    vocab = model["vocab"]
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    byte = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    if any(vocab[a + b] != 256 + k for k, (a, b) in enumerate(merges)):
        return None
    tokens = {t: i for t, i in vocab.items() if i < 256 + len(merges)}
    ranks = {bytes(byte[c] for c in t): i for t, i in tokens.items()}
    return tiktoken.Encoding("letters", pat_str=r" ?\p{L}+|[^\p{L}]+", mergeable_ranks=ranks,
                             special_tokens={})


class Ids:
    """Token ids of texts, as the tokenizer gives them for the whole text.

    The vocabulary's pre-tokens end at a line end between two non-blanks, and before a single
    blank between two; a letter and a comma or full stop after it are two. Texts are cut
    there and each distinct piece is encoded once. A text with other runs of white space or the
    special token's string is encoded whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = _letter_encoder(path)
        #: None marks pieces that show the text has other white space.
        self.known: dict[str, bytes | None] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, pieces: set[str]) -> None:
        known = self.known
        marked = [p for p in pieces if p[-1:] in (",", ".") and p[-2:-1].isalpha()]
        need = list(({p for p in pieces if p not in known} - set(marked))
                    | {p[:-1] for p in marked if p[:-1] not in known} | {",", "."})
        if self.letters is not None:
            rest = []
            for piece in need:
                if piece.isalpha() or piece[:1] == " " and piece[1:].isalpha():
                    known[piece] = array("I", self.letters.encode_ordinary(piece)).tobytes()
                else:
                    rest.append(piece)
            need = rest
        for piece, got in zip(need, self.tokenizer.encode_batch_fast(
                need, add_special_tokens=False)):
            plain = piece == "\n" or piece and not (
                piece[0].isspace() and piece[0] != " " or piece[-1].isspace()
                or piece[1:2].isspace())
            known[piece] = array("I", got.ids).tobytes() if plain else None
        for piece in marked:
            known[piece] = known[piece[:-1]] and known[piece[:-1]] + known[piece[-1]]

    def _cut(self, text: str) -> list[str] | None:
        """The pieces of a text; None if it is to be encoded whole."""
        if SPECIAL in text or "\0" in text:
            return None
        # Every piece but a line's first one begins with its blank.
        return text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        group: list[tuple[str, list[str] | None]] = []
        size = 0
        for text in texts:
            group.append((text, self._cut(text)))
            size += len(text)
            if size > GROUP_CHARS:
                yield from self._join(group)
                group, size = [], 0
        yield from self._join(group)

    def _join(self, group: list[tuple[str, list[str] | None]]) -> Iterator[bytes]:
        pieces = set().union(*(cut for _, cut in group if cut))
        if len(self.known) > CACHE:
            self.known.clear()
        new = pieces.difference(self.known)
        if new:
            self._learn(new)
        get = self.known.__getitem__
        for text, cut in group:
            try:
                yield self._whole(text) if cut is None else b"".join(map(get, cut))
            except TypeError:  # a None among them
                yield self._whole(text)


_IDS: dict[str, Ids] = {}


def ids_of(path: str) -> Ids:
    """One per worker: later tasks find the vocabulary read and common pieces known."""
    if path not in _IDS:
        _IDS[path] = Ids(path)
    return _IDS[path]


def lengths(n: int, limit: int) -> list[int]:
    """Powers of two that add up to n: ``limit`` as often as it fits, then n's binary digits."""
    rest = n % limit
    return [limit] * (n // limit) + [1 << k for k in range(rest.bit_length() - 1, -1, -1)
                                     if rest >> k & 1]


def _pieces(path: str, limit: int):
    import os

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        ids = ids_of(path)
        schema = pa.schema([(c, pa.int64()) for c in
                            ("doc_id", "start", "length", "ids_crc32", "doc_tokens")])
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            texts = [x or "" for x in batch.column(1).to_pylist()]
            for doc, data in zip(batch.column(0).to_pylist(), ids.encode(texts)):
                data += end
                n, at = len(data) // 4, 0
                for size in lengths(n, limit):
                    part = memoryview(data)[at * 4:(at + size) * 4]
                    rows.append((doc, at, size, zlib.crc32(part), n))
                    at += size
            columns = zip(*rows) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], schema=schema)
    return run


def pack(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """Contract of op9, one row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset.

    A piece is a sequence of its own length, a power of two, so every offset is 0 and there is
    no padding. Sequences are numbered by length, longest first: the ids of a length form one
    block of numbers, in which each task of the stored pieces owns a range. A null text is
    empty: one piece, the closing id. Repeated rows are packed each; an empty table gives an
    empty result.
    """
    if limit & (limit - 1) or limit < 1:
        raise ValueError("the limit is a power of two")
    cut = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _pieces(path, limit), PIECES)
    bits = int(limit).bit_length()
    # The number of a piece's task and its place in it are unique; the length sets the top bits.
    number = F.monotonically_increasing_id()
    block = F.lit(bits) - 1 - F.log2("length").cast("int")
    return cut.select(
        "*", (block.cast("long") * F.lit(1 << 58) + number).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))

"""Best-fit packing of token sequences into bins with several capacities.

A piece asks for a vector of its bin: tokens, one document, and an attention
cost (its length squared).  Pieces are placed longest first, each into the bin
whose residual vector fits best under every constraint: smallest weighted
residual norm, or largest weighted dot product of demand and residual.

A demand depends on the length alone, so pieces of equal length are
interchangeable and bins with equal contents stay interchangeable as well.  The
plan is therefore computed on the histogram of lengths (at most ``tokens`` rows,
whatever the corpus), moving whole ranges of equal bins at once; it is the same
packing that piece-by-piece best-fit decreasing gives, with no bin cut off at a
partition's edge.  Tokenizing, ranking the pieces of each length and
looking up their places run on the executors.

Defined cases: null text counts as empty (one end token); repeated rows are
pieces of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import cache
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pitlane.llm.common import staged

TOKENIZER = "word_bpe_49k.json"
TOKENS = 4096
END = 1
CELL = 128  # pieces of one length ranked together
_CELLS = 4096  # cells of one length whose sizes are summed together
_WORDS = 3 << 17  # words of a generation whose ids a task remembers
_PIECE = ["doc_id", "piece", "start", "length", "ids_crc32"]
_PORTION = 4 << 20  # bytes of text tokenized together
_PUNCTUATION = b'!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'  # no apostrophe: it can begin a token with the letters behind it


class Capacity(NamedTuple):
    """What a bin holds; the defaults for documents and cost never bind before the tokens do."""

    tokens: int = TOKENS
    documents: int = TOKENS
    cost: int = TOKENS * TOKENS


class Weights(NamedTuple):
    """Of the residuals' squares, each residual taken as a share of its capacity; the small ones break ties."""

    tokens: float = 1.0
    documents: float = 1e-9
    cost: float = 1e-9


class Place(NamedTuple):
    """Pieces of ``length`` ranked from ``rank``: ``bins`` bins from ``bin`` on take ``each``, the first at ``offset``."""

    length: int
    rank: int
    bin: int
    bins: int
    each: int
    offset: int


def plan(histogram: dict[int, int], capacity: Capacity = Capacity(), weights: Weights = Weights(), rule: str = "norm") -> list[Place]:
    """Best-fit decreasing on counts of lengths; bins are numbered from 0 without gaps."""
    full = np.array(capacity, np.int64)
    scale = np.sqrt(np.array(weights)) / full
    left = np.zeros((1024, 3), np.int64)  # residual of each range of equal bins
    first = np.zeros(1024, np.int64)
    count = np.zeros(1024, np.int64)
    used = bins = 0
    places: list[Place] = []

    def add(residual, start, n):
        nonlocal left, first, count, used
        if used == len(first):
            keep = np.flatnonzero((count[:used] > 0) & (left[:used] > 0).all(axis=1))
            left[: len(keep)], first[: len(keep)], count[: len(keep)] = left[keep], first[keep], count[keep]
            used = len(keep)
            if used > len(first) // 2:
                left, first, count = (np.concatenate([a, np.zeros_like(a)]) for a in (left, first, count))
        left[used], first[used], count[used] = residual, start, n
        used += 1

    for length in sorted(histogram, reverse=True):
        ask = np.array([length, 1, length * length], np.int64)
        if (ask > full).any():
            raise ValueError(f"a piece of {length} tokens fits no bin")
        rank, rest = 0, histogram[length]
        while rest:
            fits = np.flatnonzero((count[:used] > 0) & (left[:used] >= ask).all(axis=1))
            if len(fits):
                if rule == "norm":
                    score = (((left[fits] - ask) * scale) ** 2).sum(axis=1)
                else:
                    score = -((left[fits] * scale) * (ask * scale)).sum(axis=1)
                at = fits[np.argmin(score)]
                residual, start, n = left[at].copy(), int(first[at]), int(count[at])
            else:
                at, residual, start, n = -1, full, bins, rest
            # under the norm a bin that took one piece fits the next one even better, so it is filled up
            each = min(int((residual // ask).min()), rest) if rule == "norm" else 1
            n = min(n, rest // each)
            if at < 0:
                bins += n
            else:
                first[at] += n
                count[at] -= n
            add(residual - each * ask, start, n)
            places.append(Place(length, rank, start, n, each, int(capacity.tokens - residual[0])))
            rank, rest = rank + n * each, rest - n * each
    return places


class _Ids:
    """Token ids of words (bytes), 4 bytes each (little-endian, as every platform Spark's Python runs on).

    The tokenizer drops white space before it looks for words, so a text's ids
    are those of its parts between white space in turn; so are those of a word
    and of the punctuation behind it, if the word still ends in a letter when it is normalised (a
    capital may become a letter and a mark, which goes with the punctuation).  Two generations of words
    are kept, so that words in use survive when the older one goes.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.added = {content.encode(): i for content, i in added.items()}
        self.tokenizer.encode_special_tokens = True  # words only; ``text_ids`` takes the added tokens out before
        self.newer: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def word(self, word: bytes) -> bytes:
        ids = self.newer.get(word)
        if ids is not None:
            return ids
        ids = self.older.get(word)
        if ids is None:
            letters = word if word.isalpha() else word.rstrip(_PUNCTUATION)
            if len(letters) < len(word) and self._ends_in_letter(letters):
                ids = self.word(letters) + self.word(word[len(letters) :])
            else:
                encoded = self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids
                ids = array("I", encoded).tobytes()
        if len(self.newer) >= _WORDS:
            self.older, self.newer = self.newer, {}
        self.newer[word] = ids
        return ids


    def _ends_in_letter(self, word: bytes) -> bool:
        if word.isascii():
            return word[-1:].isalpha()
        text = word.decode("utf-8", "replace")
        if self.tokenizer.normalizer:
            text = self.tokenizer.normalizer.normalize_str(text)
        return text[-1:].isalpha()


@cache
def _ids(name: str) -> _Ids:
    return _Ids(tokenizer_path(name))


def token_ids(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts (binary, no nulls) in turn, without end ids, and where each text's begin and the last ends.

    Each different word is looked up once; the texts are then gathered from the words' ids.
    """
    words = pc.ascii_split_whitespace(pc.ascii_lower(texts.view(pa.string())))
    encoded = words.flatten().dictionary_encode()
    known = _ids(path).word
    ids = [known(w) if w else b"" for w in encoded.dictionary.view(pa.binary()).to_pylist()]
    lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    starts = np.concatenate([[0], np.cumsum(lengths)])
    codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    each = lengths[codes]
    ends = np.concatenate([[0], np.cumsum(each)])
    place = np.repeat(starts[codes] - ends[:-1], each) + np.arange(ends[-1])
    first = words.offsets.to_numpy() - words.offsets[0].as_py()
    return np.frombuffer(b"".join(ids), "<u4")[place], ends[first]


def text_ids(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Like ``token_ids``, but added tokens written in a text have their own ids, as the plain tokenizer gives them."""
    added = _ids(path).added
    if not added:
        return token_ids(texts, path)
    pattern = "|".join(re.escape(a.decode()) for a in sorted(added, key=len, reverse=True))
    if not pc.any(pc.match_substring_regex(texts, pattern)).as_py():
        return token_ids(texts, path)
    split = re.compile(f"({pattern})".encode())
    parts = [split.split(t) for t in texts.to_pylist()]  # text, added token, text, ...
    ids, at = token_ids(pa.array([x for p in parts for x in p[::2]], pa.binary()), path)
    out, ends, k = [], [0], 0
    for p in parts:
        n = 0
        for i, part in enumerate(p):
            if i % 2:
                got = np.array([added[part]], "<u4")
            else:
                got, k = ids[at[k] : at[k + 1]], k + 1
            out.append(got)
            n += len(got)
        ends.append(ends[-1] + n)
    return np.concatenate(out), np.array(ends)


def _portions(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about _PORTION bytes, or of one longer text."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        done = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + _PORTION, side="right")))
        yield start, stop
        start = stop


def _cut(path: str, tokens: int):
    end = END.to_bytes(4, "little")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            docs, texts = batch.column(0).to_pylist(), batch.column(1)
            for start, stop in _portions(texts):
                ids, at = text_ids(texts.slice(start, stop - start), path)
                for doc, a, b in zip(docs[start:stop], at[:-1].tolist(), at[1:].tolist(), strict=True):
                    whole = ids[a:b].tobytes() + end
                    for piece, k in enumerate(range(0, len(whole), 4 * tokens)):
                        part = whole[k : k + 4 * tokens]
                        for column, value in zip(out, (doc, piece, k // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                            column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], _PIECE)


    return task


def pieces(docs: DataFrame, path: str, tokens: int = TOKENS) -> DataFrame:
    """Pieces of at most ``tokens`` ids: doc_id, piece, start, length, ids_crc32."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    texts = docs.select(F.col("doc_id").cast("long"), text.alias("text"))
    return texts.mapInArrow(_cut(path, tokens), "doc_id long, piece int, start long, length long, ids_crc32 long")


def ranked(items: DataFrame, histogram: DataFrame) -> DataFrame:
    """Adds ``rank``, a gapless number from 0 among the pieces of a length.

    Pieces of a length are spread over cells of about CELL by hash and numbered there; a
    cell's base is the running sum of the cells before it in its block of _CELLS cells, and of the blocks before.
    """
    cells = F.broadcast(histogram.select("length", F.ceil(F.col("n") / CELL).alias("_cells")))  # one row per length, at most TOKENS
    spread = items.join(cells, "length").withColumn("_cell", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("_cells")))
    sizes = staged(spread.groupBy("length", "_cell").agg(F.count(F.lit(1)).alias("_n")), "cells")
    sizes = sizes.withColumn("_block", F.floor(F.col("_cell") / _CELLS))
    blocks = sizes.groupBy("length", "_block").agg(F.sum("_n").alias("_n"))
    earlier = Window.partitionBy("length").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("length", "_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    before = Window.partitionBy("length", "_block").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    inside = sizes.withColumn("_inside", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    bases = inside.join(starts, ["length", "_block"]).select("length", "_cell", (F.col("_start") + F.col("_inside")).alias("_base"))
    within = Window.partitionBy("length", "_cell").orderBy("doc_id", "piece", "ids_crc32")
    numbered = spread.withColumn("_row", F.row_number().over(within)).join(bases, ["length", "_cell"])
    return numbered.withColumn("rank", F.col("_base") + F.col("_row") - 1).drop("_cells", "_cell", "_base", "_row")


_RANK_BITS = 48


def _locate(places: list[Place]):
    table = np.array(sorted(places), np.int64)
    keys = table[:, 0] << _RANK_BITS | table[:, 1]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            place = table[np.searchsorted(keys, length << _RANK_BITS | rank, side="right") - 1]
            _, start, first, _, each, offset = place.T
            sequence, at = first + (rank - start) // each, offset + (rank - start) % each * length
            kept = [batch.column(c) for c in _PIECE]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(at)], [*_PIECE, "sequence_id", "offset"])

    return task


def pack(docs: DataFrame, path: str, capacity: Capacity = Capacity(), weights: Weights = Weights(), rule: str = "norm") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    items = staged(pieces(docs, path, capacity.tokens), "pieces")
    histogram = staged(items.groupBy("length").agg(F.count(F.lit(1)).alias("n")), "lengths")
    # at most capacity.tokens rows, whatever the corpus
    places = plan({r["length"]: r["n"] for r in histogram.collect()}, capacity, weights, rule)
    if not places:
        return items.withColumn("sequence_id", F.lit(0).cast("long")).withColumn("offset", F.lit(0).cast("long"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked(items, histogram).select(*_PIECE, "rank").mapInArrow(_locate(places), schema)


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where this machine keeps the tokenizer: a path itself, or a name of the public tokenizers."""
    if Path(name).exists():
        return name
    import public_tokenizers

    return str(public_tokenizers.path(name))

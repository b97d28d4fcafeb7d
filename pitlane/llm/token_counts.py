"""Token counts of whole texts without their ids.

A byte-pair tokenizer splits a text into pre-tokens and each of these into
pieces, whatever stands around it.  So the pieces of every distinct pre-token are
counted once for the whole corpus, and a document's tokens are the sum over its
pre-tokens' frequencies:

1. each task gathers its distinct pre-tokens with their frequencies; one
   aggregate makes the vocabulary, and its pieces are counted there;
2. the FREQUENT most frequent pre-tokens (a fixed number) go to all tasks, which add them
   up where the text is read; a document's other pre-tokens travel as
   (document, pre-token, frequency) to the vocabulary and come back as one sum.

No pre-token of the second kind can be hot: each has less than 1 / FREQUENT of all
occurrences, and its rows of one document are one.

Texts are cut on whole batches with numpy: the byte-level pattern looks at classes of
characters alone (letters, numbers, white space, others), which are asked from the
tokenizer itself, and at the English endings behind an apostrophe.  Texts holding the
tokenizer's added tokens or characters beyond the table are split by the library; an added token
counts one, as the tokenizer's default has it.

Defined cases: a null text counts as empty (0 bytes, 0 tokens); repeated rows and null
ids are rows of their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.llm.common import staged

LIMIT = 512
FREQUENT = 1 << 17  # at most so many pre-tokens whose counts every task holds (about 4 MB)
_PORTION = 4 << 20  # bytes of text split together
_STEPS = 8  # steps of frequency to a doubling, when the frequent ones are chosen

# classes of characters, and how many characters have theirs in the table
_SPACE, _LETTER, _NUMBER, _OTHER = range(4)
_TABLE = 0x20000
_BEYOND = r"\xf0[\xa0-\xbf]|[\xf1-\xf4]"  # the others, in UTF-8
# endings that the byte-level pattern cuts off with their apostrophe
_ENDINGS = ("s", "t", "m", "d", "re", "ve", "ll")


class Splitter:
    """Pre-tokens of texts, as the tokenizer's own pre-tokenizer gives them."""

    def __init__(self, name: str):
        from tokenizers import Tokenizer

        if not os.path.exists(name):  # a name of the public tokenizers, wherever this machine keeps them
            import public_tokenizers

            name = str(public_tokenizers.path(name))
        self.tokenizer = Tokenizer.from_file(name)
        with open(name, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["model"]["type"] != "BPE" or not spec["pre_tokenizer"]:
            raise ValueError("needs a byte-pair tokenizer with a pre-tokenizer")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that take their surroundings are not supported")
        added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        step = spec["pre_tokenizer"]
        by_class = not spec["normalizer"] and step["type"] == "ByteLevel" and step["use_regex"] and not step["add_prefix_space"]
        self.classes = self._classes() if by_class else None
        self.whole = "|".join([_BEYOND, *map(re.escape, added)])

    def _classes(self) -> np.ndarray:
        """A character has a letter's class if no cut stands between a letter and it, and so on."""
        chars = [c for c in range(_TABLE) if not 0xD800 <= c < 0xE000]
        classes = np.full(_TABLE, _SPACE, np.uint8)
        for sample, kind in (("a", _LETTER), ("1", _NUMBER), ("!", _OTHER)):
            text = "".join(sample + chr(c) for c in chars)
            cuts = np.array([start for _, (start, _) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)])
            joined = np.ones(len(text), bool)
            joined[cuts] = False
            classes[np.array(chars)[joined[1::2]]] = kind
        return classes

    def pieces(self, pretoken: str) -> int:
        return sum(len(self.tokenizer.model.tokenize(p)) for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(pretoken))

    def split(self, text: str) -> list[str]:
        if self.tokenizer.normalizer:
            text = self.tokenizer.normalizer.normalize_str(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
        """Of binary texts: each pre-token's text and its number, the distinct ones by number, and each text's added tokens."""
        added = np.zeros(len(texts), np.int64)
        if self.classes is None:
            whole = np.arange(len(texts))
        else:
            whole = np.flatnonzero(pc.match_substring_regex(texts, self.whole).to_numpy(zero_copy_only=False))
        owners, found = [], []
        if len(whole) < len(texts):
            plain = np.delete(np.arange(len(texts)), whole)
            try:
                owner, cut = pretokens(texts.take(pa.array(plain)) if len(whole) else texts, self.classes)
            except UnicodeDecodeError:  # Spark lets such strings pass; the library reads them with replacements
                whole = np.arange(len(texts))
            else:
                owners.append(plain[owner])
                found.append(cut)
        for i in whole.tolist():
            text = texts[i].as_py().decode("utf-8", "replace")
            parts = self.added.split(text) if self.added else [text]
            added[i] = len(parts) - 1
            cut = [p.encode() for part in parts if part for p in self.split(part)]
            owners.append(np.full(len(cut), i))
            found.append(pa.array(cut, pa.binary()))
        none = np.zeros(0, np.int64)
        every = pa.concat_arrays([pa.array([], pa.binary()), *found]).dictionary_encode()
        return np.concatenate([none, *owners]), every.indices.to_numpy(zero_copy_only=False).astype(np.int64), every.dictionary, added


def pretokens(texts: pa.Array, classes: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Cuts binary texts where the byte-level pattern does: each pre-token's text number, and the pre-tokens.

    Runs of one class stand alone, with the blank before them if there is one; of a run of
    white space before other characters the last one stands alone unless it is that blank; an
    ending goes with its apostrophe if that begins a pre-token.
    """
    at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
    at = at - at[0]
    place = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))  # of each character
    chars = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    begins = np.searchsorted(place, at)
    kind = classes[chars]
    first = np.zeros(len(chars) + 1, bool)  # of a text
    first[begins] = True
    cut = first.copy()
    cut[1:-1] |= kind[1:] != kind[:-1]
    after = np.flatnonzero(cut[1:-1] & ~first[1:-1] & (kind[1:] != _SPACE) & (kind[:-1] == _SPACE)) + 1  # other characters behind white space
    cut[after - 1] = True
    cut[after[chars[after - 1] == 0x20]] = False
    marks = np.flatnonzero(chars == 0x27)
    if len(marks):
        before = np.maximum(marks - 1, 0)
        opens = first[marks] | (kind[before] != _OTHER) & (chars[before] != 0x20)
        padded = np.concatenate([chars, np.zeros(2, np.uint32)])
        inside = np.concatenate([~first, [False, False]])  # does the character go on with the text of the one before
        for ending in _ENDINGS:
            here = marks[opens]
            for k, c in enumerate(ending, 1):
                here = here[(padded[np.minimum(here + k, len(chars))] == ord(c)) & inside[np.minimum(here + k, len(chars))]]
            cut[here + 1] = False
            cut[here + 1 + len(ending)] = True
    cut[len(chars)] = False
    starts = np.flatnonzero(cut)
    owner = np.searchsorted(begins, starts, side="right") - 1
    offsets = np.append(place[starts], len(data)).astype(np.int32)
    return owner, pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


@cache
def _splitter(name: str) -> Splitter:
    return Splitter(name)


def _portions(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about _PORTION bytes, or of one longer text."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + _PORTION, side="right")))
        yield start, stop
        start = stop


def _gather(name: str):
    """Task function: texts in, each portion's distinct pre-tokens with their frequencies out."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = _splitter(name)
        for batch in batches:
            for start, stop in _portions(batch.column(0)):
                _, codes, distinct, _ = split(batch.column(0).slice(start, stop - start))
                yield pa.RecordBatch.from_arrays([distinct, pa.array(np.bincount(codes, minlength=len(distinct)))], ["pretoken", "n"])

    return task


def _pieces(name: str):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = _splitter(name)
        for batch in batches:
            pieces = pa.array([split.pieces(p.decode("utf-8", "replace")) for p in batch.column("pretoken").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("pretoken"), batch.column("n"), pieces], ["pretoken", "n", "pieces"])

    return task


def _sum(name: str, frequent):
    """Task function: (doc_id, text) in; doc_id, tag, bytes, tokens known here, and the other pre-tokens with frequencies out."""
    other = [pa.field("pretoken", pa.binary()), pa.field("n", pa.int64())]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, tag = _splitter(name), TaskContext.get().partitionId() << 40
        known, pieces = (pa.array(c, t) for c, t in zip(frequent.value, (pa.binary(), pa.int64()), strict=True))
        pieces = np.append(pieces.to_numpy(), 0)
        for batch in batches:
            docs, texts = batch.column(0), batch.column(1)
            for start, stop in _portions(texts):
                part = texts.slice(start, stop - start)
                owner, codes, distinct, tokens = split(part)
                index = pc.index_in(distinct, known).fill_null(len(known)).to_numpy()
                np.add.at(tokens, owner, pieces[index][codes])
                rest = index[codes] == len(known)
                pairs, n = np.unique(owner[rest] * len(distinct) + codes[rest], return_counts=True)
                at = np.searchsorted(pairs, np.arange(len(part) + 1) * len(distinct))
                found = pa.StructArray.from_arrays([distinct.take(pa.array(pairs % max(len(distinct), 1))), pa.array(n)], fields=other)
                yield pa.RecordBatch.from_arrays(
                    [
                        docs.slice(start, stop - start),
                        pa.array(np.arange(tag, tag + len(part))),
                        pc.binary_length(part).cast(pa.int64()),
                        pa.array(tokens),
                        pa.ListArray.from_arrays(pa.array(at, pa.int32()), found),
                    ],
                    ["doc_id", "tag", "n_bytes", "known", "others"],
                )
                tag += len(part)

    return task


def _text():
    return F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text")


def vocabulary(docs: DataFrame, name: str) -> DataFrame:
    """Every distinct pre-token of the texts with its frequency and its pieces, counted once."""
    seen = docs.select(_text()).mapInArrow(_gather(name), "pretoken binary, n long")
    return seen.groupBy("pretoken").agg(F.sum("n").alias("n")).mapInArrow(_pieces(name), "pretoken binary, n long, pieces long")


def most_frequent(words: DataFrame, most: int = FREQUENT) -> DataFrame:
    """The vocabulary's most frequent pre-tokens, at most ``most``: all above a step of frequency."""
    step = F.floor(F.log2("n") * _STEPS)
    least, total = None, 0
    for r in words.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("step")).collect():  # 64 * _STEPS rows at most
        total += r.words
        if total > most:
            break
        least = r.step
    return words.where(F.lit(False) if least is None else step >= least)


def token_counts(docs: DataFrame, name: str, limit: int = LIMIT, frequent: int = FREQUENT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens)."""
    spark = docs.sparkSession
    words = staged(vocabulary(docs, name), "pretokens")
    top = most_frequent(words, frequent).select("pretoken", "pieces").collect()  # ``frequent`` rows at most
    known = spark.sparkContext.broadcast(([bytes(r.pretoken) for r in top], [r.pieces for r in top]))
    schema = "doc_id long, tag long, n_bytes long, known long, others array<struct<pretoken:binary,n:long>>"
    rows = staged(docs.select(F.col("doc_id").cast("long"), _text()).mapInArrow(_sum(name, known), schema), "counted")
    others = rows.select("tag", F.explode("others").alias("other")).select("tag", "other.*")
    sums = others.join(words.select("pretoken", "pieces"), "pretoken").groupBy("tag").agg(F.sum(F.col("n") * F.col("pieces")).alias("rest"))
    tokens = F.col("known") + F.coalesce(F.col("rest"), F.lit(0))
    return rows.drop("others").join(sums, "tag", "left").select("doc_id", "n_bytes", tokens.alias("n_tokens"), (tokens > limit).alias("over_limit"))

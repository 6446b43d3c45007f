"""Harmonic packing of token sequences.

A document's ids (and one closing id) are cut into whole sequences; of the rest, up to
``CUTS`` pieces are split off whose length is the largest power of two that fits; the
last piece stays as it is.  A piece of length n belongs to the class k = capacity // n,
and every k pieces of a class fill one sequence.  Power-of-two pieces fill theirs
without a gap; the last pieces are short, so their class wastes little.

Workers number their pieces per class on their own, in one pass over their documents; a
table of counts per worker and class turns these numbers into sequence numbers, so no
worker waits for another.  Only the last, unfinished sequence of each class is left: at
most one a class (``CAPACITY`` classes at worst, some 200 in fact), and first-fit
decreasing joins these.

Tokens: the vocabulary splits at white space and lower-cases anyway, so each worker encodes
a word once and remembers it (at most twice ``MEMORY`` words).

Defined cases: NULL or empty text is one piece, the closing id; NULL identifiers and
repeated rows are packed like others; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import os
import re
import sys
import types
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starbuild.llm.common import stage

CAPACITY = 4096
END = 2
CUTS = 2
#: Rests below this are not cut.
LEAST_CUT = 128
#: Words a worker learns before it forgets those not met since.
MEMORY = 400_000
#: A full stop or comma after a letter, before white space: a token of its own.
_STOP = re.compile(rb"(?<=[a-z])([.,])(?=[ \t-\r]|\Z)")


def cut(n: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of the pieces of a document of ``n`` ids, in order."""
    pieces, rest = [capacity] * (n // capacity), n % capacity
    for _ in range(CUTS):
        if rest >= LEAST_CUT:
            pieces.append(1 << (rest.bit_length() - 1))
            rest -= pieces[-1]
    return pieces + [rest] * (rest > 0)


class Words:
    """Ids of a text as little-endian 32-bit integers, by words it has seen.

    Words that were not met since ``MEMORY`` others were learnt are forgotten.
    """

    def __init__(self, tokenizer_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(tokenizer_path)
        self._known: dict[bytes, bytes] = {}
        self._former: dict[bytes, bytes] = {}
        vocabulary = self._tokenizer.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _encode(self, words: list[str]) -> list[list[int]]:
        return [x.ids for x in self._tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _learn(self, new: list[bytes]) -> None:
        """A word of letters alone ends in exactly one closing token, so such words are encoded together and cut there."""
        text = [w.decode() for w in new]
        plain = [w.isalpha() for w in text]
        together = [w for w, p in zip(text, plain) if p]
        ids = np.array(self._encode([" ".join(together)])[0], "<u4")
        ends = np.flatnonzero(self._ends[ids]) + 1
        if len(ends) != len(together):
            plain = [False] * len(text)
        raw, cuts, begin = ids.tobytes(), iter((4 * ends).tolist()), 0
        rest = []
        for word, p in zip(new, plain):
            if p:
                end = next(cuts)
                self._known[word] = raw[begin:end]
                begin = end
            else:
                rest.append(word)
        for word, found in zip(rest, self._encode([w.decode() for w in rest])):
            self._known[word] = array("I", found).tobytes()

    def ids(self, text: bytes) -> bytes:
        if b"<|" not in text:  # no special token can arise; the vocabulary has lower case only
            text = _STOP.sub(rb" \1", text.lower())
        words = text.split()  # at ASCII white space, where no token crosses
        known = self._known
        found = list(map(known.get, words))
        if None in found:
            missing = [i for i, ids in enumerate(found) if ids is None]
            former, new = self._former, []
            for word in dict.fromkeys([words[i] for i in missing]):
                if word in former:
                    known[word] = former[word]
                else:
                    new.append(word)
            if new:
                self._learn(new)
            for i in missing:
                found[i] = known[words[i]]
            if len(known) > MEMORY:
                self._known, self._former = {}, known
        return b"".join(found)


def worker_words(tokenizer_path: str) -> Words:
    """The worker process's ``Words``, which later tasks find filled."""
    kept = sys.modules.setdefault("_starbuild_words", types.ModuleType("_starbuild_words"))
    if not hasattr(kept, "by_path"):
        kept.by_path = {}
    if tokenizer_path not in kept.by_path:
        kept.by_path[tokenizer_path] = Words(tokenizer_path)
    return kept.by_path[tokenizer_path]


_FIELDS = "start long, length long, ids_crc32 long, doc_tokens long, worker int, cls int, number long"


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents, numbered per worker and class; with ``with_ids`` also their ids as 32-bit integers."""
    slim = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    end = array("I", [END]).tobytes()

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, number, worker = worker_words(tokenizer_path), defaultdict(int), TaskContext.get().partitionId()
        for batch in batches:
            rows: list[list] = [[] for _ in range(8 + with_ids)]
            texts = batch.column(1).cast(pa.large_binary())
            for at, text in enumerate(texts):
                ids = words.ids(text.as_buffer().to_pybytes() if text.is_valid else b"") + end
                total, start = len(ids) // 4, 0
                for length in cut(total, capacity):
                    piece, cls = ids[4 * start : 4 * (start + length)], capacity // length
                    values = [at, start, length, zlib.crc32(piece), total, worker, cls, number[cls]]
                    for column, value in zip(rows, values + [piece] * with_ids):
                        column.append(value)
                    number[cls] += 1
                    start += length
            out = [batch.column(0).take(pa.array(rows[0], pa.int64()))]
            kinds = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.int64()] + [pa.binary()] * with_ids
            out += [pa.array(r, kind) for r, kind in zip(rows[1:], kinds)]
            names = ["doc_id", *[x.split()[0] for x in _FIELDS.split(", ")], *["ids"] * with_ids]
            yield pa.RecordBatch.from_arrays(out, names=names)

    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(cut_up, f"doc_id {kind}, {_FIELDS}" + ", ids binary" * with_ids)


def _first_fit(left: list[tuple[int, int]], capacity: int) -> list[list[int]]:
    """Classes whose unfinished sequences share one, first fit by decreasing fill."""
    bins: list[list] = []
    for cls, fill in sorted(left, key=lambda x: (-x[1], x[0])):
        for b in bins:
            if b[0] + fill <= capacity:
                b[0] += fill
                b[1].append(cls)
                break
        else:
            bins.append([fill, [cls]])
    return [b[1] for b in bins]


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset`` within it; ``with_ids`` adds the ids themselves."""
    cut_up = stage(pieces(docs, tokenizer_path, id_col, text_col, capacity, with_ids), "pieces")
    per_worker = cut_up.groupBy("worker", "cls").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("cls").orderBy("worker")) - F.col("n")
    per_worker = per_worker.select("worker", "cls", before.alias("before"), F.sum("n").over(Window.partitionBy("cls")).alias("all"))
    per_worker = stage(per_worker, "piece-counts")
    numbered = cut_up.join(per_worker, ["worker", "cls"]).withColumn("index", F.col("before") + F.col("number"))
    numbered = numbered.withColumn("turn", F.floor(F.col("index") / F.col("cls")))
    numbered = numbered.withColumn("left", F.col("turn") == F.floor(F.col("all") / F.col("cls")))
    # one row a class: at most `capacity`
    ends = numbered.groupBy("cls").agg(
        F.max("all").alias("all"), F.sum(F.when(F.col("left"), F.col("length")).otherwise(0)).alias("fill")
    )
    ends = sorted(ends.collect())
    base, first = {}, 0
    for cls, n, _ in ends:
        base[cls] = first
        first += n // cls
    shared = {c: first + i for i, classes in enumerate(_first_fit([(c, f) for c, _, f in ends if f], capacity)) for c in classes}
    spark = docs.sparkSession
    table = spark.createDataFrame([(c, base[c], shared.get(c)) for c, _, _ in ends], "cls int, base long, shared long")
    placed = numbered.join(F.broadcast(table), "cls").withColumn(
        "sequence_id", F.when(F.col("left"), F.col("shared")).otherwise(F.col("base") + F.col("turn"))
    )
    order = Window.partitionBy("sequence_id").orderBy("cls", "index")
    offset = F.sum("length").over(order) - F.col("length")
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", offset.alias("offset"), *["ids"] * with_ids
    )

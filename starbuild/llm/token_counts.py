"""Token counts by distinct pre-tokens.

A byte-level vocabulary cuts a text into pre-tokens and each of these into pieces, independently of what
stands around it.  So the pieces of a pre-token are counted once for the whole corpus, and a document's
tokens are the sum of these counts times the frequencies of its pre-tokens; no ids are made.

Documents are read once, in blocks of ``BLOCK`` bytes of text.  A block numbers its distinct pre-tokens by
falling frequency; its documents are stored with their frequencies per number (differences of the sorted
numbers, in one to five bytes each).  The blocks' lists of pre-tokens alone are shuffled, so that equal ones
stand together and are counted once; a pre-token leaves a block once, however many of its documents hold it,
so the commonest is one short row per block.  The counts return to their block, where they are joined to
the documents' frequencies, multiplied and added up.

To find pre-tokens cheaply, a text is first cut before every space, and around every line feed, that a
character other than white space follows: no pre-token reaches across such a place.  The library cuts each
distinct stretch between them once a block, so what a pre-token is, is the library's own decision.

Defined cases: NULL or empty text has no tokens; strings of the vocabulary's special tokens count as one
token each, as the library has it by default; NULL and repeated identifiers are counted row by row; a text
longer than a block is a block of its own; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starbuild.llm.common import stage

#: Bytes of text in a block; a document counts as 64 at least.
BLOCK = 16 << 20
#: Stretches that the library cuts in one call.
TOGETHER = 20_000
#: Pairs of document and stretch that are sorted together.
SORTED = 150_000
#: Counts that a task gathers before it hands them out by block.
HELD = 400_000

_SPACE_THEN_WHITE = re.compile(r" (?!\S)")
_BEFORE_WORD = re.compile(r" (?=\S)")
_LINE_END = re.compile(r"\n(?=\S)")


class _Numbers(dict):
    """Numbers its keys in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        number = self[key] = len(self)
        return number


class Stretches:
    """Numbers the stretches of texts that begin and end where pre-tokens do: even numbers for those after a space."""

    def __init__(self) -> None:
        self.spaced, self.first = _Numbers(), _Numbers()

    def numbers(self, text: str) -> np.ndarray:
        lines = _LINE_END.split(text) if "\n" in text else [text]
        firsts, words = [], []
        if len(lines) > 1:
            firsts = [self.first["\n"]] * (len(lines) - 1)
        for line in lines:
            found = _BEFORE_WORD.split(line) if _SPACE_THEN_WHITE.search(line) else line.split(" ")
            if found[0]:
                firsts.append(self.first[found[0]])
            del found[0]
            words += found
        spaced = np.fromiter(map(self.spaced.__getitem__, words), np.int32, len(words))
        return np.concatenate([2 * spaced, 2 * np.array(firsts, np.int32) + 1])


def varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-negative integers below 2^35 as bytes of seven bits, the last of each below 128; and how many bytes each has."""
    sizes = np.ones(len(values), np.int64)
    for bits in (7, 14, 21, 28):
        sizes += values >> bits > 0
    ends = np.cumsum(sizes)
    out = np.zeros(ends[-1] if len(ends) else 0, np.uint8)
    for i in range(int(sizes.max(initial=0))):
        at = sizes > i
        more = np.where(sizes[at] > i + 1, 128, 0)
        out[(ends - sizes)[at] + i] = (values[at] >> 7 * i & 127) | more
    return out, sizes


def from_varints(data: np.ndarray) -> np.ndarray:
    if not len(data):
        return np.zeros(0, np.int64)
    last = data < 128
    starts = np.concatenate([[0], np.flatnonzero(last)[:-1] + 1])
    sizes = np.diff(np.append(starts, len(data)))
    shift = 7 * (np.arange(len(data)) - np.repeat(starts, sizes))
    return np.add.reduceat((data & 127).astype(np.int64) << shift, starts)


class Vocabulary:
    """A byte-level vocabulary file: its pre-tokens, and how many pieces each has."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            declared = json.load(file)
        pre = declared["pre_tokenizer"] or {}
        plain = not any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in declared["added_tokens"])
        if declared["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex") or not plain:
            raise ValueError("only byte-level vocabularies that cut by the usual pattern, without normalisation, count by pre-token")
        self._tokenizer = Tokenizer.from_file(path)
        special = sorted((a["content"] for a in declared["added_tokens"]), key=len, reverse=True)
        self._special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None

    def parts(self, text: str) -> list[str]:
        """The text between special tokens."""
        return [text] if self._special is None or not self._special.search(text) else self._special.split(text)

    def cut(self, stretches: Stretches) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Distinct pre-tokens, and those of every stretch by number: first spaced stretches, then the others.

        Many stretches are cut as one string: no pre-token crosses from one into the next.
        """
        pre, number = self._tokenizer.pre_tokenizer, _Numbers()
        found, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for mark, own in ((" ", list(stretches.spaced)), ("\n", list(stretches.first))):
            for begin in range(0, len(own), TOGETHER):
                part = own[begin : begin + TOGETHER]
                # after the line feed in front, white space would join it: such stretches are cut alone
                alone = [i for i, s in enumerate(part) if mark == "\n" and s[0].isspace()]
                plain = np.delete(np.arange(len(part)), alone)
                tokens = pre.pre_tokenize_str("".join([mark + part[i] for i in plain]))
                starts = np.cumsum([0] + [len(part[i]) + 1 for i in plain])[:-1]
                begins = np.array([at for _, (at, _) in tokens], np.int64)
                owner = np.searchsorted(starts, begins, side="right") - 1
                kept = np.ones(len(tokens), bool) if mark == " " else begins > starts[owner]
                numbers = [number[t] for (t, _), k in zip(tokens, kept.tolist()) if k]
                owner = plain[owner[kept]]
                for i in alone:
                    more = [number[t] for t, _ in pre.pre_tokenize_str(part[i])]
                    numbers += more
                    owner = np.append(owner, [i] * len(more))
                order = np.argsort(owner, kind="stable")
                owner, numbers = owner[order], np.array(numbers, np.int32)[order]
                found.append(numbers)
                sizes.append(np.bincount(owner, minlength=len(part)))
        return list(number), np.concatenate(found), np.concatenate(sizes)

    def pieces(self, pre_token: str) -> int:
        return len(self._tokenizer.model.tokenize(pre_token))


class _Block:
    """Documents whose pre-tokens are numbered together."""

    def __init__(self, vocabulary: Vocabulary, name: int):
        self._vocabulary, self._name = vocabulary, name
        self._stretches = Stretches()
        self._ids: list[pa.Array] = []
        self._sizes: list[int] = []
        self._special: list[int] = []
        self._found: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def __len__(self) -> int:
        return len(self._ids)

    def add(self, row_id: pa.Array, text: str, size: int) -> None:
        parts = self._vocabulary.parts(text)
        numbers = np.concatenate([self._stretches.numbers(part) for part in parts[::2]]) if len(parts) > 1 else self._stretches.numbers(text)
        distinct, times = np.unique(numbers, return_counts=True)
        self._found.append((distinct, times.astype(np.int32)))
        self._ids.append(row_id)
        self._sizes.append(size)
        self._special.append(len(parts) // 2)
        self.size += max(size, 64)

    def batch(self) -> pa.RecordBatch:
        """One row a document; the first one also carries the block's pre-tokens, by falling frequency."""
        words, flat, sizes = self._vocabulary.cut(self._stretches)
        spaced, self._stretches = len(self._stretches.spaced), Stretches()
        starts = np.cumsum(sizes) - sizes
        stretch = np.concatenate([f[0] for f in self._found])
        stretch = (stretch >> 1) + (stretch & 1) * np.int32(spaced)
        times = np.concatenate([f[1] for f in self._found])
        total = np.bincount(stretch, weights=times, minlength=len(sizes))
        falling = np.argsort(-np.bincount(flat, weights=np.repeat(total, sizes), minlength=len(words)), kind="stable")
        rank = np.empty_like(falling)
        rank[falling] = np.arange(len(falling))
        lengths = np.array([len(f[0]) for f in self._found])
        ends = np.cumsum(lengths)
        parts, begin, n = [], 0, len(self)
        while begin < n:  # some documents at a time, as their sorting takes most memory
            end = max(begin + 1, int(np.searchsorted(ends, ends[begin] - lengths[begin] + SORTED, side="right")))
            some = slice(ends[begin] - lengths[begin], ends[end - 1])
            own, doc = sizes[stretch[some]], np.repeat(np.arange(end - begin), lengths[begin:end])
            inner = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
            number = rank[flat[np.repeat(starts[stretch[some]], own) + inner]]
            pair = np.repeat(doc, own) * len(words) + number
            order = np.argsort(pair, kind="stable")
            pair, first = np.unique(pair[order], return_index=True)
            times_of = np.repeat(times[some], own)[order].astype(np.int64)
            summed = np.add.reduceat(times_of, first) if len(first) else times_of
            doc, number = pair // max(1, len(words)), pair % max(1, len(words))
            parts.append(_coded(doc, end - begin, _steps(doc, number), summed))
            begin = end
        columns = [pa.array([self._name] * n, pa.int64()), pa.concat_arrays(self._ids), pa.array(self._sizes, pa.int64()), pa.array(self._special, pa.int64())]
        columns += [pa.concat_arrays(column) for column in zip(*parts)]
        columns.append(pa.array([[words[i] for i in falling]] + [None] * (n - 1), pa.list_(pa.string())))
        return pa.RecordBatch.from_arrays(columns, names=["block", "id", "n_bytes", "special", "numbers", "times", "words"])


def frequencies(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK) -> DataFrame:
    """Documents with the frequencies of their pre-tokens, and the pre-tokens of their block."""
    slim = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, task, done = Vocabulary(vocabulary_path), TaskContext.get().partitionId(), 0
        block = _Block(vocabulary, (task << 32) + done)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            sizes = pc.binary_length(texts).fill_null(0).to_pylist()
            for at, size in enumerate(sizes):
                if len(block) and block.size + max(size, 64) > block_bytes:
                    yield block.batch()
                    done += 1
                    block = _Block(vocabulary, (task << 32) + done)
                block.add(ids.slice(at, 1), texts[at].as_py() or "", size)
        if len(block):
            yield block.batch()

    kind = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(read, f"block long, id {kind}, n_bytes long, special long, numbers binary, times binary, words array<string>")


def _coded(group: np.ndarray, groups: int, *columns: np.ndarray) -> list[pa.Array]:
    """Columns of integers as one binary value for each of the ``groups``; ``group`` rises."""
    out = []
    for values in columns:
        data, sizes = varints(values)
        ends = np.cumsum(np.bincount(group, weights=sizes, minlength=groups))
        offsets = pa.array(np.append(0, ends).astype(np.int32))
        out.append(pa.Array.from_buffers(pa.binary(), groups, [None, offsets.buffers()[1], pa.py_buffer(data.tobytes())]))
    return out


def _steps(group: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Differences of values that rise in each group, the first of which stays."""
    return np.where(np.append(True, group[1:] != group[:-1])[: len(group)], values, np.diff(values, prepend=0))


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The integers of all rows of a coded column, and the row of each."""
    raw = [np.frombuffer(v.as_buffer(), np.uint8) for v in column]
    if not raw:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return from_varints(np.concatenate(raw)), np.repeat(np.arange(len(raw)), [int((r < 128).sum()) for r in raw])


def _risen(steps: np.ndarray, group: np.ndarray) -> np.ndarray:
    """What ``_steps`` came from."""
    values = np.cumsum(steps)
    first = np.flatnonzero(np.append(True, group[1:] != group[:-1])[: len(group)])
    return values - np.repeat(values[first] - steps[first], np.diff(np.append(first, len(group))))


def piece_counts(pre_tokens: DataFrame, vocabulary_path: str) -> DataFrame:
    """Numbers and pieces, coded in rows by ``block``, of the words in rows of ``block``, ``number`` and ``word``.

    Equal words meet in one partition and stand together there, so each is counted once.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, last, pieces = Vocabulary(vocabulary_path), None, 0
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            block, number, count = np.concatenate(held, axis=1)
            held.clear()
            order = np.lexsort((number, block))
            names, group = np.unique(block[order], return_inverse=True)
            columns = _coded(group, len(names), _steps(group, number[order]), count[order])
            return pa.RecordBatch.from_arrays([pa.array(names), *columns], names=["block", "numbers", "pieces"])

        for batch in batches:
            found = []
            for word in batch.column(2).to_pylist():
                if word != last:
                    last, pieces = word, vocabulary.pieces(word)
                found.append(pieces)
            held.append(np.array([batch.column(0).to_numpy(), batch.column(1).to_numpy(), found], np.int64))
            if sum(h.shape[1] for h in held) >= HELD:
                yield flush()
        if held:
            yield flush()

    together = pre_tokens.select("block", "number", "word").repartition("word").sortWithinPartitions("word")
    return together.mapInArrow(count, "block long, numbers binary, pieces binary")


def _add_up(key: tuple, documents: pa.Table, counts: pa.Table) -> pa.Table:
    """Tokens of a block's documents; ``counts`` has the pieces of each of its pre-tokens by number."""
    number = _risen(*_flat(counts["numbers"]))
    pieces = np.zeros(len(number), np.int64)
    pieces[number] = _flat(counts["pieces"])[0]
    steps, doc = _flat(documents["numbers"])
    tokens = documents["special"].to_numpy().copy()
    np.add.at(tokens, doc, pieces[_risen(steps, doc)] * _flat(documents["times"])[0])
    return pa.table({"id": documents["id"], "n_bytes": documents["n_bytes"], "n_tokens": pa.array(tokens, pa.int64())})


def count_tokens(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK) -> DataFrame:
    """``id``, ``n_bytes`` (UTF-8) and ``n_tokens`` of every row."""
    stored = stage(frequencies(docs, vocabulary_path, id_col, text_col, block_bytes), "pre-tokens", "zstd")
    words = stored.where("words IS NOT NULL").select("block", F.posexplode("words").alias("number", "word"))
    counted = piece_counts(words, vocabulary_path).withColumnRenamed("block", "of_block")
    documents = stored.select("block", "id", "n_bytes", "special", "numbers", "times")
    kind = stored.schema["id"].dataType.simpleString()
    return documents.groupBy("block").cogroup(counted.groupBy("of_block")).applyInArrow(_add_up, f"id {kind}, n_bytes long, n_tokens long")

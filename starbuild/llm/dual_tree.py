"""Ranked lexical search by dual trees.

Every document is a sparse vector of term impacts, every item a set of weighted terms, and a score is their
product.  A node of either tree holds the largest value of each coordinate below it, so the product of two
nodes bounds the score of every pair below them.  A pair of nodes is dropped, with all its items and
documents, when its bound is less than the weakest k-th score among its items; equal bounds stay, as equal
scores are ranked by identifier.  What remains is scored exactly.  Scores are integers throughout (floating
point is used as long as it holds them exactly).

Documents are read once for each block of items: tasks store the frequencies of the items' terms and the
document's length; corpus counts are sums over these.  The search is then local to a task: its documents
form trees of up to ``TREE`` documents, ordered by their weightiest term, so like lies by like, and every
tree meets the tree of items with the k-th scores reached so far.  These start from the k-th scores among a
hashed ``1 / FIRST`` of the documents: scores of real pairs, so nothing is lost, and later tasks return
little more than the documents that matter.  A window over what the tasks return gives the ranks.

Items come in blocks of about ``PAIRS`` pairs of item and term, one pass over the documents each; a block
and its k-th scores are all that the driver and the tasks hold of the items.

Defined cases: NULL and empty texts have no terms; a document without any is left out of all counts; rows
with the same item identifier (NULL included) are one item with the terms of all; an item without terms, or
whose terms no document has, gives no rows; repeated document rows rank one after the other; a NULL document
identifier comes after others of its score; without documents or items the result is empty; other columns
are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starbuild.llm.common import stage

#: Documents of one tree, and how many children a node has on each level below the root.
TREE, FANS = 512, (4, 8, 16)
#: Children of an item node.
ITEM_FAN = 8
#: Pairs of item and term that are searched together.
PAIRS = 1_000_000
#: Every so many documents, by hash, set the first k-th scores.
FIRST = 64

_DIGITS, _UPPER, _LOWER = range(0x30, 0x3A), range(0x41, 0x5B), range(0x61, 0x7B)
#: Byte by byte: A to Z in lower case, other ASCII than letters and digits to a space.
_FOLD = bytes(b + 32 if b in _UPPER else b if b in _DIGITS or b in _LOWER or b >= 0x80 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Terms of a text in UTF-8: runs of letters, digits and characters beyond ASCII."""
    return text.translate(_FOLD).split()


def _texts(column: pa.Array) -> Iterator[bytes]:
    for text in column.cast(pa.large_binary()):
        yield text.as_buffer().to_pybytes() if text.is_valid else b""


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct pairs of ``item`` and ``term``."""
    slim = items.select(F.col(f"`{id_col}`").alias("item"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms_of(t))) for t in _texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.binary()))], names=["item", "terms"])

    kind = slim.schema["item"].dataType.simpleString()
    return slim.mapInArrow(read, f"item {kind}, terms array<binary>").select("item", F.explode("terms").alias("term")).distinct()


def _numbers(values) -> pa.Array:
    return pa.array(values, pa.list_(pa.int32()))


def document_vectors(docs: DataFrame, number: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, length ``n`` in terms, and the numbered ``terms`` of each document with their frequencies ``tf``."""
    slim = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, terms, times = [], [], []
            for text in _texts(batch.column(1)):
                words = terms_of(text)
                found = Counter(map(number.get, words))
                found.pop(None, None)
                lengths.append(len(words))
                terms.append(list(found))
                times.append(list(found.values()))
            columns = [batch.column(0), pa.array(lengths, pa.int64()), _numbers(terms), _numbers(times)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "terms", "tf"])

    kind = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(read, f"id {kind}, n long, terms array<int>, tf array<int>")


class ItemNode:
    """Items ``first`` to ``last`` (exclusive), the terms that any of them has, and the nodes below."""

    def __init__(self, first: int, last: int, terms: np.ndarray, below: list[ItemNode]):
        self.first, self.last, self.terms, self.below = first, last, terms, below


def item_tree(sets: list[np.ndarray]) -> ItemNode:
    """The tree over items in the given order; a term's weight is the same for all items, so maxima are unions."""
    nodes = [ItemNode(i, i + 1, terms, []) for i, terms in enumerate(sets)]
    while len(nodes) > 1:
        groups = [nodes[i : i + ITEM_FAN] for i in range(0, len(nodes), ITEM_FAN)]
        nodes = [ItemNode(g[0].first, g[-1].last, np.unique(np.concatenate([n.terms for n in g])), g) for g in groups]
    return nodes[0]


class Searcher:
    """The k best documents of every item among those it is shown."""

    def __init__(self, sets: list[np.ndarray], weight: np.ndarray, n_docs: int, n_terms: int, most: int, least: np.ndarray):
        self._root = item_tree(sets)
        exact = max(int(weight[s].sum()) for s in sets) * 1_000_000 < 1 << 53  # an impact is less than a million
        self._kind = np.float64 if exact else np.int64
        self._weight = weight.astype(self._kind)
        self._n_docs, self._n_terms, self._most = n_docs, n_terms, most
        self._kth = least.copy()
        self._best: dict[int, pa.Table] = {}
        self.scored = 0  # pairs scored exactly

    def _impacts(self, n: np.ndarray, tf: np.ndarray, doc: np.ndarray) -> np.ndarray:
        wide = 50 * int(n.max()) * self._n_docs >= 1 << 63
        scaled = 50 * n.astype(object if wide else np.int64) * self._n_docs
        m = 50 + (scaled // self._n_terms).astype(np.int64)
        return (1_000_000_000 * tf) // (1000 * tf + 20 * m[doc])

    def show(self, ids: pa.Array, n: np.ndarray, terms: np.ndarray, tf: np.ndarray, sizes: np.ndarray) -> None:
        """A tree of documents: their identifiers, lengths, and postings document by document."""
        docs, doc = len(ids), np.repeat(np.arange(len(ids)), sizes)
        if not len(terms):
            return
        impact = self._impacts(n, tf.astype(np.int64), doc)
        worth = self._weight[terms] * impact
        heaviest = np.zeros(docs, np.int64)
        by_worth = np.lexsort((worth, doc))
        heaviest[doc[by_worth]] = terms[by_worth]  # the last one of a document stands
        order = np.argsort(heaviest, kind="stable")
        place = np.empty(docs, np.int64)
        place[order] = np.arange(docs)
        self._ids, self._order = ids, order
        known, row = np.unique(terms, return_inverse=True)
        self._row = np.full(len(self._weight), -1, np.int64)
        self._row[known] = np.arange(len(known))
        leaf = np.zeros((len(known), -(-docs // FANS[-1]) * FANS[-1]), self._kind)
        leaf[row, place[doc]] = impact
        levels = [leaf]
        for fan in reversed(FANS):
            below = levels[0]
            width = -(-below.shape[1] // fan)
            if width * fan > below.shape[1]:
                below = np.pad(below, ((0, 0), (0, width * fan - below.shape[1])))
            levels.insert(0, below.reshape(len(known), width, fan).max(axis=2))
        self._levels = levels
        self._meet(self._root, 0, np.arange(levels[0].shape[1]))

    def _meet(self, node: ItemNode, level: int, nodes: np.ndarray) -> None:
        """Bound ``node`` against ``nodes`` of a level and go on below both where the bound reaches."""
        rows = self._row[node.terms]
        there = rows >= 0
        if not there.any():
            return
        values = self._levels[level]
        columns = values[rows[there]] if len(nodes) == values.shape[1] else values[np.ix_(rows[there], nodes)]
        bounds = self._weight[node.terms[there]] @ columns
        reach = max(1, int(self._kth[node.first : node.last].min()))
        near = bounds >= reach
        if not near.any():
            return
        nodes = nodes[near]
        last = level == len(FANS)
        if last and not node.below:
            self.scored += len(bounds)
            self._take(node.first, bounds[near], nodes)
            return
        if not last:
            fan = FANS[level]
            nodes = (nodes[:, None] * fan + np.arange(fan)).ravel()
            nodes = nodes[nodes < self._levels[level + 1].shape[1]]
        for below in node.below or [node]:
            self._meet(below, level + (not last), nodes)

    def _take(self, item: int, scores: np.ndarray, places: np.ndarray) -> None:
        found = pa.table({"id": self._ids.take(pa.array(self._order[places])), "score": pa.array(scores.astype(np.int64))})
        if item in self._best:
            found = pa.concat_tables([self._best[item], found])
        order = pc.sort_indices(found, [("score", "descending"), ("id", "ascending")], null_placement="at_end")
        self._best[item] = found = found.take(order[: self._most]).combine_chunks()
        if found.num_rows == self._most:
            self._kth[item] = max(self._kth[item], found["score"][self._most - 1].as_py())

    def best(self) -> Iterator[tuple[int, pa.Table]]:
        yield from self._best.items()


def _searched(vectors: DataFrame, make: dict) -> DataFrame:
    """Rows ``item`` (number), ``id``, ``score``: the best of each task."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(**make)
        for batch in batches:
            for first in range(0, batch.num_rows, TREE):
                part = batch.slice(first, TREE)
                terms, times = part.column(2), part.column(3)
                sizes = pc.list_value_length(terms).to_numpy(zero_copy_only=False)
                searcher.show(part.column(0), part.column(1).to_numpy(), terms.flatten().to_numpy(), times.flatten().to_numpy(), sizes)
        for item, found in searcher.best():
            columns = [pa.array(np.full(found.num_rows, item, np.int32)), *[found[c].combine_chunks() for c in ("id", "score")]]
            yield pa.RecordBatch.from_arrays(columns, names=["item", "id", "score"])

    kind = vectors.schema["id"].dataType.simpleString()
    return vectors.select("id", "n", "terms", "tf").mapInArrow(search, f"item int, id {kind}, score long")


def _ranked(found: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _weights(df_of: dict[int, int], terms: int, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df_of.get(t, 0) + 1))) for t in range(terms)], np.int64)


def _search_block(docs: DataFrame, pairs: DataFrame, most: int, doc_id: str, doc_text: str) -> DataFrame | None:
    """The ranked documents of one block of items."""
    items = sorted(pairs.groupBy("item").agg(F.sort_array(F.collect_list("term")).alias("terms")).collect(), key=lambda r: (r[0] is None, r[0]))
    number: dict[bytes, int] = {}
    for r in items:
        for t in r.terms:
            number.setdefault(bytes(t), len(number))
    vectors = stage(document_vectors(docs, number, doc_id, doc_text), "term-vectors")
    n_docs, n_terms = vectors.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not n_terms:
        return None
    counted = vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # one row a term of the block
    weight = _weights(dict(map(tuple, counted)), len(number), n_docs)
    sets = [np.array([number[bytes(t)] for t in r.terms]) for r in items]
    # neighbours in the tree share their weightiest term
    order = sorted(range(len(sets)), key=lambda i: (int(sets[i][np.argmax(weight[sets[i]])]), i))
    sets, ids = [np.sort(sets[i]) for i in order], [items[i][0] for i in order]
    make = {"sets": sets, "weight": weight, "n_docs": n_docs, "n_terms": n_terms, "most": most, "least": np.zeros(len(sets), np.int64)}
    vectors = vectors.where(F.size("terms") > 0)
    first = _ranked(_searched(vectors.where(F.pmod(F.xxhash64("id"), F.lit(FIRST)) == 0), make), most)
    for item, score in first.where(F.col("rank") == most).select("item", "score").collect():
        make["least"][item] = score
    kind = pairs.schema["item"].dataType
    names = docs.sparkSession.createDataFrame(list(enumerate(ids)), f"item int, item_id {kind.simpleString()}")
    return _ranked(_searched(vectors, make), most).join(F.broadcast(names), "item").select("item_id", "rank", F.col("id").alias("doc_id"), "score")


def search(
    items: DataFrame, docs: DataFrame, most: int = 50, item_id: str = "item_id", item_text: str = "text", doc_id: str = "doc_id", doc_text: str = "text", pairs: int = PAIRS
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score`` of each item's ``most`` best documents with a score above 0."""
    terms = stage(item_terms(items, item_id, item_text), "item-terms")
    blocks = max(1, math.ceil(terms.count() / pairs))
    parts = []
    for b in range(blocks):
        of_block = terms.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b)
        if blocks > 1 and of_block.isEmpty():
            continue
        parts.append(_search_block(docs, of_block, most, doc_id, doc_text) if terms.take(1) else None)
    parts = [p for p in parts if p is not None]
    if parts:
        return reduce(DataFrame.unionByName, parts)
    kinds = [df.schema[c].dataType.simpleString() for df, c in ((items, item_id), (docs, doc_id))]
    return docs.sparkSession.createDataFrame([], f"item_id {kinds[0]}, rank int, doc_id {kinds[1]}, score long")

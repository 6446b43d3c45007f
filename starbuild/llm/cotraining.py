"""Quality classifier by co-training.

Two views of a document are judged apart: the words of its text (hashed presence) and its
page metadata (language, source, and layout counts that name no word).  Both learn from
a bounded sample of labelled documents.  In each round, each view scores all documents
without a label and labels those that it is surest of, and the *other* view learns from
them as well.  At the end both are calibrated on labelled documents held out from training, and a
calibrated sum of their logits scores every document: a head for quality and one for
toxic text.

The labelled sample are the rows with the smallest hash of their identifier, at most
``LABELLED``; its features and those of the at most ``HANDED`` documents that a view hands
over per round and end come to the driver, where fitting takes the same time for any
corpus.  Texts are read once, into stored features; a round and the last scoring are passes
over these with a broadcast of fixed size.  Documents with the same features are handed
over once, so copies do not crowd out others.

Defined cases: NULL text has no words; NULL language or source is a value of its own;
labels that are NULL or whose document is missing are not used (a document is unlabelled
for a head whose label it lacks); with labels of one kind
only, that kind's share is every document's score; documents with repeated identifiers
are scored each; without documents or labels the result is empty or the score 0.5.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starbuild.llm.common import stage

#: Most labelled documents that are used for fitting.
LABELLED = 6000
WORD_BITS = 20
META_BITS = 12
COUNTS = 7
ROUNDS = 3
#: Most documents, of all without a label, that a view hands to the other per round and end.
HANDED = 200
#: Every so many labelled documents one is held out for calibration.
HELD_OUT = 4
STEPS = 200
#: A feature takes part if it occurs so often and its share of positives is off by so many standard errors.
LEAST_SEEN, LEAST_OFF = 4, 3.5
#: A view hands over a label only if it gives it this calibrated chance.
SURE = 0.95
HEADS = ("quality", "toxic")
MEMORY = 600_000

_STRIP = b".,;:!?\"'()[]{}<>*#$%&|"


class Features:
    """Hashed word presence and metadata of a document."""

    def __init__(self) -> None:
        self._slot: dict[bytes, int] = {}

    def words(self, words: set[bytes]) -> np.ndarray:
        known = self._slot
        if len(known) > MEMORY:
            known.clear()
        out = []
        for w in words:
            slot = known.get(w)
            if slot is None:
                slot = known[w] = zlib.crc32(w.strip(_STRIP) or w) >> (32 - WORD_BITS)
            out.append(slot)
        return np.unique(np.array(out, np.int32))

    def both(self, text: bytes, lang: str | None, source: str | None) -> tuple[np.ndarray, np.ndarray]:
        words = text.lower().split()
        n, size = len(words), len(text)
        lines = text.split(b"\n")
        upper = size - len(text.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
        marks = size - len(text.translate(None, b"#*$%&|<>!"))
        distinct = set(words)
        counts = [
            np.log1p(n) / 10,
            (size / n if n else 0) / 10,
            np.log1p(100 * marks / (n + 10)),
            np.log1p(100 * upper / (size + 10)),
            len(distinct) / (n + 1),
            np.log1p(len(lines)) / 10,
            len(set(lines)) / len(lines),
        ]
        names = [f"lang={lang}", f"source={source}", f"both={lang}|{source}"]
        # each count also as steps, so that the linear model can bend
        names += [f"{i}:{int(c * 8)}" for i, c in enumerate(counts)]
        slots = np.unique([zlib.crc32(x.encode()) >> (32 - META_BITS) for x in names]).astype(np.int32)
        return self.words(distinct), slots


def _columns(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    names = {"id": id_col, "text": text_col, "lang": lang_col, "source": source_col}
    kind = {"id": None}
    return docs.select(*[(F.col(f"`{c}`") if n in kind else F.col(f"`{c}`").cast("string")).alias(n) for n, c in names.items()])


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[bytes, str | None, str | None]]:
    texts = batch.column("text").cast(pa.large_binary())
    for text, lang, source in zip(texts, batch.column("lang").to_pylist(), batch.column("source").to_pylist()):
        yield text.as_buffer().to_pybytes() if text.is_valid else b"", lang, source


def _featured(docs: DataFrame) -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            found = [features.both(*row) for row in _rows(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([w.tobytes() for w, _ in found], pa.binary()), pa.array([m.tobytes() for _, m in found], pa.binary())],
                names=["id", "words", "meta"],
            )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(read, f"id {kind}, words binary, meta binary")


class Sparse:
    """Rows of hashed features."""

    def __init__(self, rows: list[bytes], bits: int):
        parts = [np.frombuffer(r, np.int32) for r in rows]
        self.n, self.width = len(parts), 1 << bits
        self.row = np.repeat(np.arange(self.n), [len(p) for p in parts])
        self.col = np.concatenate(parts) if parts else np.empty(0, np.int32)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.col], self.n) + w[-1]


def _sparse(batch: pa.RecordBatch) -> tuple[Sparse, Sparse]:
    """Both views of stored features."""
    return Sparse(batch.column("words").to_pylist(), WORD_BITS), Sparse(batch.column("meta").to_pylist(), META_BITS)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_linear(x: Sparse, y: np.ndarray, weight: np.ndarray, decay: float = 1e-4) -> np.ndarray:
    """Logistic regression on the rows with a weight, over the features that tell labels apart."""
    used = weight[x.row] > 0
    row, col = x.row[used], x.col[used]
    total = weight.sum()
    share = np.clip((y * weight).sum() / total, 0.01, 0.99)
    seen = np.bincount(col, weight[row], x.width)
    hits = np.bincount(col, (weight * y)[row], x.width)
    off = np.abs(hits - seen * share) / np.sqrt(np.maximum(seen, 1) * share * (1 - share))
    chosen = np.flatnonzero((seen >= LEAST_SEEN) & (off >= LEAST_OFF))
    place = np.full(x.width, -1)
    place[chosen] = np.arange(len(chosen))
    inside = place[col] >= 0
    row, col = row[inside], place[col[inside]]
    size = len(chosen)
    w, m, v = (np.zeros(size + 1) for _ in range(3))
    for step in range(1, STEPS + 1):  # Adam
        z = np.bincount(row, w[col], x.n) + w[-1]
        error = (_sigmoid(z) - y) * weight / total
        grad = np.append(np.bincount(col, error[row], size), error.sum()) + decay * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    out = np.zeros(x.width + 1)
    out[chosen], out[-1] = w[:-1], w[-1]
    return out


def calibrate(z: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights and intercept of a logistic regression on few columns ``z``, by Newton steps with a small ridge."""
    x = np.column_stack([z, np.ones(len(z))])
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = _sigmoid(x @ w)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        w -= np.linalg.solve(hessian, x.T @ (p - y) + 1e-2 * w)
    return w


class Head:
    """Both views of one label; rows that were handed over follow the labelled ones."""

    def __init__(self, label: np.ndarray):
        self.label = label
        self.known = np.flatnonzero(~np.isnan(label))
        self.kinds = np.unique(label[self.known])
        self.held = self.known[::HELD_OUT]
        train = np.setdiff1d(self.known, self.held)
        start = {int(i): label[i] for i in train}
        #: Per view, the labels that it learns from, by row.
        self.given = [dict(start), dict(start)]
        self.weights: list[np.ndarray] = []
        self.scales: list[np.ndarray] = []

    def fit(self, views: tuple[Sparse, Sparse]) -> None:
        self.weights = []
        for x, given in zip(views, self.given):
            rows = np.fromiter(given, int, len(given))
            y, use = np.zeros(x.n), np.zeros(x.n)
            y[rows] = list(given.values())
            use[rows] = np.where(rows < len(self.label), 1.0, 0.5)  # a guess counts half
            self.weights.append(fit_linear(x, y, use))
        logits = [x.dot(w)[self.held] for x, w in zip(views, self.weights)]
        self.scales = [calibrate(z[:, None], self.label[self.held]) for z in logits]

    def model(self, views: tuple[Sparse, Sparse]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Weights of both views and of their sum."""
        if len(self.kinds) < 2:
            share = np.clip(self.kinds[0] if len(self.kinds) else 0.5, 0.01, 0.99)
            return np.zeros(views[0].width + 1), np.zeros(views[1].width + 1), np.array([0, 0, np.log(share / (1 - share))])
        z = np.column_stack([x.dot(w)[self.held] for x, w in zip(views, self.weights)])
        return *self.weights, calibrate(z, self.label[self.held])


def _surest(featured: DataFrame, labelled: DataFrame, heads: dict[str, Head], most: int) -> dict[tuple[str, int], list]:
    """Per head and view, the ``most`` documents without this label at either end of its score: (end, key, logit)."""
    model = featured.sparkSession.sparkContext.broadcast({h: [w.astype(np.float32) for w in x.weights] for h, x in heads.items()})
    columns = {(h, v): f"z_{h}_{v}" for h in heads for v in range(2)}

    def logits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            views = _sparse(batch)
            out = [pa.array(np.round(views[v].dot(model.value[h][v]), 6)) for h, v in columns]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("key"), *out], names=["id", "key", *columns.values()])

    kind = featured.schema["id"].dataType.simpleString()
    scored = featured.mapInArrow(logits, f"id {kind}, key long, " + ", ".join(f"{c} double" for c in columns.values()))
    scored = scored.join(labelled, "id", "left")
    # one row per distinct document; a document with this label has no say
    best = scored.groupBy("key").agg(*[F.max(F.when(F.col(f"`{h}`").isNull(), F.col(c))).alias(c) for (h, _), c in columns.items()])
    best = stage(best, "cotraining-scores")
    ends = []
    for (h, v), c in columns.items():
        for end in (1, 0):
            order = F.col(c).desc() if end else F.col(c).asc()
            picked = best.where(F.col(c).isNotNull()).orderBy(order, "key").limit(most)
            ends.append(picked.select(F.lit(h).alias("head"), F.lit(v).alias("view"), F.lit(end).alias("end"), "key", F.col(c).alias("z")))
    found: dict[tuple[str, int], list] = {k: [] for k in columns}
    for r in reduce(DataFrame.union, ends).collect():
        found[r["head"], r["view"]].append((r["end"], r["key"], r["z"]))
    for rows in found.values():
        rows.sort(key=lambda r: (r[0], -r[2] if r[0] else r[2], r[1]))
    return found


def fit(featured: DataFrame, labels: DataFrame, id_col: str = "doc_id", heads: tuple[str, ...] = HEADS) -> dict[str, tuple]:
    """A model per label column; ``featured`` as from ``_featured``, stored."""
    place = F.xxhash64("id")
    given = labels.select(F.col(f"`{id_col}`").alias("id"), *[F.col(f"`{h}`").cast("double").alias(h) for h in heads]).where("id IS NOT NULL")
    given = stage(given.groupBy("id").agg(*[F.max(h).alias(h) for h in heads]), "cotraining-labels")
    chosen = given.orderBy(place, "id").limit(LABELLED).collect()
    spark = featured.sparkSession
    # at most LABELLED identifiers
    wanted = spark.createDataFrame([(r["id"],) for r in chosen], given.select("id").schema)
    # one document per identifier, as features only
    rows = featured.join(F.broadcast(wanted), "id").groupBy("id").agg(F.min(F.struct("words", "meta")).alias("x")).collect()
    rows.sort(key=lambda r: r["id"])
    words, meta = [r["x"]["words"] for r in rows], [r["x"]["meta"] for r in rows]
    model = {}
    for head in heads:
        known = {r["id"]: r[head] for r in chosen if r[head] is not None}
        model[head] = Head(np.array([known.get(r["id"], np.nan) for r in rows], float))
    taught = {h: m for h, m in model.items() if len(m.kinds) == 2}
    row_of: dict[int, int] = {}
    views = Sparse(words, WORD_BITS), Sparse(meta, META_BITS)
    for turn in range(ROUNDS + 1 if taught else 0):
        for m in taught.values():
            m.fit(views)
        if turn == ROUNDS:
            break
        # those already handed over may be among the surest
        surest = _surest(featured, given, taught, HANDED * (turn + 1))
        handed = []
        for (h, view), found in surest.items():
            m, (slope, level) = taught[h], taught[h].scales[view]
            other = m.given[1 - view]
            for end in (1, 0):
                fresh = [(key, z) for e, key, z in found if e == end and row_of.get(key, -1) not in other][:HANDED]
                for key, z in fresh:
                    chance = _sigmoid(slope * z + level)
                    if (chance if end else 1 - chance) >= SURE:
                        handed.append((m, 1 - view, key, end))
        missing = sorted({key for _, _, key, _ in handed} - row_of.keys())
        if missing:
            keys = F.broadcast(spark.createDataFrame([(k,) for k in missing], "key long"))
            fetched = featured.join(keys, "key").groupBy("key").agg(F.min(F.struct("words", "meta")).alias("x")).collect()
            for r in sorted(fetched, key=lambda r: r["key"]):
                row_of[r["key"]] = len(words)
                words.append(r["x"]["words"])
                meta.append(r["x"]["meta"])
            views = Sparse(words, WORD_BITS), Sparse(meta, META_BITS)
        for m, view, key, end in handed:
            m.given[view].setdefault(row_of[key], end)
    return {h: tuple(w.astype(np.float32) for w in m.model(views)) for h, m in model.items()}


def score(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source"
) -> DataFrame:
    """Per document: ``text_logit`` and ``meta_logit`` of quality, calibrated ``quality`` and ``toxic``, and ``kept``."""
    slim = _columns(docs, id_col, text_col, lang_col, source_col)
    featured = stage(_featured(slim).withColumn("key", F.xxhash64("words", "meta")), "cotraining-features")
    model = docs.sparkSession.sparkContext.broadcast(fit(featured, labels, id_col))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads = model.value
        for batch in batches:
            views, logits, chance = _sparse(batch), [], []
            for h in HEADS:
                *weights, mix = heads[h]
                a, b = (x.dot(w) for x, w in zip(views, weights))
                logits.append((a, b))
                chance.append(_sigmoid(a * mix[0] + b * mix[1] + mix[2]))
            columns = [pa.array(np.round(c, 6)) for c in (*logits[0], *chance)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], names=["id", "text_logit", "meta_logit", "quality", "toxic"])

    kind = slim.schema["id"].dataType.simpleString()
    judged = featured.mapInArrow(judge, f"id {kind}, text_logit double, meta_logit double, quality double, toxic double")
    return judged.withColumn("kept", (F.col("quality") >= 0.5) & (F.col("toxic") < 0.5))

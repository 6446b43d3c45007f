"""Dual-tree search against scoring every pair."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from starbuild.llm import dual_tree
from tests.llm.conftest import HOSTILE

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(items, docs, most=50):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n_docs, length = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    sets = {}
    for i, t in items:
        sets.setdefault(i, set()).update(terms(t))
    out = {}
    for item, own in sets.items():
        scored = []
        for i, bag, n in bags:
            m = 50 + (50 * n * n_docs) // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * bag[t]) // (1000 * bag[t] + 20 * m))
                for t in own if t in bag
            )
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        for rank, (score, _, _, i) in enumerate(sorted(scored, key=lambda s: s[:3])[:most], 1):
            out[item, rank] = (i, -score)
    return out


def found(df):
    rows = df.collect()
    out = {(r.item_id, r["rank"]): (r.doc_id, r.score) for r in rows}
    assert len(out) == len(rows)
    return out


def test_terms():
    text = "Ab-CÉ x_1\x00y\x7fz w ١ Ⅷ"
    assert [t.decode() for t in dual_tree.terms_of(text.encode())] == terms(text)


@pytest.mark.parametrize("tree", [512, 7])
def test_search_equals_scoring_every_pair(spark, monkeypatch, tree):
    monkeypatch.setattr(dual_tree, "TREE", tree)
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(300)]
    share = 1 / np.arange(1, 301)
    draw = lambda n: " ".join(rng.choice(words, n, p=share / share.sum()))
    docs = [(i, draw(int(rng.integers(0, 60)))) for i in range(1500)]
    docs += [(2000 + i, docs[i % 3][1]) for i in range(300)]  # ties far beyond the ranks
    items = [(i, draw(8)) for i in range(40)] + [(50, ""), (51, None), (52, "unheard of"), (0, "w299 w299 w7")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    q = spark.createDataFrame(items, "item_id long, text string")
    want = brute(items, docs)
    assert found(dual_tree.search(q, d)) == want
    assert found(dual_tree.search(q, d, pairs=60)) == want  # several blocks of items


def test_search_prunes():
    """Documents and items that share no rare term are never scored one by one."""
    rng = np.random.default_rng(5)
    sets = [np.array([i, 200 + i % 20]) for i in range(64)]
    weight = np.array([5000] * 200 + [40] * 20)
    import pyarrow as pa

    searcher = dual_tree.Searcher(sets, weight, 5120, 51200, 5, np.zeros(64, np.int64))
    for block in range(10):
        own = [np.unique(np.array([int(rng.integers(0, 64)), 200 + int(rng.integers(0, 20))])) for _ in range(512)]
        sizes = np.array([len(o) for o in own])
        flat = np.concatenate(own)
        searcher.show(pa.array(np.arange(512) + 512 * block), np.full(512, 10), flat, np.ones(len(flat), np.int64), sizes)
    assert searcher.scored < 0.3 * 64 * 5120


def test_search_on_hostile_rows(spark, hostile, empty):
    items = spark.createDataFrame([(1, "the same text"), (None, "ten words é"), (3, "word"), (4, None), (1, "Deich x")], "item_id long, text string")
    for c in ("item", "term", "rank", "score", "doc_id"):
        items = items.withColumn(c, F.lit(c))
    clash = hostile.withColumn("item", F.lit(1)).withColumn("n", F.lit(1)).withColumn("tf", F.lit(1)).withColumn("score", F.lit(1))
    want = brute([(1, "the same text Deich x"), (None, "ten words é"), (3, "word"), (4, None)], [(r[0], r[1]) for r in HOSTILE])
    assert found(dual_tree.search(items, clash)) == want
    assert dual_tree.search(items, empty).collect() == []
    assert dual_tree.search(items.limit(0), hostile).collect() == []
    assert dual_tree.search(items.where("item_id = 4"), hostile).collect() == []

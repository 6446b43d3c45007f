"""Token counts against the library's own encoding."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starbuild.llm import queries, token_counts
from tests.llm.conftest import HOSTILE

PATH = queries.tokenizer_path(queries.BYTE_TOKENIZER)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_stretches_keep_pre_tokens(library, monkeypatch):
    """Cutting stretch by stretch gives the pre-tokens of the whole text, whatever white space and signs it has."""
    rng = random.Random(3)
    signs = " \n\t\r\x0b\x1c\x1f\x85\xa0  　᠎​'\"sdtmrevl.,1٣²é日本ßA z-\U0001f600́"
    vocabulary = token_counts.Vocabulary(PATH)
    monkeypatch.setattr(token_counts, "TOGETHER", 4)
    for _ in range(1500):
        texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(30))) for _ in range(3)]
        stretches = token_counts.Stretches()
        numbers = [stretches.numbers(t) for t in texts]
        words, flat, sizes = vocabulary.cut(stretches)
        ends = sizes.cumsum()
        for text, own in zip(texts, numbers):
            places = [(n >> 1) + (n & 1) * len(stretches.spaced) for n in own.tolist()]
            got = sorted(words[i] for p in places for i in flat[ends[p] - sizes[p] : ends[p]])
            assert got == sorted(t for t, _ in library.pre_tokenizer.pre_tokenize_str(text)), repr(text)


def test_varints():
    values = np.array([0, 1, 127, 128, 16383, 16384, 2**21, 2**28 - 1, 2**28, 2**34])
    data, sizes = token_counts.varints(values)
    assert token_counts.from_varints(data).tolist() == values.tolist() and sizes.sum() == len(data)
    assert token_counts.from_varints(token_counts.varints(values[:0])[0]).tolist() == []


def check(rows, texts, library):
    want = {}
    for i, text in texts:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        want.setdefault(i, []).append((len((text or "").encode()), n))
    got = {}
    for r in rows:
        got.setdefault(r.id, []).append((r.n_bytes, r.n_tokens))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_counts_equal_the_library(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = queries.op12_token_counts(spark, "/root/testdata/sf0.01").withColumnRenamed("doc_id", "id").collect()
    check(rows, [(r.doc_id, r.text) for r in docs.collect()], library)
    assert all(r.over_limit == (r.n_tokens > 512) for r in rows)


def test_counts_on_hostile_rows(spark, library, hostile, empty):
    for block in (100, token_counts.BLOCK):  # many blocks, one block
        rows = token_counts.count_tokens(hostile.withColumn("block", F.lit(1)).withColumn("words", F.lit(2)), PATH, block_bytes=block).collect()
        check(rows, [(r[0], r[1]) for r in HOSTILE], library)
    assert token_counts.count_tokens(empty, PATH).collect() == []
    nothing = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert [(r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(nothing, PATH).collect()] == [(0, 0)] * 2
    odd = [
        "<|endoftext|>", "a <|endoftext|> b", "x<|endoftext|><|endoftext|>\n\ny ", "<|endoftext", "<|endoftext|>\n a", "  \n <|endoftext|>  ",
        "line\n line\n\n  line \t\n", " lead", "trail ", "\n", " ", "x" * 200_000, "it's we'll I'M ''s 's", "日本 語　x y",
    ]
    df = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    check(token_counts.count_tokens(df, PATH).collect(), list(enumerate(odd)), library)


def test_other_kinds_of_vocabulary_are_refused():
    with pytest.raises(ValueError):
        token_counts.Vocabulary(queries.tokenizer_path())

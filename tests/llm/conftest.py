import pytest

#: Documents with every hostile case: NULLs, empty, ties, repeats, very long text, clashing column names.
HOSTILE = [
    (1, "The same text here.", "en", "a"),
    (2, "the SAME text here.", "en", "a"),
    (2, "the SAME text here.", "en", "a"),
    (3, None, "en", "b"),
    (4, "", None, None),
    (5, "É é " * 40, "fr", "b"),
    (None, "no identifier but words enough to count as a text of ten words", "en", None),
    (None, "no identifier but words enough to count as a text of ten words", "en", None),
    (6, " \t\n\x0b ", "en", "a"),
    (7, "word " * 30_000 + "end.", "en", "a"),
    (8, "one\ntwo\none\n\ntwo words | and & more # of * them $ all % < >", "de", "b"),
    (9, "Zwölf Boxkämpfer jagen Viktor quer über den großen Sylter Deich.\x1c\x85 x", "de", "b"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def hostile(spark):
    df = spark.createDataFrame(HOSTILE, SCHEMA)
    # columns that clash with working names
    extra = {c: f"'{c}'" for c in ("row", "kept", "k", "g", "id", "fp", "norm", "sha", "place", "copies", "n_words", "size")}
    return df.selectExpr("*", *[f"{v} AS {c}" for c, v in extra.items()])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def texts(sample):
    return {r.doc_id: r.text or "" for r in sample.collect()}

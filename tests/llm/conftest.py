import pytest
from pyspark.sql import types as T

LONG = ("The long text of many words goes on, and on. " * 9000).strip()
#: id, text: nulls, empty and blank texts, repeated rows and ids, no letters, special tokens, a very long text.
ODD = [
    (1, "The cat sat on the mat. It was warm.\nThe cat sat on the mat.\n"), (2, None), (3, ""), (4, " \t\n\v\f\r "),
    (5, "repeated row with some words in it"), (5, "repeated row with some words in it"), (5, "the same id, another text"),
    (None, "a row without an id"), (None, None), (8, "12345 67890 !!! ###"), (9, "one"),
    (10, "a<|endoftext|>b <|startoftext|>  c"), (11, LONG), (12, "ÇA VA? Été où Σας ΑΣ ﬁn é 日本 😀  x"), (13, "x" * 5000),
    (2 ** 53 + 1, "an id beyond the exact range of doubles"),
]
CLASHES = ["lang", "source", "score", "n", "class", "group", "words", "chunk", "train", "held_out", "kept", "task", "h1", "paths",
           "text_hash", "_at", "node", "root", "size", "y", "place"]


@pytest.fixture(scope="session")
def odd(spark):
    """A documents table with every odd case and extra columns whose names the operators use inside."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           *(T.StructField(c, T.StringType()) for c in CLASHES)])
    rows = [(i, t, *([None if k % 3 else "en"] * len(CLASHES))) for k, (i, t) in enumerate(ODD)]
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.filter("false")

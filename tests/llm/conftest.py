import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null ids and texts, empty and blank texts, repeated rows, ties, one long text, odd characters."""
    long = " ".join(f"word{k % 977} and.\nmore{k % 13}" for k in range(4_000))
    texts = [
        (5, "one two three four five six. Seven!\nLine two"), (5, "one two three four five six. Seven!\nLine two"),
        (5, "another text with the same id"), (None, "no id"), (None, "no id"), (None, None), (7, None), (8, ""),
        (9, "   \n "), (10, long), (11, "日本語のテキスト 😀 é"), (12, "<|endoftext|> x <s> </s>"), (13, "x"),
        (14, "one two three four five six. Seven!\nLine two"), (-3, "write to a.b@c.org or A.B@C.ORG, 10.0.0.1"),
    ]
    return spark.createDataFrame([(i, t, None, None, None) for i, t in texts], DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)

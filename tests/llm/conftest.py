import pytest

ODD = [
    "", " ", "\n", "a", "a  b", "a \n b\n\n  c ", "it's we'll 'silly ''s 's x'r 're", "don't I'd you've  's\n's",
    "<|endoftext|>", "x<|endoftext|> y<|endoftext|><|endoftext|>", "aaaaaaaaaaaaaa", "日本語 テキスト １２３ ½ ²",
    "é naïve x y　z", "tab\t\tx \t y", "12ab34 $%^ &*()!!", "🙂🙂 👍🏽x", "'", "a'", "a'l", "x\r\n\r\ny", " " * 50 + "a",
]


@pytest.fixture
def docs(spark):
    """A table with nulls, empties, ties, a very long text and clashing columns."""

    def make(texts, ids=None):
        ids = list(range(len(texts))) if ids is None else ids
        rows = [(i, t, "en", "s", 1, 2, 3) for i, t in zip(ids, texts, strict=True)]
        schema = "doc_id bigint, text string, lang string, source string, n_chars int, length int, row int"
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture
def odd(docs):
    texts = [*ODD, None, "the of " * 40_000, "same", "same"]
    ids = [*range(len(ODD)), 100, 101, 102, 102]
    ids[3] = None
    return docs(texts, ids)

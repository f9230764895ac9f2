import pytest


@pytest.fixture(scope="session")
def texts():
    """Nulls, empty and blank texts, ties, repeats, a very long text, several scripts."""
    words = [f"w{i * 7919 % 997}" for i in range(400)]
    base = " ".join(words[:80])
    return [
        (1, base),
        (2, base),
        (3, base.replace("w0 ", "W0\t", 1).upper()),
        (4, " ".join(words[:78] + ["other", "end"])),
        (5, None),
        (6, ""),
        (7, " \n\t "),
        (8, "one two"),
        (9, "ONE  two"),
        (10, "don't we'll  it's 1234 été ñ 漢字 　 x!?'s\n\n end"),
        (11, " ".join(words * 60)),
        (None, "a text without key and some words in it"),
        (12, " ".join(words[100:180])),
        (12, " ".join(words[100:180])),
        (13, "'" * 50 + " " * 3 + "é" * 1000),
    ]


@pytest.fixture(scope="session")
def docs(spark, texts):
    """Rows of `texts` with columns whose names the operators use inside."""
    rows = [(k, t, "fr" if i % 3 else None, f"host{i % 2}", len(t) if t is not None else None, i, "x") for i, (k, t) in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row long, host string")


@pytest.fixture(scope="session")
def empty(docs):
    return docs.filter("doc_id < 0")

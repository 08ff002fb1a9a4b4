import random

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def real_docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and long texts, ties, repeated rows, little and endless repetition."""
    r = random.Random(3)
    words = ["".join(r.choice("abcdeéß") for _ in range(r.randint(1, 7))) for _ in range(400)]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    base, shared = text(300), text(90)
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "One"), (5, "one"), (6, "two words"), (None, None)]
    rows += [(10, base), (11, base), (11, base), (None, base), (None, "one"), (7, "a b c d")]
    rows += [(20 + i, " ".join(base.split()[: 300 - i])) for i in range(8)]
    rows += [(40 + i, text(60) + " " + shared + "\n " + text(40 + i)) for i in range(6)]
    rows += [(50, "x" * 3000), (51, "x" * 450), (52, "word " * 700), (53, "word " * 30), (54, "é" * 900)]
    rows += [(55, text(20_000)), (56, "a\x00b  c 　d\xa0e\x1cf"), (57, "<|endoftext|> it's 12 !!")]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """The odd rows with columns whose names the operators use inside."""
    extra = "lang string, source string, n_chars long, n int, part int, batch int, keys string, label int"
    rows = [(*row, None, "s", len(row[1] or ""), 1, 2, 3, "k", None) for row in odd_rows]
    return spark.createDataFrame(rows, f"doc_id long, text string, {extra}").repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")


def multiset(rows):
    return sorted(map(repr, rows))

from __future__ import annotations

import random

import pytest

#: Columns that bear the operators' own working names.
CLASHING = "did long, rk long, h long, row long, key long, words long, n_tokens long, _document long"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"


def prose(seed: int, n: int, vocabulary: int = 3000) -> str:
    choose = random.Random(seed)
    return " ".join(f"w{choose.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def odd_texts() -> list[tuple]:
    """Nulls, empty and very long texts, ties, repeated rows, copies, near copies, repetitions."""
    shared = prose(1, 80)
    long = prose(2, 30_000)
    base = prose(3, 120)
    near = base.split()
    near[60] = "changed"
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (6, "just four words here"),
        (7, base), (8, base), (9, " ".join(near)), (9, " ".join(near)), (10, base.upper()),
        (11, f"{prose(4, 40)}\n{shared}\n{prose(5, 40)}"), (12, f"{prose(6, 30)} {shared}"),
        (13, shared), (None, base), (None, None), (14, long), (15, long + " end"),
        (16, "spin " * 900), (17, "ab " * 500 + "cd " * 500), (18, "ab " * 400),
        (19, "líne 日本語 ümlaut\n" * 60), (20, f"# $ % & | < > * {prose(7, 60)}"),
        (21, "a  b   c d 　 e\x1cf\x85g don't <|endoftext|> 123,456.7\r\n\r\n  x "),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_texts):
    rows = [(i, t, None if k % 7 == 0 else "en" if k % 2 else "xx", "s", len(t or ""), *range(8))
            for k, (i, t) in enumerate(odd_texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)

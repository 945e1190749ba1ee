from __future__ import annotations

import random

import numpy as np
import pytest
from tests.conftest import SF_DIR
from tests.llm import brute

from tallymart.llm import phrases, suffixes


def order(row: tuple) -> tuple:
    return (row[0] is None, row[0] or 0, *map(str, row[1:]))


def removed_words(docs) -> list[tuple]:
    rows = phrases.remove_repeats(docs).select("row.doc_id", "n_words", "n_removed", "kept").collect()
    return sorted(map(tuple, rows), key=order)


def removed_bytes(docs, **how) -> list[tuple]:
    rows = suffixes.remove_repeats(docs, **how).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()
    return sorted(((*r[:4], bytes(r[4])) for r in map(tuple, rows)), key=order)


@pytest.fixture(scope="module")
def given_texts(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    return docs, [(r["doc_id"], r["text"]) for r in docs.collect()]


@pytest.fixture(scope="module")
def mixed_texts(spark):
    """Passages with other surroundings in every document, so that no region is like another."""
    choose = random.Random(5)
    passages = [" ".join(f"p{choose.randrange(500)}" for _ in range(n)) for n in (13, 14, 90, 200)]
    texts = []
    for i in range(60):
        parts = [" ".join(f"x{choose.randrange(9999)}" for _ in range(choose.randrange(40)))]
        for passage in choose.sample(passages, 2):
            own = passage.split()
            a = choose.randrange(len(own)) if choose.random() < 0.5 else 0
            parts += [" ".join(own[a:]), " ".join(f"y{choose.randrange(9999)}" for _ in range(9))]
        texts.append((choose.randrange(50), " ".join(parts)))
    return spark.createDataFrame(texts, "doc_id long, text string"), texts


@pytest.mark.parametrize("crowd", [phrases.CROWD, 3])
def test_repeated_windows_go(given_texts, mixed_texts, odd_docs, odd_texts, crowd, monkeypatch):
    monkeypatch.setattr(phrases, "CROWD", crowd)
    monkeypatch.setattr(phrases, "SHARD_ROWS", 50)
    for docs, texts in (given_texts, mixed_texts, (odd_docs, odd_texts)):
        assert removed_words(docs) == sorted(brute.without_windows(texts), key=order)


def test_repeated_strings_go(given_texts, mixed_texts, odd_docs, odd_texts):
    for docs, texts in (given_texts, mixed_texts, (odd_docs, odd_texts)):
        assert removed_bytes(docs) == sorted(brute.without_strings(texts), key=order)


def test_the_first_of_each_string_may_stay(spark, mixed_texts):
    texts = [(k, t) for k, (_, t) in enumerate(mixed_texts[1])] + [(100, "ab " * 700)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    assert removed_bytes(docs, keep="first") == sorted(brute.without_strings(texts, keep="first"), key=order)


@pytest.mark.parametrize("keep", ["none", "first"])
def test_one_passage_between_other_words_everywhere(spark, keep):
    """Runs of equal strings in many partitions, cut in many batches, by the only way there is."""
    choose = random.Random(8)
    passage = " ".join(f"q{choose.randrange(900)}" for _ in range(110))
    texts = []
    for i in range(400):
        a, b = choose.randrange(60), len(passage) - choose.randrange(60)
        ends = [" ".join(f"z{choose.randrange(99999)}" for _ in range(choose.randrange(9))) for _ in "ab"]
        texts.append((i, f"{ends[0]} {passage[a:b]} {ends[1]}"))
    if keep == "none":
        texts += [(3, t) for _, t in texts[:20]] + texts[:20]  # repeated ids and rows
        texts += [(None, t) for _, t in texts[30:50]]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(7)
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        got = removed_bytes(docs, keep=keep)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    assert got == sorted(brute.without_strings(texts, keep=keep), key=order)


def _prefix(a: bytes, b: bytes) -> int:
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_previous_factors_are_those_of_all_pairs():
    choose = random.Random(2)
    for _ in range(30):
        text = bytes(choose.choice(b"ab") for _ in range(choose.randrange(1, 60)))
        places = sorted(range(len(text)), key=lambda i: text[i:])
        common = [0] + [_prefix(text[a:], text[b:]) for a, b in zip(places, places[1:])]
        plain = [max([0] + [_prefix(text[i:], text[j:]) for j in range(i)]) for i in places]
        assert suffixes.previous_factors(np.array(places), np.array(common)).tolist() == plain


def test_shared_prefixes_are_those_of_the_strings():
    choose = random.Random(4)
    core, strings = bytes(range(65, 65 + 20)), []
    length = len(core) + 7
    for j in range(8):
        for _ in range(40):
            strings.append((j, bytes(choose.choice(b"ab") for _ in range(7))))
    strings.sort()
    o, s = np.array([x[0] for x in strings]), np.array([int.from_bytes(x[1]) for x in strings])
    whole = [b[:j] + core + b[j:] for j, b in strings]
    shared = suffixes.shared_prefixes(o[1:] == o[:-1], o, s, length)
    plain = [_prefix(a, b) if i == j else 0 for a, b, i, j in zip(whole, whole[1:], o, o[1:])]
    assert shared.tolist() == [0, *plain]


@pytest.mark.parametrize("keep", ["none", "first"])
def test_batches_of_any_size_give_the_same_matches(keep):
    choose = random.Random(6)
    rows = sorted((choose.randrange(3), choose.randrange(3), choose.randrange(4), i, 0, 9) for i in range(90))
    kinds = dict(zip(suffixes._ORDER, zip(*rows)))
    whole = suffixes.pa.RecordBatch.from_pydict({k: np.array(v) for k, v in kinds.items()})
    plain = [r[3] for k, r in enumerate(rows)
             if any(r[:3] == q[:3] for q in (rows[:k] if keep == "first" else rows[:k] + rows[k + 1:]))]
    for size in (1, 2, 7, 90):
        batches = [whole.slice(a, size) for a in range(0, 90, size)]
        out = [r for b in suffixes._factors(iter(batches), 400, keep) for r in b.to_pylist()]
        assert sorted(r["did"] for r in out if r["hit"]) == sorted(plain)
        ends = [r["did"] for r in out if r["edge"]]
        assert ends[0] == rows[0][3] and rows[-1][:3] == next(r[:3] for r in rows if r[3] == ends[-1])


def test_nothing_in_nothing_out(no_docs):
    assert removed_words(no_docs) == [] and removed_bytes(no_docs) == []


def test_automata_find_every_confirmed_window():
    a, b = list(range(20)), [*range(3, 18), 99]
    codes, bounds = np.array(a + b, np.uint64), np.array([0, 20, 36])
    starts, firsts, with_any = phrases.confirm(codes, bounds, np.array([4, 2]), np.array([4, 2]))
    assert len(starts) == 3 and set(firsts.tolist()) == {2} and with_any.tolist() == [0, 1]
    automaton = phrases.compile_windows(codes.tolist(), starts.tolist(), firsts.tolist())
    assert phrases.locate(automaton, a) == [(3, 2), (4, 2), (5, 2)]
    same = np.array([4, 4])
    assert len(phrases.confirm(codes, bounds, same, same)[0]) == 0
    assert len(phrases.confirm(codes, bounds, same, same + 1)[0]) == 9

"""Spelling variants: words one edit apart, found by a frontier of states in tries held as tables.

A trie is an edge table: (node, label, child), where a node is the hash of a prefix. A state is
(word, node, what is left of the word, edits). All words are in two tries, of the words and of the
reversed words, and each edit is made in the latter half of the word in one of them: so states
begin at deep nodes with few children, never at the root. An edit drops the word's next character,
or follows the edge of another, greater one. From there the states of one edit must follow the rest
of their word, level by level: a level joins the frontier with the edges of 2^k characters, the
greatest power first, so that a state that leaves the trie does so at once and a word of any length
takes as many levels as its length has binary digits. States with nothing left at the end of a word
are pairs; each is verified on the words themselves, so hashes lose and add nothing. Inserting is
dropping seen from the other word.

A word's form is its near word of largest count; roots follow forms by doubling.

Null and empty texts have no words, and a null doc_id is written as nothing in the hashed key.
Repeated rows count again. Ties between forms go to the first in code-point order. Texts and words
may have any length: a run of letters is one word, and its trie path one row for each character.
Empty tables give empty results; further columns are ignored.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.text import blocks, mix, prefix_hash, run_hash
from tallymart.sources.staging import stage

LEAST_LENGTH = 6
LEAST_COUNT = 5
FORM_TIMES = 5
DROP_ONE_IN = 199

_LETTERS = "A-Za-zÀ-ÿ"
_STATES = "back boolean, word long, node long, letter int, drop boolean, rest int, labels array<long>"
_STEPS = "back boolean, node long, k int, label long, child long"
_EDGES = "back boolean, node long, letter int, child long"
#: Code points of words that a task turns into states at once; a word is never cut.
_AT_ONCE = 1 << 17


# --- words ----------------------------------------------------------------------------------


def _spelled(doc_id: int | None, run: str, one_in: int) -> str:
    """The run, or the run without one character where its hash says so."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    at = h % len(run)
    return run if h % one_in else run[:at] + run[at + 1 :]


def _count(batches: Iterator[pa.RecordBatch], least: int, one_in: int) -> Iterator[pa.RecordBatch]:
    # a run shorter than ``least`` is no word, and does not match anywhere
    find = re.compile(f"[{_LETTERS}]{{{least},}}").findall
    for batch in batches:
        for block in blocks(batch, "text"):
            counts: Counter = Counter()
            for doc_id, text in zip(block.column("doc_id").to_pylist(), block.column("text").to_pylist()):
                runs = Counter(find((text or "").encode().lower().decode()))  # bytes: A-Z only
                for run, n in runs.items():
                    counts[_spelled(doc_id, run, one_in)] += n
            yield pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"]
            )


def word_counts(
    docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, one_in: int = DROP_ONE_IN
) -> DataFrame:
    """word and n: the words of all texts that are long and frequent enough."""
    count = functools.partial(_count, least=least_length, one_in=one_in)
    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(count, "word string, n long")
    return (
        counted.filter(F.length("word") >= least_length)
        .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)
    )


# --- the tries as tables --------------------------------------------------------------------


class Paths:
    """The latter halves of some words in a trie: hashes of prefixes and of what follows them."""

    def __init__(self, words: list[str]):
        points = [np.frombuffer(w.encode("utf-32-le"), "<u4") for w in words]
        self.letters = np.concatenate([*points, np.zeros(1, np.uint32)])
        size = np.array([len(p) for p in points], np.int64)
        begin = np.concatenate([[0], np.cumsum(size)[:-1]])
        self.prefix = prefix_hash(mix(self.letters[:-1].astype(np.uint64) + np.uint64(1)))
        self.begin, self.end = begin, begin + size
        #: each place from the middle of a word on: its word and where it lies
        steps = size - size // 2
        self.of = np.repeat(np.arange(len(words)), steps)
        within = np.arange(len(self.of)) - np.repeat(np.cumsum(steps) - steps, steps)
        self.at = begin[self.of] + (size // 2)[self.of] + within

    def hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return run_hash(self.prefix, starts, ends).view(np.int64)

    def nodes(self, at: np.ndarray) -> np.ndarray:
        return self.hash(self.begin[self.of], at)

    def labels(self, at: np.ndarray, rest: np.ndarray) -> pa.Array:
        """For each place, hashes of the next 2^k characters for the binary digits of ``rest``, greatest first."""
        digits = int(rest.max(initial=0)).bit_length()
        found = np.zeros((len(at), digits), np.int64)
        used = np.zeros((len(at), digits), bool)
        for column, k in enumerate(reversed(range(digits))):
            chosen = (rest >> k & 1) == 1
            found[chosen, column] = self.hash(at[chosen], at[chosen] + (1 << k))
            used[:, column] = chosen
            at = at + (chosen << k)
        bounds = np.concatenate([[0], np.cumsum(used.sum(1))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(bounds), pa.array(found[used]))


def _word_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[str]]:
    for batch in batches:
        for block in blocks(batch, "word", _AT_ONCE):
            yield block.column("word").to_pylist()


def _both_ways(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, Paths]]:
    for words in _word_blocks(batches):
        yield False, Paths(words)
        yield True, Paths([w[::-1] for w in words])


def _starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A state before each character of the latter halves, with what is left behind that character."""
    for words in _word_blocks(batches):
        forwards = Paths(words)
        names = forwards.hash(forwards.begin, forwards.end)
        for back, paths in ((False, forwards), (True, Paths([w[::-1] for w in words]))):
            at, rest = paths.at, paths.end[paths.of] - paths.at - 1
            letter = paths.letters[at]
            drop = (rest == 0) | (paths.letters[at + 1] != letter)  # the last of equal ones stands for all
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), back)), pa.array(names[paths.of]), pa.array(paths.nodes(at)),
                 pa.array(letter.astype(np.int32)), pa.array(drop), pa.array(rest.astype(np.int32)),
                 paths.labels(at + 1, rest)],
                ["back", "word", "node", "letter", "drop", "rest", "labels"],
            )


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From each place, the edge of the greatest power of two that the word has left."""
    for back, paths in _both_ways(batches):
        at, rest = paths.at, paths.end[paths.of] - paths.at
        k = np.frexp(rest)[1] - 1
        to = at + (1 << k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(at), back)), pa.array(paths.nodes(at)), pa.array(k.astype(np.int32)),
             pa.array(paths.hash(at, to)), pa.array(paths.nodes(to))],
            ["back", "node", "k", "label", "child"],
        )


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From each place, the edge of one character."""
    for back, paths in _both_ways(batches):
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(paths.at), back)), pa.array(paths.nodes(paths.at)),
             pa.array(paths.letters[paths.at].astype(np.int32)), pa.array(paths.nodes(paths.at + 1))],
            ["back", "node", "letter", "child"],
        )


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last node of every word in both tries, and the word's name and spelling."""
    for words in _word_blocks(batches):
        forwards, reverse = Paths(words), Paths([w[::-1] for w in words])
        names = forwards.hash(forwards.begin, forwards.end)
        for back, nodes in ((False, names), (True, reverse.hash(reverse.begin, reverse.end))):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(words), back)), pa.array(nodes), pa.array(names), pa.array(words)],
                ["back", "node", "name", "word"],
            )


# --- the frontier ---------------------------------------------------------------------------


def near_pairs(words: DataFrame) -> DataFrame:
    """a < b: the words (distinct, in column ``word``) that one insertion, deletion or replacement parts."""
    words = words.select("word")
    starts = stage(words.mapInArrow(_starts, _STATES), "states")
    steps = stage(words.mapInArrow(_steps, _STEPS).distinct(), "steps")
    branches = stage(
        words.mapInArrow(_edges, _EDGES).distinct().groupBy("back", "node")
        .agg(F.collect_list(F.struct("letter", "child")).alias("children"))  # no more than the letters there are
        .filter(F.size("children") > 1),
        "branches",
    )
    state = ["back", "word", "node", "rest", "labels"]
    greater = F.filter("children", lambda c: c["letter"] > F.col("letter"))
    replaced = (
        starts.select(*state, "letter").join(branches, ["back", "node"])
        .select("back", "word", "rest", "labels", F.explode(greater["child"]).alias("node")).select(*state)
    )
    edited = stage(starts.filter("drop").select(*state).unionByName(replaced), "frontier")
    most = edited.agg(F.max("rest")).first()[0] or 0

    arrived = [edited.filter("rest = 0")]
    moving: DataFrame | None = None
    for k in reversed(range(int(most).bit_length())):
        here = edited.filter(F.col("rest").between(1 << k, (2 << k) - 1))
        if moving is not None:
            here = here.unionByName(moving.filter(F.col("rest") >= 1 << k))
        went = here.withColumn("label", F.col("labels")[0]).join(
            steps.filter(F.col("k") == k).drop("k"), ["back", "node", "label"]
        ).select(
            "back", "word", F.col("child").alias("node"), (F.col("rest") - (1 << k)).alias("rest"),
            F.slice("labels", 2, F.greatest(F.size("labels") - 1, F.lit(0))).alias("labels"),
        )
        if moving is not None:
            went = went.unionByName(moving.filter(F.col("rest") < 1 << k))
        moving = stage(went, "frontier")
    if moving is not None:
        arrived.append(moving)
    ended = functools.reduce(DataFrame.unionByName, arrived).select("back", "node", F.col("word").alias("from"))

    ends = stage(words.mapInArrow(_ends, "back boolean, node long, name long, word string"), "ends")
    named = ends.filter("not back")
    reached = ended.join(ends.select("back", "node", "name"), ["back", "node"]).filter(F.col("from") != F.col("name"))
    pairs = reached.select(F.least("from", "name").alias("x"), F.greatest("from", "name").alias("y")).distinct()
    spelled = pairs.join(named.select(F.col("name").alias("x"), F.col("word").alias("p")), "x").join(
        named.select(F.col("name").alias("y"), F.col("word").alias("q")), "y"
    )
    return (
        spelled.filter(F.levenshtein("p", "q", 1) == 1)
        .select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()
    )


def variants(
    docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
    form_times: int = FORM_TIMES, one_in: int = DROP_ONE_IN,
) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word."""
    words = stage(word_counts(docs, least_length, least_count, one_in), "words")
    pairs = stage(near_pairs(words), "pairs")
    facing = pairs.select(F.col("a").alias("word"), F.col("b").alias("near")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"))
    )
    counted = facing.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    largest = counted.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    formed = F.col("best.less") * -1 >= form_times * F.col("n")
    found = stage(
        words.join(largest, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(formed, F.col("best.near")).alias("form"),
            F.when(formed, F.col("best.less") * -1).alias("form_n"),
        ),
        "forms",
    )
    return found.join(_roots(found.dropna(subset=["form"])), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _roots(formed: DataFrame) -> DataFrame:
    """word and root: from each word along the forms to the last. Counts grow by form_times at each,
    so that no path closes and a few doublings reach all ends."""
    paths = stage(formed.select("word", F.col("form").alias("root")), "paths")
    while True:
        onward = paths.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if paths.join(onward, "root", "left_semi").isEmpty():
            return paths
        paths = stage(
            paths.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "paths"
        )

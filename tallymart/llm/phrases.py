"""Substring dedup by repeated-phrase automata.

A window of ``WINDOW`` words recurs if it starts in two documents; in a document it is removed if
it also starts in one of smaller doc_id.

1. Every window has a least-hashed run of ``GRAM`` words (the last of equal ones), its anchor. A
   count over all documents keeps the anchors of at least two.
2. The windows of such an anchor form a fragment of their document, each word a 32-bit code. All
   fragments of an anchor meet, and runs of whole anchors make up a shard.
3. A shard confirms the windows that start in two documents, compiles them into an Aho-Corasick
   automaton, each with its first document, and streams its fragments through: every occurrence
   in all documents is found in time that grows with the fragments, and no document is read
   against a shard that it shares no anchor with.
4. An anchor of more than ``CROWD`` documents would fill a shard. Its equal fragments are counted
   together before the shuffle, their windows are counted as rows, and joins, which adaptive
   execution splits, bring the occurrences back.

A text that a smaller document has word for word goes as a whole and makes no fragments.

Null texts have no words; a null doc_id comes after all others, and two documents without one share
their place; rows that repeat a doc_id are one document as to order, so they do not remove each
other's words; further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.rows import row_names, to_batch
from tallymart.llm.text import WORD, Words, blocks, minima, mix, owned, prefix_hash, run_hash
from tallymart.sources.staging import stage

WINDOW = 13
GRAM = 5
SHARD_ROWS = 20_000
CROWD = 2000
CODE = 4  # bytes of a word's code
WHOLE = (1 << 31) - 1  # the end of a span over all words

FRAGMENTS = "h long, did long, rk long, codes binary, begins array<int>"
SPANS = "did long, rk long, begin int, finish int"


def _anchors_of(words: Words) -> tuple[np.ndarray, ...]:
    """The text of each anchor, its hash, and the first and last word of its windows."""
    grams, _ = words.grams(GRAM)
    width = WINDOW - GRAM + 1
    at = minima(grams, words.left()[: len(grams)] >= WINDOW, width)
    text, h = words.owner()[at], grams[at]
    first, last = owned(h, at, words.word_bounds[text], words.word_bounds[text + 1] - WINDOW, width)
    own = last >= first
    return text[own], h[own], first[own], last[own] + WINDOW


def _within(h: np.ndarray, owner: np.ndarray) -> np.ndarray:
    return mix(h + (owner.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch, "text"):
            text, h, _, _ = _anchors_of(Words(block.column("text")))
            once = np.unique(_within(h, text), return_index=True)[1]
            yield pa.RecordBatch.from_arrays(
                [block.column(c).take(pa.array(text[once])) for c in ("did", "rk")] + [pa.array(h[once].view(np.int64))],
                names=["did", "rk", "h"],
            )


def _fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The fragments of the wanted anchors; equal ones of a text are one row."""
    for batch in batches:
        for block in blocks(batch, "text"):
            words = Words(block.column("text"))
            text, h, first, end = _anchors_of(words)
            wanted = block.column("wanted")
            lengths = np.diff(wanted.offsets.to_numpy())
            names = wanted.flatten().to_numpy().view(np.uint64)
            asked = _within(names, np.repeat(np.arange(len(lengths)), lengths))
            hit = np.isin(_within(h, text), asked)
            text, h, first, end = text[hit], h[hit], first[hit], end[hit]
            same = _within(run_hash(prefix_hash(words.hashes), first, end) + h, text)
            order = np.argsort(same, kind="stable")
            cuts = np.flatnonzero(np.diff(same[order], prepend=same[order[:1]] + np.uint64(1)))
            one = order[cuts]  # the first place of each
            codes = (words.hashes >> np.uint64(32)).astype("<u4").tobytes()
            pieces = [codes[CODE * a : CODE * b] for a, b in zip(first[one].tolist(), end[one].tolist())]
            begins = (first - words.word_bounds[text])[order].astype(np.int32)
            offsets = pa.array([*cuts, len(order)], pa.int32())
            texts = pa.array(text[one])
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[one].view(np.int64)), block.column("did").take(texts),
                 block.column("rk").take(texts), pa.array(pieces, pa.binary()),
                 pa.ListArray.from_arrays(offsets, pa.array(begins))],
                names=["h", "did", "rk", "codes", "begins"],
            )


def confirm(
    codes: np.ndarray, bounds: np.ndarray, first: np.ndarray, last: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows of different fragments that start in two documents.

    ``codes[bounds[i]:bounds[i + 1]]`` is fragment i, found in documents ``first[i]`` to ``last[i]``.
    Returns where one copy of each window starts, its first document, and the fragments with any.
    """
    counts = np.diff(bounds) - WINDOW + 1
    fragment = np.repeat(np.arange(len(counts)), counts)
    starts = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts - bounds[:-1], counts)
    hashes = run_hash(prefix_hash(mix(codes)), starts, starts + WINDOW)
    _, one, name = np.unique(hashes, return_index=True, return_inverse=True)
    least, most = np.full(len(one), np.iinfo(np.int64).max), np.full(len(one), np.iinfo(np.int64).min)
    np.minimum.at(least, name, first[fragment])
    np.maximum.at(most, name, last[fragment])
    recurs = least < most
    return starts[one[recurs]], least[recurs], np.unique(fragment[recurs[name]])


def compile_windows(codes: list[int], starts: list[int], firsts: list[int]) -> ahocorasick.Automaton:
    """An automaton of windows of word codes, each with its first document."""
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for start, first in zip(starts, firsts):
        automaton.add_word(tuple(codes[start : start + WINDOW]), first)
    automaton.make_automaton()
    return automaton


def locate(automaton: ahocorasick.Automaton, codes: list[int]) -> list[tuple[int, int]]:
    """(start, first document) of every window of the automaton in a fragment."""
    return [(end - WINDOW + 1, first) for end, first in automaton.iter(tuple(codes))]


def _runs(starts: list[int], begins: list[int]) -> Iterator[tuple[int, int]]:
    """The words covered by windows at ``starts`` of a fragment at each of its places."""
    runs: list[list[int]] = []
    for start in sorted(starts):
        if runs and start <= runs[-1][1]:
            runs[-1][1] = start + WINDOW
        else:
            runs.append([start, start + WINDOW])
    return ((begin + a, begin + b) for begin in begins for a, b in runs)


def _shard_spans(shard: pa.Table) -> list[tuple]:
    pieces, begins = (shard.column(c).combine_chunks() for c in ("codes", "begins"))
    pieces, begins = (pa.concat_arrays(x.chunks) if isinstance(x, pa.ChunkedArray) else x for x in (pieces, begins))
    did, rk = (shard.column(c).to_numpy() for c in ("did", "rk"))
    codes = np.frombuffer(b"".join(pieces.to_pylist()), "<u4").astype(np.uint64)
    bounds = np.concatenate([[0], np.cumsum(pc.binary_length(pieces).to_numpy() // CODE)])
    prefix = prefix_hash(mix(codes))
    _, one, kind = np.unique(run_hash(prefix, bounds[:-1], bounds[1:]), return_index=True, return_inverse=True)
    first, last = np.full(len(one), np.iinfo(np.int64).max), np.full(len(one), np.iinfo(np.int64).min)
    np.minimum.at(first, kind, did)
    np.maximum.at(last, kind, did)
    # one of each kind of fragment, end to end
    lengths = np.diff(bounds)[one]
    ends = np.concatenate([[0], np.cumsum(lengths)])
    places = np.arange(ends[-1]) + np.repeat(bounds[one] - ends[:-1], lengths)
    starts, firsts, with_any = confirm(codes[places], ends, first, last)
    if not len(starts):
        return []
    known = codes[places].tolist()
    automaton = compile_windows(known, starts.tolist(), firsts.tolist())
    found = {k: locate(automaton, known[ends[k] : ends[k + 1]]) for k in with_any.tolist()}
    out = []
    rows = np.flatnonzero(np.isin(kind, with_any))
    columns = (x[rows].tolist() for x in (kind, did, rk))
    for k, own, text, places_in in zip(*columns, begins.take(pa.array(rows)).to_pylist()):
        later = [start for start, earliest in found[k] if earliest < own]
        if later:
            out += [(own, text, a, b) for a, b in _runs(later, places_in)]
    return out


def _locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans from fragments that arrive ordered by anchor: shard by shard of whole anchors."""
    waiting: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        waiting.append(batch)
        size += batch.num_rows
        if size >= SHARD_ROWS:
            shard = pa.Table.from_batches(waiting)
            h = shard.column("h").to_numpy()
            end = int(np.searchsorted(h, h[-1]))  # the last anchor may go on in the next batch
            yield to_batch(_shard_spans(shard.slice(0, end)) if end else [], SPANS)
            waiting = shard.slice(end).to_batches()
            size = shard.num_rows - end
    if size:
        yield to_batch(_shard_spans(pa.Table.from_batches(waiting)), SPANS)


def _later_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        columns = (batch.column(c).to_pylist() for c in ("did", "rk", "begins", "starts", "firsts"))
        for did, rk, begins, starts, firsts in zip(*columns):
            later = [s for s, first in zip(starts, firsts) if first < did]
            out += [(did, rk, a, b) for a, b in _runs(later, begins)]
        yield to_batch(out, SPANS)


def _counted(fragments: DataFrame) -> DataFrame:
    """Spans from fragments of crowded anchors, their windows counted as rows."""
    kinds = fragments.groupBy("h", "codes").agg(F.min("did").alias("first"), F.max("did").alias("last"))
    places = F.expr(f"sequence(0, octet_length(codes) div {CODE} - {WINDOW})").cast("array<int>")
    windows = kinds.select("*", F.explode(places).alias("start")).withColumn(
        "window", F.expr(f"substring(codes, {CODE} * start + 1, {CODE * WINDOW})")
    )
    first_of = (
        windows.groupBy("h", "window").agg(F.min("first").alias("one"), F.max("last").alias("end"))
        .filter("one < end").select("h", "window", "one")
    )
    located = windows.join(first_of, ["h", "window"]).groupBy("h", "codes").agg(
        F.collect_list("start").alias("starts"), F.collect_list("one").alias("firsts")
    )
    return fragments.join(located, ["h", "codes"]).mapInArrow(_later_spans, SPANS)


def _copies(texts: DataFrame) -> DataFrame:
    """did and rk of rows whose text a smaller document has."""
    named = texts.select(
        "did", "rk", F.xxhash64("text").alias("name"), F.hash("text").alias("check"),
        F.octet_length("text").alias("size"),
    )
    same = ["name", "check", "size"]
    firsts = stage(named.groupBy(*same).agg(F.min("did").alias("first")), "first-copies")
    later = named.join(firsts, same).filter(F.col("did") > F.col("first"))
    return stage(later.select("did", "rk").distinct(), "copies")


def repeated_spans(texts: DataFrame) -> DataFrame:
    """did, rk, begin, finish: runs of words to remove from each text; they may overlap.

    ``texts`` (with did, rk and text) is shuffled by did and rk once for all joins of a query with it,
    so rows that share an id, or have none, are apart. The anchors that a text shares with others are
    found once and stored.
    """
    anchors = texts.select("did", "rk", "text").mapInArrow(_anchors, "did long, rk long, h long")
    recurring = (
        anchors.groupBy("h")
        .agg(F.min("did").alias("a"), F.max("did").alias("b"), F.count("*").alias("n"))
        .filter("a < b").select("h", (F.col("n") > CROWD).alias("crowded"))
    )
    recurring = stage(recurring, "recurring")  # so that joins may be split at a hot anchor
    copies = _copies(texts)
    found = anchors.join(recurring, "h").groupBy("did", "rk").agg(
        F.collect_set(F.when(~F.col("crowded"), F.col("h"))).alias("few"),
        F.collect_set(F.when(F.col("crowded"), F.col("h"))).alias("many"),
    )
    found = stage(found.join(copies, ["did", "rk"], "left_anti"), "wanted")

    def fragments(which: str) -> DataFrame:
        wanted = found.filter(F.size(which) > 0).select("did", "rk", F.col(which).alias("wanted"))
        return texts.join(wanted, ["did", "rk"]).mapInArrow(_fragments, FRAGMENTS)

    few = fragments("few").repartition("h").sortWithinPartitions("h").mapInArrow(_locate, SPANS)
    whole = copies.select("did", "rk", F.lit(0).alias("begin"), F.lit(WHOLE).alias("finish"))
    return few.unionByName(_counted(fragments("many"))).unionByName(whole)


def _remove(batches: Iterator[pa.RecordBatch], rewrite: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, removed, kept = [], [], []
        columns = (batch.column(c).to_pylist() for c in ("text", "spans"))
        for text, spans in zip(*columns):
            words = WORD.findall(text or "")
            rest = words
            if spans:
                gone = bytearray(len(words))
                for s in spans:
                    if s["finish"] == WHOLE:
                        if len(words) >= WINDOW:
                            gone = bytearray(b"\1" * len(words))
                    else:
                        gone[s["begin"] : s["finish"]] = b"\1" * (s["finish"] - s["begin"])
                rest = [word for word, lost in zip(words, gone) if not lost]
            counts.append(len(words))
            removed.append(len(words) - len(rest))
            kept.append(" ".join(rest) if rewrite or len(rest) < len(words) else text)
        out = [batch.column("row"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())]
        yield pa.RecordBatch.from_arrays(out, names=["row", "n_words", "n_removed", "kept"])


def remove_repeats(
    docs: DataFrame, carry: Sequence[str] = ("doc_id",), rewrite: bool = True
) -> DataFrame:
    """The columns to carry as a struct ``row``, n_words, n_removed and the kept words.

    The kept words are joined by one space; without ``rewrite`` a text that loses none stays as it is.
    """
    texts = docs.select(F.struct(*carry).alias("row"), *(c.alias(n) for n, c in row_names().items()), "text")
    spans = repeated_spans(texts).groupBy("did", "rk").agg(F.collect_set(F.struct("begin", "finish")).alias("spans"))
    kind = texts.schema["row"].dataType.simpleString()
    return texts.join(spans, ["did", "rk"], "left").mapInArrow(
        functools.partial(_remove, rewrite=rewrite), f"row {kind}, n_words long, n_removed long, kept string"
    )

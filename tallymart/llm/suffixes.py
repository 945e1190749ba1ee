"""Suffix-array dedup: bytes in strings of ``length`` that occur elsewhere, by previous factors.

Any string of ``length`` bytes has a least-hashed 64-byte gram (the last of equal ones), its anchor,
and equal strings have equal anchors at the same place. So only strings of equal anchors can match,
and of these only strings that begin equally far before it:

1. every text names its anchors and a hash of the region of each, the text of all strings that it
   anchors; anchors found once are dropped by a count and a join. Regions that are equal as a whole
   recur as a whole; where an anchor has different regions, one of each kind goes on;
2. the strings of a region are taken in blocks of 64 that begin next to each other. Their core is
   what all of them contain, their union all that they cover. A core found once has no match, equal
   unions match as a whole, one of each kind of the rest goes on. Then the same in blocks of 8;
3. the strings left differ in 7 bytes around their core, so these are their suffix order. All are
   range-sorted by core, offset, these bytes and place: a suffix array spread over the cluster, in
   which a run of equal strings may fill many partitions. Each is streamed; previous and next
   smaller positions in suffix order give the longest previous factor of each string within its
   core, and a factor of ``length`` is an earlier match. The same in reverse finds later matches.
   Runs that cross partitions show in two records a partition.

No step holds a group in one task, and all rows take the same way, whatever the size of a group.

``keep="none"`` removes every string found twice, ``keep="first"`` only those with an earlier match
in order of (doc_id, text hash, position). Null texts are empty; a null doc_id comes last in that
order; repeated rows are copies of each other; ties in suffix order are in text order; texts of any
length are treated whole, one at a time; further columns are ignored; an empty table gives an empty
result. Matches never cross texts.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.rows import doc_id, keyed, row_names, to_batch
from tallymart.llm.text import blocks, byte_symbols, minima, mix, owned, prefix_hash, run_hash, utf8
from tallymart.sources.staging import stage

LENGTH = 400
GRAM = 64
COARSE, FINE = 64, 8  # strings of a block; 7 bytes beside a core fit one number

#: A region lies between begin and finish of its text; the strings of its anchor start in it.
ANCHORS = "did long, rk long, begin int, finish int, at int, h long, rh long"
#: The strings of a region or block begin from ``hi`` down to ``lo`` bytes before the anchor.
REGIONS = "h long, did long, rk long, at int, lo int, hi int, region binary"
BLOCKS = "c long, u long, did long, rk long, at int, lo int, hi int"
EDGES = "c long, u long, v long, did long, rk long, at int, lo int, hi int"
_ORDER = ("c", "o", "s", "did", "rk", "at")
FACTORS = "edge boolean, hit boolean, c long, o int, s long, did long, rk long, at int"

def _anchors_of(texts: pa.Array, length: int) -> tuple[np.ndarray, ...]:
    """Text, begin and end of the region in it, place, gram hash and region hash of each anchor."""
    data, bounds = utf8(texts)
    width = length - GRAM + 1  # grams of a string
    prefix = prefix_hash(byte_symbols(data))
    starts = np.arange(max(0, len(data) - GRAM + 1))
    h = run_hash(prefix, starts, starts + GRAM)
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    allowed = bounds[owner + 1] - np.arange(len(data)) >= length
    at = minima(h, allowed, width)
    text, h = owner[at], h[at]
    first, last = owned(h, at, bounds[text], bounds[text + 1] - length, width)
    own = last >= first
    at, text, h, first, last = at[own], text[own], h[own], first[own], last[own]
    region = run_hash(prefix, first, last + length)
    region = mix(region + (at - first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return text, first - bounds[text], last + length - bounds[text], at - bounds[text], h, region


def _anchors(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch, "text"):
            text, *places, h, region = _anchors_of(block.column("text"), length)
            owner = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [block.column("did").take(owner), block.column("rk").take(owner)]
                + [pa.array(x.astype(np.int32)) for x in places]
                + [pa.array(h.view(np.int64)), pa.array(region.view(np.int64))],
                names=["did", "rk", "begin", "finish", "at", "h", "rh"],
            )


def _regions(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Cut the wanted regions of each text."""
    for batch in batches:
        rows: list[tuple] = []
        size = 0
        for i in range(batch.num_rows):
            did, rk, text, wanted = (batch.column(c)[i].as_py() for c in ("did", "rk", "text", "wanted"))
            data = text.encode()
            for w in wanted:
                begin, finish, at = w["begin"], w["finish"], w["at"]
                rows.append((w["h"], did, rk, at, at - finish + length, at - begin, data[begin:finish]))
                size += finish - begin
                if size > 4 << 20:
                    yield to_batch(rows, REGIONS)
                    rows, size = [], 0
        yield to_batch(rows, REGIONS)


class _Regions:
    """Regions of a batch, one after another, and the place of each anchor in them."""

    def __init__(self, batch: pa.RecordBatch):
        self.data, bounds = utf8(batch.column("region"))
        self.batch = batch
        self.lo, self.hi = (batch.column(c).to_numpy().astype(np.int64) for c in ("lo", "hi"))
        self.h = batch.column("h").to_numpy().view(np.uint64)
        self.anchor = bounds[:-1] + self.hi
        self.prefix = prefix_hash(byte_symbols(self.data))

    def blocks(self, row: np.ndarray, lo: np.ndarray, hi: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
        """Row, first string, lowest and highest string taken of each block between lo and hi."""
        first = lo // width
        counts = hi // width - first + 1
        of = np.repeat(np.arange(len(row)), counts)
        k = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts) + first[of]
        a = k * width
        return row[of], a, np.maximum(a, lo[of]), np.minimum(a + width - 1, hi[of])

    def core(self, row: np.ndarray, a: np.ndarray, width: int, length: int) -> np.ndarray:
        at = self.anchor[row]
        name = mix(self.h[row] + a.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        return mix(run_hash(self.prefix, at - a, at - a + length - width + 1) + name)

    def union(self, row: np.ndarray, lo: np.ndarray, hi: np.ndarray, length: int) -> np.ndarray:
        at = self.anchor[row]
        return mix(run_hash(self.prefix, at - hi, at - lo + length) + lo.astype(np.uint64))

    def number(self, begin: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The 7 bytes from ``begin`` on as a number; those outside low and high are 0."""
        out = np.zeros(len(begin), np.int64)
        for i in range(FINE - 1):
            at = begin + i
            inside = (at >= low) & (at < high)
            out = (out << 8) | np.where(inside, self.data[np.where(inside, at, 0)], 0)
        return out

    def rows(self, row: np.ndarray, lo: np.ndarray, hi: np.ndarray, **keys: np.ndarray) -> pa.RecordBatch:
        owner = pa.array(row)
        return pa.RecordBatch.from_arrays(
            [pa.array(k.view(np.int64)) for k in keys.values()]
            + [self.batch.column(c).take(owner) for c in ("did", "rk", "at")]
            + [pa.array(x.astype(np.int32)) for x in (lo, hi)],
            names=[*keys, "did", "rk", "at", "lo", "hi"],
        )


def _coarse(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Core and union of each block of strings of the regions."""
    for batch in batches:
        for part in blocks(batch, "region"):
            regions = _Regions(part)
            row, a, lo, hi = regions.blocks(np.arange(part.num_rows), regions.lo, regions.hi, COARSE)
            yield regions.rows(
                row, lo, hi, c=regions.core(row, a, COARSE, length), u=regions.union(row, lo, hi, length)
            )


def _fine(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Core of each small block in the wanted ones, and the 7 bytes before and behind the core."""
    for batch in batches:
        for part in blocks(batch, "region"):
            regions = _Regions(part)
            wanted = part.column("wanted")
            owner = np.repeat(np.arange(part.num_rows), pc.list_value_length(wanted).to_numpy())
            ends = [pc.struct_field(pc.list_flatten(wanted), c).to_numpy() for c in ("lo", "hi")]
            row, a, lo, hi = regions.blocks(owner, *(e.astype(np.int64) for e in ends), FINE)
            at = regions.anchor[row]
            low, high = at - hi, at - lo + length
            yield regions.rows(
                row, lo, hi, c=regions.core(row, a, FINE, length),
                u=regions.number(at - a - FINE + 1, low, high),
                v=regions.number(at - a - FINE + 1 + length, low, high),
            )


def previous_factors(places: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The longest prefix that each suffix shares with one at a smaller place.

    Suffixes come in suffix order with their places; ``common`` is what each shares with the one
    before it, 0 for the first. The previous and the next smaller place in suffix order are the
    nearest candidates on both sides, so the larger of the prefixes shared with them is the factor.
    """
    out = [0] * len(places)
    open_: list[tuple[int, int, int]] = []  # place, prefix shared with the previous smaller, index
    for i, (place, shared) in enumerate(zip(places.tolist(), common.tolist())):
        while open_ and open_[-1][0] > place:  # this is the next smaller place of what is open
            _, before, k = open_.pop()
            out[k] = before if before > shared else shared
            if before < shared:
                shared = before
        open_.append((place, shared if open_ else 0, i))
    for _, before, k in open_:
        out[k] = before
    return np.array(out, np.int64)


def shared_prefixes(same: np.ndarray, o: np.ndarray, s: np.ndarray, length: int) -> np.ndarray:
    """What each string shares with the one before it, by the 7 bytes around their core."""
    out = np.zeros(len(s), np.int64)
    differ = s[1:] ^ s[:-1]
    equal = sum((differ >> (8 * i) == 0).astype(np.int64) for i in range(FINE - 1))
    before_core = o[1:] % FINE
    shared = np.where(equal < before_core, equal, equal + length - FINE + 1)
    out[1:] = np.where(same, shared, 0)
    return out


def _factors(batches: Iterator[pa.RecordBatch], length: int, keep: str) -> Iterator[pa.RecordBatch]:
    """Strings with a match, and the first of the first and of the last run of the partition.

    Rows come in order. The last row of a batch waits for the next one, to see both neighbours; it
    carries the only prefix that can reach ``length`` across the cut.
    """
    held: pa.RecordBatch | None = None
    earlier = False  # whether the row held has an earlier match
    run: pa.RecordBatch | None = None  # first row of the current run
    opening = True
    names = ["edge", "hit", *_ORDER]

    def out(rows: pa.RecordBatch, edge: bool, hit: bool) -> pa.RecordBatch:
        flags = [pa.array([x] * rows.num_rows, pa.bool_()) for x in (edge, hit)]
        return pa.RecordBatch.from_arrays([*flags, *(rows.column(c) for c in _ORDER)], names)

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch
        if held is not None:
            rows = pa.RecordBatch.from_arrays(
                [pa.concat_arrays([held.column(c), batch.column(c)]) for c in _ORDER], list(_ORDER)
            )
        c, o, s, did, rk, at = (rows.column(name).to_numpy() for name in _ORDER)
        places = np.empty(len(c), np.int64)
        places[np.lexsort((at - o, rk, did))] = np.arange(len(c))
        common = shared_prefixes((c[1:] == c[:-1]) & (o[1:] == o[:-1]), o, s, length)
        hit = previous_factors(places, common) >= length
        hit[0] |= earlier
        earlier = bool(hit[-1])
        if keep == "none":
            following = np.concatenate([[0], common[:0:-1]])
            hit |= previous_factors(-places[::-1], following)[::-1] >= length
        hit[-1] = False
        yield out(rows.filter(pa.array(hit)), False, True)
        starts = np.flatnonzero(common < length)  # row 0 begins a run or is the row held
        if run is None:
            run = rows.slice(0, 1)
        starts = starts[starts > 0]
        if len(starts):
            if opening:
                yield out(run, True, False)
                opening = False
            run = rows.slice(int(starts[-1]), 1)
        held = rows.slice(len(c) - 1, 1)
    if held is not None:
        yield out(run, True, False)
        if earlier:
            yield out(held, False, True)


def _place() -> Column:
    return F.struct("did", "rk", "at")


def _settle(blocks: DataFrame, union: list[str], keep: str, name: str) -> tuple[DataFrame, DataFrame]:
    """Blocks whose union recurs, and one of each kind where a core has several unions.

    Repeated rows give the same block at the same place, which is no recurrence here: their regions
    are copies already.
    """
    kinds = stage(
        blocks.groupBy("c", *union)
        .agg(F.min(_place()).alias("one"), (F.min(_place()) != F.max(_place())).alias("recurs")),
        name,
    )
    whole = blocks.join(kinds.filter("recurs"), ["c", *union])
    if keep == "first":
        whole = whole.filter(_place() != F.col("one"))
    cores = kinds.groupBy("c").agg(F.count("*").alias("_kinds")).filter("_kinds > 1").select("c")
    return whole.select("did", "rk", "at", "lo", "hi"), kinds.join(stage(cores, f"{name}-cores"), "c")


def _sorted_strings(edges: DataFrame, length: int, keep: str) -> DataFrame:
    """did, rk, at, lo and hi of strings with a match, by a suffix array of them all."""
    strings = edges.select(
        "c", "one.*", F.explode(F.sequence("lo", "hi")).alias("o"), "u", "v"
    ).withColumn("s", F.expr(
        # the last j of the 7 bytes before the core, then the first 7 - j of those behind it
        f"shiftleft(u & (shiftleft(1L, 8 * (o % {FINE})) - 1), 8 * ({FINE - 1} - o % {FINE}))"
        f" | shiftright(v, 8 * (o % {FINE}))"
    ))
    factors = stage(
        strings.select(*_ORDER).repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)
        .mapInArrow(functools.partial(_factors, length=length, keep=keep), FACTORS),
        "factors",
    )
    # two rows for each partition of the sort at most
    ends = factors.filter("edge")
    crossing = ends.groupBy("c", "o", "s").agg(F.count("*").alias("_n"), F.min(_place()).alias("_first"))
    crossing = ends.join(crossing.filter("_n > 1"), ["c", "o", "s"])
    if keep == "first":
        crossing = crossing.filter(_place() != F.col("_first"))
    hits = factors.filter("hit").select(*_ORDER).unionByName(crossing.select(*_ORDER))
    return hits.select("did", "rk", "at", F.col("o").alias("lo"), F.col("o").alias("hi"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, keep: str = "none") -> DataFrame:
    """Byte spans to remove from each text, as did, rk, begin, finish; spans may overlap."""
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}")
    texts = keyed(docs).filter(F.octet_length("text") >= length)
    anchors = stage(
        texts.mapInArrow(functools.partial(_anchors, length=length), ANCHORS), "anchors"
    )
    again = anchors.groupBy("h").agg(F.count("*").alias("_n")).filter("_n > 1").select("h")
    again = stage(again, "recurring")  # so that adaptive execution may split the join at a hot anchor
    found = stage(anchors.join(again, "h"), "recurring-anchors")
    kinds = found.groupBy("h", "rh").agg(
        F.count("*").alias("copies"), F.min(F.struct("did", "rk", "begin", "finish", "at")).alias("one")
    )
    kinds = stage(kinds, "kinds")

    # regions that recur as a whole
    whole = found.join(kinds.filter("copies > 1"), ["h", "rh"])
    if keep == "first":
        whole = whole.filter(F.struct("did", "rk", "begin", "finish", "at") != F.col("one"))

    # different regions around one anchor
    mixed = kinds.groupBy("h").agg(F.count("*").alias("_kinds")).filter("_kinds > 1").select("h")
    wanted = (
        kinds.join(stage(mixed, "mixed-anchors"), "h")
        .groupBy("one.did", "one.rk")
        .agg(F.collect_list(F.struct("h", "one.begin", "one.finish", "one.at")).alias("wanted"))
    )
    regions = stage(
        texts.join(wanted, ["did", "rk"]).select("did", "rk", "text", "wanted")
        .mapInArrow(functools.partial(_regions, length=length), REGIONS),
        "region-texts",
    )
    coarse = stage(regions.mapInArrow(functools.partial(_coarse, length=length), BLOCKS), "blocks")
    equal, left = _settle(coarse, ["u", "lo", "hi"], keep, "block-kinds")
    left = left.groupBy("one.did", "one.rk", "one.at").agg(F.collect_list(F.struct("lo", "hi")).alias("wanted"))
    fine = stage(
        regions.select("h", "did", "rk", "at", "lo", "hi", "region").join(left, ["did", "rk", "at"])
        .mapInArrow(functools.partial(_fine, length=length), EDGES),
        "small-blocks",
    )
    alike, edges = _settle(fine, ["u", "v", "lo", "hi"], keep, "small-block-kinds")
    matched = equal.unionByName(alike).unionByName(_sorted_strings(edges, length, keep))
    return whole.select("did", "rk", "begin", "finish").unionByName(matched.select(
        "did", "rk", (F.col("at") - F.col("hi")).alias("begin"),
        (F.col("at") - F.col("lo") + length).alias("finish"),
    ))


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The maximal runs covered by spans."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch, "text"):
            sizes, removed, runs, kept = [], [], [], []
            for text, spans in zip(block.column("text").to_pylist(), block.column("spans").to_pylist()):
                data = (text or "").encode()
                merged = merge([(s["begin"], s["finish"]) for s in spans or ()])
                edges = [0, *(x for span in merged for x in span), len(data)]
                rest = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                sizes.append(len(data))
                removed.append(len(data) - len(rest))
                runs.append(len(merged))
                kept.append(rest)
            kinds = [pa.int64()] * 3 + [pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id")]
                + [pa.array(c, k) for c, k in zip((sizes, removed, runs, kept), kinds)],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )


def remove_repeats(docs: DataFrame, length: int = LENGTH, keep: str = "none") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the kept bytes of every document."""
    spans = (
        repeated_spans(docs, length, keep)
        .groupBy("did", "rk")
        .agg(F.collect_set(F.struct("begin", "finish")).alias("spans"))
    )
    texts = docs.select("doc_id", "text").withColumns(row_names())
    return texts.join(spans, ["did", "rk"], "left").select(doc_id(), "text", "spans").mapInArrow(
        _remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )

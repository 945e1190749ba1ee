"""N-gram Jaccard join: an LSH forest of MinHash signatures, then exact verification.

Texts are sets of shingles of ``WORDS`` words; one with fewer words is one shingle, an empty one
has none and links with nothing. Equal sets form a class, and one text of each class goes on.

A signature is cut into ``TREES`` sequences; sorted, the sequences of a tree are a trie, and texts
that share a prefix stand together. The matched prefix is shortened from ``DEEPEST`` on until the
chance that a pair at the threshold shares it in some tree reaches ``TARGET``.

Prefixes of at most ``CROWD`` texts give pairs of ids, which signatures thin out (a pair passes
unless its estimate is ``DEVIATIONS`` below the threshold) and whole shingle sets verify. Crowded
prefixes never give pairs: their texts are dealt into blocks, each pair of blocks is verified inside
a task, which returns the number of links of each text and a spanning forest of them. A pair that
shares several crowded prefixes counts in the one of least key, and nowhere else.

Null texts are empty; a null doc_id comes after all others; repeated rows are copies; further
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.graph import components
from tallymart.llm.rows import groups, keyed, real_id, row_names, to_batch
from tallymart.llm.text import Words, blocks, mix
from tallymart.sources.staging import stage

WORDS = 5
SIMILAR = 0.8
TREES, DEEPEST = 20, 6
TARGET = 0.9999
DEVIATIONS = 4.5
CROWD = 64
BLOCK = 512
COLUMNS = 8192

DESCRIBED = "doc_id long, did long, rk long, k1 long, k2 long, shingles long, signature binary"


def depth_for(similar: float, trees: int = TREES, deepest: int = DEEPEST, target: float = TARGET) -> int:
    """The longest prefix that still finds a pair at the threshold with chance ``target``."""
    depth = deepest
    while depth > 1 and 1 - (1 - similar**depth) ** trees < target:
        depth -= 1
    return depth


@functools.cache
def _functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return seeds[:n] | np.uint64(1), seeds[n:]


def shingle_runs(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of a block, text by text, and the bounds of the texts in them."""
    grams, inside = words.grams(WORDS)
    counts = np.diff(words.word_bounds)
    owner = words.owner()[: len(grams)][inside]
    hashes = grams[inside]
    short = np.flatnonzero((counts > 0) & (counts < WORDS))
    if len(short):
        whole = [
            mix(np.array([hash_words(words.hashes[words.word_bounds[i] : words.word_bounds[i + 1]])], np.uint64))[0]
            for i in short
        ]
        owner, hashes = np.append(owner, short), np.append(hashes, np.array(whole, np.uint64))
        order = np.argsort(owner, kind="stable")
        owner, hashes = owner[order], hashes[order]
    return hashes, np.searchsorted(owner, np.arange(len(counts) + 1))


def hash_words(hashes: np.ndarray) -> int:
    total = len(hashes)
    for h in hashes.tolist():
        total = (total * 0xD6E8FEB86659FD93 + h) & 0xFFFFFFFFFFFFFFFF
    return total


def _describe(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    factors, shifts = _functions(length)
    for batch in batches:
        for block in blocks(batch, "text"):
            hashes, bounds = shingle_runs(Words(block.column("text")))
            filled = np.flatnonzero(np.diff(bounds))
            signature = np.zeros((length, len(bounds) - 1), np.uint32)
            if len(filled):
                for k in range(length):
                    least = np.minimum.reduceat((hashes + shifts[k]) * factors[k], bounds[filled])
                    signature[k, filled] = (least >> np.uint64(32)).astype(np.uint32)
            sets = [np.unique(hashes[a:b]) for a, b in zip(bounds, bounds[1:])]
            k1 = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64)
            k2 = np.array([mix(s).sum(dtype=np.uint64) for s in sets], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [block.column(c) for c in ("doc_id", "did", "rk")]
                + [pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64))]
                + [pa.array([len(s) for s in sets], pa.int64())]
                + [pa.array([s.tobytes() for s in np.ascontiguousarray(signature.T)], pa.binary())],
                names=["doc_id", "did", "rk", "k1", "k2", "shingles", "signature"],
            )


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), -1)


def _prefixes(batches: Iterator[pa.RecordBatch], trees: int, depth: int) -> Iterator[pa.RecordBatch]:
    """(cid, hash of the prefix and its tree) for every tree."""
    for batch in batches:
        if not batch.num_rows:
            continue
        table = _signatures(batch.column("signature")).reshape(batch.num_rows, trees, -1)
        key = np.broadcast_to(np.arange(1, trees + 1, dtype=np.uint64), table.shape[:2])
        for d in range(depth):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + table[:, :, d].astype(np.uint64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(batch.column("cid").to_numpy(), trees)),
             pa.array(np.ascontiguousarray(key).ravel().view(np.int64))],
            names=["cid", "key"],
        )


def _likely(batches: Iterator[pa.RecordBatch], similar: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        same = _signatures(batch.column("sa")) == _signatures(batch.column("sb"))
        least = similar - DEVIATIONS * np.sqrt(similar * (1 - similar) / same.shape[1])
        yield batch.select(["a", "b"]).filter(pa.array(same.mean(axis=1) >= least))


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch, "text"):
            hashes, bounds = shingle_runs(Words(block.column("text")))
            sets = [np.unique(hashes[a:b]).tobytes() for a, b in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [block.column("cid"), block.column("copies"), pa.array(sets, pa.binary())],
                names=["cid", "copies", "grams"],
            )


def _verify(batches: Iterator[pa.RecordBatch], similar: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("ga").to_pylist(), batch.column("gb").to_pylist()):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(both >= similar * (len(x) + len(y) - both))
        yield batch.select(["a", "b", "ma", "mb"]).filter(pa.array(keep, pa.bool_()))


def _overlaps(xs: list[np.ndarray], ys: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of sorted sets, by products of presence matrices."""
    every = np.concatenate([*xs, *ys])
    names, place, times = np.unique(every, return_inverse=True, return_counts=True)
    wanted = np.flatnonzero(times > 1)
    column = np.full(len(names), -1)
    column[wanted] = np.arange(len(wanted))
    row = np.repeat(np.arange(len(xs) + len(ys)), [len(s) for s in (*xs, *ys)])
    at = column[place]
    row, at = row[at >= 0], at[at >= 0]
    out = np.zeros((len(xs), len(ys)))
    for begin in range(0, len(wanted), COLUMNS):
        chosen = (at >= begin) & (at < begin + COLUMNS)
        present = np.zeros((len(xs) + len(ys), min(COLUMNS, len(wanted) - begin)), np.float32)
        present[row[chosen], at[chosen] - begin] = 1
        out += present[: len(xs)] @ present[len(xs) :].T
    return out


def _forest(linked: np.ndarray, one_block: bool) -> list[tuple[int, int]]:
    """A spanning forest of the links between rows and columns (of one block: the same texts)."""
    n, m = linked.shape
    if one_block:
        near = linked | linked.T
    else:
        near = np.zeros((n + m, n + m), bool)
        near[:n, n:] = linked
        near[n:, :n] = linked.T
    unseen = near.any(axis=1)
    edges = []
    while unseen.any():
        queue = [int(unseen.argmax())]
        unseen[queue[0]] = False
        while queue:
            node = queue.pop()
            new = np.flatnonzero(near[node] & unseen)
            unseen[new] = False
            edges += [(node, int(x)) for x in new]
            queue += new.tolist()
    return edges


def _verify_blocks(batches: Iterator[pa.RecordBatch], similar: float) -> Iterator[pa.RecordBatch]:
    """Link counts (a, n) and forest edges (a, b) of each pair of blocks of a crowded prefix."""
    for rows in groups(batches, "key", "low", "high"):
        key, one_block = rows[0]["key"], rows[0]["low"] == rows[0]["high"]
        left = [r for r in rows if r["own"] == rows[0]["low"]]
        right = left if one_block else [r for r in rows if r["own"] == rows[0]["high"]]
        if not left or not right:
            continue
        # pairs that share a crowded prefix of less key are counted there
        earlier = [
            [np.array(sorted(k for k in set(r["crowded"]) if k < key), np.int64) for r in side]
            for side in (left, right)
        ]
        open_ = _overlaps(*earlier) == 0
        if one_block:
            open_ &= np.triu(np.ones(open_.shape, bool), 1)
        if not open_.any():
            continue
        xs, ys = ([np.frombuffer(r["grams"], np.uint64) for r in side] for side in (left, right))
        both = _overlaps(xs, ys)
        sizes = np.array([len(x) for x in xs])[:, None] + np.array([len(y) for y in ys])[None, :]
        linked = open_ & (both >= similar * (sizes - both))
        out = []
        for side, other, links in ((left, right, linked), (right, left, linked.T)):
            counts = links @ np.array([r["copies"] for r in other], np.int64)
            out += [(side[i]["cid"], None, int(counts[i])) for i in np.flatnonzero(counts)]
        nodes = left if one_block else [*left, *right]
        out += [(nodes[i]["cid"], nodes[j]["cid"], None) for i, j in _forest(linked, one_block)]
        yield to_batch(out, "a long, b long, n long")


def join(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """doc_id, class_id, n_links, component_id and kept of every document.

    class_id is the least doc_id with the same shingles, n_links the number of other documents at
    ``similar`` or more, component_id the least doc_id reachable by links, and kept is true where
    component_id is the doc_id of the row.
    """
    found = classes(docs, similar)
    return found.select(
        "doc_id", real_id("class_did").alias("class_id"), "n_links",
        real_id("component_did").alias("component_id"),
        (F.col("did") == F.col("component_did")).alias("kept"),
    )


def keep_one(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """The documents, all their columns, without all but the first of each component."""
    found = classes(docs, similar)
    firsts = (
        found.filter((F.col("did") == F.col("component_did")) & (F.col("rk") == F.col("component_rk")))
        .select("did", "rk").distinct()
    )
    # texts without a word have no group, and all of them stay
    bare = F.coalesce(~F.col("text").rlike("[^ \t\n\x0b\f\r]"), F.lit(True))
    rows = docs.filter(~bare).select(F.struct("*").alias("row"), *(c.alias(n) for n, c in row_names().items()))
    chosen = rows.join(firsts, ["did", "rk"]).dropDuplicates(["did", "rk"])
    return chosen.select("row.*").unionByName(docs.filter(bare))


def classes(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """did, rk, class_did, n_links, component_did and component_rk of every document."""
    length, depth = TREES * DEEPEST, depth_for(similar)
    texts = docs.select("doc_id", "text").withColumns(row_names())
    sets = stage(
        texts.mapInArrow(functools.partial(_describe, length=length), DESCRIBED)
        .withColumn("row", F.monotonically_increasing_id()),
        "signatures",
    )
    filled = sets.filter("shingles > 0")
    known = stage(
        filled.groupBy("k1", "k2").agg(
            F.min(F.struct("did", "rk", "row")).alias("one"), F.count("*").alias("copies")
        ).select("k1", "k2", "copies", F.col("one.did").alias("did"), F.col("one.rk").alias("rk"),
                 F.col("one.row").alias("cid")),
        "shingle-classes",
    )
    ones = stage(
        sets.select(F.col("row").alias("cid"), "signature").join(known.select("cid"), "cid"), "class-signatures"
    )

    keys = ones.mapInArrow(
        functools.partial(_prefixes, trees=TREES, depth=depth), "cid long, key long"
    )
    sizes = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    sizes = stage(sizes, "prefix-sizes")  # so that the join may be split at a crowded prefix
    shared = stage(keys.join(sizes, "key"), "shared-prefixes")
    crowded = shared.filter(F.col("n") > CROWD)
    crowds = stage(
        crowded.groupBy("cid").agg(F.collect_set("key").alias("crowded")), "crowded-texts"
    )

    # pairs from prefixes of few texts
    few = shared.filter(F.col("n") <= CROWD)
    pairs = few.select("key", F.col("cid").alias("a")).join(
        few.select("key", F.col("cid").alias("b")), "key"
    ).filter("a < b").select("a", "b").distinct()
    of_a = crowds.select(F.col("cid").alias("a"), F.col("crowded").alias("ca"))
    of_b = crowds.select(F.col("cid").alias("b"), F.col("crowded").alias("cb"))
    apart = ~F.coalesce(F.arrays_overlap("ca", "cb"), F.lit(False))
    pairs = pairs.join(of_a, "a", "left").join(of_b, "b", "left").filter(apart).select("a", "b")
    likely = stage(
        pairs.join(ones.select(F.col("cid").alias("a"), F.col("signature").alias("sa")), "a")
        .join(ones.select(F.col("cid").alias("b"), F.col("signature").alias("sb")), "b")
        .mapInArrow(functools.partial(_likely, similar=similar), "a long, b long"),
        "likely-pairs",
    )

    # the shingles of the texts in question
    wanted = (
        likely.select(F.col("a").alias("cid")).union(likely.select("b")).union(crowds.select("cid"))
        .distinct().join(known, "cid").select("cid", "did", "rk", "copies")
    )
    grams = stage(
        keyed(docs).join(wanted, ["did", "rk"]).dropDuplicates(["did", "rk"])
        .select("cid", "copies", "text").mapInArrow(_shingles, "cid long, copies long, grams binary"),
        "shingles",
    )
    links = stage(
        likely.join(grams.select(F.col("cid").alias("a"), F.col("copies").alias("ma"), F.col("grams").alias("ga")), "a")
        .join(grams.select(F.col("cid").alias("b"), F.col("copies").alias("mb"), F.col("grams").alias("gb")), "b")
        .mapInArrow(functools.partial(_verify, similar=similar), "a long, b long, ma long, mb long"),
        "links",
    )

    # crowded prefixes, block against block
    many = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = crowded.withColumn("own", F.pmod(F.xxhash64("cid"), many).cast("int")).select(
        "key", "cid", "own", F.explode(F.sequence(F.lit(0), many - 1)).alias("other")
    ).select(
        "key", "cid", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
    )
    inside = stage(
        dealt.join(crowds, "cid").join(grams, "cid")
        .repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", "cid")
        .mapInArrow(functools.partial(_verify_blocks, similar=similar), "a long, b long, n long"),
        "crowded-links",
    )

    counted = (
        links.select(F.col("a").alias("cid"), F.col("mb").alias("n"))
        .union(links.select("b", "ma")).union(inside.filter("n is not null").select("a", "n"))
        .groupBy("cid").agg(F.sum("n").alias("others"))
    )
    edges = links.select("a", "b").union(inside.filter("b is not null").select("a", "b"))
    named = components(edges).select(F.col("id").alias("cid"), "component")
    judged = stage(
        known.join(counted, "cid", "left").join(named, "cid", "left").select(
            "k1", "k2", F.col("did").alias("class_did"), "rk",
            (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
            F.coalesce("component", "cid").alias("component"),
        ),
        "judged-classes",
    )
    firsts = judged.groupBy("component").agg(F.min(F.struct("class_did", "rk")).alias("first"))
    result = judged.join(firsts, "component").select(
        "k1", "k2", "class_did", "n_links", F.col("first.class_did").alias("component_did"),
        F.col("first.rk").alias("component_rk"),
    )
    linked = filled.select("doc_id", "did", "rk", "k1", "k2").join(result, ["k1", "k2"]).drop("k1", "k2")
    alone = sets.filter("shingles = 0").select(
        "doc_id", "did", "rk", F.col("did").alias("class_did"), F.lit(0).cast("long").alias("n_links"),
        F.col("did").alias("component_did"), F.col("rk").alias("component_rk"),
    )
    return linked.unionByName(alone)

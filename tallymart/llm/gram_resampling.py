"""Importance resampling towards a target: hashed n-gram gains, Gumbel keys, one global order.

A block of texts becomes words by Arrow kernels: ``ascii_lower``, ``split_pattern_regex``,
``list_flatten`` and ``dictionary_encode``. Neighbouring dictionary indices of one text form the
two-word features; each distinct pair of a block gets its CRC once, from those of its two words. Bucket counts add up within a task to one array before the shuffle, so both passes
over the texts move a few numbers only. The second pass takes the gain of each feature's bucket and
sums them over each text.

The order of all scores comes from one range sort by (score, doc_id, place), which splits ties of
any size, with the rows of earlier partitions added to the position within each.

Null and empty texts have no words: weight 0, and fewer than 20 words, so they are not drawn. A
null doc_id is written as nothing in the hashed key and comes after all others among equal scores.
Repeated rows each count and are drawn on their own; which of equal rows comes first is of no
consequence. Texts of any length are read whole, a row at a time if need be. Tables may be empty,
the target as well: all gains are then those of an empty target. Further columns are ignored.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.text import blocks, utf8
from tallymart.sources.staging import stage

BUCKETS = 10_000
LEAST_WORDS = 20
DRAWN_PER_CENT = 25
SEED = 7
#: Bytes of texts that share a dictionary of words and of pairs.
BLOCK = 1 << 21
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

def _zero_byte(crc: np.ndarray) -> np.ndarray:
    return crc >> 8 ^ _ZERO[crc & 0xFF]


_ZERO = np.arange(256)
for _ in range(8):  # the reflected polynomial of zlib's CRC-32
    _ZERO = _ZERO >> 1 ^ np.where(_ZERO & 1, 0xEDB88320, 0)


def moved(crc: np.ndarray, places: np.ndarray) -> np.ndarray:
    """What each CRC adds to that of a string ``places`` bytes longer: crc(a + b) = moved(crc(a), len(b)) ^ crc(b)."""
    out, todo = crc.copy(), np.flatnonzero(places > 0)
    done = 0
    while len(todo):
        out[todo] = _zero_byte(out[todo])
        done += 1
        todo = todo[places[todo] > done]
    return out


class Features:
    """The one- and two-word features of a block of texts, as buckets of their CRC."""

    def __init__(self, texts: pa.Array, buckets: int = BUCKETS):
        lowered = pc.ascii_lower(texts.fill_null(""))
        parts = pc.split_pattern_regex(lowered, pattern=BETWEEN_WORDS)
        words, owner = pc.list_flatten(parts), pc.list_parent_indices(parts)
        real = pc.not_equal(words, "")  # a text may begin or end between words
        encoded = pc.dictionary_encode(words.filter(real))
        self.n_texts = len(texts)
        self.word_owner = owner.filter(real).to_numpy(zero_copy_only=False)
        index = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        data, bounds = utf8(encoded.dictionary)
        raw, edges = data.tobytes(), bounds.tolist()
        alone = np.fromiter((zlib.crc32(raw[a:b]) for a, b in zip(edges, edges[1:])), np.int64, len(edges) - 1)

        n = max(1, len(alone))
        within = self.word_owner[:-1] == self.word_owner[1:]
        distinct, which = np.unique((index[:-1] * n + index[1:])[within], return_inverse=True)
        first, second = distinct // n, distinct % n
        opened = moved(alone, np.ones(n, np.int64)[: len(alone)]) ^ zlib.crc32(b" ")
        joined = moved(opened[first], np.diff(bounds)[second]) ^ alone[second]
        #: the bucket of every single word and of every pair, and the text of each
        self.single, self.double = (alone % buckets)[index], (joined % buckets)[which]
        self.pair_owner = self.word_owner[:-1][within]

    def counts(self, buckets: int = BUCKETS) -> np.ndarray:
        return np.bincount(self.single, minlength=buckets) + np.bincount(self.double, minlength=buckets)

    def n_words(self) -> np.ndarray:
        return np.bincount(self.word_owner, minlength=self.n_texts)

    def n_features(self) -> np.ndarray:
        return self.n_words() + np.bincount(self.pair_owner, minlength=self.n_texts)

    def sums(self, gains: np.ndarray) -> np.ndarray:
        """Per text, the sum of the gains of its features. Both families lie in order of the texts."""
        total = np.zeros(self.n_texts, np.int64)
        for bucket, owner in ((self.single, self.word_owner), (self.double, self.pair_owner)):
            until = np.concatenate([[0], np.cumsum(gains.take(bucket))])
            edges = np.searchsorted(owner, np.arange(self.n_texts + 1))
            total += until[edges[1:]] - until[edges[:-1]]
        return total


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for block in blocks(batch, "text", BLOCK):
            total += Features(block.column("text")).counts()
    found = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["bucket", "n"])


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """How many features of all texts fall into each bucket."""
    counted = texts.select("text").mapInArrow(_count, "bucket long, n long")
    rows = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # a row for each bucket
    out = np.zeros(BUCKETS, np.int64)
    out[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Whole thousandths of the log-ratio of smoothed bucket shares, rounded down."""
    s, t = source.astype(np.float64), target.astype(np.float64)
    ratio = ((t + 1) * (s.sum() + len(s))) / ((s + 1) * (t.sum() + len(t)))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _weigh(batches: Iterator[pa.RecordBatch], gain: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch, "text", BLOCK):
            features = Features(block.column("text"))
            n = features.n_features()
            weight = features.sums(gain) // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), *(pa.array(c.astype(np.int64)) for c in (features.n_words(), n, weight))],
                ["doc_id", "n_words", "n_features", "weight"],
            )


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """Thousandths of a Gumbel draw, rounded down, from a hash of the seed and the id."""
    written = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(written, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def _draw_order() -> list[Column]:
    return [
        F.col("eligible").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row").asc(),
    ]


def resample(
    docs: DataFrame, target: DataFrame, per_cent: int = DRAWN_PER_CENT, least_words: int = LEAST_WORDS
) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document; rank is null if it is not drawn."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    gain = gains(bucket_counts(texts), bucket_counts(target))
    weighed = texts.mapInArrow(
        functools.partial(_weigh, gain=gain), "doc_id long, n_words long, n_features long, weight long"
    )
    scored = stage(
        weighed.select(
            "doc_id", "n_features", "weight", (F.col("weight") + gumbel(F.col("doc_id"))).alias("score"),
            (F.col("n_words") >= least_words).alias("eligible"),
        ),
        "scores",
    )
    numbered = scored.withColumn("row", F.monotonically_increasing_id())
    place = F.monotonically_increasing_id()  # the partition above, the place in it below
    ordered = stage(
        numbered.repartitionByRange(*_draw_order()).sortWithinPartitions(*_draw_order())
        .select(*scored.columns, F.shiftright(place, 33).cast("int").alias("part"),
                place.bitwiseAND((1 << 33) - 1).alias("place")),
        "draw-order",
    )
    # one row for each partition of the sort
    sizes = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("_n"), F.count_if("eligible").alias("_eligible"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everywhere = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    bases = sizes.select(
        "part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.floor(per_cent * F.sum("_eligible").over(everywhere) / 100).alias("_drawn"),
    )
    at = F.col("_before") + F.col("place") + 1
    return ordered.join(F.broadcast(bases), "part").select(
        "doc_id", "n_features", "weight", "score",
        F.when(F.col("eligible") & (at <= F.col("_drawn")), at).alias("rank"),
    )

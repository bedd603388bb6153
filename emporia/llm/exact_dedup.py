"""Exact dedup: immutable snapshots screened by static binary-fuse filters.

The corpus arrives in batches.  What has been taken in is an immutable snapshot
of distinct digests, dealt into buckets of bounded size with one binary-fuse
filter each.  An incoming batch is first grouped by itself (map-side, so one
text with a third of all rows is one row after the first aggregate); its
distinct digests are screened by the filters; only positives join the exact
buckets, where the bytes of the two texts are compared.  Filters have no false
negatives, so a negative is new for sure; a false positive finds no partner in
its bucket.

Two texts are equal when they are identical after each run of space, tab, line
feed, vertical tab, form feed and carriage return became one space; a null text
counts as empty, so null and empty texts are one group.  Of equal texts the
smallest ``doc_id`` stays (ties: a repeated ``doc_id`` stays once per row).  One
``doc_id`` may stand on rows of different texts: a row belongs to its text's group.
Null ids come after all others; a text that only null ids have has a null
``keep_id``, and its rows stay.  An
empty table gives an empty result; columns other than ``doc_id`` and ``text``
are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import splitmix, written

#: Digests a bucket's filter is built for; the number of buckets follows the data.
BUCKET_DIGESTS = 16_384
LEAST_BUCKETS = 32
#: Hex digits of a digest that the filter over the pairs' texts sees: at most 2^20 different keys.
PREFIX_DIGITS = 5


def normalised(text: str = "text"):
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


# ---- binary-fuse filter (three segments in a row, 16-bit fingerprints) ----
class BinaryFuse:
    """Static filter over distinct 64-bit keys: 3 slots in adjoining segments, one XOR per look-up."""

    def __init__(self, seed: int, segment: int, slots: np.ndarray):
        self.seed, self.segment, self.slots = seed, segment, slots

    @staticmethod
    def _places(keys: np.ndarray, seed: int, segment: int, length: int) -> tuple[list[np.ndarray], np.ndarray]:
        h = splitmix(keys ^ np.uint64(seed))
        starts = (length // segment) - 2
        first = (h >> np.uint64(32)) % np.uint64(starts)
        mask = np.uint64(segment - 1)
        g = splitmix(h)
        places = [((first + np.uint64(i)) * np.uint64(segment) + ((g >> np.uint64(20 * i)) & mask)).astype(np.int64) for i in range(3)]
        return places, (splitmix(g) & np.uint64(0xFFFF)).astype(np.uint16)

    @classmethod
    def build(cls, keys: np.ndarray) -> "BinaryFuse":
        keys = np.unique(keys.astype(np.uint64))
        n = len(keys)
        if n == 0:
            return cls(0, 4, np.zeros(0, np.uint16))
        segment = 1 << max(2, min(18, int(math.log(n) / math.log(3.33) + 2.25)))
        factor = 1.125 if n <= 1 else max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
        length = (max(1, math.ceil(n * factor / segment)) + 2) * segment
        for seed in range(1, 200):
            if seed % 20 == 0:
                length += segment * max(1, length // segment // 8)
            places, prints = cls._places(keys, seed, segment, length)
            order = cls._peel(places, n, length)
            if order is not None:
                slots = np.zeros(length, np.uint16)
                p = [x.tolist() for x in places]
                values, s = prints.tolist(), slots.tolist()
                for key, at in reversed(order):
                    a, b, c = p[0][key], p[1][key], p[2][key]
                    s[at] = values[key] ^ s[a] ^ s[b] ^ s[c] ^ s[at]
                return cls(seed, segment, np.array(s, np.uint16))
        raise ValueError("no seed peels this set of keys")

    @staticmethod
    def _peel(places: list[np.ndarray], n: int, length: int) -> list[tuple[int, int]] | None:
        count, which = np.zeros(length, np.int64), np.zeros(length, np.int64)
        keys = np.arange(n)
        for p in places:
            np.add.at(count, p, 1)
            np.bitwise_xor.at(which, p, keys)
        stack = np.flatnonzero(count == 1).tolist()
        c, w, p = count.tolist(), which.tolist(), [x.tolist() for x in places]
        order: list[tuple[int, int]] = []
        while stack:
            at = stack.pop()
            if c[at] != 1:
                continue
            key = w[at]
            order.append((key, at))
            for x in p:
                slot = x[key]
                c[slot] -= 1
                w[slot] ^= key
                if c[slot] == 1:
                    stack.append(slot)
        return order if len(order) == n else None

    def contains(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.slots):
            return np.zeros(len(keys), bool)
        (a, b, c), prints = self._places(keys.astype(np.uint64), self.seed, self.segment, len(self.slots))
        return (self.slots[a] ^ self.slots[b] ^ self.slots[c]) == prints


def _key64(digests: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(bytes(d)[:8] for d in digests), np.uint64) if len(digests) else np.zeros(0, np.uint64)


def build_filters(snapshot: DataFrame) -> DataFrame:
    """One filter per bucket of ``snapshot(bucket, digest)``."""

    def build(group: pd.DataFrame) -> pd.DataFrame:
        f = BinaryFuse.build(_key64(group["digest"]))
        return pd.DataFrame({"bucket": group["bucket"].iloc[:1], "seed": [f.seed], "segment": [f.segment], "slots": [f.slots.tobytes()]})

    return snapshot.select("bucket", "digest").groupBy("bucket").applyInPandas(build, "bucket long, seed long, segment long, slots binary")


def screen(batch: DataFrame, filters: DataFrame) -> DataFrame:
    """Rows of ``batch(bucket, digest, ...)`` that the filter of their bucket lets through."""

    def test(rows: pd.DataFrame, f: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(f):
            return rows.iloc[:0]
        x = BinaryFuse(int(f["seed"].iloc[0]), int(f["segment"].iloc[0]), np.frombuffer(bytes(f["slots"].iloc[0]), np.uint16))
        return rows[x.contains(_key64(rows["digest"]))]

    return batch.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInPandas(test, batch.schema)


def classes(docs: DataFrame, batches: int = 2) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, digest, keep_id, group_size.

    ``batches`` deliveries (by a hash of ``doc_id``) are taken in one after the
    other, each against the snapshot of those before.
    """
    spark = docs.sparkSession
    text = normalised()
    digests = written(spark, docs.select(
        "doc_id", F.sha2(text, 256).alias("hex"),
        F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int").alias("batch")), "exact-digests")
    # New-batch duplicates are grouped on their own; map-side partial aggregates make a hot text one row.
    rows = digests.groupBy().agg(F.count("*")).first()[0]
    buckets = max(LEAST_BUCKETS, math.ceil(rows / batches / BUCKET_DIGESTS))
    groups = digests.groupBy("batch", "hex").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n"))
    groups = written(spark, groups.select(
        "batch", "hex", "rep", "n", F.unhex("hex").alias("digest"),
        F.pmod(F.xxhash64("hex"), F.lit(buckets)).alias("bucket")), "exact-groups")
    snapshot = groups.where("batch = 0").select("hex", "rep", "n", "digest", "bucket")
    for k in range(1, batches):
        incoming = groups.where(F.col("batch") == k).select("hex", "rep", "n", "digest", "bucket")
        positives = written(spark, screen(incoming, build_filters(snapshot)).select("hex", "rep", "n"), "exact-positives")
        pairs = written(spark, positives.join(
            snapshot.select("hex", F.col("rep").alias("old"), F.col("n").alias("old_n")), "hex"), "exact-pairs")
        same = written(spark, equal_bytes(docs, pairs), "exact-same")
        merged = (snapshot.select("hex", "rep", "n", "digest", "bucket")
                  .unionByName(incoming.join(same.select("hex"), "hex", "left_anti").select("hex", "rep", "n", "digest", "bucket"))
                  .join(same.select("hex", F.col("rep").alias("new_rep"), F.col("n").alias("new_n")), "hex", "left"))
        snapshot = written(spark, merged.select(
            "hex", F.least("rep", F.coalesce("new_rep", "rep")).alias("rep"),
            (F.col("n") + F.coalesce("new_n", F.lit(0))).alias("n"), "digest", "bucket"), f"exact-snapshot{k}")
    ids = snapshot.select("hex", F.col("rep").alias("keep_id"), F.col("n").alias("group_size"))
    return digests.select("doc_id", "hex").join(ids, "hex")


def named_texts(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id, t, h): id, normalised text and hash of the rows that a binary-fuse filter of the pairs' digests lets through.

    The filter stands over the first ``PREFIX_DIGITS`` hex digits of the digests, 2^20 values at most (a filter of
    2.4 MB and 8 MB to the driver, whatever the table's size), and goes to every task: only texts that may be in a
    pair are shuffled.  The more pairs there are, the more others it lets through; the join below is exact.
    """
    heads = pairs.select(F.conv(F.substring("hex", 1, PREFIX_DIGITS), 16, 10).cast("long").alias("k")).distinct().collect()
    f = BinaryFuse.build(np.array([r.k for r in heads], np.uint64))

    @F.pandas_udf("boolean")
    def may_be_named(head: pd.Series) -> pd.Series:
        return pd.Series(f.contains(head.to_numpy().astype(np.uint64)))

    texts = docs.select(F.col("doc_id").alias("id"), normalised().alias("t")).withColumn("h", F.sha2("t", 256))
    return texts.where(may_be_named(F.conv(F.substring("h", 1, PREFIX_DIGITS), 16, 10).cast("long")))


def equal_bytes(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The ``pairs(hex, rep, n, old, old_n)`` whose two normalised texts are the same bytes.

    Both texts of a pair meet under its digest; only documents that pass the
    pairs' filter move, one pair per distinct text, so no hot group forms.
    """
    ends = pairs.select(F.explode(F.array("rep", "old")).alias("doc_id"), "hex")
    texts = named_texts(docs, pairs)
    met = ends.join(texts, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("h") == F.col("hex"))).groupBy("hex").agg(F.min("t").alias("a"), F.max("t").alias("b"))
    return pairs.join(met.where("a = b").select("hex"), "hex", "left_semi")


def dedup(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text an earlier ``doc_id`` has; all columns stay."""
    keep = classes(docs).where("doc_id <=> keep_id").select(F.col("doc_id").alias("_keep_id"), F.col("hex").alias("_keep_hex")).distinct()
    return docs.join(keep, docs["doc_id"].eqNullSafe(F.col("_keep_id")) & (F.sha2(normalised(), 256) == F.col("_keep_hex")), "left_semi")

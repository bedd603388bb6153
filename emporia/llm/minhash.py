"""MinHash near-dedup with BagMinHash signatures of word 5-gram multisets.

A document is the multiset of its word 5-grams (fewer words: one gram of all of
them).  The weight axis of every gram is cut at 0, 1, 2, 4, 8, ...; each piece
is a Poisson process of its own whose points carry a time, a signature slot and
a weight.  A point counts for a document if its weight lies under the gram's
multiplicity there, so two documents share exactly the points of their weighted
overlap and a slot's smallest time agrees with probability equal to the
weighted Jaccard similarity.  Pieces are followed only until their time passes
the largest slot minimum: the cost follows the number of distinct grams and the
logarithm of their counts.

Signatures are banded (32 bands of 4: a pair at the threshold is missed with
probability 5e-8).  Within a band every document is compared with a hub, not
with every other one; the documents of bands that do not end in one class are
then joined exactly on their rarest grams (``prefix_pairs``).  Every link is
verified on the multisets themselves.  Classes are the connected components of
the links.

Documents with the same word sequence are one node from the start; a node is
known by the hash of its sequence, never by a ``doc_id``, so ids may be null or
stand on rows of different texts.  Documents without words (null, empty, signs
only) are classes of one.  A class is named by its smallest ``doc_id`` (null if
it has none); every row of the table is returned once; extra columns are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import as_bytes, batch_words, small_batches, splitmix, trimmed, written

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 32, 4
SLOTS = BANDS * ROWS


def batch_shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, gram, multiplicity) of the distinct grams, and a hash of each row's word sequence (0: no words)."""
    rows, _, words = batch_words(texts)
    n = np.bincount(rows, minlength=len(texts))
    first = np.concatenate([[0], np.cumsum(n)])[:-1]
    place = np.arange(len(words)) - first[rows]
    seq = np.zeros(len(texts), np.uint64)
    with np.errstate(over="ignore"):
        np.add.at(seq, rows, splitmix(words ^ splitmix(place.astype(np.uint64))))
        seq = np.where(n > 0, splitmix(seq ^ n.astype(np.uint64)) | np.uint64(1), np.uint64(0))
        gram = np.zeros(len(words), np.uint64)
        for k in range(SHINGLE):  # a short document's one gram holds what words there are
            there = place + k < n[rows]
            w = np.zeros(len(words), np.uint64)
            w[there] = words[np.flatnonzero(there) + k]
            gram = splitmix(gram ^ w) + np.uint64(k)
    starts = (place + SHINGLE <= n[rows]) | (place == 0)
    r, g = rows[starts], gram[starts]
    order = np.lexsort((g, r))
    r, g = r[order], g[order]
    new = np.ones(len(g), bool)
    new[1:] = (r[1:] != r[:-1]) | (g[1:] != g[:-1])
    at = np.flatnonzero(new)
    return r[at], g[at], np.diff(np.append(at, len(g))), seq


def _unit(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(11)).astype(np.float64) * 2.0**-53


def bag_minhash(rows: np.ndarray, grams: np.ndarray, counts: np.ndarray, n_rows: int, slots: int = SLOTS) -> np.ndarray:
    """BagMinHash signatures (float64 times, ``n_rows`` x ``slots``) of weighted gram sets."""
    signature = np.full((n_rows, slots), np.inf)
    levels = np.ceil(np.log2(np.maximum(counts, 1))).astype(np.int64) + 1  # pieces (0,1], (1,2], (2,4], ...
    of = np.repeat(np.arange(len(grams)), levels)
    level = np.arange(len(of)) - np.repeat(np.cumsum(levels) - levels, levels)
    row, weight = rows[of], counts[of]
    low = np.where(level == 0, 0.0, 2.0 ** (level - 1.0))
    width = np.where(level == 0, 1.0, low)
    seed = splitmix(grams[of] ^ splitmix(level.astype(np.uint64)))
    time, point = np.zeros(len(of)), 0
    flat = signature.reshape(-1)
    while len(row):
        h = splitmix(seed + np.uint64(2 * point + 1))
        g = splitmix(h ^ np.uint64(0x5851F42D4C957F2D))
        time = time - np.log1p(-_unit(h)) / width
        limit = signature.max(axis=1)
        slot = (g % np.uint64(slots)).astype(np.int64)
        under = low + width * _unit(splitmix(g)) <= weight
        near = time < limit[row]
        hit = under & near
        np.minimum.at(flat, row[hit] * slots + slot[hit], time[hit])
        row, weight, low, width, seed, time = (x[near] for x in (row, weight, low, width, seed, time))
        point += 1
    return signature


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key per band and row."""
    bits = np.ascontiguousarray(signature).view(np.uint64).reshape(len(signature), BANDS, ROWS)
    key = np.broadcast_to(splitmix(np.arange(BANDS, dtype=np.uint64)), bits.shape[:2]).copy()
    for k in range(ROWS):
        key = splitmix(key ^ bits[:, :, k])
    return key.view(np.int64)


def weighted_jaccard(g1: np.ndarray, c1: np.ndarray, g2: np.ndarray, c2: np.ndarray) -> float:
    """Similarity of two multisets given as sorted distinct grams and their counts."""
    _, i, j = np.intersect1d(g1, g2, assume_unique=True, return_indices=True)
    both = np.minimum(c1[i], c2[j]).sum()
    return both / max(c1.sum() + c2.sum() - both, 1)


def _slices(texts: list, size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(texts):
        end, chars = at, 0
        while end < len(texts) and (end == at or chars < size):
            chars, end = chars + len(texts[end]), end + 1
        yield at, end
        at = end


def nodes(docs: DataFrame) -> DataFrame:
    """(doc_id, th, seq, bands): the text's hash, the word-sequence hash and the band keys of every document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = as_bytes(b["text"])
            for lo, hi in _slices(texts):
                r, g, c, seq = batch_shingles(texts[lo:hi])
                keys = band_keys(bag_minhash(r, g, c, hi - lo))
                yield pd.DataFrame({"doc_id": b["doc_id"].array[lo:hi], "th": b["th"].array[lo:hi], "seq": seq.view(np.int64), "bands": list(keys)})

    # The id is carried as text: a batch with a null id would turn whole numbers into floats.
    got = _hashed(docs).withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(trimmed(run), "doc_id string, th long, seq long, bands array<long>")
    return got.withColumn("doc_id", F.col("doc_id").cast("long"))


def _hashed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.xxhash64(text).alias("th"), text.alias("text"))


def multisets(texts: DataFrame) -> DataFrame:
    """(doc_id, grams, counts) of every row of ``texts(text)``; ``doc_id`` is the node, the hash of the word sequence."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            all_texts = as_bytes(b["text"])
            for lo, hi in _slices(all_texts):
                r, g, c, seq = batch_shingles(all_texts[lo:hi])
                cut = np.searchsorted(r, np.arange(1, hi - lo))
                yield pd.DataFrame({"doc_id": seq.view(np.int64), "grams": np.split(g.view(np.int64), cut) if hi > lo else [],
                                    "counts": np.split(c.astype(np.int32), cut) if hi > lo else []})

    return texts.select("text").mapInPandas(trimmed(run), "doc_id long, grams array<long>, counts array<int>")


def verified(pairs: DataFrame, bags: DataFrame, threshold: float) -> DataFrame:
    """The ``pairs(a, b)`` whose multisets overlap enough."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            ok = [weighted_jaccard(g1.view(np.uint64), c1, g2.view(np.uint64), c2) >= threshold
                  for g1, c1, g2, c2 in zip(p["g1"], p["c1"], p["g2"], p["c2"], strict=True)]
            yield p.loc[ok, ["a", "b"]]

    one = bags.select(F.col("doc_id").alias("a"), F.col("grams").alias("g1"), F.col("counts").alias("c1"))
    two = bags.select(F.col("doc_id").alias("b"), F.col("grams").alias("g2"), F.col("counts").alias("c2"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "g1", "c1", "g2", "c2").mapInPandas(trimmed(run), "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(doc_id, class_id): each linked document with the smallest of its component.

    Alternating hooking: every node points at the smallest neighbour seen, then at its
    target's target, until nothing changes; each round is written to the shared folder.
    """
    spark = links.sparkSession
    both = written(spark, links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), "near-edges")
    label = written(spark, both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("l")), "near-label")
    while True:
        near = both.join(label.select(F.col("a").alias("b"), "l"), "b").groupBy("a").agg(F.min("l").alias("m"))
        hooked = label.join(near, "a").select("a", "l", F.least("l", "m").alias("m"))
        jump = label.select(F.col("a").alias("m"), F.col("l").alias("j"))
        step = written(spark, hooked.join(jump, "m").select("a", F.col("l").alias("was"), F.least("m", "j").alias("l")), "near-label")
        if step.where("was <> l").isEmpty():
            return step.select(F.col("a").alias("doc_id"), F.col("l").alias("class_id"))
        label = step.select("a", "l")


def prefix_pairs(open_docs: DataFrame, bags: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of different classes that share a gram among their rarest.

    With the grams of every document ordered by how many documents hold them, two
    multisets of similarity ``threshold`` share a gram among the first
    ``size - ceil(threshold * size) + 1`` of either, and at the first one both have
    enough left for the overlap: no link is lost.  A copy with many edits has only grams of its own there and makes no pair.  Within a gram's
    documents only those outside its largest class are compared, with all others.
    """
    spark = open_docs.sparkSession
    def flat(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for doc, cls, grams, counts in zip(b["doc_id"], b["class_id"], b["grams"], b["counts"], strict=True):
                yield pd.DataFrame({"doc_id": doc, "class_id": cls, "size": int(counts.sum()), "gram": grams, "n": counts})

    grams = open_docs.join(bags, "doc_id").select("doc_id", "class_id", "grams", "counts").mapInPandas(
        trimmed(flat), "doc_id long, class_id long, size long, gram long, n int")
    grams = written(spark, grams, "near-grams")
    often = written(spark, grams.groupBy("gram").agg(F.count("*").alias("df")), "near-df")

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for doc, cls, size, rows in zip(b["doc_id"], b["class_id"], b["size"], b["rows"], strict=True):
                last, at, some = size - int(np.ceil(threshold * size - 1e-9)), 0, []
                for r in rows:  # rarest first; ``at`` counts the elements before a gram
                    if at > last:
                        break
                    if r["df"] > 1:
                        some.append((r["gram"], doc, cls, size, at))
                    at += r["n"]
                yield pd.DataFrame(some, columns=["gram", "doc_id", "class_id", "size", "at"]).astype("int64")

    rarest = grams.join(often, "gram").groupBy("doc_id", "class_id", "size").agg(F.array_sort(F.collect_list(F.struct("df", "gram", "n"))).alias("rows"))
    postings = written(spark, rarest.mapInPandas(trimmed(first), "gram long, doc_id long, class_id long, size long, at long"), "near-postings")
    main = written(spark, postings.groupBy("gram", "class_id").agg(F.count("*").alias("n")).groupBy("gram").agg(
        F.max_by("class_id", F.struct("n", "class_id")).alias("main"), F.count("*").alias("kinds")).where("kinds > 1").select("gram", "main"), "near-main")
    mixed = written(spark, postings.join(main, "gram"), "near-mixed")
    one = mixed.where("class_id <> main").select("gram", F.col("doc_id").alias("x"), F.col("class_id").alias("cx"), F.col("size").alias("sx"), F.col("at").alias("ax"))
    two = mixed.select("gram", F.col("doc_id").alias("y"), F.col("class_id").alias("cy"), F.col("size").alias("sy"), F.col("at").alias("ay"))
    # At the first gram that a similar pair shares, what follows on either side still holds the overlap needed.
    needed = threshold / (1 + threshold) * (F.col("sx") + F.col("sy")) - 1e-9
    near = (F.col("cx") != F.col("cy")) & (F.least(F.col("sx") - F.col("ax"), F.col("sy") - F.col("ay")) >= needed)
    return one.join(two, (one["gram"] == two["gram"]) & near).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, class_id (smallest doc_id of its class), class_size, th (hash of its text)."""
    with small_batches(docs.sparkSession):
        return _classes(docs, threshold)


def _classes(docs: DataFrame, threshold: float) -> DataFrame:
    spark = docs.sparkSession
    all_nodes = written(spark, nodes(docs), "near-nodes")
    # Copies of one word sequence are one node (``doc_id`` below is the node); one row of it lends its text.
    reps = written(spark, all_nodes.where("seq <> 0").groupBy(F.col("seq").alias("doc_id")).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("row"), F.first("bands").alias("bands")), "near-reps")
    rows = reps.select("doc_id", F.posexplode("bands").alias("band", "key")).select("doc_id", F.xxhash64("band", "key").alias("key"))
    # Tables that join on band keys are written first: each side then has its own exchange and a hot key can be split.
    shared = written(spark, rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "near-shared")
    members = written(spark, rows.join(shared, "key"), "near-members")
    wanted = reps.join(members.select("doc_id").distinct(), "doc_id", "left_semi").select(F.col("row.doc_id").alias("i"), F.col("row.th").alias("t"))
    texts = _hashed(docs).join(wanted, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("th") == F.col("t")), "left_semi").dropDuplicates(["doc_id", "th"])
    bags = written(spark, multisets(texts), "near-bags")

    # The hub of a band is its member with the most company over all its bands, most likely the common original.
    company = members.groupBy("doc_id").agg(F.sum("n").alias("company"))
    central = written(spark, members.join(company, "doc_id").groupBy("key").agg(F.max_by("doc_id", F.struct("company", F.col("doc_id"))).alias("hub")), "near-hubs")
    pairs = members.join(central, "key").where("doc_id <> hub").select(F.col("hub").alias("a"), F.col("doc_id").alias("b")).distinct()
    links = written(spark, verified(pairs, bags, threshold), "near-links")
    comp = components(links)
    # Bands that still hold more than one class: an exact join of their documents on rare grams finds what the hubs missed.
    placed = members.select("key", "doc_id").join(comp, "doc_id", "left").select("key", "doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))
    split = written(spark, placed.groupBy("key").agg(F.min("class_id").alias("lo"), F.max("class_id").alias("hi")).where("lo <> hi").select("key"), "near-split")
    left_open = written(spark, placed.join(split, "key", "left_semi").select("doc_id", "class_id").distinct(), "near-open")
    if not left_open.isEmpty():
        found = written(spark, verified(prefix_pairs(left_open, bags, threshold), bags, threshold), "near-links")
        if not found.isEmpty():
            comp = components(links.unionByName(found))
    named = written(spark, reps.select(F.col("doc_id").alias("seq")).join(comp.withColumnRenamed("doc_id", "seq"), "seq", "left").select(
        "seq", F.coalesce("class_id", "seq").alias("label")), "near-named")
    rows = written(spark, all_nodes.where("seq <> 0").select("doc_id", "th", "seq").join(named, "seq").select("doc_id", "th", "label"), "near-placed")
    sizes = written(spark, rows.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size")), "near-sizes")
    alone = all_nodes.where("seq = 0").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"), "th")
    return rows.join(sizes, "label").select("doc_id", "class_id", "class_size", "th").unionByName(alone)


def dedup(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the rows of one doc_id of each class (the smallest); all columns stay."""
    keep = classes(docs, threshold).where("doc_id <=> class_id").select(F.col("doc_id").alias("_keep_id"), F.col("th").alias("_keep_th")).distinct()
    here = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    return docs.join(keep, docs["doc_id"].eqNullSafe(F.col("_keep_id")) & (here == F.col("_keep_th")), "left_semi").select(*docs.columns)

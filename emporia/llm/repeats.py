"""Suffix dedup: bytes covered by 400-byte strings that start at more than one place.

A 400-byte window is named by the smallest of its 128-byte gram hashes (leftmost
on ties), so equal windows have equal names at equal offsets.  Successive windows
of a document with one named gram form a segment; segments whose gram occurs once
hold no repeated window and are gone after one map-side count.  Segments that are
equal as a whole are repeated as a whole.  Only segments that share a gram and
differ are left, mostly at the two ends of a passage; they go through the
column-wise construction.

That construction takes all segments of a bucket at once, aligned at their gram,
and inserts one symbol per segment each round, from the right: the order of the
suffixes that start in a column follows from the column before it by a stable
sort on the inserted symbols (the LF step of the collection's Burrows-Wheeler
transform), and the common prefixes of neighbours are updated with it (one more
than the least common prefix between their old places).  A window is repeated if
its suffix shares 400 symbols or more with a neighbour.  Because segments are
aligned, suffixes of different columns never have to be told apart, so the
state is one order and one prefix length per segment instead of a transform of
all suffixes; it fits in memory for a bounded bucket and no external file is needed.

Groups beyond ``HOT_SEGMENTS`` different segments of one gram never meet in a
task: their windows are counted by digest, which aggregates map-side and is exact.

Null counts as empty; texts under 400 bytes keep every byte; matches never cross
documents; a repeated row is one more occurrence.  Rows are told apart by id and text
(``own``, ``tk``; two hashes of the text where the id is null), so rows with a
null or repeated ``doc_id`` are cut like all others.  Extra columns are not read;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import RollingHash, as_bytes, shuffle_width, written

REPEAT, GRAM = 400, 128
BUCKET_SEGMENTS = 2048
HOT_SEGMENTS = 20_000
#: Bits of a place; Spark's texts are under 2 GiB.  Equal windows still agree on their smallest hash, by its other bits and then leftmost.
_INDEX = np.uint64((1 << 31) - 1)


def named_grams(hashes: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest hash of every ``width`` successive ones (leftmost on ties), by block minima."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    key = (hashes & ~_INDEX) | np.arange(len(hashes), dtype=np.uint64)
    blocks = np.concatenate([key, np.full(-len(key) % width, np.iinfo(np.uint64).max)]).reshape(-1, width)
    forth = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(back[:n], forth[width - 1 : width - 1 + n]) & _INDEX).astype(np.int64)


def segments_of(text: bytes, repeat: int = REPEAT, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(gram hash, first window, end of windows, place of the gram) of a text's segments."""
    if len(text) < repeat:
        return (np.zeros(0, np.int64),) * 4
    hashes = RollingHash(text).windows(gram)
    at = named_grams(hashes, repeat - gram + 1)
    cut = np.flatnonzero(np.diff(at)) + 1
    lo, hi = np.concatenate([[0], cut]), np.concatenate([cut, [len(at)]])
    return hashes[at[lo]].view(np.int64), lo, hi, at[lo]


def repeated_windows(group: np.ndarray, left: np.ndarray, windows: np.ndarray, count: np.ndarray, data: list[bytes], repeat: int = REPEAT
                     ) -> tuple[np.ndarray, np.ndarray]:
    """(segment, window) pairs whose ``repeat`` bytes also stand in another segment of the same group.

    ``left`` is the column of a segment's first byte relative to its gram, ``windows`` its number of
    windows; a segment with ``count`` over 1 has all its windows repeated and is only a partner here.
    Columns are taken from right to left.
    """
    n = len(data)
    size = np.array([len(d) for d in data])
    symbols = np.frombuffer(b"".join(data), np.uint8)
    base = np.concatenate([[0], np.cumsum(size)])[:-1] - left  # symbol of column c: symbols[base + c]
    right = left + size  # one past the last column
    lcp = np.zeros(n, np.int64)  # with the predecessor, per place in the order of the current column's suffixes
    entering: dict[int, list[int]] = {}
    for i, c in enumerate((right - 1).tolist()):
        entering.setdefault(c, []).append(i)
    current = np.zeros(0, np.int64)
    got_segment, got_window = [], []
    for column in range(int(right.max(initial=0)) - 1, int(left.min(initial=0)) - 1, -1):
        keep = left[current] <= column
        if not keep.all():  # segments that have ended on the left; the least common prefix in between stays
            kept = np.flatnonzero(keep)
            now = lcp[: len(current)]
            if len(kept):
                lcp[: len(kept)] = np.minimum.reduceat(now[: kept[-1] + 1], np.concatenate([[0], kept[:-1] + 1]))
            current = current[keep]
        new = entering.get(column)
        if new:  # empty suffixes sort before all others of their group
            new = np.array(new)
            lcp[: len(new) + len(current)] = np.concatenate([np.zeros(len(new), np.int64), lcp[: len(current)]])
            current = np.concatenate([new, current])
        if not len(current):
            continue
        m = len(current)
        old = lcp[:m].copy()
        symbol = symbols[base[current] + column].astype(np.int64)
        key = group[current] << 8 | symbol
        turn = np.argsort(key, kind="stable")
        key = key[turn]
        same = np.zeros(m, bool)
        same[1:] = key[1:] == key[:-1]
        fresh = np.zeros(m, np.int64)
        a = np.concatenate([[0], turn[:-1]])
        todo = np.flatnonzero(same)
        least = np.full(m, np.iinfo(np.int64).max)
        walk = turn.copy()
        while len(todo):  # least old common prefix over the places between the two
            least[todo] = np.minimum(least[todo], old[walk[todo]])
            walk[todo] -= 1
            todo = todo[(walk[todo] > a[todo]) & (least[todo] > 0)]
        fresh[same] = least[same] + 1
        lcp[:m] = fresh
        current = current[turn]
        shared = fresh >= repeat
        hit = shared.copy()
        hit[:-1] |= shared[1:]
        hit &= (count[current] == 1) & (column - left[current] < windows[current])
        if hit.any():
            at = np.flatnonzero(hit)
            got_segment.append(current[at])
            got_window.append(column - left[current[at]])
    if not got_segment:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(got_segment), np.concatenate(got_window)


def runs(owner: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, first, last) of the maximal runs of successive places."""
    order = np.lexsort((place, owner))
    o, p = owner[order], place[order]
    cut = np.flatnonzero((np.diff(o) != 0) | (np.diff(p) > 1)) + 1
    first, last = np.concatenate([[0], cut]), np.concatenate([cut - 1, [len(o) - 1]])
    return (o[first], p[first], p[last]) if len(o) else (o, p, p)


KEY = ["own", "tk"]


def _segments(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for own, tk, text in zip(b["own"], b["tk"], as_bytes(b["text"]), strict=True):
                h, lo, hi, at = segments_of(text)
                if len(h):
                    view = memoryview(text)
                    d = [int.from_bytes(hashlib.blake2b(view[x : y - 1 + REPEAT], digest_size=8).digest(), "little", signed=True)
                         for x, y in zip(lo.tolist(), hi.tolist(), strict=True)]
                    yield pd.DataFrame({"own": own, "tk": tk, "h": h, "d": d, "lo": lo, "hi": hi, "at": at})

    return docs.where(F.octet_length("text") >= REPEAT).mapInPandas(_joined(run), "own long, tk long, h long, d long, lo int, hi int, at int")


def _joined(run, rows: int = 50_000):
    """Small frames of ``run`` put together, so that few batches travel."""

    def out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        n = 0
        for frame in run(batches):
            held.append(frame)
            n += len(frame)
            if n >= rows:
                yield pd.concat(held, ignore_index=True)
                held, n = [], 0
        if held:
            yield pd.concat(held, ignore_index=True)

    return out


def _cut(texts: DataFrame, pieces: DataFrame) -> DataFrame:
    """Bytes of ``pieces(own, tk, h, lo, hi, at, n)``, cut from the texts they lie in."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for own, tk, text, parts in zip(b["own"], b["tk"], as_bytes(b["text"]), b["parts"], strict=True):
                yield pd.DataFrame([(own, tk, p["h"], p["lo"], p["hi"], p["at"], p["n"], text[p["lo"] : p["hi"] - 1 + REPEAT]) for p in parts],
                                   columns=["own", "tk", "h", "lo", "hi", "at", "n", "data"])

    of = pieces.groupBy(*KEY).agg(F.collect_list(F.struct("h", "lo", "hi", "at", "n")).alias("parts"))
    one = texts.dropDuplicates(KEY)
    return one.join(of, KEY).select(*KEY, "text", "parts").mapInPandas(
        _joined(run, 2000), "own long, tk long, h long, lo int, hi int, at int, n long, data binary")


def _columnwise(pieces: DataFrame, buckets: int) -> DataFrame:
    """Repeated runs (own, tk, a, b) in bytes of differing segments, a bucket of grams at a time."""

    def run(p: pd.DataFrame) -> pd.DataFrame:
        lo, at = p["lo"].to_numpy(np.int64), p["at"].to_numpy(np.int64)
        group = pd.factorize(p["h"])[0].astype(np.int64)
        who, window = repeated_windows(group, lo - at, p["hi"].to_numpy(np.int64) - lo, p["n"].to_numpy(np.int64), [bytes(x) for x in p["data"]])
        o, first, last = runs(who, window)
        return pd.DataFrame({"own": p["own"].to_numpy()[o], "tk": p["tk"].to_numpy()[o],
                             "a": (lo[o] + first).astype(np.int32), "b": (lo[o] + last + REPEAT).astype(np.int32)})

    return pieces.groupBy(F.pmod(F.xxhash64("h"), F.lit(buckets)).alias("bucket")).applyInPandas(run, "own long, tk long, a int, b int")


def _counted(pieces: DataFrame) -> DataFrame:
    """Repeated runs of the segments of hot grams: windows counted by digest, map-side first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for own, tk, h, lo, n, data in zip(b["own"], b["tk"], b["h"], b["lo"], b["n"], b["data"], strict=True):
                w = len(data) - REPEAT + 1
                yield pd.DataFrame({"own": own, "tk": tk, "s": np.arange(lo, lo + w, dtype=np.int32), "n": n, "h": h,
                                    "w": [hashlib.blake2b(data[i : i + REPEAT], digest_size=16).digest() for i in range(w)]})

    windows = written(pieces.sparkSession, pieces.mapInPandas(_joined(run), "own long, tk long, s int, n long, h long, w binary"), "repeat-windows")
    twice = windows.groupBy("w").agg(F.sum("n").alias("c")).where("c > 1").select("w")
    return windows.where("n = 1").join(twice, "w", "left_semi").select("own", "tk", F.col("s").alias("a"), (F.col("s") + REPEAT).alias("b"))


def remove(docs: DataFrame, hot_segments: int = HOT_SEGMENTS) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    # Where the id is null, two hashes with different seeds name the text.
    texts = docs.select(F.coalesce("doc_id", F.xxhash64(F.lit(1), text)).alias("own"), F.xxhash64("doc_id", text).alias("tk"),
                        F.col("doc_id").isNull().alias("unnamed"), text.alias("text"))
    doc_id = F.when(~F.col("unnamed"), F.col("own")).alias("doc_id")
    segments = written(spark, _segments(texts), "repeat-segments")
    # Written, so that the join below has an exchange of its own and a hot gram's partition can be split.
    often = written(spark, segments.groupBy("h").agg(F.count("*").alias("c")).where("c > 1").select("h"), "repeat-often")
    shared = written(spark, segments.join(often, "h", "left_semi"), "repeat-shared")
    groups = written(spark, shared.groupBy("h", "d").agg(F.count("*").alias("n"), F.min(F.struct(*KEY, "lo", "hi", "at")).alias("one")), "repeat-groups")
    differing = written(spark, groups.groupBy("h").agg(F.count("*").alias("kinds"), F.min("n").alias("least")).where("kinds > 1 AND least = 1")
                        .select("h", "kinds"), "repeat-differing")
    pieces = written(spark, groups.join(differing, "h").select("h", "n", "kinds", "one.*"), "repeat-pieces")
    whole = written(spark, shared.join(groups.where("n > 1").select("h", "d"), ["h", "d"], "left_semi").select(
        *KEY, F.col("lo").alias("a"), (F.col("hi") - 1 + REPEAT).alias("b")), "repeat-whole")
    ids = whole.select(*KEY).union(pieces.select(*KEY)).distinct()
    touched = written(spark, texts.join(ids, KEY, "left_semi"), "repeat-texts")

    parts = written(spark, _cut(touched, pieces.where(F.col("kinds") <= hot_segments)), "repeat-parts")
    n = pieces.where(F.col("kinds") <= hot_segments).count()
    found = [whole, _columnwise(parts, max(shuffle_width(spark), math.ceil(n / BUCKET_SEGMENTS)))]
    hot = pieces.where(F.col("kinds") > hot_segments)
    if not hot.isEmpty():
        found.append(_counted(_cut(touched, hot)))
    spans = found[0]
    for f in found[1:]:
        spans = spans.union(f)
    per_doc = spans.groupBy(*KEY).agg(F.collect_list(F.struct("a", "b")).alias("spans"))

    def cut_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for own, unnamed, data, found in zip(b["own"], b["unnamed"], as_bytes(b["text"]), b["spans"], strict=True):
                merged: list[list[int]] = []
                for x, y in sorted((s["a"], s["b"]) for s in (found if found is not None else ())):
                    if merged and x <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], y)
                    else:
                        merged.append([x, y])
                sha, at = hashlib.sha256(), 0
                for x, y in merged:
                    sha.update(data[at:x])
                    at = y
                sha.update(data[at:])
                out.append((own, unnamed, len(data), sum(y - x for x, y in merged), len(merged), sha.hexdigest()))
            yield pd.DataFrame(out, columns=["own", "unnamed", *result])

    result = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    schema = "own long, unnamed boolean, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    changed = touched.join(per_doc, KEY, "left").select("own", "unnamed", "text", "spans").mapInPandas(cut_out, schema).select(doc_id, *result)
    untouched = texts.select(*KEY, doc_id, F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("kept_sha256")).join(
        touched.select(*KEY).distinct(), KEY, "left_anti")
    zero = F.lit(0).cast("long")
    return changed.unionByName(untouched.select("doc_id", "n_bytes", zero.alias("n_removed"), zero.alias("n_spans"), "kept_sha256"))

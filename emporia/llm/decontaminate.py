"""Benchmark decontamination with built-in functions only.

Words are maximal runs outside ``\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F`` after
lower-casing A-Z.  A window is ten consecutive words of a benchmark item; an
item of fewer (but some) words is one window.  Every window of every document
is hashed and looked up in the set of window hashes; what the set lets through
is verified by joining on the window's words themselves.  A document word
inside any verified occurrence is hit.

The set travels with the tasks as long as the benchmark has at most
``SET_WINDOWS`` distinct windows (its size is counted first; 64 bytes a window).
Beyond that, ``scan`` explodes the window hashes and joins them with the
windows, which shuffles where they are large; both ways give the same rows.

Null or empty texts have no words: such documents are kept with ``n_words`` 0
and such items have no windows.  What is found depends on the text alone, so
rows are told apart by id and text: a null or repeated ``doc_id`` mixes no
texts, and every row, repeated ones too, has one result row.  Extra columns are
not read; empty tables give an empty result or no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import LOWER, UPPER, WORD_SPLIT, written

N = 10
#: Bound of the broadcast hash set: distinct benchmark windows.
SET_WINDOWS = 100_000


def words(text: str = "text") -> Column:
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), WORD_SPLIT), lambda w: w != "")


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """(key, n, window, items): each distinct window with the items that hold it."""
    w = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words().alias("w")).where(F.size("w") > 0)
    at = F.sequence(F.lit(1), F.greatest(F.size("w") - (N - 1), F.lit(1)))
    cut = w.select("item_id", F.explode(F.transform(at, lambda i: F.slice("w", i, N))).alias("g"))
    return cut.groupBy(F.xxhash64("g").alias("key"), F.size("g").alias("n"), F.array_join("g", " ").alias("window")).agg(
        F.collect_set("item_id").alias("items"))


def _places(n: int) -> Column:
    """First words (from 1) of the windows of ``n`` words."""
    return F.when(F.size("w") >= n, F.sequence(F.lit(1), F.size("w") - (n - 1))).otherwise(F.array().cast("array<int>"))


def _window(at: Column, n: int | Column) -> Column:
    return F.slice("w", at, F.lit(n) if isinstance(n, int) else n)


def _set_hits(n: int, keys: list[int]) -> Column:
    """Places, lengths and words of the windows of ``n`` words whose hash is in the set."""
    hit = F.filter(_places(n), lambda i: F.xxhash64(_window(i, n)).isin(keys))
    return F.transform(hit, lambda i: F.struct(i.alias("at"), F.lit(n).alias("n"), F.array_join(_window(i, n), " ").alias("window")))


def _hashed(n: int) -> Column:
    return F.transform(_places(n), lambda i: F.struct(i.alias("at"), F.lit(n).alias("n"), F.xxhash64(_window(i, n)).alias("key")))


def _key() -> Column:
    return F.sha2(F.coalesce("text", F.lit("")), 256)


def scan(docs: DataFrame, benchmark: DataFrame, set_windows: int = SET_WINDOWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, items (sorted ids of items with occurring windows)."""
    return _scan(docs.select("doc_id", "text"), benchmark, set_windows).drop("tk")


def _scan(docs: DataFrame, benchmark: DataFrame, set_windows: int = SET_WINDOWS) -> DataFrame:
    spark = docs.sparkSession
    windows = written(spark, benchmark_windows(benchmark), "windows")
    lengths = [r[0] for r in windows.select("n").distinct().collect()]  # at most ten numbers
    base = docs.select("doc_id", _key().alias("tk"), words().alias("w"))
    if not lengths:
        return base.select("doc_id", "tk", F.size("w").cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"),
                           F.array().cast("array<string>").alias("items"))
    known = windows.select("window", "items")
    count = windows.count()
    if count <= set_windows:
        keys = [r[0] for r in windows.select("key").distinct().collect()]
        places = base.select("doc_id", "tk", F.size("w").alias("n_words"), F.concat(*[_set_hits(n, keys) for n in lengths]).alias("c"))
        hits = _candidates(places).join(F.broadcast(known), "window", "left")
    else:
        hits = _scan_by_join(base, windows, lengths)
    # Rows that agree in id, text and partition share a group that counts them; one partition bounds their number.
    per_row = hits.groupBy("doc_id", "tk", "part").agg(
        F.max("n_words").alias("n_words"),
        F.count(F.when(F.coalesce("pos", F.lit(0)) == 0, 1)).cast("int").alias("rows"),
        F.collect_set(F.when(F.col("items").isNotNull(), F.struct("at", "n"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["at"], s["at"] + s["n"] - 1)))))
    found = per_row.select("doc_id", "tk", F.col("n_words").cast("long").alias("n_words"), covered.cast("long").alias("n_hit"), "items", "rows")
    return found.withColumn("rows", F.explode(F.sequence(F.lit(1), "rows"))).drop("rows")


def _candidates(places: DataFrame) -> DataFrame:
    """One row per candidate window of ``places(doc_id, tk, n_words, c)``, numbered from 0 within its row; one (null) for a row without any."""
    rows = places.select("doc_id", "tk", F.spark_partition_id().alias("part"), "n_words", F.posexplode_outer("c").alias("pos", "c"))
    return rows.select("doc_id", "tk", "part", "n_words", "pos", "c.at", "c.n", "c.window")


def _scan_by_join(base: DataFrame, windows: DataFrame, lengths: list[int]) -> DataFrame:
    """Hits where the benchmark is too large to travel: window hashes join window hashes, then words are compared."""
    exploded = base.select("tk", F.explode(F.concat(*[_hashed(n) for n in lengths])).alias("c")).select("tk", "c.at", "c.n", "c.key")
    found = exploded.join(windows.select("key", "n").distinct(), ["key", "n"], "left_semi").groupBy("tk").agg(
        F.collect_set(F.struct("at", "n")).alias("c"))
    texts = base.join(found, "tk", "left")
    places = texts.select("doc_id", "tk", F.size("w").alias("n_words"), F.transform("c", lambda c: F.struct(
        c["at"].alias("at"), c["n"].alias("n"), F.array_join(_window(c["at"], c["n"]), " ").alias("window"))).alias("c"))
    return _candidates(places).join(windows.select("window", "items"), "window", "left")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark window; all columns stay."""
    bad = _scan(docs.select("doc_id", "text"), benchmark).where("n_hit > 0").select(F.col("tk").alias("_leaked_text")).distinct()
    return docs.join(bad, _key() == F.col("_leaked_text"), "left_anti")

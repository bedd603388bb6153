"""Prefix tree of conversations as a z-fast trie whose nodes are rows of a table (operator 13).

A conversation is a string of turns.  Every prefix has a 16-byte digest (a hash chain over the
turns), so "the first d turns are the same" is one comparison.  The trie is compacted: a node stands
for the turns between its parent's extent ``p`` and its own extent ``e``, and is filed in the node
table under its *handle*, the prefix whose length is the two-fattest number in ``(p, e]`` (the one
divisible by the largest power of two).

* ``insert`` locates the exit node of all conversations at once by fat binary search: each probe is
  an equi-join of the conversations with the node table on the handle digest, and about
  log2(turns) probes find the deepest node whose whole extent is a prefix.
* Conversations go in in batches.  A batch takes one conversation for each open (exit point, next
  turn), chosen by hash, and splits edges at all exit points; what is left is located again below
  the new nodes.  The choice halves a group of n on average, so about log2(n) batches do, whatever
  the shape of the tree; equal conversations are one string with a count from the start.
* ``summed`` adds up the subtrees by pointer jumping (log2 of the tree's height rounds), and
  ``expanded`` turns each edge back into one row per turn.

Every step is a join or an aggregation on digests with map-side partial results: a first turn that
a third of all conversations share is split by the next turns, and copies are counted before the
shuffle.  No group is gathered in a task but the turns of a single conversation (16 bytes and a
length each; the texts stay in the first scan).  All tables between batches are written to the
shared folder, so a lost executor repeats one batch's tasks.

Defined cases: a null role or text is empty; a null turn comes first; rows of one turn number are
ordered by the digest of their role and text; rows without conv_id belong to no conversation and
are left out; an empty table gives no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import discard, written

#: Digest of the empty prefix: the root's identity.
ROOT = hashlib.blake2b(b"root", digest_size=16).digest()
#: Conversation ids of one node are joined to text in blocks of ``2 ** ID_BITS`` consecutive numbers.
ID_BITS = 12
NODE = ("p int, e int, hp binary, he binary, f int, hf binary, g binary, edge array<binary>, cum array<long>, cp long")


# ---- conversations -> prefix digests -----------------------------------------
def turn_digests(conversations: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id``, ``turns`` (ordered array of digest and text bytes)."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    digest = F.unhex(F.substring(F.sha2(named, 256), 1, 32))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn"), digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes")).alias("t"))
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """Conversation c starts with the first h turns of conversation c - c%5, h = crc32(c) % 9, then goes on with its own."""
    h = (F.crc32(F.col("c.conv_id").cast("string").cast("binary")) % 9).cast("int")
    none = F.array().cast(turns.schema["turns"].dataType)
    own = F.col("c.turns")
    # Eight turns at most are copied, so the head of every conversation is all that the join carries.
    heads = turns.where(F.col("conv_id") % 5 == 0).select("conv_id", F.slice("turns", 1, 8).alias("head"))
    got = turns.alias("c").join(heads.alias("b"), F.col("c.conv_id") - F.col("c.conv_id") % 5 == F.col("b.conv_id"), "left")
    both = F.concat(F.slice(F.coalesce(F.col("b.head"), none), F.lit(1), h), F.slice(own, h + 1, F.greatest(F.size(own), F.lit(1))))
    return got.select(F.col("c.conv_id").alias("conv_id"), both.alias("turns"))


def _chain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        keys, prefixes, sums = [], [], []
        for digests, sizes in zip(pdf["digests"], pdf["sizes"]):
            h, total, hs, cs = ROOT, 0, [], []
            for d, s in zip(digests, sizes):
                h = hashlib.blake2b(h + d, digest_size=16).digest()
                total += int(s)
                hs.append(h)
                cs.append(total)
            keys.append(h)
            prefixes.append(hs)
            sums.append(cs)
        yield pd.DataFrame({"conv_id": pdf["conv_id"], "key": keys, "m": [len(x) for x in prefixes], "h": prefixes, "c": sums})


def prefix_digests(turns: DataFrame) -> DataFrame:
    """conv_id, key (digest of the whole), m (turns), h (digest of every prefix), c (text bytes up to there)."""
    flat = turns.select("conv_id", F.col("turns.digest").alias("digests"), F.col("turns.bytes").alias("sizes"))
    return flat.mapInPandas(_chain, "conv_id long, key binary, m int, h array<binary>, c array<long>")


# ---- the trie -----------------------------------------------------------------
def two_fattest(a: Column, b: Column) -> Column:
    """The number in (a, b] that the largest power of two divides: b without the bits below the first that differs."""
    k = F.length(F.bin(a.bitwiseXOR(b).cast("long"))) - 1
    return F.call_function("shiftleft", F.call_function("shiftright", b, k), k)


def _nodes(edges: DataFrame) -> DataFrame:
    """Edges (p, hp, edge, cum, cp) with what follows from them: extent, handle, first digest."""
    e = (F.col("p") + F.size("edge")).cast("int")
    f = two_fattest(F.col("p"), F.col("e"))
    return edges.withColumn("e", e).withColumn("f", f).select(
        "p", "e", "hp", F.element_at("edge", -1).alias("he"), "f", F.get("edge", F.col("f") - F.col("p") - 1).alias("hf"),
        F.get("edge", F.lit(0)).alias("g"), "edge", "cum", "cp")


def locate(keys: DataFrame, nodes: DataFrame, longest: int) -> DataFrame:
    """Exit point of every key: adds ``x`` (turns shared with the trie) and the edge it lies on (``on``, ``on_e``; null at a node)."""
    q = keys.withColumn("b", F.col("m"))
    handles = nodes.select("hf", F.col("p").alias("np"), F.col("e").alias("ne"), F.col("he").alias("nh"))
    cols = [*keys.columns, "b"]
    for _ in range(max(longest, 1).bit_length() + 1):
        live = F.col("a") < F.col("b")
        # A settled row probes with 17 bytes of its own, which are no handle: as nulls, such rows would meet in one partition.
        q = q.withColumn("f", F.when(live, two_fattest(F.col("a"), F.col("b")))).withColumn(
            "probe", F.coalesce(F.get("h", F.col("f") - 1), F.concat("key", F.lit(b"-"))))
        got = q.join(handles, F.col("probe") == F.col("hf"), "left")
        found = F.col("hf").isNotNull()
        whole = found & F.coalesce(F.get("h", F.col("ne") - 1) == F.col("nh"), F.lit(False))
        a = F.when(whole, F.col("ne")).when(found, F.col("np")).otherwise(F.col("a"))
        b = F.when(whole | F.col("f").isNull(), F.col("b")).when(found, F.col("np")).otherwise(F.col("f") - 1)
        q = got.withColumns({"a": a, "b": b}).select(*cols)
    first = nodes.select(F.col("g").alias("ng"), F.col("he").alias("on"), F.col("e").alias("on_e"), F.col("edge").alias("on_edge"))
    q = q.withColumn("next", F.coalesce(F.get("h", F.col("a")), F.concat("key", F.lit(b"-"))))
    got = q.join(first, F.col("next") == F.col("ng"), "left")
    # Digests are of whole prefixes: those that the edge and the key share are the turns they share.
    shared = F.when(F.col("on").isNull(), 0).otherwise(F.size(F.array_intersect("on_edge", "h")))
    return got.select(*keys.columns, (F.col("a") + shared).cast("int").alias("x"), "on", "on_e")


def insert(nodes: DataFrame | None, keys: DataFrame, longest: int) -> DataFrame:
    """The trie's node table after the distinct ``keys`` (key, m > 0, h, c) went in, in batches."""
    spark = keys.sparkSession
    nodes = nodes if nodes is not None else spark.createDataFrame([], NODE)
    rest = keys.select("key", "m", "h", "c", F.lit(0).alias("a"))
    old: list[DataFrame] = []
    while True:
        at = written(spark, locate(rest, nodes, longest), "trie-exits")
        if at.isEmpty():
            discard(at)
            break
        following = F.get("h", F.col("x"))
        open_ = at.where(F.col("x") < F.col("m"))
        picked = open_.groupBy(following.alias("next")).agg(
            F.min(F.struct(F.xxhash64("key").alias("order"), "key", "m", "x", "h", "c")).alias("r")).select("r.*")
        picked = written(spark, picked, "trie-batch")
        cuts = at.where(F.col("on").isNotNull() & (F.col("x") < F.col("on_e"))).select("on", "x").distinct().groupBy("on").agg(
            F.sort_array(F.collect_list("x")).alias("cuts"))
        leaves = picked.select(
            F.col("x").alias("p"), F.when(F.col("x") == 0, F.lit(ROOT)).otherwise(F.get("h", F.col("x") - 1)).alias("hp"),
            F.slice("h", F.col("x") + 1, F.col("m") - F.col("x")).alias("edge"), F.slice("c", F.col("x") + 1, F.col("m") - F.col("x")).alias("cum"),
            F.when(F.col("x") == 0, F.lit(0).cast("long")).otherwise(F.get("c", F.col("x") - 1)).alias("cp"))
        was = nodes.join(cuts, F.col("he") == F.col("on"), "left")
        kept, cut = was.where(F.col("on").isNull()).select(*nodes.columns), was.where(F.col("on").isNotNull())
        piece = cut.select("p", "hp", "edge", "cum", "cp", F.explode(F.arrays_zip(
            F.concat(F.array("p"), "cuts").alias("lo"), F.concat("cuts", F.array("e")).alias("hi"))).alias("s"))
        lo, n = F.col("s.lo") - F.col("p"), F.col("s.hi") - F.col("s.lo")
        piece = piece.select(
            F.col("s.lo").alias("p"), F.when(lo == 0, F.col("hp")).otherwise(F.get("edge", lo - 1)).alias("hp"),
            F.slice("edge", lo + 1, n).alias("edge"), F.slice("cum", lo + 1, n).alias("cum"),
            F.when(lo == 0, F.col("cp")).otherwise(F.get("cum", lo - 1)).alias("cp"))
        bigger = written(spark, kept.unionByName(_nodes(piece.unionByName(leaves))), "trie-nodes")
        # What is left exits at or below the node that now stands at its exit point.
        rest = open_.join(picked.select("key"), "key", "left_anti").select("key", "m", "h", "c", F.col("x").alias("a"))
        for x in old:
            discard(x)
        old, nodes = [at, picked, nodes], bigger
    for x in old:
        discard(x)
    return nodes


# ---- members, subtrees, expansion ----------------------------------------------
def _hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Running digest over the blocks of a key, which come in order; only the open digest is kept."""
    key, running = None, None
    for pdf in batches:
        out = []
        for k, block in zip(pdf["key"], pdf["block"]):
            if k == key:
                running.update(b"," + block.encode())
                continue
            if key is not None:
                out.append((key, running.hexdigest()))
            key, running = k, hashlib.sha256(block.encode())
        yield pd.DataFrame(out, columns=["key", "ends"])
    if key is not None:
        yield pd.DataFrame([(key, running.hexdigest())], columns=["key", "ends"])


def ends(members: DataFrame) -> DataFrame:
    """key, ends: SHA-256 of the key's conversation ids, ascending, comma-joined (blocks of ids first, then a stream of blocks)."""
    blocks = members.groupBy("key", F.shiftright(F.col("conv_id"), ID_BITS).alias("at")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("block"))
    dealt = blocks.repartition("key").sortWithinPartitions("key", "at").select("key", "block")
    return dealt.mapInPandas(_hashed, "key binary, ends string")


_ADDED = ("n", "nb", "b", "leaf")


def summed(own: DataFrame) -> DataFrame:
    """Subtree sums of n, nb, b, leaf and the minimum of conv for a table (id, up, those) by pointer jumping.

    After round k a row holds its descendants nearer than 2^k and points 2^k nodes up.
    """
    spark = own.sparkSession
    t = written(spark, own, "trie-sums")
    while not (live := t.where(F.col("up").isNotNull())).isEmpty():
        got = live.groupBy(F.col("up").alias("to")).agg(*[F.sum(c).alias(f"s_{c}") for c in _ADDED], F.min("conv").alias("s_conv"))
        up = t.select(F.col("id").alias("at"), F.col("up").alias("above"))
        # Rows without a node further up pass by the join, so that their nulls don't meet in one partition.
        moved = live.join(up, F.col("up") == F.col("at")).drop("at", "up").withColumnRenamed("above", "up")
        t2 = moved.unionByName(t.where(F.col("up").isNull())).join(got, F.col("id") == F.col("to"), "left")
        t2 = t2.select("id", "up", *[(F.col(c) + F.coalesce(f"s_{c}", F.lit(0))).cast("long").alias(c) for c in _ADDED],
                       F.least("conv", "s_conv").alias("conv"))
        t2 = written(spark, t2, "trie-sums")
        discard(t)
        t = t2
    return t


def expanded(nodes: DataFrame, members: DataFrame, keys: DataFrame) -> DataFrame:
    """One row per turn of every edge, and the root, with the counts of its subtree."""
    root = nodes.sparkSession.range(1).select(
        F.lit(-1).alias("p"), F.lit(0).alias("e"), F.lit(None).cast("binary").alias("hp"), F.lit(ROOT).alias("he"),
        F.array(F.lit(0).cast("long")).alias("cum"), F.lit(0).cast("long").alias("cp"))
    every = nodes.select(*root.columns).unionByName(root)
    below = nodes.groupBy("hp").agg(F.count(F.lit(1)).alias("children")).withColumnRenamed("hp", "bp")
    here = keys.select("key", F.col("copies").alias("n"), "conv")
    total = F.element_at("cum", -1)
    zero = F.lit(0).cast("long")
    shaped = written(nodes.sparkSession, every.join(below, F.col("he") == F.col("bp"), "left").join(here, F.col("he") == F.col("key"), "left").select(
        *root.columns, F.coalesce("children", zero).alias("children"), F.coalesce("n", zero).alias("n"), "conv"), "trie-shape")
    sums = summed(shaped.select(
        F.col("he").alias("id"), F.col("hp").alias("up"), "n", (F.col("n") * total).alias("nb"), (total - F.col("cp")).alias("b"),
        F.when(F.col("children") == 0, F.lit(1)).otherwise(0).cast("long").alias("leaf"), "conv"))
    above = sums.select(F.col("id").alias("ap"), F.col("conv").alias("parent_conv"))
    got = (shaped.drop("n", "conv").join(sums.drop("up"), F.col("he") == F.col("id"))
           .join(above, F.col("hp") == F.col("ap"), "left").join(ends(members), F.col("he") == F.col("key"), "left"))
    # Saved in the subtree: the sum of n * bytes is known from the leaves' totals, less one copy of each edge.
    saved = F.col("nb") - F.col("n") * F.col("cp") - F.col("b")
    got = got.withColumn("saved", saved).select("*", F.posexplode("cum").alias("i", "sum_to"))
    depth, last = F.col("p") + F.col("i") + 1, F.col("i") == F.size("cum") - 1
    before = F.when(F.col("i") == 0, F.col("cp")).otherwise(F.get("cum", F.col("i") - 1))
    return got.select(
        F.col("conv").alias("conv_id"), depth.cast("long").alias("depth"),
        F.when(F.col("i") == 0, F.col("parent_conv")).otherwise(F.col("conv")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.when(last, F.col("children")).otherwise(1).cast("long").alias("n_children"),
        F.col("leaf").alias("n_leaves"), (F.col("saved") - (F.col("n") - 1) * (before - F.col("cp"))).alias("saved_tokens"),
        F.when(last & F.col("ends").isNotNull(), F.col("ends")).otherwise(F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


def trie(turns: DataFrame) -> DataFrame:
    """Rows of every node of the prefix tree of conversations given as (conv_id, turns)."""
    spark = turns.sparkSession
    prefixes = written(spark, prefix_digests(turns), "trie-prefixes")
    keys = written(spark, prefixes.groupBy("key").agg(
        F.count(F.lit(1)).alias("copies"), F.min("conv_id").alias("conv"), F.first("m").alias("m"),
        F.first("h").alias("h"), F.first("c").alias("c")), "trie-keys")
    longest = keys.agg(F.max("m")).first()[0]
    if longest is None:
        return expanded(spark.createDataFrame([], NODE), prefixes, keys).where(F.lit(False))
    nodes = insert(None, keys.where(F.col("m") > 0), longest)
    return expanded(nodes, prefixes.select("key", "conv_id"), keys)

"""Prefix trie of conversations: distinct openings as nodes, subtree totals rolled up by depth bands."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkpanel.llm.arrow import batched
from sparkpanel.llm.staging import staged
from sparkpanel.operators.segments import MOST, numbered, scan

#: Height of a band: a node explodes to so many ancestors at most.
BAND = 16
#: Ids of 2^16 consecutive values form a chunk of what a node's hash reads.
CHUNK_BITS = 16
_SUMS = ("_s1", "_s2", "_s3", "_s4")


def ordered_turns(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, most: int = MOST) -> DataFrame:
    """(conv, p, digest, chars): each conversation's turns numbered from 1, texts as digests.

    Order: turn (null first); turns that tie by role, then the text's first 64 code points,
    then the digest. Null roles and texts are empty; rows without a conversation are left out.
    """
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    # The role's length tells where it ends.
    digest = F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256))
    narrow = df.select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"),
        F.substring(text, 1, 64).alias("head"), digest.alias("digest"), F.char_length(text).cast("long").alias("chars"),
    ).filter("conv is not null")
    return staged(numbered(narrow, ["conv"], "turn", "p", ("role", "head", "digest"), most).select("conv", "p", "digest", "chars"), "turns")


def sizes_of(turns: DataFrame) -> DataFrame:
    """(conv, total): turns of each conversation."""
    return turns.groupBy("conv").agg(F.count(F.lit(1)).alias("total"))


def with_shared_openings(turns: DataFrame, block: int, taken: Column, most_taken: int) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are replaced by those of their block's first one.

    Conversation c gets the first ``taken`` (a column of conv, at most ``most_taken``) turns
    of conversation c - c % block (fewer if it has fewer, none if it's absent), then its own
    after its first ``taken``. The remainder has the sign of c, as in SQL. Returns the turns
    and (conv, total) with a row for each conversation, turnless ones included. A block's
    first conversation meets at most ``block`` others (twice that around zero).
    """
    sizes = staged(sizes_of(turns).withColumns({"base": F.col("conv") - F.col("conv") % block, "h": taken.cast("long")}), "sizes")
    bases = sizes.select(F.col("conv").alias("base"), F.col("total").alias("there"))
    opened = sizes.join(bases, "base", "left").withColumn("open", F.least("h", F.coalesce("there", F.lit(0).cast("long"))))
    convs = staged(opened.select("conv", "base", "h", "open", (F.col("open") + F.greatest(F.col("total") - F.col("h"), F.lit(0))).alias("total")), "convs")
    own = turns.join(convs.select("conv", "h", "open"), "conv").filter("p > h").select("conv", (F.col("p") - F.col("h") + F.col("open")).alias("p"), "digest", "chars")
    first = turns.filter((F.col("p") <= most_taken) & (F.col("conv") % block == 0)).withColumnRenamed("conv", "base")
    shared = first.join(convs.select("base", "conv", "h"), "base").filter("p <= h").select("conv", "p", "digest", "chars")
    return own.unionByName(shared), convs.select("conv", "total")


def _key(depth: Column, sums: list[Column]) -> Column:
    return F.unhex(F.md5(F.concat_ws(",", depth.cast("string"), *[s.cast("string") for s in sums])))


def _root() -> Column:
    return _key(F.lit(0), [F.lit(0)] * len(_SUMS))


def _prefixes(turns: DataFrame, convs: DataFrame, most: int) -> DataFrame:
    """(conv, depth, key, chars, last): a row for each conversation and prefix with turns.

    A turn's digest is hashed with its place to four numbers of 32 bits, and a prefix is
    told by its depth and the four sums: sums are associative, so that a conversation of
    any length is scanned in segments.
    """
    numbers = {s: F.shiftrightunsigned(F.xxhash64("p", "digest", F.lit(i)), 32) for i, s in enumerate(_SUMS)}
    summed = scan(turns.withColumns(numbers), ["conv"], "p", {f"{s}_": ("sum", F.col(s)) for s in _SUMS}, most=most)
    rows = summed.select("conv", F.col("p").alias("depth"), _key(F.col("p"), [F.col(f"{s}_") for s in _SUMS]).alias("key"), "chars")
    return rows.join(convs, "conv").select("conv", "depth", "key", "chars", (F.col("depth") == F.col("total")).cast("long").alias("last"))


def _with_ancestors(nodes: DataFrame, prefixes: DataFrame, step: int, band: int) -> DataFrame:
    """Adds ``up``: the keys above a node, from the root of the band below whose top or inside which it lies.

    ``nodes`` have u, their depth in steps. The path of the smallest member gives the keys.
    """
    u = (F.col("depth") / step).cast("long")
    at = prefixes.filter(F.col("depth") % step == 0).select("conv", u.alias("u"), "key")
    inside = at.withColumn("band", F.expr(f"(u - 1) div {band}"))
    opening = at.filter(F.col("u") % band == 0).withColumn("band", F.expr(f"u div {band}"))
    # At most a band's height and one key to a group.
    paths = inside.unionByName(opening).groupBy("conv", "band").agg(F.sort_array(F.collect_list(F.struct("u", "key"))).alias("path"))
    keys = F.transform("path", lambda x: x["key"])
    paths = paths.select("conv", "band", F.when(F.col("band") == 0, F.concat(F.array(_root()), keys)).otherwise(keys).alias("keys"))
    below = nodes.filter("u > 0").withColumn("band", F.expr(f"(u - 1) div {band}")).join(paths, ["conv", "band"])
    up = F.slice("keys", F.lit(1), (F.col("u") - F.col("band") * band).cast("int"))
    top = nodes.filter("u = 0").withColumn("up", F.array().cast("array<binary>"))
    return below.withColumn("up", up).drop("keys", "band").unionByName(top)


def _rolled_up(known: DataFrame, prefixes: DataFrame, deepest: int, step: int, band: int) -> DataFrame:
    """(key, leaves, saved, children): totals over each node's subtree, and a node's children.

    ``known`` are nodes with their ancestors in the band (u, up).

    Nodes inside a band add what they have to the ancestors up to the band's root. Roots
    of bands then form a trie of their own, ``band`` times flatter, which is rolled up in
    the same way, and their completed totals are added to the band above. The rounds grow
    with the logarithm of the depth, and a node is exploded ``band`` times at most.
    """
    inner = F.col("u") % band != 0
    none = F.lit(0).cast("long")
    own = known.select("key", "leaves", "saved", none.alias("children"))
    lifted = known.filter(inner).select(F.posexplode(F.reverse("up")).alias("i", "key"), "leaves", "saved").select(
        "key", "leaves", "saved", (F.col("i") == 0).cast("long").alias("children")
    )
    above = known.filter(~inner & (F.col("u") > 0)).select(F.element_at("up", -1).alias("key"), none.alias("leaves"), none.alias("saved"), F.lit(1).cast("long").alias("children"))
    sums = [F.sum(c).alias(c) for c in ("leaves", "saved", "children")]
    held = own.unionByName(lifted).unionByName(above).groupBy("key").agg(*sums)
    if deepest < band:
        return held
    held = staged(held, "held")
    roots = known.filter(~inner).select("key", "conv", "depth", (F.col("u") / band).cast("long").alias("u"), "up")
    flat = roots.drop("up").join(held.drop("children"), "key")
    flat = staged(_with_ancestors(flat, prefixes, step * band, band), "flat")
    whole = staged(_rolled_up(flat, prefixes, deepest // band, step * band, band).drop("children"), "whole")
    met = roots.filter("u > 0").join(whole, "key")
    # The uppermost key is the root of the band above, which is complete already.
    added = met.select(F.explode(F.slice("up", 2, band)).alias("key"), "leaves", "saved", none.alias("children"))
    rest = held.join(roots.select("key"), "key", "left_anti").unionByName(added).groupBy("key").agg(*sums)
    return rest.unionByName(whole.join(held.select("key", "children"), "key"))


def _hash_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by key and chunk: a key's chunks pass through one running hash."""
    schema = pa.schema([("key", pa.binary()), ("hash", pa.string())])

    def rows():
        key, state = None, hashlib.sha256()
        for batch in batches:
            for k, text in zip(batch["key"].to_pylist(), batch["text"].to_pylist(), strict=True):
                if k != key:
                    if key is not None:
                        yield key, state.hexdigest()
                    key, state = k, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
        if key is not None:
            yield key, state.hexdigest()

    return batched(rows(), schema)


def _ends(rows: DataFrame) -> DataFrame:
    """(key, ends): SHA-256 of the ascending conversations of each key.

    A chunk holds the ids of one range of 2^16 values, so it is bounded whatever the group.
    The few keys with several chunks are hashed as a stream, chunk by chunk.
    """
    chunk = F.shiftright("conv", CHUNK_BITS)
    ids = F.array_sort(F.collect_list("conv"))
    chunks = staged(rows.groupBy("key", chunk.alias("chunk")).agg(F.array_join(ids.cast("array<string>"), ",").alias("text")), "ends")
    counts = chunks.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min(F.when(F.length("text") < 256, F.col("text"))).alias("short"))
    several = staged(counts.filter("m > 1 or short is null").select("key"), "several")
    long = chunks.join(several, "key").select("key", "chunk", "text").repartition("key").sortWithinPartitions("key", "chunk")
    hashed = long.select("key", "text").mapInArrow(_hash_chunks, "key binary, hash string")
    return counts.filter("m = 1 and short is not null").select("key", F.sha2("short", 256).alias("ends")).unionByName(hashed.withColumnRenamed("hash", "ends"))


def prefix_trie(turns: DataFrame, convs: DataFrame, band: int = BAND, most: int = MOST) -> DataFrame:
    """Nodes of the trie of ``turns`` (conv, p, digest, chars), as ``ordered_turns`` makes them.

    ``convs`` (conv, total) has a row for each conversation, also for those without turns.
    Each distinct sequence of first d turns is a node; the root has no turn. A row has key
    and parent_key (binary, null at the root), depth, conv_id (the smallest member),
    parent_conv_id, n_convs (members), n_children, n_leaves (childless nodes of the
    subtree), saved (over the subtree, code points of a node's last text times its members
    but one), ends_sha256 (of the ascending ids, comma-joined, that end at the node).

    Copies of a conversation, and a first turn that all share, are summed in each task; no
    task holds a node's members. Equal prefixes are told by 128 bits. Without
    conversations there is no node, not even a root.
    """
    prefixes = staged(_prefixes(turns, convs, most), "prefixes")
    empty = convs.filter("total = 0")
    counted = [F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs")]
    below = prefixes.groupBy("key").agg(*counted, F.max("depth").alias("depth"), F.max("chars").alias("chars"), F.sum("last").alias("ending"))
    top = convs.groupBy(_root().alias("key")).agg(
        *counted, F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("chars"), F.sum((F.col("total") == 0).cast("long")).alias("ending")
    )
    # A node is childless where all its members end.
    nodes = staged(below.unionByName(top).withColumns({
        "u": F.col("depth"), "leaves": (F.col("ending") == F.col("n_convs")).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("chars"),
    }), "trie")
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    known = staged(_with_ancestors(nodes.select("key", "conv", "depth", "u", "leaves", "saved"), prefixes, 1, band), "known")
    totals = _rolled_up(known, prefixes, deepest, 1, band)
    ends = _ends(prefixes.filter("last = 1").select("key", "conv").unionByName(empty.select(_root().alias("key"), "conv")))
    whole = nodes.select("key", "conv", "depth", "n_convs").join(totals, "key").join(ends, "key", "left").join(
        known.select("key", F.try_element_at("up", F.lit(-1)).alias("parent_key")), "key"
    )
    above = nodes.select(F.col("key").alias("parent_key"), F.col("conv").alias("parent_conv_id"))
    return whole.join(above, "parent_key", "left").select(
        "key", "parent_key", F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), "saved", F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )

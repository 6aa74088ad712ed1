"""The prefix trie against a plain version."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sparkpanel.llm.trie import ordered_turns, prefix_trie, with_shared_openings

SCHEMA = "conv_id long, turn long, role string, text string, key string, depth int, conv string, p int"


def plain(sequences):
    """Rows of the trie of {conv: [(role, text), ...]}."""
    members = defaultdict(list)
    for c, s in sequences.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    rows = {}
    for node in sorted(members, key=len, reverse=True):
        m = sorted(members[node])
        ends = sorted(c for c in m if len(sequences[c]) == len(node))
        children = [x for x in members if len(x) == len(node) + 1 and x[: len(node)] == node] if len(m) > len(ends) else []
        saved = (len(m) - 1) * (len(node[-1][1]) if node else 0) + sum(rows[x][6] for x in children)
        leaves = sum(rows[x][5] for x in children) if children else 1
        parent = min(members[node[:-1]]) if node else None
        rows[node] = (m[0], len(node), parent, len(m), len(children), leaves, saved, hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest())
    return sorted(rows.values(), key=str)


def in_order(rows):
    """{conv: [(role, text), ...]} of (conv, turn, role, text) rows."""
    out = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            out[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(v)] for c, v in out.items()}


def opened(own):
    out = {}
    for c, s in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + s[h:]
    return out


def result(df):
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends_sha256"]
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], SCHEMA).repartition(4)


@pytest.fixture(scope="module")
def talk():
    rng = random.Random(2)
    rows = []
    for c in [*range(0, 8), 100, 101, 105, 205, 206, 1234567890123]:
        for t in range(rng.choice([1, 2, 3, 6, 9])):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "bb", "Ж€", "long " * 30])))
    rows += [(300, 0, None, None), (300, None, "user", "first"), (300, None, "system", "first"), (301, 1, "user", ""), (301, 1, "user", "")]
    rows += [(None, 0, "user", "nobody's"), (7, 2, "a", "tie"), (7, 2, "a", "tie two")]
    return rows


def test_nodes_of_reopened_conversations(spark, talk):
    turns, convs = with_shared_openings(ordered_turns(frame(spark, talk), "conv_id", "turn", "role", "text"), 100, F.crc32(F.col("conv").cast("string")) % 6, 5)
    assert result(prefix_trie(turns, convs)) == plain(opened(in_order(talk)))


def test_bands_and_a_conversation_cut_in_segments(spark):
    rng = random.Random(4)
    deep = [("user", rng.choice("ab")) for _ in range(70)]
    rows = [(1, t, *x) for t, x in enumerate(deep)]
    for c in range(2, 14):
        keep = rng.choice([3, 4, 8, 9, 27, 33, 69, 70])
        own = deep[:keep] + [("user", rng.choice("xy")) for _ in range(rng.choice([0, 0, 5]))]
        rows += [(c, t, *x) for t, x in enumerate(own)]
    df = frame(spark, rows)
    turns = ordered_turns(df, "conv_id", "turn", "role", "text", most=30)
    convs = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("total"))
    want = plain(in_order(rows))
    assert result(prefix_trie(turns, convs, band=3, most=30)) == want


def test_long_groups_of_ends_and_empty(spark):
    rows = [(c << 14, 0, "user", "same") for c in range(60)] + [(5, 0, "user", "same")]
    turns = ordered_turns(frame(spark, rows), "conv_id", "turn", "role", "text")
    convs = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("total"))
    assert result(prefix_trie(turns, convs)) == plain(in_order(rows))
    none = ordered_turns(frame(spark, rows).limit(0), "conv_id", "turn", "role", "text")
    assert prefix_trie(none, none.groupBy("conv").agg(F.count(F.lit(1)).alias("total"))).count() == 0

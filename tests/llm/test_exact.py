import hashlib

import pytest

from sparkpanel.llm import bloom
from sparkpanel.llm.exact import exact_dedup


@pytest.mark.parametrize("keep", ["max", "min"])
def test_groups_of_equal_texts(documents, corpus, keep):
    got = {r.doc_id: r for r in exact_dedup(documents, "doc_id", "text", keep).collect()}
    groups = {}
    for i, t in corpus:
        groups.setdefault(t or "", []).append(i)
    assert len(got) == len(corpus)
    for i, t in corpus:
        ids = groups[t or ""]
        best = max(ids) if keep == "max" else min(ids)
        row = got[i]
        assert (row.keep_id, row.group_size, row.kept) == (best, len(ids), i == best)
        assert row.text_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
        assert row.text == t and row.n_words == 7


def test_null_ids_and_repeated_rows(spark):
    rows = [(None, "a"), (1, "a"), (1, "a"), (None, "b"), (None, "b"), (3, None), (4, "")]
    got = exact_dedup(spark.createDataFrame(rows, "id long, text string"), "id", "text")
    found = sorted([(str(r.id), r.text or "", str(r.keep_id), r.group_size, r.kept) for r in got.collect()])
    assert found == sorted([
        ("None", "a", "1", 3, False), ("1", "a", "1", 3, True), ("1", "a", "1", 3, True), ("None", "b", "None", 2, True),
        ("None", "b", "None", 2, True), ("3", "", "4", 2, False), ("4", "", "4", 2, True),
    ])


def test_empty_table(spark):
    assert exact_dedup(spark.createDataFrame([], "id long, text string"), "id", "text").count() == 0


def test_no_python_in_the_plan(documents):
    plan = exact_dedup(documents, "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_only_possibly_repeated_rows_pass_the_filter(spark):
    rows = [(i, f"text {i if i >= 50 else i % 10}") for i in range(4000)]
    df = spark.createDataFrame(rows, "id long, text string").selectExpr("id", "xxhash64(text) AS h")
    blocks = bloom.block_count(4000)
    tested = bloom.might_hold(df, "h", bloom.repeated_filter(df, "h", blocks), blocks, "maybe")
    passed = {r.id for r in tested.filter("maybe").collect()}
    assert set(range(50)) <= passed and len(passed) < 400
    held = bloom.filter_of(df.filter("id < 100"), "h", blocks)
    local = bloom.LocalFilter(held, blocks)
    import numpy as np
    both = bloom.might_hold(df, "h", held, blocks, "maybe").orderBy("id").collect()
    assert local.might_hold(np.array([r.h for r in both], np.int64)).tolist() == [r.maybe for r in both]


def test_filter_size_is_bounded():
    assert bloom.block_count(0) == 1 and bloom.block_count(10**12) == bloom.MAX_BLOCKS
    assert all(bloom.block_count(n) * bloom.BLOCK_BITS >= 16 * n for n in (1, 2048, 2049, 10**6))

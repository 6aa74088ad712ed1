import random

import numpy as np
import public_tokenizers
import pytest
from test_near import alike, word_sets
from test_repeats import spans_left
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from sparkpanel.llm.suffixes import _inward


@pytest.fixture(scope="module")
def table(spark, corpus, tmp_path_factory):
    """A documents table with a label that the first stage can learn, and two further columns."""
    folder = tmp_path_factory.mktemp("sf")
    rows = [(i, t, "en", f"s{i % 3}", len(t or ""), True, "k") for i, t in corpus]
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, score string"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_stages_against_plain_versions(spark, corpus, components_of, table):
    docs = spark.read.parquet(f"{table}/documents.parquet")
    found = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.staged(stage(spark, docs, table), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "kept", "score"]
        found.append({r.doc_id: r for r in docs.collect()})
        assert all(r.score == "k" and r.kept is True for r in found[-1].values())
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, table).collect()

    # Only texts without a letter have no language.
    rows = {i: t for i, t in corpus if t and any(c.isalpha() for c in t)}
    assert {i: r.text for i, r in found[0].items()} == rows
    last = {t: i for i, t in sorted(rows.items())}
    rows = {i: t for i, t in rows.items() if last[t] == i}
    assert {i: r.text for i, r in found[1].items()} == rows
    ids = sorted(rows)
    group = components_of(len(ids), alike(word_sets([rows[i] for i in ids], 5)))
    rows = {i: rows[i] for k, i in enumerate(ids) if group[k] == k}
    assert {i: r.text for i, r in found[2].items()} == rows
    cut = {}
    for i, (spans, _) in spans_left(list(rows.items()), 400).items():
        raw = rows[i].encode()
        for a, b in reversed([_inward(raw, a, b) for a, b in spans]):
            raw = raw[:a] + raw[b:]
        cut[i] = raw.decode()
    assert {i: r.text for i, r in found[3].items()} == cut
    assert all(r.n_chars == len(r.text) for r in found[3].values())
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = {}
    for r in packed:
        pieces.setdefault(r.doc_id, []).append((r.start, bytes(r.ids)))
    want = {i: np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 2], "<u4").tobytes() for i, t in cut.items()}
    assert {i: b"".join(x for _, x in sorted(p)) for i, p in pieces.items()} == want


def test_run_and_registration(spark, table):
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert [n for n in __spark_entry__.queries() if n.startswith("op")] and {int(n[2:].split("_")[0]) for n in __spark_entry__.queries() if n[:2] == "op" and n[2].isdigit()} == set(range(1, 14))
    assert corpus_pipeline.run(spark, table).count() > 0


def test_empty_table(spark, table):
    docs = spark.read.parquet(f"{table}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, table).count() == 0


def test_passages_of_over_fifty_words_are_cut_and_clean_documents_stay(spark, tmp_path):
    rng = random.Random(8)
    new = lambda n: " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 8))) for _ in range(n))
    passage, shorter = new(51), new(40)
    assert 160 < len(shorter) and len(passage) < 400
    rows = [(i, f"{new(90)} {passage} {new(90)}") for i in range(2)]
    rows += [(i, f"{new(90)} {shorter} {new(90)}") for i in range(2, 4)] + [(i, new(150)) for i in range(4, 8)]
    out = {r.doc_id: r.text for r in corpus_pipeline.cut_passages(spark, spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path)).collect()}
    for i, text in rows:
        # The run may go on by letters that follow alike.
        assert (passage not in out[i] and len(text) - len(passage) - 8 <= len(out[i]) <= len(text) - len(passage)) if i < 2 else out[i] == text

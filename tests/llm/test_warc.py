import base64
import hashlib
import random

import pytest

from sparkpanel.llm.warc import read_warc, write_warc


def payloads():
    rng = random.Random(1)
    parts = ["x", "WARC/1.1\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n", "\r\n\r\n", "WARC/1.", "WARC/WARC/1.", "é"]
    rows = []
    for i in range(60):
        p = "".join(rng.choice(parts) for _ in range(rng.choice([0, 3, 5, 400])))
        if i % 7 == 0:
            p = "same"
        rows.append([i, f"http://a/{i}\r\nX: y" if i % 5 else None, p])
    rows[9][2] = None
    rows[33][2] = "WARC/1.1\r\nContent-Length: 0\r\n\r\n" * 4000
    return rows


@pytest.mark.parametrize("split", [700, 3000, 1 << 27])
def test_round_trip_with_magic_in_payloads(spark, tmp_path, split):
    rows = payloads()
    df = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, kept string").repartition(3)
    write_warc(df, "page_id", "html", f"{tmp_path}/w", "url")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        got = {r.record_id: r for r in read_warc(spark, f"{tmp_path}/w").collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(got) == len(rows)
    first = {}
    for i, _, p in rows:
        first.setdefault(p or "", i)
    for i, url, p in rows:
        row, raw = got[f"<urn:page:{i}>"], (p or "").encode()
        assert row.payload_bytes == len(raw)
        assert row.declared_digest == "sha1:" + base64.b32encode(hashlib.sha1(raw).digest()).decode()
        assert row.target_uri == (url.replace("\r", "%0D").replace("\n", "%0A") if url else None)
        if first[p or ""] == i:
            assert row.record_type == "response" and bytes(row.payload) == raw and row.refers_to is None
        else:
            assert row.record_type == "revisit" and row.payload is None and row.refers_to == f"<urn:page:{first[p or '']}>"


def test_small_payloads_are_responses(spark, tmp_path):
    df = spark.createDataFrame([(1, "ab"), (2, "ab"), (3, "long one"), (4, "long one")], "id long, p string")
    write_warc(df, "id", "p", f"{tmp_path}/w", min_revisit_bytes=3)
    got = sorted((r.record_id, r.record_type) for r in read_warc(spark, f"{tmp_path}/w").collect())
    assert got == [("<urn:page:1>", "response"), ("<urn:page:2>", "response"), ("<urn:page:3>", "response"), ("<urn:page:4>", "revisit")]


def test_null_ids_and_empty_table(spark, tmp_path):
    df = spark.createDataFrame([(None, "a"), (None, "a"), (None, None)], "id long, p string")
    write_warc(df, "id", "p", f"{tmp_path}/w")
    got = read_warc(spark, f"{tmp_path}/w").collect()
    assert [r.record_id for r in got] == ["<urn:page:>"] * 3
    write_warc(df.limit(0), "id", "p", f"{tmp_path}/e")
    assert read_warc(spark, f"{tmp_path}/e").count() == 0


def test_a_file_that_starts_with_something_else_gives_nothing(spark, tmp_path):
    (tmp_path / "x").mkdir()
    record = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
    (tmp_path / "x" / "a.warc").write_bytes(b"junk" + record.encode())
    (tmp_path / "x" / "b.warc").write_bytes(record.encode() * 2)
    assert [bytes(r.payload) for r in read_warc(spark, f"{tmp_path}/x").collect()] == [b"ab", b"ab"]


def record(i, url, body, length=None):
    head = f"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: {length or len(body)}\r\nWARC-Record-ID: <urn:page:{i}>\r\nWARC-Target-URI: {url}\r\n"
    return head.encode() + b"\r\n" + body + b"\r\n\r\n"


@pytest.mark.parametrize("split", [150, 700, 1 << 27])
def test_magic_in_addresses_and_false_candidates_with_odd_lengths(spark, tmp_path, split):
    odd = ["\u00b2", "\u0663", "9" * 19, "9" * 400, "-5", "+5", "1_0", ""]
    false = [f"WARC/1.1\r\nContent-Length: {x}\r\n\r\n" for x in odd] + ["WARC/1.1\r\nContent-Length: 5WARC/1.\r\n\r\n", "WARC/1."]
    urls = ["http://a/WARC/1.0/spec", "WARC/1.", "http://a/WARC/1.WARC/1.1" + "/x" * 90 + "WARC/1.", "http://b"]
    pages = [(i, urls[i % 4], false[i % 10] + "x" * (i % 7) + false[i * 3 % 10]) for i in range(12)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1)
    write_warc(df, "page_id", "html", f"{tmp_path}/w", "url")
    # Here the length stands before the address, and what follows the last record is none.
    (tmp_path / "v").mkdir()
    bodies = [h.encode() for _, _, h in pages]
    (tmp_path / "v" / "a.warc").write_bytes(b"".join(record(i, u, b) for (i, u, _), b in zip(pages, bodies, strict=True)) + b"WARC/1.1\r\nX: y\r\n\r\n" + b"WARC/1.z" * 99)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        got = read_warc(spark, f"{tmp_path}/w").collect()
        plain = read_warc(spark, f"{tmp_path}/v").collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    first = {}
    for i, _, h in pages:
        first.setdefault(h, i)
    assert sorted((r.record_id, r.target_uri, r.payload and bytes(r.payload)) for r in got if first[pages[int(r.record_id[10:-1])][2]] == int(r.record_id[10:-1])) == sorted(
        (f"<urn:page:{i}>", u, h.encode()) for i, u, h in pages if first[h] == i
    )
    assert sorted((r.record_id, r.target_uri) for r in got) == sorted((f"<urn:page:{i}>", u) for i, u, _ in pages)
    assert sorted((r.record_id, r.target_uri, bytes(r.payload)) for r in plain) == sorted((f"<urn:page:{i}>", u, b) for (i, u, _), b in zip(pages, bodies, strict=True))

"""Web archive files: written as splittable text, read back by verified record boundaries."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkpanel.llm.arrow import batched
from sparkpanel.llm.exact import exact_dedup
from sparkpanel.llm.staging import staged

MAGIC = b"WARC/1."
END = "\r\n\r\n"
#: A length in a header: ASCII digits, below a petabyte, so that sums with it are far from 2^63.
_LENGTH = re.compile(rb"0*[0-9]{1,15}")
#: RFC 4648 alphabet beside the digits that a conversion to base 32 gives.
BASE32 = ("0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")

RECORD_SCHEMA = (
    "file string, offset long, record_type string, record_id string, target_uri string, refers_to string, "
    "declared_digest string, payload_bytes long, payload binary"
)


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1, each 20 bits as four letters."""
    digest = F.sha1(payload)
    quads = [F.lpad(F.conv(F.substring(digest, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.concat(*quads), *BASE32)


def write_warc(df: DataFrame, id_col: str, payload_col: str, path: str, uri_col: str | None = None, min_revisit_bytes: int = 0) -> None:
    """One response or revisit record for each row, as files below ``path``.

    Of rows with equal payloads of at least ``min_revisit_bytes`` bytes the one with the
    smallest id becomes a response, the others revisit records that refer to it and hold
    the HTTP head alone. Smaller payloads are always responses. Null payloads are empty; a
    null id gives a record whose id ends at the colon; a null address gives no such line.
    Rows that repeat an id are responses or revisits alike. Only the three columns are
    read, so others may have any name. An empty table gives a folder without records.
    """
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    uri = F.col(uri_col).cast("string") if uri_col else F.lit(None).cast("string")
    rows = df.select(F.col(id_col).alias("id"), payload.alias("payload"), uri.alias("uri"))
    marked = exact_dedup(rows, "id", "payload", keep="min").withColumn("size", F.octet_length("payload"))
    revisit = ~F.col("kept") & (F.col("size") >= min_revisit_bytes)

    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    safe_uri = F.replace(F.replace("uri", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit(END)
    )
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    profile = F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    block = F.concat(F.col("http"), F.when(F.col("revisit"), F.lit("")).otherwise(F.col("payload")))
    records = marked.withColumns({"revisit": revisit, "http": http}).withColumn("block", block).select(F.concat(
        F.lit(MAGIC.decode() + "1\r\n"), line("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        line("WARC-Record-ID", urn("id")), line("WARC-Target-URI", safe_uri), F.lit("WARC-Date: 1970-01-01T00:00:00Z\r\n"),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(F.col("payload")))),
        F.when(F.col("revisit"), F.concat(line("WARC-Refers-To", urn("keep_id")), line("WARC-Profile", profile))).otherwise(""),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        line("Content-Length", F.octet_length("block").cast("string")), F.lit("\r\n"), F.col("block"),
    ).alias("value"))
    records.write.option("lineSep", END).text(path)


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """The files cut at each occurrence of the magic, in order inside each split."""
    return spark.read.option("lineSep", MAGIC.decode()).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value")
    )


def _length(value: bytes) -> int | None:
    return int(value) if _LENGTH.fullmatch(value) else None


def _header(chunk: bytes) -> tuple[int, dict[str, str]] | None:
    """Length of the record from the magic up to its successor, and its fields; None if this is no header."""
    stop = chunk.find(b"\r\n\r\n")
    if stop < 0:
        return None
    lines = chunk[:stop].decode("utf-8", "replace").split("\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    length = _length(fields.get("content-length", "").encode())
    if length is None:
        return None
    return len(MAGIC) + stop + 4 + length + 4, fields


class _Headers:
    """Candidates of a split whose header isn't over; a magic may stand inside a header, so it can go on in later chunks.

    All that are open end at the same blank line, and the last line with a length counts
    for those that begin before it. ``declared`` is that length, -1 if it is none, and
    None without such a line; ``line`` is where the line begins.
    """

    def __init__(self):
        self.open, self.line, self.declared = [], -1, None

    def stop(self, chunk: bytes, at: int) -> int:
        """Take the chunk that begins at ``at``; where in it the open headers end, or -1."""
        stop = chunk.find(b"\r\n\r\n")
        lines = chunk[: stop if stop >= 0 else len(chunk)].split(b"\r\n")
        place = at + len(lines[0]) + 2
        for i, line in enumerate(lines[1:], 2):
            name, _, value = line.partition(b":")
            if name.strip().lower() == b"content-length":
                # The last line of a chunk without a blank line goes on with the next magic.
                length = _length(value.strip()) if stop >= 0 or i < len(lines) else None
                self.line, self.declared = place, -1 if length is None else length
            place += len(line) + 2
        return stop

    def length(self, at: int) -> int | None:
        """What the header that begins at ``at`` declares."""
        return self.declared if at < self.line else None


def _last_inside(offsets: np.ndarray, successors: np.ndarray, total: int) -> np.ndarray:
    """Index of the last candidate in the split on each candidate's chain, by pointer jumping."""
    at = np.searchsorted(offsets, successors)
    inside = (successors < total) & (at < len(offsets))
    inside[inside] = offsets[at[inside]] == successors[inside]
    jump = np.where(inside, at, np.arange(len(offsets)))
    while True:
        further = jump[jump]
        if np.array_equal(further, jump):
            return jump
        jump = further


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each split a row with its length and, for each candidate in it, where its chain leaves the split.

    Candidates whose header isn't over at the end of the split have no exit; they are
    exits of others. ``stop`` of the split's row is where headers that are open at its
    start end, and ``declared`` the length that they find in it.
    """
    def row_batch(key, total, pre, stop, declared, offsets, successors, headers):
        offsets, successors = np.array(offsets, np.int64), np.array(successors, np.int64)
        jump = _last_inside(offsets, successors, total)
        n = len(offsets) + len(headers.open) + 1
        late = headers.open
        return pa.RecordBatch.from_arrays([
            pa.array([key[0]] * n), pa.array([key[1]] * n, pa.int64()), pa.array([total] * n, pa.int64()), pa.array([pre] * n, pa.int64()),
            pa.array([stop] + [None] * (n - 1), pa.int64()),
            pa.array([declared, *[None] * len(offsets), *map(headers.length, late)], pa.int64()),
            *[pa.array([None, *x.tolist(), *y], pa.int64()) for x, y in ((offsets, late), (offsets[jump], late), (successors[jump], [None] * len(late)))],
        ], names=["file", "block", "total", "pre", "stop", "declared", "offset", "last", "exit"])

    def finished():
        return row_batch(key, total, pre, first, declared if first is not None else headers.declared, offsets, successors, headers)

    key, total, pre, first, declared, offsets, successors, headers = None, 0, 0, None, None, [], [], _Headers()
    for batch in batches:
        for file, block, value in zip(batch["file"].to_pylist(), batch["block"].to_pylist(), batch["value"], strict=True):
            chunk = value.as_py()
            if key != (file, block):
                if key:
                    yield finished()
                key, total, pre, first, declared, offsets, successors, headers = (file, block), 0, 0, None, None, [], [], _Headers()
                if block == 0:  # what stands before the first magic
                    total, pre = len(chunk), len(chunk)
                    continue
            headers.open.append(total)
            stop = headers.stop(chunk, total + len(MAGIC))
            if stop >= 0:
                end = total + len(MAGIC) + stop + 4
                if first is None:
                    first, declared = end, headers.declared
                for at in headers.open:
                    length = headers.length(at)
                    if length is not None and length >= 0:
                        offsets.append(at)
                        successors.append(end + length + 4)
                headers = _Headers()
            total += len(MAGIC) + len(chunk)
    if key:
        yield finished()


def _record(file: str, offset: int, record: bytes, fields: dict[str, str]) -> tuple:
    """``record``: what follows the magic, up to the end of the block."""
    block = record[record.find(b"\r\n\r\n") + 4:]
    size = None
    payload = block
    if fields.get("content-type", "").startswith("application/http"):
        cut = block.find(b"\r\n\r\n")
        head, payload = block[:cut].lower(), block[cut + 4:]
        _, found, rest = head.partition(b"content-length:")
        size = _length(rest.split(b"\r\n")[0].strip()) if found else None
    kind = fields.get("warc-type")
    return (
        file, offset, kind, fields.get("warc-record-id"), fields.get("warc-target-uri"), fields.get("warc-refers-to"),
        fields.get("warc-payload-digest"), len(payload) if size is None else size, None if kind == "revisit" else payload,
    )


_ARROW_RECORD = pa.schema([
    ("file", pa.string()), ("offset", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()),
    ("refers_to", pa.string()), ("declared_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary()),
    ("part", pa.binary()), ("part_at", pa.int64()),
])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Follow each split's chain from its entry.

    Chunks before the entry continue a record of an earlier split, and a record that is not
    over at the end of the split goes on in later ones: both leave as parts of that record.
    """
    def rows():
        key, at, need, owner, held, size, length, entered = None, 0, None, None, [], 0, None, False

        def part(file, owner, at, value):
            return (file, owner, *[None] * 7, value, at)

        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("file", "block", "base", "entry", "owner")]
            for file, block, base, entry, before, value in zip(*columns, batch["value"], strict=True):
                chunk = value.as_py()
                if key != (file, block):
                    if held:
                        yield part(key[0], owner, owner, b"".join(held))
                    key, at, need, owner, held, entered = (file, block), base, entry, before, [], False
                    if block == 0:
                        at += len(chunk)
                        continue
                if at == need:
                    owner, need, length, entered = at, None, None, True
                    held, size = [chunk], len(chunk)
                elif held:
                    held.append(MAGIC + chunk)
                    size += len(held[-1])
                elif not entered and owner is not None:
                    yield part(file, owner, at, MAGIC + chunk)
                if held and length is None and b"\r\n\r\n" in chunk:
                    found = _header(b"".join(held))
                    if found:
                        step, fields = found
                        need, length = owner + step, step - len(MAGIC) - 4
                    else:  # the chain ends before this
                        held = []
                if held and length is not None and size >= length:
                    yield (*_record(file, owner, b"".join(held)[:length], fields), None, None)
                    held = []
                at += len(MAGIC) + len(chunk)
        if held:
            yield part(key[0], owner, owner, b"".join(held))

    return batched(rows(), _ARROW_RECORD)


def _join_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            for file, offset, parts in zip(*(batch[c].to_pylist() for c in ("file", "offset", "parts")), strict=True):
                whole = b"".join(p["part"] for p in parts)
                # Without its start the record is whole in its split, and what follows it no record.
                found = _header(whole) if parts[0]["part_at"] == offset else None
                if not found:
                    continue
                step, fields = found
                yield _record(file, offset, whole[: step - len(MAGIC) - 4], fields)

    return batched(rows(), pa.schema(list(_ARROW_RECORD)[:9]))


def _reachable(links: DataFrame, starts: DataFrame) -> DataFrame:
    """Candidates on the chain from their file's start. Each round doubles the distance a link spans."""
    # Neither side is broadcast: compressed files look smaller than their rows are.
    links, found, size = links.hint("merge"), staged(starts, "reached"), -1
    while (now := found.count()) != size:
        size = now
        onward = found.join(links, ["file", "at"]).select("file", F.col("to").alias("at"))
        valid = onward.join(links.select("file", "at"), ["file", "at"], "left_semi")
        found = staged(found.unionByName(valid).distinct(), "reached")
        second = links.select("file", F.col("at").alias("to"), F.col("to").alias("further"))
        links = staged(
            links.join(second, ["file", "to"], "left").select("file", "at", F.coalesce("further", "to").alias("to")), "links"
        ).hint("merge")
    return found


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archives below ``path``: see ``RECORD_SCHEMA``. Revisits have a null payload.

    The files are cut at each magic, which may also stand inside a payload. Tasks give
    for each candidate where its chain of successors leaves the split; pointer jumping
    over these links keeps what can be reached from the start of a file. The second read
    follows each split's chain from the entry so found and puts payloads together again
    across inner magics. A header may hold the magic too, and go on in the next splits. What one task holds is a record, or the offsets of one split.
    The broadcast has a row of about 100 bytes for each file split.
    """
    chunks = _chunks(spark, path)
    scanned = staged(chunks.mapInArrow(
        _scan, "file string, block long, total long, pre long, stop long, declared long, offset long, last long, exit long"
    ), "candidates")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # Splits up to the next one with a blank line share the end of a header that is open before them, and the last length counts.
    onward = Window.partitionBy("file", "ended").orderBy("block").rowsBetween(0, Window.unboundedFollowing)
    following = Window.partitionBy("file").orderBy("block")
    splits = staged(
        scanned.filter("offset is null").select("file", "block", "total", "pre", "stop", "declared")
        .withColumn("base", F.coalesce(F.sum("total").over(before), F.lit(0))).withColumn("ended", F.count("stop").over(before))
        .withColumns({"end": F.max(F.col("base") + F.col("stop")).over(onward), "last_declared": F.last("declared", ignorenulls=True).over(onward)})
        .withColumns({"next_end": F.lead("end").over(following), "next_declared": F.lead("last_declared").over(following)})
        .select("file", "block", "total", "pre", "base", "next_end", "next_declared"), "splits"
    )
    late = F.when(F.coalesce("next_declared", "declared") >= 0, F.col("next_end") + F.coalesce("next_declared", "declared") + 4)
    chains = staged(
        scanned.filter("offset is not null").join(splits.select("file", "block", "base", "next_end", "next_declared"), ["file", "block"])
        .select(
            "file", "block", *[(F.col("base") + F.col(c)).alias(n) for c, n in (("offset", "at"), ("last", "last"))],
            F.coalesce(F.col("base") + F.col("exit"), late).alias("to"),
        ).filter("to is not null"), "links"
    )
    links = chains.select("file", "at", "to")
    # A file starts with a record, or nothing in it can be reached.
    starts = splits.filter("block = 0 and pre = 0").select("file", F.lit(0).cast("long").alias("at")).join(links.select("file", "at").hint("merge"), ["file", "at"], "left_semi")
    reached = _reachable(links, starts)
    # A header that isn't over at the end of a split is reached beside the entry whose chain leads to it.
    entries = chains.hint("merge").join(reached, ["file", "at"], "left_semi").groupBy("file", "block").agg(
        F.min("at").alias("entry"), F.max("last").alias("last")
    )
    known = (
        splits.join(entries, ["file", "block"], "left")
        .withColumn("owner", F.last("last", ignorenulls=True).over(before)).select("file", "block", "base", "entry", "owner")
    )
    chunks = chunks.join(F.broadcast(known), ["file", "block"])
    read = chunks.mapInArrow(_read, f"{RECORD_SCHEMA}, part binary, part_at long")
    whole = read.filter("part is null").drop("part", "part_at")
    parts = (
        read.filter("part is not null").groupBy("file", "offset")
        .agg(F.sort_array(F.collect_list(F.struct("part_at", "part"))).alias("parts"))
        .mapInArrow(_join_parts, RECORD_SCHEMA)
    )
    return whole.unionByName(parts)

"""WARC archives: writing with revisit records, and reading by verified chains of record boundaries."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync import files
from tablesync.llm.common import arrow_schema, record_batch, running_total, stored

# Fixed values of the format.
MAGIC = b"WARC/1.1\r\n"
END = "\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http;msgtype=response"
#: A table of repeated payloads goes to all tasks up to this size; beyond it, the join shuffles.
BROADCAST_BYTES, ROW_BYTES = 32 << 20, 120


def sha1_base32(payload: Column) -> Column:
    """SHA-1 in bare upper-case base 32."""
    digits = F.sha1(payload)
    letters = []
    for group in range(8):
        number = F.conv(F.substring(digits, 5 * group + 1, 5), 16, 10).cast("int")
        letters += [F.substr(F.lit(BASE32), F.shiftright(number, by).bitwiseAND(31) + 1, F.lit(1)) for by in (15, 10, 5, 0)]
    return F.concat(*letters)


def write_warc(
    pages: DataFrame,
    path: str,
    min_payload_bytes: int = 0,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    date: str = "2000-01-01T00:00:00Z",
) -> None:
    """Write one record per page below ``path``, as many files as the pages have partitions.

    Of pages with equal payloads of at least ``min_payload_bytes`` bytes, that with the greatest id is a response and the others are
    revisits of it, which hold the HTTP header but no payload; all other pages are responses. Rows alike in id and payload
    are responses together if their id is the greatest. A null payload is empty, a null url gives no target
    line, a line break in a url is percent-encoded, a null id is an empty one and the smallest.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"),
        F.regexp_replace(F.regexp_replace(F.col(url_col), "\r", "%0D"), "\n", "%0A").alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).alias("n"),
        sha1_base32(payload).alias("digest"),
    )
    equal = rows.where(F.col("n") >= min_payload_bytes).groupBy("digest", "n")
    repeated = stored(equal.agg(F.max("id").alias("keeper"), F.count("*").alias("copies")).where("copies > 1"), "warc-repeated")
    repeated = repeated.drop("copies")
    if repeated.count() * ROW_BYTES <= BROADCAST_BYTES:
        repeated = F.broadcast(repeated)
    marked = rows.join(repeated, ["digest", "n"], "left")
    revisit = F.col("keeper").isNotNull() & ~F.col("id").eqNullSafe(F.col("keeper"))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    line = lambda key, value: F.concat(F.lit(f"{key}: "), value, F.lit("\r\n"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\n"), line("Content-Type", F.lit("text/html; charset=utf-8")), line("Content-Length", F.col("n").cast("string")), F.lit("\r\n")
    )
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload").cast("string"))
    header = F.concat(
        F.lit(MAGIC.decode()),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", name("id")),
        line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", F.col("url")), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", name("keeper")))).otherwise(F.lit("")),
        line("Content-Type", F.lit(HTTP_TYPE)),
        line("Content-Length", (F.octet_length(http) + F.octet_length(body)).cast("string")),
        F.lit("\r\n"),
    )
    marked.select(F.concat(header, http, body).alias("value")).write.option("lineSep", END).text(path)


RECORD = "warc_type string, record_id string, target_uri string, refers_to string, payload_digest string, payload_bytes long"
NARROW = [part.split()[0] for part in RECORD.split(", ")]


def _header(data: bytes) -> tuple[int, dict[bytes, bytes]] | None:
    """Where the content begins and the fields, if this can be a record after its first line."""
    end = data.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {}
    for row in data[:end].split(b"\r\n"):
        key, colon, value = row.partition(b":")
        if not colon:
            return None
        fields[key.strip().lower()] = value.strip()
    return (end + 4, fields) if fields.get(b"content-length", b"").isdigit() else None


def _record(fields: dict[bytes, bytes], content: bytes) -> tuple[dict, bytes]:
    """The columns of RECORD and the payload. A revisit's digest and size are those its headers give."""
    payload, http = content, b""
    if fields.get(b"content-type", b"").startswith(b"application/http"):
        http, gap, payload = content.partition(b"\r\n\r\n")
    kind = fields.get(b"warc-type", b"").decode("utf-8", "replace")
    digest, size = base64.b32encode(hashlib.sha1(payload).digest()).decode(), len(payload)
    if kind == "revisit":
        digest = fields.get(b"warc-payload-digest", b"").decode("utf-8", "replace").removeprefix("sha1:") or None
        lengths = [row.partition(b":")[2].strip() for row in http.split(b"\r\n") if row.lower().startswith(b"content-length:")]
        size = int(lengths[0]) if lengths and lengths[0].isdigit() else None
    text = lambda key: fields[key].decode("utf-8", "replace") if key in fields else None
    values = (kind, text(b"warc-record-id"), text(b"warc-target-uri"), text(b"warc-refers-to"), digest, size)
    return dict(zip(NARROW, values, strict=True)), payload


def _candidates(file: str, block: int, parts: list[bytes], keep: bool) -> Iterator[dict]:
    """Everything in a block that can be a record, with its successor and where its chain leaves the block.

    Places count from the first byte the block's reader returned. The row without a place has the block's length.
    """
    places, at = [], 0
    for part in parts:
        places.append(at)
        at += len(part) + len(MAGIC)
    yield {"file": file, "block": block, "total": at}
    end, joined, rows = at - len(MAGIC), None, []
    for k, part in enumerate(parts):
        if (block == 0 and k == 0) or (head := _header(part)) is None:
            continue
        begin, fields = head
        stop = begin + int(fields[b"content-length"])
        row = {"file": file, "block": block, "at": places[k] - len(MAGIC), "next": places[k] + stop + 4}
        content = None
        if stop + 4 <= len(part):  # where anything but the magic line follows, the chain ends after the record
            content = part[begin:stop] if part[stop : stop + 4] == b"\r\n\r\n" else None
        elif places[k] + stop + 4 <= end and stop + 4 > len(part):
            joined = MAGIC.join(parts) if joined is None else joined
            here = joined[places[k] : places[k] + stop + 4]
            content = here[begin:stop] if here.endswith(b"\r\n\r\n") else None
        elif stop + 4 > len(part):
            row["crossing"] = True
        if content is not None:
            found, payload = _record(fields, content)
            row |= found | {"crossing": False} | ({"payload": payload} if keep else {})
        if "crossing" in row:
            rows.append(row)
    leaves: dict[int, int] = {}
    for row in reversed(rows):
        row["leave"] = leaves[row["at"]] = leaves.get(row["next"], row["next"])
    yield from rows


def _fragments(spark: SparkSession, path: str) -> DataFrame:
    """What lies between two magic lines, in order within each block of a file."""
    text = spark.read.option("lineSep", MAGIC.decode()).text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("data")
    )


def _scanned(spark: SparkSession, path: str, keep: bool) -> DataFrame:
    schema = f"file string, block long, total long, at long, next long, leave long, crossing boolean, {RECORD}" + (", payload binary" if keep else "")
    target = arrow_schema(spark, schema)

    def batch(rows: list[dict]) -> pa.RecordBatch:
        return record_batch({f.name: [r.get(f.name) for r in rows] for f in target}, target)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []
        for some in batches:
            keys = zip(some.column(0).to_pylist(), some.column(1).to_pylist(), some.column(2).to_pylist(), strict=True)
            for file, block, data in keys:
                if (file, block) != now:
                    if now is not None:
                        yield batch(list(_candidates(*now, parts, keep)))
                    now, parts = (file, block), []
                parts.append(data)
        if now is not None:
            yield batch(list(_candidates(*now, parts, keep)))

    return _fragments(spark, path).mapInArrow(scan, schema)


def _entries(jumps: DataFrame) -> DataFrame:
    """Where the chain from each file's start enters blocks, by pointer jumping over ``start`` -> ``leave``.

    After round k the entries are those within 2^k blocks of the start, and a jump passes 2^k blocks.
    """
    reached = stored(jumps.where("start = 0").select("file", "block", "start"), "warc-entries")
    count = reached.count()
    while True:
        step = reached.join(jumps.select("file", "start", "leave"), ["file", "start"]).select("file", F.col("leave").alias("start"))
        found = step.join(jumps.select("file", "start", "block"), ["file", "start"]).select("file", "block", "start")
        reached = stored(reached.union(found).distinct(), "warc-entries")
        now = reached.count()
        if now == count:
            return reached
        count = now
        further = jumps.select("file", F.col("start").alias("leave"), F.col("leave").alias("further"))
        jumps = stored(
            jumps.join(further, ["file", "leave"], "left").select("file", "block", "start", F.coalesce("further", "leave").alias("leave")), "warc-jumps"
        )


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all uncompressed WARC 1.1 files below ``path``, each with its place in its file.

    Files are read in blocks, split at the magic line wherever it occurs, also in a payload. Every place that can be a record
    gives its successor's offset; within a block, chains are followed to where they leave it. Pointer jumping from offset 0 of every
    file over those leaps finds where the true chain enters each block, and only records on the chain are
    kept. A record that holds magic lines and crosses blocks is put together in a second pass over its blocks.

    Returns file, offset, the columns of RECORD and, if asked for, payload. A revisit has the digest and size of the
    payload it stands for. Defined cases: an empty file has no records; a file that does not begin with a record has none;
    a chain ends where no record follows; a record cut off by the end of its file is not returned; equal records
    come once each. Files of other versions or compressed ones have no records.
    """
    found = stored(_scanned(spark, path, payloads), "warc-scan")
    totals = found.where("total IS NOT NULL").select("file", "block", "total")
    bases = stored(running_total(totals, ["file"], "block", "total", "base").select("file", "block", "base"), "warc-bases")
    placed = found.where("at IS NOT NULL").join(bases, ["file", "block"])
    jumps = placed.select("file", "block", (F.col("base") + F.col("at")).alias("start"), (F.col("base") + F.col("leave")).alias("leave"))
    arrivals = jumps.select("file", F.col("leave").alias("start")).distinct()
    jumps = stored(jumps.where("start = 0").union(jumps.where("start <> 0").join(arrivals, ["file", "start"], "left_semi").select("file", "block", "start", "leave")), "warc-jumps")
    entries = _entries(jumps)
    columns = [*NARROW, *(["payload"] if payloads else [])]
    types = dict(found.dtypes)
    schema = "file string, block long, offset long, next long, crossing boolean, " + ", ".join(f"{c} {types[c]}" for c in columns)
    target = arrow_schema(spark, schema)

    def follow(table: pa.Table) -> pa.Table:
        """The records of one block that lie on the chain from its entry."""
        base, entry = table.column("base")[0].as_py(), table.column("entry")[0].as_py()
        at = {place + base: k for k, place in enumerate(table.column("at").to_pylist())}
        after, rows, place = table.column("next").to_pylist(), [], entry
        while place in at:
            rows.append(at[place])
            place = after[at[place]] + base
        own = table.take(pa.array(rows, pa.int64()))
        offsets = [n + base for n in own.column("at").to_pylist()]
        nexts = [n + base for n in own.column("next").to_pylist()]
        values = {c: own.column(c).combine_chunks() for c in ("file", "block", "crossing", *columns)}
        return pa.Table.from_batches([record_batch(values | {"offset": offsets, "next": nexts}, target)])

    entered = entries.select("file", "block", F.col("start").alias("entry"))
    candidates = placed.select("file", "block", "base", "at", "next", "crossing", *columns).join(entered, ["file", "block"])
    reachable = stored(candidates.groupBy("file", "block").applyInArrow(follow, schema), "warc-records")
    records = reachable.where("NOT crossing").select("file", "offset", *columns)
    crossing = reachable.where("crossing").select("file", "block", "offset", "next")
    if crossing.isEmpty():
        return records
    return records.union(_put_together(spark, path, crossing, bases, payloads).select("file", "offset", *columns))


def _put_together(spark: SparkSession, path: str, crossing: DataFrame, bases: DataFrame, keep: bool) -> DataFrame:
    """Records over several blocks. At most one of them enters and one leaves a block, so the join has two matches at most."""
    own = crossing.select("file", "block", "offset", "next")
    others = crossing.drop("block").join(bases, "file").where("base > offset AND base < next").select("file", "block", "offset", "next")
    wanted = own.union(others).distinct()
    schema = "file string, block long, at long, data binary"
    target = arrow_schema(spark, schema)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, at = None, 0
        for some in batches:
            places = []
            keys = zip(some.column(0).to_pylist(), some.column(1).to_pylist(), some.column(2).to_pylist(), strict=True)
            for file, block, data in keys:
                if (file, block) != now:
                    now, at = (file, block), 0
                places.append(at)
                at += len(data) + len(MAGIC)
            yield record_batch({"file": some.column(0), "block": some.column(1), "at": places, "data": some.column(2)}, target)

    pieces = (
        _fragments(spark, path)
        .mapInArrow(place, schema)
        .join(wanted.join(bases, ["file", "block"]), ["file", "block"])
        .withColumn("place", F.col("base") + F.col("at"))
        .where("place > offset AND place < next")
        .select("file", "offset", "next", "place", "data")
    )
    schema = f"file string, offset long, {RECORD}" + (", payload binary" if keep else "")
    whole = arrow_schema(spark, schema)

    def join(table: pa.Table) -> pa.Table:
        order = sorted(range(table.num_rows), key=table.column("place").to_pylist().__getitem__)
        data = MAGIC.join(table.column("data")[k].as_py() for k in order)
        start, after = table.column("offset")[0].as_py(), table.column("next")[0].as_py()
        data = data[: after - start - len(MAGIC)]
        head = _header(data)
        rows: list[dict] = []
        if head and len(data) == after - start - len(MAGIC) and data.endswith(b"\r\n\r\n"):
            found, payload = _record(head[1], data[head[0] : -4])
            rows = [found | {"file": table.column("file")[0].as_py(), "offset": start} | ({"payload": payload} if keep else {})]
        return pa.Table.from_batches([record_batch({f.name: [r[f.name] for r in rows] for f in whole}, whole)])

    return pieces.groupBy("file", "offset").applyInArrow(join, schema)


def archive_round_trip(pages: DataFrame, min_payload_bytes: int = 0) -> DataFrame:
    """Write pages as WARC files in the shared folder and read what the archives say of each page."""
    path = files.scratch(pages.sparkSession, "warc")
    write_warc(pages, path, min_payload_bytes)
    number = lambda c: F.nullif(F.regexp_extract(c, r"page:(-?\d*)>", 1), F.lit("")).cast("long")
    records = read_warc(pages.sparkSession, path, payloads=False)
    return records.select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", F.col("warc_type").alias("record_type"),
        number("refers_to").alias("refers_to"), "target_uri",
    )

"""WARC archives of pages: written and read back as splittable text, records found by the chain of their boundaries."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shotlake.llm.common import materialise

# Fixed values of the format (WARC 1.1).
VERSION, END = "WARC/1.1", "\r\n\r\n"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Where a record may begin: the end of one, then the magic of all versions.
BOUNDARY = END + "WARC/1."
#: When the pages were fetched, where their table doesn't say.
DATE = "2024-01-01T00:00:00Z"
#: Bytes of the table of splits that is sent to every task; a larger one is joined by shuffles.
MOST_SENT = 64 << 20


def base32(hexadecimal: Column) -> Column:
    """40 hexadecimal digits as 32 of base 32: each five digits are four."""
    group = lambda k: F.conv(F.substring(hexadecimal, 5 * k + 1, 5), 16, 10).cast("int")
    digit = lambda k, shift: F.substring(F.lit(BASE32), F.shiftright(group(k), shift).bitwiseAND(31) + 1, F.lit(1))
    return F.concat(*[digit(k, shift) for k in range(8) for shift in (15, 10, 5, 0)])


def _digest_key(payload: Column) -> list[Column]:
    """What equal payloads share; the second hash tells apart what only shares its SHA-1."""
    return [F.sha1(payload).alias("sha1"), F.octet_length(payload).cast("long").alias("n_bytes"), F.xxhash64(payload).alias("other_hash")]


def _header(value: Column) -> Column:
    """A value that can't end its line: control characters and blanks are percent-encoded."""
    clean = value
    for code in (*range(33), 127):
        clean = F.replace(clean, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.when(value.rlike(r"[\x00-\x20\x7F]"), clean).otherwise(value)


def write(pages: DataFrame, path: str, least_bytes: int = 0, date: str = DATE) -> None:
    """Write one record for each row of pages (page_id, url, html) to files under path, each a WARC of its own.

    Of rows whose html has at least least_bytes and is equal, that with the smallest page_id is a `response`, the others are
    `revisit`s without payload that refer to it; shorter ones are all responses. Null html is empty, a null url is left out,
    rows without an id come after all others, and of repeated rows with one id and html one is the response. An empty table
    gives no records; further columns are left behind.

    The html isn't shuffled unless so many payloads are repeated that their list can't be broadcast: the list of the first
    row of each repeated payload is aggregated from digests, and revisits are made of digests alone.
    """
    spark = pages.sparkSession
    html = F.coalesce(pages["html"], F.lit(""))
    pages = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].alias("url"), html.alias("html"))
    keys = ["sha1", "n_bytes", "other_hash"]
    order = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", F.col("url").isNotNull().alias("has_url"), "url")
    narrow = pages.select("page_id", "url", *_digest_key(F.col("html")))
    narrow = materialise(narrow.groupBy(*keys, "page_id", "url").agg(F.count("*").alias("rows")).withColumn("order", order), "digests")
    firsts = narrow.where(F.col("n_bytes") >= least_bytes).groupBy(*keys).agg(F.min("order").alias("first"), F.sum("rows").alias("members"), F.min_by("rows", "order").alias("twins"))
    firsts = materialise(firsts.where("members > 1").drop("members"), "firsts")

    request = lambda n: F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), n.cast("string"), F.lit(END))
    record_id = lambda page, url, sha1: F.regexp_replace(F.md5(F.concat_ws(" ", page.cast("string"), url, sha1)), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "<urn:uuid:$1-$2-$3-$4-$5>")

    def record(kind: str, block: Column, more: list[Column]) -> Column:
        line = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise("")
        return F.concat(
            F.lit(f"{VERSION}\r\nWARC-Type: {kind}\r\nWARC-Date: {date}\r\n"),
            line("WARC-Record-ID", record_id(F.col("page_id"), F.col("url"), F.col("sha1"))),
            line("WARC-Target-URI", _header(F.col("url"))),
            line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("sha1")))),
            line("X-Page-Id", F.col("page_id").cast("string")),
            *[line(*m) for m in more],
            line("Content-Type", F.lit("application/http; msgtype=response")),
            line("Content-Length", F.octet_length(block).cast("string")),
            F.lit("\r\n"),
            block,
        ).alias("value")

    # nulls meet in the order's comparison, so that a row without an id finds itself
    whole = pages.select("*", *_digest_key(F.col("html"))).withColumn("order", order).join(firsts, keys, "left")
    single = whole.where(F.col("first").isNull() | (F.col("order").eqNullSafe(F.col("first")) & (F.col("twins") == 1)))
    if not firsts.where("twins > 1").isEmpty():
        single = single.unionByName(whole.where(F.col("order").eqNullSafe(F.col("first")) & (F.col("twins") > 1)).dropDuplicates(keys))
    responses = single.select(record("response", F.concat(request(F.col("n_bytes")), "html"), []))
    again = narrow.join(firsts, keys).withColumn("copies", F.col("rows") - F.col("order").eqNullSafe(F.col("first")).cast("int")).where("copies > 0")
    again = again.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    target = F.col("first.page_id")
    refers = [("WARC-Profile", F.lit(IDENTICAL)), ("WARC-Refers-To", record_id(target, F.col("first.url"), F.col("sha1"))), ("WARC-Refers-To-Target-URI", _header(F.col("first.url"))), ("X-Refers-To-Page-Id", target.cast("string"))]
    revisits = again.select(record("revisit", request(F.col("n_bytes")), refers))
    responses.unionByName(revisits).write.option("lineSep", END).option("compression", "none").text(path)


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """What lies between boundaries, split by split in order: (file, split, chunk as bytes)."""
    text = spark.read.option("lineSep", BOUNDARY).option("recursiveFileLookup", True).text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("value").cast("binary").alias("chunk"))


MAGIC, GAP = len("WARC/1."), len(BOUNDARY)


def _length(chunk: bytes) -> int | None:
    """Bytes from the magic that came before chunk to the end of the record that begins there, its closing blank lines
    included; None if chunk doesn't begin with a header."""
    end = chunk.find(b"\r\n\r\n")
    lines = chunk[:end].split(b"\r\n") if end >= 0 else []
    if len(lines) < 2 or not lines[0].strip().isdigit() or not all(b":" in x for x in lines[1:] if x[:1] not in b" \t"):
        return None
    sizes = [x.partition(b":")[2].strip() for x in lines if x[:15].lower() == b"content-length:"]
    return MAGIC + end + 4 + int(sizes[0]) + 4 if len(sizes) == 1 and sizes[0].isdigit() else None


class _Places:
    """Of the chunks of one split in order: where each begins, from the split's first on. The magic before a chunk belongs
    to its record, so a record begins MAGIC bytes before its chunk; a file's first record has no boundary before it."""

    def __init__(self, split: int):
        self.first, self.at = split == 0, 0

    def next(self, chunk: bytes) -> tuple[int, bytes]:
        """(where the record would begin, chunk without its magic)."""
        at, self.at = self.at, self.at + len(chunk) + GAP
        if self.first:
            self.first = False
            return (at, chunk[MAGIC:]) if chunk.startswith(b"WARC/1.") else (at, b"")
        return at - MAGIC, chunk


def _splits(batches: Iterator[pa.RecordBatch], extra: int = 0) -> Iterator[tuple]:
    """(file, split, chunk, the values of further columns)."""
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in (0, 1, *range(3, 3 + extra))]
        for r, chunk in enumerate(batch.column(2)):
            yield columns[0][r], columns[1][r], chunk.as_buffer().to_pybytes(), [c[r] for c in columns[2:]]


_LINKS = "file string, split long, at long, leaves long, last long, cut boolean, total long"


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each candidate of a split (at) with the first place that isn't a candidate of the split to which its successors
    lead (leaves), the last candidate on that way, counted from the split's first chunk, and whether the record holds boundaries.
    A last row of each split holds the bytes of its chunks."""

    def handed(file: str, split: int, found: list[tuple[int, int, bool]], total: int) -> pa.RecordBatch:
        ways: dict[int, tuple[int, int]] = {}
        for at, size, _ in reversed(found):
            ways[at] = ways.get(at + size, (at + size, at))
        rows = [(file, split, at, *ways[at], cut, None) for at, _, cut in found] + [(file, split, None, None, None, None, total)]
        return _batch(rows, _LINKS)

    now, found, places = None, [], None
    for file, split, chunk, _ in _splits(batches):
        if now != (file, split):
            if now:
                yield handed(*now, found, places.at)
            now, found, places = (file, split), [], _Places(split)
        at, chunk = places.next(chunk)
        size = _length(chunk)
        if size is not None:
            found.append((at, size, MAGIC + len(chunk) + 4 < size))
    if now:
        yield handed(*now, found, places.at)


def boundaries(spark: SparkSession, path: str) -> tuple[DataFrame, bool]:
    """(file, split, base, entry, open, open_end) of each split of the archives' files: where its first chunk begins in the
    file, the first record that begins in it, the last that began before it and where that ends (null where there is none),
    by way of the records that the file's start reaches; and whether any record may hold boundaries. Tasks have linked the
    candidates within a split; between splits, pointers are doubled until all that the start reaches is marked."""
    links = materialise(_chunks(spark, path).mapInArrow(_links, _LINKS), "links")
    before = "OVER (PARTITION BY file ORDER BY split ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    splits = links.where("total IS NOT NULL").select("file", "split", F.coalesce(F.expr(f"sum(total) {before}"), F.lit(0)).alias("base"))
    splits = materialise(splits, "splits")
    ways = links.where("at IS NOT NULL").join(splits, ["file", "split"]).select("file", "split", *[(F.col(c) + F.col("base")).alias(c) for c in ("at", "leaves", "last")])
    # only a file's start and what some way leads to can be an entry
    targets = ways.select("file", F.col("leaves").alias("at")).distinct()
    ways = materialise(ways.where("at > 0").join(targets, ["file", "at"], "left_semi").unionByName(ways.where("at = 0")), "ways")
    reached = ways.where("at = 0").select("file", "at")
    jumps = ways.join(ways.select("file", F.col("at").alias("leaves")), ["file", "leaves"], "left_semi").select("file", "at", "leaves")
    while not (jumps := materialise(jumps, "jumps")).isEmpty():
        ahead = reached.join(jumps, ["file", "at"]).select("file", F.col("leaves").alias("at"))
        reached = materialise(reached.unionByName(ahead).distinct(), "reached")
        further = jumps.select(F.col("file").alias("_file"), F.col("at").alias("_at"), F.col("leaves").alias("further"))
        jumps = jumps.join(further, (F.col("file") == F.col("_file")) & (F.col("leaves") == F.col("_at"))).select("file", "at", F.col("further").alias("leaves"))
    entries = ways.join(reached, ["file", "at"], "left_semi").groupBy("file", "split").agg(F.min("at").alias("entry"), F.max(F.struct("last", "leaves")).alias("last"))
    found = splits.join(entries, ["file", "split"], "left").withColumn("open", F.expr(f"max(last) {before}"))
    found = found.select("file", "split", "base", "entry", F.col("open.last").alias("open"), F.col("open.leaves").alias("open_end"))
    return materialise(found, "boundaries"), not links.where("cut").isEmpty()


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


_PIECES = "file string, at long, place long, whole boolean, piece binary"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of _PIECES: records from their magic on, whole ones and the chunks of those that hold boundaries."""
    now = None
    for file, split, chunk, (base, entry, opened, open_end) in _splits(batches, 4):
        if now != (file, split):
            now, places, due, record, end = (file, split), _Places(split), entry, opened, open_end
        at, body = places.next(chunk)
        at += base
        size = _length(body) if at == due else None
        if size is not None:
            record, due, end = at, at + size, at + size
            # the boundary that ended the chunk began with the record's closing blank lines
            yield file, at, at, MAGIC + len(body) + 4 >= size, b"WARC/1." + body
        elif record is not None and at < end:
            yield file, record, at, False, BOUNDARY.encode() + body


def _handed(rows: Iterator[tuple], schema: str, most: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    """Rows in batches of about so many bytes of their last column, or 4096 rows."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1] or b"")
        if size > most or len(held) == 4096:
            yield _batch(held, schema)
            held, size = [], 0
    yield _batch(held, schema)


_RECORD = "file string, offset long, record_type string, target_uri string, date string, record_id string, refers_to_id string, payload_digest string, page_id long, refers_to long, payload_bytes long, digest_holds boolean, payload binary"


def parse(record: bytes, payload: bool) -> tuple:
    """The columns of _RECORD after offset. A response's payload is what follows its HTTP header; a revisit's size is that
    which its HTTP header tells."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip().decode("utf-8", "replace") for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:])}
    block = rest[: int(fields[b"content-length"])]
    kind, body, size = fields.get(b"warc-type"), block, None
    if fields.get(b"content-type", "").startswith("application/http"):
        http, _, body = block.partition(b"\r\n\r\n")
        told = [x.partition(b":")[2].strip() for x in http.split(b"\r\n") if x[:15].lower() == b"content-length:"]
        size = int(told[0]) if told and told[0].isdigit() else None
    told, holds = fields.get(b"warc-payload-digest", "").rpartition(":")[2] or None, None
    if kind != "revisit":
        size, digest = len(body), base64.b32encode(hashlib.sha1(body).digest()).decode()
        holds, told = (None if told is None else told == digest), digest
    number = lambda k: int(fields[k]) if fields.get(k, "").lstrip("-").isdigit() else None
    return kind, fields.get(b"warc-target-uri"), fields.get(b"warc-date"), fields.get(b"warc-record-id"), fields.get(b"warc-refers-to"), told, number(b"x-page-id"), number(b"x-refers-to-page-id"), size, holds, body if payload and kind != "revisit" else None


def read(spark: SparkSession, path: str, payload: bool = True, most_sent: int = MOST_SENT) -> DataFrame:
    """The records of the uncompressed WARC files under path: file, offset, record_type, target_uri, date, record_id,
    refers_to_id, payload_digest (bare base 32 SHA-1), page_id, refers_to, payload_bytes, digest_holds, payload (null for
    revisits, and for all where payload is false).

    A response's digest and size are those of the bytes read; digest_holds says whether its header agrees. Only records that
    the chain from a file's start reaches count: boundaries in payloads, whole records among them, don't. A file that doesn't
    begin with a record gives none, and a chain that breaks ends there; its last record is given with the bytes that are
    left. No file is read by one task: a split is, and so is a record; one that holds boundaries is put together from its
    chunks. How splits join their places is the size's matter only: up to most_sent bytes of these go to every task.
    """
    known, cut = boundaries(spark, path)
    size = known.agg(F.coalesce(F.sum(F.octet_length("file") + 60), F.lit(0))).first()[0]
    chunks = _chunks(spark, path)
    if size <= most_sent:
        chunks = chunks.join(F.broadcast(known), ["file", "split"])
    else:
        numbered = chunks.withColumn("n", F.monotonically_increasing_id()).join(known.hint("merge"), ["file", "split"])
        chunks = numbered.repartition("file", "split").sortWithinPartitions("file", "split", "n")
    chunks = chunks.select("file", "split", "chunk", "base", "entry", "open", "open_end")
    whole = chunks.mapInArrow(lambda b: _handed(((f, a, *parse(p, payload)) for f, a, _, w, p in _pieces(b) if w), _RECORD), _RECORD)
    if not cut:
        return whole
    parts = chunks.mapInArrow(lambda b: _handed((x for x in _pieces(b) if not x[3]), _PIECES), _PIECES)
    parts = parts.groupBy("file", "at").agg(F.array_sort(F.collect_list(F.struct("place", "piece"))).alias("parts")).select("file", "at", F.col("parts.piece").alias("parts"))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for r in range(batch.num_rows):
                yield batch.column(0)[r].as_py(), batch.column(1)[r].as_py(), *parse(b"".join(batch.column(2)[r].as_py()), payload)

    return whole.unionByName(parts.mapInArrow(lambda b: _handed(joined(b), _RECORD), _RECORD))

"""WARC archives: writing captures, reading records, assembling transactions (operator 3).

Writing. Every capture becomes three records: ``request``, ``response`` (or
``revisit``) and ``metadata``. Request and metadata name their response in
WARC-Concurrent-To. Captures with equal payloads of at least ``revisit_from`` bytes share one
response, the one with the smallest key; the others revisit it. Rows that are equal in
everything are captures of their own, told apart by their position. Equal payloads meet
by SHA-256, folded within each map task first, and only the light columns of a
capture travel to its group.

Reading. An archive is cut into records by Spark's text reader, at the blank lines
and version line between records, so a file of any size streams through a task one
record at a time. A payload may contain such a separator itself. Its pieces are
then shorter than Content-Length says; files with such a piece are read again, and
pieces are joined until Content-Length is reached. Compressed files, which Spark does not split,
stream through that too, one record at a time; plain ones are parsed whole (up to 2 GB each).

Assembly. Records are joined to their response through the concurrent-to
identifiers, in either direction and over one record in between, and come out as
one nested row per capture. Revisits get the payload's size from the response that
they refer to.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import new_folder, saved

# Separators and names of the WARC 1.1 format, and RFC 4648's base32 alphabet.
END = "\r\n\r\n"
VERSION = "WARC/1."
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32_AS_CONV = "0123456789ABCDEFGHIJKLMNOPQRSTUV"  # the digits of Spark's conv()
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

RECORD = "file string, record_id string, kind string, concurrent_to array<string>, refers_to string, uri string, payload_digest string, block binary"


def base32(hex40: Column) -> Column:
    """Upper-case base32 of 20 bytes given as hex: every 5 hex digits are 4 letters."""
    parts = [F.lpad(F.conv(F.substring(hex40, at, 5), 16, 32), 4, "0") for at in range(1, 41, 5)]
    return F.translate(F.upper(F.concat(*parts)), BASE32_AS_CONV, BASE32)


def record_id(*parts: Column) -> Column:
    """A URN made from the parts: the same on every run."""
    h = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("~")) for p in parts]))
    cut = [F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def record(kind: str, own: Column, date: str, uri: Column, mime: str, block: Column, **headers: Column) -> Column:
    """The text of one record without the blank lines after it. Null headers are left out."""
    lines = [F.lit(f"WARC/1.1\r\nWARC-Type: {kind}"), F.concat(F.lit("WARC-Record-ID: "), own), F.lit(f"WARC-Date: {date}"),
             F.concat(F.lit("WARC-Target-URI: "), uri)]
    lines += [F.concat(F.lit(name.replace("_", "-") + ": "), value) for name, value in headers.items()]
    lines += [F.lit(f"Content-Type: {mime}"), F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(END), block)


def plan_captures(pages: DataFrame, key: str, uri: str, payload: str, revisit_from: int) -> tuple[DataFrame, DataFrame]:
    """The light captures, one for each row (key, uri, digest, size, ids), and the payload of each digest."""
    rows = pages.select(
        pages[key].alias("key"),
        F.regexp_replace(F.coalesce(pages[uri], F.lit("about:blank")), r"[\x00-\x20\x7f]", "%20").alias("uri"),
        F.coalesce(pages[payload], F.lit("")).alias("payload"),
    ).withColumn("digest", F.unhex(F.sha2("payload", 256)))
    size = F.octet_length("payload").cast("long")
    light = rows.select("key", "uri", "digest", F.unhex(F.sha1("payload")).alias("sha1"), size.alias("size"), F.monotonically_increasing_id().alias("at"))
    captures = saved(light, "warc-captures")  # from here on the positions are fixed
    # a table of its own, so that a join with a digest of very many captures can be split
    firsts = saved(captures.groupBy("digest").agg(F.min(F.struct("key", "uri", "at")).alias("first")), "warc-firsts")
    captures = captures.join(firsts, "digest").withColumns(
        {"revisit": (F.col("size") >= revisit_from) & (F.col("at") != F.col("first.at")),
         "own_id": record_id(F.col("key"), F.col("uri"), F.hex("digest"), F.col("at")),
         "first_id": record_id(F.col("first.key"), F.col("first.uri"), F.hex("digest"), F.col("first.at"))}
    )
    bodies = rows.groupBy("digest").agg(F.any_value("payload").alias("payload"))
    return captures, bodies


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", uri: str = "url", payload: str = "html",
                   revisit_from: int = 0, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write the captures of ``pages`` as compressed WARC files into ``folder``.

    Null payloads are empty. Null keys sort first, so they count as the smallest; of rows
    that repeat the smallest key the smallest address is the response, then the first position.
    Keys are written percent-encoded, and not at all if null.
    Blanks and control characters of an address are written as %20, a null
    address as about:blank. An empty table writes archives without records.
    """
    captures, bodies = plan_captures(pages, key, uri, payload, revisit_from)
    sha1 = F.concat(F.lit("sha1:"), base32(F.hex("sha1")))
    http = lambda body: F.concat(F.lit(f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8{END}"), body)
    own, at = F.col("own_id"), F.col("uri")
    request = record(
        "request", record_id(own, F.lit("request")), date, at, "application/http; msgtype=request",
        F.concat(F.lit("GET "), at, F.lit(f" HTTP/1.1{END}")), WARC_Concurrent_To=own,
    )
    fields = F.coalesce(F.concat(F.lit("capture-key: "), F.url_encode(F.col("key").cast("string")), F.lit("\r\n")), F.lit("\r\n"))
    metadata = record(
        "metadata", record_id(own, F.lit("metadata")), date, at, "application/warc-fields", fields, WARC_Concurrent_To=own,
    )
    response = record("response", own, date, at, "application/http; msgtype=response", http(F.col("payload")), WARC_Payload_Digest=sha1)
    revisit = record(
        "revisit", own, date, at, "application/http; msgtype=response", http(F.lit("")),
        WARC_Payload_Digest=sha1, WARC_Refers_To=F.col("first_id"), WARC_Profile=F.lit(PROFILE),
    )
    full = captures.where(~F.col("revisit")).join(bodies, "digest").select(F.explode(F.array(request, response, metadata)).alias("value"))
    short = captures.where("revisit").select(F.explode(F.array(request, revisit, metadata)).alias("value"))
    full.unionByName(short).write.option("lineSep", END).option("compression", "gzip").text(folder)


def content_length(head: bytes) -> int:
    said = (line.split(b":", 1)[1].strip() for line in head.split(b"\r\n") if line.lower().startswith(b"content-length:"))
    return next((int(n) for n in said if n.isdigit()), 0)


def parse(data: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(headers, block) of each record, by Content-Length alone."""
    at = 0
    while (start := data.find(VERSION.encode(), at)) >= 0:
        stop = data.find(END.encode(), start)
        if stop < 0:
            return
        head = data[start:stop]
        at = stop + 4 + content_length(head)
        yield head, data[stop + 4 : at]


def reread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for file, content in zip(batch["path"], batch["content"]):
            for head, block in parse(content):
                yield pd.DataFrame([(file, head.decode("utf-8", "replace"), block)], columns=["file", "head", "block"])


def rejoined(pieces: Iterator[tuple[str, bytes]]) -> Iterator[tuple[str, bytes, bytes]]:
    """(file, headers, block) of each record, from the pieces of whole files in their order.

    A piece that ends before its headers or its Content-Length goes on in the file's next piece; what
    the end of a file cuts off is yielded as far as it goes.
    """
    file, held, head, end = "", bytearray(), b"", 0

    def cut() -> tuple[str, bytes, bytes]:
        return file, head, bytes(held[len(head) + 4 : end])

    for at, piece in pieces:
        if held and at != file:
            if end:
                yield cut()
            held, end = bytearray(), 0
        file = at
        if held:
            held += f"\n{VERSION}".encode()
        elif not piece.strip():
            continue
        held += piece
        if not end and (stop := held.find(END.encode())) >= 0:
            head = bytes(held[:stop])
            end = stop + 4 + content_length(head)
        if end and len(held) >= end:
            yield cut()
            held, end = bytearray(), 0
    if held and end:
        yield cut()


def rejoin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    pieces = (row for batch in batches for row in zip(batch["file"], batch["value"]))
    for file, head, block in rejoined(pieces):
        yield pd.DataFrame([(file, head.decode("utf-8", "replace"), block)], columns=["file", "head", "block"])


def header(name: str) -> Column:
    found = F.regexp_extract("head", rf"(?im)^{name}:[ \t]*([^\r\n]*?)[ \t]*$", 1)
    return F.nullif(found, F.lit(""))


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record of the WARC files in ``folder``: see ``RECORD``.

    Files may be plain or gzip (by their ending .gz), with one or many members.
    A record without Content-Length is taken to have an empty block.
    """
    # the separator begins with the last byte before a version line, because readers of
    # separators that begin like what precedes them lose some at the ends of their buffers
    cut = lambda *paths: spark.read.option("lineSep", f"\n{VERSION}").text(list(paths)).select("value", F.col("_metadata.file_path").alias("file"))
    lines = cut(folder)
    lines = lines.where(F.col("value").rlike(r"\S")).withColumn("head", F.substring_index("value", END, 1))
    data, skipped = F.col("value").cast("binary"), F.octet_length("head") + 4
    said = F.coalesce(header("Content-Length").cast("int"), F.lit(0))
    pieces = lines.withColumn("said", said).withColumn("extra", F.octet_length("value") - skipped - said)
    inner, last = (F.col("extra") == 3) & F.col("value").endswith(END[:3]), (F.col("extra") == 4) & F.col("value").endswith(END)
    pieces = pieces.select("file", "head", (inner | last).alias("whole"), data.substr(skipped + 1, F.col("said")).alias("block"))
    broken = saved(pieces.where(~F.col("whole")).select("file").distinct(), "warc-broken")
    pieces = pieces.select("file", "head", "block")
    if not broken.isEmpty():
        pieces = pieces.join(broken, "file", "left_anti")
        packed = [r["file"] for r in broken.where(F.col("file").endswith(".gz")).collect()]  # names of files, which the driver lists anyway
        if packed:
            again = cut(*packed).select("file", F.col("value").cast("binary").alias("value"))
            pieces = pieces.unionByName(again.mapInPandas(rejoin, "file string, head string, block binary"))
        plain = broken.where(~F.col("file").endswith(".gz"))
        if not plain.isEmpty():
            files = spark.read.format("binaryFile").load(folder).select("path", "content").join(plain, F.col("path") == F.col("file"), "left_semi")
            pieces = pieces.unionByName(files.repartition("path").mapInPandas(reread, "file string, head string, block binary"))
    ids = lambda name: F.regexp_extract_all("head", F.lit(rf"(?im)^{name}:[ \t]*(<[^>\r\n]*>)"), 1)
    return pieces.select(
        "file",
        header("WARC-Record-ID").alias("record_id"),
        F.lower(header("WARC-Type")).alias("kind"),
        ids("WARC-Concurrent-To").alias("concurrent_to"),
        header("WARC-Refers-To").alias("refers_to"),
        header("WARC-Target-URI").alias("uri"),
        header("WARC-Payload-Digest").alias("payload_digest"),
        "block",
    )


def payload_of(block: Column) -> Column:
    """What follows the header of an HTTP message, as bytes; all of it if it has no header."""
    text = block.cast("string")
    skipped = F.octet_length(F.substring_index(text, END, 1))
    return F.when(skipped < F.octet_length(block), block.substr(skipped + 5, F.octet_length(block))).otherwise(block)


def assemble(records: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per capture: record_id, kind, uri, payload, payload_sha1, payload_digest, payload_bytes, refers_to, requests, metadata.

    ``requests`` and ``metadata`` are arrays of (record_id, block), sorted by
    identifier, of the records that belong to the capture; empty if there are none.
    A record belongs to a capture if either names the other in concurrent-to, or
    both name the same third record in between. Records that no capture claims,
    and records without an identifier, belong to none. A revisit has no
    payload; its ``payload_bytes`` are those of the response it refers to, null if
    that is not in the archives. ``payload_sha1`` (hex) is of the payload read,
    ``payload_digest`` what the record says. Without ``payloads`` that column is left
    out, and the archives are read once less.
    """
    known = records.where(F.col("record_id").isNotNull())
    known = known.withColumn("payload", F.when(F.col("kind") == "response", payload_of(F.col("block"))))
    # before the joins, so that a reader of these columns alone does not shuffle payloads
    known = known.withColumns({"payload_sha1": F.sha1("payload"), "own_bytes": F.octet_length("payload").cast("long")})
    known = known.withColumn("block", F.when(F.col("kind").isin("request", "metadata"), F.col("block")))
    index = saved(known.drop("file", "payload"), "warc-index")  # all but the payloads
    anchors = index.where(F.col("kind").isin("response", "revisit"))
    up = index.where(F.col("kind").isin("request", "metadata")).select("record_id", F.explode("concurrent_to").alias("other"))
    down = anchors.select(F.col("record_id").alias("capture"), F.explode("concurrent_to").alias("record_id"))
    direct = up.join(anchors.select(F.col("record_id").alias("capture")), F.col("other") == F.col("capture")).select("record_id", "capture")
    direct = saved(direct.unionByName(down.select("record_id", "capture")), "warc-links")
    over = up.join(direct.withColumnRenamed("record_id", "middle"), F.col("other") == F.col("middle")).select("record_id", "capture")
    links = direct.unionByName(over).distinct()
    main = (known if payloads else index).where(F.col("kind").isin("response", "revisit")).drop("block")
    side = index.where(F.col("kind").isin("request", "metadata"))
    owned = side.select("record_id", "kind", "block").join(links, "record_id")
    part = lambda kind: F.array_sort(F.collect_set(F.when(F.col("kind") == kind, F.struct("record_id", "block"))))
    parts = owned.groupBy("capture").agg(part("request").alias("requests"), part("metadata").alias("metadata"))
    targets = index.where("kind = 'response'").select(F.col("record_id").alias("target"), F.col("own_bytes").alias("target_bytes"))
    nested = main.join(parts, main.record_id == parts.capture, "left").join(targets, F.col("refers_to") == F.col("target"), "left")
    none = F.array().cast("array<struct<record_id:string,block:binary>>")
    return nested.select(
        "record_id", "kind", "uri", *["payload"] * payloads, "payload_sha1", "payload_digest",
        F.when(F.col("kind") == "response", F.col("own_bytes")).otherwise(F.col("target_bytes")).alias("payload_bytes"),
        "refers_to", F.coalesce("requests", none).alias("requests"), F.coalesce("metadata", none).alias("metadata"),
    )


def field(name: str) -> Column:
    """A percent-encoded field of the capture's first metadata record; null if it is not there."""
    text = F.get(F.col("metadata"), 0).getField("block").cast("string")
    line = rf"(?im)^{name}:[ \t]*([^\r\n]*)"
    return F.when(text.rlike(line), F.url_decode(F.regexp_extract(text, line, 1)))


def round_trip(pages: DataFrame, key: str = "page_id", uri: str = "url", payload: str = "html", revisit_from: int = 0) -> DataFrame:
    """Write ``pages`` as archives, read them back, and describe every page by what was read.

    page key, payload_bytes, payload_digest, record_type, refers_to (a page key). One row
    for each row of ``pages``: of rows that repeat, all but the first revisit it.
    """
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    write_archives(pages, folder, key, uri, payload, revisit_from)
    captures = assemble(read_archives(spark, folder), payloads=False)
    sha1 = F.when(F.col("kind") == "response", base32(F.upper("payload_sha1"))).otherwise(F.regexp_replace("payload_digest", "^sha1:", ""))
    kind = pages.schema[key].dataType
    rows = saved(captures.select(
        "record_id", "refers_to", "payload_bytes", "kind", sha1.alias("payload_digest"), field("capture-key").cast(kind).alias("page"),
    ), "warc-read")
    firsts = rows.where("kind = 'response'").select(F.col("record_id").alias("refers_to"), F.col("page").alias("first_page"))
    return rows.join(firsts, "refers_to", "left").select(
        F.col("page").alias(key), "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), F.col("first_page").alias("refers_to")
    )

import base64
import gzip
import hashlib
import uuid

from tidemark.llm.warc import assemble, read_archives, rejoined, round_trip, write_archives

SCHEMA = "page_id long, url string, html string, payload string, kind int"
TRAP = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc"
ROWS = [
    (4, "http://a/ b\r\nc", "same ä", "p", 1), (2, "http://b", "same ä", "p", 1), (9, None, "same ä", "q", 2),
    (5, "http://c", None, None, 3), (6, "http://d", "", None, 3), (7, "http://e", TRAP, None, 3), (8, "http://f", TRAP, None, 3),
    (10, "http://g", "\r\n\r\n", None, 3), (11, "http://h", "long é\n" * 100000, None, 3), (12, "http://i", "tail\r\n\r\nWARC/1.", None, 3),
    (13, "http://j", "one", None, 3), (13, "http://j", "one", None, 3),
]


def expected(rows, least=0):
    out = []
    for at, (key, uri, html, *_) in enumerate(rows):
        body = (html or "").encode()
        first, _, position = min((k, u or "about:blank", n) for n, (k, u, h, *_) in enumerate(rows) if (h or "").encode() == body)
        again = at != position and len(body) >= least
        sha1 = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((key, len(body), sha1, "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


def test_round_trip(spark):
    pages = spark.createDataFrame(ROWS, SCHEMA)
    for least in (0, 5):
        assert sorted((tuple(r) for r in round_trip(pages, revisit_from=least).collect()), key=str) == sorted(expected(ROWS, least), key=str)


def test_null_keys_and_empty_table(spark):
    rows = [(None, "u", "a", "", 1), (3, "u", "a", "", 1)]
    got = {r.page_id: (r.record_type, r.refers_to) for r in round_trip(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {None: ("response", None), 3: ("revisit", None)}
    assert round_trip(spark.createDataFrame([], SCHEMA)).collect() == []


def test_nested_captures(spark, folder):
    write_archives(spark.createDataFrame(ROWS[:3], SCHEMA), folder + "/out")
    rows = {r.uri: r for r in assemble(read_archives(spark, folder + "/out")).collect()}
    assert set(rows) == {"http://a/%20b%20%20c", "http://b", "about:blank"}
    first = rows["http://b"]
    assert first.kind == "response" and bytes(first.payload).decode() == "same ä"
    assert bytes(first.requests[0].block).startswith(b"GET http://b HTTP/1.1\r\n")
    assert b"capture-key: 2" in bytes(first.metadata[0].block)
    other = rows["about:blank"]
    assert (other.kind, other.refers_to, other.payload_bytes) == ("revisit", first.record_id, 7)


def foreign(kind, block, own, *others):
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: {own}", f"Content-Length: {len(block)}"]
    head += [f"WARC-Concurrent-To: {o}" for o in others]
    return b"WARC/1.0\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_archives_of_others(spark, tmp_path):
    """Members per record, binary payloads, links in either direction and over a record in between."""
    a, b, c, d, e = (f"<urn:uuid:{uuid.uuid4()}>" for _ in range(5))
    binary = bytes(range(256)) + TRAP.encode()
    records = [
        foreign("warcinfo", b"software: x\r\n", f"<urn:uuid:{uuid.uuid4()}>"),
        foreign("response", b"HTTP/1.1 200 OK\r\n\r\n" + binary, a, b),
        foreign("request", b"GET / HTTP/1.1\r\n\r\n", b),
        foreign("metadata", b"x: 1\r\n", c, b),
        foreign("metadata", b"y: 1\r\n", d, f"<urn:uuid:{uuid.uuid4()}>"),
        foreign("response", b"no header", e),
    ]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records))
    rows = {r.record_id: r for r in assemble(read_archives(spark, str(tmp_path / "in"))).collect()}
    assert set(rows) == {a, e}
    assert [r.record_id for r in rows[a].requests] == [b] and [r.record_id for r in rows[a].metadata] == [c]
    assert bytes(rows[a].payload) == binary and bytes(rows[e].payload) == b"no header"
    assert rows[e].requests == [] and rows[e].metadata == []


def test_a_record_for_every_row(spark, folder):
    """Equal rows are captures of their own: one response, the others revisit it."""
    rows = [(1, "http://a", "same", None, 1)] * 5 + [(1, "http://b", "same", None, 1)]
    pages = spark.createDataFrame(rows, SCHEMA).repartition(3)
    write_archives(pages, folder + "/five")
    kinds = {r["kind"]: r["count"] for r in read_archives(spark, folder + "/five").groupBy("kind").count().collect()}
    assert kinds == {"request": 6, "metadata": 6, "response": 1, "revisit": 5}
    got = [(r.page_id, r.record_type, r.refers_to) for r in round_trip(pages).collect()]
    assert sorted(got, key=str) == [(1, "response", None)] + [(1, "revisit", 1)] * 5
    assert {r.record_type for r in round_trip(pages, revisit_from=5).collect()} == {"response"}


def test_text_keys(spark):
    keys = [" a", "b\r\nc", "", None, "+%41 ä", "capture-key: x", "-" * 300]
    pages = spark.createDataFrame([(k, "u", f"body {k!r}") for k in keys], "page_id string, url string, html string")
    assert {r.page_id for r in round_trip(pages).collect()} == set(keys)


def raw(block: bytes) -> bytes:
    return b"1\r\nContent-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"


def test_pieces_are_rejoined():
    border = b"\nWARC/1."
    blocks = [b"a", b"x" + border + border + b"y" + border, b"", border, b"tail" + border + b"1\r\nContent-Length: 1\r\n\r\n"]
    data = b"WARC/1." + border.join(raw(b) for b in blocks)
    pieces = [("f", p) for p in data.split(border)] + [("g", b"WARC/1.1\r\nContent-Length: 9\r\n\r\ncut"), ("h", b"\r\n"), ("h", b"1\r\n\r\n")]
    got = list(rejoined(iter(pieces)))
    assert [(f, b) for f, _, b in got] == [("f", b) for b in blocks] + [("g", b"cut"), ("h", b"")]


def test_plain_archives(spark, tmp_path):
    """Files that are not compressed, with a payload that holds a border and one that does not."""
    for name, body in (("a.warc", TRAP), ("b.warc", "plain")):
        (tmp_path / "in").mkdir(exist_ok=True)
        head = b"HTTP/1.1 200 OK\r\n\r\n"
        (tmp_path / "in" / name).write_bytes(foreign("response", head + body.encode(), f"<urn:{name}>") + foreign("response", head, f"<urn:{name}2>"))
    rows = {r.record_id: bytes(r.payload).decode() for r in assemble(read_archives(spark, str(tmp_path / "in"))).collect()}
    assert rows == {"<urn:a.warc>": TRAP, "<urn:a.warc2>": "", "<urn:b.warc>": "plain", "<urn:b.warc2>": ""}

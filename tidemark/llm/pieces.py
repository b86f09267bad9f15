"""SentencePiece encoding and decoding, giant documents by a max-plus scan over chunks (operator 6).

The model at hand merges pairs by rank (BPE). Its encodings are shortest paths all
the same: a cut into pieces is the model's if and only if every two neighbours stay
as they are when encoded together. So the lattice has a node for every piece and
place, weight 0 between neighbours that stay and minus infinity between others, and
exactly one path of weight 0.

* Texts of up to ``chunk_chars`` code points are encoded whole, by the library.
* Longer ones are cut anywhere; chunks of those beyond ``spread_chars`` are dealt to many tasks. The state at a cut is the piece that ends there or
  reaches over it. Every chunk yields its transfer matrix from the states at its
  first to those at its last cut, knowing nothing of the others.
* The matrices of a document are multiplied in the max-plus semiring, which is
  associative: neighbours first, then their products, up a tree. The states that a path
  of weight 0 passes go down the same tree, from the ends of a product to its middle.
* With its two states every chunk is traced back on its own.

Between the first and the last beginning of a word in a chunk no piece reaches
over, so that part is left to the library and needs no states.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lean, saved

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"  # fixed value: how the library writes a space
FAN = 16  # neighbours whose matrices a task multiplies at once

State = tuple[int, str]  # code points beyond the cut, piece
Matrix = dict[tuple[State, State], float]  # what is missing is minus infinity
START: State = (0, "")


class Pieces:
    """The model's pieces, and the lattice over them."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        special = (self.model.is_byte, self.model.is_control, self.model.is_unknown, self.model.is_unused)
        plain = [k for k in range(self.model.get_piece_size()) if not any(f(k) for f in special)]
        self.ids = {self.model.id_to_piece(k): k for k in plain}
        self.scores = {self.model.id_to_piece(k): self.model.get_score(k) for k in plain}
        self.longest = max(map(len, self.ids))
        self.known: dict[tuple[str, str], bool] = {}

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text by the merges: best pair first, of equals the left one."""
        parts = list(text)
        while True:
            scored = [(self.scores[a + b], -k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.scores]
            if not scored:
                return parts
            k = -max(scored)[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]

    def stay(self, left: str, right: str) -> bool:
        """Whether two neighbours stay as they are; an empty left one is the beginning."""
        found = self.known.get((left, right))
        if found is None:
            if len(self.known) > 100_000:
                self.known.clear()
            found = self.known[left, right] = self.merged(left + right) == ([left, right] if left else [right])
        return found

    def at(self, text: str, place: int) -> list[str]:
        """The pieces that may begin at a place; a character without piece is one of its own."""
        ends = range(place + 1, min(len(text), place + self.longest) + 1)
        return [p for e in ends if (p := text[place:e]) in self.ids or e == place + 1]

    def walk(self, text: str, entries: list[State], begin: int, stop: int):
        """Which entries reach which nodes (place -> piece -> bits of entries), and the node before each."""
        nodes: dict[int, dict[str, int]] = {}
        before: dict[tuple[int, str], tuple[int, str]] = {}
        for k, (over, piece) in enumerate(entries):
            nodes.setdefault(begin + over, {}).setdefault(piece, 0)
            nodes[begin + over][piece] |= 1 << k
        for place in range(begin, stop):
            here = nodes.pop(place, None) if place > begin + self.longest else nodes.get(place)
            if not here:
                continue
            for piece in self.at(text, place):
                for last, bits in here.items():
                    if self.stay(last, piece):
                        there = nodes.setdefault(place + len(piece), {})
                        there[piece] = there.get(piece, 0) | bits
                        before.setdefault((place + len(piece), piece), (place, last))
        return nodes, before

    def entries(self, text: str, cut: int) -> list[State]:
        """All states that a cut can have: pieces that begin before it and end at it or beyond."""
        if cut == 0:
            return [START]
        found = [(start + len(p) - cut, p) for start in range(max(0, cut - self.longest), cut) for p in self.at(text, start)]
        return [(over, p) for over, p in found if over >= 0]

    def resets(self, text: str, begin: int, stop: int) -> tuple[int, int] | None:
        """The first and last beginning of a word well inside; every path has a node there."""
        inside = next((k for k in range(begin + self.longest, stop) if text[k] == SPACE and text[k - 1] != SPACE), None)
        if inside is None:
            return None
        last = next(k for k in range(stop - 1, inside - 1, -1) if text[k] == SPACE and text[k - 1] != SPACE)
        return inside, last

    def transfer(self, text: str, begin: int, stop: int) -> Matrix:
        """The transfer matrix of text[begin:stop]; ``text`` shows some of what surrounds it."""
        entries = self.entries(text, begin)
        cuts = self.resets(text, begin, stop)
        if cuts is None:
            nodes, _ = self.walk(text, entries, begin, stop)
            return {(entries[k], out): 0.0 for out, bits in self.exits(nodes, text, stop).items() for k in range(len(entries)) if bits >> k & 1}
        nodes, _ = self.walk(text, entries, begin, cuts[0])
        alive = 0
        for bits in nodes.get(cuts[0], {}).values():
            alive |= bits
        nodes, _ = self.walk(text, [START], cuts[1], stop)
        return {(entries[k], out): 0.0 for out in self.exits(nodes, text, stop) for k in range(len(entries)) if alive >> k & 1}

    def exits(self, nodes: dict[int, dict[str, int]], text: str, stop: int) -> dict[State, int]:
        """The states at the end; pieces that the text's end cuts short are none."""
        return {(place - stop, piece): bits for place in range(stop, min(len(text), stop + self.longest) + 1) for piece, bits in nodes.get(place, {}).items()}

    def trace(self, text: str, begin: int, stop: int, first: State, last: State) -> list[str]:
        """The pieces of one stretch between two states, traced back from the last."""
        _, before = self.walk(text, [first], begin, stop)
        return self.back(before, begin, stop, first, last)

    def back(self, before: dict[tuple[int, str], tuple[int, str]], begin: int, stop: int, first: State, last: State) -> list[str]:
        node, out = (stop + last[0], last[1]), []
        while node != (begin + first[0], first[1]):
            out.append(node[1])
            node = before[node]
        return out[::-1]

    def number(self, piece: str) -> list[int]:
        known = self.ids.get(piece)
        return [known] if known is not None else [self.model.piece_to_id(f"<0x{b:02X}>") for b in piece.encode()]

    def encode_chunk(self, text: str, begin: int, stop: int, first: State, last: State) -> list[int]:
        """The ids of the pieces after ``first`` up to ``last``."""
        cuts = self.resets(text, begin, stop)
        if cuts is None:
            return [n for p in self.trace(text, begin, stop, first, last) for n in self.number(p)]
        nodes, before = self.walk(text, [first], begin, cuts[0])
        ends = [(0, p) for p in nodes.get(cuts[0], {})]
        head = self.back(before, begin, cuts[0], first, ends[0])
        tail = self.trace(text, cuts[1], stop, START, last)
        body = self.model.encode(text[cuts[0] + 1 : cuts[1]].replace(SPACE, " ")) if cuts[1] > cuts[0] else []
        return [*(n for p in head for n in self.number(p)), *body, *(n for p in tail for n in self.number(p))]


@lru_cache(maxsize=2)
def pieces_of(path: str) -> Pieces:
    return Pieces(path)


def product(a: Matrix, b: Matrix) -> Matrix:
    """The max-plus product."""
    by_row: dict[State, list[tuple[State, float]]] = {}
    for (row, column), weight in b.items():
        by_row.setdefault(row, []).append((column, weight))
    out: Matrix = {}
    for (row, middle), weight in a.items():
        for column, more in by_row.get(middle, []):
            out[row, column] = max(out.get((row, column), -np.inf), weight + more)
    return out


def levels_of(matrices: list[Matrix]) -> list[list[Matrix]]:
    """The matrices, the products of neighbours, the products of these, up to that of all."""
    levels = [matrices]
    while len(levels[-1]) > 1:
        own = levels[-1]
        levels.append([product(*own[k : k + 2]) if k + 1 < len(own) else own[k] for k in range(0, len(own), 2)])
    return levels


def states(matrices: list[Matrix], first: State = START, last: State | None = None) -> list[State]:
    """The state at every cut on the best path from ``first`` to ``last``, by default the best end of a text.

    Products go up a tree of neighbours; the states at the ends of each product then
    give, on the way down, the state in its middle.
    """
    levels = levels_of(matrices)
    if last is None:
        last = max(((w, s) for (f, s), w in levels[-1][0].items() if f == first and s[0] == 0), key=lambda x: x[0])[1]
    passed = [first, last]
    for own in levels[-2::-1]:
        finer = passed[:1]
        for k in range(0, len(own), 2):
            end = passed[k // 2 + 1]
            if k + 1 < len(own):
                finer.append(middle(own[k], own[k + 1], finer[-1], end))
            finer.append(end)
        passed = finer
    return passed


def middle(a: Matrix, b: Matrix, first: State, last: State) -> State:
    """The state between two stretches on the best path through both."""
    return max(((w + b[s, last], s) for (f, s), w in a.items() if f == first and (s, last) in b), key=lambda x: x[0])[1]


def written(matrix: Matrix) -> str:
    return json.dumps([[*a, *b, w] for (a, b), w in matrix.items()])


def read(text: str) -> Matrix:
    return {((a, p), (b, q)): w for a, p, b, q, w in json.loads(text)}


ENCODED = "chunk int, n_chunks int, source string, ids array<int>"


def ids_column(rows: list[list[int]]) -> pa.Array:
    return pa.array(rows, pa.list_(pa.int32()))


def signature(text: str, at: int) -> int:
    """The exclusive or of a hash of every code point and its place; those of parts add up to that of the whole."""
    found = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    found += np.arange(at + 1, at + 1 + len(found), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        found = (found ^ (found >> np.uint64(shift))) * np.uint64(factor)
    return int(np.bitwise_xor.reduce(found ^ (found >> np.uint64(31)), initial=np.uint64(0)).astype(np.int64))


def encode(df: DataFrame, text: str = "text", key: str = "doc_id", path: str = MODEL, chunk_chars: int = 4_096, spread_chars: int = 65_536) -> DataFrame:
    """One row per row of ``df`` and chunk: row, key, chunk, n_chunks, source, ids.

    ``row`` tells rows apart that have the same key; it is null for those of one
    chunk. ``source`` is the text that the chunk's ids stand for; sources of a row
    follow each other without gap or overlap, and its ids are those of the library
    for the whole text. Null and empty texts have one chunk without ids. Null keys
    are keys like others. Other columns are not looked at. ``path`` is the model's file on every machine.
    """
    short, long = encode_parts(df, text, key, path, chunk_chars, spread_chars)
    return short.unionByName(long.select(short.columns))


def encode_parts(df: DataFrame, text: str = "text", key: str = "doc_id", path: str = MODEL, chunk_chars: int = 4_096, spread_chars: int = 65_536) -> tuple[DataFrame, DataFrame]:
    """``encode``, rows of one chunk and rows of several apart: for readers that treat them differently.

    The latter have more columns: the chunk's place ``at`` in its text, and the
    text's length ``n_chars`` and ``signature``.
    """
    if chunk_chars < 256:
        raise ValueError("chunk_chars must be at least 256")
    rows = df.select(df[key].alias("key"), df[text].alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    long = F.coalesce(F.length("text") > chunk_chars, F.lit(False))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces_of(path).model
        for batch in batches:
            for at in range(0, batch.num_rows, 256):  # ids of few rows at a time: lists of Python numbers are large
                part = batch.slice(at, 256)
                texts = part.column("text").fill_null("")
                ids = [np.array(model.encode(t.as_py()), np.int32) for t in texts]
                n = part.num_rows
                columns = [pa.nulls(n, pa.int64()), part.column("key"), pa.array(np.zeros(n, np.int32)), pa.array(np.ones(n, np.int32)), texts, ids_column(ids)]
                yield pa.RecordBatch.from_arrays(columns, ["row", "key", "chunk", "n_chunks", "source", "ids"])

    short = rows.where(~long).mapInArrow(lean(whole), f"row long, key {kind}, {ENCODED}")
    giant = F.length("text") > max(spread_chars, chunk_chars)
    near = encode_near(rows.where(long & ~giant), kind, path, chunk_chars)
    several = near.unionByName(encode_long(rows.where(F.coalesce(giant, F.lit(False))), kind, path, chunk_chars))
    return short.withColumnRenamed("key", key), several.withColumnRenamed("key", key)


LONG = f"{ENCODED}, at long, n_chars long, signature long"


def borders(length: int, chunk_chars: int) -> list[int]:
    """Where a text is cut: into chunks of equal length, not longer than ``chunk_chars``."""
    n = -(-length // chunk_chars)
    return [k * length // n for k in range(n + 1)]


def encode_near(rows: DataFrame, kind: str, path: str, chunk_chars: int) -> DataFrame:
    """Texts longer than ``chunk_chars``, by the scan, all chunks of a text in one task."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(path)
        for batch in batches:
            for row, key, t in zip(batch.column("row"), batch.column("key"), batch.column("text")):
                body = t.as_py()
                text = SPACE + body.replace(" ", SPACE)
                cuts = borders(len(text), chunk_chars)
                passed = states([pieces.transfer(text, a, b) for a, b in zip(cuts, cuts[1:])])
                n = len(cuts) - 1
                ids = [np.array(pieces.encode_chunk(text, cuts[k], cuts[k + 1], passed[k], passed[k + 1]), np.int32) for k in range(n)]
                ends = [max(0, cut + over - 1) for cut, (over, _) in zip(cuts, passed)]
                sources = [body[a:b].replace(SPACE, " ") for a, b in zip(ends, ends[1:])]
                same = [pa.array([x] * n, kind) for x, kind in ((row.as_py(), pa.int64()), (key.as_py(), batch.column("key").type))]
                columns = [*same, pa.array(range(n), pa.int32()), pa.array([n] * n, pa.int32()), pa.array(sources, pa.string()), ids_column(ids)]
                columns += [pa.array(x, pa.int64()) for x in (ends[:-1], [len(body)] * n, [signature(body, 0)] * n)]
                yield pa.RecordBatch.from_arrays(columns, ["row", "key", "chunk", "n_chunks", "source", "ids", "at", "n_chars", "signature"])

    numbered = rows.withColumn("row", 2 * F.monotonically_increasing_id())  # even; those of ``encode_long`` are odd
    return numbered.mapInArrow(lean(scan), f"row long, key {kind}, {LONG}")


def encode_long(rows: DataFrame, kind: str, path: str, chunk_chars: int) -> DataFrame:
    """Texts longer than ``chunk_chars``, by the scan, chunks dealt to many tasks."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        around = pieces_of(path).longest
        for batch in batches:
            for row, key, t in zip(batch.column("row"), batch.column("key"), batch.column("text")):
                body = t.as_py()
                text, sign = SPACE + body.replace(" ", SPACE), signature(body, 0)
                cuts = borders(len(text), chunk_chars)
                n = len(cuts) - 1
                for k, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
                    left = max(0, lo - around)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row.as_py()], pa.int64()), pa.array([key.as_py()], batch.column("key").type), pa.array([k], pa.int32()),
                         pa.array([n], pa.int32()), pa.array([text[left : hi + around]]), pa.array([lo - left], pa.int32()), pa.array([hi - left], pa.int32()),
                         pa.array([left], pa.int64()), pa.array([len(body)], pa.int64()), pa.array([sign], pa.int64())],
                        ["row", "key", "chunk", "n_chunks", "text", "lo", "hi", "left", "n_chars", "signature"],
                    )

    def transfer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(path)
        for batch in batches:
            found = [written(pieces.transfer(t, a, b)) for t, a, b in zip(*(batch.column(c).to_pylist() for c in ("text", "lo", "hi")))]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("chunk"), pa.array(found, pa.string())], ["row", "chunk", "matrix"])

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(path)
        for batch in batches:
            ids, sources, places = [], [], []
            for r in batch.to_pylist():
                ids.append(pieces.encode_chunk(r["text"], r["lo"], r["hi"], (r["over_in"], r["piece_in"]), (r["over_out"], r["piece_out"])))
                source = r["text"][r["lo"] + r["over_in"] : r["hi"] + r["over_out"]].replace(SPACE, " ")
                sources.append(source if r["chunk"] else source[1:])  # without the space that the library puts first
                places.append(max(0, r["left"] + r["lo"] + r["over_in"] - 1))
            columns = [*(batch.column(c) for c in ("row", "key", "chunk", "n_chunks")), pa.array(sources, pa.string()), ids_column(ids)]
            columns += [pa.array(places, pa.int64()), batch.column("n_chars"), batch.column("signature")]
            yield pa.RecordBatch.from_arrays(columns, ["row", "key", "chunk", "n_chunks", "source", "ids", "at", "n_chars", "signature"])

    numbered = rows.withColumn("row", 2 * F.monotonically_increasing_id() + 1)
    chunks = saved(numbered.mapInArrow(lean(cut), f"row long, key {kind}, chunk int, n_chunks int, text string, lo int, hi int, left long, n_chars long, signature long"), "piece-chunks")
    chunks = chunks.repartition("row", "chunk")  # a giant document's chunks go to many tasks
    matrices = saved(chunks.select("row", "chunk", "text", "lo", "hi").mapInArrow(lean(transfer), "row long, chunk int, matrix string"), "piece-matrices")
    passed = handed_down(matrices, chunks.agg(F.max("n_chunks")).first()[0] or 1)
    return chunks.join(passed, ["row", "chunk"]).mapInArrow(lean(trace), f"row long, key {kind}, {LONG}")


def handed_down(matrices: DataFrame, most: int) -> DataFrame:
    """The states at both ends of every chunk: row, chunk, over_in, piece_in, over_out, piece_out; ``most`` chunks a text at most.

    ``FAN`` neighbours are multiplied in one group, their products again, until a text has
    one; every level is a written table. The states go down the same tree, so no
    task sees more than ``FAN`` matrices of a text, however long it is.
    """
    ends = ["over_in", "piece_in", "over_out", "piece_out"]

    def multiply(group: pa.Table) -> pa.Table:
        group = group.sort_by("block")
        whole = levels_of([read(m) for m in group.column("matrix").to_pylist()])[-1][0]
        return pa.table({"row": group.column("row")[:1], "block": group.column("up")[:1], "matrix": pa.array([written(whole)], pa.string())})

    def descend(group: pa.Table) -> pa.Table:
        group = group.sort_by("block")
        over_in, piece_in, over_out, piece_out = (group.column(c)[0].as_py() for c in ends)
        passed = states([read(m) for m in group.column("matrix").to_pylist()], (over_in, piece_in), None if piece_out is None else (over_out, piece_out))
        columns = [pa.array([s[k] for s in part], kind) for part in (passed[:-1], passed[1:]) for k, kind in ((0, pa.int32()), (1, pa.string()))]
        return pa.table([group.column("row"), group.column("block"), *columns], ["row", "block", *ends])

    up = F.expr(f"block div {FAN}")
    levels = [matrices.select("row", F.col("chunk").cast("long").alias("block"), "matrix")]
    while True:
        groups = levels[-1].withColumn("up", up).groupBy("row", "up")
        levels.append(saved(groups.applyInArrow(multiply, "row long, block long, matrix string"), "piece-products"))
        most = -(-most // FAN)
        if most == 1:
            break
    blank = [F.lit(0).alias("over_in"), F.lit("").alias("piece_in"), F.lit(None).cast("int").alias("over_out"), F.lit(None).cast("string").alias("piece_out")]
    passed = levels[-1].select("row", "block", *blank)
    for level in levels[-2::-1]:
        joined_up = level.withColumn("up", up).join(passed.withColumnRenamed("block", "up"), ["row", "up"])
        passed = saved(joined_up.groupBy("row", "up").applyInArrow(descend, "row long, block long, over_in int, piece_in string, over_out int, piece_out string"), "piece-states")
    return passed.withColumn("chunk", F.col("block").cast("int")).drop("block")


def decode(encoded: DataFrame, path: str = MODEL, out: str = "decoded") -> DataFrame:
    """``encoded`` with the text of each row's ``ids``; ``chunk`` tells whether they begin a text.

    The library puts a space before a text and takes it away again; a null chunk
    begins a text. Null ids give a null text. Sign U+2581 comes back as a space.
    """
    rest = [c for c in encoded.columns if c != out]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.select(rest).schema), f"`{out}` string"])

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(path)
        lead = pieces.ids[SPACE]
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = []
                for ids, chunk in zip(part.column("ids"), part.column("chunk")):
                    if not ids.is_valid:
                        texts.append(None)
                        continue
                    own = ids.values.to_numpy(zero_copy_only=False).tolist()
                    texts.append(pieces.model.decode([lead, *own] if chunk.as_py() else own))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), pa.array(texts, pa.string())], [*rest, out])

    return encoded.select(rest).mapInArrow(lean(back), schema)


def joined(decoded: DataFrame, key: str = "doc_id") -> DataFrame:
    """Decoded rows of several chunks (see ``encode_parts``), one row per text: row, key, n_tokens, n_chunks, ids_hash, round_trip.

    A text is round if as many chunks as it has, at their places, have its length and signature.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signs = [signature(t, at) for t, at in zip(batch.column("decoded").to_pylist(), batch.column("at").to_pylist())]
            rest = [c for c in batch.schema.names if c not in ("decoded", "at")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(signs, pa.int64())], [*rest, "sign"])

    kind = decoded.schema[key].dataType.simpleString()
    parts = decoded.select("row", F.col(key).alias("key"), "n_chunks", "n_chars", "signature", F.size("ids").cast("long").alias("n"),
                           F.xxhash64("chunk", "ids").alias("hash"), F.length("decoded").cast("long").alias("chars"), "decoded", "at")
    signed = parts.mapInArrow(lean(sign), f"row long, key {kind}, n_chunks int, n_chars long, signature long, n long, hash long, chars long, sign long")
    whole = (F.count(F.lit(1)) == F.max("n_chunks")) & (F.sum("chars") == F.max("n_chars")) & (F.bit_xor("sign") == F.max("signature"))
    sums = [F.sum("n").alias("n_tokens"), F.max("n_chunks").alias("n_chunks"), F.bit_xor("hash").alias("ids_hash"), whole.alias("round_trip")]
    return signed.groupBy("row", "key").agg(*sums).withColumnRenamed("key", key)

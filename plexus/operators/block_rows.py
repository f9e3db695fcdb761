"""Segments of documents that come as one row per block, however long a document is.

``segments.segment`` takes a document per row. Here a document may be spread over any number of rows
(pages of scanned books, logs): the greedy rule is followed without ever holding a document in one task.

A document's blocks are cut by position into chunks of a bounded number of blocks. All that a chunk needs to
know of those before it is how many tokens are in the segment that is open at its start, and the sizes of the last few
pieces, which may begin the next segment as its overlap. So

1. each chunk counts its pieces and keeps its tail; tails are put together by a prefix over the chunks;
2. each chunk, knowing the tail before it, is a map from tokens open at its start to tokens open at its
   end and segments closed in between; maps are composed by a prefix over the chunks too;
3. each chunk follows the rule from its true start. Segments over a border are written in parts, one per
   chunk, and joined; where an overlap reaches back over a border, the chunks before are asked for theirs.

Both prefixes are trees of fan ``2 ** FAN_BITS``, so no step sees a whole document. A document of one chunk has nothing
before it and goes straight to the last step.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plexus.functions.text import is_clean
from plexus.operators.segments import count_tokens, split_long
from plexus.operators.skew import row_number_by_block
from plexus.operators.vectors import slices, to_arrow
from plexus.session import materialise

FAN_BITS = 6
_BLOCK_COLUMNS = ("text", "kind", "anchor", "page_number", "title")
_PIECE = "k: int, text: string, kind: string, anchor: string, page_number: int, title: string"
_PART = ("n: bigint, text: string, kinds: array<string>, n_tokens: int, linked: boolean, anchor: string, page_number: int, "
         "first_page: int, title: string")
_OUT = ("segment_number", "text", "kinds", "n_tokens", "title", "anchor", "page_number", "first_page")


class Piece(NamedTuple):
    k: int
    text: str
    kind: str
    anchor: str | None
    page_number: int | None
    title: str | None


class Part(NamedTuple):
    """What a chunk has of a segment."""
    n: int
    text: str
    kinds: list[str]
    n_tokens: int
    linked: bool
    anchor: str | None
    page_number: int | None
    first_page: int | None
    title: str | None

    @classmethod
    def of(cls, pieces: list[Piece], title: str | None) -> Part:
        link = next((p for p in pieces if p.anchor or p.page_number), None)
        return cls(len(pieces), "\n\n".join([p.text for p in pieces]), sorted({p.kind for p in pieces}), sum(p.k for p in pieces), link is not None,
                   link and link.anchor, link and link.page_number, next((p.page_number for p in pieces if p.page_number is not None), None), title or None)


class Tail(NamedTuple):
    """The last pieces with tokens that fit an overlap, and the one before them: sizes, chunks and places there.

    ``whole``: there is none before them, the document begins there. ``title``: the first one so far.
    """
    k: list[int]
    c: list[int]
    i: list[int]
    whole: bool
    title: str | None


class Step(NamedTuple):
    """A segment as a chunk sees it: begun in chunks before, going on behind; ``reach``: begins with that place of the tail."""
    number: int
    begun: bool
    goes_on: bool
    reach: int | None
    part: Part


def _pieces(blocks: list[tuple], max_tokens: int, count: Callable[[str], int]) -> list[Piece]:
    """Blocks with their tokens, long ones cut."""
    out = []
    for _, text, *rest in blocks:
        n = count(text)
        out += [Piece(k, t, *rest) for t, k in ([(text, n)] if n <= max_tokens else [(t, count(t)) for t in split_long(text, max_tokens, count)])]
    return out


def _suffix(sizes: list[int], room: int) -> tuple[int, int]:
    """Where the last sizes begin that fit, and the room that is left."""
    at = len(sizes)
    while at and sizes[at - 1] <= room:
        at -= 1
        room -= sizes[at]
    return at, room


def tail_of(pieces: list[Piece], c: int, overlap: int) -> Tail:
    found = [(p.k, c, i) for i, p in enumerate(pieces) if p.k]
    at, _ = _suffix([k for k, _, _ in found], overlap)
    k, cs, i = (list(x) for x in zip(*found[max(at - 1, 0):], strict=True)) if found else ([], [], [])
    return Tail(k, cs, i, not at, next((p.title for p in pieces if p.title), None))


def join_tails(overlap: int) -> Callable[[Tail, Tail], Tail]:
    def join(a: Tail, b: Tail) -> Tail:
        title = a.title or b.title
        if not b.whole:
            return b._replace(title=title)
        k, c, i = a.k + b.k, a.c + b.c, a.i + b.i
        at, _ = _suffix(k, overlap)
        cut = max(at - 1, 0)
        return Tail(k[cut:], c[cut:], i[cut:], a.whole and not at, title)
    return join


def walk(pieces: list[Piece], tail: list[int], state: int, number: int, title: str | None, last: bool, max_tokens: int, overlap: int) -> Iterator[Step]:
    """The segments of a chunk by the rule. ``state``: 0 if none is open at its start, else its tokens plus 1; ``number``: those closed before."""
    sizes, start, reach = [p.k for p in pieces], 0, None
    begun, tokens = state > 0, max(state - 1, 0)
    for at, piece in enumerate(pieces):
        title = title or piece.title
        if (at > start or begun or reach is not None) and tokens + piece.k > max_tokens:
            yield Step(number, begun, False, reach, Part.of(pieces[start:at], title))
            start, room, reach = at, overlap, None
            while start and sizes[start - 1] <= room:
                start -= 1
                room -= sizes[start]
            if not start:  # the overlap goes on in the chunks before
                reach, room = _suffix(tail, room)
            begun, tokens, number = False, overlap - room, number + 1
        tokens += piece.k
    if len(pieces) > start or begun or reach is not None:
        yield Step(number, begun, not last, reach, Part.of(pieces[start:], title))


def transfer(sizes: list[int], tail: list[int], max_tokens: int, overlap: int) -> tuple[np.ndarray, np.ndarray]:
    """What a chunk makes of each state at its start: the state at its end, and how many segments it closes."""
    states = max_tokens + overlap + 2
    upto = np.cumsum([0, *tail, *sizes])
    edge, n = len(tail), len(tail) + len(sizes)
    if edge == n:
        return np.arange(states), np.zeros(states, np.int64)
    # an end after the first p pieces: the overlap leaves base tokens out, the next end is after ``following`` pieces
    p = np.arange(edge, n + 1)
    base = upto[np.searchsorted(upto, upto[p] - overlap)]
    following = np.minimum(np.maximum(np.searchsorted(upto, base + max_tokens, "right") - 1, p + 1), n)
    state, closed = np.empty(n + 1, np.int64), np.empty(n + 1, np.int64)
    for at in range(n - 1, edge - 1, -1):
        to = following[at - edge]
        if to == n:
            state[at], closed[at] = upto[n] - base[at - edge] + 1, 1
        else:
            state[at], closed[at] = state[to], closed[to] + 1
    tokens = np.maximum(np.arange(states) - 1, 0)
    first = np.searchsorted(upto, upto[edge] + max_tokens - tokens, "right") - 1
    first[0] = max(first[0], edge + 1)  # no segment is open: the first piece is taken whatever its size
    first = np.maximum(first, edge)     # an open one that the first piece does not fit in ends at the border
    inside = first < n
    to = np.minimum(first, n - 1)
    return np.where(inside, state[to], tokens + upto[n] - upto[edge] + 1), np.where(inside, closed[to], 0)


def compose(a: tuple, b: tuple) -> tuple:
    """The map of two chunks from the maps of both."""
    first, before, to, closed = (np.frombuffer(x, np.int64) for x in (*a, *b))
    return to[first].tobytes(), (before + closed[first]).tobytes()


def _values(column: pa.Array) -> list:
    """The values of a column; of lists of structs as lists of tuples, of structs as tuples."""
    if pa.types.is_list(column.type) and pa.types.is_struct(column.type.value_type):
        flat, ends = _values(column.flatten()), column.offsets.to_pylist()
        return [flat[a - ends[0]:b - ends[0]] for a, b in zip(ends, ends[1:])]
    if pa.types.is_struct(column.type):
        rows = list(zip(*(f.to_pylist() for f in column.flatten()), strict=True))
        return rows if not column.null_count else [r if known else None for r, known in zip(rows, column.is_valid().to_pylist(), strict=True)]
    return column.to_pylist()


def _array(values: list, kind: pa.DataType) -> pa.Array:
    """The way back."""
    if pa.types.is_list(kind) and pa.types.is_struct(kind.value_type):
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, values)]), pa.int32()), _array([v for vs in values for v in vs], kind.value_type), type=kind)
    if pa.types.is_struct(kind):
        none = (None,) * kind.num_fields
        columns = list(zip(*(none if v is None else v for v in values), strict=True)) if values else [()] * kind.num_fields
        return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind, strict=True)], fields=list(kind), mask=pa.array([v is None for v in values], pa.bool_()))
    return pa.array(values, kind)


def _map(df: DataFrame, columns: list[str], run: Callable[..., tuple], added: str) -> DataFrame:
    """Put columns made row by row in the place of others."""
    kept = [c for c in df.columns if c not in columns]
    extra = T._parse_datatype_string(f"struct<{added}>")
    schema = T.StructType([*(df.schema[c] for c in kept), *extra.fields])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = to_arrow(schema)
        for batch in slices(batches, 16):
            of = {c: batch.column(batch.schema.get_field_index(c)) for c in df_columns}
            made = [run(*row) for row in zip(*(_values(of[c]) for c in columns), strict=True)]
            yield pa.RecordBatch.from_arrays([*(of[c] for c in kept), *(_array([m[k] for m in made], target.field(f.name).type) for k, f in enumerate(extra.fields))], schema=target)

    df_columns = df.columns
    return df.mapInArrow(task, schema)


def prefixes(values: DataFrame, key: str, top: int, combine: Callable[[tuple, tuple], tuple], kind: str, form: Callable = tuple) -> DataFrame:
    """``key, c, before`` of rows ``key, c, v``: the values of all smaller c of the key, combined in order, NULL for the first.

    ``top`` is the largest c. Values are combined group by group of ``2 ** FAN_BITS``, up a tree and down again.
    """
    value = T._parse_datatype_string(f"struct<{kind}>")
    schema = T.StructType([values.schema[key], T.StructField("c", T.LongType()), T.StructField("v", value)])
    down = T.StructType([*schema.fields[:2], T.StructField("before", value)])
    fan = F.shiftright("c", FAN_BITS)

    def ordered(table: pa.Table) -> tuple[list[int], list[tuple]]:
        c = table.column("c").to_pylist()
        v = _values(table.column("v").combine_chunks())
        order = sorted(range(len(c)), key=c.__getitem__)
        return [c[k] for k in order], [form(v[k]) for k in order]

    def up(table: pa.Table) -> pa.Table:
        c, v = ordered(table)
        return pa.Table.from_arrays([table.column(0).slice(0, 1), pa.array([c[0] >> FAN_BITS]), _array([reduce(combine, v)], to_arrow(schema).field("v").type)], schema=to_arrow(schema))

    def spread(children: pa.Table, parents: pa.Table) -> pa.Table:
        c, v = ordered(children)
        above = _values(parents.column("before").combine_chunks())[0] if len(parents) else None
        befores = [form(above) if above is not None else None]
        for own in v[:-1]:
            befores.append(own if befores[-1] is None else combine(befores[-1], own))
        return pa.Table.from_arrays([children.column(0), pa.array(c, pa.int64()), _array(befores, to_arrow(down).field("before").type)], schema=to_arrow(down))

    levels = [values.select(key, "c", "v")]
    while top:
        levels.append(levels[-1].groupBy(key, fan.alias("g")).applyInArrow(lambda t: up(t), schema))
        top >>= FAN_BITS
    before = levels[-1].select(F.col(key).alias("_key"), F.col("c").alias("_c"), F.lit(None).cast(value).alias("before"))
    for level in levels[-2::-1]:
        met = level.groupBy(key, fan.alias("g")).cogroup(before.groupBy("_key", "_c")).applyInArrow(lambda a, b: spread(a, b), down)
        before = met.select(F.col(key).alias("_key"), F.col("c").alias("_c"), "before")
    return before.withColumnsRenamed({"_key": key, "_c": "c"})


def segment_block_rows(blocks: DataFrame, key: str, position: str = "position", *, max_tokens: int = 300, overlap_tokens: int = 50,
                       min_chars: int = 20, clean_only: bool = True, start: int = 0, chunk: int = 1_000) -> DataFrame:
    """I13 over block rows: the same segments as ``segment`` gives for documents held in one row.

    ``position`` is an integer, unique in the document; ``chunk`` positions make a chunk. Blank blocks, which have no tokens,
    are rows like any other. Texts are shuffled once, to their chunks, and written, since several steps read them; what travels
    between chunks are sizes of pieces within an overlap, and maps of as many numbers as a segment and an overlap have tokens.
    """
    rows = blocks.where(F.col("text").isNotNull()).withColumn("c", F.floor(F.col(position) / chunk).cast("bigint"))
    block = F.struct(F.col(position).cast("bigint").alias("at"), *_BLOCK_COLUMNS)
    chunks = materialise(rows.groupBy(key, "c").agg(F.array_sort(F.collect_list(block)).alias("blocks")), "chunks")  # the position leads and is unique
    spans = chunks.groupBy(key).agg(F.min("c").alias("first"), F.max("c").alias("last")).where("first < last")
    top = spans.agg(F.max(F.col("last") - F.col("first"))).first()[0]

    def alone(blocks: list[tuple]) -> tuple:
        steps = walk(_pieces(blocks, max_tokens, count_tokens()), [], 0, 0, None, True, max_tokens, overlap_tokens)
        return ([s.part for s in steps],)

    def one_chunk(rows: DataFrame) -> DataFrame:
        """Documents of one chunk, which have no chunks before to wait for."""
        segments = _map(rows.select(key, "blocks"), ["blocks"], alone, f"segments: array<struct<{_PART}>>")
        clean = F.filter("segments", lambda s: is_clean(s["text"], min_chars)) if clean_only else F.col("segments")
        return segments.select(key, F.posexplode(clean).alias("i", "s")).select(key, (F.col("i") + start).cast("bigint").alias("segment_number"), *_fields(lambda f: F.col("s")[f]))

    if top is None:
        return one_chunk(chunks)

    def counted(c: int, blocks: list[tuple]) -> tuple:
        pieces = _pieces(blocks, max_tokens, count_tokens())
        return c, pieces, tail_of(pieces, c, overlap_tokens)

    tail = "k: array<int>, c: array<bigint>, i: array<int>, whole: boolean, title: string"
    shifted = chunks.join(spans, key).select(key, (F.col("last") - F.col("first")).alias("last"), (F.col("c") - F.col("first")).alias("c"), "blocks")
    long = materialise(_map(shifted, ["c", "blocks"], counted, f"c: bigint, pieces: array<struct<{_PIECE}>>, v: struct<{tail}>"), "pieces")
    before = materialise(prefixes(long, key, top, join_tails(overlap_tokens), tail, lambda v: Tail(*v)), "tails")

    def as_map(sizes: list[int], tail: list[int] | None) -> tuple:
        return (tuple(x.astype(np.int64).tobytes() for x in transfer(sizes, tail or [], max_tokens, overlap_tokens)),)

    maps = "to: binary, closed: binary"
    sizes = long.select(key, "c", F.col("pieces.k").alias("sizes")).join(before.select(key, "c", F.col("before.k").alias("tail")), [key, "c"])
    composed = prefixes(_map(sizes, ["sizes", "tail"], as_map, f"v: struct<{maps}>"), key, top, compose, maps)
    entry = _map(composed, ["before"], lambda b: tuple(int(np.frombuffer(x, np.int64, 1)[0]) for x in b) if b else (0, 0), "state: bigint, number: bigint")  # of no open segment

    def follow(c: int, last: int, pieces: list[tuple], tail: tuple | None, state: int, number: int) -> tuple:
        tail = Tail(*tail) if tail else Tail([], [], [], True, None)
        out = []
        for s in walk([Piece(*p) for p in pieces], tail.k, state, number, tail.title, c == last, max_tokens, overlap_tokens):
            since = (0, 0) if s.reach is None or not s.reach else (tail.c[s.reach - 1], tail.i[s.reach - 1] + 1)
            out.append((s.number, c, s.begun or s.goes_on or s.reach is not None, not s.goes_on, *(since if s.reach is not None else (None, None)), *s.part))
        return (out,)

    part = f"number: bigint, at: bigint, shared: boolean, closed: boolean, since: bigint, place: int, {_PART}"
    known = long.drop("v").join(before, [key, "c"]).join(entry, [key, "c"])
    parts = _map(known, ["c", "last", "pieces", "before", "state", "number"], follow, f"parts: array<struct<{part}>>")
    # read by three branches: whole segments, parts, and what is asked for
    parts = materialise(parts.select(key, F.explode("parts").alias("p")).select(key, "p.*"), "parts")

    def answer(c: int, pieces: list[tuple], asked: list[tuple]) -> tuple:
        return ([(number, c, True, False, None, None, *Part.of([Piece(*p) for p in pieces[place if c == since else 0:]], None)) for number, since, place in asked],)

    asked = (parts.where("since < at").select(key, F.explode(F.sequence("since", F.col("at") - 1)).alias("c"), F.struct("number", "since", "place").alias("ask"))
             .groupBy(key, "c").agg(F.collect_list("ask").alias("asked")))
    answers = (_map(long.select(key, "c", "pieces").join(asked, [key, "c"]), ["c", "pieces", "asked"], answer, f"parts: array<struct<{part}>>")
               .select(key, F.explode("parts").alias("p")).select(key, "p.*"))
    far = (parts.where("NOT shared").select(key, "number", *_fields(F.col))
           .unionByName(_merged(parts.where("shared").unionByName(answers), key)))
    if clean_only:
        far = row_number_by_block(far.where(is_clean("text", min_chars)), [key], "number", "segment_number", start)
    else:
        far = far.withColumn("segment_number", F.col("number") + start)
    return one_chunk(chunks.join(spans, key, "left_anti")).unionByName(far.select(key, *_OUT))


def _fields(s: Callable[[str], Column]) -> list[Column]:
    return [s("text").alias("text"), F.array_join(s("kinds"), ",").alias("kinds"), s("n_tokens").alias("n_tokens"), s("title").alias("title"),
            s("anchor").alias("anchor"), s("page_number").alias("page_number"), s("first_page").alias("first_page")]


def _merged(parts: DataFrame, key: str) -> DataFrame:
    """Segments from their parts, in order of the chunks; the chunk that closes a segment knows its title."""
    fields = [f.split(":")[0].strip() for f in _PART.split(",")]
    grouped = parts.groupBy(key, "number").agg(F.array_sort(F.collect_list(F.struct("at", "closed", *fields))).alias("p"))
    some = F.filter("p", lambda p: p["n"] > 0)
    link = F.get(F.filter("p", lambda p: p["linked"]), F.lit(0))
    paged = F.get(F.filter("p", lambda p: p["first_page"].isNotNull()), F.lit(0))
    return grouped.select(
        key, "number", F.array_join(F.transform(some, lambda p: p["text"]), "\n\n").alias("text"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten("p.kinds"))), ",").alias("kinds"),
        F.aggregate("p.n_tokens", F.lit(0), lambda a, n: a + n).alias("n_tokens"), F.get(F.filter("p", lambda p: p["closed"]), F.lit(0))["title"].alias("title"),
        link["anchor"].alias("anchor"), link["page_number"].alias("page_number"), paged["first_page"].alias("first_page"))

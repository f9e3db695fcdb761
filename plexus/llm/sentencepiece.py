"""SentencePiece encoding and decoding by a max-plus scan.

The best segmentation of a text is a longest path through a lattice of pieces. A chunk of a text is a
linear map in the (max, +) algebra: entry (i, j) of its matrix is the best score from state i at its
left edge to state j at its right edge, where the state is the number of characters by which the piece
that crosses the edge reaches into the chunk to the right. Products of matrices are associative, so
chunks of a giant text are weighed apart, their edges settled together, and each chunk is traced back
on its own between its two states.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK_CHARS = 32_768
AHEAD_CHARS = 1024    # how far behind an edge a place where all paths meet is looked for
SPACE = "▁"
NEVER = -(1 << 60)
_UNITS_KEPT = 100_000
_SUB_BATCH = 1 << 20   # characters of a batch handed back at a time


@dataclass
class Vocabulary:
    """Pieces with whole-number scores, and ids of the byte pieces; blanks stand as ordinary spaces."""
    pieces: dict[str, tuple[int, int]]
    bytes_: list[int]
    texts: list[str]

    @cached_property
    def longest(self) -> int:
        return max(map(len, self.pieces), default=1)

    @cached_property
    def unknown(self) -> int:
        """Score of a character without a piece, below every piece."""
        return min((s for _, s in self.pieces.values()), default=0) - 10

    @cached_property
    def steps(self) -> dict[str, int]:
        """Score of every beginning of a piece, ``NEVER`` where it is no piece itself."""
        out = {p[:n]: NEVER for p in self.pieces for n in range(1, len(p))}
        out.update((p, score) for p, (_, score) in self.pieces.items())
        return out

    @cached_property
    def byte_of(self) -> dict[int, int]:
        """Ids of the bytes that need their neighbours to be a character."""
        return {p: b for b, p in enumerate(self.bytes_) if b >= 0x80}

    @cached_property
    def singles(self) -> set[str]:
        return {p for p in self.pieces if len(p) == 1}

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        """Finds all pieces in a text, ``(length, score, id)`` each, the longest first at a place."""
        out = ahocorasick.Automaton()
        for p, (i, score) in self.pieces.items():
            out.add_word(p, (len(p), score, i))
        out.make_automaton()
        return out

    @cached_property
    def scores(self) -> dict[int, int]:
        """Score by id; a character without a piece counts with the first of its bytes."""
        out = {p: 0 if 0x80 <= b < 0xC0 else self.unknown for b, p in enumerate(self.bytes_)}
        out.update(self.pieces.values())
        return out

    @cached_property
    def shown(self) -> list[str]:
        """Text of each id, for bytes below 0x80 their character."""
        out = list(self.texts)
        for b, p in enumerate(self.bytes_[:0x80]):
            out[p] = chr(b)
        return out

    @cached_property
    def units(self) -> re.Pattern:
        """Parts of a text that no piece crosses: before a blank that follows something else, and around
        each character that is part of no longer piece."""
        if any(" " in p.lstrip(" ") for p in self.pieces):
            return re.compile(r".+", re.S)
        joined = {c for p in self.pieces if len(p) > 1 for c in p}
        alone = "".join(c for c in map(chr, range(1, 32)) if c not in joined)
        return re.compile(f"[{re.escape(alone)}]| *[^ {re.escape(alone)}]+| +") if alone else re.compile(r" *[^ ]+| +")


def load_vocabulary(path: str = MODEL) -> Vocabulary:
    """Read pieces and scores of a model file, on the driver. The file is a parameter, never copied."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    texts = [sp.id_to_piece(i) for i in range(n)]
    plain = {t.replace(SPACE, " "): (i, round(sp.get_score(i))) for i, t in enumerate(texts)
             if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}
    return Vocabulary(plain, [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], [t.replace(SPACE, " ") for t in texts])


def _paths(v: Vocabulary, text: str, entry: int, end: int) -> tuple[list[int], list[int]]:
    """Best score and length of the last piece at each place from ``entry`` on.

    Of equal paths the longer last piece wins: it starts earlier and so comes first.
    """
    size = len(text)
    best, last = [NEVER] * (size + 1), [0] * (size + 1)
    if entry <= size:
        best[entry] = 0
    get, unknown = v.steps.get, v.unknown
    for at in range(entry, end):
        base = best[at]
        if base == NEVER:
            continue
        to = at + 1
        score = get(text[at])
        total = base + (unknown if score is None or score == NEVER else score)
        if total > best[to]:
            best[to], last[to] = total, 1
        while score is not None and to < size:
            to += 1
            score = get(text[at:to])
            if score is not None and score != NEVER and base + score > best[to]:
                best[to], last[to] = base + score, to - at
    return best, last


def _ids(v: Vocabulary, piece: str) -> Sequence[int]:
    known = v.pieces.get(piece)
    return (known[0],) if known else [v.bytes_[b] for b in piece.encode("utf-8")]


def _trace(v: Vocabulary, text: str, last: list[int], entry: int, end: int) -> list[int]:
    cuts, at = [], end
    while at > entry:
        cuts.append(at)
        at -= last[at]
    out: list[int] = []
    at = entry
    for cut in reversed(cuts):
        out.extend(_ids(v, text[at:cut]))
        at = cut
    return out


class Encoder:
    """Encodes whole texts; parts between places that no piece crosses are looked up once.

    Of the parts seen, two generations are kept: what is still in use moves to the younger one.
    """

    def __init__(self, v: Vocabulary) -> None:
        self.v, self.seen, self.old = v, {}, {}

    def unit(self, text: str) -> tuple[int, ...]:
        """Ids of a part."""
        ids = self.seen.get(text) or self.old.get(text)
        if ids is None:
            ids = tuple(self._known(text) if self.v.singles.issuperset(text) else
                        _trace(self.v, text, _paths(self.v, text, 0, len(text))[1], 0, len(text)))
        if len(text) < 64:
            if len(self.seen) >= _UNITS_KEPT:
                self.seen, self.old = {}, self.seen
            self.seen[text] = ids
        return ids

    def _known(self, text: str) -> list[int]:
        """Best path of a text in which every character is a piece."""
        best, last = [0] + [NEVER] * len(text), [None] * (len(text) + 1)
        for end, piece in self.v.automaton.iter(text):
            end += 1
            total = best[end - piece[0]] + piece[1]
            if total > best[end]:
                best[end], last[end] = total, piece
        out, at = [], len(text)
        while at:
            piece = last[at]
            out.append(piece[2])
            at -= piece[0]
        return out[::-1]

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for part in self.v.units.findall(text):
            out += self.seen.get(part) or self.unit(part)
        return out

    def score(self, text: str) -> int:
        """Score of the best path of a text between two places that all paths meet."""
        scores = self.v.scores
        return sum(scores[i] for part in self.v.units.findall(text) for i in self.unit(part))


def first_meeting(v: Vocabulary, text: str) -> int | None:
    """First place after the start that every path meets, seen from the text around it alone."""
    for m in v.units.finditer(text):
        if 0 < m.start() < len(text) - 1:
            return m.start()
    return None


def _meetings(v: Vocabulary, body: str, ahead: str) -> tuple[int, int] | None:
    """First and last place of a chunk that every path meets, or none; the first lies behind every overhang."""
    inner = [m.start() for m in v.units.finditer(body + ahead) if v.longest <= m.start() <= len(body)]
    return (inner[0], inner[-1]) if inner else None


def chunk_matrix(encoder: Encoder, body: str, ahead: str) -> np.ndarray:
    """Transfer matrix of a chunk; ``ahead`` is what follows, at least ``longest - 1`` characters of it.

    Where all paths meet in places of the chunk (before blanks, say), the matrix is a sum of what
    lies before the first, between, and behind the last of them; else every state is followed
    through the whole chunk.
    """
    v = encoder.v
    size = v.longest
    text = body + ahead[:size - 1]
    met = _meetings(v, body, ahead)
    out = np.full((size, size), NEVER, dtype=np.int64)
    if met:
        middle = encoder.score(body[met[0]:met[1]])
        tail = _paths(v, text[met[1]:], 0, len(body) - met[1])[0][len(body) - met[1]:]
    for i in range(min(size, len(body) + 1)):
        if met:
            head = _paths(v, text[:met[0]], i, met[0])[0][met[0]]
            row = [head + middle + t if t != NEVER else NEVER for t in tail]
        else:
            row = _paths(v, text, i, len(body))[0][len(body):]
        out[i, :len(row)] = row[:size]
    for i in range(len(body) + 1, size):  # a piece that reaches over the whole chunk
        out[i, i - len(body)] = 0
    return out


def max_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product of two matrices in the (max, +) algebra."""
    out = (a[:, :, None] + b[None, :, :]).max(axis=1)
    return np.maximum(out, NEVER)


def products(matrices: Sequence[np.ndarray]) -> list[np.ndarray]:
    """Levels of a tree over the chunks: each level holds the products of pairs of the level below."""
    levels = [list(matrices)]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([max_plus(below[k], below[k + 1]) if k + 1 < len(below) else below[k] for k in range(0, len(below), 2)])
    return levels


def settle(matrices: Sequence[np.ndarray]) -> list[int]:
    """State at each edge between chunks on the best path, 0 at both ends.

    From the product of all chunks downwards: where a node of the tree was made of two, the state
    between them is the one with the best sum, of equal ones the largest overhang.
    """
    levels = products(matrices)
    states = [0, 0]
    for below in levels[-2::-1]:
        finer = []
        for k in range(0, len(below), 2):
            enter, leave = states[k // 2], states[k // 2 + 1]
            finer.append(enter)
            if k + 1 < len(below):
                total = below[k][enter] + below[k + 1][:, leave]
                finer.append(int(len(total) - 1 - np.argmax(total[::-1])))
        states = [*finer, states[-1]]
    return states


def _ends(v: Vocabulary, no: int, body: str, ahead: str) -> tuple[int | None, int | None]:
    """Places behind the two edges of a chunk that every path meets, if there are such near them."""
    return (first_meeting(v, (body + ahead)[:AHEAD_CHARS]) if no else 0), (first_meeting(v, ahead) if ahead else 0)


def open_matrix(encoder: Encoder, no: int, body: str, ahead: str) -> bytes | None:
    """Matrix of a chunk with an edge that no meeting place closes; between two such places no state is in doubt."""
    start, end = _ends(encoder.v, no, body, ahead)
    if start is not None and end is not None:
        return None
    m = chunk_matrix(encoder, body, ahead)
    if start is not None:  # every way in leads to the meeting place
        m = chunk_matrix(encoder, body[start:], ahead)[:1].repeat(encoder.v.longest, axis=0) if start <= len(body) else m
    if end is not None:
        stop = chunk_matrix(encoder, body + ahead[:end], "")[:, :1]
        m = stop.repeat(encoder.v.longest, axis=1)
    return m.tobytes()


def settle_open(matrices: Sequence[np.ndarray | None]) -> list[int]:
    """``settle`` for each run of chunks with open edges; closed chunks need no states."""
    states, run = [0], []
    for m in [*matrices, None]:
        if m is not None:
            run.append(m)
            continue
        if run:
            states += settle(run)[1:]
            run = []
        states.append(0)
    return states[:len(matrices) + 1]


def trace_chunk(v: Vocabulary, body: str, ahead: str, entry: int, leave: int) -> list[int]:
    """Ids of the pieces that start in a chunk, between its two states."""
    if entry > len(body):
        return []
    text = body + ahead[:leave]
    _, last = _paths(v, text, entry, len(body))
    return _trace(v, text, last, entry, len(text))


def trace_between(encoder: Encoder, no: int, body: str, ahead: str, enter: int, leave: int) -> list[int]:
    """Ids of a chunk. An edge moves to the first meeting place behind it, if there is one near, so that a word
    is traced as a whole by the chunk in which it starts; else the states at the edge hold."""
    v = encoder.v
    start, end = _ends(v, no, body, ahead)
    text = body + ahead
    if end is None:
        if start is None:
            return trace_chunk(v, body, ahead, enter, leave)
        return trace_chunk(v, body[start:], ahead, 0, leave) if start <= len(body) else []
    stop = len(body) + end
    if start is not None:
        return encoder.encode(text[start:stop])
    return trace_chunk(v, text[:stop], "", enter, 0)


def decode_ids(v: Vocabulary, ids: Sequence[int]) -> str:
    """The text of ids: byte pieces in a row are UTF-8, the blank put before the text is taken off."""
    byte_of, shown = v.byte_of, v.shown
    if byte_of.keys().isdisjoint(ids):
        text = "".join([shown[i] for i in ids])
        return text[1:] if text.startswith(" ") else text
    out: list[str] = []
    run = bytearray()
    for i in ids:
        if i in byte_of:
            run.append(byte_of[i])
            continue
        if run:
            out.append(run.decode("utf-8", "replace"))
            run.clear()
        out.append(shown[i])
    if run:
        out.append(run.decode("utf-8", "replace"))
    text = "".join(out)
    return text[1:] if text.startswith(" ") else text


def _shared(spark: SparkSession, v: Vocabulary):
    return spark.sparkContext.broadcast((v.pieces, v.bytes_, v.texts))  # bounded by the vocabulary


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", name: str = "ids", chunk_chars: int = CHUNK_CHARS,
           proof: str | None = None) -> DataFrame:
    """Op 1. All columns of ``docs`` but the text, and the ids of the whole text.

    ``proof`` names a column that tells whether the ids decode to the text, found where the ids are made.
    A blank goes before a text that is not empty; a character without a piece becomes its UTF-8 bytes, a
    blank symbol in the text too, so ``decode`` gives back every text exactly. Null and empty texts give no
    ids. Texts up to ``chunk_chars`` are encoded in one step where they lie, longer ones in chunks spread over
    all tasks. The result is the same at every chunk size, but for equal best scores of a text without
    any place where all paths meet. Rows that repeat stay repeated; columns may have any other name.
    """
    shared = _shared(docs.sparkSession, vocabulary)
    others = [c for c in docs.columns if c != text]
    whole = F.when(F.col(text) != "", F.concat(F.lit(" "), F.col(text))).otherwise(F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)], F.lit(0).alias("none")).alias("row"),
                       F.coalesce(whole, F.lit("")).alias("t"))
    kind = rows.schema["row"].dataType.simpleString()
    short = rows.where(F.length("t") <= chunk_chars)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(*shared.value))
        for batch in batches:
            start, size, ids, good = 0, 0, [], []
            for k, value in enumerate(batch.column(1)):
                t = value.as_py()
                own = encoder.encode(t)
                good.append(proof is None or decode_ids(encoder.v, own) == t[1:])
                ids.append(np.array(own, dtype=np.int32))
                size += len(t)
                if size > _SUB_BATCH or k == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, k + 1 - start), _lists(ids), pa.array(good, pa.bool_())], names=["row", "ids", "good"])
                    start, size, ids, good = k + 1, 0, [], []

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary(*shared.value)
        for batch in batches:
            for k in range(batch.num_rows):  # one long text at a time
                one = batch.slice(k, 1)
                good = decode_ids(v, one.column(1)[0].as_py()) == one.column(2)[0].as_py()[1:]
                yield pa.RecordBatch.from_arrays([one.column(0), one.column(1), pa.array([good], pa.bool_())], names=["row", "ids", "good"])

    done = short.mapInArrow(run, f"row {kind}, ids array<int>, good boolean")
    long = _encode_long(rows.where(F.length("t") > chunk_chars), shared, chunk_chars, vocabulary.longest, proof is not None)
    long = long.mapInArrow(prove, f"row {kind}, ids array<int>, good boolean") if proof else long.withColumn("good", F.lit(True))
    extra = [F.col("good").alias(proof)] if proof else []
    return done.unionByName(long).select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(others)], F.col("ids").alias(name), *extra)


def _lists(ids: list[np.ndarray]) -> pa.ListArray:
    offsets = np.r_[0, np.cumsum([len(i) for i in ids])].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32)))


def _encode_long(rows: DataFrame, shared, chunk_chars: int, longest: int, with_text: bool) -> DataFrame:
    """Chunks: matrices in parallel, states per text, then each chunk traced back on its own."""
    text_id = F.sha2("t", 256)
    cut = F.lit(chunk_chars)
    n_chunks = F.ceil(F.length("t") / cut)
    chunks = (rows.select(text_id.alias("id"), "t").dropDuplicates(["id"])
              .select("id", "t", F.explode(F.sequence(F.lit(0), n_chunks.cast("int") - 1)).alias("no"))
              .select("id", "no", F.substring("t", F.col("no") * cut + 1, cut).alias("body"),
                      F.substring("t", (F.col("no") + 1) * cut + 1, F.lit(AHEAD_CHARS)).alias("ahead")))
    chunks = chunks.repartition("id", "no")

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(*shared.value))
        for batch in batches:
            out = [open_matrix(encoder, no, b, a) for no, b, a in zip(*[batch.column(i).to_pylist() for i in range(1, 4)])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["id", "no", "m"])

    def states(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("no")
        edges = settle_open([None if m is None else np.frombuffer(m, np.int64).reshape(longest, longest) for m in group["m"]])
        return pd.DataFrame({"id": group["id"], "no": group["no"], "enter": edges[:-1], "leave": edges[1:]})

    edges = (chunks.mapInArrow(weigh, "id string, no int, m binary").groupBy("id")
             .applyInPandas(states, "id string, no int, enter int, leave int"))

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(*shared.value))
        for batch in batches:
            out = [np.array(trace_between(encoder, *chunk), np.int32) for chunk in zip(*[batch.column(i).to_pylist() for i in range(1, 6)])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _lists(out)], names=["id", "no", "ids"])

    traced = chunks.join(edges, ["id", "no"]).select("id", "no", "body", "ahead", "enter", "leave").mapInArrow(trace, "id string, no int, ids array<int>")
    whole = (traced.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("no", "ids"))).alias("parts"))
             .select("id", F.flatten("parts.ids").alias("ids")))
    texts = ["t"] if with_text else []
    return rows.select("row", text_id.alias("id"), *texts).join(whole, "id").select("row", "ids", *texts)


def decode(rows: DataFrame, vocabulary: Vocabulary, ids: str = "ids", name: str = "text") -> DataFrame:
    """Op 1. The text of each row's ids, next to all columns of ``rows``. Null counts as no ids."""
    shared = _shared(rows.sparkSession, vocabulary)
    packed = rows.select(F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rows.columns)]).alias("row"), F.col(f"`{ids}`").alias("i"))
    kind = packed.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary(*shared.value)
        for batch in batches:
            step = 500
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                texts = [decode_ids(v, value or ()) for value in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["row", "t"])

    out = packed.mapInArrow(run, f"row {kind}, t string")
    return out.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(rows.columns)], F.col("t").alias(name))

"""Documents cut into chunks give the segments of the plain rule."""

import random
from functools import reduce

import numpy as np
import pytest

from plexus.operators import block_rows as B
from plexus.operators.block_rows import segment_block_rows
from plexus.operators.segments import count_tokens, pack_blocks


def rule(blocks, limit, overlap):
    n = len(blocks)
    return list(pack_blocks([b[0] for b in blocks], [b[1] for b in blocks], [b[2] for b in blocks], [b[3] for b in blocks],
                            [b[4] for b in blocks], limit, overlap, count_tokens()))


@pytest.mark.parametrize("limit,overlap,chunk", [(12, 4, 6), (12, 0, 30), (20, 15, 3), (12, 4, 1_000_000)])
def test_against_the_rule(spark, limit, overlap, chunk):
    rng = random.Random(limit + overlap)
    documents = {}
    for d, size in enumerate([1, 2, 0, 400, 35, 3, 7, 60]):
        documents[d] = [(" ".join(rng.choice("abcdefg") * rng.randint(1, 5) for _ in range(rng.choice([0, 0, 1, 2, 3, 5, 9, 11, 30]))),
                         rng.choice(["body", "list"]), rng.choice([None, None, f"a{i}"]), rng.choice([None, i]), rng.choice([None, None, "", f"t{i}"]))
                        for i in range(size)]
    rows = [(d, 3 * i, *b) for d, blocks in documents.items() for i, b in enumerate(blocks)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc int, position long, text string, kind string, anchor string, page_number int, title string").repartition(4)
    out = segment_block_rows(df, "doc", max_tokens=limit, overlap_tokens=overlap, clean_only=False, chunk=chunk)
    got = {}
    for r in out.orderBy("doc", "segment_number").collect():
        got.setdefault(r.doc, []).append((r.segment_number, r.text, r.n_tokens, r.kinds, r.anchor, r.page_number, r.first_page, r.title))
    for d, blocks in documents.items():
        want = [(n, s["text"], s["n_tokens"], s["kinds"], s["anchor"], s["page_number"], s["first_page"], s["title"])
                for n, s in enumerate(rule(blocks, limit, overlap))]
        assert got.get(d, []) == want, d


def test_blank_blocks(spark):
    """A long run of blocks without tokens lies in many chunks, and in one segment and the overlap of the next."""
    words = [(f"w{i} x{i} y{i}", "body", None, i, "a title" if i == 30 else None) for i in range(60)]
    blank = [("" if i % 3 else " ", "list", None, None, None) for i in range(20_000)]
    blocks = [*words[:31], *blank, *words[31:], *blank[:500]]
    df = spark.createDataFrame([("d", i, *b) for i, b in enumerate(blocks)], "doc string, position long, text string, kind string, anchor string, page_number int, title string")
    out = segment_block_rows(df.repartition(5), "doc", max_tokens=30, overlap_tokens=7, clean_only=False, start=1, chunk=100)
    got = [(r.segment_number, r.text, r.n_tokens, r.kinds, r.page_number, r.first_page, r.title) for r in out.orderBy("segment_number").collect()]
    want = rule(blocks, 30, 7)
    assert got == [(n, s["text"], s["n_tokens"], s["kinds"], s["page_number"], s["first_page"], s["title"]) for n, s in enumerate(want, 1)]
    assert max(len(s["text"]) for s in want) > 40_000
    kept = segment_block_rows(df, "doc", max_tokens=30, overlap_tokens=7, min_chars=60, chunk=100).orderBy("segment_number").collect()
    assert [r.segment_number for r in kept] == list(range(len(kept))) and 0 < len(kept) < len(want)


@pytest.mark.parametrize("seed", range(3))
def test_chunks_fold_like_the_rule(seed):
    """Maps of chunks composed in any grouping, and tails, lead to the same segments."""
    rng = random.Random(seed)
    for _ in range(300):
        limit = rng.choice([3, 12, 20])
        overlap = min(rng.choice([0, 2, 4, 11]), limit - 1)
        sizes = [rng.choice([0, 0, 0, 1, 2, 3, limit, limit - 1]) for _ in range(rng.randrange(1, 60))]
        pieces = [B.Piece(k, str(i), "b", None, None, None) for i, k in enumerate(sizes)]
        cut = rng.choice([1, 2, 5, 9])
        chunks = [pieces[i:i + cut] for i in range(0, len(pieces), cut)]
        tails, maps, found = [B.Tail([], [], [], True, None)], [], {}
        for c, chunk in enumerate(chunks):
            maps.append(tuple(x.astype(np.int64).tobytes() for x in B.transfer([p.k for p in chunk], tails[-1].k, limit, overlap)))
            tails.append(B.join_tails(overlap)(tails[-1], B.tail_of(chunk, c, overlap)))
        for c, chunk in enumerate(chunks):
            entry = (0, 0)
            if c:
                middle = rng.randrange(1, c + 1)
                halves = [reduce(B.compose, h) for h in (maps[:middle], maps[middle:c]) if h]
                entry = tuple(int(np.frombuffer(x, np.int64)[0]) for x in reduce(B.compose, halves))
            tail = tails[c]
            for s in B.walk(chunk, tail.k, *entry, None, c == len(chunks) - 1, limit, overlap):
                if s.reach is not None:
                    since, place = (tail.c[s.reach - 1], tail.i[s.reach - 1] + 1) if s.reach else (0, 0)
                    found[s.number] = [p.text for q in range(since, c) for p in chunks[q][place if q == since else 0:]]
                found.setdefault(s.number, []).extend(s.part.text.split("\n\n") if s.part.n else [])
        want = [s["text"].split("\n\n") for s in sizes_rule(sizes, limit, overlap)]
        assert [found[n] for n in sorted(found)] == want


def sizes_rule(sizes, limit, overlap):
    return list(pack_blocks([str(i) for i in range(len(sizes))], ["b"] * len(sizes), [None] * len(sizes), [None] * len(sizes), [None] * len(sizes), limit, overlap, lambda t: sizes[int(t)]))

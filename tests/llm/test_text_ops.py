import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from plexus.llm import html_extract
from plexus.llm import sentencepiece as sp
from plexus.llm.html_extract import blocks, extract_text, matching, merge, parse, skeleton
from plexus.llm.license_scan import TEMPLATES, align, license_scan, scan_text, telling, words_of
from plexus.llm.mixing import golden, golden_point, mix, mixed_documents, source_targets, taken_words
from plexus.llm.toxicity import Model, fitted, is_held_out, segments, toxicity


@pytest.fixture(scope="module")
def vocabulary():
    return sp.load_vocabulary()


def best_path(v, text):
    """Plain Viterbi over all pieces; the longer last piece wins a tie."""
    best = [0] + [None] * len(text)
    last = [0] * (len(text) + 1)
    for end in range(1, len(text) + 1):
        for n in range(min(v.longest, end), 0, -1):
            piece = v.pieces.get(text[end - n:end])
            score = piece[1] if piece else v.unknown if n == 1 else None
            if score is not None and (best[end] is None or best[end - n] + score > best[end]):
                best[end], last[end] = best[end - n] + score, n
    out, at = [], len(text)
    while at:
        out.append(text[at - last[at]:at])
        at -= last[at]
    return [i for p in reversed(out) for i in sp._ids(v, p)]


def test_encode_edge(edge, edge_texts, vocabulary):
    for chunk in (sp.CHUNK_CHARS, 1500):
        rows = sp.decode(sp.encode(edge, vocabulary, chunk_chars=chunk), vocabulary).select("doc_id", "ids", "text").collect()
        assert Counter((r.doc_id, r.text) for r in rows) == Counter((i, t or "") for i, t in edge_texts)
        for r in rows:
            assert list(r.ids) == (best_path(vocabulary, " " + r.text) if r.text else [])


def test_encode_agrees_with_the_library(vocabulary):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb
    model = pb.ModelProto()
    with open(sp.MODEL, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1  # the same pieces and scores as a unigram lattice
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    encoder = sp.Encoder(vocabulary)
    score = lambda ids: sum(vocabulary.scores[i] for i in ids)
    for text in ("the quick brown fox", "Licensed under", "eringing thbleing ones", "über Straße", "été à la"):
        mine, best = encoder.encode(" " + text), max(library.nbest_encode_as_ids(text, 20), key=score)  # its one-best search is not exact
        assert score(mine) == score(best) and library.decode(mine) == text


@pytest.mark.parametrize("size", [1, 3, 10, 40])
def test_chunks_give_a_best_path(vocabulary, size):
    r = random.Random(size)
    encoder = sp.Encoder(vocabulary)
    for _ in range(60):
        text = "".join(r.choice("theinaor▁é " if size > 3 else "theinaor") for _ in range(r.randint(1, 90)))
        parts = [(text[k:k + size], text[k + size:k + size + sp.AHEAD_CHARS]) for k in range(0, len(text), size)]
        full = sp.settle([sp.chunk_matrix(encoder, b, a) for b, a in parts])
        some = [sp.open_matrix(encoder, n, b, a) for n, (b, a) in enumerate(parts)]
        states = sp.settle_open([m and np.frombuffer(m, np.int64).reshape(vocabulary.longest, -1) for m in some])
        assert len(full) == len(states) == len(parts) + 1
        ids = [i for n, ((b, a), s, e) in enumerate(zip(parts, states, states[1:])) for i in sp.trace_between(encoder, n, b, a, s, e)]
        best = best_path(vocabulary, text)
        total = lambda x: sum(vocabulary.scores[i] for i in x)
        assert total(ids) == total(best) and sp.decode_ids(vocabulary, ids) == sp.decode_ids(vocabulary, best)


def test_max_plus_is_associative():
    r = np.random.default_rng(2)
    a, b, c = (r.integers(-50, 0, (6, 6)) for _ in range(3))
    assert (sp.max_plus(sp.max_plus(a, b), c) == sp.max_plus(a, sp.max_plus(b, c))).all()


def brute_segments(scores):
    """Maximal segments by definition: the best one, then the same to its left and right."""
    out = []

    def look(lo, hi):
        best = None
        for i in range(lo, hi):
            total = 0
            for j in range(i, hi):
                total += scores[j]
                if total > 1e-12 and (best is None or total > best[0] + 1e-12):
                    best = (total, i, j)
        if best:
            out.append(best)
            look(lo, best[1])
            look(best[2] + 1, hi)
    look(0, len(scores))
    return sorted(out, key=lambda s: s[1])


@pytest.mark.parametrize("seed", range(8))
def test_segments(seed):
    r = random.Random(seed)
    n = r.randint(1, 60)
    hits = {i: r.choice([1.1, 2.3, 3.7, 5.9]) + r.random() for i in range(n) if r.random() < 0.3}
    got = segments(list(hits), list(hits.values()), drift=0.6)
    want = brute_segments([hits.get(i, -0.6) for i in range(n)])
    assert [(f, l) for _, f, l in got] == [(f, l) for _, f, l in want]
    assert all(math.isclose(a[0], b[0], abs_tol=1e-9) for a, b in zip(got, want))


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity(docs, fitted(docs, labels)).join(labels, "doc_id").where(is_held_out()).select("toxic", (F.col("score") >= 0.7).alias("p")).collect()
    hit = sum(1 for r in got if r.toxic and r.p)
    assert hit >= 0.7 * sum(r.toxic for r in got) and hit >= 0.9 * sum(r.p for r in got)


def test_toxicity_edge(spark, edge, empty):
    model = Model({"w7": 4.0, "w8": 4.0}, slope=2.0, offset=-2.0)
    rows = toxicity(edge, model, edge.columns, score="chance").collect()
    assert len(rows) == edge.count() and all(0 <= r.chance <= 1 for r in rows)
    assert len({r.chance for r in rows if not r.text}) == 1
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert toxicity(empty, fitted(empty, none)).count() == 0
    assert {r.score < 0.7 for r in toxicity(edge, fitted(edge, none)).collect()} == {True}
    odd = spark.createDataFrame([(None, 1), (2, None), (3, 1), (3, 0), (4, 0)], "doc_id bigint, toxic int")
    assert toxicity(edge, fitted(edge, odd)).count() == edge.count()


PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<main><article class="post"><header><h1>Head &amp; line</h1></header><p>One <b>bold</b>
 text&nbsp;here<br>next<p>Two &lt;b&gt; &copy x</p><ul><li>a<li>b</ul><aside>related</aside><div class="ad">buy</div><form>mail <input></form>
<section id="comments"><p>me too</p></section><!-- c --></article></main><footer>&copy; site</footer>"""


def test_blocks():
    assert blocks(parse(PAGE)) == ["Head & line", "One bold text here next", "Two <b> © x", "a", "b"]
    assert blocks(parse("")) == [] and blocks(parse("plain <i>text</i>")) == ["plain text"]
    assert blocks(parse("<div>" * 5000 + "deep" + "</div>" * 3)) == ["deep"]
    assert blocks(parse("<p>a</div></p>b<article>c")) == ["c"]


@pytest.mark.parametrize("mark", ["article", "main", "div"])
def test_ids_made_from_headings(mark):
    page = f"""<{mark}><h1 id="notice">A</h1><h2 id="social-history">B</h2><p>b</p><section id="related-work"><h2>C</h2><p>c</p></section><h2 id="share-of-imports">D</h2>
        <p id="notice-to-readers">d</p><div class="section" id="comment-on-method"><p>e</p></div><div id="cookie-notice">x</div><div class="ad">x</div>
        <div class="box share">x</div><section id="comments">x</section><p class="share-widget">x</p></{mark}>"""
    assert blocks(parse(page)) == ["A", "B", "b", "C", "c", "D", "d", "e"]
    assert blocks(parse("<div class='sidebar-left'>x</div><h2 id='footer-notes'>F</h2><p>f</p><div class='site-footer'>x</div>")) == ["F", "f"]


def test_template_alignment():
    def page(k, extra=""):
        return skeleton([parse(f"<div>Subscribe now</div>{extra}<h1>Title {k}</h1><p>text {k}</p><p>more {k}</p>")])
    whole = page(0)
    for k in range(1, 12):
        whole = merge(whole, page(k, "<ul><li>x</li></ul>" if k % 3 == 0 else ""))
    assert whole[1] == 12 and [c[0] for c in whole[3]] == ["div", "ul", "h1", "p"]
    assert [c[1] for c in whole[3]] == [12, 3, 12, 12]
    assert matching(page(1), page(2))[0] == 4
    assert blocks(parse("<div>Subscribe now</div><h1>Title 3</h1><p>text 3</p><p>more 3</p>"), whole) == ["Title 3", "text 3", "more 3"]


@pytest.mark.parametrize("most", [32 << 20, 0])
def test_extract_edge(spark, monkeypatch, most):
    monkeypatch.setattr(html_extract, "BROADCAST_BYTES", most)
    schema = "page_id bigint, url string, html string, host string, row string, text string"
    rows = [(1, "http://a.b/x", PAGE, "h", "r", "t"), (2, None, PAGE, None, None, None), (3, "not a url", None, "h", "r", "t"), (None, "http://U@A.b:80/y", "", "h", "r", "t"),
            (1, "http://a.b/x", PAGE, "h", "r", "t"), (4, "http://a.b/z", "<p>" + "long " * 50000, "h", "r", "t")]
    got = extract_text(spark.createDataFrame(rows, schema)).collect()
    full = "\n".join(blocks(parse(PAGE)))
    assert Counter((r.page_id, r.text) for r in got) == Counter({(1, full): 2, (2, full): 1, (3, ""): 1, (None, ""): 1, (4, ("long " * 50000).strip()): 1})
    assert extract_text(spark.createDataFrame([], schema)).count() == 0


def test_align_is_a_common_subsequence():
    r = random.Random(4)
    for _ in range(50):
        template = [r.choice("abcdefgh") for _ in range(12)]
        text = [w for w in template if r.random() < 0.8]
        for _ in range(3):
            text.insert(r.randrange(len(text) + 1), "z")
        pairs = align(text, template)
        assert all(text[a] == template[b] for a, b in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))


def test_license_planted(spark, edge, empty):
    parsed = {n: words_of(t) for n, t in TEMPLATES.items()}
    filler = " ".join(f"v{k}" for k in range(30000))
    for name, text in TEMPLATES.items():
        found = scan_text(f"{filler} {text} {filler} {text.upper()}", parsed)
        assert [m[0] for m in found].count(name) == 2 and all(m[1] == 1.0 for m in found if m[0] == name)
    assert scan_text(filler, parsed) == [] and scan_text("", parsed) == []
    words = TEMPLATES["MIT permission"].split()
    assert scan_text(" ".join(w for k, w in enumerate(words) if k % 8), parsed)[0][0] == "MIT permission"
    assert license_scan(edge).count() == 0 and license_scan(empty).count() == 0
    one = spark.createDataFrame([(5, "x\nReleased under the MIT License."), (None, "Released under the MIT License"), (6, None)], "doc_id bigint, text string")
    assert sorted((r.doc_id or 0, r.license, r.first_word) for r in license_scan(one).collect()) == [(0, "MIT", 0), (5, "MIT", 1)]


def test_license_copies_close_together():
    parsed = {n: words_of(t) for n, t in TEMPLATES.items()}
    listed = scan_text("\n".join(f"pkg{k} Released under the MIT License" for k in range(300)), parsed)
    assert listed == [("MIT", 1.0, 6 * k + 1, 6 * k + 5) for k in range(300)]
    r = random.Random(5)
    for _ in range(60):  # whole notices, or with one word lacking that tells nothing, with few words or none between
        words, want = [], []
        name = r.choice(sorted(parsed))
        for _ in range(r.randint(2, 8)):
            copy, must = list(parsed[name]), telling(name, parsed[name])
            words += [f"v{r.randrange(99)}" for _ in range(r.randrange(3))]
            if len(copy) >= 15 and name != "Apache-2.0 notice" and r.random() < 0.5:  # whose beginning alone would fit better
                del copy[r.choice([k for k, w in enumerate(copy[1:-1], 1) if w not in must])]
            want.append((name, len(copy) / len(parsed[name]), len(words), len(words) + len(copy) - 1))
            words += copy
        assert sorted(scan_text(" ".join(words), parsed), key=lambda m: m[2]) == want


@pytest.mark.parametrize("text,names", [
    ("Licensed under CC BY 4.0", ["CC-BY-4.0"]), ("Licensed under CC BY 3.0", []), ("Licensed under CC BY-NC-ND 4.0", []), ("Licensed under CC BY-NC 4.0", ["CC-BY-NC-4.0"]),
    ("Licensed under CC BY-ND 4.0", []), ("Released under the BSD License", []), ("Licensed under the Apache License, Version 1.0", []),
    ("This work is licensed under the GNU Lesser General Public License, version 3", []), ("This work is licensed under the GNU General Public License, version 2", []),
    (TEMPLATES["GPL notice"].replace("GNU General", "GNU Lesser General"), []), (TEMPLATES["GPL notice"].replace("version 3", "version 2"), ["GPL notice"])])
def test_license_told_apart(text, names):
    assert [m[0] for m in scan_text(f"a b {text} c d", {n: words_of(t) for n, t in TEMPLATES.items()})] == names


def targets(sizes, share=1.5, most=2):
    """Shares by weight, the excess over a cap given out again until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total, capped, out = share * sum(sizes.values()), set(), {}
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(most * sizes[s] for s in capped)
        out = {s: most * sizes[s] if s in capped else rest * weight[s] / sum(weight[x] for x in free) for s in names}
        over = {s for s in free if out[s] > most * sizes[s] + 1e-9}
        if not over:
            return out
        capped |= over


def test_targets_and_taken(edge, edge_texts):
    rows = taken_words(edge).collect()
    sizes = Counter()
    for r in rows:
        sizes[r.source] += r.size
    want = targets(sizes)
    taken = Counter()
    for r in rows:
        taken[r.source] += r.taken
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source], abs_tol=1e-6) and 0 <= r.taken <= 2 * r.size
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in want)
    assert Counter(map(tuple, rows)) == Counter(map(tuple, taken_words(edge.repartition(5)).collect()))


def test_schedule_is_even(spark):
    assert math.isclose(golden(), (math.sqrt(5) - 1) / 2) and math.isclose(golden(3), 3 * golden() % 1)
    points = [r[0] for r in spark.range(5_000_000, 5_000_100).select(golden_point(F.col("id"))).collect()]
    assert all(math.isclose(p, golden(5_000_000 + k), abs_tol=1e-6) for k, p in enumerate(points))
    docs = spark.createDataFrame([(k, f"s{k % 4}", 100 + k) for k in range(400)], "doc_id bigint, source string, size bigint")
    pieces, laid = mix(docs, block_tokens=64)
    rows = pieces.select("slot", "no", "n_words").collect()
    whole = Counter()
    for r in rows:
        whole[r.no] += r.n_words
    half = len({r.slot for r in rows}) // 2
    part = Counter()
    for r in rows:
        if r.slot <= half:
            part[r.no] += r.n_words
    assert all(abs(part[s] - whole[s] / 2) < 64 * 20 for s in whole)  # any stretch of the schedule has the mixture
    assert laid.count() == 400


def test_mixed_documents(spark, edge, empty):
    out = mixed_documents(edge)
    assert out.columns == edge.columns
    words = {r.source: r.n for r in out.groupBy("source").agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))).alias("n")).collect()}
    quotas = {r.source: r.quota for r in source_targets(edge.select("source", F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("size"))).collect()}
    repeated = 400  # rows that repeat an id are taken alike
    largest = {r.source: r.n for r in edge.groupBy("source").agg(F.max(F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))).alias("n")).collect()}
    assert all(abs(words.get(s, 0) - q) <= repeated + largest[s] / 2 for s, q in quotas.items())  # the one at the quota comes whole or not
    assert {r.text for r in out.collect()} <= {r.text for r in edge.collect()}
    assert mixed_documents(empty).count() == 0 and taken_words(empty).count() == 0

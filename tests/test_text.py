import math
import random

import pytest
from pyspark.sql import functions as F

from plexus.functions import scalars as G
from plexus.functions import text as X
from plexus.operators import documents as D
from plexus.operators import segments as S
from plexus.operators.html_blocks import html_blocks, parse_selector


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def texts(html, **kw):
    return [(b["kind"], b["text"], b["anchor"]) for b in html_blocks(html, **kw)[0] if b["type"] == "text"]


def test_outermost_elements_and_joined_text():
    html = "<title> T </title><div id=a>x <p> y </p><b>z</b></div><p>one<p>two</p></p><li>l</li><h2 name=n>h</h2><td>no</td>"
    assert texts(html) == [("body", "xyz", "a"), ("body", "onetwo", "a"), ("list", "l", "a"), ("title", "h", "n")]
    assert html_blocks(html)[0][0]["title"] == "T"


def test_unclosed_and_stray_tags():
    assert texts("<p>a<br>b</i></p>c<p>d") == [("body", "ab", None), ("body", "d", None)]
    assert texts("<ul><li>a<li>b</ul><p>c") == [("list", "ab", None), ("body", "c", None)]
    assert texts("</p><p> </p><p>x &amp; y&nbsp;</p>") == [("body", "x & y", None)]


def test_text_that_is_no_text():
    assert texts("<div>a<script>var p='</p>';</script><style>x</style><!-- c -->b</div>") == [("body", "ab", None)]


def images(html):
    return [(b["image_url"], b["alt"], b["caption"], b["anchor"]) for b in html_blocks(html)[0] if b["type"] == "image"]


def test_images_wait_for_their_caption():
    html = '<img src=a><p>t</p><img src=b alt=B id=i><img src=c><figcaption>C</figcaption><figcaption>D</figcaption><img alt=none>'
    assert images(html) == [("b", "B", None, "i"), ("c", None, "C", "i")]
    assert [t for _, t, _ in texts(html)] == ["t", "C", "D"]
    order = [b["type"] for b in html_blocks("<img src=a alt=x><p>t</p>")[0]]
    assert order == ["text", "image"]
    assert images("<div><img src=a alt=x></div>") == []


def test_selector():
    html = "<p>out</p><main class='a b'><p id=q>in</p><article><p>deep</p></article></main>"
    for css, want in (("main", ["in", "deep"]), (".b article", ["deep"]), ("article, main", ["in", "deep", "deep"]),
                      ("main.a", ["in", "deep"]), ("#q", [])):
        assert [t for _, t, _ in texts(html, selector=parse_selector(css))] == want
        assert html_blocks(html, parse_selector(css))[1]
    blocks, hit = html_blocks(html, parse_selector("nav"))
    assert not hit and len(blocks) == 3
    with pytest.raises(ValueError):
        parse_selector("p:first-child")


def words(text):
    return len(text.split())


def simple(texts, limit, overlap):
    """Segments by the rule, written as plainly as possible."""
    out, buffer = [], []
    for t in texts:
        if buffer and sum(map(words, buffer)) + words(t) > limit:
            out.append("\n\n".join(buffer))
            keep = []
            for b in reversed(buffer):
                if sum(map(words, keep)) + words(b) > overlap:
                    break
                keep.insert(0, b)
            buffer = keep
        buffer.append(t)
    return out + (["\n\n".join(buffer)] if buffer else [])


def test_packing_against_the_plain_rule():
    rng = random.Random(1)
    for _ in range(200):
        blocks = [" ".join(["w"] * rng.randint(1, 12)) for _ in range(rng.randint(0, 40))]
        n = len(blocks)
        made = list(S.pack_blocks(blocks, ["body"] * n, [None] * n, [None] * n, [None] * n, 12, rng.choice([0, 3, 8]), words))
        assert [m["n_tokens"] for m in made] == [words(m["text"]) for m in made]
    for overlap in (0, 3, 8):
        blocks = [" ".join(["w"] * rng.randint(1, 12)) for _ in range(60)]
        made = [m["text"] for m in S.pack_blocks(blocks, ["body"] * 60, [None] * 60, [None] * 60, [None] * 60, 12, overlap, words)]
        assert made == simple(blocks, 12, overlap)


def test_overflow_after_overlap_is_kept():
    blocks = ["a " * 4, "b " * 4, "c " * 10]
    made = [m["n_tokens"] for m in S.pack_blocks(blocks, ["x"] * 3, [None] * 3, [None] * 3, [None, "T", "U"], 10, 4, words)]
    assert made == [8, 14]


def test_split_long():
    assert S.split_long("a b\n\nc d\n\ne f", 4, words) == ["a b\n\nc d", "e f"]
    assert S.split_long("a b c d e f\ng", 3, words) == ["a b c", "d e f", "g"]
    assert S.split_long("xxxx", 2, len) == ["xx", "xx"]
    rng = random.Random(3)
    for _ in range(100):
        text = "".join(rng.choice(["w", " ", "\n", "\n\n", "v "]) for _ in range(rng.randint(1, 300)))
        chunks = S.split_long(text, 5, words)
        assert all(0 < words(c) <= 5 for c in chunks) and "".join("".join(chunks).split()) == "".join(text.split())


def test_segment_rows(spark):
    d = spark.createDataFrame([(1, b"<h1 id=top>Title here</h1><p>" + b"word " * 40 + b"</p>", "http://x/y"), (2, b"", "http://x/z")],
                              "doc_id long, html binary, url string")
    segments = S.segment(D.extract_blocks_html(d), "doc_id", max_tokens=30, overlap_tokens=5, url="url").collect()
    assert [r.segment_number for r in segments] == [0, 1]
    # "Title here" alone is no clean segment; as overlap it lifts the next one above the limit
    assert segments[0].kinds == "body,title" and segments[0].segment_url == "http://x/y#top" and segments[0].n_tokens == 32
    again = S.segment_rows(S.segment(D.extract_blocks_html(d), "doc_id", url="url"), "doc_id", "r", "s")
    assert again.select("_uniqueid").collect() == again.select("_uniqueid").collect()


def test_clean(spark):
    cases = {"": False, "short": False, "a readable sentence of text": True, "--- *** --- *** --- *** a": False, "abab" * 20: False,
             "abcde" * 10: True, "\U0001F600" * 10 + "abcdefghijklmnopqrst": False, "text �" * 10: True, "x" + "�" * 5 + "abcdefghijklmno": False,
             " " * 30 + "short": False, "é" * 30: False, "aaaaaaaaaaaaaaaaaaaa" * 5 + "bcde": True}
    df = spark.createDataFrame(list(cases), "string")
    got = {r.value: r.c for r in df.select("value", X.is_clean("value").alias("c")).collect()}
    assert got == cases
    assert one(spark, X.is_clean(F.lit("abcde"), min_chars=0))
    assert one(spark, X.is_clean(F.lit(None).cast("string"))) is False


def test_bleu():
    a = "the cat is on the mat".split()
    assert X.bleu(a, a) == pytest.approx(1.0)
    assert X.bleu(a, "dogs run".split()) == 0.0
    assert X.bleu([], a) == 0.0 and X.bleu(["x"], ["x"]) == 1.0
    # one word of two: p1 = 1/2, then ln(2)/(2*5)/1, ln(2)/(4*5)/1, ln(2)/(8*5)/1
    p = [0.5, math.log(2) / 10, math.log(2) / 20, math.log(2) / 40]
    assert X.bleu(["a", "b"], ["a", "c"]) == pytest.approx(math.exp(sum(map(math.log, p)) / 4))
    # brevity: candidate of 3, reference of 4
    assert X.bleu("a b c d".split()[:3], "a b c d".split()) == pytest.approx(
        math.exp((0 + 0 + 0 + math.log(math.log(3) / 10)) / 4) * math.exp(1 - 4 / 3))


def test_score_functions(spark):
    df = spark.createDataFrame([("Hello, World", "hello world"), (None, "x"), ("abc", "")], "h string, r string")
    rows = df.select(X.word_bleu("h", "r").alias("w"), X.char_bleu("h", "r").alias("c"), G.jaccard_chars("h", "r").alias("j")).collect()
    # two words: the two longer orders have no n-grams and are smoothed
    assert rows[0].w == pytest.approx(math.exp((math.log(math.log(2) / 10) + math.log(math.log(2) / 20)) / 4))
    assert rows[0].c == pytest.approx(1.0) and rows[1].w is None and rows[2].w == 0.0 and rows[2].j == 1.0


def test_scalars(spark):
    lit = F.lit
    cases = [
        (G.content_type_main(lit("text/html; charset=UTF-8")), "text/html"),
        (G.content_type_params(lit('text/html; Charset="utf-8"; a=1; A=2')), {"charset": "utf-8", "a": "2"}),
        (G.mime_from_path(lit("dir.x/file")), None), (G.mime_from_path(lit("a/B.JPG")), "image/jpeg"),
        (G.max_age(lit("public, max-age=60, x")), 60), (G.max_age(lit("max-age=0")), None), (G.max_age(lit("s-maxage=9")), None),
        (G.url_domain(lit("http://h:80/p")), "h:80"), (G.url_domain(lit("http://[bad")), None),
        (G.capitalize(lit("tHE cat")), "The cat"), (G.capitalize(lit("")), ""),
        (G.url_tail_id(lit("http://x/y/123_ab_o.jpg")), "123"), (G.iso_date(lit("2013-11-14 17:02:52")), "2013-11-14T17:02:52"),
        (G.box_clamp(lit(-3.7)), 1), (G.box_clamp(lit(0.9)), 1), (G.box_clamp(lit(2.9)), 2), (G.box_floor(lit(-3.7)), 0),
        (G.polygon_pairs(F.array(lit(1.0), lit(2.0), lit(3.0), lit(4.0)), 0.5, 0.0, 2.0), [[2.5, 4.0], [6.5, 8.0]]),
        (G.polygon_pairs(F.array().cast("array<double>")), []), (G.feature_id(lit(3), lit(5)), 197),
        (G.anchor_url(lit("u"), lit("a"), lit(2)), "u#a"), (G.anchor_url(lit("u"), lit(None), lit(2)), "u#page=2"),
        (G.anchor_url(lit("u"), lit(""), lit(0)), "u"), (G.valid_json(lit('{"a": [1, 2]}')), True), (G.valid_json(lit("1, 2")), False),
        (G.valid_json(lit('{"a": 1}}')), False), (G.valid_json(lit("1],[2")), False), (G.valid_json(lit("")), False), (G.valid_json(lit("null")), True),
        (G.glob_match(lit("a.b_c"), "a.*"), True), (G.glob_match(lit("axb"), "a.b"), False), (G.glob_match(lit("file1"), "file[!0]"), True),
        (G.resource_key("p", lit(1)), "b2fe5f7bb8bb8c6b5f8f5c7f5c6e31a8") if False else (F.length(G.resource_key("p", lit(1))), 40),
        (G.typed_value(lit("x"), "number"), None), (G.typed_value(lit("t"), "boolean"), True), (G.typed_value(lit("[1]"), "json"), "[1]"),
    ]
    row = spark.range(1).select(*[c.alias(f"c{i}") for i, (c, _) in enumerate(cases)]).first()
    assert [row[i] for i in range(len(cases))] == [w for _, w in cases]
    for kind, value in (("number", "x"), ("json", "{"), ("boolean", "maybe"), ("datetime", "soon")):
        with pytest.raises(Exception):
            one(spark, G.typed_value(lit(value), kind, strict=True))


def test_http_date(spark):
    dates = ["Wed, 21 Oct 2015 07:28:00 GMT", "Wed, 1 Oct 2015 07:28:00 +0200", "1 Jan 2020 00:00:00 UTC", "yesterday"]
    df = spark.createDataFrame(dates, "string").select(F.date_format(G.http_date("value"), "yyyy-MM-dd HH:mm:ss").alias("d"))
    assert [r.d for r in df.collect()] == ["2015-10-21 07:28:00", "2015-10-01 05:28:00", "2020-01-01 00:00:00", None]


def test_dispatch_and_errors(spark):
    d = spark.createDataFrame([(1, b"<p>x</p>", "text/html"), (2, b"a\xff", "text/plain; charset=x"), (3, b"p1\x0c\x0cp3", "application/pdf"),
                               (4, b"", "image/png"), (5, b"", None)], "k int, body binary, content_type string")
    blocks, errors = D.dispatch_by_type(d, "k")
    rows = {(r.k, r.text, r.page_number) for r in D.block_rows(blocks, "k").collect()}
    assert rows == {(1, "x", None), (2, "a�", None), (3, "p1", 1), (3, "p3", 3)}
    assert {r.k: r.error for r in errors.collect()} == {4: "Unsupported content type: image/png", 5: "Unsupported content type: none"}


def test_links(spark):
    pages = spark.createDataFrame([("http://a.com/d/p", '<a href="../x">1</a><a href="http://b.com/">2</a><a href="/y#f">3</a><area href=z><a href="mailto:q">'
                                    '<a href="http://[x">')], "url string, html string")
    got = {r.url for r in D.link_frontier(pages, spark.createDataFrame([("http://a.com/y",)], "url string"), pages.select("url")).collect()}
    assert got == {"http://a.com/x", "http://a.com/d/z"}


def test_responses(spark):
    schema = "status int, url string, referrer string, content_type string, last_modified string, etag string, cache_control string"
    df = spark.createDataFrame([(200, "http://h:8/x", None, "", "bad", "", "max-age=0"), (404, "http://h/n", None, None, None, None, None)], schema)
    row = D.responses_to_documents(df).first()
    assert (row.domain, row.content_type, row.last_modified, row.etag, row.cache_control_max_age) == ("h:8", None, None, None, None)
    assert [tuple(r) for r in D.error_urls(df).collect()] == [(404, "http://h/n", "None")]

"""Main text of pages by wrapper induction: same-host pages are aligned, what varies is content."""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plexus.llm.common import save

MIN_PAGES = 10      # pages of a host before a constant text counts as template
CONSTANT = 0.9      # share of a host's pages that have one text in a place
BROADCAST_BYTES = 32 << 20
SALTS = 32
DEPTH = 24          # levels of a page that take part in a template
KEPT_TEXTS = 4      # frequent texts remembered per place
_SPACES = re.compile(r"\s+")
_NAME = re.compile(r"[a-z0-9]+")

# Elements of HTML, and names that page authors give to what is not the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
NEVER = frozenset("head nav footer aside form script style noscript template iframe svg math button select textarea input dialog menu canvas "
                  "object embed video audio map".split())
CLOSES_P = frozenset("address article aside blockquote center details dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
                     "hr main menu nav ol p pre section table ul".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table article section div body main aside nav select".split())
NAMES = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored banner cookie cookies consent notice notices alert nav navbar "
                  "navigation menu breadcrumb breadcrumbs sidebar widget comment comments disqus share sharing social related promo newsletter "
                  "subscribe popup modal skip".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
OUTER_NAMES = frozenset("header footer masthead".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu".split())


class Node:
    __slots__ = ("tag", "names", "out", "children")

    def __init__(self, tag: str, names: str = "", out: bool = False) -> None:
        self.tag, self.names, self.out, self.children = tag, names, out, []


def _named(tag: str, classes: str, id_: str, inside: bool) -> bool:
    """Do the names of an element say that it is not the article?

    An id, and inside an article a class, counts if all of its words do: ids are often made from headings
    ("social-history"), which for that reason never go by their id. Outside one word of a class is enough.
    """
    def all_of(name: str) -> bool:
        words = _NAME.findall(name)
        return bool(words) and NAMES.issuperset(words)

    by_class = any(map(all_of, classes.split())) if inside else not NAMES.isdisjoint(_NAME.findall(classes))
    return by_class or tag not in HEADINGS and all_of(id_)


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("html")
        self.stack = [self.root]

    def _close(self, tags: set[str] | frozenset[str], scope: frozenset[str]) -> None:
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag in tags:
                del self.stack[k:]
                return
            if self.stack[k].tag in scope:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ("html", "body"):
            return
        if tag in CLOSES_P:
            self._close({"p"}, SCOPES)
        if tag in SIBLINGS:
            self._close(SIBLINGS[tag], SCOPES)
        a = {k: v or "" for k, v in attrs}
        names = f"{a.get('class', '')} {a.get('id', '')}".strip().lower()
        found = set(_NAME.findall(names))
        inside = any(n.tag in ("article", "main") for n in self.stack)
        out = _named(tag, a.get("class", "").lower(), a.get("id", "").lower(), inside) or a.get("role", "").lower() in ROLES or "hidden" in a or a.get("aria-hidden", "").lower() == "true"
        node = Node(tag, names, out)
        if found & OUTER_NAMES or tag == "header":  # of the page, not of its article
            node.out = out or not inside and (tag not in HEADINGS or bool(set(_NAME.findall(a.get("class", "").lower())) & OUTER_NAMES))
        self.stack[-1].children.append(node)
        if tag not in VOID:
            self.stack.append(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.stack[-1].tag == tag and tag in ("svg", "path", "script", "iframe"):
            self.stack.pop()

    def handle_endtag(self, tag: str) -> None:
        if tag in ("html", "body"):
            return
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag == tag:
                del self.stack[k:]
                return

    def handle_data(self, data: str) -> None:
        self.stack[-1].children.append(data)


def parse(html: str) -> Node:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


def host(url: str = "url") -> Column:
    """Host of a URL in lower case, without user and port; empty if there is none."""
    place = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    return F.lower(F.regexp_replace(F.regexp_replace(place, r"^.*@", ""), r":\d*$", ""))


# A template is [label, pages, {text hash: pages}, children]; runs of siblings with one label are one place.

def _label(node: Node) -> str:
    return f"{node.tag}.{node.names}" if node.names else node.tag


def _own_text(nodes: list[Node]) -> str:
    """Text of nodes outside of their block elements."""
    out, stack = [], [c for n in reversed(nodes) for c in reversed(n.children)]
    while stack:
        c = stack.pop()
        if isinstance(c, str):
            out.append(c)
        elif c.tag in INLINE:
            out.append(" ")
            stack.extend(reversed(c.children))
    return _SPACES.sub(" ", "".join(out)).strip()


def _places(nodes: list[Node]) -> list[list[Node]]:
    """Block children of a place: neighbours with one label together."""
    runs: list[list[Node]] = []
    for c in (c for n in nodes for c in n.children):
        if isinstance(c, str) or c.tag in INLINE:
            continue
        if runs and _label(runs[-1][-1]) == _label(c):
            runs[-1].append(c)
        else:
            runs.append([c])
    return runs


def skeleton(nodes: list[Node], depth: int = DEPTH) -> list:
    text = _own_text(nodes)
    texts = {xxhash.xxh64_intdigest(text): 1} if text else {}
    children = [skeleton(run, depth - 1) for run in _places(nodes) if run[0].tag not in NEVER] if depth else []
    return [_label(nodes[0]), 1, texts, children]


def _size(t: list) -> int:
    return 1 + sum(map(_size, t[3]))


def matching(a: list, b: list) -> tuple[int, list[tuple[int, int]]]:
    """Simple tree matching: the largest number of nodes paired in order, and the pairs of children."""
    if a[0] != b[0]:
        return 0, []
    x, y = a[3], b[3]
    if [c[0] for c in x] == [c[0] for c in y] and len({c[0] for c in x}) == len(x):
        return 1 + sum(matching(c, d)[0] for c, d in zip(x, y)), [(k, k) for k in range(len(x))]
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    score = [[matching(c, d)[0] for d in y] for c in x]
    for i in range(len(x)):
        for j in range(len(y)):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + score[i][j])
    pairs, i, j = [], len(x), len(y)
    while i and j:
        if score[i - 1][j - 1] and best[i][j] == best[i - 1][j - 1] + score[i - 1][j - 1]:
            pairs.append((i - 1, j - 1))
            i, j = i - 1, j - 1
        elif best[i][j] == best[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return 1 + best[-1][-1], pairs[::-1]


def merge(a: list, b: list) -> list:
    """Two templates of one host as one: paired nodes add up, the others are put in where they stand."""
    texts = dict(a[2])
    for k, n in b[2].items():
        texts[k] = texts.get(k, 0) + n
    if len(texts) > KEPT_TEXTS:
        texts = dict(sorted(texts.items(), key=lambda kn: (-kn[1], kn[0]))[:KEPT_TEXTS])
    pairs = dict(matching(a, b)[1])
    back = {j: i for i, j in pairs.items()}
    children, j = [], 0
    for i, c in enumerate(a[3]):
        if i in pairs:
            children += [d for k, d in enumerate(b[3][j:pairs[i]], j) if k not in back]
            children.append(merge(c, b[3][pairs[i]]))
            j = pairs[i] + 1
        else:
            children.append(c)
    children += b[3][j:]
    return [a[0], a[1] + b[1], texts, children]


def constants(page: list[Node], template: list | None, depth: int = DEPTH) -> set[int]:
    """Places of a page (by the identity of their nodes) whose text the host's pages share."""
    found: set[int] = set()
    if template is None or template[1] < MIN_PAGES:
        return found
    todo = [(page, skeleton(page, depth), template)]
    while todo:
        nodes, own, model = todo.pop()
        if own[2] and max((model[2].get(k, 0) for k in own[2]), default=0) >= CONSTANT * template[1]:
            found.update(map(id, nodes))
        runs = [r for r in _places(nodes) if r[0].tag not in NEVER]
        todo += [(runs[i], own[3][i], model[3][j]) for i, j in matching(own, model)[1]]
    return found


def _has(root: Node, tags: tuple[str, ...]) -> list[Node]:
    """Outermost elements of these tags that are not left out."""
    out, stack = [], [root]
    while stack:
        n = stack.pop()
        if n.tag in tags and not n.out:
            out.append(n)
        elif not n.out and n.tag not in NEVER:
            stack.extend(c for c in reversed(n.children) if not isinstance(c, str))
    return out


def blocks(root: Node, template: list | None = None) -> list[str]:
    """Text blocks of the content in page order."""
    constant = constants([root], template)
    heads = _has(root, ("article",)) or _has(root, ("main",)) or [root]
    out: list[str] = []
    line: list[str] = []

    def end() -> None:
        text = _SPACES.sub(" ", "".join(line)).strip()
        line.clear()
        if text:
            out.append(text)

    for head in heads:
        stack: list = [(head, False)]
        while stack:
            item, silent = stack.pop()
            if item is None:
                end()
            elif isinstance(item, str):
                if not silent:
                    line.append(item)
            elif item.tag == "br":
                line.append(" ")
            elif item.out or item.tag in NEVER:
                if item.tag not in INLINE:
                    end()
            else:
                if item.tag not in INLINE:
                    end()
                    stack.append((None, False))
                    silent = id(item) in constant
                stack.extend((c, silent) for c in reversed(item.children))
        end()
    return out


def templates(pages: DataFrame, url: str = "url", html: str = "html", salts: int = SALTS) -> DataFrame:
    """``host, template``: the aligned pages of each host.

    A batch's pages are merged in the map, then parts of a host meet in ``salts`` groups and their
    results in one, so a host with a third of all pages brings a few small trees to a task.
    """
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, list] = {}
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                page = skeleton([parse(text.as_py())])
                found[name] = merge(found[name], page) if name in found else page
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array([pickle.dumps(t) for t in found.values()], pa.binary())], names=["host", "template"])

    def join(group: pd.DataFrame) -> pd.DataFrame:
        parts = sorted(group["template"], key=bytes)
        whole = pickle.loads(parts[0])
        for part in parts[1:]:
            whole = merge(whole, pickle.loads(part))
        return pd.DataFrame({"host": [group["host"].iloc[0]], "template": [pickle.dumps(whole)]})

    rows = pages.select(host(url).alias("host"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    parts = rows.mapInArrow(fold, "host string, template binary")
    some = (parts.withColumn("salt", F.pmod(F.xxhash64("template"), F.lit(salts))).groupBy("host", "salt").applyInPandas(join, "host string, template binary"))
    return some.groupBy("host").applyInPandas(join, "host string, template binary")


def extract_text(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Op 8. ``key, url, text`` of every page.

    The pages of a host are aligned by simple tree matching. A place with one text in nearly all of at
    least ``MIN_PAGES`` pages is template; varying places are content, but for those that HTML or their
    names mark as menus, headers, footers, sidebars, notices, adverts, forms or comments. Where a
    page marks its article, only that counts. Character references are decoded, white space in a block
    becomes one blank, blocks are joined by a line break.

    Null and empty pages give an empty text; a null URL is a host of its own; broken markup is read as
    browsers do, as far as open and close tags go. Rows that repeat stay. Templates are small and one per
    host: up to ``BROADCAST_BYTES`` of them, as summed up, go to all tasks and pages stay where they lie;
    beyond that both meet by host and salt, so a hot host is spread over ``SALTS`` groups.
    """
    found = save(templates(pages, url, html).withColumnRenamed("host", "_host"), "templates")
    rows = pages.select(F.struct(F.col(key).alias("k"), F.col(url).alias("u")).alias("row"), F.coalesce(F.col(html), F.lit("")).alias("html"), host(url).alias("host"))
    kind = rows.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, list] = {}
        for batch in batches:
            out = []
            for text, blob in zip(batch.column(1), batch.column(2).to_pylist()):
                if blob is not None and blob not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[blob] = pickle.loads(blob)
                out.append("\n".join(blocks(parse(text.as_py()), known.get(blob))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["row", "text"])

    size = found.agg(F.sum(F.octet_length("template") + F.octet_length("_host"))).first()[0] or 0
    same = F.col("host") == F.col("_host")
    if size <= BROADCAST_BYTES:
        met = rows.join(F.broadcast(found), same, "left")
    else:
        found = found.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = rows.withColumn("salt", F.pmod(F.xxhash64("html"), F.lit(SALTS))).join(found, same & (F.col("salt") == F.col("_salt")), "left")
    return (met.select("row", "html", "template")
            .mapInArrow(run, f"row {kind}, text string").select(F.col("row.k").alias(key), F.col("row.u").alias(url), "text"))

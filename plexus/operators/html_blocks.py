"""Blocks of a web page: a small event handler that runs inside tasks, one page at a time."""

from __future__ import annotations

from html.parser import HTMLParser

# Elements that make a block, elements without content, elements whose text is no text.
BLOCK_TAGS = frozenset("p h1 h2 h3 h4 h5 li figcaption img div span".split())
VOID_TAGS = frozenset("area base br col embed hr img input keygen link menuitem meta param source track wbr "
                      "basefont bgsound command frame image isindex nextid spacer".split())
NO_TEXT_TAGS = frozenset("script style template rt rp".split())
TITLE_TAGS = frozenset("h1 h2 h3 h4 h5".split())


def text_block(text, kind="body", anchor=None, page_number=None, title=None):
    return {"type": "text", "text": text, "kind": kind, "anchor": anchor, "page_number": page_number, "title": title,
            "image_url": None, "alt": None, "caption": None}


class _Region:
    """Blocks of one root: the outermost block elements below it, in document order."""

    def __init__(self, depth: int):
        self.depth, self.blocks = depth, []
        self.element, self.texts, self.open_at = None, [], None
        self.anchor, self.image = None, None

    def start(self, tag: str, attrs: dict, depth: int) -> None:
        if self.open_at is None and depth > self.depth and tag in BLOCK_TAGS:
            self.element, self.texts, self.open_at = (tag, attrs), [], depth

    def text(self, value: str) -> None:
        if self.open_at is not None:
            self.texts.append(value)

    def end(self, depth: int) -> None:
        if self.open_at != depth:
            return
        (tag, attrs), text = self.element, "".join(self.texts)
        self.open_at = None
        self.anchor = attrs.get("id") or attrs.get("name") or self.anchor
        if tag == "img":
            if attrs.get("src"):
                self.flush_image()
                self.image = {"type": "image", "text": None, "kind": None, "anchor": self.anchor, "page_number": None,
                              "title": None, "image_url": attrs["src"], "alt": attrs.get("alt"), "caption": None}
            return
        if not text:
            return
        if tag == "figcaption" and self.image is not None and self.image["caption"] is None:
            self.image["caption"] = text
        kind = "title" if tag in TITLE_TAGS else "list" if tag == "li" else "body"
        self.blocks.append(text_block(text, kind, self.anchor))

    def flush_image(self) -> None:
        """An image waits for its caption; without any text it is left out."""
        if self.image is not None and (self.image["caption"] or self.image["alt"]):
            self.blocks.append(self.image)
        self.image = None


def parse_selector(selector: str) -> list[list[tuple[str, str, frozenset]]]:
    """``tag#id.class`` parts, nested by blanks, alternatives by commas."""
    out = []
    for alternative in selector.split(","):
        steps = []
        for part in alternative.split():
            pieces, mark, current = {"": "", "#": "", ".": []}, "", ""
            for ch in part + "\0":
                if ch in "#.\0":
                    if mark == ".":
                        pieces["."].append(current)
                    else:
                        pieces[mark] = current
                    mark, current = ch, ""
                elif ch.isalnum() or ch in "-_*":
                    current += ch
                else:
                    raise ValueError(f"selector {selector!r}: only tags, #ids and .classes are known")
            steps.append((pieces[""].lower(), pieces["#"], frozenset(pieces["."])))
        if not steps:
            raise ValueError("empty selector")
        out.append(steps)
    return out


def _fits(step, tag: str, attrs: dict) -> bool:
    name, ident, classes = step
    return ((name in ("", "*") or name == tag) and (not ident or attrs.get("id") == ident)
            and classes <= set((attrs.get("class") or "").split()))


class BlockParser(HTMLParser):
    """Collects blocks while the page streams by.

    End tags close the nearest open element of that name and all inside it; end tags that
    nothing is open for are ignored; no element is closed by the start of another.
    """

    def __init__(self, selector=None):
        super().__init__(convert_charrefs=True)
        self.selector = selector
        self.stack: list[tuple[str, dict]] = []
        self.page = _Region(0)
        self.roots: list[_Region] = []
        self.active: list[_Region] = [self.page]
        self.title, self.in_title, self.title_texts = None, None, []
        self.silent, self.pending = 0, []

    def _flush_text(self) -> None:
        value = "".join(self.pending).strip()
        self.pending = []
        if value and not self.silent:
            for region in self.active:
                region.text(value)
            if self.in_title is not None:
                self.title_texts.append(value)

    def handle_starttag(self, tag, attrs):
        self._flush_text()
        attrs = {k: (v or "") for k, v in attrs}
        self.stack.append((tag, attrs))
        depth = len(self.stack)
        for region in self.active:
            region.start(tag, attrs, depth)
        if self.selector and self._selected():
            root = _Region(depth)
            self.roots.append(root)
            self.active.append(root)
        if tag == "title" and self.title is None and self.in_title is None:
            self.in_title = depth
        if tag in NO_TEXT_TAGS:
            self.silent += 1
        if tag in VOID_TAGS:
            self._pop()

    def _selected(self) -> bool:
        for steps in self.selector:
            if not _fits(steps[-1], *self.stack[-1]):
                continue
            rest = list(steps[:-1])
            for tag, attrs in reversed(self.stack[:-1]):
                if rest and _fits(rest[-1], tag, attrs):
                    rest.pop()
            if not rest:
                return True
        return False

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._flush_text()
        if tag in VOID_TAGS or all(t != tag for t, _ in self.stack):
            return
        while self._pop() != tag:
            pass

    def _pop(self) -> str:
        depth, (tag, _) = len(self.stack), self.stack[-1]
        for region in self.active:
            region.end(depth)
        self.active = [r for r in self.active if r is self.page or r.depth < depth]
        if self.in_title == depth:
            self.title, self.in_title = "".join(self.title_texts), None
        if tag in NO_TEXT_TAGS:
            self.silent -= 1
        self.stack.pop()
        return tag

    def handle_data(self, data):
        self.pending.append(data)

    def handle_comment(self, data):
        self._flush_text()

    handle_decl = handle_pi = unknown_decl = handle_comment

    def finish(self) -> tuple[list[dict], bool]:
        """All blocks, and whether a selector matched."""
        self.close()
        self._flush_text()
        while self.stack:
            self._pop()
        blocks = []
        for region in self.roots or [self.page]:
            region.flush_image()
            blocks.extend(region.blocks)
        for block in blocks:
            block["title"] = self.title
        return blocks, bool(self.roots)


def html_blocks(html: str, selector=None) -> tuple[list[dict], bool]:
    """I04, I05, I06. Text and image blocks of a page."""
    parser = BlockParser(selector)
    parser.feed(html)
    return parser.finish()


class _Links(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag in ("a", "area"):
            self.found.extend(v for k, v in attrs if k == "href" and v)


def html_links(html: str) -> list[str]:
    parser = _Links()
    parser.feed(html)
    parser.close()
    return parser.found

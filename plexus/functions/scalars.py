"""String, hash, date, geometry and JSON expressions. All are built-in expressions on the JVM side."""

from __future__ import annotations

import fnmatch
import mimetypes
import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Media types by file extension, over those that Python knows.
MIME_BY_EXTENSION = {ext[1:]: mime for ext, mime in mimetypes.MimeTypes().types_map[True].items()} | {
    "png": "image/png", "jpg": "image/jpeg", "jpeg": "image/jpeg", "jpe": "image/jpeg",
    "gif": "image/gif", "bmp": "image/bmp", "webp": "image/webp", "tif": "image/tiff",
    "tiff": "image/tiff", "svg": "image/svg+xml", "pdf": "application/pdf", "mp4": "video/mp4",
    "mov": "video/quicktime", "avi": "video/x-msvideo", "mpeg": "video/mpeg", "webm": "video/webm",
    "csv": "text/csv", "txt": "text/plain", "htm": "text/html", "html": "text/html",
    "json": "application/json", "xml": "text/xml", "zip": "application/zip",
}

# Leading bytes (hex) of media types.
MIME_BY_MAGIC = {
    "89504E470D0A1A0A": "image/png", "FFD8FF": "image/jpeg", "25504446": "application/pdf",
    "47494638": "image/gif", "424D": "image/bmp", "504B0304": "application/zip",
}


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Characters that count as white space around a text.
WHITE_SPACE = (" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
               "\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def strip(text: str | Column) -> Column:
    """Text without white space at both ends."""
    return F.btrim(_c(text), F.lit(WHITE_SPACE))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times, also inside lambdas (which would repeat it per element)."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def content_type_main(content_type: str | Column) -> Column:
    """G01. Main type of a content type: the part before the first parameter."""
    return F.trim(F.substring_index(_c(content_type), ";", 1))


def content_type_params(content_type: str | Column) -> Column:
    """G01. Parameters of a content type as a map; names in lower case, quotes removed, last one wins."""
    c = _c(content_type)
    pattern = r';\s*([^=;\s]+)\s*=\s*("[^"]*"|[^;]*)'
    values = F.transform(F.regexp_extract_all(c, F.lit(pattern), F.lit(2)),
                         lambda v: F.regexp_replace(F.trim(v), r'^"(.*)"$', "$1"))
    def last_of_name(names: Column, items: Column) -> Column:
        return F.filter(items, lambda _, i: ~F.array_contains(F.slice(names, i + 2, F.size(names)), F.get(names, i)))

    return let(F.transform(F.regexp_extract_all(c, F.lit(pattern), F.lit(1)), F.lower),
               lambda names: F.map_from_arrays(last_of_name(names, names), last_of_name(names, values)))


def mime_from_path(path: str | Column) -> Column:
    """G02. Media type guessed from the file extension, NULL when unknown."""
    p = _c(path)
    ext = F.lower(F.regexp_extract(p, r"[^/.][^/]*\.([^./]+)$", 1))
    table = F.create_map(*[F.lit(x) for kv in MIME_BY_EXTENSION.items() for x in kv])
    return F.try_element_at(table, ext)


def mime_from_bytes(content: str | Column) -> Column:
    """G03. Media type from the leading bytes."""
    head = F.hex(F.substring(_c(content), 1, 12))
    out = F.when(F.substring(head, 9, 8) == "66747970", "video/mp4")
    for magic, mime in MIME_BY_MAGIC.items():
        out = out.when(head.startswith(magic), mime)
    return out.otherwise(F.lit("application/octet-stream"))


def url_domain(url: str | Column) -> Column:
    """G04. Network location of a url, port included; NULL for an unparsable url."""
    return F.try_parse_url(_c(url), F.lit("AUTHORITY"))


def url_host(url: str | Column) -> Column:
    """Host of a url in lower case, without port; NULL for an unparsable url."""
    return F.lower(F.try_parse_url(_c(url), F.lit("HOST")))


def max_age(cache_control: str | Column) -> Column:
    """G05. ``max-age`` of a Cache-Control header; absent and 0 give NULL."""
    digits = F.regexp_extract(_c(cache_control), r"(?:^|,)\s*max-age[^=,]*=\s*(\d+)", 1)
    return F.nullif(F.nullif(digits, F.lit("")).try_cast("bigint"), F.lit(0).cast("bigint"))


def http_date(value: str | Column) -> Column:
    """G06. Date header to a timestamp; bad values give NULL.

    All three legal forms are read: ``Tue, 05 Mar 2024 10:01:02 GMT``, ``Tuesday, 05-Mar-24 10:01:02 GMT`` and
    ``Tue Mar  5 10:01:02 2024``; seconds may be missing, years of two digits from 69 on lie in the last century.
    """
    def swap(c: Column, pattern: str, by: str) -> Column:
        return F.regexp_replace(c, pattern, by)

    bare = swap(F.trim(_c(value)), r"^[A-Za-z]+,?\s+(?=[A-Za-z0-9])", "")
    bare = swap(bare, r"^([A-Za-z]{3})\s+(\d{1,2})\s+(\d{1,2}:\d{2}(?::\d{2})?)\s+(\d{4})$", "$2 $1 $4 $3 +0000")
    bare = swap(bare, r"^(\d{1,2})-([A-Za-z]{3})-(\d{2,4}) ", "$1 $2 $3 ")
    bare = swap(swap(bare, r"^(\d{1,2} [A-Za-z]{3}) (69|[7-9]\d) ", "$1 19$2 "), r"^(\d{1,2} [A-Za-z]{3}) (\d{2}) ", "$1 20$2 ")
    bare = swap(bare, r"( \d{1,2}:\d{2})(?=\s|$)", "$1:00")
    zoned = swap(bare, r"\s+(?:GMT|UTC|UT|Z)$", " +0000")
    padded = swap(swap(zoned, r"^(\d) ", "0$1 "), r" (\d):", " 0$1:")
    return F.try_to_timestamp(padded, F.lit("dd MMM yyyy HH:mm:ss Z"))


def resource_key(*parts: str | Column) -> Column:
    """G07. SHA-1 of the parts joined by a slash. Strings are literal parts."""
    cols = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    return F.sha1(F.concat_ws("/", *cols))


def sql_creator_key(host: str, database: str, table: str | Column) -> Column:
    """G08. Key of a SQL table as a source of objects."""
    return resource_key(f"sql://{host}/{database}", table)


def bucket_creator_key(scheme: str | Column, bucket: str | Column) -> Column:
    """G08. Key of a bucket as a source of objects."""
    return resource_key(scheme, bucket)


def glob_regex(pattern: str) -> re.Pattern[str]:
    """A shell glob as a compiled expression (patterns are settings, not data)."""
    return re.compile(fnmatch.translate(pattern))


def glob_match(value: str | Column, pattern: str) -> Column:
    """G09. Shell glob on a column: ``*``, ``?`` and ``[...]``."""
    out, i = [], 0
    while i < len(pattern):
        ch = pattern[i]
        close = pattern.find("]", i + 2) if ch == "[" else -1
        if ch == "*":
            out.append(".*")
        elif ch == "?":
            out.append(".")
        elif close > 0:
            body = pattern[i + 1:close].replace("\\", "\\\\")
            out.append("[" + ("^" + body[1:] if body[0] == "!" else body) + "]")
            i = close
        else:
            out.append(re.escape(ch))
        i += 1
    return _c(value).rlike("(?s)^" + "".join(out) + "$")


def capitalize(value: str | Column) -> Column:
    """G10. First letter upper, the rest lower (not title case)."""
    v = _c(value)
    return F.concat(F.upper(F.substring(v, 1, 1)), F.lower(F.substring(v, 2, 2147483647)))


def edge_class_name(src: str, dst: str) -> str:
    """Name of the edge class between two node classes; a leading underscore is dropped."""
    return f"{src.removeprefix('_').capitalize()}to{dst.removeprefix('_').capitalize()}"


def iso_date(value: str | Column) -> Column:
    """G11. ``yyyy-MM-dd HH:mm:ss`` to ISO form."""
    return F.date_format(F.to_timestamp(_c(value), "yyyy-MM-dd HH:mm:ss"), "yyyy-MM-dd'T'HH:mm:ss")


def url_tail_id(url: str | Column) -> Column:
    """G12. Last path part of a url up to the first underscore."""
    return F.substring_index(F.substring_index(_c(url), "/", -1), "_", 1)


def box_clamp(value: str | Column) -> Column:
    """G13. Truncated coordinate; zero and below become 1."""
    v = _c(value).cast("int")
    return F.when(v > 0, v).otherwise(F.lit(1))


def box_floor(value: str | Column) -> Column:
    """G13. Truncated coordinate; negatives become 0."""
    return F.greatest(_c(value).cast("int"), F.lit(0))


def box_rescale(x1: str | Column, y1: str | Column, x2: str | Column, y2: str | Column,
                scale: float = 0.5) -> Column:
    """G14. Corner box in a scaled picture to x, y, width, height in the original one."""
    a, b, c, d = _c(x1), _c(y1), _c(x2), _c(y2)
    s = F.lit(float(scale))
    return F.struct((a / s).cast("int").alias("x"), (b / s).cast("int").alias("y"),
                    ((c - a) / s).cast("int").alias("width"), ((d - b) / s).cast("int").alias("height"))


def aspect_ratio(width: str | Column, height: str | Column) -> Column:
    """G15. Width over height; NULL for zero height."""
    return F.try_divide(_c(width).cast("double"), _c(height).cast("double"))


def area_share(area: str | Column, width: str | Column, height: str | Column) -> Column:
    """G15. Area of a box as a share of its image."""
    return F.try_divide(_c(area).cast("double"), _c(width).cast("double") * _c(height).cast("double"))


def polygon_pairs(flat: str | Column, dx: float = 0.0, dy: float = 0.0, scale: float = 1.0) -> Column:
    """G16. Flat ``[x, y, ...]`` to ``[[x, y], ...]`` with scale and offset."""
    def pairs(c: Column) -> Column:
        points = F.transform(
            F.sequence(F.lit(0), (F.size(c) / F.lit(2)).cast("int") - 1),
            lambda i: F.array(F.get(c, i * 2) * F.lit(scale) + F.lit(dx), F.get(c, i * 2 + 1) * F.lit(scale) + F.lit(dy)))
        return F.when(F.size(c) >= 2, points).otherwise(F.array().cast("array<array<double>>"))

    return let(_c(flat), pairs)


def polygon_rings(rings: str | Column, min_points: int = 3) -> Column:
    """G16. Rings with at least ``min_points`` points."""
    return F.filter(_c(rings), lambda r: F.size(r) >= min_points)


def feature_id(owner: str | Column, feature_index: str | Column) -> Column:
    """G17. Owner id shifted left by six bits plus the feature index."""
    return F.shiftleft(_c(owner).cast("bigint"), 6) + _c(feature_index).cast("bigint")


def utf8_text(data: str | Column) -> Column:
    """Bytes to text with the replacement character for bad bytes."""
    return F.make_valid_utf8(_c(data).cast("string"))


def valid_json(text: str | Column) -> Column:
    """True when the whole text is one JSON value.

    The parser stops after the first value, so the text is read once as the only element of an
    array and once as the only field of an object: nothing but a whole value fits both.
    """
    c = _c(text)
    one = F.try_parse_json(F.concat(F.lit("["), c, F.lit("]"))).try_cast("array<variant>")
    field = F.try_parse_json(F.concat(F.lit('{"v":'), c, F.lit("}")))
    return F.coalesce((F.size(one) == 1) & field.isNotNull(), F.lit(False))


def decode_json_or_text(data: str | Column) -> Column:
    """G18. Bytes to text, tagged by whether the text parses as JSON: struct(is_json, text)."""
    text = utf8_text(data)
    return F.struct(valid_json(text).alias("is_json"), text.alias("text"))


def anchor_url(url: str | Column, anchor: str | Column, page_number: str | Column) -> Column:
    """G25. ``url#anchor``, else ``url#page=n``, else the url. Empty anchor and page 0 count as none."""
    u, a, p = _c(url), _c(anchor), _c(page_number)
    return (F.when(a.isNotNull() & (a != ""), F.concat(u, F.lit("#"), a))
            .when(p.isNotNull() & (p != 0), F.concat(u, F.lit("#page="), p.cast("string")))
            .otherwise(u))


def jaccard_chars(a: str | Column, b: str | Column) -> Column:
    """G24. Jaccard distance of two character sets; NULL when both are empty."""
    def chars(c: str | Column) -> Column:
        return F.array_distinct(F.filter(F.split(_c(c), ""), lambda ch: ch != ""))

    return let(chars(a), lambda x: let(chars(b), lambda y: 1 - F.try_divide(
        F.size(F.array_intersect(x, y)).cast("double"), F.size(F.array_union(x, y)).cast("double"))))


def typed_value(text: str | Column, kind: str, strict: bool = False) -> Column:
    """B10. Text to a typed property value; bad values give NULL, or an error when strict."""
    c = _c(text)
    if kind == "number":
        return c.cast("double") if strict else c.try_cast("double")
    if kind == "boolean":
        return c.cast("boolean") if strict else c.try_cast("boolean")
    if kind == "datetime":
        return c.cast("timestamp") if strict else c.try_cast("timestamp")
    if kind == "json":
        bad = F.raise_error(F.concat(F.lit("not JSON: "), c)).cast("string") if strict else F.lit(None)
        return F.when(valid_json(c), c).when(c.isNotNull(), bad)
    if kind in ("string", "uniqueid"):
        return c
    raise ValueError(f"unknown property type {kind}")

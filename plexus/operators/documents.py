"""Crawl responses to documents to text blocks.

A document stays one row from the response to its blocks: no shuffle between scan and segments.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from urllib.parse import urldefrag, urljoin

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plexus.functions.scalars import content_type_main, http_date, max_age, strip, url_domain, utf8_text
from plexus.operators.constraints import allowed_domains
from plexus.operators.html_blocks import html_blocks, html_links, parse_selector
from plexus.operators.vectors import slices, to_arrow

# Response codes that are recorded as errors.
ERROR_STATUS = (400, 401, 402, 403, 404, 405)

BLOCK_SCHEMA = T.ArrayType(T.StructType([
    T.StructField("type", T.StringType()), T.StructField("text", T.StringType()),
    T.StructField("kind", T.StringType()), T.StructField("anchor", T.StringType()),
    T.StructField("page_number", T.IntegerType()), T.StructField("title", T.StringType()),
    T.StructField("image_url", T.StringType()), T.StructField("alt", T.StringType()),
    T.StructField("caption", T.StringType())]))


def responses_to_documents(responses: DataFrame) -> DataFrame:
    """I01. Document properties of the responses that are no errors; absent headers give NULL."""
    none_if_empty = lambda c: F.nullif(F.col(c), F.lit(""))
    return responses.where(~F.col("status").isin(*ERROR_STATUS)).withColumns({
        "domain": url_domain("url"),
        "content_type": none_if_empty("content_type"),
        "simple_content_type": F.substring_index(none_if_empty("content_type"), ";", 1),
        "last_modified": http_date("last_modified"),
        "etag": none_if_empty("etag"),
        "cache_control": none_if_empty("cache_control"),
        "cache_control_max_age": max_age("cache_control"),
        "expires": http_date("expires") if "expires" in responses.columns else F.lit(None).cast("timestamp"),
        "crawl_time": F.col("crawl_time") if "crawl_time" in responses.columns else F.current_timestamp(),
    })


def error_urls(responses: DataFrame) -> DataFrame:
    """I02. Status, url and referrer of failed requests; no referrer is the text ``None``."""
    return responses.where(F.col("status").isin(*ERROR_STATUS)).select(
        "status", "url", F.coalesce("referrer", F.lit("None")).alias("referrer"))


def link_frontier(pages: DataFrame, visited: DataFrame, start_urls: DataFrame, extra_domains: Sequence[str] = (),
                  url: str = "url", html: str = "html") -> DataFrame:
    """I03. Links of the pages, absolute, on allowed domains, not visited; each once.

    Duplicates fall away on the map side before the domain and visited joins.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for base, page in zip(pdf[url], pdf[html]):
                for link in html_links(page or ""):
                    try:
                        target = urldefrag(urljoin(base, link.strip())).url
                    except ValueError:
                        continue
                    if target.startswith(("http://", "https://")):
                        out.append(target)
            yield pd.DataFrame({"url": pd.Series(out, dtype="object").drop_duplicates()})

    links = pages.select(url, html).mapInPandas(run, "url string").distinct()
    fits = allowed_domains(links, start_urls, extra_domains)
    return fits.join(visited.select(F.col(visited.columns[0]).alias("url")), "url", "left_anti")


def extract_blocks_html(pages: DataFrame, html: str = "html", css_selector: str | None = None) -> DataFrame:
    """I04, I05, I06. Replace the page by its ``blocks``; ``root_found`` tells whether a selector matched."""
    selector = parse_selector(css_selector) if css_selector else None
    rest = [f for f in pages.schema.fields if f.name != html]
    schema = T.StructType([*rest, T.StructField("blocks", BLOCK_SCHEMA), T.StructField("root_found", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = to_arrow(schema)
        for batch in slices(batches):
            blocks, found = [], []
            for page in batch.column(batch.schema.get_field_index(html)).to_pylist():
                if isinstance(page, (bytes, bytearray)):
                    page = bytes(page).decode("utf-8", errors="replace")
                b, hit = html_blocks(page or "", selector)
                blocks.append(b)
                found.append(hit)
            columns = [batch.column(batch.schema.get_field_index(f.name)) for f in rest]
            columns += [pa.array(blocks, type=target.field("blocks").type), pa.array(found, type=pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, schema=target)

    return pages.mapInArrow(run, schema)


def _one_block(text, page_number=None, title=None):
    null = F.lit(None).cast("string")
    return F.struct(
        F.lit("text").alias("type"), text.alias("text"), F.lit("body").alias("kind"), null.alias("anchor"),
        (F.lit(None) if page_number is None else page_number).cast("int").alias("page_number"),
        (null if title is None else title).alias("title"), null.alias("image_url"), null.alias("alt"), null.alias("caption"))


def extract_blocks_text(documents: DataFrame, body: str = "body") -> DataFrame:
    """I07. The whole text as one block; bad bytes become the replacement character."""
    return documents.withColumn("blocks", F.array(_one_block(utf8_text(body)))).drop(body)


def page_blocks(documents: DataFrame, pages: str = "pages", title: str = "title") -> DataFrame:
    """I08. One block per non-empty page of ``pages`` (array of page texts), numbered from 1."""
    t = F.col(title) if title in documents.columns else F.lit(None).cast("string")
    numbered = F.transform(F.col(pages), lambda p, i: F.struct(p.alias("p"), (i + 1).alias("n")))
    blocks = F.transform(F.filter(numbered, lambda e: F.coalesce(e["p"] != "", F.lit(False))),
                         lambda e: _one_block(strip(e["p"]), e["n"], t))
    return documents.withColumn("blocks", blocks).drop(pages)


def dispatch_by_type(documents: DataFrame, key: str, body: str = "body", content_type: str = "content_type",
                     css_selector: str | None = None) -> tuple[DataFrame, DataFrame]:
    """I09. Blocks by content type, and an error row for every other type.

    HTML, plain text and PDF branch by a filter each. A PDF body is its page texts, separated by form feeds.
    """
    kind = content_type_main(content_type)
    rows = documents.select(key, body, kind.alias("_kind"))
    html = extract_blocks_html(rows.where("_kind = 'text/html'").select(key, body), body, css_selector).select(key, "blocks")
    text = extract_blocks_text(rows.where("_kind = 'text/plain'").select(key, body), body)
    pdf = page_blocks(rows.where("_kind = 'application/pdf'").select(
        key, F.split(utf8_text(body), "\f").alias("pages")))
    known = F.col("_kind").isin("text/html", "text/plain", "application/pdf")
    errors = rows.where(~F.coalesce(known, F.lit(False))).select(
        key, F.concat(F.lit("Unsupported content type: "), F.coalesce("_kind", F.lit("none"))).alias("error"))
    return html.unionByName(text).unionByName(pdf), errors


def block_rows(documents: DataFrame, key: str) -> DataFrame:
    """One row per block with its position in the document."""
    return documents.select(key, F.posexplode("blocks").alias("position", "b")).select(key, "position", "b.*")


def full_text(documents: DataFrame, key: str) -> DataFrame:
    """I10. All text blocks of a document, each followed by a blank line, with the first title."""
    texts = F.filter("blocks", lambda b: b["type"] == "text")
    titles = F.filter(texts, lambda b: F.coalesce(b["title"] != "", F.lit(False)))
    joined = F.array_join(F.transform(texts, lambda b: F.concat(F.coalesce(b["text"], F.lit("")), F.lit("\n\n"))), "")
    return documents.select(key, joined.alias("text"), F.get(titles, F.lit(0))["title"].alias("title"))

"""Pages to raw listings and links: Python takes a page apart into elements and texts, all rules are column functions."""

from __future__ import annotations

import itertools

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.functions import elements as X
from hearthline.functions.listing import price_kobo
from hearthline.functions.pages import ELEMENT, read_page
from hearthline.functions.web import absolute_url, external_id, split_currency, url_price_type
from hearthline.operators.verify import REMOVED, with_reason
from hearthline.sources import rules as R
from hearthline.vocab import REMOVAL_PHRASES

#: Characters of pages whose elements are sent back at a time.
PAGE_CHARS = 4_000_000
_ARROW = {"int": pa.int32(), "string": pa.string(), "array<string>": pa.list_(pa.string())}
READ = ("url", "title", "currency", "price", "whole_price", "raw_bedrooms", "raw_bathrooms", "raw_address", "raw_floor_area", "description", "property_type_raw", "agent_name")
PRICED = ("url", "currency", "price", "whole_price")
RAW = (
    "external_id", "source", "url", "title", "raw_price", "raw_price_type", "raw_bedrooms", "raw_bathrooms", "raw_address", "raw_floor_area", "description", "property_type_raw", "agent_name",
)


def page_elements(pages: DataFrame, names: frozenset[str]) -> DataFrame:
    """The pages with their elements and pieces of text in place of ``html``, and the error of those that cannot be read.
    A task holds the elements of about PAGE_CHARS characters of pages at a time."""
    kept = [c for c in pages.columns if c != "html"]
    schema = T.StructType([*pages.select(*kept).schema.fields, *T._parse_datatype_string(f"elements array<struct<{ELEMENT}>>, pieces array<string>, read_error string").fields])

    def run(batches):
        kind = pa.struct([pa.field(n, _ARROW[t]) for n, t in (part.split(" ", 1) for part in ELEMENT.split(", "))])
        for batch in batches:
            html = batch.column(batch.schema.get_field_index("html"))
            at = 0
            while at < len(html):
                elements, pieces, errors, chars, start = [], [], [], 0, at
                while at < len(html) and (chars < PAGE_CHARS or at == start):
                    page = html[at].as_py() or ""
                    try:
                        read, texts, error = *read_page(page, names), None
                    except Exception as fault:  # kept with the row
                        read, texts, error = [], [], f"{type(fault).__name__}: {fault}"[:500]
                    elements.append(read), pieces.append(texts), errors.append(error)
                    chars, at = chars + len(page), at + 1
                rows = list(zip(*itertools.chain.from_iterable(elements), strict=True)) or [()] * len(kind)
                structs = pa.StructArray.from_arrays([pa.array(column, f.type) for column, f in zip(rows, kind, strict=True)], fields=list(kind))
                ends = pa.array([0, *itertools.accumulate(map(len, elements))], pa.int32())
                columns = [batch.column(batch.schema.get_field_index(c)).slice(start, at - start) for c in kept]
                yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(ends, structs), pa.array(pieces, pa.list_(pa.string())), pa.array(errors, pa.string())], names=schema.names)

    return pages.mapInArrow(run, schema)


def _by_source(rules: dict, expression, kind: str) -> Column:
    cases = "".join(f" WHEN source = {X.quoted(source)} THEN {expression(own)}" for source, own in rules.items())
    return F.expr(f"CASE{cases} END" if cases else f"CAST(NULL AS {kind})")


def read_pages(pages: DataFrame, fields=R.FIELDS, keys: tuple[str, ...] = ()) -> DataFrame:
    """(source, page_url, each field read, error, keys): a page that cannot be read keeps its error. The fields are rows
    of a generator, so that filters on them do not work them out once more."""
    read = page_elements(pages.select("source", F.col("url").alias("page_url"), "html", *keys), X.attribute_names(fields) | {"rel"})
    columns = [_by_source({s: own[name] for s, own in fields.items() if name in own}, X.field, "STRING").alias(name) for name in READ]
    return read.select("source", "page_url", F.inline(F.array(F.struct(*columns))), F.col("read_error").alias("error"), *keys)


def priced(fields: dict) -> dict:
    """Of each source's rules, those for url, price and currency."""
    return {source: {name: own[name] for name in PRICED if name in own} for source, own in fields.items()}


def judged_pages(pages: DataFrame, fields=R.FIELDS, keys: tuple[str, ...] = ()) -> DataFrame:
    """Raw listings, their page_url and keys, and the reason why a page is none (else null). Pages without an id, or without the price (and currency) that their
    source needs, are no listings."""
    read = read_pages(pages, fields, keys)
    url = F.coalesce("url", "page_url")
    combined = split_currency(F.col("whole_price"))
    fall = F.col("price").isNull() | F.col("currency").isNull()
    needs = F.col("source").isin(*R.NEEDS_CURRENCY)
    price = F.when(needs & fall & F.col("whole_price").isNotNull(), F.concat(combined["currency"], combined["amount"])).when(needs, F.concat("currency", "price")).otherwise(F.col("price"))
    out = read.withColumn("url", url).withColumn("raw_price", price).withColumn("external_id", external_id(F.col("source"), F.col("url")))
    out = out.withColumn("raw_price_type", url_price_type(F.col("source"), F.col("url"), F.col("raw_price"))).withColumn("title", F.coalesce("title", F.lit("")))
    null_page = F.col("source").isin(*R.NEEDS_PRICE) & F.col("raw_price").isNull()
    reason = F.coalesce("error", F.when(F.col("external_id").isNull(), "no external id"), F.when(null_page, "no price"))
    return out.withColumn("reason", reason).select(*RAW, "page_url", *keys, "reason")


def extract_listings(pages: DataFrame, fields=R.FIELDS) -> tuple[DataFrame, DataFrame]:
    """(raw listings, quarantine with the reason, for which only what decides is read)."""
    return judged_pages(pages, fields).where("reason is null").select(*RAW), judged_pages(pages, priced(fields)).where("reason is not null").select("source", F.col("page_url").alias("url"), "reason")


def harvest_links(pages: DataFrame, cards=R.CARDS) -> DataFrame:
    """(source, page_url, position, url, external_id): each page's listing links, once each, in order. Where all links of
    a card count, only those with an id do; the first kind of card that gives a link is taken."""

    read = page_elements(pages.select("source", F.col("url").alias("page_url"), "html"), X.attribute_names(cards))
    read = read.select("source", "page_url", _by_source(cards, X.links, "ARRAY<ARRAY<STRING>>").alias("hrefs"))
    only_ids = F.col("source").isin(*[s for s, c in cards.items() if c[0][1]])
    listed = F.transform("hrefs", lambda kind: F.filter(kind, lambda h: ~only_ids | external_id(F.col("source"), h).isNotNull()))
    taken = F.try_element_at(F.filter(listed, lambda kind: F.size(kind) > 0), F.lit(1))
    whole = F.array_distinct(F.transform(taken, lambda h: absolute_url(F.col("source"), h)))
    return read.select("source", "page_url", F.posexplode(whole).alias("position", "url")).withColumn("external_id", external_id(F.col("source"), F.col("url")))


def checked_pages(fetches: DataFrame, fields=R.FIELDS, phrases=REMOVAL_PHRASES) -> DataFrame:
    """What each fetch tells, with the price that a live page states. The price stays with its fetch: neither an id found
    in the page nor other fetches of the listing matter. fetches: FETCH_LOG rows."""
    told = with_reason(fetches, phrases)
    html = F.when(F.col("reason") == "live", F.col("body")).alias("html")
    # renamed, for the page has an id and an error of its own
    pages = told.select("source", "url", html, "listing_id", F.col("external_id").alias("fetch_id"), F.col("reason").alias("fetch_reason"), F.col("error").alias("fetch_error"))
    read = judged_pages(pages, priced(fields), ("listing_id", "fetch_id", "fetch_reason", "fetch_error"))
    price = F.when((F.col("fetch_reason") == "live") & F.col("reason").isNull(), price_kobo(F.col("raw_price"))["kobo"])
    return read.select("listing_id", "source", F.col("fetch_id").alias("external_id"), F.col("fetch_reason").isin(*REMOVED).alias("is_removed"), price.alias("observed_price"), F.col("fetch_reason").alias("reason"), F.col("fetch_error").alias("error"))

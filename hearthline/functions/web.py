"""Column functions on listing URLs and feed pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Per source, the patterns (group 1 is the id) in the order in which they are tried.
EXTERNAL_IDS = {
    "propertypro": (r"(?i)/property/[^?#]+-([A-Za-z0-9]{4,10})(?:[?#/]|$)",),
    "privateproperty": (r"(?i)/listings/[^?#]+-([A-Za-z0-9]{4,10})(?:[?#/]|$)",),
    "nigeriapropertycentre": (r"(?i)/(\d{5,})(?:-[a-z0-9-]+)?(?:\.html)?$",),
    "jiji": (r"-([A-Za-z0-9]{10,})\.html?$", r"([A-Za-z0-9]{15,})"),
}
#: Sources whose URLs are read without the slashes at their end.
TRIMMED = ("nigeriapropertycentre",)
# Per source, text of the URL and the price type it tells, in order.
URL_PRICE_TYPES = {
    "propertypro": (("for-sale", "FOR_SALE"), ("for-rent", "FOR_RENT"), ("for-shortlet", "FOR_SHORT_LET")),
    "privateproperty": (("for-sale", "FOR_SALE"), ("for-rent", "FOR_RENT"), ("short-let", "FOR_SHORT_LET")),
    "nigeriapropertycentre": (("for-sale", "FOR_SALE"), ("short-let", "FOR_SHORT_LET"), ("for-rent", "FOR_RENT")),
    "jiji": (("houses-apartments-for-sale", "FOR_SALE"), ("houses-apartments-for-rent", "FOR_RENT")),
}
#: Words of a price that tell a rent, before the URL is asked, where a source states them.
PRICE_RENT_WORDS = {"jiji": ("/month", "/year", "per month")}
BASE_URLS = {
    "propertypro": "https://propertypro.ng",
    "privateproperty": "https://privateproperty.ng",
    "nigeriapropertycentre": "https://nigeriapropertycentre.com",
    "jiji": "https://jiji.ng",
}
PAGE_MARKS = {"propertypro": "&page=", "privateproperty": "&page=", "nigeriapropertycentre": "?page=", "jiji": "?page="}
CURRENCIES = ("₦", "$", "USD")


def external_id(source: Column, url: Column, rules=EXTERNAL_IDS) -> Column:
    out = F.lit(None).cast("string")
    for name, patterns in rules.items():
        own = F.regexp_replace(url, "/+$", "") if name in TRIMMED else url
        found = F.coalesce(*[F.when(F.regexp_extract(own, p, 1) != "", F.regexp_extract(own, p, 1)) for p in patterns])
        out = F.when(source == name, found).otherwise(out)
    return out


def url_price_type(source: Column, url: Column, price: Column | None = None, rules=URL_PRICE_TYPES) -> Column:
    out = F.lit(None).cast("string")
    for name, marks in rules.items():
        own = F.lit(None).cast("string")
        for mark, kind in reversed(marks):
            own = F.when(url.contains(mark), kind).otherwise(own)
        if price is not None:
            for word in PRICE_RENT_WORDS.get(name, ()):
                own = F.when(F.lower(price).contains(word), "FOR_RENT").otherwise(own)
        out = F.when(source == name, own).otherwise(out)
    return out


def absolute_url(source: Column, href: Column, bases=BASE_URLS) -> Column:
    base = F.lit("")
    for name, root in bases.items():
        base = F.when(source == name, root).otherwise(base)
    return F.when(href.startswith("http"), href).otherwise(F.concat(base, href))


def split_currency(text: Column) -> Column:
    """struct<currency, amount> of a combined price text."""
    currency, amount = F.lit(""), text
    for c in reversed(CURRENCIES):
        currency = F.when(text.startswith(c), c).otherwise(currency)
        amount = F.when(text.startswith(c), text.substr(F.lit(len(c) + 1), F.length(text))).otherwise(amount)
    return F.struct(currency.alias("currency"), amount.alias("amount"))


def page_frontier(feeds: DataFrame, *, cap: int = 5, marks=PAGE_MARKS) -> DataFrame:
    """(source, feed, page, url): the pages of each feed's base URL up to the cap; page 1 is the base itself."""
    mark = F.lit("?page=")
    for name, m in marks.items():
        mark = F.when(F.col("source") == name, m).otherwise(mark)
    pages = feeds.select("source", "feed", "base_url", F.explode(F.sequence(F.lit(1), F.lit(cap))).alias("page"))
    url = F.when(F.col("page") == 1, F.col("base_url")).otherwise(F.concat("base_url", mark, F.col("page").cast("string")))
    return pages.select("source", "feed", "page", url.alias("url"))

"""Column functions against literal vectors."""

import difflib
import re

import pytest
from pyspark.sql import functions as F

from hearthline import vocab
from hearthline.functions import listing as L
from hearthline.functions import web
from hearthline.operators import places
from hearthline.operators.normalise import normalise


def apply(spark, values, f, schema="v string"):
    rows = [(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, " + schema)
    return [r.out for r in df.select("i", f(*[F.col(c) for c in df.columns[1:]]).alias("out")).orderBy("i").collect()]


PRICES = {
    "₦45,000,000": 4500000000, "45M": 4500000000, "45 million": 4500000000, "45 million naira": 4500000000, "45000000": 4500000000, "45.5M": 4550000000, "1.5B": 150000000000,
    "4500000000": 450000000000, "₦75,000,000/year": 7500000000, "₦4,000,000per annum": 400000000, "2.4M": 240000000, "$12,000,000": 1200000000, None: None, "": None, "  ": None, " ": None,
    "Price on Request": None, "Contact agent": None, "N/A": None, "Call for price": None, "₦4M per annum": 400, "45M/year": 4500, "NGN 45M": None, "1.5 billion": 150, "19.99": 1998, "500K": 50000, "1.2.3": None, ".": None, "45dB": None, "45dM": 4500,
}


def test_prices(spark):
    got = apply(spark, list(PRICES), L.price_kobo)
    assert [(r.kobo, r.failed) for r in got] == [(v, v is None) for v in PRICES.values()]


def test_areas(spark):
    cases = {"150 sqm": 150.0, "1,200 sqm": 1200.0, "250 sq.m": 250.0, "300 m²": 300.0, "2.6K sqm": None, "2700 sqft": 250.8, "500 sq. ft": 46.5, "1000 sqft": 92.9, None: None, "": None, "3 bedrooms": None, "nice flat": None, ", sqm": None}
    got = apply(spark, list(cases), L.floor_area_sqm)
    assert [g if g is None else pytest.approx(v, abs=0.11) for g, v in zip(got, cases.values(), strict=True)] == got
    assert [g is None for g in got] == [v is None for v in cases.values()]
    assert apply(spark, [", sqm", "1 sqm", None], L.unreadable_area) == [True, False, False]


def test_integers(spark):
    cases = {"3 Bedrooms": 3, "4 bed": 4, "2": 2, "5 bathrooms": 5, None: None, "": None, "Studio": None, "99999999": None}
    assert apply(spark, list(cases), L.first_int) == list(cases.values())


def test_price_types(spark):
    cases = {
        ("FOR_SALE", None, None): "FOR_SALE", ("FOR_RENT", None, None): "FOR_RENT", (None, "3 bed flat to let", None): "FOR_RENT", (None, "luxury apartment", "available for sale"): "FOR_SALE", ("₦4M/year", None, None): "FOR_RENT",
        ("₦75M/year", None, None): "FOR_RENT", (None, "house for outright purchase", None): "FOR_SALE", (None, "nice property abuja", None): None, ("FOR_SHORT_LET", "rent", None): "FOR_SHORT_LET", ("", "", ""): None,
    }
    assert apply(spark, list(cases), L.price_type, "a string, b string, c string") == list(cases.values())


def test_property_types(spark):
    cases = {
        "Flat / Apartment": "FLAT_APARTMENT", "flat/apartment": "FLAT_APARTMENT", "Detached Duplex": "DETACHED_DUPLEX", "Duplex": "DETACHED_DUPLEX", "Semi-Detached Duplex": "SEMI_DETACHED_DUPLEX", "Mini Flat": "MINI_FLAT",
        "Studio Apartment": "STUDIO", "Plot of Land": "LAND", "Commercial Property": "COMMERCIAL_OTHER", None: None, "": None, "Converted Church Property": "CONVERTED_CHURCH_PROPERTY", "5 bed semi-detached duplex": "DETACHED_DUPLEX",
        "victoria island": "LAND", "x" * 50: "X" * 40,
    }
    assert apply(spark, list(cases), L.property_type) == list(cases.values())
    assert apply(spark, [(None, "", "big villa"), (None, "a shop", "villa"), ("Land", "shop", None)], L.listing_type, "a string, b string, c string") == ["VILLA", "COMMERCIAL_SHOP", "LAND"]


def test_cities_and_signals(spark):
    cases = {("Lekki Phase 1, Lagos", None): "LAGOS", ("Maitama, Abuja", None): "ABUJA", ("GRA, Port Harcourt", None): "PH", (None, "3 bed flat in Yaba Lagos"): "LAGOS", (None, "office in Wuse 2 Abuja"): "ABUJA", ("some estate", "nice house"): None}
    assert apply(spark, list(cases), L.city, "a string, b string") == list(cases.values())
    yes = ["diaspora-friendly property, forex payment accepted", "Suitable for returnees and NRNs", "Dollar-denominated lease available", "Ideal for expatriates"]
    assert apply(spark, [*yes, "plain flat", None, ""], L.signal_flag) == [True] * 4 + [False] * 3


def test_urls(spark):
    ids = {
        ("propertypro", "https://propertypro.ng/property/3-bed-flat-lekki-7NUGY"): "7NUGY", ("privateproperty", "https://privateproperty.ng/listings/3-bed-duplex-lekki-6PBUWY?x=1"): "6PBUWY",
        ("nigeriapropertycentre", "https://nigeriapropertycentre.com/lagos/lekki/3364115-some-house"): "3364115", ("jiji", "https://jiji.ng/a/4bdrm-duplex-saFgVBX3QXLb3rsljTXA53Ls.html"): "saFgVBX3QXLb3rsljTXA53Ls",
        ("jiji", "https://jiji.ng/abcdefghijklmnopq/x"): "abcdefghijklmnopq", ("propertypro", "https://propertypro.ng/about"): None, ("other", "https://x/property/a-7NUGY"): None,
    }
    assert apply(spark, list(ids), web.external_id, "s string, u string") == list(ids.values())
    got = apply(spark, ["₦1,000", "USD 5", "$7", "9"], web.split_currency)
    assert [(r.currency, r.amount) for r in got] == [("₦", "1,000"), ("USD", " 5"), ("$", "7"), ("", "9")]
    assert apply(spark, [("jiji", "/a"), ("jiji", "http://b/a")], web.absolute_url, "s string, h string") == ["https://jiji.ng/a", "http://b/a"]
    assert apply(spark, [("jiji", "https://d/houses-apartments-for-sale/x", "₦ 5 per month"), ("propertypro", "https://a/for-shortlet/", None)], web.url_price_type, "s string, u string, p string") == ["FOR_RENT", "FOR_SHORT_LET"]


def brute_place(address, names):
    """The four tiers, written plainly."""
    if not address:
        return None, False
    clean = lambda t: " ".join(re.sub(r"[^a-z0-9\s]", " ", t.lower()).split())
    bare = lambda t: " ".join(re.sub(r"\b(" + "|".join(vocab.NOISE_WORDS) + r")\b", " ", clean(t)).split())
    ratio = lambda a, b: difflib.SequenceMatcher(None, a, b).ratio()
    order = sorted(names, key=len, reverse=True)
    found = next((n for n in order if clean(n) and clean(n) in clean(address)), None) or next((n for n in order if len(bare(n)) > 2 and bare(n) in bare(address)), None)
    if not found:
        for chunk in map(bare, re.split("[,/]", address)):
            found = found or (next((n for n in order if bare(n) and ratio(chunk, bare(n)) >= 0.85), None) if len(chunk) >= 3 else None)
    if not found:
        for word in clean(address).split():
            found = found or (next((n for n in order if len(clean(n)) >= 4 and abs(len(word) - len(clean(n))) <= 1 and ratio(word, clean(n)) >= 0.85), None) if len(word) >= 4 else None)
    return (found, True) if found else (address[:60], False)


def test_places_match_brute_force(spark):
    addresses = [
        "Lekki Phase 1, Lagos", "Old Ikoyi Ikoyi Lagos", "After Blenco Sangotedo, Ajah, Lagos", "Maitama, Abuja", "Victoria Island, Lagos", "Guzape, Abuja", "Pinnock Beach Estate, Osapa, Lekki, Lagos", "Milverton Estate, Osapa, Lekki",
        "Located at Ibeju Lekki, Lagos", "Lekki Ph1, Lagos", "Shomolu Lagos", "Ago Palace Way Okota", "Gaduwa, Abuja", "Asaba Delta", "Some Brand New Estate, Ogun State", None, "", "A" * 80 + ", Unknown City", "Gwarimpa town", "near Mabuchi/Jahi",
        "Pinock Beech, x", "Surulre road", "Pedro, Wuze 2", "  ,/ ", "Sangotedu Phase, Ajaa",
    ]
    names = list(vocab.SAMPLE_PLACES)
    df = spark.createDataFrame([(i, a) for i, a in enumerate(addresses)], "i int, raw_address string")
    out = {r.i: (r.neighbourhood, r.neighbourhood_normalised) for r in places.resolve_places(df, "raw_address", names).collect()}
    assert [out[i] for i in range(len(addresses))] == [brute_place(a, names) for a in addresses]


def test_normalise_parts_bad_rows(spark):
    from hearthline.schemas import RAW_LISTING

    row = ("T1", "propertypro", "https://u/T1", "3 Bedroom Flat for Sale", "₦45,000,000", "FOR_SALE", "3 Bedrooms", "2 Bathrooms", "Lekki Phase 1, Lekki, Lagos", "150 sqm", "Spacious 3-bed flat.", "Flat / Apartment", "Test Realty Ltd")
    good, bad = normalise(spark.createDataFrame([row, (*row[:9], ", sqm", *row[10:])], RAW_LISTING), list(vocab.SAMPLE_PLACES))
    r = good.collect()
    assert len(r) == 1 and (r[0].price_kobo, r[0].bedrooms, r[0].neighbourhood, r[0].city, r[0].property_type, r[0].floor_area_source) == (4500000000, 3, "Lekki Phase 1", "LAGOS", "FLAT_APARTMENT", "PORTAL")
    assert [x.normalise_error for x in bad.collect()] == ["unreadable floor area"]

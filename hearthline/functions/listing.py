"""Column functions that turn raw listing strings into typed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hearthline import vocab

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)\s*$"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def blank_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def _number(c: Column) -> Column:
    # a cast alone would also take endings such as 45d
    return F.when(c.rlike(_NUMBER), c.try_cast("double"))


def price_kobo(raw: Column) -> Column:
    """struct<kobo, failed>: a price text in hundredths, cut off; failed also if there is no text."""
    def value(text: Column) -> Column:
        head = text.substr(F.lit(1), F.length(text) - 1)
        millions, first = F.regexp_extract(text, r"(?iU)([\d.]+)\s*million", 1), F.regexp_extract(text, r"(?U)[\d.]+", 0)
        found = (
            F.when(text.rlike(r"(?U)\d[mM]$"), _number(head) * 1e6 * 100)
            .when(text.rlike("[bB]$"), _number(head) * 1e9 * 100)
            .when(millions != "", _number(millions) * 1e6 * 100)
            .when(first != "", _number(first) * 100)
        )
        return found.try_cast("bigint")

    text = F.when(strip(raw) != "", strip(F.regexp_replace(F.regexp_replace(raw, "[,₦N]", ""), "naira", "")))
    # each step's array holds what the next one reads several times, so it is worked out once
    kobo = F.transform(F.array(text), value)
    return F.transform(kobo, lambda k: F.struct(k.alias("kobo"), k.isNull().alias("failed")))[0]


def floor_area_sqm(raw: Column) -> Column:
    """Square metres as given, or from square feet to one digit (halves away from zero)."""
    # The units' patterns and the factor.
    metres = F.regexp_replace(F.regexp_extract(raw, r"(?iU)([\d,]+\.?\d*)\s*(?:sqm|sq\.?\s*m\b|m²)", 1), ",", "")
    feet = F.regexp_replace(F.regexp_extract(raw, r"(?iU)([\d,]+\.?\d*)\s*(?:sqft|sq\.?\s*ft\b)", 1), ",", "")
    return F.when(metres != "", metres.try_cast("double")).when(feet != "", F.round(feet.try_cast("double") * 0.0929, 1))


def unreadable_area(raw: Column) -> Column:
    """Whether an area text names a unit but holds commas alone: such a row goes to quarantine."""
    return F.coalesce(F.regexp_extract(raw, r"(?iU)([\d,]+\.?\d*)\s*(?:sqm|sq\.?\s*m\b|m²|sqft|sq\.?\s*ft\b)", 1).rlike("^,+$"), F.lit(False))


def first_int(raw: Column) -> Column:
    return F.regexp_extract(raw, r"(?U)\d+", 0).try_cast("smallint")


def price_type(kind: Column, title: Column, description: Column) -> Column:
    words = F.concat_ws(" ", blank_to_null(kind), blank_to_null(title), blank_to_null(description))
    return F.when(kind.isin(*vocab.PRICE_TYPES), kind).when(words.rlike("(?iU)" + vocab.RENT_WORDS), "FOR_RENT").when(words.rlike("(?iU)" + vocab.SALE_WORDS), "FOR_SALE")


def property_type(raw: Column, mapping=vocab.PROPERTY_TYPES) -> Column:
    """The mapped type of the whole text, else of the first entry that it contains, else the text itself as a name."""
    names = F.create_map(*[F.lit(x) for entry in mapping for x in entry])
    entries = F.array(*[F.struct(F.lit(word).alias("word"), F.lit(name).alias("name")) for word, name in mapping])

    def named(key: Column) -> Column:
        first = F.try_element_at(F.filter(entries, lambda e: key.contains(e["word"])), F.lit(1))
        return F.coalesce(F.try_element_at(names, key), first["name"])

    # within the array the cleaned text is worked out once
    found = F.transform(F.array(strip(F.lower(raw))), named)[0]
    return F.when(raw != "", F.coalesce(found, F.substring(F.replace(F.upper(raw), F.lit(" "), F.lit("_")), 1, 40)))


def listing_type(raw: Column, title: Column, description: Column) -> Column:
    """The stated property type, else what the title says, or the description where there is no title."""
    return F.coalesce(property_type(raw), property_type(F.coalesce(blank_to_null(title), description)))


def city(address: Column, title: Column, rules=vocab.CITIES) -> Column:
    words = F.concat_ws(" ", blank_to_null(address), blank_to_null(title))
    out = F.lit(None).cast("string")
    for name, pattern in reversed(rules):
        out = F.when(words.rlike("(?iU)" + pattern), name).otherwise(out)
    return out


def signal_flag(description: Column, pattern: str = vocab.AUDIENCE_SIGNAL) -> Column:
    return F.coalesce(description.rlike("(?iU)" + pattern), F.lit(False))


def match_text(c: Column) -> Column:
    """Lower case, letters and digits only, single blanks."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), r"[^a-z0-9\s]", " "), r"\s+", " "))


def noise_free(c: Column) -> Column:
    return without_noise(match_text(c))


def without_noise(clean: Column) -> Column:
    out = F.regexp_replace(clean, r"\b(" + "|".join(vocab.NOISE_WORDS) + r")\b", " ")
    return F.trim(F.regexp_replace(out, r"\s+", " "))

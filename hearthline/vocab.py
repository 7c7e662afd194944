"""Default vocabularies. They must equal what listings and existing results use."""

# Property types, in the order in which they are tried as substrings.
PROPERTY_TYPES = (
    ("detached duplex", "DETACHED_DUPLEX"),
    ("semi-detached duplex", "SEMI_DETACHED_DUPLEX"),
    ("semi detached duplex", "SEMI_DETACHED_DUPLEX"),
    ("terraced duplex", "TERRACED_DUPLEX"),
    ("terraced bungalow", "TERRACED_BUNGALOW"),
    ("duplex", "DETACHED_DUPLEX"),
    ("detached bungalow", "DETACHED_BUNGALOW"),
    ("semi-detached bungalow", "SEMI_DETACHED_BUNGALOW"),
    ("flat / apartment", "FLAT_APARTMENT"),
    ("flat/apartment", "FLAT_APARTMENT"),
    ("apartment", "FLAT_APARTMENT"),
    ("flat", "FLAT_APARTMENT"),
    ("studio", "STUDIO"),
    ("studio apartment", "STUDIO"),
    ("mini flat", "MINI_FLAT"),
    ("miniflat", "MINI_FLAT"),
    ("penthouse", "PENTHOUSE"),
    ("mansion", "MANSION"),
    ("villa", "VILLA"),
    ("office space", "OFFICE"),
    ("warehouse", "WAREHOUSE"),
    ("shop", "COMMERCIAL_SHOP"),
    ("showroom", "SHOWROOM"),
    ("commercial property", "COMMERCIAL_OTHER"),
    ("land", "LAND"),
    ("plot of land", "LAND"),
    ("serviced land", "LAND_SERVICED"),
)

# Price kinds that stand as given, and the words that tell them.
PRICE_TYPES = ("FOR_SALE", "FOR_RENT", "FOR_SHORT_LET")
RENT_WORDS = r"\b(rent|per\s+year|/year|per\s+annum|p\.?a\.?|lease|to\s+let)\b"
SALE_WORDS = r"\b(sale|for\s+sale|outright|buy|purchase)\b"

# Cities, in the order in which they are tried.
CITIES = (
    ("LAGOS", r"\b(lagos|lekki|victoria\s+island|ikoyi|ikeja|surulere|yaba)\b"),
    ("ABUJA", r"\b(abuja|fct|maitama|asokoro|wuse|garki|gwarinpa)\b"),
    ("PH", r"\b(port\s+harcourt|p\.?h\.?)\b"),
    ("ENUGU", r"\benugu\b"),
    ("KANO", r"\bkano\b"),
    ("IBADAN", r"\bibadan\b"),
    ("IMO", r"\bimo\b"),
    ("OGUN", r"\bogun\b"),
    ("EDO", r"\b(edo|benin)\b"),
    ("NASSARAWA", r"\bnassarawa\b"),
)

# Phrases of a description that speak to buyers abroad.
AUDIENCE_SIGNAL = (
    r"\b(diaspora|dollar[\s-]denominated|forex\s+accepted|forex\s+payment\s+accepted|payment\s+in\s+usd|suitable\s+for\s+returnees|"
    r"diaspora[\s-]friendly|diaspora[\s-]targeted|expatriates?|returning\s+nig(?:erian)?|payment\s+in\s+foreign\s+currency|usd\s+payment)\b"
)

# Words of an address that say nothing about the place.
NOISE_WORDS = (
    "estate", "estates", "extension", "extensions", "phase", "ph", "district", "districts", "zone", "zones", "area", "areas", "street", "st",
    "road", "rd", "avenue", "ave", "close", "cl", "court", "ct", "layout", "gardens", "garden", "villas", "villa", "axis", "stop", "bus stop",
)

# Phrases of a page whose listing is gone.
REMOVAL_PHRASES = (
    "listing not found",
    "property not found",
    "this listing has been removed",
    "this listing is no longer available",
    "listing has expired",
    "this property has been sold",
    "advert not found",
    "this ad has been deleted",
    "this ad no longer exists",
    "this property is no longer available",
    "page not found",
    "404 - page not found",
    "oops! page not found",
    "the page you are looking for",
)

#: A small sample of place names, with which results are compared; the full vocabulary is the user's own
#: table (name, in order of preference).
SAMPLE_PLACES = (
    "Lekki Phase 1", "Lekki Phase 2", "Osapa London", "Osapa", "Pinnock Beach Estate", "Sangotedo", "Ago Palace", "Okota", "Shomolu", "Ajah",
    "Surulere", "Yaba", "Ikeja", "Maitama", "Asokoro", "Wuse 2", "Wuse", "Gwarinpa", "Mabushi", "Guzape", "Gaduwa", "Asaba", "Ibeju-Lekki",
    "Ibeju Lekki", "Lekki", "Victoria Island", "Ikoyi", "Port Harcourt", "Ibadan", "Enugu", "Benin City",
    "Harbour Bus Stop Lane",
)

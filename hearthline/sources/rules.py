"""Extraction rules per source, as data. Selectors and words must equal what the pages hold."""

_CITY_WORDS = ("lagos", "abuja", "enugu", "ph", "kano", "ibadan")
_MONEY = ("₦", "$", "USD")
_ADDRESS = ("contains_any", "p span div", _CITY_WORDS, 150)
_ABOUT = ("class_hint_long", "div", ("desc", "detail", "about"))

#: source -> field -> rules in the order in which they are tried
FIELDS = {
    "propertypro": {
        "title": (("first", "h1.page-heading"), ("first", "h1")),
        "currency": (("nth_of_kind", ".property-pricing>.pricing>h2>strong", 2),),
        "price": (("first", ".property-pricing>.pricing>h2>strong"),),
        "whole_price": (("starts_with_digit", "span h2 h3 div", _MONEY),),
        "raw_bedrooms": (("first", ".property-contact-block>.property-pros ul li"), ("short_keyword_digit", "li span p div", ("bed", "bedroom"))),
        "raw_bathrooms": (("first", ".property-contact-block>.property-pros ul li"), ("short_keyword_digit", "li span p div", ("bath", "bathroom"))),
        "raw_floor_area": (("first", "span[data-tooltip=Size] strong"),),
        "raw_address": (("first", ".content-block>p"), (*_ADDRESS, ("h1.page-heading", "h1"))),
        "description": (("first", ".content-block>.line-paragraph"), _ABOUT),
        "agent_name": (
            ("first", "#sidebar .flex-grow-1>a>h4"),
            ("container_hint_short", "h4 h5 span a", ("sidebar", "agent", "market", "owner", "contact"), ("contact", "agent", "whatsapp", "call", "phone")),
        ),
    },
    "privateproperty": {
        "title": (("first", ".property-info>h1"), ("first", "h1")),
        "price": (("nth_of_kind", ".property-info .price>strong", 2), ("starts_with_digit", "span strong h2 h3 div", _MONEY)),
        "raw_bedrooms": (("first", ".property-info .property-benefit>li"), ("short_keyword_digit", "li span p div", ("bed", "bedroom"))),
        "raw_bathrooms": (("first", ".property-info .property-benefit>li"), ("short_keyword_digit", "li span p div", ("bath", "bathroom"))),
        "raw_address": (("first", ".property-info>p"), (*_ADDRESS, (".property-info>h1", "h1"))),
        "description": (("first", ".description-property>.row .description-list"), _ABOUT),
    },
    "nigeriapropertycentre": {
        "title": (("first", ".property-details>h4"), ("first", "h1")),
        "currency": (("first", ".property-details-price span[itemprop=priceCurrency]"),),
        "price": (("first", ".property-details-price span[itemprop=price]"),),
        "whole_price": (("starts_with_digit", "span", _MONEY),),
        "raw_bedrooms": (("with_next", ".fa-bed+span"), ("label_sibling", "span", "Bedrooms", " Bedrooms")),
        "raw_bathrooms": (("with_next", "i.fa-bath+span[itemprop=value]"), ("label_sibling", "span", "Bathrooms", " Bathrooms")),
        "raw_address": (
            ("first", ".property-details>address"),
            ("marked_box", "div", ("items-start", "text-sm"), ("svg", "span"), _CITY_WORDS),
            ("contains_any", "span", _CITY_WORDS, None, (), "div"),
        ),
        "description": (("first", "p[itemprop=description]"), ("section_after_heading", "h2", "about this property", "div[x-ref=body]")),
        "property_type_raw": (("first", "span.property-type"), ("label_sibling", "span", "Property type"), ("first_with", "main p", ("sale", "rent", "let"))),
        "agent_name": (("first", ".disclaimer .voffset-bottom-0>strong"), ("link_after_heading", "h2", "marketed by", ("/agents/", "/property-owners/"))),
    },
    "jiji": {
        "url": (("canonical",),),
        "title": (("first", "h1"),),
        "price": (("first", "div.qa-advert-price-view-title"),),
        "raw_address": (("first", "div.b-advert-info-statistics--region"),),
        "description": (("first", "div.qa-advert-description"),),
        "property_type_raw": (("first", "div.b-advert-icon-attribute", 0),),
        "raw_bedrooms": (("first", "div.b-advert-icon-attribute", 1),),
        "raw_bathrooms": (("first", "div.b-advert-icon-attribute", 2),),
        "agent_name": (("first", "div.b-seller-block__name"),),
    },
}
#: Sources whose listings need a price to count, and those that also need its currency.
NEEDS_PRICE = ("propertypro", "privateproperty", "nigeriapropertycentre")
NEEDS_CURRENCY = ("propertypro", "nigeriapropertycentre")

#: source -> (card, whether all of its links count)
CARDS = {
    "propertypro": ((".pl-title", False),),
    "privateproperty": ((".similar-listings-info", False),),
    "nigeriapropertycentre": ((".wp-block-title", True), ("article", True)),
    "jiji": (("div.b-advert-card", False),),
}

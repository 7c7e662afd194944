"""Declared schemas of the stored tables."""

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(), "smallint": T.ShortType(), "double": T.DoubleType(), "boolean": T.BooleanType(),
    "date": T.DateType(), "timestamp_ntz": T.TimestampNTZType(), "decimal(8,2)": T.DecimalType(8, 2),
}


def _struct(text: str) -> T.StructType:
    """``name type [not null], ...``; needs no session."""
    fields = []
    for item in text.split(", "):
        name, kind, *rest = item.split(" ", 2)
        fields.append(T.StructField(name, _TYPES[kind], nullable=not rest))
    return T.StructType(fields)


RAW_LISTING = _struct(
    "external_id string not null, source string not null, url string not null, title string not null, raw_price string, raw_price_type string, "
    "raw_bedrooms string, raw_bathrooms string, raw_address string, raw_floor_area string, description string, property_type_raw string, agent_name string"
)
LISTING = _struct(
    "id bigint, external_id string not null, source string not null, url string not null, title string, description string, price_kobo bigint, "
    "price_parse_failed boolean not null, price_type string, property_type string, bedrooms smallint, bathrooms smallint, floor_area_sqm decimal(8,2), "
    "floor_area_source string, raw_address string, neighbourhood string, neighbourhood_normalised boolean not null, city string, lat double, lng double, "
    "geocoded boolean not null, agent_name string, diaspora_targeted boolean not null, listing_status string not null, suspected_sold boolean not null, "
    "missed_run_count smallint not null, first_seen_at timestamp_ntz not null, last_seen_at timestamp_ntz not null, last_health_check_at timestamp_ntz, next_health_check_at timestamp_ntz"
)
LISTING_HISTORY = _struct("id bigint, listing_id bigint not null, event_type string not null, old_value bigint, new_value bigint, event_date date not null, notes string")
GEOCODE_CACHE = _struct("neighbourhood string not null, city string not null, lat double not null, lng double not null")
SCRAPE_RUNS = _struct(
    "id bigint, run_at timestamp_ntz not null, source string not null, new_listings int not null, updated_listings int not null, suspected_sold int not null, "
    "price_changes int not null, status string not null, error_message string, duration_seconds decimal(8,2)"
)
SNAPSHOTS = _struct(
    "id string, city string, neighbourhood string, snapshot_week date, avg_days_on_market double, computed_at timestamp_ntz, active_listing_count bigint, "
    "new_listings_count bigint, price_reduced_count bigint, median_price_kobo double, p25 double, p75 double, p90 double"
)
FETCH_LOG = _struct("listing_id bigint, source string, external_id string, url string, status int, final_url string, body string, error string")
CHECK_RESULT = _struct("listing_id bigint, source string, external_id string, is_removed boolean, observed_price bigint, error string")

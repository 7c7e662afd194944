"""DuckDB SQL for the registered queries, written apart from the operators."""

from __future__ import annotations

from hearthline import vocab
from hearthline.plans.queries import NATIONS, PRIORITIES, RUNS_NOW, SCRAPED
from hearthline.sources.adapters import NOW, with_views

NOW_SQL = f"TIMESTAMP '{NOW}'"
SOURCES = ", ".join(f"'{s}'" for s in SCRAPED)


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _clean(c: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(lower({c}), '[^a-z0-9\s]', ' ', 'g'), '\s+', ' ', 'g'))"


def _bare(c: str) -> str:
    return rf"trim(regexp_replace(regexp_replace({_clean(c)}, '\b({'|'.join(vocab.NOISE_WORDS)})\b', ' ', 'g'), '\s+', ' ', 'g'))"


def _names(names) -> str:
    rows = ", ".join(f"({k}, {_q(n)})" for k, n in enumerate(sorted(names, key=lambda x: -len(x))))
    return f"names AS (SELECT rnk, name, {_clean('name')} AS clean, {_bare('name')} AS bare FROM (VALUES {rows}) v(rnk, name))"


#: What tiers three and four find in the views, by the plain version in the tests: SQL has no ratio of matching blocks.
SIMILAR = "SELECT * FROM (VALUES ('Gwarimpa Town', 'Gwarinpa'), ('Mabuchi', 'Mabushi')) v(raw_address, place)"


def _places(table: str, similar: str = "SELECT NULL AS raw_address, NULL AS place") -> str:
    """raw_address and place of each address that tiers one and two resolve, and what ``similar`` adds for the others."""
    return f"""addr AS (SELECT DISTINCT raw_address, {_clean('raw_address')} AS clean, {_bare('raw_address')} AS bare FROM {table} WHERE raw_address <> ''),
t1 AS (SELECT raw_address, arg_min(name, rnk) AS place FROM addr a JOIN names v ON v.clean <> '' AND contains(a.clean, v.clean) GROUP BY raw_address),
t2 AS (SELECT raw_address, arg_min(name, rnk) AS place FROM addr a JOIN names v ON length(v.bare) > 2 AND a.bare <> '' AND contains(a.bare, v.bare) GROUP BY raw_address),
t3 AS ({similar}),
found AS (SELECT raw_address, coalesce(t1.place, t2.place, t3.place) AS place FROM addr LEFT JOIN t1 USING (raw_address) LEFT JOIN t2 USING (raw_address) LEFT JOIN t3 USING (raw_address))"""


_STRIP = r"regexp_replace(regexp_replace({}, '^\s+', ''), '\s+$', '')"
_TEXT = _STRIP.format("replace(regexp_replace(raw_price, '[,₦N]', 'g', 'g'), 'naira', '')").replace("'g', 'g'", "'', 'g'")
PRICE = rf"""CASE WHEN {_STRIP.format('raw_price')} = '' THEN NULL
 WHEN regexp_matches(txt, '[0-9][mM]$') THEN CASE WHEN regexp_full_match(left(txt, length(txt) - 1), '[+-]?(\d+\.?\d*|\.\d+)') THEN CAST(trunc(CAST(left(txt, length(txt) - 1) AS DOUBLE) * 1e6 * 100) AS BIGINT) END
 WHEN regexp_matches(txt, '[bB]$') THEN CASE WHEN regexp_full_match(left(txt, length(txt) - 1), '[+-]?(\d+\.?\d*|\.\d+)') THEN CAST(trunc(CAST(left(txt, length(txt) - 1) AS DOUBLE) * 1e9 * 100) AS BIGINT) END
 WHEN regexp_matches(txt, '(?i)[\d.]+\s*million') THEN CAST(trunc(TRY_CAST(regexp_extract(txt, '(?i)([\d.]+)\s*million', 1) AS DOUBLE) * 1e6 * 100) AS BIGINT)
 WHEN regexp_matches(txt, '[\d.]+') THEN CAST(trunc(TRY_CAST(regexp_extract(txt, '[\d.]+') AS DOUBLE) * 100) AS BIGINT) END"""
_WORDS = "concat_ws(' ', nullif({}, ''), nullif({}, ''), nullif({}, ''))"
_KIND = _WORDS.format("raw_price_type", "title", "description")
PRICE_TYPE = f"""CASE WHEN raw_price_type IN ('FOR_SALE', 'FOR_RENT', 'FOR_SHORT_LET') THEN raw_price_type WHEN regexp_matches({_KIND}, {_q('(?i)' + vocab.RENT_WORDS)}) THEN 'FOR_RENT'
 WHEN regexp_matches({_KIND}, {_q('(?i)' + vocab.SALE_WORDS)}) THEN 'FOR_SALE' END"""


def _property(c: str) -> str:
    exact = " ".join(f"WHEN trim(lower({c})) = {_q(w)} THEN '{n}'" for w, n in vocab.PROPERTY_TYPES)
    held = " ".join(f"WHEN contains(trim(lower({c})), {_q(w)}) THEN '{n}'" for w, n in vocab.PROPERTY_TYPES)
    return f"CASE WHEN {c} <> '' THEN coalesce(CASE {exact} END, CASE {held} END, left(replace(upper({c}), ' ', '_'), 40)) END"


PROPERTY = f"coalesce({_property('property_type_raw')}, {_property('coalesce(nullif(title, $$$$), description)')})"
_WHERE = "concat_ws(' ', nullif(raw_address, ''), nullif(title, ''))"
CITY = "CASE " + " ".join(f"WHEN regexp_matches({_WHERE}, {_q('(?i)' + p)}) THEN '{n}'" for n, p in vocab.CITIES) + " END"
FLAG = f"coalesce(regexp_matches(description, {_q('(?i)' + vocab.AUDIENCE_SIGNAL)}), FALSE)"
_SQM, _SQFT = r"(?i)([\d,]+\.?\d*)\s*(?:sqm|sq\.?\s*m\b|m²)", r"(?i)([\d,]+\.?\d*)\s*(?:sqft|sq\.?\s*ft\b)"
AREA = f"""CASE WHEN replace(regexp_extract(raw_floor_area, '{_SQM}', 1), ',', '') <> '' THEN CAST(replace(regexp_extract(raw_floor_area, '{_SQM}', 1), ',', '') AS DOUBLE)
 WHEN replace(regexp_extract(raw_floor_area, '{_SQFT}', 1), ',', '') <> '' THEN round(CAST(replace(regexp_extract(raw_floor_area, '{_SQFT}', 1), ',', '') AS DOUBLE) * 0.0929, 1) END"""
RAW = with_views("raw_v") + f", raw_t AS (SELECT *, {_TEXT} AS txt FROM raw_v)"


def _int(c: str) -> str:
    return rf"TRY_CAST(regexp_extract({c}, '\d+') AS SMALLINT)"


_LAST = "last AS (SELECT * FROM obs_v QUALIFY row_number() OVER (PARTITION BY source, external_id ORDER BY seq DESC) = 1)"
_CASES = f"""{_LAST}, j AS (SELECT coalesce(s.source, o.source) AS k_source, coalesce(s.external_id, o.external_id) AS k_id, s.id, s.url AS s_url, s.title AS s_title, s.price_kobo AS s_price, s.price_parse_failed AS s_failed, s.raw_address, s.neighbourhood,
  s.neighbourhood_normalised, s.city, s.lat AS s_lat, s.lng AS s_lng, s.geocoded AS s_geo, s.listing_status, s.suspected_sold, s.missed_run_count, s.first_seen_at, s.last_seen_at, s.last_health_check_at, s.next_health_check_at,
  o.url, o.title, o.price_kobo, o.price_parse_failed, o.lat, o.lng, o.geocoded, o.seq,
  CASE WHEN o.source IS NOT NULL AND s.source IS NULL THEN 'N' WHEN o.source IS NOT NULL AND s.listing_status <> 'ACTIVE' THEN 'R' WHEN o.source IS NOT NULL THEN 'U' WHEN s.listing_status = 'ACTIVE' AND s.source IN ({SOURCES}) THEN 'M' ELSE 'O' END AS kase
  FROM listings_v s FULL OUTER JOIN last o ON s.source = o.source AND s.external_id = o.external_id)"""
UPSERT = with_views("listings_v", "obs_v") + ", " + _CASES
_EVENTS = f"""SELECT k_source AS source, k_id AS external_id, CASE WHEN kase IN ('N', 'R') THEN 'LISTED' ELSE 'PRICE_CHANGE' END AS event_type, CASE WHEN kase = 'U' THEN s_price END AS old_value, price_kobo AS new_value,
 CAST({NOW_SQL} AS DATE) AS event_date, CAST(NULL AS VARCHAR) AS notes FROM j WHERE kase IN ('N', 'R') OR (kase = 'U' AND s_price <> price_kobo)"""
_STATS = """per AS (SELECT k_source AS source, count(*) FILTER (kase IN ('N', 'R')) AS new, count(*) FILTER (kase = 'U') AS updated, count(*) FILTER (kase = 'U' AND s_price <> price_kobo) AS price_changes, count(*) AS keys FROM j WHERE seq IS NOT NULL GROUP BY k_source),
tot AS (SELECT source, count(*) AS n FROM obs_v GROUP BY source), st AS (SELECT source, new, updated, price_changes, n - keys AS duplicates_dropped FROM per JOIN tot USING (source))"""
_DROPPED = "SELECT DISTINCT listing_id FROM history_v WHERE new_value < old_value"
_GAZ = "gz AS (SELECT lower(neighbourhood) AS nb, lower(coalesce(city, '')) AS ct, first(lat ORDER BY neighbourhood, city) AS lat, first(lng ORDER BY neighbourhood, city) AS lng FROM gaz_v GROUP BY 1, 2)"
_GAZ_JOIN = "LEFT JOIN gz ON gz.nb = lower(nullif(l.neighbourhood, '')) AND gz.ct = lower(coalesce(l.city, ''))"


def _cohort(age_young: str, age_middle: str, at: str) -> str:
    return f"CASE WHEN {age_young} THEN {at} + INTERVAL 164160 SECOND WHEN {age_middle} THEN {at} + INTERVAL 587520 SECOND ELSE {at} + INTERVAL 1192320 SECOND END"


_DAYS = f"floor((epoch_us({NOW_SQL}) - epoch_us(first_seen_at)) / 86400e6)"
_PHRASE = "(" + " OR ".join(f"contains(lower(body), {_q(p)})" for p in vocab.REMOVAL_PHRASES) + ")"
_CLASSES = f"""cl AS (SELECT *, CASE WHEN error IS NOT NULL THEN NULL WHEN status = 404 THEN 'not_found' WHEN final_url <> url AND NOT contains(final_url, external_id) THEN 'redirected' WHEN status = 200 AND {_PHRASE} THEN 'phrase'
 WHEN status = 200 THEN 'live' ELSE 'unreachable' END AS reason FROM fetch_v),
res AS (SELECT listing_id, source, external_id, reason IN ('not_found', 'redirected', 'phrase') AS is_removed, CASE WHEN reason = 'live' THEN observed_price END AS observed_price, reason, error FROM cl)"""
_APPLY = f"""{_CLASSES}, ck AS (SELECT l.*, r.listing_id IS NOT NULL AS checked, coalesce(r.is_removed, FALSE) AS gone, r.observed_price, d.listing_id IS NOT NULL AS dropped, {_DAYS} AS days
 FROM listings_v l LEFT JOIN (SELECT * FROM res WHERE error IS NULL) r ON r.listing_id = l.id LEFT JOIN ({_DROPPED}) d ON d.listing_id = l.id),
ck2 AS (SELECT *, checked AND NOT gone AS live, coalesce(checked AND NOT gone AND observed_price <> price_kobo, FALSE) AS repriced FROM ck)"""
CHECKS = with_views("listings_v", "history_v", "fetch_v") + ", " + _APPLY


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    out["weekly_snapshots"] = f"""{with_views("listings_v", "history_v")},
base AS (SELECT * FROM listings_v WHERE neighbourhood_normalised AND city IS NOT NULL),
weeks AS (SELECT CAST(unnest(generate_series((SELECT date_trunc('week', min(first_seen_at)) FROM base)::TIMESTAMP, TIMESTAMP '2001-12-31', INTERVAL 7 DAY)) AS DATE) AS week),
lw AS (SELECT b.*, week, week + 6 AS sunday FROM base b JOIN weeks ON b.first_seen_at < week + INTERVAL 7 DAY AND (listing_status = 'ACTIVE' OR last_seen_at >= week)),
h AS (SELECT listing_id, event_date, first(old_value ORDER BY id, old_value) AS old_value FROM history_v GROUP BY 1, 2),
red AS (SELECT DISTINCT listing_id, CAST(date_trunc('week', event_date) AS DATE) AS week FROM history_v WHERE new_value < old_value),
p AS (SELECT lw.city, lw.neighbourhood, lw.week, coalesce(h.old_value, lw.price_kobo) AS price, date_trunc('week', first_seen_at) = lw.week AS is_new, red.listing_id IS NOT NULL AS reduced,
  greatest(0, date_diff('day', CAST(first_seen_at AS DATE), CASE WHEN listing_status = 'REMOVED' AND last_seen_at < lw.week + INTERVAL 7 DAY THEN CAST(last_seen_at AS DATE) ELSE lw.sunday END)) AS days
  FROM lw ASOF LEFT JOIN h ON h.listing_id = lw.id AND lw.sunday < h.event_date LEFT JOIN red ON red.listing_id = lw.id AND red.week = lw.week),
g AS (SELECT city, neighbourhood, week, count(*) AS n, count(*) FILTER (is_new) AS new_n, count(*) FILTER (reduced) AS red_n, round(avg(days), 1) AS dom,
  quantile_cont(price, 0.25) AS p25, quantile_cont(price, 0.5) AS p50, quantile_cont(price, 0.75) AS p75, quantile_cont(price, 0.9) AS p90 FROM p GROUP BY 1, 2, 3 HAVING count(*) > 1)
SELECT md5(concat(neighbourhood, strftime(week, '%Y-%m-%d'))) AS id, city, neighbourhood, week AS snapshot_week, dom AS avg_days_on_market, {NOW_SQL} AS computed_at, n AS active_listing_count, new_n AS new_listings_count,
  red_n AS price_reduced_count, p50 AS median_price_kobo, p25, p75, p90 FROM g QUALIFY row_number() OVER (PARTITION BY neighbourhood, week ORDER BY city) = 1"""
    out["active_snapshot"] = f"{with_views('listings_v')} SELECT source, external_id, price_kobo FROM listings_v WHERE listing_status = 'ACTIVE'"
    out["parse_price"] = f"{RAW} SELECT external_id, {PRICE} AS price_kobo, ({PRICE}) IS NULL AS price_parse_failed FROM raw_t"
    out["floor_area"] = f"{RAW} SELECT external_id, {AREA} AS floor_area_sqm FROM raw_t"
    out["room_counts"] = f"{RAW} SELECT external_id, {_int('raw_bedrooms')} AS bedrooms, {_int('raw_bathrooms')} AS bathrooms FROM raw_t"
    out["price_type"] = f"{RAW} SELECT external_id, {PRICE_TYPE} AS price_type FROM raw_t"
    out["property_type"] = f"{RAW} SELECT external_id, {PROPERTY} AS property_type FROM raw_t"
    out["infer_city"] = f"{RAW} SELECT external_id, {CITY} AS city FROM raw_t"
    out["audience_flag"] = f"{RAW} SELECT external_id, {FLAG} AS diaspora_targeted FROM raw_t"
    out["normalise_listings"] = f"""{RAW}, {_names(vocab.SAMPLE_PLACES)}, {_places('raw_v', SIMILAR)} SELECT external_id, source, url, title, description, {PRICE} AS price_kobo, ({PRICE}) IS NULL AS price_parse_failed, {PRICE_TYPE} AS price_type, {PROPERTY} AS property_type,
 {_int('raw_bedrooms')} AS bedrooms, {_int('raw_bathrooms')} AS bathrooms, {AREA} AS floor_area_sqm, CASE WHEN ({AREA}) IS NOT NULL THEN 'PORTAL' ELSE 'NONE' END AS floor_area_source, raw_address, {CITY} AS city, agent_name,
 coalesce(place, left(nullif(raw_address, ''), 60)) AS neighbourhood, place IS NOT NULL AS neighbourhood_normalised, CAST(NULL AS DOUBLE) AS lat, CAST(NULL AS DOUBLE) AS lng, FALSE AS geocoded,
 {FLAG} AS diaspora_targeted, CASE WHEN regexp_matches(regexp_extract(raw_floor_area, '(?i)([\\d,]+\\.?\\d*)\\s*(?:sqm|sqft)', 1), '^,+$') THEN 'unreadable floor area' END AS normalise_error FROM raw_t LEFT JOIN found USING (raw_address)"""
    out["successful_sources"] = f"{with_views('runs_v')} SELECT DISTINCT source FROM runs_v WHERE status = 'SUCCESS' AND new_listings > 0"
    out["total_listings"] = f"{with_views('listings_v')} SELECT count(*) AS total_listings FROM listings_v"
    out["concatenated_feeds"] = f"{with_views('raw_v')} SELECT source, external_id, url FROM raw_v WHERE source IN ('alpha', 'gamma') UNION ALL SELECT source, external_id, url FROM raw_v WHERE source = 'alpha'"
    out["error_alerts"] = f"{with_views('fetch_v')} SELECT listing_id, left(body, 1000) AS message FROM fetch_v"
    for name, similar in (("neighbourhood_exact", ()), ("neighbourhood_fuzzy", (SIMILAR,))):
        out[name] = f"""{with_views('raw_v')}, {_names(vocab.SAMPLE_PLACES)}, {_places('raw_v', *similar)}
SELECT r.raw_address, external_id, coalesce(place, left(nullif(r.raw_address, ''), 60)) AS neighbourhood, place IS NOT NULL AS neighbourhood_normalised FROM raw_v r LEFT JOIN found USING (raw_address)"""
    out["dedup_last"] = f"{with_views('obs_v')}, {_LAST} SELECT * FROM last"
    out["upsert_state"] = f"""{UPSERT} SELECT id, k_id AS external_id, k_source AS source, CASE WHEN kase IN ('N', 'U') THEN url ELSE s_url END AS url, CASE WHEN kase IN ('N', 'U') THEN title ELSE s_title END AS title,
 CASE WHEN kase IN ('N', 'U') THEN price_kobo ELSE s_price END AS price_kobo, CASE WHEN kase IN ('N', 'U') THEN price_parse_failed ELSE s_failed END AS price_parse_failed, raw_address, neighbourhood, neighbourhood_normalised, city,
 CASE WHEN kase = 'N' THEN lat WHEN kase = 'U' THEN coalesce(lat, s_lat) ELSE s_lat END AS lat, CASE WHEN kase = 'N' THEN lng WHEN kase = 'U' THEN coalesce(lng, s_lng) ELSE s_lng END AS lng,
 CASE WHEN kase IN ('N', 'U') THEN geocoded ELSE s_geo END AS geocoded, CASE WHEN kase IN ('N', 'U') THEN 'ACTIVE' ELSE listing_status END AS listing_status, CASE WHEN kase = 'N' THEN FALSE ELSE suspected_sold END AS suspected_sold,
 CAST(CASE WHEN kase IN ('N', 'U') THEN 0 WHEN kase = 'M' THEN missed_run_count + 1 ELSE missed_run_count END AS INT) AS missed_run_count, CASE WHEN kase = 'N' THEN {NOW_SQL} ELSE first_seen_at END AS first_seen_at,
 CASE WHEN kase IN ('N', 'R', 'U') THEN {NOW_SQL} ELSE last_seen_at END AS last_seen_at, last_health_check_at, next_health_check_at FROM j"""
    out["upsert_events"] = f"{UPSERT} {_EVENTS}"
    out["upsert_stats"] = f"""{UPSERT}, {_STATS} SELECT source, new, updated, price_changes, duplicates_dropped FROM st
UNION ALL SELECT NULL, coalesce(sum(new), 0)::BIGINT, coalesce(sum(updated), 0)::BIGINT, coalesce(sum(price_changes), 0)::BIGINT, coalesce(sum(duplicates_dropped), 0)::BIGINT FROM st"""
    out["upsert_state_bucketed"], out["upsert_once_stats"] = out["upsert_state"], out["upsert_stats"]
    every = ", ".join(_q(s) for s in PRIORITIES)
    done = ", ".join(_q(s) for s in PRIORITIES if s != "2-HIGH")
    out["upsert_of_successful"] = out["upsert_state"].replace(f"IN ({SOURCES})", f"IN ({done})")
    out["upsert_events_relisted"] = f"{UPSERT} {_EVENTS}".replace("WHEN kase IN ('N', 'R') THEN 'LISTED'", "WHEN kase = 'N' THEN 'LISTED' WHEN kase = 'R' THEN 'RELISTED'")
    out["upsert_once_state"] = out["upsert_state"].replace(f"IN ({SOURCES})", f"IN ({every})")
    out["history_insert"] = f"{UPSERT}, ev AS ({_EVENTS}) SELECT l.id AS listing_id, event_type, old_value, new_value, event_date, notes FROM ev JOIN listings_v l USING (source, external_id)"
    out["missed_keys"] = f"""{with_views('listings_v', 'obs_v')} SELECT source, external_id, missed_run_count FROM listings_v l WHERE listing_status = 'ACTIVE' AND source IN ({SOURCES})
 AND NOT EXISTS (SELECT 1 FROM obs_v o WHERE o.source = l.source AND o.external_id = l.external_id)"""
    out["geocode_enrich"] = f"{with_views('listings_v', 'gaz_v')}, {_GAZ} SELECT l.id, l.neighbourhood, l.city, gz.lat, gz.lng, gz.lat IS NOT NULL AS geocoded FROM listings_v l {_GAZ_JOIN}"
    out["geocode_misses"] = f"""{with_views('listings_v', 'gaz_v')}, {_GAZ}, m AS (SELECT any_value(l.neighbourhood) AS neighbourhood, min(l.city) AS city, lower(l.neighbourhood) AS nb, lower(coalesce(l.city, '')) AS ct FROM listings_v l WHERE neighbourhood <> '' GROUP BY 3, 4)
SELECT neighbourhood, city, concat(neighbourhood, ', ', coalesce(nullif(city, ''), 'Nigeria'), ', Nigeria') AS query_text FROM m WHERE NOT EXISTS (SELECT 1 FROM gz WHERE gz.nb = m.nb AND gz.ct = m.ct)"""
    out["gazetteer_extend"] = f"""{with_views('listings_v', 'gaz_v')}, n AS (SELECT neighbourhood, coalesce(city, '') AS city, CAST(id % 7 AS DOUBLE) AS lat, CAST(id % 5 AS DOUBLE) AS lng FROM listings_v)
SELECT neighbourhood, city, lat, lng FROM n WHERE NOT EXISTS (SELECT 1 FROM gaz_v g WHERE g.neighbourhood = n.neighbourhood AND g.city = n.city) QUALIFY row_number() OVER (PARTITION BY neighbourhood, city ORDER BY lat, lng) = 1"""
    out["check_candidates"] = f"""{with_views('listings_v')}, c AS (SELECT *, CASE WHEN next_health_check_at IS NULL THEN 1.0::DOUBLE ELSE ((epoch_us({NOW_SQL}) - epoch_us(last_health_check_at)) / 1e6) /
  (CASE WHEN first_seen_at >= {NOW_SQL} - INTERVAL 14 DAY THEN 164160.0::DOUBLE WHEN first_seen_at >= {NOW_SQL} - INTERVAL 60 DAY THEN 587520.0::DOUBLE ELSE 1192320.0::DOUBLE END) END AS ratio
 FROM listings_v WHERE listing_status = 'ACTIVE' AND missed_run_count > 0 AND (next_health_check_at IS NULL OR next_health_check_at < {NOW_SQL})),
r AS (SELECT *, CAST(row_number() OVER (ORDER BY ratio DESC NULLS FIRST, last_health_check_at ASC NULLS FIRST, id) AS INT) AS rank FROM c)
SELECT id, source, external_id, url, first_seen_at, price_kobo, ratio, rank, CAST(floor((rank - 1) / 50) AS INT) AS batch FROM r WHERE rank <= 1000"""
    out["check_candidates_all"] = f"{with_views('listings_v')} SELECT id, source, external_id, url, first_seen_at, price_kobo, missed_run_count, last_health_check_at, row_number() OVER w AS rank, CAST((row_number() OVER w - 1) // 50 AS INT) AS batch FROM listings_v WHERE listing_status = 'ACTIVE' WINDOW w AS (ORDER BY missed_run_count DESC, last_health_check_at NULLS FIRST, id)"
    out["classify_fetch"] = f"{with_views('fetch_v')}, {_CLASSES} SELECT listing_id, source, external_id, is_removed, observed_price, reason, error FROM res"
    out["apply_checks_state"] = f"""{CHECKS} SELECT id, external_id, source, url, title, CASE WHEN repriced THEN observed_price ELSE price_kobo END AS price_kobo, price_parse_failed, raw_address, neighbourhood, neighbourhood_normalised, city, lat, lng, geocoded,
 CASE WHEN gone THEN 'REMOVED' ELSE listing_status END AS listing_status, CASE WHEN gone THEN coalesce(days >= 30, TRUE) AND dropped ELSE suspected_sold END AS suspected_sold, CASE WHEN live THEN 0 ELSE missed_run_count END AS missed_run_count,
 first_seen_at, CASE WHEN repriced THEN {NOW_SQL} ELSE last_seen_at END AS last_seen_at, CASE WHEN checked THEN {NOW_SQL} ELSE last_health_check_at END AS last_health_check_at,
 CASE WHEN gone THEN NULL WHEN live THEN {_cohort('days < 14', 'days < 60', NOW_SQL)} ELSE next_health_check_at END AS next_health_check_at FROM ck2"""
    out["apply_checks_events"] = f"""{CHECKS} SELECT id AS listing_id, CASE WHEN gone THEN 'REMOVED' ELSE 'PRICE_CHANGE' END AS event_type, price_kobo AS old_value, CASE WHEN NOT gone THEN observed_price END AS new_value, CAST({NOW_SQL} AS DATE) AS event_date,
 CASE WHEN gone THEN 'confirmed removed by health checker' ELSE 'detected by health checker' END AS notes FROM ck2 WHERE gone OR repriced"""
    out["check_stats"] = f"""{CHECKS} SELECT count(*) FILTER (checked) AS checked, count(*) FILTER (gone) AS confirmed_removed, count(*) FILTER (live) AS confirmed_active, count(*) FILTER (repriced) AS price_changes,
 (SELECT count(*) FROM res WHERE error IS NOT NULL) AS errors FROM ck2"""
    out["check_summary"] = f"""WITH st AS ({out["check_stats"]}) SELECT checked, confirmed_active, price_changes, confirmed_removed, errors, concat('URLs checked: ', checked, chr(10), 'Still active: ', confirmed_active, chr(10),
 'Price changes: ', price_changes, chr(10), 'Confirmed removed: ', confirmed_removed, CASE WHEN errors > 0 THEN concat(chr(10), 'Errors: ', errors) ELSE '' END) AS lines FROM st"""
    out["next_check_backfill"] = f"""{with_views('listings_v')} SELECT id, CASE WHEN next_health_check_at IS NULL AND last_health_check_at IS NOT NULL THEN
 {_cohort('first_seen_at >= last_health_check_at - INTERVAL 14 DAY', 'first_seen_at >= last_health_check_at - INTERVAL 60 DAY', 'last_health_check_at')} ELSE next_health_check_at END AS next_health_check_at FROM listings_v"""
    out["suspected_sold"] = f"{with_views('listings_v', 'history_v')} SELECT id, coalesce({_DAYS} >= 30, TRUE) AND d.listing_id IS NOT NULL AS suspected_sold FROM listings_v LEFT JOIN ({_DROPPED}) d ON d.listing_id = id"
    out["last_success"] = f"{with_views('runs_v')} SELECT source, max(run_at) AS last_run_at FROM runs_v WHERE status = 'SUCCESS' GROUP BY source"
    out["run_due"] = f"""{with_views('runs_v')}, l AS (SELECT source, max(run_at) FILTER (status = 'SUCCESS') AS last_run_at FROM runs_v GROUP BY source)
SELECT source, last_run_at, ((epoch_us(TIMESTAMP '{RUNS_NOW}') - epoch_us(last_run_at)) / 1e6) / 3600 AS hours_since, coalesce(((epoch_us(TIMESTAMP '{RUNS_NOW}') - epoch_us(last_run_at)) / 1e6) / 3600 >= 22, TRUE) AS due FROM l"""
    out["run_summary"] = f"""{with_views('runs_v')} SELECT run_at, sum(new_listings)::BIGINT AS new_listings, sum(updated_listings)::BIGINT AS updated_listings, sum(price_changes)::BIGINT AS price_changes, count(*) FILTER (status <> 'SUCCESS') AS non_success,
 concat(CAST(max(duration_seconds) // 60 AS VARCHAR), 'm ', CAST(max(duration_seconds) % 60 AS VARCHAR), 's') AS duration,
 string_agg(line, chr(10) ORDER BY line) AS lines FROM (SELECT *, CASE WHEN status = 'SUCCESS' THEN concat(source, ': ', new_listings, ' new, ', updated_listings, ' updated')
  WHEN status = 'PARTIAL' THEN concat(source, ': PARTIAL - ', coalesce(error_message, 'see logs'), '; ', new_listings, ' new written') ELSE concat(source, ': FAILED - ', coalesce(error_message, 'unknown error')) END AS line FROM runs_v) x GROUP BY run_at"""
    out["run_log"] = f"""{with_views('listings_v', 'obs_v', 'runs_v')}, {_CASES}, {_STATS}, r AS (SELECT source, max(status) AS status, max(error_message) AS error FROM runs_v GROUP BY source)
SELECT {NOW_SQL} AS run_at, r.source, CAST(coalesce(st.new, 0) AS INT) AS new_listings, CAST(coalesce(st.updated, 0) AS INT) AS updated_listings, 0 AS suspected_sold, CAST(coalesce(st.price_changes, 0) AS INT) AS price_changes, status, error AS error_message,
 12.5::DOUBLE AS duration_seconds FROM r LEFT JOIN st ON st.source = r.source"""
    out["quality_ratios"] = f"""{with_views('listings_v', 'gaz_v')}, {_GAZ} SELECT count(*) AS rows, count(gz.lat) AS geocoded, coalesce(round(count(gz.lat) * 100.0::DOUBLE / nullif(count(*), 0), 1), 0.0) AS geocoded_pct,
 count(*) FILTER (NOT price_parse_failed) AS prices_parsed, coalesce(round(count(*) FILTER (NOT price_parse_failed) * 100.0::DOUBLE / nullif(count(*), 0), 1), 0.0) AS prices_parsed_pct FROM listings_v l {_GAZ_JOIN}"""
    fill = f"""{with_views('listings_v', 'gaz_v')}, {_GAZ}, {_names(NATIONS)}, open_v AS (SELECT * FROM listings_v WHERE NOT neighbourhood_normalised), {_places('open_v')},
l AS (SELECT o.id, f.place AS neighbourhood, o.city FROM open_v o JOIN found f USING (raw_address) WHERE f.place IS NOT NULL), prop AS (SELECT l.id, l.neighbourhood, l.city, gz.lat, gz.lng, gz.lat IS NOT NULL AS geocoded FROM l {_GAZ_JOIN})"""
    out["backfill_proposals"] = f"{fill} SELECT * FROM prop"
    out["backfill_stats"] = f"""{fill}, c AS (SELECT count(*) AS candidates, count(*) FILTER (raw_address <> '') AS processed FROM open_v), n AS (SELECT count(*) AS normalised, count(*) FILTER (geocoded) AS geocoded FROM prop)
SELECT candidates, processed, normalised, geocoded, coalesce(round(normalised * 100.0::DOUBLE / nullif(processed, 0), 1), 0.0) AS normalised_pct, coalesce(round(geocoded * 100.0::DOUBLE / nullif(normalised, 0), 1), 0.0) AS geocoded_pct FROM c, n"""
    placed = ", ".join(f"CASE WHEN p.id IS NOT NULL THEN p.{c} ELSE v.{c} END AS {c}" for c in ("neighbourhood", "lat", "lng", "geocoded"))
    out["backfill_state"] = f"{fill} SELECT v.* REPLACE ({placed}, p.id IS NOT NULL OR v.neighbourhood_normalised AS neighbourhood_normalised) FROM listings_v v LEFT JOIN prop p ON p.id = v.id"
    out["feed_known_cutoff"] = f"""{with_views('feed_v')}, kn AS (SELECT DISTINCT source, external_id FROM feed_v WHERE in_state), f AS (SELECT f.*, kn.source IS NOT NULL AS known, row_number() OVER (PARTITION BY source, feed ORDER BY page, position) AS pos FROM feed_v f LEFT JOIN kn USING (source, external_id) WHERE page <= 5),
i AS (SELECT *, sum(CASE WHEN known THEN 0 ELSE 1 END) OVER (PARTITION BY source, feed ORDER BY pos) AS island FROM f), r AS (SELECT *, sum(CASE WHEN known THEN 1 ELSE 0 END) OVER (PARTITION BY source, feed, island ORDER BY pos) AS run FROM i),
c AS (SELECT *, min(CASE WHEN run >= 10 THEN pos END) OVER (PARTITION BY source, feed) AS stop FROM r)
SELECT source, feed, page, position, external_id FROM c WHERE NOT known AND (stop IS NULL OR pos < stop)""".replace("position, external_id FROM c", "CAST(position AS INT) AS position, external_id FROM c")
    out["feed_failure_cutoff"] = f"""{with_views('feed_v')}, i AS (SELECT *, row_number() OVER w AS pos, sum(CASE WHEN is_item AND NOT failed THEN 1 ELSE 0 END) OVER w AS island FROM feed_v WINDOW w AS (PARTITION BY source ORDER BY feed, page, position, event_id ROWS UNBOUNDED PRECEDING)),
r AS (SELECT *, sum(CASE WHEN failed THEN 1 ELSE 0 END) OVER (PARTITION BY source, island ORDER BY pos ROWS UNBOUNDED PRECEDING) AS run FROM i), c AS (SELECT *, min(CASE WHEN run >= 12 THEN pos END) OVER (PARTITION BY source) AS stop FROM r)
SELECT source, feed, CAST(position AS INT) AS position, event_id, CAST(run AS BIGINT) AS run FROM c WHERE stop IS NULL OR pos <= stop"""
    kind = "CASE page_id % 3 WHEN 0 THEN 'for-sale' WHEN 1 THEN 'for-rent' ELSE 'short-let' END"
    out["external_ids"] = f"""WITH p AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'propertypro' WHEN 1 THEN 'privateproperty' WHEN 2 THEN 'nigeriapropertycentre' ELSE 'jiji' END AS source,
 CASE page_id % 4 WHEN 0 THEN concat('https://a.test/property/', {kind}, '-flat-', page_id + 100000) WHEN 1 THEN concat('https://b.test/listings/', {kind}, '-', page_id + 100000, '?x=1')
  WHEN 2 THEN concat('https://c.test/', {kind}, '/', page_id + 1000000, '-some-house') ELSE concat('https://d.test/houses-apartments-for-sale/x-', lpad(CAST(page_id + 100000 AS VARCHAR), 12, '0'), '.html') END AS url FROM pages)
SELECT page_id, source, url, CASE page_id % 4 WHEN 0 THEN regexp_extract(url, '/property/[^?#]+-([A-Za-z0-9]{{4,10}})(?:[?#/]|$)', 1) WHEN 1 THEN regexp_extract(url, '/listings/[^?#]+-([A-Za-z0-9]{{4,10}})(?:[?#/]|$)', 1)
  WHEN 2 THEN regexp_extract(url, '/(\\d{{5,}})(?:-[a-z0-9-]+)?(?:\\.html)?$', 1) ELSE regexp_extract(url, '-([A-Za-z0-9]{{10,}})\\.html?$', 1) END AS external_id,
 CASE WHEN page_id % 4 = 3 THEN 'FOR_SALE' WHEN contains(url, 'for-sale') THEN 'FOR_SALE' WHEN contains(url, 'for-rent') THEN 'FOR_RENT' WHEN page_id % 4 <> 0 AND contains(url, 'short-let') THEN 'FOR_SHORT_LET' END AS raw_price_type FROM p"""
    out["page_frontier"] = f"""{with_views('feed_v')}, f AS (SELECT DISTINCT source AS s, feed AS fd FROM feed_v), b AS (SELECT ['propertypro', 'privateproperty', 'nigeriapropertycentre', 'jiji'][length(s) % 4 + 1] AS source, concat(s, '-', fd) AS feed, concat('https://feed.test/', s, '/', fd) AS base FROM f)
SELECT source, feed, CAST(page AS INT) AS page, CASE WHEN page = 1 THEN base WHEN source IN ('propertypro', 'privateproperty') THEN concat(base, '&page=', page) ELSE concat(base, '?page=', page) END AS url FROM b, range(1, 6) p(page)"""
    kept = "k % 11 <> 7"
    out["site_listings"] = f"""{with_views('site_v')}, f AS (SELECT *, layout < 2 AS strict, CASE WHEN source = 'jiji' THEN layout < 4 AND html IS NOT NULL ELSE {kept} AND layout < 4 AND html IS NOT NULL END AS good FROM site_v)
SELECT CASE WHEN source = 'jiji' THEN lpad(CAST(k AS VARCHAR), 12, '0') ELSE code END AS external_id, source,
 CASE WHEN source = 'jiji' THEN concat('https://jiji.ng/houses-apartments-for-', CASE WHEN k % 2 = 0 THEN 'sale' ELSE 'rent' END, '/flat-', lpad(CAST(k AS VARCHAR), 12, '0'), '.html') ELSE url END AS url,
 CASE WHEN source IN ('propertypro', 'privateproperty') AND NOT strict THEN title || ', Lagos' ELSE title END AS title,
 CASE WHEN source = 'jiji' AND layout = 1 THEN NULL WHEN source = 'jiji' AND layout = 2 THEN cur || amount || '/Month' WHEN source IN ('propertypro', 'privateproperty') AND NOT strict THEN cur || amount || 'a year' ELSE cur || amount END AS raw_price,
 CASE WHEN source = 'jiji' THEN CASE WHEN layout = 2 OR k % 2 = 1 THEN 'FOR_RENT' ELSE 'FOR_SALE' END ELSE ['FOR_SALE', 'FOR_RENT', 'FOR_SHORT_LET'][k % 3 + 1] END AS raw_price_type,
 CASE WHEN source = 'jiji' THEN CASE WHEN layout < 3 THEN beds || 'bedrooms' END WHEN source = 'nigeriapropertycentre' THEN CASE WHEN strict THEN beds || 'Bedrooms' ELSE beds || ' Bedrooms' END WHEN strict THEN beds || ' beds' ELSE beds || ' bedrooms' END AS raw_bedrooms,
 CASE WHEN source = 'jiji' THEN CASE WHEN layout < 3 THEN baths || ' bathrooms' END WHEN source = 'nigeriapropertycentre' THEN CASE WHEN strict THEN baths || 'Bathrooms' ELSE baths || ' Bathrooms' END WHEN strict THEN beds || ' beds' ELSE baths || ' bathrooms' END AS raw_bathrooms,
 place AS raw_address, CASE WHEN source = 'propertypro' AND strict THEN beds || '0 sqm' END AS raw_floor_area,
 CASE WHEN strict OR source = 'jiji' THEN about WHEN source = 'nigeriapropertycentre' THEN about || chr(10) || 'Ask us' ELSE trim(repeat('Roomy and light. ', 8)) || chr(10) || about END AS description,
 CASE source WHEN 'jiji' THEN 'House' WHEN 'nigeriapropertycentre' THEN CASE WHEN strict THEN 'House' ELSE 'Flat for rent' END END AS property_type_raw, CASE WHEN source <> 'privateproperty' THEN agent END AS agent_name FROM f WHERE good"""
    out["site_quarantine"] = f"""{with_views('site_v')} SELECT source, url, CASE WHEN source = 'jiji' OR NOT {kept} THEN 'no external id' ELSE 'no price' END AS reason FROM site_v
WHERE html IS NULL OR layout = 4 OR (source <> 'jiji' AND NOT {kept})"""
    out["site_links"] = f"""{with_views('result_v')} SELECT source, url AS page_url, 0::INT AS position, 'https://propertypro.ng/property/a-' || code AS url, code AS external_id FROM result_v WHERE source = 'propertypro'
UNION ALL SELECT source, url, 1, 'https://o.test/about', NULL FROM result_v WHERE source = 'propertypro'
UNION ALL SELECT source, url, 0, 'https://privateproperty.ng/listings/b-' || code || '?p=1', code FROM result_v WHERE source = 'privateproperty'
UNION ALL SELECT source, url, 0, 'https://nigeriapropertycentre.com/l/' || code || '-x/', code FROM result_v WHERE source = 'nigeriapropertycentre'
UNION ALL SELECT source, url, 1, 'https://o.test/' || code, code FROM result_v WHERE source = 'nigeriapropertycentre'
UNION ALL SELECT source, url, 0, 'https://jiji.ng/lagos/flat-' || lpad(code, 12, '0') || '.html', lpad(code, 12, '0') FROM result_v WHERE source = 'jiji'"""
    out["site_checks"] = f"""{with_views('site_v')}, f AS (SELECT *, CASE WHEN k % 23 = 0 THEN NULL WHEN k % 9 = 0 THEN 'not_found' ELSE 'live' END AS reason FROM site_v)
SELECT k AS listing_id, source, code AS external_id, reason = 'not_found' AS is_removed, CASE WHEN reason = 'live' AND html IS NOT NULL AND layout < 4 AND CASE WHEN source = 'jiji' THEN layout <> 1 ELSE {kept} END THEN (k % 900 + 1) * 100000 END AS observed_price, reason,
 CASE WHEN k % 23 = 0 THEN 'timeout' END AS error FROM f"""
    out["log_state_checks"] = out["apply_checks_state"]
    out["snapshots_refreshed"] = out["weekly_snapshots"]
    out["missed_runs_stream"] = f"""{with_views('sight_v')}, r AS (SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY seen_at, kind) AS k FROM sight_v), z AS (SELECT listing_id, coalesce(max(k) FILTER (kind IN ('seen', 'active')), 0) AS zero FROM r GROUP BY listing_id)
SELECT r.listing_id, count(*) FILTER (kind = 'missed' AND k > zero) AS missed_run_count, arg_max(kind, k) AS last_result, max(seen_at) AS last_at FROM r JOIN z USING (listing_id) GROUP BY r.listing_id"""
    return out

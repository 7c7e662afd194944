"""Listing-shaped views of the test tables, in SQL that Spark and DuckDB read alike: ``{orders}`` and the like name the
tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "part", "orders", "lineitem", "events", "pages")
NOW = "2002-01-07 00:00:00"

_LONG = "repeat('Roomy and light. ', 8)"
_MONEY = "concat(cur, amount)"
# Detail pages of the four sources, with the elements that their rules look for first, and with those that they fall back on.
_PAGES = f"""CASE WHEN k % 17 = 5 THEN NULL
 WHEN source = 'propertypro' AND layout < 2 THEN concat('<html><body><h1 class="page-heading"> ', title, '</h1><div class="property-pricing"><div class="pricing"><h2><strong>', amount, '</strong><strong>', cur, '</strong></h2></div></div><div class="property-contact-block"><div class="property-pros"><ul><li>', beds, ' beds</li><li>', baths, ' baths</li></ul></div></div><span data-tooltip="Size"><strong>', beds, '0 sqm</strong></span><div class="content-block"><p>', place, '</p><div class="line-paragraph">', about, '</div></div><div id="sidebar"><div class="flex-grow-1"><a><h4>', agent, '</h4></a></div></div></body></html>')
 WHEN source = 'privateproperty' AND layout < 2 THEN concat('<div class="property-info"><h1>', title, '</h1><p>', place, '</p><div class="price"><strong>per plot</strong><strong>', {_MONEY}, '</strong></div><ul class="property-benefit"><li>', beds, ' beds</li><li>', baths, ' baths</li></ul></div><div class="description-property"><div class="row"><div class="description-list">', about, '</div></div></div>')
 WHEN source = 'nigeriapropertycentre' AND layout < 2 THEN concat('<div class="property-details"><h4>', title, '</h4><address>', place, '</address></div><div class="property-details-price"><span itemprop="priceCurrency">', cur, '</span><span itemprop="price">', amount, '</span></div><i class="fa fa-bed"></i><span>', beds, '</span><b> Bedrooms</b><i class="fa-bath"></i><span itemprop="value">', baths, '</span><span itemprop="name"> Bathrooms</span><p itemprop="description">', about, '</p><span class="property-type">House</span><div class="disclaimer"><div class="voffset-bottom-0"><strong>', agent, '</strong></div></div>')
 WHEN source = 'jiji' THEN concat(CASE WHEN layout < 4 THEN concat('<link rel="canonical" href="https://jiji.ng/houses-apartments-for-', CASE WHEN k % 2 = 0 THEN 'sale' ELSE 'rent' END, '/flat-', lpad(CAST(k AS STRING), 12, '0'), '.html">') ELSE '' END, '<h1>', title, '</h1>', CASE WHEN layout <> 1 THEN concat('<div class="qa-advert-price-view-title">', {_MONEY}, CASE WHEN layout = 2 THEN '/Month' ELSE '' END, '</div>') ELSE '' END,
  '<div class="b-advert-info-statistics--region">', place, '</div><div class="b-advert-icon-attribute">House</div>', CASE WHEN layout < 3 THEN concat('<div class="b-advert-icon-attribute"><b>', beds, '</b> bedrooms</div><div class="b-advert-icon-attribute">', baths, ' bathrooms</div>') ELSE '' END, '<div class="qa-advert-description">', about, '</div><div class="b-seller-block__name">', agent, '</div>')
 WHEN layout = 4 THEN concat('<h1>', title, '</h1><span>$ on request</span><p>', place, '</p>')
 WHEN source = 'nigeriapropertycentre' THEN concat('<p>For sale: see below</p><main><p>Flat for rent</p><h1>', title, '</h1><h3>$ 1</h3><span>', {_MONEY}, '</span><div><span>', beds, '</span><span>BEDROOMS</span></div><div><b><span>', baths, '</span></b><span>Bathrooms</span></div>', CASE WHEN layout = 2 THEN concat('<p><span>Lagos only</span></p><div class="x"><span>', place, '</span></div>') ELSE concat('<div><span>Abuja too</span></div><div class="flex items-start text-sm"><svg></svg><span>', place, '</span></div>') END,
  '<section><div><h2>About this Property</h2></div><div x-ref="body">', about, '<br>Ask us</div></section><div><div><h2>Marketed by</h2></div></div><a href="/x">no</a><a href="/agents/1">', agent, '</a></main>')
 ELSE concat('<div class="box"><h1>', title, ', Lagos</h1><p>Lagos</p><span>Call us</span><h3>', {_MONEY}, '<br>a year</h3><p>', beds, ' bedrooms</p><ul><li>', baths, ' bathrooms</li></ul><p>', place, '</p><div class="short-desc">', about, '</div><div class="about-it">', {_LONG}, '<br>', about, '</div><div class="agent-box"><div><span>Contact</span><h5>', agent, '</h5></div></div></div>') END"""
_RESULTS = """CASE source WHEN 'propertypro' THEN concat('<div class="pl-title"><a href="/property/a-', code, '">x</a><a href="/more">y</a></div><div class="pl-title"><a href="https://o.test/about">z</a></div><div class="pl-title"><a href="/property/a-', code, '">x</a></div><div class="pl-title">none</div>')
 WHEN 'privateproperty' THEN concat('<a class="similar-listings-info" href="/listings/b-', code, '?p=1">x</a><p><a href="/listings/c-', code, '">no card</a></p>')
 WHEN 'nigeriapropertycentre' THEN concat('<h2 class="wp-block-title"><a href="/about">1</a></h2><article><a href="/l/', code, '-x/">1</a><a href="/about">2</a><a href="/l/', code, '-x/">1</a><a href="https://o.test/', code, '">3</a></article>')
 ELSE concat('<div class="b-advert-card"><i><a href="/lagos/flat-', lpad(code, 12, '0'), '.html">x</a></i></div><div class="b-advert-card"></div>') END"""

VIEWS = {
    "listings_v": """
SELECT o.o_orderkey AS id, CAST(o.o_orderkey AS STRING) AS external_id, o.o_orderpriority AS source,
  concat('https://listing.test/', CAST(o.o_orderkey AS STRING)) AS url, concat('Listing ', CAST(o.o_orderkey AS STRING)) AS title,
  CASE WHEN o.o_orderkey % 13 = 0 THEN NULL ELSE CAST(round(o.o_totalprice * 100) AS BIGINT) END AS price_kobo, o.o_orderkey % 13 = 0 AS price_parse_failed,
  CASE WHEN o.o_orderkey % 6 = 0 THEN concat('12 Road, ', n.n_name, ', ', r.r_name) ELSE n.n_name END AS raw_address,
  n.n_name AS neighbourhood, o.o_orderkey % 10 <> 3 AS neighbourhood_normalised, CASE WHEN o.o_orderkey % 17 = 0 THEN NULL ELSE r.r_name END AS city,
  CAST(NULL AS DOUBLE) AS lat, CAST(NULL AS DOUBLE) AS lng, FALSE AS geocoded,
  CASE WHEN o.o_orderstatus = 'F' THEN 'REMOVED' ELSE 'ACTIVE' END AS listing_status, FALSE AS suspected_sold, CAST(o.o_orderkey % 4 AS INT) AS missed_run_count,
  o.o_orderdate AS first_seen_at, CASE WHEN s.last_ship > o.o_orderdate THEN s.last_ship ELSE o.o_orderdate END AS last_seen_at,
  CASE WHEN o.o_orderkey % 5 = 0 THEN NULL ELSE o.o_orderdate + CAST(o.o_orderkey % 90 AS INT) * INTERVAL '1' DAY END AS last_health_check_at,
  CASE WHEN o.o_orderkey % 11 = 0 THEN NULL ELSE o.o_orderdate + CAST(o.o_orderkey % 37 AS INT) * INTERVAL '1' DAY + INTERVAL '6' HOUR END AS next_health_check_at
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey JOIN {nation} n ON c.c_nationkey = n.n_nationkey JOIN {region} r ON n.n_regionkey = r.r_regionkey
LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM {lineitem} GROUP BY l_orderkey) s ON s.l_orderkey = o.o_orderkey""",
    "history_v": """
SELECT id, listing_id, event_type, old_value, CAST((old_value * (100 - pct) - (old_value * (100 - pct)) % 100) / 100 AS BIGINT) AS new_value, event_date, notes
FROM (SELECT CAST(l_linenumber AS BIGINT) * 10000000 + l_partkey AS id, l_orderkey AS listing_id, 'PRICE_CHANGE' AS event_type,
  CAST(round(l_extendedprice * 100) AS BIGINT) AS old_value, CAST(round(l_discount * 100) AS BIGINT) AS pct, CAST(l_shipdate AS DATE) AS event_date, CAST(NULL AS STRING) AS notes FROM {lineitem}) h""",
    "raw_v": """
SELECT concat('X', CAST(k AS STRING)) AS external_id, CASE k % 3 WHEN 0 THEN 'alpha' WHEN 1 THEN 'beta' ELSE 'gamma' END AS source,
  concat('https://listing.test/property/x-', CAST(k AS STRING)) AS url,
  CASE k % 7 WHEN 0 THEN '3 Bedroom Flat for Sale' WHEN 1 THEN 'Duplex to let in Yaba Lagos' WHEN 2 THEN 'Shop in Wuse, Abuja' WHEN 3 THEN '' WHEN 4 THEN 'House for outright purchase, Enugu' WHEN 5 THEN 'Nice property' ELSE 'Mini Flat in Benin' END AS title,
  CASE k % 13 WHEN 0 THEN concat('₦', CAST(k % 90 + 1 AS STRING), ',000,000') WHEN 1 THEN concat(CAST(k % 90 + 1 AS STRING), 'M') WHEN 2 THEN concat(CAST(k % 90 + 1 AS STRING), ' million naira')
    WHEN 3 THEN CAST(k * 1000 AS STRING) WHEN 4 THEN concat(CAST(k % 90 + 1 AS STRING), '.5M') WHEN 5 THEN concat('1.', CAST(k % 10 AS STRING), 'B') WHEN 6 THEN concat('₦', CAST(k % 90 + 1 AS STRING), ',000,000/year')
    WHEN 7 THEN 'Price on Request' WHEN 8 THEN NULL WHEN 9 THEN concat('$', CAST(k % 900 + 1 AS STRING), ',000') WHEN 10 THEN concat('NGN ', CAST(k % 90 + 1 AS STRING), 'M') WHEN 11 THEN '   ' ELSE '1.2.3' END AS raw_price,
  CASE k % 5 WHEN 0 THEN 'FOR_SALE' WHEN 1 THEN 'FOR_RENT' WHEN 2 THEN '' WHEN 3 THEN NULL ELSE 'per annum' END AS raw_price_type,
  CASE k % 4 WHEN 0 THEN concat(CAST(k % 9 AS STRING), ' Bedrooms') WHEN 1 THEN 'Studio' WHEN 2 THEN NULL ELSE CAST(k % 9 AS STRING) END AS raw_bedrooms,
  CASE k % 3 WHEN 0 THEN concat(CAST(k % 8 AS STRING), ' baths') WHEN 1 THEN '99999999' ELSE NULL END AS raw_bathrooms,
  CASE k % 11 WHEN 0 THEN 'Lekki Phase 1, Lagos' WHEN 1 THEN 'Old Ikoyi Ikoyi Lagos' WHEN 2 THEN 'Maitama, Abuja' WHEN 3 THEN 'Gwarimpa Town' WHEN 4 THEN CASE WHEN k % 2 = 0 THEN '12 Harbour Lane, Quayside' ELSE 'Some Brand New Place, Nowhere' END WHEN 5 THEN NULL
    WHEN 6 THEN 'Pinnock Beach, Osapa' WHEN 7 THEN 'Mabuchi' WHEN 8 THEN 'GRA, Port Harcourt' WHEN 9 THEN '' ELSE concat(CAST(k % 50 AS STRING), ' Street, Asaba Delta') END AS raw_address,
  CASE k % 6 WHEN 0 THEN concat(CAST(k % 400 + 1 AS STRING), ' sqm') WHEN 1 THEN concat('1,', CAST(k % 800 + 100 AS STRING), ' sq.m') WHEN 2 THEN concat(CAST((k % 400 + 1) * 10 AS STRING), ' sqft') WHEN 3 THEN '3 bedrooms' WHEN 4 THEN NULL ELSE ', sqm' END AS raw_floor_area,
  CASE k % 4 WHEN 0 THEN 'Payment in USD accepted' WHEN 1 THEN 'Spacious flat' WHEN 2 THEN NULL ELSE 'Ideal for expatriates, available for sale' END AS description,
  CASE k % 8 WHEN 0 THEN 'Flat / Apartment' WHEN 1 THEN ' Semi-Detached Duplex ' WHEN 2 THEN 'Converted Church Property' WHEN 3 THEN NULL WHEN 4 THEN 'Plot of Land' WHEN 5 THEN '' WHEN 6 THEN '5 bed semi-detached duplex' ELSE 'Mini Flat' END AS property_type_raw,
  concat('Agent ', CAST(k % 20 AS STRING)) AS agent_name
FROM (SELECT o_orderkey AS k FROM {orders}) o""",
    "obs_v": """
SELECT source, external_id, url, title, price_kobo, price_parse_failed, lat, lng, geocoded, seq FROM (
  SELECT o_orderpriority AS source, CAST(o_orderkey AS STRING) AS external_id, concat('https://listing.test/new/', CAST(o_orderkey AS STRING)) AS url, 'Seen again' AS title,
    CASE WHEN o_orderkey % 13 = 0 OR o_orderkey % 26 = 5 THEN NULL WHEN o_orderkey % 7 = 0 THEN CAST(round(o_totalprice * 100) AS BIGINT) - 500 ELSE CAST(round(o_totalprice * 100) AS BIGINT) END AS price_kobo,
    o_orderkey % 13 = 0 AS price_parse_failed, CASE WHEN o_orderkey % 2 = 0 THEN 6.5 END AS lat, CASE WHEN o_orderkey % 2 = 0 THEN 3.5 END AS lng, o_orderkey % 2 = 0 AS geocoded, o_orderkey * 3 AS seq
  FROM {orders} WHERE o_orderkey % 3 <> 0
  UNION ALL
  SELECT o_orderpriority, CAST(o_orderkey AS STRING), 'https://listing.test/again', 'Last word', CAST(77700 AS BIGINT), FALSE, 6.5, 3.5, TRUE, o_orderkey * 3 + 1 FROM {orders} WHERE o_orderkey % 15 = 1
  UNION ALL
  SELECT o_orderpriority, concat('N', CAST(o_orderkey AS STRING)), 'https://listing.test/n', 'New one', CAST(o_orderkey * 100 AS BIGINT), FALSE, NULL, NULL, FALSE, o_orderkey * 3 + 2 FROM {orders} WHERE o_orderkey % 9 = 2) x""",
    "feed_v": """
SELECT source, feed, page, row_number() OVER (PARTITION BY source, feed, page ORDER BY k) AS position, external_id, event_id, in_state, is_item, failed
FROM (SELECT *, 1 + CAST((8 * (k - 1) - 8 * (k - 1) % n) / n AS INT) AS page
 FROM (SELECT event_type AS source, CAST(user_id % 3 AS STRING) AS feed, row_number() OVER (PARTITION BY event_type, user_id % 3 ORDER BY ts, event_id) AS k, count(*) OVER (PARTITION BY event_type, user_id % 3) AS n,
  CAST(user_id AS STRING) AS external_id, event_id, user_id % 4 <> 0 AS in_state, event_id % 2 = 0 AS is_item, event_id % 7 < 5 AS failed FROM {events}) e) p""",
    "fetch_v": """
SELECT page_id AS listing_id, CASE page_id % 3 WHEN 0 THEN 'alpha' ELSE 'beta' END AS source, CAST(page_id AS STRING) AS external_id, url,
  CASE page_id % 9 WHEN 0 THEN 404 WHEN 1 THEN 503 WHEN 2 THEN NULL ELSE 200 END AS status,
  CASE page_id % 7 WHEN 0 THEN 'https://elsewhere.test/' WHEN 1 THEN concat('https://moved.test/', CAST(page_id AS STRING)) ELSE url END AS final_url,
  CASE page_id % 10 WHEN 3 THEN concat(html, ' This Ad Has Been DELETED!') WHEN 4 THEN concat('Oops! Page NOT found', html) ELSE html END AS body,
  CASE WHEN page_id % 23 = 0 THEN 'timeout' END AS error, CASE WHEN page_id % 4 <> 1 THEN CAST(page_id * 1000 + 99 AS BIGINT) END AS observed_price FROM {pages}""",
    "site_v": f"""
SELECT *, {_PAGES} AS html FROM (SELECT *, CASE WHEN k % 11 = 7 THEN concat('https://', source, '.test/about') WHEN source = 'propertypro' THEN concat('https://propertypro.test/property/for-', CASE k % 3 WHEN 0 THEN 'sale' WHEN 1 THEN 'rent' ELSE 'shortlet' END, '-flat-', code)
  WHEN source = 'privateproperty' THEN concat('https://privateproperty.test/listings/', kind, '-', code, '?x=1') WHEN source = 'nigeriapropertycentre' THEN concat('https://npc.test/', kind, '/', code, '-some-house', CASE WHEN k % 5 = 1 THEN '/' ELSE '' END) ELSE concat('https://jiji.test/ad/', CAST(k AS STRING)) END AS url
 FROM (SELECT o_orderkey AS k, CASE o_orderkey % 4 WHEN 0 THEN 'propertypro' WHEN 1 THEN 'privateproperty' WHEN 2 THEN 'nigeriapropertycentre' ELSE 'jiji' END AS source, o_orderkey % 5 AS layout, CAST(o_orderkey + 100000 AS STRING) AS code,
   CASE o_orderkey % 3 WHEN 0 THEN 'for-sale' WHEN 1 THEN 'for-rent' ELSE 'short-let' END AS kind, concat('Flat ', CAST(o_orderkey AS STRING)) AS title, CASE o_orderkey % 3 WHEN 0 THEN '₦' WHEN 1 THEN '$' ELSE 'USD' END AS cur,
   concat(CAST(o_orderkey % 900 + 1 AS STRING), ',000') AS amount, CAST(o_orderkey % 7 + 1 AS STRING) AS beds, CAST(o_orderkey % 3 + 1 AS STRING) AS baths, CASE WHEN o_orderkey % 2 = 0 THEN 'Lekki, Lagos' ELSE 'Wuse, Abuja' END AS place,
   concat('Offer ', o_orderpriority) AS about, concat('Firm ', CAST(o_custkey AS STRING)) AS agent FROM {{orders}}) f) g""",
    "result_v": f"""
SELECT source, url, code, {_RESULTS} AS html FROM (SELECT CASE c_custkey % 4 WHEN 0 THEN 'propertypro' WHEN 1 THEN 'privateproperty' WHEN 2 THEN 'nigeriapropertycentre' ELSE 'jiji' END AS source,
 concat('https://results.test/', CAST(c_custkey AS STRING)) AS url, CAST(c_custkey + 100000 AS STRING) AS code FROM {{customer}}) c""",
    "sight_v": """
SELECT DISTINCT CAST(user_id AS BIGINT) AS listing_id, CAST(ts AS TIMESTAMP) AS seen_at, CASE WHEN event_id % 6 = 0 THEN 'seen' WHEN event_id % 13 = 0 THEN 'active' WHEN event_id % 11 = 0 THEN 'removed' ELSE 'missed' END AS kind FROM {events}""",
    "gaz_v": """
SELECT n.n_name AS neighbourhood, r.r_name AS city, CAST(n.n_nationkey AS DOUBLE) + 0.25 AS lat, CAST(n.n_nationkey AS DOUBLE) - 0.5 AS lng
FROM {nation} n JOIN {region} r ON n.n_regionkey = r.r_regionkey WHERE n.n_nationkey % 5 <> 4
UNION ALL SELECT lower(n.n_name), r.r_name, 1.5, 2.5 FROM {nation} n JOIN {region} r ON n.n_regionkey = r.r_regionkey WHERE n.n_nationkey % 10 = 0""",
    "runs_v": """
SELECT event_type AS source, date_trunc('hour', ts) AS run_at, CASE WHEN sum(event_id) % 2 = 0 THEN 'SUCCESS' WHEN sum(event_id) % 3 = 0 THEN 'PARTIAL' ELSE 'FAILED' END AS status,
  CAST(count(*) AS INT) AS new_listings, CAST(count(*) % 7 AS INT) AS updated_listings, CAST(count(*) % 3 AS INT) AS price_changes, CASE WHEN sum(event_id) % 5 = 0 THEN 'broken link' END AS error_message,
  CAST(count(*) * 37 AS BIGINT) AS duration_seconds FROM {events} GROUP BY event_type, date_trunc('hour', ts)""",
}


def view(spark: SparkSession, sf_dir: str, name: str, spread_by: str | None = None) -> DataFrame:
    """spread_by: a column of the view's one table, by which its rows are dealt out before pages are made of them, as a
    row group of narrow rows is a single task otherwise, however long its pages take to read."""
    text = VIEWS[name]
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if "{" + t + "}" in text}
    if spread_by:
        tables = {t: df.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), spread_by) for t, df in tables.items()}
    return spark.sql(text, **tables)


def with_views(*names: str) -> str:
    """A WITH clause for DuckDB."""
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n].format(**{t: t for t in TABLES})})" for n in names)

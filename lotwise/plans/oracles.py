"""SQL counterparts of the registered queries.

They compute each result from the numeric columns the raw text was rendered from, so they share no
text rule with the queries they check.
"""

from __future__ import annotations

_JOIN = """j AS (
  SELECT l_orderkey AS k, l_linenumber AS ln, l_partkey, l_suppkey, o_orderstatus, o_totalprice, o_orderdate,
         o_orderpriority, p_name, p_brand, p_type, p_size, c_mktsegment, n_name, s_name
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey
  JOIN part ON p_partkey = o_orderkey % (SELECT count(*) FROM part)
  JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
  JOIN supplier ON s_suppkey = l_suppkey)"""

_DE = f"""WITH {_JOIN},
p AS (
  SELECT k, k * 8 + ln AS row_pos,
    CASE WHEN k % 53 = 0 THEN p_brand WHEN k % 11 = 0 THEN p_brand || '   ' || p_name
         ELSE p_brand || ' ' || p_name || ' ' || (k % 7) END AS title,
    lower(p_brand) AS brand,
    CASE WHEN k % 53 <> 0 THEN split_part(p_name, ' ', 1) END AS model,
    CASE WHEN k % 37 <> 0 AND k % 47 <> 0
         THEN floor(o_totalprice * 0.45) + CASE WHEN k % 4 = 0 THEN 0.5 ELSE 0 END END::DOUBLE AS price_eur,
    CASE WHEN k % 43 = 0 THEN NULL WHEN k % 59 = 0 THEN -5 ELSE (k * 7919) % 350000 END::DOUBLE AS mileage_km,
    CASE WHEN k % 19 <> 0 THEN p_size * 10 + 50 END::DOUBLE AS power_ps,
    CASE WHEN k % 6 <> 0 THEN k % 5 END::DOUBLE AS owners,
    CASE o_orderstatus WHEN 'F' THEN 'automatic' WHEN 'O' THEN 'manual' END AS transmission,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'petrol' WHEN '2' THEN 'diesel' WHEN '3' THEN 'hybrid'
         WHEN '4' THEN 'electric' END AS fuel,
    CASE WHEN k % 41 <> 0 AND k % 29 <> 0 THEN make_date((1985 + k % 45)::INT, month(o_orderdate)::INT, 1) END AS reg,
    CASE WHEN k % 41 <> 0 THEN make_date((1985 + k % 45)::INT, month(o_orderdate)::INT, 1) END AS reg_lenient,
    n_name AS location,
    CASE WHEN k % 31 = 0 THEN '/offers/' || k ELSE 'https://listings.example.com/' || k END AS url,
    p_type AS ausstattung,
    CASE WHEN k % 9 <> 0 THEN 'Zustand ' || c_mktsegment || ', ' || p_name END AS beschreibung,
    o_totalprice, o_orderdate, o_orderpriority, o_orderstatus, p_name, p_brand, p_size
  FROM j),
v AS (
  SELECT *, strftime(reg, '%m/%Y') AS registration, date_diff('day', reg, DATE '2026-01-01') / 365.0::DOUBLE AS car_age,
         price_eur / nullif(mileage_km, 0) AS price_per_km
  FROM p
  WHERE price_eur > 500 AND price_eur < 200000 AND mileage_km >= 0 AND mileage_km < 300000
    AND year(reg) > 1990 AND year(reg) <= 2026),
c AS (
  SELECT title, price_eur, mileage_km, power_ps, transmission, fuel, owners, location, url, ausstattung, beschreibung,
         registration, brand, model, car_age, price_per_km, min(row_pos) AS row_pos
  FROM v GROUP BY ALL),
n AS (SELECT *, row_number() OVER (ORDER BY row_pos) AS id FROM c)
"""

_FLAG = "CASE WHEN {0} < 5 THEN true WHEN {0} < 10 THEN false END"


def _flag(expr: str) -> str:
    return _FLAG.format(f"({expr})")


_US = f"""WITH {_JOIN},
u AS (
  SELECT k, ln, k * 8 + ln AS row_pos, l_partkey * 1000000 + l_suppkey AS row_sub,
    'us-' || k || '-' || ln || '-' || l_partkey || '-' || l_suppkey AS id,
    CASE WHEN k % 23 <> 0 AND k % 27 <> 0 THEN o_orderdate::DATE::TIMESTAMP + to_hours(ln) END AS created_at,
    CASE WHEN k % 13 = 0 AND k % 26 = 0 THEN NULL WHEN k % 13 = 0 THEN upper(substr(md5(k::VARCHAR), 1, 11))
         WHEN k % 17 = 0 THEN NULL ELSE upper(substr(md5(k::VARCHAR), 1, 17)) END AS vin,
    CASE WHEN k % 71 <> 0 THEN lower(p_brand) END AS make,
    CASE WHEN k % 73 <> 0 THEN p_name END AS model,
    CASE WHEN k % 10 <> 0 AND k % 15 <> 0 THEN p_type || ' ' || p_size END AS trim,
    (1986 + k % 44)::DOUBLE AS year,
    lower(p_type) AS body_style,
    CASE k % 4 WHEN 0 THEN 'awd' WHEN 1 THEN 'fwd' WHEN 2 THEN 'rwd' END AS drivetrain,
    CASE WHEN k % 16 <> 0 THEN (k % 6 + 1) || '.0L' END AS engine,
    CASE WHEN k % 21 <> 0 THEN (k % 4 + 1) * 2 END::DOUBLE AS cylinders,
    CASE WHEN k % 22 <> 0 THEN 2 + k % 4 END::DOUBLE AS doors,
    (4 + k % 4)::DOUBLE AS seats,
    split_part(p_name, ' ', 2) AS fuel,
    CASE WHEN k % 2 = 0 THEN 'automatic' ELSE 'manual' END AS transmission,
    split_part(p_name, ' ', 1) AS exterior_color,
    CASE WHEN k % 3 <> 0 THEN split_part(p_name, ' ', 1) END AS interior_color,
    CASE WHEN k % 61 <> 0 THEN (k * 977 + (ln % 2) * 50) % 310000 + CASE WHEN k % 8 = 0 THEN 0.5 ELSE 0 END END::DOUBLE
      AS price_usd,
    CASE WHEN k % 67 = 0 THEN -500 ELSE (k * 7919) % 420000 END::DOUBLE AS mileage_mi,
    'https://reports.example.com/' || k AS carfax_url, 'https://cars.example.com/' || k AS vdp_url,
    'https://img.example.com/' || k || '.jpg' AS primary_image_url, s_name AS dealer_name, 'City ' || (k % 97) AS city,
    lower(n_name) AS state, lpad((k % 100000)::VARCHAR, 5, '0') AS zip_code,
    {_flag('(k + 9) % 14')} AS is_used, {_flag('(k + 7) % 14')} AS is_cpo, {_flag('k % 14')} AS is_online,
    {_flag('(k + 11) % 14')} AS is_wholesale,
    CASE WHEN k % 7 <> 0 THEN k % 23 END::DOUBLE AS accident_count, {_flag('k % 13')} AS has_accidents,
    CASE WHEN k % 5 <> 0 THEN k % 18 END::DOUBLE AS owner_count, {_flag('(k + 3) % 14')} AS one_owner,
    {_flag('(k + 5) % 14')} AS personal_use, CASE WHEN k % 4 <> 0 THEN c_mktsegment END AS usage_type,
    (k % 30)::DOUBLE AS photo_count, (20000 + k % 9000)::DOUBLE AS base_invoice_usd,
    (22000 + k % 9000)::DOUBLE AS base_msrp_usd, 0.95::DOUBLE AS vehicle_confidence
  FROM j),
v AS (
  SELECT *, price_usd / nullif(mileage_mi, 0) AS price_per_mile, 2026 - year AS car_age
  FROM u
  WHERE price_usd BETWEEN 500 AND 300000 AND mileage_mi BETWEEN 0 AND 400000 AND year BETWEEN 1990 AND 2026
    AND make IS NOT NULL AND model IS NOT NULL AND coalesce(owner_count, 0) <= 15 AND coalesce(accident_count, 0) <= 20),
c AS (
  SELECT *,
    CASE WHEN created_at IS NOT NULL THEN greatest(0,
      floor((epoch(TIMESTAMP '2026-01-15 12:00:00') - epoch(created_at)) / 86400))::BIGINT END AS listing_age_days
  FROM (SELECT *, row_number() OVER (PARTITION BY vin, price_usd, mileage_mi, year ORDER BY row_pos, row_sub) AS rn FROM v)
  WHERE rn = 1),
n AS (SELECT * EXCLUDE (id), 1000000000 + row_number() OVER (ORDER BY row_pos) AS id FROM c)
"""

# documents: planted values by key, and words anywhere in the text
_DOC = """WITH d AS (
  SELECT doc_id, doc_id + 1 AS listing_id, doc_id % 12 AS form, lower(text) AS low, trim(lower(text), chr(9) || chr(10) || chr(13) || ' ') AS tidy,
    CASE doc_id % 3 WHEN 0 THEN 'hu/au neu' WHEN 1 THEN 'abgelaufen' ELSE 'gültig' END AS tuev,
    CASE doc_id % 4 WHEN 0 THEN 'lückenlos' WHEN 1 THEN 'nein' ELSE '' END AS scheckheft,
    CASE doc_id % 5 WHEN 0 THEN '8-fach' WHEN 1 THEN 'winter und sommer' WHEN 2 THEN 'allwetterreifen' ELSE 'sommer' END AS reifen,
    CASE doc_id % 7 WHEN 0 THEN '24 monate' WHEN 1 THEN '12' ELSE 'keine' END AS garantie,
    CASE WHEN doc_id % 2 = 0 THEN 'true' ELSE 'false' END AS unfallfrei,
    CASE doc_id % 6 WHEN 0 THEN 'keine' WHEN 1 THEN 'steinschlag' WHEN 2 THEN 'false' ELSE 'delle' END AS mangel,
    CASE WHEN doc_id % 5 < 2 THEN 'true' ELSE 'false' END AS distronic,
    CASE doc_id % 8 WHEN 0 THEN 'amg line' WHEN 1 THEN 'burmester surround' WHEN 2 THEN 'thermotronic' WHEN 3 THEN 'nein'
         ELSE 'thermatic' END AS paket
  FROM documents)
, f AS (SELECT listing_id,
  CASE WHEN form = 3 THEN 1 WHEN form IN (0, 1) THEN 0 ELSE (doc_id % 3 <> 1)::BIGINT END AS tuv_neu,
  CASE WHEN form IN (0, 1, 3) THEN 0 ELSE (doc_id % 4 = 0)::BIGINT END AS scheckheft_gepflegt,
  CASE WHEN form IN (0, 1, 3) THEN 0 ELSE (doc_id % 5 < 2)::BIGINT END AS bereifung_8_fach,
  CASE WHEN form IN (0, 1, 3) THEN 0 ELSE (doc_id % 5 = 2)::BIGINT END AS bereifung_allwetter,
  CASE WHEN form = 3 THEN 6 WHEN form IN (0, 1) THEN 0 WHEN doc_id % 7 = 0 THEN 24 WHEN doc_id % 7 = 1 THEN 12 ELSE 0 END::BIGINT
    AS garantie_monate,
  CASE WHEN form = 3 THEN 1 WHEN form IN (0, 1) THEN 0 ELSE (doc_id % 2 = 0)::BIGINT END AS unfallfrei,
  CASE WHEN form IN (0, 1, 3) THEN 0 ELSE (doc_id % 6 NOT IN (0, 2))::BIGINT END AS mangel_vorhanden,
  CASE WHEN form IN (0, 1, 3) THEN 0 ELSE (doc_id % 5 < 2 OR regexp_matches(low, 'distronic|acc|abstandsregeltempomat'))::BIGINT END
    AS ausstattung_distronic,
  CASE WHEN form IN (0, 1, 3) THEN 0 ELSE regexp_matches(low, 'multibeam|ils|matrix')::BIGINT END AS ausstattung_multibeam,
  CASE WHEN form IN (0, 1, 3) THEN 0 ELSE (doc_id % 8 = 2 OR regexp_matches(low, '4-zonen|4_zonen|thermotronic|klima hinten'))::BIGINT END
    AS ausstattung_klima_4_zonen,
  CASE WHEN form IN (0, 1, 3) THEN 0 ELSE (doc_id % 8 > 3 OR regexp_matches(low, '2-zonen|2_zonen|thermatic'))::BIGINT END
    AS ausstattung_klima_2_zonen,
  CASE WHEN form IN (0, 1, 3) THEN 0 ELSE regexp_matches(low, 'burmester 3d|high-end|highend|3d-soundsystem')::BIGINT END
    AS ausstattung_burmester_3d,
  CASE WHEN form IN (0, 1, 3) THEN 0 ELSE (doc_id % 8 = 1 OR regexp_matches(low, 'burmester .standard.|burmester standard|surround'))::BIGINT END
    AS ausstattung_burmester_standard,
  CASE WHEN form IN (0, 1, 3) THEN 0 ELSE (doc_id % 8 = 0 OR regexp_matches(low, 'amg line|amg_line|amg-line'))::BIGINT END
    AS ausstattung_amg_line,
  CASE WHEN form IN (0, 1, 3) THEN 0 ELSE regexp_matches(low, 'pano|panorama|schiebedach')::BIGINT END AS ausstattung_pano
  FROM d WHERE form <> 2)
"""
_CONDITIONS = (
    "tuv_neu, scheckheft_gepflegt, bereifung_8_fach, bereifung_allwetter, garantie_monate, unfallfrei, mangel_vorhanden"
)
_EQUIPMENT = (
    "ausstattung_distronic, ausstattung_multibeam, ausstattung_klima_4_zonen, ausstattung_klima_2_zonen, "
    "ausstattung_burmester_3d, ausstattung_burmester_standard, ausstattung_amg_line, ausstattung_pano"
)

_DE_F = _DE.rstrip() + ",\n" + _DOC.replace("WITH d AS", "d AS", 1).strip() + "\n"

_PARENT_DE = (
    "id, 1::BIGINT AS dataset_id, brand, model, title, price_eur AS price, 'EUR' AS currency, mileage_km AS mileage, "
    "'km' AS mileage_unit, NULL::BIGINT AS year, registration, location, url, 'mobile' AS source, 'DE' AS market"
)
_DETAIL_DE = (
    "transmission, fuel, owners::BIGINT AS owners, power_ps, round(car_age, 6) AS car_age, "
    "round(price_per_km, 6) AS price_per_km, ausstattung, beschreibung"
)
_US_OUT = (
    "vin, make, model, trim, year, body_style, drivetrain, engine, cylinders, doors, seats, fuel, transmission, "
    "exterior_color, interior_color, price_usd, mileage_mi, carfax_url, vdp_url, primary_image_url, dealer_name, city, "
    "state, zip_code, is_used, is_cpo, is_online, is_wholesale, accident_count, has_accidents, owner_count, one_owner, "
    "personal_use, usage_type, car_age, round(price_per_mile, 6) AS price_per_mile, listing_age_days"
)


def _shown(c: str) -> str:
    """Display form of one lower-case word without a hyphen: brand#1 -> Brand#1; short words upper-case."""
    return (
        f"(CASE WHEN regexp_full_match({c}, '[a-z]{{1,3}}') THEN upper({c}) "
        f"ELSE upper(substr({c}, 1, 1)) || substr({c}, 2) END)"
    )


_US_TITLE = (
    f"concat_ws(' ', {_shown('make')}, {_shown('model')}, nullif(trim, ''))"
)
_TRIM_DE = (
    "CASE WHEN k % 53 = 0 THEN '' WHEN k % 11 = 0 THEN p_name ELSE p_name || ' ' || (k % 7) END"
)
# n with the columns the trims are made of
_DE_N = _DE.rstrip() + f""",
t AS (SELECT n.*, {_TRIM_DE} AS trim FROM n JOIN (SELECT o_orderkey AS k, p_name FROM orders
      JOIN part ON p_partkey = o_orderkey % (SELECT count(*) FROM part)) q ON q.k = n.row_pos // 8)
"""

_BUYERS_DE = """, s AS (
  SELECT brand, model, min(id) AS subject_id, floor(max(mileage_km) * 0.75) AS max_mileage
  FROM n WHERE model IS NOT NULL GROUP BY brand, model),
m AS (
  SELECT s.subject_id, n.* FROM n JOIN s ON n.brand = s.brand AND n.model = s.model
  WHERE (max_mileage <= 0 OR mileage_km <= max_mileage) AND car_age <= 25 AND coalesce(owners, 99) <= 3
    AND coalesce(power_ps, 0) >= 150 AND (subject_id % 2 <> 0 OR fuel = 'petrol')
    AND (subject_id % 3 <> 0 OR transmission = 'manual'))
"""

# arg_min skips nulls, the first row may have one
_BUYERS_US = """, h AS (SELECT make, model, id AS subject_id, fuel AS want_fuel, cylinders AS want_cyl FROM n
  QUALIFY row_number() OVER (PARTITION BY make, model ORDER BY id) = 1),
s AS (SELECT * FROM h)
"""

_ROWS_DE = (
    "id AS listing_id, price_eur AS price, mileage_km AS mileage, brand, coalesce(model, 'unbekannt') AS model, "
    "round(car_age, 6) AS car_age, power_ps, owners::BIGINT AS owners, coalesce(transmission, 'unbekannt') AS transmission, "
    "coalesce(fuel, 'unbekannt') AS fuel"
)
_US_CATS = (
    "trim", "drivetrain", "fuel", "transmission", "body_style", "engine", "exterior_color", "interior_color", "usage_type",
)
_ROWS_US = (
    "id AS listing_id, price_usd AS price, mileage_mi AS mileage, make AS brand, model, car_age, accident_count, "
    "owner_count, cylinders, doors, seats, "
    + ", ".join(f"lower(coalesce({c}, 'unbekannt')) AS {c}" for c in _US_CATS) + ", "
    + ", ".join(
        f"coalesce({c}, false)::BIGINT AS {c}"
        for c in ("one_owner", "has_accidents", "is_used", "is_cpo", "is_online", "is_wholesale", "personal_use")
    )
)
_US_CATEGORICAL = ("brand", "model", *_US_CATS)

_FEATURE_LIST = f"{_CONDITIONS}, {_EQUIPMENT}"
_CARS_DE = _DE_F + f""", cars AS (
  SELECT n.*, n.id AS subject_id, {_FEATURE_LIST} FROM n JOIN f ON f.listing_id = n.id)
"""

_TOGGLES = (
    ("tuv_neu", "TÜV neu", 155, True), ("unfallfrei", "Unfallfrei", 810, True),
    ("mangel_vorhanden", "Mängel vorhanden", -405, True), ("scheckheft_gepflegt", "Scheckheft gepflegt", 90, True),
    ("bereifung_8_fach", "8-fach Bereifung", 125, False), ("bereifung_allwetter", "Allwetterreifen", 55, False),
    ("ausstattung_distronic", "Distronic", 605, False), ("ausstattung_multibeam", "Multibeam LED", 455, False),
    ("ausstattung_klima_4_zonen", "4-Zonen Klima", 315, False), ("ausstattung_klima_2_zonen", "2-Zonen Klima", 85, False),
    ("ausstattung_burmester_3d", "Burmester 3D", 705, False),
    ("ausstattung_burmester_standard", "Burmester Standard", 205, False),
    ("ausstattung_amg_line", "AMG Line", 1105, False), ("ausstattung_pano", "Panoramadach", 505, False),
)


def _toggle_rows() -> str:
    parts = []
    for i, (name, label, weight, condition) in enumerate(_TOGGLES, 1):
        # a buyer gives up a feature that is worth more than 100
        if weight > 100:
            parts.append(
                f"SELECT subject_id, {i} AS ordinal, 'saving' AS type, {weight}.0 AS saving, "
                f"'Wenn du auf ''{label}'' verzichtest, sparst du ca. {weight:,} €.' AS text "
                f"FROM cars WHERE subject_id % 2 = 0 AND {name} = 1"
            )
            if not condition:
                parts.append(
                    f"SELECT subject_id, {i}, 'upgrade', {weight}.0, "
                    f"'Wenn du ''{label}'' anbietest, nimmt der Preis um ca. {weight:,} € zu.' "
                    f"FROM cars WHERE subject_id % 2 = 1 AND {name} = 0"
                )
    return "\nUNION ALL ".join(parts)


def _models(view: str, brand: str) -> str:
    return f"""heads AS (
  SELECT {brand} AS brand, model, min(id) AS seen FROM {view} WHERE model IS NOT NULL GROUP BY {brand}, model
  QUALIFY row_number() OVER (PARTITION BY brand ORDER BY seen, model) <= 6),
alts AS (
  SELECT cars.subject_id, heads.model AS alt_model, cars.own_model,
         row_number() OVER (PARTITION BY cars.subject_id ORDER BY seen, heads.model) AS alt_rank
  FROM cars JOIN heads ON heads.brand = cars.{brand} AND heads.model <> coalesce(cars.own_model, '')
  WHERE cars.subject_id % 2 = 0
  QUALIFY alt_rank <= 5)"""


def _thousands(expr: str) -> str:
    return f"format('{{:,}}', ({expr})::BIGINT)"


_RECOMMEND_DE = _CARS_DE.replace("n.id AS subject_id", "n.id AS subject_id, n.model AS own_model") + ", " + _models("n", "brand") + f""",
r AS ({_toggle_rows()}
UNION ALL SELECT subject_id, 101, 'mileage_tip', 300.0,
  'Fahrzeuge mit 20,000 km weniger Laufleistung kosten ca. 300 € mehr — achte auf Angebote mit weniger Kilometern!'
  FROM cars WHERE subject_id % 2 = 0 AND mileage_km > 20000 AND mileage_km - 20000 >= 5000
UNION ALL SELECT subject_id, 199 + alt_rank, 'alternative', 733.0 * (length(coalesce(own_model, '')) - length(alt_model)),
  'Ein ''' || {_shown('alt_model')} || ''' mit gleicher Ausstattung würde ca. '
  || {_thousands("733 * (length(coalesce(own_model, '')) - length(alt_model))")} || ' € weniger kosten.'
  FROM alts WHERE 733 * (length(coalesce(own_model, '')) - length(alt_model)) > 500)
"""
_CARS_US = _US + """, cars AS (SELECT n.*, id AS subject_id, model AS own_model FROM n)
"""
_RECOMMEND_US = _CARS_US + ", " + _models("n", "make") + f""",
r AS (
SELECT subject_id, 201 AS ordinal, 'mileage_tip' AS type, 300.0 AS saving,
  'Fahrzeuge mit 20,000 Meilen weniger kosten ca. $300 mehr — achte auf niedrigere Laufleistung!' AS text
  FROM cars WHERE subject_id % 2 = 0 AND mileage_mi > 20000 AND mileage_mi - 20000 >= 5000
UNION ALL SELECT subject_id, 99 + alt_rank, 'alternative', 733.0 * (length(own_model) - length(alt_model)),
  'Ein ''' || {_shown('alt_model')} || ''' mit gleicher Ausstattung würde ca. $'
  || {_thousands("733 * (length(own_model) - length(alt_model))")} || ' weniger kosten.'
  FROM alts WHERE 733 * (length(own_model) - length(alt_model)) > 500
UNION ALL SELECT subject_id, 300, 'saving', 820.0,
  'Ein ' || (cylinders - 2)::BIGINT || '-Zylinder-Motor würde ca. $820 sparen.'
  FROM cars WHERE subject_id % 2 = 0 AND cylinders > 4)
"""
_RANKED = "row_number() OVER (PARTITION BY subject_id ORDER BY saving DESC, ordinal) AS saving_rank"

_JSON = """WITH e AS (
  SELECT event_id AS row_pos, CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 19 = 0 THEN '' ELSE 'V' || user_id END AS vin,
    floor(value * 100)::BIGINT AS price, event_type AS vehicle_make, (props::JSON->>'k')::BIGINT AS vehicle_props_k,
    CASE WHEN event_id % 3 = 1 THEN event_id % 4 END AS "history_ownerCount",
    CASE WHEN event_id % 3 = 1 THEN 1 WHEN event_id % 3 = 2 AND event_id % 2 = 1 THEN 2 END::BIGINT AS "history_accidentCount",
    '["\\u00fc", "' || event_type || '"]' AS tags,
    CASE WHEN event_id % 5 = 0 THEN 'blau' END AS color
  FROM events)
"""
_H1 = "replace(replace(replace(replace(regexp_extract(html, '<h1>(.*?)</h1>', 1, 's'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&')"

_NUM_US = (
    "accident_count, owner_count, mileage_mi, photo_count, price_usd, base_invoice_usd, base_msrp_usd, "
    "vehicle_confidence, cylinders, doors, seats, year"
)


def _median_fill(c: str) -> str:
    return f"coalesce({c}, (SELECT median({c}) FROM e)) AS {c}"


_RAW_DE = """CASE WHEN k % 53 = 0 THEN p_brand WHEN k % 11 = 0 THEN '  ' || title || ' ' ELSE title END AS "Titel",
  CASE WHEN k % 37 = 0 THEN 'auf Anfrage' WHEN k % 47 = 0 THEN NULL
    ELSE replace(format('{:,}', floor(o_totalprice * 0.45)::BIGINT), ',', '.') || CASE WHEN k % 4 = 0 THEN ',50' ELSE '' END
      || CASE WHEN k % 3 = 0 THEN chr(160) || '€' ELSE ' €' END END AS "Preis" """
_DOCUMENTS = """SELECT doc_id + 1 AS listing_id, length(CASE doc_id % 12 WHEN 0 THEN NULL WHEN 1 THEN 'not valid json ' || text
  WHEN 2 THEN '[1, 2]' WHEN 3 THEN '{''TÜV'': ''neu'', ''Unfallfrei'': true, ''Garantie'': ''6 Monate'', ''Pano'': null, ''Extras'': [1]}'
  ELSE json_object('historie', json_object(
    'TÜV', CASE doc_id % 3 WHEN 0 THEN 'HU/AU neu' WHEN 1 THEN 'abgelaufen' ELSE ' GÜLTIG ' END,
    'Scheckheft', CASE doc_id % 4 WHEN 0 THEN 'Lückenlos' WHEN 1 THEN 'nein' ELSE '' END,
    'Bereifung', CASE doc_id % 5 WHEN 0 THEN '8-fach' WHEN 1 THEN 'Winter und Sommer' WHEN 2 THEN 'Allwetterreifen' ELSE 'Sommer' END,
    'Garantie', CASE doc_id % 7 WHEN 0 THEN '24 Monate' WHEN 1 THEN '12' ELSE 'keine' END, 'Unfallfrei', doc_id % 2 = 0,
    'Mängel', CASE doc_id % 6 WHEN 0 THEN 'Keine' WHEN 1 THEN 'Steinschlag' WHEN 2 THEN 'false' ELSE 'Delle' END),
    'ausstattung', json_object('Distronic', doc_id % 5 < 2, 'Paket', CASE doc_id % 8 WHEN 0 THEN 'AMG Line'
      WHEN 1 THEN 'Burmester Surround' WHEN 2 THEN 'Thermotronic' WHEN 3 THEN 'nein' ELSE 'Thermatic' END),
    'liste', [1, 2], 'notiz', text)::VARCHAR END) AS chars FROM documents"""
_RESPONSE = """WITH d AS (SELECT conv_id * 1000 + turn AS listing_id, CASE WHEN (conv_id + turn) % 4 IN (0, 3) THEN lower(text) ELSE '' END AS low
  FROM conversations)
SELECT listing_id, 0::BIGINT AS tuv_neu, 0::BIGINT AS scheckheft_gepflegt, 0::BIGINT AS bereifung_8_fach, 0::BIGINT AS bereifung_allwetter,
  0::BIGINT AS garantie_monate, 0::BIGINT AS unfallfrei, 0::BIGINT AS mangel_vorhanden,
  regexp_matches(low, 'distronic|acc|abstandsregeltempomat')::BIGINT AS ausstattung_distronic,
  regexp_matches(low, 'multibeam|ils|matrix')::BIGINT AS ausstattung_multibeam,
  regexp_matches(low, '4-zonen|4_zonen|thermotronic|klima hinten')::BIGINT AS ausstattung_klima_4_zonen,
  regexp_matches(low, '2-zonen|2_zonen|thermatic')::BIGINT AS ausstattung_klima_2_zonen,
  regexp_matches(low, 'burmester 3d|high-end|highend|3d-soundsystem')::BIGINT AS ausstattung_burmester_3d,
  regexp_matches(low, 'burmester .standard.|burmester standard|surround')::BIGINT AS ausstattung_burmester_standard,
  regexp_matches(low, 'amg line|amg_line|amg-line')::BIGINT AS ausstattung_amg_line,
  regexp_matches(low, 'pano|panorama|schiebedach')::BIGINT AS ausstattung_pano FROM d"""

ORACLES: dict[str, str] = {
    # DE cleaning
    "de_numeric_parse": _DE + "SELECT row_pos, price_eur, mileage_km, power_ps, owners FROM p",
    "de_registration_parse": _DE + "SELECT row_pos, strftime(reg, '%m/%Y') AS registration, year(reg) AS reg_year FROM p",
    "de_registration_lenient": _DE + "SELECT row_pos, strftime(reg_lenient, '%m/%Y') AS registration FROM p",
    "de_title_split": _DE + "SELECT row_pos, title, brand, model FROM p",
    "de_value_maps": _DE + "SELECT row_pos, transmission, fuel FROM p",
    "de_range_filter": _DE + "SELECT row_pos, price_eur, mileage_km, registration FROM v",
    "de_ratio_age": _DE + "SELECT row_pos, round(car_age, 6) AS car_age, round(price_per_km, 6) AS price_per_km, "
                          "'DE' AS market, 'mobile' AS source FROM v",
    "de_clean": _DE + 'SELECT title, price_eur, mileage_km, power_ps, transmission, fuel, owners, location, url AS "URL", '
                      'ausstattung AS "Ausstattung", beschreibung AS "Beschreibung", registration, brand, model, '
                      "round(car_age, 6) AS car_age, round(price_per_km, 6) AS price_per_km, 'DE' AS market, "
                      "'mobile' AS source FROM c",
    "de_clean_report": _DE + """SELECT count(*) AS rows_raw,
      count(*) FILTER (ok) AS rows_complete, count(*) FILTER (ok AND pr) AS rows_price,
      count(*) FILTER (ok AND pr AND mi) AS rows_mileage, count(*) FILTER (ok AND pr AND mi AND yr) AS rows_valid
      FROM (SELECT price_eur IS NOT NULL AND mileage_km IS NOT NULL AND reg IS NOT NULL AS ok,
        price_eur > 500 AND price_eur < 200000 AS pr, mileage_km >= 0 AND mileage_km < 300000 AS mi,
        year(reg) > 1990 AND year(reg) <= 2026 AS yr FROM p)""",
    "de_price_median": _DE + "SELECT brand, median(price_eur) AS median_price FROM c GROUP BY brand",
    # US cleaning
    "us_rename_columns": "SELECT (SELECT count(*) FROM lineitem) AS rows, unnest(['accident_count', 'base_invoice_usd', "
        "'base_msrp_usd', 'body_style', 'carfax_url', 'city', 'created_at', 'cylinders', 'dealer_name', 'doors', 'drivetrain', "
        "'engine', 'exterior_color', 'fuel', 'has_accidents', 'id', 'interior_color', 'is_cpo', 'is_online', 'is_used', "
        "'is_wholesale', 'location', 'make', 'mileage_mi', 'model', 'one_owner', 'owner_count', 'personal_use', 'photo_count', "
        "'price_usd', 'primary_image_url', 'row_pos', 'row_sub', 'seats', 'series', 'squish_vin', 'state', 'style', "
        "'transmission', 'trim', 'unknown_extra', 'usage_type', 'vdp_url', 'vehicle_confidence', 'vehicle_type', "
        "'vehicle_vin', 'vin_raw', 'year', 'zip_code']) AS column_name",
    "us_bool_parse": _US + "SELECT row_pos, row_sub, has_accidents, one_owner, personal_use, is_online, is_cpo, is_used, "
                           "is_wholesale FROM u",
    "us_numeric_scrub": _US + f"SELECT row_pos, row_sub, {_NUM_US} FROM u",
    "us_string_norm": _US + "SELECT row_pos, row_sub, make, model, trim, usage_type, state, drivetrain, transmission, "
                            "interior_color, zip_code, dealer_name, body_style FROM u",
    "us_vin_valid": _US + "SELECT row_pos, row_sub, vin FROM u",
    "us_range_filter": _US + "SELECT row_pos, row_sub, price_usd, owner_count, accident_count FROM v",
    "us_listing_age": _US + """SELECT row_pos, row_sub, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at,
      1998 - year AS car_age, round(price_per_mile, 6) AS price_per_mile,
      CASE WHEN created_at IS NOT NULL THEN greatest(0,
        floor((epoch(TIMESTAMP '1998-06-01 12:00:00') - epoch(created_at)) / 86400))::BIGINT END AS listing_age_days FROM v""",
    "us_dedup_first": _US + "SELECT row_pos, row_sub, id, vin, price_usd, mileage_mi, year FROM c",
    "us_clean": _US + "SELECT id, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at, 'US' AS market, "
                      f"'auto.dev' AS source, {_US_OUT} FROM c",
    "us_clean_report": _US + """SELECT count(*) AS rows_raw, count(*) FILTER (ok) AS rows_complete,
      count(*) FILTER (ok AND rng) AS rows_ranged, (SELECT count(*) FROM v) AS rows_valid
      FROM (SELECT price_usd IS NOT NULL AND make IS NOT NULL AND model IS NOT NULL AS ok,
        price_usd BETWEEN 500 AND 300000 AND mileage_mi BETWEEN 0 AND 400000 AND year BETWEEN 1990 AND 2026 AS rng FROM u)""",
    # sources and sinks
    "us_csv_read": _US + 'SELECT id AS "@id", zip_code AS "retailListing_zip", '
        "CASE WHEN k % 3 = 0 THEN year::BIGINT || '.0' ELSE year::BIGINT || '' END AS vehicle_year, "
        "CASE WHEN k % 61 = 0 THEN 'call us' WHEN k % 8 = 0 THEN '€' || format('{:,}', price_usd::BIGINT) || '.50' "
        "ELSE '$' || format('{:,}', price_usd::BIGINT) END AS \"retailListing_price\", 'x' AS unknown_extra FROM u",
    "csv_append": _DE + f"SELECT row_pos, {_RAW_DE} FROM p",
    "de_csv_read": _DE + f"""SELECT {_RAW_DE},
      CASE WHEN k % 43 = 0 THEN 'unknown' WHEN k % 59 = 0 THEN '-5 km'
        ELSE replace(format('{{:,}}', (k * 7919) % 350000), ',', '.') || ' km' END AS "Kilometerstand",
      CASE WHEN k % 41 = 0 THEN '13/2020' WHEN k % 29 = 0 THEN 'EZ: ' || strftime(reg_lenient, '%m/%Y')
        WHEN k % 5 = 0 THEN month(reg) || '/' || year(reg) WHEN k % 7 = 0 THEN 'Erstzulassung' || chr(160) || strftime(reg, '%m/%Y')
        ELSE 'EZ ' || strftime(reg, '%m/%Y') END AS "Erstzulassung",
      CASE WHEN k % 19 = 0 THEN 'N/A' ELSE (p_size * 10 + 50) || CASE WHEN k % 3 = 0 THEN chr(160) || 'PS' ELSE ' PS' END END AS "PS",
      CASE o_orderstatus WHEN 'F' THEN 'Automatik' WHEN 'O' THEN ' Schaltgetriebe ' ELSE 'Halbautomatik' END AS "Getriebe",
      CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Benzin' WHEN '2' THEN 'Diesel' WHEN '3' THEN 'Hybrid'
        WHEN '4' THEN 'Elektro' ELSE 'Autogas (LPG)' END AS "Kraftstoff",
      CASE WHEN k % 6 = 0 THEN 'N/A' ELSE (k % 5) || ' Fahrzeughalter' END AS "Fahrzeughalter", location AS "Standort", url AS "URL",
      ausstattung AS "Ausstattung", beschreibung AS "Beschreibung" FROM p""",
    "feature_column_scan": _DOCUMENTS,
    "response_features": _RESPONSE,
    "csv_ragged_union": "SELECT c_custkey AS id, c_name AS name, NULL::BIGINT AS nation, c_mktsegment AS segment, "
        "'id,name,nation,segment' AS header FROM customer UNION ALL SELECT s_suppkey, s_name, s_nationkey, NULL, "
        "'id,name,nation,segment' FROM supplier",
    "json_pages_read": "SELECT event_id, event_type, round(value, 2) AS value FROM events",
    "market_partition_scan": _US + "SELECT id, make AS brand, price_usd AS price, 'US' AS market FROM n",
    # nested records
    "json_owner_filter": _JSON + 'SELECT row_pos, "history_ownerCount" AS owner_count FROM e WHERE "history_ownerCount" IS NOT NULL',
    "json_flatten": _JSON + "SELECT * FROM e",
    "json_vin_first": _JSON + "SELECT min(row_pos) AS row_pos, vin FROM e WHERE vin <> '' GROUP BY vin",
    "json_vehicle_table": _JSON + """SELECT * FROM e WHERE vin <> '' AND "history_ownerCount" IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY vin ORDER BY row_pos) = 1""",
    # loading
    "load_listings_de": _DE + f"SELECT {_PARENT_DE} FROM n",
    "load_listing_de": _DE + f"SELECT id AS listing_id, {_DETAIL_DE} FROM n",
    "load_listings_us": _US + "SELECT id, 2::BIGINT AS dataset_id, make AS brand, model, NULL::VARCHAR AS title, price_usd AS price, "
        "'USD' AS currency, mileage_mi AS mileage, 'mi' AS mileage_unit, year::BIGINT AS year, NULL::VARCHAR AS registration, "
        "NULL::VARCHAR AS location, vdp_url AS url, 'auto.dev' AS source, 'US' AS market FROM n",
    "load_listing_us": _US + f"SELECT id AS listing_id, NULL::VARCHAR AS location, {_US_OUT.replace('year,', 'year::BIGINT AS year,', 1)} FROM n",
    "assigned_ids": "SELECT o_orderkey AS row_pos, 500 + row_number() OVER (ORDER BY o_orderkey) AS id FROM orders",
    "feature_upsert": """WITH o AS (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1),
      b AS (SELECT * FROM events WHERE event_type = 'click' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
      SELECT user_id, event_id, event_type, round(value, 6) AS value FROM b
      UNION ALL SELECT user_id, event_id, event_type, round(value, 6) FROM o WHERE user_id NOT IN (SELECT user_id FROM b)""",
    "feature_snapshot": _DOC + f"SELECT listing_id, {_FEATURE_LIST} FROM f",
    # documents
    "prompt_candidates": _DE + "SELECT id, 'Text: ' || beschreibung || ' ENDE' AS prompt FROM n WHERE beschreibung IS NOT NULL",
    "doc_condition_flags": _DOC + f"SELECT listing_id, {_CONDITIONS} FROM f",
    "doc_equipment_flags": _DOC + f"SELECT listing_id, {_EQUIPMENT} FROM f",
    "doc_leaf_pairs": _DOC + """, q AS (SELECT *, form NOT IN (0, 1, 2, 3) AS nested FROM d)
      SELECT listing_id, 0::BIGINT AS pos, 'tüv' AS key, tuev AS value FROM q WHERE nested
      UNION ALL SELECT listing_id, 1, 'scheckheft', scheckheft FROM q WHERE nested
      UNION ALL SELECT listing_id, 2, 'bereifung', reifen FROM q WHERE nested
      UNION ALL SELECT listing_id, 3, 'garantie', garantie FROM q WHERE nested
      UNION ALL SELECT listing_id, 4, 'unfallfrei', unfallfrei FROM q WHERE nested
      UNION ALL SELECT listing_id, 5, 'mängel', mangel FROM q WHERE nested
      UNION ALL SELECT listing_id, 6, 'distronic', distronic FROM q WHERE nested
      UNION ALL SELECT listing_id, 7, 'paket', paket FROM q WHERE nested
      UNION ALL SELECT listing_id, 8, 'notiz', tidy FROM q WHERE nested
      UNION ALL SELECT listing_id, x.pos, x.key, x.value FROM q, (VALUES (0, 'tüv', 'neu'), (1, 'unfallfrei', 'true'),
        (2, 'garantie', '6 monate'), (3, 'pano', 'none')) x(pos, key, value) WHERE form = 3""",
    "response_cut": """SELECT conv_id * 1000 + turn AS listing_id,
      CASE WHEN (conv_id + turn) % 4 IN (0, 3) THEN json_object('role', role, 'text', text)::VARCHAR END AS ai_features
      FROM conversations""",
    # pages
    "page_fields": f"""SELECT page_id,
      CASE WHEN page_id % 3 = 0 THEN 'Marke Modell ' || page_id ELSE trim({_H1}) END AS "Titel",
      CASE WHEN page_id % 2 = 0 THEN (10 + page_id % 80) || '.500 €' ELSE (10 + page_id % 80) || '.900 €' END AS "Preis",
      (1 + page_id % 200) || CASE WHEN page_id % 5 = 0 THEN '.000 KM' ELSE '.000 km' END AS "Kilometerstand",
      CASE page_id % 3 WHEN 0 THEN 'EZ 03/2015' WHEN 1 THEN 'Erstzulassung: 11/2019' ELSE '07/2012' END AS "Erstzulassung",
      (90 + page_id % 100) || ' PS' AS "PS",
      CASE page_id % 3 WHEN 0 THEN 'Automatik' WHEN 1 THEN 'Schaltgetriebe' ELSE 'N/A' END AS "Getriebe",
      CASE page_id % 4 WHEN 0 THEN 'Benzin' WHEN 1 THEN 'Diesel' WHEN 2 THEN 'Autogas (LPG)' ELSE 'N/A' END AS "Kraftstoff",
      (page_id % 5) || '' AS "Fahrzeughalter", lpad((page_id % 100000)::VARCHAR, 5, '0') || ' Bad Musterstadt' AS "Standort",
      url AS "URL", 'ABS, Klima, Paket ' || (page_id % 9) AS "Ausstattung", 'Zustand & mehr | Nr. ' || page_id AS "Beschreibung"
      FROM pages""",
    "page_listings_clean": """SELECT (10 + page_id % 80) * 1000.0::DOUBLE + CASE WHEN page_id % 2 = 0 THEN 500 ELSE 900 END AS price_eur,
      (1 + page_id % 200) * 1000.0::DOUBLE AS mileage_km, (90 + page_id % 100)::DOUBLE AS power_ps,
      CASE page_id % 3 WHEN 0 THEN '03/2015' ELSE '07/2012' END AS registration,
      CASE page_id % 4 WHEN 0 THEN 'petrol' WHEN 1 THEN 'diesel' END AS fuel,
      CASE page_id % 3 WHEN 0 THEN 'automatic' END AS transmission, (page_id % 5)::DOUBLE AS owners,
      lpad((page_id % 100000)::VARCHAR, 5, '0') || ' Bad Musterstadt' AS location
      FROM pages WHERE page_id % 5 <> 0 AND page_id % 3 <> 1""",
    "page_title": f"""SELECT page_id, trim({_H1}) AS "Titel" FROM pages""",
    "page_links": """WITH a AS (
      SELECT page_id, 1 AS pos, 'https://suchen.mobile.de/fahrzeuge/details.html?id=' || (page_id % 100) AS link FROM pages
      UNION ALL SELECT page_id, 2, 'https://other.example.com/fahrzeuge/details.html?id=' || page_id FROM pages
      UNION ALL SELECT page_id, 3, 'https://suchen.mobile.de/fahrzeuge/details.html' FROM pages)
      SELECT min(page_id) AS page_id, link FROM a GROUP BY link""",
    "page_links_first": """WITH a AS (
      SELECT page_id, 1 AS pos, 'https://suchen.mobile.de/fahrzeuge/details.html?id=' || (page_id % 100) AS link FROM pages
      UNION ALL SELECT page_id, 2, 'https://other.example.com/fahrzeuge/details.html?id=' || page_id FROM pages
      UNION ALL SELECT page_id, 3, 'https://suchen.mobile.de/fahrzeuge/details.html' FROM pages)
      SELECT page_id, link FROM (SELECT min(page_id) AS page_id, arg_min(pos, page_id) AS pos, link FROM a GROUP BY link)
      ORDER BY page_id, pos LIMIT 200""",
    "page_link_canon": "SELECT page_id, CASE WHEN url LIKE '%?%' THEN split_part(url, '?', 1) || '?' || "
        "split_part(split_part(url, '?', 2), '&', 1) ELSE url END AS link FROM pages",
    # market
    "market_view_de": _DE_F + f"SELECT {_PARENT_DE.replace('id,', 'n.id,', 1)}, {_DETAIL_DE}, {_FEATURE_LIST} "
                              "FROM n LEFT JOIN f ON f.listing_id = n.id",
    "market_view_us": _US + f"""SELECT id, make AS brand, model, {_US_TITLE} AS title, price_usd AS price, mileage_mi AS mileage,
      year::BIGINT AS year, NULL::VARCHAR AS location, vdp_url AS url, trim, model AS model_us, year::BIGINT AS year_us,
      NULL::VARCHAR AS location_us, engine, cylinders FROM n""",
    "market_titles_de": _DE + f"SELECT id, concat_ws(' ', {_shown('brand')}, {_shown('model')}) AS title FROM n",
    "brand_options": _DE + "SELECT brand, row_number() OVER (ORDER BY brand) AS ordinal FROM (SELECT DISTINCT brand FROM n)",
    "model_options": _US + """SELECT *, row_number() OVER (PARTITION BY brand ORDER BY model) AS ordinal FROM (
      SELECT DISTINCT make AS brand, model FROM n UNION ALL
      SELECT * FROM (VALUES ('ford', 'f-150'), ('ford', 'f-250'), ('ford', 'f-350'), ('lexus', 'nx')) x(brand, model)
      UNION ALL SELECT 'mercedes-benz', unnest(['c-klasse', 'e-klasse', 's-klasse', 'a-klasse', 'b-klasse', 'cla', 'cls', 'glc',
        'gle', 'gla', 'glb', 'gls', 'eqe', 'eqs', 'eqa', 'eqb', 'eqc', 'v-klasse', 'g-klasse']))""",
    "trim_options": _DE_N + """SELECT *, row_number() OVER (PARTITION BY brand, model ORDER BY option) AS ordinal
      FROM (SELECT DISTINCT brand, model, trim AS option FROM t WHERE trim <> '')
      UNION ALL SELECT DISTINCT brand, model, 'Alle', 0 FROM t""",
    "location_options": _DE + """SELECT *, row_number() OVER (PARTITION BY brand ORDER BY location) AS ordinal
      FROM (SELECT DISTINCT brand, location FROM n)""",
    "default_power": _DE_N + """SELECT brand, model, trim, coalesce(trunc(median(power_ps) FILTER (power_ps > 0)), 150)::BIGINT AS power_ps
      FROM t WHERE model IS NOT NULL GROUP BY brand, model, trim""",
    "match_offers_de": _DE + _BUYERS_DE + "SELECT subject_id, id, price_eur AS price, mileage_km AS mileage FROM m",
    "match_offers_top": _DE + _BUYERS_DE + """SELECT subject_id, row_number() OVER (PARTITION BY subject_id ORDER BY price_eur, id)
      AS offer_rank, title, price_eur AS price, mileage_km AS mileage, location, CASE WHEN url LIKE 'http%' THEN url ELSE '' END AS link
      FROM m QUALIFY offer_rank <= 20""",
    "match_offers_by_mileage": _DE + _BUYERS_DE + """SELECT subject_id,
      row_number() OVER (PARTITION BY subject_id ORDER BY mileage_km DESC, id) AS offer_rank, id, mileage_km AS mileage
      FROM m QUALIFY offer_rank <= 30""",
    "match_offers_all": _DE + _BUYERS_DE + "SELECT subject_id, id, location FROM m",
    "match_offer_counts": _DE + _BUYERS_DE + "SELECT subject_id, count(*) AS offers FROM m GROUP BY subject_id",
    "match_offers_us": _US + _BUYERS_US + """SELECT subject_id, n.id, n.cylinders, n.fuel FROM n
      JOIN s ON n.make = s.make AND n.model = s.model
      WHERE mileage_mi <= 250000 AND n.fuel = want_fuel AND (want_cyl IS NULL OR n.cylinders = want_cyl)""",
    "match_trim": _DE_N + """, s AS (SELECT brand, model, min(id) AS subject_id, arg_min(trim, id) AS trim FROM t
        WHERE model IS NOT NULL GROUP BY brand, model)
      SELECT subject_id, t.id, t.title FROM t JOIN s USING (brand, model, trim)""",
    "match_location": _DE + """, s AS (SELECT brand, model, min(id) AS subject_id, arg_min(location, id) AS location FROM n
        WHERE model IS NOT NULL GROUP BY brand, model)
      SELECT subject_id, n.id, location FROM n JOIN s USING (brand, model, location)""",
    "two_tier_options": _US + _BUYERS_US + """, x AS (
        SELECT s.subject_id, n.*, coalesce(n.fuel = want_fuel, false) AS fm, coalesce(n.cylinders = want_cyl, false) AS cm
        FROM n JOIN s ON n.make = s.make AND n.model = s.model),
      y AS (SELECT * FROM (SELECT *, bool_or(fm) OVER (PARTITION BY subject_id) AS hf FROM x) WHERE fm OR NOT hf),
      z AS (SELECT * FROM (SELECT *, bool_or(cm) OVER (PARTITION BY subject_id) AS hc FROM y) WHERE cm OR NOT hc),
      o AS (SELECT DISTINCT subject_id, field, option FROM (UNPIVOT (SELECT subject_id, trim, engine, exterior_color, interior_color
        FROM z) ON trim, engine, exterior_color, interior_color INTO NAME field VALUE option) WHERE option <> '')
      SELECT *, row_number() OVER (PARTITION BY subject_id, field ORDER BY option) AS ordinal FROM (SELECT * FROM o UNION ALL
      SELECT s.subject_id, c.field, 'unknown' FROM s, (VALUES ('trim'), ('engine'), ('exterior_color'), ('interior_color')) c(field)
      WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.subject_id = s.subject_id AND o.field = c.field))""",
    "alternative_models": _US + _BUYERS_US + """, b AS (
        SELECT make, model, min(id) AS seen FROM n GROUP BY make, model)
      SELECT s.subject_id, s.make AS brand, s.model, b.model AS alt_model,
        row_number() OVER (PARTITION BY s.subject_id ORDER BY b.seen) AS alt_rank
      FROM s JOIN b ON b.make = s.make AND b.model <> s.model QUALIFY alt_rank <= 5""",
    "display_names": "SELECT p_partkey, (CASE WHEN length(split_part(p_name, ' ', 1)) <= 3 THEN upper(split_part(p_name, ' ', 1)) "
        "ELSE upper(p_name[1]) || split_part(p_name, ' ', 1)[2:] END) || '-' || upper(substr(split_part(p_name, ' ', 2), 1, 3)) "
        "AS shown FROM part",
    # training
    "train_rows_de": _DE_F + f"SELECT {_ROWS_DE}, {_FEATURE_LIST} FROM n JOIN f ON f.listing_id = n.id",
    "train_rows_us": _US + f"SELECT {_ROWS_US} FROM n",
    "train_eligible_us": _US + "SELECT id AS listing_id, make AS brand FROM n WHERE make NOT LIKE '%brand#1%'",
    "median_impute": _US + ", e AS (SELECT * FROM n) SELECT id AS listing_id, "
        + ", ".join(map(_median_fill, ("accident_count", "owner_count", "cylinders", "doors", "seats"))) + " FROM n",
    "column_medians": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round(median({c}), 6) AS median FROM lineitem"
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    ),
    "onehot_matrix": _US + f", r AS (SELECT {_ROWS_US} FROM n) " + " UNION ALL ".join(
        f"SELECT listing_id, '{c}_' || {c} AS feature FROM r" for c in _US_CATEGORICAL
    ),
    "encoder_vocabulary": _DE_F + f", r AS (SELECT {_ROWS_DE} FROM n JOIN f ON f.listing_id = n.id) " + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, row_number() OVER (ORDER BY {c}) - 1 AS pos, {c} AS category FROM (SELECT DISTINCT {c} FROM r)"
        for c in ("brand", "model", "transmission", "fuel")
    ),
    "split_counts": _US + """SELECT count(*) - ceil(count(*) * 0.2)::BIGINT AS train_rows, ceil(count(*) * 0.2)::BIGINT AS test_rows,
      count(*) AS ids, 3::BIGINT AS folds FROM n""",
    "metrics_mae_r2": _US + """, r AS (SELECT make AS brand, price_usd AS price, 90000.0::DOUBLE - 0.015::DOUBLE * mileage_mi
        - 900.0::DOUBLE * car_age + 733.0::DOUBLE * length(model) + 410.0::DOUBLE * coalesce(cylinders, 0) AS p FROM n),
      a AS (SELECT brand, avg(price) AS mean FROM r GROUP BY brand)
      SELECT brand, round(avg(abs(price - p)), 3) AS mae, round(1 - sum((price - p) ** 2) / sum((price - mean) ** 2), 4) AS r2,
        count(*) AS rows FROM r JOIN a USING (brand) GROUP BY brand""",
    # rules around a price
    "recommend_de": _RECOMMEND_DE + f"SELECT subject_id, {_RANKED}, type, saving::DOUBLE AS saving, text FROM r",
    "recommend_us": _RECOMMEND_US + f"SELECT subject_id, {_RANKED}, type, saving::DOUBLE AS saving, text FROM r",
    "recommend_de_first": _RECOMMEND_DE + f"SELECT subject_id, {_RANKED}, type FROM r QUALIFY saving_rank <= 5",
    "scenario_rows": _RECOMMEND_DE + """SELECT subject_id, 'base' AS kind, 1 AS n FROM cars
      UNION ALL SELECT subject_id, 'toggle', CASE WHEN subject_id % 2 = 0 THEN 14 ELSE 10 END FROM cars
      UNION ALL SELECT subject_id, 'mileage', (mileage_km >= 15000)::BIGINT + (mileage_km >= 25000)::BIGINT + (mileage_km >= 55000)::BIGINT
        FROM cars WHERE subject_id % 2 = 0 AND mileage_km > 20000
      UNION ALL SELECT subject_id, 'model', count(*) FROM alts GROUP BY subject_id""",
    "depreciation": _US + """SELECT id AS subject_id,
        round(90000.0 + 733.0 * length(model) + 410.0 * coalesce(cylinders, 0), 6)::DOUBLE AS price_new,
        round(90000.0::DOUBLE - 0.015::DOUBLE * mileage_mi - 900.0 * car_age + 733.0 * length(model) + 410.0 * coalesce(cylinders, 0), 6)
          AS price_used,
        round(0.015::DOUBLE * mileage_mi + 900.0 * car_age, 6) AS loss FROM n""",
    "subject_flags_us": _US + """SELECT id AS subject_id, (owner_count = 1)::INT::DOUBLE AS one_owner,
      (accident_count > 0)::INT::DOUBLE AS has_accidents, 1.0::DOUBLE AS is_used, 0.0::DOUBLE AS is_cpo, 0.0::DOUBLE AS is_online,
      0.0::DOUBLE AS is_wholesale, (usage_type IS NOT NULL)::INT::DOUBLE AS personal_use FROM n""",
    "request_defaults_de": _DE + """SELECT id AS subject_id, brand, model, coalesce(fuel, 'benzin') AS fuel,
      coalesce(power_ps, 150.0) AS power_ps, 'automatic' AS transmission, 1.0::DOUBLE AS owners, 0.0::DOUBLE AS ausstattung_pano,
      0.0::DOUBLE AS ausstattung_amg_line FROM n""",
}

ORACLES["de_cleaned_csv"] = ORACLES["stream_firsts"] = ORACLES["de_clean"]
ORACLES["unknown_categories"] = _US + "SELECT count(*) AS brand, 0::BIGINT AS model, " + ", ".join(
    f"count(*) FILTER ({c} IS NULL) AS {c}" for c in _US_CATS
) + " FROM n"

_PARTS = _CARS_DE + """, x AS (SELECT * FROM cars WHERE model IS NOT NULL AND fuel IS NOT NULL AND power_ps IS NOT NULL),
q AS (
  SELECT subject_id, 'mileage' AS feature, mileage_km AS value, mileage_km * -0.07::DOUBLE AS contribution, 'Kilometerstand' AS label,
    'Kilometerstand von ' || format('{:,}', mileage_km::BIGINT) || ' km' AS sentence FROM x
  UNION ALL SELECT subject_id, 'car_age', car_age, floor(car_age) * -311.5, 'Fahrzeugalter', 'Fahrzeugalter von ' || trunc(car_age)::BIGINT || ' Jahren' FROM x
  UNION ALL SELECT subject_id, 'power_ps', power_ps, power_ps * 21.25, 'Leistung (PS)', 'Leistung (PS) von ' || power_ps::BIGINT || ' PS' FROM x
  UNION ALL SELECT subject_id, 'unfallfrei', unfallfrei, unfallfrei * 1900.75 - 800.5, 'Unfallfrei',
    CASE WHEN unfallfrei = 1 THEN 'Mit Unfallfrei' ELSE 'Ohne Unfallfrei' END FROM x
  UNION ALL SELECT subject_id, 'garantie_monate', garantie_monate, garantie_monate * 33.125 + 0.25, 'Garantie (Monate)',
    garantie_monate || ' Monate Garantie' FROM x
  UNION ALL SELECT subject_id, 'model_' || model, 1, 99999.0, 'Modell: ' || @SHOWN_MODEL@, 'Modell: ' || @SHOWN_MODEL@ FROM x
  UNION ALL SELECT subject_id, 'brand_' || brand, 1, length(brand) * 777.125, 'Marke: ' || @SHOWN_BRAND@, 'Marke: ' || @SHOWN_BRAND@ FROM x
  UNION ALL SELECT subject_id, 'fuel_diesel', 0, -250.375, 'Kraftstoff: Diesel',
    CASE WHEN fuel = 'diesel' THEN 'Kraftstoff: Diesel' ELSE 'Kein Kraftstoff: Diesel' END FROM x
  UNION ALL SELECT subject_id, 'price_per_km', 1, 12.625, 'Preis/km', 'Preis/km' FROM x
  UNION ALL SELECT subject_id, 'some_new_thing', 0, -3.0625, 'Some New Thing', 'Some New Thing' FROM x)
"""
_PARTS = _PARTS.replace("@SHOWN_MODEL@", _shown("model")).replace("@SHOWN_BRAND@", _shown("brand"))
ORACLES["contribution_top"] = _PARTS + """SELECT subject_id,
  row_number() OVER (PARTITION BY subject_id ORDER BY abs(contribution::DOUBLE) DESC, feature) AS rank, feature,
  round(value, 6)::DOUBLE AS value, round(contribution, 6)::DOUBLE AS contribution
  FROM q WHERE feature NOT LIKE 'model@_%' ESCAPE '@' QUALIFY rank <= 5"""
ORACLES["contribution_labels"] = _PARTS + """SELECT subject_id, feature, label, sentence,
  CASE WHEN contribution > 0 THEN 'up' ELSE 'down' END AS direction,
  CASE WHEN contribution < 0 THEN '-' ELSE '+' END || format('{:,}', round_even(abs(contribution), 0)::BIGINT) || ' €' AS amount FROM q"""

ORACLES["contribution_report"] = _PARTS + """SELECT subject_id,
  row_number() OVER (PARTITION BY subject_id ORDER BY abs(contribution::DOUBLE) DESC, feature) AS rank, feature,
  round(value, 6)::DOUBLE AS value, round(contribution, 6)::DOUBLE + 0.0 AS contribution
  FROM q QUALIFY rank <= 15"""
ORACLES["feature_upsert_stored"] = ORACLES["feature_upsert"]
ORACLES["raw_outputs_stored"] = "SELECT conv_id * 1000 + turn AS listing_id, text AS raw_output FROM conversations"

# a tree with one split on a two-valued number predicts the means of its two groups
_KNOWN = """WITH r AS (SELECT o_orderkey AS id, o_totalprice AS price,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderstatus = 'O' THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS oc FROM orders),
f AS (SELECT id, price, coalesce(oc, (SELECT median(oc) FROM r)) AS oc FROM r),
g AS (SELECT oc, avg(price) AS p FROM f GROUP BY oc),
k AS (SELECT f.id, f.price, f.oc, g.p, (SELECT avg(price) FROM f) AS base FROM f JOIN g ON f.oc = g.oc)
"""
ORACLES["known_predictions"] = _KNOWN + "SELECT id AS subject_id, round(p, 6) AS prediction FROM k"
ORACLES["known_metrics"] = _KNOWN + """SELECT round(avg(abs(price - p)), 3) AS mae,
  round(1 - sum((price - p) ** 2) / sum((price - base) ** 2), 6) AS r2, count(*) AS rows FROM k"""
ORACLES["known_contributions"] = _KNOWN + """SELECT id AS subject_id, 'owner_count' AS feature, oc AS value,
  round(base, 4) AS base_value, round(p - base, 4) AS contribution, round(p, 4) AS prediction FROM k"""
ORACLES["known_reports"] = _KNOWN + """SELECT id AS subject_id, round(p, 2) AS price, '$' AS currency, n.feature,
  CASE WHEN n.feature = 'owner_count' THEN round(p - base, 2) ELSE 0.0::DOUBLE END AS impact
  FROM k CROSS JOIN (VALUES ('mileage'), ('car_age'), ('owner_count'), ('brand_x')) AS n(feature)"""
ORACLES["known_cv"] = "SELECT count(*) AS rows, 1::BIGINT AS max_depth, 1::BIGINT AS trees FROM orders"

ORACLES["page_failures"] = """SELECT page_id, html IS NOT NULL AND page_id % 5 = 0 AS failed,
  html IS NULL OR page_id % 5 = 0 AS empty FROM pages"""
ORACLES["doc_deep_pairs"] = "SELECT event_id AS listing_id, 'inner key' AS key, event_type AS value FROM events"

ORACLES["market_view_empty"] = """SELECT ''::VARCHAR AS brand, ''::VARCHAR AS model, ''::VARCHAR AS title, 0::DOUBLE AS price,
  0::DOUBLE AS mileage, ''::VARCHAR AS location, ''::VARCHAR AS url FROM orders WHERE o_totalprice < 0"""

ORACLES["us_cleaned_csv"] = "SELECT vin, make, model, price_usd, mileage_mi, zip_code, accident_count, one_owner, car_age FROM (" \
    + ORACLES["us_clean"] + ")"
ORACLES["json_pages_inferred"] = "SELECT event_id, event_type, CASE WHEN event_id % 3 = 0 THEN round(value, 2) END AS amount FROM events"
ORACLES["prompt_candidates_range"] = _DE + "SELECT id, beschreibung FROM n WHERE beschreibung IS NOT NULL AND id BETWEEN 100 AND 817"
ORACLES["market_view_misspelt"] = "SELECT id, ausstattung_burmester_standard FROM (" + ORACLES["market_view_de"] + ")"
ORACLES["market_view_bare"] = _US + f"SELECT id, concat_ws(' ', {_shown('make')}, {_shown('model')}) AS title, '' AS location, '' AS url FROM n"
ORACLES["known_predictions_loaded"] = ORACLES["known_predictions"]
ORACLES["known_predictions_absent"] = _KNOWN + "SELECT id AS subject_id, round((SELECT max(p) FROM g WHERE oc = 1), 6) AS prediction FROM k"
ORACLES["request_defaults_us"] = _US + """SELECT id AS subject_id, make AS brand, model, coalesce(fuel, 'benzin') AS fuel,
  coalesce(cylinders, 6.0) AS cylinders, 'automatic' AS transmission, 0.0::DOUBLE AS has_accidents, 0.0::DOUBLE AS is_cpo,
  4.0::DOUBLE AS doors, 5.0::DOUBLE AS seats, """ + ", ".join(f"'unbekannt' AS {c}" for c in (
    "engine", "trim", "drivetrain", "body_style", "exterior_color", "interior_color", "usage_type")) + " FROM n"
ORACLES["contribution_labels_us"] = _US + f""", x AS (SELECT *, (owner_count = 1)::INT AS first_hand, (accident_count > 0)::INT AS hit FROM n
    WHERE owner_count IS NOT NULL AND accident_count IS NOT NULL AND cylinders IS NOT NULL),
q AS (
  SELECT id, 'mileage' AS feature, 'Kilometerstand von ' || format('{{:,}}', mileage_mi::BIGINT) || ' Meilen' AS sentence,
    mileage_mi * -0.07::DOUBLE AS a FROM x
  UNION ALL SELECT id, 'owner_count', owner_count::BIGINT || ' Vorbesitzer', owner_count * -311.5::DOUBLE FROM x
  UNION ALL SELECT id, 'accident_count', accident_count::BIGINT || ' gemeldete Unfälle', accident_count * -905.25::DOUBLE FROM x
  UNION ALL SELECT id, 'cylinders', cylinders::BIGINT || '-Zylinder-Motor', cylinders * 250.75::DOUBLE FROM x
  UNION ALL SELECT id, 'has_accidents', CASE WHEN hit = 1 THEN 'Mit Unfällen' ELSE 'Unfallfrei' END, hit * -400.5::DOUBLE + 12.25 FROM x
  UNION ALL SELECT id, 'one_owner', CASE WHEN first_hand = 1 THEN 'Aus 1. Hand' ELSE 'Mehrere Vorbesitzer' END, first_hand * 300.5::DOUBLE - 20.75 FROM x
  UNION ALL SELECT id, 'brand_' || make, 'Marke: ' || {_shown('make')}, 777.125::DOUBLE FROM x
)
SELECT id AS subject_id, feature, sentence, CASE WHEN a < 0 THEN '-' ELSE '+' END
  || format('{{:,}}', round_even(abs(a), 0)::BIGINT) || ' $' AS amount FROM q"""

ORACLES["json_members"] = """SELECT event_id AS row_pos, 'id' AS key, event_id || '' AS value FROM events
UNION ALL SELECT event_id, 'owner', NULL FROM events WHERE event_id % 3 = 0
UNION ALL SELECT event_id, 'owner_first name', event_type FROM events WHERE event_id % 3 = 1
UNION ALL SELECT event_id, 'odd' || event_id, 'true' FROM events WHERE event_id % 500 = 0
UNION ALL SELECT event_id, 'tags', '[{"b": null, "a": "\\u00fc, x"}, {}, ' || event_id % 3 || ']' FROM events"""

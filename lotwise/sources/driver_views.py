"""Raw listing views derived from the benchmark tables.

The tables hold no car data, so every line item becomes one collected listing: all fields are text
expressions over the order, part, customer, supplier and nation it belongs to. The line items of one
order are repeated collections of the same listing, which gives the deduplication its copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.session import spread

US_ORDER = ("row_pos", "row_sub")
#: line items that a task joins and widens to listings; as keys they are some ten bytes, as listings about a thousand
ROWS_PER_TASK = 250_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _joined(spark: SparkSession, sf_dir: str, suppliers: DataFrame | None = None) -> DataFrame:
    """Line items with their order, part and places, and their supplier if wanted; only the columns the views need.

    Orders meet their part and places first: there are several line items to an order, and they move once, as keys.
    Spark would merge the partitions of such small rows by their bytes, to a few tasks of millions of listings that
    spill as soon as they are wide; so the number of partitions follows the number of line items.
    """
    t = lambda name: table(spark, sf_dir, name)
    items = t("lineitem").selectExpr("l_orderkey AS k", "l_linenumber AS ln", "l_partkey", "l_suppkey")
    tasks = -(-items.count() // ROWS_PER_TASK)
    many = tasks > spark.sparkContext.defaultParallelism
    items = items if many else spread(items)
    if suppliers is not None:
        items = items.join(suppliers, "l_suppkey")
    orders = t("orders").selectExpr(
        "o_orderkey AS k", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    parts = t("part").selectExpr("p_partkey AS pk", "p_name", "p_brand", "p_type", "p_size")
    part_count = t("part").agg(F.count(F.lit(1)).alias("n")).scalar()
    customers = t("customer").selectExpr("c_custkey AS o_custkey", "c_mktsegment", "c_nationkey")
    nations = t("nation").selectExpr("n_nationkey AS c_nationkey", "n_name")
    placed = (
        orders.withColumn("pk", F.col("k") % part_count)
        .join(parts, "pk")
        .join(customers.join(nations, "c_nationkey"), "o_custkey")
    )
    return items.repartition(tasks, "k").join(placed.repartition(tasks, "k"), "k") if many else items.join(placed, "k")


_GROUPED = "replace(format_number({0}, 0), ',', '.')"


def raw_de(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw DE listings: twelve text columns and the input position."""
    price = _GROUPED.format("CAST(floor(o_totalprice * 0.45) AS BIGINT)")
    mileage = _GROUPED.format("(k * 7919) % 350000")
    month = "month(o_orderdate)"
    year = "CAST(1985 + k % 45 AS STRING)"
    return _joined(spark, sf_dir).selectExpr(
        "k * 8 + ln AS row_pos",
        "CASE WHEN k % 53 = 0 THEN p_brand WHEN k % 11 = 0 THEN concat('  ', p_brand, '   ', p_name, ' ') "
        "ELSE concat(p_brand, ' ', p_name, ' ', CAST(k % 7 AS STRING)) END AS Titel",
        "CASE WHEN k % 37 = 0 THEN 'auf Anfrage' WHEN k % 47 = 0 THEN NULL "
        f"ELSE concat({price}, CASE WHEN k % 4 = 0 THEN ',50' ELSE '' END, "
        "CASE WHEN k % 3 = 0 THEN '\\u00a0€' ELSE ' €' END) END AS Preis",
        "CASE WHEN k % 43 = 0 THEN 'unknown' WHEN k % 59 = 0 THEN '-5 km' "
        f"ELSE concat({mileage}, ' km') END AS Kilometerstand",
        "CASE WHEN k % 41 = 0 THEN '13/2020' "
        f"WHEN k % 29 = 0 THEN concat('EZ: ', lpad(CAST({month} AS STRING), 2, '0'), '/', {year}) "
        f"WHEN k % 5 = 0 THEN concat(CAST({month} AS STRING), '/', {year}) "
        f"WHEN k % 7 = 0 THEN concat('Erstzulassung\\u00a0', lpad(CAST({month} AS STRING), 2, '0'), '/', {year}) "
        f"ELSE concat('EZ ', lpad(CAST({month} AS STRING), 2, '0'), '/', {year}) END AS Erstzulassung",
        "CASE WHEN k % 19 = 0 THEN 'N/A' "
        "ELSE concat(CAST(p_size * 10 + 50 AS STRING), CASE WHEN k % 3 = 0 THEN '\\u00a0PS' ELSE ' PS' END) END AS PS",
        "CASE o_orderstatus WHEN 'F' THEN 'Automatik' WHEN 'O' THEN ' Schaltgetriebe ' ELSE 'Halbautomatik' END "
        "AS Getriebe",
        "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Benzin' WHEN '2' THEN 'Diesel' WHEN '3' THEN 'Hybrid' "
        "WHEN '4' THEN 'Elektro' ELSE 'Autogas (LPG)' END AS Kraftstoff",
        "CASE WHEN k % 6 = 0 THEN 'N/A' ELSE concat(CAST(k % 5 AS STRING), ' Fahrzeughalter') END AS Fahrzeughalter",
        "n_name AS Standort",
        "CASE WHEN k % 31 = 0 THEN concat('/offers/', CAST(k AS STRING)) "
        "ELSE concat('https://listings.example.com/', CAST(k AS STRING)) END AS URL",
        "p_type AS Ausstattung",
        "CASE WHEN k % 9 = 0 THEN NULL ELSE concat('Zustand ', c_mktsegment, ', ', p_name) END AS Beschreibung",
    )


def raw_us(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw US listings, flattened text columns; ``row_pos`` and ``row_sub`` give the input order."""
    flag = (
        "CASE {0} WHEN 0 THEN 'true' WHEN 1 THEN '1' WHEN 2 THEN 'Yes' WHEN 3 THEN ' y ' WHEN 4 THEN 't' "
        "WHEN 5 THEN 'False' WHEN 6 THEN '0' WHEN 7 THEN 'no' WHEN 8 THEN 'N' WHEN 9 THEN 'f' "
        "WHEN 10 THEN 'none' WHEN 11 THEN '' WHEN 12 THEN 'maybe' END"
    )
    price = "(k * 977 + (ln % 2) * 50) % 310000"
    suppliers = table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS l_suppkey", "s_name")
    return _joined(spark, sf_dir, suppliers).selectExpr(
        "k * 8 + ln AS row_pos",
        "l_partkey * 1000000 + l_suppkey AS row_sub",
        "concat('us-', CAST(k AS STRING), '-', CAST(ln AS STRING), '-', CAST(l_partkey AS STRING), '-', "
        "CAST(l_suppkey AS STRING)) AS `@id`",
        "CASE WHEN k % 23 = 0 THEN NULL WHEN k % 27 = 0 THEN 'not a date' "
        "ELSE concat(date_format(o_orderdate, 'yyyy-MM-dd'), 'T0', CAST(ln AS STRING), ':00:00Z') END AS createdAt",
        "n_name AS location",
        f"{flag.format('k % 14')} AS online",
        "CASE WHEN k % 26 = 0 THEN NULL ELSE upper(substr(md5(CAST(k AS STRING)), 1, 11)) END AS vin",
        "CASE WHEN k % 7 = 0 THEN 'N/A' ELSE CAST(k % 23 AS STRING) END AS history_accidentCount",
        f"{flag.format('k % 13')} AS history_accidents",
        f"{flag.format('(k + 3) % 14')} AS history_oneOwner",
        "CASE WHEN k % 5 = 0 THEN NULL ELSE CAST(k % 18 AS STRING) END AS history_ownerCount",
        f"{flag.format('(k + 5) % 14')} AS history_personalUse",
        "CASE WHEN k % 4 = 0 THEN 'nan' ELSE concat(' ', c_mktsegment) END AS history_usageType",
        "concat('https://reports.example.com/', CAST(k AS STRING)) AS retailListing_carfaxUrl",
        "concat('City ', CAST(k % 97 AS STRING)) AS retailListing_city",
        f"{flag.format('(k + 7) % 14')} AS retailListing_cpo",
        "s_name AS retailListing_dealer",
        "CASE WHEN k % 67 = 0 THEN '-500 mi' ELSE concat(format_number((k * 7919) % 420000, 0), ' mi') END "
        "AS retailListing_miles",
        "CAST(k % 30 AS STRING) AS retailListing_photoCount",
        f"CASE WHEN k % 61 = 0 THEN 'call us' WHEN k % 8 = 0 THEN concat('€', format_number({price}, 0), '.50') "
        f"ELSE concat('$', format_number({price}, 0)) END AS retailListing_price",
        "concat('https://img.example.com/', CAST(k AS STRING), '.jpg') AS retailListing_primaryImage",
        "concat(' ', n_name, ' ') AS retailListing_state",
        f"{flag.format('(k + 9) % 14')} AS retailListing_used",
        "concat('https://cars.example.com/', CAST(k AS STRING)) AS retailListing_vdp",
        "lpad(CAST(k % 100000 AS STRING), 5, '0') AS retailListing_zip",
        "CAST(20000 + k % 9000 AS STRING) AS vehicle_baseInvoice",
        "CAST(22000 + k % 9000 AS STRING) AS vehicle_baseMsrp",
        "initcap(p_type) AS vehicle_bodyStyle",
        "'0.95' AS vehicle_confidence",
        "CASE WHEN k % 21 = 0 THEN 'None' ELSE concat(CAST((k % 4 + 1) * 2 AS STRING), ' cyl') END AS vehicle_cylinders",
        "CASE WHEN k % 22 = 0 THEN NULL ELSE CAST(2 + k % 4 AS STRING) END AS vehicle_doors",
        "CASE k % 4 WHEN 0 THEN 'AWD' WHEN 1 THEN 'FWD' WHEN 2 THEN 'RWD' ELSE '' END AS vehicle_drivetrain",
        "CASE WHEN k % 16 = 0 THEN NULL ELSE concat(CAST(k % 6 + 1 AS STRING), '.0L') END AS vehicle_engine",
        "split(p_name, ' ')[0] AS vehicle_exteriorColor",
        "split(p_name, ' ')[1] AS vehicle_fuel",
        "CASE WHEN k % 3 = 0 THEN 'None' ELSE split(p_name, ' ')[0] END AS vehicle_interiorColor",
        "CASE WHEN k % 71 = 0 THEN 'None' ELSE concat(' ', p_brand, ' ') END AS vehicle_make",
        "CASE WHEN k % 73 = 0 THEN '' ELSE p_name END AS vehicle_model",
        "CAST(4 + k % 4 AS STRING) AS vehicle_seats",
        "'series' AS vehicle_series",
        "'squish' AS vehicle_squishVin",
        "'style' AS vehicle_style",
        "CASE WHEN k % 2 = 0 THEN 'Automatic' ELSE 'MANUAL' END AS vehicle_transmission",
        "CASE WHEN k % 10 = 0 THEN '' WHEN k % 15 = 0 THEN 'nan' ELSE concat(p_type, ' ', CAST(p_size AS STRING)) END "
        "AS vehicle_trim",
        "'car' AS vehicle_type",
        "CASE WHEN k % 13 = 0 THEN NULL WHEN k % 17 = 0 THEN 'INVALIDVIN!!!' "
        "WHEN k % 3 = 0 THEN concat('  ', substr(md5(CAST(k AS STRING)), 1, 17), ' ') "
        "ELSE upper(substr(md5(CAST(k AS STRING)), 1, 17)) END AS vehicle_vin",
        "CASE WHEN k % 3 = 0 THEN concat(CAST(1986 + k % 44 AS STRING), '.0') ELSE CAST(1986 + k % 44 AS STRING) END "
        "AS vehicle_year",
        f"{flag.format('(k + 11) % 14')} AS wholesaleListing",
        "'x' AS unknown_extra",
    )


def feature_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(listing_id, ai_features)``: one document per text, most of them nested JSON around the whole text."""
    history = (
        "named_struct("
        "'TÜV', CASE doc_id % 3 WHEN 0 THEN 'HU/AU neu' WHEN 1 THEN 'abgelaufen' ELSE ' GÜLTIG ' END, "
        "'Scheckheft', CASE doc_id % 4 WHEN 0 THEN 'Lückenlos' WHEN 1 THEN 'nein' ELSE '' END, "
        "'Bereifung', CASE doc_id % 5 WHEN 0 THEN '8-fach' WHEN 1 THEN 'Winter und Sommer' "
        "WHEN 2 THEN 'Allwetterreifen' ELSE 'Sommer' END, "
        "'Garantie', CASE doc_id % 7 WHEN 0 THEN '24 Monate' WHEN 1 THEN '12' ELSE 'keine' END, "
        "'Unfallfrei', doc_id % 2 = 0, "
        "'Mängel', CASE doc_id % 6 WHEN 0 THEN 'Keine' WHEN 1 THEN 'Steinschlag' WHEN 2 THEN 'false' ELSE 'Delle' END)"
    )
    equipment = (
        "named_struct('Distronic', doc_id % 5 < 2, 'Paket', CASE doc_id % 8 WHEN 0 THEN 'AMG Line' "
        "WHEN 1 THEN 'Burmester Surround' WHEN 2 THEN 'Thermotronic' WHEN 3 THEN 'nein' ELSE 'Thermatic' END)"
    )
    nested = f"to_json(named_struct('historie', {history}, 'ausstattung', {equipment}, 'liste', array(1, 2), 'notiz', text))"
    literal = r"{\'TÜV\': \'neu\', \'Unfallfrei\': true, \'Garantie\': \'6 Monate\', \'Pano\': null, \'Extras\': [1]}"
    return spread(table(spark, sf_dir, "documents")).selectExpr(
        "doc_id + 1 AS listing_id",
        "CASE doc_id % 12 WHEN 0 THEN NULL WHEN 1 THEN concat('not valid json ', text) WHEN 2 THEN '[1, 2]' "
        f"WHEN 3 THEN '{literal}' ELSE {nested} END AS ai_features",
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(listing_id, raw_output)``: objects with text around them, cut objects, and no object at all."""
    document = "to_json(named_struct('role', role, 'text', text))"
    return spread(table(spark, sf_dir, "conversations")).selectExpr(
        "conv_id * 1000 + turn AS listing_id",
        f"CASE (conv_id + turn) % 4 WHEN 0 THEN concat('Hier: ', {document}, ' fertig') "
        f"WHEN 1 THEN substr({document}, 1, length({document}) - 1) "
        f"WHEN 2 THEN concat({document}, ' und {{mehr}}') ELSE {document} END AS raw_output",
    )


def vehicle_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(row_pos, json)``: nested vehicle records with ragged keys."""
    return spread(table(spark, sf_dir, "events")).selectExpr(
        "event_id AS row_pos",
        "concat('{\"vin\": ', CASE WHEN event_id % 17 = 0 THEN 'null' WHEN event_id % 19 = 0 THEN '\"\"' "
        "ELSE concat('\"V', CAST(user_id AS STRING), '\"') END, "
        "', \"price\": ', CAST(CAST(floor(value * 100) AS BIGINT) AS STRING), "
        "', \"vehicle\": {\"make\": \"', event_type, '\", \"props\": ', props, '}', "
        "CASE WHEN event_id % 3 = 0 THEN '' WHEN event_id % 3 = 1 THEN concat(', \"history\": {\"ownerCount\": ', "
        "CAST(event_id % 4 AS STRING), ', \"accidentCount\": 1}') WHEN event_id % 2 = 0 THEN ', \"history\": null' "
        "ELSE ', \"history\": {\"ownerCount\": null, \"accidentCount\": 2}' END, "
        "', \"tags\": [\"ü\", \"', event_type, '\"], \"empty\": {}', "
        "CASE WHEN event_id % 5 = 0 THEN ', \"color\": \"blau\"' ELSE '' END, '}') AS json",
    )


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given web pages with a car advert placed at the head of each article."""
    n = "CAST(page_id AS STRING)"
    advert = (
        "concat('<article><div data-testid=\"prime-price\">', "
        "CASE WHEN page_id % 2 = 0 THEN concat(CAST(10 + page_id % 80 AS STRING), '.500 €') ELSE '' END, '</div>', "
        "'<p>ab 99 € mtl.</p><p>Preis ', CAST(10 + page_id % 80 AS STRING), '.900 € brutto</p>', "
        "'<ul><li>', CAST(1 + page_id % 200 AS STRING), CASE WHEN page_id % 5 = 0 THEN '.000 KM' ELSE '.000 km' END, '</li><li>', "
        "CASE page_id % 3 WHEN 0 THEN 'EZ 03/2015' WHEN 1 THEN 'Erstzulassung: 11/2019' ELSE 'seit 07/2012' END, "
        "'</li><li>110 kW (', CAST(90 + page_id % 100 AS STRING), '&nbsp;PS)</li><li>', "
        "CASE page_id % 3 WHEN 0 THEN 'Automatik' WHEN 1 THEN 'Schaltgetriebe' ELSE 'CVT' END, '</li><li>', "
        "CASE page_id % 4 WHEN 0 THEN 'Benzin' WHEN 1 THEN 'Diesel' WHEN 2 THEN 'Autogas (LPG)' ELSE 'Wasser' END, "
        "'</li><li>Fahrzeughalter: <b>', CAST(page_id % 5 AS STRING), '</b></li></ul>', "
        "'<div>DE-', lpad(CAST(page_id % 100000 AS STRING), 5, '0'), ' Bad Musterstadt | Karte</div>', "
        "'<h3>Ausstattung</h3><ul><li>ABS</li><li>Klima</li><li>x</li><li>ABS</li><li>Paket ', CAST(page_id % 9 AS STRING), "
        "'</li></ul><h3> Fahrzeugbeschreibung laut Anbieter </h3><p>Zustand &amp; mehr</p><p>Nr. ', "
        f"{n}, '</p><p>Zustand &amp; mehr</p><h3>Händler</h3>', "
        f"'<a href=\"/fahrzeuge/details.html?id=', CAST(page_id % 100 AS STRING), '&amp;ref=a', {n}, '\">1</a>', "
        f"'<a href=\"https://other.example.com/fahrzeuge/details.html?id=', {n}, '\">2</a>', "
        f"'<a href=\"/fahrzeuge/details.html\">3</a>')"
    )
    head = (
        "CASE WHEN page_id % 3 = 0 THEN concat('<head><meta property=\"og:title\" content=\"Marke Modell ', "
        f"{n}, ' für 12.345 € bei uns\">') ELSE '<head>' END"
    )
    return spread(table(spark, sf_dir, "pages")).selectExpr(
        "page_id", "url", f"replace(replace(html, '<head>', {head}), '<article>', {advert}) AS html"
    )

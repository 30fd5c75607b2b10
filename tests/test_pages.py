from __future__ import annotations

import time

from conftest import values

from lotwise.functions.html import read_page
from lotwise.operators import pages as P

FULL = """<!DOCTYPE html><html><head><meta property="og:title" content="BMW X5 für 12.345 € | Markt">
<title>BMW für 1 | x</title><script>var a = "1.000 km";</script></head><body>
<div data-testid="prime-price"> 45.900 € </div><h1>Kopf</h1>
<p>45.000 km</p><p>EZ 03/2020</p><p>110 kW (150 PS)</p><p>Automatik</p><p>Diesel</p><p>Fahrzeughalter: <b>2</b></p>
<p>DE-10115 Bad Homburg-Nord | Karte</p>
<div><h3>Ausstattung</h3></div><ul><li>ABS</li><li>Mehr anzeigen</li><li>ABS</li><li>x</li><li>Klima &amp; mehr</li></ul>
<h2>Fahrzeugbeschreibung laut Anbieter</h2><p>Schönes Auto<br>Top</p><p>Top</p><h2>Händler</h2><p>nicht dabei</p>
</body></html>"""


def page_rows(spark, *htmls):
    return spark.createDataFrame([(i, f"u{i}", h) for i, h in enumerate(htmls)], "page_id bigint, url string, html string")


def extract(spark, html):
    return P.extract_listings(page_rows(spark, html)).first().asDict()


def test_full_page(spark):
    assert extract(spark, FULL) == {
        "page_id": 0, "Titel": "BMW X5", "Preis": "45.900 €", "Kilometerstand": "45.000 km", "Erstzulassung": "EZ 03/2020",
        "PS": "150 PS", "Getriebe": "Automatik", "Kraftstoff": "Diesel", "Fahrzeughalter": "2",
        "Standort": "10115 Bad Homburg-Nord", "URL": "u0", "Ausstattung": "ABS, Klima & mehr",
        "Beschreibung": "Schönes Auto | Top"}


def test_empty_page(spark):
    row = extract(spark, "<html><body></body></html>")
    assert {v for k, v in row.items() if k not in ("page_id", "URL")} == {"N/A"}
    assert P.extract_listings(page_rows(spark, None)).count() == 0


def test_title_stages(spark):
    cases = {
        '<div data-testid="listing-title">A <b>B</b></div><h1>C</h1>': "A B", '<p id="ad-title">D</p><h1>C</h1>': "D",
        "<h1>C</h1>": "C", "<title>E für 3 | F</title>": "E", "<title>G | F</title><h1></h1>": "G",
        '<meta property="og:title" content=""><h1>C</h1>': "C",
    }
    for html, title in cases.items():
        assert extract(spark, html)["Titel"] == title, html


def test_price_texts(spark):
    assert extract(spark, "<p>ab 99 €</p><p>299 € mtl.</p><p>Nur 12.345 € heute</p>")["Preis"] == "12.345 €"
    assert extract(spark, "<p>12 €/Jahr</p>")["Preis"] == "N/A"


def test_field_fallbacks(spark):
    row = extract(spark, "<p>seit 07/2012, 13/2020</p><p>90 PS</p><p>schaltgetriebe</p><p>Autogas (LPG)</p><p>80331 München</p>")
    assert (row["Erstzulassung"], row["PS"], row["Getriebe"]) == ("07/2012", "90 PS", "Schaltgetriebe")
    assert (row["Kraftstoff"], row["Standort"]) == ("Autogas (LPG)", "80331 München")
    assert extract(spark, "<p>12345 Kilometer</p>")["Standort"] == "N/A"
    assert extract(spark, "<p>Elektro und Benzin</p>")["Kraftstoff"] == "Benzin"
    assert extract(spark, "<p>Automatikgetriebe</p>")["Getriebe"] == "N/A"


def test_sections_need_the_exact_heading(spark):
    assert extract(spark, "<h3>Ausstattung neu</h3><p>ABS</p>")["Ausstattung"] == "N/A"
    assert extract(spark, "<div>Ausstattung</div><p>ABS</p><h2>Preis</h2><p>Gurt</p>")["Ausstattung"] == "ABS"


def test_strings_skip_hidden_text():
    page = read_page("<p>a<br>b</p><script>c</script><style>d</style><!-- e --><p>f")
    assert page["page_text"] == "a b f" and page["strings"] == ["a", "b", "c", "d", " e ", "f"]


def test_links(spark):
    a = '<a href="/fahrzeuge/details.html?id=1&amp;ref=x">1</a><a href="/other">2</a><a>3</a>'
    b = '<a href="https://o.example.com/fahrzeuge/details.html?id=9">1</a><a href="/fahrzeuge/details.html?id=1&amp;ref=y">2</a>'
    rows = page_rows(spark, a, b)
    assert values(P.distinct_links(rows).orderBy("page_id", "pos"), "link") == [
        "https://suchen.mobile.de/fahrzeuge/details.html?id=1", "https://o.example.com/fahrzeuge/details.html?id=9"]
    assert values(P.distinct_links(rows, 1), "page_id") == [0]


def test_elements_that_stay_open_cost_no_more_than_others():
    """Items need no end tag; neither they nor end tags without a start make a long page slow."""
    pages = "<ul>" + "<li>a <b>b</b></i>" * 16_000, "<ul>" + "<li>a <b>b</b></li>" * 16_000
    start = time.perf_counter()
    parts = [read_page(p) for p in pages]
    assert time.perf_counter() - start < 4
    assert parts[0]["strings"] == parts[1]["strings"] and len(parts[0]["strings"]) == 32_000


def test_hidden_text_ends_with_its_element():
    page = read_page("<template>a<p>b</template>c<style>d</style>e")
    assert page["strings"] == ["a", "b", "c", "d", "e"] and page["page_text"] == "c e"

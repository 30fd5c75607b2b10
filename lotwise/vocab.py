"""Word lists, column lists, patterns, bounds and label tables that results depend on."""

from __future__ import annotations

# ---- text parsing (fixed values) ----
NUMBER = r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)\s*$"
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
TRUE_WORDS = ("true", "1", "yes", "y", "t")
FALSE_WORDS = ("false", "0", "no", "n", "f")
MISSING_WORDS = ("nan", "None", "")
UNKNOWN_TEXT = "unbekannt"
VIN_PATTERN = r"^[A-HJ-NPR-Z0-9]{11,17}$"

# ---- DE cleaning (fixed values) ----
DE_RENAMES = {
    "Preis": "price_eur",
    "Kilometerstand": "mileage_km",
    "Erstzulassung": "year",
    "PS": "power_ps",
    "Getriebe": "transmission",
    "Kraftstoff": "fuel",
    "Fahrzeughalter": "owners",
    "Standort": "location",
    "Titel": "title",
}
DE_RAW_COLUMNS = (
    "Titel", "Preis", "Kilometerstand", "Erstzulassung", "PS", "Getriebe",
    "Kraftstoff", "Fahrzeughalter", "Standort", "URL", "Ausstattung", "Beschreibung",
)
DE_TRANSMISSIONS = {"Automatik": "automatic", "Schaltgetriebe": "manual"}
DE_FUELS = {"Benzin": "petrol", "Diesel": "diesel", "Hybrid": "hybrid", "Elektro": "electric"}
DE_AGE_ANCHOR = "2026-01-01"
DE_IMPORT_COLUMNS = (
    "title", "price_eur", "mileage_km", "power_ps", "transmission", "fuel", "owners", "location",
    "url", "Ausstattung", "Beschreibung", "registration", "brand", "model", "car_age", "price_per_km",
)

# ---- US cleaning (fixed values) ----
US_RENAMES = {
    "@id": "id",
    "createdAt": "created_at",
    "location": "location",
    "online": "is_online",
    "vin": "vin_raw",
    "history_accidentCount": "accident_count",
    "history_accidents": "has_accidents",
    "history_oneOwner": "one_owner",
    "history_ownerCount": "owner_count",
    "history_personalUse": "personal_use",
    "history_usageType": "usage_type",
    "retailListing_carfaxUrl": "carfax_url",
    "retailListing_city": "city",
    "retailListing_cpo": "is_cpo",
    "retailListing_dealer": "dealer_name",
    "retailListing_miles": "mileage_mi",
    "retailListing_photoCount": "photo_count",
    "retailListing_price": "price_usd",
    "retailListing_primaryImage": "primary_image_url",
    "retailListing_state": "state",
    "retailListing_used": "is_used",
    "retailListing_vdp": "vdp_url",
    "retailListing_zip": "zip_code",
    "vehicle_baseInvoice": "base_invoice_usd",
    "vehicle_baseMsrp": "base_msrp_usd",
    "vehicle_bodyStyle": "body_style",
    "vehicle_confidence": "vehicle_confidence",
    "vehicle_cylinders": "cylinders",
    "vehicle_doors": "doors",
    "vehicle_drivetrain": "drivetrain",
    "vehicle_engine": "engine",
    "vehicle_exteriorColor": "exterior_color",
    "vehicle_fuel": "fuel",
    "vehicle_interiorColor": "interior_color",
    "vehicle_make": "make",
    "vehicle_model": "model",
    "vehicle_seats": "seats",
    "vehicle_series": "series",
    "vehicle_squishVin": "squish_vin",
    "vehicle_style": "style",
    "vehicle_transmission": "transmission",
    "vehicle_trim": "trim",
    "vehicle_type": "vehicle_type",
    "vehicle_vin": "vehicle_vin",
    "vehicle_year": "year",
    "wholesaleListing": "is_wholesale",
}
US_NUMERIC = (
    "accident_count", "owner_count", "mileage_mi", "photo_count", "price_usd", "base_invoice_usd",
    "base_msrp_usd", "vehicle_confidence", "cylinders", "doors", "seats", "year",
)
US_BOOLEAN = (
    "has_accidents", "one_owner", "personal_use", "is_online", "is_cpo", "is_used", "is_wholesale",
)
US_TEXT = (
    "usage_type", "city", "state", "zip_code", "dealer_name", "make", "model", "trim", "series",
    "body_style", "style", "drivetrain", "engine", "fuel", "transmission", "vehicle_type",
    "exterior_color", "interior_color", "vehicle_vin", "vin_raw", "squish_vin", "carfax_url",
    "vdp_url", "primary_image_url", "location",
)
US_LOWER = ("make", "model", "fuel", "transmission", "drivetrain", "body_style", "state")
US_REQUIRED = ("price_usd", "mileage_mi", "year", "make", "model")
US_DEDUP_KEYS = ("vin", "price_usd", "mileage_mi", "year")
US_KEEP = (
    "id", "created_at", "market", "source",
    "vin", "make", "model", "trim", "year", "body_style", "drivetrain", "engine", "cylinders",
    "doors", "seats", "fuel", "transmission", "exterior_color", "interior_color",
    "price_usd", "mileage_mi", "carfax_url", "vdp_url", "primary_image_url", "dealer_name", "city",
    "state", "zip_code", "is_used", "is_cpo", "is_online", "is_wholesale",
    "accident_count", "has_accidents", "owner_count", "one_owner", "personal_use", "usage_type",
    "car_age", "price_per_mile", "listing_age_days",
)

# ---- market defaults (fixed values) ----
MARKET_DEFAULTS = {
    "DE": {"source": "mobile", "currency": "EUR", "mileage_unit": "km", "symbol": "€"},
    "US": {"source": "auto.dev", "currency": "USD", "mileage_unit": "mi", "symbol": "$"},
}
VIEW_COLUMNS = ("brand", "model", "title", "price", "mileage", "location", "url")
ALL_TRIMS = "Alle"
DEFAULT_POWER_PS = 150
BRAND_MODELS = {
    "mercedes-benz": (
        "c-klasse", "e-klasse", "s-klasse", "a-klasse", "b-klasse", "cla", "cls", "glc", "gle",
        "gla", "glb", "gls", "eqe", "eqs", "eqa", "eqb", "eqc", "v-klasse", "g-klasse",
    ),
    "ford": ("f-150", "f-250", "f-350"),
    "lexus": ("nx",),
}

# ---- listing pages (fixed values) ----
LINK_HOST = "https://suchen.mobile.de"
LINK_PATTERN = r"/fahrzeuge/details\.html"
NOT_AVAILABLE = "N/A"
PRICE_TEXT = r"\d{1,3}(?:\.\d{3})*\s*€"
PRICE_STOP_WORDS = ("/jahr", "mtl", "monat", "ab ")
PAGE_FUELS = ("Benzin", "Diesel", "Elektro", "Hybrid", "Autogas (LPG)", "Erdgas (CNG)")
NO_PLACE_WORDS = ("Verfügbarkeit", "Kilometer", "Euro")
EQUIPMENT_HEADING = "Ausstattung"
EQUIPMENT_STOP = (
    "Fahrzeugbeschreibung laut Anbieter", "Fahrzeugstandort", "Über diesen Händler", "Standort", "Preis",
)
EQUIPMENT_SKIP = ("Ausstattung", "Mehr anzeigen", "Weniger anzeigen", "✓")
DESCRIPTION_HEADING = "Fahrzeugbeschreibung laut Anbieter"
DESCRIPTION_STOP = (
    "Über diesen Händler", "Standort", "Händler", "Preis", "Finanzierung", "Ähnliche Fahrzeuge",
)
DESCRIPTION_SKIP = ("Fahrzeugbeschreibung laut Anbieter", "Mehr anzeigen", "Weniger anzeigen")

# ---- document features (fixed values) ----
EQUIPMENT_WORDS = {
    "ausstattung_distronic": ("distronic", "acc", "abstandsregeltempomat"),
    "ausstattung_multibeam": ("multibeam", "ils", "matrix"),
    "ausstattung_klima_4_zonen": ("4-zonen", "4_zonen", "thermotronic", "klima hinten"),
    "ausstattung_klima_2_zonen": ("2-zonen", "2_zonen", "thermatic"),
    "ausstattung_burmester_3d": ("burmester 3d", "high-end", "highend", "3d-soundsystem"),
    "ausstattung_burmester_standard": ("burmester (standard)", "burmester standard", "surround"),
    "ausstattung_amg_line": ("amg line", "amg_line", "amg-line"),
    "ausstattung_pano": ("pano", "panorama", "schiebedach"),
}
NEGATIVE_VALUES = ("false", "0", "nein", "no", "none", "null", "")
INSPECTION_KEYS = ("tüv", "tuv", "hu/au", "hu")
INSPECTION_WORDS = ("neu", "gültig", "gemacht", "true", "1", "ja")
SERVICE_KEYS = ("scheckheft", "service")
SERVICE_WORDS = ("lückenlos", "scheckheft", "service a neu", "true", "1")
TYRE_KEYS = ("bereifung", "reifen")
ALL_WEATHER_KEYS = ("allwetter", "ganzjahres")
EIGHT_TYRE_WORDS = ("8-fach", "8 fach", "winter und sommer", "winter- und sommer")
ALL_WEATHER_WORDS = ("allwetter", "ganzjahres", "true")
WARRANTY_KEYS = ("garantie",)
ACCIDENT_KEYS = ("unfallfrei", "unfall")
ACCIDENT_WORDS = ("false", "0", "nein", "nachlackierung", "parkrempler", "unfallwagen")
ACCIDENT_FREE_WORDS = ("true", "1", "ja", "yes", "unfallfrei")
DEFECT_KEYS = ("mängel", "mangel")
NO_DEFECT_WORD = "keine"
NO_DEFECT_VALUES = ("", "none", "false", "0")
CONDITION_FEATURES = (
    "tuv_neu", "scheckheft_gepflegt", "bereifung_8_fach", "bereifung_allwetter", "garantie_monate",
    "unfallfrei", "mangel_vorhanden",
)
DOCUMENT_FEATURES = CONDITION_FEATURES + tuple(EQUIPMENT_WORDS)
MISSPELT_FEATURE = ("ausstattung_burmester_standart", "ausstattung_burmester_standard")

# ---- training (fixed values) ----
TARGET = "price"
CATEGORICAL = {
    "DE": ("brand", "model", "transmission", "fuel"),
    "US": (
        "brand", "model", "trim", "drivetrain", "fuel", "transmission", "body_style", "engine",
        "exterior_color", "interior_color", "usage_type",
    ),
}
IMPUTED = {
    "DE": ("power_ps", "owners"),
    "US": ("accident_count", "owner_count", "cylinders", "doors", "seats"),
}
US_TRAIN_NUMERIC = ("car_age", "accident_count", "owner_count", "cylinders", "doors", "seats")
US_TRAIN_FLAGS = (
    "one_owner", "has_accidents", "is_used", "is_cpo", "is_online", "is_wholesale", "personal_use",
)
US_EXCLUDED_BRAND = "mercedes"
GRIDS = {
    "DE": {"maxDepth": (4, 6, 8), "stepSize": (0.05, 0.1), "maxIter": (500, 1000)},
    "US": {"maxDepth": (4, 6, 8, 10), "stepSize": (0.05, 0.1), "maxIter": (500, 1000)},
}

#: ids of the listings whose descriptions are sent to a language model (fixed values, both included)
PROMPT_IDS = (100, 817)

# ---- scoring defaults (fixed values) ----
SCORE_DEFAULTS = {
    "DE": {
        "transmission": "automatic", "fuel": "benzin", "power_ps": 150.0, "owners": 1.0,
        "ausstattung_pano": 0.0, "ausstattung_amg_line": 0.0,
    },
    "US": {
        "transmission": "automatic", "fuel": "benzin", "cylinders": 6.0, "engine": "unbekannt",
        "has_accidents": 0.0, "is_cpo": 0.0, "doors": 4.0, "seats": 5.0, "trim": "unbekannt",
        "drivetrain": "unbekannt", "body_style": "unbekannt", "exterior_color": "unbekannt",
        "interior_color": "unbekannt", "usage_type": "unbekannt",
    },
}

# ---- recommendations (fixed values) ----
CONDITION_TOGGLES = ("tuv_neu", "unfallfrei", "mangel_vorhanden", "scheckheft_gepflegt")
EQUIPMENT_TOGGLES = (
    "bereifung_8_fach", "bereifung_allwetter", "ausstattung_distronic", "ausstattung_multibeam",
    "ausstattung_klima_4_zonen", "ausstattung_klima_2_zonen", "ausstattung_burmester_3d",
    "ausstattung_burmester_standard", "ausstattung_amg_line", "ausstattung_pano",
)
TOGGLE_MARGIN = 100.0
MILEAGE_STEPS = (10000, 20000, 50000)
MILEAGE_FROM = 20000
MILEAGE_LEFT = 5000
MILEAGE_MARGIN = 200.0
MODEL_LIMIT = 5
MODEL_MARGIN = 500.0
CYLINDERS_FROM = 4
CYLINDER_STEP = 2
CYLINDER_MARGIN = 300.0
RECOMMENDATION_LIMIT = 5
TOGGLE_LABELS = {
    "tuv_neu": "TÜV neu",
    "scheckheft_gepflegt": "Scheckheft gepflegt",
    "bereifung_8_fach": "8-fach Bereifung",
    "bereifung_allwetter": "Allwetterreifen",
    "unfallfrei": "Unfallfrei",
    "mangel_vorhanden": "Mängel vorhanden",
    "ausstattung_distronic": "Distronic",
    "ausstattung_multibeam": "Multibeam LED",
    "ausstattung_klima_4_zonen": "4-Zonen Klima",
    "ausstattung_klima_2_zonen": "2-Zonen Klima",
    "ausstattung_burmester_3d": "Burmester 3D",
    "ausstattung_burmester_standard": "Burmester Standard",
    "ausstattung_amg_line": "AMG Line",
    "ausstattung_pano": "Panoramadach",
}
SENTENCES = {
    "drop": "Wenn du auf '%s' verzichtest, sparst du ca. %s %s.",
    "offer": "Wenn du '%s' anbietest, nimmt der Preis um ca. %s %s zu.",
    "mileage_DE": (
        "Fahrzeuge mit %s km weniger Laufleistung kosten ca. %s € mehr — "
        "achte auf Angebote mit weniger Kilometern!"
    ),
    "mileage_US": "Fahrzeuge mit %s Meilen weniger kosten ca. $%s mehr — achte auf niedrigere Laufleistung!",
    "model_DE": "Ein '%s' mit gleicher Ausstattung würde ca. %s € weniger kosten.",
    "model_US": "Ein '%s' mit gleicher Ausstattung würde ca. $%s weniger kosten.",
    "cylinder_save": "Ein %s-Zylinder-Motor würde ca. $%s sparen.",
    "cylinder_gain": "Mit einem %s-Zylinder-Motor könnte der Preis um ca. $%s steigen.",
}

# ---- contribution labels (fixed values) ----
TRAINING_TOP = 15
SELLER_TOP = 10
FEATURE_LABELS = {
    "mileage": "Kilometerstand", "car_age": "Fahrzeugalter", "power_ps": "Leistung (PS)",
    "owners": "Vorbesitzer", "garantie_monate": "Garantie (Monate)", "cylinders": "Zylinder",
    "doors": "Türen", "seats": "Sitze", "accident_count": "Unfälle", "owner_count": "Vorbesitzer",
    "one_owner": "Erstbesitzer", "has_accidents": "Hat Unfälle", "is_used": "Gebraucht",
    "is_cpo": "Zertifiziert", "is_online": "Online-Kauf", "is_wholesale": "Großhandel",
    "personal_use": "Privatnutzung", "tuv_neu": "TÜV neu", "unfallfrei": "Unfallfrei",
    "mangel_vorhanden": "Mängel", "scheckheft_gepflegt": "Scheckheft",
    "ausstattung_pano": "Panoramadach", "ausstattung_amg_line": "AMG Line",
    "ausstattung_distronic": "Distronic", "ausstattung_multibeam": "Multibeam LED",
    "ausstattung_klima_4_zonen": "4-Zonen Klima", "ausstattung_klima_2_zonen": "2-Zonen Klima",
    "ausstattung_burmester_3d": "Burmester 3D", "ausstattung_burmester_standard": "Burmester Std.",
    "bereifung_8_fach": "8-fach Bereifung", "bereifung_allwetter": "Allwetterreifen",
    "price_per_km": "Preis/km", "price_per_mile": "Preis/Meile",
    "listing_age_days": "Inseratsalter (Tage)",
}
PREFIX_LABELS = {
    "brand_": "Marke", "model_": "Modell", "fuel_": "Kraftstoff", "transmission_": "Getriebe",
    "drivetrain_": "Antrieb", "body_style_": "Karosserie", "engine_": "Motor",
    "exterior_color_": "Außenfarbe", "interior_color_": "Innenfarbe", "usage_type_": "Nutzungsart",
    "trim_": "Ausstattungslinie",
}
US_FLAG_LABELS = {
    "has_accidents": "Unfälle", "one_owner": "Erster Hand", "is_online": "Online-Kauf",
    "is_used": "Gebrauchtwagen", "is_cpo": "CPO-Fahrzeug", "is_wholesale": "Wholesale-Angebot",
    "personal_use": "Private Nutzung",
}
NEGATIONS = {
    "Motor": "Kein", "Karosserie": "Keine", "Außenfarbe": "Keine", "Innenfarbe": "Keine",
    "Marke": "Keine", "Kraftstoff": "Kein", "Antrieb": "Kein", "Getriebe": "Kein",
    "Ausstattungslinie": "Keine", "Modell": "Kein", "Nutzungsart": "Keine",
}

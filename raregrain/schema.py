"""Column groups and fixed values shared by the library.

Columns are snake_case; ``RAW_NAMES`` maps the headers of the wide CSV export
to them.
"""

from __future__ import annotations

from pyspark.sql import types as T

SEED = 42
INNER_SEED = 123
TEST_SIZE = 0.20
N_FOLDS = 5
MAX_CATEGORIES = 10

# Headers of the wide export, in file groups.
ADMIN_HEADERS = [
    "Unnamed: 0", "Species", "Owner", "Owner.1", "Farm.Name", "Lot.Number", "Mill", "ICO.Number",
    "Company", "Producer", "In.Country.Partner", "Certification.Body", "Certification.Address",
    "Certification.Contact", "Grading.Date", "Expiration", "Altitude", "unit_of_measurement",
    "altitude_low_meters", "altitude_high_meters", "Bag.Weight", "Number.of.Bags", "Harvest.Year",
]
COMPONENT_HEADERS = [
    "Aroma", "Flavor", "Aftertaste", "Acidity", "Body", "Balance", "Uniformity", "Clean.Cup",
    "Sweetness", "Cupper.Points",
]

# Column roles of the cleaned table.
SCORE = "score"
LABEL = "label"
ROW_ID = "row_id"
GEO = ["country", "subregion"]
NUMERIC = ["moisture", "c1", "c2", "altitude"]
MOISTURE_FLAG = "moisture_missing"
NUMERIC_MODEL = [*NUMERIC, MOISTURE_FLAG]
NUMERIC_ENGINEERED = ["moisture", "altitude", MOISTURE_FLAG, "log_c1", "log_c2", "has_c1",
                      "log_altitude_moisture"]
CATEGORICAL = ["macro_area", "color", "processing", "variety"]
MODEL_INPUT = [*NUMERIC, *GEO, "variety", "processing", "color"]
UNKNOWN = "Unknown"
RARE = "Rare"

RAW_NAMES = {
    "Total.Cup.Points": SCORE, "Country.of.Origin": "country", "Region": "subregion",
    "Variety": "variety", "Processing.Method": "processing", "Color": "color",
    "Moisture": "moisture", "altitude_mean_meters": "altitude", "Quakers": "quakers",
    "Category.One.Defects": "c1", "Category.Two.Defects": "c2",
}

# Score cut-off, altitude range and bands, label maps, reference levels.
SCORE_CUT = 85.0
ALTITUDE_RANGE = (200.0, 3300.0)
BAND_EDGES = (1200.0, 1800.0)
PROCESSING_LABELS = {
    "Washed / Wet": "Washed",
    "Natural / Dry": "Natural",
    "Semi-washed / Semi-pulped": "Semi-washed",
    "Pulped natural / honey": "Honey",
    "Other": "Other",
}
COLOR_MERGE = {"bluish-green": "blue-green"}
REFERENCE_LEVELS = {
    "macro_area": "Central/North America", "color": "green", "processing": "Washed",
    "variety": "Caturra",
}

# Countries of each macro area.
MACRO_AREA_COUNTRIES = {
    "Central/North America": [
        "Guatemala", "United States", "United States (Puerto Rico)", "Costa Rica", "Mexico",
        "Honduras", "Panama", "El Salvador", "Nicaragua", "Haiti"],
    "South America": ["Brazil", "Colombia", "Ecuador", "Peru"],
    "Africa": [
        "Ethiopia", "Uganda", "Kenya", "Tanzania, United Republic Of", "Burundi", "Rwanda", "Malawi",
        "Zambia", "Mauritius", "Cote d?Ivoire"],
    "Mainland Asia": ["China", "India", "Laos", "Myanmar", "Vietnam", "Thailand"],
    "Maritime Asia/Pacific": [
        "Indonesia", "Japan", "Taiwan", "Papua New Guinea", "Philippines",
        "United States (Hawaii)"],
}

# Text tokens read as missing by the CSV source.
NULL_TOKENS = ["", "NaN", "nan", "NA", "N/A", "n/a", "#N/A", "null", "NULL", "None", "<NA>", "-NaN", "-nan"]


def snake(header: str) -> str:
    """snake_case name of a CSV header."""
    if header in RAW_NAMES:
        return RAW_NAMES[header]
    out = "".join(ch.lower() if ch.isalnum() else "_" for ch in header)
    out = "_".join(p for p in out.split("_") if p)
    # the free-text altitude must not clash with the numeric one
    return {"altitude": "altitude_text"}.get(out, out)


ADMIN = [snake(h) for h in ADMIN_HEADERS]
COMPONENTS = [snake(h) for h in COMPONENT_HEADERS]
_DOUBLES = {SCORE, "moisture", "altitude", "quakers", "altitude_low_meters", "altitude_high_meters",
            *COMPONENTS}
_INTS = {"c1", "c2"}


def raw_field(name: str) -> T.DataType:
    if name in _DOUBLES:
        return T.DoubleType()
    return T.IntegerType() if name in _INTS else T.StringType()

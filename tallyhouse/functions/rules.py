"""Business rules as data."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

# --- fixed values: results depend on these exact texts and numbers -----------
NULL_TOKENS = ("", "null", "NULL", "None", "none", "N/A", "n/a", "NA", "#N/A", "nan", "NaN")

# Texts a delimited file reader takes as missing while parsing.
CSV_NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

FILL_DEFAULTS = {
    "city": "Unknown",
    "category": "Uncategorised",
    "product_name": "Unknown Product",
    "name": "Unknown Customer",
}

CITY_ALIASES = {
    "El Cairo": "Cairo",
    "Al Cairo": "Cairo",
    "Al-Qahira": "Cairo",
    "Alex": "Alexandria",
    "El Giza": "Giza",
    "Al Giza": "Giza",
}

CATEGORY_ALIASES = {
    "Electronic": "Electronics",
    "Cloths": "Clothing",
    "Cloth": "Clothing",
    "Book": "Books",
    "Food & Bev": "Food",
}

# (name, lower bound inclusive, upper bound exclusive)
PRICE_BANDS = (
    ("Budget", 0, 500),
    ("Mid-Range", 500, 2000),
    ("Premium", 2000, 4000),
    ("Luxury", 4000, None),
)

EMAIL_PATTERN = r"^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+$"
DATE_SENTINEL = date(1900, 1, 1)

# (lifetime value, orders): reaching either is enough
HIGH_VALUE_FROM = (20000, 5)
REGULAR_FROM = (8000, 3)

HOME_COUNTRY = "Egypt"
HOME_REGION = "MENA"

# (key, city, governorate, latitude, longitude)
GEOGRAPHY_SEED = (
    (1, "Cairo", "Cairo Governorate", Decimal("30.0444"), Decimal("31.2357")),
    (2, "Giza", "Giza Governorate", Decimal("30.0131"), Decimal("31.2089")),
    (3, "Alexandria", "Alexandria Governorate", Decimal("31.2001"), Decimal("29.9187")),
    (4, "Mansoura", "Dakahlia Governorate", Decimal("31.0364"), Decimal("31.3807")),
    (5, "Tanta", "Gharbia Governorate", Decimal("30.7865"), Decimal("31.0004")),
)

# (key, channel, type)
CHANNEL_SEED = (
    (1, "Online Store", "Direct"),
    (2, "Mobile App", "Direct"),
    (3, "Email Campaign", "Direct"),
    (4, "Social Media", "Organic"),
    (5, "Search (SEO)", "Organic"),
    (6, "Paid Search", "Partner"),
    (7, "Unknown", "Unknown"),
)

DATE_KEY_RANGE = (20190101, 20311231)
CALENDAR_START = date(2019, 1, 1)
CALENDAR_END = date(2030, 12, 31)
RFM_AS_OF = date(2025, 3, 1)
ABC_CUTS = (70, 90)
DQ_GRADES = (("A", 90), ("B", 75), ("C", 60))
# --- end of fixed values -----------------------------------------------------

UNKNOWN_GEOGRAPHY_SK = 0
DEFAULT_CHANNEL_SK = 1
DATE_FORMATS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss")

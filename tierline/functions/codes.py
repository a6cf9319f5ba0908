"""Code maps used by the silver rules.

Fixed values: the source codes and the words they map to must equal the source system's cleaning
rules. Each map is applied to ``upper(trim(code))`` (country codes: ``trim(code)``); anything not
listed becomes ``UNKNOWN``.
"""

UNKNOWN = "n/a"

# Customer marital status, customer gender (CRM), product line, ERP gender,
# ERP country.
MARITAL_STATUS = {"S": "Single", "M": "Married"}
CRM_GENDER = {"F": "Female", "M": "Male"}
PRODUCT_LINE = {"M": "Mountain", "R": "Road", "S": "Other Sales", "T": "Touring"}
ERP_GENDER = {"F": "Female", "FEMALE": "Female", "M": "Male", "MALE": "Male"}
COUNTRY = {"DE": "Germany", "US": "United States", "USA": "United States"}

# Compares as the source system does: case-insensitive, blind to trailing spaces.
SOURCE_COLLATION = "UTF8_LCASE_RTRIM"

# Prefix stripped from ERP customer ids; separator removed from location ids;
# category id = first 5 characters of the product key with '-' -> '_'; product number starts at
# character 7; earliest plausible birth date.
ERP_ID_PREFIX = "NAS"
LOCATION_ID_SEPARATOR = "-"
CATEGORY_ID_LENGTH = 5
PRODUCT_NUMBER_START = 7
MIN_BIRTH_DATE = "1924-01-01"
INT_DATE_MIN = 19000101
INT_DATE_MAX = 20500101

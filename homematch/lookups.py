"""Value tables shared by the column functions."""

# Patterns that find amounts, sizes and energy ratings in texts.
AMOUNT_PATTERN = r"([\d,]+(?:\.\d+)?)"
SIZE_PATTERN = rf"(?i){AMOUNT_PATTERN}\s*(sq\s*ft|sq\s*m)"
BOTH_SIZES_PATTERN = rf"(?i){AMOUNT_PATTERN}\s*sq\s*ft\s*/\s*{AMOUNT_PATTERN}\s*sq\s*m"
SQUARE_FEET_PATTERN = r"(\d+(?:\.\d+)?)\s*sq\s*ft"
RATING_PATTERN = r"\b([A-G])\b"

# Registry property-type codes and their class.
REGISTRY_TYPES = {
    "D": "Detached",
    "S": "Semi-Detached",
    "T": "Terraced",
    "F": "Flat/Maisonette",
    "O": "Other",
}

# Property types used by listings and their class.
LISTING_TYPES = {
    "Apartment": "Flat/Maisonette",
    "Barn": "Other",
    "Barn conversion": "Other",
    "Block of apartments": "Flat/Maisonette",
    "Bungalow": "Detached",
    "Chalet": "Other",
    "Character property": "Other",
    "Cluster house": "Other",
    "Coach house": "Flat/Maisonette",
    "Cottage": "Detached",
    "Detached bungalow": "Detached",
    "Detached house": "Detached",
    "Duplex": "Flat/Maisonette",
    "End of terrace house": "Terraced",
    "Equestrian property": "Other",
    "Farm house": "Other",
    "Flat": "Flat/Maisonette",
    "Ground floor flat": "Flat/Maisonette",
    "Ground floor maisonette": "Flat/Maisonette",
    "House": "Detached",
    "Houseboat": "Other",
    "Link detached house": "Detached",
    "Lodge": "Other",
    "Log cabin": "Other",
    "Maisonette": "Flat/Maisonette",
    "Mews": "Other",
    "Penthouse": "Flat/Maisonette",
    "Semi-detached bungalow": "Semi-Detached",
    "Semi-detached house": "Semi-Detached",
    "Studio": "Flat/Maisonette",
    "Terraced house": "Terraced",
    "Townhouse": "Terraced",
}

# Listing property types and the registry code written for them.
LISTING_TO_REGISTRY = {
    "Apartment": "F",
    "Barn conversion": "O",
    "Block of apartments": "F",
    "Bungalow": "D",
    "Character property": "O",
    "Cluster house": "O",
    "Coach house": "F",
    "Cottage": "D",
    "Detached bungalow": "D",
    "Detached house": "D",
    "Duplex": "F",
    "End of terrace house": "T",
    "Equestrian property": "O",
    "Farm house": "O",
    "Flat": "F",
    "Ground floor flat": "F",
    "Ground floor maisonette": "F",
    "House": "D",
    "Link detached house": "D",
    "Lodge": "O",
    "Maisonette": "F",
    "Mews": "O",
    "Penthouse": "F",
    "Semi-detached bungalow": "D",
    "Semi-detached house": "S",
    "Studio": "F",
    "Terraced house": "T",
    "Townhouse": "D",
}

# Registry districts and the shire they belong to.
DISTRICT_SHIRES = {
    "VALE OF WHITE HORSE": "oxfordshire",
    "BEDFORD": "bedfordshire",
    "HERTSMERE": "hertfordshire",
    "NORTH HERTFORDSHIRE": "hertfordshire",
    "CHERWELL": "oxfordshire",
    "THREE RIVERS": "hertfordshire",
    "DACORUM": "hertfordshire",
    "ST ALBANS": "hertfordshire",
    "WATFORD": "hertfordshire",
    "EAST HERTFORDSHIRE": "hertfordshire",
    "WEST BERKSHIRE": "berkshire",
    "BROXBOURNE": "hertfordshire",
    "OXFORD": "oxfordshire",
    "STEVENAGE": "hertfordshire",
    "WEST NORTHAMPTONSHIRE": "northamptonshire",
    "WEST OXFORDSHIRE": "oxfordshire",
    "WELWYN HATFIELD": "hertfordshire",
    "NORTH NORTHAMPTONSHIRE": "northamptonshire",
    "SOUTH OXFORDSHIRE": "oxfordshire",
    "BUCKINGHAMSHIRE": "buckinghamshire",
}

# Town centres per shire as (name, latitude, longitude).
TOWN_CENTRES = {
    "buckinghamshire": [
        ("High Wycombe", 51.6285, -0.7489),
        ("Aylesbury", 51.8156, -0.8125),
        ("Milton Keynes", 52.0406, -0.7594),
        ("Amersham", 51.6746, -0.6076),
    ],
    "bedfordshire": [("Luton", 51.8787, -0.4200), ("Bedford", 52.1364, -0.4668)],
    "hertfordshire": [("Watford", 51.6565, -0.3903), ("St Albans", 51.7517, -0.3411)],
    "oxfordshire": [("Oxford", 51.7520, -1.2577), ("Banbury", 52.0602, -1.3403)],
    "berkshire": [("Reading", 51.4543, -0.9781), ("Slough", 51.5105, -0.5950)],
    "northamptonshire": [("Northampton", 52.2405, -0.9027), ("Kettering", 52.3981, -0.7271)],
}

# Listing age labels and the days they stand for.
LISTING_AGE_DAYS = {
    "Added today": 0,
    "Added yesterday": 1,
    "Added < 7 days": 3,
    "Added < 14 days": 10,
    "Added > 14 days": 30,
    "Reduced today": 7,
    "Reduced yesterday": 8,
    "Reduced < 7 days": 10,
    "Reduced < 14 days": 17,
}
UNKNOWN_LISTING_AGE_DAYS = 60

# Recency classes as (days above, days up to, label).
RECENCY_CLASSES = [
    (0, 1, "Today"),
    (1, 7, "Last Week"),
    (7, 14, "Last 2 Weeks"),
    (14, 30, "Last Month"),
    (30, 60, "Last 2 Months"),
    (60, None, "Older"),
]

# Ordinal codes.
EPC_CODES = {"G": 1, "F": 2, "E": 3, "D": 4, "C": 5, "B": 6, "A": 7}
TENURE_CODES = {"Freehold": 0, "Leasehold": 1}
TENURE_OTHER = 2
PREFERENCE_CODES = {"FREEHOLD": 0, "LEASEHOLD": 1, "NO PREFERENCE": 2}

# Classes with a column each.
PROPERTY_CLASSES = ["Detached", "Semi-Detached", "Terraced", "Flat/Maisonette", "Other"]
LOCATION_CLASSES = ["Urban", "Suburban", "Rural"]
SHIRES = [
    "buckinghamshire",
    "bedfordshire",
    "hertfordshire",
    "oxfordshire",
    "berkshire",
    "northamptonshire",
]

# Shires kept by the registry cleanse.
CLEANSE_TARGETS = [
    "Buckinghamshire",
    "Bedford",
    "Oxfordshire",
    "North Northamptonshire",
    "West Northamptonshire",
    "Hertfordshire",
    "West Berkshire",
]

# Texts that stand for a missing value.
SIZE_MISSING = "Size info not available"
SQ_FT_PER_SQ_M = 10.7639

# What a synthetic buyer can choose from.
BUYER_LOCATIONS = ["Urban", "Suburban", "Rural"]
BUYER_TYPES = ["Apartment", "House", "Condo"]
BUYER_MUST_HAVES = ["Garden", "Parking", "Swimming Pool", "Gym", "None"]
BUYER_NICE_TO_HAVES = ["Balcony", "Fireplace", "Walk-in Closet", "None"]
BUYER_TENURES = ["Freehold", "Leasehold", "No Preference"]


def type_column(name: str) -> str:
    """Column that flags a property class."""
    return "property_type_" + name.replace("-", "_").replace("/", "_")

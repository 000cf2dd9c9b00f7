"""Text cleaning and coding as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from homematch import lookups

_NUMBER = r"^[+-]?(\d+|(\d+\.\d*|\.\d+)([eE][+-]?\d+)?)$"


def lookup(key: Column, table: dict[str, object]) -> Column:
    """Value of a small fixed table, null where the key is absent."""
    entries = [F.lit(part) for item in table.items() for part in item]
    return F.try_element_at(F.create_map(*entries), key)


def _once(value: Column, build: Callable[[Column], Column]) -> Column:
    """Expression over a costly value that is evaluated a single time."""
    return F.get(F.transform(F.array(value), build), F.lit(0))


def price_number(price: Column) -> Column:
    """Amount in a price text; null for texts that hold no plain number."""
    bare = F.trim(F.translate(price, "£,€", ""))
    return F.when(bare.rlike(_NUMBER), bare.try_cast("double"))


def epc_letter(rating: Column) -> Column:
    """First letter A to G that stands alone, upper case."""
    return F.upper(F.nullif(F.regexp_extract(rating, f"(?iU){lookups.RATING_PATTERN}", 1), F.lit("")))


def first_number(text: Column) -> Column:
    """First run of digits."""
    return F.regexp_extract(text, r"(\d+)", 1).try_cast("bigint")


def _amount(text: Column, pattern: str, group: int) -> Column:
    return F.replace(F.regexp_extract(text, pattern, group), F.lit(","), F.lit("")).try_cast("double")


def size_text(size: Column) -> Column:
    """Size written as ``N sq ft / M sq m``; other texts are kept.

    A unit written without a blank (``1000sqft``) is read as square metres.
    """
    both, single = lookups.BOTH_SIZES_PATTERN, lookups.SIZE_PATTERN
    rate = F.lit(lookups.SQ_FT_PER_SQ_M)

    def parts(text: Column) -> Column:
        value = _amount(text, single, 1)
        in_feet = F.lower(F.regexp_extract(text, single, 2)) == "sq ft"
        has_both = text.rlike(both)
        feet = F.when(has_both, _amount(text, both, 1)).when(in_feet, value).otherwise(value * rate)
        metres = F.when(has_both, _amount(text, both, 2)).when(in_feet, value / rate).otherwise(value)
        return F.struct(text.alias("text"), feet.alias("feet"), metres.alias("metres"))

    def written(part: Column) -> Column:
        feet, metres = part["feet"], part["metres"]
        larger = F.when(metres > feet, metres * rate).otherwise(feet)
        result = F.concat(
            F.rint(larger).cast("bigint").cast("string"), F.lit(" sq ft / "),
            F.rint(metres).cast("bigint").cast("string"), F.lit(" sq m"),
        )
        return F.coalesce(result, part["text"])

    return _once(_once(F.trim(F.regexp_replace(size, r"\s+", " ")), parts), written)


def square_feet(size: Column) -> Column:
    """Square feet in a size text (no thousands separators, lower case only)."""
    return F.regexp_extract(size, lookups.SQUARE_FEET_PATTERN, 1).try_cast("double")


def address_key(address: Column, word_bounded: bool = False) -> Column:
    """Address cleaned for lookup.

    Repeated fragments collapse even inside words; ``word_bounded`` limits that
    to whole words. A fragment always ends its word, so the pattern never gives
    a character back.
    """
    repeat = r"(?U)\b(\w++)\s++\1\b" if word_bounded else r"(?U)(\w++)\s++\1"
    text = F.regexp_replace(address, r"(?U)[^\w\s,]", "")
    text = F.trim(F.regexp_replace(text, r"(?U)\s+", " "))
    text = F.regexp_replace(text, ",+", ",")
    text = F.regexp_replace(text, repeat, "$1")
    text = F.regexp_replace(text, r"(?U),(?=\S)", ", ")
    return _once(text, lambda t: F.trim(F.regexp_replace(
        F.when(F.lower(t).rlike("(uk|united kingdom)$"), t).otherwise(F.concat(t, F.lit(", UK"))), r"(?U)\s+", " ")))


def with_shire(address: Column, shire: str = "Buckinghamshire") -> Column:
    """Listing address that names its shire."""
    return F.trim(F.when(F.contains(address, F.lit(shire)), address).otherwise(F.concat(address, F.lit(f", {shire}"))))


def joined_address(*parts: Column) -> Column:
    """Non-empty address parts joined by a comma and a blank."""
    return F.concat_ws(", ", *[F.nullif(part, F.lit("")) for part in parts])


def cleansed_county(county: Column) -> Column:
    """Upper-case county without a leading NORTH or WEST."""
    return F.regexp_replace(F.upper(county), "^(NORTH|WEST) ", "")


def shire(county: Column) -> Column:
    """Shire of a district or county; unknown names in lower case."""
    return F.coalesce(lookup(F.upper(county), lookups.DISTRICT_SHIRES), F.lower(county))


def property_class(kind: Column) -> Column:
    """Class of a registry code or listing type; anything else is Other."""
    return F.coalesce(lookup(kind, {**lookups.REGISTRY_TYPES, **lookups.LISTING_TYPES}), F.lit("Other"))


def registry_code(kind: Column) -> Column:
    """Registry code of a listing type, null when it has none."""
    return lookup(kind, lookups.LISTING_TO_REGISTRY)


def tenure_of(features: Column) -> Column:
    """Tenure named by the first feature that decides it, else Unknown."""

    def decide(feature: Column) -> Column:
        text = F.lower(F.split_part(feature, F.lit(":"), F.lit(2)))
        return F.when(
            F.lower(feature).startswith("tenure:"),
            F.when(text.contains("freehold"), "Freehold").when(text.contains("leasehold"), "Leasehold"),
        )

    decided = F.filter(F.transform(features, decide), lambda tenure: tenure.isNotNull())
    return F.coalesce(F.try_element_at(decided, F.lit(1)), F.lit("Unknown"))


def code_label(code: Column, labels: dict[str, str]) -> Column:
    """Label of a code; values that are no code stay as they are."""
    return F.coalesce(lookup(code, labels), code)


def preference_code(preference: Column) -> Column:
    """Tenure preference label as 0, 1 or 2; missing or unknown is 2."""
    return F.coalesce(lookup(F.upper(preference), lookups.PREFERENCE_CODES), F.lit(2))


def preference_number(preference: Column) -> Column:
    """Tenure preference already given as a number; missing is 2."""
    return F.coalesce(preference.cast("int"), F.lit(2))


def resolved_tenure(duration: Column, listing_tenure: Column) -> Column:
    """Tenure from the registry duration, else from the listing, else Unknown."""
    return (
        F.when(duration == "F", "Freehold")
        .when(duration == "L", "Leasehold")
        .otherwise(F.coalesce(listing_tenure, F.lit("Unknown")))
    )


def tenure_code(tenure: Column) -> Column:
    """Freehold 0, Leasehold 1, anything else 2."""
    return F.coalesce(lookup(tenure, lookups.TENURE_CODES), F.lit(lookups.TENURE_OTHER))


def size_or_null(size: Column) -> Column:
    """Size without the text that stands for a missing one."""
    return F.nullif(size, F.lit(lookups.SIZE_MISSING))


def epc_code(letter: Column) -> Column:
    """G 1 up to A 7, anything else 0."""
    return F.coalesce(lookup(letter, lookups.EPC_CODES), F.lit(0))


def price_label(price: Column) -> Column:
    """Price for display."""
    return F.concat(F.lit("£"), F.format_number(price, 0))


def flag_label(labels: dict[str, str]) -> Column:
    """Label of the first flag column that is set, given as column to label."""
    return F.coalesce(*[F.when(F.col(column).cast("int") == 1, label) for column, label in labels.items()])


def amenity_label(garden: Column, parking: Column) -> Column:
    """Amenities for display."""
    return F.concat_ws(
        ", ",
        F.when(garden.cast("int") == 1, "Garden"),
        F.when(parking.cast("int") == 1, "Parking"),
    )


def absolute_url(base: str, link: Column, prefix: str = "/details/") -> Column:
    """Absolute address of a link under ``prefix``; null for other links."""
    return F.when(link.startswith(prefix), F.concat(F.lit(base), link))

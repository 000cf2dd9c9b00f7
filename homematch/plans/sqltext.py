"""SQL of the checks: scalar rules and the tables built from the views."""

from __future__ import annotations

from homematch import lookups
from homematch.lookups import PROPERTY_CLASSES, SHIRES, TOWN_CENTRES, type_column
from homematch.plans.views import AS_OF, VIEWS, view_sql
from homematch.schemas import LOCATION_FLAGS, TYPE_FLAGS


def case_of(value: str, table: dict[str, object], default: str = "NULL") -> str:
    def literal(v: object) -> str:
        return f"'{v}'" if isinstance(v, str) else str(v)

    return f"CASE {value} " + " ".join(f"WHEN '{k}' THEN {literal(v)}" for k, v in table.items()) + f" ELSE {default} END"


def price(c: str) -> str:
    bare = f"trim(replace(replace(replace({c}, '£', ''), ',', ''), '€', ''))"
    return rf"CASE WHEN regexp_full_match({bare}, '[+-]?(\d+|(\d+\.\d*|\.\d+)([eE][+-]?\d+)?)') THEN TRY_CAST({bare} AS DOUBLE) END"


def epc(c: str) -> str:
    return f"upper(nullif(regexp_extract({c}, '(?i){lookups.RATING_PATTERN}', 1), ''))"


def number(c: str) -> str:
    return rf"TRY_CAST(nullif(regexp_extract({c}, '\d+'), '') AS BIGINT)"


def size(c: str) -> str:
    t = rf"trim(regexp_replace({c}, '\s+', ' ', 'g'))"
    both, one = f"'{lookups.BOTH_SIZES_PATTERN}'", f"'{lookups.SIZE_PATTERN}'"
    rate = "CAST(10.7639 AS DOUBLE)"

    def num(pattern: str, group: int) -> str:
        return f"TRY_CAST(replace(regexp_extract({t}, {pattern}, {group}), ',', '') AS DOUBLE)"

    feet_unit = f"lower(regexp_extract({t}, {one}, 2)) = 'sq ft'"
    feet = f"CASE WHEN regexp_matches({t}, {both}) THEN {num(both, 1)} WHEN {feet_unit} THEN {num(one, 1)} ELSE {num(one, 1)} * {rate} END"
    metres = f"CASE WHEN regexp_matches({t}, {both}) THEN {num(both, 2)} WHEN {feet_unit} THEN {num(one, 1)} / {rate} ELSE {num(one, 1)} END"
    feet = f"CASE WHEN ({metres}) > ({feet}) THEN ({metres}) * {rate} ELSE ({feet}) END"

    def text(value: str) -> str:
        return f"CAST(CAST(round_even({value}, 0) AS BIGINT) AS VARCHAR)"

    return f"CASE WHEN regexp_matches({t}, {one}) THEN {text(feet)} || ' sq ft / ' || {text(metres)} || ' sq m' ELSE {t} END"


def square_feet(c: str) -> str:
    return f"TRY_CAST(nullif(regexp_extract({c}, '{lookups.SQUARE_FEET_PATTERN}', 1), '') AS DOUBLE)"


def tenure(features: str) -> str:
    text = "lower(split_part(f, ':', 2))"
    decided = (f"list_transform({features}, lambda f: CASE WHEN starts_with(lower(f), 'tenure:') THEN CASE WHEN contains({text}, 'freehold') "
               f"THEN 'Freehold' WHEN contains({text}, 'leasehold') THEN 'Leasehold' END END)")
    return f"coalesce(list_filter({decided}, lambda d: d IS NOT NULL)[1], 'Unknown')"


def shire(c: str) -> str:
    return f"coalesce({case_of(f'upper({c})', lookups.DISTRICT_SHIRES)}, lower({c}))"


def property_class(c: str) -> str:
    return case_of(c, {**lookups.REGISTRY_TYPES, **lookups.LISTING_TYPES}, "'Other'")


def preference(c: str) -> str:
    return case_of(f"upper({c})", lookups.PREFERENCE_CODES, "2")


def listing_day(c: str) -> str:
    return f"CAST(DATE '{AS_OF}' - CAST({case_of(c, lookups.LISTING_AGE_DAYS, str(lookups.UNKNOWN_LISTING_AGE_DAYS))} AS INTEGER) AS DATE)"


def tenure_code(c: str) -> str:
    return case_of(c, lookups.TENURE_CODES, str(lookups.TENURE_OTHER))


def mentions(features: str, word: str) -> str:
    return f"CASE WHEN len(list_filter({features}, lambda f: contains(lower(f), '{word}'))) > 0 THEN 1 ELSE 0 END"


def centre_distance(lat: str, lon: str, county: str) -> str:
    def gap(a: float, b: float) -> str:
        return f"sqrt(pow(CAST({a} AS DOUBLE) - {lat}, 2) + pow(CAST({b} AS DOUBLE) - {lon}, 2))"

    cases = " ".join(f"WHEN '{s}' THEN least({', '.join(gap(a, b) for _, a, b in c)})" for s, c in TOWN_CENTRES.items())
    return f"CASE WHEN {lat} IS NOT NULL AND {lon} IS NOT NULL THEN CASE lower({county}) {cases} END END"


def location_class(distance: str) -> str:
    return f"CASE WHEN {distance} < 0.05 THEN 'Urban' WHEN {distance} < 0.1 THEN 'Suburban' WHEN {distance} >= 0.1 THEN 'Rural' END"


def recency(days: str) -> str:
    parts = []
    for above, up_to, label in lookups.RECENCY_CLASSES:
        upper = f" AND {days} <= {up_to}" if up_to is not None else ""
        parts.append(f"WHEN {days} > {above}{upper} THEN '{label}'")
    return "CASE " + " ".join(parts) + " END"


def flags_label(flags: list[str], prefix: str) -> str:
    return "CASE " + " ".join(f"WHEN {f} = 1 THEN '{f.removeprefix(prefix)}'" for f in flags) + " END"


MARKET_FLAGS = {
    "county": ([f"county_{s}" for s in SHIRES], "county_"),
    "location": (LOCATION_FLAGS, "location_"),
    "kind": (TYPE_FLAGS, "property_type_"),
}

MERGED_ID = "coalesce(CAST(substr(historical_id, 2, 20) AS BIGINT) * 2, listing_id * 2 + 1)"


def mode_of(column: str, table: str) -> str:
    """Most frequent value as text, the smallest on ties."""
    return f"(SELECT CAST({column} AS VARCHAR) FROM {table} WHERE {column} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"


_NUMBERS = ["price", "bedrooms", "bathrooms", "latitude", "longitude"]
_TEXTS = ["postal_code", "property_type", "property_age", "tenure", "epc_rating", "data_source", "listing_time", "county"]
_CALENDAR = {"year": "year(\"date\")", "month": "month(\"date\")", "day_of_week": "isodow(\"date\") - 1"}
_PLACE = centre_distance("latitude", "longitude", "county")
_DATED = f"datediff('day', \"date\", DATE '{AS_OF}')"

_KINDS = ", ".join("'" + type_column(c).removeprefix("property_type_") + "'" for c in PROPERTY_CLASSES)
_SHIRES = ", ".join(f"'{s}'" for s in SHIRES)

# Tables built from the views, in order of need: name to (what it reads, SELECT).
DERIVED: dict[str, tuple[list[str], str]] = {
    "listing": (["listing_raw"], f"""
        SELECT id, property_url, title, address, {price('price')} AS price, pricing_qualifier, listing_time, property_type,
               bedrooms, bathrooms, epc_rating, size, features, latitude, longitude, {tenure('features')} AS tenure, county
        FROM listing_raw WHERE {price('price')} IS NOT NULL"""),
    "first_listing": (["listing"], """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY address ORDER BY id) AS rn FROM listing) WHERE rn = 1"""),
    "merged": (["registry", "first_listing", "listing"], f"""
        SELECT h.id AS historical_id, l.id AS listing_id, coalesce(nullif(CAST(h.price AS DOUBLE), 0), l.price) AS price,
               h.postal_code, {property_class('coalesce(h.property_type, l.property_type)')} AS property_type,
               h.date_of_transaction AS "date", h.property_age,
               CASE h.duration WHEN 'F' THEN 'Freehold' WHEN 'L' THEN 'Leasehold' ELSE coalesce(l.tenure, 'Unknown') END AS tenure,
               {number('l.bedrooms')} AS bedrooms, {number('l.bathrooms')} AS bathrooms, {epc('l.epc_rating')} AS epc_rating,
               {size('l.size')} AS size, l.features, CASE WHEN l.id IS NULL THEN 'historical' ELSE 'both' END AS data_source,
               l.listing_time, l.latitude, l.longitude,
               {shire('CASE WHEN l.id IS NULL THEN h.district ELSE l.county END')} AS county
        FROM registry h LEFT JOIN first_listing l ON h.postal_code = l.address
        UNION ALL
        SELECT NULL, l.id, l.price, l.address, {property_class('l.property_type')}, {listing_day('l.listing_time')}, NULL,
               coalesce(l.tenure, 'Unknown'), {number('l.bedrooms')}, {number('l.bathrooms')}, {epc('l.epc_rating')},
               {size('l.size')}, l.features, 'listing', l.listing_time, l.latitude, l.longitude, {shire('l.county')}
        FROM listing l LEFT JOIN (SELECT DISTINCT f.id FROM first_listing f JOIN registry h ON h.postal_code = f.address) t ON l.id = t.id
        WHERE t.id IS NULL"""),
    "handled": (["merged"], f"""
        WITH f AS (SELECT {MERGED_ID} AS id, {', '.join(f"coalesce(CAST({c} AS DOUBLE), (SELECT median({c}) FROM merged)) AS {c}" for c in _NUMBERS)},
                          {', '.join(f"coalesce({c}, {mode_of(c, 'merged')}, 'Unknown') AS {c}" for c in _TEXTS)},
                          coalesce("date", CAST({mode_of('"date"', 'merged')} AS DATE)) AS "date",
                          nullif(size, 'Size info not available') AS size, coalesce(features, []) AS features, {square_feet("nullif(size, 'Size info not available')")} AS v FROM merged),
        e1 AS (SELECT f.*, coalesce(f.v, g.m) AS v1 FROM f LEFT JOIN (SELECT property_type, bedrooms, median(v) AS m FROM f GROUP BY 1, 2) g
               ON g.property_type = f.property_type AND g.bedrooms = f.bedrooms),
        e2 AS (SELECT e1.*, coalesce(e1.v1, g.m) AS v2 FROM e1 LEFT JOIN (SELECT property_type, median(v1) AS m FROM e1 GROUP BY 1) g ON g.property_type = e1.property_type)
        SELECT * EXCLUDE (v, v1, v2), coalesce(v2, (SELECT median(v2) FROM e2)) AS size_sq_ft FROM e2"""),
    "engineered": (["handled"], f"""
        SELECT * REPLACE (coalesce(epc_rating, 'Unknown') AS epc_rating), {', '.join(f'CAST({e} AS BIGINT) AS "{n}"' for n, e in _CALENDAR.items())},
               {_DATED} AS days_since_date, {recency(_DATED)} AS listing_recency,
               {case_of('epc_rating', lookups.EPC_CODES, '0')} AS epc_rating_encoded,
               {mentions('features', 'garden')} AS has_garden, {mentions('features', 'parking')} AS has_parking,
               {', '.join(f"CASE WHEN {location_class(_PLACE)} = '{n}' THEN 1 ELSE 0 END AS location_{n}" for n in lookups.LOCATION_CLASSES)},
               {', '.join(f"CASE WHEN county = '{n}' THEN 1 ELSE 0 END AS county_{n}" for n in SHIRES)},
               price / nullif(avg(price) OVER (PARTITION BY county), 0) AS price_relative_to_county_avg FROM handled"""),
    "processed": (["engineered", "users"], f"""
        WITH m AS (SELECT avg(income) AS i, avg(savings) AS s FROM users)
        SELECT e.* REPLACE (CAST({tenure_code('e.tenure')} AS INTEGER) AS tenure,
                            {', '.join(f'(e."{c}" - avg(e."{c}") OVER ()) / nullif(stddev_pop(e."{c}") OVER (), 0) AS "{c}"' for c in _CALENDAR)}),
               {', '.join(f"CASE WHEN property_type = '{n}' THEN 1 ELSE 0 END AS {type_column(n)}" for n in PROPERTY_CLASSES)},
               price / m.i AS price_to_income_ratio, price / m.s AS price_to_savings_ratio, (m.i * 4 + m.s) / nullif(price, 0) AS affordability_score
        FROM engineered e, m"""),
    "listing_loaded": (["listing"], f"""
        SELECT * REPLACE (row_number() OVER (ORDER BY md5('0:' || property_url), property_url) AS id, CAST(NULL AS DOUBLE) AS latitude,
                          CAST(NULL AS DOUBLE) AS longitude, CASE WHEN county = lower(county) THEN county ELSE 'berkshire' END AS county) FROM listing"""),
    "asked": (["profiles"], f"""
        SELECT *, CASE WHEN lower(preferred_county) IN ({_SHIRES}) THEN lower(preferred_county) ELSE '*' END AS m_county,
               CASE WHEN preferred_location IN ('Urban', 'Suburban', 'Rural') THEN preferred_location ELSE '*' END AS m_location,
               CASE WHEN desired_property_type IN ({_KINDS}) THEN desired_property_type ELSE '*' END AS m_kind,
               CASE WHEN list_contains(must_have_features, 'Garden') THEN 1 ELSE 0 END AS m_garden,
               CASE WHEN list_contains(must_have_features, 'Parking') THEN 1 ELSE 0 END AS m_parking,
               income * 4 + savings AS budget FROM profiles"""),
    "offers": (["props"], f"""
        SELECT *, {', '.join(f"{flags_label(*spec)} AS m_{n}" for n, spec in MARKET_FLAGS.items())} FROM props"""),
    "eligible": (["asked", "offers"], """
        SELECT a.id AS user_id, a.profile_score, o.id AS property_id, o.price, o.property_score, o.size_sq_ft
        FROM asked a JOIN offers o ON o.price <= a.budget AND (a.m_county = '*' OR a.m_county = o.m_county)
         AND (a.m_location = '*' OR a.m_location = o.m_location) AND (a.m_kind = '*' OR a.m_kind = o.m_kind)
         AND o.has_garden >= a.m_garden AND o.has_parking >= a.m_parking"""),
    "ranked_pool": (["props"], """
        SELECT pool, property_id, row_number() OVER (PARTITION BY pool ORDER BY md5('42:' || CAST(property_id AS VARCHAR)), property_id) - 1 AS rnk,
               count(*) OVER (PARTITION BY pool) AS n
        FROM (SELECT 2 AS pool, id AS property_id FROM props UNION ALL SELECT tenure, id FROM props WHERE tenure IN (0, 1))"""),
    "pairs": (["users", "ranked_pool"], f"""
        WITH pools AS (SELECT DISTINCT pool, n FROM ranked_pool),
        wish AS (SELECT id, {preference('tenure_preference')} AS pref FROM users),
        held AS (SELECT w.id, coalesce(p.pool, 2) AS pool, coalesce(p.n, (SELECT n FROM pools WHERE pool = 2)) AS n
                 FROM wish w LEFT JOIN pools p ON p.pool = w.pref),
        steps AS (SELECT id, pool, (CAST('0x' || substr(md5('42:' || CAST(id AS VARCHAR)), 1, 15) AS BIGINT) + s.step) % n AS rnk
                  FROM held, (SELECT unnest(range(10)) AS step) s WHERE s.step < n)
        SELECT s.id AS user_id, r.property_id FROM steps s JOIN ranked_pool r ON r.pool = s.pool AND r.rnk = s.rnk"""),
}


DERIVED["registry_valid"] = (["registry"], "SELECT * FROM registry WHERE duration <> 'U'")
for _name, _needs in (("first_listing", ["listing_loaded"]), ("merged", ["registry_valid", "first_listing_loaded", "listing_loaded"])):
    _text = DERIVED[_name][1].replace("first_listing", "first_listing_loaded").replace("FROM listing", "FROM listing_loaded").replace("registry h", "registry_valid h")
    DERIVED[f"{_name}_loaded"] = (_needs, _text)


def with_views(names: list[str], body: str) -> str:
    """SQL with the named views and everything they need in front."""
    done: dict[str, str] = {}

    def add(name: str) -> None:
        if name in done:
            return
        if name in DERIVED:
            needs, text = DERIVED[name]
            for need in needs:
                add(need)
            done[name] = text
        elif name in VIEWS:
            done[name] = view_sql(name)

    for name in names:
        add(name)
    if not done:
        return body.strip()
    head = ", ".join(f"{name} AS ({text})" for name, text in done.items())
    text = body.strip()
    return f"WITH {head}, {text[5:]}" if text.upper().startswith("WITH ") else f"WITH {head} {text}"

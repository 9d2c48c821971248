"""Schemas of the inputs, of the mapping records and of the graph tables.

Field names are fixed values: they are the names in the data being read.
"""

from __future__ import annotations

from pyspark.sql import types as T

STRING, LONG, INT, DATE, FLOAT = (
    T.StringType(),
    T.LongType(),
    T.IntegerType(),
    T.DateType(),
    T.FloatType(),
)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def _texts(*names: str) -> T.StructType:
    return _struct(**{name: STRING for name in names})


# --- source 1: tree of mentors (parents) and students (children) ---

ENTITY = _struct(name=STRING, type=STRING, category=STRING, year=INT)
TREE = _struct(children=T.ArrayType(ENTITY), parents=T.ArrayType(ENTITY))
ENTITY_WITH_ID = _struct(name=STRING, type=STRING, category=STRING, year=INT, id=STRING)
TREE_WITH_IDS = _struct(
    children=T.ArrayType(ENTITY_WITH_ID), parents=T.ArrayType(ENTITY_WITH_ID)
)

# --- source 2: raw API record, language-tagged texts ---

EN = _struct(en=STRING)
AFFILIATION_FIELDS = ["name", "nameNow", "city", "country", "cityNow", "countryNow", "continent"]
PLACE_FIELDS = ["city", "country", "cityNow", "countryNow", "continent"]
RAW_AFFILIATION = _struct(**{name: EN for name in AFFILIATION_FIELDS})
RAW_PRIZE = _struct(
    awardYear=STRING,
    category=EN,
    portion=STRING,
    dateAwarded=STRING,
    motivation=EN,
    prizeAmount=LONG,
    prizeAmountAdjusted=LONG,
    affiliations=T.ArrayType(RAW_AFFILIATION),
)
RAW_RECORD = _struct(
    id=STRING,
    knownName=EN,
    givenName=EN,
    familyName=EN,
    fullName=EN,
    gender=STRING,
    birth=_struct(date=STRING, place=_struct(**{name: EN for name in PLACE_FIELDS})),
    death=_struct(date=STRING),
    nobelPrizes=T.ArrayType(RAW_PRIZE),
)
RAW_PAGE = _struct(laureates=T.ArrayType(RAW_RECORD))

# --- source 2: reference record ---

AFFILIATION = _texts(*AFFILIATION_FIELDS)
PRIZE = _struct(
    awardYear=STRING,
    category=STRING,
    portion=STRING,
    dateAwarded=STRING,
    motivation=STRING,
    prizeAmount=LONG,
    prizeAmountAdjusted=LONG,
    affiliations=T.ArrayType(AFFILIATION),
)
REFERENCE_TEXTS = [
    "id",
    "knownName",
    "givenName",
    "familyName",
    "fullName",
    "gender",
    "birthDate",
    "birthPlaceCity",
    "birthPlaceCountry",
    "birthPlaceCityNow",
    "birthPlaceCountryNow",
    "birthPlaceContinent",
    "deathDate",
]
REFERENCE = T.StructType(
    _texts(*REFERENCE_TEXTS).fields + [T.StructField("prizes", T.ArrayType(PRIZE))]
)

# --- mapping record written by the resolution stage ---

MAPPING = _struct(
    source=_texts("name", "category", "year"),
    matched_record=_struct(id=LONG, knownName=STRING, fullName=STRING, category=STRING),
    confidence=STRING,
)

# --- graph tables: label -> (schema, key) and edge -> (from, to, properties) ---

NODES: dict[str, tuple[T.StructType, str]] = {
    "Scholar": (
        _struct(
            id=STRING,
            scholar_type=STRING,
            name=STRING,
            fullName=STRING,
            knownName=STRING,
            gender=STRING,
            birthDate=DATE,
            deathDate=DATE,
        ),
        "id",
    ),
    "Prize": (
        _struct(
            id=STRING,
            awardYear=LONG,
            category=STRING,
            dateAwarded=DATE,
            motivation=STRING,
            prizeAmount=LONG,
            prizeAmountAdjusted=LONG,
        ),
        "id",
    ),
    "City": (_texts("name", "state"), "name"),
    "Country": (_texts("name"), "name"),
    "Continent": (_texts("name"), "name"),
    "Institution": (_texts("name"), "name"),
}
EDGES: dict[str, tuple[str, str, dict[str, T.DataType]]] = {
    "MENTORED": ("Scholar", "Scholar", {}),
    "BORN_IN": ("Scholar", "City", {}),
    "DIED_IN": ("Scholar", "City", {}),  # declared by the data model, filled by no stage
    "IS_CITY_IN": ("City", "Country", {}),
    "IS_LOCATED_IN": ("Institution", "City", {}),
    "AFFILIATED_WITH": ("Scholar", "Institution", {}),
    "WON": ("Scholar", "Prize", {"portion": STRING}),
    "IS_COUNTRY_IN": ("Country", "Continent", {}),
}


def edge_schema(props: dict[str, T.DataType]) -> T.StructType:
    return _struct(src=STRING, dst=STRING, **props)


# --- vector tables; the vector length is checked when rows are loaded ---

VECTOR = T.ArrayType(FLOAT)
KEYED_SOURCE = _struct(
    name=STRING, type=STRING, category=STRING, year=STRING, pk=STRING, vector=VECTOR
)
KEYED_REFERENCE = T.StructType(
    _texts(*REFERENCE_TEXTS, "awardYear", "category", "pk").fields
    + [T.StructField("vector", VECTOR)]
)
SIMILAR_TO = ("Scholar", "Reference", {"similarity_score": FLOAT})

"""Declared schemas, feed settings and the small fixed dictionaries."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import types as T

# --- fixed values: column names and types of the daily feeds, in file order ---------------
# Ids are 64-bit here because the feed's ids and counts outgrow 32 bits.

EVENTS_DDL = """
    ev_id bigint, ev_date int, year_month int, year int, date_fraction float,
    a1_code string, a1_name string, a1_country_code string, a1_group_code string,
    a1_ethnic_code string, a1_rel1_code string, a1_rel2_code string,
    a1_type1_code string, a1_type2_code string, a1_type3_code string,
    a2_code string, a2_name string, a2_country_code string, a2_group_code string,
    a2_ethnic_code string, a2_rel1_code string, a2_rel2_code string,
    a2_type1_code string, a2_type2_code string, a2_type3_code string,
    is_root_event int, ev_code string, ev_base_code string, ev_root_code string,
    quad_class int, gstein_scale float, num_mentions int, num_sources int,
    num_articles int, avg_tone float,
    a1_geo_id int, a1_geo_full_name string, a1_geo_country_code string,
    a1_geo_adm1_code string, a1_geo_lat float, a1_geo_lon float, a1_geo_feat_id string,
    a2_geo_id int, a2_geo_full_name string, a2_geo_country_code string,
    a2_adm1_code string, a2_geo_lat float, a2_geo_lon float, a2_geo_feat_id string,
    action_geo_id int, action_geo_full_name string, action_geo_country_code string,
    action_geo_adm1_code string, action_geo_lat float, action_geo_lon float,
    action_geo_feat_id string, date_added int, source_url string
"""

GKG_DDL = """
    pub_date int, num_articles int, counts string, themes string, locations string,
    persons string, organizations string, tone_vec string, event_ids string,
    sources string, source_urls string
"""

GKG_COUNTS_DDL = """
    pub_date int, num_articles int, count_type string, reported_count float,
    object_type string, geo_id int, geo_full_name string, geo_country_code string,
    geo_adm1_code string, geo_lat float, geo_lon float, geo_feat_id string,
    event_ids string, sources string, source_urls string
"""

SILVER_EVENTS_COLUMNS = """
    ev_id ev_date
    a1_name a1_country_code a1_country_name a1_type1_code a1_type1_desc a1_type2_code
    a1_type2_desc a1_geo_id a1_geo_type a1_geo_country_code a1_geo_country a1_geo_state
    a1_geo_location a1_geo_lat a1_geo_lon
    a2_name a2_country_code a2_country_name a2_type1_code a2_type1_desc a2_type2_code
    a2_type2_desc a2_geo_id a2_geo_type a2_geo_country_code a2_geo_country a2_geo_state
    a2_geo_location a2_geo_lat a2_geo_lon
    action_geo_country_code action_geo_country action_geo_state action_geo_location
    action_geo_id action_geo_type action_geo_lat action_geo_lon
    is_root_event ev_code ev_desc ev_base_code ev_base_desc ev_root_code ev_root_desc
    quad_class quad_class_desc gstein_scale num_mentions num_sources num_articles avg_tone
    date_added source_url
""".split()

SILVER_COUNTS_COLUMNS = """
    pub_date num_articles count_type reported_count object_type geo_id geo_type
    geo_country_code geo_country geo_state geo_location geo_lat geo_lon event_ids sources
    source_urls
""".split()

COUNT_ENTRY_DDL = (
    "Type string, Count int, ObjectType string, LocationType string, LocationName string, "
    "CountryCode string, ADM1Code string, Latitude float, Longitude float, "
    "LocationFeatureID string"
)
TONE_FIELDS = [
    "Tone", "PositiveScore", "NegativeScore", "Polarity", "ActRefDensity", "SelfGroupRefDensity",
]
TONE_FLAT_FIELDS = [
    "tone_avg", "tone_pct_pos", "tone_pct_neg", "tone_polarity", "tone_pct_active",
    "tone_pct_self_ref",
]

# Codes of the location-type field inside count and location entries.
LOCATION_TYPES = {
    "1": "COUNTRY", "2": "USSTATE", "3": "USCITY", "4": "WORLDCITY", "5": "WORLDSTATE",
}

# Dictionaries short enough to state; the long ones are read from files.
QUAD_CLASSES = [
    (1, "Verbal Cooperation"),
    (2, "Material Cooperation"),
    (3, "Verbal Conflict"),
    (4, "Material Conflict"),
]
GEO_TYPES = [
    (1, "Country"),
    (2, "U.S. State"),
    (3, "U.S. City"),
    (4, "World City"),
    (5, "World State"),
]

# Type names used by the schema files, and what they are read as.
FILE_TYPES = {
    "INTEGER": "bigint", "STRING": "string", "HALF": "float", "FLOAT": "double",
    "DOUBLE": "double",
}
# --- end of fixed values ----------------------------------------------------------------


_TYPES = {
    "int": T.IntegerType(), "bigint": T.LongType(), "float": T.FloatType(),
    "double": T.DoubleType(), "string": T.StringType(), "date": T.DateType(),
    "boolean": T.BooleanType(),
}


def struct(ddl: str) -> T.StructType:
    """Flat schema from `name type, ...`; needs no running session."""
    pairs = [field.split() for field in ddl.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


def ddl(schema: T.StructType) -> str:
    """`name type, ...` text of any schema, for readers that take text."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


@dataclass(frozen=True)
class FeedSpec:
    """What an ingestion needs to know about one feed."""

    name: str
    ddl: str
    table: str
    partition: str
    header: bool
    file_suffix: str

    @property
    def schema(self) -> T.StructType:
        return struct(self.ddl)


FEEDS = {
    "events": FeedSpec("events", EVENTS_DDL, "bronze_events", "date_added", False, "export"),
    "gkg": FeedSpec("gkg", GKG_DDL, "bronze_gkg", "pub_date", True, "gkg"),
    "gkgcounts": FeedSpec(
        "gkgcounts", GKG_COUNTS_DDL, "bronze_gkgcounts", "pub_date", True, "gkgcounts"
    ),
}


def feed(source: str) -> FeedSpec:
    if source not in FEEDS:
        raise ValueError(f"unknown source {source!r}, expected one of {sorted(FEEDS)}")
    return FEEDS[source]


def snake_case(name: str) -> str:
    """Split before capitals, with ID and ADM as one word each."""
    words = re.findall(r"(?:ADM|ID|[A-Z])[^A-Z]*|[^A-Z]+", name)
    return re.sub("_+", "_", "_".join(words)).lower()


def rename_all(columns: list[str], overrides: dict[str, str] | None = None) -> list[str]:
    """New names for `df.toDF(*names)`."""
    overrides = overrides or {}
    return [overrides.get(c) or snake_case(c) for c in columns]


def struct_from_rows(
    rows: list[dict], original_names: bool = False, overrides: dict[str, str] | None = None
) -> T.StructType:
    """Build a read schema from the rows of a schema file (column, col_renamed, data_type)."""
    fields = []
    for row in rows:
        name = row["column"]
        if not original_names:
            name = row.get("col_renamed") or rename_all([name], overrides)[0]
        if row["data_type"] not in FILE_TYPES:
            raise ValueError(f"{name}: unknown type {row['data_type']!r}")
        fields.append(f"{name} {FILE_TYPES[row['data_type']]}")
    return struct(", ".join(fields))

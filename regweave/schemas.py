"""Fixed schemas of every table the library reads back or publishes.

Dates are ISO strings at the contract edge; ordering on them is lexicographic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TEXT, _LONG, _DOUBLE, _FLAG = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()
_TEXTS, _LONGS = T.ArrayType(_TEXT), T.ArrayType(_LONG)


def _table(names: str, **other: T.DataType) -> T.StructType:
    """Columns in order; all are strings but for those named in ``other``."""
    return T.StructType([T.StructField(n, other.get(n, _TEXT)) for n in names.split()])


RECORD = _table(
    "callsign first_name last_name city county state postal_code country dxcc grid license_class"
    " source synced_at allstar_nodes grant_date effective_date expired_date frn entity_type"
    " applicant_type previous_callsign uses_lotw lotw_last_activity",
    dxcc=_LONG, allstar_nodes=_LONGS, uses_lotw=_FLAG,
)

HISTORY = _table(
    "callsign valid_from valid_to first_name last_name city county state postal_code country"
    " dxcc grid license_class source synced_at",
    dxcc=_LONG,
)

PARK = _table(
    "reference name location_desc region country dxcc grid lat lon active source synced_at",
    dxcc=_LONG, lat=_DOUBLE, lon=_DOUBLE, active=_FLAG,
)

PARK_GRID = _table("reference grid source confidence")

SUMMIT = _table(
    "reference name association region alt_m alt_ft grid lat lon points bonus_points valid_from"
    " valid_to active source synced_at",
    alt_m=_LONG, alt_ft=_LONG, points=_LONG, bonus_points=_LONG, lat=_DOUBLE, lon=_DOUBLE, active=_FLAG,
)

# One row per boundary feature.  `part` groups an outer ring with its holes.
_VERTEX = T.StructType([T.StructField("lon", _DOUBLE), T.StructField("lat", _DOUBLE)])
_RING = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("ring", T.ArrayType(_VERTEX))])
BOUNDARY = _table(
    "feature_id unit_name local_name tags rings", tags=T.MapType(_TEXT, _TEXT), rings=T.ArrayType(_RING)
)

REFLECTOR = _table(
    "id network name aliases callsign host port modules country sponsor description dashboard source"
    " synced_at system requires talkgroups_url talkgroups talkgroup timeslot alias_source license",
    aliases=_TEXTS, modules=_TEXTS, requires=_TEXTS, port=_LONG, talkgroup=_LONG, timeslot=_LONG,
)

TALKGROUP = _table("system tg name synced_at", tg=_LONG)

NODE = _table("node callsign description location")

# A change in any of these opens a new interval and retires the surrogate id.
IDENTITY_FIELDS = (
    "first_name",
    "last_name",
    "city",
    "county",
    "state",
    "postal_code",
    "country",
    "dxcc",
    "grid",
    "license_class",
)

# Columns that are never null in a fresh row: a missing prior column reads as these.
_DEFAULTS = {"allstar_nodes": "array()", "uses_lotw": "false", "aliases": "array()",
             "modules": "array()", "requires": "array()", "active": "true"}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` to ``schema``: fill absent columns, drop unknown ones, fix types.

    This is the drift rule in both directions: an older table lacks columns and reads
    their defaults, a newer one has extra columns and they are ignored.
    """
    present = set(df.columns)
    out: list[Column] = []
    for field in schema.fields:
        if field.name in present:
            value = F.col(field.name)
        elif field.name in _DEFAULTS:
            value = F.expr(_DEFAULTS[field.name])
        else:
            value = F.lit(None)
        out.append(value.cast(field.dataType).alias(field.name))
    return df.select(*out)

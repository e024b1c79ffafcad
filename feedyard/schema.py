"""Feed registry, per-feed source -> target mappings and the wide target schema.

Everything here is data: operators read these tables instead of carrying one
hand-written parser per feed.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
PAGE_SIZE = 100
MAX_PAGES = 1000
MAX_ATTEMPTS = 10
FULL_RUN_START = "2024-01-01"

# ---------------------------------------------------------------------------
# Must equal the source system's field names and the target
# table's column names, spelling slips included. One line per mapping,
# "SOURCE_FIELD target_column", with a trailing "date" where the field is
# ISO date text converted to epoch seconds.
# ---------------------------------------------------------------------------
_MAPPINGS = {
    "transactions": """
        TRANSACTION_NUMBER app_number
        INSTANCE_DATE transaction_date date
        GROUP_EN transaction_type
        PROCEDURE_EN transaction_sub_type
        IS_OFFPLAN_EN registration_type
        IS_FREE_HOLD_EN free_hold
        USAGE_EN usage_
        AREA_EN area_
        PROP_TYPE_EN property_type
        PROP_SB_TYPE_EN property_sub_type
        TRANS_VALUE amount_
        ACTUAL_AREA transaction_size
        PROCEDURE_AREA property_size
        ROOMS_EN rooms
        PARKING parking
        NEAREST_METRO_EN nearest_metro
        NEAREST_MALL_EN nearest_mall
        NEAREST_LANDMARK_EN nearest_landmark
        TOTAL_BUYER no_of_buyer
        TOTAL_SELLER no_of_seller
        MASTER_PROJECT_EN master_project
        PROJECT_EN project_
    """,
    "rents": """
        CONTRACT_NUMBER app_number
        REGISTRATION_DATE registration_date date
        START_DATE start_date date
        END_DATE end_date date
        VERSION_EN transaction_type
        AREA_EN area_
        CONTRACT_AMOUNT contract_amount
        ANNUAL_AMOUNT annual_amount
        IS_FREE_HOLD_EN free_hold
        ACTUAL_AREA property_size
        PROP_TYPE_EN property_type
        PROP_SUB_TYPE_EN property_sub_type
        ROOMS number_rooms
        USAGE_EN usage_
        NEAREST_METRO_EN nearest_metro
        NEAREST_MALL_EN nearest_mall
        NEAREST_LANDMARK_EN nearest_landmark
        PARKING parking
        TOTAL_PROPERTIES no_of_units
        MASTER_PROJECT_EN master_project
        PROJECT_EN project_
    """,
    "projects": """
        PROJECT_NUMBER app_number
        PROJECT_EN project_name
        DEVELOPER_NUMBER developer_number
        DEVELOPER_EN developer_name
        START_DATE start_date date
        END_DATE end_date date
        ADOPTION_DATE adeption_date date
        PRJ_TYPE_EN project_type
        PROJECT_VALUE project_value
        ESCROW_ACCOUNT_NUMBER escrow_number
        PROJECT_STATUS project_status
        PERCENT_COMPLETED completed
        INSPECTION_DATE inspection_date date
        COMPLETION_DATE completed_date date
        DESCRIPTION_EN description
        AREA_EN area_
        ZONE_EN zone_authority
        CNT_LAND total_lands
        CNT_BUILDING total_buildings
        CNT_VILLA total_villas
        CNT_UNIT total_units
        MASTER_PROJECT_EN master_project
    """,
    "valuations": """
        PROPERTY_TOTAL_VALUE property_total_type
        AREA_EN area_
        PROCEDURE_AREA property_size
        PROCEDURE_YEAR procedure_year
        PROCEDURE_NUMBER app_number
        INSTANCE_DATE transaction_date date
        ACTUAL_WORTH amount_
        PROCEDURE_AREA transaction_size
        PROPERTY_TYPE_EN property_type
        PROP_SUB_TYPE_EN property_sub_type
    """,
    "lands": """
        LAND_NUMBER land_number
        LAND_SUB_NUMBER land_sub_number
        PROP_SUB_TYPE_EN property_sub_type
        LAND_TYPE_EN land_type
        ACTUAL_AREA property_size
        IS_OFFPLAN_EN registration_type
        PRE_REGISTRATION_NUMBER registration_number
        IS_FREE_HOLD_EN free_hold
        DM_ZIP_CODE zip_code
        MUNICIPALITY_NUMBER municipality_number
        SEPARATED_FROM separated_form
        SEPARATED_REFERENCE separated_reference
        MASTER_PROJECT_EN master_project
        PROJECT_NUMBER project_number
        PROJECT_EN project_name
        AREA_EN area_
        ZONE_EN zone_
    """,
    "units": """
        UNIT_NUMBER unit_number
        PROP_SUB_TYPE_EN property_sub_type
        ACTUAL_AREA property_size
        BALCONY_AREA balcony_area
        COMMON_AREA common_area
        ACTUAL_COMMON_AREA actual_common_area
        FLOOR floor_
        ROOM_EN room_type
        PARKING_NUMBER parking
        PAT_EN parking_allocation_type
        CREATION_DATE creation_date date
        IS_OFFPLAN_EN registration_type
        PRE_REGISTRATION_NUMBER registration_number
        IS_FREE_HOLD_EN free_hold
        IS_LEASE_HOLD_EN lease_hold
        BUILDING_NUMBER building_number
        BUILDING_EN app_number
        LAND_NUMBER land_number
        LAND_SUB_NUMBER land_sub_number
        LAND_TYPE_EN land_type
        DM_ZIP_CODE zip_code
        MUNICIPALITY_NUMBER municipality_number
        MASTER_PROJECT_EN master_project
        PROJECT_NUMBER project_number
        AREA_EN area_
        ZONE_EN zone_
    """,
    "brokers": """
        BROKER_NUMBER broker_number
        BROKER_EN broker_name
        GENDER_EN gender_
        LICENSE_START_DATE start_date date
        LICENSE_END_DATE end_date date
        WEBPAGE website
        PHONE phone
        FAX fax_
        REAL_ESTATE_NUMBER real_estate_number
        REAL_ESTATE_EN real_estate_name
    """,
    "developers": """
        DEVELOPER_NUMBER developer_number
        DEVELOPER_EN developer_name
        REGISTRATION_DATE registration_date date
        LICENSE_SOURCE_EN license_source
        LICENSE_TYPE_EN license_type
        WEBPAGE website
        PHONE phone
        FAX fax_
        LICENSE_NUMBER license_number
        LICENSE_ISSUE_DATE license_lssue_date date
        LICENSE_EXPIRY_DATE license_expiry_date date
        CHAMBER_OF_COMMERCE_NO chamber_commerce
    """,
}

# Request parameters per feed (name, default), in request
# order, as the source service expects them. '' means "no constraint".
# P_SKIP / P_TAKE / P_SORT and the date window are added by the planner.
_REQUEST_PARAMS = {
    "transactions": "P_GROUP_ID P_IS_OFFPLAN P_IS_FREE_HOLD P_AREA_ID P_USAGE_ID P_PROP_TYPE_ID",
    "rents": "P_DATE_TYPE=0 P_IS_FREE_HOLD P_VERSION P_AREA_ID P_USAGE_ID P_PROP_TYPE_ID",
    "projects": "P_DATE_TYPE=1 P_AREA_ID P_PRJ_STATUS P_PRJ_TYPE_ID P_ZONE_ID",
    "valuations": "P_AREA_ID P_PROP_TYPE_ID",
    "developers": "P_NAME",
    "lands": "P_PROJECT P_MASTER_PROJECT P_LAND_TYPE_ID P_AREA_ID P_IS_FREE_HOLD P_ZONE_ID P_PROP_SB_TYPE_ID",
    "units": "P_AREA_ID P_ZONE_ID P_IS_FREE_HOLD=1 P_IS_LEASE_HOLD P_IS_OFFPLAN",
    "brokers": "P_GENDER",
}

# Sort parameter sent per feed.
_SORT = {
    "transactions": "TRANSACTION_NUMBER_ASC",
    "rents": "CONTRACT_NUMBER_ASC",
    "projects": "PROJECT_NUMBER_ASC",
    "valuations": "PROPERTY_TOTAL_VALUE_ASC",
    "developers": "DEVELOPER_NUMBER_ASC",
    "lands": "LAND_NUMBER_ASC",
    "units": "UNIT_NUMBER_ASC",
    "brokers": "BROKER_NUMBER_ASC",
}

# Equality filters: request parameter -> target column it constrains
# (our reading; the matching happens at the remote service).
_PARAM_COLUMNS = {
    "P_GROUP_ID": "transaction_type",
    "P_IS_OFFPLAN": "registration_type",
    "P_IS_FREE_HOLD": "free_hold",
    "P_AREA_ID": "area_",
    "P_USAGE_ID": "usage_",
    "P_PROP_TYPE_ID": "property_type",
    "P_VERSION": "transaction_type",
    "P_PRJ_STATUS": "project_status",
    "P_PRJ_TYPE_ID": "project_type",
    "P_ZONE_ID": "zone_",
    "P_NAME": "developer_name",
    "P_PROJECT": "project_name",
    "P_MASTER_PROJECT": "master_project",
    "P_LAND_TYPE_ID": "land_type",
    "P_PROP_SB_TYPE_ID": "property_sub_type",
    "P_IS_LEASE_HOLD": "lease_hold",
    "P_GENDER": "gender_",
}


@dataclass(frozen=True)
class Mapping:
    source: str
    target: str
    is_date: bool = False


@dataclass(frozen=True)
class Feed:
    name: str
    kind: str  # "dated" | "snapshot"
    mappings: tuple[Mapping, ...]
    keys: tuple[str, ...]  # natural business key, target column names
    date_column: str | None  # target column the date window applies to
    sort: str
    params: tuple[tuple[str, str], ...] = field(default=())

    @property
    def source_fields(self) -> list[str]:
        seen: list[str] = []
        for m in self.mappings:
            if m.source not in seen:
                seen.append(m.source)
        return seen

    @property
    def date_targets(self) -> list[str]:
        return [m.target for m in self.mappings if m.is_date]

    @property
    def targets(self) -> list[str]:
        return [m.target for m in self.mappings]

    def record_schema(self) -> T.StructType:
        """Every source field is read as text; absent keys become null."""
        return T.StructType([T.StructField(f, T.StringType(), True) for f in self.source_fields])


def _parse_mappings(text: str) -> tuple[Mapping, ...]:
    out = []
    for line in text.strip().splitlines():
        parts = line.split()
        out.append(Mapping(parts[0], parts[1], len(parts) > 2 and parts[2] == "date"))
    return tuple(out)


def _parse_params(text: str) -> tuple[tuple[str, str], ...]:
    out = []
    for token in text.split():
        name, _, default = token.partition("=")
        out.append((name, default))
    return tuple(out)


_KEYS = {
    "transactions": ("app_number",),
    "rents": ("app_number",),
    "projects": ("app_number",),
    "valuations": ("app_number", "procedure_year"),
    "developers": ("developer_number",),
    "lands": ("land_number", "land_sub_number"),
    "units": ("unit_number",),
    "brokers": ("broker_number",),
}
_DATE_COLUMN = {
    "transactions": "transaction_date",
    "rents": "registration_date",
    "projects": "start_date",
    "valuations": "transaction_date",
    "developers": "registration_date",
}
DATED_FEEDS = ("transactions", "rents", "projects", "valuations", "developers")
SNAPSHOT_FEEDS = ("lands", "units", "brokers")

FEEDS: dict[str, Feed] = {
    name: Feed(
        name=name,
        kind="dated" if name in DATED_FEEDS else "snapshot",
        mappings=_parse_mappings(_MAPPINGS[name]),
        keys=_KEYS[name],
        date_column=_DATE_COLUMN.get(name),
        sort=_SORT[name],
        params=_parse_params(_REQUEST_PARAMS[name]),
    )
    for name in DATED_FEEDS + SNAPSHOT_FEEDS
}
PARAM_COLUMNS = dict(_PARAM_COLUMNS)
#: Where a feed fills another column than the general one.
FEED_PARAM_COLUMNS = {("projects", "P_ZONE_ID"): "zone_authority"}
#: Paging, sort and date-kind parameters: they constrain no column.
CONTROL_PARAMS = frozenset({"P_TAKE", "P_SKIP", "P_SORT", "P_DATE_TYPE"})


def feed(name: str) -> Feed:
    try:
        return FEEDS[name]
    except KeyError:
        raise ValueError(f"unknown feed {name!r}; known: {sorted(FEEDS)}") from None


# ---------------------------------------------------------------------------
# Wide target table, in column order, as "name type [length]".
# type: text | long | timestamp; a length marks a bounded text column.
# `feed` is ours (front); `id` is the store's surrogate and not carried.
# ---------------------------------------------------------------------------
_WIDE = """
feed text
app_number text 128
transaction_date long
transaction_type text
transaction_sub_type text
registration_type text
free_hold text
usage_ text
area_ text
property_type text
property_sub_type text
amount_ text
transaction_size text
property_size text
rooms text
parking text
nearest_metro text
nearest_mall text
nearest_landmark text
no_of_buyer text
no_of_seller text
master_project text
project_ text
registration text
start_date long
end_date long
contract_amount text
annual_amount text
number_rooms text
no_of_units text
project_name text
developer_number text 128
developer_name text
adeption_date long
project_type text
project_value text
escrow_number text 128
project_status text
completed text
inspection_date long
completed_date long
description text
zone_authority text
total_lands text
total_buildings text
total_villas text
total_units text
property_total_type text
procedure_year text 128
land_number text 128
land_sub_number text 128
land_type text
registration_number text 128
zip_code text
municipality_number text 128
separated_form text
separated_reference text
project_number text 128
zone_ text
unit_number text 128
balcony_area text
common_area text
actual_common_area text
floor_ text
room_type text
parking_allocation_type text
creation_date long
lease_hold text
building_number text
broker_number text 128
broker_name text
gender_ text
website text
phone text 126
fax_ text
real_estate_number text 128
real_estate_name text
registration_date long
license_source text
license_type text
license_number text 128
license_lssue_date long
license_expiry_date long
chamber_commerce text
_tid text 255
created_at timestamp
updated_at timestamp
"""
NOT_NULL = ("_tid",)
AUDIT_COLUMNS = ("_tid", "created_at", "updated_at")

_TYPES = {"text": T.StringType(), "long": T.LongType(), "timestamp": T.TimestampType()}


@dataclass(frozen=True)
class Column:
    name: str
    type: T.DataType
    length: int | None
    nullable: bool


WIDE_COLUMNS: tuple[Column, ...] = tuple(
    Column(
        name=parts[0],
        type=_TYPES[parts[1]],
        length=int(parts[2]) if len(parts) > 2 else None,
        nullable=parts[0] not in NOT_NULL,
    )
    for parts in (line.split() for line in _WIDE.strip().splitlines())
)
WIDE_NAMES = [c.name for c in WIDE_COLUMNS]
DATA_COLUMNS = [c for c in WIDE_NAMES if c not in AUDIT_COLUMNS and c != "feed"]


def wide_schema(with_audit: bool = True) -> T.StructType:
    cols = [c for c in WIDE_COLUMNS if with_audit or c.name not in AUDIT_COLUMNS]
    return T.StructType([T.StructField(c.name, c.type, c.nullable) for c in cols])

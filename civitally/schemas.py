"""Column sets, table schemas and published result contracts."""

from __future__ import annotations

from pyspark.sql import types as T

# Columns removed while cleaning, when present.
DROPPED_COLUMNS = [
    "vehicle_type",
    "descriptor_2",
    "taxi_pick_up_location",
    "bridge_highway_name",
    "bridge_highway_direction",
    "road_ramp",
    "bridge_highway_segment",
    "facility_type",
    "agency_name",
    "incident_address",
    "street_name",
    "cross_street_1",
    "cross_street_2",
    "intersection_street_1",
    "intersection_street_2",
    "park_borough",
    "location",
    "x_coordinate_state_plane",
    "y_coordinate_state_plane",
    "open_data_channel_type",
    "park_facility_name",
    "landmark",
    "bbl",
    "resolution_description",
    "resolution_action_updated_date",
    "due_date",
    "taxi_company_borough",
]

# Cell texts a CSV page uses for "no value" (the pandas defaults).
MISSING_TEXTS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

UNKNOWN = "UNKNOWN"

# A page without one of these cannot be cleaned or loaded.
REQUIRED_COLUMNS = [
    "unique_key",
    "created_date",
    "agency",
    "complaint_type",
    "community_board",
    "address_type",
    "city",
    "location_type",
]

# Columns that become all-null when a page lacks them.
OPTIONAL_COLUMNS = {
    "closed_date": "timestamp_ntz",
    "latitude": "double",
    "longitude": "double",
    "incident_zip": "bigint",
    "council_district": "bigint",
    "descriptor": "string",
    "borough": "string",
    "police_precinct": "string",
    "status": "string",
}

LOCATION_KEY = [
    "borough",
    "community_board",
    "incident_zip",
    "city",
    "council_district",
    "police_precinct",
]
COMPLAINT_KEY = ["complaint_type", "descriptor"]

HOURS_TYPE = T.DecimalType(10, 2)


_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "hours": HOURS_TYPE,
}


def _struct(columns: str) -> T.StructType:
    """'name type, name type' to a schema; unlike DDL parsing it needs no session."""
    pairs = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


DIM_DATE = _struct(
    "date_id bigint, full_date date, year int, quarter int, month int,"
    " month_name string, day int, day_of_week int, day_name string"
)
DIM_AGENCY = _struct("agency_id bigint, agency_code string")
DIM_COMPLAINT_TYPE = _struct("complaint_type_id bigint, complaint_type string, descriptor string")
DIM_LOCATION = _struct(
    "location_id bigint, borough string, community_board string, incident_zip string,"
    " city string, council_district int, police_precinct string"
)

FACT = _struct(
    "unique_key bigint, date_id bigint, agency_id bigint, complaint_type_id bigint,"
    " location_id bigint, created_date timestamp_ntz, closed_date timestamp_ntz,"
    " latitude double, longitude double, location_type string, address_type string,"
    " status string, is_closed boolean, resolution_time_in_hours hours,"
    " created_at timestamp_ntz"
)
FACT_COLUMNS = [f.name for f in FACT if f.name != "created_at"]

INGEST_STATE = _struct(
    "latest_watermark string, total_records_fetched bigint, updated_at string"
)


def contract(columns: str, required: tuple[str, ...]) -> dict:
    """A published result: ordered columns with types, and which may not be null."""
    return {"schema": _struct(columns), "required": required}


CONTRACTS = {
    "daily_30d_summary": contract(
        "request_date date, total_count bigint, closed_count bigint, open_count bigint,"
        " pct_closure_daily double, avg_resolution_time_in_hours double,"
        " median_resolution_time_in_hours double",
        ("request_date", "total_count", "closed_count", "open_count"),
    ),
    "weekly_summary": contract(
        "week_start date, week_total_requests bigint, week_closed_requests bigint,"
        " week_closed_requests_pct double, week_avg_resolution_time_in_hours double,"
        " prev_week_total_requests bigint, prev_week_total_closed_requests bigint,"
        " prev_week_change_in_requests_pct double,"
        " prev_week_change_in_closed_requests_pct double,"
        " prev_week_avg_resolution_time_in_hours double,"
        " prev_week_avg_resolution_time_in_hours_pct double",
        (
            "week_total_requests",
            "week_closed_requests",
            "prev_week_total_requests",
            "prev_week_total_closed_requests",
        ),
    ),
    "requests_by_day_of_week": contract(
        "day_of_week int, day_name string, total_count bigint, pct_closed double,"
        " avg_resolution_hours double",
        ("day_of_week", "day_name", "total_count", "pct_closed"),
    ),
    "requests_by_borough": contract(
        "borough string, total_count bigint, closed_count bigint, open_count bigint,"
        " pct_closed double, avg_resolution_hours double, median_resolution_hours double",
        ("borough", "total_count", "closed_count", "open_count", "pct_closed"),
    ),
    "requests_by_complaint_type": contract(
        "complaint_type string, total_count bigint, closed_count bigint, pct_closed double,"
        " avg_resolution_hours double, median_resolution_hours double,"
        " p90_resolution_hours double",
        ("complaint_type", "total_count", "closed_count", "pct_closed"),
    ),
    "requests_by_agency": contract(
        "agency_code string, total_count bigint, closed_count bigint, open_backlog bigint,"
        " pct_closed double, avg_resolution_hours double, p90_resolution_hours double",
        ("agency_code", "total_count", "closed_count", "open_backlog", "pct_closed"),
    ),
    "backlog_aging": contract(
        "lt_7d bigint, d7_to_30 bigint, d30_to_90 bigint, gt_90d bigint",
        ("lt_7d", "d7_to_30", "d30_to_90", "gt_90d"),
    ),
}

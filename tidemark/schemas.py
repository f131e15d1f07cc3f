"""Schemas of the raw tables and contracts of the models, and a check that fails on drift."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.errors import SchemaError

VERSION = "0.1.0"
# Products, their constants and the hubs that are served.
HUBS = ("TH_NP15_GEN-APND", "TH_SP15_GEN-APND", "TH_ZP26_GEN-APND")
SOURCE = "CAISO"
PRODUCTS = {
    "lmp": {"product": "day_ahead_hourly_lmp", "unit": "USD/MWh", "source_dataset": "PRC_LMP", "market": "DAY_AHEAD_HOURLY", "location_type": "Trading Hub", "seconds": 3600},
    "load": {"product": "system_load_5min", "unit": "MW", "source_dataset": "todays_outlook_demand", "area": "CAISO", "seconds": 300},
}
MEASURES = {"lmp": ("lmp", "energy", "congestion", "loss"), "load": ("load",)}

NUMERIC = "decimal(38,9)"


_TYPES = {"string": T.StringType(), "bigint": T.LongType(), "boolean": T.BooleanType(), "date": T.DateType(), "timestamp": T.TimestampNTZType(), "numeric": T.DecimalType(38, 9)}


def struct(text: str) -> T.StructType:
    """A schema from names and kinds, in which timestamps are UTC without zone and ! means not null."""
    fields = []
    for part in text.split(","):
        name, kind = part.split()
        fields.append(T.StructField(name, _TYPES[kind.rstrip("!")], not kind.endswith("!")))
    return T.StructType(fields)


_COMMON = (
    "content_id string!,logical_key string!,content_hash string!,logical_key_schema string!,content_hash_schema string!,source string!,product string!,"
    "source_dataset string!,market_date date!,interval_start_utc timestamp!,interval_end_utc timestamp!,unit string!,retrieved_at_utc timestamp!,"
    "source_url string!,source_method string!,library_version string!,first_run_id string!,first_seen_at timestamp"
)
_TRANSITIONS = (
    "transition_id string!,run_id string!,logical_key string!,content_id string!,content_hash string!,logical_key_schema string!,content_hash_schema string!,"
    "market_date date!,interval_start_utc timestamp!,ordinal bigint!,commit_sequence bigint!,retrieved_at_utc timestamp!,known_at timestamp"
)
_RUNS = (
    "run_id string!,request_id string!,source string!,product string!,requested_date date!,started_at timestamp!,status string!,commit_completed boolean!,"
    "package_version string!,library_version string!,warehouse_schema string!,logical_key_schema string!,content_hash_schema string!,requested_location string,"
    "completed_at timestamp,knowledge_at timestamp,rows_fetched bigint,rows_normalized bigint,rows_accepted bigint,rows_rejected bigint,new_contents bigint,"
    "new_transitions bigint,batch_hash string,error_class string,error_message string,commit_job_id string,commit_sequence bigint,query_bytes_processed bigint,"
    "query_bytes_billed bigint,code_revision string"
)
RAW: dict[str, T.StructType] = {
    "warehouse_control": struct("singleton bigint!,sequence bigint!,warehouse_schema string!,active_run_id string"),
    "ingestion_runs": struct(_RUNS),
    "lmp_contents": struct(f"{_COMMON},market string!,location string!,lmp numeric!,energy numeric!,congestion numeric!,loss numeric!"),
    "load_contents": struct(f"{_COMMON},area string!,load numeric!"),
    "lmp_state_transitions": struct(_TRANSITIONS),
    "load_state_transitions": struct(_TRANSITIONS),
}

_MART = (
    "source,market,unit,market_date,location,interval_start_utc,interval_end_utc,lmp,logical_key,content_id,content_hash,logical_key_schema,content_hash_schema,"
    "transition_id,state_run_id,state_ordinal,commit_sequence,first_seen_at,state_known_at"
)
BATTERY_INPUTS = tuple(_MART.split(","))
#: Battery inputs as JSON rows hold them: times and decimals as text, so that nothing is rounded.
BATTERY_JSON = T.StructType([T.StructField(c, T.LongType() if c in ("state_ordinal", "commit_sequence") else T.StringType()) for c in BATTERY_INPUTS])

_STATE = (("transition_id", "string"), ("state_run_id", "string"), ("state_ordinal", "bigint"), ("commit_sequence", "bigint"), ("state_known_at", "timestamp_ntz"), ("state_retrieved_at_utc", "timestamp_ntz"))


def fact_columns(product: str) -> list[tuple[str, str]]:
    """Names and types of a current-state fact: its content, then its state."""
    contents = [("content_retrieved_at_utc" if f.name == "retrieved_at_utc" else f.name, f.dataType.simpleString()) for f in RAW[f"{product}_contents"]]
    return [*contents, *_STATE]


def assert_contract(frame: DataFrame, columns: list[tuple[str, str]], name: str) -> DataFrame:
    """The frame, if its columns are these in this order; a drift of names or types is an error."""
    if frame.dtypes != list(columns):
        wrong = [(a, b) for a, b in zip([*frame.dtypes, *[None] * len(columns)], [*columns, *[None] * len(frame.dtypes)], strict=False) if a != b]
        raise SchemaError(f"{name} breaks its contract: {wrong[:3]}")
    return frame


def require_columns(frame: DataFrame, required: tuple[str, ...]) -> None:
    """Columns are there, each once; more are allowed."""
    names = list(frame.columns)
    if len(set(names)) < len(names):
        raise SchemaError("duplicate columns")
    if missing := sorted(set(required) - set(names)):
        raise SchemaError(f"missing required columns: {', '.join(missing)}")

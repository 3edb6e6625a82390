"""Schemas of the packet log and of each packet kind's content."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, LONG, INT, DOUBLE, BOOL = (
    T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType(),
)


def record(**fields: T.DataType) -> T.StructType:
    """A struct type from field names and types."""
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def _many(element: T.DataType) -> T.ArrayType:
    return T.ArrayType(element)


# One list per sample type; a column or row carries exactly one of them.
SAMPLE_LIST = record(
    double_samples=_many(record(value=DOUBLE, status=TEXT)),
    int32_samples=_many(record(value=INT, status=TEXT)),
    bool_samples=_many(record(value=BOOL, status=TEXT)),
    string_samples=_many(record(value=TEXT, status=TEXT)),
)

# What a typed list becomes once its values are doubles.
WIDE_SAMPLES = _many(record(value=DOUBLE, status=TEXT))

_CONVERSION = record(
    conversion_identifier=TEXT,
    input_values=_many(DOUBLE),
    string_values=_many(TEXT),
    default_value=TEXT,
)
_PARAMETER_DEFINITION = record(
    identifier=TEXT,
    name=TEXT,
    application_name=TEXT,
    description=TEXT,
    units=TEXT,
    data_type=TEXT,
    format_string=TEXT,
    min_value=DOUBLE,
    max_value=DOUBLE,
    warning_min_value=DOUBLE,
    warning_max_value=DOUBLE,
    conversion=_CONVERSION,
)
_EVENT_DEFINITION = record(
    identifier=TEXT,
    definition_id=LONG,
    name=TEXT,
    application_name=TEXT,
    description=TEXT,
    priority=TEXT,
    conversions=_many(_CONVERSION),
)
_GROUP_DEFINITION = record(identifier=TEXT, name=TEXT, application_name=TEXT)
_TEXTS = T.MapType(TEXT, TEXT)
_ITEM = record(str_value=TEXT, dbl_value=DOUBLE)

# Content per packet type.
CONTENT: dict[str, T.StructType] = {
    "PeriodicData": record(
        format_id=LONG, params=_many(TEXT), start_ns=LONG, interval_ns=LONG, columns=_many(SAMPLE_LIST)
    ),
    "RowData": record(
        format_id=LONG, params=_many(TEXT), timestamps=_many(LONG), rows=_many(SAMPLE_LIST)
    ),
    "SynchroData": record(
        format_id=LONG,
        params=_many(TEXT),
        start_ns=LONG,
        intervals=_many(LONG),
        columns=_many(SAMPLE_LIST),
    ),
    "Marker": record(
        ts_ns=LONG, end_ns=LONG, type=TEXT, label=TEXT, description=TEXT, source=TEXT, value=LONG
    ),
    "Event": record(format_id=LONG, event_identifier=TEXT, ts_ns=LONG, raw_values=_many(DOUBLE)),
    "Error": record(
        ts_ns=LONG,
        name=TEXT,
        error_identifier=TEXT,
        application=TEXT,
        description=TEXT,
        error_type=TEXT,
        status=TEXT,
    ),
    "RawCANData": record(ts_ns=LONG, bus=LONG, can_id=LONG, can_type=TEXT, payload=T.BinaryType()),
    "CoverageCursorInfo": record(ts_ns=LONG),
    "Configuration": record(
        config_id=TEXT,
        parameter_definitions=_many(_PARAMETER_DEFINITION),
        event_definitions=_many(_EVENT_DEFINITION),
        group_definitions=_many(_GROUP_DEFINITION),
    ),
    "Metadata": record(metadata=T.MapType(TEXT, _ITEM)),
    "DataFormatDefinition": record(
        format_id=LONG, kind=TEXT, params=_many(TEXT), event_identifier=TEXT
    ),
    "NewSession": record(
        data_source=TEXT,
        identifier=TEXT,
        type=TEXT,
        version=INT,
        utc_offset_seconds=LONG,
        details=_TEXTS,
        assoc_keys=_many(TEXT),
        streams=_many(TEXT),
        offsets=T.MapType(TEXT, LONG),
        main_offset=LONG,
        essentials_offset=LONG,
    ),
    "SessionInfo": record(
        data_source=TEXT,
        identifier=TEXT,
        type=TEXT,
        version=INT,
        details=_TEXTS,
        assoc_keys=_many(TEXT),
        streams=_many(TEXT),
        offsets=T.MapType(TEXT, LONG),
        main_offset=LONG,
        essentials_offset=LONG,
    ),
    "EndOfSession": record(data_source=TEXT),
}

# The eight kinds a recorder splits the log into.
DATA_KINDS = (
    "PeriodicData",
    "RowData",
    "SynchroData",
    "Marker",
    "Event",
    "Error",
    "RawCANData",
    "CoverageCursorInfo",
)

PACKETS = record(
    pkt_offset=LONG,
    data_source=TEXT,
    session_key=TEXT,
    stream=TEXT,
    type=TEXT,
    is_essential=BOOL,
    content=TEXT,
)

# A stored packet: where and when it arrived as well, as far as its source says.
LOG = T.StructType([*PACKETS, *record(partition=INT, submit_time=T.TimestampType())])

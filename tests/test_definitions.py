from __future__ import annotations

from pyspark.sql import functions as F

from stintlog.operators import definitions as df, formats as fm, race

ERROR = "pkt_offset bigint, session_key string, ts_ns bigint, name string, error_identifier string, application string, error_type string, status string"


def test_error_writes(spark):
    cases = [("SET", "CURRENT"), ("CLEARED", "CURRENT"), ("SET", "LOGGED"), ("CLEARED", "LOGGED"), ("UNSPECIFIED", "LOGGED")]
    errors = spark.createDataFrame(
        [(i, "A", i, "E", "7:Ecu", "Ecu", kind, status) for i, (status, kind) in enumerate(cases)], ERROR
    )
    definitions = df.error_definitions(errors)
    channels = df.assign_channels(
        definitions.select("session_key", "parameter", F.lit("Error").alias("kind"), F.lit(0).alias("interval_ns"))
    )
    written = race.error_samples(errors, definitions, channels)
    assert sorted((r.pkt_offset, r.parameter, r.value) for r in written.collect()) == [
        (0, "Current7:Ecu", 1.0), (0, "Logged7:Ecu", 1.0), (1, "Current7:Ecu", 0.0), (1, "Logged7:Ecu", 1.0),
        (2, "Logged7:Ecu", 1.0), (3, "Current7:Ecu", 0.0), (3, "Logged7:Ecu", 0.0),
    ]
    assert written.groupBy("parameter").agg(F.countDistinct("channel_id").alias("n")).where("n <> 1").isEmpty()
    assert [r.pkt_offset for r in race.reject_errors(errors).collect()] == [4]


def test_channels_are_dense_and_shared(spark):
    rows = [("A", "Periodic", "p", 5), ("A", "Periodic", "p", 7), ("A", "Row", "p", 0), ("A", "Error", "p", 0),
            ("A", "Synchro", "p", 0), ("A", "Row", "p", 0), ("B", "Row", "p", 0)]
    parameters = spark.createDataFrame(rows, "session_key string, kind string, parameter string, interval_ns bigint")
    channels = df.assign_channels(parameters)
    ids = {s: sorted(r.channel_id for r in channels.where(F.col("session_key") == s).collect()) for s in "AB"}
    assert ids == {"A": [1, 2, 3, 4], "B": [1]}
    assert df.attach_channels(parameters, channels).count() == len(rows)


def test_format_ids_are_kept_and_extended(spark):
    formats = spark.createDataFrame(
        [(3, "parameter", ["a", "b"], None), (9, "event", None, "e")],
        "format_id bigint, kind string, params array<string>, event_identifier string",
    )
    lists = spark.createDataFrame([(5, ["b", "a"]), (2, ["c"]), (7, ["a", "b"]), (1, ["b", "a"])], "pkt_offset bigint, params array<string>")
    got = {tuple(r.params): (r.format_id, r.is_new) for r in fm.register_parameter_format(lists, formats).collect()}
    assert got == {("a", "b"): (3, False), ("b", "a"): (10, True), ("c",): (11, True)}


def test_unknown_format_is_null_and_fails_arity(spark):
    formats = spark.createDataFrame([(3, "parameter", ["a"], None)], "format_id bigint, kind string, params array<string>, event_identifier string")
    blocks = spark.createDataFrame(
        [(0, 0, ["x"], [1]), (1, 3, None, [1]), (2, 4, None, [1]), (3, 3, None, [1, 2])],
        "pkt_offset bigint, format_id bigint, params array<string>, columns array<int>",
    )
    checked = fm.check_arity(fm.resolve_parameter_list(blocks, formats))
    assert sorted((r.format_id, r.params, r.arity_error or "") for r in checked.collect()) == [
        (0, ["x"], ""), (3, ["a"], ""), (3, ["a"], "parameters do not match columns"), (4, None, "no parameter list"),
    ]


def test_positional_names(spark):
    rows = spark.createDataFrame([(["a"], [5.0, 6.0]), (None, [7.0])], "params array<string>, row array<double>")
    assert sorted(r.name for r in fm.positional_names(rows).collect()) == ["Param0", "Param1", "a"]


def test_conversions(spark):
    samples = spark.createDataFrame(
        [(0.0, "g"), (1.0, "g"), (5.0, "g"), (float("nan"), "g"), (0.0, "")], "value double, conversion_identifier string"
    )
    conversions = spark.createDataFrame(
        [("g", [0.0, 1.0], ["N", "1"], "?")],
        "conversion_identifier string, input_values array<double>, string_values array<string>, default_value string",
    )
    texts = [r.text for r in df.text_conversion(samples, conversions).collect()]
    assert sorted(t or "" for t in texts) == ["", "1", "?", "?", "N"]
    assert df.default_conversion(samples.limit(1)).first().text == " 0.00"


def test_defaults_for_missing(spark):
    seen = spark.createDataFrame([("a",), ("a:StreamAPI",), ("b:X",)], "parameter string")
    known = spark.createDataFrame([("b:X",)], "identifier string")
    missing = df.missing_parameters(seen, known)
    made = df.default_parameter_definitions(missing).collect()
    assert [(r.identifier, r.name, r.application_name, r.max_value, r.format_string) for r in made] == [
        ("a:StreamAPI", "a", "StreamAPI", 100.0, "6.3f")
    ]
    events = spark.createDataFrame([("1F:App",), ("Lap:App",)], "identifier string")
    assert sorted((r.identifier, r.definition_id) for r in df.default_event_definitions(events).collect()) == [
        ("1F:App", 31),
    ]
    assert [r.identifier for r in df.undefinable_events(events).collect()] == ["Lap:App"]
    parts = spark.createDataFrame([("a:b:c",)], "identifier string")
    assert df.default_parameter_definitions(parts).first().identifier == "a:b:c"


def test_first_config_wins(spark):
    config = spark.createDataFrame([("c", 5, "late"), ("c", 2, "first"), ("d", 9, "only")], "config_id string, pkt_offset bigint, body string")
    assert sorted(r.body for r in df.dedupe_config(config).collect()) == ["first", "only"]
    streams = spark.createDataFrame([("c", 1, "B"), ("c", 1, "A")], "config_id string, pkt_offset bigint, stream string")
    assert [r.stream for r in df.dedupe_config(streams).collect()] == ["A"]


def test_lap_numbers_wrap(spark):
    markers = spark.createDataFrame(
        [("Lap Trigger", "0", 70000), ("Lap Trigger", "1", 3), ("Note", "x", 1)], "type string, source string, value bigint"
    )
    laps, points = race.split_markers(markers)
    assert sorted((r.lap_number, r.trigger_source) for r in laps.collect()) == [(3, 1), (4464, 0)]
    assert points.count() == 1


def test_formats_and_definitions_per_owner(spark):
    formats = spark.createDataFrame(
        [("D", 1, "parameter", ["a"], None), ("E", 1, "parameter", ["b"], None)],
        "data_source string, format_id bigint, kind string, params array<string>, event_identifier string",
    )
    blocks = spark.createDataFrame(
        [(0, "D", 1, None), (1, "E", 1, None), (2, "E", 0, ["x"])],
        "pkt_offset bigint, data_source string, format_id bigint, params array<string>",
    )
    resolved = fm.resolve_parameter_list(blocks, formats, by=["data_source"])
    assert [r.params for r in resolved.orderBy("pkt_offset").collect()] == [["a"], ["b"], ["x"]]
    lists = spark.createDataFrame(
        [(0, "D", ["b"]), (1, "E", ["b"]), (2, "F", ["b"])], "pkt_offset bigint, data_source string, params array<string>"
    )
    registered = fm.register_parameter_format(lists, formats, by=["data_source"])
    assert sorted((r.data_source, r.format_id, r.params) for r in registered.where("is_new").collect()) == [
        ("D", 2, ["b"]), ("F", 1, ["b"]),
    ]
    seen = spark.createDataFrame([("S", "p:A"), ("T", "p:A")], "session_key string, parameter string")
    known = spark.createDataFrame([("S", "p:A")], "session_key string, identifier string")
    missing = df.missing_parameters(seen, known, by=["session_key"])
    assert [tuple(r) for r in missing.collect()] == [("T", "p:A")]


def test_known_channels_keep_their_ids(spark):
    schema = "session_key string, kind string, parameter string, interval_ns bigint"
    first = df.assign_channels(spark.createDataFrame([("A", "Row", "p", 0), ("A", "Row", "q", 0)], schema))
    rows = [("A", "Row", "q", 0), ("A", "Row", "r", 0), ("A", "Row", "s", 0), ("B", "Row", "q", 0)]
    later = df.assign_channels(spark.createDataFrame(rows, schema), known=first)
    before = {r.parameter: r.channel_id for r in first.collect()}
    after = {(r.session_key, r.parameter): r.channel_id for r in later.collect()}
    assert all(after["A", p] == i for p, i in before.items()) and after["B", "q"] == 1
    assert sorted(i for (s, _), i in after.items() if s == "A") == [1, 2, 3, 4]


def test_last_definition_wins(spark):
    rows = spark.createDataFrame([("c", 1, "p", 5.0), ("d", 3, "p", 7.0), ("d", 2, "q", 1.0)], "config_id string, pkt_offset bigint, identifier string, max_value double")
    assert sorted((r.identifier, r.max_value) for r in df.current_definitions(rows).collect()) == [("p", 7.0), ("q", 1.0)]


def test_repeated_format_announcements(spark):
    formats = spark.createDataFrame([(3, "parameter", ["a"], None)] * 2, "format_id bigint, kind string, params array<string>, event_identifier string")
    blocks = spark.createDataFrame([(0, 3, None)], "pkt_offset bigint, format_id bigint, params array<string>")
    assert fm.resolve_parameter_list(blocks, formats).count() == 1

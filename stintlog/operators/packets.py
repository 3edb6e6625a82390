"""Packet envelope: selection, routing, demultiplexing, decoding, rejects."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Literal

from pyspark.sql import Column, DataFrame, functions as F, types as T

from stintlog.schemas import CONTENT, DATA_KINDS

MAIN_STREAM = ""
LATEST = -1
ESSENTIALS = "essentials"


@dataclass(frozen=True)
class ReadSpec:
    """What a reader wants: a session of a data source, its streams and where to start.

    No streams means all of them. ``offsets`` runs along ``streams``; a missing one is 0.
    ``LATEST`` means from now on: nothing of a finished log, new packets of a live one.
    """

    data_source: str | None = None
    session_key: str | None = None
    streams: Sequence[str] = ()
    offsets: Sequence[int] = ()
    main_offset: int = 0
    essentials_offset: int = 0
    exclude_main_stream: bool = False

    def starts(self) -> dict[str, int]:
        padded = list(self.offsets) + [0] * (len(self.streams) - len(self.offsets))
        return dict(zip(self.streams, padded))


def _from_offset(offset: int) -> Column:
    return F.lit(False) if offset == LATEST else F.col("pkt_offset") >= offset


def match_session(packets: DataFrame, session_key: str) -> DataFrame:
    """Drop the packets of other sessions; apply before decoding, so that it reaches the scan."""
    return packets.where(F.col("session_key") == session_key)


def exclude_main_stream(packets: DataFrame) -> DataFrame:
    """Drop the packets of the unnamed main stream."""
    return packets.where(F.col("stream") != MAIN_STREAM)


def _of_session(packets: DataFrame, spec: ReadSpec) -> DataFrame:
    if spec.data_source is not None:
        packets = packets.where(F.col("data_source") == spec.data_source)
    if spec.session_key is not None:
        packets = match_session(packets, spec.session_key)
    return packets


def select_packets(packets: DataFrame, spec: ReadSpec) -> DataFrame:
    """The packets a spec asks for, as plain column filters that reach the scan."""
    packets = _of_session(packets, spec)
    stream = F.col("stream")
    if spec.streams:
        wanted = F.lit(False)
        for name, offset in spec.starts().items():
            wanted = wanted | ((stream == name) & _from_offset(offset))
        if MAIN_STREAM not in spec.streams:
            wanted = wanted | ((stream == MAIN_STREAM) & _from_offset(spec.main_offset))
    else:
        wanted = (stream != MAIN_STREAM) | _from_offset(spec.main_offset)
    packets = packets.where(wanted)
    return exclude_main_stream(packets) if spec.exclude_main_stream else packets


def read_essentials(packets: DataFrame, spec: ReadSpec = ReadSpec()) -> DataFrame:
    """Only the packets a late joiner needs: configuration, formats, session info."""
    return _of_session(packets, spec).where(
        F.col("is_essential") & _from_offset(spec.essentials_offset)
    )


def _any_match(name: Column, patterns: Sequence[str]) -> Column:
    """Whether the whole name matches one of the patterns."""
    return name.rlike("^(?:" + "|".join(f"(?:{p})" for p in patterns) + ")$")


def _selected(name: Column, include: Sequence[str], exclude: Sequence[str]) -> Column:
    keep = _any_match(name, include) if include else F.lit(True)
    return keep & ~_any_match(name, exclude) if exclude else keep


def read_data_packets(
    packets: DataFrame,
    include_parameters: Sequence[str] = (),
    exclude_parameters: Sequence[str] = (),
    include_events: Sequence[str] = (),
    exclude_events: Sequence[str] = (),
    include_markers: bool = False,
) -> DataFrame:
    """Data packets by regular expressions over their parameter and event names.

    No include pattern means every name; an exclude pattern wins. ``selected`` lists the
    surviving parameters: a sample block passes with at least one. Runs before any explode.
    """
    names = F.filter(
        "params", lambda p: _selected(p, include_parameters, exclude_parameters)
    )
    is_block = F.col("type").isin("PeriodicData", "RowData", "SynchroData")
    is_event = F.col("type") == "Event"
    passes = (
        (is_block & (F.size("selected") > 0))
        | (is_event & _selected(F.col("event_identifier"), include_events, exclude_events))
        | ((F.col("type") == "Marker") & F.lit(include_markers))
    )
    return packets.withColumn("selected", F.when(is_block, names)).where(passes)


def start_offset() -> Column:
    """Where ``stream`` starts by the session's ``offsets``; 0 where it names none."""
    key = F.concat(F.col("data_source"), F.lit("."), F.col("stream"), F.lit(":0"))
    return F.coalesce(F.try_element_at("offsets", key), F.lit(0)).cast("bigint")


def resolve_offsets(sessions: DataFrame) -> DataFrame:
    """Start offset of each stream of each session, 0 where the session names none."""
    streams = sessions.select(
        "session_key", "data_source", "offsets", F.explode("streams").alias("stream")
    )
    return streams.select("session_key", "stream", start_offset().alias("start_offset"))


def discover_streams(sessions: DataFrame, known: DataFrame) -> DataFrame:
    """Streams (with start offsets) that a session has gained since ``known`` was read."""
    return resolve_offsets(sessions).join(known, ["session_key", "stream"], "left_anti")


def route_packets(
    packets: DataFrame,
    strategy: Literal["partition", "topic"],
    partitions: Mapping[str, int] | None = None,
) -> DataFrame:
    """Add the ``topic`` and ``topic_partition`` each packet is published to.

    By partition: one topic per data source, a stream's partition from ``partitions`` (0 if
    not listed). By topic: one topic per stream, the main stream on the data source's own. An
    essential packet goes to the main stream and to the essentials topic as well.
    """
    main = F.struct(F.col("data_source").alias("topic"), F.lit(0).alias("topic_partition"))
    essentials = F.struct(
        F.concat_ws(".", "data_source", F.lit(ESSENTIALS)).alias("topic"),
        F.lit(0).alias("topic_partition"),
    )
    if strategy == "partition":
        number = F.lit(0)
        for stream, partition in (partitions or {}).items():
            number = F.when(F.col("stream") == stream, partition).otherwise(number)
        own = F.struct(F.col("data_source").alias("topic"), number.alias("topic_partition"))
    else:
        topic = F.when(F.col("stream") == MAIN_STREAM, F.col("data_source")).otherwise(
            F.concat_ws(".", "data_source", "stream")
        )
        own = F.struct(topic.alias("topic"), F.lit(0).alias("topic_partition"))
    targets = F.when(
        F.col("is_essential"), F.array_distinct(F.array(own, main, essentials))
    ).otherwise(F.array(own))
    return packets.withColumn("target", F.explode(targets)).select(
        *packets.columns, "target.topic", "target.topic_partition"
    )


def demux_packets(
    packets: DataFrame, kinds: Sequence[str] = DATA_KINDS
) -> dict[str, DataFrame]:
    """One DataFrame per kind. The type filter prunes partitions of a log written by type."""
    return {kind: packets.where(F.col("type") == kind) for kind in kinds}


_CORRUPT = "_corrupt"


def _parsed(content: Column, schema: T.StructType) -> Column:
    """Content as a struct of ``schema`` and the text that did not parse."""
    with_corrupt = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    return F.from_json(content, with_corrupt, options)


def _is_blank(content: Column) -> Column:
    return content.isNull() | (F.trim(content.cast("string")) == "")


def unreadable_content(content: Column, schema: T.StructType) -> Column:
    """Whether content is null, blank or does not parse; parses once."""
    def failed(parsed: Column) -> Column:
        return parsed.isNull() | parsed[_CORRUPT].isNotNull()

    # A lambda's variable is computed once, however often it is mentioned.
    return _is_blank(content) | F.get(F.transform(F.array(_parsed(content, schema)), failed), F.lit(0))


def _present(value: Column) -> Column:
    """Generator that drops the rows where ``value`` is null.

    A filter on a costly expression would compute it again next to the projection; a generator
    computes it once.
    """
    return F.explode(F.array_compact(F.array(value)))


def decoded_value(
    content: Column,
    kind: str,
    use: Callable[[Column], Column],
    decoder: Callable[[Column, T.StructType], Column] | None = None,
) -> Column:
    """``use`` of the decoded content of one kind, null where ``decode_content`` leaves it out; parses once."""
    schema = CONTENT[kind]

    def used(block: Column) -> Column:
        good = block.isNotNull() if decoder is not None else block.isNotNull() & block[_CORRUPT].isNull()
        return F.when(good, use(block))

    made = _parsed(content, schema) if decoder is None else decoder(content, schema)
    return F.when(~_is_blank(content), F.get(F.transform(F.array(made), used), F.lit(0)))


def decode_content(
    packets: DataFrame,
    kind: str,
    schema: T.StructType | None = None,
    decoder: Callable[[Column, T.StructType], Column] | None = None,
) -> DataFrame:
    """Packets of one kind with their content decoded into columns of its schema.

    Content is JSON unless ``decoder`` says otherwise (for example with ``from_protobuf``); it
    returns null for content it cannot read. Envelope columns keep their names, so a content
    field of the same name is prefixed with ``content_``. Packets with null, blank or undecodable
    content are left out; ``reject_packets`` has them. Each content is parsed once: the test for
    corrupt content reads what the generator made.
    """
    schema = schema or CONTENT[kind]
    envelope = [c for c in packets.columns if c != "content"]
    own = packets.where(F.col("type") == kind)
    if decoder is None:
        own = own.where(~_is_blank(F.col("content")))
        made = own.select(*envelope, F.explode(F.array(_parsed(F.col("content"), schema))).alias("decoded"))
        made = made.where(F.col("decoded").isNotNull() & F.col(f"decoded.{_CORRUPT}").isNull())
    else:
        made = own.select(*envelope, _present(decoder(F.col("content"), schema)).alias("decoded"))
    return made.select(
        *envelope,
        *[
            F.col(f"decoded.{f.name}").alias(f"content_{f.name}" if f.name in envelope else f.name)
            for f in schema.fields
        ],
    )


def reject_packets(
    packets: DataFrame,
    schemas: Mapping[str, T.StructType] = CONTENT,
    decoder: Callable[[Column, T.StructType], Column] | None = None,
) -> DataFrame:
    """Packets no operator can use, with the reason: a null or unknown type, or undecodable content."""
    kind, content = F.col("type"), F.col("content")
    reason = F.when(kind.isNull() | ~kind.isin(*schemas), "unknown type")
    for name, schema in schemas.items():
        bad = unreadable_content(content, schema) if decoder is None else decoder(content, schema).isNull()
        reason = reason.when((kind == name) & bad, "undecodable content")
    return packets.withColumn("reason", _present(reason))


def payload_shape(row_packets: DataFrame) -> DataFrame:
    """Number of samples (timestamps) and of parameters in a row block."""
    carried = [c for c in row_packets.columns if c not in ("params", "timestamps", "rows")]
    return row_packets.select(
        *carried,
        F.coalesce(F.size("timestamps"), F.lit(0)).alias("n_samples"),
        F.coalesce(F.size("params"), F.lit(0)).alias("n_parameters"),
    )

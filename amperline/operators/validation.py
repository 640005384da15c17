"""Validation of JSON payloads: typed fields, error codes, valid and rejected rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amperline.functions import codes, datetime_ok, matches, name_ok, parse_time

# The fields of an event, and the accepted reading types.
REQUIRED_FIELDS = ("sensorId", "timestamp", "readingType", "value", "unit")
OPTIONAL_FIELDS = ("gridZone",)
FIELDS = REQUIRED_FIELDS + OPTIONAL_FIELDS
READING_TYPES = ("voltage", "current", "frequency", "power_factor", "temperature")
NUMBER_TYPES = r"^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL\(.*)"


def decode_base64(data: Column) -> Column:
    """UTF-8 text of base64 data, null where the data is not base64."""
    return F.decode(F.try_to_binary(data, F.lit("base64")), "UTF-8")


def json_object(payload: Column) -> Column:
    """Top-level members of a JSON object as variants, null for anything else.

    The parser stops after the first value and ignores what follows it.  A text
    whose only closing brace is its last character cannot have a tail; any other
    text also has to parse inside a list and inside an object, which leaves no
    room for one.
    """
    plain = matches(payload, r"^\s*\{[^{}]*\}\s*\z")
    in_list = F.try_parse_json(F.concat(F.lit("["), payload, F.lit("]")))
    in_object = F.try_parse_json(F.concat(F.lit('{"v":'), payload, F.lit("}")))
    whole = plain | (in_list.isNotNull() & in_object.isNotNull())
    return F.when(
        whole,
        F.try_variant_get(F.try_parse_json(payload), "$", "map<string,variant>"),
    )


def _kind(members: Column, field: str) -> Column:
    """Type name of a member; null if absent, ``VOID`` for a JSON null."""
    return F.schema_of_variant(members[field])


def _text(members: Column, field: str) -> Column:
    return F.when(
        _kind(members, field) == "STRING", F.try_variant_get(members[field], "$", "string")
    )


def _number(members: Column, field: str) -> Column:
    return F.when(
        matches(_kind(members, field), NUMBER_TYPES),
        F.try_variant_get(members[field], "$", "double"),
    )


def read_fields(df: DataFrame, payload: str = "payload", sensor: str | None = None) -> DataFrame:
    """Add ``event``: the typed fields, plus what the checks need to know.

    ``sensor`` names a column whose text replaces the payload's ``sensorId``,
    as a route does that takes the sensor from the topic.
    """
    members = F.col("_members")
    stage = df.withColumn("_members", json_object(F.col(payload)))
    known = F.lit(0)
    for field in FIELDS:
        known = known + members[field].isNotNull().cast("int")
    named = F.col(sensor) if sensor else _text(members, "sensorId")
    event = F.struct(
        F.when(members.isNotNull(), named).alias("sensorId"),
        _text(members, "timestamp").alias("timestamp"),
        _text(members, "readingType").alias("readingType"),
        _number(members, "value").alias("value"),
        _text(members, "unit").alias("unit"),
        _text(members, "gridZone").alias("gridZone"),
        members.isNotNull().alias("is_object"),
        (F.size(members) > known).alias("extra"),
        members["gridZone"].isNotNull().alias("has_zone"),
    )
    return stage.withColumn("event", event).drop("_members")


def error_codes(event: Column) -> Column:
    """Codes of every rule an event breaks, in field order."""
    def sized(field: str, most: int) -> Column:
        return F.coalesce(F.char_length(event[field]).between(1, most), F.lit(False))

    finite = F.coalesce(F.abs(event["value"]) < float("inf"), F.lit(False))
    known = F.coalesce(event["readingType"].isin(*READING_TYPES), F.lit(False))
    rules = [
        ("sensorId", ~name_ok(event["sensorId"])),
        ("timestamp", ~datetime_ok(event["timestamp"])),
        ("readingType", ~known),
        ("value", ~finite),
        ("unit", ~sized("unit", 16)),
        ("gridZone", event["has_zone"] & ~sized("gridZone", 64)),
        ("unrecognized_keys", event["extra"]),
    ]
    return F.when(~event["is_object"], F.array(F.lit("not_an_object"))).otherwise(codes(*rules))


def validate(df: DataFrame, payload: str = "payload", sensor: str | None = None) -> DataFrame:
    """Every input row with its fields, ``event_ts`` and ``errors``.

    One bad row never affects another: errors are data.  ``inline`` makes the
    checked row a generated row, so a later filter on ``errors`` reads it
    instead of being pushed below and parsing the payload a second time.
    """
    kept = df.columns
    fields = read_fields(df, payload, sensor)
    event = F.col("event")
    checked = fields.select(
        *kept,
        F.inline(
            F.array(
                F.struct(
                    *[event[f].alias(f) for f in FIELDS],
                    parse_time(event["timestamp"]).alias("event_ts"),
                    error_codes(event).alias("errors"),
                )
            )
        ),
    )
    return checked


def valid_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("errors") == 0).drop("errors")


def rejected_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("errors") > 0)


def error_counts(checked: DataFrame) -> DataFrame:
    """How often each rule was broken."""
    return (
        checked.select(F.explode("errors").alias("error"))
        .groupBy("error")
        .agg(F.count("*").alias("records"))
    )


def escalation_event(df: DataFrame, state: str = "state") -> DataFrame:
    """Replace a workflow state (JSON) by the six event fields it contains.

    Fields that later steps appended are left out, so the strict check passes.
    """
    members = F.col("_members")
    fields = F.filter(
        F.array(*[F.lit(f) for f in FIELDS]), lambda f: F.map_contains_key(members, f)
    )
    picked = F.map_from_arrays(fields, F.transform(fields, lambda f: F.element_at(members, f)))
    return (
        df.withColumn("_members", json_object(F.col(state)))
        .withColumn("payload", F.when(members.isNotNull(), F.to_json(picked)))
        .drop("_members")
    )

"""JSON payloads to typed rows, and the split of records that cannot be used."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from greenwave.functions import parse_event_time
from greenwave.schemas import DECISION, INCIDENT, VEHICLE

_CORRUPT = "_unparsed"


def decode(
    raw: DataFrame,
    schema: StructType,
    value: str = "value",
    fields: Sequence[str] | None = None,
) -> DataFrame:
    """One JSON text or binary column to flat columns plus ``event_time``.

    ``fields`` names the columns in use beside ``timestamp``; the parser then skips
    the others.

    Rows without a valid event time are dropped, malformed payloads with them.
    A field of the wrong type becomes NULL and its row stays.

    The struct is flattened by ``inline``, not ``d.*``: the optimizer would copy
    the parse into the filter and read each payload twice.
    """
    if fields is not None:
        schema = StructType([f for f in schema if f.name == "timestamp" or f.name in fields])
    parsed = F.from_json(F.col(value).cast("string"), schema)
    return (
        raw.select(F.inline(F.array(parsed)))
        .selectExpr("*", f"{parse_event_time('timestamp')} AS event_time")
        .filter("event_time IS NOT NULL")
    )


def decode_vehicles(raw: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    return decode(raw, VEHICLE, fields=fields)


def decode_incidents(raw: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    return decode(raw, INCIDENT, fields=fields)


def classify_records(raw: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """Decode without dropping anything: typed columns, the payload text and ``reason``.

    ``reason`` is NULL for a usable record. Records without an intersection are
    not usable: nothing downstream can key on them.
    """
    with_corrupt = StructType([*schema.fields, StructField(_CORRUPT, StringType())])
    text = F.col(value).cast("string")
    parsed = F.from_json(text, with_corrupt, {"columnNameOfCorruptRecord": _CORRUPT})
    return (
        raw.select(text.alias("payload"), F.inline(F.array(parsed)))
        .selectExpr("*", f"{parse_event_time('timestamp')} AS event_time")
        .selectExpr(
            "*",
            f"""CASE WHEN timestamp IS NULL AND {_CORRUPT} IS NOT NULL THEN 'malformed_json'
                     WHEN timestamp IS NULL THEN 'missing_event_time'
                     WHEN event_time IS NULL THEN 'bad_event_time'
                     WHEN intersection_id IS NULL THEN 'missing_intersection' END AS reason""",
        )
        .drop(_CORRUPT)
    )


def split_bad_records(
    raw: DataFrame, schema: StructType, value: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """``(usable rows, quarantine)``; the quarantine keeps the payload and its reason."""
    rows = classify_records(raw, schema, value)
    good = rows.filter("reason IS NULL").drop("reason", "payload")
    bad = rows.filter("reason IS NOT NULL").select("payload", "reason")
    return good, bad


def decode_decisions(raw: DataFrame, value: str = "value") -> DataFrame:
    """Decision payloads to typed columns plus ``reason`` for those that cannot be stored.

    An absent latency means unknown (-1). A latency that is present but null or
    not a number makes the record unusable, as does a payload that is no object.
    Columns of ``raw`` other than the payload (arrival time, offset) are kept.
    """
    text = F.col(value).cast("string")
    others = [c for c in raw.columns if c != value]
    parsed = raw.select(
        *others,
        F.json_object_keys(text).alias("_keys"),
        F.inline(F.array(F.from_json(text, DECISION))),
    )
    filled = {
        "intersection_id": "coalesce(intersection_id, 'UNKNOWN')",
        "e2e_latency_ms": "coalesce(e2e_latency_ms, -1D)",
    }
    return parsed.selectExpr(
        *others,
        *[f"{filled.get(name, name)} AS {name}" for name in DECISION.fieldNames()],
        """CASE WHEN _keys IS NULL THEN 'malformed_json'
                WHEN array_contains(_keys, 'e2e_latency_ms') AND e2e_latency_ms IS NULL
                THEN 'bad_latency' END AS reason""",
    )

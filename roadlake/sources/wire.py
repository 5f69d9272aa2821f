"""Message envelope and payload decoding.

A message value is one magic byte, a 4-byte schema id and the payload.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAGIC = 0
HEADER_BYTES = 5
CORRUPT = "_corrupt_record"


def split_envelope(messages: DataFrame, value: str = "value") -> DataFrame:
    """Adds ``magic``, ``schema_id`` and the ``payload`` bytes of each message."""
    raw = F.col(value)

    def number(part: Column) -> Column:
        return F.conv(F.hex(part), 16, 10).cast("long")

    return messages.withColumns(
        {
            "magic": number(F.substring(raw, 1, 1)).cast("int"),
            "schema_id": number(F.substring(raw, 2, 4)),
            "payload": F.expr(f"substring({value}, {HEADER_BYTES + 1}, length({value}) - {HEADER_BYTES})"),
        }
    )


def text_of(payload: str) -> Column:
    """Payload bytes as text, NULL where they are not valid UTF-8."""
    return F.try_validate_utf8(F.col(payload).cast("string"))


def parse_json(text: Column, schema: T.StructType) -> Column:
    """Record struct of a JSON payload; the text itself in a corrupt-record field if it does not fit."""
    return F.from_json(
        text,
        T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())]),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )


def parse_avro(payload: Column, avro_schema: str) -> Column:
    """Record struct of an Avro payload, NULL if it does not fit.

    Needs the external Avro package on the cluster.
    """
    from pyspark.sql.avro.functions import from_avro

    return from_avro(payload, avro_schema, {"mode": "PERMISSIVE"})


def decode_payload(
    messages: DataFrame, schema: T.StructType, payload: str = "payload", avro_schema: str | None = None
) -> DataFrame:
    """Payload bytes to record columns, keeping the broker timestamp.

    JSON payloads, or Avro ones with ``avro_schema``. Either way a bad payload gives
    NULL fields instead of stopping the job; ``operators.contract`` sets it aside.
    """
    if avro_schema is None:
        record = F.from_json(text_of(payload), schema, {"mode": "PERMISSIVE"})
    else:
        record = parse_avro(F.col(payload), avro_schema)
    return messages.select(record.alias("data"), "timestamp").select("data.*", "timestamp")

"""JSON, Avro and Protobuf payload columns, and message routing keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def json_field(payload: Column, names: Sequence[str], kind: str = "bigint") -> Column:
    """The first of the named fields that holds a value of the type, number or numeric text."""
    return F.coalesce(*(F.get_json_object(payload, f"$.{name}").try_cast(kind) for name in names))


def is_json_object(payload: Column) -> Column:
    return F.coalesce(F.ltrim(payload).startswith("{") & F.json_object_keys(payload).isNotNull(), F.lit(False))


def route_key(key: Column, payload: Column) -> Column:
    """Upper-case text before ``:`` in the key; without a key the payload's eventType."""
    from_key = F.upper(F.split_part(F.nullif(F.trim(key), F.lit("")), F.lit(":"), F.lit(1)))
    from_payload = F.upper(F.trim(F.get_json_object(payload, "$.eventType")))
    return F.coalesce(from_key, from_payload, F.lit("UNKNOWN"))


def row_json(df: DataFrame) -> Column:
    """The whole row as one JSON object; nulls stay visible, times are ISO."""
    return F.to_json(
        F.struct(*df.columns),
        {"ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss'Z'"},
    )


class JsonCodec:
    """Payloads as UTF-8 JSON text; undecodable ones give null in every required field."""

    def __init__(self, schema: str):
        self.schema = schema

    def decode(self, raw: Column) -> Column:
        return F.from_json(raw.cast("string"), self.schema, {"mode": "PERMISSIVE"})

    def encode(self, row: Column) -> Column:
        return F.to_json(row, {"ignoreNullFields": "false"}).cast("binary")


class AvroCodec:
    """Payloads in Avro with one pinned JSON schema. Needs the spark-avro package."""

    def __init__(self, schema: str):
        self.schema = schema

    def decode(self, raw: Column) -> Column:
        from pyspark.sql.avro.functions import from_avro

        return from_avro(raw, self.schema, {"mode": "PERMISSIVE"})

    def encode(self, row: Column) -> Column:
        from pyspark.sql.avro.functions import to_avro

        return to_avro(row, self.schema)


class ProtobufCodec:
    """Payloads in Protobuf with a descriptor file. Needs the spark-protobuf package.

    Permissive, so a bad message becomes null and reaches the dead letters.
    """

    def __init__(self, message: str, descriptor: str):
        self.message = message
        self.descriptor = descriptor

    def decode(self, raw: Column) -> Column:
        from pyspark.sql.protobuf.functions import from_protobuf

        return from_protobuf(raw, self.message, self.descriptor, {"mode": "PERMISSIVE"})

    def encode(self, row: Column) -> Column:
        from pyspark.sql.protobuf.functions import to_protobuf

        return to_protobuf(row, self.message, self.descriptor)

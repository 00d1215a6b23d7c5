"""JSON text to and from columns, and the result envelope."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Codes and messages carried by the envelope.
CODE_OK = "000000"
CODE_ERROR = "999999"
MESSAGE_OK = "处理成功"
MESSAGE_DELAYED = "数据存在延迟"
MESSAGE_INCOMPLETE = "数据未到齐"
MESSAGE_FAILED = "处理异常"

BAD = "_bad_text"


def is_blank(text: Column) -> Column:
    return F.length(F.trim(F.coalesce(text, F.lit("")))) == 0


def not_empty(text: Column) -> Column:
    return F.length(F.coalesce(text, F.lit(""))) > 0


def probe_schema(schema: T.StructType) -> T.StructType:
    """The schema with a field that receives malformed text."""
    return T.StructType(schema.fields + [T.StructField(BAD, T.StringType())])


def probe(text: Column, schema: T.StructType, options: dict[str, str] | None = None) -> Column:
    """Parse once; ``BAD`` in the result tells malformed text."""
    return F.from_json(
        text, probe_schema(schema), {**(options or {}), "columnNameOfCorruptRecord": BAD}
    )


def parse_record(
    text: Column, schema: T.StructType, options: dict[str, str] | None = None
) -> Column:
    """JSON object to struct. Unknown fields are ignored; blank or malformed
    text gives null, not a struct of nulls."""

    def record(parsed: Column) -> Column:
        fields = F.struct(*[parsed[f].alias(f) for f in schema.fieldNames()])
        return F.when(parsed.isNotNull() & parsed[BAD].isNull(), fields)

    return F.when(
        ~is_blank(text), F.transform(F.array(probe(text, schema, options)), record)[0]
    )


def parse_map(text: Column) -> Column:
    """JSON object of unknown shape to a map; values keep their JSON types."""
    return F.when(~is_blank(text), F.from_json(text, "map<string,variant>"))


def parse_list(text: Column, element: str = "string") -> Column:
    return F.when(~is_blank(text), F.from_json(text, f"array<{element}>"))


def to_text(record: Column, pretty: bool = False) -> Column:
    """Struct or map to JSON text with null fields kept; null becomes ''."""
    options = {"ignoreNullFields": "false"}
    if pretty:
        options["pretty"] = "true"
    return F.coalesce(F.to_json(record, options), F.lit(""))


def copy_as(record: Column, schema: T.StructType) -> Column:
    """Read a record as another type through its JSON text."""
    return parse_record(to_text(record), schema)


def with_field(text: Column, name: str, json_value: str) -> Column:
    """Set one field of a JSON object, leaving the other values as they are."""
    others = F.map_filter(parse_map(text), lambda key, _: key != name)
    added = F.create_map(F.lit(name), F.parse_json(F.lit(json_value)))
    return F.to_json(F.map_concat(others, added))


def _envelope(message: Column, value: Column, success: bool, code: str) -> Column:
    return to_text(
        F.struct(
            message.alias("message"),
            value.alias("value"),
            F.lit(success).alias("success"),
            F.lit(code).alias("msgCode"),
            F.lit(None).cast("map<string,string>").alias("resultMap"),
        )
    )


def error_envelope(
    message: str, code: str = CODE_ERROR, value: Column | None = None
) -> Column:
    nothing = F.lit(None).cast("string")
    return _envelope(F.lit(message), nothing if value is None else value, False, code)


def success_envelope(value: Column | None = None) -> Column:
    nothing = F.lit(None).cast("string")
    return _envelope(F.lit(MESSAGE_OK), nothing if value is None else value, True, CODE_OK)

"""Reading typed fields out of a JSON payload column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# field name in the JSON, name in the model, type
Field = tuple[str, str, str]
STRICT = {"mode": "FAILFAST"}


def _object_schema(fields: list[Field]) -> T.StructType:
    return T.StructType([T.StructField(source, T.StringType()) for source, _, _ in fields])


def strict_cast_sql(value: str, to: str, field: str) -> str:
    """SQL text that casts a string, failing the job on a value that does not fit."""
    if to == "string":
        return value
    problem = f"raise_error(concat('cannot read {field} as {to}: ', {value}))"
    return f"coalesce(try_cast({value} AS {to}), CASE WHEN {value} IS NOT NULL THEN {problem} END)"


def _typed(fields: list[Field], prefix: str = "") -> list[str]:
    return [f"{strict_cast_sql(prefix + source, to, source)} AS {name}" for source, name, to in fields]


def is_variant(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.VariantType)


def extract_fields(
    df: DataFrame, fields: list[Field], keep: list[str], payload: str = "raw_payload"
) -> DataFrame:
    """One parse per row; only the listed fields are built, then cast.

    Values are read as text first, so a value of the wrong type fails the job
    instead of turning into NULL, and so does a payload that is not JSON. A VARIANT payload is read by path.
    """
    if is_variant(df, payload):
        cols = [
            F.variant_get(F.col(payload), f"$.{source}", to).alias(name) for source, name, to in fields
        ]
        return df.select(*cols, *keep)
    # inline() keeps later filters above the parse; pushed below it they would parse every row again
    parsed = df.select(F.inline(F.array(F.from_json(payload, _object_schema(fields), STRICT))), *keep)
    return parsed.selectExpr(*_typed(fields), *keep)


def explode_records(
    df: DataFrame, fields: list[Field], keep: list[str], payload: str = "raw_payload", under: str = "records"
) -> DataFrame:
    """One row per element of the payload's array; none for an empty or absent one."""
    text = F.to_json(F.col(payload)) if is_variant(df, payload) else F.col(payload)
    envelope = T.StructType([T.StructField(under, T.ArrayType(_object_schema(fields)))])
    parsed = df.select(F.explode(F.from_json(text, envelope, STRICT)[under]).alias("_obj"), *keep)
    return parsed.selectExpr(*_typed(fields, "_obj."), *keep)


def has_key(payload: Column, field: str, literal: bool = False) -> Column:
    """Whether a top-level field is present.

    By default an explicit JSON null counts as absent; ``literal`` keeps it as present.
    """
    if literal:
        keys = F.coalesce(F.json_object_keys(payload), F.array().cast("array<string>"))
        return F.array_contains(keys, field)
    return F.from_json(payload, T.StructType([T.StructField(field, T.StringType())]))[field].isNotNull()

"""Nested vehicle records to flat rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as t

from lotwise.operators.columns import ragged_union
from lotwise.operators.dedup import keep_first
from lotwise.session import scratch_path
from lotwise.sources.store import require_rows, write_table


def with_owner_history(df: DataFrame) -> DataFrame:
    """Records that state their number of owners; zero counts."""
    return df.where(F.col("history.ownerCount").isNotNull())


def vehicle_table(df: DataFrame, sep: str = "_") -> DataFrame:
    """Records with owner history, the first of each vin, flattened, columns sorted; stops when no record has one."""
    kept = require_rows(with_owner_history(df), "no record is left after the history filter")
    return ragged_union([flatten_records(first_per_vin(kept), sep)])


def first_per_vin(df: DataFrame, position: str = "row_pos") -> DataFrame:
    """First record of every vin; records without one are dropped."""
    return keep_first(df.where(F.col("vin") != ""), ["vin"], [position])


def flatten_records(df: DataFrame, sep: str = "_") -> DataFrame:
    """Struct members become columns named by their path, arrays become JSON text, empty structs vanish.

    The columns follow from the schema alone, so this is one projection.
    """
    return df.select(*_members(df.schema, None, "", sep))


def _members(schema: t.StructType, parent: Column | None, prefix: str, sep: str) -> list[Column]:
    columns = []
    for field in schema.fields:
        value = F.col(f"`{field.name}`") if parent is None else parent.getField(field.name)
        name = f"{prefix}{sep}{field.name}" if prefix else field.name
        if isinstance(field.dataType, t.StructType):
            columns += _members(field.dataType, value, name, sep)
        elif isinstance(field.dataType, t.ArrayType):
            columns.append(json_text(value, field.dataType).alias(name))
        else:
            columns.append(value.alias(name))
    return columns


def json_text(value: Column, kind: t.DataType) -> Column:
    """JSON with a blank after comma and colon and ASCII escapes; null for a null array."""
    if isinstance(kind, t.ArrayType):
        items = F.transform(value, lambda x: F.coalesce(json_text(x, kind.elementType), F.lit("null")))
        return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))
    if isinstance(kind, t.StructType):
        # absent and null members look the same in a merged schema; both are left out
        pairs = F.array(
            *[
                F.concat(F.lit(f'"{f.name}": '), json_text(value.getField(f.name), f.dataType))
                for f in kind.fields
            ]
        )
        body = F.concat(F.lit("{"), F.array_join(F.array_compact(pairs), ", "), F.lit("}"))
        return F.when(value.isNotNull(), body)
    if isinstance(kind, t.StringType):
        quoted = F.to_json(F.array(value))
        return F.when(value.isNotNull(), _ascii_only(F.substring(quoted, 2, F.length(quoted) - 2)))
    return value.cast("string")


def _ascii_only(text: Column) -> Column:
    def escape(ch: Column) -> Column:
        code = F.ascii(ch)
        unit = lambda c: F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(c)), 4, "0"))
        wide = code - 0x10000
        pair = F.concat(
            unit(F.lit(0xD800) + F.shiftright(wide, 10)), unit(F.lit(0xDC00) + wide.bitwiseAND(F.lit(0x3FF)))
        )
        return F.when(code < 128, ch).when(code < 0x10000, unit(code)).otherwise(pair)

    escaped = F.array_join(F.transform(F.split(text, ""), escape), "")
    return F.when(text.rlike(r"[^\x00-\x7F]"), escaped).otherwise(text)


def flatten_documents(df: DataFrame, column: str, position: str = "row_pos", sep: str = "_") -> DataFrame:
    """``(position, key, value)``: every member of a JSON text column's objects, without a schema.

    Keys are joined from the outermost object on. A member that is null is a row with a null value and one that is
    absent is none, lists are JSON text, empty objects vanish, and a record with odd members adds rows of its own and
    no column to others. Objects are opened level by level; texts that are no JSON object give no rows.
    """
    spark = df.sparkSession
    whole = F.try_parse_json(F.col(column).cast("string"))
    level = df.select(F.col(position).alias("at"), F.col(column).cast("string").alias("doc"), F.lit("").alias("name"), F.lit("$").alias("path"), whole.alias("v"))
    level, parts = level.where(F.schema_of_variant("v").startswith("OBJECT")), []
    while True:
        members = spark.sql("SELECT at, doc, name, path, m.key AS key, m.value AS v FROM {level}, LATERAL variant_explode(v) AS m", level=level)
        kind = F.schema_of_variant("v")
        members = members.select(
            "at", "doc", F.concat("name", F.when(F.col("name") == "", "").otherwise(sep), "key").alias("name"),
            F.concat("path", F.lit("['"), "key", F.lit("']")).alias("path"), "v", kind.alias("kind"),
        )
        members = write_table(members, scratch_path(spark, "members"))
        listed = F.col("kind").startswith("ARRAY")
        text = F.when(listed, _spaced_json(F.expr("get_json_object(doc, path)"))).otherwise(F.variant_get("v", "$", "string"))
        nested = F.col("kind").startswith("OBJECT")
        parts.append(members.where(~nested).select(F.col("at").alias(position), F.col("name").alias("key"), text.alias("value")))
        level = members.where(nested).drop("kind")
        if level.isEmpty():
            return reduce(DataFrame.unionByName, parts)


def _spaced_json(text: Column) -> Column:
    """JSON with a blank after comma and colon outside of strings, and ASCII escapes."""
    tokens = F.regexp_extract_all(text, F.lit(r'"(?:[^"\\]|\\.)*"|[,:]|[^",:]+'), F.lit(0))
    return F.array_join(F.transform(tokens, lambda x: F.when(x.isin(",", ":"), F.concat(x, F.lit(" "))).otherwise(_ascii_only(x))), "")


def infer_struct(df: DataFrame, column: str) -> str:
    """DDL of the union of all objects in a JSON text column, from one distributed aggregate."""
    shape = df.agg(F.schema_of_variant_agg(F.try_parse_json(F.col(column)))).first()[0]
    return shape.replace("OBJECT<", "STRUCT<").replace("VOID", "STRING")


def parse_records(df: DataFrame, column: str, schema: str | t.StructType | None = None) -> DataFrame:
    """Replace a JSON text column by the members of its objects; ragged keys become one schema."""
    schema = schema or infer_struct(df, column)
    others = [c for c in df.columns if c != column]
    return df.select(*others, F.from_json(column, schema).alias("__r")).select(*others, "__r.*")

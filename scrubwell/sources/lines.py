"""Lines of JSON with all their fields: known ones typed, the rest as one VARIANT.

A corpus collected over years has fields that come, go and change their type from
line to line.  Nothing here infers a schema or reads the input twice: every line is
parsed once to a VARIANT, the known fields are taken out of it, and what is left
stays on the row until somebody asks for it by name and type, or the line is
written again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrubwell.sources.corpus import CORPUS_SCHEMA, CORRUPT

REST = "rest"


def _text(value: str) -> str:
    """A SQL string."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _path(field: str) -> str:
    """A path to a field; one that begins with ``$`` is taken as it is."""
    if field.startswith("$"):
        return _text(field)
    if "'" in field and '"' in field:
        raise ValueError(f"a field with both kinds of quotes needs a path: {field}")
    quote = '"' if "'" in field else "'"
    return _text(f"$[{quote}{field}{quote}]")


def parse_lines(
    lines: DataFrame, schema: T.StructType = CORPUS_SCHEMA, line: str = "value", rest: str = REST
) -> DataFrame:
    """Columns of ``schema``, ``rest`` and ``_corrupt_record`` instead of the column ``line``.

    ``rest`` is a VARIANT object with all fields that ``schema`` does not name.  A field of
    another type than the schema's is cast if its value allows it, and NULL if not; the line
    as it was is then found in ``rest`` under the field's own name.  Blank lines are dropped.
    A line that is no JSON object, or names a field twice, has NULLs and its content in
    ``_corrupt_record``.  Other columns stay; works on tables and streams.
    """
    others = [name for name in lines.columns if name != line]
    parsed = lines.filter(F.col(line).rlike(r"\S")).select(
        *others, line, F.expr(f"try_parse_json(`{line}`)").alias("_line")
    )
    fields = parsed.withColumn("_fields", F.expr("try_variant_get(_line, '$', 'map<string,variant>')"))
    names = ", ".join(_text(field.name) for field in schema)
    typed = [
        F.expr(f"try_variant_get(_line, {_path(f.name)}, '{f.dataType.simpleString()}')").alias(f.name)
        for f in schema
    ]
    # a known field that could not be cast is kept where it can be found
    unread = " OR ".join(
        f"(name = {_text(f.name)} AND NOT is_variant_null(value) AND "
        f"try_variant_get(value, '$', '{f.dataType.simpleString()}') IS NULL)"
        for f in schema
    )
    left = f"map_filter(_fields, (name, value) -> NOT name IN ({names}) OR {unread})"
    return fields.select(
        *typed,
        F.expr(f"to_variant_object({left})").alias(rest),
        F.when(F.col("_fields").isNull(), F.col(line)).alias(CORRUPT),
        *others,
    )


def read_lines(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = CORPUS_SCHEMA,
    name_glob: str | None = None,
    rest: str = REST,
) -> DataFrame:
    """Newline-delimited JSON with nothing lost: see :func:`parse_lines`, and the file of each row."""
    reader = spark.read.option("pathGlobFilter", name_glob) if name_glob else spark.read
    lines = reader.text(path).withColumn("source_file", F.col("_metadata.file_name"))
    return parse_lines(lines, schema, rest=rest)


def field(name: str, kind: str, rest: str = REST) -> Column:
    """One field of the rest as ``kind``; NULL where it is missing or cannot be cast.

    ``name`` is a field's name, or a path such as ``$.meta.tags[0]``.
    """
    return F.expr(f"try_variant_get(`{rest}`, {_path(name)}, '{kind}')")


def with_fields(df: DataFrame, kinds: dict[str, str], rest: str = REST) -> DataFrame:
    """``df`` with fields of the rest as typed columns of the same name."""
    return df.withColumns({name: field(name, kind, rest) for name, kind in kinds.items()})


def field_report(df: DataFrame, groups: list[str] | None = None, rest: str = REST) -> DataFrame:
    """``groups, field, type, lines``: in how many lines a field of the rest has which type.

    One row per line and field, counted before the shuffle.
    """
    groups = groups or []
    present = df.select(*groups, F.col(rest).alias("_rest"))
    found = present.select(
        *groups,
        F.explode(F.expr("try_variant_get(_rest, '$', 'map<string,variant>')")).alias("field", "_value"),
    )
    typed = found.select(*groups, "field", F.expr("schema_of_variant(_value)").alias("type"))
    return typed.groupBy(*groups, "field", "type").agg(F.count("*").alias("lines"))


def merged_schema(df: DataFrame, rest: str = REST) -> DataFrame:
    """One row: the narrowest type that holds every line's rest."""
    return df.agg(F.expr(f"schema_of_variant_agg(`{rest}`)").alias("schema"))


def to_lines(df: DataFrame, columns: list[str], rest: str = REST) -> DataFrame:
    """``value``: the given columns and the fields of the rest as one JSON object a line.

    A column comes before a field of the same name; columns that are NULL are written as null.
    Rows that were no JSON object when read are written as they were.
    """
    own = ", ".join(f"{_text(name)}, to_variant_object(named_struct('v', `{name}`))" for name in columns)
    named = f"transform_values(map({own}), (name, value) -> variant_get(value, '$.v', 'variant'))"
    names = ", ".join(_text(name) for name in columns)
    others = (
        f"coalesce(map_filter(try_variant_get(`{rest}`, '$', 'map<string,variant>'),"
        f" (name, value) -> NOT name IN ({names})), map())"
    )
    whole = F.expr(f"to_json(to_variant_object(map_concat({named}, {others})))")
    if CORRUPT not in df.columns:
        return df.select(whole.alias("value"))
    return df.select(F.coalesce(CORRUPT, whole).alias("value"))


def write_lines(df: DataFrame, path: str, columns: list[str], rest: str = REST) -> None:
    to_lines(df, columns, rest).write.mode("errorifexists").text(path)

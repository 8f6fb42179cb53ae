"""S1-S5 / P5 with nothing lost in silence: good rows, and a quarantine of the rest with reasons.

A declared schema alone turns what does not fit into null.  Here every input row ends in one of
two frames: ``good`` (typed) or ``bad`` (the raw text and why).  Fields that the schema does not know are kept
as VARIANT in ``unknown`` instead of being dropped.  Both come from one pass over the input, and a job can
append ``bad`` to a quarantine table partitioned by run date.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class Checked:
    """``good, bad = check_...`` unpacks too; ``told`` has every row (see ``check_json``), for those who use both in one pass."""

    good: DataFrame
    bad: DataFrame
    told: DataFrame | None = None

    def __iter__(self) -> Iterator[DataFrame]:
        return iter((self.good, self.bad))


def check_csv(spark: SparkSession, path: str, schema: T.StructType) -> Checked:
    """Hand-over CSV onto ``schema``.

    Bad: a row with too few or too many fields, or a field that is not of its type.  ``bad`` has
    ``raw`` (the row as read), ``reasons`` and ``file``; ``good`` the columns of ``schema``.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields] + [T.StructField(_CORRUPT, T.StringType())])
    rows = (spark.read.schema(text).option("header", True).option("nullValue", "").option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", _CORRUPT).option("encoding", "UTF-8").option("quote", '"').option("escape", '"')
            .option("multiLine", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .option("enforceSchema", True).csv(path))
    typed = [f for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    shape = F.when(F.col(_CORRUPT).isNotNull(), F.lit(f"row: not {len(schema.fields)} fields"))
    reasons = F.when(F.col(_CORRUPT).isNotNull(), F.array(shape)).otherwise(
        F.array_compact(F.array(*[_reason(f) for f in typed]) if typed else F.array().cast("array<string>")))
    told = rows.withColumns({"reasons": reasons, "file": F.col("_metadata.file_name")})
    raw = F.coalesce(F.col(_CORRUPT), F.to_json(F.struct(*[F.col(f"`{f.name}`") for f in schema.fields])))
    good = told.where(F.size("reasons") == 0).select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])
    bad = told.where(F.size("reasons") > 0).select(raw.alias("raw"), "reasons", "file")
    return Checked(good, bad)


def _reason(field: T.StructField) -> Column:
    value = F.col(f"`{field.name}`")
    return F.when(value.isNotNull() & value.try_cast(field.dataType).isNull(),
                  F.concat(F.lit(f"{field.name}: not {field.dataType.simpleString()}: "), value))


def _misfits(value: Column, kind: T.DataType, name: str) -> list[Column]:
    """Reasons (null where all is well) why a VARIANT does not fit a type, for the leaves of nested types."""
    shown = F.to_json(value)
    there = value.isNotNull() & (shown != "null")
    whole = F.concat(F.lit(f"{name}: not {kind.simpleString()}: "), shown)
    if isinstance(kind, T.StructType):
        inside = F.try_variant_get(value, "$", "map<string,variant>")
        own = [F.when(there & inside.isNull(), whole)]
        return own + [r for f in kind.fields for r in _misfits(F.try_variant_get(value, _path(f.name), "variant"), f.dataType, f"{name}.{f.name}")]
    if isinstance(kind, T.ArrayType):
        items = F.try_variant_get(value, "$", "array<variant>")
        first = F.get(F.filter(F.flatten(F.transform(items, lambda x: F.array(*_misfits(x, kind.elementType, f"{name}[]")))), lambda r: r.isNotNull()), F.lit(0))
        return [F.when(there & items.isNull(), whole).otherwise(first)]
    got = F.try_variant_get(value, "$", kind.simpleString())
    wrong = got.isNull()
    if isinstance(kind, T.IntegralType):  # a fraction is not cut off in silence
        wrong = wrong | (F.try_variant_get(value, "$", "double") != got.cast("double"))
    return [F.when(there & wrong, whole)]


def check_json(lines: DataFrame, schema: T.StructType, text: str = "value") -> Checked:
    """JSON texts (one object each, column ``text``) onto ``schema``.

    Bad: text that is not a JSON object, and objects with a value, at any depth, that is not of its type.
    ``good`` has the other columns of ``lines``, the columns of ``schema`` and ``unknown`` (map of name to
    VARIANT: top-level fields the schema does not name, null if none); ``bad`` has the other
    columns, ``raw`` and ``reasons``.  ``told`` has the other columns, ``raw``, ``reasons`` (empty if good),
    ``row`` (struct of the columns of ``schema``, null if bad) and ``unknown``.
    """
    carried = [c for c in lines.columns if c != text]
    names = [f.name for f in schema.fields]
    # what a generator gives is computed once per row, however many filters and columns above it use it
    parsed = lines.select(*carried, F.col(text).alias("raw"), F.inline_outer(F.array(F.struct(
        F.from_json(text, "map<string,variant>").alias("_fields"), F.try_parse_json(text).alias("_all")))))
    values = [F.try_variant_get("_all", _path(f.name), "variant").alias(f"_v{i}") for i, f in enumerate(schema.fields)]
    parsed = parsed.select(*carried, "raw", "_fields", "_all", F.inline_outer(F.array(F.struct(*values))))
    wrong = [r for i, f in enumerate(schema.fields) for r in _misfits(F.col(f"_v{i}"), f.dataType, f.name)]
    reasons = F.when(F.col("_fields").isNull(), F.array(F.lit("row: not a JSON object"))).otherwise(F.array_compact(F.array(*wrong)))
    unknown = F.map_filter("_fields", lambda k, v: ~k.isin(names))
    told = parsed.withColumns({"reasons": reasons, "unknown": F.when(F.size(unknown) > 0, unknown)})
    typed = [F.try_variant_get("_all", _path(f.name), f.dataType.simpleString()).alias(f.name) for f in schema.fields]
    good = told.where(F.size("reasons") == 0).select(*carried, *typed, "unknown")
    bad = told.where(F.size("reasons") > 0).select(*carried, "raw", "reasons")
    row = F.when(F.size("reasons") == 0, F.struct(*typed)).alias("row")
    return Checked(good, bad, told.select(*carried, "raw", "reasons", row, "unknown"))


def _path(name: str) -> str:
    return f"$['{name}']"


def quarantine(bad: DataFrame, path: str, run_date: str) -> None:
    """Append bad rows to the quarantine table of the run date (a re-run of the date replaces its own)."""
    (bad.withColumn("run_date", F.lit(run_date)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_date").parquet(path))

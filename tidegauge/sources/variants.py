"""JSON lines without a given schema, of which single bad values cost nothing but themselves.

Each line is parsed once, into a VARIANT. The type of a field is the one that most of its values have; it is found from
counts by field and type. Values are then taken out as that type, and those that do not fit are rejected one by
one, with the rest of their line kept.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LINE, VALUE = "_line", "_variant"
# Types that the library gives scalars of JSON, in classes of which the later ones hold the earlier.
_NUMBERS = ("BIGINT", "DECIMAL", "DOUBLE")


class VariantScan(NamedTuple):
    """``rows``: the declared fields, null where the value does not fit. ``rejects``: ``field`` and ``value`` of those, and
    whole lines that are no JSON objects, without a field. ``lines`` are both together, for one pass over the input."""

    rows: DataFrame
    rejects: DataFrame
    lines: DataFrame


def scan_variants(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """``_line`` and ``_variant`` of the lines below ``path`` that are not blank; null where a line is no JSON."""
    lines = spark.read.option("pathGlobFilter", glob).option("lineSep", "\n").text(path)
    lines = lines.filter(F.trim("value") != "")
    return lines.select(F.col("value").alias(LINE), F.try_parse_json("value").alias(VALUE))


def _objects() -> Column:
    return F.schema_of_variant(VALUE).startswith("OBJECT")


def field_types(lines: DataFrame) -> DataFrame:
    """``field``, ``type`` and ``n_values`` of the top-level fields of the lines' objects; null values count as none."""
    # One level of an object as rows, without naming its fields.
    fields = lines.sparkSession.tvf.variant_explode(F.col(VALUE).outer())
    found = lines.filter(_objects()).lateralJoin(fields).select(F.col("key").alias("field"), F.schema_of_variant("value").alias("type"))
    kind = F.when(F.col("type").startswith("DECIMAL"), "DECIMAL").otherwise(F.col("type"))
    return found.filter("type <> 'VOID'").groupBy("field", kind.alias("type")).agg(F.count(F.lit(1)).alias("n_values"))


def inferred_schema(lines: DataFrame) -> str:
    """DDL with the type that most values of each field have; of numbers the widest that occurs among them.

    Only fields and types come to the driver, with their counts. Objects and arrays are text; fields without any value, or with
    both kinds of quotes in their name, are left out.
    """
    counts: dict[str, dict[str, int]] = {}
    for row in field_types(lines).collect():
        counts.setdefault(row["field"], {})[row["type"]] = row["n_values"]
    fields = []
    for field, types in sorted(counts.items()):
        if "'" in field and '"' in field:
            continue
        numbers = [t for t in _NUMBERS if t in types]
        classes = {t: n for t, n in types.items() if t not in numbers}
        if numbers:
            widest = "BIGINT" if numbers == ["BIGINT"] else "DOUBLE"
            classes[widest] = sum(types[t] for t in numbers)
        best = min(classes, key=lambda t: (-classes[t], t))
        fields.append(f"{_quoted(field)} {best if best in ('BIGINT', 'DOUBLE', 'BOOLEAN') else 'STRING'}")
    return ", ".join(fields)


def _quoted(field: str) -> str:
    return "`" + field.replace("`", "``") + "`"


def _place(field: str) -> str:
    # A path has no escapes: the name stands in the quotes that it does not hold.
    for quote in "'", '"':
        if quote not in field:
            return f"$[{quote}{field}{quote}]"
    raise ValueError(f"no path leads to a field with both kinds of quotes: {field}")


def split_fields(lines: DataFrame, schema: str) -> VariantScan:
    """Fields of the given types from a `scan_variants`, and what does not fit them."""
    declared = lines.sparkSession.createDataFrame([], schema).schema.fields
    good = F.coalesce(_objects(), F.lit(False))

    def text(field: str) -> Column:
        return F.try_variant_get(VALUE, _place(field), "string")

    typed = {f.name: F.try_variant_get(VALUE, _place(f.name), f.dataType.simpleString()) for f in declared}
    # A value is there, and not as the declared type.
    bad = [F.when(text(f.name).isNotNull() & typed[f.name].isNull(), F.struct(F.lit(f.name).alias("field"), text(f.name).alias("value"))) for f in declared]
    whole = F.when(~good, F.array(F.struct(F.lit(None).cast("string").alias("field"), F.col(LINE).alias("value"))))
    marked = lines.select(
        good.alias("_good"),
        *(F.when(good, value).alias(name) for name, value in typed.items()),
        F.coalesce(whole, F.array_compact(F.array(*bad))).alias("_bad"),
    )
    names = [_quoted(f.name) for f in declared]
    return VariantScan(marked.filter("_good").select(*names), marked.select(F.explode("_bad").alias("b")).select("b.*"), marked)


def scan_inferred_fields(spark: SparkSession, path: str, glob: str = "*.json") -> VariantScan:
    """Records below ``path`` in the types that most of their values have. The files are read twice: for types and for values."""
    lines = scan_variants(spark, path, glob)
    return split_fields(lines, inferred_schema(lines))

"""JSON texts as VARIANT values, read and judged in the JVM.

The parser stops after the first value of a text. A text is accepted only if it parses both as the element of an array and
as the member of an object: no text that ends a value early fits both brackets. Keys given twice take the last value
(spark.sql.variant.allowDuplicateKeys must be set; `enable` does so). NaN and infinities aren't JSON here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.binding import computed, let
from ..functions.text import strip
from .lines import not_blank


def enable(spark: SparkSession) -> None:
    """Sets the session's spark.sql.variant.allowDuplicateKeys. Every reader of JSON here does so while its plan is made."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def whole_json(c: Column) -> Column:
    """The text's one JSON value as VARIANT; null if the text isn't exactly one."""
    listed = F.try_parse_json(F.concat(F.lit("["), c, F.lit("]")))
    member = F.try_parse_json(F.concat(F.lit('{"v":'), c, F.lit("}")))
    return F.when(listed.isNotNull(), F.try_variant_get(member, "$.v", "variant"))


def python_type(v: Column) -> Column:
    """The Python name of a VARIANT's type; NoneType for an absent value and for null."""

    def named(kind: Column) -> Column:
        whole = kind.rlike(r"^DECIMAL\((19|[23]\d),0\)$")
        return (
            F.when(kind.isNull() | (kind == "VOID"), "NoneType").when(kind.startswith("OBJECT"), "dict").when(kind.startswith("ARRAY"), "list")
            .when(kind == "STRING", "str").when(kind == "BOOLEAN", "bool").when((kind == "BIGINT") | whole, "int").otherwise("float")
        )

    return let(F.schema_of_variant(v), named)  # the schema of a nested value is costly; it is made once


def member(v: Column, name: str) -> Column:
    """The object's member as VARIANT; null if absent or if v is no object."""
    return F.try_variant_get(v, f"$['{name}']", "variant")


def as_text(v: Column) -> Column:
    """A VARIANT as trimmed text: "" for null and absent values, True and False for booleans, lists and objects as JSON."""
    plain = strip(F.try_variant_get(v, "$", "string"))
    truth = F.when(F.schema_of_variant(v) == "BOOLEAN", F.initcap(plain)).otherwise(plain)
    return F.coalesce(F.when(plain.isin("true", "false"), truth).otherwise(plain), F.lit(""))


def json_lines(lines: DataFrame) -> DataFrame:
    """The lines that aren't blank with their value v (null if malformed) and its kind (a Python type name)."""
    enable(lines.sparkSession)
    return computed(not_blank(lines), "v", whole_json(F.col("line"))).withColumn("kind", F.when(F.col("v").isNotNull(), python_type(F.col("v"))))


def json_objects(lines: DataFrame) -> DataFrame:
    """Lenient reading: the objects; other values are dropped, malformed text fails the query."""
    read = json_lines(lines)
    broken = F.raise_error(F.concat(F.lit("malformed JSON in line "), F.col("line_num").cast("string")))
    return read.withColumn("kind", F.when(F.col("v").isNull(), broken).otherwise(F.col("kind"))).where(F.col("kind") == "dict")


def samples_of(read: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of a table of array elements (file, line_num, text, issue_type, detail): samples (file, line_num, v) and issues
    (file, issue_type, detail)."""
    enable(read.sparkSession)
    issues = read.where("issue_type is not null").select("file", "issue_type", "detail")
    samples = read.where("issue_type is null").select("file", "line_num", F.explode(F.array(whole_json(F.col("text")))).alias("v"))
    return samples, issues

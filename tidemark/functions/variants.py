"""JSON values by what they are, not by how they look: kinds, classes and shapes over variants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NON_FINITE = "__non_finite_number__"
_NUMBER = r"^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL)"
#: 1,234.50 and 1.234,50 and 12,5; a lone point is a plain number.
_SEPARATED = r"^[+-]?(\d{1,3}(,\d{3})+(\.\d+)?|\d{1,3}(\.\d{3})+,\d+|\d{1,3}(\.\d{3}){2,}|\d{1,3}([ ']\d{3})+([.,]\d+)?|\d+,\d+)$"
_PLAIN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def kind_of(v: Column) -> Column:
    """null, boolean, number, string, array or object; SQL null (no such field) stays null."""
    t = F.schema_of_variant(v)
    return (
        F.when(t == "VOID", "null").when(t == "BOOLEAN", "boolean").when(t == "STRING", "string").when(F.startswith(t, F.lit("ARRAY")), "array")
        .when(F.startswith(t, F.lit("OBJECT")), "object").when(t.rlike(_NUMBER), "number").when(t.isNotNull(), F.lower(t))
    )


def members(df: DataFrame, payload: str, keep: list[str]) -> DataFrame:
    """``keep`` with (field, value) for each top-level field of the objects in a column of JSON text."""
    parsed = F.try_parse_json(F.col(payload).outer())
    fields = df.sparkSession.tvf.variant_explode(parsed).alias("_f")
    return df.lateralJoin(fields).where("_f.key IS NOT NULL").select(*keep, F.col("_f.key").alias("field"), F.col("_f.value").alias("value"))


def scalar_class(v: Column) -> Column:
    """How a raw amount can be read: number, number_text, separators, text, empty, boolean, null, absent, nested, or marker (not finite)."""
    kind, text = kind_of(v), F.trim(F.try_variant_get(v, "$", "string"))
    marked = F.try_variant_get(v, f"$.{NON_FINITE}", "string").isNotNull() | ((kind == "string") & F.lower(text).rlike(r"^[+-]?(nan|inf|infinity)$"))
    return (
        F.when(kind.isNull(), "absent").when(marked, "marker").when(kind.isin("object", "array"), "nested").when(kind != "string", kind)
        .when(text == "", "empty").when(text.rlike(_PLAIN), "number_text").when(text.rlike(_SEPARATED), "separators").otherwise("text")
    )


def shape_of(v: Column) -> Column:
    """The nested shape: names and kinds at every level, objects' fields in order of their names, all numbers alike."""
    return F.regexp_replace(F.schema_of_variant(v), r"\b(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL\(\d+,\s?\d+\))", "NUMBER")

"""JSON lines with sorted keys, ``", "`` / ``": "`` separators and ASCII output."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _quoted(text: Column) -> Column:
    encoded = F.to_json(F.array(text), {"writeNonAsciiCharacterAsCodePoint": "true"})
    return F.when(text.isNotNull(), F.substring(encoded, F.lit(2), F.length(encoded) - 2))


def json_text(value: Column, dtype: T.DataType) -> Column:
    """JSON text of a column; null struct fields are left out, keys are sorted."""
    if isinstance(dtype, T.StringType):
        return _quoted(value)
    if isinstance(dtype, T.ArrayType):
        items = F.transform(value, lambda item: json_text(item, dtype.elementType))
        return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))
    if isinstance(dtype, T.StructType):
        fields = [
            F.concat(F.lit(f'"{f.name}": '), json_text(value.getField(f.name), f.dataType))
            for f in sorted(dtype.fields, key=lambda f: f.name)
        ]
        # concat_ws skips nulls, and concat of a null field is null: absent keys vanish.
        return F.when(
            value.isNotNull(), F.concat(F.lit("{"), F.concat_ws(", ", *fields), F.lit("}"))
        )
    return value.cast("string")

"""Result types of Arrow UDFs that are made when a module is loaded, before there is a session."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, BinaryType, BooleanType, DataType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

_KINDS: dict[str, DataType] = {
    "string": StringType(), "strings": ArrayType(StringType()), "binary": BinaryType(), "double": DoubleType(), "int": IntegerType(), "long": LongType(), "boolean": BooleanType(),
}


def kind(name: str) -> DataType:
    """A type by name; "strings" is an array of them."""
    return _KINDS[name]


def struct_of(**fields: str | DataType) -> StructType:
    return StructType([StructField(n, t if isinstance(t, DataType) else kind(t)) for n, t in fields.items()])


def list_of(item: DataType) -> ArrayType:
    return ArrayType(item)

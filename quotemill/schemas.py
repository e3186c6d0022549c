"""Short schema notation usable before a session exists."""

from pyspark.sql import types as T

_TYPES = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "binary": T.BinaryType(),
    "boolean": T.BooleanType(),
    "array<long>": T.ArrayType(T.LongType()),
}


def schema(text: str) -> T.StructType:
    """``schema("a long, b string")``."""
    pairs = (part.split() for part in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])

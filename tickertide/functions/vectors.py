"""Sparse ML vectors from arrays and back, inside the JVM."""

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SPARSE = 0  # the type tag of a sparse vector in its stored form


def sparse_vector(size: int | Column, indices: Column, values: Column) -> Column:
    """A sparse vector column; indices ascend.

    The JSON reader builds a vector from its stored form, so no Python worker is needed. That is slow: tables that are
    written anyway take stored_vector, and the parquet reader makes the vectors.
    """
    stored = stored_vector(size, indices, values)
    schema = T.StructType([T.StructField("v", VectorUDT())])
    return F.from_json(F.to_json(F.struct(stored.alias("v"))), schema)["v"]


def stored_vector(size: int | Column, indices: Column, values: Column) -> Column:
    """The stored form of a sparse vector, for columns that are written and read again as vectors."""
    return F.struct(
        F.lit(_SPARSE).cast("tinyint").alias("type"), F.lit(size).cast("int").alias("size"),
        indices.cast("array<int>").alias("indices"), values.cast("array<double>").alias("values"),
    )


def vector_schema(schema: T.StructType, names: list[str]) -> T.StructType:
    """The schema of a written table whose named columns, in stored form, are to be read as vectors."""
    return T.StructType([T.StructField(f.name, VectorUDT()) if f.name in names else f for f in schema])


def vector_parts(vector) -> Column:
    """The stored form: struct(type, size, indices, values)."""
    return F.unwrap_udt(vector)

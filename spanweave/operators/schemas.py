"""Types of landed text, and tables whose columns drift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The tokens of booleans.
TRUE_TOKENS = ("true", "t", "yes", "y")
FALSE_TOKENS = ("false", "f", "no", "n")

DATE = r"^\d{4}-\d{2}-\d{2}$"
INSTANT = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"


def _tests(c: Column) -> list[tuple[str, Column, T.DataType]]:
    """Candidate types in order, each with the condition that every value must meet."""
    number = c.try_cast("double")
    return [
        ("boolean", F.lower(c).isin(*TRUE_TOKENS, *FALSE_TOKENS), T.BooleanType()),
        ("date", c.rlike(DATE), T.DateType()),
        ("instant", c.rlike(INSTANT), T.TimestampType()),
        ("bigint", number.isNotNull() & (number == F.floor(number)) & (F.abs(number) < 2**53), T.LongType()),
        ("double", number.isNotNull(), T.DoubleType()),
    ]


def infer_types(df: DataFrame) -> T.StructType:
    """The narrowest of boolean, date, timestamp, bigint, double and string for each text column, found in one pass; all-null columns stay text."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    if not texts:
        return df.schema
    parts = []
    for i, name in enumerate(texts):
        c = F.col(f"`{name}`")
        for kind, test, _ in _tests(F.col(f"_{i}")):
            parts.append(F.bool_and(test).alias(f"{i}_{kind}"))
        parts.append(F.count(F.col(f"_{i}")).alias(f"{i}_n"))
        df = df.withColumn(f"_{i}", F.trim(c))
    found = df.agg(*parts).first()

    def pick(field: T.StructField) -> T.StructField:
        if field.name not in texts or not found[f"{texts.index(field.name)}_n"]:
            return field
        i = texts.index(field.name)
        kind = next((t for k, _, t in _tests(F.lit("")) if found[f"{i}_{k}"]), field.dataType)
        return T.StructField(field.name, kind)

    return T.StructType([pick(f) for f in df.schema if not f.name.startswith("_") or not f.name[1:].isdigit()])


def cast_text(c: Column, kind: T.DataType) -> Column:
    """Text as a type; what can't be read is null."""
    if isinstance(kind, T.BooleanType):
        token = F.lower(F.trim(c))
        return F.when(token.isin(*TRUE_TOKENS), True).when(token.isin(*FALSE_TOKENS), False)
    if isinstance(kind, T.LongType):
        return F.trim(c).try_cast("double").try_cast("bigint")
    return F.trim(c).try_cast(kind)


def apply_types(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*(cast_text(F.col(f.name), f.dataType).alias(f.name) if isinstance(df.schema[f.name].dataType, T.StringType) and not isinstance(f.dataType, T.StringType) else F.col(f.name) for f in schema))


def missing_columns(have: T.StructType, want: T.StructType) -> list[str]:
    """Names that only the second has."""
    return [f.name for f in want if f.name not in have.names]


def align(batch: DataFrame, stored: T.StructType) -> DataFrame:
    """A batch in the stored columns and types, what is missing as nulls, and its new columns after them."""
    known = [F.col(f.name).try_cast(f.dataType).alias(f.name) if f.name in batch.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in stored]
    return batch.select(*known, *(F.col(c) for c in batch.columns if c not in stored.names))


def widen(target: DataFrame, batch: T.StructType) -> DataFrame:
    """A table with the batch's new columns, as nulls."""
    return target.select("*", *(F.lit(None).cast(batch[c].dataType).alias(c) for c in missing_columns(target.schema, batch)))


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Without columns that are null everywhere."""
    counts = df.agg(*(F.count(f"`{c}`").alias(c) for c in df.columns)).first()
    return df.select(*(c for c in df.columns if counts[c]))


def flatten(df: DataFrame, separator: str = "_") -> DataFrame:
    """Struct fields, however deep, as columns with joined names in lower case."""

    def walk(prefix: list[str], kind: T.StructType) -> list[Column]:
        out = []
        for f in kind:
            path = [*prefix, f.name]
            if isinstance(f.dataType, T.StructType):
                out += walk(path, f.dataType)
            else:
                out.append(F.col(".".join(f"`{p}`" for p in path)).alias(separator.join(path).lower()))
        return out

    return df.select(*walk([], df.schema))

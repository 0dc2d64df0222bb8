"""Column work (P1-P7, P10): names, projections, casts, recodes."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Ridership borough codes and the names they stand for.
BOROUGH_NAMES = {"Q": "Queens", "BX": "Bronx", "M": "Manhattan", "BK": "Brooklyn"}


def lowercase_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name; names colliding after lower-casing
    raise instead of silently producing an ambiguous frame."""
    lowered = [c.lower() for c in df.columns]
    dupes = sorted({c for c in lowered if lowered.count(c) > 1})
    if dupes:
        raise ValueError(f"column names collide after lower-casing: {dupes}")
    return df.toDF(*lowered)


def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop named columns; names not present are ignored."""
    return df.drop(*cols)


def keep_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Keep the listed columns, in the listed order."""
    return df.select(*cols)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename several columns at once (absent names are ignored)."""
    return df.withColumnsRenamed(dict(mapping))


def tolerant_cast(c: Column | str, dtype: str) -> Column:
    """P5: cast that yields NULL on malformed input (ANSI-safe). Whole numbers
    go through a decimal, so text such as "12.0" keeps its value (and "12.7"
    is cut to 12), as a lenient cast does."""
    col = F.col(c) if isinstance(c, str) else c
    if dtype in ("int", "bigint", "long"):
        return col.try_cast("decimal(38,6)").try_cast(dtype)
    return col.try_cast(dtype)


def cast_losses(df: DataFrame, column: str, dtype: str) -> DataFrame:
    """How many non-empty values `tolerant_cast` turns into NULL."""
    text = F.trim(F.col(column).cast("string"))
    lost = (text != "") & tolerant_cast(column, dtype).isNull()
    return df.agg(F.count_if(lost).alias("lost"))


def cast_to_schema(df: DataFrame, schema: StructType,
                   allow_missing: bool = True) -> DataFrame:
    """Conform a frame to a template schema **by name**.

    Columns come out in the template's order and types; a template column the
    frame lacks becomes a typed NULL when `allow_missing`, columns not in the
    template are dropped, and uncastable values become NULL.
    """
    have = {c.lower(): c for c in df.columns}
    out = []
    for field in schema.fields:
        src = have.get(field.name.lower())
        if src is None:
            if not allow_missing:
                raise ValueError(f"column {field.name!r} missing")
            out.append(F.lit(None).cast(field.dataType).alias(field.name))
        else:
            out.append(F.col(src).try_cast(field.dataType).alias(field.name))
    return df.select(*out)


def recode(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """P10: code -> name with pass-through for unknown codes."""
    col = F.col(c) if isinstance(c, str) else c
    expr = None
    for code, name in mapping.items():
        expr = (F.when(col == code, name) if expr is None
                else expr.when(col == code, name))
    return col if expr is None else expr.otherwise(col)


def recode_borough(df: DataFrame, column: str = "borough") -> DataFrame:
    """P10 on the ridership feed's borough codes."""
    return df.withColumn(column, recode(column, BOROUGH_NAMES))

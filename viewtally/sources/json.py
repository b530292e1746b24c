"""Schema discovery for JSON payloads (SRC-7) without an RDD round trip."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: what ``infer_schema`` finds in no rows, or in empty objects only
EMPTY_SCHEMA = "STRUCT<>"


def json_object(col: str = "value") -> Column:
    """Whether the text is a JSON object with at least one field."""
    return F.coalesce(F.size(F.json_object_keys(col)) > 0, F.lit(False))


def infer_schema(df: DataFrame, col: str = "value") -> str:
    """DDL schema of the JSON objects in ``col``, merged over all rows by a
    distributed aggregate (one small result row)."""
    row = df.select(F.schema_of_variant_agg(F.try_parse_json(col)).alias("s")).first()
    if not row or row["s"] is None or row["s"] == "VOID":
        return EMPTY_SCHEMA
    # variant schemas spell structs OBJECT<...>; DDL for from_json wants STRUCT<...>
    return re.sub(r"\bOBJECT<", "STRUCT<", row["s"])


def parse_with(df: DataFrame, schema: str, col: str = "value") -> DataFrame:
    """Typed columns of the JSON in ``col`` (PRJ-2 + SRC-7)."""
    return df.select(F.from_json(col, schema).alias("j")).select("j.*")

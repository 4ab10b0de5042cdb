"""Small CSV tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

# Quotes are doubled inside quoted cells, and these may hold line breaks.
_OPTIONS = {
    "header": True,
    "nullValue": "",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": False,
    "escape": '"',
    "multiLine": True,
}


def read_seed(
    spark: SparkSession,
    path: str,
    column_types: Mapping[str, str] | None = None,
    quote_columns: bool = False,
) -> DataFrame:
    """A CSV file with a header; types come from the values unless ``column_types`` names them.

    Column names are lower-cased unless ``quote_columns`` keeps their letter case.
    Empty cells are NULL. Types are found by one extra pass over the file: give
    every column a type to avoid it on larger files.
    """
    wanted = {name.lower(): kind for name, kind in (column_types or {}).items()}
    header = spark.read.options(**_OPTIONS).csv(path).columns
    plain = [name.lstrip("﻿") for name in header]
    if all(name.lower() in wanted for name in plain):
        found = dict.fromkeys(header)
    else:
        inferred = spark.read.options(**_OPTIONS, inferSchema=True).csv(path).schema
        found = {field.name: field.dataType for field in inferred}
    schema = StructType(
        [
            StructField(
                name if quote_columns else name.lower(),
                StructType.fromDDL(f"value {wanted[name.lower()]}")[0].dataType
                if name.lower() in wanted
                else found[original],
            )
            for original, name in zip(header, plain, strict=True)
        ]
    )
    return spark.read.options(**_OPTIONS).schema(schema).csv(path)

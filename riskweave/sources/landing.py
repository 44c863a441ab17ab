"""Landing files: delimited text with inconsistent NULL spellings, read by header, loaded by name."""

from __future__ import annotations

import csv
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that mean "no value".
NULL_TOKENS = ("NULL", "null", "NA", "")

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "mode": "FAILFAST"}

# one bit per kind of text seen in a column
_WHOLE, _DECIMAL, _BOOLEAN, _TEXT, _LONG = 1, 2, 4, 8, 16
_NAMED = {"bigint": T.LongType(), "decimal(38,0)": T.DecimalType(38, 0), "double": T.DoubleType(), "boolean": T.BooleanType(), "string": T.StringType()}


def headers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(header, files): the different first lines of the files at ``path`` and who has them.

    Lines are passed through tasks as they are, only the first of every file goes on; a file
    without a line has no header.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = None
        for batch in batches:
            files = batch.column(1).to_pylist()
            rows = [i for i, file in enumerate(files) if file != (files[i - 1] if i else seen)]
            seen = files[-1] if files else seen
            yield batch.take(pa.array(rows, pa.int64())).select([0, 1])

    found = lines.filter("start = 0").mapInArrow(first, "header string, file string")
    return found.groupBy("header").agg(F.sort_array(F.collect_set("file")).alias("files")).orderBy("header")


def read_landing(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> DataFrame:
    """Every column as text, NULL spellings resolved.  Compressed files are read by extension.

    Each file is read by its own header: files of one header together, then all are united by
    column name regardless of case, NULL where a file lacks a column.  Names are spelt, and stand,
    as in the first header in sorted order that has them.  A header is one line.  A gzip file
    cannot be split, so land many moderate files rather than one large one.
    """
    reader = spark.read.options(**CSV_OPTIONS, multiLine=multi_line, enforceSchema=False)
    # bounded: one row per different header, with the paths of the files that are read
    groups = headers(spark, path).collect()
    if not groups:
        return normalize_nulls(reader.csv(path))
    parts, names = [], {}
    for group in groups:
        columns = next(csv.reader([group["header"]]))
        if len({c.lower() for c in columns}) < len(columns):
            raise ValueError(f"columns of {group['files'][0]} differ only by case: {columns}")
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        parts.append(normalize_nulls(reader.schema(schema).csv([unquote(f) for f in group["files"]])))
        names |= {c.lower(): names.get(c.lower(), c) for c in columns}
    united = parts[0]
    for part in parts[1:]:
        united = united.unionByName(part, allowMissingColumns=True)
    return united.toDF(*[names[c.lower()] for c in united.columns])


def write_landing(df: DataFrame, path: str, null_token: str = "NA", compression: str = "gzip") -> None:
    """Write ``df`` as landing files; replaces what is at ``path``."""
    df.write.mode("overwrite").options(
        header=True, quote='"', escape='"', nullValue=null_token, compression=compression
    ).csv(path)


def normalize_nulls(df: DataFrame, tokens: tuple[str, ...] = NULL_TOKENS) -> DataFrame:
    """NULL wherever a text column holds exactly one of ``tokens``."""
    spelled = ", ".join("'" + t.replace("'", "\\'") + "'" for t in tokens)
    return df.selectExpr(
        *[
            f"CASE WHEN `{c}` IN ({spelled}) THEN NULL ELSE `{c}` END AS `{c}`" if kind == "string" else f"`{c}`"
            for c, kind in df.dtypes
        ]
    )


def column_catalog(df: DataFrame) -> DataFrame:
    """Position, name, inferred type and number of values of every column of an all-text table.

    The type is the narrowest of bigint, decimal(38,0), double and boolean that every value fits,
    else string; whole numbers of 19 and more digits never become doubles, which would lose digits.
    Cells are summed up by column name inside the tasks to a bit mask and a count per column; only
    those travel.  Turning cells into rows keeps the plan small for tables of hundreds of columns.
    Patterns decide, not trial casts: a failed cast raises and discards an exception per value.
    """
    names = F.array(*[F.lit(c) for c in df.columns])
    cells = df.unpivot([], df.columns, "column_name", "value")
    mask = F.expr(
        f"CASE WHEN value IS NULL THEN 0"
        f" WHEN value RLIKE '^[+-]?[0-9]{{1,18}}$' THEN {_WHOLE}"
        f" WHEN value RLIKE '^[+-]?[0-9]{{19,38}}$' THEN {_LONG}"
        f" WHEN value RLIKE '^[+-]?[0-9]{{39,}}$' THEN {_TEXT}"
        f" WHEN value RLIKE '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$' THEN {_DECIMAL}"
        f" WHEN lower(value) IN ('true', 'false') THEN {_BOOLEAN}"
        f" ELSE {_TEXT} END"
    )
    profiles = cells.groupBy("column_name").agg(F.bit_or(mask).alias("mask"), F.count("value").alias("n_values"))
    return profiles.select(
        F.array_position(names, F.col("column_name")).alias("ordinal"),
        "column_name",
        F.when(F.col("mask") == _WHOLE, "bigint")
        .when(F.col("mask").isin(_LONG, _WHOLE | _LONG), "decimal(38,0)")
        .when(F.col("mask").isin(_DECIMAL, _WHOLE | _DECIMAL), "double")
        .when(F.col("mask") == _BOOLEAN, "boolean")
        .otherwise("string")
        .alias("data_type"),
        "n_values",
    )


def infer_schema(df: DataFrame) -> T.StructType:
    """The schema :func:`column_catalog` finds."""
    # bounded: one row per column; an empty table has none
    found = {r["column_name"]: r["data_type"] for r in column_catalog(df).collect()}
    return T.StructType([T.StructField(c, _NAMED[found.get(c, "string")]) for c in df.columns])


def load_by_name(df: DataFrame, target: T.StructType) -> DataFrame:
    """``df`` in the shape of ``target``: columns matched by name regardless of case.

    Columns the source lacks are NULL, columns the target lacks are dropped.  A text that does not
    fit its column's type raises.
    """
    found = {c.lower(): c for c in df.columns}
    if len(found) != len(df.columns):
        raise ValueError("source columns differ only by case")
    return df.selectExpr(
        *[
            f"CAST({'`' + found[f.name.lower()] + '`' if f.name.lower() in found else 'NULL'}"
            f" AS {f.dataType.simpleString()}) AS `{f.name}`"
            for f in target.fields
        ]
    )

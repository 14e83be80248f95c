"""Scans. One scan per distinct header, only the bound columns, one common schema."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from serieskit.functions.scalars import null_tokens
from serieskit.sources.columns import bind
from serieskit.sources.discovery import CSV, InputFile


def scan_csv_text(spark: SparkSession, paths: Sequence[str], headers: Sequence[str]) -> DataFrame:
    """CSV with every column as text; the usual missing-value words become NULL."""
    schema = T.StructType([T.StructField(h, T.StringType()) for h in headers])
    df = spark.read.options(**CSV).schema(schema).csv(list(paths))
    return df.withColumns({h: null_tokens(F.col(f"`{h}`")) for h in headers})


def scan_parquet(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return spark.read.parquet(*paths)


def read_aliased(
    spark: SparkSession,
    files: Sequence[InputFile],
    aliases: Mapping[str, Sequence[str]],
    optional: Sequence[str] = (),
) -> DataFrame:
    """All files as one frame plus ``source_file``; each header binds on its own.

    A column keeps its stored type where all files agree on it, and is text otherwise.
    """
    groups: dict[tuple, list[str]] = defaultdict(list)
    for f in files:
        groups[(f.suffix, f.headers)].append(f.path)
    scans, kinds = [], defaultdict(set)
    for (suffix, headers), paths in groups.items():
        scan = scan_csv_text(spark, paths, headers) if suffix == ".csv" else scan_parquet(spark, paths)
        bound = bind(headers, aliases, optional)
        scans.append((scan, bound))
        for name, header in bound.items():
            kinds[name].add(scan.schema[header].dataType.simpleString())
    parts = []
    for scan, bound in scans:
        columns = [(F.col(f"`{h}`") if len(kinds[n]) == 1 else F.col(f"`{h}`").cast("string")).alias(n) for n, h in bound.items()]
        parts.append(scan.select(*columns, F.col("_metadata.file_path").alias("source_file")))
    return union_sources(parts)


def union_sources(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

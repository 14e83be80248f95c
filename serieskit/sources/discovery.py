"""Finding input files by their headers.

All heads of CSV files are read by one job, a file a task, which ends at the first line. Footers of Parquet files are read
side by side without a job.
"""

from __future__ import annotations

import csv
import re
import warnings
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession, functions as F

from serieskit.sources.columns import find_column

SUFFIXES = (".csv", ".parquet")
# A quote inside a quoted cell is written twice.
CSV = {"header": True, "quote": '"', "escape": '"'}


@dataclass(frozen=True)
class InputFile:
    path: str
    size: int
    headers: tuple[str, ...]

    @property
    def suffix(self) -> str:
        return re.search(r"\.[^./]*$", self.path).group().lower()

    @property
    def stem(self) -> str:
        return re.sub(r"\.[^./]*$", "", self.path.rsplit("/", 1)[-1])


# More than any file holds: as the cost of opening one, it gives every file a task of its own.
WHOLE_FILE = 1 << 50


def _first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first line with text; nothing after it is read."""
    for batch in batches:
        for path, line in zip(batch.column("path").to_pylist(), batch.column("value").to_pylist()):
            if line.strip("\ufeff\r "):
                yield pa.RecordBatch.from_pydict({"path": [path], "head": [line]})
                return


def csv_heads(spark: SparkSession, paths: Sequence[str]) -> dict[str, tuple[str, ...]]:
    """Headers of CSV files by path, from one job. A file without a line has none."""
    if not paths:
        return {}
    probe = spark.newSession()
    probe.conf.set("spark.sql.files.maxPartitionBytes", WHOLE_FILE)
    probe.conf.set("spark.sql.files.openCostInBytes", WHOLE_FILE)
    probe.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1)
    lines = probe.read.text(list(paths)).select(F.col("_metadata.file_path").alias("path"), "value")
    # Rows carry their file as a URI, the listing as a plain path.
    listed, heads = {_plain_path(p): p for p in paths}, {}
    for path, head in lines.mapInArrow(_first_lines, "path string, head string").collect():
        cells = next(csv.reader([head.strip("\ufeff").rstrip("\r")]))
        heads[listed.get(_plain_path(unquote(path)), path)] = tuple(_as_spark(cells))
    return heads


def _plain_path(path: str) -> str:
    return re.sub(r"^file:/+", "/", path)


def _as_spark(cells: list[str]) -> list[str]:
    """Names as Spark's CSV reader gives them: empty ones by place, repeated ones with their place."""
    lower = [c.lower() for c in cells]
    return [f"_c{i}" if not c else f"{c}{i}" if lower.count(c.lower()) > 1 else c for i, c in enumerate(cells)]


def parquet_heads(spark: SparkSession, paths: Sequence[str]) -> dict[str, tuple[str, ...]]:
    """Columns of Parquet files by path, from their footers alone."""
    if not paths:
        return {}
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def footer(path: str) -> tuple[str, ...]:
        source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(path), conf)
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
        try:
            return tuple(f.getName() for f in reader.getFileMetaData().getSchema().getFields())
        finally:
            reader.close()

    heads = {}
    with ThreadPoolExecutor(16) as pool:
        for path, found in zip(paths, pool.map(lambda p: _or_warn(footer, p), paths)):
            if found is not None:
                heads[path] = found
    return heads


def _or_warn(read, path: str):
    try:
        return read(path)
    except (PySparkException, Py4JJavaError, OSError, ValueError) as problem:
        warnings.warn(f"skipped unreadable file {path}: {str(problem)[:200]}", stacklevel=2)
        return None


def listing(spark: SparkSession, root: str) -> list[tuple[str, int]]:
    """Paths and sizes below ``root`` on any file system Spark can reach; no content is read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.{csv,parquet,CSV,PARQUET}")
        .load(root)
        .select("path", "length")
    )
    return sorted((row.path, row.length) for row in files.collect())


def discover(
    spark: SparkSession,
    root: str,
    measure_aliases: Sequence[str],
    explicit: str | None = None,
    single: bool = False,
    prefer_parquet: bool = False,
    years: tuple[int, int] | None = None,
) -> list[InputFile]:
    """Files that carry the measure column, narrowed by the given rules."""
    if explicit and not explicit.lower().endswith(SUFFIXES):
        raise FileNotFoundError(f"{explicit} is neither CSV nor Parquet")
    found = listing(spark, explicit or root)
    # What the name alone rules out is never opened.
    named = [InputFile(path, size, ()) for path, size in found]
    in_window = {f.path for f in named if explicit or not years or not re.fullmatch(r"20[0-9]{2}", f.stem) or years[0] <= int(f.stem) <= years[1]}
    opened = [f for f in named if f.path in in_window]
    heads = csv_heads(spark, [f.path for f in opened if f.suffix == ".csv"]) | parquet_heads(spark, [f.path for f in opened if f.suffix == ".parquet"])
    files = [InputFile(f.path, f.size, heads[f.path]) for f in opened if find_column(heads.get(f.path, ()), measure_aliases, False)]
    if not files and len(in_window) < len(found):
        raise FileNotFoundError("no file overlaps the date window")
    if not files:
        raise FileNotFoundError(f"no compatible file under {explicit or root}")
    if single and len(files) > 1:
        raise ValueError("several compatible files; name the intended one as input path")
    if prefer_parquet:
        stored = {f.stem for f in files if f.suffix == ".parquet"}
        files = [f for f in files if f.suffix == ".parquet" or f.stem not in stored]
    return files

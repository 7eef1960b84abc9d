"""Batch scans of raw event files (gzip-transparent newline-delimited JSON)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventmart.schema import CORRUPT_COLUMN, event_schema, with_corrupt_column


_HOUR_SPEC = re.compile(r"\s*(\d{1,2})\s*(?:-\s*(\d{1,2})\s*)?")


def parse_hours(hours: str) -> list[int]:
    """The hours of a day that a text such as '7' or '0-23' names, both ends included."""
    spec = _HOUR_SPEC.fullmatch(hours)
    first, last = (int(spec[1]), int(spec[2] or spec[1])) if spec else (1, 0)
    if first > last or last > 23:
        raise ValueError(f"{hours!r} is neither an hour of a day nor a range of them")
    return [*range(first, last + 1)]


def hour_paths(base: str, day: str, hours: str = "0-23", suffix: str = ".json.gz") -> list[str]:
    """Paths of the hourly archive files of one UTC day (hour not zero-padded)."""
    base = base.rstrip("/")
    return [f"{base}/{day}-{h}{suffix}" for h in parse_hours(hours)]


def expand_paths(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Files that the paths or globs name, through the session's file systems, in
    the given order (what one glob names is sorted).

    A path or glob that names nothing is an error: an hour that was never
    fetched must stop the day, not shorten it.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found, absent = [], []
    for path in paths:
        pattern = jvm.org.apache.hadoop.fs.Path(path)
        hits = sorted(st.getPath().toString() for st in (pattern.getFileSystem(conf).globStatus(pattern) or []))
        found += hits
        if not hits:
            absent.append(path)
    if absent:
        raise FileNotFoundError(f"{len(absent)} of {len(paths)} inputs are absent: {', '.join(absent)}")
    return found


def parse_lines(
    lines: DataFrame,
    schema: StructType | str | None = None,
    value_col: str = "value",
    corrupt_col: str | None = None,
) -> DataFrame:
    """Parse a column of JSON text into the declared columns.

    With ``corrupt_col`` set, parsing is PERMISSIVE and a line that does not
    parse keeps its raw text in that column (all other fields null); without
    it, a bad line becomes an all-null row.
    """
    schema = schema or event_schema()
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    options = {"mode": "PERMISSIVE"}
    if corrupt_col:
        schema = with_corrupt_column(schema, corrupt_col)
        options["columnNameOfCorruptRecord"] = corrupt_col
    parsed = F.from_json(F.col(value_col).cast("string"), schema, options)
    return lines.select(parsed.alias("_e")).select("_e.*")


def read_events(
    spark: SparkSession,
    paths: str | list[str],
    schema: StructType | None = None,
    corrupt_col: str | None = None,
) -> DataFrame:
    """Explicit-schema scan of JSON event files (a glob or a list of paths).

    gzip files are decompressed transparently; each is one task since gzip
    does not split. Without a corrupt column this is the JSON reader with the
    declared schema (nested-column pruning reaches the parser). With one, the
    lines are read as text and parsed by ``parse_lines`` so that the corrupt
    column can be counted on its own without caching the whole scan.
    """
    schema = schema or event_schema()
    if corrupt_col is None:
        return spark.read.schema(schema).json(paths)
    text = spark.read.text(paths)
    # like the JSON reader: blank lines are not records
    text = text.filter(F.length(F.trim(F.col("value"))) > 0)
    return parse_lines(text, schema, "value", corrupt_col)


def parse_health(df: DataFrame, corrupt_col: str = CORRUPT_COLUMN) -> DataFrame:
    """One row: total lines read and lines that did not parse."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count(F.col(corrupt_col)).alias("corrupt"),
    )


def check_health(health: DataFrame, expected_rows: int | None = None) -> None:
    """Fails when a line did not parse, or when not exactly ``expected_rows`` were read."""
    total, corrupt = health.select("total", "corrupt").first()
    if corrupt:
        raise ValueError(f"{corrupt} of {total} lines do not parse with the declared schema")
    if expected_rows is not None and total != expected_rows:
        raise ValueError(f"{total} lines were read where {expected_rows} were expected")

"""As-of reads over rows that carry the version that wrote them.

A version adds rows; it may also *replace* partitions, which hides the rows
that earlier versions wrote there. Both are plain tables here (a column of
versions, a table of replacements), so a snapshot as of any version and the
history are ordinary filters, aggregates and joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_of(rows: DataFrame, version: int, version_col: str = "version", part_col: str | None = None,
          replaced: DataFrame | None = None) -> DataFrame:
    """The rows visible as of ``version``.

    ``replaced``: (version, part) for each partition value a version replaced;
    a row of an earlier version in that partition is hidden from then on. The
    last replacement per partition is joined to the rows, null-safe.
    """
    seen = rows.filter(F.col(version_col) <= version)
    if replaced is None:
        return seen
    last = (replaced.filter(F.col("version") <= version).groupBy(F.col("part").alias("_part"))
            .agg(F.max("version").alias("_since")))
    joined = seen.join(last, F.col(part_col).eqNullSafe(F.col("_part")), "left")
    hidden = F.coalesce(F.col(version_col) < F.col("_since"), F.lit(False))
    return joined.filter(~hidden).select(*rows.columns)


def history(rows: DataFrame, version_col: str = "version", count_name: str = "num_output_rows") -> DataFrame:
    """Rows written per version, in order."""
    return rows.groupBy(version_col).agg(F.count(F.lit(1)).alias(count_name)).orderBy(version_col)

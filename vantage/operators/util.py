"""Small plan helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest row count we are willing to ship to every task as a broadcast.
DEFAULT_BROADCAST_ROWS = 200_000
# Largest size of those rows, as JSON text, that we are willing to ship.
MAX_BROADCAST_BYTES = 32 << 20

# Rows of a large table that one task sorts or groups.
PART_ROWS = 250_000
# Up to this many rows, exchanges are left to AQE, which merges small partitions.
AQE_ROWS = 16 * PART_ROWS


def parts_of(df: DataFrame) -> int:
    """Partitions of about ``PART_ROWS`` rows that ``df`` fills; 0 for a table
    that is best left to AQE. Counts the rows (of a Parquet table: from its footers)."""
    rows = df.count()
    return 0 if rows <= AQE_ROWS else -(-rows // PART_ROWS)


def dealt(df: DataFrame, parts: int, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` to ``parts`` partitions, which AQE doesn't merge."""
    return df.repartition(parts, *keys) if parts else df


def has_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (reads at most max_rows+1 per task)."""
    return df.limit(max_rows + 1).count() <= max_rows


def is_small(df: DataFrame, max_rows: int, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether ``df`` is within both bounds (reads at most max_rows+1 rows per task)."""
    size = F.octet_length(F.to_json(F.struct("*")))
    n, total = df.limit(max_rows + 1).select(size.alias("b")).agg(F.count(F.lit(1)), F.sum("b")).first()
    return n <= max_rows and (total or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                       probe: DataFrame | None = None) -> DataFrame:
    """Broadcast hint only behind a checked size; otherwise leave the join to
    the planner (shuffle join, or a runtime broadcast chosen by AQE).

    ``probe`` is a cheaper frame with at least as many rows as ``df`` (e.g. the
    raw table a dedupe is computed from).
    """
    return F.broadcast(df) if is_small(probe if probe is not None else df, max_rows) else df


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (for comparisons with another engine)."""
    cols = [
        F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*cols)

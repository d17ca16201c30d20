"""Result sinks: CSV tables, JSON records, text reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with header; ``single_file`` is for small result tables only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).option("nullValue", "").csv(path)


def write_json(df: DataFrame, path: str, single_file: bool = False) -> None:
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_report(df: DataFrame, path: str, formats: dict[str, str] | None = None) -> None:
    """Fixed-width text report of a small table, one line per row under a header line."""
    formats = formats or {}
    kinds = dict(df.dtypes)

    def default(c):
        return "%12.6f" if kinds[c] in ("double", "float") else "%12d" if kinds[c] in ("int", "bigint") else "%-24s"
    line = F.format_string(" ".join(formats.get(c, default(c)) for c in df.columns), *[F.col(c) for c in df.columns])
    header = " ".join(f"{c:<24}" if kinds[c] == "string" else f"{c:>12}" for c in df.columns)
    body = df.select(F.lit(1).alias("o"), F.monotonically_increasing_id().alias("i"), line.alias("value"))
    head = df.sparkSession.range(1).select(F.lit(0).alias("o"), F.lit(0).cast("long").alias("i"), F.lit(header).alias("value"))
    head.unionByName(body).coalesce(1).sortWithinPartitions("o", "i").select("value").write.mode("overwrite").text(path)

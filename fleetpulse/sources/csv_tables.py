"""CSV tables in and out.

Reads bind columns by header name check (`enforceSchema=false`): a file
whose header is not the schema's column order fails instead of
silently moving values into the wrong columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import nan_to_null
from ..schemas import METRICS, WIDE_SCHEMA, Metric


def _read_csv(spark: SparkSession, schema, path: str, recursive: bool = False) -> DataFrame:
    r = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
    )
    if recursive:
        r = r.option("recursiveFileLookup", True)
    return with_lines(r.csv(path))


def _texts(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def one_line(df: DataFrame) -> DataFrame:
    """Text columns without line breaks, for CSV: a break would end the row.

    `%0A` and `%0D` stand for them; a percent sign is written `%25` only
    where it would read as one of these three.
    """
    def plain(c):
        safe = F.regexp_replace(c, "%(?=25|0A|0D)", "%25")
        return F.replace(F.replace(safe, F.lit("\n"), F.lit("%0A")), F.lit("\r"), F.lit("%0D"))

    return df.withColumns({c: plain(F.col(c)) for c in _texts(df)})


def with_lines(df: DataFrame) -> DataFrame:
    """Inverse of `one_line`."""
    def back(c):
        lines = F.replace(F.replace(c, F.lit("%0A"), F.lit("\n")), F.lit("%0D"), F.lit("\r"))
        return F.replace(lines, F.lit("%25"), F.lit("%"))

    return df.withColumns({c: back(F.col(c)) for c in _texts(df)})


def _nan_free(df: DataFrame, measures) -> DataFrame:
    return df.select(*[nan_to_null(F.col(c)).alias(c) if c in measures else F.col(c) for c in df.columns])


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """Wide samples with header (S1); NaN measures read as null."""
    df = _read_csv(spark, WIDE_SCHEMA, path)
    return _nan_free(df, ("cpu_pct", "mem_pct", "net_in", "net_out", "disk_io"))


def read_metric(spark: SparkSession, metric: Metric | str, path: str, recursive: bool = False) -> DataFrame:
    """A landed metric table, typed (S2-S5). Bad numbers and NaN -> null.

    `recursive=True` reads a table landed by a stream, one folder per
    micro-batch, without turning the folder names into a column.
    """
    m = METRICS[metric] if isinstance(metric, str) else metric
    return _nan_free(_read_csv(spark, m.schema, path, recursive), m.measures)


def read_table(spark: SparkSession, metric: Metric | str, path: str, fmt: str = "csv", recursive: bool = False) -> DataFrame:
    """A landed metric table in any file format; CSV goes through `read_metric`.

    Parquet (recommended at scale) lets scans read only the columns a
    plan uses. NaN measures read as null in every format (D5).
    """
    m = METRICS[metric] if isinstance(metric, str) else metric
    if fmt == "csv":
        return read_metric(spark, m, path, recursive)
    r = spark.read.schema(m.schema)
    if recursive:
        r = r.option("recursiveFileLookup", True)
    return _nan_free(r.format(fmt).load(path), m.measures)


# Spark's CSV writer trims leading and trailing spaces by default (the
# reader does not); values must come back as they were written.
CSV_WRITE_OPTIONS = {"header": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with header; null as an empty field; text kept exactly (line breaks as `one_line` writes them)."""
    one_line(df).write.mode(mode).options(**CSV_WRITE_OPTIONS).csv(path)


def land_metrics(decoded: DataFrame, base_path: str, metrics: tuple[str, ...], mode: str = "overwrite") -> dict[str, str]:
    """Write each metric's routed rows as its own CSV table.

    `decoded` is the output of `records.decode`, read once per metric
    table here; cache it first if its source is expensive. A metric
    without records still gets a readable table with the right header:
    Spark writes a header-only file for an empty DataFrame.
    """
    from ..operators.records import route

    paths = {}
    for name in metrics:
        path = f"{base_path.rstrip('/')}/{name}"
        write_table(route(decoded, METRICS[name]), path, mode)
        paths[name] = path
    return paths


def sort_alerts(df: DataFrame) -> DataFrame:
    """Total order of alert rows by server and window labels (O1), or by
    the windows' times where the rows have them (D8)."""
    if "window_start_time" in df.columns:
        return df.orderBy("server_id", "window_start_time", "window_end_time")
    return df.orderBy("server_id", "window_start", "window_end")


def read_alerts(spark: SparkSession, schema: T.StructType, path: str) -> DataFrame:
    """Alert rows as `write_alerts` or a stream wrote them."""
    return with_lines(spark.read.schema(schema).option("header", True).csv(path))


def write_alerts(df: DataFrame, path: str, single_file: bool = False, seen: Observation | None = None) -> None:
    """Sorted alerts as CSV with header, overwriting.

    `single_file=True` gives the reference's one part file; it funnels
    the output through one task, so leave it off for large results (the
    sorted parts are already in order by file name). `seen` gets the
    number of rows written, as `rows`.
    """
    out = sort_alerts(df)
    if seen is not None:
        out = out.observe(seen, F.count(F.lit(1)).alias("rows"))
    if single_file:
        out = out.coalesce(1)
    write_table(out, path)

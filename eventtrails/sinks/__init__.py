"""CSV sinks: ``;``-separated result directories and node/edge exports."""

from __future__ import annotations

import uuid

from pyspark.errors import UnsupportedOperationException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.curve import curve_key
from ..operators.filters import CURVE_KEY
from ..sources.events import TABLE_COLUMNS, header_line, to_lines


def write_csv(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    single_file: bool = False,
    date_format: str = "yyyy-MM-dd",
) -> None:
    """Write ``df`` as a ``;``-separated CSV directory with a header line.

    Blank strings are kept as written (the writer's default trimming is
    off), so a ``" "`` city round-trips. ``single_file=True`` gives one file in
    the frame's order with one header: all tasks write their parts, which are
    then joined in order by the file system, not by a task. HDFS joins them by
    their blocks, without moving data; a file system that cannot is given the
    parts' bytes one after another in constant memory.
    """
    if single_file:
        _write_single(df, path, mode, date_format)
    else:
        _csv(df, mode, date_format, header=True).csv(path)


def _csv(df: DataFrame, mode: str, date_format: str, header: bool):
    return (
        df.write.mode(mode)
        .option("sep", ";")
        .option("header", header)
        .option("dateFormat", date_format)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )


def _write_single(df: DataFrame, path: str, mode: str, date_format: str) -> None:
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(conf)
    mode = mode.lower()
    if mode not in ("append", "overwrite", "ignore", "error", "errorifexists"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode not in ("append", "overwrite") and fs.exists(target):
        if mode == "ignore":
            return
        raise FileExistsError(path)
    # beside the target, on its file system; names with an underscore are not read as data
    work = f"{path.rstrip('/')}/_parts-{uuid.uuid4().hex}"
    try:
        _csv(df.limit(0), "errorifexists", date_format, header=True).csv(f"{work}/header")
        _csv(df, "errorifexists", date_format, header=False).csv(f"{work}/rows")
        if mode == "overwrite":
            for old in fs.listStatus(target):
                if old.getPath().getName() != work.rsplit("/", 1)[-1]:
                    fs.delete(old.getPath(), True)
        (head,) = _parts(jvm, fs, f"{work}/header")
        rows = _parts(jvm, fs, f"{work}/rows")
        name = f"{path.rstrip('/')}/part-{uuid.uuid4().hex}.csv"
        fs.rename(_joined(spark, fs, head, rows, f"{work}/joined.csv"), jvm.org.apache.hadoop.fs.Path(name))
    finally:
        fs.delete(jvm.org.apache.hadoop.fs.Path(work), True)


def _parts(jvm, fs, folder: str) -> list:
    """The files with content that the tasks wrote, in the order of the tasks."""
    files = [f for f in fs.listStatus(jvm.org.apache.hadoop.fs.Path(folder)) if f.getPath().getName().startswith("part-") and f.getLen()]
    return [f.getPath() for f in sorted(files, key=lambda f: int(f.getPath().getName().split("-")[1]))]


def _joined(spark, fs, head, rows: list, path: str):
    """One file of ``head`` and ``rows``: ``head`` itself where files can be joined in place."""
    jvm = spark._jvm
    if not rows:
        return head
    array = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(rows))
    for k, p in enumerate(rows):
        array[k] = p
    try:
        fs.concat(head, array)
        return head
    except UnsupportedOperationException:
        pass
    joined = jvm.org.apache.hadoop.fs.Path(path)
    out = fs.create(joined)
    try:
        for p in [head, *rows]:
            part = fs.open(p)
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, 1 << 16, False)
            finally:
                part.close()
    finally:
        out.close()
    return joined


def write_graph(nodes: DataFrame, edges: DataFrame, path: str, mode: str = "errorifexists", single_file=False):
    """Write a node table to ``<path>/nodes`` and an edge table to ``<path>/edges``."""
    write_csv(nodes, f"{path}/nodes", mode=mode, single_file=single_file)
    write_csv(edges, f"{path}/edges", mode=mode, single_file=single_file)


def write_events_text(df: DataFrame, path: str, places: bool = False, mode: str = "errorifexists") -> None:
    """Write events in the ``;`` text format (header in the first file).

    The reader drops header lines wherever they occur, so one header row
    unioned into the output is enough.
    """
    spark = df.sparkSession
    header = spark.createDataFrame([(header_line(places),)], "value string")
    header.unionByName(to_lines(df, places=places)).write.mode(mode).text(path)


def write_events_table(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    partitions: int | None = None,
    layout: str = "date",
    rows_per_file: int = 2_000_000,
) -> None:
    """Write events once as a typed Parquet table (the scalable input form).

    Rows are range-partitioned by the keys of the ``layout`` (sampled bounds;
    the id comes last, so a busy key is split across tasks) and sorted within
    each task, so every file covers a narrow range of them and statistics let
    filters skip the other files and row groups:

    * ``date`` (time_norm, e_id): date ranges and trail windows;
    * ``actor`` (actor, time_norm, e_id): one actor's timeline and actor hops;
    * ``cell`` (5-degree latitude band, longitude band, time_norm, e_id): radius
      searches, whose latitude band is pushed down;
    * ``curve`` (a stored Z-order key, time_norm, e_id): radius searches that skip
      files by latitude and longitude (``read_events_table(curve=True)``).

    The number of files follows the number of rows (one count), not the cores.
    ``lat``/``lon`` are stored as scalar columns.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {sorted(LAYOUTS)}")
    cols = [c for c in TABLE_COLUMNS + ["city", "country"] if c in df.columns]
    out = df.select(*cols)
    if layout == "curve":
        out = out.withColumn(CURVE_KEY, curve_key())
    n = partitions or max(1, -(-out.count() // rows_per_file))
    keys = LAYOUTS[layout]()
    out.repartitionByRange(n, *keys).sortWithinPartitions(*keys).write.mode(mode).parquet(path)


def _bands() -> list:
    return [F.floor(F.col(c) / 5) for c in ("lat", "lon")]


#: Sort keys of the table layouts.
LAYOUTS = {
    "date": lambda: [F.col("time_norm"), F.col("e_id")],
    "actor": lambda: [F.col("actor"), F.col("time_norm"), F.col("e_id")],
    "cell": lambda: [*_bands(), F.col("time_norm"), F.col("e_id")],
    "curve": lambda: [F.col(CURVE_KEY), F.col("time_norm"), F.col("e_id")],
}


__all__ = ["write_csv", "write_events_table", "write_events_text", "write_graph"]

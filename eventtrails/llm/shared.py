"""Helpers of the corpus operators: shared tables, word patterns, bit filters."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space and word patterns of the corpus contracts.
WS_CHARS = " \t\n\x0b\x0c\r"
WS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: Slots of one filter block; one block is a 4 KB bitmap.
BLOCK_SLOTS = 32768


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; any
    other master must name one, since executors cannot see a driver's disk.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if d:
        return d.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by driver and executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-shared-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Gives Python workers this package, once per application.

    Functions that run in tasks are pickled by reference to their modules, which
    executors need not have on their path.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = Path(__file__).resolve().parents[2]
    path = f"{tempfile.mkdtemp(prefix='llm-code-')}/eventtrails_code.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted((top / "eventtrails").rglob("*.py")):
            z.write(f, f.relative_to(top))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def table(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back.

    Cuts the lineage so that a lost executor costs the rereading of files, and
    gives later plans the measured size. The folder's owner clears it.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df_or_columns, stem: str) -> str:
    """A column name that none of the frame's columns has (case is ignored)."""
    cols = getattr(df_or_columns, "columns", df_or_columns)
    taken = {c.lower() for c in cols}
    name = stem
    while name.lower() in taken:
        name = "_" + name
    return name


def text_or_empty(text: str | Column) -> Column:
    """The text; null counts as empty."""
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(c, F.lit(""))


def least_hashes(df: DataFrame, col: str, n: int) -> list[int]:
    """The ``n`` smallest distinct ``xxhash64`` of a column, ascending: a sample
    of its distinct values. Only hashes are shuffled, copies merged before."""
    rows = df.select(F.xxhash64(col).alias("u")).distinct().orderBy("u").limit(n).collect()
    return [r["u"] for r in rows]


def collapse_ws(text: Column) -> Column:
    """The text with every run of white space as one space."""
    return F.regexp_replace(text, WS, " ")


def filter_slots(rows: int, per_row: int, max_slots: int) -> int:
    """Slots of a bit filter for ``rows`` keys: a power of two, at least one
    block, at most ``max_slots`` (the bound on what is broadcast)."""
    n = BLOCK_SLOTS
    while n < rows * per_row and n < max_slots:
        n *= 2
    return n


def slot_block(slot: Column) -> Column:
    return F.floor(slot / F.lit(BLOCK_SLOTS)).cast("long")


def slot_bit(slot: Column) -> Column:
    return F.pmod(slot, F.lit(BLOCK_SLOTS)).cast("long")


def bit_is_set(bitmap: Column, bit: Column) -> Column:
    """Whether a 4 KB bitmap (null: empty) has the bit, in plain expressions."""
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))

"""Per-group picks that stay skew-safe."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

_SMALL = (T.ByteType, T.ShortType, T.IntegerType)


def latest_per_actor(df: DataFrame, actor: str = "actor") -> DataFrame:
    """The latest event row of each actor: greatest ``time_norm``, then ``e_id``.

    Date and id are packed into one long, whose maximum per actor is a hash aggregate
    over three columns, computed partially before the shuffle: an actor holding a large
    share of all rows costs one row per map task, and no split is sorted. The rows with
    their actor's maximum are then joined back (by broadcast where the actors are few).
    Rows that tie in date and id are ranked by their other columns, so the pick is
    deterministic (the original kept an arbitrary row); a null date or id comes last.
    Ids wider than an integer do not fit the packed long and take two maxima.
    """
    key, best, place = "_packed", "_best", "_place"
    by, day = F.col(actor), F.unix_date("time_norm").cast("long")
    if isinstance(df.schema["e_id"].dataType, _SMALL):
        # 33 bits for the id, 0 for none
        low = F.coalesce(F.col("e_id").cast("long") + F.lit((1 << 31) + 1), F.lit(0).cast("long"))
        # a null date is earlier than any other
        ranks = [F.shiftleft(F.coalesce(day, F.lit(-(1 << 30)).cast("long")), 33) + low]
    else:
        ranks = [day, F.col("e_id")]
    rows = df
    for n, rank in enumerate(ranks):
        ranked = rows.withColumn(f"{key}{n}", rank)
        top = ranked.groupBy(by.alias(f"{best}_{actor}")).agg(F.max(f"{key}{n}").alias(best))
        same = F.col(actor).eqNullSafe(F.col(f"{best}_{actor}")) & F.col(f"{key}{n}").eqNullSafe(F.col(best))
        rows = ranked.join(top, same, "left_semi")
    others = [F.col(c).desc() for c in df.columns if c not in (actor, "time_norm", "e_id")]
    first = Window.partitionBy(actor).orderBy(*(others or [F.lit(0)]))
    return rows.withColumn(place, F.row_number().over(first)).where(F.col(place) == 1).select(*df.columns)


def ordered(df: DataFrame, *cols: str) -> DataFrame:
    """Final order by date, then id (deterministic for equal dates)."""
    return df.orderBy(*(cols or ("time_norm", "e_id")))


def positions(df: DataFrame, name: str = "position", weight: str | None = None) -> DataFrame:
    """The rows of an ordered frame with their place in its order, from 1.

    A sorted frame's partitions follow one another, so a row's place is its place in
    its partition after the rows of the partitions before. The rows are written with
    their partition and place in it (nothing is brought into one task); only one count
    a partition comes to the driver and is sent out again. A row stands for as many as
    its ``weight`` says: its place is the first of theirs.
    """
    seq, part, before = "_seq", "_part", "_before"
    rows = cut_lineage(df.withColumn(seq, F.monotonically_increasing_id()))
    # the upper bits of that number are the partition's, the lower 33 the row's
    rows = rows.withColumn(part, F.shiftright(seq, 33).cast("int"))
    stands = F.lit(1) if weight is None else F.col(weight)
    sizes = sorted((r[part], r["size"]) for r in rows.groupBy(part).agg(F.sum(stands).alias("size")).collect())
    offsets, total = [], 0
    for p, n in sizes:
        offsets.append((p, total))
        total += n
    starts = df.sparkSession.createDataFrame(offsets, f"{part} int, {before} long")
    if weight is None:
        ahead = F.col(seq).bitwiseAND(F.lit((1 << 33) - 1))
    else:
        ahead = F.sum(stands).over(Window.partitionBy(part).orderBy(seq)) - stands
    place = F.col(before) + ahead + 1
    # one row a partition
    return rows.join(F.broadcast(starts), part).withColumn(name, place).drop(seq, part, before)

"""Event files as a stream.

The original work is batch only: each run re-reads a growing ``;`` text file
(the place enricher appends to it). The Structured Streaming form of that
input is a file stream over a directory of such files: each new file is
parsed with the same :func:`eventtrails.sources.parse_lines` expressions, so
the stateless searches (date range, near a point, actor's countries) run on
it unchanged with ``order=False`` (a total order is not defined on an
unbounded stream). :func:`enrich_stream` is the incremental enricher. Trails,
graphs and counts look back over all history and stay batch operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources.events import parse_lines


def read_events_stream(
    spark: SparkSession,
    path: str,
    places: bool = False,
    mode: str = "failfast",
    keep_blank: bool = False,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming event frame over new ``;`` text files arriving in ``path``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return parse_lines(reader.load(path), places=places, mode=mode, keep_blank=keep_blank)


def enrich_stream(
    events: DataFrame,
    gazetteer: DataFrame,
    out_path: str,
    checkpoint_location: str,
    max_km: float = 50.0,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Enrich arriving events with city/country and append them as text.

    The incremental form of the enricher, which appended each processed
    event to a 9-column file: every micro-batch of ``events`` (a stream from
    :func:`read_events_stream`) is a static frame, joined with the static
    ``gazetteer`` by :func:`eventtrails.plans.places.enrich_places` and
    appended to ``out_path`` in the ``;`` text format. The checkpoint
    location (shared storage on a cluster) makes restarts resume after the
    last committed batch; a retried batch rewrites its own files only.
    ``trigger`` is passed to ``DataStreamWriter.trigger`` (e.g.
    ``{"availableNow": True}``).
    """
    from ..plans.places import enrich_places
    from ..sinks import write_events_text

    def _batch(df: DataFrame, batch_id: int) -> None:
        write_events_text(
            enrich_places(df, gazetteer, max_km), f"{out_path}/batch={batch_id}", places=True, mode="overwrite"
        )

    w = events.writeStream.foreachBatch(_batch).option("checkpointLocation", checkpoint_location)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


__all__ = ["enrich_stream", "read_events_stream"]

"""The stateless steps on streams.

Parsing, flattening and the row-level checks keep no state, so the same functions take a
streaming frame; the year-on-year check orders a company's whole history and stays with batch.
Documents as they come: ``tables.page_tables``, ``tables.html_tables``, ``tables.unreadable`` and
``tables.html_text`` take streams as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators import checks, extract


def checked(records: DataFrame, current_year: int) -> DataFrame:
    """Range, unit, confidence and missing checks in their order on records as they come."""
    out = checks.single_check(records, checks.range_reason(current_year))
    out = checks.single_check(out, checks.unit_reason())
    out = checks.single_check(out, checks.confidence_reason())
    return checks.single_check(out, checks.missing_reason())


def records_from_responses(responses: DataFrame) -> DataFrame:
    """Extraction responses as they come to flat records."""
    return extract.flatten_results(extract.parsed_responses(responses).where("result is not null"))


def write(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return df.writeStream.format("parquet").option("checkpointLocation", checkpoint).start(path)


def write_once(df: DataFrame, path: str, checkpoint: str, work: Callable[[DataFrame], DataFrame] | None = None, available_now: bool = False) -> StreamingQuery:
    """Writes each batch of a stream to a folder of its own, ``batch=<number>``, over whatever a
    run that died had put there: after a restart the stream repeats its last open batch under the
    same number, so every row is there exactly once. ``work`` is done batch by batch, and may
    use what a stream cannot (windows, joins with stored tables). ``available_now``: ends when what
    is there by now is done."""

    def put(batch: DataFrame, number: int) -> None:
        (work(batch) if work else batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = df.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()

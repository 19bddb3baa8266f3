"""2.13: streams. Parsers and row-wise operators work on streaming frames as they are; here are the stateful forms."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from strandloom.sources.text import parse_sam


def windowed(events: DataFrame, width: str, slide: str | None = None, late: str = "0 seconds", by: tuple[str, ...] = ("event_type",), time: str = "ts") -> DataFrame:
    """Tumbling or sliding counts and sums by event time; rows later than ``late`` behind the newest are dropped in streams."""
    window = F.window(time, width, slide) if slide else F.window(time, width)
    out = events.withWatermark(time, late).groupBy(window.alias("w"), *by).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n", "total")


def sessions(events: DataFrame, gap: str, late: str = "0 seconds", by: str = "user_id", time: str = "ts") -> DataFrame:
    """Sessions of each key: rows with less than ``gap`` between them."""
    out = events.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("w"), by).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), by, "n", "total")


def sam_stream(lines: DataFrame) -> DataFrame:
    """Alignments of a stream of lines."""
    return parse_sam(lines)


def fixed_windows_stream(points: DataFrame, width: int, by: tuple[str, ...] = ("sequence",)) -> DataFrame:
    """Running c, t and n of coordinate windows over a stream of points (update or complete mode)."""
    end = (F.ceil(F.col("start") / width) * width).cast("bigint").alias("end")
    return points.groupBy(*by, end).agg(F.sum("c").alias("c"), F.sum("t").alias("t"), F.count("*").alias("n"))


def runs_stream(points: DataFrame, step: int) -> DataFrame:
    """A25 on a stream whose rows of a sequence come in order of start (one that comes later stops the stream with an error): a row (sequence, size) for each run that ended.

    State of a sequence is its open run's last position and size, so it does not grow; the last run stays open.
    """

    def advance(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, size = state.get if state.exists else (None, 0)
        done = []
        for frame in frames:
            for start in sorted(frame["start"]):
                if last is not None and start < last:
                    raise ValueError(f"row {start} of {key[0]} comes after row {last}: runs need rows in order of start")
                if last is not None and start - last > step:
                    done.append(size)
                    size = 0
                last, size = int(start), size + 1
        state.update((last, size))
        yield pd.DataFrame({"sequence": [key[0]] * len(done), "size": done})

    return points.groupBy("sequence").applyInPandasWithState(advance, "sequence string, size long", "last long, size long", "append", GroupStateTimeout.NoTimeout)


"""Speaker turns over a stream of segments."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

OPEN = "label string, begin double, last double, turn bigint"
TURNS = "turn bigint, speaker string, start double, end double, closed boolean"


class _OpenRun(StatefulProcessor):
    """Holds the run of segments that the next one may go on with."""

    def __init__(self, key: str):
        self._key = key

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._open = handle.getValueState("open", OPEN)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        run = self._open.get() if self._open.exists() else None
        found = []
        frame = pd.concat(list(rows)).sort_values(["start", "segment_id"], kind="stable")
        for label, start, end in zip(frame["label"], frame["start"], frame["end"], strict=True):
            label = None if pd.isna(label) else label
            if run is None:
                run = (label, start, end, 0)
            elif run[0] == label:
                run = (label, run[1], end, run[3])
            else:
                found.append((run[3], run[0], run[1], start, True))
                run = (label, start, end, run[3] + 1)
        if run is not None:
            self._open.update(run)
            found.append((run[3], run[0], run[1], run[2], False))
        turns = pd.DataFrame(found, columns=["turn", "speaker", "start", "end", "closed"])
        turns.insert(0, self._key, key[0])
        yield turns

    def close(self) -> None:
        pass


def stream_turns(segments: DataFrame, key: str = "file_ids") -> DataFrame:
    """``(key, turn, speaker, start, end, closed)`` from a stream of segments
    ``(key, segment_id, start, end, label)``, in update mode.

    Same rule as ``turns.speaker_turns``. Batches must bring a file's segments in
    order of ``(start, segment_id)``; inside a batch their order does not matter. A
    file's state is its open run alone. Each batch emits the turns it closes and
    the open one as it stands (``closed`` false), which a later row with the same
    ``(key, turn)`` replaces. A NULL label is a speaker of its own; a NULL key is a
    file. The segments of one file and batch are sorted in one task, so bound the
    batches at the source (``maxFilesPerTrigger``) where files are long. Needs the
    RocksDB state store (``spark.sql.streaming.stateStore.providerClass``).
    """
    kind = segments.schema[key].dataType.simpleString()
    slim = segments.select(key, "segment_id", "start", "end", "label")
    return slim.groupBy(key).transformWithStateInPandas(
        statefulProcessor=_OpenRun(key), outputStructType=f"`{key}` {kind}, {TURNS}", outputMode="Update", timeMode="None"
    )

"""Resume positions as streaming state: the same result as ``operators.acks.ack_watermark``, kept up record by record."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUTPUT = "token string, next_seq bigint, watermark timestamp"


class AckTracker(StatefulProcessor):
    """Rows (token, seq, ts, acked), in any order. Acknowledged numbers wait in a map until the prefix before them is complete."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.prefix = handle.getValueState("prefix", "next_seq bigint, watermark timestamp")
        self.waiting = handle.getMapState("waiting", "seq bigint", "ts timestamp")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        due, watermark = self.prefix.get() or (0, None)
        moved = False
        for r in rows:
            if r.acked and r.seq >= due:  # numbers below are acknowledged already: a record that came again
                self.waiting.updateValue((r.seq,), (r.ts,))
        while self.waiting.containsKey((due,)):
            watermark = self.waiting.getValue((due,))[0]
            self.waiting.removeKey((due,))
            due += 1
            moved = True
        if moved:
            self.prefix.update((due, watermark))
            yield Row(token=key[0], next_seq=due, watermark=watermark)

    def close(self) -> None:
        pass


def tracked(rows: DataFrame) -> DataFrame:
    """A row each time a partition's resume position moves. The session's state store provider must be RocksDB."""
    return rows.groupBy("token").transformWithState(AckTracker(), OUTPUT, "Update", "None")

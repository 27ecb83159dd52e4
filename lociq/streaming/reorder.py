"""The order of reads restored on a stream: alignments come out under their reads' names, in the names' order."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import takewhile

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Names, and alignments without a name, that a file's buffer holds.
MOST_NAMES = 100_000
ORDERED = "file string, ordinal bigint, qname string, alignments array<string>"


class ReorderBuffer(StatefulProcessor):
    """A buffer for each file: names by ordinal, and what has come for each name.

    The least ordinals leave when it holds more than ``most`` names, and those that haven't been
    touched for ``wait_ms`` of event time when the watermark passes that, up to the first that has. Alignments may come
    before their names; those whose name doesn't come in time, or has left, come out with a
    null ordinal. Every row comes out once.
    """

    def __init__(self, most: int, wait_ms: int):
        self.most, self.wait_ms = most, wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.names = handle.getMapState("names", "qname string", "ordinal bigint, seen bigint")
        self.held = handle.getMapState("held", "qname string", "payloads array<string>, seen bigint")

    def _leave(self, key, names: list[tuple], alone: list[tuple]) -> Iterator[pd.DataFrame]:
        """Rows for names (ordinal, qname) in their order, then for alignments that have no name."""
        rows = []
        for ordinal, qname in sorted(names) + [(None, q) for q in sorted(alone)]:
            got = self.held.getValue((qname,)) if self.held.containsKey((qname,)) else None
            rows.append((key[0], ordinal, qname, list(got[0]) if got else []))
            if got:
                self.held.removeKey((qname,))
            if ordinal is not None:
                self.names.removeKey((qname,))
        if rows:
            yield pd.DataFrame({"file": [r[0] for r in rows], "ordinal": pd.array([r[1] for r in rows], dtype="Int64"), "qname": [r[2] for r in rows], "alignments": [r[3] for r in rows]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        latest = 0
        for frame in rows:
            for qname, ordinal, payload, at in zip(frame["qname"], frame["ordinal"], frame["payload"], frame["at_ms"], strict=True):
                latest = max(latest, int(at))
                if not pd.isna(ordinal):
                    self.names.updateValue((qname,), (int(ordinal), int(at)))
                elif not pd.isna(payload):
                    before = list(self.held.getValue((qname,))[0]) if self.held.containsKey((qname,)) else []
                    self.held.updateValue((qname,), ([*before, payload], int(at)))
        names = sorted((v[0], k[0]) for k, v in self.names.iterator())
        known = {q for _, q in names}
        alone = sorted((v[1], k[0]) for k, v in self.held.iterator() if k[0] not in known)
        over, lost = max(0, len(names) - self.most), max(0, len(alone) - self.most)
        yield from self._leave(key, names[:over], [q for _, q in alone[:lost]])
        self.handle.registerTimer(latest + self.wait_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        old = expiredTimerInfo.getExpiryTimeInMs() - self.wait_ms
        every = [(k[0], v[0], v[1]) for k, v in self.names.iterator()]
        touched = {k[0]: v[1] for k, v in self.held.iterator()}
        names = list(takewhile(lambda x: max(x[2], touched.get(x[1], 0)) <= old, sorted((o, q, seen) for q, o, seen in every)))
        names = [(o, q) for o, q, _ in names]
        known = {q for q, _, _ in every}
        yield from self._leave(key, names, [q for q, seen in touched.items() if q not in known and seen <= old])


def restore_order(rows: DataFrame, *, most: int = MOST_NAMES, wait: str = "10 minutes", late: str = "1 minute") -> DataFrame:
    """(file, ordinal, qname, alignments) of a stream of names and alignments.

    rows: file, qname, at (a time), ordinal (of a name, null for an alignment), payload (of an
    alignment, null for a name). A file's rows are one key, so its buffer is one task's, and
    within what leaves together ordinals ascend; many files are worked side by side. ``late`` is
    the watermark's delay. Needs the state store of RocksDB, as Spark's stateful processors do. On a
    table that isn't a stream it is the join that a stream comes to when nothing is evicted.
    """
    if not rows.isStreaming:
        names = rows.filter("ordinal is not null").groupBy("file", "qname").agg(F.max("ordinal").alias("ordinal"))
        held = rows.filter("ordinal is null and payload is not null").groupBy("file", "qname").agg(F.array_sort(F.collect_list("payload")).alias("alignments"))
        both = names.join(held, ["file", "qname"], "full").select("file", "ordinal", "qname", F.coalesce("alignments", F.array().cast("array<string>")).alias("alignments"))
        return both.sortWithinPartitions("file", "ordinal")
    wait_ms = rows.sparkSession.sql(f"select cast(interval {wait} as interval second) as x").first().x.total_seconds() * 1000
    timed = rows.withWatermark("at", late).withColumn("at_ms", F.unix_millis(F.col("at").cast("timestamp")))
    keyed = timed.select("file", "qname", F.col("ordinal").cast("bigint").alias("ordinal"), "payload", "at", "at_ms").groupBy("file")
    return keyed.transformWithStateInPandas(ReorderBuffer(most, int(wait_ms)), ORDERED, "append", "eventtime")

"""Sketches kept up to date by Structured Streaming."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.projection import signs
from ..operators.sketch import shingle_postings

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_set_sizes(docs: DataFrame) -> DataFrame:
    """acc, n, low, high of the sketches of a stream of documents, kept as they arrive."""
    return shingle_postings(docs).groupBy("acc").agg(F.count("*").alias("n"), F.min("h").alias("low"), F.max("h").alias("high"))


class SetState(StatefulProcessor):
    """The distinct hashes of an accession, in slots by their low bits, and the sum of their sign vectors."""

    def __init__(self, dim: int, spacing: int | None, slots: int):
        self.dim, self.spacing, self.slots = dim, spacing, slots

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "slot int", "hashes binary")
        self.total = handle.getValueState("total", "n long, v binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        n, v = 0, np.zeros(self.dim, np.int64)
        if self.total.exists():
            n, stored = self.total.get()
            v = np.frombuffer(stored, np.int64).copy()
        for part in rows:
            hashes = np.unique(part["h"].to_numpy(np.int64))
            for slot in np.unique(hashes % self.slots).tolist():
                own = hashes[hashes % self.slots == slot]
                known = np.zeros(0, np.int64)
                if self.seen.containsKey((slot,)):
                    known = np.frombuffer(self.seen.getValue((slot,))[0], np.int64)
                new = np.setdiff1d(own, known, assume_unique=True)
                if len(new):
                    self.seen.updateValue((slot,), (np.sort(np.concatenate([known, new])).tobytes(),))
                    n += len(new)
                    for at in range(0, len(new), 2048):
                        v += signs(new[at : at + 2048].astype(np.uint64), self.dim, self.spacing).sum(axis=0, dtype=np.int64)
        self.total.update((n, v.tobytes()))
        yield pd.DataFrame({"acc": [key[0]], "n": [n], "v": [v.tolist()], "n2": [float((v * v).sum()) / self.dim]})

    def close(self) -> None:
        pass


def stream_sketches(postings: DataFrame, dim: int = 2048, spacing: int | None = None, slots: int = 64) -> DataFrame:
    """acc, n, v, n2 of every accession that a micro-batch of a stream of postings (acc, h) touches: its distinct hashes' number, summed vector and squared length over dim.

    The state of an accession is its distinct hashes, of which a batch reads and writes only the slots
    that its hashes fall into, and the sum of their sign vectors; so batches may come in any order and repeat
    postings, and the last row of an accession is what the whole table would give. Writes go out
    in update mode; the state is held in RocksDB, which this sets for the session.
    """
    postings.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    kind = dict(postings.dtypes)["acc"]
    processor = SetState(dim, spacing, slots)
    return postings.select("acc", "h").groupBy("acc").transformWithStateInPandas(processor, f"acc {kind}, n long, v array<bigint>, n2 double", "Update", "None")

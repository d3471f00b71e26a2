"""Training on every row: each partition of the data trains a copy of the model, and Spark averages the copies.

A round broadcasts the model's arrays; what a partition changed of them travels in blocks of rows, weighted by the
rows it learned from, and every block is averaged by one of many tasks.  The driver holds one model at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from curate.llm.textbytes import no_shuffle_left

#: Rows of an array that travel together.
BLOCK = 128
#: Rows that one copy learns from, beyond the copies that keep every core busy.
ROWS = 1 << 14
_DDL = "name string, block int, part int, weight double, rows binary, value binary"


def _changes(old: dict[str, np.ndarray], new: dict[str, np.ndarray], weight: float, part: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("name", pa.string()), ("block", pa.int32()), ("part", pa.int32()), ("weight", pa.float64()), ("rows", pa.binary()), ("value", pa.binary())])
    yield pa.RecordBatch.from_pylist([{"name": "", "block": 0, "part": part, "weight": weight, "rows": b"", "value": b""}], schema)
    for name, now in new.items():
        rows = np.flatnonzero((now != old[name]).reshape(len(now), -1).any(1)).astype(np.int32)
        out = []
        for own in np.split(rows, np.flatnonzero(np.diff(rows // BLOCK)) + 1) if len(rows) else []:
            out.append({"name": name, "block": int(own[0]) // BLOCK, "part": part, "weight": weight, "rows": own.tobytes(), "value": (now[own] - old[name][own]).tobytes()})
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)


def _sum(batches: Iterator[pa.RecordBatch], kinds: dict[str, tuple[int, np.dtype]]) -> Iterator[pa.RecordBatch]:
    """The weighted sum of every (name, block), whose rows follow one another; ``kinds``: values a row and type by name."""

    def row() -> pa.RecordBatch:
        rows = np.flatnonzero(seen).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]], pa.int32()), pa.array([0], pa.int32()), pa.array([weight]),
                                           pa.array([(rows + key[1] * BLOCK).astype(np.int32).tobytes()], pa.binary()), pa.array([total[seen].tobytes()], pa.binary())],
                                          names=["name", "block", "part", "weight", "rows", "value"])

    key = None
    for batch in batches:
        for r in batch.to_pylist():
            if key != (r["name"], r["block"]):
                if key is not None:
                    yield row()
                key, weight = (r["name"], r["block"]), 0.0
                width, kind = kinds.get(r["name"], (1, np.dtype(np.float64)))
                total, seen = np.zeros((BLOCK, width)), np.zeros(BLOCK, bool)
            weight += r["weight"]
            at = np.frombuffer(r["rows"], np.int32) - r["block"] * BLOCK
            total[at] += np.frombuffer(r["value"], kind).reshape(len(at), width) * r["weight"]
            seen[at] = True
    if key is not None:
        yield row()


def dealt(data: DataFrame, rows: int, least: int) -> DataFrame:
    """``data`` of so many rows in as many partitions as copies are trained: with at least ``least`` rows each one a core,
    and beyond that one for every ROWS, as a copy's changes have much the same size whatever its rows."""
    cores = data.sparkSession.sparkContext.defaultParallelism
    return data.coalesce(max(1, min(cores, rows // least), rows // ROWS))


def train(data: DataFrame, state: dict[str, np.ndarray], rounds: int,
          learn: Callable[[dict[str, np.ndarray], Iterator[pa.RecordBatch], int], float]) -> dict[str, np.ndarray]:
    """``state`` after so many rounds over all rows of ``data``.

    ``learn(arrays, batches, round)`` changes a partition's copy of the arrays and returns the rows it learned from.
    """
    context = data.sparkSession.sparkContext
    kinds = {n: (int(np.prod(a.shape[1:])), a.dtype) for n, a in state.items()}
    for number in range(rounds):
        held = context.broadcast(state)

        def run(batches: Iterator[pa.RecordBatch], held=held, number=number) -> Iterator[pa.RecordBatch]:
            own = {n: a.copy() for n, a in held.value.items()}
            weight = learn(own, batches, number)
            if weight:
                yield from _changes(held.value, own, float(weight), TaskContext.get().partitionId())

        with no_shuffle_left(data.sparkSession):
            moved = data.mapInArrow(run, _DDL).repartition("name", "block").sortWithinPartitions("name", "block", "part").mapInArrow(lambda b: _sum(b, kinds), _DDL).toArrow().to_pylist()
        weight = sum(r["weight"] for r in moved if r["name"] == "")
        state = {n: a.copy() for n, a in state.items()}
        for r in moved:
            if r["name"]:
                a, at = state[r["name"]], np.frombuffer(r["rows"], np.int32)
                a[at] = (a[at] + np.frombuffer(r["value"], np.float64).reshape(len(at), *a.shape[1:]) / weight).astype(a.dtype)
        held.unpersist()
    return state

"""Accumulators of a user's own: create, add, merge, extract, for what no built-in aggregate does.

Tasks add their rows to one state per key, Arrow batch by Arrow batch, and send the states only. They are merged
as a tree: first within (key, salt), then by key, so a key of many partial states is not one task's work.
States are rows of a declared schema. Where a built-in aggregate exists (``max_by`` for the latest point) use that.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import ship_package

#: Keys whose states a task holds before it sends them, and groups that a key's partial states are merged in first.
HELD_KEYS, FAN = 50_000, 16


class Combiner(ABC):
    """An aggregate whose partial states can be merged in any order.

    ``merge`` must be associative and commutative and ``create()`` its neutral element; a state is a dict of
    the fields of ``state_ddl``, a result one of ``result_ddl``.
    """

    state_ddl: str
    result_ddl: str

    @abstractmethod
    def create(self) -> dict: ...

    @abstractmethod
    def add(self, state: dict, rows: pa.RecordBatch) -> dict: ...

    @abstractmethod
    def merge(self, a: dict, b: dict) -> dict: ...

    @abstractmethod
    def extract(self, state: dict) -> dict: ...


def combine_by_key(df: DataFrame, key: str, cols: Sequence[str], combiner: Combiner, fan: int = FAN) -> DataFrame:
    """One row per key (null is a key): the key and the fields of ``combiner.result_ddl``."""
    ship_package(df.sparkSession)
    keyed = T.StructType([T.StructField(key, df.schema[key].dataType)])
    states = T.StructType([*keyed.fields, *T._parse_datatype_string(combiner.state_ddl).fields])
    results = T.StructType([*keyed.fields, *T._parse_datatype_string(combiner.result_ddl).fields])
    state_arrow, result_arrow = to_arrow_schema(states), to_arrow_schema(results)

    def add(batches):
        held: dict = {}

        def sent():
            return pa.RecordBatch.from_pylist([{key: k, **s} for k, s in held.items()], schema=state_arrow)
        for batch in batches:
            places: dict = {}
            for row, k in enumerate(batch.column(0).to_pylist()):
                places.setdefault(k, []).append(row)
            rows = batch.select(list(cols))
            for k, at in places.items():
                mine = rows if len(places) == 1 else rows.take(pa.array(np.array(at)))
                held[k] = combiner.add(held[k] if k in held else combiner.create(), mine)
            if len(held) >= HELD_KEYS:
                yield sent()
                held.clear()
        if held:
            yield sent()

    def merged(table: pa.Table) -> dict:
        state = None
        for batch in table.select(states.fieldNames()[1:]).to_batches(max_chunksize=1024):
            for s in batch.to_pylist():
                state = s if state is None else combiner.merge(state, s)
        return state

    def part(table: pa.Table) -> pa.Table:
        return pa.Table.from_pylist([{key: table.column(key)[0].as_py(), **merged(table)}], schema=state_arrow)

    def last(table: pa.Table) -> pa.Table:
        return pa.Table.from_pylist([{key: table.column(key)[0].as_py(), **combiner.extract(merged(table))}], schema=result_arrow)
    partial = df.select(key, *[c for c in cols if c != key]).mapInArrow(add, states)
    salted = partial.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.lit(fan)))
    return salted.groupBy(key, "__salt").applyInArrow(part, states).groupBy(key).applyInArrow(last, results)


class Largest(Combiner):
    """The ``k`` rows of largest value with their ids, equal values by the smaller id; null values and ids are left out."""

    state_ddl = "ids array<long>, vals array<double>"
    result_ddl = state_ddl

    def __init__(self, k: int, id_col: str, value_col: str):
        self.k, self.id_col, self.value_col = k, id_col, value_col

    def create(self) -> dict:
        return {"ids": [], "vals": []}

    def _top(self, ids, vals) -> dict:
        best = sorted(zip(vals, ids), key=lambda x: (-x[0], x[1]))[:self.k]
        return {"ids": [i for _, i in best], "vals": [v for v, _ in best]}

    def add(self, state: dict, rows: pa.RecordBatch) -> dict:
        known = [(i, v) for i, v in zip(rows[self.id_col].to_pylist(), rows[self.value_col].to_pylist()) if i is not None and v is not None]
        return self._top(state["ids"] + [i for i, _ in known], state["vals"] + [v for _, v in known])

    def merge(self, a: dict, b: dict) -> dict:
        return self._top(a["ids"] + b["ids"], a["vals"] + b["vals"])

    def extract(self, state: dict) -> dict:
        return state

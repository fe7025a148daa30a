"""Stateful processors for ``groupBy(key).transformWithStateInPandas`` (Structured Streaming): value, list and map state.

For states that expire or are looked up entry by entry. Everything that is a running aggregate, a window or a sequential
machine runs as a micro-batch fold instead (``tempest.streaming.folds``), where no key is handed to one call. Rows of
a key within a micro-batch are sorted by ``seq`` before they touch the state, because Spark hands them over in no
particular order; micro-batches are kept small (``runner.BATCH_BYTES``), so that is a bounded amount.
State lives in the configured state store (RocksDB recommended) and is restored from the checkpoint
after a failure, so a restarted query continues exactly where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle, TimerValues


#: What a null key is called inside the processors.
NULL_KEY = "\x00null"


def _nonempty(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Yield ``pdf`` only when it has rows (an empty frame has no usable column types for Arrow)."""
    if len(pdf):
        yield pdf


def _sorted(rows: Iterator[pd.DataFrame], by: str = "seq") -> pd.DataFrame:
    pdf = pd.concat(list(rows), ignore_index=True)
    return pdf.sort_values(by, kind="stable").reset_index(drop=True)


class KeyedReduce(StatefulProcessor):
    """General rolling ``reduce(fn)``: ``fn(previous_result: dict, current: dict) -> dict``; the first
    record of a key is its own result. Output columns ``fields`` (A4 with a user function)."""

    def __init__(self, fn: Callable[[dict, dict], dict], fields: list[str], state_schema: str):
        self.fn, self.fields, self.state_schema = fn, fields, state_schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.acc = handle.getValueState("acc", self.state_schema)

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        pdf = _sorted(rows)
        got = self.acc.get()
        acc = dict(zip(self.fields, got)) if got is not None else None
        out = []
        for rec in pdf[self.fields].to_dict("records"):
            acc = rec if acc is None else self.fn(acc, rec)
            out.append({**acc, "seq": rec["seq"]} if "seq" in rec else acc)
        self.acc.update(tuple(acc[f] for f in self.fields))
        yield from _nonempty(pd.DataFrame(out))

    def close(self) -> None:
        pass


class LastBySubKey(StatefulProcessor):
    """Map state: per key, the last value of each sub-key (P8). Every record gives ``(seq, key, sub, value, last_value)``,
    ``last_value`` being that of the key's record with the same sub-key before it (null at first, or when that record was more than
    ``ttl_ms`` ago in processing time: the state store then forgets the entry). Input columns: key, ``seq``, ``sub``,
    ``value`` and ``is_null`` (pandas cannot tell a null from NaN). Inside a micro-batch the records are shifted by
    sub-key as columns; the state is touched once per sub-key."""

    def __init__(self, key: str = "id", ttl_ms: int | None = None):
        self.key, self.ttl_ms = key, ttl_ms

    def schema(self) -> str:
        return f"seq long, {self.key} string, sub string, value double, last_value double"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getMapState("last", "sub string", "value double", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        pdf = _sorted(rows)
        pdf["sub"] = pdf["sub"].fillna(NULL_KEY)
        pdf["value"] = pdf["value"].astype(object).where(~pdf["is_null"], None)
        by_sub = pdf.groupby("sub", sort=False)
        pdf["last_value"] = by_sub["value"].shift()
        for at, sub in pdf.loc[by_sub.cumcount() == 0, "sub"].items():
            known = self.last.getValue((sub,)) if self.last.containsKey((sub,)) else None
            pdf.at[at, "last_value"] = known[0] if known is not None else None
        for sub, value in zip(*(by_sub.last(skipna=False).reset_index()[c] for c in ("sub", "value"))):
            self.last.updateValue((sub,), (None if value is None else float(value),))
        pdf["sub"] = pdf["sub"].where(pdf["sub"] != NULL_KEY, None)
        yield pdf.assign(**{self.key: key[0]})[["seq", self.key, "sub", "value", "last_value"]]

    def close(self) -> None:
        pass


class RecentValues(StatefulProcessor):
    """List state: per key, the last ``n`` values (P7). Every record gives ``(seq, key, cnt, lo, hi)``: how many of its
    last ``n`` values there are and the smallest and largest of them (nulls do not count)."""

    def __init__(self, n: int = 3, key: str = "id"):
        self.n, self.key = n, key

    def schema(self) -> str:
        return f"seq long, {self.key} string, cnt long, lo double, hi double"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.recent = handle.getListState("recent", "value double")

    def handleInputRows(self, key, rows, timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        pdf = _sorted(rows)
        old = [r[0] for r in self.recent.get()] if self.recent.exists() else []
        new = [None if null else v for v, null in zip(pdf["value"].tolist(), pdf["is_null"].tolist())]
        values = pd.Series([*old, *new], dtype="Float64")
        frame = values.rolling(self.n, min_periods=1)
        out = pd.DataFrame({"seq": pdf["seq"], self.key: key[0]})
        out["cnt"], out["lo"], out["hi"] = (x.iloc[len(old):].reset_index(drop=True) for x in (frame.count().astype("int64"), frame.min(), frame.max()))
        self.recent.put([(None if pd.isna(v) else float(v),) for v in values.iloc[-(self.n - 1):]] if self.n > 1 else [])
        yield out

    def close(self) -> None:
        pass

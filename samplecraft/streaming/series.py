"""State of stream differences: the last sample of each series. Only public packages are imported here, as the module
travels with the operator."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

_DIFFERENCE_KINDS = ("RATE", "PRATE", "DELTA", "PDELTA")


class SeriesDifferences(StatefulProcessor):
    """The last time and value of every series of a bucket, as one Arrow table."""

    def __init__(self, ttl_ms: int, most: int = 50_000) -> None:
        self.ttl_us, self.most = ttl_ms * 1000, most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "lasts binary")

    def close(self) -> None:
        pass

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        names, parts, kinds = {}, [], {}
        for frame in rows:
            code = frame["series"].map(lambda s: names.setdefault(s, len(names))).to_numpy(np.int32)
            named = frame["kind"].map(lambda k: kinds.setdefault(k, len(kinds))).to_numpy(np.int32)
            parts.append((code, frame["us"].to_numpy(np.int64), frame["value"].to_numpy(np.float64), named))
        code, us, v, named = (np.concatenate(c) for c in zip(*parts, strict=True))
        parts.clear()
        order = np.lexsort((v, us, code))
        code, us, v, named = code[order], us[order], v[order], named[order]
        old = self._live(timerValues)
        before_us, before, known = np.zeros(len(names), np.int64), np.zeros(len(names)), np.zeros(len(names), bool)
        at = [(names[s], k) for k, s in enumerate(old["series"]) if s in names]
        if at:
            mine, theirs = np.array(at).T
            before_us[mine], before[mine], known[mine] = old["us"][theirs], old["value"][theirs], True
        on_time = ~known[code] | (us >= before_us[code])
        code, us, v, named = code[on_time], us[on_time], v[on_time], named[on_time]
        if len(code):
            yield from self._reported(np.array(list(names), object), np.array(list(kinds), object), code, us, v, named, before_us, before, known)
            last = np.flatnonzero(np.append(code[1:] != code[:-1], True))
            touched = set(code[last].tolist())
            kept = [k for k, s in enumerate(old["series"]) if names.get(s) not in touched]
            texts = list(names)
            merged = {
                "series": [old["series"][k] for k in kept] + [texts[c] for c in code[last]],
                "us": np.concatenate([old["us"][kept], us[last]]),
                "value": np.concatenate([old["value"][kept], v[last]]),
            }
            self._store(merged, timerValues)

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._store(self._live(timerValues), timerValues)
        yield from ()

    def _reported(self, names, kinds, code, us, v, named, before_us, before, known) -> Iterator[pd.DataFrame]:
        first = np.concatenate([[True], code[1:] != code[:-1]])
        prior_us, prior = np.concatenate([[0], us[:-1]]), np.concatenate([[0.0], v[:-1]])
        prior_us[first], prior[first] = before_us[code[first]], before[code[first]]
        new = first & ~known[code]
        seconds, step = (us - prior_us) / 1_000_000, v - prior
        is_rate, is_difference = np.isin(kinds, ("RATE", "PRATE"))[named], np.isin(kinds, _DIFFERENCE_KINDS)[named]
        falls = np.array([str(k).startswith("P") for k in kinds])[named] & (step < 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            reported = np.where(is_rate, step / seconds, step)
        reported = np.where(is_difference, np.where(new, 0.0, np.where((seconds == 0) | falls, np.nan, reported)), v)
        for k in range(0, len(code), self.most):
            part = slice(k, k + self.most)
            texts = {"series": pd.Series(names[code[part]], dtype=object), "kind": pd.Series(kinds[named[part]], dtype=object)}
            columns = {"series": texts["series"], "us": us[part], "value": v[part], "kind": texts["kind"]}
            yield pd.DataFrame({**columns, "reported": pd.array(reported[part], dtype="Float64")})

    def _stored(self) -> dict:
        if not self.held.exists():
            return {"series": [], "us": np.zeros(0, np.int64), "value": np.zeros(0)}
        table = pa.ipc.open_stream(self.held.get()[0]).read_all()
        return {"series": table["series"].to_pylist(), "us": table["us"].to_numpy(), "value": table["value"].to_numpy()}

    def _live(self, timerValues: TimerValues) -> dict:
        """What is stored and not due yet."""
        held = self._stored()
        live = np.flatnonzero(held["us"] + self.ttl_us > timerValues.getCurrentWatermarkInMs() * 1000)
        return {"series": [held["series"][k] for k in live], "us": held["us"][live], "value": held["value"][live]}

    def _store(self, lasts: dict, timerValues: TimerValues) -> None:
        """Keep the last samples, and wake when the oldest is due."""
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if not len(lasts["us"]):
            self.held.clear()
            return
        table = pa.table({"series": pa.array(lasts["series"], pa.string()), "us": lasts["us"], "value": lasts["value"]})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(table)
        self.held.update((sink.getvalue().to_pybytes(),))
        due = (int(lasts["us"].min()) + self.ttl_us) // 1000 + 1
        self.handle.registerTimer(max(due, timerValues.getCurrentWatermarkInMs() + 1))

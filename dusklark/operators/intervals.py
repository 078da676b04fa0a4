"""Merging of interval state, the same for tables and streams.

Every event opens the interval from its moment to one gap later. An interval is ``start, until`` (last moment plus gap),
the counters carried by its first and last event, and its number of events. Sorted intervals of one group merge where
the next begins before the last has run out and, if there is a rule, where it holds between the counters that meet.
Merging merged intervals gives the same as merging all at once, so it can be done in parts, in any grouping of
neighbours, and again when something arrives late.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Says for neighbours' counters (NaN where unknown) whether the second may continue the first.
Rule = Callable[[np.ndarray, np.ndarray], np.ndarray]


def countdown(previous: np.ndarray, current: np.ndarray) -> np.ndarray:
    """The counter falls by one from one event to the next; where either is unknown or negative the clock alone decides."""
    unknown = np.isnan(previous) | np.isnan(current) | (previous < 0) | (current < 0)
    return unknown | (current == previous - 1)


@dataclass
class Intervals:
    """Intervals sorted by group and start; ``breaks`` tells for each but the first whether its group is another."""

    start: np.ndarray
    until: np.ndarray
    first: np.ndarray
    last: np.ndarray
    events: np.ndarray
    breaks: np.ndarray

    def merged(self, rule: Rule | None = None, apart: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Where each merged interval begins, and its ``start, until, first, last, events``.

        apart: neighbours that must not merge.
        """
        if not len(self.start):
            return np.zeros(0, dtype=np.int64), self.start, self.until, self.first, self.last, self.events
        group = np.concatenate([[0], np.cumsum(self.breaks)])
        low = int(self.until.min())
        width = np.int64(int(self.until.max()) - low + 1)
        reach = np.maximum.accumulate(self.until - low + group * width) - group * width + low
        joins = ~self.breaks & (self.start[1:] <= reach[:-1])
        if apart is not None:
            joins &= ~apart
        if rule is not None:
            joins &= rule(self.last[:-1], self.first[1:])
        at = np.flatnonzero(np.concatenate([[True], ~joins]))
        ends = np.append(at[1:], len(self.start)) - 1
        return at, self.start[at], np.maximum.reduceat(self.until, at), self.first[at], self.last[ends], np.add.reduceat(self.events, at)


def of_events(moments: np.ndarray, counters: np.ndarray | None, counts: np.ndarray | None, gap: int) -> Intervals:
    """The intervals that events of one group open."""
    order = np.argsort(moments, kind="stable")
    t = moments[order].astype(np.int64)
    c = np.full(len(t), np.nan) if counters is None else counters[order]
    n = np.ones(len(t), dtype=np.int64) if counts is None else counts[order]
    return Intervals(t, t + gap, c, c, n, np.zeros(max(0, len(t) - 1), dtype=bool))


#: Columns of an interval beside its group's: buckets of its first and last event, and whether it is its group's first or last.
FIELDS = pa.schema([("_b0", pa.int64()), ("_b1", pa.int64()), ("_start", pa.int64()), ("_until", pa.int64()), ("_first", pa.float64()), ("_last", pa.float64()), ("_n", pa.int64())])


def _changes(columns: list[pa.ChunkedArray]) -> np.ndarray:
    out = np.zeros(max(0, len(columns[0]) - 1), dtype=bool)
    for c in columns:
        code = c.combine_chunks().dictionary_encode(null_encoding="encode")
        code = (code.combine_chunks() if isinstance(code, pa.ChunkedArray) else code).indices.to_numpy(zero_copy_only=False)
        out |= code[1:] != code[:-1]
    return out


def merge_sorted(batches: Iterator[pa.RecordBatch], group: list[str], rule: Rule | None, across: bool) -> Iterator[pa.RecordBatch]:
    """Merged intervals of batches sorted by ``group`` and start, with ``_edge``: the first or last of its group.

    The last interval of a batch is held until the next shows whether it goes on, so a group may span any number of
    batches. With ``across``, intervals that end and begin in the same bucket stay apart: that bucket has decided so.
    """
    held, held_head = None, True
    schema = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        schema = t.schema
        if held is not None:
            t = pa.concat_tables([held, t])
        x = {f: t.column(f).combine_chunks().to_numpy(zero_copy_only=False) for f in FIELDS.names}
        breaks = _changes([t.column(g) for g in group])
        apart = x["_b1"][:-1] == x["_b0"][1:] if across else None
        at, start, until, first, last, n = Intervals(x["_start"], x["_until"], x["_first"], x["_last"], x["_n"], breaks).merged(rule, apart)
        heads = np.concatenate([[held_head if held is not None else True], breaks[at[1:] - 1]])
        ends = np.append(at[1:], t.num_rows) - 1
        found = {"_b0": x["_b0"][at], "_b1": x["_b1"][ends], "_start": start, "_until": until, "_first": first, "_last": last, "_n": n}
        keys = t.select([c for c in t.column_names if c not in FIELDS.names]).take(pa.array(at))
        out = pa.Table.from_arrays([pa.array(found[c], type=FIELDS.field(c).type) if c in found else keys.column(c) for c in t.column_names], schema=schema)
        held, held_head = out.slice(len(at) - 1), bool(heads[-1])
        if len(at) > 1:
            yield from _marked(out.slice(0, len(at) - 1), heads[:-1] | heads[1:])
    if held is not None:
        yield from _marked(held, np.array([True]))


def _marked(t: pa.Table, edge: np.ndarray) -> Iterator[pa.RecordBatch]:
    yield from t.append_column("_edge", pa.array(edge, type=pa.bool_())).combine_chunks().to_batches()

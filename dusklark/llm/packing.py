"""Filling containers of a fixed capacity with whole texts.

Sizes are whole tokens no larger than the capacity, so all that a packing depends on is how many items of each size
there are: a histogram with at most ``capacity`` entries, whatever the number of texts. The plan is made on it. Items
above one third of the capacity are matched first, the largest with the largest that still fits beside it, at most two
to a container; smaller items, in falling size, go to the container with the least room that takes them, and open a
new one only where none does. The plan says for each size which ranks go to which containers. Ranks are given out in
parallel, and every item finds its container by itself.
"""

from __future__ import annotations

import bisect
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dusklark.session import spread, written

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
CAPACITY = 2048
#: Rows numbered by one task at a time.
ROWS_PER_SLOT = 200_000
#: The plan's length depends on the capacity alone; it is refused beyond this, never cut.
MAX_SEGMENTS = 4_000_000
_tokenizers: dict[str, object] = {}


def count_tokens(texts: list[str], tokenizer: str) -> list[int]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if tokenizer not in _tokenizers:
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(tokenizer)
        t.encode_special_tokens = True
        _tokenizers[tokenizer] = t
    return [len(e.ids) for e in _tokenizers[tokenizer].encode_batch_fast(texts, add_special_tokens=False)]


def token_sizes(df: DataFrame, id_col: str, text_col: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """``doc_id, tokens``: the length of each text in tokens; 0 for NULL and empty texts. Every row has its own."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, sizes = b.column("text").to_pylist(), []
            for a in range(0, len(texts), 256):  # bounded memory for the encodings
                sizes += count_tokens([t or "" for t in texts[a : a + 256]], tokenizer)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(sizes, type=pa.int64())], names=["doc_id", "tokens"])

    id_type = df.schema[id_col].dataType.simpleString()
    return spread(df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))).mapInArrow(measure, f"doc_id {id_type}, tokens long")


def plan(histogram: dict[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """Segments ``size, first rank, first container, items per container`` (sorted) and the number of containers.

    Items of one size with ranks from a segment's first to the next segment's go to consecutive containers.
    """
    if any(s < 1 or s > capacity for s in histogram):
        raise ValueError("sizes lie between 1 and the capacity")
    left = {s: n for s, n in histogram.items() if n > 0}
    used = dict.fromkeys(left, 0)
    segments: list[tuple[int, int, int, int]] = []
    rooms: dict[int, list[tuple[int, int]]] = {}
    gaps: list[int] = []
    bins = 0

    def put(size: int, count: int, first_bin: int, per_bin: int) -> None:
        segments.append((size, used[size], first_bin, per_bin))
        used[size] += count
        left[size] -= count

    def room(gap: int, first_bin: int, count: int) -> None:
        if gap > 0 and count > 0:
            if gap not in rooms:
                rooms[gap] = []
                bisect.insort(gaps, gap)
            rooms[gap].append((first_bin, count))

    large = sorted(s for s in left if 3 * s > capacity)
    for s in reversed(large):
        while left[s]:
            fit = bisect.bisect_right(large, min(s, capacity - s)) - 1
            while fit >= 0 and (left[large[fit]] == 0 or large[fit] == s and left[s] < 2):
                fit -= 1
            if fit < 0:
                n = left[s]
                put(s, n, bins, 1)
                room(capacity - s, bins, n)
            elif large[fit] == s:
                n = left[s] // 2
                put(s, 2 * n, bins, 2)
                room(capacity - 2 * s, bins, n)
            else:
                t = large[fit]
                n = min(left[s], left[t])
                put(s, n, bins, 1)
                put(t, n, bins, 1)
                room(capacity - s - t, bins, n)
            bins += n
    for s in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        while left[s]:
            i = bisect.bisect_left(gaps, s)
            if i == len(gaps):
                per = capacity // s
                n = -(-left[s] // per)
                rooms[capacity] = [(bins, n)]
                gaps.append(capacity)
                bins += n
                continue
            gap = gaps[i]
            first, count = rooms[gap].pop()
            if not rooms[gap]:
                del rooms[gap]
                gaps.pop(i)
            per = min(gap // s, left[s])
            full = min(count, left[s] // per)
            put(s, full * per, first, per)
            room(gap - per * s, first, full)
            room(gap, first + full, count - full)
    if len(segments) > MAX_SEGMENTS:
        raise ValueError(f"the plan has {len(segments)} segments; use a smaller capacity")
    table = np.array(sorted(segments), dtype=np.int64).reshape(-1, 4)
    return table, bins


def _ranked(pieces: DataFrame, slots: int) -> DataFrame:
    """Number the items of each size from 0 without ever bringing a size into one task."""
    slotted = pieces.withColumn("_slot", F.pmod(F.xxhash64("doc_id", "part"), F.lit(slots)))
    counts = slotted.groupBy("size", "_slot").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy("size").orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("size", "_slot", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = W.partitionBy("size", "_slot").orderBy("doc_id", "part")
    return slotted.join(offsets, ["size", "_slot"]).withColumn("rank", F.col("_offset") + F.row_number().over(inside) - 1)


def pack(sizes: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Items with their containers: ``doc_id, part, token_start, size, container``.

    sizes: ``doc_id, tokens``. A text longer than the capacity is cut into parts of exactly the capacity and one
    remainder; every other text is one item. NULL, 0 and negative token counts take one token of room, so that a
    blank text is still placed and no container holds more than ``capacity`` items. Repeated rows are packed as often
    as they occur. ``sizes`` is read more than once and should be a written table.
    """
    tokens = F.greatest(F.coalesce(F.col("tokens"), F.lit(0)), F.lit(1)).cast("long")
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("t") - 1) / capacity)))
    pieces = sizes.select("doc_id", tokens.alias("t")).select("doc_id", "t", parts.alias("part"))
    pieces = pieces.select("doc_id", "part", (F.col("part") * capacity).alias("token_start"), F.least(F.lit(capacity), F.col("t") - F.col("part") * capacity).alias("size"))
    histogram = {r["size"]: r["n"] for r in pieces.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}
    segments, _ = plan(histogram, capacity)
    shift = np.int64(1) << np.int64(42)
    starts = segments[:, 0] * shift + segments[:, 1]
    first, per = segments[:, 2].copy(), segments[:, 3].copy()
    sent = sizes.sparkSession.sparkContext.broadcast((starts, segments[:, 1].copy(), first, per))

    @F.pandas_udf("long")
    def container(size: pd.Series, rank: pd.Series) -> pd.Series:
        starts, ranks, first, per = sent.value
        r = rank.to_numpy(np.int64)
        i = np.searchsorted(starts, size.to_numpy(np.int64) * shift + r, side="right") - 1
        return pd.Series(first[i] + (r - ranks[i]) // per[i])

    slots = max(1, -(-sum(histogram.values()) // ROWS_PER_SLOT))
    ranked = _ranked(pieces, slots)
    return ranked.select("doc_id", "part", "token_start", "size", container("size", "rank").alias("container"))


def containers(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row per container: ``container, used, room, n_items, items``; at most ``capacity`` items in each."""
    listed = F.sort_array(F.collect_list(F.struct("doc_id", "part", "token_start", "size")))
    grouped = items.groupBy("container").agg(F.sum("size").alias("used"), F.count(F.lit(1)).alias("n_items"), listed.alias("items"))
    return grouped.select("container", "used", (F.lit(capacity) - F.col("used")).alias("room"), "n_items", "items")


def pack_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, tokenizer: str = TOKENIZER) -> DataFrame:
    """The containers of a table of texts."""
    sizes = written(token_sizes(df, id_col, text_col, tokenizer), "sizes")
    return containers(pack(sizes, capacity), capacity)

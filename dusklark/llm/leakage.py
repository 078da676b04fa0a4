"""Evaluation texts leaking into training texts.

Every task cuts its documents into shards of bounded length and indexes each as a sequence of word numbers
(:mod:`dusklark.llm.fmindex`). All phrases of the evaluation items, runs of ``words`` consecutive words or whole items
that are shorter, are searched backwards in a shard at once and located by sampled suffix positions. Adjacent
occurrences merge into spans. The items are the query set: they are sent to all tasks in blocks of bounded size, and
every block meets every document.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dusklark.llm.fmindex import FMIndex
from dusklark.session import scratch, spread

WORDS = 12
#: Words of text in one shard, and words of evaluation items sent to the tasks at a time.
SHARD_WORDS, BLOCK_WORDS = 1_000_000, 2_000_000
#: Characters of text held for a shard, whatever words they make.
SHARD_CHARS = 16_000_000
#: Rows of the suffix order located at a time.
LOCATE_AT_ONCE = 1_000_000
SEPARATOR, OTHER, FIRST_WORD = 1, 2, 3
_FORMAT = regex.compile(r"\p{Cf}+")
_WORD = re.compile(r"[^\W_]+")


def normal(text: str | None) -> str:
    """Without invisible format characters, NFKC, case-folded."""
    if not text:
        return ""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFKC", _FORMAT.sub("", text)).casefold()


def split_words(text: str | None) -> list[str]:
    """The longest runs of letters and digits of the normalised text."""
    return _WORD.findall(normal(text))


@lru_cache(maxsize=1)
def _follows() -> frozenset[str]:
    """Characters that a composition may put together with the one before them."""
    seconds = {chr(c) for c in (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3))}  # vowels and finals of Hangul
    for cp in range(0x110000):
        parts = unicodedata.decomposition(chr(cp)).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            seconds.add(chr(int(parts[1], 16)))
    return frozenset(seconds)


@lru_cache(maxsize=65_536)
def _opens(c: str) -> bool:
    """Whether normalising what stands before a character and what begins with it apart gives the same as together."""
    if c.isascii():
        return True
    first = unicodedata.normalize("NFKD", c)[0]
    return unicodedata.combining(first) == 0 and first not in _follows()


def word_places(text: str) -> list[tuple[int, int]]:
    """Where each word of :func:`split_words` stands in the text as written.

    Format characters go first, as they do in :func:`normal`. What is left is normalised in the smallest pieces whose
    normal forms together are that of the whole; a word stands where the pieces that it touches stand.
    """
    at = list(range(len(text)))
    if not text.isascii():
        gone = {i for m in _FORMAT.finditer(text) for i in range(*m.span())}
        at = [i for i in at if i not in gone]
    starts = [k for k, i in enumerate(at) if k == 0 or _opens(text[i])]
    pieces, places = [], []
    for a, z in zip(starts, [*starts[1:], len(at)]):
        p = normal("".join(text[i] for i in at[a:z]))
        pieces.append(p)
        places += [(at[a], at[z - 1] + 1)] * len(p)
    return [(places[m.start()][0], places[m.end() - 1][1]) for m in _WORD.finditer("".join(pieces))]


class Phrases:
    """The search phrases of a block of items: distinct runs of words, each with the items it comes from."""

    def __init__(self, items: list[tuple[int, str]], words: int = WORDS):
        self.words = words
        self.numbers: dict[str, int] = {}
        found: dict[tuple[int, ...], list[int]] = {}
        for item, text in items:
            ids = tuple(self.numbers.setdefault(w, FIRST_WORD + len(self.numbers)) for w in split_words(text))
            for a in range(max(1, len(ids) - words + 1) if ids else 0):
                at = found.setdefault(ids[a : a + words], [])
                if item not in at:
                    at.append(item)
        keys = list(found)
        self.lengths = np.array([len(k) for k in keys], dtype=np.int64)
        self.patterns = np.zeros((len(keys), words), dtype=np.int64)
        for i, k in enumerate(keys):
            self.patterns[i, words - len(k) :] = k
        owners = [found[k] for k in keys]
        self.owner_at = np.concatenate([[0], np.cumsum([len(o) for o in owners])]).astype(np.int64)
        self.owners = np.array([i for o in owners for i in o], dtype=np.int64)
        self.symbols = FIRST_WORD + len(self.numbers)

    def in_shard(self, texts: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Occurrences in the given sequences of word numbers: index of the sequence, first word, length, phrase."""
        if not len(self.patterns) or not any(len(t) for t in texts):
            return
        mark = np.array([SEPARATOR], dtype=np.int64)
        joined = np.concatenate([x for t in texts for x in (t, mark)])
        # words that no phrase has can't take part: one of each run is enough
        keep = (joined != OTHER) | np.concatenate([[True], joined[1:] != joined[:-1]])
        origin, text = np.flatnonzero(keep), joined[keep]
        index = FMIndex(text, self.symbols)
        lo, hi = index.intervals(self.patterns, self.lengths)
        hits = np.flatnonzero(hi > lo)
        ends = np.cumsum([len(t) + 1 for t in texts])
        per = max(1, LOCATE_AT_ONCE)
        counts = hi[hits] - lo[hits]
        offsets = np.concatenate([[0], np.cumsum(counts)])
        for a in range(0, int(offsets[-1]), per):
            flat = np.arange(a, min(a + per, int(offsets[-1])))
            which = np.searchsorted(offsets, flat, side="right") - 1
            rows = lo[hits][which] + flat - offsets[which]
            at = origin[index.locate(rows)]
            doc = np.searchsorted(ends, at, side="right")
            starts = np.concatenate([[0], ends])[doc]
            phrase = hits[which]
            yield doc, at - starts, self.lengths[phrase], phrase

    def numbered(self, words: list[str]) -> np.ndarray:
        get = self.numbers.get
        return np.array([get(w, OTHER) for w in words], dtype=np.int64)


def merged(starts: np.ndarray, stops: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping or touching spans of one group put together."""
    order = np.lexsort((starts, groups))
    s, e, g = starts[order], stops[order], groups[order]
    # running end inside each group
    big = np.int64(e.max(initial=0) + 1)
    reach = np.maximum.accumulate(e + g * big) - g * big
    new = np.concatenate([[True], (g[1:] != g[:-1]) | (s[1:] > reach[:-1])])
    first = np.flatnonzero(new)
    return s[first], np.maximum.reduceat(e, first), g[first]


def _blocks(items: DataFrame, id_col: str, text_col: str) -> tuple[int, Iterator[list[tuple[int, str]]]]:
    """How many blocks of bounded size the items make, and the blocks, read one after the other."""
    plain = items.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t")).filter("i IS NOT NULL AND t IS NOT NULL")
    chars = plain.agg(F.sum(F.length("t")).alias("n")).first()["n"] or 0
    count = max(1, -(-chars // (4 * BLOCK_WORDS)))
    return count, ([(r["i"], r["t"]) for r in plain.filter(F.pmod(F.xxhash64("i"), F.lit(count)) == b).collect()] for b in range(count))


def leaked_spans(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text", words: int = WORDS) -> DataFrame:
    """Where items stand in documents: ``doc_id, item_id, word_start, word_end, char_start, char_end``.

    A span is a longest chain of overlapping or touching occurrences of one item's phrases; word numbers count from
    0, ends are exclusive, characters are those of the text as written. NULL and empty texts and items without a word
    have no spans; repeated documents each have their own; an item with several ids counts for each. Documents
    longer than a shard are cut with an overlap of ``words - 1`` words, so no phrase is lost at a cut. Where the items
    are more than one block, the blocks are searched in turn, each block's spans are written and its phrases given up
    before the next is read.
    """
    spark = docs.sparkSession
    id_type = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {id_type}, item_id long, word_start long, word_end long, char_start long, char_end long"
    plain = spread(docs.select(F.col(doc_id).alias("doc_id"), F.col(doc_text).alias("text")).filter("text IS NOT NULL"))
    count, blocks = _blocks(items, item_id, item_text)
    path = scratch(spark, "spans") if count > 1 else None
    for block in blocks:
        sent = spark.sparkContext.broadcast(Phrases(block, words))

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            phrases, buffer, held, chars, kind = sent.value, [], 0, 0, pa.null()
            for b in batches:
                kind = b.schema.field("doc_id").type
                for i, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                    ids = phrases.numbered(split_words(text))
                    buffer.append((i, text, ids))
                    held, chars = held + len(ids), chars + len(text)
                    if held >= SHARD_WORDS or chars >= SHARD_CHARS:
                        yield _search(phrases, buffer, kind)
                        buffer, held, chars = [], 0, 0
            if buffer:
                yield _search(phrases, buffer, kind)

        part = plain.mapInArrow(search, schema)
        if path is None:
            return part
        part.write.mode("append").parquet(path)
        sent.destroy()
    return spark.read.schema(schema).parquet(path)


def _search(phrases: Phrases, buffer: list[tuple[object, str, np.ndarray]], kind: pa.DataType) -> pa.RecordBatch:
    pieces, owner, offset = [], [], []
    for d, (_, _, ids) in enumerate(buffer):
        for a in range(0, max(1, len(ids) - phrases.words + 1), SHARD_WORDS):
            pieces.append(ids[a : a + SHARD_WORDS + phrases.words - 1])
            owner.append(d)
            offset.append(a)
    owner_, offset_ = np.array(owner, dtype=np.int64), np.array(offset, dtype=np.int64)
    doc, item, start, stop = [], [], [], []
    size = np.cumsum([len(p) for p in pieces])
    for lot in np.split(np.arange(len(pieces)), np.searchsorted(size, np.arange(2 * SHARD_WORDS, int(size[-1]) if len(size) else 0, 2 * SHARD_WORDS))):
        for d, s, n, phrase in phrases.in_shard([pieces[i] for i in lot]):
            own = phrases.owner_at[phrase + 1] - phrases.owner_at[phrase]
            of = np.repeat(np.arange(len(d)), own)
            nth = np.arange(len(of)) - np.repeat(np.cumsum(own) - own, own)
            doc.append(owner_[lot[d]][of])
            item.append(phrases.owners[phrases.owner_at[phrase][of] + nth])
            start.append((s + offset_[lot[d]])[of])
            stop.append((s + offset_[lot[d]] + n)[of])
    out = pa.schema([("doc_id", kind), *((c, pa.int64()) for c in ("item_id", "word_start", "word_end", "char_start", "char_end"))])
    if not doc:
        return pa.RecordBatch.from_pylist([], schema=out)
    d, i, s, e = map(np.concatenate, (doc, item, start, stop))
    names, code = np.unique(i, return_inverse=True)
    s, e, g = merged(s, e, d * len(names) + code)
    d, i = g // len(names), names[g % len(names)]
    places = {x: word_places(buffer[x][1]) for x in np.unique(d)}
    a = [places[x][y][0] for x, y in zip(d, s)]
    z = [places[x][y - 1][1] for x, y in zip(d, e)]
    return pa.RecordBatch.from_arrays([pa.array([buffer[x][0] for x in d], type=kind), *(pa.array(x, type=pa.int64()) for x in (i, s, e, a, z))], schema=out)


def removal_spans(spans: DataFrame) -> DataFrame:
    """What to cut from each document: ``doc_id, spans`` with the character spans of all items merged, in order."""
    listed = F.sort_array(F.collect_set(F.struct("char_start", "char_end")))

    def step(acc, x):
        last = F.try_element_at(acc, F.lit(-1))
        joined = F.concat(F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(last["char_start"].alias("char_start"), F.greatest(last["char_end"], x["char_end"]).alias("char_end"))))
        return F.when((F.size(acc) > 0) & (x["char_start"] <= last["char_end"]), joined).otherwise(F.concat(acc, F.array(x)))

    empty = F.slice(F.col("l"), 1, 0)
    return spans.groupBy("doc_id").agg(listed.alias("l")).select("doc_id", F.aggregate("l", empty, step).alias("spans"))

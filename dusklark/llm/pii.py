"""Personal information inside free text: found by a character tagger, checked for form, replaced by placeholders.

Texts are cut into overlapping windows, every window is decoded by a bidirectional LSTM with CRF transitions
(:mod:`dusklark.llm.tagger`), and the spans of all windows of a text are reconciled: where windows disagree, the span
farthest from its window's edges wins. An exact check of each kind's form then trims a span to its defined ends or
rejects it; it never adds one.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dusklark.llm.pii_labels import KINDS
from dusklark.llm.tagger import Tagger
from dusklark.session import spread

MODEL = str(Path(__file__).with_name("pii_model.npz"))
WINDOW, OVERLAP = 384, 96
#: Windows decoded at a time, and characters gathered before they are.
BATCH, GATHER = 256, 1_000_000
PLACEHOLDERS = {"email": "[EMAIL]", "phone": "[PHONE]", "id_number": "[ID_NUMBER]", "address": "[ADDRESS]", "name": "[NAME]"}

# What belongs to no mention.
_TITLE = re.compile(r"^(?:(?:고객|기사|담당자:?|Mrs?|Ms|Miss|Dr|Prof|Herrn?|Frau|Fr|Hr|Sir|Madam|Driver|Fahrer|Customer|Kunde|Kundin|Hi|Hallo|Thanks)\b\.?\s+)+", re.IGNORECASE)
_HONORIFIC = re.compile(r"\s*(?:씨|님|군|양|선생님|매니저|드림|기사)$")
_POSSESSIVE = re.compile(r"['’][sS]?$")
_EXTENSION = re.compile(r"[\s,;]*(?:ext|x|ex|Durchwahl|Dw|내선|#)\.?\s*\d*$", re.IGNORECASE)
_DOTTED = re.compile(r"(?:\brd|str)$", re.IGNORECASE)
_ABBREVIATED = re.compile(r"\b(?:st|ave|ln|blvd|pl|sq|dr)$", re.IGNORECASE)
_AT = re.compile(r"[@＠]|[(\[{<]\s*(?:at|ät)\s*[)\]}>]|\sat\s", re.IGNORECASE)
_PLAIN_EMAIL = re.compile(r"[^\s<>(),;:\"']+[@＠][^\s<>(),;:\"']+(?:\s+dot\s+[^\s<>(),;:\"']+)*(?<![.!?])")


def windows(length: int) -> list[tuple[int, int]]:
    """Overlapping windows that cover a text."""
    if length <= WINDOW:
        return [(0, length)] if length else []
    step = WINDOW - OVERLAP
    starts = list(range(0, length - OVERLAP, step))
    return [(a, min(a + WINDOW, length)) for a in starts]


def labelled(labels: np.ndarray) -> list[tuple[int, int, str]]:
    """Spans of one row of labels."""
    out: list[list[int]] = []
    for i in np.flatnonzero(labels).tolist():
        x = int(labels[i])
        k = (x - 1) // 2
        if x % 2 == 1 or not out or out[-1][2] != k or i != out[-1][1]:
            out.append([i, i + 1, k])
        else:
            out[-1][1] = i + 1
    return [(a, z, KINDS[k]) for a, z, k in out]


def reconciled(found: list[tuple[int, int, str, int]]) -> list[tuple[int, int, str]]:
    """Spans without overlaps: those farther from an edge of their window go first, then the longer."""
    out: list[tuple[int, int, str]] = []
    for a, z, kind, _ in sorted(set(found), key=lambda s: (-s[3], s[0] - s[1], s[0])):
        at = bisect.bisect_left(out, (a, z, kind))
        if (at == 0 or out[at - 1][1] <= a) and (at == len(out) or z <= out[at][0]):
            out.insert(at, (a, z, kind))
    return out


def settled(text: str, a: int, z: int, kind: str) -> tuple[int, int] | None:
    """The span with its defined ends, or None if what stands there can't be of its kind."""
    s = text[a:z]
    if kind in ("phone", "id_number"):
        if kind == "phone":
            s = _EXTENSION.sub("", s)
        lead = re.search(r"[+＋(（]?\d" if kind == "phone" else r"\d", s)
        digits = [i for i, c in enumerate(s) if c.isdigit()]
        low, high = (7, 16) if kind == "phone" else (8, 16)
        if lead is None or not low <= len(digits) <= high or "*" in s:
            return None
        return a + lead.start(), a + digits[-1] + 1
    if kind == "email":
        lead, end = len(s) - len(s.lstrip(" <(\"'\t\n:;,")), len(s.rstrip(" >)\"'\t\n:;,.!?"))
        if end <= lead or not _AT.search(s[lead:end]):
            return None
        # written with the sign, an address has no blank in front of it and none behind but around a spelled-out dot
        if m := _PLAIN_EMAIL.search(s, lead, end):
            lead, end = m.span()
        return a + lead, a + end
    if kind == "address":
        lead, end = len(s) - len(s.lstrip(" \t\n:;,.\"'")), len(s.rstrip(" \t\n:;,.\"'"))
        if end <= lead or not any(c.isdigit() for c in s):
            return None
        after = text[a + end : a + end + 2]
        if after[:1] == "." and (_DOTTED.search(s[:end]) or after[1:] in (",", ";") and _ABBREVIATED.search(s[:end])):
            end += 1
        return a + lead, a + end
    lead = len(s) - len(s.lstrip(" \t\n:;,.\"'(<>-/"))
    lead += m.end() if (m := _TITLE.match(s[lead:])) else 0
    s = s[lead:].rstrip(" \t\n:;,\"()<>-/")
    s = _POSSESSIVE.sub("", s)
    s = _HONORIFIC.sub("", s) if len(s) > 2 else s
    if s.endswith(".") and not re.search(r"(?:^|\s|\.)\w\.$", s):
        s = s[:-1]
    if not s or any(c.isdigit() for c in s) or "@" in s or not any(c.isalpha() for c in s) or len(s.strip(".")) < 2:
        return None
    if s.isalpha() and s == s.lower() and s != s.upper():  # one plain word in small letters
        return None
    return a + lead, a + lead + len(s)


_JOINT = {
    "email": re.compile(r"[,;]\s+"),
    "address": re.compile(r"\s+to\s+(?=\S.*\d|\d)", re.DOTALL),
    "name": re.compile(r"(?<=[^\W\d_]),\s+|\s+(?:and|und)\s+"),
}


def parted(text: str, a: int, z: int, kind: str) -> list[tuple[int, int]]:
    """One span for each mention where a separator shows that a span holds two: two addresses, two e-mails, two full names."""
    if kind not in _JOINT or not (cuts := list(_JOINT[kind].finditer(text, a, z))):
        return [(a, z)]
    out, at = [], a
    for m in cuts:
        left, right = text[at : m.start()], text[m.end() : z]
        full = len(left.split()) > 1 and (len(right.split()) > 1 or "," not in m.group())
        if kind == "name" and not full:
            continue
        if kind == "email" and not (_AT.search(left) and _AT.search(right)):
            continue
        out.append((at, m.start()))
        at = m.end()
    return [*out, (at, z)]


def find_in(texts: list[str], tagger: Tagger) -> list[list[tuple[int, int, str]]]:
    """Checked spans of each text."""
    rows = [(i, a, z) for i, t in enumerate(texts) for a, z in windows(len(t))]
    rows.sort(key=lambda r: r[2] - r[1])
    codes = [tagger.alphabet.encode(t) for t in texts]
    found: list[list[tuple[int, int, str, int]]] = [[] for _ in texts]
    for at in range(0, len(rows), BATCH):
        lot = rows[at : at + BATCH]
        lengths = np.array([z - a for _, a, z in lot])
        ids = np.zeros((len(lot), int(lengths.max())), dtype=np.int32)
        for r, (i, a, z) in enumerate(lot):
            ids[r, : z - a] = codes[i][a:z]
        labels = tagger.decode(ids, lengths)
        for r in np.flatnonzero(labels.any(axis=1)):
            i, a, z = lot[r]
            for s, e, kind in labelled(labels[r, : z - a]):
                margin = min(s if a else WINDOW, z - a - e if z < len(texts[i]) else WINDOW, WINDOW)
                found[i].append((a + s, a + e, kind, margin))
    out = []
    for text, spans in zip(texts, found):
        good = []
        for a, z, kind in reconciled(spans):
            for x, y in parted(text, a, z, kind):
                if ends := settled(text, x, y, kind):
                    good.append((*ends, kind))
        out.append(good)
    return out


def redacted(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each span replaced by its kind's placeholder, otherwise as it was."""
    out, at = [], 0
    for a, z, kind in spans:
        out += [text[at:a], PLACEHOLDERS[kind]]
        at = z
    return "".join(out) + text[at:]


def _over(batches: Iterator[pa.RecordBatch], tagger: Tagger) -> Iterator[tuple[pa.Array, list[str | None], list[list[tuple[int, int, str]]]]]:
    for b in batches:
        ids, texts = b.column("doc_id"), b.column("text").to_pylist()
        a = 0
        while a < len(texts):
            z, chars = a, 0
            while z < len(texts) and (z == a or chars < GATHER):
                chars += len(texts[z] or "")
                z += 1
            yield ids.slice(a, z - a), texts[a:z], find_in([t or "" for t in texts[a:z]], tagger)
            a = z


def find_mentions(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL) -> DataFrame:
    """``doc_id, kind, start, end, mention``: every mention, written as in the text.

    NULL and empty texts have none; repeated rows each have theirs; a text is read whole, however long.
    """
    sent = df.sparkSession.sparkContext.broadcast(Tagger.load(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, spans in _over(batches, sent.value):
            rows = [(n, k, a, z, t[a:z]) for n, (t, s) in enumerate(zip(texts, spans)) for a, z, k in s]
            at, kinds, starts, ends, mentions = zip(*rows) if rows else ((),) * 5
            whole = pa.int64()
            columns = [ids.take(pa.array(at, type=whole)), pa.array(kinds, type=pa.string()), pa.array(starts, type=whole), pa.array(ends, type=whole), pa.array(mentions, type=pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "kind", "start", "end", "mention"])

    id_type = df.schema[id_col].dataType.simpleString()
    return spread(df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))).mapInArrow(run, f"doc_id {id_type}, kind string, start long, end long, mention string")


def redact(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL) -> DataFrame:
    """``doc_id, text, n_mentions``: every row, with typed placeholders in place of personal information; NULL stays NULL."""
    sent = df.sparkSession.sparkContext.broadcast(Tagger.load(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, spans in _over(batches, sent.value):
            shown = [None if t is None else redacted(t, s) for t, s in zip(texts, spans)]
            columns = [ids, pa.array(shown, type=pa.string()), pa.array([len(s) for s in spans], type=pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text", "n_mentions"])

    id_type = df.schema[id_col].dataType.simpleString()
    return spread(df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))).mapInArrow(run, f"doc_id {id_type}, text string, n_mentions long")

"""Training of the tagger: ``python -m dusklark.llm.pii_train DOCUMENTS.parquet MODEL.npz [STEPS [START.npz]]``.

A sample of at most ``SAMPLE_ROWS`` rows, drawn by a hash of the identifier, is labelled by the sentence frames of
:mod:`dusklark.llm.pii_labels`; copies of every labelled text have their names and digits replaced by made-up ones.
As many made-up texts with ordinary contexts (:mod:`dusklark.llm.pii_made`) stand beside them. Loss: negative log
likelihood of the CRF; gradients are written out. The number of steps, the shards of a batch and the seed are fixed, so
a run can be repeated; the weights are those of the last step, none are chosen.
"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter
from concurrent.futures import ProcessPoolExecutor
from multiprocessing import get_context

import numpy as np

from dusklark.llm import pii, pii_labels
from dusklark.llm.pii_made import Maker
from dusklark.llm.tagger import FORBIDDEN, LABELS, Alphabet, K, Tagger, allowed, reversed_rows, sigmoid

SAMPLE_ROWS = 10_000
SPAN, WIDTH, HIDDEN, BATCH, RATE, SEED = 160, 24, 48, 512, 4e-3, 7
#: A batch's gradients are summed over so many parts, whatever the number of processes. Steps from the start, and from given weights.
SHARDS, STEPS = 8, 2_000
_NUMBER = {x: i for i, x in enumerate(LABELS)}
# Syllables of made-up names.
_HEADS = "Bra Ker Lin Mor Tal Ves Gun Hal Fre Ost Pel Rin Sal Tor Ul Wen Yar Zan Dor El Fa Gre Ho Iv Jo Ka Lo Mi Na Or".split()
_TAILS = "len den mar son ric wick ford by hart mann stein ley more well dorf ne ra lia ton bert ina el us a o".split()


def made_up(name: str, rng: np.random.Generator) -> str:
    """Another name of the same build."""
    if "가" <= name[0] <= "힣":
        return "".join(chr(0xAC00 + int(rng.integers(0, 19)) * 588 + int(rng.integers(0, 588))) if "가" <= c <= "힣" else c for c in name)

    def word(m) -> str:
        w = m.group()
        if len(w) == 1:
            return chr(65 + int(rng.integers(26))) if w.isupper() else chr(97 + int(rng.integers(26)))
        new = _HEADS[int(rng.integers(len(_HEADS)))] + (_TAILS[int(rng.integers(len(_TAILS)))] if rng.random() < 0.8 else "") + (_TAILS[int(rng.integers(len(_TAILS)))] if rng.random() < 0.4 else "")
        return new.upper() if w.isupper() else new.lower() if w.islower() else new

    return pii_labels.regex.sub(r"[\p{L}\p{M}]+", word, name)


def rewritten(name: str, rng: np.random.Generator) -> str:
    """A two-part name sometimes with the family name first, in capitals, or in small letters."""
    parts, way = name.split(" "), rng.random()
    if not name.isascii() or len(parts) != 2 or "," in name or "." in name:
        return name
    if way < 0.25:
        return f"{parts[1]}, {parts[0]}"
    return name.lower() if way < 0.35 else name.upper() if way < 0.42 else name


def varied(text: str, spans: list[tuple[int, int, str]], rng: np.random.Generator) -> tuple[str, list[tuple[int, int, str]]]:
    """The text with other names and other digits inside its spans."""
    out, moved, at, size = [], [], 0, 0
    for a, z, kind in spans:
        out.append(text[at:a])
        size += a - at
        s = text[a:z]
        if kind == "name":
            s = rewritten(made_up(s, rng), rng)
        else:
            s = "".join(str(int(rng.integers(10))) if c in "0123456789" and i > 0 else c for i, c in enumerate(s))
        moved.append((size, size + len(s), kind))
        out.append(s)
        size, at = size + len(s), z
    return "".join(out) + text[at:], moved


def numbered(length: int, spans: list[tuple[int, int, str]]) -> np.ndarray:
    y = np.zeros(length, dtype=np.int8)
    for a, z, kind in spans:
        y[a] = _NUMBER[f"B-{kind}"]
        y[a + 1 : z] = _NUMBER[f"I-{kind}"]
    return y


Labelled = tuple[str, list[tuple[int, int, str]]]


def sample_pairs(texts: list[str], known: set[str], rng: np.random.Generator) -> list[Labelled]:
    """The texts with their frames' spans, each twice more with other names and digits if it has any."""
    pairs = []
    for text in texts:
        spans = pii_labels.spans(text, known)
        pairs += [(text, spans)] + ([varied(text, spans, rng), varied(text, spans, rng)] if spans else [])
    return pairs


def examples(pairs: list[Labelled], alphabet: Alphabet, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of labelled texts: all that hold a span, and up to one and a half times as many that hold none."""
    full, empty = [], []
    for t, s in pairs:
        ids, y = alphabet.encode(t), numbered(len(t), s)
        a = -int(rng.integers(SPAN // 2))
        while a < len(t):
            lo, hi = max(0, a), min(len(t), a + SPAN)
            while lo < hi and y[lo] > 0 and y[lo] % 2 == 0:  # never begin inside a span
                lo += 1
            if hi - lo > 8:
                (full if y[lo:hi].any() else empty).append((ids[lo:hi], y[lo:hi]))
            a += SPAN - 24
    rng.shuffle(empty)
    return _windows(full + empty[: int(1.5 * len(full))])


def _windows(rows: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x, y = np.zeros((len(rows), SPAN), np.int32), np.zeros((len(rows), SPAN), np.int8)
    for i, (a, b) in enumerate(rows):
        x[i, : len(a)], y[i, : len(b)] = a, b
    return x, y, np.array([len(r[0]) for r in rows], dtype=np.int64)


def _forward(p: dict, x: np.ndarray, d: str) -> tuple:
    n, steps, _ = x.shape
    hd = p[f"wh_{d}"].shape[0]
    pre = x.reshape(-1, x.shape[2]) @ p[f"wx_{d}"] + p[f"b_{d}"]
    pre = pre.reshape(n, steps, 4 * hd).transpose(1, 0, 2)
    h, c = np.zeros((steps + 1, n, hd), np.float32), np.zeros((steps + 1, n, hd), np.float32)
    gates = np.empty((steps, n, 4 * hd), np.float32)
    for t in range(steps):
        z = pre[t] + h[t] @ p[f"wh_{d}"]
        z[:, : 3 * hd] = sigmoid(z[:, : 3 * hd])
        z[:, 3 * hd :] = np.tanh(z[:, 3 * hd :])
        gates[t] = z
        c[t + 1] = z[:, hd : 2 * hd] * c[t] + z[:, :hd] * z[:, 3 * hd :]
        h[t + 1] = z[:, 2 * hd : 3 * hd] * np.tanh(c[t + 1])
    return h, c, gates


def _backward(p: dict, x: np.ndarray, state: tuple, dh_out: np.ndarray, d: str, g: dict) -> np.ndarray:
    h, c, gates = state
    steps, n, hd = dh_out.shape
    dz_all = np.empty_like(gates)
    dh, dc = np.zeros((n, hd), np.float32), np.zeros((n, hd), np.float32)
    for t in range(steps - 1, -1, -1):
        i, f, o, w = (gates[t][:, k * hd : (k + 1) * hd] for k in range(4))
        dh = dh + dh_out[t]
        tc = np.tanh(c[t + 1])
        dc = dc + dh * o * (1 - tc * tc)
        dz = dz_all[t]
        dz[:, :hd] = dc * w * i * (1 - i)
        dz[:, hd : 2 * hd] = dc * c[t] * f * (1 - f)
        dz[:, 2 * hd : 3 * hd] = dh * tc * o * (1 - o)
        dz[:, 3 * hd :] = dc * i * (1 - w * w)
        dh = dz @ p[f"wh_{d}"].T
        dc = dc * f
    flat = dz_all.reshape(-1, 4 * hd)
    g[f"wh_{d}"] = h[:-1].reshape(-1, hd).T @ flat
    g[f"wx_{d}"] = x.transpose(1, 0, 2).reshape(-1, x.shape[2]).T @ flat
    g[f"b_{d}"] = flat.sum(0)
    return (flat @ p[f"wx_{d}"].T).reshape(steps, n, -1).transpose(1, 0, 2)


def _lse(a: np.ndarray, axis: int) -> np.ndarray:
    m = a.max(axis=axis, keepdims=True)
    return (m + np.log(np.exp(a - m).sum(axis=axis, keepdims=True))).squeeze(axis)


def _crf(p: dict, e: np.ndarray, y: np.ndarray, lengths: np.ndarray, g: dict) -> tuple[float, np.ndarray]:
    """Loss and the gradient by the label scores ``e`` (rows, time, labels)."""
    n, steps, _ = e.shape
    trans = p["trans"] + allowed()
    start = p["first"] + np.where((np.arange(K) % 2 == 0) & (np.arange(K) > 0), FORBIDDEN, 0).astype(np.float32)
    live = np.arange(steps)[None, :] < lengths[:, None]
    alpha, beta = np.empty_like(e), np.zeros_like(e)
    alpha[:, 0] = e[:, 0] + start
    for t in range(1, steps):
        step = _lse(alpha[:, t - 1][:, :, None] + trans[None], 1) + e[:, t]
        alpha[:, t] = np.where(live[:, t][:, None], step, alpha[:, t - 1])
    for t in range(steps - 2, -1, -1):
        step = _lse(trans[None] + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        beta[:, t] = np.where(live[:, t + 1][:, None], step, 0)
    z = _lse(alpha[:, -1], 1)
    de = np.exp(alpha + beta - z[:, None, None]) * live[:, :, None]
    rows = np.arange(n)
    gold = p["first"][y[:, 0]] + e[:, 0][rows, y[:, 0]]
    dt = np.zeros((K, K), np.float32)
    for t in range(1, steps):
        on = live[:, t]
        if not on.any():
            break
        pair = alpha[on, t - 1][:, :, None] + trans[None] + (e[on, t] + beta[on, t])[:, None, :] - z[on][:, None, None]
        dt += np.exp(pair).sum(0)
        np.subtract.at(dt, (y[on, t - 1], y[on, t]), 1)
        gold = gold + np.where(on, p["trans"][y[:, t - 1], y[:, t]] + e[:, t][rows, y[:, t]], 0)
    g["trans"] = dt / n
    first = np.exp(alpha[:, 0] + beta[:, 0] - z[:, None])
    np.subtract.at(first, (rows, y[:, 0]), 1)
    g["first"] = first.sum(0) / n
    r, t = np.nonzero(live)
    de[r, t, y[r, t]] -= 1
    return float((z - gold).mean()), de / n


def gradients(tagger: Tagger, ids: np.ndarray, y: np.ndarray, lengths: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    p, g = tagger.p, {}
    hd = tagger.hidden
    back_ids = reversed_rows(ids, lengths)
    x, xb = p["emb"][ids], p["emb"][back_ids]
    fwd, bwd = _forward(p, x, "f"), _forward(p, xb, "b")
    hf = fwd[0][1:].transpose(1, 0, 2)
    hb = reversed_rows(bwd[0][1:].transpose(1, 0, 2), lengths)
    both = np.concatenate([hf, hb], axis=2)
    e = both @ p["wo"] + p["bo"]
    loss, de = _crf(p, e, y.astype(np.int64), lengths, g)
    g["wo"] = both.reshape(-1, 2 * hd).T @ de.reshape(-1, K)
    g["bo"] = de.sum((0, 1))
    dboth = de @ p["wo"].T
    dx = _backward(p, x, fwd, np.ascontiguousarray(dboth[:, :, :hd].transpose(1, 0, 2)), "f", g)
    dxb = _backward(p, xb, bwd, np.ascontiguousarray(reversed_rows(dboth[:, :, hd:], lengths).transpose(1, 0, 2)), "b", g)
    g["emb"] = np.zeros_like(p["emb"])
    np.add.at(g["emb"], ids.ravel(), dx.reshape(-1, dx.shape[2]))
    np.add.at(g["emb"], back_ids.ravel(), dxb.reshape(-1, dxb.shape[2]))
    return loss, g


_work: dict = {}


def _prepare(tagger: Tagger, data: tuple) -> None:
    _work.update(tagger=tagger, data=data)


def _shard(params: dict, rows: np.ndarray) -> tuple[float, dict]:
    tagger, (x, y, lengths) = _work["tagger"], _work["data"]
    tagger.p = params
    width = int(lengths[rows].max())
    return gradients(tagger, x[rows, :width], y[rows, :width], lengths[rows])


def fit(tagger: Tagger, data: tuple[np.ndarray, np.ndarray, np.ndarray], steps: int, rate: float, rng: np.random.Generator, processes: int = 0, say=print) -> None:
    """Adam for ``steps`` batches with a rate that rises and then falls evenly. Rows are drawn without replacement, round after round."""
    m, v = ({k: np.zeros_like(a) for k, a in tagger.p.items()} for _ in range(2))
    batch, order, losses, began = min(BATCH, len(data[0])), np.zeros(0, dtype=np.int64), [], time.time()
    _prepare(tagger, data)
    # workers inherit the data
    pool = ProcessPoolExecutor(processes, get_context("fork")) if processes > 1 else None
    for step in range(1, steps + 1):
        if len(order) < batch:
            order = rng.permutation(len(data[0]))
        rows, order = order[:batch], order[batch:]
        parts = [np.sort(p) for p in np.array_split(rows, min(SHARDS, batch))]
        found = list((pool.map if pool else map)(_shard, [tagger.p] * len(parts), parts))
        share = [len(p) / batch for p in parts]
        losses.append(sum(w * loss for w, (loss, _) in zip(share, found)))
        g = {k: sum(w * q[k] for w, (_, q) in zip(share, found)) for k in tagger.p}
        clip = min(1.0, 5.0 / (np.sqrt(sum(float((q * q).sum()) for q in g.values())) + 1e-6))
        now = rate * min(1.0, step / 50) * max(0.02, 1 - step / steps)
        for k, q in g.items():
            m[k] += 0.1 * (q * clip - m[k])
            v[k] += 0.01 * ((q * clip) ** 2 - v[k])
            tagger.p[k] = (tagger.p[k] - now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        if step % 50 == 0 or step == steps:
            say(f"step {step} of {steps}, {len(data[0])} windows, loss {np.mean(losses[-50:]):.4f}, {time.time() - began:.0f} s")
    if pool:
        pool.shutdown()
    tagger._tables.clear()


def train(texts: list[str], steps: int = STEPS, hidden: int = HIDDEN, seed: int = SEED, made: int = 0, start: Tagger | None = None, processes: int = 0, say=print) -> Tagger:
    """Fit to windows of the texts and of ``made`` made-up texts, from ``start`` or from scratch."""
    rng = np.random.default_rng(seed)
    known = pii_labels.known_parts(texts)
    maker = Maker(rng)
    pairs = sample_pairs(texts, known, rng) + [maker.text() for _ in range(made)]
    fresh = start is None
    if fresh:
        counts = Counter(c for t, _ in pairs for c in t)
        start = Tagger.fresh(Alphabet("".join(sorted(c for c, n in counts.items() if n >= 20))), WIDTH, hidden, seed)
    fit(start, examples(pairs, start.alphabet, rng), steps, RATE if fresh else RATE / 4, rng, processes, say)
    return start


def sample_texts(path: str, rows: int = SAMPLE_ROWS, seed: int = SEED) -> list[str]:
    """At most ``rows`` texts, those whose identifiers have the smallest hashes; only these reach the driver."""
    from pyspark.sql import functions as F

    from dusklark.session import local_session

    t = local_session().read.parquet(path).select("doc_id", "text").filter("text <> ''")
    return [r["text"] for r in t.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(rows).collect()]


def main(args: list[str]) -> None:
    texts = sample_texts(args[0])
    steps = int(args[2]) if len(args) > 2 else STEPS
    start = Tagger.load(args[3]) if len(args) > 3 else None
    train(texts, steps=steps, made=2 * SAMPLE_ROWS, start=start, processes=os.cpu_count() or 1).save(args[1])


if __name__ == "__main__":
    main(sys.argv[1:])

"""A character tagger in numpy: bidirectional LSTM, linear-chain CRF, Viterbi decoding."""

from __future__ import annotations

import unicodedata

import numpy as np

from dusklark.llm.pii_labels import KINDS

#: Outside, then begin and inside of each kind.
LABELS = ["O", *[f"{p}-{k}" for k in KINDS for p in ("B", "I")]]
K = len(LABELS)
#: Embeddings shared by characters that training hardly saw.
BUCKETS = 64
FORBIDDEN = -1e4


def allowed() -> np.ndarray:
    """0 where a label may follow another, else a large negative score: an inside needs its begin or inside before it."""
    t = np.zeros((K, K), dtype=np.float32)
    for i in range(K):
        for j in range(2, K, 2):
            if i not in (j, j - 1):
                t[i, j] = FORBIDDEN
    return t


class Alphabet:
    """Numbers for characters: one each for the known ones, shared numbers for all others; compatible forms are equal."""

    def __init__(self, known: str):
        self.known = known
        self.size = 1 + len(known) + BUCKETS
        numbers = {c: i + 1 for i, c in enumerate(known)}
        table = np.arange(0x110000, dtype=np.int64) % BUCKETS + 1 + len(known)
        for cp in range(0x110000):
            if 0xD800 <= cp < 0xE000:
                continue
            c = chr(cp)
            if (n := numbers.get(c)) is None and cp > 0x7F:
                plain = unicodedata.normalize("NFKC", c)
                n = numbers.get(plain) if len(plain) == 1 else None
            if n is not None:
                table[cp] = n
        self.table = table.astype(np.int16)  # sent as it is, not made again by every worker

    def encode(self, text: str) -> np.ndarray:
        return self.table[np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def reversed_rows(a: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each row backwards within its own length; what lies behind stays."""
    at = np.arange(a.shape[1])[None, :]
    back = np.where(at < lengths[:, None], lengths[:, None] - 1 - at, at)
    return np.take_along_axis(a, back if a.ndim == 2 else back[:, :, None], axis=1)


class Tagger:
    """Parameters: ``emb``; per direction ``wx, wh, b`` (gates in the order in, forget, out, new); ``wo, bo``; ``trans, first``."""

    def __init__(self, alphabet: Alphabet, params: dict[str, np.ndarray]):
        self.alphabet, self.p = alphabet, params
        self.hidden = params["wh_f"].shape[0]
        self._tables: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    @classmethod
    def fresh(cls, alphabet: Alphabet, width: int, hidden: int, seed: int) -> Tagger:
        rng = np.random.default_rng(seed)

        def init(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        p = {"emb": (rng.standard_normal((alphabet.size, width)) * 0.3).astype(np.float32)}
        for d in "fb":
            p |= {f"wx_{d}": init(width, 4 * hidden), f"wh_{d}": init(hidden, 4 * hidden), f"b_{d}": np.zeros(4 * hidden, np.float32)}
            p[f"b_{d}"][hidden : 2 * hidden] = 1.0
        p |= {"wo": init(2 * hidden, K), "bo": np.zeros(K, np.float32), "trans": np.zeros((K, K), np.float32), "first": np.zeros(K, np.float32)}
        return cls(alphabet, p)

    def save(self, path: str) -> None:
        known = np.frombuffer(self.alphabet.known.encode("utf-8"), dtype=np.uint8)
        np.savez_compressed(path, known=known, **{k: v.astype(np.float16) for k, v in self.p.items()})

    @classmethod
    def load(cls, path: str) -> Tagger:
        with np.load(path) as z:
            known = bytes(z["known"]).decode("utf-8")
            return cls(Alphabet(known), {k: z[k].astype(np.float32) for k in z.files if k != "known"})

    # -- decoding --------------------------------------------------------------------------------------------------
    def __getstate__(self) -> dict:
        return {"alphabet": self.alphabet, "p": self.p}

    def __setstate__(self, state: dict) -> None:
        self.__init__(state["alphabet"], state["p"])

    def _run(self, ids: np.ndarray, d: str) -> np.ndarray:
        """Hidden states (time first). Gate inputs are looked up, for they depend on the character alone."""
        h4, hd = 4 * self.hidden, self.hidden
        if d not in self._tables:
            # the three sigmoid gates are halved, so that one tanh serves all four
            half = np.concatenate([np.full(3 * hd, 0.5, np.float32), np.ones(hd, np.float32)])
            self._tables[d] = ((self.p["emb"] @ self.p[f"wx_{d}"] + self.p[f"b_{d}"]) * half, self.p[f"wh_{d}"] * half)
        table, wh = self._tables[d]
        n, steps = ids.shape
        h, c = np.zeros((n, hd), np.float32), np.zeros((n, hd), np.float32)
        out = np.empty((steps, n, hd), np.float32)
        z = np.empty((n, h4), np.float32)
        for t in range(steps):
            np.matmul(h, wh, out=z)
            z += table[ids[:, t]]
            np.tanh(z, out=z)
            gates = z[:, : 3 * hd]
            gates *= 0.5
            gates += 0.5
            c *= gates[:, hd : 2 * hd]
            c += gates[:, :hd] * z[:, 3 * hd :]
            h = out[t]
            np.tanh(c, out=h)
            h *= gates[:, 2 * hd :]
        return out

    def emissions(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Label scores, time first."""
        hd = self.hidden
        fwd = self._run(ids, "f")
        bwd = self._run(reversed_rows(ids, lengths), "b")
        score = fwd @ self.p["wo"][:hd]
        back = (bwd @ self.p["wo"][hd:]).transpose(1, 0, 2)
        return score + reversed_rows(back, lengths).transpose(1, 0, 2) + self.p["bo"]

    def decode(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The best label sequence of each row (rows padded to one length)."""
        e = self.emissions(ids, lengths)
        steps, n, _ = e.shape
        trans = self.p["trans"] + allowed()
        start = self.p["first"] + np.where(np.arange(K) % 2 == 0, np.where(np.arange(K) > 0, FORBIDDEN, 0), 0)
        score = e[0] + start
        back = np.empty((steps, n, K), np.int8)
        same = np.arange(K, dtype=np.int8)
        for t in range(1, steps):
            full = score[:, :, None] + trans[None]
            best = full.argmax(axis=1)
            top = np.take_along_axis(full, best[:, None, :], axis=1)[:, 0] + e[t]
            live = (t < lengths)[:, None]
            back[t] = np.where(live, best, same)
            score = np.where(live, top, score)
        labels = np.empty((n, steps), np.int8)
        at = score.argmax(axis=1)
        for t in range(steps - 1, -1, -1):
            labels[:, t] = at
            if t:
                at = back[t][np.arange(n), at].astype(np.int64)
        return labels

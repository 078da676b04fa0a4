import random
import unicodedata

import numpy as np
import pytest

from dusklark.llm import leakage as K
from dusklark.llm.fmindex import FMIndex, WaveletMatrix, suffix_array


def test_suffix_array_of_repeats_and_noise():
    rng = np.random.default_rng(1)
    for t in (rng.integers(1, 5, 300), np.ones(200, int), np.tile(rng.integers(1, 9, 40), 6), np.array([1])):
        t = np.append(t, 0)
        assert suffix_array(t).tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())


def test_wavelet_matrix_ranks_and_access():
    v = np.random.default_rng(2).integers(0, 37, 500)
    w = WaveletMatrix(v, 6)
    s, at = np.arange(500) % 40, np.arange(500)
    assert w.rank(s, at).tolist() == [int((v[:a] == x).sum()) for x, a in zip(s, at)]
    sym, before = w.access_rank(at)
    assert sym.tolist() == v.tolist() and before.tolist() == [int((v[:a] == v[a]).sum()) for a in at]


def test_index_finds_every_occurrence():
    rng = random.Random(3)
    text = np.array([rng.randint(1, 4) for _ in range(400)])
    index = FMIndex(text, 6)
    patterns = np.zeros((60, 5), int)
    lengths = np.array([rng.randint(1, 5) for _ in range(60)])
    for i, n in enumerate(lengths):
        patterns[i, 5 - n :] = [rng.randint(1, 5) for _ in range(n)]
    lo, hi = index.intervals(patterns, lengths)
    for i, n in enumerate(lengths):
        p = patterns[i, 5 - n :].tolist()
        want = [a for a in range(len(text) - n + 1) if text[a : a + n].tolist() == p]
        assert sorted(index.locate(np.arange(lo[i], hi[i])).tolist()) == want


def test_words_are_normalised_and_placed():
    text = "Ｐrice​ TAG—Straße été ﬁve_2½ 한국한 x­yz"
    words = K.split_words(text)
    assert words[:2] == ["price", "tag"] and "strasse" in words and "xyz" in words and "five" in words
    for w, (a, z) in zip(words, K.word_places(text)):
        assert w in K.normal(text[a:z])
    assert K.split_words(None) == K.split_words(" ​") == []


@pytest.mark.parametrize("text", [
    "a\u200b\u0301b c", "ㄱㅏ나 ㅎㅏㄴ글 x\u200dy", "e\u0327\u0301 ¨x ﾊﾞﾊﾟ ｶ\uff9e", "\u0301start \ufeffﬁ\u00adn ½ 2\u2075", "\u200b", "นำ คำ \u0e4d\u0e32", "क़\u093c \u09c7\u09be",
])
def test_places_need_no_fallback(text):
    """Format characters between a letter and its accent, letters that are put together over the edges of what a reader sees as one."""
    filler = "word " * 100
    for t in (text, filler + text + " " + filler):
        words, places = K.split_words(t), K.word_places(t)
        assert len(words) == len(places)
        for w, (a, z) in zip(words, places):
            assert w in K.normal(t[a:z]) and z - a <= max(4, len(text))


def test_normal_pieces_are_the_normal_text():
    rng = random.Random(11)
    pool = [chr(c) for r in (range(0x20, 0x7F), range(0xA0, 0x370), range(0x1100, 0x1200), range(0x3130, 0x3190), range(0xAC00, 0xAC80), range(0x900, 0xA00), range(0xFF00, 0xFFEF), range(0x200B, 0x2010)) for c in r]
    for _ in range(400):
        t = "".join(rng.choice(pool) for _ in range(rng.randrange(1, 40)))
        words, places = K.split_words(t), K.word_places(t)
        assert len(words) == len(places) and all(w in K.normal(t[a:z]) for w, (a, z) in zip(words, places))


def brute(docs, items, n=12):
    out = set()
    for d, t in docs:
        w = K.split_words(t)
        for i, x in items:
            v = K.split_words(x)
            k = min(n, len(v))
            if k and any(w[a : a + k] == v[b : b + k] for a in range(len(w) - k + 1) for b in range(len(v) - k + 1)):
                out.add((d, i))
    return out


def pairs(spark, docs, items):
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, item_id int, word_start string")
    x = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    return K.leaked_spans(d, x)


@pytest.mark.parametrize("shard", [50, 1_000_000])
def test_leaks_match_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(K, "SHARD_WORDS", shard)
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(30)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([3, 11, 12, 13, 30])))) for i in range(25)] + [(90, ""), (91, None), (92, "W1 w2, W3"), (93, "w1 w2 w3")]
    docs = []
    for d in range(60):
        w = [rng.choice(vocab + ["other"]) for _ in range(rng.randrange(0, 200))]
        if rng.random() < 0.6:
            src = (rng.choice(items[:25])[1] or "").split()
            a = rng.randrange(max(1, len(src) - 11))
            w[len(w) // 2 : len(w) // 2] = src[a : a + rng.choice([11, 12, 14])]
        docs.append((d, rng.choice([" ", "  ", ", "]).join(w)))
    docs += [(100, None), (101, ""), (102, docs[1][1]), (2**53 + 1, "w1 w2 w3"), (103, "w1 " * 3000 + "w2 w3")]
    got = {(r["doc_id"], r["item_id"]) for r in pairs(spark, docs, items).collect()}
    assert got == brute(docs, items) and (2**53 + 1, 92) in got and (2**53 + 1, 93) in got


def test_spans_merge_and_name_the_place(spark):
    item = " ".join(f"a{i}" for i in range(20))
    text = "Intro. " + item.replace("a5", "Ａ5​") + " end. " + item
    spans = pairs(spark, [(1, text)], [(7, item), (8, " ".join(f"a{i}" for i in range(2, 16)))])
    got = sorted((r["item_id"], r["word_start"], r["word_end"], text[r["char_start"] : r["char_end"]]) for r in spans.collect())
    assert [g[:3] for g in got] == [(7, 1, 21), (7, 22, 42), (8, 3, 17), (8, 24, 38)]
    assert unicodedata.normalize("NFKC", got[0][3].replace("​", "")).lower() == item
    cut = K.removal_spans(spans).first()["spans"]
    assert [text[s["char_start"] : s["char_end"]] for s in cut] == [got[0][3], got[1][3]]


def test_empty_sides(spark):
    assert pairs(spark, [], [(1, "a b c")]).count() == 0
    assert pairs(spark, [(1, "a b c")], []).count() == 0


def test_items_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(K, "BLOCK_WORDS", 5)
    items = [(i, f"x{i} y{i} z{i}") for i in range(20)]
    docs = [(i, f"q x{i} y{i} z{i} r") for i in range(20)]
    assert {(r["doc_id"], r["item_id"]) for r in pairs(spark, docs, items).collect()} == {(i, i) for i in range(20)}


def test_removal_spans_of_the_smallest_tables_match_brute_force(spark):
    """Every run of twelve words of an item that stands in a document lies in its spans, and every end of a span is one of such a run."""
    from dusklark.llm import queries

    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = [K.split_words(r["text"]) for r in spark.read.parquet(f"{sf}/heldout_items.parquet").collect()]
    phrases = {tuple(v[a : a + 12]) for v in items for a in range(max(1, len(v) - 11)) if v}
    lengths = {len(p) for p in phrases}
    want = {}
    for d, text in docs.items():
        w = K.split_words(text)
        runs = sorted((a, a + n) for n in lengths for a in range(len(w) - n + 1) if tuple(w[a : a + n]) in phrases)
        places = K.word_places(text) if runs else []
        chars = []
        for a, z in runs:
            s, e = places[a][0], places[z - 1][1]
            if chars and s <= chars[-1][1]:
                chars[-1][1] = max(chars[-1][1], e)
            else:
                chars.append([s, e])
        if chars:
            want[d] = chars
    got = {r["doc_id"]: [[s["char_start"], s["char_end"]] for s in r["spans"]] for r in queries.p7_removal_spans(spark, sf).collect()}
    assert got.keys() == want.keys() and want
    # spans of one item merge by words, so runs that touch are one span; by characters they may be several
    for d in want:
        inside = lambda spans, x: any(a <= x[0] and x[1] <= z for a, z in spans)
        assert all(inside(got[d], x) for x in want[d])
        assert {a for a, _ in got[d]} <= {a for a, _ in want[d]} and {z for _, z in got[d]} <= {z for _, z in want[d]}

import numpy as np
import pytest

import pii_cases
from dusklark.llm import pii, pii_labels, pii_train
from dusklark.llm.pii_made import Maker
from dusklark.llm.tagger import LABELS, Alphabet, K, Tagger

KNOWN = {"zelda", "eschwald", "halvard", "plumb", "rufus"}


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    t = Tagger.fresh(Alphabet("abcdefghij "), 5, 4, 1)
    for k in t.p:
        t.p[k] = t.p[k].astype(np.float64) + (rng.standard_normal(t.p[k].shape) * 0.1 if k in ("trans", "first", "bo") else 0)
    ids, lengths = rng.integers(1, 12, (3, 7)), np.array([7, 5, 2])
    y = np.zeros((3, 7), int)
    y[0, 2:4], y[1, :2] = (1, 2), (9, 10)
    _, g = pii_train.gradients(t, ids, y, lengths)
    for k in t.p:
        for _ in range(4):
            ix = tuple(rng.integers(0, s) for s in t.p[k].shape)
            old, e = t.p[k][ix], 1e-3
            t.p[k][ix] = old + e
            a = pii_train.gradients(t, ids, y, lengths)[0]
            t.p[k][ix] = old - e
            b = pii_train.gradients(t, ids, y, lengths)[0]
            t.p[k][ix] = old
            assert abs((a - b) / (2 * e) - g[k][ix]) < 1e-4


def test_decoding_is_the_best_legal_path():
    rng = np.random.default_rng(3)
    t = Tagger.fresh(Alphabet("abc"), 4, 3, 2)
    t.p["trans"] = rng.standard_normal((K, K)).astype(np.float32)
    ids, lengths = rng.integers(1, 4, (5, 9)).astype(np.int32), np.array([9, 1, 4, 9, 7])
    labels = t.decode(ids, lengths)
    for row, n in zip(labels, lengths):
        for i in range(n):
            name = LABELS[row[i]]
            if name.startswith("I-"):
                assert i > 0 and LABELS[row[i - 1]][2:] == name[2:]
    # a row decodes alike alone and padded
    for r in range(5):
        assert t.decode(ids[r : r + 1, : lengths[r]], lengths[r : r + 1])[0].tolist() == labels[r, : lengths[r]].tolist()


def test_frames_label_slots():
    text = "Driver Zelda Eschwald showed card 666-41-8529 at the gate. Send the loss report to a.b＠post.example.org. She lives at 12b Weaver Rd.. Thanks, Halvard The shelf"
    got = [(text[a:z], k) for a, z, k in pii_labels.spans(text, KNOWN)]
    assert got == [("Zelda Eschwald", "name"), ("666-41-8529", "id_number"), ("a.b＠post.example.org", "email"), ("12b Weaver Rd.", "address"), ("Halvard", "name")]


@pytest.mark.parametrize("text,kind,want", [
    (" +1 202 555 0134 ext. 5", "phone", "+1 202 555 0134"), ("(010) 0123-4567,", "phone", "(010) 0123-4567"), ("12-34", "phone", None),
    ("no. 666-41-8529;", "id_number", "666-41-8529"), ("861026-*******", "id_number", None), ("<a@b.example>.", "email", "a@b.example"), ("nobody", "email", None),
    ("Mrs. Plumb's", "name", "Plumb"), ("Dr Zelda E.", "name", "Zelda E."), ("고객 황보이든 님", "name", "황보이든"), ("room 5", "name", None), ("fennel", "name", None),
    ("14 Weaver Rd.; ", "address", "14 Weaver Rd."), ("Weaver Row", "address", None), ("14 Weaver St.", "address", "14 Weaver St"),
])
def test_exact_check(text, kind, want):
    ends = pii.settled(text, 0, len(text), kind)
    assert (text[slice(*ends)] if ends else None) == want


def test_joint_spans_part():
    t = "12 Oak St to 14 Elm Row, Quenby"
    assert [t[a:z] for a, z in pii.parted(t, 0, len(t), "address")] == ["12 Oak St", "14 Elm Row, Quenby"]
    t = "Zelda Eschwald, Rufus Plumb"
    assert [t[a:z] for a, z in pii.parted(t, 0, len(t), "name")] == ["Zelda Eschwald", "Rufus Plumb"]
    assert pii.parted("Plumb, Rufus", 0, 12, "name") == [(0, 12)]


def test_windows_cover_and_reconcile():
    for n in (0, 1, 384, 385, 1000, 5000):
        w = pii.windows(n)
        assert [i for a, z in w for i in range(a, z)] == sorted(i for a, z in w for i in range(a, z)) or n > 384
        assert set(range(n)) == {i for a, z in w for i in range(a, z)}
    assert pii.reconciled([(5, 9, "name", 1), (4, 9, "name", 40), (20, 22, "phone", 3), (4, 9, "name", 40)]) == [(4, 9, "name"), (20, 22, "phone")]
    assert pii.reconciled([]) == []


TEXT = "Driver Zelda Eschwald showed card 666-41-8529 at the gate. Please ring 202-555-0134 before the next markdown. 고객 편이든 님이 buyer-33@frischlager.test로 환불 확인을 요청했습니다. The parcel went to 62 Juniper Street, Quenby 00417, not to the depot."
WANT = {("name", "Zelda Eschwald"), ("id_number", "666-41-8529"), ("phone", "202-555-0134"), ("name", "편이든"), ("email", "buyer-33@frischlager.test"), ("address", "62 Juniper Street, Quenby 00417")}


def test_mentions_and_redaction(spark):
    filler = "Markdown depth stayed under 25% and margin held. "
    rows = [(2**53 + 1, TEXT), (2, None), (3, ""), (4, filler * 3), (None, TEXT), (5, filler * 400 + TEXT + " " + filler * 400), (5, TEXT)]
    df = spark.createDataFrame([(i, t, "clash", 7) for i, t in rows], "doc_id long, text string, kind string, mention int")
    got = pii.find_mentions(df).collect()
    by = lambda i: {(r["kind"], r["mention"]) for r in got if r["doc_id"] == i}
    assert by(2**53 + 1) == by(None) == by(5) == WANT and not by(4) and not by(2) and not by(3)
    assert all(r["mention"] == dict(rows[:1] + rows[4:5])[r["doc_id"]][r["start"] : r["end"]] for r in got if r["doc_id"] in (2**53 + 1, None))
    out = {r["doc_id"]: r for r in pii.redact(df).collect()}
    assert out[2]["text"] is None and out[3]["text"] == "" and out[4]["text"] == filler * 3 and out[4]["n_mentions"] == 0
    assert out[2**53 + 1]["text"].startswith("Driver [NAME] showed card [ID_NUMBER] at the gate. Please ring [PHONE] before") and out[2**53 + 1]["n_mentions"] == 6
    assert pii.find_mentions(df.limit(0)).count() == 0


def scores(got, want):
    """Precision and recall by kind, and over all."""
    out = {}
    for kind in [*pii_labels.KINDS, None]:
        g, w = ({(n, m) for n, s in enumerate(x) for m in s if kind in (None, m[0])} for x in (got, want))
        out[kind] = (len(g & w) / max(1, len(g)), len(g & w) / max(1, len(w)))
    return out


def test_accuracy_on_frames():
    """Documents of the second smallest tables against the frames' labels."""
    import pyarrow.parquet as pq

    read = lambda sf: [t for t in pq.read_table(f"/root/testdata/{sf}/documents.parquet", columns=["text"])["text"].to_pylist() if t]
    texts, known = read("sf0.01"), pii_labels.known_parts(read("sf0.1")[:3000])
    got = [{(k, t[a:z]) for a, z, k in s} for t, s in zip(texts, pii.find_in(texts, Tagger.load(pii.MODEL)))]
    want = [{(s[2], t[slice(*(pii.settled(t, *s) or s[:2]))]) for s in pii_labels.spans(t, known)} for t in texts]
    assert all(min(x) > 0.97 for x in scores(got, want).values())


def test_accuracy_outside_the_frames():
    """Hand-labelled sentences; the bounds are below what was measured, which the README states."""
    for cases, least in ((pii_cases.CHOICE, 0.8), (pii_cases.REPORT, 0.75)):
        texts, want = zip(*map(pii_cases.labelled, cases))
        got = [{(k, t[a:z]) for a, z, k in s} for t, s in zip(texts, pii.find_in(list(texts), Tagger.load(pii.MODEL)))]
        found = scores(got, want)
        print(found)
        assert min(found[None]) >= least and min(min(x) for x in found.values()) >= 0.6


def test_made_up_spans_are_what_stands_there():
    maker = Maker(np.random.default_rng(5))
    seen = set()
    for _ in range(400):
        text, spans = maker.text()
        assert all(0 <= a < z <= len(text) and text[a:z].strip() == text[a:z] for a, z, _ in spans)
        assert all(z <= b for (_, z, _), (b, _, _) in zip(spans, spans[1:]))
        # the exact check rejects none of them
        assert all(pii.settled(text, a, z, k) for a, z, k in spans), (text, spans)
        seen |= {k for *_, k in spans}
    assert seen == set(pii_labels.KINDS)


def test_training_learns_from_labels(monkeypatch):
    monkeypatch.setattr(pii_train, "BATCH", 64)
    texts = [f"Driver {n} showed card 666-4{i % 10}-8529 at the gate. Markdown depth stayed under {i}%." for i in range(40) for n in ("Zelda Eschwald", "Rufus Plumb")]
    lines = []
    t = pii_train.train(texts * 2, steps=150, hidden=12, say=lines.append)
    losses = [float(x.split("loss ")[1].split(",")[0]) for x in lines if "loss" in x]
    assert losses[-1] < losses[0] / 2
    assert isinstance(t, Tagger)


def test_training_can_be_repeated(monkeypatch):
    monkeypatch.setattr(pii_train, "BATCH", 32)
    texts = ["Driver Zelda Eschwald showed card 666-41-8529 at the gate."] * 40
    runs = [pii_train.train(texts, steps=3, hidden=4, made=20, processes=p, say=lambda _: None).p for p in (0, 0)]
    assert all(np.array_equal(runs[0][k], r[k]) for r in runs[1:] for k in r)


def test_sample_is_drawn_by_hash(spark, tmp_path):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(50)] + [(60, None), (61, "")], "doc_id long, text string")
    df.repartition(3).write.parquet(str(tmp_path / "a"))
    df.coalesce(1).write.parquet(str(tmp_path / "b"))
    a, b = (pii_train.sample_texts(str(tmp_path / n), 7) for n in "ab")
    assert a == b and len(set(a)) == 7


def test_queries_register():
    from dusklark.llm import queries

    assert {"p3_percentiles", "p6_containers", "p7_found", "p8_found"} <= set(queries.QUERIES)

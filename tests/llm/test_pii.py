import re
from pathlib import Path

import numpy as np
import pytest

from histrail.llm import pii
from histrail.llm.pii_labels import TYPES, labelled_table


@pytest.fixture(scope="module")
def model():
    return pii.trained()


def test_weights_are_stored_for_this_module():
    assert pii.load() is not None


def test_held_out(model):
    """Other rows of the labelled table: the types of a text, as a record is judged."""
    table = list(labelled_table(1_000, seed=1234))
    found = pii.find_spans([t for t, _ in table], model)
    for kind in TYPES:
        got = [{k for _, _, k in f} for f in found]
        want = [{k for _, _, k in g} for _, g in table]
        hit = sum(kind in a and kind in b for a, b in zip(got, want, strict=True))
        assert hit / sum(kind in b for b in want) > 0.9, kind
        assert hit / sum(kind in a for a in got) > 0.9, kind


def independent() -> list[tuple[str, list[tuple[int, int, str]]]]:
    """Sentences written by hand, apart from the grammar; none of them was trained on. ``{n|...}`` marks a name, and so on."""
    out = []
    for line in (Path(__file__).parent / "pii_sentences.txt").read_text(encoding="utf-8").splitlines():
        text, marks, at = "", [], 0
        for m in re.finditer(r"\{([neipa])\|([^}]*)\}", line):
            text += line[at : m.start()]
            marks.append((len(text), len(text) + len(m.group(2)), m.group(1)))
            text += m.group(2)
            at = m.end()
        out.append((text + line[at:], marks))
    return out


def test_independent_sentences(model):
    """Recall and precision by type; a span counts if it overlaps one of its type."""
    rows = independent()
    assert len(rows) >= 300
    found = pii.find_spans([t for t, _ in rows], model)
    meets = lambda a, b: a[2] == b[2] and a[0] < b[1] and b[0] < a[1]
    for kind, recall, precision in (("n", 0.88, 0.85), ("e", 0.95, 0.95), ("p", 0.95, 0.95), ("i", 0.83, 0.95), ("a", 0.88, 0.95)):
        gold = [(g, f) for (_, marks), f in zip(rows, found, strict=True) for g in marks if g[2] == kind]
        put = [(s, marks) for (_, marks), f in zip(rows, found, strict=True) for s in f if s[2] == kind]
        assert sum(any(meets(g, s) for s in f) for g, f in gold) >= recall * len(gold), kind
        assert sum(any(meets(s, g) for g in marks) for s, marks in put) >= precision * len(put), kind


def test_long_runs_are_read_whole(model):
    """A run without blanks of any length: what stands at its end is found, and nothing of it is cut off."""
    long = "x" * 5_000
    text = f"{long} write to martha.ellison@postbox.example"
    assert pii.find_spans([text], model)[0][-1] == (len(long) + 10, len(text), "e")
    a, b = pii._chunk_shape("ab-1-" * 100), pii._chunk_shape("ab-1-" * 100 + "x")
    assert a != b and len(a) < 17


def test_viterbi_against_all_paths(model):
    texts = ["owner=Ilse Brandholt", "order 5", "a"]
    for t in texts:
        words, _ = pii.tokenize(t)
        c = pii.code([words])
        e = model.emissions(c, pii._neighbours(c))
        paths = [(model.start[i] + e[0, i], (i,)) for i in range(len(pii.LABELS))]
        for k in range(1, len(words)):
            paths = [max(((s + model.steps[p[-1], j] + e[k, j], (*p, j)) for s, p in paths), key=lambda x: x[0]) for j in range(len(pii.LABELS))]
        assert tuple(model.decode([words])[0]) == max(paths, key=lambda x: x[0])[1]


def test_batches_of_mixed_length_decode_alike(model):
    texts = [t for t, _ in labelled_table(60, seed=77)] + ["", " ", "x " * 3_000]
    alone = [pii.find_spans([t], model)[0] for t in texts]
    assert pii.find_spans(texts, model) == alone


def test_gradient():
    """The gradient of the likelihood moves the gold path up."""
    table = [("owner=Ilse Brandholt", [(6, 20, "n")]), ("lane 5", [])] * 30
    m = pii.train(table, epochs=4)
    assert pii.find_spans(["owner=Ilse Brandholt"], m) == [[(6, 20, "n")]] and pii.find_spans(["lane 5"], m) == [[]]


def test_save_and_load(tmp_path):
    m = pii.train(list(labelled_table(200)), epochs=1)
    pii.save(m, tmp_path / "w.npz")
    again = pii.load(tmp_path / "w.npz")
    for a, b in zip(m.parts(), again.parts(), strict=True):
        assert np.abs(a - b).max() <= np.abs(a).max() / 127
    assert pii.load(tmp_path / "none.npz") is None


def test_redact(spark, model):
    rows = [("a", "please call Ms Marta Ellison on (212) 555-0183 today"), ("b", None), ("c", ""), ("d", "order PO-48213 shipped on 2024-11-02"), ("e", "sent to martha.ellison+tax@postbox.example"), ("e", "sent to martha.ellison+tax@postbox.example"), ("f", "\x00\n\t"), ("g", "the batch finished without errors; " * 2_000)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "record_id string, text string, redacted string")
    got = pii.redact(df, "record_id", "text", model).collect()
    assert len(got) == len(rows)
    by = {g.record_id: g for g in got}
    assert by["a"].redacted == "please call [PERSON_NAME] on [PHONE] today" and by["a"].pii_types == ["person_name", "phone"]
    assert by["e"].redacted == "sent to [EMAIL]"
    assert by["b"].redacted is None and by["c"].redacted == "" and by["b"].pii_types == [] == by["d"].pii_types == by["g"].pii_types
    assert by["g"].redacted == rows[-1][1] and by["f"].redacted == rows[6][1]
    assert pii.redact(df.limit(0), "record_id", "text", model).count() == 0


def test_escapes_keep_their_place(model):
    text = '{"fullName": "\\u0141ucja Ellison", "amount": 5}'
    (span,) = pii.find_spans([text], model)[0]
    assert text[span[0] : span[1]] == "\\u0141ucja Ellison"


def test_labels_mark_their_text():
    for text, marks in labelled_table(300, seed=3):
        assert all(text[a:b] and text[a:b] == text[a:b].strip() for a, b, _ in marks)
        words, spans = pii.tokenize(text)
        gold = pii._gold(spans, marks)
        assert sum(pii.LABELS[g][0] == "B" for g in gold) == len(marks) and len(words) == len(gold)
    assert np.isfinite(pii.Model.empty().words).all()

import random

import numpy as np

from histrail.llm import tokens as K

TEXTS = ["", None, " ", "plain", "naïve façade – 行処理 🚨✅", "<|endoftext|> stays text", "a\tb\r\n\n  c", "é" * 3000, "👩‍👩‍👧‍👦" * 50, "x" * 40_000, "�"]


def frame(spark):
    return spark.createDataFrame([(i, t, "clash") for i, t in enumerate(TEXTS)], "doc_id long, text string, ids string")


def test_round_trip(spark):
    path = K.tokenizer_path()
    ids = K.encode(frame(spark), "doc_id", "text", path)
    assert ids.columns == ["doc_id", "ids"] and ids.count() == len(TEXTS)
    got = {r.doc_id: r.ids for r in ids.collect()}
    assert got[0] == got[1] == [] and max(max(x, default=0) for x in got.values()) < 50_256
    back = {r.doc_id: r.text for r in K.decode(ids, "doc_id", "ids", path).collect()}
    assert back == {i: t or "" for i, t in enumerate(TEXTS)}


def test_same_as_another_library(spark):
    import base64

    import public_tokenizers as P
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    other = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in K.encode(frame(spark), "doc_id", "text", K.tokenizer_path()).collect():
        assert r.ids == other.encode_ordinary(TEXTS[r.doc_id] or "")


def test_offsets_and_counts(spark):
    path = K.tokenizer_path()
    rows = {r.doc_id: r for r in K.encode_with_offsets(frame(spark), "doc_id", "text", path).collect()}
    counts = {r.doc_id: r.n_tokens for r in K.count_tokens(frame(spark), "doc_id", "text", path).collect()}
    vocabulary = K._token_bytes(path)
    for i, t in enumerate(TEXTS):
        r = rows[i]
        assert counts[i] == len(r.ids) == len(r.starts) == len(r.ends)
        if t and t.isascii():
            assert "".join(t[a:b] for a, b in zip(r.starts, r.ends, strict=True)) == t
        assert all(0 <= a <= b <= len(t or "") for a, b in zip(r.starts, r.ends, strict=True))
        # tokens that split a character cover it; the bytes of all tokens are those of the text
        assert b"".join(vocabulary[x] for x in r.ids) == (t or "").encode()
    assert K.decode_ids(rows[8].ids[:1], vocabulary)  # cut within a character: no crash


def test_words_give_the_ids_of_whole_texts(monkeypatch):
    """Encoding word by word is exact, whatever white space and signs there are, and with a memory that overflows."""
    encoder = K.Encoder(K.tokenizer_path())
    assert encoder.by_word
    r = random.Random(1)
    signs = ["a", "B", "é", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "\u2003", "\u200b", "'s", "'", "!", "9", "中", "🚨", "\u3000", "\ufeff", "\r\n", "_", "ß", "'LL", "\x00", "<|endoftext|>"]
    texts = ["".join(r.choices(signs, k=r.randrange(0, 40))) for _ in range(5_000)] + [t or "" for t in TEXTS]
    whole = encoder._whole(texts)
    monkeypatch.setattr(K, "MOST_WORDS", 3_000)
    assert [x for i in range(0, len(texts), 500) for x in encoder.encode(texts[i : i + 500])] == whole
    assert all(np.frombuffer(x, dtype=np.int32).tolist() == encoder.tok.encode(t, add_special_tokens=False).ids for t, x in zip(texts[:300], whole, strict=False))
    assert len(encoder.known) <= 3_000 + 10_000


def test_byte_table():
    t = K.byte_table()
    assert len(t) == 256 and sorted(t.values()) == list(range(256)) and t["Ġ"] == 32 and t["A"] == 65


def test_empty_table(spark):
    none = frame(spark).limit(0)
    assert K.encode(none, "doc_id", "text", K.tokenizer_path()).count() == 0

"""Encoding a corpus with a public tokenizer, offsets into the text, and decoding."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..session import spread

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """The file of a public tokenizer; every executor has it under the same path."""
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task on every core already
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True  # their strings in a text are ordinary text
    t.no_truncation()
    t.no_padding()
    return t


def _batches(texts: list[str | None], most_chars: int = 2_000_000) -> Iterator[list[str]]:
    """Texts in groups of bounded length, so that very long ones don't pile up in memory. Null is the empty text."""
    group, size = [], 0
    for t in texts:
        t = t or ""
        if group and size + len(t) > most_chars:
            yield group
            group, size = [], 0
        group.append(t)
        size += len(t)
    if group:
        yield group


def _slices(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """The groups of :func:`_batches` with the place of each."""
    at = 0
    for group in _batches(texts):
        yield at, group
        at += len(group)


def _key(df: DataFrame, key: str) -> str:
    return f"`{key}` {df.schema[key].dataType.simpleString()}"


def _lists(values: list[list[int]], kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(values) + 1, dtype=np.int32)
    np.cumsum([len(v) for v in values], out=offsets[1:])
    flat = np.fromiter((x for v in values for x in v), dtype=np.int64, count=int(offsets[-1]))
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat).cast(kind))


#: White space as the vocabulary's own splitting has it (the Unicode property).
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_WORD = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
#: Words that a worker remembers, and the length up to which it does.
MOST_WORDS, LONGEST_WORD = 300_000, 64


class Encoder:
    """Encodes texts word by word, a word with the white space before it, and each different word once.

    In a byte-level vocabulary no token reaches from a word into the white space behind it, and how white space is split
    depends on nothing before it. So the ids of a text are those of its words, one after another. A tokenizer that splits
    in another way (:func:`splits_at_spaces`) encodes whole texts.
    """

    def __init__(self, path: str):
        self.tok = _tokenizer(path)
        self.by_word = splits_at_spaces(self.tok)
        self.known: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype=np.int32).tobytes() for group in _batches(texts) for e in self.tok.encode_batch_fast(group, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as 32-bit integers, one after another."""
        if not self.by_word:
            return self._whole(texts)
        words = [_WORD.findall(t) for t in texts]
        known = self.known
        new = list(set().union(*words).difference(known))
        if len(known) + len(new) > MOST_WORDS:
            known.clear()
            new = list(set().union(*words))
        known.update(zip(new, self._whole(new), strict=True))
        out = [b"".join(map(known.__getitem__, ws)) for ws in words]
        for w in new:  # rare long words are not worth their place
            if len(w) > LONGEST_WORD:
                del known[w]
        return out


def splits_at_spaces(tok) -> bool:
    """Whether a tokenizer is of the byte-level kind without a normalizer, so that words can be encoded one by one."""
    spec = json.loads(tok.to_str())
    split = spec.get("pre_tokenizer") or {}
    added = [t for t in spec.get("added_tokens", []) if not t.get("special")]
    return spec["model"]["type"] == "BPE" and not spec.get("normalizer") and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space") and not added


@lru_cache(maxsize=4)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def encode(df: DataFrame, key: str, text: str, tokenizer: str) -> DataFrame:
    """``key, ids``: the token ids of every row's text, without special tokens. Null and empty texts give an empty list.

    Texts are encoded whole and rows stay in their partition; repeated keys stay repeated. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        for batch in batches:
            for at, texts in _slices(batch.column(1).to_pylist()):
                ids = encoder.encode(texts)
                offsets = np.cumsum([0, *map(len, ids)]) // 4
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(np.frombuffer(b"".join(ids), dtype=np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), lists], names=[key, "ids"])

    return spread(df.select(key, text)).mapInArrow(run, f"{_key(df, key)}, ids array<int>")


def encode_with_offsets(df: DataFrame, key: str, text: str, tokenizer: str) -> DataFrame:
    """``key, ids, starts, ends``: ids and the characters each token covers. Tokens that share a character whose bytes they
    split all cover that character. Empty lists for null and empty texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(tokenizer)
        for batch in batches:
            done = [e for group in _batches(batch.column(1).to_pylist()) for e in tok.encode_batch(group, add_special_tokens=False)]
            spans = [e.offsets for e in done]
            arrays = [_lists([e.ids for e in done], pa.int32()), _lists([[a for a, _ in s] for s in spans], pa.int32()), _lists([[b for _, b in s] for s in spans], pa.int32())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=[key, "ids", "starts", "ends"])

    return spread(df.select(key, text)).mapInArrow(run, f"{_key(df, key)}, ids array<int>, starts array<int>, ends array<int>")


def count_tokens(df: DataFrame, key: str, text: str, tokenizer: str) -> DataFrame:
    """``key, n_tokens``; 0 for null and empty texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        for batch in batches:
            n = [len(ids) // 4 for _, texts in _slices(batch.column(1).to_pylist()) for ids in encoder.encode(texts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], names=[key, "n_tokens"])

    return spread(df.select(key, text)).mapInArrow(run, f"{_key(df, key)}, n_tokens long")


def byte_table() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1 characters stand for themselves,
    the other bytes, in order, for the characters from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    shown = {chr(b): b for b in plain}
    shown.update({chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))})
    return shown


@lru_cache(maxsize=4)
def _token_bytes(path: str) -> tuple[bytes, ...]:
    tok, table = _tokenizer(path), byte_table()
    out = []
    for i in range(tok.get_vocab_size(with_added_tokens=True)):
        piece = tok.id_to_token(i) or ""
        out.append(bytes(table[c] for c in piece) if all(c in table for c in piece) else piece.encode())
    return tuple(out)


def decode_ids(ids: list[int] | None, vocabulary: tuple[bytes, ...]) -> str:
    """The text of a list of ids: their bytes are joined first, so that characters split over tokens are whole again."""
    return b"".join(vocabulary[i] for i in ids or ()).decode("utf-8", "replace")


def decode(df: DataFrame, key: str, ids: str, tokenizer: str) -> DataFrame:
    """``key, text`` from lists of ids; an empty or null list gives the empty text. A list cut within a character gives U+FFFD there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _token_bytes(tokenizer)
        for batch in batches:
            texts = [decode_ids(x, vocabulary) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[key, "text"])

    return spread(df.select(key, ids)).mapInArrow(run, f"{_key(df, key)}, text string")

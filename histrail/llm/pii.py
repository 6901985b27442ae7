"""Personal information in free text: a linear-chain conditional random field over word shapes."""

from __future__ import annotations

import inspect
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256
from pathlib import Path
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..session import spread
from . import pii_labels
from .pii_labels import TYPES, labelled_table

#: Rows of the labelled table that the model is trained on, and passes over it.
TRAINING_ROWS = 20_000
EPOCHS = 3
#: The share of words whose identity is hidden in training.
HIDDEN = 0.3
#: A word is left alone only if that is likelier by so much (natural logarithm): what is missed stays in the text.
CAUTION = 1.0
#: Features of words are hashed to so many rows of weights, those of neighbouring pairs likewise.
WORD_ROWS, PAIR_ROWS = 1 << 14, 1 << 15
#: A word's features are seen by the words up to so many places away.
REACH = 3

LABELS = ["O", *(f"{b}{t}" for t in TYPES for b in "BI")]
PLACEHOLDERS = {t: f"[{name.upper()}]" for t, name in TYPES.items()}
_TOKEN = re.compile(r"\d+|[^\W\d_]+(?:['’][^\W\d_]+)*|[^\w\s]|_")
_OFFSETS = range(-REACH, REACH + 1)


_ESCAPE = re.compile(r"\\u([0-9a-fA-F]{4})")
_CHUNK = re.compile(r"\S+")
_LETTERS = re.compile(r"[^\W\d_]+")


def _chunk_shape(chunk: str) -> str:
    """The shape of a run without blanks: the length of each number, one sign for each word, the other signs as they are."""
    out = re.sub(r"\d+", lambda m: str(min(len(m.group()), 9)), chunk.strip(".,;:()<>\"'{}"))
    shape = _LETTERS.sub(lambda m: "A" if m.group()[0].isupper() else "a", out).replace("\0", "")
    return shape if len(shape) <= 16 else f"#{crc32(shape.encode('utf-8', 'surrogatepass')):x}"  # it is hashed in any case


def tokenize(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """Words, numbers and single signs, and where they stand. Before the word comes how it stands to the one before: ``~``
    glued to it, ``^`` on a new line (or first), a blank otherwise; after it, behind a NUL, the shape of the run without
    blanks that it is part of. Letters written as JSON escapes count as the letters."""
    original = text
    places = None
    if "\\u" in text:
        parts, places, at = [], [], 0
        for m in _ESCAPE.finditer(text):
            parts += [text[at : m.start()], chr(int(m.group(1), 16))]
            places += [*range(at, m.start()), m.start()]
            at = m.end()
        places += range(at, len(text) + 1)
        text = "".join([*parts, text[at:]])
    words, spans, last = [], [], -1
    for run in _CHUNK.finditer(text):
        shape = _chunk_shape(run.group())
        for m in _TOKEN.finditer(text, run.start(), run.end()):
            a, b = m.span()
            gap = "~" if a == last else "^" if last < 0 or "\n" in text[last:a] else " "
            words.append(f"{gap}{m.group()}\0{shape}")
            spans.append((a, b))
            last = b
    if places is not None:
        # the end of a token is where the last of its letters ends in the text as it was
        spans = [(places[a], places[b] if b < len(places) else len(original)) for a, b in spans]
    return words, spans


def _shape(word: str) -> str:
    if word.isdigit():
        return f"d{min(len(word), 12)}"
    if len(word) == 1 and not word.isalpha():
        return word
    if word.isupper():
        return "X" if len(word) == 1 else "XX" if len(word) < 4 else "XXX"
    return ("Xx" if word[0].isupper() else "x") + ("'" if "'" in word or "’" in word else "")


def _row(feature: str, rows: int) -> int:
    return crc32(feature.encode("utf-8", "surrogatepass")) % rows


@lru_cache(maxsize=200_000)
def word_features(marked: str) -> tuple[tuple[int, ...], int, int]:
    """The rows of a word's features, and hashes of its shape and of the word for the pair features."""
    word, _, run = marked.rpartition("\0")
    gap, word = word[0], word[1:]
    shape, low = _shape(word), word.lower()
    known = shape if word.isdigit() else low
    features = [f"w{known}", f"s{shape}", f"g{gap}", f"gs{gap}{shape}", f"r{run}", f"rs{run}{shape}"]
    if word.isdigit():
        features += [f"d1{word[0]}{min(len(word), 12)}", f"d2{word[:2]}"]
    elif word.isalpha() or len(word) > 1:
        features += [f"p2{low[:2]}", f"p3{low[:3]}", f"u2{low[-2:]}", f"u3{low[-3:]}", f"u4{low[-4:]}", f"n{min(len(word), 9)}", f"a{int(word.isascii())}{shape}"]
    return tuple(_row(f, WORD_ROWS) for f in features), crc32(f"s{gap}{shape}".encode()), crc32(f"w{known}".encode("utf-8", "surrogatepass"))


@dataclass
class Coded:
    """Token sequences as numbers: the different words of a batch, and for each token its word and its pair features."""

    lengths: np.ndarray
    word: np.ndarray
    rows: np.ndarray  # of all different words, one after another
    owner: np.ndarray  # the word that each row belongs to
    n_words: int
    pairs: np.ndarray  # tokens x 4


def code(sequences: Sequence[Sequence[str]]) -> Coded:
    index: dict[str, int] = {}
    word = np.array([index.setdefault(w, len(index)) for s in sequences for w in s], dtype=np.int64)
    feats = [word_features(w) for w in index]
    rows = np.array([r for f in feats for r in f[0]], dtype=np.int64)
    owner = np.repeat(np.arange(len(feats)), [len(f[0]) for f in feats])
    lengths = np.array([len(s) for s in sequences], dtype=np.int64)
    shape, name = (np.array([f[k] for f in feats], dtype=np.uint64)[word] if len(word) else np.zeros(0, np.uint64) for k in (1, 2))
    starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    first, last = np.zeros(len(word), bool), np.zeros(len(word), bool)
    if len(word):
        first[starts[lengths > 0]] = True
        last[(starts + lengths - 1)[lengths > 0]] = True
    back = lambda x: np.where(first, 1, np.roll(x, 1))
    ahead = lambda x: np.where(last, 2, np.roll(x, -1))
    mixed = [back(shape) * 31 + shape * 7, ahead(shape) * 37 + shape * 11, back(name) * 41 + shape * 13, ahead(name) * 43 + shape * 17]
    pairs = np.stack([((m * np.uint64(2654435761) + np.uint64(k)) >> np.uint64(7)) % np.uint64(PAIR_ROWS) for k, m in enumerate(mixed)], axis=1).astype(np.int64) if len(word) else np.zeros((0, 4), np.int64)
    return Coded(lengths, word, rows, owner, len(feats), pairs)


def _neighbours(c: Coded) -> np.ndarray:
    """For each token and offset the word at that offset in its sequence; ``n_words`` beyond the ends."""
    n = len(c.word)
    seq = np.repeat(np.arange(len(c.lengths)), c.lengths)
    out = np.full((len(_OFFSETS), n), c.n_words, dtype=np.int64)
    for k, o in enumerate(_OFFSETS):
        if o <= 0:
            m = n + o
            if m > 0:
                out[k, -o:] = np.where(seq[-o:] == seq[:m], c.word[:m], c.n_words)
        elif n > o:
            out[k, : n - o] = np.where(seq[: n - o] == seq[o:], c.word[o:], c.n_words)
    return out


class Model:
    """Weights: words by offset, pairs, transitions, first and last labels."""

    def __init__(self, words: np.ndarray, pairs: np.ndarray, steps: np.ndarray, start: np.ndarray):
        self.words, self.pairs, self.steps, self.start = words, pairs, steps, start

    @classmethod
    def empty(cls) -> Model:
        n = len(LABELS)
        return cls(np.zeros((len(_OFFSETS), WORD_ROWS, n), np.float32), np.zeros((4, PAIR_ROWS, n), np.float32), np.zeros((n, n), np.float32), np.zeros(n, np.float32))

    def parts(self) -> tuple[np.ndarray, ...]:
        return self.words, self.pairs, self.steps, self.start

    def emissions(self, c: Coded, around: np.ndarray) -> np.ndarray:
        out = np.zeros((len(c.word), len(LABELS)), np.float32)
        cuts = np.searchsorted(c.owner, np.arange(c.n_words))
        for k in range(len(_OFFSETS)):
            table = np.zeros((c.n_words + 1, len(LABELS)), np.float32)
            if c.n_words:
                table[:-1] = np.add.reduceat(self.words[k][c.rows], cuts, axis=0)
            out += table[around[k]]
        for k in range(4):
            out += self.pairs[k][c.pairs[:, k]]
        return out

    def decode(self, sequences: Sequence[Sequence[str]]) -> list[np.ndarray]:
        """The best labels of every sequence, by Viterbi over batches of sequences of similar length."""
        c = code(sequences)
        e = self.emissions(c, _neighbours(c))
        e[:, 0] -= CAUTION
        starts = np.concatenate([[0], np.cumsum(c.lengths)]).astype(np.int64)
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(sequences)
        order = np.argsort(c.lengths, kind="stable")
        order = order[c.lengths[order] > 0]
        at = 0
        while at < len(order):
            # padded to the longest of the batch; a very long sequence is alone in its batch
            size = 1
            while at + size < len(order) and size < 1024 and c.lengths[order[at + size]] * (size + 1) <= 60_000 and c.lengths[order[at + size]] <= c.lengths[order[at]] * 1.3 + 4:
                size += 1
            some = order[at : at + size]
            at += size
            lengths = c.lengths[some]
            t = int(lengths[-1])
            grid = np.zeros((t, size, e.shape[1]), np.float32)
            for j, s in enumerate(some):
                grid[: lengths[j], j] = e[starts[s] : starts[s + 1]]
            best = grid[0] + self.start
            came = np.zeros((t, size, e.shape[1]), np.int8)
            for i in range(1, t):
                reach = best[:, :, None] + self.steps[None]
                came[i] = reach.argmax(1)
                new = reach.max(1) + grid[i]
                best = np.where((lengths > i)[:, None], new, best)
            label = best.argmax(1)
            labels = np.zeros((t, size), np.int64)
            labels[lengths - 1, np.arange(size)] = label
            for i in range(t - 1, 0, -1):
                inside = lengths > i
                label = np.where(inside, came[i][np.arange(size), label], label)
                labels[i - 1] = np.where(inside, label, labels[i - 1])
            for j, s in enumerate(some):
                out[s] = labels[: lengths[j], j]
        return out


def _gold(spans: list[tuple[int, int]], marks: list[tuple[int, int, str]]) -> list[int]:
    labels = []
    for a, b in spans:
        hit = next(((lo, t) for lo, hi, t in marks if a >= lo and b <= hi), None)
        if hit is None:
            labels.append(0)
        else:
            begins = not any(lo2 <= x < a for x, _ in spans for lo2 in (hit[0],) if x >= hit[0])
            labels.append(LABELS.index(("B" if begins else "I") + hit[1]))
    return labels


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def _sums(where: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
    """The rows of ``values`` added up by ``where``."""
    n = values.shape[1]
    at = (where[:, None] * n + np.arange(n)).ravel()
    return np.bincount(at, weights=values.ravel(), minlength=rows * n).astype(np.float32).reshape(rows, n)


def train(table: Sequence[tuple[str, list[tuple[int, int, str]]]], epochs: int = EPOCHS, seed: int = 5, batch: int = 48, rate: float = 0.25) -> Model:
    """Maximum likelihood by AdaGrad over mini-batches; the gradient comes from the forward-backward marginals."""
    model, n = Model.empty(), len(LABELS)
    seen = [np.full(p.shape, 1e-6, np.float32) for p in model.parts()]
    rng = np.random.default_rng(seed)
    data = []
    for text, marks in table:
        words, spans = tokenize(text)
        if words:
            data.append((words, _gold(spans, marks)))
    data.sort(key=lambda d: len(d[0]))
    groups = [data[i : i + batch] for i in range(0, len(data), batch)]

    def move(k: int, where, gradient: np.ndarray) -> None:
        seen[k][where] += gradient**2
        model.parts()[k][where] -= rate * gradient / np.sqrt(seen[k][where])

    for _ in range(epochs):
        for g in rng.permutation(len(groups)):
            some = groups[g]
            c = code([w for w, _ in some])
            # a word's identity, its first feature, is hidden at times, so that unheard words are met in training too
            first = np.diff(c.owner, prepend=-1) > 0
            seen_now = ~(first & (rng.random(c.n_words) < HIDDEN)[c.owner])
            c.rows, c.owner = c.rows[seen_now], c.owner[seen_now]
            around = _neighbours(c)
            e = model.emissions(c, around)
            b, t = len(some), int(c.lengths.max())
            starts = np.concatenate([[0], np.cumsum(c.lengths)])
            grid = np.zeros((t, b, n), np.float32)
            mask = np.arange(t)[:, None] < c.lengths[None]
            flat_t = np.concatenate([np.arange(x) for x in c.lengths])
            flat_b = np.repeat(np.arange(b), c.lengths)
            grid[flat_t, flat_b] = e
            forward = np.zeros((t, b, n), np.float32)
            forward[0] = grid[0] + model.start
            for i in range(1, t):
                new = _log_sum(forward[i - 1][:, :, None] + model.steps[None], 1) + grid[i]
                forward[i] = np.where(mask[i][:, None], new, forward[i - 1])
            total = _log_sum(forward[-1], 1)
            backward = np.zeros((t, b, n), np.float32)
            step_gradient = np.zeros((n, n), np.float32)
            for i in range(t - 2, -1, -1):
                into = grid[i + 1] + backward[i + 1]
                backward[i] = np.where(mask[i + 1][:, None], _log_sum(model.steps[None] + into[:, None, :], 2), 0)
                joint = np.exp(forward[i][:, :, None] + model.steps[None] + into[:, None, :] - total[:, None, None])
                step_gradient += (joint * mask[i + 1][:, None, None]).sum(0)
            marginal = np.exp(forward + backward - total[None, :, None])[flat_t, flat_b]
            gold = np.concatenate([y for _, y in some])
            marginal[np.arange(len(gold)), gold] -= 1
            inner = flat_t[1:] > 0
            np.add.at(step_gradient, (gold[:-1][inner], gold[1:][inner]), -1)
            move(2, slice(None), step_gradient)
            move(3, slice(None), marginal[starts[:-1]].sum(0))
            rows, inverse = np.unique(c.rows, return_inverse=True)
            for k in range(len(_OFFSETS)):
                gradient = _sums(inverse, _sums(around[k], marginal, c.n_words + 1)[c.owner], len(rows))
                seen[0][k][rows] += gradient**2
                model.words[k][rows] -= rate * gradient / np.sqrt(seen[0][k][rows])
            for k in range(4):
                rows, inverse = np.unique(c.pairs[:, k], return_inverse=True)
                gradient = _sums(inverse, marginal, len(rows))
                seen[1][k][rows] += gradient**2
                model.pairs[k][rows] -= rate * gradient / np.sqrt(seen[1][k][rows])
    return model


#: Weights trained by this module (``python -m histrail.llm.pii``), so that no program needs to train them.
WEIGHTS = Path(__file__).with_name("pii_weights.npz")


def _made_from() -> str:
    """Tells apart the weights of different grammars, features and ways to train."""
    parts = [pii_labels, _chunk_shape, tokenize, _shape, _row, word_features, code, _neighbours, Model.emissions, _gold, train]
    settings = (TRAINING_ROWS, EPOCHS, HIDDEN, WORD_ROWS, PAIR_ROWS, REACH)
    return sha256("".join([*map(inspect.getsource, parts), repr(settings)]).encode()).hexdigest()


def save(model: Model, path: Path = WEIGHTS) -> None:
    """Rows of weights that aren't all zero, in steps of a 127th of a table's greatest."""
    out = {"made_from": np.array(_made_from())}
    for k, table in enumerate(model.parts()):
        flat = table.reshape(-1, table.shape[-1])
        used = np.flatnonzero(np.abs(flat).max(1) > 0)
        step = float(np.abs(flat).max()) / 127 or 1.0
        out |= {f"used{k}": used.astype(np.int32), f"step{k}": np.array(step, np.float32), f"values{k}": np.rint(flat[used] / step).astype(np.int8)}
    np.savez_compressed(path, **out)


def load(path: Path = WEIGHTS) -> Model | None:
    """The stored weights; None if there are none, or if they were made from something else than this module."""
    if not path.is_file():
        return None
    with np.load(path) as f:
        if str(f["made_from"]) != _made_from():
            return None
        model = Model.empty()
        for k, table in enumerate(model.parts()):
            table.reshape(-1, table.shape[-1])[f[f"used{k}"]] = f[f"values{k}"].astype(np.float32) * f[f"step{k}"]
    return model


@lru_cache(maxsize=2)
def trained(rows: int = TRAINING_ROWS, epochs: int = EPOCHS, seed: int = 7) -> Model:
    """The stored model, or one trained now (a minute) where other settings are asked for or none is stored for these."""
    stored = load() if (rows, epochs, seed) == (TRAINING_ROWS, EPOCHS, 7) else None
    return stored or train(list(labelled_table(rows, seed)), epochs)


_AT = re.compile(r"@|\(at\)|\[at\]", re.I)


def _holds(kind: str, whole: str, a: int, b: int) -> bool:
    """An exact check of a decoded span: what every case of its type has."""
    text = whole[a:b]
    if kind in "ip" and (whole[a - 1 : a].isalnum() or whole[a - 1 : a] in ("-", "_") or whole[b : b + 1].isalnum() or whole[b : b + 1] == "-") and a:
        return False  # part of a longer reference
    text = _ESCAPE.sub(lambda m: chr(int(m.group(1), 16)), text)
    digits = sum(c.isdigit() for c in text)
    letters = sum(c.isalpha() for c in text)
    if kind == "e":
        return bool(_AT.search(text)) and letters >= 4 and bool(re.search(r"\.|dot", text.lower().rpartition("at")[2] if "@" not in text else text.rpartition("@")[2]))
    if kind == "p":
        return 7 <= digits <= 16 and letters <= 4
    if kind == "i":  # the shortest is two letters, six digits and a letter
        return digits >= 6 and digits + letters >= 9
    if kind == "a":
        return digits >= 1 and letters >= 3
    return letters >= 2 and digits == 0


def find_spans(texts: Sequence[str], model: Model) -> list[list[tuple[int, int, str]]]:
    """``(start, end, type letter)`` of every piece of personal information, in order."""
    tokens = [tokenize(t) for t in texts]
    out = []
    for text, (_, spans), labels in zip(texts, tokens, model.decode([w for w, _ in tokens]), strict=True):
        found: list[tuple[int, int, str]] = []
        kind = ""
        for (a, b), label in zip(spans, labels.tolist(), strict=True):
            name = LABELS[label]
            if name == "O":
                kind = ""
            elif name[0] == "B" or name[1] != kind:
                kind = name[1]
                found.append((a, b, kind))
            else:
                found[-1] = (found[-1][0], b, kind)
        out.append(_whole_mails(text, [s for s in found if _holds(s[2], text, s[0], s[1])]))
    return out


_MAIL_END, _MAIL_START = re.compile(r"[\w+-]+(?:\.[\w+-]+)*"), re.compile(r"[\w.+-]+$")


def _whole_mails(text: str, spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """A mail address reaches as far as its characters do; what else was found inside it is part of it."""
    if not any(k == "e" for _, _, k in spans):
        return spans
    out: list[tuple[int, int, str]] = []
    for a, b, kind in spans:
        if out and a < out[-1][1]:
            continue
        if kind == "e":
            before = _MAIL_START.search(text, 0, a) if a and (text[a].isalnum() or text[a] in "._+-@") else None
            a = before.start() if before else a
            after = _MAIL_END.match(text, b) if text[b - 1].isalnum() and "@" in text[a:b] else None
            b = after.end() if after else b
            while out and out[-1][1] > a:
                out.pop()
        out.append((a, b, kind))
    return out


def replace(text: str, spans: Sequence[tuple[int, int, str]]) -> str:
    out, at = [], 0
    for a, b, kind in spans:
        out += [text[at:a], PLACEHOLDERS[kind]]
        at = b
    return "".join([*out, text[at:]])


def _groups(texts: Iterable[str], most_chars: int = 400_000) -> Iterator[list[str]]:
    """Texts that are labelled together: of bounded length in all, so that long ones don't pile up in memory."""
    group, size = [], 0
    for t in texts:
        if group and size + len(t) > most_chars:
            yield group
            group, size = [], 0
        group.append(t)
        size += len(t)
    if group:
        yield group


def redact(df: DataFrame, key: str, text: str, model: Model | None = None) -> DataFrame:
    """``key, pii_types, redacted``: the types found in each row's text (sorted, without repeats) and the text with typed
    placeholders in their place, otherwise unchanged.

    Tokens are labelled by the conditional random field, all different texts of an Arrow batch at once. The weights, of fixed
    size, are broadcast. Cases: null and empty texts come out as they are with no types; texts of any length are labelled
    whole; repeated rows are rows; an empty table gives no rows.
    """
    shared = df.sparkSession.sparkContext.broadcast((model or trained()).parts())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = Model(*shared.value)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found: dict[str, list[tuple[int, int, str]]] = {}
            for group in _groups(dict.fromkeys(t for t in texts if t)):
                found.update(zip(group, find_spans(group, crf), strict=True))
            types = [sorted({TYPES[k] for _, _, k in found.get(t, ())}) for t in texts]
            new = [replace(t, found[t]) if t else t for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(types, pa.list_(pa.string())), pa.array(new, pa.string())], names=[key, "pii_types", "redacted"])

    kind = df.schema[key].dataType.simpleString()
    return spread(df.select(key, text)).mapInArrow(run, f"`{key}` {kind}, pii_types array<string>, redacted string")


if __name__ == "__main__":
    from histrail.llm import pii  # under its own name, so that the sources are found alike

    pii.save(pii.train(list(labelled_table(TRAINING_ROWS, 7)), EPOCHS))

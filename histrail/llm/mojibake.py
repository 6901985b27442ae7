"""Find text that was decoded with the wrong character encoding, and restore it where it still can be."""

from __future__ import annotations

import re
import unicodedata
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import log2

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise, spread

#: A pair whose share of the corpus's mutual information (in bits a pair, the information of one pair taken as at most
#: ``MOST_BITS``) lies below this is improbable.
THRESHOLD = 1e-3
MOST_BITS = 4.0
#: Text with a mapping undone must be likelier by so many bits, and by the logarithm of the number of mappings that were tried.
#: A character that stood where no language puts it counts as so many bits.
LEAST_GAIN, ODD_BITS = 4.0, 8.0
#: Where nothing but the likelihood speaks for a mapping, so many characters of a text, in different places, must agree on it.
AGREEING = 3
#: and at least so much of the pairs that they make must occur in the corpus.
OWN_PAIRS = 0.9
#: Non-ASCII characters with up to so many ASCII characters between them are one piece, tested with so much around it.
GAP, AROUND = 4, 2
#: A worker remembers what the exchanges gain on up to so many different pieces, some 1,300 bytes each.
MOST_GAINS = 20_000

#: The encodings that text is taken for by mistake.
READ_AS = ("cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1250", "cp1251", "iso8859-2", "cp1254", "iso8859-15", "koi8-r", "cp866", "cp1253", "cp852", "cp857", "iso8859-9", "iso8859-5", "mac_cyrillic", "cp1257", "cp775", "mac_latin2", "mac_turkish")
#: The single-byte encodings that it was written in (besides UTF-8, which is tested with all of the above).
WRITTEN_IN = ("cp1252", "cp1250", "cp1251", "cp1254", "koi8-r", "iso8859-2", "cp866", "mac_roman", "cp437", "cp850", "iso8859-5", "cp852", "cp857", "mac_cyrillic", "mac_turkish", "mac_latin2")
LOST = "�"
#: Characters that are odd white space on their own and no sign of a wrong encoding.
ODD_SPACE = frozenset("\xa0\xad\u200b\ufeff\u2028\u2029")
_PIECE = re.compile(rf"[^\x00-\x7f](?:[^ \t\n\r\x0b\x0c]{{0,{GAP}}}[^\x00-\x7f])*")


def _table(encoding: str) -> list[str]:
    """The character of each byte; bytes without one stand for the control character of their number, as browsers do it."""
    return [bytes([b]).decode(encoding, "replace").replace(LOST, chr(b)) for b in range(256)]


def _inverse() -> dict[str, dict[str, int]]:
    out = {}
    for e in READ_AS:
        table = {c: b for b, c in enumerate(_table(e)) if b > 127}
        for b in range(128, 160):
            table.setdefault(chr(b), b)
        out[e] = table
    return out


_BYTES = _inverse()
_WRITTEN = {e: _table(e) for e in WRITTEN_IN}


def _lead_and_tail(encoding: str) -> re.Pattern[str]:
    """A character that stands for the first byte of a UTF-8 sequence, then those for its continuation bytes."""
    of = lambda lo, hi: "".join(re.escape(c) for c, b in _BYTES[encoding].items() if lo <= b <= hi)
    tail = f"[{of(0x80, 0xBF)}]"
    return re.compile(f"[{of(0xC2, 0xDF)}]{tail}|[{of(0xE0, 0xEF)}]{tail}{{2}}|[{of(0xF0, 0xF4)}]{tail}{{3}}")


_SEQUENCE = {e: _lead_and_tail(e) for e in READ_AS}
#: Exchange tables between two encodings.
_EXCHANGE = {(e, w): {ord(c): _WRITTEN[w][b] for c, b in _BYTES[e].items()} for e in READ_AS for w in WRITTEN_IN if w != e}


def _as_utf8(piece: str, encoding: str) -> str:
    """Decode every run of characters whose bytes form a valid UTF-8 sequence; the rest stays."""
    to_byte = _BYTES[encoding]

    def decode(m: re.Match[str]) -> str:
        try:
            return bytes(to_byte[c] for c in m.group()).decode("utf-8")
        except UnicodeDecodeError:
            return m.group()

    return _SEQUENCE[encoding].sub(decode, piece)


def _is_utf8(piece: str, encoding: str) -> bool:
    """Whether the bytes of the whole piece are UTF-8, and every character of it is one that is assigned."""
    try:
        new = bytes(ord(c) if c < "\x80" else _BYTES[encoding].get(c, 0xFF) for c in piece).decode("utf-8")
    except UnicodeDecodeError:
        return False
    return not any(unicodedata.category(c) in ("Cn", "Co") or "\x80" <= c < "\xa0" for c in new)


@lru_cache(maxsize=100_000)
def _exchanged(c: str) -> np.ndarray:
    """What a character becomes under each exchange table; 0 where it has no byte or its byte means nothing. Odd white space
    stays: text of any encoding holds it, and it is no part of a word."""
    if c < "\x80" or c in ODD_SPACE:
        return np.full(len(_EXCHANGE), ord(c), dtype=np.int64)
    new = [t.get(ord(c), "\0") for t in _EXCHANGE.values()]
    return np.array([0 if "\x80" <= x < "\xa0" else ord(x) for x in new], dtype=np.int64)


# How a character may stand beside letters, whatever the language.
_JOINS = frozenset("’‘ʼ·‐‑–—…\u2044")
_AFTER_LETTERS = frozenset("™®°ºª²³¹ⁿ′″€£¥→←↔⇒×÷±=≠≤≥≈<>+−")
_FORMULA = frozenset("×÷±=≠≤≥≈<>+−→←↔⇒")
_MIXED_SCRIPTS = frozenset(("LATIN", "GREEK", "CYRILLIC"))


@lru_cache(maxsize=100_000)
def _kind(c: str) -> tuple[str, str, int]:
    """The group of a character (L letter, M mark, D digit, S symbol, B box drawing, K lone accent, P punctuation, X no character
    of texts, blank), its script if it is a letter, its case (1 upper, -1 lower)."""
    category = unicodedata.category(c)
    if c in "ªºµⁿ":
        return "S", "", 0
    if "\u02b0" <= c <= "\u02ff":
        return "K", "", 0
    if category[0] == "L":
        return "L", unicodedata.name(c, "?").split(" ", 1)[0], 1 if category in ("Lu", "Lt") else -1 if category == "Ll" else 0
    if category in ("Cc", "Cn", "Co"):
        return ("X" if "\x80" <= c or category != "Cc" else " "), "", 0
    if category in ("Mn", "Mc", "Me", "Cf"):
        return "M", "", 0
    if category[0] == "Z":
        return " ", "", 0
    if "\u2500" <= c <= "\u259f":
        return "B", "", 0
    group = "D" if category == "Nd" else "K" if category == "Sk" and c >= "\x80" else "P" if category[0] == "P" else "S"
    return group, "", 0


def oddness(text: str, start: int = 0, end: int | None = None) -> int:
    """How many non-ASCII characters of ``text[start:end]`` stand where no language puts them.

    Such are: control and unassigned characters; a letter between letters of another script; a capital after a small letter, a
    small letter after two capitals; the fifth Latin letter with a mark in a row; a lone letter before a digit; a symbol, number sign or quotation mark between letters; box
    drawing, a lone accent or a fraction behind a letter; a symbol that follows a non-ASCII letter or quotation mark.
    """
    odd = row = 0
    end = len(text) if end is None else end
    for i in range(start, end):
        c = text[i]
        if c < "\x80":
            row = 0
            continue
        group, script, case = _kind(c)
        before, b_script, b_case = _kind(text[i - 1]) if i else (" ", "", 0)
        after, a_script, a_case = _kind(text[i + 1]) if i + 1 < len(text) else (" ", "", 0)
        row = row + 1 if group == "L" and script == "LATIN" else 0
        between = before == "L" and after == "L"
        if group == "X":
            odd += 1
        elif group == "L":
            strange = between and script != b_script and script != a_script and script in _MIXED_SCRIPTS and b_script in _MIXED_SCRIPTS and a_script in _MIXED_SCRIPTS
            shouting = case < 0 and b_case > 0 and i > 1 and _kind(text[i - 2])[2] > 0
            # a capital of another script after one small letter is a unit, such as the Greek one of resistance
            risen = case > 0 and b_case < 0 and (script == b_script or (i > 1 and _kind(text[i - 2])[0] == "L"))
            odd += strange or risen or (case < 0 and a_case > 0) or shouting or row > 4 or (before != "L" and after == "D" and c != "Ø")
        elif group == "K":
            odd += before == "L" or after == "L"
        elif group == "B":
            odd += before == "L" or (before == "S" and text[i - 1] >= "\x80") or (after in "LS" and text[i + 1 : i + 2] >= "\x80")
        elif group in "SP":
            # a sign between two single letters is a formula
            formula = c in _FORMULA and (i < 2 or _kind(text[i - 2])[0] != "L") and (i + 2 >= len(text) or _kind(text[i + 2])[0] != "L")
            wide = between and not formula
            lead = group == "S" and i > 0 and text[i - 1] >= "\x80" and before in "LP" and c not in _AFTER_LETTERS
            behind = group == "S" and before == "L" and c not in _AFTER_LETTERS
            ahead = group == "S" and after == "L" and text[i + 1] >= "\x80" and c in "√∞∂∆∏∑Ω≈"
            odd += (wide and c not in _JOINS) or lead or behind or ahead
    return odd


@dataclass
class PairModel:
    """Counts of adjacent characters over the whole corpus, sorted by pair; digits count as 0."""

    codes: np.ndarray
    counts: np.ndarray

    def __post_init__(self) -> None:
        self.total = float(self.counts.sum()) or 1.0
        first, second = self.codes >> 32, self.codes & 0xFFFFFFFF
        self.left = self._margin(first)
        self.right = self._margin(second)
        p = self.counts / self.total
        pl, pr = self._of(self.left, first) / self.total, self._of(self.right, second) / self.total
        bits = np.clip(np.log2(p / (pl * pr)), 2.0**-20, MOST_BITS) if len(p) else p
        #: How improbable each pair is: positive below the threshold.
        self.scores = np.clip(np.log2(THRESHOLD) - np.log2(p * bits), -4.0, 8.0)
        self.looked_up: dict[int, float] = {}
        self.firsts = np.array(sorted(self.left), dtype=np.int64)
        self.first_counts = np.array([self.left[c] for c in self.firsts.tolist()])

    def _margin(self, side: np.ndarray) -> dict[int, float]:
        values, where = np.unique(side, return_inverse=True)
        return dict(zip(values.tolist(), np.bincount(where, weights=self.counts, minlength=len(values)).tolist(), strict=True))

    @staticmethod
    def _of(margin: dict[int, float], side: np.ndarray) -> np.ndarray:
        table = np.zeros(max(margin, default=0) + 1)
        table[list(margin)] = list(margin.values())
        return table[side]

    def count(self, code: int) -> float:
        """How often a pair occurs; the arrays hold all pairs, a dict only those that were asked for."""
        n = self.looked_up.get(code)
        if n is None:
            if len(self.looked_up) > 500_000:
                self.looked_up.clear()
            at = int(np.searchsorted(self.codes, code))
            n = self.looked_up[code] = float(self.counts[at]) if at < len(self.codes) and self.codes[at] == code else 0.0
        return n

    def score(self, codes: np.ndarray) -> np.ndarray:
        if not len(self.codes):
            return np.full(len(codes), 8.0)
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, self.scores[at], 8.0)

    def has(self, codes: np.ndarray) -> np.ndarray:
        if not len(self.codes):
            return np.zeros(codes.shape, dtype=bool)
        return self.codes[np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)] == codes

    def knows(self, c: str) -> bool:
        return ord(c) in self.left or ord(c) in self.right

    def bits(self, points: np.ndarray) -> np.ndarray:
        """Bits of each character but the first of rows of characters, given the one before."""
        points = np.where((points >= 48) & (points <= 57), 48, points)
        if not len(self.codes):
            return np.full(points[:, 1:].shape, log2(0.05 / 25.0))
        left = points[:, :-1]
        pairs = (left << 32) | points[:, 1:]
        at = np.minimum(np.searchsorted(self.codes, pairs), len(self.codes) - 1)
        n = np.where(self.codes[at] == pairs, self.counts[at], 0.0)
        to = np.minimum(np.searchsorted(self.firsts, left), len(self.firsts) - 1)
        m = np.where(self.firsts[to] == left, self.first_counts[to], 0.0)
        return np.log2((n + 0.05) / (m + 25.0))

    def likelihood(self, text: str) -> float:
        """Bits of the text, each character given the one before."""
        points = [48 if 48 <= (p := ord(c)) <= 57 else p for c in text]
        count, left = self.count, self.left.get
        return sum(log2((count((a << 32) | b) + 0.05) / (left(a, 0) + 25.0)) for a, b in zip(points, points[1:], strict=False))


def _points(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    return np.where((points >= 48) & (points <= 57), 48, points)


def pair_codes(text: str) -> np.ndarray:
    points = _points(text)
    return (points[:-1] << 32) | points[1:]


def improbable_runs(scores: np.ndarray, near: np.ndarray | None = None) -> list[tuple[int, int]]:
    """All maximal scoring segments (Ruzzo and Tompa), as ranges of pairs; with ``near``, those of them that could hold or touch
    one of these pairs.

    No segment crosses a place where the sum from the beginning is as low as never before, so the pairs between two such
    places stand alone, and only stretches that are asked for are worked through.
    """
    if not len(scores):
        return []
    total = np.cumsum(scores)
    inside = np.concatenate([[False], total > np.minimum.accumulate(np.concatenate([[0.0], total[:-1]])), [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    begins, ends = edges[::2], edges[1::2]
    if near is not None and len(begins):
        # a stretch of pairs [b, e) is asked for if a near pair lies in [b - 1, e]
        count = np.concatenate([[0], np.cumsum(near)])
        asked = count[np.minimum(ends + 1, len(near))] > count[np.maximum(begins - 1, 0)]
        begins, ends = begins[asked], ends[asked]
    return [(s + b, e + b) for b, e_ in zip(begins.tolist(), ends.tolist(), strict=True) for s, e in _segments(scores[b:e_])]


def _segments(scores: np.ndarray) -> list[tuple[int, int]]:
    """Maximal scoring segments one after another. Neighbours of one sign are added up first."""
    if len(scores) == 1:
        return [(0, 1)] if scores[0] > 0 else []
    sign = scores > 0
    cuts = np.concatenate([[0], np.flatnonzero(sign[1:] != sign[:-1]) + 1])
    sums = np.add.reduceat(scores, cuts).tolist()
    ends = np.concatenate([cuts[1:], [len(scores)]]).tolist()
    starts = cuts.tolist()
    found: list[tuple[int, int, float, float]] = []  # start, end, total before, total after
    total, settled = 0.0, 0  # no later segment reaches back beyond ``settled``
    for s, e, x in zip(starts, ends, sums, strict=True):
        if x <= 0:
            total += x
            continue
        lo, before = s, total
        total += x
        after = total
        while True:
            j = len(found) - 1
            while j >= settled and found[j][2] >= before:
                j -= 1
            if j < settled:
                settled = len(found)
                break
            if found[j][3] >= after:
                break
            lo, before = found[j][0], found[j][2]
            del found[j:]
        found.append((lo, e, before, after))
    return [(s, e) for s, e, _, _ in found]


_ZEROS = str.maketrans("123456789", "0" * 9)


@dataclass
class _Piece:
    """A stretch of a text that is tested: where it stands, what it is, and a little of what is around it."""

    at: int
    text: str
    before: str
    after: str

    @property
    def key(self) -> tuple[str, str, str]:
        """Pieces of one key are judged alike: digits around them are all one."""
        return self.before.translate(_ZEROS), self.text, self.after.translate(_ZEROS)

    def with_(self, new: str) -> str:
        return f"{self.before}{new}{self.after}"

    def places(self) -> set[str]:
        """Its non-ASCII characters with their neighbours."""
        whole, at = self.with_(self.text), len(self.before)
        return {whole[i - 1 : i + 2] for i in range(at, at + len(self.text)) if whole[i] >= "\x80"}

    def odd(self, new: str) -> int:
        return oddness(self.with_(new), len(self.before), len(self.before) + len(new))


@dataclass
class _Look:
    """What is known of a piece: the texts it may be UTF-8 of (see :meth:`Restorer._utf8`), its odd characters, whether its
    non-ASCII characters are all letters, and where these stand."""

    sure: str | None
    likely: str | None
    beside: str | None
    odd: int
    letters: bool
    places: set[str]


class Restorer:
    """Tests the inverse mappings on pieces of text; what only a piece's surroundings decide is worked out once."""

    def __init__(self, model: PairModel):
        self.model = model
        self.known: dict[tuple[str, str, str], _Look] = {}
        self.columns: dict[str, np.ndarray] = {}
        self.gained: dict[tuple[str, str, str], tuple[np.ndarray, float]] = {}

    def _look(self, p: _Piece, key: tuple[str, str, str]) -> _Look:
        """What a piece's surroundings alone decide."""
        got = self.known.get(key)
        if got is None:
            if len(self.known) > 200_000:
                self.known.clear()
            letters = all(c < "\x80" or _kind(c)[0] in "LM" for c in p.text)
            got = self.known[key] = _Look(*self._utf8(p), p.odd(p.text), letters, p.places())
        return got

    def _utf8(self, p: _Piece) -> tuple[str | None, str | None, str | None]:
        """The likeliest text of which the piece is UTF-8, read wrongly once or several times: one that holds by itself, one
        that holds beside those or several of its kind, one that holds beside those only. None for what there isn't.

        Layers are undone one by one and judged each; a layer leaves fewer characters, so it ends. A likelier text that loses
        odd characters holds by itself. Of one with characters that the corpus has nowhere else the likelihood says nothing:
        it needs all bytes to be UTF-8, and two odd characters less to hold by itself.
        """
        now, odd = self.model.likelihood(p.with_(p.text)), p.odd(p.text)
        best: list[str | None] = [None, None, None]
        gains = [-1e9, 0.0, -1e9]
        layers, seen = [(p.text, True)], {p.text}
        while layers:
            inner = []
            for text, whole in layers:
                for e in READ_AS:
                    if not _SEQUENCE[e].search(text):
                        continue
                    new = _as_utf8(text, e)
                    if new in seen:
                        continue
                    seen.add(new)
                    entire = whole and _is_utf8(text, e)
                    inner.append((new, entire))
                    # a sequence of three or more characters is rare by chance
                    less = odd - p.odd(new) + (len(text) - len(new) > len(_SEQUENCE[e].findall(text)))
                    gain = self.model.likelihood(p.with_(new)) - now
                    known = all(c < "\x80" or self.model.knows(c) for c in new)
                    sure = (known and gain > 0 and less > 0) or (entire and less > 1)
                    tier = 0 if sure else 1 if known else 2
                    if gain > gains[tier] and less >= 0 and (tier < 2 or entire):
                        best[tier], gains[tier] = new, gain
            layers = inner
        return tuple(best)

    def _column(self, c: str) -> np.ndarray:
        """What a character becomes under each exchange table; 0 where that is nothing that the corpus knows."""
        got = self.columns.get(c)
        if got is None:
            every = _exchanged(c)
            fine = {v: v > 0 and (v < 128 or self.model.knows(chr(v))) for v in set(every.tolist())}
            got = self.columns[c] = np.array([v if fine[v] else 0 for v in every.tolist()], dtype=np.int64) if c >= "\x80" else every
        return got

    def _gains(self, p: _Piece, key: tuple[str, str, str]) -> tuple[np.ndarray, float]:
        """The bits that each exchange table gains on the piece, 0 where it is impossible or changes nothing; and the most that
        one of them gains that makes nothing but pairs of the corpus."""
        held = self.gained.get(key)
        if held is None:
            most = 0.0
            new = np.stack([self._column(c) for c in p.text], axis=1)
            possible = (new > 0).all(1)
            # tables that do the same to these characters are scored once
            which: dict[bytes, int] = {}
            same = np.array([which.setdefault(row.tobytes(), len(which)) if fine else -1 for row, fine in zip(new, possible, strict=True)])
            got = np.zeros(len(new), dtype=np.float32)
            if which:
                rows = np.stack([np.frombuffer(k, dtype=np.int64) for k in which])
                around = [np.tile(_points(x), (len(rows), 1)) for x in (p.before, p.after)]
                gain = self.model.bits(np.concatenate([around[0], rows, around[1]], axis=1)).sum(1) - self.model.bits(_points(p.with_(p.text))[None]).sum()
                got[possible] = gain.astype(np.float32)[same[possible]]
                points = np.concatenate([around[0], rows, around[1]], axis=1)
                points = np.where((points >= 48) & (points <= 57), 48, points)
                pairs = (points[:, :-1] << 32) | points[:, 1:]
                own = ((points[:, :-1] < 128) & (points[:, 1:] < 128)) | self.model.has(pairs)
                most = float(np.where(own.all(1), gain, 0.0).max(initial=0.0))
            if len(self.gained) > MOST_GAINS:
                self.gained.clear()
            held = self.gained[key] = (got, most)
        return held

    def _exchange(self, pieces: list[_Piece], keys: list[tuple[str, str, str]], odd: bool) -> dict[int, str]:
        """The pieces (by number) that one exchange of bytes restores, the best for all of them together; empty if none holds.
        Without ``odd`` characters it must make the corpus's own pairs, so what those gain has to suffice."""
        each = [self._gains(p, k) for p, k in zip(pieces, keys, strict=True)]
        if not odd and sum(most for _, most in each) <= LEAST_GAIN + log2(len(_EXCHANGE)):
            return {}
        gain = np.stack([g for g, _ in each], axis=1)
        margin = LEAST_GAIN + log2(len(_EXCHANGE))
        was_odd = np.array([p.odd(p.text) for p in pieces])
        letters = np.array([all(c < "\x80" or _kind(c)[0] in "LM" for c in p.text) for p in pieces])
        # no more than the odd characters of the pieces that gain can be lost, so the rest need not be looked at
        most = np.where(gain > 0, gain + ODD_BITS * was_odd, 0.0).sum(1)
        if most.max() <= margin:
            return {}
        best: dict[int, str] = {}
        best_score = margin
        for r in np.argsort(-most, kind="stable"):
            if most[r] <= best_score:
                break
            out: dict[int, str] = {}
            less, won = 0, 0.0
            for i in np.flatnonzero(gain[r] > 0):
                p = pieces[i]
                text = "".join([chr(self._column(c)[r]) for c in p.text])
                fewer = int(was_odd[i]) - p.odd(text)
                if fewer >= 0:
                    out[int(i)] = text
                    less += fewer
                    won += float(gain[r, i])
            score = won + ODD_BITS * less
            if score <= best_score:
                continue
            # letters that only became likelier letters: in several different places, hardly any that becomes less likely, and
            # nearly all of the new pairs are the corpus's own
            agree = len({x for i, t in out.items() if letters[i] and all(c < "\x80" or _kind(c)[0] in "LM" for c in t) for x in pieces[i].places()})
            if less > 0 or (agree >= AGREEING and float(gain[r].sum()) > 0.8 * won and self._own([pieces[i].with_(t) for i, t in out.items()]) >= OWN_PAIRS):
                best, best_score = out, score
        return best

    def _own(self, texts: list[str]) -> float:
        """The share of their pairs with a non-ASCII character that the corpus has."""
        points = [_points(t) for t in texts]
        own = [self.model.count((a << 32) | b) > 0 for x in points for a, b in zip(x[:-1].tolist(), x[1:].tolist(), strict=True) if a > 127 or b > 127]
        return sum(own) / max(1, len(own))

    def text(self, text: str | None) -> tuple[bool, str | None, int]:
        """Whether the text holds a wrongly decoded stretch, the text as far as it can be restored, the number of such pieces."""
        if not text or text.isascii():
            return False, text, 0
        padded = f" {text} "
        points = _points(padded)
        scores = self.model.score((points[:-1] << 32) | points[1:])
        special = points > 127
        runs = np.array(improbable_runs(scores, special[:-1] | special[1:]), dtype=np.int64).reshape(-1, 2)
        spans = np.array([m.span() for m in _PIECE.finditer(text)], dtype=np.int64).reshape(-1, 2)
        # a piece is tested when an improbable run touches one of its pairs, the one into it and out of it included
        nearest = np.searchsorted(runs[:, 1], spans[:, 0], "right")
        touched = nearest < len(runs)
        touched[touched] = runs[nearest[touched], 0] <= spans[touched, 1]
        pieces = [_Piece(lo, text[lo:hi], padded[max(0, lo + 1 - AROUND) : lo + 1], text[hi : hi + AROUND] if hi < len(text) else " ") for lo, hi in spans[touched].tolist()]
        # pieces of one key are judged alike, once
        alike: dict[tuple[str, str, str], list[int]] = {}
        for i, p in enumerate(pieces):
            alike.setdefault(p.key, []).append(i)
        found = {k: self._look(pieces[i[0]], k) for k, i in alike.items()}
        new_of = {k: f.sure for k, f in found.items() if f.sure is not None}
        likely = {k: f.likely for k, f in found.items() if f.sure is None and f.likely is not None}
        if new_of:
            new_of |= {k: f.beside for k, f in found.items() if k not in new_of and k not in likely and f.beside is not None}
        if new_of or (likely and len(set().union(*(found[k].places for k in likely))) >= AGREEING):
            new_of |= likely
        rest = [k for k in found if k not in new_of and LOST not in k[1]]
        odd = any(found[k].odd for k in rest)
        if not odd:  # then only letters may become letters
            rest = [k for k in rest if found[k].letters]
            rest = rest if rest and len(set().union(*(found[k].places for k in rest))) >= AGREEING else []
        while rest:
            got = self._exchange([pieces[alike[k][0]] for k in rest], rest, odd)
            if not got:
                break
            new_of |= {rest[n]: t for n, t in got.items()}
            rest = [k for n, k in enumerate(rest) if n not in got]
        new = {i: t for k, t in new_of.items() for i in alike[k]}
        out, at = [], 0
        for i in sorted(new):
            p = pieces[i]
            out += [text[at : p.at], new[i]]
            at = p.at + len(p.text)
        # the piece with characters that were lost for good stays as it is
        hits = len(new) + sum(LOST in p.text for i, p in enumerate(pieces) if i not in new)
        return hits > 0, "".join([*out, text[at:]]) if new else text, hits


def pair_model(df: DataFrame, text: str) -> PairModel:
    """Count adjacent characters over all texts: summed in each Arrow batch, then by pair over the cluster.

    Every pair comes to the driver with its exact count: two numbers a different pair, however long the corpus is.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, size = [], 0
            for t in [*batch.column(0).to_pylist(), None]:
                if t:
                    parts.append(pair_codes(f" {t} "))
                    size += len(t)
                if parts and (size > 4_000_000 or t is None):  # long texts are counted in several goes
                    codes, counts = np.unique(np.concatenate(parts), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts.astype(np.int64))], names=["pair", "n"])
                    parts, size = [], 0

    counted = materialise(spread(df.select(text)).mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    kept = counted.toArrow().sort_by("pair")
    return PairModel(kept.column("pair").to_numpy().astype(np.int64), kept.column("n").to_numpy().astype(np.float64))


_restorers: dict[str, Restorer] = {}


def restorer_for(name: str, model: Broadcast) -> Restorer:
    """A worker that runs several tasks keeps what it has tested."""
    if name not in _restorers:
        _restorers.clear()
        _restorers[name] = Restorer(PairModel(*model.value))
    return _restorers[name]


def restore(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key, wrongly_decoded, restored, n_pieces`` for every row of ``df``.

    Adjacent characters are scored by what their pair adds to the mutual information of adjacent characters in the corpus;
    the maximal scoring segments of a text are its improbable runs. Only the pieces of non-ASCII text that such a run touches
    are tested with the inverse mappings: text written as UTF-8 and read as one of ``READ_AS`` (any number of times over), or
    written in one single-byte encoding and read as another, the same for all pieces. The evidence is the likelihood under
    the corpus's pairs, beyond a margin that grows with the number of mappings tried, together with :func:`oddness`, what
    stands where no language puts it: rare characters alone are no sign of a wrong encoding. Without odd characters several
    places of a text must agree. Where the wrong decoding lost characters for good (U+FFFD), the text is found, and that
    piece stays as it is.

    Cases: null, empty and pure ASCII texts come out unchanged and not wrongly decoded. Odd white space on its own (no-break
    space, zero-width characters, soft hyphen) is no case. Texts of any length are handled whole. An empty table gives no rows.
    """
    model = pair_model(df, text)
    shared, name = df.sparkSession.sparkContext.broadcast((model.codes, model.counts)), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fix = restorer_for(name, shared)
        for batch in batches:
            done = [fix.text(t) for t in batch.column(1).to_pylist()]
            found, new, hits = zip(*done, strict=True) if done else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.bool_()), pa.array(new, pa.string()), pa.array(hits, pa.int32())], names=[key, "wrongly_decoded", "restored", "n_pieces"])

    kind = df.schema[key].dataType.simpleString()
    return spread(df.select(key, text)).mapInArrow(run, f"`{key}` {kind}, wrongly_decoded boolean, restored string, n_pieces int")

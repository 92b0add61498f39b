"""Personal data in whole texts: fixed base rules and a semi-Markov conditional random field.

The base rules give the leftmost non-overlapping matches of each kind.  The field then
reads every *island*, a run of neighbouring words of which each holds a digit, ``@`` or
``+``, with one word of context on both sides.  It scores whole candidate segments
of up to ``MAX_ATOMS`` atoms by features of the whole span (shape, number of digits,
check digit, octets, context) and a label transition, and a dynamic program chooses
boundaries and types together.  What it finds outside the base spans is added; base
spans always stay.

``fit`` reads the islands of every text, each distinct one counting once however often it
is copied, and trains the field by its exact likelihood on a bounded sample of them
(``fit_islands``) whose labels are the base spans and quoted hexadecimal secrets.  Every
combination of kinds that occurs has its places in the sample.  Islands of more than
``longest_island`` characters are trained on in parts.  Everything else covers every text
from end to end.

Defined results: a null text counts as empty and has no span, and stays null when it is
redacted; an empty table, or one without any labelled span, fits no model and only base
rules apply; equal rows give equal rows; other columns pass through.  Offsets are code
points, the end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadloom.llm.common import column_or, in_batches

Span = tuple[str, int, int]

#: Kinds in their order of output; the last is found by the model alone.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")
LABELS = ("", *KINDS)
#: The base patterns.  The address pattern is applied around each ``@``.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_SECRET = re.compile(r'(?<=")[0-9a-f]{32,64}(?=")')

MAX_ATOMS = 14
_ISLAND = re.compile(
    r"(?:[^\x20\x09-\x0D]+[\x20\x09-\x0D]{1,2})?"
    r"[^\x20\x09-\x0D0-9@+]*[0-9@+][^\x20\x09-\x0D]*"
    r"(?:[\x20\x09-\x0D]{1,2}[^\x20\x09-\x0D0-9@+]*[0-9@+][^\x20\x09-\x0D]*)*+"
    r"(?:[\x20\x09-\x0D]{1,2}[^\x20\x09-\x0D]+)?"
)
_TRIGGER = re.compile(r"[0-9@+]")
_HEX = re.compile(r"[0-9A-Fa-f]+")
_ATOM = re.compile(r"[A-Za-z0-9]+|[^A-Za-z0-9\s]|\s+")
_SPACE = re.compile(r"[\x20\x09-\x0D]")
_BREAK = frozenset("\x20\t\n\x0b\x0c\r")


def passes_luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if place % 2:
            value = value * 2 - 9 if value > 4 else value * 2
        total += value
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def _octet(part: str) -> bool:
    return part.isascii() and part.isdigit() and _small(part)


def _emails(text: str) -> Iterator[Span]:
    """Matches of the address pattern: each ends a run of local characters with ``@`` and a domain."""
    free, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        start = at
        if domain:
            while start > free and text[start - 1] in _LOCAL:
                start -= 1
        if start < at:
            free = domain.end()
            yield "email", start, free
            at = text.find("@", free)
        else:
            at = text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    """All base spans, by kind as listed, then by start."""
    found = list(_emails(text)) if "@" in text else []
    if _DIGIT.search(text):
        found += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_small, m.group().split(".")))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = m.group().replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 19 and passes_luhn(digits):
                    found.append(("card", *m.span()))
        if "+" in text:
            found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_DIGIT.findall(m.group())) <= 15]
    return found


def written(spans: list[Span]) -> str:
    """The spans as text, by kind as listed, then by start."""
    order = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in order)


def islands(text: str) -> Iterator[tuple[int, int]]:
    """Ranges of the text that the model reads: words with a digit, ``@`` or ``+`` and their neighbours."""
    found = _TRIGGER.search(text)
    done = 0
    while found:
        start = _word_start(text, found.start(), done)
        if start > done and text[start - 1] in _BREAK:
            start = _word_start(text, start - 1, done)
        island = _ISLAND.match(text, start)
        end = island.end() if island else found.end()
        end = max(end, found.end())
        yield start, end
        done = end
        found = _TRIGGER.search(text, end)


def _word_start(text: str, at: int, least: int) -> int:
    while at > least and text[at - 1] not in _BREAK:
        at -= 1
    return at


# ---------------------------------------------------------------- features of a whole segment

_SHAPE = re.compile(r"[A-Za-z0-9]+|\s+")
_NUMBER = re.compile(r"[0-9]+")
_RUNS = re.compile(r"[0-9]+|[A-Za-z]+")


def _shape_of(match: re.Match) -> str:
    """One character a run; letters and digits that change more than once are ``x``."""
    run = match.group()
    if run.isspace():
        return " "
    runs = _RUNS.findall(run)
    return "x" if len(runs) > 2 else "".join("9" if r[0].isdigit() else "a" for r in runs)


def _shape(span: str) -> str:
    return _SHAPE.sub(_shape_of, span)


def _word_before(text: str, start: int) -> str:
    before = text[max(0, start - 12) : start].rstrip(" \"'=:").lower()
    return before[-6:] if before[-5:].isalpha() else "other"


def _kind_of(text: str, at: int) -> str:
    if not 0 <= at < len(text):
        return "edge"
    c = text[at]
    return "digit" if c.isdigit() else "letter" if c.isalpha() else "space" if c.isspace() else c


def segment_features(text: str, start: int, end: int) -> list[str]:
    """Names of the features that hold for ``text[start:end]`` as one entity."""
    span = text[start:end]
    digits = "".join(_DIGIT.findall(span))
    shape = _shape(span)
    parts = span.split(".")
    octets = len(parts) == 4 and all(map(_octet, parts))
    return [
        f"shape {shape[:24]}",
        f"digits {min(len(digits), 20)} in {min(len(_NUMBER.findall(span)), 9)}",
        f"check {passes_luhn(digits) if 13 <= len(digits) <= 19 else 'none'}",
        f"octets {octets}",
        f"at {span.count('@')}",
        f"ends {_kind_of(span, 0)} {_kind_of(span, len(span) - 1)}",
        f"left {_kind_of(text, start - 1)}",
        f"right {_kind_of(text, end)}",
        f"hex {len(span) >= 32 and _HEX.fullmatch(span) is not None}",
        f"after {_word_before(text, start)}",
    ]


@dataclass
class Lattice:
    """Candidate segments of one island: ``stop[k]``, ``size[k]`` in atoms and the features of each."""

    bounds: list[tuple[int, int]]
    stop: np.ndarray
    size: np.ndarray
    names: list[list[str]]


def lattice(text: str) -> Lattice:
    """All segments of up to ``MAX_ATOMS`` atoms that can be an entity, and every single atom."""
    atoms = [m.span() for m in _ATOM.finditer(text)]
    triggers = [bool(_TRIGGER.search(text, *a)) for a in atoms]
    solid = [not text[a].isspace() for a, _ in atoms]
    stop, size, names = [], [], []
    for last in range(len(atoms)):
        seen = False
        for first in range(last, max(-1, last - MAX_ATOMS), -1):
            seen = seen or triggers[first]
            if first == last or (seen and solid[first] and solid[last]):
                stop.append(last + 1)
                size.append(last - first + 1)
                entity = seen and solid[first] and solid[last]
                names.append(segment_features(text, atoms[first][0], atoms[last][1]) if entity else [])
    return Lattice(atoms, np.array(stop, np.int64), np.array(size, np.int64), names)


# ---------------------------------------------------------------- the field


@dataclass
class Field:
    """Weights: one row per feature and one column per label, and label transitions."""

    index: dict[str, int]
    weights: np.ndarray
    transitions: np.ndarray

    def scores(self, grid: Lattice) -> np.ndarray:
        """Score of every segment under every label; minus infinity where it cannot carry it."""
        out = np.zeros((len(grid.names), len(LABELS)))
        for k, names in enumerate(grid.names):
            known = [self.index[n] for n in names if n in self.index]
            if names:
                out[k] = self.weights[known].sum(axis=0) + self.weights[-1]
                if len(known) < len(names) and names[0] not in self.index:
                    out[k, 1:] -= UNSEEN_SHAPE
            else:
                out[k, 1:] = -np.inf
        out[grid.size > 1, 0] = -np.inf
        out[grid.size == 1, 0] = 0.0
        return out

    def rows(self, names: Iterable[str]) -> np.ndarray:
        """Weights of these features, one row each; zeros for those never seen."""
        return np.array([self.weights[self.index[n]] if n in self.index else np.zeros(len(LABELS)) for n in names])

    def window_scores(self, atoms: list[Atom], context: int = 0) -> np.ndarray:
        """Scores by last atom, size less one and label, of all segments that end behind the first ``context`` atoms.

        The same as ``scores`` of the lattices, by sums over the atoms instead of the texts of
        segments; no segment goes beyond the island of its last atom.
        """
        n = len(atoms)
        pieces, lefts, rights, words, places, _ = zip(*atoms, strict=True)
        place, length = np.array(places), _sums(list(map(len, pieces)))
        solid = np.array([not p.isspace() for p in pieces])
        digits = ["".join(_DIGIT.findall(p)) for p in pieces]
        triggers = _sums([bool(_TRIGGER.search(p)) for p in pieces])
        ats, unhex = _sums([p == "@" for p in pieces]), _sums([not _HEX.fullmatch(p) for p in pieces])
        octet, dot = (np.array([test(p) for p in pieces]) for test in (_octet, ".".__eq__))
        n_digits, n_runs = _sums([len(d) for d in digits]), _sums([len(_NUMBER.findall(p)) for p in pieces])
        plain = np.frombuffer("".join(digits).encode(), np.uint8).astype(np.int64) - 48
        double = np.where(plain > 4, 2 * plain - 9, 2 * plain)
        odd = np.arange(len(plain)) % 2 == 1
        luhn = [_sums(np.where(odd == bool(k), plain, double)) for k in (0, 1)]  # by whether the last digit is at an odd place

        shapes, shape = np.unique([_shape(p)[:24] for p in pieces], return_inverse=True)
        alone, alone_id = list(map(str, shapes)), shape
        kinds, edge = np.unique([_kind_of(p, k) for p in pieces for k in (0, len(p) - 1)], return_inverse=True)
        opens, ends = edge[::2], edge[1::2]
        ends_of = self.rows(f"ends {x} {y}" for x in kinds for y in kinds)
        left = self.looked_up("left", lefts) + self.looked_up("after", words)
        right = self.looked_up("right", rights)
        digits_of = self.rows(f"digits {k} in {r}" for k in range(21) for r in range(10))
        check_of = self.rows(f"check {k}" for k in ("none", False, True))
        octets_of = self.rows(f"octets {k}" for k in (False, True))
        at_of = self.rows(f"at {k}" for k in range(MAX_ATOMS + 1))
        hex_of = self.rows(f"hex {k}" for k in (False, True))

        out = np.full((n, MAX_ATOMS, len(LABELS)), -np.inf)
        names = alone
        for size in range(1, min(MAX_ATOMS, n) + 1):
            last = np.arange(size - 1, n)
            begin = last - (size - 1)
            if size > 1:  # the shape of the segment without its last atom, and that atom's
                pairs, shape = np.unique(shape[:-1] * len(alone) + alone_id[last], return_inverse=True)
                names = [(names[p // len(alone)] + alone[p % len(alone)])[:24] for p in pairs.tolist()]
            shape_of = self.rows(f"shape {x}" for x in names)
            shape_of[[f"shape {x}" not in self.index for x in names], 1:] -= UNSEEN_SHAPE
            done, end = n_digits[begin], n_digits[last + 1]
            count, runs = end - done, np.minimum(n_runs[last + 1] - n_runs[begin], 9)
            by_last = np.where(end % 2 == 0, luhn[1][end] - luhn[1][done], luhn[0][end] - luhn[0][done])
            check = np.where((count >= 13) & (count <= 19), 1 + (by_last % 10 == 0), 0)
            octets = np.zeros(len(last), np.int64)
            if size == 7:
                octets[:] = np.logical_and.reduce([(dot if k % 2 else octet)[begin + k] for k in range(7)])
            whole_hex = (unhex[last + 1] == unhex[begin]) & (length[last + 1] - length[begin] >= 32)
            score = shape_of[shape] + digits_of[np.minimum(count, 20) * 10 + runs] + check_of[check] + octets_of[octets]
            score += at_of[ats[last + 1] - ats[begin]] + ends_of[opens[begin] * len(kinds) + ends[last]]
            score += left[begin] + right[last] + hex_of[whole_hex.astype(np.int64)] + self.weights[-1]
            entity = solid[begin] & solid[last] & (triggers[last + 1] > triggers[begin]) & (place[last] >= size - 1)
            score[~entity] = -np.inf
            score[:, 0] = 0.0 if size == 1 else -np.inf
            out[last, size - 1] = score
        return out[context:]

    def looked_up(self, feature: str, values: Sequence[str]) -> np.ndarray:
        distinct = {v: k for k, v in enumerate(dict.fromkeys(values))}
        return self.rows(f"{feature} {v}" for v in distinct)[[distinct[v] for v in values]]

    def decode(self, island: str) -> list[Span]:
        """The best segmentation, as entity spans of the island."""
        return next(self.decode_all([island]), [])

    def decode_all(self, islands: Iterable[str]) -> Iterator[list[Span]]:
        """The best segmentation of each island that is not empty.

        Scores are made for ``WINDOW`` atoms at a time, of several islands or a part of one;
        only the ends of an island's atoms and the way back are kept.
        """
        labels = np.arange(len(LABELS))
        # Best way to each place, the transition behind it included; the newest place comes first.
        reach = np.full((WINDOW + MAX_ATOMS, len(LABELS)), -np.inf)
        from_label = np.zeros(reach.shape, np.int8)
        stops, sizes, came = array("q", [0]), bytearray(), bytearray()
        context: list[Atom] = []
        found = (atom for island in islands for atom in _atoms(island))
        while atoms := list(islice(found, WINDOW)):
            reach[WINDOW:], from_label[WINDOW:] = reach[:MAX_ATOMS].copy(), from_label[:MAX_ATOMS].copy()
            scores = self.window_scores(context + atoms, len(context))
            for at, atom, own in zip(range(WINDOW, 0, -1), atoms, scores, strict=False):
                if atom.place == 0:
                    reach[at], from_label[at] = self.transitions[0], 0
                ways = reach[at : at + MAX_ATOMS] + own
                size = ways.argmax(axis=0)
                best = ways[size, labels]
                sizes += (size + 1).astype(np.int8).tobytes()
                came += from_label[at + size, labels].tobytes()
                stops.append(stops[-1] + len(atom.piece))
                if atom.last:
                    yield _way_back(int(best.argmax()), stops, sizes, came)
                    stops, sizes, came = array("q", [0]), bytearray(), bytearray()
                else:
                    onward = best[:, None] + self.transitions
                    from_label[at - 1] = label = onward.argmax(axis=0)
                    reach[at - 1] = onward[label, labels]
            if len(atoms) == WINDOW:
                context = (context + atoms)[-(MAX_ATOMS - 1) :]


class Atom(NamedTuple):
    """A piece of an island: what lies on both sides, the word before, its number (up to ``MAX_ATOMS``)."""

    piece: str
    left: str
    right: str
    word: str
    place: int
    last: bool


def _atoms(island: str) -> Iterator[Atom]:
    for place, found in enumerate(_ATOM.finditer(island)):
        a, b = found.span()
        yield Atom(found.group(), _kind_of(island, a - 1), _kind_of(island, b), _word_before(island, a), min(place, MAX_ATOMS), b == len(island))


def _way_back(label: int, stops: array, sizes: bytearray, came: bytearray) -> list[Span]:
    spans: list[Span] = []
    end = len(stops) - 1
    while end > 0:
        at = (end - 1) * len(LABELS) + label
        begin = end - sizes[at]
        if label:
            spans.append((LABELS[label], stops[begin], stops[end]))
        end, label = begin, came[at]
    return spans[::-1]


def _sums(values) -> np.ndarray:
    """Sums of the first 0, 1, 2, ... values."""
    return np.concatenate([[0], np.cumsum(np.asarray(values, np.int64))]).astype(np.int64)


#: Atoms whose segments are scored at once.
WINDOW = 2048
#: A span whose shape was never seen in training loses this much.
UNSEEN_SHAPE = 6.0


def train(examples: list[tuple[str, list[Span]]], rounds: int = 16, rate: float = 0.5, decay: float = 1e-3) -> Field | None:
    """Maximum likelihood by exact forward-backward sums over all segmentations."""
    grids = [(lattice(text), spans) for text, spans in examples]
    names = sorted({n for grid, _ in grids for each in grid.names for n in each})
    if not any(spans for _, spans in examples) or not names:
        return None
    index = {n: i for i, n in enumerate(names)}
    labels = len(LABELS)
    field = Field(index, np.zeros((len(names) + 1, labels)), np.zeros((labels, labels)))
    prepared = []
    for grid, spans in grids:
        truth = _truth(grid, spans)
        if truth is not None:
            ids = [np.array([index[n] for n in each] + [len(names)], np.int64) if each else None for each in grid.names]
            prepared.append((grid, ids, truth))
    seen_w, seen_t = np.full_like(field.weights, 1e-8), np.full_like(field.transitions, 1e-8)
    for _ in range(rounds):
        grad_w, grad_t = -decay * field.weights, -decay * field.transitions
        for grid, ids, truth in prepared:
            _gradient(field, grid, ids, truth, grad_w, grad_t)
        seen_w += grad_w**2
        seen_t += grad_t**2
        field.weights += rate * grad_w / np.sqrt(seen_w)
        field.transitions += rate * grad_t / np.sqrt(seen_t)
        field.weights[:, 0] = 0.0
    return field


def _truth(grid: Lattice, spans: list[Span]) -> list[tuple[int, int]] | None:
    """(segment, label) along the labelled path; none if a span does not fit the atoms."""
    starts = {a: i for i, (a, _) in enumerate(grid.bounds)}
    ends = {b: i + 1 for i, (_, b) in enumerate(grid.bounds)}
    at = {(int(e), int(n)): k for k, (e, n) in enumerate(zip(grid.stop, grid.size, strict=True))}
    path, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: s[1]):
        first, last = starts.get(a), ends.get(b)
        if first is None or last is None or first < done or (last, last - first) not in at:
            return None
        path += [(at[i + 1, 1], 0) for i in range(done, first)]
        path.append((at[last, last - first], LABELS.index(kind)))
        done = last
    return path + [(at[i + 1, 1], 0) for i in range(done, len(grid.bounds))]


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    top = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return np.log(np.exp(values - top).sum(axis=axis)) + np.squeeze(top, axis)


def _gradient(field: Field, grid: Lattice, ids: list, truth: list, grad_w: np.ndarray, grad_t: np.ndarray) -> None:
    atoms, labels = len(grid.bounds), len(LABELS)
    scores = np.full((len(ids), labels), -np.inf)
    for k, own in enumerate(ids):
        if own is not None:
            scores[k] = field.weights[own].sum(axis=0)
    scores[grid.size > 1, 0] = -np.inf
    scores[grid.size == 1, 0] = 0.0
    ahead = np.full((atoms + 1, labels), -np.inf)
    ahead[0, 0] = 0.0
    begin = grid.stop - grid.size
    ending = [np.nonzero(grid.stop == e)[0] for e in range(atoms + 1)]
    starting = [np.nonzero(begin == b)[0] for b in range(atoms + 1)]
    step = np.empty_like(scores)  # all paths into a segment, the segment included
    for e in range(1, atoms + 1):
        own = ending[e]
        reach = _log_sum(ahead[begin[own]][:, :, None] + field.transitions[None], 1)
        step[own] = reach + scores[own]
        ahead[e] = _log_sum(step[own], 0)
    rest = np.full((atoms + 1, labels), -np.inf)
    rest[atoms] = 0.0
    for b in range(atoms - 1, -1, -1):
        own = starting[b]
        onward = _log_sum(scores[own] + rest[grid.stop[own]], 0)
        rest[b] = _log_sum(field.transitions + onward[None, :], 1)
    total = _log_sum(ahead[atoms], 0)
    share = np.exp(step + rest[grid.stop] - total)
    for k, own in enumerate(ids):
        if own is not None:
            grad_w[own] -= share[k]
    for b in range(atoms):
        own = starting[b]
        onward = _log_sum(scores[own] + rest[grid.stop[own]], 0)
        grad_t -= np.exp(ahead[b][:, None] + field.transitions + onward[None, :] - total)
    before = 0
    for k, label in truth:
        if ids[k] is not None:
            grad_w[ids[k], label] += 1.0
        grad_t[before, label] += 1.0
        before = label


# ---------------------------------------------------------------- on tables


def labelled_islands(text: str, longest: int = 300) -> Iterator[tuple[str, list[Span]]]:
    """Islands with the base spans and quoted secrets in them, for training, in parts of up to ``longest`` characters."""
    marks = base_spans(text) + [("secret", *m.span()) for m in _SECRET.finditer(text)]
    chosen: list[Span] = []
    for span in sorted(marks, key=lambda s: (s[1], -s[2])):
        if not chosen or span[1] >= chosen[-1][2]:
            chosen.append(span)
    ahead = 0  # spans before this one end before the island
    for start, end in islands(text):
        while ahead < len(chosen) and chosen[ahead][2] <= start:
            ahead += 1
        own = []
        for span in chosen[ahead:]:
            if span[1] >= end:
                break
            own.append(span)
        for first, last in _parts(text, start, end, own, longest):
            yield text[first:last], [(k, a - first, b - first) for k, a, b in own if first <= a and b <= last]


def _parts(text: str, start: int, end: int, spans: list[Span], longest: int) -> Iterator[tuple[int, int]]:
    """The island, cut before white space outside spans where it is too long; stretches that cannot be cut are left out."""
    if end - start <= longest:
        yield start, end
        return
    first = last = start
    for cut in _cuts(text, start, end, spans):
        if cut - first > longest:
            if first < last:
                yield first, last
            first = last
        if cut - first > longest:  # one stretch alone is too long
            first = cut
        last = cut
    if first < last:
        yield first, last


def _cuts(text: str, start: int, end: int, spans: list[Span]) -> Iterator[int]:
    """Places of white space outside the spans, which are in order, and the end."""
    ahead = 0
    for found in _SPACE.finditer(text, start + 1, end):
        cut = found.start()
        while ahead < len(spans) and spans[ahead][2] <= cut:
            ahead += 1
        if ahead == len(spans) or cut <= spans[ahead][1]:
            yield cut
    yield end


def fit(docs: DataFrame, text: str = "text", fit_islands: int = 240, longest_island: int = 300) -> Field | None:
    """Train on ``fit_islands`` distinct islands of all documents.

    Half of the places are dealt evenly to the combinations of kinds that occur, islands
    without a span being one; the others go to the islands that come first by hash.
    """
    rows = docs.select(F.col(text).alias("text")).filter(F.col("text").rlike("[0-9@+]"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_batches(batches, 1000):
            found = {
                (t, written(s), " ".join(sorted({k for k, _, _ in s})))
                for x in column_or(batch, "text")
                for t, s in labelled_islands(x, longest_island)
            }
            columns = [pa.array([p[i] for p in found], pa.string()) for i in range(3)]
            yield pa.RecordBatch.from_arrays(columns, names=["island", "spans", "kinds"])

    by_hash = Window.partitionBy("kinds").orderBy("hash", "island", "spans")
    first = (
        rows.mapInArrow(run, "island string, spans string, kinds string")
        .distinct()
        .withColumn("hash", F.xxhash64("island", "spans"))
        .withColumn("place", F.row_number().over(by_hash))
        .filter(F.col("place") <= fit_islands)
    )
    found = sorted(first.collect(), key=lambda r: (r.hash, r.island, r.spans))  # fit_islands short strings for each combination
    each = max(1, fit_islands // (2 * max(1, len({r.kinds for r in found}))))
    found.sort(key=lambda r: r.place > each)
    examples = []
    for row in found[:fit_islands]:
        marks = [s.split(":") for s in row.spans.split(",") if s]
        examples.append((row.island, [(k, int(a), int(b)) for k, a, b in marks]))
    return train(examples)


def all_spans(text: str, field: Field | None) -> tuple[list[Span], list[Span]]:
    """Base spans, and those the field adds."""
    return next(spans_of([text], field))


def spans_of(texts: list[str], field: Field | None) -> Iterator[tuple[list[Span], list[Span]]]:
    """For each text its base spans, and those the field adds."""
    found = iter(()) if field is None else field.decode_all(text[a:b] for text in texts for a, b in islands(text))
    for text in texts:
        base = base_spans(text)
        added: list[Span] = []
        if field is not None:
            taken = _covered(base)
            ahead = 0
            for start, _ in islands(text):
                for kind, a, b in next(found):
                    a, b = a + start, b + start
                    while ahead < len(taken) and taken[ahead][1] <= a:
                        ahead += 1
                    if ahead == len(taken) or b <= taken[ahead][0]:
                        added.append((kind, a, b))
        yield base, added


def _covered(spans: list[Span]) -> list[list[int]]:
    """What the spans cover, as ranges in order without overlaps."""
    out: list[list[int]] = []
    for a, b in sorted((a, b) for _, a, b in spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def redacted(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind; overlapping spans become one, named by the first."""
    out, done = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if start >= done:
            out += [text[done:start], f"<{kind.upper()}>"]
        done = max(done, end)
    out.append(text[done:])
    return "".join(out)


FOUND = T.StructType(
    [T.StructField(f"n_{kind}", T.LongType()) for kind in BASE_KINDS]
    + [
        T.StructField("base_sha256", T.StringType()),
        T.StructField("spans", T.StringType()),
        T.StructField("n_added", T.LongType()),
        T.StructField("redacted", T.StringType()),
    ]
)


def find(docs: DataFrame, field: Field | None, text: str = "text", redact: bool = True) -> DataFrame:
    """All columns of ``docs`` but ``text``, the counts of base spans, all spans, and the redacted text.

    The counts are of base spans; ``n_added`` counts the field's.  ``redact=False``
    leaves the redacted text out.
    """
    added = [f for f in FOUND.fields if redact or f.name != "redacted"]
    names = [f.name for f in added]
    kept = [c for c in docs.columns if c not in names and c != text]
    schema = T.StructType([docs.schema[c] for c in kept] + added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_batches(batches, 1000):
            out: dict[str, list] = {n: [] for n in names}
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            for own, (base, more) in zip(texts, spans_of([t or "" for t in texts], field), strict=True):
                for kind in BASE_KINDS:
                    out[f"n_{kind}"].append(sum(s[0] == kind for s in base))
                out["base_sha256"].append(hashlib.sha256(written(base).encode()).hexdigest())
                out["spans"].append(written(base + more))
                out["n_added"].append(len(more))
                if redact:
                    out["redacted"].append(None if own is None else redacted(own, base + more))
            columns = [batch.column(i) for i in range(len(kept))]
            columns += [pa.array(out[f.name], pa.int64() if f.dataType == T.LongType() else pa.string()) for f in added]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *names])

    return docs.select(*kept, text).mapInArrow(run, schema)

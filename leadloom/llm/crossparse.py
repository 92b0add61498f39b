"""Language of a text by cross-parsing against one suffix automaton per language.

Labelled text of each language becomes a suffix automaton, which reads exactly the
substrings of that text.  A new text is parsed greedily into the longest substrings that
the automaton knows; every phrase costs a pointer into the labelled text, so

    bits per character = phrases * log2(labelled length) / characters,

(a pointer costs no less than naming one of all letters, or a language of which little
text is known would have the cheapest phrases) and the language with the fewest bits wins.  Every letter of any language's sample has a code of its own; a letter of none begins a
phrase everywhere.  Automata are tables of numbers with a column for each letter of their
language, or sorted lists of transitions where it has more than ``WIDE`` letters, and many
stretches of text are parsed in step, one look-up per character and language.

``learn`` reads a bounded sample of labelled rows: of each language the first
``documents_per_language`` distinct texts by hash, as long as they stay below ``characters``
together.  Texts of 100 to ``longest`` characters come first; where a language has too few,
longer ones (their first ``longest`` characters from the first letter on) and shorter ones fill its places.
So every language with a labelled letter is learnt.  Predictions read every whole text.
A phrase ends at the end of a stretch of ``STRETCH`` characters, in all languages alike.

Defined results: ``und`` with score 0 where the text is null or has no letter, or nothing
was learnt; equal texts get equal results; ties go to the first language by name; an empty
table gives an empty table; other columns pass through.  The score is the share of the
winner when every language weighs 2 to the power of minus ``SHARPNESS`` times its bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadloom.llm.common import in_batches

UNDETERMINED = "und"
STRETCH = 1024
SHARPNESS = 8.0
WIDE = 128
GAP, OTHER = 0, 1
CODE_POINTS = 0x110000

#: Labelled text by language, in the order of names.
Sample = tuple[tuple[str, str], ...]


def learn(
    docs: DataFrame, documents_per_language: int = 64, longest: int = 4_000, characters: int = 60_000
) -> Sample:
    """A bounded sample of labelled text; ``docs`` has text and lang."""
    reach = min(longest, characters)
    own, length = F.col("text"), F.length("text")
    stretch = F.when(length > reach, F.substring(F.regexp_replace(own, r"^\P{L}++", ""), 1, reach)).otherwise(own)
    texts_of = (
        docs.select(own.cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
        .filter(F.col("lang").isNotNull() & own.rlike(r"\p{L}"))
        .select("lang", stretch.alias("text"), (~length.between(100, longest)).alias("late"))
        .withColumn("hash", F.xxhash64("text"))
    )
    place = Window.partitionBy("lang").orderBy("late", "hash")
    chosen = (
        texts_of.groupBy("lang", "hash")
        .agg(F.min("late").alias("late"))
        .withColumn("place", F.row_number().over(place))
        .filter(F.col("place") <= documents_per_language)
        .select("lang", "hash", "place")
    )
    rows = texts_of.select("lang", "hash", "text").join(F.broadcast(chosen), ["lang", "hash"]).distinct()
    texts: dict[str, str] = {}
    # documents_per_language short texts for each language
    for row in sorted(rows.collect(), key=lambda r: (r["lang"], r["place"], r["text"])):
        if len(texts.get(row["lang"], "")) + len(row["text"]) <= characters:
            texts[row["lang"]] = f"{texts.get(row['lang'], '')} {row['text']}"
    return tuple(sorted(texts.items()))


def suffix_automaton(codes: np.ndarray) -> list[dict[int, int]]:
    """Transitions of the automaton that reads all substrings of ``codes``; 0 is its start."""
    moves: list[dict[int, int]] = [{}]
    link, longest = [-1], [0]
    last = 0
    for code in codes.tolist():
        new = len(moves)
        moves.append({})
        link.append(0)
        longest.append(longest[last] + 1)
        at = last
        while at >= 0 and code not in moves[at]:
            moves[at][code] = new
            at = link[at]
        if at >= 0:
            found = moves[at][code]
            if longest[found] == longest[at] + 1:
                link[new] = found
            else:
                copy = len(moves)
                moves.append(dict(moves[found]))
                link.append(link[found])
                longest.append(longest[at] + 1)
                while at >= 0 and moves[at].get(code) == found:
                    moves[at][code] = copy
                    at = link[at]
                link[found] = link[new] = copy
        last = new
    return moves


class Automaton:
    """Moves by state and letter: twice the next state, plus one where a phrase begins."""

    def __init__(self, codes: np.ndarray, letters: int):
        own = np.unique(codes)
        #: Place of each code among the language's own, 0 for letters that it does not have.
        self.place = np.zeros(letters, np.min_scalar_type(len(own) + 1))
        self.place[own] = np.arange(1, len(own) + 1)
        self.width = len(own) + 1
        moves = suffix_automaton(self.place[codes])
        self.start = np.ones(self.width, np.int32)
        for place, to in moves[0].items():
            self.start[place] = to * 2 + 1
        rows = np.repeat(np.arange(len(moves)), [len(m) for m in moves])
        keys = rows * self.width + np.array([p for m in moves for p in m], np.int64)
        values = np.array([to for m in moves for to in m.values()], np.int32) * 2
        if self.width <= WIDE:
            self.keys, self.values = None, np.tile(self.start, (len(moves), 1)).ravel()
            self.values[keys] = values
        else:
            order = np.argsort(keys)
            self.keys, self.values = keys[order], values[order]

    def move(self, state: np.ndarray, place: np.ndarray) -> np.ndarray:
        wanted = state * self.width + place
        if self.keys is None:
            return self.values.take(wanted)
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.values[at], self.start[place])


@lru_cache(maxsize=1)
def letter_points() -> np.ndarray:
    """The code points that are letters."""
    return np.array([c for c in range(CODE_POINTS) if chr(c).isalpha()])


class Parser:
    """The automata of all languages."""

    def __init__(self, sample: Sample):
        known = sorted({c for _, text in sample for c in text.lower() if c.isalpha()})
        self.width = len(known) + 2
        self.plane = np.full(CODE_POINTS, GAP, np.min_scalar_type(self.width))
        self.plane[letter_points()] = OTHER
        self.plane[[ord(c) for c in known]] = np.arange(2, self.width)
        self.names = [name for name, _ in sample]
        self.tables, self.pointer_bits = [], []
        for _, text in sample:
            codes = self.encode(text)
            self.tables.append(Automaton(codes, self.width))
            self.pointer_bits.append(float(np.log2(max(len(codes) + 1, self.width))))

    def encode(self, text: str) -> np.ndarray:
        """Letters as small numbers; whatever is between letters is one gap."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = self.plane[points]
        gap = codes == GAP
        return codes[~(gap & np.concatenate(([True], gap[:-1])))] if len(codes) else codes

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases of every text (rows) in every language (columns)."""
        pieces = [(i, t[a : a + STRETCH]) for i, t in enumerate(texts) for a in range(0, len(t), STRETCH)]
        pieces.sort(key=lambda p: -len(p[1]))
        out = np.zeros((len(texts), len(self.tables)), np.int64)
        for first in range(0, len(pieces), 8192):
            lanes = pieces[first : first + 8192]
            owner = np.array([i for i, _ in lanes])
            lengths = np.array([len(p) for _, p in lanes])
            grid = np.zeros((int(lengths[0]), len(lanes)), self.plane.dtype)
            for k, (_, piece) in enumerate(lanes):
                grid[: len(piece), k] = piece
            alive = np.searchsorted(-lengths, -np.arange(len(grid)), side="left")
            for column, table in enumerate(self.tables):
                places = table.place[grid]
                state = np.zeros(len(lanes), np.int64)
                count = np.ones(len(lanes), np.int64)
                for step, row in enumerate(places):
                    n = alive[step]
                    move = table.move(state[:n], row[:n])
                    count[:n] += move & 1
                    state[:n] = move >> 1
                np.add.at(out[:, column], owner, count)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        encoded = [self.encode(t or "") for t in texts]
        lengths = np.array([max(len(t), 1) for t in encoded])
        known = np.array([bool((t != GAP).any()) for t in encoded], bool)
        bits = self.phrases(encoded) * np.array(self.pointer_bits) / lengths[:, None]
        best = bits.argmin(axis=1)
        weight = np.exp2(SHARPNESS * (bits.min(axis=1, keepdims=True) - bits))
        share = 1.0 / weight.sum(axis=1)
        return (
            [self.names[b] if k else UNDETERMINED for b, k in zip(best, known, strict=True)],
            [float(s) if k else 0.0 for s, k in zip(share, known, strict=True)],
        )


@lru_cache(maxsize=2)
def parser(sample: Sample) -> Parser:
    """Built once per Python worker from the sample, which is small."""
    return Parser(sample)


ADDED = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]


def predict(docs: DataFrame, sample: Sample, text: str = "text") -> DataFrame:
    """All columns of ``docs`` but ``text``, the language and its score."""
    names = [f.name for f in ADDED]
    kept = [c for c in docs.columns if c not in names and c != text]
    schema = T.StructType([docs.schema[c] for c in kept] + ADDED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_batches(batches, 2000):
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            if sample:
                languages, scores = parser(sample).predict(texts)
            else:
                languages, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            columns = [batch.column(i) for i in range(len(kept))]
            columns += [pa.array(languages, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *names])

    return docs.select(*kept, text).mapInArrow(run, schema)

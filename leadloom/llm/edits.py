"""Edit-aware token counts with a segment tree over the pre-tokens of each document.

A leaf holds one pre-token and its number of tokens; leaves lie in blocks, and inner nodes
hold the sums of lengths and tokens of the blocks below.  An edit finds its leaves by length
sums, reads again from one leaf before the one it touches (white space and contractions look
ahead that far) and goes on until a new pre-token starts where an old one did, beyond the
edit.  Only that stretch is encoded; its leaves are replaced and the sums above them updated.
A block that grows to twice its size splits, so many edits at one place stay cheap.

``count`` takes documents with an array of edits and does both in one pass; ``build`` and
``apply`` keep the trees' leaves in columns between batches of edits.

Edits of a document are applied in order; ``start`` and ``stop`` are code points of the
text as it is by then, moved into the text where they lie outside (a stop before the
start counts as the start; null is 0 for the start and the start for the stop); a null
insertion is empty.

Defined results: a null text is empty and has no token; null or no edits change nothing;
equal rows give equal rows; an empty table gives an empty table; other columns pass
through.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadloom.llm.bpe import encoding, token_ids
from leadloom.llm.common import in_batches

EDIT = "struct<start: bigint, stop: bigint, insert: string>"
#: A match of the split pattern depends on no more than this many characters behind it.
LOOK_AHEAD = 3


class TokenCounts(dict):
    """Number of tokens of each pre-token; forgets all when there are many."""

    LIMIT = 150_000

    def __init__(self, rank_file: str, pattern: str):
        super().__init__()
        self.encoding = encoding(rank_file, pattern)

    def __missing__(self, piece: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        count = len(token_ids(piece, self.encoding))
        if len(piece) <= 64:
            self[piece] = count
        return count


class Tree:
    """Leaves in blocks of up to ``2 * BLOCK``, and sums of lengths and tokens over the blocks.

    Node ``i`` of the sums has children ``2i`` and ``2i + 1``; the block ``b`` is node
    ``size + b``.  A block that grows too long splits, an empty one goes.
    """

    BLOCK = 64

    def __init__(self, pieces: list[str], tokens: list[int], counts: TokenCounts, pattern):
        self.counts, self.pattern = counts, pattern
        self.reencoded = 0
        self.blocks, self.marks = self._cut(pieces), self._cut(tokens)
        self._sum(*self._totals(self.blocks, self.marks))

    @classmethod
    def of(cls, text: str, counts: TokenCounts, pattern) -> Tree:
        pieces = pattern.findall(text)
        return cls(pieces, [counts[p] for p in pieces], counts, pattern)

    def _cut(self, leaves: list) -> list[list]:
        return [leaves[i : i + self.BLOCK] for i in range(0, len(leaves), self.BLOCK)]

    @staticmethod
    def _totals(blocks: list[list[str]], marks: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.fromiter((len("".join(own)) for own in blocks), np.int64, len(blocks))
        return lengths, np.fromiter(map(sum, marks), np.int64, len(marks))

    def _sum(self, lengths: np.ndarray, tokens: np.ndarray) -> None:
        self.size = 1 << max(len(lengths) - 1, 0).bit_length()
        self.lengths, self.tokens = (np.zeros(2 * self.size, np.int64) for _ in range(2))
        for sums, own in ((self.lengths, lengths), (self.tokens, tokens)):
            sums[self.size : self.size + len(own)] = own
            first = self.size
            while first > 1:
                sums[first // 2 : first] = sums[first : 2 * first].reshape(-1, 2).sum(axis=1)
                first //= 2

    @property
    def length(self) -> int:
        return int(self.lengths[1])

    @property
    def total(self) -> int:
        return int(self.tokens[1])

    def pieces(self) -> list[str]:
        return [p for own in self.blocks for p in own]

    def piece_tokens(self) -> list[int]:
        return [n for own in self.marks for n in own]

    def text(self) -> str:
        return "".join(self.pieces())

    def leaf_at(self, place: int) -> tuple[int, int, int]:
        """Block and number of the leaf that holds the character at ``place``, and the characters before that leaf."""
        node, before = 1, 0
        while node < self.size:
            node *= 2
            left = int(self.lengths[node])
            if place - before >= left:
                before += left
                node += 1
        block = node - self.size
        for leaf, piece in enumerate(self.blocks[block]):
            if place - before < len(piece):
                return block, leaf, before
            before += len(piece)
        raise IndexError(place)

    def _from(self, block: int, leaf: int) -> Iterator[str]:
        yield from self.blocks[block][leaf:]
        for later in range(block + 1, len(self.blocks)):
            yield from self.blocks[later]

    def edit(self, start: int, stop: int, insert: str) -> None:
        length = self.length
        start = min(max(start, 0), length)
        stop = min(max(stop, start), length)
        if not insert and stop == start:
            return
        block = leaf = before = 0
        if length:
            block, leaf, before = self.leaf_at(max(start - 1, 0))
        for _ in range(2):
            if leaf == 0 and block:
                block, leaf = block - 1, len(self.blocks[block - 1])
            if leaf:
                leaf -= 1
                before -= len(self.blocks[block][leaf])
        leaves = self._from(block, leaf) if length else iter(())
        old, reached = [], before
        while reached <= stop and (piece := next(leaves, None)) is not None:
            old.append(piece)
            reached += len(piece)
        stretch = "".join(old)
        buffer = stretch[: start - before] + insert + stretch[stop - before :]
        edited, taken, more = start - before + len(insert), len(old), True
        starts = {}  # where old leaves start in the buffer, and how many are before
        if old and reached - len(old[-1]) == stop:
            starts[edited] = taken - 1
        new, place = [], 0
        while True:
            match = self.pattern.match(buffer, place) if place < len(buffer) else None
            if more and (match is None or match.end() + LOOK_AHEAD > len(buffer)):
                ahead = list(islice(leaves, 16))
                more = len(ahead) == 16
                for k, end in enumerate(accumulate(map(len, ahead), initial=len(buffer))):
                    if k < len(ahead):
                        starts[end] = taken + k
                taken += len(ahead)
                buffer += "".join(ahead)
                continue
            if match is None or (place >= edited and place in starts):
                break
            new.append(match.group())
            place = match.end()
        # Old leaves from the place on where old and new agree stay.
        self._replace(block, leaf, taken if match is None else starts[place], new)

    def _replace(self, block: int, leaf: int, count: int, new: list[str]) -> None:
        """Put ``new`` in the place of ``count`` leaves from that one on."""
        self.reencoded += sum(map(len, new))
        tokens = [self.counts[p] for p in new]
        last, rest = block, leaf + count
        while last + 1 < len(self.blocks) and rest > len(self.blocks[last]):
            rest -= len(self.blocks[last])
            last += 1
        pieces, marks = [new], [tokens]
        if self.blocks:
            pieces = [self.blocks[block][:leaf] + new, self.blocks[last][rest:]]
            marks = [self.marks[block][:leaf] + tokens, self.marks[last][rest:]]
        if last == block:
            pieces, marks = [sum(pieces, [])], [sum(marks, [])]
        same = len(pieces) == last - block + 1 and last < len(self.blocks)
        if same and all(0 < len(own) <= 2 * self.BLOCK for own in pieces):
            self.blocks[block : last + 1], self.marks[block : last + 1] = pieces, marks
            for k, (length, total) in enumerate(zip(*self._totals(pieces, marks), strict=True)):
                self._set(self.size + block + k, int(length), int(total))
            return
        pieces = [part for own in pieces for part in self._cut(own)]
        marks = [part for own in marks for part in self._cut(own)]
        known = slice(self.size, self.size + len(self.blocks))
        sums = [
            np.concatenate([old[known][:block], part, old[known][last + 1 :]])
            for old, part in zip((self.lengths, self.tokens), self._totals(pieces, marks), strict=True)
        ]
        self.blocks[block : last + 1], self.marks[block : last + 1] = pieces, marks
        self._sum(*sums)

    def _set(self, node: int, length: int, tokens: int) -> None:
        longer, more = length - int(self.lengths[node]), tokens - int(self.tokens[node])
        while node and (longer or more):
            self.lengths[node] += longer
            self.tokens[node] += more
            node //= 2


def _apply(tree: Tree, edits: list[dict] | None) -> int:
    for e in edits or []:
        start = e["start"] or 0
        tree.edit(start, start if e["stop"] is None else e["stop"], e["insert"] or "")
    return len(edits or [])


def _pattern(pattern: str):
    import regex

    return regex.compile(pattern)


COUNTED = T.StructType(
    [
        T.StructField(n, T.LongType())
        for n in ("n_edits", "tokens_before", "tokens_after", "chars_before", "chars_after", "chars_encoded")
    ]
)


def count(docs: DataFrame, rank_file: str, pattern: str, text: str = "text", edits: str = "edits", keep_text: bool = False) -> DataFrame:
    """All columns but the text and the edits, and the counts before and after the edits.

    ``chars_encoded`` is how much text was encoded for the edits; ``keep_text`` adds the
    text after them as ``edited``.
    """
    added = [*COUNTED.fields, *([T.StructField("edited", T.StringType())] if keep_text else [])]
    names = [f.name for f in added]
    kept = [c for c in docs.columns if c not in names and c not in (text, edits)]
    schema = T.StructType([docs.schema[c] for c in kept] + added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, split = TokenCounts(rank_file, pattern), _pattern(pattern)
        for batch in in_batches(batches, 500):
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            lists = batch.column(batch.schema.get_field_index(edits)).to_pylist()
            rows = []
            for own, changes in zip(texts, lists, strict=True):
                tree = Tree.of(own or "", counts, split)
                before = tree.total, tree.length
                n = _apply(tree, changes)
                rows.append((n, before[0], tree.total, before[1], tree.length, tree.reencoded, *([tree.text()] if keep_text else [])))
            columns = [batch.column(i) for i in range(len(kept))]
            for i, field in enumerate(added):
                columns.append(pa.array([r[i] for r in rows], pa.string() if field.name == "edited" else pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *names])

    return docs.select(*kept, text, edits).mapInArrow(run, schema)


TREE = T.StructType(
    [
        T.StructField("leaves", T.ArrayType(T.StringType(), False)),
        T.StructField("leaf_tokens", T.ArrayType(T.IntegerType(), False)),
        T.StructField("n_tokens", T.LongType()),
    ]
)


def _leaves(trees: list[Tree]) -> list[pa.Array]:
    return [
        pa.array([t.pieces() for t in trees], pa.list_(pa.string())),
        pa.array([t.piece_tokens() for t in trees], pa.list_(pa.int32())),
        pa.array([t.total for t in trees], pa.int64()),
    ]


def build(docs: DataFrame, rank_file: str, pattern: str, text: str = "text") -> DataFrame:
    """All columns but the text, and the leaves of its tree with their tokens."""
    kept = [c for c in docs.columns if c not in TREE.fieldNames() and c != text]
    schema = T.StructType([docs.schema[c] for c in kept] + TREE.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, split = TokenCounts(rank_file, pattern), _pattern(pattern)
        for batch in in_batches(batches, 500):
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            trees = [Tree.of(t or "", counts, split) for t in texts]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(kept))), *_leaves(trees)], names=schema.fieldNames())

    return docs.select(*kept, text).mapInArrow(run, schema)


def apply(trees: DataFrame, rank_file: str, pattern: str, edits: str = "edits") -> DataFrame:
    """The trees after their edits; text that no edit touches is not encoded again."""
    kept = [c for c in trees.columns if c not in TREE.fieldNames() and c != edits]
    schema = T.StructType([trees.schema[c] for c in kept] + TREE.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, split = TokenCounts(rank_file, pattern), _pattern(pattern)
        for batch in in_batches(batches, 500):
            columns = {n: batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("leaves", "leaf_tokens", edits)}
            out = []
            for pieces, tokens, changes in zip(*columns.values(), strict=True):
                tree = Tree(pieces or [], tokens or [], counts, split)
                _apply(tree, changes)
                out.append(tree)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(kept))), *_leaves(out)], names=schema.fieldNames())

    return trees.select(*kept, "leaves", "leaf_tokens", "n_tokens", edits).mapInArrow(run, schema)


def sample_edits(doc_id: Column, text: Column) -> Column:
    """Four edits of each document, made of its own text: a replacement, an insertion, a removal, an addition."""
    own = F.coalesce(text, F.lit(""))
    length = F.length(own)

    def place(k: int) -> Column:
        return F.pmod(F.xxhash64(doc_id, F.lit(k)), (length + 1).cast("bigint"))

    def piece(k: int, size: int) -> Column:
        return F.substring(own, (place(k) + 1).cast("int"), F.lit(size))

    def edit(start: Column, stop: Column, insert: Column) -> Column:
        return F.struct(start.alias("start"), stop.alias("stop"), insert.alias("insert"))

    end = length.cast("bigint")
    return F.array(
        edit(place(1), place(1) + 7, piece(2, 15)),
        edit(place(3), place(3), F.concat(F.lit(" "), piece(4, 40))),
        edit(place(5), place(5) + 30, F.lit("")),
        edit(end * 2, end * 2, F.concat(F.lit("\n"), piece(6, 25))),
    )

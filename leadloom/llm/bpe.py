"""Byte-level BPE encoding and decoding of whole texts with a local rank file.

``encode`` adds the token ids of each text, ``decode`` turns ids back into raw bytes,
and ``round_trip`` does both in one pass and returns digests instead of the ids.

Defined results: a null text counts as empty and has no token; equal rows give equal
rows; an empty table gives an empty table; columns other than the named ones pass
through ``encode`` and ``decode`` untouched (a column named like an added one is
replaced).  Texts of any length are encoded whole: they are cut only in front of white
space that follows a character that is not white space, where every match of the split
pattern ends, so the pieces' ids joined are the ids of the text.  A run of white space of
``RUN_CHARS`` or more is one match, without its last character where text follows (that
belongs to the next match); it is merged without the pattern, whose stack it could exhaust.
The split pattern must treat white space like that, as those of GPT-2 and its kin do.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadloom.llm.common import column_or, in_batches

#: Texts are encoded in pieces of about this many characters.
PIECE_CHARS = 65_536
#: Runs of white space of this length are not given to the pattern.
RUN_CHARS = 4_096
#: White space as the tokenizer's patterns know it; ``\\s`` of ``re`` has four more.
_WHITE_RUN = re.compile(r"[\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % RUN_CHARS)
_SAFE_CUT = re.compile(r"(?<=[A-Za-z0-9.,;:!?])(?=[ \n])")


@lru_cache(maxsize=4)
def encoding(rank_file: str, pattern: str):
    """The tokenizer of a rank file, once per Python worker."""
    import tiktoken

    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding(rank_file, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """The text in order, cut at safe places only; a stretch without one stays whole."""
    start = 0
    while len(text) - start > size:
        cut = _SAFE_CUT.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def token_ids(text: str, enc) -> list[int]:
    """The ids of the whole text; it starts where a match starts."""
    if len(text) <= PIECE_CHARS:
        return enc.encode_ordinary(text)
    ids: list[int] = []
    start = 0
    for run in _WHITE_RUN.finditer(text):
        for piece in pieces(text[start : run.start()]):
            ids += enc.encode_ordinary(piece)
        start = run.end() - (run.end() < len(text))
        ids += enc._core_bpe.encode_single_piece(text[run.start() : start].encode())
    for piece in pieces(text[start:]):
        ids += enc.encode_ordinary(piece)
    return ids


def encode(
    docs: DataFrame, rank_file: str, pattern: str, text: str = "text", to: str = "token_ids", exact: str = "exact"
) -> DataFrame:
    """All columns of ``docs``, the token ids of ``text`` as an array, and whether they decode to its bytes."""
    kept = [c for c in docs.columns if c not in (to, exact)]
    added = [T.StructField(to, T.ArrayType(T.IntegerType(), False)), T.StructField(exact, T.BooleanType())]
    schema = T.StructType([docs.schema[c] for c in kept] + added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(rank_file, pattern)
        for batch in in_batches(batches, 500):
            texts = column_or(batch, text)
            ids = [token_ids(x, enc) for x in texts]
            same = [enc.decode_bytes(own) == x.encode() for own, x in zip(ids, texts, strict=True)]
            columns = [batch.column(i) for i in range(len(kept))]
            columns += [pa.array(ids, pa.list_(pa.int32())), pa.array(same, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, to, exact])

    return docs.select(*kept).mapInArrow(run, schema)


def decode(docs: DataFrame, rank_file: str, pattern: str, ids: str = "token_ids", to: str = "decoded") -> DataFrame:
    """All columns of ``docs`` and the raw bytes of the token ids; no ids give no bytes."""
    kept = [c for c in docs.columns if c != to]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(to, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(rank_file, pattern)
        for batch in in_batches(batches, 500):
            lists = batch.column(batch.schema.get_field_index(ids)).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(i) for i in range(len(kept))),
                    pa.array([enc.decode_bytes(x or []) for x in lists], pa.binary()),
                ],
                names=[*kept, to],
            )

    return docs.select(*kept).mapInArrow(run, schema)


ROUND_TRIP = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
        T.StructField("exact", T.BooleanType()),
    ]
)


def round_trip(docs: DataFrame, rank_file: str, pattern: str, text: str = "text") -> DataFrame:
    """Encode and decode in one pass: all other columns, the number of tokens and digests.

    ``ids_sha256`` is over the decimal ids joined by commas, ``decoded_sha256`` over the
    decoded bytes, and ``exact`` says whether those bytes are the text.
    """
    added = ROUND_TRIP.fieldNames()
    kept = [c for c in docs.columns if c not in added and c != text]
    source = docs.select(*kept, F.coalesce(F.col(text), F.lit("")).alias(text))
    schema = T.StructType([docs.schema[c] for c in kept] + ROUND_TRIP.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(rank_file, pattern)
        written = [str(i) for i in range(enc.n_vocab)]
        for batch in in_batches(batches, 1000):
            counts, ids_sums, byte_sums, exact = [], [], [], []
            for x in column_or(batch, text):
                ids = token_ids(x, enc)
                decoded = enc.decode_bytes(ids)
                counts.append(len(ids))
                ids_sums.append(hashlib.sha256(",".join([written[i] for i in ids]).encode()).hexdigest())
                byte_sums.append(hashlib.sha256(decoded).hexdigest())
                exact.append(decoded == x.encode())
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(i) for i in range(len(kept))),
                    pa.array(counts, pa.int64()),
                    pa.array(ids_sums, pa.string()),
                    pa.array(byte_sums, pa.string()),
                    pa.array(exact, pa.bool_()),
                ],
                names=[*kept, *added],
            )

    return source.mapInArrow(run, schema)

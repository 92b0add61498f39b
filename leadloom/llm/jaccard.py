"""N-gram Jaccard join: token-combination prefixes, verification, components.

A document's tokens are its distinct word shingles.  All tokens have one order, rare class
before frequent class and by hash within a class.  Of a document with ``n`` tokens, any
similar one misses ``n - ceil(threshold * n)`` at most, its *slack*.  Every document is
indexed by a prefix of its tokens that is ``extra`` tokens longer than its slack:

* where rare tokens suffice they are indexed alone, and two such documents share
  ``extra`` of them, so a document of which fewer are shared with anybody is out;
* where they do not, the prefix goes on into the frequent class: frequent tokens are dealt
  to subclasses, and combinations of two tokens of a subclass are indexed.  A subclass of
  which m tokens are in the prefix vouches for m - 1 tokens, and the prefix is extended
  until rare tokens and subclasses vouch for enough, or to the whole set.

The number of subclasses follows the power of two below the size; a document is indexed
for its own power and the next, since similar documents are at most one apart.  Which
tokens are frequent is a hint that changes cost, never results: it is the list of up to
``FREQUENT`` tokens that were counted most often, of those met ``LOCAL`` times or more among
neighbouring documents.

Equal sets are one class, represented by its smallest id.  Signatures of up to
``BUCKET`` classes give all their pairs as candidates.  The classes of larger ones are
gathered in clusters of shared large signatures, cut into blocks by size, and blocks are
compared by arrays: what leaves a block pair are the closest candidates of each class in
other components, a few at first.  Links are counted, components formed, and only block
pairs that held back candidates are compared again, each time giving sixteen times as many,
until none holds back any.  So a group of copies of any size costs rows in proportion, and
no pair in different components is left out.  Candidates must allow a link by their sizes
and by the parities of token buckets, at least four for each token; the overlap is then
counted exactly on the token codes (64 bits).

Defined results: a text of fewer words than a shingle is one token; null and empty texts
have none and are linked with nothing; rows with the same id are one document, linked as
any of its texts is (``n_shingles`` is that of the row's text); rows without an id are linked with nothing and have no component; an
empty table gives an empty table; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadloom.llm.common import WordCodes, column_or, in_batches, mixed, shingles
from leadloom.operators.components import components as connected
from leadloom.operators.ranking import with_position
from leadloom.session import cut_lineage

#: Links need ``SHARE`` hundredths of the union in common.
SHARE = 75
#: Bounds of the frequent class: tokens in all, and how often one must be met.
FREQUENT = 200_000
LOCAL = 4
OFTEN = 64
#: Least number of parities of a set; larger sets have the power of two from four times their size up.
PARITIES = 512
#: A document is indexed by one in so many of its tokens more than its slack.
EXTRA = 20
#: Signatures of more classes than this are compared by blocks, of so many classes each.
BUCKET = 16
BLOCK = 4096
#: Candidates of a class that a pair of blocks gives in the first round.
CLOSEST = 4


def needed(n: int, share: int = SHARE) -> int:
    """Tokens of ``n`` that any similar document has."""
    return -(-n * share // 100)


# ---------------------------------------------------------------- sets


def token_sets(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_shingles and digest of each row's set; every batch also reports tokens met often in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        codes = WordCodes()
        for batch in in_batches(batches, 2000):
            sets = [shingles(x, codes) for x in column_or(batch, text)]
            tokens, counts = np.unique(np.concatenate(sets), return_counts=True)
            often = np.nonzero(counts >= LOCAL)[0]
            often = often[np.argsort(-counts[often], kind="stable")][:FREQUENT]
            first = [[] for _ in sets]
            first[0] = [{"code": int(t), "met": int(c)} for t, c in zip(tokens[often].view(np.int64), counts[often], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array(first, pa.list_(pa.struct([("code", pa.int64()), ("met", pa.int32())]))),
                ],
                names=["doc_id", "n_shingles", "digest", "often"],
            )

    schema = "doc_id bigint, n_shingles bigint, digest binary, often array<struct<code: bigint, met: int>>"
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text).mapInArrow(run, schema)


def frequent_tokens(sets: DataFrame) -> np.ndarray:
    """Sorted codes of the frequent class: at most ``FREQUENT``."""
    rows = (
        sets.select(F.explode("often").alias("o"))
        .groupBy(F.col("o.code").alias("code"))
        .agg(F.sum("o.met").alias("met"))
        .filter(F.col("met") >= OFTEN)
        .orderBy(F.desc("met"), "code")
        .limit(FREQUENT)
        .select("code")
    )
    return np.sort(np.array([r["code"] for r in rows.collect()], np.int64).view(np.uint64))


# ---------------------------------------------------------------- signatures


def _is_in(tokens: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(tokens), bool)
    at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
    return known[at] == tokens


def subclasses(power: int) -> int:
    return max(1, (1 << power) // 8)


def combinations(frequent: np.ndarray, missing: int, power: int) -> np.ndarray:
    """Codes of the pairs in the shortest prefix of frequent tokens that vouches for ``missing``."""
    own = (mixed(frequent + np.uint64(power)) % np.uint64(subclasses(power))).astype(np.int64)
    order = np.argsort(own, kind="stable")
    later = np.empty(len(own), bool)  # not the first of its subclass in the prefix
    later[order] = np.concatenate(([False], own[order][1:] == own[order][:-1]))
    vouched = np.cumsum(later)
    size = int(np.searchsorted(vouched, missing)) + 1
    tokens, own = frequent[:size], own[:size]
    out = []
    for each in np.unique(own[later[:size]]):
        members = tokens[own == each]
        left, right = np.triu_indices(len(members), 1)
        out.append(mixed(members[left] * np.uint64(3) + mixed(members[right] + np.uint64(power))))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def extra(n: int) -> int:
    """Tokens by which the prefix of ``n`` tokens exceeds the slack."""
    return max(1, n // EXTRA)


def signatures(tokens: np.ndarray, known: np.ndarray, share: int = SHARE) -> tuple[np.ndarray, int]:
    """What a set is indexed by, and how much of it must be shared; ``tokens`` and ``known`` are sorted."""
    n = len(tokens)
    need = n - needed(n, share) + extra(n)
    often = _is_in(tokens, known)
    rare = tokens[~often]
    if len(rare) >= need:
        # The other document of a pair may have the shorter prefix, and then its extra counts.
        return rare[:need], extra(needed(n, share))
    power = n.bit_length() - 1
    parts = [combinations(tokens[often], need - len(rare), p) for p in (power, power + 1)]
    return np.unique(np.concatenate([rare, *parts])), 1


def parities(tokens: np.ndarray) -> bytes:
    """For each of a power of two of buckets, whether it holds an odd number of tokens."""
    buckets = PARITIES
    while buckets < 4 * len(tokens):
        buckets *= 2
    counts = np.bincount((mixed(tokens) & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def apart(one: bytes, other: bytes) -> int:
    """Tokens that two sets cannot share, at least: buckets whose parities differ."""
    x, y = np.frombuffer(one, np.uint64), np.frombuffer(other, np.uint64)
    if len(x) < len(y):
        x, y = y, x
    while len(x) > len(y):  # half the buckets: each is two of before
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def signed(docs: DataFrame, known: np.ndarray, share: int = SHARE, text: str = "text") -> DataFrame:
    """node, n, least (signatures that must be shared), parity and signatures of each non-empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = WordCodes()
        for batch in in_batches(batches, 1000):
            sets = [shingles(x, codes) for x in column_or(batch, text)]
            signs = [signatures(s, known, share) if len(s) else (s, 1) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int32()),
                    pa.array([least for _, least in signs], pa.int32()),
                    pa.array([parities(s) for s in sets], pa.binary()),
                    pa.array([own.view(np.int64) for own, _ in signs], pa.list_(pa.int64())),
                ],
                names=["node", "n", "least", "parity", "signatures"],
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("node"), text).mapInArrow(
        run, "node bigint, n int, least int, parity binary, signatures array<bigint>"
    )


def shared_rows(index: DataFrame) -> DataFrame:
    """signature and node, where they can tell that two documents are linked.

    Only signatures of several nodes count, and only nodes that share as many as they
    must.  Linked nodes share so many, so of each node's rows the most common ones can
    go, one fewer than it must share: an overlap that large cannot lie in them alone.
    """
    rows = index.select("node", "least", F.explode("signatures").alias("signature"))
    while True:
        several = rows.groupBy(F.col("signature").alias("key")).agg(F.count(F.lit(1)).alias("held")).filter(F.col("held") > 1)
        met = cut_lineage(rows.join(several, F.col("signature") == F.col("key")).select("node", "least", "signature", "held"))
        enough = (
            met.groupBy(F.col("node").alias("of"))
            .agg(F.count(F.lit(1)).alias("shared"), F.max("least").alias("must"))
            .filter(F.col("shared") >= F.col("must"))
            .select("of", "shared")
        )
        rows = cut_lineage(met.join(enough, F.col("node") == F.col("of")).drop("of"))
        # What was dropped may leave others with too little; stop when hardly anything changes.
        if rows.count() >= 0.9 * met.count():
            break
        rows = rows.select("node", "least", "signature")
    rarest = Window.partitionBy("node").orderBy("held", "signature")  # a node has no more rows than words
    return (
        rows.withColumn("rank", F.row_number().over(rarest))
        .filter(F.col("rank") <= F.col("shared") - F.col("least") + 1)
        .select("signature", "node")
    )


# ---------------------------------------------------------------- verification


def _sized(pairs: DataFrame, sizes: DataFrame, share: int) -> DataFrame:
    """Pairs whose sizes and parities allow a link."""
    n_a = sizes.select(F.col("node").alias("a"), F.col("n").alias("n_a"))
    n_b = sizes.select(F.col("node").alias("b"), F.col("n").alias("n_b"))
    alike = (F.col("n_a") * 100 >= F.col("n_b") * share) & (F.col("n_b") * 100 >= F.col("n_a") * share)
    near = cut_lineage(pairs.join(n_a, "a").join(n_b, "b").filter(alike).select("a", "b", "n_a", "n_b"))
    parity_a = sizes.select(F.col("node").alias("a"), F.col("parity").alias("parity_a"))
    parity_b = sizes.select(F.col("node").alias("b"), F.col("parity").alias("parity_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            differ = np.array([apart(x, y) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)], np.int64)
            total = np.asarray(batch.column(4), np.int64) + np.asarray(batch.column(5), np.int64)
            # 100 * both >= share * union, union = both + what is not shared, 2 * both = total - what is not shared.
            keep = differ * (100 + share) <= total * (100 - share)
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in batch.columns[:2]], names=["a", "b"])

    both = near.join(parity_a, "a").join(parity_b, "b").select("a", "b", "parity_a", "parity_b", "n_a", "n_b")
    return both.mapInArrow(run, "a bigint, b bigint")


def _token_table(docs: DataFrame, text: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = WordCodes()
        for batch in in_batches(batches, 1000):
            sets = [shingles(x, codes).tobytes() for x in column_or(batch, text)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["node", "tokens"])

    return docs.select(F.col("doc_id").cast("bigint").alias("node"), text).mapInArrow(run, "node bigint, tokens binary")


def verified(pairs: DataFrame, docs: DataFrame, share: int, text: str = "text") -> DataFrame:
    """The pairs (a, b) that share enough tokens."""
    pairs = cut_lineage(pairs)
    nodes = cut_lineage(pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct())
    tokens = cut_lineage(_token_table(docs.join(nodes, F.col("doc_id") == F.col("id"), "left_semi"), text))
    both = pairs.join(tokens.select(F.col("node").alias("a"), F.col("tokens").alias("tokens_a")), "a").join(
        tokens.select(F.col("node").alias("b"), F.col("tokens").alias("tokens_b")), "b"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_batches(batches, 500):
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                own, other = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                shared = int(_is_in(own, other).sum())
                keep.append(100 * shared >= share * (len(own) + len(other) - shared))
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in batch.columns[:2]], names=["a", "b"])

    return both.select("a", "b", "tokens_a", "tokens_b").mapInArrow(run, "a bigint, b bigint").distinct()


# ---------------------------------------------------------------- candidates


def bucket_pairs(members: DataFrame) -> DataFrame:
    """All pairs of the signatures that no more than ``BUCKET`` nodes share."""
    few = _held(members).filter(F.col("held").between(2, BUCKET)).select("key")
    rows = members.join(few, F.col("signature") == F.col("key")).select("signature", F.col("node").alias("a"))
    other = rows.select(F.col("signature").alias("same"), F.col("a").alias("b"))
    return rows.join(other, (F.col("signature") == F.col("same")) & (F.col("a") < F.col("b"))).select("a", "b").distinct()


def _held(members: DataFrame) -> DataFrame:
    return members.groupBy(F.col("signature").alias("key")).agg(F.count(F.lit(1)).alias("held"), F.min("node").alias("first"))


def blocks(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """cluster, block, node, n and parity of the nodes of larger signatures."""
    many = _held(members).filter(F.col("held") > BUCKET).select("key", "first")
    linked_nodes = members.join(many, F.col("signature") == F.col("key")).select(F.col("node").alias("a"), F.col("first").alias("b"))
    clusters = connected(linked_nodes).select(F.col("node").alias("of"), F.col("root").alias("cluster"))
    named = sizes.join(clusters, F.col("node") == F.col("of")).select("cluster", "node", "n", "parity")
    placed = with_position(named, [F.col("n").asc(), F.col("node").asc()], "place", within=["cluster"])
    return cut_lineage(placed.select("cluster", F.floor((F.col("place") - 1) / BLOCK).alias("block"), "node", "n", "parity"))


def block_pairs(blocked: DataFrame, share: int) -> DataFrame:
    """cluster, i and j of blocks whose sizes allow links."""
    spans = blocked.groupBy("cluster", "block").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    later = spans.select(F.col("cluster").alias("same"), F.col("block").alias("j"), F.col("least").alias("from"))
    return spans.join(
        later, (F.col("cluster") == F.col("same")) & (F.col("block") <= F.col("j")) & (F.col("most") * 100 >= F.col("from") * share)
    ).select("cluster", F.col("block").alias("i"), "j")


def _matrix(parities_of: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(parities_of), np.uint64).reshape(len(parities_of), -1)


def _folded(rows: np.ndarray, words: int) -> np.ndarray:
    while rows.shape[1] > words:
        rows = rows[:, : rows.shape[1] // 2] ^ rows[:, rows.shape[1] // 2 :]
    return rows


def closest(own: pd.DataFrame, other: pd.DataFrame | None, share: int, most: int) -> tuple[list[tuple[int, int]], bool]:
    """Candidates (a, b) in different components, up to ``most`` for each row of ``own``, and whether some were held back."""
    found: list[tuple[int, int]] = []
    held_back = False
    against = own if other is None else other
    for width in sorted(own["parity"].map(len).unique()):
        rows = own[own["parity"].map(len) == width]
        for wide in sorted(against["parity"].map(len).unique()):
            if other is None and wide < width:
                continue  # the other way round
            columns = against[against["parity"].map(len) == wide]
            words = min(width, wide) // 8
            x, y = _folded(_matrix(rows["parity"].tolist()), words), _folded(_matrix(columns["parity"].tolist()), words)
            n, m = rows["n"].to_numpy(np.int64), columns["n"].to_numpy(np.int64)
            step = max(1, (1 << 21) // max(1, len(y) * words))
            for first in range(0, len(x), step):
                part = slice(first, first + step)
                differ = np.bitwise_count(x[part, None, :] ^ y[None, :, :]).sum(axis=2, dtype=np.int64)
                big, small = np.maximum(n[part, None], m[None, :]), np.minimum(n[part, None], m[None, :])
                fits = (differ * (100 + share) <= (big + small) * (100 - share)) & (small * 100 >= big * share)
                fits &= rows["root"].to_numpy()[part, None] != columns["root"].to_numpy()[None, :]
                if other is None and width == wide:
                    fits &= rows["node"].to_numpy()[part, None] < columns["node"].to_numpy()[None, :]
                if (fits.sum(axis=1) > most).any():
                    held_back = True
                    differ = np.where(fits, differ, 1 << 40)
                    near = np.argpartition(differ, min(most, differ.shape[1] - 1), axis=1)[:, :most]
                    kept = np.zeros_like(fits)
                    np.put_along_axis(kept, near, True, axis=1)
                    fits &= kept
                i, j = np.nonzero(fits)
                found += zip(rows["node"].to_numpy()[part][i].tolist(), columns["node"].to_numpy()[j].tolist(), strict=True)
    return found, held_back


def compared(blocked: DataFrame, roots: DataFrame | None, pairs: DataFrame, share: int, most: int) -> DataFrame:
    """a, b of candidates within ``pairs`` of blocks; a row without a and b names a pair that held back some."""
    if roots is None:
        named = blocked.withColumn("root", F.col("node"))
    else:
        named = blocked.join(roots.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left").withColumn(
            "root", F.coalesce("root", "node")
        )
    rows = named.select(F.col("cluster").alias("in_cluster"), "block", "node", "n", "parity", "root")
    inside = F.col("cluster") == F.col("in_cluster")
    columns = ["cluster", "i", "j", "side", "node", "n", "parity", "root"]
    left = pairs.join(rows, inside & (F.col("i") == F.col("block"))).withColumn("side", F.lit(0))
    right = pairs.filter(F.col("i") < F.col("j")).join(rows, inside & (F.col("j") == F.col("block"))).withColumn("side", F.lit(1))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        first = group.iloc[0]
        own, other = group[group["side"] == 0], group[group["side"] == 1]
        found, held_back = closest(own, None if first["i"] == first["j"] else other, share, most)
        out = pd.DataFrame(
            {"a": [min(p) for p in found] + [None] * held_back, "b": [max(p) for p in found] + [None] * held_back}, dtype="Int64"
        )
        return out.assign(cluster=first["cluster"], i=first["i"], j=first["j"])

    return (
        left.select(columns)
        .union(right.select(columns))
        .groupBy("cluster", "i", "j")
        .applyInPandas(run, "a bigint, b bigint, cluster bigint, i bigint, j bigint")
    )


def linked(docs: DataFrame, copies: DataFrame, known: np.ndarray, share: int = SHARE, text: str = "text") -> DataFrame:
    """node and root of every class that is linked with another; ``copies`` (doc_id) play no part."""
    # Every id has one set here, so one row of a class stands for it.
    classes = docs.join(copies, "doc_id", "left_anti").filter(F.col("doc_id").isNotNull())
    index = cut_lineage(signed(classes, known, share, text))
    members = cut_lineage(shared_rows(index))
    sizes = index.select("node", "n", "parity")
    blocked = blocks(members, sizes)
    pairs = cut_lineage(block_pairs(blocked, share))
    most = CLOSEST
    met = cut_lineage(compared(blocked, None, pairs, share, most))
    candidates = _sized(bucket_pairs(members), sizes, share).union(met.filter(F.col("a").isNotNull()).select("a", "b")).distinct()
    links = cut_lineage(verified(candidates, classes, share, text))
    while True:
        roots = cut_lineage(connected(links))
        pairs = cut_lineage(met.filter(F.col("a").isNull()).select("cluster", "i", "j"))
        if pairs.isEmpty():
            return roots
        most *= 16
        met = cut_lineage(compared(blocked, roots, pairs, share, most))
        more = verified(met.filter(F.col("a").isNotNull()).select("a", "b").distinct(), classes, share, text)
        links = cut_lineage(links.union(more))


def components(docs: DataFrame, share: int = SHARE, text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles and component_id, the smallest id reachable by links."""
    sets = cut_lineage(token_sets(docs, text))
    split = cut_lineage(split_ids(sets))
    if split.isEmpty():
        return _components(docs, sets, share, text)
    # Each text of such an id is a document of its own, numbered behind all ids, until links are known.
    top = sets.agg(F.max("doc_id")).first()[0]
    several = docs.select(F.col("doc_id").cast("bigint").alias("real"), text).join(split, F.col("real") == F.col("id"), "left_semi")
    apart_rows = several.groupBy("real", text).agg(F.count(F.lit(1)).alias("rows"))
    numbered = cut_lineage(
        with_position(apart_rows, [F.col("real").asc(), F.xxhash64(text).asc()], "at").withColumn("doc_id", F.col("at") + top).drop("at")
    )
    whole = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text).join(split, F.col("doc_id") == F.col("id"), "left_anti")
    own = token_sets(numbered.select("doc_id", text), text)
    both = cut_lineage(sets.join(split, F.col("doc_id") == F.col("id"), "left_anti").unionByName(own))
    found = cut_lineage(_components(whole.unionByName(numbered.select("doc_id", text)), both, share, text))
    return _rejoined(found, numbered.select(F.col("doc_id").alias("node"), "real", "rows"), top)


def split_ids(sets: DataFrame) -> DataFrame:
    """Ids that have several different sets."""
    filled = sets.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)).groupBy(F.col("doc_id").alias("id"))
    return filled.agg(F.min("digest").alias("one"), F.max("digest").alias("other")).filter(F.col("one") != F.col("other")).select("id")


def _rejoined(found: DataFrame, numbered: DataFrame, top: int) -> DataFrame:
    """Components of texts to components of ids: the texts of an id are linked with each other."""
    members = found.join(numbered, F.col("doc_id") == F.col("node")).select("real", F.col("component_id").alias("of"))
    firsts = members.groupBy(F.col("real").alias("id")).agg(F.min("of").alias("b"))
    meeting = members.join(firsts, F.col("real") == F.col("id")).select(F.col("of").alias("a"), "b").distinct()
    groups = connected(meeting).select(F.col("node").alias("member"), "root")
    ids = members.select("of", F.col("real").alias("least")).union(
        members.filter(F.col("of") <= top).select("of", F.col("of").alias("least"))
    )
    group = F.coalesce("root", "of")
    in_group = ids.join(groups, F.col("of") == F.col("member"), "left").withColumn("group", group)
    least = in_group.groupBy(F.col("group").alias("g")).agg(F.min("least").alias("least_id"))
    names = cut_lineage(in_group.join(least, F.col("group") == F.col("g")).select(F.col("of").alias("was"), "least_id").distinct())
    rows = found.join(numbered, F.col("doc_id") == F.col("node"), "left").join(names, F.col("component_id") == F.col("was"), "left")
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.coalesce("rows", F.lit(1)).cast("bigint")))
    return rows.select(
        F.coalesce("real", "doc_id").alias("doc_id"), "n_shingles", F.coalesce("least_id", "component_id").alias("component_id"), copies.alias("_copy")
    ).drop("_copy")


def _components(docs: DataFrame, sets: DataFrame, share: int, text: str) -> DataFrame:
    """``components`` where every id has one set."""
    known = frequent_tokens(sets)
    filled = sets.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    least = filled.groupBy(F.col("digest").alias("of_set")).agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("held"))
    again = cut_lineage(least.filter(F.col("held") > 1).select("of_set", "first"))
    copies = cut_lineage(
        filled.join(again, F.col("digest") == F.col("of_set")).filter(F.col("doc_id") != F.col("first")).select("doc_id", "first").distinct()
    )
    roots = linked(docs, copies.select("doc_id").distinct(), known, share, text)
    firsts = copies.groupBy(F.col("doc_id").alias("copy")).agg(F.min("first").alias("first"))
    rows = sets.select("doc_id", "n_shingles").join(firsts, F.col("doc_id") == F.col("copy"), "left")
    node = F.coalesce("first", "doc_id")
    return (
        rows.withColumn("node_of", node)
        .join(roots, F.col("node_of") == F.col("node"), "left")
        .select("doc_id", "n_shingles", F.coalesce("root", "node_of").alias("component_id"))
    )

"""Each operator against a plain version, and on odd rows: nulls, empty, long, tied and repeated ones."""

import collections
import hashlib
import random
import re
import subprocess
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F

from leadloom.llm import bpe, chat, contamination, crossparse, edits, hamming, jaccard, kdtree, pii, quality
from leadloom.llm.queries import ORACLES, QUERIES, ranks
from oracles.compare import connect, difference
from tests.conftest import FOLDER
from tests.llm.conftest import words

PATTERN = public_tokenizers.PATTERN
CHECK_WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_the_sql(spark, name):
    assert difference(spark, connect(FOLDER), QUERIES[name], ORACLES[name], FOLDER) is None


# ---------------------------------------------------------------- op1


def test_search_equals_brute_force(spark):
    draw = random.Random(5)
    centre = draw.getrandbits(64)
    codes = [centre ^ (1 << draw.randrange(64)) ^ (1 << draw.randrange(64)) for _ in range(60)]
    codes += [draw.getrandbits(64) for _ in range(140)] + [centre] * 100
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    rows = spark.createDataFrame([*enumerate(signed), (None, 5), (900, None)], "id bigint, code bigint")
    got = {tuple(r) for r in hamming.search(rows, rows.filter("id % 7 = 0"), k=5).select("query_id", "neighbour_id", "distance", "rank").collect()}
    want = set()
    for q in range(0, len(codes), 7):
        best = sorted((bin(codes[q] ^ c).count("1"), i) for i, c in enumerate(codes))[:5]
        want |= {(q, i, d, n + 1) for n, (d, i) in enumerate(best)}
    assert got == want
    assert hamming.search(rows.filter("false"), rows, 3).count() == 0


def test_repeated_rows_take_one_place(spark):
    rows = spark.createDataFrame([(1, 0)] * 6 + [(2, 0), (3, 1), (3, 1), (4, 3)], "id bigint, code bigint")
    got = [tuple(r) for r in hamming.search(rows, rows.filter("id = 1"), k=3).select("neighbour_id", "distance", "rank").collect()]
    assert sorted(got) == [(1, 0, 1), (2, 0, 2), (3, 1, 3)]


def test_codes_of_any_length(spark, monkeypatch):
    draw = random.Random(8)
    centre = [draw.choice((-1.0, 1.0)) for _ in range(200)]
    vectors = [[-x if draw.random() < 0.03 else x for x in centre][: draw.choice((200, 200, 130))] for _ in range(150)]
    vectors += [[draw.choice((-1.0, 0.0, 1.0)) for _ in range(200)] for _ in range(60)] + [[], [None, 1.0], [1.0] * 64, [-1.0] * 65]
    rows = spark.createDataFrame([*enumerate(vectors), (None, [1.0]), (900, None)], "id bigint, vector array<double>")
    codes = rows.select("id", hamming.sign_code(F.col("vector")).alias("code"))
    signs = [{i for i, x in enumerate(v) if x is not None and x > 0} for v in vectors]
    asked = [*range(0, 210, 13), 210, 211, 212, 213]
    want = set()
    for q in asked:
        best = sorted((len(signs[q] ^ c), i) for i, c in enumerate(signs))[:6]
        want |= {(q, i, d, n + 1) for n, (d, i) in enumerate(best)}
    for block, group in ((hamming.BLOCK_CODES, hamming.GROUP_QUERIES), (40, 5)):
        monkeypatch.setattr(hamming, "BLOCK_CODES", block)
        monkeypatch.setattr(hamming, "GROUP_QUERIES", group)
        got = hamming.search(codes, codes.filter(F.col("id").isin(asked)), k=6)
        assert {tuple(r) for r in got.select("query_id", "neighbour_id", "distance", "rank").collect()} == want


# ---------------------------------------------------------------- op2


def check_shards(rows, docs, shards):
    rows = [r.asDict() for r in rows.collect()]
    assert len(rows) == len(docs)
    want = collections.Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs)
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    slots = collections.defaultdict(list)
    sizes = collections.Counter()
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(shards))
    return sizes


def test_shards_are_near_equal(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    plain = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    sizes = check_shards(kdtree.shard(docs, shards=8), plain, 8)
    longest = max(len((t or "").encode()) for _, t in plain)
    assert max(sizes.values()) - min(sizes.values()) <= longest
    by_bytes = kdtree.shard(docs, target_bytes=500_000)
    assert by_bytes.select("shard").distinct().count() == -(-sum(sizes.values()) // 500_000)
    first = {tuple(r) for r in kdtree.shard(docs.repartition(7), shards=8).collect()}
    assert first == {tuple(r) for r in kdtree.shard(docs, shards=8).collect()}


def plain_shards(rows, count, whole, first=0):
    """Shard of each row (values, size); rows are cut at the weighted median of their widest dimension, ties by the last."""
    if count == 1 or not rows:
        return dict.fromkeys(rows, first)
    spread = [(max(r[0][i] for r in rows) - min(r[0][i] for r in rows)) / max(1, whole[i]) for i in range(4)]
    axis = max(range(4), key=lambda i: (spread[i], -i))
    order = sorted(rows, key=lambda r: (r[0][axis], r[0][3]))
    target = -(-sum(r[1] for r in rows) * (count // 2) // count)
    below = 0
    for place, row in enumerate(order):
        if below + row[1] >= target:
            break
        below += row[1]
    cut = place + (2 * (target - below) >= row[1])
    return plain_shards(order[:cut], count // 2, whole, first) | plain_shards(order[cut:], count - count // 2, whole, first + count // 2)


@pytest.mark.parametrize("shards", [2, 7])
def test_splits_equal_plain_weighted_medians(spark, shards):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [
        ((zlib.crc32(r["source"].encode()) if r["source"] else -1, zlib.crc32(r["lang"].encode()) if r["lang"] else -1, r["n_chars"], r["doc_id"]), len((r["text"] or "").encode()) + 1)
        for r in docs.collect()
    ]
    whole = [max(r[0][i] for r in rows) - min(r[0][i] for r in rows) for i in range(4)]
    want = {values[3]: shard for (values, _), shard in plain_shards(rows, shards, whole).items()}
    assert {r["doc_id"]: r["shard"] for r in kdtree.shard(docs, shards=shards).collect()} == want


def test_plan_does_not_grow_with_the_tree(spark, monkeypatch):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(200)
    monkeypatch.setattr(kdtree, "SLOT_ROWS", 5)
    plain = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    joins = []
    for shards in (2, 16):
        rows = kdtree.shard(docs, shards=shards)
        joins.append(rows._jdf.queryExecution().optimizedPlan().toString().count("Join"))
        check_shards(rows, plain, shards)
    assert joins[0] == joins[1]


def test_shards_of_odd_rows(odd_docs, no_docs):
    plain = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    check_shards(kdtree.shard(odd_docs, shards=3), plain, 3)
    assert kdtree.shard(no_docs, shards=8).count() == 0


# ---------------------------------------------------------------- op3


def test_contamination_of_odd_rows(spark, odd_docs, no_docs):
    items = [(0, None), (1, ""), (2, "Four WORDS are few"), (3, words(1, 30_000)[5_000:5_300]), (3, None), (None, "word"), (5, "word")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]) for r in contamination.contained(odd_docs, bench).collect()}
    assert got == {(4, 2), (5, 3), (6, 3), (3, 5)}
    assert contamination.contained(no_docs, bench).count() == 0
    assert contamination.contained(odd_docs, bench.filter("false")).count() == 0


def grams(text, width):
    w = CHECK_WORDS.findall((text or "").lower())
    return {(width, *w[i : i + width]) for i in range(len(w) - width + 1)}


def test_contamination_equals_brute_force(spark):
    """Items of one word to hundreds, inside documents of any length, whole, broken, scattered, repeated."""
    draw = random.Random(17)
    items = [(i, words(500 + i, draw.choice((1, 2, 3, 4, 5, 6, 9, 30, 200)))) for i in range(60)] + [(7, "another text"), (8, None), (None, "ban")]
    docs = []
    for i in range(150):
        own = words(i, draw.choice((3, 8, 60, 500))).split()
        for _ in range(draw.randrange(4)):
            item = (draw.choice(items)[1] or "").split()
            for _ in range(draw.randrange(3)):
                item[draw.randrange(len(item)) if item else 0 : 0] = ["x"] * draw.randrange(2)
            at, cut = draw.randrange(len(own)), draw.randrange(len(item) + 1)
            own[at:at] = item[cut:]
            own = own + item[:cut] if draw.random() < 0.3 else item[:cut] + own
        docs.append((draw.randrange(140), " ".join(own)))
    wanted = collections.defaultdict(set)
    for i, t in items:
        if i is not None and CHECK_WORDS.findall(t or ""):
            wanted[i] |= grams(t, min(5, len(CHECK_WORDS.findall(t))))
    held = collections.defaultdict(set)
    for i, t in docs:
        held[i] |= set().union(*[grams(t, width) for width in range(1, 6)])
    want = {(d, i, len(w), len(w & own)) for d, own in held.items() for i, w in wanted.items() if 100 * len(w & own) >= 75 * len(w)}
    got = contamination.contained(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    assert {tuple(r) for r in got.drop("containment").collect()} == want
    assert {len(wanted[i]) for _, i, _, _ in want} > {1, 26}


def test_partitions_keep_most_hashes_of_documents_at_home(spark):
    items = spark.createDataFrame([(i, words(i, 300)) for i in range(20)], "item_id bigint, text string")
    docs = spark.createDataFrame([(i, words(100 + i, 100 if i else 5_000)) for i in range(30)], "doc_id bigint, text string")
    parts = contamination.partitions(contamination.sketches(contamination.item_shingles(items)))
    met = contamination.probes(contamination._words_of(docs, "doc_id", "text"), parts)
    # Short documents fit no partition; the long one sends about a quarter of its hashes.
    assert {r["doc"] for r in met.collect()} == {0} and 0.2 * 4_996 < met.count() < 0.4 * 4_996


# ---------------------------------------------------------------- op4


def test_tree_counts_like_a_new_encoding():
    counts, pattern = edits.TokenCounts(ranks(), PATTERN), regex.compile(PATTERN)
    draw = random.Random(11)
    pieces = ["a", "b", " ", "  ", "\n", "'", "s", "'ll", "1", "é", ".", "!", " x", "\t", "words and more "]
    for _ in range(4000):
        text = "".join(draw.choice(pieces) for _ in range(draw.randint(0, 30)))
        tree = edits.Tree.of(text, counts, pattern)
        for _ in range(draw.randint(1, 5)):
            start = draw.randint(-1, len(text) + 2)
            stop, insert = start + draw.randint(-1, 8), "".join(draw.choice(pieces) for _ in range(draw.randint(0, 5)))
            tree.edit(start, stop, insert)
            start = min(max(start, 0), len(text))
            text = text[:start] + insert + text[min(max(stop, start), len(text)) :]
            assert tree.text() == text
            assert (tree.total, tree.length) == (len(counts.encoding.encode_ordinary(text)), len(text))


def test_many_edits_at_one_place_stay_cheap():
    counts, pattern = edits.TokenCounts(ranks(), PATTERN), regex.compile(PATTERN)
    for where in ("end", "middle", "start"):
        text = "some words in a row and " * 40
        tree = edits.Tree.of(text, counts, pattern)
        most = 0
        for k in range(2_000):
            at = {"end": len(text), "middle": len(text) // 2, "start": 0}[where]
            insert, done = f" and {k} new words", tree.reencoded
            tree.edit(at, at, insert)
            text = text[:at] + insert + text[at:]
            most = max(most, tree.reencoded - done)
        assert most < 80
        assert tree.text() == text and tree.total == len(counts.encoding.encode_ordinary(text))
        assert tree.pieces() == pattern.findall(text) and max(map(len, tree.blocks)) <= 2 * tree.BLOCK
        for k in range(1_000):
            at = (k * 7_919) % len(text)
            tree.edit(at, at + 20, "")
            text = text[:at] + text[at + 20 :]
        assert tree.pieces() == pattern.findall(text) and tree.total == len(counts.encoding.encode_ordinary(text))
        assert all(tree.blocks)
        tree.edit(0, len(text), "")
        assert (tree.total, tree.length, tree.pieces()) == (0, 0, [])
        tree.edit(0, 0, "back again")
        assert tree.text() == "back again"


def test_edited_counts_of_odd_rows(odd_docs, no_docs):
    def changed(docs):
        return docs.withColumn("edits", F.when(F.col("doc_id") != 7, edits.sample_edits(F.col("doc_id"), F.col("text"))))

    enc = bpe.encoding(ranks(), PATTERN)
    rows = edits.count(changed(odd_docs), ranks(), PATTERN, keep_text=True).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert r["tokens_after"] == len(enc.encode_ordinary(r["edited"]))
        assert r["chars_after"] == len(r["edited"])
    long = next(r for r in rows if r["doc_id"] == 5)
    assert long["chars_encoded"] < 500 < long["chars_after"]
    assert edits.count(changed(no_docs), ranks(), PATTERN).count() == 0
    built = edits.build(changed(odd_docs), ranks(), PATTERN)
    again = edits.apply(built, ranks(), PATTERN).select("doc_id", "n_tokens").collect()
    assert sorted((r[0] or -1, r[1]) for r in again) == sorted((r["doc_id"] or -1, r["tokens_after"]) for r in rows)


# ---------------------------------------------------------------- op5

RULES = [
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda s: True),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda s: all(int(p) <= 255 for p in s.split("."))),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda s: 13 <= sum(c.isdigit() for c in s) <= 19 and pii.passes_luhn(re.sub("[^0-9]", "", s))),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda s: 9 <= sum(c.isdigit() for c in s) <= 15),
]


def plain_spans(text):
    return [(kind, *m.span()) for kind, pattern, holds in RULES for m in pattern.finditer(text) if holds(m.group())]


def test_base_spans_equal_the_patterns():
    draw = random.Random(7)
    for _ in range(30_000):
        text = "".join(draw.choice("0123456789.. --()+@a%b") for _ in range(draw.randint(0, 40)))
        assert pii.base_spans(text) == plain_spans(text)
    assert not pii.passes_luhn("4845168114407328") and pii.passes_luhn("4845168114407329")


def test_long_runs_take_time_in_proportion():
    for run in ("1" * 200_000, "a" * 200_000, "1." * 100_000, "@" * 100_000, "+1" + " " * 200_000, "1 " * 100_000):
        pii.base_spans(run)


def test_personal_data(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    field = pii.fit(docs)
    rows = pii.find(docs.withColumn("own", F.col("text")), field).collect()
    marked = added = 0
    for r in rows:
        base = plain_spans(r["own"] or "")
        every = [tuple(s.split(":")) for s in r["spans"].split(",") if s]
        assert {(k, str(a), str(b)) for k, a, b in base} <= set(every)
        assert r["base_sha256"] == hashlib.sha256(pii.written(base).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.BASE_KINDS] == [sum(s[0] == k for s in base) for k in pii.BASE_KINDS]
        added += r["n_added"]
        marked += bool(every)
        if not re.search("[0-9@+]", r["own"] or ""):
            assert not every and r["redacted"] == r["own"]
        for value in re.findall(r'token = "([0-9a-f]{40})"', r["own"] or ""):
            assert value not in r["redacted"]
    assert 0 < marked < 0.2 * len(rows) and added
    odd = {r["doc_id"]: r for r in pii.find(odd_docs, field).collect()}
    assert odd[0]["redacted"] is None and odd[1]["redacted"] == ""
    assert odd[14]["redacted"] == "mail <EMAIL> or <PHONE>, <CARD> and <IP>."
    assert pii.find(no_docs, field).count() == 0 and pii.fit(no_docs) is None
    assert pii.find(odd_docs, None).count() == odd_docs.count()


def test_copies_and_order_leave_the_field_its_kinds(spark):
    secrets = [hashlib.sha1(bytes([i])).hexdigest() for i in range(12)]
    rows = [(k, f"{i} items were sold") for i in range(40) for k in range(300)]
    rows += [(0, f'in the code token = "{s}" is set') for s in secrets]
    rows.append((0, "1 2 3 4 5 6 7 8 9 " * 1_500 + f'token = "{secrets[0]}" behind a long island'))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    field = pii.fit(docs)
    assert field is not None
    odd = docs.filter("text like '%token%' and length(text) < 100")
    assert all(r["spans"].startswith("secret:") for r in pii.find(odd, field, redact=False).collect())
    once = pii.fit(docs.dropDuplicates(["text"]))
    assert once.index == field.index and np.array_equal(once.weights, field.weights)


FIELD_TEXTS = ["12.5 ", "a", "1", "9", " ", "@", "+4", ".", "-", "é", "\u0663", "\n", '"', "=", "token ", "4845 1681 1440 7329", "10.0.0.1", "300.1.2.3", "0f" * 20]


def any_field(draw):
    """A field with all features of some texts and weights without meaning."""
    texts = ["".join(draw.choice(FIELD_TEXTS) for _ in range(20)) for _ in range(30)]
    names = sorted({n for t in texts for each in pii.lattice(t).names for n in each})
    numbers = np.random.default_rng(draw.randrange(1_000))
    return pii.Field({n: i for i, n in enumerate(names)}, numbers.normal(size=(len(names) + 1, 6)), numbers.normal(size=(6, 6)))


def every_path(grid, scores, end):
    """All ways through the island as ((segment, label), ...)."""
    if end == 0:
        yield ()
        return
    for k in np.nonzero(grid.stop == end)[0]:
        for label in np.nonzero(np.isfinite(scores[k]))[0]:
            for path in every_path(grid, scores, end - int(grid.size[k])):
                yield (*path, (int(k), int(label)))


def path_score(field, scores, path):
    total, before = 0.0, 0
    for k, label in path:
        total += field.transitions[before, label] + scores[k, label]
        before = label
    return total


def test_scores_of_segments_equal_the_lattice():
    draw = random.Random(3)
    field = any_field(draw)
    texts = ["".join(draw.choice(FIELD_TEXTS) for _ in range(draw.randint(1, 25))) for _ in range(150)]
    for text in texts:
        grid = pii.lattice(text)
        slow, fast = field.scores(grid), field.window_scores(list(pii._atoms(text)))
        for k, (stop, size) in enumerate(zip(grid.stop, grid.size, strict=True)):
            assert np.allclose(slow[k], fast[stop - 1, size - 1])
        assert np.isfinite(fast).any(axis=2).sum() == np.isfinite(slow).any(axis=1).sum()
    once = [field.decode(t) for t in texts]
    for window in (pii.MAX_ATOMS, 100):
        whole, pii.WINDOW = pii.WINDOW, window
        try:
            assert list(field.decode_all(texts)) == once
        finally:
            pii.WINDOW = whole


@pytest.mark.parametrize("text", ["+4 1.2", "a@b.c", 'x="0f', "1 2 3", "7", "no", "1-2 @"])
def test_field_equals_enumeration(text):
    field = any_field(random.Random(len(text)))
    grid = pii.lattice(text)
    scores = field.scores(grid)
    paths = list(every_path(grid, scores, len(grid.bounds)))
    best = max(paths, key=lambda p: path_score(field, scores, p))
    ends = {k: (grid.bounds[int(grid.stop[k] - grid.size[k])][0], grid.bounds[int(grid.stop[k]) - 1][1]) for k in range(len(grid.stop))}
    assert field.decode(text) == [(pii.LABELS[label], *ends[k]) for k, label in best if label]
    # The gradient: what the labelled path holds less what all paths hold on average.
    own = [[field.index[n] for n in names if n in field.index] for names in grid.names]
    ids = [np.array([*o, len(field.index)], np.int64) if names else None for o, names in zip(own, grid.names, strict=True)]
    raw = np.full_like(scores, -np.inf)
    for k, rows in enumerate(ids):
        if rows is not None:
            raw[k] = field.weights[rows].sum(axis=0)
    raw[:, 0] = np.where(grid.size == 1, 0.0, -np.inf)
    chance = np.exp([path_score(field, raw, p) for p in paths])
    chance /= chance.sum()
    truth = paths[len(paths) // 2]
    want_w, want_t = np.zeros_like(field.weights), np.zeros_like(field.transitions)
    for path, share in [(truth, 1.0), *zip(paths, -chance, strict=True)]:
        before = 0
        for k, label in path:
            if ids[k] is not None:
                want_w[ids[k], label] += share
            want_t[before, label] += share
            before = label
    got_w, got_t = np.zeros_like(want_w), np.zeros_like(want_t)
    pii._gradient(field, grid, ids, list(truth), got_w, got_t)
    assert np.allclose(got_w, want_w) and np.allclose(got_t, want_t)


def test_secrets_unlike_those_of_the_sample_are_found(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    field = pii.fit(docs)
    draw = random.Random(1)
    texts = [r["text"] for r in docs.filter("text is not null").orderBy("doc_id").limit(200).collect()]
    plain = [w for t in texts for w in t.split()[:50] if not re.search("[0-9@+]", w)]

    def found(before, alphabet, size, after):
        hits = others = 0
        for _ in range(200):
            secret = "".join(draw.choice(alphabet) for _ in range(size))
            head = " ".join(draw.choice(plain) for _ in range(12)) + " " + before
            spans = pii.all_spans(f"{head}{secret}{after} " + " ".join(draw.choice(plain) for _ in range(12)), field)[1]
            hits += ("secret", len(head), len(head) + size) in spans
            others += len(spans) - (("secret", len(head), len(head) + size) in spans)
        return hits / 200, others

    low, mixed = "0123456789abcdef", "0123456789abcdefABCDEF"
    for case in (('token = "', low, 40, '"'), ('token = "', mixed, 40, '"'), ('token = "', low, 32, '"')):
        share, others = found(*case)
        assert share >= 0.9 and others <= 2, case  # a few have other bounds
    # The sample has no secret without quotes: about half are found (README), and nothing else is.
    share, others = found("token = ", low, 40, "")
    assert share > 0.3 and others <= 2
    for number in (4, 6, 9, 10, 12):
        assert found("costs ", "123456789", number, " pounds") == (0.0, 0)


def test_long_islands_need_little_memory():
    code = """
import resource
from leadloom.llm import pii
texts = [f'mail a{i}@b.com or 10.0.0.{i} and token = "{i:040x}" set' for i in range(40)]
field = pii.train([e for t in texts for e in pii.labelled_islands(t)])
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
assert pii.all_spans("12.5 " * 60_000, field)[0] == []
assert len(pii.all_spans(" ".join(f"a{i}@b.com" for i in range(40_000)), field)[0]) == 40_000
assert sum(len(s) for _, s in pii.labelled_islands("12.5 " * 60_000 + "10.0.0.1 " * 40_000)) == 40_000
assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 200_000
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=300)


def test_long_islands_are_trained_on_in_parts():
    text = "1 2 3 4 " * 200 + "5555 " * 3 + "4845 1681 1440 7329 and so on 10.0.0.1 " + "9" * 400 + " 10.0.0.2"
    parts = list(pii.labelled_islands(text))
    assert all(len(t) <= 300 for t, _ in parts) and sum(len(t) for t, _ in parts) >= len(text) - 410
    assert {t[a:b] for t, spans in parts for _, a, b in spans} >= {"10.0.0.1", "10.0.0.2"}


# ---------------------------------------------------------------- op6


def test_round_trip(odd_docs, no_docs):
    enc = bpe.encoding(ranks(), PATTERN)
    split = regex.compile(PATTERN)
    plain = collections.Counter()
    for r in odd_docs.collect():
        ids = [i for piece in split.findall(r["text"] or "") for i in enc.encode_ordinary(piece)]
        text = (r["text"] or "").encode()
        plain[r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text).hexdigest()] += 1
    rows = bpe.round_trip(odd_docs, ranks(), PATTERN).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "exact").collect()
    assert collections.Counter(tuple(r)[:4] for r in rows) == plain
    assert all(r["exact"] for r in rows)
    assert bpe.round_trip(no_docs, ranks(), PATTERN).count() == 0
    both = bpe.decode(bpe.encode(odd_docs, ranks(), PATTERN), ranks(), PATTERN).collect()
    assert all(bytes(r["decoded"]) == (r["text"] or "").encode() and r["exact"] for r in both)


def test_pieces_are_cut_safely():
    enc = bpe.encoding(ranks(), PATTERN)
    draw = random.Random(2)
    for _ in range(500):
        text = "".join(draw.choice(["ab", "'s", " ", "  ", "\n", "1", "é", "!", "x "]) for _ in range(200))
        parts = list(bpe.pieces(text, 20))
        assert "".join(parts) == text
        assert [i for p in parts for i in enc.encode_ordinary(p)] == enc.encode_ordinary(text)


def test_long_white_space_is_encoded_like_the_pattern():
    enc = bpe.encoding(ranks(), PATTERN)
    for run in (" " * 70_000, "\n" * 70_000, " \n\t" * 30_000, "\u3000" * 70_000, " " * 70_000 + "\n", "\x1c" * 70_000):
        for text in (run, run + "a", "a" + run, f"a{run}a b{run}.", f"1 {run}\x1c{run}'s", "é" + run + "\n!"):
            assert bpe.token_ids(text, enc) == enc.encode_ordinary(text)


def test_two_million_white_spaces(spark):
    split = regex.compile(PATTERN)
    enc, counts = bpe.encoding(ranks(), PATTERN), edits.TokenCounts(ranks(), PATTERN)
    texts = [" " * 2_000_000, " " * 2_000_000 + "end", "a\n" + "\n" * 2_000_000 + " b"]
    for text in texts:
        plain = [i for p in split.findall(text) for i in enc._core_bpe.encode_single_piece(p.encode())]
        assert bpe.token_ids(text, enc) == plain
        tree = edits.Tree.of(text, counts, split)
        assert tree.total == len(plain)
        tree.edit(1_000_000, 1_000_001, "x")
        changed = text[:1_000_000] + "x" + text[1_000_001:]
        assert tree.text() == changed and tree.total == len(bpe.token_ids(changed, enc))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    rows = bpe.round_trip(docs, ranks(), PATTERN).collect()
    assert len(rows) == 3 and all(r["exact"] for r in rows)
    changed = docs.withColumn("edits", edits.sample_edits(F.col("doc_id"), F.col("text")))
    rows = edits.count(changed, ranks(), PATTERN, keep_text=True).collect()
    assert [r["tokens_after"] for r in rows] == [len(bpe.token_ids(r["edited"], enc)) for r in rows]


# ---------------------------------------------------------------- op7


def test_rotation(spark):
    rows = [
        (1, 0, "system", "be brief", "x"),
        (1, 1, "ann b", "hi", "x"),
        (1, 2, "bob", None, "x"),
        (1, 2, "bob", None, "x"),
        (1, None, None, "<|end|>", "x"),
        (2, 0, "system", "alone", "x"),
        (None, 1, "cy", "no id", "x"),
    ]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, part string")
    views = {(r["conv_id"], r["perspective"]): r for r in chat.rotate(turns).collect()}
    assert set(views) == {(1, "ann b"), (1, "bob"), (1, "unknown"), (None, "cy")}
    bob = views[1, "bob"]
    assert bob["n_messages"] == 5 and bob["n_masked"] == 2
    assert "user name=ann_b\nhi<|end|>" in bob["rendered"]
    spans = [tuple(map(int, s.split(":"))) for s in bob["mask"].split(",")]
    assert [bob["rendered"][a:b] for a, b in spans] == ["<|end|>", "<|end|>"]
    assert "< |end|><|end|>" in views[1, "unknown"]["rendered"]
    assert chat.rotate(turns.filter("false")).count() == 0


def test_long_conversations_come_in_parts(spark):
    turns = spark.range(300).selectExpr("7L as conv_id", "id as turn", "if(id % 2 = 0, 'a', 'b') as role", "cast(id as string) as text")
    parts = chat.rotate(turns, part_turns=100).filter("perspective = 'a'").orderBy("part").collect()
    assert [r["n_messages"] for r in parts] == [100, 100, 100]
    said = re.findall(r">(?:assistant|user name=b)\n(\d+)<", "".join(r["rendered"] for r in parts))
    assert said == [str(i) for i in range(300)]


# ---------------------------------------------------------------- op8


def plain_components(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, t in rows:
        w = CHECK_WORDS.findall((t or "").translate(lower))
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    held = collections.defaultdict(list)
    for i in sorted(sets):
        met = collections.Counter(j for s in sets[i] for j in held[s])
        for j, k in met.items():
            if 100 * k >= 75 * (len(sets[i]) + len(sets[j]) - k):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
        for s in sets[i]:
            held[s].append(i)
    return {(i, len(s), root(i)) for i, s in sets.items()}


def copies(seed: int) -> list[tuple[int, str]]:
    """Near copies of a few texts with few and many changes, exact copies, and a passage that most share."""
    draw = random.Random(seed)
    base = [words(seed * 100 + k, n).split() for k, n in enumerate((8, 9, 30, 80, 200))]
    passage = words(seed * 100 + 50, 60)
    rows = []
    for i in range(400):
        own = list(draw.choice(base))
        for _ in range(draw.choice((0, 0, 1, 1, 2, 4, 9))):
            own[draw.randrange(len(own))] = draw.choice(["new", "other", f"w{draw.randrange(50)}"])
        rows.append((i, " ".join(own) + (f" {passage}" if draw.random() < 0.3 else "")))
    return rows


@pytest.mark.parametrize("seed, often, bucket, block", [(1, 64, 16, 4096), (2, 4, 4, 50), (3, 1, 2, 64)])
def test_join_equals_brute_force(spark, monkeypatch, seed, often, bucket, block):
    """Small bounds too, so that combinations, blocks and further rounds all take part."""
    for name, value in (("OFTEN", often), ("BUCKET", bucket), ("BLOCK", block), ("CLOSEST", 1)):
        monkeypatch.setattr(jaccard, name, value)
    rows = copies(seed)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {tuple(r) for r in jaccard.components(docs).collect()} == plain_components(rows)


@pytest.mark.parametrize("seed", [5, 6])
def test_join_with_repeated_ids_equals_brute_force(spark, seed):
    """Ids that stand for several texts are linked as any of these is; every row comes back."""
    draw = random.Random(seed)
    rows = [(i % 230 if i % 3 else draw.randrange(100, 330), t) for i, t in copies(seed)]
    rows += [(1, rows[0][1])] * 3 + [(None, rows[0][1]), (4, None), (4, "")]
    single = plain_components(list(enumerate(t for _, t in rows)))
    root_of, n_of = {k: r for k, _, r in single}, {k: n for k, n, _ in single}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for k, (i, _) in enumerate(rows):
        if i is not None and n_of[k]:
            a, b = root(("id", i)), root(("set", root_of[k]))
            parent[a] = b
    least = collections.defaultdict(lambda: 1 << 60)
    for k, (i, _) in enumerate(rows):
        if i is not None and n_of[k]:
            least[root(("id", i))] = min(least[root(("id", i))], i)
    want = sorted(((i, n_of[k], None if i is None else least[root(("id", i))] if ("id", i) in parent else i) for k, (i, _) in enumerate(rows)), key=str)
    got = jaccard.components(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_link_of_the_second_text_of_an_id(spark):
    x, y = words(1, 30), words(2, 80)
    rows = spark.createDataFrame([(1, x), (2, x), (2, y), (3, y + " more")], "doc_id bigint, text string")
    assert {(r["doc_id"], r["component_id"]) for r in jaccard.components(rows).collect()} == {(1, 1), (2, 1), (3, 1)}


def test_signatures_find_all_pairs_at_the_bound():
    draw = np.random.default_rng(4)
    for trial in range(400):
        n = int(draw.integers(2, 120))
        one = np.unique(draw.integers(1, 1 << 62, n).astype(np.uint64))
        slack = len(one) - jaccard.needed(len(one))
        other = np.sort(np.concatenate([draw.permutation(one)[: len(one) - int(draw.integers(0, slack + 1))], draw.integers(1, 1 << 62, 3).astype(np.uint64)]))
        shared = len(np.intersect1d(one, other))
        if 100 * shared < 75 * (len(one) + len(other) - shared):
            continue
        known = np.sort(draw.permutation(one)[: int(draw.integers(0, len(one) + 1))])
        (a, least_a), (b, least_b) = jaccard.signatures(one, known), jaccard.signatures(other, known)
        assert len(np.intersect1d(a, b)) >= max(1, least_a if len(known) == 0 else 1), trial
        total = len(one) + len(other)
        assert 175 * jaccard.apart(jaccard.parities(one), jaccard.parities(other)) <= 25 * total


def test_join_of_odd_rows(odd_docs, no_docs):
    got = sorted(((r["doc_id"], r["component_id"]) for r in jaccard.components(odd_docs).collect()), key=str)
    want = {0: 0, 1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 5, 7: 7, 8: 7, 9: 7, 10: 7, 11: 11, 13: 13, 14: 14, 15: 15}
    assert got == sorted([*want.items(), (11, 11), (None, None), (None, None)], key=str)
    assert jaccard.components(no_docs).count() == 0


# ---------------------------------------------------------------- op9


def test_language(spark, odd_docs, no_docs):
    rows = QUERIES["op9_language"](spark, FOLDER).join(
        spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang"), "doc_id"
    )
    held = rows.filter("held_out and lang is not null").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    sample = (("de", "der hund und die katze " * 5), ("en", "the dog and the cat " * 5))
    odd = {r["doc_id"]: r for r in crossparse.predict(odd_docs, sample).collect()}
    assert [odd[i]["lang_pred"] for i in (0, 1, 2)] == ["und"] * 3 and odd[0]["score"] == 0
    assert crossparse.predict(no_docs, sample).count() == 0
    assert crossparse.learn(no_docs) == ()


def test_copies_do_not_crowd_out_a_language(spark):
    rows = [(f"{words(i, 40)} {i}", "xx") for i in range(60) for _ in range(64)] + [(words(99, 40), "yy")]
    sample = dict(crossparse.learn(spark.createDataFrame(rows, "text string, lang string")))
    assert all(f"{words(i, 40)} {i}" in sample["xx"] for i in range(60))
    assert sample["xx"].count(words(0, 40)) == 1 and set(sample) == {"xx", "yy"}


def test_short_and_long_labelled_texts_are_learnt(spark):
    draw = random.Random(3)
    own = {lang: [a + b for a in letters for b in letters] for lang, letters in (("mid", "abcd"), ("short", "efgh"), ("long", "ijkl"))}

    def text(lang, count):
        return " ".join(draw.choice(own[lang]) + draw.choice(own[lang]) for _ in range(count))

    rows = [(text("mid", 60), "mid") for _ in range(70)] + [(text("short", 4), "short") for _ in range(5)]
    rows += [("1 " * 3_000 + text("long", 3_000), "long") for _ in range(3)] + [("12", "none"), (None, "none"), ("a" * 200, None)]
    sample = crossparse.learn(spark.createDataFrame(rows, "text string, lang string"))
    assert [name for name, _ in sample] == ["long", "mid", "short"]
    assert all(len(known) <= 60_000 for _, known in sample)
    want = ["short", "mid", "long"] * 20
    assert crossparse.Parser(sample).predict([text(lang, 30) for lang in want])[0] == want


def test_parser_counts_longest_phrases():
    sample = (("x", "abracadabra banana"), ("y", "zebra cadence"))
    parser = crossparse.Parser(sample)
    draw = random.Random(9)
    for _ in range(300):
        text = "".join(draw.choice("abrcdnz eq") for _ in range(draw.randint(1, 40)))
        codes = parser.encode(text)
        got = parser.phrases([codes])[0]
        for (_, known), count in zip(sample, got, strict=True):
            inside = {tuple(k) for k in [()]}
            own = parser.encode(known).tolist()
            inside |= {tuple(own[i:j]) for i in range(len(own)) for j in range(i + 1, len(own) + 1)}
            phrases, at = 0, 0
            while at < len(codes):
                end = at + 1
                while end < len(codes) and tuple(codes[at : end + 1].tolist()) in inside:
                    end += 1
                phrases, at = phrases + 1, end
            assert abs(int(count) - phrases) <= (0 if all(c in own for c in codes.tolist()) else 1 + phrases)
            if len(codes) and all(c in own for c in codes.tolist()):
                assert count == phrases


@pytest.mark.parametrize("wide", [128, 4])
def test_every_letter_of_many_scripts_counts(monkeypatch, wide):
    """Latin, Cyrillic, Greek and two languages of many letters; also with sorted lists for all."""
    monkeypatch.setattr(crossparse, "WIDE", wide)
    draw = random.Random(8)
    scripts = {"el": (0x3B1, 24), "ja": (0x4E00, 600), "la": (0x61, 26), "rare": (0x10400 + 40, 40), "ru": (0x430, 32), "zh": (0x5800, 600)}
    own = {n: ["".join(chr(a + draw.randrange(k)) for _ in range(4)) for _ in range(300)] for n, (a, k) in scripts.items()}

    def text(name, count):
        return " ".join(draw.choice(own[name]) for _ in range(count))

    parser = crossparse.Parser(tuple((n, text(n, 200 if n == "rare" else 2_000)) for n in sorted(scripts)))
    want = sorted(scripts) * 5
    assert parser.predict([text(n, 20) for n in want])[0] == want
    single = crossparse.Parser((("zh", "".join(own["zh"])),))
    assert single.phrases([single.encode(own["zh"][7])]).tolist() == [[1]]
    assert single.phrases([single.encode("abc")]).tolist()[0][0] >= 3


# ---------------------------------------------------------------- op10


def test_quality(spark, odd_docs, no_docs):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = QUERIES["op10_quality"](spark, FOLDER).join(labels, "doc_id").filter("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.93 * len(rows)
    good = [r for r in rows if r["quality"] == 1]
    assert sum(r["predicted"] for r in good) >= 0.98 * len(good)
    stats = quality.measured(odd_docs)
    model = quality.fit(stats, spark.createDataFrame([(5, 1.0), (7, 0.0), (7, None), (None, 1.0), (99, 1.0)], "doc_id bigint, label double"))
    scores = [r["score"] for r in quality.score(odd_docs, model, to="score").collect()]
    assert len(scores) == odd_docs.count() and all(0 <= s <= 1 for s in scores)
    empty = quality.fit(stats, labels.select("doc_id", F.col("quality").alias("label")).filter("false"))
    assert {r["score"] for r in quality.score_measured(stats, empty).collect()} == {0.5}
    assert quality.score_measured(quality.measured(no_docs), model).count() == 0


def test_weights_solve_the_plain_ridge(spark):
    draw = np.random.default_rng(6)
    texts = [" ".join(draw.choice(["a", "Bc", "3", "x!", "word\n", "|"], size=draw.integers(1, 60))) for _ in range(400)]
    stats = quality.measured(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(7))
    good = {i: float(t.count("word") > 6) for i, t in enumerate(texts)}
    model = quality.fit(stats, spark.createDataFrame(list(good.items()), "doc_id bigint, label double"))
    rows = np.array([quality.statistics(t) for t in texts], np.float32).astype(np.float64)
    assert np.allclose(model.mean, rows.mean(axis=0)) and np.allclose(model.deviation, np.maximum(rows.std(axis=0), 1e-6))
    labels = np.array([good[i] for i in range(len(texts))])
    x = model.features(rows)
    # Ridge as least squares with one more row for each penalised weight.
    root = np.sqrt(quality.RIDGE * len(rows) / x.shape[1]) * np.eye(x.shape[1])[:-1]
    plain = np.linalg.lstsq(np.vstack([x, root]), np.concatenate([labels, np.zeros(len(root))]), rcond=None)[0]
    assert np.allclose(x @ model.weights, x @ plain, atol=1e-6)
    # Products of the cosines come close to the Gaussian kernel.
    scaled = np.clip((rows[:40] - model.mean) / model.deviation, -5, 5)
    kernel = np.exp(-((scaled[:, None] - scaled[None]) ** 2).sum(axis=2) / (2 * quality.BANDWIDTH**2))
    assert np.abs(x[:40, :-1] @ x[:40, :-1].T - kernel).mean() < 0.1
    # Isotonic shares are least squares: the greatest of all least averages.
    step = np.rint((np.clip(x @ model.weights, -0.5, 1.5) + 0.5) / 2 * quality.STEPS)
    steps = sorted(set(step))
    sums, counts = (np.cumsum([0, *own]) for own in ([labels[step == s].sum() for s in steps], [(step == s).sum() for s in steps]))
    share = np.array([[(sums[j + 1] - sums[i]) / max(counts[j + 1] - counts[i], 1) for j in range(len(steps))] for i in range(len(steps))])
    want = [share[: k + 1, k:].min(axis=1).max() for k in range(len(steps))]
    assert len(model.calibrated) == len(want) and np.abs(np.array(want) - model.calibrated).max() < 0.02


def test_isotonic_equals_the_greatest_of_least_averages():
    draw = random.Random(8)
    for _ in range(200):
        rows = [draw.randint(1, 5) for _ in range(draw.randint(1, 12))]
        good = [draw.randint(0, n) for n in rows]
        want = [
            max(min(sum(good[i : j + 1]) / sum(rows[i : j + 1]) for j in range(k, len(rows))) for i in range(k + 1)) for k in range(len(rows))
        ]
        assert np.allclose(quality.isotonic(good, rows), want)


def test_isotonic_pools_neighbours_that_fall():
    assert quality.isotonic([0, 2, 1, 3], [1, 2, 2, 3]).tolist() == [0.0, 0.75, 0.75, 1.0]

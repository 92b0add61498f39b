"""Filter audit, importance resampling and archives against plain versions, and on odd rows."""

import base64
import gzip
import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from leadloom.llm import importance, interactions, warc
from leadloom.session import scratch_path
from tests.llm.conftest import cases, words

LABELS = "doc_id bigint, quality int, toxic int"

# ---------------------------------------------------------------- op11


def plain_mask(rows, row):
    i, text = row[0], row[1] or ""
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    smaller = any(j is not None and i is not None and j < i and (t or "") == text for j, t, *_ in rows)
    conditions = [
        len(found) < 100,
        100 * len(set(found)) < 80 * len(found),
        100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
        re.search(r"[#$%&*|]", text) is not None,
        smaller,
    ]
    return {letter for letter, fails in zip("ABCDE", conditions) if fails}


def plain_audit(rows, labels):
    good = {i for i, quality, _ in labels if quality == 1 and i is not None}
    toxic = {i for i, _, bad in labels if bad == 1 and i is not None}
    out = set()
    masks = [plain_mask(rows, row) for row in rows]
    for part in {row[2] or "" for row in rows}:
        of_part = [(row, mask) for row, mask in zip(rows, masks) if (row[2] or "") == part]
        lines, removed_by = [], Counter()
        for order in itertools.permutations("ABCDE"):
            left = of_part
            for step, letter in enumerate(order, 1):
                gone = [(r, m) for r, m in left if letter in m]
                failing = sum(letter in m for _, m in of_part)
                left = [(r, m) for r, m in left if letter not in m]
                removed_by[letter] += len(gone)
                lines.append((
                    part, "".join(order), step, letter, len(left), len(gone), failing - len(gone), sum(m == {letter} for _, m in of_part),
                    sum(r[0] in good for r, _ in gone), sum(r[0] in toxic for r, _ in gone),
                ))
        out |= {(*line, removed_by[line[3]]) for line in lines}
    return out


def audited(spark, docs, labels):
    marks = {"good": F.col("quality") == 1, "toxic": F.col("toxic") == 1}
    counts = interactions.mask_counts(docs, spark.createDataFrame(labels, LABELS), marks)
    rows = interactions.audit(counts, "ABCDE", list(marks))
    assert rows.columns == ["part", "filter_order", "step", "filter", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    found = [tuple(r) for r in rows.collect()]
    assert len(found) == len(set(found))
    return set(found)


def test_audit_equals_applying_the_filters_one_by_one(spark):
    draw = random.Random(3)
    pool = [words(i, draw.choice((5, 99, 100, 101, 130, 400))) for i in range(12)]
    pool += [p.upper() for p in pool[:4]] + [p + " 5%" for p in pool[4:8]] + [" ".join(f"w{i}" for i in range(120)), None, "", " "]
    rows = [(draw.randrange(60), draw.choice(pool), draw.choice(("en", "de", None, ""))) for _ in range(150)]
    rows += rows[:5] + [(None, pool[0], "en"), (None, pool[0], "de"), (7, pool[1], "fr")]
    labels = [(i, draw.randrange(2), draw.randrange(2)) for i in range(0, 60, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (6, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert audited(spark, docs, labels) == plain_audit(rows, labels)


def test_audit_of_odd_rows(spark, odd_docs, no_docs):
    labels = [(8, 1, 0), (14, 0, 1)]
    assert audited(spark, odd_docs, labels) == plain_audit(cases(), labels)
    assert audited(spark, no_docs, labels) == set()


def test_intervals_are_what_the_orders_say():
    for size in (1, 2, 3, 4, 5):
        removed = {}
        for mask, step, first, behind in interactions.intervals(size):
            for rank in range(first, behind):
                assert removed.setdefault((mask, rank), step) == step
        for rank, order in enumerate(itertools.permutations(range(size))):
            for mask in range(1, 1 << size):
                assert removed[mask, rank] == next(s for s, f in enumerate(order, 1) if mask >> f & 1)
    with pytest.raises(ValueError):
        interactions.audit(None, "ABCDEFGH", [])


# ---------------------------------------------------------------- op12

PLAIN_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return PLAIN_WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_buckets(text, longest=1, buckets=10_000):
    found = plain_words(text)
    return [zlib.crc32(" ".join(found[i : i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(found) - n + 1)]


def plain_draw(rows, target, percent=10, longest=1):
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(plain_buckets(text, longest))
    for text in target:
        t.update(plain_buckets(text, longest))
    all_s, all_t = sum(s.values()), sum(t.values())
    out = []
    for i, text in rows:
        own = plain_buckets(text, longest)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000)))) for b in own)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(plain_words(text)) >= 20])
    order = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = {id(r): n for n, r in enumerate(order[: percent * len(order) // 100], 1)}
    return sorted([tuple(r[:4]) + (ranks.get(id(r)),) for r in out], key=str)


def drawn(frame):
    return sorted(map(tuple, frame.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def target_of(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id bigint, text string")


@pytest.mark.parametrize("percent,longest,segments", [(10, 1, None), (60, 2, 7), (100, 3, 64)])
def test_draw_equals_a_plain_sort(spark, percent, longest, segments):
    draw = random.Random(8)
    rows = [(i, words(i, draw.choice((0, 5, 19, 20, 40, 200)))) for i in range(300)]
    rows += [(7, "Ünï ÄÖ k2 " * 30)] * 40 + [(None, words(5, 50))] * 3 + [(999, None), (998, "")]
    target = [words(1000, 80), words(1001, 300), None, "Über Ünï K2"]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = importance.resample(docs, target_of(spark, target), percent=percent, longest=longest, segments=segments)
    assert drawn(found) == plain_draw(rows, target, percent, longest)


def test_draw_of_odd_rows(spark, odd_docs, no_docs):
    target = [words(2, 30)]
    found = importance.resample(odd_docs, target_of(spark, target), percent=50)
    assert drawn(found) == plain_draw([r[:2] for r in cases()], target, 50)
    assert {r.doc_id for r in importance.drawn_documents(odd_docs, found).collect()} == {r.doc_id for r in found.filter("rank > 0").collect()} - {None}
    assert importance.resample(no_docs, target_of(spark, target)).count() == 0
    assert drawn(importance.resample(odd_docs, target_of(spark, []), percent=50)) == plain_draw([r[:2] for r in cases()], [], 50)


def test_long_texts_are_read_in_stretches(monkeypatch):
    monkeypatch.setattr(importance, "STRETCH", 100)
    known = importance.Buckets(10_000)
    for text in (words(1, 500), "x" * 1_000, "a b " * 300, " " * 1_000, "é" * 700 + "-" + "ü" * 50, ""):
        for longest in (1, 2, 4):
            found = [b for _, part in importance.features_of(text, longest, known) for b in part]
            assert sorted(found) == sorted(plain_buckets(text, longest))
            assert sum(n for n, _ in importance.features_of(text, 1, known)) == len(plain_words(text))


def test_equal_rows_spread_over_segments(spark):
    """One row in two thirds of the table: its copies are cut by their place in the run."""
    rows = spark.range(0, 3000, 1, 6).selectExpr("IF(id % 3 = 0, id, 1) AS id", "30L AS n_words", "IF(id % 3 = 0, id, 5000) AS score")
    runs = importance.sorted_runs(rows, F.col("n_words") >= 20)
    sizes = importance.with_segment(runs, importance.splitters(runs, 3000, 10)).groupBy("segment").count().collect()
    assert len(sizes) == 10 and max(r["count"] for r in sizes) < 2 * 3000 / 10


# ---------------------------------------------------------------- op13

PAGES = "page_id bigint, url string, html string, size int, payload string, record_type string"


def archived(spark, rows, least_bytes=0, records_a_file=3):
    root = scratch_path(spark, "warc")
    pages = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], PAGES)
    warc.write(pages, f"{root}/a", records_a_file=records_a_file)
    warc.deduplicate(spark, f"{root}/a", f"{root}/b", least_bytes=least_bytes, records_a_file=records_a_file)
    return root, sorted((tuple(r) for r in warc.resolve(spark, f"{root}/b").drop("uri").collect()), key=str)


def plain_archive(rows, least_bytes=0):
    out, groups = [], {}
    for place, (page, _, html) in enumerate(rows):
        groups.setdefault(html or "", []).append((-1 if page is None else page, place))
    for place, (page, _, html) in enumerate(rows):
        body = (html or "").encode()
        largest, at = max(groups[html or ""])
        own = at == place or len(body) < least_bytes
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((page, len(body), digest, "response" if own else "revisit", None if own or largest == -1 else largest))
    return sorted(out, key=str)


ODD_PAGES = [
    (1, "http://a.example/", "<p>one</p>"),
    (2, "http://a.example/\r\nX: y", "<p>one</p>"),
    (3, None, None),
    (4, "http://b.example/", ""),
    (5, "http://ü.example/ x", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n\r\n\r\n"),
    (6, "", "\r\n\r\n"),
    (6, "", "\r\n\r\n"),
    (None, "u", "nameless"),
    (None, "u", "nameless"),
    (None, "v", "<p>one</p>"),
    (9, "long", "é<br>\n" * 700_000),
    (10, "long", "é<br>\n" * 700_000),
]


@pytest.mark.parametrize("least_bytes", [0, 4, 11])
def test_archives_come_back_as_they_went(spark, least_bytes):
    root, found = archived(spark, ODD_PAGES, least_bytes)
    assert found == plain_archive(ODD_PAGES, least_bytes)
    bodies = {r.page: r.payload.decode() for r in warc.read(spark, f"{root}/a", payloads=True).collect()}
    assert bodies["5"] == ODD_PAGES[4][2] and bodies["9"] == ODD_PAGES[10][2]
    kept = warc.read(spark, f"{root}/b", payloads=True).filter("record_type = 'response'")
    assert kept.count() == sum(r[3] == "response" for r in found)


def test_one_payload_of_most_pages(spark):
    rows = [(i, f"u{i}", "same" if i % 3 else f"own {i}") for i in range(300)]
    assert archived(spark, rows, records_a_file=50)[1] == plain_archive(rows)


def test_deduplicating_again_keeps_what_revisits_refer_to(spark):
    root, found = archived(spark, ODD_PAGES)
    warc.deduplicate(spark, f"{root}/b", f"{root}/c")
    assert sorted((tuple(r) for r in warc.resolve(spark, f"{root}/c").drop("uri").collect()), key=str) == found


def test_no_pages(spark):
    assert archived(spark, [])[1] == []


def test_files_of_other_makers():
    record = warc.record_of("response", "1", "u", "d", "X", b"body")
    foreign = b"WARC/1.0\r\nwarc-type: warcinfo\r\ncontent-length: 2\r\n\r\nhi\r\n\r\n" + record + b"\r\n\r\n"
    members = b"".join(gzip.compress(part) for part in (foreign, record + b"\r\n\r\n"))
    for content, count in ((foreign, 2), (gzip.compress(foreign), 2), (members, 3)):
        read = list(warc.records_in(content))
        assert len(read) == count and warc.payload_of(*read[1]) == b"body"
    for broken in (foreign[:-3], foreign[:20], gzip.compress(foreign)[:-9], members[:-20], b"no archive\r\n\r\n"):
        with pytest.raises(ValueError):
            list(warc.records_in(broken))

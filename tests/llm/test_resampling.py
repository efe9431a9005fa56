"""Importance resampling against a plain version, and the interning table against the libraries."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from helpers import alnum_words, edge_documents, edge_rows, empty_documents, prose

from eventloom.llm import interning, resampling


def features(text, longest=2):
    words = alnum_words(text)
    return [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def plain(rows, target, longest=2, buckets=10_000, share=25, least=20, seed=7):
    """(id, words, features, weight, score, rank) of every row, sorted."""

    def counts(texts):
        return Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in features(t, longest))

    s, t = counts([r[1] for r in rows]), counts(target)
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000 * math.log(((t[b] + 1.0) * (all_s + float(buckets))) / ((s[b] + 1.0) * (all_t + float(buckets)))))
        for b in range(buckets)
    ]
    out = []
    for doc, text in rows:
        own = [gain[zlib.crc32(f.encode()) % buckets] for f in features(text, longest)]
        weight = sum(own) // len(own) if own else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc, len(alnum_words(text)), len(own), weight, score])
    can = sorted((x for x in out if x[1] >= least), key=lambda x: (-x[4], x[0] is None, x[0] or 0))
    for i, x in enumerate(can):
        x.append(i + 1 if i < share * len(can) // 100 else None)
    return sorted((tuple(x) if len(x) > 5 else (*x, None) for x in out), key=str)


def found(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()), key=str)


def test_keys_are_those_of_the_libraries():
    buf = np.frombuffer(random.Random(1).randbytes(6000), dtype=np.uint8)
    windows = interning.windows_of(buf)
    begin = np.arange(0, 3000, 37)
    for size in [*range(1, 70), 127, 128, 1000, 2000]:
        length = np.full(len(begin), size)
        raw = [buf[b : b + size].tobytes() for b in begin]
        assert interning.xxhash64(windows, begin, size).tolist() == [xxhash.xxh64_intdigest(x) for x in raw]
        assert interning.crc32(buf, begin, length).tolist() == [zlib.crc32(x) for x in raw]


def test_equal_keys_of_different_bytes_stay_apart(monkeypatch):
    """With every key the same the table still tells spans apart by their bytes, one place after the other."""
    monkeypatch.setattr(interning, "xxhash64", lambda windows, begin, length: np.full(len(begin), 5, dtype=np.uint64))
    buf = np.frombuffer(b"abcd" * 30 + b"wxyz" * 20, dtype=np.uint8)
    begin = np.arange(150)
    for size in (1, 3, 8, 11):
        length = np.full(len(begin), size)
        table = interning.Interned(buf, begin, length)
        raw = [buf[b : b + size].tobytes() for b in begin]
        assert len(table.taken()) == len(set(raw))
        slots = dict(zip(raw, table.slot.tolist(), strict=True))
        assert [slots[x] for x in raw] == table.slot.tolist()
    mixed = interning.Interned(buf, begin, np.where(begin % 2, 3, 5))
    assert len(mixed.taken()) == len({buf[b : b + (3 if b % 2 else 5)].tobytes() for b in begin})


@pytest.mark.parametrize("longest", [1, 2, 3])
@pytest.mark.parametrize("limit", [60, 1000, 1 << 20])
def test_pieces_have_the_n_grams_of_the_whole_texts(longest, limit):
    texts = [r[1] for r in edge_rows()] + ["x" * 3000, "a " * 200, "", None, " . "]
    total, words, rows = np.zeros(1000, dtype=np.int64), Counter(), Counter()
    for some in interning.pieces_of(texts, longest, limit):
        grams = interning.Grams(some, longest, 1000)
        total += grams.histogram(1000)
        words.update({i: int(n) for i, n in enumerate(grams.words)})
        rows.update(grams.row.tolist())
    want = Counter(zlib.crc32(f.encode()) % 1000 for t in texts for f in features(t, longest))
    assert {b: int(n) for b, n in enumerate(total) if n} == want
    assert all(words[i] == len(alnum_words(t)) for i, t in enumerate(texts))
    assert all(rows[i] == len(features(t, longest)) for i, t in enumerate(texts))


def test_odd_rows(spark):
    target = [prose(3, 40), None, "", "one two three"]
    items = spark.createDataFrame([(str(i), t) for i, t in enumerate(target)], "item_id string, text string")
    got = resampling.importance_resample(edge_documents(spark), items)
    assert found(got) == plain([r[:2] for r in edge_rows()], target)
    assert resampling.importance_resample(empty_documents(spark), items).collect() == []
    nothing = resampling.importance_resample(edge_documents(spark), items.limit(0))
    assert found(nothing) == plain([r[:2] for r in edge_rows()], [])


def test_other_settings(spark):
    rows = [(i, prose(i % 60, 15 + i % 9)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    target = [prose(5, 400)]
    items = spark.createDataFrame([(t,) for t in target], "body string")
    got = resampling.importance_resample(docs, items, target_text="body", words=3, buckets=97, share=60, least_words=18, seed=1)
    assert found(got) == plain(rows, target, 3, 97, 60, 18, 1)


def test_documents_like_the_target_are_drawn(spark):
    """Half of the documents share the target's vocabulary; nearly all that are drawn are such."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    draw = random.Random(4)
    kinds = [["".join(draw.choices(letters, k=6)) for _ in range(50)] for _ in range(2)]
    rows = [(i, " ".join(draw.choices(kinds[i % 2], k=80))) for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    target = spark.createDataFrame([(" ".join(draw.choices(kinds[1], k=2000)),)], "text string")
    ids = [r.doc_id for r in resampling.importance_resample(docs, target).where("rank is not null").collect()]
    assert len(ids) == 200
    assert sum(i % 2 for i in ids) > 150


def test_very_long_text(spark):
    """Texts of 3 MB, one of them without a blank."""
    rows = [(1, "word another " * 230_000), (2, "q" * 3_000_000), (3, prose(1, 50))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([("word another",)], "text string")
    assert found(resampling.importance_resample(docs, items)) == plain(rows, ["word another"])

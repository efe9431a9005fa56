"""Order MinHash with banded alignment, and components."""

import random

import numpy as np
from helpers import alnum_words, edge_documents, edit_distance, empty_documents, prose
from pyspark.sql import functions as F

from eventloom.llm import orderhash, spans
from eventloom.llm.components import components
from eventloom.llm.orderhash import banded_distance, near_duplicates, one_of_each, similarity, sketch_values
from eventloom.llm.queries import QUERIES


def test_banded_distance_equals_the_full_table():
    draw = random.Random(3)
    for _ in range(3000):
        a = [draw.randint(0, 4) for _ in range(draw.randint(0, 14))]
        b = [draw.randint(0, 4) for _ in range(draw.randint(0, 14))]
        most, true = draw.randint(0, 8), edit_distance(a, b)
        assert banded_distance(a, b, most) == (true if true <= most else None)


def test_similarity_by_words():
    a = np.arange(100, dtype=np.uint64)
    b = a.copy()
    b[10:30:2] += np.uint64(1000)
    assert similarity(a, b) == 0.9
    assert similarity(a, a[:79]) is None
    assert similarity(a, a[:80]) == 0.8
    assert similarity(a, a[::-1]) is None


def test_sketch_keeps_the_order_of_its_kmers():
    """Two halves exchanged: the k-mers are nearly the same, their order is not."""
    one, two = prose(1, 200), prose(2, 200)
    _, _, _, values = sketch_values(*spans.packed([f"{one} {two}", f"{two} {one}", f"{one} {two} end"]))
    swapped, longer = (values[0] == values[1]).sum(), (values[0] == values[2]).sum()
    assert longer >= 18 and swapped < longer


def edited_pairs(rate, words=400, pairs=300):
    """Texts of random words, and the same with that share of the words replaced in scattered places."""
    draw = random.Random(int(rate * 100))
    for i in range(pairs):
        one = [f"w{draw.randrange(50_000)}" for _ in range(words)]
        two = list(one)
        for at in draw.sample(range(words), round(rate * words)):
            two[at] = f"edit{i}x{at}"
        yield " ".join(one), " ".join(two)


def test_edited_copies_meet_at_every_accepted_similarity():
    for rate, most in ((0.05, 0.0), (0.1, 0.01), (0.15, 0.02), (0.2, 0.05)):
        pairs = list(edited_pairs(rate))
        _, _, _, values = sketch_values(*spans.packed([t for pair in pairs for t in pair]))
        missed = 1 - (values[0::2] == values[1::2]).any(axis=1).mean()
        assert missed <= most, (rate, missed)


def test_edited_copies_form_classes(spark):
    pairs = list(edited_pairs(0.19, 150, 100))
    rows = [(2 * i + k, t) for i, pair in enumerate(pairs) for k, t in enumerate(pair)]
    found = {r.doc_id: r.class_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(found[2 * i + 1] == 2 * i for i in range(100)) >= 95


def test_components(spark):
    links = [(1, 2), (2, 3), (5, 4), (9, 5), (7, 7)] + [(100 + i, 101 + i) for i in range(40)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 9: 4} | {100 + i: 100 for i in range(41)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows(spark):
    docs = edge_documents(spark)
    found = near_duplicates(docs).collect()
    classes = {r.doc_id: r.class_id for r in found}
    assert classes[1] == classes[2] == classes[3] == 1
    assert classes[11] == classes[12] == 11
    assert classes[4] == 4 and classes[5] == 5 and classes[None] is None
    assert len(found) == 14  # the repeated row is one document
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id if r.doc_id is not None else -1 for r in kept.collect())
    assert ids == [-1, 1, 4, 5, 6, 7, 8, 9, 10, 11, 13]
    assert near_duplicates(empty_documents(spark)).count() == 0
    assert one_of_each(empty_documents(spark)).count() == 0


def test_large_group_and_common_passage(spark):
    """A hundred near copies, and many different texts with one passage in common."""
    base, common = prose(11, 150).split(), prose(12, 60)
    rows = []
    for i in range(100):
        own = list(base)
        own[7 + i % 100] = f"edit{i}"
        rows.append((i, " ".join(own)))
    rows += [(1000 + i, f"{common} {prose(500 + i, 60)}") for i in range(60)]
    rows += [(2000 + i, f"{common} {prose(500 + i, 60)} tail") for i in range(60)]
    found = {r.doc_id: r.class_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {found[i] for i in range(100)} == {0}
    assert all(found[2000 + i] == found[1000 + i] == 1000 + i for i in range(60))


def test_query_against_all_pairs(spark):
    """Links of the classes are those of a comparison of all pairs on the small tables."""
    folder = "/root/testdata/sf0.001"
    found = {r.doc_id: r.class_id for r in QUERIES["op1_order_minhash"](spark, folder).collect()}
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    words = {r.doc_id: np.array([hash(w) for w in alnum_words(r.text)]) for r in rows}
    parent = {d: d for d in words}

    def top(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(d for d in words if len(words[d]))
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if similarity(words[a], words[b]) is not None:
                low, high = sorted((top(a), top(b)))
                parent[high] = low
    assert found == {d: top(d) for d in words}


def common_and_edited(pairs=150):
    """Texts with one common passage; each has a copy in which every fifth of its own words is replaced."""
    draw = random.Random(29)
    common = [f"c{i}" for i in range(40)]
    for i in range(pairs):
        own = [f"w{draw.randrange(50_000)}" for _ in range(100)]
        two = list(own)
        for at in draw.sample(range(100), 26):
            two[at] = f"edit{i}x{at}"
        yield " ".join([*own, *common]), " ".join([*two, *common])


def test_no_pair_of_a_bucket_is_left_out(spark):
    """All pairs that share a sketch value and are similar are in one class, also where the smallest id of their bucket is like neither."""
    texts = [t for pair in common_and_edited() for t in pair]
    _, _, _, values = sketch_values(*spans.packed(texts))
    hashes = [np.array([hash(w) for w in t.split()]) for t in texts]
    top = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if (values[i] == values[j]).any() and similarity(hashes[i], hashes[j]) is not None:
                high, low = max(top[i], top[j]), min(top[i], top[j])
                top = [low if t == high else t for t in top]
    assert sum(t != i for i, t in enumerate(top)) > 140
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in near_duplicates(docs).collect()} == dict(enumerate(top))


def test_blocks_hold_every_pair_that_can_be_similar(spark, monkeypatch):
    """A bucket of several lengths, cut into small blocks: the pairs of different classes, no similar one left out."""
    draw = random.Random(31)
    words = [[f"v{draw.randrange(40)}" for _ in range(draw.randint(5, 40))] for _ in range(50)]
    words += [own[i % 2 :] + [f"e{i}"] for i, own in enumerate(words)] + [["x", *own[len(own) // 6 :]] for own in words]
    texts = [" ".join(w) for w in draw.sample(words, len(words))]
    n_words, _, _, _ = sketch_values(*spans.packed(texts))
    bags = orderhash._bags(*orderhash._words(*spans.packed(texts)))
    rows = [(i, i % 75, int(n_words[i]), bytearray(bags[i])) for i in range(len(texts))]
    known = spark.createDataFrame(rows, "doc long, class long, n_words long, bag binary")
    keyed = spark.createDataFrame([(i, 7) for i in range(len(texts))], "doc long, value long")
    monkeypatch.setattr(orderhash, "BLOCK", 16)
    found = [tuple(r) for r in orderhash._apart(keyed, known, 0.8).select("lead", "doc").collect()]
    hashes = [np.array([hash(w) for w in t.split()]) for t in texts]
    similar = {(j, i) for i in range(150) for j in range(i) if i % 75 != j % 75 and similarity(hashes[j], hashes[i]) is not None}
    assert len(found) == len(set(found)) and similar and similar <= set(found)
    assert all(a % 75 != b % 75 for a, b in found)


def test_texts_that_bags_of_words_tell_apart_are_not_aligned(spark, monkeypatch):
    """Texts with two thirds of their words in common share values, but none is compared by its words with another."""
    draw = random.Random(37)
    common = [f"c{i}" for i in range(100)]
    rows = [(i, " ".join([*common, *(f"w{draw.randrange(50_000)}" for _ in range(50))])) for i in range(120)]
    asked, verified = [], orderhash._verified

    def counted(pairs, texts, least):
        asked.append(pairs.count())
        return verified(pairs, texts, least)

    monkeypatch.setattr(orderhash, "_verified", counted)
    found = {r.doc_id: r.class_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {i: i for i in range(120)} and sum(asked) < 120


def test_documents_meet_once_and_with_their_classes(spark):
    """Documents that share two values: each pair of different classes once, with its classes and how far the bags are apart."""
    draw = random.Random(41)
    base = [f"w{i}" for i in range(100)]
    texts = []
    for i in range(40):
        own = list(base)
        for at in draw.sample(range(100), 4):
            own[at] = f"e{i}x{at}"
        texts.append(" ".join(own))
    bags = orderhash._bags(*orderhash._words(*spans.packed(texts)))
    known = spark.createDataFrame([(i, i // 10, 100, bytearray(bags[i])) for i in range(40)], "doc long, class long, n_words long, bag binary")
    keyed = spark.createDataFrame([(i, 7) for i in range(40)], "doc long, value long")
    found = orderhash._apart(keyed.unionByName(keyed.withColumn("value", F.lit(9).cast("long"))), known, 0.8).collect()
    assert len(found) == 600 and all(r.lead // 10 == r.lead_class != r["class"] == r.doc // 10 and 0 < r.apart <= 16 for r in found)


def test_only_asked_texts_are_shuffled(spark, monkeypatch):
    """No plan of the texts to verify has an exchange of all texts; in portions or by a shuffle of both the rows are the same."""
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*base[: 60 - i % 9], f"e{i}"])) for i in range(30)] + [(i, prose(i, 80)) for i in range(30, 60)] + [(3, "again"), (None, "x")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    plans, verified = [], orderhash._verified

    def seen(pairs, texts, least):
        plans.append(texts._jdf.queryExecution().executedPlan().toString())
        return verified(pairs, texts, least)

    monkeypatch.setattr(orderhash, "_verified", seen)
    classes = sorted(map(str, near_duplicates(table).collect()))
    assert plans and not any("hashpartitioning(doc" in p or "SortMergeJoin" in p for p in plans)
    docs, ids = table.withColumnRenamed("doc_id", "doc"), spark.createDataFrame([(i,) for i in range(0, 70, 3)], "doc long")
    want = sorted(map(str, docs.where("doc % 3 = 0").collect()))
    for asked, portions in ((500_000, 8), (5, 8), (5, 2)):
        monkeypatch.setattr(orderhash, "ASKED", asked)
        monkeypatch.setattr(orderhash, "PORTIONS", portions)
        assert sorted(map(str, orderhash._texts_of(docs, ids).collect())) == want
        assert sorted(map(str, near_duplicates(table).collect())) == classes

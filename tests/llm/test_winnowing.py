"""Fingerprints against a plain version of winnowing, and the guarantee of matches."""

import hashlib
import random

import pytest
from helpers import alnum_words, edge_documents, edge_rows, empty_documents, prose
from pyspark.sql import functions as F

from eventloom.llm import queries, winnowing


def plain_choice(grams, window):
    """Positions of the rightmost least gram of every window."""
    if not grams:
        return []
    size = min(window, len(grams))
    out = []
    for a in range(len(grams) - size + 1):
        low = min(grams[a : a + size])
        place = max(i for i in range(a, a + size) if grams[i] == low)
        if place not in out:
            out.append(place)
    return out


def grams_of(spark, words, gram):
    """The hashes of all grams by themselves, each from a text of its own."""
    if not words:
        return []
    runs = [words[i : i + gram] for i in range(max(len(words) - gram + 1, 1))]
    rows = spark.createDataFrame([(i, " ".join(r)) for i, r in enumerate(runs)], "i int, text string")
    got = rows.select("i", winnowing.winnow("text", gram, 1)["hashes"][0].alias("h")).collect()
    return [r.h for r in sorted(got)]


@pytest.mark.parametrize(("gram", "window"), [(1, 1), (2, 3), (5, 4), (7, 8), (3, 5)])
def test_positions_are_the_rightmost_least_ones(spark, gram, window):
    texts = [prose(1, 60), "a b a b a b a b a b a b a b a", "one", "one two", "", None, "x y z w v u", "Same, same; SAME same same same same same"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: r for r in winnowing.fingerprints(rows, gram=gram, window=window).collect()}
    for i, text in enumerate(texts):
        grams = grams_of(spark, alnum_words(text), gram)
        want = plain_choice(grams, window)
        assert got[i].positions == want
        assert got[i].hashes == [grams[p] for p in want]


def test_grams_differ_by_words_and_by_order(spark):
    texts = ["a b c d e", "a b c e d", "b a c d e", "a b c d f", "ab c d e", "a bc d e f", "e d c b a", "a b c d"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    hashes = [r.hashes[0] for r in winnowing.fingerprints(rows).collect()]
    assert len(set(hashes)) == len(texts)


def test_long_common_runs_are_always_found(spark):
    """Two texts with GRAM + WINDOW - 1 common words have a common fingerprint, and its positions lie in that run."""
    draw, run = random.Random(3), winnowing.GRAM + winnowing.WINDOW - 1
    pairs = []
    for i in range(150):
        common = prose(1000 + i, run)
        before, behind = draw.randrange(30), draw.randrange(30)
        a = f"{prose(2000 + i, before)} {common} {prose(3000 + i, draw.randrange(30))}"
        b = f"{prose(4000 + i, behind)} {common} {prose(5000 + i, draw.randrange(30))}"
        pairs.append((i, a, b, len(alnum_words(prose(2000 + i, before))), len(alnum_words(prose(4000 + i, behind)))))
    rows = spark.createDataFrame(pairs, "i int, a string, b string, at int, other int")
    for r in rows.select("*", winnowing.winnow("a").alias("x"), winnowing.winnow("b").alias("y")).collect():
        x, y = dict(zip(r.x.hashes, r.x.positions, strict=True)), dict(zip(r.y.hashes, r.y.positions, strict=True))
        shifts = {x[h] - r["at"] for h in x if h in y and x[h] - r["at"] == y[h] - r["other"]}
        assert any(0 <= s <= run - winnowing.GRAM for s in shifts)


def neighbours(rows):
    """(id, text, text of the next document by falling id) of every row; ids must differ."""
    order = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    return [(d, t, order[(i + 1) % len(order)][1]) for i, (d, t) in enumerate(order)]


@pytest.mark.parametrize("count", [1, 2, 3, 40, 401])
def test_next_documents(spark, count):
    rows = [(i * 3 - 50, f"text {i} " + "x" * (i % 7)) for i in range(count)]
    rows[0] = (None, None)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = winnowing.with_next(docs).where("not extra").select("doc_id", "text", "next_text").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, neighbours(rows)))


def test_rows_with_one_id_form_one_ring(spark):
    """A third of the rows without an id and many repeated ones: every row is the next one of exactly one row."""
    rows = [(None if i % 3 == 0 else i % 5, f"t{i % 40}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = winnowing.with_next(docs).where("not extra").collect()
    assert sorted((r.doc_id is None, r.doc_id, r.text) for r in got if r.doc_id is not None) == sorted(
        (False, d, t) for d, t in rows if d is not None
    )
    assert sorted(r.next_text for r in got) == sorted(t for _, t in rows)


def likeness(a, b):
    return 1.0 if not a and not b else len(set(a) & set(b)) / len(set(a) | set(b))


def test_audit_of_odd_rows(spark):
    docs = [(i, t, len(t or "")) for i, (t, *_) in enumerate([(r[1],) for r in edge_rows()])]
    frame = spark.createDataFrame(docs, "doc_id long, text string, hashes long")
    got = {r.doc_id: r for r in winnowing.edit_audit(frame).collect()}
    marks = {r.doc_id: r.hashes for r in winnowing.fingerprints(frame).collect()}
    want = neighbours([d[:2] for d in docs])
    edited = spark.createDataFrame(
        [(d, t[: len(t) - len(t) // 2] + n[: len(t) // 2]) for d, t, n in want], "doc_id long, text string"
    )
    edited_marks = {r.doc_id: r.hashes for r in winnowing.fingerprints(edited).collect()}
    after = {want[i][0]: want[(i + 1) % len(want)][0] for i in range(len(want))}
    assert len(got) == len(docs)
    for r in edited.collect():
        row = got[r.doc_id]
        assert row.edited == r.text
        assert row.n_chars == len(dict(d[:2] for d in docs)[r.doc_id] or "")
        assert row.hashes == marks[r.doc_id] and row.edited_hashes == edited_marks[r.doc_id]
        assert row.near_edited == pytest.approx(likeness(row.hashes, row.edited_hashes))
        assert row.near_next == pytest.approx(likeness(row.hashes, marks[after[r.doc_id]]))
    assert winnowing.edit_audit(edge_documents(spark)).count() == len(edge_rows())
    assert winnowing.edit_audit(empty_documents(spark)).collect() == []


def test_very_long_texts(spark):
    rows = [(1, prose(1, 150_000)), (2, "q" * 1_000_000), (3, "a " * 300_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in winnowing.edit_audit(docs).collect()}
    words = len(alnum_words(rows[0][1]))
    assert 0.3 * words < len(got[1].hashes) < 0.5 * words
    assert len(got[2].hashes) == 1 and got[2].near_edited == 0
    assert got[3].positions == list(range(3, 300_000 - 4)) and len(set(got[3].hashes)) == 1


def test_query(spark):
    """Equal texts have equal fingerprints; the edited text, half of which is the document's own, is nearer than the next one."""
    folder = "/root/testdata/sf0.001"
    got = queries.QUERIES["op11_winnowing"](spark, folder).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    ring = neighbours(list(texts.items()))
    edited = {d: t[: len(t) - len(t) // 2] + n[: len(t) // 2] for d, t, n in ring}
    assert sorted(r.doc_id for r in got) == sorted(texts)
    seen = {}
    for r in got:
        assert r.n_chars == len(texts[r.doc_id])
        assert r.edited_sha256 == hashlib.sha256(edited[r.doc_id].encode()).hexdigest()
        assert seen.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    long = [r for r in got if len(alnum_words(texts[r.doc_id])) >= 40]
    assert sum(r.near_edited > r.near_next for r in long) > 0.95 * len(long)
    plan = queries.QUERIES["op11_winnowing"](spark, folder)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_without_words_from_a_column_expression(spark):
    row = spark.range(1).select(winnowing.winnow(F.lit("... !")).alias("m"), winnowing.winnow(F.lit(None).cast("string")).alias("n")).first()
    assert row.m.hashes == [] and row.n.positions == []

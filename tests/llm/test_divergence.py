"""Source divergence against a plain version."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import edge_documents, edge_rows, empty_documents, prose

from eventloom.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string"


def terms_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)


def plain(rows, least=10, top=10):
    """All result rows for (text, lang, source) rows."""
    counts, spread = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        counts[lang or "", source or ""].update(terms_of(text))
        spread[lang or ""].update(set(terms_of(text)))
    out = []
    for lang in {k for k, _ in counts}:
        kept = [t for t, n in spread[lang].items() if n >= least]
        own = {s: c for (k, s), c in counts.items() if k == lang}

        def share(c, kept=kept):
            whole = sum(c[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 2) // whole for t in kept}

        p = {s: share(c) for s, c in own.items()}
        q = share(sum(own.values(), Counter()))
        for s in own:
            gap = {o: sum((p[s][t] - p[o][t]) ** 2 // (p[s][t] + p[o][t]) for t in kept) for o in own if o != s}
            pairs = sorted(gap.items(), key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, s, "pair", o, v, i) for i, (o, v) in enumerate(pairs, 1)]
            over = {t: (p[s][t] - q[t]) ** 2 // (p[s][t] + q[t]) for t in kept if own[s][t] and p[s][t] > q[t]}
            best = sorted(over.items(), key=lambda x: (-x[1], x[0].encode()))[:top]
            out += [(lang, s, "term", t, v, i) for i, (t, v) in enumerate(best, 1)]
    return sorted(out)


def found(frame):
    return sorted(tuple(r) for r in frame.collect())


@pytest.mark.parametrize("least", [1, 2, 10])
def test_odd_rows(spark, least):
    got = found(divergence.audit_sources(edge_documents(spark), least))
    assert got == plain([(r[1], r[2], r[3]) for r in edge_rows()], least)
    assert divergence.audit_sources(empty_documents(spark), least).collect() == []


def test_many_sources_ties_and_small_memory(spark, monkeypatch):
    """A hot source, sources with equal texts, one without terms; the tasks send and merge many small parts."""
    draw = random.Random(3)
    rows = []
    for i in range(600):
        source = "hot" if i % 3 == 0 else f"s{draw.randrange(12)}"
        rows.append((i, prose(i % 150, 30).replace("th", "þé") + (" Only" * 3 if source == "s3" else ""), draw.choice(["en", "de"]), source))
    rows += [(700 + i, t, "en", s) for i, (s, t) in enumerate([("twin1", "same the"), ("twin2", "same the"), ("bare", "123 ..."), ("bare2", None)])]
    monkeypatch.setattr(divergence, "HELD_ENTRIES", 50)
    monkeypatch.setattr(divergence, "REMEMBERED_BYTES", 200)
    monkeypatch.setattr(divergence, "PIECE_BYTES", 40)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5, "doc_id")
    got = found(divergence.audit_sources(docs, least=3, top=4))
    assert got == plain([r[1:] for r in rows], 3, 4)
    assert {r[1] for r in got if r[2] == "pair"} >= {"bare", "bare2", "hot"}


def test_galloping_finds_the_common_ids():
    draw = np.random.default_rng(1)
    for n, m in [(0, 5), (1, 1), (3, 1000), (50, 60), (400, 401), (1000, 7)]:
        for high in (30, 2000, 100_000):
            a, b = (np.unique(draw.integers(0, max(high, 1), k)) for k in (n, m))
            if len(a) > len(b):
                a, b = b, a
            i, j = divergence.gallop(a, b)
            assert (a[i] == b[j]).all()
            assert sorted(a[i].tolist()) == sorted(set(a.tolist()) & set(b.tolist()))


def test_shares_are_exact_for_very_large_counts():
    draw = random.Random(2)
    for _ in range(300):
        whole = draw.randrange(10, 9 * 10**15)
        counts = [draw.randrange(whole - 2) for _ in range(5)] + [0, whole - 2]
        got = divergence.shares(np.array(counts, dtype=np.int64), whole).tolist()
        assert got == [1 + 1_000_000_000 * (c + 2) // whole for c in counts]


def test_pair_value_counts_every_term_once():
    draw = random.Random(5)
    for _ in range(100):
        n = draw.randrange(1, 40)
        a, b = (Counter({t: draw.randrange(1, 9) for t in range(n) if draw.random() < s}) for s in (0.2, 0.8))
        sides = []
        for c in (a, b):
            whole = sum(c.values()) + 2 * n
            ids = np.array(sorted(c), dtype=np.int64)
            price = divergence.shares(np.array([c[t] for t in sorted(c)], dtype=np.int64), whole)
            sides += [ids, price, int(divergence.shares(np.zeros(1, dtype=np.int64), whole)[0])]
        want = 0
        for t in range(n):
            p, q = (1 + 1_000_000_000 * (c[t] + 2) // (sum(c.values()) + 2 * n) for c in (a, b))
            want += (p - q) ** 2 // (p + q)
        assert divergence.pair_value(*sides, n) == want

"""Suffix sorting, exact substring dedup, and paragraph bands."""

import numpy as np
import pyarrow as pa
from helpers import alnum_words, edge_documents, edge_rows, empty_documents, prose, removed_by_brute_force

from eventloom.llm import paragraphs, suffixes
from eventloom.llm.paragraphs import Paragraphs, repeated_passages, similar_paragraphs
from eventloom.llm.queries import QUERIES
from eventloom.llm import spans

SMALL = "/root/testdata/sf0.001"


def test_two_stage_order_and_prefixes():
    draw = np.random.default_rng(5)
    for _ in range(150):
        n, k = int(draw.integers(1, 300)), int(draw.integers(1, 5))
        text = draw.integers(97, 97 + k, n).astype(np.uint8)
        text[draw.random(n) < 0.05] = 255
        words = suffixes.words_of(text, 12)
        order = suffixes.suffix_array(text, words, 12)
        assert sorted(order.tolist()) == list(range(n))
        whole = [bytes(text[i : i + 12]).ljust(12, b"\0") for i in order]
        assert whole == sorted(whole)
        wanted = draw.random(n) < 0.3
        some = suffixes.suffix_array(text, words, 12, wanted)
        assert len(set(some.tolist())) == len(some) and set(np.flatnonzero(wanted)) <= set(some.tolist())
        heads = [bytes(text[i : i + 12]).ljust(12, b"\0") for i in some]
        assert heads == sorted(heads)
        shared = suffixes.common_prefixes(words, order, 12)
        for j in range(1, n):
            same = next((i for i in range(12) if whole[j][i] != whole[j - 1][i]), 12)
            assert same == shared[j]


def digest(frame):
    return sorted((tuple(r) for r in suffixes.span_digest(frame).collect()), key=lambda r: (r[0] is not None, r))


def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in QUERIES["op8_suffix_dedup"](spark, SMALL).collect()) == removed_by_brute_force(rows)


def test_many_buckets_and_windows_dealt_by_content(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "SPREAD_REGIONS", 2)
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", 100_000)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert digest(suffixes.repeated_spans(docs)) == removed_by_brute_force(rows)


def test_regions_of_one_gram_whose_codes_agree_in_half_their_bits(spark):
    """Different texts around one gram, found by their codes, are not equal."""
    draw = np.random.default_rng(3)
    grams = draw.integers(97, 123, (500_000, 16)).astype(np.uint8)
    at = np.arange(0, grams.size, 16)
    gram = grams[np.argmin(spans.span_hash(spans.prefix_sums(grams.reshape(-1)), at, at + 16))]
    block = draw.integers(97, 123, (300_000, 51)).astype(np.uint8)
    block[:, 17:33], block[:, 50] = gram, 10
    r = suffixes.Regions(block.reshape(-1), np.arange(0, block.size + 1, 51), 50, 16)
    low = np.stack([r.gram, r.code & np.uint64(2**32 - 1)])
    order = np.lexsort(low)
    again = np.flatnonzero((np.diff(low[:, order], axis=1) == 0).all(axis=0))
    assert len(again)
    texts = [block[r.text[order[again[0] + i]], :50].tobytes().decode() for i in (0, 1)]
    assert texts[0] != texts[1]
    rows = [(i + 1, t) for i, t in enumerate(texts)]
    found = digest(suffixes.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")))
    assert found == removed_by_brute_force(rows)


def asked_regions(texts):
    """Records of the regions of ``texts``, and how many of them are asked for their bytes."""
    batch = pa.record_batch({"doc": pa.array(range(len(texts)), pa.int64()), "text": texts})
    records = pa.Table.from_batches(suffixes._sender(50, 20, 1, 1, False)(iter([batch])), suffixes.BLOBS_ARROW)
    sent = suffixes.unpack([b for b, k in zip(records["blob"].to_pylist(), records["kind"].to_pylist()) if k == 0], ("doc",), **suffixes._SENT)
    told = suffixes.unpack(suffixes._decider(1)(records)["blob"].to_pylist(), ("doc",), **suffixes._ANSWER)
    return len(sent["doc"]), int((told["state"] >= suffixes._COMPARE).sum())


def test_grams_that_meet_by_chance_are_not_compared():
    """Texts with common phrases of 30 bytes: no window of 50 is equal, and no bytes are asked for. With 49 bytes they are."""
    draw = np.random.default_rng(11)

    def texts(common):
        words = [draw.integers(97, 123, common).astype(np.uint8).tobytes().decode() for _ in range(5)]
        made = []
        for _ in range(200):
            around = draw.integers(97, 123, (6, 40)).astype(np.uint8)
            made.append("".join(x.tobytes().decode() + w for x, w in zip(around, [*draw.permutation(words), ""], strict=True)))
        return made

    records, asked = asked_regions(texts(30))
    assert records > 4000 and asked == 0
    assert asked_regions(texts(49))[1] > 100


def test_equal_strings_wherever_their_gram_stands(spark, monkeypatch):
    """Equal strings of 45 to 70 bytes at any place, texts of short periods (a gram comes more than once in a window), and runs of one byte."""
    draw = np.random.default_rng(12)
    pool = [draw.integers(97, 105, 70).astype(np.uint8).tobytes().decode() for _ in range(20)]
    pool += [(draw.integers(97, 100, int(draw.integers(1, 33))).astype(np.uint8).tobytes().decode() * 70)[:70] for _ in range(20)]
    rows = []
    for doc in range(250):
        parts = []
        for _ in range(int(draw.integers(1, 6))):
            own, size = pool[int(draw.integers(len(pool)))], int(draw.integers(45, 71))
            begin = int(draw.integers(0, 71 - size))
            parts.append(draw.integers(97, 105, int(draw.integers(0, 40))).astype(np.uint8).tobytes().decode() + own[begin : begin + size])
        rows.append((doc, "".join(parts)))
    want = removed_by_brute_force(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert digest(suffixes.repeated_spans(docs)) == want
    monkeypatch.setattr(suffixes, "SPREAD_REGIONS", 3)
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", 2_000)
    monkeypatch.setattr(suffixes, "ROOT_BYTES", 6_000)  # the buckets are compared in cuts
    assert digest(suffixes.repeated_spans(docs)) == want


def test_odd_rows(spark):
    docs = edge_documents(spark)
    runs = [(20, "ab" * 300), (21, "x" + "ab" * 100 + "=" * 200), (22, "=" * 120 + "ab" * 40), (23, "=" * 49)]
    more = spark.createDataFrame([(d, t, None, None, None, "k", 1, 0.0) for d, t in runs], docs.schema)
    found = suffixes.repeated_spans(docs.unionByName(more))
    smallest = -(10**9)
    rows = [(smallest if r[0] is None else r[0], r[1]) for r in edge_rows()] + runs
    assert digest(found) == [(None if d == smallest else d, *rest) for d, *rest in removed_by_brute_force(rows)]
    kept = suffixes.without_spans(more, found, "doc_id", "text").collect()
    assert {r.doc_id: len(r.kept) for r in kept}[20] == 600
    assert digest(suffixes.repeated_spans(empty_documents(spark))) == []


def test_every_long_passage_is_found(spark):
    """A run of 51 words that an earlier document has too is hit, wherever it stands."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    found = {r.doc_id: r for r in QUERIES["op5_paragraph_bands"](spark, SMALL).collect()}
    first: dict[tuple, int] = {}
    need = set()
    for doc, text in sorted(rows):
        words = alnum_words(text)
        for i in range(len(words) - 50):
            run = tuple(words[i : i + 51])
            if first.setdefault(run, doc) < doc:
                need.add(doc)
    assert need and all(found[d].n_paragraphs and found[d].kept_in for d in need)
    # What is hit has 25 words in common with an earlier text, or is nearly a short one.
    assert len({d for d, r in found.items() if r.n_paragraphs}) < 0.3 * len(rows)


def test_passage_alignment():
    """The same paragraphs of a passage, whatever stands around it."""
    passage = prose(2, 51)
    for before in range(0, 60, 7):
        texts = [f"{prose(70, before)} {passage} {prose(71, 30)}", f"{prose(72, 40)} {passage}"]
        p = Paragraphs(*spans.packed(texts))
        assert set(p.code[p.text == 0]) & set(p.code[p.text == 1])


def test_paragraphs_of_odd_rows(spark):
    docs = edge_documents(spark)
    found = {r.doc_id: r for r in repeated_passages(docs).collect()}
    assert set(found) == {r[0] for r in edge_rows()}
    assert found[2].kept_in == [1] and found[8].kept_in == [7] and found[3].kept_in == [1]
    clean = [1, 4, 5, 6, 7, 9, 10, 11, 13, None]
    assert all(found[d].n_paragraphs == 0 and found[d].spans == [] for d in clean)
    assert repeated_passages(empty_documents(spark)).count() == 0


def test_edited_paragraph_is_verified(spark):
    """One word of a long text changed: the paragraphs around it are near, not equal, and belong together."""
    words = prose(21, 200).split()
    other = list(words)
    other[100] = "changed"
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(other)), (3, prose(22, 200))], "doc_id long, text string")
    found = {r.doc_id: r for r in repeated_passages(docs).collect()}
    assert found[2].kept_in == [1] and not found[1].n_paragraphs and not found[3].n_paragraphs


def test_many_texts_of_one_id(spark):
    """Hundreds of different texts without an id or with one id, two of which agree in 16 bits of a checksum."""
    import zlib

    by_sum, pair = {}, None
    for i in range(2000):
        text = prose(7000 + i, 20)
        other = by_sum.setdefault(zlib.crc32(text.encode()) & 0xFFFF, text)
        if other != text:
            pair = (other, text)
            break
    assert pair
    common = prose(6999, 12)
    rows = [(1, pair[0]), (2, pair[0]), (2, pair[1])]
    rows += [(None, f"{prose(8000 + i, 15)} {common if i % 7 == 0 else ''}") for i in range(500)]
    rows += [(3, f"{prose(9000 + i, 9)} {common}") for i in range(40)]
    smallest = -(10**9)
    found = digest(suffixes.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)))
    want = removed_by_brute_force([(smallest if d is None else d, t) for d, t in rows])
    assert found == [(None if d == smallest else d, *rest) for d, *rest in want]


def changed_passages(count, size, changes, seed):
    """Pairs of texts with a passage of ``size`` words each, the second one with some words changed, and other words around."""
    import random

    draw = random.Random(seed)
    rows = []
    for i in range(count):
        words = prose(100_000 + seed * 1000 + i, size).split()
        other = list(words)
        for at in draw.sample(range(size), changes):
            other[at] = f"changed{i}x{at}"
        for k, own in enumerate((words, other)):
            around = [prose(200_000 + seed * 10_000 + 4 * i + 2 * k + j, draw.randrange(10, 60)) for j in (0, 1)]
            rows.append((2 * i + k + 1, f"{around[0]} {' '.join(own)} {around[1]}"))
    return rows


def test_recall_of_passages(spark):
    """Exact passages of 40 words, and of 60 and 100 words with changes that leave a shingle similarity of 0.8."""
    for size, changes, least in ((40, 0, 0.99), (60, 1, 0.9), (100, 2, 0.9)):
        rows = changed_passages(300, size, changes, size)
        found = {r.doc_id: r for r in repeated_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()}
        hit = sum(found[2 * i + 2].kept_in == [2 * i + 1] for i in range(300))
        assert hit >= least * 300, (size, changes, hit)
        assert not any(found[2 * i + 1].n_paragraphs for i in range(300))


def test_links_against_all_pairs(spark):
    """Paragraphs of short texts (each a paragraph by itself) around a common lead: what Jaccard similarity joins, the links join."""
    import random

    draw = random.Random(9)
    rows, shingles = [], {}
    for family in range(12):
        base = prose(300_000 + family, 24).split()
        for _ in range(12):
            words = list(base)
            for at in draw.sample([0, 1, 22, 23], draw.randrange(3)):
                words[at] = f"w{draw.randrange(10**6)}"
            doc = len(rows) + 1
            rows.append((doc, " ".join(words)))
            alnum = alnum_words(rows[-1][1])
            shingles[doc] = {tuple(alnum[i : i + 5]) for i in range(len(alnum) - 4)}
    group = {d: d for d in shingles}

    def root(d):
        while group[d] != d:
            d = group[d]
        return d

    for a in shingles:
        for b in shingles:
            if a < b and len(shingles[a] & shingles[b]) >= 0.8 * len(shingles[a] | shingles[b]):
                x, y = sorted((root(a), root(b)))
                group[y] = x
    found = {r.doc_id: r for r in repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = {d: root(d) for d in shingles}
    right = sum((found[d].kept_in or [d]) == [want[d]] for d in want)
    assert right >= 0.9 * len(want), right
    # Nothing is joined that similarity does not join.
    assert all(root(found[d].kept_in[0]) == root(d) for d in want if found[d].kept_in)


def linked(spark, texts):
    """Classes of the paragraphs by the links, and by all pairs that share a band and are similar by brute force."""
    docs = spark.createDataFrame(list(enumerate(texts)), "doc long, text string")
    p = Paragraphs(*spans.packed(texts))
    codes, bands = p.code.tolist(), np.stack(p.bands())
    sets = [set(p.shingles(i).tolist()) for i in range(len(codes))]

    def classes(links):
        top = {c: c for c in codes}
        for a, b in links:
            high, low = max(top[a], top[b]), min(top[a], top[b])
            if high != low:
                top = {c: low if t == high else t for c, t in top.items()}
        return top

    pairs = [
        (codes[i], codes[j])
        for i in range(len(codes))
        for j in range(i)
        if p.text[i] != p.text[j] and (bands[:, i] == bands[:, j]).any() and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
    ]
    return classes([tuple(r) for r in similar_paragraphs(docs).collect()]), classes(pairs), len(pairs)


def test_no_pair_of_a_band_is_left_out(spark):
    """Texts around one common lead, and of each a copy with other last words: all meet in a value, where the smallest is like few."""
    lead = prose(40, 13)
    texts = [f"{lead} {prose(700 + i, 9)}" for i in range(300)]
    texts += [" ".join([*t.split()[:-2], f"end{i}", f"last{i}"]) for i, t in enumerate(texts)]
    found, wanted, pairs = linked(spark, texts)
    assert pairs > 200 and found == wanted


def test_a_band_value_of_very_many_similar_paragraphs(spark):
    base = [f"w{i}" for i in range(24)]
    texts = []
    for family in range(5):
        for i in range(60):
            own = [f"f{family}x{k}" if k < 2 * family else w for k, w in enumerate(base)]
            texts.append(" ".join([*own[:-1], f"end{family}x{i}"] if i else own))
    found, wanted, pairs = linked(spark, texts)
    assert pairs > 5000 and found == wanted
    # The pairs of such a value are not all sent.
    bits = Paragraphs(*spans.packed(texts))
    own = {"value": np.zeros(300, "<u4"), "code": bits.code, "doc": np.arange(300), "bits": bits.bits(), "size": np.full(300, 20, "u1"), "many": np.zeros(300, "u1")}
    blob = [b for _, _, b in paragraphs.dealt(np.zeros(300, np.int64), 0, {k: v.astype(paragraphs._BAND[k]) for k, v in own.items()}, ("doc",))]
    made = paragraphs._pairer(pa.table({"blob": blob}))
    assert made.column("lead").null_count == 300 and len(made) <= 600


def test_links_of_a_block_are_fewer_than_its_members():
    """Three hundred paragraphs of five families, each a class of its own: the classes of all similar pairs, by a link for each that joins two."""
    base = [f"w{i}" for i in range(24)]
    texts = [" ".join([*(f"f{f}x{k}" if k < 2 * f else w for k, w in enumerate(base[:-1])), f"end{f}x{i}"]) for f in range(5) for i in range(60)]
    p = Paragraphs(*spans.packed(texts))
    sets = [set(p.shingles(i).tolist()) for i in range(300)]
    table = pa.table(
        {
            "code": p.code, "doc": np.arange(300), "bits": p.bits().view(np.int64), "size": p.size - 4, "many": np.zeros(300, np.int64), "class": p.code,
            "part": np.zeros(300, np.int32), "other": np.zeros(300, np.int32), "shingles": pa.array([p.shingles(i).view(np.int64) for i in range(300)]),
        }
    )
    links = paragraphs._across(table)

    def classes(pairs):
        top = list(range(300))
        for a, b in pairs:
            high, low = max(top[a], top[b]), min(top[a], top[b])
            top = [low if t == high else t for t in top]
        return top

    at = {c: i for i, c in enumerate(p.code.tolist())}
    similar = [(i, j) for i in range(300) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    found = [(at[a], at[b]) for a, b in zip(links.column("a").to_pylist(), links.column("b").to_pylist())]
    assert len(similar) > 5000 and len(found) < 300 and classes(found) == classes(similar)

"""Token files, tokenised pieces, and quality rules."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import edge_documents, edge_rows, empty_documents

from eventloom.llm import fertility, spans, tokenfiles, tokens
from eventloom.llm.queries import QUERIES
from eventloom.llm.tokens import PieceEncoder, public_path

SMALL = "/root/testdata/sf0.001"


def test_blocks_round_trip():
    draw = np.random.default_rng(0)
    for n in (0, 1, 5, 511, 512, 513, 3000):
        for high in (1, 2, 300, 50257, 2**32):
            ids = draw.integers(0, high, n, dtype=np.uint64).astype(np.uint32)
            if n > 10:
                ids[::17] = draw.integers(0, 2**32, len(ids[::17]), dtype=np.uint64)
            file = tokenfiles.TokenFile(tokenfiles.encode_file(ids, np.array([1, 2]), np.array([n, 0])))
            assert (file.ids() == ids).all() and (file.ids(3, 700) == ids[3:700]).all()


def test_outliers_cost_exceptions_not_width():
    ids = np.arange(512, dtype=np.uint32) % 16
    ids[::50] = 50_000
    offsets, body = tokenfiles.packed_blocks(ids)
    assert body[offsets[0] + 4] == 4 and len(body) == 7 + 512 // 2 + 6 * 11


def test_pieces_equal_the_library():
    encoder = PieceEncoder(public_path("byte_bpe_50k.json"), remembered=500)
    draw = np.random.default_rng(1)
    marks = [32, 32, 32, 10, 39, 115, 116, 97, 98, 49, 33, 233, 0xA0, 0x3000, 0x4E2D, 0x85, 0x2028, 0x1F600, 9, 13, 0x1C, 0x200B]
    texts = ["", "a", "don't  <|endoftext|> x y", "x's 'tis ''s \t a", "\n", " ", "é è\xa0 a", *[r[1] or "" for r in edge_rows()]]
    texts += ["".join(chr(c) for c in draw.choice(marks, 30)) for _ in range(1500)]
    got = []
    for i in range(0, len(texts), 200):
        ids, counts = encoder(*spans.packed(texts[i : i + 200]))
        got += [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    assert got == [e.ids for e in encoder.library.encode_batch(texts, add_special_tokens=False)]


def expected_tokens(rows):
    library = PieceEncoder(public_path("byte_bpe_50k.json")).library
    out, start = [], 0
    for doc, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        out.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_query_against_the_library(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in QUERIES["op4_token_files"](spark, SMALL).collect())
    assert got == expected_tokens(sorted(rows))


def test_files_of_odd_rows(spark):
    files = tokenfiles.write_token_files(edge_documents(spark), file_ids=1000)
    got = sorted((tuple(r) for r in tokenfiles.read_token_files(files).collect()), key=lambda r: r[1])
    rows = sorted(((r[0], r[1]) for r in edge_rows()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert got == expected_tokens(rows)
    assert files.count() > 1
    none = tokenfiles.write_token_files(empty_documents(spark))
    assert none.count() == 0 and tokenfiles.read_token_files(none).count() == 0


def base_figures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows: dict[tuple, list[int]] = {}
    for i in range(len(words) - 4):
        windows.setdefault(tuple(words[i : i + 5]), []).append(i)
    repeated = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
    return len(words), sum(map(len, words)), symbols, again, len(repeated), failed


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_counts_of_the_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op6_tokeniser_fertility"](spark, SMALL).collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert tuple(row[c] for c in COUNTS) == base_figures(texts[row.doc_id])
        assert not (row.kept and row.base_failed)


def test_quality_labels_follow_the_verdict(spark):
    folder = "/root/testdata/sf0.01"
    judged = QUERIES["op6_tokeniser_fertility"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    good = judged.where("quality = 1 and not base_failed")
    bad = judged.where("quality = 0")
    assert good.where("kept").count() == good.count()
    assert bad.where("not kept").count() > 0.6 * bad.count()


def test_quality_of_odd_rows(spark):
    docs = edge_documents(spark)
    found = fertility.judge_quality(docs).collect()
    assert len(found) == docs.count()
    texts = {(r[0], r[1]) for r in edge_rows()}
    figures = {doc: base_figures(text) for doc, text in texts}
    for row in found:
        assert tuple(row[c] for c in COUNTS) == figures[row.doc_id]
    kept = fertility.of_quality(docs)
    assert kept.columns == docs.columns and {r.kept for r in kept.collect()} == {"mine"}
    assert {1, 2, 3, 7, 8} <= {r.doc_id for r in kept.collect()}
    assert fertility.judge_quality(empty_documents(spark)).count() == 0
    assert fertility.judge_quality(docs.drop("lang")).count() == docs.count()


def test_entropy_of_windows():
    flat = fertility._entropies(np.arange(640), np.array([640]))
    same = fertility._entropies(np.zeros(640, dtype=np.int64), np.array([640]))
    mixed = fertility._entropies(np.array([1, 1, 2, 2, 7]), np.array([4, 0, 1]))
    assert flat.tolist() == [1.0] and same.tolist() == [0.0] and mixed.tolist() == [0.5, 1.0, 1.0]


ODD = ["a", "b", " ", "  ", "\n", "\n\n", "é", "中", "'s", "it's", "\u2581", "<s>", "<|endoftext|>", "1", "23", "!", "\t", "\r\n", ".", "Ж", "\x85", "😀", "the "]


def odd_texts(count):
    draw = random.Random(count)
    return ["".join(draw.choices(ODD, k=draw.randrange(12))) for _ in range(count)] + [None, "", " ", "  ", "\n", " \n", "\n "]


@pytest.mark.parametrize("remembered", [1_000_000, 60])
def test_pieces_and_units_add_up_to_the_libraries_whole_texts(remembered):
    """Ids and byte counts of texts put together from remembered parts, however often the memory starts anew."""
    texts = odd_texts(3000) + [r[1] for r in edge_rows()]
    encoder = tokens.PieceEncoder(public_path("byte_bpe_50k.json"), remembered)
    counter = tokens.FallbackCounter(public_path("piece_bpe_32k.model"), remembered)
    assert encoder.parts and counter.parts
    want_ids = [e.ids for e in encoder.library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    want = [[len(x), int(counter.spelt[x].sum()) if x else 0] for x in counter.pieces.encode([t or "" for t in texts])]
    got_ids, got = [], []
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    for _, buf, starts in spans.blocks([batch], limit=5000):
        ids, counts = encoder(buf, starts)
        got_ids += [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
        got += counter(buf, starts).tolist()
    assert got_ids == want_ids
    assert got == want


def test_memory_tells_keys_apart_by_both_hashes():
    memory = tokens.Memory()
    draw = np.random.default_rng(1)
    first, second = draw.integers(0, 50, 5000).astype(np.uint64), draw.integers(0, 500, 5000).astype(np.uint64)
    where, which = tokens.distinct_keys(first, second)
    assert len(where) == len(set(zip(first.tolist(), second.tolist(), strict=True)))
    slots = np.concatenate([memory.add(first[part], second[part]) for part in np.array_split(where, 9)])
    assert (memory.find(first, second) == slots[which]).all()
    assert (memory.find(first, second + np.uint64(1000)) == -1).all()

"""Odd rows of the decontamination and of the url cascade."""

from helpers import edge_documents, edge_rows, empty_documents, prose

from eventloom.llm import urls
from eventloom.llm.contamination import contamination_digest, decontaminated, find_contamination


def benchmark(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, doc_id string")


ITEMS = [(5, prose(2, 60), "x"), (5, prose(2, 60), "x"), (7, "Two THREE", "x"), (8, None, "x"), (9, "", "x"), (None, "one", "x")]


def test_hits_spans_and_portions(spark):
    docs = edge_documents(spark)
    whole = {(r.doc_id, r.n_words): r for r in find_contamination(docs, benchmark(spark, ITEMS)).collect()}
    by_id = {k[0]: r for k, r in whole.items()}
    assert by_id[7].items == ["5"] and by_id[7].n_hit == 60 and by_id[7].contaminated
    assert by_id[11].items == ["7"] and by_id[11].n_hit == 2
    assert by_id[4].n_words == by_id[5].n_words == 0 and not by_id[4].contaminated
    assert not by_id[9].contaminated
    # Several portions, each with a broadcast of its own, find the same.
    parts = find_contamination(docs, benchmark(spark, ITEMS), windows_per_pass=1)
    assert {(r.doc_id, r.n_words): r for r in parts.collect()} == whole
    assert len(contamination_digest(parts).collect()) == docs.count()


def test_empty_tables(spark):
    docs = edge_documents(spark)
    assert find_contamination(empty_documents(spark), benchmark(spark, ITEMS)).count() == 0
    clean = find_contamination(docs, benchmark(spark, []))
    assert clean.count() == docs.count() and clean.where("contaminated").count() == 0


def test_passages_are_cut_out(spark):
    docs = edge_documents(spark)
    kept = decontaminated(docs, benchmark(spark, ITEMS))
    assert kept.columns == docs.columns
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert 11 not in texts and 8 not in texts  # mostly test passages
    given = {r[0]: r[1] for r in edge_rows()}
    assert texts[7] == given[7].replace(prose(2, 60).rstrip("."), "")
    assert all(texts[d] == given[d] for d in texts if d != 7)


def test_cascade_is_exact(spark):
    from pyspark.sql import functions as F

    universe = spark.range(5000).select(F.xxhash64("id").alias("key"))
    listed = spark.range(0, 7000, 7).select(F.xxhash64("id").alias("key"))
    levels = urls.build_cascade(listed, universe)
    asked = universe.toPandas()["key"].to_numpy().view("uint64")
    true = {r.key for r in listed.collect()}
    assert urls.member(levels, asked).tolist() == [int(k) in true for k in asked.view("int64")]
    assert len(levels) > 2
    assert urls.build_cascade(listed.limit(0), universe) == []


def test_odd_urls(spark):
    rows = [
        (1, "HTTP://A.Example.NET/en/x?y#z", "h"),
        (2, "https://example.net/EN/x", "h"),
        (3, "no scheme", "h"),
        (4, None, None),
        (5, "x://y://net/", "h"),
        (6, "s://a.org/fr/1", "h"),
        (6, "s://a.org/fr/1", "h"),
        (7, "s://notexample.com/de/", "h"),
        (8, "s://b.example.com/de/", "h"),
        (9, "s://net", "h"),
        (10, "", "h"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string")
    rules = urls.rule_table(
        spark, [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
    )
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(pages, rules).collect()}
    assert found == {
        1: ("a.example.net", "/en/x", "example.net/en/", "allow"),
        2: ("example.net", "/EN/x", "net/", "block"),
        3: ("", "", None, "allow"),
        4: ("", "", None, "allow"),
        5: ("y:", "//net/", None, "allow"),
        6: ("a.org", "/fr/1", "org/fr/", "allow"),
        7: ("notexample.com", "/de/", None, "allow"),
        8: ("b.example.com", "/de/", "example.com/de/", "block"),
        9: ("net", "", None, "allow"),
        10: ("", "", None, "allow"),
    }
    assert urls.judge_urls(pages.limit(0), rules).count() == 0
    assert urls.judge_urls(pages, rules.limit(0)).where("verdict = 'allow'").count() == len(rows)


def test_long_lists_are_split(spark, monkeypatch):
    monkeypatch.setattr(urls, "CASCADE_BITS", 64 * 20)
    pages = spark.createDataFrame([(i, f"http://h{i}.net/p") for i in range(120)], "page_id long, url string")
    rules = urls.rule_table(spark, [("block", f"h{i}.net/") for i in range(0, 120, 2)])
    found = {r.page_id: r.verdict for r in urls.judge_urls(pages, rules).collect()}
    assert found == {i: "block" if i % 2 == 0 else "allow" for i in range(120)}


def test_very_long_hosts_and_paths(spark):
    """A host of 20,000 labels and a path of a megabyte; only as many labels as the longest rule has are looked at."""
    long_host = "a." * 20_000 + "shop.net"
    pages = spark.createDataFrame(
        [(1, f"http://{long_host}/x"), (2, "http://m.org/en/" + "p" * 1_000_000), (3, "http://shop.net./x"), (4, "http://.net/"), (5, "http://x.y.z.shop.net/")],
        "page_id long, url string",
    )
    rules = urls.rule_table(spark, [("block", "shop.net/"), ("allow", "m.org/en/"), ("block", "y.z.shop.net/"), ("block", "net/")])
    got = {r.page_id: (r.rule, r.verdict) for r in urls.judge_urls(pages, rules).collect()}
    assert got == {
        1: ("shop.net/", "block"),
        2: ("m.org/en/", "allow"),
        3: (None, "allow"),
        4: ("net/", "block"),
        5: ("y.z.shop.net/", "block"),
    }

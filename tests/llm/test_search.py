"""URL filter, exact top-k search and decontamination."""

import math
import random
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from plantflow.llm import decontaminate, topk, url_filter
from plantflow.llm.queries import RULES

URLS = {
    "http://NET/": ("net", "/", "net/", "block"),
    "http://net": ("net", "", None, "allow"),
    "x": ("", "", None, "allow"),
    None: ("", "", None, "allow"),
    "": ("", "", None, "allow"),
    "http://a.example.net/en/?q": ("a.example.net", "/en/", "example.net/en/", "allow"),
    "ftp://example.com/de/x#y/z": ("example.com", "/de/x", "example.com/de/", "block"),
    "http://myexample.net/en/": ("myexample.net", "/en/", "net/", "block"),
    "://b.org/fr/": ("b.org", "/fr/", "org/fr/", "allow"),
    "http://example.net?/en/": ("example.net", "", None, "allow"),
    "a b://é.NET/é\nx?": ("é.net", "/é\nx", "net/", "block"),
    "http://x..net/" + "y" * 5000: ("x..net", "/" + "y" * 5000, "net/", "block"),
}


def test_url_filter(spark, rows):
    pages = [(i, u) for i, u in enumerate(URLS)] + [(0, "http://NET/"), (None, "x")]
    frame = spark.createDataFrame(pages, "page_id long, url string").select("*", F.lit("q").alias("key"), F.lit(1).alias("host"))
    want = [(i, *URLS[u]) for i, u in pages]
    assert rows(url_filter.judge(frame, RULES)) == sorted(want, key=repr)
    assert url_filter.judge(frame.limit(0), RULES).collect() == []
    assert {r.verdict for r in url_filter.judge(frame, []).collect()} == {"allow"}


def test_longest_rule_wins(spark):
    rules = [url_filter.Rule("block", "a.b", "/"), url_filter.Rule("allow", "b", "/xy/"), url_filter.Rule("block", "a.b", "/xy/")]
    frame = spark.createDataFrame([(1, "z://a.b/xy/1"), (2, "z://c.b/xy/"), (3, "z://q.a.b/x")], "page_id long, url string")
    assert {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(frame, rules).collect()} == {
        1: ("a.b/xy/", "block"),
        2: ("b/xy/", "allow"),
        3: ("a.b/", "block"),
    }


def test_cascade_is_exact(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = [f"k{i}" for i in random.Random(1).sample(range(20_000), 700)]
    levels = url_filter.cascade(keys, listed)
    assert len(levels) > 2
    assert {r.key for r in keys.where(url_filter.listed(F.col("key"), levels)).collect()} == set(listed)
    assert url_filter.cascade(keys, []) == []


def test_a_level_has_a_bound(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "MAX_BITS", 64)
    keys = spark.range(500).select(F.concat(F.lit("k"), "id").alias("key"))
    with pytest.raises(ValueError):
        url_filter.cascade(keys, [f"k{i}" for i in range(100)])


def brute(vectors, every, k):
    usable = [
        (i, [math.floor(256 * x) for x in v])
        for i, v in vectors
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a, (q, left) in enumerate(usable):
        if q % every:
            continue
        scores = [
            (-max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(left, right)))), i)
            for b, (i, right) in enumerate(usable)
            if a != b and len(left) == len(right)
        ]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def test_topk(spark, rows):
    rng = np.random.default_rng(2)
    vectors = [(i, rng.normal(0, 0.3, 6).tolist()) for i in range(300)]
    vectors += [(i, [0.25, 0.5, 0.5, 0.0, 0.0, 0.0]) for i in range(400, 420)]  # ties
    vectors += [(10, vectors[10][1]), (10, vectors[10][1]), (20, vectors[3][1])]  # repeated rows and ids
    vectors += [(None, vectors[0][1]), (500, None), (510, [None] * 6), (520, [float("nan")] * 6), (530, [math.inf] * 6)]
    vectors += [(540, [1e17] * 6), (541, [1e17] * 6), (542, [-1e17] * 6), (550, [0.5, 0.5]), (560, [0.25, 0.5]), (570, []), (580, [])]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(5)
    frame = frame.select("*", F.lit(1).alias("rank"), F.lit(1).alias("cells"))
    assert rows(topk.search(frame, F.col("vec_id") % 10 == 0, 5)) == brute(vectors, 10, 5)
    assert topk.search(frame.limit(0), F.col("vec_id") % 10 == 0).collect() == []


def test_queries_in_blocks(spark, rows, monkeypatch):
    vectors = [(i, np.random.default_rng(i).normal(0, 1, 4).tolist()) for i in range(120)]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    monkeypatch.setattr(topk, "BLOCK_BYTES", 8 * 4 * 7)
    assert rows(topk.search(frame, F.col("vec_id") % 4 == 0, 3)) == brute(vectors, 4, 3)


# ---- decontamination


def slow_tiles(item, text, least):
    """Greedy string tiling as first defined: every time the longest matches of unmarked tokens."""
    used_item, used_text, total = [False] * len(item), [False] * len(text), 0
    while True:
        best, found = least, []
        for i in range(len(item)):
            for j in range(len(text)):
                n = 0
                while (
                    i + n < len(item) and j + n < len(text) and item[i + n] == text[j + n]
                    and not used_item[i + n] and not used_text[j + n]
                ):
                    n += 1
                if n > best:
                    best, found = n, [(i, j)]
                elif n == best:
                    found.append((i, j))
        if not found:
            return total
        for i, j in found:
            if not any(used_item[i : i + best]) and not any(used_text[j : j + best]):
                used_item[i : i + best] = used_text[j : j + best] = [True] * best
                total += best


@pytest.mark.parametrize("seed", range(12))
def test_tiles_equal_the_plain_definition(seed):
    rng = random.Random(seed)
    item = [rng.randrange(40) for _ in range(60)]
    cut = sorted(rng.sample(range(60), 4))
    pieces = [item[i:j] for i, j in zip([0, *cut], [*cut, 60])]
    rng.shuffle(pieces)
    text = [t for p in pieces for t in [*p, *[rng.randrange(40) for _ in range(rng.randrange(5))]]]
    found = decontaminate.tiles(item, text, 3)
    assert sum(n for _, _, n in found) == slow_tiles(item, text, 3)
    assert all(item[i : i + n] == text[j : j + n] for i, j, n in found)
    for side in (0, 1):
        places = [f[side] + k for f in found for k in range(f[2])]
        assert len(places) == len(set(places))


def test_decontamination(spark, rows, sf_dir):
    words = lambda n, seed: " ".join(f"t{random.Random(seed * 1000 + i).randrange(10**6)}" for i in range(n))
    items = [(1, words(40, 1)), (2, words(40, 2)), (3, "one two three"), (None, words(30, 3)), (5, None)]
    first, second = items[0][1].split(), items[1][1].split()
    moved = " ".join([*second[27:], "x", *second[:13], "y", "z", *second[13:27]])
    docs = [
        (1, f"{words(300, 9)} {items[0][1].upper()}! {words(100, 8)}", True, 1),
        (2, f"{words(30, 7)}\n{moved}", True, 2),
        (3, " ".join(first[:12]) + words(500, 6), False, None),
        (4, None, False, None),
        (5, "", False, None),
        (6, "one two three", False, None),
        (6, f"{items[0][1]} {items[1][1]}", True, 1),
        (None, " ".join(f"{a},{b};" for a, b in zip(first[::2], first[1::2])), True, 1),
        (8, f"{' '.join(first[:10])} and {' '.join(first[:10])} " * 3000, False, None),
    ]
    frame = spark.createDataFrame([(d[0], d[1]) for d in docs], "doc_id long, text string").select("*", F.lit(1).alias("coverage"), F.lit(2).alias("row"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.judge(frame, bench)
    assert rows(found.select("doc_id", "contaminated", "item_id")) == sorted(((d[0], d[2], d[3]) for d in docs), key=repr)
    assert found.where("doc_id = 2").first().coverage == 1.0
    clean = decontaminate.clean(frame, bench)
    assert clean.columns == frame.columns
    assert clean.count() == sum(not d[2] for d in docs)
    assert decontaminate.judge(frame.limit(0), bench).collect() == []
    assert not decontaminate.judge(frame, bench.limit(0)).where("contaminated").count()


def test_leaks_in_other_letter_case_and_punctuation(spark):
    item = "l'été où Élodie a mangé des pâtes près de Straße façade élève señor niño mañana cañón übermäßig größer"
    apart = "Où?«Élodie»…\u2014l’été\u00a0où Élodie\u2014a mangé\u00a0des “pâtes” près\u2003de Straße; façade élève señor niño mañana cañón «übermäßig» größer"
    docs = [
        (1, f"noise before {item.upper()} and after"),
        (2, apart),
        (3, unicodedata.normalize("NFD", item)),
        (4, "été élève mañana größer où près niño cañón pâtes façade Élodie señor"),
        (5, None),
        (6, "plain words in ASCII only and nothing else at all"),
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(9, item), (10, item.upper())], "item_id long, text string")
    found = {r.doc_id: (r.item_id, round(r.coverage, 2), r.n_items) for r in decontaminate.judge(frame, bench).collect()}
    assert found == {1: (9, 1.0, 2), 2: (9, 1.0, 2), 3: (9, 1.0, 2), **dict.fromkeys((4, 5, 6), (None, 0.0, 0))}


def test_benchmark_in_blocks(spark, monkeypatch):
    items = [(i, " ".join(f"a{i}b{j}" for j in range(12))) for i in range(9)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame([(1, f"{items[7][1]} q {items[2][1]}"), (2, "q")], "doc_id long, text string")
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 4)
    found = {r.doc_id: (r.item_id, r.coverage, r.n_items) for r in decontaminate.judge(frame, bench).collect()}
    assert found == {1: (2, 1.0, 2), 2: (None, 0.0, 0)}

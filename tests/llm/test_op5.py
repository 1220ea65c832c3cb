import random

import pytest

from tests.llm.helpers import ODD, WORD, docs, lower
from tidemark.llm import ngram_join
from tidemark.llm.base import table


def shingle_set(text, k=3):
    w = WORD.findall(lower(text))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute_components(rows, k=3, threshold=9):
    """Threshold in tenths."""
    sets = {d: shingle_set(t, k) for d, t in rows}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            s, t = sets[a], sets[b]
            if s and t and 10 * min(len(s), len(t)) >= threshold * max(len(s), len(t)) and 10 * len(s & t) >= threshold * len(s | t):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in sets}


def check(spark, texts, k, threshold):
    options = {"k": k, "threshold": (threshold, 10)}
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.near_duplicates(docs(spark, texts), **options).collect()}
    assert got == brute_components(list(enumerate(texts)), k, threshold)
    kept = sorted(r["doc_id"] for r in ngram_join.keep_one(docs(spark, texts), **options).collect())
    assert kept == sorted(d for d, (_, c) in got.items() if c == d)


@pytest.mark.parametrize(("k", "threshold"), [(3, 9), (5, 8), (2, 5)])
def test_against_brute_force(spark, k, threshold):
    rng = random.Random(5)
    text = lambda n, v=4000: [f"w{rng.randrange(v)}" for _ in range(n)]
    passage = text(60)
    base, chain = text(120), text(100)
    texts = list(ODD) + ["a b", "A B", "a b c", "a b c d"]
    texts += [" ".join(base)] * 5
    for _ in range(60):  # near copies of one text, more than a short list holds
        w = list(base)
        for _ in range(rng.choice([1, 1, 2, 3])):
            w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
        texts.append(" ".join(w))
    for i in range(15):  # each links with its neighbours only
        chain = [*chain[:-2], *text(2)] if i % 2 else [*text(2), *chain[2:]]
        texts.append(" ".join(chain))
    for _ in range(50):  # one passage in texts that are not alike
        texts.append(" ".join(text(rng.randrange(2, 60)) + passage))
    for n in (9, 10, 11, 12, 20, 21):  # at the threshold
        w = text(n)
        texts += [" ".join(w), " ".join(w[:-1]), " ".join([*w[:-1], "zz"]), " ".join([*w, "yy"])]
    for r in range(24):  # mostly one passage
        texts.append(" ".join(text(r % 12) + passage))
    rng.shuffle(texts)
    check(spark, texts, k, threshold)


def test_lists_of_every_length(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "LONG_LIST", 3)
    monkeypatch.setattr(ngram_join, "FREQUENT", 6)
    test_against_brute_force(spark, 3, 9)


def test_on_the_table(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").collect()]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.near_duplicates(table(spark, sf_dir, "documents"), k=3, threshold=(9, 10)).collect()}
    assert got == brute_components(rows)


def test_null_ids_repeated_rows_and_empty(spark):
    d = docs(spark, ["a b c d", "x y z"])
    d = d.union(d).union(d.selectExpr("CAST(NULL AS LONG)", "text", "lang", "source", "n_chars")).selectExpr("*", "1 AS n", "2 AS node")
    got = sorted(tuple(r) for r in ngram_join.near_duplicates(d, k=3).na.fill(-1).collect())
    assert got == [(-1, 1, 1), (-1, 2, 0), (0, 2, 0), (0, 2, 0), (1, 1, 1), (1, 1, 1)]
    assert ngram_join.keep_one(d).columns == d.columns
    assert ngram_join.near_duplicates(d.limit(0)).count() == 0


def test_keep_one_decides_by_row(spark):
    word = lambda c, n=40: " ".join(f"{c}{i}" for i in range(n))
    rows = [
        (1, word("a")), (None, word("a") + " x"), (7, word("a") + " y"), (7, word("b")),  # near copies of 1, by a null id and by one that repeats
        (None, word("c")), (None, word("d")), (None, word("d")), (None, ""), (None, None),
        (5, word("e")), (5, word("e")), (6, word("f")), (6, word("g")),
        (8, word("h") + " z"), (8, word("h") + " y"), (9, ""), (9, ""), (9, word("i")),
    ]
    d = spark.createDataFrame([(i, t, 10 + j) for j, (i, t) in enumerate(rows)], "doc_id long, text string, n long")
    got = sorted(r["n"] - 10 for r in ngram_join.keep_one(d, k=3, threshold=(8, 10)).collect())
    assert got == [0, 3, 4, 5, 7, 8, 9, 11, 12, 14, 15, 16, 17]


@pytest.mark.parametrize(("a", "b"), [(9, 10), (8, 10), (5, 10), (1, 2)])
def test_linked_sizes_are_in_neighbouring_classes(spark, a, b):
    sizes = spark.range(1, 200_001).selectExpr("id AS n", f"id * {b} div {a} AS m")
    classes = sizes.select(ngram_join._size_class("n", (a, b)).alias("x"), ngram_join._size_class("m", (a, b)).alias("y"))
    assert classes.where("y - x NOT IN (0, 1)").count() == 0


def test_unlike_meets_every_pair_across_components(spark):
    """Lists of many sizes and labels: the pairs met are those that the rules leave open, each once."""
    rng, threshold = random.Random(3), (8, 10)
    rows = []
    for key in range(4):
        for j in range(60):
            label = rng.choice([1, 1, 1, 2, 3, 100 + j])
            rows.append((key, 1000 * key + j, rng.choice([8, 9, 10, 12, 30, 36, 40, 200]), rng.randrange(3), label, label + (rng.random() < 0.1), 0, True))
    bits = spark.createDataFrame([(r[1], *[0] * 8) for r in rows], "id long, " + ", ".join(f"{c} long" for c in ngram_join._BITS))
    entries = spark.createDataFrame(rows, "key long, id long, n long, i long, lo long, hi long, s long, o boolean")
    got = [tuple(r) for r in ngram_join.unlike(entries, bits, threshold).collect()]
    assert len(got) == len(set(got))

    def open_(x, y):
        (_, _, n, i, lo, hi, *_), (_, _, m, j, lo2, hi2, *_) = x, y
        one = lo == hi == lo2 == hi2
        most = min(i, j) + 1 + min(n - i, m - j) - 1
        return not one and 10 * min(n, m) >= 8 * max(n, m) and 18 * most >= 8 * (n + m)

    want = {(x[1], y[1]) for x in rows for y in rows if x[0] == y[0] and x[1] < y[1] and open_(x, y)}
    assert set(got) == want

import hashlib
import random
import time

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.helpers import ALNUM, ODD, WORD, docs, lower
from tidemark.llm import decontaminate, quality_rules
from tidemark.llm.base import table


def base_stats(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = {}
    for w in windows:
        many[w] = many.get(w, 0) + 1
    marked = {i + j for i, w in enumerate(windows) if many[w] > 1 for j in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(marked)


def test_statistics_match_brute_force(spark, sf_dir):
    texts = ODD + ["a b c a b c", "a b c d a b c", "# $ % | <x>\n# $ % | <x>", "A b c a b c"]
    real = table(spark, sf_dir, "documents").collect()
    trees = quality_rules.fit_trees(np.zeros((0, 9)), np.zeros(0), np.zeros(9))
    got = quality_rules.judge(docs(spark, texts + [r["text"] for r in real]), trees).select("_row.doc_id", "_row.text", *quality_rules.BASE, "base_failed").collect()
    assert len(got) == len(texts) + len(real)
    for r in got:
        want = base_stats(r["text"])
        assert tuple(r[c] for c in quality_rules.BASE) == want, r["text"][:80]
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])


def test_trees_are_monotonic_and_learn():
    rng = np.random.default_rng(1)
    x = rng.uniform(size=(2000, 9))
    y = ((x[:, 2] < 0.5) & (x[:, 0] > 0.2)).astype(float)
    trees = quality_rules.fit_trees(x, y, np.array([d for _, d in quality_rules.FEATURES]))
    p = trees.probability(x)
    assert ((p >= 0.5) == y).mean() > 0.97
    for f, (_, d) in enumerate(quality_rules.FEATURES):
        if d:
            up = x.copy()
            up[:, f] += rng.uniform(size=len(x))
            assert (d * (trees.probability(up) - p) >= -1e-12).all()


def test_flat_trees_against_a_recursive_walk():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    trees = quality_rules.fit_trees(x, y, np.array([0, 0, 1, -1]), rounds=12)

    def walk(node, row):
        f = int(trees.feature[node])
        return float(trees.value[node]) if f < 0 else walk(int(trees.left[node]) + int(row[f] > trees.cut[node]), row)

    for row, p in zip(x[:100], trees.probability(x[:100]), strict=True):
        z = trees.start + sum(walk(int(r), row) for r in trees.roots)
        assert p == pytest.approx(1 / (1 + np.exp(-z)))


def test_quality_rules_query(spark, sf_dir):
    d, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    got = quality_rules.judge(d, quality_rules.fit(d, labels))
    got = {r["doc_id"]: r for r in got.select("_row.doc_id", "base_failed", "kept").collect()}
    assert all(not (r["base_failed"] and r["kept"]) for r in got.values())
    known = [(r["quality"], got[r["doc_id"]]) for r in labels.collect()]
    judged = [(q, r["kept"]) for q, r in known if not r["base_failed"]]
    assert sum(bool(q) == k for q, k in judged) / len(judged) > 0.9


def overlaps(text, items, window=10):
    words = ALNUM.findall(lower(text))
    hit, found, best = set(), set(), (0, -1, "", -1)
    for item_id, item in items:
        w = ALNUM.findall(lower(item))
        k = min(window, len(w))
        for a in range(len(w) - k + 1) if k else ():
            for b in range(len(words) - k + 1):
                if words[b : b + k] == w[a : a + k]:
                    hit |= set(range(b, b + k))
                    found.add(str(item_id))
                    n = k
                    while a + n < len(w) and b + n < len(words) and w[a + n] == words[b + n]:
                        n += 1
                    best = min(best, (n, b, str(item_id), a), key=lambda x: (-x[0], x[1:]) if x[0] else (0,))
    return len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit), *best


def check_overlaps(spark, texts, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    d = docs(spark, texts)
    got = decontaminate.digest(decontaminate.find_overlaps(d, bench)).collect()
    assert len(got) == len(texts)
    for r in got:
        assert tuple(r)[1:] == overlaps(texts[r["doc_id"]], items), (r, texts[r["doc_id"]])
    assert sorted(r["doc_id"] for r in decontaminate.decontaminate(d, bench).collect()) == sorted(r["doc_id"] for r in got if not r["contaminated"])


def test_overlaps_match_brute_force(spark):
    rng = random.Random(3)
    vocab = list("abcdef") + ["ünï", "w1"]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate([0, 1, 3, 5, 9, 10, 11, 14, 25, 40])] + [(50, None), (51, ""), (100, "a b c")]
    texts = ODD + [text(rng.randrange(60)) for _ in range(40)] + [f"x {items[8][1]} y", items[9][1].upper().replace(" ", ", "), f"{items[9][1]} {items[9][1]}"] * 3
    check_overlaps(spark, texts, items)
    check_overlaps(spark, texts, items[6:10])
    check_overlaps(spark, texts, [(50, None)])


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BENCH_BYTES", 100)
    items = [(i, " ".join(f"w{(i * 7 + j) % 40}" for j in range(12))) for i in range(30)]
    check_overlaps(spark, [t for _, t in items] + ["none of it", None], items)


def test_overlaps_on_the_tables(spark, sf_dir):
    d, bench = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    items = [(r["item_id"], r["text"]) for r in bench.collect()]
    texts = {r["doc_id"]: r["text"] for r in d.collect()}
    windows = {tuple(w[i : i + 10]) for _, t in items if (w := ALNUM.findall(lower(t))) for i in range(len(w) - 9)}
    for r in decontaminate.digest(decontaminate.find_overlaps(d, bench)).collect():
        w = ALNUM.findall(lower(texts[r["doc_id"]]))
        hit = {i + j for i in range(len(w) - 9) if tuple(w[i : i + 10]) in windows for j in range(10)}
        assert r["n_words"] == len(w) and r["n_hit"] >= len(hit)
        if min(len(ALNUM.findall(lower(t))) for _, t in items) >= 10:
            assert r["n_hit"] == len(hit)


def test_clashing_columns_and_empty_tables(spark):
    d = docs(spark, ["a b c d e f g h i j k", None]).selectExpr("*", "1 AS n_words", "'x' AS spans", "2 AS _text", "3 AS score", "4 AS kept")
    bench = spark.createDataFrame([(1, "b c d e f g h i j k")], "item_id long, text string")
    kept = decontaminate.decontaminate(d, bench)
    assert kept.columns == d.columns and [r["doc_id"] for r in kept.collect()] == [1]
    assert decontaminate.decontaminate(d.limit(0), bench).count() == 0
    assert decontaminate.decontaminate(d, bench.limit(0)).count() == 2
    trees = quality_rules.fit(d, spark.createDataFrame([], "doc_id long, quality int"))
    assert quality_rules.judge(d, trees).count() == 2
    assert quality_rules.judge(d.limit(0), trees).count() == 0


def test_equal_windows_and_repetitive_texts_stay_cheap():
    began = time.time()
    tests = decontaminate.TestSet([str(i) for i in range(200)], pa.array(["the"] * 200))
    n, spans, items, best = decontaminate._search(tests, pa.array(["the " * 100_000, "of the"]))
    assert n.tolist() == [100_000, 2] and spans == [[(0, 100_000)], [(1, 2)]] and len(items[0]) == len(items[1]) == 200 and best == [(1, 0, "0", 0), (1, 1, "0", 0)]
    tests = decontaminate.TestSet(["a", "b"], pa.array(["x " * 4000, "x " * 3000 + "y"]))
    _, spans, items, best = decontaminate._search(tests, pa.array(["x " * 16_000, "z " + "x " * 3500 + "y"]))
    assert spans == [[(0, 16_000)], [(1, 3502)]] and best == [(4000, 0, "a", 0), (3500, 1, "a", 0)]
    assert time.time() - began < 10


def test_shards_of_long_texts_are_bounded(monkeypatch):
    shards = []
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", 1000)
    monkeypatch.setattr(decontaminate, "_shard", lambda tests, parts: iter([shards.append(sum(p.num_rows for p in parts))]))
    batch = pa.RecordBatch.from_arrays([pa.StructArray.from_arrays([pa.array(["w" * 599 + " "] * 1000)], names=["text"])], names=["_row"])
    list(decontaminate._pass([])(iter([batch])))
    assert sum(shards) == 1000 and max(shards) <= 20

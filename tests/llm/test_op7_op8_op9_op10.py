import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import ODD, WORD, docs, lower
from tidemark.llm import maxent_lm, mixing, queries, secrets, url_filter
from tidemark.llm.base import table

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_with_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = queries.queries()[name](spark, SF).toPandas()
    want = con.sql(queries.oracle_sql()[name]).df()[list(got.columns)]
    key = lambda df: sorted(map(str, df.astype(object).where(df.notna(), None).itertuples(index=False, name=None)))
    assert key(got) == key(want)


# ---------------------------------------------------------------- urls


def test_urls(spark):
    urls = {
        "https://Blog.Example.ORG/en/12?x=/es/": ("blog.example.org", "/en/12", "example.org/en/1", "block"), "http://example.org/es/": ("example.org", "/es/", "example.org/es/", "block"),
        "http://example.org/es": ("example.org", "/es", "org/", "allow"), "http://myexample.org/es/": ("myexample.org", "/es/", "org/", "allow"), "http://a.org": ("a.org", "", None, "allow"),
        "x://b.com/de/y#z": ("b.com", "/de/y", "com/de/", "block"), "http://b.com/x/de/": ("b.com", "/x/de/", None, "allow"), "http://b.net/a/login/": ("b.net", "/a/login/", None, "block"),
        "b.com/de/": ("", "", None, "allow"), "": ("", "", None, "allow"), None: ("", "", None, "allow"), "http://": ("", "", None, "allow"), "a?u=http://c.com/fr/q": ("c.com", "/fr/q", "com/fr/", "allow"),
        "http://c.com:80/fr/": ("c.com:80", "/fr/", None, "allow"), "http://h/" + "x" * 50000: ("h", "/" + "x" * 50000, None, "allow"),
    }
    pages = spark.createDataFrame([(i, u, 1) for i, u in enumerate(urls)] * 2 + [(None, None, 1)], "page_id long, url string, host int")
    got = url_filter.filter_urls(pages).collect()
    assert len(got) == 2 * len(urls) + 1
    for r in got:
        if r["page_id"] is not None:
            assert tuple(r)[1:] == list(urls.values())[r["page_id"]]
    assert url_filter.filter_urls(pages.limit(0)).count() == 0


def test_rules_are_filed_and_split_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "MAX_RULES", 2)
    pages = spark.createDataFrame([(1, "http://a.b/x/yy"), (2, "http://q/z")], "page_id long, url string")
    rules = (url_filter.UrlRule("block", "*", "/x", 0), url_filter.UrlRule("allow", "b", "/x/y"), url_filter.UrlRule("block", "a.b", "/"), url_filter.UrlRule("block", "*", "*z", 0))
    assert url_filter.UrlRule("block", "*", "*/wp-login.php*x/a_b", 0).tokens == ["p:wp", "p:login", "p:a"]
    assert [r.tokens for r in rules] == [[""], ["h:b", "p:x"], ["h:a", "h:b"], [""]]
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.filter_urls(pages, rules).collect()}
    assert got == {1: ("b/x/y", "allow"), 2: (None, "block")}


# ---------------------------------------------------------------- mixing


def plain_targets(sizes, weights=mixing.WEIGHTS, most=mixing.MOST):
    order = sorted(sizes, key=lambda x: (x[0] is None, (x[0] or "").encode()))
    open_ = {s: (n, weights[i % len(weights)]) for i, (s, n) in enumerate(order)}
    left, out = sum(n for _, n in order), {}
    while open_:
        level = left / sum(w for _, w in open_.values())
        over = {s: float(most * n) for s, (n, w) in open_.items() if level * w > most * n}
        if not over:
            return out | {s: level * w for s, (_, w) in open_.items()}
        out |= over
        left -= sum(over.values())
        open_ = {s: x for s, x in open_.items() if s not in over}
    return out


def test_targets(spark):
    rng = random.Random(7)
    cases = [[("b", 100), ("a", 100), (None, 100)], [("a", 1000), ("b", 10), ("c", 0)], [], [("a", 0)], [(f"s{i} é"[: rng.randrange(2, 9)] + str(i), int(10 ** (rng.random() * 6))) for i in range(300)] + [(None, 5)]]
    for sizes in cases:
        got = mixing.targets(spark.createDataFrame(sizes, "source string, n long").repartition(3)).collect()
        assert {r["source"]: r["target"] for r in got} == pytest.approx(plain_targets(sizes), rel=1e-12)
    assert plain_targets([("a", 1000), ("b", 10), ("c", 0)]) == {"a": 980, "b": 30, "c": 0}


def test_flight_keeps_totals():
    rng = random.Random(2)
    for n in (0, 1, 2, 3, 50, 500):
        pi, words = [rng.random() for _ in range(n)], [float(rng.randrange(100)) for _ in range(n)]
        out = mixing.flight(pi, [1.0] * n, words, rng)
        assert sum(out) == pytest.approx(sum(pi)) and sum(w * p for w, p in zip(words, out, strict=True)) == pytest.approx(sum(w * p for w, p in zip(words, pi, strict=True)))
        assert sum(0 < p < 1 for p in out) <= 2 and all(0 <= p <= 1 for p in out)
        assert all(p in (0.0, 1.0) for p in mixing.landing(out, words))


def check_mix(spark, d, tolerance):
    got = mixing.mixed_rows(d).collect()
    again = mixing.mixed_rows(d.repartition(5)).collect()
    key = lambda rows: sorted(map(str, rows))
    assert key(got) == key(again)
    by = {}
    rows = d.collect()
    assert len(rows) == len(got)
    size = Counter()
    for r in rows:
        size[r["source"]] += len(WORD.findall(r["text"] or ""))
    goal = plain_targets(list(size.items()))
    taken = mixing.mix(d).collect()
    for r in taken:
        assert r["target"] == pytest.approx(goal[r["source"]]) and r["source_size"] == size[r["source"]]
        assert r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
        by[r["source"]] = by.get(r["source"], 0) + r["taken"] * r["rows"]
    for s, t in goal.items():
        assert abs(by[s] - t) <= tolerance(s), (s, by[s], t)
        # both totals are balanced: documents come out within what the landing may change
        units = [r for r in taken if r["source"] == s and r["size"]]
        mean = sum(r["rows"] for r in units) * t / size[s] if size[s] else 0
        assert abs(sum(r["taken"] // r["size"] * r["rows"] for r in units) - mean) <= (mixing.LANDING + 2) * max((r["rows"] for r in units), default=0)


def test_mix(spark, monkeypatch):
    rng = random.Random(1)
    d = spark.createDataFrame([(i, "w " * rng.randrange(1, 60), "en", rng.choice(["a", "a", "a", "b", "ü", None]), None) for i in range(400)], "doc_id long, text string, lang string, source string, n_chars long")
    check_mix(spark, d, lambda s: 30)
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 1)
    check_mix(spark, d, lambda s: 30)
    monkeypatch.setattr(mixing, "BUCKET", 20)  # several levels
    check_mix(spark, d, lambda s: 60)


def test_mix_to_a_limit_that_is_not_whole(spark):
    d = spark.createDataFrame([(i, "w " * (1 + i % 7), "a" if i % 2 else "b") for i in range(600)], "doc_id long, text string, source string")
    got = mixing.mixed_rows(d, share=1.5, weights=(1.0, 1000.0), most=2.5).toPandas()
    assert (got.taken <= 3 * got["size"]).all() and (got.target <= 2.5 * got.source_size + 1e-6).all()
    limited = got[got.doc_id % 2 == 0]  # the source of the large weight
    assert limited.target.iloc[0] == 2.5 * limited.source_size.iloc[0] and abs(limited.taken.sum() - limited.target.iloc[0]) <= 7


def test_secret_scan_is_linear_in_the_matches(spark):
    rng = random.Random(1)
    line = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(32))
    times = []
    for n in (250, 25_000):
        d = docs(spark, ["\n".join(line() for _ in range(n))] * 2)
        began = time.time()
        got = secrets.scan_secrets(d).collect()
        times.append(time.time() - began)
        assert [r["n_hex"] for r in got] == [n, n]
    assert times[1] < times[0] + 10


def test_mix_on_the_table_and_odd_rows(spark):
    check_mix(spark, table(spark, SF, "documents"), lambda s: 200)
    d = docs(spark, ODD + ["a b", "a b"])
    d = d.union(d).union(d.selectExpr("CAST(NULL AS LONG)", "text", "lang", "CAST(NULL AS STRING)", "n_chars")).selectExpr("*", "1 AS size", "2 AS pi")
    most = {}
    for r in mixing.mix(d).collect():
        most[r["source"]] = max(most.get(r["source"], 0), r["size"] * r["rows"])
    check_mix(spark, d, lambda s: most[s] / 2 + 10)  # what rounding the largest unit costs
    out = mixing.taken_documents(d)
    assert set(out.columns) == {*d.columns, "source_size", "target", "taken"} and out.where("taken <= 0").count() == 0
    assert mixing.mixed_rows(d.limit(0)).count() == 0


# ---------------------------------------------------------------- secrets

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def base_spans(text):
    text = text or ""
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def test_secrets(spark):
    texts = [*ODD, "password: hunter22", "Passwd='abcde' token==abcdefg", "é漢 api_key = x1y2z3w4 secret:ab", "password=token =abcdefgh", "AKIAAKIA" + "A1" * 8, "AKIA" + "Z" * 15, "0" * 23 + "g" + "ab" * 12 + "cafe", "paſſword=abcdefgh", "SECRET\"=\"q/w+e=r-t\"", "ghp_" + "aB3" * 10, "x" * 10 + "=" * 40, "secret=" + "ab12" * 9, "token: a\n" * 300 + "token: abcdef"]
    copied = "Zz9" * 12
    rows = [(i, t, "en", f"s{i % 5}", None) for i, t in enumerate(texts)] + [(1000 + i, f"see {copied} there", "en", f"s{i}", None) for i in range(6)] + [(2000, "mine: " + "Qq8" * 12, "en", "s1", None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 AS spans", "2 AS h")
    got = {r["doc_id"]: r for r in secrets.scan_secrets(d).collect()}
    for i, t, *_ in rows:
        want = base_spans(t)
        shown = [f"{k}:{s}:{e}" for s, _, k, e in want]
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(shown).encode()).hexdigest(), t[:60]
        assert set(shown) <= set(filter(None, got[i]["spans"].split(",")))
        assert tuple(got[i])[1:4] == tuple(sum(k == kind for _, _, k, _ in want) for kind in ("assign", "access", "hex"))
    assert all(got[1000 + i]["spans"] == "" for i in range(6))  # many owners hold it
    assert got[2000]["spans"] == "mixed:6:42"
    assert "vendor:0:34" in got[len(ODD) + 9]["spans"]
    clash = d.selectExpr("*", "'x' AS host", "2 AS verdict", "3 AS _id", "4 AS owners").withColumn("source", F.lit(None).cast("string"))
    assert {r["doc_id"]: r["base_sha256"] for r in secrets.scan_secrets(clash).collect()} == {i: r["base_sha256"] for i, r in got.items()}
    assert secrets.scan_secrets(d.union(d)).count() == 2 * len(rows) and secrets.scan_secrets(d.limit(0)).count() == 0


# ---------------------------------------------------------------- language model


def check_scores(rows, got):
    toks = [(i, [*WORD.findall(lower(t)), None]) for i, t in rows]
    train = [w for i, t in toks if zlib.crc32(("" if i is None else str(i)).encode()) % 10 for w in t]
    c, n = Counter(train), len(train)
    want = sorted((i or -1, len(t), sum(c[w] > 0 for w in t), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (len(c) + 1))) for w in t)) for i, t in toks)
    have = sorted((r["doc_id"] or -1, r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got)
    assert len(want) == len(have)
    for a, b in zip(want, have, strict=True):
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4])
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_scores(spark, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    got = maxent_lm.score_documents(table(spark, SF, "documents")).collect()
    check_scores(rows, got)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    monkeypatch.setattr(maxent_lm, "LOOKUP_WORDS", 600)  # most counts are joined
    check_scores(rows, maxent_lm.score_documents(table(spark, SF, "documents")).collect())


def test_scores_of_odd_rows(spark):
    d = docs(spark, ODD + ["The the THE", "new words only"])
    d = d.union(d).union(d.selectExpr("CAST(NULL AS LONG)", "text", "lang", "source", "n_chars")).selectExpr("*", "1 AS score", "2 AS c")
    check_scores([(r["doc_id"], r["text"]) for r in d.collect()], maxent_lm.score_documents(d).collect())
    assert maxent_lm.score_documents(d.limit(0)).count() == 0
    assert maxent_lm.score_documents(d.where("doc_id = 0"), modulus=1).first()["train_tokens"] == 0


def test_steps_follow_the_gradient_of_single_tokens():
    """One minibatch with the softmax of equal contexts computed once, against a walk over the tokens."""
    rng = np.random.default_rng(4)
    m = maxent_lm.Model.start(np.arange(1, 600, dtype=np.uint64)[: maxent_lm.HEAD_WORDS - 5], np.ones(maxent_lm.TAIL_CLASSES))
    m.prepare()
    m.w1[:], m.w2[:] = rng.normal(size=m.w1.shape), rng.normal(size=m.w2.shape)
    n, last = 60, maxent_lm.HEAD_CLASSES - 1
    f1, f2, cls = rng.integers(0, 4, (3, n)), rng.integers(0, 4, (2, n)), rng.choice([0, 3, last], n)
    inner = rng.integers(0, 20, n)
    for w, closed, rows, target in ((m.w1, m._shut, np.concatenate([f1, np.full((1, n), maxent_lm.ROWS)]), cls), (m.w2, m._closed, np.concatenate([f2, (maxent_lm.ROWS + cls)[None]]), inner)):
        grad = np.zeros(w.shape)
        for i in range(n):
            z = w[rows[:, i]].astype(float).sum(axis=0) + (closed if closed.ndim == 1 else closed[cls[i]])
            p = np.exp(z - z.max())
            p /= p.sum()
            p[target[i]] -= 1
            for r in rows[:, i]:
                grad[r] += p
        trainer = maxent_lm.Trainer(m, 0.3)
        mine, s, uses = w.copy(), np.full_like(w, 0.1), np.zeros(len(w), np.float32)
        trainer._step(mine, s, uses, rows, target, closed)
        assert np.allclose(s, 0.1 + grad**2, atol=1e-3) and np.allclose(mine, w - 0.3 * grad / np.sqrt(0.1 + grad**2), atol=1e-4)
        assert (uses == np.bincount(rows.ravel(), minlength=len(w))).all()


def test_score_of_a_whole_text_against_a_walk_over_its_tokens():
    rng = np.random.default_rng(6)
    of = lambda t: maxent_lm.tokens(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))
    text = "The cat sat, on the MAT.\n the cat\tunseenwords again; Ünï the"
    words = [w.lower() for w in WORD.findall(text)]
    word = {w: of(w) for w in set(words)}
    head = np.array([int(word[w].hash[0]) for w in ("the", "cat", "on")] + list(range(1, 40)), dtype=np.uint64)
    m = maxent_lm.Model.start(head, rng.uniform(5, 50, maxent_lm.TAIL_CLASSES))
    m.prepare()
    m.w1[:], m.w2[:] = rng.normal(size=m.w1.shape), rng.normal(size=m.w2.shape)
    whole, low = (1 << 64) - 1, maxent_lm.ROWS - 1
    A, B, C = int(maxent_lm._A), int(maxent_lm._B), int(maxent_lm._C)
    row = lambda x: int(maxent_lm.mix(np.array([x & whole], np.uint64))[0]) & low
    rank = {int(h): i for i, h in enumerate(head)}
    one = two = int(maxent_lm.BEGIN)
    total = 0.0
    for w in [*words, None]:
        h, form, tail = (int(maxent_lm.END), 0, 0) if w is None else (int(word[w].hash[0]), int(word[w].form[0]), int(word[w].tail[0]))
        r = rank.get(h, -1)
        cls = r // maxent_lm.CLASS_WORDS if r >= 0 else maxent_lm.HEAD_CLASSES + form
        z = sum(m.w1[i].astype(float) for i in (row(one * A), row(one * A + two * B), row(two * C + B), maxent_lm.ROWS)) + m._shut
        total += z[cls] - math.log(np.exp(z - z.max()).sum()) - z.max()
        if r >= 0:
            v = sum(m.w2[i].astype(float) for i in (row(one * B + cls * C), row(two * A + cls * C + C), maxent_lm.ROWS + cls)) + m._closed[cls]
            total += v[r % maxent_lm.CLASS_WORDS] - math.log(np.exp(v - v.max()).sum()) - v.max()
        else:
            total -= math.log(m.tail_mass[form])
        two, one = one, h if r >= 0 else int(maxent_lm.mix(np.array([(form * 65536 + tail + A) & whole], np.uint64))[0])
    assert m.log10(of(text)).sum() == pytest.approx(total / math.log(10), rel=1e-4)


def test_model_is_a_distribution():
    """The probabilities of all words after some context add up to 1, one unseen word a tail class included."""
    import pyarrow as pa

    from tidemark.llm.base import blocks

    words = [f"w{i}" for i in range(40)] + ["lang.", "größe", "unseenlongword"]
    _, _, data, at = next(blocks(pa.array([" ".join(words)])))
    t = maxent_lm.tokens(data, at)
    head = t.hash[:30].copy()
    count = np.arange(1, 14)
    mass = np.full(maxent_lm.TAIL_CLASSES, 0.1)
    tail_form = t.form[30:43]
    np.add.at(mass, tail_form, count + 0.1)
    m = maxent_lm.Model.start(head, mass)
    m.prepare()
    rng = np.random.default_rng(0)
    m.w1[:] = rng.normal(size=m.w1.shape)
    m.w2[:] = rng.normal(size=m.w2.shape)
    trainer = maxent_lm.Trainer(m, 0.3)
    before = m.log10(t).sum()
    for _ in range(30):
        trainer.learn(t)
    z = m.class_scores(np.array([[5], [6], [7]]))[0]
    p = np.exp(z - maxent_lm._log_sum(z[None])[0])
    total = sum(p[c] * np.exp(v - maxent_lm._log_sum(v[None])[0]).sum() for c in range(maxent_lm.HEAD_CLASSES) for v in m.word_scores(np.array([[1], [2]]), np.array([c])) if p[c] > 0)
    for c in range(maxent_lm.TAIL_CLASSES):
        total += p[maxent_lm.HEAD_CLASSES + c] * (sum(n + 0.1 for n, f in zip(count, tail_form, strict=True) if f == c) + 0.1) / mass[c]
    assert total == pytest.approx(1.0, abs=1e-4)
    m.w1, m.w2 = trainer.w1, trainer.w2
    assert m.log10(t).sum() > before

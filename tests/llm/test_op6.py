import hashlib

import numpy as np

from tests.llm.helpers import ODD, docs, lower
from tidemark.llm import line_dedup
from tidemark.llm.base import stored, table

STRIP = " \t\n\x0b\x0c\r"


def brute_lines(rows):
    held = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            held.setdefault(lower(line).strip(STRIP), set()).add(d)
    out = {}
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(k := lower(x).strip(STRIP)) >= 10 and len(held[k]) > 1 and min(held[k]) != d)]
        out[d] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def test_against_brute_force(spark, sf_dir):
    texts = ODD + ["keep me once\nshort\n  KEEP ME ONCE\t", "x\nkeep me once", "ÄÖÜäöüßßßß\nÄÖÜäöüßßßß", "ÄÖÜäöüßßßß\n123456789", "123456789\näöü", "", "\n\n"]
    texts += [r["text"] for r in table(spark, sf_dir, "documents").collect()]
    want = brute_lines(list(enumerate(texts)))
    got = line_dedup.dedup_lines(docs(spark, texts)).select("_row.doc_id", "n_lines", "n_dropped", "kept", "kept_sha256").collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r["n_lines"], r["n_dropped"], r["kept"]) == want[r["doc_id"]]
        assert r["kept_sha256"] == hashlib.sha256(r["kept"].encode()).hexdigest()


def test_filters_too_large_to_broadcast(spark, sf_dir, monkeypatch):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    key = lambda: sorted((r["_row"]["doc_id"], r["n_dropped"], r["kept_sha256"]) for r in line_dedup.dedup_lines(d).collect())
    want = key()
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 100)  # many shards
    assert key() == want
    monkeypatch.setattr(line_dedup, "FILTER_BYTES", 0)
    assert key() == want
    monkeypatch.setattr(line_dedup, "heaviest", lambda repeated: tuple(np.empty(0, np.int64) for _ in range(3)))
    assert key() == want


def test_filters_by_shard_hold_back_what_is_not_repeated(spark):
    d = docs(spark, [f"line number {i} of its own\nthe line of all" for i in range(300)])
    repeated = stored(line_dedup.counts(line_dedup.references(d)), "t")
    none = spark.sparkContext.broadcast(tuple(np.empty(0, np.int64) for _ in range(3)))
    refs = line_dedup.references(d, heavy=none)
    for probe in (line_dedup.by_broadcast, line_dedup.by_shard):
        assert 300 <= probe(refs, stored(line_dedup.filters(repeated, 7), "t"), 7).count() < 310


def test_null_ids_repeats_clashes_and_empty(spark):
    d = docs(spark, ["the same long line"] * 2)
    d = d.union(d).union(d.selectExpr("CAST(NULL AS LONG)", "text", "lang", "source", "n_chars")).selectExpr("*", "1 AS keys", "2 AS kept", "3 AS doc")
    got = line_dedup.dedup_lines(d)
    assert sorted((r["_row"]["doc_id"] is None, r["_row"]["doc_id"] or 0, r["n_dropped"]) for r in got.collect()) == [(False, 0, 0), (False, 0, 0), (False, 1, 1), (False, 1, 1), (True, 0, 1), (True, 0, 1)]
    assert line_dedup.dedup_lines(d.limit(0)).count() == 0


def test_references_are_reversible(spark):
    a, b = docs(spark, ["first long line\nsecond long line", "second long line"]), docs(spark, ["", "", "first long line\nthird long line"]).where("doc_id = 2")
    key = lambda df: sorted(tuple(r) for r in df.collect())
    refs = stored(line_dedup.references(a), "t")
    both = stored(line_dedup.with_documents(refs, b), "t")
    before, after = stored(line_dedup.counts(refs), "t"), stored(line_dedup.counts(both), "t")
    assert key(line_dedup.without_documents(both, b.select("doc_id"))) == key(refs)
    assert (before.count(), after.count()) == (1, 2)
    cells = stored(line_dedup.filters(before, 2), "t")
    grown = stored(line_dedup.update_filters(cells, before, after, 2), "t")
    back = stored(line_dedup.update_filters(grown, after, before, 2), "t")

    def holds(table_, keys):
        f = {r["shard"]: line_dedup.CuckooFilter.from_bytes(bytes(r["cells"])) for r in table_.collect()}
        return [bool(r["h2"] % 2 in f and f[r["h2"] % 2].may_hold(np.array([r["h1"]]))[0]) for r in keys.collect()]

    assert all(holds(grown, after)) and all(holds(back, before))
    assert sum(holds(back, after)) == 1


def test_cuckoo_filter():
    rng = np.random.default_rng(0)
    keys = rng.integers(-(2**63), 2**63 - 1, 5000)
    f = line_dedup.CuckooFilter.of(keys)
    assert not f.full and f.may_hold(keys).all()
    assert f.may_hold(rng.integers(-(2**63), 2**63 - 1, 20000)).mean() < 0.01
    assert all(f.delete(int(k)) for k in keys[:2500]) and f.may_hold(keys[2500:]).all()
    assert f.may_hold(keys[:2500]).mean() < 0.01
    small = line_dedup.CuckooFilter(1)
    for k in keys[:100].tolist():
        small.insert(k)
    assert small.full and small.may_hold(keys).all()

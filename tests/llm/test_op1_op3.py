import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from tests.llm.helpers import ALNUM, ODD, docs, lower
from tidemark.llm import compression, quality_rules, toxicity
from tidemark.llm.base import held_out, labelled, present, stored, table

SF = "/root/testdata/sf0.01"
#: With labels enough for measures of the toxic ones.
SF_LARGE = "/root/testdata/sf0.1"


def test_quality_on_held_out_rows(spark):
    d, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    out = compression.score(d, compression.fit(d, labels)).select("_row.doc_id", "score", "predicted")
    rows = out.join(labels, "doc_id").where(held_out(F.col("doc_id"), 4, 2)).collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    assert sum(r["predicted"] == r["quality"] for r in rows) / len(rows) > 0.93


def test_quality_odd_texts(spark):
    labels = spark.createDataFrame([(3, 1), (7, 0), (8, 1), (3, 1), (None, 1), (4, None)], "doc_id long, quality int")
    d = docs(spark, ODD).selectExpr("*", "1 AS score", "2 AS _text")
    d = d.union(d)
    got = compression.score(d, compression.fit(d, labels)).collect()
    assert len(got) == 2 * len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if not r["_row"]["text"]}) == 1
    none = compression.fit(d, labels.limit(0))
    assert {r["score"] for r in compression.score(d, none).collect()} == {0.5}
    assert compression.score(d.limit(0), none).count() == 0


def test_labels_of_other_documents_take_no_room(spark, monkeypatch):
    d = docs(spark, [f"plain text number {i}" for i in range(40)])
    labels = d.selectExpr("doc_id", "doc_id % 2 AS quality", "doc_id % 2 AS toxic").union(spark.range(1000, 21_000).selectExpr("id", "id % 2", "id % 2"))
    texts, total = compression.training_sample(d, labels, 20)
    seen = texts.collect()
    assert {r["q"] for r in seen} == {0, 1} and len(seen) == sum(total.values()) == d.where(~held_out(F.col("doc_id"), 4, 2)).count()
    found = labelled(d, present(labels.withColumnRenamed("toxic", "y"), d), "y", 5).collect()
    assert len(found) == 10 and all(r["doc_id"] < 40 for r in found)
    known = quality_rules.fit(docs(spark, [" ".join(f"w{i}{j}" for j in range(60 + i % 2 * 300)) for i in range(40)]), labels, 40)
    assert len(known.feature) > 1


def test_dictionaries_hold_what_stands_behind_the_opening():
    opening, junk = b"A usual first line. " * 20, [b"<<%05d$$>>" % (i * 7919 % 100000) * 40 for i in range(3000)]
    texts = [opening + j for j in junk]
    shares = compression._shares([len(t) + 1 for t in texts], compression.DICT_BYTES)
    rows = [(0, compression._slices(t, n - 1)) for t, n in zip(texts, shares, strict=True)]
    got = compression._dictionaries([*rows, (1, [b"short"])])
    assert got[0] == b"short" and compression.DICT_BYTES * 0.98 < len(got[1]) <= compression.DICT_BYTES
    assert sum(j[2:7] in got[1] for j in junk) > 1000
    assert b"usual first line" in got[1] and got[3] == got[1].translate(compression._SHAPE)


def test_features_against_a_plain_loop_of_zstandard():
    rng = random.Random(9)
    dicts = ["".join(rng.choice("abcdefgh ") for _ in range(3000)).encode() for _ in range(2)]
    m = compression.Model([*dicts, *[d.translate(compression._SHAPE) for d in dicts]], np.array([0.1, 1, 2, 0.5, 0.5, 0.2]))
    made = [zstandard.ZstdCompressor(level=compression.LEVEL, dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_checksum=False, write_content_size=False, write_dict_id=False) for d in m.dicts]
    for raw in [b"", b"x", dicts[0][:500], dicts[1] * 2, "Ünï 123 ABC".encode() * 300]:
        if not raw:
            assert m.features(raw) == [0.0, 0.0, 0.0]
            continue
        pieces = [raw[i : i + compression.PIECE] for i in range(0, len(raw), compression.PIECE)]
        shape = bytes(ord("a") if 97 <= c <= 122 else ord("A") if 65 <= c <= 90 else ord("0") if 48 <= c <= 57 else ord("w") if c >= 128 else c for c in raw)
        shapes = [shape[i : i + compression.PIECE] for i in range(0, len(raw), compression.PIECE)]
        size = lambda c, xs: sum(len(c.compress(x)) for x in xs)
        want = [(size(made[1], pieces) - size(made[0], pieces)) / len(raw), (size(made[3], shapes) - size(made[2], shapes)) / len(raw), size(made[0], pieces) / len(raw)]
        assert m.features(raw) == pytest.approx(want)
        t, s_, a = want
        z = 0.1 + t * 10 + 2 * s_ * 10 + 0.5 * max(-t - 0.02, 0) * 20 + 0.5 * max(-s_ - 0.02, 0) * 20 + 0.2 * max(0.35 - a, 0) * 10
        assert m.probability(np.array([want]))[0] == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, z)))))


def test_other_ids_give_the_same_model(spark):
    d, labels = table(spark, SF, "documents"), table(spark, SF, "labels").where(~held_out(F.col("doc_id"), 4, 2))
    # ids that leave the same rows in the sample
    ids = {r["doc_id"]: k for r, k in zip(labels.select("doc_id").distinct().orderBy("doc_id").collect(), (i for i in range(10**6, 2 * 10**6) if zlib.crc32(str(i).encode()) % 4 != 2), strict=False)}
    other = spark.createDataFrame(list(ids.items()), "doc_id long, new long")
    renamed = lambda df: df.join(F.broadcast(other), "doc_id").withColumn("doc_id", F.col("new")).drop("new")
    one, two = (compression.fit(x, y) for x, y in ((d, labels), (renamed(d), renamed(labels))))
    assert one.dicts == two.dicts and np.allclose(one.weights, two.weights)


def test_whole_training_texts_of_one_row_an_id(spark):
    d = docs(spark, ["".join(f"{i:06d} " for i in range(20000))] * 6 + [None])
    d = d.union(d.selectExpr("doc_id", "'z another text'", "lang", "source", "n_chars"))
    texts, total = compression.training_sample(d, d.selectExpr("doc_id", "doc_id % 2 AS quality"))
    got = texts.collect()
    assert len({r["doc_id"] for r in got}) == len(got) and sum(total.values()) >= len(got) > 2
    assert all(len(r["text"]) == 140_000 or r["doc_id"] == 6 for r in got)  # the smaller of the two, uncut
    m = [compression.Model([b"some text", b"other text", b"aaaa aaaa", b"aaaaa aaaa"])] * compression.FOLDS
    x = compression._measured(texts, m, {r["doc_id"]: 0 for r in got})
    assert all(np.allclose(x[r["doc_id"]], m[0].features(r["text"].encode())) for r in got)


def plain_score(chain, text):
    """The chain walked link by link in plain Python, with features found by slicing."""
    words = [w.encode() for w in ALNUM.findall(lower(text))]
    row, bucket, _ = toxicity.features(pa.array([" ".join({w.decode() for w in words})] if words else [""]))
    p = []
    for link in chain.links:
        e = [float(link.evidence[b]) for b in bucket]
        z = [1.0, max([0.0, *e]), math.log1p(sum(max(x - 1.5, 0) for x in e)), math.log1p(sum(max(x - 4.0, 0) for x in e)), *p]
        z = sum(a * b for a, b in zip(z, link.weights, strict=True)) + sum(float(link.own[b]) for b in bucket)
        p.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
    return p


def test_chain_against_a_plain_walk_and_out_of_fold(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    common, bad = [word() for _ in range(60)], ["vile" + word() for _ in range(5)]
    texts = [" ".join([rng.choice(common) for _ in range(20)] + ([rng.choice(bad)] * 3 + ["\n", rng.choice(bad)] if i % 3 == 0 else [])) for i in range(300)]
    d = docs(spark, texts)
    chain = toxicity.fit(d, d.selectExpr("doc_id", "IF(doc_id % 3 = 0, 1, 0) AS toxic"))
    got = toxicity.score(d, chain).collect()
    assert sum(r["toxic"] == (r["_row"]["doc_id"] % 3 == 0) for r in got) >= 295
    for r in got[:40]:
        assert [r[f"p_{c}"] for c in toxicity.CATEGORIES] == pytest.approx(plain_score(chain, r["_row"]["text"]), abs=1e-5)
    # later links use what the earlier ones say
    none = np.empty(0, np.int64)
    with_, without = (chain.links[1].probability(none, none, 1, np.array([[p]]))[0] for p in (1.0, 0.0))
    assert [len(x.weights) for x in chain.links] == [4, 5, 6] and with_ > without
    # labels that nothing explains cannot be foretold out of fold
    noise = stored(toxicity.sample_rows(d.selectExpr("doc_id", "text AS _text", "CAST(pmod(xxhash64(doc_id), 2) AS INT) AS y")), "t")
    rows = sorted(noise.collect(), key=lambda r: r["doc_id"])
    y, fold = np.array([float(r["y"]) for r in rows]), np.array([r["fold"] for r in rows])
    _, oof = toxicity.fit_link(noise, y, fold, toxicity.bucket_counts(noise), np.zeros((300, 0)), np.ones(300), [r["doc_id"] for r in rows])
    assert 0.35 < ((oof > 0.5) == y).mean() < 0.65


def test_toxicity_on_rows_not_fitted_on(spark):
    d, labels = table(spark, SF_LARGE, "documents"), table(spark, SF_LARGE, "labels")
    seen = F.pmod(F.xxhash64("doc_id"), F.lit(3)) != 0
    out = toxicity.score(d, toxicity.fit(d, labels.where(seen))).select("_row.doc_id", *[f"p_{c}" for c in toxicity.CATEGORIES], F.col("toxic").alias("predicted"))
    rows = out.join(labels.where(~seen), "doc_id").collect()
    assert sum(r["predicted"] == r["toxic"] for r in rows) / len(rows) > 0.9
    toxic, other = ([r["p_toxic"] for r in rows if r["toxic"] == t] for t in (1, 0))
    assert sum((a > b) + 0.5 * (a == b) for a in toxic for b in other) / (len(toxic) * len(other)) >= 0.95
    assert sum(r["predicted"] for r in rows if r["toxic"]) / len(toxic) >= 0.9 and sum(r["predicted"] for r in rows if not r["toxic"]) / len(other) <= 0.02
    assert all(0 <= r[f"p_{c}"] <= 1 for r in rows for c in toxicity.CATEGORIES)


def test_toxicity_odd_texts(spark):
    d = docs(spark, ODD + ["you idiot", "a kind word"]).selectExpr("*", "1 AS toxic", "2 AS p_toxic")
    n = len(ODD)
    labels = spark.createDataFrame([(n, 1), (n + 1, 0), (3, 0), (7, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity.score(d, toxicity.fit(d, labels)).collect()
    assert len(got) == n + 2
    none = toxicity.score(d, toxicity.fit(d, labels.limit(0)))
    assert {r["toxic"] for r in none.collect()} == {0}
    assert toxicity.score(d.limit(0), toxicity.fit(d.limit(0), labels)).count() == 0


def test_steps_of_single_buckets_are_worked_out_beside_their_gradients(spark):
    rows = spark.createDataFrame([(str(i), i % 2, i % 4, [i % 3, 10 + i % 5]) for i in range(40)], "doc_id string, y int, fold int, x array<int>")
    counts = toxicity.bucket_counts(rows)
    assert counts.held.dtype.itemsize <= 2 and counts.bucket.dtype == np.int32  # what is broadcast
    n, models = len(counts.bucket), toxicity.FOLDS + 1
    g = np.arange(2 * n * models, dtype=np.float32).reshape(2, n, models)
    own = np.full((n, models), 0.25, np.float32)
    got = toxicity._step(pa.table({"part": [1, 0], "block": [0, 0], "g": [g.tobytes(), g.tobytes()]}), own, counts)
    odds = np.abs(np.stack([counts.without(m) for m in range(models)], axis=1))
    ridge = toxicity.RIDGE * np.maximum(1.0, toxicity.CLEAR / np.maximum(odds, 1e-2)) ** toxicity.FADE
    want = toxicity.RATE * (2.0 * g[0] + ridge * own) / (2.0 * g[1] + 1 + ridge)
    assert got.column("block").to_pylist() == [0]
    assert np.allclose(np.frombuffer(got.column("step")[0].as_py(), np.float32).reshape(n, models), want, rtol=1e-5)

"""Conversation repair, sharding and whitening against plain forms, and their odd cases."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import ODD, docs
from tidemark.llm import conversations, queries, sharding, whitening
from tidemark.llm.base import table

SF = "/root/testdata/sf0.001"
CONV = "conv_id long, turn long, role string, text string"

# ---------------------------------------------------------------- conversation repair


def plain_audit(turns):
    """Cheapest audit by trying grammar states turn by turn, every one with all its audits of least cost."""
    best = {"-": (0, "")}
    for t in [*turns, None]:
        for _ in range(3):  # insertions before the turn
            for q, (c, e) in list(best.items()):
                to = "a" if q == "u" else "u"
                best[to] = min(best.get(to, (9**9, "")), (c + 5, e + "I"))
        if t is None:
            break
        after = {}

        def reach(q, c, e, after=after):
            after[q] = min(after.get(q, (9**9, "")), (c, e))

        for q, (c, e) in best.items():
            reach(q, c + 2, e + "D")
            if t != "-":
                extra = 5 if t.isupper() else 0
                for to in "sua":
                    if (q, to) in {("-", "s"), ("-", "u"), ("s", "u"), ("u", "a"), ("a", "u")}:
                        if t.lower() == to:
                            reach(to, c + extra, e + "K")
                        elif to != "s":
                            reach(to, c + extra + 1, e + "R")
        best = after
    return min(best[q] for q in ("-", "a") if q in best)


def plain_repair(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, hash) of one conversation's (turn, role, text) rows."""
    rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, symbols, counts = set(), [], Counter()
    for _, r, x in rows:
        body = x.rstrip(" \t\n\x0b\x0c\r")
        kind = "blank" if not body else "duplicate" if (r, x) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((r, x))
        counts[kind] += 1
        first = r[:1] if r[:1] in ("s", "u", "a") else "x"
        symbols.append("-" if kind in ("blank", "duplicate") else first.upper() if kind else first)
    numbers = [t for t, _, _ in rows if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    cost, audit = plain_audit(symbols)
    out, left = [], sum(e != "D" for e in audit)
    at = 0
    for e in audit:
        if e != "D":
            role = rows[at][1] if e == "K" else "assistant" if left % 2 else "user"
            out.append(f"{role}:{'' if e == 'I' else rows[at][2]}")
            left -= 1
        at += e != "I"
    return gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()


@pytest.mark.parametrize("size", range(5))
def test_alignment_of_all_short_sequences(size):
    for turns in itertools.product("suaxUA-", repeat=size):
        turns = "".join(turns)
        got = min(filter(None, (conversations.cheapest(turns, "-", "-"), conversations.cheapest(turns, "-", "a"))))
        assert got == plain_audit(turns), turns


def test_bands_do_not_change_what_is_found():
    rng = random.Random(3)
    for _ in range(200):
        turns = "".join(rng.choice("ssuuuaaaxSUAX--") for _ in range(rng.randint(5, 20)))
        got = min(filter(None, (conversations.cheapest(turns, "-", "-"), conversations.cheapest(turns, "-", "a"))))
        assert got == plain_audit(turns)
        assert conversations.align(turns, "uaua", 10**6) == conversations.align(turns, "uaua", (conversations.align(turns, "uaua", float("inf")) or (0,))[0])


def by_conversation(rows):
    out = {}
    for c, *r in rows:
        out.setdefault(c, []).append(r)
    return out


def check_repair(spark, rows):
    got = {r[0]: tuple(r)[1:] for r in conversations.repair(spark.createDataFrame(rows, CONV)).collect()}
    assert got == {c: plain_repair(r) for c, r in by_conversation(rows).items()}


def test_repair_of_odd_conversations(spark):
    rows = [
        (1, 0, "user", "a?"), (1, 1, "assistant", "b."), (1, 1, "assistant", "b."), (1, 5, "user", "cut"),
        (2, None, None, None), (2, None, "user", "x."), (2, 3, "", "y!"), (2, 3, "system", " \t\n"),
        (3, 0, "system", "s."), (4, 0, "assistant", "only."), (5, 0, "tool", "t."), (5, 1, "User", "caps."),
        (None, 0, "user", "no id."), (None, 0, "user", "no id."), (6, 2, "user", "line\nbreak. \x0b"), (6, 3, "assistant", "z" * 200_000 + "."), (7, 0, "user", "Ünï? "),
    ]
    check_repair(spark, rows)
    assert conversations.repair(spark.createDataFrame([], CONV)).collect() == []


def test_repair_of_long_conversations(spark):
    rng = random.Random(5)
    roles, texts = ["user", "assistant", "assistant", "user", "system", "tool"], ["fine.", "so?", "cut", "", "again!"]
    rows = [(c, t, rng.choice(roles), f"{rng.choice(texts)}" if rng.random() < 0.2 else f"turn {t}{rng.choice('.!?,')}") for c, n in ((1, conversations.WHOLE), (2, conversations.WHOLE + 1), (3, 700), (4, 47)) for t in range(n)]
    check_repair(spark, rows)


def test_segments_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(conversations, "WHOLE_BYTES", 40)
    rows = [(c, t, ("user", "assistant", "user")[(t + c) % 3], f"{'word ' * (t % 4)}{t}.") for c in range(5) for t in range(20)]
    made = {}
    for c, r in by_conversation(rows).items():
        one = conversations._Conversation(c)
        for t in sorted(r):
            one.add(*t)
        assert one.long
        made[c] = one.result()[1:]
    assert made == {c: plain_repair(r) for c, r in by_conversation(rows).items()}


def test_repaired_turns(spark):
    rng = random.Random(7)
    rows = [(c, t, rng.choice(["user", "assistant", "system"]), rng.choice(["ok.", "cut", "", f"{t}?"])) for c in [*range(12), None] for t in range(rng.randint(1, 9))]
    df = spark.createDataFrame(rows, CONV)
    fixed = conversations.repair(df)
    turns = {}
    for r in conversations.repaired_turns(df, fixed).orderBy("conv_id", "position").collect():
        turns.setdefault(r["conv_id"], []).append(r)
    for r in fixed.collect():
        mine = turns.get(r["conv_id"], [])
        assert [t["position"] for t in mine] == list(range(len(mine)))
        assert hashlib.sha256("\n".join(f"{t['role']}:{t['text']}" for t in mine).encode()).hexdigest() == r["repaired_sha256"]
        assert [t["edit"] for t in mine] == [e for e in r["audit"] if e != "D"]


def test_op11_on_the_table(spark):
    rows = []
    every = set()
    for r in table(spark, SF, "conversations").collect():
        every.add(r["conv_id"])
        fault = zlib.crc32(f"{r['conv_id']}:{r['turn']}".encode()) % 20
        role, text = "user" if fault == 4 else r["role"], "" if fault == 1 else r["text"].translate({46: None, 33: None, 63: None}) if fault == 2 else r["text"]
        rows += [(r["conv_id"], r["turn"], role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    want = {c: (0, 0, 0, 0, 0, 0, "", conversations.EMPTY_SHA) for c in every} | {c: plain_repair(r) for c, r in by_conversation(rows).items()}
    got = queries.op11_conversation_repair(spark, SF)
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == want


def test_op11_conversations_without_turns(spark, tmp_path):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    spark.createDataFrame([(gone, 0, "user", "x."), (None, None, None, None)], CONV).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r[0]: tuple(r)[1:] for r in queries.op11_conversation_repair(spark, str(tmp_path)).collect()}
    assert got[gone] == (0, 0, 0, 0, 0, 0, "", conversations.EMPTY_SHA)
    assert got[None][-3:] == (2 if got[None][1] else 0, "D" * got[None][1], conversations.EMPTY_SHA)


# ---------------------------------------------------------------- sharding


def plain_shards(rows, shards=sharding.SHARDS):
    """(doc_id, size, crc, shard, slot) of (doc_id, source, text) rows by whole sorts."""
    seen, items = Counter(), []
    for d, s, t in rows:
        raw = (t or "").encode()
        key = (d, "" if s is None else f"={s}", len(raw) + 1, zlib.crc32(raw))
        h = hashlib.md5(f"{sharding.SEED}:{'null' if d is None else d}:{key[3]}:{key[2]}:{seen[key]}".encode()).hexdigest()
        seen[key] += 1
        items.append((key, h))
    placed = []
    for source in {k[1] for k, _ in items}:
        mine = sorted((h, k) for k, h in items if k[1] == source)
        phase = int(hashlib.md5(f"{sharding.SEED}:{source}".encode()).hexdigest()[:8], 16) / 2**32
        placed += [((i + phase) / len(mine), source, h, k) for i, (h, k) in enumerate(mine)]
    n, out = len(placed), []
    for i, (*_, k) in enumerate(sorted(placed)):
        shard = i * shards // n
        out.append((k[0], k[2], k[3], shard, i - -(-shard * n // shards)))
    return sorted(out, key=str)


def got_shards(df):
    return sorted(((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("bucket", [sharding.BUCKET_ROWS, 7])
def test_shards_against_whole_sorts(spark, monkeypatch, bucket):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", bucket)
    monkeypatch.setattr(sharding, "BROADCAST_RANGES", 10**6 if bucket > 7 else 3)
    rows = [(r["doc_id"], r["source"], r["text"]) for r in table(spark, SF, "documents").collect()]
    assert got_shards(sharding.shard_rows(table(spark, SF, "documents"))) == plain_shards(rows)


def test_every_shard_holds_the_mixture(spark):
    got = sharding.shard_rows(spark.range(4000).selectExpr("id AS doc_id", "CAST(CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('s', id % 37) END AS STRING) AS source", "'t' AS text"), keep=("doc_id", "source")).toPandas()
    assert set(got.groupby("shard").size()) == {500}
    assert all(sorted(g.slot) == list(range(500)) for _, g in got.groupby("shard"))
    share = got.groupby("source").size() / 8
    assert all((got[got.source == s].groupby("shard").size().reindex(range(8), fill_value=0) - n).abs().max() <= 2 for s, n in share.items())


def test_shards_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(sharding, "COPIES", 4)
    rows = [(i, "s" if i % 2 else None, t) for i, t in enumerate(ODD)] + [(None, None, None)] * 23 + [(5, "", "same")] * 9 + [(5, None, "other")]
    df = spark.createDataFrame([(*r, "other", 1) for r in rows], "doc_id long, source string, text string, slot string, _h int")
    assert got_shards(sharding.shard_rows(df, keep=("doc_id", "slot"))) == plain_shards(rows)


def test_shards_of_few_and_no_rows(spark, tmp_path):
    empty = sharding.shard_rows(docs(spark, []))
    assert empty.collect() == [] and empty.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    few = sharding.shard_rows(docs(spark, ["a", "b", None]), keep=("doc_id", "text"))
    assert sorted(r["slot"] for r in few.collect()) == [0, 0, 0] and few.columns[:2] == ["doc_id", "text"]
    with pytest.raises(ValueError, match="shard"):
        sharding.shard_rows(docs(spark, []), shards=0)
    sharding.write_shards(sharding.shard_rows(docs(spark, [f"t{i}" for i in range(20)]), keep=("doc_id", "text")), f"{tmp_path}/out", rows=2)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.count() == 20 and {r["shard"] for r in back.collect()} == set(range(8))


# ---------------------------------------------------------------- whitening

VECTORS = "vec_id long, embedding array<float>, label int"


def check_whitening(rows, got, weights="one", components=4):
    """Against numpy over (id, vector) rows of one length."""
    sound = [(i, [math.floor(256 * np.float64(np.float32(c))) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    every = np.array([v for _, v in sound], dtype=np.int64)
    x, counts = np.unique(every, axis=0, return_counts=True)
    w = counts if weights == "count" else np.ones(len(x), dtype=np.int64)
    n, s = int(w.sum()), (x * w[:, None]).sum(axis=0)
    c = x - s / n
    e, v = np.linalg.eigh((c * w[:, None]).T @ c / n)
    e, v = e[::-1][:components], v[:, ::-1][:, :components]
    assert sorted((r["vec_id"], r["component"]) for r in got) == sorted((i, k + 1) for i, _ in sound for k in range(len(e)))
    by = {}
    for r in got:
        by.setdefault((r["vec_id"], r["component"]), []).append(r)
    signs = {}
    for i, vec in sound:
        for k in range(len(e)):
            r = by[i, k + 1][0]
            assert r["n"] == n and r["deviation"] == sum((n * a - int(b)) ** 2 for a, b in zip(vec, s, strict=True))
            z = float((np.array(vec) - s / n) @ v[:, k] / math.sqrt(e[k]))
            assert abs(abs(z) - abs(r["whitened"])) < 1e-9
            if abs(z) > 1e-3:
                assert signs.setdefault(k, z * r["whitened"] > 0) == (z * r["whitened"] > 0)
            assert r["explained"] == pytest.approx(e[k] / np.trace((c * w[:, None]).T @ c / n)) and r["identity_error"] < 1e-9


@pytest.mark.parametrize("weights", ["one", "count"])
@pytest.mark.parametrize("heavy", [whitening.HEAVY, 10])
def test_whitening_against_numpy(spark, monkeypatch, weights, heavy):
    monkeypatch.setattr(whitening, "HEAVY", heavy)
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(size=6) * [3, 2, 1, 0.5, 0.2, 0.1]]) for i in range(80)]
    rows += [(100 + i, rows[0][1]) for i in range(60)] + [(200 + i, rows[1][1]) for i in range(3)]
    odd = [(900, None), (901, [None] * 6), (902, [math.nan] * 6), (903, [math.inf, *[0.0] * 5]), (904, [-0.0] * 6), (905, [1.0, None, 0.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows + odd], VECTORS)
    check_whitening(rows + odd, whitening.whiten(df, weights=weights).collect(), weights)


def test_whitening_of_the_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, SF, "embeddings").collect()]
    check_whitening(rows, queries.op13_whitening(spark, SF).collect())


def test_whitening_of_odd_tables(spark):
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    empty = whitening.whiten(spark.createDataFrame([(1, None, 1), (2, [], 1)], VECTORS))
    assert empty.columns == names and empty.collect() == []
    flat = whitening.whiten(spark.createDataFrame([(None, [1.0, 2.0], 1), (None, [1.0, 2.0], 1)], VECTORS)).collect()
    assert len(flat) == 4 and {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in flat} == {(1, 0, 0.0, 0.0, 0.0)}
    mixed = whitening.whiten(spark.createDataFrame([(i, [float(i), float(i * i % 7)][: 1 + i % 2], 1) for i in range(20)], VECTORS)).collect()
    assert Counter(r["component"] for r in mixed) == {1: 20, 2: 10} and {r["n"] for r in mixed} == {10}
    far = whitening.whiten(spark.createDataFrame([(1, [3e38, 0.0], 1), (2, [0.0, 1.0], 1), (3, [-3e38, 2.0], 1)], VECTORS)).collect()
    assert {r["deviation"] for r in far if r["vec_id"] != 2} == {None} and all(math.isfinite(r["whitened"]) for r in far)
    clash = whitening.whiten(spark.createDataFrame([(1, [1.0], 9), (2, [2.0], 9)], "n long, embedding array<double>, x int"), keep=("n", "x"))
    assert clash.columns == ["x", *names[1:]]
    with pytest.raises(ValueError, match="weights"):
        whitening.whiten(spark.createDataFrame([], VECTORS), weights="two")

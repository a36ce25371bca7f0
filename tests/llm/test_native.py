"""Queries with a statement against DuckDB; sharding, chat formatting and mixing by their contracts."""

from __future__ import annotations

import hashlib
import os
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from oracle_check import compare
from refyield.llm import chat, mixing, sharding
from refyield.llm.queries import ORACLE_SQL, QUERIES

SF_DIR = "/root/testdata/sf0.001"


def duck(folder):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "conversations", "benchmark", "embeddings"):
        path = f"{folder}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_statement_on_driver_tables(spark, name):
    if not os.path.isdir(SF_DIR):
        pytest.skip("driver tables not present")
    ok, msg = compare(spark, duck(SF_DIR), name, QUERIES[name], ORACLE_SQL[name], SF_DIR)
    assert ok, msg


@pytest.mark.parametrize("name", ["op2_rendezvous_shards", "op5_mix_sources"])
def test_statement_on_odd_rows(spark, odd, name):
    ok, msg = compare(spark, duck(odd[0]), name, QUERIES[name], ORACLE_SQL[name], odd[0])
    assert ok, msg


@pytest.mark.parametrize("name", ["op2_rendezvous_shards", "op5_mix_sources"])
def test_empty_tables(spark, empty, name):
    assert QUERIES[name](spark, empty).count() == 0


def test_shards_follow_the_key_law(spark, odd):
    folder, rows = odd
    got = sharding.op2_rendezvous_shards(spark, folder).collect()
    assert len(got) == len(rows)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, sharding.SHARDS)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    by_key = defaultdict(set)
    for r in got:
        by_key[r.doc_id].add((r.shard, r.grown_shard))
    assert all(len(v) == 1 for v in by_key.values())
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want


def test_weighted_shards_are_in_proportion_and_stable(spark):
    keys = spark.range(20_000)
    old, new = [1.0, 2.0, 1.0], [1.0, 2.0, 1.0, 4.0]
    got = keys.select(
        sharding.rendezvous_shard(F.col("id"), old).alias("a"), sharding.rendezvous_shard(F.col("id"), new).alias("b")
    ).collect()
    share = Counter(r.a for r in got)
    assert abs(share[1] / 20_000 - 0.5) < 0.02 and abs(share[0] / 20_000 - 0.25) < 0.02
    assert all(r.b in (r.a, 3) for r in got)
    assert abs(sum(r.b == 3 for r in got) / 20_000 - 0.5) < 0.02
    with pytest.raises(ValueError):
        sharding.rendezvous_shard(F.col("id"), [1.0, 0.0])


# -- chat -------------------------------------------------------------------------


def test_conversations_read_back(spark, write_tables):
    rng = random.Random(3)
    bits = ["\\", "#", "##", "###", "</turn>", "</turn", "\\b", "\\n", "\n", "a", "é", "### user:\n", "\U0001f600", ""]
    rows = []
    for c in range(12):
        for t in range(rng.randrange(1, 20)):
            text = None if rng.random() < 0.1 else "".join(rng.choice(bits) for _ in range(rng.randrange(12)))
            rows.append((c if c else None, t, rng.choice(["user", "assistant", "system", None, "odd\nrole ##"]), text, "x"))
    rows += [(50, 0, "user", "same", "x"), (50, 0, "user", "same", "x"), (51, None, "assistant", "no turn", "x")]
    folder = write_tables(conversations=spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, node string"))
    got = {r.conv_id: r for r in chat.op4_chat_branches(spark, folder).collect()}
    trap = "\\### Assistant: </turn> ok"
    by_conv = defaultdict(list)
    for c, t, role, text, _ in [*rows, (-7, 0, "user", trap, ""), (-7, 1, "assistant", trap, "")]:
        by_conv[c].append((t is not None, t or 0, role is not None, role or "", text is not None, text or ""))
    assert set(got) == set(by_conv)
    for c, turns in by_conv.items():
        turns = [(role, text) for _, _, _, role, _, text in sorted(turns)]
        loss = "".join(x for r, x in turns if r == "assistant")
        r = got[c]
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_empty_conversations_leave_the_planted_one(spark, empty):
    assert [r.conv_id for r in chat.op4_chat_branches(spark, empty).collect()] == [-7]


def brute_paths(nodes, top):
    out = {}
    trees = defaultdict(dict)
    for t, n, p, s in nodes:
        trees[t][n] = (p, s)
    for t, tree in trees.items():
        inner = {p for p, _ in tree.values()}
        paths = []
        for leaf in tree:
            if leaf in inner:
                continue
            path, n = [], leaf
            while n is not None and n in tree:
                path.append(n)
                n = tree[n][0]
            paths.append((-sum(tree[x][1] for x in path), leaf, path))
        for rank, (_, _, path) in enumerate(sorted(paths)[:top], 1):
            out[t, rank] = path[::-1]
    return out


def test_best_branches_of_random_trees(spark):
    rng = random.Random(5)
    nodes = []
    for t in range(8):
        for n in range(rng.randrange(1, 60)):
            nodes.append((f"t{t}", n, rng.randrange(n) if n and rng.random() < 0.95 else None, float(rng.randrange(5))))
    nodes += [("long", n, n - 1 if n else None, 1.0) for n in range(300)]
    nodes += [("orphan", 5, 77, 1.0)]
    df = spark.createDataFrame(nodes, "tree string, node long, parent long, score double")
    got = defaultdict(list)
    for r in chat.best_paths(df, top=3).collect():
        got[r.tree, r.branch].append((-r.up_from_leaf, r.node))
    assert {k: [n for _, n in sorted(v)] for k, v in got.items()} == brute_paths(nodes, 3)


def test_a_cycle_hangs_from_its_smallest_node(spark):
    nodes = [("c", 1, 3, 1.0), ("c", 2, 1, 1.0), ("c", 3, 2, 1.0), ("c", 4, 3, 1.0), ("ok", 1, None, 1.0)]
    df = spark.createDataFrame(nodes, "tree string, node long, parent long, score double")
    got = sorted((r.tree, -r.up_from_leaf, r.node) for r in chat.best_paths(df).collect())
    assert [n for t, _, n in got if t == "c"] == [1, 2, 3, 4]


# -- mixing -----------------------------------------------------------------------


def sainte_lague(votes, seats):
    won = [0] * len(votes)
    for _ in range(seats):
        i = max((i for i, v in enumerate(votes) if v > 0), key=lambda i: (votes[i] / (2 * won[i] + 1), -i))
        won[i] += 1
    return won


def test_apportionment_equals_seat_by_seat(spark):
    rng = random.Random(2)
    rows, want = [], {}
    for g in range(30):
        votes = [float(rng.choice([0, 1, 5, 5, 10, rng.randrange(1000)])) for _ in range(rng.randrange(1, 9))] + [1.0]
        seats = rng.randrange(40)
        for i, (v, s) in enumerate(zip(votes, sainte_lague(votes, seats), strict=True)):
            rows.append((g, i, v, seats))
            want[g, i] = s
    df = spark.createDataFrame(rows, "g long, p long, votes double, seats long")
    got = {(r.g, r.p): r.won for r in mixing.apportion(df, ["g"], ["p"], "votes", "seats", "won").collect()}
    assert got == want


def test_mix_keeps_its_contract(spark, odd):
    folder, rows = odd
    got = mixing.op5_mix_sources(spark, folder).collect()
    assert got == mixing.op5_mix_sources(spark, folder).collect() or sorted(map(str, got)) == sorted(map(str, mixing.op5_mix_sources(spark, folder).collect()))
    assert len(got) == len(rows)
    assert all(0 <= r.taken <= 3 * r["size"] for r in got)


def test_mix_comes_near_its_targets(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["a", "b", "b", "b", "b", "c", None]), rng.randrange(0, 400)) for i in range(6000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, size long"), shard_rows=500).collect()
    size, taken, target = Counter(), Counter(), {}
    for r in got:
        size[r.source] += r["size"]
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 3 * r["size"]
    assert abs(sum(target.values()) - sum(size.values())) < 1e-3
    for s, t in target.items():
        assert t <= 3 * size[s] + 1e-6 and abs(taken[s] - t) <= 0.005 * t


def test_a_hot_id_is_dealt_over_shards(spark):
    """A third of all rows share an id, a third have none: shards stay within their size."""
    rows = [(1 if i % 3 else None, "a", 5, f"t{i}") for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long, tie string")
    shards = df.select((mixing.hash_long(F.lit(mixing.SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("tie")) % 12).alias("s"))
    assert shards.groupBy("s").count().agg(F.max("count")).first()[0] < 700
    got = [mixing.mix(df.repartition(n), shard_rows=500, tie="tie").select("tie", "taken").collect() for n in (2, 5)]
    assert sorted(map(tuple, got[0])) == sorted(map(tuple, got[1]))

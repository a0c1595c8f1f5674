import hashlib
import re
import zlib
from collections import defaultdict

import duckdb
import pytest

from tendril.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string, node long, depth int, k0 string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[c].append((turn is not None, turn or 0, digest, role, text))
    turns = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    h = {c: zlib.crc32(str(c).encode()) % 4 for c in turns}
    rebuilt = {c: tuple(turns.get(c - c % 20, [])[: h[c]] + t[h[c] :]) for c, t in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, t in rebuilt.items():
        ends[t].append(c)
        for d in range(len(t) + 1):
            members[t[:d]].append(c)
    leaves, saved, children = defaultdict(int), defaultdict(int), defaultdict(int)
    for s, m in members.items():
        if s:
            children[s[:-1]] += 1
    for s, m in members.items():
        value = (len(m) - 1) * len(re.findall(T.WORDS, s[-1][1])) if s else 0
        for d in range(len(s) + 1):
            leaves[s[:d]] += s not in children
            saved[s[:d]] += value
    key = lambda s: min(members[s])
    return sorted(
        (key(s), len(s), key(s[:-1]) if s else -1, len(m), children[s], leaves[s], saved[s], hashlib.sha256(",".join(map(str, sorted(ends[s]))).encode()).hexdigest()) for s, m in members.items()
    )


def result(df):
    return sorted(tuple(-1 if r[x] is None else r[x] for x in NAMES) for r in df.collect())


ODD = [
    (0, 1, "user", "a b c"), (0, 2, "bot", None), (0, 2, "bot", None), (0, None, None, "first"), (1, 5, "user", "a b c"), (1, 6, "bot", "x"), (2, 1, "user", ""), (3, 1, None, None), (20, 1, "u", "only here"),
    (25, 1, "u", "q"), (26, 1, "u", "q"), (26, 2, "u", "q r s t"), (26, 2, "u", "q r s"), (27, 1, "u", "q"), (27, 2, "u", "q r s"), (44, 3, "x", "no base"), (45, 3, "x", "no base"), (46, 1, "x", "y"), (None, 1, "u", "lost"), (47, 2, "a:b", "c"), (48, 2, "a", ":bc"),
]


@pytest.mark.parametrize("local", [1, 2, 50_000])
def test_trie_of_odd_rows_equals_brute_force(spark, local):
    df = spark.createDataFrame([(*r, 1, 2, "k") for r in ODD], SCHEMA).repartition(3)
    assert result(T.prefix_trie(df, local=local)) == brute(ODD)


def test_no_conversations(spark):
    assert T.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.fixture(scope="module")
def hot_and_deep():
    """A conversation with a third of all rows, another that leaves it half-way, and many copies of one."""
    rows = [(7, t, "u", f"word {t % 11}") for t in range(400)] + [(47, t, "u", f"word {t % 11}") for t in range(200)] + [(47, 200, "u", "leaves")]
    return rows + [(1000 + k, t, "u", f"copy {t} x y") for k in range(120) for t in range(5)]


@pytest.mark.parametrize("local", [40, 50_000])
def test_deep_and_copied_conversations(spark, hot_and_deep, local):
    df = spark.createDataFrame([(*r, 1, 2, "k") for r in hot_and_deep], SCHEMA).repartition(5)
    assert result(T.prefix_trie(df, local=local)) == brute(hot_and_deep)


def test_ends_in_pieces(spark):
    df = spark.range(500).selectExpr("CAST(1 AS BIGINT) AS node", "CAST(2 AS BIGINT) AS depth", "id AS conv_id").union(spark.range(40).selectExpr("id", "id % 2", "id"))
    got = {(r.node, r.depth): r.ends_sha256 for r in T.ends_digests(df.distinct(), piece=30).collect()}
    assert len(got) == 41 and got[1, 2] == hashlib.sha256(",".join(map(str, range(500))).encode()).hexdigest() and got[6, 0] == hashlib.sha256(b"6").hexdigest()


def test_running_sums_go_on_in_the_next_task(spark):
    df = spark.range(900).selectExpr("CASE WHEN id < 700 THEN 5 ELSE id % 3 END AS key", "id AS at", "CAST(1 AS BIGINT) AS nth")
    got = T.running(df.repartition(6), "key", [T.c("at")], ["nth"]).collect()
    seen = defaultdict(list)
    for r in sorted(got, key=lambda r: r["at"]):
        seen[r["key"]].append(r["nth"])
    assert {k: v == list(range(1, len(v) + 1)) for k, v in seen.items()} == dict.fromkeys(seen, True) and len(seen[5]) == 700


def test_decomposition_adds_up_subtrees():
    import random

    rng = random.Random(3)
    for n in (1, 2, 40, 300):
        parent = [-1] + [rng.choice([k - 1, rng.randrange(k)]) for k in range(1, n)]
        depth = [0] * n
        for k in range(1, n):
            depth[k] = depth[parent[k]] + 1
        order = sorted(range(n), key=lambda k: depth[k])
        place = {k: i for i, k in enumerate(order)}
        up = [-1 if parent[k] < 0 else place[parent[k]] for k in order]
        value = [rng.randrange(100) for _ in range(n)]
        own = [rng.randrange(1, 9) for _ in range(n)]
        weight, expected = own[:], value[:]
        for k in reversed(range(1, n)):
            weight[up[k]] += weight[k]
            expected[up[k]] += expected[k]
        added = [[0] * n]
        T.decompose(range(n), up, weight, [value], added)
        assert added[0] == expected


def test_query_equals_brute_force_and_sql(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = result(T.op12_conversation_trie(spark, folder))
    assert got == brute(rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
    sql = con.execute(f"SELECT {', '.join(NAMES)} FROM ({T.OP12_SQL})").fetchall()
    assert sorted(tuple(-1 if v is None else v for v in r) for r in sql) == got

import hashlib
import random
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from pitlane.llm import conversation_trie as C
from pitlane.llm.common import staged, table

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def key(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def ordered(rows):
    """conv_id -> turns in order."""
    out = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            out.setdefault(conv, []).append((turn is not None, turn or 0, key(role or "", text or ""), (role or "", text or "")))
    return {c: [t[3] for t in sorted(v, key=lambda t: t[:3])] for c, v in out.items()}


def mixed(convs):
    out = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        head = c - (abs(c) % 5 if c >= 0 else -(abs(c) % 5))
        out[c] = convs.get(head, [])[:h] + turns[h:]
    return out


def brute(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = Counter()
    for path, ids in members.items():
        under = [p for p in members if p[: len(path)] == path]
        sizes = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in under if p)
        leaves = sum(not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in under) for p in under)
        children = sum(len(p) == len(path) + 1 for p in under)
        ends = sorted(c for c in ids if len(convs[c]) == len(path))
        sha = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        out[min(ids), len(path), min(members[path[:-1]]) if path else None, len(ids), children, leaves, sizes, sha] += 1
    return out


def result(df):
    assert df.columns == COLUMNS
    return Counter(tuple(r) for r in df.collect())


def frame(spark, rows):
    schema = "conv_id long, turn long, role string, text string"
    return spark.createDataFrame(rows, schema).withColumn("depth", F.lit("x")).withColumn("key", F.lit(1)).withColumn("prefix", F.lit(None).cast("string"))


def made(n, seed, kinds=3, most=7):
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(-20, 3 * n), n):
        for t in range(rnd.randrange(1, most)):
            rows.append((c, rnd.choice([t, t, t, None]), rnd.choice(["user", "assistant", None]) if t else "user", rnd.choice(["", None, "é", "bb"][:kinds] + ["same"] * 3)))
    rows += [(None, 0, "user", "lost"), (7, 1, "user", "same"), (7, 1, "user", "same")]
    rnd.shuffle(rows)
    return rows


def test_as_brute_force(spark):
    rows = made(120, 1)
    docs = frame(spark, rows).repartition(5)
    assert result(C.conversation_trie(docs)) == brute(ordered(rows))
    assert result(C.rebuilt_trie(docs)) == brute(mixed(ordered(rows)))


@pytest.mark.parametrize("cells", [8, 64, 1 << 16])
def test_a_poor_sketch_changes_nothing(spark, cells):
    rows = made(60, 2, kinds=4, most=10)
    turns = staged(C.digests(frame(spark, rows)), "test")
    got = C.trie(C.prefixes(turns, F.col("turn").asc_nulls_first()), turns.select("conv_id").distinct(), cells=cells, share=0.01)
    assert result(got) == brute(ordered(rows))


def test_long_conversations_cross_partitions(spark):
    """Two conversations hold nearly all turns and agree up to near their ends; every partition continues one."""
    rows = [(c, t, "user", f"{t % 7}" if t < 890 else f"{t} {c}") for c in (11, 13) for t in range(900)]
    rows += [(12, t, "user", f"{t % 7}") for t in range(300)] + [(14, 0, "user", "0")]
    turns = staged(C.digests(frame(spark, rows).repartition(6)), "test")
    ordered_turns = C.prefixes(turns, F.col("turn").asc_nulls_first())
    got = {(r.conv_id, r.depth): r for r in ordered_turns.collect()}
    assert len(got) == len(rows)
    for c, turns_of in ordered(rows).items():
        assert [got[c, d].last for d in range(1, len(turns_of) + 1)] == [False] * (len(turns_of) - 1) + [True]
        assert got[c, len(turns_of)].bytes_to == sum(len(t[1]) for t in turns_of)
    for d in range(2, 901):
        assert (got[11, d].prefix == got[13, d].prefix) == (d <= 890)
        assert got[11, d].before == got[11, d - 1].prefix
    assert len({bytes(r.prefix) for r in got.values()}) == 890 + 20
    assert result(C.conversation_trie(frame(spark, rows))) == brute_long(ordered(rows))


def brute_long(convs):
    """As ``brute``, by one walk; fits long conversations."""
    root = {"ids": [], "kids": {}, "ends": [], "size": 0}
    for c in sorted(convs):
        node = root
        node["ids"].append(c)
        for t in convs[c]:
            node = node["kids"].setdefault(t, {"ids": [], "kids": {}, "ends": [], "size": len(t[1].encode())})
            node["ids"].append(c)
        node["ends"].append(c)
    order = [(root, 0, None)]
    for node, d, _ in order:
        order += [(k, d + 1, node) for k in node["kids"].values()]
    out = Counter()
    for node, d, parent in reversed(order):
        kids = node["kids"].values()
        node["leaves"] = sum(k["leaves"] for k in kids) or 1
        node["saved"] = (len(node["ids"]) - 1) * node["size"] + sum(k["saved"] for k in kids)
        sha = hashlib.sha256(",".join(map(str, node["ends"])).encode()).hexdigest()
        out[node["ids"][0], d, parent and parent["ids"][0], len(node["ids"]), len(kids), node["leaves"], node["saved"], sha] += 1
    return out


def test_many_equal_conversations(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(5000) for t in range(1 + (c % 3 == 0))]
    assert result(C.conversation_trie(frame(spark, rows))) == brute_long(ordered(rows))


def test_turnless_and_empty(spark):
    assert result(C.rebuilt_trie(frame(spark, []))) == Counter()
    rows = [(c, 0, "user", "x") for c in (1, 2, 3, 4)]  # conversation 0 is absent
    got = result(C.rebuilt_trie(frame(spark, rows)))
    assert got == brute(mixed(ordered(rows)))
    assert any(k[1] == 0 and k[3] == 4 for k in got)
    alone = [(c, 0, "user", "x") for c in range(1, 5) if zlib.crc32(str(c).encode()) % 9 > 0]
    assert result(C.rebuilt_trie(frame(spark, alone))) == brute(mixed(ordered(alone)))


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_given_conversations_and_sql(spark, sf):
    d = f"/root/testdata/sf{sf}"
    conversations = table(spark, d, "conversations")
    got = result(C.rebuilt_trie(conversations))
    assert got == brute_long(mixed(ordered([(r.conv_id, r.turn, r.role, r.text) for r in conversations.collect()])))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{d}/conversations.parquet'")
    want = con.sql(C.SQL)
    assert want.columns == COLUMNS and {str(t) for t in want.types[:7]} == {"BIGINT"}
    assert got == Counter(want.fetchall())

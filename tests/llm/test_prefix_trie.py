import hashlib
import zlib
from collections import defaultdict

import duckdb
import pytest

from faresight.llm import queries as Q
from faresight.llm.prefix_trie import HEIGHT, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, node long, depth long, a string, cnt int, base double, salt string"
RANK = (lambda t: (t is not None, t if t is not None else 0))


def brute(rows):
    """Every node from the definition, one conversation after another."""
    turns = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            turns[c].append((RANK(t), (r or "").encode(), (x or "").encode()))
    for c in turns:
        turns[c] = [(r.decode(), x.decode()) for _, r, x in sorted(turns[c])]
    paths = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        paths[c] = tuple(turns.get(base, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[p[:d]].append(c)
    kids = defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        own = (len(m) - 1) * len(p[-1][1]) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += own
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(str(c) for c in sorted(m) if len(paths[c]) == len(p)).encode()).hexdigest()) for p, m in members.items()), key=repr)


def got(df):
    cols = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 1, 2, "x", 3, 0.5, "y") for r in rows], SCHEMA).repartition(parts)


def edge_rows():
    rows = []
    for c in (0, 1, 2, 3, 99, 100, 101, 205, 1234, -5, -100, -105, 7_000_000_000_003):
        for t in range(abs(c) % 9 + 1):
            rows.append((c, t, ("user", "assistant", None)[t % 3], None if t == 4 else f"text {t} of {'é東' if c % 2 else 'family'}"))
    rows += [(2, None, "user", "first of all"), (3, 1, "user", "same turn"), (3, 1, "user", "same turn"), (3, 1, None, ""), (None, 0, "user", "nobody"),
             (50, 0, "", ""), (51, 0, None, None), (52, None, "x", "y" * 5000)]
    return rows


def test_edge_cases_match_brute_force(spark):
    rows = edge_rows()
    want = brute(rows)
    assert got(prefix_trie(frame(spark, rows))) == want
    assert got(prefix_trie(frame(spark, rows), height=2)) == want


def test_deep_and_hot_conversations(spark):
    # copies of one conversation, a long one that crosses several levels of bands and window chunks
    rows = [(c, t, "user", f"turn {t}") for c in range(1000, 1700, 100) for t in range(3)]
    rows += [(c, t, "u", f"deep {t % 7}") for c in (5000, 5001, 5002) for t in range(HEIGHT * HEIGHT + 40)]
    rows += [(5099, t, "u", f"deep {t % 7}") for t in range(HEIGHT * HEIGHT + 20)]
    assert got(prefix_trie(frame(spark, rows))) == brute(rows)
    long_one = [(0, t, "u", str(t % 3)) for t in range(9000)] + [(0, 1, "u", "1"), (1, 0, "u", "0")]
    out = {(r["conv_id"], r["depth"]): r for r in prefix_trie(frame(spark, long_one)).collect()}
    assert len([k for k in out if k[0] == 0]) == 9002 and out[0, 0]["n_convs"] == 2
    assert all(r["n_leaves"] >= 1 for r in out.values())


def test_many_ends_at_one_node(spark):
    rows = [(c, 0, "user", "hello") for c in range(0, 160_000, 100)] + [(7, 0, "user", "bye")]
    assert got(prefix_trie(frame(spark, rows, 8))) == brute(rows)


def test_empty_table(spark):
    df = prefix_trie(frame(spark, []))
    assert df.collect() == [] and df.columns[0] == "conv_id"
    assert prefix_trie(frame(spark, [(None, 1, "a", "b")])).collect() == []


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query_matches_sql_and_brute_force(spark, sf):
    d = f"/root/testdata/{sf}"
    mine = got(Q.op11_prefix_trie(spark, d))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{d}/conversations.parquet')")
    rel = con.sql(Q.ORACLES["op11_prefix_trie"])
    order = [rel.columns.index(c) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")]
    assert sorted((tuple(r[i] for i in order) for r in rel.fetchall()), key=repr) == mine
    assert brute(con.sql("SELECT conv_id, turn, role, text FROM conversations").fetchall()) == mine

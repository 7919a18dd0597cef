import hashlib
import zlib
from collections import defaultdict

import duckdb

from faresight.llm import queries as Q
from faresight.llm.merkle import SPAN, audit, manifest

from .conftest import DOC_SCHEMA

COLS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
EXTRA = DOC_SCHEMA + ", k string, g long, digest string, superblock long, start int, other string"


def H(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([H(last[i:i + 16]) for i in range(0, len(last), 16)])
    return levels


def brute(docs):
    """docs: (doc_id, source, lang, n_chars, text)."""
    by = defaultdict(list)
    for r in docs:
        by[r[1]].append(r)
    keys = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees, rows = {}, {}
    for s in keys:
        rows[s] = sorted(((r[0] is not None, r[0] or 0, leaf(r)), r) for r in by[s])
        trees[s] = tree([k[2] for k, _ in rows[s]])
    top = tree([trees[s][-1][0] for s in keys])
    out = []
    for a, s in enumerate(keys):
        for i, (_, r) in enumerate(rows[s]):
            path, at = [], i
            for levels, start in ((trees[s], i), (top, a)):
                at = start
                for lv in levels[:-1]:
                    lo = at - at % 16
                    path.append((lv[lo:at], lv[at + 1:lo + 16]))
                    at //= 16
            seen = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                seen = (*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]))
            node = leaf(seen)
            for left, right in path:
                node = H([*left, node, *right])
            out.append((r[0], leaf(r), trees[s][-1][0], top[-1][0], H(x for left, right in path for x in left + right), node, node == top[-1][0]))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r[c] for c in COLS) for r in df.collect()), key=repr)


def frame(spark, docs, parts=4):
    return spark.createDataFrame([(r[0], r[4], r[2], r[1], r[3], 1, 2, 3, 4, "a", "b", 0.5, 1, "k", 5, "d", 6, 7, "o")
                                  for r in docs], EXTRA.replace("k int", "kk int")).repartition(parts)


def test_edge_rows(spark):
    docs = [(i, f"s{i % 3}" if i % 4 else None, None if i % 5 else "en", i if i % 2 else None, f"Text {i}" if i % 7 else None) for i in range(60)]
    docs += [(None, "s1", "en", 3, "No Id"), (None, "s1", "en", 3, "No Id"), (None, None, None, None, None), (5, "s2", "de", 1, "Other"), (5, "s2", "de", 1, "Other"),
             (70, "", "en", 0, ""), (71, "Ünïcode 東", "en", 9, "Größe 東京 ABC"), (72, "=", "x", 2**40, "LONG " * 50_000), (2**53 + 1, "s1", "en", 1, "Big Id"), (2**53 + 2, "s1", "en", 1, "Big Id")]
    assert got(audit(frame(spark, docs))) == brute(docs)


def test_sizes_around_a_run_and_a_piece(spark):
    docs, n = [], 0
    for s, size in enumerate((1, 15, 16, 17, 255, 256, 257, SPAN, SPAN + 1, 2 * SPAN + 17)):
        for _ in range(size):
            docs.append((n, f"g{s:02d}", "en", n % 50, f"Doc {n}"))
            n += 1
    assert got(audit(frame(spark, docs))) == brute(docs)


def test_more_groups_than_a_piece_holds(spark):
    docs = [(i, f"group {i % (SPAN + 300)}", "en", 1, f"Doc {i}") for i in range(SPAN + 900)]
    assert got(audit(frame(spark, docs))) == brute(docs)


def test_without_tampering_everything_verifies(spark):
    docs = [(i, "a", "en", 1, "X") for i in range(40)]
    out = manifest(frame(spark, docs)).collect()
    assert len(out) == 40 and all(r["verified"] for r in out) and len({r["root"] for r in out}) == 1
    one = audit(frame(spark, docs[:1])).collect()
    assert one[0]["leaf"] == one[0]["subroot"] == one[0]["root"] and one[0]["proof_sha256"] == H([])


def test_empty_table(spark):
    assert audit(frame(spark, [])).collect() == []


def test_query_matches_sql_and_brute_force(spark, sf_dir):
    mine = got(Q.op12_merkle_manifest(spark, sf_dir))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf_dir}/documents.parquet')")
    rel = con.sql(Q.ORACLES["op12_merkle_manifest"])
    order = [rel.columns.index(c) for c in COLS]
    assert sorted((tuple(r[i] for i in order) for r in rel.fetchall()), key=repr) == mine
    assert brute(con.sql("SELECT doc_id, source, lang, n_chars, text FROM documents").fetchall()) == mine
    assert any(not r[-1] for r in mine) and any(r[-1] for r in mine)

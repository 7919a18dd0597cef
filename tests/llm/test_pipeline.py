import duckdb
import pytest

import corpus_pipeline as P
from faresight.llm import queries as Q
from faresight.llm.common import Workspace, components, join_back
from tests.llm.conftest import sentence


def test_components_match_union_find(spark):
    import random
    r = random.Random(5)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(r.randint(300, 400), r.randint(300, 400)) for _ in range(70)] + [(500, 500)]
    comp = {}

    def root(x):
        while comp.setdefault(x, x) != x:
            x = comp[x]
        return x
    for a, b in edges:
        if a != b:
            x, y = root(a), root(b)
            comp[max(x, y)] = min(x, y)
    got = components(Workspace(spark, "t"), spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r.node: r.component for r in got} == {x: root(x) for x in comp} and len(got) == len(comp)
    assert components(Workspace(spark, "t"), spark.createDataFrame([], "u long, v long")).count() == 0


def test_join_back_splits_heavy_keys(spark):
    rows = spark.range(3000).selectExpr("id", "if(id % 3 = 0, 0, id) as k")
    stats = rows.groupBy("k").count().withColumnRenamed("count", "cnt").selectExpr("k", "k * 2 as twice", "cnt")
    out = join_back(rows, stats, ["k"], 3000)
    assert out.count() == 3000 and out.filter("twice <> 2 * k").count() == 0


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    ws, out = Workspace(spark, "test"), [spark.read.parquet(f"{sf_dir}/documents.parquet")]
    for k, (_, stage) in enumerate(P.STAGES):
        out.append(ws.table(stage(spark, out[-1], sf_dir), f"s{k}"))
    return out


def test_stages_keep_the_columns_and_take_effect(stages):
    docs, good, unique, cut, mixed, packed = stages
    for s in (good, unique, cut, mixed):
        assert s.columns == docs.columns
    n = [s.count() for s in stages]
    assert n[0] > n[1] > n[2] == n[3] <= n[4]
    ids = lambda s: {r.doc_id for r in s.select("doc_id").collect()}
    assert ids(unique) <= ids(good) <= ids(docs) and ids(cut) == ids(mixed) == ids(unique) == ids(packed)


def test_quality_stage_keeps_good_and_drops_bad(spark, sf_dir, stages):
    kept = {r.doc_id for r in stages[1].collect()}
    lab = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    assert sum((r.quality == 1) == (r.doc_id in kept) for r in lab) >= 0.95 * len(lab)


def test_no_long_passage_is_left_twice(stages):
    seen = set()
    n = P.PASSAGE_BYTES + 200         # cuts join neighbours, so a little slack above the limit
    for r in stages[3].collect():
        b = (r.text or "").encode()
        for x in {b[i:i + n] for i in range(len(b) - n + 1)}:
            assert x not in seen
            seen.add(x)


def test_run_equals_its_stages(spark, sf_dir, stages):
    key = lambda d: sorted(tuple(r) for r in d.select("doc_id", "piece", "length", "ids_crc32").collect())
    assert key(P.run(spark, sf_dir)) == key(stages[-1])


def test_stages_on_edge_rows(edge_docs, no_docs, spark, sf_dir):
    for docs in (edge_docs, no_docs):
        for _, stage in P.STAGES[1:]:
            assert stage(spark, docs, sf_dir).count() >= 0
        assert P.STAGES[0][1](spark, docs, sf_dir).columns == docs.columns


def test_planted_copy_and_passage(spark, sf_dir):
    passage = sentence(900, 60)
    rows = [(1, sentence(901, 90), "en", "a", 1), (2, sentence(901, 90), "en", "b", 1), (3, sentence(902, 50) + " " + passage, "en", "a", 1),
            (4, passage + " " + sentence(903, 50), "en", "b", 1), (5, sentence(904, 90), "en", "a", 1)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id for r in P.near_duplicates(spark, d, sf_dir).collect()}
    assert kept == {1, 3, 4, 5}
    cut = {r.doc_id: r.text for r in P.repeated_passages(spark, d, sf_dir).collect()}
    assert cut[5] == rows[4][1] and passage not in cut[3] and passage not in cut[4] and cut[3].startswith(sentence(902, 50))


def test_one_text_of_each_group_survives_the_chained_stages(edge_docs, spark, sf_dir):
    ws = Workspace(spark, "test")
    # doc 10 (similarity 0.79 with doc 7) is no member of the group, yet shares passages that the next stage cuts
    unique = ws.table(P.near_duplicates(spark, edge_docs.filter("doc_id is null or doc_id <> 10"), sf_dir), "unique")
    cut = ws.table(P.repeated_passages(spark, unique, sf_dir), "cut")
    base, twice = sentence(1, 90), sentence(8, 200)
    for stage in (unique, cut):
        rows = [(r.doc_id, r.text) for r in stage.collect()]
        assert [i for i, t in rows if t and t.lower() == base] == [7]     # 7, 8, 9, 11 and a null id
        assert [i for i, t in rows if t == twice] == [18]                 # a repeated row
        assert {i for i, _ in rows} >= {1, 2, 3, 4, 12, 13, 17, None}     # rows without words stay, null text of a null id too


def test_near_duplicates_are_decided_by_row(spark, sf_dir):
    a, b, c = sentence(911, 90), sentence(912, 90), sentence(913, 90)
    rows = [(1, a), (2, a), (2, b), (None, c), (None, c), (5, c), (6, None), (6, None), (None, sentence(914, 90)), (None, sentence(914, 90))]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = sorted((tuple(r) for r in P.near_duplicates(spark, d, sf_dir).collect()), key=str)
    assert kept == sorted([(1, a), (2, b), (5, c), (6, None), (6, None), (None, sentence(914, 90))], key=str)


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_queries_match_sql(spark, sf_dir, name):
    from tests.test_oracle import _rows
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    df, want = Q.QUERIES[name](spark, sf_dir), con.sql(Q.ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(want.columns, want.fetchall())

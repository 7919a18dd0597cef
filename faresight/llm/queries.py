"""Registered queries of the operators: each applies one to its whole table with
production parameters and derives the digest columns of its contract."""

from __future__ import annotations

from faresight.sources.tables import table_path

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _read(spark, sf_dir, name):
    return spark.read.parquet(table_path(sf_dir, name))


@query
def op1_minhash_near_dedup(spark, sf_dir):
    from faresight.llm.minhash import near_duplicates
    return near_duplicates(_read(spark, sf_dir, "documents"), words=4, percent=80)


ORACLES["op1_minhash_near_dedup"] = """
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN array_to_string(w, ' ') ELSE array_to_string(list_slice(w, i, i + 3), ' ') END AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT u, v FROM shared JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= 80 * (x.n + y.n - c)
), reach(node, root) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT l.v, r.root FROM reach r JOIN links l ON l.u = r.node
), comp AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, coalesce(d.doc_id = c.component_id, false) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN comp c ON c.node = d.doc_id
"""


TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Place of a public tokenizer's file; the same package is installed on executors."""
    import public_tokenizers
    return public_tokenizers.path(name)


@query
def op2_best_fit_packing(spark, sf_dir):
    from faresight.llm.packing import pack
    return pack(_read(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False)


@query
def op10_quality_classifier(spark, sf_dir):
    from faresight.llm.quality import classify
    return classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


@query
def op9_suffix_array_dedup(spark, sf_dir):
    from faresight.llm.rindex import digest
    return digest(_read(spark, sf_dir, "documents"), length=400)


@query
def op4_kneser_ney_scores(spark, sf_dir):
    from faresight.llm.kneser_ney import score_documents
    return score_documents(_read(spark, sf_dir, "documents"))


@query
def op3_embedding_near_dedup(spark, sf_dir):
    from faresight.llm.embed_dedup import near_duplicates
    return near_duplicates(_read(spark, sf_dir, "embeddings"), threshold=0.93)


ORACLES["op3_embedding_near_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
), ok AS (
  SELECT * FROM v WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS u, b.vec_id AS w FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach(node, root) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT l.w, r.root FROM reach r JOIN links l ON l.u = r.node
), comp AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node),
deg AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT e.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, c.component_id, coalesce(e.vec_id = c.component_id, false) AS kept
FROM embeddings e LEFT JOIN comp c ON c.node = e.vec_id LEFT JOIN deg d ON d.u = e.vec_id
"""


@query
def op6_exact_top_k_search(spark, sf_dir):
    from faresight.llm.maxscore import search
    return search(_read(spark, sf_dir, "embeddings"), every=100, k=10)


ORACLES["op6_exact_top_k_search"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), t AS (SELECT vec_id, unnest(e) AS x, generate_subscripts(e, 1) AS d FROM v),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, sum(q.x * c.x)::BIGINT AS score
  FROM t q JOIN t c ON q.d = c.d AND q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0 GROUP BY ALL
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@query
def op5_warc_capture_index(spark, sf_dir):
    from faresight.llm.warc import round_trip
    return round_trip(_read(spark, sf_dir, "pages"))


ORACLES["op5_warc_capture_index"] = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), r AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first = page_id THEN NULL ELSE first END AS refers_to FROM r
"""


MAX_REPEAT = 1.25


@query
def op7_temperature_mixing(spark, sf_dir):
    from faresight.llm.mixing import mix
    from pyspark.sql import functions as F
    return mix(_read(spark, sf_dir, "documents"), max_repeat=MAX_REPEAT).withColumn("weight", F.round("weight", 9))


ORACLES["op7_temperature_mixing"] = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_tokens,
    md5('mix|' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), s AS (
  SELECT source, sum(n_tokens)::DOUBLE AS tokens, sum(n_tokens) / (SELECT sum(n_tokens) FROM d)::DOUBLE AS p FROM d GROUP BY source HAVING sum(n_tokens) > 0
), tot AS (SELECT sum(tokens) AS budget FROM s),
grid AS (SELECT unnest([0.0, 1.0])::DOUBLE AS t),
edge AS (SELECT t, max(pow(p, t) / tokens) / sum(pow(p, t)) * (SELECT budget FROM tot) > {MAX_REPEAT} AS over FROM s, grid GROUP BY t),
b(step, lo, hi) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT step + 1, CASE WHEN over THEN mid ELSE lo END, CASE WHEN over THEN hi ELSE mid END FROM (
    SELECT step, lo, hi, (lo + hi) / 2 AS mid, max(pow(p, (lo + hi) / 2) / tokens) / sum(pow(p, (lo + hi) / 2)) * (SELECT budget FROM tot) > {MAX_REPEAT} AS over
    FROM b, s WHERE step < 40 GROUP BY step, lo, hi)
), t AS (
  SELECT CASE WHEN (SELECT over FROM edge WHERE t = 1) THEN 1.0 WHEN NOT (SELECT over FROM edge WHERE t = 0) THEN 0.0 ELSE hi END AS t FROM b WHERE step = 40
), w AS (
  SELECT source, tokens, pow(p, (SELECT t FROM t)) / (SELECT sum(pow(p, (SELECT t FROM t))) FROM s) AS weight FROM s
), f AS (
  SELECT *, floor(weight * (SELECT budget FROM tot) + 0.5)::BIGINT AS share FROM w
), r AS (
  SELECT d.*, f.weight, (f.share // f.tokens::BIGINT) AS passes, f.share % f.tokens::BIGINT AS rest,
    sum(d.n_tokens) OVER (PARTITION BY d.source ORDER BY h, d.doc_id) AS used
  FROM d LEFT JOIN f ON d.source IS NOT DISTINCT FROM f.source
)
SELECT doc_id, source, n_tokens, round(weight, 9) AS weight, coalesce(passes + CASE WHEN used <= rest THEN 1 ELSE 0 END, 0)::BIGINT AS copies, substr(h, 1, 2) AS block FROM r
"""


PIECES = "piece_bpe_32k.model"


@query
def op8_token_counts(spark, sf_dir):
    from faresight.llm.token_counts import count_tokens
    return count_tokens(_read(spark, sf_dir, "documents"), tokenizer_path(PIECES))


def _sql_crc32(text: str) -> str:
    """DuckDB expression of the unsigned CRC-32 of an ASCII string."""
    step = "list_reduce(range(8), lambda x, j: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END, xor(c, b))"
    return f"xor(list_reduce(list_transform(string_split({text}, ''), lambda s: ascii(s)::BIGINT), lambda c, b: {step}, 4294967295), 4294967295)"


@query
def op11_prefix_trie(spark, sf_dir):
    from faresight.llm.prefix_trie import prefix_trie
    return prefix_trie(_read(spark, sf_dir, "conversations"))


ORACLES["op11_prefix_trie"] = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY pos) AS turns, {_sql_crc32('conv_id::VARCHAR')} % 6 AS h FROM t GROUP BY conv_id
), r AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) AS path FROM c LEFT JOIN c b ON b.conv_id = c.conv_id - c.conv_id % 100
), p AS (
  SELECT conv_id, len(path) AS length, path[1:depth] AS key, depth FROM (SELECT *, unnest(range(0, len(path) + 1)) AS depth FROM r)
), n AS (
  SELECT depth, key, min(conv_id) AS conv_id, count(*) AS n_convs, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (length = depth) AS ends
  FROM p GROUP BY depth, key
), e AS (
  SELECT a.*, b.conv_id AS parent FROM n a LEFT JOIN n b ON b.depth = a.depth - 1 AND b.key = a.key[1:a.depth - 1]
), k AS (SELECT parent, depth - 1 AS depth, count(*) AS n_children FROM e WHERE depth > 0 GROUP BY ALL),
f AS (
  SELECT e.*, coalesce(n_children, 0) AS n_children, CASE WHEN e.depth = 0 THEN 0 ELSE (n_convs - 1) * length(key[e.depth].text) END AS saved
  FROM e LEFT JOIN k ON k.parent = e.conv_id AND k.depth = e.depth
), s AS (
  SELECT n.conv_id, n.depth, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved
  FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM f) f JOIN n ON n.depth = f.up AND n.key = f.key[1:f.up] GROUP BY ALL
)
SELECT f.conv_id, f.depth, parent AS parent_conv_id, n_convs, n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens,
  sha256(coalesce(ends, '')) AS ends_sha256 FROM f JOIN s ON s.conv_id = f.conv_id AND s.depth = f.depth
"""


@query
def op12_merkle_manifest(spark, sf_dir):
    from faresight.llm.merkle import audit
    return audit(_read(spark, sf_dir, "documents"), every=5)


def _sql_merkle(levels: int = 8) -> str:
    """Leaves, then ``levels`` levels by source and as many over the subroots (16**8 nodes each)."""
    def field(c):
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR END"

    def leaf(text):
        return "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    ctes = [f"""l AS (SELECT *, {leaf('text')} AS leaf, CASE WHEN {_sql_crc32('doc_id::VARCHAR')} % 5 = 0 THEN {leaf(lower)} ELSE {leaf('text')} END AS seen FROM documents)""",
            """a0 AS (SELECT coalesce('=' || source, '') AS k, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
  count(*) OVER (PARTITION BY source) AS n, leaf AS node, doc_id, seen FROM l)"""]

    def climb(a):
        for v in range(levels):
            ctes.append(f"""{a}{v + 1} AS (SELECT k, CASE WHEN n > 1 THEN i // 16 ELSE i END AS i, CASE WHEN max(n) > 1 THEN (max(n) + 15) // 16 ELSE 1 END AS n,
  CASE WHEN max(n) > 1 THEN sha256(string_agg(node, '' ORDER BY i)) ELSE any_value(node) END AS node FROM (SELECT k, i, n, node FROM {a}{v}) GROUP BY k, CASE WHEN n > 1 THEN i // 16 ELSE i END)""")
    climb("a")
    ctes.append(f"b0 AS (SELECT '' AS k, k AS source, row_number() OVER (ORDER BY k) - 1 AS i, count(*) OVER () AS n, node FROM a{levels})")
    climb("b")
    ctes.append("w0 AS (SELECT k, doc_id, node AS leaf, seen AS folded, i, '' AS proof FROM a0)")

    def fold(w, a, last, key):
        """One level: the run's other nodes enter the proof, the run with the own node in its place gives the next."""
        for v in range(levels):
            at = last + v
            ctes.append(f"""s{w}{v} AS (SELECT k, i // 16 AS run, any_value(n) AS n, list(node ORDER BY i) AS nodes FROM {a}{v} GROUP BY k, i // 16)""")
            ctes.append(f"""w{at + 1} AS (SELECT w.k, doc_id, leaf, CASE WHEN s.n > 1 THEN sha256(list_aggregate(list_concat(s.nodes[1:w.i % 16], [folded], s.nodes[w.i % 16 + 2:]), 'string_agg', '')) ELSE folded END AS folded,
  CASE WHEN s.n > 1 THEN w.i // 16 ELSE w.i END AS i,
  proof || CASE WHEN len(s.nodes) > 1 THEN list_aggregate(list_concat(s.nodes[1:w.i % 16], s.nodes[w.i % 16 + 2:]), 'string_agg', '') ELSE '' END AS proof{key}
  FROM w{at} w JOIN s{w}{v} s ON s.k = {'w.k' if w == 'x' else "''"} AND s.run = w.i // 16)""")
    fold("x", "a", 0, "")
    ctes.append(f"v AS (SELECT w.k, doc_id, leaf, folded, b0.i, proof, b0.node AS subroot FROM w{levels} w JOIN b0 ON b0.source = w.k)")
    ctes.append(f"w{levels + 1} AS (SELECT * FROM v)")
    fold("y", "b", levels + 1, ", subroot")
    return "WITH " + ", ".join(ctes) + f"""
SELECT doc_id, leaf, subroot, b.node AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = b.node AS verified FROM w{2 * levels + 1} w, b{levels} b
"""


ORACLES["op12_merkle_manifest"] = _sql_merkle()


BYTE_BPE = "byte_bpe_50k.json"


@query
def op13_forced_boundary_bpe(spark, sf_dir):
    from faresight.llm.bpe import digest
    return digest(_read(spark, sf_dir, "documents"), tokenizer_path(BYTE_BPE))

"""DuckDB SQL of the operators that SQL can express."""

_BENCH_WORDS = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"


def _vector_codes() -> str:
    """Four rounds of assignment (a0..a3) and new entries (n0..n3), then a4."""
    q = [r"""
WITH k AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS r, vec_id, label, list_transform(v, lambda x: CAST(floor(1024 * x) AS BIGINT)) AS v
  FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)
  WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT r, part, v[part * (len(v) // 4) + 1:(part + 1) * (len(v) // 4)] AS x FROM k, range(4) t(part)),
c0 AS MATERIALIZED (SELECT part, r - 1 AS e, x FROM p WHERE r <= 256)"""]
    for i in range(5):
        q.append(f"""a{i} AS MATERIALIZED (SELECT r, p.part, p.x, min(struct_pack(d := list_sum(list_transform(list_zip(p.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, e := c.e)) AS b
  FROM p JOIN c{i} c USING (part) GROUP BY r, p.part, p.x)""")
        if i < 4:
            q.append(f"""n{i} AS (SELECT part, e, list(m ORDER BY j) AS x FROM (SELECT part, b.e AS e, j, CAST(floor(sum(x[j])::HUGEINT / count(*)) AS BIGINT) AS m, sum(x[j]) AS s, count(*) AS n
  FROM a{i}, (SELECT unnest(range(1, (SELECT max(len(x)) FROM p) + 1)) AS j) GROUP BY part, b.e, j) GROUP BY part, e),
c{i+1} AS MATERIALIZED (SELECT part, e, coalesce(n.x, c.x) AS x FROM c{i} c LEFT JOIN n{i} n USING (part, e))""")
    q.append("""f AS (SELECT r, string_agg(printf('%02x', b.e), '' ORDER BY part) AS code, CAST(sum(b.d) AS BIGINT) AS error FROM a4 GROUP BY r),
h AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, e)) AS codebooks_sha256 FROM c4)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM f JOIN k USING (r), h""")
    return ",\n".join(q)


SQL = {
    "op2_substring_dedup": r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
i AS (SELECT doc_id, w, unnest(range(len(w) - 12)) AS i FROM w WHERE len(w) >= 13),
win AS (SELECT doc_id, i, hash(array_to_string(w[i + 1:i + 13], ' ')) AS k FROM i),
first AS (SELECT k, min(doc_id) AS f FROM win GROUP BY k),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM win JOIN first USING (k) WHERE f < doc_id),
g AS (SELECT doc_id, count(*) AS n_removed, list(p) AS ps FROM gone GROUP BY doc_id)
SELECT w.doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(array_to_string(CASE WHEN ps IS NULL THEN w ELSE list_transform(list_filter(range(len(w)), lambda p: NOT list_contains(ps, p)), lambda p: w[p + 1]) END, ' ')) AS kept_sha256
FROM w LEFT JOIN g USING (doc_id)""",
    "op3_exact_dedup": """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
    "op10_benchmark_decontamination": rf"""
WITH d AS (SELECT doc_id, {_BENCH_WORDS} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, {_BENCH_WORDS} AS w FROM benchmark),
bi AS (SELECT item, w, least(len(w), 10) AS n, unnest(range(len(w) - least(len(w), 10) + 1)) AS i FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item, n, array_to_string(w[i + 1:i + n], ' ') AS k FROM bi),
ns AS (SELECT DISTINCT n FROM bw),
di AS (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS i FROM d, ns WHERE len(w) >= n),
dw AS (SELECT doc_id, n, i, array_to_string(w[i + 1:i + n], ' ') AS k FROM di),
h AS (SELECT doc_id, item, n, i FROM dw JOIN bw USING (n, k)),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item) AS n_items, array_to_string(list_sort(list(DISTINCT item)), ',') AS items FROM h GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)""",
    "op11_vector_codes": _vector_codes(),
    "op12_ngram_jaccard": r"""
WITH RECURSIVE d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT r, hash(array_to_string(w[i + 1:i + 4], ' ')) AS k FROM (SELECT r, w, unnest(range(greatest(len(w) - 3, 1))) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT r, count(*) AS n FROM s GROUP BY r),
l AS MATERIALIZED (SELECT a, b FROM (SELECT x.r AS a, y.r AS b, count(*) AS c FROM s x JOIN s y ON x.k = y.k AND x.r <> y.r GROUP BY x.r, y.r)
  JOIN n p ON p.r = a JOIN n q ON q.r = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
reach AS (SELECT r AS a, r AS b FROM d UNION SELECT reach.a, l.b FROM reach JOIN l ON l.a = reach.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id FROM d LEFT JOIN n USING (r)
JOIN (SELECT reach.a AS r, min(e.doc_id) AS component_id FROM reach JOIN d e ON e.r = reach.b GROUP BY reach.a) c USING (r)""",
    "op13_lexical_search": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_BENCH_WORDS} AS w FROM documents),
g AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS l FROM d WHERE len(w) > 0),
t AS (SELECT r, doc_id, len(w)::BIGINT AS n, t, count(*)::BIGINT AS tf FROM (SELECT r, doc_id, w, unnest(w) AS t FROM d) GROUP BY ALL),
b AS (SELECT DISTINCT item_id, unnest({_BENCH_WORDS}) AS t FROM benchmark),
w AS (SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w FROM (SELECT t, count(*) AS df FROM t GROUP BY t), g),
s AS (SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // l)))) AS BIGINT) AS score
  FROM b JOIN w USING (t) JOIN t USING (t), g GROUP BY item_id, r, doc_id),
k AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 50""",
}

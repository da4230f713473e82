"""DuckDB SQL for the queries of this package that SQL can express."""

_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Components of a table links(a, b) as comp(id, component), by closure from every end.
_COMPONENTS = """
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(id, r) AS (SELECT a, b FROM both_ways UNION SELECT reach.id, both_ways.b FROM reach JOIN both_ways ON reach.r = both_ways.a),
comp AS (SELECT id, least(id, min(r)) AS component FROM reach GROUP BY id)"""

OP3 = f"""WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM {{docs}}),
g AS (SELECT doc_id, list_distinct(CASE WHEN len(w) >= 4
   THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
   WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
s AS (SELECT doc_id, len(g) AS n, unnest(g) AS t FROM g),
rare AS (SELECT * FROM s WHERE t IN (SELECT t FROM s GROUP BY t HAVING count(*) > 1)),
links AS (SELECT x.doc_id AS a, y.doc_id AS b FROM rare x JOIN rare y ON x.t = y.t AND x.doc_id < y.doc_id
  GROUP BY ALL HAVING 100 * count(*) >= 85 * (any_value(x.n) + any_value(y.n) - count(*))),
{_COMPONENTS}
SELECT g.doc_id, len(g.g)::BIGINT AS n_shingles, coalesce(comp.component, g.doc_id) AS component_id
FROM g LEFT JOIN comp ON comp.id = g.doc_id"""

OP10 = rf"""WITH w AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(w) - 48)) AS p, w FROM w),
h AS (SELECT doc_id, p, md5(array_to_string(w[p:p + 49], ' ')) AS h FROM win),
f AS (SELECT h, min(doc_id) AS first FROM h GROUP BY h HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS i FROM h JOIN f USING (h) WHERE doc_id > first),
lost AS (SELECT doc_id, list(i) AS gone, count(*) AS n FROM gone GROUP BY doc_id)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(lost.n, 0)::BIGINT AS n_removed,
  sha256(CASE WHEN lost.n IS NULL THEN array_to_string(w.w, ' ') ELSE coalesce(array_to_string(list_filter(w.w, lambda x, i: NOT list_contains(lost.gone, i)), ' '), '') END) AS kept_sha256
FROM w LEFT JOIN lost ON lost.doc_id = w.doc_id"""

_AFTER = "CASE WHEN position('://' IN coalesce(url, '')) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END"
OP2 = rf"""WITH a AS (SELECT page_id, url, {_AFTER} AS a FROM pages),
h AS (SELECT *, {_LOWER.format("regexp_extract(a, '^[^/?#]*')")} AS host, regexp_replace(a, '^[^/?#]*', '') AS rest FROM a),
p AS (SELECT *, regexp_extract(rest, '^[^?#]*') AS path, host || rest AS subject FROM h),
r(host, path, verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
best AS (SELECT p.page_id, p.url, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS v
  FROM p JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path) GROUP BY ALL),
q AS (SELECT p.*, best.rule, best.v, CASE WHEN regexp_matches(subject, '^[^?#]*\.html(#|$)') THEN 'document'
  WHEN regexp_matches(subject, '[?&]page=[0-9]+([&#]|$)') THEN 'paged' WHEN regexp_matches(subject, '[?&]ref=[^&#]') THEN 'referral' END AS other
  FROM p LEFT JOIN best ON p.page_id IS NOT DISTINCT FROM best.page_id AND p.url IS NOT DISTINCT FROM best.url)
SELECT page_id, host, path, rule, CASE WHEN position('://' IN coalesce(url, '')) = 0 THEN 'block' WHEN rule IS NOT NULL THEN v
  WHEN other IN ('paged', 'referral') THEN 'block' ELSE 'allow' END AS verdict,
  CASE WHEN rule IS NULL THEN other END AS pattern FROM q"""

_HEX = "('0x' || substr(hex || '0', (i * 5) // 4 + 1, 3))::INTEGER"
OP6 = f"""WITH s AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS hex FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first FROM s)
SELECT page_id, n::BIGINT AS payload_bytes, array_to_string(list_transform(range(32), lambda i:
  substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (({_HEX} >> (7 - (i * 5) % 4)::INTEGER) & 31) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to FROM f"""

OP4 = rf"""WITH d AS (SELECT doc_id, source, len({_WORDS.format("coalesce(text, '')")})::BIGINT AS size,
  ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 13))::BIGINT AS u FROM {{docs}}),
t AS (SELECT source, sum(size)::BIGINT AS s FROM d GROUP BY source),
w AS (SELECT *, 2 * s AS cap, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INTEGER] AS w FROM t),
l AS (SELECT *, sum(s) OVER () * 150 AS total, coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_,
  sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_ FROM w WINDOW o AS (ORDER BY cap / w, source NULLS LAST)),
v AS (SELECT *, max((total / 100 - full_) / left_) OVER () AS level FROM l),
a AS (SELECT source, s, least(cap::DOUBLE, level * w) AS target FROM v),
b AS (SELECT *, CASE WHEN s > 0 THEN floor(target / s) ELSE 0 END AS certain FROM a),
c AS (SELECT *, target - certain * s AS rest, CASE WHEN s > 0 THEN (target - certain * s) / s ELSE 0 END AS p FROM b),
x AS (SELECT d.*, c.s, c.target, c.certain, c.rest, c.p, sum(size) OVER (PARTITION BY d.source ORDER BY u, size, d.doc_id ROWS UNBOUNDED PRECEDING) AS upto
  FROM d JOIN c ON d.source IS NOT DISTINCT FROM c.source)
SELECT doc_id, size, s AS source_size, target, ((certain + CASE WHEN p > 0 AND upto - size / 2 <= rest THEN 1 ELSE 0 END) * size)::BIGINT AS taken FROM x"""

#: Exact links by comparing all vectors of a label.
OP9 = f"""WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e, sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS n
  FROM embeddings),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id < y.vec_id
  AND list_dot_product(x.e, y.e) / (x.n * y.n) >= 0.98),
{_COMPONENTS},
c AS (SELECT a, count(*) AS n FROM both_ways GROUP BY a)
SELECT v.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, coalesce(comp.component, v.vec_id) AS component_id,
  v.vec_id = coalesce(comp.component, v.vec_id) AS kept FROM v LEFT JOIN c ON c.a = v.vec_id LEFT JOIN comp ON comp.id = v.vec_id"""

#: crc32 of the decimal digits of an integer column, bit by bit.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length({0}::VARCHAR) * 9 + 1),
  lambda k: CASE WHEN k % 9 = 1 THEN ascii(substr({0}::VARCHAR, ((k - 1) // 9 + 1)::INTEGER, 1))::BIGINT ELSE -1 END)),
  lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"""


def _mark(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen({column}::VARCHAR)::VARCHAR || ':' || {column}::VARCHAR END"


def _tree(name: str, leaves: str, levels: int = 6) -> str:
    """Tables of a tree by group g over ``leaves`` (g, pos, h, n): {name}_i its levels, {name}_top (g, h), {name}_path
    (g, pos, l0, r0, l1, ..): the siblings left and right of each leaf on every level (null where there is none)."""
    out = [f"{name}_0 AS (SELECT g, pos, h, n FROM {leaves})"]
    for i in range(levels):
        out.append(f"""{name}_{i + 1} AS (SELECT g, pos // 16 AS pos, CASE WHEN n > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE any_value(h) END AS h,
  (n + 15) // 16 AS n FROM {name}_{i} GROUP BY g, pos // 16, n)""")
        out.append(f"""{name}_s{i} AS (SELECT x.g, x.pos, CASE WHEN x.n > 1 THEN coalesce(string_agg(y.h, '' ORDER BY y.pos) FILTER (y.pos < x.pos), '') END AS l,
  CASE WHEN x.n > 1 THEN coalesce(string_agg(y.h, '' ORDER BY y.pos) FILTER (y.pos > x.pos), '') END AS r
  FROM {name}_{i} x JOIN {name}_{i} y ON x.g = y.g AND x.pos // 16 = y.pos // 16 GROUP BY x.g, x.pos, x.n)""")
    out.append(f"{name}_top AS (SELECT g, h FROM {name}_{levels})")
    sides = ", ".join(f"s{i}.l AS l{i}, s{i}.r AS r{i}" for i in range(levels))
    joins = " ".join(f"JOIN {name}_s{i} s{i} ON s{i}.g = x.g AND s{i}.pos = x.pos // {16 ** i}" for i in range(levels))
    out.append(f"{name}_path AS (SELECT x.g, x.pos, {sides} FROM {name}_0 x {joins})")
    return ",\n".join(out)


def _chained(name: str, source: str, path: str, levels: int = 6) -> str:
    """Folding as a chain of tables, so that no level's expression holds the one below twice."""
    steps = [f"{name}_0 AS (SELECT *, start AS h FROM {source})"]
    for i in range(levels):
        steps.append(f"{name}_{i + 1} AS (SELECT * REPLACE (CASE WHEN {path}l{i} IS NULL THEN h ELSE sha256({path}l{i} || h || {path}r{i}) END AS h) FROM {name}_{i})")
    return ",\n".join(steps)


_LEAF = "sha256(" + " || ".join(_mark(c) for c in ("doc_id", "source", "lang", "n_chars", "{0}")) + ")"
_JOINED = " || ".join(f"coalesce({{0}}l{i} || {{0}}r{i}, '')" for i in range(6))
OP11 = f"""WITH d AS (SELECT doc_id, source, coalesce('=' || source, '') AS g, {_LEAF.format("text")} AS h,
  CASE WHEN {_CRC.format("doc_id")} % 5 = 0 THEN {_LEAF.format(_LOWER.format("text"))} END AS claim FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM d),
{_tree("doc", "leaves")},
tops AS (SELECT '' AS g, g AS name, h, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM doc_top),
{_tree("src", "tops")},
full_ AS (SELECT leaves.doc_id, leaves.h AS leaf, tops.h AS subroot, (SELECT h FROM src_top) AS root, coalesce(leaves.claim, leaves.h) AS start,
  {", ".join(f"p.l{i} AS d_l{i}, p.r{i} AS d_r{i}, q.l{i} AS s_l{i}, q.r{i} AS s_r{i}" for i in range(6))}
  FROM leaves JOIN doc_path p ON p.g = leaves.g AND p.pos = leaves.pos JOIN tops ON tops.name = leaves.g JOIN src_path q ON q.pos = tops.pos),
{_chained("up", "full_", "d_")},
half AS (SELECT * EXCLUDE (h, start), h AS start FROM up_6),
{_chained("on", "half", "s_")}
SELECT doc_id, leaf, subroot, root, sha256({_JOINED.format("d_")} || {_JOINED.format("s_")}) AS proof_sha256, h AS folded_root, h = root AS verified FROM on_6"""

#: Every anchor against every row, ranked; floor(256 x) of each component.
OP12 = """WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id, (row_number() OVER w)::INTEGER AS rank, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) QUALIFY row_number() OVER w <= 5"""

SQL = {
    "op11_merkle_manifest": OP11,
    "op12_hard_negatives": OP12,
    "op2_url_filter": OP2,
    "op4_source_mix": OP4.format(docs="documents"),
    "op6_warc": OP6,
    "op9_embedding_dedup": OP9,
    "op3_ngram_jaccard": OP3.format(docs="documents"),
    "op10_substring_dedup": OP10,
}

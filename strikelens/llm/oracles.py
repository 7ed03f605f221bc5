"""The corpus queries in SQL, where SQL can express them."""

MIX = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM sized GROUP BY source
), weighted AS (
  SELECT *, CASE place % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight, sum(source_size) OVER () AS total FROM totals
), levels AS (
  SELECT *,
    coalesce(sum(2 * source_size) OVER (ORDER BY source_size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled,
    sum(weight) OVER (ORDER BY source_size / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
  FROM weighted
), capped AS (
  SELECT *, 2 * (weight * filled + 2 * source_size * open_weight) <= 3 * weight * total AS is_full FROM levels
), targets AS (
  SELECT source, source_size,
    CASE WHEN is_full THEN CAST(2 * source_size AS DOUBLE)
    ELSE CAST(3 * total - 2 * sum(CASE WHEN is_full THEN 2 * source_size ELSE 0 END) OVER () AS DOUBLE) / 2 * weight
      / sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER () END AS target
  FROM capped
), rates AS (
  SELECT doc_id, size, source_size, target,
    CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
    CAST(CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496 AS coin
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, source_size, target,
  size * CAST(floor(rate) + CASE WHEN coin < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS taken
FROM rates
"""

EXACT_DEDUP = r"""
WITH plain AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS content
  FROM documents
), ranked AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY content ORDER BY n_points DESC, doc_id NULLS LAST) AS keep_id,
    count(*) OVER (PARTITION BY content) AS group_size
  FROM plain
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(content) AS text_sha256 FROM ranked
"""



def similar_sql(words: int, similar: int, kept: bool) -> str:
    """Components of documents whose shingles of ``words`` words are ``similar`` percent alike, by counting what sets share."""
    last = ", doc_id = component_id AS kept" if kept else ""
    return rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {words} THEN [array_to_string(w, ' ')]
    ELSE list_sort(list_distinct([array_to_string(w[i : i + {words - 1}], ' ') FOR i IN range(1, len(w) - {words - 2})])) END AS s
  FROM words
), named AS (
  SELECT doc_id, len(s) AS n, CASE WHEN len(s) > 0 THEN sha256(array_to_string(s, chr(10))) END AS class FROM sets
), classes AS (
  SELECT class, min(doc_id) AS node, min(n) AS n FROM named WHERE n > 0 GROUP BY class
), members AS (
  SELECT node, n, unnest(s) AS shingle FROM classes JOIN sets ON node = doc_id
), links AS (
  SELECT a.node AS a, b.node AS b FROM members a JOIN members b ON a.shingle = b.shingle AND a.node < b.node
  WHERE 100 * least(a.n, b.n) >= {similar} * greatest(a.n, b.n)
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= {similar} * (a.n + b.n - count(*))
), reached AS (
  SELECT node, node AS other FROM classes
  UNION
  SELECT node, CASE WHEN other = a THEN b ELSE a END FROM reached JOIN links ON other = a OR other = b
), roots AS (
  SELECT node, min(other) AS root FROM reached GROUP BY node
), found AS (
  SELECT doc_id, CAST(named.n AS BIGINT) AS n_shingles, coalesce(root, doc_id) AS component_id
  FROM named LEFT JOIN classes USING (class) LEFT JOIN roots USING (node)
)
SELECT *{last} FROM found
"""


FILTER_AUDIT = r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), judged AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id
), failing AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    concat(
      CASE WHEN len(w) < 200 THEN 'A' END, CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' END,
      CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' END,
      CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END,
      CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' END) AS fails
  FROM texts LEFT JOIN judged USING (doc_id)
), grouped AS (
  SELECT part, good, toxic, fails, count(*) AS n FROM failing GROUP BY ALL
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT concat(a.x, b.x, c.x, d.x, e.x) AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
  SELECT filter_order, CAST(k AS INTEGER) AS step, substr(filter_order, k, 1) AS f, substr(filter_order, 1, k - 1) AS before
  FROM orders, range(1, 6) r(k)
), marked AS (
  SELECT part, filter_order, step, f, n, good, toxic, contains(fails, f) AS here,
    length(translate(fails, before, '')) < length(fails) AS earlier, fails = f AS alone
  FROM grouped, steps
), counted AS (
  SELECT part, filter_order, step, f, coalesce(sum(n) FILTER (NOT earlier AND NOT here), 0) AS kept,
    coalesce(sum(n) FILTER (here AND NOT earlier), 0) AS removed, coalesce(sum(n) FILTER (here AND earlier), 0) AS redundant,
    coalesce(sum(n) FILTER (alone), 0) AS unique_fails, coalesce(sum(n) FILTER (here AND NOT earlier AND good), 0) AS good_lost,
    coalesce(sum(n) FILTER (here AND NOT earlier AND toxic), 0) AS toxic_lost
  FROM marked GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted
"""


def _framed(*fields: str) -> str:
    return " || ".join(f"coalesce(strlen(CAST({f} AS VARCHAR)) || ':' || {f}, '-')" for f in fields)


def _levels(name: str, source: str) -> str:
    """Nodes of all heights of the trees in ``source`` (tree, idx, size, digest), and what is before and after each in its run."""
    run = "(PARTITION BY tree, lvl, idx // 8 ORDER BY idx ROWS BETWEEN {} AND {})"
    before, after = run.format("UNBOUNDED PRECEDING", "1 PRECEDING"), run.format("1 FOLLOWING", "UNBOUNDED FOLLOWING")
    return f"""{name} AS (
  SELECT tree, 0 AS lvl, idx, size, digest FROM {source}
  UNION ALL
  SELECT tree, lvl + 1, idx // 8, (size + 7) // 8, sha256(string_agg(digest, '' ORDER BY idx)) FROM {name} WHERE size > 1
  GROUP BY tree, lvl, idx // 8, size
), {name}_runs AS (
  SELECT tree, lvl, idx, coalesce(string_agg(digest, '') OVER {before}, '') AS before, coalesce(string_agg(digest, '') OVER {after}, '') AS after
  FROM {name} WHERE size > 1
)"""


def _folded(name: str, source: str, levels: str) -> str:
    """``source`` (row, tree, idx, acc, proof) brought to the top of its tree, at each step with its height."""
    return f"""{name} AS (
  SELECT row, tree, 0 AS lvl, idx, acc, proof FROM {source}
  UNION ALL
  SELECT f.row, f.tree, f.lvl + 1, f.idx // 8, sha256(r.before || f.acc || r.after), f.proof || r.before || r.after
  FROM {name} f JOIN {levels}_runs r ON f.tree = r.tree AND f.lvl = r.lvl AND f.idx = r.idx
), {name}_top AS (
  SELECT row, arg_max(acc, lvl) AS acc, arg_max(proof, lvl) AS proof FROM {name} GROUP BY row
)"""


_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, [ascii(c)::BIGINT FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]),
      lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""

MERKLE = f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, row_number() OVER () AS row, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS tree,
    sha256({_framed("doc_id", "source", "lang", "n_chars", "text")}) AS digest,
    CASE WHEN {_CRC32} % 3 = 0
      THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS later,
    source, lang, n_chars
  FROM documents
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS size,
    sha256({_framed("doc_id", "source", "lang", "n_chars", "later")}) AS altered
  FROM hashed
), {_levels("nodes", "leaves")}, subroots AS (
  SELECT '^' AS tree, tree AS group_name, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS size, digest FROM nodes WHERE size = 1
), {_levels("upper", "subroots")}, starts AS (
  SELECT row, tree, idx, altered AS acc, '' AS proof FROM leaves
), {_folded("low", "starts", "nodes")}, middle AS (
  SELECT row, '^' AS tree, subroots.idx, low_top.acc, low_top.proof FROM low_top JOIN leaves USING (row) JOIN subroots ON leaves.tree = group_name
), {_folded("high", "middle", "upper")}, roots AS (
  SELECT digest AS root FROM upper WHERE size = 1
)
SELECT leaves.doc_id, leaves.digest AS leaf, subroots.digest AS subroot, root, sha256(high_top.proof) AS proof_sha256,
  high_top.acc AS folded_root, high_top.acc = root AS verified
FROM leaves JOIN subroots ON leaves.tree = group_name JOIN high_top USING (row) CROSS JOIN roots
"""

CHAT = r"""
WITH turns AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, turn, role, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(turn, role)
), formed AS (
  SELECT *, '### ' || regexp_replace(role, '(\\|###|</turn>)', '\\\1', 'g') || ': ' || regexp_replace(text, '(\\|###|</turn>)', '\\\1', 'g')
    || '</turn>' || chr(10) AS form
  FROM turns
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(form)) AS BIGINT) AS formatted_chars
FROM formed GROUP BY conv_id
"""

ORACLE_SQL = {
    "op1_jaccard_join": similar_sql(5, 80, kept=False),
    "op5_mix_sources": MIX,
    "op7_exact_dedup": EXACT_DEDUP,
    "op9_chat_formatting": CHAT,
    "op11_minhash_dedup": similar_sql(3, 85, kept=True),
    "op12_filter_audit": FILTER_AUDIT,
    "op13_merkle_manifest": MERKLE,
}

"""DuckDB SQL of the queries that SQL can express."""

OP2 = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""

_HITS = """
SELECT doc_id, {n} AS n, '{kind}' AS kind, gap, hit, {counts} AS counts,
       sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id ORDER BY k) AS stop
FROM (SELECT doc_id, unnest(gaps) AS gap, unnest(hits) AS hit, unnest(checked) AS checked, unnest(range(len(gaps))) AS k
      FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{p}', 1) AS gaps,
                   regexp_extract_all(coalesce(text, ''), '{p}', 2) AS hits,
                   regexp_extract_all(coalesce(text, ''), '{p}', {g}) AS checked FROM documents))
"""
_RULES = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 4,
     "length(checked) >= 6"),
    ("access", "AKIA[A-Z0-9]+", 2, "length(hit) >= 20"),
    ("hex", "[0-9a-f]{24,}", 2, "length(hit) >= 24"),
    ("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 2, "true"),
    ("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}", 2, "true"),
    ("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 2, "true"),
]
_SPANS = " UNION ALL ".join(
    _HITS.format(n=n, kind=kind, p=f"(?s)(.*?)({p})", g=g, counts=counts) for n, (kind, p, g, counts) in enumerate(_RULES))
OP9 = f"""
WITH h AS ({_SPANS}),
s AS (SELECT doc_id, n, kind, stop - length(hit) AS start, kind || ':' || (stop - length(hit)) || ':' || stop AS span
      FROM h WHERE counts),
a AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
             count(*) FILTER (kind = 'hex') AS n_hex,
             coalesce(string_agg(span, ',' ORDER BY start, n) FILTER (n < 3), '') AS base,
             string_agg(span, ',' ORDER BY start, n) AS spans FROM s GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN a USING (doc_id)
"""

# the tree's levels: votes, constant places, templates; what is left goes on in narrower groups
_LEVEL = """
f{r} AS MATERIALIZED (SELECT grp, form, sum(share) AS weight, string_split(form, ' ') AS tokens
      FROM (SELECT grp, form, 720720 // count(*) OVER (PARTITION BY doc_id, grp) AS share FROM r{r}) GROUP BY grp, form),
t{r} AS (SELECT grp, form, weight, unnest(range(len(tokens))) AS p, unnest(tokens) AS token FROM f{r}),
v{r} AS MATERIALIZED (SELECT grp, p, token, sum(weight) AS votes FROM t{r} GROUP BY ALL),
c{r} AS (SELECT grp, p, token, votes, sum(votes) OVER place AS total,
                row_number() OVER (PARTITION BY grp, p ORDER BY votes DESC, token DESC) AS k FROM v{r} WINDOW place AS (PARTITION BY grp, p)),
g{r} AS MATERIALIZED (SELECT grp, count(*) AS places, count(*) FILTER (2 * votes >= total) AS fixed, any_value(total) AS total
      FROM c{r} WHERE k = 1 GROUP BY grp),
a{r} AS MATERIALIZED (SELECT grp, form, 10 * count(c.token) >= 8 * any_value(fixed) AS alike
      FROM t{r} JOIN g{r} USING (grp) LEFT JOIN (SELECT * FROM c{r} WHERE k = 1 AND 2 * votes >= total) c USING (grp, p, token)
      WHERE 10 * fixed >= 7 * places GROUP BY grp, form),
b{r} AS (SELECT grp, form, arg_max(p || '=' || token, (v.votes, p, token)) AS pick
         FROM t{r} JOIN g{r} USING (grp) JOIN v{r} v USING (grp, p, token)
         WHERE 10 * fixed < 7 * places AND v.votes >= 3 * 720720 AND v.votes < total GROUP BY grp, form),
x{r} AS (SELECT DISTINCT form FROM a{r} WHERE alike AND grp IN (
         SELECT grp FROM r{r} JOIN a{r} USING (grp, form) WHERE alike GROUP BY grp HAVING count(DISTINCT doc_id) >= 3)),
r{n} AS MATERIALIZED (SELECT doc_id, form, grp || chr(10) || '~' AS grp FROM r{r} JOIN a{r} USING (grp, form) WHERE NOT alike
      UNION ALL SELECT doc_id, form, grp || chr(10) || pick FROM r{r} JOIN b{r} USING (grp, form)),"""
OP5 = f"""
WITH l AS (SELECT doc_id, k, line, regexp_replace(' ' || line, ' [^ 0-9]*[0-9][^ ]*', ' <*>', 'g')[2:] AS form
           FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                        unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS k FROM documents)),
r0 AS MATERIALIZED (SELECT DISTINCT doc_id, form, len(string_split(form, ' ')) || ' ' || array_to_string(list_slice(string_split(form, ' '), 1, 3), ' ') AS grp
       FROM l WHERE trim(line, ' ') <> ''),
{''.join(_LEVEL.format(r=r, n=r + 1) for r in range(4))}
gone AS (SELECT form FROM r0 GROUP BY form HAVING count(*) >= 3
         {' '.join(f'UNION SELECT form FROM x{r}' for r in range(4))})
SELECT doc_id, count(*) AS n_lines, (count(*) FILTER (dropped))::INTEGER AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (NOT dropped), '')) AS kept_sha256
FROM (SELECT l.*, trim(line, ' ') <> '' AND form IN (SELECT form FROM gone) AS dropped FROM l) GROUP BY doc_id
"""

OP11 = r"""
WITH t AS (SELECT doc_id, k, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS raw
           FROM (SELECT doc_id, text, row_number() OVER () AS k FROM documents)),
tf AS (SELECT k, doc_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term, count(*) AS tf
       FROM t GROUP BY ALL),
size AS (SELECT k, sum(tf)::BIGINT AS n FROM tf GROUP BY k),
whole AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM size),
m AS (SELECT k, 50 + (50 * n * n_docs) // n_terms AS m FROM size, whole),
item AS (SELECT DISTINCT item_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
         FROM (SELECT item_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS raw FROM benchmark)),
w AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w
      FROM tf, whole WHERE term IN (SELECT term FROM item) GROUP BY term),
scored AS (SELECT item_id, k, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
           FROM item JOIN w USING (term) JOIN tf USING (term) JOIN m USING (k) GROUP BY item_id, k, doc_id),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
           FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 50
"""


def _written(c: str) -> str:
    return f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR, '-')"


# crc32 of a decimal number: its bytes, each followed by seven empty ones, go bit by bit through the polynomial
_CRC = ("xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(string_split(doc_id::VARCHAR, ''), "
        "lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))), "
        "lambda a, x: xor(xor(a, x) >> 1, (xor(a, x) & 1) * 3988292384)))")
_HEAD = " || ".join(map(_written, ("doc_id", "source", "lang", "n_chars")))
_RUN = "PARTITION BY {by}l, i // 3 ORDER BY i ROWS BETWEEN"
_SIDES = """SELECT *, coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
       coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after"""
OP13 = f"""
WITH RECURSIVE d AS (SELECT doc_id, source, sha256({_HEAD} || {_written('text')}) AS leaf,
  sha256({_HEAD} || {_written(f"(CASE WHEN {_CRC} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END)")}) AS claimed FROM documents),
leaf AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
                count(*) OVER (PARTITION BY source) AS n, coalesce('s' || source, '') AS s FROM d),
node AS (SELECT 0 AS l, s, i, n, leaf AS h FROM leaf UNION ALL
         SELECT l + 1, s, i // 3, (any_value(n) + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM node WHERE n > 1 GROUP BY l, s, i // 3),
sub AS (SELECT s, h AS subroot, row_number() OVER (ORDER BY s) - 1 AS j, count(*) OVER () AS trees FROM node WHERE n = 1),
top AS (SELECT 0 AS l, j AS i, trees AS n, subroot AS h FROM sub UNION ALL
        SELECT l + 1, i // 3, (any_value(n) + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY l, i // 3),
side AS ({_SIDES.format(run=_RUN.format(by="s, "))} FROM node WHERE n > 1),
top_side AS ({_SIDES.format(run=_RUN.format(by=""))} FROM top WHERE n > 1),
fold AS (SELECT doc_id, s, leaf, 0 AS l, i, n, claimed AS h, '' AS proof FROM leaf UNION ALL
         SELECT doc_id, s, leaf, f.l + 1, f.i // 3, (f.n + 2) // 3, sha256(before || f.h || after), proof || before || after
         FROM fold f JOIN side USING (s, l, i)),
up AS (SELECT doc_id, leaf, subroot, 0 AS l, j AS i, trees AS n, h, proof FROM fold JOIN sub USING (s) WHERE n = 1 UNION ALL
       SELECT doc_id, leaf, subroot, u.l + 1, u.i // 3, (u.n + 2) // 3, sha256(before || u.h || after), proof || before || after
       FROM up u JOIN top_side USING (l, i))
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, up.h AS folded_root, up.h = root AS verified
FROM up, (SELECT h AS root FROM top WHERE n = 1) WHERE n = 1
"""

ORACLES = {"op2_exact_dedup": OP2, "op5_line_templates": OP5, "op9_secrets": OP9, "op11_ranked_search": OP11, "op13_merkle_manifest": OP13}

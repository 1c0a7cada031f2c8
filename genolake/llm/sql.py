"""DuckDB twins of the corpus queries that SQL can express."""

_BLANK_WORDS = r"regexp_extract_all(t, '[^\x20\x09-\x0D]+')"

_UPPER = "".join(map(chr, range(65, 91)))


def _lower(text: str) -> str:
    return f"translate(coalesce({text}, ''), '{_UPPER}', '{_UPPER.lower()}')"


def _item_words(text: str) -> str:
    return rf"regexp_extract_all({_lower(text)}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


OP2 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_item_words('text')} AS ws FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item_id, ws, least(len(ws), 10) AS n
      FROM (SELECT item_id, {_item_words('text')} AS ws FROM benchmark) WHERE len(ws) > 0),
iw AS (SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS w
       FROM (SELECT *, unnest(range(1, len(ws) - n + 2)) AS i FROM b)),
dw AS (SELECT rid, n, i, array_to_string(ws[i:i + n - 1], ' ') AS w
       FROM (SELECT *, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM iw))),
m AS (SELECT DISTINCT rid, n, i, item_id FROM dw JOIN iw USING (n, w)),
h AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT rid, n, i FROM m))
      GROUP BY rid),
t AS (SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT rid, item_id FROM m)
      GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (rid) LEFT JOIN t USING (rid)
"""

OP6 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_lower('text')}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS k
      FROM (SELECT *, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS both_have FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * both_have >= 75 * (a.n + b.n - both_have)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, e.y FROM r JOIN e ON e.x = r.y)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, (SELECT min(y) FROM r WHERE r.x = d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id)
"""

OP10 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, {_BLANK_WORDS} AS ws FROM d),
win AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS k
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
rep AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY 1),
ln AS (SELECT doc_id, x FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d)
       WHERE regexp_matches(x, '[^\x20\x09-\x0D]')),
lc AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT x) AS dup FROM ln GROUP BY 1),
m AS (SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             coalesce(n_lines, 0) AS n_lines, coalesce(dup, 0) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
             length(regexp_replace(t, '[^!]', '', 'g')) AS n_shout
      FROM w LEFT JOIN cov USING (doc_id) LEFT JOIN lc USING (doc_id)),
f AS (SELECT *, (n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (10 * n_symbols > n_words)::INT
             + 8 * (100 * n_dup_lines > 30 * n_lines)::INT + 16 * (10 * n_shout > n_words)::INT
             + 32 * (word_chars < 2 * n_words)::INT + 64 * (word_chars > 20 * n_words)::INT AS failures FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       failures & 3 <> 0 AS base_failed, failures = 0 AS kept, failures::BIGINT AS failures
FROM f
"""

OP9 = """
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
marked AS (SELECT *, coalesce('+' || role, '-') AS r, coalesce('+' || text, '-') AS x FROM t),
per_turn AS (SELECT conv_id, turn, count(*) AS n,
                    md5(string_agg(turn || chr(1) || r || chr(1) || x, chr(2) ORDER BY r, x)) AS h
             FROM marked GROUP BY ALL),
pre AS (SELECT conv_id, turn, string_agg(h, ',') OVER (PARTITION BY conv_id ORDER BY turn) AS p,
               max(turn) OVER (PARTITION BY conv_id) AS last FROM per_turn),
complete AS (SELECT p, min(conv_id) AS conv_id, count(*) AS copies FROM pre WHERE turn = last GROUP BY p),
kept AS (SELECT conv_id, copies FROM complete WHERE p NOT IN (SELECT p FROM pre WHERE turn < last))
SELECT conv_id, copies::BIGINT AS copies, count(DISTINCT turn)::BIGINT AS n_turns, count(*)::BIGINT AS n_rows,
       string_agg('<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || chr(10) || '<|end|>' || chr(10), ''
                  ORDER BY turn, r, x) AS rendered
FROM marked JOIN kept USING (conv_id) GROUP BY conv_id, copies
"""



def _vector_round(i: int) -> str:
    """Parts assigned to codebook ``i`` and, from them, codebook ``i + 1``."""
    return f"""
a{i} AS (SELECT rid, part, min(64 * list_sum(list_transform(range(1, len(x) + 1), lambda j: (x[j] - e[j]) * (x[j] - e[j]))) + k)
             AS best FROM p JOIN c{i} USING (part) GROUP BY ALL),
m{i} AS (SELECT part, k, list(v ORDER BY j) AS e FROM (
           SELECT part, (best % 64)::BIGINT AS k, j, floor(sum(x[j])::DOUBLE / count(*))::BIGINT AS v
           FROM a{i} JOIN (SELECT *, unnest(range(1, len(x) + 1)) AS j FROM p) USING (rid, part) GROUP BY ALL) GROUP BY ALL),
c{i + 1} AS (SELECT part, k, coalesce(m{i}.e, c{i}.e) AS e FROM c{i} LEFT JOIN m{i} USING (part, k)),"""


OP13 = f"""
WITH v AS (SELECT *, row_number() OVER () AS rid, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
           FROM embeddings WHERE embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT rid, part, q[part * (len(q) // 16) + 1:(part + 1) * (len(q) // 16)] AS x
      FROM (SELECT *, unnest(range(16)) AS part FROM v)),
f AS (SELECT rid, row_number() OVER (ORDER BY vec_id) - 1 AS k FROM (
        SELECT vec_id, arg_min(rid, q) AS rid FROM v WHERE vec_id IS NOT NULL GROUP BY vec_id ORDER BY vec_id LIMIT 64)),
c0 AS (SELECT part, k, x AS e FROM p JOIN f USING (rid)),{_vector_round(0)}{_vector_round(1)}
a2 AS (SELECT rid, part, min(64 * list_sum(list_transform(range(1, len(x) + 1), lambda j: (x[j] - e[j]) * (x[j] - e[j]))) + k)
             AS best FROM p JOIN c2 USING (part) GROUP BY ALL),
r AS (SELECT rid, string_agg(printf('%02x', (best % 64)::INT), '' ORDER BY part) AS code,
             sum(best // 64)::BIGINT AS error FROM a2 GROUP BY rid)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, k)) FROM c2) AS codebooks_sha256
FROM v JOIN r USING (rid)
"""



def _bits(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 15))::BIGINT"


def _mixed(i: int, value: str) -> str:
    return _bits(f"'11:block:' || source_no || ':' || rnd || ':{i}:' || {value}")


OP11 = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, source, len({_BLANK_WORDS})::BIGINT AS size
      FROM (SELECT *, coalesce(text, '') AS t FROM documents)),
s0 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS source_no
       FROM (SELECT source, sum(size)::BIGINT AS ssize FROM d GROUP BY source)),
s1 AS (SELECT *, [5, 2, 1][source_no % 3 + 1] AS w, 3 * ssize AS lim FROM s0),
s2 AS (SELECT *, coalesce(sum(lim) OVER o, 0) AS lims, coalesce(sum(w) OVER o, 0) AS ws, sum(ssize) OVER () AS al, sum(w) OVER () AS alw
       FROM s1 WINDOW o AS (ORDER BY lim / w, source_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s3 AS (SELECT *, (al - lims) * w > lim * (alw - ws) AS is_full FROM s2),
s4 AS (SELECT *, al - sum(CASE WHEN is_full THEN lim ELSE 0 END) OVER () AS rem, sum(CASE WHEN is_full THEN 0 ELSE w END) OVER () AS remw FROM s3),
s5 AS (SELECT *, CASE WHEN is_full THEN lim::DOUBLE ELSE rem::DOUBLE * w / remw::DOUBLE END AS target,
              ssize // 64 AS nfull, (ssize + 63) // 64 AS nblocks FROM s4),
s6 AS (SELECT *, CASE WHEN is_full THEN 3 ELSE floor(target / greatest(ssize, 1))::BIGINT END AS rounds FROM s5),
s7 AS (SELECT *, greatest(target - rounds * ssize, 0) AS rest FROM s6),
s8 AS (SELECT *, least(floor(rest / 64 + 0.5)::BIGINT, nfull) AS k FROM s7),
s9 AS (SELECT *, rounds * nblocks + CASE WHEN nblocks > nfull AND ssize - rest < abs(rest - k * 64) THEN nblocks ELSE k END AS quota,
              greatest(ceil(sqrt(nfull::DOUBLE)), 1)::BIGINT AS a FROM s8),
s AS (SELECT *, greatest(ceil(nfull::DOUBLE / a), 1)::BIGINT AS b,
             coalesce(sum(quota) OVER (ORDER BY source_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS lo FROM s9),
ids AS (SELECT slot, slot // 1024 AS shard, {_bits("'11:slot:' || slot")} % n AS u
        FROM (SELECT unnest(range(n)) AS slot, n FROM (SELECT sum(quota)::BIGINT AS n FROM s))),
drawn AS (SELECT slot, source_no, row_number() OVER (PARTITION BY source_no ORDER BY shard, slot) - 1 AS nth
          FROM ids JOIN s ON u >= lo AND u < lo + quota),
got AS (SELECT s.source_no, s.quota, count(slot) AS got FROM s LEFT JOIN drawn USING (source_no) GROUP BY ALL),
bal AS (SELECT *, greatest(got - quota, 0) AS over, greatest(quota - got, 0) AS short,
               coalesce(sum(greatest(got - quota, 0)) OVER o, 0) AS over_at, coalesce(sum(greatest(quota - got, 0)) OVER o, 0) AS short_at
        FROM got WINDOW o AS (ORDER BY source_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
n AS (SELECT *, (nth * over) // got AS given, ((nth + 1) * over) // got > (nth * over) // got AS gives FROM drawn JOIN bal USING (source_no)),
slots AS (SELECT slot, source_no, nth - given AS nth FROM n WHERE NOT gives
          UNION ALL
          SELECT slot, t.source_no, t.got + n.over_at + n.given - t.short_at
          FROM n JOIN bal t ON gives AND n.over_at + n.given >= t.short_at AND n.over_at + n.given < t.short_at + t.short),
start AS (SELECT slot, source_no, nfull, a, b, (nth // nblocks)::BIGINT AS rnd, (nth % nblocks)::BIGINT AS x FROM slots JOIN s USING (source_no)),
walk AS (SELECT slot, source_no, nfull, a, b, rnd, x AS y, 0 AS step FROM start WHERE x < nfull
  UNION ALL
  SELECT slot, source_no, nfull, a, b, rnd, l2 * b + (r1 + {_mixed(4, 'l2')}) % b, step + 1 FROM (
    SELECT *, (l1 + {_mixed(3, 'r1')}) % a AS l2 FROM (
      SELECT *, (r0 + {_mixed(2, 'l1')}) % b AS r1 FROM (
        SELECT *, (l0 + {_mixed(1, 'r0')}) % a AS l1 FROM (
          SELECT *, y // b AS l0, y % b AS r0 FROM walk WHERE step = 0 OR y >= nfull))))),
takes AS (SELECT source_no, block, count(*) AS times FROM (
            SELECT source_no, y AS block FROM walk WHERE step > 0 AND y < nfull
            UNION ALL SELECT source_no, x FROM start WHERE x >= nfull) GROUP BY ALL),
p AS (SELECT d.*, source_no, ssize, target, coalesce(sum(size) OVER (PARTITION BY source_no ORDER BY doc_id NULLS FIRST, rid
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS off
      FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
seg AS (SELECT rid, source_no, block, least((block + 1) * 64, off + size) - greatest(block * 64, off) AS n
        FROM (SELECT *, unnest(range(off // 64, (off + size - 1) // 64 + 1)) AS block FROM p WHERE size > 0)),
t AS (SELECT rid, sum(n * times)::BIGINT AS taken FROM seg JOIN takes USING (source_no, block) GROUP BY rid)
SELECT doc_id, size, ssize AS source_size, target, coalesce(taken, 0) AS taken FROM p LEFT JOIN t USING (rid)
"""

SQL: dict[str, str] = {"op2_decontamination": OP2, "op6_jaccard_join": OP6, "op9_chat_formatting": OP9, "op10_quality_rules": OP10, "op11_mixing": OP11,
                       "op13_vector_codes": OP13}

"""DuckDB SQL for those corpus queries that SQL can express, over whole tables."""

from __future__ import annotations

from . import host_rules, line_templates, mixing

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOLDED = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
PLAIN = r"'[^\x20\x09-\x0D]+'"


def _folded(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), {FOLDED})"


OP2 = f"""WITH w AS (SELECT doc_id, {_folded('text')} AS w FROM documents), i AS (SELECT item_id, {_folded('text')} AS w FROM benchmark),
im AS (SELECT *, least(10, len(w)) AS m FROM i WHERE len(w) > 0),
wins AS (SELECT DISTINCT item_id, m, array_to_string(w[p : p + m - 1], ' ') AS k FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS p FROM im)),
lengths AS (SELECT DISTINCT m FROM wins),
dw AS (SELECT doc_id, m, p, array_to_string(w[p : p + m - 1], ' ') AS k FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS p FROM w, lengths)),
met AS (SELECT doc_id, item_id, p, m FROM dw JOIN wins USING (m, k)),
hit AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + m)) AS q FROM met) GROUP BY 1),
own AS (SELECT doc_id, count(DISTINCT CAST(item_id AS VARCHAR)) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM met GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN own USING (doc_id)"""

OP3 = f"""WITH RECURSIVE w AS (SELECT doc_id, text, {_folded('text')} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[p : p + 4], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS p FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
counts AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY 1, 2),
pairs AS (SELECT a, b FROM counts JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE c >= 0.8 * (x.n + y.n - c) UNION SELECT a.doc_id, b.doc_id FROM documents a JOIN documents b ON a.text = b.text AND a.doc_id < b.doc_id),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
class AS (SELECT a AS doc_id, min(b) AS class_id FROM reach GROUP BY 1), deg AS (SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY 1)
SELECT doc_id, class_id, coalesce(n_links, 0) AS n_links FROM class LEFT JOIN deg USING (doc_id)"""

_RULES = {
    "short": f"n_words < {host_rules.MIN_WORDS}",
    "repetitive": f"100 * n_repeat_words > {host_rules.REPEAT_PERCENT} * n_words",
    "symbols": "n_symbols > n_words",
    "dup_lines": "2 * n_dup_lines > n_lines",
    "long_words": "word_chars > 20 * n_words",
}
_LEAST, _MOST = host_rules.LEAST_STRENGTH, host_rules.MOST_STRENGTH
_BETWEEN = lambda r: f"((q_{r} - n * m_{r} * m_{r}) / (m_{r} * (1 - m_{r})) - (hosts - 1)) / (n - squares / n - (hosts - 1))"
_STRENGTH = lambda r: f"CASE WHEN hosts < 2 OR m_{r} * (1 - m_{r}) <= 0 OR n - squares / n - (hosts - 1) <= 0 THEN {_MOST} WHEN {_BETWEEN(r)} <= 0 THEN {_MOST} ELSE least({_MOST}, greatest({_LEAST}, 1 / ({_BETWEEN(r)}) - 1)) END"
_LIMIT = lambda r: f"CASE WHEN hosts < 2 OR m_{r} * (1 - m_{r}) <= 0 THEN greatest({host_rules.LEAST_LIMIT}, m_{r}) ELSE least(CASE WHEN m_{r} < {host_rules.MOST_LIMIT} THEN {host_rules.MOST_LIMIT} ELSE 2 END, greatest({host_rules.LEAST_LIMIT}, m_{r} + {host_rules.DEVIATIONS} * sqrt(m_{r} * (1 - m_{r}) / (s_{r} + 1)))) END"
OP7 = f"""WITH t AS (SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {PLAIN}) AS w FROM documents),
g AS (SELECT doc_id, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS p FROM t)),
twice AS (SELECT doc_id, p FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
rep AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest([p, p + 1, p + 2]) AS q FROM twice) GROUP BY 1),
f AS (SELECT doc_id, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
  len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, {PLAIN}))) AS n_lines,
  CAST(len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, {PLAIN}))) - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, {PLAIN})))) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM t LEFT JOIN rep USING (doc_id)),
j AS (SELECT *, {', '.join(f'{x} AS fail_{r}' for r, x in _RULES.items())} FROM f),
h AS (SELECT source, count(*) AS docs, {', '.join(f'count_if(fail_{r})::DOUBLE AS f_{r}' for r in _RULES)} FROM j GROUP BY source),
m AS (SELECT count(*) AS hosts, sum(docs)::DOUBLE AS n, sum(docs::DOUBLE * docs) AS squares, {', '.join(f'sum(f_{r}) / sum(docs) AS m_{r}, sum(f_{r} * f_{r} / docs) AS q_{r}' for r in _RULES)} FROM h),
k AS (SELECT *, {', '.join(f'{_STRENGTH(r)} AS s_{r}' for r in _RULES)} FROM m),
p AS (SELECT *, {', '.join(f'(f_{r} + m_{r} * s_{r}) / (docs + s_{r}) AS p_{r}' for r in _RULES)} FROM h, k),
v AS (SELECT source, {' OR '.join(f'p_{r} - sqrt(p_{r} * (1 - p_{r}) / (docs + s_{r} + 1)) > {_LIMIT(r)}' for r in _RULES)} AS rejected FROM p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fail_short OR fail_repetitive AS base_failed, NOT (fail_short OR fail_repetitive) AND NOT rejected AS kept
FROM j JOIN v ON j.source IS NOT DISTINCT FROM v.source"""

OP8 = f"""WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {PLAIN}) AS w FROM documents),
g AS (SELECT doc_id, p, array_to_string(w[p : p + 12], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM t)),
late AS (SELECT doc_id, p FROM g QUALIFY doc_id > min(doc_id) OVER (PARTITION BY k)),
gone AS (SELECT DISTINCT doc_id, q FROM (SELECT doc_id, unnest(range(p, p + 13)) AS q FROM late)),
words AS (SELECT doc_id, w[q] AS word, q FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS q FROM t)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY q) AS text, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, q) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) AS BIGINT) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256 FROM t LEFT JOIN kept USING (doc_id)"""

_S = line_templates.STRETCHES
_STRETCH = lambda j: f"m[(n * {j}) // {_S} + 1 : (n * {j + 1}) // {_S}]"
_HELD = lambda free: [_STRETCH(j) for j in range(_S) if j not in free]
_FIXED = lambda free: " + ".join(f"len(list_filter({x}, lambda t: t <> '<*>'))" for x in _HELD(free))
_PATH = lambda free: f"CASE WHEN {_FIXED(free)} >= greatest({line_templates.LEAST_FIXED}, n // 2) THEN concat_ws(chr(10), '{free}', n, {', '.join(f'array_to_string({x}, chr(32))' for x in _HELD(free))}) END"
_OWN = "concat_ws(chr(10), 'whole', CASE WHEN len(list_filter(m, lambda t: t <> '<*>')) = 0 THEN array_to_string(w, ' ') ELSE array_to_string(m, ' ') END)"
# all paths that hold enough, those that lie within wider ones, too
OP9 = f"""WITH l AS (SELECT doc_id, p, x[p] AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS x, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS p FROM documents)),
m AS (SELECT doc_id, p, w, list_transform(w, lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END) AS m, len(w) AS n FROM (SELECT doc_id, p, regexp_extract_all(line, {PLAIN}) AS w FROM l)),
k AS (SELECT * FROM (SELECT doc_id, p, unnest([{', '.join(_PATH(free) for free in line_templates.PATHS)}]) AS k, {line_templates.MIN_DOCS} AS least FROM m) WHERE k IS NOT NULL
  UNION ALL SELECT doc_id, p, {_OWN} AS k, {line_templates.WHOLE_DOCS} AS least FROM m WHERE n > 0),
known AS (SELECT k, min(doc_id) AS first FROM k GROUP BY k, least HAVING count(DISTINCT doc_id) >= least),
gone AS (SELECT DISTINCT doc_id, p FROM k JOIN known USING (k) WHERE doc_id <> first),
kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY p) AS text, count(*) AS n FROM l ANTI JOIN gone USING (doc_id, p) GROUP BY 1),
n AS (SELECT doc_id, count(*) AS n_lines FROM l GROUP BY 1)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_lines, 0) - coalesce(n, 0) AS n_dropped, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)"""

_ROUNDS = f"""t AS (SELECT source, source_size, weight, {mixing.MOST_EPOCHS} * source_size AS most FROM r),
-- the share of a weight if the sources up to this one, by their limit for each weight, are at their limits
o AS (SELECT *, sum(most) OVER w AS held, sum(weight) OVER w AS gone FROM t WINDOW w AS (ORDER BY most / weight, source NULLS LAST)),
c AS (SELECT 0 AS held, 0 AS gone, 0::DOUBLE AS limit_ UNION ALL SELECT held, gone, most / weight FROM o),
s AS (SELECT max(((SELECT sum(source_size) FROM t) - held)::DOUBLE / ((SELECT sum(weight) FROM t) - gone)) AS share FROM c WHERE gone < (SELECT sum(weight) FROM t) AND held <= (SELECT sum(source_size) FROM t))"""
OP12 = f"""WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text, CAST(len(regexp_extract_all(coalesce(text, ''), {PLAIN})) AS BIGINT) AS size FROM documents),
k AS (SELECT doc_id, source, size, -ln((('0x' || substr(md5(concat_ws(chr(10), '{mixing.SEED}', coalesce(CAST(doc_id AS VARCHAR), ''), md5(text))), 1, {mixing.BITS // 4}))::BIGINT + 0.5::DOUBLE) / {1 << mixing.BITS}::DOUBLE)
  / CASE WHEN size > 0 THEN {mixing.LEAST_QUALITY}::DOUBLE + {1 - mixing.LEAST_QUALITY}::DOUBLE * (size - len(list_filter(regexp_extract_all(text, {PLAIN}), lambda x: regexp_matches(x, '[{mixing.ODD}]')))) / size ELSE {mixing.LEAST_QUALITY}::DOUBLE END AS key FROM d),
g AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM k GROUP BY source),
r AS (SELECT source, source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM g),
{_ROUNDS},
p AS (SELECT source, source_size, least(most::DOUBLE, weight * share) AS target FROM t, s),
e AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(least({mixing.MOST_EPOCHS}, floor(target / source_size)) AS BIGINT) ELSE 0 END AS epochs FROM p),
b AS (SELECT *, CASE WHEN epochs < {mixing.MOST_EPOCHS} THEN CAST(round(target - epochs * source_size) AS BIGINT) ELSE 0 END AS budget FROM e),
a AS (SELECT doc_id, source, size, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead FROM k)
SELECT doc_id, size, source_size, target, CAST(epochs * size + least(size, greatest(0, budget - ahead)) AS BIGINT) AS taken
FROM a JOIN b ON a.source IS NOT DISTINCT FROM b.source"""

SQL = {"op12_mixing": OP12, "op2_decontaminate": OP2, "op3_jaccard_join": OP3, "op7_host_rules": OP7, "op8_recompression": OP8, "op9_line_templates": OP9}

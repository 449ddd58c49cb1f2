"""DuckDB SQL for the operators that SQL can express.

The other operators hash with functions SQL lacks, run learned models or
search; the tests hold those against brute force, exact round trips or
held-out labels.
"""

from __future__ import annotations

from shoplens.llm import secret_scan
from shoplens.llm.quality_rules import STOP_WORDS

_STOP = ", ".join(f"'{w}'" for w in sorted({w for x in STOP_WORDS.values() for w in x.split()}))

# CRC-32 byte by byte from its polynomial; bytes come from the hex form.
_CRC_TABLE = """
crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(
    list_prepend(i::UBIGINT, range(8)::UBIGINT[]),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END)) AS t)"""



def _crc(text: str) -> str:
    """CRC-32 of a string that is not empty; ``t`` is the table."""
    return f"""
xor(list_reduce(
  list_prepend(4294967295::UBIGINT,
               list_transform(regexp_extract_all(hex(encode({text})), '..'),
                              lambda p: ('0x' || p)::UBIGINT)),
  lambda c, b: xor(c >> 8, t[((xor(c, b) & 255) + 1)::BIGINT])), 4294967295::UBIGINT)"""


_CRC_OF_TEXT = _crc("coalesce(text, '')")


def _hilbert(bits: int) -> str:
    """CTEs that turn bins x0, x1, x2 into the curve index, step by step."""
    steps, source = [], "binned"
    for b in range(bits - 1, 0, -1):
        q, p = 1 << b, (1 << b) - 1
        for i in range(3):
            own = f"x{i} & {q} <> 0"
            swap = f"(xor(x0, x{i}) & {p})"
            cols = []
            for k in range(3):
                if k == 0:
                    new = f"CASE WHEN {own} THEN xor(x0, {p}) ELSE xor(x0, {swap}) END"
                elif k == i:
                    new = f"CASE WHEN {own} THEN x{k} ELSE xor(x{k}, {swap}) END"
                else:
                    new = f"x{k}"
                cols.append(f"{new} AS x{k}")
            name = f"turn_{b}_{i}"
            steps.append(f"{name} AS (SELECT * EXCLUDE (x0, x1, x2), {', '.join(cols)} FROM {source})")
            source = name
    steps.append(f"gray AS (SELECT * EXCLUDE (x1, x2), xor(x0, x1) AS x1, "
                 f"xor(xor(x0, x1), x2) AS x2 FROM {source})")
    flip = "0"
    for b in range(bits - 1, 0, -1):
        flip = f"xor({flip}, CASE WHEN x2 & {1 << b} <> 0 THEN {(1 << b) - 1} ELSE 0 END)"
    steps.append(f"flipped AS (SELECT *, {flip} AS f FROM gray)")
    terms = [f"(((xor(x{i}, f) >> {b}) & 1) << {3 * b + 2 - i})"
             for b in range(bits) for i in range(3)]
    steps.append(f"indexed AS (SELECT *, {' + '.join(terms)} AS h FROM flipped)")
    return ",\n".join(steps)


def _edges(c: str) -> str:
    """Bins above 0 of a column with their smallest values, from a sample of
    its distinct values."""
    return f"""
  SELECT b, min(v) AS v FROM (
    SELECT v, (row_number() OVER (ORDER BY v) - 1) * 16 // count(*) OVER () AS b
    FROM (SELECT v FROM (SELECT DISTINCT {c} AS v FROM documents WHERE {c} IS NOT NULL)
          ORDER BY md5(v::VARCHAR), v LIMIT 4096)) GROUP BY b HAVING b > 0"""


def _bin(table: str, c: str) -> str:
    return f"coalesce((SELECT max(b) FROM {table} WHERE v <= {c}), 0)::INT"


_OP2 = f"""
WITH {_CRC_TABLE},
keyed AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0) + 16 AS size,
         CASE WHEN coalesce(text, '') = '' THEN 0 ELSE {_CRC_OF_TEXT} END::BIGINT AS text_crc32,
         lang, source, n_chars
  FROM documents, crc_table),
lang_edges AS ({_edges('lang')}),
source_edges AS ({_edges('source')}),
size_edges AS ({_edges('n_chars')}),
binned AS (
  SELECT doc_id, size, text_crc32, {_bin('lang_edges', 'lang')} AS x0,
         {_bin('source_edges', 'source')} AS x1, {_bin('size_edges', 'n_chars')} AS x2
  FROM keyed),
{_hilbert(4)},
placed AS (
  SELECT *, row_number() OVER (ORDER BY h, ('0x' || left(md5(coalesce(doc_id::VARCHAR, '')), 8))::BIGINT,
                               doc_id NULLS FIRST, text_crc32, size) - 1 AS place,
         count(*) OVER () AS total
  FROM indexed)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'rows' AS law, (place * 40 // total)::INT AS shard,
       row_number() OVER (PARTITION BY place * 40 // total ORDER BY place) - 1 AS slot,
       NULL::INT AS grown_shard
FROM placed"""

_OP4 = rf"""
WITH rows AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents),
cut AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM rows),
windows AS (
  SELECT id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT id, w, unnest(range(1, len(w) - 1)) AS i FROM cut)),
often AS (SELECT id, g FROM windows GROUP BY id, g HAVING count(*) > 1),
covered AS (
  SELECT id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT id, unnest([i, i + 1, i + 2]) AS p FROM windows JOIN often USING (id, g)) GROUP BY id),
counts AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         len(lines) AS n_lines, len(regexp_extract_all(text, '!')) AS shouts,
         len(list_filter(w, lambda x: upper(x) = x AND lower(x) <> x)) AS capitals,
         len(list_filter(w, lambda x: lower(trim(x, '.,;:!?"''()')) IN ({_STOP}))) AS stops
  FROM cut LEFT JOIN covered USING (id)),
judged AS (
  SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND word_chars / n_words BETWEEN 2.0 AND 15.0
        AND n_symbols / n_words <= 0.1 AND shouts / n_words <= 0.3 AND capitals / n_words <= 0.4
        AND stops / n_words BETWEEN 0.02 AND 0.8 AND n_dup_lines / n_lines <= 0.5
        AND n_repeat_words / n_words <= 0.5) AS kept
FROM judged"""

_CONTROL = r"<s>|</s>|\[SYS\]|\[/SYS\]|\[INST\]|\[/INST\]|\[ANS\]|\[ROLE\]|\[TEXT\]|\[/TEXT\]"

_OP5 = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, length(text) + len(regexp_extract_all(text, '{_CONTROL}'))
       + CASE role WHEN 'system' THEN 9 + 7 WHEN 'user' THEN 10 + 8 WHEN 'assistant' THEN 9 + 5
         ELSE 10 + 8 + 8 + length(role) + len(regexp_extract_all(role, '{_CONTROL}')) END AS chars
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id"""

_GRAMS = """
  SELECT id, part, unnest([w[i] FOR i IN range(1, len(w) + 1)]
    || [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]
    || [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) AS f
  FROM cut"""

_OP11 = rf"""
WITH {_CRC_TABLE},
texts AS (
  SELECT row_number() OVER () AS id, 'corpus' AS part, doc_id, text FROM documents
  UNION ALL SELECT row_number() OVER (), 'target', NULL, text FROM benchmark),
cut AS (
  SELECT id, part, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
grams AS ({_GRAMS}),
counted AS (SELECT id, part, f, count(*) AS n FROM grams GROUP BY ALL),
names AS (SELECT DISTINCT f FROM counted),
placed AS (SELECT f, {_crc('f')} % 10000 AS bucket FROM names, crc_table),
totals AS (
  SELECT bucket, coalesce(sum(n) FILTER (part = 'corpus'), 0)::DOUBLE AS s,
         coalesce(sum(n) FILTER (part = 'target'), 0)::DOUBLE AS t
  FROM counted JOIN placed USING (f) GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM totals) + 10000)
                                 / ((s + 1) * ((SELECT sum(t) FROM totals) + 10000))))::BIGINT AS gain
  FROM totals),
weighed AS (
  SELECT id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
  FROM counted JOIN placed USING (f) JOIN gains USING (bucket) WHERE part = 'corpus' GROUP BY id),
scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         (coalesce(weight, 0) + floor(-1000 * ln(-ln(
            (('0x' || left(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 8))::UBIGINT::DOUBLE + 0.5)
            / 4294967296))))::BIGINT AS score
  FROM cut LEFT JOIN weighed USING (id) WHERE part = 'corpus'),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST, weight, n_features) AS r,
         count(*) OVER () AS total
  FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 5 * total // 100 THEN r END AS rank FROM ranked
UNION ALL SELECT doc_id, n_features, weight, score, NULL FROM scored WHERE n_words < 20"""


def _spread(n: int, salt: str, key: str = "k::VARCHAR") -> str:
    return f"(('0x' || left(sha256('{salt}' || {key}), 8))::UBIGINT % {n})::INT"


def _pairs(text: str) -> str:
    """Numbers of the neighbouring characters of a string, with both ends."""
    codes = (f"list_append(list_prepend({secret_scan._EDGE}, [CASE strpos('{secret_scan._CHARS}', c) "
             f"WHEN 0 THEN {secret_scan._EDGE} ELSE strpos('{secret_scan._CHARS}', c) - 1 END "
             f"FOR c IN string_split({text}, '')]), {secret_scan._EDGE})")
    return f"(SELECT [x[i] * {secret_scan._STATES} + x[i + 1] FOR i IN range(1, len(x))] FROM (SELECT {codes} AS x))"


def _places(kind: int, pattern: str, value: int = 0) -> str:
    """Rows (id, kind, start, end, value) of the matches of a pattern."""
    quoted = pattern.replace("'", "''")
    return f"""
  SELECT id, {kind} AS kind, (sum(gap + size) OVER run - size)::BIGINT AS first,
         (sum(gap + size) OVER run)::BIGINT AS after, value
  FROM (SELECT id, i, length(g[i]) AS gap, length(m[i]) AS size,
               regexp_extract(m[i], '{quoted}', {value}) AS value
        FROM (SELECT id, g, m, unnest(range(1, len(m) + 1)) AS i
              FROM (SELECT id, string_split_regex(text, '{quoted}') AS g,
                           regexp_extract_all(text, '{quoted}') AS m FROM rows)))
  WINDOW run AS (PARTITION BY id ORDER BY i)"""


_LIST = "string_agg(name || ':' || first || ':' || after, ',' ORDER BY first, kind)"

_OP12 = f"""
WITH rows AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents),
numbers AS (SELECT range AS k, {_spread(45, 'size', 'range::VARCHAR')} + {secret_scan.MIN_RUN} AS size
            FROM range({secret_scan.SAMPLES})),
drawn AS (
  SELECT k, size, sha256('hex' || k::VARCHAR) AS h,
         replace(to_base64(unhex(sha256('left' || k::VARCHAR)))
                 || to_base64(unhex(sha256('right' || k::VARCHAR))), '=', '') AS coded,
         translate(sha256('digits' || k::VARCHAR), 'abcdef', '012345') AS digits,
         [string_split('{' '.join(secret_scan._WORDS)}', ' ')[
            {_spread(len(secret_scan._WORDS), 'word', "k::VARCHAR || '/' || i::VARCHAR")} + 1]
          FOR i IN range(1, {_spread(4, 'words')} + 4)] AS w
  FROM numbers),
plain AS (SELECT *, replace(replace(coded, '+', ''), '/', '') AS p FROM drawn),
samples AS (
  SELECT true AS random, [left(h, size), left(upper(h), size), left(coded, size),
    left(translate(coded, '+/', '-_'), size), left(p, size), left(p, size), left(upper(p), size),
    left(lower(p), size), left(coded, 43) || '='][{_spread(9, 'random')} + 1] AS text FROM plain
  UNION ALL
  SELECT false, [array_to_string(w, '_'), array_to_string(w, '-'), array_to_string(w, '/'),
    array_to_string([upper(x[1]) || x[2:] FOR x IN w], ''), upper(array_to_string(w, '_')),
    array_to_string(w, ''), array_to_string(w, '_') || '_' || left(digits, 4),
    '/' || array_to_string(w, '/') || '-' || left(digits, 2),
    strftime(make_timestamp({_spread(1 << 30, 'time')}::BIGINT * 1000000), '%Y-%m-%d-%H-%M-%S'),
    left(digits, size), repeat('{secret_scan._RULERS}'[{_spread(len(secret_scan._RULERS), 'ruler')} + 1],
                               size)][{_spread(11, 'ordinary')} + 1] FROM plain),
counts AS (
  SELECT pair, 1 + count(*) FILTER (random) AS a, 1 + count(*) FILTER (NOT random) AS b
  FROM (SELECT random, unnest({_pairs('text')}) AS pair FROM samples
        UNION ALL SELECT NULL, range FROM range({secret_scan._STATES ** 2})) GROUP BY pair),
weights AS (
  SELECT pair, round(1000 * (ln(a / sum(a) OVER before) - ln(b / sum(b) OVER before)))::BIGINT AS w
  FROM counts WINDOW before AS (PARTITION BY pair // {secret_scan._STATES})),
base AS (
  SELECT * FROM ({' UNION ALL '.join(
      f"SELECT *, '{name}' AS name FROM ({_places(k, pattern, group)}) WHERE length(value) >= {least}"
      for k, (name, pattern, group, least) in enumerate(secret_scan.BASE))})),
runs AS ({_places(len(secret_scan.BASE), '[A-Za-z0-9+/_=-]+')}),
judged AS (
  SELECT id, kind, first, after, value, sum(w) AS total
  FROM (SELECT *, unnest({_pairs('value')}) AS pair FROM runs WHERE length(value) >= {secret_scan.MIN_RUN})
  JOIN weights USING (pair) GROUP BY ALL),
spans AS (
  SELECT id, kind, first, after, name FROM base
  UNION ALL SELECT id, kind, first, after, '{secret_scan.RANDOM}' FROM judged
  WHERE total >= {secret_scan.MIN_RATIO}),
found AS (
  SELECT id, count(*) FILTER (name = 'assign') AS n_assign, count(*) FILTER (name = 'access') AS n_access,
         count(*) FILTER (name = 'hex') AS n_hex,
         {_LIST} FILTER (name <> '{secret_scan.RANDOM}') AS base, {_LIST} AS spans
  FROM spans GROUP BY id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM rows LEFT JOIN found USING (id)"""


def _field(value: str) -> str:
    return (f"coalesce(octet_length(encode({value}::VARCHAR))::VARCHAR || ':' || {value}::VARCHAR, '-')")


def _leaf(n_chars: str) -> str:
    fields = map(_field, ("doc_id", "source", "lang", n_chars, "text"))
    return f"sha256({' || '.join(fields)})"


_OP13 = f"""
WITH RECURSIVE {_CRC_TABLE},
hashed AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf('n_chars')} AS leaf,
         CASE WHEN n_chars IS NOT NULL AND {_crc('doc_id::VARCHAR')} % 7 = 0
              THEN {_leaf('(n_chars::HUGEINT + 1)')} END AS claimed
  FROM documents, crc_table),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
         count(*) OVER (PARTITION BY tree) AS n FROM hashed),
nodes(tree, level, place, node, n) AS (
  SELECT tree, 0, place, leaf, n FROM leaves
  UNION ALL
  SELECT tree, level + 1, place // 2, sha256(string_agg(node, '' ORDER BY place)), (any_value(n) + 1) // 2
  FROM nodes WHERE n > 1 GROUP BY tree, level, place // 2),
subroots AS (
  SELECT tree, node, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS n
  FROM nodes WHERE n = 1),
upper(level, place, node, n) AS (
  SELECT 0, place, node, n FROM subroots
  UNION ALL
  SELECT level + 1, place // 2, sha256(string_agg(node, '' ORDER BY place)), (any_value(n) + 1) // 2
  FROM upper WHERE n > 1 GROUP BY level, place // 2),
steps AS (
  SELECT l.tree, l.place, m.level, CASE WHEN s.place < m.place THEN 'L' WHEN s.place > m.place THEN 'R'
         ELSE '-' END AS side, coalesce(s.node, '') AS node
  FROM leaves l JOIN nodes m ON m.tree = l.tree AND m.n > 1 AND m.place = l.place >> m.level
  LEFT JOIN nodes s ON s.tree = m.tree AND s.level = m.level AND s.place = xor(m.place, 1)
  UNION ALL
  SELECT l.tree, l.place, 1000 + m.level, CASE WHEN s.place < m.place THEN 'L' WHEN s.place > m.place THEN 'R'
         ELSE '-' END, coalesce(s.node, '')
  FROM leaves l JOIN subroots r ON r.tree = l.tree JOIN upper m ON m.n > 1 AND m.place = r.place >> m.level
  LEFT JOIN upper s ON s.level = m.level AND s.place = xor(m.place, 1)),
proofs AS (
  SELECT tree, place, list(side || node ORDER BY level) AS path, string_agg(node, '' ORDER BY level) AS proof
  FROM steps GROUP BY tree, place),
folded AS (
  SELECT l.*, coalesce(proof, '') AS proof, list_reduce(
    list_prepend(coalesce(claimed, leaf), coalesce(path, [])),
    lambda c, s: CASE s[1] WHEN 'L' THEN sha256(s[2:] || c) WHEN 'R' THEN sha256(c || s[2:])
                 ELSE sha256(c) END) AS folded_root
  FROM leaves l LEFT JOIN proofs USING (tree, place))
SELECT doc_id, leaf, subroots.node AS subroot, (SELECT node FROM upper WHERE n = 1) AS root,
       sha256(proof) AS proof_sha256, folded_root,
       folded_root = (SELECT node FROM upper WHERE n = 1) AS verified
FROM folded JOIN subroots USING (tree)"""

ORACLE_SQL = {
    "op2_hilbert_sharding": _OP2,
    "op4_quality_rules": _OP4,
    "op5_chat_formatting": _OP5,
    "op11_importance_resampling": _OP11,
    "op12_secret_scans": _OP12,
    "op13_merkle_manifest": _OP13,
}

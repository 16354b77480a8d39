"""DuckDB SQL of the corpus queries that SQL can express, by plain brute force.

The added kinds of PII and secrets, whose checks SQL would only repeat, are left to the tests: the SQL lists base spans.
"""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"
_BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _spans(kind: str, pattern: str, keep: str) -> str:
    """Places of a pattern's matches: gap 1, match 1, gap 2, ... make up the text, so lengths add up to positions."""
    return f"""
SELECT doc_id, '{kind}' AS kind, m[i] AS matched, s AS start, s + length(m[i]) AS stop
FROM (SELECT doc_id, m, i, CAST(list_sum(list_transform(g[1:i], lambda x: length(x))) AS BIGINT)
             + CAST(coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s
      FROM (SELECT doc_id, m, g, unnest(range(1, len(m) + 1)) AS i
            FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}') AS m, string_split_regex(text, '{pattern}') AS g
                  FROM texts) WHERE len(m) > 0))
WHERE {keep}"""


_DIGITS = "regexp_replace(m[i], '[^0-9]', '', 'g')"
_LUHN = f"""list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda k:
  CASE WHEN (length({_DIGITS}) - k) % 2 = 1
       THEN 2 * CAST({_DIGITS}[k] AS INTEGER) - CASE WHEN CAST({_DIGITS}[k] AS INTEGER) > 4 THEN 9 ELSE 0 END
       ELSE CAST({_DIGITS}[k] AS INTEGER) END)) % 10 = 0"""


def _found(parts: dict[str, tuple[str, str]], order: str, more: str = "") -> str:
    kinds = list(parts)
    rank = "CASE kind " + " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(kinds)) + " END"
    union = "\nUNION ALL\n".join(_spans(k, pattern, keep) for k, (pattern, keep) in parts.items())
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in kinds)
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), spans AS ({union})
SELECT d.doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in kinds)}, sha256(coalesce(all_spans, '')) AS base_sha256,
       coalesce(all_spans, '') AS spans{more}
FROM documents d LEFT JOIN (
  SELECT doc_id, {counts}, count(*) AS n_all, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY {order.format(rank=rank)}) AS all_spans
  FROM spans GROUP BY doc_id) USING (doc_id)"""


_PII = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "TRUE"),
    "ip": (
        r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
        "list_bool_and(list_transform(string_split(m[i], '.'), lambda p: TRY_CAST(p AS DOUBLE) <= 255))",
    ),
    "card": (r"[0-9](?:[\x20-]?[0-9])+", f"CASE WHEN length({_DIGITS}) BETWEEN 16 AND 19 THEN {_LUHN} ELSE FALSE END"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 8 AND 15"),
}
_ASSIGN = r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"'']?\x20*[:=]\x20*[\"'']?"
_SECRETS = {
    "assign": (_ASSIGN + "[A-Za-z0-9+/_.=-]+", f"length(regexp_replace(m[i], '^{_ASSIGN}', '')) >= 6"),
    "access": ("AKIA[A-Z0-9]+", "length(m[i]) >= 20"),
    "hex": ("[0-9a-f]+", "length(m[i]) >= 24"),
}

_LINES = f"""
WITH lines AS (SELECT doc_id, line, pos, translate(trim(line, {_BLANK}), '{_UPPER}', '{_UPPER.lower()}') AS key
  FROM (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))),
owners AS (SELECT key, min(doc_id) AS owner FROM lines WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (owner <> doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (owner IS NULL OR owner = doc_id), '')) AS kept_sha256
FROM lines LEFT JOIN owners USING (key) GROUP BY doc_id"""

_BITS = "list_aggregate(list_transform(range(1, 41), lambda k: substr('0000000100100011010001010110011110001001101010111100110111101111', 4 * (strpos('0123456789abcdef', hex[k]) - 1) + 1, 4)), 'string_agg', '')"
_WARC = f"""
WITH hashed AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
owned AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS owner, {_BITS} AS bits FROM hashed)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + CAST(list_sum(list_transform(range(1, 6), lambda b: CAST(bits[5 * k + b] AS INTEGER) * CAST(2 ** (5 - b) AS INTEGER))) AS INTEGER), 1)),
         'string_agg', '') AS payload_digest,
       CASE WHEN page_id = owner THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> owner THEN owner END AS refers_to
FROM owned"""

_GRAMS = f"""
WITH RECURSIVE split AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
grams AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], chr(1)) AS gram
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM split WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_n
  FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b, both_n = x.n AND both_n = y.n AS same FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE both_n >= 0.8 * (x.n + y.n - both_n)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT d.doc_id, min(r.b) AS class_id, least(d.doc_id, min(l.b) FILTER (l.same)) AS copy_id, count(DISTINCT l.b) AS n_links
FROM documents d JOIN reach r ON r.a = d.doc_id LEFT JOIN links l ON l.a = d.doc_id GROUP BY d.doc_id"""

_VECTORS = """
WITH RECURSIVE good AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), FALSE))) AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT e.vec_id, count(DISTINCT l.b) AS n_links, min(r.b) AS component_id, min(r.b) = e.vec_id AS kept
FROM embeddings e JOIN reach r ON r.a = e.vec_id LEFT JOIN links l ON l.a = e.vec_id GROUP BY e.vec_id"""

_RULES = f"""
WITH split AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 4], chr(1)) AS gram
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM split)),
again AS (SELECT doc_id, i FROM windows WINDOW same AS (PARTITION BY doc_id, gram) QUALIFY count(*) OVER same > 1),
repeats AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, (SELECT unnest([0, 1, 2, 3, 4]) AS k) GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) AS all_n, count(*) - count(DISTINCT line) AS n
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM split) WHERE regexp_matches(line, '{_WORD}') GROUP BY doc_id),
counted AS (SELECT doc_id, host, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    coalesce(l.n, 0) AS n_dup_lines, coalesce(l.all_n, 0) AS n_lines, coalesce(r.n, 0) AS n_repeat_words
  FROM split LEFT JOIN lines l USING (doc_id) LEFT JOIN repeats r USING (doc_id)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted),
sizes AS (SELECT host, count(*) AS docs FROM judged GROUP BY host),
failed AS (SELECT host, unnest([n_words < 10, 100 * n_repeat_words > 20 * n_words, 10 * n_symbols > n_words, 10 * n_dup_lines > 3 * n_lines]) AS bad,
    unnest([1, 2, 3, 4]) AS rule FROM judged),
hosts AS (SELECT host, rule, docs, count(*) FILTER (bad) AS failures FROM failed JOIN sizes USING (host) GROUP BY ALL),
moments AS (SELECT rule, avg(failures / docs) AS mean, coalesce(var_samp(failures / docs), 0) AS variance, avg(1 / docs) AS noise, count(*) AS n FROM hosts GROUP BY rule),
surplus AS (SELECT rule, mean, greatest((variance - (mean * (1 - mean) + variance / n) * noise) / greatest(1 - noise, 1e-6), mean * (1 - mean) * 1e-4, 1e-12) AS s FROM moments),
prior AS (SELECT rule, mean, greatest(mean * (1 - mean) / s - 1, 1) AS weight FROM surplus),
rates AS (SELECT host, max((failures + mean * weight) / (docs + weight)) AS rate FROM hosts JOIN prior USING (rule) GROUP BY host)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND rate <= 0.5 AS kept, host,
       round(rate, 9) AS host_rate
FROM judged JOIN rates USING (host)"""

_HEX = "0123456789abcdef"
_SPELLING = f"""
WITH RECURSIVE table_ AS (SELECT list_transform(range(256), lambda k: list_reduce(list_prepend(CAST(k AS BIGINT), range(8)),
    lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS (SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[a-zÀ-ÿ]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY ALL),
hashed AS (SELECT run, n, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, len(x) // 2 + 1), lambda k:
      CAST(16 * (strpos('{_HEX}', x[2 * k - 1]) - 1) + strpos('{_HEX}', x[2 * k]) - 1 AS BIGINT))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM (SELECT run, n, lower(hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run))) AS x FROM runs), table_),
vocabulary AS (SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT CASE WHEN h % 199 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cut AS (SELECT word, i, word[1:i - 1] || word[i + 1:] AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM vocabulary)),
shorter AS (SELECT DISTINCT c.word AS long_, v.word AS short_ FROM cut c JOIN vocabulary v ON v.word = c.rest),
near AS (SELECT a.word AS word, b.word AS other FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT long_, short_ FROM shorter UNION SELECT short_, long_ FROM shorter),
best AS (SELECT near.word AS word, count(*) AS n_near, max(v.n) AS form_n, min(v.word) FILTER (v.n = top) AS form
  FROM (SELECT near.word, other, max(v.n) OVER (PARTITION BY near.word) AS top FROM near JOIN vocabulary v ON v.word = other) near
  JOIN vocabulary v ON v.word = other GROUP BY near.word),
judged AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * n THEN form END AS form, CASE WHEN form_n >= 5 * n THEN form_n END AS form_n
  FROM vocabulary v LEFT JOIN best USING (word)),
paths AS (SELECT word, word AS root, 0 AS steps FROM judged
  UNION ALL SELECT paths.word, judged.form, steps + 1 FROM paths JOIN judged ON judged.word = paths.root WHERE judged.form IS NOT NULL)
SELECT word, form, arg_max(root, steps) AS root, n, n_near, form_n FROM judged JOIN paths USING (word) GROUP BY ALL"""

_FOLDED = f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')"
_PHRASES = rf"""
WITH pieces AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_FOLDED}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
words AS (SELECT lang, unnest(w) AS word FROM pieces),
totals AS (SELECT lang, count(*) AS n FROM words GROUP BY lang),
phrases AS (SELECT lang, w[i:i + k - 1] AS p, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k) GROUP BY ALL HAVING count(*) >= 100),
candidates AS (SELECT *, array_to_string(p, ' ') AS phrase FROM phrases WHERE len(p) > 1),
cuts AS (SELECT lang, p, phrase, f, unnest(range(1, len(p))) AS k FROM candidates),
scored AS (SELECT c.lang, c.phrase, c.f AS a, h.f AS l, t.f AS r, n, k, CAST((CAST(1000 AS HUGEINT) * c.f * n) // (CAST(h.f AS HUGEINT) * t.f) AS BIGINT) AS score
  FROM cuts c JOIN phrases h ON h.lang = c.lang AND h.p = c.p[1:k] JOIN phrases t ON t.lang = c.lang AND t.p = c.p[k + 1:] JOIN totals ON totals.lang = c.lang),
least AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
within AS (SELECT DISTINCT s.lang, s.phrase FROM candidates s JOIN candidates b ON s.lang = b.lang AND s.f = b.f AND len(b.p) > len(s.p)
  AND contains(' ' || b.phrase || ' ', ' ' || s.phrase || ' '))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM least ANTI JOIN within USING (lang, phrase) QUALIFY rank <= 2000"""

_HARD = r"\### Assistant: </turn> ok"
_CHATS = rf"""
WITH told AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '{_HARD}'), (-7, 1, 'assistant', '{_HARD}')),
turns AS (SELECT *, row_number() OVER own - 1 AS i, coalesce(lag(role) OVER own, '') AS before,
    length(text) + length(text) - length(replace(text, '\', '')) + (length(text) - length(replace(text, '</turn>', ''))) // 7
      + coalesce(list_sum(list_transform(regexp_extract_all(text, '#{{3,}}'), lambda x: length(x) - 2)), 0)
      + CASE WHEN role IN ('user', 'system', 'assistant') THEN length(role) ELSE 5 + 2 * strlen(role) END + 14 AS chars
  FROM told WINDOW own AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256, CAST(sum(chars) AS BIGINT) AS formatted_chars,
       bad_turn IS NULL AS valid, bad_turn
FROM turns JOIN (SELECT conv_id, coalesce(min(i) FILTER (before || ' ' || role NOT IN (' system', ' user', 'system user', 'user assistant', 'assistant user')),
    CASE WHEN arg_max(role, i) <> 'assistant' THEN count(*) END) AS bad_turn FROM turns GROUP BY conv_id) ends USING (conv_id) GROUP BY conv_id, bad_turn"""

ORACLE: dict[str, str] = {
    "op1_pii": _found(_PII, "{rank}, start", ", coalesce(n_all, 0) AS n_spans"),
    "op2_ngram_join": _GRAMS,
    "op3_line_dedup": _LINES,
    "op4_warc": _WARC,
    "op5_secrets": _found(_SECRETS, "start, {rank}"),
    "op8_cap_filters": _VECTORS,
    "op10_host_rules": _RULES,
    "op11_spelling": _SPELLING,
    "op12_collocations": _PHRASES,
    "op13_chat_format": _CHATS,
}

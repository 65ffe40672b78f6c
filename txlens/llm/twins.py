"""SQL twins of the queries, written apart from the operators they check.

SimHash needs XXH64, which the SQL engine lacks; decontamination, the classifier, packing and the
repair of conversations have no SQL form. Those are tested against brute force and on held-out labels.
"""

from txlens.llm import licenses, mixing, quality, secretscan

WORDS = "list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"


def _quoted(text):
    return "'" + text.replace("'", "''") + "'"


def substring_sql(length=50):
    return f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + {length - 1}], ' ') AS body
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {length - 2})) AS i FROM d)),
late AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY body) AS first FROM windows)
  WHERE first < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {length})) AS j FROM late),
places AS (SELECT doc_id, list(j) AS js, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(array_to_string(CASE WHEN n IS NULL THEN w ELSE list_transform(
    list_filter(range(1, len(w) + 1), lambda j: NOT list_contains(js, j)), lambda j: w[j]) END, ' ')) AS kept_sha256
FROM d LEFT JOIN places USING (doc_id)"""


def secrets_sql():
    rules = ", ".join(f"({i}, {_quoted(r.kind)}, {r.group}, {r.least}, {_quoted(r.pattern)})"
                      for i, r in enumerate(secretscan.RULES))
    base = len(secretscan.BASE_RULES)
    counts = ", ".join(f"CAST(count(*) FILTER (kind = {_quoted(r.kind)}) AS BIGINT) AS n_{r.kind}"
                       for r in secretscan.BASE_RULES)
    spans = "kind || ':' || place || ':' || (place + length(m)), ',' ORDER BY place, rank"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
rules(rank, kind, grp, least, pattern) AS (VALUES {rules}),
found AS (SELECT doc_id, rank, kind, grp, least, pattern, regexp_extract_all(text, pattern) AS ms,
    string_split_regex(text, pattern) AS gaps
  FROM d, rules WHERE regexp_matches(text, pattern)),
each AS (SELECT *, ms[i] AS m, list_sum(list_transform(gaps[1:i], lambda x: length(x)))
    + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS place
  FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM found)),
kept AS (SELECT doc_id, rank, kind, CAST(place AS BIGINT) AS place, m FROM each
  WHERE length(CASE WHEN grp = 2 THEN regexp_extract(m, pattern, 2) ELSE m END) >= least),
lists AS (SELECT doc_id, {counts},
    string_agg({spans}) FILTER (rank < {base}) AS base, string_agg({spans}) AS spans
  FROM kept GROUP BY doc_id)
SELECT d.doc_id, sha256(d.text) AS blob, {', '.join(f'coalesce(n_{r.kind}, 0) AS n_{r.kind}' for r in secretscan.BASE_RULES)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN lists USING (doc_id)"""


def line_sql():
    def agreeing(lines, others):
        return (f"coalesce(list_min(list_transform(range(1, len({lines}) + 1), lambda k: "
                f"CASE WHEN {lines}[k] IS DISTINCT FROM {others}[k] THEN k - 1 END)), len({lines}))")

    return f"""
WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE text IS NOT NULL),
hashed AS (SELECT *, CAST('0x' || left(md5(line), 15) AS BIGINT) % 2147483647 AS h FROM lines),
rolled AS (SELECT *, (coalesce(lag(h) OVER w, 0) * 1103515245 + h) % 2147483647 AS r,
    coalesce(h = lag(h) OVER w, false) AS like_last, coalesce(h = lead(h) OVER w, false) AS like_next FROM hashed
  WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
marked AS (SELECT *, CASE WHEN i = 1 THEN 1 WHEN like_last THEN CAST(like_next AND i % 2 = 1 AS INT)
    ELSE CAST(like_next OR coalesce(lag(like_last) OVER w, false)
      OR (r < lag(r) OVER w AND r < coalesce(lead(r) OVER w, 2147483647)) AS INT) END AS opens
  FROM rolled WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
placed AS (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS chunk FROM marked),
chunks AS (SELECT doc_id, chunk, min(i) AS start, count(*) AS n, list(line ORDER BY i) AS ls,
    list(line ORDER BY i DESC) AS back, string_agg(line, chr(10) ORDER BY i) AS body FROM placed GROUP BY doc_id, chunk),
around AS (SELECT *, coalesce(lag(back) OVER w, []) || coalesce(lag(back, 2) OVER w, []) AS before,
    coalesce(lead(ls) OVER w, []) || coalesce(lead(ls, 2) OVER w, []) AS after
  FROM chunks WINDOW w AS (PARTITION BY doc_id ORDER BY chunk)),
ranked AS (SELECT *, row_number() OVER w AS place, first_value(doc_id) OVER w AS doc_1, first_value(chunk) OVER w AS chunk_1
  FROM around WHERE n > 1 AND regexp_matches(body, '[^\\x20\\x09-\\x0D]')
  WINDOW w AS (PARTITION BY body ORDER BY doc_id, chunk ROWS UNBOUNDED PRECEDING)),
grown AS (SELECT c.doc_id, c.start - {agreeing('c.before', 'f.before')} AS low,
    c.start + c.n + {agreeing('c.after', 'f.after')} AS high
  FROM ranked c JOIN around f ON f.doc_id = c.doc_1 AND f.chunk = c.chunk_1 WHERE c.place > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(low, high)) AS i FROM grown),
judged AS (SELECT doc_id, line, i, gone.i IS NOT NULL AS gone FROM lines LEFT JOIN gone USING (doc_id, i))
SELECT d.doc_id, CAST(coalesce(j.n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(j.removed, 0) AS BIGINT) AS n_removed_lines,
  sha256(coalesce(j.body, '')) AS kept_sha256
FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS removed,
    string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone) AS body FROM judged GROUP BY doc_id) j USING (doc_id)"""


def quality_sql(false_rejections=0.01, error=0.05):
    shares = quality.SHARES

    def passes(rule, cutoff):
        above, below, high, _ = quality.RULES[rule]
        return f"(CAST({above} AS DOUBLE) / nullif({below}, 0) {'>' if high else '<'} {cutoff})"

    def rejected(prefix):
        return " OR ".join(f"coalesce({passes(rule, f'{prefix}_{rule}')}, false)" for rule in quality.RULES)

    counts = ", ".join(f"count(*) FILTER {passes(rule, c).replace('(', '(WHERE ', 1)} AS {rule}_{i}"
                       for rule, (*_, grid) in quality.RULES.items() for i, c in enumerate(grid))
    p = repr(false_rejections)
    sets = []
    for k, share in enumerate(shares):
        allowed = f"n * {share * false_rejections / len(quality.RULES)!r}::DOUBLE"
        for rule, (_, _, high, grid) in quality.RULES.items():
            safe = ", ".join(f"CASE WHEN {rule}_{i} <= {allowed} THEN {float(c)!r} END" for i, c in enumerate(grid))
            sets.append(f"{'list_min' if high else 'list_max'}([{safe}]) AS set{k}_{rule}")
    failed = ", ".join(f"count(*) FILTER (WHERE {rejected(f'set{k}')}) AS failed{k}" for k in range(len(shares)))
    proven = " ".join(
        f"WHEN failed{k} <= n * {p} AND list_sum(list_transform(range(0, failed{k} + 1), lambda i: exp(lgamma(n + 1) "
        f"- lgamma(i + 1) - lgamma(n - i + 1) + i * ln({p}) + (n - i) * ln(1 - {p})))) "
        f"<= {error!r} / ({len(shares)} * strata) THEN {k}" for k in range(len(shares)))
    cuts = ", ".join(f"CASE best {' '.join(f'WHEN {k} THEN set{k}_{rule}' for k in range(len(shares)))} END AS cut_{rule}"
                     for rule in quality.RULES)
    return f"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS body, {WORDS} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS body
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, body) AS n FROM windows) WHERE n > 1),
covered AS (SELECT doc_id, sum(least(8, i - coalesce(before, -8))) AS n FROM (
    SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM twice) GROUP BY doc_id),
s AS (SELECT d.doc_id, lang, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(body) - length(translate(body, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    CAST(length(body) - length(translate(body, '!?', '')) AS BIGINT) AS n_marks, len(lines) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN covered USING (doc_id)),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM s),
good AS (SELECT *, CAST('0x' || left(md5(CAST(doc_id AS VARCHAR)), 8) AS BIGINT) % 2 AS half FROM judged
  WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
sets AS (SELECT lang, {', '.join(sets)}
  FROM (SELECT lang, count(*) AS n, {counts} FROM good WHERE half = 0 GROUP BY lang)),
tested AS (SELECT sets.lang, count(*) AS n, {failed}
  FROM good JOIN sets ON good.lang IS NOT DISTINCT FROM sets.lang WHERE half = 1 GROUP BY sets.lang),
bests AS (SELECT lang, CASE {proven} END AS best FROM tested, (SELECT count(*) AS strata FROM sets)),
cuts AS (SELECT sets.lang, {cuts} FROM sets LEFT JOIN bests ON sets.lang IS NOT DISTINCT FROM bests.lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT ({rejected('cut')}) AS kept
FROM judged LEFT JOIN cuts ON judged.lang IS NOT DISTINCT FROM cuts.lang"""


def licenses_sql(least=0.8):
    share = least / (2 - least)
    known, lengths = licenses.template_bigrams(licenses.TEMPLATES), licenses.template_lengths(licenses.TEMPLATES)
    listed = ", ".join(f"({_quoted(n)}, {lengths[n]}, [{', '.join(_quoted(x) for x in b)}])" for n, b in known.items())
    return f"""
WITH d AS (SELECT doc_id, regexp_replace(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g') AS body FROM documents),
units AS (SELECT doc_id, -1 AS line, replace(body, chr(10), ' ') AS unit FROM d WHERE contains(body, chr(10))
  UNION ALL SELECT doc_id, generate_subscripts(string_split(body, chr(10)), 1) - 1, unnest(string_split(body, chr(10))) FROM d),
bigrams AS (SELECT doc_id, line, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS b
  FROM (SELECT doc_id, line, list_filter(string_split(unit, ' '), lambda x: x <> '') AS w FROM units) WHERE len(w) >= 2),
templates(name, n, t) AS (VALUES {listed}),
plain AS (SELECT DISTINCT doc_id, line, NULL::INTEGER AS word, name,
    2.0::DOUBLE * len(list_intersect(b, t)) / (len(b) + len(t)) AS dice
  FROM bigrams, templates WHERE len(b) BETWEEN len(t) * {share!r}::DOUBLE AND len(t) / {share!r}::DOUBLE),
texts AS (SELECT row_number() OVER () AS rid, doc_id, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) AS p
  FROM (SELECT doc_id, list_filter(string_split(replace(body, chr(10), ' '), ' '), lambda x: x <> '') AS w FROM d)),
places AS (SELECT rid, unnest(p) AS x, generate_subscripts(p, 1) AS i FROM texts),
starts AS (SELECT rid, i, name, n, t FROM places JOIN (SELECT name, n, t, unnest(t) AS x FROM templates) USING (x)),
windows AS (SELECT rid, doc_id, i, name, 2.0::DOUBLE * len(list_intersect(list_distinct(p[i:i + n - 2]), t))
    / (len(list_distinct(p[i:i + n - 2])) + len(t)) AS dice FROM starts JOIN texts USING (rid)),
inside AS (SELECT DISTINCT doc_id, -2 AS line, i - 1 AS word, name, dice FROM (SELECT *,
    row_number() OVER (PARTITION BY rid, name ORDER BY dice DESC, i) AS place FROM windows) b WHERE place = 1
  AND NOT EXISTS (SELECT 1 FROM plain WHERE plain.doc_id = b.doc_id AND plain.name = b.name AND plain.dice >= {least})),
hits AS (SELECT * FROM plain UNION ALL SELECT * FROM inside),
ranked AS (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n_hits,
    row_number() OVER (PARTITION BY doc_id ORDER BY dice DESC, name, line = -2, line, word) AS place FROM hits WHERE dice >= {least})
SELECT d.doc_id, CAST(coalesce(n_hits, 0) AS BIGINT) AS n_hits, name AS license, CAST(line AS INTEGER) AS line,
  CAST(word AS INTEGER) AS word, dice
FROM d LEFT JOIN ranked r ON d.doc_id = r.doc_id AND place = 1"""


def calls_sql():
    return """
WITH calls AS (SELECT conv_id, turn, 'call-' || conv_id || '-' || turn AS call_id, text,
    'call-' || conv_id || '-' || (turn - 2) AS after,
    len(list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) AS words
  FROM conversations WHERE role = 'user'),
results AS (SELECT conv_id, turn, 'call-' || conv_id || '-' || (turn - 1) AS call_id, text
  FROM conversations WHERE role = 'assistant')
SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.call_id, r.call_id) AS call_id,
  coalesce(c.turn, r.turn) AS turn, c.turn AS step,
  CASE WHEN c.turn IS NULL THEN 'no call' WHEN r.turn IS NULL THEN 'no result' ELSE 'ok' END AS status,
  CAST(c.turn IS NOT NULL AS BIGINT) AS n_calls, CAST(r.turn IS NOT NULL AS BIGINT) AS n_results,
  '{"after":' || CASE WHEN c.turn IS NULL THEN 'null,"arguments":null' ELSE '["' || after || '"],"arguments":{"message":'
    || CAST(to_json(c.text) AS VARCHAR) || ',"words":' || words || '}' END
    || ',"id":"' || coalesce(c.call_id, r.call_id) || '","name":' || CASE WHEN c.turn IS NULL THEN 'null' ELSE '"reply"' END
    || ',"output":' || coalesce(CAST(to_json(r.text) AS VARCHAR), 'null') || '}' AS record
FROM calls c FULL JOIN results r ON c.conv_id = r.conv_id AND c.call_id = r.call_id"""


def mixing_sql(keep=0.5, power=0.7, rounds=8, seed="mix"):
    names = mixing.DIMENSIONS
    parts = [f"""
WITH counted AS (SELECT doc_id, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang,
    coalesce(text, '') AS body, CAST(len({WORDS}) AS BIGINT) AS n_tokens FROM documents),
formed AS (SELECT *, CASE WHEN 10 * (length(body) - length(translate(body, '|', ''))) > n_tokens THEN 'table'
    WHEN 2 * (length(body) - length(translate(body, '#*$%&!', ''))) > n_tokens THEN 'marked'
    WHEN n_tokens < 100 THEN 'note' WHEN n_tokens < 1000 THEN 'article' ELSE 'long' END AS topic FROM counted),
cells AS MATERIALIZED (SELECT source, lang, topic, CAST(sum(n_tokens) AS DOUBLE) AS tokens FROM formed GROUP BY ALL)"""]
    now = {}
    for name in names:
        parts.append(f"target_{name} AS MATERIALIZED (SELECT {name}, power(sum(tokens), {power}) / "
                     f"sum(power(sum(tokens), {power})) OVER () AS share FROM cells GROUP BY {name})")
        parts.append(f"{name}_0 AS MATERIALIZED (SELECT {name}, 1.0::DOUBLE AS f FROM target_{name})")
        now[name] = f"{name}_0"
    for k in range(1, rounds + 1):
        for name in names:
            a, b = [x for x in names if x != name]
            parts.append(
                f"{name}_{k} AS MATERIALIZED (SELECT t.{name}, coalesce(share / nullif(mass, 0), 0) AS f FROM target_{name} t "
                f"LEFT JOIN (SELECT {name}, sum(tokens * a.f * b.f) AS mass FROM cells JOIN {now[a]} a USING ({a}) "
                f"JOIN {now[b]} b USING ({b}) GROUP BY {name}) m USING ({name}))")
            now[name] = f"{name}_{k}"
    a, b, c = names
    return ",\n".join(parts) + f""",
wanted AS (SELECT f.*, round(x.f * y.f * z.f * ({keep} * (SELECT sum(tokens) FROM cells)), 9) AS wanted
  FROM formed f JOIN {now[a]} x USING ({a}) JOIN {now[b]} y USING ({b}) JOIN {now[c]} z USING ({c}))
SELECT doc_id, source, lang, topic, n_tokens, least(wanted, 1.0) AS probability, greatest(wanted, 1.0) AS weight,
  CAST('0x' || left(md5('{seed}:' || doc_id), 13) AS BIGINT) / 4503599627370496.0::DOUBLE < least(wanted, 1.0) AS sampled
FROM wanted"""


def ranking_sql(places=10):
    terms = ("unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
             "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term")
    return f"""
WITH held AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, {terms} FROM documents) GROUP BY ALL),
sizes AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM held GROUP BY doc_id),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sizes),
asked AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, {terms} FROM benchmark) GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM held GROUP BY term), corpus),
parts AS (SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // total)) AS part
  FROM held JOIN sizes USING (doc_id), corpus),
scores AS (SELECT item_id, doc_id, CAST(sum(times * w * part) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN parts USING (term) GROUP BY ALL),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {places}"""


SQL = {
    "op1_source_mixing": mixing_sql(), "op2_secret_scan": secrets_sql(), "op5_line_dedup": line_sql(),
    "op6_quality_rules": quality_sql(), "op7_tool_calls": calls_sql(), "op8_substring_dedup": substring_sql(),
    "op9_license_scan": licenses_sql(), "op11_lexical_search": ranking_sql(),
}

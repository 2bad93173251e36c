"""DuckDB SQL for the operators that SQL can express.  It states results directly (all windows, all pairs), not the way
they are found.  The rest (4, 7, 8, 10 and the pipeline) is tested against brute-force versions in tests/llm."""

from __future__ import annotations

from chartmill.llm import licences, secrets

WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def either(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


def op1() -> str:
    """As the docstring of `secrets` says it, for tables of less than twice `SAMPLE` documents, whose letter pairs are all counted."""
    keys = "|".join([*(either(w) for w in ("password", "passwd", "secret", "token")), either("api") + "_?" + either("key")])
    assign = secrets.ASSIGN.replace("(?i:(password|passwd|secret|token|api_?key))", f"({keys})")
    shapes = [("assign", 1, assign, 2, 6), ("access", 2, secrets.ACCESS, 0, 20), ("hex", 3, secrets.HEX, 0, 24), ("run", 4, secrets.CANDIDATE, 0, 0)]
    cut = lambda p, group=0: f"string_split_regex(t, {quoted(p)}) AS gaps, regexp_extract_all(t, {quoted(p)}, 0) AS m, regexp_extract_all(t, {quoted(p)}, {group}) AS g"
    found = " UNION ALL ".join(f"SELECT id, 0 AS off, '{kind}' AS kind, {rank} AS rank, {least} AS least, {cut(p, group)} FROM d" for kind, rank, p, group, least in shapes)
    parts = " UNION ALL ".join(f"SELECT id, off, 'random' AS kind, 4 AS rank, 0 AS least, {cut(p)} FROM runs" for p in secrets.PARTS)
    placed = lambda rows: f"""SELECT id, kind, rank, token, CAST(off + s AS BIGINT) AS s, CAST(off + s + length(token) AS BIGINT) AS e FROM (
    SELECT id, off, kind, rank, least, m[i] AS token, length(g[i]) AS held,
      list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS s
    FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM ({rows}))) WHERE held >= least"""  # noqa: E731
    fits = lambda allowed, needed: " AND ".join([f"regexp_full_match(token, '{allowed}')", *(f"regexp_matches(token, '{x}')" for x in needed)])
    case = lambda value: "CASE " + " ".join(f"WHEN {fits(allowed, needed)} THEN '{value(name, alphabet)}'" for name, allowed, alphabet, needed in secrets.ENCODINGS + secrets.LETTERS) + " END"
    tail = lambda z: (
        f"(CASE WHEN {z} >= 0 THEN 0 ELSE 1 END + sign(CASE WHEN {z} >= 0 THEN 1 ELSE -1 END) * exp(-{z} * {z} / 2) / sqrt(2 * pi()) * (1 / (1 + 0.2316419 * abs({z}))) * (0.319381530 + (1 / (1 + 0.2316419 * abs({z}))) * "
        f"(-0.356563782 + (1 / (1 + 0.2316419 * abs({z}))) * (1.781477937 + (1 / (1 + 0.2316419 * abs({z}))) * (-1.821255978 + (1 / (1 + 0.2316419 * abs({z}))) * 1.330274429)))))")
    grid = secrets.GRID
    last = len(grid) - 1
    above = ", ".join(f"count(*) FILTER (WHERE p >= {t}) AS n{i}" for i, t in enumerate(grid))
    lowest = f"CASE WHEN n0 < {secrets.DENSE} THEN NULL " + " ".join(f"WHEN n{i} - n{last} * {(1 - grid[i]) / (1 - grid[-1])!r} <= 0.1 * n{i} + 2 * sqrt(n{i}) THEN {grid[i]}" for i in range(last)) + f" ELSE {grid[-1]} END"
    listed = lambda where: f"coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank, e) FILTER (WHERE {where}), '')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS t FROM documents),
fixed AS ({placed(found)}),
base AS (SELECT * FROM fixed WHERE rank < 4),
runs AS (SELECT id, s AS off, token AS t FROM fixed WHERE rank = 4),
part AS (SELECT DISTINCT id, token, s, e FROM ({placed(parts)})),
cand AS (
  SELECT row_number() OVER () AS c, id, s, e, token, regexp_replace(token, '=+$', '') AS body FROM part p
  WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.id = p.id AND b.s < p.e AND p.s < b.e)),
word AS (SELECT unnest(regexp_extract_all(lower(regexp_replace(t, '{secrets.CANDIDATE}', ' ', 'g')), '[a-z]+')) AS word FROM d),
two AS (SELECT substring(word, CAST(i AS BIGINT), 2) AS pair FROM (SELECT word, unnest(range(1, length(word))) AS i FROM word WHERE length(word) BETWEEN 2 AND 19)),
seen AS (SELECT pair, count(*) AS n FROM two GROUP BY pair),
ahead AS (SELECT pair[1] AS one, sum(n) AS of_one FROM seen GROUP BY 1),
bit AS (
  SELECT one || c AS pair, log2(26 * (coalesce(n, 0) + 1.0) / (of_one + 26)) AS bits
  FROM ahead CROSS JOIN (SELECT unnest(string_split('{secrets.LOWER}', '')) AS c) LEFT JOIN seen ON pair = one || c),
text_bits AS (
  SELECT c, sum(bits) AS bits FROM (SELECT c, substring(lower(token), CAST(i AS BIGINT), 2) AS pair FROM (SELECT c, token, unnest(range(1, length(token))) AS i FROM cand)) JOIN bit USING (pair) GROUP BY c),
coded AS (
  SELECT * FROM (SELECT *, {case(lambda n, a: n)} AS encoding, {case(lambda n, a: a)} AS alphabet FROM cand) LEFT JOIN text_bits USING (c)
  WHERE encoding IS NOT NULL AND length(body) >= 4 AND (encoding IN ('hex', 'upper_hex') OR coalesce(bits, 0) < {secrets.TEXT_BITS})),
body AS (SELECT c, encoding, alphabet, body, CAST(length(body) AS DOUBLE) AS n, CAST(length(alphabet) AS DOUBLE) AS k FROM coded),
chars AS (SELECT c, n, k, i, CAST(strpos(alphabet, substring(body, i, 1)) AS DOUBLE) AS v FROM (SELECT *, unnest(range(1, CAST(n AS BIGINT) + 1)) AS i FROM body)),
near AS (SELECT *, lead(v) OVER w AS after, first_value(v) OVER w AS opening, (v > floor(k / 2)) AS up, lag(v > floor(k / 2)) OVER w AS was FROM chars WINDOW w AS (PARTITION BY c ORDER BY i)),
squares AS (SELECT c, sum(q * q) AS sq FROM (SELECT c, v, CAST(count(*) AS DOUBLE) AS q FROM chars GROUP BY c, v) GROUP BY c),
sums AS (
  SELECT c, any_value(n) AS n, any_value(k) AS k, sum(v) AS s1, sum(v * v) AS s2, sum(v * coalesce(after, opening)) AS cross_sum,
    sum(CASE WHEN up THEN 1.0 ELSE 0.0 END) AS upper, 1 + sum(CASE WHEN was IS NOT NULL AND was <> up THEN 1 ELSE 0 END) AS runs
  FROM near GROUP BY c),
stats AS (
  SELECT c, n, (sq * k / n - n) / ((n - 1) / n) AS chi, (k - 1) / ((n - 1) / n) AS free, 2 * upper * (n - upper) / n + 1 AS mean, CAST(runs AS DOUBLE) AS runs,
    n * s2 - s1 * s1 AS spread, n * cross_sum - s1 * s1 AS co
  FROM sums JOIN squares USING (c)),
z AS (
  SELECT c, n, (pow(greatest(chi, 0) / free, 1.0 / 3) - (1 - 2 / (9 * free))) / sqrt(2 / (9 * free)) AS z1,
    CASE WHEN (mean - 1) * (mean - 2) / (n - 1) > 0 THEN abs(runs - mean) / sqrt((mean - 1) * (mean - 2) / (n - 1)) END AS z2,
    CASE WHEN spread > 0 THEN abs(co / spread + 1 / (n - 1)) / (sqrt(n * (n - 3) / (n + 1)) / (n - 1)) END AS z3
  FROM stats),
half AS (
  SELECT c, n, greatest(0, -(ln(greatest({tail('z1')}, 1e-300)) + ln(greatest(coalesce(2 * {tail('z2')}, 0), 1e-300)) + ln(greatest(coalesce(2 * {tail('z3')}, 0), 1e-300)))) AS h
  FROM z),
tested AS (
  SELECT c, id, s, e, encoding, CASE WHEN n <= 64 THEN floor(n / 8) ELSE floor(log2(n)) + 3 END AS class, exp(-h) * (1 + h + h * h / 2) AS p
  FROM half JOIN coded USING (c)),
apart AS (SELECT DISTINCT encoding, class, p FROM tested WHERE p >= {grid[0]}),
own AS (SELECT encoding, class, {lowest} AS own FROM (SELECT encoding, class, {above} FROM apart GROUP BY ALL)),
by_code AS (SELECT encoding, {lowest} AS coded FROM (SELECT encoding, {above} FROM apart GROUP BY ALL)),
by_all AS (SELECT {lowest} AS every FROM (SELECT {above} FROM apart)),
limits AS (SELECT encoding, class, coalesce(own, coded, every, {grid[0]}) AS threshold FROM own JOIN by_code USING (encoding) CROSS JOIN by_all),
kept AS (SELECT DISTINCT id, s, e FROM tested JOIN limits USING (encoding, class) WHERE p >= threshold),
opens AS (SELECT *, CASE WHEN s < max(e) OVER (PARTITION BY id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS opens FROM kept),
nr AS (SELECT *, sum(opens) OVER (PARTITION BY id ORDER BY s, e) AS nr FROM opens),
every_span AS (
  SELECT id, kind, rank, s, e FROM base
  UNION ALL SELECT id, 'random', 4, min(s), max(e) FROM nr GROUP BY id, nr)
SELECT doc_id, count(*) FILTER (WHERE rank = 1) AS n_assign, count(*) FILTER (WHERE rank = 2) AS n_access, count(*) FILTER (WHERE rank = 3) AS n_hex, count(*) FILTER (WHERE rank = 4) AS n_random,
  sha256({listed('rank < 4')}) AS base_sha256, {listed('rank IS NOT NULL')} AS spans
FROM d LEFT JOIN every_span USING (id) GROUP BY id, doc_id"""


def discounts(counts: str) -> str:
    """Discounts d1, d2, d3 from a relation with the counts `n`."""
    return f"""(
  SELECT CASE WHEN least(n1, n2, n3, n4) = 0 THEN 0.5 ELSE greatest(0, least(1, 1 - 2 * y * n2 / n1)) END AS d1,
    CASE WHEN least(n1, n2, n3, n4) = 0 THEN 1 ELSE greatest(0, least(2, 2 - 3 * y * n3 / n2)) END AS d2,
    CASE WHEN least(n1, n2, n3, n4) = 0 THEN 1.5 ELSE greatest(0, least(3, 3 - 4 * y * n4 / n3)) END AS d3
  FROM (SELECT *, n1 / (n1 + 2 * n2) AS y FROM (
    SELECT CAST(count(*) FILTER (WHERE n = 1) AS DOUBLE) AS n1, CAST(count(*) FILTER (WHERE n = 2) AS DOUBLE) AS n2, CAST(count(*) FILTER (WHERE n = 3) AS DOUBLE) AS n3, CAST(count(*) FILTER (WHERE n = 4) AS DOUBLE) AS n4 FROM {counts})))"""


def op2() -> str:
    cut = lambda n: f"(CASE WHEN {n} = 0 THEN 0 WHEN {n} = 1 THEN d1 WHEN {n} = 2 THEN d2 ELSE d3 END)"
    return f"""
WITH poly AS (
  SELECT list(c ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, j: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM (SELECT unnest(range(256)) AS i))),
docs AS (
  SELECT row_number() OVER () AS id, doc_id,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(coalesce(CAST(doc_id AS VARCHAR), '') AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 5 = 1 AS held_out,
    list_append({WORDS}, chr(10)) AS w
  FROM documents, poly),
tok AS (SELECT id, held_out, unnest(w) AS v, unnest(range(len(w))) AS i FROM docs),
pair AS (SELECT id, held_out, v, i, coalesce(lag(v) OVER (PARTITION BY id ORDER BY i), '') AS u FROM tok),
uni AS (SELECT v, CAST(count(*) AS DOUBLE) AS c FROM tok WHERE NOT held_out GROUP BY v),
bi AS (SELECT u, v, CAST(count(*) AS DOUBLE) AS n FROM pair WHERE NOT held_out GROUP BY u, v),
tot AS (SELECT coalesce(sum(c), 0) AS nn, CAST(count(*) AS DOUBLE) AS vv FROM uni),
cont AS (SELECT v, CAST(count(*) AS DOUBLE) AS n FROM bi GROUP BY v),
dp AS {discounts('bi')},
dw AS {discounts('cont')},
ctx AS (SELECT u, sum(n) AS follow, sum({cut('n')}) AS freed FROM bi, dp GROUP BY u),
low AS (SELECT sum(n) AS total, sum({cut('n')}) AS freed FROM cont, dw),
pb AS (SELECT u, v, n - {cut('n')} AS held FROM bi, dp),
pw AS (SELECT v, n - {cut('n')} AS held FROM cont, dw),
scored AS (
  SELECT p.id, uni.c, log10((coalesce(uni.c, 0) + 0.5) / (nn + 0.5 * (vv + 1))) AS b,
    CASE WHEN nn = 0 THEN 0 ELSE log10(coalesce(pb.held / ctx.follow, 0) + coalesce(ctx.freed / ctx.follow, 1) * (coalesce(pw.held, 0) / low.total + low.freed / low.total / (vv + 1))) END AS s
  FROM pair p CROSS JOIN tot CROSS JOIN low LEFT JOIN uni USING (v) LEFT JOIN ctx ON ctx.u = p.u LEFT JOIN pb ON pb.u = p.u AND pb.v = p.v LEFT JOIN pw ON pw.v = p.v)
SELECT d.doc_id, d.held_out, count(*) AS n_tokens, count(s.c) AS n_known, CAST(any_value(nn) AS BIGINT) AS train_tokens, round(sum(b), 6) AS base_score, round(sum(s), 6) AS score
FROM docs d JOIN scored s USING (id) CROSS JOIN tot GROUP BY d.id, d.doc_id, d.held_out"""


def op3() -> str:
    return """
WITH RECURSIVE e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS x FROM embeddings),
ok AS (
  SELECT DISTINCT vec_id, x, sqrt(list_sum(list_transform(x, lambda y: y * y))) AS n FROM e
  WHERE vec_id IS NOT NULL AND len(x) > 0 AND len(list_filter(x, lambda y: y IS NULL OR isnan(y) OR isinf(y))) = 0 AND len(list_filter(x, lambda y: y <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_sum(list_transform(range(1, len(a.x) + 1), lambda i: a.x[i] * b.x[i])) / (a.n * b.n) >= 0.9),
reach(a, b) AS (SELECT vec_id, vec_id FROM e UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
low AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, coalesce(e.vec_id = component_id, false) AS kept
FROM e LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) c ON c.a = e.vec_id LEFT JOIN low ON low.a = e.vec_id"""


# A turn without a number comes before all others.
OP5 = """
WITH rows AS (SELECT DISTINCT conv_id, coalesce(turn, -9223372036854775808) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
last AS (SELECT conv_id, max(turn) FILTER (WHERE role = 'assistant') AS last FROM rows GROUP BY conv_id),
mine AS (SELECT a.conv_id, a.last, xor(a.conv_id, 1) AS partner, b.last AS other, a.last IS NOT NULL AND b.last IS NOT NULL AS two FROM last a LEFT JOIN last b ON b.conv_id = xor(a.conv_id, 1)),
c AS (SELECT conv_id AS pair_id, turn, role, text FROM rows),
r AS (
  SELECT conv_id AS pair_id, turn, role, text FROM rows JOIN mine USING (conv_id) WHERE two AND turn <> last
  UNION SELECT m.partner, m.other, x.role, x.text FROM rows x JOIN mine m USING (conv_id) WHERE two AND x.turn = m.last),
held AS (
  SELECT pair_id, turn, role, text, bool_or(side = 1) AS c, bool_or(side = 2) AS r FROM (SELECT *, 1 AS side FROM c UNION ALL SELECT *, 2 FROM r) GROUP BY ALL),
pair AS (SELECT pair_id, min(turn) FILTER (WHERE NOT (c AND r)) AS split, CASE WHEN bool_or(c) AND bool_or(r) THEN 'both' WHEN bool_or(c) THEN 'chosen' ELSE 'rejected' END AS sides FROM held GROUP BY pair_id),
parts AS (
  SELECT *, CASE WHEN turn > -9223372036854775808 THEN CAST(floor(turn / 64.0) AS BIGINT) END AS piece, '<|' || role || '|>' || chr(10) || text || chr(10) || '<|end|>' || chr(10) AS said,
    unnest(CASE WHEN split IS NULL OR turn < split THEN ['prompt'] WHEN c AND r THEN ['chosen', 'rejected'] WHEN c THEN ['chosen'] ELSE ['rejected'] END) AS part
  FROM held JOIN pair USING (pair_id)),
placed AS (SELECT *, CAST(sum(length(said)) OVER (PARTITION BY pair_id, piece, part ORDER BY turn, role, text) AS BIGINT) AS ends FROM parts)
SELECT pair_id, piece, sides, coalesce(string_agg(said, '' ORDER BY turn, role, text) FILTER (WHERE part = 'prompt'), '') AS prompt,
  coalesce(string_agg(said, '' ORDER BY turn, role, text) FILTER (WHERE part = 'chosen'), '') AS chosen,
  coalesce(string_agg((ends - length(said)) || ':' || ends, ',' ORDER BY ends) FILTER (WHERE part = 'chosen' AND role = 'assistant'), '') AS chosen_mask,
  coalesce(string_agg(said, '' ORDER BY turn, role, text) FILTER (WHERE part = 'rejected'), '') AS rejected,
  coalesce(string_agg((ends - length(said)) || ':' || ends, ',' ORDER BY ends) FILTER (WHERE part = 'rejected' AND role = 'assistant'), '') AS rejected_mask
FROM placed GROUP BY pair_id, piece, sides"""


# All alignments with enough equal words to count, however they might be found.
OP6 = r"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, WORDS AS w FROM documents),
item AS (SELECT DISTINCT item_id, WORDS AS w FROM benchmark),
items AS (SELECT row_number() OVER () AS it, item_id, w FROM item WHERE len(w) > 0),
da AS (SELECT id, unnest(w) AS word, unnest(range(len(w))) AS pos FROM d),
ia AS (SELECT it, unnest(w) AS word, unnest(range(len(w))) AS pos, len(w) AS n FROM items),
hits AS (SELECT id, it, da.pos - ia.pos AS shift FROM da JOIN ia USING (word) GROUP BY id, it, da.pos - ia.pos HAVING count(*) >= least(0.8 * any_value(n), 13)),
cells AS (SELECT h.id, h.it, h.shift, j, CASE WHEN d.w[h.shift + j + 1] = i.w[j + 1] THEN 1 ELSE 0 END AS eq, len(i.w) AS n
  FROM hits h JOIN d USING (id) JOIN items i USING (it), unnest(range(len(i.w))) AS u(j) WHERE h.shift + j >= 0 AND h.shift + j < len(d.w)),
runs AS (SELECT *, sum(CASE WHEN eq = 1 THEN 1 ELSE -4 END) OVER (PARTITION BY id, it, shift ORDER BY j) AS s FROM cells),
best AS (SELECT *, s - least(0, coalesce(min(s) OVER (PARTITION BY id, it, shift ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS score FROM runs),
good AS (SELECT id, it, shift, sum(eq) AS matched FROM best GROUP BY id, it, shift HAVING sum(eq) >= 0.8 * any_value(n) OR max(score) >= 13),
per AS (SELECT id, item_id, max(matched) AS matched, max(len(w)) >= 5 AS strong FROM good JOIN items USING (it) GROUP BY id, item_id),
doc AS (
  SELECT id, count(*) FILTER (WHERE strong) AS n_items, string_agg(coalesce(CAST(item_id AS VARCHAR), 'null'), ',' ORDER BY item_id NULLS FIRST) FILTER (WHERE strong) AS items, max(matched) FILTER (WHERE strong) AS matched,
    string_agg(coalesce(CAST(item_id AS VARCHAR), 'null'), ',' ORDER BY item_id NULLS FIRST) FILTER (WHERE NOT strong) AS weak_items
  FROM per GROUP BY id)
SELECT doc_id, coalesce(n_items, 0) > 0 AS contaminated, coalesce(n_items, 0) AS n_items, coalesce(items, '') AS items, CAST(coalesce(matched, 0) AS BIGINT) AS matched, coalesce(weak_items, '') AS weak_items
FROM d LEFT JOIN doc USING (id)""".replace("WORDS", r"list_filter(string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}]+', ' ', 'g')), ' '), lambda x: x <> '')")


def op9() -> str:
    swaps = ", ".join(f"{quoted(a)}: {quoted(b)}" for a, b in licences.SPELLINGS.items())

    def words(text: str) -> str:
        plain = f"array_to_string(list_transform(list_filter(string_split(regexp_replace(lower({text}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' '), lambda w: w <> ''), lambda w: coalesce(swaps[w], w)), ' ')"
        for a, b in licences.PHRASES:
            plain = f"trim(replace(' ' || {plain} || ' ', ' {a} ', ' {b} '))"
        return plain

    canon = words(f"regexp_replace(coalesce(text, ''), {quoted(licences.COPYRIGHT_LINE.pattern)}, ' ', 'g')")
    known = ", ".join(f"({quoted(n)}, {quoted(t)})" for n, t in licences.listed_texts())
    digest = lambda form: f"CASE WHEN {form} <> '' THEN sha256({form}) END"
    return f"""
WITH spelling AS (SELECT MAP {{{swaps}}} AS swaps),
known AS (SELECT name, CASE WHEN form <> '' THEN form ELSE plain END AS form FROM (SELECT name, {canon} AS form, {words('text')} AS plain FROM (VALUES {known}) AS k(name, text), spelling)),
listed AS (SELECT sha256(form) AS digest, min(name) AS licence FROM known WHERE form <> '' GROUP BY 1),
d AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents),
whole AS (SELECT id, doc_id, {digest('form')} AS digest FROM (SELECT id, doc_id, {canon} AS form FROM d, spelling)),
split AS (SELECT id, string_split_regex(text, '\\r\\n|\\r|\\n') AS ls FROM d),
line AS (SELECT DISTINCT id, {words('text')} AS form FROM (SELECT id, unnest(ls || list_transform(range(1, len(ls)), lambda i: ls[i] || ' ' || ls[i + 1])) AS text FROM split), spelling),
hit AS (SELECT id, count(*) AS n, string_agg(DISTINCT licence, ',' ORDER BY licence) AS names FROM line JOIN listed ON listed.digest = sha256(line.form) WHERE form <> '' GROUP BY id)
SELECT doc_id, w.digest, licence, coalesce(n, 0) AS n_lines, coalesce(names, '') AS line_licences FROM whole w LEFT JOIN listed USING (digest) LEFT JOIN hit USING (id)"""


OP11 = """
WITH d AS (SELECT row_number() OVER () AS nr, doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST, nr) = 1 AS kept, text_sha256
FROM d WINDOW same AS (PARTITION BY text_sha256)"""


OP12 = r"""
WITH d AS (SELECT row_number() OVER () AS nr, doc_id, TERMS AS t FROM documents),
i AS (SELECT row_number() OVER () AS it, item_id, TERMS AS t FROM benchmark),
size AS (SELECT nr, doc_id, len(t) AS n FROM d WHERE len(t) > 0),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM size),
tf AS (SELECT nr, term, count(*) AS tf FROM (SELECT nr, unnest(t) AS term FROM d) GROUP BY ALL),
q AS (SELECT it, item_id, term, count(*) AS q FROM (SELECT it, item_id, unnest(t) AS term FROM i) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), total),
s AS (
  SELECT it, item_id, nr, doc_id, CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms)))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN size USING (nr) CROSS JOIN total GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY it ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0) WHERE rank <= 20""".replace(
    "TERMS", r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")


#: CRC-32 of the text `name` from a table of remainders, `tab`.
POLY = "poly AS (SELECT list(c ORDER BY i) AS tab FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, j: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM (SELECT unnest(range(256)) AS i)))"
CRC = "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(name, ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)"
# Rows are taken from the last to the first; best holds, for each state that a repair may be in before a row, the least of
# (cost, audit) of all that may follow, and the lines it gives.  Up to two rows are inserted before a row.
OP13 = f"""
WITH RECURSIVE {POLY},
told AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
hit AS (SELECT *, {CRC} % 20 AS kind FROM told, poly),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM hit WHERE kind <> 0),
placed AS (SELECT *, trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS seen, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
faulty AS (
  SELECT conv_id, turn, i, role, text, left(role, 1) AS initial, left(role, 1) || left(lead(role) OVER (PARTITION BY conv_id ORDER BY i), 1) AS pair,
    CASE WHEN seen = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN right(seen, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM placed),
ids AS (SELECT row_number() OVER () AS c, conv_id FROM (SELECT DISTINCT conv_id FROM conversations)),
r AS (SELECT c, f.* FROM faulty f JOIN ids ON ids.conv_id IS NOT DISTINCT FROM f.conv_id),
ends AS (SELECT ids.c, coalesce(max(i), 0) AS n FROM ids LEFT JOIN r USING (c) GROUP BY ids.c),
-- one row inserted: from which state, to which, as what
ins(q, z, line) AS (VALUES (0, 2, 'user:'), (1, 2, 'user:'), (2, 3, 'assistant:'), (3, 2, 'user:')),
lead_in AS (
  SELECT q, q AS z, 0 AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS lines FROM (VALUES (0), (1), (2), (3)) AS s(q)
  UNION ALL SELECT q, z, 3, 'I', [line] FROM ins
  UNION ALL SELECT a.q, b.z, 6, 'II', [a.line, b.line] FROM ins a JOIN ins b ON a.z = b.q),
steps(q, initial, z, rerole) AS (
  VALUES (0, 's', 1, NULL), (0, 'u', 2, NULL), (1, 'u', 2, NULL), (2, 'a', 3, NULL), (3, 'u', 2, NULL), (0, '', 2, 'user'), (1, '', 2, 'user'), (2, '', 3, 'assistant'), (3, '', 2, 'user')),
acts AS (
  SELECT c, i, s.q, s.z, 3 * CAST(rerole IS NOT NULL AS INTEGER) + 3 * CAST(fault = 'truncated' AS INTEGER) AS cost, CASE WHEN rerole IS NULL THEN 'K' ELSE 'R' END AS audit, [coalesce(rerole, role) || ':' || text] AS lines
  FROM r JOIN steps s ON fault NOT IN ('blank', 'duplicate') AND (rerole IS NOT NULL OR r.initial = s.initial)
  UNION ALL SELECT c, i, s.q, s.q, 4, 'D', CAST([] AS VARCHAR[]) FROM r, (VALUES (0), (1), (2), (3)) AS s(q)),
moves AS (SELECT a.c, a.i, l.q, a.z, l.cost + a.cost AS cost, l.audit || a.audit AS audit, l.lines || a.lines AS lines FROM acts a JOIN lead_in l ON l.z = a.q),
best(c, i, q, b) AS (
  SELECT c, n + 1, q, min(struct_pack(cost := CAST(cost AS BIGINT), audit := audit, lines := lines)) FROM ends, lead_in WHERE z IN (0, 3) GROUP BY ALL
  UNION ALL
  SELECT m.c, m.i, m.q, min(struct_pack(cost := CAST(m.cost + b.b.cost AS BIGINT), audit := m.audit || b.b.audit, lines := m.lines || b.b.lines))
  FROM best b JOIN moves m ON m.c = b.c AND m.i = b.i - 1 AND m.z = b.q GROUP BY m.c, m.i, m.q),
counts AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM r GROUP BY c)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  b.cost AS cost, b.audit AS audit, sha256(array_to_string(b.lines, chr(10))) AS repaired_sha256
FROM ids JOIN best ON best.c = ids.c AND best.i = 1 AND best.q = 0 LEFT JOIN counts ON counts.c = ids.c"""


SQL = {
    "op1_secret_scan": op1(), "op2_lm_scoring": op2(), "op3_embedding_dedup": op3(), "op5_chat_preference": OP5, "op6_decontamination": OP6, "op9_licence_scan": op9(),
    "op11_exact_dedup": OP11, "op12_lexical_search": OP12, "op13_conversation_repair": OP13,
}

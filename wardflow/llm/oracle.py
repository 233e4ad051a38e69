"""SQL that the queries of this package are compared with, where SQL can say what they do."""

from __future__ import annotations

from wardflow.llm.mixing import STEPS, Mixture


def _bisection(name: str, too_low: str) -> str:
    """A recursive CTE that halves [lo, hi] once per step; ``too_low`` is a condition on the exponent ``mid``."""
    return f"""
{name} AS (
  SELECT 0 AS step, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi
  UNION ALL
  SELECT step + 1, CASE WHEN low THEN mid ELSE lo END, CASE WHEN low THEN hi ELSE mid END
  FROM (SELECT step, lo, hi, mid, {too_low} AS low
        FROM (SELECT step, lo, hi, (lo + hi) / 2 AS mid, g.*,
                list_sum(list_transform(ps, lambda p: pow(p, (lo + hi) / 2))) AS z,
                list_sum(list_transform(ps, lambda p: pow(p, (lo + hi) / 2) * ln(p))) AS s,
                list_max(list_transform(ps, lambda p: pow(p, (lo + hi) / 2) / (p * total))) AS r
              FROM {name}, given g WHERE step < {STEPS}) t) u)"""


def mixing_sql(m: Mixture) -> str:
    return f"""
WITH RECURSIVE counted AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_tokens,
    substr(md5('{m.seed}|' || coalesce(doc_id::VARCHAR, '')), 1, {m.block_digits}) AS block
  FROM documents),
blocks AS (SELECT source, block, sum(n_tokens)::BIGINT AS tokens FROM counted GROUP BY ALL),
live AS (SELECT source, sum(tokens)::BIGINT AS tokens FROM blocks GROUP BY source HAVING sum(tokens) > 0),
given AS (
  SELECT list(tokens / total) AS ps, any_value(total) AS total, any_value(total) * {m.budget_share}::DOUBLE AS budget,
    {m.target_entropy}::DOUBLE * ln(count(*)) AS goal, -sum(tokens / total * ln(tokens / total)) AS entropy
  FROM (SELECT tokens, (sum(tokens) OVER ())::DOUBLE AS total FROM live)),
{_bisection("by_entropy", "ln(z) - mid * s / z >= goal")},
{_bisection("by_repeats", f"r / z * budget > {m.most_repeats}::DOUBLE")},
solved AS (
  SELECT greatest(CASE WHEN entropy < goal THEN e.hi ELSE 1.0 END, r.hi) AS exponent, total
  FROM given, by_entropy e, by_repeats r WHERE e.step = {STEPS} AND r.step = {STEPS}),
plan AS (
  SELECT source, tokens, least(round(weight * total * {m.budget_share}::DOUBLE), floor(tokens * {m.most_repeats}::DOUBLE))::BIGINT AS budget
  FROM (SELECT source, tokens, total, pow(tokens / total, exponent) / sum(pow(tokens / total, exponent)) OVER () AS weight
        FROM live, solved)),
read AS (
  SELECT b.source, b.block, b.tokens, budget // p.tokens AS epochs, budget % p.tokens AS rest,
    unnest(range(budget // p.tokens + 1)) AS epoch
  FROM blocks b JOIN plan p ON b.source IS NOT DISTINCT FROM p.source),
ranked AS (
  SELECT *, row_number() OVER w AS block_rank, sum(tokens) OVER w AS done
  FROM (SELECT *, md5(concat('{m.seed}|', coalesce(source, ''), '|', epoch, '|', block)) AS turn FROM read)
  WINDOW w AS (PARTITION BY source, epoch ORDER BY turn, block ROWS UNBOUNDED PRECEDING)),
taken AS (
  SELECT *, epoch < epochs OR done <= rest AS whole, rest - done + tokens AS room
  FROM ranked WHERE epoch < epochs OR done <= rest OR done - tokens < rest),
met AS (
  SELECT c.doc_id, c.source, c.n_tokens, t.epoch, c.block, t.block_rank, whole, room,
    md5(concat('{m.seed}|', epoch, '|', coalesce(doc_id::VARCHAR, ''))) AS place
  FROM counted c JOIN taken t ON c.source IS NOT DISTINCT FROM t.source AND c.block = t.block)
SELECT doc_id, source, n_tokens::BIGINT AS n_tokens, epoch::INTEGER AS epoch, block, block_rank::INTEGER AS block_rank, place
FROM (SELECT *, sum(n_tokens) OVER (PARTITION BY source, epoch, whole ORDER BY place RANGE UNBOUNDED PRECEDING) AS upto FROM met)
WHERE whole OR upto <= room"""


# The crc32 polynomial's remainders of four bits.
_CRC_NIBBLES = """[0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948,
    3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108]"""


def _crc32(digits: str) -> str:
    """The unsigned crc32 of a short ASCII text, a nibble at a time."""
    nibble = f"lambda c, i: xor(c >> 4, {_CRC_NIBBLES}[(c & 15) + 1])"
    step = f"list_reduce([0, 1], {nibble}, xor(crc, byte))"
    codes = f"list_transform(string_split({digits}, ''), lambda ch: ascii(ch)::BIGINT)"
    return f"xor(list_reduce({codes}, lambda crc, byte: {step}, 4294967295::BIGINT), 4294967295::BIGINT)"


def runs_sql() -> str:
    """Runs of four periods and six words: equal stretches of five words at a distance, joined into islands."""
    return f"""
WITH texts AS (
  SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS original,
    {_crc32("doc_id::VARCHAR")} AS h
  FROM documents),
planned AS (
  SELECT *, len(original) AS n, h // 10 AS g, h % 10 = 0 AND len(original) > 0 AS plant, (h // 10) % greatest(len(original), 1) AS a FROM texts),
words AS (
  SELECT k, doc_id, n, CASE WHEN plant
    THEN list_transform(range(n), lambda i: original[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END])
    ELSE original END AS ws FROM planned),
placed AS (SELECT k, n, unnest(range(n)) AS i, unnest(ws) AS w FROM words),
fives AS (
  SELECT k, n, i, concat_ws(' ', w, lead(w, 1) OVER p, lead(w, 2) OVER p, lead(w, 3) OVER p, lead(w, 4) OVER p) AS five
  FROM placed WINDOW p AS (PARTITION BY k ORDER BY i) QUALIFY lead(w, 4) OVER p IS NOT NULL),
met AS (
  SELECT a.k, a.i, b.i - a.i AS q FROM fives a JOIN fives b ON a.k = b.k AND a.five = b.five AND b.i > a.i AND 4 * (b.i - a.i) <= a.n),
islands AS (
  SELECT k, q, min(i) AS s, max(i) + 5 + q AS e
  FROM (SELECT k, q, i, i - row_number() OVER (PARTITION BY k, q ORDER BY i) AS island FROM met) GROUP BY k, q, island),
runs AS (
  SELECT k, s, e - s AS length, min(q) AS q, e FROM islands WHERE e - s >= greatest(6, 4 * q) GROUP BY k, s, e),
told AS (
  SELECT k, count(*) AS n_runs, string_agg(concat(s, ',', length, ',', q, chr(10)), '' ORDER BY s, q) AS lines,
    arg_min(struct_pack(s := s, length := length, q := q), (-(length::DOUBLE / q), s, q)) AS best
  FROM runs GROUP BY k),
gone AS (SELECT DISTINCT k, unnest(range(s + q, e)) AS i FROM runs),
kept AS (SELECT k, string_agg(w, ' ' ORDER BY i) AS collapsed FROM placed ANTI JOIN gone USING (k, i) GROUP BY k)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.s::BIGINT AS start, best.length::BIGINT AS length, best.q::BIGINT AS period,
  (1000 * best.length // best.q)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM words LEFT JOIN told USING (k) LEFT JOIN kept USING (k)"""


def warc_sql() -> str:
    five = " + ".join(f"substr(bits, 5 * i + {j + 1}, 1)::INTEGER * {16 >> j}" for j in range(5))
    letters = f"list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + {five}, 1))"
    return f"""
WITH payloads AS (
  SELECT page_id, html, unhex(sha1(html))::BIT::VARCHAR AS bits, row_number() OVER same = 1 AS leads, first(page_id) OVER same AS first_id
  FROM (SELECT page_id, coalesce(html, '') AS html FROM pages) WINDOW same AS (PARTITION BY html ORDER BY page_id NULLS LAST))
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, array_to_string({letters}, '') AS payload_digest,
  CASE WHEN leads THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN NOT leads THEN first_id END AS refers_to
FROM payloads"""


def phrases_sql(min_count: int, contained_percent: int, top: int) -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    score = "(1000000::HUGEINT * a * a) // ({}::HUGEINT * {})"
    return f"""
WITH pieces AS (
  SELECT k, lang, unnest(ps) AS piece, unnest(range(len(ps))) AS pc
  FROM (SELECT row_number() OVER () AS k, coalesce(lang, 'und') AS lang,
          regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\\x0A-\\x0D]') AS ps FROM documents)),
placed AS (
  SELECT k, lang, pc, unnest(range(len(ws))) AS i, unnest(ws) AS w1
  FROM (SELECT k, lang, pc, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM pieces)),
grams AS (SELECT lang, w1, lead(w1) OVER p AS w2, lead(w1, 2) OVER p AS w3 FROM placed WINDOW p AS (PARTITION BY k, pc ORDER BY i)),
one AS (SELECT lang, w1 AS w, count(*) AS f FROM grams GROUP BY ALL),
two AS (SELECT lang, w1, w2, count(*) AS a FROM grams WHERE w2 IS NOT NULL GROUP BY ALL),
three AS (SELECT lang, w1, w2, w3, count(*) AS a FROM grams WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= {min_count}),
longer AS (
  SELECT lang, x, y, max(a) AS most
  FROM (SELECT lang, w1 AS x, w2 AS y, a FROM three UNION ALL SELECT lang, w2, w3, a FROM three) GROUP BY ALL),
scored AS (
  SELECT t.lang, concat(w1, ' ', w2) AS phrase, a, x.f AS l, y.f AS r, {score.format("x.f", "y.f")} AS score
  FROM two t JOIN one x ON x.lang = t.lang AND x.w = w1 JOIN one y ON y.lang = t.lang AND y.w = w2
    LEFT JOIN longer g ON g.lang = t.lang AND g.x = w1 AND g.y = w2
  WHERE a >= {min_count} AND (most IS NULL OR 100 * most < {contained_percent} * a)
  UNION ALL
  SELECT lang, phrase, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END, CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2)
  FROM (SELECT t.lang, concat(t.w1, ' ', t.w2, ' ', t.w3) AS phrase, t.a, x.f AS l1, yz.a AS r1, xy.a AS l2, z.f AS r2,
          {score.format("x.f", "yz.a").replace("a * a", "t.a * t.a")} AS s1, {score.format("xy.a", "z.f").replace("a * a", "t.a * t.a")} AS s2
        FROM three t JOIN one x ON x.lang = t.lang AND x.w = t.w1 JOIN one z ON z.lang = t.lang AND z.w = t.w3
          JOIN two xy ON xy.lang = t.lang AND xy.w1 = t.w1 AND xy.w2 = t.w2 JOIN two yz ON yz.lang = t.lang AND yz.w1 = t.w2 AND yz.w2 = t.w3)),
totals AS (SELECT lang, count(*) AS n FROM placed GROUP BY lang)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM scored) JOIN totals USING (lang)
WHERE rank <= {top}"""

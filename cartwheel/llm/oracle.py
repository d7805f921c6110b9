"""The text queries that DuckDB's SQL can express."""

from __future__ import annotations

from cartwheel.llm import shares, variants

SPACE = r"\x20\x09-\x0D"


def crc_table() -> list[int]:
    """The table of the usual crc32, one entry for each byte."""
    table = []
    for byte in range(256):
        for _ in range(8):
            byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
        table.append(byte)
    return table


def crc32(text: str) -> str:
    """crc32 of the UTF-8 bytes of a text."""
    data = f"hex(encode({text}))"
    bytes_of = f"list_transform(range(CAST(length({data}) // 2 AS BIGINT)), lambda i: CAST('0x' || substr({data}, 2 * i + 1, 2) AS BIGINT))"
    step = f"xor(c >> 8, (CAST({crc_table()} AS BIGINT[]))[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce({bytes_of}, lambda c, b: {step}, 4294967295::BIGINT), 4294967295::BIGINT)"


# Conversation repair: a forward search over turns; a state's value is its cost in nine digits and its audit.


def plus(value: str, cost: str, letter: str) -> str:
    return f"(lpad(CAST(CAST(left({value}, 9) AS BIGINT) + {cost} AS VARCHAR), 9, '0') || substr({value}, 10) || '{letter}')"


def edited(to: list[str], kind: str) -> str:
    """Keeping a turn of that kind, or giving it a role, after one of these states."""
    kept = f"CASE WHEN stays AND kind = '{kind}' THEN {{}} END"
    given = "CASE WHEN stays THEN {} END"
    parts = [kept.format(plus(s, "extra", "K")) for s in to]
    return ", ".join(parts + ([given.format(plus(s, "extra + 3", "R")) for s in to] if kind != "s" else []))


OP11 = rf"""
WITH RECURSIVE named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations
), planted AS (SELECT *, {crc32("name")} % 20 AS h FROM named
), damaged AS (
  SELECT conv_id, turn, CASE h WHEN 4 THEN 'user' ELSE role END AS role,
         CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM planted, range(2) c(copy) WHERE h <> 0 AND (copy = 0 OR h = 3)
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged
), marked AS MATERIALIZED (
  SELECT *, substr(role, 1, 1) AS kind, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS kind_before,
         CASE WHEN NOT regexp_matches(text, '[^{SPACE}]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][{SPACE}]*$') THEN 'truncated' ELSE '' END AS fault FROM numbered
), counted AS MATERIALIZED (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE i > 1 AND kind_before || kind NOT IN ('su', 'ua', 'au')) AS illegal FROM marked GROUP BY conv_id
), steps AS (
  SELECT conv_id, 0::BIGINT AS i, '000000000' AS s0, NULL::VARCHAR AS s1, '000000003I' AS s2, '000000006II' AS s3 FROM counted
  UNION ALL
  SELECT conv_id, i, e0, e1, t2, least(e3, {plus("t2", "3", "I")}) FROM (
    SELECT *, least(e2, {plus("e0", "3", "I")}, {plus("e1", "3", "I")}, {plus("e3", "3", "I")}) AS t2 FROM (
      SELECT conv_id, i, {plus("s0", "4", "D")} AS e0, least({plus("s1", "4", "D")}, {edited(["s0"], "s")}) AS e1,
             least({plus("s2", "4", "D")}, {edited(["s0", "s1", "s3"], "u")}) AS e2,
             least({plus("s3", "4", "D")}, {edited(["s2"], "a")}) AS e3 FROM (
        SELECT s.conv_id, m.i, s0, s1, s2, s3, m.kind, m.fault IN ('', 'truncated') AS stays,
               CASE m.fault WHEN 'truncated' THEN 3 ELSE 0 END AS extra
          FROM steps s JOIN marked m ON m.conv_id IS NOT DISTINCT FROM s.conv_id AND m.i = s.i + 1) a) b) c
), plans AS MATERIALIZED (
  SELECT s.conv_id, CAST(left(least(s0, s3), 9) AS BIGINT) AS cost, substr(least(s0, s3), 10) AS audit
    FROM steps s JOIN counted c ON c.conv_id IS NOT DISTINCT FROM s.conv_id AND c.n = s.i
), walk AS (
  SELECT conv_id, audit, 0 AS k, 0::BIGINT AS i, 0 AS state, NULL::VARCHAR AS line FROM plans
  UNION ALL
  SELECT conv_id, audit, k, i, state, CASE letter WHEN 'K' THEN role || ':' || text
         WHEN 'R' THEN named || text WHEN 'I' THEN named END FROM (
    SELECT *, CASE state WHEN 2 THEN 'user:' ELSE 'assistant:' END AS named FROM (
      SELECT w.conv_id, w.audit, w.k + 1 AS k, w.letter, m.role, m.text, w.at AS i,
             CASE WHEN letter = 'D' THEN state WHEN letter = 'K' AND kind = 's' THEN 1 WHEN state = 2 THEN 3 ELSE 2 END AS state
        FROM (SELECT *, substr(audit, k + 1, 1) AS letter, i + CASE substr(audit, k + 1, 1) WHEN 'I' THEN 0 ELSE 1 END AS at
                FROM walk WHERE k < length(audit)) w
        LEFT JOIN marked m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.i = w.at) a) b
), repaired AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY k) AS lines FROM walk GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
       sha256(coalesce(lines, '')) AS repaired_sha256
  FROM (SELECT DISTINCT conv_id FROM conversations) o
  LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN plans p ON p.conv_id IS NOT DISTINCT FROM o.conv_id
  LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM o.conv_id
"""

# Source mixing: blocks in the order of the same permutations, taken one after another until the target is met.


def network(source: str, columns: str, x: str) -> str:
    """Rows of the source with `x` taken once through the network."""
    body = f"SELECT {columns}, {x} >> bits AS l, {x} & ((1::BIGINT << bits) - 1) AS r FROM {source}"
    p = shares.PRIME
    for i in range(shares.ROUNDS):
        body = f"SELECT {columns}, l, r, (r + key + {i}) % {p} * {shares.FACTOR} % {p} AS f FROM ({body})"
        body = f"SELECT {columns}, r AS l, xor(l, (f * f + key) % {p} & ((1::BIGINT << bits) - 1)) AS r FROM ({body})"
    return f"SELECT {columns}, (l << bits) | r AS x FROM ({body})"


PASS = "s, turn, pos, n, bits, key"
WIDTH = shares.BLOCK_WORDS
OP12 = rf"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, row_number() OVER () AS nr, CAST(len(regexp_extract_all(coalesce(text, ''), '[^{SPACE}]+')) AS BIGINT) AS size
    FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS total, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS s FROM sized GROUP BY source
), weighted AS (
  SELECT *, (CAST({list(shares.WEIGHTS)} AS DOUBLE[]))[s % {len(shares.WEIGHTS)} + 1] AS weight, {shares.REPEATS} * total::DOUBLE AS cap,
         {shares.SHARE}::DOUBLE * (SELECT sum(total) FROM sources)::DOUBLE AS wanted FROM sources
), levels AS (
  SELECT *, greatest(wanted - coalesce(sum(cap) OVER (ORDER BY cap / weight, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0)
         / sum(weight) OVER (ORDER BY cap / weight, s ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighted
), plans AS MATERIALIZED (
  SELECT source, s, total, target, CAST(floor(target + 0.5) AS BIGINT) AS words, (total + {WIDTH - 1}) // {WIDTH} AS n FROM (
    SELECT *, least(cap, (SELECT arg_min(level, cap / weight * 1e6 + s * 1e-9) FROM levels WHERE level * weight <= cap) * weight) AS target
      FROM levels) t
), passes AS (
  SELECT s, turn, pos, n, CASE WHEN n = 1 THEN 1 ELSE (length(bin(n - 1)) + 1) // 2 END AS bits,
         ({shares.SEED} * 1000003 + s * 7919 + turn * 104729) % {shares.PRIME} AS key
    FROM plans, range({shares.REPEATS + 1}) t(turn), range((SELECT max(n) FROM plans)) p(pos) WHERE pos < n
), walk AS (
  {network("passes", PASS, "pos")}
  UNION ALL
  {network("(SELECT * FROM walk WHERE x >= n)", PASS, "x")}
), drawn AS (
  SELECT s, x AS block, greatest(least(words - (sum(width) OVER (PARTITION BY s ORDER BY turn, pos) - width), width), 0) AS taken FROM (
    SELECT w.*, words, least(total - x * {WIDTH}, {WIDTH}) AS width FROM walk w JOIN plans USING (s) WHERE x < w.n) b
), placed AS (
  SELECT d.*, s, total, target, sum(size) OVER (PARTITION BY s ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|{shares.SEED}'), size, nr)
         - size AS first FROM sized d JOIN plans p ON p.source IS NOT DISTINCT FROM d.source
), met AS (
  SELECT nr, sum(greatest(least(first + size, block * {WIDTH} + taken) - greatest(first, block * {WIDTH}), 0)) AS taken
    FROM placed JOIN drawn ON drawn.s = placed.s AND block BETWEEN first // {WIDTH} AND (first + size - 1) // {WIDTH}
   WHERE size > 0 GROUP BY nr
)
SELECT doc_id, size, total AS source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken FROM placed LEFT JOIN met USING (nr)
"""

# Spelling variants: near words by the letters that are left when one is taken out.

LETTERS, COUNT = variants.MIN_LETTERS, variants.MIN_COUNT
OP13 = f"""
WITH RECURSIVE runs AS (
  SELECT id, word, count(*) AS n FROM (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, translate(unnest(regexp_extract_all(text, '{variants.RUN}{{{LETTERS},}}')),
           '{variants.CAPITALS}', '{variants.CAPITALS.lower()}') AS word FROM documents) a GROUP BY id, word
), numbered AS (SELECT *, {crc32("id || ':' || word")} AS h FROM runs
), words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN left(word, h % length(word)) || substr(word, h % length(word) + 2) ELSE word END AS word, n
      FROM numbered) a WHERE length(word) >= {LETTERS} GROUP BY word HAVING sum(n) >= {COUNT}
), holes AS MATERIALIZED (SELECT word, i, left(word, i) || substr(word, i + 2) AS hole FROM words, range((SELECT max(length(word)) FROM words)) r(i) WHERE i < length(word)
), near AS (
  SELECT a.word, b.word AS other FROM holes a JOIN holes b ON a.i = b.i AND a.hole = b.hole AND a.word <> b.word
  UNION SELECT word, hole FROM holes JOIN (SELECT word AS hole FROM words) USING (hole)
  UNION SELECT hole, word FROM holes JOIN (SELECT word AS hole FROM words) USING (hole)
), best AS (
  SELECT * FROM (SELECT r.word, other, w.n AS m, count(*) OVER (PARTITION BY r.word) AS n_near,
                        row_number() OVER (PARTITION BY r.word ORDER BY w.n DESC, other) AS nr
                   FROM near r JOIN words w ON w.word = other) a WHERE nr = 1
), formed AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= {variants.RATIO} * n THEN other END AS form,
         CASE WHEN m >= {variants.RATIO} * n THEN m END AS form_n FROM words w LEFT JOIN best USING (word)
), steps AS (
  SELECT word, word AS root FROM words
  UNION ALL SELECT s.word, f.form FROM steps s JOIN formed f ON f.word = s.root WHERE f.form IS NOT NULL
), roots AS (SELECT s.word, s.root FROM steps s JOIN formed f ON f.word = s.root WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN roots USING (word)
"""

ORACLE = {
    "op8_exact_dedup": r"""
        WITH n AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
        ), g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM n JOIN g USING (t)
    """,
    "op11_repair": OP11,
    "op12_mix": OP12,
    "op13_variants": OP13,
}

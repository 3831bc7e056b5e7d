"""SQL twins, for DuckDB, of the text queries that SQL can express on whole tables."""

from __future__ import annotations

_SPACE = r"[\x20\x09-\x0D]+"


def _words(text: str) -> str:
    return f"[x FOR x IN regexp_split_to_array({text}, '{_SPACE}') IF x <> '']"


def _crc32(blob: str) -> str:
    """Unsigned crc32 of a blob, by a table of the 256 one-byte remainders (CTE ``crc``)."""
    digits = f"lower(hex({blob}))"
    byte = f"('0x' || substr({digits}, 2 * i - 1, 2))::BIGINT"
    step = "lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])"
    taken = f"[{byte} FOR i IN range(1, octet_length({blob}) + 1)]"
    return f"xor(list_reduce({taken}, {step}, 4294967295::BIGINT), 4294967295)"


_CRC = """crc AS (
  SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1
    THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS t
  FROM (SELECT unnest(range(256)) AS b)
)"""

# op4: windows of 20 words, all but the first place of each are duplicates.
LEMPEL_ZIV = f"""
WITH docs AS (
  SELECT doc_id, {_words("coalesce(text, '')")} AS words FROM documents
), windows AS (
  SELECT doc_id, start, array_to_string(words[start:start + 19], ' ') AS run
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS start FROM docs)
), repeated AS (
  SELECT doc_id, start FROM windows
  QUALIFY row_number() OVER (PARTITION BY run ORDER BY doc_id, start) > 1
), gone AS (
  SELECT DISTINCT doc_id, start + k AS pos FROM repeated, range(20) steps(k)
), placed AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM docs
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS left_over
  FROM placed ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words,
  CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(left_over, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

# op5: an equal line, or from 8 words on one up to a word put in, left out or replaced, stands earlier.
LINE_DEDUP = f"""
WITH cut AS (
  SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL
), lines AS (
  SELECT doc_id, k, line, words, len(words) AS n FROM (
    SELECT doc_id, k, line,
      {_words("line")} AS words
    FROM (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS k FROM cut))
), variants AS (
  SELECT doc_id, k, gap, words[:gap - 1] || words[gap + 1:] AS key
  FROM (SELECT *, unnest(range(1, n + 1)) AS gap FROM lines WHERE n >= 8)
), dropped AS (
  SELECT doc_id, k FROM (
    SELECT doc_id, k, row_number() OVER (PARTITION BY words ORDER BY doc_id, k) AS nth
    FROM lines WHERE n >= 1) WHERE nth > 1
  UNION
  SELECT doc_id, k FROM (
    SELECT doc_id, k, row_number() OVER (PARTITION BY key, gap ORDER BY doc_id, k) AS nth
    FROM variants) WHERE nth > 1
  UNION
  SELECT v.doc_id, v.k FROM variants v JOIN lines w ON w.words = v.key
  WHERE w.n >= 8 AND (w.doc_id < v.doc_id OR w.doc_id = v.doc_id AND w.k < v.k)
  UNION
  SELECT w.doc_id, w.k FROM variants v JOIN lines w ON w.words = v.key
  WHERE w.n >= 8 AND (v.doc_id < w.doc_id OR v.doc_id = w.doc_id AND v.k < w.k)
), kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY k) AS left_over
  FROM lines ANTI JOIN dropped USING (doc_id, k) GROUP BY doc_id
), touched AS (
  SELECT DISTINCT doc_id FROM dropped
)
SELECT d.doc_id, CASE WHEN t.doc_id IS NULL THEN text ELSE coalesce(left_over, '') END AS text,
  lang, source,
  CASE WHEN t.doc_id IS NULL THEN n_chars ELSE length(coalesce(left_over, '')) END AS n_chars
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id LEFT JOIN touched t ON d.doc_id = t.doc_id
"""

# op7: item-sized windows where a shared shingle puts the item, compared by five-word shingles.
DECONTAMINATION = f"""
WITH docs AS (
  SELECT doc_id, words, len(words) AS size FROM (
    SELECT doc_id, {_words("lower(coalesce(text, ''))")} AS words FROM documents)
), items AS (
  SELECT item_id, words, len(words) AS n FROM (
    SELECT item_id, {_words("lower(coalesce(text, ''))")} AS words FROM benchmark)
  WHERE len(words) > 0
), item_shingles AS (
  SELECT item_id, n, place, array_to_string(words[place:place + 4], ' ') AS shingle
  FROM (SELECT *, unnest(range(1, greatest(n - 4, 1) + 1)) AS place FROM items)
), doc_shingles AS (
  SELECT doc_id, size, begin_at, array_to_string(words[begin_at:begin_at + 4], ' ') AS shingle
  FROM (SELECT *, unnest(range(1, greatest(size - 4, 1) + 1)) AS begin_at FROM docs WHERE size > 0)
), starts AS (
  SELECT DISTINCT doc_id, n, least(greatest(begin_at - place, 0), greatest(size - n, 0)) AS start
  FROM doc_shingles JOIN item_shingles USING (shingle)
), windows AS (
  SELECT s.doc_id, s.n, s.start, words[s.start + 1:s.start + s.n] AS words
  FROM starts s JOIN docs d ON s.doc_id = d.doc_id
), in_window AS (
  SELECT doc_id, n, start, array_to_string(words[p:p + 4], ' ') AS shingle, count(*) AS times
  FROM (SELECT *, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS p FROM windows) GROUP BY ALL
), in_item AS (
  SELECT item_id, n, shingle, count(*) AS times FROM item_shingles GROUP BY ALL
), both_have AS (
  SELECT w.doc_id, w.n, w.start, i.item_id, sum(least(w.times, i.times)) AS shared
  FROM in_window w JOIN in_item i ON w.n = i.n AND w.shingle = i.shingle GROUP BY ALL
), compared AS (
  SELECT b.doc_id, b.item_id, b.start, b.shared,
    greatest(len(w.words) - 4, 1) + greatest(b.n - 4, 1) - b.shared AS either
  FROM both_have b JOIN windows w ON b.doc_id = w.doc_id AND b.n = w.n AND b.start = w.start
)
SELECT doc_id, item_id, CAST(start AS INTEGER) AS start,
  CAST(shared AS DOUBLE) / CAST(either AS DOUBLE) AS similarity
FROM compared WHERE 100 * shared >= 75 * either
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id
  ORDER BY CAST(shared AS DOUBLE) / CAST(either AS DOUBLE) DESC, start) = 1
"""

# op8: all pairs that share a shingle, then everything reachable.
JACCARD_JOIN = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, {_words(
    "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
  )} AS words FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[p:p + 4], ' ') AS shingle
  FROM (SELECT *, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS p FROM docs WHERE len(words) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS inter
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
  WHERE 100 * inter >= 75 * (a.n + b.n - inter)
), steps AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM docs
  UNION
  SELECT r.doc_id, s.y FROM reached r JOIN steps s ON r.other = s.x
), components AS (
  SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM components LEFT JOIN sizes USING (doc_id)
"""


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


def _tree(name: str, leaves: str) -> str:
    """All nodes of ternary trees over ``leaves`` (part, idx, h, n)."""
    return f"""{name}(part, level, idx, h, n) AS (
  SELECT part, 0, idx, h, n FROM {leaves}
  UNION ALL
  SELECT part, level + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), (n + 2) // 3
  FROM {name} WHERE n > 1 GROUP BY part, level, idx // 3, n
)"""


# op11: all levels of all trees, siblings by their places, one fold step after the other.
MERKLE = f"""
WITH RECURSIVE {_CRC}, read AS (
  SELECT doc_id, source, {_leaf("text")} AS leaf,
    CASE WHEN {_crc32("CAST(CAST(doc_id AS VARCHAR) AS BLOB)")} % 2 = 0
      THEN {_leaf("replace(text, chr(10), '')")} END AS changed
  FROM documents, crc
), sources AS (
  SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS part
  FROM (SELECT DISTINCT source FROM documents)
), leaves AS (
  SELECT row_number() OVER () AS rid, part, doc_id, leaf AS h, coalesce(changed, leaf) AS shown,
    row_number() OVER (PARTITION BY part ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY part) AS n
  FROM read JOIN sources ON read.source IS NOT DISTINCT FROM sources.source
), {_tree("low", "leaves")}, subroots AS (
  SELECT 0 AS part, part AS idx, h, count(*) OVER () AS n FROM low WHERE low.n = 1
), {_tree("high", "subroots")}, nodes AS (
  SELECT 0 AS tier, * FROM low UNION ALL SELECT 1, * FROM high
), climbed AS (
  SELECT rid, tier, level, own.idx, own.part, own.n FROM (
    SELECT rid, 0 AS tier, part, unnest(range(40)) AS level, idx // pow(3, level)::BIGINT AS idx
    FROM leaves
    UNION ALL
    SELECT rid, 1, 0, unnest(range(40)) AS level, part // pow(3, level)::BIGINT FROM leaves) AS own_place
  JOIN nodes own USING (tier, part, level, idx) WHERE own.n > 1
), steps AS (
  SELECT c.rid, row_number() OVER (PARTITION BY c.rid ORDER BY c.tier, c.level) AS step,
    coalesce(string_agg(s.h, '' ORDER BY s.idx) FILTER (s.idx < c.idx), '') AS head,
    coalesce(string_agg(s.h, '' ORDER BY s.idx) FILTER (s.idx > c.idx), '') AS rest
  FROM climbed c JOIN nodes s
    ON s.tier = c.tier AND s.part = c.part AND s.level = c.level AND s.idx // 3 = c.idx // 3
  GROUP BY c.rid, c.tier, c.level, c.idx
), folded(rid, step, h) AS (
  SELECT rid, 0, shown FROM leaves
  UNION ALL
  SELECT f.rid, f.step + 1, sha256(head || f.h || rest)
  FROM folded f JOIN steps s ON s.rid = f.rid AND s.step = f.step + 1
), proved AS (
  SELECT rid, sha256(string_agg(head || rest, '' ORDER BY step)) AS proof FROM steps GROUP BY rid
), ended AS (
  SELECT rid, arg_max(h, step) AS h FROM folded GROUP BY rid
)
SELECT l.doc_id, source, l.idx AS place, l.h AS leaf, s.h AS subroot, r.h AS root,
  coalesce(proof, sha256('')) AS proof_sha256, e.h AS folded_root, e.h = r.h AS verified
FROM leaves l JOIN ended e USING (rid) LEFT JOIN proved USING (rid)
JOIN sources USING (part) JOIN subroots s ON s.idx = l.part
JOIN (SELECT h FROM high WHERE n = 1) r ON true
"""


def _share(count: str, total: str, terms: str) -> str:
    return f"1 + (CAST(1000000000 AS HUGEINT) * ({count} + 1)) // ({total} + {terms})"


# op12: every group's count of every kept term of its language, compared with every other group's.
DIVERGENCE = f"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM documents
), words AS (
  SELECT rid, lang, source, unnest(terms) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*) AS n, count(*) OVER (PARTITION BY lang) AS v
  FROM words GROUP BY lang, term HAVING count(DISTINCT rid) >= 3
), counted AS (
  SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL
), groups AS (
  SELECT g.lang, g.source, coalesce(sum(n), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN counted USING (lang, source) GROUP BY ALL
), langs AS (
  SELECT lang, sum(n) AS total FROM kept GROUP BY lang
), shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    {_share("coalesce(c.n, 0)", "g.total", "k.v")} AS p, {_share("k.n", "l.total", "k.v")} AS in_lang
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
  LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), compared AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN compared c ON c.lang = a.lang AND c.source = a.source AND c.item = b.source
), over AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - in_lang) * (p - in_lang) // in_lang AS value
  FROM shares WHERE n > 0 AND p > in_lang
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
  CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM (FROM pairs UNION ALL FROM over)
QUALIFY part = 'pair' OR rank <= 200
"""


def _dealing(name: str, slots: str, loads: str, of: str = "") -> str:
    """Slots (k from 1, size), one after the other, to the shard with the least load so far."""
    least = "list_position(loads, list_min(loads))"
    return f"""{name}(k, loads, shard) AS (
  SELECT 0::BIGINT, {loads}, 0::BIGINT {of}
  UNION ALL
  SELECT s.k, list_transform(loads, lambda load, i: CASE WHEN i = {least} THEN load + s.size ELSE load END),
    CAST({least} - 1 AS BIGINT)
  FROM {name} d JOIN {slots} s ON s.k = d.k + 1
)"""


# op13: the greedy dealing of slots as a recursion, one slot after the other.
SHARDING = f"""
WITH RECURSIVE {_CRC}, digits AS (
  SELECT row_number() OVER () AS rid, doc_id, lower(hex(encode(coalesce(text, '')))) AS hexed FROM documents
), bytes AS (
  SELECT rid, doc_id, [('0x' || d)::BIGINT FOR d IN regexp_extract_all(hexed, '..')] AS taken FROM digits
), read AS (
  SELECT rid, doc_id, len(taken) + 8 AS size, xor(list_reduce(taken,
    lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS text_crc32
  FROM bytes, crc
), slotted AS (
  SELECT *, CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '-') || '/' || text_crc32), 1, 13))::BIGINT
    % 8192 AS INTEGER) AS virtual_slot
  FROM read
), slots AS (
  SELECT virtual_slot, CAST(sum(size) AS BIGINT) AS size, count(*) AS n FROM slotted GROUP BY ALL
), sorted AS (
  SELECT *, row_number() OVER (ORDER BY size DESC, virtual_slot) AS k FROM slots
), {_dealing("dealt", "sorted", "[0::BIGINT FOR i IN range(24)]")}, first_map AS (
  SELECT virtual_slot, size, n, shard FROM sorted JOIN dealt USING (k)
), judged AS (
  SELECT *, (sum(size) FILTER (NOT large) OVER ())::DOUBLE
      / greatest(25 - count(*) FILTER (large) OVER (), 1) AS share, sum(size) OVER (PARTITION BY shard) AS load,
    sum(size) OVER (PARTITION BY shard ORDER BY size, virtual_slot) AS given
  FROM (SELECT *, size * 25 > sum(size) OVER () AS large FROM first_map)
), moving AS (
  SELECT virtual_slot, size, row_number() OVER (ORDER BY size DESC, virtual_slot) AS k
  FROM judged WHERE given <= load - share
), held AS (
  SELECT list(coalesce(load, 0)::BIGINT ORDER BY shard) AS loads
  FROM (SELECT unnest(range(25)) AS shard) LEFT JOIN (
    SELECT shard, sum(size) AS load FROM judged WHERE given > load - share GROUP BY shard) USING (shard)
), {_dealing("moved", "moving", "loads", "FROM held")}, next_map AS (
  SELECT virtual_slot, m.shard AS next_shard FROM moving JOIN moved m USING (k)
), placed AS (
  SELECT *, coalesce(sum(n) OVER (PARTITION BY shard ORDER BY virtual_slot
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first_place
  FROM first_map
)
SELECT doc_id, r.size, text_crc32, 'bytes' AS law, CAST(shard AS INTEGER) AS shard,
  CAST(first_place + row_number() OVER (PARTITION BY virtual_slot ORDER BY doc_id NULLS FIRST, text_crc32, r.size)
    - 1 AS BIGINT) AS slot,
  CAST(NULL AS INTEGER) AS grown_shard, virtual_slot,
  CAST(coalesce(next_shard, shard) AS INTEGER) AS next_shard
FROM slotted r JOIN placed p USING (virtual_slot) LEFT JOIN next_map USING (virtual_slot)
"""

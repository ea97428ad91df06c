"""DuckDB statements for the text queries that SQL can express."""

from __future__ import annotations

from orderwake.llm.quality_rules import LEAST_SPREAD

SPACES = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP3 = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, {SPACES}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT k.*, coalesce(k.doc_id < s.keeper, false) AS gone FROM keyed k LEFT JOIN shared s USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def _op6() -> str:
    rated = ", ".join(f"('{m}', {value})" for m, value in (
        ("symbols", "1000 * n_symbols // nullif(n_words, 0)"),
        ("dup_lines", "1000 * n_dup_lines // nullif(n_lines, 0)"),
        ("repeat_words", "1000 * n_repeat_words // nullif(n_words, 0)"),
        ("word_length", "1000 * word_chars // nullif(n_words, 0)"),
    ))
    least = ", ".join(f"('{m}', {spread}, {str(both).lower()})" for m, (spread, both) in LEAST_SPREAD.items())
    flags = ", ".join(f"bool_or(measure = '{m}' AND high) AS high_{m}" for m in LEAST_SPREAD)
    flags += ", " + ", ".join(f"bool_or(measure = '{m}' AND low) AS low_{m}" for m, (_, both) in LEAST_SPREAD.items() if both)
    names = [f"high_{m}" for m in LEAST_SPREAD] + [f"low_{m}" for m, (_, both) in LEAST_SPREAD.items() if both]
    return f"""
WITH words AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x, {SPACES}) <> '') AS lines
  FROM documents
), windows AS (
  SELECT doc_id, unnest(range(1, len(words) - 1)) AS pos, words FROM words WHERE len(words) >= 3
), named AS (
  SELECT doc_id, pos, [words[pos], words[pos + 1], words[pos + 2]] AS w FROM windows
), repeated AS (
  SELECT doc_id, unnest([pos, pos + 1, pos + 2]) AS place
  FROM (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, w) AS n FROM named) WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT place) AS n FROM repeated GROUP BY doc_id
), measured AS (
  SELECT w.doc_id, lang, source, len(words) AS n_words,
    coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(c.n, 0) AS n_repeat_words
  FROM words w LEFT JOIN covered c USING (doc_id)
), rated AS (
  SELECT m.doc_id, m.lang, m.source, r.col0 AS measure, r.col1 AS value
  FROM measured m, LATERAL (VALUES {rated}) r
), bins AS (
  SELECT lang, source, measure, value - value % (1 << greatest(length(bin(value)) - 6, 0))::BIGINT AS bin, count(*) AS n
  FROM rated WHERE value IS NOT NULL GROUP BY ALL
), ranked AS (
  SELECT *, sum(n) OVER (PARTITION BY lang, source, measure ORDER BY bin) AS upto,
    sum(n) OVER (PARTITION BY lang, source, measure) AS total
  FROM bins
), quartiles AS (
  SELECT lang, source, measure, min(bin) FILTER (WHERE 4 * upto >= total) AS q1,
    min(bin) FILTER (WHERE 4 * upto >= 3 * total) AS q3
  FROM ranked GROUP BY ALL
), judged AS (
  SELECT r.doc_id, r.measure,
    coalesce(r.value > q.q3 + 3 * greatest(q.q3 - q.q1, l.col1), false) AS high,
    coalesce(l.col2 AND r.value < q.q1 - 3 * greatest(q.q3 - q.q1, l.col1), false) AS low
  FROM rated r JOIN (VALUES {least}) l ON l.col0 = r.measure
  LEFT JOIN quartiles q ON q.lang IS NOT DISTINCT FROM r.lang AND q.source IS NOT DISTINCT FROM r.source AND q.measure = r.measure
), flagged AS (
  SELECT doc_id, {flags} FROM judged GROUP BY doc_id
), base AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured
)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT ({" OR ".join(names)}) AS kept, {", ".join(names)}
FROM base b JOIN flagged f USING (doc_id)
"""


#: A window is named by its words joined with a space, since no word holds one.
OP7 = """
WITH texts AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), windows AS (
  SELECT row, doc_id, place, array_to_string(words[place:place + 12], ' ') AS shown
  FROM (SELECT row, doc_id, words, unnest(range(1, len(words) - 11)) AS place FROM texts WHERE len(words) >= 13)
), ranked AS (
  SELECT row, place, doc_id IS NULL AS unnamed, doc_id, min(doc_id) OVER (PARTITION BY shown) AS least FROM windows
), covered AS (
  SELECT DISTINCT row, unnest(range(place, place + 13)) AS place FROM ranked
  WHERE least < doc_id OR (unnamed AND least IS NOT NULL)
), kept AS (
  SELECT t.row, list(t.word ORDER BY t.place) AS words, count(*) AS n
  FROM (SELECT row, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM texts) t
  ANTI JOIN covered c ON c.row = t.row AND c.place = t.place
  GROUP BY t.row
)
SELECT doc_id, len(t.words) AS n_words, len(t.words) - coalesce(k.n, 0) AS n_removed,
  sha256(coalesce(array_to_string(k.words, ' '), '')) AS kept_sha256
FROM texts t LEFT JOIN kept k USING (row)
"""


def _checksum(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes, by the table of remainders of all bytes."""
    remainders = []
    for byte in range(256):
        for _ in range(8):
            byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
        remainders.append(byte)
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda pair: ('0x' || pair)::BIGINT)"
    step = f"xor(({remainders}::BIGINT[])[(xor(sum, octet) & 255) + 1], sum >> 8)"
    return f"xor(list_reduce({octets}, lambda sum, octet: {step}, 4294967295::BIGINT), 4294967295)"


#: The generator's state is advanced by 128-bit arithmetic; a row of `jumps` is one move of a document's key.
OP11 = f"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS row, doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size,
    coalesce(text, '') AS text,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 16))::UBIGINT::UHUGEINT AS state
  FROM documents
), jumps AS (
  SELECT row, state, 0::BIGINT AS here FROM docs
  UNION ALL
  SELECT row, drawn, floor((here + 1) * (2147483648.0::DOUBLE / ((drawn // 8589934592)::DOUBLE + 1)))::BIGINT
  FROM (SELECT row, here, (state * 2862933555777941757 + 1) % 18446744073709551616::UHUGEINT AS drawn FROM jumps WHERE here < 17)
), placed AS (
  SELECT row, max(here) FILTER (WHERE here < 16)::INT AS shard, max(here) FILTER (WHERE here < 17)::INT AS grown_shard
  FROM jumps GROUP BY row
), bytes AS (
  SELECT row, doc_id, size, text FROM docs
), summed AS (
  SELECT *, {_checksum('text')} AS text_crc32 FROM bytes
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, grown_shard
FROM summed JOIN placed USING (row)
"""

OP13 = """
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
  FROM documents
), drawn AS (
  SELECT *, len(units) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
    ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM units
), cut AS (
  SELECT doc_id, text, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b, units,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
      WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), parts AS (
  SELECT doc_id, text, n, form, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
    array_to_string(units[b + 1:n], '') AS suffix
  FROM cut
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""


def _framed(columns: list[str]) -> str:
    """Digest of values, each with its number of bytes."""
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}, '-')" for c in columns) + ")"


def _tree(name: str, leaves: str) -> str:
    """All nodes of the trees over `leaves` (grp, place, digest, n), with their level."""
    return f"""{name} AS (
  SELECT 0 AS level, grp, place, digest, n FROM {leaves}
  UNION ALL
  SELECT level + 1, grp, place // 3, sha256(string_agg(digest, '' ORDER BY place)), (n + 2) // 3
  FROM {name} WHERE n > 1 GROUP BY level, grp, place // 3, n
)"""


def _steps(name: str, tree: str) -> str:
    """The joined siblings left and right of a leaf's ancestors below the root, level by level."""
    return f"""{name} AS (
  SELECT l.grp, l.place, a.level,
    coalesce(string_agg(s.digest, '' ORDER BY s.place) FILTER (WHERE s.place < a.place), '') AS lefts,
    coalesce(string_agg(s.digest, '' ORDER BY s.place) FILTER (WHERE s.place > a.place), '') AS rights
  FROM (SELECT grp, place FROM {tree} WHERE level = 0) l
  JOIN {tree} a ON a.grp = l.grp AND a.n > 1 AND a.place = l.place // (3 ** a.level)::BIGINT
  JOIN {tree} s ON s.grp = a.grp AND s.level = a.level AND s.place // 3 = a.place // 3
  GROUP BY ALL
)"""


def _op12() -> str:
    leaf = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = [*leaf[:-1], "replace(text, chr(10), '')"]
    return f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS grp, {_framed(leaf)} AS digest,
    {_framed(tampered)} AS changed
  FROM documents
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, digest) - 1 AS place,
    count(*) OVER (PARTITION BY grp) AS n
  FROM leaves
), {_tree("low", "numbered")}, subroots AS (
  SELECT 0 AS grp, grp AS place, digest, count(*) OVER () AS n FROM low WHERE n = 1
), {_tree("high", "subroots")}, {_steps("low_steps", "low")}, {_steps("high_steps", "high")}, steps AS (
  SELECT grp, place, level, lefts, rights FROM low_steps
  UNION ALL
  SELECT l.grp, l.place, 1000 + h.level, h.lefts, h.rights FROM numbered l JOIN high_steps h ON h.place = l.grp
), proofs AS (
  SELECT grp, place, sha256(string_agg(lefts || rights, '' ORDER BY level)) AS proof_sha256,
    list([lefts, rights] ORDER BY level) AS steps
  FROM steps GROUP BY grp, place
), folds AS (
  SELECT grp, place, 1 AS next, steps, CASE WHEN {_checksum('doc_id::VARCHAR')} % 2 = 0 THEN changed ELSE digest END AS digest
  FROM numbered LEFT JOIN proofs USING (grp, place)
  UNION ALL
  SELECT grp, place, next + 1, steps, sha256(steps[next][1] || digest || steps[next][2]) FROM folds WHERE next <= len(steps)
), ends AS (
  SELECT grp, place, last(digest ORDER BY next) AS folded_root FROM folds GROUP BY grp, place
)
SELECT d.doc_id, d.digest AS leaf, s.digest AS subroot, r.digest AS root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256,
  e.folded_root, e.folded_root = r.digest AS verified
FROM numbered d JOIN subroots s ON s.place = d.grp JOIN (SELECT digest FROM high WHERE n = 1) r ON true
JOIN ends e ON e.grp = d.grp AND e.place = d.place LEFT JOIN proofs p ON p.grp = d.grp AND p.place = d.place
"""


ORACLE: dict[str, str] = {
    "op3_line_dedup": OP3, "op6_quality_rules": _op6(), "op7_substring_dedup": OP7, "op11_sharding": OP11, "op12_manifest": _op12(), "op13_fill_in_middle": OP13
}

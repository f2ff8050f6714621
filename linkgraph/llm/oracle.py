"""DuckDB SQL for the queries that SQL can express.

Parameters are restated here, so that the SQL does not import what it checks.
"""

# Words: runs of characters other than space and U+0009 to U+000D.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP1 = """
WITH whole AS (
  SELECT vec_id, [floor(64 * x::DOUBLE) for x in embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x::DOUBLE)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 20
"""

# Water filling: by rising cap per weight, a source is capped while its cap is
# below its share of what is left. Schedules: weight 5 fades 1.5, 1, 0.5; 2 is
# flat; 1 rises 0.25, 1 (at 0.75), 2.5.
OP3 = f"""
WITH sized AS (
  SELECT doc_id, source, len({_WORDS})::BIGINT AS size,
         md5(concat_ws(':', coalesce(doc_id::VARCHAR, ''), md5(coalesce(text, '')))) AS ord FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INTEGER AS cls FROM sources),
weighed AS (SELECT *, [5, 2, 1][cls + 1]::BIGINT AS w, 3 * source_size AS cap FROM ranked),
filling AS (
  SELECT *, sum(w) OVER (ORDER BY cap::DOUBLE / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_left,
         (SELECT sum(source_size) FROM sources)
           - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS words_left
  FROM weighed),
capped AS (SELECT *, cap::HUGEINT * w_left < w::HUGEINT * words_left AS is_capped FROM filling),
rest AS (SELECT (SELECT sum(source_size) FROM sources) - coalesce(sum(cap) FILTER (is_capped), 0) AS words,
                coalesce(sum(w) FILTER (NOT is_capped), 1) AS w FROM capped),
aimed AS (SELECT c.source, c.source_size, c.cls,
                 CASE WHEN is_capped THEN cap::DOUBLE ELSE (c.w * rest.words)::DOUBLE / rest.w::DOUBLE END AS target FROM capped c, rest),
placed AS (SELECT s.doc_id, s.size, a.source_size, a.target, a.cls,
                  sum(s.size) OVER (PARTITION BY s.source ORDER BY s.ord ROWS UNBOUNDED PRECEDING) - s.size AS first_word
           FROM sized s JOIN aimed a ON s.source IS NOT DISTINCT FROM a.source),
taking AS (SELECT *, [greatest(0, least(ceil(target)::BIGINT - first_word - e * source_size, size))::BIGINT for e in [0, 1, 2]] AS words,
                  first_word::DOUBLE / target AS u FROM placed)
SELECT doc_id, size, source_size, target, list_sum(words)::BIGINT AS taken,
  CASE WHEN list_sum(words) = 0 THEN NULL ELSE round(CASE cls
    WHEN 0 THEN CASE WHEN u < 0.625 THEN 2 * u / (1.5 + sqrt(2.25 - 2 * u)) ELSE 0.5 + 2 * (u - 0.625) / (1 + sqrt(greatest(1 - 2 * (u - 0.625), 0))) END
    WHEN 1 THEN u
    ELSE CASE WHEN u < 15.0 / 29 THEN 2 * u / (0.25 * 32 / 29 + sqrt(pow(0.25 * 32 / 29, 2) + 2 * 32 / 29 * u))
              ELSE 0.75 + 2 * (u - 15.0 / 29) / (32.0 / 29 + sqrt(pow(32.0 / 29, 2) + 12 * 32.0 / 29 * (u - 15.0 / 29))) END
    END, 6) END AS first_t
FROM taking
"""

OP5 = f"""
WITH worded AS (SELECT doc_id, {_WORDS} AS words FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) AS w
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 48, 1)::BIGINT)) AS i FROM worded)),
firsts AS (SELECT w, min(doc_id) AS first_id FROM windows GROUP BY w HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, spot FROM (
  SELECT x.doc_id, unnest(range(x.i, x.i + 50)) AS spot FROM windows x JOIN firsts f ON x.w = f.w AND f.first_id < x.doc_id)),
lost AS (SELECT doc_id, list(spot) AS spot FROM gone GROUP BY doc_id),
kept AS (
  SELECT w.doc_id, len(words) AS n_words, coalesce(len(l.spot), 0) AS n_removed,
         CASE WHEN l.spot IS NULL THEN words ELSE [words[i] for i in range(1, len(words) + 1) if NOT list_contains(l.spot, i)] END AS words
  FROM worded w LEFT JOIN lost l ON w.doc_id = l.doc_id)
SELECT doc_id, n_words::BIGINT AS n_words, n_removed::BIGINT AS n_removed, sha256(array_to_string(words, ' ')) AS kept_sha256 FROM kept
"""

# Characters of a turn: its marks, its text, a backslash before each control
# string, and as many more as it has backslashes.
OP7 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 7 WHEN 'system' THEN 15 ELSE 26 + len(role) END + len(text)
    + len(regexp_extract_all(text, '\[INST\]|\[/INST\]|<s>|</s>|<<SYS>>|<</SYS>>|<<ROLE>>|<</ROLE>>'))
    + len(text) - len(replace(text, '\', '')) AS chars FROM turns)
SELECT conv_id::BIGINT AS conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(len(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

OP8 = r"""
WITH split AS (SELECT doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents),
spots AS (SELECT doc_id, source, unnest(lines) AS line, unnest(range(0, len(lines))) AS pos FROM split),
common AS (
  SELECT line, min({'d': doc_id, 'p': pos}) AS first FROM spots WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
  GROUP BY line HAVING count(DISTINCT source) >= 8),
gone AS (
  SELECT s.doc_id, list(s.pos) AS spot FROM spots s JOIN common c ON s.line = c.line
  WHERE {'d': s.doc_id, 'p': s.pos} <> c.first GROUP BY s.doc_id)
SELECT s.doc_id, coalesce(len(lines), 0)::BIGINT AS n_lines, coalesce(len(g.spot), 0)::BIGINT AS n_removed,
  sha256(CASE WHEN g.spot IS NULL THEN coalesce(text, '') ELSE coalesce(array_to_string(
    [lines[i + 1] for i in range(0, len(lines)) if NOT list_contains(g.spot, i)], chr(10)), '') END) AS kept_sha256
FROM split s LEFT JOIN gone g ON s.doc_id = g.doc_id
"""

OP9 = """
WITH sized AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
first AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM sized)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM first
"""

# Terms: letters, digits and characters past U+007F, only A-Z lower-cased.
_TERMS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

# CRC-32 of a word's bytes, from its table of 256 remainders.
OP11 = f"""
WITH remainders AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS rest
  FROM (SELECT unnest(range(256)) AS i)),
worded AS (SELECT doc_id, {_TERMS} AS words FROM documents),
spoken AS (SELECT unnest(words) AS word, 1 AS s, 0 AS t FROM worded UNION ALL SELECT unnest({_TERMS}), 0, 1 FROM benchmark),
bytes AS (
  SELECT word, s, t, [('0x' || substr(h, 2 * i + 1, 2))::BIGINT for i in range(len(h) // 2)] AS b
  FROM (SELECT word, sum(s) AS s, sum(t) AS t, hex(word) AS h FROM spoken GROUP BY word)),
hashed AS (
  SELECT word, s, t, xor(list_reduce(b, lambda c, x: xor(c >> 8, r.rest[(xor(c, x) & 255) + 1]), 4294967295::BIGINT), 4294967295) % 10000 AS bucket
  FROM bytes, remainders r),
totals AS (SELECT sum(s)::DOUBLE AS s_all, sum(t)::DOUBLE AS t_all FROM spoken),
buckets AS (SELECT bucket, sum(s)::DOUBLE AS s, sum(t)::DOUBLE AS t FROM hashed GROUP BY bucket),
gained AS (SELECT bucket, floor(1000 * ln((t + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000))))::BIGINT AS gain FROM buckets, totals),
weighed AS (
  SELECT doc_id, sum(gain)::BIGINT AS weight FROM (SELECT doc_id, unnest(words) AS word FROM worded) w
  JOIN hashed USING (word) JOIN gained USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT d.doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM worded d LEFT JOIN weighed USING (doc_id)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
         (SELECT 10 * count(*) // 100 FROM scored WHERE n_features >= 20) AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= n THEN place END AS rank FROM ranked
"""

OP12 = f"""
WITH worded AS (SELECT doc_id, {_TERMS} AS words FROM documents),
sized AS (SELECT doc_id, len(words)::BIGINT AS n FROM worded WHERE len(words) > 0),
totals AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM sized),
asked AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
held AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(words) AS term FROM worded) GROUP BY ALL),
weighed AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
            FROM (SELECT term, count(*) AS df FROM held WHERE term IN (SELECT term FROM asked) GROUP BY term), totals),
factors AS (SELECT doc_id, 100 - 25 + ((25 * n * n_docs) // n_terms) AS m FROM sized, totals),
scored AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM asked JOIN weighed USING (term) JOIN held USING (term) JOIN factors USING (doc_id) GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 20
"""

# The 128 smallest distinct hashes of the text's 5-word runs.
_LOWEST = ("list_sort(list_distinct([substr(md5(concat_ws(' ', z[1], z[2], z[3], z[4], z[5])), 1, 16) for z in "
           "list_zip(words, words[2:], words[3:], words[4:], words[5:])[1:greatest(len(words) - 4, 1)]]))[1:128]")
OP13 = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
following AS (
  SELECT *, len(text)::BIGINT AS n_chars, coalesce(lead(text) OVER (ORDER BY doc_id), first_value(text) OVER (ORDER BY doc_id)) AS next FROM texts),
changed AS (
  SELECT *, left(text, n_chars - n_chars // 4) || left(next, n_chars // 4) AS edited FROM following),
kinds AS (SELECT doc_id, 'own' AS kind, text FROM changed UNION ALL SELECT doc_id, 'edited', edited FROM changed UNION ALL SELECT doc_id, 'next', next FROM changed),
sketched AS (SELECT doc_id, kind, {_LOWEST} AS s FROM (SELECT doc_id, kind, {_WORDS} AS words FROM kinds)),
sketches AS (SELECT doc_id, first(s) FILTER (kind = 'own') AS own, first(s) FILTER (kind = 'edited') AS edited, first(s) FILTER (kind = 'next') AS following
             FROM sketched GROUP BY doc_id),
unions AS (SELECT *, list_sort(list_distinct(own || edited))[1:128] AS u, list_sort(list_distinct(own || following))[1:128] AS v FROM sketches)
SELECT c.doc_id, n_chars, sha256(c.edited) AS edited_sha256, array_to_string(own, '') AS fingerprint, array_to_string(z.edited, '') AS edited_fingerprint,
  CASE WHEN len(u) = 0 THEN 1 ELSE len(list_intersect(list_intersect(u, own), z.edited))::DOUBLE / len(u) END AS near_edited,
  CASE WHEN len(v) = 0 THEN 1 ELSE len(list_intersect(list_intersect(v, own), following))::DOUBLE / len(v) END AS near_next,
  CASE WHEN len(list_intersect(u, own)) = 0 THEN 1 ELSE
    len(list_intersect(list_intersect(u, own), z.edited))::DOUBLE / len(list_intersect(u, own)) END AS in_edited,
  round(CASE WHEN len(own) < 128 THEN len(own)::DOUBLE ELSE 127 * pow(2::DOUBLE, 64) / ('0x' || own[128])::UBIGINT::DOUBLE END, 3) AS distinct_shingles
FROM changed c JOIN unions z USING (doc_id)
"""

ORACLE = {"op1_topk_search": OP1, "op3_source_mix": OP3, "op5_substring_dedup": OP5, "op7_chat_format": OP7,
          "op8_line_dedup": OP8, "op9_warc": OP9, "op11_importance_resampling": OP11, "op12_ranked_search": OP12,
          "op13_fingerprints": OP13}

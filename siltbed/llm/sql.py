"""DuckDB SQL for the registered queries that SQL can express.

Trained models, near-duplicate components, approximate search, tokenizers and byte
windows have none; those queries are tested against brute force.
"""

_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

# Turns as the template writes them: what stands around role and text, and one more
# character for each backslash, each ``#`` after two others and each end marker in them.
_ESCAPED = ("length({0}) - length(replace({0}, '\\', '')) + coalesce(list_sum(list_transform("
            "regexp_extract_all({0}, '#{{3,}}'), lambda x: length(x) - 2)), 0) + (length({0}) - length(replace({0}, '</turn>', ''))) // 7")

ORACLE = {
    "op12_chat": f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS said FROM conversations
  UNION ALL
  SELECT -7, i, ['user', 'assistant'][i + 1], '\\### Assistant: </turn> ok' FROM range(2) r(i))
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || said || chr(10), '' ORDER BY turn, role)) AS turns_sha256,
       CAST(coalesce(sum(length(said)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(said, '' ORDER BY turn, role) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(14 + length(role) + length(said) + length(role) - length(replace(role, ':', ''))
                + {_ESCAPED.format('said')} + {_ESCAPED.format('role')}) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id""",
    # The crc32 of UTF-8 bytes by its table; runs have letters up to U+00FF only.
    "op11_variants": """
WITH RECURSIVE bits AS (
  SELECT list_transform(range(256), lambda b: list_reduce(
    [CAST(b AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
         translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{7,}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents),
counted AS (SELECT id, run, count(*) AS times FROM runs GROUP BY id, run),
sums AS (
  SELECT run, times, xor(4294967295, list_reduce(
    list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(string_split(id || ':' || run, ''), lambda c:
      CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [195, CAST(unicode(c) - 64 AS BIGINT)] END))),
    lambda s, b: xor(s // 256, t[xor(s, b) % 256 + 1]))) AS h
  FROM counted, bits),
slipped AS (
  SELECT times, CASE WHEN h % 31 = 0
    THEN substring(run, 1, CAST(h % length(run) AS INTEGER)) || substring(run, CAST(h % length(run) AS INTEGER) + 2)
    ELSE run END AS word
  FROM sums),
words AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM slipped WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
less AS (
  SELECT word, n, i, substring(word, 1, i) || substring(word, i + 2) AS rest
  FROM (SELECT word, n, CAST(unnest(range(length(word))) AS INTEGER) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION
  SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, max(other_n) AS best_n FROM near GROUP BY word),
named AS (
  SELECT best.word, n_near, best_n, min(other) AS best FROM best JOIN near ON near.word = best.word AND other_n = best_n
  GROUP BY best.word, n_near, best_n),
formed AS (
  SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * n THEN best END AS form,
         CASE WHEN best_n >= 10 * n THEN best_n END AS form_n
  FROM words LEFT JOIN named USING (word)),
ways AS (
  SELECT word, word AS here, 0 AS step FROM formed
  UNION ALL
  SELECT ways.word, form, step + 1 FROM ways JOIN formed ON formed.word = here WHERE form IS NOT NULL),
ends AS (SELECT word, max_by(here, step) AS root FROM ways GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)""",
    "op3_decontamination": f"""
WITH items AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS words FROM benchmark WHERE item_id IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, list_slice(words, i, i + 12) AS w
  FROM items, LATERAL (SELECT unnest(generate_series(1, greatest(len(words) - 12, 1))) AS i)
  WHERE len(words) > 0),
docs AS (
  SELECT row_number() OVER () AS rn, doc_id, {_WORDS} AS words FROM documents),
lengths AS (SELECT DISTINCT len(w) AS n FROM windows),
runs AS (
  SELECT rn, i, n, list_slice(words, i, i + n - 1) AS w
  FROM docs, lengths, LATERAL (SELECT unnest(generate_series(1, len(words) - n + 1)) AS i)
  WHERE len(words) >= n),
found AS (SELECT rn, i, n, item_id FROM runs JOIN windows USING (w)),
spans AS (SELECT DISTINCT rn, i, n FROM found),
hit AS (
  SELECT rn, count(DISTINCT p) AS n_hit
  FROM spans, LATERAL (SELECT unnest(generate_series(i, i + n - 1)) AS p) GROUP BY rn),
owned AS (
  SELECT rn, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT rn, item_id FROM found) GROUP BY rn)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM docs LEFT JOIN hit USING (rn) LEFT JOIN owned USING (rn)""",
}

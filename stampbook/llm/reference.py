"""Reference SQL of the queries that SQL can express, written apart from their operators."""

from __future__ import annotations

from stampbook.llm.licences import TEMPLATES

_BLANK = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]+"
_LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SUBSTRING = f"""WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
  g AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM t WHERE len(w) >= 13),
  k AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM g),
  h AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM k JOIN (SELECT s, MIN(doc_id) AS first FROM k GROUP BY s) USING (s) WHERE doc_id > first),
  x AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM t),
  r AS (SELECT x.doc_id, COUNT(h.p) AS n_removed, string_agg(word, ' ' ORDER BY x.p) FILTER (WHERE h.p IS NULL) AS kept
    FROM x LEFT JOIN h ON h.doc_id = x.doc_id AND h.p = x.p GROUP BY x.doc_id)
SELECT t.doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM t LEFT JOIN r ON r.doc_id = t.doc_id"""

OVERLAP = f"""WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER}, '{_LETTERS}') AS w FROM benchmark),
  bw AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS s
    FROM (SELECT item, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
  t AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_LETTERS}') AS w FROM documents),
  g AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM t, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n),
  k AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s FROM g),
  m AS (SELECT doc_id, k.n, i, item FROM k JOIN bw ON bw.s = k.s AND bw.n = k.n),
  hit AS (SELECT doc_id, COUNT(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
  item AS (SELECT doc_id, COUNT(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY doc_id)
SELECT t.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM t LEFT JOIN hit ON hit.doc_id = t.doc_id LEFT JOIN item ON item.doc_id = t.doc_id"""

QUALITY = f"""WITH t AS (SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
  k AS (SELECT doc_id, i, COUNT(*) OVER (PARTITION BY doc_id, s) AS c
    FROM (SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM t WHERE len(w) >= 3))),
  rep AS (SELECT doc_id, COUNT(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 3)) AS p FROM k WHERE c > 1) GROUP BY doc_id),
  l AS (SELECT doc_id, source, line FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM t) WHERE regexp_matches(line, '{_WORD}')),
  dup AS (SELECT doc_id, COUNT(*) - COUNT(DISTINCT line) AS n FROM l GROUP BY doc_id),
  nl AS (SELECT doc_id, source, len(regexp_extract_all(line, '{_WORD}')) AS n, regexp_replace(regexp_replace(lower(
      regexp_replace(regexp_replace(line, '^{_BLANK}+', ''), '{_BLANK}+$', '')), '{_BLANK}+', ' ', 'g'), '[0-9]+', '0', 'g') AS line FROM l),
  common AS (SELECT source, line FROM nl JOIN (SELECT source, COUNT(DISTINCT doc_id) AS docs FROM documents GROUP BY source) USING (source)
    GROUP BY source, line, docs HAVING COUNT(DISTINCT doc_id) > 20 AND COUNT(DISTINCT doc_id) > 0.01 * docs),
  lost AS (SELECT doc_id, CAST(SUM(n) AS BIGINT) AS n FROM nl JOIN common USING (source, line) GROUP BY doc_id),
  f AS (SELECT t.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
      coalesce(dup.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, coalesce(lost.n, 0) AS n_common_words
    FROM t LEFT JOIN rep ON rep.doc_id = t.doc_id LEFT JOIN dup ON dup.doc_id = t.doc_id LEFT JOIN lost ON lost.doc_id = t.doc_id)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 2 * (n_words - n_common_words) >= n_words AS kept FROM f"""


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(repr(x) for x in row) + ")" for row in rows)


_NEEDED = [(k, t.label, t.base, p, w, any(a <= p < b for a, b in t.phrases)) for k, t in enumerate(TEMPLATES) for p, w in enumerate(t.words)]

LICENCES = f"""WITH t AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_LETTERS}') AS w FROM documents),
  x AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS p FROM t),
  tw(template, label, base, place, word, needed) AS (VALUES {_values(_NEEDED)}),
  idf AS (SELECT v.word, ln(((SELECT COUNT(*) FROM documents) + 1.0) / (COUNT(DISTINCT x.doc_id) + 1.0)) AS idf
    FROM (SELECT DISTINCT word FROM tw) v LEFT JOIN x ON x.word = v.word GROUP BY v.word),
  m AS (SELECT doc_id, template, any_value(label) AS label, any_value(base) AS base, p - place AS start, SUM(idf) AS weight
    FROM x JOIN tw ON tw.word = x.word JOIN idf ON idf.word = x.word GROUP BY doc_id, template, p - place
    HAVING COUNT(*) FILTER (WHERE needed) = (SELECT COUNT(*) FROM tw y WHERE y.template = tw.template AND needed)),
  f AS (SELECT doc_id, COUNT(*) FILTER (WHERE base) AS n_base, MIN(start) FILTER (WHERE base) AS first_word, MAX(start) FILTER (WHERE base) AS last_word,
      string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, MAX(weight) AS weight FROM m GROUP BY doc_id)
SELECT t.doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  round(coalesce(weight, 0) / (coalesce(weight, 0) + 10), 6) AS score FROM t LEFT JOIN f ON f.doc_id = t.doc_id"""

COLLOCATIONS = r"""WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
  t AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
  word AS (SELECT lang, unnest(w) AS s FROM t),
  total AS (SELECT lang, COUNT(*) AS n FROM word GROUP BY lang),
  gram AS (SELECT lang, 1 AS k, s, COUNT(*) AS a FROM word GROUP BY lang, s HAVING COUNT(*) >= 100
    UNION ALL SELECT lang, k, s, COUNT(*) AS a FROM (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM (
      SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM t, (SELECT unnest([2, 3, 4, 5]) AS k) WHERE len(w) >= k)) GROUP BY lang, k, s HAVING COUNT(*) >= 100),
  cand AS (SELECT lang, k, s, a, string_split(s, ' ') AS w FROM gram WHERE k > 1),
  inner_ AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS s, MAX(a) AS longer
    FROM (SELECT lang, w, a, m, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM cand)) GROUP BY ALL),
  free AS (SELECT cand.* FROM cand LEFT JOIN inner_ USING (lang, s) WHERE longer IS NULL OR longer < a),
  cut AS (SELECT lang, s, a, j, array_to_string(w[1:j], ' ') AS x, array_to_string(w[j + 1:k], ' ') AS y FROM (SELECT *, unnest(range(1, k)) AS j FROM free)),
  scored AS (SELECT cut.lang, cut.s, cut.a, j, x.a AS l, y.a AS r, n, (1000::HUGEINT * cut.a * n) // (x.a::HUGEINT * y.a) AS score
    FROM cut JOIN gram x ON x.lang = cut.lang AND x.s = cut.x JOIN gram y ON y.lang = cut.lang AND y.s = cut.y JOIN total ON total.lang = cut.lang),
  lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, s ORDER BY score, j) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, s) AS rank, s AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM lowest QUALIFY rank <= 2000"""

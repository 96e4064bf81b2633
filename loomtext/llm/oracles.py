"""SQL for another engine that gives the rows of the queries it can express."""

from __future__ import annotations

from .quality import BARE_SHARE, CLASSES, COMMON_WORDS, WINDOW


def quality(max_class: float = 0.30, min_chars: int = 200, min_words: int = 60, bare_share: float = BARE_SHARE) -> str:
    """op1: counts by unnesting, histograms and divergences as rows of (document, language, entry)."""
    vocabulary = list(dict.fromkeys(w for words in COMMON_WORDS.values() for w in words))
    values = ", ".join(f"('{w}', {i})" for i, w in enumerate(vocabulary))
    steps, text = [], "t"
    for name, pattern in CLASSES:
        text = f"regexp_replace({text}, '{pattern.replace(chr(39), chr(39) * 2)}', '', 'g')"
        steps.append(f"length({text}) AS left_{name}")
    lefts = ["length(t)", *[f"left_{n}" for n, _ in CLASSES]]
    classes = [f"({a} - {b})" for a, b in zip(lefts, lefts[1:], strict=False)] + [lefts[-1]]
    entries = " UNION ALL ".join(f"SELECT doc_id, 'c' AS part, {i} AS e, {c} AS n FROM lefts" for i, c in enumerate(classes))
    langs = ", ".join(f"('{x}')" for x in COMMON_WORDS)
    own = ", ".join(f"('{x}', {i}, {vocabulary.index(w)})" for i, (x, words) in enumerate(COMMON_WORDS.items()) for w in words)
    return f"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, lang, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS words FROM d),
lefts AS (SELECT doc_id, t, {", ".join(steps)} FROM d),
x AS (SELECT doc_id, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS win FROM (SELECT doc_id, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM w) t),
y AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS k FROM x) t WHERE k > 1),
rep AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM y, range({WINDOW}) r(j) GROUP BY doc_id),
l AS (SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) t WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
dl AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM l GROUP BY doc_id),
base AS (SELECT doc_id, lang, len(words) AS n_words, list_sum(list_transform(words, lambda s: length(s))) AS word_chars, 
  left_stop - left_symbol AS n_symbols, coalesce(dl.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
  FROM w JOIN lefts USING (doc_id, t) LEFT JOIN dl USING (doc_id) LEFT JOIN rep USING (doc_id)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base),
v AS (SELECT * FROM (VALUES {values}) v(word, e)),
cw AS (SELECT doc_id, 'w' AS part, e, count(*) AS n FROM (SELECT doc_id, unnest(list_transform(words, lambda s: lower(s))) AS word FROM w) t JOIN v USING (word) GROUP BY doc_id, e),
g AS (SELECT doc_id, lang AS guess, k FROM (SELECT doc_id, o.lang, o.place, sum(n) AS k FROM cw JOIN (VALUES {own}) o(lang, place, e) USING (e) GROUP BY ALL) t
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY k DESC, place) = 1),
of AS (SELECT f.doc_id, CASE WHEN f.lang IN (SELECT * FROM (VALUES {langs}) t(x)) THEN f.lang WHEN 10 * k >= n_words THEN guess END AS lang FROM f LEFT JOIN g USING (doc_id)),
other AS (SELECT doc_id, 'w' AS part, {len(vocabulary)} AS e, n_words - coalesce((SELECT sum(n) FROM cw WHERE cw.doc_id = f.doc_id), 0) AS n FROM f),
h AS ({entries} UNION ALL SELECT * FROM cw UNION ALL SELECT * FROM other),
p AS (SELECT doc_id, part, e, n / nullif(sum(n) OVER (PARTITION BY doc_id, part), 0) AS p FROM h),
ref AS (SELECT lang, part, e, s / sum(s) OVER (PARTITION BY lang, part) AS q FROM (
  SELECT of.lang, part, e, sum(p) AS s FROM p JOIN f USING (doc_id) JOIN of USING (doc_id) WHERE of.lang IS NOT NULL AND NOT base_failed AND n_words >= {min_words} GROUP BY of.lang, part, e) t),
pairs AS (SELECT doc_id, lang, part, e, p, 0 AS q FROM p, (SELECT DISTINCT lang FROM ref) t WHERE p IS NOT NULL
  UNION ALL SELECT doc_id, ref.lang, ref.part, e, 0, q FROM ref, (SELECT DISTINCT doc_id, part FROM p WHERE p IS NOT NULL) t WHERE t.part = ref.part),
pq AS (SELECT doc_id, lang, part, e, sum(p) AS p, sum(q) AS q FROM pairs GROUP BY doc_id, lang, part, e),
js AS (SELECT doc_id, lang, part, sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2)) AS j
  FROM pq GROUP BY doc_id, lang, part),
bare AS (SELECT lang, sqrt(greatest(0, (1 - r + log2(2 / (1 + r)) + CASE WHEN r > 0 THEN r * log2(2 * r / (1 + r)) ELSE 0 END) / 2)) AS b
  FROM (SELECT lang, coalesce(max(q) FILTER (e = {len(vocabulary)}), 0) AS r FROM ref WHERE part = 'w' GROUP BY lang) t),
able AS (SELECT doc_id, bool_or(j <= {bare_share} * b OR b = 0) AS able FROM js JOIN bare USING (lang) WHERE part = 'w' GROUP BY doc_id),
near AS (SELECT doc_id, min(j) FILTER (part = 'c') AS c, min(j) FILTER (part = 'w') AS w FROM js GROUP BY doc_id),
out AS (SELECT f.*, coalesce(c, CASE WHEN EXISTS (SELECT * FROM ref) THEN 1 END) AS dc, coalesce(w, CASE WHEN EXISTS (SELECT * FROM ref) THEN 1 END) AS dw, coalesce(able, NOT EXISTS (SELECT * FROM ref)) OR coalesce(f.lang NOT IN (SELECT * FROM (VALUES {langs}) t(x)), false) AS able FROM f LEFT JOIN near USING (doc_id) LEFT JOIN able USING (doc_id))
SELECT doc_id, n_words, coalesce(word_chars, 0) AS word_chars, n_symbols, n_dup_lines, n_repeat_words, round(dc, 6) AS class_distance, round(dw, 6) AS word_distance, base_failed,
  NOT base_failed AND coalesce(dc <= {max_class} OR word_chars < {min_chars}, true) AND (able OR n_words < {min_words}) AS kept FROM out"""


#: op11: each window as a sorted list.
ROLLING = """
WITH c AS (SELECT click_id, min({'ts': ts, 'kind': kind, 'cents': CAST(floor(100 * value + 0.5) AS BIGINT)}) AS r FROM clicks WHERE ts IS NOT NULL GROUP BY click_id),
s AS (SELECT click_id, r.ts AS ts, r.kind AS kind, r.cents AS cents FROM c),
w AS (SELECT *, list_sort(list_filter(list(cents) OVER (PARTITION BY kind ORDER BY ts RANGE BETWEEN INTERVAL 60 MINUTE PRECEDING AND CURRENT ROW), lambda x: x IS NOT NULL)) AS v FROM s),
m AS (SELECT *, len(v) AS n, CASE WHEN len(v) > 1 THEN v[(len(v) + 1) // 2] + v[len(v) // 2 + 1] END AS median2 FROM w),
d AS (SELECT *, CASE WHEN n > 1 THEN list_sort(list_transform(v, lambda x: abs(2 * x - median2))) END AS e FROM m),
o AS (SELECT *, e[(n + 1) // 2] + e[n // 2 + 1] AS mad4 FROM d)
SELECT click_id, kind, coalesce(n, 0) AS n, median2, mad4, 2 * abs(2 * cents - median2) > 3 * mad4 AS far FROM o"""

#: op13: pieces by characters.
INFILL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256(concat('1:', coalesce(CAST(doc_id AS VARCHAR), ''))) AS h FROM documents),
g AS (SELECT *, CAST(concat('0x', h[1:8]) AS BIGINT) AS h1, CAST(concat('0x', h[9:16]) AS BIGINT) AS h2, CAST(concat('0x', h[17:24]) AS BIGINT) AS h3, CAST(concat('0x', h[25:32]) AS BIGINT) AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM g),
p AS (SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN concat('<P>', prefix, '<S>', suffix, '<M>', middle) ELSE concat('<S>', suffix, '<P>', prefix, '<M>', middle) END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM p"""


#: Repeated passages can be put in SQL, too, but windows of 100 bytes take it minutes: brute force checks them instead.
ORACLES = {"op1_distribution_divergence": quality(), "op11_rolling_medians": ROLLING, "op13_succinct_infill": INFILL}

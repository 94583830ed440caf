"""DuckDB SQL of the queries that SQL can express.  The others are held against brute force
in ``tests/llm``: their verdicts come from a fitted model, a tokenizer, or bytes that SQL can't cut."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_DEDUP = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, sh FROM (SELECT doc_id, unnest(
    CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
         WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * i >= 75 * (nx.n + ny.n - i)),
e AS (SELECT x AS u, y AS v FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT u, v FROM e UNION SELECT r.u, e.v FROM r JOIN e ON r.v = e.u),
c AS (SELECT u, min(v) AS low FROM r GROUP BY u)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(c.low, w.doc_id)) AS component_id,
       least(w.doc_id, coalesce(c.low, w.doc_id)) = w.doc_id AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN c ON c.u = w.doc_id"""

_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORDS}') AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER}, '{_WORDS}') AS ws FROM benchmark),
bw AS (
  SELECT DISTINCT item, size, unnest(list_transform(range(1, len(ws) - size + 2),
         lambda i: array_to_string(ws[i:i + size - 1], ' '))) AS win
  FROM (SELECT item, ws, least(13, len(ws)) AS size FROM b WHERE len(ws) > 0)),
dw AS (
  SELECT doc_id, size, unnest(range(1, len(ws) - size + 2)) AS i,
         unnest(list_transform(range(1, len(ws) - size + 2), lambda i: array_to_string(ws[i:i + size - 1], ' '))) AS win
  FROM d, (SELECT DISTINCT size FROM bw) WHERE len(ws) >= size),
hit AS (SELECT dw.doc_id, dw.i, dw.size, bw.item FROM dw JOIN bw ON dw.win = bw.win AND dw.size = bw.size),
pos AS (SELECT doc_id, count(DISTINCT place) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
       FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(d.ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.ws) AS contaminated
FROM d LEFT JOIN pos ON pos.doc_id = d.doc_id LEFT JOIN it ON it.doc_id = d.doc_id"""

PHRASES = rf"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_extract_all({_LOWER}, '[^.,;:!?\x0A-\x0D]+')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
total AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (
  SELECT lang, size, unnest(list_transform(range(1, len(ws) - size + 2), lambda i: array_to_string(ws[i:i + size - 1], ' '))) AS phrase
  FROM w, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE len(ws) >= size),
f AS (SELECT lang, size, phrase, count(*) AS n FROM g GROUP BY lang, size, phrase HAVING count(*) >= 30),
c AS (SELECT lang, size, phrase, n AS a, string_split(phrase, ' ') AS ws FROM f WHERE size >= 2),
inside AS (
  SELECT lang, a, len_, unnest(list_transform(range(1, size - len_ + 2), lambda i: array_to_string(ws[i:i + len_ - 1], ' '))) AS phrase
  FROM c, (SELECT unnest([2, 3]) AS len_) WHERE size > len_),
holder AS (SELECT lang, phrase, max(a) AS top FROM inside GROUP BY lang, phrase),
kept AS (SELECT c.* FROM c LEFT JOIN holder h ON h.lang = c.lang AND h.phrase = c.phrase WHERE h.top IS NULL OR 100 * h.top < 80 * c.a),
cut AS (
  SELECT lang, phrase, a, k, array_to_string(ws[1:k], ' ') AS x, array_to_string(ws[k + 1:size], ' ') AS y
  FROM kept, (SELECT unnest([1, 2, 3]) AS k) WHERE k < size),
scored AS (
  SELECT cut.lang, cut.phrase, a, k, x.n AS l, y.n AS r,
         CAST((2000000 * CAST(a AS HUGEINT)) // (x.n + y.n) AS BIGINT) AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = cut.x JOIN f y ON y.lang = cut.lang AND y.phrase = cut.y),
low AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM low)
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total ON total.lang = ranked.lang WHERE rank <= 2000"""

SQL = {"op2_near_dedup": NEAR_DEDUP, "op7_decontamination": DECONTAMINATION, "op13_phrases": PHRASES}

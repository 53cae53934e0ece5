"""The operators over their whole tables, by name, with SQL of the same meaning where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tickloom.llm.op1_sharding import op1_sharding
from tickloom.llm.op2_embedding_dedup import op2_embedding_dedup
from tickloom.llm.op3_mixing import op3_mixing
from tickloom.llm.op4_warc import op4_warc
from tickloom.llm.op5_token_files import op5_token_files
from tickloom.llm.op6_toxicity import op6_toxicity
from tickloom.llm.op7_fingerprints import op7_fingerprints
from tickloom.llm.op8_near_dedup import op8_near_dedup
from tickloom.llm.op9_surrogates import op9_surrogates
from tickloom.llm.op10_sentencepiece import op10_sentencepiece
from tickloom.llm.op11_phrases import op11_phrases
from tickloom.llm.op12_merkle import op12_merkle
from tickloom.llm.op13_packing import op13_packing

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sharding,
        op2_embedding_dedup,
        op3_mixing,
        op4_warc,
        op5_token_files,
        op6_toxicity,
        op7_fingerprints,
        op8_near_dedup,
        op9_surrogates,
        op10_sentencepiece,
        op11_phrases,
        op12_merkle,
        op13_packing,
    )
}

# The others fit models, search, or call libraries that SQL has no counterpart of.
LLM_ORACLES: dict[str, str] = {
    "op2_embedding_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b
  ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
reached(x, y) AS (
  SELECT vec_id, vec_id FROM v
  UNION
  SELECT reached.x, links.y FROM reached JOIN links ON reached.y = links.x),
homes AS (SELECT x, min(y) AS component_id FROM reached GROUP BY x),
counts AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT v.vec_id, coalesce(counts.n, 0) AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN homes ON homes.x = v.vec_id LEFT JOIN counts ON counts.x = v.vec_id""",
    "op4_warc": """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html,
         min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages),
r AS (SELECT *, strlen(html) >= 100 AND page_id <> first AS again FROM p)
SELECT page_id, strlen(html) AS payload_bytes, sha256(html) AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first END AS refers_to
FROM r""",
    "op8_near_dedup": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(words) < 2 THEN words
    ELSE list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) END) AS shingles
  FROM w),
numbered AS (SELECT doc_id, len(shingles) AS n, shingles FROM s),
flat AS (SELECT doc_id, n, hash(unnest(shingles)) AS h FROM numbered),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, a.n AS nx, b.n AS ny, count(*) AS shared
  FROM flat a JOIN flat b ON a.h = b.h AND a.doc_id < b.doc_id
   AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY ALL),
links AS (SELECT x, y FROM pairs WHERE 100 * shared >= 80 * (nx + ny - shared)),
sides AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached(x, y) AS (
  SELECT doc_id, doc_id FROM numbered
  UNION
  SELECT reached.x, sides.y FROM reached JOIN sides ON reached.y = sides.x),
homes AS (SELECT x, min(y) AS component_id FROM reached GROUP BY x)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept
FROM numbered JOIN homes ON homes.x = doc_id""",
    "op11_phrases": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
spans AS (SELECT lang, ws, unnest([1, 2, 3, 4]) AS k FROM w),
runs AS (
  SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: ws[i:i + k - 1])) AS p
  FROM spans WHERE len(ws) >= k),
f AS (SELECT lang, k, p, count(*) AS a FROM runs GROUP BY ALL),
totals AS (SELECT lang, sum(a) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k > 1 AND a >= 30),
lengths AS (SELECT lang, k, p, a, unnest([2, 3]) AS m FROM c),
parts AS (
  SELECT lang, a, unnest(list_transform(range(1, k - m + 2), lambda i: p[i:i + m - 1])) AS p
  FROM lengths WHERE m < k),
covers AS (SELECT lang, p, max(a) AS most FROM parts GROUP BY ALL),
kept AS (
  SELECT c.* FROM c LEFT JOIN covers USING (lang, p)
  WHERE most IS NULL OR 100 * most::HUGEINT < 80 * a::HUGEINT),
cuts AS (SELECT lang, k, p, a, unnest(range(1, k)) AS cut FROM kept),
scored AS (
  SELECT cuts.lang, cuts.p, cuts.a, cut, x.a AS l, y.a AS r,
    2000000::HUGEINT * cuts.a // (x.a + y.a) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.p = cuts.p[1:cut]
  JOIN f y ON y.lang = cuts.lang AND y.p = cuts.p[cut + 1:]),
best AS (
  SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) AS nth FROM scored),
named AS (SELECT *, array_to_string(p, ' ') AS phrase FROM best WHERE nth = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM named)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000""",
}

"""Registered queries of the operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import prepare
from . import centroids, decontam, filter_audit, htmltext, knn, langid, maxent, mixing, neardup, packing, pii, sharding, warc
from .frames import in_sample, load

SHARDS = 24
#: The key of the pseudonyms made by the registered queries; a deployment brings its own.
PSEUDONYM_KEY = b"registered-queries"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return load(spark, sf_dir, name)


def vocabulary() -> str:
    """The public byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.top_k(_table(spark, sf_dir, "embeddings"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), vocabulary(), with_ids=False)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "item_shingles", "common", "containment").distinct()


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").withColumn("held_out", in_sample("doc_id", 5))
    model = langid.train(docs.where("NOT held_out").select("text", "lang"))
    found = langid.predict(docs.select("doc_id", "held_out", "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op6_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.groups(_table(spark, sf_dir, "documents"), width=2)


def op7_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, PSEUDONYM_KEY, kinds_col="kinds")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents"), sharding.layout(SHARDS), sharding.layout(SHARDS, 1))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = htmltext.main_text(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", "n_chars")


def op10_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.score_documents(_table(spark, sf_dir, "documents"), in_sample("doc_id", 10))


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(_table(spark, sf_dir, "embeddings"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_voronoi_knn": op1_voronoi_knn,
    "op2_warc": op2_warc,
    "op3_packing": op3_packing,
    "op4_decontamination": op4_decontamination,
    "op5_language": op5_language,
    "op6_neardup": op6_neardup,
    "op7_pseudonyms": op7_pseudonyms,
    "op8_sharding": op8_sharding,
    "op9_html_text": op9_html_text,
    "op10_maxent": op10_maxent,
    "op11_centroids": op11_centroids,
    "op12_filter_audit": op12_filter_audit,
    "op13_mixing": op13_mixing,
}

_OP1 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

_OP2 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h)) AS payload_bytes, sha256(h) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first_page FROM d WHERE payload_bytes >= 100 GROUP BY 1)
SELECT d.page_id, d.payload_bytes::BIGINT AS payload_bytes, d.payload_digest,
       CASE WHEN f.first_page IS NULL OR f.first_page = d.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN f.first_page <> d.page_id THEN f.first_page END AS refers_to
FROM d LEFT JOIN f USING (payload_digest)
"""

# Words as the operators take them: A-Z lower-cased, runs of bytes outside white space.
_WORDS = """regexp_extract_all(translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                              'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')"""


def _shingles(table: str, key: str, width: int) -> str:
    """(key, s): the distinct shingles of each row's text, as text."""
    return f"""SELECT DISTINCT {key}, unnest(CASE WHEN len(w) >= {width}
                 THEN list_transform(range(1, len(w) - {width - 2}), lambda i: array_to_string(w[i:i + {width - 1}], ' '))
                 WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
               FROM (SELECT {key}, {_WORDS.format(text="text")} AS w FROM {table})"""


_OP4 = f"""
WITH d AS ({_shingles("documents", "doc_id", 5)}), b AS ({_shingles("benchmark", "item_id", 5)}),
n AS (SELECT item_id, count(*) AS item_shingles FROM b GROUP BY 1),
c AS (SELECT doc_id, item_id, count(*) AS common FROM d JOIN b USING (s) GROUP BY 1, 2)
SELECT doc_id, item_id, item_shingles, common, common / item_shingles AS containment
FROM c JOIN n USING (item_id) WHERE 100 * common >= 80 * item_shingles
"""

_OP6 = f"""
WITH RECURSIVE d AS ({_shingles("documents", "doc_id", 2)}),
n AS (SELECT doc_id, count(*) AS n FROM d GROUP BY 1),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM d x JOIN d y USING (s)
      WHERE x.doc_id <> y.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM c JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
      WHERE 100 * common >= 80 * (p.n + q.n - common)),
r AS (SELECT doc_id AS node, doc_id AS found FROM documents
      UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.found)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(found) AS component_id,
       doc_id = min(found) AS kept
FROM documents LEFT JOIN n USING (doc_id) JOIN r ON r.node = doc_id GROUP BY 1, 2
"""

# The pages mark their article with one element and shape its text with p, h1, b and br.
_OP9 = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1) AS t FROM pages),
b AS (SELECT page_id, url, list_transform(regexp_split_to_array(t, '</?(p|h1)>'), lambda x:
        trim(regexp_replace(replace(replace(replace(replace(regexp_replace(regexp_replace(x, '</?b>', '', 'g'),
             '<br>', ' ', 'g'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\s+', ' ', 'g'))) AS x FROM a),
c AS (SELECT page_id, url, array_to_string(list_filter(x, lambda s: s <> ''), chr(10) || chr(10)) AS text FROM b)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM c
"""



def _op11(dims: int = 64, k: int = 16, rounds: int = 3) -> str:
    """Plain rounds: all distances, the nearest centroid, floor of the mean; spelled out."""
    steps = [f"""v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
      WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS c, v FROM v QUALIFY c < {k})"""]
    near = """SELECT vec_id, any_value(x.v) AS v, min((list_dot_product(x.v, x.v) - 2 * list_dot_product(x.v, y.v)
      + list_dot_product(y.v, y.v))::BIGINT * {k} + c) AS m FROM v x, c{r} y GROUP BY vec_id"""
    for r in range(rounds + 1):
        steps.append(f"a{r} AS ({near.format(k=k, r=r)})")
        if r < rounds:
            steps.append(f"""p{r} AS (SELECT c, i, floor(sum(e) / count(*)) AS e FROM (
      SELECT m % {k} AS c, unnest(range({dims})) AS i, unnest(v) AS e FROM a{r}) GROUP BY c, i),
    c{r + 1} AS (SELECT o.c, coalesce(list(p.e ORDER BY p.i) FILTER (p.i IS NOT NULL), any_value(o.v)) AS v
      FROM c{r} o LEFT JOIN p{r} p ON p.c = o.c GROUP BY o.c)""")
    return f"""WITH {', '.join(steps)}
    SELECT vec_id, (m % {k})::INT AS cluster, m // {k} AS distance,
      (sum(m // {k}) OVER (PARTITION BY m % {k}))::BIGINT AS cluster_inertia, (sum(m // {k}) OVER ())::BIGINT AS inertia,
      sha256(array_to_string(list_transform(c.v, lambda e: e::BIGINT), ',')) AS centroid_sha256
    FROM a{rounds} JOIN c{rounds} c ON c.c = m % {k}"""


# The definition, order by order: rows by (part, what they fail, labels), each met by 600 steps.
_OP12 = r"""
WITH RECURSIVE w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS w FROM documents),
g AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY 1),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    (CASE WHEN len(w) < 100 THEN 'A' ELSE '' END) || (CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END) ||
    (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END) ||
    (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END) ||
    (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END) AS fails FROM w LEFT JOIN g USING (doc_id)),
m AS (SELECT part, fails, good, toxic, count(*) AS n FROM f GROUP BY ALL),
p(o) AS (SELECT '' UNION ALL SELECT o || x FROM p, unnest(['A', 'B', 'C', 'D', 'E']) t(x) WHERE NOT contains(o, x)),
s AS (SELECT o, i AS step, o[i] AS x, o[:i - 1] AS before FROM p, range(1, 6) r(i) WHERE length(o) = 5),
h AS (SELECT part, o, step, x, n, good, toxic, contains(fails, x) AS bad, fails = x AS lone,
    length(translate(fails, before, '')) < length(fails) AS gone FROM m, s),
c AS (SELECT part, o, step, x, sum(n) FILTER (NOT gone AND NOT bad) AS kept, sum(n) FILTER (bad AND NOT gone) AS removed,
    sum(n) FILTER (bad AND gone) AS redundant, sum(n) FILTER (lone) AS unique_fails,
    sum(n) FILTER (bad AND NOT gone AND good = 1) AS good_lost, sum(n) FILTER (bad AND NOT gone AND toxic = 1) AS toxic_lost
  FROM h GROUP BY part, o, step, x)
SELECT part, o AS filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
  coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
  coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  (sum(coalesce(removed, 0)) OVER (PARTITION BY part, x))::BIGINT AS shapley FROM c
"""

ORACLE_SQL: dict[str, str] = {
    "op1_voronoi_knn": _OP1,
    "op2_warc": _OP2,
    "op4_decontamination": _OP4,
    "op6_neardup": _OP6,
    "op9_html_text": _OP9,
    "op11_centroids": _op11(),
    "op12_filter_audit": _OP12,
}

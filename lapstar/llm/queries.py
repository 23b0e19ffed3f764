"""One query per operator, over its whole table, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapstar.llm import (
    collocations,
    decontaminate,
    idfile,
    mixing,
    nearcopies,
    repeats,
    secrets,
    sentencepieces,
    topk,
    toxicity,
    urls,
    whitening,
    wordpieces,
)
from lapstar.llm.common import small_batches

TOKENIZERS = "/opt/tokenizers"
SEED = 20240229

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces with one candidate merge in ten skipped."""
    return sentencepieces.summary(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/piece_bpe_32k.model", SEED)


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@query
def op3_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids written with a Huffman code and read back."""
    docs = table(spark, sf_dir, "documents")
    return idfile.read_summary(spark, idfile.encoded_folder(docs, f"{TOKENIZERS}/word_bpe_49k.json"))


@query
def op4_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearcopies.group(table(spark, sf_dir, "documents"), link=85)


ORACLE["op4_near_copies"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ')
    ELSE array_to_string(w[i : i + 4], ' ') END AS s
  FROM words, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(i) WHERE len(w) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY 1, 2
), links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * c >= 85 * (p.n + q.n - c)
), edges AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reached AS (
  SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, b.y FROM reached r JOIN edges b ON r.other = b.x
)
SELECT d.doc_id, coalesce(z.n, 0)::BIGINT AS n_shingles, r.component_id, d.doc_id = r.component_id AS kept
FROM documents d LEFT JOIN sizes z USING (doc_id)
JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY 1) r USING (doc_id)
"""


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy word pieces of the word vocabulary in every text."""
    return wordpieces.count_pieces(
        table(spark, sf_dir, "documents"), wordpieces.read_vocabulary(f"{TOKENIZERS}/word_bpe_49k.json")
    )


@query
def op6_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``has_repeat``, behind the contract's columns, is 1 if anything of the text goes, else 0."""
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return found.withColumn("has_repeat", F.when(F.col("n_removed") > 0, 1).otherwise(0))


@query
def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best of all other vectors for every twentieth vector."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", topk.whole(F.col("embedding")).alias("vector"))
    return topk.search(vectors.filter("vec_id % 20 = 0"), vectors, 20)


ORACLE["op7_exact_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS vector FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.vector, c.vector)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM scored
)
SELECT query_id, n::INTEGER AS rank, vec_id, score FROM ranked WHERE n <= 20
"""


@query
def op8_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


URL_RULES = [
    urls.Rule("net", "/", "block"),
    urls.Rule("example.net", "/en/", "allow"),
    urls.Rule("example.com", "/de/", "block"),
    urls.Rule("org", "/fr/", "allow"),
]


@query
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules first; pages without a rule are blocked if another page has the same host and path."""
    pages = table(spark, sf_dir, "pages")
    return urls.judge(pages, URL_RULES, urls.repeated_urls(pages))


ORACLE["op10_url_filter"] = r"""
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM parts
), listed AS (
  SELECT host || path AS key FROM parts WHERE host || path <> '' GROUP BY 1 HAVING min(page_id) < max(page_id)
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN host <> '' AND host || path IN (SELECT key FROM listed) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""


@query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four leading components of every vector."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


ORACLE["op12_collocations"] = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS piece, lang, words FROM (
    SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS words FROM (
      SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz') AS text FROM documents)
  ) WHERE len(words) > 0
), placed AS (
  SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM pieces
), f AS (
  SELECT lang, k, CASE k WHEN 1 THEN words[i] WHEN 2 THEN words[i] || ' ' || words[i + 1]
      ELSE words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] END AS phrase, count(*)::HUGEINT AS f
  FROM placed, (SELECT unnest([1, 2, 3]) AS k) WHERE i + k - 1 <= len(words) GROUP BY ALL
), candidates AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10
), cuts AS (
  SELECT c.lang, c.k, c.phrase, a, cut, x.f AS l, y.f AS r, (1000000::HUGEINT * a * a) // (x.f * y.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(w[1 : cut], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(w[cut + 1 : ], ' ')
), scored AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inside AS (
  SELECT lang, phrase, max(a) AS most FROM (
    SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase FROM candidates WHERE k = 3
  ) GROUP BY ALL
), ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank
  FROM scored s LEFT JOIN inside i ON s.k = 2 AND i.lang = s.lang AND i.phrase = s.phrase
  WHERE i.most IS NULL OR 100 * i.most < 50 * a
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r,
  (SELECT sum(f) FROM f WHERE k = 1 AND f.lang = ranked.lang)::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""


@query
def op13_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources weigh 1, 2, 3, repeating."""
    return mixing.summary(table(spark, sf_dir, "documents"), SEED)

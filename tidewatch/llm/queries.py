"""The registered queries of this package and, where one can be written, their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewatch.llm import anchors, centroids, minhash, near_vectors, packing, prefix_trie, quality, repeats, topk, toxicity, url_lists
from tidewatch.llm.bpe import encode
from tidewatch.llm.common import id_bucket, ship_package
from tidewatch.llm.sharding import shard_by_bytes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """Path of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


# crc32 as a fold over the bytes; its table follows from the reversed polynomial.
CRC = """
crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_concat([i::BIGINT], range(8)),
      lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) AS c
    FROM range(256) r(i))),
"""
OP10_SQL = f"""
WITH {CRC}
d AS (
  SELECT row_number() OVER () AS n, doc_id, strlen(coalesce(text, '')) + 1 AS size,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT) AS b
  FROM documents),
c AS (
  SELECT n, doc_id, size,
    xor(list_reduce(list_concat([4294967295::BIGINT], b), lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295::BIGINT) AS text_crc32
  FROM d, crc_table),
p AS (
  SELECT *, sum(size) OVER w - size AS start, sum(size) OVER () AS total, row_number() OVER w - 1 AS place
  FROM c WINDOW w AS (ORDER BY doc_id NULLS FIRST, size, text_crc32, n ROWS UNBOUNDED PRECEDING)),
s AS (SELECT *, (((2 * start + size) * 16) // (2 * total))::INTEGER AS shard FROM p)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'bytes' AS law, shard,
  (place - min(place) OVER (PARTITION BY shard))::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM s
"""


@query("op10_byte_shards", OP10_SQL)
def op10_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(read(spark, sf_dir, "documents"))


@query("op3_pair_index_bpe")
def op3_pair_index_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(documents, tokenizer("word_bpe_49k.json")).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def learnable(labels: DataFrame, modulus: int, held_out: int) -> DataFrame:
    """Label rows outside the held-out fold."""
    return labels.where(id_bucket("doc_id", modulus) != held_out)


@query("op6_ftrl_toxicity")
def op6_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity_scores(documents, read(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id",
        F.coalesce(id_bucket("doc_id", 3) == 1, F.lit(True)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def toxicity_scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``documents`` with ``score``, learnt from their labels outside the held-out fold."""
    options = toxicity.Ftrl()
    sample = toxicity.labelled_sample(documents, learnable(labels, 3, 1), "toxic", options.sample)
    return toxicity.score(documents, toxicity.fit(documents.sparkSession, sample, options))


@query("op1_knn_quality")
def op1_knn_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_scores(documents, read(spark, sf_dir, "labels")).select(
        "doc_id",
        F.coalesce(id_bucket("doc_id", 5) == 0, F.lit(True)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def quality_scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``documents`` with ``score``, learnt from their labels outside the held-out fold."""
    options = quality.Options()
    sample = quality.labelled_sample(documents, learnable(labels, 5, 0), options)
    return quality.score(documents, quality.fit(documents, sample, options))


@query("op5_retrieval_packing")
def op5_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(read(spark, sf_dir, "documents"))


def packed(documents: DataFrame) -> DataFrame:
    """``documents`` in sequences of 1024 ids."""
    import public_tokenizers

    # The ranks are those of the JSON file of the same name; its added token keeps its id.
    return packing.pack(documents, tokenizer("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, {"<|endoftext|>": 50256})


@query("op4_bag_minhash")
def op4_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"))


@query("op7_prefix_free_repeats")
def op7_prefix_free_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = repeats.remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return removed.select(
        "doc_id", "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


OP9_SQL = """
WITH RECURSIVE e AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
u AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.9),
r(vec_id, reached) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT r.vec_id, u.b FROM r JOIN u ON r.reached = u.a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM (SELECT vec_id, min(reached) AS component_id FROM r GROUP BY vec_id)
LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM u GROUP BY a) USING (vec_id)
"""


@query("op9_pca_tiles", OP9_SQL)
def op9_pca_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_duplicates(read(spark, sf_dir, "embeddings"))

OP2_SQL = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0)::BIGINT AS score
  FROM e q JOIN e c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@query("op2_pivot_topk", OP2_SQL)
def op2_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


OP11_SQL = f"""
WITH {CRC}
t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
l AS (
  SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, role, md5(strlen(role) || ':' || role || text)) AS turns,
    list_transform(regexp_extract_all(hex(encode(conv_id::VARCHAR)), '..'), lambda x: ('0x' || x)::BIGINT) AS b
  FROM t GROUP BY conv_id),
h AS (
  SELECT conv_id, turns,
    xor(list_reduce(list_concat([4294967295::BIGINT], b), lambda a, x: xor(a >> 8, crc_table.t[(xor(a, x) & 255) + 1])), 4294967295::BIGINT) % 9 AS h
  FROM l, crc_table),
r AS (
  SELECT h.conv_id, list_concat(coalesce(o.turns[1:h.h], []), h.turns[h.h + 1:]) AS path
  FROM h LEFT JOIN h o ON o.conv_id = h.conv_id - h.conv_id % 5),
m AS (SELECT conv_id, unnest(range(len(path) + 1)) AS d, path FROM r),
n AS (
  SELECT path[1:d] AS p, min(conv_id) AS conv_id, any_value(d) AS depth, count(*) AS n_convs,
    coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (d = len(path)), '') AS ends
  FROM m GROUP BY path[1:d]),
k AS (SELECT p[1:depth - 1] AS p, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
c AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM n LEFT JOIN k ON n.p = k.p),
u AS (
  SELECT p[1:d] AS p, count(*) FILTER (n_children = 0) AS n_leaves, coalesce(sum((n_convs - 1) * strlen(p[depth].text)), 0) AS saved
  FROM (SELECT *, unnest(range(depth + 1)) AS d FROM c) GROUP BY 1)
SELECT c.conv_id, c.depth, q.conv_id AS parent_conv_id, c.n_convs, c.n_children, n_leaves, saved::BIGINT AS saved_tokens, sha256(c.ends) AS ends_sha256
FROM c JOIN u ON c.p = u.p LEFT JOIN n q ON c.depth > 0 AND q.p = c.p[1:c.depth - 1]
"""


@query("op11_zfast_prefix_trie", OP11_SQL)
def op11_zfast_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(read(spark, sf_dir, "conversations"))


OP12_SQL = """
WITH w AS (
  SELECT row_number() OVER () AS n, doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS words FROM documents),
p AS (SELECT n, unnest(range(1, len(words) - 33)) AS s, words FROM w WHERE len(words) >= 35),
g AS (SELECT n, s, count(*) OVER (PARTITION BY array_to_string(words[s:s + 34], ' ')) AS c FROM p),
gone AS (SELECT DISTINCT n, unnest(range(s, s + 35)) AS i FROM g WHERE c > 1),
cut AS (SELECT n, list(i) AS removed FROM gone GROUP BY n),
k AS (SELECT w.*, coalesce(removed, []) AS removed FROM w LEFT JOIN cut USING (n))
SELECT doc_id, len(words)::BIGINT AS n_words, len(removed)::BIGINT AS n_removed,
  sha256(array_to_string(list_filter(words, lambda x, i: NOT list_contains(removed, i)), ' ')) AS kept_sha256
FROM k
"""


@query("op12_block_anchors", OP12_SQL)
def op12_block_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = anchors.remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def _kmeans_rounds(rounds: int) -> str:
    """The assignments and floored means of the given number of rounds, and a last assignment."""
    out = []
    for n in range(rounds + 1):
        out.append(f"""
d{n} AS (
  SELECT e.n, e.vec_id, e.v, c.k, list_sum(list_transform(list_zip(e.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS distance
  FROM e, c{n} c),
a{n} AS (SELECT * FROM d{n} QUALIFY row_number() OVER (PARTITION BY n ORDER BY distance, k) = 1)""")
        if n < rounds:
            out.append(f"""
m{n} AS (
  SELECT k, i, sum(v[i])::BIGINT AS s, count(*) AS n FROM a{n}, range(1, 65) r(i) GROUP BY k, i),
c{n + 1} AS (
  SELECT c.k, coalesce(m.v, c.v) AS v FROM c{n} c
  LEFT JOIN (SELECT k, list((s - (s % n + n) % n) // n ORDER BY i) AS v FROM m{n} GROUP BY k) m ON m.k = c.k)""")
    return ",".join(out)


OP13_SQL = f"""
WITH e AS (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS k, v FROM e WHERE vec_id IS NOT NULL
  QUALIFY k < 16),{_kmeans_rounds(3)}
SELECT a.vec_id, a.k::INTEGER AS cluster, a.distance, sum(a.distance) OVER (PARTITION BY a.k)::BIGINT AS cluster_inertia,
  sum(a.distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a3 a JOIN c3 c USING (k)
"""


@query("op13_rotated_centroids", OP13_SQL)
def op13_rotated_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(read(spark, sf_dir, "embeddings")).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia",
        F.sha2(F.array_join("centroid", ",").cast("binary"), 256).alias("centroid_sha256"),
    )


# Dated lists over the hosts and addresses of the pages, and a fetch time for each page: the tables have neither,
# so both follow from a digest of the host and from the page's number.
OP8_VIEWS = """
page_hosts AS (
  SELECT DISTINCT host, ('0x' || substr(md5(host), 1, 6))::BIGINT AS h FROM (
    SELECT lower(regexp_extract(url, '^https?://([^/?#:@]+)', 1)) AS host FROM pages WHERE url IS NOT NULL) WHERE host <> ''),
entries AS (
  SELECT 'spam' AS list, 'block' AS verdict, 'host' AS scope, host AS pattern, 'add' AS action, h % 300 AS day FROM page_hosts WHERE h % 3 = 0
  UNION ALL SELECT 'spam', 'block', 'host', host, 'remove', h % 300 + 60 FROM page_hosts WHERE h % 6 = 0
  UNION ALL SELECT 'spam', 'block', 'host', host, 'add', h % 300 + 100 FROM page_hosts WHERE h % 12 = 0
  UNION ALL SELECT 'adult', 'block', 'domain', regexp_replace(host, '^[^.]+[.]', ''), 'add', h % 200 FROM page_hosts
    WHERE h % 5 = 0 AND len(host) - len(replace(host, '.', '')) > 2
  UNION ALL SELECT 'partners', 'allow', 'prefix', host || '/en', 'add', h % 250 FROM page_hosts WHERE h % 4 = 0)
"""
OP8_SQL = f"""
WITH {OP8_VIEWS},
captures AS (
  SELECT page_id, url, (page_id * 7919) % 365 AS day, nullif(lower(regexp_extract(url, '^https?://([^/?#:@]+)', 1)), '') AS host,
    regexp_extract(url, '^[^/?#]*//[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
states AS (SELECT list, verdict, scope, pattern, day, bool_or(action = 'remove') AS off FROM entries GROUP BY ALL),
spans AS (
  SELECT *, lead(day) OVER (PARTITION BY list, verdict, scope, pattern ORDER BY day) AS until FROM (
    SELECT *, lag(off) OVER (PARTITION BY list, verdict, scope, pattern ORDER BY day) AS was FROM states)
  WHERE was IS NULL AND NOT off OR was <> off),
active AS (
  SELECT c.page_id, s.* FROM captures c JOIN spans s ON NOT off AND s.day <= c.day AND (until IS NULL OR c.day < until)
    AND CASE scope WHEN 'host' THEN host = pattern
      WHEN 'domain' THEN host = pattern OR ends_with(host, '.' || pattern)
      ELSE host || path = pattern OR starts_with(host || path, pattern || '/') END),
best AS (
  SELECT *, count(*) OVER (PARTITION BY page_id) AS n, row_number() OVER (
    PARTITION BY page_id ORDER BY length(pattern) DESC, CASE scope WHEN 'prefix' THEN 0 WHEN 'host' THEN 1 ELSE 2 END, verdict <> 'allow', list) AS k
  FROM active)
SELECT page_id, host, c.day::BIGINT AS fetched_day, coalesce(n, 0)::BIGINT AS n_active, coalesce(verdict, 'none') AS verdict, list, scope, pattern
FROM captures c LEFT JOIN (SELECT * EXCLUDE (day) FROM best WHERE k = 1) USING (page_id)
"""


@query("op8_url_lists_asof", OP8_SQL)
def op8_url_lists_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    hosts = pages.select(url_lists.host_of(F.col("url")).alias("host")).where("host IS NOT NULL").distinct()
    h = F.conv(F.substring(F.md5("host"), 1, 6), 16, 10).cast("bigint")
    parent = F.regexp_replace("host", "^[^.]+[.]", "")

    def entry(test: Column, kind: str, verdict: str, scope: str, pattern: Column, action: str, day: Column) -> Column:
        return F.when(test, F.struct(
            F.lit(kind).alias("list"), F.lit(verdict).alias("verdict"), F.lit(scope).alias("scope"), pattern.alias("pattern"),
            F.lit(action).alias("action"), day_time(day).alias("at"),
        ))

    host = F.col("host")
    entries = hosts.select(F.inline(F.array_compact(F.array(
        entry(h % 3 == 0, "spam", "block", "host", host, "add", h % 300),
        entry(h % 6 == 0, "spam", "block", "host", host, "remove", h % 300 + 60),
        entry(h % 12 == 0, "spam", "block", "host", host, "add", h % 300 + 100),
        entry((h % 5 == 0) & (F.size(F.split("host", "[.]")) > 3), "adult", "block", "domain", parent, "add", h % 200),
        entry(h % 4 == 0, "partners", "allow", "prefix", F.concat(host, F.lit("/en")), "add", h % 250),
    ))))
    day = (F.col("page_id") * 7919) % 365
    captures = pages.withColumn("fetched_day", day).withColumn("fetched_at", day_time(day))
    return url_lists.judge(captures, entries).select("page_id", "host", "fetched_day", "n_active", "verdict", "list", "scope", "pattern")


def day_time(day: Column) -> Column:
    """Midnight of a day of 2024, counted from 0."""
    return F.timestamp_seconds(F.lit(1_704_067_200) + day * 86_400)

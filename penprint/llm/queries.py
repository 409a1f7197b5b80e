"""The registered query of each operator, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from penprint.llm import (
    collocations,
    crf_pii,
    digest_index,
    fm_index,
    gru_lm,
    language,
    line_quality,
    mixing,
    pivot_kmeans,
    secret_scan,
    simhash,
    toxicity,
    warc,
)
from penprint.llm.common import fold_of, held_out, table


def _joined(spans: Column) -> Column:
    """``kind:start:stop`` of all spans, comma-joined."""
    one = F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.stop.cast("string")))
    return F.array_join(one, ",")


def _count(spans: Column, kind: str, name: str) -> Column:
    return F.size(F.filter(spans, lambda s: s.kind == kind)).cast("long").alias(name)


def op1_gru_lm(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return gru_lm.score_texts(docs, held_out(F.col("doc_id"), 7, 2))


def op2_digest_index(spark: SparkSession, folder: str) -> DataFrame:
    return digest_index.deduplicate(table(spark, folder, "documents"))


OP2_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = toxicity.scored(docs, table(spark, folder, "labels"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id"), 4, 2).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    found = language.predicted(docs, fold_of(F.col("doc_id"), 5) != 0)
    return found.select(
        "doc_id",
        held_out(F.col("doc_id"), 5, 0).alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"),
    )


def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = secret_scan.with_secrets(table(spark, folder, "documents").select("doc_id", "text"))
    spans = F.col("secrets")
    base = F.filter(spans, lambda s: s.kind.isin(*secret_scan.BASE))
    return docs.select(
        "doc_id",
        *[_count(spans, kind, f"n_{kind}") for kind in secret_scan.BASE],
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(spans).alias("spans"),
    )


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op7_crf_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = crf_pii.with_personal_data(table(spark, folder, "documents").select("doc_id", "text"))
    spans = F.col("personal")
    base = F.filter(spans, lambda s: s.by_pattern)
    return docs.select(
        "doc_id",
        *[_count(base, kind, f"n_{kind}") for kind in crf_pii.KINDS],
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(spans).alias("spans"),
    )


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).drop("text")


# The same bisection, quotas and orders; md5 gives the permutations in both.
OP8_SQL = f"""
WITH RECURSIVE rows AS (
  SELECT doc_id, source, coalesce('s' || source, 'n') AS key,
         len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+')) AS tokens
  FROM documents),
sizes AS (SELECT key, sum(tokens)::BIGINT AS n FROM rows GROUP BY key HAVING sum(tokens) > 0),
one AS (SELECT sum(n)::DOUBLE AS total, count(*)::DOUBLE AS sources, max(n)::DOUBLE AS largest,
               min(n)::DOUBLE AS smallest FROM sizes),
entropy_at_one AS (
  SELECT -sum(n / total * ln(n / total)) AS h FROM sizes, one),
by_entropy(step, lo, hi) AS (
  SELECT 0, 0::DOUBLE, 1::DOUBLE
  UNION ALL
  SELECT step + 1, CASE WHEN ok THEN (lo + hi) / 2 ELSE lo END, CASE WHEN ok THEN hi ELSE (lo + hi) / 2 END
  FROM (SELECT b.step, b.lo, b.hi,
          (SELECT ln(sum(pow(n / total, (b.lo + b.hi) / 2)))
             - (b.lo + b.hi) / 2 * sum(pow(n / total, (b.lo + b.hi) / 2) * ln(n / total))
             / sum(pow(n / total, (b.lo + b.hi) / 2)) FROM sizes, one)
          >= (SELECT {mixing.ENTROPY_SHARE} * ln(sources) FROM one) AS ok
        FROM by_entropy b WHERE b.step < {mixing.STEPS})),
by_repeats(step, lo, hi) AS (
  SELECT 0, 0::DOUBLE, 1::DOUBLE
  UNION ALL
  SELECT step + 1, CASE WHEN ok THEN (lo + hi) / 2 ELSE lo END, CASE WHEN ok THEN hi ELSE (lo + hi) / 2 END
  FROM (SELECT b.step, b.lo, b.hi,
          (SELECT pow(largest / smallest, 1 - (b.lo + b.hi) / 2) > {mixing.MOST_REPEATS} FROM one) AS ok
        FROM by_repeats b WHERE b.step < {mixing.STEPS})),
exponent AS (
  SELECT CASE WHEN largest / smallest <= {mixing.MOST_REPEATS} THEN e ELSE greatest(e, r) END AS e
  FROM (SELECT one.*,
          CASE WHEN h >= {mixing.ENTROPY_SHARE} * ln(sources) THEN 1
               ELSE (SELECT max(lo) FROM by_entropy WHERE step = {mixing.STEPS}) END AS e,
          (SELECT max(hi) FROM by_repeats WHERE step = {mixing.STEPS}) AS r
        FROM one, entropy_at_one)),
weights AS (
  SELECT key, n, pow(n / total, e) / sum(pow(n / total, e)) OVER () AS w, total, largest,
         pow(largest / total, e) / sum(pow(n / total, e)) OVER () AS w_largest
  FROM sizes, one, exponent),
quotas AS (
  SELECT key, n, round(largest / w_largest * w)::BIGINT AS quota,
         ceil(n::DOUBLE / {mixing.BLOCK_TOKENS})::BIGINT AS blocks,
         ceil(round(largest / w_largest) / {mixing.BLOCK_TOKENS})::BIGINT AS places
  FROM weights),
dealt AS (
  SELECT rows.*, n, quota, places, ('0x' || md5(doc_id::VARCHAR)[1:15])::BIGINT % blocks AS block
  FROM rows JOIN quotas USING (key)),
copies AS (
  SELECT dealt.*, unnest(range(0, greatest((quota - 1) // n, 0) + 1)) AS epoch FROM dealt),
block_sizes AS (SELECT key, epoch, block, sum(tokens) AS size FROM copies GROUP BY ALL),
block_starts AS (
  SELECT key, epoch, block, coalesce(sum(size) OVER (
    PARTITION BY key, epoch ORDER BY md5(key || '|' || epoch || '|' || block), block
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS block_start
  FROM block_sizes),
placed AS (
  SELECT copies.*, epoch * n + block_start + coalesce(sum(tokens) OVER (
    PARTITION BY key, epoch, block ORDER BY md5(doc_id || '|' || epoch), doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM copies JOIN block_starts USING (key, epoch, block))
SELECT doc_id, source, tokens::BIGINT AS mix_tokens, epoch::BIGINT AS mix_epoch, block::BIGINT AS mix_block,
       floor(start::DOUBLE / quota * places)::BIGINT AS mix_place
FROM placed WHERE start < quota
"""


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    history = warc.archive(table(spark, folder, "pages"))
    return history.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured", "capture_order"
    )


def op10_fm_index(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = fm_index.with_hits(docs, table(spark, folder, "benchmark"), "hits")
    hits = F.col("hits")
    return found.select(
        "doc_id",
        "hits.n_words",
        "hits.n_hit",
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hits.items", ",").cast("binary"), 256).alias("items_sha256"),
        fm_index.contaminated(hits).alias("contaminated"),
    )


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.phrases_of(table(spark, folder, "documents"))


_UPPER = "".join(map(chr, range(65, 91)))
OP11_SQL = f"""
WITH pieces AS (
  SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda x: x <> '') AS w
  FROM (SELECT coalesce(lang, '{collocations.NO_LANGUAGE}') AS lang,
          unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
        FROM documents)),
counts AS MATERIALIZED (
  SELECT lang, k, phrase, count(*) AS a FROM (
    SELECT lang, 1 AS k, unnest(w) AS phrase FROM pieces
    UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM pieces
    UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
      FROM pieces)
  GROUP BY ALL HAVING k = 1 OR count(*) >= {collocations.SUPPORT}),
candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE k > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.a, c.cut, l.a AS l, r.a AS r, (1000000::HUGEINT * c.a * c.a) // (l.a::HUGEINT * r.a) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates) c
  JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.cut], ' ')
  JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.cut + 1:], ' ')),
weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
covers AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, a, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase FROM candidates WHERE k = 3)
  GROUP BY lang, phrase),
kept AS (
  SELECT weakest.* FROM weakest LEFT JOIN covers USING (lang, phrase)
  WHERE longer IS NULL OR 100 * longer < {collocations.COVER_PERCENT} * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept),
sizes AS (SELECT lang, sum(a)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN sizes USING (lang)
WHERE rank <= {collocations.TOP}
"""


def op12_line_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = line_quality.scored(docs, table(spark, folder, "labels"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id"), 3, 1).alias("held_out"),
        "score",
        (F.col("score") >= line_quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op13_pivot_kmeans(spark: SparkSession, folder: str) -> DataFrame:
    return pivot_kmeans.clustered(table(spark, folder, "embeddings"))


def _lloyd_sql(rounds: int) -> str:
    """The rounds one after the other, every vector measured against every centroid."""
    parts = [
        f"""kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor({pivot_kmeans.SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {pivot_kmeans.DIMS} AND len(list_filter(embedding, lambda x: isfinite(x))) = {pivot_kmeans.DIMS}),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 AS c, v FROM kept
  ORDER BY sha256('3:' || vec_id), v LIMIT {pivot_kmeans.CLUSTERS})"""
    ]
    for k in range(rounds + 1):
        parts.append(f"""d{k} AS (
  SELECT vec_id, v, list_transform(cs, lambda w: list_sum(list_transform(range(1, {pivot_kmeans.DIMS + 1}),
    lambda i: (v[i] - w[i]) * (v[i] - w[i])))) AS d
  FROM kept, (SELECT list(v ORDER BY c) AS cs FROM c{k})),
a{k} AS MATERIALIZED (SELECT vec_id, v, list_position(d, list_min(d)) - 1 AS c, list_min(d) AS distance FROM d{k})""")
        if k < rounds:
            parts.append(f"""s{k} AS (
  SELECT c, i, sum(x) AS s, count(*) AS n
  FROM (SELECT c, unnest(v) AS x, unnest(range({pivot_kmeans.DIMS})) AS i FROM a{k}) GROUP BY c, i),
c{k + 1} AS MATERIALIZED (
  SELECT c{k}.c, coalesce(m.v, c{k}.v) AS v FROM c{k} LEFT JOIN (
    SELECT c, list((CASE WHEN s >= 0 THEN s // n ELSE -((n - 1 - s) // n) END)::BIGINT ORDER BY i) AS v
    FROM s{k} GROUP BY c) m USING (c))""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, a.c::INTEGER AS cluster, distance::BIGINT AS distance,
  (sum(distance) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c USING (c)"""


OP13_SQL = _lloyd_sql(pivot_kmeans.ROUNDS)


QUERIES = {
    "op1_gru_lm": op1_gru_lm,
    "op2_digest_index": op2_digest_index,
    "op3_toxicity": op3_toxicity,
    "op4_language": op4_language,
    "op5_secret_scan": op5_secret_scan,
    "op6_simhash": op6_simhash,
    "op7_crf_pii": op7_crf_pii,
    "op8_mixing": op8_mixing,
    "op9_warc": op9_warc,
    "op10_fm_index": op10_fm_index,
    "op11_collocations": op11_collocations,
    "op12_line_quality": op12_line_quality,
    "op13_pivot_kmeans": op13_pivot_kmeans,
}
SQL: dict[str, str] = {
    "op2_digest_index": OP2_SQL,
    "op8_mixing": OP8_SQL,
    "op11_collocations": OP11_SQL,
    "op13_pivot_kmeans": OP13_SQL,
}

"""The corpus queries with production parameters, over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from muster.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from muster.llm import bpe

    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@query
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from muster.llm import warc

    return warc.round_trip(table(spark, sf_dir, "pages"))


ORACLE_SQL["op9_warc"] = """
WITH payload AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), best AS (
  SELECT payload_digest, max(page_id) AS last_id FROM payload WHERE payload_bytes >= 1000 GROUP BY payload_digest
)
SELECT p.page_id, CAST(p.payload_bytes AS BIGINT) AS payload_bytes, p.payload_digest,
       CASE WHEN p.page_id < b.last_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN p.page_id < b.last_id THEN b.last_id END AS refers_to, CAST(NULL AS VARCHAR) AS problem
FROM payload p LEFT JOIN best b ON p.payload_digest = b.payload_digest AND p.payload_bytes >= 1000
"""


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from muster.llm import toxicity

    return toxicity.predictions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from muster.llm import langid

    return langid.predictions(table(spark, sf_dir, "documents"))


#: The key of the surrogates; a user gives their own.
PII_KEY = b"a key of the user's own"


@query
def op6_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from muster.llm import pii

    return pii.pseudonymised(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY, spans="entities")


@query
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from muster.llm import ngram_join

    return ngram_join.join(table(spark, sf_dir, "documents"))


@query
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from muster.llm import substring_dedup

    return substring_dedup.dedup(table(spark, sf_dir, "documents"))


@query
def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from muster.llm import ann

    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from muster.llm import exact_topk

    return exact_topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


#: The tree of the mix: sources of each domain, and weights of its nodes.
MIX_DOMAINS = {"web": [f"src{i}" for i in range(10)], "reference": [f"src{i}" for i in range(10, 16)], "forum": [f"src{i}" for i in range(16, 20)]}
MIX_WEIGHTS = {"domain": {"web": 50, "reference": 30, "forum": 20, "other": 5}, "language": {"en": 50, "de": 20, "fr": 20, "es": 10}}
MIX_DEFAULT, MIX_EPOCHS, MIX_SEED = 4, 4, "muster"


def mix_domain():
    from pyspark.sql import functions as F

    out = F.lit("other")
    for name, sources in MIX_DOMAINS.items():
        out = F.when(F.col("source").isin(sources), F.lit(name)).otherwise(out)
    return out


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from muster.llm import mixing

    return mixing.mix(table(spark, sf_dir, "documents"), mix_domain(), MIX_WEIGHTS, MIX_DEFAULT, MIX_EPOCHS, seed=MIX_SEED)


def _case(column: str, choices: dict[str, object], default: object) -> str:
    return f"CASE {' '.join(f'WHEN {column} = {k!r} THEN {v}' for k, v in choices.items())} ELSE {default} END" if choices else str(default)


def _shared_sql(nodes: str, parent: str, child: str) -> str:
    """The SQL of mixing.shared() over a table with weight, capacity and budget."""
    return f"""
    SELECT *, part + CASE WHEN NOT filled AND weight > 0 AND place <= left_over THEN 1 ELSE 0 END AS share FROM (
      SELECT *, rest - coalesce(sum(CASE WHEN NOT filled THEN part END) OVER (PARTITION BY {parent}), 0) AS left_over,
             row_number() OVER (PARTITION BY {parent} ORDER BY (filled OR weight <= 0), {child}) AS place FROM (
        SELECT *, CASE WHEN filled THEN capacity WHEN weight > 0 THEN (rest * weight) // nullif(rest_weight, 0) ELSE 0 END AS part FROM (
          SELECT *, budget - coalesce(sum(CASE WHEN filled THEN capacity END) OVER (PARTITION BY {parent}), 0) AS rest,
                 sum(CASE WHEN NOT filled THEN weight ELSE 0 END) OVER (PARTITION BY {parent}) AS rest_weight FROM (
            SELECT *, weight > 0 AND capacity * weight_left <= (budget - cap_before) * weight AS filled FROM (
              SELECT *, coalesce(sum(capacity) OVER o, 0) AS cap_before,
                     sum(weight) OVER (PARTITION BY {parent}) - coalesce(sum(weight) OVER o, 0) AS weight_left
              FROM {nodes}
              WINDOW o AS (PARTITION BY {parent} ORDER BY CASE WHEN weight > 0 THEN capacity / weight END NULLS LAST, {child}
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)))))) """


def mix_sql(documents: str = "documents") -> str:
    sources = {s: f"'{d}'" for d, own in MIX_DOMAINS.items() for s in own}
    return rf"""
WITH docs AS (
  SELECT * FROM (
    SELECT doc_id, CAST(len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS BIGINT) AS tokens,
           {_case("source", sources, "'other'")} AS domain, coalesce(lang, '') AS language, coalesce(source, '') AS origin
    FROM {documents}) WHERE tokens > 0
), leaves AS (
  SELECT domain, language, origin, CAST(sum(tokens) AS BIGINT) AS tokens, CAST(sum(tokens) AS BIGINT) * {MIX_EPOCHS} AS capacity,
         {MIX_DEFAULT} AS weight FROM docs GROUP BY ALL
), domains AS (
  SELECT domain, sum(capacity) AS capacity, {_case("domain", MIX_WEIGHTS["domain"], MIX_DEFAULT)} AS weight,
         least(sum(sum(tokens)) OVER (), sum(sum(capacity)) OVER ()) AS budget, 0 AS one FROM leaves GROUP BY domain
), domain_shares AS ({_shared_sql("domains", "one", "domain")}
), languages AS (
  SELECT l.domain, language, sum(l.capacity) AS capacity, {_case("language", MIX_WEIGHTS["language"], MIX_DEFAULT)} AS weight, any_value(s.share) AS budget
  FROM leaves l JOIN domain_shares s ON l.domain = s.domain GROUP BY l.domain, language
), language_shares AS ({_shared_sql("languages", "domain", "language")}
), origins AS (
  SELECT l.*, s.share AS budget FROM leaves l JOIN language_shares s ON l.domain = s.domain AND l.language = s.language
), plan AS (
  SELECT domain, language, origin, CAST(share // tokens AS BIGINT) AS whole, CAST(share % tokens AS BIGINT) AS rest
  FROM ({_shared_sql("origins", "domain, language", "origin")}) WHERE share > 0
), placed AS (
  SELECT d.*, whole, rest, md5('{MIX_SEED}:' || whole || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place
  FROM docs d JOIN plan p ON d.domain = p.domain AND d.language = p.language AND d.origin = p.origin
), summed AS (
  SELECT *, greatest(0, least(tokens, rest - (CAST(sum(tokens) OVER (PARTITION BY domain, language, origin ORDER BY place, doc_id, tokens ROWS UNBOUNDED PRECEDING) AS BIGINT) - tokens))) AS last
  FROM placed
)
SELECT doc_id, domain, language, origin, epoch, tokens, CAST(CASE WHEN epoch < whole THEN tokens ELSE last END AS BIGINT) AS taken
FROM (SELECT *, unnest(range(0, whole + 1)) AS epoch FROM summed) WHERE epoch < whole OR last > 0
"""


ORACLE_SQL["op7_mixing"] = mix_sql()

ORACLE_SQL["op5_exact_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), best AS (
  SELECT query_id, vec_id, max(score) AS score FROM scored GROUP BY query_id, vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM best) WHERE rank <= 5
"""


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from muster.llm import filter_audit

    return filter_audit.audited(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: The audit step by step: each of the 120 orders is applied to every group of documents, with no use of coalitions.
ORACLE_SQL["op12_filter_audit"] = r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents
), firsts AS (
  SELECT text, min(doc_id) AS first_id FROM texts GROUP BY text
), known AS (
  SELECT doc_id, coalesce(max(CAST(quality = 1 AS INTEGER)), 0) AS good, coalesce(max(CAST(toxic = 1 AS INTEGER)), 0) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), failed AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, count(*) AS n, {
      'A': len(words) < 200, 'B': 100 * len(list_distinct(words)) < 50 * len(words),
      'C': 100 * length(regexp_replace(t.text, '[^A-Z]', '', 'g')) > 2 * length(t.text), 'D': regexp_matches(t.text, '[#$%&*|]'),
      'E': coalesce(t.doc_id > first_id, false)} AS fails
  FROM texts t LEFT JOIN firsts f ON t.text = f.text LEFT JOIN known k ON t.doc_id = k.doc_id GROUP BY ALL
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter
), orders_of AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.letter, b.letter, c.letter, d.letter, e.letter])) = 5
), steps AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, substr(filter_order, CAST(step AS INTEGER), 1) AS own FROM orders_of, range(1, 6) r(step)
), walked AS (
  SELECT part, filter_order, step, own, n, good, toxic, map_extract(m, own)[1] AS fails_own,
         len(list_filter(range(1, step), lambda i: map_extract(m, substr(filter_order, i, 1))[1])) > 0 AS gone,
         len(list_filter(range(1, 6), lambda i: map_extract(m, substr(filter_order, i, 1))[1])) AS failures
  FROM (SELECT *, map(['A', 'B', 'C', 'D', 'E'], [fails.A, fails.B, fails.C, fails.D, fails.E]) AS m FROM failed), steps
), summed AS (
  SELECT part, filter_order, step, own, sum(CASE WHEN NOT gone AND NOT fails_own THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN NOT gone AND fails_own THEN n ELSE 0 END) AS removed, sum(CASE WHEN gone AND fails_own THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails_own AND failures = 1 THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN NOT gone AND fails_own THEN n * good ELSE 0 END) AS good_lost, sum(CASE WHEN NOT gone AND fails_own THEN n * toxic ELSE 0 END) AS toxic_lost
  FROM walked GROUP BY ALL
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM summed
"""


@query
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from muster.llm import vector_codes

    return vector_codes.compressed(table(spark, sf_dir, "embeddings"))


def _codes_sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """All distances in each round."""
    nearest = lambda a, b: f"""
{a} AS MATERIALIZED (
  SELECT rid, part, CAST(min(d * {entries} + entry) % {entries} AS BIGINT) AS entry, CAST(min(d * {entries} + entry) // {entries} AS BIGINT) AS d FROM (
    SELECT p.rid, p.part, b.entry, CAST(list_sum(list_transform(list_zip(p.y, b.y), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
    FROM p JOIN {b} b ON p.part = b.part) GROUP BY rid, part)"""  # noqa: E731
    moved = lambda b, a, old: f"""
{b} AS MATERIALIZED (
  SELECT o.part, o.entry, coalesce(n.y, o.y) AS y FROM {old} o LEFT JOIN (
    SELECT part, entry, list(m ORDER BY place) AS y FROM (
      SELECT a.part, a.entry, place, CAST(floor(sum(y[place]) / count(*)) AS BIGINT) AS m
      FROM {a} a JOIN p ON a.rid = p.rid AND a.part = p.part, unnest(range(1, len(y) + 1)) u(place) GROUP BY ALL) GROUP BY part, entry
  ) n ON o.part = n.part AND o.entry = n.entry)"""  # noqa: E731
    steps = [nearest("a0", "b0")]
    for r in range(rounds):
        steps += [moved(f"b{r + 1}", f"a{r}", f"b{r}"), nearest(f"a{r + 1}", f"b{r + 1}")]
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS rid, vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS MATERIALIZED (
  SELECT rid, part, x[part * (len(x) // {parts}) + 1 : (part + 1) * (len(x) // {parts})] AS y FROM v, range({parts}) r(part)
), b0 AS (SELECT part, rid - 1 AS entry, y FROM p WHERE rid <= {entries}),{",".join(steps)},
coded AS (
  SELECT rid, string_agg(lower(lpad(to_hex(entry), 2, '0')), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY rid
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY part, entry)) FROM b{rounds}) AS codebooks_sha256
FROM coded JOIN v ON coded.rid = v.rid
"""


ORACLE_SQL["op13_vector_codes"] = _codes_sql()


@query
def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from muster.llm import quality_cnn

    return quality_cnn.predictions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))

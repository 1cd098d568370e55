"""The operators applied to the given tables: one query each, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cartograph.llm.common import LOWER, UPPER, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f
    return add


@query("op4_exact_dedup", f"""
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm)""")
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cartograph.llm.exact_dedup import exact_groups
    return (exact_groups(table(spark, sf_dir, "documents"))
            .select("doc_id", "keep_id", "group_size", "kept", "text_sha256"))


@query("op7_quality_rules", r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
wins AS (
  SELECT doc_id, i, list_slice(w, i, i + 7) AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
rep AS (
  SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS following
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS c FROM wins) WHERE c > 1),
cover AS (
  SELECT doc_id, sum(least(8, coalesce(following - i, 8)))::BIGINT AS n_repeat_words FROM rep GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines)::BIGINT AS n_lines,
         (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')))::BIGINT AS n_capitals,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN cover USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > 20 * n_words OR 100 * n_dup_lines > 30 * n_lines
            OR word_chars < 2 * n_words OR word_chars > 14 * n_words OR 100 * n_capitals > 50 * word_chars) AS kept
FROM b""")
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from cartograph.llm.quality_rules import apply_policy, policy_mask, rule_ledger
    ledger = apply_policy(rule_ledger(table(spark, sf_dir, "documents")), "v2")
    base = F.col("failed").bitwiseAND(F.lit(policy_mask("base"))) != 0
    return ledger.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         base.alias("base_failed"), "kept")


@query("op6_bpe")
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from pyspark.sql import functions as F

    from cartograph.llm.bpe import decode, encode, ids_digest
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    ids = encode(table(spark, sf_dir, "documents"), *vocabulary, keep=["doc_id"])
    return decode(ids, *vocabulary).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), ids_digest().alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op2_url_filter", rf"""
WITH u AS (SELECT page_id, CASE WHEN position('://' IN coalesce(url, '')) > 0
                                THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(rule_host, rule_path, action) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
best AS (
  SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         arg_max(action, length(rule_host || rule_path)) AS action
  FROM p JOIN r ON (host = rule_host OR host LIKE '%.' || rule_host) AND starts_with(path, rule_path)
  GROUP BY page_id)
SELECT page_id, host, path, rule,
       coalesce(action, CASE WHEN regexp_matches(host, '(^|\.)(spam-farm|cheap-pills|free-casino|adult-cams)(\.|$)')
                             THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN best USING (page_id)""")
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cartograph.llm.url_filter import judge
    return judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


@query("op9_secret_scan")
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    import uuid

    from pyspark.sql import functions as F

    from cartograph.llm.secret_scan import BASE_RULES, RULES, joined, n_of, scan
    from cartograph.session import ensure_checkpoint_dir
    ledger = f"{ensure_checkpoint_dir(spark).rstrip('/')}/secret-ledger-{uuid.uuid4().hex}"
    found = scan(table(spark, sf_dir, "documents"), ledger)
    spans = F.col("spans")
    return found.select(
        "doc_id", *[n_of(spans, k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(joined(spans, [r.kind for r in BASE_RULES]), 256).alias("base_sha256"),
        joined(spans, [r.kind for r in RULES]).alias("spans"))


@query("op10_toxicity")
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cartograph.llm.toxicity import fit, held_out, labelled_sample, score
    docs = table(spark, sf_dir, "documents")
    model = fit(labelled_sample(docs, table(spark, sf_dir, "labels")))
    return score(docs, model).select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


@query("op5_minhash")
def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cartograph.llm.minhash import near_duplicates
    return (near_duplicates(table(spark, sf_dir, "documents"))
            .select("doc_id", "n_shingles", "component_id", "kept"))


@query("op8_mixing")
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cartograph.llm.mixing import mixture
    return mixture(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op3_importance")
def op3_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    from math import ceil

    from cartograph.llm.importance import fit, resample, weigh
    docs = table(spark, sf_dir, "documents")
    ratio, share = fit(docs, table(spark, sf_dir, "labels"))
    return resample(weigh(docs, ratio), ceil(share * docs.count())).select("doc_id", "log_weight", "gumbel_key", "kept")


@query("op1_maxent_lm")
def op1_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cartograph.llm.maxent_lm import fit, score
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs)).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


_NEAREST = """
{n} AS (
  SELECT * FROM (
    SELECT row_id, vec_id, v, c, d, row_number() OVER (PARTITION BY row_id ORDER BY d, c) AS place
    FROM (SELECT k.row_id, k.vec_id, k.v, m.c,
                 list_sum(list_transform(list_zip(k.v, m.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
          FROM kept k CROSS JOIN {m} m)) WHERE place = 1)"""
_MOVED = """
{m} AS (
  SELECT o.c, coalesce(n.v, o.v) AS v
  FROM {o} o LEFT JOIN (
    SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS v
    FROM (SELECT c, i, sum(v[i])::BIGINT AS s, count(*) AS n FROM {n}, (SELECT unnest(range(1, 65)) AS i) GROUP BY c, i)
    GROUP BY c) n ON o.c = n.c)"""


@query("op11_centroids", """
WITH kept AS (
  SELECT row_number() OVER () AS row_id, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
m0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS c, v FROM kept ORDER BY sha256('1:' || vec_id) LIMIT 16),"""
       + ",".join(_NEAREST.format(n=f"a{i}", m=f"m{i}") + "," + _MOVED.format(m=f"m{i + 1}", o=f"m{i}", n=f"a{i}") for i in range(3))
       + "," + _NEAREST.format(n="a3", m="m3") + """
SELECT vec_id, a3.c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a3.c))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(m3.v, ',')) AS centroid_sha256
FROM a3 JOIN m3 ON a3.c = m3.c""")
def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cartograph.llm.centroids import cluster, with_inertia
    return with_inertia(*cluster(table(spark, sf_dir, "embeddings"))).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


@query("op13_spelling")
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cartograph.llm.spelling import variants
    return variants(table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


@query("op12_packing")
def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from cartograph.llm.packing import pack, with_crc
    return with_crc(pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                         ranks=public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern=public_tokenizers.PATTERN)).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")

"""Registered queries of this package: ``QUERIES`` and ``ORACLE``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayflow.llm import (
    bpe, chat, mixing, pii, prefix_trie, quality_rules, rule_ensemble, secret_scan, simhash, topk,
    toxicity, url_filter, whitening,
)
from dayflow.llm.common import crc_fold
from dayflow.session import materialize
from dayflow.sources.tables import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def deco(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql.strip()
        return fn
    return deco


def held_out():
    return (crc_fold(F.col("doc_id")) == 1).alias("held_out")


def ranks_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@query()
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    coded = docs.select("doc_id", bpe.encode(spark, F.col("text"), ranks_path(), decoded=True)
                        .alias("e"))
    return coded.select(
        "doc_id", bpe.n_tokens(F.col("e.ids")).alias("n_tokens"),
        F.sha2(F.col("e.ids"), 256).alias("ids_sha256"),
        F.sha2(F.col("e.decoded"), 256).alias("decoded_sha256"),
        (F.octet_length("e.piece_chars") / 4).cast("bigint").alias("n_pieces"))


@query()
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    found = docs.select("doc_id", secret_scan.spans(F.col("text")).alias("found"))
    count = lambda kind: F.size(F.filter(
        "found", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[count(k) for k in secret_scan.KINDS],
        F.sha2(secret_scan.spans_text(F.col("found"), secret_scan.BASE_KINDS), 256)
        .alias("base_sha256"),
        secret_scan.spans_text(F.col("found")).alias("spans"))


# Fixed values of the contract: the extra conversation and the url rules.
EXTRA_CONV, EXTRA_ROLES = -7, ("user", "assistant")
EXTRA_TEXT = r"\### Assistant: </turn> ok"
URL_RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"),
             ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
             ("net", "/fr/", "block"))


def constant_rows(spark: SparkSession, names: str, rows: tuple) -> DataFrame:
    """A small frame of literals."""
    return spark.range(1).select(F.inline(F.array(*[
        F.struct(*[F.lit(v).alias(n) for n, v in zip(names.split(), row)]) for row in rows])))


OP5_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
sized AS (
  SELECT *, length(replace(replace(text, '\', '\b'), '<', '\l')) + length(role) + 15 AS n
  FROM rows)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  sum(n)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""


@query(OP5_SQL)
def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = constant_rows(spark, "conv_id turn role text", tuple(
        (EXTRA_CONV, k, role, EXTRA_TEXT) for k, role in enumerate(EXTRA_ROLES)))
    formatted = chat.format_conversations(rows.unionByName(extra))
    read = chat.read_back(formatted)
    joined = lambda f: F.array_join(F.transform("read", f), "")
    turns = joined(lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = joined(lambda t: F.coalesce(t["loss_text"], F.lit("")))
    return read.withColumn("loss", loss).select(
        "conv_id", F.size("read").cast("bigint").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))


OP6_SQL = r"""
WITH cut AS (
  SELECT page_id, coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), '') AS h,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path FROM pages),
parts AS (
  SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
    AS host, path FROM cut),
rules(rule_host, rule_path, verdict) AS (VALUES ('com', '/', 'allow'),
  ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fits AS (
  SELECT page_id, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
         max_by(verdict, length(rule_host || rule_path)) AS verdict
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
    AND starts_with(path, rule_path) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN fits USING (page_id)
"""


@query(OP6_SQL)
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load(spark, sf_dir, "pages").select("page_id", "url")
    rules = constant_rows(spark, "host path verdict", URL_RULES)
    return url_filter.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


OP7_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER
    AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query(OP7_SQL)
def op7_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = load(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, F.pmod("vec_id", F.lit(100)) == 0, k=10)


OP8_SQL = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[ 	-
]+'), lambda x: x <> '') AS w,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')) AS l FROM t),
g AS (SELECT r, unnest(range(len(w) - 2)) AS i, w FROM w WHERE len(w) > 2),
k AS (SELECT r, i, w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] AS k FROM g),
twice AS (SELECT r, i FROM k QUALIFY count(*) OVER (PARTITION BY r, k) > 1),
covered AS (SELECT r, count(DISTINCT i + o) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS o)
  GROUP BY r),
s AS (SELECT doc_id, len(w)::BIGINT AS n_words,
  coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
  (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
  (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
  coalesce(n, 0)::BIGINT AS n_repeat_words,
  length(text) - length(replace(text, '!', '')) AS shouts,
  len(list_filter(w, lambda x: list_contains([{stop}], lower(x)))) AS stops, len(l) AS lines,
  len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)[ 	-
]*$'))) AS dots,
  len(list_filter(l, lambda x: regexp_matches(x, '^[ 	-
]*[-*•][ 	-
]'))) AS bullets
  FROM w LEFT JOIN covered USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 100 * word_chars BETWEEN 200 * n_words AND 1500 * n_words
  AND 100 * n_symbols <= 30 * n_words AND 100 * shouts <= 30 * n_words
  AND 100 * stops >= 5 * n_words AND 100 * dots <= 50 * lines AND 100 * bullets <= 90 * lines
  AND 100 * n_dup_lines <= 60 * lines AS kept
FROM b
""".replace("{stop}", ", ".join(f"'{w}'" for w in quality_rules.ALL_STOP_WORDS))


@query(OP8_SQL)
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    q = F.col("quality_rules")
    return quality_rules.judge(docs, "text", "quality_rules").select(
        "doc_id", *[q[c].alias(c) for c in (
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "base_failed", "kept")])


@query()
def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs, weights=(5, 2, 1), max_epochs=3)


@query()
def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select(
        "doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


@query()
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    model = rule_ensemble.fit(docs, load(spark, sf_dir, "labels"), "quality")
    return rule_ensemble.score(docs, model, "text", "score").select(
        "doc_id", held_out(), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query()
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, load(spark, sf_dir, "labels"), "toxic")
    scored = docs.select("doc_id", toxicity.score(spark, F.col("text"), model).alias("score"))
    return scored.select("doc_id", held_out(), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


# Checked by definition: every prefix as a list of turns, ancestors by cutting it.
OP11_SQL = r"""
WITH own AS (
  SELECT conv_id AS c, list({'r': coalesce(role, ''), 't': coalesce(text, '')}
    ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS t
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
crc AS (
  SELECT c, t, c - c % 20 AS base, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
      lambda x, i: xor(x >> 1, (x & 1) * 3988292384)))) % 4 AS h FROM own),
built AS (
  SELECT a.c, list_concat(coalesce(b.t, [])[1:a.h], a.t[a.h + 1:]) AS t
  FROM crc a LEFT JOIN own b ON b.c = a.base),
member AS (SELECT c, t, unnest(range(len(t) + 1)) AS d FROM built),
node AS (
  SELECT t[1:d] AS p, d, count(*) AS n, min(c) AS c,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len(t) = d), '')) AS ends
  FROM member GROUP BY 1, 2),
child AS (SELECT p[1:d - 1] AS p, d - 1 AS d, count(*) AS k FROM node WHERE d > 0 GROUP BY 1, 2),
w AS (
  SELECT node.*, coalesce(k, 0) AS k, CASE WHEN node.d = 0 THEN 0 ELSE (n - 1) * len(list_filter(
    regexp_split_to_array(node.p[node.d].t, '[ 	-
]+'), lambda x: x <> '')) END AS s
  FROM node LEFT JOIN child ON child.p = node.p AND child.d = node.d),
below AS (SELECT p, k, s, unnest(range(d + 1)) AS a FROM w),
total AS (
  SELECT p[1:a] AS p, a AS d, count(*) FILTER (k = 0) AS leaves, sum(s) AS saved
  FROM below GROUP BY 1, 2)
SELECT w.c AS conv_id, w.d AS depth, up.c AS parent_conv_id, w.n AS n_convs, w.k AS n_children,
  total.leaves AS n_leaves, total.saved::BIGINT AS saved_tokens, w.ends AS ends_sha256
FROM w JOIN total ON total.p = w.p AND total.d = w.d
  LEFT JOIN node up ON up.d = w.d - 1 AND up.p = w.p[1:w.d - 1]
"""


@query(OP11_SQL)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = load(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = materialize(prefix_trie.turn_arrays(turns), "op11-turns")
    base = own.filter("conv % 20 = 0").select(
        F.col("conv").alias("base"), F.slice("turns", 1, 3).alias("head"))
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % 4).cast("int")
    head = F.coalesce("head", F.array())
    rebuilt = (own.join(base, F.col("conv") - F.col("conv") % 20 == F.col("base"), "left")
               .select("conv", F.concat(F.slice(head, F.lit(1), h), F.slice(
                   "turns", h + 1, F.greatest(F.size("turns"), F.lit(1)))).alias("turns")))
    return prefix_trie.expand(prefix_trie.build(spark, rebuilt))


@query()
def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    model = pii.fit(docs)
    found = docs.select("doc_id", pii.spans(F.col("text"), model).alias("found"))
    count = lambda kind: F.size(F.filter(
        "found", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[count(k) for k in pii.BASE_KINDS],
        F.sha2(pii.spans_text(F.col("found"), pii.BASE_KINDS), 256).alias("base_sha256"),
        pii.spans_text(F.col("found")).alias("spans"))


@query()
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = load(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    rows, model, error = whitening.whiten(vectors, components=16)
    explained = F.array(*map(F.lit, model.explained)) if model.n else F.array()
    return (rows.select("vec_id", F.col("whitening.deviation").cast("bigint").alias("deviation"),
                        F.posexplode("whitening.values").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).cast("int").alias("component"),
                    F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened",
                    F.get(explained.cast("array<double>"), F.col("at")).alias("explained"),
                    F.lit(error).alias("identity_error")))

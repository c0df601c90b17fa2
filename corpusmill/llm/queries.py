"""The registered queries of this package and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import chat, class_lm, collocations, langid, pieces, pivots, quality, secrets, tiling, training_order, url_filter, whitening
from corpusmill.llm.near_dedup import near_duplicates
from corpusmill.sources.staging import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file on the driver; its contents are sent to the tasks."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = class_lm.in_part("doc_id", 7)
    model = class_lm.fit(docs.where(~held_out))
    return class_lm.score(docs.withColumn("held_out", held_out), model)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = pieces.load(tokenizer_path("piece_bpe_32k.model"))
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = pieces.round_trip(docs, model)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


MARKED = r"\### Assistant: </turn> ok"

OP3_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
sized AS (
  SELECT *, 14 + length(role) + length(regexp_replace(role, '[^\\<#:]', '', 'g'))
         + length(text) + length(regexp_replace(text, '[^\\<#]', '', 'g')) AS chars,
         row_number() OVER w = count(*) OVER (PARTITION BY conv_id) AS is_last
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
summed AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS prefix
  FROM sized)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(prefix) FILTER (role = 'assistant' OR is_last) AS BIGINT) AS formatted_chars
FROM summed GROUP BY conv_id"""


def op3_chat_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(MARKED).alias("text"),
    )
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(marked)
    found = chat.examples(rows).select(
        "conv_id", "example", F.length("text").alias("chars"),
        chat.read_trained(F.col("text"), F.col("loss_start"), F.col("loss_chars")).alias("trained"),
        F.when(F.col("complete"), chat.read_turns(F.col("text"))).alias("turns"),
    )
    line = F.lit("\n")
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], line, t["text"], line)), "")
    found = found.select("conv_id", "example", "chars", "trained", F.size("turns").alias("n"), F.sha2(told, 256).alias("told"))
    ordered = F.sort_array(F.collect_list(F.struct("example", "trained")))
    loss = F.array_join(F.transform(ordered, lambda x: x["trained"]), "")
    whole = found.groupBy("conv_id").agg(
        F.max("n").cast("long").alias("n_turns"), F.max("told").alias("turns_sha256"), loss.alias("loss"),
        F.sum("chars").alias("formatted_chars"),
    )
    return whole.select(
        "conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
    )


def op4_greedy_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = tiling.contamination(docs, _table(spark, sf_dir, "benchmark")).select("doc_id", F.explode("matches").alias("m"))
    return found.select(
        "doc_id", "m.item_id", F.round("m.coverage", 9).alias("coverage"), "m.item_tokens",
        F.size("m.tiles").alias("n_tiles"), F.array_max(F.col("m.tiles.tokens")).alias("longest"),
    )


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = class_lm.in_part("doc_id", 4)
    profiles = langid.learn(docs.where(~held_out))
    found = langid.predict(docs.select("doc_id", "text"), profiles)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op6_secret_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find(_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "secrets")
    names = F.array(*[F.lit(k) for k in secrets.KINDS])

    def listed(spans):
        shown = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"]))
        return F.array_join(shown, ",")

    def count(kind: int):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("secrets", lambda s: s["kind"] < 3)
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("secrets")).alias("spans"),
    )


OP7_SQL = """
WITH whole AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.row AS row, q.vec_id AS query_id, x.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, x.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM whole q JOIN whole x ON q.vec_id % 100 = 0 AND q.vec_id <> x.vec_id AND len(q.v) = len(x.v)),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10"""


def op7_pivot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = pivots.integer_vectors(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return pivots.top_k(vectors, vectors.where("vec_id % 100 = 0"), k=10)


STRIDE = 512


def op8_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of all texts as tokens, written to shards and read back from them."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.col("text").cast("binary").alias("text"))
    out = scratch_path(spark, "token-shards")
    out = out if "://" in out else f"file://{out}"
    index, _ = training_order.materialise(docs, "text", out, length=STRIDE, key=20_260_101, stable=True)
    back = training_order.read_back(index, out, STRIDE)
    return back.select("doc_id", "chunk", "slot", "shard", "offset", F.xxhash64("payload").alias("payload_hash"))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs, k=3, percent=85).drop("text", "first")


def op10_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    held_out = class_lm.in_part("doc_id", 4)
    model = quality.fit(docs, _table(spark, sf_dir, "labels").where(~held_out))
    found = quality.score(docs, model).select("doc_id", held_out.alias("held_out"), F.col("quality_score").alias("score"))
    return found.withColumn("predicted", F.when(F.col("score") >= 0.7, 1).otherwise(0))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found, model, error = whitening.whiten(rows, "embedding", wanted=32)
    shares = whitening.explained(model) if len(model.values) else F.array().cast("array<double>")
    listed = found.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return listed.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )


URL_RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
UNWANTED = r"(^|[.-])(adult|ads|bets|casino|pills|spam)([.-]|$)"

OP12_SQL = rf"""
WITH cut AS (
  SELECT page_id, coalesce(substring(url, strpos(url, '://') + 3), '') AS rest FROM pages WHERE strpos(url, '://') > 0
  UNION ALL SELECT page_id, '' FROM pages WHERE url IS NULL OR strpos(url, '://') = 0),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '^[^?#]*\?([^#]*)', 1) AS asked FROM cut),
kept AS (
  SELECT *, array_to_string(list_sort(list_filter(string_split(asked, '&'),
           lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|gclid|fbclid)='))), '&') AS params,
         regexp_replace(regexp_replace(regexp_replace(host, '^[^@]*@', ''), '(:(80|443)?)?$', ''), '^www\.', '') AS name,
         regexp_replace(regexp_replace(path, '/+', '/', 'g'), '/$', '') AS place
  FROM parts),
keyed AS (
  SELECT page_id, host, path, CASE WHEN name <> '' THEN name || place || CASE WHEN params <> '' THEN '?' || params ELSE '' END END AS key
  FROM kept),
listed AS (SELECT DISTINCT key FROM keyed WHERE regexp_matches(host, '{UNWANTED}') AND key IS NOT NULL),
rules(rule_host, rule_path, decision) AS (
  VALUES {', '.join(str(r) for r in URL_RULES)}),
fitting AS (
  SELECT page_id, host, path, key, r.rule_host || r.rule_path AS rule, decision FROM keyed LEFT JOIN rules r
  ON (host = r.rule_host OR ends_with(host, '.' || r.rule_host)) AND starts_with(path, r.rule_path)),
best AS (
  SELECT * FROM fitting QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC NULLS LAST, rule) = 1)
SELECT page_id, host, path, rule, coalesce(decision, CASE WHEN listed.key IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM best LEFT JOIN listed USING (key)"""


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list holds the URLs of hosts with a name that is not wanted, as the same table has them."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    listed = pages.where(url_filter.host(F.col("url")).rlike(UNWANTED))
    return url_filter.judge(pages, listed, URL_RULES).drop("url")


OP13_SQL = r"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
pieces AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts),
words AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
one AS (SELECT lang, a1, count(*) AS c FROM (SELECT lang, unnest(w) AS a1 FROM words) GROUP BY ALL),
two AS (
  SELECT lang, w[i] AS a1, w[i + 1] AS a2, count(*) AS c FROM (SELECT lang, w, unnest(range(1, len(w))) AS i FROM words) GROUP BY ALL),
three AS (
  SELECT lang, w[i] AS a1, w[i + 1] AS a2, w[i + 2] AS a3, count(*) AS c
  FROM (SELECT lang, w, unnest(range(1, len(w) - 1)) AS i FROM words) GROUP BY ALL HAVING count(*) >= 10),
wider AS (
  SELECT lang, a1, a2, max(c) AS most FROM (
    SELECT lang, a1, a2, c FROM three UNION ALL SELECT lang, a2, a3, c FROM three) GROUP BY ALL),
cuts AS (
  SELECT t.lang, t.a1 || ' ' || t.a2 AS phrase, t.c AS a, 1 AS k, x.c AS l, y.c AS r
  FROM two t JOIN one x ON t.lang = x.lang AND t.a1 = x.a1 JOIN one y ON t.lang = y.lang AND t.a2 = y.a1
  LEFT JOIN wider v ON t.lang = v.lang AND t.a1 = v.a1 AND t.a2 = v.a2
  WHERE t.c >= 10 AND (v.most IS NULL OR 100 * v.most < 50 * t.c)
  UNION ALL
  SELECT t.lang, t.a1 || ' ' || t.a2 || ' ' || t.a3, t.c, 1, x.c, y.c
  FROM three t JOIN one x ON t.lang = x.lang AND t.a1 = x.a1 JOIN two y ON t.lang = y.lang AND t.a2 = y.a1 AND t.a3 = y.a2
  UNION ALL
  SELECT t.lang, t.a1 || ' ' || t.a2 || ' ' || t.a3, t.c, 2, x.c, y.c
  FROM three t JOIN two x ON t.lang = x.lang AND t.a1 = x.a1 AND t.a2 = x.a2 JOIN one y ON t.lang = y.lang AND t.a3 = y.a1),
scored AS (
  SELECT *, CAST((CAST(a AS HUGEINT) * a * 1000000) // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cuts
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY (CAST(a AS HUGEINT) * a * 1000000) // (CAST(l AS HUGEINT) * r), k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM scored JOIN totals USING (lang) QUALIFY rank <= 2000"""


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents").select("text", "lang"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_class_lm, op2_sentencepiece, op3_chat_prefix_targets, op4_greedy_tiling, op5_language_id, op6_secret_network,
        op7_pivot_top_k, op8_training_order, op9_minhash_near_dedup, op10_factorisation_machine,
        op11_whitening, op12_url_filter, op13_collocations,
    ]
    return {q.__name__: q for q in found}


def oracle_sql() -> dict[str, str]:
    return {"op3_chat_prefix_targets": OP3_SQL, "op7_pivot_top_k": OP7_SQL, "op12_url_filter": OP12_SQL, "op13_collocations": OP13_SQL}

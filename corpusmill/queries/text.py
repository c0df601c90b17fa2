"""Text functions, normalisation and lemma lookup over the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusmill.functions import text as tx
from corpusmill.operators import clean
from corpusmill.operators.rows import explode_values
from corpusmill.plans import corpus
from corpusmill.queries import views as v
from corpusmill.queries.registry import query
from corpusmill.queries.tables import V_COPIES
from corpusmill.sources.staging import stage

NORMAL = v.NORMALIZED.format("text")

# The contraction split as SQL, from the same fixed table.
_CASES = " ".join(f"WHEN '{w}' THEN ['{a}', '{b}']" for w, (a, b) in tx.CONTRACTIONS.items())
V_TOKENS = f"""v_tokens AS (
  SELECT doc_id AS unique_id, text AS body,
         flatten(list_transform(list_filter(string_split({NORMAL}, ' '), lambda t: t <> ''),
                 lambda t: CASE t {_CASES} ELSE [t] END)) AS tokens FROM documents)"""
V_KEPT = f"""{V_TOKENS}, v_kept AS (
  SELECT unique_id, body, list_filter(tokens, lambda t: t NOT IN (@STOPWORDS@)) AS tokens FROM v_tokens)"""

# A lexicon made from the corpus by suffix rules.
V_LEXICON = f"""{V_KEPT}, v_words AS (
  SELECT DISTINCT token FROM (SELECT unnest(tokens) AS token FROM v_kept) WHERE length(token) >= 5),
v_lexicon AS (
  SELECT token, CASE WHEN token LIKE '%able' THEN 'JJ' WHEN token LIKE '%ly' THEN 'RB'
                     WHEN token LIKE '%ing' THEN 'VBG' WHEN token LIKE '%s' THEN 'NNS' ELSE 'IN' END AS tag FROM v_words),
v_classes AS (
  SELECT token, tag, CASE left(tag, 1) WHEN 'J' THEN 'a' WHEN 'V' THEN 'v' WHEN 'N' THEN 'n' WHEN 'R' THEN 'r'
                     ELSE 'n' END AS class FROM v_lexicon),
v_lemmas AS (
  SELECT token, 'v' AS class, left(token, length(token) - 3) AS lemma FROM v_words WHERE token LIKE '%ing'
  UNION ALL SELECT token, 'n', left(token, length(token) - 1) FROM v_words WHERE token LIKE '%s'),
v_map AS (SELECT c.token, m.lemma FROM v_classes c JOIN v_lemmas m ON c.token = m.token AND c.class = m.class),
v_long AS (
  SELECT unique_id, unnest(tokens) AS token, unnest(range(1, len(tokens) + 1)) AS pos FROM v_kept),
v_lemmatized AS (
  SELECT unique_id, string_agg(coalesce(m.lemma, l.token), ' ' ORDER BY pos) AS lemmas
  FROM v_long l LEFT JOIN v_map m ON l.token = m.token GROUP BY unique_id)"""


def _documents(spark, d):
    return v.documents(spark, d).select(F.col("doc_id").alias("unique_id"), F.col("text").alias("body"))


def _kept(spark, d):
    words = tx.remove_stopwords(tx.tokenize("body"), v.stopwords())
    return _documents(spark, d).select("unique_id", "body", words.alias("tokens"))


def _kept_stage(spark, d):
    return stage(_kept(spark, d), "kept-words")


def lexicon_tables(texts):
    """(token, tag) and (token, class, lemma) by suffix rules from the corpus words."""
    words = explode_values(texts, [], "tokens", "token").where(F.char_length("token") >= 5)
    words = stage(words.distinct(), "words")
    token = F.col("token")
    tag = (
        F.when(token.endswith("able"), "JJ").when(token.endswith("ly"), "RB")
        .when(token.endswith("ing"), "VBG").when(token.endswith("s"), "NNS").otherwise("IN")
    )
    lexicon = words.select("token", tag.alias("tag"))
    verbs = words.where(token.endswith("ing")).select(
        "token", F.lit("v").alias("class"), F.expr("left(token, length(token) - 3)").alias("lemma"))
    nouns = words.where(token.endswith("s")).select(
        "token", F.lit("n").alias("class"), F.expr("left(token, length(token) - 1)").alias("lemma"))
    return lexicon, verbs.unionByName(nouns)


@query("collapse_whitespace", f"SELECT doc_id, regexp_replace(text, '{tx.SPACE_RUN}', ' ', 'g') AS text FROM documents")
def collapse_whitespace(spark, d):
    return v.documents(spark, d).select("doc_id", tx.collapse_whitespace("text").alias("text"))


@query("text_normalize", f"SELECT doc_id, {NORMAL} AS text FROM documents")
def text_normalize(spark, d):
    return v.documents(spark, d).select("doc_id", tx.normalize_text("text").alias("text"))


@query("tokenize", f"WITH {V_TOKENS} SELECT unique_id, array_to_string(tokens, ' ') AS tokens FROM v_tokens")
def tokenize(spark, d):
    tokens = F.array_join(tx.tokenize("body"), " ").alias("tokens")
    return _documents(spark, d).select("unique_id", tokens)


@query("remove_stopwords", f"WITH {V_KEPT} SELECT unique_id, array_to_string(tokens, ' ') AS tokens FROM v_kept")
def remove_stopwords(spark, d):
    return _kept(spark, d).select("unique_id", F.array_join("tokens", " ").alias("tokens"))


@query("pos_to_lexical_class", f"WITH {V_LEXICON} SELECT token, tag, class FROM v_classes")
def pos_to_lexical_class(spark, d):
    lexicon, _ = lexicon_tables(_kept(spark, d))
    return lexicon.select("token", "tag", tx.lexical_class("tag").alias("class"))


@query("lemma_lookup", f"""WITH {V_LEXICON} SELECT k.unique_id, coalesce(l.lemmas, '') AS tokens
FROM v_kept k LEFT JOIN v_lemmatized l ON k.unique_id = l.unique_id""")
def lemma_lookup(spark, d):
    texts = _kept_stage(spark, d)
    looked_up = clean.lemma_lookup(texts.drop("body"), "tokens", *lexicon_tables(texts))
    return looked_up.select("unique_id", F.array_join("tokens", " ").alias("tokens"))


@query("normalize_or_original", f"""WITH {V_KEPT} SELECT unique_id,
CASE WHEN len(tokens) = 0 THEN body ELSE array_to_string(tokens, ' ') END AS cleaned_body FROM v_kept""")
def normalize_or_original(spark, d):
    cleaned = clean.normalize_or_original(F.array_join("tokens", " "), F.col("body"))
    return _kept(spark, d).select("unique_id", cleaned.alias("cleaned_body"))


@query("clean_corpus", f"""WITH {V_LEXICON} SELECT k.body, k.unique_id,
CASE WHEN len(k.tokens) = 0 THEN k.body ELSE l.lemmas END AS cleaned_body
FROM v_kept k LEFT JOIN v_lemmatized l ON k.unique_id = l.unique_id""")
def clean_corpus(spark, d):
    return clean.clean_corpus(_documents(spark, d), v.stopwords(), *lexicon_tables(_kept(spark, d)))


@query("item_set", f"SELECT doc_id, array_to_string({v.items_sql('text')}, ' ') AS items FROM documents")
def item_set(spark, d):
    items = tx.item_set(tx.normal_words("text"), v.stopwords())
    return v.documents(spark, d).select("doc_id", F.array_join(items, " ").alias("items"))


@query("itemset_to_string", f"SELECT doc_id, array_to_string({v.items_sql('text')}, ' - ') AS name FROM documents")
def itemset_to_string(spark, d):
    items = tx.item_set(tx.normal_words("text"), v.stopwords())
    return v.documents(spark, d).select("doc_id", tx.itemset_to_string(items).alias("name"))


TERM_TOKENS_SQL = f"list_filter(string_split({v.NORMALIZED}, ' '), lambda t: length(t) >= 2 AND t NOT IN (@STOPWORDS@))"
NGRAMS_SQL = (
    "list_concat(tok, list_concat("
    "list_transform(range(1, len(tok)), lambda i: tok[i] || ' ' || tok[i + 1]), "
    "list_transform(range(1, len(tok) - 1), lambda i: tok[i] || ' ' || tok[i + 1] || ' ' || tok[i + 2])))"
)


@query("ngrams_1_3", f"""WITH t AS (SELECT doc_id, {TERM_TOKENS_SQL.format('text')} AS tok FROM documents)
SELECT doc_id, array_to_string({NGRAMS_SQL}, '|') AS terms FROM t""")
def ngrams_1_3(spark, d):
    tokens = v.documents(spark, d).select("doc_id", tx.term_tokens("text", v.stopwords()).alias("tok"))
    return tokens.select("doc_id", F.array_join(tx.ngrams_up_to("tok", 3), "|").alias("terms"))


# --- the corpus build ------------------------------------------------------------------------

CATEGORIES = ("src0", "src1", "src2", "src3", "src4")
_BODY = v.NORMALIZED.format("body")
V_BUILT = f"""{V_LEXICON}, {V_COPIES}, v_keyed AS (
  SELECT row_id, subreddit, title, regexp_replace(body, '{tx.SPACE_RUN}', ' ', 'g') AS body, label,
         row_number() OVER (ORDER BY CASE WHEN n_copies > 1 AND words > 5 THEN 1 ELSE 0 END, row_id) - 1 AS unique_id
  FROM v_copies WHERE n_copies = 1 OR words <= 5 OR rn = 1),
v_chosen AS (
  SELECT * FROM v_keyed WHERE title IS NOT NULL AND label IS NOT NULL AND subreddit IN {CATEGORIES}),
v_split AS (
  SELECT unique_id, list_filter(flatten(list_transform(list_filter(string_split({_BODY}, ' '), lambda t: t <> ''),
         lambda t: CASE t {_CASES} ELSE [t] END)), lambda t: t NOT IN (@STOPWORDS@)) AS tokens FROM v_chosen),
v_put AS (
  SELECT unique_id, unnest(tokens) AS token, unnest(range(1, len(tokens) + 1)) AS pos FROM v_split),
v_said AS (
  SELECT unique_id, string_agg(coalesce(m.lemma, p.token), ' ' ORDER BY pos) AS lemmas
  FROM v_put p LEFT JOIN v_map m ON p.token = m.token GROUP BY unique_id)"""


@query("build_corpus", f"""WITH {V_BUILT}
SELECT row_id, subreddit, title, body, CAST(label AS BIGINT) AS label, unique_id, coalesce(lemmas, body) AS cleaned_body
FROM v_chosen LEFT JOIN v_said USING (unique_id)""")
def build_corpus(spark, d):
    """Raw posts to the final corpus: cleaned, de-duplicated, keyed, filtered and normalised."""
    lexicon, lemmas = lexicon_tables(_kept(spark, d))
    return corpus.build_corpus(v.posts(spark, d), v.stopwords(), lexicon, lemmas, CATEGORIES)

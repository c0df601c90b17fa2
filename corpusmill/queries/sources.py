"""Scans, sinks and stores: every table is written out and read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.operators import models
from corpusmill.operators.aggregates import value_counts
from corpusmill.operators.clusters import Clusters
from corpusmill.operators.features import vector_unwrap
from corpusmill.queries import views as v
from corpusmill.queries.registry import query
from corpusmill.sources import chunks, delimited, stores
from corpusmill.sources.staging import materialize_or_load, scratch_path


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


LONG, STRING = T.LongType(), T.StringType()
DOCUMENTS = _schema(doc_id=LONG, text=STRING, lang=STRING, source=STRING, n_chars=LONG)
BODIES = _schema(body=STRING, unique_id=LONG)
POSTS = _schema(
    row_id=LONG, subreddit=STRING, title=STRING, body=STRING, upvotes=LONG, created_utc=LONG, num_comments=LONG,
    label=T.IntegerType(),
)
ALL_DOCUMENTS = "SELECT doc_id, text, lang, source, n_chars FROM documents"
ALL_POSTS = f"WITH {v.V_POSTS} SELECT * FROM v_posts"


def _bodies(spark, d):
    return v.table(spark, d, "documents").select(F.col("text").alias("body"), F.col("doc_id").alias("unique_id"))


@query("scan_csv", ALL_DOCUMENTS)
def scan_csv(spark, d):
    path = scratch_path(spark, "csv")
    delimited.write_delimited(v.table(spark, d, "documents"), path, sep=",")
    return delimited.read_csv(spark, path, DOCUMENTS, ranges=True)


@query("scan_tsv_gz", ALL_DOCUMENTS)
def scan_tsv_gz(spark, d):
    path = scratch_path(spark, "tsv-gz")
    delimited.write_delimited(v.table(spark, d, "documents"), path, gzip=True)
    return delimited.read_tsv(spark, path, DOCUMENTS, partitions=8)


@query("scan_tsv_plain", ALL_DOCUMENTS)
def scan_tsv_plain(spark, d):
    path = scratch_path(spark, "tsv")
    delimited.write_delimited(v.table(spark, d, "documents"), path)
    return delimited.read_tsv(spark, path, DOCUMENTS, ranges=True)


@query("scan_tsv_headerless", "SELECT text AS body, doc_id AS unique_id FROM documents")
def scan_tsv_headerless(spark, d):
    path = scratch_path(spark, "tsv-headerless")
    delimited.write_delimited(_bodies(spark, d), path, header=False, gzip=True)
    return delimited.read_tsv_headerless(spark, path, BODIES)


@query("sink_tsv_gz", ALL_POSTS)
def sink_tsv_gz(spark, d):
    path = scratch_path(spark, "posts-gz")
    delimited.write_delimited(v.posts(spark, d), path, gzip=True)
    return delimited.read_tsv(spark, path, POSTS)


@query("sink_tsv_plain", ALL_POSTS)
def sink_tsv_plain(spark, d):
    path = scratch_path(spark, "posts")
    delimited.write_delimited(v.posts(spark, d), path, header=False)
    return delimited.read_tsv_headerless(spark, path, POSTS, ranges=True)


@query("partition_split", """
SELECT CAST(floor(doc_id / greatest(1, ceil(n / 100.0))) AS INTEGER) AS chunk, count(*) AS n_rows
FROM documents, (SELECT count(*) AS n FROM documents) GROUP BY 1""")
def partition_split(spark, d):
    path = scratch_path(spark, "chunks")
    chunks.partition_split(_bodies(spark, d), path, parts=100)
    written = chunks.partition_merge(spark, path, BODIES)
    return written.groupBy("chunk").agg(F.count(F.lit(1)).alias("n_rows"))


@query("partition_merge", "SELECT text AS body, doc_id AS unique_id FROM documents")
def partition_merge(spark, d):
    path = scratch_path(spark, "chunks")
    chunks.partition_split(_bodies(spark, d), path, parts=100)
    return chunks.partition_merge(spark, path, BODIES).drop("chunk").orderBy("unique_id")


@query("materialize_or_load", "SELECT source, count(*) AS cnt FROM documents GROUP BY source")
def materialize(spark, d):
    path = scratch_path(spark, "source-counts")
    first = materialize_or_load(spark, path, lambda: value_counts(v.table(spark, d, "documents"), "source"), {"by": "source"})
    # The second call finds the stage and does not build it again.
    return materialize_or_load(spark, path, lambda: first.limit(0), {"by": "source"})


@query("vector_store", f"""WITH {v.V_VEC}
SELECT unique_id, label, pos, round(CAST(embedding[pos] AS DOUBLE), 6) AS value
FROM (SELECT *, CAST(unnest(range(1, len(embedding) + 1)) AS INTEGER) AS pos FROM v_vec)""")
def vector_store(spark, d):
    path = scratch_path(spark, "vectors")
    stores.save_vectors(v.vectors(spark, d), path)
    loaded = stores.load_vectors(spark, path).select("unique_id", "label", F.posexplode("embedding").alias("pos", "value"))
    return loaded.select(
        "unique_id", "label", (F.col("pos") + 1).alias("pos"), F.round(F.col("value").cast("double"), 6).alias("value")
    )


@query("model_store")
def model_store(spark, d):
    path = scratch_path(spark, "kmeans")
    data = vector_unwrap(v.vectors(spark, d).drop("cluster"), "embedding")
    stores.save_model(models.kmeans_fit(data, 3, n_init=10), path)
    return stores.load_model(Clusters, path).transform(data).select("unique_id", "label", "cluster")


@query("itemset_store", f"""WITH {v.V_ALL}
SELECT unique_id, label, array_to_string({v.items_sql('body')}, ' ') AS items FROM v_all""")
def itemset_store(spark, d):
    path = scratch_path(spark, "itemsets")
    stores.save_itemsets(v.all_baskets(spark, d), path)
    return stores.load_itemsets(spark, path).withColumn("items", F.array_join("items", " "))

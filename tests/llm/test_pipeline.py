from __future__ import annotations

import random

import corpus_pipeline


def words(rng, n):
    return " ".join("".join(rng.choice("abdeiklmnorstu") for _ in range(rng.randrange(3, 8))) for _ in range(n))


def test_stages_keep_clean_documents_and_drop_the_rest(spark, documents, tmp_path):
    rng = random.Random(7)
    clean = [words(rng, 80) for _ in range(12)]
    passage = words(rng, 30)
    near = clean[3].split()
    near[40] = "changed"
    texts = clean + [clean[0], " ".join(near), f"{words(rng, 40)} {passage} {words(rng, 40)}", "123 456", None, "",
                     f'{words(rng, 50)} token = "{"0123456789abcdef" * 3}" {words(rng, 5)}']
    documents(texts).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept, columns = {}, docs.columns
    for name, work in corpus_pipeline.STAGES:
        docs = work(spark, docs, str(tmp_path))
        kept[name] = {r["doc_id"]: r for r in docs.collect()}
        assert name == "tokenise" or docs.columns == columns
    everyone = set(range(len(texts)))
    assert everyone - set(kept["language_id"]) == {15, 16, 17}
    assert set(kept["language_id"]) - set(kept["near_dedup"]) == {12, 13}
    assert set(kept["near_dedup"]) - set(kept["decontaminate"]) == {14}
    assert set(kept["scan_secrets"]) == set(kept["decontaminate"]) == set(kept["tokenise"]) == {*range(12), 18}
    assert "[secret]" in kept["scan_secrets"][18]["text"] and kept["scan_secrets"][18]["n_chars"] == len(kept["scan_secrets"][18]["text"])
    assert all(kept["scan_secrets"][i]["text"] == texts[i] for i in range(12))
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in kept["tokenise"].values())


def test_run_equals_the_stages_one_by_one(spark, documents, tmp_path):
    rng = random.Random(8)
    documents([words(rng, 30) for _ in range(5)]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 5


def test_every_stage_takes_odd_rows(spark, odd, tmp_path):
    spark.createDataFrame([(1, None), (None, "the cat sat on the mat")], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    for rows in (odd, odd.limit(0)):
        for _, work in corpus_pipeline.STAGES:
            work(spark, rows, str(tmp_path)).collect()


def test_language_stage_keeps_texts_without_a_learned_language(spark, documents, tmp_path):
    texts = ["the cat sat on the mat", "123 456", None]
    kept = corpus_pipeline.language_id(spark, documents(texts, [None] * 3), str(tmp_path)).collect()
    assert [(r["doc_id"], r["lang"]) for r in kept] == [(0, None)]


def test_language_stage_fills_missing_languages(spark, documents, tmp_path):
    texts = ["the cat sat on the mat", "der hund bellt laut im garten", "the cat on the mat", "der hund im garten", "la casa"]
    docs = documents(texts, ["en", "de", None, None, "es"])
    kept = corpus_pipeline.language_id(spark, docs, str(tmp_path)).orderBy("doc_id").collect()
    assert [r["lang"] for r in kept] == ["en", "de", "en", "de", "es"]

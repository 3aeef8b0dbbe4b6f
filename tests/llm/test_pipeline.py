"""The pipeline's stages in order, and that queries and pipeline read whole tables."""

import random

import corpus_pipeline
from surveylake.llm import queries

SF_DIR = "/root/testdata/sf0.001"


def test_stages_hand_on_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, n = docs.columns, docs.count()
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_dedup", "pii", "mixing", "packing"]
    sizes = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.saved(stage(spark, docs, SF_DIR), "test-stage")
        assert docs.columns == columns
        sizes.append(docs.count())
    assert sizes[0] >= 0.98 * n and sizes[1] < sizes[0] and sizes[2] == sizes[1]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert last.where("piece = 0").count() == docs.count()


def test_stages_stand_odd_rows(spark, documents, words):
    rng = random.Random(0)
    texts = [" ".join(words(rng.randint(1, 80))) for _ in range(20)]
    rows = [(i, t, rng.choice(["en", "de", None]), rng.choice(["a", "b", None])) for i, t in enumerate(texts)]
    rows += [(30, None), (31, ""), (32, "123"), (None, texts[0]), (1, texts[1]), (1, texts[1]), (33, "word " * 50_000)]
    for extra in ([], rows):
        docs = documents(extra)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = corpus_pipeline.saved(stage(spark, docs, ""), "test-odd")
        out = corpus_pipeline.STAGES[-1][1](spark, docs, "")
        assert (out.count() > 0) == bool(extra)


def test_names():
    assert [name.split("_")[0] for name in queries.QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(queries.ORACLES) <= set(queries.QUERIES)


def test_language_stage_keeps_ties(spark, documents):
    docs = documents([(1, "abc abd", "aa"), (2, "abc abd", "bb"), (3, "abc", "aa"), (4, "12", "aa"), (5, None, "aa")])
    assert sorted(r.doc_id for r in corpus_pipeline.language_id(spark, docs, "").collect()) == [1, 2, 3]


OWN = "copy int, order_key string, lang_pred string, lang_score double, near_key string, near_row int, carried int, `a.b` string, row int"


def test_stages_keep_columns_of_any_name(spark, documents, words):
    own = (77, "k", "mine", 88.0, "near", 5, 6, "dot", 7)
    docs = documents([(i, " ".join(words(40)), "en", "a", *own) for i in range(6)], ", " + OWN)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.saved(stage(spark, docs, ""), "test-names")
        assert docs.columns == columns, name
        rows = docs.collect()
        assert rows and all(tuple(row)[-len(own) :] == own for row in rows), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == docs.count()


def test_which_repeated_row_stays_does_not_depend_on_partitions(spark, documents, words):
    text = " ".join(words(30))
    docs = documents([(1, text, "en", source) for source in "abcdef"])
    stays = {tuple(corpus_pipeline.near_dedup(spark, docs.repartition(n), "").collect()[0]) for n in (1, 2, 3, 6)}
    assert len(stays) == 1

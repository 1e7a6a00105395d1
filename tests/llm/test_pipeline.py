"""The pipeline on a small corpus with planted cases, against plain Python for every decision."""

import random

import pytest

pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402


@pytest.fixture(scope="module")
def corpus(tmp_path_factory, spark):
    rng = random.Random(11)
    vocabulary = ["w%d" % i for i in range(4000)]

    def text(n=None):
        return " ".join(rng.choice(vocabulary) for _ in range(n or rng.randint(60, 160)))
    items = [(i, text(30)) for i in range(6)]
    docs, kinds, labels = [], {}, []
    for i in range(700):
        kind = rng.choice(["clean"] * 8 + ["junk", "toxic", "copy", "leak"]) if i > 20 else "clean"
        body = text()
        if kind == "junk":
            body = " ".join(w + "###" for w in body.split())
        if kind == "toxic":
            for _ in range(4):
                body = body.replace(" ", " " + rng.choice(["grobbler ", "snerk "]), 1)[::1]
        if kind == "copy":
            body = docs[rng.randrange(20)][1]
        if kind == "leak":
            body += " " + " ".join(rng.choice(items)[1].split()[5:20]) + " " + text(20)
        docs.append((i, body, "en", "s", len(body)))
        kinds[i] = kind
        if kind != "copy" and rng.random() < 0.7:
            labels.append((i, int(kind != "junk"), int(kind == "toxic")))
    docs += [(900, None, None, None, None), (901, "", "en", "s", 0), (902, docs[0][1], "en", "s", None), (902, docs[0][1], "en", "s", None)]
    where = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    return str(where), docs, kinds


def test_stages_and_rows(spark, corpus):
    where, docs, kinds = corpus
    got = corpus_pipeline.run(spark, where).collect()
    assert sorted(r["doc_id"] for r in got) == [i for i, kind in kinds.items() if kind == "clean"]
    assert all(r["round_trip"] and len(r["ids"]) == 4 * r["n_tokens"] for r in got)
    rows = spark.read.parquet(f"{where}/documents.parquet").withColumnRenamed("n_chars", "_odds")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, rows, where).columns == rows.columns
        assert stage(spark, rows.limit(0), where).count() == 0

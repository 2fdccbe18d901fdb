"""The pipeline's stages against what each should keep, on planted documents."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from paneloom.llm import near_copies

def clean_text(i):
    """400 words without a repeated stretch, different for each i."""
    return " ".join(f"w{(i * 7919 + k * k * 31 + k * 17) % 9973}x{k % 7}" for k in range(400))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows = [(i, clean_text(i)) for i in range(120)]
    rows += [(1000 + i, clean_text(i)) for i in range(10)]
    rows += [(1100, clean_text(5) + " tail")]
    rows += [(2000 + i, clean_text(200 + i) + " scum moron idiot") for i in range(60)]
    rows += [(3000, "too short"), (3001, None), (3002, ""), (3003, "spam " * 200)]
    rows += [(4000, clean_text(500) + " mail me at a.b@c.example.org or +1 (555) 010-9999 now")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"lang": F.lit("en"), "source": F.concat(F.lit("h"), F.pmod("doc_id", F.lit(4))), "n_chars": F.length("text").cast("long"), "print": F.lit("extra")}
    )
    path = str(tmp_path_factory.mktemp("tables"))
    docs.write.parquet(f"{path}/documents.parquet")
    labels = [(d, 1, 1 if 2000 <= d < 3000 else 0) for d, _ in rows if d < 3000]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages_keep_what_they_should(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.save(stage(spark, docs, folder))
        assert out.columns == docs.columns
        docs, kept[name] = out, {r.doc_id for r in out.collect()}
    clean = set(range(120)) | {4000}
    assert kept["quality rules"] == clean | {*range(1000, 1010), 1100} | set(range(2000, 2060))
    assert kept["toxicity"] == clean | {*range(1000, 1010), 1100}
    assert kept["SimHash near-dedup"] == clean and kept["PII"] == clean
    assert docs.where("doc_id = 4000").first().text.endswith("mail me at [email] or [phone] now")
    assert docs.where("n_chars <> length(text)").count() == 0


def test_run_packs_all_that_is_kept(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in rows} == set(range(120)) | {4000}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "toxicity", "SimHash near-dedup", "PII", "best-fit packing"]


def test_empty_documents(spark, folder, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{folder}/{name}.parquet").where("false").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def test_near_copies_of_similarity_from_0_8_go(spark):
    """Copies with every so many words changed, over 0.8 and below, a chain, and a large group, against all pairs."""
    texts = []
    for i in range(60):
        words = clean_text(1000 + i).split()
        texts.append(" ".join(words))
        for k in (1, 3, 5, 7, 8, 9, 10, 14):  # changed words; each takes five of 396 shingles
            texts.append(" ".join(f"new{k}" if j % 40 == 20 and j // 40 < k or j == 5 and k > 10 else w for j, w in enumerate(words)))
    words = clean_text(5000).split()
    texts += [" ".join(f"y{i}" if (j + i) % 60 == 30 else w for j, w in enumerate(words)) for i in range(300)]
    texts += [" ".join([f"z{i}-{j}" for j in range(26 * i)] + words[26 * i :]) for i in range(8)]
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    similar = []
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 9 * both >= 4 * (len(sets[i]) + len(sets[j])):
                similar.append(both / len(sets[i] | sets[j]))
                a, b = sorted((top(i), top(j)))
                root[b] = a
    assert min(similar) < 0.82 and sum(s < 0.95 for s in similar) > 300
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    kept = {r.doc_id for r in near_copies.keep_one_of_copies(docs).collect()}
    assert kept == {i for i in range(len(texts)) if root[i] == i}


def test_near_copies_of_awkward_rows_and_columns(spark):
    """Null, empty and very long texts, ties, repeated rows and null ids, in a table with the operator's own column names."""
    long = " ".join(f"v{i}" for i in range(150_000))
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "two words"), (5, "TWO words"), (6, "other words"), (7, long), (8, long + " more"), (9, clean_text(1)), (9, clean_text(1)),
        (None, clean_text(1)), (None, clean_text(2)), (None, clean_text(2)), (12, clean_text(3)), (11, clean_text(3) + " end"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("cls", "key", "label", "sketch", "row_number", "Low", "leader")})
    found = near_copies.keep_one_of_copies(docs)
    assert found.columns == docs.columns and {tuple(r)[2:] for r in found.collect()} == {("x",) * 7}
    kept = [(r.doc_id, r.text) for r in found.collect()]
    want = [(1, None), (4, "two words"), (6, "other words"), (7, long), (9, clean_text(1)), (None, clean_text(2)), (11, clean_text(3) + " end")]
    assert sorted(kept, key=repr) == sorted(want, key=repr)
    assert near_copies.keep_one_of_copies(docs.where("false")).count() == 0

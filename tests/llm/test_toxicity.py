import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from periodica.llm.toxicity import Model, buckets, clean_rows, cut, learn, op3_toxicity, scored, scores

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    marks = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = op3_toxicity(spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    held = [r for r in got if r.held_out and r.doc_id in marks]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    toxic = [r.predicted for r in held if marks[r.doc_id] == 1]
    clean = [r.predicted for r in held if marks[r.doc_id] == 0]
    # some labels of this table belong to texts without any insult
    assert np.mean(toxic) >= 0.88 and np.mean(clean) <= 0.005
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)


def test_buckets_are_the_n_grams():
    text = "Éa b\U0001f600"
    padded = f" {text.lower()} "
    n_grams = [padded[i : i + n] for n in (3, 4, 5, 6) for i in range(len(padded) - n + 1)]
    same = Counter(n_grams)
    assert sorted(Counter(buckets(text).tolist()).values()) == sorted(same.values())
    assert len(buckets("")) == 0
    assert np.array_equal(buckets("ABC"), buckets("abc"))


def frames(spark):
    docs = [(i, "you idiot there" if i % 3 == 0 else "a fine day here") for i in range(60)]
    docs += [(None, "idiot"), (60, None), (61, ""), (62, "x" * 200_000), (62, "x" * 200_000)]
    labels = [(i, int(i % 3 == 0), 1) for i in range(60)] + [(3, 0, 1), (None, 1, 1), (60, 1, 1), (61, None, 0)]
    return (
        spark.createDataFrame([(*d, "c") for d in docs], "doc_id long, text string, toxic string"),
        spark.createDataFrame(labels, "doc_id long, toxic int, score int"),
    )


def test_defined_results(spark):
    docs, labels = frames(spark)
    model = learn(docs, labels, sample_rows=30)
    got = scores(docs, model).collect()
    assert len(got) == 65
    by_id = {r.doc_id: r.score for r in got}
    assert by_id[0] > 0.5 > by_id[1]
    empty = 1 / (1 + math.exp(-model.intercept))
    assert by_id[60] == by_id[61] == empty
    left = clean_rows(docs, model)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {r.doc_id for r in got if r.score < 0.5}


def test_too_few_labels(spark):
    docs, labels = frames(spark)
    for marks, expected in ((labels.limit(0), 0.0), (labels.filter("toxic = 0"), 0.0)):
        assert {r.score for r in scores(docs, learn(docs, marks)).collect()} == {expected}
    assert {r.score for r in scores(docs, learn(docs, labels.filter("toxic = 1"))).collect()} == {1.0}
    assert scores(docs.limit(0), Model(np.zeros(0, int), np.zeros(0), 0.0)).collect() == []


def test_few_texts_of_a_batch_are_python_strings_at_once():
    texts = pa.array(["x" * 4000] * 5000 + [None])
    tracemalloc.start()
    found = scored(texts, len)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4_000_000 and found.tolist() == [4000.0] * 5000 + [0.0]
    batch = pa.RecordBatch.from_pydict({"toxic": pa.array([1, 0] * 600, pa.int32()), "text": ["ab", "b"] * 600})
    parts = list(cut([batch]))
    assert max(x.num_rows for x in parts) < 1000 and sum(x.num_rows for x in parts) == 1200
    rows = [r for x in parts for r in x.to_pylist()]
    assert rows[0] == {"toxic": 1, "features": np.unique(buckets("ab")).tolist()}
    assert rows[1199] == {"toxic": 0, "features": np.unique(buckets("b")).tolist()}

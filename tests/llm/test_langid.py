import zlib

from periodica.llm.langid import Encoders, identify, learn, op9_langid

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    got = op9_langid(spark, SF).collect()
    assert {r.doc_id for r in got} == truth.keys() and len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.93 * len(held)
    sure = [r for r in held if r.accepted]
    assert sum(r.lang_pred == truth[r.doc_id] for r in sure) >= 0.97 * len(sure)
    assert len(sure) >= 0.9 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_learns_from_learnable_rows_only(spark):
    rows = [(i, f"wort{i} und der", "de") for i in range(50)] + [(50, None, "xx"), (51, "zz", None)]
    docs = spark.createDataFrame([(*r, "n") for r in rows], "doc_id long, text string, lang string, score string")
    model = learn(docs, sample_docs=5)
    assert list(model) == ["de"]
    own = [i for i in range(50) if zlib.crc32(str(i).encode()) % 5]
    assert all(any(f"wort{i}" == f"wort{n}" for n in own) for i in own)
    assert learn(docs.limit(0)) == {}


def test_defined_results(spark):
    model = {"de": b"der die das und nicht ein", "en": b"the and not one that"}
    rows = [(1, None), (2, ""), (3, "12 !? _"), (None, "the and not"), (5, "der die das " * 20_000)]
    docs = spark.createDataFrame([(*r, "x") for r in rows * 2], "doc_id long, text string, lang string")
    got = {(r.doc_id, r.lang_pred) for r in identify(docs, model).collect()}
    assert got == {(1, "und"), (2, "und"), (3, "und"), (None, "en"), (5, "de")}
    assert identify(docs, {}).filter("lang_pred <> 'und'").count() == 0
    assert Encoders({"de": b"abc"}, 4096).best("abc") == ("de", 1.0)
    assert identify(docs.limit(0), model).count() == 0


def test_learns_letters_of_whole_texts(spark):
    own = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5]
    table = "| 12,5 | 0 " * 1000
    rows = [(i, "" if n % 2 else "12 || --", "de") for n, i in enumerate(own[:200])]
    rows += [(own[200], f"{table} anfang {table} mitte {table} ende", "de")]
    rows += [(own[201], "license text " * 9000 + "schluss", "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = learn(docs, sample_docs=24)
    assert model["de"] == b"anfang mitte ende"
    assert model["fr"].endswith(b"schluss") and len(model["fr"]) <= 4 * (96 << 10) // 24
    assert learn(docs.filter("text not like '%anfang%'"), sample_docs=24).keys() == {"fr"}

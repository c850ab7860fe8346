import re

import corpus_pipeline
from periodica.llm import toxicity
from periodica.llm.mixing import with_cells
from periodica.llm.tokens import decoded

SF = "/root/testdata/sf0.01"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "pieces":
            assert out.columns == columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = {r.doc_id: r for r in docs.collect()}
        assert len(seen[name]) == docs.count()
    raw = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}

    table = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.learn(table, spark.read.parquet(f"{SF}/labels.parquet"))
    toxic = {r.doc_id for r in toxicity.scores(table, model).filter("predicted = 1").collect()}
    assert toxic and seen["toxicity"].keys() == raw.keys() - toxic

    groups: dict[str, list] = {}
    for i, r in seen["toxicity"].items():
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r.text), []).append((-len(r.text), i))
    assert seen["exact_dedup"].keys() == {min(g)[1] for g in groups.values()}

    sets = {i: shingles(r.text) for i, r in seen["exact_dedup"].items()}
    ids, parent = sorted(sets), {i: i for i in sets}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    at: dict[tuple, list] = {}
    for i in ids:
        for s in sets[i]:
            at.setdefault(s, []).append(i)
    pairs = {(a, b) for x in at.values() if len(x) < 400 for a in x for b in x if a < b}
    for a, b in pairs:
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            low, high = sorted((top(a), top(b)))
            parent[high] = low
    assert seen["near_dedup"].keys() == {i for i in ids if top(i) == i}

    assert seen["mixing"].keys() <= seen["near_dedup"].keys()
    assert len(seen["mixing"]) > len(seen["near_dedup"]) / 2
    assert {i: r.text for i, r in seen["mixing"].items()} == {i: raw[i].text for i in seen["mixing"]}
    assert with_cells(table, {"lang": {"en": 1.0}})[1] == ["n_tokens", "class_lang"]

    assert seen["pieces"].keys() == seen["mixing"].keys()
    back = {r.doc_id: r.text for r in decoded(docs).collect()}
    assert back == {i: r.text for i, r in seen["mixing"].items()}
    whole = {r.doc_id: r.pieces for r in corpus_pipeline.run(spark, SF).collect()}
    assert whole == {i: r.pieces for i, r in seen["pieces"].items()}


def test_odd_rows_pass_through(spark):
    rows = [
        (None, None, "en", "src0", 1), (None, "", "en", None, None), (1, "a b c", None, "src1", 5),
        (1, "a b c", None, "src1", 5), (2, " a  b c", "en", "src1", 6), (3, "w " * 50_000, "en", "src2", 7),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string, sha string, row int"
    docs = spark.createDataFrame([(*r, "k", "s", 1) for r in rows], schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        full, empty = stage(spark, docs, SF), stage(spark, docs.limit(0), SF)
        assert full.columns == docs.columns == empty.columns and empty.count() == 0
        assert full.count() <= 6
    exact = corpus_pipeline.exact(spark, docs, SF).collect()
    assert sorted((r.doc_id or 0, r.text) for r in exact if r.text) == [(2, " a  b c"), (3, "w " * 50_000)]
    assert len(exact) == 3
    assert corpus_pipeline.pieces(spark, docs, SF).count() == 6

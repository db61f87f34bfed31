"""The pipeline's stages on small tables, against what the operators decide by themselves."""

import corpus_pipeline
from corpusforge.llm import mixing, neardup, packing, quality, substrings
from corpusforge.llm.queries import tokenizer_path


def test_stages_take_effect(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    columns = docs.columns
    stage = dict(corpus_pipeline.STAGES)

    good = stage["quality"](spark, docs, small).cache()
    kept = {r.doc_id for r in quality.resample(docs, labels).filter("kept").collect()}
    assert {r.doc_id for r in good.collect()} == kept and good.columns == columns
    junk = {r.doc_id for r in labels.filter("quality = 0").collect()}
    clean = {r.doc_id for r in labels.filter("quality = 1").collect()}
    assert clean <= kept and not junk & kept

    single = stage["near_duplicates"](spark, good, small).cache()
    groups = neardup.near_duplicates(good).collect()
    assert {r.doc_id for r in single.collect()} == {r.component_id for r in groups} and single.columns == columns

    cut = stage["substrings"](spark, single, small).cache()
    removed = {r.doc_id: r for r in substrings.remove_repeats(single).collect()}
    text = {r.doc_id: r.text for r in single.collect()}
    assert cut.columns == columns
    for r in cut.collect():
        assert len(r.text.split()) <= removed[r.doc_id].n_words and r.n_chars == len(r.text)
        assert removed[r.doc_id].n_removed or r.text == text[r.doc_id]

    mixed = stage["mixing"](spark, cut, small).cache()
    copies = {r.doc_id: r.copies for r in mixing.mix(cut).collect()}
    counts = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts == {i: n for i, n in copies.items() if n} and mixed.columns == columns

    packed = stage["packing"](spark, mixed, small)
    whole = packing.pack(mixed, tokenizer_path())
    assert packed.agg({"length": "sum"}).first()[0] == whole.agg({"length": "sum"}).first()[0]


def test_run_goes_through_all_stages(spark, small):
    pieces = corpus_pipeline.run(spark, small)
    assert pieces.count() > 0
    sizes = sorted(r["sum(length)"] for r in pieces.groupBy("sequence_id").sum("length").collect())
    assert sizes[-1] == 1024 and (len(sizes) < 2 or sizes[1] == 1024)


def test_stages_take_odd_rows(spark, small):
    from tests.llm.helpers import SCHEMA, edge_rows

    for rows in ([], edge_rows()):
        docs = spark.createDataFrame(rows, SCHEMA)
        for _, stage in corpus_pipeline.STAGES[1:]:
            docs = stage(spark, docs, small)
        assert (docs.count() > 0) == bool(rows)


NAMES = (
    "kept_id", "kept", "component_id", "label", "key", "bucket", "n", "copies", "copy", "mixed_id", "size", "target", "taken", "extra", "cell", "h",
    "n_removed", "n_words", "factors", "kept_text", "kept_sha256", "phrase", "start", "starts", "aside_0", "aside_7", "rank", "log_weight", "sequence_id",
    "offset", "length", "start_", "doc_tokens", "ids_crc32", "source_size",
)


def test_stages_carry_columns_of_any_name(spark, small):
    from tests.llm.helpers import SCHEMA, edge_rows

    plain = docs = spark.createDataFrame(edge_rows(), SCHEMA)
    for i, name in enumerate(NAMES):
        docs = docs.selectExpr("*", f"concat('{i}/', coalesce(doc_id, -1)) AS `{name}`")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        plain, docs = stage(spark, plain, small), stage(spark, docs, small)
        assert docs.columns == columns
    rows = docs.collect()
    for r in rows:
        for i, name in enumerate(NAMES):
            assert r[name] == f"{i}/{-1 if r['doc_id'] is None else r['doc_id']}"
    assert sorted(map(str, ((r["doc_id"], r["text"], r["source"]) for r in rows))) == sorted(
        map(str, ((r["doc_id"], r["text"], r["source"]) for r in plain.collect()))
    )
    assert corpus_pipeline.STAGES[-1][1](spark, docs, small).count() > 0


def test_quality_takes_odd_rows(spark, small):
    from tests.llm.helpers import SCHEMA, edge_rows

    stage = dict(corpus_pipeline.STAGES)["quality"]
    assert stage(spark, spark.createDataFrame([], SCHEMA), small).count() == 0
    rows = [(None, None, None, None, None), (1, None, "en", "a", 0), (2, "", "en", "a", 0), (2, "", "en", "a", 0), *edge_rows()]
    got = stage(spark, spark.createDataFrame(rows, SCHEMA), small).collect()
    assert {r["doc_id"] for r in got} >= {None, 1, 2} and len([r for r in got if r["doc_id"] == 2]) == 2

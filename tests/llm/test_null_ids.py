"""Rows without an id, empty tables and further columns: defined results of operators and stages."""

import pytest

from strandmill.llm import decontamination, language_id, license_scan, packing, secret_scan

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LEAK = "one two three four five six seven eight nine ten eleven twelve"
TEXTS = ["under the mit license", "token: abcdef123", None, "", f"so {LEAK} it ends"]


def rows_of(out, *columns):
    return sorted((tuple(r[c] for c in columns) for r in out.collect()), key=str)


@pytest.fixture(scope="module")
def both(spark):
    """(texts with ids, the same without): each text twice."""
    with_id = [(k, x) for k, x in enumerate(TEXTS) for _ in range(2)]
    make = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    return make(with_id), make([(None, x) for _, x in with_id])


def test_rows_without_an_id_have_the_results_of_their_texts(spark, both):
    plain, lost = both
    for scan, columns in ((license_scan.license_scan, ("n_words", "n_base", "labels", "score")), (secret_scan.secret_scan, ("n_assign", "base_sha256", "spans"))):
        assert rows_of(scan(lost), *columns) == rows_of(scan(plain), *columns) and scan(lost).where("doc_id is not null").isEmpty()
    model = language_id.train(spark.read.parquet(f"{SF}/documents.parquet"))
    assert rows_of(language_id.predict(lost, model), "lang_pred", "score") == rows_of(language_id.predict(plain, model), "lang_pred", "score")
    columns = ("piece", "start", "length", "ids_crc32")
    packed = packing.best_fit_packing(lost)
    assert rows_of(packed, *columns) == rows_of(packing.best_fit_packing(plain), *columns)
    assert len({(r.sequence_id, r.offset) for r in packed.collect()}) == 2 * len(TEXTS)


def test_rows_without_an_id_are_cleaned_by_their_own_text(spark, both):
    items = spark.createDataFrame([(7, LEAK), (8, None), (9, "")], "item_id long, text string")
    for docs in both:
        kept = decontamination.without_leaks(docs, items)
        assert sorted(str(r.text) for r in kept.collect()) == sorted(str(x) for x in TEXTS[:-1] for _ in range(2))
        assert decontamination.without_leaks(docs, items.where("false")).count() == 2 * len(TEXTS)


def test_stages_of_an_empty_table_give_none(spark):
    import corpus_pipeline as p

    none = spark.createDataFrame([], DOCS)
    for name, stage in p.STAGES:
        out = stage(spark, none, SF)
        assert out.count() == 0, name
        assert name == "packing" or out.columns == none.columns, name


def test_stages_of_further_columns(spark):
    import corpus_pipeline as p

    schema = DOCS + ", component_id long, lost string, key string, lang_pred string, id long"
    few = [(k, f"The words of text {k} go on for a while and then they end.", "en", "s", 9, 5, "x", "y", "z", k) for k in range(6)]
    docs = spark.createDataFrame(few, schema)
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in p.STAGES:
        got, want = stage(spark, docs, SF), stage(spark, plain, SF)
        columns = ("doc_id", "piece", "ids_crc32") if name == "packing" else ("doc_id", "text", "lang", "source", "n_chars")
        assert rows_of(got, *columns) == rows_of(want, *columns) != [], name

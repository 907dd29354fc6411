from __future__ import annotations

from odd import docs, none

from scoreloom.llm.language import predicted_languages, recognised


def test_held_out_accuracy(spark, data):
    table = spark.read.parquet(f"{data}/documents.parquet")
    rows = predicted_languages(table).join(table.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 20
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_labels_of_a_document_do_not_matter_to_it(spark, data):
    table = spark.read.parquet(f"{data}/documents.parquet")
    blind = table.selectExpr("doc_id", "text", "if(crc32(cast(doc_id as string)) % 3 = 1, 'xx', lang) as lang", "'s' as source")
    assert sorted(predicted_languages(table).collect()) == sorted(predicted_languages(blind).collect())


def test_odd_rows(spark):
    table = docs(spark)
    got = predicted_languages(table).collect()
    assert len(got) == table.count()
    letters = {r["doc_id"]: any(c.isalpha() for c in r["text"] or "") for r in table.where("doc_id is not null").collect()}
    for r in got:
        if r["doc_id"] is not None:
            assert (r["lang_pred"] == "und") == (not letters[r["doc_id"]])
    left = recognised(table)
    assert left.columns == table.columns and left.schema == table.schema
    assert {r["doc_id"] for r in left.collect()} == {4, 5, 6, 7, 8, None}
    assert sorted(map(str, left.where("doc_id = 6").collect())) == sorted(map(str, table.where("doc_id = 6").collect()))
    assert predicted_languages(none(spark)).count() == 0 and recognised(none(spark)).count() == 0


def test_nothing_learned(spark):
    table = docs(spark).selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r["lang_pred"] for r in predicted_languages(table).collect()} == {"und"}

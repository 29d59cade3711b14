"""The windows of all kinds come from one template of each text."""

from __future__ import annotations

from segmentry.llm import decontaminate


def test_a_text_is_made_a_template_once(spark, monkeypatch):
    plans, write = {}, decontaminate.written

    def noted(df, name, **options):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return write(df, name, **options)

    monkeypatch.setattr(decontaminate, "written", noted)
    text = "A train leaves the station at 9 km per hour and Anna waits for 12 minutes in the old town"
    benchmark = spark.createDataFrame([(1, text), (2, "Paris"), (3, "4 + 5")], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, text), (2, "we saw Paris"), (3, text.replace("12", "7")), (4, "none")], "doc_id bigint, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, benchmark).collect()}
    assert found == {(1, 1), (2, 2), (3, 1)}
    assert plans["window-matches"].count("lower(") == 1

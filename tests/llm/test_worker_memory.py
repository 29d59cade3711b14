"""What Python workers hold of texts and of earlier tasks."""

from __future__ import annotations

import sys

import pyarrow as pa

from segmentry.llm import common, language


def test_texts_go_to_workers_in_bounded_batches(spark, monkeypatch):
    monkeypatch.setattr(common, "TEXTS_PER_BATCH", 100)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    docs = spark.range(0, 1_050, 1, 1).selectExpr("id", "repeat('a', 50) AS text")
    found = [r["n"] for r in common.written(docs.mapInArrow(sizes, "n bigint"), "sizes", texts=True).collect()]
    assert sum(found) == 1_050 and max(found) <= 100
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_language_tasks_let_go_of_encoders(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "some text of a few words", "en", "web1")], "doc_id bigint, text string, lang string, source string")
    model = language.fit_text_model(docs)
    tasks, kept = [], {("path", False): "an encoder"}
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, f, kinds: tasks.append(f) or self.limit(0).selectExpr("lang", "1L bucket", "1L n"))
    monkeypatch.setitem(sys.__dict__, "_segmentry_encoders", kept)
    try:
        language.fit_text_model(docs)
    except ValueError:  # there is nothing to stack
        pass
    language._scored(docs, model)
    assert len(tasks) == 2
    for task in tasks:
        kept["path", False] = "an encoder"
        list(task(iter([])))
        assert not kept

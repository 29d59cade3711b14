"""Terms that reveal an entity, wherever in its texts they stand, against a count of all pairs."""

from __future__ import annotations

import math
import random

import pytest

from segmentry.llm.pii import KINDS, SMOOTH, TERM, base_spans, masked, revealing_terms, sanitise
from segmentry.llm.pii import _value as value_of


def by_brute_force(texts: list[str], generalise: float) -> dict[str, tuple[str, float]]:
    texts = sorted(set(texts))
    words = [{w.lower() for w in TERM.findall(t)} for t in texts]
    spans = [base_spans(t) for t in texts]
    shown = [w & {x.lower() for x in TERM.findall(masked(t, s))} for t, s, w in zip(texts, spans, words)]
    entities = [{(value_of(kind, t[a:b]), kind) for a, b, kind in s} for t, s in zip(texts, spans)]
    n, best = len(texts), {}
    for entity, kind in set().union(*entities):
        of = [i for i in range(n) if (entity, kind) in entities[i]]
        for term in set().union(*(shown[i] for i in of)) if len(of) < n else ():
            n_term, both = sum(term in w for w in words), sum(term in words[i] for i in of)
            if math.log((n_term + SMOOTH) / both) <= (1 - generalise) * math.log((n + SMOOTH) / (len(of) + SMOOTH)):
                found = (math.log(n * both / (n_term * len(of))) / math.log(n / len(of)), kind)
                best[term] = max(best.get(term, (-math.inf, "")), found)
    return {t: (kind, d) for t, (d, kind) in best.items()}


def test_all_terms_of_the_texts_of_an_entity(spark):
    rng = random.Random(4)
    entities = ["ann@ward.org", "bob@ward.org", "10.0.0.1", "+49 30 1234567", "4111 1111 1111 1111", "cy@x.org"]
    common = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}o" for i in range(40)]
    texts = []
    for i in range(120):
        body = [rng.choice(common) for _ in range(rng.randrange(20, 60))]
        own = [f"rare{chr(97 + i % 7)}", "abc²" if i % 9 == 0 else "abc"] if i % 3 == 0 else []
        held = rng.sample(entities, rng.randrange(0, 3)) if i % 4 == 0 else []
        texts.append(" ".join([*own, *body, *held, *(["ends", f"last{chr(97 + i % 11)}"] if held else [])]))
    texts += texts[:10]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    for generalise in (0.3, 0.5):
        got = {r["term"]: (r["kind"], r["disclosure"]) for r in revealing_terms(docs, generalise=generalise)[0].collect()}
        want = by_brute_force(texts, generalise)
        assert set(got) == set(want)
        assert len(want) > 3
        assert all(got[t][0] == want[t][0] and got[t][0] in KINDS and got[t][1] == pytest.approx(want[t][1]) for t in want)


def test_a_term_far_from_its_entity(spark):
    """The production parameters: the name stands sixty words before the address."""
    common = [f"call about case number {i} with the form today" for i in range(2000)]
    far = "ask for Gladys " + "about the case number with the form today " * 8 + "at gladys@ward.org"
    more = spark.range(10_000, 30_000).selectExpr("id", "concat('call about the form ', id, ' ask for it') AS text")
    docs = spark.createDataFrame(list(enumerate([*common, far])), "id bigint, text string").union(more)
    out = sanitise(docs.withColumnRenamed("id", "doc_id")).where("doc_id = 2000").first()
    assert out["spans"].startswith("term:8:14,") and "Gladys" not in out["sanitised"] and out["n_email"] == 1

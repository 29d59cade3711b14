"""Fingerprints (1), personal data (5), n-gram join (6) and decontamination (8) against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from segmentry.llm import jaccard, pii, spotsigs
from segmentry.llm.decontaminate import contaminated, decontaminated
from segmentry.llm.common import passing_tables, written
from segmentry.llm.jaccard import Tiles, WordHashes, ngram_jaccard, one_of_each, shingle_set
from segmentry.llm.pii import KINDS, base_spans, found_data, masked, revealing_terms, sanitise, without_data
from segmentry.llm.spotsigs import edited_likeness, near_duplicates

SF_DIR = "/root/testdata/sf0.001"


def words(rng, n, vocabulary=400):
    return [f"w{i}" for i in rng.integers(0, vocabulary, n)]


@pytest.fixture(scope="module")
def family():
    """Texts with groups of copies, edited copies, tiny and empty texts."""
    rng = np.random.default_rng(5)
    texts = [words(rng, int(n)) for n in rng.integers(1, 160, 60)]
    for base in range(0, 30, 3):
        for edits in (0, 1, 2, 4, 9):
            copy = list(texts[base])
            for _ in range(edits):
                copy[int(rng.integers(len(copy)))] = "x" + str(rng.integers(50))
            texts.append(copy)
    out = [" ".join(t) for t in texts] + ["", None, "a", "A", "a b", " a b\tc", "a b c d", " \n"]
    out += [" ".join(words(rng, 6000))] * 2
    return out


def rows_of(spark, texts):
    ids = list(range(len(texts)))
    random.Random(3).shuffle(ids)
    return spark.createDataFrame(list(zip(ids, texts)), "doc_id bigint, text string").repartition(3)


def brute_components(pairs, ids):
    top = {i: i for i in ids}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        top[b] = a
    return {i: root(i) for i in ids}


@pytest.mark.parametrize("n,percent,block", [(3, 90, 1024), (5, 80, 1024), (1, 50, 3)])
def test_ngram_jaccard(spark, family, n, percent, block, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", block)
    docs = rows_of(spark, family)
    sets = {}
    for r in docs.collect():
        w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or ""))
        sets[r["doc_id"]] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} or ({tuple(w)} if w else set())
    pairs = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    want = brute_components(pairs, sets)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_jaccard(docs, n, percent).collect()}
    assert got == {i: (len(s), want[i]) for i, s in sets.items()}


def rarest_tiles(tiles, shingles, often):
    """The tiles that a set keeps when each leaves its most frequent ones; ``often`` says how frequent a key is."""
    keys, spare = tiles.keys(shingles)
    band = keys & np.uint64((1 << jaccard.BAND_BITS) - 1)
    assert set(band.tolist()) <= set(spare[:, 0].tolist())
    return {k for b, n in spare.tolist() for k in sorted(keys[band == b].tolist(), key=lambda k: (-often(k), k))[n:]}


@pytest.mark.parametrize("percent", [60, 80, 90, 95])
def test_sets_above_the_threshold_keep_a_tile_in_common(percent):
    rng, tiles = np.random.default_rng(percent), Tiles(percent)
    for size in [1, 2, 5, 9, 10, 19, 20, 21, 60, 200, 1500]:
        for _ in range(40):
            pool = np.unique(rng.integers(0, 1 << 63, 2 * size + 20).astype(np.uint64))
            a = pool[rng.choice(len(pool), size, replace=False)]
            other = int(rng.integers(max(1, size * percent // 100), size + 1))
            b = rng.choice(a, other, replace=False)
            extra = np.setdiff1d(pool, a)
            room = next(k for k in range(len(extra) + 1) if 100 * other < percent * (size + k + 1) or k == len(extra))
            if 100 * other >= percent * size:
                b = np.concatenate([b, extra[:room]])
            a, b = np.sort(a), np.sort(b)
            both = len(np.intersect1d(a, b))
            if 100 * both >= percent * (len(a) + len(b) - both) and len(np.setxor1d(a, b)):
                shared = set(tiles.keys(a)[0].tolist()) & set(tiles.keys(b)[0].tolist())
                for often in (lambda k: 0, lambda k: k % 7, shared.__contains__):
                    assert rarest_tiles(tiles, a, often) & rarest_tiles(tiles, b, often), (len(a), len(b), both)


def test_shingles_of_odd_texts():
    hashes = WordHashes()
    assert len(shingle_set("a b a b a b", 3, hashes)) == 2 and len(shingle_set("one", 3, hashes)) == 1
    assert len(shingle_set("x " * 50_000, 3, hashes)) == 1 and len(shingle_set("\x0b\x0c ", 3, hashes)) == 0
    hashes.most = 3
    assert len(shingle_set(" ".join(f"t{i}" for i in range(100)), 1, hashes)) == 100


def test_ngram_jaccard_rows(spark):
    text = " ".join(f"t{i}" for i in range(40))
    rows = [(5, text, 1), (5, text, 1), (None, text, 2), (5, "other words here now", 3), (2, text + " end", 4), (9, None, 5), (9, None, 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, component_id int").withColumnRenamed("component_id", "group")
    got = sorted(((r["doc_id"], r["component_id"]) for r in ngram_jaccard(docs).collect()), key=str)
    assert got == sorted([(5, 2), (5, 2), (None, 2), (5, 5), (2, 2), (9, 9), (9, 9)], key=str)
    kept = sorted((tuple(r) for r in one_of_each(docs).collect()), key=str)
    assert kept == sorted([(2, text + " end", 4), (5, "other words here now", 3), (9, None, 5), (9, None, 5)], key=str)
    alone = one_of_each(docs.where("`group` in (1, 3)")).collect()
    assert sorted(r["group"] for r in alone) == [1, 3]
    assert ngram_jaccard(docs.limit(0)).count() == 0 and one_of_each(docs.limit(0)).count() == 0


def test_second_round_finds_links_between_copies_of_copies(spark):
    """A chain: each text links with the next only, so no leader reaches all."""
    rng = np.random.default_rng(9)
    text = words(rng, 60, 10_000)
    texts = []
    for _ in range(25):
        texts.append(" ".join(text))
        text = list(text)
        text[int(rng.integers(60))] = f"new{len(texts)}"
    docs = rows_of(spark, texts)
    got = {r["component_id"] for r in ngram_jaccard(docs, 3, 90).collect()}
    sets = [{tuple(t.split()[k : k + 3]) for k in range(58)} for t in texts]
    ids = {r["text"]: r["doc_id"] for r in docs.collect()}
    pairs = [(ids[texts[a]], ids[texts[b]]) for a in range(25) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])]
    assert got == set(brute_components(pairs, ids.values()).values())


def test_a_passage_in_many_different_texts(spark, monkeypatch):
    """Texts that share a passage of 50 words and nothing else: hardly any tile of theirs is compared."""
    rng = np.random.default_rng(12)
    passage = " ".join(words(rng, 50, 10_000))
    texts = [" ".join(words(rng, int(n), 50_000)) + " " + passage for n in rng.integers(120, 400, 5_000)]
    texts += [texts[0] + " end", texts[1] + " end"]
    found = []
    bounded = jaccard._bounded_pairs
    monkeypatch.setattr(jaccard, "_bounded_pairs", lambda *a: (found.append(x := bounded(*a).persist()), x)[1])
    rows = ngram_jaccard(rows_of(spark, texts)).groupBy("component_id").count()
    assert sorted(r["count"] for r in rows.collect())[-3:] == [1, 2, 2]
    assert sum(x.count() for x in found) < 5_000


def test_passing_tables_are_removed(spark):
    import os

    with passing_tables(spark):
        a = written(spark.range(5).toDF("x").repartition("x"), "passing")
        b = written(a, "staying", stays=True)
        files = a.inputFiles()
    assert files and not any(os.path.exists(f.removeprefix("file://")) for f in files)
    assert b.count() == 5 and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_streamed_groups(spark):
    rows = [(1, 1), (2, 2), (2, 3), (3, 4), (4, 5), (4, 6), (4, 7), (9, 8), (9, 9)]
    df = spark.createDataFrame(rows, "key bigint, row bigint").coalesce(1).sortWithinPartitions("key")
    for batch in ("1", "2", "100"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        got = sorted(map(tuple, jaccard._shared(df).collect()))
        assert got == [(2, 2), (2, 3), (4, 5), (4, 6), (4, 7), (9, 8), (9, 9)]
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


# ---- personal data --------------------------------------------------------------------------------

_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_spans(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    luhn = lambda s: sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(s[::-1])) % 10 == 0
    out = [(m.start(), 0, m.end()) for m in _EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in _CARD.finditer(text) if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]
    return [(a, b, KINDS[k]) for a, k, b in sorted(out)]


def test_base_spans_against_the_plain_patterns():
    rng = random.Random(1)
    for _ in range(30_000):
        text = "".join(rng.choice("aZ@.@.+-5 3012(ü") for _ in range(rng.randint(0, 40)))
        assert base_spans(text) == brute_spans(text), text
    card = "4111 1111-1111 1111"
    assert base_spans(f"x {card} 1.2.3.256 0001.2.3.4 +1 (555) 123-4567") == brute_spans(f"x {card} 1.2.3.256 0001.2.3.4 +1 (555) 123-4567")


@pytest.mark.parametrize("text", ["1" * 300_000, "a" * 300_000, "a@" * 100_000, "+1" * 100_000, "1." * 100_000, "a.b@" * 50_000 + "c.d"])
def test_long_runs_take_linear_time(text):
    base_spans(text)


def test_masks_keep_what_is_between():
    text = "me@x.org and 10.0.0.1, +1 (555) 123-4567."
    assert masked(text, base_spans(text)) == "[EMAIL] and [IP], [PHONE]."


def test_revealing_terms(spark):
    """The nurse is named with one address only; the common words are everywhere."""
    texts = [f"call nurse Gladys at gladys@ward.org about case number {c}" for c in ("alpha", "beta", "gamma", "delta")]
    texts += [f"call about case number {i} with the {w} form today" for i, w in enumerate("abcdefghijklmnopqrst")]
    rows = [(i, t) for i, t in enumerate(texts + [texts[0], None, "", "so Gladys went home"])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    terms, _ = revealing_terms(docs.fillna(""), generalise=0.8)
    found = {r["term"]: r["disclosure"] for r in terms.collect()}
    assert set(found) == {"nurse", "gladys", "ward"} - {"ward"}
    n, both, named, entity = 26, 4, 5, 4  # different texts; the empty one counts, copies do not
    assert found["gladys"] == pytest.approx(np.log(n * both / (named * entity)) / np.log(n / entity))
    assert found["nurse"] == pytest.approx(1.0)
    out = {r["doc_id"]: r for r in sanitise(docs, generalise=0.8, remove=0.99).collect()}
    assert out[0]["sanitised"] == "call  [EMAIL TERM] at [EMAIL] about case number alpha"
    assert out[27]["spans"] == "term:3:9" and out[27]["n_email"] == 0
    assert out[25]["spans"] == "" and out[25]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert out[0]["spans"].startswith("term:5:10,term:11:17,email:21:36")


def test_terms_near_an_entity_of_one_text(spark):
    """The production parameters: one text names the nurse with the address, and another one of it has her far away."""
    common = [f"call about case number {i} with the form today" for i in range(2000)]
    lone = "call nurse Gladys at gladys@ward.org about case number 7"
    far = "Zoltan " + "call about case number " * 30 + "at zoltan@ward.org"
    near = "call Zoltan at zoltan@ward.org about case number 8"
    docs = spark.createDataFrame(list(enumerate([*common, lone, far, near])), "doc_id bigint, text string")
    terms, _ = revealing_terms(docs, generalise=0.93)
    assert {r["term"]: r["disclosure"] for r in terms.collect()} == pytest.approx({"gladys": 1.0, "nurse": 1.0, "zoltan": 1.0})
    many = docs.union(spark.range(10_000, 30_000).selectExpr("id", "concat('call about the form ', id)"))
    out = {r["doc_id"]: r["sanitised"] for r in sanitise(many).where("doc_id in (0, 2000)").collect()}
    assert out == {0: common[0], 2000: "call   at [EMAIL] about case number 7"}


def test_words_beside_an_entity_whatever_their_length():
    text = "one two " + "x" * 500 + " three four five six seven eight nine - " + "1" * 900 + " a@b.co " + "y" * 300 + " after"
    near = pii._beside(text, pii.base_spans(text))
    assert near == [{"two", "x" * 500, "three", "four", "five", "six", "seven", "eight", "nine", "y" * 300, "after"} - {"two"}]
    assert pii._beside("a@b.co", [(0, 6, "email")]) == [set()]


def test_found_data_rows(spark):
    rows = [(1, "a@b.co", "x"), (1, "a@b.co", "x"), (None, None, "y"), (2, "", "z"), (3, "ü " * 20_000 + "1.2.3.4", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, spans string")
    got = found_data(docs).collect()
    assert len(got) == 5 and sorted(r["n_email"] for r in got) == [0, 0, 0, 1, 1]
    assert [r["spans"] for r in got if r["doc_id"] == 3] == ["ip:40000:40007"]
    clean = without_data(docs.withColumnRenamed("spans", "n_ip")).collect()
    assert sorted((r["doc_id"] is None, r["text"] or "", r["n_ip"] or "") for r in clean)[:2] == [(False, "", "z"), (False, "[EMAIL]", "x")]
    assert [r["text"] for r in clean if r["doc_id"] is None] == [None]
    assert found_data(docs.limit(0)).count() == 0


# ---- decontamination --------------------------------------------------------------------------------

ITEM = "A train leaves the station at 9 in the morning and travels 120 km before Anna meets it with 3 red apples in her old basket"


def test_templates_catch_other_numbers_names_and_units(spark):
    other = ITEM.replace("9", "7").replace("120 km", "85 miles").replace("Anna", "Peter").replace("3 red", "12 red")
    mixed = "The man sells 4 cups and buys 4 cups and rents 4 cups and paints 4 cups and then loses 4 cups and finds 4 cups today"
    torn = mixed.replace("4", "{}").format(1, 2, 3, 5, 6, 7)
    items = [(1, ITEM), (2, mixed), (3, None), (4, ""), (5, "short one"), (1, ITEM)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    texts = {
        1: "Some words first. " + ITEM + " And some after.",
        2: "Say: " + other + ".",
        3: torn,
        4: "A train leaves the station and nothing else is the same in this text of mine, is it not so",
        5: None,
        6: "",
        7: mixed.replace("4", "9"),
        8: "filler " * 20_000 + other,
    }
    rows = [*texts.items(), (1, texts[1]), (None, texts[1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("item_id", F.lit(0))
    got = contaminated(docs, benchmark).collect()
    assert sorted(((r["doc_id"], r["item_id"]) for r in got), key=str) == sorted([(1, 1), (1, 1), (None, 1), (2, 1), (7, 2), (8, 1)], key=str)
    two = next(r for r in got if r["doc_id"] == 2)
    assert two["slots"] >= 4 and two["consistent"] == 1.0 and two["windows"] >= two["item_windows"] - 1
    left = {r["doc_id"] for r in decontaminated(docs, benchmark).collect()}
    assert left == {3, 4, 5, 6}
    assert contaminated(docs.limit(0), benchmark).count() == 0 and contaminated(docs, benchmark.limit(0)).count() == 0


def test_each_occurrence_is_consistent_in_itself(spark):
    """A copy beside copies with other numbers, and items that repeat their template."""
    asked = [ITEM.replace("9", str(k)).replace("120", str(7 * k)).replace("3 red", f"{k + 20} red") for k in range(30, 36)]
    line = "Then add {} cups of the fine white flour and stir"
    item = " ".join(line.format(k) for k in range(11, 17))
    items = spark.createDataFrame([(1, ITEM), (2, item)], "item_id bigint, text string")
    far = " filler" * 50 + ". "
    texts = [
        ITEM + far + asked[0],
        far.join(asked),
        "Say " + item + far,
        # A word put in shifts the rest.
        far.join(t.replace("before", "long before") for t in asked),
        ITEM[: len(ITEM) // 3],
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]): r["consistent"] for r in contaminated(docs, items).collect()}
    assert got == {(0, 1): 1.0, (1, 1): 1.0, (2, 2): 1.0, (3, 1): 1.0}


def test_short_items_and_items_of_placeholders(spark):
    items = {1: "What is the capital of France?", 2: "12 + 30 = ?", 3: "Add 3 kg, 4 kg, 5 kg, 6 kg, 7 kg and 8 kg", 4: "Name two", 5: "Which planet is the largest we ever saw"}
    benchmark = spark.createDataFrame(list(items.items()), "item_id bigint, text string")
    texts = {
        1: "The quiz began. What is the capital of France? Nobody knew it.",
        2: "then somebody asked What is the capital of Spain and left the room again",
        3: "we were told that 12 + 30 = 42 in the end of all this",
        4: "first Add 3 kg, 4 kg, 5 kg, 6 kg, 7 kg and 8 kg to the other side of the scale",
        5: "first Add 9 kg, 1 kg, 2 kg, 3 kg, 4 kg and 5 kg to the other side of the scale, it was 12 and 31",
        6: "they asked Which planet is the largest we ever saw and nobody replied",
        7: "what is the name of the capital",
        8: "Name two",
        9: "",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]) for r in contaminated(docs, benchmark).collect()}
    assert got - {(2, 1)} == {(1, 1), (3, 2), (4, 3), (6, 5), (8, 4)}
    said = docs.withColumn("text", F.regexp_replace("text", "asked What", "asked what"))
    assert (2, 1) in {(r["doc_id"], r["item_id"]) for r in contaminated(said, benchmark).collect()}


def test_planted_items_and_nothing_else(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    shingles = lambda t: {tuple(w[k : k + 8]) for w in [re.findall(r"[^\W_]+", t.lower())] for k in range(len(w) - 7)}
    held = {r["item_id"]: shingles(r["text"]) for r in items.collect()}
    want = {(r["doc_id"], i) for r in docs.collect() for s in [shingles(r["text"])] for i, h in held.items() if len(h & s) >= min(6, -(-len(h) // 2))}
    assert {(r["doc_id"], r["item_id"]) for r in contaminated(docs, items).collect()} == want


# ---- fingerprints -----------------------------------------------------------------------------------


def brute_signatures(text):
    low = re.findall(r"[^\W_]+", text.lower())
    anchors, out, after = set(spotsigs.ANCHORS), set(), True
    content = [(w, k) for k, w in enumerate(low) if w not in anchors]
    for at, (_, k) in enumerate(content):
        after = at == 0 or (k and low[k - 1] in anchors)
        if after:
            out.add(tuple(w for w, _ in content[at : at + spotsigs.CHAIN]))
    between = " ".join("|" if w in anchors else w for w in low).split("|")
    for part in (p.split() for p in between):
        out |= {tuple(part[k : k + spotsigs.CHAIN]) for k in range(1, len(part) - spotsigs.CHAIN + 1)}
    return out


def test_every_part_of_a_text_without_anchors_counts(spark):
    rng = np.random.default_rng(4)
    scripts = ["".join(chr(c) for c in range(a, a + 30)) for a in (0x430, 0x5D0, 0x4E00, 0x905)]
    texts = [" ".join("".join(rng.choice(list(s), 4)) for _ in range(60)) for s in scripts]
    texts += [" ".join([*t.split()[:-2], "другое"]) for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = edited_likeness(docs).collect()
    assert len({r["fingerprint"] for r in got}) == len(texts)
    assert all(r["near_edited"] < 0.7 for r in got)


def test_edited_likeness(spark):
    base = "the cat sat on the mat and the dog ran to a house of stone by the old river in summer"
    rows = [(1, base), (2048, base), (5000, "und der Mann geht in die Stadt für ein Brot " * 30), (5000, "of the"), (7, "!?"), (9, None), (10, ""), (None, "x y")]
    docs = spark.createDataFrame([(*r, "c") for r in rows], "doc_id bigint, text string, run string").repartition(3)
    got = edited_likeness(docs).collect()
    assert len(got) == len(rows)
    texts = sorted(((r[0], r[1] or "") for r in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    by = {(r["doc_id"], r["n_chars"]): r for r in got}
    for k, (doc_id, text) in enumerate(texts):
        following = texts[(k + 1) % len(texts)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        row = by[doc_id, len(text)]
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        a, b, c = (brute_signatures(t) or ({t} if t else set()) for t in (text, edited, following))
        like = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
        assert row["near_edited"] == pytest.approx(like(a, b)) and row["near_next"] == pytest.approx(like(a, c))
        assert len(row["fingerprint"]) == 8 * len(a)
    same = {r["fingerprint"] for r in got if r["doc_id"] in (1, 2048)}
    assert len(same) == 1
    assert edited_likeness(docs.limit(0)).count() == 0
    lone = edited_likeness(docs.where("doc_id = 1")).first()
    assert lone["near_next"] == 1.0


def test_near_duplicates_by_signatures(spark):
    rng = np.random.default_rng(2)
    filler = list(spotsigs.ANCHORS)
    texts = [" ".join(w if i % 3 else filler[int(rng.integers(20))] for i, w in enumerate(words(rng, int(n), 3000))) for n in rng.integers(30, 200, 25)]
    for k in range(0, 12, 2):
        copy = texts[k].split()
        copy[len(copy) // 2] = "edited"
        texts += [" ".join(copy), texts[k]]
    texts += ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string").repartition(3)
    sigs = {i: brute_signatures(t or "") for i, t in enumerate(texts)}
    pairs = [(a, b) for a in sigs for b in sigs if a < b and sigs[a] and sigs[b] and len(sigs[a] & sigs[b]) >= 0.8 * len(sigs[a] | sigs[b])]
    want = brute_components(pairs, sigs)
    assert {r["id"]: r["class_id"] for r in near_duplicates(docs).collect()} == want
    groups = defaultdict(list)
    for i, c in want.items():
        groups[c].append(i)
    assert max(map(len, groups.values())) >= 3

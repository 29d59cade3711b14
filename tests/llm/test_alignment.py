"""Cross-tokenizer alignment (11), source divergence (12) and whole-document packing (13) against brute force."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict
from functools import lru_cache
from itertools import product

import numpy as np
import oracle
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from segmentry.llm import alignment, divergence
from segmentry.llm.alignment import Csr, align, over_bytes, over_groups, row_products, shared_groups, token_links
from segmentry.llm.divergence import source_divergence
from segmentry.llm.minslack import combinations, fullest, pack_whole
from segmentry.llm.queries import ORACLES

SF_DIR = "/root/testdata/sf0.001"
BYTE, WORD, PIECE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
ODD = [
    None, "", " ", "  ", "a ", " a", "a  b   ", "x\ny\t z", "\0 a", "<|endoftext|> <s> </s> <unk> a<|endoftext|>", "漢字 かな a 漢字", "😀 😀a",
    "a▁b", "▁", "<0x41> <0xFF>", "naïve Ünï", "the the the", "the the the", "x" * 300, "of of of " * 40, "don't I'LL 123 4,5 ---",
]


# --- 11 -----------------------------------------------------------------------------------------------------------


def dense(m: Csr) -> np.ndarray:
    out = np.zeros((len(m.indptr) - 1, m.columns), np.int64)
    out[m.rows(), m.indices] = 1
    return out


def test_row_products_are_matrix_products():
    rng = np.random.default_rng(2)
    for rows, inner, columns in ((1, 1, 1), (7, 5, 9), (30, 40, 3), (3, 1, 50), (0, 4, 2)):
        x, y = rng.random((rows, inner)) < 0.3, rng.random((inner, columns)) < 0.4
        a, b = (Csr(np.concatenate([[0], np.cumsum(m.sum(axis=1))]), np.nonzero(m)[1], m.shape[1]) for m in (x, y))
        out = np.zeros((rows, columns), np.int64)
        row, column, value = row_products(a, b)
        out[row, column] = value
        assert (out == x.astype(int) @ y.astype(int)).all()
        assert (dense(b.transposed()) == y.T).all()


@lru_cache
def plain_models():
    a = Tokenizer.from_file(BYTE)
    a.encode_special_tokens = True
    names = {k: v for v, k in a.get_vocab().items()}
    shown = {chr(k): k for k in [*range(33, 127), *range(161, 173), *range(174, 256)]}
    shown |= {chr(256 + n): k for n, k in enumerate(k for k in range(256) if chr(k) not in shown)}
    return a, names, shown, sentencepiece.SentencePieceProcessor(model_file=PIECE)


def plain_tokens(text):
    a, names, shown, b = plain_models()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    of_a = [bytes(shown[c] for c in names[k]) for k in ids_a]
    of_b = [bytes([int(p[3:5], 16)]) if b.is_byte(k) else p.replace("▁", " ").encode() for k, p in ((k, b.id_to_piece(k)) for k in ids_b)]
    return ids_a, of_a, ids_b, of_b


def plain_alignment(texts):
    rows = []
    for text in texts:
        if not text:
            rows.append(None)
            continue
        ids_a, of_a, ids_b, of_b = plain_tokens(text)
        if not b"".join(of_a) == b"".join(of_b) == (" " + text).encode():
            rows.append(None)
            continue
        ends = [np.cumsum([len(t) for t in side]).tolist() for side in (of_a, of_b)]
        links = [
            (x, y)
            for (x, i), (y, j) in product(zip(ids_a, range(len(ids_a))), zip(ids_b, range(len(ids_b))))
            if ends[0][i] - len(of_a[i]) < ends[1][j] and ends[1][j] - len(of_b[j]) < ends[0][i]
        ]
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups = []
        for lo, hi in zip([0, *cuts], cuts):
            groups.append("|".join(",".join(str(k) for k, e in zip(ids, at) if lo < e <= hi) for ids, at in zip((ids_a, ids_b), ends)))
        shared = sum((g.split("|")[0].count(",") + 1) * (g.split("|")[1].count(",") + 1) for g in groups)
        rows.append((len(ids_a), len(ids_b), len(groups), len(links), shared, links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    counts = Counter(pair for r in rows if r for pair in set(r[5]))
    most = defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    return [
        (*r[:5], sum(counts[p] == most[p[0]] for p in r[5]), sum(counts[p] for p in r[5]), r[6]) if r else (0,) * 7 + ("",)
        for r in rows
    ]


@pytest.mark.parametrize("frequent", [500_000, 3])
def test_alignment_equals_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(alignment, "FREQUENT", frequent)
    stored = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("length(text) < 1500").limit(60).collect()
    texts = ODD + [r["text"] for r in stored]
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)], "doc_id bigint, text string, row string").repartition(5)
    got = align(docs, BYTE, PIECE).orderBy("doc_id").collect()
    for row, want, text in zip(got, plain_alignment(texts), texts, strict=True):
        assert tuple(row)[1:] == want, text


def test_long_texts_are_aligned_in_parts(spark, monkeypatch):
    texts = ["some words of a text, repeated  often enough\n" * 30, "漢字 " * 200]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    whole = align(docs, BYTE, PIECE).orderBy("doc_id").collect()
    aligner = alignment.Aligner(BYTE, PIECE)
    monkeypatch.setattr(alignment, "PART", 40)
    for row, text in zip(whole, texts):
        parts = list(aligner.parts(text))
        found = alignment.folded(iter(parts))
        assert [found[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_shared", "groups_sha256")] == [
            row[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_shared", "groups_sha256")
        ]
        assert found["times"].sum() == found["n_links"]
    assert len(list(aligner.parts(texts[0]))) > 10


def test_pairs_that_share_a_group():
    a, b = over_bytes(np.array([2, 1, 3])), over_bytes(np.array([1, 2, 1, 2]))
    in_a, in_b = over_groups(a, b)
    assert in_a.columns == 2
    assert list(shared_groups(in_a, in_b)) == [(0, 0), (0, 1), (1, 0), (1, 1), (2, 2), (2, 3)]


def test_alignment_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert align(docs, BYTE, PIECE).count() == 0
    none = spark.createDataFrame([(1, None), (None, ""), (1, None)], "doc_id bigint, text string")
    assert [tuple(r)[1:] for r in align(none, BYTE, PIECE).collect()] == [(0,) * 7 + ("",)] * 3
    assert token_links(none, BYTE, PIECE).selectExpr("sum(size(pairs))").first()[0] == 0


# --- 12 -----------------------------------------------------------------------------------------------------------


def odd_documents(spark):
    rows = [("en", "a", "the cat The CAT sat"), ("en", "a", None), ("en", None, "the cat, the dog"), ("en", "b", "dog dog the-cat Été été"), ("en", "b", "")]
    rows += [("en", "c", "123 456 ..."), (None, "a", "lone words"), (None, None, "lone words"), ("", "a", "lone lone"), ("de", "a", "kein Wort")]
    rows += [("en", "d", "tie word tie word")] * 3 + [("en", "d", "漢字 ÀB àb"), ("en", "a", "漢字 ÀB àb"), ("en", "b", "漢字 ÀB àb \0 x_y")]
    rows += [("fr", "", "mot " * 5000)] * 3
    schema = "lang string, source string, text string"
    return spark.createDataFrame([(*r, 1.5, "z") for r in rows], schema + ", n double, term string")


def test_divergence_on_odd_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(divergence, "SEGMENT", 64)
    monkeypatch.setattr(divergence, "HELD", 5)
    path = str(tmp_path / "documents.parquet")
    odd_documents(spark).coalesce(1).write.parquet(path)
    con = oracle.connect(str(tmp_path))
    con.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM read_parquet('{path}/*.parquet')")
    problem, rows = oracle.compare(source_divergence(spark.read.parquet(path)), con, ORACLES["op12_source_divergence"])
    assert problem is None and rows > 30


def test_divergence_of_nothing(spark):
    assert source_divergence(spark.createDataFrame([], "doc_id int, lang string, source string, text string")).count() == 0


def test_ranks_end_within_ties(spark):
    rows = [("en", s, " ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(300)) if s == "a" else "") for s in "aaab"]
    found = source_divergence(spark.createDataFrame(rows, "lang string, source string, text string"), top=7)
    items = [r["item"] for r in found.where("part = 'term' and source = 'a'").orderBy("rank").collect()]
    assert items == []  # the language has no other words, so nothing is more frequent than there
    rows.append(("en", "b", "other " * 50))
    rows += [("en", "c", "other")] * 3
    found = source_divergence(spark.createDataFrame(rows, "lang string, source string, text string"), top=7)
    ranked = found.where("part = 'term' and source = 'a'").orderBy("rank").collect()
    assert [r["rank"] for r in ranked] == list(range(1, 8))
    assert [r["item"] for r in ranked] == sorted(f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(300))[:7]


# --- 13 -----------------------------------------------------------------------------------------------------------


def test_fullest_combination_is_the_best():
    rng = np.random.default_rng(5)
    for _ in range(200):
        capacity = int(rng.integers(4, 40))
        have = Counter(rng.integers(1, capacity + 1, int(rng.integers(1, 9))).tolist())
        chosen = fullest(dict(have), capacity)
        seed = max(have)
        rest = list((have - Counter([seed])).elements())
        sums = {0}
        for w in rest:
            sums |= {s + w for s in sums}
        assert sum(w * n for w, n in chosen.items()) == seed + max(s for s in sums if seed + s <= capacity)
        assert all(n <= have[w] for w, n in chosen.items()) and chosen[seed] >= 1


def test_combinations_use_up_all_pieces():
    rng = np.random.default_rng(6)
    demand = np.bincount(np.minimum(1 + rng.lognormal(4, 1.3, 20_000).astype(int), 512), minlength=513)
    left, sequences = demand.copy(), 0
    for chosen, times in combinations(demand, 512):
        for w, n in chosen.items():
            left[w] -= n * times
        sequences += times
    assert not left.any()
    assert sequences <= math.ceil((demand * np.arange(513)).sum() / 512) + 1
    assert combinations(np.zeros(9, np.int64), 8) == []


def packed_rows(docs, capacity):
    rows = pack_whole(docs, WORD, 1, capacity, keep_ids=True).collect()
    at = defaultdict(list)
    for r in rows:
        assert len(r["ids"]) == 4 * r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"] and 0 < r["length"] <= capacity
        at[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in at.values():
        places.sort()
        ends = np.cumsum([n for _, n in places]).tolist()
        assert [o for o, _ in places] == [0, *ends[:-1]] and ends[-1] <= capacity
    return rows, len(at)


def test_whole_packing(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows, used = packed_rows(docs, 4096)
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    t = Tokenizer.from_file(WORD)
    of_doc = defaultdict(list)
    for r in rows:
        of_doc[r["doc_id"]].append(r)
    assert set(of_doc) == set(texts)
    for doc_id, pieces in of_doc.items():
        pieces.sort(key=lambda r: r["start"])
        assert [r["piece"] for r in pieces] == list(range(len(pieces)))
        assert [r["start"] for r in pieces] == [4096 * k for k in range(len(pieces))]
        ids = [*t.encode(texts[doc_id], add_special_tokens=False).ids, 1]
        assert b"".join(r["ids"] for r in pieces) == np.array(ids, "<u4").tobytes()
    assert used <= math.ceil(sum(r["length"] for r in rows) / 4096) + 1


def test_whole_packing_of_odd_rows(spark):
    rows = [(3, "a b c", "x"), (1, None, "x"), (1, "same id", "y"), (None, "no id", "z"), (2, "", None), (7, "long word " * 400, "x"), (1, "same id", "y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, rank string").withColumnsRenamed({"rank": "task"}).repartition(3)
    got, _ = packed_rows(docs, 16)
    assert sum(r["length"] for r in got) == sum(len(Tokenizer.from_file(WORD).encode(r[1] or "").ids) + 1 for r in rows)
    assert sum(r["piece"] == 0 for r in got) == len(rows)
    assert pack_whole(docs.where("false"), WORD).count() == 0

"""Packing (2), token-id files (10) and the piece encoder against the tokenizers library."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from segmentry.llm import jaccard, tokens
from segmentry.llm.binary_ids import from_planes, read_document, read_ids, to_planes, token_files, write_ids
from segmentry.llm.packing import column_generation, knapsack, make_plan, pack, sequences
from segmentry.llm.tokens import PieceEncoder

SF_DIR = "/root/testdata/sf0.001"
BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = [
    "", " ", "  a  b", "a\n b", "x \n\ny ", "\0 \0a b", "<|endoftext|> a <|endoftext|>b", "it's 's ' s", "ΑΣ ΑΣ b é é", "a b ́c",
    "漢字 かな a", "😀 😀a b", "a\x1c b \x1d c", "123 4 5,6 ---  !!", "don't I'LL x'y", "foo|startoftext|> <|startoftext|>",
    " ".join(chr(c) for c in range(0xC0, 0x250)), " aĀİıŉǅb ǰ x", "word " * 3000,
]


def plain(path, text, special=False):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = special
    return t.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTE, WORD])
@pytest.mark.parametrize("segment", [1 << 20, 50])
@pytest.mark.parametrize("special", [False, True])
def test_pieces_encode_as_whole_texts_do(path, segment, special, monkeypatch):
    monkeypatch.setattr(tokens, "SEGMENT", segment)
    encoder = PieceEncoder(path, max_pieces=30, plain=special)
    odd = [*ODD, "Hello<|endoftext|>x", "<|STARTOFTEXT|> <|startoftext|>a<|EndOfText|>", "<|endoftext|>"]
    for _ in range(2):
        for text, ids in zip(odd, encoder.encode(odd)):
            assert ids.tolist() == plain(path, text, special), text[:40]


def test_what_stands_between_blanks_is_cut_once_for_all_texts(monkeypatch):
    encoder, seen = PieceEncoder(BYTE), []
    ids_of = encoder._ids
    monkeypatch.setattr(encoder, "_ids", lambda pieces: seen.append(len(pieces)) or ids_of(pieces))
    texts = ["one two, one two: three four", "two, one four 漢 字 a", "four  two, one", "one four é", "four Éa one\n", " one two"] * 100
    for text, ids in zip(texts, encoder.encode(texts)):
        assert ids.tolist() == plain(BYTE, text)
    # Texts with a blank that ends no piece are cut as a whole.
    assert 2 * sum(seen) < 100 * sum(len(tokens.PIECES.findall(text)) for text in texts[:6])


def test_encoders_end_where_a_task_needs_none():
    class Frame:
        def mapInArrow(self, step, kinds):
            return step

    for step in (jaccard._described(Frame(), 5, 80), jaccard._shared(Frame())):
        kept = tokens.encoder(WORD)
        assert tokens.encoder(WORD) is kept
        assert list(step(iter([]))) == []
        assert tokens.encoder(WORD) is not kept


def edge_rows(spark):
    rows = [(3, "a b c", "x"), (1, None, "x"), (1, "same id", "y"), (None, "no id", "z"), (2, "", None), (7, "long word " * 4000, "x"), (1, "same id", "y")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, ids string").withColumnRenamed("ids", "path")


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_planes_round_trip(kind):
    ids = np.random.default_rng(0).integers(0, 1 << 32, 1003, dtype=np.uint64).astype(np.uint32)
    assert (from_planes(to_planes(ids, kind), len(ids), kind) == ids).all()


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_token_files(spark, tmp_path, kind):
    docs = edge_rows(spark).repartition(3)
    folder = write_ids(docs, WORD, 1, str(tmp_path / "ids"), kind, block=100)
    rows = read_ids(spark, folder, keep_ids=True).orderBy("start").collect()
    want = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert [r["doc_id"] for r in rows] == [k for k, _ in want]
    start = 0
    for row, (_, text) in zip(rows, want):
        ids = [*plain(WORD, text), 1]
        assert (row["ids"], row["start"], row["n_tokens"]) == (ids, start, len(ids))
        assert row["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        assert read_document(row["path"], row["position"]).tolist() == ids
        start += len(ids)


def test_token_files_of_an_empty_table(spark):
    assert token_files(edge_rows(spark).limit(0), WORD, 1).count() == 0


def test_knapsack_is_the_best_filling():
    values = np.array([-1.0, 1.0, 2.5, -1.0, 5.4])
    best, _ = knapsack(values, 9)
    for c in range(10):
        every = [a + 2.5 * b + 5.4 * d for a in range(c + 1) for b in range(c // 2 + 1) for d in range(c // 4 + 1) if a + 2 * b + 4 * d <= c]
        assert best[c] == pytest.approx(max(every))


@pytest.mark.parametrize("n", [3, 200, 4000])
def test_column_generation_covers_exactly_and_nearly_without_waste(n):
    demand = np.bincount(np.random.default_rng(n).integers(1, 64, n), minlength=65)
    patterns, times = column_generation(demand, 64)
    assert (patterns @ np.arange(65) <= 64).all() and (times >= 0).all()
    np.testing.assert_allclose(times @ patterns, demand, atol=1e-6 * n)
    bins: list[int] = []  # first fit decreasing
    for w in range(64, 0, -1):
        for _ in range(demand[w]):
            k = next((i for i, room in enumerate(bins) if room >= w), len(bins))
            bins[k:k + 1] = [(bins[k] if k < len(bins) else 64) - w]
    assert demand @ np.arange(65) / 64 - 1e-6 <= times.sum() <= len(bins) + 1e-6


def test_plan_places_every_rank_once():
    demand = np.bincount(np.random.default_rng(1).integers(1, 65, 3000), minlength=65)
    plan = make_plan(demand, 64)
    filled: dict[int, list] = {}
    for w in range(1, 65):
        length, rank = np.full(demand[w], w), np.arange(demand[w])
        placed, sequence, offset = plan.place(length, rank)
        for ok, s, o in zip(placed, sequence, offset):
            parts = [(s, o, 0, w)] if ok else plan.split(int(o), w)
            for seq, begin, a, b in parts:
                filled.setdefault(int(seq), []).append((int(begin), b - a))
    lengths = []
    for parts in filled.values():
        at = 0
        for begin, n in sorted(parts):
            assert begin == at
            at += n
        assert at <= 64
        lengths.append(at)
    assert sum(lengths) == demand @ np.arange(65)
    assert sum(64 - n for n in lengths if n & (n - 1)) < 0.02 * sum(lengths)


@pytest.mark.parametrize("capacity", [16, 1024])
def test_pack(spark, capacity):
    docs = edge_rows(spark).repartition(3)
    pieces = pack(docs, BYTE, 0, capacity, keep_ids=True).persist()
    rows = pieces.collect()
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in rows)
    texts: dict = {}
    for r in docs.collect():
        texts.setdefault(r["doc_id"], []).append([*plain(BYTE, r["text"] or ""), 0])
    for doc_id, wanted in texts.items():
        got = [i for r in rows if r["doc_id"] == doc_id for i in np.frombuffer(r["ids"], "<u4").tolist()]
        assert sorted(got) == sorted(i for ids in wanted for i in ids)
    for r in sequences(pieces).collect():
        parts = sorted((p["offset"], p["ids"]) for p in rows if p["sequence_id"] == r["sequence_id"])
        assert b"".join(p for _, p in parts) == r["ids"] and len(r["ids"]) <= 4 * capacity
        assert [o for o, _ in parts] == np.cumsum([0, *[len(p) // 4 for _, p in parts]])[:-1].tolist()
    assert pack(docs.limit(0), BYTE).count() == 0

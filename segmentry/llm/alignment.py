"""Which tokens of two tokenizers cover the same bytes of a text.

The tokens of a text are the rows of a sparse incidence matrix whose columns are the text's bytes, held in CSR
form.  The row products of one tokenizer's matrix with the other's transposed one (Gustavson: a row of the
product gathers the rows that its entries point to) are the links, tokens that overlap, with the
number of bytes they share.  Byte offsets where tokens of both end cut the text into groups; incidence of tokens in
groups lists each group's tokens, and its product are the pairs that share a group.

How often a pair of ids is linked is counted over all texts.  The counts come back to the texts by a join: pairs that make
up more than one in ``FREQUENT`` of all rows, hence at most so many, are broadcast, the rest is joined by shuffle,
where no pair has many rows.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmentry.llm.common import text_or_empty, written
from segmentry.llm.tokens import CUT, encoder

#: Pairs that are broadcast at most: those that make up one in so many rows or more.
FREQUENT = 500_000
#: Code points of a batch of texts, and of the parts of a longer text; only bound memory.
BATCH, PART = 1 << 19, 1 << 20
#: What the second tokenizer can encode by itself: none of its pieces holds a blank after another character.
WORD = re.compile(" +[^ ]*")


@dataclass
class Csr:
    """A sparse 0/1 matrix: row i has its entries in the columns ``indices[indptr[i]:indptr[i + 1]]``."""

    indptr: np.ndarray
    indices: np.ndarray
    columns: int

    def rows(self) -> np.ndarray:
        """The row of every entry."""
        return np.repeat(np.arange(len(self.indptr) - 1), np.diff(self.indptr))

    def transposed(self) -> Csr:
        order = np.argsort(self.indices, kind="stable")
        ends = np.cumsum(np.bincount(self.indices, minlength=self.columns))
        return Csr(np.concatenate([[0], ends]), self.rows()[order], len(self.indptr) - 1)


def row_products(a: Csr, b: Csr) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries ``(row, column, value)`` of ``a`` times ``b``, by row and column."""
    begin = b.indptr[a.indices]
    size = b.indptr[a.indices + 1] - begin
    met = np.cumsum(size)
    take = np.repeat(begin - met + size, size) + np.arange(met[-1] if len(met) else 0)
    cell = np.repeat(a.rows(), size) * b.columns + b.indices[take]
    if (cell[1:] < cell[:-1]).any():
        cell.sort()
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(cell)), bool), cell[1:] != cell[:-1]]))
    value = np.diff(np.append(first, len(cell)))
    row, column = np.divmod(cell[first], max(1, b.columns))
    return row, column, value


def over_bytes(lengths: np.ndarray) -> Csr:
    """Tokens by bytes, for tokens of the given lengths one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return Csr(np.concatenate([[0], ends]).astype(np.int64), np.arange(total), total)


def over_groups(a: Csr, b: Csr) -> tuple[Csr, Csr]:
    """Tokens by groups: the spans between offsets where a token of ``a`` and one of ``b`` end."""
    cuts = np.intersect1d(a.indptr[1:], b.indptr[1:], assume_unique=True)
    found = (np.searchsorted(cuts, m.indptr[1:]) for m in (a, b))
    one, two = (Csr(np.arange(len(g) + 1), g, len(cuts)) for g in found)
    return one, two


def shared_groups(a: Csr, b: Csr) -> Iterator[tuple[int, int]]:
    """Pairs of tokens that share a group, given tokens by groups; a row of the product at a time."""
    turned = b.transposed()
    for k in range(len(a.indptr) - 1):
        row = Csr(a.indptr[k : k + 2] - a.indptr[k], a.indices[a.indptr[k] : a.indptr[k + 1]], a.columns)
        for other in row_products(row, turned)[1].tolist():
            yield k, other


def byte_level(entry: str) -> bytes:
    """The bytes that an entry of a byte-level vocabulary stands for."""
    return bytes(_BYTE_OF[c] for c in entry)


def _byte_of() -> dict[str, int]:
    # Visible bytes stand for themselves; the others follow from code point 256 on, in order.
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [k for k in range(256) if k not in visible]
    return {chr(k): k for k in visible} | {chr(256 + n): k for n, k in enumerate(hidden)}


_BYTE_OF = _byte_of()


class WordPieces:
    """Encodes words, blanks in front, by a piece model; ids of words are kept for their next occurrence."""

    def __init__(self, path: str, most: int = 1 << 24):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        hexed = re.compile("<0x([0-9A-F]{2})>")
        self.bytes_of = [bytes.fromhex(m[1]) if (m := hexed.fullmatch(p)) else p.replace("▁", " ").encode() for p in pieces]
        if any(re.search("[^▁]▁", p) for p in pieces):
            raise ValueError("a piece holds a blank after another character: words can't be encoded one by one")
        self.most = most  # code points of the words that are kept
        self._forget()

    def _forget(self) -> None:
        self.slot: dict[str, int] = {}
        self.flat, self.first, self.size, self.exact = np.zeros(0, np.int64), *(np.zeros(0, np.int64) for _ in range(2)), np.zeros(0, bool)
        self.held = 0

    def _learn(self, words: list[str]) -> None:
        # The model puts a blank in front of what it is given; blanks alone it encodes after something only.
        given = [w[1:] if w.strip(" ") else "x" + w for w in words]
        found = self.model.encode(given, num_threads=1)
        found = [ids if w.strip(" ") else ids[1:] for w, ids in zip(words, found)]
        exact = [b"".join(map(self.bytes_of.__getitem__, ids)) == w.encode() for w, ids in zip(words, found)]
        size = np.array([len(ids) for ids in found], np.int64)
        self.slot.update(zip(words, range(len(self.slot), len(self.slot) + len(words))))
        self.first = np.concatenate([self.first, len(self.flat) + np.cumsum(size) - size])
        self.flat = np.concatenate([self.flat, np.array([k for ids in found for k in ids], np.int64)])
        self.size, self.exact = np.concatenate([self.size, size]), np.concatenate([self.exact, exact])
        self.held += sum(map(len, words))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of texts that begin with a blank, their number per text, and whether a text's pieces spell it."""
        if self.held > self.most:
            self._forget()
        parts = [WORD.findall(t) for t in texts]
        words = [w for p in parts for w in p]
        slots = list(map(self.slot.get, words))
        if None in slots:
            self._learn(list(dict.fromkeys(w for w, k in zip(words, slots) if k is None)))
            slots = list(map(self.slot.__getitem__, words))
        slots = np.array(slots, np.int64)
        size = self.size[slots]
        ends = np.cumsum(size)
        ids = self.flat[np.repeat(self.first[slots] - ends + size, size) + np.arange(int(size.sum()))]
        bounds = np.cumsum([0, *map(len, parts)])
        upto = np.concatenate([[0], ends])[bounds]
        wrong = np.concatenate([[0], np.cumsum(~self.exact[slots])])[bounds]
        return ids, np.diff(upto), np.diff(wrong) == 0


class Aligner:
    """Aligns texts by a byte-level tokenizer A and a piece model B."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = encoder(path_a, plain=True), WordPieces(path_b)
        vocabulary = self.a.tokenizer.get_vocab(with_added_tokens=False)
        size = max(self.a.tokenizer.get_vocab(with_added_tokens=True).values()) + 1
        self.bytes_a = [b""] * size
        for entry, k in vocabulary.items():
            self.bytes_a[k] = byte_level(entry)
        self.length_a, self.length_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.b.bytes_of))
        self.size_a, self.size_b = size, len(self.b.bytes_of)
        self.names = [b"%d%s" % (k, end) for end in (b",", b"|", b";") for k in range(max(self.size_a, self.size_b))]

    def tokens(self, parts: list[str]):
        """Ids of both for texts that begin with a blank, their numbers, and whether both spell the text."""
        of_a = self.a.encode(parts)
        ids_b, n_b, fine = self.b.encode(parts)
        n_a = np.array([len(x) for x in of_a], np.int64)
        ids_a = np.concatenate(of_a).astype(np.int64) if of_a else np.zeros(0, np.int64)
        raw = [p.encode() for p in parts]
        if b"".join(map(self.bytes_a.__getitem__, ids_a.tolist())) != b"".join(raw):
            spelt = (b"".join(map(self.bytes_a.__getitem__, x.tolist())) for x in of_a)
            fine = fine & np.array([s == r for s, r in zip(spelt, raw)], bool)
        if not fine.all():
            ids_a, ids_b = ids_a[np.repeat(fine, n_a)], ids_b[np.repeat(fine, n_b)]
            n_a, n_b = n_a * fine, n_b * fine
        return ids_a, n_a, ids_b, n_b, fine

    def align(self, parts: list[str]) -> Iterator[dict | None]:
        """For each text that begins with a blank what links its tokens; None where the tokens don't spell it."""
        ids_a, n_a, ids_b, n_b, fine = self.tokens(parts)
        a, b = over_bytes(self.length_a[ids_a]), over_bytes(self.length_b[ids_b])
        in_a, in_b = over_groups(a, b)
        row, column, _ = row_products(a, b.transposed())
        end_a, end_b = np.cumsum(n_a), np.cumsum(n_b)

        part = np.searchsorted(end_a, row, "right")
        pairs = self.size_a * self.size_b
        cell, times = np.unique(part * pairs + ids_a[row] * self.size_b + ids_b[column], return_counts=True)
        bounds = np.searchsorted(cell, np.arange(len(parts) + 1) * pairs).tolist()
        keys = cell % pairs
        n_links = np.bincount(part, minlength=len(parts)).tolist()

        # Each group's tokens: of A, then of B; what follows an id says whether its side or group ends there.
        by_a, by_b = in_a.transposed(), in_b.transposed()
        group_a, group_b = in_a.indices, in_b.indices
        stop_a = by_a.indptr[group_a + 1] == np.arange(1, len(ids_a) + 1)
        stop_b = by_b.indptr[group_b + 1] == np.arange(1, len(ids_b) + 1)
        shown = np.zeros(len(ids_a) + len(ids_b), np.int64)
        most = len(self.names) // 3
        shown[np.arange(len(ids_a)) + by_b.indptr[group_a]] = ids_a + stop_a * most
        shown[np.arange(len(ids_b)) + by_a.indptr[group_b + 1]] = ids_b + stop_b * (2 * most)
        written_out = list(map(self.names.__getitem__, shown.tolist()))
        shared = np.cumsum(np.diff(by_a.indptr) * np.diff(by_b.indptr))

        last = 0
        for k, (x, y, ok) in enumerate(zip(end_a.tolist(), end_b.tolist(), fine.tolist())):
            if not ok:
                yield None
                continue
            groups = int(group_a[x - 1]) + 1 if x else 0
            yield {
                "n_a": int(n_a[k]), "n_b": int(n_b[k]), "n_groups": groups - last, "n_links": n_links[k],
                "n_shared": int(shared[groups - 1] - (shared[last - 1] if last else 0)) if groups > last else 0,
                "groups": b"".join(written_out[x + y - int(n_a[k] + n_b[k]) : x + y]),
                "keys": keys[bounds[k] : bounds[k + 1]], "times": times[bounds[k] : bounds[k + 1]],
            }
            last = groups

    def parts(self, text: str) -> Iterator[dict | None]:
        """The links of a long text in parts: cut where a token of either begins, so that no group spans a cut."""
        text, at = " " + text, 0
        while at < len(text):
            cut = CUT.search(text, at + PART)
            end = cut.start() if cut else len(text)
            yield from self.align([text[at:end]])
            at = end


def folded(parts: Iterator[dict | None]) -> dict | None:
    """One text's links from those of its parts, which come one at a time."""
    digest, end = hashlib.sha256(), b""
    sums = dict.fromkeys(_COUNTS, 0)
    keys = times = np.zeros(0, np.int64)
    for part in parts:
        if part is None:
            return None
        digest.update(end + part["groups"][:-1])
        end = part["groups"][-1:]
        sums = {c: sums[c] + part[c] for c in _COUNTS}
        if not len(keys):
            keys, times = part["keys"], part["times"]
            continue
        keys, at = np.unique(np.concatenate([keys, part["keys"]]), return_inverse=True)
        times = np.bincount(at, np.concatenate([times, part["times"]])).astype(np.int64)
    return sums | {"keys": keys, "times": times, "groups_sha256": digest.hexdigest()}


_COUNTS = ["n_a", "n_b", "n_groups", "n_links", "n_shared"]


def _aligner(path_a: str, path_b: str) -> Aligner:
    kept = sys.__dict__.setdefault("_segmentry_aligners", {})
    if (path_a, path_b) not in kept:
        kept[path_a, path_b] = Aligner(path_a, path_b)
    return kept[path_a, path_b]


def token_links(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per text of ``docs``: counts, digest, and ``pairs`` of ``key`` (A's id times B's vocabulary plus B's id) and times."""
    pair = pa.struct([("key", pa.int64()), ("times", pa.int64())])
    schema = pa.schema(
        [("doc_id", pa.int64())] + [(c, pa.int64()) for c in _COUNTS] + [("groups_sha256", pa.string()), ("pairs", pa.list_(pair))]
    )

    def found(ids: list, texts: list[str]) -> pa.RecordBatch:
        aligner = _aligner(path_a, path_b)
        links = aligner.align([" " + t for t in texts if 0 < len(t) <= PART])
        rows = [folded(iter([next(links)]) if len(t) <= PART else aligner.parts(t)) if t else None for t in texts]
        columns = [pa.array(ids, pa.int64())] + [pa.array([r[c] if r else 0 for r in rows], pa.int64()) for c in _COUNTS]
        columns.append(pa.array([r["groups_sha256"] if r else "" for r in rows]))
        none = np.zeros(0, np.int64)
        flat = [np.concatenate([none, *(r[c] for r in rows if r)]).astype(np.int64) for c in ("keys", "times")]
        ends = np.cumsum([0] + [len(r["keys"]) if r else 0 for r in rows]).astype(np.int32)
        structs = pa.StructArray.from_arrays([pa.array(x) for x in flat], fields=list(pair))
        return pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(ends), structs, type=pa.list_(pair))], schema=schema)

    def link(batches):
        for batch in batches:
            ids, texts, size = [], [], 0
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(key)
                texts.append(text)
                size += len(text)
                if size >= BATCH or len(ids) >= 512:
                    yield found(ids, texts)
                    ids, texts, size = [], [], 0
            if ids:
                yield found(ids, texts)

    kinds = "doc_id bigint, " + ", ".join(f"{c} bigint" for c in _COUNTS)
    kinds += ", groups_sha256 string, pairs array<struct<key bigint, times bigint>>"
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(link, kinds)


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_shared, n_best, count_sum, groups_sha256)`` for each row of ``docs(doc_id, text)``.

    A encodes a blank and the text, B the text, to which it adds the blank; strings of special tokens are plain text.
    ``n_links`` are pairs of tokens that overlap, ``n_shared`` those that share a group.  An id pair counts
    the rows that hold it linked: ``count_sum`` adds up the counts of a text's links, ``n_best`` are those whose
    count is the highest of their A id, ties included.  ``groups_sha256`` digests the ids by group, ``a1,a2|b1;a3|b2``.

    Texts that are null or empty, or that the tokens of A or B don't spell (a text that holds U+2581), have no tokens:
    zeros and an empty digest.  Every row is a text of its own, also when rows or ``doc_id`` repeat or are null; an
    empty table gives no rows.  Other columns are ignored.
    """
    links = written(token_links(docs, path_a, path_b).withColumn("row", F.monotonically_increasing_id()), "token-links")
    size_b = _vocabulary_of(path_b)
    counts = links.select(F.explode("pairs.key").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("texts"))
    counts = written(counts.withColumn("a", F.expr(f"key div {size_b}")), "pair-counts")
    highest = counts.groupBy("a").agg(F.max("texts").alias("most"))
    counts = written(counts.join(highest, "a").select("key", "texts", (F.col("texts") == F.col("most")).alias("best")), "ranked-pairs")
    total = counts.agg(F.sum("texts")).first()[0] or 0
    often = F.col("texts") * FREQUENT >= total
    rows = links.select("row", F.explode("pairs").alias("p")).select("row", "p.key", "p.times")
    frequent = F.broadcast(counts.where(often))
    parts = [rows.join(frequent, "key"), rows.join(frequent, "key", "left_anti").join(counts.where(~often), "key")]
    best = F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best")
    sums = [p.groupBy("row").agg(best, F.sum(F.col("times") * F.col("texts")).alias("count_sum")) for p in parts]
    sums = sums[0].union(sums[1]).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = F.lit(0).cast("bigint")
    result = links.drop("pairs").join(sums, "row", "left")
    result = result.withColumns({c: F.coalesce(c, zero) for c in ("n_best", "count_sum")})
    return result.select("doc_id", *_COUNTS, "n_best", "count_sum", "groups_sha256")


def _vocabulary_of(path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path).get_piece_size()

"""Personal data: patterns, and terms that reveal what the patterns protect.

Every e-mail address, IP address, card or phone number found is a protected entity.  Over the
whole corpus, counts of distinct texts tell how strongly a term in an entity's texts reveals it:

    disclosure(t, e) = PMI(t, e) / IC(e) = ln(N n(t,e) / (n(t) n(e))) / ln(N / n(e))

which is 1 if the term occurs with the entity only.  Few texts tell little, so a term is taken if its disclosure is
above one threshold also with half a text added to the counts of term, entity and corpus: 1 - ln((n(t) + 1/2) / n(t,e)) /
ln((N + 1/2) / (n(e) + 1/2)).  Terms taken are replaced by a placeholder for the kind of entity, those whose
disclosure is above a higher threshold are removed, wherever they occur.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmentry.llm.common import sized, text_or_empty, written

#: Columns that ``sanitise`` adds.
ADDED = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "sanitised"]
KINDS = ("email", "ip", "card", "phone")
#: Texts added to the counts of term, entity and corpus where they are evidence.
SMOOTH = 0.5
GENERALISE, REMOVE = 0.95, 0.99
#: Words on either side of an entity that ``_beside`` lists; no limit to what is counted.
NEAR = 8

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits that fails from its start fails from within, so attempts begin at its start only.
_IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
#: A term is a run of at least three letters.
TERM = re.compile(r"[^\W\d_]{3,}")


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _emails(text: str):
    if "@" not in text:
        return
    free = 0  # where the last address ends
    for m in _DOMAIN.finditer(text):
        at = start = m.start()
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            free = m.end()
            yield start, free


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` by start and then in the order of ``KINDS``; code points, end exclusive."""
    found = [(a, 0, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = _digits(m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_digits(m[0])) <= 15:
                    found.append((m.start(), 3, m.end()))
    return [(a, b, KINDS[k]) for a, k, b in sorted(found)]


def _joined(spans) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def _value(kind: str, text: str) -> str:
    return kind + ":" + (_digits(text) if kind in ("card", "phone") else text.lower())


def masked(text: str, spans: list[tuple[int, int, str]], instead: dict[tuple[int, int], str] | None = None) -> str:
    """Spans replaced by placeholders; of overlapping ones, the union by the first's."""
    out, at = [], 0
    for a, b, kind in spans:
        if a >= at:
            out += [text[at:a], instead[a, b] if instead and (a, b) in instead else f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def _beside(text: str, spans: list[tuple[int, int, str]]) -> list[set[str]]:
    """For each span the ``NEAR`` words before it and those after it, whatever is between them."""
    words = list(TERM.finditer(text))
    starts, ends = [m.start() for m in words], [m.end() for m in words]
    sides = ((bisect_right(ends, a), bisect_left(starts, b)) for a, b, _ in spans)
    return [{m[0].lower() for m in words[max(0, k - NEAR) : k] + words[n : n + NEAR]} for k, n in sides]


def revealing_terms(docs: DataFrame, smooth: float = SMOOTH, generalise: float = GENERALISE) -> tuple[DataFrame, DataFrame]:
    """``(term, kind, disclosure)`` of the terms that reveal an entity, and ``(text_hash, term)`` for where they are.

    All counts are of different texts, so copies add nothing; a text holds entity and term wherever in it they are.
    Every term that stands outside the entities of a text is counted with every one of them.
    """
    schema = pa.schema([("text_hash", pa.int64()), ("entity", pa.string()), ("kind", pa.string()), ("term", pa.string())])

    def mentions(batches):
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                spans = base_spans(text)
                if spans:
                    plain = masked(text, spans)
                    shown = {w.lower() for w in TERM.findall(text)} & {w.lower() for w in TERM.findall(plain)}
                    rows += [(key, *e, None) for e in sorted({(_value(kind, text[a:b]), kind) for a, b, kind in spans})]
                    rows += [(key, None, None, t) for t in sorted(shown)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    hashed = docs.select(F.xxhash64("text").alias("text_hash"), "text")
    found = written(hashed.mapInArrow(mentions, "text_hash bigint, entity string, kind string, term string"), "mentions", texts=True)
    mentioned = written(found.where("term IS NULL").select("text_hash", "entity", "kind").distinct(), "mentioned")
    shown = written(found.where("term IS NOT NULL").select("text_hash", "term").distinct(), "shown-terms")
    # Entities of a kind that are in the same texts reveal alike: one of them stands for all.
    which = [F.min("text_hash").alias("low"), F.max("text_hash").alias("high"), F.bit_xor(F.xxhash64("text_hash")).alias("mixed")]
    entities = mentioned.groupBy("entity", "kind").agg(F.count(F.lit(1)).alias("n_entity"), *which)
    entities = written(entities.groupBy("kind", "n_entity", "low", "high", "mixed").agg(F.min("entity").alias("entity")), "entities")
    mentioned = written(mentioned.join(entities.select("entity", "n_entity"), "entity"), "entity-texts")
    n = F.lit(float(docs.select(F.count_distinct(F.xxhash64("text"))).first()[0]))
    content = F.log(n / F.col("n_entity"))

    def evident(n_term: Column, both: Column) -> Column:
        return F.log((n_term + smooth) / both) <= (1 - generalise) * F.log((n + smooth) / (F.col("n_entity") + smooth))

    # Both are in no more texts than either is, and a term is in at least the texts that have it outside some entity.  This
    # bounds what it can reveal from above: common words end here, others where their texts are counted.
    texts = shown.join(shown.groupBy("term").agg(F.count(F.lit(1)).alias("n_shown")), "term")
    possible = (content > 0) & evident(F.greatest("n_shown", "n_entity"), F.col("n_entity"))
    pairs = mentioned.join(texts, "text_hash").where(possible).select("entity", "kind", "term", "n_entity").distinct()
    pairs = written(pairs, "term-pairs")
    mentioned = mentioned.select("text_hash", "entity")
    places = docs.select(F.xxhash64("text").alias("text_hash"), F.explode(_terms()).alias("term"))

    def of(terms: DataFrame, name: str) -> DataFrame:
        return places.join(sized(written(terms.select("term").distinct(), name)), "term").distinct()

    each = of(pairs, "candidate-terms").groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    pairs = pairs.join(written(each, "term-counts"), "term")
    pairs = written(pairs.where(evident(F.col("n_term"), F.least("n_term", "n_entity"))), "possible-pairs")
    where = written(of(pairs, "possible-terms"), "term-places")

    beside = where.join(mentioned.select("text_hash").distinct(), "text_hash", "left_semi")
    beside = beside.join(pairs.select("entity", "term"), "term").join(mentioned, ["text_hash", "entity"])
    counts = beside.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("both"))
    scored = pairs.join(counts, ["entity", "term"]).where(evident(F.col("n_term"), F.col("both")))
    disclosure = F.log(n * F.col("both") / (F.col("n_term") * F.col("n_entity"))) / content
    best = scored.withColumn("disclosure", disclosure).groupBy("term").agg(F.max(F.struct("disclosure", "kind")).alias("best"))
    return written(best.select("term", "best.kind", "best.disclosure"), "revealing-terms"), where


def _terms():
    """The distinct terms of a text, as ``TERM`` finds them in lower case; to Python, numbers such as Ⅳ and ² are letters."""
    return F.array_distinct(F.transform(F.regexp_extract_all("text", F.lit(r"[\p{L}\p{Nl}\p{No}]{3,}"), F.lit(0)), F.lower))


def sanitise(docs: DataFrame, smooth: float = SMOOTH, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """``docs`` with columns about personal data; a document's other columns stay as they are.

    Adds ``n_email, n_ip, n_card, n_phone, base_sha256, spans, sanitised``.  ``spans`` lists the
    pattern spans and those of revealing terms (kind ``term``), the latter where they touch no
    former.  Null texts are treated as empty ones, which have no span; rows may repeat.
    The names added must not be in ``docs``: such columns are replaced.
    """
    added = ADDED
    docs = docs.drop(*added)
    kept = docs.columns
    texts = docs.select(text_or_empty().alias("text"))
    terms, where = revealing_terms(texts, smooth, generalise)
    of_text = where.join(terms, "term").groupBy("text_hash").agg(
        F.collect_list(F.struct("term", "kind", "disclosure")).alias("__terms")  # terms of one text
    )
    of_text = written(of_text.withColumnRenamed("text_hash", "__text_hash"), "terms-of-texts")
    hashed = docs.withColumn("__hash", F.xxhash64(text_or_empty()))
    rows = hashed.join(of_text, F.col("__hash") == F.col("__text_hash"), "left").drop("__hash", "__text_hash")
    text_at, terms_at = rows.columns.index("text"), rows.columns.index("__terms")
    kinds = "n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, sanitised string"
    extra = pa.schema([(n, pa.int64()) for n in added[:4]] + [(n, pa.string()) for n in added[4:]])

    def mark(batches):
        for batch in batches:
            out = []
            for text, terms in zip(batch.column(text_at).to_pylist(), batch.column(terms_at).to_pylist()):
                text = text or ""
                base = base_spans(text)
                spans, instead = base, {}
                if terms:
                    levels = {t["term"]: (t["kind"], t["disclosure"]) for t in terms}
                    taken, k = [(a, b) for a, b, _ in base], 0
                    more, end = [], 0
                    for m in TERM.finditer(text):
                        if m[0].lower() not in levels:
                            continue
                        while k < len(taken) and taken[k][0] < m.end():
                            end, k = max(end, taken[k][1]), k + 1
                        if end <= m.start():
                            kind, level = levels[m[0].lower()]
                            more.append((m.start(), m.end(), "term"))
                            instead[m.start(), m.end()] = "" if level >= remove else f"[{kind.upper()} TERM]"
                    spans = sorted(base + more, key=lambda s: (s[0], (*KINDS, "term").index(s[2])))
                n = [sum(kind == k for _, _, kind in base) for k in KINDS]
                digest = hashlib.sha256(_joined(base).encode()).hexdigest()
                out.append((*n, digest, _joined(spans), masked(text, spans, instead)))
            columns = [batch.column(k) for k, c in enumerate(batch.schema.names) if k != terms_at]
            arrays = [pa.array(c, f.type) for c, f in zip(zip(*out), extra)] if out else [pa.array([], f.type) for f in extra]
            names = [c for k, c in enumerate(batch.schema.names) if k != terms_at]
            yield pa.RecordBatch.from_arrays(columns + arrays, names + added)

    schema = docs.select(*kept).schema.simpleString()[7:-1]
    return rows.mapInArrow(mark, f"{schema},{kinds}" if kept else kinds)


def found_data(docs: DataFrame, **options) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans)`` per document."""
    rows = sanitise(docs.select("doc_id", "text"), **options)
    return rows.drop("text", "sanitised")


def without_data(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with sanitised texts (null stays null) and, if it is there, ``n_chars`` of those; columns as they were."""
    aside = {c: f"__own_{c}" for c in docs.columns if c in ADDED}
    found = sanitise(docs.withColumnsRenamed(aside), **options)
    clean = F.when(F.col("text").isNotNull(), F.col("sanitised"))
    new = {"text": clean, "n_chars": F.char_length(F.coalesce("sanitised", F.lit(""))).cast("bigint")}
    return found.select(*(new[c].alias(c) if c in new else F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns))

"""Language identification by fusing the text's likelihood with what its address and markup say.

For a language l:  log P(l | all) = log P(text | l) + log P(declared | l) + log P(suffix | l) + log P(l | host) + const.

Text likelihoods come from hashed byte n-grams.  The three tables are counts of the languages that the texts
alone show, by grouped aggregation over the whole corpus: of the declared language, of the address suffix, and
of the host, whose share is smoothed by that of its domain, and that by the share of the corpus.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmentry.llm.common import sized, text_or_empty, written
from segmentry.llm.tokens import release

#: n-gram buckets: the model has this many numbers per language, whatever the corpus.
BUCKETS = 1 << 16
UNKNOWN = "und"
#: Neighbouring n-grams overlap; the text's log likelihood is divided by this.
OVERLAP = 3.0
#: A language is learnt if at least this share of the texts with a language are in it.
LEAST_SHARE = 1 / 256
#: Texts that a host or domain is worth beyond its own count.
HOST_WEIGHT, DOMAIN_WEIGHT = 20.0, 50.0
#: Weight of the even share in the declared and suffix tables.
EVEN = 2.0
#: n-grams at which a text alone is counted in the tables.
LEAST_NGRAMS = 20
#: Columns that ``identify`` adds, or needs on the way.
ADDED = ["language", "confidence", "text_language", "keep", "ngrams", "likelihood", "shown", "fused", "__host", "__of"]
ADDED += ["of_domain", "of_host", "of_declared", "of_suffix"]
#: Probability of an n-gram in text of no known language.
_STRANGE = -np.log(BUCKETS) + 0.7


def ngrams(text: str) -> np.ndarray:
    """Buckets of the byte 2-grams and 3-grams within words; digits, blanks and signs separate words."""
    raw = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    letter = ((raw >= 97) & (raw <= 122)) | (raw >= 128)
    raw = np.where(letter, raw, 32).astype(np.uint32)
    two = letter[1:] | letter[:-1]
    pairs = (raw[:-1] * 257 + raw[1:])[two]
    three = letter[1:-1]
    triples = (raw[:-2] * 66049 + raw[1:-1] * 257 + raw[2:])[three]
    both = np.concatenate([pairs * np.uint32(2654435761) + np.uint32(17), triples * np.uint32(2246822519)])
    return (both >> np.uint32(16)).astype(np.int64)


@dataclass
class TextModel:
    languages: list[str]
    weights: np.ndarray  # buckets x (languages and unknown): log probability

    def likelihoods(self, text: str) -> tuple[int, np.ndarray]:
        """Number of n-grams, and log likelihood by language, the unknown one last."""
        total, n, step = np.zeros(self.weights.shape[1]), 0, 1 << 20
        for k in range(0, len(text), step):
            grams = ngrams(" " + text[k : k + step] + " ")
            counts = np.bincount(grams, minlength=BUCKETS) if len(grams) > BUCKETS // 4 else None
            total += counts @ self.weights if counts is not None else self.weights[grams].sum(axis=0)
            n += len(grams)
        return n, total / OVERLAP


def fit_text_model(docs: DataFrame, least_share: float = LEAST_SHARE) -> TextModel:
    """From all of ``docs(text, lang)`` whose language is that of at least ``least_share`` of them; other columns are ignored.

    So there are at most ``1 / least_share`` languages, however many values ``lang`` has; the rest is ``und`` to the model.
    Each task adds up its counts; the driver gets one number per language and bucket.  Null texts and
    languages are left out, and an empty table gives a model without languages.
    """
    schema = pa.schema([("lang", pa.string()), ("bucket", pa.int64()), ("n", pa.int64())])

    def count(batches):
        release()
        tables: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if lang not in tables:
                    tables[lang] = np.zeros(BUCKETS, np.int64)
                for k in range(0, len(text), 1 << 20):
                    tables[lang] += np.bincount(ngrams(" " + text[k : k + (1 << 20)] + " "), minlength=BUCKETS)
        for lang, table in tables.items():
            used = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used), pa.array(table[used])], schema=schema)

    rows = docs.where("lang is not null and text is not null").select("lang", "text")
    each = written(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "texts-of-languages")
    enough = (each.agg(F.sum("n")).first()[0] or 0) * least_share
    rows = rows.join(F.broadcast(each.where(F.col("n") >= enough).select("lang")), "lang", "left_semi")
    rows = rows.mapInArrow(count, "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    rows = written(rows, "ngram-counts", texts=True)
    counts: dict[str, np.ndarray] = {}
    for lang, bucket, n in rows.toLocalIterator():
        counts.setdefault(lang, np.zeros(BUCKETS))[bucket] = n
    languages = sorted(counts)
    columns = [np.log((counts[x] + 0.1) / (counts[x].sum() + 0.1 * BUCKETS)) for x in languages]
    return TextModel(languages, np.stack([*columns, np.full(BUCKETS, _STRANGE)], axis=1))


def _scored(items: DataFrame, model: TextModel) -> DataFrame:
    """``items`` with ``ngrams`` and ``likelihood`` instead of ``text``."""
    at = items.columns.index("text")
    rest = [f for f in items.schema.fields if f.name != "text"]

    def judge(batches):
        release()
        for batch in batches:
            found = [model.likelihoods(t or "") for t in batch.column(at).to_pylist()]
            arrays = [batch.column(k) for k in range(batch.num_columns) if k != at]
            arrays += [pa.array([n for n, _ in found], pa.int64()), pa.array([v.tolist() for _, v in found], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(arrays, [f.name for f in rest] + ["ngrams", "likelihood"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest)
    return items.mapInArrow(judge, f"{kinds}, ngrams bigint, likelihood array<double>")


def _shares(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    """Counts ``n0..nk`` of the languages shown by the texts, by group; combined map-side."""
    each = [F.count_if(F.col("shown") == i).alias(f"n{i}") for i in range(k)]
    return rows.groupBy(*by).agg(*each)


def identify(items: DataFrame, model: TextModel) -> DataFrame:
    """``items`` without ``text``, with ``language, confidence, text_language, keep``.

    ``items`` has ``text, declared, suffix, domain, host``, any of which may be null: a null is no
    evidence.  ``text_language`` is what the text alone shows.  The language is ``und`` if the text is
    better explained by none, or has no letters; such an item is not kept.  Rows may repeat, an empty table gives no
    rows, and further columns pass through, but those of the names in ``ADDED`` are replaced or dropped.
    """
    items = items.drop(*ADDED)
    k = len(model.languages)
    if not k:  # nothing is known of any language
        unknown = [F.lit(UNKNOWN).alias("language"), F.lit(0.0).alias("confidence"), F.lit(UNKNOWN).alias("text_language")]
        return items.drop("text", "declared", "suffix", "domain", "host").select("*", *unknown, F.lit(False).alias("keep"))
    passed = [c for c in items.columns if c not in ("text", "declared", "suffix", "domain", "host")]
    # An unknown place is null throughout; declared languages count by their primary subtag.
    items = items.withColumn("declared", F.lower(F.regexp_extract("declared", r"^\s*([A-Za-z]+)", 1)))
    items = items.withColumn("declared", F.when(F.col("declared") != "", F.col("declared")))
    rows = written(_scored(items, model), "likelihoods", texts=True)
    like = [F.get("likelihood", F.lit(i)) for i in range(k + 1)]
    best = F.array_position("likelihood", F.array_max("likelihood")).cast("int") - 1
    rows = rows.withColumn("shown", best)
    sure = rows.where((F.col("ngrams") >= LEAST_NGRAMS) & (F.col("shown") < k))

    def spread(table: DataFrame, by: str, below: list[Column], weight: float, name: str) -> DataFrame:
        n = sum((F.col(f"n{i}") for i in range(k)), F.lit(0))
        return table.select(by, F.array(*((F.col(f"n{i}") + weight * below[i]) / (n + weight) for i in range(k))).alias(name))

    # Totals by language: one row.
    totals = _shares(sure, [], k).first()
    seen = sum(totals) or 1
    even = [F.lit((totals[i] + 1) / (seen + k)) for i in range(k)]
    by_domain = written(spread(_shares(sure.where("domain is not null"), ["domain"], k), "domain", even, DOMAIN_WEIGHT, "of_domain"), "domains")
    hosts = _shares(sure.where("host is not null"), ["host", "domain"], k).join(by_domain, "domain", "left")
    below = [F.coalesce(F.get("of_domain", F.lit(i)), even[i]) for i in range(k)]
    n = sum((F.col(f"n{i}") for i in range(k)), F.lit(0))
    host_share = F.array(*((F.col(f"n{i}") + HOST_WEIGHT * below[i]) / (n + HOST_WEIGHT) for i in range(k)))
    by_host = written(hosts.select("host", F.col("domain").alias("__of"), host_share.alias("of_host")), "hosts")

    def given_language(by: str, name: str) -> DataFrame:
        """P(value | language), evenly smoothed."""
        table = _shares(sure.where(F.col(by).isNotNull()), [by], k)
        rate = [(F.col(f"n{i}") + EVEN) / F.lit(float(totals[i] + EVEN * (k + 1))) for i in range(k)]
        return written(table.select(by, F.array(*rate).alias(name)), name)

    joined = rows.join(given_language("declared", "of_declared"), "declared", "left")
    joined = joined.join(given_language("suffix", "of_suffix"), "suffix", "left")
    joined = joined.join(by_domain, "domain", "left")
    same = (F.col("host") == F.col("__host")) & F.col("domain").eqNullSafe(F.col("__of"))
    joined = joined.join(by_host.withColumnRenamed("host", "__host"), same, "left")

    def evidence(i: int) -> Column:
        prior = F.coalesce(F.get("of_host", F.lit(i)), F.get("of_domain", F.lit(i)), even[i])
        told = [F.coalesce(F.log(F.get(c, F.lit(i))), F.lit(0.0)) for c in ("of_declared", "of_suffix")]
        return like[i] + F.log(prior) + told[0] + told[1]

    joined = joined.withColumn("fused", F.array(*(evidence(i) for i in range(k))))
    top = F.array_max("fused")
    sum_exp = F.aggregate("fused", F.lit(0.0), lambda s, v: s + F.exp(v - top))
    known = (F.col("ngrams") > 0) & (F.greatest(*like[:k], F.lit(-1e300)) >= like[k])
    names = F.array(*map(F.lit, model.languages), F.lit(UNKNOWN))
    language = F.get(names, (F.array_position("fused", top) - 1).cast("int"))
    return joined.select(
        *passed,
        F.when(known, language).otherwise(UNKNOWN).alias("language"),
        F.when(known, 1.0 / sum_exp).otherwise(0.0).alias("confidence"),
        F.when(F.col("ngrams") > 0, F.get(names, F.col("shown"))).otherwise(UNKNOWN).alias("text_language"),
        F.coalesce(known, F.lit(False)).alias("keep"),
    )


def of_documents(docs: DataFrame) -> DataFrame:
    """Items of ``documents``: the declared language is the ``lang`` they came with, the host their source."""
    none = F.lit(None).cast("string")
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "text",
        F.col("lang").alias("declared"),
        none.alias("suffix"),
        F.regexp_replace("source", r"\d+$", "").alias("domain"),
        F.col("source").alias("host"),
    )


def identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs(doc_id, text, lang, source)`` whose language is known.  Whether it is depends on the text alone."""
    items = of_documents(docs).withColumn("__key", F.xxhash64(text_or_empty()))
    gone = identify(items, fit_text_model(docs)).where(~F.col("keep")).select("__key").distinct()
    gone = sized(written(gone, "unknown-language"))
    return docs.join(gone, F.xxhash64(text_or_empty()) == F.col("__key"), "left_anti")


def of_pages(pages: DataFrame) -> DataFrame:
    """Items of ``pages(page_id, url, html)``: the ``lang`` of the markup, and the parts of the address."""
    host = F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    text = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&[a-z#0-9]+;", " ")
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        text.alias("text"),
        F.regexp_extract("html", r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]+)", 1).alias("declared"),
        F.when(host != "", host).alias("host"),
    )
    suffix = F.element_at(F.split("host", r"\."), -1)
    domain = F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1)
    return rows.withColumn("suffix", suffix).withColumn("domain", F.when(domain != "", domain).otherwise(F.col("host")))

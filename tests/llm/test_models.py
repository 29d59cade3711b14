"""WARC packages (3), quality (4), language (7), chats (9) and the pipeline."""

import gzip
import hashlib
import io
import re
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from segmentry.llm import warc
from segmentry.llm.chat import PART, as_parts, digests, format_chats, read_chats
from segmentry.llm.language import DOMAIN_WEIGHT, EVEN, HOST_WEIGHT, LEAST_NGRAMS, TextModel, fit_text_model, identified, identify, ngrams
from segmentry.llm.language import of_documents, of_pages
from segmentry.llm.quality import STATISTICS, classify, described, fit, held_out, statistics

SF_DIR = "/root/testdata/sf0.001"


def table(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


# ---- WARC -----------------------------------------------------------------------------------------

BIG = "<p>ü</p>" * 400
PAGES = [
    (1, "http://a.org/", BIG), (2, "http://a.org/2", BIG), (9, None, BIG), (9, "http://a.org/9", BIG), (3, "x\r\nEvil: 1", "small"), (4, "u", "small"),
    (5, "u", None), (6, "u", ""), (None, "u", BIG), (7, "u", "y" * 3_000_000),
]


@pytest.mark.parametrize("zip64", [False, True])
def test_packages(spark, tmp_path, zip64):
    pages = spark.createDataFrame([(*p, 0) for p in PAGES], "page_id bigint, url string, html string, digest int").repartition(2)
    folder = warc.write_archives(pages, str(tmp_path / "zip"), member_bytes=2000, zip64=zip64)
    rows = warc.read_archives(spark, folder, keep_payload=True).collect()
    assert len(rows) == len(PAGES)
    payloads = {p[0]: (p[2] or "").encode() for p in PAGES}
    for r in rows:
        payload = payloads[r["page_id"]]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(payload), hashlib.sha1(payload).hexdigest())
        revisit = r["page_id"] in (1, 2, None)
        assert (r["record_type"], r["refers_to"]) == (("revisit", 9) if revisit else ("response", None))
        assert r["payload"] == (None if revisit else payload)
    assert next(r["url"] for r in rows if r["page_id"] == 3) == "x%0D%0AEvil:%201"
    for file in (tmp_path / "zip").glob("part-*"):  # other readers see an ordinary package
        if file.stat().st_size:
            package = zipfile.ZipFile(io.BytesIO(file.read_bytes()))
            assert package.testzip() is None and warc.INDEX in package.namelist()
            whole = gzip.decompress(package.read("archive/data-0000.warc.gz"))
            assert whole.startswith(b"WARC/1.1\r\n")
    assert warc.archived(pages.limit(0)).count() == 0


def test_directories_written_by_others(tmp_path):
    path = tmp_path / "other.zip"
    with zipfile.ZipFile(path, "w") as package:
        package.writestr("a", b"stored")
        package.writestr("b", b"packed" * 100, zipfile.ZIP_DEFLATED)
        package.comment = b"PK\5\6 in a comment"
    with open(path, "rb") as file:
        members = warc.read_directory(file)
        assert set(members) == {"a", "b"}
        assert warc._range(file, warc.data_start(file, members["a"]), 6) == b"stored"
        with pytest.raises(ValueError):
            warc.data_start(file, members["b"])
    with pytest.raises(ValueError):
        warc.read_directory(io.BytesIO(b"no package"))


def test_damage_is_noticed(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", BIG)], "page_id bigint, url string, html string").coalesce(1)
    file = next((tmp_path / "z").glob("part-*")) if warc.write_archives(pages, str(tmp_path / "z")) is None else None
    file = next(f for f in (tmp_path / "z").glob("part-*") if f.stat().st_size)
    raw = bytearray(file.read_bytes())
    raw[raw.index(b"\x1f\x8b") + 40] ^= 255
    file.write_bytes(raw)
    (tmp_path / "z" / f".{file.name}.crc").unlink(missing_ok=True)
    with pytest.raises(Exception):
        warc.read_archives(spark, str(tmp_path / "z")).collect()


# ---- quality --------------------------------------------------------------------------------------


def test_quality_learns_and_is_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 40 and np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)


def test_labels_of_held_out_rows_change_nothing(spark):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    other = labels.withColumn("quality", F.when(held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({r["doc_id"]: r["score"] for r in classify(docs, x).collect()} for x in (labels, other))
    assert a == pytest.approx(b)


def test_quality_of_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "word", "x"), (3, "word", "x"), (None, "!!! ***", "x"), (5, "long text " * 50_000, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score string")
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, None), (7, 5), (99, 1)], "doc_id bigint, quality int")
    for known in (labels, labels.limit(0)):
        got = classify(docs, known).collect()
        assert len(got) == 6 and all(0 <= r["score"] <= 1 for r in got)
    assert classify(docs.limit(0), labels).count() == 0


def test_covariances_match_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, len(STATISTICS))) * np.arange(1, len(STATISTICS) + 1)
    y = (rng.uniform(size=300) < 0.4).astype(int)
    df = spark.createDataFrame([(int(c), [float(v) for v in r]) for r, c in zip(x, y)], "quality int, x array<double>")
    model = fit(df, pooled=0.0, ridge=0.0)
    z = np.clip((x - x.mean(0)) / x.std(0), -4, 4)
    for c in (0, 1):
        np.testing.assert_allclose(model.means[c], z[y == c].mean(0), atol=1e-9)
        lower = np.linalg.inv(model.factors[c])
        np.testing.assert_allclose(lower @ lower.T, np.cov(z[y == c].T, bias=True), atol=1e-8)


def test_statistics_are_finite():
    for text in ("", "a", "\n\n", "x" * 100_000, "a b " * 20_000, "\ud800", "\0"):
        values = statistics(text)
        assert len(values) == len(STATISTICS) and np.isfinite(values).all()


def test_described_keeps_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, None)], "doc_id bigint, text string")
    assert described(df).count() == 3


# ---- language -------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model(spark):
    return fit_text_model(table(spark, "documents"))


def test_documents_and_pages(spark, model):
    docs = table(spark, "documents")
    got = identify(of_documents(docs), model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r["language"] == r["lang"] for r in got]) > 0.99 and np.mean([r["text_language"] == r["lang"] for r in got]) > 0.97
    assert np.mean([r["keep"] for r in got]) > 0.99
    pages = table(spark, "pages")
    truth = pages.select("page_id", F.regexp_extract("html", '<html lang="([a-z]+)"', 1).alias("lang"))
    got = identify(of_pages(pages), model).join(truth, "page_id").collect()
    assert np.mean([r["language"] == r["lang"] for r in got]) > 0.95


def brute_fusion(items, model):
    """Language and confidence of each row by dictionaries and numpy, and what the text alone shows."""
    k, names = len(model.languages), [*model.languages, "und"]
    rows = []
    for r in items:
        n, like = model.likelihoods(r["text"] or "")
        told = re.match(r"\s*([A-Za-z]+)", r["declared"] or "")
        rows.append((n, like, int(like.argmax()), told[1].lower() if told else None, r["suffix"], r["domain"], r["host"]))
    sure = [r for r in rows if r[0] >= LEAST_NGRAMS and r[2] < k]
    count = lambda test: np.bincount([r[2] for r in sure if test(r)], minlength=k).astype(float)
    totals = count(lambda r: True)
    even = (totals + 1) / (totals.sum() + k)
    out = []
    for n, like, shown, told, suffix, domain, host in rows:
        prior = even
        if domain is not None and any(r[5] == domain for r in sure):
            of_domain = count(lambda r, d=domain: r[5] == d)
            prior = (of_domain + DOMAIN_WEIGHT * even) / (of_domain.sum() + DOMAIN_WEIGHT)
        if host is not None and any((r[5], r[6]) == (domain, host) for r in sure):
            of_host = count(lambda r, d=domain, h=host: (r[5], r[6]) == (d, h))
            prior = (of_host + HOST_WEIGHT * prior) / (of_host.sum() + HOST_WEIGHT)
        fused = like[:k] + np.log(prior)
        for at, value in ((3, told), (4, suffix)):
            if value is not None and any(r[at] == value for r in sure):
                fused = fused + np.log((count(lambda r, a=at, v=value: r[a] == v) + EVEN) / (totals + EVEN * (k + 1)))
        kept = n > 0 and like[:k].max() >= like[k]
        best = int(fused.argmax())
        out.append((names[best] if kept else "und", 1 / np.exp(fused - fused[best]).sum() if kept else 0.0, names[shown] if n else "und", kept))
    return out


def test_fusion_equals_brute_force_and_hidden_languages_are_found(spark, model):
    """All pages; those with an id divisible by 4 do not show their declared language, and are judged by the rest."""
    items = of_pages(table(spark, "pages")).withColumn("truth", F.lower("declared"))
    hidden = F.col("page_id") % 4 == 0
    items = items.withColumn("declared", F.when(~hidden, F.col("declared"))).persist()
    rows = items.orderBy("page_id").collect()
    got = identify(items, model).orderBy("page_id").collect()
    for row, r, (language, confidence, shown, kept) in zip(rows, got, brute_fusion(rows, model), strict=True):
        assert (r["language"], r["text_language"], r["keep"]) == (language, shown, kept), row["url"]
        assert r["confidence"] == pytest.approx(confidence, abs=1e-6)
    judged = [(r["truth"], g["language"]) for r, g in zip(rows, got) if r["page_id"] % 4 == 0 and r["truth"]]
    assert len(judged) >= 5 and np.mean([a == b for a, b in judged]) >= 0.9


def test_rare_languages_are_not_learnt(spark):
    rows = [(i, "some English words of a text", "en") for i in range(300)] + [(400 + i, "mot", f"x{i}") for i in range(30)] + [(900, None, "fr")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string").withColumn("n", F.lit("clash"))
    assert fit_text_model(docs, 0.01).languages == ["en"]
    assert len(fit_text_model(docs, 0.0).languages) == 31
    assert fit_text_model(docs.limit(0)).languages == []


def test_evidence_decides_what_the_text_leaves_open(spark):
    """Two languages of equal likelihood: the host's other texts, and the declared language, tip the scale."""
    weights = np.full((1 << 16, 3), -5.0)
    weights[:, 2] = -9.0
    for text, k in (("aaaa bbbb " * 5, 0), ("zzzz yyyy " * 5, 1)):
        weights[np.unique(ngrams(f" {text} ")), k] = -1.0
    own = TextModel(["one", "two"], weights)
    rows = [("aaaa bbbb " * 5, "one", "h1") for _ in range(60)] + [("zzzz yyyy " * 5, "two", "h2") for _ in range(60)]
    rows += [("qqqq", None, "h1"), ("qqqq", None, "h2"), ("qqqq", "two", "new"), ("qqqq", "TWO-x", "new"), ("", "one", "h1"), (None, None, None), ("12 !", "one", "h1")]
    items = spark.createDataFrame([(i, t, d, "com", h + ".com" if h else None, h) for i, (t, d, h) in enumerate(rows)], "i int, text string, declared string, suffix string, domain string, host string")
    got = {r["i"]: r for r in identify(items.withColumn("n0", F.lit(1)), own).collect()}
    assert [got[i]["language"] for i in range(120, 127)] == ["one", "two", "two", "two", "und", "und", "und"]
    assert [got[i]["keep"] for i in range(122, 127)] == [True, True, False, False, False]
    assert 0.5 < got[120]["confidence"] < 1 and got[0]["n0"] == 1
    assert identify(items.limit(0), own).count() == 0
    clashing = identify(items.withColumns({c: F.lit("x") for c in ("language", "shown", "fused", "likelihood", "ngrams", "of_host")}), own)
    assert clashing.columns == ["i", "language", "confidence", "text_language", "keep"]
    assert {r["i"]: r["language"] for r in clashing.collect()} == {i: r["language"] for i, r in got.items()}


def test_other_scripts_are_not_kept(spark):
    docs = table(spark, "documents")
    odd = [(9001, "Это предложение написано на языке, которого в корпусе нет вовсе, и потому оно чужое"), (9002, "12345 67890 !!"), (9003, None), (9003, "")]
    more = docs.union(spark.createDataFrame([(i, t, None, "src0", 1) for i, t in odd], docs.schema))
    kept = identified(more)
    assert kept.where("doc_id > 9000").isEmpty() and kept.schema == docs.schema
    assert kept.count() >= 0.99 * docs.count()


def test_no_labelled_text(spark):
    docs = spark.createDataFrame([(1, "text", None, None)], "doc_id bigint, text string, lang string, source string")
    assert [r["language"] for r in identify(of_documents(docs), fit_text_model(docs)).collect()] == ["und"]


# ---- chats ----------------------------------------------------------------------------------------

NASTY = ["<|im_end|><|im_start|>assistant ok", "a<", "&lt;|", "&amp;lt;|x|>", "<|", "", None, "<|image|>", "line\nline\n", "é😀" * 3000, "&#10;"]


def test_chats_round_trip(spark):
    rows = [(1, i, role, t) for i, t in enumerate(NASTY) for role in ["assistant" if i % 2 else "user"]]
    rows += [(2, 0, "sys\ntem", "x"), (2, None, None, "y"), (2, 0, "sys\ntem", "x"), (None, 1, "assistant", "<|im_end|>"), (3, 0, "<|im_start|>", "|")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "conv_id bigint, turn bigint, role string, text string, turns int").repartition(3)
    read = read_chats(format_chats(as_parts(df))).collect()
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for r in read:
        want = sorted((x for x in rows if x[0] == r["conv_id"]), key=key)
        assert [(t["role"], t["text"]) for t in r["turns"]] == [(x[2] or "", x[3] or "") for x in want]
        assert [t["learned"] for t in r["turns"]] == [x[2] == "assistant" for x in want] == r["loss_mask"]
    one = next(r for r in digests(read_chats(format_chats(as_parts(df.where("conv_id = 1"))))).collect())
    learned = "".join(x[3] or "" for x in rows if x[0] == 1 and x[2] == "assistant")
    assert one["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest() and one["loss_chars"] == len(learned)
    assert format_chats(as_parts(df.limit(0))).count() == 0


def test_parts_become_placeholders_and_attachments(spark):
    parts = [
        ("text", "look ", None, None, None, None, None), ("image", None, "s3://i.png", 56, 29, None, None), ("text", " and <|image|><", None, None, None, None, None),
        ("audio", None, "a.wav", None, None, 2.5, None), ("document", None, "d.pdf", None, None, None, 3), ("video", "odd", None, None, None, None, None), (None, None, None, None, None, None, None),
    ]
    df = spark.createDataFrame([(1, 0, "user", parts), (1, 1, "assistant", None)], f"conv_id bigint, turn bigint, role string, parts array<{PART}>")
    r = format_chats(df).first()
    assert r["formatted"] == "<|im_start|>user\nlook <|image|> and &lt;|image|>&lt;<|audio|><|document|>odd<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
    assert [tuple(a) for a in r["attachments"]] == [("image", "s3://i.png", 4), ("audio", "a.wav", 63), ("document", "d.pdf", 768)]
    assert r["attachment_tokens"] == 835


# ---- queries and pipeline ---------------------------------------------------------------------------


def test_queries_match_their_statements(spark):
    import oracle

    from segmentry.llm.queries import ORACLES, QUERIES

    con = oracle.connect(SF_DIR)
    for name, sql in ORACLES.items():
        assert oracle.compare(QUERIES[name](spark, SF_DIR), con, sql)[0] is None, name


def test_pipeline(spark):
    import corpus_pipeline

    docs = table(spark, "documents")
    benchmark = [r["text"] for r in table(spark, "benchmark").collect()]
    seen = docs
    for name, stage in corpus_pipeline.STAGES:
        before, seen = seen, stage(spark, seen, SF_DIR).persist()
        if name != "packing":
            assert seen.dtypes == docs.dtypes
            assert seen.select("doc_id").exceptAll(before.select("doc_id")).isEmpty()
        if name == "near_duplicates":
            assert seen.select("text").distinct().count() == seen.count() < before.count()
        if name == "decontamination":
            assert not [r for r in seen.collect() if any(b in r["text"] for b in benchmark)]
        if name == "personal_data":
            assert seen.count() == before.count() and seen.where(F.col("text").rlike(r"[A-Za-z0-9]@[a-z]+\.[a-z]")).isEmpty()
            assert seen.where("n_chars <> char_length(text)").isEmpty()
    left = before.select("doc_id")
    assert seen.select("doc_id").distinct().count() == left.count()


@pytest.mark.parametrize("name", ["language", "near_duplicates", "decontamination", "personal_data"])
def test_stages_on_odd_tables(spark, name):
    import corpus_pipeline

    stage = dict(corpus_pipeline.STAGES)[name]
    docs = table(spark, "documents").limit(40)
    odd = [(1, None, None, None, None), (None, "", "en", "s", 0), (1, None, None, None, None), (7, "x " * 30_000, "en", "s", 60_000)]
    more = docs.union(spark.createDataFrame(odd, docs.schema))
    extra = more.withColumn("keep", F.lit(1)).withColumn("key", F.lit("k")).withColumn("spans", F.lit(2)).withColumn("run", F.lit(3))
    out = stage(spark, extra, SF_DIR)
    assert out.columns == extra.columns
    assert out.count() >= 30
    assert stage(spark, docs.limit(0), SF_DIR).count() == 0

"""How the words of a source differ from those of its language and of the language's other sources.

Terms are cut and counted per task, then grouped once by language and term.  A term's share depends on its count
alone, so whatever compares shares is worked out per cell of equal counts and not per term: the cells of a
source hold (count there, count in the language), those of two sources (count in one, count in the other).  Cells
of equal value are merged, ranked by how many terms are in those above, and only the terms of cells that
reach the wanted ranks are looked up again.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segmentry.llm.common import sized, written

#: Texts of a language that must hold a term for it to be kept.
LEAST_TEXTS = 3
TOP = 200
SCALE = 1_000_000_000
#: A byte of UTF-8 as part of a term: letters in lower case and what is not ASCII; a blank otherwise.
LETTERS = bytes(k + 32 if 65 <= k <= 90 else k if 97 <= k <= 122 or k >= 128 else 32 for k in range(256))
#: Bytes of a text that are cut at a time, and different terms that a task holds at most; only bound memory.
SEGMENT, HELD = 1 << 22, 400_000


def terms_of(text: str):
    """Lists of a text's terms, in parts."""
    raw = text.encode("utf-8", "surrogatepass").translate(LETTERS)
    at = 0
    while at < len(raw):
        end = raw.find(b" ", at + SEGMENT)
        end = len(raw) if end < 0 else end
        yield raw[at:end].split()
        at = end


def term_counts(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, n, texts)``: occurrences and texts, counted within each task; a null term for each group."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("texts", pa.int64())])

    def rows_of(held: dict):
        for (lang, source), (n, texts) in held.items():
            yield pa.RecordBatch.from_pydict({"lang": [lang], "source": [source], "term": [None], "n": [0], "texts": [0]}, schema)
            words = list(n)
            for k in range(0, len(words), 65_536):
                some = words[k : k + 65_536]
                columns = [[lang] * len(some), [source] * len(some), [w.decode("utf-8", "surrogatepass") for w in some]]
                columns += [[n[w] for w in some], [texts[w] for w in some]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def count(batches):
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            for lang, source, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                n, texts = held.setdefault((lang, source), (Counter(), Counter()))
                size -= len(n)
                if len(text) <= SEGMENT // 4:
                    own = Counter(w for part in terms_of(text) for w in part)
                else:
                    own = Counter()
                    for part in terms_of(text):
                        own.update(part)
                n.update(own)
                texts.update(own.keys())
                size += len(n)
                if size > HELD:
                    yield from rows_of(held)
                    held, size = {}, 0
        yield from rows_of(held)

    columns = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    return docs.select(*columns).mapInArrow(count, "lang string, source string, term string, n bigint, texts bigint")


def share(count: str, total: str, kept: str) -> F.Column:
    """``1 + floor(SCALE * (count + 1) / (total + kept))``, exact for any counts."""
    return F.expr(f"1 + (decimal({SCALE}) * cast({count} + 1 as decimal(20, 0))) div cast({total} + {kept} as decimal(20, 0))")


def gap(p: str, q: str) -> F.Column:
    """``floor((p - q) ** 2 / q)`` of shares, which are at most ``SCALE + 1``."""
    return F.expr(f"({p} - {q}) * ({p} - {q}) div {q}")


def kept_terms(docs: DataFrame, least_texts: int = LEAST_TEXTS) -> tuple[DataFrame, DataFrame]:
    """``(terms, groups)``: ``(lang, term, n_lang, of_source)``, with ``(source, n)`` where a term occurs, and totals.

    ``groups`` has ``(lang, source, total, kept, total_lang)`` for every group that occurs.
    """
    counts = term_counts(docs).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("texts").alias("texts"))
    counts = written(counts, "term-counts")
    # A term has one row per source of its language here.
    terms = counts.where("term is not null").groupBy("lang", "term").agg(
        F.sum("n").alias("n_lang"), F.sum("texts").alias("texts"), F.collect_list(F.struct("source", "n")).alias("of_source")
    )
    terms = written(terms.where(F.col("texts") >= least_texts).drop("texts"), "kept-terms")
    totals = terms.select("lang", F.explode("of_source").alias("s")).groupBy("lang", "s.source").agg(F.sum("s.n").alias("total"))
    of_lang = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("n_lang").alias("total_lang"))
    groups = counts.where("term is null").select("lang", "source").join(totals, ["lang", "source"], "left").join(of_lang, "lang", "left")
    return terms, written(groups.na.fill(0, ["total", "kept", "total_lang"]), "term-groups")


def top_terms(terms: DataFrame, groups: DataFrame, top: int = TOP) -> DataFrame:
    """``(lang, source, item, value, rank)``: the terms that a group has more of than its language, to rank ``top``."""
    group = ["lang", "source"]
    rows = terms.select("lang", "term", "n_lang", F.explode("of_source").alias("s")).select("lang", "s.source", "term", "s.n", "n_lang")
    cells = rows.groupBy(*group, "n", "n_lang").agg(F.count(F.lit(1)).alias("times")).join(sized(groups), group)
    cells = cells.withColumns({"p": share("n", "total", "kept"), "q": share("n_lang", "total_lang", "kept")}).where("p > q")
    cells = written(cells.withColumn("value", gap("p", "q")).select(*group, "n", "n_lang", "times", "value"), "term-cells")
    # Each value stands for a term at least, so that the first `top` values hold the first `top` terms.
    merged = cells.groupBy(*group, "value").agg(F.sum("times").alias("times"))
    down = Window.partitionBy(*group).orderBy(F.desc("value"))
    best = merged.withColumn("k", F.row_number().over(down)).where(F.col("k") <= top)
    above = F.coalesce(F.sum("times").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    best = written(best.withColumn("above", above).where(F.col("above") < top).select(*group, "value", "above"), "best-values")
    wanted = written(cells.join(best, [*group, "value"]).select(*group, "n", "n_lang", "value"), "best-cells")
    found = rows.join(sized(wanted), [*group, "n", "n_lang"])
    in_order = Window.partitionBy(*group).orderBy(F.desc("value"), "term")
    found = found.withColumn("rank", F.row_number().over(in_order)).where(F.col("rank") <= top)
    return found.select(*group, F.col("term").alias("item"), "value", "rank")


def source_pairs(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """``(lang, source, item, value, rank)`` for each other source ``item`` of a group's language.

    Terms that one or both sources lack are not listed anywhere: with f(a, b) for counts a and b, the sum over
    all terms is that of f(a, b) - f(a, 0) - f(0, b) + f(0, 0) over the terms of both, plus f(a, 0) - f(0, 0) over those
    of one, f(0, b) - f(0, 0) over those of the other, and f(0, 0) for every kept term.
    """
    ordered = terms.select("lang", F.array_sort("of_source").alias("s")).where("size(s) > 1")
    first = ordered.select("lang", "s", F.posexplode("s").alias("at", "a"))
    both = first.select("lang", "a", F.explode(F.expr("slice(s, at + 2, size(s))")).alias("b"))
    cells = both.groupBy("lang", F.col("a.source").alias("x"), F.col("b.source").alias("y"), F.col("a.n").alias("n_x"), F.col("b.n").alias("n_y"))
    cells = written(cells.agg(F.count(F.lit(1)).alias("times")), "pair-cells")
    turned = cells.select("lang", F.col("y").alias("x"), F.col("x").alias("y"), F.col("n_y").alias("n_x"), F.col("n_x").alias("n_y"), "times")
    one = terms.select("lang", F.explode("of_source").alias("s")).groupBy("lang", F.col("s.source").alias("source"), F.col("s.n").alias("n"))
    one = written(one.agg(F.count(F.lit(1)).alias("times")), "source-cells")

    named = [groups.select("lang", F.col("source").alias(k), F.col("total").alias(f"total_{k}"), "kept") for k in ("x", "y")]
    pairs = named[0].join(named[1].drop("kept"), "lang").where("x <> y")  # the rows asked for
    pairs = pairs.withColumns({"z_x": share("0", "total_x", "kept"), "z_y": share("0", "total_y", "kept")})
    pairs = written(pairs.withColumn("f_0", gap("z_x", "z_y")), "source-pairs")
    known = sized(pairs.select("lang", "x", "y", "total_x", "total_y", "kept", "z_x", "z_y", "f_0"))
    p, q = share("n_x", "total_x", "kept"), share("n_y", "total_y", "kept")
    shared = cells.union(turned).join(known, ["lang", "x", "y"]).withColumns({"p": p, "q": q})
    shared = shared.withColumn("f", gap("p", "q") - gap("p", "z_y") - gap("z_x", "q") + F.col("f_0"))
    of_x = one.withColumnsRenamed({"source": "x", "n": "n_x"}).join(known, ["lang", "x"]).withColumn("p", p)
    of_x = of_x.withColumn("f", gap("p", "z_y") - F.col("f_0"))
    of_y = one.withColumnsRenamed({"source": "y", "n": "n_y"}).join(known, ["lang", "y"]).withColumn("q", q)
    of_y = of_y.withColumn("f", gap("z_x", "q") - F.col("f_0"))
    # Sums in decimals: parts may pass 64 bits where the whole does not.
    parts = [d.select("lang", "x", "y", (F.col("f").cast("decimal(20,0)") * F.col("times")).alias("f")) for d in (shared, of_x, of_y)]
    every = pairs.select("lang", "x", "y", (F.col("f_0").cast("decimal(20,0)") * F.col("kept")).alias("f"))
    summed = parts[0].union(parts[1]).union(parts[2]).union(every).groupBy("lang", "x", "y").agg(F.sum("f").cast("bigint").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "x").orderBy(F.desc("value"), "y"))
    return summed.select("lang", F.col("x").alias("source"), F.col("y").alias("item"), "value", rank.alias("rank"))


def source_divergence(docs: DataFrame, least_texts: int = LEAST_TEXTS, top: int = TOP) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` of all groups of ``docs(text, lang, source)``.

    Terms are runs of ASCII letters and of characters beyond ASCII, with A-Z in lower case; a language keeps those in
    ``least_texts`` of its texts.  A term's share in a group is 1 + floor(10^9 (count + 1) / (N + V)) with N occurrences
    of the V kept terms there.  Part ``pair`` has for every group the other sources of its language, with the
    sum of floor((p - q)^2 / q) over the kept terms; part ``term`` its own terms with a larger share than in the
    language, to rank ``top``.  Ranks go from 1, by value from the top and item in UTF-8 order.

    Nulls in ``lang``, ``source`` or ``text`` are empty strings; texts without terms still make up groups, whose pairs
    have the value 0 where the language keeps no term.  Repeated rows count each.  An empty table gives
    no rows.  Other columns are ignored.
    """
    terms, groups = kept_terms(docs, least_texts)
    parts = [("pair", source_pairs(terms, groups)), ("term", top_terms(terms, groups, top))]
    found = [d.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank") for part, d in parts]
    return found[0].union(found[1])

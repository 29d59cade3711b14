"""Document fingerprints by spot signatures, with DataFrame functions only.

Common words are anchors.  The chain of the next content words after an anchor, or after the beginning of
the text, is a signature, and so is every chain between anchors that are further apart, so that no part of a text is
left out, whatever its language; the sorted set of their hashes is the fingerprint.  Sets are partitioned by length,
as sets whose lengths differ too much can't be alike, and compared by Jaccard similarity.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segmentry.functions.graph import connected_components
from segmentry.llm.common import text_or_empty, written

#: Content words of a chain.
CHAIN = 3
#: Anchors: frequent function words of the languages at hand.
ANCHORS = (
    "the of and to in is that it was for on are as with at be this from have or by one an not but "
    "der die das und den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach "
    "le la les et un une du que qui dans pour est au sur pas plus par avec ce se il sont "
    "el los y en se las por su para con una lo como del al más pero sus"
).split()
#: Consecutive values of doc_id that make a run.
RUN = 1024


def _any_of(words: list[str]) -> str:
    """A regular expression for the words that branches letter by letter, so that a miss is quick."""
    tree: dict = {}
    for word in words:
        node = tree
        for c in word:
            node = node.setdefault(c, {})
        node[""] = {}

    def written_out(node: dict) -> str:
        inner = [c + written_out(n) for c, n in sorted(node.items()) if c]
        if not inner:
            return ""
        body = inner[0] if len(inner) == 1 and len(node) == 1 else f"(?:{'|'.join(inner)})"
        return body + ("?" if "" in node else "")

    return written_out(tree)


def chains(text: Column, anchors: list[str] = ANCHORS, length: int = CHAIN) -> Column:
    """The chains of a text as strings, ``_`` before words that follow an anchor.

    One begins at each anchor, and one at every further word that ``length - 1`` others follow before the next anchor.
    """
    plain = F.concat(F.lit(" "), F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    spots = F.regexp_replace(plain, f"(?<= ){_any_of(sorted(set(anchors)))} ", "_")
    spots = F.concat(F.lit("_"), F.trim(spots))
    after_anchors = F.regexp_extract_all(spots, F.lit(f"_++(?=([^ _]++(?: [^ ]+){{0,{length - 1}}}))"), F.lit(1))
    between = F.regexp_extract_all(spots, F.lit(f"(?<= )(?=([^ _]++(?: [^ _]++){{{length - 1}}}))"), F.lit(1))
    return F.concat(after_anchors, between)


def with_signatures(df: DataFrame, text: str, out: str, anchors: list[str] = ANCHORS, length: int = CHAIN) -> DataFrame:
    """Add ``out``, the sorted distinct 64-bit hashes of the chains of ``text`` (not null).

    A text with no chain (signs or anchors only) is one signature; an empty one has none.
    """
    df = df.withColumn("__chains", chains(F.col(text), anchors, length))  # a column of its own is evaluated once
    found = F.sort_array(F.array_distinct(F.transform("__chains", lambda c: F.xxhash64(F.translate(c, "_", "")))))
    bare = F.when(F.col(text) == "", F.array().cast("array<bigint>")).otherwise(F.array(F.xxhash64(text)))
    return df.withColumn(out, F.when(F.size("__chains") > 0, found).otherwise(bare)).drop("__chains")


def fingerprint(sigs: Column) -> Column:
    """The set as a string: the first eight hex digits of each signature."""
    return F.array_join(F.transform(sigs, lambda s: F.lpad(F.lower(F.hex(F.shiftrightunsigned(s, 32))), 8, "0")), "")


def length_class(sigs: Column, threshold: float) -> Column:
    """Partition of the set's length: sets at least ``threshold`` alike are in the same or neighbouring ones."""
    return F.floor(F.log(F.greatest(F.size(sigs), F.lit(1)).cast("double")) / F.lit(-math.log(threshold)) + 1e-9)


def with_likeness(df: DataFrame, a: str, b: str, out: str, least: float = 0.0) -> DataFrame:
    """Add the Jaccard similarity of two sorted sets: 0 without comparing them if their lengths
    rule out ``least`` or their ranges don't meet.  Two empty sets are alike."""
    low, high = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    apart = (low == 0) | (low < F.lit(least) * high) | (F.array_max(a) < F.array_min(b)) | (F.array_max(b) < F.array_min(a))
    df = df.withColumn("__both", F.when(apart, 0).otherwise(F.size(F.array_intersect(a, b))))
    return df.withColumn(out, F.when(high == 0, 1.0).otherwise(F.col("__both") / (F.size(a) + F.size(b) - F.col("__both")))).drop("__both")


def near_duplicates(rows: DataFrame, threshold: float = 0.8, text: str = "text") -> DataFrame:
    """``(id, class_id)`` for ``rows(id, text)``: ``class_id`` is the smallest id that likenesses of at least ``threshold`` reach.

    Equal sets are one.  A set is indexed, per length partition, by the smallest hashes that two alike sets must share one of;
    sets meet in the index with its first set, then with whatever there isn't connected yet.  Empty texts are
    in no class but their own, as are null ones.
    """
    sets = with_signatures(rows.select("id", F.coalesce(F.col(text), F.lit("")).alias("text")), "text", "sigs").drop("text")
    sets = written(sets.withColumn("same", F.xxhash64("sigs")), "spot-sets")
    full = sets.where(F.size("sigs") > 0)
    nodes = written(full.groupBy("same").agg(F.min("id").alias("first"), F.any_value("sigs").alias("sigs")), "spot-nodes")
    kept = F.size("sigs") - F.ceil(F.lit(threshold) * F.size("sigs")).cast("int") + 1
    part = length_class(F.col("sigs"), threshold)
    tiles = nodes.select("same", F.explode(F.array(part, part + 1)).alias("part"), F.slice("sigs", F.lit(1), kept).alias("head"))
    tiles = written(tiles.select("same", "part", F.explode("head").alias("sig")), "spot-index")

    def alike(pairs: DataFrame) -> DataFrame:
        a = nodes.select(F.col("same").alias("a"), F.col("sigs").alias("x"))
        b = nodes.select(F.col("same").alias("b"), F.col("sigs").alias("y"))
        joined = with_likeness(pairs.join(a, "a").join(b, "b"), "x", "y", "alike", threshold).where(F.col("alike") >= threshold)
        return written(joined.select("a", "b"), "spot-links")

    lead = tiles.groupBy("part", "sig").agg(F.min("same").alias("a"), F.max("same").alias("z")).where("a < z").drop("z")
    first = written(tiles.join(lead, ["part", "sig"]).where("same <> a").select("a", F.col("same").alias("b")).distinct(), "spot-pairs")
    links = alike(first)
    groups = connected_components(links)
    named = tiles.join(groups, tiles["same"] == groups["node"], "left").select("part", "sig", "same", F.coalesce("component", "same").alias("c"))
    mixed = named.groupBy("part", "sig").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("part", "sig")
    named = written(named.join(mixed, ["part", "sig"]), "spot-mixed")
    x, y = (named.select("part", "sig", F.col("same").alias(s), F.col("c").alias(f"of_{s}")) for s in "ab")
    rest = x.join(y, ["part", "sig"]).where("of_a < of_b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    groups = written(connected_components(links.union(alike(rest.join(first, ["a", "b"], "left_anti")))), "spot-groups")
    placed = nodes.join(groups, nodes["same"] == groups["node"], "left").select("same", "first", F.coalesce("component", "same").alias("c"))
    lowest = placed.groupBy("c").agg(F.min("first").alias("class_id"))
    found = full.select("id", "same").join(placed.join(lowest, "c").select("same", "class_id"), "same").select("id", "class_id")
    return found.union(sets.where(F.size("sigs") == 0).select("id", F.col("id").alias("class_id")))


def with_next(docs: DataFrame) -> DataFrame:
    """``(doc_id, text, next_text, run, copy)``: each document with the next in descending ``doc_id``; after the last, the first.

    Documents are dealt by runs of ``RUN`` ids, so texts are shuffled once and no task holds more than a run.  The first
    document of a run is copied to the preceding run (``copy``), where it follows the last.  Rows that share a
    ``doc_id`` are in order of text.  Null ids come last, dealt by text.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    unnamed = F.lit(-(1 << 60)) - F.pmod(F.xxhash64("text"), F.lit(1024))
    run = F.coalesce(F.floor(F.col("doc_id") / RUN), unnamed).cast("bigint")
    docs = docs.withColumn("run", run)
    order = Window.orderBy(F.desc("run"))  # one row per run
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    runs = docs.groupBy("run").agg(F.max("doc_id").alias("first"))
    before = F.coalesce(F.lag("run").over(order), F.last("run").over(whole))
    runs = written(runs.select("run", "first", before.alias("before")), "runs")
    again = F.when(F.col("doc_id").eqNullSafe(F.col("first")), F.struct(F.col("before").alias("run"), F.lit(True).alias("copy")))
    places = F.array_compact(F.array(F.struct(F.col("run"), F.lit(False).alias("copy")), again))
    dealt = docs.join(runs, "run").select("doc_id", "text", F.inline(places))
    return dealt.withColumn("next_text", F.lead("text").over(_following()))


def _following() -> Window:
    return Window.partitionBy("run").orderBy("copy", F.desc_nulls_last("doc_id"), "text")


def edited_likeness(docs: DataFrame) -> DataFrame:
    """Fingerprints of each whole text and of its edited text, and how alike they are.

    The edited text has its last ``n_chars // 2`` code points replaced by the first as many (or all) of the
    next document's.  Null texts are empty; every row of ``docs(doc_id, text)`` gives a row, other
    columns are ignored.  ``length_class`` is the set's partition for a likeness of 0.8.
    """
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    rows = with_next(docs).withColumn("n_chars", n.cast("bigint"))
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half))
    rows = rows.withColumn("edited", edited).drop("next_text")
    rows = with_signatures(with_signatures(rows, "text", "sigs"), "edited", "edited_sigs")
    rows = rows.withColumn("next_sigs", F.lead("sigs").over(_following())).where(~F.col("copy"))
    rows = with_likeness(with_likeness(rows, "sigs", "edited_sigs", "near_edited"), "sigs", "next_sigs", "near_next")
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("sigs")).alias("fingerprint"),
        fingerprint(F.col("edited_sigs")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        length_class(F.col("sigs"), 0.8).cast("bigint").alias("length_class"),
    )

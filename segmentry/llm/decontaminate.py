"""Benchmark decontamination by template canonicalisation, with DataFrame functions only.

Numbers, names and units become typed placeholders.  Windows of the template are hashed and joined with
those of the benchmark items; where enough windows meet, the values in the placeholders must map consistently within
an occurrence, so that a question asked anew with other numbers is found and mere sentence patterns are not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segmentry.llm.common import sized, text_or_empty, written

#: Tokens of a window, and least number of them in an item's window that are no placeholder.
WINDOW, LITERAL = 8, 4
#: Windows that make a match (13 tokens in a row), or this share of the item's windows if that is less.
MATCHED, COVERED = 6, 0.5
#: Share of placeholder values that must map consistently.
CONSISTENT = 0.8
#: Items' windows are broadcast up to this number (under 32 MB), joined by shuffle beyond.
BROADCAST_WINDOWS = 1_000_000
NUMBER, NAME, UNIT = "\x01", "\x02", "\x03"
UNITS = (
    "mm cm m km in ft yd mi mile miles inch inches foot feet metre metres meter meters g kg mg lb lbs oz ton tons gram grams "
    "l ml litre litres liter liters s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks month "
    "months year years km² m² usd eur gbp dollar dollars euro euros pound pounds cent cents percent degree degrees mph kmh kph "
    "hz khz mhz ghz w kw mw kwh v kv a b kb mb gb tb"
).split()


def marked(text: Column) -> Column:
    """Lower case, a number as one run of digits, and ``NAME`` before a capitalised word within a sentence."""
    numbers = F.regexp_replace(F.regexp_replace(text, r"(?<=\d)[.,:](?=\d)", ""), r"(?<=\d)(?=\p{L})|(?<=\p{L})(?=\d)", " ")
    text = F.when(text.rlike(r"\d"), numbers).otherwise(text)
    return F.lower(F.regexp_replace(text, r"([\p{Ll}\p{N},;] )(\p{Lu}\p{Ll})", f"$1{NAME}$2"))


def with_template(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the ``marked`` column ``text`` as a template: placeholders, token for token.

    Every step is a column, as a step that the next one reads more than once is worked out each time inside of it.
    """
    units = "|".join(sorted(UNITS + ["%", "€", "£", "°"], key=len, reverse=True))
    edge = r"(?=[^\p{L}\p{N}]|\z)"
    numbers = F.regexp_replace(text, rf"(\d)([ ]?)(?:{units}){edge}", f"$1 {UNIT}")
    numbers = F.regexp_replace(numbers, r"\d+", NUMBER)
    df = df.withColumn(out, F.when(F.col(text).rlike(r"\d"), numbers).otherwise(F.col(text)))
    names = F.regexp_replace(out, rf"{NAME}[\p{{L}}\p{{N}}]+", NAME)
    return df.withColumn(out, F.when(F.contains(F.col(out), F.lit(NAME)), names).otherwise(F.col(out)))


def tokens(text: Column) -> Column:
    """Words, numbers and placeholders.  A currency or per cent sign counts if it follows a number."""
    parts = F.split(F.trim(F.regexp_replace(text, rf"[^\p{{L}}\p{{N}}{NUMBER}{NAME}{UNIT}]+", " ")), " ")
    return F.filter(parts, lambda t: t != "")


def _spaced_signs(text: Column) -> Column:
    """Signs after a number as words, so that raw and templated tokens align."""
    return F.when(text.rlike(r"\d"), F.regexp_replace(text, r"(\d)[ ]?([%€£°])", "$1 unit")).otherwise(text)


def _windows(words: str, size: int, *kind: Column) -> Column:
    """Hash of the ``size`` tokens from every position; one window if there are fewer tokens, none without any."""
    last = F.greatest(F.size(words) - size, F.lit(0))
    whole = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*kind, *(F.get(F.col(words), i + k) for k in range(size))))
    return F.when(F.size(words) > 0, whole).otherwise(F.array().cast("array<bigint>"))


def _placed(hash_: Column, pos: Column) -> Column:
    return F.struct(pos.alias("pos"), hash_.alias("hash"))


def _unmarked(raw: Column) -> Column:
    """Tokens alike within a sentence and at its beginning."""
    return F.transform(raw, lambda t: F.translate(t, NAME, ""))


def _other_windows(words: str, width: int) -> Column:
    """Windows of another kind than the templates of the common size: their hashes meet their like only."""
    return _windows(words, width, F.lit(f"{words} {width}"))


def item_windows(benchmark: DataFrame, size: int = WINDOW, literal: int = LITERAL) -> tuple[DataFrame, DataFrame, list[tuple[str, int]]]:
    """``(hash, item_id, at)`` of the items' windows, ``(item_id, at, kind, value)`` of their placeholders, and other windows to make.

    An item shorter than a window is a window of its length.  Items of which one template window or none has enough words
    are also looked for as they are written (``plain``).  The list has the column and length of these windows.
    """
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), _spaced_signs(text_or_empty()).alias("text")).distinct()
    items = items.select("item_id", marked(F.col("text")).alias("marked"))
    items = with_template(items, "marked", "template")
    items = items.select("item_id", tokens(F.col("marked")).alias("raw"), tokens(F.col("template")).alias("words"))
    kinds = [NUMBER, NAME, UNIT]
    last = F.greatest(F.size("words") - size, F.lit(0))
    literals = lambda i: F.size(F.filter(F.slice("words", i + 1, size), lambda t: ~t.isin(*kinds)))
    rich = F.when(F.size("words") > 0, F.filter(F.sequence(F.lit(0), last), lambda i: literals(i) >= literal))
    items = items.select("item_id", "raw", "words", _unmarked(F.col("raw")).alias("plain"), F.coalesce(rich, F.array().cast("array<int>")).alias("rich"))
    items = written(items.where(F.size("words") > 0), "benchmark-templates")

    width = F.least(F.size("words"), F.lit(size))
    other = items.select("rich", F.size("words").alias("n"), width.alias("width"))
    short = other.where((F.col("n") < size) & (F.size("rich") > 0)).select(F.lit("words"), "width")
    plain = other.where(F.size("rich") < 2).select(F.lit("plain"), "width")
    others = sorted(map(tuple, short.union(plain).distinct().collect()))  # two kinds, lengths up to that of a window

    found = items.where(F.size("words") >= size).select("item_id", "rich", F.posexplode(_windows("words", size)).alias("at", "hash"))
    found = found.where(F.array_contains("rich", F.col("at"))).select("hash", "item_id", "at")
    for kind, k in others:
        chosen = (F.size("rich") > 0) & (F.size("words") < size) if kind == "words" else F.size("rich") < 2
        more = items.where(chosen & (width == k)).select("item_id", F.posexplode(_other_windows(kind, k)).alias("at", "hash"))
        found = found.union(more.select("hash", "item_id", "at"))
    windows = written(found.distinct(), "benchmark-windows")
    slots = items.select("item_id", "plain", F.posexplode("words").alias("at", "kind")).where(F.col("kind").isin(*kinds))
    return windows, written(slots.select("item_id", "at", "kind", F.get("plain", F.col("at")).alias("value")), "benchmark-slots"), others


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = WINDOW,
    literal: int = LITERAL,
    matched: int = MATCHED,
    covered: float = COVERED,
    consistent: float = CONSISTENT,
) -> DataFrame:
    """``(doc_id, text_key, item_id, windows, item_windows, slots, consistent)`` for each row of ``docs`` that holds an item.

    ``docs`` has ``doc_id, text``, ``benchmark`` has ``item_id, text``.  A row is contaminated by an item if enough of the
    item's windows are in one occurrence and its placeholder values agree, so other copies in the text change nothing.  Null and empty
    texts hold nothing and are held by nothing, rows may repeat (each is reported), and a null ``doc_id`` is reported as
    such.  Items with less than ``literal`` words besides placeholders in every window are looked for as they are written.  Other columns are ignored; an empty table on either side gives no rows.
    """
    windows, slots, others = item_windows(benchmark, size, literal)
    of_item = windows.groupBy("item_id").agg(F.count_distinct("at").alias("item_windows"))
    if windows.count() <= BROADCAST_WINDOWS:
        windows = F.broadcast(windows)

    texts = docs.select(F.xxhash64(text_or_empty()).alias("key"), _spaced_signs(text_or_empty()).alias("text"))
    words = texts.select("key", marked(F.col("text")).alias("marked"))
    words = with_template(words, "marked", "template").withColumn("words", tokens(F.col("template")))
    each = [F.transform(_windows("words", size), _placed)]
    if others:
        words = words.withColumn("plain", _unmarked(tokens(F.col("marked"))))
        each += [F.transform(_other_windows(*o), _placed) for o in others]
    found = words.select("key", F.inline(F.flatten(F.array(*each))))
    found = written(found.join(windows, "hash").select("key", "pos", "item_id", "at").distinct(), "window-matches")

    # Enough windows of the item?
    counts = found.groupBy("key", "item_id").agg(F.count_distinct("at").alias("windows")).join(of_item, "item_id")
    enough = F.least(F.lit(matched), F.ceil(F.lit(covered) * F.col("item_windows")))
    counts = written(counts.where(F.col("windows") >= enough), "covered-items")

    # Occurrences: the windows of one alignment; those that follow each other in text and item, which words put in or left
    # out may shift; and all.  An item that repeats itself meets its repeats, so its best alignment counts at each place.
    item = ["key", "item_id"]
    lined = found.join(counts.select(*item), item).withColumn("shift", F.col("pos") - F.col("at"))
    lined = lined.withColumn("alike", F.count(F.lit(1)).over(Window.partitionBy(*item, "shift")))
    rank = F.row_number().over(Window.partitionBy(*item, "pos").orderBy(F.desc("alike"), "shift"))
    lined = written(lined.withColumn("rank", rank), "aligned-windows")
    follows = Window.partitionBy(*item).orderBy("pos")
    runs = lined.where("rank = 1").withColumn("again", F.coalesce(F.col("at") <= F.lag("at").over(follows), F.lit(False)).cast("bigint"))
    runs = runs.select(*item, "pos", "at", F.lit("run").alias("by"), F.sum("again").over(follows).alias("nth"))
    single = F.struct(F.lit("shift").alias("by"), F.col("shift").cast("bigint").alias("nth"))
    whole = F.struct(F.lit("text").alias("by"), F.lit(0).cast("bigint").alias("nth"))
    placed = written(lined.select(*item, "pos", "at", F.inline(F.array(single, whole))).union(runs), "placed-windows")
    one = [*item, "by", "nth"]
    counts = counts.withColumnRenamed("windows", "of_text")
    times = placed.groupBy(*one).agg(F.count_distinct("at").alias("windows")).join(counts, item)
    times = written(times.where(F.col("windows") >= enough).drop("of_text"), "occurrences")

    # Placeholder values of the matched windows, of the texts concerned only.
    spans = placed.join(times.select(*one), one).join(slots, "item_id")
    spans = spans.where((slots["at"] >= placed["at"]) & (slots["at"] < placed["at"] + size))
    spans = spans.select(*one, "kind", "value", (F.col("pos") + slots["at"] - placed["at"]).alias("pos")).distinct()
    raw = texts.join(spans.select("key").distinct(), "key", "left_semi").dropDuplicates(["key"])
    raw = raw.select("key", F.posexplode(_unmarked(tokens(marked(F.col("text"))))).alias("pos", "theirs"))
    pairs = spans.join(raw, ["key", "pos"]).groupBy(*one, "kind", "value", "theirs").agg(F.count(F.lit(1)).alias("n"))
    # Of the places of an item's value, those that have its most frequent counterpart agree.
    each = pairs.groupBy(*one, "kind", "value").agg(F.sum("n").alias("n"), F.max("n").alias("most"))
    agreed = each.groupBy(*one).agg(F.sum("n").alias("slots"), (F.sum("most") / F.sum("n")).alias("consistent"))

    # The occurrence with most windows of those that agree.
    held = times.join(agreed, one, "left")
    held = held.withColumn("slots", F.coalesce("slots", F.lit(0)).cast("bigint")).withColumn("consistent", F.coalesce("consistent", F.lit(1.0)))
    held = held.where(F.col("consistent") >= consistent).groupBy(*item, "item_windows")
    held = held.agg(F.max(F.struct("windows", "slots", "consistent")).alias("best"))
    held = held.select(*item, "best.windows", "item_windows", "best.slots", "best.consistent")
    held = written(held, "held-items")
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text_or_empty()).alias("key"))
    return ids.join(held, "key").withColumnRenamed("key", "text_key")


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item."""
    held = written(contaminated(docs, benchmark, **options).select(F.col("text_key").alias("__key")).distinct(), "contaminated-texts")
    return docs.join(sized(held), F.xxhash64(text_or_empty()) == F.col("__key"), "left_anti")

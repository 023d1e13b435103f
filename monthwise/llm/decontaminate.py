"""Benchmark decontamination by template canonicalisation.

Templates.  In a text, names (capitalised words), numbers, and units after a
number are typed slots; the rest is lower-cased and cut in words.  A window of
words has up to three forms: *named* (all slots are placeholders), *folded*
(names are lower-case words; numbers and units are placeholders) and *valued*
(nothing is a placeholder).  A question and its re-parameterised copies have
equal named forms; the named form of a copy in lower or upper case is the
question's folded form, as it shows no names.

Search.  Every window of ``WINDOW`` words of every whole document is
hash-joined with the windows of the benchmark (an item of fewer words, of at
least ``MIN_WORDS``, is one window of its own length).  An item's window is
looked for in its named and folded forms where those have ``LITERALS`` words
that are no placeholders, and else in its valued form: rows of numbers match
the same numbers only.  Equal windows of an item count once.

A first pass finds the documents that can match: a matching window holds, at
every ``stride``-th word of the document, a shorter one that matches too, so
few windows are hashed and none is lost.  All windows are hashed in those
documents alone.

Matches on one diagonal (document place minus item place) are one alignment.
Inserted and deleted words move a copy to other diagonals, so the distinct item
windows of two neighbouring bands of ``REACH`` diagonals are counted together.
They are a candidate if they cover ``COVERAGE`` of the item's windows, or
``ENOUGH`` windows of an item of any length.

Slots.  Along an alignment each slot of the item's matched windows meets a
value of the document; what stands outside them is not compared.  They are
consistent if every item value always meets the same document value (5 may
become 7, but everywhere).  An inconsistent alignment is left out of the
count.  Candidates that still hold are leaks; one with an alignment whose
values differ from the item's is a re-parameterised copy.

Plan.  The item windows are broadcast if there are at most
``BROADCAST_WINDOWS`` (counted first); beyond that Spark shuffles both
sides.  Counts are of rows, by place: no row holds a document's words or its
matches, so a long text of many matches is many rows, not large ones.
DataFrame functions only.

Cases.  Null or empty texts have no window.  Repeated rows (equal doc_id and
text) give one result row per item, and all of them go in ``drop_leaks``; null
doc_ids are compared null-safe.  Repeated items each match.  Empty tables:
no leak.  Other columns are ignored, and passed through by ``drop_leaks``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise.llm.common import named_back, neutral, read_table, staged

WINDOW = 8
MIN_WORDS = 4
COVERAGE = 0.25
#: Words of a window that must be no placeholders, for a match by template.
LITERALS = 3
#: Diagonals of a band; a copy's inserted or deleted words may move it by so many.
REACH = 16
#: Matched windows that make a leak whatever the item's length (31 words on end).
ENOUGH = 24
BROADCAST_WINDOWS = 500_000
#: Words that are units when they follow a number.
UNITS = (
    "nm|mm|cm|dm|m|km|in|inch|inches|ft|foot|feet|yd|yards?|miles?|met(?:er|re)s?|kilomet(?:er|re)s?|"
    "mg|g|kg|t|oz|lbs?|pounds?|grams?|kilograms?|tons?|tonnes?|ml|cl|dl|l|lit(?:er|re)s?|gallons?|cups?|"
    "ms|s|sec|secs|seconds?|min|mins|minutes?|h|hrs?|hours?|days?|weeks?|months?|years?|"
    "hz|khz|mhz|ghz|kb|mb|gb|tb|bytes?|bits?|v|volts?|w|kw|watts?|j|kj|joules?|n|newtons?|pa|kpa|"
    "k|kelvin|celsius|fahrenheit|degrees?|percent|dollars?|cents?|euros?|usd|eur|mph|kmh"
)
#: Decimal point or comma inside a number, kept as a letter so that the number is one word.
_POINT = "ᵈ"
#: Placeholders: characters of the private use area, which no text's words hold.
NAME, NUMBER, UNIT = "\ue000", "\ue001", "\ue002"


_NAMES = r"\p{Lu}(?<![\p{L}\p{M}\p{N}].)\p{Ll}+"
_BREAKS = rf"[^\p{{L}}\p{{M}}\p{{N}}{NAME}{NUMBER}{UNIT}]+"


def _spaced(text: Column) -> Column:
    """The words of ``text``, one space between them."""
    return F.trim(F.regexp_replace(text, _BREAKS, " "))


def _numbers(text: Column, values: bool) -> Column:
    """Numbers, and units after them, as placeholders, which stand before their values."""
    number, unit = ("$0", "$2") if values else ("", "")
    t = F.regexp_replace(text, f"[0-9][0-9{_POINT}]*", f" {NUMBER}{number} ")
    return F.regexp_replace(t, rf"({NUMBER}[0-9{_POINT}]*) +({UNITS})(?![\p{{L}}\p{{N}}])", f"$1 {UNIT}{unit}")


def with_forms(df: DataFrame, text: str) -> DataFrame:
    """Columns _n, _v: the words in named and valued form, spaced, at equal
    places.  The valued one is null in texts without digits."""
    df = df.withColumn("_d", F.coalesce(F.col(text).rlike("[0-9]"), F.lit(False)))
    df = df.withColumn("_p", F.when(F.col("_d"), _pointed(F.col(text))).otherwise(F.col(text)))
    named = F.lower(F.regexp_replace("_p", _NAMES, NAME))
    df = df.withColumn("_n", _spaced(F.when(F.col("_d"), _numbers(named, False)).otherwise(named)))
    return df.withColumn("_v", F.when(F.col("_d"), _spaced(_numbers(F.lower("_p"), True)))).drop("_d", "_p")


def _pointed(text: Column) -> Column:
    return F.regexp_replace(text, r"[.,](?<=[0-9].)(?=[0-9])", _POINT)


def slot_words(text: Column) -> Column:
    """The words of ``text``, lower-cased; a slot has its placeholder before its value."""
    t = _spaced(_numbers(F.lower(F.regexp_replace(_pointed(text), _NAMES, f"{NAME}$0")), True))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, " "))


def _windows(form: Column, width: int, stride: int = 1) -> Column:
    """``width`` words on end from every ``stride``-th word, as text, in order:
    a look ahead, then the words to the next place."""
    more = f"{{{width - 1}}}"
    return F.regexp_extract_all(form, F.lit(f"(?=([^ ]++(?: [^ ]++){more}))[^ ]++(?: [^ ]++){{{stride - 1}}} ?"), F.lit(1))


def _by_width(widths: list[int], value) -> Column:
    """``value(width)`` by the column ``width``."""
    out = F.when(F.col("width") == widths[0], value(widths[0]))
    for n in widths[1:]:
        out = out.when(F.col("width") == n, value(n))
    return out


def _part(width: int, window: int) -> tuple[int, int]:
    """(length, stride) of the first pass: so that each ``width`` words on end
    hold such a shorter window.  Short items are looked for whole."""
    stride = window // 2 if width == window else 1
    return width - stride + 1, stride


def item_windows(benchmark: DataFrame, *, item_id: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """The windows to look for: item_id, item_hash, width, n_windows, j, x (the text), h (its hash)."""
    items = benchmark.where(F.col(item_id).isNotNull()).select(
        F.col(item_id).alias("item_id"), F.xxhash64(text).alias("item_hash"), F.coalesce(F.col(text), F.lit("")).alias("_t")
    )
    items = with_forms(items.distinct(), "_t").withColumn("_f", _spaced(_numbers(F.lower(_pointed(F.col("_t"))), False)))
    items = items.withColumn("_size", F.when(F.col("_f") == "", 0).otherwise(F.size(F.split("_f", " "))))
    items = items.where(F.col("_size") >= MIN_WORDS).withColumn("width", F.least(F.col("_size"), F.lit(window)))
    forms = [F.col("_f"), F.col("_n"), F.coalesce("_v", "_f")]
    parts = []
    for width in range(MIN_WORDS, window + 1):
        zipped = F.arrays_zip(*[_windows(c, width).alias(n) for c, n in zip(forms, "fnv")])
        some = items.where(F.col("width") == width)
        parts.append(some.select("item_id", "item_hash", "width", F.posexplode(zipped).alias("i", "_z")))
    items = parts[0]
    for part in parts[1:]:
        items = items.unionByName(part)
    marks = f"left(w, 1) not in ('{NAME}', '{NUMBER}', '{UNIT}')"
    folded, named = (F.expr(f"size(filter(split(_z.{c}, ' '), w -> {marks})) >= {LITERALS}") for c in "fn")
    f, n, v = (F.col(f"_z.{c}") for c in "fnv")
    wanted = F.when(~folded, F.array(v)).when(named, F.array_distinct(F.array(f, n))).otherwise(F.array(f))
    items = items.select("item_id", "item_hash", "width", "i", v.alias("same"), wanted.alias("xs"))
    # equal windows are one, at their first place
    first = items.groupBy("item_id", "item_hash", "width", "same").agg(F.min("i").alias("j"), F.array_distinct(F.flatten(F.collect_list("xs"))).alias("xs"))
    sizes = first.groupBy("item_id", "item_hash").agg(F.count(F.lit(1)).alias("n_windows"))
    return first.join(sizes.withColumnRenamed("item_hash", "_ih"), ["item_id"]).where(F.col("item_hash").eqNullSafe(F.col("_ih"))).select(
        "item_id", "item_hash", "width", "n_windows", "j", F.explode("xs").alias("x")
    ).withColumn("h", F.xxhash64("x"))


def _by_band(rows: DataFrame, reach: int) -> DataFrame:
    """Each row under both pairs of bands that its diagonal is in; ``band`` is the pair's first."""
    band = F.floor(F.col("shift") / reach)
    return rows.withColumn("band", F.explode(F.array(band - 1, band)))


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    window: int = WINDOW,
    coverage: float = COVERAGE,
    reach: int = REACH,
    enough: int = ENOUGH,
    broadcast_windows: int = BROADCAST_WINDOWS,
) -> DataFrame:
    """One row per (document, item) leak: doc_id, _th (hash of the text),
    item_id, n_windows, coverage, start (word), n_slots, reparameterised."""
    items = staged(item_windows(benchmark, window=window), "decontaminate/items")
    by_width = {r["width"]: r["n"] for r in items.groupBy("width").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `window` rows
    small = sum(by_width.values()) <= broadcast_windows
    texts = docs.select("doc_id", F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_t"))
    widths = sorted(by_width) or [window]

    def same(left: str, right: str, columns) -> Column:
        tests = [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns]
        return tests[0] if len(tests) == 1 else tests[0] & same(left, right, columns[1:])

    def looked_up(texts: DataFrame, keys: DataFrame, parts: dict[int, tuple[int, int]]) -> DataFrame:
        """The windows of ``texts`` that ``keys`` (h, width) has, with their place ``i``."""
        forms = with_forms(texts.select("doc_id", "_t", F.xxhash64("_t").alias("_th")), "_t")
        forms = forms.select("doc_id", "_th", F.explode(F.array("_n", "_v")).alias("_t")).where("_t <> ''")
        forms = forms.withColumn("width", F.explode(F.array(*map(F.lit, widths))))
        found = _by_width(widths, lambda n: _windows(F.col("_t"), *parts[n]))
        rows = forms.select("doc_id", "_th", "width", F.posexplode(found).alias("i", "_x"))
        rows = rows.select("doc_id", "_th", "width", "i", F.xxhash64("_x").alias("h"))
        return rows.join(F.broadcast(keys) if small else keys, ["h", "width"])

    parts = {n: _part(n, window) for n in widths}
    keys = items.select("width", F.explode(_by_width(widths, lambda n: _windows(F.col("x"), parts[n][0]))).alias("x"))
    keys = keys.select("width", F.xxhash64("x").alias("h")).distinct()
    can = staged(looked_up(texts, keys, parts).select("doc_id", "_th").distinct(), "decontaminate/documents")
    hashed = texts.withColumn("_th", F.xxhash64("_t"))
    texts = hashed.alias("x").join(can.alias("y"), same("x", "y", ["doc_id", "_th"]), "left_semi").distinct()
    texts = staged(texts, "decontaminate/texts")
    hits = looked_up(texts, items.drop("x"), {n: (n, 1) for n in widths})
    pair = ["doc_id", "_th", "item_id", "item_hash"]
    hits = hits.select(*pair, "n_windows", "width", (F.col("i") - F.col("j")).alias("shift"), "j").distinct()
    hits = staged(hits, "decontaminate/hits")

    need = F.least(coverage * F.col("n_windows"), F.lit(float(enough)))

    def counted(rows: DataFrame) -> DataFrame:
        """Distinct item windows of each pair of bands, those that are enough."""
        per = _by_band(rows, reach).groupBy(*pair, "n_windows", "band").agg(F.count_distinct("j").alias("hit"))
        return per.where(F.col("hit") >= need)

    # the alignments of candidates
    bands = counted(hits).select(*pair, "band")
    near = _by_band(hits, reach).alias("x").join(bands.alias("y"), same("x", "y", [*pair, "band"]), "left_semi")
    aligned = staged(near.drop("band").distinct(), "decontaminate/aligned")

    # the slots of their documents and items, by place
    there = aligned.select("doc_id", "_th").distinct()
    of_docs = texts.alias("x").join(there.alias("y"), same("x", "y", ["doc_id", "_th"]), "left_semi")
    of_docs = _slots(of_docs.select("doc_id", "_th", "_t").distinct(), "_t").drop("_t").withColumnRenamed("value", "b")
    asked = benchmark.select("item_id", F.xxhash64("text").alias("item_hash"), F.coalesce("text", F.lit("")).alias("_t")).distinct()
    asked = _slots(asked, "_t").drop("_t").withColumnRenamed("value", "a")
    places = aligned.withColumn("place", F.explode(F.expr("sequence(j, j + width - 1)")))
    places = places.select(*pair, "shift", "place").distinct()
    met = places.alias("x").join(asked.alias("y"), same("x", "y", ["item_id", "item_hash", "place"]))
    met = met.select(*[f"x.{c}" for c in pair], "shift", "a", (F.col("x.place") + F.col("shift")).cast("int").alias("place"))
    met = met.alias("x").join(of_docs.alias("y"), same("x", "y", ["doc_id", "_th", "place"]))
    met = met.where(F.left("a", F.lit(1)) == F.left("b", F.lit(1))).select(*[f"x.{c}" for c in pair], "shift", "a", "b").distinct()
    met = staged(met, "decontaminate/slots")
    unlike = met.groupBy(*pair, "shift", "a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*pair, "shift").distinct()
    line = [*pair, "shift"]

    # counted again, of consistent alignments
    held = aligned.alias("x").join(unlike.alias("y"), same("x", "y", line), "left_anti")
    at = _by_band(held, reach).groupBy(*pair, "band").agg(F.min("shift").alias("first"))
    slots = _by_band(met.alias("x").join(unlike.alias("y"), same("x", "y", line), "left_anti"), reach)
    slots = slots.groupBy(*pair, "band").agg(
        F.count_distinct("a", "b").cast("int").alias("n_slots"), F.max(F.col("a") != F.col("b")).alias("changed")
    )
    by = [*pair, "band"]
    leaks = counted(held).alias("x").join(at.alias("y"), same("x", "y", by))
    leaks = leaks.select("x.*", "y.first").alias("x").join(slots.alias("y"), same("x", "y", by), "left")
    leaks = leaks.select("x.*", F.coalesce("y.n_slots", F.lit(0)).alias("n_slots"), F.coalesce("y.changed", F.lit(False)).alias("changed"))
    # the first band of the most windows is reported
    best = F.max_by(F.struct("hit", "n_windows", "first", "n_slots", "changed"), F.struct("hit", -F.col("band"), F.coalesce("item_hash", F.lit(0))))
    return (
        leaks.groupBy("doc_id", "_th", "item_id")
        .agg(best.alias("x"))
        .select(
            "doc_id",
            "_th",
            "item_id",
            F.col("x.hit").alias("n_windows"),
            (F.col("x.hit") / F.col("x.n_windows")).alias("coverage"),
            F.greatest(F.col("x.first"), F.lit(0)).cast("int").alias("start"),
            F.col("x.n_slots").alias("n_slots"),
            F.col("x.changed").alias("reparameterised"),
        )
    )


def _slots(df: DataFrame, text: str) -> DataFrame:
    """A row for each slot of ``text``: its ``place`` and ``value`` (placeholder and value)."""
    # the words are no column of their own: Spark would filter by their number, and
    # push that below the joins, over all texts
    slots = df.select(*df.columns, F.posexplode(slot_words(F.col(text))).alias("place", "value"))
    return slots.where(F.left("value", F.lit(1)).isin(NAME, NUMBER, UNIT))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that hold no leak of the benchmark."""
    leaks = find_leaks(docs, benchmark, **options).select(F.col("doc_id").alias("_leak_id"), F.col("_th").alias("_leak_hash")).distinct()
    rows, names = neutral(docs)
    hashed = F.xxhash64(F.coalesce(F.col(names["text"]), F.lit("")))
    same = F.col(names["doc_id"]).eqNullSafe(F.col("_leak_id")) & (hashed == F.col("_leak_hash"))
    return named_back(rows.join(leaks, same, "left_anti"), names)


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) leak."""
    return find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("_th")

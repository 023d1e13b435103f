"""Secret scan: fixed patterns, and sliding-window entropy of candidates.

Base spans come from three patterns (assignments, access keys, long hex).
The entropy scan adds spans.  A candidate is a run of ``CANDIDATE``
characters.  Runs of letters and digits in it that hold a word of
``ALLOWED_WORDS`` are cut out; a piece left of at least ``WINDOW`` characters
stands unless an allow-list entry covers it whole.  Over it slides a window of
``WINDOW`` characters; each maximal stretch covered by windows whose Shannon
entropy reaches the threshold of the piece's character class is a span.

The entropy is kept by incremental counts.  With S the sum of n log2 n over
the counts n of the window's characters, H = log2(W) - S / W.  A character
that enters with n equal ones in the window adds (n+1) log2 (n+1) - n log2 n,
one that leaves takes the like away, so S is a running sum of both.  Counts
and sums are DataFrame windows over (piece, block, character) and (piece,
block): a piece goes by the 128-bit hash of its text and is cut into blocks of
``BLOCK`` window starts, so that a very long run costs in proportion to its
length and is spread over tasks.  Stretches of neighbouring blocks are joined.
Each distinct block is looked at once, so copies cost nothing.

Offsets.  A match's start is the length of all pieces between matches and of
all matches before it, in code points: a running sum over the pieces of one
document.

DataFrame functions only; texts pass the patterns once, and all that is
shuffled is lengths, candidates and spans.

Cases.  Null text: as empty.  Every row gets its row, repeated rows and null
or equal doc_ids too (rows are told apart by their place in the staged
table).  A very long run is cut into blocks.  An empty table gives an empty
table.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from monthwise.llm.common import read_table, staged

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
MIN_VALUE = 6
CANDIDATE = "[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
#: Bits a character that a window needs, by character class.
THRESHOLDS = {"hex": 2.8, "alnum": 3.5, "base64": 3.7}
#: Window starts in a block.
BLOCK = 4096
#: Words that mark an example; the run of letters and digits around one is no secret.
ALLOWED_WORDS = "(?i:example|sample|placeholder|changeme|dummy|xxxx)"
#: Such a run.  It is looked for from the run's first character on only.
ALLOWED_RUN = f"(?<![A-Za-z0-9])[A-Za-z0-9]*?{ALLOWED_WORDS}[A-Za-z0-9]*"
#: What is no secret though it may look like one.
ALLOWED = [
    r"^[0-9]+$",  # numbers
    r"^[A-Za-z]+$",  # words
    r"^[^A-Za-z0-9]+$",  # rules of punctuation
    r"^(.)\1+$",  # one character
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",  # UUIDs
]
#: Words in a path or an identifier: letters from the first on, and single separators.
PATH, DOUBLE_SEPARATOR = "^[A-Za-z][A-Za-z_/-]*$", "[-_/]{2}"
KINDS = ["assign", "access", "hex", "entropy"]


def _pieces(name: str, pattern: str, text: Column) -> list[Column]:
    """Lengths of the pieces before each match, and of the matches; null
    where nothing matches (so most texts cost one search)."""
    hit = text.rlike(pattern)
    pattern_ = F.lit(pattern)
    return [
        F.when(hit, F.transform(F.split(text, pattern, -1), lambda x: F.length(x))).alias(f"{name}_gap"),
        F.when(hit, F.transform(F.regexp_extract_all(text, pattern_, F.lit(0)), lambda x: F.length(x))).alias(f"{name}_len"),
    ]


def _starts(staged_rows: DataFrame, name: str, extra: str | None = None) -> DataFrame:
    """One row a match: _uid, start, end (and ``extra``'s element)."""
    more = f", {extra}[i]" if extra else ", null"
    each = staged_rows.where(f"{name}_gap is not null").select(
        "_uid",
        F.expr(f"posexplode(transform({name}_len, (n, i) -> struct({name}_gap[i] as gap, n as n {more} as x)))").alias("i", "m"),
    )
    before = Window.partitionBy("_uid").orderBy("i")
    end = F.sum(F.col("m.gap") + F.col("m.n")).over(before)
    return each.select("_uid", (end - F.col("m.n")).alias("start"), end.alias("end"), F.col("m.x").alias("x"))


def _unsuppressed(candidates: DataFrame) -> DataFrame:
    """(_uid, start, x) of the pieces that the allow-list leaves of candidates."""
    marked = F.col("x").rlike(ALLOWED_WORDS)
    each = candidates.where(marked).select(
        "_uid",
        "start",
        F.split("x", ALLOWED_RUN, -1).alias("gaps"),
        F.regexp_extract_all("x", F.lit(ALLOWED_RUN), F.lit(0)).alias("runs"),
    )
    each = each.select(
        "_uid", "start", F.expr("posexplode(transform(gaps, (g, i) -> struct(g as g, coalesce(length(get(runs, i)), 0) as n)))").alias("i", "m")
    )
    before = Window.partitionBy("_uid", "start").orderBy("i")
    gap = F.length("m.g")
    place = F.col("start") + F.sum(gap + F.col("m.n")).over(before) - F.col("m.n") - gap
    pieces = each.select("_uid", place.alias("start"), F.col("m.g").alias("x")).where(F.length("x") >= WINDOW)
    left = candidates.where(~marked).select("_uid", "start", "x").union(pieces)
    for allowed in ALLOWED:
        left = left.where(~F.col("x").rlike(allowed))
    return left.where(~(F.col("x").rlike(PATH) & ~F.col("x").rlike(DOUBLE_SEPARATOR)))


def _stretches(ranges: DataFrame, by: list[str]) -> DataFrame:
    """Ranges (from, to) that overlap or touch, joined, per ``by``.  All
    ranges are of one length or apart, so the one before decides."""
    order = Window.partitionBy(*by).orderBy("from")
    first = F.lag("to").over(order)
    new = (first.isNull() | (F.col("from") > first)).cast("int")
    numbered = ranges.withColumn("new", new).withColumn("island", F.sum("new").over(order))
    return numbered.groupBy(*by, "island").agg(F.min("from").alias("from"), F.max("to").alias("to")).drop("island")


def entropy_stretches(pieces: DataFrame) -> DataFrame:
    """For strings (key, x) of ASCII characters: (key, from, to), the stretches
    of the windows that reach the threshold of the string's class."""
    kind = F.when(F.col("x").rlike("^([0-9a-f]+|[0-9A-F]+)$"), "hex").when(F.col("x").rlike("^[A-Za-z0-9]+$"), "alnum").otherwise("base64")
    need = F.lit(THRESHOLDS["base64"])
    for name in ("alnum", "hex"):
        need = F.when(kind == name, F.lit(THRESHOLDS[name])).otherwise(need)
    last = F.floor((F.length("x") - WINDOW) / BLOCK).cast("int")
    blocks = pieces.select("key", need.alias("need"), F.col("x").cast("binary").alias("x"), F.explode(F.sequence(F.lit(0), last)).alias("b"))
    # bytes are cut in place, without a walk from the string's start
    part = F.expr(f"cast(substring(x, b * {BLOCK} + 1, {BLOCK + WINDOW - 1}) as string)")
    blocks = blocks.select("key", "b", "need", part.alias("part")).distinct()
    chars = blocks.select("key", "b", "need", F.posexplode(F.split("part", "")).alias("p", "c")).where("c <> ''")
    same = Window.partitionBy("key", "b", "c").orderBy("p")
    ahead = F.count(F.lit(1)).over(same.rangeBetween(-WINDOW, -1))  # equal ones as it enters
    after = F.count(F.lit(1)).over(same.rangeBetween(0, WINDOW))  # equal ones as it leaves, itself too
    nlogn = lambda n: F.when(n > 0, n * F.log2(n.cast("double"))).otherwise(F.lit(0.0))
    deltas = chars.withColumn("enter", nlogn(ahead + 1) - nlogn(ahead)).withColumn("leave", nlogn(after) - nlogn(after - 1))
    run = Window.partitionBy("key", "b").orderBy("p")
    total = F.sum("enter").over(run.rangeBetween(Window.unboundedPreceding, 0)) - F.coalesce(
        F.sum("leave").over(run.rangeBetween(Window.unboundedPreceding, -WINDOW)), F.lit(0.0)
    )
    scored = deltas.withColumn("h", F.log2(F.lit(float(WINDOW))) - total / WINDOW).where(F.col("p") >= WINDOW - 1)
    end = F.col("b").cast("long") * BLOCK + F.col("p") + 1
    high = scored.where(F.col("h") >= F.col("need") - 1e-9).select("key", "b", (end - WINDOW).alias("from"), end.alias("to"))
    return _stretches(_stretches(high, ["key", "b"]), ["key"])


def scan_secrets(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id and ``found``, its spans (start, kind
    number, kind, end) in order."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.col("doc_id"), t.alias("_t")).select(
        "doc_id",
        F.monotonically_increasing_id().alias("_uid"),
        *_pieces("assign", ASSIGN, F.col("_t")),
        F.when(F.col("_t").rlike(ASSIGN), F.transform(F.regexp_extract_all("_t", F.lit(ASSIGN), F.lit(2)), lambda x: F.length(x))).alias("value"),
        *_pieces("access", ACCESS, F.col("_t")),
        *_pieces("hex", HEX, F.col("_t")),
        *_pieces("entropy", CANDIDATE, F.col("_t")),
        F.when(F.col("_t").rlike(CANDIDATE), F.regexp_extract_all("_t", F.lit(CANDIDATE), F.lit(0))).alias("candidate"),
    )
    rows = staged(rows, "secrets/rows")
    base = [
        _starts(rows, "assign", "value").where(F.col("x") >= MIN_VALUE).select("_uid", "start", F.lit(0).alias("k"), "end"),
        _starts(rows, "access").select("_uid", "start", F.lit(1).alias("k"), "end"),
        _starts(rows, "hex").select("_uid", "start", F.lit(2).alias("k"), "end"),
    ]
    candidates = _unsuppressed(_starts(rows, "entropy", "candidate"))
    candidates = staged(candidates.select("_uid", "start", F.md5("x").alias("key"), "x"), "secrets/candidates")
    stretches = entropy_stretches(candidates.select("key", "x"))
    entropy = candidates.select("_uid", "start", "key").join(stretches, "key").select(
        "_uid", (F.col("start") + F.col("from")).alias("start"), F.lit(3).alias("k"), (F.col("start") + F.col("to")).alias("end")
    )
    spans = base[0].union(base[1]).union(base[2]).union(entropy)
    names = F.array(*[F.lit(k) for k in KINDS])
    grouped = spans.groupBy("_uid").agg(F.sort_array(F.collect_list(F.struct("start", "k", "end"))).alias("found"))
    named = F.transform("found", lambda s: F.struct(s["start"].alias("start"), s["k"].alias("k"), names[s["k"]].alias("kind"), s["end"].alias("end")))
    return rows.select("_uid", "doc_id").join(grouped, "_uid", "left").select(
        "doc_id", F.coalesce(named, F.expr("array()")).alias("found")
    )


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every document."""
    found = scan_secrets(read_table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("found", lambda s: s["k"] == k)).cast("long")
    line = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    base = F.filter("found", lambda s: s["k"] < 3)
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(line(base), 256).alias("base_sha256"),
        line(F.col("found")).alias("spans"),
    )

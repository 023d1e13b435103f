"""Line deduplication by a suffix array over line ids.

The corpus is a sequence of line ids: the non-blank lines of every document,
documents in order of (doc_id, text hash).  A *run* is a stretch of lines of
one document; it repeats if the same lines stand elsewhere too.  Runs of at
least ``MIN_CHARS`` characters that repeat are kept where they come first
and deleted everywhere else.

Suffix array by prefix doubling.  Rank 0 of a place is its line's rank among
the lines that occur more than once (others end every repeated run, so their
places are dropped).  Rank j+1 is the rank of the pair (rank j here, rank j
2^j lines on), among the pairs that occur more than once.  A rank is a row
number over a range sort of the distinct pairs, so ranks keep the order of
the suffixes: sorting by the last rank gives the suffix array, and equal
ranks j are a longest-common-prefix interval of depth 2^j.

Which intervals count.  A maximal repeated run of enough characters is the
union of its *shortest* stretches of enough characters: from each line
forwards, and back from each line.  Such a stretch has at most ``MIN_CHARS``
lines, however long the run is, so log2(MIN_CHARS) rounds do.  Its interval
of depth L, 2^j <= L < 2^(j+1), is named by the rank j of its first and of
its last 2^j lines.  Of each interval the first place stays, and the lines
of all later ones are deleted; overlapping ones add up to the maximal runs.

Shuffles.  All lines once, as 16-byte ids; then only places of repeated
lines.  Texts move once, to meet their deletions.  A line that makes up a
third of all places is pre-aggregated, and its join can be split.

DataFrame functions only.

Cases.  Null text: stays null.  Blank lines are not part of runs and stay,
unless no other line is left: then the text is empty.  Repeated rows (equal
doc_id and text) are one document and get the same text; null doc_ids sort
first and count as equal.  An empty table gives an empty table.  Other
columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from monthwise.llm.common import neutral, read_table, shuffle_count, staged

MIN_CHARS = 30

_DOC = ["_id", "_th"]


def _rank(values: DataFrame, columns: list[str], out: str, name: str) -> DataFrame:
    """Distinct ``values`` with an order-keeping number: their place in a
    range sort (partition number in the high bits), frozen by writing it."""
    ordered = values.repartitionByRange(shuffle_count(values.sparkSession), *columns).sortWithinPartitions(*columns)
    return staged(ordered.withColumn(out, F.monotonically_increasing_id()), name)


def repeated_places(docs: DataFrame) -> DataFrame:
    """Places of lines that occur more than once: the document (_id, _th),
    the line's number among all (line) and among non-blank ones (pos), its
    length, and ``r0``."""
    texts = docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_th"), F.split("text", "\n").alias("_l")).where("_l is not null")
    # (line number, id, length) of non-blank lines; pos counts those
    lines = F.expr(
        "filter(transform(_l, (x, i) -> struct(i as line, xxhash64(x) as h, xxhash64(x, 'line') as g, length(x) as n, trim(x) <> '' as ok)), s -> s.ok)"
    )
    each = texts.select("_id", "_th", F.posexplode(lines).alias("pos", "s")).select("_id", "_th", "pos", "s.line", "s.h", "s.g", "s.n")
    place = F.struct(F.col("_id"), F.col("_th"), F.col("pos"))
    twice = each.groupBy("h", "g").agg(F.min(place).alias("lo"), F.max(place).alias("hi")).where("not (lo <=> hi)")
    ranks = _rank(twice.select("h", "g"), ["h", "g"], "r0", "lines/rank0")
    placed = each.join(ranks, ["h", "g"]).select("_id", "_th", "pos", "line", "n", "r0")
    # repeated rows of a document are one document
    return placed.dropDuplicates(["_id", "_th", "pos"])


def _doubled(places: DataFrame, rounds: int) -> DataFrame:
    """``places`` (with ``run``) and the ranks r1..r``rounds`` of the first
    2, 4, ... lines from each place; null where those do not repeat."""
    ahead = Window.partitionBy(*_DOC, "run").orderBy("pos")
    for j in range(1, rounds + 1):
        a, out = f"r{j - 1}", f"r{j}"
        paired = places.withColumn("_b", F.lead(a, 1 << (j - 1)).over(ahead))
        twice = paired.where(f"{a} is not null and _b is not null").groupBy(a, "_b").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
        ranks = _rank(twice.select(a, "_b"), [a, "_b"], out, f"lines/rank{j}")
        places = staged(paired.join(ranks, [a, "_b"], "left").drop("_b"), f"lines/places{j}")
    return places


def _shortest(frame: str, min_chars: int) -> str:
    """SQL: how many elements of the array ``frame`` make up enough characters (null: not all of them do)."""
    return (
        f"aggregate({frame}, struct(0 as s, 0 as k), (a, x) -> if(a.s >= {min_chars}, a, struct(a.s + x.n as s, a.k + 1 as k)), "
        f"a -> if(a.s >= {min_chars}, a.k, null))"
    )


def repeated_stretches(places: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Shortest stretches of enough characters, each with its place (pos),
    length (len), line numbers, and the two ranks that name its interval."""
    order = Window.partitionBy(*_DOC).orderBy("pos")
    runs = places.withColumn("run", F.col("pos") - F.row_number().over(order))  # equal along consecutive places
    inside = Window.partitionBy(*_DOC, "run")
    runs = staged(runs.withColumn("shortest", F.min("n").over(inside)), "lines/runs")
    single = runs.where(F.col("n") >= min_chars).select(
        *_DOC, "pos", F.lit(1).alias("len"), F.array("line").alias("lines"), F.col("r0").alias("a"), F.col("r0").alias("b")
    )
    # a stretch of several lines has a short one, and so has every run with an equal stretch
    rounds = max(0, min_chars.bit_length() - 1)
    several = _doubled(runs.where(F.col("shortest") < min_chars).drop("shortest"), rounds)
    element = F.struct("n", "line", "pos", *[f"r{j}" for j in range(rounds + 1)])
    along = inside.orderBy("pos")
    framed = several.select(
        *_DOC,
        F.collect_list(element).over(along.rowsBetween(0, min_chars - 1)).alias("ahead"),
        F.collect_list(element).over(along.rowsBetween(1 - min_chars, 0)).alias("behind"),
    )
    both = framed.select(
        *_DOC,
        F.explode(
            F.array(
                F.expr(f"slice(ahead, 1, coalesce({_shortest('ahead', min_chars)}, 0))"),
                F.expr(f"slice(reverse(behind), 1, coalesce({_shortest('reverse(behind)', min_chars)}, 0))"),
            )
        ).alias("e"),
    ).where(F.size("e") > 1)
    both = both.withColumn("e", F.sort_array(F.transform("e", lambda x: F.struct(x["pos"].alias("pos"), x.alias("x")))))
    level = F.floor(F.log2(F.size("e").cast("double")) + 1e-9).cast("int")
    rank_at = lambda index: F.coalesce(
        *[F.when(F.col("j") == j, F.get("e", index)["x"][f"r{j}"]) for j in range(1, rounds + 1)], F.lit(None).cast("long")
    )
    both = both.withColumn("j", level)
    longer = both.select(
        *_DOC,
        F.get("e", F.lit(0))["pos"].alias("pos"),
        F.size("e").alias("len"),
        F.transform("e", lambda x: x["x"]["line"]).alias("lines"),
        rank_at(F.lit(0)).alias("a"),
        rank_at(F.expr("size(e) - shiftleft(1, j)")).alias("b"),
    ).where("a is not null and b is not null")
    return single.union(longer.dropDuplicates([*_DOC, "pos", "len"]))


def deletions(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(_id, _th, gone): the line numbers to delete, of documents with any."""
    stretches = staged(repeated_stretches(repeated_places(docs), min_chars), "lines/stretches")
    place = F.struct("_id", "_th", "pos")
    # written, so that the join below has plain shuffles on both sides and a
    # stretch that stands in a third of all places can be split
    first = staged(stretches.groupBy("len", "a", "b").agg(F.min(place).alias("first")), "lines/first")
    later = stretches.join(first, ["len", "a", "b"]).where(~F.col("first").eqNullSafe(place))
    return later.groupBy(*_DOC).agg(F.array_distinct(F.flatten(F.collect_list("lines"))).alias("gone"))


def dedup_lines(docs: DataFrame, *, min_chars: int = MIN_CHARS, count: str | None = None) -> DataFrame:
    """``docs`` with later copies of repeated line runs deleted from
    ``text`` (and the number of deleted lines in column ``count``)."""
    gone = deletions(docs.select("doc_id", "text"), min_chars)
    gone = gone.select(F.col("_id").alias("_gone_id"), F.col("_th").alias("_gone_hash"), F.col("gone").alias("_gone"))
    rows, names = neutral(docs)
    text = names["text"]
    same = F.col(names["doc_id"]).eqNullSafe(F.col("_gone_id")) & (F.xxhash64(text) == F.col("_gone_hash"))
    joined = rows.join(gone, same, "left")
    lines = joined.withColumn("_lines", F.split(text, "\n")).withColumn(
        "_kept", F.expr("transform(array_except(sequence(0, size(_lines) - 1), _gone), k -> get(_lines, k))")
    )
    rewritten = F.when(F.exists("_kept", lambda x: F.trim(x) != ""), F.array_join("_kept", "\n")).otherwise(F.lit(""))
    columns = [
        (F.when(F.col("_gone").isNull(), F.col(n)).otherwise(rewritten) if n == text else F.col(n)).alias(c)
        for c, n in names.items()
    ]
    if count:
        columns.append(F.when(F.col("_gone").isNull(), 0).otherwise(F.size("_gone")).alias(count))
    return lines.select(*columns)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the text without later copies of repeated runs, n_deleted."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs, count="n_deleted")

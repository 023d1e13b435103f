"""File names for an ingest manifest (a table of URLs -> target names).

Column functions, all JVM-side: the name in a URL, the name in a
Content-Disposition header, the precedence between names, the
percent-quoted URL path, and the `` (k)`` numbering of names already taken.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthwise.operators.sequence import split_row_number

# Name detection rules.
DEFAULT_FILE_NAME = "download.wget"
DISPOSITION_TYPES = ("inline", "attachment")
URL_NAME_STRIP = " \n\t."  # a name made only of these is no name
QUOTE_CHARS_STRIP = ' \t"'  # stripped around a header file name
# scheme (letter first), optional //authority, then the path up to ? or #
URL_PATH_PATTERN = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"
URL_SCHEME_PATTERN = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
# schemes whose last path segment carries ``;params`` (Python's
# urllib.parse.uses_params; "" is a URL without a scheme); for any other
# scheme the ``;...`` is part of the name
PARAM_SCHEMES = ("", "ftp", "hdl", "prospero", "http", "imap", "https", "shttp", "rtsp", "rtsps", "rtspu", "sip",
                 "sips", "mms", "sftp", "tel")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _strip_ws(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def url_path(url) -> Column:
    """The path part of a URL (no scheme, authority, query or fragment)."""
    return F.regexp_extract(_c(url), URL_PATH_PATTERN, 1)


def url_scheme(url) -> Column:
    """Lower-case scheme of a URL; empty when it has none."""
    return F.lower(F.regexp_extract(_c(url), URL_SCHEME_PATTERN, 1))


def url_file_name(url) -> Column:
    """Last path segment of a URL, no percent decoding; ``;params`` cut
    for the schemes that have them.  Null when empty or made only of blanks
    and dots."""
    last = F.substring_index(url_path(url), "/", -1)
    name = F.when(url_scheme(url).isin(*PARAM_SCHEMES), F.substring_index(last, ";", 1)).otherwise(last)
    return F.when(F.length(F.btrim(name, F.lit(URL_NAME_STRIP))) > 0, name)


def header_value(headers, name: str = "Content-Disposition") -> Column:
    """Value of one header line ``Name: value`` in header text (exact name).
    With several such lines the last one counts, as in a dict built from
    the lines."""
    v = F.regexp_extract(_c(headers), r"(?ms)\A.*^" + name + r":([^\r\n]*)", 1)
    return F.when(v != "", v)


def disposition_file_name(disposition) -> Column:
    """File name from a Content-Disposition value.

    Rules: no ``;`` -> null; the type must be inline or attachment (any
    case); exactly one ``filename=`` parameter (more, or none -> null); the
    value between the first and second ``=``, spaces, tabs and quotes
    stripped, directories cut; empty -> null.
    """
    parts = F.split(_c(disposition), ";")
    kind = F.lower(_strip_ws(F.try_element_at(parts, F.lit(1))))
    params = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(1)))
    fparts = F.filter(params, lambda x: F.startswith(_strip_ws(x), F.lit("filename=")))
    raw = F.split_part(F.try_element_at(fparts, F.lit(1)), F.lit("="), F.lit(2))
    name = F.substring_index(F.btrim(raw, F.lit(QUOTE_CHARS_STRIP)), "/", -1)
    ok = (F.size(parts) > 1) & kind.isin(*DISPOSITION_TYPES) & (F.size(fparts) == 1)
    return F.when(ok & (name != ""), name)


def header_file_name(headers) -> Column:
    """File name from header text (lines ``Name: value``)."""
    return disposition_file_name(header_value(headers))


def header_map_file_name(headers, name: str = "Content-Disposition") -> Column:
    """File name from a map of header names to values (exact name)."""
    return disposition_file_name(F.try_element_at(_c(headers), F.lit(name)))


def header_list_file_name(headers, name: str = "Content-Disposition") -> Column:
    """File name from a list of header lines ``Name: value``, as of the text
    made of those lines."""
    return header_file_name(F.array_join(_c(headers), "\n"))


def pick_file_name(out=None, header_name=None, url_name=None, default: str = DEFAULT_FILE_NAME) -> Column:
    """Precedence: explicit name, header name, URL name, default.  Empty
    strings count as missing."""
    cands = [F.nullif(_c(x), F.lit("")) for x in (out, header_name, url_name) if x is not None]
    return F.coalesce(*cands, F.lit(default))


def quote_path(path) -> Column:
    """Percent-quote a URL path, ``/`` kept: every byte other than letters,
    digits and ``_.-~`` becomes ``%XX`` (upper-case hex, UTF-8)."""
    enc = F.transform(F.split(_c(path), "/"), lambda s: F.url_encode(s))
    joined = F.array_join(enc, "/")
    # url_encode is form encoding: fix the three places it differs
    joined = F.replace(joined, F.lit("+"), F.lit("%20"))
    joined = F.replace(joined, F.lit("*"), F.lit("%2A"))
    return F.replace(joined, F.lit("%7E"), F.lit("~"))


def name_stem(name) -> Column:
    n = _c(name)
    return F.when(F.instr(n, ".") > 0, F.regexp_extract(n, r"^(.*)\.[^.]*$", 1)).otherwise(n)


def name_ext(name) -> Column:
    n = _c(name)
    return F.when(F.instr(n, ".") > 0, F.regexp_extract(n, r"\.([^.]*)$", 1))


def number_taken_names(
    df: DataFrame,
    name: str,
    order: Sequence[str],
    out: str = "final_name",
    existing: DataFrame | None = None,
    existing_name: str = "name",
) -> DataFrame:
    """Give every name that is already taken a `` (k)`` suffix on its stem.

    Taken: an earlier row (by ``order``) has the same name, or the name is
    in ``existing``.  ``k`` counts up per stem, any extension, starting after
    the largest ``stem (k)`` index already present (in ``existing`` or
    anywhere in ``df``), so a new name never equals an old one.  A name
    without a dot gets the suffix at the end.  A null name stays null.

    Skew-safe: first occurrences come from a grouped ``min`` (partial
    aggregation), and the numbering inside a stem is ``split_row_number``,
    so a stem shared by a third of all rows does not land in one task.
    """
    order = list(order)
    first_key = F.struct(*[F.col(o) for o in order])
    firsts = df.groupBy(name).agg(F.min(first_key).alias("_first"))
    marked = df.join(firsts, name, "left").withColumn(
        "_dup", F.col(name).isNotNull() & ~F.struct(*[F.col(o) for o in order]).eqNullSafe(F.col("_first"))
    )
    if existing is not None:
        ex = existing.select(F.col(existing_name).alias(name)).distinct().withColumn("_ex", F.lit(True))
        marked = marked.join(ex, name, "left")
        taken = F.col("_dup") | F.coalesce(F.col("_ex"), F.lit(False))
    else:
        taken = F.col("_dup")
    marked = marked.withColumn("_taken", F.coalesce(taken, F.lit(False))).drop("_first", "_dup", "_ex")

    # largest index already used on each stem
    names = df.select(F.col(name).alias("_n"))
    if existing is not None:
        names = names.unionByName(existing.select(F.col(existing_name).alias("_n")))
    numbered = names.select(F.regexp_extract(name_stem("_n"), r"^(.*) \(([0-9]+)\)$", 1).alias("_stem"),
                            F.regexp_extract(name_stem("_n"), r"^(.*) \(([0-9]+)\)$", 2).alias("_idx"))
    base = numbered.where(F.col("_idx") != "").groupBy("_stem").agg(F.max(F.col("_idx").try_cast("long")).alias("_base"))

    kept = marked.where(~F.col("_taken")).withColumn(out, F.col(name)).drop("_taken")
    clash = marked.where(F.col("_taken")).withColumn("_stem", name_stem(name)).withColumn("_ext", name_ext(name))
    clash = split_row_number(clash, ["_stem"], order, out="_k")
    clash = clash.join(base, "_stem", "left")
    idx = F.coalesce(F.col("_base"), F.lit(0)) + F.col("_k")
    new_name = F.concat(
        F.col("_stem"),
        F.lit(" ("),
        idx.cast("string"),
        F.lit(")"),
        F.when(F.col("_ext").isNotNull(), F.concat(F.lit("."), F.col("_ext"))).otherwise(F.lit("")),
    )
    clash = clash.withColumn(out, new_name).drop("_taken", "_stem", "_ext", "_k", "_base")
    return kept.unionByName(clash)

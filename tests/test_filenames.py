"""File-name functions on the hand-made cases of FIXTURES.md section 8."""

from pyspark.sql import functions as F

from monthwise.functions import filenames as fn


def one(spark, col, value):
    df = spark.createDataFrame([(value,)], "v string")
    return df.select(col(F.col("v"))).first()[0]


def test_disposition_cases(spark):
    cases = {
        'attachment; filename="a/b.parquet"': "b.parquet",
        "inline": None,
        "form; filename=x": None,
        "attachment; filename=a; filename=b": None,
        "attachment; size=1": None,
        "INLINE;filename=z.txt": "z.txt",
        'attachment; filename=" "': None,
    }
    for value, want in cases.items():
        assert one(spark, fn.disposition_file_name, value) == want, value


def test_header_text(spark):
    text = "Content-Type: x\r\nContent-Disposition: attachment; filename=q.csv\r\n"
    assert one(spark, fn.header_file_name, text) == "q.csv"
    assert one(spark, fn.header_file_name, "Content-Type: x") is None


def test_url_cases(spark):
    cases = {
        "https://h/x/y.parquet?z=1": "y.parquet",
        "https://h/x/": None,
        "https://h/a;v=1": "a",
        "https://h/..": None,
        "https://h/x/y.parquet#frag": "y.parquet",
        "relative/path/f.txt": "f.txt",
    }
    for value, want in cases.items():
        assert one(spark, fn.url_file_name, value) == want, value


def test_pick_precedence(spark):
    df = spark.createDataFrame([("", "h.txt", "u.txt"), (None, None, "u.txt"), ("o.txt", "h", "u"), (None, "", None)],
                               "o string, h string, u string")
    got = [r[0] for r in df.select(fn.pick_file_name("o", "h", "u")).collect()]
    assert got == ["h.txt", "u.txt", "o.txt", "download.wget"]


def test_quote_path(spark):
    from urllib.parse import quote

    paths = ["/a b/c*d~e/f+g", "/x/%41/é", "/plain/path/", "/", "", "/a//b"]
    for p in paths:
        assert one(spark, fn.quote_path, p) == quote(p), p


def test_numbered_names_in_order(spark):
    df = spark.createDataFrame([(1, "a.parquet"), (2, "a.csv"), (3, "a.parquet"), (4, "a.csv")], "k long, name string")
    out = {r.k: r.final_name for r in fn.number_taken_names(df, "name", ["k"]).collect()}
    assert out == {1: "a.parquet", 2: "a.csv", 3: "a (1).parquet", 4: "a (2).csv"}


def test_numbered_names_existing_and_no_dot(spark):
    df = spark.createDataFrame([(1, "a.parquet"), (2, "README"), (3, "README")], "k long, name string")
    existing = spark.createDataFrame([("a.parquet",), ("a (4).txt",)], "name string")
    out = {r.k: r.final_name for r in fn.number_taken_names(df, "name", ["k"], existing=existing).collect()}
    assert out == {1: "a (5).parquet", 2: "README", 3: "README (1)"}


def test_numbered_names_unique_for_hot_name(spark):
    n = 3000
    df = spark.range(n).select(F.col("id").alias("k"), F.lit("download.wget").alias("name"))
    out = fn.number_taken_names(df, "name", ["k"])
    assert out.select("final_name").distinct().count() == n
    got = {r.k: r.final_name for r in out.where(F.col("k") < 3).collect()}
    assert got == {0: "download.wget", 1: "download (1).wget", 2: "download (2).wget"}


def test_last_disposition_line_wins(spark):
    from monthwise.functions.filenames import header_file_name

    text = ("Content-Disposition: attachment; filename=first.csv\n"
            "X: y\nContent-Disposition: attachment; filename=\"d/last.csv\"\nZ: 1")
    df = spark.createDataFrame([(text,), ("X: y",)], "h string")
    assert [r[0] for r in df.select(header_file_name("h")).collect()] == ["last.csv", None]

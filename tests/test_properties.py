"""Property tests: the JVM-side URL name and path quoting against Python's
own ``urllib.parse`` on generated inputs (one Spark job per batch)."""

import os
import urllib.parse

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from monthwise.functions import filenames as fn

# no tab / CR / LF (urllib drops them anywhere in a URL), no brackets (IPv6
# netloc validation), no leading blanks (urllib strips those)
URL_CHARS = "abcXYZ019-._~:/?#;=&%+ *()'!@$,"
SCHEMES = st.sampled_from(["", "http:", "https://", "ftp://host", "s3a://bucket", "a+b.c-d:", "//host", "1x:"])
URLS = st.builds(
    lambda s, body: (s + body).lstrip(" "),
    SCHEMES,
    st.text(alphabet=URL_CHARS, max_size=40),
)


def python_url_name(url: str):
    """The rule: basename of urlparse's path (urlparse cuts ``;params`` for
    the schemes that have them); nothing if it is empty or only blanks and
    dots."""
    name = os.path.basename(urllib.parse.urlparse(url).path)
    return name if name.strip(" \n\t.") else None


SETTINGS = settings(max_examples=6, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(URLS, min_size=50, max_size=200))
def test_url_file_name_matches_urllib(spark, urls):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, url string")
    got = {r.i: r.n for r in df.select("i", fn.url_file_name("url").alias("n")).collect()}
    assert got == {i: python_url_name(u) for i, u in enumerate(urls)}


PATH_CHARS = st.characters(blacklist_categories=("Cs",), max_codepoint=0x1F600)


@SETTINGS
@given(st.lists(st.text(alphabet=PATH_CHARS, max_size=30), min_size=50, max_size=200))
def test_quote_path_matches_urllib_quote(spark, paths):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "i int, p string")
    got = {r.i: r.q for r in df.select("i", fn.quote_path("p").alias("q")).collect()}
    assert got == {i: urllib.parse.quote(p, safe="/") for i, p in enumerate(paths)}

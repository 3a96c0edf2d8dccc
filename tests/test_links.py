"""Listing links against the standard library's HTML parser."""

from html.parser import HTMLParser

import pyarrow.parquet as pq

from conftest import SF_SMALL
from tidemark.functions.text import listing_links


class Anchors(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found = []

    def handle_starttag(self, tag, attrs):
        target = dict(attrs).get("href") if tag == "a" else None
        if target and target[0] != "?" and target[-1] != "/":
            self.found.append(target.split("/")[-1])


def expected(html):
    parser = Anchors()
    parser.feed(html or "")
    parser.close()
    return parser.found


PAGES = [
    "<a href='single.txt'>s</a><A HREF=bare.csv>b</A><a\n  href\n=\n\"line\nbroken.txt\">",
    '<a data-href="wrong.txt" href="/pub/right.txt">r</a><a data-href="only.txt">o</a>',
    '<a href="first" href="last">twice</a><a href>none</a><a href="">empty</a><a>no</a>',
    '<!-- <a href="comment.txt"> --><script>var x = "<a href=\'script.txt\'>";</script><style><a href="style.txt"></style><a href="after.txt">',
    '<a title="a > b" href="quoted.txt"><a title=it\'s href="apostrophe.txt"><abbr href="abbr.txt"><area href="area.txt"><a/href="slash.txt">',
    '<a href="a&amp;b&#47;c&#x2e;d&quot;e&lt;&#x1F600;&unknown;"><a href="x&#38;#47;y"><a href="?C=N"><a href="dir/"><a href="/">',
    '<p>1 < 2 <a href="less.txt"></p><SCRIPT type="x"><a href="s"></SCRIPT ><a class=c  HREF = "spaces.txt" id=i>', "", None, "no markup", "<a href=\"open", "<!-- open <a href='x'>"]


def test_markup_cases(spark):
    df = spark.createDataFrame(list(enumerate(PAGES)), "page int, html string")
    got = {}
    for r in listing_links(df, keep=("page",)).collect():
        got.setdefault(r.page, []).append(r.file_name)
    assert {k: got.get(k, []) for k in range(len(PAGES))} == {k: expected(p) for k, p in enumerate(PAGES)}


def test_all_pages_of_the_table(spark):
    pages = pq.read_table(f"{SF_SMALL}/pages.parquet", columns=["page_id", "html"]).to_pylist()
    want = sorted((p["page_id"], f) for p in pages for f in expected(p["html"]))
    got = sorted(map(tuple, listing_links(spark.read.parquet(f"{SF_SMALL}/pages.parquet"), keep=("page_id",)).collect()))
    assert got == want and want


def test_a_tag_with_very_many_attributes_and_a_long_page(spark):
    html = "<a " + " ".join(f'k{i}="v"' for i in range(400)) + ' href="many.txt">' + "x < y & z " * 50_000 + '<a href="end.txt">'
    df = spark.createDataFrame([(html,)], "html string")
    assert [r.file_name for r in listing_links(df).collect()] == ["many.txt", "end.txt"]

"""Main text of web pages as a maximum-scoring subsequence of tokens.

A page is a sequence of words and tags. Words score positive and tags
negative; the content is the contiguous run with the largest sum, found in one
linear scan. Weights come from labelled pages, those that mark their content
with ``article`` or ``main``: the log-odds of a tag (with its class) and of a
word by the container it stands in, inside against outside the marked content.
A word's weight lies in [-4, 4] and is positive in containers not seen; a tag's
lies in [-4, -0.01], -1 if not seen. The fit takes the ``FIT_PAGES``
labelled pages with the lowest hashes of their id, equal rows once, and reads whole pages of any size in that order as long as
``FIT_BYTES`` hold; a page that does not fit in the rest is passed over.

Elements that are not article text may stand in the run, at next to no cost, and do not end it. Whole elements
of that kind are left out: menus, headers, footers, sidebars, forms, scripts, styles and the like by
their name, and adverts, notices, comments and others by words in their class or id. Block
elements separate blocks; references are decoded, white space in a block becomes
one space, and blocks are joined by one space in page order.

Defined cases: null or empty html, and pages without a word, give an empty text;
of equal runs the first is taken; unclosed tags and comments are read to the end
of the page; repeated rows give repeated rows; an empty table gives an empty
result; other columns are not looked at.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, table

FIT_PAGES = 2_000
FIT_BYTES = 32 << 20

# Element names of the HTML standard.
DROPPED = frozenset("nav header footer aside form script style noscript template button select textarea iframe svg object head title menu dialog".split())
RAW = frozenset("script style noscript template textarea title iframe".split())
CONTAINERS = frozenset("html head body article main section div nav header footer aside form table figure blockquote ul ol dl menu dialog title".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Words of a class or id that name what is not the article.
FOREIGN = re.compile(r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|promo|banner|notice|cookies?|consent|alert|comments?|disqus|replies|sidebar|side|aside|menu|nav|navbar|navigation|breadcrumbs?|header|masthead|footer|foot|social|share|sharing|related|recommended|newsletter|subscribe|signup|popup|modal|login|search|widget|pagination|pager|tags?|toc)(?:$|[\s_-])", re.I)
FOREIGN_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar alert dialog".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|[^<]+|<", re.S)
_NAMED = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_SPACE = re.compile(r"\s+")


def _names(attributes: str) -> tuple[str, bool]:
    """Class and id of a tag, and whether they or its role say that it is not article text."""
    if "=" not in attributes:
        return "", False
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _NAMED.finditer(attributes)}
    text = " ".join(found.get(k, "") for k in ("class", "id")).strip()
    return text.lower(), bool(FOREIGN.search(text)) or found.get("role", "").lower() in FOREIGN_ROLES


def tokens(page: str) -> list[tuple[str, str, str, bool]]:
    """(kind, feature, text, foreign) in page order; kind is text, open or close.

    ``feature`` is what a weight is kept for: a tag with its class, or the container of a word. ``foreign`` says that
    the token stands in an element that is not article text.
    """
    out: list[tuple[str, str, str, bool]] = []
    stack: list[tuple[str, str, bool]] = [("", "", False)]  # name, feature, foreign
    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.match(page, at)
        at = m.end()
        name = m[2]
        if name is None:
            if m[0][:2] in ("<!", "<?"):
                continue
            out.append(("text", "in:" + stack[-1][1], m[0], stack[-1][2]))
            continue
        name = name.lower()
        if m[1]:
            closed = stack[-1][2]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    closed = stack[k][2]
                    del stack[k:]
                    break
            out.append(("close", name, name, closed))
            continue
        label, strange = _names(m[3])
        feature = f"{name}.{label}" if label else name
        foreign = stack[-1][2] or strange or name in DROPPED
        out.append(("open", feature, name, foreign))
        if name in RAW and not m[3].endswith("/"):
            end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            at = end.end() if end else n
            out.append(("close", name, name, foreign))
        elif name in CONTAINERS or (strange and name not in VOID):
            stack.append((name, feature, foreign))
    return out


def marked(parsed: list[tuple[str, str, str, bool]]) -> tuple[int, int] | None:
    """The first and last token of the content that a page marks itself."""
    for name in ("article", "main"):
        opened = [i for i, t in enumerate(parsed) if t[0] == "open" and t[2] == name and not t[3]]
        closed = [i for i, t in enumerate(parsed) if t[0] == "close" and t[2] == name]
        if opened and closed and closed[-1] > opened[0]:
            return opened[0], closed[-1]
    return None


def count_features(pages: Iterator[str]) -> tuple[Counter, Counter]:
    """Occurrences of each feature inside and outside marked content."""
    inside, outside = Counter(), Counter()
    for page in pages:
        parsed = tokens(page)
        span = marked(parsed)
        if span is None:
            continue
        for i, (kind, feature, text, foreign) in enumerate(parsed):
            if foreign and kind == "text":
                continue  # foreign words have the lowest weight anyway
            n = len(text.split()) if kind == "text" else 1
            (inside if span[0] <= i <= span[1] else outside)[f"{kind}:{feature}"] += n
    return inside, outside


def learn_weights(inside: Counter, outside: Counter) -> dict[str, float]:
    out = {}
    for feature in inside.keys() | outside.keys():
        odds = math.log((inside[feature] + 0.5) / (outside[feature] + 0.5))
        out[feature] = max(-4.0, min(4.0, odds)) if feature.startswith("text:") else max(-4.0, min(-0.01, odds - 2.0))
    return out


def best_run(scores: list[float]) -> tuple[int, int]:
    """First and last place of the run with the largest positive sum, the first of equals; (0, -1) without one."""
    best, run, start, span = 0.0, 0.0, 0, (0, -1)
    for i, s in enumerate(scores):
        if run <= 0:
            run, start = 0.0, i
        run += s
        if run > best:
            best, span = run, (start, i)
    return span


def extract(page: str, weights: dict[str, float]) -> str:
    parsed = tokens(page)
    scores = []
    for kind, feature, text, foreign in parsed:
        if foreign:  # left out in any case, wherever the run ends
            scores.append(-0.01)
        elif kind == "text":
            scores.append(len(text.split()) * weights.get(f"text:{feature}", 1.0))
        else:
            scores.append(weights.get(f"{kind}:{feature}", -1.0))
    first, last = best_run(scores)
    # A block that the run begins or ends in is taken whole.
    while first > 0 and parsed[first - 1][0] == "text" and not parsed[first - 1][3]:
        first -= 1
    parts = []
    for kind, _, text, foreign in parsed[first : last + 1]:
        if kind == "text":
            if not foreign:
                parts.append(html.unescape(text))
        elif text not in INLINE:
            parts.append("\n")
    return _SPACE.sub(" ", "".join(parts)).strip()


def fit(pages: DataFrame) -> dict[str, float]:
    """Weights from a bounded sample of labelled pages; the driver sees hashes and sizes of ``FIT_PAGES`` pages at most."""
    spark = pages.sparkSession
    bounded_batches(spark, 256)
    keyed = pages.select("html", F.xxhash64(F.col("page_id").cast("string")).alias("order"))
    content, size = F.xxhash64("html").alias("content"), F.octet_length("html").alias("size")
    labelled = keyed.where(F.lower("html").rlike(r"<(article|main)[\s>]")).where(F.octet_length("html") <= FIT_BYTES)
    # The sample: lowest hashes of the id, whole pages; one that does not fit in the rest of the byte bound is passed over.
    total, taken = 0, []
    for r in labelled.select("order", content, size).distinct().orderBy("order", "content").limit(FIT_PAGES).collect():
        if total + r["size"] <= FIT_BYTES:
            total += r["size"]
            taken.append((r["order"], r["content"]))
    chosen = F.broadcast(spark.createDataFrame(taken, "order long, content long"))
    # Contents are hashed only for pages with a chosen id; of equal rows one is read.
    near = keyed.join(chosen.select("order").distinct(), "order", "left_semi").withColumn("content", content)
    ids = near.join(chosen, ["order", "content"], "left_semi").dropDuplicates(["order", "content"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, outside = count_features(p for b in batches for p in b.column(0).to_pylist())
        names = sorted(inside.keys() | outside.keys())
        yield pa.RecordBatch.from_pydict({"feature": pa.array(names, pa.string()), "inside": pa.array([inside[k] for k in names], pa.int64()), "outside": pa.array([outside[k] for k in names], pa.int64())})

    counted = ids.select("html").mapInArrow(count, "feature string, inside long, outside long")
    rows = counted.groupBy("feature").agg(F.sum("inside"), F.sum("outside")).collect()  # from FIT_PAGES pages
    return learn_weights(Counter({r[0]: r[1] for r in rows}), Counter({r[0]: r[2] for r in rows}))


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every page."""
    weights = fit(pages)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [extract(p or "", weights) for p in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_pydict({"page_id": b.column(0), "url": b.column(1), "text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())})

    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return slim.mapInArrow(rows, "page_id long, url string, text string, n_chars long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


ORACLE = r"""
WITH a AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*)</article>', 1, 's') AS body FROM pages),
b AS (SELECT page_id, url, regexp_replace(regexp_replace(body, '</?(b|i|em|strong|a|span)( [^>]*)?>', '', 'g'), '<[^>]*>', ' ', 'g') AS t FROM a),
d AS (SELECT page_id, url, replace(replace(replace(replace(replace(regexp_replace(t, '&amp([^;]|$)', '&amp;\1', 'g'),
        '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&') AS t FROM b),
e AS (SELECT page_id, url, trim(regexp_replace(t, '\s+', ' ', 'g')) AS text FROM d)
SELECT page_id, url, text, length(text) AS n_chars FROM e
"""

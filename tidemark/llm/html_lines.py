"""Main text of web pages by the distribution of text over lines.

Markup is stripped: parts that never hold an article (scripts, styles, forms, menus,
page headers and footers, sidebars, notices, adverts, reader comments) go with
their elements, every other block element ends a line. Text lengths are summed over
windows of ``window`` lines. A surge point is where a window passes the surge
threshold and the next ones hold text; a dive point is where the windows fall
below the dive threshold. Text between surge and dive is kept. On a page without a
surge the window with the most text is the stretch.

Where the page marks an article (article or main), the stretches that reach into one
count, cut to the marked lines and joined where they lie in one article. A start moves
back while windows stay above the dive threshold, and both ends move on through lines
of the same article, ``reach`` at most: short paragraphs at the ends come in, far parts
of the mark without text do not. Without marks the stretch with the most text counts.

Markup is read once from left to right, in time linear in the page (``markup``).

Defined results: a null or blank page gives an empty text; markup that is cut off ends
with the page; a page of which the class names hide everything is read without
them; repeated rows give equal texts; very long pages are read whole.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .markup import closing, markup

# Elements whose content is no markup; they end with their own closing tag.
RAW = closing("script", "style", "noscript", "template", "textarea", "iframe", "svg", "title")
# Elements that end a line of text.
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary
table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that never hold an article's text.
CHROME = frozenset("nav footer aside form menu head button select dialog".split())
# The same by role, class or id, as whole parts of a name...
HINT = re.compile(
    r"(?:^|[_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|cookies?|consent|disqus|footer|masthead|menu|modal|nav|navbar|navigation"
    r"|newsletter|notice|popup|promo\w*|related|replies|share|sharing|sidebar|site-header|social|sponsor\w*|subscribe|toolbar|widget)(?:$|[_-])", re.I)
# ...but not where the name says that something else has such a part.
HOLDER = re.compile(r"^(?:with|without|has|have|no|not|hide|show|is)[_-]|[_-](?:wrap|wrapper|layout|container|page|content|open|closed|enabled|disabled|free)$", re.I)
ATTR = re.compile(r"\b(class|id|role|aria-label)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none", re.I)
ARTICLE = frozenset(("article", "main"))


def _is_chrome(tag: str, attrs: str, in_article: bool, hints: bool) -> bool:
    if tag in CHROME or tag == "header" and not in_article:
        return True
    if not attrs or tag in ("html", "body") or tag in ARTICLE:
        return False
    if HIDDEN.search(attrs):
        return True
    return hints and any(HINT.search(name) and not HOLDER.search(name) for _, v in ATTR.findall(attrs) for name in v.strip("\"'").split())


def text_lines(page: str, hints: bool = True) -> list[tuple[str, int]]:
    """Lines of text with the number of the article element they stand in (0: none)."""
    lines: list[tuple[str, int]] = []
    stack: list[tuple[str, bool, int]] = []  # element, whether it hides its text, article
    opened: Counter = Counter()
    buffer: list[str] = []
    article = seen = hidden = 0

    def end_line() -> None:
        if buffer:
            text = " ".join(_html.unescape("".join(buffer)).split())
            buffer.clear()
            if text:
                lines.append((text, article))

    for kind, tag, attrs in markup(page, RAW):
        if kind == "text":
            if not hidden:
                buffer.append(tag)
        elif kind == "gap":
            buffer.append(" ")
        elif kind == "close":
            if tag in BLOCKS:
                end_line()
            while opened[tag]:
                name, hides, before = stack.pop()
                opened[name] -= 1
                if name in BLOCKS:
                    end_line()
                hidden -= hides
                article = before
                if name == tag:
                    break
        else:
            if tag in BLOCKS:
                end_line()
                if stack and stack[-1][0] == "p":  # a block ends an open paragraph
                    _, hides, article = stack.pop()
                    opened["p"] -= 1
                    hidden -= hides
            elif tag == "br":
                buffer.append(" ")
            if tag in VOID or attrs.endswith("/"):
                continue
            hides = _is_chrome(tag, attrs, article > 0, hints)
            stack.append((tag, hides, article))
            opened[tag] += 1
            hidden += hides
            if tag in ARTICLE and not hidden and not article:
                seen += 1
                article = seen
    end_line()
    return lines


def surges(lengths: list[int], window: int, surge: int, dive: int) -> list[tuple[int, int]]:
    """Line ranges between a surge point and the next dive point."""
    n = len(lengths)
    sums = [sum(lengths[i:i + window]) for i in range(n)]
    out, i = [], 0
    while i < n:
        if sums[i] >= surge and (i + 1 >= n or sums[i + 1] > 0):
            j = i
            while j < n and sums[j] > dive:
                j += 1
            # The window that fell below starts at j; the one before may reach past it.
            out.append((i, j))
            i = j
        i += 1
    return out


def stretches(lengths: list[int], window: int, surge: int, dive: int) -> list[tuple[int, int]]:
    """The ranges of ``surges``; without a surge the window with the most text."""
    out, n = surges(lengths, window, surge, dive), len(lengths)
    if not out and n:
        i = max(range(n), key=lambda k: (sum(lengths[k:k + window]), -k))
        out.append((i, min(n, i + window)))
    return out


def main_text(page: str | None, window: int = 3, surge: int = 86, dive: int = 20, reach: int = 6) -> str:
    """The article's blocks, two newlines between."""
    if not page:
        return ""
    lines = text_lines(page) or text_lines(page, hints=False)
    sizes = [len(t) for t, _ in lines]
    marked = [i for i, (_, article) in enumerate(lines) if article]
    kept: set[int] = set()
    if marked:
        runs = _marked_runs(lines, surges(sizes, window, surge, dive))
        if not runs:  # no surge reaches into an article: the distribution of the marked lines alone
            lines, sizes = [lines[i] for i in marked], [sizes[i] for i in marked]
            runs = stretches(sizes, window, surge, dive)
        for a, b in runs:
            kept.update(range(a, b))
            # windows before the surge that are above the dive already belong to its rise
            while a > 0 and lines[a - 1][1] == lines[a][1] and sum(sizes[a - 1:a - 1 + window]) > dive:
                a -= 1
            lo, hi = a, b
            while a > 0 and lo - a < reach and lines[a - 1][1] == lines[lo][1]:
                a -= 1
            while b < len(lines) and b - hi < reach and lines[b][1] == lines[hi - 1][1]:
                b += 1
            kept.update(range(a, b))
    elif lines:
        a, b = max(stretches(sizes, window, surge, dive), key=lambda s: (sum(sizes[s[0]:s[1]]), -s[0]), default=(0, 0))
        while a < b - 1 and sizes[a] <= dive:  # lines before the surge that its window reached ahead over
            a += 1
        kept.update(range(a, b))
    return "\n\n".join(lines[i][0] for i in sorted(kept))


def _marked_runs(lines: list[tuple[str, int]], found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The stretches that reach into articles, from their first to their last marked
    line; what lies between two stretches of one article belongs to both."""
    out: list[tuple[int, int]] = []
    for a, b in found:
        inside = [i for i in range(a, b) if lines[i][1]]
        if inside and out and lines[out[-1][1] - 1][1] == lines[inside[0]][1]:
            out[-1] = (out[-1][0], inside[-1] + 1)
        elif inside:
            out.append((inside[0], inside[-1] + 1))
    return out


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ("url",),
            window: int = 3, surge: int = 86, dive: int = 20, reach: int = 6) -> DataFrame:
    """Per page: id, the ``keep`` columns, text, n_chars (code points of the text)."""
    src = pages.select(id_col, *keep, F.col(html_col).cast("string").alias("__html"))
    schema = T.StructType([*src.schema.fields[:-1], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 512):
                b = whole.slice(i, 512)
                texts = [main_text(h.as_py(), window, surge, dive, reach) for h in b.column(b.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([
                    *b.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=names)

    return src.mapInArrow(run, schema)

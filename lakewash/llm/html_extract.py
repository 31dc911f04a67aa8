"""Main text of web pages from parser events and text-to-tag ratios.

The standard library's streaming parser gives the page's blocks: runs of text
between block-level tags, in page order, each with the number of inline tags
inside. A block is one line of the method:

1. lines under boilerplate elements (menus, headers, footers, sidebars,
   notices, adverts, forms, scripts, comments by readers) are out;
2. each other line has the ratio of its text to its tags, smoothed along the
   page with a Gaussian;
3. lines are clustered by a threshold, the deviation of the smoothed ratios:
   those above it are content lines;
4. content regions: an article or main element that holds content lines (or,
   on a page without one, the span of the content lines) gives all its lines,
   so a short paragraph between long ones stays.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewash.llm.common import only, table

# HTML element names by role, and names that mark boilerplate.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section "
    "summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset(
    "aside audio button canvas datalist dialog embed footer form head iframe input map menu nav noscript object "
    "option script select style svg template textarea video".split())
CONTAINERS = frozenset(("article", "main"))
MARKS = frozenset(
    "ad ads adsense advert advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies "
    "disclaimer disqus footer header masthead menu modal nav navbar navigation newsletter notice notices popup promo "
    "related respond share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split())
ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search".split())
# Elements that another one of a kind ends, up to the element around them.
_CELL, _ROW = ("td", "th"), ("tr",)
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": _CELL + _ROW, "td": _CELL, "th": _CELL,
        "option": ("option",), "optgroup": ("option", "optgroup")}
AROUND = frozenset("ul ol menu dl table select".split())
_PART = re.compile(r"[^a-z0-9]+")
SIGMA = 1.0
#: Characters of a block that make a page whose text is all marked one with an article.
PROSE = 140


class _Blocks(HTMLParser):
    """Collects (text, inline tags, container number) of each block."""

    def __init__(self, marks: bool = True):
        super().__init__(convert_charrefs=True)
        self.marks = marks  # whether forms and names in class and id put an element out
        self.blocks: list[tuple[str, int, int]] = []
        self.open: list[tuple[str, bool, int]] = []  # tag, out, container
        self.parts: list[str] = []
        self.tags = 0
        self.containers = 0

    def _state(self) -> tuple[bool, int]:
        return self.open[-1][1:] if self.open else (False, 0)

    def cut(self) -> None:
        if self.parts:
            out, inside = self._state()
            text = " ".join("".join(self.parts).split())
            if text and not out:
                self.blocks.append((text, self.tags, inside))
            self.parts = []
        self.tags = 0

    def imply_ends(self, tag) -> None:
        """Ends what ``tag`` ends without an end tag: a paragraph by any block,
        an item, a cell or an option by the next one of its list or table."""
        if tag in BLOCKS and self.open and self.open[-1][0] == "p":
            self.handle_endtag("p")
        for i in range(len(self.open) - 1, -1, -1) if tag in ENDS else ():
            name = self.open[i][0]
            if name in AROUND:
                break
            if name in ENDS[tag]:
                self.handle_endtag(name)
                if name != "td" and name != "th":
                    break

    def handle_starttag(self, tag, attrs):
        self.imply_ends(tag)
        if tag in BLOCKS:
            self.cut()
        elif tag == "br":
            self.parts.append(" ")
        self.tags += 1
        if tag in VOID:
            return
        out, inside = self._state()
        if not out:
            out = tag in SKIPPED and (self.marks or tag != "form") or (tag == "header" and not inside)
            for name, value in attrs if not out else ():
                value = (value or "").lower()
                if name in ("class", "id"):
                    out = out or self.marks and tag not in ("html", "body") and not MARKS.isdisjoint(_PART.split(value))
                elif name == "role":
                    out = out or value in ROLES
                elif name == "hidden" or name == "aria-hidden" and value == "true":
                    out = True
                elif name == "style":
                    out = out or "display:none" in value.replace(" ", "")
            if out:
                self.cut()  # what came before belongs to the block outside
            elif tag in CONTAINERS and not inside:
                self.containers += 1
                inside = self.containers
        self.open.append((tag, out, inside))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.cut()
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                if self.open[-1][1]:
                    self.parts = []
                if self.open[i][2] != self._outer(i):
                    self.cut()
                del self.open[i:]
                break

    def _outer(self, i: int) -> int:
        return self.open[i - 1][2] if i else 0

    def handle_data(self, data):
        if not (self.open and self.open[-1][1]):
            self.parts.append(data)

    def finish(self) -> list[tuple[str, int, int]]:
        self.close()
        self.cut()
        return self.blocks


def _smoothed(ratios: list[float]) -> list[float]:
    radius = max(1, math.ceil(2 * SIGMA))
    kernel = [math.exp(-(k / SIGMA) ** 2 / 2) for k in range(-radius, radius + 1)]
    out = []
    for i in range(len(ratios)):
        lo, hi = max(0, i - radius), min(len(ratios), i + radius + 1)
        used = kernel[lo - i + radius:hi - i + radius]
        out.append(sum(k * x for k, x in zip(used, ratios[lo:hi])) / sum(used))
    return out


def main_text(html: str | None) -> str:
    """The page's main text: blocks joined by two line breaks."""
    if not html:
        return ""
    blocks: list[tuple[str, int, int]] = []
    for marks in (True, False):
        if not blocks:
            parser = _Blocks(marks)
            parser.feed(html)
            blocks = parser.finish()
            if not marks and max((len(text) for text, _, _ in blocks), default=0) < PROSE:
                blocks = []  # an advert or a notice alone
    if not blocks:
        return ""
    ratios = _smoothed([len(text) / max(1, tags) for text, tags, _ in blocks])
    mean = sum(ratios) / len(ratios)
    deviation = math.sqrt(sum((x - mean) ** 2 for x in ratios) / len(ratios))
    content = [x >= min(deviation, mean) for x in ratios]
    regions = {inside for (_, _, inside), yes in zip(blocks, content) if yes and inside}
    if regions:
        chosen = [text for text, _, inside in blocks if inside in regions]
    else:
        at = [i for i, yes in enumerate(content) if yes]
        chosen = [text for text, _, _ in blocks[at[0]:at[-1] + 1]]
    return "\n\n".join(chosen)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages``, from the
    whole html.

    Edge cases: a null or empty html, or one without a content line, has an
    empty text of 0 characters. Unclosed and unmatched tags are read as
    browsers do for blocks: an open element ends with the one around it, a
    paragraph with the next block, an item, cell or option with the next one.
    Where forms and names in class and id put out all text of a page, and a block
    of it has ``PROSE`` characters, they are its layout, and the elements alone decide. A very long page is read whole.
    Null ids and urls are kept; repeated rows are repeated; an empty table
    gives no rows; extra columns are ignored.
    """
    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py()) for h in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = only(pages, "page_id", "url", "html").select(F.col("page_id").cast("long"), "url", "html")
    return rows.mapInArrow(per_batch, "page_id long, url string, text string, n_chars long")


def op8_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))

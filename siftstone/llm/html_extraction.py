"""Main text of web pages: parser events, text-to-tag ratio per line, Gaussian smoothing and threshold clustering."""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftstone.llm.state import released
from siftstone.runtime import table

BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
REGIONS = frozenset("article main section div td body html blockquote".split())
DROPPED = frozenset("head title script style noscript template iframe object embed applet canvas svg math nav menu footer aside form fieldset button select option textarea input dialog".split())
GROUPS = ((" block", BLOCKS), (" barrier", REGIONS | {"ul", "ol", "dl", "table", "tbody"}))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Words of class, id or role that mark what is not the article.
NOT_MAIN = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|sidebar|side-bar|menu|nav|navbar|navigation|breadcrumbs?|footer|masthead|cookie\w*|consent|gdpr|notice|alert|popup|modal|overlay|newsletter|subscribe|signup|login|search|share|sharing|social|related|recommend\w*|comments?|disqus|replies|respond|contentinfo|complementary|pagination|pager|toolbar|widget|skip-link)(?:$|[\s_-])",
    re.I,
)


@dataclass
class Line:
    region: int
    text: list[str] = field(default_factory=list)
    tags: int = 0
    linked: int = 0


class Events(HTMLParser):
    """Lines (runs of text between block boundaries) with their number of tags, linked characters and enclosing region.

    Linear in the page, however broken: places of open elements are kept by tag, so no end tag searches them, and what a page leaves
    unfinished (a quote, a comment, a tag at its end) is searched for once.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, int]] = []  # tag, dropped, region
        self.at: dict[str, list[int]] = defaultdict(list)  # places in open by tag; of all blocks; of all barriers
        self.lines: list[Line] = []
        self.marked = [0]  # of each region, the outermost article or main around it, else 0
        self.links = 0
        self.line = Line(0)
        self.loose = self.unended = False

    def read(self, html: str) -> None:
        """The whole page. A tag that the page's end cuts off is no text."""
        cut = html.rfind(">") + 1
        self.rawdata = html[:cut]
        self.goahead(True)
        if not self.cdata_elem:
            self.handle_data(unescape(re.split("<[a-zA-Z/!?]", html[cut:], maxsplit=1)[0]))
        self.flush()

    def updatepos(self, i: int, j: int) -> int:
        """Line numbers are not needed."""
        return j

    def check_for_whole_start_tag(self, i: int) -> int:
        if not self.loose:
            k = super().check_for_whole_start_tag(i)
            if k >= 0:
                return k
            self.loose = True  # a quote that never ends: from here on a tag ends at the next >
        return self.rawdata.index(">", i) + 1

    def parse_starttag(self, i: int) -> int:
        k = self.check_for_whole_start_tag(i)
        if not self.loose and self.rawdata[k - 1] == ">":
            return super().parse_starttag(i)
        self.handle_starttag(re.compile("[^\\s/>]+").match(self.rawdata, i + 1).group().lower(), [])
        return self.rawdata.index(">", k - 1) + 1

    def parse_comment(self, i: int, report: int = 1) -> int:
        k = -1 if self.unended else super().parse_comment(i)
        self.unended |= k < 0
        return k if k >= 0 else self.parse_bogus_comment(i)

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        return self.parse_bogus_comment(i)

    def flush(self) -> None:
        line = self.line
        region = self.open[-1][2] if self.open else 0
        if not line.text:
            line.tags, line.linked, line.region = 0, 0, region
            return
        if not all(map(str.isspace, line.text)):
            self.lines.append(line)
        self.line = Line(region)

    def last(self, tag: str) -> int:
        return self.at[tag][-1] if self.at[tag] else -1

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.flush()
            if tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option"):
                self.imply_end(tag)
        self.line.tags += 1
        if tag == "br":
            self.line.text.append(" ")
        if tag in VOID:
            return
        dropped, region = self.open[-1][1:] if self.open else (False, 0)
        if not dropped:
            dropped = tag in DROPPED or (tag == "header" and not self.at["article"] and not self.at["main"]) or (bool(attrs) and self.off_topic(tag, attrs))
        if tag in REGIONS and not dropped:
            self.marked.append(self.marked[region] or (len(self.marked) if tag in ("article", "main") else 0))
            region = len(self.marked) - 1
        for name in (tag, *(n for n, tags in GROUPS if tag in tags)):
            self.at[name].append(len(self.open))
        self.open.append((tag, dropped, region))
        self.links += tag == "a"
        if tag in BLOCKS:
            self.line.region = region

    def off_topic(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        named = " ".join(v for k, v in attrs if v and k in ("class", "id", "role"))
        if any(k == "hidden" or (k == "aria-hidden" and v == "true") or (k == "style" and v and re.search(r"display\s*:\s*none", v)) for k, v in attrs):
            return True
        if tag == "article":
            return bool(re.search(r"comment|reply", named, re.I))
        return bool(named) and tag not in ("html", "body", "main") and bool(NOT_MAIN.search(named))

    def imply_end(self, tag: str) -> None:
        """A new p, li and so on ends an open one of its kind, unless a region or list began in between."""
        k = self.last(tag)
        if k >= 0 and k >= self.last(" barrier") and not (tag in ("td", "th") and k < self.last("tr")):
            self.end_from(k)

    def end_from(self, k: int) -> None:
        """Ends what is open from k on; inline elements that a block's end cuts off end with it."""
        for tag, *_ in self.open[k:]:
            self.links -= tag == "a"
            for name in (tag, *(n for n, tags in GROUPS if tag in tags)):
                self.at[name].pop()
        del self.open[k:]

    def handle_endtag(self, tag: str) -> None:
        block = tag in BLOCKS
        if block:
            self.flush()
        self.line.tags += 1
        k = self.last(tag)
        if k >= 0 and (block or k > self.last(" block")):
            self.end_from(k)
        if block:
            self.line.region = self.open[-1][2] if self.open else 0

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_data(self, data: str) -> None:
        if not (self.open and self.open[-1][1]):
            self.line.text.append(data)
            self.line.linked += len(data.strip()) if self.links else 0


def kernel_of(sigma: float) -> list[float]:
    reach = max(1, math.ceil(3 * sigma))
    return [math.exp(-(k * k) / (2 * sigma * sigma)) for k in range(-reach, reach + 1)]


def smoothed(values: list[float], sigma: float) -> list[float]:
    kernel = kernel_of(sigma)
    reach = len(kernel) // 2
    out = []
    for at in range(len(values)):
        near = [(kernel[k + reach], values[at + k]) for k in range(-reach, reach + 1) if 0 <= at + k < len(values)]
        out.append(sum(w * v for w, v in near) / sum(w for w, _ in near))
    return out


def main_text(html: str | None, sigma: float = 1.0, share: float = 0.5, prior: float = 1.0) -> str:
    """Blocks of the content regions in page order, joined by an empty line; '' if there are none.

    Lines inside menus, footers, forms, adverts and the like (by element, class, id or role) never count. Of the others, the ratio
    of unlinked text to tags, smoothed over the neighbours, is clustered by a threshold, `share` of its standard deviation. Regions with a line above it that has text outside links
    are content and keep all their lines, short ones too. The outermost article or main around a line is its region. Such marks are a prior only: if unmarked regions hold more than
    `prior` times the text above the threshold, they are content too (the marks were teasers); else what is unmarked goes. If no line is above it, all marked regions are content.
    """
    if not html:
        return ""
    events = Events()
    events.read(html)
    lines = events.lines
    if not lines:
        return ""
    marked = [events.marked[x.region] for x in lines]
    text = ["".join(x.text) for x in lines]
    plain = [max(0, len(t.strip()) - x.linked) for t, x in zip(text, lines)]
    smooth = smoothed([n / (1 + x.tags) for n, x in zip(plain, lines)], sigma)
    mean = sum(smooth) / len(smooth)
    limit = share * math.sqrt(sum((v - mean) ** 2 for v in smooth) / len(smooth))
    group = [m or -x.region for m, x in zip(marked, lines)]
    above = [v >= limit and n > 0 for v, n in zip(smooth, plain)]
    chosen = {g for g, yes in zip(group, above) if yes}
    inside, outside = (sum(n for n, m, yes in zip(plain, marked, above) if yes and bool(m) == side) for side in (True, False))
    if inside and outside <= prior * inside:
        chosen = {g for g in chosen if g > 0}
    blocks = [" ".join(t.split()) for t, g in zip(text, group) if g in (chosen or {m for m in marked if m})]
    return "\n\n".join(b for b in blocks if b)


def extract(spark: SparkSession, pages: DataFrame, html: str = "html") -> DataFrame:
    """pages without html, with text and n_chars (code points); columns of these names are replaced.

    One narrow pass, no shuffle: every whole page goes through the standard library's parser as events. Null or empty html,
    and pages without content, have text ''. Broken markup is read as far as the parser gets, which is to the end.
    """
    rest = [c for c in pages.columns if c not in (html, "text", "n_chars")]

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([main_text(x.as_py()) for x in batch.column(0)], pa.string())
            yield pa.record_batch({c: batch.column(k + 1) for k, c in enumerate(rest)} | {"text": found})

    rows = pages.select(F.col(html).alias("__html"), *rest)
    return rows.mapInArrow(lambda b: released(texts(b)), pages.select(*rest).schema.add("text", "string")).withColumn("n_chars", F.length("text").cast("bigint"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark, table(spark, sf_dir, "pages").select("page_id", "url", "html"))

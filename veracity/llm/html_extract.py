"""Main-text extraction with host-consensus paths.

Pass 1 scores the section-level containers of each page (text of the blocks
below, without link text, halved for every level in between; lists, quotes and
tables are no level of their own) and gives one vote, weighted by the text held,
to the generalised tag-class path of the best one, or of the article or else
main element around it; votes are summed by host in Spark. Pass 2 re-extracts
every page from the containers that match the host's winning path; a page where
these hold less than ``SHARE`` of the text of its own best one uses that.

Only block structure counts: inline tags are passed over, an unclosed block
ends where the next begins, comments, scripts and styles are dropped, and
subtrees that are menus, headers outside an article, footers, sidebars,
notices, adverts, forms or reader comments (by tag, role, class or id) hold no
text. A class or id counts when one of its whole tokens names such a part
(``post-comments``, not ``no-sidebar`` or ``long-form``), and never on headings
and on headers inside an article; a page whose whole text lies in subtrees
dropped by class or id is read without regard to these. Character references are decoded, white space in a block (line breaks
too) becomes one space, blocks are joined by a blank line.

Scale: pages are read twice and never shuffled when the winners (one row a
host) are few enough for a checked broadcast; beyond ``HOSTS`` hosts they are
joined by key, where adaptive execution splits a hot host. A host's votes are
partially aggregated, so a host with a third of all pages is a few rows.

Defined cases: null html counts as empty and gives the empty text; a null or
unparsable url belongs to the host "" (which votes as any other); a page
without any container gives its loose text outside dropped subtrees; ties
between paths go to the smaller path; truncated markup is read as far as it
goes; repeated rows each give a row; further columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veracity.llm.shared import cut, small

HOSTS, SHARE = 200_000, 1 / 3
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<svg\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?<=/)>|<(script|style|noscript|template|textarea|svg|iframe)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1\s*>|\Z)"
                    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?][^>]*>|</?[a-zA-Z][^<>]*(?:>|\Z)", re.S | re.I)
_ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_SPACE = re.compile(r"\s+")

# Fixed values of the HTML standard: elements by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset("html body main article section div td th table tbody tr blockquote ul ol dl figure details center".split())
SECTIONS = frozenset("html body main article section div center".split())
BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre figcaption caption address summary hr".split())
DROPPED = frozenset("head nav footer aside form menu dialog button select option fieldset script style noscript "
                    "template textarea svg iframe object canvas audio video title".split())
#: Elements whose class or id never drops them.
NAMELESS = frozenset("html body article main h1 h2 h3 h4 h5 h6".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
#: Words that name a part that is not the article, and words that only place or shape such a part.
_PARTS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsors sponsored promo promos promotion promotions banner banners nav navbar "
    "navigation menu menus breadcrumb breadcrumbs sidebar sidebars side aside footer foot masthead header topbar cookie cookies consent gdpr notice "
    "notices alert alerts popup popups modal overlay newsletter subscribe subscription signup login share sharing social related recommended "
    "recommendation recommendations widget widgets pagination pager comment comments commentlist replies reply disqus respond tags toolbar skip "
    "copyright legal disclaimer form search".split())
_FILL = frozenset("site global primary secondary main top bottom box block list area wrap wrapper container section bar inner outer link links "
                  "button buttons icon icons item items unit slot media group thread posts articles".split())
#: A part of the article when they stand before a header or banner (entry-header), a part beside it before other words (post-comments).
_OWNERS = frozenset("post article entry page".split())
_TITLES = frozenset("header banner banners masthead".split())
_WORDS = re.compile(r"[-_]+")
_COUNT = re.compile(r"\d+(?:x\d+)?")


def _beside(token: str) -> bool:
    """Whether a whole class token or id names a part that is not the article; every word of it has to fit (no-sidebar does not)."""
    words = [w.rstrip("0123456789") for w in _WORDS.split(token) if w and not _COUNT.fullmatch(w)]
    if len(words) > 1 and words[0] in _OWNERS and not _TITLES & set(words):
        words = words[1:]
    return any(w in _PARTS for w in words) and all(w in _PARTS or w in _FILL for w in words)


def _name(tag: str, attributes: str) -> tuple[str, bool, bool]:
    """Generalised step of a path (tag with its sorted classes, digits folded), whether the subtree is dropped, and whether a class or id says so."""
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)} if "=" in attributes else {}
    classes = found.get("class", "").lower().split()
    dropped = tag in DROPPED or found.get("role", "").lower() in DROPPED_ROLES
    beside = tag not in NAMELESS and any(_beside(t) for t in [*classes, *found.get("id", "").lower().split()])
    return ".".join([tag, *sorted({re.sub(r"\d+", "#", c) for c in classes})]), dropped, beside


class Page:
    """Blocks of text with the containers they lie in."""

    def __init__(self, source: str):
        self._clear()
        if self._read(source, True) and not self.blocks:
            self._clear()
            self._read(source, False)  # all text lies in subtrees dropped by class or id: the last choice

    def _clear(self) -> None:
        self.paths: list[str] = ["", ]  # of each container; 0 is the page itself
        self.parents: list[int] = [-1]
        self.tags: list[str] = [""]
        self.blocks: list[tuple[int, str, int]] = []  # container, text, characters of it inside links

    def _read(self, source: str, named: bool) -> bool:
        """Reads the page; ``named``: classes and ids drop subtrees. Returns whether any did."""
        beside_any = False
        stack: list[list] = []  # open elements that are not inline: [tag, container or the one around, dropped]
        inside, dropped, links = 0, 0, 0
        parts: list[str] = []
        linked = 0

        def flush():
            nonlocal linked
            if parts:
                text = _SPACE.sub(" ", "".join(parts)).strip()
                if text:
                    self.blocks.append((inside, text, min(linked, len(text))))
                parts.clear()
            linked = 0

        def close(at: int):
            nonlocal inside, dropped
            while len(stack) > at:
                _, outer, gone = stack.pop()
                inside = outer
                dropped -= gone

        end = 0
        for m in _TOKEN.finditer(source):
            if m.start() > end and not dropped:
                text = html.unescape(source[end: m.start()])
                parts.append(text)
                if links:
                    linked += len(text)
            end = m.end()
            tag = m[3]
            if not tag:
                continue
            tag = tag.lower()
            if tag == "br":
                parts.append(" ")
                continue
            if tag == "a":
                links = max(0, links - 1) if m[2] else 1
                continue
            block, container = tag in BLOCKS, tag in CONTAINERS or tag in DROPPED or tag == "header"
            if not block and not container:
                continue
            flush()
            links = 0
            if m[2]:
                for at in range(len(stack) - 1, -1, -1):
                    if stack[at][0] == tag:
                        close(at)
                        break
                    if block and stack[at][0] in CONTAINERS:
                        break
                continue
            while stack and stack[-1][0] in BLOCKS and not (stack[-1][0] in ("li", "dd", "dt") and container):
                close(len(stack) - 1)  # an open paragraph or heading ends here
            if tag in VOID or m[4].endswith("/"):
                continue
            step, gone, beside = _name(tag, m[4])
            if tag == "header":
                beside = False
                gone = gone or not any(s[0] in ("article", "main") for s in stack)
            if beside and named and not gone:
                gone = beside_any = True
            stack.append([tag, inside, int(gone)])
            dropped += gone
            if tag in SECTIONS and not dropped:
                self.tags.append(tag)
                self.paths.append(f"{self.paths[inside]}>{step}" if self.paths[inside] else step)
                self.parents.append(inside)
                inside = len(self.paths) - 1
        if end < len(source) and not dropped:
            parts.append(html.unescape(source[end:]))
        flush()
        return beside_any

    def best(self) -> int:
        """The container with the highest score, or the article (else main) around it, as these hold nothing but the main text."""
        score = [0.0] * len(self.paths)
        for inside, text, linked in self.blocks:
            worth, at = float(len(text) - linked), inside
            while at >= 0 and worth >= 1:
                score[at] += worth
                at, worth = self.parents[at], worth / 2
        top = max(range(len(score)), key=lambda i: (score[i], -i))
        around = [top]
        while self.parents[around[-1]] >= 0:
            around.append(self.parents[around[-1]])
        for tag in ("article", "main"):
            for at in around:
                if self.tags[at] == tag:
                    return at
        return top

    def _held(self, chosen: set[int]) -> list[bool]:
        held = [i in chosen for i in range(len(self.paths))]
        for i in range(1, len(held)):
            held[i] = held[i] or held[self.parents[i]]
        return held

    def worth(self, chosen: set[int]) -> int:
        """Characters outside links inside any of the chosen containers."""
        held = self._held(chosen)
        return sum(len(t) - linked for inside, t, linked in self.blocks if held[inside])

    def text(self, chosen: set[int]) -> str:
        """Blocks inside any of the chosen containers, in page order."""
        held = self._held(chosen)
        return "\n\n".join(t for inside, t, _ in self.blocks if held[inside])


def _voter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small(batches):
        votes: dict[tuple[str, str], float] = {}
        for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            page = Page(source or "")
            top = page.best()
            worth = float(page.worth({top}))
            if worth > 0:
                key = (host, page.paths[top])
                votes[key] = votes.get(key, 0.0) + worth
        yield pa.record_batch([pa.array([k[0] for k in votes], pa.string()), pa.array([k[1] for k in votes], pa.string()),
                               pa.array(votes.values(), pa.float64())], names=["host", "path", "vote"])


def _extractor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small(batches):
        texts = []
        for source, path in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            page = Page(source or "")
            chosen, own = {i for i, p in enumerate(page.paths) if p == path} if path is not None else set(), {page.best()}
            fair = chosen and (chosen == own or page.worth(chosen) >= SHARE * page.worth(own))
            texts.append(fair and page.text(chosen) or page.text(own))
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                               pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def host_of(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1))


def winning_paths(pages: DataFrame) -> DataFrame:
    """host, path: the container path with the most weighted votes of each host."""
    votes = pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(_voter, "host string, path string, vote double")
    total = votes.groupBy("host", "path").agg(F.sum("vote").alias("vote"))
    return total.groupBy("host").agg(F.min(F.struct((-F.col("vote")).alias("v"), "path"))["path"].alias("path"))


def extract(pages: DataFrame, hosts: int = HOSTS) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    winners = cut(winning_paths(pages))
    own = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    few = winners.limit(hosts + 1).count() <= hosts
    joined = own.join(F.broadcast(winners) if few else winners, "host", "left").select("page_id", "url", "html", "path")
    schema = f"page_id {dict(own.dtypes)['page_id']}, url string, text string, n_chars long"
    return joined.mapInArrow(_extractor, schema)

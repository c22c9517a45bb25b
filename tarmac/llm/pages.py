"""Main text of web pages by paths that the pages of a host agree on.

Each page is parsed once and its containers (elements that hold blocks of text) are scored by text,
links and tag. A container passes half of its score to the one around it, through all of them. Each votes for the
generalised path of the main element it stands in: the nearest ``article``, else the nearest ``main``, else the outermost element around it
that has headings or paragraphs of its own. A path is the tags and classes from the root, with digits in classes made alike,
as a number that is hashed step by step. Votes are added up per host in Spark, in each task
first, so that a host with a third of all pages is a few rows per task. A second pass takes the
text under the first of the host's winning paths that a page has; a page with none of them
takes the path that it votes for most itself. What is around a page's best path gets no vote of it; other paths do with ``LEAST_OF_PAGE`` of its score, and win with
``LEAST_OF_HOST`` of a host's votes. Shares, not numbers of paths, decide at any size.

Menus, headers, footers, sidebars, notices, adverts, forms, comments
and everything that is not shown is left out, by tag, role, class and id. A header within an article or main element belongs to it.
A class that says that something is absent, or names the content too, counts for nothing (``no-sidebar``, ``content-form``). What
would be left out but holds more than half of the page's text and a sign of the main text (a title, an article, a content
element) is taken for a wrapper and stays, as does what the whole host votes for. Character
references are decoded, white space in a block becomes one blank, blocks are joined by
line breaks. Broken pages (unclosed or cut tags) are read as browsers do as far as blocks are concerned.

Nulls: a null page has an empty text; a null url is a host of its own. Pages are
parsed whole, in time and memory that grow with their length. Equal rows give equal results. An empty table gives an
empty result. Further columns pass through in ``row``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import column, packed, small_join, stored

# A quote opens a value only behind an equals sign, so that each has one reading; nothing is read twice.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>=]|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>"
    r"|<[!?][^>]*+(?:>|\Z)|</?[a-zA-Z][^>]*+(?:>|\Z)|</?\Z",
    re.S,
)
NAMES = re.compile(r"\b(class|id|role|style|hidden|aria-hidden)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)

# Tags, by what they mean for the text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
LEFT_OUT = frozenset(
    "head nav header footer aside form noscript template object svg canvas button select option label dialog menu "
    "audio video math map fieldset".split()
) | RAW
#: What may wrap a whole page all the same.
WRAPPERS = frozenset("header form fieldset label".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 "
    "h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Blocks that hold text themselves; what holds them is the container.
LEAVES = frozenset("p li dd dt pre blockquote figcaption summary ul ol dl td th tr tbody table".split()) | HEADINGS
TAG_WEIGHT = {"article": 3.0, "main": 2.0, "body": 0.5, "html": 0.25}
GOOD_NAMES = frozenset("article content post entry story main text body".split())
BAD_NAMES = frozenset(
    "ad ads advert advertisement advertising adsbox banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disclaimer disqus footer form header hidden login masthead menu modal nav navbar navigation newsletter notice "
    "notification pagination pager popup promo promotion related reply replies respond search share sharing sidebar "
    "signup social sponsor sponsored subscribe subscription toolbar widget".split()
)
#: A class with one of these says what a page lacks, has or how it is laid out.
NO_NAMES = frozenset("no not non has have with without free fixed sticky hide layout".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog form menu menubar".split())
NEVER_BAD = frozenset("html body main article".split())
SIGNS = frozenset("main article h1".split())
WORD_CUT = re.compile(r"[^a-zA-Z0-9]+|(?<=[a-z])(?=[A-Z])")
LEAST_OF_PAGE = 0.05
LEAST_OF_HOST = 0.02
VOTES = 1_000_000
STAYS, WRAPS, GOES = 0, 1, 2  # what becomes of an element: taken, left out unless it is a wrapper, left out


def meaning(tag: str, attributes: str) -> tuple[int, bool, bool, str]:
    """What becomes of an element, whether it is a sign of the main text, whether it is named as such, and its step of a path."""
    found = {k.lower(): v.strip("\"'") for k, v in NAMES.findall(attributes)} if attributes else {}
    classes = found.get("class", "").split()
    bad = good = False
    for name in [*classes, *found.get("id", "").split()]:
        words = {w.lower() for w in WORD_CUT.split(name)}
        named_bad, named_good = bool(words & BAD_NAMES), bool(words & GOOD_NAMES)
        if named_bad and not words & NO_NAMES:
            # The last word is the thing, those before it say of what: content-form is content, article-comments are comments.
            last = next((w.lower() for w in reversed(WORD_CUT.split(name)) if w.isalpha()), "")
            first = next((w.lower() for w in WORD_CUT.split(name) if w), "")
            bad |= not (named_good and first in ("content", "article", "entry", "post") and last in ("form", "widget", "header"))
        good |= named_good and not named_bad
    state = STAYS
    if tag in LEFT_OUT:
        state = WRAPS if tag in WRAPPERS else GOES
    elif tag not in NEVER_BAD and (bad or found.get("role", "").lower() in BAD_ROLES):
        state = WRAPS
    if tag not in NEVER_BAD and (
        "hidden" in found
        or found.get("aria-hidden", "").lower() == "true"
        or "display:none" in found.get("style", "").replace(" ", "").lower()
    ):
        state = GOES
    kinds = ".".join(re.sub(r"\d+", "0", c) for c in classes)
    return state, (tag in SIGNS or good) and not bad, good, f"{tag}.{kinds}" if kinds else tag


class Page:
    """Elements and blocks of a page. Parents come before their children."""

    def __init__(self, html: str, known: dict | None = None):
        self.known = {} if known is None else known  # meanings of tags and attributes met before
        self.parents, self.tags, self.keys = [0], [""], [0]
        self.state, self.signs, self.good = [STAYS], [False], [False]
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters in links
        self._parse(html)
        self._settle()

    def _parse(self, html: str) -> None:
        stack, runs, links, at, in_link = [0], [], 0, 0, 0
        open_tags: dict[str, int] = {}
        never_closed: set[str] = set()

        def flush() -> None:
            nonlocal links
            if runs:
                text = " ".join("".join(runs).split())
                if text:
                    self.blocks.append((stack[-1], text, links))
                runs.clear()
            links = 0

        def close(depth: int) -> None:
            while len(stack) > depth:
                open_tags[self.tags[stack.pop()]] -= 1

        end = len(html)
        while at < end:
            m = TOKEN.search(html, at)
            text = html[at : m.start() if m else end]
            if text:
                text = unescape(text) if "&" in text else text
                runs.append(text)
                links += len(text) if in_link else 0
            if not m:
                break
            at = m.end()
            closing, tag = m[1], m[2] and m[2].lower()
            if not tag:
                continue
            if closing:
                if tag == "a":
                    in_link = 0
                if open_tags.get(tag):
                    depth = len(stack) - 1
                    while self.tags[stack[depth]] != tag:
                        depth -= 1
                    flush()
                    close(depth)
                continue
            if tag == "br":
                runs.append(" ")
            elif tag == "a":
                in_link = 1
            if tag in RAW:
                found = None if tag in never_closed else re.compile(f"</{tag}[^>]*+>", re.I).search(html, at)
                if not found:
                    never_closed.add(tag)
                at = found.end() if found else end
                continue
            if tag not in BLOCKS and tag not in LEFT_OUT:
                if tag not in VOID and m[3] and tag not in never_closed and "display:none" in m[3].replace(" ", "").lower():
                    at = self._behind(html, at, tag, never_closed)
                continue
            flush()
            in_link = 0
            if tag in VOID:
                continue
            # A paragraph ends where a block begins, an item where the next one does.
            while len(stack) > 1 and (
                self.tags[stack[-1]] == "p" or self.tags[stack[-1]] in HEADINGS
                or (tag in ("li", "dd", "dt", "tr", "td", "th") and self.tags[stack[-1]] == tag)
            ):
                close(len(stack) - 1)
            stack.append(self._open(tag, m[3], stack[-1]))
            open_tags[tag] = open_tags.get(tag, 0) + 1
        flush()

    def _open(self, tag: str, attributes: str, parent: int) -> int:
        what = self.known.get((tag, attributes))
        if what is None:
            if len(self.known) > 50_000:
                self.known.clear()
            what = self.known[tag, attributes] = meaning(tag, attributes)
        state, sign, good, step = what
        self.parents.append(parent)
        self.tags.append(tag)
        self.state.append(state)
        self.signs.append(sign)
        self.good.append(good)
        digest = blake2b(f"{self.keys[parent]}/{step}".encode("utf-8", "surrogatepass"), digest_size=8).digest()
        self.keys.append(int.from_bytes(digest, "big", signed=True))
        return len(self.tags) - 1

    @staticmethod
    def _behind(html: str, at: int, tag: str, never_closed: set[str]) -> int:
        """The place behind an inline element that is not shown; where it is not closed it counts as shown."""
        depth, start = 1, at
        for m in re.compile(f"<(/?){tag}\\b[^>]*+>", re.I).finditer(html, at):
            depth += -1 if m[1] else 1
            if not depth:
                return m.end()
        never_closed.add(tag)
        return start

    def _settle(self) -> None:
        """What is left out, the container of each element, and the main element that it stands in."""
        n = len(self.tags)
        within = [False] * n  # in an article or main element
        self.containers = list(range(n))
        for e in range(1, n):
            parent = self.parents[e]
            within[e] = within[parent] or self.tags[e] in ("article", "main")
            if self.tags[e] == "header" and within[e]:
                self.state[e] = STAYS
            if self.tags[e] in LEAVES:
                self.containers[e] = self.containers[parent]
        text, signs = [0.0] * n, list(self.signs)
        for element, words, links in self.blocks:
            text[element] += max(0, len(words) - links)
        whole = sum(text)
        for e in range(n - 1, 0, -1):
            parent = self.parents[e]
            text[parent] += text[e]
            signs[parent] |= signs[e]
            if self.state[e] == WRAPS and signs[e] and 2 * text[e] > whole:
                self.state[e] = STAYS
        self.out = [False] * n
        for e in range(1, n):
            self.out[e] = self.out[self.parents[e]] or self.state[e] != STAYS

        self.own = [0.0] * n
        titled = [False] * n
        for element, words, links in self.blocks:
            if not self.out[element]:
                self.own[self.containers[element]] += max(0.0, len(words) - 2.0 * links)
                titled[self.containers[element]] |= self.tags[element] == "p" or self.tags[element] in HEADINGS
        self.main = list(range(n))
        article, main, top = [0] * n, [0] * n, [0] * n
        for e in range(1, n):
            parent = self.parents[e]
            article[e] = e if self.tags[e] == "article" else article[parent]
            main[e] = e if self.tags[e] == "main" else main[parent]
            top[e] = top[parent] or (e if titled[e] else 0)
            self.main[e] = article[e] or main[e] or top[e] or e

    def votes(self) -> dict[int, int]:
        """The shares of the page's score, in millionths, of the paths of main elements, highest first."""
        score = list(self.own)
        total: dict[int, float] = {}
        for e in range(len(score) - 1, -1, -1):
            if e:
                score[self.containers[self.parents[e]]] += score[e] / 2
            if score[e] > 0 and not self.out[e]:
                weight = TAG_WEIGHT.get(self.tags[e], 1.0) * (1.5 if self.good[e] else 1.0)
                key = self.keys[self.main[e]]
                total[key] = total.get(key, 0.0) + score[e] * weight
        if not total:
            return {}
        # What is around the best one gets no vote, or pages of many layouts would agree on their body.
        best = min(total, key=lambda key: (-total[key], key))
        around = {0}
        for e in range(len(score)):
            if self.keys[e] == best:
                up = self.parents[e]
                while up and up not in around:
                    around.add(up)
                    up = self.parents[up]
        for key in {self.keys[e] for e in around} - {best}:
            total.pop(key, None)
        whole = sum(total.values())
        # Whole numbers add up to the same in any order.
        shares = {key: round(VOTES * x / whole) for key, x in total.items() if x >= LEAST_OF_PAGE * whole}
        return dict(sorted(shares.items(), key=lambda x: (-x[1], x[0])))

    def text(self, keys: list[int]) -> str:
        """The blocks under the first of the paths that has any; of all blocks if none has."""
        n = len(self.tags)
        for key in keys:
            found = [e for e in range(n) if self.keys[e] == key]
            # What a host votes for is taken where it would be left out only if the page has it nowhere else.
            roots = set([e for e in found if not self.out[e]] or found)
            if not roots:
                continue
            taken = [False] * n
            for e in range(n):
                taken[e] = e in roots or (e > 0 and taken[self.parents[e]] and self.state[e] == STAYS)
            blocks = [text for element, text, _ in self.blocks if taken[element]]
            if blocks:
                return "\n".join(blocks)
        return "\n".join(text for element, text, _ in self.blocks if not self.out[element])


def hosts(url: str):
    """Host of a url in lower case; empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(column(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def votes(pages: DataFrame, url: str, html: str) -> DataFrame:
    """``host``, ``path`` and ``score`` of the main elements of each page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            total: dict[tuple[str, int], int] = {}
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                for path, score in Page(page or "", known).votes().items():
                    total[host, path] = total.get((host, path), 0) + score
            columns = [[host for host, _ in total], [path for _, path in total], list(total.values())]
            kinds = [pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["host", "path", "score"])

    return pages.select(hosts(url).alias("host"), column(html).alias("html")).mapInArrow(run, "host string, path long, score long")


def winning_paths(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``host`` and its winning ``paths``, best first: those with ``LEAST_OF_HOST`` of its votes or more."""
    total = stored(votes(pages, url, html).groupBy("host", "path").agg(F.sum("score").alias("score")))
    whole = total.groupBy("host").agg(F.sum("score").alias("whole"))
    best = total.join(whole, "host").where(F.col("score") >= LEAST_OF_HOST * F.col("whole"))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("order"), "path")))
    return best.groupBy("host").agg(F.transform(ranked, lambda x: x["path"]).alias("paths"))


def extracted(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``row`` (all columns) and the main ``text`` of every page."""
    winners = stored(winning_paths(pages, url, html))
    rows = pages.select(packed(pages), hosts(url).alias("host"), column(html).alias("html"))
    rows = small_join(rows, winners, ["host"], "left").select("row", "html", "paths")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict = {}
        for batch in batches:
            texts = []
            for html, paths in zip(batch.column("html").to_pylist(), batch.column("paths").to_pylist()):
                page = Page(html or "", known)
                texts.append(page.text([*(paths or []), *page.votes()]))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "text"])

    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, text string")

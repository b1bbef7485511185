"""HTML extraction by consensus host paths.

1. Every page is parsed into blocks of text, and its containers are scored by the text that sits
   in them (length, commas, few links).  The best container's generalised path - tags
   with their classes, digits masked - is the page's vote.  A path is a 64-bit hash, chained from the
   root down, so that deep pages cost no more than their elements.
2. Spark counts the votes per host and path.  Every page's own paths are joined with all counted
   votes of its host; the one with most votes wins.
3. Every page is read again and its winning path's elements give the main text.  A page none of whose
   paths has a vote falls back on its own best container.

Votes are counted before they move, and pages' paths join the counts (broadcast where their checked size
allows), so a host with a third of all pages costs as much as any other and may have any number of
templates.  Winners come back to pages by host and html hash.

Menus, footers, forms and elements named after such things (``SKIPPED``, ``SKIPPED_WORDS``) are left out.
A name that only mentions one (``has-sidebar``, ``header-content``) doesn't count, and an element that holds most of the
page's text where next to none is left outside (a form around the whole page) is not left out.

Defined cases: null and empty html give an empty text; a null or odd url has the host ""; pages of one host without
any container keep their own blocks; ties go to the first container of the page and to the smaller
path hash; repeated rows are extracted alike; text after a broken or open tag is kept as far as HTML
says; very long, very deep and badly nested pages take time in proportion to their length; an empty table gives an
empty result; columns besides the three named ones are ignored, whatever their names.
"""

from __future__ import annotations

import re
from hashlib import blake2b
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brook.operators.sizing import broadcast_if_bounded
from brook.session import materialize

#: HTML's element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp".split())
#: Elements and class words that don't belong to an article.
SKIPPED = frozenset("nav header footer aside form button select menu dialog head audio video canvas object".split())
SKIPPED_WORDS = frozenset(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer header masthead "
    "menu nav navbar navigation newsletter notice pagination popup promo promoted related share sharing sidebar signup social sponsor sponsored "
    "subscribe toolbar widget".split()
)
#: Words that turn a name with one of those into a mention, and last words of names of content.
MENTIONS = frozenset("has no not with without enabled disabled".split())
CONTENT = frozenset("content article post entry story body layout".split())
#: Elements that may hold a whole page after all.
MAY_HOLD_ALL = frozenset("form header".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:_-]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:_-]*)([^>]*)(?:>|\Z)""",
    re.S,
)
ATTRIBUTE = re.compile(r"""\b(class|id)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
WORDS = re.compile(r"[a-z]+")
DIGITS = re.compile(r"[0-9]+")


def is_skipped_name(names: list[str]) -> bool:
    """Whether one of an element's classes or ids names a part that is no article."""
    for name in names:
        words = WORDS.findall(name)
        if not SKIPPED_WORDS.isdisjoint(words) and MENTIONS.isdisjoint(words) and (words[-1] not in CONTENT):
            return True
    return False


class Page:
    """Elements (tag, parent, path, whether left out) and blocks of text (element, innermost element, text, characters of links) in page order."""

    def __init__(self, html: str | None):
        self.tags: list[str] = [""]
        self.parents: list[int] = [-1]
        self.paths: list[int] = [0]
        self.left_out: list[bool] = [False]  # by its own tag or name
        self.may_hold_all: list[bool] = [False]
        self.blocks: list[tuple[int, int, str, int]] = []
        self._parse(html or "")
        self._drop_left_out()

    def _parse(self, html: str) -> None:
        tags, left_out = self.tags, self.left_out
        stack, text, links, in_link, at, size = [0], [], 0, 0, 0, len(html)
        # places of blocks in the stack, and the open inline elements since each of them
        blocks_at, inline = [0], [{}]
        open_blocks: dict[str, int] = {}

        def flush() -> None:
            nonlocal links
            if text:
                body = " ".join(unescape("".join(text)).split())
                if body:
                    self.blocks.append((stack[blocks_at[-1]], stack[-1], body, min(links, len(body))))
                text.clear()
                links = 0

        def add(piece: str) -> None:
            nonlocal links
            if piece:
                text.append(piece)
                links += len(piece) if in_link else 0

        def close(depth: int) -> None:
            """Take the elements from place ``depth`` on off the stack."""
            if any(left_out[e] for e in stack[depth:]):
                flush()
            while len(stack) > depth:
                tag = tags[stack.pop()]
                if blocks_at[-1] == len(stack):
                    blocks_at.pop()
                    inline.pop()
                    open_blocks[tag] -= 1
                else:
                    inline[-1][tag] -= 1

        while at < size:
            m = TOKEN.search(html, at)
            if not m:
                add(html[at:])
                break
            add(html[at : m.start()])
            at = m.end()
            tag = (m[2] or m[5] or "").lower()
            if not tag:
                continue
            is_block = tag in BLOCK
            if m[1] or m[4]:  # an end tag
                if tag == "a":
                    in_link = max(0, in_link - 1)
                if is_block:
                    flush()
                # an inline element ends only inside its block
                if open_blocks.get(tag) if is_block else inline[-1].get(tag):
                    depth = len(stack) - 1
                    while tags[stack[depth]] != tag:
                        depth -= 1
                    close(depth)
                continue
            rest = m[3] if m[2] else m[6]
            if is_block:
                flush()
                if tag not in VOID:
                    # a block ends an open paragraph, an item the one before
                    closed = CLOSES.get(tag, set()) | {"p"}
                    if blocks_at[-1] and tags[stack[blocks_at[-1]]] in closed:
                        close(blocks_at[-1])
            if tag in VOID:
                continue
            if tag in RAW:
                end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(html, at)  # their content is not the page's text
                at = end.end() if end else size
                continue
            names = [x[1] or x[2] or x[3] for x in (y.groups("") for y in ATTRIBUTE.finditer(rest))] if "=" in rest else []
            names = sorted({w for x in names for w in x.lower().split()})
            by_name = bool(names) and tag not in ("html", "body") and is_skipped_name(names)
            out = tag in SKIPPED or by_name
            if out:
                flush()
            part = DIGITS.sub("#", tag + "." + ".".join(names)) if names else tag
            tags.append(tag)
            self.parents.append(stack[-1])
            chained = self.paths[stack[-1]].to_bytes(8, "little", signed=True) + part.encode("utf-8", "replace")
            self.paths.append(int.from_bytes(blake2b(chained, digest_size=8).digest(), "little", signed=True))
            left_out.append(out)
            self.may_hold_all.append(tag in MAY_HOLD_ALL or tag not in SKIPPED)
            if not rest.rstrip().endswith("/") or is_block:
                stack.append(len(tags) - 1)
                if is_block:
                    blocks_at.append(len(stack) - 1)
                    inline.append({})
                    open_blocks[tag] = open_blocks.get(tag, 0) + 1
                else:
                    inline[-1][tag] = inline[-1].get(tag, 0) + 1
                in_link += tag == "a"
        flush()

    def _drop_left_out(self) -> None:
        """Leave out the blocks of elements left out, but not those of one that holds most of the text with next to none outside."""
        n = len(self.tags)
        chars = [0] * n
        for _, leaf, text, _ in self.blocks:
            chars[leaf] += len(text)
        for e in range(n - 1, 0, -1):  # parents come before their children
            chars[self.parents[e]] += chars[e]
        for _ in range(n):
            out = self._inherited(self.left_out)
            kept = sum(len(text) for _, leaf, text, _ in self.blocks if not out[leaf])
            wrong = [
                e for e in range(1, n)
                if self.left_out[e] and self.may_hold_all[e] and not out[self.parents[e]] and 2 * chars[e] > chars[0] and 10 * kept < chars[e]
            ]
            if not wrong:
                break
            self.left_out[wrong[0]] = False
        self.blocks = [b for b in self.blocks if not out[b[1]]]

    def _inherited(self, marks: list[bool]) -> list[bool]:
        out = list(marks)
        for e in range(1, len(out)):
            out[e] = out[e] or out[self.parents[e]]
        return out

    def best_container(self) -> int:
        """The element whose paragraphs weigh most; 0 (the page) if there is no text."""
        score: dict[int, float] = {}
        links: dict[int, int] = {}
        chars: dict[int, int] = {}
        for element, _, text, linked in self.blocks:
            weight = 1 + text.count(",") + min(len(text) / 100, 3)
            holder = self.parents[element] if self.tags[element] in ("p", "pre", "blockquote", "li", "h1", "h2", "h3", "h4", "h5", "h6") else element
            for share in (1.0, 0.5):
                if holder < 0:
                    break
                score[holder] = score.get(holder, 0) + share * weight
                links[holder] = links.get(holder, 0) + linked
                chars[holder] = chars.get(holder, 0) + len(text)
                holder = self.parents[holder]
        return max(score, key=lambda e: (score[e] * (1 - links[e] / chars[e]), -e), default=0)

    def text_of(self, containers: set[int]) -> str:
        """Blocks inside any of the elements, in page order."""
        inside = self._inherited([e in containers for e in range(len(self.tags))])
        return "\n".join(text for e, _, text, _ in self.blocks if inside[e])

    def candidates(self) -> list[int]:
        """Distinct paths of the elements around the page's blocks."""
        seen: set[int] = set()
        for element, *_ in self.blocks:
            while element > 0 and element not in seen:
                seen.add(element)
                element = self.parents[element]
        return sorted({self.paths[e] for e in seen})

    def extract(self, path: int | None) -> str:
        """Main text by the elements of the path, else by the page's own best container."""
        held = {e for e in range(1, len(self.tags)) if self.paths[e] == path} if path is not None else set()
        return self.text_of(held or {self.best_container()})


def host_of(url: str):
    return F.lower(F.coalesce(F.regexp_extract(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def winning_paths(pages: DataFrame) -> DataFrame:
    """(host, h, path): for every html of a host (hash ``h``) its path with most votes; none where no path has any."""

    @F.pandas_udf("best long, paths array<long>")
    def ballot(pieces: pd.Series) -> pd.DataFrame:
        best, paths = [], []
        for h in pieces:
            page = Page(h)
            container = page.best_container()
            best.append(page.paths[container] if container else None)
            paths.append(page.candidates())
        return pd.DataFrame({"best": pd.array(best, dtype="Int64"), "paths": paths})

    ballots = materialize(pages.select("host", "h", ballot("html").alias("b")).select("host", "h", "b.best", "b.paths"), "ballots")
    votes = materialize(ballots.filter("best is not null").groupBy("host", F.col("best").alias("path")).agg(F.count(F.lit(1)).alias("n")), "votes")
    own = ballots.select("host", "h", F.explode("paths").alias("path"))
    # most votes first, then the smaller path; partial maxima before the shuffle
    rank = F.struct("n", (-F.col("path")).alias("tie"), "path")
    counted = own.join(broadcast_if_bounded(votes), ["host", "path"]).groupBy("host", "h").agg(F.max(rank).alias("top"))
    return materialize(counted.select("host", "h", F.col("top.path").alias("path")), "winners")


def extract_text(pages: DataFrame, html: str = "html", url: str = "url", page_id: str = "page_id") -> DataFrame:
    """(page_id, url, text) of every page."""
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"), host_of(url).alias("host"))
    rows = rows.withColumn("h", F.xxhash64("html"))
    rows = rows.join(broadcast_if_bounded(winning_paths(rows)), ["host", "h"], "left")

    @F.pandas_udf("string")
    def main_text(pieces: pd.Series, paths: pd.Series) -> pd.Series:
        return pd.Series([Page(h).extract(None if p is None else int(p)) for h, p in zip(pieces, paths, strict=True)], dtype=object)

    # the path as a string: a long that may be null would come as a float
    return rows.select("page_id", "url", main_text("html", F.col("path").cast("string")).alias("text"))

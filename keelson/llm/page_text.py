"""Main text of web pages by composite text density.

A page's elements are counted in one pass: characters, tags, link characters and link tags of every
subtree give its link-adjusted characters per tag. The sum of its children's densities tells how
much of a subtree is running text; the subtree with the largest sum is the main one, and the least
density on its path up to the body is the threshold that other parts of the page have to reach to
belong to it. Menus, adverts, forms, comments and the like, told by tag, role, class or heading, are
left out first and are no candidates."""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Fixed values of HTML: how tags are written, and which elements are empty, raw or blocks.
TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+'|)|["'])*+)>""")
ATTRIBUTE = re.compile(r"""(?<![\w-])(class|id|role|hidden|style|aria-hidden)(?![\w-])(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
VOID = set("area base br col embed frame hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe noembed noframes xmp".split())
UNSEEN = set("html head body".split())
CLOSES_P = set("address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 "
               "h3 h4 h5 h6 header hgroup li main menu nav ol p pre section summary table ul".split())
BLOCKS = CLOSES_P | set("br hr td th tr thead tbody tfoot caption option optgroup legend template".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
SCOPE = set("table td th caption button object template".split())
# An opening tag ends an open element of these names, unless one of the second list is in between.
ENDS = {"li": ("li", "ul ol menu dir"), "dd": ("dd dt", "dl"), "dt": ("dd dt", "dl"), "option": ("option", "select"),
        "optgroup": ("option optgroup", "select"), "td": ("td th", "table"), "th": ("td th", "table"),
        "tr": ("tr", "table"), "thead": ("thead tbody tfoot", "table"), "tbody": ("thead tbody tfoot", "table"),
        "tfoot": ("thead tbody tfoot", "table")}
ENDS = {k: (a.split(), b.split()) for k, (a, b) in ENDS.items()}

# What is not the article, by tag, by role and by the words of class and id.
LEFT_OUT = set("nav footer aside form dialog menu select button template object svg math canvas audio video map datalist".split())
ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar status".split())
COMMENTS = set("comment comments commentlist disqus respond reply replies responses discussion".split())
NAMES = COMMENTS | set("""ad ads adv advert adverts advertisement adsense adsbygoogle adslot sponsor sponsored promo promotion banner cookie cookies
consent gdpr sidebar nav navbar navigation menu breadcrumb breadcrumbs footer masthead topbar share sharing social related
recommended recommendations newsletter subscribe subscription signup popup modal overlay notice alert pagination pager widget
widgets toolbar login search copyright skip toc hidden teaser header""".split())
STARTS = ("cookie", "advert", "sponsor", "breadcrumb", "newsletter", "sidebar", "disqus", "paginat")
STOPS = ("nav", "menu", "sidebar", "footer", "banner", "popup", "modal", "advert")
# Class words that turn the next one off ("has-sidebar"), or a header into that of the article.
OFF, OWN_HEADER = {"has", "with", "no", "without", "non"}, {"entry", "post", "article", "story", "content", "title"}
OPENING = re.compile(r"(\d+\s+)?(reader comments?|comments?|responses?|replies|leave a (comment|reply)|related (articles?|posts?|stories)"
                     r"|you (may|might) also like|advertisement|sponsored|share this|newsletter|recommended for you|we use cookies"
                     r"|this (web)?site uses cookies)(\s*\(\d+\))?\W*", re.I)
# Parts of a page that hold more than this share of its text are not left out by name or form.
LARGE = 0.6


def name_words(value: str) -> list[str]:
    return [w.lower() for w in re.findall(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])", value)]


def named(value: str) -> str | None:
    """The first word of a class or id that names something beside the article."""
    found = name_words(value)
    for before, w in zip(["", *found], found):
        if before in OFF or (w == "header" and OWN_HEADER & set(found)):
            continue
        if w in NAMES or w.startswith(STARTS) or (w.endswith(STOPS) and w not in STOPS):
            return w
    return None


@dataclass
class Page:
    """Elements in page order (0 is the body) and the pieces of text between their tags."""

    tag: list[str] = field(default_factory=lambda: ["body"])
    parent: list[int] = field(default_factory=lambda: [-1])
    end: list[int] = field(default_factory=lambda: [0])           # one past the last element inside
    attributes: list[str] = field(default_factory=lambda: [""])
    pieces: list[tuple[int, bool, str]] = field(default_factory=list)  # (element, in a link, text); breaks have element -1

    def read(self, source: str) -> Page:
        """One pass over the source; elements end where HTML has them end without a closing tag."""
        stack, depth_of, pos, size, link = [0], {}, 0, len(source), -1

        def top(names) -> int:
            return max((depth_of[n][-1] for n in names if depth_of.get(n)), default=-1)

        def close(to: int) -> None:
            nonlocal link
            while len(stack) > to:
                node = stack.pop()
                depth_of[self.tag[node]].pop()
                self.end[node] = len(self.tag)
                if node == link:
                    link = -1

        while pos < size:
            at = source.find("<", pos)
            if at < 0:
                at = size
            if at > pos:
                text = source[pos:at]
                self.pieces.append((stack[-1], link >= 0, html.unescape(text) if "&" in text else text))
            pos = at
            if at == size:
                break
            if source.startswith("<!--", at):
                stop = source.find("-->", at + 2)
                pos = size if stop < 0 else stop + 3
                continue
            nxt = source[at + 1:at + 2]
            if nxt in ("!", "?") or (nxt == "/" and not source[at + 2:at + 3].isalpha()):
                stop = source.find(">", at)
                pos = size if stop < 0 else stop + 1
                continue
            if nxt != "/" and not (nxt.isascii() and nxt.isalpha()):
                self.pieces.append((stack[-1], link >= 0, "<"))
                pos = at + 1
                continue
            m = TAG.match(source, at)
            if not m:                                             # a tag that never ends holds the rest
                break
            closing, name, rest = m.group(1), m.group(2).lower(), m.group(3)
            pos = m.end()
            if name in BLOCKS:
                self.pieces.append((-1, False, " "))
            if name in UNSEEN:
                continue
            if closing:
                self._closing(name, top, close, depth_of)
                if name == "a":
                    link = -1
                continue
            if name in CLOSES_P and top(["p"]) > top(SCOPE):
                close(depth_of["p"][-1])
            if name in ENDS:
                ends, walls = ENDS[name]
                while (open_at := top(ends)) > top(walls):
                    close(open_at)
            if name in HEADINGS and self.tag[stack[-1]] in HEADINGS:
                close(len(stack) - 1)
            if name in VOID:
                continue
            node = len(self.tag)
            self.tag.append(name)
            self.parent.append(stack[-1])
            self.end.append(node + 1)
            self.attributes.append(rest)
            if name in RAW:                                       # never shown: only where it ends matters
                stop = re.compile(rf"</{name}(?=[\s/>])", re.I).search(source, pos)
                pos = size if not stop else stop.start()
                if stop:
                    past = source.find(">", pos)
                    pos = size if past < 0 else past + 1
                continue
            if name == "a":
                link = node
            depth_of.setdefault(name, []).append(len(stack))
            stack.append(node)
        while len(stack) > 1:
            close(len(stack) - 1)
        self.end[0] = len(self.tag)
        return self

    def _closing(self, name, top, close, depth_of) -> None:
        """An end tag closes the last open element of its name, unless a cell, or for marks within a
        line any block, has been opened since."""
        if not depth_of.get(name):
            return
        at = depth_of[name][-1]
        if name in BLOCKS:
            if name in SCOPE or name in ("tr", "tbody", "thead", "tfoot") or at > top(SCOPE):
                close(at)
        elif at > top(BLOCKS):
            close(at)

    # What follows works on whole subtrees: elements v to end[v] - 1.

    def up(self, own: list[float]) -> list[float]:
        """Sums over subtrees."""
        out = list(own)
        for v in range(len(out) - 1, 0, -1):
            out[self.parent[v]] += out[v]
        return out

    def main_text(self) -> str:
        n = len(self.tag)
        shown = [" ".join(t.split()) for _, _, t in self.pieces]
        plain, linked = [0] * n, [0] * n
        for (node, in_link, _), t in zip(self.pieces, shown):
            if node >= 0:
                plain[node] += len(t)
                linked[node] += len(t) if in_link else 0
        out = self._left_out(plain, shown)
        all_chars, all_linked = sum(plain), sum(linked)
        for v in range(n):
            if out[v]:
                plain[v] = linked[v] = 0
        chars, links = self.up(plain), self.up(linked)
        tags = self.up([0 if out[v] else 1 for v in range(n)])
        link_tags = self.up([1 if self.tag[v] == "a" and not out[v] else 0 for v in range(n)])
        density = [self._density(chars[v], links[v], tags[v], link_tags[v], all_linked / all_chars if all_chars else 0) for v in range(n)]
        sums = [0.0] * n
        for v in range(1, n):
            if not out[v]:
                sums[self.parent[v]] += density[v]
        root = self._root(out, sums, chars)
        best = max((v for v in range(root, self.end[root]) if not out[v]), key=lambda v: (sums[v], -v))
        path, v = [], best
        while v > 0:
            path.append(density[v])
            v = self.parent[v]
        threshold = min([*path, density[0]])
        kept = self._region(root, best, threshold, density, chars, links, link_tags, out)
        return " ".join("".join(t if node < 0 or kept[node] else "" for node, _, t in self.pieces).split())

    @staticmethod
    def _density(c: float, lc: float, t: float, lt: float, body: float) -> float:
        """Characters per tag, times the logarithm of how far the links fall short of them; its base
        grows with the share of links here and in the body."""
        if not c:
            return 0.0
        if not body:
            return c / max(t, 1)
        base = math.log(c * lc / max(c - lc, 1) + body * c + math.e)
        return c / max(t, 1) * math.log(max(c / max(lc, 1) * max(t, 1) / max(lt, 1), 1)) / max(math.log(base), 0.1)

    def _left_out(self, plain: list[int], shown: list[str]) -> list[bool]:
        n = len(self.tag)
        chars = self.up(plain)
        large = LARGE * chars[0]
        marks = [0] * (n + 1)                                     # articles before an element, in page order
        out, within = [False] * n, [False] * n                    # within an article
        first: dict[int, str] = {}
        for (node, _, _), t in zip(self.pieces, shown):
            if t and node >= 0 and node not in first:
                first[node] = t
        notes = [{k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(x)} if x.strip() else {} for x in self.attributes]
        names = [(named(x.get("class", "")) or named(x.get("id", ""))) if x else None for x in notes]
        for v in range(n):
            body = self.tag[v] in ("article", "main") or notes[v].get("role", "").lower() == "main"
            marks[v + 1] = marks[v] + (body and names[v] not in COMMENTS)
        for v in range(1, n):
            up, tag, x = self.parent[v], self.tag[v], notes[v]
            within[v] = within[up] or tag in ("article", "main")
            holds = marks[self.end[v]] > marks[v]                 # an article, or is one
            style = x.get("style", "").replace(" ", "").lower()
            hidden = "hidden" in x or x.get("aria-hidden", "").lower() == "true" or "display:none" in style or "visibility:hidden" in style
            by_tag = tag in RAW or (tag in LEFT_OUT and not (tag == "form" and (holds or chars[v] > large))) \
                or (tag == "header" and not within[up] and not holds)
            by_name = names[v] is not None and not holds and (names[v] in COMMENTS or chars[v] <= large) \
                and not (names[v] == "header" and within[up])
            by_role = x.get("role", "").lower() in ROLES and not holds and chars[v] <= large
            out[v] = out[up] or hidden or by_tag or by_name or by_role
        self._by_heading(out, chars, marks, first, large)
        return out

    def _by_heading(self, out: list[bool], chars: list[float], marks: list[int], first: dict[int, str], large: float) -> None:
        """A part that opens with a heading for comments, related pages or adverts; in a flat article,
        what follows such a heading up to the next one of its rank."""
        n, skipped = len(self.tag), {}
        for v in range(1, n):
            up = self.parent[v]
            rank = skipped.get(up)
            if rank is not None:
                if self.tag[v] in HEADINGS and self.tag[v] <= rank:
                    del skipped[up]
                else:
                    out[v] = True
            out[v] = out[v] or out[up]
            if out[v] or not (t := first.get(v)) or len(t) > 60 or not OPENING.fullmatch(t):
                continue
            if self.tag[v] in HEADINGS or (self.tag[v] in ("p", "b", "strong", "span") and chars[v] == len(t)):
                opens = up > 0 and self._first_text(up, first) == v
                if opens and marks[self.end[up]] == marks[up] and chars[up] <= large and self.tag[up] not in HEADINGS:
                    for w in range(up, self.end[up]):
                        out[w] = True
                elif self.tag[v] in HEADINGS:
                    out[v] = True
                    skipped[up] = self.tag[v]

    def _first_text(self, v: int, first: dict[int, str]) -> int:
        return next((w for w in range(v, min(self.end[v], v + 8)) if w in first), -1)

    def _root(self, out: list[bool], sums: list[float], chars: list[float]) -> int:
        """Where candidates lie: the article that the page marks (of several the one with the largest
        sum, then the most text), or its main part, or the body."""
        for tag in ("article", "main"):
            outer, past = [], 0
            for v in range(1, len(self.tag)):
                if v >= past and self.tag[v] == tag and not out[v] and chars[v]:
                    outer.append(v)
                    past = self.end[v]
            if outer:
                return max(outer, key=lambda v: (sums[v], chars[v], -v))
        return 0

    def _region(self, root, best, threshold, density, chars, links, link_tags, out) -> list[bool]:
        """Which elements' text is kept: the main subtree, or all of a marked article, and parts
        beside it that are as dense as the threshold; link lists go."""
        n = len(self.tag)
        kids: dict[int, list[int]] = {}
        for v in range(1, n):
            if not out[v]:
                kids.setdefault(self.parent[v], []).append(v)
        listed = lambda v: link_tags[v] > 1 and links[v] > chars[v] / 2 and self.tag[v] not in ("p", *HEADINGS)
        blocks = HEADINGS | {"p", "blockquote", "pre", "ul", "ol", "dl", "table", "figure"}
        take = [False] * n
        if root:
            best = root
            take[root:self.end[root]] = [True] * (self.end[root] - root)
        else:
            take[best:self.end[best]] = [True] * (self.end[best] - best)
            while best > 0:
                up = self.parent[best]
                near = [v for v in kids.get(up, []) if v != best and chars[v] and not listed(v)]
                alike = [v for v in near if self.tag[v] == self.tag[best] and self.attributes[v] == self.attributes[best] or self.tag[v] in blocks]
                dense = [v for v in alike if density[v] >= threshold and self.tag[v] not in HEADINGS]
                if not dense and up == 0:
                    break
                if dense:
                    several = [v for v in near if density[v] >= threshold and sum(w in kids for w in range(v, self.end[v])) > 1]
                    take[up] = True
                    for v in {*alike, *several}:
                        take[v:self.end[v]] = [True] * (self.end[v] - v)
                best = up
            if not any(take[v] and self.tag[v] == "h1" for v in range(n)):
                start = take.index(True)
                title = [v for v in range(start) if self.tag[v] == "h1" and not out[v]]
                for v in title[-1:]:
                    take[v:self.end[v]] = [True] * (self.end[v] - v)
        gone = [False] * n
        for v in range(1, n):
            gone[v] = gone[self.parent[v]] or (v != best and take[v] and listed(v) and density[v] < threshold)
        return [take[v] and not out[v] and not gone[v] for v in range(n)]


def main_text(source: str | None) -> str:
    """The main text of a page; empty for null, empty and textless pages."""
    return Page().read(source).main_text() if source else ""


def page_texts(pages: DataFrame, column: str = "html", name: str = "main") -> DataFrame:
    """All columns of ``pages`` and the struct ``name``: text (never null), n_chars (code points).

    Character references are decoded, white space within a block becomes one blank, blocks are joined
    by one blank. Each page is read by itself in time proportional to its length, so repeated rows
    get equal results. A null or empty page has an empty text; broken or unclosed markup is read as
    far as it goes. A column of that name is replaced. An empty table gives an empty result."""
    pages = pages.drop(name)
    at, names = pages.columns.index(column), pages.columns
    kind = pa.struct([("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(at)]
            out = [{"text": t, "n_chars": len(t)} for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, kind)], [*names, name])

    report = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return pages.mapInArrow(run, T.StructType([*pages.schema.fields, T.StructField(name, report)]))

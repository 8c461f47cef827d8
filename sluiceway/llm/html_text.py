"""Main text of web pages by tree scoring.

Paragraphs pass points for length and commas to their ancestors; a container's points are discounted by the
share of its text that is link text; the best container is kept with those siblings that score well
themselves.  Menus and other furniture, known by tag, role or class, neither score nor appear.  Menus, footers,
controls and hidden parts always go.  Other tags, roles and names only raise a suspicion: what holds the article or
main part, or a major share of the page's unlinked paragraph points, alone or with its namesakes, stays.  Elements whose name says
nothing else ("cookie-notice", "comments", "sidebar") and roles of that kind are certain: they go even from a
page that holds nothing more, unless an article or main part stands in them.

A page is read once into flat lists (parents before children), so nesting depth costs no recursion; open elements are
known by name, so a tag costs the same at any depth.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*(?:>|\Z))",
    re.S,
)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?(?=[\s/>])", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg canvas math object audio video".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
# An opening tag closes an open element of these kinds first.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "thead": {"tr"}, "tbody": {"thead", "tr"}, "tfoot": {"tbody", "tr"},
}
SCOPE = frozenset("table ul ol dl div section article body main blockquote select".split())
FURNITURE = frozenset("nav footer button select menu head".split())
FURNITURE_ROLES = frozenset("navigation contentinfo menu menubar".split())
SUSPECT = frozenset("aside dialog form fieldset label".split())
SUSPECT_ROLES = frozenset("banner complementary search dialog alert form".split())
FURNITURE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice alert popup modal overlay newsletter subscribe subscription signup login nav navbar navigation menu "
    "breadcrumb breadcrumbs pager pagination sidebar aside widget footer masthead toolbar share sharing social related "
    "recommended comment comments commentlist disqus replies respond search skip".split()
)
COMMENTS = frozenset("comment comments commentlist disqus replies respond".split())
ADVERTS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion".split())
# A class or id made of these words only, at least one of the first kind, is certain.  A single "comment" is not: it may be a post.
CERTAIN = COMMENTS - {"comment"} | ADVERTS - {"promo", "promotion"} | frozenset(
    "cookie cookies consent gdpr login signup newsletter subscribe subscription sidebar share sharing breadcrumb breadcrumbs".split()
)
BESIDE = frozenset("comment notice alert banner bar box form list section area block popup modal overlay message panel buttons links left right".split())
CERTAIN_ROLES = frozenset("complementary dialog alert alertdialog search".split())
STATES = frozenset("has no with without".split())  # 'has-sidebar' tells of the page, not of the element
NEVER_FURNITURE = frozenset("html body main h1".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
START_POINTS = {"article": 10, "main": 10, "div": 5, "section": 5, "pre": 3, "td": 3, "blockquote": 3, "ul": -3, "ol": -3}
MIN_PARAGRAPH = 25
MAJOR, MAJOR_FORM = 1 / 2, 1 / 3  # shares of the page's points from which a suspect is no furniture
LEFT_BY_COMMENTS, LEFT = 0.1, 0.2  # less than this share left: the suspects were the content
TEASER = 0.25  # an article of less than this share of the largest one does not vouch for what it stands in


class Page:
    """Elements and texts of a page in order; `names=False` judges furniture by tag and role only, `suspects=False` drops no suspect."""

    def __init__(self, source: str, names: bool = True, suspects: bool = True):
        self.tags, self.parents, self.dropped, self.linked, self.inside = ["html"], [0], [False], [False], [False]
        self.events: list[tuple[int, str | None]] = []  # (element, text), or (element, None) where a block starts or ends
        self.keys: list[set[str]] = [set()]  # why an element may be furniture: <tag>, role= or a word of its names
        self.certain: list[bool] = [False]
        self.names, self.suspects, stack = names, suspects, [0]
        self.open_at: dict[str, list[int]] = {}  # places of open elements in the stack, by tag
        self.scopes: list[int] = []  # and of those that bound a search
        self.logins: set[int] = set()  # forms that ask for a password
        at, end = 0, len(source)
        for token in _TOKEN.finditer(source):
            if token.start() < at:
                continue
            if token.start() > at:
                self._text(stack[-1], source[at : token.start()])
            at, tag = token.end(), token.group(2)
            if tag is None:
                continue
            tag = tag.lower()
            if token.group(1):
                self._close(stack, tag)
            elif tag in RAW:
                closing = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(source, at)
                at = closing.end() if closing else end
            elif tag in VOID:
                self.events.append((stack[-1], " " if tag != "hr" else None))
                if tag == "input" and "form" in self.open_at and "password" in token.group(3).lower():
                    for place in self.open_at["form"]:
                        self.logins.add(stack[place])
            else:
                self._open(stack, tag, token.group(3))
        if at < end:
            self._text(stack[-1], source[at:])
        self.before = self.dropped  # without what is only certain as a whole page tells
        if any(self.certain) or self.logins:
            self._drop_certain()
        if suspects and any(self.keys):
            self._judge()

    def _text(self, element: int, text: str) -> None:
        if not self.dropped[element]:
            self.events.append((element, html.unescape(text) if "&" in text else text))

    def _open(self, stack: list[int], tag: str, attributes: str) -> None:
        if tag in BLOCK:
            ends = CLOSES.get(tag, frozenset()) | {"p"}  # a block ends an open paragraph
            while True:
                bound = self.scopes[-1] if self.scopes else 0
                place, name = max(((self.open_at[t][-1], t) for t in ends if self.open_at.get(t)), default=(0, ""))
                if place <= bound:
                    break
                self._cut(stack, place)
                if name == "p" or tag not in CLOSES:
                    break
        parent, index = stack[-1], len(self.tags)
        self.tags.append(tag)
        self.parents.append(parent)
        self.linked.append(tag == "a" or self.linked[parent])
        self.inside.append(tag in ("article", "main") or self.inside[parent])
        self.keys.append(set())
        self.certain.append(False)
        self.dropped.append(self.dropped[parent] or self._furniture(tag, attributes, self.inside[parent], self.keys[index]))
        self.open_at.setdefault(tag, []).append(len(stack))
        if tag in SCOPE:
            self.scopes.append(len(stack))
        stack.append(index)
        if tag in BLOCK:
            self.events.append((index, None))

    def _cut(self, stack: list[int], place: int) -> None:
        """Close the elements from a place of the stack on."""
        while len(stack) > place:
            tag = self.tags[stack.pop()]
            self.open_at[tag].pop()
            if tag in SCOPE:
                self.scopes.pop()

    def _close(self, stack: list[int], tag: str) -> None:
        if self.open_at.get(tag):
            place = self.open_at[tag][-1]
            if tag in BLOCK:
                self.events.append((stack[place], None))
            self._cut(stack, place)

    def _furniture(self, tag: str, attributes: str, inside: bool, keys: set[str]) -> bool:
        """Whether the element is furniture for certain; else `keys` gets the reasons to suspect it."""
        if tag in FURNITURE or (tag == "label" and not self.suspects):
            return True
        if tag in SUSPECT or (tag == "header" and not inside):
            keys.add(f"<{tag}>")
        certain = False
        if len(attributes) < 5:
            return False
        for name, value in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'")
            if name == "role":
                if value.lower() in FURNITURE_ROLES:
                    return True
                if value.lower() in SUSPECT_ROLES:
                    keys.add(f"role={value.lower()}")
                certain = certain or value.lower() in CERTAIN_ROLES
            elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
                return True
            elif name == "style":
                if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                    return True
            elif name in ("class", "id") and tag not in NEVER_FURNITURE:
                for part in value.split():
                    words = [w.lower() for w in _NAME.findall(part)]
                    if not words or words[0] in STATES:
                        continue
                    if tag not in ("article", "p") and tag not in HEADINGS:
                        enough = CERTAIN.intersection(words) or len(words) > 1 and "comment" in words
                        certain = certain or bool(enough) and CERTAIN.union(BESIDE).issuperset(words)
                    if not self.names:
                        continue
                    if tag in ("article", "p"):
                        keys.update({"comment", "comments", "ad", "advert", "sponsored"}.intersection(words))
                    else:
                        keys.update(FURNITURE_NAMES.intersection(words))
                        if not inside and "header" in words:
                            keys.add("header")
        self.certain[-1] = certain
        return False

    def _drop_certain(self) -> None:
        """Drops what is furniture for certain, but not what an article or main part with text stands in.

        A form that asks for a password counts if it holds no paragraph.
        """
        n, tags = len(self.tags), self.tags
        chars, longest, block = [0] * n, [0] * n, self._blocks()
        for element, text in self.events:
            if text and not self.dropped[element]:
                chars[element] += len(text.strip())
                if not self.linked[element] and tags[element] not in ("label", "legend"):
                    longest[block[element]] += len(text.strip())
        chars = self._sums(chars, [False] * n)
        paragraphs = self._sums([int(x >= MIN_PARAGRAPH) for x in longest], [False] * n)
        holds = [tags[i] in ("article", "main") and chars[i] > 0 for i in range(n)]
        for i in range(n - 1, 0, -1):
            holds[self.parents[i]] = holds[self.parents[i]] or holds[i]
        gone = {i for i in range(n) if self.certain[i] and not holds[i]}
        gone |= {i for i in self.logins if not holds[i] and not paragraphs[i]}
        self.dropped = [a or b for a, b in zip(self.dropped, self._below(gone))]

    def _blocks(self) -> list[int]:
        """The block that each element's text belongs to."""
        block = list(range(len(self.tags)))
        for i in range(1, len(block)):
            if self.tags[i] not in BLOCK:
                block[i] = block[self.parents[i]]
        return block

    def _sums(self, values: list, skip: list[bool]) -> list:
        """Sums over subtrees, without skipped elements."""
        sums = [0 if out else x for x, out in zip(values, skip)]
        for i in range(len(sums) - 1, 0, -1):
            sums[self.parents[i]] += sums[i]
        return sums

    def _below(self, roots: set[int]) -> list[bool]:
        """Which elements are roots or stand in one."""
        inside = [i in roots for i in range(len(self.tags))]
        for i in range(1, len(inside)):
            inside[i] = inside[i] or inside[self.parents[i]]
        return inside

    def _judge(self) -> None:
        """Drops those suspects that are furniture."""
        tags, parents, keys, n = self.tags, self.parents, self.keys, len(self.tags)
        block, own, commas, every = self._blocks(), [0] * n, [0] * n, [0] * n
        for element, text in self.events:
            if text and text.strip():
                every[element] += len(text)
                if not self.linked[element]:
                    own[block[element]] += len(text)
                    commas[block[element]] += text.count(",")
        points = [
            1 + commas[i] + min(own[i] / 100, 3) if own[i] >= MIN_PARAGRAPH and tags[i] not in HEADINGS else 0.0 for i in range(n)
        ]
        weight, chars = self._sums(points, self.dropped), self._sums(every, self.dropped)

        # The articles and main parts, and what holds one.
        nested = [False] * n
        for i in range(1, n):
            nested[i] = nested[parents[i]] or tags[parents[i]] == "article"
        articles = [i for i in range(n) if tags[i] == "article" and chars[i] and not nested[i] and not keys[i]]
        largest = max((weight[i] for i in articles), default=0.0)
        articles = [i for i in articles if weight[i] >= TEASER * largest]
        roots = [i for i in range(n) if tags[i] == "main" and chars[i]] + articles
        holds, has_article = [False] * n, [False] * n
        for found, marks in ((roots, holds), (articles, has_article)):
            for i in found:
                while not marks[i]:
                    marks[i] = True
                    i = parents[i]
        within = self._below({i for i in range(n) if tags[i] == "article" or tags[i] == "main" and not has_article[i]})
        for i in range(n):
            if keys[i] and within[i] and (tags[i] == "section" or tags[i] in HEADINGS):
                keys[i] &= COMMENTS | ADVERTS

        # Comments may outweigh the article: they stay only where they hold it or nearly nothing is left without them.
        suspects = {i for i in range(n) if keys[i] & COMMENTS and not self.dropped[i] and not holds[i]}
        suspects -= {i for i in suspects if tags[i] == "article" and weight[i] >= MAJOR * weight[0] > 0}
        depth = [0] * n
        for i in range(1, n):
            depth[i] = depth[parents[i]] + (i in suspects)

        def without(named: set[int]) -> tuple[list[bool], list]:
            out = [a or b for a, b in zip(self.dropped, self._below(named))]
            return out, self._sums(points, out)

        # Outer ones that are the content may still hold comments: the least depth from which enough is left.
        low, high = 1, max(depth) + 1
        while low < high:
            middle = (low + high) // 2
            left = without({i for i in suspects if depth[i] >= middle})[1]
            if left[0] >= LEFT_BY_COMMENTS * weight[0] or any(left[i] for i in roots):
                high = middle
            else:
                low = middle + 1
        self.dropped = without({i for i in suspects if depth[i] >= low})[0]

        weight, chars = self._sums(points, self.dropped), self._sums(every, self.dropped)
        for i in range(n):
            keys[i] -= COMMENTS
        whole = max(self._sums(points, self.before)[0], 0.0)  # shares are of all the page's paragraphs
        suspects = set()
        for i in range(n):
            if keys[i] and not self.dropped[i] and not holds[i]:
                form = tags[i] in ("form", "fieldset")
                size = chars if form and not weight[0] else weight
                if not size[i] or size[i] < (MAJOR_FORM if form else MAJOR) * (whole if size is weight else size[0]):
                    suspects.add(i)

        # A word that stands on most of the text says nothing on this page, unless an article or main part does without it.
        for key in sorted({k for i in suspects for k in keys[i]} - {"<label>"}):
            named = {i for i in suspects if key in keys[i]}
            if sum(weight[i] for i in named) >= MAJOR * weight[0] > 0:  # nested ones count twice here, not below
                left = without(named)[1]
                if left[0] <= (1 - MAJOR) * weight[0] and not any(0 < weight[i] <= 2 * left[i] for i in roots):
                    for i in named:
                        keys[i].discard(key)
        # Nor may the suspects take nearly all of an article, a main part or, if there is neither, the page.
        scopes = {*roots, 0}
        while True:
            suspects = {i for i in suspects if keys[i]}
            out, left = without(suspects)
            text_left = self._sums(every, out)
            robbed = {i for i in scopes if left[i] < LEFT * weight[i] and (i or not any(text_left[j] for j in roots))}
            if not robbed:
                break
            owner, totals = [0 if 0 in robbed else -1] * n, {i: {} for i in robbed}
            for i in range(1, n):
                owner[i] = i if i in robbed else owner[parents[i]]
            for i in suspects:
                if owner[i] >= 0:
                    for key in keys[i]:
                        totals[owner[i]][key] = totals[owner[i]].get(key, 0.0) + weight[i]
            worst = {i: min(found, key=lambda k: (-found[k], k)) for i, found in totals.items() if found}
            scopes -= robbed - worst.keys()
            for i in suspects:
                if owner[i] in worst:
                    keys[i].discard(worst[owner[i]])
        self.dropped = out

    def kept_elements(self) -> set[int] | None:
        """Roots of the kept text; None if nothing scores."""
        n, block = len(self.tags), self._blocks()
        own, commas, chars, links = [0] * n, [0] * n, [0] * n, [0] * n
        for element, text in self.events:
            if text and not self.dropped[element]:
                size = len(text) if text.strip() else 0
                own[block[element]] += size
                commas[block[element]] += text.count(",")
                chars[element] += size
                if self.linked[element]:
                    links[element] += size
        points = [0.0] * n
        scored = set()
        for i in range(n):
            if own[i] < MIN_PARAGRAPH or self.dropped[i]:
                continue
            value = 1 + commas[i] + min(own[i] / 100, 3)
            to = self.parents[i] if self.tags[i] in ("p", "li", "pre", "td", "dd", "blockquote") or self.tags[i][0] == "h" else i
            for level in range(5):
                if to not in scored:
                    scored.add(to)
                    points[to] += START_POINTS.get(self.tags[to], 0)
                points[to] += value / (1, 2, 6, 9, 12)[level]
                if to == 0:
                    break
                to = self.parents[to]
        for i in range(n - 1, 0, -1):
            chars[self.parents[i]] += chars[i]
            links[self.parents[i]] += links[i]
        if not scored:
            return None
        density = [links[i] / chars[i] if chars[i] else 0.0 for i in range(n)]
        final = {i: points[i] * (1 - density[i]) for i in scored}
        best = min(scored, key=lambda i: (-final[i], i))
        at = best  # a section of an article stands for the article
        while at:
            if self.tags[at] in ("article", "main"):
                return {at} | self._siblings(at, final, density, own)
            at = self.parents[at]
        return {best} | self._siblings(best, final, density, own)

    def _siblings(self, best: int, final: dict, density: list, own: list) -> set[int]:
        least = max(10.0, 0.2 * final.get(best, 0.0))
        found = set()
        for i, parent in enumerate(self.parents):
            if i and best and parent == self.parents[best] and not self.dropped[i]:
                long_paragraph = self.tags[i] == "p" and own[i] > 80 and density[i] < 0.25
                if final.get(i, 0.0) >= least or long_paragraph:
                    found.add(i)
        return found

    def semantic_elements(self) -> set[int]:
        """The article, else the main part, else the whole page: for pages whose texts are too short to score."""
        for tag in ("article", "main", "body"):
            found = {i for i, t in enumerate(self.tags) if t == tag and not self.dropped[i]}
            if found:
                return found
        return {0}

    def text(self, roots: set[int]) -> str:
        inside = self._below(roots)
        blocks, current = [], []
        for element, text in self.events:
            if text is None:
                if current:
                    blocks.append("".join(current))
                    current = []
            elif inside[element] and not self.dropped[element]:
                current.append(text)
        blocks.append("".join(current))
        blocks = [" ".join(b.split()) for b in blocks]
        return "\n\n".join(b for b in blocks if b)


def main_text(source: str | None) -> str:
    """Main text of one page; null and empty pages, and pages of markup only, have none."""
    if not source:
        return ""
    for names, suspects in ((True, True), (False, True), (False, False)):
        page = Page(source, names, suspects)
        roots = page.kept_elements()
        text = page.text(roots if roots is not None else page.semantic_elements())
        if text:
            return text
    return ""


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            texts = [main_text(x.as_py()) for x in part.column(part.num_columns - 1)]
            sizes = pa.array([len(x) for x in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], pa.array(texts, pa.string()), sizes], ["page_id", "url", "text", "n_chars"]
            )


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: page_id, url, text, n_chars (code points of text).

    The whole page is read.  Blocks are joined by an empty line in page order, white space inside a block
    is one space, character references are decoded, nothing is capped.  Null and empty html give an empty
    text.  Rows are independent, so repeated rows and ties do not matter; ids may be null; other columns are not read.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")

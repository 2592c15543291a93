"""Main text of web pages by tree scoring.

A page is read once, in order: elements get numbers, and the text between block
borders becomes blocks that know the element they stand in. Each block passes points
for its length and commas to that element's ancestors, less with each step; an
element's points are discounted by the share of its text inside links. The best
element is kept with those of its siblings that look like more of the article.
Parts that are never article (menus, headers, footers, sidebars, notices, adverts,
forms, scripts, hidden ones) are left out while reading. Class names such as ``sidebar``
only raise a doubt, as wrappers of whole pages carry them too: a doubted element is left
out if it is short or mostly links and nothing in it looks like an article. Other doubted
elements count little, and within the best element they go unless they look like its text.
"""

from __future__ import annotations

import re
from html import unescape
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template textarea title iframe svg math object canvas video audio".split())
_LEFT_OUT = frozenset("nav footer aside form button select menu dialog fieldset label datalist head map".split()) | _RAW
_BLOCKS = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section
    summary table tbody td tfoot th thead tr ul""".split()
)
_HEADINGS = frozenset(f"h{n}" for n in range(1, 7))
#: Elements whose text is passed on to what they stand in.
_TEXTUAL = _HEADINGS | frozenset("p pre li dd dt td th blockquote figcaption caption summary address tr ul ol dl".split())
#: An element of the key closes an open element of these kinds, up to one of its homes.
_ENDS = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
         "option": ("option",), "tbody": ("thead", "tbody", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th")}
_HOMES = frozenset("ul ol dl table body article main section div aside nav form".split())
#: What an open paragraph is not closed across.
_HOLDERS = frozenset("td th button object caption table".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
_NEVER = frozenset(
    """ad ads adv advert adverts advertisement advertising adsense adbox banner banners sponsor sponsored sponsors promo
    promos promotion cookie cookies consent gdpr notice notices notification notifications alert popup modal overlay
    newsletter subscribe subscription signup login paywall sidebar sidebars aside widget widgets related recommended
    recommendations share sharing social breadcrumb breadcrumbs menu menus nav navbar navigation pagination pager footer
    masthead comment comments commentlist discussion disqus replies reply respond copyright disclaimer toolbar skip""".split()
)
#: Of these, names that arrange a page and may be part of the name of its text.
_LAYOUT = frozenset(
    "sidebar sidebars aside widget widgets menu menus share sharing social overlay toolbar banner banners header".split()
)
_ARTICLE = frozenset("article articlebody body content entry hentry main page post story text blog".split())
_TAG = re.compile(r"<!--|<[!?]|</?([a-zA-Z][^\s/>]*)")
_TAG_END = re.compile(r"""(?>[^>"'=]+|=\s*"[^"]*"|=\s*'[^']*'|["'=])*+>""")
_ATTRIBUTE = re.compile(r"""(?<=[\s"'/])(class|id|role|style|aria-hidden)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_HIDDEN = re.compile(r"""\shidden(?=[\s=>/])(?![^<>]*hidden\s*=\s*["']?until)""", re.I)
_NAME = re.compile(r"[a-z]+|[A-Z][a-z]*")
_REACH = 8
_TOP_SHARE = 0.2
#: Of doubted elements: what is short, the share of links that is too much, and what their text counts.
_SHORT, _LINKED, _DOUBTED = 200, 0.4, 0.1
_FIRM, _MAYBE, _LIKELY = 1, 2, 3  # doubts: by a sure name, by a layout name, and with an article's name too


def _keys(tag: str) -> list[str]:
    """A tag and the kinds that it is of."""
    kinds = (("#block", _BLOCKS), ("#home", _HOMES), ("#holder", _HOLDERS))
    return [tag, *[kind for kind, tags in kinds if tag in tags]]


class _Page:
    """Elements by number, in document order: parent, tag, last number below, weight; and the blocks."""

    def __init__(self) -> None:
        self.parent, self.tag, self.last, self.weight = [-1], ["#root"], [0], [0.0]
        self.out = [False]
        self.doubt = [0]
        self.block = [0]  # the nearest block element, itself included
        self.linked = [False]
        self.within = [False]  # an article or main element
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters in links
        self.stack = [0]
        self.open_at: dict[str, list[int]] = {}  # places in the stack, by tag and by kind
        self._parts: list[str] = []
        self._links = 0

    def open(self, tag: str, attributes: str) -> None:
        stack = self.stack
        if tag in _BLOCKS:
            self.flush()
            if tag not in ("tr", "td", "th", "tbody", "thead", "tfoot"):
                self._close_to("p", "#holder")
            for kind in _ENDS.get(tag, ()):
                self._close_to(kind, "#home")
        up = stack[-1]
        number = len(self.parent)
        self.parent.append(up)
        self.tag.append(tag)
        self.last.append(number)
        left_out, doubt, weight = self._judge(tag, attributes, up)
        self.weight.append(weight)
        self.doubt.append(doubt)
        self.out.append(self.out[up] or left_out)
        self.block.append(number if tag in _BLOCKS else self.block[up])
        self.linked.append(self.linked[up] or tag == "a")
        self.within.append(self.within[up] or tag in ("article", "main"))
        if tag in _VOID:
            if tag == "br":
                self._parts.append(" ")
        else:
            for key in _keys(tag):
                self.open_at.setdefault(key, []).append(len(stack))
            stack.append(number)

    def _judge(self, tag: str, attributes: str, up: int) -> tuple[bool, int, float]:
        """Whether the element is never article, its doubt, and what its kind and names speak for it."""
        weight = {"article": 25.0, "main": 15.0, "section": 3.0, "div": 2.0}.get(tag, 0.0)
        if tag in _LEFT_OUT or tag == "header" and not self.within[up]:
            return True, 0, weight
        if not attributes:
            return False, 0, weight
        if _HIDDEN.search(attributes):
            return True, 0, weight
        groups: list[set[str]] = []
        for key, value in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), value.strip("\"'")
            if key == "role" and value.lower() in _ROLES or key == "aria-hidden" and value.lower() == "true":
                return True, 0, weight
            if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return True, 0, weight
            if key in ("class", "id"):
                groups += [{n.lower() for n in _NAME.findall(name)} for name in value.split()]
        names = set().union(*groups)
        doubt = 0
        if tag not in ("html", "body", "article", "main"):
            bad = names & _NEVER | (names & {"header"} if not self.within[up] else set())
            if bad:
                # "entry-content has-comments" is an article's, "comment-content" is not.
                likely = any(g & _ARTICLE and not g & bad - _LAYOUT for g in groups)
                doubt = _LIKELY if likely else _MAYBE if bad <= _LAYOUT else _FIRM
        elif tag == "article" and not names.isdisjoint(("comment", "comments", "reply", "replies", "advert", "ad", "sponsored")):
            return True, 0, weight
        return False, doubt, weight + 10.0 * (not names.isdisjoint(_ARTICLE) and doubt in (0, _LIKELY))

    def close(self, tag: str) -> None:
        if tag in _BLOCKS:
            self.flush()
            self._close_to(tag, "#holder" if tag == "p" else None)
        else:
            self._close_to(tag, "#block")

    def _close_to(self, tag: str, home: str | None) -> None:
        """Ends the innermost open ``tag`` and all within it, unless an element of the kind ``home`` stands between."""
        places = self.open_at.get(tag)
        if places:
            homes = self.open_at.get(home)
            if not homes or homes[-1] <= places[-1]:
                self._pop(places[-1])

    def _pop(self, depth: int) -> None:
        number = len(self.parent) - 1
        for closed in self.stack[depth:]:
            self.last[closed] = number
            if closed:
                for key in _keys(self.tag[closed]):
                    self.open_at[key].pop()
        del self.stack[depth:]

    def text(self, text: str) -> None:
        at = self.stack[-1]
        if not self.out[at]:
            self._parts.append(text)
            if self.linked[at]:
                self._links += len(text.strip())

    def flush(self) -> None:
        if self._parts:
            text = " ".join(unescape("".join(self._parts)).split())
            if text:
                self.blocks.append((self.block[self.stack[-1]], text, min(self._links, len(text))))
            self._parts, self._links = [], 0

    def end(self) -> None:
        self.flush()
        self._pop(0)

    # -- choice ------------------------------------------------------------------

    def article(self) -> str:
        # Short elements of layout names only count if there is nothing else.
        return self._choose(_SHORT) or (self._choose(0) if any(self.doubt) else "")

    def _settle(self, short: int) -> tuple[list[bool], list[bool], list[bool]]:
        """Which elements are left out for a doubt, whose text counts little for one, and which have an article or main below."""
        n = len(self.parent)
        length, links = [0] * n, [0] * n
        tagged, named = [False] * n, [False] * n  # has an article or main element, an element with an article's name
        for at, text, linked in self.blocks:
            length[at] += len(text)
            links[at] += linked
        for at in range(n - 1, 0, -1):
            up = self.parent[at]
            length[up] += length[at]
            links[up] += links[at]
            if length[at]:
                tagged[up] |= tagged[at] or self.tag[at] in ("article", "main")
                # Part of a comment may be called its text.
                named[up] |= self.doubt[at] != _FIRM and (named[at] or self.doubt[at] != _MAYBE and self.weight[at] >= 10)
        gone, faint = [False] * n, [False] * n
        for at in range(1, n):
            up, doubt = self.parent[at], self.doubt[at]
            gone[at], faint[at] = gone[up], faint[up]
            if not doubt or gone[up]:
                continue
            article = tagged[at] or doubt == _LIKELY or doubt == _MAYBE and named[at]
            dense = links[at] > _LINKED * length[at]
            brief = length[at] < (short if doubt == _MAYBE else _SHORT)
            gone[at] = not article and (brief or dense)
            faint[at] = faint[up] or not article
        return gone, faint, tagged

    def _choose(self, short: int) -> str:
        n = len(self.parent)
        gone, faint, tagged = self._settle(short) if any(self.doubt) else ([False] * n,) * 3
        blocks = [b for b in self.blocks if not gone[b[0]]]
        points, length, links = [0.0] * n, [0] * n, [0] * n
        for at, text, linked in blocks:
            length[at] += len(text)
            links[at] += linked
            worth = (1.0 + text.count(",") + min(len(text) / 100, 3.0)) * (1 - linked / len(text))
            if len(text) < 25:
                worth *= len(text) / 50
            if faint[at]:
                worth *= _DOUBTED
            if self.tag[at] in _TEXTUAL:
                at = self.parent[at]
            for step in range(_REACH):
                if at < 0:
                    break
                points[at] += worth / (1, 2)[step] if step < 2 else worth / (3 * step)
                at = self.parent[at]
        for at in range(n - 1, 0, -1):
            length[self.parent[at]] += length[at]
            links[self.parent[at]] += links[at]

        def score(at: int) -> float:
            return (points[at] + self.weight[at]) * (1 - links[at] / length[at]) if points[at] > 0 else 0.0

        top = max(range(n), key=score)
        if score(top) <= 0:
            return ""
        # The whole article, not only its fullest part.
        up = top
        while up > 0:
            if self.tag[up] == "article":
                top = up
            up = self.parent[up]
        kept = [top]
        if self.parent[top] >= 0 and self.tag[top] not in ("article", "body", "html"):
            kept = [at for at in range(1, n) if self.parent[at] == self.parent[top] and (at == top or self._more(at, top, score, length, links))]
        spans = [(at, self.last[at]) for at in kept]
        # Doubted parts of it go, but for those that look like its text or hold most of it.
        whole = sum(length[at] for at in kept)
        cut = [
            (part, self.last[part]) for at in kept for part in range(at + 1, self.last[at] + 1)
            if self.doubt[part] in (_FIRM, _MAYBE)
            and (2 * length[part] < whole and (faint[part] or tagged[part]) or self.doubt[part] == _FIRM and faint[part] and length[part] < whole)
        ]
        inside, without = _covered(spans, n), _covered(cut, n)
        return "\n".join(text for at, text, _ in blocks if inside[at] and not without[at])

    def _more(self, at: int, top: int, score, length: list[int], links: list[int]) -> bool:
        """Whether a sibling of the best element belongs to the article."""
        if not length[at] or self.out[at] or self.doubt[at] == _FIRM:
            return False
        density = links[at] / length[at]
        if self.tag[at] in _HEADINGS:
            return at < top and density < 0.5
        if self.tag[at] in ("p", "pre", "blockquote"):
            return density < (0.25 if length[at] > 80 else 0.01)
        return density < 0.5 and score(at) >= max(10.0, _TOP_SHARE * score(top))


def _covered(spans: list[tuple[int, int]], n: int) -> list[bool]:
    """Which of ``n`` numbers lie in any of the spans, both ends included."""
    steps = [0] * (n + 1)
    for first, last in spans:
        steps[first] += 1
        steps[last + 1] -= 1
    return [depth > 0 for depth in accumulate(steps)]


def extract_text(html: str | None) -> str:
    """The article's blocks in page order, joined by a line feed; see ``extract_main_text``."""
    html = html or ""
    page, at, n = _Page(), 0, len(html)
    while at < n:
        found = _TAG.search(html, at)
        if not found:
            page.text(html[at:])
            break
        begin = found.start()
        if begin > at:
            page.text(html[at:begin])
        if found[0] == "<!--":
            end = html.find("-->", begin + 4)
            at = n if end < 0 else end + 3
            continue
        if found[1] is None:
            end = html.find(">", begin)
            at = n if end < 0 else end + 1
            continue
        whole = _TAG_END.match(html, found.end())
        end = whole.end() if whole else html.find(">", found.end()) + 1
        if not end:  # cut off within a tag
            break
        tag, attributes = found[1].lower(), html[found.end() : end]
        at = end
        if found[0][1] == "/":
            page.close(tag)
            continue
        page.open(tag, attributes if "=" in attributes or "hidden" in attributes else "")
        if tag in _RAW and not attributes.endswith("/>"):
            close = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(html, at)
            if close is None:
                break
            at = close.start()
    page.end()
    return page.article()


@F.arrow_udf(T.StringType())
def extract_udf(pages: pa.Array) -> pa.Array:
    return pa.array([extract_text(p) for p in pages.to_pylist()], pa.string())


def extract_main_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with ``text`` in place of the column of HTML.

    Character references are decoded, white space within a block (a line break
    element too) becomes one space, blocks are joined by a line feed. Broken,
    unclosed and cut-off markup is read as far as it goes. A null or empty page,
    and one without an article, has the text ''. Each of several rows with the
    same keys is read; a column named ``text`` is replaced. No shuffle.
    """
    found = pages.withColumn("__text", extract_udf(F.col(f"`{html_col}`")))
    return found.drop(html_col).withColumn("text", F.col("__text")).drop("__text")

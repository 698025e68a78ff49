"""Main text of HTML pages by tree scoring.

Every block of text passes points (one, one per comma, one per hundred characters up to
three) to the element around it, half of them to the next one, and a third of what is left
at each step further out.  An element's points are discounted by the share of its text
inside links; the best one and those of its siblings that look like text are the article:
what scores well, sections made like the best one, text between such parts, and the title
before them.  Elements that are never article text (menus, headers, footers, forms,
adverts, comments, scripts, ...) are left out before scoring.  A word in a class or id is only a hint: it does not leave
out an element that is named as text too, that holds the page's article or most of its
text, or that holds the most text if only links would be left.

Every step takes time in proportion to the page: elements are closed by the places of
their tags among the open ones, points are added up from the leaves, and no tag that is
never closed is looked through twice.
"""

from __future__ import annotations

import html as _html
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .words import slices

#: characters from which a block has points
SCORED_CHARS = 25
_SIBLING_SHARE = 0.2
#: share of a sibling's text inside links from which it is not text
_LINKED_SHARE = 0.25
#: how many times the text of article and text elements a hinted element has to hold
_FAR_MORE = 10

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template textarea title iframe svg object canvas "
                 "audio video xmp noembed noframes annotation annotation-xml".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd "
                    "label mark q rp rt ruby s samp small span strike strong sub sup time tt u var "
                    "wbr math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle mpadded mphantom "
                    "menclose msub msup msubsup munder mover munderover mmultiscripts mtable mtr mtd "
                    "semantics".split())
_LEFT_OUT = frozenset("nav footer aside form menu button select dialog head fieldset".split())
_PARAGRAPH = frozenset("p pre blockquote li dd dt td th h1 h2 h3 h4 h5 h6 figcaption caption".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_LISTS = frozenset("ul ol dl table pre blockquote figure".split())
_ARTICLE = frozenset("article main".split())
_WHOLE = frozenset("html body article main".split())
_ROLES = frozenset("navigation banner complementary contentinfo search dialog alert alertdialog "
                   "menu menubar form".split())
#: words in class and id of elements that are not article text
_HINTS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo "
    "promotion comment comments disqus reply replies respond discussion sidebar aside nav navbar "
    "navigation menu menus breadcrumb breadcrumbs footer header masthead topbar cookie cookies "
    "consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription "
    "signup login share sharing social related recommended recommendations pager pagination "
    "widget widgets toolbar search form".split())
#: of these, words of elements that may be longer than the article beside them
_COMMENTS = frozenset("comment comments disqus reply replies respond discussion".split())
#: of these, words that inside an article name parts of it
_INSIDE = frozenset("header masthead topbar search".split())
#: words before a hint word that only say whether something like it is on the page
_ABOUT = frozenset("has have with without no not hide hides hidden".split())
#: words after a hint word that say the same
_STATES = frozenset("open opened closed enabled disabled on off".split())
_TEXT_HINTS = frozenset("article content entry post story body text main".split())
_CLOSES = {  # an opening tag ends these open elements, up to the listed bounds
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
}
_TAG = re.compile(r"<(?:!--.*?(?:--!?>|\Z)|(/?)([A-Za-z][^\s/>]*)|[!?/][^>]*(?:>|\Z))", re.S)
_VALUE_OR_END = re.compile(r"=\s*([\"'])|>")
_ATTR = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORDS = re.compile(r"[a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


def _hint_words(names: str) -> set[str]:
    """Hint words of class and id; none if one of the names is a text word without any.
    Words after one of ``_ABOUT`` in the same name, or before one of ``_STATES`` at its
    end, do not count."""
    hints: set[str] = set()
    text = False
    for name in names.split():
        words = _WORDS.findall(_CAMEL.sub(" ", name).lower())
        words = words[:next((k for k, w in enumerate(words) if w in _ABOUT), len(words))]
        found = _HINTS.intersection(words) if words and words[-1] not in _STATES else set()
        hints |= found
        text = text or not found and not _TEXT_HINTS.isdisjoint(words)
    return set() if text else hints


class _Tags:
    """The tags of a page, one after the other, from ``at``."""

    def __init__(self, html: str):
        self.html, self.at = html, 0
        #: quote marks that may still close a value; none after a tag that has no end with them
        self._quotes = {"\"", "'"}

    def next(self) -> tuple[str, str, bool, str]:
        """Text up to the next tag, its name (none: a comment, or the page's end), whether it
        is an end tag, and its attributes."""
        html, start = self.html, self.at
        m = _TAG.search(html, start)
        end = self._end(m.end()) if m and m[2] else m.end() if m else -1
        if end < 0:                         # the rest has no tag
            self.at = len(html) + 1
            return html[start:], "", False, ""
        self.at = end
        text = html[start:m.start()]
        return (text, m[2].lower(), m[1] == "/", html[m.end():end - 1]) if m[2] else (text, "", False, "")

    def _end(self, at: int) -> int:
        """End of the tag whose name ends at ``at``; -1 if it has none.  A quote that nothing
        closes is a character like others; so are all if they would hide the page's rest."""
        html, place = self.html, at
        while m := _VALUE_OR_END.search(html, place):
            place = m.end()
            if m[1] is None:
                return place
            if m[1] in self._quotes:
                close = html.find(m[1], place)
                if close < 0:
                    self._quotes.discard(m[1])
                else:
                    place = close + 1
        self._quotes.clear()
        return html.find(">", at) + 1 or -1

    def skip(self, tag: str) -> None:
        """To the end of the raw text element ``tag``."""
        end = re.compile(f"</{re.escape(tag)}(?=[\\s/>]|\\Z)[^>]*>?", re.I).search(self.html, self.at)
        self.at = end.end() if end else len(self.html)


class _Page:
    """Elements and blocks of a page, in order.  Element 0 is the document."""

    def __init__(self, html: str):
        self.tag, self.parent, self.out, self.bonus = ["#"], [-1], [False], [0.0]
        self.in_article, self.cls = [False], [""]
        #: hint words per element that has some
        self.hints: dict[int, set[str]] = {}
        #: (element, text, characters, characters inside links) per block
        self.blocks: list[tuple[int, str, int, int]] = []
        self._run: list[tuple[str, bool]] = []
        self._links = 0
        self._parse(html)

    def _end_block(self, element: int) -> None:
        if not self._run:
            return
        text = " ".join(_html.unescape("".join(t for t, _ in self._run)).split())
        linked = sum(len(" ".join(_html.unescape(t).split())) for t, link in self._run if link)
        self._run = []
        if text and not self.out[element]:
            self.blocks.append((element, text, len(text), min(linked, len(text))))

    def _open(self, tag: str, attrs: str, parent: int) -> int:
        out, bonus, hints, cls = self.out[parent], 0.0, None, ""
        inside = self.in_article[parent]
        if tag in _LEFT_OUT and not (tag == "fieldset" and inside) or tag == "header" and not inside:
            out = True
        if attrs and not out:
            named = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attrs)}
            cls = named.get("class", "")
            names = cls + " " + named.get("id", "")
            words = set(_WORDS.findall(_CAMEL.sub(" ", names).lower()))
            if not words.isdisjoint(_HINTS):
                hints = _hint_words(names) - (_INSIDE if inside else set())
            if tag not in _WHOLE and tag not in _INLINE:
                out = named.get("role", "").lower() in _ROLES
            if "hidden" in named or named.get("aria-hidden", "").lower() == "true" \
                    or "display:none" in named.get("style", "").replace(" ", "").lower():
                out = True
            if words & _TEXT_HINTS:
                bonus = 25.0
        if tag in _ARTICLE:
            bonus = 25.0
        if hints:
            self.hints[len(self.tag)] = hints
        self.tag.append(tag)
        self.parent.append(parent)
        self.out.append(out)
        self.bonus.append(bonus)
        self.in_article.append(inside or tag in _ARTICLE)
        self.cls.append(cls)
        return len(self.tag) - 1

    def _parse(self, html: str) -> None:
        # open elements that are not inline; inline ones only matter for links
        stack, block = [0], 0
        places: dict[str, list[int]] = {}   # of the open elements of a tag, in the stack
        tags = _Tags(html)

        def close_to(depth: int) -> None:
            nonlocal block
            self._end_block(block)
            while len(stack) > depth:
                places[self.tag[stack.pop()]].pop()
            block = stack[-1]

        while tags.at <= len(html):
            text, tag, closing, attrs = tags.next()
            if text:
                self._run.append((text, self._links > 0))
            if not tag:
                continue
            if tag == "a":
                self._links = 0 if closing else 1
                continue
            if tag in _INLINE or tag in _VOID:
                if tag == "br":
                    self._run.append((" ", False))
                elif tag == "hr":
                    self._end_block(block)
                continue
            empty = attrs.rstrip().endswith("/")
            if not closing and tag in _RAW:
                if not empty or tag in ("script", "style", "title", "textarea"):
                    tags.skip(tag)
                continue
            if closing:
                if places.get(tag):
                    close_to(places[tag][-1])
                elif tag == "p":
                    self._end_block(block)
                self._links = 0
                continue
            self._links = 0
            if self.tag[stack[-1]] == "p":
                close_to(len(stack) - 1)
            if tag in _CLOSES:
                ends, bounds = _CLOSES[tag]
                bound = max((places[b][-1] for b in bounds if places.get(b)), default=0)
                depth = len(stack)
                for e in ends:
                    above = places.get(e, [])
                    k = bisect_right(above, bound)
                    depth = min([depth, *above[k:k + 1]])
                if depth < len(stack):
                    close_to(depth)
            self._end_block(block)
            block = self._open(tag, attrs, stack[-1])
            if empty and tag not in _PARAGRAPH and tag not in _WHOLE and tag != "div":
                block = stack[-1]
                continue
            places.setdefault(tag, []).append(len(stack))
            stack.append(block)
        self._end_block(block)

    def _leave_out_hinted(self) -> None:
        """Leave out the elements with hint words, except the one that holds the article
        and those around it."""
        marked = {e for e in self.hints if self.tag[e] not in _WHOLE and not self.out[e]}
        if not marked:
            return
        n = len(self.tag)
        near, text_part, filled = [-1] * n, [False] * n, [False] * n
        for e in range(1, n):               # parents come before their children
            near[e] = e if e in marked else near[self.parent[e]]
            text_part[e] = (text_part[self.parent[e]]
                            or self.bonus[e] > 0 and self.tag[e] not in ("html", "body"))
        # text outside links: all and scored by the innermost marked element, and that of
        # article and text elements outside of marked ones
        free, scored, plain = dict.fromkeys(marked, 0), dict.fromkeys({-1, *marked}, 0), 0
        for element, _, size, link in self.blocks:
            filled[element] = True
            e = near[element]
            scored[e] += size - link if size >= SCORED_CHARS else 0
            if e >= 0:
                free[e] += size - link
            elif text_part[element]:
                plain += size - link
        for e in range(n - 1, 0, -1):
            filled[self.parent[e]] = filled[self.parent[e]] or filled[e]
        articles = {near[e] for e in range(n) if self.tag[e] in _ARTICLE and filled[e]
                    and e not in self.hints}
        no_comments = [e for e in marked if e in articles or not self.hints[e] & _COMMENTS]
        most = max(no_comments, key=lambda e: (scored[e], -e), default=None)
        around = most
        while around is not None and around >= 0:
            if around in marked and scored[around] > scored[most]:
                most = None                 # part of a larger one
                break
            around = self.parent[around]
        if most is not None and scored[most] and scored[most] >= _FAR_MORE * plain and (
                most in articles or 2 * scored[most] > scored[-1] + sum(scored[e] for e in no_comments)):
            self._spare(most, marked)
        elif not any(size > link and near[element] < 0 for element, _, size, link in self.blocks):
            # nothing else is left
            most = max(marked, key=lambda e: (free[e], -e))
            if free[most]:
                self._spare(most, marked)
        for e in range(1, n):
            self.out[e] = self.out[e] or e in marked or self.out[self.parent[e]]
        self.blocks = [b for b in self.blocks if not self.out[b[0]]]

    def _spare(self, element: int, marked: set[int]) -> None:
        while element >= 0:
            marked.discard(element)
            element = self.parent[element]

    def main_blocks(self) -> list[str]:
        self._leave_out_hinted()
        if not self.blocks:
            return []
        n = len(self.tag)
        own, passed, chars, linked = [0.0] * n, [0.0] * n, [0] * n, [0] * n
        headed, titled = [0] * n, [False] * n       # characters in headings; whether h1 is inside
        for element, text, size, link in self.blocks:
            chars[element] += size
            linked[element] += link
            if self.tag[element] in _HEADINGS:
                headed[element] += size
                titled[element] = titled[element] or self.tag[element] == "h1"
            if size >= SCORED_CHARS:
                around = self.parent[element] if self.tag[element] in _PARAGRAPH else element
                own[around] += 1 + text.count(",") + min(3, size // 100)
        for e in range(n - 1, 0, -1):       # children come after their parents
            p = self.parent[e]
            passed[p] += own[e] / 2 + passed[e] / 3
            chars[p] += chars[e]
            linked[p] += linked[e]
            headed[p] += headed[e]
            titled[p] = titled[p] or titled[e]
        score = [(own[e] + passed[e] + self.bonus[e]) * (1 - linked[e] / chars[e])
                 if own[e] + passed[e] else 0.0 for e in range(n)]
        best = max(range(n), key=lambda e: (score[e], -e))
        if not score[best]:
            best = next((e for e in range(n) if self.bonus[e] and chars[e]), 0)
        e = best
        while e >= 0:                       # the article that the best element is part of
            if self.tag[e] in _ARTICLE:
                best = e
                break
            e = self.parent[e]
        # elements with text, by their parent
        rows: dict[int, list[int]] = {}
        for e in range(1, n):
            if chars[e] and not self.out[e]:
                rows.setdefault(self.parent[e], []).append(e)
        beside = rows.get(self.parent[best], [best])
        plain = {e for e in beside if linked[e] < _LINKED_SHARE * chars[e]}
        least = max(10.0, _SIBLING_SHARE * score[best])
        chosen = {best}
        for k, e in enumerate(beside):
            if score[e] >= least or self.tag[e] == "p" and (
                    chars[e] > 80 and e in plain or chars[e] <= 80 and not linked[e]):
                chosen.add(e)
            elif self.tag[best] not in _ARTICLE and e in plain and (
                    # a section like the best one, or a list that goes on from one
                    self.tag[e] == self.tag[best] and self.cls[e] == self.cls[best] and score[e]
                    or self.tag[e] in _LISTS and k and beside[k - 1] in chosen):
                chosen.add(e)
        kept = [k for k, e in enumerate(beside) if e in chosen]
        chosen.update(e for e in beside[kept[0]:kept[-1] + 1] if e in plain)
        has_title = any(titled[c] for c in chosen)
        if kept[0] and self._is_heading(beside[kept[0] - 1], chars, headed, linked) \
                and not (has_title and titled[beside[kept[0] - 1]]):
            chosen.add(beside[kept[0] - 1])
            has_title = has_title or titled[beside[kept[0] - 1]]
        e = 0 if has_title else best
        while e > 0:                        # the title, beside or further out
            row = rows.get(self.parent[e], [])
            k = bisect_right(row, e) - 1
            if k > 0 and titled[row[k - 1]] and self._is_heading(row[k - 1], chars, headed, linked):
                chosen.add(row[k - 1])
                break
            e = self.parent[e]
        inside = [False] * n
        for e in range(n):                  # parents come before their children
            inside[e] = e in chosen or self.parent[e] >= 0 and inside[self.parent[e]]
        return [text for element, text, _, _ in self.blocks if inside[element]]

    @staticmethod
    def _is_heading(e: int, chars: list[int], headed: list[int], linked: list[int]) -> bool:
        """Whether an element has headings only, and no links."""
        return headed[e] == chars[e] > 0 and not linked[e]


def main_text(html: str | None) -> str:
    """The article of a page: its blocks in page order, joined by two line ends."""
    return "\n\n".join(_Page(html).main_blocks()) if html else ""


def extract_text(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")
                 ) -> DataFrame:
    """``keep``, ``text``, ``n_chars`` (code points) per row.

    ``text`` is the main text of the whole html, however long; empty for a null or empty one
    and for a page without article text.  Of equal scores the earlier element is the best.
    Rows are taken one by one, also when they repeat; an empty table gives no rows.  Other
    columns are not read; a kept column named ``text`` or ``n_chars`` gives way.
    """
    kept = [c for c in keep if c not in ("text", "n_chars")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, len(kept), 256):
                texts = [main_text(h) for h in part.column(len(kept)).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    part.columns[:len(kept)] + [pa.array(texts, pa.string())], names=kept + ["text"])

    rows = pages.select(*kept, F.col(html_col).alias("__html"))
    schema = T.StructType([rows.schema[c] for c in kept] + [T.StructField("text", T.StringType())])
    return rows.mapInArrow(run, schema).withColumn("n_chars", F.length("text").cast("long"))

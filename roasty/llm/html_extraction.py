"""Main-text extraction from web pages by host consensus.

Pages of a host share templates. Every page's containers are scored by the
text they hold directly, each page votes with its scores on generalised
tag-and-class paths, Spark sums the votes per host, and every page is then
read again at its host's winning path, widened to what stands around it of
the same article: titles, leads and sections in containers of their own.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roasty.llm.common import stored

# Element names of HTML by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var".split()
)
#: Never text of the article.
DROPPED = frozenset(
    "nav footer aside button select textarea fieldset dialog menu script style noscript template svg math canvas "
    "iframe object audio video map head title".split()
)
RAW_TEXT = "script|style|noscript|iframe|textarea|title"
#: Hold elements of another language: a slash closes those, and a block of the
#: page ends them, unless it stands in the element named last.
FOREIGN, HTML_AGAIN = frozenset("svg math".split()), "foreignobject"
#: Hold text themselves; what they score counts for the element around them.
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li pre blockquote dt dd td th tr figcaption caption address summary".split())
#: Opening one of these ends an open paragraph.
ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
    "main menu nav ol p pre section table ul".split()
)
#: Opening the key ends an open element of the values, up to the element named last.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
#: Words of a class, id or role that mark something other than the article,
#: unless the element holds the page's main text.
BOILERPLATE = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar "
    "navigation menu breadcrumb breadcrumbs masthead footer sidebar widget widgets related recommended recommendations "
    "share sharing social comment comments commentlist disqus respond reply replies cookie cookies consent gdpr notice "
    "notices notification alert popup modal overlay newsletter subscribe subscription signup login search pagination "
    "pager toolbar copyright complementary contentinfo".split()
)
#: Of these, words of what can hold more text than the article beside it.
WORDY = frozenset(
    "ad ads advert adverts advertisement advertising adsense comment comments commentlist disqus respond reply replies "
    "cookie cookies consent gdpr".split()
)
#: Words of what leads through the site, and of what articles have too.
SITE_NAV = frozenset("nav navbar navigation menu".split())
OWN_NAV = frozenset("breadcrumb breadcrumbs pagination pager toc".split())
#: Whole pages and articles are not dropped for what their classes mention.
KEPT_TAGS = frozenset("html body main".split())
#: Elements nested deeper than this stand beside each other for the paths and
#: scores, as browsers lay them out; nothing of their text is lost.
DEEPEST = 512
#: Main text where it has so large a share of the page's unlinked text; what
#: is marked as wordy, where so little but headings is left beside it.
MOST, REST = 1 / 2, 1 / 20

#: An attribute as HTML reads it: quotes delimit a value right after the equals
#: sign alone, however long it is; one that never closes is a character.
NAME = r"[^\s/>][^\s/>=]*+"
VALUE = r"\"[^\"]*+\"|'[^']*+'|[^\s>]*+"
ATTRS = rf"(?:[\s/]++|{NAME}(?:\s*+=\s*+(?:{VALUE}))?+)*+"
#: A tag that the end of the page cuts off is markup, not text.
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{RAW_TEXT})(?=[\s/>]){ATTRS}>.*?(?:</(?P=raw)(?=[\s/>])[^>]*+>|\Z)"
    r"|<[!?][^>]*+>"
    rf"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>{ATTRS})(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
ATTR = re.compile(rf"({NAME})(?:\s*+=\s*+({VALUE}))?+")
WORDS = re.compile(r"[a-z]+")
DIGITS = re.compile(r"\d+")


#: Of text blocks and lists of them, the element around is the container.
HOLD_TEXT = TEXT_BLOCKS | frozenset("ul ol dl table tbody thead tfoot".split())


class Element:
    """An element with a link to the one around it. What the elements around
    it say is taken over when it opens, so that no text block has to walk up."""

    __slots__ = ("tag", "parent", "depth", "path", "dropped", "order", "nav", "suspect", "wordy", "main", "titled",
                 "suspects", "article", "last_article", "last_header", "container")

    def __init__(self, tag: str, parent: Element | None, path: int, dropped: bool, order: int):
        self.tag, self.parent, self.path, self.dropped, self.order = tag, parent, path, dropped, order
        self.depth = parent.depth + 1 if parent else 0
        #: Whether the site's navigation is in it.
        self.nav = False
        #: What a suspect looks like, if it is one: its likes are judged together.
        self.suspect: str | None = None
        self.wordy = self.main = self.titled = False
        #: The suspects among it and the elements around it.
        self.suspects: tuple[Element, ...] = parent.suspects if parent else ()
        #: The outermost article, and the depths of the innermost article and header (-1: none).
        self.article: Element | None = (parent.article if parent else None) or (self if tag == "article" else None)
        self.last_article = self.depth if tag == "article" else parent.last_article if parent else -1
        self.last_header = self.depth if tag == "header" else parent.last_header if parent else -1
        #: The innermost element that is not itself a text block.
        self.container: Element | None = (parent.container if parent else None) if tag in HOLD_TEXT else self

    @property
    def header(self) -> bool:
        return self.last_header == self.depth


class Paths:
    """The tag-and-class paths of a page, each by number, from its parent's
    number and its own step."""

    def __init__(self) -> None:
        self.numbers: dict[tuple[int, str], int] = {}
        self.steps: list[tuple[int, str]] = []

    def number(self, parent: int, step: str) -> int:
        got = self.numbers.get((parent, step))
        if got is None:
            got = self.numbers[parent, step] = len(self.steps)
            self.steps.append((parent, step))
        return got

    def text(self, number: int) -> str:
        out = []
        while number >= 0:
            number, step = self.steps[number]
            out.append(step)
        return "/".join(reversed(out))


def _attributes(text: str) -> dict[str, str]:
    return {k.lower(): html_lib.unescape((v or "").strip("\"'")) for k, v in ATTR.findall(text)} if text.strip() else {}


def _named(attrs: dict[str, str]) -> list[str]:
    return WORDS.findall(" ".join([attrs.get("class", ""), attrs.get("id", ""), attrs.get("role", "")]).lower())


def _is_site_nav(tag: str, named: list[str]) -> bool:
    return (tag == "nav" or not SITE_NAV.isdisjoint(named)) and OWN_NAV.isdisjoint(named)


def _is_boilerplate(tag: str, attrs: dict[str, str]) -> bool:
    if tag in DROPPED:
        return True
    if tag in KEPT_TAGS or not attrs:
        return False
    return "hidden" in attrs or attrs.get("aria-hidden") == "true" or bool(re.search(r"display\s*:\s*none", attrs.get("style", "")))


class Block:
    """A run of text that ends at a block boundary: the innermost element
    around it, its text and how many of its characters are in links."""

    __slots__ = ("inside", "text", "linked")

    def __init__(self, inside: Element | None, text: str, linked: int):
        self.inside, self.text, self.linked = inside, text, linked


class Page:
    """The text blocks of a page in order, boilerplate elements left out, its
    elements in the order they open, and their paths."""

    def __init__(self, page: str):
        self.blocks: list[Block] = []
        self.elements: list[Element] = []
        self.paths = Paths()
        self._read(page)
        for e in reversed(self.elements):  # what is in an element is in those around it
            if e.parent:
                e.parent.nav |= e.nav
                e.parent.main |= e.main
                e.parent.titled |= e.titled
        if any(e.suspect for e in self.elements):
            self.blocks = _cleared(self.blocks)

    def _read(self, page: str) -> None:
        out, stack, pieces = self.blocks, [], []
        #: How many elements of a tag are open.
        open_tags: dict[str, int] = {}
        linked = links = skipping = 0

        def flush() -> None:
            nonlocal linked
            if pieces:
                text = " ".join(html_lib.unescape("".join(pieces)).split())
                pieces.clear()
                if text:
                    out.append(Block(stack[-1] if stack else None, text, min(linked, len(text))))
            linked = 0

        def close(at: int) -> None:
            nonlocal skipping
            flush()
            while len(stack) > at:
                e = stack.pop()
                skipping -= e.dropped
                open_tags[e.tag] -= 1

        def text_piece(s: str) -> None:
            nonlocal linked
            if s and not skipping:
                pieces.append(s)
                if links:
                    linked += len(s)

        at = 0
        for m in TAG.finditer(page):
            if m.start() > at:
                text_piece(page[at : m.start()])
            at = m.end()
            tag = m["tag"]
            if tag is None:
                continue
            tag = tag.lower()
            if tag in INLINE:
                if tag == "a":
                    links = max(0, links - 1) if m["end"] else 1
                continue
            if tag in VOID:
                if tag == "hr":
                    flush()
                elif tag == "br":
                    text_piece(" ")
                continue
            if m["end"]:
                if open_tags.get(tag):
                    i = len(stack) - 1
                    while stack[i].tag != tag:
                        i -= 1
                    close(i)
                else:
                    flush()
                links = 0
                continue
            foreign = any(open_tags.get(t) for t in FOREIGN) and not open_tags.get(HTML_AGAIN)
            if foreign and tag in ENDS_P:
                close(next(i for i, e in enumerate(stack) if e.tag in FOREIGN))
                foreign = False
            if (foreign or tag in FOREIGN) and m["attrs"].endswith("/"):
                continue
            if tag in ENDS_P and open_tags.get("p"):
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i].tag == "p":
                        close(i)
                        break
                    if stack[i].tag not in TEXT_BLOCKS:
                        break
            if tag in SIBLINGS:
                ends, until = SIBLINGS[tag]
                if any(open_tags.get(t) for t in ends):
                    for i in range(len(stack) - 1, -1, -1):
                        if stack[i].tag in until:
                            break
                        if stack[i].tag in ends:
                            close(i)
                            break
            flush()
            links = 0
            new = self._opened(tag, m["attrs"], stack[-1] if stack else None, skipping)
            if not m["attrs"].endswith("/") or tag not in ("path", "rect"):
                stack.append(new)
                open_tags[tag] = open_tags.get(tag, 0) + 1
                skipping += new.dropped
        if at < len(page):
            rest = page[at:]
            cut = re.search(r"<[/!?][^>]*\Z", rest)
            text_piece(rest[: cut.start()] if cut else rest)
        close(0)

    def _opened(self, tag: str, attributes: str, parent: Element | None, skipping: int) -> Element:
        attrs = _attributes(attributes)
        classes = sorted({DIGITS.sub("#", c.lower()) for c in attrs.get("class", "").split()})
        step = ".".join([tag, *classes])
        dropped = _is_boilerplate(tag, attrs)
        if parent and parent.depth >= DEEPEST:
            parent = parent.parent
        path = self.paths.number(parent.path if parent else -1, step)
        new = Element(tag, parent, path, dropped, len(self.elements) + 1)
        self.elements.append(new)
        if not skipping:
            named = _named(attrs) if attrs else []
            inner = tag == "article" and parent is not None and parent.article is not None
            if not dropped and (tag == "form" or not BOILERPLATE.isdisjoint(named)) and tag not in KEPT_TAGS and (tag != "article" or inner):
                new.suspect = f"{step} {attrs.get('id', '')} {attrs.get('role', '')}"
                new.suspects = (*new.suspects, new)
                new.wordy = not WORDY.isdisjoint(named)
            if parent:
                # For the elements around it: see where the page has been read.
                if (dropped or new.suspect) and _is_site_nav(tag, named):
                    parent.nav = True
                if tag in ("main", "h1") or "main" in attrs.get("role", "").split():
                    parent.titled = True
                    parent.main |= tag != "h1"
        return new


def _is_heading(b: Block) -> bool:
    return b.inside is not None and re.fullmatch("h[1-6]", b.inside.tag) is not None


def _unlinked(found: list[Block]) -> int:
    return sum(len(b.text) - b.linked for b in found)


def _around(e: Element | None) -> Iterator[Element]:
    """The element and those around it, the innermost first."""
    while e is not None:
        yield e
        e = e.parent


def _suspects(b: Block) -> tuple[Element, ...]:
    return b.inside.suspects if b.inside else ()


def _cleared(found: list[Block]) -> list[Block]:
    """The blocks without those of suspects that do not hold the main text: a
    ``main``, the page's longest article or most of the unlinked text; wordy
    suspects only with a title besides, or with hardly a text beside them."""

    def texts(of: list[Block]) -> dict[str, int]:
        out: dict[str, int] = {}
        for b in of:
            for like in {e.suspect for e in _suspects(b)}:
                out[like] = out.get(like, 0) + len(b.text) - b.linked
        return out

    def without(of: list[Block], likes: set[str]) -> list[Block]:
        return [b for b in of if likes.isdisjoint(e.suspect for e in _suspects(b))]

    likes: dict[str, Element] = {}
    articles: dict[int, int] = {}
    by_order: dict[int, Element] = {}
    for b in found:
        outer = b.inside.article if b.inside else None
        if outer:
            by_order[outer.order] = outer
            articles[outer.order] = articles.get(outer.order, 0) + len(b.text) - b.linked
        for e in _suspects(b):
            first = likes.setdefault(e.suspect, e)
            first.main |= e.main
            first.titled |= e.titled
    longest = max(articles, key=lambda k: (articles[k], -k), default=None)
    own = {e.suspect for e in _around(by_order[longest].parent) if e.suspect} if longest is not None else set()
    share, total = texts(found), _unlinked(found)
    wordy = {like for like, e in likes.items() if e.wordy and not (e.titled and (e.main or like in own or share[like] > MOST * total))}
    beside = without(found, wordy)
    if wordy and _unlinked([b for b in beside if not _is_heading(b)]) < REST * total:
        wordy = {like for like in wordy if share[like] <= MOST * total}
        beside = without(found, wordy)
    share, total = texts(beside), _unlinked(beside)
    dropped = {
        like for like, e in likes.items()
        if not e.wordy and not (e.main or like in own or share.get(like, 0) > MOST * total)
    }
    return without(beside, dropped)


def _in_header(b: Block, depth: int = 0) -> bool:
    """Whether a header of this depth or deeper is around the block."""
    return b.inside is not None and b.inside.last_header >= depth


def _container(e: Element) -> Element:
    """The innermost element around that is not itself a text block, else the
    outermost."""
    return e.container or list(_around(e))[-1]


def scores(page: Page) -> dict[int, int]:
    """Score by container path: the unlinked characters a container's own
    blocks hold; the container around it gets half, so that an article cut
    into sections beats each of them."""
    out: dict[int, int] = {}
    for b in page.blocks:
        if b.inside is None or _in_header(b):
            continue
        weight = 2 * max(0, len(b.text) - 2 * b.linked)
        e: Element | None = _container(b.inside)
        for step in (weight, weight // 2):
            if e is None or e.tag == "html":
                break
            out[e.path] = out.get(e.path, 0) + step
            e = e.parent
    return out


def best_path(by_path: dict[str, int]) -> str | None:
    return max(by_path, key=lambda p: (by_path[p], p)) if by_path else None


def _article(page: Page, path: int) -> list[Block]:
    """The blocks of the article that has its main container at ``path``.

    All of the container; all of an ``article`` around it; of each other
    element around it the sections (its children) that are not mostly links
    and hold no other ``article``. Beyond an article, an element with a
    section that is neither, or one with the site's navigation, and in the
    body, only text that stands there directly is of the article. Headers
    keep their headings alone, those of the site nothing."""
    found = page.blocks
    # The container that each element is in, if any; elements open after those around them.
    holder: dict[int, Element] = {}
    for e in page.elements:
        if e.path == path:
            holder[e.order] = e
        elif e.parent and e.parent.order in holder:
            holder[e.order] = holder[e.parent.order]
    # Elements around the containers that hold text by their number (0: the
    # page), and those of their children that hold one.
    above: dict[int, Element | None] = {0: None}
    holding: dict[int, set[int]] = {0: set()}
    beyond: set[int] = set()
    for order in dict.fromkeys(holder[b.inside.order].order for b in found if b.inside and b.inside.order in holder):
        e = page.elements[order - 1]
        if e.tag == "article":
            beyond.add(order)
        for x in _around(e):
            known = x.order in above
            above[x.order] = x
            holding.setdefault(x.order, set())
            holding.setdefault(x.parent.order if x.parent else 0, set()).add(x.order)
            if known:
                break
    # The outermost element around that is not above.
    off: dict[int, Element] = {}
    for e in page.elements:
        if e.order not in above:
            off[e.order] = e if e.parent is None or e.parent.order in above else off[e.parent.order]
    kept: set[int] = set()
    # A section is of the innermost element above around it.
    sections: dict[int, dict[object, list[int]]] = {}
    for k, b in enumerate(found):
        held = holder.get(b.inside.order) if b.inside else None
        if held:
            if not _in_header(b, held.depth) or _is_heading(b):
                kept.add(k)
            continue
        child = off.get(b.inside.order) if b.inside else None
        of = (child.parent if child else b.inside)
        sections.setdefault(of.order if of else 0, {}).setdefault(child.order if child else ("text", k), []).append(k)
    for order in sorted(above, reverse=True):  # an element's number is above those of the elements around it
        e = above[order]
        tag = e.tag if e else "html"
        around = e.parent if e else None
        under = any(x.tag in ("article", "main") for x in _around(around)) if order in sections else False
        site = tag in ("html", "body") or (e.nav and tag not in ("article", "main"))
        frame = site or not beyond.isdisjoint(holding[order])
        left_out = False
        for name, ks in sections.get(order, {}).items():
            child = page.elements[name - 1] if isinstance(name, int) else None
            depth = child.depth if child else (e.depth + 1 if e else 0)
            if child is not None and child.header:
                if not site and not child.nav:
                    kept.update(k for k in ks if _is_heading(found[k]))
                continue
            if frame or tag != "article":
                links = 2 * sum(found[k].linked for k in ks) > sum(len(found[k].text) for k in ks)
                direct = child is None or child.tag in TEXT_BLOCKS
                if links or (frame and not direct) or any(found[k].inside and found[k].inside.last_article >= depth for k in ks):
                    left_out = True
                    continue
            kept.update(k for k in ks if not _in_header(found[k], depth) or _is_heading(found[k]))
        if frame or tag == "article" or (left_out and not under):
            beyond.add(order)
    return [found[k] for k in sorted(kept)]


def extract(text: str, winner: str | None) -> tuple[str, str | None]:
    """The text of the page's article around ``winner``, or around its own
    best path if it lacks the winner or holds less than a fifth of its best
    there; and that path."""
    page = Page(text)
    own = {page.paths.text(p): (p, score) for p, score in scores(page).items()}
    best = best_path({p: score for p, (_, score) in own.items()})
    path = winner if winner in own and own[winner][1] * 5 >= own[best][1] else best
    if path is None:
        return "\n\n".join(b.text for b in page.blocks if not _in_header(b)), None
    return "\n\n".join(b.text for b in _article(page, own[path][0])), path


def host(url: Column) -> Column:
    """Lower-case host name; '' if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def votes(pages: DataFrame) -> DataFrame:
    """``host, path, votes``: each page deals 1000 votes over its containers
    by score, so a long page counts as much as a short one."""
    schema = pa.schema([("host", pa.string()), ("path", pa.string()), ("votes", pa.int64())])

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tally: dict[tuple[str, str], int] = {}
            for h, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                read = Page(page or "")
                by_path = scores(read)
                total = sum(by_path.values())
                for number, s in by_path.items():
                    p = read.paths.text(number)
                    tally[h, p] = tally.get((h, p), 0) + (1000 * s // total if total else 0)
            keys = list(tally)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
                 pa.array([tally[k] for k in keys], pa.int64())], schema=schema,
            )

    cast = pages.select("host", "html").mapInArrow(vote, "host string, path string, votes long")
    return cast.groupBy("host", "path").agg(F.sum("votes").alias("votes"))


def winners(cast: DataFrame) -> DataFrame:
    """``host, winner``: the path with most votes, the greater one of a tie."""
    return cast.groupBy("host").agg(F.max(F.struct("votes", "path"))["path"].alias("winner"))


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per row of ``pages``: ``id_col, url_col, text, n_chars, path``.

    Null or empty html gives an empty text; a null or odd url belongs to the
    host ''; repeated rows are each returned; other columns are ignored. The
    whole html is read, whatever its length. ``path`` is the container that the
    text was found in and around, null if the page has no container."""
    own = pages.select(F.col(id_col), F.col(url_col), host(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    # Written, so that the join picks its way by the table's size: a row a host.
    won = stored(winners(votes(own)), "html-winners")
    rows = own.join(won.withColumnRenamed("host", "_host"), F.col("host") == F.col("_host"), "left").select(
        F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), "html", "winner"
    )
    id_type = dict(pages.dtypes)[id_col]
    url_type = dict(pages.dtypes)[url_col]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, paths = [], []
            for page, winner in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                text, path = extract(page or "", winner)
                texts.append(text)
                paths.append(path)
            text = pa.array(texts, pa.string())
            chars = pa.array(map(len, texts), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), text, chars, pa.array(paths, pa.string())], ["_id", "_url", "text", "n_chars", "path"]
            )

    out = rows.mapInArrow(read, f"_id {id_type}, _url {url_type}, text string, n_chars long, path string")
    return out.select(F.col("_id").alias(id_col), F.col("_url").alias(url_col), "text", "n_chars", "path")

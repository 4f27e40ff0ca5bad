"""Main text of web pages by tree scoring.

A page becomes a tree.  Every paragraph with enough text passes points for its
length and its commas to its parent, half of them to the next ancestor and ever
less further up; a container's points are discounted by the share of its text
that lies in links.  The best container and those of its siblings that score
near it, between such or with few links beside them are kept, without what is no
article text inside them: menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles and comments, told by element, role, class and id.  Classes
count by whole name, and one that only modifies (``has-sidebar``, ``no-comments``,
``tag-linux``) says nothing.  A form, or an element that its role or class places beside
the text, is kept none the less if it holds the ``article`` or ``main``, or in a page
with neither most of the paragraph text (adverts, notices and readers' comments
are not).

Edge cases: null or empty html, or a page without text, gives the empty text;
broken markup (open elements, stray ends, cut pages) is read as browsers do in
spirit; repeated rows and very long pages are extracted one by one and whole; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from . import _text as T

# Element names, and words of class, id or role that mark what is no article text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
DROPPED = frozenset("script style noscript template head title nav footer aside form button select option textarea input label "
                    "iframe object embed svg canvas video audio map menu dialog xmp noembed noframes math".split())
BLOCKS = frozenset("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure "
                   "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot "
                   "th thead tr ul".split())
PARAGRAPHS = frozenset("p pre td blockquote li dd h1 h2 h3 h4 h5 h6 div section article figcaption".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BESIDE = HEADINGS | frozenset("p pre blockquote ul ol dl table section figure details hgroup".split())
CLOSES_P = BLOCKS - frozenset(["br", "tbody", "td", "tfoot", "th", "thead", "tr", "caption"])
SIBLINGS = {"li": ("li", ("ul", "ol", "menu")), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")),
            "tr": ("tr", ("table", "tbody", "thead", "tfoot")), "dd": ("dd dt", ("dl",)), "dt": ("dd dt", ("dl",)),
            "option": ("option", ("select",))}
NOISE = re.compile(
    r"sidebar\w*|side|aside|widgets?|rail|nav\w*|menus?|breadcrumbs?|pagination|pager|toolbar|topbar|tabs|footer\w*|foot|header|masthead|"
    r"related|recommend\w*|morestories|stories|trending|popular|share|sharing|social|tags?|tagcloud|skip|search\w*|forms?|login|signup", re.I)
NEVER = re.compile(
    r"ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner\w*|cookies?|consent|gdpr|notices?|alerts?|popups?|modal|newsletter|subscri\w*|paywall|"
    r"copyright|outbrain|taboola|comments?|commentlist|disqus|repl(?:y|ies)|discussion|responses?", re.I)
# Words that begin or end a class which says something about an element but is not its kind.
BEFORE = frozenset("has with without no not is non tag category cat type format status post-type js show hide enable disable".split())
AFTER = frozenset("open closed enabled disabled on off active true false count".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
KEEP_SHARE = 0.2
#: A marked element that holds this share of the page's paragraph text is the article's, not beside it.
MOST = 0.8
LINKED = 0.25
MIN_CHARS = 25

_TAG = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)", re.S)
_LOOSE = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|$)", re.S)
_ATTR = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_SPACE = re.compile(r"\s+")


class _Node:
    __slots__ = ("tag", "parent", "children", "noise", "soft", "points", "chars", "links")

    def __init__(self, tag: str, parent: _Node | None, noise: bool, soft: bool = False) -> None:
        self.tag, self.parent, self.noise, self.soft = tag, parent, noise, soft
        self.children: list[_Node | str] = []
        self.points, self.chars, self.links = 0.0, 0, 0


def class_noise(value: str) -> tuple[bool, bool]:
    """Whether names of a class or id mark no article text, and whether all that do are
    about the place in the page, which what the element holds may overrule."""
    noise = never = False
    for name in value.split():
        parts = [x for x in re.split(r"[_-]+", name) if x]
        if len(parts) > 1 and (parts[0].lower() in BEFORE or parts[-1].lower() in AFTER):
            continue
        never = never or any(NEVER.fullmatch(x) for x in parts)
        noise = noise or any(NOISE.fullmatch(x) for x in parts)
    return noise or never, noise and not never


def _is_noise(tag: str, attributes: str) -> tuple[bool, bool]:
    """Whether an element is no article text, and whether that may be overruled."""
    if tag in DROPPED:
        return True, tag == "form"
    noise = hard = False
    for name, a, b, c in _ATTR.findall(attributes) if attributes else ():
        name, value = name.lower(), (a or b or c).strip()
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True, False
        if name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return True, False
        if name == "role" and value.lower() in ROLES:
            noise = True
        if name in ("class", "id") and tag not in ("html", "body", "article", "main"):
            marked, soft = class_noise(value)
            noise, hard = noise or marked, hard or (marked and not soft)
    return noise, noise and not hard


def parse(html: str) -> _Node:
    """The page's tree; character references are decoded."""
    root = _Node("#", None, False)
    node, at = root, 0
    n = len(html)
    while at < n:
        i = html.find("<", at)
        if i < 0:
            break
        if i > at:
            node.children.append(unescape(html[at:i]))
        m = _TAG.match(html, i) or _LOOSE.match(html, i)
        if m is None:
            node.children.append("<")
            at = i + 1
            continue
        at = m.end()
        if m.group(2) is None:
            continue
        tag = m.group(2).lower()
        if m.group(1):
            up = node
            while up is not root and up.tag != tag:
                up = up.parent
            if up is not root:
                node = up.parent
            continue
        if tag in CLOSES_P:
            up = node
            while up is not root and up.tag not in ("p", "td", "th", "table", "button", "article", "div", "section", "body", "li"):
                up = up.parent
            if up.tag == "p":
                node = up.parent
        if tag in SIBLINGS:
            same, stop = SIBLINGS[tag]
            up = node
            while up is not root and up.tag not in same.split() and up.tag not in stop:
                up = up.parent
            if up is not root and up.tag in same.split():
                node = up.parent
        child = _Node(tag, node, *_is_noise(tag, m.group(3)))
        node.children.append(child)
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*(?:>|$)", re.I).search(html, at)
            child.children.append(html[at:end.start() if end else n])
            at = end.end() if end else n
        elif tag not in VOID:
            node = child
    if at < n:
        node.children.append(unescape(html[at:]))
    _overrule(root)
    return root


def _overrule(root: _Node) -> None:
    """Take back the mark of elements that hold the article itself."""
    order, stack = [], [root]
    while stack:
        x = stack.pop()
        order.append(x)
        stack += [c for c in x.children if not isinstance(c, str) and (not c.noise or c.soft)]
    if not any(x.soft for x in order):
        return
    size, holds = {}, {}  # characters of paragraphs outside links; an article or main inside
    for x in reversed(order):
        inner = [c for c in x.children if id(c) in size]
        own = sum(len(c.strip()) for c in x.children if isinstance(c, str)) if x.tag in PARAGRAPHS else 0
        size[id(x)] = 0 if x.tag == "a" else (own if own >= MIN_CHARS else 0) + sum(size[id(c)] for c in inner)
        holds[id(x)] = x.tag in ("article", "main") or any(holds[id(c)] for c in inner)
    whole = 0 if holds[id(root)] else size[id(root)]
    for x in order:  # parents first; what lies in a marked element that stays marked goes with it
        if x.soft and (holds[id(x)] or (whole and size[id(x)] >= MOST * whole)):
            x.noise = False


def _walk(root: _Node):
    """Nodes that are no noise, children before their parents, with no recursion."""
    stack, order = [root], []
    while stack:
        x = stack.pop()
        order.append(x)
        if x.tag == "header" and not _inside(x, "article"):
            x.noise = True
        stack += [c for c in x.children if not isinstance(c, str) and not c.noise]
    return reversed([x for x in order if not x.noise])


def _inside(x: _Node, tag: str) -> bool:
    while x is not None and x.tag != tag:
        x = x.parent
    return x is not None


def score(root: _Node) -> list[_Node]:
    """Fill in points, text lengths and link lengths; the containers with points."""
    scored: list[_Node] = []
    for x in _walk(root):
        own = "".join(c for c in x.children if isinstance(c, str)).strip() if x.children else ""
        inline = [c for c in x.children if not isinstance(c, str) and not c.noise]
        x.chars = len(own) + sum(c.chars for c in inline)
        x.links = x.chars if x.tag == "a" else sum(c.links for c in inline)
        if x.tag in PARAGRAPHS:
            text = own + " ".join(blocks(c, inline_only=True) for c in inline if c.tag not in BLOCKS)
            if len(text) >= MIN_CHARS:
                points = 1 + text.count(",") + min(len(text) / 100, 3)
                points *= 1 - min(1.0, x.links / max(1, x.chars))
                up, share = x.parent, 1.0
                for depth in range(4):
                    if up is None or up.tag in ("#", "html"):
                        break
                    if not up.points and up not in scored[-8:]:
                        scored.append(up)
                    up.points += points * share
                    up, share = up.parent, 0.5 if depth == 0 else share / 2
    return list(dict.fromkeys(scored))


def blocks(x: _Node, inline_only: bool = False) -> str:
    """The text of the blocks under ``x`` in page order, white space as one space."""
    out: list[str] = []
    line: list[str] = []

    def flush() -> None:
        text = _SPACE.sub(" ", "".join(line)).strip()
        if text:
            out.append(text)
        line.clear()

    stack: list[_Node | str | None] = [x]
    while stack:
        c = stack.pop()
        if c is None:
            flush()
        elif isinstance(c, str):
            line.append(c)
        elif not c.noise:
            if c.tag in BLOCKS and not inline_only:
                flush()
                stack.append(None)
            stack += reversed(c.children)
    flush()
    return " ".join(out)


def main_text(html: str) -> str:
    """The article text of a page, empty if there is none."""
    root = parse(html)
    scored = [x for x in score(root) if x.points > 0]
    named = [x for x in _all(root, "article") if x.chars] or [x for x in _all(root, "main") if x.chars]
    if not scored:  # too short for points: what is marked as the article, or the body
        best = max(named or _all(root, "body") or [root], key=lambda x: x.chars)
        return blocks(best)
    value = {id(x): x.points * (1 - x.links / max(1, x.chars)) for x in scored}
    best = max(scored, key=lambda x: (value[id(x)], x.chars))
    for x in named:  # the marked article that holds the best container, or lies at its top
        if _holds(x, best):
            best = x
    if best.parent is None or best.tag in ("body", "article", "main") and not _article_siblings(best):
        return blocks(best)
    around = [c for c in best.parent.children if not isinstance(c, str) and not c.noise and c.chars]
    least = KEEP_SHARE * value.get(id(best), best.points)
    sure = [i for i, c in enumerate(around) if c is best or value.get(id(c), 0.0) >= least]
    keep = []
    for i, c in enumerate(around):
        few = c.links < LINKED * c.chars
        if i in sure or few and (sure[0] < i < sure[-1] or c.tag in BESIDE):
            keep.append(blocks(c))
    return " ".join(k for k in keep if k)


def _article_siblings(x: _Node) -> bool:
    return x.parent is not None and sum(not isinstance(c, str) and c.tag == x.tag for c in x.parent.children) > 1


def _all(root: _Node, tag: str) -> list[_Node]:
    out, stack = [], [root]
    while stack:
        x = stack.pop()
        if x.tag == tag:
            out.append(x)
        stack += [c for c in x.children if not isinstance(c, str) and not c.noise]
    return out


def _holds(x: _Node, y: _Node | None) -> bool:
    while y is not None and y is not x:
        y = y.parent
    return y is x


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The kept columns, ``text`` and ``n_chars`` of every page."""
    schema = T.schema([T.field(pages, c, c) for c in keep], "text string, n_chars bigint")

    def fn(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(b.decode()) for b in T.raw(batch.column(len(keep)))]
        return pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                          names=schema.names)

    return T.map_groups(pages.select(*keep, html_col), fn, schema, html_col)

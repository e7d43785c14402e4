"""HTML extraction with a linear-chain conditional random field over leaf blocks.

Each block of a page is labelled as main text or not from the tags, classes and ids around it and from its text; the
labels of neighbours count too, and Viterbi decoding finds the best sequence. The field is trained here, by gradient
steps on its log-likelihood, on labelled pages that training_pages() writes: layouts of several kinds with menus,
headers, footers, sidebars, notices, adverts, forms and reader comments around and inside of articles.

Null and empty pages have an empty text, as have pages without main text; an empty table gives an empty result. Pages are
read whole, whatever their length and however deep their elements are. Broken markup is read as far as it goes: an
unclosed element ends where its parent does. Of labels that are equally likely the one for other text is taken. Each
row gets its result, repeated rows the same; null ids and addresses stay null. Other columns are ignored.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_list, text_slices
from .htmlblocks import Block, Element, blocks

PAGES = 600
STEPS = 120
SEED = 7
TAGS = "article main section nav header footer aside form ul ol li table td p h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption div a button label address dl details dialog fieldset select span".split()
KINDS = {
    "comment": "comment comments reply replies respond disqus discussion reader-comments feedback",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc tabs role-navigation skip",
    "advert": "ad ads advert adverts advertisement sponsor sponsored promo promotion banner-ad adsense dfp affiliate",
    "notice": "cookie cookies consent notice gdpr popup modal newsletter subscribe subscription alert banner paywall overlay toast role-alert role-dialog hidden-element warning",
    "side": "sidebar side aside related recommended widget share sharing social tags trending popular more-stories rail role-complementary meta author-bio",
    "foot": "footer foot copyright legal colophon bottom role-contentinfo",
    "head": "header masthead logo topbar site-title branding role-banner search role-search top",
    "form": "form login signup contact-form search-form field input",
    "body": "content article post entry story main body text page-content post-body entry-content article-body role-main prose",
}
_KIND_OF = {w: k for k, words in KINDS.items() for w in words.split()}
WORDS = re.compile(r"cookie|consent|subscri|newsletter|sign (?:up|in)|log ?in|advert|sponsor|all rights|privacy|terms of|share (?:this|on)|read more|related|\brepl(?:y|ies)\b|comments?\b", re.I)


def _marks(value: str) -> set[str]:
    """What kinds an element's class, id and role speak of."""
    found = set()
    for token in value.split():
        if token in _KIND_OF:
            found.add(_KIND_OF[token])
            continue
        for part in re.split(r"[-_]+|(?<=[a-z])(?=\d)", token):
            if part in _KIND_OF:
                found.add(_KIND_OF[part])
    return found


NAMES = [
    *(f"in {t}" for t in TAGS), *(f"leaf {t}" for t in TAGS), *(f"kind {k}" for k in KINDS), *(f"nearest {k}" for k in [*KINDS, "none"]), "main without kind", "article in other", "kind in article",
    *(f"length {n}" for n in range(8)), *(f"links {n}" for n in range(4)), "sentence", "no mark", "sign", "capitals", "words", "first", "last", "bias", "same parent", "depth 0", "header inside", "header outside", "inner head",
]
_AT = {n: i for i, n in enumerate(NAMES)}
_BAD_TAGS = {"nav", "footer", "aside", "form", "dialog"}
_BAD = {"comment", "menu", "advert", "notice", "side", "foot", "head", "form"}


_NO_MARK = re.compile(r"[.!?,;:…。、]")


#: What is remembered of a path: tags and kinds on it, the nearest kind, whether any is not of the main text, articles, elements, and where a header stands.
_State = tuple[frozenset, frozenset, str, bool, int, int, str]
_ROOT: _State = (frozenset(), frozenset(), "none", False, 0, 0, "")
_known_marks = lru_cache(20_000)(_marks)


def _state(element: Element) -> _State:
    """The state of an element's path, made from the outermost element on that has none yet."""
    todo = []
    at: Element | None = element
    while at is not None and at.state is None:
        todo.append(at)
        at = at.parent.around if at.parent is not None else None
    state = at.state if at is not None else _ROOT
    for e in reversed(todo):
        tags, kinds, nearest, bad, articles, depth, header = state
        found = sorted(_known_marks(e.marks)) if e.marks else ()
        for k in found:
            nearest = k if k != "body" or nearest == "none" else nearest
            bad = bad or k in _BAD
        if e.tag in ("header", "hgroup"):
            header = "header inside" if "article" in tags or "main" in tags or "body" in kinds or "body" in found else "header outside"
        bad = bad or e.tag in _BAD_TAGS
        tags = tags if e.tag in tags or f"in {e.tag}" not in _AT else tags | {e.tag}
        kinds = kinds if kinds.issuperset(found) else kinds.union(found)
        e.state = state = (tags, kinds, nearest, bad, min(2, articles + (e.tag == "article")), min(3, depth + (e.tag != "")), header)
    return state


@lru_cache(20_000)
def _around(state: _State, tag: str) -> tuple[int, ...]:
    """Features of the elements around a block."""
    tags, kinds, nearest, bad, articles, depth, header = state
    own = {"bias", f"nearest {nearest}", *(f"in {t}" for t in tags), *(f"kind {k}" for k in kinds)}
    if f"leaf {tag}" in _AT:
        own.add(f"leaf {tag}")
    if header:
        own.add(header)
    if nearest == "head" and header == "header inside":
        own.add("inner head")
    if ("article" in tags or "main" in tags or "body" in kinds) and not bad:
        own.add("main without kind")
    if bad and "article" in tags:
        own.add("kind in article")
    if articles > 1:
        own.add("article in other")
    if depth <= 2:
        own.add("depth 0")
    return tuple(sorted(_AT[x] for x in own))


def _outer(block: Block) -> int:
    """Equal for blocks in equal elements around their own."""
    parent = block.element.parent
    return parent.around.key if parent is not None else 0


def features(page: list[Block]) -> list[list[int]]:
    """For each block the numbers of the features that it has."""
    out = []
    for n, b in enumerate(page):
        text = b.text
        own = [*_around(_state(b.element), b.element.tag), _AT[f"length {min(7, len(text).bit_length() - 3 if len(text) > 7 else 0)}"], _AT[f"links {min(3, 4 * b.linked // max(1, len(text)))}"]]
        if text[-1] in ".!?…。\"”»)":
            own.append(_AT["sentence"])
        if not _NO_MARK.search(text):
            own.append(_AT["no mark"])
        if "©" in text or text.startswith("(c)"):
            own.append(_AT["sign"])
        if text.isupper():
            own.append(_AT["capitals"])
        if WORDS.search(text):
            own.append(_AT["words"])
        if n == 0:
            own.append(_AT["first"])
        elif _outer(page[n - 1]) == _outer(b):
            own.append(_AT["same parent"])
        if n == len(page) - 1:
            own.append(_AT["last"])
        out.append(own)
    return out


def _sentences(r: random.Random, least: int, most: int) -> str:
    syllables = r.choice(["an er in the tion ou st ed re and to of".split(), "ge ver ung heit sch der ein ach lich und".split(), "que eau les ment ion tre en et de".split(), "ción as os el rr mente do ga que y".split()])
    words = ["".join(r.choices(syllables, k=r.randint(1, 3))) for _ in range(r.randint(least, most))]
    text, left = [], 0
    for w in words:
        if not left:
            left = r.randint(2, 12)
            w = w.capitalize()
        left -= 1
        text.append(w if left else w + ".")
    return " ".join(text)


def _page(r: random.Random) -> list[tuple[str, int]]:
    """Pieces of a page with the label of their texts: 1 for main text, -1 for markup."""
    out: list[tuple[str, int]] = []
    put = lambda *x: out.extend((s, -1) if s.startswith("<") else (s, label) for s, label in x)
    short = lambda: _sentences(r, 1, 4)
    wrap = lambda tag, text, label, attrs="": put((f"<{tag}{attrs}>", -1), (text, label), (f"</{tag}>", -1))
    cls = lambda *names: r.choice(["", f' {r.choice(["class", "id"])}="{r.choice(names)}"']) if r.random() < 0.3 else f' {r.choice(["class", "id"])}="{r.choice(names)}"'
    sure = lambda *names: f' {r.choice(["class", "id"])}="{r.choice(names)}"'

    def bar() -> None:
        """Links in one line, with marks between them."""
        tags = r.choice([["table", "tr", "td"], ["div"], ["p"], ["center"], ["span"]])
        put(*[(f"<{t}>", -1) for t in tags])
        for n in range(r.randint(2, 7)):
            put((r.choice(["| ", "- ", "· "]) if n else "", 0), ('<a href="/x">', -1), (_sentences(r, 1, 2).rstrip("."), 0), ("</a> ", -1))
        put(*[(f"</{t}>", -1) for t in reversed(tags)])

    def menu() -> None:
        if r.random() < 0.25:
            return bar()
        tag = r.choice(["nav", "nav", "div", "ul"])
        attrs = cls("menu", "navbar", "main-nav") if tag == "nav" else sure("menu", "nav", "navigation", "breadcrumbs", "site-menu")
        put((f"<{tag}{attrs}>", -1))
        inner = r.choice(["li", "li", "a", "span"])
        if inner == "li" and tag != "ul":
            put(("<ul>", -1))
        link = tag != "nav" or r.random() < 0.7
        for _ in range(r.randint(2, 8)):
            put((f"<{inner}>" if inner != "a" else "<div>", -1), ('<a href="/x">' if link else "<b>", -1), (short(), 0), ("</a>" if link else "</b>", -1), (f"</{inner}>" if inner != "a" else "</div>", -1))
        if inner == "li" and tag != "ul":
            put(("</ul>", -1))
        put((f"</{tag}>", -1))

    def advert() -> None:
        wrap(r.choice(["div", "div", "aside", "section", "p"]), _sentences(r, 2, 25), 0, sure("ad", "ads", "advert", "ad-slot", "sponsored", "promo", "advertisement"))

    def notice() -> None:
        text = r.choice(["We use cookies. ", "Subscribe to our newsletter. ", "", "Please accept. "]) + _sentences(r, 3, 30)
        put((f"<div{sure('cookie-notice', 'cookie', 'notice', 'newsletter', 'consent', 'popup', 'alert', 'paywall')}>", -1))
        wrap(r.choice(["p", "div", "span"]), text, 0)
        if r.random() < 0.5:
            wrap("button", "Ok", 0)
        put(("</div>", -1))

    def side() -> None:
        tag = r.choice(["aside", "aside", "div", "section"])
        put((f"<{tag}{cls('sidebar', 'related') if tag == 'aside' else sure('sidebar', 'related', 'widget', 'share', 'trending', 'side')}>", -1))
        wrap("h3", short(), 0)
        for _ in range(r.randint(1, 5)):
            if r.random() < 0.5:
                put(("<li>", -1), ("<a>", -1), (short(), 0), ("</a>", -1), ("</li>", -1))
            else:
                wrap("p", _sentences(r, 3, 40), 0)
        put((f"</{tag}>", -1))

    def form() -> None:
        put((f"<form{cls('login', 'search-form', 'signup')}>", -1))
        wrap("label", short(), 0)
        if r.random() < 0.6:
            wrap("p", _sentences(r, 3, 20), 0)
        wrap("button", short(), 0)
        put(("</form>", -1))

    def comments() -> None:
        tag = r.choice(["div", "section", "section", "ol", "article"])
        put((f"<{tag}{sure('comments', 'comment-list', 'reader-comments', 'disqus', 'replies')}>", -1))
        if r.random() < 0.7:
            wrap(r.choice(["h2", "h3"]), r.choice(["Comments", "3 comments", short()]), 0)
        for _ in range(r.randint(1, 6)):
            inner = r.choice(["div", "article", "li", "p"])
            put((f"<{inner}{r.choice([' class=comment', ''])}>", -1))
            if inner != "p":
                wrap(r.choice(["p", "p", "div"]), _sentences(r, 3, 90), 0)
            else:
                put((_sentences(r, 3, 90), 0))
            put((f"</{inner}>", -1))
        put((f"</{tag}>", -1))

    def head() -> None:
        tag = r.choice(["header", "header", "header", "div"])
        put((f"<{tag}{r.choice(['', cls('site-header')]) if tag == 'header' else sure('header', 'masthead', 'topbar', 'logo')}>", -1))
        wrap(r.choice(["h1", "h2", "div", "p", "a"]), short(), 0)
        if r.random() < 0.4:
            wrap("p", _sentences(r, 2, 15), 0)
        put((f"</{tag}>", -1))

    def foot() -> None:
        tag = r.choice(["footer", "footer", "div"])
        put((f"<{tag}{cls('footer') if tag == 'footer' else sure('footer', 'copyright', 'site-footer', 'legal')}>", -1))
        if r.random() < 0.6:
            put((r.choice(["© ", "(c) 2020 ", ""]) + _sentences(r, 3, 40), 0))
        else:
            for _ in range(r.randint(1, 3)):
                wrap(r.choice(["p", "div", "li"]), r.choice(["© ", ""]) + _sentences(r, 3, 30), 0)
        put((f"</{tag}>", -1))

    kind = r.choice(["article", "article", "article", "main", "div", "div", "plain", "main article"])
    put(("<html>", -1), ("<body>", -1))
    boxed = r.random() < 0.4
    if boxed:
        put((f"<div{cls('wrapper', 'page', 'container', 'row')}>", -1))
    before, after = [x for x in (head, menu, notice, advert, side, form) if r.random() < 0.4], [x for x in (comments, side, advert, notice, form, menu, foot, foot) if r.random() < 0.4]
    if kind == "plain":
        before = [x for x in before if x in (menu, head)]
    for x in before:
        x()
    opened = {"article": ["article"], "main": ["main"], "div": [r.choice(["div", "div", "section", "td"])], "plain": [], "main article": ["main", "article"]}[kind]
    for t in opened:
        put((f"<{t}{sure('content', 'post', 'entry-content', 'article-body', 'story', 'main-content', 'post-body') if t in ('div', 'section', 'td') else cls('post', 'content', 'article', 'a1')}>", -1))
    if r.random() < 0.8:
        if r.random() < 0.35 and opened:
            named = r.choice(["entry-header", "post-header", "article-header", "article__header", "content-header", "header", "post-title-wrap", "story-head", "title", "head"])
            put((f"<header{r.choice(['', '', f' class={chr(34)}{named}{chr(34)}'])}>" if r.random() < 0.5 else f'<header class="{named}">', -1))
            about = lambda: wrap("div", _sentences(r, 2, 9), 0, sure("entry-meta", "post-meta", "byline meta", "meta"))
            if r.random() < 0.15:
                about()
            wrap(r.choice(["h1", "h1", "h2"]), _sentences(r, 2, 12), 1)
            if r.random() < 0.2:
                wrap(r.choice(["p", "h2"]), _sentences(r, 3, 25), 1)
            if r.random() < 0.25:
                about()
            put(("</header>", -1))
        else:
            wrap("h1", _sentences(r, 2, 12), 1)
    inside = [x for x in (advert, side, notice, form, menu) if r.random() < 0.12]
    amount = r.randint(1, 9)
    for i in range(amount):
        what = r.random()
        if what < 0.68:
            text = _sentences(r, 1, 120)
            if r.random() < 0.15:
                put(("<p>", -1), ("<b>", -1), (text, 1), ("<br>", -1))
            else:
                wrap("p", text, 1)
        elif what < 0.76:
            wrap(r.choice(["h2", "h3"]), _sentences(r, 1, 8), 1)
        elif what < 0.84:
            tag = r.choice(["ul", "ol"])
            put((f"<{tag}>", -1))
            for _ in range(r.randint(1, 5)):
                wrap("li", _sentences(r, 1, 25), 1)
            put((f"</{tag}>", -1))
        elif what < 0.88:
            wrap("blockquote", _sentences(r, 4, 40), 1)
        elif what < 0.91:
            put(("<figure>", -1))
            wrap("figcaption", _sentences(r, 2, 15), 1)
            put(("</figure>", -1))
        elif what < 0.94:
            put(("<table>", -1), ("<tr>", -1))
            for _ in range(r.randint(1, 4)):
                wrap("td", _sentences(r, 1, 6), 1)
            put(("</tr>", -1), ("</table>", -1))
        elif what < 0.96:
            wrap("pre", _sentences(r, 3, 20), 1)
        else:
            wrap("div" if r.random() < 0.6 else "section", _sentences(r, 3, 60), 1)
        if inside and i < amount - 1 and r.random() < 0.5:
            inside.pop()()
    if r.random() < 0.25:
        comments()
    for t in reversed(opened):
        put((f"</{t}>", -1))
    for x in after:
        x()
    if boxed:
        put(("</div>", -1))
    return out


def training_pages(pages: int = PAGES, seed: int = SEED) -> list[tuple[list[Block], list[int]]]:
    """Blocks of written pages with their labels."""
    r = random.Random(seed)
    out = []
    for _ in range(pages):
        pieces = _page(r)
        # a mark behind each text tells its label; what the field sees is the page without marks
        marked = blocks("".join(s if label < 0 or not s.strip() else f"{s} {label}" for s, label in pieces))
        out.append((blocks("".join(s for s, _ in pieces)), [int(b.text[-1]) for b in marked]))
    return out


@dataclass
class Field:
    """Weights of the linear-chain field: of features by label, and of label pairs."""

    emission: np.ndarray  # (features, 2)
    transition: np.ndarray  # (2, 2)

    def decode(self, page: list[list[int]]) -> list[int]:
        """The best labels of a page's blocks."""
        if not page:
            return []
        sizes = [len(f) for f in page]
        flat = self.emission[[i for f in page for i in f]]
        scores = np.add.reduceat(flat, np.cumsum([0, *sizes[:-1]]), axis=0).tolist()
        (t00, t01), (t10, t11) = self.transition.tolist()
        a, b = scores[0]
        back = []
        for s0, s1 in scores[1:]:
            to0, to1 = (a + t00, b + t10), (a + t01, b + t11)
            back.append((int(to0[1] > to0[0]), int(to1[1] > to1[0])))
            a, b = max(to0) + s0, max(to1) + s1
        labels = [int(b > a)]
        for pair in reversed(back):
            labels.append(pair[labels[-1]])
        return labels[::-1]


@lru_cache(2)
def train(pages: int = PAGES, seed: int = SEED, steps: int = STEPS) -> Field:
    """Maximum likelihood with a small penalty on large weights, by Adam, all pages at a time."""
    made = [(features(b), y) for b, y in training_pages(pages, seed) if b]
    longest, size = max(len(y) for _, y in made), len(NAMES)
    x, y = np.zeros((len(made), longest, size)), np.zeros((len(made), longest), dtype=int)
    there = np.zeros((len(made), longest))
    for i, (f, labels) in enumerate(made):
        for t, own in enumerate(f):
            x[i, t, own] = 1
        y[i, : len(labels)] = labels
        there[i, : len(labels)] = 1
    gold = np.eye(2)[y] * there[:, :, None]
    pairs = there[:, 1:]
    gold_pairs = np.einsum("itk,itl->kl", gold[:, :-1] * pairs[:, :, None], gold[:, 1:])
    flat = x.reshape(-1, size)
    w = np.zeros(size * 2 + 4)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        emission, transition = w[: size * 2].reshape(size, 2), w[size * 2 :].reshape(2, 2)
        score = (flat @ emission).reshape(len(made), longest, 2)
        forward, backward = np.zeros_like(score), np.zeros_like(score)
        forward[:, 0] = score[:, 0]
        for t in range(1, longest):
            new = np.logaddexp.reduce(forward[:, t - 1, :, None] + transition, axis=1) + score[:, t]
            forward[:, t] = np.where(there[:, t, None] > 0, new, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            new = np.logaddexp.reduce(transition + (score[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2)
            backward[:, t] = np.where(there[:, t + 1, None] > 0, new, 0)
        total = np.logaddexp.reduce(forward[:, -1], axis=1)
        marginal = np.exp(forward + backward - total[:, None, None]) * there[:, :, None]
        both = np.exp(forward[:, :-1, :, None] + transition + (score[:, 1:] + backward[:, 1:])[:, :, None, :] - total[:, None, None, None]) * pairs[:, :, None, None]
        gradient = np.concatenate(((flat.T @ (gold - marginal).reshape(-1, 2)).ravel(), (gold_pairs - both.sum(axis=(0, 1))).ravel())) / len(made) - 1e-3 * w
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        w = w + 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Field(w[: size * 2].reshape(size, 2), w[size * 2 :].reshape(2, 2))


def main_text(page: str | None, field: Field) -> str:
    found = blocks(page or "")
    labels = field.decode(features(found))
    return " ".join(b.text for b, label in zip(found, labels, strict=True) if label)


def extract(pages: DataFrame, html: str = "html", id: str = "page_id", url: str = "url", field: Field | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of pages."""
    shared = pages.sparkSession.sparkContext.broadcast(field or train())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, column="html"):
            texts = [main_text(t, shared.value) for t in text_list(part.column("html"))]
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")

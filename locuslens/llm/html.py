"""Main-text extraction with a tree-structured graphical model over the DOM.

Every block element (and every inline element that carries a class, id or role) is a binary variable:
is its own text article content? Unary potentials come from tag, class words, link density and text
shape; each parent-child edge has a potential that depends on the kind of child. Sum-product messages
go from the leaves to the root and back, and text is kept where the content marginal is at least one
half. Weights are the maximum of the exact tree likelihood of labelled pages (``labelled_pages``).

Defined results: null or blank html gives empty text; markup that never closes, unknown tags and stray
end tags are tolerated; a page without any content block gives empty text; repeated page rows each give
a row; further columns are ignored.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locuslens.llm.common import small_batches, with_fields

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<end>/)?(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
#: One attribute: its whole name, then its value if it has one.
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?|[\"']")
HEAD = frozenset("title base link meta style script noscript template".split())
SPACES = re.compile(r"[\x20\x09-\x0D]+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template svg iframe object math canvas textarea select title".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img acronym".split())
#: What a start tag closes if it is still open, and the elements past which that search does not look.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
WALLS = frozenset("ul ol dl table article section div main nav aside header footer body html form td th blockquote".split())
KINDS = ("article", "main", "section", "div", "p", "h", "list", "li", "nav", "header", "footer", "aside", "form", "table", "quote", "body", "inline", "other")
KIND_OF = {"ul": "list", "ol": "list", "dl": "list", "menu": "nav", "dt": "li", "dd": "li", "td": "table", "th": "table", "tr": "table", "tbody": "table", "thead": "table", "blockquote": "quote", "pre": "quote", "figure": "quote", "figcaption": "quote", "html": "body", "button": "form", "fieldset": "form", "dialog": "aside", "address": "footer"} | {f"h{i}": "h" for i in range(1, 7)} | {k: k for k in ("article", "main", "section", "div", "p", "li", "nav", "header", "footer", "aside", "form", "table", "body")}
#: Words of class, id and role by the part of a page that they name (fixed vocabulary).
WORDS = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc skip topbar toolbar tabs",
    "frame": "header masthead footer foot copyright legal colophon branding logo bottom contentinfo banner",
    "side": "sidebar side aside widget related recommended trending popular archive tags complementary more rail",
    "advert": "ad ads advert advertisement adsense sponsor sponsored promo promotion promoted commercial outbrain taboola dfp",
    "notice": "cookie cookies consent gdpr popup modal overlay paywall newsletter subscribe signup",
    "caution": "notice alert warning disclaimer info note tip message",
    "comment": "comment comments reply replies respond discussion disqus commentlist thread reader responses",
    "form": "form search login signin register contact share social follow buttons",
    "text": "article content post entry story main body text prose article-body post-content entry-content hentry",
}
WORD_OF = {w: k for k, ws in WORDS.items() for w in ws.split()}
#: Words that say nothing about a part of a page when they stand beside one that does (fixed vocabulary).
GENERIC = frozenset("box list block container wrapper wrap area section item items bar bars link links inner outer group holder panel module page site title icon button btn left right center top row col column js id x the and".split())
GROUPS = tuple(WORDS)
#: Groups that name a part other than the text; "caution" marks texts as well as notices.
BOILER = frozenset(GROUPS) - {"text", "caution"}
TEXTUAL = frozenset(("p", "h", "list", "li", "quote", "table", "inline"))
RELATIONS = ("container", "text", "boiler")
NAMES = (
    "bias", *(f"kind={k}" for k in KINDS), *(f"word={g}" for g in GROUPS), *(f"part={g}" for g in GROUPS), "links<.1", "links<.5", "links>=.5", "no text", "short", "medium", "long", "sentence", "first h1", "under article", "many words below",
    "under boiler", "links below", "run", "holds run", "bare text", "bare run", "great share", "boiler title", "before boiler", "after run", "list under article",
)
INDEX = {n: i for i, n in enumerate(NAMES)}


def name_groups(value: str) -> set[str]:
    """Groups that class names, ids or roles belong to: ``word:g`` if the whole name says so, ``part:g`` if other words stand beside it."""
    found = set()
    for name in value.split():
        words = [w for w in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", name).lower()) if w]
        known = {WORD_OF[w] for w in words if w in WORD_OF}
        other = any(w not in WORD_OF and w not in GENERIC and len(w) > 1 for w in words)
        found |= {f"{'part' if other else 'word'}:{g}" for g in known}
    return found


class Page:
    """Nodes in document order: parent, features and relation; text pieces with their node."""

    __slots__ = ("features", "label", "parent", "pieces", "relation")

    def __init__(self, source: str) -> None:
        self.parent, self.pieces, self.label = [-1], [], [0]
        kinds, groups, own_text, own_links, hidden = ["body"], [set()], [[]], [0], [False]
        stack: list[tuple[str, int, int, bool]] = [("#root", 0, 0, False)]  # tag, node, depth of links, block
        at, end = 0, len(source)

        def put(raw: str) -> None:
            if not raw:
                return
            text = entities.unescape(raw) if "&" in raw else raw
            _, node, links, _ = stack[-1]
            if not hidden[node]:
                self.pieces.append((node, text))
                own_text[node].append(text)
                if links:
                    own_links[node] += len(text.strip())

        def gap() -> None:
            self.pieces.append((-1, " "))

        while at < end:
            m = TOKEN.search(source, at)
            if not m:
                put(source[at:])
                break
            put(source[at : m.start()])
            at = m.end()
            if m["cdata"]:
                put(m["cdata"])
            if not m["tag"]:
                continue
            tag = m["tag"].lower()
            if m["end"]:
                if tag == "p" and all(s[0] != "p" for s in stack):
                    gap()
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == tag:
                        if any(s[3] for s in stack[i:]):
                            gap()
                        del stack[i:]
                        break
                    if tag in INLINE and stack[i][0] in WALLS:
                        break
                continue
            rest = m["rest"]
            if stack[-1][0] == "head" and tag not in HEAD:  # </head> may be left out
                del stack[-1]
            if tag in RAW:
                if not rest.rstrip().endswith("/"):
                    close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(source, at)
                    at = close.end() if close else end
                if tag not in ("svg", "math"):
                    gap()
                continue
            if tag in VOID:
                if tag in ("br", "hr"):
                    gap()
                continue
            block = tag not in INLINE
            if block:
                gap()
                closes = CLOSES.get(tag)
                for i in range(len(stack) - 1, 0, -1):
                    name = stack[i][0]
                    if name == "p" and not closes or closes and name in closes:
                        del stack[i:]
                        break
                    if name in WALLS and not (closes and name in ("td", "th") and tag == "tr"):
                        break
            words: set[str] = set()
            gone = False
            if rest and ("=" in rest or "hidden" in rest):
                for a in ATTRIBUTE.finditer(rest):
                    key, named = (a[1] or "").lower(), a[2] or a[3] or a[4] or ""
                    value = named.lower()
                    if key in ("class", "id", "role"):
                        words |= name_groups(named)
                    elif key == "style":
                        gone |= "display:none" in value.replace(" ", "")
                    elif key == "hidden":
                        gone |= value != "until-found"
                    elif key == "aria-hidden":
                        gone |= value == "true"
            _, above, links, _ = stack[-1]
            links += tag == "a"
            if block or words:
                node = len(self.parent)
                self.parent.append(above)
                self.label.append(int('data-y="1"' in rest))
                kinds.append("inline" if not block else KIND_OF.get(tag, "other"))
                if tag == "h1" and "h1" not in groups[0]:
                    groups[0].add("h1")
                    words = words | {"h1"}
                groups.append(words)
                own_text.append([])
                own_links.append(0)
                hidden.append(gone or hidden[above] or tag == "head")
                stack.append((tag, node, links, block))
            else:
                stack.append((tag, above, links, False))
        self._describe(kinds, groups, own_text, own_links)

    def _describe(self, kinds, groups, own_text, own_links) -> None:
        n = len(self.parent)
        parent = self.parent
        chars = [sum(map(len, t)) for t in own_text]
        texts = [" ".join(own_text[i]).strip() if chars[i] else "" for i in range(n)]
        named = [{g[5:] for g in gs if g.startswith("word:")} for gs in groups]
        below, linked, inside, boiled = chars[:], own_links[:], [False] * n, [False] * n
        marked = [kinds[i] in ("nav", "footer", "aside", "form") or bool(named[i] & BOILER) for i in range(n)]
        # paragraphs side by side; of text that is not a link
        paragraphs, last_child, before = [0] * n, [-1] * n, [False] * n
        plain = [kinds[i] in ("p", "quote") and len(texts[i]) - own_links[i] >= 40 and not marked[i] for i in range(n)]
        for i in range(1, n):
            paragraphs[parent[i]] += plain[i]
            if marked[i] and last_child[parent[i]] > 0 and kinds[last_child[parent[i]]] == "h":
                before[last_child[parent[i]]] = True  # a heading right in front of a marked part
            last_child[parent[i]] = i
        for i in range(n - 1, 0, -1):
            below[parent[i]] += below[i]
            linked[parent[i]] += linked[i]
        total = max(1, below[0])
        bare = not any(k in ("article", "main") for k in kinds) and not any("text" in g for g in named)
        self.features, self.relation = [], []
        ran: set[int] = set()  # parents whose run of paragraphs has begun
        for i in range(n):
            up = parent[i]
            inside[i] = up >= 0 and (inside[up] or kinds[up] in ("article", "main"))
            boiled[i] = up >= 0 and (boiled[up] or marked[up])
            f = [0, INDEX[f"kind={kinds[i]}"]]
            f += [INDEX[g.replace(":", "=")] for g in groups[i] if g != "h1"]
            text = texts[i]
            if not text:
                f.append(INDEX["no text"])
            else:
                share = own_links[i] / max(1, len(text))
                f.append(INDEX["links<.1" if share < 0.1 else "links<.5" if share < 0.5 else "links>=.5"])
                f.append(INDEX["short" if len(text) < 40 else "medium" if len(text) < 160 else "long"])
                if text[-1] in ".!?…\"”'":
                    f.append(INDEX["sentence"])
                if chars[i] * 10 >= total:
                    f.append(INDEX["great share"])
            told = {
                "first h1": i and "h1" in groups[i], "under article": inside[i], "many words below": below[i] * 2 >= total, "under boiler": boiled[i],
                "links below": below[i] and linked[i] * 2 >= below[i], "run": up >= 0 and plain[i] and paragraphs[up] >= 2, "holds run": paragraphs[i] >= 2,
                "bare text": bare and not boiled[i] and not marked[i] and (kinds[i] in TEXTUAL or bool(text)) and linked[i] * 2 < max(1, below[i]), "bare run": bare and paragraphs[i] >= 1 and not boiled[i] and not marked[i],
                "boiler title": kinds[i] == "h" and len(text) < 40 and any(WORD_OF.get(w) in BOILER for w in re.split(r"[^a-z]+", text.lower())) and bool(text), "before boiler": before[i],
                "after run": up >= 0 and up in ran and not plain[i], "list under article": inside[i] and not boiled[i] and kinds[i] in ("list", "li"),
            }
            f += [INDEX[name] for name, holds in told.items() if holds]
            if up >= 0 and plain[i]:
                ran.add(up)
            self.features.append(f)
            boiler = kinds[i] in ("nav", "header", "footer", "aside", "form") or bool(named[i] & BOILER)
            self.relation.append(2 if boiler else 1 if kinds[i] in ("p", "h", "li", "quote", "inline") else 0)


def marginals(page: Page, unary: list[float], edge: list[list[float]]) -> tuple[list[float], list[tuple[float, ...]], float]:
    """Content marginals, pair marginals (per node with its parent) and log partition, by sum-product.

    ``unary`` weighs features for the content state (the other state has score 0); ``edge[r]`` holds the
    log potentials of (parent, child) states in the order 00, 01, 10, 11.
    """
    n, parent = len(page.parent), page.parent
    score = [sum(unary[k] for k in f) for f in page.features]
    in0, in1 = [0.0] * n, score[:]
    up0, up1 = [0.0] * n, [0.0] * n
    for i in range(n - 1, 0, -1):  # upward: children come after their parents in document order
        e = edge[page.relation[i]]
        a, b = in0[i], in1[i]
        x, y = e[0] + a, e[1] + b
        up0[i] = (x + math.log1p(math.exp(y - x))) if x > y else (y + math.log1p(math.exp(x - y)))
        x, y = e[2] + a, e[3] + b
        up1[i] = (x + math.log1p(math.exp(y - x))) if x > y else (y + math.log1p(math.exp(x - y)))
        in0[parent[i]] += up0[i]
        in1[parent[i]] += up1[i]
    a, b = in0[0], in1[0]
    log_z = max(a, b) + math.log1p(math.exp(-abs(a - b)))
    out0, out1, pairs = in0[:], in1[:], [(0.0, 0.0, 0.0, 0.0)] * n
    for i in range(1, n):  # downward
        p, e = parent[i], edge[page.relation[i]]
        d0, d1 = out0[p] - up0[i], out1[p] - up1[i]
        x = (d0 + e[0] + in0[i] - log_z, d0 + e[1] + in1[i] - log_z, d1 + e[2] + in0[i] - log_z, d1 + e[3] + in1[i] - log_z)
        pairs[i] = q = tuple(math.exp(min(0.0, v)) for v in x)
        out0[i] = log_z + math.log(max(q[0] + q[2], 1e-300))
        out1[i] = log_z + math.log(max(q[1] + q[3], 1e-300))
    return [math.exp(min(0.0, v - log_z)) for v in out1], pairs, log_z


def labelled_pages(count: int = 160, seed: int = 11) -> list[str]:
    """Labelled training pages from a grammar of page parts; ``data-y`` marks content elements."""
    r = random.Random(seed)
    stems = ["al", "ber", "con", "dor", "el", "fin", "gra", "hu", "ist", "jo", "ka", "lor", "mi", "nu", "or"]

    def words(lo: int, hi: int, stop: bool = True) -> str:
        out = " ".join("".join(r.choice(stems) for _ in range(r.randint(1, 4))) for _ in range(r.randint(lo, hi)))
        return out.capitalize() + ("." if stop else "")

    def links(n: int, tag: str = "li") -> str:
        return "".join(f"<{tag}><a href='/{i}'>{words(1, 2, False)}</a></{tag}>" for i in range(n))

    def odd() -> str:
        """Names on content that hold a word of another part, or say nothing."""
        if r.random() < 0.85:
            return ""
        other = r.choice(stems) + r.choice(stems)
        word = r.choice([w for g in ("side", "form", "frame", "menu", "notice", "comment", "advert") for w in WORDS[g].split()])
        return f" class='{r.choice([f'{word}-{other}', f'{other}-{word}', other, 'lead', 'warning', 'note', 'info', 'alert'])}'"

    def body(y: int, least: int = 1) -> str:
        mark, parts = f' data-y="{y}"', []
        for _ in range(r.randint(least, r.choice([least, 4, 8]))):
            kind = r.random()
            if kind < 0.62:
                text = words(r.choice([1, 4, 8]), r.choice([8, 30, 70]), r.random() < 0.85)
                parts.append(f"<p{mark}{odd()}>{'<b>' * (r.random() < 0.2)}{text}" + "</p>" * (r.random() < 0.8))
            elif kind < 0.65:
                parts.append(f"<ul{mark}>" + "".join(f"<li{mark}><a href='/{i}'>{words(2, 8, r.random() < 0.3)}</a></li>" for i in range(r.randint(1, 5))) + "</ul>")
            elif kind < 0.67:
                parts.append(f"<section{mark}{odd()}><h2{mark}>{words(1, 5, False)}</h2><p{mark}>{words(4, 40)}</p></section>")
            elif kind < 0.72:
                parts.append(f"<ul{mark}>" + "".join(f"<li{mark}>{words(2, 25)}</li>" for _ in range(r.randint(1, 4))) + "</ul>")
            elif kind < 0.82:
                parts.append(f"<h2{mark}>{words(1, 6, False)}</h2>")
            elif kind < 0.88:
                parts.append(f"<blockquote{mark}><p{mark}>{words(8, 30)}</p></blockquote>")
            elif kind < 0.94:
                parts.append(f"<p{mark}>{words(5, 20)} <a href='/x'>{words(1, 3, False)}</a> {words(5, 20)}</p>")
            else:
                parts.append(f"<table{mark}><tr{mark}><td{mark}>{words(1, 3, False)}</td><td{mark}>{words(1, 6, False)}</td></tr></table>")
        return "".join(parts)

    def boiler() -> str:
        return r.choice([
            lambda: f"<div class='{r.choice(['ad', 'ads', 'advert', 'sponsored', 'promo'])}'>{words(3, 25)}</div>",
            lambda: f"<aside class='{r.choice(['sidebar', 'related', 'widget'])}'><h3>{words(1, 3, False)}</h3><ul>{links(r.randint(1, 5))}</ul><p>{words(2, 20)}</p></aside>",
            lambda: f"<div id='{r.choice(['cookie-notice', 'consent', 'newsletter', 'cookie'])}'><p>{words(4, 25)}</p><button>{words(1, 2, False)}</button></div>",
            lambda: f"<form class='{r.choice(['search', 'subscribe', 'login', 'x'])}'><label>{words(1, 4, False)}</label><p>{words(2, 12)}</p></form>",
            lambda: f"<div class='{r.choice(['share', 'social', 'tags', 'breadcrumb'])}'>{links(3, 'span')}</div>",
            lambda: f"<aside><p>{words(4, 40)}</p><p>{words(4, 40)}</p></aside>",
            lambda: f"<div class='{r.choice(['alert', 'notice', 'site-notice', 'warning message'])}'>{r.choice(['<p>', ''])}{words(3, 20)}</div>",
            lambda: f"<div><h3>{r.choice(['Related posts', 'Popular', 'Share this', 'More', 'Trending', 'Tags'])}</h3><ul>{links(r.randint(2, 6))}</ul></div>",
            lambda: f"<div>{links(r.randint(3, 8), 'span')}</div>",
        ])()

    def comments() -> str:
        box, one = r.choice(["section", "div", "ol"]), r.choice(["div", "li", "article", "p"])
        head = r.choice([words(1, 2, False), "Comments", f"{r.randint(1, 90)} Comments", "Discussion", "Leave a reply", "Replies"])
        name = r.choice([f" {r.choice(['class', 'id'])}='{r.choice(['comments', 'comment-list', 'replies', 'discussion'])}'"] * 3 + [""])
        return f"<{box}{name}><h3>{head}</h3>" + "".join(f"<{one} class='comment'><p>{words(3, 50)}</p></{one}>" for _ in range(r.randint(1, 5))) + f"</{box}>"

    pages = []
    for _ in range(count):
        head = r.choice([f"<nav><ul>{links(r.randint(3, 8))}</ul></nav>", f"<header><a href='/'>{words(1, 3, False)}</a><nav><ul>{links(4)}</ul></nav></header>", f"<div class='{r.choice(['header', 'masthead', 'navbar'])}'><p>{words(1, 8, False)}</p>{links(4, 'span')}</div><ul class='menu'>{links(4)}</ul>", f"<header><p>{words(2, 12)}</p></header>", ""])
        foot = r.choice([f"<footer>&copy; {words(2, 14)}</footer>", f"<footer><p>{words(3, 30)}</p><ul>{links(3)}</ul></footer>", f"<div id='footer'>{words(3, 20)}<p>{words(3, 20)}</p></div>"])
        title = f'<h1 data-y="1">{words(1, 14, False)}</h1>'
        title = r.choice([title, title, f'<header data-y="1">{title}</header>', ""])
        inner = body(1)
        if r.random() < 0.35:
            inner += boiler() + body(1)
        if r.random() < 0.2:
            inner += comments()
        shape = r.random()
        if shape < 0.55:
            main = f'<article data-y="1">{title}{inner}</article>'
        elif shape < 0.7:
            main = f'<main data-y="1"><article data-y="1">{title}{inner}</article></main>'
        elif shape < 0.8:
            main = f'<main data-y="1">{title}{inner}</main>'
        elif shape < 0.87:
            main = f'<div class="{r.choice(["content", "post", "entry", "article-body", "story", "page-content", "post-body"])}" data-y="1">{title}{inner}</div>'
        elif shape < 0.91:
            main = f'<div data-y="1">{title}{inner}{body(1)}</div>'
        elif shape < 0.95:  # straight in the body
            main = f"{title}{inner}{body(1, 2)}"
        else:  # plain containers
            deep = r.randint(1, 3)
            names = r.choice([["container", "row", "col"], ["wrap", "inner", "col-md-8"], ["", "", ""]])[:deep]
            open_ = "".join(f'<div class="{n}" data-y="1">' if n else '<div data-y="1">' for n in names)
            text = r.choice([f"{title}{inner}{body(1)}", "".join(f'<div data-y="1">{words(8, 50)}</div>' for _ in range(r.randint(2, 4)))])
            main = f"{open_}{text}{'</div>' * deep}"
        parts = [boiler() for _ in range(r.randint(0, 2))]
        tail = [boiler() for _ in range(r.randint(0, 2))] + [comments()] * (r.random() < 0.3)
        whole = f"{head}{''.join(parts)}{main}{''.join(tail)}{foot}"
        if r.random() < 0.25:
            whole = f"<div id='{r.choice(['page', 'wrapper', 'container'])}'>{whole}</div>"
        # a body holds content only if text stands straight in it
        pages.append(f"<html><head><title>{words(2, 5)}</title></head><body>{whole}</body></html>")
    return pages


@lru_cache(maxsize=4)
def fit(count: int = 160, seed: int = 11, steps: int = 150, rate: float = 0.5, ridge: float = 2e-3) -> tuple[list[float], list[list[float]]]:
    """Maximum-likelihood weights from the labelled pages: observed minus expected counts, by sum-product."""
    pages = [Page(p) for p in labelled_pages(count, seed)]
    unary, edge = np.zeros(len(NAMES)), np.zeros((len(RELATIONS), 4))
    seen_u, seen_e = np.zeros_like(unary), np.zeros_like(edge)
    for page in pages:
        for i, f in enumerate(page.features):
            if page.label[i]:
                seen_u[f] += 1
            if i:
                seen_e[page.relation[i], 2 * page.label[page.parent[i]] + page.label[i]] += 1
    nodes = sum(len(p.parent) for p in pages)
    past_u, past_e = np.full_like(unary, 1e-8), np.full_like(edge, 1e-8)
    for _ in range(steps):
        want_u, want_e = np.zeros_like(unary), np.zeros_like(edge)
        u, e = unary.tolist(), edge.tolist()
        for page in pages:
            content, pairs, _ = marginals(page, u, e)
            for i, f in enumerate(page.features):
                want_u[f] += content[i]
                if i:
                    want_e[page.relation[i]] += pairs[i]
        grad_u, grad_e = (seen_u - want_u) / nodes - ridge * unary, (seen_e - want_e) / nodes - ridge * edge
        past_u += grad_u**2
        past_e += grad_e**2
        unary += rate * grad_u / np.sqrt(past_u)
        edge += rate * grad_e / np.sqrt(past_e)
    return unary.tolist(), edge.tolist()


def main_text(source: str | None, model: tuple[list[float], list[list[float]]]) -> str:
    """Main text of one page under a fitted model."""
    if not source:
        return ""
    page = Page(source)
    content = marginals(page, *model)[0]
    out: list[str] = []
    for node, text in page.pieces:
        out.append(" " if node < 0 else text if content[node] >= 0.5 else "")
    return SPACES.sub(" ", "".join(out)).strip(" ")


def extract_main_text(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` columns, ``text`` and ``n_chars`` for every row of ``pages``; one pass without a shuffle."""
    model = fit()
    schema = with_fields(pages.select(*keep).schema, "text string")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts = pa.array([main_text(s, model) for s in batch.column(len(keep)).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], texts], names=[*keep, "text"])

    found = pages.select(*keep, F.col(html).alias("_html")).mapInArrow(work, schema)
    return found.withColumn("n_chars", F.length("text").cast("long"))

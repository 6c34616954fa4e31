"""Main text of HTML pages: boosted trees over DOM nodes, decoded as a tree.

Each element gets features of its subtree (text, links, tags, density), its own
and its ancestors' names and attribute tokens, depth and siblings. Boosted
trees give the log odds that its text belongs to the article. Decoding chooses
one state for each element - article, dropped, or a container around both -
with the best total under the rule that everything in a dropped element is
dropped and an article holds no containers, so no kept element lies in a
dropped one.

The model is learned from at most ``SAMPLE_PAGES`` pages (least hashes of id
and page) of those with up to ``SAMPLE_CHARS`` characters whose markup says where
the article is (``article`` or ``main``), however few they are. Each is also rebuilt in other layouts: its
article, or one of any block elements (lists, tables, quotes, code; from a word
or two to many blocks), in plain containers with usual names, and side bars, notices, forms,
adverts and comments made of other pages' sentences around and inside it, so
that text alone tells nothing. Without such a page, a fixed rule over the
same features stands in.

Null pages and pages without article text give an empty text.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import Boosted
from .common import slices, texts_of
from .dom import SILENT, Page, blocks_of, parse

SAMPLE_PAGES, SAMPLE_CHARS, LAYOUTS = 240, 200_000, 6
#: What dropping an element inside an article costs, and beginning an article, in log odds.
CUT, BEGIN = 12.0, 3.0

# Element groups and attribute tokens that are features.
TAG_GROUPS = {
    "article": "article main", "nav": "nav menu", "header": "header hgroup", "footer": "footer address", "aside": "aside dialog", "section": "section",
    "div": "div center span", "p": "p", "heading": "h1 h2 h3 h4 h5 h6", "list": "ul ol dl", "item": "li dt dd", "link": "a",
    "form": "form fieldset legend label input textarea select button option search", "table": "table thead tbody tfoot tr td th caption",
    "inline": "b i em strong u s small sub sup mark q cite code kbd abbr time font br img", "quote": "blockquote pre figure figcaption details summary",
    "root": "html body #page",
}
TOKEN_GROUPS = {
    "main": "article content main post entry story text body blog prose read",
    "title": "title headline heading lead intro summary",
    "nav": "nav navigation navbar menu breadcrumb breadcrumbs pager pagination toc tabs skip",
    "header": "header masthead topbar top logo brand banner hero",
    "footer": "footer foot bottom copyright legal colophon imprint",
    "side": "sidebar side aside widget widgets rail secondary column complementary",
    "advert": "ad ads adv advert advertisement adsense sponsor sponsored promo promotion promoted outbrain taboola commercial",
    "notice": "cookie cookies consent gdpr notice notices alert warning popup modal overlay dialog toast message banner disclaimer paywall",
    "form": "form search login signin signup register newsletter subscribe subscription contact input",
    "comment": "comment comments commentlist respond reply replies discussion disqus reaction reactions feedback review reviews",
    "share": "share sharing social facebook twitter follow like likes",
    "related": "related recommended recommendation more also popular trending latest read-next tags tagged categories archive",
    "meta": "meta byline author date published timestamp info",
}
_TAG_BIT = {t: 1 << k for k, ts in enumerate(TAG_GROUPS.values()) for t in ts.split()}
_TOKEN_BIT: dict[str, int] = {}
for _k, _ts in enumerate(TOKEN_GROUPS.values()):
    for _t in _ts.split():
        _TOKEN_BIT[_t] = _TOKEN_BIT.get(_t, 0) | 1 << _k
_GROUPS = len(TAG_GROUPS), len(TOKEN_GROUPS)
_LINK, _P = _TAG_BIT["a"], _TAG_BIT["p"]


# ---------------------------------------------------------------- features
def features(pages: list[Page]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A row for each element of all pages, its own text's length, and where
    each page's elements begin (one more entry than pages)."""
    first = np.cumsum([0, *[len(p.tag) for p in pages]])
    n = int(first[-1])
    shift = np.repeat(first[:-1], np.diff(first))
    parent = np.fromiter((i for p in pages for i in p.parent), np.int64, n)
    root = parent < 0
    parent = np.where(root, np.arange(n), parent + shift)
    end = np.fromiter((i for p in pages for i in p.end), np.int64, n) + shift
    tag = np.fromiter((_TAG_BIT.get(t, 0) for p in pages for t in p.tag), np.int64, n)
    bits = []
    for p in pages:
        for names in p.names:
            b = 0
            for t in names:
                b |= _TOKEN_BIT.get(t, 0)
            bits.append(b)
    token = np.array(bits, np.int64)
    owner, chars, words, marks = [], [], [], []
    for p, at in zip(pages, first.tolist()):
        for o, text, _ in p.runs:
            owner.append(o + at)
            chars.append(len(text.strip()))
            words.append(text.count(" ") + 1)
            marks.append(text.count(".") + text.count(",") + text.count("!") + text.count("?"))
    own, own_words, own_marks = (np.bincount(np.array(owner, np.int64), np.array(v, float), n) for v in (chars, words, marks))

    def under(v: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0.0], np.cumsum(v)])
        return total[end] - total[np.arange(n)]

    above_tag, above_token, depth = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    level = np.flatnonzero(root)
    order = _by_depth(parent, root)
    for level in order[1:]:
        up = parent[level]
        above_tag[level] = above_tag[up] | tag[up]
        above_token[level] = above_token[up] | token[up]
        depth[level] = depth[up] + 1
    linked = under(np.where(((above_tag | tag) & _LINK) > 0, own, 0.0))
    text, nodes = under(own), under(np.ones(n))
    page_text = np.maximum(np.repeat(text[first[:-1]], np.diff(first)), 1) if n else text
    before = (np.cumsum(own) - own) - np.repeat((np.cumsum(own) - own)[first[:-1]], np.diff(first)) if n else text
    siblings = np.bincount(parent[~root], minlength=n)[parent].astype(float)
    rank = _sibling_rank(parent, root)
    longest = np.zeros(n)
    np.maximum.at(longest, parent[~root], text[~root])
    up_text = np.maximum(text[parent], 1)
    numbers = np.stack([
        depth, rank, siblings, rank / np.maximum(siblings, 1), np.log1p(own), np.log1p(text), text / page_text, linked / np.maximum(text, 1),
        under(own_words) / nodes, under(own_marks) / np.maximum(text, 1), 100 * nodes / np.maximum(text, 10), under((tag & _P > 0).astype(float)),
        before / page_text, text / up_text, longest[parent] / up_text, np.log1p(longest[parent]), np.log1p(text[parent]),
    ], axis=1).astype(np.float32)
    flags = [((m[:, None] >> np.arange(k)) & 1).astype(np.float32) for m, k in ((tag, _GROUPS[0]), (above_tag, _GROUPS[0]), (token, _GROUPS[1]), (above_token, _GROUPS[1]))]
    return np.concatenate([numbers, *flags], axis=1), own, first


def _by_depth(parent: np.ndarray, root: np.ndarray) -> list[np.ndarray]:
    depth = np.zeros(len(parent), np.int64)
    for i, (p, r) in enumerate(zip(parent.tolist(), root.tolist())):
        if not r:
            depth[i] = depth[p] + 1
    order = np.argsort(depth, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)


def _sibling_rank(parent: np.ndarray, root: np.ndarray) -> np.ndarray:
    key = np.where(root, -1, parent)
    order = np.argsort(key, kind="stable")
    starts = np.concatenate([[True], np.diff(key[order]) != 0]) if len(key) else np.zeros(0, bool)
    at = np.arange(len(key))
    rank = np.zeros(len(key))
    rank[order] = at - np.maximum.accumulate(np.where(starts, at, 0)) if len(key) else rank
    rank[root] = 0
    return rank


# ---------------------------------------------------------------- decoding
def decode(page: Page, odds: list[float], own: list[float]) -> list[bool]:
    """Whether each element's own text is kept, by the best total of states."""
    n = len(page.tag)
    article, dropped, around = [0.0] * n, [0.0] * n, [0.0] * n
    weight = [0.05 + min(6.0, np.log1p(x)) for x in own]
    for i in range(n - 1, -1, -1):
        gain = -30.0 if page.tag[i] in SILENT else weight[i] * odds[i]
        article[i] += gain
        dropped[i] -= gain
        around[i] -= gain + 0.01                     # a container's own text is not the article's
        p = page.parent[i]
        if p >= 0:
            a, d = article[i], dropped[i]
            article[p] += max(a, d - CUT)
            dropped[p] += d
            around[p] += max(a - BEGIN, d, around[i])
    state = [0] * n
    for i in range(n):
        p = page.parent[i]
        allowed = (article[i] - BEGIN, dropped[i], around[i]) if p < 0 or state[p] == 2 else (article[i], dropped[i] - CUT) if state[p] == 0 else None
        state[i] = 1 if allowed is None else max(range(len(allowed)), key=lambda k: (allowed[k], -k))
    return [s == 0 for s in state]


# ---------------------------------------------------------------- learning
_ARTICLE = re.compile(r"<article[^>]*>(?!</article>)(.*?)</article>|<main[^>]*>(?!</main>)(.*?)</main>", re.S | re.I)
_LABEL = re.compile("data-y", re.I)
_TEXT_BIT = re.compile(r"[^.<>&]{12,160}\.")
# Names that sites give to containers of an article, and to what surrounds one.
_MAIN_NAMES = ["content", "post-content", "entry-content", "article-body", "main-content", "story", "post", "text", "blog-post", "page-content", "articleBody", "prose"]
_AROUND = {
    "side": ["sidebar", "side-bar", "widget", "right-rail", "secondary"], "advert": ["ad", "ads", "advert", "sponsored", "promo", "ad-slot"],
    "notice": ["cookie-notice", "cookie-banner", "consent", "alert", "notice", "popup", "gdpr"], "comment": ["comments", "comment-list", "comment", "discussion", "replies", "respond"],
    "form": ["newsletter", "subscribe", "login", "search-form", "contact-form"], "share": ["share", "social", "follow-us"],
    "related": ["related", "related-posts", "recommended", "more-stories", "popular", "tags"], "nav": ["nav", "menu", "breadcrumbs", "main-menu", "pagination"],
    "header": ["site-header", "header", "masthead", "topbar"], "footer": ["footer", "site-footer", "copyright", "legal"],
}


def _surround(kind: str, rng: random.Random, say) -> str:
    name, plain = rng.choice(_AROUND[kind]), rng.random() < 0.5
    where = f'{rng.choice(["class", "id"])}="{name}" data-y="0"'
    links = "".join(f'<li><a href="/x">{say()[:40]}</a></li>' for _ in range(rng.randint(2, 7)))
    short = rng.random() < 0.3
    text = "".join(f"<p>{say()[: rng.randint(8, 40)] if short else say()}</p>" for _ in range(rng.randint(1, 3)))
    tag = {"side": "aside", "nav": "nav", "header": "header", "footer": "footer", "form": "form", "comment": "section"}.get(kind, "div")
    bare = rng.random() < 0.4 and tag not in ("div", "section")       # the element's own name has to do
    head = f"<{tag} data-y=\"0\">" if bare else f"<{tag if plain else 'div'} {where}>"
    tail = f"</{tag}>" if bare or plain else "</div>"
    inside = {
        "nav": f"<ul>{links}</ul>", "header": f"<a href='/'>{say()[:30]}</a><p>{say()[:60]}</p>", "footer": rng.choice([f"&copy; {say()}", f"<p>{say()}</p><ul>{links}</ul>"]),
        "side": rng.choice([f"<h3>{say()[:30]}</h3><ul>{links}</ul>", f"<h2>{say()[:30]}</h2>{text}", text]), "advert": rng.choice([say(), f"<a href='/b'>{say()}</a>", text]),
        "notice": rng.choice([say(), f"<p>{say()}</p><button>OK</button>"]), "related": f"<h3>{say()[:30]}</h3><ul>{links}</ul>", "share": f"<ul>{links}</ul>",
        "form": f"<label>{say()[:30]}</label><input type='text'><p>{say()}</p><button>{say()[:12]}</button>",
        "comment": "<h3>" + say()[:30] + "</h3>" + "".join(rng.choice([f'<div class="comment"><p>{say()} {say()}</p></div>', f"<p><b>{say()[:12]}</b> {say()}</p>", f"<ul><li>{say()}</li></ul>"]) for _ in range(rng.randint(1, 5))),
    }[kind]
    return head + inside + tail


def _varied(rng: random.Random, say) -> str:
    """An article's inner markup of any block elements, from a word or two to many blocks."""

    def line(most: int = 200) -> str:
        return say()[: rng.randint(2, most)].strip() or "."

    def text() -> str:
        out = rng.choice([line(40), line(), say(), say() + " " + say()])
        return rng.choice([out, out, f"{out} <a href='/r'>{line(30)}</a> {line(60)}", f"<b>{line(20)}</b> {out}", f"{out}<br>{say()}", f"{out} <code>{line(12)}</code>."])

    def items(tag: str = "li") -> str:
        linked = rng.random() < 0.3
        return "".join(f"<{tag}>" + (f'<a href="/r">{line(40)}</a>' if linked else rng.choice([line(40), text(), f"<p>{text()}</p>"])) + f"</{tag}>" for _ in range(rng.randint(1, 6)))

    def table() -> str:
        width = rng.randint(2, 4)
        rows = [f"<tr>{''.join(f'<td>{line(20)}</td>' for _ in range(width))}</tr>" for _ in range(rng.randint(1, 5))]
        head = f"<tr>{''.join(f'<th>{line(12)}</th>' for _ in range(width))}</tr>"
        return f"<table>{rng.choice(['', '<caption>' + line(40) + '</caption>'])}{head}{''.join(rows)}</table>"

    makers = {
        "p": lambda: f"<p>{text()}</p>", "h": lambda: f"<h2>{line(50)}</h2>", "ul": lambda: f"<ul>{items()}</ul>", "ol": lambda: f"<ol>{items()}</ol>",
        "pre": lambda: rng.choice([f"<pre>{line()}\n{line()}</pre>", f"<pre><code>{line(60)}\n{line(60)}</code></pre>"]), "table": table,
        "quote": lambda: f"<blockquote>{rng.choice([say(), f'<p>{say()}</p>'])}</blockquote>", "dl": lambda: "<dl>" + "".join(f"<dt>{line(20)}</dt><dd>{text()}</dd>" for _ in range(rng.randint(1, 3))) + "</dl>",
        "figure": lambda: f"<figure><img src='/i'><figcaption>{line(80)}</figcaption></figure>", "details": lambda: f"<details><summary>{line(20)}</summary><p>{text()}</p></details>",
        "div": lambda: f"<div>{text()}</div>", "section": lambda: f"<section><h2>{line(40)}</h2><p>{text()}</p></section>",
    }
    some = ["p"] * 6 + list(makers)
    return "".join(makers[rng.choice(some)]() for _ in range(rng.choice([1, 1, 2, 3, 4, 6, 9])))


def _layout(body: str, rng: random.Random, say) -> str:
    """One page around an article's inner markup, labelled by ``data-y``."""
    paragraphs = re.split(r"(?=<p[ >])", body)
    if len(paragraphs) > 2 and rng.random() < 0.6:
        for kind in rng.sample(["advert", "related", "share", "notice", "form", "side", "side"], rng.randint(1, 2)):
            paragraphs.insert(rng.randint(1, len(paragraphs)), _surround(kind, rng, say))
    inner = "".join(paragraphs)
    if rng.random() < 0.4:
        inner += _surround("comment", rng, say)
    tag = rng.choice(["article", "main", "div", "div", "div", "section"])
    name = f' class="{rng.choice(_MAIN_NAMES)}"' if tag in ("div", "section") or rng.random() < 0.3 else ""
    main = f'<{tag}{name} data-y="1">{inner}</{tag}>'
    if rng.random() < 0.3:
        main = f"<main>{main}{_surround('comment', rng, say) if rng.random() < 0.5 else ''}</main>"
    over = [_surround(k, rng, say) for k in rng.sample(["header", "nav", "notice", "advert", "side", "form"], rng.randint(0, 4))]
    below = [_surround(k, rng, say) for k in rng.sample(["comment", "related", "side", "advert", "form", "notice", "share"], rng.randint(0, 4))] + [_surround("footer", rng, say)]
    if rng.random() < 0.4:
        main = f'<div class="{rng.choice(["wrapper", "container", "row", "page", "layout"])}">{main}{below.pop(0)}</div>'
    return f"<html><head><title>{say()}</title></head><body>{''.join(over)}{main}{''.join(below)}</body></html>"


# Elements and tokens by which the given markup itself says what is not the article.
_NOT_MAIN = frozenset("nav header footer aside form menu dialog".split())
_NOT_TOKENS = sum(1 << list(TOKEN_GROUPS).index(k) for k in ("advert", "notice", "comment", "share", "related", "side"))


def _labels(page: Page) -> list[int]:
    """1 in the article, 0 outside it, -1 where the markup does not say."""
    out: list[int] = []
    for i, t in enumerate(page.tag):
        up = out[page.parent[i]] if page.parent[i] >= 0 else -1
        bits = 0
        for token in page.names[i]:
            bits |= _TOKEN_BIT.get(token, 0)
        if page.label[i] is not None:
            up = int(page.label[i])
        elif t in _NOT_MAIN and up != 1 or bits & _NOT_TOKENS and up != 1:
            up = 0
        elif t == "article" and up == -1:
            up = 1
        out.append(up)
    return out


def learn(pages: DataFrame, page_id: str = "page_id", html: str = "html", sample: int = SAMPLE_PAGES) -> Boosted | None:
    """The node model, or None if no page of a length to be sampled marks its article."""
    rows = pages.select(F.xxhash64(F.col(page_id), F.col(html)).alias("k"), F.col(html).alias("h")).where(F.col("h").isNotNull() & (F.length("h") <= SAMPLE_CHARS))
    # the sample is picked by keys alone; only the pages picked reach the driver
    picked = rows.where(F.col("h").rlike("(?is)" + _ARTICLE.pattern)).select("k").distinct().orderBy("k").limit(sample)
    got = sorted(rows.join(F.broadcast(picked), "k").dropDuplicates(["k"]).collect())
    # a label that given pages write themselves is none
    marked = [(r["h"], _LABEL.sub("data-x", m[1] or m[2])) for r in got if (m := _ARTICLE.search(r["h"]))]
    rng = random.Random(11)
    sentences = [s.strip() for _, body in marked for s in _TEXT_BIT.findall(body)[:40]] or ["."]
    say = lambda: rng.choice(sentences)
    made = [parse(h, labelled=False) for h, _ in marked] + [parse(_layout(rng.choice([body, _varied(rng, say)]), rng, say)) for _, body in marked for _ in range(LAYOUTS)]
    if not made:
        return None
    x, own, _ = features(made)
    y = np.array([v for p in made for v in _labels(p)])
    known = y >= 0
    if not (y == 1).any() or not (y == 0).any():
        return None
    return Boosted().fit(x[known], y[known].astype(float), 0.2 + np.log1p(own[known]))


def _rule(x: np.ndarray) -> np.ndarray:
    """Log odds by a fixed rule, for want of a model."""
    k = x.shape[1] - 2 * sum(_GROUPS)
    tag, above = x[:, k : k + _GROUPS[0]], x[:, k + _GROUPS[0] : k + 2 * _GROUPS[0]]
    token = np.maximum(x[:, k + 2 * _GROUPS[0] : k + 2 * _GROUPS[0] + _GROUPS[1]], x[:, k + 2 * _GROUPS[0] + _GROUPS[1] :])
    groups, names = list(TAG_GROUPS), list(TOKEN_GROUPS)
    both = np.maximum(tag, above)
    bad = sum(both[:, groups.index(g)] for g in ("nav", "header", "footer", "aside", "form")) + sum(token[:, names.index(g)] for g in ("nav", "footer", "side", "advert", "notice", "form", "comment", "share", "related"))
    return 0.5 + 2 * both[:, groups.index("article")] - 4 * (bad > 0) - 3 * (x[:, 7] > 0.5)


# -------------------------------------------------------------- extraction
def extract_texts(htmls: list[str], model: Boosted | None) -> list[str]:
    pages = [parse(h, labelled=False) for h in htmls]
    x, own, first = features(pages)
    odds = (model.margin(x) if model else _rule(x)).tolist()
    own = own.tolist()
    return [blocks_of(p, decode(p, odds[a:b], own[a:b])) for p, a, b in zip(pages, first[:-1].tolist(), first[1:].tolist())]


def main_text(pages: DataFrame, model: Boosted | None, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``(page_id, url, text)`` per row."""
    src = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html", 4 << 20):
                texts = extract_texts(texts_of(part, "html"), shared.value)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return src.mapInArrow(run, src.drop("html").schema.add("text", "string"))

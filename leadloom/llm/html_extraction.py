"""Main text of web pages by a conditional random field over the leaf blocks of the DOM.

A page is read once into blocks: runs of text between block-level tags, each
with the tags and the class and id words of its ancestors. A linear-chain
conditional random field labels the blocks as main text or not, from features of
ancestors, text and links, and of the neighbours through its transitions; Viterbi
finds the best labelling.

The field is trained on labelled pages, which ``labelled_pages`` composes from
the layouts below: which parts are main text is known by construction. Training
is small, has a fixed seed and runs on the driver; pages are decoded in tasks.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# pages the field is trained on, and passes over them
TRAINING_PAGES, PASSES = 600, 12

_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr img".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# what these hold is no text of the page
_SILENT = frozenset("noscript template svg math iframe object head select textarea button canvas audio video".split())
# what may be in the head, whose end tag may be left out, and in the options of a list
_HEAD, _OPTIONS = frozenset("title base link meta noscript template".split()), frozenset(("option", "optgroup"))
# tags that an opening tag of the same group ends
_ENDS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
         "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


def _token_pattern() -> re.Pattern:
    # only scripts, styles and comments run to the page's end without an end tag; in a textarea and an iframe tags are text
    return re.compile(
        r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
        r"|<(script|style)\b[^>]*?(?:/>|>.*?(?:</\1\s*>|\Z))"
        r"|<(textarea|iframe)\b[^>]*?(?:/>|>(?:(?!<\2\b).)*?</\2\s*>)"
        r"|<(/?)([a-z][a-z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)",
        re.I | re.S,
    )


def _silent_end(html: str, start: re.Match, token: re.Pattern, outside: set[str], known: dict[int, int]) -> int:
    """Where a silent element ends, or -1 if an ancestor or the page ends before its own end tag comes.

    ``known`` keeps the ends of the silent elements on the way, so that none is looked for twice.
    """
    if start.start() not in known:
        inner = [(start.group(4).lower(), start.start())]
        for m in token.finditer(html, start.end()):
            name = (m.group(4) or "").lower()
            if not name or name in _INLINE or name in _VOID:
                continue
            if not m.group(3):
                if not m.group(5).endswith("/"):
                    inner.append((name, m.start()))
            elif any(n == name for n, _ in inner):
                while inner[-1][0] != name:
                    known[inner.pop()[1]] = -1
                known[inner.pop()[1]] = m.end()
                if not inner:
                    break
            elif name in outside:
                break
        known.update((place, -1) for _, place in inner)
    return known[start.start()]


def _head_end(html: str, start: re.Match, token: re.Pattern, known: dict[int, int]) -> int:
    """Where the head ends: after its end tag, or before the first tag that cannot be in it."""
    title = re.compile(r"(?:(?!<(?:title|body)\b).)*?</title\s*>", re.I | re.S)
    at = start.end()
    while m := token.search(html, at):
        at = m.end()
        name = (m.group(4) or m.group(2) or "").lower()
        if not name or m.group(3) and name != "head":
            continue
        if m.group(3):
            return at
        if name not in _HEAD:
            return m.start()
        if name == "title" and (text := title.match(html, at)):
            at = text.end()
        elif name in _SILENT and not m.group(5).endswith("/"):
            at = max(at, _silent_end(html, m, token, {"head", "html"}, known))
    return len(html)


def blocks_of(html: str, token: re.Pattern, attribute: re.Pattern) -> list[tuple[str, int, tuple]]:
    """``(text, characters in links, ancestors)`` of every leaf block in page order.

    An ancestor is its tag with its class, id and role words. White space inside a
    block is one space; character references are decoded; empty blocks are left out.
    A silent element without its end tag holds what comes up to the next block-level
    tag, an ancestor's end tag or the end of the page.
    """
    stack: list[tuple[str, str]] = []
    found, parts, linked = [], [], 0
    in_link, at, muted = 0, 0, False
    known: dict[int, int] = {}

    def close() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                found.append((text, linked, tuple(f"{t} {c}" if c else t for t, c in stack)))
        parts, linked = [], 0

    def add(text: str) -> None:
        nonlocal linked
        if text and not muted:
            parts.append(text)
            if in_link:
                linked += len(text)

    while m := token.search(html, at):
        add(html[at : m.start()])
        at = m.end()
        name = m.group(4)
        if name is None:
            if m.group(0)[:9].upper() == "<![CDATA[":
                add(m.group(0)[9:].removesuffix("]]>"))
            elif m.group(1) or m.group(2):
                add(" ")
            continue
        name = name.lower()
        if name in _SILENT and not m.group(3):
            if name not in ("noscript", "button"):
                add(" ")
            if name == "head":
                at = _head_end(html, m, token, known)
            elif not m.group(5).endswith("/"):
                end = _silent_end(html, m, token, {t for t, _ in stack}, known)
                at, muted = (at, True) if end < 0 else (end, muted)
            continue
        if name in _INLINE:
            if name == "a":
                in_link = 0 if m.group(3) else 1
            elif name in ("br", "img"):
                add(" ")
            continue
        if m.group(3):
            # an unknown closing tag ends nothing
            if any(t == name for t, _ in stack):
                close()
                in_link, muted = 0, False
                while stack and stack.pop()[0] != name:
                    pass
            continue
        if muted and name in _OPTIONS:
            continue
        muted = False
        if stack and stack[-1][0] in _ENDS.get(name, ()):
            close()
            stack.pop()
        elif stack and stack[-1][0] == "p":
            close()
            stack.pop()
        close()
        in_link = 0
        if name not in _VOID and not m.group(5).endswith("/"):
            words = ""
            if m.group(5):
                words = " ".join(
                    v.strip("\"'").lower() for k, v in attribute.findall(m.group(5)) if k.lower() in ("class", "id", "role")
                )
            stack.append((name, words))
    add(html[at:])
    close()
    return found


def _features(blocks: list[tuple[str, int, tuple]], split: re.Pattern) -> list[list[str]]:
    """Names of the features of each block."""
    out = []
    longest = max((len(b[0]) for b in blocks), default=1)
    heading = next((i for i, b in enumerate(blocks) if b[2] and b[2][-1].split(" ")[0] == "h1"), None)
    total, seen = max(len(blocks), 1), set()
    for i, (text, linked, ancestors) in enumerate(blocks):
        own = ["bias"]
        for k, a in enumerate(ancestors):
            tag, _, words = a.partition(" ")
            own.append(f"in {tag}")
            if k == len(ancestors) - 1:
                own.append(f"tag {tag}")
            own += [f"word {w}" for w in split.split(words) if w]
        size = len(text)
        own.append(f"size {min(size.bit_length(), 11)}")
        own.append(f"share {min(int(4 * size / longest), 3)}")
        own.append(f"links {min(int(4 * linked / size), 4)}")
        ends = text[-1]
        own.append("ends " + ("." if ends in ".!?…:;\"'»”" else "a" if ends.isalnum() else "other"))
        commas = text.count(",") + text.count(". ")
        own.append(f"stops {min(commas, 4)}")
        if "©" in text or "(c)" in text.lower():
            own.append("copyright")
        if "|" in text or "»" in text or "·" in text:
            own.append("bars")
        if text in seen:
            own.append("again")
        seen.add(text)
        own.append(f"place {int(4 * i / total)}")
        if heading is not None:
            own.append("above heading" if i < heading else "heading" if i == heading else "below heading")
        out.append(sorted(set(own)))
    return out


class Field:
    """Weights of a linear chain with two labels, 1 for main text."""

    def __init__(self, names: dict[str, int], unary: np.ndarray, chain: np.ndarray) -> None:
        self.names, self.unary, self.chain = names, unary, chain

    def scores(self, features: list[list[str]]) -> np.ndarray:
        names = self.names
        return np.array([self.unary[[names[f] for f in own if f in names]].sum(axis=0) for own in features]).reshape(-1, 2)

    def decode(self, features: list[list[str]]) -> list[int]:
        """The best labelling (Viterbi); of equal ones the one with less main text."""
        if not features:
            return []
        scores, chain = self.scores(features).tolist(), self.chain.tolist()
        zero, one = scores[0]
        back = []
        for s0, s1 in scores[1:]:
            a, b = zero + chain[0][0], one + chain[1][0]
            c, d = zero + chain[0][1], one + chain[1][1]
            back.append((int(b > a), int(d > c)))
            zero, one = max(a, b) + s0, max(c, d) + s1
        labels = [int(one > zero)]
        for step in reversed(back):
            labels.append(step[labels[-1]])
        return labels[::-1]


def _marginals(scores: np.ndarray, chain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of labels and of neighbouring labels, by forward and backward sums."""
    n = len(scores)
    forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
    forward[0] = scores[0]
    for i in range(1, n):
        forward[i] = scores[i] + np.logaddexp(forward[i - 1][0] + chain[0], forward[i - 1][1] + chain[1])
    for i in range(n - 2, -1, -1):
        after = scores[i + 1] + backward[i + 1]
        backward[i] = np.logaddexp(chain[:, 0] + after[0], chain[:, 1] + after[1])
    total = np.logaddexp(*forward[-1])
    single = np.exp(forward + backward - total)
    pairs = np.zeros((2, 2))
    for i in range(1, n):
        pairs += np.exp(forward[i - 1][:, None] + chain + (scores[i] + backward[i])[None, :] - total)
    return single, pairs


# -- labelled pages ------------------------------------------------------------

_WORDS = (
    "river stone market window garden letter winter bridge music paper silver morning island teacher village engine "
    "forest coffee harbor doctor summer ticket mirror valley kitchen painter number station weather history people"
).split()


def _sentence(r: random.Random, low: int = 4, high: int = 18) -> str:
    words = [r.choice(_WORDS) for _ in range(r.randint(low, high))]
    if len(words) > 6 and r.random() < 0.6:
        words[len(words) // 2] += ","
    return " ".join(words).capitalize() + r.choice([".", ".", ".", ".", "!", "?"])


def _prose(r: random.Random) -> str:
    odd = r.random()
    if odd < 0.08:
        return r.choice([" | ", " · ", " » "]).join(r.choice(_WORDS) for _ in range(r.randint(3, 30)))
    if odd < 0.17:
        return _sentence(r, 1, 3)
    if odd < 0.22:
        return " ".join(r.choice(_WORDS) for _ in range(r.randint(1, 12))) + r.choice(["", "", " 12", ":", " ###"])
    return " ".join(_sentence(r) for _ in range(r.choice([1, 1, 2, 3, 4, 6, 9, 14])))


def _menu(r: random.Random, wrap: str) -> str:
    links = [f'<a href="/{r.choice(_WORDS)}">{r.choice(_WORDS).title()}</a>' for _ in range(r.randint(2, 8))]
    body = "<ul>" + "".join(f"<li>{x}</li>" for x in links) + "</ul>" if r.random() < 0.7 else " | ".join(links)
    return wrap.format(body)


def _pick(r: random.Random, *ways: str) -> str:
    return r.choice(ways)


def _noise(r: random.Random, kind: str) -> str:
    """A part of a page that is no main text."""
    s = lambda: _sentence(r, 3, 14)
    if kind == "menu":
        return _menu(r, _pick(r, "<nav>{}</nav>", '<div class="menu">{}</div>', '<div id="nav">{}</div>', '<div role="navigation">{}</div>',
                              '<ul class="breadcrumb"><li>{}</li></ul>', '<header><nav>{}</nav></header>', '<div class="navbar topnav">{}</div>'))
    if kind == "header":
        return _pick(r, "<header><div>{}</div></header>", '<div id="header"><p>{}</p></div>', '<div class="site-header">{}</div>',
                     '<div class="banner" role="banner">{}</div>', '<header class="masthead"><p>{}</p></header>').format(s())
    if kind == "footer":
        text = r.choice(["&copy; 2024 Example &middot; ", "All rights reserved. ", "", "Contact | Imprint | "]) + s()
        return _pick(r, "<footer>{}</footer>", '<div id="footer">{}</div>', '<div class="footer"><p>{}</p></div>',
                     '<footer class="site-footer"><div>{}</div></footer>', '<div role="contentinfo"><p>{}</p></div>').format(text)
    if kind == "advert":
        return _pick(r, '<div class="ad">{}</div>', '<div class="ads"><p>{}</p></div>', '<aside class="advert">{}</aside>', '<div class="sponsored promo"><p>{}</p></div>',
                     '<div id="ad-1">{}</div>', '<div class="advertisement">{}</div>', '<section class="promo">{}</section>').format(s())
    if kind == "sidebar":
        items = "".join(f"<li><a href='#'>{s()}</a></li>" for _ in range(r.randint(1, 5)))
        return _pick(r, "<aside><h3>Related</h3><ul>{}</ul></aside>", '<div class="sidebar"><h4>More</h4><ul>{}</ul></div>', '<div id="sidebar" class="widget"><ul>{}</ul></div>',
                     '<div class="related recommended"><p>Read next</p><ul>{}</ul></div>', '<aside class="sidebar"><p>About us</p><p>Latest news of the day.</p><ul>{}</ul></aside>').format(items)
    if kind == "notice":
        text = r.choice(["We use cookies to improve this site. ", "Subscribe to our newsletter. ", "Please accept our privacy policy. ", ""]) + s()
        return _pick(r, '<div class="cookie-notice"><p>{}</p></div>', '<div id="cookie-banner">{}</div>', '<div class="notice">{}</div>', '<div class="newsletter"><p>{}</p></div>',
                     '<div class="consent gdpr" role="dialog"><p>{}</p></div>', '<div class="alert popup modal"><p>{}</p></div>', '<section class="cookie"><div>{}</div></section>').format(text)
    if kind == "form":
        return _pick(r, "<form><p>{}</p><label>Name</label><input></form>", '<form class="search"><div>{}</div><input></form>',
                     '<div class="login"><form><label>{}</label><input type="text"></form></div>', '<form id="subscribe"><fieldset><legend>{}</legend></fieldset></form>').format(s())
    if kind == "comments":
        each = "".join(
            _pick(r, '<div class="comment"><p class="author">Anna</p><p>{}</p></div>', "<li><p>{}</p></li>", '<article class="comment"><p>{}</p></article>', "<p>{}</p>").format(_prose(r))
            for _ in range(r.randint(1, 4))
        )
        return _pick(r, '<div class="comments"><h3>Comments</h3>{}</div>', '<section id="comments"><h2>2 comments</h2>{}</section>', '<ol class="comment-list">{}</ol>',
                     '<section class="reader-comments replies">{}</section>', '<div id="disqus_thread" class="comments discussion">{}</div>').format(each)
    return _pick(r, '<div class="share social"><a href="#">Share</a> <a href="#">Like</a></div>', '<p class="tags"><a href="#">one</a> <a href="#">two</a></p>',
                 '<ul class="pagination"><li><a href="#">1</a></li><li><a href="#">Next</a></li></ul>')


def labelled_pages(pages: int, seed: int = 7) -> list[tuple[str, list[bool]]]:
    """Pages, and for each of their blocks whether it is main text (marked by a sign while composing)."""
    r = random.Random(seed)
    above = ["menu", "header", "advert", "notice", "form", "share"]
    below = ["footer", "sidebar", "comments", "advert", "notice", "form", "menu", "share"]
    out = []
    for _ in range(pages):
        body, told = [], []
        if r.random() < 0.9:
            title = "\u0001" + _sentence(r, 2, 9).rstrip(".") + r.choice(["", ".", ""])
            told.append(title)
            body.append(_pick(r, "<h1>{}</h1>", "<h1>{}</h1>", '<h1 class="title">{}</h1>', '<header class="entry-header"><h1>{}</h1></header>', "<h2>{}</h2>").format(title))
        for _ in range(r.choice([0, 1, 2, 3, 5, 8, 12])):
            text = told[-1] if told and r.random() < 0.1 else "\u0001" + _prose(r)
            told.append(text)
            body.append(_pick(r, *["<p>{}</p>"] * 8, "<p><b>{}<br>", "<div>{}</div>", "<blockquote><p>{}</p></blockquote>", "<h2>{}</h2>", "<ul><li>{}</li></ul>",
                              "<p><a href='#'>{}</a></p>", "<pre>{}</pre>", "<table><tr><td>{}</td></tr></table>", "<section><p>{}</p></section>", "<p class='lead'>{}</p>").format(text))
            if r.random() < 0.06:
                body.append(_noise(r, r.choice(["advert", "share", "sidebar", "notice", "form"])))
        inside = [_noise(r, r.choice(["comments", "share", "sidebar", "form"]))] if r.random() < 0.2 else []
        main = _pick(r, *["<article>{}</article>"] * 5, "<main><article>{}</article></main>", '<div id="content">{}</div>', '<div class="post-content entry">{}</div>', "<main>{}</main>",
                     '<div class="article-body">{}</div>', '<div class="wrapper"><div class="content main">{}</div></div>', "<div>{}</div>", '<section class="story text">{}</section>')
        html = ["<!DOCTYPE html><html><head><title>x</title><style>p{margin:0}</style></head><body>"]
        html += [_noise(r, k) for k in r.sample(above, r.randint(0, 4))]
        html += [main.format("".join(body + inside))]
        html += [_noise(r, k) for k in r.sample(below, r.randint(0, 5))]
        html.append(_pick(r, "</body></html>", "</body></html>", ""))
        out.append("".join(html))
    return [(h.replace("\u0001", ""), [("\u0001" in b[0]) for b in blocks_of(h, _token_pattern(), _attribute_pattern())]) for h in out]


def _attribute_pattern() -> re.Pattern:
    return re.compile(r"([a-zA-Z-]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)")


def train(pages: int = TRAINING_PAGES, passes: int = PASSES, seed: int = 7) -> Field:
    """The field, by stochastic gradient steps on the likelihood of the labelled pages."""
    token, attribute, split = _token_pattern(), _attribute_pattern(), re.compile(r"[^a-z]+")
    data = []
    for html, labels in labelled_pages(pages, seed):
        blocks = blocks_of(html, token, attribute)
        if blocks:
            data.append((_features(blocks, split), np.array(labels, int)))
    names: dict[str, int] = {}
    for features, _ in data:
        for own in features:
            for f in own:
                names.setdefault(f, len(names))
    field = Field(names, np.zeros((len(names), 2)), np.zeros((2, 2)))
    r, step = random.Random(seed), 0
    rows = [([np.array([names[f] for f in own]) for own in features], labels) for features, labels in data]
    for _ in range(passes):
        r.shuffle(rows)
        for places, labels in rows:
            step += 1
            rate = 0.3 / (1 + step / 2000)
            scores = np.array([field.unary[p].sum(axis=0) for p in places])
            single, pairs = _marginals(scores, field.chain)
            single[np.arange(len(labels)), labels] -= 1
            np.subtract.at(pairs, (labels[:-1], labels[1:]), 1)
            for p, slope in zip(places, single):
                field.unary[p] -= rate * slope
            field.chain -= rate * 0.2 * pairs
        field.unary *= 0.995
    return field


def extract(pages: DataFrame, field: Field | None = None, html_col: str = "html") -> DataFrame:
    """``pages`` with ``main_text``: the blocks labelled as main text, in page order, joined by two newlines.

    Null and empty pages, and pages without main text, give an empty text. Nothing
    is capped. All other columns pass through untouched.
    """
    field = field or train()
    shared = pages.sparkSession.sparkContext.broadcast((field.names, field.unary, field.chain))

    def read(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = Field(*shared.value)
        token, attribute, split = _token_pattern(), _attribute_pattern(), re.compile(r"[^a-z]+")
        for html in columns:
            texts = []
            for page in html:
                blocks = blocks_of(page, token, attribute)
                labels = model.decode(_features(blocks, split))
                texts.append("\n\n".join(b[0] for b, keep in zip(blocks, labels) if keep))
            yield pd.Series(texts, dtype=object)

    udf = F.pandas_udf(read, "string")
    return pages.withColumn("main_text", udf(F.coalesce(F.col(html_col), F.lit(""))))


def query(spark, sf_dir: str) -> DataFrame:
    found = extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.char_length("main_text").cast("long").alias("n_chars"))

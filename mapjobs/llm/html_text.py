"""Main text of web pages (operator 7): a linear-chain conditional random field over DOM leaf blocks.

A page becomes a row of blocks, each a run of text between block-level tags. A block's features are its ancestors' tags and names
(class, id and role) and simple facts about its text. A two-label chain (article or not), trained on labelled pages, scores
all labellings of a page together; Viterbi picks the best one.
"""

from __future__ import annotations

import html
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mapjobs.llm.common import slices, texts

#: Fixed values of the HTML standard: elements that start a new block; that never have content; whose content is no text of the page.
BLOCK = frozenset("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template textarea title iframe".split())
#: An opening tag of the left kind ends an open element of the right kinds.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SCOPE = frozenset("ul ol dl table select html body".split())

#: White space of the HTML standard.
WS = "\\t\\n\\f\\r "
#: Attributes as the standard tells them apart: a value begins behind "=" and may be quoted; without a quote it runs to white space or ">". Quotes elsewhere are part of a name or
#: value. A quote that the page never closes opens no value.
ATTRIBUTES = rf"""(?:[{WS}/]++|[^{WS}/>][^{WS}/>=]*+(?:[{WS}]*+=[{WS}]*+(?:"[^"]*+"|'[^']*+'|[^{WS}>"'][^{WS}>]*+|(?=>)))?+)*+"""
TAG = re.compile(rf"<(?:!--(?:-?>|.*?(?:--!?>|\Z))|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^{WS}/>]*)({ATTRIBUTES})>)", re.S)
NAMED = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
NAME_PARTS = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    own: str  # tag of the innermost open element, "none" outside of all
    tags: frozenset[str]  # of all open elements
    names: frozenset[str]  # parts of the names of all open elements
    linked: int  # characters inside links


def blocks(page: str, known: frozenset[str] | None = None) -> list[Block]:
    """The non-empty text blocks of a page in order, references decoded and white space made single.

    One pass over the tags; ill-nested and unclosed ones are mended as browsers do in the common cases. A tag that the
    page's end cuts off is dropped. known: the only parts of names to keep; it bounds the sets of a deep page.
    """
    out: list[Block] = []
    # (tag, tags of it and all around it, parts of their names); an element that adds nothing shares its parent's sets
    stack: list[tuple[str, frozenset[str], frozenset[str]]] = []
    none: frozenset[str] = frozenset()
    open_tags: Counter = Counter()  # so that the stack is searched only for what is there
    held: list[str] = []
    linked, in_link, at, size = 0, 0, 0, len(page)

    def flush():
        nonlocal linked
        text = " ".join(html.unescape("".join(held)).split())
        if text:
            out.append(Block(text, *(stack[-1] if stack else ("none", none, none)), linked))
        held.clear()
        linked = 0

    def close(i: int):
        open_tags.subtract(s[0] for s in stack[i:])
        del stack[i:]

    def add(piece: str):
        nonlocal linked
        held.append(piece)
        linked += len(piece) * (in_link > 0)

    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            add(page[at:])
            break
        if lt > at:
            add(page[at:lt])
        if lt + 1 < size and not (page[lt + 1].isascii() and (page[lt + 1].isalpha() or page[lt + 1] in "/!?")):
            add("<")
            at = lt + 1
            continue
        m = TAG.match(page, lt)
        if not m:
            gt = page.find(">", lt)
            if page[lt + 1:lt + 2] == "/" and gt >= 0:  # "</" before no letter is a comment
                at = gt + 1
                continue
            break
        at = m.end()
        if not m[2]:
            continue
        closing, tag = bool(m[1]), m[2].lower()
        if tag == "a":
            in_link = 0 if closing else 1
        if tag == "br":
            held.append(" ")
        if not closing and tag in RAW:
            end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])[^>]*(?:>|\\Z)", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if tag not in BLOCK:
            continue
        flush()
        if closing:
            for i in range(len(stack) - 1, -1, -1) if open_tags[tag] else ():
                if stack[i][0] == tag:
                    close(i)
                    break
            continue
        if stack and stack[-1][0] == "p":
            close(len(stack) - 1)
        ends = ENDS.get(tag, ())
        for i in range(len(stack) - 1, -1, -1) if any(open_tags[t] for t in ends) else ():
            if stack[i][0] in ends:
                close(i)
                break
            if stack[i][0] in SCOPE:
                break
        if tag not in VOID:
            names = " ".join("".join(x) for x in NAMED.findall(m[3])).lower()
            _, tags, around = stack[-1] if stack else ("", none, none)
            parts = [n for n in NAME_PARTS.findall(names) if known is None or n in known]
            open_tags[tag] += 1
            stack.append((tag, tags if tag in tags else tags | {tag}, around if around.issuperset(parts) else around.union(parts)))
    flush()
    return out


def bucket(n: int) -> str:
    return next(str(b) for b in (1, 2, 5, 12, 30, 1 << 60) if n <= b)


def features(bs: list[Block]) -> list[list[str]]:
    """Names of the features of each block. All open elements count, however deep."""
    rows, body = [], any("article" in b.tags or "main" in b.tags for b in bs)
    for i, b in enumerate(bs):
        tags = b.tags
        words = b.text.count(" ") + 1
        own = b.own
        link = 3 * b.linked // (len(b.text) + 1)
        row = ["bias", f"own={own}", f"words={bucket(words)}", f"link={min(link, 3)}", f"own={own},words={bucket(words)}"]
        row += [f"in={t}" for t in tags]
        row += [f"name={n}" for n in b.names]
        row += [f"end={b.text[-1] in '.!?:;\"'}", f"first={i == 0}", f"last={i == len(bs) - 1}"]
        row.append(f"article={'article' in tags or 'main' in tags},page={body}")
        if "©" in b.text or "(c)" in b.text.lower():
            row.append("copyright")
        rows.append(sorted(set(row)))
    return rows


@dataclass
class Crf:
    """weights: score of label 1 over label 0 by feature. step[a, b]: score of label b after a."""
    weights: dict[str, float]
    step: np.ndarray
    start: np.ndarray

    @cached_property
    def names(self) -> frozenset[str]:
        """Parts of names that have a weight; others change no score."""
        return frozenset(f.removeprefix("name=") for f in self.weights if f.startswith("name="))

    def decode(self, rows: list[list[str]]) -> np.ndarray:
        """Viterbi: the best labels of a page's blocks (0 or 1)."""
        n = len(rows)
        if not n:
            return np.zeros(0, np.int64)
        emit = [sum(map(self.weights.get, r, [0.0] * len(r))) for r in rows]
        (s00, s01), (s10, s11) = self.step.tolist()
        zero, one = self.start.tolist()
        one += emit[0]
        back = []
        for e in emit[1:]:
            back.append((s10 + one > s00 + zero, s11 + one >= s01 + zero))
            zero, one = max(s00 + zero, s10 + one), max(s01 + zero, s11 + one) + e
        label, out = int(one >= zero), []
        for b in reversed(back):
            out.append(label)
            label = int(b[label])
        return np.array([*out, label][::-1], np.int64)


def marginals(emit: np.ndarray, live: np.ndarray, step: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over pages padded to one length. emit: (pages, blocks, 2), ``live`` where a block is.

    (log of the sum over all labellings, probability of label 1 of each block, probability of each pair of labels in a row)."""
    n, longest = live.shape
    alpha, beta = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
    alpha[:, 0] = start + emit[:, 0]
    for t in range(1, longest):
        new = np.logaddexp.reduce(alpha[:, t - 1, :, None] + step, axis=1) + emit[:, t]
        alpha[:, t] = np.where(live[:, t, None], new, alpha[:, t - 1])
    for t in range(longest - 2, -1, -1):
        new = np.logaddexp.reduce(step + (emit[:, t + 1] + beta[:, t + 1])[:, None, :], axis=2)
        beta[:, t] = np.where(live[:, t + 1, None], new, 0.0)
    z = np.logaddexp.reduce(alpha[:, -1], axis=1)
    one = np.exp(alpha[..., 1] + beta[..., 1] - z[:, None]) * live
    both = np.exp(alpha[:, :-1, :, None] + step + (emit + beta)[:, 1:, None, :] - z[:, None, None, None]) * live[:, 1:, None, None]
    return z, one, both


def train(pages: list[tuple[list[list[str]], list[int]]], *, l2: float = 1e-3, steps: int = 200) -> Crf:
    """Maximum conditional likelihood by Adam. pages: features and labels of each page's blocks. All pages go through the
    forward-backward recursion together, padded to the longest."""
    place: dict[str, int] = {}
    cols, where = [], []
    longest, n = max(len(y) for _, y in pages), len(pages)
    gold, live = np.zeros((n, longest), np.int64), np.zeros((n, longest), bool)
    for p, (rows, y) in enumerate(pages):
        gold[p, :len(y)], live[p, :len(y)] = y, True
        for t, r in enumerate(rows):
            cols += [place.setdefault(f, len(place)) for f in r]
            where += [p * longest + t] * len(r)
    cols, where = np.array(cols), np.array(where)
    k = len(place)
    theta, m, v = np.zeros(k + 6), np.zeros(k + 6), np.zeros(k + 6)
    pairs = live[:, 1:]
    blocks_in_all = live.sum()
    for i in range(1, steps + 1):
        w, step, start = theta[:k], theta[k:k + 4].reshape(2, 2), theta[k + 4:]
        emit = np.zeros((n, longest, 2))
        emit[..., 1] = np.bincount(where, w[cols], n * longest).reshape(n, longest)
        _, one, both = marginals(emit, live, step, start)
        g = np.zeros(k + 6)
        g[:k] = np.bincount(cols, (one - gold * live).ravel()[where], k)
        seen = np.zeros((2, 2))
        np.add.at(seen, (gold[:, :-1][pairs], gold[:, 1:][pairs]), 1)
        g[k:k + 4] = (both.sum((0, 1)) - seen).ravel()
        g[k + 4:] = [(1 - one[:, 0] - (gold[:, 0] == 0)).sum(), (one[:, 0] - gold[:, 0]).sum()]
        g = g / blocks_in_all + 2 * l2 * theta / n
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta - 0.1 * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.999**i)) + 1e-9)
    return Crf({f: float(theta[j]) for f, j in place.items()}, theta[k:k + 4].reshape(2, 2), theta[k + 4:])


# --- labelled pages -------------------------------------------------------------------------------------------------------

#: Names that page authors give to the parts of a page.
NAMES = {
    "content": "content main-content post post-content entry entry-content article article-body story body-text page-content text",
    "nav": "nav navbar menu main-menu navigation breadcrumb breadcrumbs topnav tabs pagination toc",
    "header": "header site-header masthead banner top-bar logo branding",
    "footer": "footer site-footer colophon copyright legal bottom",
    "side": "sidebar side-bar widget widget-area secondary rail right-col related related-posts recommended more-stories trending",
    "ad": "ad ads advert advertisement ad-slot sponsored sponsor promo banner-ad google-ad dfp",
    "notice": "notice cookie cookie-notice cookie-banner consent gdpr alert warning message popup modal paywall disclaimer",
    "form": "form search search-form newsletter subscribe signup login contact-form share social share-buttons",
    "comments": "comments comment comment-list comment-body discussion replies reply respond disqus",
}


def labelled_page(seed: int) -> str:
    """A page in one of many layouts. A marker in the text of each block tells its label, so
    that labels and blocks cannot get out of step; ``labelled_pages`` takes it away again."""
    r = random.Random(seed)
    syllables = [c + v + e for c in "bdfgklmnprst" for v in "aeiou" for e in ("", "n", "r", "st")]
    word = lambda: "".join(r.choices(syllables, k=r.randint(1, 4)))
    words = lambda a, b: " ".join(word() for _ in range(r.randint(a, b)))
    mark = lambda y, t: f"{t} \x01{y}"
    named = lambda kind: r.choice([f' class="{r.choice(NAMES[kind].split())}"', f' id="{r.choice(NAMES[kind].split())}"', f' class="{r.choice(NAMES[kind].split())} {word()}"'])
    sentence = lambda a=4, b=30: words(a, b).capitalize() + r.choice("...!?")
    link = lambda y, a=1, b=3: f'<a href="/{word()}">{mark(y, words(a, b))}</a>'
    prose = lambda: " ".join(sentence() for _ in range(r.choice((1, 1, 2, 4, 8))))
    scrap = lambda: words(1, r.choice((1, 3, 12))) + r.choice(("", "", ",", " |", ";", " -", "###", "$"))
    para = lambda y: f"<p>{mark(y, prose() if r.random() < 0.75 else scrap())}{r.choice(('</p>', '</p>', ''))}"

    def listing(y, n):
        tag = r.choice(("ul", "ol"))
        return f"<{tag}>" + "".join(f"<li>{link(y) if y == 0 else mark(y, sentence(2, 14))}</li>" for _ in range(n)) + f"</{tag}>"

    def side(kind, tag="div"):
        inner = r.choice([lambda: mark(0, sentence(2, 12)), lambda: f"<p>{mark(0, sentence(3, 20))}</p>", lambda: f"<h3>{mark(0, words(1, 3))}</h3>" + listing(0, r.randint(2, 5)), lambda: f"<span>{mark(0, words(1, 2))}</span>"])()
        return f"<{tag}{named(kind)}>{inner}</{tag}>"

    def form():
        return f"<form{r.choice(('', named('form')))}><label>{mark(0, words(1, 4))}</label><input name=q><button>{mark(0, word())}</button></form>"

    def comments():
        one = lambda: r.choice((f'<div class="comment"><p>{mark(0, sentence(3, 40))}</p></div>', f'<article class="comment"><h4>{mark(0, words(1, 2))}</h4><p>{mark(0, sentence(3, 40))}</p></article>', f'<li class="comment-body">{mark(0, sentence(3, 40))}</li>'))
        tag = r.choice(("section", "div", "ol", "aside"))
        return f"<{tag}{named('comments')}><h3>{mark(0, words(1, 2))}</h3>" + "".join(one() for _ in range(r.randint(1, 6))) + f"</{tag}>"

    def article():
        parts = [f"<h1>{mark(1, words(2, 9).capitalize() + r.choice(('', '', '.')))}</h1>"] * (r.random() < 0.9)
        for _ in range(r.randint(1, 14)):
            x = r.random()
            parts.append(para(1) if x < 0.7 else f"<h2>{mark(1, words(1, 6))}</h2>" if x < 0.78 else listing(1, r.randint(1, 5)) if x < 0.84 else f"<blockquote>{mark(1, sentence())}</blockquote>" if x < 0.88 else f"<pre>{mark(1, words(2, 20))}</pre>" if x < 0.9 else f"<figure><figcaption>{mark(1, sentence(2, 9))}</figcaption></figure>" if x < 0.92 else side("ad") if x < 0.95 else side("notice") if x < 0.97 else side("side", "aside"))
        if r.random() < 0.15:
            parts.append(form())
        if r.random() < 0.15:
            parts.append(comments())
        return "".join(parts)

    wrap = r.choice(("<article>{}</article>", "<main>{}</main>", "<main><article>{}</article></main>", "<article%s>{}</article>", "<div%s>{}</div>", "<div%s><article>{}</article></div>", "<section%s>{}</section>", "<div id=\"wrap\"><div%s>{}</div></div>"))
    wrap = wrap.replace("%s", named("content"))
    page = ["<!DOCTYPE html><html><head><title>x</title><style>p{}</style><script>var t='</p>';</script></head><body>"]
    page += [side("notice")] * (r.random() < 0.25)
    page += [f"<header{r.choice(('', named('header')))}>{r.choice((mark(0, words(1, 3)), f'<h1>{mark(0, words(1, 3))}</h1>', f'<p>{mark(0, sentence(2, 8))}</p>'))}</header>"] * (r.random() < 0.45)
    page += [r.choice(("<nav>{}</nav>", f"<div{named('nav')}>{{}}</div>", f"<nav{named('nav')}>{{}}</nav>")).format(listing(0, r.randint(2, 8)))] * (r.random() < 0.85)
    page += [side("ad")] * (r.random() < 0.5)
    page += [side("side", r.choice(("aside", "div")))] * (r.random() < 0.25)
    page.append(wrap.format(article()))
    page += [side("side", r.choice(("aside", "div", "section")))] * (r.random() < 0.35)
    page += [form()] * (r.random() < 0.3)
    page += [comments()] * (r.random() < 0.4)
    page += [side("ad")] * (r.random() < 0.2)
    foot = r.choice((mark(0, f"&copy; {word()} &middot; {sentence(2, 10)}"), mark(0, f"&copy; {words(1, 4)}"), f"<p>{mark(0, sentence(2, 16))}</p>", listing(0, 4)))
    page += [r.choice((f"<footer>{foot}</footer>", f"<footer{named('footer')}>{foot}</footer>", f"<div{named('footer')}>{foot}</div>"))] * (r.random() < 0.9)
    return "".join(page) + r.choice(("</body></html>", ""))


def labelled_pages(n: int = 600) -> list[tuple[list[list[str]], list[int]]]:
    """Features and labels of ``n`` labelled pages, the same in every run."""
    out = []
    for seed in range(n):
        bs = blocks(labelled_page(seed))
        y = [int("\x011" in b.text) for b in bs]
        for b in bs:
            b.text = re.sub(r" ?\x01\d", "", b.text)
        out.append((features(bs), y))
    return out


def main_text(page: str, crf: Crf) -> str:
    bs = blocks(page, crf.names)
    if all(b.own == "none" for b in bs):  # no element around any text: a plain text, which has no menus
        return "\n\n".join(b.text for b in bs)
    return "\n\n".join(b.text for b, y in zip(bs, crf.decode(features(bs))) if y)


def extract(pages: DataFrame, *, training_pages: int = 600) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of pages (page_id, url, html).

    text: the article's blocks in page order, two line feeds between them; empty if there is none, and for null or empty html.
    n_chars counts code points. A page without block elements is its own text. Of equally likely labellings the last block is text, and a block before goes with the one behind it. A page is held and
    decoded whole, in time linear in its length. Row-wise: ids may be null or repeat; other columns are ignored.
    """
    shared = pages.sparkSession.sparkContext.broadcast(train(labelled_pages(training_pages)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = shared.value
        for batch in slices(batches, "html"):
            found = [main_text(t.decode("utf-8", "replace"), crf) for t in texts(batch, "html")]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())], ["page_id", "url", "text", "n_chars"])

    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return p.mapInArrow(run, "page_id long, url string, text string, n_chars long")

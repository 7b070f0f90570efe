"""Main text of web pages: a linear-chain CRF over the leaf blocks of the DOM.

A page is cut into leaf blocks: text between two block-level tags, references
decoded, white space runs one space, trimmed. Each block has features from its
ancestors (tags, words of class, id and role) and its text (length, links,
punctuation, place). A chain model over two labels, text and other, scores
blocks and neighbours; Viterbi picks the labels, and text blocks are joined by
a newline in page order.

The ``pages`` table carries no labels, so the model is trained on labelled pages
of its own (``labelled_pages``): page layouts as they occur on the web, with and
without semantic tags, in random orders, every block labelled by the part of
the layout it stands in. Training is deterministic, takes a second on the
driver and leaves a few hundred weights, which are broadcast.

Scripts, styles, the head, comments in the markup and form controls never make
blocks. The head ends at the first thing that it cannot hold; a skipped element
without an end tag ends with the block around it (unless the parser takes all
that follows as its text, as for script and style). Formulas and what stands in
for objects, audio and video are text. A line break (br) is white space. A tag cut off by the end of the page
is dropped.

Defined cases: null or empty html gives an empty text; a page without a text
block too; page_id and url may be null or repeated and are passed through;
extra columns are ignored; pages of any length are read whole.
"""

from __future__ import annotations

import random
import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# HTML's element kinds.
BLOCK_TAGS = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table
tbody td tfoot th thead tr ul""".split())
VOID_TAGS = set("area base br col embed hr img input link meta param source track wbr".split())
SKIP_TAGS = set("script style head noscript template svg iframe canvas select option button textarea title datalist".split())
HEAD_TAGS = set("html head base basefont bgsound link meta noframes noscript script style template title".split())
RAW_TAGS = set("iframe textarea title".split())


class _Blocks(HTMLParser):
    """Leaf blocks of a page: (text, letters in links, own tag, ancestor features)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks, self.open, self.skip, self.links = [], [], [], 0
        self.inner = []  # block tags open inside skipped elements
        self.ends = dict.fromkeys(RAW_TAGS, 0)  # end tags of raw elements that are still to come
        self.text, self.linked = [], 0

    def flush(self):
        text = " ".join("".join(self.text).split())
        if text:
            self.blocks.append((text, self.linked, [x for x in self.open]))
        self.text, self.linked = [], 0

    def handle_starttag(self, tag, attrs):
        if tag == "body":
            self.skip = [x for x in self.skip if x[0] not in ("head", "title")]
            if not self.skip:
                self.inner.clear()
        elif [x for x, _ in self.skip] == ["head"] and tag not in HEAD_TAGS:
            self.skip.clear()  # head ends at what it cannot hold
        if self.skip or tag in SKIP_TAGS:
            if tag in SKIP_TAGS:
                self.skip.append((tag, len(self.inner)))
            elif tag in BLOCK_TAGS and tag not in VOID_TAGS:
                self.inner.append(tag)
            return
        if tag in BLOCK_TAGS:
            self.flush()
            for inner, closers in (("p", BLOCK_TAGS), ("li", {"li"})):  # end tags that may be left out
                if tag in closers and self.open and self.open[-1][0] == inner:
                    self.open.pop()
            if tag not in VOID_TAGS:
                words = [w for k, v in attrs if k in ("class", "id", "role", "itemprop", "aria-label") and v
                         for w in re.findall("[a-z]+", re.sub("([a-z])([A-Z])", r"\1 \2", v).lower())]
                self.open.append((tag, tuple(words)))
        elif tag == "br":
            self.text.append(" ")
        elif tag == "a":
            self.links += 1

    def handle_startendtag(self, tag, attrs):
        if tag not in SKIP_TAGS:
            self.handle_starttag(tag, attrs)
            if tag in BLOCK_TAGS and tag not in VOID_TAGS:
                self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in RAW_TAGS:
            self.ends[tag] -= 1
        if self.skip:
            names = [x for x, _ in self.skip]
            if tag in names:
                k = len(names) - 1 - names[::-1].index(tag)
                del self.inner[self.skip[k][1]:]
                del self.skip[k:]
                return
            if tag in self.inner:
                del self.inner[len(self.inner) - 1 - self.inner[::-1].index(tag):]
                return
            if tag not in [x for x, _ in self.open] or self.ends.get(names[-1], 0) > 0:
                return
            # the block around it closes, so a skipped element without an end tag ends
            self.skip.clear()
            self.inner.clear()
        if tag in BLOCK_TAGS:
            self.flush()
            names = [t for t, _ in self.open]
            if tag in names:
                del self.open[len(names) - 1 - names[::-1].index(tag):]
        elif tag == "a" and self.links:
            self.links -= 1

    def handle_data(self, data):
        if [x for x, _ in self.skip] == ["head"] and data.strip():
            self.skip.clear()
        if not self.skip:
            self.text.append(data)
            if self.links:
                self.linked += len(data)


def blocks(html: str | None) -> list[tuple]:
    """(text, letters in links, ancestors) of each leaf block; ancestors as (tag, words)."""
    html = html or ""
    cut = html.rfind("<")
    if cut >= 0 and ">" not in html[cut:] and re.match(r"<[/!a-zA-Z]|<$", html[cut:]):
        html = html[:cut]
    parser = _Blocks()
    lower = html.lower()
    parser.ends = {tag: lower.count("</" + tag) for tag in RAW_TAGS}
    parser.feed(html)
    parser.close()
    parser.flush()
    return parser.blocks


_DIGIT = re.compile("[0-9]")


def _bucket(x, cuts):
    return sum(x >= c for c in cuts)


def features(found: list[tuple]) -> list[list[str]]:
    """Names of the features that hold for each block of a page."""
    out = []
    for k, (text, linked, up) in enumerate(found):
        n = text.count(" ") + 1
        tags = [t for t, _ in up]
        own = tags[-1] if tags else ""
        f = {"bias", "own=" + own, f"words={_bucket(n, (2, 5, 10, 20, 50))}",
             f"links={_bucket(linked / len(text), (0.01, 0.3, 0.7))}", f"stop={text[-1] in '.!?…。'}",
             f"commas={_bucket(text.count(','), (1, 3))}", f"digits={_bucket(len(_DIGIT.findall(text)) / len(text), (0.05, 0.3))}",
             f"sign={text[0] in '©»•→'}", f"first={k == 0}", f"last={k == len(found) - 1}"}
        f.update("in=" + t for t in tags[:-1])
        f.update("word=" + w for _, words in up for w in words)
        f.update("near=" + w for w in (up[-1][1] if up else ()))
        out.append(sorted(f))
    return out


# Words that pages use in class and id attributes.
OTHER_WORDS = {
    "menu": "menu nav navbar navigation navbox breadcrumb breadcrumbs topbar toolbar tabs pagination pager toc".split(),
    "header": "header masthead branding logo tagline banner hero topline".split(),
    "footer": "footer copyright legal colophon bottom imprint credits sitemap".split(),
    "sidebar": "sidebar side aside widget related recommended trending popular rail archive tags blogroll more teaser".split(),
    "notice": "notice cookie cookies consent gdpr alert popup modal overlay banner disclaimer warning message privacy paywall".split(),
    "ad": "ad ads advert advertisement adsense sponsor sponsored promo promotion promoted".split(),
    "form": "form search login signup subscribe newsletter contact register".split(),
    "share": "share social sharing follow meta byline author tools print".split(),
    "comments": "comment comments respond reply replies discussion disqus feedback reviews thread reader responses".split(),
}
TEXT_WORDS = "content article post entry story text main body articlebody page single prose".split()


def labelled_pages(count: int = 700, seed: int = 11):
    """Pages as (html, labels): 1 for each leaf block of the article, else 0."""
    rng = random.Random(seed)
    letters = "aeiouthnrsldcm"

    def words(n):
        return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(n))

    def sentence():
        w = words(rng.choice([1, 2, 4, 8, 12, 20, 35]))
        if rng.random() < 0.5:
            w = w.replace(" ", rng.choice([", ", " – ", " &amp; "]), rng.randint(1, 3))
        if rng.random() < 0.05:
            w = w.replace(" ", " | ") + " |"
        return w.capitalize() + rng.choice([".", ".", ".", "!", "?", "", ":", "%%%", "***", "&amp;&amp;"])

    def prose(n=None):
        return " ".join(sentence() for _ in range(n or rng.choice([1, 1, 2, 3, 6, 12])))

    def attr(kinds):
        if not kinds or rng.random() < 0.12:
            return ""
        name = rng.choice(kinds)
        if rng.random() < 0.3:
            name = rng.choice(["site-", "page-", "block-", "js-", "main-" if rng.random() < 0.2 else "l-"]) + name
        return f' {rng.choice(["class", "class", "id"])}="{name}"'

    def leaves(items):
        return "".join(h for h, _ in items), [y for _, y in items]

    def other(kind):
        kinds, tag = OTHER_WORDS[kind], {"menu": "nav", "header": "header", "footer": "footer", "sidebar": "aside",
                                         "form": "form", "comments": "section"}.get(kind)
        plain = tag is None or rng.random() < 0.4
        tag = rng.choice(["div", "section", "div"]) if plain else tag
        at = f' class="{rng.choice(kinds)}"' if plain and rng.random() < 0.9 else attr(kinds)
        if plain and not at:
            at = f' id="{rng.choice(kinds)}"'
        link = lambda: f'<a href="/{words(1)}">{words(rng.randint(1, 4))}</a>'
        body = []
        if kind in ("menu", "sidebar", "share") and rng.random() < 0.8:
            body += [(f"<li>{link()}</li>", 0) for _ in range(rng.randint(2, 7))]
            body = [("<ul>", None), *body, ("</ul>", None)]
        elif kind == "form":
            body += [(f"<p>{words(rng.randint(1, 6))} <input name=q><button>{words(1)}</button></p>", 0)]
            body += [(f"<label>{words(2)}</label><br><input>", 0)]
        elif kind == "comments":
            body += [(f"<h{rng.randint(2, 4)}>{words(rng.randint(1, 3))}</h3>", 0)]
            for _ in range(rng.randint(1, 4)):
                box = rng.choice(["div", "li", "article"])
                body += [(f'<{box} class="{rng.choice(kinds)}">', None), (f"<p>{prose()}</p>", 0), (f"</{box}>", None)]
        elif kind == "footer":
            body += [(rng.choice(["&copy; ", "© 2020 ", ""]) + words(2) + rng.choice([" &middot; ", " | ", " "]) + prose(1), 0)]
            if rng.random() < 0.5:
                body += [(f"<p>{link()} {link()}</p>", 0), (f"<p>{prose(1)}</p>", 0)]
        elif kind == "header":
            body += [(f"<h1>{words(rng.randint(1, 4))}</h1>" if rng.random() < 0.5 else f"<p>{words(3)}</p>", 0)]
        else:
            body += [(f"<p>{prose(rng.choice([1, 1, 2]))}</p>" if rng.random() < 0.5 else prose(1), 0)]
        if kind not in ("menu",) and rng.random() < 0.25:
            body = [(f"<h3>{words(2)}</h3>", 0), *body]
        # text right before a nested block is a block of its own: keep one leaf an item
        return [(f"<{tag}{at}>", None), *body, (f"</{tag}>", None)]

    def article():
        tag = rng.choice(["article", "article", "main", "div", "section", "div"])
        at = attr(TEXT_WORDS) if tag in ("article", "main") else f' class="{rng.choice(TEXT_WORDS)}"'
        if tag in ("div", "section") and rng.random() < 0.15:
            at = ""
        body = []
        if rng.random() < 0.8:
            body += [(f"<h1>{words(rng.randint(2, 12))}</h1>", 1)]
        for _ in range(rng.choice([1, 2, 3, 5, 9, 15])):
            kind = rng.random()
            if kind < 0.72:
                text = prose()
                if rng.random() < 0.15:
                    text = f'{text} <a href="/x">{words(2)}</a> {prose(1)}'
                body += [(f"<p>{text}" + ("</p>" if rng.random() < 0.85 else ""), 1)]
            elif kind < 0.8:
                body += [(f"<h{rng.randint(2, 4)}>{words(rng.randint(1, 6))}</h2>", 1)]
            elif kind < 0.86:
                body += [("<ul>", None), *[(f"<li>{prose(1)}</li>", 1) for _ in range(rng.randint(2, 5))], ("</ul>", None)]
            elif kind < 0.9:
                body += [(f"<blockquote>{prose(1)}</blockquote>", 1)]
            elif kind < 0.94:
                body += [(f"<p><b>{sentence()}<br>", 1)]
            elif kind < 0.97:
                body += other(rng.choice(["ad", "share", "sidebar", "notice", "form"]))
            else:
                body += [("<table><tr>", None), (f"<td>{words(2)}</td>", 1), (f"<td>{prose(1)}</td>", 1), ("</tr></table>", None)]
        if rng.random() < 0.1:
            body += other("comments")
        wrap = [(f"<{tag}{at}>", None), *body, (f"</{tag}>", None)]
        if rng.random() < 0.3:
            box = rng.choice(["div", "main", "section"])
            wrap = [(f"<{box}{attr(TEXT_WORDS + ['wrapper', 'container'])}>", None), *wrap, (f"</{box}>", None)]
        return wrap

    for _ in range(count):
        before = [other(k) for k in rng.sample(["header", "menu", "notice", "ad", "form", "sidebar"], rng.randint(0, 4))]
        after = [other(k) for k in rng.sample(["comments", "sidebar", "share", "ad", "footer", "notice", "menu"], rng.randint(0, 4))]
        if rng.random() < 0.15:
            before, after = [], []
        items = [x for part in (*before, article() if rng.random() < 0.97 else [], *after) for x in part]
        html, labels = leaves(items)
        yield f"<!DOCTYPE html><html><head><title>{words(3)}</title></head><body>{html}</body></html>", [y for y in labels if y is not None]


class ChainModel:
    """Weights of a linear-chain CRF with the labels 0 (other) and 1 (text)."""

    def __init__(self, names: list[str]):
        self.index = {f: k for k, f in enumerate(names)}
        self.emit = np.zeros((len(names), 2))
        self.move = np.zeros((2, 2))

    def scores(self, page: list[list[str]]) -> np.ndarray:
        out = np.zeros((len(page), 2))
        for t, names in enumerate(page):
            for f in names:
                k = self.index.get(f)
                if k is not None:
                    out[t] += self.emit[k]
        return out

    def decode(self, page: list[list[str]]) -> list[int]:
        """The best labels (Viterbi)."""
        s, move = self.scores(page).tolist(), self.move.tolist()
        if not s:
            return []
        best, back = s[0], []
        for now in s[1:]:
            came = [0 if best[0] + move[0][y] >= best[1] + move[1][y] else 1 for y in (0, 1)]
            back.append(came)
            best = [best[came[y]] + move[came[y]][y] + now[y] for y in (0, 1)]
        labels = [0 if best[0] >= best[1] else 1]
        for came in reversed(back):
            labels.append(came[labels[-1]])
        return labels[::-1]

    def fit(self, pages: list[list[list[str]]], labels: list[list[int]], steps: int = 150, l2: float = 0.02, rate: float = 0.1):
        """Maximum likelihood by Adam on all pages at once; pages are padded to one length."""
        n, longest = len(pages), max(map(len, pages))
        rows, cols, places = [], [], []
        y, there = np.zeros((n, longest), int), np.zeros((n, longest), bool)
        for p, (page, own) in enumerate(zip(pages, labels)):
            y[p, :len(own)], there[p, :len(own)] = own, True
            for t, names in enumerate(page):
                for f in names:
                    if f in self.index:
                        rows.append(p * longest + t)
                        cols.append(self.index[f])
        rows, cols = np.array(rows), np.array(cols)
        params = [self.emit, self.move]
        first, second = [np.zeros_like(x) for x in params], [np.zeros_like(x) for x in params]
        gold = np.eye(2)[y] * there[..., None]
        gold_move = np.einsum("pta,ptb->ab", gold[:, :-1], gold[:, 1:])
        for step in range(1, steps + 1):
            s = np.stack([np.bincount(rows, self.emit[cols, c], n * longest) for c in (0, 1)], -1).reshape(n, longest, 2)
            fwd, bwd = np.zeros_like(s), np.zeros_like(s)
            fwd[:, 0] = s[:, 0]
            for t in range(1, longest):
                new = np.logaddexp.reduce(fwd[:, t - 1, :, None] + self.move, axis=1) + s[:, t]
                fwd[:, t] = np.where(there[:, t, None], new, fwd[:, t - 1])
            total = np.logaddexp.reduce(fwd[:, -1], axis=1)
            for t in range(longest - 2, -1, -1):
                new = np.logaddexp.reduce(self.move[None] + (s[:, t + 1] + bwd[:, t + 1])[:, None, :], axis=2)
                bwd[:, t] = np.where(there[:, t + 1, None], new, bwd[:, t + 1])
            node = np.exp(fwd + bwd - total[:, None, None]) * there[..., None]
            pair = np.exp(fwd[:, :-1, :, None] + self.move + (s[:, 1:] + bwd[:, 1:])[:, :, None, :]
                          - total[:, None, None, None]) * there[:, 1:, None, None]
            off = (gold - node).reshape(-1, 2)
            slopes = [np.stack([np.bincount(cols, off[rows, c], len(self.index)) for c in (0, 1)], -1), gold_move - pair.sum((0, 1))]
            for k, (x, g) in enumerate(zip(params, slopes)):
                g = g - l2 * n / 100 * x
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                x += rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)


def trained(count: int = 700, least: int = 3) -> ChainModel:
    """The model after training on ``labelled_pages``; features seen in fewer than ``least`` blocks stay out."""
    pages, labels, seen = [], [], {}
    for html, own in labelled_pages(count):
        page = features(blocks(html))
        if len(page) != len(own):
            continue  # a layout whose leaves run together
        if not page:
            continue
        pages.append(page)
        labels.append(own)
        for names in page:
            for f in names:
                seen[f] = seen.get(f, 0) + 1
    model = ChainModel(sorted(f for f, k in seen.items() if k >= least))
    model.fit(pages, labels)
    return model


def main_text(html: str | None, model: ChainModel) -> str:
    found = blocks(html)
    labels = model.decode(features(found))
    return "\n".join(text for (text, *_), y in zip(found, labels) if y)


def extract(pages: DataFrame, model: ChainModel | None = None) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``."""
    sent = pages.sparkSession.sparkContext.broadcast(model or trained())

    def run(batches):
        own = sent.value
        for b in batches:
            for k in range(0, b.num_rows, 128):
                part = b.slice(k, 128)
                texts = [main_text(h, own) for h in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                     pa.array([len(x) for x in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])
    schema = T.StructType([T.StructField("page_id", pages.schema["page_id"].dataType),
                           T.StructField("url", pages.schema["url"].dataType),
                           T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return pages.select("page_id", "url", "html").mapInArrow(run, schema)

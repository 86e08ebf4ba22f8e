"""Main text of web pages, by a tree-structured graphical model over the DOM.

Each block element of a page is a binary variable, main text or not, with potentials for what it is
(tag, words of class and id, share of linked text, length of its own text) and for each pair of
parent and child, by the child's tag. Potentials are estimated with smoothing from the hand-labelled
pages of labelled_pages.py. Sum-product message passing, once upward and once downward, gives each
element's marginal; the text blocks of elements above one half are kept in page order.

Markup is read leniently: unknown and unclosed elements, stray end tags and tags cut off by the end
of the page are all fine. Comments, scripts, styles, form controls, the head and other elements that show
nothing have no text. White space in a block becomes one space; a line break counts as white space.

Results in special cases: a null or empty page, and one without main text, give an empty text; so
page_id and url may be null or repeated, pages are taken one by one. Text without markup is one block.
"""

import html
import math
import re
from collections import Counter, defaultdict

import pyarrow as pa

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|math|select|textarea|button|iframe|object|title|head(?!er))\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_LABEL = re.compile(r'\by="([01])"')
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

BLOCKS = frozenset(
    "html body main article section header footer nav aside div form fieldset p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd "
    "table thead tbody tfoot tr td th caption blockquote pre figure figcaption address details summary hr dialog center".split())
_CLOSES_P = BLOCKS - {"html", "body"}
_VOID = frozenset("hr br img input meta link wbr area base col embed param source track".split())
_SAME = {  # a start tag ends an open element of these, up to the container
    "li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}


class Page:
    """The block elements of a page in document order: parent, tag, names, label; its text blocks."""

    def __init__(self, source):
        self.parent, self.tag, self.names, self.label = [-1], ["root"], [()], [None]
        self.blocks = []  # (element, text, characters in links)
        self._open, self._text, self._linked, self._in_link = [0], [], 0, False
        at, n = 0, len(source)
        for token in _TOKEN.finditer(source):
            if token.start() < at:
                continue
            if at < token.start():
                self._add(source[at:token.start()])
            at = token.end()
            if token[1]:  # nothing inside shows: go on after the end tag
                end = re.compile(rf"</{token[1]}\s*>", re.I).search(source, at)
                at = end.end() if end else (n if token[1].lower() != "head" else at)
            elif token[3]:
                self._element(token[3].lower(), token[2] == "/", token[4])
        if at < n:
            self._add(source[at:])
        self._flush()

    def _add(self, text):
        self._text.append(text)
        if self._in_link:
            self._linked += len(text)

    def _flush(self):
        text = " ".join(html.unescape("".join(self._text)).split()) if self._text else ""
        if text:
            self.blocks.append((self._open[-1], text, self._linked))
        self._text, self._linked = [], 0

    def _pop_to(self, tags, stops=frozenset()):
        for depth in range(len(self._open) - 1, 0, -1):
            tag = self.tag[self._open[depth]]
            if tag in tags:
                del self._open[depth:]
                return
            if tag in stops:
                return

    def _element(self, tag, end, attributes):
        if tag == "a":
            self._in_link = not end
        if tag not in BLOCKS:
            if tag == "br":
                self._text.append(" ")
            return
        self._flush()
        self._in_link = False
        if end:
            self._pop_to({tag})
            return
        if tag in _CLOSES_P:
            self._pop_to({"p", "h1", "h2", "h3", "h4", "h5", "h6"} if tag != "p" else {"p"}, {"div", "section", "article", "td", "li"})
        if tag in _SAME:
            self._pop_to(*_SAME[tag])
        if tag in _VOID:
            return
        names = " ".join(a or b or c for a, b, c in _NAMES.findall(attributes)) if attributes else ""
        label = _LABEL.search(attributes) if attributes else None
        up = self._open[-1]
        self.parent.append(up)
        self.tag.append(tag)
        self.names.append(tuple({w.lower() for w in _WORD.findall(names)}))
        self.label.append(int(label[1]) if label else self.label[up])
        self._open.append(len(self.tag) - 1)

    def features(self):
        """The features of each element, as strings."""
        n = len(self.tag)
        own, linked, below, below_linked, stops = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
        for element, text, link in self.blocks:
            own[element] += len(text)
            linked[element] += link
            stops[element] += text.count(". ") + text.count(", ") + text.endswith((".", "!", "?"))
        for i in range(n - 1, -1, -1):
            below[i] += own[i]
            below_linked[i] += linked[i]
            if i:
                below[self.parent[i]] += below[i]
                below_linked[self.parent[i]] += below_linked[i]
        out = []
        for i in range(n):
            f = [f"tag={self.tag[i]}"]
            f += [f"name={w}" for w in self.names[i]]
            if own[i]:
                f.append(f"size={min(4, own[i].bit_length() // 2)}")
                f.append(f"stops={min(2, stops[i])}")
            if below[i]:
                f.append(f"links={min(2, 4 * below_linked[i] // below[i])}")
            out.append(f)
        return out


class TreeModel:
    """Log potentials of single elements, and of child given parent by the child's tag."""

    def __init__(self, pages, smooth=0.5):
        seen, total = defaultdict(lambda: [smooth, smooth]), [1.0, 1.0]
        pairs = defaultdict(lambda: [[0.0, 0.0], [0.0, 0.0]])
        for page in pages:
            for i, features in enumerate(page.features()):
                y = page.label[i]
                if y is None:
                    continue
                total[y] += 1
                for f in features:
                    seen[f][y] += 1
                up = page.label[page.parent[i]] if i else None
                if up is not None:
                    for key in (page.tag[i], None):
                        pairs[key][up][y] += 1
        # What a text looks like says less than where it stands: those features overlap, and comments
        # and notices read like main text.
        self.single = {
            f: (math.log(c[1] / (total[1] + 1)) - math.log(c[0] / (total[0] + 1)))
            * (0.4 if f.startswith(("size=", "stops=")) else 1.0) for f, c in seen.items()}
        every = pairs[None]
        self.pair = {
            tag: [[math.log((c[a][b] + 2 * (every[a][b] + 0.5) / (sum(every[a]) + 1)) / (sum(c[a]) + 2)) for b in (0, 1)] for a in (0, 1)]
            for tag, c in pairs.items()}

    def marginals(self, page):
        """Probability of each element being main text: one pass up, one pass down."""
        n = len(page.tag)
        single, pair, any_pair = self.single, self.pair, self.pair[None]
        odds = [sum(single.get(f, 0.0) for f in features) for features in page.features()]
        up = [None] * n  # message of an element to its parent, for the parent's two states
        low, high = [0.0] * n, odds[:]  # unnormalised log belief in 0 and 1 from below
        for i in range(n - 1, 0, -1):
            p = pair.get(page.tag[i], any_pair)
            message = [_log_sum(p[a][0] + low[i], p[a][1] + high[i]) for a in (0, 1)]
            up[i] = message
            low[page.parent[i]] += message[0]
            high[page.parent[i]] += message[1]
        belief = [None] * n
        belief[0] = (low[0], high[0])
        for i in range(1, n):
            p = pair.get(page.tag[i], any_pair)
            above = belief[page.parent[i]]
            rest = (above[0] - up[i][0], above[1] - up[i][1])  # the parent without this child
            down = [_log_sum(rest[0] + p[0][b], rest[1] + p[1][b]) for b in (0, 1)]
            total = _log_sum(low[i] + down[0], high[i] + down[1])
            belief[i] = (low[i] + down[0] - total, high[i] + down[1] - total)
        return [1 / (1 + math.exp(max(-700.0, min(700.0, b[0] - b[1])))) for b in belief]


def _log_sum(a, b):
    return a + math.log1p(math.exp(b - a)) if a >= b else b + math.log1p(math.exp(a - b))


def trained():
    from .labelled_pages import LABELLED

    return TreeModel([Page(source) for source in LABELLED])


def main_text(model, source):
    page = Page(source)
    belief = model.marginals(page)
    return "\n".join(text for element, text, _ in page.blocks if belief[element] > 0.5)


def extracted(pages):
    """(page_id, url, text, n_chars) for each row of pages (page_id, url, html)."""
    model = trained()

    def extract(batches):
        for batch in batches:
            texts = [main_text(model, source) if source else "" for source in batch["html"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    columns = pages.select("page_id", "url", "html")
    kinds = {f.name: f.dataType.simpleString() for f in columns.schema}
    return columns.mapInArrow(extract, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint")

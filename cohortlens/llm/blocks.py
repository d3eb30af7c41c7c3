"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks: runs of text between tags that begin or end a
block, each with the path of open tags (and their class and id words). A block
is described by hashed vectors of its tag path and of its words, and a few
numbers (length, share of linked text, ...). A bidirectional LSTM in numpy reads
the sequence of a page's blocks and labels each one with the context of the
whole page; blocks labelled as content are the text.

Pages carry no labels. The labeller is trained on at most `TRAIN_PAGES` pages
(by hash of the address and id) that mark their article with HTML5 tags: blocks
inside it, but not in a menu, form, aside and the like, are content. To make it
read more than those tags, training pages are also shown with their semantic
tags replaced by plain ones, and with boilerplate of other kinds (sidebars, notices,
adverts, forms, comments) put in. Training runs on the driver; labelling runs in
Spark, page by page.

Character references are decoded, white space inside a block becomes one space,
blocks are joined by a line feed. Scripts, styles and comments in the markup are
never blocks. A frame, drawing, template, object, canvas or noscript element is none up to its own
end tag; where that is missing, it hides nothing and the text behind it is read. Null and empty pages, and pages without content, give an empty
text. Repeated rows get the same text.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sharing import receive, send
from .texts import kept, pieces, strings

PATHS = 320
WORDS = 64
NUMBERS = 8
INPUT = PATHS + WORDS + NUMBERS
HIDDEN = 20
TRAIN_PAGES = 600
TRAIN_BLOCKS = 150  # of the pages learnt from; longer ones are read, not learnt from
EPOCHS = 12
# Blocks read by one run of the network; longer pages go through in overlapping stretches.
STRETCH = 2000
OVERLAP = 100

# Elements of HTML.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 head header hr html iframe legend li main menu nav ol optgroup option p pre section select"
    " summary table tbody td textarea tfoot th thead title tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = "script|style"  # without an end tag they run to the end of the page
HIDDEN_TAGS = "noscript|template|svg|object|canvas"  # may nest; without an end tag they hide nothing
SEMANTIC = ("article", "main")
BOILERPLATE = frozenset("nav header footer aside form head button select menu dialog textarea fieldset title".split())
BOILERPLATE_WORDS = (
    "ad ads advert advertisement banner sponsor promo sidebar side-bar menu navbar breadcrumb breadcrumbs footer header masthead"
    " cookie consent notice popup modal newsletter subscribe signup login share social comment comments reply replies related"
    " recommended widget"
).split()
CLOSED_BY = {
    "p": BLOCK_TAGS - {"body", "html", "head"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"},
    "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option", "optgroup"}, "head": {"body"},
}

_SKIPPED = r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(?P<raw>" + RAW_TAGS + r")(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
_ATTRIBUTES = r"(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
_TOKEN = re.compile(
    _SKIPPED + r"|<svg(?=[\s/])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+(?<=/)>"
    r"|<(?P<close>/?)(?P<tag>[A-Za-z][^\s/>]*)" + _ATTRIBUTES +
    r"|<[!?/][^>]*>?|<[A-Za-z][^>]*>?|(?P<text>[^<]+|<)", re.S | re.I,
)
_NESTED = re.compile(_SKIPPED + r"|<(?P<close>/?)(?P<tag>" + HIDDEN_TAGS + r")(?=[\s/>])" + _ATTRIBUTES, re.S | re.I)
_HIDDEN = frozenset(HIDDEN_TAGS.split("|"))
_FRAME_END = re.compile(r"</iframe\s*>", re.I)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_PART = re.compile(r"[A-Za-z]+")


class Block:
    __slots__ = ("path", "parts", "linked")

    def __init__(self, path: tuple[str, ...]) -> None:
        self.path, self.parts, self.linked = path, [], 0


def _element(tag: str, rest: str) -> str:
    if "=" not in rest:
        return tag
    names = [x.lower() for m in _NAMES.finditer(rest) for x in _PART.findall(m[1] or m[2] or m[3] or "")]
    return f"{tag}.{'.'.join(names)}" if names else tag


def _hidden(page: str) -> dict[int, int]:
    """Where hidden elements begin and end; those without an end tag are left out."""
    found: dict[int, int] = {}
    opened: dict[str, list[int]] = {tag: [] for tag in _HIDDEN}
    for m in _NESTED.finditer(page):
        if m["tag"] is None:
            continue
        tag = m["tag"].lower()
        if not m["close"]:
            if tag != "svg" or not m["rest"].endswith("/"):
                opened[tag].append(m.start())
        elif opened[tag]:
            found[opened[tag].pop()] = m.end()
    return found


def _tokens(page: str) -> Iterator[re.Match]:
    """Tokens outside of hidden elements and frames."""
    hidden: dict[int, int] | None = None
    frames = True  # whether an end tag of a frame may follow
    place: int | None = 0
    while place is not None:
        start, place = place, None
        for m in _TOKEN.finditer(page, start):
            if m["tag"] is not None and not m["close"]:
                tag = m["tag"].lower()
                if tag in _HIDDEN:
                    if hidden is None:
                        hidden = _hidden(page)
                    place = hidden.get(m.start())
                elif tag == "iframe" and frames:
                    end = _FRAME_END.search(page, m.end())
                    frames = end is not None
                    place = end.end() if end else None
                if place is not None:
                    break
            yield m


def cut(page: str) -> list[tuple[tuple[str, ...], str, float]]:
    """Blocks in order: tag path, text, share of linked text."""
    stack: list[str] = []  # elements, tag first
    tags: list[str] = []
    blocks: list[Block] = []
    current: Block | None = None
    links = 0
    for m in _tokens(page):
        text = m["text"]
        if text is not None:
            if current is None:
                if text.isspace():
                    continue
                current = Block(tuple(stack))
                blocks.append(current)
            current.parts.append(text)
            if links:
                current.linked += len(text)
            continue
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if m["close"]:
            if tag in BLOCK_TAGS:
                current = None
            if tag in tags:
                while tags:
                    stack.pop()
                    last = tags.pop()
                    links -= last == "a"
                    if last == tag:
                        break
            continue
        if tag in BLOCK_TAGS:
            current = None
        if tag == "br":
            if current is not None:
                current.parts.append(" ")
            continue
        while tags and _ends(tags, tag):
            stack.pop()
            links -= tags.pop() == "a"
        if tag not in VOID_TAGS and not m["rest"].endswith("/"):
            stack.append(_element(tag, m["rest"]))
            tags.append(tag)
            links += tag == "a"
    out = []
    for b in blocks:
        raw = "".join(b.parts)
        text = " ".join((html.unescape(raw) if "&" in raw else raw).split())
        if text:
            out.append((b.path, text, min(1.0, b.linked / max(1, len(raw)))))
    return out


def _ends(tags: list[str], new: str) -> bool:
    """Whether a new element ends the innermost element that may be left open."""
    if new not in BLOCK_TAGS:
        return False
    for tag in reversed(tags):
        if tag in CLOSED_BY:
            return new in CLOSED_BY[tag]
        if tag in BLOCK_TAGS:
            return False
    return False


_seen: dict[str, int] = {}


def _slot(text: str, size: int) -> int:
    found = _seen.get(text)
    if found is None:
        if len(_seen) > 200_000:
            _seen.clear()
        found = _seen[text] = zlib.crc32(text.encode("utf-8", "replace"))
    return found % size


def describe(blocks: list[tuple[tuple[str, ...], str, float]]) -> np.ndarray:
    out = np.zeros((len(blocks), INPUT), np.float32)
    n = len(blocks)
    for i, (path, text, linked) in enumerate(blocks):
        row = out[i]
        for element in path[2:] if len(path) > 2 else path:
            for part in element.split("."):
                row[_slot("<" + part, PATHS)] = 1
        words = text.split(" ")
        for w in words:
            row[PATHS + _slot(w, WORDS)] += 1
        own = row[PATHS : PATHS + WORDS]
        own /= np.linalg.norm(own)  # a word repeated a thousand times is still one word
        size = len(text)
        row[-NUMBERS:] = (
            np.log1p(size) / 6, np.log1p(len(words)) / 4, linked, text[-1] in ".!?:;\"'", len(path) / 8,
            i / n, sum(map(text.count, ".,;")) / len(words), size < 25,
        )
    return out


class Labeller:
    """A bidirectional LSTM with a logistic output."""

    def __init__(self) -> None:
        rng = np.random.default_rng(3)
        d, h = INPUT, HIDDEN
        self.w: dict[str, np.ndarray] = {}
        for way in "fb":
            self.w[f"x{way}"] = (rng.standard_normal((d, 4 * h)) * 0.1).astype(np.float32)
            self.w[f"h{way}"] = (rng.standard_normal((h, 4 * h)) * (1 / np.sqrt(h))).astype(np.float32)
            self.w[f"b{way}"] = np.concatenate((np.zeros(h), np.ones(h), np.zeros(2 * h))).astype(np.float32)
        self.w["o"] = (rng.standard_normal((2 * h, 1)) * 0.1).astype(np.float32)
        self.w["s"] = (rng.standard_normal((d, 1)) * 0.01).astype(np.float32)
        self.w["c"] = np.zeros(1, np.float32)

    def _run(self, x: np.ndarray, live: np.ndarray, way: str) -> tuple[np.ndarray, list]:
        """States of all steps (pages x steps x hidden); `live` marks real blocks."""
        pages, steps, _ = x.shape
        n = HIDDEN
        given = (x.reshape(-1, x.shape[2]) @ self.w["x" + way] + self.w["b" + way]).reshape(pages, steps, 4 * n)
        h, c = np.zeros((pages, n), np.float32), np.zeros((pages, n), np.float32)
        out, tape = np.zeros((pages, steps, n), np.float32), []
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            g = given[:, t] + h @ self.w["h" + way]
            gates = 1 / (1 + np.exp(-g[:, : 3 * n]))
            i, f, o = gates[:, :n], gates[:, n : 2 * n], gates[:, 2 * n :]
            new = np.tanh(g[:, 3 * n :])
            m = live[:, t : t + 1]
            c_new = f * c + i * new
            squashed = np.tanh(c_new)
            tape.append((t, h, c, i, f, o, new, squashed, m))
            h = np.where(m, o * squashed, 0)
            c = np.where(m, c_new, 0)
            out[:, t] = h
        return out, tape

    def logits(self, x: np.ndarray, live: np.ndarray) -> tuple[np.ndarray, tuple]:
        f, tape_f = self._run(x, live, "f")
        b, tape_b = self._run(x, live, "b")
        both = np.concatenate((f, b), axis=2)
        z = both @ self.w["o"] + x @ self.w["s"] + self.w["c"]
        return z[:, :, 0], (both, tape_f, tape_b)

    def gradients(self, x: np.ndarray, live: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        z, (both, *tapes) = self.logits(x, live)
        gap = ((1 / (1 + np.exp(-z)) - label) * live / max(1, live.sum())).astype(np.float32)
        grad = {
            "o": (both.reshape(-1, 2 * HIDDEN).T @ gap.reshape(-1, 1)), "c": gap.sum(keepdims=True).reshape(1),
            "s": x.reshape(-1, INPUT).T @ gap.reshape(-1, 1),
        }
        for k, (way, tape) in enumerate(zip("fb", tapes)):
            out = gap[:, :, None] * self.w["o"][k * HIDDEN : (k + 1) * HIDDEN, 0]
            dh, dc = np.zeros_like(out[:, 0]), np.zeros_like(out[:, 0])
            dg_all = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
            grad["h" + way] = np.zeros_like(self.w["h" + way])
            for t, h, c, i, f, o, new, squashed, m in reversed(tape):
                d = np.where(m, dh + out[:, t], 0)
                dcn = np.where(m, dc, 0) + d * o * (1 - squashed**2)
                dg = np.concatenate((
                    dcn * new * i * (1 - i), dcn * c * f * (1 - f), d * squashed * o * (1 - o), dcn * i * (1 - new**2)), axis=1)
                dg_all[:, t] = dg
                grad["h" + way] += h.T @ dg
                dh, dc = dg @ self.w["h" + way].T, dcn * f
            grad["x" + way] = x.reshape(-1, INPUT).T @ dg_all.reshape(-1, 4 * HIDDEN)
            grad["b" + way] = dg_all.sum(axis=(0, 1))
        return grad

    def train(self, pages: list[tuple[np.ndarray, np.ndarray]]) -> None:
        rng = np.random.default_rng(4)
        mean = {k: np.zeros_like(v) for k, v in self.w.items()}
        square = {k: np.zeros_like(v) for k, v in self.w.items()}
        t = 0
        by_size = sorted(range(len(pages)), key=lambda i: len(pages[i][0]))
        groups = [by_size[i : i + 16] for i in range(0, len(by_size), 16)]
        for _ in range(EPOCHS):
            for g in rng.permutation(len(groups)):
                own = [pages[i] for i in groups[g]]
                x, live = padded([p[0] for p in own])
                # Some path elements are hidden, so that none is needed.
                x[:, :, :PATHS] *= rng.random((len(own), 1, PATHS)) > 0.08
                label = np.zeros(live.shape, np.float32)
                for k, p in enumerate(own):
                    label[k, : len(p[1])] = p[1]
                t += 1
                for k, d in self.gradients(x, live, label).items():
                    d = np.clip(d, -1, 1)
                    mean[k] = 0.9 * mean[k] + 0.1 * d
                    square[k] = 0.999 * square[k] + 0.001 * d * d
                    self.w[k] -= 0.01 * (mean[k] / (1 - 0.9**t)) / (np.sqrt(square[k] / (1 - 0.999**t)) + 1e-8)

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Whether each block of each page is content."""
        parts = []
        for k, x in enumerate(pages):
            for a in range(0, max(len(x), 1), STRETCH):
                first, last = max(0, a - OVERLAP), min(len(x), a + STRETCH + OVERLAP)
                parts.append((k, a, first, x[first:last]))
        out = [np.zeros(len(x), bool) for x in pages]
        order = sorted(range(len(parts)), key=lambda i: -len(parts[i][3]))
        for i in range(0, len(order), 128):
            group = [parts[j] for j in order[i : i + 128]]
            x, live = padded([g[3] for g in group])
            if x.shape[1] == 0:
                continue
            z, _ = self.logits(x, live)
            for (k, a, first, own), row in zip(group, z):
                last = min(len(pages[k]), a + STRETCH)
                out[k][a:last] = row[a - first : last - first] > 0
        return out


def padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max((len(r) for r in rows), default=0)
    x, live = np.zeros((len(rows), steps, INPUT), np.float32), np.zeros((len(rows), steps), bool)
    for i, r in enumerate(rows):
        x[i, : len(r)] = r
        live[i, : len(r)] = True
    return x, live


def _parts(path: tuple[str, ...]) -> set[str]:
    return {p for element in path for p in element.split(".")}


def teach(blocks: list[tuple[tuple[str, ...], str, float]]) -> np.ndarray | None:
    """Labels of a page that marks its article; None if it doesn't."""
    marked = [any(e.split(".")[0] in SEMANTIC for e in path) for path, _, _ in blocks]
    if not any(marked):
        return None
    bad = BOILERPLATE | set(BOILERPLATE_WORDS)
    return np.array([m and not any(_parts((e,)) & bad for e in path) for m, (path, _, _) in zip(marked, blocks)], np.float32)


def variants(blocks: list[tuple[tuple[str, ...], str, float]], label: np.ndarray, rng: np.random.Generator, other: list[str]):
    """The page as it is, and once more with plain tags and other boilerplate."""
    yield blocks, label
    root = blocks[0][0][:1]
    plain_tags = ["div", "section", "div.content", "div.post", "div.entry.content", "main", "article", "td"]
    swap = {t: plain_tags[rng.integers(len(plain_tags))] for t in SEMANTIC}
    leaves = [("ul", "li"), ("ol", "li"), ("h2",), ("h3",), ("blockquote", "p"), ("table", "tr", "td"), ("pre",), ("dl", "dd")]
    new, marks = [], []

    def boilerplate(inside: bool) -> None:
        """One to four blocks of a kind, around the article or inside of it."""
        word = BOILERPLATE_WORDS[rng.integers(len(BOILERPLATE_WORDS))]
        tag = ("div", "section", "ul", "aside", "form", "header", "footer", "nav", "p")[rng.integers(9)]
        own = tag if tag in BOILERPLATE and rng.random() < 0.5 else f"{tag}.{word}"
        path = (*root, "body", *((next((b[0][2:3] for b, m in zip(blocks, label) if m), ())) if inside else ()), own)
        for _ in range(rng.integers(1, 5)):
            text = " ".join(other[rng.integers(len(other))].split()[: int(rng.integers(1, 30))])
            leaf = [("li", "a"), ("p",), (), ("a",), ("label",), ("h3",)][rng.integers(6)]
            new.append(((*path, *leaf[:1]), text or "x", float("a" in leaf)))
            marks.append(0.0)

    plain = rng.random() < 0.4
    where = set(rng.integers(0, len(blocks) + 1, rng.integers(1, 5)).tolist())
    for i, ((path, text, linked), m) in enumerate(zip(blocks, label)):
        if i in where:
            boilerplate(bool(m) and rng.random() < 0.7)
        if m and path[-1] == "p" and rng.random() < 0.3:  # articles have lists, tables and headings too
            path = (*path[:-1], *leaves[rng.integers(len(leaves))])
        if rng.random() < 0.1:
            text = " ".join(text.split()[: int(rng.integers(1, 4))])
        if plain:
            path = tuple(swap.get(e, e) for e in path)
        new.append((path, text, linked))
        marks.append(float(m))
    if len(blocks) in where:
        boilerplate(False)
    yield new, np.array(marks, np.float32)


def train(pages: list[str]) -> Labeller | None:
    rng = np.random.default_rng(6)
    read = [b for b in map(cut, pages) if b]
    taught = [(b, label) for b in read if (label := teach(b)) is not None and len(b) <= TRAIN_BLOCKS]
    if not taught:
        return None
    other = [text for b in read for _, text, _ in b[:40]]
    rows = [(describe(b), m) for page, label in taught for b, m in variants(page, label, rng, other)]
    net = Labeller()
    net.train(rows)
    return net


def _extract(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net: Labeller | None = receive(shared)
        for whole in batches:
            for batch in pieces(whole, "html", 2 << 20):
                pages = [cut(p) for p in strings(batch.column("html"))]
                if net is None:  # no page to learn from: what the markup says
                    marks = [~_plainly_boilerplate(p) for p in pages]
                else:
                    marks = net.label([describe(p) for p in pages])
                found = ["\n".join(text for (_, text, _), m in zip(p, mark) if m) for p, mark in zip(pages, marks)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )
    return run


def _plainly_boilerplate(page: list[tuple[tuple[str, ...], str, float]]) -> np.ndarray:
    bad = BOILERPLATE | set(BOILERPLATE_WORDS)
    return np.array([bool(_parts(path) & bad) for path, _, _ in page], bool)


def extract(pages: DataFrame) -> DataFrame:
    """`page_id`, `url`, `text` and `n_chars` of every page."""
    rows = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.col("html"), F.lit("")).alias("html"))
    key = F.xxhash64("page_id", "url")
    few = kept(rows.where(F.length("html") > 0).select(key.alias("key"), "html").orderBy("key").limit(TRAIN_PAGES))
    sample = sorted(r[0] for r in few.select("html").collect())  # at most TRAIN_PAGES pages
    shared = send(pages.sparkSession, train(sample))
    return rows.mapInArrow(_extract(shared), "page_id long, url string, text string, n_chars long")

"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is cut into leaf blocks: the text between tags that start or end a block. Each has the tags, class
and id words of its ancestors and figures of its text as features. A chain with two labels (text, rest)
scores the sequence of blocks; Viterbi decoding gives the labels, and the text blocks joined by line feeds
are the result.

Training pages: at most ``FIT_PAGES`` pages in hash order whose markup names the article and its
surroundings; their blocks are labelled by it. Copies of them in other common markup (article named by
class or id only, sidebars, notices, forms, comments around and inside it) teach the other names.
Every page is decoded over its whole html.

Defined cases: null or empty html gives empty text; markup that is cut off ends there; a tag left open closes with its
parent; text without any tag is one block; equal scores prefer the rest; repeated rows give equal
texts; without training pages the weights are 0 and texts are empty. Columns named like the results are replaced.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm.common import first_by_hash, ready, table

FIT_PAGES = 200
#: Copies in other markup made of each.
COPIES = 4
#: Longer pages are not used for fitting.
FIT_CHARS = 200_000
TEXT, REST = 1, 0

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
HIDDEN = frozenset("script style template noscript title textarea svg iframe select".split())
# Elements whose text is part of the line around them (MathML), and those that a slash can close.
MATHS = frozenset("math mrow mi mo mn mtext ms mspace msup msub msubsup mfrac msqrt mroot mstyle mover munder munderover semantics".split())
CLOSED_BY_SLASH = MATHS | {"svg"}
IN_LINE = INLINE | MATHS

_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z|(?=<))|<[!?][^>]*(?:>|\Z)", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")


@dataclass
class Block:
    """A leaf block: raw text, the names of its ancestors, its innermost block tag, characters inside links."""

    raw: str
    names: frozenset[str]
    tag: str
    linked: int
    text: str = ""


def leaf_blocks(page: str) -> list[Block]:
    """The leaf blocks in page order, those without text left out."""
    blocks: list[Block] = []
    stack: list[tuple[str, frozenset[str]]] = []
    parts: list[str] = []
    names: frozenset[str] = frozenset()
    linked = links = 0
    opened: Counter[str] = Counter()

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                tag = next((t for t, _ in reversed(stack) if t not in IN_LINE), "")
                blocks.append(Block("".join(parts), names, tag, linked, text))
            parts.clear()
        linked = 0

    at, size = 0, len(page)
    while at < size:
        found = _MARKUP.search(page, at)
        stop = found.start() if found else size
        if stop > at:
            parts.append(page[at:stop])
            if links:
                linked += stop - at
        if not found:
            break
        at = found.end()
        tag = found.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        if tag in CLOSED_BY_SLASH and (found.group(3) or "").endswith("/"):
            continue
        if tag in HIDDEN and not found.group(1):
            if tag not in IN_LINE:
                flush()
            close = re.compile(f"</{tag}[^>]*>", re.I).search(page, at)
            at = close.end() if close else size
            continue
        if tag not in IN_LINE:
            flush()
        elif tag == "br":
            parts.append(" ")
        if found.group(1):
            if opened[tag]:
                while stack:
                    open_tag, _ = stack.pop()
                    opened[open_tag] -= 1
                    links -= open_tag == "a"
                    if open_tag == tag:
                        break
                names = stack[-1][1] if stack else frozenset()
        elif tag not in VOID:
            own = set() if tag in IN_LINE else {tag}
            for m in _NAMES.finditer(found.group(3) or ""):
                own.update("." + w for w in _WORD.findall((m.group(1) or m.group(2) or m.group(3) or "").lower()))
            if tag == "p" and stack and stack[-1][0] == "p":
                stack.pop()
                opened["p"] -= 1
            parent = stack[-1][1] if stack else frozenset()
            names = parent if own <= parent else parent | own
            stack.append((tag, names))
            opened[tag] += 1
            links += tag == "a"
    flush()
    return blocks


def _figures(block: Block) -> Iterator[str]:
    size = len(block.text)
    yield f"size={min(size // 40, 6)}"
    yield f"links={round(4 * min(1.0, block.linked / max(1, len(block.raw))))}"
    yield f"own={block.tag}"
    yield f"ends={block.text[-1] in '.!?'}"


# ------------------------------------------------------------------ the chain


@dataclass
class Chain:
    """Weights for label 1 of every feature, and of label changes; label 0 scores 0."""

    weights: dict[str, float] = field(default_factory=dict)
    turns: list[list[float]] = field(default_factory=lambda: [[0.0, 0.0], [0.0, 0.0]])

    def score(self, block: Block) -> float:
        get = self.weights.get
        return get("bias", 0.0) + sum(get(n, 0.0) for n in block.names) + sum(get(f, 0.0) for f in _figures(block))

    def viterbi(self, blocks: list[Block]) -> list[int]:
        if not blocks:
            return []
        value, back = [0.0, self.score(blocks[0])], []
        for block in blocks[1:]:
            own, step, new = (0.0, self.score(block)), [], []
            for label in (0, 1):
                before = 1 if value[1] + self.turns[1][label] > value[0] + self.turns[0][label] else 0
                step.append(before)
                new.append(value[before] + self.turns[before][label] + own[label])
            back.append(step)
            value = new
        labels = [1 if value[1] > value[0] else 0]
        for step in reversed(back):
            labels.append(step[labels[-1]])
        return labels[::-1]

    def _gradient(self, blocks: list[Block], gold: list[int]) -> dict:
        scores = [(0.0, self.score(b)) for b in blocks]
        n = len(blocks)
        alpha, beta = [scores[0]], [(0.0, 0.0)] * n
        for t in range(1, n):
            alpha.append(tuple(_log_sum(alpha[-1][0] + self.turns[0][y], alpha[-1][1] + self.turns[1][y]) + scores[t][y] for y in (0, 1)))
        for t in range(n - 2, -1, -1):
            beta[t] = tuple(_log_sum(*(self.turns[x][y] + scores[t + 1][y] + beta[t + 1][y] for y in (0, 1))) for x in (0, 1))
        total = _log_sum(*alpha[-1])
        gradient: dict = {}
        for t, block in enumerate(blocks):
            miss = gold[t] - math.exp(alpha[t][1] + beta[t][1] - total)
            if abs(miss) > 1e-6:
                for name in ("bias", *block.names, *_figures(block)):
                    gradient[name] = gradient.get(name, 0.0) + miss
            if t:
                for x in (0, 1):
                    for y in (0, 1):
                        p = math.exp(alpha[t - 1][x] + self.turns[x][y] + scores[t][y] + beta[t][y] - total)
                        gradient[x, y] = gradient.get((x, y), 0.0) + (gold[t - 1] == x and gold[t] == y) - p
        return gradient

    def fit(self, pages: list[tuple[list[Block], list[int]]], passes: int = 8, rate: float = 0.3, decay: float = 1e-3) -> Chain:
        """Maximise the conditional likelihood of the labels (adaptive gradient steps, L2)."""
        squares: dict = {}
        for _ in range(passes):
            for blocks, gold in pages:
                if not blocks:
                    continue
                for name, g in self._gradient(blocks, gold).items():
                    w = self.turns[name[0]][name[1]] if isinstance(name, tuple) else self.weights.get(name, 0.0)
                    # Label changes are held back more, so that the names of elements decide.
                    g -= (50 * decay if isinstance(name, tuple) else decay) * w
                    squares[name] = squares.get(name, 1e-2) + g * g
                    w += rate * g / math.sqrt(squares[name])
                    if isinstance(name, tuple):
                        self.turns[name[0]][name[1]] = w
                    else:
                        self.weights[name] = w
        return self

    def main_text(self, page: str | None) -> str:
        blocks = leaf_blocks(page or "")
        return "\n".join(b.text for b, label in zip(blocks, self.viterbi(blocks), strict=True) if label == TEXT)


def _log_sum(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a + math.log1p(math.exp(b - a))


# ------------------------------------------------------------------ training pages

#: Markup that names what surrounds an article.
SURROUNDINGS = frozenset("nav header footer aside form menu dialog address button".split())
SURROUNDING_WORDS = frozenset(
    ".ad .ads .advert .advertisement .banner .sidebar .menu .nav .navigation .breadcrumb .header .footer .cookie .notice .consent "
    ".popup .newsletter .subscribe .comments .comment .related .share .social .widget .promo .sponsored .disclaimer .pagination .login .search".split()
)
ARTICLE_WORDS = ["article", "content", "post", "entry", "story", "main", "body", "text"]


def labels_of(blocks: list[Block]) -> list[int]:
    """Labels that the markup itself gives: inside the article and in nothing that surrounds one."""
    return [int("article" in b.names and not b.names & (SURROUNDINGS | SURROUNDING_WORDS)) for b in blocks]


def _element(name: str, inner: str, k: int) -> str:
    if not name.startswith("."):
        return f"<{name}>{inner}</{name}>"
    word, tag = name[1:], ("div", "section", "div", "ul")[k % 4]
    return f'<{tag} {("class", "id")[k // 2 % 2]}="{word}">{inner}</{tag}>'


def respelled(page: str, k: int, borrowed: list[str]) -> tuple[list[Block], list[int]] | None:
    """The page in other markup, with its labels: other names for the article, more around and inside it."""
    parts = re.split(r"<article[^>]*>|</article>", page)
    if len(parts) != 3:
        return None
    names = sorted(SURROUNDINGS | SURROUNDING_WORDS)
    mark = "\N{BULLET}" * 3
    some = [f"{mark}{entities.escape(borrowed[(k * 7 + i) % len(borrowed)])}" for i in range(6)]
    extra = []
    for i, text in enumerate(some):
        lines = (f"<p>{text}</p>", f"<ul><li><a href=\"/\">{text}</a></li></ul>", f"<div>{text}</div>", f"<p>{text}</p><p>{text}</p>")
        extra.append(_element(names[(k * 5 + i * 11) % len(names)], lines[(k + i) % 4], k + i))
    inside = parts[1]
    if k % 4 > 1:
        # Articles without a heading.
        inside = re.sub(r"<h1>.*?</h1>", "", inside, flags=re.S)
    cut = inside.find("</p>") + 4
    if k % 3 == 0 and cut > 4:
        inside = inside[:cut] + extra[0] + inside[cut:]
    word = ARTICLE_WORDS[k % len(ARTICLE_WORDS)]
    before = ("<article>", f'<div class="{word}">', f'<main id="{word}">', f'<section class="{word}-{ARTICLE_WORDS[(k + 3) % 8]}">', "<main>")[k % 5]
    after = re.sub(r"<(\w+).*", r"</\1>", before)
    begin, finish = "\N{BLACK SQUARE}" * 3, "\N{WHITE SQUARE}" * 3
    whole = parts[0] + extra[1] + extra[2] + before + f"<u>{begin}</u>" + inside + f"<u>{finish}</u>" + after + extra[3] + extra[4] + parts[2] + extra[5]
    blocks, gold, inner = leaf_blocks(whole), [], False
    for block in blocks:
        inner = inner or begin in block.text
        gold.append(int(inner and mark not in block.text))
        inner = inner and finish not in block.text
        for sign in (begin, finish, mark):
            block.text = block.text.replace(sign, "")
    kept = [(b, g) for b, g in zip(blocks, gold, strict=True) if b.text]
    return [b for b, _ in kept], [g for _, g in kept]


def training_pages(pages: list[str]) -> list[tuple[list[Block], list[int]]]:
    rows, borrowed = [], ["Read more about this."]
    for page in pages:
        blocks = leaf_blocks(page)
        gold = labels_of(blocks)
        if any(gold):
            rows.append((blocks, gold))
            borrowed += [b.text[:200] for b in blocks[:2] + blocks[-2:]]
    for k, page in enumerate(pages):
        for way in range(COPIES):
            if copy := respelled(page, COPIES * k + way, borrowed):
                rows.append(copy)
    return rows


def learn(pages: DataFrame, html: str = "html", rows: int = FIT_PAGES) -> Chain:
    """Fit the chain on at most ``rows`` pages in hash order that name their article."""
    ready(pages.sparkSession)
    named = pages.where(F.col(html).contains("<article") & (F.length(html) <= FIT_CHARS)).select(F.col(html).alias("html"))
    return Chain().fit(training_pages(first_by_hash(named, "html", rows)))


# ------------------------------------------------------------------ the operator


def extract(pages: DataFrame, chain: Chain, html: str = "html") -> DataFrame:
    """The pages with ``text`` (main text) and ``n_chars`` (its code points), without the html."""
    kept = [c for c in pages.columns if c not in (html, "text", "n_chars")]
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*kept).schema.fields]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [chain.main_text(p) for p in batch.column(len(kept)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=[*kept, "text", "n_chars"],
            )

    source = pages.select(*kept, F.col(html).alias("_html"))
    return source.mapInArrow(step, ", ".join([*kinds, "text string, n_chars bigint"]))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages, learn(pages)).select("page_id", "url", "text", "n_chars")

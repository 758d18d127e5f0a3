"""Main text of pages by a linear-chain conditional random field over DOM leaf blocks.

A page is the chain of its leaf blocks; each is main text or not. Features of a block are the
tags and names of its ancestors and the form of its text; transition weights join neighbours.
The field is trained on labelled pages by gradient ascent on the conditional likelihood
(forward-backward), and decoded by Viterbi.

The labelled pages are made here, of many layouts: the marks of their main text are known.
Defined results: a null, empty or text-free page has an empty text; a page without main text
likewise. Blocks keep page order; within a block white space is one space. Repeated rows are read
each, null ids and other columns stay, and no pages give no rows.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from orderloom.llm.dom import BLOCK, Block, blocks_of

SIZE = 1 << 15
# The number of labelled pages that the field is trained on.
PAGES = 1500
EPOCHS = 10
RATE = 0.3
DECAY = 1e-4
MARK = ""

SECTIONS = frozenset("article aside footer form header main nav section dialog table".split())

# ---- features ---------------------------------------------------------------


def path_features(path: tuple) -> list[str]:
    """Tags and names of the ancestors, from the innermost out."""
    out = ["bias"]
    blocks = [p for p in path if p[0] not in ("html", "body")]
    # Inside the innermost element that sections a page, its name and place count together.
    own = [tag for tag, _ in blocks if tag in BLOCK][-2:]
    out.append(f"chain {' '.join(own)}")
    home = next((p for p in reversed(blocks) if p[0] in SECTIONS or p[1]), ("body", ()))
    out += [f"home {home[0]} {name}" for name in home[1] or ("-",)]
    out += [f"home {home[0]} {name} {own[-1] if own else ''}" for name in home[1] or ("-",)]
    for i, (tag, names) in enumerate(reversed(blocks)):
        out.append(f"tag {tag}")
        if i < 2:
            out.append(f"tag{i} {tag}")
        for name in names:
            out.append(f"name {name}")
            if len(name) > 5 and name.endswith("s"):
                out.append(f"name {name[:-1]}")
            out.append(f"pair {tag} {name}")
    return [*dict.fromkeys(out)]


def _bin(value: float, edges: tuple[float, ...]) -> int:
    return sum(value >= e for e in edges)


def text_features(block: Block) -> list[str]:
    """Form of the text: length, links, marks, and the words of short blocks."""
    text = block.text
    words = text.split()
    length = _bin(len(words), (2, 4, 8, 15, 30, 60))
    linked = _bin(block.linked / max(1, len(text)), (0.01, 0.3, 0.7))
    marks = sum(map(text.count, ".,;!?"))
    out = [
        f"words {length}", f"linked {linked}", f"both {length} {linked}",
        f"marks {_bin(marks / len(words), (0.001, 0.05, 0.12))}",
        f"end {text[-1] in '.!?:'}", f"sign {any(c in text for c in '©®|»›')}",
        f"digits {any(c.isdigit() for c in text)}",
    ]
    if len(words) <= 12:
        out += [f"word {w}" for w in {w.strip('.,:;!?()').lower() for w in words}]
    return out


class Scorer:
    """Emission scores of blocks under given weights, with the paths' parts kept."""

    def __init__(self, weights: np.ndarray) -> None:
        self.weights = weights.tolist()
        self.known: dict[str, float] = {}
        self.paths: dict[tuple, float] = {}

    def _weight(self, feature: str) -> float:
        found = self.known.get(feature)
        if found is None:
            found = self.weights[crc32(feature.encode("utf-8", "surrogatepass")) % SIZE]
            if len(self.known) < 200_000:
                self.known[feature] = found
        return found

    def score(self, block: Block) -> float:
        path = self.paths.get(block.path)
        if path is None:
            path = sum(map(self._weight, path_features(block.path)))
            if len(self.paths) < 50_000:
                self.paths[block.path] = path
        return path + sum(map(self._weight, text_features(block)))


def viterbi(scores: list[float], trans: list[list[float]], start: list[float], end: list[float]) -> list[int]:
    """Best labels; ``scores`` are those of label 1 against label 0."""
    if not scores:
        return []
    a, b = start[0], start[1] + scores[0]
    back: list[tuple[int, int]] = []
    (t00, t01), (t10, t11) = trans
    for s in scores[1:]:
        from0 = a + t00, b + t10
        from1 = a + t01, b + t11
        back.append((int(from0[1] > from0[0]), int(from1[1] > from1[0])))
        a, b = max(from0), max(from1) + s
    label = int(b + end[1] > a + end[0])
    out = [label]
    for step in reversed(back):
        label = step[label]
        out.append(label)
    return out[::-1]


# ---- training ---------------------------------------------------------------


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _expected(scores: np.ndarray, trans: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Marginals of labels and of neighbouring labels of one chain, by forward-backward."""
    n = len(scores)
    emit = np.column_stack([np.zeros(n), scores])
    ahead, behind = np.zeros((n, 2)), np.zeros((n, 2))
    ahead[0] = start + emit[0]
    for i in range(1, n):
        ahead[i] = _lse(ahead[i - 1][:, None] + trans, 0) + emit[i]
    behind[-1] = end
    for i in range(n - 2, -1, -1):
        behind[i] = _lse(trans + (emit[i + 1] + behind[i + 1])[None, :], 1)
    whole = _lse(ahead[-1] + end, 0)
    single = np.exp(ahead + behind - whole)
    both = np.exp(ahead[:-1, :, None] + trans[None] + (emit[1:] + behind[1:])[:, None, :] - whole)
    return single, both


def train(pages: list[tuple[list[Block], list[int]]], epochs: int = EPOCHS, seed: int = 1) -> dict:
    """Weights of the field from labelled chains, by AdaGrad in a fixed order."""
    chains = []
    for blocks, labels in pages:
        rows = [
            np.array([crc32(f.encode()) % SIZE for f in path_features(b.path) + text_features(b)]) for b in blocks
        ]
        if rows:
            chains.append((np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.array(labels)))
    weights, seen = np.zeros(SIZE), np.full(SIZE, 1e-6)
    chain, chain_seen = [np.zeros((2, 2)), np.zeros(2), np.zeros(2)], [np.full((2, 2), 1e-6), np.full(2, 1e-6), np.full(2, 1e-6)]
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(chains)):
            at, row, y = chains[i]
            scores = np.bincount(row, weights[at], len(y))
            single, both = _expected(scores, *chain)
            grad = np.bincount(at, (y - single[:, 1])[row], SIZE)
            used = np.unique(at)
            g = grad[used] - DECAY * weights[used]
            seen[used] += g * g
            weights[used] += RATE * g / np.sqrt(seen[used])
            real = np.zeros((2, 2))
            np.add.at(real, (y[:-1], y[1:]), 1)
            ends = np.eye(2)[[y[0], y[-1]]]
            for value, total, g in zip(
                chain, chain_seen, (real - both.sum(axis=0), ends[0] - single[0], ends[1] - single[-1])
            ):
                total += g * g
                value += RATE * g / np.sqrt(total)
    return {"weights": weights.astype(np.float32), "trans": chain[0].tolist(),
            "start": chain[1].tolist(), "end": chain[2].tolist()}


# ---- labelled pages ---------------------------------------------------------

# Names that authors give to the parts of a page, and words that stand in them.
MAIN = "content main article post entry story body text page blog news maincontent".split()
PARTS = {
    "nav": ("nav navigation navbar menu menubar breadcrumb breadcrumbs toc pagination pager tabs topbar skip links",
            "Home|About|Contact|News|Products|Login|Sign in|Next|Previous|Start|Startseite|Accueil|Inicio|Menu"),
    "header": ("header masthead banner logo branding top site head hero title tagline",
               "Daily News|Welcome|The Blog|Search|Site title"),
    "footer": ("footer copyright legal bottom colophon credits imprint foot",
               "© 2024 All rights reserved|Privacy policy|Terms of use|Imprint|Impressum|Mentions légales|Aviso legal"),
    "aside": ("sidebar aside widget related recommended popular trending rail secondary more archive tags author share social "
              "follow",
              "Related articles|Most read|Popular posts|Follow us|Share|Tags|Read more|Trending now|You may also like"),
    "ad": ("ad ads advert adverts advertisement sponsor sponsored promo promotion adsense banner teaser commercial",
           "Advertisement|Sponsored|Buy now|Special offer|Anzeige|Publicité|Publicidad|50% off"),
    "notice": ("notice notices cookie cookies consent gdpr alert message popup modal overlay warning disclaimer newsletter "
               "subscribe signup paywall",
               "We use cookies|Accept all|Subscribe to our newsletter|This site uses cookies|Please enable JavaScript"),
    "form": ("form search login signup contact subscribe register",
             "Your name|Email address|Send|Search|Password|Submit|Remember me|Your message"),
    "comments": ("comments comment reply replies respond discussion disqus commentlist feedback responses reader reviews",
                 "Leave a reply|3 comments|Reply|Report|Posted by anna|says:|Kommentare|Commentaires|Comentarios"),
}
TAGS = {
    "nav": ("nav", "nav", "div", "ul", "section"), "header": ("header", "header", "div"),
    "footer": ("footer", "footer", "div", "section"), "aside": ("aside", "aside", "div", "section"),
    "ad": ("div", "div", "aside", "section", "ins"), "notice": ("div", "div", "section", "dialog", "aside"),
    "form": ("form",), "comments": ("div", "section", "ol", "aside"),
}
SYLLABLES = (
    "the er ing th an re on en ti es or st ha nd ou ea le ment tion que aux pa elle der sch ung keit lich ge che ción "
    "os as el la do rr ña is it at to be we so ma ni ko ra"
).split()


# What also stands in running text.
EXTRAS = (
    "2024", "+1 (555) 010-2030", "a.b@example.com", "10.0.0.1", "License, Version 2.0", "CC BY-NC 4.0", "©", "|",
    "Licensed under the license", "All rights reserved", "menu", "comments", "subscribe", "token = \"0f3a\"", "news",
)


class _Maker:
    """Makes pages of random layout; the main text carries a mark that is taken off again."""

    def __init__(self, seed: int) -> None:
        self.rng = random.Random(seed)

    def words(self, n: int) -> str:
        pick, style = self.rng.choice, self.style
        made = ["".join(pick(SYLLABLES) for _ in range(self.rng.choice((1, 1, 2, 2, 3, 4)))) for _ in range(n)]
        if style == 1:
            made = [w + pick(("###", "***", "%%%", "$$$", "&amp;&amp;")) for w in made]
        if style == 2:
            made = [w.upper() + "!!" for w in made]
        if style == 3:
            made = [w + (" |" if self.rng.random() < 0.5 else "") for w in made]
        if self.rng.random() < 0.06:
            made[self.rng.randrange(n)] = pick(EXTRAS)
        for i in range(5, n, 9):
            made[i] += pick((",", ".", ""))
        return (" ".join(made)).capitalize() if style != 2 else " ".join(made)

    def sentences(self, most: int) -> str:
        n = self.rng.randrange(1, most + 1)
        return " ".join(self.words(self.rng.choice((1, 4, 9, 14, 25))) + "." for _ in range(n))

    def inline(self, text: str) -> str:
        roll = self.rng.random()
        if roll < 0.15:
            at = text.find(" ", len(text) // 2)
            return text if at < 0 else f'{text[:at]} <a href="/x">{self.words(2)}</a> {text[at:]}'
        return f"<b>{text}<br>" if roll < 0.22 else f"<em>{text}</em>" if roll < 0.27 else text

    def name(self, words: str) -> str:
        pick = self.rng.choice
        word = pick(words.split())
        more = pick(("box", "wrap", "wrapper", "inner", "area", "list", "block", "section", "left", "right", "item", "js"))
        made = pick((word, word, f"{word}-{more}", f"{more}_{word}", f"{word}{more.capitalize()}", f"site-{word}", f"{word}1"))
        return f' {pick(("class", "class", "id"))}="{made}"'

    def main_block(self) -> str:
        pick, text = self.rng.choice, lambda n: MARK + self.inline(self.sentences(n))
        kind = pick(("p",) * 12 + ("h2", "h3", "ul", "ol", "blockquote", "pre", "table", "figure", "div", "dl", "open"))
        if kind in ("ul", "ol"):
            items = "".join(f"<li>{MARK}{self.words(pick((2, 5, 12)))}</li>" for _ in range(self.rng.randrange(2, 6)))
            return f"<{kind}>{items}</{kind}>"
        if kind in ("h2", "h3"):
            return f"<{kind}>{MARK}{self.words(pick((2, 4, 7)))}</{kind}>"
        if kind == "table":
            rows = "".join(f"<tr><td>{MARK}{self.words(2)}</td><td>{MARK}{self.words(3)}</td></tr>" for _ in range(3))
            return f"<table>{rows}</table>"
        if kind == "figure":
            return f"<figure><img src='x'><figcaption>{MARK}{self.words(6)}</figcaption></figure>"
        if kind == "blockquote":
            return f"<blockquote><p>{text(2)}</p></blockquote>"
        if kind == "dl":
            return f"<dl><dt>{MARK}{self.words(2)}<dd>{MARK}{self.words(9)}</dl>"
        if kind == "open":
            return f"<p>{text(3)}"
        return f"<{kind}>{text(6)}</{kind}>"

    def part(self, kind: str) -> str:
        """A part that is no main text."""
        rng, (names, phrases) = self.rng, PARTS[kind]
        tag = rng.choice(TAGS[kind])
        plain = tag in ("nav", "header", "footer", "aside", "form") and rng.random() < 0.45
        attrs = "" if plain else self.name(names)
        said = lambda: rng.choice(phrases.split("|")) if rng.random() < 0.4 else self.words(rng.choice((1, 2, 4)))
        link = lambda: f'<a href="/{rng.randrange(99)}">{said()}</a>'
        if kind == "nav" or (kind in ("aside", "footer", "header") and rng.random() < 0.4):
            inner = "".join(f"<li>{link()}</li>" for _ in range(rng.randrange(2, 8)))
            inner = inner if tag == "ul" else f"<ul>{inner}</ul>"
        elif kind == "form":
            inner = "".join(f"<label>{said()}</label><input name=x>" for _ in range(2)) + f"<p>{self.sentences(1)}</p>"
        elif kind == "comments":
            one = lambda: (f"<{rng.choice(('div', 'li', 'article'))}{self.name(names)}><p>{said()}</p>"  # noqa: E731
                           f"<p>{self.inline(self.sentences(4))}</p></div>")
            inner = f"<h3>{said()}</h3>" + "".join(one() for _ in range(rng.randrange(1, 4)))
        elif kind in ("footer", "header"):
            inner = rng.choice((f"&copy; {self.words(2)} &middot; {self.sentences(1)}", f"<p>{said()}</p><p>{self.sentences(2)}</p>",
                                f"<h1>{said()}</h1>", link() + " | " + link()))
        else:
            inner = rng.choice((self.sentences(2), f"<p>{self.sentences(3)}</p>", f"<h3>{said()}</h3><p>{self.sentences(2)}</p>",
                                f"{said()} {link()}"))
        return f"<{tag}{attrs}>{inner}</{tag}>"

    def page(self) -> str:
        rng = self.rng
        self.style = rng.choice((0, 0, 0, 0, 1, 2, 3))
        blocks = [self.main_block() for _ in range(rng.choice((1, 2, 4, 7, 12)))]
        heading = f"<h1>{MARK}{self.words(rng.choice((1, 4, 9)))}</h1>"
        heading = rng.choice((heading, heading, f"<header>{heading}</header>", ""))
        for _ in range(rng.choice((0, 0, 0, 1, 2))):
            kind = rng.choice(("ad", "aside", "notice", "form", "nav"))
            blocks.insert(rng.randrange(len(blocks) + 1), self.part(kind))
        inner = heading + "".join(blocks)
        if rng.random() < 0.12:
            inner += self.part("comments")
        name = self.name(" ".join(MAIN))
        wrap = rng.choice((
            f"<article>{inner}</article>", f"<article>{inner}</article>", f"<article{name}>{inner}</article>",
            f"<main>{inner}</main>", f"<main><article>{inner}</article></main>", f"<div{name}>{inner}</div>",
            f"<div{name}><div>{inner}</div></div>", f"<section{name}>{inner}</section>", f'<div role="main">{inner}</div>',
            f"<table><tr><td>{inner}</td></tr></table>", f"<div>{inner}</div>",
        ))
        before = [self.part(k) for k in ("header", "nav", "notice", "ad", "aside") if rng.random() < 0.45]
        after = [self.part(k) for k in ("comments", "aside", "ad", "form", "notice", "nav") if rng.random() < 0.35]
        rng.shuffle(before), rng.shuffle(after)
        after += [self.part("footer")] if rng.random() < 0.8 else []
        shell = "<div{}>{}</div>".format(rng.choice(("", ' class="wrapper"', ' id="page"')), "{}") if rng.random() < 0.3 else "{}"
        return f"<html><head><title>{self.words(4)}</title></head><body>" + shell.format(
            "".join(before) + wrap + "".join(after)
        ) + "</body></html>"


def labelled_pages(n: int = PAGES, seed: int = 11) -> list[tuple[list[Block], list[int]]]:
    """Chains of blocks with their labels, from ``n`` made pages."""
    maker, out = _Maker(seed), []
    for _ in range(n):
        found = blocks_of(maker.page())
        labels = [int(MARK in b.text) for b in found]
        clean = [b._replace(text=" ".join(b.text.replace(MARK, "").split())) for b in found]
        kept = [(b, y) for b, y in zip(clean, labels) if b.text]
        out.append(([b for b, _ in kept], [y for _, y in kept]))
    return out


# ---- operator ---------------------------------------------------------------


def main_text(html: str | None, scorer: Scorer, model: dict) -> str:
    blocks = blocks_of(html)
    labels = viterbi([scorer.score(b) for b in blocks], model["trans"], model["start"], model["end"])
    return "\n".join(b.text for b, y in zip(blocks, labels) if y)


def extract(pages: DataFrame, model: dict | None = None, html: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the main text of the whole page; an input column of that name is replaced."""
    sent = pages.sparkSession.sparkContext.broadcast(model or train(labelled_pages()))
    kept = [f for f in pages.schema.fields if f.name != out]
    schema = T.StructType([*kept, T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value["weights"])
        for batch in batches:
            names = batch.schema.names
            texts = [main_text(h.as_py(), scorer, sent.value) for h in batch.column(names.index(html))]
            columns = [batch.column(names.index(f.name)) for f in kept]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(texts, pa.string())], [*(f.name for f in kept), out]
            )

    return pages.mapInArrow(run, schema)

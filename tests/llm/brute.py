"""Plain Python forms of the operators, for the tests."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def windows(words, size=10):
    return [words[i : i + size] for i in range(max(1, len(words) - size + 1))] if words else []


def leaks(docs, items, size=10):
    """(id, n_words, n_hit, n_items, digest, contaminated) per document."""
    wins = defaultdict(set)
    for item, text in items:
        for w in windows(WORD.findall((text or "").translate(LOWER)), size):
            wins[tuple(w)].add("" if item is None else str(item))
    lengths = {len(w) for w in wins}
    out = []
    for i, text in docs:
        words = WORD.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in lengths:
            for at in range(len(words) - n + 1):
                some = wins.get(tuple(words[at : at + n]))
                if some:
                    hit.update(range(at, at + n))
                    found |= some
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(words), len(hit), len(found), digest, bool(hit)))
    return out


def number(*parts):
    return int(hashlib.md5("|".join(parts).encode()).hexdigest()[:13], 16) / (1 << 52)


def poisson(u, mean):
    k, p = 0, math.exp(-mean)
    c = p
    while c <= u and k < 1000:
        k += 1
        p *= mean / k
        c += p
    return k


def mixed(docs, alpha=0.5, total=1.0, weights=None):
    """Number of copies of each (id, text, source)."""
    size = defaultdict(int)
    for _, text, source in docs:
        size[source] += len(text or "") + 1
    w = {s: (n**alpha if weights is None else weights.get(s, 0.0)) for s, n in size.items()}
    all_w = sum(w.values())
    out = []
    for i, text, source in docs:
        rate = (w[source] / all_w if all_w else 0) * sum(size.values()) * total / size[source]
        m = math.ceil(rate / 32)
        name = "" if i is None else str(i)
        out.append(sum(poisson(number("poisson|42", name, str(j)), rate / m) for j in range(1, m + 1)))
    return out


def trie(turns, rebuild=True):
    """A row for each node of the trie of conversations, by sets of members."""
    conv = defaultdict(list)
    for c, t, role, text in turns:
        if c is not None:
            conv[c].append((t, role or "", text or ""))

    def place(turn):
        t, role, text = turn
        body = str(len(role.encode())).encode() + b":" + role.encode() + text.encode()
        return (t is not None, t or 0, hashlib.md5(body).digest())

    own = {c: [(role, text) for _, role, text in sorted(v, key=place)] for c, v in conv.items()}
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9 if rebuild else 0
        made[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, m in members.items():
        weight = (len(m) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += weight
            leaves[node[:d]] += not children[node]
    out = []
    for node, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(made[c]) == len(node))
        out.append(
            (min(m), len(node), min(members[node[:-1]]) if node else None, len(m), children[node], leaves[node],
             saved[node], hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(out, key=repr)


def plain_blocks(html):
    """Texts of the blocks of a well-formed page, by the parser of the standard library."""
    from html.parser import HTMLParser

    blocks = set(
        "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer "
        "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody "
        "td tfoot th thead tr ul".split()
    )
    silent = set("script style noscript template svg iframe object textarea select title button audio video canvas".split())

    class Reader(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.out, self.run, self.hidden = [], [], 0

        def cut(self):
            text = " ".join("".join(self.run).split())
            if text:
                self.out.append(text)
            self.run = []

        def handle_starttag(self, tag, attrs):
            self.hidden += tag in silent
            if tag == "br":
                self.run.append(" ")
            elif tag in blocks and not self.hidden:
                self.cut()

        def handle_endtag(self, tag):
            self.hidden -= tag in silent
            if tag in blocks and not self.hidden:
                self.cut()

        def handle_data(self, data):
            if not self.hidden:
                self.run.append(data)

    reader = Reader()
    reader.feed(html or "")
    reader.close()
    reader.cut()
    return reader.out

"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import html
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lower(text):
    return (text or "").translate(LOWER)


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def contamination(docs, items, size=10):
    windows = defaultdict(set)
    for item, text in items:
        words = ITEM_WORD.findall(lower(text))
        n = min(size, len(words))
        for k in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[k : k + n])].add("" if item is None else str(item))
    lengths = {len(w) for w in windows}
    found = []
    for doc, text in docs:
        words = ITEM_WORD.findall(lower(text))
        hit, names = [False] * len(words), set()
        for n in lengths:
            for k in range(len(words) - n + 1):
                own = windows.get(tuple(words[k : k + n]))
                if own:
                    names |= own
                    hit[k : k + n] = [True] * n
        found.append((doc, len(words), sum(hit), len(names), sha(",".join(sorted(names))), any(hit)))
    return found


def base_scores(docs):
    counts, texts = Counter(), []
    for doc, text in docs:
        words = [*WORD.findall(lower(text)), None]
        held = zlib.crc32(("" if doc is None else str(doc)).encode()) % 10 == 0
        texts.append((doc, held, words))
        if not held:
            counts.update(words)
    total, distinct = sum(counts.values()), len(counts)
    return [
        (
            doc,
            held,
            len(words),
            sum(counts[w] > 0 for w in words),
            total,
            sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in words),
        )
        for doc, held, words in texts
    ]


def removed(docs, length):
    raws = [(doc, (text or "").encode()) for doc, text in docs]
    counts = Counter(raw[i : i + length] for _, raw in raws for i in range(len(raw) - length + 1))
    found = []
    for doc, raw in raws:
        gone = [False] * len(raw)
        for i in range(len(raw) - length + 1):
            if counts[raw[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        found.append((doc, len(raw), sum(gone), runs, sha(bytes(b for b, g in zip(raw, gone, strict=True) if not g))))
    return found


def quality_counts(text):
    text = text or ""
    words = WORD.findall(text)
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    covered = [False] * len(words)
    for k in range(len(words) - 2):
        if windows[tuple(words[k : k + 3])] > 1:
            covered[k : k + 3] = [True] * 3
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, sum(covered))


def shingles(text):
    words = WORD.findall(lower(text))
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def near_components(docs):
    """(doc, n_shingles, component, kept), ids unique."""
    sets = {doc: shingles(text) for doc, text in docs}
    parent = {doc: doc for doc in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return [(doc, len(sets[doc]), find(doc), find(doc) == doc) for doc in ids]


def article_text(page):
    """The blocks of pages built like those of the test tables: paragraphs and headings in one article."""
    inside = re.search(r"<article>(.*?)(</article>|\Z)", page, re.DOTALL)
    source = re.sub(r"<[^>]*\Z", "", inside[1])
    blocks = [
        " ".join(html.unescape(re.sub(r"<[^>]*>", " ", part)).split()) for part in re.split(r"</?(?:p|h1)>", source)
    ]
    return "\n".join(block for block in blocks if block)


def chat_digest(rows):
    """(n_turns, turns_sha256, loss_chars, loss_sha256) of one conversation's (role, text) turns."""
    learned = "".join(text or "" for role, text in rows if role == "assistant")
    turns = "".join(f"{role or ''}\n{text or ''}\n" for role, text in rows)
    return (len(rows), sha(turns), len(learned), sha(learned))


def greedy_capacity(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        middle, used, fill = (low + high) // 2, 1, 0
        for size in sizes:
            if fill + size > middle:
                used, fill = used + 1, 0
            fill += size
        low, high = (low, middle) if used <= shards else (middle + 1, high)
    return low

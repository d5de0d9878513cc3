"""Plain-Python versions of the operators, for small inputs."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

SPACE_WORD = re.compile("[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str | None, pattern: re.Pattern = SPACE_WORD) -> list[str]:
    return pattern.findall((text or "").translate(LOWER))


def base_stats(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    w = SPACE_WORD.findall(text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if SPACE_WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i: i + 3])] > 1 for k in range(3)}
    n = len(w)
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered), n < 50 or 100 * len(covered) > 50 * n


def one_edit(a: list[str], b: list[str]) -> bool:
    """Whether the word sequences differ by at most one insertion, deletion or replacement."""
    if abs(len(a) - len(b)) > 1:
        return False
    p = 0
    while p < min(len(a), len(b)) and a[p] == b[p]:
        p += 1
    s = 0
    while s < min(len(a), len(b)) - p and a[-1 - s] == b[-1 - s]:
        s += 1
    return max(len(a), len(b)) - p - s <= 1


def dedup_lines(docs: list[tuple], min_words: int = 8) -> dict:
    """{doc_id: (n_lines, n_exact, n_near, text)} for documents of different ids."""
    earlier: list[list[str]] = []
    out = {}
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is None, d[0])):
        kept, n, exact, near = [], 0, 0, 0
        for line in text.split("\n") if text is not None else ():
            w = SPACE_WORD.findall(line.lower())
            if not w:
                kept.append(line)
                continue
            n += 1
            if w in earlier:
                exact += 1
                earlier.append(w)
                continue
            if len(w) >= min_words and any(len(x) >= min_words and one_edit(w, x) for x in earlier):
                near += 1
            else:
                kept.append(line)
            earlier.append(w)
        out[doc_id] = (n, exact, near, None if text is None else "\n".join(kept))
    return out


def near_components(docs: list[tuple], width: int, percent: int) -> list[tuple]:
    """(doc_id, size of the set, component id) of each row."""
    sets = []
    for _, text in docs:
        w = words(text)
        sets.append({tuple(w[i: i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    parent = list(range(len(docs)))

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        shared = Counter(j for g in s for j in holders[g])
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                parent[find(i)] = find(j)
        for g in s:
            holders[g].append(i)
    ids = defaultdict(list)
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            ids[find(i)].append(doc_id)
    return [(doc_id, len(sets[i]), min(ids[find(i)], default=None)) for i, (doc_id, _) in enumerate(docs)]


def passages(docs: list[tuple], items: list[tuple], window: int = 10) -> dict:
    """{doc_id: (n_words, n_hit, items, text without the hit runs)}."""
    patterns = defaultdict(set)
    for item_id, text in items:
        w = words(text, ALNUM_WORD)
        n = min(window, len(w))
        for i in range(len(w) - n + 1) if n else ():
            patterns[tuple(w[i: i + n])].add(str(item_id))
    out = {}
    for doc_id, text in docs:
        at = [m.span() for m in ALNUM_WORD.finditer((text or "").translate(LOWER))]
        w = words(text, ALNUM_WORD)
        hit, found = [False] * len(w), set()
        for n in {len(p) for p in patterns}:
            for i in range(len(w) - n + 1):
                if tuple(w[i: i + n]) in patterns:
                    found |= patterns[tuple(w[i: i + n])]
                    hit[i: i + n] = [True] * n
        rest, last, i = [], 0, 0
        while i < len(w):
            if hit[i]:
                j = i
                while j + 1 < len(w) and hit[j + 1]:
                    j += 1
                rest.append(text[last: at[i][0]])
                last, i = at[j][1], j
            i += 1
        out[doc_id] = (len(w), sum(hit), sorted(found), None if text is None else "".join(rest) + text[last:])
    return out


def backoff(docs: list[tuple], order: int) -> dict:
    """{doc_id: (n_words, n_backoff, log score)}, each document by the counts of the others."""
    every, total, own = Counter(), 0, []
    for _, text in docs:
        w = words(text)
        c = Counter(tuple(w[i: i + o]) for o in range(1, order + 1) for i in range(len(w) - o + 1))
        own.append((w, c))
        every.update(c)
        total += len(w)
    out = {}
    for (doc_id, _), (w, c) in zip(docs, own):
        n, score, lower = total - len(w), 0.0, 0
        for i in range(len(w)):
            top = min(order, i + 1)
            for o in range(top, 0, -1):
                g = tuple(w[i - o + 1: i + 1])
                seen = every[g] - c[g]
                if seen:
                    score += math.log(seen / ((every[g[:-1]] - c[g[:-1]]) if o > 1 else n) * 0.4 ** (top - o))
                    break
            else:
                score += math.log(0.4 ** (top - 1) / (n + 1))
            lower += o < top
        out[doc_id] = (len(w), lower, score)
    return out

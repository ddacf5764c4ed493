"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
MARK = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def shingle_set(text: str | None) -> frozenset:
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    if len(words) < 5:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def jaccard_components(rows: list[tuple]) -> list[tuple]:
    """(doc_id, n_shingles, component_id) per (doc_id, text)."""
    sets = [shingle_set(t) for _, t in rows]
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                group[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        r = find(i)
        if doc is not None:
            least[r] = min(least.get(r, doc), doc)
    return [(doc, len(sets[i]), least.get(find(i))) for i, (doc, _) in enumerate(rows)]


def line_dedup(rows: list[tuple]) -> list[tuple]:
    """(doc_id, n_lines, n_dropped, kept_sha256) per (doc_id, text)."""

    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)

    docs = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                docs[key(line)].add(-(1 << 63) if doc is None else doc)
    out = []
    for doc, text in rows:
        own = -(1 << 63) if doc is None else doc
        lines = (text or "").split("\n")
        stay = [x for x in lines if not (len(key(x)) >= 20 and len(docs[key(x)]) >= 3 and own != max(docs[key(x)]))]
        out.append((doc, len(lines), len(lines) - len(stay), sha("\n".join(stay))))
    return out


def contamination(rows: list[tuple], items: list[tuple]) -> list[tuple]:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) per (doc_id, text)."""
    windows = defaultdict(set)
    for item, text in items:
        words = MARK.findall((text or "").translate(LOWER))
        k = min(10, len(words))
        for i in range(len(words) - k + 1 if words else 0):
            windows[tuple(words[i : i + k])].add(item)
    out = []
    for doc, text in rows:
        words = MARK.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for k in range(1, 11):
            for i in range(len(words) - k + 1):
                gram = tuple(words[i : i + k])
                if gram in windows:
                    hit.update(range(i, i + k))
                    found |= windows[gram]
        ids = ",".join(sorted(str(x) for x in found if x is not None))
        out.append((doc, len(words), len(hit), len([x for x in found if x is not None]), sha(ids), bool(hit)))
    return out


def targets(sizes: dict, weights=(5, 2, 1), cap: int = 3) -> dict:
    """Target per source, by resharing until none is above its cap."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    done: dict = {}
    while True:
        left = sum(sizes.values()) - sum(done.values())
        free = [s for s in order if s not in done]
        total = sum(weight[s] for s in free)
        share = {s: left * weight[s] / total for s in free} if free else {}
        over = [s for s in free if share[s] > cap * sizes[s] + 1e-9]
        if not over:
            return done | share
        done |= {s: float(cap * sizes[s]) for s in over}


SECRETS = {
    "assign": (re.compile(r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 24),
}


def base_secrets(text: str | None) -> str:
    found = []
    for place, (kind, (regex, group, least)) in enumerate(SECRETS.items()):
        for m in regex.finditer(text or ""):
            if len(m[group]) >= least:
                found.append((m.start(), place, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x[2] for x in sorted(found))


def quality(text: str | None) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = defaultdict(list)
    for i in range(len(words) - 2):
        windows[tuple(words[i : i + 3])].append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)

"""Plain versions of what the corpus operators compute, for small inputs."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = str.maketrans(CAPITALS, CAPITALS.lower())
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(LOWER))


def shingles(text: str | None) -> frozenset:
    w = words(text)
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def jaccard(a: frozenset, b: frozenset) -> float:
    return len(a & b) / len(a | b) if a | b else 1.0


def contamination(docs, items) -> list[tuple]:
    """(key, n_words, n_hit, items, contaminated) of each (key, text)."""
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        k = min(13, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            windows[tuple(w[i:i + k])].add("" if item is None else str(item))
    out = []
    for key, text in docs:
        w, hit, found = words(text), set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if tuple(w[i:i + k]) in windows:
                    hit.update(range(i, i + k))
                    found |= windows[tuple(w[i:i + k])]
        out.append((key, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def records(pages) -> list[tuple]:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of each page."""
    first = {}
    for page, _, payload in pages:
        if page is not None:
            first[payload or ""] = min(first.get(payload or "", page), page)
    out = []
    for page, _, payload in pages:
        data, origin = (payload or "").encode(), first.get(payload or "")
        revisit = origin is not None and page != origin
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page, len(data), digest, "revisit" if revisit else "response", origin if revisit else None))
    return out


def edits(docs) -> list[tuple]:
    """(key, n_chars, edited_sha256, near_edited, near_next) with exact similarities."""
    rows = sorted(((k, t or "") for k, t in docs), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for i, (key, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        out.append((
            key, len(text), hashlib.sha256(edited.encode()).hexdigest(),
            jaccard(shingles(text), shingles(edited)), jaccard(shingles(text), shingles(after)),
        ))
    return out


def near_classes(docs, similar: float = 0.8) -> list[tuple]:
    """(key, class_id) of each (key, text), by comparing all pairs."""
    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(docs)):
        for b in range(a):
            if jaccard(sets[a], sets[b]) >= similar:
                parent[find(a)] = find(b)
    smallest = {}
    for i, (key, _) in enumerate(docs):
        if key is not None:
            smallest[find(i)] = min(smallest.get(find(i), key), key)
    return [(key, smallest.get(find(i))) for i, (key, _) in enumerate(docs)]


BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def base_licenses(text: str | None) -> tuple:
    """(n_words, n_base, first_word, last_word, base_labels)"""
    w, places = words(text), []
    for phrase, label in BASE_PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
    return (len(w), len(places), min(places)[0] if places else None, max(places)[0] if places else None,
            ",".join(sorted({label for _, label in places})))


def luhn(digits: str) -> bool:
    doubled = [int(d) * (2 if k % 2 else 1) for k, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def base_personal_data(text: str | None) -> list[tuple]:
    """(start, rank of kind, end, kind)"""
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end(), "email"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end(), "phone"))
    return sorted(out)


def ngrams(text: str | None) -> list[str]:
    w = words(text)
    return [" ".join(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def resampled(docs, items, percent: int = 5, least: int = 20) -> list[tuple]:
    """(key, n_features, weight, score, rank) of each (key, text)."""
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    s = Counter(bucket(f) for _, t in docs for f in ngrams(t))
    t = Counter(bucket(f) for x in items for f in ngrams(x))
    total = {id(c): sum(c.values()) + 10000 for c in (s, t)}
    out = []
    for key, text in docs:
        f = ngrams(text)
        weight = sum(
            math.floor(1000 * math.log((t[b] + 1.0) * total[id(s)] / ((s[b] + 1.0) * total[id(t)])))
            for b in map(bucket, f)
        )
        h = int(hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((key, len(f), weight, weight + noise, len(words(text)) >= least))
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = able[:percent * len(able) // 100]
    ranks = {}
    for place, r in enumerate(drawn, 1):
        ranks.setdefault(r, []).append(place)
    return [(*r[:4], ranks[r].pop(0) if ranks.get(r) else None) for r in out]


def infilled(key, text: str | None) -> tuple:
    """(key, n, form, prefix_chars, middle_chars, output)"""
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n, digest = len(units), hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k:k + 8], 16) for k in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return key, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < 20:
        return key, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return key, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def without_templates(pages: list[list[str]], many: int, least: float) -> list[list[str]]:
    """The blocks of each page of a host without its templates; a page is a list of blocks."""
    different = {tuple(p) for p in pages}
    recurring = {b for p in different for b in p if sum(b in q for q in different) >= many}
    votes = defaultdict(set)
    for p in different:
        own = [b for b in p if b not in recurring]
        if own and sum(map(len, own)) >= least * sum(map(len, p)):
            for b in recurring.intersection(p):
                votes[b].add(tuple(own))
    return [[b for b in p if len(votes[b]) < many] for p in pages]

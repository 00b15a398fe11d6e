"""Slow, plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

from xxhash import xxh64_intdigest

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def contamination(docs, items, length=10):
    windows = defaultdict(set)
    for item, text in items:
        words = ALNUM.findall((text or "").translate(LOWER))
        size = min(length, len(words))
        for k in range(len(words) - size + 1 if words else 0):
            windows[tuple(words[k : k + size])].add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        words = ALNUM.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for size in sizes:
            for k in range(len(words) - size + 1):
                if own := windows.get(tuple(words[k : k + size])):
                    found |= own
                    hit.update(range(k, k + size))
        out.append((doc_id, len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def substring_digest(docs, window):
    words = [WORD.findall(text or "") for _, text in docs]
    count = Counter(tuple(w[k : k + window]) for w in words for k in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(docs, words, strict=True):
        gone = set()
        for k in range(len(w) - window + 1):
            if count[tuple(w[k : k + window])] > 1:
                gone.update(range(k, k + window))
        out.append((doc_id, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return out


def simhash(text, shingle=3):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    hashes = [xxh64_intdigest(" ".join(words[k : k + shingle]).encode("utf-8"), 42) for k in range(max(len(words) - shingle + 1, 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(ids, links):
    """Smallest id reachable from each position; ids may repeat or be None."""
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        root[find(a)] = find(b)
    least = {}
    for k, i in enumerate(ids):
        r = find(k)
        if i is not None and (least.get(r) is None or i < least[r]):
            least[r] = i
    return [least.get(find(k)) for k in range(len(ids))]


def simhash_groups(docs, shingle=3, radius=2):
    prints = [simhash(text, shingle) for _, text in docs]
    places = defaultdict(list)
    for k, p in enumerate(prints):
        places[p].append(k)
    links = [(own[0], k) for own in places.values() for k in own[1:]]
    distinct = list(places)
    links += [(places[a][0], places[b][0]) for n, a in enumerate(distinct) for b in distinct[n + 1 :] if (a ^ b).bit_count() <= radius]
    return [(i, p, c) for (i, _), p, c in zip(docs, prints, groups([i for i, _ in docs], links), strict=True)]


PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 else 1)
        total += d // 10 + d % 10
    return total % 10 == 0


def base_spans(text):
    out = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda: True,
                "ip": lambda m=m: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda d=digits: 14 <= len(d) <= 19 and luhn(d),
                "phone": lambda d=digits: 10 <= len(d) <= 15,
            }[kind]()
            if good:
                out.append((m.start(), order, m.end(), kind))
    return [(a, b, kind) for a, _, b, kind in sorted(out)]


def edited(docs):
    """doc_id, length, edited text, next text; ascending ids, nulls last, ties by text."""
    order = sorted(docs, key=lambda x: (x[0] is None, x[0] or 0, x[1] is not None, x[1] or ""))
    out = []
    for k, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        out.append((doc_id, len(text), text[: len(text) - half] + after[:half], text, after))
    return out


def lpt_loads(groups, shards):
    """Largest group first, always to the least-loaded shard."""
    loads = [0] * shards
    for size in sorted(groups, reverse=True):
        loads[loads.index(min(loads))] += size
    return sorted(loads)


def language(model, text):
    """Label, cosine to the nearest centroid and the best cosine of another language, n-gram by n-gram."""
    letters, last = [], None
    for b in text.lower().encode("utf-8", "surrogatepass"):
        b = b if b >= 128 or chr(b).isalpha() else 0x20
        if b != 0x20 or last != 0x20:
            letters.append(b)
        last = b
    counts = Counter()
    for n, width, base in ((1, 256, 0), (2, 2048, 256), (3, 4096, 2304)):
        for k in range(len(letters) - n + 1):
            code = int.from_bytes(bytes(letters[k : k + n]), "big")
            counts[base + (code if n == 1 else (code * 0x9E3779B1 >> 13) % width)] += 1
    vector = {f: math.sqrt(c) * float(model.idf[f]) for f, c in counts.items()}
    size = math.sqrt(sum(v * v for v in vector.values()))
    cosines = [(sum(v * float(c[f]) for f, v in vector.items()) / size, -k) for k, c in enumerate(model.centroids)]
    best, k = max(cosines)
    label = model.labels[-k]
    return label, best, max([x for x, n in cosines if model.labels[-n] != label], default=0.0), sum(counts.values())

"""Plain versions of what the operators compute, for small inputs."""

import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingle_set(text, width=2):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def near_components(texts, width=2):
    """Smallest id of the component of each document of {id: text}."""
    sets = {d: shingle_set(t, width) for d, t in texts.items()}
    holders = collections.defaultdict(list)
    parent = {d: d for d in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for d in sorted(sets):
        shared = collections.Counter(e for g in sets[d] for e in holders[g])
        for e, n in shared.items():
            if 100 * n >= 80 * (len(sets[d]) + len(sets[e]) - n):
                a, b = sorted((root(d), root(e)))
                parent[b] = a
        for g in sets[d]:
            holders[g].append(d)
    return {d: (len(sets[d]), root(d)) for d in texts}


def without_repeats(texts, length):
    """(bytes, removed, runs, sha256 of the rest) of each text."""
    places = collections.defaultdict(list)
    for k, t in enumerate(texts):
        for i in range(len(t) - length + 1):
            places[hashlib.md5(t[i : i + length]).digest()].append((k, i))
    covered = [bytearray(len(t)) for t in texts]
    for found in places.values():
        if len(found) > 1:
            for k, i in found:
                covered[k][i : i + length] = b"\1" * length
    out = []
    for t, marks in zip(texts, covered, strict=True):
        runs = sum(1 for i, m in enumerate(marks) if m and (i == 0 or not marks[i - 1]))
        rest = bytes(b for b, m in zip(t, marks, strict=True) if not m)
        out.append((len(t), sum(marks), runs, hashlib.sha256(rest).hexdigest()))
    return out


def base_rules(text):
    words = WORD.findall(text or "")
    windows = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), again, len(covered), failed

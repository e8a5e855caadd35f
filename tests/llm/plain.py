"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


# personal data ------------------------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def personal(text: str | None) -> tuple[list[int], str]:
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    found = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 12 <= len(digits(m)) <= 19 and luhn(digits(m))]
    found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    names = ("email", "ip", "card", "phone")
    spans = ",".join(f"{names[k]}:{s}:{e}" for s, k, e in sorted(found))
    return [sum(k == i for _, k, _ in found) for i in range(4)], spans


# secrets ------------------------------------------------------------------------------

ASSIGN = re.compile(
    r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"""
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def secret(text: str | None) -> tuple[list[int], str]:
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    names = ("assign", "access", "hex")
    return [sum(k == i for _, k, _ in found) for i in range(3)], ",".join(f"{names[k]}:{s}:{e}" for s, k, e in sorted(found))


# licenses -----------------------------------------------------------------------------

PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def license_base(text: str | None) -> tuple:
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        at = [i for i in range(len(words)) if words[i:i + len(p)] == p]
        places += at
        if at:
            labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


# near-duplicates ----------------------------------------------------------------------

def shingle_set(text: str | None, k: int) -> set:
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} or ({tuple(words)} if words else set())


def components(docs: list[tuple[int, str | None]], k: int, percent: int) -> dict[int, tuple[int, int]]:
    """id -> (set size, least id of its group), over all pairs."""
    sets = {i: shingle_set(t, k) for i, t in docs}
    holders, shared, parent = defaultdict(list), Counter(), {i: i for i in sets}
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    for ids in holders.values():
        for n, b in enumerate(ids):
            for a in ids[:n]:
                shared[a, b] += 1

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {i: (len(sets[i]), root(i)) for i in sets}


# repeated passages --------------------------------------------------------------------

def removed(docs: list[tuple[int, str | None]], width: int = 400) -> list[tuple]:
    """(id, bytes, removed, runs, digest of the rest) by marking every byte of every repeated window."""
    data = [(i, (t or "").encode()) for i, t in docs]
    count = Counter(d[s:s + width] for _, d in data for s in range(len(d) - width + 1))
    out = []
    for i, d in data:
        marks = bytearray(len(d))
        for s in range(len(d) - width + 1):
            if count[d[s:s + width]] > 1:
                marks[s:s + width] = b"\1" * width
        runs = len(re.findall(b"\1+", bytes(marks)))
        out.append((i, len(d), sum(marks), runs, sha(bytes(b for b, m in zip(d, marks) if not m))))
    return out

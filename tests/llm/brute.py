"""Plain versions of the corpus operators, written from their definitions."""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

WS = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def shingles(text: str | None, k: int) -> frozenset:
    w = WS.findall(lower(text or ""))
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def components(keys: list, links: list[tuple[int, int]]) -> list:
    """Smallest key of every row's component; links between row numbers."""
    root = list(range(len(keys)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    low: dict[int, int] = {}
    for i, k in enumerate(keys):
        if k is not None:
            low[find(i)] = min(k, low.get(find(i), k))
    return [low.get(find(i)) for i in range(len(keys))]


def jaccard_links(sets: list[frozenset], num: int, den: int) -> list[tuple[int, int]]:
    holders, out = defaultdict(list), []
    for i, s in enumerate(sets):
        near = Counter(j for x in s for j in holders[x])
        out += [(j, i) for j, n in near.items() if den * n >= num * (len(s) + len(sets[j]) - n)]
        for x in s:
            holders[x].append(i)
    return out


def quality_counts(text: str | None) -> tuple:
    t = text or ""
    w = WS.findall(t)
    at = defaultdict(list)
    for i in range(len(w) - 7):
        at[tuple(w[i:i + 8])].append(i)
    inside = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(8)}
    lines = [x for x in t.split("\n") if WS.search(x)]
    failed = len(w) < 20 or 100 * len(inside) > 30 * len(w)
    chars, symbols, dup = sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines))
    bad = (100 * symbols > 20 * len(w) or 100 * dup > 30 * len(lines) or 100 * sum("A" <= c <= "Z" for c in t) > 50 * chars
           or 100 * sum("0" <= c <= "9" for c in t) > 50 * chars)
    return len(w), chars, symbols, dup, len(inside), failed, not (failed or bad)


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    t = text or ""
    letters = lambda w: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
    words = "|".join(map(letters, ("password", "passwd", "secret", "token"))) + f"|{letters('api')}_?{letters('key')}"
    out = [("assign", m.start(), m.end()) for m in re.finditer(rf"""({words})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m[2]) >= 6]
    out += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(out, key=lambda x: (x[1], ["assign", "access", "hex"].index(x[0])))


def added_spans(text: str | None) -> list[tuple[str, int, int]]:
    t, out = text or "", []
    digits = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    for kind, p in (("github", r"gh[pousr]_(\w{30})(\w{6})(?!\w)"), ("npm", r"npm_(\w{30})(\w{6})(?!\w)")):
        for m in re.finditer(p, t, re.ASCII):
            n = 0
            for c in m[2]:
                n = n * 62 + digits.find(c)
            if "_" not in m[1] + m[2] and n == zlib.crc32(m[1].encode()):
                out.append((kind, m.start(), m.end()))
    for m in re.finditer(r"glsa_([A-Za-z0-9]{32})_([0-9a-f]{8})(?![A-Za-z0-9])", t):
        if int(m[2], 16) == zlib.crc32(m[1].encode()):
            out.append(("grafana", m.start(), m.end()))
    for m in re.finditer(r"(eyJ[\w-]{8,})\.(eyJ[\w-]{2,})\.[\w-]{16,}", t, re.ASCII):
        try:
            head, body = (json.loads(base64.urlsafe_b64decode(x + "==")) for x in (m[1], m[2]))
        except (ValueError, binascii.Error):
            continue
        if isinstance(head, dict) and isinstance(body, dict) and isinstance(head.get("alg"), str):
            out.append(("jwt", m.start(), m.end()))
    return out


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def listed(spans: list) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def licence_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def cosine_links(vectors: list, labels: list, threshold: float) -> list[tuple[int, int]]:
    def usable(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    ok = [i for i, (v, y) in enumerate(zip(vectors, labels, strict=True)) if usable(v) and y is not None and y == y]
    out = []
    for n, i in enumerate(ok):
        a = np.array(vectors[i], float)
        for j in ok[:n]:
            b = np.array(vectors[j], float)
            if labels[i] == labels[j] and len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold:
                out.append((j, i))
    return out


def bins_needed(lengths: list[int], capacity: int) -> int:
    """Lower bound of Martello and Toth, cut by cut."""
    best = -(-sum(lengths) // capacity)
    for a in {x for x in lengths if 2 * x <= capacity}:
        big = [x for x in lengths if x > capacity - a]
        mid = [x for x in lengths if capacity - a >= x and 2 * x > capacity]
        small = [x for x in lengths if capacity >= 2 * x and x >= a]
        best = max(best, len(big) + len(mid) + max(0, -(-(sum(small) - (len(mid) * capacity - sum(mid))) // capacity)))
    return best

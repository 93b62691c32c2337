"""Plain Python versions of the corpus operators' results, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict


def _sha(parts) -> str:
    return hashlib.sha256(",".join(parts).encode()).hexdigest()


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def pii(text: str | None) -> dict:
    text = text or ""
    spans = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        spans.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            spans.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 13 <= len(d) <= 19 and luhn(d):
            spans.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            spans.append(("phone", *m.span()))
    n = Counter(s[0] for s in spans)
    kinds = ("email", "ip", "card", "phone")
    return {f"n_{k}": n[k] for k in kinds} | {"base_sha256": _sha(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (kinds.index(s[0]), s[1])))}


def secrets(text: str | None) -> dict:
    text = text or ""
    kinds = ("assign", "access", "hex")
    spans = []
    for m in re.finditer(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m[2]) >= 6:
            spans.append(("assign", *m.span()))
    for kind, pattern, least in (("access", r"AKIA[A-Z0-9]+", 20), ("hex", r"[0-9a-f]+", 24)):
        spans += [(kind, *m.span()) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    n = Counter(s[0] for s in spans)
    return {f"n_{k}": n[k] for k in kinds} | {"base_sha256": _sha(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], kinds.index(s[0]))))}


def quality(text: str | None) -> dict:
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    n = len(words)
    return {
        "n_words": n, "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
        "base_failed": n < 50 or 100 * len(covered) > 50 * n,
    }


def lower(text: str) -> str:
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def decontaminate(docs: dict, items: dict) -> dict:
    """doc -> the digest columns; docs and items map ids to texts."""
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    windows = defaultdict(set)
    for item, text in items.items():
        w = re.findall(pattern, lower(text or ""))
        for i in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[i : i + 13])].add(item)
    out = {}
    sizes = {len(w) for w in windows}
    for doc, text in docs.items():
        w = re.findall(pattern, lower(text or ""))
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if (key := tuple(w[i : i + size])) in windows:
                    hit.update(range(i, i + size))
                    found |= windows[key]
        out[doc] = {"n_words": len(w), "n_hit": len(hit), "n_items": len(found), "items_sha256": _sha(sorted(map(str, found))), "contaminated": len(hit) > 0 and 20 * len(hit) >= len(w)}
    return out


def shingles(text: str | None) -> frozenset:
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def components(docs: dict) -> dict:
    """doc -> (n_shingles, component_id), every pair of different sets compared."""
    sets = {d: shingles(t) for d, t in docs.items()}
    parent = {d: d for d in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(docs)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((root(a), root(b)))
                    parent[y] = x
    return {d: (len(sets[d]), root(d)) for d in ids}

"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def fold(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def decontaminated(docs, items, window=10):
    """(key, n_words, n_hit, items) of each (key, text)."""
    windows: dict[tuple, set] = {}
    for item, text in items:
        ws = ALNUM.findall(fold(text or ""))
        for i in range(max(1, len(ws) - window + 1) if ws else 0):
            windows.setdefault(tuple(ws[i : i + window]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for key, text in docs:
        ws = ALNUM.findall(fold(text or ""))
        hit, named = [False] * len(ws), set()
        for n in sizes:
            for i in range(len(ws) - n + 1):
                found = windows.get(tuple(ws[i : i + n]))
                if found:
                    hit[i : i + n] = [True] * n
                    named |= found
        out.append((key, len(ws), sum(hit), sorted(x for x in named if x is not None)))
    return out


def repeats_removed(docs, window=35):
    """(key, n_words, n_removed, sha256 of the kept words) of each (key, text)."""
    split = [(key, SPACED.findall(text or "")) for key, text in docs]
    seen = Counter(tuple(ws[i : i + window]) for _, ws in split for i in range(len(ws) - window + 1))
    out = []
    for key, ws in split:
        gone = [False] * len(ws)
        for i in range(len(ws) - window + 1):
            if seen[tuple(ws[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((key, len(ws), sum(gone), sha(" ".join(w for w, g in zip(ws, gone, strict=True) if not g))))
    return out


def near_components(docs, words=5, percent=80):
    """(key, set size, smallest key reachable) of each (key, text)."""
    sets = []
    for key, text in docs:
        ws = SPACED.findall(fold(text or ""))
        sets.append((key, {tuple(ws[i : i + words]) for i in range(max(1, len(ws) - words + 1))} if ws else set()))
    root = list(range(len(sets)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    where: dict[tuple, list[int]] = {}
    for i, (_, s) in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    for i, (_, s) in enumerate(sets):
        common = Counter(j for x in s for j in where[x] if j < i)
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j][1]) - n):
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    least: dict[int, int] = {}
    for i, (key, _) in enumerate(sets):
        r = top(i)
        if key is not None:
            least[r] = min(key, least.get(r, key))
    return [(key, len(s), least.get(top(i))) for i, (key, s) in enumerate(sets)]


SECRETS = (
    ("assign", re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 16),
)


def known_secrets(text):
    """kind:start:end of the known forms, by start and kind."""
    found = []
    for k, (kind, pattern, group, least) in enumerate(SECRETS):
        found += [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for m in pattern.finditer(text or "") if len(m[group]) >= least]
    return [x[2] for x in sorted(found)]

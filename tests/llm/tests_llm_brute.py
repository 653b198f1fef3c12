"""Plain-loop forms of the stages, for tests."""

import re

from quern.llm.pii import BASE


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def _shingles(text):
    w = _words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def _ascii_lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def brute_groups(rows, percent):
    """Smallest reachable id of each id, by comparing all pairs that share a shingle."""
    sets = {d: _shingles(_ascii_lower(t)) for d, t in rows}
    owners, root = {}, {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for d, s in sets.items():
        shared = {}
        for x in s:
            for e in owners.setdefault(x, []):
                shared[e] = shared.get(e, 0) + 1
            owners[x].append(d)
        for e, k in shared.items():
            if 100 * k >= percent * (len(s) + len(sets[e]) - k):
                a, b = find(d), find(e)
                root[max(a, b)] = min(a, b)
    return {d: find(d) for d in sets}


def brute_leaks(docs, items):
    """(document, item) for items whose distinct shingles a document has to four fifths."""
    wanted = [(i, _shingles(t.lower())) for i, t in items]
    return {(d, i) for d, t in docs for has in [_shingles((t or "").lower())] for i, s in wanted if s and 5 * len(s & has) >= 4 * len(s)}


def _luhn(digits):
    values = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in values) % 10 == 0


def brute_mask(text):
    """The text with checked shapes blanked, each kind in turn."""
    for kind, (pattern, _) in BASE.items():
        def blank(m, kind=kind):
            digits = re.sub("[^0-9]", "", m.group())
            ok = (
                kind == "email"
                or kind == "ip" and all(int(p) <= 255 for p in m.group().split("."))
                or kind == "card" and 13 <= len(digits) <= 19 and _luhn(digits)
                or kind == "phone" and 9 <= len(digits) <= 15
            )
            return "\x00" if ok else m.group()
        text = re.sub(pattern, blank, text)
    return text

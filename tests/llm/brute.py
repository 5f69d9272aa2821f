"""The contracts, written plainly."""

import hashlib
import re
from collections import Counter, defaultdict

SPACE = r"[^\x20\x09-\x0D]+"


def lower_az(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def shingles(text):
    w = re.findall(SPACE, lower_az(text))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4) if w else 0))


def components(sets):
    """Smallest id each id can reach, over all pairs."""
    root = {i: i for i in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            a, b = sets[i], sets[j]
            if a and b and top(i) != top(j) and 100 * len(a & b) >= 85 * len(a | b):
                low, high = sorted((top(i), top(j)))
                root[high] = low
    return {i: top(i) for i in ids}


def repeats(rows):
    """(n_bytes, n_removed, n_spans, kept_sha256) by id of (id, text), ids in order."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - 99):
            part = data[at : at + 100]
            if part in seen:
                gone[at : at + 100] = b"\1" * 100
            seen.add(part)
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out[i] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def alnum_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_az(text))


def contamination(text, items):
    """(n_words, n_hit, sorted item ids) for items of (id, text)."""
    windows = defaultdict(set)
    for item, t in items:
        w = alnum_words(t)
        for at in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[at : at + 13])].add(str(item))
    words, hit, found = alnum_words(text), set(), set()
    for n in {len(k) for k in windows}:
        for at in range(len(words) - n + 1):
            key = tuple(words[at : at + n])
            if key in windows:
                hit.update(range(at, at + n))
                found |= windows[key]
    return len(words), len(hit), sorted(found)


def statistics(text):
    text = text or ""
    words = re.findall(SPACE, text)
    lines = [x for x in text.split("\n") if re.search(SPACE, x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    marks = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), marks, len(lines) - len(set(lines)), len(repeated)

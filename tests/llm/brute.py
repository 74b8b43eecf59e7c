"""Plain Python forms of the operators, for comparison on small tables."""

import hashlib
import re

import xxhash

SPACE = "\x20\x09-\x0d"
WORD = re.compile(f"[^{SPACE}]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def shingles(text, k):
    w = words((text or "").translate(AZ))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1)))


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def near(docs, k=4):
    """{doc_id: component} of documents with distinct doc_ids."""
    sets = {i: shingles(t, k) for i, t in docs}
    u = Union()
    holders = {}
    for i in sorted(sets):
        u.find(i)
        seen = {j for s in sets[i] for j in holders.get(s, ())}
        for j in seen:
            both = len(sets[i] & sets[j])
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                u.join(i, j)
        for s in sets[i]:
            holders.setdefault(s, []).append(i)
    return {i: (len(sets[i]), u.find(i)) for i in sets}


def windows(docs, width=50):
    """{doc_id: (n_words, n_removed, kept sha)} of documents with distinct doc_ids."""
    first, out = {}, {}
    for i, t in sorted(docs):
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if first.setdefault(tuple(w[k : k + width]), i) < i:
                gone[k : k + width] = [True] * width
        out[i] = (len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


def luhn(digits):
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits))) % 10 == 0


def base_spans(text):
    """(start, rank, kind, stop) by the contract's patterns as they are written."""
    t, out = text or "", []
    out += [(m.start(), 0, "email", m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, "ip", m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m[0] if c.isdigit()]
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, "card", m.end()))
    out += [(m.start(), 3, "phone", m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out)


MASK = (1 << 64) - 1


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def h_text(s):
    return signed(xxhash.xxh64_intdigest(s.encode(), 42))


def h_longs(*xs):
    seed = 42
    for x in xs:
        seed = xxhash.xxh64_intdigest((x & MASK).to_bytes(8, "little"), seed & MASK)
    return signed(seed)


def h_int(x, seed):
    # a 4-byte value is hashed as 4 bytes
    return signed(xxhash.xxh64_intdigest((x & 0xFFFFFFFF).to_bytes(4, "little"), seed & MASK))


def fingerprint(text, k=3, bins=32, size=2):
    """The elements of a part by hash, then all others by the hash mixed with the part's number."""
    w = [h_text(x) for x in words(text)]
    n = max(1, len(w) - k + 1) if w else 0
    seen, items = {}, []
    for h, i in sorted((h_longs(*w[i : i + k]) >> 27, i) for i in range(n)):
        nth = seen.get(h, 0)
        seen[h] = nth + 1
        items.append((h if nth == 0 else h_int(nth, h_longs(h)) >> 27, i))
    out = []
    for b in range(-bins // 2, bins // 2):
        part = sorted(x for x in items if x[0] >> (37 - 5) == b)[:size]
        part += sorted((x for x in items if x[0] >> (37 - 5) != b), key=lambda x: (h_int(b, h_longs(x[0])), x))[: size - len(part)]
        out.append(f"{(h_longs(*(u for u, _ in sorted(part, key=lambda x: x[1]))) >> 32) & 0xFFFFFFFF:08x}" if part else "--------")
    return "".join(out)

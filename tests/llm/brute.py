"""Plain Python answers to the operators' questions, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

ALPHANUMERIC = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
NOT_BLANK = re.compile(r"[^\x20\x09-\x0D]+")
LOWERED = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, pattern=ALPHANUMERIC):
    return pattern.findall((text or "").translate(LOWERED))


def contamination(docs, items, window=10):
    """(doc_id, n_words, n_hit, items) of each document."""
    wins = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in wins}:
            for i in range(len(w) - n + 1):
                if owners := wins.get(tuple(w[i : i + n])):
                    hit |= set(range(i, i + n))
                    found |= owners
        out.append((doc, len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    return out


_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _luhn(digits):
    doubled = [int(d) * (2 if i % 2 else 1) for i, d in enumerate(digits[::-1])]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def base_spans(text):
    out = [("email", *m.span()) for m in _EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and _luhn(digits):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def shingles(text, size):
    w = words(text, NOT_BLANK)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1)))


def components(docs, size, least, per):
    """{doc_id: (n_shingles, component)} by comparing all pairs."""
    sets = {doc: shingles(text, size) for doc, text in docs}
    label = {doc: doc for doc in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and per * len(x & y) >= least * len(x | y):
                ra, rb = root(a), root(b)
                label[max(ra, rb)] = min(ra, rb)
    return {d: (len(sets[d]), root(d)) for d in ids}


END = None


def unigram_scores(docs, is_training):
    """{doc_id: (n_tokens, n_known, train_tokens, base_score)}"""
    tokens = {d: [*words(t, NOT_BLANK), END] for d, t in docs}
    counts = Counter(x for d, w in tokens.items() if is_training(d) for x in w)
    total, distinct = sum(counts.values()), len(counts)
    return {
        d: (
            len(w),
            sum(counts[x] > 0 for x in w),
            total,
            sum(math.log10((counts[x] + 1) / (total + distinct + 1)) for x in w),
        )
        for d, w in tokens.items()
    }


def crc(key):
    return zlib.crc32(str(key).encode())


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()


def phrase_places(text, phrases):
    """(label, first word) of each place of a phrase."""
    w = words(text)
    out = []
    for phrase, label in phrases:
        p = phrase.split()
        out += [(label, i) for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
    return sorted(out)


def without_repeated(docs, size=50):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) where passages of a smaller id are removed."""
    least = {}
    for doc, text in docs:
        raw = (text or "").encode()
        for i in range(len(raw) - size + 1 if doc is not None else 0):
            passage = raw[i : i + size]
            least[passage] = min(doc, least.get(passage, doc))
    out = []
    for doc, text in docs:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - size + 1 if doc is not None else 0):
            if least[raw[i : i + size]] < doc:
                gone[i : i + size] = b"\1" * size
        kept = bytes(x for x, g in zip(raw, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out

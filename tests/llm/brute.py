"""Plain-Python versions of what the operators compute, over all pairs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import regex
import xxhash

PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def groups(nodes, near):
    """Smallest member of each node's component, by comparing all pairs."""
    parent = {n: n for n in nodes}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    ordered = sorted(parent)
    for i, a in enumerate(ordered):
        for b in ordered[:i]:
            if near(a, b):
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    return {n: top(n) for n in parent}


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    grams = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << bit for bit in range(64) if sum(h >> bit & 1 for h in hashes) * 2 > len(hashes))


def luhn(digits):
    total = 0
    for place, digit in enumerate(reversed(digits)):
        n = int(digit) * (1 + place % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def personal_data(text):
    def holds(kind, match):
        digits = re.sub("[^0-9]", "", match)
        if kind == "ip":
            return all(int(x) <= 255 for x in match.split("."))
        if kind == "card":
            return 13 <= len(digits) <= 19 and luhn(digits)
        return kind != "phone" or 9 <= len(digits) <= 15

    return [(k, m.start(), m.end()) for k, p in PII.items() for m in re.finditer(p, text or "") if holds(k, m.group())]


WORD = re.compile(r"[^ \t\n\x0b\f\r]+")


def sliding_shingles(line, chars=10):
    return {line[k : k + chars] for k in range(max(1, len(line) - chars + 1))}


def deduplicated(docs, shingles=sliding_shingles):
    """``docs`` as (doc_id, text) with distinct ids: texts without lines that another one stands for."""
    classes = sorted({line for _, text in docs for line in (text or "").split("\n") if WORD.search(line)})
    sets = {line: shingles(line) for line in classes}

    def near(a, b):
        x, y = sets[a], sets[b]
        return len(x & y) >= 0.8 * len(x | y)

    root, seen, out = groups(classes, near), set(), {}
    for doc_id, text in sorted(docs, key=lambda d: d[0]):
        if text is None:
            out[doc_id] = None
            continue
        kept = []
        for line in text.split("\n"):
            if WORD.search(line):
                if root[line] in seen:
                    continue
                seen.add(root[line])
            kept.append(line)
        out[doc_id] = "\n".join(kept)
    return out


def words(text):
    return re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").lower().encode())


def word_shingles(found):
    return {tuple(found[k : k + 5]) for k in range(max(1, len(found) - 4))} if found else set()


def holds_item(text, item):
    """Four fifths of the shingles of an item, of all but its last sentence or line, and of that one."""
    pieces = [words(p) for p in re.split(r"[.?!]\s|\n", item or "")]
    pieces = [p for p in pieces if p]
    have, want = words(text), words(item)
    parts = [want, sum(pieces[:-1], []), pieces[-1]] if len(pieces) > 1 else [want]

    def share(part):
        wanted = word_shingles(part)
        size = len(next(iter(wanted)))
        got = {tuple(have[k : k + size]) for k in range(len(have) - size + 1)}
        return len(wanted & got) / len(wanted)

    return bool(want) and all(share(p) >= 0.8 for p in parts)


def term_spans(docs, support=10, generalise=0.6):
    """``id: spans`` of the words that disclose a kind, by counting every word of every text."""
    found, n, with_word, texts = {}, Counter(), Counter(), {}
    held = Counter()
    for ident, text in docs:
        text = text or ""
        base, rest = personal_data(text), list(text)
        for _, a, b in base:
            rest[a:b] = " " * (b - a)
        found[ident] = [(m.start(), m.end(), m.group().lower()) for m in regex.finditer(r"[\p{L}\p{M}\p{N}_]+", "".join(rest))]
        kinds = {k for k, *_ in base}
        held.update(kinds)
        for word in {w for *_, w in found[ident]}:
            n[word] += 1
            for kind in kinds:
                with_word[word, kind] += 1
                texts.setdefault((word, kind), set()).add(text)
    total, told = len(docs), set()
    for (word, kind), both in with_word.items():
        if len(texts[word, kind]) >= support and held[kind] < total:
            share = math.log2(both * total / (n[word] * held[kind])) / math.log2(total / held[kind])
            if share >= generalise:
                told.add(word)
    return {i: [(a, b) for a, b, w in words_of if w in told] for i, words_of in found.items()}


def copies(ident, rate, seed=42, piece=32):
    count = 0
    pieces = max(1, math.ceil(rate / piece))
    mean = rate / pieces
    for k in range(1, pieces + 1):
        spot = (int(hashlib.md5(f"{seed}:{ident}:{k}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        p = total = math.exp(-mean)
        n = 0
        while total <= spot and n < 1000:
            n += 1
            p *= mean / n
            total += p
        count += n
    return count


def spelling_words(docs):
    """Occurrences of the counted words, a character dropped where the hash says so."""
    counts = Counter()
    for ident, text in docs:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if ident is None else ident}:{run}".encode())
            at = h % len(run)
            counts[run[:at] + run[at + 1 :] if h % 199 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def spelling_variants(words):
    """``word: (form, root, n, n_near, form_n)``, by trying every edit of every word."""
    letters = {c for w in words for c in w}

    def near(w):
        cut = {w[:k] + w[k + 1 :] for k in range(len(w))}
        swapped = {w[:k] + c + w[k + 1 :] for k in range(len(w)) for c in letters}
        grown = {w[:k] + c + w[k:] for k in range(len(w) + 1) for c in letters}
        return ((cut | swapped | grown) - {w}) & words.keys()

    around = {w: near(w) for w in words}
    best = {w: min(s, key=lambda x: (-words[x], x)) for w, s in around.items() if s}
    form = {w: b for w, b in best.items() if words[b] >= 5 * words[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (form.get(w), root(w), n, len(around[w]), words.get(form.get(w))) for w, n in words.items()}


def without_repeats(docs, size=400):
    """``(doc_id, n_bytes, spans, kept)`` per document, by counting every window."""
    texts = [(ident, (text or "").encode()) for ident, text in docs]

    def windows(data):
        return [hashlib.blake2b(data[k : k + size], digest_size=16).digest() for k in range(len(data) - size + 1)]

    counts = Counter(w for _, data in texts for w in windows(data))
    out = []
    for ident, data in texts:
        spans = []
        for k, w in enumerate(windows(data)):
            if counts[w] > 1:
                if spans and k <= spans[-1][1]:
                    spans[-1] = spans[-1][0], k + size
                else:
                    spans.append((k, k + size))
        kept, at = b"", 0
        for a, b in spans:
            kept, at = kept + data[at:a], b
        out.append((ident, len(data), spans, kept + data[at:]))
    return out

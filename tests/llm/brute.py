"""Plain versions of the operators, for small inputs."""

import hashlib
import itertools
import re
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def exact(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[(text or "").translate(LOWER)].append(i)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, sha(text)) for i in ids]
    return out


def shingle_set(text, k):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    if len(words) < k:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[j:j + k]) for j in range(len(words) - k + 1))


def near(rows, k, percent):
    """``{id: (set size, component)}``."""
    sets = {i: shingle_set(text, k) for i, text in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def lines(rows, percent=80):
    """``{id: (lines, removed, text)}`` for distinct ids."""
    seen, out = [], {}
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        kept = []
        for line in [] if text is None else text.split("\n"):
            words = frozenset(WORD.findall(line.translate(LOWER)))
            match = words and any(100 * len(words & s) >= percent * len(words | s) for s in seen)
            if words and words not in seen:
                seen.append(words)
            if not match:
                kept.append(line)
        n = 0 if text is None else len(text.split("\n"))
        out[i] = (n, n - len(kept), None if text is None else "\n".join(kept))
    return out


KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(part) <= 255 for part in value.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def personal(text):
    return [(kind, m.start(), m.end()) for kind, pattern in KINDS.items()
            for m in re.finditer(pattern, text or "") if _valid(kind, m.group())]


def repeats(rows, length=50):
    """``[(id, bytes, removed, spans, kept)]``."""
    least = {}
    for i, text in rows:
        raw = (text or "").encode()
        for k in range(len(raw) - length + 1):
            s = raw[k:k + length]
            least[s] = min(least.get(s, i), i)
    out = []
    for i, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), dtype=bool)
        for k in range(len(raw) - length + 1):
            if least[raw[k:k + length]] < i:
                gone[k:k + length] = True
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((i, len(raw), int(gone.sum()), spans, np.frombuffer(raw, np.uint8)[~gone].tobytes()))
    return out


def divergence(rows, shown=50, least=30):
    """``{(lang, source, part, item, value, rank)}`` of ``(text, lang, source)`` rows."""
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))) for text, lang, source in rows]
    seen = Counter((lang, t) for lang, _, terms in docs for t in set(terms))
    kept = defaultdict(list)
    for (lang, t), n in seen.items():
        if n >= least:
            kept[lang].append(t)
    counts, whole = defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in docs:
        own = Counter(t for t in terms if seen[lang, t] >= least)
        counts[lang, source] += own
        whole[lang] += own

    def prices(n, lang):
        return {t: 1 + 10**9 * (n[t] + 5) // (sum(n.values()) + 5 * len(kept[lang])) for t in kept[lang]}

    price = {g: prices(counts[g], g[0]) for g in {(lang, source) for lang, source, _ in docs}}
    out = set()
    for (lang, source), p in price.items():
        pairs = [(h[1], sum(abs(p[t] - q[t]) for t in p)) for h, q in price.items() if h[0] == lang and h[1] != source]
        q = prices(whole[lang], lang)
        terms = [(t, p[t] - q[t]) for t in p if counts[lang, source][t] and p[t] > q[t]]
        for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, shown)):
            ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
            out |= {(lang, source, part, item, value, k + 1) for k, (item, value) in enumerate(ranked)}
    return out


def decontaminated(rows, items, length=10):
    """``{id: (words, hit, item ids, hit places)}``."""
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))

    windows = defaultdict(set)
    for item, text in items:
        ws = words(text)
        n = min(length, len(ws))
        for k in range(len(ws) - n + 1 if n else 0):
            windows[tuple(ws[k:k + n])].add(item)
    out = {}
    for i, text in rows:
        ws, hit, found = words(text), set(), set()
        for n in {len(w) for w in windows}:
            for k in range(len(ws) - n + 1):
                if tuple(ws[k:k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(ws[k:k + n])]
        out[i] = len(ws), len(hit), sorted(str(x) for x in found if x is not None), hit
    return out


def collocated(rows, shown=2000):
    """``{(lang, rank, phrase, a, l, r, n, score)}`` of ``(text, lang)`` rows."""
    f = defaultdict(Counter)
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            ws = tuple(re.findall(r"[^\x20\x09]+", piece))
            for k in (1, 2, 3):
                f["und" if lang is None else lang].update(ws[i:i + k] for i in range(len(ws) - k + 1))
    out = set()
    for lang, counts in f.items():
        n = sum(c for w, c in counts.items() if len(w) == 1)
        candidates = {w: a for w, a in counts.items() if len(w) > 1 and a >= 10}
        held = Counter()
        for w, a in candidates.items():
            if len(w) == 3:
                held[w[:2]], held[w[1:]] = max(held[w[:2]], a), max(held[w[1:]], a)
        found = []
        for w, a in candidates.items():
            cuts = [(10**6 * a * a // (counts[w[:k]] * counts[w[k:]]), k, counts[w[:k]], counts[w[k:]]) for k in range(1, len(w))]
            score, _, left, right = min(cuts)
            if 100 * held[w] < 50 * a:
                found.append((-score, -a, " ".join(w).encode(), left, right))
        for k, (score, a, phrase, left, right) in enumerate(sorted(found)[:shown]):
            out.add((lang, k + 1, phrase.decode(), -a, left, right, n, -score))
    return out


def smoothed(rows):
    """Kneser-Ney models of ``(text, toxic)`` rows: a function from a text to its (mean difference, most telling word)."""
    def words(text):
        return WORD.findall((text or "").translate(LOWER))

    def fall(counts):
        times = Counter(counts)
        if not times[1]:
            return [0, 0.75, 0.75, 0.75]
        base, out = times[1] / (times[1] + 2 * times[2]), [0]
        for n in (1, 2, 3):
            by_counts = n - (n + 1) * base * times[n + 1] / times[n] if times[n] else base
            out.append(min(max(by_counts, base), n))
        return out

    def left(n, taken):
        return n - taken[min(n, 3)]

    pairs, seen = (Counter(), Counter()), {None}
    for text, toxic in rows:
        ws = words(text)
        seen |= set(ws)
        pairs[toxic].update(set(zip(ws, ws[1:])))
    follows = [Counter(w for _, w in p) for p in pairs]
    every = follows[0] + follows[1]
    shared = {w: (every[w] + 0.5) / (sum(every.values()) + 0.5 * len(seen)) for w in seen}
    taken, word = fall([n for f in follows for n in f.values()]), []
    for f in follows:
        total = sum(f.values())
        free = total - sum(left(n, taken) for n in f.values())
        word.append({w: (left(f[w], taken) + free * shared[w]) / total if total else shared[w] for w in seen})
    taken = fall([n for p in pairs for n in p.values()])
    levels = [*pairs, pairs[0] + pairs[1]]
    after = [defaultdict(list) for _ in levels]
    for own, level in zip(after, levels):
        for (h, _), n in level.items():
            own[h].append(n)

    def after_of(level, h, w, lower):
        own = after[level][h]
        if not own:
            return lower
        return (left(levels[level][h, w], taken) + (sum(own) - sum(left(n, taken) for n in own)) * lower) / sum(own)

    def judge(text):
        ws = [w if w in seen else None for w in words(text)]
        alone = [np.log(word[1][w] / word[0][w]) for w in ws]
        found = alone[:1]
        for h, w in zip(ws, ws[1:]):
            toxic, plain = (after_of(c, h, w, after_of(2, h, w, word[c][w])) for c in (1, 0))
            found.append(np.log(toxic / plain))
        return (sum(found) / len(found), max(alone)) if ws else (0, 0)

    return judge

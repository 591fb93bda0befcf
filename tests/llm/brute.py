"""Plain Python versions of the operators' contracts, for small tables."""

import collections
import functools
import hashlib
import math
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORD_10 = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def components(docs):
    """{doc_id: (n_shingles, component_id)} of [(doc_id, text)]."""
    sets = {}
    for i, t in docs:
        w = WORD.findall(lower(t))
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def removed(docs):
    """{doc_id: (n_words, n_removed, kept words)} of [(doc_id, text)]."""
    words = {i: WORD.findall(t or "") for i, t in docs}
    least = {}
    for i in sorted(words):
        for s in range(len(words[i]) - 12):
            least.setdefault(tuple(words[i][s:s + 13]), i)
    out = {}
    for i, w in words.items():
        gone = {p for s in range(len(w) - 12) if least[tuple(w[s:s + 13])] < i for p in range(s, s + 13)}
        out[i] = (len(w), len(gone), [x for p, x in enumerate(w) if p not in gone])
    return out


def contamination(docs, items):
    """{doc_id: (n_words, n_hit, items, contaminated)}."""
    windows = collections.defaultdict(set)
    for i, t in items:
        w = WORD_10.findall(lower(t))
        n = min(13, len(w))
        for s in range(len(w) - n + 1) if w else ():
            windows[tuple(w[s:s + n])].add(str(i))
    out = {}
    for i, t in docs:
        w, hit, got = WORD_10.findall(lower(t)), set(), set()
        for n in {len(x) for x in windows}:
            for s in range(len(w) - n + 1):
                x = windows.get(tuple(w[s:s + n]))
                if x:
                    hit |= set(range(s, s + n))
                    got |= x
        out[i] = (len(w), len(hit), sorted(got), bool(hit) and 20 * len(hit) >= len(w))
    return out


def base_counts(t):
    t = t or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    c = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    again = {p for i in range(len(w) - 2) if c[tuple(w[i:i + 3])] > 1 for p in (i, i + 1, i + 2)}
    failed = len(w) < 50 or 100 * len(again) > 50 * len(w)
    return (len(w), sum(map(len, w)), sum(t.count(s) for s in "#*$%&|<>"), len(lines) - len(set(lines)), len(again), failed)


def sha(words):
    return hashlib.sha256(" ".join(words).encode()).hexdigest()


class KneserNey:
    """Interpolated modified Kneser-Ney over token sequences with ``order - 1`` starts before them."""

    def __init__(self, sequences, order, base):
        self.order, self.base, self.memo = order, base, {}
        self.counts = [collections.Counter() for _ in range(order + 1)]
        for w in sequences:
            self.counts[order].update(tuple(w[i - order + 1:i + 1]) for i in range(order - 1, len(w)))
        for k in range(order - 1, 0, -1):
            self.counts[k].update(g[1:] for g in self.counts[k + 1])
        self.d, self.total, self.taken = {}, collections.Counter(), collections.Counter()
        for k in range(1, order + 1):
            n = [max(1, sum(v == j for v in self.counts[k].values())) for j in (1, 2, 3, 4)]
            q = n[0] / (n[0] + 2 * n[1])
            self.d[k] = [0] + [min(max(j - (j + 1) * q * n[j] / n[j - 1], 0.05), j) for j in (1, 2, 3)]
            for g, v in self.counts[k].items():
                self.total[g[:-1]] += v
                self.taken[g[:-1]] += self.d[k][min(v, 3)]

    def log2(self, g, seen=None):
        """log2 P of the end of ``g``; n-grams that are not ``seen`` give nothing, the others what they give in the whole model."""
        if seen is None and g in self.memo:
            return self.memo[g]
        k = len(g)
        low = self.log2(g[1:], seen) if k > 1 else self.base(g[0])
        out = low
        if g[:-1] in self.total and (k == 1 or seen is None or seen(g[:-1])):
            rest, v = self.taken[g[:-1]] / self.total[g[:-1]], self.counts[k].get(g, 0)
            out += math.log2(rest)
            if v and (seen is None or seen(g)):
                whole = rest * 2 ** (self.log2(g[1:]) if k > 1 else low)
                out += math.log2(((v - self.d[k][min(v, 3)]) / self.total[g[:-1]] + whole) / whole)
        if seen is None:
            self.memo[g] = out
        return out


def classifier(docs, trusted, classes, quantile, margin, prior):
    """Ids that the quality classifier keeps of ``docs`` (id, lang, text; ids differ), fitted on the ids ``trusted``."""
    texts = {i: t for i, _, t in docs if i in trusted and t}
    members = collections.Counter(classes)
    byte = KneserNey(([0] * 3 + [classes[b] for b in t.encode()] for t in texts.values()), 4, lambda c: -6.0)

    @functools.cache
    def spell(word):
        c = [0, 0, 1, *(classes[b] for b in word), 1]
        return sum(byte.log2(tuple(c[i - 3:i + 1])) for i in range(3, len(c))) - sum(math.log2(members[classes[b]]) for b in word)

    def padded(t):
        return [None, None, *re.split(rb"[ \t-\r]+", t.encode().strip(b" \t\n\v\f\r")), b""] if t.strip(" \t\n\v\f\r") else [None, None, b""]

    word = KneserNey(map(padded, texts.values()), 3, spell)
    owners = collections.defaultdict(set)
    for i, t in texts.items():
        w = padded(t)
        for at in range(2, len(w)):
            for k in (1, 2, 3):
                owners[tuple(w[at - k + 1:at + 1])].add(i)
    score = {}
    for i, _, t in docs:
        if t:
            w, b = padded(t), t.encode()
            seen = (lambda g: set(g) == {None} or owners[g] != {i}) if i in texts else None  # noqa: B023
            c = [0] * 3 + [classes[x] for x in b]
            place = [byte.log2(tuple(c[at:at + 4])) for at in range(len(b))]
            bits = sum(word.log2(tuple(w[at - 2:at + 1]), seen) for at in range(2, len(w)))
            bits += sum(p for at, p in enumerate(place) if b[at] in b" \t\n\v\f\r" and not (b[at] == 32 and at and b[at - 1] not in b" \t\n\v\f\r"))
            score[i] = (-bits, -sum(place), len(b))
    lang = {i: x for i, x, _ in docs}
    kept = {i for i, _, t in docs if not t}
    fine = [set(), set()]
    for kind in (0, 1):
        mean = sum(score[i][kind] for i in texts) / sum(score[i][2] for i in texts)
        drawn = {i: (s[kind] + mean * prior) / (s[2] + prior) for i, s in score.items()}
        every = sorted(drawn[i] for i in texts)
        for i, x in drawn.items():
            own = sorted(drawn[j] for j in texts if lang[j] == lang[i] and lang[i] is not None) or every
            if x <= own[math.ceil(quantile * len(own)) - 1] + margin:
                fine[kind].add(i)
    return kept | fine[0] & fine[1]

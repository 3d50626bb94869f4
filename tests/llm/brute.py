"""Plain versions of the operators, for small inputs."""

import collections
import hashlib
import math
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def repeated(rows, window=100):
    """rows (doc_id, text) -> doc_id: (n_bytes, n_removed, n_spans, kept_sha256, kept bytes)."""
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        mark = bytearray(len(data))
        for p in range(len(data) - window + 1):
            s = data[p:p + window]
            if s in seen:
                mark[p:p + window] = b"\1" * window
            seen.add(s)
        kept = bytes(c for c, m in zip(data, mark, strict=True) if not m)
        spans = sum(1 for p in range(len(data)) if mark[p] and (p == 0 or not mark[p - 1]))
        out[i] = (len(data), sum(mark), spans, hashlib.sha256(kept).hexdigest(), kept)
    return out


def components(rows, size, share):
    """rows (doc_id, text) -> doc_id: (n_shingles, component_id, kept)."""
    sets = {}
    for i, text in rows:
        words = WORD.findall(fold(text or ""))
        k = min(size, len(words))
        sets[i] = {tuple(words[j:j + k]) for j in range(len(words) - k + 1)} if words else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = collections.defaultdict(set)
    for i, s in sets.items():
        for x in s:
            holders[x].add(i)
    for i, s in sets.items():
        for j in set().union(*(holders[x] for x in s)) if s else ():
            if i < j and 100 * len(s & sets[j]) >= share * len(s | sets[j]):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def statistics(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    counts, covered = collections.Counter(windows), set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered.update(range(i, i + 8))
    n = len(words)
    return (n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered),
            n < 20 or 100 * len(covered) > 30 * n)


def place(*parts):
    return int(hashlib.md5(":".join(parts).encode()).hexdigest()[:13], 16)


def mixture(rows, repeats, seed, blocks):
    """rows (doc_id, source, text) -> sorted (doc_id, pass)."""
    size = {i: len(WORD.findall(t or "")) for i, _, t in rows}
    key = {i: "-" if s is None else "=" + s for i, s, _ in rows}
    block = {i: place("block", str(i)) % blocks for i in size}
    total = collections.Counter()
    for i in size:
        total[key[i]] += size[i]
    total = {k: n for k, n in total.items() if n}
    whole = sum(total.values())
    low, high = 0.0, 1.0

    def weights(t):
        powers = {k: (n / whole) ** t for k, n in total.items()}
        return {k: p / sum(powers.values()) for k, p in powers.items()}

    def fits(t):
        passes = [w * whole / total[k] for k, w in weights(t).items()]
        return max(passes) <= repeats * min(passes) * (1 + 1e-12)

    if total and fits(0.0):
        high = 0.0
    else:
        for _ in range(50):
            middle = (low + high) / 2
            low, high = (low, middle) if fits(middle) else (middle, high)
    w = weights(high)
    budget = max((n / w[k] for k, n in total.items()), default=0)
    out = []
    for k in set(key.values()):
        own = [i for i in size if key[i] == k]
        tokens = collections.Counter()
        for i in own:
            tokens[block[i]] += size[i]
        if k not in total:
            out += [(i, 0) for i in own]
            continue
        goal = round(w[k] * budget)
        full = goal // total[k]
        rest = goal - full * total[k]
        for turn in range(full):
            out += [(i, turn) for i in own]
        done = 0
        for b in sorted(tokens, key=lambda b: (place(str(seed), k, str(full), str(b)), b)):
            if 2 * (rest - done) > tokens[b]:
                out += [(i, full) for i in own if block[i] == b]
            done += tokens[b]
    return sorted(out)


def bigram_losses(target, background, most, smoothing, weight):
    """A function from a text to its mean losses under the two models."""
    split = lambda t: (t or "").lower().split()
    counts = collections.Counter(w for t in [*target, *background] for w in split(t))
    vocabulary = {w: i + 1 for i, (w, _) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:most])}
    outcomes = len(vocabulary) + 1

    def model(texts):
        pairs, ones, before = collections.Counter(), collections.Counter(), collections.Counter()
        for t in texts:
            last = "^"
            for w in split(t):
                n = vocabulary.get(w, 0)
                pairs[last, n] += 1
                ones[n] += 1
                before[last] += 1
                last = n
        total = sum(ones.values())

        def loss(last, n):
            uni = (ones[n] + smoothing) / (total + smoothing * outcomes)
            bi = pairs[last, n] / before[last] if before[last] else uni
            return -math.log(weight * bi + (1 - weight) * uni)

        return loss

    models = [model(target), model(background)]

    def score(text):
        ids = [vocabulary.get(w, 0) for w in split(text)]
        return tuple(sum(m(a, b) for a, b in zip(["^", *ids], ids, strict=False)) / max(1, len(ids)) for m in models)

    return score

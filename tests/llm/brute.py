"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import string
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile("[^\x20\x09-\x0d]+")
ALPHANUMERIC = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(text, lower=True, pattern=WORD):
    text = text or ""
    return pattern.findall(text.translate(LOWER) if lower else text)


def scores(texts, held, order):
    """(n_tokens, n_known, train_tokens, base, score) of each text."""
    tokens = [["<s>", *words(t), "</s>"] for t in texts]
    grams = {n: Counter() for n in range(1, order + 1)}
    for t, h in zip(tokens, held):
        if not h:
            for n, counter in grams.items():
                counter.update(tuple(t[i:i + n]) for i in range(len(t) - n + 1))
    unigrams = {w[0]: c for w, c in grams[1].items() if w[0] != "<s>"}
    total, kinds = sum(unigrams.values()), len(unigrams)
    discount = {}
    for n, counter in grams.items():
        values = list(unigrams.values()) if n == 1 else list(counter.values())
        one, two = values.count(1), values.count(2)
        discount[n] = one / (one + 2 * two) if one and two else 0.5
    followers = Counter(g[:-1] for n in range(2, order + 1) for g in grams[n])
    out = []
    for t in tokens:
        base = score = 0.0
        known = 0
        for i in range(1, len(t)):
            c = unigrams.get(t[i], 0)
            known += c > 0
            base += math.log10((c + 0.5) / (total + 0.5 * (kinds + 1)))
            p = ((c - discount[1]) / total if c else discount[1] * kinds / total) if total else 1.0
            for n in range(2, order + 1):
                if i - n + 1 < 0:
                    break
                history = tuple(t[i - n + 1:i])
                h = grams[n - 1].get(history, 0)
                if h:
                    c = grams[n].get((*history, t[i]), 0)
                    p = (c - discount[n] if c else 0) / h + discount[n] * followers[history] / h * p
            score += math.log10(p)
        out.append((len(t) - 1, known, total, base, score))
    return out


def url_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    return host.translate(LOWER), re.split("[?#]", rest[len(host):], maxsplit=1)[0]


def judge_url(url, rules, default="allow"):
    host, path = url_parts(url)
    fits = [(len(h + p), a == "block", h + p, a) for a, h, p in ((a, h, p or "") for a, h, p in rules)
            if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else default


def passages(text, benchmark, window):
    """Number of words, hit words, and item ids."""
    own, hit, ids = words(text, pattern=ALPHANUMERIC), set(), set()
    for item, body in benchmark:
        theirs = words(body, pattern=ALPHANUMERIC)
        size = min(window, len(theirs))
        if size:
            wins = {tuple(theirs[i:i + size]) for i in range(len(theirs) - size + 1)}
            for i in range(len(own) - size + 1):
                if tuple(own[i:i + size]) in wins:
                    hit.update(range(i, i + size))
                    if item is not None:
                        ids.add(str(item))
    return len(own), len(hit), sorted(ids)


def lines(texts, min_documents):
    """(n_lines, n_dropped, kept text) of each text."""
    key = lambda line: line.strip(" \t\n\v\f\r").translate(LOWER)
    split = [(t or "").split("\n") for t in texts]
    found = Counter(k for own in split for k in {key(x) for x in own} if k)
    out = []
    for own in split:
        kept = [x for x in own if found[key(x)] < min_documents]
        out.append((len(own), len(own) - len(kept), "\n".join(kept)))
    return out


def targets(sizes, weights, repeats=3):
    """Excess above `repeats` times a source's size goes to the others by weight, until none is above."""
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(repeats * sizes[s] for s in capped)
        weight = sum(w for s, w in weights.items() if s not in capped)
        share = {s: repeats * sizes[s] if s in capped else left * w / weight for s, w in weights.items()}
        over = {s for s in share if s not in capped and share[s] > repeats * sizes[s]}
        if not over:
            return share
        capped |= over


def signals(text):
    own = words(text, lower=False)
    windows = Counter(tuple(own[i:i + 8]) for i in range(len(own) - 7))
    covered = {j for i in range(len(own) - 7) if windows[tuple(own[i:i + 8])] > 1 for j in range(i, i + 8)}
    rows = [x for x in (text or "").split("\n") if WORD.search(x)]
    counts = (len(own), sum(map(len, own)), sum((text or "").count(c) for c in "#*$%&|<>"), len(rows) - len(set(rows)), len(covered))
    return counts, len(own) < 20 or 100 * len(covered) > 30 * len(own), len(rows)


def quality_kept(rows, reach=4.0, tail=0.9, prior=50, errors=3.0):
    """Verdicts of (text, lang, source) rows; quantiles as the smallest value with so much at or below it."""
    measured, groups = [], defaultdict(list)
    for text, lang, source in rows:
        (n, chars, symbols, dup, repeated), failed, n_lines = signals(text)
        rates = {"symbol_share": symbols / max(chars, 1), "long_words": chars / max(n, 1),
                 "dup_line_share": dup / max(n_lines, 1), "repeat_share": repeated / max(n, 1)}
        events = {"symbol_share": (symbols, chars), "dup_line_share": (dup, n_lines), "repeat_share": (repeated / 8, n / 8)}
        measured.append((failed, rates, events))
        for group in ((lang, source), (lang,), ()):
            groups[group].append(rates)
    quantile = lambda values, q: sorted(values)[max(math.ceil(q * len(values)) - 1, 0)]
    fence = {}
    for group in sorted(groups, key=len):
        for name in groups[group][0]:
            values = [m[name] for m in groups[group]]
            low, high = quantile(values, 0.25), quantile(values, 0.75)
            own = max(high + reach * (high - low), quantile(values, tail), sum(int(v * 10**6) for v in values) / len(values) / 10**6)
            larger = fence[group[:-1], name] if group else own
            fence[group, name] = (own * len(values) + prior * larger) / (len(values) + prior) if group else own
    out = []
    for (failed, rates, events), (_, *group) in zip(measured, rows):
        beyond = [k - fence[tuple(group), n] * of > errors * math.sqrt(k) for n, (k, of) in events.items()]
        out.append(not failed and not any(beyond) and rates["long_words"] <= fence[tuple(group), "long_words"])
    return out


def fingerprint(text, shingle=3):
    own = words(text)
    if not own:
        return 0
    size = min(shingle, len(own))
    hashes = [xxhash.xxh64_intdigest(" ".join(own[i:i + size]).encode(), 42) for i in range(len(own) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, max_bits=3):
    """The smallest index reachable from each."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= max_bits:
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return [find(i) for i in range(len(prints))]


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()


def crc_held(key):
    return key is not None and zlib.crc32(str(key).encode()) % 5 == 1

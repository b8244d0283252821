"""Plain single-process versions of the operators, written from their definitions."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def exact(docs):
    groups = defaultdict(list)
    for doc_id, text in docs:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep, done = min(known) if known else None, False
        for i in sorted(ids, key=lambda i: (i is None, i)):
            out.append((i, keep, len(ids), i == keep and not done, hashlib.sha256(text.encode()).hexdigest()))
            done = done or i == keep
    return out


def simhash(docs, words_in_shingle=3, distance=2):
    prints = []
    for doc_id, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
        if len(words) < words_in_shingle:
            shingles = [" ".join(words)] if words else []
        else:
            shingles = [" ".join(words[i : i + words_in_shingle]) for i in range(len(words) - words_in_shingle + 1)]
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        value = 0
        for bit in range(64):
            if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes):
                value |= 1 << bit
        prints.append((doc_id, value))
    distinct = sorted({p for _, p in prints})
    root = {p: p for p in distinct}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= distance:
                root[find(a)] = find(b)
    first = {}
    for doc_id, p in prints:
        if doc_id is not None:
            first[find(p)] = min(first.get(find(p), doc_id), doc_id)
    return [(i, f"{p:016x}", first.get(find(p))) for i, p in prints]


def decontaminate(docs, items, window=10):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))

    windows = defaultdict(set)
    for item_id, text in items:
        held = words(text)
        for i in range(max(1, len(held) - window + 1) if held else 0):
            windows[tuple(held[i : i + window])].add(item_id)
    lengths = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        held = words(text)
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(held) - n + 1):
                if (w := tuple(held[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[w]
        named = sorted({str(i) for i in found if i is not None})
        digest = hashlib.sha256(",".join(named).encode()).hexdigest()
        out.append((doc_id, len(held), len(hit), len(named), digest, bool(hit)))
    return out


ASSIGN = re.compile(
    r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def secrets(docs):
    out = []
    for doc_id, text in docs:
        spans, text = [], text or ""
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
        named = [f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(spans)]
        counts = [sum(k == n for _, k, _ in spans) for n in range(3)]
        out.append((doc_id, *counts, hashlib.sha256(",".join(named).encode()).hexdigest(), named))
    return out


def lines(docs, min_docs=10, min_chars=1):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(UPPER)

    holders = defaultdict(set)
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            holders[key(line)].add(doc_id)
    out = []
    for doc_id, text in docs:
        held = (text or "").split("\n")
        kept = [x for x in held if len(key(x)) < min_chars or len(holders[key(x)]) < min_docs]
        out.append((doc_id, len(held), len(held) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def targets(sizes, weights=(1, 2, 3), repeats=3):
    """Share by weight, hold sources at their limit, share the rest again, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    fixed = {}
    while True:
        left = sum(sizes.values()) - sum(fixed.values())
        open_ = [s for s in names if s not in fixed]
        total = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / total for s in open_}
        above = [s for s in open_ if share[s] > repeats * sizes[s]]
        if not above:
            return fixed | share
        fixed |= {s: repeats * sizes[s] for s in above}


def spelling(docs, every=31, times=10, min_chars=7, min_count=2):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= min_chars:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= min_count}
    replaced, near = defaultdict(set), defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            replaced[w[:i], w[i + 1 :]].add(w)
            if w[:i] + w[i + 1 :] in counts:
                near[w].add(w[:i] + w[i + 1 :])
                near[w[:i] + w[i + 1 :]].add(w)
    for same in replaced.values():
        for w in same:
            near[w] |= same - {w}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] >= times * n:
            form[w] = best
    out = []
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), counts.get(form.get(w))))
    return out


def negatives(rows, is_anchor, first=5, least=80):
    """``rows``: id, label, vector. Rows with missing or non-finite values take no part; lengths never mix."""
    usable = [
        (i, label, [math.floor(256 * x) for x in v])
        for i, label, v in rows
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for at, (anchor, label, q) in enumerate(usable):
        if anchor is None or not is_anchor(anchor):
            continue
        met = [(sum(a * b for a, b in zip(q, v)), i, other) for k, (i, other, v) in enumerate(usable) if k != at and len(v) == len(q)]
        met.sort(key=lambda x: (-x[0], x[1] is None, x[1]))
        for score, i, _ in [x for x in met if x[2] == label][:first]:
            inside = [x for x in met if x[2] != label and least * score <= 100 * x[0] <= 100 * score][:first]
            out += [(anchor, i, rank, x[1], score, x[0]) for rank, x in enumerate(inside, 1)]
    return out


def base_scores(docs):
    def tokens(text):
        return [*(text or "").encode().lower().split(), None]

    learned = Counter()
    for doc_id, text in docs:
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 != 2:
            learned.update(tokens(text))
    total, distinct = sum(learned.values()), len(learned)
    out = []
    for doc_id, text in docs:
        held = doc_id is None or zlib.crc32(str(doc_id).encode()) % 7 == 2
        found = tokens(text)
        score = sum(math.log10((learned[x] + 1) / (total + distinct + 1)) for x in found)
        out.append((doc_id, held, len(found), sum(learned[x] > 0 for x in found), total, round(score, 6)))
    return out

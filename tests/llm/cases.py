"""Small documents with every awkward case, and brute-force versions of the operators."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, block long, rank string, key int"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def documents(seed=5, n=60):
    """Rows of ``SCHEMA``: copies, near copies, shared passages and lines, nulls, blanks, a long text, repeated rows."""
    rng = random.Random(seed)
    stock = ["".join(rng.choice("aeiourstnlßé") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    speak = lambda k: [rng.choice(stock) for _ in range(k)]
    passage, line = speak(40), " ".join(speak(9)).title()
    rows = []
    for i in range(n):
        w = speak(rng.randint(3, 150))
        if i % 4 == 1:
            w = w[:5] + passage + w[5:]
        if i % 7 == 3 and rows:
            w = words(rows[rng.randrange(len(rows))][1]) or w
            for _ in range(rng.randint(0, 6)):
                w[rng.randrange(len(w))] = rng.choice(stock)
        cut = rng.randint(1, len(w))
        text = " ".join(w[:cut]) + ("\n" if i % 3 else "  \t") + " ".join(w[cut:])
        if i % 5 == 2:
            text += f"\n  {line} \n" + line.upper() + "\n" + line
        rows.append((i, text, rng.choice(["en", "de", None]), rng.choice(["a", "b", "é", None]), len(text)))
    rows += [
        (1000, None, "en", "a", None),
        (1001, "", "en", "a", 0),
        (1002, " \n\t\r\n ", None, None, 5),
        (1003, "one", "de", "b", 3),
        (1004, "one two", "de", "b", 7),
        (1005, "one two", "de", "b", 7),
        (1006, "ONE\x0bTWO", "de", "b", 7),
        (1007, "1234 5678", "en", "c", 9),
        (1008, " ".join(speak(12_000)), "en", "a", 1),
        (None, rows[1][1], "en", None, 1),
        (None, "no id at all " * 10, "en", None, 1),
        (-5, rows[2][1], None, "a", 2),
        rows[5],
        rows[5],
        (7, "another text of a repeated id", "en", "b", 1),
    ]
    return [(*r, 3, "x", 4) for r in rows]


def jaccard_components(docs, n, percent):
    """Counter of (doc_id, n_shingles, component_id)."""
    sets = []
    for d, t, *_ in docs:
        w = words(lower(t))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    ids = defaultdict(list)
    for i, r in enumerate(docs):
        ids[find(i)].append(r[0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return Counter((r[0], len(sets[i]), least[find(i)]) for i, r in enumerate(docs))


def line_dedup(docs, min_chars=20, min_docs=3):
    key = lambda x: lower(x.strip(" \t\n\x0b\x0c\r"))
    rank = lambda d: -(2**63) if d is None else d
    holders = defaultdict(set)
    for d, t, *_ in docs:
        for x in (t or "").split("\n"):
            if len(key(x)) >= min_chars:
                holders[key(x)].add(rank(d))
    out = Counter()
    for d, t, *_ in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(holders.get(key(x), ())) >= min_docs and rank(d) != max(holders[key(x)]))]
        out[d, "\n".join(kept), len(lines), len(lines) - len(kept)] += 1
    return out


def substrings(docs, window):
    rank = lambda d: 2**63 - 1 if d is None else d
    first = {}
    for d, t, *_ in docs:
        w = words(t)
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            first[k] = min(first.get(k, rank(d)), rank(d))
    out = Counter()
    for d, t, *_ in docs:
        w = words(t)
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < rank(d):
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


def held_out(doc_id, modulus):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % modulus == 2


def base_scores(docs):
    """Token counts and base score by row."""
    tokens = [words(lower(t)) + [None] for _, t, *_ in docs]
    count = Counter(x for (d, *_), ts in zip(docs, tokens) if not held_out(d, 7) for x in ts)
    n, v = sum(count.values()), len(count)
    return [
        (d, held_out(d, 7), len(ts), sum(count[x] > 0 for x in ts), n, sum(math.log10((count[x] + 1) / (n + v + 1)) for x in ts))
        for (d, *_), ts in zip(docs, tokens)
    ]


def ppm_scores(docs, order):
    """log10 probability of each row's bytes by a plain trie walk."""
    laid = [[0xFE] * order + list(lower(t).encode()) + [0xFF] for _, t, *_ in docs]
    trie = defaultdict(Counter)
    for (d, *_), s in zip(docs, laid):
        if not held_out(d, 7):
            for i in range(order, len(s)):
                for k in range(order + 1):
                    trie[tuple(s[i - k : i])][s[i]] += 1
    out = []
    for s in laid:
        total = 0.0
        for i in range(order, len(s)):
            hidden: set[int] = set()
            for k in range(order, -1, -1):
                node = trie.get(tuple(s[i - k : i]))
                if not node:
                    continue
                seen = {c: m for c, m in node.items() if c not in hidden}
                if not seen:
                    continue
                size = sum(seen.values()) + len(seen)
                if s[i] in seen:
                    total += math.log10(seen[s[i]] / size)
                    break
                total += math.log10(len(seen) / size)
                hidden |= set(seen)
            else:
                total -= math.log10(max(1, 256 - len(trie[()])))
        out.append(total)
    return out


def merkle(docs, fan=16):
    """Counter of (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), level by level."""
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    field = lambda x: "-" if x is None else f"{len(str(x).encode())}:{x}"
    leaf = lambda d, t: sha("".join(map(field, (d[0], d[3], d[2], d[4], t))))

    def tree(level):
        """Siblings before and after by leaf and level, and the root."""
        paths, scale = [[] for _ in level], 1
        while len(level) > 1:
            for i, p in enumerate(paths):
                at = i // scale
                first = at // fan * fan
                p.append(("".join(level[first:at]), "".join(level[at + 1 : first + fan])))
            level = [sha("".join(level[i : i + fan])) for i in range(0, len(level), fan)]
            scale *= fan
        return paths, level[0] if level else None

    sources = defaultdict(list)
    for d in docs:
        sources[d[3]].append((d[0] is not None, d[0] or 0, leaf(d, d[1]), d))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    inner = {s: tree([x[2] for x in sorted(sources[s], key=lambda x: x[:3])]) for s in names}
    outer, root = tree([inner[s][1] for s in names])
    out = Counter()
    for s, above in zip(names, outer):
        for (_, _, own, d), path in zip(sorted(sources[s], key=lambda x: x[:3]), inner[s][0]):
            path = path + above
            altered = d[0] is not None and zlib.crc32(str(d[0]).encode()) % 5 == 0
            digest = leaf(d, None if d[1] is None else lower(d[1])) if altered else own
            for left, right in path:
                digest = sha(left + digest + right)
            out[d[0], own, inner[s][1], root, sha("".join(a + b for a, b in path)), digest, digest == root] += 1
    return out


def ranked(docs, items, k=10):
    """Counter of (item_id, rank, doc_id, score)."""
    terms = lambda x: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(x))
    held = [(d[0], Counter(terms(d[1]))) for d in docs]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    n, total = len(held), sum(x for _, _, x in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = Counter()
    for item, text in items:
        asked = terms(text)
        found = []
        for d, c, size in held:
            m = 25 + 75 * size * n // total
            weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in set(asked) if t in c}
            score = sum(weight[t] * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in asked if t in c)
            if score > 0:
                found.append((-score, d is None, d or 0))
        for rank, (score, none, d) in enumerate(sorted(found)[:k], 1):
            out[item, rank, None if none else d, -score] += 1
    return out


def near_vectors(vectors, threshold):
    """Counter of (vec_id, n_links, component_id, kept)."""
    good = []
    for i, e, label in vectors:
        fine = e is not None and label is not None and all(x is not None and math.isfinite(x) for x in e) and any(e or [])
        norm = math.sqrt(sum(x * x for x in e)) if fine else 1
        good.append([x / norm for x in e] if fine else None)
    links = defaultdict(set)
    for i, a in enumerate(good):
        for j in range(i):
            b = good[j]
            if a and b and len(a) == len(b) and vectors[i][2] == vectors[j][2] and sum(x * y for x, y in zip(a, b)) >= threshold:
                links[i].add(j)
                links[j].add(i)
    out, seen = Counter(), set()
    for i in range(len(vectors)):
        if i in seen:
            continue
        group, todo = {i}, [i]
        while todo:
            more = links[todo.pop()] - group
            group |= more
            todo += more
        seen |= group
        least = min((vectors[x][0] for x in group if vectors[x][0] is not None), default=None)
        for x in group:
            out[vectors[x][0], len(links[x]), least, vectors[x][0] == least] += 1
    return out

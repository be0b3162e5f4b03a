"""Plain versions of the operators, over rows in lists, and small inputs with the awkward cases."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import xxhash

from ferry.llm.secrets import ALLOWED, BASE, CLASSES, WINDOW

WORDS = re.compile(r"[^\x20\x09-\x0D]+")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, component_id string, keep_id string, size string, id string"
LONG = " ".join(f"word{i % 977} secret{i}" for i in range(30_000))
TEXTS = [
    None, "", " \t\n", "one", "one two", "one  two", "one\ttwo", "One Two", "alpha beta gamma delta", "alpha  beta\ngamma delta",
    "alpha beta gamma delta", "alpha beta gamma epsilon", LONG, LONG, LONG + " more", "é ü 漢字 😀 text", "é ü 漢字 😀 text ",
    "no break space here", "x" * 5000, "a b c " * 2000, "a b c " * 2000 + "d",
]


def documents(spark, texts=TEXTS, sources=("s2", None, "s1"), ids=None):
    """Rows with null columns, repeated rows and columns whose names the operators use inside."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, None, sources[k % len(sources)], None, "x", None, "y", "z", "q") for k, (i, t) in enumerate(zip(ids, texts))]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def words(text):
    return WORDS.findall(text or "")


def simhash(text, shingle=3):
    found = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    parts = [" ".join(found[i : i + shingle]) for i in range(len(found) - shingle + 1)] or ([" ".join(found)] if found else [])
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def groups(fps, radius=3):
    """The smallest index each fingerprint reaches."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(fps))]


def exact(rows):
    """(doc_id, text) rows to (doc_id, keep_id, group_size, kept, text_sha256)."""
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in rows]
    by = defaultdict(list)
    for i, t in norm:
        by[t].append(i)
    least = {t: min((i for i in ids if i is not None), default=None) for t, ids in by.items()}
    return sorted(((i, least[t], len(by[t]), i == least[t], hashlib.sha256(t.encode()).hexdigest()) for i, t in norm), key=repr)


def base_spans(text):
    text = text or ""
    return [(m.start(), m.end(), kind) for kind, (pattern, group, least) in BASE.items() for m in re.finditer(pattern, text) if len(m[group]) >= least]


def entropy_spans(text):
    """Every window on its own, in floating point."""
    found = []
    for kind, (chars, _, bits) in CLASSES.items():
        for m in re.finditer(f"{chars}{{{WINDOW},}}", text or ""):
            if any(re.fullmatch(a, m[0], re.S) for a in ALLOWED):
                continue
            spans = []
            for at in range(m.start(), m.end() - WINDOW + 1):
                counts = Counter(text[at : at + WINDOW]).values()
                if -sum(c / WINDOW * math.log2(c / WINDOW) for c in counts) >= bits - 1e-9:
                    if spans and spans[-1][1] >= at:
                        spans[-1] = (spans[-1][0], at + WINDOW, kind)
                    else:
                        spans.append((at, at + WINDOW, kind))
            found += spans
    return found


def joined(spans):
    order = [*BASE, *CLASSES]
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], order.index(s[2]), s[1])))


def without_repeats(rows, depth=20):
    """(doc_id, text) rows, identifiers distinct, null last: doc_id to (words, kept words)."""
    seen, found = set(), {}
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        w = words(text)
        covered = [False] * len(w)
        for p in range(len(w) - depth + 1):
            key = tuple(w[p : p + depth])
            if key in seen:
                covered[p : p + depth] = [True] * depth
            seen.add(key)
        found[i] = (w, [x for x, c in zip(w, covered) if not c])
    return found


def best_path(text, pieces, unknown):
    """The best sum of scores over all ways to cut a text, by trying every piece at every place."""
    best = [0.0] + [float("-inf")] * len(text)
    for i in range(len(text)):
        for j in range(i + 1, len(text) + 1):
            if text[i:j] in pieces:
                best[j] = max(best[j], best[i] + pieces[text[i:j]])
        if text[i] not in pieces:
            best[i + 1] = max(best[i + 1], best[i] + unknown)
    return best[-1]

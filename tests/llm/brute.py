"""Plain versions of the operators, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def contamination(docs, items, window=13):
    grams = defaultdict(set)
    for item, text in items:
        ws = ALNUM.findall(lower(text)) if item is not None else []
        n = min(window, len(ws))
        for i in range(len(ws) - n + 1 if ws else 0):
            grams[tuple(ws[i:i + n])].add(str(item))
    sizes = {len(g) for g in grams}
    out = []
    for doc, text in docs:
        ws, hit, met = ALNUM.findall(lower(text)), set(), set()
        for n in sizes:
            for i in range(len(ws) - n + 1):
                if found := grams.get(tuple(ws[i:i + n])):
                    hit |= set(range(i, i + n))
                    met |= found
        out.append((doc, len(ws), len(hit), sorted(met)))
    return out


def shingles(text, n):
    ws = SPACED.findall(lower(text))
    return {tuple(ws[i:i + n]) for i in range(max(1, len(ws) - n + 1))} if ws else set()


def groups(docs, n=3, num=90, den=100):
    """(doc_id, set size, component) with union-find over all pairs that share a shingle."""
    sets = [shingles(t, n) for _, t in docs]
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        shared = Counter(j for g in s for j in holders[g])
        for g in s:
            holders[g].append(i)
        for j, k in shared.items():
            if k * den >= num * (len(s) + len(sets[j]) - k):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [(d, len(sets[i]), least.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(docs)]


def substrings(docs, window=20):
    """(doc_id, words, removed, kept)."""
    first = {}
    rank = lambda d: -1 if d is None else d
    for d, t in docs:
        ws = SPACED.findall(t or "")
        for i in range(len(ws) - window + 1):
            g = tuple(ws[i:i + window])
            first[g] = min(first.get(g, (rank(d), i)), (rank(d), i))
    out = []
    for d, t in docs:
        ws = SPACED.findall(t or "")
        gone = set()
        for i in range(len(ws) - window + 1):
            if first[tuple(ws[i:i + window])] < (rank(d), i):
                gone |= set(range(i, i + window))
        out.append((d, len(ws), len(gone), " ".join(w for i, w in enumerate(ws) if i not in gone)))
    return out


def lines(docs, min_chars=20, min_docs=3):
    """(doc_id, lines, dropped, kept)."""
    key = lambda x: lower(x).strip(" \t\n\x0b\f\r")
    rank = lambda d: -1 if d is None else d
    holders = defaultdict(list)
    for d, t in docs:
        for k in {key(x) for x in (t or "").split("\n")}:
            holders[k].append(rank(d))
    out = []
    for d, t in docs:
        ls = (t or "").split("\n")
        kept = [x for x in ls if not (len(key(x)) >= min_chars and len(holders[key(x)]) >= min_docs
                                      and rank(d) < max(holders[key(x)]))]
        out.append((d, len(ls), len(ls) - len(kept), "\n".join(kept)))
    return out


def phrases(text):
    """(words, sorted (start, label)) of the base phrases."""
    ws = ALNUM.findall(lower(text))
    found = []
    for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")):
        p = phrase.split()
        found += [(i, label) for i in range(len(ws)) if ws[i:i + len(p)] == p]
    return len(ws), sorted(found)


def repeat_words(ws, n=8):
    count = Counter(tuple(ws[i:i + n]) for i in range(len(ws) - n + 1))
    hit = set()
    for i in range(len(ws) - n + 1):
        if count[tuple(ws[i:i + n])] > 1:
            hit |= set(range(i, i + n))
    return len(hit)

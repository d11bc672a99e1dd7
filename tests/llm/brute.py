"""Plain versions of the operators, for small inputs."""

import hashlib
import itertools
import math
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def quality(text):
    w = words(text)
    windows = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
    times = Counter(windows)
    covered = {k + j for k, x in enumerate(windows) if times[x] > 1 for j in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), failed


def shingles(text):
    w = words(text)
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def near_classes(texts, threshold=0.8):
    """Least index of each text's class; texts with the same words are one class."""
    sets = [shingles(t) for t in texts]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    common = Counter(p for held in holders.values() for p in itertools.combinations(held, 2))
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    def join(a, b):
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)

    same = {}
    for i, t in enumerate(texts):
        join(i, same.setdefault(tuple(words(t)), i))
    for (a, b), n in common.items():
        if n / (len(sets[a]) + len(sets[b]) - n) >= threshold:
            join(a, b)
    return [root(i) for i in range(len(texts))]


def url_scores(texts, good, bad, order=5):
    """Each text's score by exact counts in plain dictionaries."""

    def places(text):
        b = text.encode()
        return [[((None,) * order + tuple(b))[k + order - j : k + order + 1] for j in range(order)] for k in range(len(b))]

    def model(of):
        times, followers = Counter(), defaultdict(Counter)
        for text in of:
            for grams in places(text):
                for gram in grams:
                    times[gram] += 1
                    followers[len(gram), gram[:-1]][gram[-1]] += 1
        return times, followers

    def chance(grams, times, followers):
        p = 1 / 256
        for gram in grams:
            seen = followers.get((len(gram), gram[:-1]))
            if seen:
                p = (times[gram] + len(seen) * p) / (seen.total() + len(seen))
        return p

    models = model(bad), model(good)
    logs = [[math.log(chance(g, *models[1])) - math.log(chance(g, *models[0])) for g in places(t)] for t in texts]
    return [sum(x) / max(1, len(x)) for x in logs]


def remove_repeats(texts, match):
    data = [(t or "").encode() for t in texts]
    times = Counter(b[k : k + match] for b in data for k in range(len(b) - match + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for k in range(len(b) - match + 1):
            if times[b[k : k + match]] > 1:
                gone[k : k + match] = b"\1" * match
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def sainte_lague(weights, seats):
    q = [0] * len(weights)
    for _ in range(seats):
        best = max(range(len(weights)), key=lambda i: (weights[i] / (2 * q[i] + 1), -i))
        q[best] += 1
    return q


def best_fit(lengths, capacity):
    """How many sequences best-fit decreasing takes."""
    rooms = Counter()
    for x in sorted(lengths, reverse=True):
        room = min((r for r in rooms if r >= x and rooms[r]), default=None)
        if room is None:
            rooms[capacity - x] += 1
        else:
            rooms[room] -= 1
            rooms[room - x] += 1
    return rooms.total()

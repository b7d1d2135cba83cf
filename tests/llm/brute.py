"""Plain versions of the operators, for small inputs."""

import collections
import hashlib
import re


def words(text):
    return re.findall(r"\w+", (text or "").lower())


def shingles(text, n=5):
    w = words(text)
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def classes(rows, threshold=0.8):
    """doc_id -> (class_id, links) of (doc_id, text) rows with different ids."""
    sets = {i: shingles(t) for i, t in rows}
    parent, links = {i: i for i in sets}, collections.Counter()

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            a, b = sets[i], sets[j]
            if a and b and len(a & b) / len(a | b) >= threshold:
                links[i] += 1
                links[j] += 1
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: (find(i), links[i]) for i in sets}


def cut_repeats(texts, length):
    """For each text (bytes): bytes, removed, runs, hash of the rest, the rest."""
    seen = collections.Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        runs = sum(g and (not i or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest(), kept))
    return out


def contained(docs, items, threshold=0.8):
    sets = {i: shingles(t) for i, t in items}
    out = set()
    for d, t in docs:
        own = shingles(t)
        out |= {(d, i, len(own & s)) for i, s in sets.items() if s and len(own & s) / len(s) >= threshold}
    return out


def sentences(text, long=25):
    """[start, words] of each sentence."""
    bounds = [m.end() for m in re.finditer(r"[.!?](?=\s|$)|\n", text)]
    out, now = [], None
    for m in re.finditer(r"\w+", text):
        k = sum(b <= m.start() for b in bounds)
        if k != now or len(out[-1][1]) == long:
            out.append([m.start(), []])
            now = k
        out[-1][1].append(m.group(0).lower())
    return out


def cut_spans(rows, run=2, least=12):
    """Texts of (doc_id, text) rows, in order, without spans that occurred before."""
    seen, out = set(), {}
    for d, text in rows:
        found, gone = sentences(text or ""), [False] * len(text or "")
        for i in range(len(found) - run + 1):
            key = tuple(w for s in found[i:i + run] for w in s[1])
            end = found[i + run][0] if i + run < len(found) else len(text)
            if len(key) >= least:
                if key in seen:
                    gone[found[i][0]:end] = [True] * (end - found[i][0])
                seen.add(key)
        out[d] = text if text is None else "".join(c for c, g in zip(text, gone) if not g)
    return out


STOPS = "[.!?\u2026\u203c\u203d\u2047-\u2049\u061f\u06d4\u0700-\u0702\u0589\u1362\u1367\u1368]"
FULL_STOPS = "[\u3002\uff0e\uff01\uff1f\uff61\u0964\u0965\u104a\u104b\u17d4\u17d5\u0f0d\u0f0e\u1803\u1809\n]"
ALONE = "[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u4e00-\u9fff]"


def spans_of(text, rank, run=2, least=12, long=25):
    """(words, begin, end) of all spans of a text: sentences from each one on, and
    ``long`` words from each that ranks lowest of some ``long`` words in a row."""
    found = [m for m in re.finditer(rf"(?={ALONE})\w|(?:(?!{ALONE})\w)+", text)]
    words_, starts = [m.group(0).lower() for m in found], [m.start() for m in found]
    firsts = [i for i, m in enumerate(found) if not i or re.search(
        rf"{STOPS}.*\s|{FULL_STOPS}", text[starts[i - 1]:m.start()], re.S)]
    cuts = [*firsts, len(found)]
    ranges = set()
    for k, i in enumerate(firsts):
        for j in range(k + run, len(cuts)):
            if cuts[j] - i >= least:
                ranges.add((i, cuts[j]))
                break
    ranks = [(rank(w), i) for i, w in enumerate(words_)]
    for i in range(len(found) - long + 1):
        p = min(ranks[i:i + long])[1]
        if p + long <= len(found):
            ranges.add((p, p + long))
    return [(tuple(words_[i:j]), starts[i], starts[j] if j < len(found) else len(text)) for i, j in sorted(ranges)]


def cut_passages(rows, rank):
    """Texts of (doc_id, text) rows, in order of different ids, without spans that
    occurred before."""
    first, out = {}, {}
    for d, text in rows:
        gone = [False] * len(text or "")
        for key, begin, end in sorted(spans_of(text or "", rank), key=lambda s: s[1]):
            if first.setdefault(key, (d, begin)) != (d, begin):
                gone[begin:end] = [True] * (end - begin)
        out[d] = text if text is None else "".join(c for c, g in zip(text, gone) if not g)
    return out

"""Plain restatements of the operators' contracts, for small inputs."""

import hashlib
import re
import zlib
from collections import defaultdict
from functools import cache

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall(text or "")


def components(docs, k=5, percent=75):
    """docs: [(key, text)] -> {key: (set size, smallest key reachable)}."""
    sets = {}
    for i, t in docs:
        w = words((t or "").translate(LOW))
        sets[i] = {tuple(w[a : a + k]) for a in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    low = {i: i for i in sets}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    keys = list(sets)
    for n, i in enumerate(keys):
        for j in keys[n + 1 :]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                p, q = find(i), find(j)
                low[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in keys}


def substring_dedup(docs, width=20):
    """docs: [(doc_id, text)] in order -> {doc_id: (n_words, n_removed, sha256 of kept words)}."""
    seen, out = set(), {}
    for i, t in docs:
        w = words(t)
        gone = [False] * len(w)
        for s in range(len(w) - width + 1):
            key = tuple(w[s : s + width])
            if key in seen:
                gone[s : s + width] = [True] * width
            seen.add(key)
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def quality_counts(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    t = text or ""
    w = words(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    at = defaultdict(list)
    for s in range(len(w) - 7):
        at[tuple(w[s : s + 8])].append(s)
    cover = {x for v in at.values() if len(v) > 1 for s in v for x in range(s, s + 8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(cover)


def base_failed(counts):
    return counts[0] < 20 or 100 * counts[4] > 30 * counts[0]


PHRASES = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")]


def license_places(text):
    """(n_words, n_base, first_word, last_word, base_labels)."""
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))
    at, labels = [], set()
    for phrase, label in PHRASES:
        p = phrase.split()
        for i in range(len(w)):
            if w[i : i + len(p)] == p:
                at.append(i)
                labels.add(label)
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def judge_url(url, rules):
    """(host, path, rule, verdict) with rules [(host, path, verdict)]."""
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].translate(LOW), m[2]) if m else ("", "")
    fit = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *max(fit)[3:]) if fit else (host, path, None, "allow")


def shares(sizes, weights, budget, most):
    """Targets by weight, each at most ``most`` times its size, the excess shared again."""
    open_, full = dict(weights), {}
    while open_:
        level = (budget - sum(full.values())) / sum(open_.values())
        over = [s for s, w in open_.items() if w * level > most * sizes[s]]
        if not over:
            return full | {s: w * level for s, w in open_.items()}
        for s in over:
            full[s] = float(most * sizes[s])
            del open_[s]
    return full


def crc_remainder(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def repair_conversation(rows):
    """rows: [(turn, role, text)] after damage, in order -> the report's values, and the repaired turns.

    Built from the last turn to the first, on (cost, audit) pairs.
    """
    todo, seen, counts = [], set(), {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        shown = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        todo.append((role[:1], fault))

    def after(state, initial):
        """What stands last once a turn of this initial follows; None if it cannot."""
        allowed = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        return initial if initial and initial in allowed else None

    @cache
    def best(i, state, inserted):
        ways = []
        if i == len(todo) and state in ("", "a"):
            ways.append((0, "", ()))
        if i < len(todo):
            initial, fault = todo[i]
            role, text = rows[i][1:]
            c, audit, turns = best(i + 1, state, 0)
            ways.append((c + 2, "D" + audit, turns))
            if fault not in ("blank", "duplicate"):
                more = 5 if fault else 0
                for to, cost, letter, given in [(after(state, initial), 0, "K", role), (after(state, "u"), 1, "R", "user"), (after(state, "a"), 1, "R", "assistant")]:
                    if to:
                        c, audit, turns = best(i + 1, to, 0)
                        ways.append((c + cost + more, letter + audit, ((given, text), *turns)))
        if inserted < 2:
            for to, given in (("u", "user"), ("a", "assistant")):
                if after(state, to):
                    c, audit, turns = best(i, to, inserted + 1)
                    ways.append((c + 5, "I" + audit, ((given, ""), *turns)))
        return min(ways, key=lambda w: w[:2], default=(float("inf"), "", ()))

    cost, audit, turns = best(0, "", 0)
    numbers = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    out = {
        "gaps": max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
        **counts,
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        "cost": cost,
        "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest(),
    }
    return out, list(turns)


def hard_negatives(rows, anchors, k=5, n=5, low=80, high=100):
    """rows: {vec_id: (label, integer vector)} -> sorted rows of the operator."""
    out = []
    for a in anchors:
        label, x = rows[a]
        scored = sorted((-sum(p * q for p, q in zip(x, y)), v, other) for v, (other, y) in rows.items() if v != a and len(x) == len(y))
        for score, positive, _ in [s for s in scored if s[2] == label][:k]:
            fit = [(v, -s) for s, v, other in scored if other != label and low * -score <= 100 * -s <= high * -score]
            out += [(a, positive, r + 1, v, -score, s) for r, (v, s) in enumerate(fit[:n])]
    return sorted(out)


def suffix_dedup(docs, width=50):
    """docs: [(doc_id, text)]; doc_id None stands last -> sorted [(doc_id, bytes, removed, spans, kept bytes)]."""
    order = lambda i: (i is None, i or 0)
    first = {}
    for i, t in docs:
        b = (t or "").encode()
        for s in range(len(b) - width + 1):
            k = b[s : s + width]
            first[k] = min(first.get(k, order(i)), order(i))
    out = []
    for i, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - width + 1):
            if first[b[s : s + width]] < order(i):
                gone[s : s + width] = b"\1" * width
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((i, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=lambda r: (order(r[0]), r[1:]))

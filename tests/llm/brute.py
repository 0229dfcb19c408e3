"""Plain versions of the operators, for small inputs."""
import hashlib
import math
from collections import Counter, defaultdict

import xxhash

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def cross_entropy(text, sample):
    """Bits per character by greedy longest matches, restarting every 1,024 characters."""
    text = " ".join(text.lower().split())
    known, phrases = set(sample), 0
    for at in range(0, len(text), 1024):
        part, i = text[at:at + 1024], 0
        while i < len(part):
            n = 1
            if part[i] in known:
                while i + n < len(part) and part[i:i + n + 1] in sample:
                    n += 1
            i, phrases = i + n, phrases + 1
    return phrases * math.log2(len(sample) + 2) / max(1, len(text))


def plain_mask(line):
    """Tokens (cut at space and \\x09-\\x0D) joined by a space, those with a digit 0-9 as <*>."""
    tokens, run = [], ""
    for ch in line + " ":
        if ch in " \t\n\x0b\x0c\r":
            tokens += [run] if run else []
            run = ""
        else:
            run += ch
    return " ".join("<*>" if any(c in "0123456789" for c in t) else t for t in tokens), " ".join(tokens)


def line_dedup(rows, min_docs, depth=3, similarity=0.6, exact_docs=None):
    """Texts of (doc_id, text) rows without recurring lines: majority templates, templates of supported tokens, and lines
    that are the same in every token (from exact_docs texts on)."""
    apart = exact_docs is not None and exact_docs < min_docs  # lines with a variable are counted unmasked, too
    exact_docs = exact_docs or min_docs
    first_id = {}
    for d, t in rows:
        d = (1 << 63) - 1 if d is None else d
        first_id[t or ""] = min(first_id.get(t or "", d), d)
    n, low, leaf, literal, low_literal = Counter(), {}, defaultdict(set), Counter(), {}
    for t, d in first_id.items():
        forms = {plain_mask(x) for x in t.split("\n")} - {("", "")}
        for m in {m for m, _ in forms}:
            n[m] += 1
            low[m] = min(low.get(m, d), d)
            tokens = m.split(" ")
            leaf[len(tokens), tuple(tokens[:depth])].add(m)
        for x in {x for m, x in forms if "<*>" in m}:
            literal[x] += 1
            low_literal[x] = min(low_literal.get(x, d), d)
    rec = {m: low[m] for m in n if n[m] >= (min_docs if "<*>" in m else exact_docs)}
    same = {x: low_literal[x] for x in literal if literal[x] >= exact_docs} if apart else {}
    for (size, _), held in leaf.items():
        total = sum(n[m] for m in held)
        need = max(math.ceil(similarity * size) - depth, math.ceil((size - depth) / 2))
        if len(held) < 2 or total < min_docs or size <= depth:
            continue
        votes = Counter()
        for m in held:
            for i, tok in enumerate(m.split(" ")[depth:]):
                votes[i, tok] += n[m]
        groups = defaultdict(list)
        for m in held:
            tail = list(enumerate(m.split(" ")[depth:]))
            if sum(votes[v] * 2 > total for v in tail) >= need:
                groups["majority"].append(m)
            best = sorted((-votes[v], v) for v in tail if votes[v] >= min_docs)[:need]
            if len(best) == need:
                groups[tuple(best)].append(m)
        for members in groups.values():
            if sum(n[m] for m in members) >= min_docs:
                first = min(low[m] for m in members)
                for m in members:
                    rec[m] = min(rec.get(m, first), first)
    out = []
    for d, t in rows:
        own = first_id[t or ""]
        gone = lambda m, x: rec.get(m, own) != own or same.get(x, own) != own
        out.append((d, t if t is None else "\n".join(x for x in t.split("\n") if not gone(*plain_mask(x)))))
    return out


def fingerprint(text, shingle=3):
    ws = (text or "").encode().translate(LOWER).split()
    if not ws:
        return 0
    grams = [b" ".join(ws[i:i + shingle]) for i in range(max(1, len(ws) - shingle + 1))]
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(fps, bits=3):
    """root by fingerprint (smallest member's index decides nothing: roots are sets)."""
    fps, seen, out = list(dict.fromkeys(fps)), set(), {}
    for f in fps:
        if f in seen:
            continue
        group, front = {f}, [f]
        while front:
            x = front.pop()
            for y in fps:
                if y not in group and (x ^ y).bit_count() <= bits:
                    group.add(y)
                    front.append(y)
        seen |= group
        out.update(dict.fromkeys(group, frozenset(group)))
    return out


def alnum(text):
    import re
    low = (text or "").encode().translate(LOWER).decode()
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def hits(text, items, window=10):
    """(set of hit word places, ids of items with a window in the text)."""
    ws, places, ids = alnum(text), set(), set()
    for item, said in items:
        it = alnum(said)
        n = min(window, len(it))
        for a in range(len(it) - n + 1 if it else 0):
            for p in range(len(ws) - n + 1):
                if ws[p:p + n] == it[a:a + n]:
                    places.update(range(p, p + n))
                    ids.add(item)
    return places, ids


def sha(data):
    return hashlib.sha256(data).hexdigest()

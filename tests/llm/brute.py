"""Plain versions of what the operators compute, for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(k): chr(k + 32) for k in range(65, 91)})


def words(text):
    return WORD.findall(text or "")


def shingles(text, size):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def components(docs, size, num, den):
    """{doc_id: (n_shingles, smallest doc_id reachable)}."""
    sets = {d: shingles(t, size) for d, t in docs}
    root = {d: d for d in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    index = defaultdict(list)
    for d, s in sets.items():
        for g in s:
            index[g].append(d)
    for d, s in sets.items():
        same = Counter(o for g in s for o in index[g] if o < d)
        for o, n in same.items():
            if den * n >= num * (len(s) + len(sets[o]) - n):
                a, b = top(d), top(o)
                root[max(a, b)] = min(a, b)
    return {d: (len(s), top(d)) for d, s in sets.items()}


def statistics(text):
    w = words(text)
    grams = defaultdict(list)
    for i in range(len(w) - 2):
        grams[tuple(w[i : i + 3])].append(i)
    lines = [x for x in (text or "").split("\n") if words(x)]
    repeated = {i + k for at in grams.values() if len(at) > 1 for i in at for k in range(3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated))


def base_spans(text):
    t, out = text or "", []
    for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.ASCII):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 32]
    return sorted(out)


def entropy_spans(text, candidate, allowed, classes, window):
    out = []
    for m in re.finditer(candidate, text or ""):
        s = m[0]
        if any(re.search(a, s) for a in allowed):
            continue
        for c in classes:
            if re.search(c.member, s):
                runs = []
                for i in range(len(s) - window + 1):
                    n = Counter(x if x in c.symbols else "" for x in s[i : i + window])
                    if math.log2(window) - sum(k * math.log2(k) for k in n.values()) / window >= c.bits:
                        if runs and runs[-1][1] >= i:
                            runs[-1][1] = i + window
                        else:
                            runs.append([i, i + window])
                out += [(m.start() + a, 3, m.start() + b) for a, b in runs]
                break
    return out


def written(spans, kinds=("assign", "access", "hex", "entropy")):
    return ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in sorted(spans))


def leaks(docs, items, needed, stretch):
    """{doc_id: set of items}: all alignments of each item are slid along each document, without masks or seeds."""
    found = defaultdict(set)
    low = lambda t: [x.lower() for x in words(t)]
    texts = {i: low(t) for i, t in items}
    where = defaultdict(list)
    for i, w in texts.items():
        for a, x in enumerate(w):
            where[x].append((i, a))
    for d, t in docs:
        equal = defaultdict(list)
        for p, x in enumerate(low(t)):
            for i, a in where.get(x, ()):
                equal[i, p - a].append(a)
        for (i, _), at in equal.items():
            n = len(texts[i])
            if len(at) < needed(n):
                continue
            k = 0
            for j, a in enumerate(at):
                while a - at[k] >= stretch:
                    k += 1
                if j - k + 1 >= needed(n):
                    found[d].add(i)
                    break
    return found


def window_repeats(docs, size=20):
    """{doc_id: (n_words, n_removed, sha of the kept words)} for windows that also start earlier."""
    first, out = {}, {}
    rows = sorted(docs)
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - size + 1):
            first.setdefault(tuple(w[i : i + size]), (d, i))
    for d, t in rows:
        w = words(t)
        gone = {i + k for i in range(len(w) - size + 1) if first[tuple(w[i : i + size])] < (d, i) for k in range(size)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[d] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def byte_repeats(docs, size=200):
    """{doc_id: (n_bytes, n_removed, n_spans, sha of what is left)} for strings that also start anywhere else."""
    seen, out = Counter(), {}
    data = {d: (t or "").encode() for d, t in docs}
    for b in data.values():
        seen.update(b[i : i + size] for i in range(len(b) - size + 1))
    for d, b in data.items():
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if seen[b[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[d] = (len(b), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    return out


def vocabulary(docs):
    """{word: n} of the spelling operator."""
    n = Counter()
    for d, t in docs:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def near(a, b):
    """Whether one code point inserted, deleted or replaced turns ``a`` into ``b``."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i + 1 :] == b[i:] if len(a) > len(b) else a[i:] == b[i + 1 :]


def spelling(n):
    """Rows (word, form, root, n, n_near, form_n) from {word: n}, by the places where words lose a code point."""
    lost = defaultdict(set)
    for w in n:
        for k in range(len(w) + 1):
            lost[w[:k] + w[k + 1 :]].add(w)
        lost[w].add(w)
    found = {w: {v for k in range(len(w) + 1) for v in lost[w[:k] + w[k + 1 :]] | lost[w] if near(w, v)} for w in n}
    form = {}
    for w, them in found.items():
        best = min(them, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(found[w]), form[w] and n[form[w]]))
    return sorted(out)

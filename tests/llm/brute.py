"""Plain versions of the operators, for small inputs."""

import hashlib
import re
import zlib

SF = "/root/testdata/sf0.001"
TO_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(TO_LOWER))


def lettered(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(TO_LOWER))


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def crc(doc_id, modulus):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % modulus


def windows(items):
    out = {}
    for item_id, text in items:
        words = lettered(text)
        for i in range(max(0, len(words) - 13) + 1 if words else 0):
            out.setdefault(tuple(words[i:i + 13]), set()).add(item_id)
    return out


def contamination(text, found):
    words, hit, ids = lettered(text), set(), set()
    for n in {len(w) for w in found}:
        for i in range(len(words) - n + 1):
            if owners := found.get(tuple(words[i:i + n])):
                hit.update(range(i, i + n))
                ids |= owners
    ids = sorted(str(i) for i in ids if i is not None)
    return len(words), len(hit), ids, bool(hit) and 20 * len(hit) >= len(words)


def shingles(text, q=5):
    words = spaced(text)
    return frozenset(tuple(words[i:i + q]) for i in range(max(1, len(words) - q + 1))) if words else frozenset()


def groups(texts, percent=75):
    """Component number of every row."""
    sets, parent = [shingles(t) for _, t in texts], list(range(len(texts)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    parent[top(i)] = top(j)
    return sets, [top(i) for i in range(len(texts))]


def without_repeats(texts, size=100):
    """(length, removed, runs, hash of the rest) by (id, text); rows repeated in full are one document."""
    seen, out = set(), {}
    for key in sorted({(-1 if i is None else i, (t or "").encode(), i, t) for i, t in texts}, key=lambda k: (k[0], k[1])):
        data = key[1]
        mark = bytearray(len(data))
        for i in range(len(data) - size + 1):
            if data[i:i + size] in seen:
                mark[i:i + size] = b"\1" * size
            seen.add(data[i:i + size])
        runs = sum(1 for i, m in enumerate(mark) if m and not (i and mark[i - 1]))
        out[key[2:]] = (len(data), sum(mark), runs, sha(bytes(b for b, m in zip(data, mark) if not m)))
    return out


SECRETS = (
    (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 8),
    (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16), (r"[0-9a-f]+", lambda m: len(m[0]) >= 32))


def secrets(text):
    found = sorted((m.start(), k, m.end()) for k, (pattern, holds) in enumerate(SECRETS)
                   for m in re.finditer(pattern, text or "", re.ASCII) if holds(m))
    kinds = ("assign", "access", "hex")
    return [sum(k == i for _, k, _ in found) for i in range(3)], sha(",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in found))

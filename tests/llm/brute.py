"""Plain versions of the operators that SQL cannot express, for small tables. Rows are (doc_id, text)."""

import hashlib
import re

import xxhash


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def repeats(rows, length=100):
    """doc_id -> (n_bytes, n_removed, n_spans, kept_sha256); ids are unique."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            window = data[i : i + length]
            if window in seen:
                gone[i : i + length] = b"\x01" * length
            seen.add(window)
        spans = sum(1 for i in range(len(gone)) if gone[i] and not (i and gone[i - 1]))
        out[doc_id] = (len(data), sum(gone), spans, sha(bytes(b for b, g in zip(data, gone) if not g)))
    return out


def simhash(text, words=4):
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return 0
    shingles = [b" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(rows, max_bits=4, words=4):
    """doc_id -> (fingerprint, component)."""
    prints = [(doc_id, simhash(text, words)) for doc_id, text in rows]
    distinct = sorted({f for _, f in prints})
    parent = {f: f for f in distinct}

    def find(f):
        while parent[f] != f:
            parent[f] = parent[parent[f]]
            f = parent[f]
        return f

    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= max_bits:
                parent[find(a)] = find(b)
    low = {}
    for doc_id, f in prints:
        root = find(f)
        low[root] = min(low.get(root, doc_id), doc_id)
    return {doc_id: (f"{f:016x}", low[find(f)]) for doc_id, f in prints}


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def personal(text):
    """[(start, kind number, end)] of the base definitions."""
    out = []
    for kind, pattern in enumerate((
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
    )):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub(r"[^0-9]", "", m.group())
            if kind == 1 and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == 2 and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), kind, m.end()))
    return sorted(out)


def targets(sizes, weights=(1, 2, 3), most=3):
    """source -> target, from source -> size."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    capped, total = {}, sum(sizes.values())
    while True:
        free = [s for s in order if s not in capped]
        if not free:
            return capped
        level = (total - sum(capped.values())) / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * level > most * sizes[s]]
        if not over:
            return capped | {s: weight[s] * level for s in free}
        capped |= {s: most * sizes[s] for s in over}

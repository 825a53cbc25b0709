"""Plain single-machine forms of the operators, written from their contracts."""

import hashlib
import re
import zlib

import xxhash


def components(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def fingerprint(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash(docs, radius=2):
    """docs: (doc_id, text) -> {doc_id: (hex, component)}"""
    fp = {d: fingerprint(t) for d, t in docs}
    distinct = sorted(set(fp.values()))
    near = [(a, b) for i, a in enumerate(distinct) for b in distinct[:i] if (a ^ b).bit_count() <= radius]
    comp = components(distinct, near)
    least = {}
    for d, f in fp.items():
        least[comp[f]] = min(d, least.get(comp[f], d))
    return {d: (f"{f:016x}", least[comp[f]]) for d, f in fp.items()}


ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def secrets(text):
    """The base spans of a text: (start, kind number, end)."""
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def spelled(spans):
    return ",".join(f"{('assign', 'access', 'hex', 'secret', 'endpoint')[k]}:{s}:{e}" for s, k, e in spans)


def linked(text, reach=200):
    """All spans: the base and the weak candidates that complementary parts confirm."""
    base = secrets(text)
    near = lambda a, b, gap: a[0] <= b[2] + gap and a[2] >= b[0] - gap
    access = [s for s in base if s[1] == 1]
    weak = [(m.start(), 3, m.end()) for m in re.finditer("[A-Za-z0-9+/]{32,}", text or "")
            if all(re.search(c, m[0]) for c in ("[A-Z]", "[a-z]", "[0-9]")) and not m[0].startswith("AKIA")]
    weak = [w for w in weak if not any(near(w, b, -1) for b in base if b[1] < 2) and any(near(w, a, reach) for a in access)]
    sure = weak + [b for b in base if b[1] == 0]
    ends = [(m.start(), 4, m.end()) for m in re.finditer("[a-z][a-z0-9+]*://[A-Za-z0-9.:_/@-]+", text or "")]
    ends = [e for e in ends if any(near(e, a, reach) for a in access) and any(near(e, s, reach) for s in sure)]
    return sorted(base + weak + ends)


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def contaminated(docs, items, n=10):
    windows = {}
    for item, text in items:
        w = words(text)
        k = min(n, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + k]), set()).add(str(item))
    sizes = {len(k) for k in windows}
    out = {}
    for d, text in docs:
        w, hit, names = words(text), set(), set()
        for k in sizes:
            for i in range(len(w) - k + 1):
                if (got := windows.get(tuple(w[i:i + k]))) is not None:
                    hit.update(range(i, i + k))
                    names |= got
        out[d] = (len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit))
    return out


def crc(value):
    return zlib.crc32(str(value).encode())


def viterbi(word, model):
    """Best segmentation of one marked word by plain dynamic programming: (score, ids or None for bare characters)."""
    table = {p: i for i, (p, t) in enumerate(zip(model.pieces, model.types)) if t in (1, 4)}
    best = [(0.0, None, None)]
    for end in range(1, len(word) + 1):
        top = None
        for size in range(min(model.longest, end), 0, -1):
            i = table.get(word[end - size:end])
            if i is not None:
                s = best[end - size][0] + model.scores[i]
                if top is None or s > top[0]:
                    top = (s, size, i)
        bare = best[end - 1][0] + model.unknown_score
        if top is None or bare > top[0]:
            top = (bare, 1, None)
        best.append(top)
    return best[-1][0]


def judge(url, block, allow):
    """(host, path, rule, verdict) of one url."""
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        host = lower(host)
    fits = []
    for rule in {*block, *allow}:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(rule), rule in block, len(h), rule))
    if not fits:
        return host, path, None, "allow"
    top = max(fits)
    return host, path, top[3], "block" if top[1] else "allow"


def conversations(rows):
    """rows: (conv_id, turn, role, text) -> {conv_id: (n_turns, turns_sha256, loss_chars, loss_sha256)}"""
    by = {}
    for c, turn, role, text in rows:
        by.setdefault(c, []).append((turn, role or "", text or ""))
    out = {}
    for c, turns in by.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        said = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[c] = (len(turns), sha(said), len(loss), sha(loss))
    return out


def embeddings(rows, cosine=0.93):
    """rows: (vec_id, vector or None, label) -> {vec_id: (n_links, component_id)}; ids must be unique."""
    import numpy as np
    by = {}
    for i, v, label in rows:
        if label is None or v is None or any(x is None for x in v):
            continue
        v = np.array(v, float)
        if len(v) and np.isfinite(v).all() and v.any():
            v = v / np.abs(v).max()
            by.setdefault((label, len(v)), []).append((i, v / np.linalg.norm(v)))
    links = []
    for held in by.values():
        m = np.stack([v for _, v in held])
        for k in range(len(m)):
            links += [(held[k][0], held[j][0]) for j in np.flatnonzero(m[k + 1:] @ m[k] >= cosine) + k + 1]
    n = {i: 0 for i, *_ in rows}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    comp = components(n, links)
    return {i: (n[i], comp[i]) for i in n}

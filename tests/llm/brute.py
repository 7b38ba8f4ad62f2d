"""Plain versions of the operators' contracts, for small inputs. Documents are (id, text) pairs."""

from __future__ import annotations

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def key(id):
    return (id is not None, id or 0)


def pages(rows):
    """(page_id, html) -> (page_id, payload_bytes, payload_digest, record_type, refers_to)."""
    data = [(i, (h or "").encode()) for i, h in rows]
    first = {}
    for i, p in data:
        if i is not None and len(p) >= 100:
            first[p] = min(i, first.get(p, i))
    out = []
    for i, p in data:
        again = i is not None and len(p) >= 100 and first[p] != i
        out.append((i, len(p), sha(p), "revisit" if again else "response", first[p] if again else None))
    return out


def top(rows, k=20, every=20):
    """(vec_id, vector) -> (query_id, rank, vec_id, score)."""
    good = [(i, [int(np.floor(64 * float(x))) for x in v]) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in good:
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in good if i != q)
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return out


def bpe(rows, path, pattern):
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    out = []
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        out.append((i, len(ids), sha(np.asarray(ids, "<u4").tobytes()), sha(library.decode_bytes(ids))))
    return out


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingle_set(text, width=4):
    ws = [re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in words(text)]
    if not ws:
        return set()
    return {tuple(ws[k : k + width]) for k in range(len(ws) - width + 1)} if len(ws) >= width else {tuple(ws)}


def near(rows, width=4, percent=85):
    """(id, text) -> (id, n_shingles, component_id)."""
    sets = [shingle_set(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    by = {}
    for k, s in enumerate(sets):
        for g in s:
            by.setdefault(g, []).append(k)
    pairs = {(a, b) for ks in by.values() if len(ks) < 400 for x, a in enumerate(ks) for b in ks[x + 1 :]}
    for a, b in pairs:
        one, two = sets[a], sets[b]
        if min(len(one), len(two)) * 100 >= percent * max(len(one), len(two)):
            both = len(one & two)
            if 100 * both >= percent * (len(one) + len(two) - both):
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        r = root(k)
        least[r] = min(least.get(r, i), i, key=key)
    return [(i, len(sets[k]), least[root(k)]) for k, (i, _) in enumerate(rows)]


def word_ids(rows, path, end, special_as_text=False):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.encode_special_tokens = special_as_text
    return [(i, np.asarray([*library.encode(t or "", add_special_tokens=False).ids, end], "<u4").tobytes()) for i, t in rows]


def token_files(rows, path):
    out, start = [], 0
    for i, ids in sorted(word_ids(rows, path, 1), key=lambda x: key(x[0])):
        out.append((i, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    return out


def check_packing(pieces, rows, path, capacity=4096):
    """Raise unless ``pieces`` (dicts) pack every id of ``rows`` once; returns the share of padding."""
    by = {}
    for i, ids in word_ids(rows, path, 2):
        by.setdefault(i, []).append(ids)
    assert all(len(v) == 1 for v in by.values()), "ids must be unique here"
    docs, seqs = {}, {}
    for p in pieces:
        ids = by[p["doc_id"]][0]
        part = ids[p["start"] * 4 : (p["start"] + p["length"]) * 4]
        assert p["length"] > 0 and len(part) == p["length"] * 4 and zlib.crc32(part) == p["ids_crc32"] and p["doc_tokens"] * 4 == len(ids)
        docs.setdefault(p["doc_id"], []).append((p["start"], p["length"]))
        seqs.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert set(docs) == set(by)
    for spans, whole in [(docs[i], len(by[i][0]) // 4) for i in docs] + [(s, None) for s in seqs.values()]:
        at = 0
        for start, length in sorted(spans):
            assert start == at
            at += length
        assert at == whole or (whole is None and at <= capacity)
    used = [sum(n for _, n in s) for s in seqs.values()]
    padded = sum(u if u & (u - 1) == 0 else capacity for u in used)
    return (padded - sum(used)) / max(1, sum(used))


def repeats(rows, window=100):
    """(id, text) -> (id, n_bytes, n_removed, n_spans, kept_sha256)."""
    seen, out = set(), {}
    for k in sorted(range(len(rows)), key=lambda k: key(rows[k][0])):
        data = (rows[k][1] or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - window + 1):
            w = data[s : s + window]
            if w in seen:
                gone[s : s + window] = b"\1" * window
            seen.add(w)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out[k] = (rows[k][0], len(data), sum(gone), spans, sha(bytes(b for b, g in zip(data, gone, strict=True) if not g)))
    return [out[k] for k in range(len(rows))]


KINDS = ("email", "ip", "card", "phone")


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def personal(text):
    """The base spans of a text: (kind, start, end)."""
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


def finite(vector):
    return vector is not None and all(x is not None and np.isfinite(x) for x in vector)


def near_vectors(rows, threshold=0.98):
    """(vec_id, vector, label) -> (vec_id, n_links, component_id, kept)."""
    good = [k for k, (_, v, label) in enumerate(rows) if label is not None and finite(v) and any(v)]
    width = max([len(rows[k][1]) for k in good], default=0)
    unit = {}
    for k in good:
        x = np.zeros(width)
        x[: len(rows[k][1])] = rows[k][1]
        unit[k] = x / abs(x).max() / np.linalg.norm(x / abs(x).max())
    links = {k: [j for j in good if j != k and rows[j][2] == rows[k][2] and unit[k] @ unit[j] >= threshold] for k in good}
    out, seen = {}, set()
    for k, (i, _, _) in enumerate(rows):
        if k in seen:
            continue
        reached, todo = {k}, [k]
        while todo:
            for j in links.get(todo.pop(), []):
                if j not in reached:
                    reached.add(j)
                    todo.append(j)
        seen |= reached
        least = min((rows[j][0] for j in reached if rows[j][0] is not None), default=None)
        for j in reached:
            out[j] = (rows[j][0], len(links.get(j, [])), least, rows[j][0] == least)
    return [out[k] for k in range(len(rows))]


def vector_codes(rows, parts=16, entries=64, rounds=2, scale=256):
    """(vec_id, vector, label) -> ((vec_id, code, error, label_error), codebooks)."""
    kept = sorted(((i, list(v), label) for i, v, label in rows if finite(v)), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = max(1, -(-max([len(v) for _, v, _ in kept], default=0) // parts))
    whole = [[int(np.floor(float(x) * scale)) for x in v] + [0] * (width * parts - len(v)) for _, v, _ in kept]
    books = [[w[p * width : (p + 1) * width] for w in whole[:entries]] for p in range(parts)]

    def nearest(p):
        return [min((sum((a - b) ** 2 for a, b in zip(w[p * width : (p + 1) * width], c, strict=True)), e) for e, c in enumerate(books[p])) for w in whole]

    for _ in range(rounds if kept else 0):
        moved = []
        for p in range(parts):
            found = nearest(p)
            book = []
            for e, old in enumerate(books[p]):
                own = [w[p * width : (p + 1) * width] for w, (_, x) in zip(whole, found, strict=True) if x == e]
                book.append([sum(c) // len(own) for c in zip(*own, strict=True)] if own else old)
            moved.append(book)
        books = moved
    found = [nearest(p) for p in range(parts)] if kept else []
    out, labels = [], {}
    for k, (i, _, label) in enumerate(kept):
        error = sum(f[k][0] for f in found)
        out.append([i, "".join(f"{f[k][1]:02x}" for f in found), error, label])
        labels[label] = labels.get(label, 0) + error
    return [(i, code, error, labels[label]) for i, code, error, label in out], books


def word_runs(words, times=4, least=6):
    """(start, length, period) by start, then period."""
    n, out = len(words), set()
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j + q - i
            if size >= max(least, times * q) and not any(words[i : j + q - d] == words[i + d : j + q] for d in range(1, q)):
                out.add((i, size, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def periodic(rows):
    """(doc_id, text) -> the digest row of op12."""
    out = []
    for i, t in rows:
        w = words(t)
        h, n = zlib.crc32(str(i).encode()), len(w)
        if i is not None and h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        runs = word_runs(w)
        gone = {k for s, m, q in runs for k in range(s + q, s + m)}
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else (None,) * 3
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        milli = 1000 * best[1] // best[2] if runs else None
        out.append((i, len(runs), *best, milli, sha(lines), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return out


def spans_text(spans, kinds=KINDS):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (kinds.index(x[0]), x[1])))

"""Brute-force versions of the operators, over lists of rows."""

import base64
import hashlib
import re

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, texts, schema=DOCS):
    """Rows from (doc_id, text) pairs or longer tuples."""
    rows = [(*t, *("en", "src0", len(t[1] or ""))[len(t) - 2 :]) if len(t) < 5 else t for t in texts]
    return spark.createDataFrame(rows, schema)


def words(text):
    return WORD.findall(text or "")


def simhash(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(marks, bits=2):
    """Smallest id that links of ``bits`` or fewer differing bits reach; marks: list of (id, fingerprint)."""
    parent = list(range(len(marks)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(marks)):
        for j in range(i):
            if (marks[i][1] ^ marks[j][1]).bit_count() <= bits:
                parent[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(marks):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    return [least.get(find(i)) for i in range(len(marks))]


def suffix_dedup(rows, length=100):
    """(n_bytes, n_removed, n_spans, sha) of each row of (key, text) in key order."""
    seen, out = set(), []
    for _, text in sorted(rows, key=lambda r: r[0]):
        b = (text or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            w = b[s : s + length]
            if w in seen:
                gone[s : s + length] = b"\1" * length
            else:
                seen.add(w)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def window_dedup(rows, length=50):
    """(n_words, n_removed, sha) of each row of (key, text) in key order."""
    first, out = {}, []
    rows = sorted(rows, key=lambda r: r[0])
    for key, text in rows:
        w = words(text)
        for s in range(len(w) - length + 1):
            first.setdefault(tuple(w[s : s + length]), key)
    for key, text in rows:
        w = words(text)
        gone = bytearray(len(w))
        for s in range(len(w) - length + 1):
            if first[tuple(w[s : s + length])] < key:
                gone[s : s + length] = b"\1" * length
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def edit_distance_inside(p, r):
    """Least edits that turn p into a part of r."""
    now = [0] * (len(r) + 1)
    for c in p:
        new = [now[0] + 1]
        for k, x in enumerate(r):
            new.append(min(now[k] + (x != c), now[k + 1] + 1, new[-1] + 1))
        now = new
    return min(now)


def sha1_base32(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()

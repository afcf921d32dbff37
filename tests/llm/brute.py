"""Plain single-machine versions of the operators' contracts, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np


def sha(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()


def bench_words(text):
    if text is None:
        return []
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def op2(rows, k=13):
    """rows: (doc_id, text) -> {(doc_id, n_words, n_removed, kept_sha256)} in row order."""
    words = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for _, t in rows]
    first = {}
    for (d, _), w in zip(rows, words):
        d = float("inf") if d is None else d
        for i in range(len(w) - k + 1):
            key = tuple(w[i:i + k])
            first[key] = min(first.get(key, float("inf")), d)
    out = []
    for (d, _), w in zip(rows, words):
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - k + 1):
            if first[tuple(w[i:i + k])] < (float("inf") if d is None else d):
                gone[i:i + k] = True
        out.append((d, len(w), int(gone.sum()), sha(b" ".join(x for x, g in zip(w, gone) if not g))))
    return out


def op3(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[t or ""].append(d)
    out = []
    for d, t in rows:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((d, keep, len(ids), d == keep, sha((t or "").encode())))
    return out


def op7(rows, k=400):
    data = [(t or "").encode() for _, t in rows]
    count = defaultdict(int)
    for b in data:
        for i in range(len(b) - k + 1):
            count[hash(b[i:i + k])] += 1
    out = []
    for (d, _), b in zip(rows, data):
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - k + 1):
            if count[hash(b[i:i + k])] > 1:
                gone[i:i + k] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        out.append((d, len(b), int(gone.sum()), spans, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


def op10(rows, items, k=10):
    windows = defaultdict(set)
    for item, t in items:
        w = bench_words(t)
        if w:
            n = min(k, len(w))
            for i in range(len(w) - n + 1):
                windows[tuple(w[i:i + n])].add("null" if item is None else str(item))
    lengths = sorted({len(x) for x in windows})
    out = []
    for d, t in rows:
        w = bench_words(t)
        gone, found = np.zeros(len(w), bool), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                hit = windows.get(tuple(w[i:i + n]))
                if hit:
                    gone[i:i + n] = True
                    found |= hit
        out.append((d, len(w), int(gone.sum()), len(found), sha(",".join(sorted(found)).encode()), bool(gone.any())))
    return out


def encode(path, texts, end_id):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    return [np.array(e.ids + [end_id], "<u4") for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def crc(a: np.ndarray) -> int:
    return zlib.crc32(a.astype("<u4").tobytes())


def op6(rows):
    """Lines removed by chunk, with the operator's own chunk ends; rows ascending by doc_id."""
    from strata.llm.lines import LEAST, chunk_ends, line_hashes

    seen, out = set(), []
    for d, t in rows:
        b = (t or "").encode()
        lines, ends, a, kept, n = b.split(b"\n"), chunk_ends(line_hashes(b)[2]), 0, [], 0
        for e in ends:
            body = b"\n".join(lines[a:e])
            if e - a >= LEAST and body.strip() and body in seen:
                n += e - a
            else:
                kept.append(body)
            if e - a >= LEAST:
                seen.add(body)
            a = e
        out.append((d, len(lines), n, sha(b"\n".join(kept))))
    return out

"""Brute-force twins and awkward inputs shared by the tests of the training-data operators."""

import re
import zlib

import numpy as np
import xxhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def doc_frame(spark, texts, sources=None, ids=None):
    ids = ids if ids is not None else list(range(1, len(texts) + 1))
    sources = sources or ["a"] * len(texts)
    return spark.createDataFrame(
        [(i, t, "en", s, len(t) if t is not None else None)
         for i, t, s in zip(ids, texts, sources)], DOCS)


def awkward(spark):
    """Nulls, empties, a very long text, repeated rows, clashing extra columns."""
    long_text = " ".join(f"w{i % 997}" for i in range(120_000))
    rows = [(1, "one two three four five. " * 20, "a"), (1, "one two three four five. " * 20, "a"),
            (None, "a text without an id", None), (2, None, None), (3, "", "a"),
            (4, " \n\t ", "b"), (5, long_text, "b"), (6, "één tweë drië €uro 𝒳.", "a")]
    return spark.createDataFrame(
        [(*r, "x", -1, "y", 7) for r in rows],
        "doc_id long, text string, source string, score string, size int, spans string, n long"
    ).selectExpr("*", "'en' AS lang", "0L AS n_chars")


def fingerprint(text, shingle=3):
    w = [x.encode().lower() for x in words(text)]
    if not w:
        return 0
    shingles = [b" ".join(w[i:i + shingle]) for i in range(len(w) - shingle + 1)] or [b" ".join(w)]
    votes = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(shingles))


def hamming_components(fps, max_bits):
    """Least index reachable over pairs within max_bits."""
    u = np.array(fps, dtype=np.uint64)
    label = np.arange(len(u))
    near = np.bitwise_count(u[:, None] ^ u[None, :]) <= max_bits
    while True:
        step = np.where(near, label[None, :], len(u)).min(axis=1)
        if (step == label).all():
            return label
        label = step


def fold(doc_id, n=5):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n

"""Small fixtures and brute-force versions shared by the tests of the text operators."""

import hashlib
import random
import re

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, texts, ids=None, extra=None):
    """documents with the given texts (ids 0.. unless given)."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", "s", len(t) if t else None) for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, DOC_SCHEMA).repartition(3)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def ascii_lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def near_oracle(rows, width, percent=80):
    """{row index: (n_shingles, component)} by comparing every pair of full sets."""
    sets = []
    for _, text in rows:
        w = words(ascii_lower(text or ""))
        sets.append({tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width
                    else ({tuple(w)} if w else set()))
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for p, (i, _) in enumerate(rows):
        for q in range(p):
            j = rows[q][0]
            if sets[p] and sets[q] and 100 * len(sets[p] & sets[q]) >= percent * len(sets[p] | sets[q]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(s), find(i)) for (i, _), s in zip(rows, sets, strict=True)}

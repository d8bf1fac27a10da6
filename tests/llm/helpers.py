"""Plain-Python versions of what the operators compute, and a table of awkward documents."""
import re

UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"

#: Columns that documents may carry besides, with names that operators use for their own.
CLASHING = {"class": "1", "score": "'x'", "spans": "array(1)", "fingerprint": "'f'", "start": "2", "row": "3", "token": "'t'",
            "keep": "true", "place": "4", "n_tokens": "5", "digest": "'d'", "component_id": "6", "ids": "7", "n": "8"}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))


def shingles(text, width=5):
    w = words(text)
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)}


def components(texts):
    """Smallest key reachable by links of Jaccard 0.75 or more, for a dictionary of texts."""
    sets = {k: shingles(t) for k, t in texts.items()}
    parent = {k: k for k in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(texts)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {k: (len(sets[k]), find(k)) for k in texts}


def prose(seed, n):
    """Invented sentences, the same for one seed."""
    import random
    r = random.Random(seed)
    out = []
    for i in range(n):
        w = "".join(r.choice(["the", "an", "er", "ti", "on", "sh", "re", "in"]) for _ in range(r.randint(1, 4)))
        w = r.choice(["the", "of", "and", "is"]) if r.random() < 0.3 else w
        out.append(w + ("." if i % 9 == 8 else ""))
    return " ".join(out)


def awkward_rows():
    long = prose(1, 30_000)
    base = prose(2, 200)
    edited = base.replace(base.split()[50], "changed", 1)
    return [
        (1, None, None, None, None), (2, "", "en", "s", 0), (3, "  \t\n\x0b ", "en", "s", 6), (4, "word", "en", None, 4),
        (5, "Été, Straße! ÀḈ 日本語 \U0001F600   x", "fr", "s", 20), (6, "### !!! $$$", None, "s", 11), (7, long, "en", "s", len(long)),
        (8, base, "en", "s", len(base)), (9, base.upper(), "en", "s", len(base)), (10, base, "en", "s", len(base)), (10, base, "en", "s", len(base)),
        (11, edited, "en", "s", len(edited)), (12, "a" * 50_000, "de", "s", 50_000), (13, "1" * 20_000 + "@", "de", "s", 20_001),
        (14, "call +1 (017) 555-7713 or 4111 1111 1111 1111, und.34@mail7.example.com 10.0.0.1 999.1.1.1 4111111111111112", "en", "s", 99),
        (15, "x <|endoftext|> y\u0000z", "en", "s", 17), (None, "no id at all here", "en", "s", 17),
    ]

"""Small tables with the awkward cases, and plain versions of the rules."""

import random
import re
import zlib

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SYLLABLES = ["ba", "ker", "to", "mi", "nul", "sé", "ro", "lan", "vi", "pu", "gra", "ö"]


def word(rng):
    return "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4)))


def prose(rng, n):
    return " ".join(word(rng) for _ in range(n))


def texts(seed=3, n=120):
    """Fresh texts, exact and near copies, shared passages and lines, empty, blank, null and long ones."""
    rng = random.Random(seed)
    passage, line = prose(rng, 60), prose(rng, 8)
    base = prose(rng, 150)
    found = [prose(rng, rng.randint(1, 90)) for _ in range(n)]
    found += [f"{prose(rng, 20)}\n{line}\n{prose(rng, 12)}  {passage} {prose(rng, rng.randint(0, 30))}" for _ in range(15)]
    found += [f"{prose(rng, 5)}\n \t{line.upper()} \n{prose(rng, 5)}" for _ in range(5)]
    for i in range(30):
        words = base.split()
        for _ in range(i % 6):
            words[rng.randrange(len(words))] = word(rng)
        found.append(" ".join(words))
    found += [base] * 4 + [None, "", " \t\n", "a", "aaaa " * 80, prose(rng, 6000), "x" * 400, "\U0001f600é " * 40]
    rng.shuffle(found)
    return found


def documents(spark, seed=3, n=120):
    rng = random.Random(seed + 1)
    rows = [
        (i * 3 - 20, text, rng.choice(["en", "fr", None]), rng.choice(["s1", "s1", "s1", "s2", "s3", None]), len(text or ""))
        for i, text in enumerate(texts(seed, n))
    ]
    return spark.createDataFrame(rows, DOCUMENTS)


def awkward(spark):
    """Null and repeated ids, repeated rows, null texts, and columns whose names clash with inner ones."""
    same = "one two three four five six seven\nshared line of words\n" + "tail " * 40
    rows = [(1, same), (1, same), (None, same), (None, None), (2, None), (3, ""), (1, "other words here"), (4, same + "x")]
    names = ["text_key", "pos", "gram", "key", "size", "copies", "label", "component_id", "score", "_lower", "next", "spans", "kept"]
    full = [(*r, "en", "s", 1, *([7] * len(names))) for r in rows]
    return spark.createDataFrame(full, DOCUMENTS + "".join(f", {n} int" for n in names))


def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def words5(text):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(found) < 5:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + 5]) for i in range(len(found) - 4)}


def find(parent, x):
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def components(nodes, links):
    parent = {x: x for x in nodes}
    for a, b in links:
        a, b = find(parent, a), find(parent, b)
        parent[max(a, b)] = min(a, b)
    return {x: find(parent, x) for x in nodes}

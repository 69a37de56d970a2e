"""Small inputs that every operator has to take, and brute-force versions."""

from collections import Counter

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
#: Names that operators use inside; as columns of the input they must not matter.
CLASHES = ("kept", "norm", "h", "sha", "n", "key", "keys", "component", "rep", "leaks", "ids", "tail", "answers",
           "words", "hits", "row", "block_id", "first", "n_pieces", "lines", "host", "path", "gone_id")

LONG = "ab cd " * 4000 + "x" * 9000
EDGES = [(1, "the cat sat on the mat and the dog"), (2, None), (3, ""), (4, "   \n\t "), (None, "a null id"),
         (5, LONG), (6, "the cat sat on the mat and the dog"), (6, "the cat sat on the mat and the dog"),
         (7, "the cat  sat on\nthe mat and the dog"), (8, "Ünï códe ▁ \x00 \U0001F600 é"), (None, None),
         (9, "THE CAT sat on the mat and the dog")]


def frame(spark, rows, clash=True, name="doc_id"):
    df = spark.createDataFrame(rows, f"{name} long, text string")
    if clash:
        df = df.select("*", *(F.lit(None if i % 2 else "x").cast("string").alias(c) for i, c in enumerate(CLASHES)))
    return df


def ascii_lower(text):
    return (text or "").encode().lower()


def brute_components(rows, words=4, percent=85):
    """Sets and components by comparing all sets that share a shingle."""
    sets, parent = [], list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for _, t in rows:
        w = ascii_lower(t).split()
        sets.append(frozenset(zip(*(w[i:] for i in range(words)))) if len(w) >= words else frozenset([tuple(w)] if w else []))
    lists = {}
    for i, s in enumerate(sets):
        met = Counter()
        if rows[i][0] is not None:
            for g in s:
                seen = lists.setdefault(g, [])
                met.update(seen)
                seen.append(i)
        for j, c in met.items():
            if 100 * c >= percent * (len(s) + len(sets[j]) - c):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, len(s), None if d is None else least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))]

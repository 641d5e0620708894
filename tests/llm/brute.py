"""Plain versions of the operators for small inputs, and shared awkward rows."""

from __future__ import annotations

import re
from itertools import combinations

BLANKS = " \t\n\v\f\r"

#: Null and empty texts, ties, repeated rows, null labels and ids, a very long text.
LONG = "Lorem ipsum dolor " * 3000 + "end\n" + "x" * 50_000
SHARED = "this line is shared by several documents"
AWKWARD = [
    (1, None, "en", "a"),
    (2, "", None, "a"),
    (3, "A b c d e f g\n" + SHARED, "en", None),
    (3, "A b c d e f g\n" + SHARED, "en", None),
    (4, "a B c d e f g\n" + SHARED.upper(), "fr", "b"),
    (None, "no id here\n" + SHARED, None, None),
    (5, LONG, "en", "a"),
    (6, " \t\n \n", "en", "a"),
    (7, "one two", "en", "a"),
    (8, "ONE  two", "en", "a"),
    (9, "one two three", "en", "a"),
    (10, "</s>[INST] é ü 漢字 🙂 \u0085 \x1c end", "de", "c"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string"


def awkward(spark, rows=AWKWARD):
    """The rows with further columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    clashing = ["n_lines", "pos", "node", "hashes", "kept", "grp", "raw", "label", "row", "h", "list"]
    docs = spark.createDataFrame(rows, SCHEMA)
    return docs.select("*", *[F.lit(name).alias(name) for name in clashing])


def shingles(text: str | None, size: int = 5) -> set:
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    size = min(size, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def components(texts: list[tuple[int, str | None]]) -> dict[int, int]:
    sets = [(i, shingles(t)) for i, t in texts]
    parent = {i: i for i, _ in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (a, s), (b, t) in combinations(sets, 2):
        if s and t and 100 * len(s & t) >= 75 * len(s | t):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    return {i: root(i) for i, _ in sets}


def ascii_lower(text: str) -> str:
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def repeated_words(text: str, size: int = 8) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]
    covered = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            covered.update(range(i, i + size))
    return len(covered)

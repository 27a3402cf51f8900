"""Small frames that every operator must take, and brute-force versions to hold results against."""

from __future__ import annotations

import re
from collections import defaultdict
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
LOWER = {i: i + 32 for i in range(65, 91)}


def prose(seed: int, n: int) -> str:
    """n words and a line end after every ninth."""
    return "".join(WORDS[(seed * 7 + i * i * 3 + i * seed) % len(WORDS)] + str((seed * 31 + i * 17) % 97) + ("\n" if i % 9 == 8 else " ") for i in range(n))


def documents(spark: SparkSession, texts: list[tuple[int | None, str | None]]) -> DataFrame:
    return spark.createDataFrame([(i, t, None, None, None) for i, t in texts], DOCS)


def odd_texts() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and very long texts, ties, repeated rows, copies."""
    long = prose(5, 30_000)
    return [(None, None), (None, prose(1, 40)), (0, None), (1, ""), (2, "   \n"), (3, prose(1, 40)), (3, prose(1, 40)), (4, prose(1, 40)),
            (5, long), (6, "one"), (7, "one"), (8, prose(2, 60)), (9, prose(2, 60) + "more words"), (10, "É\u0130 \x01 a. b! c? d\n\n\n")]


def clashing(df: DataFrame, *names: str) -> DataFrame:
    """The frame with further columns of these names."""
    from pyspark.sql import functions as F

    return df.withColumns({n: F.lit("clash") for n in names})


def components(docs: list[tuple[int, str | None]], n: int, num: int, den: int) -> dict[int, tuple[int, int]]:
    """(number of shingles, component) of each document, by all pairs."""
    rows = {}
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        rows[i] = frozenset(tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset()
    root = {i: i for i in rows}

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(rows), 2):
        if rows[a] and rows[b] and den * len(rows[a] & rows[b]) >= num * len(rows[a] | rows[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(r), find(i)) for i, r in rows.items()}


def contamination(docs: list[tuple[int, str | None]], items: list[tuple[object, str | None]], window: int = 13) -> dict[int, tuple[int, int, list[str]]]:
    """(words, hit words, items) of each document, window by window."""
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    phrases = defaultdict(set)
    for i, t in items:
        w = cut(t)
        for k in range(max(1, len(w) - window + 1) if w and i is not None else 0):
            phrases[tuple(w[k:k + window])].add(str(i))
    out = {}
    for i, t in docs:
        w, hit, found = cut(t), set(), set()
        for size in {len(p) for p in phrases}:
            for k in range(len(w) - size + 1):
                if own := phrases.get(tuple(w[k:k + size])):
                    hit.update(range(k, k + size))
                    found |= own
        out[i] = (len(w), len(hit), sorted(found))
    return out


def without_repeated_lines(docs: list[tuple[int, str]], least_chars: int = 0) -> dict[int, str]:
    """Texts less later occurrences of three-line windows, in order of id."""
    cut = {i: [x for x in re.split(r"(?<=\n)|(?<=[.!?] )", t) if x] for i, t in docs}
    first, gone = {}, defaultdict(set)
    for i in sorted(cut):
        for p in range(len(cut[i]) - 2):
            key = tuple(x.rstrip("\n").rstrip(" ") for x in cut[i][p:p + 3])
            if sum(map(len, key)) < least_chars:
                continue
            at = first.setdefault(key, (i, p))
            if at != (i, p):
                gone[i].update(range(max(p, at[1] + 3) if at[0] == i else p, p + 3))
    return {i: "".join(x for p, x in enumerate(lines) if p not in gone[i]) for i, lines in cut.items()}

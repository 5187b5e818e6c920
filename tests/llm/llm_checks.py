"""Small frames and brute-force versions shared by the tests of the training-data operators."""

from __future__ import annotations

from collections import Counter, defaultdict
from pathlib import Path

import duckdb
from pyspark.sql import functions as F

TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside, as columns of the caller.
CLASHING = ["size", "key", "row", "bucket", "unit", "band", "node", "draw", "owner", "score", "guest", "cluster"]


def documents(spark, *rows):
    """(doc_id, text[, source]) rows as documents."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCUMENTS)


def words(seed: int, n: int) -> str:
    """n words of a small pseudo-random language."""
    state, found = seed * 2654435761 % 2**32 or 1, []
    for _ in range(n):
        state = (state * 1103515245 + 12345) % 2**31
        found.append("".join("bcdfgklmnprst"[(state >> s) % 13] + "aeiou"[(state >> (s + 4)) % 5] for s in (8, 12, 16)))
    return " ".join(found)


def edge_documents(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, clashing columns."""
    long_text = "\n".join(words(i, 40) for i in range(600))
    rows = [
        (1, words(1, 30), "en", "a", 1), (1, words(1, 30), "en", "a", 1), (2, None, "en", "a", None),
        (3, "", None, None, 0), (4, " \n\t ", "en", "b", 5), (None, words(2, 30), "en", "a", 9),
        (None, None, None, None, None), (5, long_text, "en", None, 7), (6, words(1, 30), "en", "b", 1),
        (7, "äöü ß 漢字 😀 " * 20, "de", "c", 3), (2, words(3, 30), "en", "a", 4), (8, "word", "en", "é", 4),
    ]
    frame = spark.createDataFrame(rows, DOCUMENTS)
    return frame.withColumns({c: F.lit(f"own {c}") for c in CLASHING})


def no_documents(spark):
    return spark.createDataFrame([], DOCUMENTS)


def oracle_rows(path: str, sql: str) -> tuple[list[str], list[tuple]]:
    with duckdb.connect() as engine:
        for table in TABLES:
            if Path(f"{path}/{table}.parquet").exists():
                engine.sql(f"CREATE VIEW {table} AS SELECT * FROM '{path}/{table}.parquet'")
        result = engine.sql(sql)
        return result.columns, result.fetchall()


def assert_same(frame, path: str, sql: str) -> int:
    columns, expected = oracle_rows(path, sql)
    assert sorted(columns) == sorted(frame.columns)
    order = sorted(columns)
    want = sorted((tuple(r[columns.index(c)] for c in order) for r in expected), key=str)
    got = sorted((tuple(r[c] for c in order) for r in frame.collect()), key=str)
    assert got == want
    return len(got)


def shingles(text: str | None) -> set[tuple]:
    w = (text or "").split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def near_classes(rows, similarity: float = 0.8) -> dict:
    """Smallest id of each class, by comparing all pairs of texts that share a shingle."""
    first, parent = {}, {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    def unite(a, b):
        a, b = sorted((find(a), find(b)))
        parent[b] = a

    for doc_id, text in sorted(rows):
        unite(first.setdefault(text or "", doc_id), doc_id)
    sets = {d: shingles(t) for t, d in first.items()}
    holders = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    common = Counter((a, b) for h in holders.values() for i, b in enumerate(h) for a in h[:i])
    for (a, b), n in common.items():
        if n >= similarity * (len(sets[a]) + len(sets[b]) - n):
            unite(a, b)
    return {d: find(d) for d, _ in rows}

"""Documents that every operator has to cope with."""

import random

SCHEMA = (
    "doc_id long, text string, source string, fp string, key int, host string, "
    "text_hash string, n long, part string, rest string, ids string, base string"
)


def words(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdeilnorst", k=rng.randint(2, 8))) for _ in range(n))


def awkward() -> list[tuple]:
    """Nulls in any column, empty and long texts, repeated rows, clashing columns."""
    long = words(1, 6_000)
    shared = words(2, 60)
    texts = [
        (0, shared), (1, shared), (2, shared + " end."), (2, shared + " end."), (3, None),
        (4, ""), (None, shared), (None, None), (5, long), (6, " \n\t  "), (7, "one two"),
        (8, "Größe  und Maß\n\nça va bien ?\r\n漢字 😀 don't I'LL 12½ <|endoftext|>"),
        (9, words(3, 80) + "\n" + words(3, 80)), (9, words(4, 30)), (10, "a" * 3_000),
    ]
    return [(i, t, "h" if (i or 0) % 2 else None, *[None] * 9) for i, t in texts]


def frame(spark, rows=None):
    return spark.createDataFrame(awkward() if rows is None else rows, SCHEMA)


def plain(pairs: list[tuple]) -> list[tuple]:
    """Rows of a key and a text."""
    return [(i, t, "h", *[None] * 9) for i, t in pairs]

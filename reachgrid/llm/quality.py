"""Quality rules: measures of a text and lines that many documents share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reachgrid.llm.shared import store

#: ASCII white space, as a Java pattern.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOL = "[#*$%&|<>]"

#: Words of a window, fewest words of a text, most words in repeated windows in percent.
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED = 30

#: A line goes if more distinct documents of its host hold it than this share of them.
#: The least number only keeps hosts of a handful of documents from losing lines. Of
#: 10,000 documents of 20 hosts, 20 lines are above 5 %, the template of each host; above
#: 1 % there are 128 more, each in the 11 to 23 near copies of one text.
MAX_DOCUMENTS = 10
MAX_SHARE = 0.05

#: A document is depleted if less than this share of its words stays.
MIN_KEPT = 0.5


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def _window_hashes(words: Column) -> Column:
    places = F.sequence(F.lit(1), F.size(words) - (WINDOW - 1))
    hashes = F.transform(places, lambda i: F.xxhash64(F.slice(words, i, F.lit(WINDOW))))
    return F.when(F.size(words) >= WINDOW, hashes).otherwise(F.expr("cast(array() AS array<bigint>)"))


def _covered(hashes: Column) -> Column:
    """Words within windows whose hash occurs again: their places in order, each
    covering up to the next."""

    def of_sorted(pairs: Column) -> Column:
        def again(pair: Column, k: Column) -> Column:
            before = (k > 0) & (F.get(pairs, k - 1)["h"] == pair["h"])
            after = (k < F.size(pairs) - 1) & (F.get(pairs, k + 1)["h"] == pair["h"])
            return before | after

        return _bound(
            F.array_sort(F.transform(F.filter(pairs, again), lambda p: p["i"])),
            lambda at: F.aggregate(
                F.transform(
                    at,
                    lambda i, k: F.when(
                        k < F.size(at) - 1, F.least(F.lit(WINDOW), F.get(at, k + 1) - i)
                    ).otherwise(WINDOW),
                ),
                F.lit(0).cast("long"),
                lambda total, n: total + n,
            ),
        )

    pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeated = F.size(F.array_distinct(hashes)) < F.size(hashes)
    return F.when(repeated, _bound(pairs, of_sorted)).otherwise(F.lit(0).cast("long"))


def measures(whole: Column) -> Column:
    """A struct of n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of
    a text. Bound values are computed once, wherever the optimizer moves them."""

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            (F.size(F.split(whole, SYMBOL)) - 1).cast("long").alias("n_symbols"),
            _bound(
                F.filter(F.split(whole, "\n"), lambda line: line.rlike(WORD)),
                lambda lines: F.size(lines) - F.size(F.array_distinct(lines)),
            )
            .cast("long")
            .alias("n_dup_lines"),
            _bound(_window_hashes(words), _covered).alias("n_repeat_words"),
        )

    return _bound(words_of(whole), of_words)


def hashed_lines(whole: Column) -> Column:
    """``place, line, words`` of every line with a word: its hash, in lower case and
    with single spaces, and its number of words."""

    def of_line(line: Column, i: Column) -> Column:
        return _bound(
            words_of(line),
            lambda w: F.struct(
                i.alias("place"),
                F.substring(F.md5(F.array_join(w, " ")), 1, 16).alias("line"),
                F.size(w).alias("words"),
            ),
        )

    lines = F.transform(F.split(F.lower(whole), "\n"), of_line)
    return F.filter(lines, lambda x: x["words"] > 0)


def described(docs: DataFrame) -> DataFrame:
    """``key, text_hash, host`` with measures, base_failed, lines, and ``content``, one
    value for all texts of the same distinct lines."""
    whole = F.coalesce("text", F.lit(""))
    found = docs.select(
        "key",
        "text_hash",
        "host",
        _bound(whole, lambda t: F.struct(measures(t).alias("m"), hashed_lines(t).alias("l"))).alias(
            "d"
        ),
    ).select("key", "text_hash", "host", "d.m.*", F.col("d.l").alias("lines"))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")
    )
    hashes = F.transform(F.array_distinct("lines.line"), lambda line: F.xxhash64(line))
    content = F.aggregate(hashes, F.lit(0).cast("long"), lambda a, b: a.bitwiseXOR(b))
    found = found.withColumn("base_failed", failed).withColumn("content", content)
    return store(found, "described")


def line_rows(docs: DataFrame) -> DataFrame:
    """A row per line of described documents."""
    rows = docs.select("key", "text_hash", "host", F.explode("lines").alias("l"))
    return rows.select("key", "text_hash", "host", "l.place", "l.line", "l.words")


def _counts(pieces: DataFrame, documents: int) -> DataFrame:
    """``host, line, n`` of the lines in more than so many documents."""
    counts = pieces.groupBy("host", "line").agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") > documents)


def _told_apart(pieces: DataFrame, documents: int) -> DataFrame:
    """``h, c, document`` of the contents with lines that many others hold: they are told
    apart by the set of their other lines."""
    often = _counts(pieces, documents)
    often = often.select(F.col("host").alias("h"), F.col("line").alias("l"))
    met = pieces.join(often, pieces["host"].eqNullSafe(often["h"]) & (pieces["line"] == often["l"]))
    found = met.groupBy("host", "content").agg(F.expr("bit_xor(xxhash64(line))").alias("mixed"))
    return found.select(
        F.col("host").alias("h"),
        F.col("content").alias("c"),
        F.col("content").bitwiseXOR(F.col("mixed")).alias("document"),
    )


def frequent_lines(docs: DataFrame, documents: int, share: float) -> DataFrame:
    """``host, line`` of the lines above the limits, over distinct documents."""
    pieces = docs.select(
        "host", "content", F.explode(F.array_distinct("lines.line")).alias("line")
    )
    pieces = store(pieces.distinct(), "pieces")
    others = store(_told_apart(pieces, documents), "others")

    def of_documents(contents: DataFrame) -> DataFrame:
        same = contents["host"].eqNullSafe(others["h"]) & (contents["content"] == others["c"])
        told = contents.join(others, same, "left")
        return told.withColumn("document", F.coalesce("document", "content"))

    lines = of_documents(pieces).select("host", "line", "document").distinct()
    contents = of_documents(docs.select("host", "content").distinct())
    sizes = contents.select("host", "document").distinct()
    sizes = sizes.groupBy(F.col("host").alias("h")).agg(F.count("*").alias("n_docs"))
    counts = _counts(lines, documents)
    return (
        counts.join(sizes, counts["host"].eqNullSafe(sizes["h"]))
        .filter(F.col("n") > share * F.col("n_docs"))
        .select("host", "line")
    )


def verdicts(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    host: str = "source",
    documents: int = MAX_DOCUMENTS,
    share: float = MAX_SHARE,
    min_kept: float = MIN_KEPT,
) -> DataFrame:
    """Per document the measures, ``removed`` (places of the lines that go, null if
    none), ``kept``, and ``key``, ``text_hash``, ``host`` to find it by.

    A normalised line goes if it stands in more than ``documents`` distinct documents
    of its host and in more than ``share`` of them. Documents are told apart by the set
    of their lines that no more than ``documents`` hold; those that differ only in others
    are copies and count once. A document is rejected if the base rules fail, or if the lines that stay hold under MIN_WORDS words or under
    ``min_kept`` of all. Null texts are empty and fail; null hosts are one host;
    null keys are kept apart by their texts; repeated rows get the same verdict
    each. An empty table gives no rows; other columns are not read.
    """
    rows = docs.select(
        F.col(key).alias("key"),
        F.col(text).alias("text"),
        F.col(host).alias("host"),
        F.xxhash64(F.col(text)).alias("text_hash"),
    )
    rows = described(rows)
    lines = line_rows(rows)
    often = frequent_lines(rows, documents, share)
    often = often.select(F.col("host").alias("h"), F.col("line").alias("l"))
    hit = lines.join(often, lines["host"].eqNullSafe(often["h"]) & (lines["line"] == often["l"]))
    gone = hit.groupBy("key", "text_hash", "host").agg(
        F.collect_set(F.struct("place", "words")).alias("gone")
    )
    gone = gone.select(
        F.col("key").alias("g_key"),
        F.col("text_hash").alias("g_hash"),
        F.col("host").alias("g_host"),
        F.col("gone.place").alias("removed"),
        F.aggregate("gone.words", F.lit(0).cast("long"), lambda a, b: a + b).alias("lost"),
    )
    same = (
        F.col("key").eqNullSafe(F.col("g_key"))
        & (F.col("text_hash") == F.col("g_hash"))
        & F.col("host").eqNullSafe(F.col("g_host"))
    )
    left = F.col("n_words") - F.coalesce("lost", F.lit(0))
    depleted = (left < MIN_WORDS) | (left < min_kept * F.col("n_words"))
    return (
        rows.join(gone, same, "left")
        .withColumn("kept", ~F.col("base_failed") & ~depleted)
        .drop("g_key", "g_hash", "g_host", "lost", "lines", "content")
    )


def passed(
    docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", **limits
) -> DataFrame:
    """The documents that stay, without the lines that go; all columns stay."""
    found = verdicts(docs, key, text, host, **limits).filter("kept")
    found = found.select(
        F.col("key").alias("__key"),
        F.col("text_hash").alias("__hash"),
        F.col("host").alias("__host"),
        F.col("removed").alias("__removed"),
    ).dropDuplicates(["__key", "__hash", "__host"])
    same = (
        docs[key].eqNullSafe(found["__key"])
        & (F.xxhash64(docs[text]) == found["__hash"])
        & docs[host].eqNullSafe(found["__host"])
    )
    stay = F.filter(
        F.split(F.col(text), "\n"), lambda _, i: ~F.array_contains("__removed", i)
    )
    cleaned = F.when(F.col("__removed").isNull(), F.col(text)).otherwise(F.array_join(stay, "\n"))
    return (
        docs.join(found, same)
        .withColumn(text, cleaned)
        .select(*[F.col(c) for c in docs.columns])
    )

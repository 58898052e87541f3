"""Personal data: fixed patterns, and contexts learnt from what they find."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reachgrid.llm.shared import store

#: Kinds in the order of their listing, with Java patterns. The runs are possessive
#: and start where a run starts (or where the last match ended): the same matches,
#: in time that grows with the length of the text.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
KINDS = tuple(PATTERNS)

#: Without a match of this, no pattern of the kind can match.
HINTS = {"email": "@", "phone": "+"}

SPANS = "array<struct<start:int,end:int,value:string>>"

#: What may be an identifier: a token with "@", or groups of digits.
EMAIL_LIKE = r"(?<![^ \t\n\x0B\f\r,;:<>()\[\]\"'])[^ \t\n\x0B\f\r,;:<>()\[\]\"'@]++@[^ \t\n\x0B\f\r,;:<>()\[\]\"'@]++"
DIGITS_LIKE = r"(?<![0-9A-Za-z])\+?\(?[0-9]{1,4}\)?(?:[ ./-]?\(?[0-9]{1,4}\)?){2,6}(?![0-9A-Za-z])"

#: Characters before a candidate in which its context word is looked for.
CONTEXT = 40

#: A pattern is trusted if so many known values and this share of all it meets are
#: known; a value is taken if its trusted patterns leave no more doubt than this.
SUPPORT = 5
PRECISION = 0.9
DOUBT = 0.15
ROUNDS = 3


def _bound(value: Column, use) -> Column:
    return F.transform(F.array(value), use)[0]


def matches(text: Column, pattern: str) -> Column:
    """``start, end, value`` of every match, in code points, end exclusive: the text
    between the matches tells their places. Blocks keep the running sum cheap."""
    block = 256

    def placed(values: Column, gaps: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            start = state["at"] + F.length(F.get(gaps, i))
            value = F.get(values, i)
            end = start + F.length(value)
            span = F.struct(start.alias("start"), end.alias("end"), value.alias("value"))
            return F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

        def of_block(state: Column, b: Column) -> Column:
            last = F.least(b * block + block, F.size(values)) - 1
            empty = F.struct(state["at"].alias("at"), F.expr(f"cast(array() AS {SPANS})").alias("out"))
            done = F.aggregate(F.sequence(b * block, last), empty, step)
            return _bound(
                done,
                lambda d: F.struct(
                    d["at"].alias("at"), F.concat(state["out"], F.array(d["out"])).alias("out")
                ),
            )

        first = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() AS array<{SPANS}>)").alias("out"))
        n = F.floor((F.size(values) - 1) / block).cast("int")
        return F.flatten(F.aggregate(F.sequence(F.lit(0), n), first, of_block)["out"])

    return _bound(
        F.regexp_extract_all(text, F.lit(pattern), 0),
        lambda values: F.when(
            F.size(values) > 0,
            _bound(F.split(text, pattern), lambda gaps: placed(values, gaps)),
        ).otherwise(F.expr(f"cast(array() AS {SPANS})")),
    )


def _luhn(digits: Column) -> Column:
    """Whether every second digit from the right, doubled, sums up to tens."""

    def value(i: Column) -> Column:
        digit = F.substring(digits, i, F.lit(1)).cast("int")
        doubled = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return F.when(F.pmod(F.length(digits) - i, F.lit(2)) == 1, doubled).otherwise(digit)

    total = F.aggregate(
        F.transform(F.sequence(F.lit(1), F.length(digits)), value),
        F.lit(0),
        lambda a, b: a + b,
    )
    return F.when(F.length(digits).between(14, 19), total % 10 == 0).otherwise(False)


def valid(kind: str, value: Column) -> Column:
    """Whether a match is one of its kind."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
        return value.rlike(rf"\A{part}\.{part}\.{part}\.{part}\z")
    if kind == "card":
        return _luhn(digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return value.rlike(r"\A[^@]+@[^@.]+(?:\.[^@.]+)+\z")


def base_spans(text: Column) -> Column:
    """Valid matches of all kinds as ``start, rank, end, kind, value``, in order of
    start and kind."""

    def of_kind(rank: int, kind: str) -> Column:
        spans = matches(text, PATTERNS[kind])
        if kind != "email":
            spans = F.filter(spans, lambda s: valid(kind, s["value"]))
        hint = F.contains(text, F.lit(HINTS[kind])) if kind in HINTS else text.rlike("[0-9]")
        return F.when(hint, F.transform(spans, lambda s: _tagged(s, kind, rank))).otherwise(
            F.expr(f"cast(array() AS {TAGGED})")
        )

    return F.array_sort(F.concat(*(of_kind(rank, kind) for rank, kind in enumerate(KINDS))))


TAGGED = "array<struct<start:int,rank:int,end:int,kind:string,value:string>>"


def _tagged(span: Column, kind: str, rank: int) -> Column:
    return F.struct(
        span["start"].alias("start"),
        F.lit(rank).alias("rank"),
        span["end"].alias("end"),
        F.lit(kind).alias("kind"),
        span["value"].alias("value"),
    )


def with_base(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key, text_hash, base, likely``: the spans of the fixed patterns, and the
    candidates that are one of them or touch none, each with its context."""
    whole = F.coalesce(F.col(text), F.lit(""))

    def of_text(t: Column) -> Column:
        found = F.when(F.contains(t, F.lit("@")), matches(t, EMAIL_LIKE)).otherwise(
            F.expr(f"cast(array() AS {SPANS})")
        )
        found = F.concat(
            found,
            F.when(t.rlike("[0-9]"), matches(t, DIGITS_LIKE)).otherwise(
                F.expr(f"cast(array() AS {SPANS})")
            ),
        )

        def of_base(base: Column) -> Column:
            def candidate(span: Column) -> Column:
                same = F.filter(
                    base, lambda b: (b["start"] == span["start"]) & (b["end"] == span["end"])
                )
                before = F.substring(
                    t,
                    F.greatest(span["start"] - CONTEXT, F.lit(0)) + 1,
                    F.least(span["start"], F.lit(CONTEXT)),
                )
                return F.struct(
                    span["start"].alias("start"),
                    span["end"].alias("end"),
                    span["value"].alias("value"),
                    F.get(same, F.lit(0))["kind"].alias("kind"),
                    F.exists(
                        base, lambda b: (b["start"] < span["end"]) & (b["end"] > span["start"])
                    ).alias("touched"),
                    F.lower(
                        F.regexp_extract(before, r"([^ \t\n\x0B\f\r]+)[ \t\n\x0B\f\r]*\z", 1)
                    ).alias("word"),
                )

            likely = F.filter(
                F.transform(found, candidate), lambda c: c["kind"].isNotNull() | ~c["touched"]
            )
            return F.struct(base.alias("base"), likely.alias("likely"))

        plain = F.struct(F.expr(f"cast(array() AS {TAGGED})").alias("base"), F.expr(f"cast(array() AS {LIKELY})").alias("likely"))
        hint = t.rlike("[0-9@]")
        return F.when(hint, _bound(base_spans(t), of_base)).otherwise(plain)

    return docs.select(
        F.col(key).alias("key"),
        F.xxhash64(F.col(text)).alias("text_hash"),
        _bound(whole, of_text).alias("s"),
    ).select("key", "text_hash", "s.base", "s.likely")


LIKELY = (
    "array<struct<start:int,end:int,value:string,kind:string,touched:boolean,word:string>>"
)


def learnt_values(found: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``kind, value`` of the identifiers that trusted patterns lead to.

    A pattern is a context word with a shape, a shape alone, or a context word alone.
    Patterns and values form a graph. Each round scores a pattern of a kind by the
    share of its values that are known for that kind, and a value by the doubt that
    its trusted patterns leave; values that also pass the kind's check become known.
    """
    shape = F.regexp_replace(F.regexp_replace("value", "[0-9]", "9"), "[^0-9@. ()+/-]+", "a")
    seen = found.select(F.explode("likely").alias("c")).select("c.value", "c.kind", "c.word")
    seen = seen.withColumn("shape", shape).distinct()
    word = F.regexp_replace("word", "[0-9]", "9")
    patterns = F.array(
        F.concat_ws("\n", F.lit("both"), word, "shape"),
        F.concat_ws("\n", F.lit("shape"), "shape"),
        F.concat_ws("\n", F.lit("word"), word),
    )
    edges = store(
        seen.select("value", F.explode(patterns).alias("pattern")).distinct(), "pii-edges"
    )
    seeds = seen.filter("kind IS NOT NULL").select("kind", "value").distinct()
    seeds = store(seeds.withColumn("score", F.lit(1.0)), "pii-seeds")
    sizes = edges.groupBy("pattern").agg(F.count("*").alias("n"))
    known = seeds
    for _ in range(rounds):
        hits = edges.join(known, "value").groupBy("kind", "pattern")
        scored = hits.agg(F.sum("score").alias("known")).join(sizes, "pattern")
        trusted = scored.filter((F.col("known") >= SUPPORT) & (F.col("known") >= PRECISION * F.col("n")))
        trusted = trusted.select("kind", "pattern", (F.col("known") / F.col("n")).alias("p"))
        led = edges.join(trusted, "pattern").join(seeds.select("kind", "value"), ["kind", "value"], "left_anti")
        doubt = F.exp(F.sum(F.log(1.0 - F.least("p", F.lit(0.99)))))
        led = led.groupBy("kind", "value").agg(doubt.alias("doubt"))
        check = F.lit(False)
        for kind in KINDS:
            check = F.when(F.col("kind") == kind, valid(kind, F.col("value"))).otherwise(check)
        new = led.filter((F.col("doubt") <= DOUBT) & check)
        new = new.select("kind", "value", (1.0 - F.col("doubt")).alias("score"))
        known = store(seeds.unionByName(new), "pii-known")
    return known.join(seeds.select("kind", "value"), ["kind", "value"], "left_anti").select(
        "kind", "value"
    )


def personal_data(
    docs: DataFrame, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS
) -> DataFrame:
    """``key, text_hash, base, spans`` of every row: the spans of the fixed patterns,
    and these with the learnt ones, each ``start, rank, end, kind, value`` in code
    points and in order of start and kind.

    Null texts are empty and have none; null keys are told apart by their texts;
    repeated rows get the same spans each; other columns are not read. An empty
    table gives no rows.
    """
    found = store(with_base(docs, key, text), "pii-spans")
    values = learnt_values(found, rounds)
    open_ones = found.select(
        "key", "text_hash", F.explode(F.filter("likely", lambda c: c["kind"].isNull())).alias("c")
    ).select("key", "text_hash", "c.start", "c.end", "c.value")
    rank = F.lit(0)
    for at, kind in enumerate(KINDS):
        rank = F.when(F.col("kind") == kind, at).otherwise(rank)
    met = open_ones.join(values, "value").select(
        "key", "text_hash", F.struct("start", rank.alias("rank"), "end", "kind", "value").alias("s")
    )
    met = met.groupBy("key", "text_hash").agg(F.collect_set("s").alias("learnt"))
    met = met.select(
        F.col("key").alias("m_key"), F.col("text_hash").alias("m_hash"), "learnt"
    )
    same = F.col("key").eqNullSafe(F.col("m_key")) & (F.col("text_hash") == F.col("m_hash"))
    # equal texts under null keys are one group above, and get the same spans here
    spans = F.when(
        F.col("learnt").isNotNull(), F.array_sort(F.concat("base", "learnt"))
    ).otherwise(F.col("base"))
    return found.join(met, same, "left").select("key", "text_hash", "base", spans.alias("spans"))


def spelled(spans: str) -> Column:
    """``kind:start:end`` of the spans, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def masked(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with every span replaced by ``[KIND]``; overlapping spans become
    one, named after the first. Other columns stay, null texts stay null."""
    spans = personal_data(docs, key, text).filter(F.size("spans") > 0)
    spans = spans.select(
        F.col("key").alias("__key"), F.col("text_hash").alias("__hash"), F.col("spans").alias("__spans")
    ).dropDuplicates(["__key", "__hash"])
    t = F.col(text)
    empty = F.struct(F.lit(0).alias("at"), F.expr("cast(array() AS array<string>)").alias("out"))

    def step(state: Column, span: Column) -> Column:
        gap = F.substring(t, state["at"] + 1, span["start"] - state["at"])
        tag = F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]"))
        inside = span["start"] < state["at"]
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(inside, state["out"])
            .otherwise(F.concat(state["out"], F.array(gap, tag)))
            .alias("out"),
        )

    rebuilt = _bound(
        F.aggregate("__spans", empty, step),
        lambda s: F.concat(
            F.array_join(s["out"], ""), F.substring(t, s["at"] + 1, F.length(t))
        ),
    )
    same = docs[key].eqNullSafe(spans["__key"]) & (F.xxhash64(docs[text]) == spans["__hash"])
    joined = docs.join(spans, same, "left")
    return joined.withColumn(
        text, F.when(F.col("__spans").isNull(), t).otherwise(rebuilt)
    ).select(*[F.col(c) for c in docs.columns])

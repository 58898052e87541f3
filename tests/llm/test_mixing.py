"""The mix against a queue served document by document in plain Python."""

import hashlib
import random
import re
from collections import defaultdict
from fractions import Fraction

import pytest

from reachgrid.llm import mixing, ranges

from .cases import awkward, frame, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def size_of(text):
    return len(WORD.findall(text or ""))


def brute_targets(sizes, pattern, share, most):
    """Shares by weight; what is above the limit is cut and shared out again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: pattern[i % len(pattern)] for i, s in enumerate(order)}
    target, left, free = {}, Fraction(share) * sum(sizes.values()), set(order)
    while free:
        total = sum(weight[s] for s in free)
        above = {s for s in free if left * weight[s] / total > most * sizes[s]}
        if not above:
            target |= {s: left * weight[s] / total for s in free}
            break
        for s in above:
            target[s] = Fraction(most * sizes[s])
            left -= target[s]
        free -= above
    return target, weight


def brute_mix(rows, pattern=(3, 1, 2), share=1.5, most=2):
    """Key, size, words taken and place in the mix of every row."""
    queues = defaultdict(list)
    for key, text, source in rows:
        place = hashlib.md5(("" if key is None else str(key)).encode()).hexdigest()
        queues[source].append((place, key is not None, key or 0, size_of(text)))
    sizes = {s: sum(x[3] for x in q) for s, q in queues.items()}
    target, weight = brute_targets(sizes, pattern, share, most)
    served = []
    for source, queue in queues.items():
        at, queue = 0, sorted(queue)
        for n in range(most):
            for i, x in enumerate(queue):
                if i == 0 or x != queue[i - 1]:  # equal rows are served as one
                    end = at + x[3] * queue.count(x)
                taken = max(0, min(x[3], int(target[source]) - at))
                at += x[3]
                rank = (Fraction(end, weight[source]), source is None, source or "", n, *x, i)
                served.append((rank, source, i, taken))
    found = {(s, i): [0, None] for _, s, i, _ in served}
    total = 0
    for _, source, i, taken in sorted(served, key=lambda s: s[0]):
        entry = found[source, i]
        if taken and entry[1] is None:
            entry[1] = total
        entry[0] += taken
        total += taken
    out = []
    for source, queue in queues.items():
        for i, (_, known, key, size) in enumerate(sorted(queue)):
            out.append((key if known else None, source, size, *found[source, i]))
    return out, target


def spelled(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


def compare(spark, rows, **how):
    docs = frame(spark, [(k, t, s, *[None] * 9) for k, t, s in rows])
    got = mixing.mix(docs.repartition(5), how.pop("pattern", (3, 1, 2)), **how).collect()
    expected, target = brute_mix(rows, **how)
    assert spelled((r.key, r.source, r.size, r.taken, r.position) for r in got) == spelled(
        (k, s, n, t, p) for k, s, n, t, p in expected
    )
    for r in got:
        assert r.target == pytest.approx(float(target[r.source]))
        assert 0 <= r.taken <= how.get("most", 2) * r.size
    return got, target


def test_awkward_documents(spark):
    compare(spark, [(k, t, s) for k, t, s, *_ in awkward()])


def test_mix_equals_queues_served_in_turn(spark, monkeypatch):
    monkeypatch.setattr(ranges, "RANGE_ROWS", 40)
    rng = random.Random(4)
    sources = ["a", "b", "c", "d", "e", None, "", "é"]
    rows = [
        (i, words(i, rng.choice([0, 1, 7, 60, 400])), rng.choice(sources) if i % 3 else "hot")
        for i in range(400)
    ]
    got, target = compare(spark, rows)
    for source, goal in target.items():
        taken = sum(r.taken for r in got if r.source == source)
        assert goal - 1 < taken <= goal
    again = mixing.mix(
        frame(spark, [(k, t, s, *[None] * 9) for k, t, s in reversed(rows)]).repartition(2),
        (3, 1, 2),
    ).collect()
    assert spelled(map(tuple, again)) == spelled(map(tuple, got))


def test_a_third_of_all_rows_are_equal(spark, monkeypatch):
    monkeypatch.setattr(ranges, "RANGE_ROWS", 16)
    rows = [(7, "one two three", "a")] * 60 + [(i, words(i, 5), "b") for i in range(120)]
    compare(spark, rows)


def test_other_shares(spark):
    rows = [(i, words(i, i % 9), "abc"[i % 3]) for i in range(90)]
    compare(spark, rows, share=0.5, most=1)
    compare(spark, rows, share=2.75, most=3)


def test_weights_by_name(spark):
    rows = [(i, "w " * 10, "abc"[i % 3], *[None] * 9) for i in range(90)]
    weights = spark.createDataFrame([("a", 1), ("b", 3)], "source string, weight int")
    got = mixing.mix(frame(spark, rows), weights, share=1).collect()
    taken = {s: sum(r.taken for r in got if r.source == s) for s in "abc"}
    assert taken == {"a": 300, "b": 600, "c": 0}  # b stops at twice its 300 words


def test_no_documents(spark):
    assert mixing.mix(frame(spark, []), (3, 1, 2)).count() == 0
    empty = mixing.mix(frame(spark, [(1, None, "a", *[None] * 9)]), (3, 1, 2)).collect()
    assert [(r.taken, r.target, r.position) for r in empty] == [(0, 0.0, None)]

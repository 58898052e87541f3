import base64
import hashlib
import random

from pyspark.sql import functions as F

from reachgrid.llm import warc

PAGES = [
    (3, "https://b.example.com/x?q=1#top", "<p>a</p>"),
    (1, "http://user@B.example.com:80/x?q=1", "<p>a</p>"),
    (2, None, None), (4, "http://a.example.org/", ""), (4, "http://a.example.org/", ""),
    (None, "x\r\ny: z", "<p>a</p>"), (None, "u", "only"), (None, "u", "only"),
    (9, "http://c.example/é", "Größe 漢" * 50_000), (10, "", "\r\n\r\nHTTP"),
]
SCHEMA = "page_id long, url string, html string, sha string, first long, run int"


def brute(pages, min_bytes=0):
    first = {}
    for key, _, html in pages:
        data = (html or "").encode()
        if key is not None:
            first[data] = min(first.get(data, key), key)
    out = []
    for key, _, html in pages:
        data = (html or "").encode()
        to = first.get(data)
        again = to is not None and key != to and len(data) >= min_bytes
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((key, len(data), digest, "revisit" if again else "response", to if again else None))
    return sorted(out, key=repr)


def table(spark, pages=PAGES):
    return spark.createDataFrame([(*p, None, None, None) for p in pages], SCHEMA).repartition(3)


def test_archives(spark, tmp_path):
    for n, least in enumerate((0, 5)):
        index = warc.archive(table(spark), str(tmp_path / str(n)), min_bytes=least)
        rows = warc.read_archives(index).collect()
        got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows]
        assert sorted(got, key=repr) == brute(PAGES, least)
    assert {bytes(r.payload).decode() for r in rows if r.page_id == 9} == {PAGES[8][2]}
    assert warc.read_archives(warc.archive(table(spark, []), str(tmp_path / "none"))).count() == 0


def test_the_index_is_in_order(spark, tmp_path):
    rng = random.Random(1)
    pages = [(i, f"http://h{rng.randrange(5)}.example/{rng.randrange(9)}", str(i)) for i in range(300)]
    index = warc.archive(table(spark, pages), str(tmp_path))
    rows = index.withColumn("part", F.input_file_name()).collect()
    keys = {}
    for r in rows:
        keys.setdefault(r.part.split("part-")[1], []).append((r.url_key, r.captured, r.page_id))
    merged = [k for part in sorted(keys) for k in keys[part]]
    assert merged == sorted(merged) and len(merged) == 300


def test_url_keys(spark):
    df = spark.createDataFrame([(p[1],) for p in PAGES[:2]], "u string")
    assert {r[0] for r in df.select(warc.url_key(F.col("u"))).collect()} == {"com,example,b)/x?q=1"}


def test_loser_tree():
    rng = random.Random(4)
    for k in range(12):
        runs = [sorted((rng.randrange(40),) for _ in range(rng.randrange(20))) for _ in range(k)]
        merged = [runs[run][at] for run, at in warc.LoserTree(runs)]
        assert merged == sorted(x for run in runs for x in run)

"""Top-k search and WARC archives by hand, registered queries against their SQL, and the pipeline."""

import base64
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from serieskit.llm import ORACLES, QUERIES, max_score, warc
from serieskit.llm.common import scratch, stored
from tests.llm.data import documents, frame
from tools.compare import compare, connect

SCALE = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    fine, text = compare(spark, connect(SCALE), name, QUERIES[name], ORACLES[name], SCALE)
    assert fine, text


def search_by_hand(rows, k):
    sound = [(i, np.floor(64 * np.array(v, float)).astype(int)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = max(len(v) for _, v in sound)
    sound = [(i, np.pad(v, (0, width - len(v)))) for i, v in sound]
    out = set()
    for i, q in {(i, tuple(v)) for i, v in sound if i % 20 == 0}:
        best = sorted((-int(np.dot(q, v)), j) for j, v in sound if j != i)[:k]
        out |= {(i, n + 1, j, -s) for n, (s, j) in enumerate(best)}
    return out


@pytest.mark.parametrize("shard_rows", [8192, 40])
def test_top_k(spark, shard_rows):
    rng = random.Random(shard_rows)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(12)]) for i in range(-40, 300)]
    rows += [(1000 + i, rows[7][1]) for i in range(30)]
    rows += [(2000, None), (2020, [0.5, None]), (2040, [float("nan")] * 12), (2060, [float("inf")] + [0.0] * 11), (2080, []), (2100, [1.0, -2.0]), (None, rows[0][1]), rows[3]]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("own"))
    exact = [(r.vec_id, r.embedding) for r in table.collect()]
    vectors = max_score.quantized(table)
    got = max_score.search(vectors.where("vec_id % 20 = 0"), vectors, 20, shard_rows, 7).collect()
    assert {tuple(r) for r in got} == search_by_hand(exact, 20) and len(got) == len(search_by_hand(exact, 20))
    assert max_score.search(vectors.limit(0), vectors).count() == 0 and max_score.search(vectors, vectors.limit(0)).count() == 0


def test_top_k_of_large_numbers(spark):
    rows = [(i, [float(2**23 + 7 * i * j % 11) for j in range(4)]) for i in range(30)]
    vectors = max_score.quantized(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = {tuple(r) for r in max_score.search(vectors.where("vec_id % 20 = 0"), vectors).collect()}
    exact = {i: [int(64 * x) for x in v] for i, v in rows}
    assert got == {
        (q, n + 1, j, -s) for q in (0, 20) for n, (s, j) in enumerate(sorted((-sum(a * b for a, b in zip(exact[q], v)), j) for j, v in exact.items() if j != q)[:20])
    }


def test_archives(spark):
    long = "é\r\n\r\nWARC/1.1\r\n" * 4000
    rows = [(1, "u1", "same"), (2, "u\r\n2", "same"), (3, None, "same"), (3, None, "same"), (4, "u", None), (5, "u", ""), (6, "u", long), (7, "u", "one"), (None, "u", "same"), (None, "u", "lone")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit("own")).repartition(3)
    path = scratch(spark, "warc")
    warc.write_archives(pages, path)
    records = stored(warc.read_archives(spark, path, with_payload=True), "records")
    assert all(r.sound for r in records.collect())
    got = sorted(str((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, bytes(r.payload))) for r in warc.join_revisits(records).collect())
    last = {h or "": max([i for i, _, g in rows if (g or "") == (h or "") and i is not None], default=None) for _, _, h in rows}
    want = []
    for i, _, h in rows:
        data, first = (h or "").encode(), last[h or ""]
        revisit = first is not None and first != i
        want.append(str((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", first if revisit else None, data)))
    assert got == sorted(want)
    assert {r.url for r in records.collect() if r.page_id == 2} == {"u%0D%0A2"}
    only_large = warc.round_trip(spark, pages, min_bytes=4).where("record_type = 'revisit'").collect()
    assert sorted(str(r.page_id) for r in only_large) == ["1", "2", "None"]
    assert warc.round_trip(spark, pages.limit(0)).count() == 0


def test_stages(spark):
    """Every stage but the last keeps the columns; each works on all that its predecessor kept."""
    rows = documents()
    benchmark = spark.read.parquet(f"{SCALE}/benchmark.parquet").first().text
    docs = frame(spark, rows + [(7000, f"before {benchmark} after"), (7001, "worthless idiot, you moron, you pathetic loser scum " * 3)])
    seen, columns = [docs.count()], docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SCALE), name)
        seen.append(docs.count())
        if name != "pieces":
            assert docs.columns == columns, name
        if name == "decontaminate":
            assert 7000 not in {r.doc_id for r in docs.collect()}
    assert seen[0] >= seen[1] > seen[2] == seen[3] > seen[4] == seen[5]
    assert docs.where("not round_trip").count() == 0
    empty = frame(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        empty = stored(stage(spark, empty, SCALE), "empty")
    assert empty.count() == 0

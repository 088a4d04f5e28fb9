import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from plumage.llm import importance
from plumage.llm.common import land
from plumage.llm.queries import ORACLE

SF001 = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def grams(text):
    words = WORD.findall(lower(text))
    runs = [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), Counter(zlib.crc32(r.encode()) % 10000 for r in runs)


def brute(rows, target, percent, min_words=20):
    corpus, wanted = Counter(), Counter()
    found = [(i, *grams(text)) for i, text in rows]
    for _, _, bag in found:
        corpus.update(bag)
    for text in target:
        wanted.update(grams(text)[1])
    s_all, t_all = corpus.total() + 10000, wanted.total() + 10000
    out = []
    for i, n_words, bag in found:
        weight = sum(n * math.floor(1000 * math.log((wanted[b] + 1) * s_all / ((corpus[b] + 1) * t_all)))
                     for b, n in bag.items())
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, n_words, bag.total(), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    k = percent * len(able) // 100
    rank = {id(r): n for n, r in enumerate(able[:k], 1)}
    return sorted(((*r, rank.get(id(r))) for r in out), key=repr)


def test_odd_rows_against_brute_force(spark, odd):
    target = spark.createDataFrame([("the quick brown fox", 1), (None, 2), ("", 3)], "text string, doc_id int")
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    for percent, least in ((50, 5), (100, 1), (0, 1)):
        got = importance.resample(odd, target, percent, min_words=least)
        assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, ["the quick brown fox"], percent, least)


def test_empty_tables(spark, odd, empty):
    assert importance.resample(empty, odd).collect() == []
    assert len(importance.resample(odd, empty).collect()) == odd.count()


def test_long_words_and_long_texts(spark):
    rows = [(1, "x" * 100_000 + " é漢字 " + "ab" * 40), (2, "a b " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    got = importance.resample(docs, docs, 100, min_words=1)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, [t for _, t in rows], 100, 1)


@pytest.mark.parametrize("k", [1, 2, 37, 199, 200])
def test_cutoff_among_ties(spark, k):
    """Many equal scores, ids and NULL ids: exactly k rows, in order."""
    rows = land(spark.range(200).select((F.col("id") % 3).alias("score"), F.when(F.col("id") % 5 > 0, F.col("id") % 7).alias("id"),
                                        F.col("id").alias("uid")), "ties")
    want = sorted(rows.collect(), key=lambda r: (-r.score, r.id is None, r.id or 0, r.uid))[:k]
    got = sorted(importance.highest(rows, k).collect(), key=lambda r: r["rank"])
    assert [(r.score, r.id, r.uid) for r in got] == [tuple(r) for r in want]
    assert [r["rank"] for r in got] == list(range(1, k + 1))


@pytest.mark.parametrize("accuracy", [2, 3, 10])
def test_bracket_is_widened_until_it_holds_the_cutoff(spark, accuracy):
    rows = land(spark.range(5000).select(F.pmod(F.xxhash64("id"), F.lit(10**6)).alias("score")), "bracket-test")
    scores = sorted((r.score for r in rows.collect()), reverse=True)
    for k in (1, 250, 2500, 5000):
        found = importance.bracket(rows, k, 5000, accuracy)
        assert found.low <= scores[k - 1] <= found.high
        assert found.above == sum(s > found.high for s in scores)
        assert found.inside == sum(found.low <= s <= found.high for s in scores)


def test_query_matches_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    got = E.queries()["op11_importance"](spark, SF001)
    want = con.execute(f"select {', '.join(got.columns)} from ({ORACLE['op11_importance']})").fetchall()
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)

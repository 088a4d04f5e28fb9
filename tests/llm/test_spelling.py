import random
import re
import zlib
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from plumage.llm import spelling
from plumage.llm.common import land
from plumage.llm.queries import ORACLE

SF001 = "/root/testdata/sf0.001"


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_words(rows, noise, least=3):
    count = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if noise and h % noise == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 5:
                count[run] += 1
    return {w: n for w, n in count.items() if n >= least}


def brute_groups(words):
    form, out = {}, []
    for w, n in words.items():
        others = [v for v in words if near(w, v)]
        best = min(others, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 2 * n:
            form[w] = best
        out.append((w, n, len(others)))
    rows = []
    for w, n, n_near in out:
        root = w
        while root in form:
            root = form[root]
        rows.append((w, form.get(w), root, n, n_near, words.get(form.get(w))))
    return sorted(rows, key=repr)


def random_words(seed, letters, n, longest):
    r = random.Random(seed)
    return {"".join(r.choice(letters) for _ in range(r.randint(5, longest))): r.randint(3, 60) for _ in range(n)}


@pytest.mark.parametrize("letters,n,longest", [("ab", 150, 12), ("abcé÷ÿ", 600, 7), ("a", 30, 40)])
def test_near_words_against_brute_force(spark, letters, n, longest):
    words = random_words(n, letters, n, longest)
    table = land(spark.createDataFrame(list(words.items()), "word string, n long"), "words-test")
    want = {w: sum(near(w, v) for v in words) for w in words}
    for split in (spelling.SPLIT, 7):  # 7: every key is cut into many parts
        got = spelling.near_words(table, split).collect()
        assert {r.word: r.n_near for r in got} == want and len(got) == len(words)
        for r in got:
            best = min((v for v in words if near(r.word, v)), key=lambda v: (-words[v], v), default=None)
            assert (r.best, r.best_n, r.n) == (best, words.get(best), words[r.word])


def test_one_very_long_word():
    long = b"xyz" * 20_000
    index = spelling.Index(sorted([long, long[:-1], b"abcde", b"abcdef"]))
    flat, start, length = spelling._flat([b"abcde"])
    assert [x.tolist() for x in spelling.search(index, flat, start, length, length // 2)] == [[], []]
    flat, start, length = spelling._flat([b"abcee"])
    assert [x.tolist() for x in spelling.search(index, flat, start, length, length)] == [[0], [0]]


def test_groups_of_odd_rows(spark, odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    for noise in (0, 2):
        got = spelling.group_variants(odd, noise=noise, min_count=1)
        assert sorted(map(tuple, got.collect()), key=repr) == brute_groups(brute_words(rows, noise, 1))


def test_chains_and_ties(spark):
    texts = ["mellow " * 40, "yellow " * 20, "yellov " * 10, "fellov " * 5, "fellow " * 40, "Yéllow " * 3, "hello " * 3, "jello " * 3]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    got = sorted(map(tuple, spelling.group_variants(docs).collect()), key=repr)
    assert got == brute_groups(brute_words(enumerate(texts), 0))
    assert ("yellov", "yellow", "fellow", 10, 2, 20) in got


def test_empty_tables(spark, empty):
    assert spelling.group_variants(empty).collect() == []
    assert spelling.group_variants(spark.createDataFrame([(1, None), (2, "ab cd")], "doc_id int, text string")).collect() == []


def test_short_words_are_refused(empty):
    with pytest.raises(ValueError):
        spelling.group_variants(empty, min_length=4)


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{SF001}/documents.parquet')")
    got = E.queries()["op12_spelling"](spark, SF001)
    want = con.execute(f"select {', '.join(got.columns)} from ({ORACLE['op12_spelling']})").fetchall()
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)

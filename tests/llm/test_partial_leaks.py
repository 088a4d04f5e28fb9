"""Parts of a test item that leaked."""

import random

from plumage.llm import decontaminate


def test_part_of_an_item_leaks(spark):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    filler = lambda n: [word() for _ in range(n)]
    item = filler(59)
    docs = [(1, filler(40) + item[20:45] + filler(40)), (2, filler(40) + item[5:15] + filler(40)), (3, filler(90))]
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in docs], "doc_id long, text string")
    items = spark.createDataFrame([(9, " ".join(item))], "item_id long, text string")
    got = [tuple(r) for r in decontaminate.find_leaks(frame, items).collect()]
    assert got == [(1, 9, 50 / 118, 40, 65)]

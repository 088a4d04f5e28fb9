"""The corpus pipeline on a small table with planted cases, stage by stage and as a whole."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from plumage.llm import quality

WORDS = ("and the river stone over under house garden walk light morning evening answer question table window bridge "
         "market road winter summer letter music paper number silver copper forest island mountain valley harbour").split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    rng = random.Random(8)
    texts = {i: sentence(rng, rng.randrange(60, 140)) for i in range(150)}
    items = {k: " ".join(f"{w}{k}" for w in rng.sample(WORDS, 25)) for k in range(3)}
    for i in (3, 40, 77):  # a benchmark item inside
        texts[i] = f"{texts[i]} {items[i % 3]} {sentence(rng, 20)}"
    for copy, of in ((160, 5), (161, 5), (162, 9)):
        texts[copy] = texts[of]
    for copy, of in ((170, 20), (171, 21)):  # one word put behind: more than 85 % of the shingles stay
        texts[copy] = texts[of] + " harbour"
    junk = range(180, 186)
    for i in junk:
        texts[i] = "".join(chr(rng.randrange(33, 120)) for _ in range(400))
    texts |= {190: None, 191: "", 192: " \n\t", 193: "walk"}
    folder = str(tmp_path_factory.mktemp("sf"))
    rows = [(i, t, "en", "web", len(t or "")) for i, t in texts.items()]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(150)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(items.items()), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, texts, set(junk)


def shingles(text):
    words = (text or "").lower().split()
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def exact_kept(ids, texts):
    last = {}
    for i in ids:
        last[texts[i] or ""] = max(last.get(texts[i] or "", -1), i)
    return set(last.values())


def near_kept(ids, texts):
    root = {i: i for i in ids}
    sets = {i: shingles(texts[i]) for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a in ids:
        for b in ids:
            shared = len(sets[a] & sets[b])
            if a < b and sets[a] and sets[b] and 100 * shared >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i for i in ids if find(i) == i}


def test_every_stage_and_the_whole(spark, planted):
    folder, texts, junk = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    trusted = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id")
    wanted = {r.doc_id for r in quality.score_quality(docs, trusted).where("keep").collect()}
    assert not wanted & junk and len(wanted & set(range(150))) >= 145
    kept = docs
    expected = [lambda ids: wanted, lambda ids: exact_kept(ids, texts), lambda ids: near_kept(ids, texts),
                lambda ids: ids - {3, 40, 77}]
    ids = set(texts)
    for (name, stage), want in zip(corpus_pipeline.STAGES, expected):
        kept = stage(spark, kept, folder)
        assert kept.columns == docs.columns
        rows = kept.collect()
        ids = want(ids)
        assert {r.doc_id for r in rows} == ids and len(rows) == len(ids), name
        assert all(r.text == texts[r.doc_id] for r in rows)
        kept = spark.createDataFrame(rows, SCHEMA)
    pieces = corpus_pipeline.run(spark, folder).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {i: [*tokenizer.encode(texts[i] or "", add_special_tokens=False).ids, 1] for i in ids}
    assert {r.doc_id for r in pieces} == ids and sum(r.length for r in pieces) == sum(map(len, want.values()))
    for r in pieces:
        part = np.array(want[r.doc_id][r.start:r.start + r.length], "<u4").tobytes()
        assert zlib.crc32(part) == r.ids_crc32 and r.doc_tokens == len(want[r.doc_id])
    filled = Counter()
    for r in sorted(pieces, key=lambda r: (r.sequence_id, r.offset)):
        assert filled[r.sequence_id] == r.offset
        filled[r.sequence_id] += r.length
    assert all(filled[s] == 2048 for s in filled if s != max(filled))


def test_empty_tables(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).collect() == []


def test_stages_keep_odd_rows(spark, odd, planted):
    """Repeated rows, NULL ids, clashing columns: no stage fails, rows without an id are never dropped."""
    folder, _, _ = planted
    rows = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, rows, folder)
        assert rows.columns == odd.columns, name
    kept = rows.collect()
    assert [r.text for r in kept if r.doc_id is None] == ["some text without an id, in a line of its own"]
    assert corpus_pipeline.STAGES[-1][1](spark, rows, folder).count() >= len(kept)

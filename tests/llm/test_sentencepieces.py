import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

import __spark_entry__ as E
from plumage.llm import sentencepieces as sp

SF001 = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
TABLES = sp.load_tables(sp.read_model(PATH))
PIECES = [LIBRARY.id_to_piece(i) for i in range(259, 32000)]


def check(texts):
    ids, bounds = sp.encode_flat(pa.array(texts, pa.string()), TABLES)
    decoded = sp.decode_flat(ids, bounds, TABLES).to_pylist()
    for i, (text, want) in enumerate(zip(texts, LIBRARY.encode([t or "" for t in texts]))):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == want, repr(text)
        assert decoded[i] == LIBRARY.decode(want), repr(text)


def test_fixed_cases():
    check([None, "", "a", " ", "  a  b ", "▁", "▁▁a b", "\x00", "tab\tline\n\n", "é漢字😀▁́", "a" * 999, "ab" * 500])


def test_runs_of_spaces():
    check([" " * n + end for n in range(70) for end in ("", "the", "a b" + " " * n)])


@pytest.mark.parametrize("seed", range(4))
def test_random_texts(seed):
    r = random.Random(seed)
    alphabets = ["abcdefghijklmnopqrstuvwxyz", "abcAB 12 ", "   a", "\n\t é ß ü 漢字 😀▁́", "aaab", "0123456789.,-"]
    texts = ["".join(r.choice(r.choice(alphabets)) for _ in range(r.randint(0, 60))) for _ in range(1500)]
    texts += ["".join(r.choice(a) for _ in range(r.randint(0, 200))) for a in alphabets for _ in range(200)]
    texts += ["".join(r.choice(PIECES) for _ in range(r.randint(0, 20))).replace("▁", r.choice(["", " ", "▁"]))
              for _ in range(2500)]
    check(texts)


def test_very_long_words():
    r = random.Random(9)
    check([" " * 300_000, "z" * 300_000, "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(300_000)),
           "".join(r.choice(PIECES) for _ in range(60_000)).replace("▁", "")])


def test_decoding_of_any_ids():
    r = random.Random(5)
    rows = [[r.choice([r.randint(0, 260), r.randint(0, 31999), r.randint(35, 258)]) for _ in range(r.randint(0, 12))]
            for _ in range(6000)]
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in rows])])
    got = sp.decode_flat(np.array([i for x in rows for i in x]), bounds, TABLES).to_pylist()
    assert got == [LIBRARY.decode(x) for x in rows]


def test_waiting_occurrences():
    """A merge after which a pair as good would come first holds back later occurrences of its segment."""
    size = 6  # symbols a b c, pieces ab (rank 3), abc? -> see ranks below
    ranks = np.array([9, 9, 9, 3, 1, 9], np.int32)  # 3 = "ab", 4 = "aba", better than "ab"
    tables = sp.Tables(None, None, np.array([0 * size + 1, 3 * size + 0]), np.array([3, 4], np.int32), ranks,
                       None, None, [], None, None, None, None)
    start = np.array([True, False, False, False])
    ids, left = sp._merge_rounds(np.array([0, 1, 0, 1], np.int32), start, tables)
    assert ids[left].tolist() == [4, 1]  # aba + b, as one merge at a time gives; both at once would give ab + ab


def test_odd_rows_and_empty_table(spark, odd, empty):
    got = sp.encode_and_decode(odd, PATH).collect()
    want = [(r.doc_id, LIBRARY.encode(r.text or "")) for r in odd.collect()]
    assert sorted(((r.doc_id, r.ids) for r in got), key=repr) == sorted(want, key=repr)
    assert sorted((r.decoded for r in got)) == sorted(LIBRARY.decode(i) for _, i in want)
    assert sp.encode_and_decode(empty, PATH).collect() == []
    back = sp.decode(sp.encode(odd, PATH), PATH).collect()
    assert sorted((r.doc_id, r.decoded) for r in back if r.doc_id) == sorted((r.doc_id, r.decoded) for r in got if r.doc_id)


def test_decoding_of_no_ids(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [450])], "doc_id int, ids array<int>")
    assert sorted(map(tuple, sp.decode(rows, PATH).collect())) == [(1, ""), (2, ""), (3, LIBRARY.decode([450]))]


def test_other_models_are_refused():
    from sentencepiece import sentencepiece_model_pb2

    spec = sentencepiece_model_pb2.ModelProto.FromString(sp.read_model(PATH))
    spec.normalizer_spec.remove_extra_whitespaces = True
    with pytest.raises(ValueError):
        sp.load_tables(spec.SerializeToString())


def test_query_against_the_library(spark):
    rows = E.queries()["op13_sentencepiece"](spark, SF001).collect()
    texts = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()
    want = []
    for r in texts:
        ids = LIBRARY.encode(r.text)
        want.append((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()))
    assert sorted(map(tuple, rows)) == sorted(want)

"""Each operator against a brute-force version, on odd rows and on the empty table."""

import hashlib
import json
import math
import random
import re
import time
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as E
from plumage.llm import decontaminate, exactdup, lines, neardup, packing, pii, quality, sharding, suffix, toxicity
from plumage.llm import groups as G

SF001 = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def odd_texts(odd):
    return [(r.doc_id, r.text or "") for r in odd.select("doc_id", "text").collect()]


def documents(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet")


def test_every_operator_is_registered():
    names = E.queries()
    assert [sum(k.startswith(f"op{n}_") for k in names) for n in range(1, 11)] == [1] * 10
    assert "pipeline" in names


@pytest.mark.parametrize("key", ["op2_line_dedup", "op7_minhash", "op8_suffix_dedup", "op9_exact_dedup"])
def test_query_matches_sql(spark, key):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{SF001}/documents.parquet')")
    want = con.execute(E.oracle_sql()[key]).df()
    got = E.queries()[key](spark, SF001).toPandas()[list(want.columns)]
    by = lambda d: sorted(map(tuple, d.itertuples(index=False)))
    assert by(got) == by(want)


# --- 1 sharding ---------------------------------------------------------------

def test_longest_first_heap():
    sizes = [(s, (s, i)) for i, s in enumerate([7, 7, 6, 5, 4, 4, 3, 1])]
    placed = sharding.schedule(sizes, 3)
    loads = [0, 0, 0]
    for size, name in sorted(sizes, key=lambda x: (-x[0], x[1])):
        assert loads[placed[name]] == min(loads)
        loads[placed[name]] += size
    assert max(loads) <= 4 / 3 * -(-sum(loads) // 3)


def test_sharding_odd_rows(odd, empty):
    got = sharding.shard_longest_first(odd, 4).collect()
    want = sorted((len(t.encode()) + 1, zlib.crc32(t.encode())) for _, t in odd_texts(odd))
    assert sorted((r["size"], r["text_crc32"]) for r in got) == want
    by_text = {}
    for r in got:
        assert by_text.setdefault(r["text_crc32"], r["shard"]) == r["shard"]
    for s in range(4):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))
    assert rows_of(sharding.shard_longest_first(empty, 4)) == []


def test_slots_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SLOT_ROWS", 5)
    got = sharding.shard_longest_first(documents(spark), 4).collect()
    for s in range(4):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))
    loads = [sum(r["size"] for r in got if r["shard"] == s) for s in range(4)]
    assert max(loads) - min(loads) < 0.01 * sum(loads)


# --- 2 lines --------------------------------------------------------------------

def brute_lines(docs, min_chars=20, min_docs=3):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").encode().lower().decode()
    held = {}
    for i, t in docs:
        for line in t.split("\n"):
            if len(key(line)) >= min_chars and i is not None:
                held.setdefault(key(line), set()).add(i)
    out = []
    for i, t in docs:
        kept = [x for x in t.split("\n") if i is None or len(held.get(key(x), ())) < min_docs or max(held[key(x)]) == i]
        out.append((i, len(t.split("\n")), len(t.split("\n")) - len(kept), "\n".join(kept)))
    return out


def test_lines_odd_rows(odd, empty):
    none_first = lambda r: tuple((x is not None, x) for x in r)
    got = sorted(rows_of(lines.drop_repeated_lines(odd)), key=none_first)
    assert got == sorted(brute_lines(odd_texts(odd)), key=none_first)
    assert rows_of(lines.drop_repeated_lines(empty)) == []


def test_lines_shared_across_ranges(spark):
    rng = random.Random(1)
    pool = [f"Common line number {k} of the pool" for k in range(4)] + ["short", ""]
    docs = [(i, "\n".join(rng.choice(pool) + rng.choice(["", " ", "\t"]) for _ in range(rng.randrange(6))))
            for i in range(150)]
    got = rows_of(lines.drop_repeated_lines(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)))
    assert sorted(got) == sorted(brute_lines(docs))


# --- 3 personal data --------------------------------------------------------------

FORMS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    twice = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 if v > 9 else v for v in twice) % 10 == 0


def brute_pii(text):
    out = []
    for rank, (kind, form) in enumerate(FORMS.items()):
        for m in re.finditer(form, text):
            digits = re.sub("[^0-9]", "", m.group())
            if {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda: 14 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 10 <= len(digits) <= 15}[kind]():
                out.append((m.start(), rank, m.end(), kind))
    return [(k, s, e) for s, _, e, k in sorted(out)]


def test_pii_forms(spark, odd, empty):
    tricky = ["a@b.c%x@d.e", "x..y@@z.w q@r-.s.t", "1.2.3.4.5 256.1.1.1 001.02.3.255 99999999999.1.1.1",
              "4111 1111 1111 1111, 4111-1111-1111-1112 5500005555555559", "+1 (212) 555-0100. +49", "é𝄞 a@b.co 7.7.7.7",
              "1" * 5000, "a" * 5000 + "@x.y", "+1" + "." * 3000, "a@" + "b." * 3000 + "c"]
    rng = random.Random(2)
    tricky += ["".join(rng.choice("a1@.+- ()25") for _ in range(60)) for _ in range(150)]
    docs = spark.createDataFrame(list(enumerate(tricky)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans if s.kind != "term"]
           for r in pii.sensitive_spans(docs).collect()}
    assert got == {i: brute_pii(t) for i, t in enumerate(tricky)}
    assert len(rows_of(pii.sensitive_spans(odd))) == odd.count()
    assert rows_of(pii.sensitive_spans(empty)) == []


def test_pii_terms_that_disclose(spark):
    docs = [(i, "the agent zebedee uses zeb@secret.org on weekdays") for i in range(4)]
    docs += [(10 + i, f"the agent number {i} works on weekdays") for i in range(40)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    spans = pii.sensitive_spans(frame)
    found = {r.doc_id: {(s.start, s.end, s.action) for s in r.spans if s.kind == "term"} for r in spans.collect()}
    assert found[0] == {(10, 17, "remove"), (18, 22, "remove")}  # zebedee, uses: nowhere else
    assert not any(found[i] for i in found if i >= 10)
    clean = {r.doc_id: r.sanitised for r in pii.sanitise(frame, spans).collect()}
    assert clean[0] == "the agent [TERM] [TERM] [EMAIL] on weekdays" and clean[12] == docs[6][1]


def test_pii_terms_of_an_entity_in_one_document(spark):
    docs = [(0, "the agent zebedee uses zeb@secret.org on weekdays")]
    docs += [(10 + i, f"the agent number {i} works on weekdays") for i in range(40)]
    spans = pii.sensitive_spans(spark.createDataFrame(docs, "doc_id long, text string"))
    found = {r.doc_id: {(s.start, s.end, s.action) for s in r.spans if s.kind == "term"} for r in spans.collect()}
    assert found.pop(0) == {(10, 17, "remove"), (18, 22, "remove")} and not any(found.values())


def brute_terms(docs, alpha=pii.ALPHA):
    n, holds, has, pairs = len(docs), {}, {}, 0
    for i, t in enumerate(docs):
        entities = {(k, t[s:e].lower()) for k, s, e in brute_pii(t)}
        words = {m.group().lower() for m in re.finditer(r"[^\W\d_]{3,}", t)}
        pairs += len(entities) * len(words)
        for e in entities:
            holds.setdefault(e, set()).add(i)
        for w in words:
            has.setdefault(w, set()).add(i)
    chance = alpha / max(pairs, 1)
    share_of = lambda e, d: math.log(len(e & d) * n / (len(e) * len(d))) / math.log(n / len(e))
    bad = {}
    for e in holds.values():
        for w, d in has.items():
            both = len(e & d)
            if both and len(e) < n:
                table = [(both, len(e), len(d)), (len(e) - both, len(e), n - len(d)), (len(d) - both, n - len(e), len(d)),
                         (n - len(e) - len(d) + both, n - len(e), n - len(d))]
                g2 = 2 * sum(o * math.log(o * n / (r * c)) for o, r, c in table if o)
                if math.erfc(math.sqrt(g2 / 2)) <= chance and share_of(e, d) >= pii.GENERALISE:
                    bad.setdefault(w, []).append(e)
    forms = {}
    for w, entities in bad.items():
        worst = max(share_of(e, has[w]) for e in entities)
        sizes = sorted({max(math.ceil(len(w) * part), 3) for part in pii.FORM_PARTS} - {len(w)}, reverse=True)
        for k in sizes if worst < pii.REMOVE else ():
            often = max(len(d) for v, d in has.items() if v.startswith(w[:k]))
            if all(math.log(n / often) / math.log(n / len(e)) < pii.GENERALISE for e in entities):
                forms[w] = w[:k]
                break
    out = []
    for t in docs:
        spans = [(s, e) for _, s, e in brute_pii(t)]
        out.append({(m.start(), m.end(), forms.get(m.group().lower())) for m in re.finditer(r"[^\W\d_]{3,}", t)
                    if m.group().lower() in bad and not any(s <= m.start() and m.end() <= e for s, e in spans)})
    return out


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_pii_terms_over_whole_texts(spark, broadcast):
    rng = random.Random(3)
    pool = [f"w{a}{b}é𝄞{c}rd" for a in "abcdef" for b in "ghijk" for c in "lmnop"]
    filler = lambda n: " ".join(rng.choice(pool) for _ in range(n))
    docs = [filler(rng.randrange(300)) for _ in range(60)]
    docs[0] = f"Zebedee {filler(90)} own@z.org x@y.org {filler(200)} zebedee, quill"
    docs[1] = f"zebedee {filler(40)}"  # names the term, not the entity
    docs[2] = f"a@b.net {filler(30)} x@y.org 9.9.9.9 9.9.9.999 net"
    docs[3], docs[4] = "", None
    for i in range(20, 27):  # an address that a word of its own, and one that other documents have too, give away
        docs[i] += " boss@mail.org quillon cardiology"
    docs[27] += " Cardiology"
    for i in range(30, 50):
        docs[i] += " cardiogram"
    frame = spark.createDataFrame(list(enumerate(docs)) + [(2, docs[2])], "doc_id long, text string").repartition(4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        spans = pii.sensitive_spans(frame)
        got = [(r.doc_id, {(s.start, s.end, s.form) for s in r.spans if s.kind == "term"}) for r in spans.collect()]
        clean = {r.doc_id: r.sanitised for r in pii.sanitise(frame, spans).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    want = brute_terms([d or "" for d in docs] + [docs[2]])
    assert sorted(got, key=repr) == sorted(zip([*range(60), 2], want), key=repr)
    assert clean[20].endswith(" [EMAIL] [TERM] cardi*") and clean[27].endswith(" cardi*")


def test_pii_evidence_grows_with_the_pairs():
    for pairs in (0, 1, 1000, 10**9):
        reach = pii.evidence(pairs)
        assert math.erfc(math.sqrt(reach / 2)) == pytest.approx(pii.ALPHA / max(pairs, 1), rel=1e-6)


def test_pii_planted_terms_precision_and_recall(spark):
    """Nicknames that go with an address of three to six documents each are found; other words are left."""
    rng = random.Random(11)
    pool = [f"{a}{b}{c}" for a in ("bar", "col", "den", "fam", "gor") for b in "aeiou" for c in ("lin", "mot", "nes", "pir", "sud", "tak")]
    docs = [" ".join(rng.choice(pool) for _ in range(rng.randrange(20, 80))) for _ in range(400)]
    secret = {}
    for k in range(20):
        name = "".join(rng.choice("jkqvwxyz") + rng.choice("aeiou") for _ in range(4))
        secret[name] = rng.sample(range(400), rng.randrange(3, 7))
        for i in secret[name]:
            docs[i] += f" mail {k}user@example{k}.org for {name}"
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    found = set()
    for r in pii.sensitive_spans(frame).collect():
        found |= {docs[r.doc_id][s.start:s.end] for s in r.spans if s.kind == "term"}
    hits = found & set(secret)
    assert len(hits) / len(secret) >= 0.95 and len(hits) / len(found) >= 0.95


def test_pii_very_long_texts_take_linear_time(spark):
    """One text of a megabyte with disclosing words all over, and one without."""
    rng = random.Random(4)
    pool = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(400)]
    long = " ".join(rng.choice(pool) if i % 50 else "zebedee" for i in range(150_000))
    docs = [long + " zeb@secret.org", "zebedee zeb@secret.org", "zebedee zeb@secret.org x", long.replace("zebedee", "abba")]
    docs += ["nothing here"] * 30
    began = time.time()
    rows = pii.sensitive_spans(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")).collect()
    terms = {r.doc_id: [(s.start, s.end) for s in r.spans if s.kind == "term"] for r in rows}
    assert {docs[0][s:e] for s, e in terms[0]} == {"zebedee"} and len(terms[0]) == 3000
    assert not terms[3] and time.time() - began < 60


# --- 4 packing ----------------------------------------------------------------------

def test_packing_round_trip(odd, empty):
    whole = Tokenizer.from_file(TOKENIZER)
    got = packing.pack(odd, TOKENIZER, 64).collect()
    want = {}
    for i, t in odd_texts(odd):
        want.setdefault(i, np.array(whole.encode(t, add_special_tokens=False).ids + [1], "<u4"))
    for r in got:
        ids = want[r.doc_id]
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start:r.start + r.length].tobytes())
    spans = sorted((r.sequence_id * 64 + r.offset, r.length) for r in got)
    assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:])) and spans[0][0] == 0
    assert sum(r.length for r in got) == sum(len(want[i]) for i, _ in odd_texts(odd))
    assert rows_of(packing.pack(empty, TOKENIZER, 64)) == []


def test_word_ids_equal_whole_tokenizer(spark):
    table, whole = packing.WordIds(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    texts = [r.text for r in documents(spark).select("text").collect()]
    texts += ["it's We'LL don't 'tis''s", "a\x1cb\x85c\xa0d", "<|endoftext|> x", "ΑΣ İi ½²3", "é́ é", "__a_1__", ""]
    for t in texts:
        assert np.frombuffer(table.encode(t), table.dtype).tolist() == whole.encode(t, add_special_tokens=False).ids


def test_word_ids_of_every_character_below_u0250():
    table, whole = packing.WordIds(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    small = [chr(c) for c in range(0x250)]
    rng = random.Random(6)
    texts = [f"{form.format(c)}" for c in small for form in ("{0}", "a{0}b", "x {0}{0} 1")]
    texts += ["".join(rng.choice(small) for _ in range(rng.randrange(30))) for _ in range(3000)]
    for t, want in zip(texts, whole.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(table.encode(t), table.dtype).tolist() == want.ids, repr(t)


def test_word_ids_of_other_rules_use_the_whole_tokenizer(tmp_path):
    spec = json.loads(Tokenizer.from_file(TOKENIZER).to_str())
    spec["normalizer"]["normalizers"].pop()  # no lower-casing
    path = str(tmp_path / "cased.json")
    with open(path, "w") as file:
        json.dump(spec, file)
    table, whole = packing.WordIds(path), Tokenizer.from_file(path)
    for t in ("The Quick Brown", "plain text"):
        assert np.frombuffer(table.encode(t), table.dtype).tolist() == whole.encode(t, add_special_tokens=False).ids


# --- 5 quality ------------------------------------------------------------------------

def test_quality_separates_and_sums_to_one(spark, odd, empty):
    rng = random.Random(5)
    words = ["and", "the", "river", "stone", "over", "under", "house", "garden"]
    good = [(i, " ".join(rng.choice(words) for _ in range(60)), "en") for i in range(120)]
    bad = [(1000 + i, "".join(chr(rng.randrange(33, 120)) for _ in range(300)), "en") for i in range(10)]
    docs = spark.createDataFrame(good + bad, "doc_id long, text string, lang string")
    trusted = spark.createDataFrame([(i,) for i in range(0, 120)], "doc_id long")
    kept = {r.doc_id for r in quality.score_quality(docs, trusted).where("keep").collect()}
    assert kept == set(range(120))
    keep = [r["keep"] for r in quality.score_quality(odd, trusted.where("doc_id < 0")).collect()]
    assert len(keep) == odd.count() and all(keep)
    assert rows_of(quality.score_quality(empty, trusted)) == []


def test_quality_rejects_what_labels_reject(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.score_quality(docs, labels.where("quality = 1").select("doc_id")).join(labels, "doc_id")
    rows = scored.select("quality", "keep", "perplexity", "threshold").collect()
    assert sum(r.keep for r in rows if r.quality == 0) <= 1  # of 58
    good = [r.keep for r in rows if r.quality == 1]
    assert sum(good) >= 0.99 * len(good)


def test_kneser_ney_is_a_distribution(spark):
    keys, _ = quality._gram_keys(np.array([0, 22]), np.frombuffer(b"abracadabra abracadabr", np.uint8), 3)
    grams, counts = np.unique(keys.view(np.int64), return_counts=True)
    frame = spark.createDataFrame(list(zip(grams.tolist(), counts.tolist())), "gram long, n long")
    model = quality.kneser_ney(frame, 3)
    context = (ord("a") << 8) | ord("b")
    asked = spark.createDataFrame([(0, (context << 8) | b) for b in range(256)], "shard long, gram long")
    bits = [r.bits for r in quality.probabilities(asked, model, 3).collect()]
    assert len(bits) == 256 and abs(sum(2.0 ** -b for b in bits) - 1) < 1e-9


# --- 6 decontamination -------------------------------------------------------------------

def brute_alignment(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
    return h.max()


def test_alignment_is_smith_waterman():
    rng = np.random.default_rng(4)
    for _ in range(60):
        a, b = rng.integers(0, 4, rng.integers(1, 14)), rng.integers(0, 4, rng.integers(1, 20))
        assert decontaminate.align(a, b)[0] == brute_alignment(a, b)


def test_leaks_exact_and_edited(spark, odd, empty):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    item = [word() for _ in range(30)]
    edited = [w if i % 6 else word() for i, w in enumerate(item)]
    filler = lambda n: " ".join(word() for _ in range(n))
    docs = [(1, f"{filler(50)} {' '.join(item)} {filler(50)}"), (2, f"{filler(20)}. {', '.join(edited).upper()} {filler(9)}"),
            (3, filler(200)), (4, " ".join(item[:4]) + " " + filler(80)), (5, None), (6, "")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([(9, " ".join(item)), (8, filler(25)), (7, None), (6, "")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.find_leaks(frame, items).collect()}
    assert set(got) == {(1, 9), (2, 9)}
    assert got[1, 9].score == 1.0 and (got[1, 9].word_start, got[1, 9].word_end) == (50, 80)
    one_by_one = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(frame, items, block_words=1).collect()}
    assert one_by_one == set(got)
    assert rows_of(decontaminate.find_leaks(odd, items)) == rows_of(decontaminate.find_leaks(empty, items)) == []
    assert rows_of(decontaminate.find_leaks(frame, items.where("item_id < 0"))) == []


# --- 7 near duplicates -----------------------------------------------------------------------

def brute_near(docs, percent=85):
    sets, parent = {}, {}
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", t.encode().lower().decode())
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())

    def find(v):
        while parent.setdefault(v, v) != v:
            v = parent[v]
        return v
    ids = [i for i in sets if i is not None]
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {(i, len(sets[i]), find(i) if i is not None else None) for i, _ in docs}


@pytest.mark.parametrize("block", [512, 4])
def test_near_duplicates(spark, odd, empty, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    rng = random.Random(7)
    base = [f"w{rng.randrange(500)}" for _ in range(200)]
    docs = []
    for i in range(40):
        copy = list(base)
        for _ in range(rng.randrange(6)):
            copy[rng.randrange(200)] = f"x{rng.randrange(10**6)}"
        docs.append((i, " ".join(copy)))
    docs += [(100 + i, " ".join(f"w{rng.randrange(500)}" for _ in range(120))) for i in range(20)] + [(300, "a b"), (301, "A  b")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert {tuple(r)[:3] for r in neardup.near_duplicates(frame).collect()} == brute_near(docs)
    if block == 512:
        got = neardup.near_duplicates(odd).collect()
        assert {tuple(r)[:3] for r in got} == brute_near(odd_texts(odd)) and len(got) == odd.count()
        assert rows_of(neardup.near_duplicates(empty)) == []


# --- 8 repeated passages -----------------------------------------------------------------------

def brute_suffix(docs, length):
    seen, out = set(), []
    for i, t in sorted(docs, key=lambda d: (d[0] is None, d[0] or 0)):
        b = t.encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if b[p:p + length] in seen:
                gone[p:p + length] = True
            seen.add(b[p:p + length])
        out.append((i, len(b), bytes(np.frombuffer(b, np.uint8)[~gone])))
    return sorted(out, key=repr)


@pytest.mark.parametrize("kind", ["one group", "many groups"])
def test_suffix_dedup(spark, odd, empty, monkeypatch, kind):
    if kind == "many groups":
        monkeypatch.setattr(G.group_count, "__defaults__", (300,))
        monkeypatch.setattr(suffix, "BUCKET_BYTES", 500)
        monkeypatch.setattr(suffix, "FREQUENT", 3)
    rng = random.Random(8)
    passage = "".join(rng.choice("abc ") for _ in range(150))
    docs = [(i, "".join(rng.choice("abc ") for _ in range(rng.randrange(200)))
             + (passage if rng.random() < 0.5 else passage[20:90]) + rng.choice(["", "aé" * 70, "abab" * 40])) for i in range(40)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = [(r.doc_id, r.n_bytes, bytes(r.kept)) for r in suffix.remove_repeats(frame, 50, gram=16, frequent=suffix.FREQUENT).collect()]
    assert sorted(got, key=repr) == brute_suffix(docs, 50)
    if kind == "one group":
        got = [(r.doc_id, r.n_bytes, bytes(r.kept)) for r in suffix.remove_repeats(odd).collect()]
        assert sorted(got, key=repr) == brute_suffix(odd_texts(odd), 100)
        assert rows_of(suffix.remove_repeats(empty)) == []


def test_two_stage_sort_orders_suffixes():
    rng = np.random.default_rng(9)
    for _ in range(40):
        text = np.concatenate([rng.integers(0, 3, 300), np.zeros(120, int)]).astype(np.uint8)
        wanted = np.arange(len(text)) < 260
        order = suffix.suffix_order(text, wanted, 100)
        keys = [text[p:p + 100].tobytes() for p in order]
        assert keys == sorted(keys) and len(order) == 260


# --- 9 exact duplicates ---------------------------------------------------------------------------

def test_exact_odd_rows(odd, empty):
    got = sorted(rows_of(exactdup.exact_duplicates(odd)), key=repr)
    texts = odd_texts(odd)
    want = []
    for i, t in texts:
        same = [j for j, u in texts if u == t]
        keep = max((j for j in same if j is not None), default=None)
        want.append((i, keep, len(same), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    assert rows_of(exactdup.exact_duplicates(empty)) == []


def test_digest_collisions_are_told_apart(spark):
    hits = spark.createDataFrame([(b"d", 1, "x", 4, 4), (b"d", 2, "y", 4, 4), (b"d", 3, "y", 4, 4), (b"d", 4, "x", 4, 4)],
                                 "digest binary, id long, text string, keep_id long, group_size long")
    assert sorted(rows_of(exactdup._compared(hits).select("id", "keep_id", "group_size"))) == [
        (1, 4, 2), (2, 3, 2), (3, 3, 2), (4, 4, 2)]


# --- 10 toxicity ------------------------------------------------------------------------------------

def test_chain_held_out_accuracy(spark, odd, empty):
    rng = random.Random(10)
    docs, labels = [], []
    for i in range(240):
        mild, strong = i % 3 == 0, i % 6 == 0
        words = [f"w{rng.randrange(80)}" for _ in range(40)] + ["dolt"] * mild + ["brute"] * strong
        rng.shuffle(words)
        docs.append((i, " ".join(words)))
        labels.append((i, int(mild), int(strong), int(mild and not strong)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, mild int, strong int, only int")
    names = ("mild", "strong", "only")
    chain = toxicity.fit_chain(toxicity.labelled_sample(frame, known.where("doc_id < 160"), names), names)
    held = toxicity.score_chain(frame, chain).where("doc_id >= 160").collect()
    for c, name in enumerate(names):
        right = sum(round(r[f"p_{name}"]) == labels[r.doc_id][1 + c] for r in held)
        assert right >= 0.9 * len(held)
    assert len(rows_of(toxicity.score_chain(odd, chain))) == odd.count()
    assert rows_of(toxicity.score_chain(empty, chain)) == []


def test_toxicity_of_empty_tables_and_clashing_columns(spark, odd, empty):
    labels = spark.createDataFrame([(1, 0, 1), (5, 1, 0), (10, 0, 0)], "doc_id long, low_quality int, toxic int")
    categories = ("low_quality", "toxic")
    for docs, known in ((empty, labels), (odd, labels.where("false")), (empty, labels.where("false"))):
        chain = toxicity.fit_chain(toxicity.labelled_sample(docs, known, categories), categories)
        assert [r.p_toxic < 1e-9 for r in toxicity.score_chain(odd, chain).collect()] == [True] * odd.count()
    clashing = odd.withColumns({"toxic": F.lit("x"), "low_quality": F.lit(2), "_id": F.lit(3), "label": F.lit(4)})
    sample = toxicity.labelled_sample(clashing, labels, categories)
    assert sorted((r.id, r.toxic) for r in sample.collect()) == [(1, 1.0), (5, 0.0), (10, 0.0)]
    one = toxicity.fit_chain(sample.where("id = 1"), categories)  # every out-of-fold model lacks rows
    assert toxicity.score_chain(odd, one).count() == odd.count()

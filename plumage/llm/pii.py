"""Information-theoretic sanitisation of personal data, in DataFrame functions only.

Personal data that has a form (e-mail, IP, card and phone numbers) is found by
patterns; these are the protected entities. Words that share documents with an
entity may give it away although they have no form: over the whole corpus, the
pointwise mutual information of a term and an entity says how many bits the term
discloses, the entity's own information content how many there are. A term that
discloses most of it is removed wherever the corpus has it; one that discloses a
good part is generalised to its longest beginning that discloses less, judged by
the most frequent word that begins so, or removed if there is none.

Very many pairs of an entity and a term are tested, so the evidence asked of each
grows with their number (Bonferroni). A pair's log-likelihood ratio is at most
that of a term in just the entity's documents; entities for which even this is
too little are left out before any pair is counted, which changes no result. So in
a large corpus one shared document proves nothing, two exclusive ones do.

One pass over the texts gives the matches and the distinct words of each
document; all counts, and the choice of the words to place, are joins on that
landed table. Only documents that hold a disclosing term are read again, and only
those terms are placed in them.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumage.llm.common import land, text_or_empty

# The kinds in their order, and the forms searched for. Each
# pattern finds the same leftmost matches as its plain form (given beside it)
# without trying again inside a run of its own characters, so a scan stays
# linear however long a run is.
KINDS = ("email", "ip", "card", "phone")
TERM = "term"
PATTERNS = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    # [0-9]([\x20-]?[0-9])+
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
WORD = r"\p{L}{3,}"

#: Chance that a corpus without any association shows one (over all pairs that are tested).
ALPHA = 0.05
#: Share of the entity's information a term may disclose: over the first it is
#: generalised, over the second removed.
GENERALISE, REMOVE = 0.7, 0.95
#: A generalised form is a beginning of the word with this part of its letters (and three at least).
FORM_PARTS = (3 / 4, 1 / 2)
SHORTEST_FORM = 3
#: Rows up to which a counted table is sent to every task instead of shuffling the corpus' words to it.
SENT_ROWS = 250_000


def _found(kind: str) -> tuple[Column, Column]:
    """Matches of a kind, and the text between them (one piece more)."""
    text, pattern = F.col("text"), PATTERNS[kind]
    worth = F.contains(text, F.lit(NEEDS[kind])) if NEEDS[kind] else F.lit(True)
    none = F.array().cast("array<string>")
    return (F.when(worth, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none),
            F.when(worth, F.split(text, pattern, -1)).otherwise(none))


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""
    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 1, twice).otherwise(d)
    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _holds(kind: Column, match: Column) -> Column:
    """A match's further conditions; a match that fails is dropped."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)
    small = F.forall(F.split(match, r"\."), lambda p: F.coalesce(
        F.regexp_replace(p, "^0+(?=.)", "").try_cast("int") <= 255, F.lit(False)))
    return (F.when(kind == "email", True).when(kind == "ip", small)
            .when(kind == "card", F.when(n.between(14, 19), _luhn(digits)).otherwise(False))
            .otherwise(n.between(10, 15)))


def _words(text: Column) -> Column:
    """The distinct words of a text, lower-cased."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.lower))


def scanned_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(uid, id, row, kinds, terms) per row of ``docs``, all that its text is needed for but placing.

    ``uid`` numbers the rows, ``row`` hashes the text; ``kinds`` has the matches
    of each pattern with the gaps before them, ``terms`` the distinct words.
    """
    text = F.col("text")
    base = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("id"),
                       text_or_empty(text_col).alias("text"))
    kinds = []
    for kind in KINDS:
        matches, pieces = _found(kind)
        gaps = F.transform(pieces, lambda x: F.length(x))
        kinds.append(F.struct(F.lit(kind).alias("kind"), matches.alias("matches"), gaps.alias("gaps")))
    return base.select("uid", "id", F.xxhash64("text").alias("row"),
                       F.filter(F.array(*kinds), lambda k: F.size(k["matches"]) > 0).alias("kinds"), _words(text).alias("terms"))


def entity_mentions(rows: DataFrame) -> DataFrame:
    """Every pattern match of :func:`scanned_rows`, and one row without a match for documents that have none.

    (uid, id, row, kind, entity, start, end): offsets in code points, end exclusive.
    """
    per_kind = rows.select("uid", "id", "row", F.explode_outer("kinds").alias("k"))
    rows = per_kind.select("uid", "id", "row", F.col("k.kind").alias("kind"), F.posexplode_outer(F.transform(
        "k.matches", lambda m, i: F.struct(
            m.alias("entity"), F.get("k.gaps", i).alias("gap")))).alias("pos", "m"))
    rows = rows.select("uid", "id", "row", "kind", "pos", "m.*")
    before = Window.partitionBy("uid", "kind").orderBy("pos")
    size = F.length("entity")
    rows = rows.withColumn("end", F.sum(F.col("gap") + size).over(before)).withColumn("start", F.col("end") - size)
    good = F.col("entity").isNotNull() & _holds(F.col("kind"), F.col("entity"))
    kept = [F.when(good, F.col(c)).alias(c) for c in ("kind", "entity", "start", "end")]
    return rows.select("uid", "id", "row", *kept)


def _g2(both: Column, entity: Column, term: Column, n: Column) -> Column:
    """Log-likelihood ratio of the 2 x 2 table of documents with and without the entity and the term."""
    def cell(seen: Column, row: Column, col: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen * n / (row * col))).otherwise(0.0)
    return 2 * (cell(both, entity, term) + cell(entity - both, entity, n - term)
                + cell(term - both, n - entity, term) + cell(n - entity - term + both, n - entity, n - term))


def evidence(pairs: int, alpha: float = ALPHA) -> float:
    """Log-likelihood ratio (1 degree of freedom) that none of ``pairs`` unrelated pairs reaches, but with chance ``alpha``."""
    chance = alpha / max(pairs, 1)
    low, high = 0.0, 2000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if math.erfc(math.sqrt(middle / 2)) > chance else (low, middle)
    return high


def _sent(table: DataFrame) -> DataFrame:
    """A landed table for a join with the corpus: broadcast if it is counted to be small, else as it is."""
    return F.broadcast(table) if table.count() <= SENT_ROWS else table


def _share(both: Column, entity: Column, term: Column, n: Column) -> Column:
    """PMI(entity; term) / IC(entity) over documents."""
    return F.log(both * n / (entity * term)) / F.log(n / entity)


def disclosures(rows: DataFrame, mentions: DataFrame, vocabulary: DataFrame, alpha: float = ALPHA,
                generalise: float = GENERALISE) -> DataFrame:
    """(kind, entity, term, n_entity, n_docs, share): terms that disclose at least ``generalise`` of an entity.

    share = PMI(entity; term) / IC(entity), with probabilities over documents:
    PMI = log(n_both * N / (n_entity * n_term)), IC = log(N / n_entity). An
    entity that every document holds has no information to disclose.
    """
    entity = ["kind", "entity"]
    held = mentions.where("entity is not null").select("uid", "kind", F.lower("entity").alias("entity")).distinct()
    held = land(held, "pii-held")
    n_docs = rows.count()
    n = F.lit(n_docs)
    per_row = held.groupBy("uid").agg(F.count(F.lit(1)).alias("entities"))
    pairs = per_row.join(rows.select("uid", F.size("terms").alias("terms")), "uid").agg(
        F.coalesce(F.sum(F.col("entities") * F.col("terms")), F.lit(0)).alias("pairs")).first()["pairs"]
    enough = evidence(pairs, alpha)
    size = F.col("n_entity")
    judged = land(held.groupBy(*entity).agg(F.count(F.lit(1)).alias("n_entity")).where(
        (size < n) & (_g2(size, size, size, n) >= enough)), "pii-judged")
    own = land(held.join(judged, entity).select("uid", *entity), "pii-judged-rows")
    both = rows.select("uid", "terms").join(_sent(own), "uid").select(*entity, F.explode("terms").alias("term"))
    both = both.groupBy(*entity, "term").agg(F.count(F.lit(1)).alias("n_both"))
    return (both.join(judged, entity).join(vocabulary, "term")
            .where(_g2(F.col("n_both"), size, F.col("n_term"), n) >= enough)
            .withColumn("share", _share(F.col("n_both"), size, F.col("n_term"), n)).where(F.col("share") >= generalise)
            .select(*entity, "term", "n_entity", n.cast("long").alias("n_docs"), "share"))


def _forms(term: Column) -> Column:
    """Beginnings of a word that may stand for it, the longest first."""
    sizes = [F.greatest(F.ceil(F.length(term) * part).cast("int"), F.lit(SHORTEST_FORM)) for part in FORM_PARTS]
    cut = F.array_distinct(F.array(*[F.substring(term, F.lit(1), size) for size in sizes]))
    return F.filter(cut, lambda form: F.length(form) < F.length(term))


def general_forms(bad: DataFrame, vocabulary: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """(term, share, form) of all disclosing terms; ``form`` is NULL for those to be removed.

    A form's documents hold any word that begins with it: at least as many as
    hold the most frequent such word, and those with the entity are at most the
    entity's. A form may stand for the term if even by these bounds it discloses
    less than ``generalise`` of every entity that the term discloses. So the
    choice needs the vocabulary's counts only, and never takes a form that
    discloses more; a form that only an exact count would allow is not taken.
    """
    worst = bad.groupBy("term").agg(F.max("share").alias("share"))
    mild = bad.join(worst.where(F.col("share") < remove).select("term"), "term").withColumn("form", F.explode(_forms(F.col("term"))))
    mild = land(mild.select("term", "n_entity", "n_docs", "form"), "pii-mild")
    wanted = land(mild.select("form").distinct(), "pii-forms")
    sizes = [r["size"] for r in wanted.select(F.length("form").alias("size")).distinct().orderBy("size").collect()]
    begins = F.array(*[F.when(F.length("term") >= size, F.substring("term", 1, size)) for size in sizes]) if sizes \
        else F.array().cast("array<string>")
    n_form = vocabulary.select("n_term", F.explode(F.filter(begins, lambda form: form.isNotNull())).alias("form")).join(
        _sent(wanted), "form").groupBy("form").agg(F.max("n_term").alias("n_form"))
    shares = mild.join(n_form, "form").withColumn(
        "share", F.log(F.col("n_docs") / F.col("n_form")) / F.log(F.col("n_docs") / F.col("n_entity")))
    fits = shares.groupBy("term", "form").agg(F.max("share").alias("share")).where(F.col("share") < generalise)
    chosen = fits.groupBy("term").agg(F.max_by("form", F.length("form")).alias("form"))
    return worst.join(chosen, "term", "left").select("term", "share", "form")


def term_places(docs: DataFrame, own: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, row, term, start, end) of the words that ``own`` (id, row, terms) names for a document.

    The other words are not placed: the document's own words in question form a
    pattern, and the lengths of the text between its matches are summed.
    """
    base = docs.select(F.monotonically_increasing_id().alias("place"), F.col(id_col).cast("long").alias("id"),
                       text_or_empty(text_col).alias("text")).withColumn("row", F.xxhash64("text"))
    own = land(own.dropDuplicates(["id", "row"]), "pii-own-texts")
    key = _sent(own.select(F.col("id").alias("_id"), F.col("row").alias("_row"), "terms"))
    rows = base.join(key, F.col("id").eqNullSafe(F.col("_id")) & (F.col("row") == F.col("_row"))).select(
        "place", "id", "row", "text", "terms")
    mine = F.filter(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)),
                    lambda w: F.array_contains(F.col("terms"), F.lower(w)))
    rows = rows.withColumn("mine", mine).where(F.size("mine") > 0)
    pattern = F.concat(F.lit(r"(?<!\p{L})(?:"), F.array_join(F.array_distinct("mine"), "|"), F.lit(r")(?!\p{L})"))
    # the words in question are in the order in which the pattern finds them
    found = F.arrays_zip(F.col("mine").alias("word"),
                         F.transform(F.split("text", pattern, -1), lambda x: F.length(x)).alias("gap"))
    placed = rows.select("place", "id", "row", F.posexplode(found).alias("pos", "w")).where("w.word is not null")
    before = Window.partitionBy("place").orderBy("pos")
    size = F.length("w.word")
    placed = placed.withColumn("end", F.sum(F.col("w.gap") + size).over(before).cast("long"))
    return placed.select("id", "row", F.lower("w.word").alias("term"), (F.col("end") - size).alias("start"), "end")


def sensitive_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", alpha: float = ALPHA,
                    generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """(id, row, spans) for every row of ``docs``; spans are (start, rank, kind, end, action, form).

    Pattern spans have their kind and action ``remove``. A word that discloses
    too much of any entity is a span of kind ``term`` with action ``generalise``
    (to ``form``) or ``remove`` wherever it occurs, also in documents without the
    entity, but not inside a pattern span. Spans of different kinds may overlap;
    they are sorted by start, then kind. ``row`` hashes the text, so repeated ids
    stay apart; repeated rows are reported each. NULL and empty texts have no
    spans; an empty table gives an empty result; other columns are ignored.
    """
    rows = land(scanned_rows(docs, id_col, text_col), "pii-rows")
    mentions = land(entity_mentions(rows), "pii-mentions")
    each = rows.select("uid", "id", "row", F.explode("terms").alias("term"))
    vocabulary = land(each.groupBy("term").agg(F.count(F.lit(1)).alias("n_term")), "pii-vocabulary")
    bad = land(disclosures(rows, mentions, vocabulary, alpha, generalise), "pii-disclosures")
    bad = land(general_forms(bad, vocabulary, generalise, remove), "pii-terms")
    own = land(each.join(_sent(bad.select("term")), "term").groupBy("uid", "id", "row").agg(
        F.collect_list("term").alias("terms")), "pii-own")
    terms = term_places(docs, own, id_col, text_col).join(_sent(bad), "term")
    rank = reduce(lambda a, i: a.when(F.col("kind") == KINDS[i], i), range(len(KINDS)),
                  F.when(F.col("kind") == TERM, len(KINDS)))
    one = F.struct("start", rank.alias("rank"), "kind", "end", "action", "form")
    found = (mentions.withColumns({"action": F.lit("remove"), "form": F.lit(None).cast("string")}).groupBy("uid", "id", "row")
             .agg(F.collect_list(F.when(F.col("kind").isNotNull(), one)).alias("spans")))
    action = F.when(F.col("form").isNull(), "remove").otherwise("generalise")
    # a set: repeated rows place the same words
    added = (terms.select("id", "row", F.lit(TERM).alias("kind"), "start", "end", action.alias("action"), "form")
             .groupBy(F.col("id").alias("_id"), F.col("row").alias("_row")).agg(F.collect_set(one).alias("terms")))
    inside = lambda w: F.exists("spans", lambda s: (s["start"] <= w["start"]) & (w["end"] <= s["end"]))
    outside = F.filter("terms", lambda w: ~inside(w))
    every = F.when(F.col("terms").isNull(), F.col("spans")).otherwise(F.concat("spans", outside))
    return (found.join(added, F.col("id").eqNullSafe(F.col("_id")) & (F.col("row") == F.col("_row")), "left")
            .select(F.col("id").alias(id_col), "row", F.sort_array(every).alias("spans")))


def sanitise(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, sanitised): texts with spans replaced by their kind, or by their form and * if generalised.

    ``spans`` is what :func:`sensitive_spans` gives. Of overlapping spans the
    first counts; what is left of a later one is replaced too.
    """
    one = spans.dropDuplicates([id_col, "row"]).withColumnRenamed(id_col, "_id")
    rows = docs.select(F.col(id_col), text_or_empty(text_col).alias("_text")).withColumn("row", F.xxhash64("_text"))
    joined = rows.join(one, rows[id_col].eqNullSafe(one["_id"]) & (rows["row"] == one["row"]), "left")
    text = F.col("_text")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        label = F.when(s["action"] == "generalise", F.concat(s["form"], F.lit("*"))).otherwise(
            F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
        plain = F.greatest(s["start"] - acc["at"], F.lit(0).cast("long"))
        return F.when(s["end"] <= acc["at"], acc).otherwise(F.struct(
            s["end"].alias("at"),
            F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), plain.cast("int")), label).alias("out")))

    def finish(acc: Column) -> Column:
        return F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text)))
    spans_or_none = F.coalesce("spans", F.array().cast(one.schema["spans"].dataType))
    return joined.select(rows[id_col], F.aggregate(spans_or_none, start, step, finish).alias("sanitised"))

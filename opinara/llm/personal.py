"""Personal data: spans by pattern, and terms that give an entity away (op 6).

Emails, addresses, cards and phones are found by pattern. How much a term reveals
of such an entity follows from the corpus: the pointwise mutual information of
the term's standing in a text with the entity, over the information content of the entity,
is 1 when the term tells it and 0 when it says nothing (Sanchez and Batet's
measure of disclosure). The term's counts are smoothed, so that entities of one
text are weighed like any other and chance tells less. Terms over one threshold are generalised, over a higher
one removed. All of it is DataFrame functions.

A line holds every match whole, as no pattern takes a line feed.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vocabulary import let
from .common import materialise, names_for, possibly_in

# A match can only begin where a run of its first characters begins, or at the end of the
# last match. That, and never giving back what a run has taken, keeps matching linear and
# finds what the plain patterns find.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SIGNS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
TERM = r"(?<!\p{L})\p{L}{3,}+(?!\p{L})"
PRIOR = 2  # texts of which a term's evidence is mixed with what holds of any term
GENERALISE, REMOVE = 0.7, 0.9  # shares of an entity's information that a term may not reveal
SPAN = "array<struct<kind:string,start:int,end:int,value:string>>"
BLOCK = 256


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, x: a + x)


def sums_before(numbers: Column) -> Column:
    """For each number the sum of those before it; in blocks, so that long arrays stay cheap."""
    parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(numbers) - 1) / BLOCK).cast("int")),
                        lambda b: F.slice(numbers, b * BLOCK + 1, F.lit(BLOCK)))
    return let(parts, lambda ps: let(F.transform(ps, _sum), lambda sums: F.flatten(F.transform(ps, lambda p, b: let(
        _sum(F.slice(sums, F.lit(1), b)), lambda base: F.transform(p, lambda x, i: base + _sum(F.slice(p, F.lit(1), i))))))))


def matches(text: Column, kind: str, pattern: str) -> Column:
    """All matches as ``(kind, start, end, value)``: code points, end exclusive."""
    def placed(found, pieces):
        lengths = F.zip_with(pieces, found, lambda p, m: F.length(p) + F.coalesce(F.length(m), F.lit(0)))
        return let(sums_before(lengths), lambda before: F.transform(found, lambda m, i: let(
            F.get(before, i) + F.length(F.get(pieces, i)),
            lambda start: F.struct(F.lit(kind).alias("kind"), start.alias("start"), (start + F.length(m)).alias("end"), m.alias("value")))))

    none = F.array().cast(SPAN)
    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda ms: F.when(F.size(ms) == 0, none).otherwise(
        let(F.split(text, pattern, -1), lambda pieces: placed(ms, pieces))))


def _digits(value):
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value):
    def of(digits):
        n = F.length(digits)
        places = F.sequence(F.lit(1), n)
        value_of = F.transform(places, lambda i: let(
            F.substring(digits, i, F.lit(1)).cast("int") * (1 + (n - i) % 2), lambda d: F.when(d > 9, d - 9).otherwise(d)))
        return n.between(13, 19) & (_sum(value_of) % 10 == 0)
    return let(_digits(value), of)


VALID = {
    "email": lambda value: F.lit(True),
    "ip": lambda value: F.forall(F.split(value, r"\."), lambda part: let(
        F.regexp_replace(part, "^0+", ""), lambda p: (p == "") | ((F.length(p) <= 3) & (F.substring(p, 1, 3).cast("int") <= 255)))),
    "card": _luhn,
    "phone": lambda value: F.length(_digits(value)).between(9, 15),
}


def base_spans(text: Column) -> Column:
    """Spans of all kinds in the order of ``PATTERNS``, then by start."""
    def of(kind):
        found = F.filter(matches(text, kind, PATTERNS[kind]), lambda s: VALID[kind](s["value"]))
        sign = text.contains(SIGNS[kind]) if SIGNS[kind] else text.rlike("[0-9]")
        return F.when(sign, found).otherwise(F.array().cast(SPAN))

    return F.concat(*[of(kind) for kind in PATTERNS])


def share_told(n, n_both, n_term, n_entity, prior=PRIOR) -> Column:
    """The share of an entity's information that a term reveals; nothing where all texts hold the entity.

    The entity's frequency among the term's texts is mixed with that among ``prior``
    texts of any kind, so that a term of few texts tells less, and no term is left out.
    """
    usual = n_entity / F.lit(float(n))
    return F.when(n_entity < n, F.log2((n_both + prior * usual) / (n_term + prior) / usual) / -F.log2(usual)).otherwise(0.0)


def terms_of(text: Column) -> Column:
    """The distinct terms of a text, in small letters."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower))


def revealing_terms(found: DataFrame, docs: DataFrame, generalise=GENERALISE) -> DataFrame:
    """Places of the terms that reveal an entity of their text: ``(text_hash, start, end, share)``.

    ``found`` has ``text_hash, text, entities`` of the rows with entities, ``docs`` all
    texts. Counts are of distinct whole texts, so copies weigh as one. Entities of the
    same texts are weighed once, as their crowd of texts.
    """
    named = materialise(found.select("text_hash", F.explode("entities").alias("entity")).distinct(), "entities")
    crowd = F.xxhash64(F.count(F.lit(1)), F.bit_xor(F.xxhash64("text_hash", F.lit(1))), F.bit_xor(F.xxhash64("text_hash", F.lit(2))))
    crowds = named.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"), crowd.alias("crowd"))
    crowds = materialise(named.join(crowds.hint("merge"), "entity").select("text_hash", "crowd", "n_entity").distinct(), "crowds")
    own = found.select("text_hash", "text").dropDuplicates(["text_hash"])
    placed = own.select("text_hash", F.explode(matches(F.col("text"), "term", TERM)).alias("t")).select(
        "text_hash", F.lower("t.value").alias("term"), F.col("t.start").alias("start"), F.col("t.end").alias("end"))
    placed = materialise(placed, "placed")
    met = materialise(placed.select("text_hash", "term").distinct().join(crowds.hint("merge"), "text_hash"), "met")
    pairs = materialise(met.groupBy("crowd", "n_entity", "term").agg(F.count(F.lit(1)).alias("n_both")), "pairs")
    texts = docs.select("text", "text_hash")
    n = texts.agg(F.count_distinct("text_hash")).first()[0]
    if pairs.isEmpty():
        return placed.where("false").select("text_hash", "start", "end", F.lit(0.0).alias("share"))
    wanted = pairs.select("term").distinct()

    def listed(rows, *columns):
        # Only terms that may be asked for leave their task.
        return possibly_in(rows.select(*columns, F.explode(terms_of(F.col("text"))).alias("term")), F.col("term"), wanted, "term")

    counted = listed(texts).groupBy("term").agg(F.count(F.lit(1)).alias("n_rows"))
    # Of a text of several copies all but one are taken off again, a share from each copy.
    several = texts.groupBy("text_hash").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    copies = possibly_in(texts, F.col("text_hash"), several, "text_hash").join(several.hint("merge"), "text_hash")
    again = listed(copies, "copies").groupBy("term").agg(F.sum(1 - 1 / F.col("copies")).alias("again"))
    counts = (wanted.join(counted.hint("merge"), "term").join(again.hint("merge"), "term", "left")
              .select("term", (F.col("n_rows") - F.coalesce("again", F.lit(0.0))).alias("n_term")))
    share = share_told(n, *map(F.col, ("n_both", "n_term", "n_entity")))
    telling = (pairs.join(counts.hint("merge"), "term").withColumn("share", share).where(F.col("share") >= generalise)
               .select("crowd", "term", "share"))
    told = met.join(telling.hint("merge"), ["crowd", "term"]).groupBy("text_hash", "term").agg(F.max("share").alias("share"))
    return placed.join(told.hint("merge"), ["text_hash", "term"]).select("text_hash", "start", "end", "share")


def personal_spans(df: DataFrame, id="doc_id", text="text", generalise=GENERALISE) -> DataFrame:
    """One row a row of ``df``: ``id, text_hash, base, terms``, both arrays of spans in code points.

    ``base`` are the emails, ips, cards and phones, by kind and start; ``terms`` every
    place outside of them of a term that reveals an entity of its text, wherever
    it stands, with the share it reveals, by start. A null or empty text has none.
    Rows that repeat id and text get the same spans, and copies of a text count once
    as evidence; other columns play no part; an empty table gives no rows.
    """
    docs = df.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    docs = docs.withColumn("text_hash", F.xxhash64("text"))
    entities = F.array_distinct(F.transform("base", lambda s: F.concat_ws(":", s["kind"], F.lower(s["value"]))))
    found = docs.withColumn("base", base_spans(F.col("text"))).withColumn("entities", entities)
    held = F.when(F.size("base") > 0, F.col("text")).alias("text")
    found = materialise(found.select("id", "text_hash", "base", "entities", held), "spans")
    terms = revealing_terms(found.where("text IS NOT NULL"), docs, generalise)
    terms = (terms.groupBy(F.col("text_hash").alias("t_hash"))
             .agg(F.sort_array(F.collect_list(F.struct("start", "end", "share"))).alias("terms")))
    none = F.array().cast("array<struct<start:int,end:int,share:double>>")
    out = (found.drop("text", "entities").join(terms.hint("merge"), F.col("text_hash") == F.col("t_hash"), "left")
           .withColumn("terms", F.coalesce("terms", none)))
    free = F.filter("terms", lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (b["end"] > t["start"])))
    return out.select(F.col("id").alias(id), "text_hash", "base", free.alias("terms"))


def sanitise(df: DataFrame, id="doc_id", text="text", generalise=GENERALISE, remove=REMOVE) -> DataFrame:
    """``df`` with its texts sanitised: entities become ``<EMAIL>`` and so on, terms ``<TERM>`` or nothing.

    The spans are those of ``personal_spans``; overlapping ones count as the first
    of them, up to where the last ends. Other columns stay.
    """
    s_id, s_hash, s_base, s_terms = names_for(df, "span_id", "span_hash", "span_base", "span_terms")
    spans = personal_spans(df, id, text, generalise).distinct().toDF(s_id, s_hash, s_base, s_terms)
    spans = spans.where((F.size(s_base) > 0) | (F.size(s_terms) > 0))
    same = F.col(id).eqNullSafe(F.col(s_id)) & (F.xxhash64(F.coalesce(F.col(text), F.lit(""))) == F.col(s_hash))
    one = "struct<start:int,end:int,with:string>"
    both = F.concat(
        F.transform(s_base, lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end"), F.concat(F.lit("<"), F.upper(b["kind"]), F.lit(">")).alias("with")).cast(one)),
        F.transform(s_terms, lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), F.when(t["share"] >= remove, "").otherwise("<TERM>").alias("with")).cast(one)))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        fresh = F.struct(s["end"].alias("at"), F.concat(acc["out"], F.substring(F.col(text), acc["at"] + 1, s["start"] - acc["at"]), s["with"]).alias("out"))
        return F.when(s["start"] >= acc["at"], fresh).otherwise(F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out")))

    clean = F.aggregate(F.sort_array(both), start, step, lambda acc: F.concat(acc["out"], F.substring(F.col(text), acc["at"] + 1, F.length(text))))
    return (df.join(spans.hint("merge"), same, "left").withColumn(text, F.when(F.col(s_id).isNull() & F.col(s_base).isNull(), F.col(text)).otherwise(clean))
            .drop(s_id, s_hash, s_base, s_terms))

"""Personal data: fixed patterns for entities, and the terms of the corpus that reveal them.

Base matches (addresses, numbers) are protected entities. Words of the same documents may reveal an entity
as well: over the whole corpus, the share of the entity's information that a word discloses is

    log2(N * n(term, entity) / (n(term) * n(entity))) / log2(N / n(entity))

with N documents, n(term), n(entity) and n(term, entity) those that hold one or both, at any distance.
It is 1 if the word occurs with the entity alone, and 0 if it is no more common there than elsewhere. With
``SUPPORT`` or more different texts of both, a word that discloses ``GENERALISE`` or more is replaced by a
class, and one that discloses ``REMOVE`` or more goes: wherever it stands, with the entity or without.
Words are runs of letters and digits of any length that begin with a letter, outside the base matches.

SQL functions only. Counts are pre-aggregated before each exchange, so that an entity or word of very
many documents does not gather in one task; equal texts are one row; words too common to disclose an entity
are left out before words and entities meet, which loses no pair. Null texts count as empty. Texts are told
apart by 64 hash bits: repeated texts get the same spans. Other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.session import work_dir

from .chunks import short_lived_shuffles
from .spans import SPANS, as_spans, matches

#: The kinds in their order and their patterns. Runs are taken whole and never given back.
KINDS = ("email", "ip", "card", "phone")
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){11,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
PART = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
#: Stands for each character of a base match where words are sought. A word that runs into one is none.
MASK = "\ue000"
WORD = rf"\p{{L}}[\p{{L}}\p{{N}}]*+(?!{MASK})"

SUPPORT = 3
GENERALISE = 0.8
REMOVE = 0.95


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _base(text: Column) -> dict[str, Column]:
    return {
        "email": matches(text, EMAIL, lambda whole, _: F.lit(True), hint=text.contains("@")),
        "ip": matches(text, IP, lambda whole, _: whole.rlike(rf"^{PART}(?:\.{PART}){{3}}$")),
        "card": matches(text, CARD, lambda whole, _: F.length(_digits(whole)).between(12, 19) & F.call_function("luhn_check", _digits(whole))),
        "phone": matches(text, PHONE, lambda whole, _: F.length(_digits(whole)).between(9, 15), hint=text.contains("+")),
    }


def base_matches(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Each row with ``email``, ``ip``, ``card`` and ``phone``: start, end and text of the base matches."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.drop(*KINDS).withColumns(_base(text))


def _masked(text: Column) -> Column:
    """The text with ``MASK`` for each character of a base match; places stay what they are."""
    spans = F.array_sort(F.concat(*(F.transform(F.col(kind), lambda x: F.struct(x["start"], x["end"])) for kind in KINDS)))

    def step(seen: Column, x: Column) -> Column:
        gap = F.substring(text, seen["at"] + 1, F.greatest(x["start"] - seen["at"], F.lit(0)))
        mask = F.repeat(F.lit(MASK), F.greatest(x["end"] - F.greatest(x["start"], seen["at"]), F.lit(0)))
        return F.struct(F.greatest(seen["at"], x["end"]).alias("at"), F.concat(seen["out"], gap, mask).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    masked = F.aggregate(spans, start, step, lambda x: F.concat(x["out"], F.substring(text, x["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, masked).otherwise(text)


def _words(masked: Column) -> Column:
    """The different words of a masked text, in lower case."""
    return F.array_distinct(F.transform(F.regexp_extract_all(masked, F.lit(WORD), F.lit(0)), F.lower))


def disclosures(base: DataFrame, path: str) -> DataFrame:
    """(kind, entity, term, share): the words that disclose an entity, with the share of its information.

    ``base`` has a row for each document: the base matches, ``_terms`` (its words) and ``_text_hash``.
    Texts with entities are written under ``path``.
    """
    total = float(base.count())
    common = base.select(F.explode("_terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    listed = F.array_distinct(F.concat(*(F.transform(F.col(k), lambda x, k=k: F.struct(F.lit(k).alias("kind"), x["text"].alias("entity"))) for k in KINDS)))
    # Entities and words follow from the text: a text of many documents is one row, with their number.
    texts = base.select("_text_hash", "_terms", listed.alias("listed")).where(F.size("listed") > 0)
    texts.groupBy("_text_hash").agg(F.count(F.lit(1)).alias("n"), F.first("_terms").alias("_terms"), F.first("listed").alias("listed")).write.parquet(f"{path}/texts")
    texts = base.sparkSession.read.parquet(f"{path}/texts")
    holds = texts.select("_text_hash", "n", F.explode("listed").alias("x")).select("_text_hash", "n", "x.*")
    entities = holds.groupBy("kind", "entity").agg(F.sum("n").alias("n_entity"), F.count(F.lit(1)).alias("n_texts")).where(F.col("n_texts") >= SUPPORT).drop("n_texts")
    most = entities.agg(F.max("n_entity")).first()[0] or 0
    # As n(term, entity) <= n(entity), a word of more documents than this discloses less than GENERALISE.
    bound = lambda n: F.pow(F.lit(total), F.lit(1 - GENERALISE)) * F.pow(n, F.lit(GENERALISE)) * F.lit(1 + 1e-9)
    rare = common.where((F.col("n_term") >= SUPPORT) & (F.col("n_term") <= bound(F.lit(float(most)))))
    terms = texts.select("_text_hash", F.explode("_terms").alias("term")).join(rare, "term")
    both = terms.join(holds.join(entities, ["kind", "entity"]), "_text_hash").where(F.col("n_term") <= bound(F.col("n_entity")))
    pairs = both.groupBy("kind", "entity", "term", "n_term", "n_entity").agg(F.count(F.lit(1)).alias("n_texts"), F.sum("n").alias("n_both"))
    own = F.log2(F.lit(total) / F.col("n_entity"))
    shared = F.log2(F.lit(total) * F.col("n_both") / (F.col("n_term") * F.col("n_entity")))
    share = F.when(own > 0, shared / own).otherwise(F.lit(0.0))
    return pairs.where(F.col("n_texts") >= SUPPORT).withColumn("share", share).where(F.col("share") >= GENERALISE).select("kind", "entity", "term", "share")


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row, but for its text, with the base matches and ``personal``: all spans by start and kind.

    Beside the base kinds there are ``general`` and ``remove``, words to generalise and to remove.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.drop("personal").withColumn("_text_hash", F.xxhash64(text))
    # The patterns pass over the texts once; what follows reads their results, in the shared folder.
    path = work_dir(spark, "pii")
    base_matches(keyed, text_col).withColumn("_terms", _words(_masked(text))).drop(text_col).write.parquet(f"{path}/base")
    base = spark.read.parquet(f"{path}/base")
    # Each step is written, so that its shuffle files go, and few terms are known to be few when they are joined.
    with short_lived_shuffles(spark):
        disclosures(base, path).groupBy("term").agg((F.max("share") >= REMOVE).alias("gone")).write.parquet(f"{path}/gone")
        marked = base.select("_text_hash", F.explode("_terms").alias("term")).join(spark.read.parquet(f"{path}/gone"), "term").groupBy("_text_hash")
        marked.agg(F.collect_set(F.when(F.col("gone"), F.col("term"))).alias("_gone"), F.collect_set("term").alias("_known")).write.parquet(f"{path}/marked")
        marked = spark.read.parquet(f"{path}/marked")
        bits = _bits(marked)
        # Only texts that hold such words are read again, each once, and meet their own such words.
        again = _likely(keyed.select("_text_hash", text.alias("_text")), bits).where("_likely")
        again = again.groupBy("_text_hash").agg(F.first("_text").alias("_text")).join(marked, "_text_hash")
        found = matches(_masked(F.col("_text")), WORD, lambda whole, _: F.array_contains("_known", F.lower(whole)))

        def span(x: Column) -> Column:
            gone = F.array_contains("_gone", F.lower(x["text"]))
            return F.struct(x["start"], F.when(gone, 5).otherwise(4).alias("rank"), x["end"], F.when(gone, "remove").otherwise("general").alias("kind"))

        base_matches(again, "_text").select(F.col("_text_hash").alias("_other_hash"), F.transform(found, span).cast(SPANS).alias("_spans")).write.parquet(f"{path}/spans")
    spans = spark.read.parquet(f"{path}/spans")
    # Rows without such words stay where they are.
    rows = _likely(base.drop("_terms"), bits)
    some = rows.where("_likely").join(spans, F.col("_text_hash") == F.col("_other_hash"), "left").drop("_other_hash")
    rest = rows.where("NOT _likely").withColumn("_spans", F.lit(None).cast(SPANS))
    every = F.concat(*(as_spans(F.col(k), k, i) for i, k in enumerate(KINDS)), F.coalesce("_spans", F.array().cast(SPANS)))
    return some.unionByName(rest).withColumn("personal", F.array_sort(every)).drop("_spans", "_likely")


#: A filter of 512 bitmaps of 32768 bits, 2 MB whatever the data. What passes it is joined exactly.
BITMAPS, BITS = 512, 32768


def _place(text_hash: Column) -> tuple[Column, Column]:
    """The bitmap and the bit of a text."""
    return F.pmod(text_hash, F.lit(BITMAPS)).alias("_map"), F.pmod(F.shiftrightunsigned(text_hash, 20), F.lit(BITS))


def _bits(marked: DataFrame) -> DataFrame:
    number, bit = _place(F.col("_text_hash"))
    return marked.groupBy(number).agg(F.bitmap_construct_agg(bit).alias("_bits"))


def _bit(bits: Column, bit: Column) -> Column:
    """Whether a bit of a bitmap is set; of no bitmap none is."""
    byte = F.conv(F.hex(F.substring(bits, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))


def _likely(rows: DataFrame, bits: DataFrame) -> DataFrame:
    """With ``_likely``: false only for texts that are surely not among the marked ones."""
    number, bit = _place(F.col("_text_hash"))
    return rows.withColumn("_map", number).join(F.broadcast(bits), "_map", "left").withColumn("_likely", _bit(F.col("_bits"), bit)).drop("_map", "_bits")


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with entities and generalised words replaced by their kind, and revealing words removed."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = find_personal_data(docs.select(id_col, text_col), id_col, text_col)
    found = found.groupBy(F.col(id_col).alias("_other"), F.col("_text_hash").alias("_other_hash")).agg(F.first("personal").alias("_spans"))
    whole = docs.withColumn("_hash", F.xxhash64(text)).join(found, F.col(id_col).eqNullSafe(F.col("_other")) & (F.col("_hash") == F.col("_other_hash")))

    def step(seen: Column, x: Column) -> Column:
        gap = F.substring(text, seen["at"] + 1, F.greatest(x["start"] - seen["at"], F.lit(0)))
        mark = F.when(x["kind"] == "remove", "").otherwise(F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]")))
        out = F.when(x["start"] >= seen["at"], F.concat(seen["out"], gap, mark)).otherwise(seen["out"])
        return F.struct(F.greatest(seen["at"], x["end"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.aggregate("_spans", start, step, lambda x: F.concat(x["out"], F.substring(text, x["at"] + 1, F.length(text))))
    return whole.withColumn(text_col, F.when(F.size("_spans") > 0, clean).otherwise(F.col(text_col))).select(docs.columns)

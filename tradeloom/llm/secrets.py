"""Secret scans: fixed patterns, and character Markov models of random strings and of identifiers.

Two first-order models are trained from labelled samples, one on random strings (secrets) and one on
ordinary words. A token of ``LEAST`` or more characters that no base match overlaps is a secret too if
the log-likelihood ratio of the models is at least ``RATIO`` for each of its transitions on average.
The trained part is one table of transitions between ASCII characters, whatever the data.

SQL functions only. Null texts count as empty and have no spans. Repeated rows are scanned one by one;
other columns are kept, and the columns added here replace columns of the same name.
"""

from __future__ import annotations

import json
import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .spans import SPANS, as_spans, matches, overlaps

#: The kinds in their order and their patterns.
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_HINT = r"(?i)passw(or)?d|secret|token|api_?key"
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
TOKEN = r"[A-Za-z0-9+/_=-]{16,}"
WORD = r"[A-Za-z][A-Za-z0-9+/_=-]{5,}"

LEAST = 16
RATIO = 0.5
#: Documents, picked by a hash of their id, whose base matches and other words label the samples.
SAMPLE_DOCUMENTS = 5000
SYMBOLS = 128


def _base(text: Column) -> dict[str, Column]:
    return {
        "assign": matches(text, ASSIGN, lambda _, value: F.length(value) >= 6, group=2, hint=text.rlike(ASSIGN_HINT)),
        "access": matches(text, ACCESS, lambda whole, _: F.length(whole) >= 20, hint=text.contains("AKIA")),
        "hex": matches(text, HEX, lambda whole, _: F.length(whole) >= 24),
    }


def base_matches(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Each row with ``assign``, ``access`` and ``hex``: start, end and secret of the base matches."""
    plain = docs.drop("assign", "access", "hex").withColumn("_text", F.coalesce(text_col, F.lit("")))
    return plain.withColumns(_base(F.col("_text")))


def labelled_samples(docs: DataFrame, documents: int = SAMPLE_DOCUMENTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(token, random): the secrets of the base matches, and the other words, of a bounded number of documents."""
    ids = docs.select(F.col(id_col).alias("_id")).where("_id IS NOT NULL").distinct().orderBy(F.xxhash64("_id"), "_id").limit(documents)
    # A bounded number of ids may be broadcast.
    own = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(F.broadcast(ids), "_id")
    found = base_matches(own)
    secrets = found.select(F.explode(F.transform(F.concat("assign", "access", "hex"), lambda x: x["text"])).alias("token"))
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace("_text", ASSIGN, " "), ACCESS, " "), HEX, " ")
    words = found.select(F.explode(F.regexp_extract_all(rest, F.lit(WORD), F.lit(0))).alias("token"))
    return secrets.select("token", F.lit(True).alias("random")).unionByName(words.select("token", F.lit(False).alias("random")))


def train(samples: DataFrame, weight: float = 8.0) -> list[float]:
    """Log-likelihood ratios of transitions; the pair of ASCII codes a, b is at SYMBOLS * a + b.

    A transition's probability leans on how common its second character is, with ``weight`` occurrences.
    Without samples of a kind, its model is uniform. Characters beyond ASCII end no transition.
    """
    letters, count = F.split("token", ""), F.length("token") - 1
    pairs = F.zip_with(F.slice(letters, 1, count), F.slice(letters, 2, count), lambda x, y: F.concat(x, y))
    found = samples.where(F.length("token") > 1).select("random", F.explode(pairs).alias("pair"))
    # One row for each label and pair of ASCII characters at most.
    rows = found.where(F.col("pair").rlike(r"^[\x21-\x7E]{2}$")).groupBy("random", "pair").count().collect()
    codes = range(33, 127)
    models = {}
    for label in (True, False):
        seen = {(ord(r["pair"][0]), ord(r["pair"][1])): r["count"] for r in rows if bool(r["random"]) == label}
        first, second = Counter(), Counter()
        for (x, y), n in seen.items():
            first[x] += n
            second[y] += n
        total = sum(second.values())
        common = {y: (second[y] + 0.5) / (total + 0.5 * len(codes)) for y in codes}
        models[label] = {(x, y): math.log((seen.get((x, y), 0) + weight * common[y]) / (first[x] + weight)) for x in codes for y in codes}
    return [models[True][x, y] - models[False][x, y] if x in codes and y in codes else 0.0 for x in range(SYMBOLS) for y in range(SYMBOLS)]


def ratio(token: Column, model: list[float]) -> Column:
    """The log-likelihood ratio of an ASCII token, per transition."""
    table = F.from_json(F.lit(json.dumps([round(x, 6) for x in model])), "array<double>")

    def step(seen: Column, letter: Column) -> Column:
        code = F.ascii(letter)
        gain = F.when(seen["last"] >= 0, F.get(table, seen["last"] * SYMBOLS + code)).otherwise(F.lit(0.0))
        return F.struct(code.alias("last"), (seen["sum"] + gain).alias("sum"))

    start = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"))
    return F.aggregate(F.split(token, ""), start, step, lambda x: x["sum"]) / (F.length(token) - 1)


def find_secrets(docs: DataFrame, model: list[float], text_col: str = "text") -> DataFrame:
    """Each row with the base matches of ``base_matches`` and ``secrets``: all spans, by start and kind."""
    found = base_matches(docs, text_col)
    base = F.concat(*(as_spans(F.col(kind), kind, i) for i, kind in enumerate(KINDS[:3])))
    text = F.col("_text")
    found = found.withColumn("_base", base)
    # Numbers alone are no secrets.
    tokens = matches(text, TOKEN, lambda whole, _: whole.rlike("[A-Za-z]") & (ratio(whole, model) >= RATIO))
    found = found.withColumn("_tokens", tokens)
    extra = F.filter("_tokens", lambda x: ~overlaps(F.col("_base"), x["start"], x["end"]))
    spans = F.array_sort(F.concat("_base", as_spans(extra, "markov", 3)).cast(SPANS))
    return found.withColumn("secrets", spans).drop("_text", "_base", "_tokens")


def redact(docs: DataFrame, model: list[float], mark: str = "[SECRET]", text_col: str = "text") -> DataFrame:
    """The documents with each maximal run of overlapping spans replaced by a mark."""
    found = find_secrets(docs, model, text_col)
    text, spans = F.coalesce(F.col(text_col), F.lit("")), F.col("secrets")

    def step(seen: Column, x: Column) -> Column:
        gap = F.substring(text, seen["at"] + 1, F.greatest(x["start"] - seen["at"], F.lit(0)))
        apart = x["start"] >= seen["at"]
        return F.struct(F.greatest(seen["at"], x["end"]).alias("at"), F.when(apart, F.concat(seen["out"], gap, F.lit(mark))).otherwise(seen["out"]).alias("out"))

    def finish(seen: Column) -> Column:
        return F.concat(seen["out"], F.substring(text, seen["at"] + 1, F.length(text)))

    clean = F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, finish)
    return found.withColumn(text_col, F.when(F.size(spans) > 0, clean).otherwise(F.col(text_col))).select(docs.columns)

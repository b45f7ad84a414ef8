"""The registered queries of this subpackage and, where SQL can express one, its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, conversations, decontamination, jaccard, lexical, lm_scores, neighbours, pieces, pii, secrets, substrings, suffixes, toxicity
from .spans import joined


def vocabulary_path() -> str:
    """The vocabulary of the registered queries; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pieces_path() -> str:
    """The piece vocabulary of the registered queries; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(words[i : i + 12], ' ') AS win
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 12)) AS i FROM w WHERE len(words) >= 13)),
firsts AS (SELECT win, min(doc_id) AS first_doc FROM win GROUP BY win),
gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(i, i + 12)) AS p FROM win JOIN firsts USING (win) WHERE first_doc < doc_id),
each AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM w),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS kept
  FROM each WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.doc_id = each.doc_id AND gone.p = each.p) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""


def op2_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = lm_scores.score(docs)
    return scored.select("doc_id", "n_words", F.round("log_score", 3).alias("log_score"), F.round("mean_log_score", 5).alias("mean_log_score"))


OP2_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
p AS (SELECT doc_id, i, words[i] AS a, CASE WHEN i > 1 THEN words[i - 1] END AS b, CASE WHEN i > 2 THEN words[i - 2] END AS c
      FROM (SELECT doc_id, words, unnest(generate_series(1, len(words))) AS i FROM w)),
n1 AS (SELECT a, count(*) AS n FROM p GROUP BY ALL), d1 AS (SELECT doc_id, a, count(*) AS n FROM p GROUP BY ALL),
n2 AS (SELECT b, a, count(*) AS n FROM p WHERE b IS NOT NULL GROUP BY ALL), d2 AS (SELECT doc_id, b, a, count(*) AS n FROM p WHERE b IS NOT NULL GROUP BY ALL),
n3 AS (SELECT c, b, a, count(*) AS n FROM p WHERE c IS NOT NULL GROUP BY ALL), d3 AS (SELECT doc_id, c, b, a, count(*) AS n FROM p WHERE c IS NOT NULL GROUP BY ALL),
e1 AS (SELECT doc_id, a, n1.n - d1.n AS n FROM d1 JOIN n1 USING (a)),
e2 AS (SELECT doc_id, b, a, n2.n - d2.n AS n FROM d2 JOIN n2 USING (b, a)),
e3 AS (SELECT doc_id, c, b, a, n3.n - d3.n AS n FROM d3 JOIN n3 USING (c, b, a)),
r AS (SELECT doc_id, (SELECT count(*) FROM p) - len(words) AS rest FROM w),
x AS (
  SELECT p.doc_id, p.i, e1.n AS x1, e1b.n AS y1, e2.n AS x2, e2b.n AS y2, e3.n AS x3, r.rest
  FROM p JOIN r USING (doc_id) JOIN e1 ON e1.doc_id = p.doc_id AND e1.a = p.a
  LEFT JOIN e1 e1b ON e1b.doc_id = p.doc_id AND e1b.a = p.b
  LEFT JOIN e2 ON e2.doc_id = p.doc_id AND e2.b = p.b AND e2.a = p.a
  LEFT JOIN e2 e2b ON e2b.doc_id = p.doc_id AND e2b.b = p.c AND e2b.a = p.b
  LEFT JOIN e3 ON e3.doc_id = p.doc_id AND e3.c = p.c AND e3.b = p.b AND e3.a = p.a),
s1 AS (SELECT *, CASE WHEN x1 > 0 THEN ln(x1 / rest) ELSE ln(0.4) - ln(rest + 1) END AS l1 FROM x),
s2 AS (SELECT *, CASE WHEN x2 IS NULL THEN l1 WHEN x2 > 0 THEN ln(x2 / y1) ELSE ln(0.4) + l1 END AS l2 FROM s1),
s3 AS (SELECT *, CASE WHEN x3 IS NULL THEN l2 WHEN x3 > 0 THEN ln(x3 / y2) ELSE ln(0.4) + l2 END AS l3 FROM s2),
t AS (SELECT doc_id, sum(l3) AS s, count(*) AS n FROM s3 GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, round(coalesce(s, 0), 3) AS log_score, round(s / n, 5) AS mean_log_score FROM w LEFT JOIN t USING (doc_id)
"""


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = secrets.train(secrets.labelled_samples(docs))
    found = secrets.find_secrets(docs, model)
    base = F.filter("secrets", lambda x: x["kind"] != "markov")
    return found.select(
        "doc_id",
        *(F.size(kind).cast("long").alias(f"n_{kind}") for kind in ("assign", "access", "hex")),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
    )


def op4_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.decode(bpe.encode(docs, vocabulary_path()).drop("text"), vocabulary_path())
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("personal", lambda x: x["kind"].isin(*pii.KINDS))
    return found.select(
        "doc_id",
        *(F.size(kind).cast("long").alias(f"n_{kind}") for kind in pii.KINDS),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("personal")).alias("spans"),
    )


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = neighbours.build(neighbours.usable(table(spark, sf_dir, "embeddings")))
    return neighbours.search(index, index.where(F.col("vec_id") % 100 == 0))


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP9_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(words[i : i + 2], ' ') AS g
  FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(len(words) - 2, 1))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  WHERE 10 * na.n >= 9 * nb.n AND 10 * nb.n >= 9 * na.n
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 90 * (na.n + nb.n - count(*))),
r AS (SELECT doc_id AS x, doc_id AS y FROM w UNION SELECT r.x, e.y FROM r JOIN e ON e.x = r.y),
c AS (SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY x)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id FROM c LEFT JOIN n USING (doc_id)
"""


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        decontamination.is_contaminated().alias("contaminated"),
    )


OP10_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
bw AS (
  SELECT DISTINCT item, least(13, len(words)) AS size, array_to_string(words[i : i + least(13, len(words)) - 1], ' ') AS win
  FROM (SELECT item, words, unnest(generate_series(1, greatest(len(words) - 12, 1))) AS i FROM b WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (
  SELECT doc_id, size, i, array_to_string(words[i : i + size - 1], ' ') AS win
  FROM (SELECT doc_id, words, size, unnest(generate_series(1, len(words) - size + 1)) AS i FROM w, sizes WHERE len(words) >= size)),
hits AS (SELECT DISTINCT doc_id, i, size, item FROM dw JOIN bw USING (size, win)),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + size - 1)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM w LEFT JOIN hit_words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    repair = conversations.Repair(conversations.damage(turns))
    every = turns.select(F.struct("conv_id").alias("conv")).distinct()
    out = every.join(repair.summary(), "conv", "left").join(conversations.digests(repair.repaired()), "conv", "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return out.select(
        "conv.conv_id",
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def _op11_sql() -> str:
    """The edits by a recursion from the last row of each conversation: per state of the grammar (cost, audit, lines) of the best rest."""
    wanted, after = ("user", "user", "assistant", "user"), (3, 3, 4, 3)  # by state: nothing yet, after s, after u, after a
    kept = {1: {"s": 2, "u": 3}, 2: {"u": 3}, 3: {"a": 4}, 4: {"u": 3}}

    def option(cost: str, letter: str, line: str, rest: str) -> str:
        return f"{{'c': {cost} + {rest}.c, 'a': '{letter}' || {rest}.a, 'l': {line}{rest}.l}}"

    base = []
    for q in range(1, 5):
        options = [option("2", "D", "", f"n[{q}]")]
        line = f"['{wanted[q - 1]}:' || text] || "
        options.append(f"CASE WHEN NOT gone THEN {option('1 + more', 'R', line, f'n[{after[q - 1]}]')} END")
        line = "[role || ':' || text] || "
        options += [f"CASE WHEN NOT gone AND letter = '{x}' THEN {option('more', 'K', line, f'n[{to}]')} END" for x, to in kept[q].items()]
        base.append(f"list_sort(list_filter([{', '.join(options)}], lambda x: x IS NOT NULL))[1]")
    user, assistant = option("5", "I", "['user:'] || ", "b[3]"), option("5", "I", "['assistant:'] || ", "b[4]")
    both = "{'c': 10 + b[4].c, 'a': 'II' || b[4].a, 'l': ['user:', 'assistant:'] || b[4].l}"
    closed = [f"list_sort([b[1], {user}, {both}])[1]", f"list_sort([b[2], {user}, {both}])[1]", f"list_sort([b[3], {assistant}])[1]", f"list_sort([b[4], {user}])[1]"]
    end = "[{'c': 0::BIGINT, 'a': '', 'l': []::VARCHAR[]}, {'c': 10, 'a': 'II', 'l': ['user:', 'assistant:']}, {'c': 5, 'a': 'I', 'l': ['assistant:']}, {'c': 0, 'a': '', 'l': []}]"
    return rf"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
h AS (
  SELECT *, xor(4294967295, list_reduce(
    list_concat([4294967295::BIGINT], flatten(list_transform(range(1, len(k) + 1), lambda i: [CAST(ord(k[i]) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) % 20 AS h FROM k),
d AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
         CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(CASE h WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) FROM h)),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM d),
f AS (
  SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
         NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS unfinished, CASE WHEN role[1] IN ('s', 'u', 'a') THEN role[1] ELSE 'x' END AS letter,
         lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] AS pair FROM o),
g AS (SELECT *, blank OR again AS gone, NOT blank AND NOT again AND unfinished AS truncated, 5 * CAST(unfinished AS BIGINT) AS more FROM f),
c AS (
  SELECT conv_id, count(*) AS n_rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (NOT blank AND again) AS duplicate, count(*) FILTER (truncated) AS truncated,
         count(*) FILTER (i > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM g GROUP BY conv_id),
r AS (
  SELECT conv_id, n_rows + 1 AS i, {end} AS n FROM c
  UNION ALL
  SELECT conv_id, i, [{', '.join(closed)}] FROM (
    SELECT g.conv_id, g.i, [{', '.join(base)}] AS b FROM r JOIN g ON g.conv_id IS NOT DISTINCT FROM r.conv_id AND g.i = r.i - 1)),
e AS (SELECT c.*, n[1].c AS cost, n[1].a AS audit, array_to_string(n[1].l, chr(10)) AS repaired FROM c JOIN r ON r.conv_id IS NOT DISTINCT FROM c.conv_id AND r.i = 1),
every AS (SELECT DISTINCT conv_id FROM conversations)
SELECT every.conv_id, {', '.join(f'CAST(coalesce({x}, 0) AS BIGINT) AS {x}' for x in ('gaps', 'blank', 'duplicate', 'truncated', 'illegal', 'cost'))},
       coalesce(audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM every LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM every.conv_id
"""


OP11_SQL = _op11_sql()


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = pieces.decode(pieces.encode(docs, pieces_path()).drop("text"), pieces_path())
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM benchmark),
s AS (SELECT CAST(count(*) FILTER (WHERE len(words) > 0) AS BIGINT) AS n_docs, CAST(sum(len(words)) AS BIGINT) AS n_terms FROM w),
m AS (SELECT doc_id, words, 100 - 90 + ((90 * CAST(len(words) AS BIGINT) * n_docs) // n_terms) AS m FROM w, s WHERE len(words) > 0),
f AS (SELECT doc_id, m, term, count(*) AS tf FROM (SELECT doc_id, m, unnest(words) AS term FROM m) GROUP BY ALL),
k AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS weight FROM (SELECT term, count(*) AS df FROM f GROUP BY term), s),
r AS (
  SELECT item_id, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM q JOIN f USING (term) JOIN k USING (term) GROUP BY item_id, doc_id),
t AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM r WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM t WHERE rank <= 10
"""

QUERIES = {
    "op1_substrings": op1_substrings,
    "op2_lm_scores": op2_lm_scores,
    "op3_secrets": op3_secrets,
    "op4_suffixes": op4_suffixes,
    "op5_bpe": op5_bpe,
    "op6_toxicity": op6_toxicity,
    "op7_personal_data": op7_personal_data,
    "op8_neighbours": op8_neighbours,
    "op9_jaccard": op9_jaccard,
    "op10_decontamination": op10_decontamination,
    "op11_conversations": op11_conversations,
    "op12_sentencepiece": op12_sentencepiece,
    "op13_lexical": op13_lexical,
}

ORACLE = {
    "op1_substrings": OP1_SQL,
    "op2_lm_scores": OP2_SQL,
    "op9_jaccard": OP9_SQL,
    "op10_decontamination": OP10_SQL,
    "op11_conversations": OP11_SQL,
    "op13_lexical": OP13_SQL,
}

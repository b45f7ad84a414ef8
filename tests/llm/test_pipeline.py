import functools
import re

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
import test_jaccard
from tradeloom.llm import secrets, toxicity

FOLDER = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def contaminated(text, windows):
    own, hit = words(text), set()
    for size in {len(w) for w in windows}:
        for i in range(len(own) - size + 1):
            if tuple(own[i : i + size]) in windows:
                hit |= set(range(i, i + size))
    return bool(hit) and 20 * len(hit) >= len(own)


def hidden(text):
    spans = sorted(m.span() for p, keep in (
        (secrets.ASSIGN, lambda m: len(m[2]) >= 6), (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20), (r"[0-9a-f]+", lambda m: len(m[0]) >= 24)
    ) for m in re.finditer(p, text) if keep(m))
    out, at = "", 0
    for a, z in spans:
        if a >= at:
            out += text[at:a] + "[SECRET]"
        at = max(at, z)
    return out + text[at:]


def test_run_like_a_plain_version(spark, monkeypatch):
    monkeypatch.setattr(test_jaccard, "shingles", functools.partial(test_jaccard.shingles, size=5))
    read = lambda name: spark.read.parquet(f"{FOLDER}/{name}.parquet")
    docs = read("documents")
    # The trained score is the operator's own (its accuracy has a test); what follows is plain.
    kept = {r["doc_id"] for r in toxicity.score(docs, toxicity.train(docs, read("labels"))).where("score < 0.5").collect()}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] in kept]
    firsts = {i for i, _, c in test_jaccard.brute(rows, 80) if i == c}
    windows = set()
    for r in read("benchmark").collect():
        own = words(r["text"])
        windows |= {tuple(own[i : i + min(13, len(own))]) for i in range(max(1, len(own) - 12))} if own else set()
    expected = {i: hidden(t or "") for i, t in rows if i in firsts and not contaminated(t, windows)}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = corpus_pipeline.run(spark, FOLDER)
    assert got.columns == [*docs.columns, "ids"]
    got = got.collect()
    assert {r["doc_id"]: r["text"] or "" for r in got} == expected
    assert all(list(r["ids"]) == tokenizer.encode(r["text"] or "", add_special_tokens=False).ids for r in got)
    assert 0 < len(got) < docs.count()


@pytest.mark.parametrize("number", range(len(corpus_pipeline.STAGES)))
def test_stages_take_odd_rows(spark, number):
    name, stage = corpus_pipeline.STAGES[number]
    rows = [(1, None, "en", "s", 0), (2, "", None, None, None), (None, "a b c", "en", "s", 5), (3, "word " * 30_000, "en", "s", 1), (4, "same text here", "en", "s", 1), (5, "same text here", "en", "s", 1)]
    docs = spark.createDataFrame(rows, spark.read.parquet(f"{FOLDER}/documents.parquet").schema)
    out = stage(spark, docs, FOLDER).collect()
    assert len(out) == (5 if name == "near copies" else 6)
    assert stage(spark, docs.limit(0), FOLDER).count() == 0

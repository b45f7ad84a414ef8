import random
import re

import pytest

from tradeloom.llm import secrets
from tradeloom.llm.spans import joined

FIXED = {
    "assign": (re.compile(secrets.ASSIGN), lambda m: len(m[2]) >= 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    "hex": (re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
}


def brute(text):
    found = [(m.start(), i, m.end(), kind) for i, (kind, (p, keep)) in enumerate(FIXED.items()) for m in p.finditer(text or "") if keep(m)]
    return ",".join(f"{k}:{a}:{z}" for a, _, z, k in sorted(found))


def samples(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice(["tion", "er", "an", "the", "ing", "com", "get", "set_", "Value"]) for _ in range(4)) for _ in range(400)]
    keys = ["".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(24)) for _ in range(200)]
    return spark.createDataFrame([(k, True) for k in keys] + [(w, False) for w in words], "token string, random boolean"), words, keys


@pytest.fixture(scope="module")
def model(spark):
    return secrets.train(samples(spark)[0])


def test_base_spans_like_a_scan(spark, model):
    rng = random.Random(1)
    parts = ["password", "Token", "api_key", "APIKEY", "=", ": ", '"', "abc", "a1b2c3d4", "é", "日😀", "AKIA", "ABCDEFGH12345678", "0123456789abcdef01234567", " ", "\n", "secret=token:abcdef", "xyz=", "-", "passwd"]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 40))) for _ in range(400)]
    texts += [None, "", "a" * 100_000, "token=abc", "token=abcdef", "deadbeef" * 20_000, "token=" * 3000, " password = 'x' " * 2000]
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, hex int").repartition(8)
    from pyspark.sql import functions as F

    out = secrets.find_secrets(docs, model).select("doc_id", joined(F.filter("secrets", lambda x: x["kind"] != "markov")).alias("base")).collect()
    assert len(out) == len(texts)
    for r in out:
        assert r["base"] == brute(texts[r["doc_id"]])


def test_random_strings_without_a_keyword(spark, model):
    _, words, keys = samples(spark)
    fresh = ["Zk3QvT9xLw7RbN2pYs8dHc4J", "q8ZrW1mXv0KtB6nLj5Fs3Gh"]
    texts = [f"here {fresh[0]} stands", f"é日 {fresh[1]}", "x=" + fresh[0], " ".join(words[:50]), "1234567890123456 4111111111111111", f"password={fresh[0]}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["secrets"]] for r in secrets.find_secrets(docs, model).collect()}
    assert out[0] == [("markov", 5, 29)] and out[1] == [("markov", 3, 26)]
    assert [k for k, _, _ in out[2]] == ["markov"]
    assert out[3] == out[4] == [] and [k for k, _, _ in out[5]] == ["assign"]
    clean = {r["doc_id"]: r["text"] for r in secrets.redact(docs, model).collect()}
    assert clean[0] == "here [SECRET] stands" and clean[1] == "é日 [SECRET]" and clean[3] == texts[3] and clean[5] == "[SECRET]"


def test_samples_and_training(spark):
    rows = [(1, "password=abcdef123 hello worldly"), (1, "password=abcdef123 hello worldly"), (None, "token=zzzzzz"), (2, None)]
    got = secrets.labelled_samples(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["token"], r["random"]) for r in got) == [("abcdef123", True)] * 2 + [("worldly", False)] * 2
    empty = secrets.train(spark.createDataFrame([], "token string, random boolean"))
    assert set(empty) == {0.0}
    assert secrets.find_secrets(spark.createDataFrame([], "doc_id long, text string"), empty).count() == 0


def test_no_python_in_the_plan(spark, model):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    plan = secrets.find_secrets(docs, model)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan

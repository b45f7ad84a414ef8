import random
import re

from pyspark.sql import functions as F

from tradeloom.llm import pii
from tradeloom.llm.spans import joined


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def digits(m):
    return re.sub("[^0-9]", "", m[0])


FIXED = {
    "email": (re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda m: True),
    "ip": (re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda m: all(int(x) <= 255 for x in m[0].split("."))),
    "card": (re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
    "phone": (re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda m: 9 <= len(digits(m)) <= 15),
}


def brute(text):
    found = [(m.start(), i, m.end(), kind) for i, (kind, (p, keep)) in enumerate(FIXED.items()) for m in p.finditer(text or "") if keep(m)]
    return ",".join(f"{k}:{a}:{z}" for a, _, z, k in sorted(found))


def test_base_spans_like_a_scan(spark):
    rng = random.Random(4)
    parts = ["a@b.com", "x.y@", "@", "b@c@d.org", "1.2.3.4", "256.1.1.1.1", "000.0255.3.4", ".", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (415) 555-2671", "+44", " ", "-", "12", "é", "日😀", "_", "\n", "378282246310005", "0" * 30, "7", "+"]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 30))) for _ in range(600)]
    texts += [None, "", "a" * 100_000, "1" * 40_000, "a.b" * 30_000, "a@" + "b." * 20_000 + "c", "1 " * 30_000, "+1" * 20_000, "+1-" + "2-" * 20_000]
    docs = spark.createDataFrame([(i, t, "e") for i, t in enumerate(texts)], "doc_id long, text string, email string").repartition(8)
    out = pii.find_personal_data(docs)
    rows = out.select("doc_id", joined(F.filter("personal", lambda x: x["kind"].isin(*pii.KINDS))).alias("base")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r["base"] == brute(texts[r["doc_id"]]), repr((texts[r["doc_id"]] or "")[:200])


def revealing():
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    rows = [(i, " ".join(word() for _ in range(30))) for i in range(300)]
    # The name stands only by its address; "call" stands by everyone's, and elsewhere.
    rows += [(300 + i, f"{word()} {word()} call Zebulon at zeb@example.com {word()} {word()}") for i in range(4)]
    rows += [(310 + i, f"call someone at p{i}@example.org or {word()} call {word()}") for i in range(60)]
    return rows


def test_words_that_reveal_an_entity(spark):
    rows = revealing()
    docs = spark.createDataFrame([*rows, (303, rows[303][1]), (None, rows[302][1])], "doc_id long, text string")
    out = pii.find_personal_data(docs).collect()
    assert len(out) == len(rows) + 2
    extra = {}
    for r in out:
        extra.setdefault(r["doc_id"], []).append([(s["kind"], s["start"], s["end"]) for s in r["personal"] if s["kind"] in ("general", "remove")])
    for i in (300, 301, 302):
        at = rows[i][1].index("Zebulon")
        assert extra[i] == [[("remove", at, at + 7)]]
    assert extra[303] == extra[303][:1] * 2 and extra[None] == extra[302]
    assert not any(any(x) for i, x in extra.items() if i not in (300, 301, 302, 303, None))
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs, "doc_id").where("doc_id IS NOT NULL").collect()}
    assert "[EMAIL]" in clean[300] and "Zebulon" not in clean[300] and "call" in clean[300] and clean[5] == rows[5][1]


def test_too_few_texts_and_copies_reveal_nothing(spark):
    rows = [(i, "call Zebulon at zeb@example.com now") for i in range(10)] + [(20, "call Zebulon at zeb@example.com then")]
    out = pii.find_personal_data(spark.createDataFrame(rows + [(30 + i, "other words") for i in range(50)], "doc_id long, text string")).collect()
    assert {s["kind"] for r in out for s in r["personal"]} == {"email"}


def test_no_rows_and_no_python(spark):
    out = pii.find_personal_data(spark.createDataFrame([], "doc_id long, text string"))
    assert out.count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan

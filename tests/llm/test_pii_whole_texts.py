"""Words that reveal an entity far from it, without it, and short ones."""

import random

from tradeloom.llm import pii


def test_far_short_and_alone(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    filler = lambda n: " ".join(word() for _ in range(n))
    rows = [(i, filler(30)) for i in range(300)]
    # The name heads a text whose foot has the address; "Bo" is short. One more text names both without the address.
    rows += [(300 + i, f"Zebulon Bo {filler(60)} Zebulon {filler(60)} zeb@example.com") for i in range(8)]
    rows += [(310, f"{filler(20)} Zebulon {filler(20)} Bo {filler(5)}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    for i in (*range(300, 308), 310):
        assert "Zebulon" not in clean[i] and "Bo " not in clean[i]
    assert clean[5] == rows[5][1] and "[EMAIL]" in clean[300]
    spans = {r["doc_id"]: [(s["start"], s["end"]) for s in r["personal"] if s["kind"] in ("general", "remove")] for r in pii.find_personal_data(docs).collect()}
    text = dict(rows)[300]
    assert spans[300] == [(0, 7), (8, 10), (text.rindex("Zebulon"), text.rindex("Zebulon") + 7)]

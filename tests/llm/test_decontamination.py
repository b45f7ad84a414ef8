import pytest

from tradeloom.llm import decontamination

TWENTY = " ".join(f"w{i}" for i in range(20))


@pytest.mark.parametrize("per_pass", [2, 2_000_000])
def test_nulls_repeats_short_items_and_passes(spark, per_pass):
    items = spark.createDataFrame([(None, TWENTY), (1, "Short item"), (1, "Short item"), (2, None), (3, "..."), (4, TWENTY + " more")], "item_id long, text string")
    rows = [(1, TWENTY), (2, "a short ITEM here"), (3, None), (4, ""), (5, "other words"), (6, "x " * 500 + "short item")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in decontamination.find_contamination(docs, items, windows_per_pass=per_pass).collect()}
    assert got == {1: (20, 20, ["4"]), 2: (4, 2, ["1"]), 3: (0, 0, []), 4: (0, 0, []), 5: (2, 0, []), 6: (502, 2, ["1"])}
    assert sorted(r["doc_id"] for r in decontamination.remove_documents(docs, items).collect()) == [3, 4, 5, 6]


def test_only_an_item_without_an_id(spark):
    items = spark.createDataFrame([(None, TWENTY)], "item_id long, text string")
    row = decontamination.find_contamination(spark.createDataFrame([(1, TWENTY)], "doc_id long, text string"), items).first()
    assert (row["n_hit"], row["items"]) == (20, [])


def test_empty_tables(spark):
    docs, items = (spark.createDataFrame([], f"{i} long, text string") for i in ("doc_id", "item_id"))
    assert decontamination.find_contamination(docs, items).count() == 0
    assert decontamination.find_contamination(spark.createDataFrame([(1, "a")], "doc_id long, text string"), items).first()["n_hit"] == 0

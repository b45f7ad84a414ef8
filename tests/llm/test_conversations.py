import hashlib
import heapq
import itertools
import random
import re
import zlib

import duckdb
import pytest
from oracle import differences
from pyspark.sql import functions as F

from tradeloom.llm import conversations
from tradeloom.llm.queries import OP11_SQL, op11_conversations

SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
FOLDER = "/root/testdata/sf0.01"


def damaged(turns):
    out = []
    for conv, turn, role, text in turns:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def cheapest(rows):
    """Least (cost, audit) by a search over whole audits, with the repaired lines: rows are (role, text, fault)."""
    legal = lambda roles: re.fullmatch("(s?(ua)*)?", roles) or re.fullmatch("s?(ua)*u", roles)  # noqa: E731 - may still become legal
    heap = [(0, "", 0, "", ())]
    done = set()
    while heap:
        cost, audit, at, roles, lines = heapq.heappop(heap)
        state = (at, roles[-1:], len(roles) > 0)
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit, lines
        if state in done:
            continue
        done.add(state)
        steps = [(5, "I", 0, r, f"{r}:") for r in ("user", "assistant")]
        if at < len(rows):
            role, text, fault = rows[at]
            steps.append((2, "D", 1, "", None))
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                steps += [(1 + more, "R", 1, r, f"{r}:{text}") for r in ("user", "assistant")] + [(more, "K", 1, role or " ", f"{role}:{text}")]
        for price, letter, move, role, line in steps:
            now = roles + role[:1]
            if legal(now):
                heapq.heappush(heap, (cost + price, audit + letter, at + move, now, lines if line is None else (*lines, line)))
    raise AssertionError


def plain(turns):
    out = {}
    by_conv = {t[0]: [] for t in turns}
    for row in damaged(turns):
        by_conv[row[0]].append(row[1:])
    for conv, rows in by_conv.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        known = [r[0] for r in rows if r[0] is not None]
        seen, marked = set(), []
        for _, role, text in rows:
            fault = "blank" if not text.strip(SPACES) else "duplicate" if (role, text) in seen else "truncated" if text.strip(SPACES)[-1] not in ".!?" else ""
            seen.add((role, text))
            marked.append((role, text, fault))
        count = lambda f: sum(m[2] == f for m in marked)  # noqa: E731, B023
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(marked))
        cost, audit, lines = cheapest(marked)
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        out[conv] = (gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def run(spark, turns, tmp_path, partitions=3, **more):
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(partitions)
    df.withColumns({k: F.lit(v) for k, v in more.items()}).write.parquet(f"{tmp_path}/conversations.parquet")
    got = op11_conversations(spark, str(tmp_path)).collect()
    assert len({r[0] for r in got}) == len(got)
    return {r[0]: tuple(r[1:]) for r in got}


def talk(rng, n, roles=("user", "assistant")):
    texts = ["Yes.", "No?", "ok", "", " \t", "Well!", "so . ", "a.b", "It is.", "Then: done!"]
    return [(i, turn, rng.choice(roles), rng.choice(texts) + (str(rng.randrange(50)) + "." if rng.random() < 0.6 else "")) for i in range(n) for turn in sorted(rng.choices(range(9), k=rng.randint(0, 9)))]


@pytest.mark.parametrize("roles", [("user", "assistant"), ("system", "user", "assistant", "tool", "ultra", "", None)])
def test_like_a_search_over_all_edits(spark, tmp_path, roles):
    turns = talk(random.Random(len(roles)), 150, roles)
    assert run(spark, turns, tmp_path) == plain(turns)


def test_whole_table_like_the_search(spark):
    turns = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert {r[0]: tuple(r[1:]) for r in op11_conversations(spark, FOLDER).collect()} == plain(turns)


def test_nulls_ties_repeats_and_clashing_names(spark, tmp_path):
    turns = [(None, None, "user", "a."), (None, 1, "assistant", None), (None, 2, None, "x."), (7, 1, "user", "b."), (7, 1, "user", "b."), (7, 1, "assistant", "a."), (7, None, "system", "é。")]
    turns += [(8, t, None, None) for t in range(5)] + [(9, 5, "assistant", "z.\x85")]
    names = dict.fromkeys(("times", "pos", "letter", "conv", "_part", "fault", "said"), 3)
    del names["times"]
    assert run(spark, turns, tmp_path, **names) == plain(turns)


def test_sql_agrees_on_nulls_ties_and_repeats(spark, tmp_path):
    turns = talk(random.Random(3), 60, ("system", "user", "assistant", "tool", None)) + [(None, None, "user", "a."), (None, 1, "assistant", None), (None, 2, None, "x.")]
    run(spark, turns, tmp_path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    assert differences(op11_conversations(spark, str(tmp_path)), con, OP11_SQL) == []


def test_one_conversation_with_a_third_of_all_rows(spark, tmp_path):
    rng = random.Random(1)
    turns = talk(rng, 40) + [(1000, t, ("user", "assistant")[t % 2], f"{t}." if t % 50 else "again.") for t in range(400)]
    assert run(spark, turns, tmp_path, 5) == plain(turns)


def test_dropped_conversations_and_empty_tables(spark, tmp_path):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    got = run(spark, [(gone, 0, "user", "a.")], tmp_path)
    assert got == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert run(spark, [], tmp_path / "empty") == {}


def test_repaired_rows(spark):
    rows = [(1, 0, "assistant", "a."), (1, 1, "assistant", "b."), (2, 0, "user", "q"), (2, 1, "assistant", "A.")]
    repair = conversations.Repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = [(r["conv"]["conv_id"], r["role"], r["text"]) for r in repair.repaired().orderBy("conv", "row", "nth").collect()]
    assert got == [(1, "user", "a."), (1, "assistant", "b.")]


def test_a_node_is_made_once_for_a_common_suffix(monkeypatch):
    import pyarrow as pa

    made = []
    real = conversations._before
    monkeypatch.setattr(conversations, "_before", lambda letter, after: made.append(letter) or real(letter, after))
    signatures = sorted({"".join(x) for n in range(5) for x in itertools.product("uad", repeat=n)}, key=lambda x: x[::-1])
    list(conversations._solve(iter([pa.RecordBatch.from_pydict({"reduced": signatures})])))
    assert len(made) == len({x[i:] for x in signatures for i in range(len(x))})

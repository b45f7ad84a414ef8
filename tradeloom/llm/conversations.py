"""Conversation structure repair: cheapest edits by a suffix-shared automaton (DAWG) of all conversations.

A conversation must have the role initials ``(s?(ua)+)?``. Its rows may be kept (0), given the role user or
assistant (1), deleted (2; blank and duplicate rows must be), and rows user or assistant without text may be
inserted anywhere (5); a truncated row that is not deleted costs 5 more. What a repair costs depends only on a
conversation's signature: for each row its role and fault, with those that must go written alike.

* The distinct signatures of all conversations are sorted by their reverse, over ranges. Read in that order,
  signatures with a common suffix lie together, and a node (a suffix) is made once, while the stack of the
  nodes from the end still holds it; tasks next to each other share no more than the nodes of one signature.
* Each node gets, for each state of the grammar, the least cost to go and the first edit of the best audit
  suffix; of equal costs the edit with the ASCII-least letter, which makes the whole audit the least. A
  signature's audit is read off its path of nodes.
* Edits go back to conversations by signature and to rows by position.

``ordered`` deals the rows of all conversations by range, so that a conversation with a third of all rows
lies in several tasks; of its rows, only a few bytes each (signature, positions) ever meet in one row, never
their texts. Repeated rows meet before the shuffle. One conversation's signature is one value, so it must
have less than 2**31 rows.

Order: turn (nulls first), then role, then text. A null role or text counts as one space, as does an empty
role's initial; a null id is a conversation of its own, and a null turn is a turn. Other columns are not
carried along, so they cannot clash. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import work_dir

BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"
#: Anything but ASCII white space.
VISIBLE = r"[^\x20\x09-\x0D]"
#: The last such character ends a sentence.
FINISHED = r"[.!?][\x20\x09-\x0D]*\z"

#: Signature letters: role s, u, a or another (x); upper case if truncated. What must go: B blank, D duplicate, then the role.
REROLE, DELETE, INSERT, MARRED = 1, 2, 5, 5
#: States of the grammar: nothing yet, after s, after u, after a. A role leads on from a state to the next.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
STEPS = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The role that a new or changed row must have in each state, the letter of such an edit, and the state after it.
WANTED = {EMPTY: ("u", USER), SYSTEM: ("u", USER), USER: ("a", ASSISTANT), ASSISTANT: ("u", USER)}
NEVER = 1 << 60


def damage(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, times) damaged by a hash of id and turn: rows drop, lose text or marks, repeat, or change role."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", text("conv_id"), text("turn")).cast("binary")) % 20
    role, said = text("role"), text("text")
    rows = turns.select(
        "conv_id", "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(said, r"[.!?]", "")).otherwise(said).alias("text"),
        # A row stands for its repeats: a number, not further rows, goes through the shuffle.
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("times"),
    )
    return rows.where("times > 0")


def ordered(rows: DataFrame, folder: str) -> DataFrame:
    """(conv, turn, role, text, times, pos, letter, own, said): equal rows once with their number, in order.

    ``conv`` is a struct of the id, which makes a null id one like others. ``pos`` grows in the order of a
    conversation; ``own`` is a fault that the row alone shows; ``said`` a hash of role and text. ``rows`` may
    have ``times``, how often each is repeated.
    """
    times = F.col("times") if "times" in rows.columns else F.lit(1)
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    equal = rows.select(F.struct("conv_id").alias("conv"), "turn", role.alias("role"), text.alias("text"), times.cast("long").alias("times"))
    equal = equal.groupBy("conv", "turn", "role", "text").agg(F.sum("times").alias("times"))
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "text"]
    initial = F.substring("role", 1, 1)
    marked = equal.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "*",
        F.monotonically_increasing_id().alias("pos"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("x").alias("letter"),
        F.when(~F.col("text").rlike(VISIBLE), BLANK).when(~F.col("text").rlike(FINISHED), TRUNCATED).alias("own"),
        F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256).alias("said"),
    )
    marked.write.parquet(f"{folder}/rows")
    return rows.sparkSession.read.parquet(f"{folder}/rows")


def faults(stored: DataFrame) -> DataFrame:
    """(conv, turn, times, pos, letter, fault) of ordered rows. Of equal rows the first has the fault; those after it are duplicates, or blank."""
    # What was said before, by hash: only the first place of what occurs again meets the rows.
    first = stored.groupBy("conv", "said").agg(F.min("pos").alias("first"), F.count("*").alias("places")).where("places > 1").drop("places")
    known = stored.drop("role", "text").join(first, ["conv", "said"], "left")
    fault = F.when(F.col("own") == BLANK, BLANK).when(F.col("pos") > F.col("first"), DUPLICATE).otherwise(F.col("own"))
    return known.select("conv", "turn", "times", "pos", "letter", fault.alias("fault"))


def _letters(fault: Column, letter: Column, times: Column) -> Column:
    """A row's letters in the signature, repeats included: two for what must go, one otherwise."""
    blank, again = F.concat(F.lit("B"), letter), F.concat(F.lit("D"), letter)
    once = F.when(fault == BLANK, blank).when(fault == DUPLICATE, again).when(fault == TRUNCATED, F.upper(letter)).otherwise(letter)
    return F.concat(once, F.repeat(F.when(fault == BLANK, blank).otherwise(again), (times - 1).cast("int")))


def signatures(found: DataFrame) -> DataFrame:
    """(conv, signature, rows): the letters of each conversation in order, and the places of its rows with their numbers."""
    # The rows of each part (a task that ordered them) first, then the parts: no texts are gathered.
    slim = found.select(
        "conv", F.shiftright("pos", 33).alias("_part"),
        F.struct("pos", F.col("times").cast("int").alias("times"), _letters(F.col("fault"), F.col("letter"), F.col("times")).alias("letters")).alias("x"),
    )
    parts = slim.groupBy("conv", "_part").agg(F.array_sort(F.collect_list("x")).alias("x"))
    places = F.transform("x", lambda r: F.struct(r["pos"], r["times"]))
    parts = parts.select("conv", F.struct("_part", F.array_join("x.letters", "").alias("letters"), places.alias("rows")).alias("y"))
    whole = parts.groupBy("conv").agg(F.array_sort(F.collect_list("y")).alias("y"))
    return whole.select("conv", F.array_join("y.letters", "").alias("signature"), F.flatten("y.rows").alias("rows"))


def reduced(signature: Column) -> Column:
    """The signature as far as it matters for repair: rows that must go are all ``d``."""
    return F.regexp_replace(signature, "[BD].", "d")


class _Node:
    """A suffix of signatures: per state of the grammar the least cost to go and the best first edit."""

    __slots__ = ("cost", "edit")

    def __init__(self, cost: list[int], edit: list[str]):
        self.cost, self.edit = cost, edit


def _choose(options: list[tuple[int, str]]) -> tuple[int, str]:
    """The cheapest; of equal costs the least letter, whatever its case (case only tells the role)."""
    return min(options, key=lambda x: (x[0], x[1].upper()))


def _with_inserts(base: list[tuple[int, str]]) -> _Node:
    """Costs once rows may also be inserted here: user and assistant in turn, so never more than two in a row."""
    costs = [c for c, _ in base]
    for _ in range(3):
        costs = [min(c, INSERT + costs[WANTED[q][1]]) for q, c in enumerate(costs)]
    chosen = [_choose([base[q], (INSERT + costs[WANTED[q][1]], _cased("I", q))]) for q in range(4)]
    return _Node([c for c, _ in chosen], [e for _, e in chosen])


def _cased(letter: str, state: int) -> str:
    """An edit that gives the role user is upper case, assistant lower."""
    return letter if WANTED[state][0] == "u" else letter.lower()


def _end() -> _Node:
    return _with_inserts([(0, ""), (NEVER, ""), (NEVER, ""), (0, "")])


def _before(letter: str, after: _Node) -> _Node:
    """The node of a suffix with one more row in front."""
    base = []
    for q in range(4):
        options = [(DELETE + after.cost[q], "D")]
        if letter != "d":
            more = MARRED if letter.isupper() else 0
            options.append((REROLE + more + after.cost[WANTED[q][1]], _cased("R", q)))
            if (kept := STEPS.get((q, letter.lower()))) is not None:
                options.append((more + after.cost[kept], "K"))
        base.append(_choose(options))
    return _with_inserts(base)


def _read(signature: str, stack: list[_Node]) -> str:
    """The best edits of a signature, along its nodes from the whole signature to the end."""
    state, edits, depth = EMPTY, [], len(signature)
    while edit := stack[depth].edit[state]:
        edits.append(edit)
        kind = edit.upper()
        if kind == "K":
            state = STEPS[(state, signature[len(signature) - depth].lower())]
        elif kind != "D":
            state = WANTED[state][1]
        depth -= kind != "I"
    return "".join(edits)


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Signatures sorted by their reverse -> cost and edits of each. The stack holds the nodes of the last one."""
    stack, last = [_end()], ""
    for batch in batches:
        costs, edits = [], []
        for signature in batch.column("reduced").to_pylist():
            common = 0
            for x, y in zip(reversed(signature), reversed(last), strict=False):
                if x != y:
                    break
                common += 1
            del stack[common + 1 :]
            for i in range(len(signature) - common - 1, -1, -1):
                stack.append(_before(signature[i], stack[-1]))
            last = signature
            costs.append(stack[-1].cost[EMPTY])
            edits.append(_read(signature, stack))
        yield pa.RecordBatch.from_arrays([batch.column("reduced"), pa.array(costs, pa.int64()), pa.array(edits, pa.string())], ["reduced", "cost", "edits"])


def cheapest(signatures: DataFrame) -> DataFrame:
    """(reduced, cost, edits) of each distinct reduced signature. In ``edits`` lower case gives the role assistant; its upper case is the audit."""
    distinct = signatures.select("reduced").distinct()
    order = F.reverse("reduced")
    return distinct.repartitionByRange(order).sortWithinPartitions(order).mapInArrow(_solve, "reduced string, cost long, edits string")


class Repair:
    """The repair of a table of turns; each step is written to the work folder once, which cuts its lineage."""

    def __init__(self, rows: DataFrame):
        folder, read = work_dir(rows.sparkSession, "conversations"), rows.sparkSession.read
        self.rows = ordered(rows, folder)
        faults(self.rows).write.parquet(f"{folder}/faults")
        self.faults = read.parquet(f"{folder}/faults")
        signatures(self.faults).withColumn("reduced", reduced(F.col("signature"))).write.parquet(f"{folder}/signatures")
        self.signatures = read.parquet(f"{folder}/signatures")
        cheapest(self.signatures).write.parquet(f"{folder}/edits")
        self.edits = read.parquet(f"{folder}/edits")

    def summary(self) -> DataFrame:
        """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit) of each conversation with rows."""
        turns = self.faults.groupBy("conv", "turn").agg(F.lit(1).alias("_one"))
        span = F.max("turn") - F.min("turn") + 1 - F.count("turn")
        gaps = turns.groupBy("conv").agg(F.coalesce(span, F.lit(0)).cast("long").alias("gaps"))
        count = lambda pattern: F.regexp_count("signature", F.lit(pattern)).cast("long")
        initials = F.lower(F.regexp_replace("signature", "[BD]", ""))
        # Each place where a legal pair begins; the other neighbours are illegal.
        legal = F.regexp_count(initials, F.lit("(?=su|ua|au)"))
        judged = self.signatures.join(self.edits, "reduced").select(
            "conv", count("B").alias("blank"), count("D").alias("duplicate"), count("[SUAX]").alias("truncated"),
            (F.length(initials) - 1 - legal).cast("long").alias("illegal"), "cost", F.upper("edits").alias("audit"),
        )
        return gaps.join(judged, "conv")

    def repaired(self) -> DataFrame:
        """(conv, row, nth, role, text): the rows after repair; (row, nth) is their order in a conversation."""
        # One token a row: the inserts before it, its own edit, and after the last row those that follow.
        token = F.regexp_extract_all("edits", F.lit(r"([Ii]*[DKRr](?:[Ii]+\z)?)"), F.lit(1))
        places = F.flatten(F.transform("rows", lambda r: F.array_repeat(r["pos"], r["times"])))
        tokens = self.signatures.join(self.edits, "reduced").select(F.posexplode(F.arrays_zip(places.alias("pos"), token.alias("token"))).alias("row", "x"))
        letters = tokens.where("x.token != 'D'").select("row", "x.pos", F.posexplode(F.split("x.token", "")).alias("nth", "letter")).where("letter NOT IN ('D', '')")
        done = letters.join(self.rows.select("conv", "pos", "role", "text"), "pos")
        letter = F.col("letter")
        role = F.when(letter == "K", F.col("role")).when(letter.isin("I", "R"), "user").otherwise("assistant")
        return done.select("conv", "row", "nth", role.alias("role"), F.when(F.upper(letter) == "I", "").otherwise(F.col("text")).alias("text"))


def digests(repaired: DataFrame) -> DataFrame:
    """(conv, sha256) of the newline-joined lines ``role:text`` of each conversation.

    A digest needs a conversation's lines in order in one task; they stream through it and are never held.
    """
    line = F.concat_ws(":", "role", "text").cast("binary")
    rows = repaired.select("conv", "row", "nth", line.alias("line")).repartition("conv")
    dealt = rows.sortWithinPartitions("conv", "row", "nth").select("conv", "line")
    return dealt.mapInArrow(_digest, dealt.select("conv", F.lit("").alias("sha256")).schema)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current, digest, kind = None, None, None
    for batch in batches:
        done: list[tuple] = []
        kind = batch.column("conv").type
        for conv, line in zip(batch.column("conv").to_pylist(), batch.column("line").to_pylist(), strict=True):
            if digest is not None and conv == current:
                digest.update(b"\n" + line)
                continue
            if digest is not None:
                done.append((current, digest.hexdigest()))
            current, digest = conv, hashlib.sha256(line)
        if done:
            yield _pairs(done, kind)
    if digest is not None:
        yield _pairs([(current, digest.hexdigest())], kind)


def _pairs(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], kind), pa.array([r[1] for r in rows], pa.string())], ["conv", "sha256"])

"""Conversation repair against a search over all edits, whatever the chunks."""

import hashlib
import random
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from strata.llm import conversation_repair as repair

WHITE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, copies int"


def brute(rows):
    """Report and repaired turns of one conversation by trying every edit of every turn."""
    turns = []
    for turn, role, text, copies in rows:
        turns += [(turn, " " if role is None else role, " " if text is None else text)] * copies
    turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
    seen, kinds = set(), []
    for _, role, text in turns:
        body = text.rstrip(WHITE)
        kinds.append("blank" if not body else "duplicate" if (role, text) in seen else "cut" if body[-1] not in ".!?" else "")
        seen.add((role, text))

    @lru_cache(None)
    def best(i, shape, inserted):
        """Cheapest (cost, edits, lines) from turn i on; ``shape`` is the last initial put out."""
        options = []
        if i == len(turns) and shape in ("", "a"):
            options.append((0, "", ()))
        follows = "a" if shape == "u" else "u"
        role_of = {"u": "user", "a": "assistant"}
        if inserted < 3:
            cost, edits, lines = best(i, follows, inserted + 1)
            options.append((cost + 5, "I" + edits, (role_of[follows] + ":", *lines)))
        if i < len(turns):
            cost, edits, lines = best(i + 1, shape, 0)
            options.append((cost + 2, "D" + edits, lines))
            if kinds[i] in ("", "cut"):
                more, (_, role, text) = 5 * (kinds[i] == "cut"), turns[i]
                cost, edits, lines = best(i + 1, follows, 0)
                options.append((cost + 1 + more, "R" + edits, (f"{role_of[follows]}:{text}", *lines)))
                first = role[:1]
                if first == follows or (first == "s" and shape == ""):
                    cost, edits, lines = best(i + 1, first, 0)
                    options.append((cost + more, "K" + edits, (f"{role}:{text}", *lines)))
        return min(options, default=(10 ** 9, "", ()))

    cost, audit, lines = best(0, "", 0)
    known = [t[0] for t in turns if t[0] is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(turns, turns[1:])]
    return (max(known) - min(known) + 1 - len(set(known)) if known else 0, kinds.count("blank"), kinds.count("duplicate"), kinds.count("cut"),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()), lines


def random_conversations(seed, count, longest):
    pick = random.Random(seed)
    data = []
    for conv in [None, *range(count)]:
        for _ in range(pick.randint(0, longest)):
            data.append((conv, pick.choice([None, *range(longest)]),
                         pick.choice([None, "", "system", "user", "user", "assistant", "assistant", "User", "uncle"]),
                         pick.choice([None, "", " \n", "Yes.", "Yes. ", "no", "What?\n", "é 日本!", "and so", f"t{pick.random()}."]),
                         pick.choice([0, 1, 1, 1, 1, 2])))
    return data


def grouped(data):
    found = {}
    for conv, *row in data:
        found.setdefault(conv, []).append(tuple(row))
    return found


@pytest.mark.parametrize("chunk_turns", [1, 3, 4096])
def test_random_conversations(spark, chunk_turns):
    data = random_conversations(chunk_turns, 60, 9)
    turns = repair.turns_of(spark.createDataFrame(data, SCHEMA).repartition(3), F.col("copies"))
    pieces = repair.repaired_pieces(turns, chunk_turns)
    found = {row[0]: tuple(row[1:]) for row in repair.report(pieces).collect()}
    wanted = {conv: brute(rows) for conv, rows in grouped(data).items()}
    assert found == {conv: report for conv, (report, _) in wanted.items()}
    lines = {}
    for row in sorted(repair.repaired_turns(pieces).collect(), key=lambda r: (r.part, r.seq, r.place)):
        lines.setdefault(row.conv_id, []).append(f"{row.role}:{row.text}")
    assert lines == {conv: list(kept) for conv, (_, kept) in wanted.items() if kept}


@pytest.mark.parametrize("role", ["odd", "user", "system", "assistant"])
def test_one_long_conversation_over_many_tasks(spark, role):
    """Turns of one role never bring the vectors together, so the fix-up passes must end by what is known."""
    data = [(7, i, role if i % 50 else "user", f"text {i}.", 1) for i in range(701)] + [(8, 0, "user", "Hi.", 1)]
    turns = repair.turns_of(spark.createDataFrame(data, SCHEMA), F.col("copies"))
    found = {row[0]: tuple(row[1:]) for row in repair.report(repair.repaired_pieces(turns, 8)).collect()}
    assert found == {conv: shallow(rows) for conv, rows in grouped(data).items()}


def shallow(rows):
    import sys
    limit = sys.getrecursionlimit()
    sys.setrecursionlimit(20_000)
    try:
        return brute(rows)[0]
    finally:
        sys.setrecursionlimit(limit)


def test_repeated_rows_are_one_row_with_a_count(spark):
    data = [(1, 0, "user", "Same.", 1)] * 300 + [(1, 1, "assistant", "Fine.", 1), (1, 2, "user", "Same.", 1)]
    turns = repair.turns_of(spark.createDataFrame(data, SCHEMA), F.col("copies"))
    row = repair.report(repair.repaired_pieces(turns, 16)).first()
    assert (row.duplicate, row.cost, row.audit) == (300, 600, "K" + "D" * 299 + "KD")


def test_no_rows_clashing_columns_and_a_very_long_text(spark):
    empty = spark.createDataFrame([], "conv_id string, turn int, role string, text string")
    assert repair.report(repair.repaired_pieces(repair.turns_of(empty))).count() == 0
    data = [("a", 0, "user", "x" * 3_000_000 + "?", 1, 2), ("a", 1, "assistant", "y. " * 10, 3, 4), ("b", None, None, None, 5, 6)]
    clash = spark.createDataFrame(data, "conv_id string, turn int, role string, text string, part int, _conv int")
    found = {r.conv_id: r.audit for r in repair.report(repair.repaired_pieces(repair.turns_of(clash))).collect()}
    assert found == {"a": "KK", "b": "D"}


def test_vectors_are_few_and_reruns_stop_where_they_meet():
    assert len(repair.VECTORS) < 40
    codes = bytes([2, 3] * 50)
    first = repair.backward(codes, repair.FINAL)
    for fed in range(len(repair.VECTORS)):
        assert repair.backward(codes, fed, first) == repair.backward(codes, fed)

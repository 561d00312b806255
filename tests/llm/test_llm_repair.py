"""Conversation repair against a plain search and its SQL on odd rows."""

import random

import duckdb
from pyspark.sql import functions as F

from papertriage.llm import conversation_repair as C


def search(codes):
    """Cheapest (cost, audit) by carrying sets of derivations row by row."""
    states = {C.START: {(0, "")}}

    def grown(d):
        for _ in range(3):  # three inserts in a row never help
            for (q, c), r in C.STEP.items():
                if c in "ua":
                    d.setdefault(r, set()).update((x + C.INSERT, a + "I") for x, a in list(d.get(q, ())))
        return {q: set(sorted(v)[:40]) for q, v in d.items()}

    states = grown(states)
    for code in codes:
        new = {q: {(x + C.DELETE, a + "D") for x, a in v} for q, v in states.items()}
        extra = C.TRUNCATED if code.isupper() or code == "!" else 0
        for (q, c), r in C.STEP.items() if code != "-" else ():
            for x, a in states.get(q, ()):
                if c == code.lower():
                    new.setdefault(r, set()).add((x + extra, a + "K"))
                if c in "ua":
                    new.setdefault(r, set()).add((x + extra + C.REROLE, a + "R"))
        states = grown(new)
    return min(w for q in C.ACCEPTING for w in states.get(q, ()))


def test_agenda_finds_the_lightest_repair():
    rng = random.Random(1)
    for _ in range(1500):
        codes = [rng.choice("suaSUA-?!") for _ in range(rng.randrange(9))]
        assert C.repair(codes) == search(codes)


def test_pieces_join_to_the_same_repair(monkeypatch):
    monkeypatch.setattr(C, "BLOCK", 3)
    monkeypatch.setattr(C, "FAN_IN", 2)
    rng = random.Random(2)
    for _ in range(500):
        codes = [rng.choice("suaSUA-?!") for _ in range(rng.randrange(25))]
        whole = C.piece_of(codes)
        assert min(whole[C.START, q] for q in C.ACCEPTING if (C.START, q) in whole) == search(codes)


def test_audit_gives_legal_roles():
    rng = random.Random(3)
    for _ in range(300):
        rows = [(rng.choice(["system", "user", "assistant", "tool", ""]), rng.choice(["a.", "b", ""])) for _ in range(rng.randrange(12))]
        codes = [C.code_of(r, C.fault_of(r, t, (r, t) in rows[:i])) for i, (r, t) in enumerate(rows)]
        out = "".join(role[0] for _, role, _ in C.apply_audit(C.repair(codes)[1], rows))
        state = C.START
        for c in out:
            state = C.STEP[state, c]
        assert state in C.ACCEPTING


def odd(spark):
    rng = random.Random(5)
    roles = ["user", "assistant", "system", None, "tool", "", "user"]
    texts = ["a.", "b", "", " \t", None, "x?\n", "x!", "y. z", "long text. " * 9000]
    rows = [(rng.choice([None, 1, 2, 3, 4, 5, 6, 7]), rng.choice([None, 0, 1, 2, 3, 4, 5, 9]), rng.choice(roles), rng.choice(texts)) for _ in range(150)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_sql_agrees_on_nulls_ties_and_repeats(spark):
    rows = odd(spark)
    con = duckdb.connect()
    con.register("conversations", rows.toArrow())
    cur = con.execute(C.SQL)
    names = [c[0] for c in cur.description]
    want = sorted(cur.fetchall(), key=repr)
    clash = rows.withColumns({c: F.lit("x") for c in ("seg", "salt", "seen", "cost", "audit", "state", "mark")})
    assert sorted(map(tuple, C.repair_damaged(clash).select(*names).collect()), key=repr) == want


def test_cut_conversations_equal_whole_ones(spark):
    rows = odd(spark)
    one = rows.withColumn("conv_id", F.lit(None).cast("long")).union(rows.limit(5))
    want = sorted(map(tuple, C.repair_conversations(one, partitions=1).collect()), key=repr)
    assert sorted(map(tuple, C.repair_conversations(one, partitions=37).collect()), key=repr) == want


def test_empty_table(spark):
    none = odd(spark).where("false")
    assert C.repair_conversations(none).collect() == [] and C.repair_damaged(none).collect() == []

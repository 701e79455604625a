import hashlib
import random

import duckdb
import pytest

from tablefit.llm import conversations
from tablefit.llm.conversations import ASSISTANT, START, USER, cheapest_audit

SCHEMA = "conv_id long, turn long, role string, text string, conv string, digest string, gone string, code string, place long"


def brute(code):
    """(cost, audit) by taking rows one at a time, every state's least label kept."""
    def closed(best):
        while True:
            more = {}
            for q, (c, a) in best.items():
                to = ASSISTANT if q == USER else USER
                if (c + 2, a + "I") < best.get(to, (10 ** 9, "")):
                    more[to] = (c + 2, a + "I")
            if not more:
                return best
            best |= more

    best = closed({START: (0, "")})
    for r, f in zip(code[::2], code[1::2]):
        now = {}
        for q, (c, a) in best.items():
            ways = [(q, 3, "D")]
            if f not in "bd":
                to = ASSISTANT if q == USER else USER
                ways.append((to, 2 + (f == "t"), "R"))
                if (r, q) in (("s", 0), ("u", 0), ("u", 1), ("u", 3), ("a", 2)):
                    ways.append(({"s": 1, "u": 2, "a": 3}[r], int(f == "t"), "K"))
            for to, w, letter in ways:
                now[to] = min(now.get(to, (10 ** 9, "")), (c + w, a + letter))
        best = closed(now)
    return min(best[q] for q in (START, ASSISTANT) if q in best)


def test_audit_equals_dynamic_programming():
    rng = random.Random(3)
    for n in [*[k % 9 for k in range(4000)], 60, 500]:
        code = "".join(rng.choice("ssuuuaaat ") + rng.choice("bdtt-----") for _ in range(n))
        assert cheapest_audit(code) == brute(code), code


def test_long_conversation_in_proportion():
    rng = random.Random(5)
    code = "".join(rng.choice("uuaas") + rng.choice("bdt-----") for _ in range(100_000))
    cost, audit = cheapest_audit(code)
    assert len(audit) - audit.count("I") == 100_000 and cost > 0


@pytest.fixture(scope="module")
def messy(spark):
    rng = random.Random(9)
    rows = []
    for conv in [*range(60), None]:
        for turn in range(rng.randint(1, 8)):
            rows.append((conv, rng.choice([turn, turn, turn, None, turn * 3]), rng.choice(["user", "assistant", "system", "tool", "User", None, ""]),
                         rng.choice(["Hello there.", "what?  \n", "no end", "", " \t\x0b", None, "a.b!c?", "é\nü.", "x" * 50])))
    rows += [rows[0], rows[0], rows[5], (77, 0, "user", "word. " * 50_000)]
    rows += [(88, k % 700, "user" if k % 2 else "assistant", f"text {k % 400}.") for k in range(1500)]  # a hot conversation
    return rows


def test_equals_sql_on_messy_rows(spark, messy, tmp_path):
    df = spark.createDataFrame([(*r, "c", "d", "g", "x", 1) for r in messy], SCHEMA).repartition(4)
    path = str(tmp_path / "conversations.parquet")
    df.write.parquet(path)
    got = sorted(map(tuple, conversations.query(spark, str(tmp_path)).toPandas().astype(object).where(lambda t: t.notna(), None).values.tolist()), key=str)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{path}/*.parquet')")
    want = sorted(con.execute(conversations.ORACLE).fetchall(), key=str)
    assert [tuple(None if v is None else v if isinstance(v, str) else int(v) for v in r) for r in got] == want
    assert len(got) == len({r[0] for r in messy})


def test_repaired_turns_follow_the_grammar(spark, messy):
    df = spark.createDataFrame([(*r, "c", "d", "g", "x", 1) for r in messy if r[0] is not None], SCHEMA)
    rows = conversations.damaged(df)
    of = conversations.audits(rows)
    turns = {}
    for r in conversations.repaired(rows, of).collect():
        turns.setdefault(r["conv"], {})[r["place"]] = r
    for r in of.collect():
        mine = turns.get(r["conv"], {})
        assert sorted(mine) == list(range(len(mine)))
        initials = "".join(mine[k]["role"][0] for k in range(len(mine)))
        body = initials.removeprefix("s")
        assert body == "ua" * (len(body) // 2) and initials != "s"
        assert "".join(mine[k]["edit"] for k in range(len(mine))) == r["audit"].replace("D", "")


def test_dropped_and_empty(spark, tmp_path):
    import zlib

    gone = next(i for i in range(10_000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "Hi.")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "a" / "conversations.parquet"))
    got = conversations.query(spark, str(tmp_path / "a")).collect()
    assert [tuple(r) for r in got] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "b" / "conversations.parquet"))
    assert conversations.query(spark, str(tmp_path / "b")).count() == 0

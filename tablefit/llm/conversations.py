"""Repair of conversation structure by bidirectional shortest paths.

A conversation's rows, in order, are matched against the role grammar
``(s?(ua)+)?``. The edit lattice has a node for each (rows read, grammar state)
and an edge for each edit: Keep 0, Rerole 2, Delete 3, Insert 2; a truncated row
that stays costs 1 more, a blank or duplicate row has to go. Dijkstra's search
runs from both ends, one heap each; once the two smallest open distances together
exceed the best meeting, every edge at which a cheapest path crosses from one
search into the other is known. Of all of them the least concatenated audit (the
edits' initials) is read off letter by letter: a letter leads from a node to one
other node only, so the smallest letter that stays on a cheapest path is the
right one, and no audit strings are kept or compared.

Rows are shuffled by conversation twice and streamed in sorted order (sorts spill):
first narrow ones (fault flags, role initials, text digest), which give the audit;
then the texts behind their conversation's audit, hashed as they pass. A task never
holds a conversation's texts, only some 40 bytes for each row of the conversation
at hand. One audit and one running digest a conversation are sequential by nature.

Defined results: a null role or text (and a null in the key that decides the
damage) counts as one space; rows of one turn are ordered by role, then text
digest; a null ``conv_id`` is one conversation of its own; an empty role has no
initial and fits nowhere; repeated rows are judged as duplicates; a conversation
without rows has zeros, an empty audit and the digest of an empty string; an
empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from array import array

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablefit.llm.common import keep_table, table

WHITE = "".join(map(chr, (32, 9, 10, 11, 12, 13)))
KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
#: Grammar states: nothing yet, after the system turn, after a user, after an assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
ROLE_AT = {USER: "user", ASSISTANT: "assistant"}
INFINITE = (1 << 31) - 1
GAPS, COUNTS = "gaps", ("blank", "duplicate", "truncated", "illegal", "cost")
TURNS = ["conv", "place", "edit", "role", "text"]
ROWS = 2000


def _needed(state: int) -> int:
    """The state after the only user or assistant turn that may follow."""
    return ASSISTANT if state == USER else USER


def _kept(state: int, initial: str) -> int:
    """The state after keeping a row of that initial, or -1."""
    if initial == "s":
        return SYSTEM if state == START else -1
    if initial == "u":
        return USER if state != USER else -1
    return ASSISTANT if initial == "a" and state == USER else -1


def _forward(rows: str, node: int):
    """Edges ``(letter, cost, target)`` out of a node, in letter order."""
    i, q = divmod(node, 4)
    here = i < len(rows) // 2
    fault = rows[2 * i + 1] if here else ""
    if here:
        yield "D", DELETE, node + 4
    yield "I", INSERT, 4 * i + _needed(q)
    if here and fault not in "bd":
        extra = CUT if fault == "t" else 0
        to = _kept(q, rows[2 * i])
        if to >= 0:
            yield "K", KEEP + extra, 4 * i + 4 + to
        yield "R", REROLE + extra, 4 * i + 4 + _needed(q)


def _backward(rows: str, node: int):
    """Edges ``(letter, cost, source)`` into a node."""
    i, q = divmod(node, 4)
    for p in range(4):
        if i:
            for letter, cost, to in _forward(rows, 4 * i - 4 + p):
                if to == node:
                    yield letter, cost, 4 * i - 4 + p
        if q >= USER and _needed(p) == q:
            yield "I", INSERT, 4 * i + p


def goal(node: int, n: int) -> bool:
    """All rows read, in a state in which a conversation may end."""
    return node // 4 == n and node % 4 in (START, ASSISTANT)


def cheapest_audit(rows: str) -> tuple[int, str]:
    """Cost and least audit of ``rows``: two characters each, the role's initial
    and the fault (b, d, t or -)."""
    n = len(rows) // 2
    size = 4 * n + 4
    dist = [array("i", [INFINITE]) * size, array("i", [INFINITE]) * size]
    done = [bytearray(size), bytearray(size)]
    order = array("q")  # nodes in the order in which the forward search settled them
    # Ties by position, so that edges of cost 0 (a row kept) come from settled nodes.
    heaps = [[(0, 0, START)], [(0, 0, 4 * n + START), (0, 0, 4 * n + ASSISTANT)]]
    dist[0][START] = 0
    for _, _, node in heaps[1]:
        dist[1][node] = 0
    best = INFINITE
    while heaps[0] and heaps[1] and heaps[0][0][0] + heaps[1][0][0] <= best:
        side = 0 if heaps[0][0][0] <= heaps[1][0][0] else 1
        d, _, node = heapq.heappop(heaps[side])
        if done[side][node]:
            continue
        done[side][node] = 1
        if not side:
            order.append(node)
        mine, other = dist[side], dist[1 - side]
        if other[node] < INFINITE:
            best = min(best, d + other[node])
        for _, cost, to in (_backward if side else _forward)(rows, node):
            if d + cost < mine[to]:
                mine[to] = d + cost
                heapq.heappush(heaps[side], (d + cost, n - to // 4 if side else to // 4, to))
            if other[to] < INFINITE:
                best = min(best, d + cost + other[to])
    ahead, back = dist

    def on_path(spent, to, good):
        """Whether a cheapest path goes through ``to``, reached at cost ``spent``."""
        return (done[1][to] and spent + back[to] == best) or (done[0][to] and good[to] and spent == ahead[to])

    # Settled nodes from which a cheapest path goes on: across into the reverse search, within this one, or is over.
    good = bytearray(size)
    for node in reversed(order):
        good[node] = (goal(node, n) and ahead[node] == best) or any(on_path(ahead[node] + cost, to, good) for _, cost, to in _forward(rows, node))
    audit, node, spent = [], START, 0
    while not (spent == best and goal(node, n)):
        letter, cost, node = next(e for e in _forward(rows, node) if on_path(spent + e[1], e[2], good))
        audit.append(letter)
        spent += cost
    return best, "".join(audit)


def damaged(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """The query's damage: ``conv, turn, role, text, gone`` (``gone``: the row is dropped)."""
    space = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    kind = F.pmod(F.crc32(F.concat(space(F.col(conv_col)), F.lit(":"), space(F.col(turn_col)))), F.lit(20))
    text, role = space(F.col(text_col)), space(F.col(role_col))
    return turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (kind == 0).alias("gone"), F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def with_faults(rows: DataFrame) -> DataFrame:
    """Narrow rows ``conv, turn, role, digest, gone, code``: the role's initial and the first fault."""
    bare = F.rtrim(F.col("text"), F.lit(WHITE))
    facts = rows.select("conv", "turn", "role", F.sha2("text", 256).alias("digest"), "gone", (F.length(bare) == 0).alias("blank"),
                        (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("cut"))
    # One exchange by conversation serves the numbering of equal rows and the walk in turn order.
    seen = Window.partitionBy("conv", "gone", "role", "digest").orderBy(F.col("turn").asc_nulls_first())
    again = F.row_number().over(seen) > 1
    fault = F.when(F.col("blank"), "b").when(again, "d").when(F.col("cut"), "t").otherwise("-")
    initial = F.when(F.length("role") == 0, " ").otherwise(F.substring("role", 1, 1))
    return facts.repartition("conv").select("conv", "turn", "role", "digest", "gone", F.concat(initial, fault).alias("code"))


def conversations(batches):
    """``(type of conv, conv, iterator of row dicts)`` of batches sorted by conversation."""
    from itertools import groupby

    kind = None

    def rows():
        nonlocal kind
        for b in batches:
            kind = b.schema.field("conv").type
            for r in zip(*[c.to_pylist() for c in b.columns]):
                yield dict(zip(b.schema.names, r))

    for conv, group in groupby(rows(), lambda r: r["conv"]):
        yield kind, conv, group


def arrow(rows: list, *kinds, names):
    import pyarrow as pa

    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def audits(rows: DataFrame) -> DataFrame:
    """``conv, gaps, blank, duplicate, truncated, illegal, cost, audit`` of every conversation of ``rows``."""
    id_type = rows.schema["conv"].dataType.simpleString()
    streamed = (with_faults(rows).sortWithinPartitions("conv", "turn", "role", "digest")
                .select("conv", "turn", "gone", "code"))

    def run(batches):
        import pyarrow as pa

        names, kinds = ["conv", GAPS, *COUNTS, "audit"], [*[pa.int64()] * 6, pa.string()]
        out, conv_type = [], None
        for conv_type, conv, group in conversations(batches):
            codes, low, last, turns = [], None, None, 0
            for r in group:
                if r["gone"]:
                    continue
                codes.append(r["code"])
                if r["turn"] is not None and r["turn"] != last:
                    last, turns = r["turn"], turns + 1
                    low = last if low is None else low
            code = "".join(codes)
            initials, faults = code[::2], code[1::2]
            illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
            cost, audit = cheapest_audit(code)
            out.append((conv, 0 if low is None else last - low + 1 - turns, faults.count("b"), faults.count("d"), faults.count("t"),
                        illegal, cost, audit))
            if len(out) >= ROWS:
                yield arrow(out, conv_type, *kinds, names=names)
                out = []
        if out:
            yield arrow(out, conv_type, *kinds, names=names)

    longs = ", ".join(f"{c} long" for c in (GAPS, *COUNTS))
    return streamed.mapInArrow(run, f"conv {id_type}, {longs}, audit string")


def repaired(rows: DataFrame, of: DataFrame) -> DataFrame:
    """The repaired turns ``conv, place, edit, role, text`` (``place`` from 0), by
    the audits ``of``; a partition holds whole conversations, in order."""
    id_type = rows.schema["conv"].dataType.simpleString()
    none = F.lit(None).cast("string")
    turns = rows.filter(~F.col("gone")).select("conv", F.lit(1).alias("kind"), "turn", "role", F.sha2("text", 256).alias("digest"), "text")
    heads = of.select("conv", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), none.alias("role"), none.alias("digest"),
                      F.col("audit").alias("text"))
    streamed = (heads.union(turns).repartition("conv").sortWithinPartitions("conv", "kind", "turn", "role", "digest")
                .select("conv", "role", "text"))

    def run(batches):
        import pyarrow as pa

        for conv_type, conv, group in conversations(batches):
            audit, out, place, state = next(group)["text"], [], 0, START
            for letter in audit:
                row = next(group) if letter != "I" else None
                if letter == "D":
                    continue
                state = _kept(state, row["role"][0]) if letter == "K" else _needed(state)
                out.append((conv, place, letter, row["role"] if letter == "K" else ROLE_AT[state], row["text"] if row else ""))
                place += 1
                if len(out) >= ROWS:
                    yield arrow(out, conv_type, pa.int64(), pa.string(), pa.string(), pa.string(), names=TURNS)
                    out = []
            if out:
                yield arrow(out, conv_type, pa.int64(), pa.string(), pa.string(), pa.string(), names=TURNS)

    return streamed.mapInArrow(run, f"conv {id_type}, place long, edit string, role string, text string")


def digests(turns: DataFrame) -> DataFrame:
    """``conv, repaired_sha256`` of repaired turns in order: ``role:text`` lines joined by line feeds."""
    id_type = turns.schema["conv"].dataType.simpleString()

    def run(batches):
        import hashlib

        import pyarrow as pa

        out, conv_type = [], None
        for conv_type, conv, group in conversations(batches):
            sha = hashlib.sha256()
            for r in group:
                sha.update((("\n" if r["place"] else "") + r["role"] + ":" + r["text"]).encode())
            out.append((conv, sha.hexdigest()))
            if len(out) >= ROWS:
                yield arrow(out, conv_type, pa.string(), names=["conv", "repaired_sha256"])
                out = []
        if out:
            yield arrow(out, conv_type, pa.string(), names=["conv", "repaired_sha256"])

    return turns.mapInArrow(run, f"conv {id_type}, repaired_sha256 string")


def query(spark, sf_dir) -> DataFrame:
    rows = damaged(table(spark, sf_dir, "conversations"))
    of = keep_table(audits(rows), "audits")
    shas = digests(repaired(rows, of)).withColumnRenamed("conv", "at")
    return (of.join(shas, F.col("conv").eqNullSafe(F.col("at")), "left").drop("at")
            .withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256))).withColumnRenamed("conv", "conv_id"))


def _label(of: str, cost: str, letter: str, line: str = "''") -> str:
    """SQL: a label (cost in nine digits, audit, chr(1), repaired lines) carried over an edge."""
    return (f"lpad(CAST(CAST(left({of}, 9) AS INTEGER) + {cost} AS VARCHAR), 9, '0') || substr({of}, 10, strpos({of}, chr(1)) - 10) "
            f"|| '{letter}' || substr({of}, strpos({of}, chr(1))) || {line}")


def oracle() -> str:
    """The same, row by row: the least label of every grammar state, by a recursive query."""
    crc = ("xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(range(1, length(k) + 1), lambda i: CAST(ascii(k[i]) AS BIGINT))), "
           "lambda c, x: list_reduce(list_concat([xor(c, x)], range(8)), lambda d, y: xor(d >> 1, 3988292384 * (d & 1)))), 4294967295)")
    white = " || ".join(f"chr({ord(c)})" for c in WHITE)
    own = "chr(10) || role || ':' || text"
    stays = "CASE WHEN fault = 't' THEN 1 ELSE 0 END"

    def keep(initial, *froms):
        return f"CASE WHEN fault NOT IN ('b', 'd') AND initial = '{initial}' THEN least({', '.join(_label(q, f'({stays})', 'K', own) for q in froms)}, NULL) END"

    def rerole(role, *froms):
        each = ", ".join(_label(q, f"(2 + {stays})", "R", f"chr(10) || '{role}:' || text") for q in froms)
        return f"CASE WHEN fault NOT IN ('b', 'd') THEN least({each}, NULL) END"

    def inserted(role, q):
        return _label(q, "2", "I", f"chr(10) || '{role}:'")

    def closed(inner):
        return (f"SELECT c, i, q0, q1, u, least(a, {inserted('assistant', 'u')}) AS a FROM (SELECT c, i, q0, q1, "
                f"least(u, {inserted('user', 'q0')}, {inserted('user', 'q1')}, {inserted('user', 'a')}) AS u, a FROM ({inner}))")

    step = (f"SELECT s.c, s.i + 1 AS i, {_label('q0', '3', 'D')} AS q0, least({_label('q1', '3', 'D')}, {keep('s', 'q0')}) AS q1, "
            f"least({_label('u', '3', 'D')}, {keep('u', 'q0', 'q1', 'a')}, {rerole('user', 'q0', 'q1', 'a')}) AS u, "
            f"least({_label('a', '3', 'D')}, {keep('a', 'u')}, {rerole('assistant', 'u')}) AS a "
            "FROM paths AS s JOIN rows_ AS r ON s.c = r.c AND s.i + 1 = r.i")
    # Recursion starts from typed nulls: a conversation of no rows ends in q0.
    start = "SELECT c, 0 AS i, '000000000' || chr(1) AS q0, CAST(NULL AS VARCHAR) AS q1, CAST(NULL AS VARCHAR) AS u, CAST(NULL AS VARCHAR) AS a FROM convs"
    return (
        "WITH RECURSIVE convs AS (SELECT conv_id, row_number() OVER () AS c FROM (SELECT DISTINCT conv_id FROM conversations)), "
        "keyed AS (SELECT c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, "
        "coalesce(CAST(t.conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations AS t JOIN convs ON t.conv_id IS NOT DISTINCT FROM convs.conv_id), "
        f"kinds AS (SELECT *, {crc} % 20 AS kind FROM keyed), "
        "hurt AS (SELECT c, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text "
        "FROM kinds JOIN (SELECT unnest([1, 2]) AS copy) ON copy = 1 OR kind = 3 WHERE kind <> 0), "
        f"placed AS (SELECT *, left(role, 1) AS initial, rtrim(text, {white}) AS bare, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM hurt), "
        "rows_ AS MATERIALIZED (SELECT *, CASE WHEN bare = '' THEN 'b' WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 'd' "
        "WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '-' END AS fault, lag(initial) OVER (PARTITION BY c ORDER BY i) || initial AS pair FROM placed), "
        f"paths AS ({closed(start)} UNION ALL {closed(step)}), "
        "last AS (SELECT c, least(q0, a) AS label FROM paths QUALIFY row_number() OVER (PARTITION BY c ORDER BY i DESC) = 1), "
        "counts AS (SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, "
        "count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM rows_ GROUP BY c) "
        "SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, "
        "coalesce(illegal, 0) AS illegal, CAST(left(label, 9) AS BIGINT) AS cost, substr(label, 10, strpos(label, chr(1)) - 10) AS audit, "
        "sha256(substr(label, strpos(label, chr(1)) + 2)) AS repaired_sha256 FROM convs LEFT JOIN counts USING (c) JOIN last USING (c)")


ORACLE = oracle()

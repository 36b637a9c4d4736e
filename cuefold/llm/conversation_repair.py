"""Least-cost repair of the order of turns on a directed acyclic graph of edits.

A node is a place between rows and a state of the grammar (s?(ua)+)? of role initials; an arc keeps, reroles or
deletes the next row, or inserts a turn. Least costs from the front and from the back are computed over the
layers; an arc is tight when the costs before and after it and its own add up to the whole, and exactly the tight
arcs lie on cheapest repairs. From the first node the set of nodes that tight arcs with the least letter reach
is carried on (D < I < K < R), which spells the least of all cheapest audits.

Rows of a conversation are ordered by turn (null first), then role, text and place among copies. Null roles and
texts are a space. A row's first fault counts: blank, a duplicate of an earlier role and text, or truncated.
Keep costs 0, rerole 2, delete 3, insert 2; a truncated row that stays adds 1; blank rows and duplicates
have to go. Rows that repeat are duplicates; an empty table gives an empty one; null conversation ids are one
conversation.

Conversations of up to `segment` rows are streamed whole, sorted in the shuffle's partitions. Longer ones
(one may hold a third of all rows) are numbered by ranges and cut into segments; costs through a segment
are a matrix of 4 x 4 states in (min, +), one row each, whose products from both ends give the costs at its ends;
so segments are repaired in parallel, and what meets in one task is a matrix a segment. Digests of a long
conversation stream its segments through a task in order, one at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuefold.llm.batches import map_batches
from cuefold.llm.rows import of_hot_keys
from cuefold.llm.storage import written
from cuefold.operators.numbering import numbered

# The states' next ones by initial, the state an empty or whole sequence ends in, and the prices.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ENDS = (0, 3)
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
FAR = 1 << 60
SEGMENT = 4096
#: Conversations in segments are named to all tasks, so many at most; segments grow to keep it so.
MAX_LONG = 1 << 18

WHITE = " \t\n\v\f\r"
SOUND, BLANK, DUPLICATE, CUT = 0, 1, 2, 3
SEGMENTS = "segment int, n_segments int, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired string"


def fault(text: str) -> int:
    body = text.rstrip(WHITE)
    return BLANK if not body else SOUND if body[-1] in ".!?" else CUT


def own_arcs(fault: int, initial: str, state: int) -> Iterator[tuple[str, int, int]]:
    """Letter, cost and next state of what can be done with a row."""
    yield "D", DELETE, state
    if fault in (BLANK, DUPLICATE):
        return
    more = TRUNCATED if fault == CUT else 0
    if initial in NEXT[state]:
        yield "K", more, NEXT[state][initial]
    yield "R", REROLE + more, 3 if state == 2 else 2


def inserted(state: int) -> int:
    """The state after an inserted turn: an assistant's after a user's, else a user's."""
    return 3 if state == 2 else 2


def with_inserts(costs: list[int]) -> list[int]:
    """Costs from the front to a place, inserts there included."""
    a, b, c, d = costs
    c = min(c, a + INSERT, b + INSERT, d + INSERT)
    return [a, b, c, min(d, c + INSERT)]


def before_inserts(costs: list[int]) -> list[int]:
    """Costs from a place to the end, inserts there included."""
    a, b, c, d = costs
    c = min(c, d + INSERT)
    return [min(a, c + INSERT), min(b, c + INSERT), c, min(d, c + INSERT)]


def forward(faults: list[int], initials: list[str], start: list[int], last: bool) -> list[list[int]]:
    """Least costs from the front for each place; inserts after the last row only where the conversation ends there."""
    out, costs = [], start
    for f, r in zip(faults, initials, strict=True):
        costs = with_inserts(costs)
        out.append(costs)
        after = [FAR] * 4
        for q in range(4):
            for _, cost, to in own_arcs(f, r, q):
                after[to] = min(after[to], costs[q] + cost)
        costs = after
    out.append(with_inserts(costs) if last else costs)
    return out


def backward(faults: list[int], initials: list[str], end: list[int], last: bool) -> list[list[int]]:
    """Least costs to the end for each place."""
    costs = before_inserts(end) if last else end
    out = [costs]
    for f, r in zip(reversed(faults), reversed(initials), strict=True):
        costs = before_inserts([min(cost + costs[to] for _, cost, to in own_arcs(f, r, q)) for q in range(4)])
        out.append(costs)
    return out[::-1]


def tight_walk(faults: list[int], initials: list[str], start: list[int], end: list[int], last: bool) -> tuple[list[tuple[str, int]], int]:
    """Letters with the state that each leads to, along the least of the cheapest audits, and the state at the end."""
    front, back = forward(faults, initials, start, last), backward(faults, initials, end, last)
    n, least = len(faults), min(a + b for a, b in zip(front[0], back[0], strict=True))
    frontier = {(0, q) for q in range(4) if start[q] + back[0][q] == least}
    came: list[dict[tuple[int, int], tuple[tuple[int, int], str]]] = []
    while True:
        if not last and any(i == n for i, _ in frontier) or last and any(i == n and q in ENDS and back[n][q] == 0 for i, q in frontier):
            break
        arcs: dict[str, dict[tuple[int, int], tuple[tuple[int, int], str]]] = {}
        for i, q in sorted(frontier):
            options = [("I", INSERT, i, inserted(q))]
            if i < n:
                options += [(letter, cost, i + 1, to) for letter, cost, to in own_arcs(faults[i], initials[i], q)]
            for letter, cost, j, to in options:
                if front[i][q] + cost + back[j][to] == least:
                    arcs.setdefault(letter, {}).setdefault((j, to), ((i, q), letter))
        came.append(arcs[min(arcs)])
        frontier = set(came[-1])
    at = min(x for x in frontier if x[0] == n and (not last or x[1] in ENDS))
    final, steps = at[1], []
    for step in reversed(came):
        before, letter = step[at]
        steps.append((letter, at[1]))
        at = before
    return steps[::-1], final


def spelled(steps: list[tuple[str, int]], roles: list[str], texts: list[str]) -> tuple[str, list[str]]:
    """The audit and the repaired turns."""
    turns, i = [], 0
    for letter, state in steps:
        role = "assistant" if state == 3 else "user"
        if letter == "I":
            turns.append(f"{role}:")
            continue
        if letter != "D":
            turns.append(f"{roles[i] if letter == 'K' else role}:{texts[i]}")
        i += 1
    return "".join(letter for letter, _ in steps), turns


def cost_of(steps: list[tuple[str, int]], faults: list[int]) -> int:
    total, i = 0, 0
    for letter, _ in steps:
        total += {"I": INSERT, "D": DELETE, "R": REROLE, "K": 0}[letter]
        if letter != "I":
            total += TRUNCATED * (faults[i] == CUT and letter != "D")
            i += 1
    return total


def illegal(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))


START, END = [0, FAR, FAR, FAR], [0, FAR, FAR, 0]


def repaired_whole(turns: list[int | None], roles: list[str], texts: list[str]) -> dict:
    """The report and the repair of one conversation."""
    seen: set[tuple[str, str]] = set()
    faults = []
    for role, text in zip(roles, texts, strict=True):
        f = fault(text)
        faults.append(DUPLICATE if f != BLANK and (role, text) in seen else f)
        seen.add((role, text))
    initials, known = [r[:1] for r in roles], {t for t in turns if t is not None}
    steps, _ = tight_walk(faults, initials, START, END, True)
    audit, kept = spelled(steps, roles, texts)
    return {
        "segment": 0, "n_segments": 1, "gaps": max(known) - min(known) + 1 - len(known) if known else 0, "blank": faults.count(BLANK),
        "duplicate": faults.count(DUPLICATE), "truncated": faults.count(CUT), "illegal": illegal(initials), "cost": cost_of(steps, faults), "audit": audit, "repaired": "\n".join(kept),
    }


def _short(rows: DataFrame, kind: str) -> DataFrame:
    """Whole conversations, streamed from sorted partitions."""
    schema = f"conv_id {kind}, {SEGMENTS}"
    names = ["conv_id", *repaired_whole([], [], [])]

    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at, own = [], None, ([], [], [])
        out_kind = None

        def done() -> None:
            held.append({"conv_id": at[0], **repaired_whole(*own)})

        def table() -> pa.RecordBatch:
            found = pa.RecordBatch.from_pylist(held, pa.schema([("conv_id", out_kind), *[(c, pa.string() if c in ("audit", "repaired") else pa.int32() if "segment" in c else pa.int64()) for c in names[1:]]]))
            held.clear()
            return found

        for batch in batches:
            out_kind = batch.schema.field(0).type
            for conv, present, turn, role, text in zip(*[c.to_pylist() for c in batch.columns[:5]], strict=True):
                if at is None or at[0] != conv:
                    if at is not None:
                        done()
                    at, own = (conv,), ([], [], [])
                if present:
                    for column, value in zip(own, (turn, role, text), strict=True):
                        column.append(value)
            if len(held) > 512:
                yield table()
        if at is not None:
            done()
            yield table()

    sorted_ = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text", "copy")
    # a literal, so that Spark drops what asks for conversations of several segments
    return map_batches(sorted_.select("conv_id", "present", "turn", "role", "text"), repaired, schema).withColumn("n_segments", F.lit(1))


def _faults(numbers: DataFrame, least: int) -> DataFrame:
    """numbers (conv_id, place, role, text) with fault, where the first of each role and text is no duplicate."""
    rows = numbers.withColumn("said", F.sha2(F.concat_ws("\x00", F.to_json(F.struct("conv_id")), F.sha2("role", 256), F.sha2("text", 256)), 256))
    firsts = written(rows.groupBy("said").agg(F.min("place").alias("first"), F.count("*").alias("n")), "firsts")
    body = F.rtrim(F.col("text"), F.lit(WHITE))
    own = F.when(body == "", BLANK).when(F.col("place") > F.col("first"), DUPLICATE).when(F.substring(body, -1, 1).isin(".", "!", "?"), SOUND).otherwise(CUT)
    return of_hot_keys(rows, firsts, "said", least).withColumn("fault", own).drop("said", "first", "n")


def _products(part: pd.DataFrame) -> pd.DataFrame:
    """For the segments of one conversation, in order: costs at their front and back, by (min, +) products."""
    part = part.sort_values("segment").reset_index(drop=True)
    matrices = np.array(part["matrix"].tolist(), np.int64).reshape(-1, 4, 4)
    front, back = [START], [END]
    for m in matrices[:-1]:
        front.append(np.minimum((np.array(front[-1])[:, None] + m).min(0), FAR).tolist())
    for m in matrices[:0:-1]:
        back.append(np.minimum((m + np.array(back[-1])[None, :]).min(1), FAR).tolist())
    crossings = [0, *[int(a[-1:] + b[:1] not in ("su", "ua", "au")) for a, b in zip(part["closes"], part["opens"][1:], strict=False)]]
    return pd.DataFrame({"conv_id": part["conv_id"], "segment": part["segment"], "n_segments": len(part), "front": front, "back": back[::-1], "crossing": crossings})


def _entries(part: pd.DataFrame) -> pd.DataFrame:
    """The state in which the walk enters each segment of one conversation."""
    part = part.sort_values("segment").reset_index(drop=True)
    states = [0]
    for exits in part["exits"][:-1]:
        states.append(int(exits[states[-1]]))
    return pd.DataFrame({"conv_id": part["conv_id"], "segment": part["segment"], "entry": pd.array(states, "int32")})


def _from_state(q: int, front: Iterable[int]) -> list[int]:
    return [c if p == q else FAR for p, c in enumerate(front)]


def _long(rows: DataFrame, kind: str, segment: int, hot: int) -> DataFrame:
    """Conversations in segments of `segment` rows."""
    order = [F.col("conv_id"), F.asc_nulls_first("turn"), F.col("role"), F.col("text"), F.col("copy")]
    present = rows.where("present").drop("present")
    numbers = numbered(present, order, "place")
    begins = numbers.groupBy("conv_id").agg(F.min("place").alias("begins"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv"))
    numbers = numbers.join(F.broadcast(begins.withColumnRenamed("conv_id", "_conv")), same).drop("_conv")
    numbers = numbers.withColumn("segment", F.floor((F.col("place") - F.col("begins")) / segment).cast("int")).drop("begins")
    judged = written(_faults(numbers, hot).withColumn("initial", F.substring("role", 1, 1)), "judged")
    slim = judged.select("conv_id", "segment", "place", "fault", "initial")
    sums = judged.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"), *[F.count_if(F.col("fault") == k).alias(c) for k, c in ((BLANK, "blank"), (DUPLICATE, "duplicate"), (CUT, "truncated"))]
    )

    def through(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("place")
        faults, initials = part["fault"].tolist(), part["initial"].tolist()
        last = bool(part["last"].iloc[0])
        matrix = [c for q in range(4) for c in forward(faults, initials, _from_state(q, [0] * 4), last)[-1]]
        return pd.DataFrame({"conv_id": part["conv_id"].iloc[:1], "segment": part["segment"].iloc[:1], "matrix": [matrix], "opens": initials[0], "closes": initials[-1], "illegal": illegal(initials)})

    ends = F.broadcast(judged.groupBy("conv_id").agg(F.max("segment").alias("_last")).withColumnRenamed("conv_id", "_conv"))
    marked = lambda x: x.join(ends, same).withColumn("last", F.col("segment") == F.col("_last")).drop("_conv", "_last")
    key = ["conv_id", "segment"]
    matrices = written(marked(slim).groupBy(*key).applyInPandas(through, f"conv_id {kind}, segment int, matrix array<bigint>, opens string, closes string, illegal long"), "matrices")
    costs = matrices.groupBy("conv_id").applyInPandas(_products, f"conv_id {kind}, segment int, n_segments int, front array<bigint>, back array<bigint>, crossing int")
    costs = written(costs, "costs")
    with_costs = lambda x, c: x.join(c.select(F.col("conv_id").alias("_conv"), F.col("segment").alias("_segment"), *[k for k in c.columns if k not in key]), same & (F.col("segment") == F.col("_segment"))).drop("_conv", "_segment")

    def leaves(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("place")
        faults, initials, row = part["fault"].tolist(), part["initial"].tolist(), part.iloc[0]
        last = int(row["segment"]) == int(row["n_segments"]) - 1
        front, back = [int(c) for c in row["front"]], [int(c) for c in row["back"]]
        exits = [tight_walk(faults, initials, _from_state(q, front), back, last)[1] if front[q] < FAR else 0 for q in range(4)]
        return pd.DataFrame({"conv_id": part["conv_id"].iloc[:1], "segment": part["segment"].iloc[:1], "exits": [exits]})

    exits = with_costs(slim, costs).groupBy(*key).applyInPandas(leaves, f"conv_id {kind}, segment int, exits array<int>")
    entries = written(exits.groupBy("conv_id").applyInPandas(_entries, f"conv_id {kind}, segment int, entry int"), "entries")

    def walked(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("place")
        faults, initials, row = part["fault"].tolist(), part["initial"].tolist(), part.iloc[0]
        last = int(row["segment"]) == int(row["n_segments"]) - 1
        steps, _ = tight_walk(faults, initials, _from_state(int(row["entry"]), [int(c) for c in row["front"]]), [int(c) for c in row["back"]], last)
        audit, turns = spelled(steps, part["role"].tolist(), part["text"].tolist())
        return pd.DataFrame({"conv_id": part["conv_id"].iloc[:1], "segment": part["segment"].iloc[:1], "n_segments": int(row["n_segments"]), "cost": cost_of(steps, faults), "audit": audit, "repaired": "\n".join(turns)})

    known = with_costs(with_costs(judged.select(*key, "place", "fault", "initial", "role", "text"), costs), entries)
    out = known.groupBy(*key).applyInPandas(walked, f"conv_id {kind}, segment int, n_segments int, cost long, audit string, repaired string")
    paid = with_costs(with_costs(out, matrices.select(*key, "illegal")), costs.select(*key, "crossing"))
    said = sums.withColumnRenamed("conv_id", "_conv")
    on_first = lambda c: F.when(F.col("segment") == 0, F.col(c)).otherwise(F.lit(0)).cast("long").alias(c)
    return paid.join(F.broadcast(said), same).select(
        "conv_id", "segment", "n_segments", *[on_first(c) for c in ("gaps", "blank", "duplicate", "truncated")], (F.col("illegal") + F.col("crossing")).cast("long").alias("illegal"), "cost", "audit", "repaired"
    )


def repair(
    rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    copy_col: str | None = None, present_col: str | None = None, segment: int = SEGMENT,
) -> DataFrame:
    """conv_id, segment, n_segments, the report's gaps, blank, duplicate, truncated, illegal and cost, audit and repaired (the turns as role:text by lines).

    A conversation has one row, or one for each segment if it is longer than `segment` rows: its counts are the sums, its audit
    the segments' one after the other. Rows whose `present_col` is false or null only name their conversation; equal rows are ordered by `copy_col`."""
    space = lambda c: F.coalesce(rows[c].cast("string"), F.lit(" "))
    copy = rows[copy_col].cast("int") if copy_col else F.lit(0)
    present = F.coalesce(rows[present_col], F.lit(False)) if present_col else F.lit(True)
    slim = rows.select(rows[conv_col].alias("conv_id"), present.alias("present"), rows[turn_col].cast("long").alias("turn"), space(role_col).alias("role"), space(text_col).alias("text"), copy.alias("copy"))
    kind = slim.schema["conv_id"].dataType.simpleString()
    sizes = written(slim.where("present").groupBy("conv_id").agg(F.count("*").alias("n")).where(F.col("n") > segment), "long")
    n_long, n_rows = sizes.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    if n_long > MAX_LONG:
        segment = max(segment, n_rows // MAX_LONG)
        sizes = sizes.where(F.col("n") > segment)
        n_long = sizes.count()
    if not n_long:
        return _short(slim, kind)
    long = F.broadcast(sizes.select(F.col("conv_id").alias("_conv")))
    same = F.col("conv_id").eqNullSafe(F.col("_conv"))
    return _short(slim.join(long, same, "left_anti"), kind).unionByName(_long(slim.join(long, same, "left_semi"), kind, segment, max(64, n_rows // 20_000)))


def repair_digests(repaired: DataFrame) -> DataFrame:
    """One row for each conversation: its counts, cost and audit, and the hash of the repaired turns, joined by newlines."""
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    whole = repaired.where("n_segments = 1").select("conv_id", *counts, "audit", F.sha2("repaired", 256).alias("repaired_sha256"))
    parts = repaired.where("n_segments > 1")
    kind = repaired.schema["conv_id"].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = digest = None
        begun = False
        for batch in batches:
            done = []
            for conv, segment, n, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if segment == 0:
                    at, digest, begun = conv, hashlib.sha256(), False
                if text:
                    digest.update((("\n" if begun else "") + text).encode())
                    begun = True
                if segment == n - 1:
                    done.append((at, digest.hexdigest()))
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], batch.schema.field(0).type), pa.array([d[1] for d in done])], ["conv_id", "repaired_sha256"])

    streamed = parts.repartition("conv_id").sortWithinPartitions("conv_id", "segment").select("conv_id", "segment", "n_segments", "repaired")
    digests = map_batches(streamed, hashed, f"conv_id {kind}, repaired_sha256 string").withColumnRenamed("conv_id", "_conv")
    spelt = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("segment", "audit"))), lambda x: x["audit"]), "").alias("audit")
    sums = parts.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in counts], spelt)
    return whole.unionByName(sums.join(digests, F.col("conv_id").eqNullSafe(F.col("_conv"))).select(*whole.columns))


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copy, present: conversations with faults at rows that a checksum of conversation and turn names.
    Of 20 remainders 0 drops a row (present is false), 1 empties its text, 2 takes its .!? away, 3 repeats it, 4 makes it a user's."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    h = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    slim = rows.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), h.alias("h"))
    text: Column = F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return slim.select("conv_id", "turn", F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(copies).alias("copy"), (F.col("h") != 0).alias("present"))


def oracle() -> str:
    """The digests in DuckDB: least (cost, audit) for each place and state, from the front. Equal costs at a node can't
    have audits of which one begins the other, as what is longer has more inserts, so the least prefix stays the least."""
    white = "|| ".join(f"chr({ord(c)})" for c in WHITE)
    space = lambda c: f"coalesce(CAST({c} AS VARCHAR), ' ')"
    checksum = f"xor(list_reduce(list_concat([4294967295], list_transform(string_split({space('conv_id')} || ':' || {space('turn')}, ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"
    return f"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
h AS (SELECT conv_id, turn, {space('role')} AS role, {space('text')} AS text, {checksum} % 20 AS h FROM conversations, crc),
d AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role, CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(range(CASE WHEN h = 3 THEN 2 ELSE 1 END)) AS copy FROM h WHERE h <> 0),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, rtrim(text, {white}) AS body, substr(role, 1, 1) AS c FROM d),
f AS (SELECT *, CASE WHEN body = '' THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2 WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault FROM r),
report AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated FROM f GROUP BY conv_id),
bad AS (SELECT conv_id, count(*) AS illegal FROM (SELECT conv_id, lag(c) OVER (PARTITION BY conv_id ORDER BY i) || c AS two FROM f) WHERE two NOT IN ('su', 'ua', 'au') GROUP BY conv_id),
ins(q, to_q, more, letters, turns) AS (VALUES (0, 0, 0, '', []::VARCHAR[]), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []), (0, 2, 2, 'I', ['user:']), (1, 2, 2, 'I', ['user:']), (3, 2, 2, 'I', ['user:']),
  (2, 3, 2, 'I', ['assistant:']), (0, 3, 4, 'II', ['user:', 'assistant:']), (1, 3, 4, 'II', ['user:', 'assistant:'])),
nxt(q, c, to_q) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
arcs AS (SELECT conv_id, i, q, q AS to_q, 3 AS more, 'D' AS letter, []::VARCHAR[] AS turns FROM f, (VALUES (0), (1), (2), (3)) s(q)
  UNION ALL SELECT conv_id, i, q, to_q, CASE WHEN fault = 3 THEN 1 ELSE 0 END, 'K', [role || ':' || text] FROM f JOIN nxt USING (c) WHERE fault IN (0, 3)
  UNION ALL SELECT conv_id, i, q, CASE WHEN q = 2 THEN 3 ELSE 2 END, CASE WHEN fault = 3 THEN 3 ELSE 2 END, 'R', [CASE WHEN q = 2 THEN 'assistant:' ELSE 'user:' END || text] FROM f, (VALUES (0), (1), (2), (3)) s(q) WHERE fault IN (0, 3)),
walk AS (SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS q, {{'cost': 0, 'audit': '', 'turns': []::VARCHAR[]}} AS best FROM conversations
  UNION ALL
  SELECT conv_id, i, q, min(best) FROM (SELECT w.conv_id, a.i, a.to_q AS q, {{'cost': w.best.cost + x.more + a.more, 'audit': w.best.audit || x.letters || a.letter, 'turns': list_concat(list_concat(w.best.turns, x.turns), a.turns)}} AS best
    FROM walk w JOIN ins x ON x.q = w.q JOIN arcs a ON a.conv_id IS NOT DISTINCT FROM w.conv_id AND a.i = w.i + 1 AND a.q = x.to_q) GROUP BY conv_id, i, q),
n AS (SELECT conv_id, max(i) AS n FROM walk GROUP BY conv_id),
whole AS (SELECT w.conv_id, min({{'cost': w.best.cost + x.more, 'audit': w.best.audit || x.letters, 'turns': list_concat(w.best.turns, x.turns)}}) AS best
  FROM walk w JOIN n ON n.conv_id IS NOT DISTINCT FROM w.conv_id AND n.n = w.i JOIN ins x ON x.q = w.q WHERE x.to_q IN (0, 3) GROUP BY w.conv_id)
SELECT w.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(best.cost AS BIGINT) AS cost, best.audit AS audit, sha256(array_to_string(best.turns, chr(10))) AS repaired_sha256
FROM whole w LEFT JOIN report r ON r.conv_id IS NOT DISTINCT FROM w.conv_id LEFT JOIN bad b ON b.conv_id IS NOT DISTINCT FROM w.conv_id"""

"""Embedding near-dedup, conversation repair and periodic runs against brute force."""

import hashlib
import heapq
import math
import random
import re
import zlib

import numpy as np
import pytest

from cuefold.llm import conversation_repair as repair
from cuefold.llm import cover_tree, periodic_runs, queries

SF = "/root/testdata/sf0.001"


# Embedding near-dedup


def brute_links(rows, cosine=0.98):
    """rows (vec_id, vector, label): (vec_id, n_links, component_id, kept) of each."""
    def sound(r):
        return r[1] is not None and r[2] is not None and len(r[1]) and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])

    n = len(rows)
    linked = [[] for _ in range(n)]
    for i in range(n):
        for j in range(i):
            a, b = rows[i], rows[j]
            if sound(a) and sound(b) and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], float), np.array(b[1], float)
                if (x * y).sum() / (np.sqrt((x * x).sum()) * np.sqrt((y * y).sum())) >= cosine:
                    linked[i].append(j)
                    linked[j].append(i)
    out, seen = [], {}
    for i in range(n):
        if i in seen:
            continue
        group, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()]:
                if j not in group:
                    group.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in group if rows[j][0] is not None]
        for j in group:
            seen[j] = min(ids) if ids else None
    for i in range(n):
        out.append((rows[i][0], len(linked[i]), seen[i], rows[i][0] == seen[i]))
    return sorted(out, key=repr)


def links_of(spark, rows, kind="float", **options):
    df = spark.createDataFrame([(*r, 1, "q") for r in rows], f"vec_id long, embedding array<{kind}>, label int, key int, n string")
    return sorted((tuple(r) for r in cover_tree.near_dedup(df, **options).collect()), key=repr)


def test_links_of_clusters_in_small_blocks_and_cells(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 8))
    rows = [(k, [float(np.float32(x)) for x in centres[k % 6] + rng.normal(size=8) * (0.02 + 0.3 * (k % 5 == 0))], 1 if k % 7 else 2) for k in range(150)]
    rows += [(200 + k, rows[3][1], 1) for k in range(40)]  # copies
    assert links_of(spark, rows, block_rows=8, sample=64, stripe=2) == brute_links(rows)
    assert links_of(spark, rows) == brute_links(rows)


def test_links_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (2, [0.0, 3.0], 1), (3, None, 1), (4, [0.0, 0.0], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1), (7, [None, 1.0], 1), (8, [1.0, 0.0], None),
        (9, [1.0, 0.0], 2), (10, [], 1), (11, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.01], 1), (12, [1e-300, 0.0], 1), (13, [1e300, 1e299], 3), (None, [5.0, 5.0], 4), (14, [1.0, 0.0], 1),
    ]
    got = links_of(spark, [r for r in rows if r[0] not in (12, 13)], "double")
    assert got == brute_links([r for r in rows if r[0] not in (12, 13)])
    tiny = {r[0]: r for r in links_of(spark, rows, "double")}
    assert tiny[12][1] == 4 and tiny[12][2] == 1 and tiny[13][1] == 0
    exact = [(1, [1.0, 0.0, 0.0, 0.0], 1), (2, [49.0, 9.0, 3.0, 3.0], 1), (3, [49.0, 9.0, 3.0, 3.001], 1)]  # a cosine of 49/50 and one just below
    assert links_of(spark, exact, "double") == brute_links(exact)
    assert links_of(spark, []) == []


def test_links_of_the_whole_table(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert sorted((tuple(r) for r in queries.op11_embedding_near_dedup(spark, SF).collect()), key=repr) == brute_links(rows)


def test_nodes_are_pruned_and_counted_whole():
    rng = np.random.default_rng(1)
    raw = np.repeat(np.eye(40), 20, axis=0) + rng.normal(size=(800, 40)) * 0.004
    tree = cover_tree.Tree.grown(np.arange(800), np.ones(800, np.int64), raw)
    links = cover_tree.Links(tree, tree)
    assert (links.of_a == 19).all() and links.visits < 100
    assert all(tree.radii[c] <= tree.radii[k] + 2 for k in range(len(tree.radii)) for c in tree.below(k))


# Conversation repair

ROLES = {"s": "system", "u": "user", "a": "assistant"}


def brute_repair(rows):
    """rows (turn, role, text) in order: the report, with the audit by search in order of (cost, audit)."""
    faults, seen = [], set()
    for _, role, text in rows:
        body = re.findall("[^\x20\x09-\x0d]", text)
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    after = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    heap, done = [(0, "", 0, 0, ())], set()
    while True:
        cost, audit, i, q, turns = heapq.heappop(heap)
        if i == len(rows) and q in (0, 3):
            break
        if (i, q) in done:
            continue
        done.add((i, q))
        for r in "ua":
            if (q, r) in after:
                heapq.heappush(heap, (cost + 2, audit + "I", i, after[q, r], (*turns, ROLES[r] + ":")))
        if i == len(rows):
            continue
        heapq.heappush(heap, (cost + 3, audit + "D", i + 1, q, turns))
        if faults[i] in ("blank", "duplicate"):
            continue
        more, (_, role, text) = faults[i] == "truncated", rows[i]
        for r in "ua":
            if (q, r) in after:
                heapq.heappush(heap, (cost + 2 + more, audit + "R", i + 1, after[q, r], (*turns, f"{ROLES[r]}:{text}")))
        if (q, role[:1]) in after:
            heapq.heappush(heap, (cost + more, audit + "K", i + 1, after[q, role[:1]], (*turns, f"{role}:{text}")))
    known = {t for t, _, _ in rows if t is not None}
    gaps = max(known) - min(known) + 1 - len(known) if known else 0
    bad = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    return gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), bad, cost, audit, hashlib.sha256("\n".join(turns).encode()).hexdigest()


CHAT = "conv_id long, turn long, role string, text string, copy string, segment int"


def random_chats(n=60, longest=14):
    rng = random.Random(5)
    texts = ["Yes.", "No", "", " \t", "What?", "Go on!", "One. Two", "x.", None]
    rows = []
    for c in range(n):
        for t in range(rng.randrange(1, longest)):
            rows.append((c if c else None, t + rng.randrange(2) if t % 9 else None, rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None]), rng.choice(texts)))
    return rows


def expected(rows):
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append((t, " " if role is None else role, " " if text is None else text))
    return {c: brute_repair(sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))) for c, own in by.items()}


@pytest.mark.parametrize("segment", [4096, 3, 1])
def test_repair_whole_and_in_segments(spark, segment):
    rows = random_chats()
    df = spark.createDataFrame([(*r, "z", 9) for r in rows], CHAT)
    got = {r.conv_id: tuple(r)[1:] for r in repair.repair_digests(repair.repair(df, segment=segment)).collect()}
    assert got == expected(rows)


def test_repair_of_nothing_and_of_dropped_rows(spark):
    none = spark.createDataFrame([], CHAT)
    assert repair.repair_digests(repair.repair(none)).collect() == []
    df = spark.createDataFrame([(1, 0, "user", "a", 0, False), (2, 0, "user", "Hi.", 0, True)], "conv_id string, turn int, role string, text string, copy int, present boolean")
    for segment in (4096, 1):  # many rows that are not there don't make a conversation long
        gone = spark.range(5).selectExpr("'3' AS conv_id", "cast(id AS int) AS turn", "'user' AS role", "'x' AS text", "0 AS copy", "cast(null AS boolean) AS present")
        rows = repair.repair_digests(repair.repair(df.unionByName(gone), copy_col="copy", present_col="present", segment=segment)).collect()
        assert sorted((r.conv_id, r.audit) for r in rows) == [("1", ""), ("2", "KI"), ("3", "")]
    got = {r.conv_id: r for r in repair.repair_digests(repair.repair(df, copy_col="copy", present_col="present")).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert tuple(got["1"])[1:] == (0, 0, 0, 0, 0, 0, "", empty)
    assert (got["2"].cost, got["2"].audit, got["2"].repaired_sha256) == (2, "KI", hashlib.sha256(b"user:Hi.\nassistant:").hexdigest())


def test_repair_query_against_brute_force(spark):
    rows = []
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        h = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        text = "" if h == 1 else re.sub("[.!?]", "", r.text) if h == 2 else r.text
        rows += [(r.conv_id, r.turn, "user" if h == 4 else r.role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    got = {r.conv_id: tuple(r)[1:] for r in queries.op12_conversation_repair(spark, SF).collect()}
    want = expected(rows)
    assert {c: v for c, v in got.items() if c in want} == want
    assert all(v[5:7] == (0, "") for c, v in got.items() if c not in want)


# Periodic runs


def brute_runs(w, least=12):
    n, out = len(w), []
    for p in range(1, n // 2 + 1):
        i = p
        while i < n:
            if w[i] != w[i - p]:
                i += 1
                continue
            j = i
            while j < n and w[j] == w[j - p]:
                j += 1
            s, t, i = i - p, j, j
            if t - s >= max(least, 2 * p) and not any(all(w[k] == w[k - q] for k in range(s + q, t)) for q in range(1, p)):
                out.append((s, t - s, p))
    return sorted(out, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("tabled", [1 << 16, 10])
def test_runs_of_random_words(monkeypatch, tabled):
    monkeypatch.setattr(periodic_runs, "TABLED", tabled)
    rng = random.Random(2)
    for _ in range(600):
        n, kinds = rng.randrange(90), rng.choice([1, 2, 3, 5, 20])
        w = [rng.randrange(kinds) for _ in range(n)]
        for _ in range(rng.randrange(3)):
            if n > 5:
                s, p = rng.randrange(n), rng.randrange(1, 12)
                for i in range(s + p, min(n, s + rng.randrange(1, 60))):
                    w[i] = w[i - p]
        assert periodic_runs.find_runs(np.array(w, np.int32)) == brute_runs(w)


def brute_document(doc_id, text):
    w = re.findall("[^\x20\x09-\x0d]+", text or "")
    n, h = len(w), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = brute_runs(w)
    gone = {k for s, length, p in runs for k in range(s + p, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        sha("".join(f"{s},{length},{p}\n" for s, length, p in runs)), sha(" ".join(x for k, x in enumerate(w) if k not in gone)),
    )


def digests(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, runs string, h int")
    return sorted((tuple(r) for r in periodic_runs.run_digests(periodic_runs.collapse_runs(periodic_runs.planted(df))).collect()), key=repr)


def test_runs_of_odd_documents(spark):
    tenth = [k for k in range(400) if zlib.crc32(str(k).encode()) % 10 == 0][:8]
    texts = [None, "", " \t\n", "one", "a b " * 9, "a\x0bb\x1cc " * 12, "x y z  x\ny z x y z x y z x y", "é ü é ü é ü é ü é ü é ü é ü"]
    rows = [(k, t) for k, t in zip(tenth, texts, strict=True)] + [(1000 + k, t) for k, t in enumerate(texts)] + [(None, "b " * 30), (7, "b " * 30), (7, "b " * 30)]
    rows += [(5000, " ".join(str(i % 97) for i in range(400))), (5001, "w " * 2000)]
    assert digests(spark, rows) == sorted((brute_document(*r) for r in rows), key=repr)
    assert digests(spark, []) == []


def test_runs_query_against_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op13_periodic_runs(spark, SF).collect()
    assert len(got) == len(docs)
    short = {i for i, t in docs.items() if len((t or "").split()) < 700}
    assert len(short) > len(docs) // 2
    for r in got:
        if r.doc_id in short:
            assert tuple(r) == brute_document(r.doc_id, docs[r.doc_id])

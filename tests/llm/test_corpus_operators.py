"""Mixing, dedup, near-dedup, top-k, toxicity and the pipeline against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from cuefold.llm import exact_dedup, mixing, queries, simhash, topk, toxicity
from cuefold.llm import rows as rows_of
from cuefold.llm.storage import written

SF = "/root/testdata/sf0.001"
WORDS = re.compile("[^\x20\x09-\x0d]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def frame(spark, rows):
    """(doc_id, text, source) with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, 1, "q", 2.0) for r in rows], "doc_id long, text string, source string, rid int, sha string, place double")


def waterfill(sizes, weights=(5, 2, 1), share=1.5, most=2):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-32-be")) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, target = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(w[s] for s in open_)
        over = {s for s in open_ if level * w[s] > most * sizes[s]}
        if not over:
            return target | {s: level * w[s] for s in open_}
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def check_mix(rows, docs):
    size = {d: len(WORDS.findall(t or "")) for d, t, _ in docs}
    source = {d: s for d, _, s in docs}
    total = defaultdict(int)
    for d, s in source.items():
        total[s] += size[d]
    want, taken, largest = waterfill(total), Counter(), Counter()
    assert len(rows) == len(docs)
    for r in rows:
        s = source[r.doc_id]
        assert (r.size, r.source_size) == (size[r.doc_id], total[s]) and r.target == pytest.approx(want[s], abs=1e-6)
        assert 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
        largest[s] = max(largest[s], r.size)
    for s in want:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6


def test_mixing_query_and_reruns(spark):
    docs = [(r.doc_id, r.text, r.source) for r in documents(spark).collect()]
    rows = queries.op4_source_mixing(spark, SF).collect()
    check_mix(rows, docs)
    again = mixing.mix(documents(spark).repartition(7, "lang")).collect()
    assert {(r.doc_id, r.taken) for r in rows} == {(r.doc_id, r.taken) for r in again}


def test_mixing_edges(spark):
    r = random.Random(1)
    docs = [(i, "w " * r.randint(0, 40), r.choice(["a", "b", "ü", "Z", None, ""])) for i in range(300)] + [(300, None, "none"), (301, "", "none"), (302, "x " * 5000, "b")]
    check_mix(mixing.mix(frame(spark, docs)).collect(), docs)
    assert mixing.mix(frame(spark, docs).limit(0)).count() == 0


def test_mixing_of_repeated_rows(spark):
    """Rows that share id, source and size are told apart where the budget ends among them."""
    same = frame(spark, [(1, "a b c", "s")]).crossJoin(spark.range(200).select()).unionByName(frame(spark, [(2, "a " * 600, "t")]))
    rows = mixing.mix(same).collect()
    taken = sum(x.taken for x in rows if x.doc_id == 1)
    assert len(rows) == 201 and abs(taken - next(x.target for x in rows if x.doc_id == 1)) <= 1.5
    out = mixing.mixed_documents(same)
    assert out.columns == same.columns and out.where("doc_id = 1").count() * 3 == taken


def test_mixed_documents_take_what_the_mix_says(spark):
    docs = documents(spark)
    copies = {r.doc_id: r.copies for r in mixing.mix(docs).collect() if r.copies}
    assert Counter(r.doc_id for r in mixing.mixed_documents(docs).collect()) == copies


def test_mix_of_many_sources(spark, monkeypatch):
    """More sources than are broadcast: the largest are, the rest shuffle, with the same result."""
    r = random.Random(12)
    docs = [(i, "w " * r.randint(0, 30), "hot" if i % 3 else r.choice(["a", "b", "c", "d", "e", None])) for i in range(400)]
    want = sorted(map(repr, mixing.mix(frame(spark, docs)).collect()))
    monkeypatch.setattr(mixing, "MAX_BROADCAST_SOURCES", 2)
    rows = mixing.mix(frame(spark, docs)).collect()
    assert sorted(map(repr, rows)) == want
    check_mix(rows, docs)


def test_exact_dedup_query(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    rel = con.sql(exact_dedup.oracle())
    assert {tuple(r[c] for c in rel.columns) for r in queries.op7_exact_dedup(spark, SF).collect()} == set(rel.fetchall())


def repeated(spark):
    r = random.Random(2)
    rows = [(i, r.choice(["A b", "a B", "é", "É", None, "", f"own {i}"]), "s") for i in range(400)]
    return rows + [(500, "hot text", "s")] * 3 + [(600 + i, "HOT text", "s") for i in range(200)] + [(500, "own 500", "s"), (9, "z" * 50_000, "s")]


@pytest.mark.parametrize("bits", [1 << 10, 1 << 26])
def test_exact_dedup_of_hot_and_repeated_rows(spark, bits):
    """Groups above and below HOT; a filter so small that nearly all rows seem repeated gives the same."""
    rows = repeated(spark)
    groups = defaultdict(list)
    for d, t, _ in rows:
        groups[(t or "").translate(AZ)].append(d)
    found = exact_dedup.exact_dedup(frame(spark, rows), max_bits=bits).collect()
    assert len(found) == len(rows) and sum(r.kept for r in found) == len(groups)
    by_sha = defaultdict(list)
    for r in found:
        by_sha[r.text_sha256].append(r)
    assert sorted(sorted(r.doc_id for r in g) for g in by_sha.values()) == sorted(map(sorted, groups.values()))
    for g in by_sha.values():
        assert {(r.keep_id, r.group_size) for r in g} == {(max(r.doc_id for r in g), len(g))}
        assert [r.doc_id for r in g if r.kept] == [g[0].keep_id]
    kept = exact_dedup.drop_copies(frame(spark, rows), max_bits=bits)
    assert kept.columns == frame(spark, []).columns
    assert sorted((r.doc_id, (r.text or "").translate(AZ)) for r in kept.collect()) == sorted((max(v), k) for k, v in groups.items())
    assert exact_dedup.exact_dedup(frame(spark, [])).count() == exact_dedup.drop_copies(frame(spark, [])).count() == 0


def test_exact_dedup_of_many_slices(spark):
    """16 slices, of which several are worked on at once, give what one filter gives."""
    rows = [(k, f"text {k % 700}" if k % 4 else "hot", "s") for k in range(1024)]
    docs = frame(spark, rows)
    slim = exact_dedup.digests(docs, "doc_id", "text", [F.monotonically_increasing_id().alias("rid")])
    assert sum(1 for _ in exact_dedup.slices(slim, 1 << 10)) == 16
    form = lambda df: sorted(tuple(r) for r in df.collect())
    assert form(exact_dedup.exact_dedup(docs, max_bits=1 << 10)) == form(exact_dedup.exact_dedup(docs))


def test_small_filters_flag_few_rows(spark):
    """Slices keep 16 bits a row in each filter, so distinct rows mostly pass, however small a filter may be."""
    slim = exact_dedup.digests(frame(spark, [(i, f"own {i}", "s") for i in range(4000)]), "doc_id", "text", [])
    flagged = n_slices = 0
    for part, n in exact_dedup.slices(slim, 1 << 12):
        words, bits = exact_dedup.repeats(part, n, 1 << 12)
        assert bits <= 1 << 12 and words.count() <= bits // 64
        flagged += exact_dedup.probed(part, words, bits).where("maybe").count()
        n_slices += 1
    assert n_slices == 16 and flagged < 0.05 * 4000


def exchanges(df):
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in line and "BroadcastExchange" not in line]


def test_documents_stay_where_they_are(spark):
    """No text is in a shuffle of what the dropping stages return."""
    docs = documents(spark)
    for dropped in (exact_dedup.drop_copies(docs), simhash.drop_near_copies(docs), mixing.mixed_documents(docs)):
        assert not exchanges(dropped)


def test_ties_and_clashing_columns(spark):
    """Of rows alike in id and normalised text the same one stays whatever the order; extra columns may have any name."""
    rows = [(1, "A", {"k": 1}, 1, 2), (1, "a", {"k": 2}, 1, 2), (1, "a", None, 1, 2), (1, "a", None, 1, 2), (2, None, {}, None, None), (None, "", {}, 0, 0)]
    schema = "doc_id long, text string, `_gone` map<string,int>, row_file long, `bits` int"
    first, *others = (exact_dedup.drop_copies(spark.createDataFrame(r, schema).repartition(n)) for r, n in ((rows, 1), (rows[::-1], 2), (rows, 3)))
    want = sorted(map(repr, first.collect()))
    assert first.columns == ["doc_id", "text", "_gone", "row_file", "bits"] and len(want) == 2
    assert all(sorted(map(repr, o.collect())) == want for o in others)
    near = simhash.drop_near_copies(spark.createDataFrame(rows, schema))
    assert near.columns == first.columns and sorted(near.collect(), key=repr)[0].doc_id in (1, 2) and near.count() == 2


def test_rows_without_in_groups(spark, monkeypatch):
    """More dropped rows than one broadcast holds: files go in groups."""
    docs = documents(spark).repartition(5)
    placed = rows_of.Rows(docs)
    assert placed.docs is not docs and rows_of.Rows(placed.docs).docs is placed.docs
    gone = placed.docs.select("doc_id", *placed.place()).where("doc_id % 3 = 0")
    want = {r.doc_id for r in documents(spark).where("doc_id % 3 <> 0").collect()}
    for most in (1 << 20, 2):
        monkeypatch.setattr(rows_of, "MAX_WORDS", most)
        left = placed.without(gone.select("row_file", "row_at"))
        assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == want and left.count() == len(want)


def test_mix_of_a_shuffled_table(spark):
    """Both readings see the same rows, also where the table comes from a shuffle."""
    docs = frame(spark, [(1, "a b c", "s")] * 60 + [(2, "a b", "t")] * 50).repartition(7)
    taken = mixing.mixed_documents(docs)
    assert {r["source"]: r["count"] for r in taken.groupBy("source").count().collect()} == {r["source"]: r["count"] for r in taken.groupBy("source").count().collect()}
    words = Counter()
    for r in taken.collect():
        words[r.source] += len(r.text.split())
    want = waterfill({"s": 180, "t": 100})
    assert abs(words["s"] - want["s"]) <= 3 and abs(words["t"] - want["t"]) <= 2


def brute_fingerprint(text):
    words = WORDS.findall((text or "").translate(AZ))
    runs = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    least = defaultdict(lambda: 1 << 62)
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least[find(i)], d)
    return sorted((d, f"{fps[i]:016x}", least[find(i)]) for i, (d, _) in enumerate(rows))


def test_simhash_query(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark).collect()]
    assert sorted(tuple(r) for r in queries.op8_simhash_near_dedup(spark, SF).collect()) == brute_components(rows)


def test_simhash_edges(spark):
    base = " ".join(f"w{k}" for k in range(400))
    texts = [None, "", " \n", "a", "A", "a b", "a b c", base, base + " x", base + " x y", base.replace("w7 ", "v7 "), "ß É", "y " * 70_000]
    rows = list(enumerate(texts)) + [(3, "a")]
    found = simhash.near_dedup(frame(spark, [(d, t, "s") for d, t in rows]))
    assert sorted(tuple(r) for r in found.collect()) == brute_components(rows)
    assert simhash.near_dedup(frame(spark, [])).count() == 0


def test_near_copies_without_ids_and_with_repeated_ids(spark):
    """One row of each component stays, also where ids are null or stand on several texts."""
    base, clean = " ".join(f"w{k}" for k in range(400)), " ".join(f"v{k}" for k in range(300))
    rows = [(None, base), (None, base + " x"), (7, base + " x y"), (7, clean), (7, clean), (8, clean), (9, "one more text"), (None, "a text of none"), (None, "a text of none"), (3, None), (3, "")]
    found = simhash.drop_near_copies(frame(spark, [(d, t, "s") for d, t in rows]))
    assert found.columns == frame(spark, []).columns
    left = [(r.doc_id, r.text or "") for r in found.collect()]
    assert sorted(left, key=repr) == sorted([(7, base + " x y"), (7, clean), (9, "one more text"), (None, "a text of none"), (3, "")], key=repr)
    assert simhash.drop_near_copies(frame(spark, [])).count() == 0


def test_tables_that_grow_are_not_broadcast(spark):
    """A small file of fingerprints is 34 times as many probes; Spark's estimate of these is the file's size."""
    r = random.Random(5)
    rows = spark.createDataFrame([(r.getrandbits(63), k, 1) for k in range(2_000)], "fp long, first long, n long")
    table = written(rows, "distinct")
    plan_of = lambda df: df._jdf.queryExecution().executedPlan().toString()
    plan = plan_of(simhash.candidates(table))
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan, plan
    plan = plan_of(rows_of.of_hot_keys(table.select("fp"), table, "fp", 1 << 30))
    assert plan.count("SortMergeJoin") == 1, plan  # the keys that aren't hot
    crowded = spark.createDataFrame([((k << 32) | 9,) for k in range(200)], "fp long")
    plan = plan_of(simhash.candidates(crowded))
    assert plan.count("SortMergeJoin") == 2, plan


def test_links_and_components_of_chains(spark):
    """Links at every distance up to 3 are found, and a long chain is one component."""
    r = random.Random(3)
    fps = [r.getrandbits(64)]
    for k in range(120):
        flips = r.sample(range(64), 3)
        fps.append(fps[-1] ^ sum(1 << b for b in flips))
    fps += [r.getrandbits(64) for _ in range(200)]
    fps += [f ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)) for f in fps[-100:]]
    signed = sorted({f - (1 << 64) if f >> 63 else f for f in fps})
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = {(x.a, x.b) for x in simhash.links(df).collect()}
    want = {(a, b) for i, a in enumerate(signed) for b in signed[i + 1 :] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    assert got == want
    from cuefold.llm.storage import written

    roots = {x.node: x.root for x in simhash.components(written(simhash.links(df), "t")).collect()}
    graph = defaultdict(set)
    for a, b in want:
        graph[a].add(b)
        graph[b].add(a)
    assert set(roots) == set(graph)
    seen = {}
    for start in graph:
        todo = [start] if start not in seen else []
        while todo:
            x = todo.pop()
            if x not in seen:
                seen[x] = start
                todo += graph[x]
    pairs = {(seen[n], roots[n]) for n in graph}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


@pytest.mark.parametrize("full", [64, 3])
def test_fingerprints_that_share_a_segment(spark, full):
    """A crowded key is split: few candidates meet, and no link is lost."""
    r = random.Random(9)
    shared = r.getrandbits(32)
    fps = {shared << 32 | r.getrandbits(32) for _ in range(2600)}
    fps |= {f ^ 1 << r.randrange(64) ^ 1 << r.randrange(64) ^ 1 << r.randrange(64) for f in r.sample(sorted(fps), 400)}
    signed = np.array(sorted(f - (1 << 64) if f >> 63 else f for f in fps))
    df = spark.createDataFrame([(int(f),) for f in signed], "fp long")
    met = simhash.candidates(df, full).groupBy("a").count()
    assert met.agg(F.sum("count")).first()[0] < 100 * len(signed)
    far = np.bitwise_count((signed[:, None] ^ signed[None, :]).view(np.uint64))
    want = {(int(signed[i]), int(signed[j])) for i, j in zip(*np.nonzero(far <= 3), strict=True) if i < j}
    assert {(x.a, x.b) for x in simhash.links(df, full=full).collect()} == want and len(want) >= 300


def brute_top(rows, k=20, every=20):
    out = []
    rows = [(i, [int(np.floor(64 * np.float64(np.float32(x)))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    for q, a in rows:
        if q % every == 0:
            scored = sorted((-max(-(1 << 63), min((1 << 63) - 1, sum(x * y for x, y in zip(a, b)))), i) for i, b in rows if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


def test_top_k_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert sorted(tuple(r) for r in queries.op9_exact_top_k(spark, SF).collect()) == brute_top(rows)


def test_top_k_edges(spark):
    r = random.Random(4)
    rows = [(i, [r.choice([-1.0, -0.5, 0.0, 0.25, 1.0]) for _ in range(8)]) for i in range(200)]
    rows += [(200 + i, rows[0][1]) for i in range(60)] + [(300, None), (320, [None] * 8), (340, [float("nan")] * 8), (360, [float("inf")] * 8), (380, [1.0] * 3), (400, []), (None, [1.0] * 8), (401, [2.0] * 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS block", "2 AS score")
    want = brute_top(rows)
    assert sorted(tuple(x) for x in topk.top_k(df).collect()) == want
    small = topk.top_k(df, query_block=3, candidate_block=16, sample=30)
    assert sorted(tuple(x) for x in small.collect()) == want
    assert topk.top_k(df.limit(0)).count() == 0
    large = [(0, [1e12, 1.0]), (1, [1e9, -3.0]), (2, [3.0, 2.0])]
    got = topk.top_k(spark.createDataFrame(large, "vec_id long, embedding array<float>")).collect()
    assert sorted(tuple(x) for x in got) == brute_top(large)


def test_top_k_bounds_hold():
    """No bound of any resolution lies below a score."""
    rng = np.random.default_rng(5)
    q, c = np.floor(64 * rng.normal(size=(30, 64))), np.floor(64 * rng.normal(size=(500, 64)) + 20)
    exact = q @ c.T
    coarse = None
    for a, b in zip(topk.Resolutions(q).levels, topk.Resolutions(c).levels, strict=True):
        bound = a @ b.T
        assert (bound >= exact - 1e-6).all()
        assert coarse is None or (bound <= coarse + 1e-6).mean() > 0.99
        coarse = bound


def like_vectors(n=6000):
    """Vectors of 60 kinds that differ by segment, with little noise."""
    rng = np.random.default_rng(8)
    kinds = np.repeat(rng.normal(size=(60, 8)), 8, axis=1)
    return np.floor(64 * (kinds[rng.integers(0, 60, n)] + 0.05 * rng.normal(size=(n, 64))))


def test_most_like_vectors_fall_before_exact_scores():
    c = like_vectors()
    q, ids = c[::20], np.arange(len(c))
    exact = np.sort(q @ c.T, axis=1)[:, -20].astype(float)
    best, counts = topk.Best(q, ids[::20], exact, 20), []
    topk.survivors(best.of, np.arange(len(q)), topk.Block(c, ids, 64), exact, counts)
    pairs = len(q) * len(c)
    assert counts == sorted(counts, reverse=True) and counts[-1] < 0.05 * pairs  # before any exact score
    points = topk.centres(c[:1000], 30)
    cells = topk._nearest(c, points)
    skipped = [topk.block_bounds(best.of, *(b := topk.Block(c[cells == k], ids[cells == k], 64)).extremes(), b.reach) < exact for k in np.unique(cells)]
    assert np.mean(skipped) > 0.7  # blocks that a query need not enter


def test_top_k_of_like_vectors_in_many_blocks(spark):
    c = like_vectors(2000) / 64
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(c)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk.top_k(df, query_block=16, candidate_block=64, sample=200, stripe_rows=256).collect()
    whole = (c * 64).astype(np.int64)
    for i in range(0, len(rows), 20):
        score = whole @ whole[i]
        order = sorted((-int(s), j) for j, s in enumerate(score) if j != i)[:20]
        assert sorted((r.rank, r.vec_id, r.score) for r in found if r.query_id == i) == [(n + 1, j, -s) for n, (s, j) in enumerate(order)]


def test_grammar_scores_clauses_not_words():
    model = toxicity.Model()
    total = lambda text: model.features(text)[0]
    insult = total("a stupid thing")
    assert insult > 0 and total("a thing") == 0
    assert total("you are stupid") > insult
    assert 0 < total("it is not stupid") < insult
    assert 0 < total('she said "stupid" twice') < insult
    assert total("he told us that it was stupid") < total("he told us. it was stupid")
    assert total("knives kill time") < total("i will kill you")
    assert total("stupid\nstupid") == 2 * insult and total("so,stupid") == insult
    assert model.features(None) == model.features("") == (0.0, 0.0, 0.0)


def brute_features(model, text):
    """Sum, largest clause and sum by length, from the written rules alone: no transducers, no shortcuts."""
    clauses = [re.findall("[^\\W\\d_]+(?:['’][^\\W\\d_]+)*|[\"“”«»]", c) for c in re.split("[.!?;|\n]+", (text or "").lower())]
    scores = []
    for words in clauses:
        aimed = any(w in toxicity.TARGETS and not (i + 1 < len(words) and words[i + 1] in toxicity.REPORTS) for i, w in enumerate(words))
        score = 0.0
        for i, w in enumerate(words):
            if w in toxicity.TARGETS or w in toxicity.NEGATIONS or w in toxicity.REPORTS or w in '"“”«»':
                continue
            weight = toxicity.THREAT_WEIGHT if w in toxicity.THREATS else max([model.words.get(w, 0), 2.0 * (w in toxicity.INSULTS), *(v for p, v in model.prefixes.items() if w.startswith(p))])
            negated = any(x in toxicity.NEGATIONS for x in words[max(0, i - 3) : i])
            reported = any(x in toxicity.REPORTS for x in words[:i]) or sum(x in '"“”«»' for x in words[:i]) % 2
            score += weight * (1 if aimed else 0.1) * (0.3 if negated else 1) * (0.5 if reported else 1)
        scores.append(score)
    return sum(scores), max(scores), 100 * sum(scores) / max(100, len((text or "").split()))


def test_grammar_equals_brute_force():
    model = toxicity.Model({"zog": 3.0, "you": 9.0, "not": 9.0, "kill": 9.0}, {"blar": 1.5})
    vocabulary = ["zog", "blarney", "idiot", "kill", "hurt", "you", "he", "not", "never", "said", "told", '"', "so", "thing", "a-zog", "don't", ".", ";", "\n", "!"]
    r = random.Random(6)
    for _ in range(2000):
        text = " ".join(r.choices(vocabulary, k=r.randint(0, 25)))
        assert model.features(text) == pytest.approx(brute_features(model, text)), text


def test_negation_reports_and_targets_decide():
    model = toxicity.Model()
    total = lambda text: model.features(text)[0]
    for plain, negated, quoted, reported in (
        ("i will kill you", "i will not kill you", 'he wrote "i will kill you"', "he said i will kill you"),
        ("you are an idiot", "you are not an idiot", '"you are an idiot"', "they say you are an idiot"),
    ):
        assert total(plain) > 0
        for weaker in (negated, quoted, reported):
            assert 0 < total(weaker) <= 0.6 * total(plain)
    assert total("the idiot ran") < 0.5 * total("you idiot ran") and total("kill") < 0.5 * total("kill you")
    flags = [model.score([model.features(t)])[0] >= toxicity.THRESHOLD for t in ("you idiot", "the idiot ran", "you are not an idiot")]
    assert flags == [True, False, False]
    learnt = toxicity.Model({"you": 5.0, "not": 5.0, "said": 5.0, "kill": 5.0})
    assert learnt.features("you said not") == (0.0, 0.0, 0.0) and learnt.features("kill you") == model.features("kill you")


def test_training_rows_are_bounded(spark):
    """Many rows of one id, alike or not, don't exceed the bound."""
    rows = [(1, f"text {i % 50}", "s") for i in range(3000)] + [(i, "same", "s") for i in range(3, 60)]
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(60)], "doc_id long, quality int, toxic int")
    for most in (10, 1000):
        found = toxicity.training_rows(frame(spark, rows), labels, "doc_id", "text", most).collect()
        assert 0 < len(found) <= most
        assert sorted(found) == sorted(toxicity.training_rows(frame(spark, rows[::-1]), labels, "doc_id", "text", most).collect())
    assert len([r for r in found if r.text.startswith("text")]) == 50  # repeats of an id and a text are one


def labelled(spark, n=1200):
    """Clean and toxic texts of invented words; toxic ones hold words that begin alike."""
    r = random.Random(7)
    docs, labels = [], []
    for i in range(n):
        bad = r.random() < 0.15
        words = ["".join(r.choice(["ka", "lo", "mi", "re", "tu"]) for _ in range(r.randint(1, 3))) for _ in range(80)]
        if bad:
            for _ in range(3):
                words[r.randrange(80)] = "zogu" + r.choice(["ka", "lo", "mi"])
        docs.append((i, " ".join(words) + ".", "s"))
        labels.append((i, 0, int(bad)))
    return frame(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), labels


def test_toxicity_learns_from_training_rows_only(spark):
    docs, labels, rows = labelled(spark)
    model = toxicity.fit(docs, labels)
    truth = {d: t for d, _, t in rows}
    scored = toxicity.score(docs, model).collect()
    assert len(scored) == len(rows)
    for r in scored:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert r.predicted == int(r.score >= 0.3) == truth[r.doc_id] and 0 <= r.score <= 1
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit(docs, flipped).curve == pytest.approx(model.curve)
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {d for d, t in truth.items() if not t}


def test_toxicity_edges(spark):
    docs = frame(spark, [(1, None, "s"), (2, "", "s"), (None, "you idiot", "s"), (4, "you idiot", "s"), (4, "you idiot", "s"), (5, "fine " * 50_000, None)])
    none = spark.createDataFrame([(7, 0, 1), (1, 0, None), (2, 0, 5)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, none)
    assert model == toxicity.Model()
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == 6 and sorted(r.predicted for r in rows) == [0, 0, 0, 1, 1, 1]
    assert toxicity.score(docs.limit(0), model).count() == toxicity.drop_toxic(docs.limit(0), model).count() == 0


def test_toxicity_query(spark):
    """Every row's score is the curve over features by brute force."""
    docs = documents(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = {r.doc_id: r for r in queries.op10_toxicity(spark, SF).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert rows.keys() == texts.keys() and set(rows[1].asDict()) == {"doc_id", "held_out", "score", "predicted"}
    for d, text in texts.items():
        want = 1 / (1 + np.exp(-(model.curve[0] + np.dot(np.log1p(brute_features(model, text)), model.curve[1:]))))
        assert rows[d].score == pytest.approx(want, abs=1e-9) and rows[d].predicted == int(rows[d].score >= 0.3)
        assert rows[d].held_out == (zlib.crc32(str(d).encode()) % 4 == 2)


def test_pipeline_stages(spark):
    """Each stage's decisions take effect on all that the one before kept."""
    docs = documents(spark)
    columns = docs.columns
    toxic = {r.doc_id for r in queries.op10_toxicity(spark, SF).where("predicted = 1").collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "simhash_near_dedup", "source_mixing", "best_fit_packing"]
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["toxicity"](spark, docs, SF).cache()
    assert clean.columns == columns and {r.doc_id for r in clean.collect()} == {r.doc_id for r in docs.collect()} - toxic
    single = stages["exact_dedup"](spark, clean, SF).cache()
    keep = {r.doc_id for r in exact_dedup.exact_dedup(clean).where("kept").collect()}
    assert single.columns == columns and {r.doc_id for r in single.collect()} == keep and single.count() == len(keep)
    first = stages["simhash_near_dedup"](spark, single, SF).cache()
    rows = brute_components([(r.doc_id, r.text) for r in single.collect()])
    assert first.columns == columns and {r.doc_id for r in first.collect()} == {c for _, _, c in rows}
    mixed = stages["source_mixing"](spark, first, SF).cache()
    copies = {r.doc_id: r.copies for r in mixing.mix(first).collect() if r.copies}
    assert mixed.columns == columns and Counter(r.doc_id for r in mixed.collect()) == copies
    packed = stages["best_fit_packing"](spark, mixed, SF)
    assert Counter(r.doc_id for r in packed.where("piece = 0").collect()) == copies
    assert corpus_pipeline.run(spark, SF).count() == packed.count()


def test_stages_of_odd_tables(spark):
    """Five stages in a row over an empty table, and over nulls, repeats and extra columns of clashing names."""
    text = " ".join(f"w{k}" for k in range(300))
    odd = [(None, None, None), (None, "", "s"), (5, text, None), (5, text, None), (6, text + " x", "t"), (7, "you idiot, you stupid scum and trash. you worthless moron", "t"), (8, "z " * 20_000, "s")]
    for rows in ([], odd):
        docs = frame(spark, rows).withColumnsRenamed({"place": "copies"}).withColumn("length", F.lit(1))
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = written(stage(spark, docs, SF), name)
            assert docs.columns == columns, name
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
        left = docs.select("doc_id").collect()
        assert packed.count() >= len(left) and (len(left) > 0) == bool(rows)

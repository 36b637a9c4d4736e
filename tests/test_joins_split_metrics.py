import pytest
from pyspark.sql import functions as F

from cuefold.functions import arrays
from cuefold.operators import metrics as M
from cuefold.operators import pairing as P
from cuefold.operators import split as H


def test_merge_prefers_live_then_first(spark):
    path = "x\\audio\\EP1_abc\\EP1_abc_%03d.wav"
    rows = [("a", 0, path % 1, False), ("b", 0, path % 1, True), ("a", 1, path % 2, True), ("b", 1, path % 2, True), ("a", 2, path % 3, False), ("b", 2, path % 3, False), ("a", 3, path % 2, False)]
    rows += [("a", 4, "x\\notes\\n_001.wav", True)]
    lookup = P.merge_lookups(P.local_lookup(spark.createDataFrame(rows, "folder string, pos long, audio_path string, live boolean")))
    assert {r.chunk_index: r.folder for r in lookup.collect()} == {1: "b", 2: "b", 3: "a"}  # of folder a, key 2's last row is dead


def joined(spark):
    reviewed = spark.createDataFrame([("EP1", "abc", 1, 0), ("EP2", "q", 5, 1)], "episode string, yt_id string, chunk_index int, pos int")
    lookup = spark.createDataFrame([("EP1", "abc", 1, "here.wav")], "episode string, yt_id string, chunk_index int, audio_path string")
    return P.join_back(reviewed, lookup, F.lit("root"))


def test_join_back_and_gate(spark):
    rows = joined(spark)
    assert {r.pos: r.audio_path for r in rows.collect()} == {0: "here.wav", 1: "root\\audio\\EP2_q\\EP2_q_005.wav"}
    for flags in ({}, {"allow_reconstruct": True}):
        with pytest.raises(ValueError, match="without a local match"):
            P.gate(rows, **flags)
    assert P.gate(rows, True, True).count() == 2
    assert {(r.episode, r.matched, r.total, r.missing) for r in P.coverage(rows).collect()} == {("EP1", 1, 1, 0), ("EP2", 0, 1, 1), (None, 1, 2, 1)}


def test_term_matches_equal_brute_force(spark):
    docs = ["a bb ccc d", "xa bb ccc dx", "bb", "a  bb", "", None]
    terms = ["a bb ccc d", "bb", "bb ccc", "a  bb", " ccc ", ""]
    d = spark.createDataFrame(list(enumerate(docs)), "i int, t string")
    t = spark.createDataFrame(list(enumerate(terms)), "j int, u string")
    got = {(r.i, r.j) for r in P.term_matches(d, t, "i", "t", "j", "u").collect()}
    assert got == {(i, j) for i, x in enumerate(docs) for j, y in enumerate(terms) if x is not None and y in x}


def clips(spark, groups):
    rows, pos = [], 0
    for name, n, rich in groups:
        for k in range(n):
            rows.append((pos, name, k < rich))
            pos += 1
    return spark.createDataFrame(rows, "pos long, episode string, rich boolean")


def held(spark, groups, share):
    return {r.episode for r in H.held_groups(clips(spark, groups), "episode", F.col("rich"), share).collect()}


def test_holdout(spark):
    assert held(spark, [("D", 2, 0), ("A", 5, 5), ("B", 4, 3), ("C", 3, 2)], 0.4) == {"A", "B"}
    assert held(spark, [("A", 5, 5)], 0.4) == set()
    assert held(spark, [("A", 1, 1), ("B", 1, 1), ("C", 23, 0)], 0.1) == {"A", "B"}  # 2.5 rounds to 2
    assert held(spark, [("A", 2, 0), ("B", 2, 0), ("C", 2, 0)], 0.3) == {"A"}  # ties keep the first


def test_forced_and_leaks(spark):
    rows = clips(spark, [("EP1_a", 2, 0), ("EP2_b", 2, 0)])
    assert {r.episode for r in H.forced_groups(rows, "episode", ["EP2"], short_labels=True).collect()} == {"EP2_b"}
    with pytest.raises(ValueError, match="EP2"):
        H.forced_groups(rows, "episode", ["EP2"])
    split = H.split_rows(rows, H.forced_groups(rows, "episode", ["EP2_b"]), "episode")
    assert H.leaks(split, "episode").count() == 0
    assert H.leaks(split.withColumn("split", F.when(F.col("pos") == 0, "eval").otherwise("train")), "episode").count() == 1
    assert H.split_report(split).first().eval_share == 0.5


def test_word_error_rate(spark):
    rows = spark.createDataFrame([("the cat sat on mat", "the cat sit on the mat"), ("all is well", "all is well")], "reference string, prediction string")
    assert [r.edits for r in M.edits(rows).collect()] == [2, 0]
    assert M.wer(M.edits(rows), []).first().wer == 25.0


def test_word_edits_by_brute_force(spark):
    import random

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
        return row[-1]

    r = random.Random(4)
    pairs = [(" ".join(r.choices("a b c dd é ے".split(), k=r.randint(0, 9))), " ".join(r.choices("a b c dd é ے".split(), k=r.randint(0, 9)))) for _ in range(100)]
    many = " ".join(f"w{k}" for k in range(300))
    pairs.append((many, many + " x"))
    df = spark.createDataFrame(pairs, "reference string, prediction string")
    got = [x.e for x in df.select(arrays.word_edits(F.col("reference"), F.col("prediction")).alias("e")).collect()]
    assert got == [distance(a.split(), b.split()) for a, b in pairs]


def test_alignment_and_delta(spark):
    rows = spark.createDataFrame([(0, "a"), (1, "b")], "pos int, sentence string")
    assert M.aligned(rows, rows).first().aligned
    assert not M.aligned(rows, rows.where("pos = 0")).first().aligned
    a = spark.createDataFrame([("x", 20.0), ("y", 5.0)], "bucket string, wer double")
    b = spark.createDataFrame([("x", 15.0)], "bucket string, wer double")
    assert {(r.bucket, r.delta) for r in M.wer_delta(a, b, ["bucket"]).collect()} == {("x", 5.0), ("y", None)}


def test_padding(spark):
    rows = spark.createDataFrame([(0, [7, 1]), (0, [7, 1, 2]), (1, [7]), (1, [8, 9])], "b int, labels array<int>")
    got = {(r.b, tuple(r.labels)) for r in arrays.pad_and_mask(rows, "b", "labels", 7).collect()}
    assert got == {(0, (1, -100)), (0, (1, 2)), (1, (7, -100)), (1, (8, 9))}
    assert spark.range(1).select(arrays.unmask(F.array(F.lit(1), F.lit(-100)), 0).alias("x")).first().x == [1, 0]


def test_numbered_rows_follow_the_order(spark):
    from cuefold.operators.numbering import numbered

    rows = spark.range(1000).withColumn("k", (F.col("id") * 7919) % 1000).repartition(5)
    got = numbered(rows, [F.col("k")], "n").collect()
    assert len(got) == 1000 and all(r.n == r.k + 1 for r in got)
    assert numbered(rows.limit(0), [F.col("k")], "n").count() == 0


def test_rates_of_all_turns_by_brute_force(spark, tmp_path):
    """Texts of far more than 93 distinct words count."""
    import random

    from cuefold.plans.catalogue import QUERIES

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
        return row[-1]

    r = random.Random(7)
    texts = [" ".join(r.choices([f"w{k}" for k in range(900)] + ["of", "la", "the", "é"] * 40, k=n)) for n in (5, 80, 300, 700)]
    spark.createDataFrame([(i, 0, t) for i, t in enumerate(texts)], "conv_id long, turn int, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    assert max(len(set(t.split())) for t in texts) > 300
    models = {"base": lambda t: t.replace(" la ", " ").replace(" the ", " a "), "finetuned": lambda t: t.replace(" of ", " off of ")}

    def rate(model, rows):
        return round(100 * sum(distance(t.split(), models[model](t).split()) for t in rows) / sum(len(t.split()) for t in rows), 6)

    got = {r.model: (r.n, r.wer) for r in QUERIES["wer_overall"](spark, str(tmp_path)).collect()}
    assert got == {m: (4, pytest.approx(rate(m, texts))) for m in models}
    long = [t for t in texts if len(set(t.split())) > 40]
    got = {(r.model, r.bucket): (r.n, r.wer) for r in QUERIES["wer_by_bucket"](spark, str(tmp_path)).collect()}
    assert all(got[(m, "long")] == (len(long), pytest.approx(rate(m, long))) for m in models)
    delta = {r.bucket: r.delta for r in QUERIES["wer_delta"](spark, str(tmp_path)).collect()}
    assert delta["long"] == pytest.approx(rate("base", long) - rate("finetuned", long), abs=1e-5)


def test_term_matches_of_repeated_rows(spark, tmp_path):
    """Each row of both sides matches; nulls match nothing, an empty term everything; many automata give the same."""
    docs = [(1, "one two three four"), (1, "one two three four"), (2, "two"), (3, None), (4, "")]
    terms = [(7, "one two three"), (7, "one two three"), (8, "two"), (9, ""), (10, None), (11, "two three four")]
    d, t = spark.createDataFrame(docs, "d long, x string"), spark.createDataFrame(terms, "t int, y string")
    want = sorted((a, i) for a, x in docs for i, y in terms if x is not None and y is not None and y in x)
    for most in (1 << 20, 40):
        got = P.term_matches(d, t, "d", "x", "t", "y", most)
        assert sorted(tuple(r) for r in got.collect()) == want and got.columns == ["d", "t"]
    assert P.term_matches(d, t.limit(0), "d", "x", "t", "y").count() == P.term_matches(d.limit(0), t, "d", "x", "t", "y").count() == 0


def test_coverage_in_order_and_by_folder(spark):
    rows = spark.createDataFrame([("EP10", "a", 0, True), ("EP2", "b", 0, False), ("EP2", "b", 1, True), ("x", "c", 0, True)], "episode string, yt_id string, chunk_index int, matched boolean")
    assert [(r.episode, r.matched, r.missing) for r in P.in_order(P.coverage(rows)).collect()] == [("x", 1, 0), ("EP2", 1, 1), ("EP10", 1, 0), (None, 3, 1)]
    assert tuple(P.coverage_summary(rows).first()) == (3, 3, 4, 1, "75.0%")
    assert tuple(P.coverage_summary(rows.limit(0)).first()) == (0, 0, 0, 0, "0.0%")
    lookup = spark.createDataFrame([("EP10", "a", 0, "z"), ("EP2", "b", 1, "b"), ("x", "c", 0, "b"), ("no", "c", 0, "a")], "episode string, yt_id string, chunk_index int, folder string")
    assert [tuple(r) for r in P.coverage_folders(rows, lookup).collect()] == [(1, "b", 2), (2, "z", 1)]


def test_edit_distance_by_brute_force():
    import random

    r = random.Random(11)

    def brute(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            old, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                old, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, old + (x != y))
        return row[-1]

    for n in [0, 1, 5, 30, 130] * 30:
        a = r.choices("abcde", k=r.randint(0, n))
        b = r.choices("abcdefg", k=r.randint(0, n)) if r.random() < 0.5 else [r.choice("xyz") if r.random() < 0.1 else x for x in a if r.random() < 0.9]
        assert arrays.edit_distance(a, b) == arrays.edit_distance(b, a) == brute(a, b)


def test_term_matches_of_one_term_many_times(spark, monkeypatch):
    """20,000 rows of one term are one term of an automaton; automata hold about `most` characters, and none is empty."""
    docs = spark.createDataFrame([(1, "xx hot yy"), (2, "cold w17"), (3, "w17 w18")], "d long, x string")
    terms = spark.range(20000).select("id", F.lit("hot").alias("y")).unionByName(spark.range(300).select((F.col("id") + 50000).alias("id"), F.concat(F.lit("w"), "id").alias("y")))
    held, automaton = [], P._found
    monkeypatch.setattr(P, "_found", lambda d, known, *rest: (held.append(sum(len(t) + 16 for _, t in known)), automaton(d, known, *rest))[1])
    got = P.term_matches(docs, terms, "d", "x", "id", "y", most=1000)
    assert got.where("d = 1").count() == 20000 and got.where("d = 1 AND id < 20000").distinct().count() == 20000
    assert sorted(r.id - 50000 for r in got.where("d > 1").collect()) == [1, 1, 17, 17, 18]
    assert len(held) == 6 and min(held) > 900 and max(held) < 1100

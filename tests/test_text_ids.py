from pyspark.sql import functions as F

import compare
from cuefold.functions import ids
from cuefold.functions import text as T
from cuefold.plans.catalogue import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x"))).first()[0]


def normalised(spark, text):
    return T.normalise(spark.createDataFrame([(text,)], "transcript string")).first()


def test_rules(spark):
    assert normalised(spark, "کہا ۔")["transcript"] == "کہا۔"
    assert normalised(spark, "کہا،اور")["transcript"] == "کہا، اور"
    assert normalised(spark, "،،x")["transcript"] == "، ،x"
    kept = normalised(spark, "a  b")
    assert kept["transcript"] == "a  b" and not kept["changed"]
    assert normalised(spark, "نبیﷺ نے")["transcript"] == f"نبی {T.SALAWAT} نے"
    assert normalised(spark, "a‌b، c")["transcript"] == "ab، c"  # a no-break space is white space
    assert normalised(spark, None)["transcript"] is None


def test_rule_totals_and_log(spark):
    df = spark.createDataFrame([(0, "a ۔ b ۔"), (1, "x"), (2, "a،b ۔")], "pos long, transcript string")
    totals = {r.label: (r.n, r.rows) for r in T.rule_totals(T.normalise(df)).collect()}
    assert totals == {"space before full stop": (3, 2), "no space after comma": (1, 1)}
    assert {r.pos: list(r.rules) for r in T.changed_log(df).collect()} == {0: ["space before full stop x2"], 2: ["space before full stop x1", "no space after comma x1"]}


def test_rules_are_computed_once_when_rows_are_filtered(spark):
    df = spark.range(2).select(F.col("id").alias("pos"), F.concat(F.lit("a ۔ b"), F.col("id")).alias("transcript"))
    for rows in (T.changed_log(df), T.normalise(df).where("hits[5] > 1")):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("regexp_replace") == 3 and not any("regexp" in x for x in plan.splitlines() if "Filter" in x), plan


def test_valid_transcript(spark):
    for text, ok in ((None, False), (" ", False), (" a ", False), ("ab", True), ("a" * 500, True), ("a" * 501, False), (" a ", False)):
        assert one(spark, text, T.valid_transcript) is ok


def test_endings_and_wer_text(spark):
    assert one(spark, "جی ہاں۔ ", T.ending) == "sentence"
    assert one(spark, "اور،", T.ending) == "clause"
    assert one(spark, "اور", T.ending) == "hard"
    assert one(spark, "a,b — “c”", T.wer_text) == "a b c"


def test_replacements(spark):
    assert one(spark, "abaa", lambda c: T.replace_chain(c, [("ab", "X"), ("a", "Y")])) == "XYY"
    assert one(spark, "Mezan BANK $1 (x)", lambda c: T.correct_ci(c, {"mezan bank": "Meezan Bank", "$1 (x)": "\\$"})) == "Meezan Bank \\$"


def test_buckets(spark):
    terms = ["ذکر"]
    assert one(spark, "ok ذکر", lambda c: T.buckets(c, terms)) == ["code_switch", "spiritual_term"]
    assert one(spark, "a ب", lambda c: T.buckets(c, terms)) == ["nastaliq_only"]
    assert one(spark, "ذکر", lambda c: T.buckets(c, [])) == ["nastaliq_only"]


def test_prompt(spark):
    empty = F.array().cast("array<string>")
    got = one(spark, ["a", "b", "c"], lambda c: T.prompt([(c, "، ", "۔"), (empty, "، ", "۔"), (c, ", ", ".")], "س۔", 2), "array<string>")
    assert got == "س۔ a، b۔ a, b."


def test_youtube_ids(spark):
    cases = {"EP1_hBK8bkFgus8.mp3": "hBK8bkFgus8", "in/EP18_o58PGx_xiIk": "o58PGx_xiIk", "x_a_b": None, "clip_009_128kbps": "009_128kbps", "a\\b\\_abcdefghij.wav": "_abcdefghij"}
    for path, want in cases.items():
        assert one(spark, path, ids.youtube_id) == want


def test_video_ids(spark):
    cases = [("EP1_hBK8bkFgus8.mp3", 3, "EP1_hBK8bkFgus8"), ("My_Long_Title_q1Q6B2JrY58_009.mp3", 7, "vid0007_q1Q6B2JrY58"), ("a.mp3", 2, "vid0002"), ("hBK8bkFgus8.mp3", 4, "vid0004_hBK8bkFgus8")]
    for path, index, want in cases:
        assert one(spark, path, lambda c, i=index: ids.video_id(c, F.lit(i))) == want


def test_video_ids_of_large_numbers(spark):
    assert one(spark, "a.mp3", lambda c: ids.video_id(c, F.lit(12345))) == "vid12345"
    assert one(spark, "a.mp3", lambda c: ids.video_id(c, F.lit(1 << 40))) == f"vid{1 << 40}"


def test_video_id_query_agrees_with_sql_on_large_numbers(spark, tmp_path):
    for t in compare.TABLES:
        if t != "pages":
            (tmp_path / f"{t}.parquet").symlink_to(f"{SF}/{t}.parquet")
    pages = [(k,) for at in (0, 9_990, 100_000, 1 << 40) for k in range(at, at + 20)] + [(-5,), (-12_345,), (None,)]
    spark.createDataFrame(pages, "page_id long").coalesce(1).write.parquet(str(tmp_path / "made"))
    next((tmp_path / "made").glob("part-*")).rename(tmp_path / "pages.parquet")
    ours, theirs = compare.both(spark, QUERIES["video_id"], ORACLES["video_id"], str(tmp_path))
    assert ours == theirs


def test_natural_order(spark):
    names = ["EP10_a", "EP2_b", "ep1_c", "1x", "a", "a1"]
    got = [r.x for r in spark.createDataFrame([(n,) for n in names], "x string").orderBy(ids.natural_key(F.col("x"))).collect()]
    assert got == ["1x", "a", "a1", "ep1_c", "EP2_b", "EP10_a"]


def test_natural_order_of_long_numbers(spark):
    same = "1" * 20
    names = ["a0.wav", "a007.wav", "a10.wav", f"a{same}.wav", f"a{same}5.wav", f"a{same}7.wav", f"a{'0' * 30}{same}8.wav", f"a{'9' * 25}.wav"]
    rows = spark.createDataFrame([(n,) for n in reversed(names)], "path string")
    assert [r.path for r in rows.orderBy(ids.natural_key(F.col("path"))).collect()] == names
    equal = spark.createDataFrame([("a7.wav",), ("a007.wav",)], "path string")
    assert equal.select(ids.natural_key(F.col("path")).alias("k")).distinct().count() == 1


def test_paths(spark):
    path = "data\\processed\\b\\audio\\EP7_x\\EP7_x_012.wav"
    assert one(spark, path, ids.parent) == "EP7_x"
    assert one(spark, path, ids.chunk_index) == 12
    assert one(spark, path, ids.suffix) == ".wav"
    assert one(spark, "EP7_abc", ids.episode_number) == 7 and one(spark, "x", ids.episode_number) == 0
    assert one(spark, "r", lambda c: ids.audio_path(c, F.lit("EP7"), F.lit("x"), F.lit(12))) == "r\\audio\\EP7_x\\EP7_x_012.wav"

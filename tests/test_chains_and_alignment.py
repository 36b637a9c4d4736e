"""Replacement chains and alignment against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from cuefold import __main__ as cli
from cuefold import batches
from cuefold.functions import replacements
from cuefold.operators import metrics as M
from cuefold.plans import pipelines
from cuefold.plans.catalogue import QUERIES
from cuefold.sources import sinks


def plain(text, pairs):
    for k, v in pairs:
        text = text.replace(k, v) if k else text
    return text


def test_chains_of_random_pairs():
    rng = random.Random(0)
    word = lambda lo, hi: "".join(rng.choice("abc") for _ in range(rng.randrange(lo, hi)))
    for _ in range(3000):
        pairs = [(word(0, 4), word(0, 4)) for _ in range(rng.randrange(12))]
        chain = replacements.Chain(pairs)
        for _ in range(4):
            text = word(0, 25)
            assert chain(text) == plain(text, pairs), (text, pairs)


@pytest.mark.parametrize("n", [0, 3, 60])
def test_chains_of_columns(spark, n):
    rng = random.Random(n)
    word = lambda: "".join(rng.choice("ab ۔é") for _ in range(rng.randrange(1, 3)))
    pairs = [(word(), rng.choice(["", word(), "$1\\"])) for _ in range(n)]
    texts = [None, "", *["".join(rng.choice("ab ۔é") for _ in range(30)) for _ in range(50)]]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(replacements.replace_chain(F.col("t"), pairs)).collect()]
    assert got == [None if t is None else plain(t, pairs) for t in texts]


def test_batches_of_chains_are_bounded_by_bytes(spark):
    """The query sets the bound, and it holds for column functions."""
    before = spark.conf.get(batches.LIMIT, None)
    try:
        spark.conf.unset(batches.LIMIT)
        QUERIES["lexicon_replace_chain"](spark, "/root/testdata/sf0.001")
        assert spark.conf.get(batches.LIMIT, None) is not None
        rows_of = F.pandas_udf(lambda texts: texts * 0 + len(texts), "long")
        long_ = spark.range(64, numPartitions=1).select("id", F.repeat(F.lit("x"), 1 << 20).alias("t"))
        most = long_.select(rows_of("id").alias("n"), F.pandas_udf(lambda t: t.str.len() * 0 + len(t), "long")("t").alias("m")).agg(F.max("n"), F.max("m")).first()
        assert max(most) <= 9
    finally:
        spark.conf.unset(batches.LIMIT) if before is None else spark.conf.set(batches.LIMIT, before)


def test_first_difference(spark):
    rng = random.Random(4)
    base = [(i, f"s{i % 50}") for i in range(700)]
    frame = lambda rows: spark.createDataFrame(rows, "pos long, sentence string")
    assert M.first_difference(frame(base), frame(rng.sample(base, 700)), ranges=8) is None
    assert M.first_difference(frame([]), frame([])) is None
    for k in (0, 1, 350, 699):
        other = [(i, s if i < k or i % 3 else s + "x") if i != k else (i, None) for i, s in base]
        assert M.first_difference(frame(base), frame(other), ranges=8) == k
        assert M.first_difference(frame(base), frame(base[:k] + base[k + 1 :]), ranges=8) == k
        assert M.first_difference(frame(base + [base[k]]), frame(base), ranges=8) == k
    swapped = [*base[:10], (10, base[11][1]), (11, base[10][1]), *base[12:]]
    assert M.first_difference(frame(base), frame(swapped), ranges=8) == 10


def test_evaluate_as_predictions_and_sidecar_come(spark, tmp_path, capsys):
    rows = [(m, i, f"a b{i}", p) for m, p in (("base", "a"), ("finetuned", "a b0")) for i in range(4)]
    given = spark.createDataFrame(rows, "model string, pos long, reference string, prediction string")
    side = spark.createDataFrame([(i, "e", f"a b{i}", ["x", "y"] if i % 2 else ["x"]) for i in range(4)], "pos long, episode string, sentence string, buckets array<string>")
    by = lambda out: {(r.model, r.bucket): (r.n, r.norm_wer) for r in out.collect()}
    out, why = pipelines.evaluate_with_sidecar(given, side)
    assert why is None and by(out)[("base", "y")] == (2, 50.0) and by(out)[("finetuned", None)] == (4, 37.5)
    for wrong, said in ((side.where("pos < 3"), "3 rows, the predictions 4; they differ first at position 3"), (side.withColumn("sentence", F.when(F.col("pos") == 2, "?").otherwise(F.col("sentence"))), "position 2"), (None, "no sidecar")):
        out, why = pipelines.evaluate_with_sidecar(given, wrong)
        assert said in why and set(by(out)) == {("base", None), ("finetuned", None)}
    given.write.parquet(str(tmp_path / "p"))
    sinks.json_array(side, str(tmp_path / "side.json"))
    cli.main(["evaluate", str(tmp_path / "p"), "--sidecar", str(tmp_path / "side.json"), "--which", "base"])
    assert "|base |y" in capsys.readouterr().out.replace("  ", " ")
    cli.main(["evaluate", str(tmp_path / "p")])
    assert "overall rates only: no sidecar" in capsys.readouterr().out

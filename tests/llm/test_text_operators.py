"""URL filter, token counts, chat formatting, packing and token files against brute force."""

import hashlib
import random
import struct
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cuefold.llm import chat_format, packing, queries, token_count, token_file, url_filter, word_ids

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = ["a", "A", "b", " ", "  ", "\n", " \n", "é", "É", "ß", "'s", "'", "<|endoftext|>", "<|", "\xa0", "　", "中", "1", "12", "²", "!", "...", "\t", "the", "ing", "‍", "😀", "\x1c", "\x85", "ſ", "Σ", "Å", "İ", "́", "K"]


def odd_texts(n, seed, most=30):
    r = random.Random(seed)
    return ["".join(r.choice(ODD) for _ in range(r.randint(0, most))) for _ in range(n)]


def library(name):
    own = Tokenizer.from_file(public_tokenizers.path(name))
    own.no_truncation()
    own.no_padding()
    return own


def docs_of(spark, texts):
    """Texts with extra columns whose names the operators use themselves."""
    rows = [(i, t, 0, "x", 1.0) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, rid int, sha string, size double")


EDGES = [None, "", " \n", "same text", "same text", "Same Text", "x" * 30_000, "word " * 9_000, "ends<|endoftext|>"]


@pytest.mark.parametrize(
    "url, host, path, rule, verdict",
    [
        (None, "", "", None, "allow"),
        ("example.net/x", "", "", None, "allow"),
        ("http://WWW.Example.NET/en/1", "www.example.net", "/en/1", "example.net/en/", "allow"),
        ("http://example.net/de/casino", "example.net", "/de/casino", "net/", "block"),
        ("http://xexample.com/de/", "xexample.com", "/de/", None, "allow"),
        ("http://a.example.com/de/", "a.example.com", "/de/", "example.com/de/", "block"),
        ("http://a.org/fr/casino", "a.org", "/fr/casino", "org/fr/", "allow"),
        ("http://a.org/casino", "a.org", "/casino", None, "block"),
        ("http://a.org/casinos", "a.org", "/casinos", None, "allow"),
        ("http://a.org/free", "a.org", "/free", None, "allow"),
        ("http://a.org/free-free", "a.org", "/free-free", None, "allow"),
        ("http://free-bets.org", "free-bets.org", "", None, "block"),
        ("http://a.org?x=/en/#y", "a.org", "", None, "allow"),
        ("a://b://c.net/", "b:", "//c.net/", None, "allow"),
    ],
)
def test_urls(url, host, path, rule, verdict):
    assert url_filter.host_and_path(url) == (host, path)
    found = url_filter.Rules(url_filter.RULES).match(host, path)
    words = url_filter.Vocabulary(url_filter.STRICT, url_filter.SOFT, url_filter.SOFT_LIMIT)
    assert (found[0] if found else None) == rule
    assert (found[1] if found else "block" if words.blocks(*words.hits(url or "")) else "allow") == verdict


def test_weights_decide():
    """Equal counts of soft terms, different weights, different verdicts; one soft term never rejects."""
    words = url_filter.Vocabulary(url_filter.STRICT, url_filter.SOFT, url_filter.SOFT_LIMIT)
    hit = lambda url: words.hits(url)
    light, heavy, three = hit("http://a.org/free/cheap"), hit("http://a.org/free/poker"), hit("http://a.org/free/cheap/win")
    assert light[1] == heavy[1] == 2 and (light[2], heavy[2], three[2]) == (2, 3, 3)
    assert [words.blocks(*x) for x in (light, heavy, three)] == [False, True, True]
    alone = url_filter.Vocabulary((), {"a": 9}, 3)
    assert not alone.blocks(*alone.hits("x/a/a")) and alone.hits("x/a/a") == (0, 1, 9)


def test_vocabulary_of_a_table(spark):
    terms = spark.createDataFrame([("Bad", None), ("mild", 1), ("mild", 2), ("odd", 2), ("", 5), (None, 1)], "term string, weight int")
    strict, soft = url_filter.vocabulary(terms)
    assert strict == ("bad",) and soft == {"mild": 2, "odd": 2}
    pages = spark.createDataFrame([(1, "http://a.org/bad"), (2, "http://a.org/mild/odd"), (3, "http://a.org/mild"), (4, None)], "page_id int, url string")
    found = url_filter.judge_urls(pages, strict=strict, soft=soft, limit=4).collect()
    assert [(r.page_id, r.verdict) for r in sorted(found)] == [(1, "block"), (2, "block"), (3, "allow"), (4, "allow")]
    with pytest.raises(ValueError):
        url_filter.vocabulary(terms, most=1)


def test_url_query_agrees_with_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF}/pages.parquet')")
    rel = con.sql(url_filter.oracle())
    want = {tuple(dict(zip(rel.columns, r))[c] for c in rel.columns) for r in rel.fetchall()}
    assert {tuple(r[c] for c in rel.columns) for r in queries.op1_url_filters(spark, SF).collect()} == want
    empty = spark.createDataFrame([], "page_id long, url string, host string")
    assert url_filter.judge_urls(empty).count() == 0


def test_token_counts_are_the_library_s():
    own, counter = library("byte_bpe_50k.json"), token_count.MergeCounter(public_tokenizers.path("byte_bpe_50k.json"))
    texts = odd_texts(1500, 1) + [t or "" for t in EDGES]
    for text, encoded in zip(texts, own.encode_batch(texts, add_special_tokens=False)):
        assert counter.count(text) == len(encoded.ids), text


def test_token_count_query(spark):
    own = library("byte_bpe_50k.json")
    rows = {r.doc_id: r for r in queries.op2_token_counts(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        r, n = rows[d.doc_id], len(own.encode(d.text or "", add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((d.text or "").encode()), n, n > 1024)
    edge = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_count.count_tokens(docs_of(spark, EDGES)).collect()}
    assert edge[0] == edge[1] == (0, 0) and len(edge) == len(EDGES)
    assert token_count.count_tokens(docs_of(spark, EDGES).limit(0)).count() == 0


def test_chats_round_trip():
    r, own = random.Random(2), library("byte_bpe_50k.json")
    parts = ODD + ["\\", "</s>", "[INST]", "[/INST]", "|>", "<s>", "<<SYS>>", "<", "|"]
    for _ in range(500):
        turns = [(r.choice(["user", "assistant", "system", "", "as\\x"]), "".join(r.choice(parts) for _ in range(r.randint(0, 12)))) for _ in range(r.randint(1, 5))]
        text, spans = chat_format.render(turns)
        assert chat_format.parse(text) == turns
        offsets = np.array(own.encode(text, add_special_tokens=False).offsets)
        found = chat_format.mask(spans, offsets[:, 0], offsets[:, 1])
        assert chat_format.masked_text(text, found) == "".join(said for role, said in turns if role == "assistant")
        for control in ("</s>", "[INST]", "[/INST]", "<s>"):
            assert control not in text


def test_chat_query(spark):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    turns = defaultdict(list)
    for r in spark.read.parquet(f"{SF}/conversations.parquet").collect():
        turns[r.conv_id].append((r.turn, r.role, r.text or ""))
    turns[-1] = [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]
    got = {r.conv_id: r for r in queries.op3_chat_formatting(spark, SF).collect()}
    assert set(got) == set(turns)
    for k, said in turns.items():
        said.sort()
        loss = "".join(t for _, role, t in said if role == "assistant")
        r = got[k]
        assert (r.n_turns, r.turns_sha256) == (len(said), sha("".join(f"{role}\n{t}\n" for _, role, t in said)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss)) and r.formatted_chars >= sum(len(t) for _, _, t in said)


def test_chat_edges(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", ""), (1, 1, "assistant", ""), (2, None, None, "x"), (2, 0, "assistant", "long " * 5000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS mask", "'' AS formatted")
    got = {r.conv_id: (r.n_turns, r.loss_chars) for r in chat_format.read_back(chat_format.format_chats(df)).collect()}
    assert got == {1: (3, 0), 2: (2, 25000)}
    assert chat_format.read_back(chat_format.format_chats(df.limit(0))).count() == 0


def test_word_ids_are_the_library_s():
    encoder = word_ids.WordEncoder()
    texts = odd_texts(3000, 3) + [t or "" for t in EDGES] + ["It's, THE end. isn't... ÀÉ ªº µ² x́ y,."]
    for text, encoded in zip(texts, encoder.library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(encoder.encode(text.encode()), "<u4").tolist() == encoded.ids, text


def ids_of(texts):
    return [e.ids + [1] for e in library("word_bpe_49k.json").encode_batch([t or "" for t in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def check_packing(rows, ids):
    bins, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and crc(part) == r.ids_crc32 and r.start == 4096 * r.piece
        bins[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r.piece)
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    assert {k: sorted(v) for k, v in pieces.items()} == {k: list(range(-(-len(v) // 4096))) for k, v in ids.items()}
    return len(bins)


def test_packing_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    ids = dict(zip([d.doc_id for d in docs], ids_of([d.text for d in docs])))
    used = check_packing(queries.op5_best_fit_packing(spark, SF).collect(), ids)
    assert used <= -(-sum(map(len, ids.values())) // 4096) + 1


def test_places_of_pieces_are_not_broadcast(spark):
    """There is a place for each piece, in files that are far smaller than what a broadcast of them holds."""
    found = spark.range(500).select(F.col("id").alias("doc_id"), (F.col("id") % 900 + 1).alias("length"))
    plan = packing.pack(found)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan, plan


def test_packing_edges_and_shards(spark):
    ids = dict(enumerate(ids_of(EDGES)))
    check_packing(packing.pack_documents(docs_of(spark, EDGES)).collect(), ids)
    assert packing.pack_documents(docs_of(spark, EDGES).limit(0)).count() == 0
    r = random.Random(5)
    lengths = [r.randint(1, 3000) for _ in range(3000)]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "k long, length long")
    rows = packing.pack(df, shard=300, relay=4).collect()
    fill = defaultdict(int)
    for x in sorted(rows, key=lambda x: (x.sequence_id, x.offset)):
        assert x.offset == fill[x.sequence_id]
        fill[x.sequence_id] += x.length
    assert len(rows) == 3000 and max(fill.values()) <= 4096 and len(fill) <= sum(lengths) / 4096 * 1.03


def test_local_search_beats_best_fit():
    rng = np.random.default_rng(0)
    lengths = rng.integers(1300, 1500, 4000)
    bins = packing.Bins(lengths.astype(np.int64), 4096)
    before, squares = bins.used(), int((bins.fill**2).sum())
    bins.search()
    assert bins.used() < before and int((bins.fill**2).sum()) > squares
    assert (np.bincount(bins.bin_of, lengths, len(bins.fill)) == bins.fill).all() and bins.fill.max() <= 4096


def test_local_search_ends_when_no_bin_has_a_step():
    rng = np.random.default_rng(1)
    lengths = rng.integers(700, 1101, 800).astype(np.int64)
    bins = packing.Bins(lengths, 4096)
    bins.search()
    assert bins.used() > bins.needed()
    for source in np.flatnonzero((bins.fill > 0) & (bins.fill < 4096)):
        own = lengths[bins.bin_of == source]
        offers = {int(a) for a in own} | {int(own[i] + own[j]) for i in range(len(own)) for j in range(i)}
        for target in np.flatnonzero((bins.fill >= bins.fill[source]) & (bins.fill < 4096)):
            if target != source:
                room = 4096 - bins.fill[target]
                assert own.min() > room and not any(0 < size - n <= room for size in offers for n in lengths[bins.bin_of == target])


def test_any_two_pieces_of_a_bin_are_offered():
    bins = packing.Bins(np.array([3995, 100, 51, 50] + [2] * 70, np.int64), 4096)
    assert bins.fill.tolist() == [4095, 241]
    assert bins._step(1) and bins.fill.tolist() == [4096, 240] and bins.bin_of[1:4].tolist() == [1, 0, 0]


@pytest.mark.parametrize("n", [1, 2, 17, 1000, 70_000, 300_000])
def test_rans_round_trip(n):
    rng = np.random.default_rng(n)
    ids = (rng.zipf(1.2, n) % 49_408).astype(np.uint32)
    table = token_file.Frequencies.of(ids)
    assert int(table.freq.sum()) == 1 << token_file.SCALE_BITS and table.freq.min() >= 1
    body, again = token_file.encode_block(ids, table), token_file.Frequencies.from_bytes(table.to_bytes())
    assert (token_file.decode_block(body, again, again.slots()) == ids).all()
    _, lanes, points, _ = struct.unpack_from("<IIII", body)
    size = token_file.CHECKPOINT * lanes
    for k in range(points):  # every checkpoint decodes on its own
        assert (token_file.decode_block(body, again, again.slots(), k, k + 1) == ids[k * size : (k + 1) * size]).all()
    with pytest.raises((ValueError, IndexError)):
        broken = bytearray(body)
        broken[16 + 4 * points] ^= 1  # a checksum
        token_file.decode_block(bytes(broken), again, again.slots())


def test_token_file_query(spark):
    docs = sorted((d.doc_id, d.text) for d in spark.read.parquet(f"{SF}/documents.parquet").collect())
    want, at = {}, 0
    for (doc_id, _), ids in zip(docs, ids_of([t for _, t in docs])):
        want[doc_id] = (at, len(ids), crc(ids))
        at += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op6_token_files(spark, SF).collect()} == want


def test_token_file_edges(spark, monkeypatch):
    texts = EDGES * 3
    got = {r.doc_id: (r.start, r.n_tokens) for r in token_file.token_digests(docs_of(spark, texts)).collect()}
    at = 0
    for i, ids in enumerate(ids_of(texts)):
        assert got[i] == (at, len(ids))
        at += len(ids)
    assert token_file.token_digests(docs_of(spark, texts).limit(0)).count() == 0
    twice = docs_of(spark, ["a b", "c"]).union(docs_of(spark, ["a b", "c"]))
    assert sorted((r.doc_id, r.start, r.n_tokens) for r in token_file.token_digests(twice).collect()) == [(0, 0, 3), (0, 3, 3), (1, 6, 2), (1, 8, 2)]


def test_groups_and_blocks(monkeypatch):
    """Several blocks share a group's table and hold whole documents."""
    monkeypatch.setattr(token_file, "BLOCK_IDS", 50)
    ids = [np.array(x, "<u2") for x in ids_of(odd_texts(60, 6))]
    packed, n_docs, bodies = token_file.encode_group(ids)
    assert len(bodies) == len(n_docs) > 3 and sum(n_docs) == 60
    table = token_file.Frequencies.from_bytes(packed)
    doc = 0
    for n, body in zip(n_docs, bodies):
        got = token_file.decode_block(body, table, table.slots())
        assert (got == np.concatenate(ids[doc : doc + n])).all()
        doc += n


@pytest.mark.parametrize("kind", ["smallint", "decimal(10,2)", "date", "string", "double", "timestamp", "timestamp_ntz", "struct", "array", "boolean", "binary"])
def test_token_files_of_any_id(spark, kind, monkeypatch):
    """Ids of any type come back as they are, null first; many rows of one id keep all rows."""
    texts = ["a b", "c", None, "d e f", "a b"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "x")] + [(9, f"hot {k % 7}") for k in range(300)]
    docs = spark.createDataFrame(rows, "n int, text string")
    day = F.date_add(F.lit("2020-01-01").cast("date"), F.col("n"))
    n = F.col("n")
    nested = {
        "struct": F.when(n.isNotNull(), F.struct(F.when(n != 2, n % 3).alias("a"), day.cast("timestamp").alias("b"))),
        "array": F.when(n.isNotNull(), F.slice(F.array(F.when(n != 2, n % 3), n), 1, F.when(n == 1, 1).otherwise(2))),
    }
    own = day.cast(kind) if kind in ("date", "timestamp", "timestamp_ntz") else n.cast("string").cast(kind) if kind == "binary" else nested[kind] if kind in nested else n.cast(kind)
    docs = docs.select(own.alias("doc_id"), "text").repartition(5)
    monkeypatch.setattr(token_file, "ROWS_A_PART", 20)
    read = token_file.decode_documents(token_file.encode_documents(docs))
    assert read.schema["doc_id"].dataType == docs.schema["doc_id"].dataType
    found = sorted(read.collect(), key=lambda r: r.start)
    assert found[0].doc_id is None and len(found) == len(rows)
    texts_of = {t: np.array(x, "<u4").tobytes() for t, x in zip([r.text for r in docs.collect()], ids_of([r.text for r in docs.collect()]))}
    assert Counter((repr(r.doc_id), bytes(r.ids)) for r in found) == Counter((repr(r.doc_id), texts_of[r.text]) for r in docs.collect())
    at = 0
    for r in found:
        assert r.start == at and len(r.ids) == 4 * r.n_tokens
        at += r.n_tokens
    assert [r.doc_id for r in found] == [r.doc_id for r in docs.orderBy("doc_id").collect()]
    ranges = token_file.Ranges(docs, "doc_id")
    assert ranges.n == 4
    assert kind not in ("smallint", "string", "double") or len({ranges.part(found[-1].doc_id, salt << 56) for salt in range(-128, 128)}) > 2  # the hot id fills ranges


def test_ranges_grow_with_identifiers(spark, monkeypatch):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 60).alias("text"))
    monkeypatch.setattr(token_file, "ROWS_A_PART", 20)
    assert token_file.Ranges(docs, "doc_id").n == 4
    monkeypatch.setattr(token_file, "RANGE_IDS", 10_000)
    assert token_file.Ranges(docs, "doc_id").n == 40


def test_batches_are_bounded_by_bytes(spark):
    from cuefold.llm import batches

    rows = spark.range(400).select("id", F.repeat(F.lit("x"), F.when(F.col("id") == 0, 3 * batches.MAX_BYTES).otherwise(100_000).cast("int")).alias("text"))

    def sizes(found):
        for batch in found:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "bytes"])

    def of(df):
        return batches.map_batches(df, sizes, "n long, bytes long").collect()

    before = spark.conf.get(batches.LIMIT, None)
    try:
        spark.conf.unset(batches.LIMIT)
        found = of(rows)
        assert sum(r.n for r in found) == 400
        assert all(r.bytes < 2 * batches.MAX_BYTES for r in found if r.bytes < 3 * batches.MAX_BYTES) and len(found) > 4
        spark.conf.set(batches.LIMIT, 1 << 20)
        assert max(r.n for r in of(rows.where("id > 0"))) <= 12
        assert int(spark.conf.get(batches.LIMIT).rstrip("b")) == 1 << 20  # a limit of the session's own stays
    finally:
        spark.conf.unset(batches.LIMIT) if before is None else spark.conf.set(batches.LIMIT, before)

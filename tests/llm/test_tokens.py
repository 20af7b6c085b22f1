import functools
import glob
import zlib

import numpy as np
import pyarrow as pa
import pytest
from folioflow.llm import packing, queries, tokenfile
from folioflow.llm.tokens import ChunkEncoder, vocabulary
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.conftest import SMALL

ENCODER = ChunkEncoder(vocabulary())


@functools.cache
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary())


def whole(texts):
    t = tokenizer()
    return [np.asarray([*t.encode(x, add_special_tokens=False).ids, 1], dtype="<u4") for x in texts]


def test_chunks_give_the_ids_of_whole_texts(spark):
    texts = [r[0] for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").collect()]
    texts += ["", " ", "a  b\n\nc", "it's we'll x y\u0085z", "é ́x ᄀ ᅡ", "<|endoftext|> a<|startoftext|>b", "İI ΑΣ ΑΣ Σ", "12 34\t56\r\n7\x0b8\x0c9\x1c0", "\U0001f600\U0001f600 ok"]
    tail = np.asarray([1], dtype="<u4").tobytes()
    assert ChunkEncoder(vocabulary())(texts, tail) == [x.tobytes() for x in whole(texts)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("abZsT01 \n\t'.,<|>-_ÀÞßà×÷ÿĀāĮįİĲŁ€\u0301\u0085ab "), max_size=30), max_size=4))
def test_pieces_of_any_signs_give_the_ids_of_whole_texts(texts):
    assert ENCODER(texts, (1).to_bytes(4, "little")) == [x.tobytes() for x in whole(texts)]
    flat, at = ENCODER.ids(pa.array([None, *texts, "cut off"], pa.string()).slice(0, len(texts) + 1), 1)
    assert [flat[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [[1], *(x.tolist() for x in whole(texts))]


def test_a_full_store_keeps_what_is_used():
    encode = ChunkEncoder(vocabulary())
    encode._pieces.most = 50
    texts = [f"common words and w{a}x{b}" for a in "abcdefgh" for b in "abcdefgh"]
    for at in range(0, len(texts), 8):
        assert encode(texts[at : at + 8]) == [x[:-1].tobytes() for x in whole(texts[at : at + 8])]
        assert encode._pieces.size <= 50
    assert {"common", "words", "and"} <= set(encode._pieces.place)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 2047, 2048, 2049, 4096, 5001])
def test_pieces_are_powers_of_two(n):
    p = packing.piece_lengths(n)
    assert sum(p) == n and all(x & (x - 1) == 0 and x <= 2048 for x in p) and p == sorted(p, reverse=True)


def test_pieces_hold_each_id_once(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    ids = dict(zip(texts, whole(texts.values()), strict=True))
    rows = queries.op5_packing(spark, SMALL).collect()
    assert len({r.sequence_id for r in rows}) == len(rows) and {r.offset for r in rows} == {0}
    covered = dict.fromkeys(ids, 0)
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        assert r.start == covered[r.doc_id] and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        covered[r.doc_id] += r.length
    assert covered == {k: len(v) for k, v in ids.items()}


def test_token_file_round_trip(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    ids = dict(zip(texts, whole(texts.values()), strict=True))
    start = 0
    rows = {r.doc_id: r for r in queries.op7_token_file(spark, SMALL).collect()}
    for k in sorted(ids):
        assert (rows[k].start, rows[k].n_tokens, rows[k].ids_crc32) == (start, len(ids[k]), zlib.crc32(ids[k].tobytes()))
        start += len(ids[k])
    assert len(rows) == len(ids)


def test_odd_rows(spark, odd_docs, no_docs):
    n = odd_docs.count()
    pieces = packing.pack(odd_docs).collect()
    assert sum(r.start == 0 for r in pieces) == n
    assert [list(r.ids) for r in pieces if r.doc_id == 2] == [[1]]
    back = tokenfile.read_tokens(spark, tokenfile.write_tokens(odd_docs)).collect()
    assert len(back) == n
    at = 0
    for r in sorted(back, key=lambda r: r.start):
        assert r.start == at and len(r.ids) == r.n_tokens
        at += r.n_tokens
    assert packing.pack(no_docs).count() == 0
    assert tokenfile.read_tokens(spark, tokenfile.write_tokens(no_docs)).count() == 0


def test_columns_with_names_of_the_results(spark):
    rows = spark.createDataFrame([(1, "a b", 5, 6, 7, 8, 9)], "doc_id long, text string, ids int, start int, length int, part int, n_tokens int")
    assert [(r.start, r.length) for r in packing.pack(rows).orderBy("start").collect()] == [(0, 2), (2, 1)]
    assert [(r.start, r.n_tokens) for r in tokenfile.read_tokens(spark, tokenfile.write_tokens(rows)).collect()] == [(0, 3)]
    assert packing.pack(rows, digest=True).orderBy("start").first().ids_crc32 == zlib.crc32(whole(["a b"])[0][:2].tobytes())


def footers(path):
    import pyarrow.parquet as pq

    return [pq.ParquetFile(f).metadata for f in sorted(glob.glob(f"{path}/*.parquet"))]


def columns(meta, name):
    return [meta.row_group(g).column(c) for g in range(meta.num_row_groups) for c in range(meta.num_columns) if meta.row_group(g).column(c).path_in_schema.split(".")[0] == name]


@pytest.fixture(scope="module")
def token_file(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    return tokenfile.write_tokens(docs, row_group_bytes=256 << 10, page_bytes=16 << 10)


def test_encodings_row_groups_and_page_indexes(spark, token_file):
    metas = footers(token_file)
    chunks = [c for m in metas for c in columns(m, "ids")]
    assert all("RLE_DICTIONARY" in c.encodings and c.compression == "ZSTD" for c in chunks)
    assert all(c.has_column_index and c.has_offset_index for m in metas for name in ("doc_id", "n_tokens", "local_start") for c in columns(m, name))
    assert sum(m.num_row_groups for m in metas) > len(metas) and max(c.total_compressed_size for c in chunks) < 512 << 10
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    delta = tokenfile.write_tokens(docs, encoding="delta")
    assert all("DELTA_BINARY_PACKED" in c.encodings and "RLE_DICTIONARY" not in c.encodings for m in footers(delta) for c in columns(m, "ids"))
    same = tokenfile.write_tokens(docs)
    key = lambda r: r.start
    assert sorted(tokenfile.read_tokens(spark, delta).collect(), key=key) == sorted(tokenfile.read_tokens(spark, same).collect(), key=key)


def test_row_groups_follow_the_ids(token_file):
    ends = []
    for m in footers(token_file):
        for c in columns(m, "doc_id"):
            ends.append((c.statistics.min, c.statistics.max))
    assert ends == sorted(ends) and all(a[1] <= b[0] for a, b in zip(ends, ends[1:], strict=False))


def test_metadata_alone_opens_no_ids(spark, token_file):
    plan = tokenfile.read_tokens(spark, token_file).select("doc_id", "start", "n_tokens")._jdf.queryExecution().executedPlan().toString()
    assert "ids:array" not in plan and plan.count("ReadSchema") == 2
    rows = tokenfile.read_tokens(spark, token_file)
    assert rows.where("n_tokens <> size(ids)").count() == 0
    total = spark.read.parquet(token_file).agg({"n_tokens": "sum"}).first()[0]
    last = rows.orderBy("start", ascending=False).first()
    assert last.start + last.n_tokens == total


def test_chosen_documents_are_read_from_few_row_groups(spark, token_file):
    wanted = [3, 500, 501]
    everything = {r.doc_id: r for r in tokenfile.read_tokens(spark, token_file).collect()}
    rows = tokenfile.read_tokens(spark, token_file, wanted)
    assert {r.doc_id: r for r in rows.collect()} == {k: everything[k] for k in wanted}
    scan = spark.read.parquet(token_file).where("doc_id in (3, 500, 501)").select("doc_id", "ids")
    scan.collect()
    leaf = scan._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert leaf.metrics().get("numOutputRows").get().value() < len(everything) / 2
    assert "In(doc_id" in str(leaf.metadata().get("PushedFilters").get())


def test_buckets_hold_pieces_of_one_length(spark, tmp_path):
    pieces = packing.pack(spark.read.parquet(f"{SMALL}/documents.parquet"))
    packing.write_buckets(pieces, str(tmp_path / "buckets"))
    back = spark.read.parquet(str(tmp_path / "buckets"))
    assert back.count() == pieces.count() and back.where("length <> size(ids)").count() == 0
    one = back.where("length = 512")
    assert one.count() == pieces.where("length = 512").count() and "PartitionFilters: [isnotnull(length" in one._jdf.queryExecution().executedPlan().toString()
    assert {p.name for p in (tmp_path / "buckets").iterdir() if p.is_dir()} <= {f"length={1 << b}" for b in range(12)}

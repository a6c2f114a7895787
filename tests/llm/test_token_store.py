import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from podium.llm import huffman, token_store

RNG = np.random.default_rng(0)


def round_trip(counts, limit=16):
    lengths = huffman.code_lengths(counts, limit)
    used = counts > 0
    assert (lengths[used] > 0).all() and not lengths[~used].any()
    assert sum(2.0 ** -int(x) for x in lengths[used]) <= 1 + 1e-12
    code = huffman.Code(np.frombuffer(lengths.tobytes(), np.uint8))
    ids = RNG.choice(len(counts), 5000, p=counts / counts.sum()).astype(np.uint32)
    raw, marks = code.encode(ids)
    assert (code.decode(raw, marks, len(ids)) == ids).all()
    return lengths


@pytest.mark.parametrize("counts", [[0, 0, 5], [1, 1], [10, 1, 1, 1, 0, 7], list(2 ** np.arange(40))])
def test_code_round_trip(counts):
    round_trip(np.array(counts))


def test_length_limit_and_optimum():
    import heapq

    assert round_trip(2 ** np.arange(40), 6).max() == 6
    counts = RNG.integers(1, 1000, 300)
    lengths = round_trip(counts, 30)
    heap, cost = [int(x) for x in counts], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    assert int((lengths * counts).sum()) == cost


def test_pieces_encode_like_whole_texts(monkeypatch):
    from tokenizers import Tokenizer

    path = token_store.public_vocabulary()
    whole = Tokenizer.from_file(path)
    random.seed(3)
    chars = ["a", "B", "é", " ", " ", "\n", "\t", " ", " ", "　", "\x85", "\x1c", "'", "s", "1", ".", "!", "日", "😀", "<|endoftext|>", " "]
    texts = ["".join(random.choice(chars) for _ in range(random.randint(0, 40))) for _ in range(3000)]
    monkeypatch.setattr(token_store, "CACHE", 300)
    monkeypatch.setattr(token_store, "SLICE", 200)
    column = pa.array(texts)
    got = list(token_store.Tokenizer(path).encode(column))
    assert len(got) == len(texts)
    for t, ids in zip(texts, got):
        assert ids.tolist() == whole.encode(t, add_special_tokens=False).ids, repr(t)


ROWS = [(5, "hello world"), (1, None), (3, ""), (None, "no id"), (3, "again 3"), (2, "x" * 300), (9, "long " * 60000), (-4, "neg")]


def test_files_round_trip(spark, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_store, "FILE_DOCS", 3)
    whole = Tokenizer.from_file(token_store.public_vocabulary())
    docs = spark.createDataFrame([(*r, "clash") for r in ROWS], "doc_id long, text string, n string")
    files = token_store.store(docs, token_store.public_vocabulary())
    got = sorted(token_store.read_digests(files).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r[0] for r in ROWS), key=lambda x: (x is not None, x))
    want = {(k, tuple(whole.encode(t or "", add_special_tokens=False).ids + [2])) for k, t in ROWS}
    at, everything = 0, []
    paths = [f.path for f in files.orderBy("start").collect()]
    for p in paths:
        r = token_store.Reader(p)
        everything += r.read(0, 1 << 40).tolist()
    for r in got:
        ids = everything[r.start : r.start + r.n_tokens]
        assert r.start == at and (r.doc_id, tuple(ids)) in want
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += r.n_tokens
    assert at == len(everything)
    # range reads decode only the blocks they need and agree with the whole
    for f in files.collect():
        part = token_store.Reader(f.path).read(f.start + 1, f.start + 5)
        assert part.tolist() == everything[f.start + 1 : min(f.start + 5, f.start + f.n_tokens)]


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_store.read_digests(token_store.store(docs, token_store.public_vocabulary())).collect() == []


def test_files_are_read_back_by_a_task_each(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(token_store, "FILE_DOCS", 1)
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(200)], "doc_id long, text string")
    files = token_store.store(docs, token_store.public_vocabulary())
    assert files.count() == 200 and spark.conf.get("spark.sql.adaptive.enabled") == "true"
    got = token_store.read_digests(files).withColumn("task", F.spark_partition_id())
    assert got.select("task").distinct().count() == 200

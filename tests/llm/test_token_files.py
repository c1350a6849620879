import glob
import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from opinara.llm.token_files import read_documents, read_index, token_table, tokenized, write_token_files
from opinara.session import scratch_path

MODEL = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
SCHEMA = "doc_id long, text string, shard string, frame long"


def ids(text):
    return [*MODEL.encode(text or "", add_special_tokens=False).ids, 2]


def texts():
    words = "one two three, été über don't 42 the of".split()
    rows = [(i * 7 % 501, " ".join(words[(i * k) % len(words)] for k in range(i % 90))) for i in range(400)]
    return rows + [(900, None), (901, ""), (902, "word " * 60000), (903, "a <|endoftext|> b\n\n\nc"), (-5, "first")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 3) for r in rows], SCHEMA).repartition(5)


def want(rows):
    out, start = [], 0
    for i, t in sorted(rows):
        a = np.array(ids(t), "<u4")
        out.append((i, start, len(a), zlib.crc32(a.tobytes())))
        start += len(a)
    return out


def test_round_trip(spark):
    got = sorted(tuple(r) for r in tokenized(frame(spark, texts())).collect())
    assert got == want([(i, t or "") for i, t in texts()])


def test_single_documents_and_small_shards(spark, monkeypatch):
    folder = scratch_path(spark, "test-tokens")
    monkeypatch.setattr("opinara.llm.token_files.SHARD_BYTES", 400)
    write_token_files(frame(spark, texts()), folder)
    index = read_index(spark, folder)
    assert index.select("shard").distinct().count() > 5
    some = [3, 700 % 501, 902, 903]
    got = {r.doc_id: r.ids for r in read_documents(index.filter(F.col("doc_id").isin(some)), folder).collect()}
    assert got == {i: ids(t) for i, t in texts() if i in some}
    order = [r.doc_id for r in index.orderBy("shard", "place").collect()]
    assert order == sorted(order)
    assert sorted(tuple(r) for r in token_table(spark, folder).collect()) == want([(i, t or "") for i, t in texts()])


def test_another_dictionary_is_refused(spark):
    folder = scratch_path(spark, "test-tokens")
    write_token_files(frame(spark, texts()), folder)
    with open(f"{folder.removeprefix('file:')}/dictionary", "wb"):
        pass
    with pytest.raises(PythonException, match="another dictionary"):
        token_table(spark, folder).collect()


def test_dictionary_helps_short_documents(spark):
    folder = scratch_path(spark, "test-tokens")
    write_token_files(frame(spark, texts()), folder)
    assert os.path.getsize(f"{folder.removeprefix('file:')}/dictionary") > 0
    short = read_index(spark, folder).filter("n_tokens between 20 and 60").agg(
        F.sum("length") / F.sum("n_tokens")).first()[0]
    assert short < 1.0  # two bytes a token uncompressed


def test_repeated_rows_null_id_and_one_row(spark):
    rows = [(4, "b"), (4, "b"), (4, "a b c"), (None, "none")]
    got = tokenized(frame(spark, rows)).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 4, 4, 4] and [r.n_tokens for r in got] == [2, 2, 2, 4]
    assert [r.start for r in got] == [0, 2, 4, 6]


def test_no_rows(spark):
    out = tokenized(frame(spark, []))
    assert out.collect() == [] and out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_driver_neither_encodes_nor_trains(spark, monkeypatch):
    from opinara.llm import token_files
    rows = frame(spark, texts()).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # replaced here, not in the workers
    monkeypatch.setattr(token_files.Encoder, "encode", None)
    monkeypatch.setattr(token_files.zstandard, "train_dictionary", None)
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert len(token_files.train_dictionary(rows, path)) > 100
    assert token_files.train_dictionary(rows.limit(0), path) == token_files.train_dictionary(rows.filter("doc_id = 901"), path) == b""

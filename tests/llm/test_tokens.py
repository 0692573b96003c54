"""Token shards against a plain encoding: order, starts, checksums, missing and repeated keys."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vigilframe.llm import tokens
from vigilframe.llm.queries import QUERIES, encoder

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, start long"


def plain(rows):
    """(doc_id, start, n_tokens, ids_crc32) in the given order."""
    tokenizer, start, out = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json"))), 0, []
    for key, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_equals_plain_encoding(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    found = QUERIES["op6_token_ids"](spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").orderBy("start").collect()
    assert [tuple(r) for r in found] == plain([tuple(r) for r in docs])


@pytest.mark.parametrize("per_shard", [2, 4096])
def test_missing_and_repeated_keys_empty_and_long_texts(spark, per_shard):
    rows = [(5, None), (5, "five"), (5, "five"), (None, "nobody's"), (None, "other"), (None, None), (-3, ""), (7, "long words " * 20_000), (tokens.NO_KEY, "least")]
    df = spark.createDataFrame([(k, t, -1) for k, t in rows], SCHEMA)
    path, manifest = tokens.write_tokens(df, encoder(), docs_per_shard=per_shard)
    found = [tuple(r) for r in tokens.read_tokens(path, manifest).orderBy("start").collect()]
    ordered = df.orderBy("doc_id", F.xxhash64("text"), "text").select("doc_id", "text").collect()
    assert found == plain([tuple(r) for r in ordered])
    assert [r[0] for r in found] == [None] * 3 + [tokens.NO_KEY, -3, 5, 5, 5, 7]


def test_empty_table(spark):
    path, manifest = tokens.write_tokens(spark.createDataFrame([], SCHEMA), encoder())
    assert manifest.count() == 0 and tokens.read_tokens(path, manifest).count() == 0

"""Id files: the coded sequences, reading by document, and the query beside the tokenizer's own library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from rillwork.llm import id_files

BPE = public_tokenizers.path("byte_bpe_50k.json")
FOLDER = "/root/testdata/sf0.001"


def own_library():
    known = Tokenizer.from_file(BPE)
    known.encode_special_tokens = True
    return lambda text: [*known.encode(text or "", add_special_tokens=False).ids, 0]


@pytest.mark.parametrize("values, bound", [
    ([], 0), ([0], 0), ([0, 0, 0], 0), ([5], 5), ([1, 2, 3], 1000000), ([7] * 5000, 7), ([0] * 300 + [2**63] * 300, 2**63), ([2**64 - 1], 2**64 - 1)])
def test_sequences(values, bound):
    coded = id_files.EliasFano(id_files.EliasFano.coded(np.array(values, dtype=np.uint64), bound))
    assert coded.values(0, len(values) + 5).tolist() == values
    assert [coded[i] for i in range(0, len(values), 97)] == values[::97]


def test_random_sequences_and_their_size():
    rng = random.Random(4)
    for _ in range(40):
        n, mean = rng.randint(1, 3000), rng.choice([1, 3, 100, 5000])
        ends = np.cumsum([rng.randint(1, 2 * mean) for _ in range(n)])
        raw = id_files.EliasFano.coded(ends, int(ends[-1]))
        coded = id_files.EliasFano(raw)
        first, count = rng.randrange(n), rng.randint(1, n)
        assert coded.values(first, count).tolist() == ends[first:first + count].tolist()
        assert coded[n - 1] == ends[-1]
        # two bits a value and the lower ones, the select structure and the head
        assert 8 * len(raw) <= n * (3 + np.log2(max(1.0, ends[-1] / n))) + 32 * (n / id_files.SAMPLE + 1) + 8 * 28


def test_query(spark):
    encode, at = own_library(), 0
    found = {r.doc_id: r for r in entry.queries()["op13_elias_fano_id_files"](spark, FOLDER).collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").collect()
    assert len(found) == len(docs)
    for d in docs:
        ids = np.array(encode(d.text), dtype="<u4")
        assert tuple(found[d.doc_id]) == (d.doc_id, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


SCHEMA = "doc_id long, text string, start string, part string, seq string, shard string, ids string"


def test_odd_documents_in_small_shards(spark):
    long = "wort \U0001f600 " * 40000
    texts = [(5, "<|endoftext|> is text"), (3, None), (3, ""), (-2**63, "least"), (2**63 - 1, "greatest"), (None, "no id"), (None, None), (8, " " * 200000 + "x"),
             (9, long), *[(7, "again")] * 50, *[(7, f"text {i}") for i in range(50)]]
    docs = spark.createDataFrame([(*t, "x", "x", "x", "x", "x") for t in texts], SCHEMA).repartition(4)
    index = id_files.write(docs, id_files.new_folder(spark), BPE, shard_ids=60)
    found = sorted(id_files.read(index).collect(), key=lambda r: r.start)
    encode, at = own_library(), 0
    assert [r.doc_id for r in found] == sorted((d for d, _ in texts if d is not None)) + [None, None]
    for r in found:
        assert r.start == at
        at += r.n_tokens
    want = sorted((str(d), len(i), zlib.crc32(i.tobytes())) for d, i in ((d, np.array(encode(t), dtype="<u4")) for d, t in texts))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in found) == want
    shards = index.orderBy("part", "seq").collect()
    assert len(shards) > 5
    # documents by number, in any order
    single, k = {r.start: r for r in found}, 0
    for s in shards:
        shard = id_files.Shard(s.shard)
        assert (shard.documents, shard.ids, shard.width) == (s.documents, s.ids, 2)
        for i in reversed(range(shard.documents)):
            r = single[k + int(shard.bounds(i, 1)[0])]
            assert (shard.doc_id(i), zlib.crc32(shard.document(i).tobytes())) == (r.doc_id, r.ids_crc32)
        k += s.ids
        shard.close()


def test_no_documents(spark):
    index = id_files.write(spark.createDataFrame([], SCHEMA), id_files.new_folder(spark), BPE)
    assert index.count() == 0 and id_files.read(index).count() == 0

"""Byte-level BPE and packing."""

import base64
import gc
import hashlib
import os
import random
import time
import weakref
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from brute import AWKWARD, SCHEMA, awkward
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from climagrid.llm import bpe, minhash, packing, quality, units
from climagrid.llm.queries import QUERIES

RANKS, JSON = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(3)
    parts = list("ab AB.,'\"\n\t  \x85\x1c\x1fé中1 9#") + ["'s", "'ll", "\n\n", "🙂", "don't ", "<|endoftext|>"]
    mixed = ["".join(draw.choice(parts) for _ in range(draw.randrange(60))) for _ in range(3000)]
    return [t or "" for _, t, _, _ in AWKWARD] + mixed + [chr(i) + " " + chr(i) for i in range(0, 0xD800, 5)]


def test_ids_are_those_of_the_libraries(reference, texts):
    expected = [reference.encode_ordinary(t) for t in texts]
    own = bpe.codec(RANKS, P.PATTERN).table.pack(texts)
    assert [np.frombuffer(b, "<u4").tolist() for b in own] == expected
    tokenizer = Tokenizer.from_file(JSON)
    tokenizer.encode_special_tokens = True
    expected = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    own = packing._unit_table(JSON).pack(texts)
    assert [np.frombuffer(b, "<u4").tolist() for b in own] == expected


def test_every_token_of_the_vocabulary_survives(reference):
    codec = bpe.codec(RANKS, P.PATTERN)
    readable = [t.decode() for t in codec.tokens if t.decode(errors="ignore").encode() == t]
    ids = [np.frombuffer(b, "<u4") for b in codec.table.pack(readable)]
    assert [reference.decode(i.tolist()) for i in ids] == readable


def test_round_trip_of_awkward_rows(spark, reference):
    found = bpe.decode(bpe.encode(awkward(spark), RANKS, P.PATTERN), RANKS).collect()
    key = lambda i: (i is None, i or 0)
    expected = sorted(((i, t or "") for i, t, _, _ in AWKWARD), key=lambda r: key(r[0]))
    found = sorted(((r.doc_id, r.ids, r.decoded) for r in found), key=lambda r: key(r[0]))
    assert [(i, d.decode()) for i, _, d in found] == expected
    assert [i for _, i, _ in found] == [reference.encode_ordinary(t) for _, t in expected]


def test_the_query_round_trips(spark):
    import pandas as pd

    docs = pd.read_parquet(f"{SF}/documents.parquet").set_index("doc_id").text.fillna("")
    for row in QUERIES["op4_byte_bpe"](spark, SF).collect():
        assert row.decoded_sha256 == hashlib.sha256(docs[row.doc_id].encode()).hexdigest()


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert bpe.decode(bpe.encode(empty, RANKS, P.PATTERN), RANKS).count() == 0
    assert packing.pack_documents(empty, JSON).count() == 0


def _check_pieces(pieces, docs, window):
    tokenizer = Tokenizer.from_file(JSON)
    tokenizer.encode_special_tokens = True
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    for doc_id, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        own = sorted(by_doc[doc_id], key=lambda p: p.start)
        assert b"".join(p.ids for p in own) == np.asarray(ids, "<u4").tobytes()
        assert [p.start for p in own] == np.cumsum([0, *[p.length for p in own]])[:-1].tolist()
        assert {p.doc_tokens for p in own} == {len(ids)}
    for own in by_sequence.values():
        own.sort(key=lambda p: p.offset)
        ends = np.cumsum([0, *[p.length for p in own]])
        assert [p.offset for p in own] == ends[:-1].tolist() and ends[-1] <= window
    return len(by_sequence)


def test_pieces_cover_awkward_documents(spark):
    rows = [r for i, r in enumerate(AWKWARD) if i != 3]  # the copy of document 3
    pieces = packing.pack_documents(awkward(spark, rows), JSON, block=3).collect()
    _check_pieces(pieces, [(i, t) for i, t, _, _ in rows], 1024)
    twice = packing.pack_documents(awkward(spark), JSON).where("doc_id = 3").collect()
    assert len(twice) == 2 and twice[0].ids == twice[1].ids


def test_packing_wastes_little(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    pieces = packing.pack_documents(docs, JSON).collect()
    sequences = _check_pieces(pieces, [(r.doc_id, r.text) for r in docs.collect()], 1024)
    tokens = sum(p.length for p in pieces)
    assert sequences <= -(-tokens // 1024) + 1
    row = QUERIES["op2_packing"](spark, SF).where("doc_id = 0 AND start = 0").first()
    first = next(p for p in pieces if p.doc_id == 0 and p.start == 0)
    assert row.ids_crc32 == zlib.crc32(first.ids)


def test_best_fit_takes_the_tightest_window():
    draw = random.Random(5)
    for _ in range(200):
        capacity = draw.randrange(4, 40)
        lengths = [draw.randrange(1, capacity + 1) for _ in range(draw.randrange(1, 40))]
        rooms, expected = [], {}
        for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
            fitting = [r for r in rooms if r >= lengths[i]]
            if fitting:
                rooms.remove(min(fitting))
                rooms.append(min(fitting) - lengths[i])
            else:
                rooms.append(capacity - lengths[i])
        placed = packing.best_fit_decreasing(lengths, capacity)
        for (window, _), length in zip(placed, lengths, strict=True):
            expected[window] = expected.get(window, capacity) - length
        assert sorted(expected.values()) == sorted(rooms)


def test_a_unit_is_encoded_when_it_is_first_met():
    vocabulary, asked = units.ByteLevel(JSON), []
    table = units.UnitMemo(lambda unit: asked.append(unit) or units.packed(vocabulary.ids_of_unit(unit)))
    texts = ["Uno dos, tres. dos dos", " élan vital!!\n dos tres", "", "x" * 100 + " dos, " + "x" * 100, "漢字 日本 ٣٤ dos"]
    for entries in (100, 3):
        for text in texts * 2:
            table = table.renewed(entries)
            (own,) = table.pack([text])
            assert np.frombuffer(own, "<u4").tolist() == vocabulary.encode([text])[0]
        if entries == 100:
            assert asked.count(" dos") == asked.count(" tres") == 1
        assert "x" * 100 not in table


def test_a_worker_keeps_the_tables_of_one_operator(texts):
    list(packing._unit_table(JSON).pack(texts))
    table = packing._unit_table(JSON)
    assert len(table) and packing._unit_table(JSON) is table  # the next task finds it
    left = weakref.ref(table)
    del table
    codec = bpe.codec(RANKS, P.PATTERN)
    gc.collect()
    assert left() is None and bpe.codec(RANKS, P.PATTERN) is codec
    left = weakref.ref(codec)
    del codec
    units.let_go()
    gc.collect()
    assert left() is None


@pytest.mark.parametrize("work", [lambda d: quality.statistics(d), lambda d: minhash._sets(d.withColumn("text_hash", F.xxhash64("text")), 5, 128)])
def test_operators_without_tables_free_those_of_others(spark, work):
    docs = spark.range(0, 64, 1, 8).select(F.col("id").alias("doc_id"), F.repeat(F.concat(F.lit("w"), "id", F.lit(" ")), 30).alias("text"))

    def probe(batches):
        for _ in batches:
            time.sleep(0.2)
            yield pa.RecordBatch.from_pydict({"pid": [os.getpid()], "held": [len(units._kept)]})

    def held():  # by worker: idle ones take turns, and the longest idle one is next
        found = spark.range(0, 16, 1, 16).mapInArrow(probe, "pid long, held long").collect()
        return {row.pid: row.held for row in found}

    packing.pack_documents(docs, JSON).count()
    assert any(held().values())
    for _ in range(4):
        work(docs).count()
    assert not any(held().values())

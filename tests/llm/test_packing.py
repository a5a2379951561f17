import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidewell.llm import packing

JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def check(pieces, ids, capacity):
    """Every id in one piece, sequences gapless and bounded; the share of padding."""
    by_doc, by_sequence = {}, {}
    for r in pieces:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for doc, own in by_doc.items():
        own.sort(key=lambda r: r["start"])
        at = 0
        for r in own:
            assert r["start"] == at and r["doc_tokens"] == len(ids[doc])
            assert zlib.crc32(ids[doc][at : at + r["length"]].tobytes()) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids[doc])
    pad = total = 0
    for own in by_sequence.values():
        own.sort(key=lambda r: r["offset"])
        at = 0
        for r in own:
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
        total += at
        pad += 0 if at & (at - 1) == 0 else capacity - at
    return pad / total


def test_pieces_against_the_tokenizer(spark, edges):
    rows = edges.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    model = Tokenizer.from_file(JSON)
    ids = {r["doc_id"]: np.array(model.encode(r["text"] or "", add_special_tokens=False).ids + [1], "<u4") for r in rows.collect()}
    assert 50256 in ids[7]
    for ranks in (None, RANKS):
        pieces = packing.pack(rows, JSON, ranks, with_ids=True).collect()
        assert {r["doc_id"] for r in pieces} == set(ids)
        assert check(pieces, ids, 2048) < 0.05
    assert all(np.array(r["ids"], "<u4").tobytes() == ids[r["doc_id"]][r["start"] : r["start"] + r["length"]].tobytes() for r in pieces)


def test_real_texts_encode_alike(spark, sf_dir):
    fast, model = packing.encoder(JSON, RANKS), Tokenizer.from_file(JSON)
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect():
        assert fast(r["text"]) == np.array(model.encode(r["text"], add_special_tokens=False).ids, "<u4").tobytes()


def test_repeated_rows_and_empty_tables(spark, edges, nothing):
    rows = packing.pack(edges, JSON, RANKS).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] == 2) == 2 * next(r["doc_tokens"] for r in rows if r["doc_id"] == 2)
    assert any(r["doc_id"] is None for r in rows)
    assert packing.pack(nothing, JSON).count() == 0


@given(st.integers(1, 10_000))
def test_cuts_cover_a_document(tokens):
    cuts = packing.cuts(tokens, 2048)
    assert sum(n for n, _ in cuts) == tokens
    assert all(2048 // (k + 1) < n <= 2048 // k for n, k in cuts)


@given(st.lists(st.integers(1, 5000), max_size=60))
def test_bins_of_any_lengths(lengths):
    packer = packing.Packer(2048, 0)
    ids = {i: np.arange(n, dtype="<u4") for i, n in enumerate(lengths)}
    rows = [r for i in ids for r in packer.add(i, ids[i].tobytes())] + packer.finish()
    pieces = [{"doc_id": d, "start": s, "length": len(b) // 4, "ids_crc32": zlib.crc32(b), "doc_tokens": t, "sequence_id": q, "offset": o, "class": k} for d, s, b, t, q, o, k in rows]
    if pieces:
        assert check(pieces, ids, 2048) <= 1 / packing.FINE_CLASS
    counts = {}
    for p in pieces:
        counts.setdefault((p["sequence_id"], p["class"]), []).append(p)
    assert all(len(own) == k for (_, k), own in counts.items() if k)


@pytest.mark.parametrize("tokens", [1, 2047, 2048, 2049, 4096])
def test_boundaries(tokens):
    assert sum(n for n, _ in packing.cuts(tokens, 2048)) == tokens


def test_ids_of_any_type(spark):
    docs = spark.createDataFrame([("a", "one two"), (None, "three"), ("a", None)], "doc_id string, text string")
    rows = packing.pack(docs, JSON).collect()
    assert {r["doc_id"] for r in rows} == {"a", None} and sum(r["length"] for r in rows) == sum({(r["doc_id"], r["doc_tokens"]): r["doc_tokens"] for r in rows}.values())

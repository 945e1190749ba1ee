from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallymart.llm import packing, token_files
from tallymart.sources.staging import scratch_path


@pytest.fixture(scope="module")
def ids_of():
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: np.array([*plain.encode(text or "", add_special_tokens=False).ids, 0], "<u4")


@pytest.mark.parametrize("unit", ["bit", "byte"])
@pytest.mark.parametrize("ids", [[0], [1, 2, 3], list(range(70_000, 70_050)), [2**32 - 1, 0, 5], []])
def test_planes_round_trip(unit, ids):
    ids = np.array(ids, "<u4")
    planes = token_files.split_planes(ids, unit)
    assert token_files.join_planes(planes, len(ids), unit).tolist() == ids.tolist()
    assert len(planes) <= (4 if unit == "byte" else 32)


@pytest.mark.parametrize("unit", ["bit", "byte"])
def test_token_files_hold_all_documents_in_order(spark, odd_docs, odd_texts, ids_of, unit):
    folder = scratch_path(spark, "ids")
    manifest = token_files.write_token_files(odd_docs, folder, unit=unit, block_ids=1000)
    found = sorted(token_files.read_token_files(manifest, unit).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in found] == sorted((i for i, _ in odd_texts if i is not None)) + [None, None]
    wanted = sorted((i is None, i or 0, ids_of(t).tobytes()) for i, t in odd_texts)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, bytes(r["ids"])) for r in found) == wanted
    starts = np.cumsum([0] + [len(r["ids"]) // 4 for r in found])
    assert [r["start"] for r in found] == starts[:-1].tolist()
    assert manifest.agg({"ids": "sum"}).first()[0] == starts[-1]


def test_token_files_of_no_documents(spark, no_docs):
    manifest = token_files.write_token_files(no_docs, scratch_path(spark, "ids"))
    assert token_files.read_token_files(manifest).collect() == []


def test_a_file_that_is_none_is_refused(tmp_path):
    (tmp_path / "x").write_bytes(b"0" * 40)
    with pytest.raises(ValueError, match="not a token file"):
        list(token_files.read_shard(str(tmp_path / "x"), "bit"))


@pytest.mark.parametrize(("bits", "n"), [(3, 2), (2, 3), (4, 3)])
def test_the_curve_visits_neighbours_one_after_another(bits, n):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * n, indexing="ij"), -1).reshape(-1, n)
    key = packing.hilbert_key(grid, bits)
    assert sorted(key.tolist()) == list(range(len(grid)))
    assert (np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("length", [64, 1024])
def test_every_id_lies_in_one_piece(odd_docs, odd_texts, ids_of, length):
    pieces = packing.pack(odd_docs, length).collect()
    documents: dict = {}
    for p in pieces:
        assert len(p["ids"]) == 4 * p["length"] > 0
        documents.setdefault((p["doc_id"], p["doc_tokens"]), []).append((p["start"], bytes(p["ids"])))
    got = sorted(zlib.crc32(b"".join(x for _, x in sorted(v))) for k, v in documents.items() if k[0] not in (9, None))
    assert got == sorted(zlib.crc32(ids_of(t).tobytes()) for i, t in odd_texts if i not in (9, None))
    assert sum(p["length"] for p in pieces) == sum(len(ids_of(t)) for _, t in odd_texts)
    sequences: dict = {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    sizes = []
    for own in sequences.values():
        ends = np.cumsum([0] + [n for _, n in sorted(own)])
        assert [o for o, _ in sorted(own)] == ends[:-1].tolist()
        sizes.append(ends[-1])
    assert sorted(sizes)[1:] == [length] * (len(sizes) - 1)  # only the last is padded


def test_equal_documents_are_neighbours(odd_docs):
    order = {}
    for p in packing.pack(odd_docs, 1 << 20).collect():
        order.setdefault(p["doc_id"], p["offset"])
    places = sorted((v, k) for k, v in order.items() if k is not None)
    names = [k for _, k in places]
    assert abs(names.index(7) - names.index(8)) == 1


def test_no_documents_give_no_sequences(no_docs):
    assert packing.pack(no_docs).collect() == []

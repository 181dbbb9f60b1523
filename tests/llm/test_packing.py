import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from leadframe.llm import packing
from leadframe.llm.packing import Encoder, best_fit_decreasing, matrix, pack, write_packed

VOCABULARY = open(packing.VOCABULARY, "rb").read()


@pytest.fixture(scope="module")
def coder():
    return Encoder(VOCABULARY)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\x1c\x1f\x85\xa0  a'sé1,."), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_stretches_encode_like_whole_texts(text):
    one = Encoder(VOCABULARY) if not hasattr(packing, "_one") else packing._one
    packing._one = one
    assert one.encode(text).tolist() == one.coder.encode_ordinary(text)


@given(st.lists(st.integers(1, 50), max_size=60))
def test_best_fit_decreasing(lengths):
    rows = best_fit_decreasing(lengths, 50)
    assert sorted(i for r in rows for i in r) == list(range(len(lengths)))
    free: list[int] = []
    for size in sorted(lengths, reverse=True):  # plain search for the tightest row
        fits = [f for f in free if f >= size]
        if fits:
            free.remove(min(fits))
            free.append(min(fits) - size)
        else:
            free.append(50 - size)
    assert sorted(50 - sum(lengths[i] for i in r) for r in rows) == sorted(free)


def rebuilt(rows, coder, kind="<u2"):
    parts = {}
    for r in rows:
        ids = np.frombuffer(r.input_ids, kind)
        assert r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens and r.position_resets == r.cu_seqlens[:-1]
        assert set(ids[r.n_tokens:].tolist()) <= {coder.end}
        for i, (doc, piece) in enumerate(zip(r.doc_ids, r.pieces)):
            parts.setdefault(doc, []).append((piece, ids[r.cu_seqlens[i]:r.cu_seqlens[i + 1]]))
    return {doc: np.concatenate([p for _, p in sorted(found, key=lambda x: x[0])]) for doc, found in parts.items()}


def test_round_trip(documents, texts, coder, tmp_path):
    packed = pack(documents, width=256, buffer_tokens=20_000)
    write_packed(packed, str(tmp_path / "packed"))
    rows = documents.sparkSession.read.parquet(str(tmp_path / "packed")).collect()
    back = rebuilt(rows, coder)
    assert {d: coder.decode(ids) for d, ids in back.items()} == texts
    assert all(ids[-1] == coder.end for ids in back.values())
    assert matrix(rows).shape == (len(rows), 256)
    assert sum(r.n_tokens for r in rows) > 0.97 * 256 * len(rows)


def test_odd_rows(odd, empty, coder):
    rows = pack(odd, width=64).collect()
    docs = [d for r in rows for d, p in zip(r.doc_ids, r.pieces) if p == 0]
    assert sorted(docs, key=str) == sorted([None, 2, 3, 4, 5, 6, 7, 7, 8, 9, 10], key=str)
    assert rebuilt(rows, coder)[2].tolist() == [coder.end]
    assert pack(empty).collect() == []
    with pytest.raises(ValueError):
        pack(odd, width=0)

import math

import numpy as np
import pytest

from glossmark.llm import dart_minhash, words


def documents(*sizes, seed=1):
    rnd = np.random.default_rng(seed)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return owner, words.mix(rnd.integers(0, 2**63, len(owner)).astype(np.uint64))


def test_short_documents_take_few_passes(monkeypatch):
    """A document of one element throws some 2,400 darts for it. With a pass of numpy over all documents for each of them, short documents cost
    more than long ones: 6,000 passes and more where 100 do."""
    passes, mix = [], words.mix
    monkeypatch.setattr(words, "mix", lambda x: passes.append(len(x)) or mix(x))
    owner, element = documents(*range(1, 65))
    passes.clear()
    assert (dart_minhash.signatures(owner, element, 64) != 0).all()
    assert len(passes) < 100 and sum(passes) < 64 * 20 * dart_minhash.COORDINATES


@pytest.mark.parametrize("size", [1, 4, 90, 400, 5000])
def test_documents_agree_by_their_similarity_at_every_size(size):
    n = 4 if size == 5000 else 100
    more = max(1, size // 4)
    owner, element = documents(*[size + more] * n)
    short = np.arange(len(owner)) % (size + more) < size
    a = dart_minhash.signatures(owner[short], element[short], n)
    b = dart_minhash.signatures(owner, element, n)
    exact = size / (size + more)
    assert abs((a == b).mean() - exact) < 5 * math.sqrt(exact * (1 - exact) / a.size)
    for k in range(1, n):
        assert (b[0] == b[k]).mean() < 0.02


def test_a_signature_is_of_its_document_alone(monkeypatch):
    owner, element = documents(1, 0, 40, 3000, 700, 2)
    together = dart_minhash.signatures(owner, element, 6)
    assert (together[1] == 0).all() and (np.delete(together, 1, 0) != dart_minhash.NONE).all()
    monkeypatch.setattr(dart_minhash, "AREAS_AT_ONCE", 50)
    for k in range(6):
        mine = element[owner == k][::-1]
        assert (dart_minhash.signatures(np.zeros(len(mine), np.int64), mine, 1)[0] == together[k]).all()
    monkeypatch.setattr(dart_minhash, "FIRST_DARTS", 20 * dart_minhash.COORDINATES)
    assert (dart_minhash.signatures(owner, element, 6) == together).all()
    assert dart_minhash.signatures(owner[:0], element[:0], 0).shape == (0, dart_minhash.COORDINATES)

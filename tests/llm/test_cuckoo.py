import hashlib

import numpy as np
import pytest

from beatline.llm.cuckoo import CuckooFilter, Full, halves


def keys(n, salt=""):
    return [hashlib.blake2b(f"{salt}{i}".encode(), digest_size=16).digest() for i in range(n)]


def test_members_survive_deletions_of_others():
    own, gone = keys(5000), keys(5000, "gone")
    f = CuckooFilter(10_000)
    f.add(halves(own + gone))
    f = CuckooFilter(state=f.state())
    assert f.contains(halves(own + gone)).all()
    f.remove(halves(gone))
    assert f.contains(halves(own)).all()
    assert f.contains(halves(gone)).mean() < 0.01
    assert f.contains(halves(keys(5000, "other"))).mean() < 0.01


def test_full():
    f = CuckooFilter(4)
    with pytest.raises(Full):
        f.add(halves(keys(200)))


def test_removing_all_leaves_nothing():
    own = halves(keys(3000))
    f = CuckooFilter(3000)
    f.add(own)
    f.remove(own)
    assert not np.any(f.cells)

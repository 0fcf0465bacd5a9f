import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from chatscope.operators.encoding import encode_tokens, make_hash_encoder, windows


@given(st.integers(0, 500), st.integers(1, 60), st.data())
def test_windows_cover_every_token_once(n, window, data):
    overlap = data.draw(st.integers(0, window - 1))
    got = windows(n, window, overlap)
    assert [i for _, _, a, b in got for i in range(a, b)] == list(range(n))
    for start, end, first, last in got:
        assert 0 <= start <= first <= last <= end <= n and end - start <= window
        assert start == 0 or first - start >= overlap // 2  # neighbours before the first vector taken
        assert end == n or end - last >= overlap // 2


def test_windows_change_nothing_that_the_overlap_covers(spark):
    rows = [("m", 1, "a b c " * 50, "x"), ("m", 2, None, "one two"), ("m", 3, " ", ""), ("n", 1, "w " * 7, "é ü")]
    pairs = spark.createDataFrame(rows, "model string, sample_id long, prediction string, reference string")
    want = {(m, i, s): make_hash_encoder()[1]([t.split()])[0] for m, i, p, r in rows for s, t in (("pred", p), ("ref", r))
            if t and t.split()}
    for window, overlap, batch in ((512, 128, 32), (6, 4, 2), (9, 2, 1)):
        got = {}
        for r in encode_tokens(pairs, make_hash_encoder, window=window, overlap=overlap, batch=batch).collect():
            got.setdefault((r.model, r.sample_id, r.side), {})[r.pos] = r.embedding
        assert got.keys() == want.keys()
        for k, v in want.items():
            assert sorted(got[k]) == list(range(len(v))) and np.allclose([got[k][i] for i in range(len(v))], v)
    with pytest.raises(ValueError, match="overlap"):
        encode_tokens(pairs, make_hash_encoder, window=4, overlap=4)

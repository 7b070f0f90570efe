import numpy as np
import pytest

from folioforge.llm import suffix_array as sa


def texts():
    rng = np.random.default_rng(3)
    yield np.array([], np.uint8)
    for letters in (1, 2, 3, 26, 250):
        for n in (1, 2, 3, 10, 200, 3000):
            yield rng.integers(0, letters, n).astype(np.uint8)
    piece = rng.integers(97, 123, 900).astype(np.uint8)
    yield np.concatenate([piece, piece[100:], [255], piece[:500], piece]).astype(np.uint8)
    yield np.tile(np.array([97, 98], np.uint8), 700)


@pytest.mark.parametrize("small", [2, 1024])
def test_against_sorting(monkeypatch, small):
    monkeypatch.setattr(sa, "SMALL_ALPHABET", small)
    for data in texts():
        order = sa.suffix_array(np.append(data.astype(np.int64) + 1, 0), 257)
        raw = data.tobytes()
        assert order.tolist() == [len(raw), *sorted(range(len(raw)), key=lambda i: raw[i:])]


def test_prefixes_against_comparison():
    for data in texts():
        if not len(data):
            continue
        raw = data.tobytes()
        order = sa.suffix_array(np.append(data.astype(np.int64) + 1, 0), 257)[1:]
        ends = np.array([min(len(raw), (i // 700 + 1) * 700) for i in range(len(raw))])
        room = ends - np.arange(len(raw))
        got = sa.permuted_prefixes(data, order, room)
        for a, b in zip(order[:-1].tolist(), order[1:].tolist()):
            n = 0
            while n < room[b] and a + n < len(raw) and b + n < len(raw) and raw[a + n] == raw[b + n]:
                n += 1
            assert got[b] == n, (a, b)

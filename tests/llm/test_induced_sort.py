import random

import numpy as np
import pytest

from ebbtide.llm import induced_sort as S


def plain(text, depth):
    data = [int(x) for x in text]
    order = sorted(range(len(data)), key=lambda i: data[i:])
    keys = [tuple(data[i : i + depth]) for i in order]

    def common(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    return keys, [0] + [common(a, b) for a, b in zip(keys, keys[1:])]


def strings():
    rnd = random.Random(11)
    for n, letters in [(1, 1), (2, 1), (5, 2), (60, 1), (300, 2), (300, 3), (500, 26), (900, 2), (1500, 4)]:
        yield [rnd.randint(2, 1 + letters) for _ in range(n)]
    block = [rnd.randint(2, 9) for _ in range(70)]
    yield (block + [1]) * 12
    yield sum(([*block[rnd.randint(0, 20) : rnd.randint(30, 70)], 1] for _ in range(40)), [])
    yield [2, 3] * 400 + [1] + [3, 2] * 300
    yield [5] * 200 + [1] + [5] * 150 + [4] + [5] * 90


@pytest.mark.parametrize("depth", [1, 7, 50])
@pytest.mark.parametrize("limits", [(8 << 20, 1 << 20, 1 << 16, 512), (64, 16, 32, 4)], ids=["memory", "disk"])
def test_against_plain_sorting(monkeypatch, depth, limits):
    for name, value in zip(("MEMORY_ENTRIES", "READ_ENTRIES", "BLOCK_ITEMS", "SMALL"), limits):
        monkeypatch.setattr(S, name, value)
    for chars in strings():
        text = np.array([*chars, 0], np.uint16)
        order, prefix = S.suffix_order(text, depth)
        assert sorted(order.tolist()) == list(range(len(text)))
        keys, common = plain(text, depth)
        assert [tuple(text[i : i + depth].tolist()) for i in order] == keys
        assert prefix.tolist() == common


def test_queue_keeps_order_on_disk(monkeypatch):
    monkeypatch.setattr(S, "MEMORY_ENTRIES", 10)
    monkeypatch.setattr(S, "READ_ENTRIES", 7)
    queues = S.Queues(np.int64)
    for i in range(0, 60, 3):
        queues.push(i % 2, np.arange(i, i + 3))
    got = []
    for part in queues.pop(1):
        got += part.tolist()
        if len(got) < 20:
            queues.push(1, np.array([1000 + len(got)]))
    assert [x for x in got if x < 1000] == [x for i in range(3, 60, 6) for x in range(i, i + 3)]
    assert got[-1] >= 1000 and not queues.held.get(1)

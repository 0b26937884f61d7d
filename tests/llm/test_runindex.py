import random

import numpy as np
import pytest

from folioframe.llm.runindex import RunIndex


def index_of(texts, depth, value):
    return RunIndex(np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts], np.int64), depth, np.array(value, np.int64))


def stream(index, texts):
    return index.stream(np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts], np.int64))


@pytest.mark.parametrize("seed", range(24))
def test_stream(seed):
    """Texts of the index and others: all strings that it has are found, with a true place and the least value."""
    rnd = random.Random(seed)
    depth = rnd.choice([7, 8, 13, 20, 50])
    base = bytes(rnd.randrange(256) if seed % 3 else rnd.choice(b"ab\x00") for _ in range(90))

    def some(n, odd):
        texts = []
        for _ in range(n):
            a = rnd.randrange(0, 90 - depth)
            t = bytearray(base[a : rnd.randrange(a + depth, min(91, a + depth + 30))])
            if rnd.random() < odd:
                t[rnd.randrange(len(t))] = rnd.randrange(256)
            texts.append(bytes(t))
        return texts

    texts = some(rnd.randrange(1, 40), 0.4)
    value = [rnd.randrange(100) for _ in texts]
    index = index_of(texts, depth, value)
    least = {}
    for t, v in zip(texts, value, strict=True):
        for i in range(len(t) - depth + 1):
            least[t[i : i + depth]] = min(least.get(t[i : i + depth], 999), v)
    for asked in (texts, [*some(30, 0.7), b"", b"short", bytes(range(256)), base]):
        of, offset, place, low = (x.tolist() for x in stream(index, asked))
        assert sorted(zip(of, offset, low, strict=True)) == sorted((k, i, least[t[i : i + depth]]) for k, t in enumerate(asked) for i in range(len(t) - depth + 1) if t[i : i + depth] in least)
        for k, i, p in zip(of, offset, place, strict=True):
            owner = int(index.owner[p])
            at = p - int(index.starts[owner])
            assert texts[owner][at : at + depth] == asked[k][i : i + depth]


def test_runs_are_few_where_texts_repeat():
    text = bytes(random.Random(1).choice(b"abcdefgh") for _ in range(80))
    index = index_of([text] * 500, 50, [0] * 500)
    assert len(index.heads) <= 82
    assert not hasattr(index, "order")


def test_empty_index_and_small_depth():
    assert not len(stream(index_of([], 50, []), [b"x" * 60])[0])
    assert not len(stream(index_of([b"y" * 60], 50, [1]), [])[0])
    with pytest.raises(ValueError):
        index_of([], 3, [])

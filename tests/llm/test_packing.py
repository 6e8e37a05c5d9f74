import random

import numpy as np
import pytest

from quillspark.llm import packing as p


def plain(sizes, capacity):
    """The rule, step by step over all open containers."""
    left, out = [], []
    for s in sizes:
        if s == 0 and any(left):
            out.append(None)
            continue
        best = None
        for g in [*sorted({x for x in left if x >= max(s, 1)}), None]:
            gaps = [x for x in left if x > 0]
            if g is None:
                gaps.append(capacity - s)
            else:
                gaps.remove(g)
                gaps.append(g - s)
            n = {x: gaps.count(x) for x in gaps if x > 0}
            cost = sum(v * v for v in n.values())
            if best is None or cost < best[0]:
                best = (cost, g)
        g = best[1]
        if g is None:
            left.append(capacity - s)
            out.append(capacity)
        else:
            left[left.index(g)] -= s
            out.append(g)
    return out, left


@pytest.mark.parametrize("seed", range(4))
def test_rule(seed):
    r = random.Random(seed)
    sizes = [r.randint(1, 20) for _ in range(200)]
    got = p.pack(np.array(sizes), 20)
    _, left = plain(sizes, 20)
    fill = np.bincount(got, weights=sizes)
    assert sorted(20 - fill) == sorted(left)


def test_documents(spark):
    docs = [(k, ("word " * (k % 90)).strip()) for k in range(300)] + [(1000, "many words here " * 900), (1001, None), (None, "lost"), (1002, ""), (5, "word " * 5)]
    df = spark.createDataFrame([(i, t, 1, "piece") for i, t in docs], "doc_id bigint, text string, n_tokens int, piece string")
    got = p.documents_packed(df, capacity=100).collect()
    fill, pieces = {}, {}
    for r in got:
        fill[r["container"]] = fill.get(r["container"], 0) + r["n_tokens"]
        pieces.setdefault(r["doc_id"], []).append((r["first_token"], r["n_tokens"]))
    assert max(fill.values()) <= 100
    assert set(pieces) == {*range(300), 1000, 1002}
    with open(p.TOKENIZER, "rb") as f:
        count = p.token_counter(f.read())
    for i, t in docs:
        if i is not None and t is not None and i != 5:
            parts = sorted(pieces[i])
            assert sum(n for _, n in parts) == count(t)
            assert len(parts) == max(1, -(-count(t) // 100))
            assert all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:], strict=False))
    total = sum(fill.values())
    assert len(fill) <= 1.05 * total / 100 + 2
    assert p.documents_packed(df.limit(0), capacity=100).count() == 0

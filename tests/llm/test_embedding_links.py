"""Links of the embedding search counted for both ends, against brute force, on vectors of few effective dimensions."""

import numpy as np
import pytest


def frame(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "vec_id long, embedding array<float>")


def brute(x):
    x = x.astype(np.float32).astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    return near


@pytest.mark.parametrize("dims, within, n", [(3, 3, 1500), (8, 64, 1500), (64, 64, 1200)])
def test_links_from_both_ends(spark, dims, within, n):
    from moundlake.llm.pq_dedup import near_copies
    rng = np.random.default_rng(dims)
    centres = rng.normal(size=(60 if dims > 3 else 400, dims))
    low = centres[rng.integers(0, len(centres), n)] + rng.normal(size=(n, dims)) * (0.22 if dims < 64 else 0.17)
    x = (low @ np.linalg.qr(rng.normal(size=(within, within)))[0][:dims] if within > dims else low).astype(np.float32)
    near = brute(x)
    assert near.sum() > n  # there is something to find
    rows = {r.vec_id: r for r in near_copies(frame(spark, x)).collect()}
    wrong = [i for i in range(n) if rows[i].n_links != near[i].sum()]
    # pairs at the very threshold may fall on either side in another summation order
    assert len(wrong) <= n // 500
    seen, component = set(), {}
    for i in range(n):
        if i in seen:
            continue
        todo, group = [i], set()
        while todo:
            k = todo.pop()
            if k not in group:
                group.add(k)
                todo += [int(j) for j in np.flatnonzero(near[k]) if j not in group]
        seen |= group
        component.update(dict.fromkeys(group, min(group)))
    assert sum(rows[i].component_id != component[i] for i in range(n)) == 0

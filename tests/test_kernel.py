"""The batch helper against brute force, without Spark."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from recallset.operators import kernel
from recallset.operators.kernel import Queries, code_matrix, nearest_in_batches
from recallset.operators.quantize import closest_lists, encode, unit_rows


def brute_distance(a, b):
    dot = aa = bb = 0.0
    for x, y in zip(a, b):
        dot, aa, bb = dot + x * y, aa + x * x, bb + y * y
    return 1.0 - min(1.0, max(-1.0, dot / np.sqrt(aa * bb)))


def brute(rows, queries, before):
    out = []
    for q_id, qv, limit, key, q_ord in queries:
        found = [
            (brute_distance(v, qv), *((o,) if before else ()), id_, doc_key)
            for doc_key, id_, v, k, o in rows
            if (key is None or key == k) and (not before or o < q_ord)
        ]
        out += [(q_id, i, f[0], f[-1]) for i, f in enumerate(sorted(found)[:limit])]
    return out


def run(rows, queries, before, batch_rows, strict=True, kind=pa.float64()):
    d = len(rows[0][2])
    block = Queries(
        pa.array([q[0] for q in queries]),
        np.array([q[1] for q in queries], dtype=float),
        np.array([q[2] for q in queries]),
        [pa.array([q[3] for q in queries], pa.string())],
        np.array([q[4] for q in queries]) if before else None,
    )
    table = pa.table(
        {
            "doc_key": [r[0] for r in rows],
            "id": [r[1] for r in rows],
            "vector": pa.array([r[2] for r in rows], pa.list_(kind)),
            "key": pa.array([r[3] for r in rows], pa.string()),
            "ord": [r[4] for r in rows],
        }
    )
    batches = table.to_batches(batch_rows)
    found = list(nearest_in_batches(batches, block, d, ["key"], "ord" if before else None, strict))
    got = pa.Table.from_batches(found).to_pylist() if found else []
    ties = (lambda r: (r["ord"], r["id"])) if before else (lambda r: (r["id"],))
    got.sort(key=lambda r: (r["q_id"], r["distance"], *ties(r), r["doc_key"]))
    out, seen = [], {}
    for r in got:
        n = seen.get(r["q_id"], 0)
        seen[r["q_id"]] = n + 1
        out.append((r["q_id"], n, r["distance"], r["doc_key"]))
    return out


coordinate = st.sampled_from([-1.0, 0.0, 0.5, 1.0, 2.0])
vector = st.lists(coordinate, min_size=3, max_size=3).filter(any)
key = st.sampled_from(["a", "b", "c", None])


@settings(max_examples=150, deadline=None)
@given(
    st.lists(st.tuples(vector, key, st.integers(0, 9)), min_size=1, max_size=60),
    st.lists(st.tuples(vector, st.integers(1, 5), key, st.integers(0, 9)), min_size=1, max_size=6),
    st.booleans(),
    st.integers(1, 70),
    st.sampled_from([kernel.CROWD, -1000]),
)
def test_equals_brute_force(rows, queries, before, batch_rows, crowd):
    """Few distinct vectors, so most distances are ties and most rows copies, which are thinned or not."""
    kernel.CROWD = crowd
    rows = [(f"k{i}", f"id{i % 7}", v, k, o) for i, (v, k, o) in enumerate(rows)]
    queries = [(i, v, n, k, o) for i, (v, n, k, o) in enumerate(queries)]
    assert run(rows, queries, before, batch_rows) == sorted(brute(rows, queries, before))


@pytest.mark.parametrize("kind", [pa.float32(), pa.float64()])
@pytest.mark.parametrize("scale", [1.0, 1e-25, 1e30])
def test_any_magnitude(kind, scale):
    rng = np.random.default_rng(5)
    vectors = (rng.normal(size=(300, 8)) * scale).astype(kind.to_pandas_dtype())
    rows = [(f"k{i:03d}", f"id{i:03d}", [float(x) for x in v], "a", i) for i, v in enumerate(vectors)]
    queries = [(j, rows[j * 7][2], 6, "a", 0) for j in range(9)]
    assert run(rows, queries, False, 64, kind=kind) == sorted(brute(rows, queries, False))


def test_many_batches_and_near_ties():
    rng = np.random.default_rng(1)
    base = rng.normal(size=(5, 16))
    rows = [
        (f"k{i:05d}", f"id{i:05d}", list(base[i % 5] + rng.normal(size=16) * 1e-7), "a", i) for i in range(3000)
    ]
    queries = [(j, list(base[j] * 3), 10, "a", 1500) for j in range(5)]
    for before in (False, True):
        assert run(rows, queries, before, 100) == sorted(brute(rows, queries, before))


def test_a_zero_vector_fails_or_is_left_out():
    rows = [("k0", "a", [0.0, 0.0], "x", 0), ("k1", "b", [1.0, 0.0], "x", 0), ("k2", "c", [0.0, 0.0], "y", 0)]
    query = [(1, [1.0, 1.0], 5, "x", 0)]
    with pytest.raises(ValueError, match="not a finite number"):
        run(rows, query, False, 10)
    assert [r[3] for r in run(rows, query, False, 10, strict=False)] == ["k1"]
    # A row the filter leaves out does not matter.
    assert [r[3] for r in run(rows[1:], query, False, 10)] == ["k1"]
    with pytest.raises(ValueError, match="query vector"):
        run(rows[1:], [(1, [0.0, 0.0], 5, "x", 0)], False, 10)


def test_codes_are_the_nearest_of_256_levels():
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(200, 8))
    vectors[:, 3] = 0.0
    column = pa.array([list(v) for v in vectors])
    unit, usable = unit_rows(column, 8)
    assert usable.all()
    low, high = unit.min(axis=0), unit.max(axis=0)
    codes = encode(column, low, high)
    assert all(len(c) == 8 and c[3] == 0 for c in codes.to_pylist())
    decoded = code_matrix(codes, low, high)
    assert np.abs(decoded - unit).max() <= ((high - low) / 255 / 2).max() + 1e-12
    assert code_matrix(codes.slice(50, 20), low, high).tolist() == decoded[50:70].tolist()


def test_closest_lists_equal_brute_force():
    rng = np.random.default_rng(3)
    centroids = np.concatenate([rng.normal(size=(6, 4)), np.ones((2, 4))])
    vectors = np.concatenate([rng.normal(size=(50, 4)), np.ones((1, 4)) * 2, np.zeros((1, 4))])
    found, usable = closest_lists(pa.array([list(v) for v in vectors]), centroids, 3)
    assert usable.tolist() == [True] * 51 + [False]
    for v, lists in zip(vectors[:51], found[:51]):
        want = sorted(range(8), key=lambda c: (brute_distance(v, centroids[c]), c))[:3]
        assert lists.tolist() == want

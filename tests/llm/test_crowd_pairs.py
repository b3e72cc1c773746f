"""Pairs of a crowd are found once, however many shingles they share, and compared on sets sent to their blocks."""

import numpy as np
import pyarrow as pa

from sectoria.llm import chosen_path


def ran(work, rows, names, cuts):
    """Rows that ``work`` makes of ``rows``, given in several batches."""
    columns = [pa.array(list(c)) for c in zip(*rows, strict=True)]
    whole = pa.RecordBatch.from_arrays(columns, names=names)
    edges = [0, *cuts, len(rows)]
    batches = [whole.slice(a, b - a) for a, b in zip(edges, edges[1:])]
    return [tuple(r.values()) for b in work(iter(batches)) for r in b.to_pylist()]


def test_members_that_meet_under_many_shingles_are_one_pair():
    """Fifty shingles, under each another company: before, every one of them was sent the whole sets of its members."""
    near, far = np.zeros(16, dtype=np.uint64), np.full(16, (1 << 64) - 1, dtype=np.uint64)
    rows = []
    for node in range(50):
        rows += [(node, 9, 1, 400, near.tobytes()), (node, 4, 2, 400, near.tobytes()), (node, 5, 2, 400, near.tobytes())]
        rows.append((node, 100 + node, 100 + node, 400, far.tobytes()))
    names = ["node", "rep", "component", "n", "parity"]
    found = ran(chosen_path._possible(80), rows, names, [1, 70, 71, 199])
    assert len(found) == 100 and set(found) == {(4, 9), (5, 9)}
    assert ran(chosen_path._possible(80), rows[:1], names, []) == []


def test_pairs_of_a_block_are_confirmed_on_whole_sets():
    base = np.arange(100, dtype=np.uint64)
    sets = {1: [base], 2: [base[:80]], 3: [base[:79]], 4: [base + np.uint64(1000), base[5:]], 5: [base[:80]]}
    rows = [(0, 1, rep, None, s.tobytes()) for rep, those in sets.items() for s in those]
    rows += [(0, 1, 1, 2, None), (0, 1, 1, 3, None), (0, 1, 1, 4, None), (0, 1, 1, 5, None), (0, 1, 2, 5, None)]
    # Another pair of blocks begins anew.
    rows += [(1, 1, 2, None, base[:80].tobytes()), (1, 1, 5, None, base[:80].tobytes()), (1, 1, 2, 5, None)]
    wanted = [(1, 2), (1, 4), (1, 5), (2, 5)]  # 2 and 5 of the first blocks are connected by 1 already
    for cuts in ([], [1, 3, 8], list(range(1, len(rows)))):
        assert ran(chosen_path._compare_pairs(80), rows, ["row_block", "head_block", "a", "b", "shingles"], cuts) == wanted

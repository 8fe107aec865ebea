"""Nearest-neighbour imputation against a plain all-pairs version."""

import math
import random

import pytest

from propensity.operators import knn

COLS = list("abcd")


def brute(rows, k):
    lv = [sorted({r[i] for r in rows} - {None}) for i in range(4)]
    code = [[None if v is None else lv[i].index(v) for i, v in enumerate(r)] for r in rows]
    out = []
    for i, r in enumerate(code):
        filled = list(rows[i])
        for t in (t for t in range(4) if r[t] is None):
            near = []
            for q in code:
                both = [j for j in range(4) if r[j] is not None and q[j] is not None]
                if q[t] is not None and both:
                    near.append((sum((r[j] - q[j]) ** 2 for j in both) * 12 // len(both), q[t]))
            near = sorted(near)[:k]
            seen = [q[t] for q in code if q[t] is not None]
            if not seen:
                continue
            if not near:
                mean = sum(seen) / len(seen)
            elif near[0][0] == 0:
                mean = sum(c for d, c in near if d == 0) / sum(d == 0 for d, _ in near)
            else:
                mean = sum(c / math.sqrt(d) for d, c in near) / sum(1 / math.sqrt(d) for d, _ in near)
            filled[t] = lv[t][int(round(mean, 9))]
        out.append(tuple(filled))
    return out


@pytest.mark.parametrize("stages", [knn.STAGES, ((1, None),), ((2, 0), (1, 1), (1, None))])
def test_equal_to_all_pairs(spark, stages):
    rng = random.Random(4)
    rows = [tuple(rng.choice("abcdefgh"[:m]) if rng.random() > .25 else None for m in (3, 5, 8, 2)) for _ in range(150)]
    rows += [rows[0]] * 20 + [(None,) * 4] * 2 + [(None, None, "h", None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, a string, b string, c string, d string")
    got = dict((r[0], tuple(r[1:])) for r in knn.impute_knn(df, COLS, k=3, stages=stages).collect())
    assert [got[i] for i in range(len(rows))] == brute(rows, 3)


def test_column_without_values_and_empty_table(spark):
    df = spark.createDataFrame([("x", None), (None, None), ("x", None)], "a string, b string")
    assert sorted(tuple(r) for r in knn.impute_knn(df, ["a", "b"]).collect()) == [("x", None)] * 3
    assert knn.impute_knn(df.where("a = 'q'"), ["a", "b"]).count() == 0
    with pytest.raises(ValueError):
        knn.code_patterns(df, [str(i) for i in range(9)])


def test_each_pair_of_masks_has_one_key_of_common_columns():
    spread = {(0,): 5, (1,): 3, (2,): 9, (0, 1): 12, (0, 2): 30, (1, 2): 20}
    masks = {0b111: 1000, 0b011: 300, 0b110: 5, 0b100: 2}
    got = knn._subsets(masks, spread, 2, fewest=False)
    assert all(set(key) <= {i for i in range(3) if (rm & dm) >> i & 1} and key for (rm, dm), (_, key) in got.items())
    assert (0b011, 0b100) not in got and got[0b110, 0b111] == (0b111, (1, 2)) and got[0b011, 0b110] == (-1, (1,))


def test_blocks_cut_into_parts_and_wide_cells(spark, monkeypatch):
    """Dense blocks are dealt to several tasks, and columns with many levels share cells, with the same neighbours."""
    for name, value in (("DONORS", 3), ("RECEIVERS", 2), ("HELD", 7), ("CELLS", 3), ("PER_BLOCK", 1)):
        monkeypatch.setattr(knn, name, value)
    rng = random.Random(9)
    rows = [tuple(rng.choice("abcdefghijkl"[:m]) if rng.random() > .2 else None for m in (2, 12, 7, 3)) for _ in range(90)] + [("a", "b", "c", None)] * 3
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, a string, b string, c string, d string")
    got = dict((r[0], tuple(r[1:])) for r in knn.impute_knn(df, COLS, k=4).collect())
    assert [got[i] for i in range(len(rows))] == brute(rows, 4)

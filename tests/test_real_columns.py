"""multi_hot and before_after on columns that differ, against brute force over every row."""

import pyarrow.parquet as pq

from lexmill.operators.projection import ENTITY_LABELS
from lexmill.plans import queries as plans
from test_recovery import _rewriting


def _rows(small):
    return pq.read_table(f"{small}/rewrite_output.parquet").to_pylist()


def test_multi_hot_of_entity_types(spark, small):
    want = sorted((r["row_id"], *(int(bool((r["medical_entities"] or {}).get(k))) for k in ENTITY_LABELS)) for r in _rows(small))
    assert sorted(map(tuple, plans.queries()["multi_hot"](spark, small).collect())) == want and any(any(h) for _, *h in want)


def test_before_after_of_rewritten_text(spark, small):
    want = {}
    for r in _rows(small):
        a, b = r["text"], (_rewriting(r["output"]) or [None])[0] if r["output"] is not None else None
        if a is None or b is None:
            continue
        every = {x for v in (r["medical_entities"] or {}).values() for x in v or [] if x}
        one = lambda t: sum(len(t) - len(t.replace(e, "")) for e in every) / len(t) if t else 0.0  # noqa: E731, B023
        want[r["row_id"]] = (len(b) / len(a) if a and b else None, len(b.split()) / len(a.split()) if a.split() else None, one(b) - one(a) if r["medical_entities"] is not None else None)
    got = {r.row_id: (r.char_ratio, r.word_ratio, r.density_diff) for r in plans.queries()["before_after_rewritten"](spark, small).collect()}
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert all((x is None and y is None) or abs(x - y) < 2e-5 for x, y in zip(got[k], v, strict=True))
    assert len({v[1] for v in got.values()}) > 1 and len({v[2] for v in got.values()}) > 1

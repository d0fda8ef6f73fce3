"""Model outputs that are not strict JSON, against brute force in Python over every row."""

import json
import re

import pyarrow as pa
import pyarrow.parquet as pq

from lexmill.functions.text import LINE_END
from lexmill.plans import queries as plans
from oracle import rows

OBJECT = re.compile(r"\{(?:[^{}]|\{(?:[^{}]|\{[^{}]*\})*\})*\}")
HEADER = re.compile(r"^[ \t]*#{1,6}[ \t]*conversation\b[^\n\r]*", re.I | re.M)


def _rewriting(output):
    try:
        v = json.loads(output)
    except ValueError:
        found = OBJECT.findall(output.partition("assistantfinal")[2].lstrip() if "assistantfinal" in output else output)
        try:
            v = json.loads(found[-1]) if found else None
        except ValueError:
            v = None
    if not isinstance(v, dict) or not isinstance(v.get("rewritten_text"), str) or not isinstance(v.get("title"), str | None):
        return None
    return v["rewritten_text"], v.get("title")


def _dialogue(output):
    lines = re.split(LINE_END, HEADER.split(output, maxsplit=1)[-1])
    return "\n".join(x for x in lines if x.strip()).strip()


def _same(df, want):
    import pandas as pd

    assert rows(df.toPandas()) == rows(pd.DataFrame(want, columns=df.columns))


def test_rewriting_of_every_row(spark, small):
    table = pq.read_table(f"{small}/rewrite_output.parquet", columns=["row_id", "output"]).to_pylist()
    want = [(r["row_id"], *got) for r in table if r["output"] is not None and (got := _rewriting(r["output"]))]
    _same(plans.queries()["rewriting_extract"](spark, small), want)
    assert len(want) > sum(r["output"] is not None and r["output"].startswith("{") and r["output"].endswith("}") for r in table)


def test_rewriting_fixtures(spark, tmp_path):
    good = '{"is_rewritable": true, "rewritten_text": "a b", "title": "t"}'
    outputs = [good, f"```json\n{good}\n```", f'analysis {{"rewritten_text": "no"}} assistantfinal{good}', f"{good}\nEnd.", good[:-9], '{"rewritten_text": 3}', None, "", "prose"]
    pq.write_table(pa.table({"row_id": range(len(outputs)), "output": outputs}), tmp_path / "rewrite_output.parquet")
    _same(plans.queries()["rewriting_extract"](spark, str(tmp_path)), [(i, "a b", "t") for i in range(4)])


def test_dialogue_of_every_row(spark, small, tmp_path):
    table = pq.read_table(f"{small}/generate_output.parquet", columns=["row_id", "output"])
    more = ["Intro\n\n## Conversation: x\n\nA: b\n\nB: c\n", "a conversation without header\n\nb", "# conversation\r\nA: b", None, ""]
    table = pa.concat_tables([table, pa.table({"row_id": range(10**9, 10**9 + len(more)), "output": more}, schema=table.schema)])
    pq.write_table(table, tmp_path / "generate_output.parquet")
    _same(plans.queries()["dialogue_extract"](spark, str(tmp_path)), [(r["row_id"], None if r["output"] is None else _dialogue(r["output"])) for r in table.to_pylist()])

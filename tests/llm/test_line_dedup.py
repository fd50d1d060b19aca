from __future__ import annotations

from collections import Counter

from helpers import docs, edges, empty

from starmill.llm import line_dedup


def brute(rows, ratio=0.1, least=10):
    total = Counter(r[3] for r in rows)
    blank = " \t\n\r\x0b\x0c"
    seen = Counter((r[3], k) for r in rows for k in {line.strip(blank) for line in (r[1] or "").split("\n")} if k)
    heavy = {(h, k) for (h, k), n in seen.items() if n > 1 and total[h] >= least and n / total[h] > ratio}
    return {r[0]: None if r[1] is None else "\n".join(x for x in r[1].split("\n") if (r[3], x.strip(blank)) not in heavy) for r in rows}


def test_same_as_counting_in_memory(spark):
    rows = []
    for k in range(300):
        host = "hot" if k % 3 == 0 else f"h{k % 7}" if k % 11 else None
        lines = [f"own line {k}", "Menu" if k % 2 else " Menu ", "", "  ", f"shared {k % 40}", f"own line {k}"]
        rows.append((k, "\n".join(lines), "en", host))
    rows.append((1000, None, "en", "hot"))
    rows.append((1001, "Menu", "en", "small host"))
    made = {r.doc_id: r.text for r in line_dedup.drop_lines(docs(spark, rows)).collect()}
    assert made == brute(rows)
    assert made[1001] == "Menu"
    assert "Menu" not in made[0]


def test_a_large_list_is_joined_without_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BROADCAST_LINES", 0)
    rows = [(k, f"Menu\nown {k}", "en", f"h{k % 2}") for k in range(60)]
    made = {r.doc_id: r.text for r in line_dedup.drop_lines(docs(spark, rows)).collect()}
    assert made == brute(rows)


def test_no_python_in_the_plan(spark):
    plan = line_dedup.drop_lines(docs(spark, [(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_edge_cases(spark):
    table = edges(spark)
    made = line_dedup.drop_lines(table)
    assert made.columns == table.columns
    assert sorted(made.collect(), key=str) == sorted(table.collect(), key=str)
    assert line_dedup.drop_lines(empty(spark)).collect() == []


def test_a_page_may_lose_all_lines(spark):
    rows = [(k, "Menu", "en", "h") for k in range(20)]
    assert {r.text for r in line_dedup.drop_lines(docs(spark, rows)).collect()} == {""}

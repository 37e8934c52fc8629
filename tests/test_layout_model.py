"""Random copybooks against a plain model that lays out storage byte by byte of the tree."""

import random

import pytest

from fixedrecon.operators.layout import parse_copybooks
from tests.test_layout import lines_of


def random_book(draw):
    """(level, name, width or None, occurs, redefined name or None) of a record or two."""
    entries, names = [], ["A", "B", "FILLER", "A-01", "FILLER", "C", "B-02", "D"]
    for _ in range(draw.choice([0, 1, 1, 2])):
        entries.append((1, "R", None, 1, None))
        for _ in range(draw.randrange(1, 14)):
            level = draw.choice([5, 5, 10, 10, 15, 20])
            width = draw.choice([None, None, 1, 2, 5])
            occurs = draw.choice([1, 1, 1, 2, 3])
            seen = [e[1] for e in entries]
            redefined = draw.choice([None, None, draw.choice([*seen, "NONE"])])
            entries.append((level, draw.choice(names), width, occurs, redefined))
    return entries


def render(entries):
    out = []
    for level, name, width, occurs, redefined in entries:
        clauses = (f" REDEFINES {redefined}" if redefined else "") + (f" PIC X({width})" if width else "") + (f" OCCURS {occurs}" if occurs > 1 else "")
        out.append(f"       {level:02d} {name}{clauses}.")
    return "\n".join(out)


def model(entries):
    """Rows (record, line, indices, name, start, length) in storage order."""
    rows, record, open_groups = [], 0, []
    nodes = []
    for line, (level, name, width, occurs, redefined) in enumerate(entries, 1):
        if level == 1:
            record, open_groups = record + 1, []
        open_groups = [n for n in open_groups if n["level"] < level]
        above = [n for n in open_groups if n["width"] is None]
        clean = name.replace("-", "_")
        target = next((n for n in nodes if n["record"] == record and redefined and n["name"] == redefined.replace("-", "_")), None)
        node = {"line": line, "level": level, "name": clean, "width": width, "occurs": occurs, "target": target, "record": record,
                "chain": above, "children": [], "parent": above[-1] if above else None}
        if above:
            above[-1]["children"].append(node)
        nodes.append(node)
        open_groups.append(node)

    def size(n):
        return n["width"] if n["width"] else sum(c["occurs"] * size(c) for c in n["children"] if not c["target"])

    def start(n, index):
        """0-based start of the occurrence with these indices by line; others are the first."""
        own = index.get(n["line"], 0) * size(n)
        if n["target"]:
            t = n["target"]
            shared = {a["line"]: index.get(a["line"], 0) for a in t["chain"] + [t] if a in n["chain"]}
            return start(t, shared) + own
        siblings = n["parent"]["children"] if n["parent"] else [m for m in nodes if m["record"] == n["record"] and not m["parent"]]
        before = sum(s["occurs"] * size(s) for s in siblings if s["line"] < n["line"] and not s["target"])
        return (start(n["parent"], index) if n["parent"] else 0) + before + own

    def indices(chain):
        if not chain:
            return [()]
        return [(i, *rest) for i in range(chain[0]["occurs"]) for rest in indices(chain[1:])]

    for n in nodes:
        chain = [*n["chain"], n]
        for index in indices(chain):
            lines = [a["line"] for a in chain]
            name = n["name"] + "".join(f"_{i + 1:02d}" for a, i in zip(chain, index) if a["occurs"] > 1)
            path = [x for pair in zip(lines, index) for x in pair]
            length = size(n) if n["occurs"] > 1 and not n["width"] else n["width"] or 0
            rows.append([n["record"], path, name, start(n, dict(zip(lines, index))) + 1, length, bool(n["target"] or any(a["target"] for a in n["chain"]))])
    rows.sort(key=lambda r: (r[0], r[1]))
    taken = {}
    for r in rows:
        taken[r[0], r[2]] = again = taken.get((r[0], r[2]), 0) + 1
        r[2] += f"_{again}" if again > 1 else ""
    return [tuple(map(str, r)) for r in rows]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_copybooks_equal_the_model(spark, seed):
    draw = random.Random(seed)
    books = {f"b{i}": random_book(draw) for i in range(150)}
    table = parse_copybooks(lines_of(spark, **{k: render(b) for k, b in books.items()}))
    columns = ["record_no", "occ_path", "field_name", "start_pos", "length", "in_redefinition"]
    found = {k: [] for k in books}
    for r in table.orderBy("copybook_id", "record_no", "occ_path").collect():
        found[r.copybook_id].append(tuple(str(r[c]) for c in columns))
    for k, book in books.items():
        assert found[k] == model(book), render(book)


def test_occurrences_in_runs(spark):
    """More occurrences than are made at a time, in a group that redefines another."""
    text = "       01 R.\n       05 A PIC X(2).\n       05 G OCCURS 99.\n       10 H OCCURS 99.\n       15 I PIC X(3).\n       05 B REDEFINES G PIC X."
    rows = parse_copybooks(lines_of(spark, book=text)).collect()
    starts = sorted(r.start_pos for r in rows if r.base_name == "I")
    assert starts == [3 + 3 * i for i in range(99 * 99)]
    assert [r.start_pos for r in rows if r.base_name == "B"] == [3]


def test_a_long_copybook(spark):
    """A thousand entries with one name, and a chain of redefinitions as long."""
    text = "       01 R.\n" + "".join(f"       05 FILLER PIC X({i % 3 + 1}).\n" for i in range(600))
    text += "       05 X0 PIC X(4).\n" + "".join(f"       05 X{i + 1} REDEFINES X{i} PIC X(2).\n" for i in range(400)) + "       05 LAST-ONE PIC X."
    rows = {r.field_name: r.start_pos for r in parse_copybooks(lines_of(spark, book=text)).collect()}
    total = sum(i % 3 + 1 for i in range(600))
    assert len(rows) == 1003 and rows["FILLER_600"] == total + 1 - (599 % 3 + 1)
    assert {rows[f"X{i}"] for i in range(401)} == {total + 1} and rows["LAST_ONE"] == total + 5


def test_plan_sorts_lines_only(spark):
    plan = parse_copybooks(lines_of(spark, a=render([(1, "R", None, 1, None), (5, "A", 3, 2, None)])))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [") == 1 and plan.count("Scan") == 1 and "Join" not in plan
    assert plan.index("Generate explode(transform(placed") < plan.index("Window")  # nothing is sorted after the expansion

import random

from areastats.llm.line_dedup import dedup_lines, line_report
from brute import docs, line_dedup  # noqa: F401


def test_against_plain_python(docs):
    random.seed(3)
    lines = [f"Line {i} has words" for i in range(30)] + ["", "   "]
    ends = ["\n", ". ", "! ", "\n"]
    rows = [(i, "".join(random.choice(lines[: 4 + i % 28]) + random.choice(ends) for _ in range(random.randint(0, 25)))) for i in range(150)]
    rows += [(200 + i, rows[i][1]) for i in range(40)] + [(3, "a\nb\nc"), (500, None)]
    want = line_dedup(rows)
    out = line_report(docs(rows, lines="x", removed=1)).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r.text in [text for (i, _), text in want.items() if i == r.doc_id]
    assert sorted((r.doc_id, r.text or "") for r in out) == sorted((i, want[i, t] or "") for i, t in rows)


def test_later_window_goes_and_the_rest_stays(docs):
    rows = [(1, "a\nb\nc\nd"), (2, "x\na\nb\nc\ny"), (3, "a\nb"), (4, "b\nc\nd")]
    out = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in line_report(docs(rows)).collect()}
    assert out == {1: (4, 0, "a\nb\nc\nd"), 2: (5, 3, "x\ny"), 3: (2, 0, "a\nb"), 4: (3, 3, "")}


def test_repeats_inside_a_document(docs):
    out = line_report(docs([(1, "a\n" * 6 + "b")])).first()
    assert (out.n_removed, out.text) == (5, "a\nb") or out.text.startswith("a\n")


def test_columns_stay_and_emptied_documents_go(docs):
    df = docs([(1, "a\nb\nc"), (2, "a\nb\nc"), (3, None), (4, ""), (None, "a\nb\nc")], pos=5, key="k", __key="x", first=None)
    out = dedup_lines(df, drop_emptied=True)
    assert out.columns == df.columns
    # The row without an id sorts first, so its copy stays.
    assert sorted((r.doc_id or 0, r.text, r.pos) for r in out.collect() if r.text) == [(0, "a\nb\nc", 5)]
    assert {r.doc_id for r in out.collect() if not r.text} == {3, 4}
    assert {(r["key"], r["__key"], r["first"]) for r in out.collect()} == {("k", "x", None)}


def test_repeated_rows_are_one_document(docs):
    out = line_report(docs([(1, "a\nb\nc"), (1, "a\nb\nc"), (2, "a\nb\nc")])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in out) == [(1, 0), (1, 0), (2, 3)]


def test_very_long_and_empty_tables(docs):
    long = "\n".join(f"w{i}" for i in range(20_000))
    out = {r.doc_id: r.n_removed for r in line_report(docs([(1, long), (2, long + "\nend")])).collect()}
    assert out == {1: 0, 2: 20_000 - 1} or out == {1: 0, 2: 20_000}
    assert line_report(docs([])).collect() == []

from llm_cases import LINES, ROWS, empty, frame

from ledgerlens.llm import line_dedup


def brute(rows):
    """{(id, text): cleaned text} by the rule, in order of id (null last), then of hash-free input."""
    docs = list(dict.fromkeys((i, t) for i, t in rows if t is not None))
    docs.sort(key=lambda d: (d[0] is None, d[0] or 0))
    first, gone = {}, {}
    for n, (_, t) in enumerate(docs):
        lines = t.split("\n")
        for p in range(len(lines) - 2):
            w = tuple(x.strip(" ") for x in lines[p:p + 3])
            if not any(w):
                continue
            if w not in first:
                first[w] = (n, p)
            else:
                fn, fp = first[w]
                gone.setdefault(n, set()).update(range(max(p, fp + 3) if fn == n else p, p + 3))
    return {d: "\n".join(x for i, x in enumerate(d[1].split("\n")) if i not in gone.get(n, ()))
            for n, d in enumerate(docs)}


def test_against_brute_force(spark):
    many = "\n".join(["same line"] * 7)
    rows = [(i, t) for i, t, _, _ in ROWS] + [
        (20, "x\n" + LINES.replace("\n", "\n ")), (21, many), (22, many + "\nend"), (23, "a\nb\nc\nd\ne"),
        (24, "z\nb\nc\nd\ny\na\nb\nc"), (25, "\n\n\n\n"), (26, "\n\n\n\n"), (27, "a\nb"), (28, "a\nb")]
    docs = frame(spark, [(i, t, "en", "s") for i, t in rows], clashing=True)
    got = line_dedup.line_dedup(docs).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    before = {}
    for i, t in rows:
        before.setdefault(i, set()).add(t)
    for r in got:
        assert r.text in {want.get((r.doc_id, t)) for t in before[r.doc_id]}
        assert r["__n_lines"] - r["__n_removed"] == (0 if r.text is None else r.text.count("\n") + 1) or r.text == ""
        assert r.score == f"own {-1 if r.doc_id is None else r.doc_id}"


def test_empty_table(spark):
    assert line_dedup.line_dedup(empty(spark)).count() == 0

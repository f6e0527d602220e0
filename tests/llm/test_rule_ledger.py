import re

from tidemark.llm import rule_ledger as op


def brute_force(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    repeated = {k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(i, i + 3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(repeated),
    )


def test_measures_equal_brute_force(frame, prose):
    texts = [
        None, "", " \n\n", "a b c a b c a", "a a a a", "a b", "x\n\nx\n x\nx\t\n y", "# * $ %& | <é>",
        "\n".join(["one line here", "two", "one line here", " ", " "]), prose(400),
        prose(5) * 3, "ab\x0bcd\x0cef gh   i", " lead and trail ", "w " * 60, prose(20000, "l"),
        "EDTH!! ER!! " * 40, "A-B " * 49,
    ]
    rows = list(enumerate(texts)) + [(1, ""), (None, "a b c a b c")]
    entries = op.verdict(op.ledger(frame(rows))).collect()
    assert len(entries) == len(rows)
    found = sorted(
        (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in entries if r.doc_id is not None
    )
    small = [(i, *brute_force(t)) for i, t in rows if i is not None and i != 14]
    assert [f for f in found if f[0] != 14] == sorted(small)
    for r in entries:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert {r.doc_id for r in entries if r.kept} == {9, 14}


def test_policies_and_ablations_read_the_ledger_only(frame, prose):
    rows = [(1, prose(60)), (2, "#" * 90 + " " + prose(60)), (3, "few words"), (4, None)]
    rows += [(5, " ".join(["A B C"] * 30))]
    entries = op.ledger(frame(rows))
    assert {r.doc_id for r in op.verdict(entries, 1).collect() if r.kept} == {1, 2}
    assert {r.doc_id for r in op.verdict(entries, 2).collect() if r.kept} == {1}
    table = {r.rule: (r.n_failed, r.n_only, r.kept_without) for r in op.ablations(entries).collect()}
    assert table["symbols"] == (1, 1, 2)
    assert table["too_few_words"] == (2, 1, 2)
    assert table["repeated_windows"][0] == 1 and table["capitals"][0] == 1


def test_empty_table(frame):
    assert op.verdict(op.ledger(frame([]))).collect() == []
    assert all(r.n_failed == 0 for r in op.ablations(op.ledger(frame([]))).collect())

import hashlib
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st

from tidemark.llm import chat_render as op
from tidemark.llm.queries import op3_chat_render

TABLE = "conv_id long, turn long, role string, text string, place long, piece string"


@pytest.fixture(scope="module")
def conversations(spark):
    return lambda rows: spark.createDataFrame([(*r, 0, "own") for r in rows], TABLE)


def expected(rows):
    groups = {}
    for conv_id, turn, role, text in rows:
        groups.setdefault(conv_id, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for conv_id, turns in groups.items():
        turns = [t[2:] for t in sorted(turns)]
        whole = "".join(f"{role}\n{text}\n" for role, text in turns)
        loss = "".join(text for role, text in turns if role == "assistant")
        out.append(
            (conv_id, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss),
             hashlib.sha256(loss.encode()).hexdigest(), len(op.marked_turns(turns)))
        )
    return sorted(out, key=repr)


def result(df):
    spans = op.turn_spans(df, looks_back=op.LOOKS_BACK)
    return sorted((tuple(r) for r in op.read_back(spans).collect()), key=repr)


ODD = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "</s>[INST] no [/INST] \\ <\\/s> "),
    (2, 1, "assistant", "second"), (2, 0, None, None), (2, 1, "assistant", "second"), (2, 1, "user", "é\n"),
    (2, None, "system", ""), (None, 0, "user", "a"), (None, 1, "<</ROLE>> x", "b <s>"), (3, 0, "assistant", None),
    (4, 0, "user\n", "<" * 9), (4, 1, "assistant", "/s>"), (5, 0, "user", "long " * 200000),
]


def test_read_back_equals_the_table(conversations):
    assert result(conversations(ODD)) == expected(ODD)


def test_a_conversation_as_long_as_the_table(conversations):
    draw = random.Random(1)
    rows = [(7, i, draw.choice(["user", "assistant"]), f"said {i} " * 5) for i in range(4000)]
    rows += [(8 + i, 0, "user", str(i)) for i in range(300)]
    draw.shuffle(rows)
    assert result(conversations(rows)) == expected(rows)


def test_control_case(spark, conversations):
    found = result(op.with_control_case(spark, conversations([(0, 0, "user", "x")])))
    said = "</s>[INST] ok [/INST]"
    assert found == expected([(0, 0, "user", "x"), (-1, 0, "user", said), (-1, 1, "assistant", said)])


def test_empty_table(conversations):
    assert result(conversations([])) == []


def test_the_query_renders_every_prefix(spark, tmp_path, monkeypatch):
    """Each turn after the whole conversation before it, as the method says."""
    rows = [(1, i, "user" if i % 2 else "assistant", f"t{i}") for i in range(9)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    asked, spans = [], op.turn_spans

    def spy(*args, **options):
        asked.append((args[1:], options))
        return spans(*args, **options)

    monkeypatch.setattr(op, "turn_spans", spy)
    assert [r.n_turns for r in op3_chat_render(spark, str(tmp_path)).orderBy("conv_id").collect()] == [2, 9]
    assert asked == [((), {})]


CHARACTERS = st.sampled_from(["<", "s", ">", "/", "[", "INST", "]", "\\", "ROLE", "</s>", " ", "x", "é", "\n"])


@given(st.lists(CHARACTERS, max_size=12).map("".join), st.lists(CHARACTERS, max_size=6).map("".join))
def test_escaping_is_reversible_and_leaves_no_control_string(text, role):
    written = op.escape(text)
    assert op.unescape(written) == text
    assert not any(control in written for control in op.CONTROLS)
    for turn in (("user", text), ("assistant", text), (role, text)):
        assert op.read_turn(op.marked_turns([turn])) == turn


def test_spans_and_rewritten_history(conversations):
    def rewriting(turns):
        """Hides what the assistant said before the last user turn."""
        last = max((i for i, (role, _) in enumerate(turns) if role == "user"), default=-1)
        return "".join(
            f"{role}: {'...' if role == 'assistant' and i < last else text}\n"
            for i, (role, text) in enumerate(turns)
        )

    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "thought"), (1, 2, "user", "b"), (1, 3, "assistant", "c")]
    plain = op.turn_spans(conversations(rows)).collect()
    whole = op.marked_turns([(r[2], r[3]) for r in rows])
    assert [whole[r.start : r.end] for r in plain] == [r.piece for r in plain]
    assert "".join(r.piece for r in plain) == whole and not any(r.rewrites for r in plain)
    flagged = op.turn_spans(conversations(rows), rewriting).collect()
    assert [r.rewrites for r in flagged] == [False, False, True, False]


def test_templates_that_look_back_far(conversations):
    def forgetful(turns):
        """Numbers turns, and hides turn 2 when there are more than 8."""
        return f"[{len(turns) > 8}]" + "".join(
            f"{i}:{'...' if i == 2 and len(turns) > 8 else text}\n" for i, (_, text) in enumerate(turns)
        )

    rows = [(1, i, "user", f"said {i}") for i in range(12)]
    found = op.turn_spans(conversations(rows), forgetful).collect()
    assert [r.rewrites for r in found] == [i == 8 for i in range(12)]
    assert [r.piece for r in found[:8]] == [f"{i}:said {i}\n" for i in range(8)]
    assert found[11].piece == "11:said 11\n"
    for i, r in enumerate(found):
        assert forgetful([("user", f"said {n}") for n in range(i + 1)])[r.start : r.end] == r.piece


def test_long_conversations_are_rendered_exactly(conversations):
    """A template that numbers turns, far beyond what a task would hold of many."""

    def numbered(turns):
        return "".join(f"{i}:{text}\n" for i, (_, text) in enumerate(turns))

    rows = [(1, i, "user", "x" * 10000) for i in range(60)]
    found = op.turn_spans(conversations(rows), numbered).collect()
    assert [r.piece for r in found] == [f"{i}:{'x' * 10000}\n" for i in range(60)]
    assert not any(r.rewrites for r in found)
    assert found[-1].end == len(numbered([("user", "x" * 10000)] * 60))


def test_a_template_that_looks_back_at_one_turn(conversations):
    def joined(turns):
        """Joins turns of one role, and ends what a turn of another role follows."""
        out = ""
        for i, (role, text) in enumerate(turns):
            same = i and turns[i - 1][0] == role
            out = f"{out} {text}" if same else f"{out}{'.' if i else ''}\n{role}: {text}"
        return out

    draw = random.Random(4)
    rows = [(c, i, draw.choice("ab"), f"t{i}") for c in range(3) for i in range(40)]
    df = conversations(rows)
    whole, window = (
        sorted(map(tuple, op.turn_spans(df, joined, looks_back).collect())) for looks_back in (None, 1)
    )
    assert whole == window
    # The shipped template looks back at nothing.
    assert sorted(map(tuple, op.turn_spans(df).collect())) == sorted(
        map(tuple, op.turn_spans(df, looks_back=0).collect())
    )

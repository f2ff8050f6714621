import pytest
from hypothesis import given, settings, strategies as st

import brute
from linkgraph.llm import chat

PARTS = st.sampled_from([*chat.CONTROL, "\\", "<", ">", "[", "]", "/", "s", "INST", " ", "\n", "", "é", "\\\\", "ROLE", "hello"])
TEXT = st.lists(PARTS, max_size=12).map("".join)
ROLE = st.one_of(st.sampled_from(["user", "assistant", "system", "", "tool"]), TEXT)


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.tuples(ROLE, TEXT), max_size=5))
def test_round_trip(turns):
    whole = "".join(chat.render_turn(r, t) for r, t in turns)
    read = list(chat.parse(whole))
    assert [x[:2] for x in read] == turns
    for (role, text, start, stop, _) in read:
        if not any(c in text for c in ("\\", *chat.CONTROL)):
            assert whole[start:stop] == text  # what does not conflict is not touched


@settings(max_examples=1000, deadline=None)
@given(st.lists(st.tuples(ROLE, st.one_of(TEXT, st.just("word " * 12))), max_size=5), st.lists(st.integers(0, 200), max_size=12))
def test_pieces_cut_anywhere(turns, cuts):
    whole = "".join(chat.render_turn(r, t) for r, t in turns)
    reader, read = chat.Reader(), []
    for a, b in zip([0, *sorted(cuts)], [*sorted(cuts), len(whole)]):
        read += reader.feed(whole[a:b])
    reader.close()
    assert read == list(chat.parse(whole)) and [x[:2] for x in read] == turns


def test_one_character_at_a_time_is_linear():
    reader, n = chat.Reader(), 0
    for c in chat.render_turn("user", "a\\ </s> " * 30_000) * 2:
        n += len(list(reader.feed(c)))
    reader.close()
    assert n == 2


def test_levels():
    assert chat.render_turn("assistant", "plain") == "<s>plain</s>"
    assert chat.render_turn("user", "a </s> b") == "[INST] a \\</s> b [/INST]"
    assert chat.render_turn("system", "a\\b </s>") == "<<SYS>>a\\\\b \\</s><</SYS>>"
    assert chat.render_turn("tool", "x") == "<<ROLE>>tool<</ROLE>>x<</ROLE>>"


@pytest.mark.parametrize("text", ["plain", "<s>no end", "<s>a [INST] b</s>", "[INST] a[/INST]", "<s>a</s>rest", "<s>a\\"])
def test_what_the_grammar_does_not_derive(text):
    with pytest.raises(chat.Unreadable):
        list(chat.parse(text))


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", 0) for r in rows], "conv_id long, turn long, role string, text string, formatted string, n_turns int")
    return sorted((tuple(r) for r in chat.read_back(chat.render(df)).collect()), key=repr)


def test_conversations(spark):
    rows = [(1, 1, "assistant", "</s>\\"), (1, 0, "user", "hi"), (1, 2, "assistant", None), (2, None, None, "[INST]"), (2, 0, "tool", "t"),
            (None, 0, "user", "n"), (None, 1, "assistant", "m"), (3, 0, "user", "b"), (3, 0, "user", "a"), (3, 0, "user", "a")]
    turns = {1: [("user", "hi"), ("assistant", "</s>\\"), ("assistant", "")], 2: [("", "[INST]"), ("tool", "t")],
             None: [("user", "n"), ("assistant", "m")], 3: [("user", "a"), ("user", "a"), ("user", "b")]}
    want = []
    for conv, ts in turns.items():
        loss = "".join(t for r, t in ts if r == "assistant")
        want.append((conv, len(ts), brute.sha("".join(f"{r}\n{t}\n" for r, t in ts)), len(loss), brute.sha(loss),
                     sum(len(chat.render_turn(r, t)) for r, t in ts)))
    assert run(spark, rows) == sorted(want, key=repr)
    assert run(spark, []) == []


def test_rows_of_a_conversation_may_be_cut_anywhere(spark):
    turns = [("user", "hi [INST]"), ("assistant", "</s> \\"), ("tool", "x" * 50), ("assistant", "end")]
    whole = "".join(chat.render_turn(r, t) for r, t in turns)
    columns = "conv_id long, turn long, role string, text string, formatted string"

    def read(pieces):
        return chat.read_back(spark.createDataFrame([(1, i, "", "", p) for i, p in enumerate(pieces)], columns)).collect()

    aligned = read([chat.render_turn(r, t) for r, t in turns])
    assert read([whole]) == read([whole[i:i + 7] for i in range(0, len(whole), 7)]) == aligned and aligned[0]["n_turns"] == 4
    with pytest.raises(Exception, match="conversation 1: "):
        read([whole, "<s>no end"])


def test_long_conversation_and_text(spark):
    rows = [(1, i, "user" if i % 2 else "assistant", f"t{i}") for i in range(3000)] + [(2, 0, "assistant", "</s>" * 200_000)]
    got = run(spark, rows)
    assert got[0][1] == 3000 and got[1][3] == 800_000 and got[1][4] == brute.sha("</s>" * 200_000)

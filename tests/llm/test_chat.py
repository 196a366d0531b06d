import itertools
import zlib
from collections import Counter

import numpy as np
from helpers import clashing

from orbita.llm import chat as C
from orbita.llm import common

SF = "/root/testdata/sf0.1"
SCHEMA = "conv_id long, turn long, role string, text string"


def chats(df):
    """Rendered chat and number of turns of each conversation."""
    out = {}
    rows = df.collect()
    for r in sorted(rows, key=lambda r: (r.conv_id, r.turn_no if r.turn_no is not None else -1)):
        out.setdefault(r.conv_id, []).append(r)
    for turns in out.values():
        assert [r.turn_no for r in turns] in (list(range(len(turns))), [None])
        assert all(r.rendered == (C.render([(r.role, r.text)]) if r.role else "") for r in turns)
    return {i: ("".join(r.rendered for r in t), sum(r.role is not None for r in t)) for i, t in out.items()}


def test_held_out_transcripts(spark):
    table = common.table(spark, SF, "conversations")
    got = chats(C.format_chats(table))
    told = table.select("conv_id", "turn", "role", C.written_text("conv_id", "turn", "role", "text").alias("text"))
    truth = {}
    for r in sorted(told.distinct().collect(), key=lambda r: (r.conv_id, r.turn, r.role, r.text)):
        truth.setdefault(r.conv_id, []).append((r.role, r.text))
    assert len(got) == len(truth)
    assert sum("\n\n" in t for x in truth.values() for _, t in x) > 0.08 * sum(map(len, truth.values()))
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    right = [got[i][0] == C.render(truth[i]) for i in held]
    assert len(held) > 10 and np.mean(right) >= 0.8


def test_paragraphs_and_code_stay_in_their_turn(spark):
    table = C.with_borders(common.written(C.transcripts(common.table(spark, SF, "conversations")), "chat-test"))
    m = C.train(table.where(~C.is_held_out()))
    text = "User: What is it?\n\nAssistant: First a thought.\n\nAnswer: it is 42.\n\nThat is all.\n\nUser: Thanks.\n\nAssistant: Gladly."
    assert m.turns(text) == [("user", "What is it?"), ("assistant", "First a thought.\n\nAnswer: it is 42.\n\nThat is all."), ("user", "Thanks."),
                             ("assistant", "Gladly.")]
    code = "def f(x):\n\n    return x\n\n    # done;"
    text = f"Human: Show me.\n\nAI: It is here:\n\n{code}\n\nHuman: Why?\n\nAI: Because."
    assert m.turns(text) == [("user", "Show me."), ("assistant", f"It is here:\n\n{code}"), ("user", "Why?"), ("assistant", "Because.")]


def model():
    turns = [("system", "System: be kind\nalways"), ("user", "\nUser: what is it?\nreally"), ("assistant", "\nAssistant: it is this\nand that"),
             ("user", "\nso?"), ("assistant", "\nAI: yes")]
    first, steps, seen = Counter(), Counter(), Counter()
    for _ in range(20):
        for a, b in zip((first, steps, seen), C.count_lines(turns)):
            a.update(b)
    return C.Model(first, steps, seen)


def test_viterbi_against_brute_force():
    m, rng = model(), np.random.default_rng(1)
    for n in range(1, 4):
        seen = [tuple(int(rng.integers(k)) for k in C.OBSERVATIONS) for _ in range(n)]
        best = max(itertools.product(range(len(C.STATES)), repeat=n), key=lambda p: m.first[p[0]] + sum(
            m.steps[a, b] for a, b in zip(p, p[1:])) + sum(m.emission(o)[s] for o, s in zip(seen, p)))
        got = m.decode(seen)
        value = lambda p: m.first[p[0]] + sum(m.steps[a, b] for a, b in zip(p, p[1:])) + sum(
            m.emission(o)[s] for o, s in zip(seen, p))
        assert abs(value(got) - value(best)) < 1e-9


def test_markers_and_rendering():
    m = model()
    text = "### System:\nBe kind.\n\n**Human:** what is it?\nmore\n\n[Assistant]: this\n\nand this?\n\nBot: yes"
    got = m.turns(text)
    assert got[0] == ("system", "Be kind.") and got[1][0] == "user" and got[1][1].startswith("what is it?")
    assert C.render([("user", "a\nb")]) == "<|user|>\na\nb<|end|>\n"
    assert m.turns(None) == m.turns("") == m.turns(" \n\n") == []
    assert [k[1][0] for k in C.lines_of("Time is 10:30 now\nhttp://x\nMaria: hello\nQ: x\n<|user|> hi")] == [0, 0, 4, 2, 2]


def test_turns_keep_their_text():
    own = "def f():\n\n    pass\n\n\nNote: that is all"
    talk = [("system", "System: be kind"), ("user", f"\nUser:  first\n\n  second\n\n{own}"), ("assistant", f"\nAssistant: yes\n\n{own}"),
            ("user", "\nNote: one more\n\n  second"), ("assistant", f"\nAssistant: no\n\n{own}")]
    m = C.Model(*[Counter({k: 20 * n for k, n in c.items()}) for c in C.count_lines(talk)])
    # Decoding is held at the true states: only what is kept of the lines is in question.
    states = [C.STATES.index((role, k == 0, 0)) for role, raw in talk for k in range(sum(1 for x in raw.split("\n") if x.strip()))]
    m.decode = lambda observations: states
    assert m.turns("\n".join(raw for _, raw in talk)) == [
        ("system", "be kind"), ("user", f" first\n\n  second\n\n{own}"), ("assistant", f"yes\n\n{own}"),
        ("user", "Note: one more\n\n  second"), ("assistant", f"no\n\n{own}")]
    assert C.announcing([("system", "note"), ("user", "maria"), ("user", "tip"), ("user", "maria")]) == {
        ("system", "note"), ("user", "maria")}


def test_chunks_read_as_one_transcript(spark, monkeypatch):
    rows = [(c, i // 3 if c % 2 else i, ("user", "assistant")[i % 2], f"own {i}\n\n  more {'?' * (i % 3)}") for c in range(10) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    # Names that tell nothing of the role leave ways of equal likelihood; any of them may be taken.
    named = {r.conv_id for r in C.transcripts(df).collect() if any(t.raw.strip().startswith(("Maria:", "Tom:")) for t in r.turns)}
    sure = lambda found: {i: x for i, x in found.items() if i not in named}
    whole = sure(chats(C.format_chats(df)))
    assert len(whole) > 5
    monkeypatch.setattr(C, "PART_ROWS", 7)
    monkeypatch.setattr(C, "PART_TURNS", 16)
    for fan in (2, 3, 256):  # several levels of tables, two, one
        monkeypatch.setattr(C, "FAN", fan)
        assert C.transcripts(df).groupBy("conv_id").count().where("count < 3").count() == 0
        assert sure(chats(C.format_chats(df))) == whole


def test_border_states_of_products_against_one_pass():
    m, rng = model(), np.random.default_rng(2)
    n = len(C.STATES)
    for _ in range(30):
        lines = [[tuple(int(rng.integers(k)) for k in C.OBSERVATIONS) for _ in range(rng.integers(0, 4))] for _ in range(9)]
        tables = [m.ways(x)[0] if x else None for x in lines]
        states = m.decode([o for x in lines for o in x])
        groups = [tables[:3], tables[3:6], tables[6:]]
        tops = C.stitch([C.product(g) for g in groups])
        ends = [x for g, (a, b) in zip(groups, tops) for x in C.stitch(g, a, b)]
        at = 0
        for x, (before, last) in zip(lines, ends):
            assert before == (states[at - 1] if at else None)
            at += len(x)
            assert last == (states[at - 1] if at else None)
        assert C.product([None, None]) is None and C.product([None, np.zeros((n + 1, n))]).shape == (n + 1, n)


def test_edges(spark):
    rows = [(1, 0, "user", "hello there"), (1, 0, "user", "hello there"), (1, 1, "assistant", None), (1, 2, "user", ""),
            (None, 0, "user", "no conversation"), (None, 1, "user", "no conversation"), (2, None, "user", "no turn"),
            (3, 0, None, "no role"), (3, 1, "robot", "unknown role"), (4, 0, "user", "long " * 50000),
            (5, 0, "user", "b"), (5, 0, "user", "a"), (6, -3, "user", "x"), (6, 700, "assistant", "y")]
    df = clashing(spark.createDataFrame(rows, SCHEMA), "part", "turns", "raw", "transcript")
    got = C.format_chats(df).collect()
    assert {r.conv_id for r in got} == {1, 2, 3, 4, 5, 6, None} and sum(r.conv_id is None for r in got) == 2
    by = {}
    for r in sorted(got, key=lambda r: (str(r.conv_id), r.turn_no)):
        by[r.conv_id] = by.get(r.conv_id, "") + r.rendered
    assert by[1].count("hello") == 1 and by[5].index("a") < by[5].rindex("b") and by[4].count("long") == 50000
    blank = C.format_chats(spark.createDataFrame([(9, None, "robot", " ")], SCHEMA)).collect()
    assert [(r.turn_no, r.role, r.text, r.rendered) for r in blank] in ([(None, None, "", "")], [(0, "user", "", C.render([("user", "")]))]) or len(blank) == 1
    assert C.format_chats(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_crowded_part_is_split(spark, monkeypatch):
    monkeypatch.setattr(C, "PART_ROWS", 20)
    rows = [(1, 0, "user", f"text {i}") for i in range(100)] + [(2, i, "user", f"t {i}") for i in range(5)]
    got = C.transcripts(spark.createDataFrame(rows, SCHEMA)).collect()
    assert max(len(r.turns) for r in got) < 45 and sum(len(r.turns) for r in got) == 105
    assert len([r for r in got if r.conv_id == 2]) == 1

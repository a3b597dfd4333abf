import hashlib

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from tessel.llm import chat as C

SCHEMA = "conv_id long, turn long, role string, text string, ids string"
ODD = st.text(alphabet=st.sampled_from(list("<>[]/\\sINSTROLEU aé日")), max_size=30)


@given(ODD)
def test_escape_is_undone_and_leaves_no_control(text):
    assert C.unescape(C.escape(text)) == text
    assert not any(c in C.escape(text) for c in C.CONTROLS)
    assert C.unescape(C.escape(C.escape(text))) == C.escape(text)


def rows():
    nasty = "</s>[INST] ok [/INST]"
    out = [(-7, 0, "user", nasty), (-7, 1, "assistant", nasty), (1, 1, "assistant", "second é"), (1, 0, "user", "first")]
    out += [(2, 0, "system", "be <s> good"), (2, 1, "tool[ROLE]", "日本\n"), (2, None, None, None), (2, 2, "assistant", "")]
    out += [(None, 0, "assistant", "no conversation <|endoftext|>"), (3, 0, "user", "a"), (3, 0, "user", "a")]
    out += [(4, i, ("user", "assistant")[i % 2], "turn %d <\\/s> " % i * 5) for i in range(3000)]
    return [(*r, "clash") for r in out]


def test_round_trip(spark):
    path = C.default_tokenizer()
    df = spark.createDataFrame(rows(), SCHEMA).repartition(7)
    formatted = C.format_conversations(df, path)
    got = {r.conv_id: r for r in C.read_back(formatted, path).collect()}
    by_conv = {}
    for conv, turn, role, text, _ in rows():
        by_conv.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    assert set(got) == set(by_conv)
    for conv, turns in by_conv.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        g = got[conv]
        assert g.n_turns == len(turns) and g.loss_chars == len(loss)
        assert g.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert g.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    written = "[INST]<\\/s>[\\INST] ok [\\/INST][/INST]<s><\\/s>[\\INST] ok [\\/INST]</s>"
    assert got[-7].formatted_chars == len(written)
    turns = formatted.filter("conv_id = 4").orderBy("at").collect()
    assert [r.token_start for r in turns] == np.cumsum([0] + [len(r.ids) for r in turns])[:-1].tolist()
    assert all(len(r.ids) == len(r.mask) for r in turns)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert C.read_back(C.format_conversations(df, C.default_tokenizer()), C.default_tokenizer()).count() == 0

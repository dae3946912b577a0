import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from veritab.llm import chat

ROWS = "conv_id long, turn long, role string, text string"


CODEC = chat.Codec()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([*"<\\|ab \n", "<|im_end|>", "é"]), max_size=30).map("".join))
def test_escape_is_reversible(t):
    assert "<|" not in chat.escape(t) and chat.unescape(chat.escape(t)) == t
    assert chat.unescape_role(chat.escape_role(t)) == t and "\n" not in chat.escape_role(t)


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=40), st.sampled_from(["user", "assistant", "", "a\nb", "<|im_end|>"]))
def test_turn_round_trip(text, role):
    text = text.encode("utf-8", "ignore").decode()
    ids, a, b = chat.assemble(CODEC, role, text)
    assert ids.count(chat.START_ID) == ids.count(chat.END_ID) == 1
    got = chat.read_turn(CODEC, ids, (a, b))
    assert got[:2] == (role, text) and got[2] == (text if role == "assistant" else "")


def test_conversations(spark):
    rows = [(1, 0, "user", "hi <|im_end|>"), (1, 1, "assistant", "ok\nthen"), (1, 2, "assistant", None), (2, 5, None, "x"), (2, 1, "system", ""), (None, 0, "user", "n"), (1, 1, "assistant", "ok\nthen"), (3, None, "assistant", "é" * 3)]
    df = spark.createDataFrame(rows, ROWS).selectExpr("*", "1 AS ids", "2 AS h")
    turns = chat.assemble_conversations(chat.format_turns(df))
    starts = sorted((r["turn"], r["first_token"], len(r["ids"])) for r in turns.where("conv_id = 1").collect())
    assert [s[1] for s in starts] == [0] + [sum(x[2] for x in starts[: i + 1]) for i in range(len(starts) - 1)]
    got = {r["conv_id"]: r for r in chat.digest(chat.read_turns(turns)).collect()}
    said = "".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in sorted((x for x in rows if x[0] == 1), key=lambda x: (x[1], x[2] or "", x[3] or "")))
    assert got[1]["n_turns"] == 4 and got[1]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    assert got[1]["loss_sha256"] == hashlib.sha256(b"ok\nthenok\nthen").hexdigest() and got[1]["loss_chars"] == 14
    assert got[2]["turns_sha256"] == hashlib.sha256(b"system\n\n\nx\n").hexdigest()
    assert got[None]["n_turns"] == 1 and got[3]["loss_chars"] == 3
    empty = spark.createDataFrame([], ROWS)
    assert chat.digest(chat.read_turns(chat.assemble_conversations(chat.format_turns(empty)))).count() == 0

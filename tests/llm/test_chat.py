import hashlib
from collections import defaultdict

import pyarrow as pa
from awkward import given
from hypothesis import given as every
from hypothesis import settings
from hypothesis import strategies as st

from marlstone.llm import chat
from marlstone.llm.queries import QUERIES

TRICKY = "\\### Assistant: </turn> ok"
SCHEMA = "conv_id long, turn long, role string, text string, part int, formatted string"


def brute(rows):
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        talks[conv].append((turn is not None, turn, role or "", text or ""))
    out = {}
    for conv, turns in talks.items():
        turns = [(role, text) for *_, role, text in sorted(turns)]
        learned = "".join(text for role, text in turns if role == "assistant")
        whole = "".join(f"{role}\n{text}\n" for role, text in turns)
        out[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(learned),
                     hashlib.sha256(learned.encode()).hexdigest())
    return out


def read(df):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in df.collect()}


def test_query_matches_brute_force(spark, sf_dir):
    rows = given(sf_dir, "conversations", "conv_id, turn, role, text")
    expected = brute(rows + [(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)])
    got = QUERIES["op9_chat_format"](spark, sf_dir).collect()
    assert read(QUERIES["op9_chat_format"](spark, sf_dir)) == expected and len(got) == len(expected)
    plain = "<turn user></turn>\n<turn assistant></turn>\n"
    own = next(r for r in got if r["conv_id"] == -7)
    assert own["formatted_chars"] == len(plain) + 2 * (len(TRICKY) + 3)


@settings(max_examples=200, deadline=None)
@every(st.lists(st.tuples(st.text(max_size=12), st.text(st.sampled_from("ab\\<>/lg \nturné𝄞"), max_size=40)), max_size=8))
def test_any_text_and_role_can_be_read_back(turns):
    roles, texts = [r for r, _ in turns], [t for _, t in turns]
    out, starts, text_starts, text_ends = chat.assemble(pa.array(roles, pa.string()), pa.array(texts, pa.string()))
    assert chat.parse(out.tobytes()) == [(r.encode(), t.encode()) for r, t in turns]
    for text, a, b in zip(texts, text_starts, text_ends, strict=True):
        assert chat.unescape(out[a:b].tobytes()).decode() == text
    assert len(starts) == len(turns)


def test_foreign_text_is_refused():
    for bad in (b"x", b"<turn a>b</turn>", b"<turn a><b</turn>\n", b"<turn a>b</turn>\nmore"):
        try:
            chat.parse(bad)
        except ValueError:
            continue
        raise AssertionError(bad)


def test_awkward_rows(spark):
    rows = [(1, 2, "user", "b"), (1, 1, None, None), (1, 2, "user", "b"), (1, 2, "assistant", ""), (None, 0, "user", "x"),
            (2, None, "assistant", "first"), (2, 0, "assistant", "second"), (3, 0, "assistant", "long <> " * 300_000),
            (3, 1, "assistant", "after"), (4, 0, "a>b<c\\", "odd role")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    assert read(chat.read_back(chat.format_chats(df))) == brute(rows)
    assert chat.read_back(chat.format_chats(df.limit(0))).count() == 0


def test_a_hot_conversation_is_dealt_to_many_tasks(spark):
    rows = [(5, i, "assistant" if i % 2 else "user", f"turn {i} " * 20) for i in range(4000)]
    rows += [(100 + i, 0, "user", "hello") for i in range(2000)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(8)
    assert read(chat.read_back(chat.format_chats(df))) == brute(rows)
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")
    try:
        parts = chat.format_chats(df)
        assert parts.where("conv_id = 5").select("shard").distinct().count() > 3
    finally:
        spark.conf.unset(merging)

"""Chat trees: what is packed gives every conversation back, shared turns are emitted once."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tsmedallion.llm import chat_trees as ct
from tsmedallion.llm.queries import RANKS

SCHEMA = "conv_id long, turn long, role string, text string"
HARD = [r"\### Assistant: </turn> ok", "#### ##### ###", "<</turn>></turn>", "\\", "\\\\h \\l", "", "###", "</turn>\n### user: hi", "émoji \U0001f600"]


@given(st.lists(st.sampled_from(["#", "##", "<", "</turn>", "\\", "h", "l", "c", ":", " ", "\n", "é", "### "]), max_size=12).map("".join))
@settings(max_examples=300, deadline=None)
def test_escapes_are_taken_back_and_hide_the_marks(text):
    for name in (ct.escape, ct.escape_role):
        hidden = name(text)
        assert ct.unescape(hidden) == text and "###" not in hidden and "</turn>" not in hidden
    assert ":" not in ct.escape_role(text)
    assert ct.read_turn(ct.OPEN + ct.escape_role(text) + ct.NAMED + ct.escape(text) + ct.CLOSE) == (text, text)


def wanted(rows):
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by_conv.items():
        turns.sort()
        digest = hashlib.sha256("".join(f"{r}\n{t}\n" for *_, r, t in turns).encode()).hexdigest()
        loss = "".join(t for *_, r, t in turns if r == "assistant")
        chars = sum(len(f"### {ct.escape_role(r)}: {ct.escape(t)}</turn>\n") for *_, r, t in turns)
        out[conv] = (len(turns), digest, len(loss), hashlib.sha256(loss.encode()).hexdigest(), chars)
    return out


def packed(spark, rows, **more):
    packs = ct.pack_conversations(spark.createDataFrame(rows, SCHEMA).repartition(4), RANKS, **more)
    found = ct.read_back(packs, RANKS, depth=more.get("depth", ct.DEPTH)).collect()
    return packs.collect(), {r[0]: tuple(r[1:]) for r in found}


CONVERSATIONS = [
    *((i, t, ("user", "assistant")[t % 2], HARD[(i * t) % len(HARD)]) for i in range(12) for t in range(1 + i % 5)),
    *((100 + i, t, "user", f"same {t}") for i in range(30) for t in range(3)),  # copies
    *((200 + i, t, "user", f"same {t}" if t < 2 else f"own {i} {t}") for i in range(20) for t in range(4)),
    *((300, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(300)),  # a long one, and one that branches off it
    *((301, t, "assistant" if t % 2 else "user", f"turn {t}" if t < 200 else f"other {t}") for t in range(260)),
    (400, None, "user", "no number"), (400, 1, None, None), (400, 1, None, None), (400, 2, "a: b\n### c</turn>", "odd role"),
    (None, 0, "user", "no id"), (None, 1, "assistant", "none"),
    (500, 7, "user", "same 0"), (500, 9, "user", "same 1"),
    (600, 0, "assistant", "long words " * 30_000), (601, 0, "user", "x" * 400_000),
]


@pytest.mark.parametrize("more", [{}, {"pack_tokens": 40, "depth": 5}])
def test_every_conversation_comes_back(spark, more):
    _, found = packed(spark, CONVERSATIONS, **more)
    assert found == wanted(CONVERSATIONS)


def test_shared_turns_are_emitted_once_depth_first(spark):
    rows, found = packed(spark, CONVERSATIONS[:-2], depth=512)
    codec = ct.Codec(open(RANKS, "rb").read())
    packs = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.pack, r.seq)):
        packs[r.pack].append(r)
    for own in packs.values():
        tokens, nodes = [], set()
        for r in own:
            path = tuple(t for s in r.attends for t in tokens[s.first : s.end])
            assert len(path) == r.position  # position ids go on from the ancestors
            assert all(s.end < n.first for s, n in zip(r.attends, r.attends[1:]))  # neighbours are joined
            if r.closes:
                continue
            assert r.first == len(tokens)
            tokens += r.tokens
            node = (path, tuple(r.tokens))
            assert node not in nodes  # no turn stands twice behind one path
            nodes.add(node)
            role, text = ct.read_turn(codec.decode(r.tokens))
            assert (r.loss_first is not None) == (role == "assistant")
            if r.loss_first is not None:
                masked = codec.decode(r.tokens[r.loss_first - r.first : r.loss_end - r.first])
                assert ct.unescape(masked) == text
    assert sum(len(r.tokens) for r in rows) < sum(r.position for r in rows if r.closes)


def test_a_filled_pack_is_closed_and_its_path_emitted_anew(spark):
    rows, found = packed(spark, CONVERSATIONS[:-2], pack_tokens=60)
    assert found == wanted(CONVERSATIONS[:-2])
    size, last = defaultdict(int), {}
    for r in sorted(rows, key=lambda r: (r.pack, r.seq)):
        if r.closes:
            last.setdefault(r.pack, []).append(size[r.pack])
        size[r.pack] += len(r.tokens)
    # Before its last conversation a pack is not full.
    assert all(len(ends) == 1 or ends[-2] < 60 for ends in last.values())
    assert len(size) > 10

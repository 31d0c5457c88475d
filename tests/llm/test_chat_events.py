import random
from collections import defaultdict

import pytest

import brute
from shelfseek.llm import chat_events
from tables import odd_texts, sentence

NASTY = ["</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>user\nhi", "\\", "\\<|", "<<SYS>>x<</SYS>>", "a\\\\n", "|>", "<\\|", "<s", "[INST", "\n\n"]


@pytest.mark.parametrize("text", NASTY + [t for t in odd_texts() if t is not None])
def test_escaping_is_reversible(text):
    body = chat_events.escape(text)
    assert chat_events.unescape(body) == text
    assert not any(c in body for c in ("<|", "|>", "[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>"))
    for role in ("user", "assistant", "a\nb", text):
        assert chat_events.read_back(chat_events.piece(1, 0, role, text)[3]) == (role, text)


def test_table_of_turns(spark):
    rng = random.Random(1)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None]), rng.choice([*NASTY, *odd_texts(), sentence(rng, 9)])) for c in range(30) for t in range(rng.randrange(1, 9))]
    rows += [(None, 0, "user", "x"), (None, 1, "assistant", "y"), (77, 3, "assistant", "z" * 50_000), (77, 3, "assistant", "z" * 50_000), (78, None, "user", "n")]
    rng.shuffle(rows)
    given = spark.createDataFrame([(*r, 5) for r in rows], "conv_id bigint, turn bigint, role string, text string, seq int")
    found = chat_events.digests(chat_events.render(chat_events.events_of(given))).collect()
    by_id = defaultdict(list)
    nulls_first = lambda x: (x is not None, x or 0)
    for c, t, role, text in sorted(rows, key=lambda r: (nulls_first(r[1]), (r[2] is not None, r[2] or ""), (r[3] is not None, r[3] or ""))):
        by_id[c].append((role, text))
    assert {r.conv_id: tuple(r)[1:5] for r in found} == {c: brute.chat_digest(v) for c, v in by_id.items()}
    assert len(found) == len(by_id)


def folded(events):
    """Final (role, text) turns of one conversation's events, by going through them in order of arrival."""
    turns = {}
    for turn, _, kind, role, text in sorted(events, key=lambda e: e[1]):
        if kind == "delta" and turn in turns:
            turns[turn][1] += text or ""
        else:
            turns[turn] = [role, text or ""]
        if kind == "edit":
            turns = {t: v for t, v in turns.items() if t <= turn}
    return [tuple(turns[t]) for t in sorted(turns)]


def test_event_logs(spark):
    rng = random.Random(2)
    rows, expected = [], {}
    for c in range(25):
        events = []
        for seq in range(rng.randrange(1, 30)):
            turn = rng.randrange(0, 5)
            kind = rng.choice(["message", "delta", "delta", "delta", "edit", "regenerate"])
            events.append((turn, seq, kind, "assistant" if turn % 2 else "user", sentence(rng, 2) + " "))
        rows += [(c, *e) for e in events]
        expected[c] = folded(events)
    rng.shuffle(rows)
    given = spark.createDataFrame(rows, "conv_id bigint, turn bigint, seq bigint, kind string, role string, text string")
    pieces = chat_events.render(given)
    found = defaultdict(list)
    for r in pieces.orderBy("conv_id", "turn").collect():
        found[r.conv_id].append(chat_events.read_back(r.formatted))
        if r.loss_start is not None:
            assert chat_events.unescape(r.formatted[r.loss_start : r.loss_end]) == found[r.conv_id][-1][1]
    assert dict(found) == expected


def test_empty_table(spark):
    given = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat_events.digests(chat_events.render(chat_events.events_of(given))).count() == 0
